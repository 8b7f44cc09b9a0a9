"""Login, Markdown, commit-message and token expressions.

The patterns spell out Unicode classes instead of ``\\w``, ``\\s`` and ``\\d``:
those are ASCII-only in Java, and the analyses need the Unicode meaning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import bound

# White space as Unicode-aware string stripping understands it.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WORD = r"[\p{L}\p{N}_]"

# Characters that count as digits (decimal digits, superscripts,
# subscripts, circled and parenthesised digits and a few historic scripts).
DIGIT = (
    r"[\p{Nd}\x{b2}\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}"
    r"\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}"
    r"\x{24f5}-\x{24fd}\x{24ff}\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}"
    r"\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}]"
)

# Fragments that mark an automated account.
BOT_MARKS = ("bot", "renovate", "github-actions", "gitlab-ci")

# Commit types in priority order and the words that signal them.
COMMIT_TYPES = {
    "fix": ("fix", "bug", "patch", "hotfix", "error", "repair", "correct", "typo", "broke", "broken", "revert",
            "crash", "fail"),
    "feature": ("feat", "add", "new", "implement", "introduce", "create", "support", "feature", "initial", "allow",
                "enable"),
    "refactor": ("refactor", "cleanup", "clean", "reorganize", "rename", "restructure", "move", "extract", "simplify",
                 "rewrite", "split"),
    "test": ("test", "tests", "spec", "specs", "assert", "coverage", "mock", "pytest", "unittest"),
    "docs": ("doc", "docs", "readme", "changelog", "documentation", "guide", "docstring"),
}
COMMIT_LABELS = (*COMMIT_TYPES, "other")

# Issue labels that mark a feature request.
FEATURE_LABELS = ("enhancement", "feature", "feature request", "feature-request", "type: feature", "type:feature",
                  "kind/feature", "new feature")

# English function words left out of vocabularies. Spellings with
# an apostrophe are not listed because a token never contains one.
STOP_WORDS = tuple(
    """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
    it its itself they them their theirs themselves what which who whom this that these those am is are was were be
    been being have has had having do does did doing a an the and but if or because as until while of at by for with
    about against between into through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some such no nor not only
    own same so than too very s t can will just don should now d ll m o re ve y ain aren couldn didn doesn hadn hasn
    haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn""".split()
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def remove_nul(text: Column) -> Column:
    return F.coalesce(F.translate(text, "\x00", ""), F.lit(""))


def unix_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\\r\\n|\\r", "\n")


def canonical_login(login: Column) -> Column:
    return F.lower(strip(F.coalesce(login, F.lit(""))))


def is_bot_login(login: Column, strict: bool = False) -> Column:
    """True for automated accounts.

    The default flags any login containing ``bot``; ``strict`` wants ``bot`` to
    stand at the end or as a ``[bot]`` suffix, so that ``abbott`` is a person.
    """
    name = canonical_login(login)
    if strict:
        return name.rlike(r"bot(\[bot\])?$|\[bot\]$") | name.rlike("renovate|github-actions|gitlab-ci")
    flag = F.lit(False)
    for mark in BOT_MARKS:
        flag = flag | name.contains(mark)
    return flag


def canonical_user(login: Column, strict: bool = False) -> Column:
    """Struct (login_norm, is_bot)."""
    return F.struct(canonical_login(login).alias("login_norm"), is_bot_login(login, strict).alias("is_bot"))


def plain_text(markdown: Column) -> Column:
    """Markdown reduced to plain text, code spans tagged, white space settled.

    A fence is matched by two exclusive alternatives, with or without a line
    break, so an unclosed fence costs one scan of the text instead of one per
    character of its line. A one-line fence leaves an empty code tag.
    """
    text = F.coalesce(markdown, F.lit(""))
    # The patterns below and their order.
    text = F.regexp_replace(text, r"(?s)```[^\n]*(\n.*?)```|```[^\n]*```", "<CODE>$1</CODE>")
    text = F.regexp_replace(text, "`([^`]*)`", "<CODE>$1</CODE>")
    text = F.translate(text, "#", "")
    text = F.regexp_replace(text, rf"^{SPACE}*(?:[-*+]|\p{{Nd}}+\.)", "")
    text = unix_newlines(text)
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    text = F.regexp_replace(text, r"[ \t]{2,}", " ")
    return F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


# Fixed value: the form of a conventional commit header.
HEADER = rf"^({WORD}+)(?:\(([^)]+)\))?(!)?:{SPACE}+([^\n]*)\z"


def commit_parts(message: Column) -> Column:
    """Struct (subject, body, cc_type, cc_scope, cc_breaking) of a commit message."""
    clean = strip(unix_newlines(F.coalesce(message, F.lit(""))))
    head = F.substring_index(clean, "\n", 1)
    rest = F.when(F.instr(clean, "\n") > 0, F.substr(clean, F.instr(clean, "\n") + 1)).otherwise("")
    conventional = head.rlike(HEADER)

    def part(group: int) -> Column:
        return F.regexp_extract(head, HEADER, group)

    return F.struct(
        F.when(conventional, part(4)).otherwise(head).alias("subject"),
        plain_text(strip(rest)).alias("body"),
        F.when(conventional, F.lower(part(1))).alias("cc_type"),
        F.when(conventional & (part(2) != ""), part(2)).alias("cc_scope"),
        (conventional & (part(3) == "!")).alias("cc_breaking"),
    )


def commit_label(message: Column) -> Column:
    """First commit type, by priority, one of whose words occurs as a whole word.

    The message is cut into words once; a text search per type would read it up to
    five times.
    """
    return bound(words(message), label_of_words)


def label_of_words(found: Column) -> Column:
    """The commit type of an array of lower-cased words."""
    label = None
    for name, signals in COMMIT_TYPES.items():
        hit = F.arrays_overlap(found, F.array(*map(F.lit, signals)))
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label.otherwise("other")


def word_counts(found: Column, min_length: int = 3, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Distinct vocabulary tokens of an array of words, as structs (token, n): the runs of the sorted array."""

    def runs(ordered: Column) -> Column:
        size = F.size(ordered)
        ends = F.filter(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), lambda i: (i <= size) & ((i == size) | ~F.get(ordered, i - 1).eqNullSafe(F.get(ordered, i))))

        def counted(stops: Column, starts: Column) -> Column:
            return F.transform(stops, lambda stop, i: F.struct(F.get(ordered, stop - 1).alias("token"), (stop - F.get(starts, i)).cast("long").alias("n")))

        # the starts are bound too: inside the loop they would be made again for every run
        return bound(ends, lambda stops: bound(F.concat(F.array(F.lit(0)), stops), lambda starts: counted(stops, starts)))

    # sort_array compares strings itself, array_sort by an expression
    return F.filter(bound(F.sort_array(found), runs), lambda pair: keeps_word(pair["token"], min_length, stop_words))


def is_feature_request(labels: Column) -> Column:
    """1 when any of the comma-joined labels names a feature request."""
    names = F.transform(F.split(labels, ","), lambda item: F.lower(strip(item)))
    return F.coalesce(F.arrays_overlap(names, F.array(*map(F.lit, FEATURE_LABELS))), F.lit(False)).cast("int")


def comment_body(raw: Column) -> Column:
    """Comment text without its opening and closing marker; '' when nothing is left."""
    text = F.regexp_replace(strip(raw), r"^(?://|/\*|#)", "")
    return strip(F.regexp_replace(text, r"\*/\z", ""))


def words(text: Column) -> Column:
    """All lower-cased words of a text, in order."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD}+)"), 1)


def keeps_word(word: Column, min_length: int = 3, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Whether a word belongs to a vocabulary: no number, long enough, no stop word.

    The null test stands first and is written out. Otherwise the optimizer infers it
    in some uses of the same rows only, and their equal shuffles are not shared. The
    pattern stands last, and a word that begins with a to z is no number without it.
    """
    keep = word.isNotNull() & (F.length(word) >= min_length)
    if stop_words:
        keep = keep & ~word.isin(*stop_words)
    return keep & ((word >= "a") & (word < "{") | ~word.rlike(rf"^{DIGIT}+\z"))


def vocabulary(text: Column, min_length: int = 3, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Unstemmed vocabulary tokens of one text as an array, order and repeats kept."""
    return F.filter(words(text), lambda word: keeps_word(word, min_length, stop_words))


def joined_text(subject: Column, body: Column) -> Column:
    """``subject + ' ' + body``, an absent side counting as empty."""
    return F.concat(F.coalesce(subject, F.lit("")), F.lit(" "), F.coalesce(body, F.lit("")))


def is_filled(text: Column) -> Column:
    """Neither null nor empty."""
    return text.isNotNull() & (text != "")


def is_not_blank(text: Column) -> Column:
    """Neither null, nor empty, nor white space only."""
    return text.isNotNull() & (strip(text) != "")
