"""The ten operators on small tables: brute force, round trips, and rows that break things."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from repoquarry.llm import best_fit_packing as packing
from repoquarry.llm import components, licence_classifier, ordinal_quality, parity_join, recurrent_lm, repetition_rules
from repoquarry.llm import template_decontamination as templates
from repoquarry.llm import toxic_segments, url_rules, warc_index
from repoquarry.llm.queries import in_fold, tokenizer_path
from repoquarry.session import release

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"long{i * i % 7919}" for i in range(40_000))
EDGES = [
    (1, "Plain words that stand here for a short text.", 9), (2, None, 9), (3, "", None), (4, " \n\t ", 9), (5, LONG, 9), (6, "twin text of some words", 9),
    (6, "twin text of some words", 9), (7, "twin text of some words", 8), (None, "no id but words", 1), (8, "é" * 30 + " \x0b<|endoftext|>  x", 1),
]
# Other columns with names that operators use themselves.
CLASHES = ["id", "key", "key2", "sid", "n", "score", "path", "rule", "__x", "component_id", "sequence_id", "offset", "piece", "label", "grade", "best", "_id", "_text"]


@pytest.fixture(scope="module")
def edges(spark):
    rows = spark.createDataFrame(EDGES, "doc_id long, text string, other long")
    return rows.select("doc_id", "text", *(F.col("other").alias(c) for c in CLASHES))


@pytest.fixture(scope="module")
def empty(edges):
    return edges.limit(0)


def collect(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- 1 ---


def test_templates_catch_other_numbers_and_names(spark):
    items = spark.createDataFrame(
        [(1, "Anna bought 12 apples and gave 5 apples to Bob before Anna walked 3 km home with the rest of them."), (2, "too short"), (3, None),
         (4, "What is the capital city of the old kingdom in the north"), (5, "one two three four five")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "See. Carla bought 7 apples and gave 2 apples to Dan before Carla walked 9 km home with the rest of them. Bye"),
         (2, "nothing of the kind is said here, and nothing is asked"), (3, None), (None, "so, what is THE capital city of the old kingdom in the north"),
         (4, "say one, two. three four five"), (5, ""), (4, "say one, two. three four five"),
         (6, "See. Carla bought 7 apples and Dan gave 5 pears")], "doc_id long, text string")
    found = {(r["id"], r["item_id"]): r for r in templates.contaminated(docs, items).collect()}
    assert set(found) == {(1, 1), (None, 4), (4, 5)}
    assert found[1, 1]["covered_words"] >= 19 and found[1, 1]["slots_changed"] > 0 and found[4, 5]["slots_changed"] == 0
    kept = templates.drop_contaminated(docs.withColumn("key", F.lit(1)).withColumn("id", F.lit(2)), items)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5, 6] and kept.columns == ["doc_id", "text", "key", "id"]


def test_slots_have_to_agree(spark):
    item = "the box of Anna holds 4 red balls and the bag of Anna holds 6 blue balls for the game of Anna"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    steady = item.replace("Anna", "Mary")
    mixed = "the box of Mary holds 4 red balls and the bag of Ruth holds 6 blue balls for the game of Nora"
    docs = spark.createDataFrame([(1, "x " + steady), (2, "x " + mixed)], "doc_id long, text string")
    covered = {r["id"]: r["covered_words"] for r in templates.contaminated(docs, items).collect()}
    assert covered[1] == 22 and covered.get(2, 0) < covered[1]


def test_templates_catch_names_that_begin_sentences_and_arithmetic(spark):
    apples = "Anna has 12 apples. Bob has 5 apples. Carl has 7 apples. How many in all?"
    items = [apples, "Compute 12 + 7 * 3 - 4 / 2", "Add 3 kg 5 kg 9 kg 4 kg 8 kg and round up", "12 + 7 * 3 - 4 / 2 = ?"]
    mia = apples.translate(str.maketrans("1257", "3486"))
    for a, b in (("Anna", "Mia"), ("Bob", "Tom"), ("Carl", "Leo")):
        mia = mia.replace(a, b)
    docs = [
        f"Here it is. {mia} Done.", "so compute 25 + 9 * 6 - 8 / 3 now", "compute 25 - 9 + 6 * 8 / 3 now", "compute 25, 9, 6, 8, 3 now", "Add 2 kg 6 kg 7 kg 1 kg 5 kg and round up!",
        "Add 2 kg 6 kg 7 kg 1 kg 5 kg and cook", "Mia has 3 apples. Tom has 4 pears. Leo sold 6 apples. Who has more in all?", "Add 2 kg 6 kg 7 kg 1 km", " 5 + 6 * 7 - 8 / 9 ",
    ]
    found = templates.contaminated(
        spark.createDataFrame(list(enumerate(docs)), "doc_id int, text string"), spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    )
    got = {(r["id"], r["item_id"]): r for r in found.collect()}
    assert {(0, 0), (1, 1), (4, 2), (8, 3)} <= set(got) and {d for d, _ in got} <= {0, 1, 4, 8}
    assert got[0, 0]["covered_words"] == got[0, 0]["item_words"] == 16 and got[1, 1]["covered_words"] == 6 and got[4, 2]["covered_words"] == 14


def test_literal_windows_against_brute_force(spark):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(draw.choices(words, k=draw.randint(4, 20)))) for i in range(15)]
    docs = [(i, " ".join(draw.choices(words, k=30)) + " " + " ".join(draw.choice(items)[1].split()[draw.randint(0, 8) :])) for i in range(40)]
    expected = set()
    for d, text in docs:
        w = text.split()
        for i, question in items:
            q = question.split()
            n = min(len(q), templates.WINDOW)
            own = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
            cover = {k + j for k in range(len(q) - n + 1) if tuple(q[k : k + n]) in own for j in range(n)}
            if cover and (len(cover) >= templates.MIN_SHARE * len(q) or len(cover) >= templates.MIN_WORDS):
                expected.add((d, i, len(cover)))
    # words like w3 are no numbers, so there are no slots
    found = templates.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["id"], r["item_id"], r["covered_words"]) for r in found.collect()} == expected and expected


# --- 2 ---


def test_rules_on_edges(edges, empty):
    rows = repetition_rules.measure_repetition(edges).collect()
    assert len(rows) == len(EDGES) and not any(r["kept"] for r in rows if r["doc_id"] != 5)
    five = next(r for r in rows if r["doc_id"] == 5)
    assert five["n_words"] == 40_000 and five["kept"] == repetition_rules.keep_unrepetitive(edges).filter("doc_id = 5").count()
    assert repetition_rules.keep_unrepetitive(edges).columns == edges.columns
    assert repetition_rules.measure_repetition(empty).count() == 0 == repetition_rules.keep_unrepetitive(empty).count()


def test_each_length_and_lines_reject_by_themselves(spark):
    new = (f"w{i}" for i in range(10_000))
    some = lambda n: [next(new) for _ in range(n)]

    def text(n, phrase, copies):  # ``copies`` of a phrase between new words, ``n`` words in all
        parts = [phrase + some((n - copies * len(phrase)) // copies) for _ in range(copies)]
        return " ".join(" ".join(p) for p in parts)

    short = "\n".join(f"{' '.join(some(8))}\n{'menu' * 4}" for _ in range(20))
    texts = [text(200, some(5), 7), text(200, some(8), 3), text(200, some(8), 4), text(200, some(10), 2), text(200, some(12), 2), short, text(200, some(5), 4), " ".join(some(200))]
    rows = repetition_rules.measure_repetition(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).orderBy("doc_id").collect()
    rules = repetition_rules.Rules()
    limits = {**{f"dup_{k}gram_chars": share for k, share in rules.windows}, "dup_line_chars": rules.line_chars}
    over = [{c for c, share in limits.items() if r[c] > share * r["word_chars"]} for r in rows]
    assert over == [{"dup_5gram_chars"}, set(), {"dup_5gram_chars", "dup_8gram_chars"}, set(), {"dup_10gram_chars"}, {"dup_line_chars"}, set(), set()]
    assert not any(r["base_failed"] for r in rows) and [r["kept"] for r in rows] == [not x for x in over]
    symbols = spark.createDataFrame([(1, " ".join(f"word{i}%" for i in range(60)))], "doc_id int, text string")
    (row,) = repetition_rules.measure_repetition(symbols).collect()  # symbols are no repetition, but the pipeline rejects them
    assert row["kept"] and row["many_symbols"] and repetition_rules.keep_unrepetitive(symbols).count() == 0


# --- 3 ---


def test_packing_round_trip(spark, edges, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    docs = edges.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    packed = packing.pack_documents(docs, tokenizer_path(), size=256, with_ids=True).cache()
    whole = packing.sequences(packed)
    sequences = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in whole.collect()}
    texts, pieces, used = {r["doc_id"]: r["text"] for r in docs.collect()}, {}, {}
    for r in packed.collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(pieces[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert sum((sequences[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] for r in own), []) == ids
        assert [r["start"] for r in own] == [sum(q["length"] for q in own[:k]) for k in range(len(own))]
        assert all(r["length"] == 256 for r in own[1:])
    for parts in used.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(n for _, n in parts) <= 256
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0
    plain = packing.pack_documents(docs, tokenizer_path(), size=256)
    assert sorted(plain.columns) == sorted(set(packed.columns) - {"ids"})
    assert collect(plain.select("doc_id", "piece", "start", "length", "ids_crc32")) == collect(packed.select("doc_id", "piece", "start", "length", "ids_crc32"))


def test_text_parts_have_the_ids_of_the_text():
    ids = packing._Ids(tokenizer_path())
    texts = ["a\t b  c\n\nd   e\x1f f's don't\r\n x   ", "  lead", "", "\n", " ", "x ", "x  \n", "a\n  b", "a\n b c \n\n d", "a\u3000 b <|endoftext|> c", " é\n\nü ß ", None]
    expected = [np.array(ids.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert ids.of_all(texts) == expected and ids.of_all(texts[::-1]) == expected[::-1]


def test_packer_is_bounded_best_fit():
    draw, packer = random.Random(5), packing.Packer(100, 4)
    free = {}  # brute force: open sequences and their free space
    for _ in range(2000):
        n = draw.randint(1, 100)
        sequence, offset = packer.place(n)
        fits = [s for s, f in free.items() if f >= n]
        if fits:
            assert free[sequence] == min(free[s] for s in fits) and offset == 100 - free[sequence]
        else:
            assert offset == 0 and sequence not in free
            if len(free) >= 4 and n < 100:
                least = min(free.values())
                closed = next(s for s in free if free[s] == least and s not in packer.still_open())
                del free[closed]
            free[sequence] = 100
        free[sequence] -= n
        if not free[sequence]:
            del free[sequence]
        assert packer.still_open() == set(free) and len(free) <= 4


def test_packing_is_dense(spark):
    draw = random.Random(1)
    rows = [(i, 0, int(min(2048, draw.lognormvariate(6, 1)) or 1)) for i in range(30_000)]
    packed = packing.pack_pieces(spark.createDataFrame(rows, "doc_id long, piece long, length long").repartition(20))
    n = packed.select("sequence_id").distinct().count()
    assert n <= 1.01 * sum(r[2] for r in rows) / 2048 + 1
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r["used"] == r["end"] <= 2048 for r in used) and packed.count() == len(rows)


# --- 4 ---


def test_grades(spark, edges, empty):
    draw = random.Random(2)
    tone = {0: "bad awful broken spam", 1: "plain usual common fair", 2: "great fine superb lovely"}
    rows = [(i, " ".join(draw.choices(tone[i % 3].split() + ["the", "of", "and"], k=30)), i % 3) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    grades = docs.select("doc_id", F.when(F.col("doc_id") != 5, F.col("grade")).alias("grade"))
    model = ordinal_quality.fit(docs, grades, 3, ~in_fold("doc_id", 5))
    assert (np.diff(model.thresholds) > 0).all()
    graded = ordinal_quality.grade_documents(docs, model).join(docs, "doc_id").filter(in_fold("doc_id", 5)).collect()
    assert sum(round(r["expected_grade"]) == r["grade"] for r in graded) > 0.95 * len(graded)
    assert all(r["tail"][0] >= r["tail"][1] >= 0 and abs(sum(r["tail"]) - r["expected_grade"]) < 1e-9 for r in graded)
    on_edges = {r["doc_id"]: r for r in ordinal_quality.grade_documents(edges, model).collect()}
    assert on_edges[2]["tail"] == on_edges[3]["tail"] == on_edges[4]["tail"] and on_edges[6]["tail"] == on_edges[7]["tail"]
    even = ordinal_quality.fit(edges, grades.limit(0), 3, F.lit(True))
    assert [round(x, 6) for x in ordinal_quality.grade_documents(edges, even).first()["tail"]] == [round(2 / 3, 6), round(1 / 3, 6)]
    assert ordinal_quality.grade_documents(empty, model).count() == 0


def test_ordinal_fit_is_stationary(monkeypatch):
    """Long steps end where the likelihood, differenced numerically, has no slope in any weight or threshold."""
    draw = np.random.default_rng(0)
    doc, place, value = np.repeat(np.arange(60), 5), draw.integers(0, 12, 300), draw.random(300)
    grade = draw.integers(0, 3, 60)
    monkeypatch.setattr(ordinal_quality, "STEPS", 6000)
    model = ordinal_quality.fit_weights(doc, place, value, grade, 3)

    def objective(weights, thresholds):
        z = np.bincount(doc, weights=weights[place] * value, minlength=60)
        p = ordinal_quality.Model(weights, thresholds).probabilities(z)
        return -np.log(p[np.arange(60), grade]).mean() + ordinal_quality.RIDGE / 2 * (weights**2).sum()

    best = objective(model.weights, model.thresholds)
    for values in (model.weights[:12], model.thresholds):
        for at in range(len(values)):
            values[at] += 1e-5
            high = objective(model.weights, model.thresholds)
            values[at] -= 2e-5
            low = objective(model.weights, model.thresholds)
            values[at] += 1e-5
            assert abs(high - low) / 2e-5 < 2e-3
    monkeypatch.setattr(ordinal_quality, "STEPS", 150)
    short = ordinal_quality.fit_weights(doc, place, value, grade, 3)
    assert best <= objective(short.weights, short.thresholds) < objective(np.zeros(ordinal_quality.SIZE), model.thresholds) + 0.05
    share = np.bincount(grade, minlength=3) / 60
    assert best < -(share * np.log(share)).sum() and not model.weights[12:].any()


# --- 5 ---


def brute_classes(rows, k, percent):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def shingles(text):
        w = WORD.findall((text or "").translate(fold))
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(s), low.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_classes_against_all_pairs(spark, k, percent):
    draw = random.Random(k)
    vocabulary = [f"v{i}" for i in range(300)]
    rows = [(None, "lone words"), (900, None), (901, ""), (902, "one"), (903, "ONE"), (904, "one two"), (905, " ")]
    for g in range(12):
        base = draw.choices(vocabulary, k=draw.choice([4, 12, 40, 90, 300]))
        for c in range(draw.choice([1, 2, 5, 25])):
            text = list(base)
            for _ in range(draw.randint(0, max(1, len(text) // 25))):
                text[draw.randrange(len(text))] = draw.choice(vocabulary)
            rows.append((g * 50 + c, " ".join(text).upper() if c % 3 == 0 else " ".join(text)))
    rows += [rows[10], rows[20]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collect(parity_join.classes(docs, shingle=k, percent=percent)) == brute_classes(rows, k, percent)


def test_chains_and_rounds(spark):
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join(base[: 60 + 2 * (i % 30)])) for i in range(60)]  # each like its neighbours only
    assert collect(parity_join.classes(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=90)) == brute_classes(rows, 3, 90)


def test_a_family_just_under_the_limit(spark):
    """Near copies that are hardly ever linked but share blocks: pairs are formed about once, not once a block."""
    draw = random.Random(9)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for i in range(150):
        text = list(base)
        for at in draw.sample(range(400), draw.choice([5, 6, 7, 8])):
            text[at] = f"n{i}_{at}"
        rows.append((i, " ".join(text)))
    formed = []
    whole = parity_join.compact

    def counted(df):
        out = whole(df)
        if out.columns == ["a", "b"]:
            formed.append((out.count(), out.distinct().count()))
        return out

    parity_join.compact = counted
    try:
        found = collect(parity_join.classes(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=90))
    finally:
        parity_join.compact = whole
    assert found == brute_classes(rows, 3, 90) and len({c for _, _, c in found}) > 1
    assert all(n == m for n, m in formed) and sum(n for n, _ in formed) < 150 * 149


def test_classes_on_edges(edges, empty):
    rows = [(r[0], r[1]) for r in EDGES]
    assert collect(parity_join.classes(edges)) == brute_classes(rows, 5, 80)
    kept = parity_join.keep_one(edges)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 2, 3, 4, 5, 6, 8, None] and kept.columns == edges.columns
    assert parity_join.classes(empty).count() == 0 == parity_join.keep_one(empty).count()


def test_sketch_distance_is_a_lower_bound():
    draw = random.Random(4)
    texts = [" ".join(draw.choices("a b c d e f g h".split(), k=draw.randint(5, 200))) for _ in range(30)]
    sets = parity_join.shingle_sets(pa.array(texts), 2)
    words = parity_join.sketches(sets)
    keys = [set(sets.key[sets.doc == i].tolist()) for i in range(30)]
    for i, j in combinations(range(30), 2):
        assert sum(int(x).bit_count() for x in words[i] ^ words[j]) <= len(keys[i] ^ keys[j])


def test_the_sketch_tells_texts_just_under_the_limit_apart():
    """Of 700 shingles with a similarity of about 0.72, linked at 0.8; 256 bits would be full."""
    base = [f"b{i}" for i in range(704)]
    texts = []
    for c in range(12):
        text = list(base)
        for at in range(c % 6 * 10 + 5 * (c // 6), 660, 60):
            text[at] = f"n{c}_{at}"
        texts.append(" ".join(text))
    sets = parity_join.shingle_sets(pa.array(texts), 5)
    words = parity_join.sketches(sets)
    keys = [set(sets.key[sets.doc == i].tolist()) for i in range(12)]
    for i, j in combinations(range(12), 2):
        shared = len(keys[i] & keys[j])
        if 74 * len(keys[i] | keys[j]) > 100 * shared:
            differ = sum(int(x).bit_count() for x in words[i] ^ words[j])
            assert differ * 180 > 20 * (len(keys[i]) + len(keys[j]))


def test_components(spark):
    draw = random.Random(6)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    found = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: find(x) for x in root if any(x in p and p[0] != p[1] for p in links)}


# --- 6 ---


def test_licences(spark, edges, empty):
    draw = random.Random(8)
    lines = [" ".join(draw.choices("river stone window garden paper music light winter corner bridge".split(), k=12)) + "." for _ in range(400)]
    rows = [(i, "\n".join(draw.choices(lines, k=5))) for i in range(200)]
    said = {500: ("Licensed under the Apache License, Version 2.0.", "Apache"), 501: ("This work is licensed under the GNU General Public License, version 3.", "GPL"),
            502: ("Released under the MIT License.", "MIT"), 503: ("All rights reserved.", "Proprietary"), 504: ("Licensed under the Zephyr License, version 7.1.", "unknown")}
    rows += [(i, f"{lines[0]}\n{text}\n{lines[1]}") for i, (text, _) in said.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = licence_classifier.fit(docs)
    found = licence_classifier.statements(docs, model).join(docs, "doc_id").collect()
    assert {r["doc_id"]: r["family"] for r in found} == {i: family for i, (_, family) in said.items()}
    for r in found:
        assert r["text"].encode()[r["start"] : r["end"]].decode() == said[r["doc_id"]][0] and r["line"] == 1
    assert all(r["confirmed"] for r in found if r["family"] != "unknown")
    assert licence_classifier.statements(edges, model).count() == 0 == licence_classifier.statements(empty, model).count()
    assert licence_classifier.fit(empty).least >= 0.5


def test_licences_inside_long_lines_and_of_unfamiliar_wording(spark):
    draw = random.Random(12)
    lines = [" ".join(draw.choices("river stone window garden paper music light winter corner bridge".split(), k=draw.choice([6, 12, 60]))) + "." for _ in range(400)]
    words = lambda n: " ".join(draw.choices(lines, k=n // 10))
    said = {300: ("Licensed under the Apache License, Version 2.0.", "Apache"), 301: ("Released under the MIT License.", "MIT"), 302: ("All rights reserved.", "Proprietary"),
            303: ("Licensed under the GNU Lesser General Public License, version 2.1.", "LGPL")}
    rows = [(i, "\n".join(draw.choices(lines, k=5))) for i in range(200)] + [(i, f"{words(1500)} {text} {words(1500)}") for i, (text, _) in said.items()]
    odd = "This material is distributed to all; may you use and redistribute it under Hovel."
    rows += [(400, words(3000)), (401, odd)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = licence_classifier.fit(docs.filter("doc_id < 400"))
    found = licence_classifier.statements(docs, model).join(docs, "doc_id").collect()
    assert sorted((r["doc_id"], r["family"]) for r in found) == sorted([*((i, family) for i, (_, family) in said.items()), (401, "unknown")])
    for r in found:
        span = r["text"].encode()[r["start"] : r["end"]].decode()
        assert said.get(r["doc_id"], (odd,))[0] in span and len(span.split()) <= 96 and (r["doc_id"] == 401 or r["confirmed"])
    assert next(r for r in found if r["doc_id"] == 401)["confirmed"] is False


# --- 7 ---


def test_urls_against_brute_force(spark):
    draw = random.Random(9)
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("Example.com", "/de", "block"), ("org", "/fr/", "allow"), ("a.b.org", "", "block"), ("net", "/", "allow"), ("", "/x", "block")]
    hosts = ["example.net", "www.EXAMPLE.net", "net", "planet", "x.example.com", "example.com:80", "b.org", "a.b.org", "z.a.b.org", "", "org."]
    urls = [f"http{draw.choice(['', 's'])}://{draw.choice(hosts)}{draw.choice(['', '/', '/en/1', '/de/x', '/dex', '/fr/', '/fr', '/en'])}{draw.choice(['', '?q=/en/', '#/fr/', '?a://b'])}" for _ in range(200)]
    urls += [None, "", "no scheme/en/", "ftp://net/", "://net/", "http:///en/", "http://" + "a." * 3000 + "net/" + "en/" * 3000]
    expected = []
    for url in urls:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.lower()
        best = max(((len(h) + len(p), len(h), h.lower() + p, v) for h, p, v in rules if h and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)), default=None)
        expected.append((url, host, path, best and best[2], best[3] if best else "allow"))
    pages = spark.createDataFrame([(i, u, 1, 2, 3) for i, u in enumerate(urls)], "page_id long, url string, host long, best long, prefix long")
    known = spark.createDataFrame(rules, "host string, path string, verdict string")
    judged = url_rules.judge_urls(pages, known)
    assert [tuple(r) for r in judged.orderBy("page_id").select("url", "host", "path", "rule", "verdict").collect()] == expected
    assert {"page_id", "best", "prefix"} <= set(judged.columns)
    assert {r["verdict"] for r in url_rules.judge_urls(pages, known.limit(0), default="block").collect()} == {"block"}
    assert url_rules.judge_urls(pages.limit(0), known).count() == 0


# --- 8 ---


def test_lm_gradients():
    draw = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in recurrent_lm.initial(np.ones(recurrent_lm.N_OUT)).items()}
    x, y = (draw.integers(0, recurrent_lm.N_OUT, (5, 3)).astype(np.int32) for _ in range(2))
    begins, h = np.zeros((5, 3), bool), draw.standard_normal((3, recurrent_lm.HIDDEN)) * 0.1
    begins[2, 1] = True
    _, grad, _ = recurrent_lm.gradients(w, x, y, begins, h)
    for k in w:
        i = np.unravel_index(np.abs(grad[k]).argmax(), grad[k].shape)
        losses = []
        for e in (1e-4, -2e-4):
            w[k][i] += e
            losses.append(recurrent_lm.gradients(w, x, y, begins, h)[0])
        w[k][i] += 1e-4
        assert grad[k][i] == pytest.approx((losses[0] - losses[1]) / 2e-4, rel=1e-3)


def test_lm_outputs_are_a_distribution_and_state_is_carried():
    w = recurrent_lm.initial(np.arange(1, recurrent_lm.N_OUT + 1.0))
    h = np.random.default_rng(1).standard_normal((1, recurrent_lm.HIDDEN)).astype(np.float32)
    logs, _ = recurrent_lm.output_log(w, np.repeat(h, recurrent_lm.N_OUT, axis=0), np.arange(recurrent_lm.N_OUT))
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)
    draw = np.random.default_rng(2)
    sizes = [1, 300, 7, 300, 45]
    y = [draw.integers(0, recurrent_lm.N_OUT, n).astype(np.int32) for n in sizes]
    together = recurrent_lm.score_texts(w, np.repeat(np.arange(5), sizes), np.concatenate(y), 5)
    for own, total in zip(y, together):
        state, x, plain = np.zeros((1, recurrent_lm.HIDDEN), np.float32), np.array([recurrent_lm.START]), 0.0
        for token in own:  # one word after the other
            state, *_ = recurrent_lm.step(w, x, state)
            plain += recurrent_lm.output_log(w, state, np.array([token]))[0][0]
            x = np.array([token])
        assert total == pytest.approx(plain, rel=1e-4)


def test_lm_scores(spark, edges, empty, monkeypatch):
    import math
    import zlib
    from collections import Counter

    monkeypatch.setattr(recurrent_lm, "FREQUENT", 20)  # so that most words go through the join
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choices([f"{'ab'[i % 2]}{j}" for j in range(40)], k=80))) for i in range(150)] + [(r[0], r[1]) for r in EDGES if r[0] != 5]
    rows += [(10_000, "a1 NEWWORD a2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("row", F.lit(2))
    found = recurrent_lm.score_documents(docs, in_fold("doc_id", 10)).collect()
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = lambda t: [*WORD.findall((t or "").translate(fold)), None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    base = lambda text: sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens(text))
    expected = sorted((repr(i), held(i), len(tokens(t)), sum(x in c for x in tokens(t)), n, round(base(t), 6)) for i, t in rows)
    assert sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == expected
    assert all(r["score"] < 0 for r in found)
    model, plain = (sum(r[k] for r in found if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 150) for k in ("score", "base_score"))
    assert model > plain  # words of a text are all of one kind, which the state learns
    assert recurrent_lm.score_documents(empty, in_fold("doc_id", 10)).count() == 0
    alone = recurrent_lm.score_documents(docs, F.lit(True)).first()
    assert alone["train_tokens"] == 0 and alone["base_score"] == pytest.approx(0)


# --- 9 ---


def test_warc_round_trip(spark):
    big, small = "<p>" + "x" * 200 + "é</p>", "<p>tiny</p>"
    rows = [(5, "http://a/1", big), (3, "http://a/2", big), (9, None, big), (9, None, big), (1, "http://b/ü\r\nx", small), (2, "u", small), (4, "", None), (6, "u", ""), (None, "n", big), (7, "l", "y" * 500_000), (3, "http://a/2", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("file", F.lit(1)).withColumn("offset", F.lit("x")).repartition(3)
    folder = warc_index.new_folder(spark)
    index = warc_index.write_archives(pages, folder)
    found = warc_index.read_records(index, folder).collect()
    expected = []
    for i, _, html in rows:
        payload = (html or "").encode()
        revisit = i is not None and len(payload) >= 100 and i > 3 and html == big
        expected.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None, None if revisit else payload))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    some = warc_index.read_records(index.filter("page_id IN (7, 1)"), folder).collect()
    assert warc_index.read_records(index, folder).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism  # the index alone is a few kB
    assert sorted(r["page_id"] for r in some) == [1, 7]
    nothing = warc_index.new_folder(spark)
    assert warc_index.read_records(warc_index.write_archives(pages.limit(0), nothing), nothing).count() == 0


def test_reads_are_merged():
    batch = pa.RecordBatch.from_pydict({"file": ["a", "a", "a", "b"], "offset": [0, 10, 10_000_000, 0], "length": [10, 5, 7, 3]})
    assert list(warc_index._reads(iter([batch]))) == [("a", 0, [(0, 10), (10, 5)]), ("a", 10_000_000, [(0, 7)]), ("b", 0, [(0, 3)])]


# --- 10 ---


def brute_segments(scores):
    """Maximal scoring segments by their definition: take the best segment, then go on on both sides of it."""
    best = max(((round(sum(scores[i:j]), 9), -(j - i), -i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    i, j = -best[2], -best[2] - best[1]
    left, right = brute_segments(scores[:i]), brute_segments(scores[j:])
    return left + [(i, j, best[0])] + [(a + j, b + j, s) for a, b, s in right]


def test_segments_against_their_definition():
    draw = random.Random(7)
    for _ in range(300):
        scores = [draw.choice([-3, -2, -1, 1, 2, 3]) + draw.random() / 8 for _ in range(draw.randint(0, 14))]
        found = [(a, b, round(s, 6)) for a, b, s in toxic_segments.maximal_segments(np.array(scores))]
        assert found == [(a, b, round(s, 6)) for a, b, s in brute_segments(scores)]


def test_extreme_value_fit():
    draw = np.random.default_rng(3)
    n = draw.integers(50, 500, 5000)
    best = np.log(0.3 * n) / 1.7 + draw.gumbel(size=5000) / 1.7
    lam, k = toxic_segments.fit_extremes(best, n)
    assert lam == pytest.approx(1.7, rel=0.08) and k == pytest.approx(0.3, rel=0.3)


def test_toxic_documents(spark, edges, empty):
    draw = random.Random(5)
    plain, rude = [f"word{i}" for i in range(300)], ["grobber", "snarkel", "vilefink"]
    rows = []
    for i in range(900):
        text = draw.choices(plain, k=draw.randint(20, 200))
        for _ in range(draw.randint(2, 5) if i % 5 == 1 else 0):
            text.insert(draw.randrange(len(text)), draw.choice(rude) + draw.choice(["", "ish", "!", "ette"]))
        rows.append((i, " ".join(text), int(i % 5 == 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.select("doc_id", F.when(F.col("doc_id") != 4, F.col("toxic")).alias("toxic")).unionByName(docs.limit(3).select("doc_id", "toxic"))
    model = toxic_segments.fit(docs.drop("toxic"), labels, ~in_fold("doc_id", 5))
    scored = toxic_segments.score_documents(docs, model).join(docs, "doc_id").filter(in_fold("doc_id", 5)).collect()
    assert sum((r["score"] >= 0.5) == (r["toxic"] == 1) for r in scored) > 0.97 * len(scored)
    spans = [r["text"].encode()[s["start"] : s["end"]].decode() for r in scored if r["toxic"] for s in r["segments"]]
    assert spans and all(any(x in s for x in rude) for s in spans)
    kept = toxic_segments.drop_toxic(edges, model)
    assert kept.columns == edges.columns and kept.count() == len(EDGES)
    on_edges = {r["doc_id"]: r["score"] for r in toxic_segments.score_documents(edges, model).collect()}
    assert on_edges[2] == on_edges[3] == on_edges[4] and 0 <= on_edges[5] <= 1 and on_edges[6] == on_edges[7]
    assert toxic_segments.score_documents(empty, model).count() == 0
    nothing = toxic_segments.fit(edges, labels.limit(0), F.lit(True))
    assert all(r["score"] < 0.5 for r in toxic_segments.score_documents(edges, nothing).collect())


def test_near_duplicates_give_disk_back(spark):
    """Shuffles of rounds that are over are gone when the rows come back, without waiting for the driver's memory to fill."""
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(40)) for _ in range(60)) for _ in range(40)]
    texts += [text.replace(" ", " x ", 1) for text in texts[:20]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    release(spark)
    shuffles = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    held = shuffles.size()
    kept = parity_join.keep_one(docs)
    assert shuffles.size() - held < 10
    assert sorted(r.doc_id for r in kept.collect()) == list(range(40))
