"""Identifiers and comments out of source markup (XML trees of program text).

A tree walk has no built-in expression, so documents go through
``mapInPandas`` in Arrow batches; typing, spelling and counting of what it finds
are native columns.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from functools import lru_cache
from xml.parsers import expat
from xml.sax.saxutils import escape, unescape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.naming import name_parts, naming_convention
from ..functions.text import comment_body
from .joins import key_weights, lookup_join
from .leading import first_rows

# Elements that name an identifier and source files that have markup.
KINDS = {"function": "function", "class": "class", "decl": "variable"}
SOURCE_EXTENSIONS = ("c", "cpp", "cxx", "cs", "java")
_IDENTIFIERS = "file_path string, pos int, name string, kind string, scope string"
_COMMENTS = "file_path string, pos int, raw string"
_UNITS = "document string, unit_no int, file_path string, xml string"


@lru_cache(maxsize=1024)
def _local(tag: object) -> str:
    """Name of a tag without its namespace; a language has few tags, so most calls are answered by the cache."""
    return tag.rpartition("}")[2] if isinstance(tag, str) else ""


def _parse(document: str | None) -> ET.Element | None:
    """Root element, or None for an absent, blank or broken document."""
    try:
        return ET.fromstring(document) if document else None
    except (ET.ParseError, ValueError):
        return None


_ATTRIBUTE = {'"': "&quot;", "\r": "&#13;", "\n": "&#10;", "\t": "&#09;"}


def _escaped(text: str) -> str:
    return escape(text) if "&" in text or "<" in text or ">" in text else text


def _xml(element: ET.Element) -> str:
    """Text of an element and its tail, character by character that of ``ET.tostring``, for trees that ``_parse`` makes.

    That one walks a tree twice and calls itself for each element; this is one walk with an explicit stack.
    """
    names: dict[str, str] = {}
    prefixes: dict[str, str] = {}

    def name(tag: str) -> str:
        uri, _, local = tag.rpartition("}")
        if uri:
            uri = uri[1:]
            prefix = prefixes.get(uri) or ET._namespace_map.get(uri) or f"ns{len(prefixes)}"
            if prefix != "xml":
                prefixes[uri] = prefix
            local = f"{prefix}:{local}"
        names[tag] = local
        return local

    parts, stack = [], [element]
    while stack:
        node = stack.pop()
        if isinstance(node, str):  # what follows the children of an element
            parts.append(node)
            continue
        tag = names.get(node.tag) or name(node.tag)
        opening = tag
        for key, value in node.items():
            opening += f' {names.get(key) or name(key)}="{escape(value, _ATTRIBUTE)}"'
        text = _escaped(node.text) if node.text else ""
        tail = _escaped(node.tail) if node.tail else ""
        if len(node):
            parts.append(f"<{opening}>{text}")
            stack.append(f"</{tag}>{tail}")
            stack.extend(reversed(node))
        else:
            parts.append(f"<{opening}>{text}</{tag}>{tail}" if text else f"<{opening} />{tail}")
    text, start = "".join(parts), len(names[element.tag]) + 1
    declared = "".join(f' xmlns:{prefix}="{escape(uri, _ATTRIBUTE)}"' for uri, prefix in sorted(prefixes.items(), key=lambda x: x[1]))
    return text[:start] + declared + text[start:]


def _named(element: ET.Element) -> str:
    for child in element:
        if _local(child.tag) == "name":
            return "".join(child.itertext()).strip()
    return ""


def _identifiers(root: ET.Element) -> Iterator[tuple[str, str, str]]:
    """(name, kind, scope) in document order, with an explicit stack for deep trees.

    Children are read as parameters in a parameter list, as local in blocks of all but classes, else in the scope they are in.
    An element without children has no name and is not visited.
    """
    stack = [(root, "global")]
    while stack:
        element, scope = stack.pop()
        tag = _local(element.tag)
        name = _named(element) if tag in KINDS else ""
        if name:
            kind = "parameter" if (tag, scope) == ("decl", "parameter") else KINDS[tag]
            yield name, kind, "global" if tag == "function" else scope
        inside = "parameter" if tag == "parameter_list" else scope
        opens = tag not in ("parameter_list", "class", "decl")
        for child in reversed(element):
            if len(child):
                stack.append((child, "local" if opens and _local(child.tag) == "block" else inside))


def _comments(root: ET.Element) -> Iterator[str]:
    return ("".join(e.itertext()) for e in root.iter() if _local(e.tag) == "comment")


_PIECE_ROWS = 10_000  # results that a task holds before it passes them on
_PIECE_CHARS = 8 << 20


def _walk(batches: Iterator[pd.DataFrame], find, columns: list[str]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for path, document in zip(batch["file_path"], batch["xml"]):
            root = _parse(document)
            if root is None:
                continue
            for pos, item in enumerate(find(root)):
                found.append((path, pos, *(item if isinstance(item, tuple) else (item,))))
                if len(found) >= _PIECE_ROWS:
                    yield pd.DataFrame(found, columns=columns)
                    found = []
        yield pd.DataFrame(found, columns=columns)


def _units_of(root: ET.Element) -> list[ET.Element]:
    """Child units; a document that is one unit of a named file is its own unit."""
    units = [child for child in root if _local(child.tag) == "unit"]
    return units or ([root] if _local(root.tag) == "unit" and root.get("filename") else [])


def extract_identifiers(documents: DataFrame) -> DataFrame:
    """Identifier rows of (file_path, xml): name, kind, convention, length, n_tokens, scope.

    A document that does not parse gives no row.
    """
    columns = ["file_path", "pos", "name", "kind", "scope"]
    found = documents.select("file_path", "xml").mapInPandas(
        lambda batches: _walk(batches, _identifiers, columns), _IDENTIFIERS
    )
    return with_spelling(found)


def with_spelling(identifiers: DataFrame) -> DataFrame:
    """Add naming convention, length and number of word parts to named rows."""
    return identifiers.withColumns(
        {
            "convention": naming_convention(F.col("name")),
            "length": F.length("name"),
            "n_tokens": F.size(name_parts(F.col("name"))),
        }
    )


def extract_comments(documents: DataFrame) -> DataFrame:
    """Comment rows (file_path, pos, comment_text) of (file_path, xml), markers stripped."""
    columns = ["file_path", "pos", "raw"]
    found = documents.select("file_path", "xml").mapInPandas(
        lambda batches: _walk(batches, _comments, columns), _COMMENTS
    )
    text = comment_body(F.col("raw"))
    return found.select("file_path", "pos", text.alias("comment_text")).where(F.col("comment_text") != "")


def page_comments(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Comments of HTML pages: key, pos, comment_text."""
    raw = F.regexp_extract_all(F.col(html), F.lit("(?s)<!--(.*?)-->"), 1)
    found = pages.select(key, F.posexplode(raw).alias("pos", "raw"))
    return found.select(key, "pos", comment_body(F.col("raw")).alias("comment_text")).where(F.col("comment_text") != "")


def split_units(archives: DataFrame, first: int | None = None) -> DataFrame:
    """Child units of multi-unit documents (document, xml): unit_no, file_path, xml.

    ``first`` keeps the leading units of each document. An archive is parsed by one task; ``read_units`` reads
    archives that are files, of any size, by ranges of bytes.
    """
    columns = ["document", "unit_no", "file_path", "xml"]

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, held = [], 0
            for document, xml in zip(batch["document"], batch["xml"]):
                root = _parse(xml)
                units = [] if root is None else _units_of(root)
                for no, unit in enumerate(units[:first] if first else units):
                    found.append((document, no, unit.get("filename", ""), _xml(unit)))
                    held += len(found[-1][3])
                    if held >= _PIECE_CHARS:
                        yield pd.DataFrame(found, columns=columns)
                        found, held = [], 0
            yield pd.DataFrame(found, columns=columns)

    return archives.select("document", "xml").mapInPandas(split, _UNITS)


_UNIT_START = re.compile(r"(?=<unit[\s/>])")
_OPENING = re.compile(r"<unit((?:\s+[\w:.-]+\s*=\s*(?:\"[^\"]*\"|'[^']*'))*)\s*(/?)>")
_FILENAME = re.compile(r"\sfilename\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")
_PREFIX = re.compile(r"[<\s/]([A-Za-z_][\w.-]*):[A-Za-z_]")
_CLOSING = "</unit>"


def _well_formed(xml: str) -> bool:
    try:
        expat.ParserCreate().Parse(xml, True)
    except expat.ExpatError:
        return False
    return True


def _units_in(record: str, first: bool) -> Iterator[tuple[str, str]]:
    """(file_path, xml) of the whole units in what stands before a closing tag; ``first`` at the beginning of a file."""
    pieces = [piece for piece in _UNIT_START.split(record) if piece.startswith("<unit")]
    for i, piece in enumerate(pieces):
        opening = _OPENING.match(piece)
        if opening is None:
            continue
        alone, last = opening[2] == "/", i == len(pieces) - 1
        if not (alone or last):
            continue  # the root's opening tag, or a unit that was cut off
        xml = opening[0] if alone else piece + _CLOSING
        name = _FILENAME.search(opening[1])
        if first and i == 0 and name is None:
            continue  # a document without units
        # Namespaces may be declared at the root, which another task reads; only local names matter here.
        strange = sorted({q for q in _PREFIX.findall(xml) if f"xmlns:{q}" not in xml} - {"xml", "xmlns"})
        if strange:
            xml = f"<unit {' '.join(f'xmlns:{q}={chr(34)}urn:{q}{chr(34)}' for q in strange)}>{xml}{_CLOSING}"
        if _well_formed(xml):
            yield unescape((name[1] or name[2] or "") if name else "", {"&quot;": '"', "&apos;": "'"}), xml


def read_units(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """Units of archive files of any size: document, unit_no, file_path, xml, as ``split_units`` gives them.

    Files are read in byte ranges as records that end with a closing unit tag, so one archive is many tasks and
    no task holds more than a unit. A unit that is cut off or does not parse is left out alone, as is the text around units.
    ``document`` is the path of the file; a unit gets its number from the units before it in its range and a count of those in
    earlier ranges. Archives must be neither compressed (such files cannot be split) nor hold a closing unit tag inside a comment or a CDATA section.
    """
    records = spark.read.option("lineSep", _CLOSING).text(path)
    placed = records.select(F.col("_metadata.file_path").alias("document"), F.col("_metadata.file_block_start").alias("block"), "value")
    columns = ["document", "block", "place", "file_path", "xml"]

    def units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, place = None, 0
        for batch in batches:
            found, held = [], 0
            for document, block, record in zip(batch["document"], batch["block"], batch["value"]):
                beginning = (document, block) != at
                if beginning:
                    at, place = (document, block), 0
                for file_path, xml in _units_in(record, beginning and block == 0):
                    found.append((document, block, place, file_path, xml))
                    place, held = place + 1, held + len(xml)
                    if held >= _PIECE_CHARS:
                        yield pd.DataFrame(found, columns=columns)
                        found, held = [], 0
            yield pd.DataFrame(found, columns=columns)

    found = placed.mapInPandas(units, "document string, block long, place int, file_path string, xml string")
    sizes = found.groupBy("document", "block").agg(F.count("*").alias("held"))  # a row for each range
    before = Window.partitionBy("document").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("document", "block", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    numbered = found.join(offsets, ["document", "block"]).withColumn("unit_no", (F.col("before") + F.col("place")).cast("int"))
    units_read = numbered.select("document", "unit_no", "file_path", "xml")
    return units_read if first is None else units_read.where(F.col("unit_no") < first)


def function_names(identifiers: DataFrame) -> DataFrame:
    """Functions of each file: how many, and their names one row each in order."""
    functions = identifiers.where(F.col("kind") == "function")
    weights = key_weights(functions, ["file_path"])
    counts = weights.withColumnRenamed("weight", "n_functions")
    rows = functions.select("file_path", "pos", "name")
    return lookup_join(rows, counts, ["file_path"], ["pos"], "inner", weights)


def source_files(files: DataFrame, path: str = "file_path", first: int | None = None) -> DataFrame:
    """Files with markup support, by extension; ``first`` keeps the leading paths."""
    kept = files.where(F.regexp_extract(path, r"\.([^./]+)$", 1).isin(*SOURCE_EXTENSIONS))
    return kept if first is None else first_rows(kept, [path], first)
