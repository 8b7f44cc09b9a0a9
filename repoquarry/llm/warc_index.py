"""WARC archives written with an index, and read back by coalesced byte ranges.

Every task writes one record for each of its rows into files of its own in a folder
that all executors share, and returns the index first: file, offset, length, url and
digest of each record. The index is a Parquet table; archives are never scanned. A
reader picks rows of the index, which are dealt by stretch of file, sorted, and
merged into few large reads. Records are single gzip members.

A file name holds an id made by the task attempt that wrote it, and only the rows of the
attempt that Spark accepts reach the index, so a lost executor or a second attempt
leaves at most files that nothing refers to.

Of records with equal payloads of at least ``MIN_SHARED`` bytes the one with the
smallest id is a ``response``, the others are a ``revisit`` without a payload. Only
ids and digests are grouped, combined before the shuffle; pages are dealt by id and
digest, so no group of copies meets in one task.

Defined cases: a null html is an empty payload; a null id is always a response, and
never referred to; rows that share both the smallest id and the payload are all responses;
a null url gives a record without a target; an empty table gives an empty index; a very long payload is one
record, written and read alone;
columns other than the three named are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_folder
from .words import slices

MIN_SHARED = 100
MAX_GAP = 64 << 10  # bytes between two records that one read may skip over
MAX_READ = 8 << 20
TASK_BYTES = 4 * MAX_READ  # of archives that one task reads
MAX_FILE = 1 << 30
DATE = "2024-01-01T00:00:00Z"  # part of the record, so that it does not depend on the run
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("file", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
    ]
)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record, uncompressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {DATE}"]
    head.append(f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>")
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers and payload of one uncompressed record; the digest of a response is that of its bytes."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    said = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    number = lambda urn: int(text) if (text := urn[len("<urn:page:") : -1]) else None
    out = {
        "page_id": number(fields["WARC-Record-ID"]),
        "record_type": fields["WARC-Type"],
        "refers_to": number(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None,
        "payload_bytes": int(said["Content-Length"]),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        "payload": None,
    }
    if out["record_type"] == "response":
        if len(payload) != out["payload_bytes"] or hashlib.sha256(payload).hexdigest() != out["payload_digest"]:
            raise ValueError(f"the payload of page {out['page_id']} does not have its digest")
        out["payload"] = payload
    return out


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, html, payload_digest and refers_to (null for a response)."""
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), html.alias("html"), F.sha2(html.cast("binary"), 256).alias("payload_digest")
    )
    narrow = rows.filter((F.octet_length("html") >= MIN_SHARED) & F.col("page_id").isNotNull()).select("page_id", "payload_digest")
    firsts = narrow.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
    later = (
        narrow.join(firsts.filter("refers_to < last").drop("last"), "payload_digest")
        .filter("page_id > refers_to").distinct()
    )
    return rows.join(later, ["page_id", "payload_digest"], "left")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write ``pages`` into archives under ``folder`` and return the index as a table stored there."""
    _, place = _open(folder)
    target = f"{folder}/archives"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(target)
        fs.create_dir(path, recursive=True)
        name, out, at = "", None, 0
        try:
            for batch, first, n in ((b, *part) for b in batches for part in slices(b.column(2))):
                rows = batch.slice(first, n).to_pydict()
                held = {f.name: [] for f in INDEX}
                for page_id, url, html, digest, refers_to in zip(*(rows[c] for c in ("page_id", "url", "html", "payload_digest", "refers_to"))):
                    if out is None or at >= MAX_FILE:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                    raw = record_bytes(page_id, url, html.encode(), digest, refers_to)
                    member = packer.compress(raw) + packer.flush()
                    out.write(member)
                    kind = "response" if refers_to is None else "revisit"
                    for column, value in zip(held.values(), (page_id, url, digest, kind, refers_to, name, at, len(member))):
                        column.append(value)
                    at += len(member)
                yield pa.RecordBatch.from_pydict(held, schema=_ARROW)
        finally:
            if out is not None:
                out.close()

    records = with_revisits(pages, id_col, url_col, html_col).select("page_id", "url", "html", "payload_digest", "refers_to")
    records.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


_ARROW = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
     ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
)


def _reads(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[tuple[int, int]]]]:
    """(file, offset, [(place, length)]): sorted records merged into reads of bounded size and gaps."""
    file, first, end, spans = None, 0, 0, []
    for batch in batches:
        for name, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
            if name != file or offset - end > MAX_GAP or offset + length - first > MAX_READ and spans:
                if spans:
                    yield file, first, spans
                file, first, spans = name, offset, []
            spans.append((offset - first, length))
            end = max(end, offset + length) if len(spans) > 1 else offset + length
    if spans:
        yield file, first, spans


def read_records(index: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records that the rows of ``index`` name: page_id, record_type, refers_to, payload_bytes, payload_digest, payload.

    The payload of a response is checked against its digest; a revisit has none. With
    ``payload=False`` the bytes are read and checked but not returned.
    """
    target = f"{folder}/archives"
    names = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * payload
    kinds = {"page_id": "long", "refers_to": "long", "payload_bytes": "long", "payload": "binary"}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(target)
        opened, source = None, None
        types = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
        for file, first, spans in _reads(batches):
            if file != opened:
                if source is not None:
                    source.close()
                opened, source = file, fs.open_input_file(f"{path}/{file}")
            data = source.read_at(spans[-1][0] + spans[-1][1], first)
            found = [parse_record(gzip.decompress(data[at : at + size])) for at, size in spans]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in found], types.get(c, pa.string())) for c in names], names=names)
        if source is not None:
            source.close()

    places = index.select("file", "offset", "length")
    stored = places.agg(F.sum("length")).first()[0] or 0
    # The index is narrow, so the number of tasks follows the bytes they will read; a number that is given is not changed.
    dealt = places.repartition(max(stored // TASK_BYTES, int(index.sparkSession.sparkContext.defaultParallelism)), "file", F.expr(f"offset div {MAX_READ}"))
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(run, schema)


def new_folder(spark) -> str:
    """A folder of its own for the archives of one run, where all executors can read it."""
    return f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
