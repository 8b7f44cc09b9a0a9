"""Stored tables that are merged by buckets of their key.

The rows of a key lie in one of a fixed number of buckets, by a hash of the key. A merge reads and writes only the buckets
that its batch falls into; their new files go to a folder of their own, and a manifest, a small table with the
folder of every bucket, makes them the table's. The manifest is written last and under the next number, so a run that is lost midway changes
nothing, readers keep the version they began with, and of two merges at once the second one fails. A manifest that a lost run
began stops later merges until ``remove_unused`` takes it away.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize

BUCKETS = 256
_BUCKET = "keyed_bucket"


class KeyedTable:
    """The table under ``path`` with the columns ``keys`` as its key. ``buckets`` holds for a new table; a stored one keeps its number."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets

    def _children(self, folder: str) -> list[str]:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []

    def _versions(self) -> list[int]:
        return [int(name) for name in self._children("manifest") if "_SUCCESS" in self._children(f"manifest/{name}")]

    def _manifest(self, version: int) -> tuple[dict[int, str], int, StructType | None]:
        """(folder by bucket, number of buckets, schema)."""
        rows = self.spark.read.parquet(f"{self.path}/manifest/{version:010d}").collect()  # a row for each bucket at most
        folders = {r["bucket"]: r["folder"] for r in rows if r["folder"] is not None}
        return folders, rows[0]["buckets"], StructType.fromJson(json.loads(rows[0]["schema"]))

    def _current(self) -> tuple[int, dict[int, str], int, StructType | None]:
        versions = self._versions()
        return (versions[-1], *self._manifest(versions[-1])) if versions else (0, {}, self.buckets, None)

    def _files(self, folders: dict[int, str], schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/data/{folder}/{_BUCKET}={b}" for b, folder in sorted(folders.items())))

    def read(self) -> DataFrame | None:
        """The table as it is now; None before the first merge."""
        _, folders, _, schema = self._current()
        return None if schema is None else self._files(folders, schema) if folders else self.spark.createDataFrame([], schema)

    def merge(self, batch: DataFrame, merged: Callable[[DataFrame | None, DataFrame], DataFrame], materialized: bool = False) -> list[int]:
        """Put ``merged(stored rows, batch)`` in place of the buckets that the batch falls into, and return their numbers.

        ``merged`` gets the stored rows of these buckets alone, or None, and must keep every row in the bucket of its key.
        The batch is read twice; it is materialized for this unless the caller has done so.
        """
        version, folders, n, schema = self._current()

        def bucket() -> Column:  # keys as text, so that an int and a long are one key
            return F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in self.keys)), F.lit(n)).cast("int")

        batch = batch if materialized else materialize(batch)
        touched = sorted(r[0] for r in batch.select(bucket().alias("b")).distinct().collect())
        if not touched and schema is not None:
            return []
        held = {b: folder for b, folder in folders.items() if b in set(touched)}
        rows = merged(self._files(held, schema) if held else None, batch)
        if schema is not None and rows.columns != schema.names:
            raise ValueError(f"columns {rows.columns} instead of {schema.names}")
        if schema is not None:
            rows = rows.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema))
        schema = StructType([*rows.schema]) if schema is None else schema
        folder = uuid.uuid4().hex
        if touched:
            rows.withColumn(_BUCKET, bucket()).repartition(len(touched), _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.path}/data/{folder}")
        written = {int(name.split("=")[1]) for name in self._children(f"data/{folder}") if name.startswith(f"{_BUCKET}=")}
        if not written <= set(touched):
            raise ValueError("the merge made rows of other buckets")
        now = {b: f for b, f in folders.items() if b not in set(touched)} | {b: folder for b in written}
        listed = [(b, f, n, schema.json()) for b, f in sorted(now.items())] or [(None, None, n, schema.json())]
        manifest = self.spark.createDataFrame(listed, "bucket int, folder string, buckets int, schema string").coalesce(1)
        manifest.write.mode("errorifexists").parquet(f"{self.path}/manifest/{version + 1:010d}")
        return touched

    def remove_unused(self, keep: int = 2) -> list[str]:
        """Delete the folders that none of the last ``keep`` versions names, and manifests that were begun and not finished. Not beside a merge."""
        used = {f for v in self._versions()[-keep:] for f in self._manifest(v)[0].values()}
        whole = {f"{v:010d}" for v in self._versions()}
        gone = [f"data/{name}" for name in self._children("data") if name not in used] + [f"manifest/{name}" for name in self._children("manifest") if name not in whole]
        for name in gone:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        return gone
