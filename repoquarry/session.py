"""Session settings and the two ways this library cuts lineage or broadcasts."""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# A dimension is broadcast only after its rows were counted and found below this.
BROADCAST_ROWS = 200_000


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("repoquarry")
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Where it is unset, a session on one machine gets a temporary folder; a cluster has
    to name one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="repoquarry-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return re.sub(r"^file:/+", "file:///", folder).rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the cluster names in ``spark.checkpoint.dir``.

    Used where a plan must not be evaluated twice: row numbers over a sorted
    table, inputs of iterative fits, and results whose size is then checked.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows as Parquet in the same folder: narrower than a checkpoint, and read by column.

    Used for rows of the size of the tokens that several passes read.
    """
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete what ``stored`` wrote; nothing may read it any more."""
    context = table.sparkSession.sparkContext
    for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
        if folder.rpartition("/")[2].startswith("stored-"):
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffles and checkpoints that nothing refers to any more.

    Its cleaner learns of them when the driver collects garbage, which depends on the driver's memory
    and not on the disk they take. To be called after a step whose result is materialized. What the last
    step has left may take a few times to be found.
    """
    for _ in range(4):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.1)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Hint a broadcast when a count proves at most ``max_rows`` rows.

    ``df`` should be materialized or a plain scan, since the check is an action.
    """
    small = df.limit(max_rows + 1).count() <= max_rows
    return (F.broadcast(df) if small else df), small
