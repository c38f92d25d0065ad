"""Session settings the operators expect."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

MAX_BROADCAST_ROWS = 10_000
ROWS_PER_PARTITION = 250_000
PARTITION_BYTES = "16m"
SCAN_BYTES = "4m"

# Static and dynamic settings that matter for correctness (time zone) or for
# plans that adapt to the data (adaptive execution, skew handling).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call-site capture makes every Column call several times slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str | int = "*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", f"--driver-memory {memory} pyspark-shell")
    builder = SparkSession.builder.master(f"local[{cores}]").appName("plumbline")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def default_buckets(spark: SparkSession) -> int:
    """Range buckets per ordered column: follow the shuffle width of the cluster."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(8, width)


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Partitions that hold a bounded number of rows each, at least the cluster's shuffle width."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_PARTITION))


@contextmanager
def shuffle_width(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Shuffles of jobs that run inside have this many partitions, merged up to `PARTITION_BYTES` only.

    For aggregates that count map-side, which take no number of partitions of their own. A few
    megabytes of counted rows are some hundreds in memory, so scans are split finely as well:
    a task keeps what it is about to shuffle.
    """
    wanted = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": PARTITION_BYTES,
        "spark.sql.files.maxPartitionBytes": SCAN_BYTES,
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder for a written table that several steps or executors read.

    Clusters name a shared folder in spark.checkpoint.dir. Only a session that runs in
    one process may leave it unset, as in tests; a local temporary folder serves there.
    Files stay until that folder is cleaned.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/plumbline-{uuid.uuid4().hex}/{label}"
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{tempfile.mkdtemp(prefix='plumbline-')}/{label}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table once and read it back.

    Later passes start from columnar files instead of repeating joins and shuffles,
    read only the columns they need, and survive lost executors.
    """
    path = scratch_folder(df.sparkSession, f"{label}.parquet")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_few(staged: DataFrame) -> DataFrame:
    """A staged table, marked for broadcast unless it has over `MAX_BROADCAST_ROWS` rows."""
    few = staged.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS
    return F.broadcast(staged) if few else staged
