"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs count on. Everything else is left to the deployer.
SETTINGS = {
    # A day is the calendar day as written; no zone conversion may creep in.
    "spark.sql.session.timeZone": "UTC",
    # Runtime coalescing, skew splitting and join re-planning.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A broken value nulls its own field, not its whole record.
    "spark.sql.json.enablePartialResults": "true",
}


MB = 1 << 20
# A load's largest shuffle was 6 % of its JSON text (measured with short records,
# 370 bytes each; longer ones shuffle a smaller share).
SHUFFLED_SHARE = 0.06


def settings_for(input_bytes: int) -> dict[str, str]:
    """Partition sizes for a load of that much JSON text.

    Scan tasks grow from 128 MB to 1 GB of text before there are more than 200,000
    of them. Shuffles start with partitions of 128 MB, which fit any executor;
    adaptive execution merges those that turn out small.
    """
    split = min(max(128 * MB, input_bytes // 200_000), 1024 * MB)
    partitions = max(200, math.ceil(input_bytes * SHUFFLED_SHARE / (128 * MB)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
    }


def listed_bytes(scan: DataFrame) -> int:
    """Size of the files of a scan, from the listing that Spark made for it."""
    return int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Shuffle in as many partitions as that input needs, and as before afterwards."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    needed = math.ceil(input_bytes * SHUFFLED_SHARE / (128 * MB))
    if needed > int(before):
        spark.conf.set(key, str(needed))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def build_session(
    app_name: str = "paytally", settings: dict[str, str] | None = None, **conf: str
) -> SparkSession:
    """A session with ``SETTINGS`` and more; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="paytally-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nobody has used yet."""
    return f"{shared_dir(spark)}/paytally/{purpose}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object behind ``path`` (metadata calls only)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that this job has written."""
    fs, target = file_system(spark, path)
    fs.delete(target, True)
