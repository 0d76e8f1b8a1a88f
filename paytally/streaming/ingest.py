"""Each landed file is loaded once and then archived.

The stream is one of file names and sizes; a micro-batch is all files that have landed.
Their texts are read by the loads, and these take whole days: the first load of a day
wins, so a day that came in two would lose counts. A backlog is loaded in steps of
bounded size, each of which stages and shuffles no more than its own files.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from paytally.plans import load_payments
from paytally.session import drop_path, file_system, sized_for
from paytally.sinks import JdbcTarget, Warehouse
from paytally.sources import scan_payments

# Longer than any file's age, so that a file moved in with its old time is loaded too.
MAX_FILE_AGE = "365000d"
# A step takes further days as long as their files stay below this size.
STEP_BYTES = 1 << 40
_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_DAY = re.compile(r"(\d{4})_(\d{2})_(\d{2})")
_LEFT_BY_WRITERS = re.compile(r"_SUCCESS|\..*\.crc")


def day_of(path: str) -> str:
    """The day in a file's name, or in that of its folder; empty if there is none."""
    found = _DAY.findall(path)
    return "-".join(found[-1]) if found else ""


def steps(files: Iterable[tuple[str, int]], most: int) -> Iterator[dict[str, list]]:
    """(path, bytes) of ``files`` by day, in steps of whole days of about ``most`` bytes.

    Files without a day in their name cannot be told apart and count as one day.
    """
    by_day: dict[str, list] = {}
    for path, size in files:
        by_day.setdefault(day_of(path), []).append((path, size))
    step: dict[str, list] = {}
    held = 0
    for day in sorted(by_day):
        size = sum(size for _, size in by_day[day])
        if step and held + size > most:
            yield step
            step, held = {}, 0
        step[day] = by_day[day]
        held += size
    if step:
        yield step


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = file_system(spark, path)
    return [e.getPath().getName() for e in fs.listStatus(folder)] if fs.exists(folder) else []


def _literal(path: str) -> str:
    """``path`` as a pattern that only it matches."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", path)


class _Journal:
    """What a checkpoint notes beside Spark's own files: the days of a batch that have
    been loaded, and the files of a batch, to be archived when it has been committed."""

    def __init__(self, spark: SparkSession, checkpoint: str) -> None:
        self.spark = spark
        self.root = checkpoint.rstrip("/")

    def loaded(self, batch: int) -> set[str]:
        return {name.removeprefix("day-") for name in _names(self.spark, f"{self.root}/loaded/{batch}")}

    def note_loaded(self, batch: int, days: Iterable[str]) -> None:
        for day in days:
            fs, mark = file_system(self.spark, f"{self.root}/loaded/{batch}/day-{day}")
            fs.create(mark, True).close()

    def note_files(self, batch: int, files: DataFrame) -> None:
        files.select("path").write.mode("overwrite").text(f"{self.root}/files/{batch}")

    def committed(self) -> list[tuple[int, list[str]]]:
        """Batches that Spark has committed, with files that are still to be archived."""
        done = set(_names(self.spark, f"{self.root}/commits"))
        noted = [name for name in _names(self.spark, f"{self.root}/files") if name in done]
        found = []
        for name in sorted(noted, key=int):
            rows = self.spark.read.text(f"{self.root}/files/{name}").collect()
            found.append((int(name), [row.value for row in rows]))
        return found

    def forget(self, batch: int) -> None:
        for kind in ("loaded", "files"):
            drop_path(self.spark, f"{self.root}/{kind}/{batch}")


def _archive(spark: SparkSession, landing: str, archive: str, journal: _Journal) -> None:
    """Move the files of committed batches. What has been moved already is passed over."""
    fs, root = file_system(spark, landing)
    prefix = fs.makeQualified(root).toString().rstrip("/")
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    goal = file_system(spark, archive)[1].toString().rstrip("/")

    for batch, files in journal.committed():

        def move(file: str, batch: int = batch) -> None:
            source = path_of(file)
            if not fs.exists(source):
                return
            target = path_of(f"{goal}{file.removeprefix(prefix)}")
            if fs.exists(target):  # an earlier file of that name stays
                target = path_of(f"{target.toString()}.{batch}")
            fs.mkdirs(target.getParent())
            if not fs.rename(source, target):
                raise OSError(f"{file} could not be moved to {target.toString()}")

        with ThreadPoolExecutor(max_workers=16) as pool:
            list(pool.map(move, files))
        folders = {file.rpartition("/")[0] for file in files} - {prefix}
        for folder in sorted(folders, key=len, reverse=True):
            left = _names(spark, folder)
            if all(_LEFT_BY_WRITERS.fullmatch(name) for name in left):
                fs.delete(path_of(folder), True)
        journal.forget(batch)


def ingest_available(
    spark: SparkSession,
    landing: str,
    archive: str,
    checkpoint: str,
    warehouse: Warehouse | JdbcTarget,
    step_bytes: int = STEP_BYTES,
) -> list[dict[str, int]]:
    """Load all files that landed since the last run; return rows written per step.

    The checkpoint remembers which files are done. Files are moved to ``archive`` when
    their batch has been committed, or at the start of the next run if this one dies
    before. A batch that is replayed after a failure passes over the days that it had
    loaded; of the day that it was at, nothing is written twice, as loads skip stored keys.

    A file counts by its path: another one of the same name is not loaded. The first
    load of a day wins: land a day's payments together, the day in the files' names.
    """
    loaded = []
    journal = _Journal(warehouse.spark, checkpoint)
    _archive(warehouse.spark, landing, archive, journal)

    def load(batch: DataFrame, batch_id: int) -> None:
        # Names and sizes only, as many as the stream's own list of files has.
        files = batch.persist()
        try:
            journal.note_files(batch_id, files)
            found = [(row.path, row.length) for row in files.collect()]
        finally:
            files.unpersist()
        done = journal.loaded(batch_id)
        left = (file for file in found if day_of(file[0]) not in done)
        for step in steps(left, step_bytes):
            parts = [file for day in step.values() for file in day]
            with sized_for(warehouse.spark, sum(size for _, size in parts)):
                payments = scan_payments(warehouse.spark, [_literal(path) for path, _ in parts])
                loaded.append(load_payments(payments, warehouse))
            journal.note_loaded(batch_id, step)

    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("recursiveFileLookup", "true")
        # By default a file a week older than the newest one would never be read.
        .option("maxFileAge", MAX_FILE_AGE)
        .load(landing)
        .select("path", "length")  # contents are not read
    )
    query = (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    _archive(warehouse.spark, landing, archive, journal)
    return loaded
