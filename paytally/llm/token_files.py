"""Token ids of a corpus as files of patched frame-of-reference blocks, in id order.

``write`` sorts the documents by range of doc_id; each task encodes its range and writes
files of at most ``ids_per_file`` ids (one document more, if that is larger). What the
files hold is a written table, and the first id of each comes from sums over it.
``digests`` reads the files back by ranges.

Defined results for odd input: a null or empty text has no ids but the end id; a null
doc_id sorts first; documents of equal doc_id are ordered by a hash of the text, so that
many of them are spread over tasks, also where their texts are equal; very long texts are
encoded whole; an empty table gives no files and no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paytally.llm.common import MB, materialised, partitions
from paytally.llm.files import existing_file, new_file
from paytally.llm.frame_of_reference import TokenFile, file_bytes
from paytally.llm.tokenizer import definition, library_encoder

IDS_PER_FILE = 2_000_000
# A task sorts and encodes about this much of the table, as Spark estimates its size.
PART_BYTES = 6 * MB
# Larger tables have larger tasks, which write more files each.
MOST_PARTS = 20_000
# The files are read back in tasks of about this many ids, in at most so many tasks.
READ_IDS = 8_000_000
MOST_READERS = 10_000
# Documents are read back this many ids at a time.
IDS_PER_READ = 1_000_000


def write(
    docs: DataFrame, folder: str, path: str, end_id: int, ids_per_file: int = IDS_PER_FILE
) -> DataFrame:
    """Write the files; return a row ``file, start, ids`` for each.

    A file has the name of the attempt that wrote it; only those of attempts that ended
    well are listed.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(definition(path))
    narrow = docs.select("doc_id", "text")
    parts = min(partitions(narrow, PART_BYTES), MOST_PARTS)
    order = ["doc_id", "text_hash", "row"]
    numbered = narrow.withColumn("text_hash", F.xxhash64("text")).withColumn(
        "row", F.monotonically_increasing_id()
    )
    ordered = numbered.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(shared.value)
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        end = np.array([end_id], np.uint32)
        held, doc_ids, counts, files = [], [], [], []
        total = 0

        def flush() -> None:
            uri = f"{folder}/ids-{part:06d}-{attempt}-{len(files):06d}.pfor"
            with new_file(uri) as out:
                out.write(file_bytes(np.concatenate(held), doc_ids, counts))
            files.append((part, len(files), uri, sum(counts)))
            held.clear(), doc_ids.clear(), counts.clear()

        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for key, ids in zip(keys, encoder.encode(texts), strict=True):
                if counts and total + len(ids) >= ids_per_file:
                    flush()
                    total = 0
                held += [ids, end]
                doc_ids.append(key)
                counts.append(len(ids) + 1)
                total += len(ids) + 1
        if counts:
            flush()
        columns = list(zip(*files, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(columns[0], pa.int64()),
                pa.array(columns[1], pa.int64()),
                pa.array(columns[2], pa.string()),
                pa.array(columns[3], pa.int64()),
            ],
            names=["part", "k", "file", "ids"],
        )

    encoded = ordered.select("doc_id", "text")
    files = materialised(
        encoded.mapInArrow(run, "part long, k long, file string, ids long"), "token_lists"
    )
    return materialised(_with_starts(files), "token_files")


def _with_starts(files: DataFrame) -> DataFrame:
    """``file, start, ids``: sums over the parts (``MOST_PARTS`` at most) and within each."""
    sums = files.groupBy("part").agg(F.sum("ids").alias("part_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.sum("part_ids").over(earlier).alias("base"))
    inside = Window.partitionBy("part").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    start = F.coalesce("base", none) + F.coalesce(F.sum("ids").over(inside), none)
    return files.join(F.broadcast(bases), "part").select("file", start.alias("start"), "ids")


def digests(files: DataFrame) -> DataFrame:
    """Per document ``doc_id, start, n_tokens, ids_crc32``, read from the files."""
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with existing_file(row["file"]) as source:
                    yield from _read(TokenFile(source), row["start"], names)

    held = files.agg(F.count("*").alias("files"), F.sum("ids").alias("ids")).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    wanted = max((held["ids"] or 0) // READ_IDS, min(held["files"], cores), 1)
    return files.repartition(min(wanted, MOST_READERS)).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _read(file: TokenFile, start: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    counts = file.docs["count"].astype(np.int64)
    ends = np.cumsum(counts)
    begins = ends - counts
    crcs = np.zeros(len(counts), np.int64)
    loaded, base = np.zeros(0, np.uint32), 0
    for k, (begin, end) in enumerate(zip(begins.tolist(), ends.tolist(), strict=True)):
        at, crc = begin, 0
        while at < end:
            if at >= base + len(loaded):
                base = at
                loaded = file.ids(at, min(IDS_PER_READ, int(file.foot["ids"]) - at))
            part = loaded[at - base : end - base]
            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
            at += len(part)
        crcs[k] = crc
    keys = pa.array(file.docs["doc_id"].copy(), mask=file.docs["is_null"].astype(bool))
    arrays = [keys, pa.array(start + begins), pa.array(counts), pa.array(crcs)]
    yield pa.RecordBatch.from_arrays(arrays, names=names)
