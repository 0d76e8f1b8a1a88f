"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its ``depth`` nearest pivots, and posted with its
place in the inverted file of each of them. A query opens the files of its ``probes``
nearest pivots; what it finds there is ranked by the footrule distance of the two orders,
and the first ``share`` of all vectors are reranked by the inner product of the originals.

Orders know directions only, but the inner product grows with a vector's length, so the
likeness of two orders (the largest footrule distance less theirs) counts with its square
root times the length.

The index is kept in blocks of ``BLOCK_ROWS`` vectors, dealt by row number, each with
inverted files of its own. A block is searched for ``QUERY_ROWS`` queries at a time, and
gives each query its ``k`` best, so each vector and each query is sent whole to the
blocks it meets and to no file. Crowded regions are divided evenly, as blocks do not
follow directions.

The pivots are a sample of the distinct vectors; their number grows with the square root of
the table, as far as they fit into ``PIVOT_BYTES``.

Defined results for odd input: vectors that are null, empty, zero, of another length
than most, or hold null or non-finite components take no part; equal scores go to the
smaller id (null first), and equal vectors are ranked alike, so none of them is left out
for another; repeated and null ids are separate rows; columns beside ``vec_id`` and
``embedding`` are ignored, whatever their names; an empty table gives no rows; a query is
never its own neighbour.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytally.llm.common import materialised

LEAST_PIVOTS = 256
PIVOT_BYTES = 32 << 20
DEPTH, PROBES, SHARE = 32, 32, 0.25
# At least this many of a block are reranked, if a query meets as many.
LEAST_RERANKED = 512
# Vectors of a block, and queries that are sent there at once.
BLOCK_ROWS, QUERY_ROWS = 65_536, 16_384
# Smaller tables are dealt to fewer tasks than there are cores.
LEAST_BLOCK_ROWS = 2048
FOUND = "query_id long, query_row long, vec_id long, row long, score double"


def usable(embedding: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(
        embedding,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def choose_pivots(vectors: DataFrame, count: int, total: int) -> np.ndarray:
    """``count`` distinct vectors at most, those of the least hashes, as unit vectors.

    Of ``total`` vectors about four times as many as needed are looked at, chosen by
    hash, so equal ones are chosen together and count once.
    """
    hashed = vectors.select("vector", F.xxhash64("vector").alias("h"))
    distinct = hashed.groupBy("h").agg(F.first("vector").alias("vector"))
    rate = 4 * count / max(total, 1)
    drawn = distinct.where(F.pmod("h", F.lit(1 << 40)) < int(rate * (1 << 40)))
    rows = (drawn if rate < 1 else distinct).orderBy("h").limit(count).collect()
    rows = rows or distinct.orderBy("h").limit(count).collect()
    chosen = np.array([row.vector for row in rows], np.float64)
    return chosen / np.linalg.norm(chosen, axis=1, keepdims=True)


def _orders(matrix: np.ndarray, pivots: np.ndarray, depth: int) -> np.ndarray:
    """The ``depth`` nearest pivots of each row, nearest first."""
    near = -(matrix @ pivots.T)
    depth = min(depth, len(pivots))
    first = np.argpartition(near, depth - 1, axis=1)[:, :depth]
    order = np.argsort(np.take_along_axis(near, first, axis=1), axis=1, kind="stable")
    return np.take_along_axis(first, order, axis=1).astype(np.int32)


def _matrix(lists: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of equal lengths as rows."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def with_orders(vectors: DataFrame, pivots: np.ndarray, depth: int) -> DataFrame:
    """``vectors`` (whose ``vector``s have the pivots' length) with their ``pivots`` in order."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = _orders(_matrix(batch.column("vector")), shared.value, depth)
            ends = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
            yield batch.append_column(
                "pivots", pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
            )

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema]
    return vectors.mapInArrow(run, ", ".join([*kinds, "pivots array<int>"]))


class Block:
    """Vectors with the inverted files of their pivots."""

    def __init__(self, vectors: np.ndarray, orders: np.ndarray, pivots: int) -> None:
        self.vectors, self.depth = vectors, orders.shape[1]
        largest = np.abs(vectors).max(axis=1, initial=0).astype(np.float64)
        scaled = vectors / largest[:, None]
        self.lengths = largest * np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
        by_pivot = np.argsort(orders.ravel(), kind="stable")
        self.members, self.places = np.divmod(by_pivot, self.depth)
        self.ends = np.searchsorted(orders.ravel()[by_pivot], np.arange(pivots + 1))

    def likeness(self, opened: np.ndarray) -> np.ndarray:
        """How alike the orders of all vectors are to one that begins with ``opened``.

        A pivot at places i and j of two orders adds depth - max(i, j); with all pivots
        opened, twice the sum is what their footrule distance lacks to the largest one
        (a pivot that one order lacks counts as at its end).
        """
        files = [slice(self.ends[p], self.ends[p + 1]) for p in opened]
        sizes = [f.stop - f.start for f in files]
        places = np.concatenate([self.places[f] for f in files])
        later = np.maximum(places, np.repeat(np.arange(len(files)), sizes))
        members = np.concatenate([self.members[f] for f in files])
        return np.bincount(members, self.depth - later, len(self.vectors))

    def candidates(self, opened: np.ndarray, most: int) -> np.ndarray:
        """The ``most`` first by likeness and length, and those that rank like the last."""
        alike = self.likeness(opened)
        met = np.flatnonzero(alike)
        if len(met) <= most:
            return met
        rank = self.lengths[met] * np.sqrt(alike[met])
        return met[rank >= np.partition(rank, len(rank) - most)[len(rank) - most]]

    def best(self, near: np.ndarray, vector: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` of ``near`` (ascending) with the largest inner products, and these."""
        scores = np.einsum("ij,j->i", self.vectors[near].astype(np.float64), vector)
        if len(near) > k:
            some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
            # Rows ascend by id, so a stable sort leaves ties to the smaller ones.
            some = some[np.argsort(-scores[some], kind="stable")[:k]]
            near, scores = near[some], scores[some]
        return near, scores


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int,
    pivots: int | None = None,
    depth: int = DEPTH,
    probes: int = PROBES,
    share: float = SHARE,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The ``k`` nearest of ``vectors`` (vec_id, embedding) to each row with ``queries``.

    Returns ``query_id, rank, vec_id, score``. Of each block ``share``, ``8 * k`` and
    ``LEAST_RERANKED`` at least are reranked. Orders hold more than ``k`` pivots, each of
    which is a vector that the query meets, so it finds ``k`` where there are as many.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["embedding"].dataType.simpleString()
    # Whole floats are sent as such; all is computed in doubles.
    embedding = F.col("embedding").cast("array<float>" if kind == "array<float>" else "array<double>")
    clean = vectors.where(usable(embedding)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        embedding.alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("is_query"),
    )
    sizes = clean.groupBy(F.size("vector").alias("size")).count()
    usual = sizes.orderBy(F.desc("count"), "size").first()
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, count = usual["size"], usual["count"]
    clean = clean.where(F.size("vector") == size)
    wanted = pivots or min(math.isqrt(count), PIVOT_BYTES // (8 * size))
    chosen = choose_pivots(clean, wanted if pivots else max(LEAST_PIVOTS, wanted, k + 1), count)
    total = len(chosen)
    depth = min(max(depth, k + 1), total)
    wide = min(max(probes, k + 1), depth)
    index = materialised(
        with_orders(clean, chosen, depth).withColumn("row", F.monotonically_increasing_id()),
        "permutations",
    )

    few = min(2 * spark.sparkContext.defaultParallelism, math.ceil(count / LEAST_BLOCK_ROWS))
    blocks = max(math.ceil(count / block_rows), few)
    asked = index.where("is_query").drop("is_query")
    rounds = max(1, math.ceil(asked.count() / query_rows))
    every_round = F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    held = index.drop("is_query").select(
        "*", F.pmod("row", F.lit(blocks)).cast("int").alias("block"), every_round
    )
    asking = asked.select(
        "*", F.pmod(F.xxhash64("row"), F.lit(rounds)).cast("int").alias("round"), every_block
    )

    def search(asking: pa.Table, held: pa.Table) -> pa.Table:
        order = [("vec_id", "ascending"), ("row", "ascending")]
        held = held.take(pc.sort_indices(held, order, null_placement="at_start"))
        ids, rows = held.column("vec_id"), held.column("row").to_numpy()
        asked_ids, asked_rows = asking.column("vec_id"), asking.column("row").to_numpy()
        places, found, scores = [], [], []
        if len(rows) and len(asked_rows):
            block = Block(_matrix(held.column("vector")), _matrix(held.column("pivots")), total)
            most = max(math.ceil(share * len(rows)), 8 * k, LEAST_RERANKED)
            vectors = _matrix(asking.column("vector")).astype(np.float64)
            opened = _matrix(asking.column("pivots"))[:, :wide]
            for place, row in enumerate(asked_rows):
                near = block.candidates(opened[place], most)
                near, products = block.best(near[rows[near] != row], vectors[place], k)
                places.append(np.full(len(near), place))
                found.append(near)
                scores.append(products)
        place = np.concatenate([np.zeros(0, np.int64), *places])
        near = np.concatenate([np.zeros(0, np.int64), *found])
        columns = [
            asked_ids.take(pa.array(place)),
            pa.array(asked_rows[place]),
            ids.take(pa.array(near)),
            pa.array(rows[near]),
            pa.array(np.concatenate([np.zeros(0), *scores])),
        ]
        return pa.table(columns, names=["query_id", "query_row", "vec_id", "row", "score"])

    keys = ["block", "round"]
    found = asking.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(search, FOUND)
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
