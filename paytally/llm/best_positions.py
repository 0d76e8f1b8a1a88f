"""Ranked lexical search by the best position algorithm.

Documents lie in shards of bounded size, each with its own impact lists: for each term
of a query, the documents that hold it, by descending impact. A query reads its lists
in parallel, a growing stretch of each in a round. Each document that is met is scored
at once by direct access to its places in all the query's lists, and these places count
as seen. The best position of a list is the last before which all are seen; it is often
far beyond the last place read. What no one has seen scores at most the sum, over the
lists, of the impacts just behind the best positions. The query stops when that sum lies
strictly below its k-th score, so that ties are all seen.

The k best of each shard are merged by a window, which sends k rows a task and query at
most. Counts of documents and words are taken over all documents first, since impacts
depend on them.

Items are a stated set of queries, searched in blocks of bounded size against all
documents. Defined results for odd input: a null or empty text has no terms and does not
count; a document without an id is ranked before others of equal score and returned
with a null; rows that repeat are ranked each; rows of one item id are one item, also
those without an id; texts are taken whole; other columns are left out, whatever their
names; with an empty table on either side the result is empty.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from paytally.llm.common import materialised
from paytally.llm.terms import BLOCK_CHARS, query_blocks, words

# A shard is closed when it has so many postings (about 40 bytes each).
SHARD_POSTINGS = 2_000_000
# Places read of each list in the first round; a round reads twice those of the last.
FIRST_STRETCH = 32
_NO_ID = np.iinfo(np.int64).min


def _counted(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, counts): words of each document that has any, and the places
    in ``terms`` of those that queries ask for, with their counts."""
    schema = "doc_id long, n long, terms array<int>, counts array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {term: k for k, term in enumerate(terms)}
        asked = place.keys()
        for batch in batches:
            ids, sizes, held, times = [], [], [], []
            for doc, text in zip(*batch.columns, strict=True):
                split = words(text.as_py())
                if not split:
                    continue
                counts = Counter(split)
                found = [t for t in counts if t in asked]
                ids.append(doc.as_py())
                sizes.append(len(split))
                held.append([place[t] for t in found])
                times.append([counts[t] for t in found])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(held, pa.list_(pa.int32())),
                    pa.array(times, pa.list_(pa.int32())),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def weights(frequencies: np.ndarray, documents: int) -> np.ndarray:
    """The weight of each term from the number of documents that hold it."""
    whole = 2 * documents + 2
    found = (math.floor(1000 * math.log(whole / (2 * int(df) + 1))) for df in frequencies)
    return np.fromiter(found, np.int64, len(frequencies))


def impacts(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * (1_000_000_000 * tf // (1000 * tf + 20 * m))


class Shard:
    """Impact lists of some documents, and for each document its places in them."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, impact: np.ndarray, n_terms: int):
        """Postings by document (``starts`` in ``terms`` and ``impact``)."""
        sizes = np.diff(starts)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((-impact, terms))
        self.doc = owner[order]
        self.impact = impact[order]
        self.first = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.starts, self.terms = starts, terms
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.seen = np.zeros(len(order), bool)
        self.scored = np.zeros(len(sizes), bool)
        self.wanted = np.zeros(n_terms, bool)

    def _score(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of ``docs`` by direct access, and the places that were seen so."""
        sizes = self.starts[docs + 1] - self.starts[docs]
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1])) + np.repeat(self.starts[docs] - ends + sizes, sizes)
        at = at[self.wanted[self.terms[at]]]
        places = self.place[at]
        # Each of these documents was met in a list, so each has a place here.
        owner = self.doc[places]
        firsts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        return np.add.reduceat(self.impact[places], firsts), places

    def _next_unseen(self, place: int, end: int) -> int:
        while place < end:
            stretch = self.seen[place : min(place + 1024, end)]
            missing = int(stretch.argmin())
            if not stretch[missing]:
                return place + missing
            place += len(stretch)
        return end

    def best(self, lists: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores, with all of the ``k`` best and their ties among them;
        also the number of places that were read in order."""
        begin, end = self.first[lists], self.first[lists + 1]
        begin, end = begin[end > begin], end[end > begin]
        self.wanted[lists] = True
        unseen = begin.copy()
        pool, scores, touched = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        depth, stretch, read = 0, FIRST_STRETCH, 0
        while True:
            spans = [
                self.doc[b + depth : min(b + depth + stretch, e)]
                for b, e in zip(begin, end, strict=True)
                if b + depth < e
            ]
            if not spans:
                break
            met = np.concatenate(spans)
            read += len(met)
            new = np.unique(met[~self.scored[met]])
            if len(new):
                found, places = self._score(new)
                self.scored[new] = self.seen[places] = True
                pool.append(new)
                scores.append(found)
                touched.append(places)
            open_lists = zip(unseen.tolist(), end.tolist(), strict=True)
            unseen = np.array([self._next_unseen(p, e) for p, e in open_lists], np.int64)
            left = unseen < end
            bound = int(self.impact[unseen[left]].sum())
            if not bound:
                break
            so_far = np.concatenate(scores)
            if len(so_far) >= k and bound < np.partition(so_far, -k)[-k]:
                break
            depth, stretch = depth + stretch, 2 * stretch
        docs, totals = np.concatenate(pool), np.concatenate(scores)
        self.wanted[lists] = False
        self.scored[docs] = False
        for places in touched:
            self.seen[places] = False
        return docs, totals, read


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    held, postings = [], 0
    for batch in batches:
        held.append(batch)
        postings += len(batch.column(2).flatten())
        if postings >= most:
            yield pa.Table.from_batches(held).combine_chunks()
            held, postings = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and values of a column of lists."""
    sizes = pc.list_value_length(column).to_numpy()
    flat = pc.list_flatten(column).to_numpy()
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), flat.astype(np.int64)


def _ranked(
    counted: DataFrame,
    names: list,
    asked: list[np.ndarray],
    weight: np.ndarray,
    totals: tuple[int, int],
    k: int,
    key: T.StructField,
    most: int,
) -> DataFrame:
    """The ``k`` best of each shard for each item: (item_id, doc_id, score)."""
    numbers = [T.StructField(name, T.LongType()) for name in ("doc_id", "score")]
    schema = T.StructType([key, *numbers])
    n_docs, n_words = totals
    key_type = to_arrow_type(key.dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _shards(batches, most):
            ids = pc.fill_null(table.column("doc_id"), int(_NO_ID)).to_numpy()
            missing = pc.is_null(table.column("doc_id")).to_numpy()
            starts, terms = _lists(table.column("terms"))
            _, tf = _lists(table.column("counts"))
            # Exact beyond 64 bits, as the product of words and documents may be.
            m = [50 + 50 * n * n_docs // n_words for n in table.column("n").to_pylist()]
            m = np.repeat(np.array(m, np.int64), np.diff(starts))
            shard = Shard(starts, terms, impacts(weight[terms], tf, m), len(weight))
            for name, lists in zip(names, asked, strict=True):
                docs, scores, _ = shard.best(lists, k)
                docs, scores = docs[scores > 0], scores[scores > 0]
                top = np.lexsort((ids[docs], ~missing[docs], -scores))[:k]
                docs, scores = docs[top], scores[top]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(docs), key_type),
                        pa.array(ids[docs], pa.int64(), mask=missing[docs]),
                        pa.array(scores, pa.int64()),
                    ],
                    names=schema.names,
                )

    return counted.mapInArrow(run, schema)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    block_chars: int = BLOCK_CHARS,
    shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best of ``docs`` for each item."""
    parts = []
    for block in query_blocks(items, most=block_chars):
        terms_of: dict[object, set[bytes]] = {}
        for row in block:
            terms_of.setdefault(row.item_id, set()).update(words(row.text))
        terms = sorted(set().union(*terms_of.values()))
        place = {term: k for k, term in enumerate(terms)}
        asked = [np.array(sorted(place[t] for t in held), np.int64) for held in terms_of.values()]
        counted = materialised(_counted(docs, terms), "counted")
        totals = counted.agg(F.count("*"), F.sum("n")).first()
        df = np.zeros(len(terms), np.int64)
        for term, n in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[term] = n
        weight = weights(df, totals[0])
        parts.append(
            _ranked(
                counted, list(terms_of), asked, weight, tuple(totals), k,
                items.schema["item_id"], shard_postings,
            )
        )
    found = reduce(DataFrame.unionByName, parts)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
