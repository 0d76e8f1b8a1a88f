"""Passages of test items in documents, by Wu-Manber search over words.

A window is ``length`` consecutive words of an item; an item of fewer words is one
window. The alphabet of the search is words, and a block is three of them (fewer in
windows of fewer). At a place of the document, the block of words that ends there
tells how far the next window's end can be: a block that is in no window lets the
search move on by all but its own length; one that stands in windows, but never at
their end, by its least distance from the end. Where a block does end windows, its
bucket holds them by their first block, and these are compared word by word.

Windows of different lengths have tables of their own, so that one short item does not
shorten the shifts of the others. Items are a stated set of queries: they go to the
tasks in blocks of bounded size, and each block is searched in all documents.

Defined results for odd input: null texts have no words, and an item without a word has
no window. Rows that repeat are searched and reported each. Items of one id count once;
an item without an id counts under the empty text. Texts are taken whole. Other columns
are left out, whatever their names. An empty table of documents gives none; without
items nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytally.llm.common import materialised
from paytally.llm.terms import BLOCK_CHARS, query_blocks, words

BLOCK = 3


class Windows:
    """Shift and bucket tables of all windows of one length."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.block = min(BLOCK, length)
        self.furthest = length - self.block + 1
        # By block: how far to move on, or, where it ends windows, its bucket; that holds
        # (window, its items) by the first block of the window.
        self.table: dict[bytes, int | dict[bytes, list]] = {}

    def add(self, item: int, text: list[bytes]) -> None:
        size, last = self.block, self.length - 1
        blocks = [b" ".join(text[k : k + size]) for k in range(len(text) - size + 1)]
        for end, block in enumerate(blocks, size - 1):
            known = self.table.get(block, self.furthest)
            if end < last:
                if isinstance(known, int):
                    self.table[block] = min(known, last - end)
                continue
            if isinstance(known, int):
                known = self.table[block] = {}
            window = text[end - last : end + 1]
            alike = known.setdefault(blocks[end - last], [])
            for other, items in alike:
                if other == window:
                    items.add(item)
                    break
            else:
                alike.append((window, {item}))

    def search(self, text: list[bytes]) -> Iterator[tuple[int, set[int]]]:
        """(first word, items) for each place where a window stands."""
        get, size, length, furthest = self.table.get, self.block, self.length, self.furthest
        end, n = length, len(text)  # the place behind the window
        while end <= n:
            found = get(b" ".join(text[end - size : end]))
            if found is None:
                end += furthest
                continue
            if found.__class__ is int:
                end += found
                continue
            begin = end - length
            for window, items in found.get(b" ".join(text[begin : begin + size]), ()):
                if text[begin:end] == window:
                    yield begin, items
            end += 1


def windows_of(texts: Iterable[list[bytes]], length: int) -> list[Windows]:
    """Tables by length for the windows of all ``texts``, numbered as they come."""
    tables: dict[int, Windows] = {}
    for item, text in enumerate(texts):
        if text:
            size = min(length, len(text))
            tables.setdefault(size, Windows(size)).add(item, text)
    return list(tables.values())


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places as spans that neither overlap nor touch."""
    joined: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if joined and begin <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(joined[-1][1], end))
        else:
            joined.append((begin, end))
    return joined


def find(text: list[bytes], tables: list[Windows]) -> tuple[list[tuple[int, int]], set[int]]:
    """Spans of hit words, and the items whose windows stand there."""
    spans, found = [], set()
    for table in tables:
        for begin, items in table.search(text):
            if spans and spans[-1][0] <= begin <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(spans[-1][1], begin + table.length))
            else:
                spans.append((begin, begin + table.length))
            found |= items
    return merged(spans), found


_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _searched(state: DataFrame, items: list[tuple[str, str]], length: int) -> DataFrame:
    """``state`` with the spans and items of this block added to those it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = windows_of([words(text) for _, text in items], length)
        for batch in batches:
            counts, spans, names = [], [], []
            *_, texts, _, spans_before, names_before = batch.columns
            for text, old_spans, old_names in zip(texts, spans_before, names_before, strict=True):
                split = words(text.as_py())
                new_spans, hit = find(split, tables)
                old = [(s["begin"], s["end"]) for s in old_spans.as_py()]
                both = merged(old + new_spans) if old else new_spans
                counts.append(len(split))
                spans.append([{"begin": b, "end": e} for b, e in both])
                names.append(sorted({*old_names.as_py(), *(items[k][0] for k in hit)}))
            done = [pa.array(counts, pa.int64()), pa.array(spans, _SPANS)]
            columns = [batch.column(0), texts, *done, pa.array(names, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return state.mapInArrow(run, state.schema)


def overlaps(
    docs: DataFrame, items: DataFrame, length: int = 10, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """``doc_id, n_words, spans, items`` of each row of ``docs`` (doc_id, text).

    ``spans`` are the word ranges (begin, end) inside occurrences of windows of
    ``items`` (item_id, text), apart from each other and in order; ``items`` the ids,
    as text and in order, of the items that occur.
    """
    state = docs.select(
        "doc_id",
        "text",
        F.lit(None).cast("long").alias("n_words"),
        F.array().cast("array<struct<begin: long, end: long>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for k, block in enumerate(query_blocks(items, most=block_chars)):
        if k:
            state = materialised(state, "searched")
        named = [("" if r.item_id is None else str(r.item_id), r.text) for r in block]
        state = _searched(state, named, length)
    return state.drop("text")


def contamination(docs: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """Counts and a digest of ``overlaps`` per row of ``docs``."""
    found = overlaps(docs, items, length)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
