"""Language identification by unigrams of pieces, summed over all segmentations.

Each language has a probability for each piece of a fixed public vocabulary. A word is
any sequence of pieces that spells it; the forward algorithm sums over all of them. A
word is a run of letters and the marks that combine with them. A
text's score for a language is the product over its words, and the answer is the
language of the highest posterior under equal priors. Piece probabilities are learned
by expectation maximisation on the words of a bounded sample of labelled documents.

Defined results for odd input: a null text or one without a letter is ``und`` with
score 0; texts are scored whole, words of any length too; equal posteriors go to the
first language in order of name; without labelled documents everything is ``und``;
repeated rows each give a row; an empty table gives none; further columns are ignored.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from unicodedata import category

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paytally.llm.common import materialised, slices
from paytally.llm.folds import held_out, learnable, sample_per_class

# Learned from about this many documents of each language, and from that many of their
# most frequent words that are no longer than LONGEST_LEARNED.
SAMPLE_DOCS = 1000
SAMPLE_WORDS = 40_000
LONGEST_LEARNED = 24
EM_ROUNDS = 2
SMOOTHING = 0.02
START = "▁"
UNDETERMINED = "und"
MOST_KNOWN = 200_000


def read_pieces(path: str) -> list[str]:
    """The pieces of a SentencePiece model without control, unknown and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            piece = model.id_to_piece(i)
            plain = piece.removeprefix(START)
            if piece == piece.lower() and not plain.isdigit():
                pieces.append(piece)
    return pieces


@lru_cache(maxsize=2)
def _letters(last: int = sys.maxunicode) -> re.Pattern:
    """Runs of letters and combining marks up to ``last``, by their general category."""
    spans: list[list[int]] = []
    for code in range(last + 1):
        if category(chr(code))[0] in "LM":
            if spans and spans[-1][1] == code - 1:
                spans[-1][1] = code
            else:
                spans.append([code, code])
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans) + "]+")


def words_of(text: str) -> list[str]:
    """Runs of letters and marks that have a letter, in lower case; for learning as for
    scoring."""
    text = text.lower()
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        runs = _letters().findall(text)
    else:
        return _letters(0xFF).findall(text)  # far quicker, and there are no marks
    return [w for w in runs if w[0].isalpha() or any(map(str.isalpha, w))]


def _steps(words: list[str], place: dict[str, int], unknown: int, longest: int):
    """For words of one length with the start mark: (begin, size, piece of each word).

    The piece is ``unknown`` for a single character that is no piece, and the one after
    it, which has no probability, where the characters are none.
    """
    length, none, get = len(words[0]), unknown + 1, place.get
    for end in range(1, length + 1):
        for begin in range(max(0, end - longest), end):
            default = unknown if end - begin == 1 else none
            ids = [get(w[begin:end], default) for w in words]
            yield begin, end, np.array(ids, np.int64)


def log_probabilities(words: list[str], place: dict, table: np.ndarray) -> np.ndarray:
    """(words, languages): the log of the sum over all segmentations of each word.

    ``table``: (pieces + 2, languages); its last two rows are the unknown character's
    and a row of zeros.
    """
    out = np.zeros((len(words), table.shape[1]))
    longest = max(map(len, place), default=1)
    by_length: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        by_length.setdefault(len(word), []).append(k)
    for length, mine in by_length.items():
        for first in range(0, len(mine), 4096):
            part = mine[first : first + 4096]
            marked = [START + words[k] for k in part]
            # A ring of the last positions is enough, and lets it be rescaled.
            ring = np.zeros((longest + 1, len(part), table.shape[1]))
            ring[0] = 1.0
            scale = np.zeros((len(part), table.shape[1]))
            now = 0
            for begin, end, ids in _steps(marked, place, len(table) - 2, longest):
                if end != now:
                    if now and now % 8 == 0:
                        top = ring[now % len(ring)]
                        scale += np.log(top)
                        ring /= top.copy()
                    now = end
                    ring[end % len(ring)] = 0.0
                ring[end % len(ring)] += ring[begin % len(ring)] * table[ids]
            out[part] = scale + np.log(ring[(length + 1) % len(ring)])
    return out


def expected_counts(
    words: list[str], weights: np.ndarray, place: dict, probabilities: np.ndarray
) -> np.ndarray:
    """How often each piece is expected in the words of one language, by weight."""
    counts = np.zeros(len(probabilities))
    longest = max(map(len, place), default=1)
    by_length: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        by_length.setdefault(len(word), []).append(k)
    for length, mine in by_length.items():
        marked = [START + words[k] for k in mine]
        steps = list(_steps(marked, place, len(probabilities) - 2, longest))
        forward = np.zeros((length + 2, len(mine)))
        backward = np.zeros((length + 2, len(mine)))
        forward[0] = backward[length + 1] = 1.0
        for begin, end, ids in steps:
            forward[end] += forward[begin] * probabilities[ids]
        for begin, end, ids in reversed(steps):
            backward[begin] += backward[end] * probabilities[ids]
        weight = weights[mine] / forward[length + 1]
        for begin, end, ids in steps:
            share = forward[begin] * probabilities[ids] * backward[end] * weight
            counts += np.bincount(ids, share, len(counts))
    return counts


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    place: dict[str, int]
    table: np.ndarray


def _normalised(counts: np.ndarray) -> np.ndarray:
    smooth = counts + SMOOTHING
    smooth[-1] = 0.0
    return smooth / smooth.sum()


def _text_slices(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts of a column, a null as an empty one, some at a time, and where they begin."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for first, last in slices(sizes):
        yield first, [t or "" for t in texts.slice(first, last - first).to_pylist()]


def _word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n): words of ``docs``, counted some texts at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in _text_slices(batch.column(1)):
                langs = batch.column(0).slice(first, len(part)).to_pylist()
                counts: Counter[tuple[str, str]] = Counter()
                for lang, text in zip(langs, part, strict=True):
                    counts.update((lang, w) for w in words_of(text) if len(w) <= LONGEST_LEARNED)
                names, words = zip(*counts, strict=True) if counts else ([], [])
                arrays = [
                    pa.array(names, pa.string()),
                    pa.array(words, pa.string()),
                    pa.array(counts.values(), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "word", "n"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, word string, n long")


def train(docs: DataFrame, pieces: list[str]) -> LanguageModel:
    """Learn from rows whose fold is not held out and whose language is given.

    Word counts and the expected piece counts are summed by Spark; what reaches the
    driver is a number per piece and language.
    """
    spark = docs.sparkSession
    usable = docs.where(learnable() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    chosen = sample_per_class(usable.select("doc_id", "lang", "text"), "lang", SAMPLE_DOCS)
    counted = _word_counts(chosen).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    # Frequent words are few, so each language's are cut off at a count, not sorted.
    held = materialised(counted, "words")
    totals = held.groupBy("lang", "n").agg(F.count("*").alias("words")).collect()
    least: dict[str, int] = {}
    for lang in {r.lang for r in totals}:
        kept, least[lang] = 0, 1
        for r in sorted((r for r in totals if r.lang == lang), key=lambda r: -r.n):
            if kept and kept + r.words > SAMPLE_WORDS:
                least[lang] = r.n + 1
                break
            kept += r.words
    languages = tuple(sorted(least))
    place = {piece: i for i, piece in enumerate(pieces)}
    size = len(pieces) + 2
    table = np.zeros((size, len(languages)))
    if not languages:
        return LanguageModel((), place, table)
    limits = F.create_map(*(F.lit(x) for pair in least.items() for x in pair))
    frequent = held.where(F.col("n") >= limits[F.col("lang")])
    frequent = materialised(frequent.repartition(spark.sparkContext.defaultParallelism), "words")
    table[:] = 1.0 / size
    table[-1] = 0.0
    for _ in range(EM_ROUNDS + 1):
        shared = spark.sparkContext.broadcast((languages, place, table))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, places, now = shared.value  # noqa: B023 - used before the next round
            sums = np.zeros_like(now)
            for batch in batches:
                langs = np.array(batch.column(0).to_pylist())
                words = np.array(batch.column(1).to_pylist(), object)
                n = batch.column(2).to_numpy().astype(float)
                for k, name in enumerate(names):
                    mine = langs == name
                    if mine.any():
                        sums[:, k] += expected_counts(
                            words[mine].tolist(), n[mine], places, now[:, k]
                        )
            piece, lang = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece), pa.array(lang), pa.array(sums[piece, lang])],
                names=["piece", "lang", "n"],
            )

        partial = frequent.select("lang", "word", "n").mapInArrow(
            run, "piece long, lang long, n double"
        )
        sums = partial.groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros_like(table)
        counts[sums["piece"], sums["lang"]] = sums["n"]
        table = np.stack([_normalised(counts[:, k]) for k in range(len(languages))], axis=1)
    return LanguageModel(languages, place, table)


class Scorer:
    """Posteriors of texts; words met before are looked up."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.place: dict[str, int] = {}
        self.logs = np.zeros((0, len(model.languages)))

    def posteriors(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray | None]]:
        for first, last in slices(map(len, texts)):
            own = [words_of(t) for t in texts[first:last]]
            if len(self.place) > MOST_KNOWN:
                self.place, self.logs = {}, self.logs[:0]
            place = self.place
            new = list({w for ws in own for w in ws if w not in place})
            if new:
                logs = log_probabilities(new, self.model.place, self.model.table)
                place.update(zip(new, range(len(place), len(place) + len(new)), strict=True))
                self.logs = np.concatenate([self.logs, logs])
            for k, ws in enumerate(own, first):
                if not ws or not self.model.languages:
                    yield k, None
                    continue
                rows = np.fromiter((place[w] for w in ws), np.int64, len(ws))
                total = self.logs[rows].sum(axis=0)
                odds = np.exp(total - total.max())
                yield k, odds / odds.sum()


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, its posterior."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    frame = docs.select(
        *(F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score"))
    )
    schema = T.StructType([*frame.schema]).add("lang_pred", "string").add("score", "double")
    text = [c.lower() for c in frame.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        names = shared.value.languages
        for batch in batches:
            found, scores = [UNDETERMINED] * batch.num_rows, [0.0] * batch.num_rows
            for first, part in _text_slices(batch.column(text)):
                for k, posterior in scorer.posteriors(part):
                    if posterior is not None:
                        best = int(posterior.argmax())
                        found[first + k], scores[first + k] = names[best], float(posterior[best])
            arrays = [*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return frame.mapInArrow(run, schema)


def languages_of(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of each row, learned from ``docs`` itself."""
    model = train(docs, read_pieces(path))
    narrow = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(narrow, model).drop("text")
