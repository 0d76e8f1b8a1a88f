"""Quality rules: a threshold table compiled into one projection of built-in functions.

No user function runs. Defined results for odd input:

- a null or empty text has no words: all counts are 0, it fails the base rule;
- very long texts are counted whole; repeated rows each give a row; an empty table
  gives none;
- further columns of the input pass through, unless they have the name of a measure:
  those are replaced.

Two windows count as equal if the 64-bit hashes of their eight words are: in a text of
a million words two different ones meet with a probability below one in ten million.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from string import ascii_letters

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytally.llm.common import let

WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for was on with be as by this are at from "
    "le la les de des du un une et est que qui en pour dans par sur pas avec au "
    "der die das und zu den von mit sich auf für ist im nicht ein eine dem als "
    "el los las del y se por no con para al su es lo"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= 100 * part / whole <= high``, for texts of ``least_words`` or more.

    With ``only`` (part, whole, share): for texts in which 100 * part / whole is that
    share at least.
    """

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None
    least_words: int = 0
    only: tuple[str, str, int] | None = None

    def fails(self) -> Column:
        part, whole = F.col(self.part), F.greatest(F.col(self.whole), F.lit(1))
        below = 100 * part < self.low * whole if self.low is not None else F.lit(False)
        above = 100 * part > self.high * whole if self.high is not None else F.lit(False)
        fails = (F.col("n_words") >= self.least_words) & (below | above)
        if self.only:
            own, of_all, share = self.only
            fails &= 100 * F.col(own) >= share * F.col(of_all)
        return fails


# A text is rejected if any of these fails. The bounds are wide: a text of running
# prose in any language with spaces passes all of them. One stop word is asked for where
# at least half of the characters are ASCII letters: most languages written so have words
# that look like one of the list, and those in other scripts cannot.
RULES = (
    Rule("short_words", "word_chars", "n_words", low=150),
    Rule("long_words", "word_chars", "n_words", high=1500),
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule(
        "stop_words", "n_stop_words", "one", low=100, least_words=100,
        only=("n_ascii_letters", "word_chars", 50),
    ),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=50),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=90, least_words=50),
    Rule("cut_lines", "n_cut_lines", "n_lines", high=50, least_words=50),
)

MEASURES = (
    "n_words",
    "word_chars",
    "n_ascii_letters",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_bullet_lines",
    "n_cut_lines",
    "n_stop_words",
    "one",
)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window which the text has twice or more."""
    def joined(step: int, hashes: Column) -> Column:
        """Hashes of runs of ``2 * step`` words from those of ``step`` words."""
        runs = F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + step)))
        return let(runs, lambda d: joined(2 * step, d)) if 2 * step < WINDOW else runs

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    every = let(hashes, lambda h: joined(1, h))
    # Runs that begin in the last seven words are shorter than a window.
    windows = F.when(
        F.size(words) >= WINDOW, F.slice(every, F.lit(1), F.size(words) - (WINDOW - 1))
    )

    def covered(places: Column) -> Column:
        # Windows overlap: each one adds what reaches beyond the one before the next.
        steps = F.transform(
            places,
            lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW))),
        )
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def repeated(hashes: Column) -> Column:
        ordered = F.array_sort(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        )

        def places(s: Column) -> Column:
            same = F.transform(
                s,
                lambda e, i: F.when(
                    (e["h"] == F.get(s, i - 1)["h"]) | (e["h"] == F.get(s, i + 1)["h"]), e["p"]
                ),
            )
            return F.array_sort(F.array_compact(same))

        return let(ordered, lambda s: let(places(s), covered))

    return let(
        windows,
        lambda h: F.when(F.size(h) > F.size(F.array_distinct(h)), repeated(h)).otherwise(0),
    )


def _measures(text: Column) -> Column:
    """All measures of a text as one struct."""

    def without(chars: str) -> Column:
        return F.char_length(F.translate(text, chars, ""))

    def of_words(words: Column) -> dict[str, Column]:
        stops = F.array(*map(F.lit, dict.fromkeys(STOP_WORDS)))
        lower = F.transform(words, F.lower)
        return {
            "n_words": F.size(words),
            "n_repeat_words": _repeat_words(words),
            "n_stop_words": F.size(F.array_intersect(lower, stops)),
        }

    def of_lines(lines: Column) -> dict[str, Column]:
        def how_many(pattern: str) -> Column:
            return F.size(F.filter(lines, lambda x: F.rlike(x, F.lit(pattern))))

        return {
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_bullet_lines": how_many(r"^\s*[-*•‣●]"),
            "n_cut_lines": how_many(r"(\.\.\.|…)\s*$"),
        }

    def struct(columns: dict[str, Column]) -> Column:
        return F.struct(*(c.cast("bigint").alias(name) for name, c in columns.items()))

    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(WORD)))
    chars = {
        "word_chars": without(WHITE),
        "n_ascii_letters": F.char_length(text) - without(ascii_letters),
        "n_symbols": F.char_length(text) - without(SYMBOLS),
        "one": F.lit(1),
    }
    return F.struct(
        struct(chars).alias("chars"),
        let(words, lambda w: struct(of_words(w))).alias("words"),
        let(lines, lambda x: struct(of_lines(x))).alias("lines"),
    )


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the measures, ``failed`` (names of rules), ``base_failed``, ``kept``."""
    own = [c for c in docs.columns if c.lower() not in (*MEASURES, "failed", "base_failed", "kept")]
    text = F.coalesce(F.col("text"), F.lit(""))
    measured = docs.select(*(F.col(f"`{c}`") for c in own), let(text, _measures).alias("__m"))
    parts = {
        **dict.fromkeys(("word_chars", "n_ascii_letters", "n_symbols", "one"), "chars"),
        **dict.fromkeys(("n_words", "n_repeat_words", "n_stop_words"), "words"),
        **dict.fromkeys(("n_lines", "n_dup_lines", "n_bullet_lines", "n_cut_lines"), "lines"),
    }
    columns = [F.col(f"__m.{parts[m]}.{m}").alias(m) for m in MEASURES]
    flat = measured.select(*(F.col(f"`{c}`") for c in own), *columns)
    too_repetitive = 100 * F.col("n_repeat_words") > 30 * F.col("n_words")
    failed = F.array_compact(F.array(*(F.when(r.fails(), F.lit(r.name)) for r in rules)))
    verdict = reduce(lambda a, b: a | b, (r.fails() for r in rules), F.lit(False))
    base = (F.col("n_words") < 20) | too_repetitive
    return flat.select(
        *(F.col(f"`{c}`") for c in own),
        *(m for m in MEASURES if m != "one"),
        failed.alias("failed"),
        base.alias("base_failed"),
        (~base & ~verdict).alias("kept"),
    )


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns they had."""
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"), "text")
    return quality(held).where("kept").select("__row.*")
