"""Quality rules: counts of words, symbols and lines, and suffix-array repetition."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wicketflow.llm.common import append_columns

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
#: Words that are sorted together; a longer text is sorted alone.
CHUNK_WORDS = 400_000


@dataclass(frozen=True)
class RepeatLimits:
    """A text is rejected if repeats of `min_words` words or more cover over `max_covered` of
    its words, or if its longest repeat has over `max_longest` words."""

    min_words: int = 8
    max_covered: float = 0.5
    max_longest: int = 120


LIMITS = RepeatLimits()
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "covered_words", "longest_repeat")
FIELDS = [T.StructField(n, T.LongType()) for n in COUNTS]


def longest_repeats(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position, the length of the longest substring from there that occurs twice.

    `symbols` are several texts in a row that share no symbol; `ends[i]` is the end of the
    text of position i. Suffixes are sorted by prefix doubling, where only suffixes with an
    equal neighbour are sorted again. The common prefixes of neighbours in the suffix array
    are read off the ranks of each doubling. A suffix lies in the prefix intervals of its two
    neighbours, so the larger of both prefixes is its longest repeat; every occurrence of
    every maximal repeat is such a span or lies in one.
    """
    n = len(symbols)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    order = np.argsort(symbols, kind="stable")
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(symbols[order[1:]], symbols[order[:-1]], out=new[1:])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, width = [rank.astype(np.int32)], 1
    while True:
        open_ = ~new
        open_[:-1] |= ~new[1:]
        slots = np.flatnonzero(open_)
        if not len(slots):
            break
        at = order[slots]
        after = np.zeros(len(at), np.int64)
        inside = at + width < ends[at]
        after[inside] = rank[at[inside] + width] + 1
        key = rank[at] * (n + 1) + after
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[slots] = at
        first = np.empty(len(at), bool)
        first[0] = True
        np.not_equal(key[1:], key[:-1], out=first[1:])
        new[slots] = first
        rank[at] = slots[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        levels.append(rank.astype(np.int32))
        width *= 2
    base = levels[0]
    near = np.flatnonzero(base[order[1:]] == base[order[:-1]])
    a, b = order[near], order[near + 1]
    common = np.zeros(len(near), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        i, j = a + common, b + common
        same = np.flatnonzero((i < ends[a]) & (j < ends[b]))
        ranks = levels[level]
        same = same[ranks[i[same]] == ranks[j[same]]]
        common[same] += 1 << level
    longest[a] = common
    longest[b] = np.maximum(longest[b], common)
    return longest


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Whether each of `n` positions lies in one of the spans."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lengths, -1)
    return np.cumsum(step[:-1]) > 0


def word_repeats(texts: list[list[bytes]], min_words: int) -> tuple[np.ndarray, ...]:
    """Per text: words in repeated windows, words in repeats of `min_words`, longest repeat."""
    sizes = np.array([len(w) for w in texts], np.int64)
    n = int(sizes.sum())
    zero = np.zeros(len(texts), np.int64)
    if not n:
        return zero, zero, zero
    ids: defaultdict[bytes, int] = defaultdict(count().__next__)
    flat = np.fromiter((ids[w] for words in texts for w in words), np.int64, n)
    owner = np.repeat(np.arange(len(texts)), sizes)
    longest = longest_repeats(flat + owner * len(ids), np.repeat(np.cumsum(sizes), sizes))
    found = []
    for least, fixed in ((WINDOW, True), (min_words, False)):
        starts = np.flatnonzero(longest >= least)
        spans = np.full(len(starts), WINDOW) if fixed else longest[starts]
        found.append(np.bincount(owner[covered(starts, spans, n)], minlength=len(texts)))
    top = zero.copy()
    np.maximum.at(top, owner, longest)
    return found[0], found[1], np.where(top >= min_words, top, 0)


def measure(texts: list[str | None], min_words: int) -> list[list[int]]:
    """The values of COUNTS for some texts."""
    rows: list[list[int]] = [[] for _ in COUNTS]
    held: list[list[bytes]] = []

    def flush() -> None:
        for column, values in zip(rows[4:], word_repeats(held, min_words), strict=True):
            column.extend(values.tolist())
        held.clear()

    waiting = 0
    for text in texts:
        text = text or ""
        words = text.encode().split()
        if waiting and waiting + len(words) > CHUNK_WORDS:
            flush()
            waiting = 0
        held.append(words)
        waiting += len(words)
        lines = [x for x in text.split("\n") if x.strip(SPACES)]
        rows[0].append(len(words))
        rows[1].append(len(text) - sum(map(text.count, SPACES)))
        rows[2].append(sum(map(text.count, SYMBOLS)))
        rows[3].append(len(lines) - len(set(lines)))
    flush()
    return rows


def quality(df: DataFrame, text: str = "text", limits: RepeatLimits = LIMITS) -> DataFrame:
    """`df` with COUNTS, `base_failed`, `repeat_failed` and `kept`.

    Each row is judged alone, so equal rows get equal verdicts and nothing is shuffled. A
    null or empty text has no words and fails the base rules (fewer than 50 words). Other
    columns, null or not, pass through; none may have the name of a new column. An empty
    table stays empty. A text is always sorted whole, alone if it is long.
    """
    least = limits.min_words
    made = append_columns(df, text, lambda: lambda texts: measure(texts, least), FIELDS)
    n = F.col("n_words")
    base = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    repeat = ((F.col("covered_words") > limits.max_covered * n)
              | (F.col("longest_repeat") > limits.max_longest))
    return (made.withColumn("base_failed", base).withColumn("repeat_failed", repeat)
            .withColumn("kept", ~F.col("base_failed") & ~F.col("repeat_failed")))
