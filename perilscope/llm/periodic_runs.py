"""Stretches of words that repeat with a period, in every text, and texts without the repetition.

Words i and i + q agree along a stretch of period q. The positions i of one stretch form a match interval; a run is a maximal
one of at least max(least - q, q) positions, for the smallest q of its words. Distribution by scale:

1. Each text is exploded into overlapping tiles, per octave P <= q < 2P. A tile lies around a boundary; boundaries are
   ``spacing`` words apart, so every run of the octave matches at one of them at least. A tile reaches one spacing to both
   sides of its boundary and of the words up to 2P later.
2. A tile is solved on its own by two boundary Z-functions: for every q of the octave, how many words from the boundary on,
   and how many before it, agree with those q later. Pairs that can't belong to a run are told by the hash of half a
   spacing; the Z-values of the others come from a binary search over hashes of word spans. Multiples of a period of the
   same words are left out here. All tiles of an Arrow batch are solved together, in numpy; a tile never leaves its task.
3. What a tile sees of a match interval is a fragment, clipped to the tile. Fragments are shuffled by (document, period) and
   stitched where they meet. Their number is in proportion to the words of the runs.
4. Texts with fragments are stored with them, and meet their runs in one join. A text without fragments has no run and never
   moves; it is told by solving its tiles once more where it is read, which costs less than shuffling every text.

The work is n log n for n words whatever they are, memory a few numbers per word of a slice. Equal hashes of 64 bits are taken for
equal words. A run's length doesn't depend on tiles, slices or batches.

Defined results: NULL, empty and blank texts have no words and no run; each row is judged with its own text, also where doc_id
repeats or is NULL; rows that agree in doc_id, source and text share their runs; an empty table gives an empty result. Other
columns go along; those called like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perilscope.llm.text import ROW_KEY, packed, with_row_hash
from perilscope.llm.wordhash import Slice, slices
from perilscope.session import cut_lineage

LEAST_WORDS = 12
PAIRS_AT_ONCE = 1 << 20
ROW = ROW_KEY[:3]
RESULT = ("n_words", "runs", "collapsed")

#: Where the words of a text are taken from: (doc_id, number of words) -> positions, or None for the text as it is.
Order = Callable[[int | None, int], np.ndarray | None]


def as_written(doc_id: int | None, n: int) -> None:
    return None


def needed(q: np.ndarray | int, least: int) -> np.ndarray:
    """Matches in a row that a run of period q has at least."""
    return np.maximum(least - q, q)


def spacing(octave: int, least: int) -> int:
    return int(needed(np.arange(octave, 2 * octave), least).min())


class SmallestFactors:
    """The smallest prime factor of each number, as far as asked for."""

    def __init__(self) -> None:
        self.table = np.arange(2)

    def up_to(self, most: int) -> np.ndarray:
        if len(self.table) <= most:
            table = np.arange(max(most + 1, 2 * len(self.table)))
            for p in range(2, int(len(table) ** 0.5) + 1):
                if table[p] == p:
                    multiples = table[p * p :: p]
                    multiples[multiples == np.arange(p * p, len(table), p)] = p
            self.table = table
        return self.table


FACTORS = SmallestFactors()


def z_values(words: Slice, at: np.ndarray, q: np.ndarray, most: np.ndarray, step: int, back: bool) -> np.ndarray:
    """How many words from ``at`` on (``back``: before it) agree with those q later, ``most`` at most; step: a power of 2 above half of any."""
    agree = np.zeros(len(at), dtype=np.int64)
    while step:
        open_ = np.flatnonzero(agree + step <= most)
        first = at[open_] - agree[open_] - step if back else at[open_] + agree[open_]
        same = words.spans(first, step) == words.spans(first + q[open_], step)
        agree[open_[same]] += step
        step //= 2
    return agree


def is_power(words: Slice, first: np.ndarray, length: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether a stretch of period q also has a period that divides q."""
    found, rest = np.zeros(len(q), dtype=bool), q.copy()
    factors = FACTORS.up_to(int(q.max(initial=1)))
    while (rest > 1).any():
        prime = factors[rest]
        smaller = np.where(rest > 1, q // prime, q)
        size = length - smaller
        found |= (rest > 1) & (words.spans(first, size) == words.spans(first + smaller, size))
        rest = np.where(rest > 1, rest // prime, rest)
    return found


def solve_octave(words: Slice, octave: int, least: int) -> np.ndarray:
    """Fragments of the octave: rows of text number, period, first match, one past the last, positions within the text."""
    sizes = np.diff(words.bounds)
    gap, half = spacing(octave, least), -(-spacing(octave, least) // 2)
    tiles = np.where(sizes >= max(least, 2 * octave), -(-(sizes - octave) // gap), 0)
    text = np.repeat(np.arange(len(sizes)), tiles)
    if not len(text):
        return np.zeros((0, 4), dtype=np.int64)
    local = (np.arange(len(text)) - np.repeat(np.cumsum(tiles) - tiles, tiles)) * gap
    at = words.bounds[text] + local
    total = len(words.hashes)
    prints = words.spans(np.arange(max(total - half + 1, 0)), half)
    padded = np.concatenate([np.zeros(half, np.uint64), prints, np.zeros(half + 2 * octave, np.uint64)])
    later = sliding_window_view(padded, octave)
    found = []
    for low in range(0, len(at), max(PAIRS_AT_ONCE // octave, 1)):
        part = slice(low, low + max(PAIRS_AT_ONCE // octave, 1))
        c = at[part]
        hit = later[c + octave + half] == padded[c + half][:, None]
        hit |= (later[c + octave] == padded[c][:, None]) & (local[part] >= half)[:, None]
        row, column = np.nonzero(hit)
        c, t, q = c[row], text[part][row], octave + column
        start, end = words.bounds[t], words.bounds[t + 1]
        fits = (2 * q <= end - start) & (c + q < end)
        c, t, q, start, end = c[fits], t[fits], q[fits], start[fits], end[fits]
        step = 1 << (gap.bit_length() - 1)
        right = z_values(words, c, q, np.minimum(gap, end - c - q), step, back=False)
        left = z_values(words, c, q, np.minimum(gap, c - start), step, back=True)
        # A fragment is whole, or reaches the next boundary on a side, where another tile goes on.
        kept = (right > 0) & ((left + right >= needed(q, least)) | (right == gap) | (left == gap))
        c, t, q, left, right = c[kept], t[kept], q[kept], left[kept], right[kept]
        plain = ~is_power(words, c - left, left + right + q, q)
        first = words.bounds[t]
        found.append(np.column_stack([t, q, c - left - first, c + right - first])[plain])
    return np.concatenate(found)


def solve(words: Slice, least: int) -> np.ndarray:
    longest, octave, found = int(np.diff(words.bounds).max(initial=0)), 1, [np.zeros((0, 4), dtype=np.int64)]
    while longest >= max(least, 2 * octave):
        found.append(solve_octave(words, octave, least))
        octave *= 2
    return np.concatenate(found)


def arranged(doc_id: int | None, raw: bytes, order: Order) -> list[bytes]:
    """The words of a text in that order; bytes are split at space and \\x09-\\x0D, nothing else."""
    words = raw.split()
    taken = order(doc_id, len(words))
    return words if taken is None else [words[i] for i in taken.tolist()]


def solving(least: int, order: Order, finish: bool):
    """A function on (doc_id, text): pieces, an array of period, first and past (match) as the tiles see them; n_words; and, to
    ``finish`` texts without pieces, collapsed."""

    def work(ids: pa.Array, texts: pa.Array) -> pa.Array:
        known, found = ids.to_pylist(), [np.zeros((0, 4), dtype=np.int64)]
        sizes, collapsed = [np.zeros(0, dtype=np.int64)], []
        for words in slices(texts):
            hashes = words.hashes.copy()
            for t, (a, b) in enumerate(zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist())):
                taken = order(known[words.first_row + t], b - a)
                if taken is not None:
                    hashes[a:b] = words.hashes[a + taken]
            part = solve(replace(words, hashes=hashes), least)
            if finish:
                repeats = set(part[:, 0].tolist())
                for t, (a, b) in enumerate(zip(words.borders[:-1].tolist(), words.borders[1:].tolist())):
                    whole = None if t in repeats else b" ".join(arranged(known[words.first_row + t], words.data[a:b].tobytes(), order))
                    collapsed.append(whole)
            part[:, 0] += words.first_row
            found.append(part)
            sizes.append(np.diff(words.bounds))
        rows = np.concatenate(found)
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        borders = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
        pieces = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in (1, 2, 3)], names=["period", "first", "past"])
        listed = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pieces)
        texts_left = pa.array(collapsed, pa.binary()).cast(pa.string()) if finish else pa.nulls(len(texts), pa.string())
        return pa.StructArray.from_arrays([listed, pa.array(np.concatenate(sizes)), texts_left], names=["pieces", "n_words", "collapsed"])

    kind = "struct<pieces:array<struct<period:bigint,first:bigint,past:bigint>>,n_words:bigint,collapsed:string>"
    # Not to be evaluated again for a filter on its result.
    return F.arrow_udf(work, kind).asNondeterministic()


def stitched(pieces: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """The row's key, start, length, period of each run: fragments that overlap or touch are one match interval."""
    group = [*ROW, "period"]
    along = Window.partitionBy(*group).orderBy("first", "past")
    reached = F.max("past").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("first") > F.col("_reached"), F.lit(True)).cast("bigint")
    marked = pieces.distinct().withColumn("_reached", reached)  # rows that repeat send their fragments once per task
    numbered = marked.withColumn("_interval", F.sum(opens).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy(*group, "_interval").agg(F.min("first").alias("start"), F.max("past").alias("_past"))
    matches = F.col("_past") - F.col("start")
    long_enough = matches >= F.greatest(F.lit(least) - F.col("period"), F.col("period"))
    return whole.filter(long_enough).select(*ROW, "start", (matches + F.col("period")).alias("length"), "period")


def collapsing(order: Order):
    """A function on (doc_id, text, starts, lengths, periods): the words outside of repetitions, joined by one space."""

    def keep(doc_id: int | None, text: bytes, starts, lengths, periods) -> str:
        words = arranged(doc_id, text, order)
        if starts is not None:
            change = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(change, starts + periods, 1)
            np.add.at(change, starts + lengths, -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
        return b" ".join(words).decode()

    def work(ids: pd.Series, texts: pd.Series, starts: pd.Series, lengths: pd.Series, periods: pd.Series) -> pd.Series:
        known = [None if missing else int(i) for i, missing in zip(ids, ids.isna())]
        return pd.Series([keep(*row) for row in zip(known, texts, starts, lengths, periods)], dtype=object)

    return F.pandas_udf(work, "string")


def collapse_runs(docs: DataFrame, least: int = LEAST_WORDS, order: Order = as_written) -> DataFrame:
    """Every row of ``docs``, all columns, with n_words, runs (start, length, period; by start, then period; never NULL) and collapsed.

    collapsed: the words joined by one space, without those that some run holds after its first period.
    """
    rows = with_row_hash(packed(docs.drop(*RESULT))).drop("source").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    repeats = F.size("_solved.pieces") > 0
    first = rows.withColumn("_solved", solving(least, order, finish=False)("doc_id", "text")).filter(repeats)
    marked = cut_lineage(first.select("doc_id", "_doc", *ROW, "_solved.pieces", "_solved.n_words"))
    pieces = marked.select(*ROW, F.explode("pieces").alias("_piece")).select(*ROW, "_piece.*")
    found = stitched(pieces, least).groupBy(*ROW)
    listed = found.agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("_runs"))
    parts = [F.col(f"_runs.{name}") for name in ("start", "length", "period")]
    shorter = collapsing(order)(F.col("doc_id"), F.col("_doc.text").cast("binary"), *parts).alias("collapsed")
    none = F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>")
    repeating = marked.drop("pieces").join(listed.hint("merge"), ROW, "left")
    repeating = repeating.select("_doc", "n_words", F.coalesce("_runs", none).alias("runs"), shorter)
    plain = rows.withColumn("_solved", solving(least, order, finish=True)("doc_id", "text")).filter(~repeats)
    plain = plain.select("_doc", "_solved.n_words", none.alias("runs"), "_solved.collapsed")
    return plain.unionByName(repeating).select("_doc.*", *RESULT)
