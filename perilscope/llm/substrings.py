"""Removal of repeated word passages through difference-cover anchors.

A passage of ``window`` words is removed where it also starts earlier (smaller doc_id, or earlier in the document).

1. Anchors: only places whose number modulo ``PERIOD`` is in ``COVER`` are hashed, each with the next
   window - PERIOD + 1 words. Every difference modulo the period is a difference of two members of the cover, so two
   equal windows, wherever they stand, have a pair of equal anchors at the same distance from their starts.
2. Places whose anchor occurs elsewhere are taken back to their document and extended: each window around them is hashed.
3. The first start of each window hash stays; all other starts are removed.

Both shuffles by hash are combined on the map side: what a task already knows to be repeated goes on as such, and one row per hash
and batch is left to meet the other tasks. So a passage in a third of all documents is a few rows for its reducer.
Reducers stream over sorted rows and hold one row. Whole copies of an earlier text are found first, by checksum, and take no part
in the search. The texts are shuffled once, by doc_id, and that exchange serves all steps.

Defined results: a NULL text has no words; rows without doc_id count as later than all others, in the order of a hash of their
text; rows with one doc_id have the same rank, and windows of the same rank and start don't remove each other. An empty
table gives an empty result. Other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perilscope.llm.wordhash import mixed, slices

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
# A row that travels by hash: its key, the rank of the document and, packed into one number, the kind of the row, whether the
# document lacks an id, its number among rows of the same rank, and a place. Settled rows name a stretch: its length is in the key.
TRAVEL = "key bigint, rank bigint, what bigint"
FOUND = "rank bigint, what bigint, length bigint"
KIND, NO_ID, NUMBER = 61, 60, 32
PLACE = (1 << NUMBER) - 1
DOCUMENT = (1 << KIND) - 1 - PLACE  # the bits of the document
SINGLE, REPEATED, SETTLED = 0, 1, 2
WHOLE = (1 << 31) - 1  # length of a stretch to the end of a text

Batches = Iterator[pa.RecordBatch]


def travelling(key: np.ndarray, rank: np.ndarray, what: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(rank), pa.array(what)], names=["key", "rank", "what"])


def settled_rows(rank: np.ndarray, what: np.ndarray, length: np.ndarray) -> pa.RecordBatch:
    spread = mixed(rank.view(np.uint64) + (what >> NUMBER).view(np.uint64), 5)
    key = (spread & ~np.uint64(PLACE)) | length.astype(np.uint64)
    return travelling(key, rank, what | (SETTLED << KIND))


def found(rank: np.ndarray, what: np.ndarray, length: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rank), pa.array(what), pa.array(length)], names=["rank", "what", "length"])


def numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def stretches(row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of the stretches of consecutive places, for entries in the order of (row, place)."""
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(row)))


def runs_of(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of equal keys, and the run of each row."""
    first = np.ones(len(sorted_keys), dtype=bool)
    first[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return np.flatnonzero(first), np.cumsum(first) - 1


def document_places(part, places: Callable[[int], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and place for the places that ``places`` names for each word count."""
    counts = np.diff(part.bounds)
    chosen = [places(int(n)) for n in counts]
    text = np.repeat(np.arange(len(counts)), [len(c) for c in chosen])
    return text, np.concatenate(chosen) if chosen else np.zeros(0, dtype=np.int64)


def anchors(window: int) -> Callable[[Batches], Batches]:
    length = window - PERIOD + 1

    def places(count: int) -> np.ndarray:
        starts = np.arange(max(count - length + 1, 0))
        return starts[np.isin(starts % PERIOD, COVER)] if count >= window else starts[:0]

    def work(batches: Batches) -> Batches:
        for batch in batches:
            rank, what = numbers(batch, "rank"), numbers(batch, "what")
            for part in slices(batch.column(batch.schema.get_field_index("text"))):
                text, place = document_places(part, places)
                if not len(text):
                    continue
                key, row = part.spans(part.bounds[text] + place, length), text + part.first_row
                order = np.argsort(key, kind="stable")
                starts, run = runs_of(key[order])
                many = np.zeros(len(key), dtype=bool)
                many[order] = np.diff(np.append(starts, len(key)))[run] > 1
                # In the order of the documents, which compresses best.
                one = np.flatnonzero(~many)
                yield travelling(key[one], rank[row[one]], what[row[one]] + place[one])
                # One row tells the other tasks; the places themselves are settled.
                told = order[starts[many[order[starts]]]]
                yield travelling(key[told], rank[row[told]], np.full(len(told), REPEATED << KIND))
                known = np.flatnonzero(many)
                first, runs = stretches(row[known], place[known])
                at = known[first]
                yield settled_rows(rank[row[at]], what[row[at]] + place[at], runs)

    return work


def settled_first(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, tuple[np.ndarray, ...]]:
    """The settled rows of a batch as found, and (key, rank, what) of the others."""
    key, rank, what = (numbers(batch, name) for name in ("key", "rank", "what"))
    settled = what >> KIND == SETTLED
    out = found(rank[settled], what[settled] - (SETTLED << KIND), key[settled] & PLACE)
    return out, (key[~settled], rank[~settled], what[~settled])


def shared_places(batches: Batches) -> Batches:
    """The places of the anchors that occur twice, from rows sorted by key; holds one row between batches."""
    held = None
    for batch in batches:
        out, rows = settled_first(batch)
        yield out
        if held is not None:
            rows = tuple(np.concatenate(pair) for pair in zip(held, rows))
        key, rank, what = rows
        if not len(key):
            continue
        kind = what >> KIND
        starts, run = runs_of(key)
        told = np.zeros(len(starts), dtype=bool)
        told[run[kind == REPEATED]] = True
        shared = (told | (np.diff(np.append(starts, len(key))) > 1))[run]
        out = shared & (kind == SINGLE)
        yield found(rank[out], what[out], np.ones(out.sum(), dtype=np.int64))
        # The held row has been told already if its key is shared: it only has to tell the next batch.
        held = (key[-1:], rank[-1:], np.where(shared[-1:], REPEATED << KIND, what[-1:]))


def windows(window: int) -> Callable[[Batches], Batches]:
    """From texts with their shared anchor places: the first start of each window hash in the batch, and settled repeats."""

    def work(batches: Batches) -> Batches:
        for batch in batches:
            rank, what = numbers(batch, "rank"), numbers(batch, "what")
            marks = Marks(batch)
            for part in slices(batch.column(batch.schema.get_field_index("text"))):
                texts, starts = [], []
                for t, count in enumerate(np.diff(part.bounds).tolist()):
                    near = marks.covered(part.first_row + t, count, before=PERIOD - 1, behind=0)
                    here = np.flatnonzero(near[: max(count - window + 1, 0)])
                    starts.append(here)
                    texts.append(np.full(len(here), t))
                text, place = np.concatenate(texts), np.concatenate(starts)
                if not len(text):
                    continue
                key, row = part.spans(part.bounds[text] + place, window), text + part.first_row
                order = np.lexsort((place, rank[row], what[row] >> NO_ID & 1, key))
                begins, run = runs_of(key[order])
                first = np.zeros(len(key), dtype=np.int64)
                first[order] = order[begins[run]]
                same = (rank[row] == rank[row[first]]) & (what[row] >> NO_ID == what[row[first]] >> NO_ID) & (place == place[first])
                leads = np.sort(order[begins])
                yield travelling(key[leads], rank[row[leads]], what[row[leads]] + place[leads])
                later = np.flatnonzero(~same)
                begin, runs = stretches(row[later], place[later])
                at = later[begin]
                yield settled_rows(rank[row[at]], what[row[at]] + place[at], runs)

    return work


def repeated_starts(batches: Batches) -> Batches:
    """The starts behind the first of their key, from rows sorted by key, lack of an id, rank and place."""
    held = None
    for batch in batches:
        out, rows = settled_first(batch)
        yield out
        if held is not None:
            rows = tuple(np.concatenate(pair) for pair in zip(held, rows))
        key, rank, what = rows
        if not len(key):
            continue
        begins, run = runs_of(key)
        first = begins[run]
        mask = PLACE | (1 << NO_ID)
        later = (rank != rank[first]) | (what & mask != what[first] & mask)
        yield found(rank[later], what[later], np.ones(later.sum(), dtype=np.int64))
        held = (key[first[-1:]], rank[first[-1:]], what[first[-1:]])


class Marks:
    """The stretches of places that a batch lists for each of its rows."""

    def __init__(self, batch: pa.RecordBatch):
        lists = batch.column(batch.schema.get_field_index("places"))
        self.borders = lists.offsets.to_numpy()
        self.first, self.length = (lists.values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))

    def covered(self, row: int, count: int, before: int, behind: int) -> np.ndarray:
        """Which of ``count`` places lie in a stretch, each widened by so many places."""
        some = slice(self.borders[row], self.borders[row + 1])
        edges = np.zeros(count + 1, dtype=np.int64)
        np.add.at(edges, np.clip(self.first[some] - before, 0, count), 1)
        np.add.at(edges, np.clip(self.first[some] + self.length[some] + behind, 0, count), -1)
        return np.cumsum(edges)[:count] > 0


def kept_words(window: int) -> Callable[[Batches], Batches]:
    """From texts with the stretches of removed starts: the words that stay."""

    def work(batches: Batches) -> Batches:
        for batch in batches:
            marks = Marks(batch)
            total, removed, texts = [], [], []
            for part in slices(batch.column(batch.schema.get_field_index("text"))):
                raw = part.data.tobytes()
                for t, count in enumerate(np.diff(part.bounds).tolist()):
                    row, a = part.first_row + t, part.bounds[t]
                    # A copy of a text names a stretch beyond its end; without a whole window nothing goes.
                    gone = marks.covered(row, count, before=0, behind=window - 1) if count >= window else np.zeros(count, bool)
                    stay = a + np.flatnonzero(~gone)
                    words = [raw[s:e] for s, e in zip(part.starts[stay].tolist(), part.ends[stay].tolist())]
                    texts.append(b" ".join(words).decode("utf-8", "replace"))
                    total.append(count)
                    removed.append(count - len(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return work


def with_document(rows: DataFrame, checksum: Column) -> DataFrame:
    """Add ``what``, the bits of the document: rows of one rank are numbered in the order of their checksum."""
    same = Window.partitionBy("rank").orderBy("no_id", checksum)
    number = F.shiftleft(F.row_number().over(same).cast("bigint"), NUMBER)
    return rows.withColumn("what", number + F.shiftleft(F.col("no_id").cast("bigint"), NO_ID))


def copies(docs: DataFrame) -> DataFrame:
    """rank, what: rows whose text is also that of a row of smaller rank."""
    rows = with_document(docs.select("rank", "no_id", F.md5("text").alias("sum")).repartition("rank"), F.col("sum"))
    order = F.struct("no_id", "rank")
    leaders = rows.groupBy("sum").agg(F.min(order).alias("leader"), F.max(order).alias("other")).filter("leader <> other")
    return rows.join(leaders, "sum").filter(order != F.col("leader")).select("rank", "what")


def listed(places: DataFrame) -> DataFrame:
    """_rank, _what, places (first place and length of each stretch): dealt by rank alone, as the texts are."""
    place, document = F.col("what").bitwiseAND(PLACE), F.col("what").bitwiseAND(DOCUMENT)
    rows = places.repartition("rank").select(F.col("rank").alias("_rank"), document.alias("_what"), place.alias("first"), "length")
    return rows.groupBy("_rank", "_what").agg(F.collect_list(F.struct("first", "length")).alias("places"))


def same_document() -> Column:
    """Equal rank and document bits. The bits are no join key: with them, Spark would deal the texts anew by both."""
    return (F.col("rank") == F.col("_rank")) & (F.abs(F.col("what") - F.col("_what")) < 1)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (the words that stay, joined by one space); a row per row of ``docs``."""
    rank = F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text")).alias("rank")
    ranked = docs.select(rank, F.col("doc_id").isNull().alias("no_id"), "text")
    # Every reader takes the same columns, so Spark reuses the exchange.
    texts = with_document(ranked.repartition("rank"), F.md5("text"))
    twins = copies(ranked)
    own = texts.join(twins.toDF("_rank", "_what").repartition("_rank"), same_document(), "left_anti")
    hashed = own.select("rank", "what", "text").mapInArrow(anchors(window), TRAVEL)
    shared = hashed.repartition("key").sortWithinPartitions("key").mapInArrow(shared_places, FOUND)
    near = texts.join(listed(shared), same_document()).select("rank", "what", "text", "places")
    starts = near.mapInArrow(windows(window), TRAVEL).repartition("key")
    no_id, place = F.shiftright("what", NO_ID).bitwiseAND(1), F.col("what").bitwiseAND(PLACE)
    later = starts.sortWithinPartitions("key", no_id, "rank", place).mapInArrow(repeated_starts, FOUND)
    later = later.union(twins.select("rank", "what", F.lit(WHOLE).cast("bigint")))
    marked = texts.join(listed(later), same_document(), "left")
    none = F.array().cast("array<struct<first:bigint,length:bigint>>")
    doc_id = F.when(~F.col("no_id"), F.col("rank")).alias("doc_id")
    rows = marked.select(doc_id, "text", F.coalesce("places", none).alias("places"))
    return rows.mapInArrow(kept_words(window), "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
