import random

from pyspark.sql import functions as F

from perilscope.llm import substrings
from tests.llm.conftest import ODD_TEXTS, prose, rows_of


def brute(rows, window=20):
    """Per row (doc_id, words, removed, kept text): window starts behind the first start of the same words go."""
    last = (1 << 63) - 1
    split = [((last if i is None else i), (text or "").encode().split()) for i, text in rows]
    first = {}
    for rank, words in split:
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            first[key] = min(first.get(key, (rank, s)), (rank, s))
    found = []
    for (i, _), (rank, words) in zip(rows, split):
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] != (rank, s):
                gone.update(range(s, s + window))
        found.append((i, len(words), len(gone), b" ".join(w for n, w in enumerate(words) if n not in gone).decode()))
    return found


def key(row):
    return (row[0] is not None, row[0] or 0, *row[1:])


def check(spark, rows, window=20):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = [tuple(r) for r in substrings.remove_repeats(docs, window).collect()]
    assert sorted(found, key=key) == sorted(brute(rows, window), key=key)


def test_cover_has_every_difference():
    differences = {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER}
    assert differences == set(range(substrings.PERIOD))


def test_every_shift_of_a_passage_is_found(spark):
    passage = prose(0, 20)
    rows = [(n, prose(1000 * (n + 1), n) + " " + passage + " " + prose(1000 * (n + 1) + 500, 7)) for n in range(30)]
    rows.append((40, passage + " " + prose(90_000, 3) + " " + passage))
    check(spark, rows)


def test_random_texts_match_brute_force(spark):
    rng = random.Random(3)
    pool = [prose(100 * n, rng.randint(15, 60)) for n in range(12)]
    rows = [(n, " ".join(rng.choice(pool) for _ in range(rng.randint(1, 6)))) for n in range(60)]
    rows += [(70, "x " * 200), (71, "a b " * 60), (72, "x " * 19), (73, "x " * 20)]
    check(spark, rows)


def test_whole_copies(spark):
    rows = [(n, prose(0, 200)) for n in range(1, 40)] + [(50 + n, "short text") for n in range(5)]
    rows += [(60, prose(0, 20)), (61, prose(0, 19)), (62, prose(0, 19)), (2, prose(0, 200)), (2, prose(500, 30)), (0, prose(500, 30))]
    check(spark, rows)


def test_rows_without_id_come_last(spark):
    rows = [(None, prose(0, 40)), (None, prose(0, 40)), (5, prose(0, 40)), (None, prose(100, 30))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted((r["doc_id"] or 0, r["n_removed"]) for r in substrings.remove_repeats(docs).collect())
    assert found == [(0, 0), (0, 40), (0, 40), (5, 0)]


def test_batches_of_one_row_give_the_same(spark):
    rows = [(n, " ".join([prose(0, 25), prose(1000 * n, 10), prose(0, 22)])) for n in range(12)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        check(spark, rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_rows(spark, odd, nothing, clashing):
    want = sorted(brute([(r[0], r[1]) for r in ODD_TEXTS]), key=key)
    assert sorted((tuple(r) for r in substrings.remove_repeats(odd).collect()), key=key) == want
    assert substrings.remove_repeats(nothing).count() == 0
    clean = substrings.remove_repeats(clashing)
    assert clean.count() == odd.count() and clean.agg(F.sum("n_removed")).first()[0] == sum(r[2] for r in want)
    assert rows_of(clean, "doc_id", "n_removed") == rows_of(substrings.remove_repeats(odd), "doc_id", "n_removed")
