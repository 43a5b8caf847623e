"""Periodic runs against comparing every word with every later one."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from perilscope.llm import periodic_runs, queries
from perilscope.llm.wordhash import slices
from tests.llm.conftest import DOCUMENTS, ODD_TEXTS, prose, rows_of


def brute(ws, least=12):
    """(start, length, period) of all maximal stretches, the smallest period of each."""
    found = {}
    n = len(ws)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and ws[i] == ws[i + q]:
                i += 1
            if i - start + q >= max(least, 2 * q):
                found.setdefault((start, i + q), q)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def collapsed(ws, runs):
    gone = {i for a, size, q in runs for i in range(a + q, a + size)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def sample_texts():
    random.seed(5)
    texts = ["x " * k for k in (1, 11, 12, 13, 40, 257)] + ["a b " * 6, "a b " * 5 + "a", prose(0, 100), "a a b " * 30 + "q " + "a b " * 20]
    for size in (20, 60, 150, 400):
        for letters in (1, 2, 3, 8):
            texts += [" ".join(random.choice("abcdefgh"[:letters]) for _ in range(size)) for _ in range(4)]
    for p in (1, 2, 3, 5, 7, 8, 9, 16, 17, 31, 64, 65, 100):
        block = prose(1000, p)
        texts += [f"{prose(0, 13)} {' '.join([block] * 4)} {' '.join(block.split()[: p // 2])} {prose(50, 9)}", f"{block} {block}", " ".join([block] * 3 + ["y"] + [block] * 2)]
    fibonacci = ["a", "a b"]
    while len(fibonacci) < 13:
        fibonacci.append(fibonacci[-1] + " " + fibonacci[-2])
    return texts + [fibonacci[-1]]


def test_runs_match_brute_force(spark):
    texts = sample_texts()
    docs = spark.createDataFrame([(n, t, "en", "s", 0) for n, t in enumerate(texts)], DOCUMENTS)
    rows = periodic_runs.collapse_runs(docs).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ws = texts[row["doc_id"]].split()
        assert [tuple(r) for r in row["runs"]] == brute(ws), texts[row["doc_id"]][:80]
        assert (row["n_words"], row["collapsed"]) == (len(ws), collapsed(ws, brute(ws)))


@pytest.mark.parametrize("pairs", [1, 64, 1 << 20])
def test_slices_and_blocks_do_not_change_fragments(monkeypatch, pairs):
    texts = sample_texts()
    monkeypatch.setattr(periodic_runs, "PAIRS_AT_ONCE", pairs)
    [words] = slices(pa.array(texts))
    together = periodic_runs.solve(words, 12)
    for t in (3, 20, len(texts) - 1):
        [alone] = slices(pa.array([texts[t]]))
        mine = together[together[:, 0] == t][:, 1:]
        assert sorted(map(tuple, mine)) == sorted(map(tuple, periodic_runs.solve(alone, 12)[:, 1:]))


def test_work_stays_in_proportion_on_one_word():
    [words] = slices(pa.array(["x " * 20_000]))
    found = periodic_runs.solve(words, 12)
    assert set(found[:, 1]) == {1} and len(found) <= 20_000 / 10


def test_other_least_length(spark):
    texts = ["a a a b b b b c c", "p q p q p q p"]
    docs = spark.createDataFrame([(n, t, "en", "s", 0) for n, t in enumerate(texts)], DOCUMENTS)
    for least in (2, 3, 4, 7):
        for row in periodic_runs.collapse_runs(docs, least=least).collect():
            assert [tuple(r) for r in row["runs"]] == brute(texts[row["doc_id"]].split(), least)


def test_runs_of_odd_rows(spark, odd, nothing, clashing):
    found = periodic_runs.collapse_runs(odd)
    by_text = Counter((r["doc_id"], r["collapsed"], tuple(map(tuple, r["runs"]))) for r in found.collect())
    want = Counter()
    for i, text, *_ in ODD_TEXTS:
        ws = [w.decode() for w in (text or "").encode().split()]
        runs = brute(ws) if len(ws) < 10_000 else []
        want[(i, collapsed(ws, runs), tuple(runs))] += 1
    assert by_text == want
    assert periodic_runs.collapse_runs(nothing).count() == 0
    more = clashing.withColumnsRenamed({"rank": "period", "value": "_runs", "label": "n_words", "key": "_kept"})
    again = periodic_runs.collapse_runs(more)
    assert again.columns == [c for c in more.columns if c != "n_words"] + list(periodic_runs.RESULT)
    assert rows_of(again, "doc_id", "collapsed") == rows_of(found, "doc_id", "collapsed")


def test_query_on_the_given_table(spark):
    import hashlib

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op11_periodic_runs(spark, sf).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ws = [w.decode() for w in (texts[row["doc_id"]] or "").encode().split()]
        at = queries.with_planted_run(row["doc_id"], len(ws))
        ws = ws if at is None else [ws[i] for i in at]
        if len(ws) > 1500:
            continue  # a plain comparison of all words takes minutes
        runs = brute(ws)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (row["n_runs"], row["start"], row["length"], row["period"], row["exponent_milli"]) == (len(runs), *want)
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(ws, runs).encode()).hexdigest()


def test_planted_words():
    import zlib

    planted = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    for i in range(400):
        at = queries.with_planted_run(i, 50)
        assert (at is None) == (i not in planted)
        if at is not None:
            g = zlib.crc32(str(i).encode()) // 10
            a, p = g % 50, 1 + (50 - g % 50) // (3 + g % 8)
            assert at.tolist() == [k if k < a else a + (k - a) % p for k in range(50)]
    assert queries.with_planted_run(None, 50) is None and queries.with_planted_run(planted[0], 0) is None
    assert np.array_equal(queries.with_planted_run(planted[0], 1), [0])
