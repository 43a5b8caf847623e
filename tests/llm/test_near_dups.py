from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from perilscope.llm import near_dups
from perilscope.llm.graph import components
from tests.llm.conftest import DOCUMENTS, rows_of

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    words = (text or "").translate(LOW).encode().split()
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, similarity):
    """doc_id -> (set size, smallest reachable doc_id) by comparing all pairs that share a shingle."""
    sets = [(i, shingles(text, k)) for i, text in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = defaultdict(list)
    for n, (_, found) in enumerate(sets):
        for s in found:
            where[s].append(n)
    for n, (i, found) in enumerate(sets):
        for m, c in Counter(m for s in found for m in where[s] if m < n).items():
            if Fraction(c, len(found) + len(sets[m][1]) - c) >= similarity:
                a, b = sorted((root(i), root(sets[m][0])))
                parent[b] = a
    return {i: root(i) for i, _ in sets}


def edited(words, places):
    return " ".join(f"new{p}" if n in places else w for n, w in enumerate(words) for p in [n])


def test_groups_match_brute_force(spark):
    base = [f"b{i}" for i in range(150)]
    other = [f"c{i}" for i in range(40)]
    texts = [" ".join(base)] * 3
    texts += [edited(base, {p}) for p in range(0, 150, 9)]
    texts += [edited(base, {p, p + 40, p + 70}) for p in range(0, 60, 5)]
    texts += [edited(base, set(range(p, p + 60, 10))) for p in range(0, 80, 7)]
    texts += [" ".join(other), edited(other, {5}), edited(other, {39}), " ".join(other[:-2]), " ".join(other).upper()]
    texts += ["tiny text", "tiny TEXT", "tiny", "", None, " ".join(base[:75]), " ".join(base + base[:4])]
    rows = [(100 - n, text, "en", "s", 0) for n, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    for k, similarity in ((3, Fraction(85, 100)), (5, Fraction(4, 5))):
        found = near_dups.near_duplicates(docs, k, similarity).collect()
        want = brute([(r[0], r[1]) for r in rows], k, similarity)
        assert {r["doc_id"]: r["component_id"] for r in found} == want
        assert {r["doc_id"]: r["n_shingles"] for r in found} == {r[0]: len(shingles(r[1], k)) for r in rows}
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_odd_rows(spark, odd, nothing, clashing):
    found = rows_of(near_dups.near_duplicates(odd, 3, Fraction(85, 100)), "doc_id", "component_id", "kept")
    assert found == [
        (None, None, True), (None, None, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 5, True),
        (6, 6, True), (7, 7, True), (8, 7, False), (9, 9, True), (10, 10, True), (11, 11, True), (11, 11, True),
        (12, 12, True), (13, 13, True),
    ]
    assert near_dups.near_duplicates(nothing).count() == 0
    kept = near_dups.keep_one(clashing)
    assert kept.columns == clashing.columns and kept.count() == 12, "2, 3 and 8 are copies; 11 is there twice"
    repeats = odd.union(odd).union(odd.filter("doc_id IS NULL"))
    assert rows_of(near_dups.keep_one(repeats), "doc_id", "text") == rows_of(kept, "doc_id", "text")
    assert {r["rank"] for r in kept.collect()} == {"own rank"}


def test_overlap_bound_misses_almost_nothing():
    need = near_dups.least_shared(24, Fraction(85, 100))
    assert 1 <= need < 24
    assert near_dups.least_shared(64, Fraction(4, 5)) < 64 * 0.8


@pytest.mark.parametrize(
    "edges",
    [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(99, 98), (98, 97), (5, 5)], [(3, 1), (1, 3), (2, 3)]],
)
def test_components(spark, edges):
    found = dict(rows_of(components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    parent = {n: n for edge in edges for n in edge if edge[0] != edge[1]}
    for _ in range(len(edges)):
        for a, b in edges:
            if a != b:
                parent[a] = parent[b] = min(parent[a], parent[b])
    assert found == parent
