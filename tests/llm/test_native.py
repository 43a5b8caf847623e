"""Operators made of DataFrame operations: rules, decontamination, sharding, mixing."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from perilscope.llm import decontaminate, line_rules, mixing, sharding
from tests.llm.conftest import DOCUMENTS, ODD_TEXTS, prose, rows_of

PYTHON_NODES = ("Python", "Pandas", "Arrow")


def is_native(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(node in plan for node in PYTHON_NODES)


def words(text):
    return (text or "").encode().split()


def test_repeated_words_match_brute_force(spark):
    texts = ["a b c d e a b c d e", "a b c d e f a b c d e", "x " * 30, "a a a a a", "a a a a a a", prose(0, 50), None, "", "a b c d"]
    texts += ["a b c d e f g a b c d e f g h a b c d e"]
    docs = spark.createDataFrame([(n, t, "en", "s", 0) for n, t in enumerate(texts)], DOCUMENTS)
    for row in line_rules.judge(docs).collect():
        ws = words(texts[row["doc_id"]])
        windows = Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
        covered = {p for i in range(len(ws) - 4) if windows[tuple(ws[i : i + 5])] > 1 for p in range(i, i + 5)}
        assert (row["n_words"], row["n_repeat_words"]) == (len(ws), len(covered)), texts[row["doc_id"]]


def test_frequent_lines_deplete_documents(spark):
    menu = "\n".join(["Home   News about\tUS", "Terms and conditions of this place"])
    rows = [(n, menu + "\n" + prose(100 * n, 40), "en", "h", 0) for n in range(30)]
    rows += [(100 + n, menu.upper() + "\n" + f"only{n} few{n}", "en", "h", 0) for n in range(5)]
    rows += [(200, menu + "\nmore words are not on this other host at all", "en", "other", 0)]
    rows += [(300 + n, prose(7000, 50), "en", "h", 0) for n in range(10)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    kept = {r["doc_id"]: (r["n_removed"], r["kept"]) for r in line_rules.judge(docs).collect()}
    assert all(kept[n] == (10, True) for n in range(30))
    assert all(kept[100 + n] == (10, False) for n in range(5))
    assert kept[200] == (0, True)
    assert all(kept[300 + n] == (0, True) for n in range(10)), "copies are no boilerplate"
    assert {r["doc_id"] for r in line_rules.keep(docs).collect()} == {i for i, (_, k) in kept.items() if k}


def test_frequent_lines_leave_the_text(spark):
    notice = ["Home   News about\tUS", "", "Terms and conditions of this place"]
    rows = [(n, "\n".join([notice[0], prose(100 * n, 20), *notice[1:], prose(100 * n + 50, 20)]), "en", "h", None if n == 7 else 1) for n in range(30)]
    rows += [(100 + n, "\n".join([*notice, prose(90_000 + 100 * n, 9)]), "en", "h", 1) for n in range(3)]
    docs = spark.createDataFrame(rows, DOCUMENTS).withColumns({"_gone": F.lit("own"), "at": F.lit("own")})
    kept = line_rules.keep(docs)
    assert kept.columns == docs.columns and {(r["_gone"], r["at"]) for r in kept.collect()} == {("own", "own")}
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in kept.collect()}
    assert set(texts) == set(range(30)), "nine words are left of the others"
    for n in range(30):
        left = f"{prose(100 * n, 20)}\n\n{prose(100 * n + 50, 20)}"
        assert texts[n] == (left, len(left))
    judged = {r["doc_id"]: r for r in line_rules.judge(docs).collect()}
    assert (judged[0]["n_removed"], judged[0]["n_frequent_lines"], judged[100]["base_failed"], judged[100]["kept"]) == (10, 2, False, False)


def test_lines_of_a_few_percent_are_frequent_and_copies_are_not(spark):
    """A notice on 30 of 640 documents of a host; 40 copies of one text count once."""
    notice = " ".join(f"Notice{n}" for n in range(30))
    rows = [(n, prose(100 * n, 40), "en", "h", 0) for n in range(570)]
    rows += [(1000 + n, notice + "\n" + prose(90_000 + 100 * n, 40), "en", "h", 0) for n in range(25)]
    rows += [(2000 + n, notice + f"\nonly{n} few{n}", "en", "h", 0) for n in range(5)]
    rows += [(3000 + n, prose(500_000, 50), "en", "h", 0) for n in range(40)]
    found = {r["doc_id"]: (r["n_removed"], r["kept"]) for r in line_rules.judge(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert len(found) == 640
    for i, seen in found.items():
        assert seen == ((0, True) if i < 1000 or i >= 3000 else (30, i < 2000)), i


def test_rules_on_odd_rows(spark, odd, nothing, clashing):
    found = line_rules.judge(odd)
    assert found.count() == len(ODD_TEXTS) and line_rules.judge(nothing).count() == 0
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert (by_id[4]["n_words"], by_id[4]["base_failed"], by_id[4]["kept"]) == (0, True, False)
    twelve = by_id[12]
    assert (twelve["n_words"], twelve["word_chars"], twelve["n_symbols"], twelve["n_dup_lines"]) == (6, 19, 3, 1)
    assert by_id[9]["n_dup_lines"] == 29 and by_id[9]["base_failed"]
    kept = line_rules.keep(clashing)
    assert kept.columns == clashing.columns
    assert rows_of(kept, "doc_id") == rows_of(found.filter("kept"), "doc_id")
    assert {r["_id"] for r in kept.collect()} == {"own _id"}


def containment(docs, items, k=5, share=800):
    def sets(rows):
        found = defaultdict(set)
        for i, text in rows:
            ws = [w.lower() for w in words(text)]
            found[i] |= {tuple(ws[n : n + k]) for n in range(len(ws) - k + 1)} if len(ws) >= k else {tuple(ws)} - {()}
        return found

    d, b = sets(docs), sets(items)
    return {
        (i, j, len(x & y), len(y)) for i, x in d.items() for j, y in b.items() if y and 1000 * len(x & y) >= share * len(y)
    }


def test_containment_matches_brute_force(spark):
    items = [(n, prose(100 * n, 8 + 3 * n)) for n in range(12)] + [(50, "two words"), (51, ""), (52, None), (53, prose(0, 8))]
    items += [(60, prose(9000, 20)), (60, prose(9100, 5)), (None, prose(0, 30))]
    docs = [(n, prose(50_000, 300 * n) + " " + items[n][1].upper() + " " + prose(70_000, 40)) for n in range(12)]
    docs += [(20 + n, " ".join(items[n][1].split()[: 7 + 2 * n])) for n in range(12)]
    docs += [(40, "Two Words"), (41, "two words more"), (42, None), (43, ""), (44, prose(9000, 20) + " " + prose(9100, 5))]
    texts = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCUMENTS)
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contained(texts, tests)
    assert {tuple(r)[:4] for r in found.collect()} == containment(docs, [x for x in items if x[0] is not None])
    assert is_native(found)
    dirty = {r["doc_id"] for r in found.collect()}
    assert {r["doc_id"] for r in decontaminate.clean(texts, tests).collect()} == {i for i, _ in docs} - dirty


def test_decontamination_of_odd_rows(spark, odd, nothing, clashing):
    tests = spark.createDataFrame([(1, prose(100, 30)), (2, "one two"), (None, "x"), (3, None)], "item_id bigint, text string")
    assert rows_of(decontaminate.contained(odd, tests), "doc_id", "item_id") == [(7, 2), (8, 2), (11, 1)]
    left = decontaminate.clean(clashing, tests)
    assert left.columns == clashing.columns and left.count() == len(ODD_TEXTS) - 4
    assert decontaminate.clean(odd, tests.limit(0)).count() == len(ODD_TEXTS)
    assert decontaminate.contained(nothing, tests).count() == 0


def test_shards_follow_the_mixture(spark):
    rows = [(n, prose(n, n % 7), "en", "big" if n % 3 else "s%d" % (n % 5), 0) for n in range(1003)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    found = sharding.assign(docs)
    assert is_native(found)
    placed = found.collect()
    counts = Counter(r["shard"] for r in placed)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(8):
        assert sorted(r["slot"] for r in placed if r["shard"] == s) == list(range(counts[s]))
    source = {r[0]: r[3] for r in rows}
    totals = Counter(source.values())
    for (s, name), n in Counter((r["shard"], source[r["doc_id"]]) for r in placed).items():
        assert abs(n - totals[name] / 8) < 2
    text = {r[0]: r[1] for r in rows}
    assert all(r["size"] == len(text[r["doc_id"]].encode()) + 1 for r in placed)
    assert all(r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) for r in placed)


@pytest.mark.parametrize("equal", [5, 20, 100, 400])
def test_equal_sources_share_every_shard(spark, equal):
    """Equally large sources reach the cuts together; neither they nor a large one pay for it."""
    names = ["large"] * 5000 + [f"s{n}" for n in range(equal) for _ in range(53)]
    docs = spark.createDataFrame([(n, f"t{n}", "en", name, 0) for n, name in enumerate(names)], DOCUMENTS)
    placed = sharding.assign(docs).collect()
    counts = Counter(r["shard"] for r in placed)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    totals, cells = Counter(names), Counter((r["shard"], names[r["doc_id"]]) for r in placed)
    assert all(abs(cells[s, name] - n / 8) < 2 for name, n in totals.items() for s in range(8))


def test_rows_of_a_shard_stand_by_fractional_rank(spark):
    names = ["large"] * 400 + ["small"] * 40
    docs = spark.createDataFrame([(n, f"t{n}", "en", name, 0) for n, name in enumerate(names)], DOCUMENTS)
    for s in range(8):
        rows = sharding.assign(docs).filter(F.col("shard") == s).orderBy("slot").collect()
        small = [r["slot"] for r in rows if names[r["doc_id"]] == "small"]
        assert len(small) == 5 and all(8 <= b - a <= 14 for a, b in zip(small, small[1:]))


def test_buckets_do_not_change_places(spark, monkeypatch):
    rows = [(n, f"t{n}", "en", "s%d" % (n % 3), 0) for n in range(300)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    few = rows_of(sharding.assign(docs), "doc_id", "shard", "slot")
    monkeypatch.setattr("perilscope.llm.ranking.BUCKET_ROWS", 7)
    monkeypatch.setattr("perilscope.llm.ranking.STRETCH", 3)
    assert rows_of(sharding.assign(docs), "doc_id", "shard", "slot") == few


def test_shards_of_odd_rows(spark, odd, nothing, clashing):
    placed = sharding.shard(clashing)
    assert placed.columns == [c for c in clashing.columns if c not in sharding.PLACED] + list(sharding.PLACED)
    assert rows_of(placed, "doc_id", "shard", "slot") == rows_of(sharding.assign(odd), "doc_id", "shard", "slot")
    assert Counter(r["shard"] for r in placed.collect()) == {s: 2 for s in range(8)}
    assert {r["_nth"] for r in placed.collect()} == {"own _nth"}
    assert sharding.assign(nothing).count() == 0 and sharding.shard(nothing).count() == 0


def targets(sizes, weights=(1, 2, 3), most=3):
    """Reshare the excess by weight until nothing is above its limit."""
    weight = {s: weights[n % len(weights)] for n, s in enumerate(sorted(sizes))}
    total, fixed = sum(sizes.values()), {}
    while True:
        left = {s: w for s, w in weight.items() if s not in fixed}
        level = (total - sum(fixed.values())) / max(sum(left.values()), 1)
        above = [s for s, w in left.items() if level * w > most * sizes[s]]
        if not above:
            return {**fixed, **{s: level * w for s, w in left.items()}}
        fixed |= {s: most * sizes[s] for s in above}


def test_mixture_meets_its_targets(spark):
    shape = {"a": (40, 100), "b": (5, 30), "c": (20, 200), "d": (3, 10), "e": (30, 60), "f": (1, 1500)}
    rows = [(k * 1000 + n, prose(n, size), "en", name, 0) for k, (name, (docs, size)) in enumerate(shape.items()) for n in range(docs)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    mixed = mixing.mix(docs, shard_blocks=64)
    found = mixing.taken_words(mixed)
    assert is_native(found)
    taken = found.collect()
    size = {r[0]: len(words(r[1])) for r in rows}
    assert {r["doc_id"]: r["size"] for r in taken} == size
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in taken)
    want = targets({name: docs * n for name, (docs, n) in shape.items()})
    source, got = {r[0]: r[3] for r in rows}, Counter()
    for r in taken:
        got[source[r["doc_id"]]] += r["taken"]
        assert r["target"] == pytest.approx(want[source[r["doc_id"]]], rel=1e-12)
    # Half a block from rounding the slots, and up to one for the short last block, taken once more or less than the average.
    assert all(abs(got[s] - t) <= 1.5 * mixing.BLOCK_WORDS for s, t in want.items())
    assert rows_of(mixing.taken_words(mixing.mix(docs, shard_blocks=64))) == rows_of(found)
    counts = mixed.counts.groupBy("shard").agg(F.sum("drawn").alias("n")).orderBy("shard").collect()
    assert all(r["n"] == 64 for r in counts[:-1]) and 0 < counts[-1]["n"] <= 64
    blocks = mixing.mixed_blocks(docs, mixed)
    assert Counter({r["doc_id"]: r["n"] for r in blocks.groupBy("doc_id").agg(F.sum(F.size("words")).alias("n")).collect()}) == Counter(
        {r["doc_id"]: r["taken"] for r in taken if r["taken"]}
    )
    texts = mixing.mixed_documents(docs, mixed)
    length = Counter()
    for r in texts.collect():
        length[r["doc_id"]] += len(words(r["text"]))
        assert r["n_chars"] == len(r["text"]) and set(words(r["text"])) <= set(words(rows[[x[0] for x in rows].index(r["doc_id"])][1]))
    assert length == Counter({r["doc_id"]: r["taken"] for r in taken if r["taken"]})


@pytest.mark.parametrize("size", [1, 2, 7, 64, 100])
def test_permutation(spark, size):
    at = spark.range(size).select(mixing.permuted(F.col("id"), F.lit(size), F.lit(5)).alias("p"))
    assert sorted(r["p"] for r in at.collect()) == list(range(size))


def test_mixture_of_odd_rows(spark, odd, nothing, clashing):
    taken = mixing.taken_words(mixing.mix(odd))
    assert taken.count() == len(ODD_TEXTS)
    assert all(r["taken"] <= 3 * r["size"] for r in taken.collect())
    assert mixing.taken_words(mixing.mix(nothing)).count() == 0
    mixed = mixing.mixed_documents(clashing, mixing.mix(clashing))
    assert mixed.columns == clashing.columns
    assert {r["_doc"] for r in mixed.collect()} == {"own _doc"}
    assert sum(len(words(r["text"])) for r in mixed.collect()) == sum(r["taken"] for r in taken.collect())
    assert mixing.mixed_documents(nothing, mixing.mix(nothing)).count() == 0
