"""The pipeline, stage by stage, against plain versions of the operators."""

from collections import Counter
from fractions import Fraction

import corpus_pipeline
from perilscope.llm import line_rules, mixing
from tests.llm.conftest import rows_of
from tests.llm.test_native import containment, targets, words
from tests.llm.test_near_dups import brute

SMALL = "/root/testdata/sf0.001"


def test_each_stage_on_its_own_input(spark, scratch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frames[-1], SMALL).write.parquet(f"{scratch}/{name}")
        frames.append(spark.read.parquet(f"{scratch}/{name}"))
    raw, ruled, single, clean, mixed, sharded = [f.collect() for f in frames]
    assert all(f.columns == columns for f in frames[:5])
    verdicts = {r["doc_id"]: r["kept"] for r in line_rules.judge(docs).collect()}
    assert [r["doc_id"] for r in sorted(ruled)] == sorted(i for i, kept in verdicts.items() if kept)
    groups = brute([(r["doc_id"], r["text"]) for r in ruled], 5, Fraction(4, 5))
    assert {r["doc_id"] for r in single} == {i for i, head in groups.items() if i == head}
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {i for i, *_ in containment([(r["doc_id"], r["text"]) for r in single], items)}
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in single} - dirty
    size = {r["doc_id"]: len(words(r["text"])) for r in clean}
    taken, passes = Counter(), Counter(r["doc_id"] for r in mixed)
    for r in mixed:
        taken[r["doc_id"]] += len(words(r["text"]))
    assert max(passes.values()) <= 3 and all(taken[i] <= 3 * size[i] for i in taken)
    by_source, sizes = Counter(), Counter()
    for r in clean:
        by_source[r["source"]] += taken[r["doc_id"]]
        sizes[r["source"]] += size[r["doc_id"]]
    # Half a block from rounding the slots, and up to one for the short last block, taken once more or less than the average.
    assert all(abs(by_source[s] - t) <= 1.5 * mixing.BLOCK_WORDS for s, t in targets(sizes).items())
    counts = Counter(r["shard"] for r in sharded)
    assert len(sharded) == len(mixed) and max(counts.values()) - min(counts.values()) <= 1
    assert sorted((r["doc_id"], r["text"]) for r in sharded) == sorted((r["doc_id"], r["text"]) for r in mixed)


def test_odd_rows_go_through(spark, odd, nothing):
    for start in (odd, nothing):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
        rows = rows_of(docs, "doc_id", "shard", "slot")
        assert (len(rows) > 0) == (start is odd)
