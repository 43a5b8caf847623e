"""Operators with a fitted model: held-out accuracy, and defined results for odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from perilscope.llm import language, pu_quality
from perilscope.llm.queries import op1_language, op10_quality
from tests.llm.conftest import ODD_TEXTS, rows_of

SMALL = "/root/testdata/sf0.01"


def test_quality_on_held_out_labels(spark):
    scored = op10_quality(spark, SMALL)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    held = [(label[r["doc_id"]], r["score"], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in label]
    good, bad = [s for q, s, _ in held if q], [s for q, s, _ in held if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([q == p for q, _, p in held]) > 0.9


def test_held_out_labels_and_other_columns_change_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    out = pu_quality.held_out(F.col("doc_id"))
    turned = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    first = {r["doc_id"]: r["score"] for r in pu_quality.score(docs, labels).collect()}
    second = {r["doc_id"]: r["score"] for r in pu_quality.score(other, turned).collect()}
    assert all(abs(first[i] - second[i]) < 1e-6 for i in first)


def test_risk_gradient_and_prior():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(1, 1, (4000, 1)), rng.normal(-2, 1, (4000, 1))
    mixed = np.concatenate([good[2000:3400], bad[:600]])  # 0.7 good
    passes = plain_passes(pu_quality.with_one(good[:2000]), pu_quality.with_one(mixed))
    weights = pu_quality.fit_non_negative(passes, 0.7, pu_quality.RIDGE_ROWS / 2000, 2)
    score = lambda x: pu_quality.sigmoid(pu_quality.with_one(x) @ weights)
    assert (score(good[3400:]) > 0.5).mean() > 0.9 and (score(bad[600:]) < 0.5).mean() > 0.8


def test_quality_of_odd_rows(spark, odd, nothing, clashing):
    labels = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (7, 0), (None, 1), (99, 1), (10, 1)], "doc_id bigint, quality int")
    scored = pu_quality.score(clashing, labels).collect()
    assert len(scored) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in scored)
    assert [r["held_out"] for r in scored if r["doc_id"] is None] == [False, False]
    assert len({r["score"] for r in scored if r["doc_id"] == 11}) == 1
    assert {r["score"] for r in pu_quality.score(odd, labels.limit(0)).collect()} == {0.5}
    assert pu_quality.score(nothing, labels).count() == 0


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = pu_quality.held_out(F.col("doc_id"))
    langs, shares = language.train(docs.filter(~out))
    assert langs == ["de", "en", "es", "fr"] and np.allclose(np.exp(shares).sum(axis=1), 1)
    none = F.lit(None).cast("string")
    rows = docs.filter(out).select("doc_id", "text", none.alias("declared"), none.alias("address"), F.col("source").alias("host"), F.col("lang").alias("true"))
    found = language.identify(rows, langs, shares).collect()
    assert np.mean([r["lang"] == r["true"] for r in found]) > 0.97


def test_language_of_every_row(spark):
    found = op1_language(spark, "/root/testdata/sf0.001")
    assert rows_of(found.groupBy("kind").count()) == [("document", 200), ("page", 50)]
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    named = pages.select("page_id", language.declared_language(F.col("html")).alias("declared"))
    joined = found.join(named, "page_id").filter("declared = lang").count()
    assert joined >= 45


def fused(rows, langs, shares):
    """The same evidence in plain loops."""
    logs = []
    for _, text, declared, address, host in rows:
        data = np.frombuffer((text or "").encode(), dtype=np.uint8)
        codes = language.trigrams(data) if len(data) >= 3 else np.zeros(0, dtype=np.uint32)
        log = np.zeros(len(langs))
        if len(codes):
            log += shares[:, codes].sum(axis=1) * min(len(codes), language.TEXT_WEIGHT) / len(codes)
        for value, right in ((declared, language.DECLARED_RIGHT), (address, language.ADDRESS_RIGHT)):
            if value in langs:
                log += [np.log(right if l == value else (1 - right) / (len(langs) - 1)) for l in langs]
        logs.append(log)
    own = [np.exp(l - l.max()) / np.exp(l - l.max()).sum() for l in logs]
    hosts = [r[4] or "" for r in rows]
    domains = [".".join(h.split(".")[-2:]) for h in hosts]
    base = (sum(own) + 1) / (len(rows) + len(langs))
    result = []
    for k in range(len(rows)):
        at_domain = sum(own[m] for m in range(len(rows)) if domains[m] == domains[k] and m != k) + np.zeros(len(langs))
        at_host = sum(own[m] for m in range(len(rows)) if hosts[m] == hosts[k] and m != k) + np.zeros(len(langs))
        domain_p = (at_domain + language.SMOOTHING * base) / (at_domain.sum() + language.SMOOTHING)
        host_p = (at_host + language.SMOOTHING * domain_p) / (at_host.sum() + language.SMOOTHING)
        log = logs[k] + np.log(base if not hosts[k] else host_p)
        p = np.exp(log - log.max()) / np.exp(log - log.max()).sum()
        result.append((rows[k][0], langs[int(p.argmax())], p.max()))
    return result


def test_fusion_matches_plain_loops(spark):
    texts = [("aa bb aa bb", "x"), ("cc dd cc dd", "y"), ("ee ff ee", "z"), ("", "x"), (None, None)]
    docs = spark.createDataFrame(texts, "text string, lang string")
    langs, shares = language.train(docs)
    assert langs == ["x", "y", "z"]
    rows = [
        (1, "aa bb", None, None, "a.com"), (2, "aa", "y", None, "a.com"), (3, None, None, None, "a.com"), (4, None, "z", "x", "b.a.com"),
        (5, "", "nonsense", None, None), (6, "cc dd cc", "x", "x", "b.org"), (7, None, None, None, "b.org"), (8, "qq", None, "zz", "c.org"),
        (9, "ee ff " * 5000, "x", "x", "c.org"),
    ]
    frame = spark.createDataFrame(rows, "id bigint, text string, declared string, address string, host string")
    found = {r["id"]: (r["lang"], r["confidence"]) for r in language.identify(frame, langs, shares).collect()}
    for i, lang, confidence in fused(rows, langs, shares):
        assert found[i][0] == lang and abs(found[i][1] - confidence) < 1e-6
    assert language.identify(frame.limit(0), langs, shares).count() == 0
    empty = language.train(docs.limit(0))
    assert {(r["lang"], r["confidence"]) for r in language.identify(frame, *empty).collect()} == {(None, 0.0)}


def test_declared_and_address(spark):
    rows = [("<html lang='FR-ca'>", "a.de", "/en/x"), ("<HTML class=x lang=de>", "a.fr", "/english/"), ("<p lang=es>", "a.com", ""), (None, None, None)]
    frame = spark.createDataFrame(rows, "html string, host string, path string")
    found = frame.select(language.declared_language(F.col("html")), language.address_language(F.col("host"), F.col("path"))).collect()
    assert [tuple(r) for r in found] == [("fr", "en"), ("de", "fr"), (None, None), (None, None)]


def test_suffixes_are_countries(spark):
    hosts = {"a.at": "de", "b.a.mx": "es", "a.co.uk": "en", "a.br": "pt", "a.ca": "en", "a.ar": "es", "a.sv": "es", "a.se": "sv", "a.be": None, "a.ch": None,
             "a.io": None, "a.com": None, "at": None, "": None, None: None}
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    found = {r["host"]: r["l"] for r in frame.select("host", language.address_language(F.col("host"), F.lit("/x")).alias("l")).collect()}
    assert found == hosts
    suffixes = " ".join(language.SUFFIX_LANGUAGES.values()).split()
    assert len(suffixes) == len(set(suffixes))


def plain_passes(positive, unlabelled):
    return lambda w: tuple(pu_quality.Sums.read(pu_quality.Sums.of(x, w)) for x in (positive, unlabelled))


def risk(w, positive, unlabelled, prior, ridge):
    """The non-negative risk as written, by rows."""
    loss = lambda z: float(np.mean([np.log1p(np.exp(-v)) if v > -30 else -v for v in z]))
    part = loss(-(unlabelled @ w)) - prior * loss(-(positive @ w))
    return prior * loss(positive @ w) + max(0.0, part) + ridge / 2 * w @ w, part


def two_groups(seed, n=400, share=0.4):
    rng = np.random.default_rng(seed)
    good = rng.normal([1.0, 0.5, 0.0], 1.0, (n, 3))
    mixed = np.where(rng.random((n, 1)) < share, rng.normal([1.0, 0.5, 0.0], 1.0, (n, 3)), rng.normal([-1.0, -0.5, 0.0], 1.0, (n, 3)))
    return pu_quality.with_one(good), pu_quality.with_one(mixed)


@pytest.mark.parametrize("prior", [0.1, 0.4, 0.55, 0.6, 0.9])
def test_fit_has_the_least_non_negative_risk(prior):
    """No step in any of many directions lowers the risk; priors that are too large make the second part negative."""
    positive, unlabelled = two_groups(1)
    ridge = 0.01
    w = pu_quality.fit_non_negative(plain_passes(positive, unlabelled), prior, ridge, 4)
    least = risk(w, positive, unlabelled, prior, ridge)[0]
    unbiased = pu_quality.minimise(plain_passes(positive, unlabelled), pu_quality.weighted_risk(prior, 1.0), ridge, np.zeros(4))[0]
    plain, part = risk(unbiased, positive, unlabelled, prior, ridge)
    assert (part < 0) == (prior > 0.5) and (abs(plain - least) < 1e-9 if part >= 0 else least < plain - 1e-3)
    rng = np.random.default_rng(2)
    for size in (1e-2, 1e-1, 1.0):
        for _ in range(60):
            assert risk(w + size * rng.standard_normal(4), positive, unlabelled, prior, ridge)[0] >= least - 1e-4


def test_sums_of_all_rows_match_one_table(spark):
    rng = np.random.default_rng(4)
    table = rng.standard_normal((500, len(pu_quality.NAMES)))
    positive = rng.random(500) < 0.3
    rows = spark.createDataFrame([(*map(float, r), bool(p)) for r, p in zip(table, positive)], [*pu_quality.NAMES, "positive"]).repartition(5)
    means, spreads = table.mean(axis=0), table.std(axis=0)
    w = rng.standard_normal(2 * len(pu_quality.NAMES) + 1) / 10
    x = pu_quality.with_one(pu_quality.design(table, means, spreads))
    for got, want in zip(pu_quality.spark_passes(rows, means, spreads)(w), plain_passes(x[positive], x)(w)):
        for name in ("rows", "loss", "loss_back", "x", "sx", "curve"):
            assert np.allclose(getattr(got, name), getattr(want, name), rtol=1e-10, atol=1e-9), name


def test_prior_matches_a_plain_count(spark):
    positive, unlabelled = two_groups(7, n=3000)
    x = np.vstack([unlabelled, positive])[:, :3]
    rows = [(*map(float, r), *([0.0] * (len(pu_quality.NAMES) - 3)), bool(k >= 3000)) for k, r in enumerate(x)]
    frame = spark.createDataFrame(rows, [*pu_quality.NAMES, "positive"])
    half = len(pu_quality.NAMES)
    model = pu_quality.Model((0.0,) * half, (1.0,) * half, (1.5, 0.7) + (0.0,) * (2 * half - 2), 0.0, 0.5)
    found = pu_quality.estimated_prior(frame, model)
    score = 1 / (1 + np.exp(-np.clip(x, -4, 4)[:, :2] @ [1.5, 0.7]))
    best = []
    for t in range(pu_quality.BINS):
        above = np.floor(score * (pu_quality.BINS - 1e-9)) >= t
        p, u = above[3000:].mean(), above.mean()
        if p >= pu_quality.LEAST_SHARE:
            best.append((u / p + (1 / np.sqrt(6000) + 1 / np.sqrt(3000)) / p, u / p))
    assert found == pytest.approx(min(best)[1], rel=1e-9)
    assert 0.6 < found < 0.85, "the positives are half of all rows, and two fifths of the other half are good"


def test_labels_of_texts_that_are_not_there(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    more = labels.select("doc_id", "quality").union(spark.range(10**9, 10**9 + 5000).selectExpr("id", "cast(id % 2 as int)"))
    assert rows_of(pu_quality.score(docs, more), "doc_id", "predicted") == rows_of(pu_quality.score(docs, labels), "doc_id", "predicted")
