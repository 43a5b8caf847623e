"""Registered queries of the text operators, with the same rows as SQL where SQL can state them."""

from __future__ import annotations

import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perilscope.llm import (
    decontaminate,
    html_text,
    language,
    line_dedup,
    line_rules,
    mixing,
    near_dups,
    periodic_runs,
    pu_quality,
    sharding,
    substrings,
    url_filter,
    whitening,
)
from perilscope.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document (its source as host) and every page: kind, doc_id or page_id, lang, confidence."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    langs, shares = language.train(docs)
    none = F.lit(None)
    texts = docs.select(
        F.lit("document").alias("kind"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        none.cast("bigint").alias("page_id"),
        "text",
        none.cast("string").alias("declared"),
        none.cast("string").alias("address"),
        F.col("source").alias("host"),
    )
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    declared = pages.withColumn("_declared", language.declared_language(F.col("html")))
    extracted = html_text.extract(declared)
    web = extracted.select(
        F.lit("page").alias("kind"),
        none.cast("bigint").alias("doc_id"),
        F.col("page_id").cast("bigint").alias("page_id"),
        "text",
        F.col("_declared").alias("declared"),
        language.address_language(host, path).alias("address"),
        host.alias("host"),
    )
    return language.identify(texts.union(web), langs, shares)


def op2_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), 3, Fraction(85, 100))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "soft_weight")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(mixing.mix(table(spark, sf_dir, "documents")))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op9_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *line_rules.MEASURES, "base_failed", "kept", "n_removed", "n_frequent_lines")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def with_planted_run(doc_id: int | None, n: int) -> np.ndarray | None:
    """The words of the contract: a tenth of the documents ends in a stretch of one period."""
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if doc_id is None or rest or not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse_runs(table(spark, sf_dir, "documents"), order=with_planted_run)
    # The greatest length, then the smallest start, then the smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"], r["period"])))
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    found = found.withColumn("_best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("_best.start").alias("start"),
        F.col("_best.length").alias("length"),
        F.col("_best.period").alias("period"),
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.remove_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_language,
        op2_near_dups,
        op3_url_filter,
        op4_decontaminate,
        op5_shards,
        op6_mix,
        op7_substrings,
        op8_html_text,
        op9_line_rules,
        op10_quality,
        op11_periodic_runs,
        op12_line_dedup,
        op13_whitening,
    )
}

