"""Language identification by Bayesian fusion of evidence.

For each row and language the log evidence adds up:

- text: naive Bayes on byte trigrams, counted per language over all labelled documents; its weight is limited to
  ``TEXT_WEIGHT`` trigrams' worth, so that a long text doesn't drown the rest;
- declared markup language and address (the country suffix of the host, or a language as first path segment), each right with a stated chance;
- the host: counts of the other rows' languages on the same host, smoothed towards its domain, and that towards all rows. The counts are sums of
  the rows' own posteriors, from grouped aggregations with partial sums; a row is taken out of its own host's counts.

Text is scored in Arrow batches; the rest is DataFrame operations on narrow rows. The model is one array of ``BUCKETS`` numbers per
language; languages are few by nature, and a table that names more than ``MOST_LANGUAGES`` is refused.

Defined results: rows without text, address, host or declaration simply lack that evidence; a row with none gets the
languages' overall shares. Languages that tie resolve to the first by name. Without any labelled document, lang is NULL and
confidence 0. Rows that repeat are scored one by one. Rows of an empty table: none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perilscope.llm.wordhash import SLICE_BYTES, texts_of
from perilscope.llm.text import bundled
from perilscope.session import cut_lineage

BUCKETS = 4096
TEXT_WEIGHT = 40.0
DECLARED_RIGHT = 0.85
ADDRESS_RIGHT = 0.7
SMOOTHING = 4.0
MOST_LANGUAGES = 500


def trigrams(data: np.ndarray) -> np.ndarray:
    """The bucket of the three bytes from each place on, A-Z taken as a-z, other white space as a space."""
    folded = np.where((data >= 65) & (data <= 90), data + 32, np.where(data < 33, 32, data)).astype(np.uint32)
    return ((folded[:-2] * 31 + folded[1:-1]) * 31 + folded[2:]) * np.uint32(2654435761) >> np.uint32(20)


def pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and borders of slices with at least one text."""
    data, borders = texts_of(column)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(borders, borders[row] + SLICE_BYTES, side="right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield row, data[borders[row] : borders[stop]], borders[row : stop + 1] - borders[row]
        row = stop


def inside(borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 trigram of each text."""
    return borders[:-1], np.maximum(borders[1:] - 2, borders[:-1])


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages by name and their log trigram shares, from all rows with text and lang."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for row, data, borders in pieces(batch.column(0)):
                if len(data) < 3:
                    continue
                codes = trigrams(data)
                first, last = inside(borders)
                for lang in set(langs[row : row + len(first)]):
                    mine = np.zeros(len(codes) + 1, dtype=np.int64)
                    chosen = langs[row : row + len(first)] == lang
                    np.add.at(mine, np.minimum(first[chosen], len(codes)), 1)
                    np.add.at(mine, np.minimum(last[chosen], len(codes)), -1)
                    found = np.bincount(codes[np.cumsum(mine[:-1]) > 0], minlength=BUCKETS)
                    counts[lang] = counts.get(lang, 0) + found
        for lang, found in counts.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(found[at].astype(np.int64))],
                names=["lang", "bucket", "n"],
            )

    labelled = docs.select("text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = labelled.mapInArrow(work, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counted = cut_lineage(counted)
    langs = [r["lang"] for r in counted.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(langs) > MOST_LANGUAGES:
        raise ValueError("lang has too many values to be a language")
    table = np.ones((len(langs), BUCKETS))
    place = {lang: k for k, lang in enumerate(langs)}
    for lang, bucket, n in counted.collect():  # at most BUCKETS rows per language
        table[place[lang], bucket] += n
    return langs, np.log(table / table.sum(axis=1, keepdims=True))


def text_evidence(rows: DataFrame, shares: np.ndarray) -> DataFrame:
    """Replace ``text`` by ``_text``: the limited log likelihood of each language."""
    table = np.ascontiguousarray(shares.astype(np.float32))
    kept = [f for f in rows.schema.fields if f.name != "text"]
    names = [f.name for f in kept]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            found = np.zeros((len(table), len(text)))
            for row, data, borders in pieces(text):
                if len(data) < 3:
                    continue
                codes = trigrams(data)
                first, last = inside(borders)
                first, last = np.minimum(first, len(codes)), np.minimum(last, len(codes))
                n = np.maximum(last - first, 0)
                weight = np.minimum(n, TEXT_WEIGHT) / np.maximum(n, 1)
                sums = np.zeros(len(codes) + 1)
                for k in range(len(table)):
                    np.cumsum(table[k][codes], dtype=np.float64, out=sums[1:])
                    found[k, row : row + len(n)] = (sums[last] - sums[first]) * weight
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.T.ravel()), len(table)).cast(pa.list_(pa.float64()))
            arrays = [batch.column(batch.schema.get_field_index(name)) for name in names]
            yield pa.RecordBatch.from_arrays([*arrays, lists], names=[*names, "_text"])

    return rows.mapInArrow(work, T.StructType([*kept, T.StructField("_text", T.ArrayType(T.DoubleType()))]))


def normalised(logs: Column) -> Column:
    """Probabilities from log evidence."""
    most = F.array_max(logs)
    powers = F.transform(logs, lambda x: F.exp(x - most))
    total = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(powers, lambda x: x / total)


def hint(value: Column, langs: list[str], right: float) -> Column:
    """Log evidence of a named language: ``right`` for it, the rest shared; nothing if it names none of them."""
    wrong = math.log((1 - right) / max(len(langs) - 1, 1))
    known = F.array(*[F.when(value == lang, F.lit(math.log(right))).otherwise(F.lit(wrong)) for lang in langs])
    none = F.array(*[F.lit(0.0) for _ in langs])
    return F.when(F.coalesce(value.isin(langs), F.lit(False)), known).otherwise(none)


def summed(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: a + b)


def host_counts(rows: DataFrame, keys: list[str], langs: list[str], out: str) -> DataFrame:
    sums = [F.sum(F.col("_own")[k]) for k in range(len(langs))]
    return rows.groupBy(*keys).agg(F.array(*sums).alias(out))


def identify(rows: DataFrame, langs: list[str], shares: np.ndarray) -> DataFrame:
    """Replace text, declared, address and host by lang and confidence. Other columns stay, but for those called like an output."""
    others = [name for name in rows.columns if name not in ("text", "declared", "address", "host", "lang", "confidence")]
    if not langs:
        return rows.select(*[f"`{name}`" for name in others], F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"))
    rows = rows.select(bundled(others).alias("_row"), "text", "declared", "address", "host")
    hints = summed(hint(F.col("declared"), langs, DECLARED_RIGHT), hint(F.col("address"), langs, ADDRESS_RIGHT))
    found = text_evidence(rows, shares).withColumn("_log", summed(F.col("_text"), hints))
    found = found.withColumn("_own", normalised(F.col("_log"))).drop("_text", "declared", "address")
    host = F.coalesce("host", F.lit(""))
    found = cut_lineage(found.withColumns({"_host": host, "_domain": F.substring_index(host, ".", -2)}).drop("host"))
    overall = host_counts(found, [], langs, "_n").first()["_n"] or [0.0] * len(langs)
    total = sum(x or 0.0 for x in overall)
    base = F.array(*[F.lit(((x or 0.0) + 1.0) / (total + len(langs))) for x in overall])
    domains = host_counts(found, ["_domain"], langs, "_domain_n")
    hosts = host_counts(found, ["_domain", "_host"], langs, "_host_n").join(domains, "_domain")
    joined = found.join(hosts.drop("_domain"), "_host").withColumn("_base", base)

    def smoothed(counts: str, towards: str) -> Column:
        """Shares of the other rows, with ``SMOOTHING`` rows' weight of what they are smoothed towards."""
        others_n = F.zip_with(counts, "_own", lambda n, own: F.greatest(n - own, F.lit(0.0)))
        everyone = F.aggregate(others_n, F.lit(0.0), lambda acc, x: acc + x)
        return F.zip_with(others_n, towards, lambda n, p: (n + SMOOTHING * p) / (everyone + SMOOTHING))

    joined = joined.withColumn("_domain_p", smoothed("_domain_n", "_base"))
    nowhere = F.col("_host") == ""
    prior = F.when(nowhere, F.col("_base")).otherwise(smoothed("_host_n", "_domain_p"))
    joined = joined.withColumn("_prior", prior)
    final = normalised(F.zip_with("_log", "_prior", lambda a, p: a + F.log(p)))
    joined = joined.withColumn("_final", final).withColumn("confidence", F.array_max("_final"))
    names = F.array(*[F.lit(lang) for lang in langs])
    lang = F.element_at(names, F.array_position("_final", F.col("confidence")).cast("int"))
    kept = [F.col("_row").getField(name).alias(name) for name in others]
    return joined.select(*kept, lang.alias("lang"), "confidence")


def declared_language(html: Column) -> Column:
    """The primary language of the html element, or NULL."""
    found = F.regexp_extract(html, r"""(?is)<html\b[^>]*?\slang\s*=\s*["']?([a-z]{2,3})""", 1)
    return F.nullif(F.lower(found), F.lit(""))


# --- Fixed values: the language most people of a country use, by its address suffix -----------------

# Countries without such a language (Belgium, Switzerland) and suffixes sold to anyone (.co, .io, .tv, .me) say
# nothing. A suffix is no language code: .ar, .sv, .et, .ca and others would name a wrong one.
SUFFIX_LANGUAGES = {
    "de": "de at li", "fr": "fr mc", "en": "uk us au nz ie ca za", "es": "es mx ar cl pe ve ec gt cu bo do hn py sv ni cr pa uy",
    "pt": "pt br", "it": "it sm va", "nl": "nl", "pl": "pl", "ru": "ru", "sv": "se", "da": "dk", "no": "no", "fi": "fi", "cs": "cz", "sk": "sk",
    "hu": "hu", "ro": "ro", "el": "gr", "tr": "tr", "uk": "ua", "bg": "bg", "hr": "hr", "sl": "si", "et": "ee", "lt": "lt", "lv": "lv",
    "ja": "jp", "zh": "cn", "ko": "kr", "he": "il", "fa": "ir", "vi": "vn", "th": "th", "id": "id",
}


def address_language(host: Column, path: Column) -> Column:
    """The language of the first path segment, when that has two letters, or else of the country of the host's suffix."""
    segment = F.nullif(F.regexp_extract(path, r"^/([a-z]{2})(?:/|$)", 1), F.lit(""))
    pairs = [F.lit(text) for lang, suffixes in SUFFIX_LANGUAGES.items() for suffix in suffixes.split() for text in (suffix, lang)]
    return F.coalesce(segment, F.try_element_at(F.create_map(*pairs), F.regexp_extract(host, r"\.([a-z]{2})$", 1)))
