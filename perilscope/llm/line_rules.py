"""Quality rules with cross-document line frequency.

Base rules look at one text: too few words, or too many words in repeated 5-word windows. The method looks across
documents: lines are normalised (A-Z to lower case, runs of white space to one space, trimmed) and hashed; for each host
the distinct texts with that line are counted, so that copies of a document count once. A line at ``least`` texts and above
``share`` of the host's texts is boilerplate and removed from every text of the host. A document that keeps under ``depleted`` of its
words, or too few words for the base rule, is rejected; the others go on without the lines.

DataFrame operations only. Counts are hash aggregations with partial sums, so a hot host or line costs a row per task.
A text is only compared with itself by sorting inside its row.

Defined results: NULL, empty and blank texts have no words and fail the base rules; a NULL host is a host of its own; each row
is a document, also where doc_id repeats or is NULL. Other columns don't matter; ``judge`` replaces those called like an
output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilscope.llm.text import BLANKS, BROADCAST_ROWS, ROW_KEY, SPACE, WORD, broadcast_if_few, fold_ascii, packed, with_row_hash, with_row_key, words
from perilscope.session import cut_lineage

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
LEAST_DOCUMENTS = 20
HOST_SHARE = 0.02
DEPLETED = 0.3
SYMBOLS = "#*$%&|<>"

HOST = ["_no_host", "_host"]
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def word_windows(hashes: Column, window: int) -> Column:
    """A hash for each run of ``window`` words, by its first word, from the hashes of the words."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(hashes) - window, F.lit(0)))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]))


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """Narrow rows: doc_id, ROW_KEY, host columns, the base measures, base_failed, ``_text_hash`` and ``_lines`` (hash, words and number of each line with a word)."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select(
        "doc_id",
        F.coalesce(F.col(host), F.lit("")).alias("_host"),
        F.col(host).isNull().alias("_no_host"),
        "source",
        "text",
        F.xxhash64(text).alias("_text_hash"),
        words(F.col("text")).alias("_words"),
        F.translate(text, BLANKS, "").alias("_solid"),
        F.split(text, "\n").alias("_split"),
    ).withColumn("_raw", F.filter("_split", lambda line: line.rlike(WORD)))
    base = base.withColumns(
        {
            "n_words": F.size("_words").cast("bigint"),
            "word_chars": F.char_length("_solid").cast("bigint"),
            "n_symbols": (F.char_length("_solid") - F.char_length(F.translate("_solid", SYMBOLS, ""))).cast("bigint"),
            "n_dup_lines": (F.size("_raw") - F.size(F.array_distinct("_raw"))).cast("bigint"),
            "_hashes": F.transform("_words", lambda word: F.xxhash64(word)),
            "_lines": F.filter(F.transform("_split", numbered_line), lambda entry: entry["words"] > 0),
        }
    )
    base = base.withColumn("_windows", F.when(F.size("_hashes") > WINDOW, word_windows(F.col("_hashes"), WINDOW)))
    # Pairs are sorted only where some window occurs twice; for other texts the distinct count settles it.
    again = F.size("_windows") > F.size(F.array_distinct("_windows"))
    pair = F.transform("_windows", lambda value, i: F.struct(value.alias("h"), i.alias("i")))
    base = base.withColumn("_pairs", F.when(again, F.array_sort(pair)))

    def same(p: Column, at: Column) -> Column:
        return F.coalesce(F.get("_pairs", at)["h"] == p["h"], F.lit(False))

    repeated = F.filter("_pairs", lambda p, i: same(p, i - 1) | same(p, i + 1))
    base = base.withColumn("_starts", F.array_sort(F.transform(repeated, lambda p: p["i"])))

    def fresh(start: Column, i: Column) -> Column:
        return F.least(F.coalesce(F.get("_starts", i + 1) - start, F.lit(WINDOW)), F.lit(WINDOW))

    covered = F.aggregate(F.transform("_starts", fresh), F.lit(0), lambda total, part: total + part)
    base = base.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    narrow = base.withColumn("base_failed", failed).drop("_words", "_hashes", "_solid", "_raw", "_split", "_windows", "_pairs", "_starts")
    return with_row_key(narrow).drop("text", "source")


def numbered_line(line: Column, at: Column) -> Column:
    return F.struct(line_hash(line).alias("line"), F.size(words(line)).alias("words"), at.alias("at"))


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(F.regexp_replace(fold_ascii(line), SPACE, " ")))


def frequent_lines(measured: DataFrame, least: int = LEAST_DOCUMENTS, share: float = HOST_SHARE) -> DataFrame:
    """_host, _no_host, line: lines in at least ``least`` distinct texts and more than ``share`` of the host's."""
    hosts = measured.select(*HOST, "_text_hash").distinct().groupBy(*HOST).agg(F.count(F.lit(1)).alias("_host_texts"))
    once = F.explode(F.array_distinct(F.transform("_lines", lambda entry: entry["line"])))
    lines = measured.select(*HOST, "_text_hash", once.alias("line"))
    # A line has no more texts than rows: texts are told apart only for lines in enough rows.
    rows = lines.groupBy(*HOST, "line").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") >= least)
    candidates = broadcast_if_few(cut_lineage(rows.drop("_rows")))
    texts = lines.join(candidates, [*HOST, "line"]).distinct().groupBy(*HOST, "line").agg(F.count(F.lit(1)).alias("_texts"))
    often = texts.filter(F.col("_texts") >= least).join(hosts, HOST)
    return often.filter(F.col("_texts") > share * F.col("_host_texts")).select(*HOST, "line")


def lines_found(measured: DataFrame) -> DataFrame:
    """ROW_KEY, words and at of the lines to be removed. ``measured`` is a stored table."""
    lines = measured.select(*HOST, *ROW_KEY, F.explode("_lines").alias("_entry")).select(*HOST, *ROW_KEY, "_entry.*")
    often = broadcast_if_few(cut_lineage(frequent_lines(measured)))
    return lines.join(often, [*HOST, "line"]).select(*ROW_KEY, "words", "at")


def verdicts(measured: DataFrame, found: DataFrame, depleted: float = DEPLETED) -> DataFrame:
    """A narrow row per document: doc_id, ROW_KEY, the measures, base_failed, n_removed (words), n_frequent_lines, kept."""
    removed = found.groupBy(*ROW_KEY).agg(F.sum("words").alias("n_removed"), F.count(F.lit(1)).alias("n_frequent_lines"))
    rows = measured.drop("_lines", "_text_hash", *HOST).join(removed, ROW_KEY, "left").fillna(0, ["n_removed", "n_frequent_lines"])
    left = F.col("n_words") - F.col("n_removed")
    return rows.withColumn("kept", ~F.col("base_failed") & (left >= depleted * F.col("n_words")) & (left >= MIN_WORDS))


def judge(docs: DataFrame, host: str = "source", depleted: float = DEPLETED) -> DataFrame:
    """``verdicts`` of the documents."""
    measured = cut_lineage(measure(docs, host))
    return verdicts(measured, lines_found(measured), depleted)


def keep(docs: DataFrame, host: str = "source", depleted: float = DEPLETED) -> DataFrame:
    """The documents that pass, without their frequent lines; n_chars, where there is such a column, follows the text.

    Texts without frequent lines are unchanged. Rows that agree in doc_id, source and text have the same verdict and lines.
    """
    measured = cut_lineage(measure(docs, host))
    found = cut_lineage(lines_found(measured))
    row = ROW_KEY[:3]
    gone = found.groupBy(*row).agg(F.collect_set("at").alias("_gone"))
    rejected = verdicts(measured, found, depleted).filter(~F.col("kept")).select(*row).distinct()
    # A row for each document that is rejected or shortened.
    decided = cut_lineage(rejected.withColumn("_rejected", F.lit(True)).join(gone, row, "full"))
    numbers = decided.agg(F.sum(1 + F.coalesce(F.size("_gone"), F.lit(0)))).first()[0] or 0
    decided = F.broadcast(decided) if numbers <= BROADCAST_ROWS else decided
    rows = with_row_hash(packed(docs)).join(decided, row, "left").filter(F.col("_rejected").isNull())
    lines = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    shorter = F.array_join(F.transform(stay, lambda at: F.get(lines, at)), "\n")
    rows = rows.select("_doc", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(shorter).alias("_text"), F.col("_gone").isNotNull().alias("_cut"))
    made = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(F.col("_cut"), F.char_length("_text")).otherwise(F.col("_doc.n_chars"))
    kinds = {field.name: field.dataType for field in docs.schema.fields}
    return rows.select(
        *[made[name].cast(kinds[name]).alias(name) if name in made else F.col("_doc").getField(name).alias(name) for name in docs.columns]
    )
