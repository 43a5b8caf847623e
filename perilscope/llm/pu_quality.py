"""Quality scores learned from positives and unlabelled text.

Only documents marked good (label 1) are used as labels; everything else is unlabelled web text, good and bad mixed.

1. Each text becomes a few numbers about its letters, words and lines; their means and spreads are taken over all documents.
2. A first model tells trusted positives from unlabelled text. Its scores, binned over all rows, give the class prior: above a
   threshold that keeps only good text, the unlabelled share is the prior times the positive share.
3. The classifier minimises the non-negative unbiased risk
       prior x E_pos[loss(z)] + max(0, E_unl[loss(-z)] - prior x E_pos[loss(-z)])
   with the logistic loss and a ridge. That is the greater of two convex functions. Where the unbiased risk has its minimum at a
   second part of 0 or more, that is the answer; else the part's weight is lowered from 1 until the part is 0 at the minimum, or its weight is.

Both fits are Newton iterations. A step needs losses, gradients and second derivatives summed over trusted positives and over unlabelled
rows: one pass over the stored features, partial sums per task, added up in a shuffle. Nothing is sampled, and the driver gets a few
numbers per pair of features. Rows whose crc32(doc_id) mod 4 is 2 take no part in it.

Defined results: NULL and empty texts are scored like any other, as texts of no words; a doc_id labelled both ways is no
trusted positive; rows without doc_id are unlabelled and not held out; without any positive, or any document, the score is the
constant 0.5; repeated rows score alike. Columns other than doc_id and text are no input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilscope.llm.wordhash import slices
from perilscope.session import cut_lineage

NEWTON_STEPS = 40
FLAT = 1e-6  # length of a gradient that counts as none
SHARES = 40  # tried for the second part
ZERO = 1e-5  # a second part, or a share of it, this small counts as none
RIDGE_ROWS = 3.0  # the ridge weighs as much as so many positives
BINS = 200
LEAST_SHARE = 0.1  # of the positives above a threshold that may give the prior
THRESHOLD = 0.7

NAMES = (
    "words_log", "word_bytes", "symbols", "shouts", "bars", "upper", "digits", "twins", "variety", "stops", "commas", "lines",
    "repeats", "short", "top_word", "marked", "punctuation_only", "line_repeats",
)
SYMBOLS = b"#*$%&|<>@^~_=+\\{}[]"
MARKS = np.zeros((8, 256), dtype=bool)
for row, chars in enumerate((SYMBOLS, b"!", b"|", b"0123456789", b".?!", b",;:", b"\n")):
    MARKS[row, list(chars)] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = True
SOLID_MARK = MARKS[0] | MARKS[1]


def between(counts: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Sums of a 0/1 array between borders."""
    sums = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=sums[1:])
    return np.diff(sums[borders]).astype(np.float64)


def measures(part, borders: np.ndarray) -> np.ndarray:
    """A row of ``NAMES`` for each text of a slice; borders: its byte offsets."""
    data, texts = part.data, len(part.bounds) - 1
    n = np.diff(part.bounds).astype(np.float64)
    least = np.maximum(n, 1)
    symbols, shouts, bars, digits, stops, commas, lines = (between(MARKS[k][data], borders) for k in range(7))
    wide = np.zeros(len(data), dtype=bool)  # capitals of Latin-1, two bytes each
    wide[:-1] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    upper = between(UPPER[data] | wide, borders)
    letters = between(LETTER[data] | (data == 0xC3), borders)
    sizes = (part.ends - part.starts).astype(np.float64)
    word_bytes = between(part.ends - part.starts, part.bounds)
    short = between(sizes <= 3, part.bounds)
    marked = between(SOLID_MARK[data[part.ends - 1]] if len(data) else np.zeros(0, bool), part.bounds)
    bare = between(SOLID_MARK[data[part.starts]] if len(data) else np.zeros(0, bool), part.bounds)
    same = np.zeros(len(part.hashes), dtype=bool)
    same[1:] = part.hashes[1:] == part.hashes[:-1]
    twins = between(same, part.bounds)
    distinct, top, repeats, line_repeats = (np.zeros(texts) for _ in range(4))
    runs = part.runs(3)
    ends_line = np.flatnonzero(data == 10)
    for t, (a, b) in enumerate(zip(part.bounds[:-1].tolist(), part.bounds[1:].tolist())):
        if b > a:
            counts = np.unique(part.hashes[a:b], return_counts=True)[1]
            distinct[t], top[t] = len(counts), counts.max()
        if b - a > 3:
            repeats[t] = 1 - len(np.unique(runs[a : b - 2])) / (b - 2 - a)
        if b > a and lines[t]:
            cut = ends_line[np.searchsorted(ends_line, borders[t]) : np.searchsorted(ends_line, borders[t + 1])]
            first = np.unique(np.concatenate([[a], np.searchsorted(part.starts, cut)]))
            first = first[first < b]
            size = np.diff(np.append(first, b))
            whole = part.spans(first, size)
            line_repeats[t] = 1 - len(np.unique(whole)) / len(whole)
    columns = (
        np.log1p(n), word_bytes / least, np.sqrt(symbols / least), np.sqrt(shouts / least), np.sqrt(bars / least),
        np.sqrt(upper / np.maximum(letters, 1)), np.sqrt(digits / least), np.sqrt(twins / least),
        np.log1p(distinct) / np.log1p(least), np.sqrt(stops / least), np.sqrt(commas / least), np.sqrt(lines / least),
        np.sqrt(repeats), short / least, top / least, np.sqrt(marked / least), np.sqrt(bare / least), np.sqrt(line_repeats),
    )
    return np.column_stack(columns) if texts else np.zeros((0, len(NAMES)))


def features(docs: DataFrame) -> DataFrame:
    """doc_id and a double column for each of ``NAMES``; a row per row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros((0, len(NAMES)))]
            column = batch.column(batch.schema.get_field_index("text"))
            for part in slices(column):
                found.append(measures(part, part.borders))
            table = np.concatenate(found)
            arrays = [batch.column(0), *[pa.array(table[:, k]) for k in range(len(NAMES))]]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *NAMES])

    schema = "doc_id bigint, " + ", ".join(f"{name} double" for name in NAMES)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(work, schema)


@dataclass(frozen=True)
class Model:
    """Standardisation of each feature, then weights of it and its square, an offset, and the class prior used."""

    means: tuple[float, ...]
    spreads: tuple[float, ...]
    weights: tuple[float, ...]
    offset: float
    prior: float

    def margin(self) -> Column:
        """The log odds as an expression on the feature columns."""
        z = F.lit(self.offset)
        half = len(NAMES)
        for k, name in enumerate(NAMES):
            x = limited((F.col(name) - self.means[k]) / self.spreads[k])
            z = z + self.weights[k] * x + self.weights[half + k] * x * x
        return z

    def score(self) -> Column:
        return 1 / (1 + F.exp(-self.margin()))


def limited(x: Column) -> Column:
    return F.greatest(F.least(x, F.lit(4.0)), F.lit(-4.0))


def design(rows: np.ndarray, means: np.ndarray, spreads: np.ndarray) -> np.ndarray:
    x = np.clip((rows - means) / spreads, -4, 4)
    return np.column_stack([x, x * x])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def with_one(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x))])


@dataclass(frozen=True)
class Sums:
    """Over one group of rows, at some weights: rows, losses of z and of -z, sums of x, of s x and of s (1 - s) x x', s = sigmoid(z)."""

    rows: float
    loss: float
    loss_back: float
    x: np.ndarray
    sx: np.ndarray
    curve: np.ndarray

    @staticmethod
    def of(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        """All of them in the rows of one table, so that tables add up."""
        z = x @ w
        s = sigmoid(z)
        heads = np.zeros((3, len(w)))
        heads[:, 0] = len(x), np.logaddexp(0, -z).sum(), np.logaddexp(0, z).sum()
        return np.vstack([heads, x.sum(axis=0), s @ x, (x * (s * (1 - s))[:, None]).T @ x])

    @staticmethod
    def read(table: np.ndarray) -> Sums:
        return Sums(*table[:3, 0], table[3], table[4], table[5:])


#: Weights to the sums over positives and over unlabelled rows.
Passes = Callable[[np.ndarray], tuple[Sums, Sums]]


def spark_passes(rows: DataFrame, means: np.ndarray, spreads: np.ndarray) -> Passes:
    """``rows``: the features and ``positive``; every row counts as unlabelled, positives count for themselves as well."""
    size = 2 * len(NAMES) + 1

    def at(w: np.ndarray) -> tuple[Sums, Sums]:
        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2 * (size + 5), size))
            for batch in batches:
                table = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(len(NAMES))])
                x = with_one(design(table, means, spreads))
                positive = batch.column(len(NAMES)).to_numpy(zero_copy_only=False).astype(bool)
                total += np.vstack([Sums.of(x[positive], w), Sums.of(x, w)])
            arrays = [pa.array(np.arange(len(total))), *(pa.array(total[:, k]) for k in range(size))]
            yield pa.RecordBatch.from_arrays(arrays, names=["i", *(f"c{k}" for k in range(size))])

        schema = ", ".join(["i bigint", *(f"c{k} double" for k in range(size))])
        parts = rows.select(*NAMES, "positive").mapInArrow(partial, schema)
        added = parts.groupBy("i").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(size)]).collect()
        table = np.zeros((2 * (size + 5), size))
        for row in added:  # a row per sum
            table[row["i"]] = row[1:]
        return Sums.read(table[: size + 5]), Sums.read(table[size + 5 :])

    return at


Objective = Callable[[Sums, Sums], tuple[float, np.ndarray, np.ndarray]]


def minimise(passes: Passes, objective: Objective, ridge: float, w: np.ndarray) -> tuple[np.ndarray, Sums, Sums]:
    """Newton steps from w, halved while they don't lower the objective; the sums are those at the result."""
    step, before, best = None, np.inf, None
    for _ in range(NEWTON_STEPS):
        p, u = passes(w)
        value, gradient, curve = objective(p, u)
        value, gradient, curve = value + ridge / 2 * w @ w, gradient + ridge * w, curve + ridge * np.eye(len(w))
        if best is None or value <= before + 1e-12:
            best, before = (w, p, u), value
            if np.linalg.norm(gradient) < FLAT:
                break
            step = -np.linalg.solve(curve, gradient)
        else:
            step = step / 2
            if np.linalg.norm(step) < 1e-10:
                break
        w = best[0] + step
    return best


def contrast(p: Sums, u: Sums) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic loss of positive against unlabelled, both weighing the same."""
    value = p.loss / p.rows + u.loss_back / u.rows
    return value, (p.sx - p.x) / p.rows + u.sx / u.rows, p.curve / p.rows + u.curve / u.rows


def negative_part(p: Sums, u: Sums, prior: float) -> float:
    return u.loss_back / u.rows - prior * p.loss_back / p.rows


def weighted_risk(prior: float, share: float) -> Objective:
    """prior x E_pos[loss(z)] + share x (E_unl[loss(-z)] - prior x E_pos[loss(-z)]); convex for shares of 0 to 1."""

    def objective(p: Sums, u: Sums) -> tuple[float, np.ndarray, np.ndarray]:
        value = prior * p.loss / p.rows + share * negative_part(p, u, prior)
        gradient = prior * ((1 - share) * p.sx - p.x) / p.rows + share * u.sx / u.rows
        return value, gradient, prior * (1 - share) * p.curve / p.rows + share * u.curve / u.rows

    return objective


def fit_contrast(passes: Passes, ridge: float, size: int) -> np.ndarray:
    return minimise(passes, contrast, ridge, np.zeros(size))[0]


def fit_non_negative(passes: Passes, prior: float, ridge: float, size: int) -> np.ndarray:
    """Weights of least non-negative unbiased risk.

    The second part at the minimum falls as its share grows. Its derivative by the share follows from the sums at hand, so the share is
    found by Newton steps too, kept inside the shares known to be too low and too high.
    """
    share, low, high, w = 1.0, 0.0, 1.0, np.zeros(size)
    for _ in range(SHARES):
        w, p, u = minimise(passes, weighted_risk(prior, share), ridge, w)
        part = negative_part(p, u, prior)
        if abs(part) < ZERO or (part > 0 and share == 1.0) or high < ZERO:
            break
        low, high = (share, high) if part > 0 else (low, share)
        rise = u.sx / u.rows - prior * p.sx / p.rows
        along = -np.linalg.solve(weighted_risk(prior, share)(p, u)[2] + ridge * np.eye(size), rise)
        wanted = share - part / (rise @ along)
        wanted = wanted if low < wanted < high else (low + high) / 2
        share, w = wanted, w + (wanted - share) * along
    return w


def estimated_prior(rows: DataFrame, contrast: Model) -> float:
    """The ratio of unlabelled to positive shares above the threshold where it is surely low, over binned scores of all rows.

    Thresholds are compared by the ratio plus its sampling error, so that few rows don't give a chance minimum.
    """
    bins = F.floor(contrast.score() * (BINS - 1e-9)).cast("int")
    counts = rows.groupBy(bins.alias("bin")).agg(
        F.count(F.lit(1)).alias("u"), F.sum(F.col("positive").cast("bigint")).alias("p")
    ).collect()
    u, p = np.zeros(BINS), np.zeros(BINS)
    for row in counts:  # one row per bin
        u[row["bin"]], p[row["bin"]] = row["u"], row["p"]
    above_u, above_p = np.cumsum(u[::-1]) / max(u.sum(), 1), np.cumsum(p[::-1]) / max(p.sum(), 1)
    usable = above_p >= LEAST_SHARE
    if not usable.any():
        return 0.5
    above_u, above_p = above_u[usable], above_p[usable]
    error = (1 / np.sqrt(max(u.sum(), 1)) + 1 / np.sqrt(max(p.sum(), 1))) / above_p
    best = np.argmin(above_u / above_p + error)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(table: DataFrame, labels: DataFrame) -> Model | None:
    """A model from stored features and labels (doc_id, quality); None without any positive."""
    trusted = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1")
    known = table.filter(~held_out(F.col("doc_id")))
    rows = known.join(trusted.select("doc_id", F.lit(True).alias("positive")), "doc_id", "left")
    rows = cut_lineage(rows.select(*NAMES, F.coalesce("positive", F.lit(False)).alias("positive")))
    stats = table.agg(*[f(name).alias(f"{f.__name__}_{name}") for name in NAMES for f in (F.avg, F.stddev_pop)]).first()
    means = np.array([stats[f"avg_{name}"] or 0.0 for name in NAMES])
    spreads = np.array([max(stats[f"stddev_pop_{name}"] or 0.0, 1e-6) for name in NAMES])

    n_positive = rows.filter("positive").count()
    if not n_positive:
        return None
    passes, ridge, size = spark_passes(rows, means, spreads), RIDGE_ROWS / n_positive, 2 * len(NAMES) + 1
    build = lambda w, prior: Model(tuple(means.tolist()), tuple(spreads.tolist()), tuple(w[:-1].tolist()), float(w[-1]), prior)
    prior = estimated_prior(rows, build(fit_contrast(passes, ridge, size), 0.5))
    return build(fit_non_negative(passes, prior, ridge, size), prior)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: good), predicted (1 if the score is 0.7 or more); a row per row."""
    table = cut_lineage(features(docs))
    model = train(table, labels)
    value = model.score() if model else F.lit(0.5)
    scored = table.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), value.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
