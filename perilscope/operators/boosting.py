"""Boosted trees grown on counted cells: the learner of Spark's ``GBTClassifier`` (logistic loss, variance splits, mean leaves).

A tree only sees in which of at most ``BINS`` intervals a feature lies. Rows with the same intervals, label and weight are one cell with
a number of copies, and a round draws from the copies of a cell what it would draw from its rows. Cells are dealt by hash into blocks
that stay with the executors; a level of the trees of all classes is one job, which returns histograms. The draws follow the cells, not
the layout of the rows.
"""

from __future__ import annotations

import math
import pickle
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import Identifiable
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perilscope.operators.prefix import running_sums
from perilscope.session import cut_lineage, shared_folder

BINS = 32
SORTED = 100_000  # values of a feature that one task may sort
BLOCK = 8_192
BLOCKS_PER_TASK = 64
PACK = 1024  # features whose bins have no more combinations than this share a histogram
RESTART = 25  # rounds after which margins are computed from all trees again, so that lineage stays short
EPSILON = 2.0**-52
STATS = 4  # weight, weighted sum, weighted squares, rows; the last two are only counted per node and for the children of the last level


@dataclass
class Shared:
    """Features by the histogram that they share: ``packs`` lists them, ``stride`` and ``width`` tell a feature's bin from the shared code."""

    packs: list[list[int]]
    width: np.ndarray
    pack: np.ndarray
    stride: np.ndarray

    def shapes(self) -> list[list[int]]:
        return [[int(self.width[j]) for j in pack] for pack in self.packs]

    def sizes(self) -> list[int]:
        return [math.prod(shape) for shape in self.shapes()]


@dataclass
class Tree:
    """Nodes by number: children of a node are ``left`` and ``left + 1``; a leaf has feature -1."""

    feature: np.ndarray
    place: np.ndarray
    left: np.ndarray
    level: np.ndarray
    gain: np.ndarray
    stats: np.ndarray

    @property
    def value(self) -> np.ndarray:
        w = self.stats[:, 0]
        return np.divide(self.stats[:, 1], w, out=np.zeros(len(w)), where=w > 0)

    def route(self, packed: np.ndarray, shared: Shared, levels: int) -> np.ndarray:
        """The node that each cell reaches after so many levels."""
        cells = np.arange(packed.shape[1])
        at = np.zeros(len(cells), dtype=np.intp)
        if not levels:
            return at
        feature = np.maximum(self.feature, 0)
        codes = np.arange(max(shared.sizes()))
        further = codes // shared.stride[feature][:, None] % shared.width[feature][:, None] > self.place[:, None]
        then = np.where(self.feature[:, None] >= 0, self.left[:, None] + further, np.arange(len(feature))[:, None])
        pack = shared.pack[feature]
        for _ in range(levels):
            at = then[at, packed[pack[at], cells]]
        return at


@dataclass
class Block:
    """Cells of one hash value: shared codes (packs x cells), class number, weight and copies, margins and draws (classes x cells)."""

    number: int
    packed: np.ndarray
    kind: np.ndarray
    weight: np.ndarray
    copies: np.ndarray
    margin: np.ndarray
    drawn: np.ndarray | None = None

    def target(self, k: int) -> np.ndarray:
        return np.where(self.kind == k, 1.0, -1.0)

    def goal(self, k: int, first: bool) -> np.ndarray:
        """What the next tree aims at: the label at first, then the slope of the loss."""
        target = self.target(k)
        return target if first else 4.0 * target / (1.0 + np.exp(2.0 * target * self.margin[k]))


def fit(
    train: DataFrame, learner: GBTClassifier, classes: Sequence[float], weight: str | None = None, copies: str | None = None
) -> list[GBTClassificationModel]:
    """One model per class, that class against all others, with the parameters of the learner. ``copies``: a row stands for so many."""
    spark, label = train.sparkSession, learner.getLabelCol()
    one = F.lit(1.0)
    heavy = _checked(F.col(weight).cast("double"), F.col(weight) >= 0, "weights must not be negative or null") if weight else one
    rows = train.select(
        vector_to_array(learner.getFeaturesCol()).alias("x"), F.coalesce(F.col(label).cast("double"), F.lit(-1.0)).alias("y"),
        heavy.alias("w"), (F.col(copies) if copies else F.lit(1)).cast("bigint").alias("n"),
    )
    thresholds = split_points(rows)
    cells = cut_lineage(_cells(rows, thresholds))
    trees = _grow(cells, _shared(thresholds), learner, list(classes))
    return _models(spark, learner, thresholds, trees)


def _checked(value: Column, right: Column, said: str) -> Column:
    return F.when(right, value).otherwise(F.raise_error(F.lit(said)).cast("double"))


def binary_label(label: str) -> Column:
    return _checked(F.col(label).cast("double"), F.col(label).isin(0, 1), "labels must be 0 or 1")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _value_weights(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch)
        w = batch.column(1).to_numpy(zero_copy_only=False)
        found = [np.unique(column, return_inverse=True) for column in x.T]
        features = np.repeat(np.arange(len(found), dtype=np.int32), [len(values) for values, _ in found])
        weights = [np.bincount(at.ravel(), w, len(values)) for values, at in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array(features), pa.array(np.concatenate([values for values, _ in found])), pa.array(np.concatenate(weights))],
            names=["feature", "value", "weight"],
        )


def split_points(rows: DataFrame) -> list[np.ndarray]:
    """Ascending thresholds per feature: between all values where there are few, else between intervals of equal weight. Exact."""
    found = rows.select("x", (F.col("w") * F.col("n")).alias("w")).mapInArrow(_value_weights, "feature int, value double, weight double")
    counted = cut_lineage(found.groupBy("feature", "value").agg(F.sum("weight").alias("weight")))
    totals = counted.groupBy("feature").agg(F.sum("weight").alias("total"), F.count(F.lit(1)).alias("values"))
    if (totals.agg(F.max("values")).first()[0] or 0) <= SORTED:
        upto = F.sum("weight").over(Window.partitionBy("feature").orderBy("value"))
        summed = counted.withColumn("upto", upto).join(F.broadcast(totals), "feature")
    else:
        summed = running_sums(counted, ["feature"], "value", {"upto": F.col("weight")}).join(F.broadcast(totals), "feature")
    part = F.floor((F.col("upto") - F.col("weight") / 2) / F.col("total") * BINS)
    part = F.when(F.col("values") <= BINS, F.col("value")).otherwise(F.greatest(F.least(part, F.lit(BINS - 1)), F.lit(0)).cast("double"))
    parts = summed.groupBy("feature", part.alias("part")).agg(F.min("value").alias("low"), F.max("value").alias("high"))
    intervals: dict[int, list] = {}
    for row in parts.orderBy("feature", "low").collect():  # at most BINS rows per feature
        intervals.setdefault(row["feature"], []).append(row)
    if not intervals:
        raise ValueError("no rows to train on")
    return [
        np.array([(a["high"] + b["low"]) / 2 for a, b in zip(of, of[1:])], dtype=float) for _, of in sorted(intervals.items())
    ]


def _cells(rows: DataFrame, thresholds: list[np.ndarray]) -> DataFrame:
    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                bins = np.empty(x.shape, dtype=np.uint8)
                for j, cuts in enumerate(thresholds):
                    bins[:, j] = np.searchsorted(cuts, x[:, j], side="left")
                keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.shape[1]), len(x), [None, pa.py_buffer(bins.tobytes())])
                yield pa.RecordBatch.from_arrays([keys.cast(pa.binary()), *batch.columns[1:]], names=["key", "y", "w", "n"])

    found = rows.mapInArrow(binned, "key binary, y double, w double, n bigint")
    return found.groupBy("key", "y", "w").agg(F.sum("n").alias("n"))


def _shared(thresholds: list[np.ndarray]) -> Shared:
    width = np.array([len(cuts) + 1 for cuts in thresholds])
    packs: list[list[int]] = []
    sizes: list[int] = []
    for j in sorted(range(len(width)), key=lambda j: -width[j]):
        at = next((k for k, size in enumerate(sizes) if size * width[j] <= PACK), len(packs))
        if at == len(packs):
            packs.append([])
            sizes.append(1)
        packs[at].append(j)
        sizes[at] *= int(width[j])
    pack, stride = np.zeros(len(width), dtype=np.intp), np.ones(len(width), dtype=np.intp)
    for k, members in enumerate(packs):
        for i, j in enumerate(members):
            pack[j], stride[j] = k, math.prod(int(width[other]) for other in members[i + 1 :])
    return Shared(packs, width, pack, stride)


def _small(numbers: np.ndarray) -> np.ndarray:
    return numbers.astype(np.min_scalar_type(numbers.max(initial=0)))


def _blocks(cells: DataFrame, count: int, shared: Shared, classes: list[float]):
    """The cells as an RDD of blocks; a task has several."""
    blocks = max(math.ceil(count / BLOCK), 1)
    tasks = min(blocks, max(cells.sparkSession.sparkContext.defaultParallelism, math.ceil(blocks / BLOCKS_PER_TASK)))
    kinds = np.array(classes)

    def made(number: int, part: pa.Table) -> pa.RecordBatch:
        bins = np.frombuffer(b"".join(part.column("key").to_pylist()), dtype=np.uint8).reshape(part.num_rows, -1).astype(np.intp)
        y, w, n = (part.column(c).to_numpy() for c in ("y", "w", "n"))
        packed = np.stack([bins[:, pack] @ shared.stride[pack] for pack in shared.packs]).astype(np.uint16)
        hit = y[:, None] == kinds[None, :]
        kind = np.where(hit.any(axis=1), hit.argmax(axis=1), -1).astype(np.int16)
        block = Block(number, packed, kind, w, _small(n), np.zeros((len(kinds), len(y))))
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block, protocol=5)], pa.binary())], names=["block"])

    def dealt(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in parts:  # sorted by block; a block may span batches
            if not batch.num_rows:
                continue
            rest = pa.concat_tables([*([rest] if rest is not None else []), pa.Table.from_batches([batch])])
            numbers = rest.column("block").to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(numbers)) + 1)]
            for a, b in zip(starts, starts[1:]):
                yield made(int(numbers[a]), rest.slice(a, b - a))
            rest = rest.slice(starts[-1])
        if rest is not None:
            yield made(int(rest.column("block")[0].as_py()), rest)

    hashed = cells.withColumn("block", F.pmod(F.xxhash64("key", "y", "w"), F.lit(blocks)).cast("int"))
    hashed = hashed.repartitionById(tasks, F.pmod("block", F.lit(tasks)).cast("int")).sortWithinPartitions("block", "key", "y", "w")
    return hashed.mapInArrow(dealt, "block binary").rdd.map(lambda row: pickle.loads(row[0]))


def _grow(cells: DataFrame, shared: Shared, learner: GBTClassifier, classes: list[float]) -> list[list[Tree]]:
    """Trees by round and class."""
    rounds, depth, step = learner.getMaxIter(), learner.getMaxDepth(), learner.getStepSize()
    rate, seed = learner.getSubsamplingRate(), learner.getSeed() % 2**63
    start = _blocks(cells, cells.count(), shared, classes).persist(StorageLevel.MEMORY_AND_DISK)
    now, done = start, []
    for number in range(rounds):
        restart = number % RESTART == 0
        since = done if restart else done[-1:]
        ready = (start if restart else now).map(_advance(since, number, shared, depth, step, rate, seed)).persist(StorageLevel.MEMORY_AND_DISK)
        grown = [_root() for _ in classes]
        for level in range(depth):
            fresh = [np.flatnonzero(tree.level == level) for tree in grown]
            if not any(len(nodes) for nodes in fresh):
                break
            sums = _added(ready.mapPartitions(_histograms(grown, fresh, level, shared, number == 0, level == depth - 1)))
            for k, tree in enumerate(grown):
                grown[k] = _split(tree, fresh[k], *sums[2 * k : 2 * k + 2], shared)
        if now is not start:
            now.unpersist()
        now = ready
        done.append(grown)
    now.unpersist()
    start.unpersist()
    return done


def _root() -> Tree:
    return Tree(np.array([-1]), np.array([0]), np.array([0]), np.array([0]), np.array([0.0]), np.zeros((1, STATS)))


def _advance(trees: list[list[Tree]], number: int, shared: Shared, depth: int, step: float, rate: float, seed: int) -> Callable[[Block], Block]:
    """Margins with these trees, the last ones before round ``number``, and the copies that this round sees."""

    def advance(b: Block) -> Block:
        margin = b.margin.copy()
        for i, grown in enumerate(trees, number - len(trees)):
            for k, tree in enumerate(grown):
                margin[k] += (step if i else 1.0) * tree.value[tree.route(b.packed, shared, depth)]
        drawn = np.broadcast_to(b.copies, margin.shape)
        if rate < 1.0:
            drawn = np.random.default_rng([seed, number, b.number]).binomial(drawn, rate)
        return Block(b.number, b.packed, b.kind, b.weight, b.copies, margin, _small(drawn))

    return advance


def _histograms(grown: list[Tree], fresh: list[np.ndarray], level: int, shared: Shared, first: bool, last: bool):
    """Per class two arrays: (fresh nodes, STATS) and (fresh nodes, bins of all features, stats)."""

    def histograms(blocks: Iterable[Block]) -> Iterator[list[np.ndarray]]:
        kept = STATS if last else 2
        shapes, sizes = shared.shapes(), shared.sizes()
        slots = [np.full(len(tree.feature), len(nodes)) for tree, nodes in zip(grown, fresh)]
        for slot, nodes in zip(slots, fresh):
            slot[nodes] = np.arange(len(nodes))
        whole = [np.zeros((STATS, len(nodes) + 1)) for nodes in fresh]
        sums = [[np.zeros((kept, (len(nodes) + 1) * size)) for size in sizes] for nodes in fresh]
        for b in blocks:
            for k, tree in enumerate(grown):
                if not len(fresh[k]):
                    continue
                slot = slots[k][tree.route(b.packed, shared, level)]
                goal, w = b.goal(k, first), b.weight * b.drawn[k]
                parts = (w, w * goal, w * goal**2, b.drawn[k].astype(float))
                for s, part in enumerate(parts):
                    whole[k][s] += np.bincount(slot, part, len(fresh[k]) + 1)
                for p, size in enumerate(sizes):
                    at = slot * size + b.packed[p]
                    for s in range(kept):
                        sums[k][p][s] += np.bincount(at, parts[s], sums[k][p].shape[1])
        out = []
        for k, nodes in enumerate(fresh):
            of_feature: list[np.ndarray] = [np.empty(0)] * len(shared.width)
            for p, pack in enumerate(shared.packs):
                cube = sums[k][p].reshape(kept, len(nodes) + 1, *shapes[p])[:, :-1]
                for i, j in enumerate(pack):
                    of_feature[j] = cube.sum(axis=tuple(2 + other for other in range(len(pack)) if other != i))
            out += [whole[k][:, :-1].T, np.concatenate(of_feature, axis=2).transpose(1, 2, 0)]
        yield out

    return histograms


def _added(parts) -> list[np.ndarray]:
    add = lambda a, b: [x + y for x, y in zip(a, b)]
    if parts.getNumPartitions() > BLOCKS_PER_TASK:
        return parts.treeReduce(add)
    total, *others = parts.collect()  # histograms of each task
    for more in others:
        total = add(total, more)
    return total


def _over(top: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    return np.divide(top, bottom, out=np.zeros(np.broadcast(top, bottom).shape), where=bottom > 0)


def _impurity(stats: np.ndarray) -> np.ndarray:
    """Variance, from weight, sum and squares."""
    w, s, q = stats[..., 0], stats[..., 1], stats[..., 2]
    return _over(q - _over(s * s, w), w)


def _split(tree: Tree, fresh: np.ndarray, whole: np.ndarray, sums: np.ndarray, shared: Shared) -> Tree:
    """The tree with its fresh nodes split where that lowers the variance most; both sides have a row at least."""
    stats = tree.stats.copy()
    stats[fresh] = whole
    ends = np.cumsum(shared.width)
    parts = np.split(sums, ends[:-1], axis=1)
    lower = np.concatenate([np.cumsum(part, axis=1) for part in parts], axis=1)
    zero = np.zeros((len(fresh), 1))
    rest = np.concatenate([piece for part in parts for piece in (np.cumsum(part[:, :0:-1, 0], axis=1)[:, ::-1], zero)], axis=1)
    total = lower[:, ends[0] - 1][:, None, :]
    upper = total - lower
    fits = (lower[..., 0] > 0) & (rest > 0)
    mean = _over(total[..., 1], total[..., 0])
    won = _over(_over(lower[..., 1] ** 2, lower[..., 0]) + _over(upper[..., 1] ** 2, rest) - total[..., 1] * mean, total[..., 0])
    best = np.argmax(np.where(fits, won, -np.inf), axis=1) if len(fresh) else []
    feature, place, left, level, gain = (part.tolist() for part in (tree.feature, tree.place, tree.left, tree.level, tree.gain))
    children = []
    impure = np.abs(_impurity(whole)) >= EPSILON
    for i, (node, at) in enumerate(zip(fresh.tolist(), best)):
        if not (impure[i] and fits[i, at] and won[i, at] > EPSILON * mean[i, 0] ** 2):
            continue
        j = int(np.searchsorted(ends, at, side="right"))
        feature[node], place[node], left[node], gain[node] = j, int(at - ends[j] + shared.width[j]), len(feature), float(won[i, at])
        for side in (lower[i, at], upper[i, at]):
            children.append(np.concatenate([side, np.zeros(STATS - len(side))]))
        feature += [-1, -1]
        place += [0, 0]
        left += [0, 0]
        level += [level[node] + 1] * 2
        gain += [0.0, 0.0]
    return Tree(*(np.array(part) for part in (feature, place, left, level, gain)), stats=np.vstack([stats, *children]))


def _models(spark: SparkSession, learner: GBTClassifier, thresholds: list[np.ndarray], trees: list[list[Tree]]) -> list[GBTClassificationModel]:
    """The trees of each class as Spark's model: a stored model of bare roots whose table of nodes is written anew."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway  # type: ignore[attr-defined]
    ml = jvm.org.apache.spark.ml
    bare = ml.tree.LeafNode(0.0, 0.0, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(gateway.new_array(jvm.double, 3), 0))
    roots, shares = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees)), gateway.new_array(jvm.double, len(trees))
    for number in range(len(trees)):
        roots[number] = ml.regression.DecisionTreeRegressionModel(Identifiable().uid, bare, len(thresholds))
        shares[number] = learner.getStepSize() if number else 1.0
    uid = f"GBTClassifier_{Identifiable().uid}"
    made = ml.classification.GBTClassificationModel(uid, roots, shares, len(thresholds), 2)
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    learner._copyValues(GBTClassificationModel(made)).write().save(path)  # type: ignore[attr-defined]
    kind = spark.read.parquet(f"{path}/data").schema
    found = []
    for k in range(len(trees[0])):
        rows = [row for number, grown in enumerate(trees) for row in _nodes(number, grown[k], thresholds)]
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
        found.append(GBTClassificationModel.load(path))
    return found


def _nodes(number: int, tree: Tree, thresholds: list[np.ndarray]) -> Iterator[tuple]:
    """Rows of Spark's table of nodes: treeID and (id, prediction, impurity, impurityStats, rawCount, gain, children, split)."""
    impurity, value = _impurity(tree.stats), tree.value
    for at, j in enumerate(tree.feature.tolist()):
        left, right = (int(tree.left[at]), int(tree.left[at]) + 1) if j >= 0 else (-1, -1)
        split = (j, [float(thresholds[j][tree.place[at]])], -1) if j >= 0 else (-1, [], -1)
        known = (tree.stats[at, :3].tolist(), int(tree.stats[at, 3]))
        yield number, (at, float(value[at]), float(impurity[at]), *known, float(tree.gain[at]) if j >= 0 else -1.0, left, right, split)
