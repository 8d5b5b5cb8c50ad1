"""Gradient boosted regression trees over blocks of binned rows.

The trees are those of Spark's ``GBTRegressor``: its bins, its variance gain, its order of tree categories, its stop rules
of a node and its steps. Only the row sampling draws other rows, and of features that part a node's rows alike, where Spark
decides by rounding, the first is taken. What differs is the cost: a row is a byte per feature and
its residual, a level of a tree is one pass that adds up whole arrays, and boosting goes on from the residuals that
the rounds before have left, so no round is fitted twice. The blocks are kept in memory or on the executors' disks.
"""

from __future__ import annotations

import math
import pickle
import sys
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD, StorageLevel, TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.session import shared_folder

# workers get these functions by value, so they need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a block and of a partition, cells of the sums that a task holds, bytes of sums that the driver takes at once.
BLOCK_ROWS, PARTITION_ROWS, MOST_CELLS, DRIVER_BYTES = 32_768, 8_000_000, 1 << 22, 1 << 26
#: Rounds between two checkpoints of the residuals.
CHECKPOINT_ROUNDS = 20
#: An impurity, or a gain as a share of the mean square, that is rounding alone; share by which equal gains may differ.
ROUNDING, EQUAL = 2.0**-52, 1e-11


@dataclass(frozen=True)
class Bins:
    """Of every feature its thresholds, or its number of categories, and how many bins that makes."""

    thresholds: list[np.ndarray | None]
    widths: list[int]

    def of(self, values: np.ndarray) -> np.ndarray:
        """One row per feature; the bin of a number is the count of thresholds below it."""
        most = max(self.widths, default=1) - 1
        out = np.empty(values.shape[::-1], np.min_scalar_type(most))
        for j, cuts in enumerate(self.thresholds):
            out[j] = values[:, j] if cuts is None else np.searchsorted(cuts, values[:, j], side="left")
        return out


@dataclass
class Node:
    """Count, sum and sum of squares of the sampled residuals, and the split, if there is one."""

    count: float = 0.0
    total: float = 0.0
    squares: float = 0.0
    gain: float = 0.0
    feature: int = -1
    left: np.ndarray | None = None
    children: list[Node] = field(default_factory=list)

    @property
    def mean(self) -> float:
        return self.total / self.count if self.count else 0.0

    @property
    def impurity(self) -> float:
        return max(self.squares / self.count - self.mean**2, 0.0) if self.count else 0.0


@dataclass(frozen=True)
class Tree:
    """The root, the leaves, and the tables that lead a row's bins to its leaf, one per level."""

    root: Node
    leaves: list[Node]
    levels: list[tuple[np.ndarray, np.ndarray]]


def thresholds(values: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` cuts between sorted distinct values, as Spark's trainer sets them."""
    middles = (values[:-1] + values[1:]) / 2
    if len(middles) <= most:
        return middles
    stride, upto, cuts = counts.sum() / (most + 1), counts.cumsum(), []
    target = stride
    for k, middle in enumerate(middles):
        if abs(upto[k] - target) < abs(upto[k + 1] - target):
            cuts.append(middle)
            target += stride
    return np.array(cuts)


def bins_of(regressor: GBTRegressor, vectors: DataFrame) -> tuple[Bins, int]:
    """The bins of all features, and the number of rows.

    Like Spark's trainer it takes the cuts of a number from at least the square of the bins in rows, or from all rows,
    if there are fewer; every feature is a group of value counts, so no more than the cuts reach the driver.
    """
    name, n_rows = regressor.getFeaturesCol(), vectors.count()
    if not n_rows:
        raise ValueError("there are no rows to learn from")
    attributes = vectors.schema[name].metadata["ml_attr"]
    arity = {x["idx"]: len(x["vals"]) for x in attributes["attrs"].get("nominal", [])}
    most = min(regressor.getMaxBins(), n_rows)
    fraction = max(most**2, 10_000) / n_rows
    some = vectors.sample(False, fraction, regressor.getSeed()) if fraction < 1 else vectors
    counted = some.select(F.posexplode(vector_to_array(name)).alias("place", "value")).where(~F.col("place").isin([*arity]))
    counted = counted.groupBy("place", "value").agg(F.count("*").alias("n"))

    def cut(table):
        import pyarrow as pa

        table = table.sort_by("value")
        cuts = thresholds(table["value"].to_numpy(), table["n"].to_numpy(), most - 1)
        return pa.table({"place": table["place"][:1], "cuts": pa.array([cuts], pa.list_(pa.float64()))})

    found = dict(counted.groupBy("place").applyInArrow(cut, "place int, cuts array<double>").collect())
    cuts = [None if j in arity else np.array(found.get(j, [])) for j in range(attributes["num_attrs"])]
    return Bins(cuts, [arity[j] if x is None else len(x) + 1 for j, x in enumerate(cuts)]), n_rows


# -- blocks: (number, learning or judged, bins, residuals, sampled rows, sums of the last tree's leaves) -------------


def _sampled(number: int, n: int, share: float, seed: int, done: int) -> np.ndarray | None:
    """The rows that a round learns from; the same again when a lost block is made again."""
    if share >= 1:
        return None
    return np.random.Generator(np.random.SFC64([seed % 2**64, done, number])).random(n, np.float32) < share


def binned(vectors: DataFrame, label: str, bins: Bins, learning: bool, share: float, seed: int) -> DataFrame:
    """The rows as pickled blocks, one per row."""

    def block(number, parts):
        values, labels = (np.concatenate(x) for x in zip(*parts))
        keep = _sampled(number, len(labels), share, seed, 0) if learning else None
        return pickle.dumps((number, learning, bins.of(values), labels, keep, None), protocol=5)

    def run(batches):
        import pyarrow as pa

        number, parts, held = TaskContext.get().partitionId() << 24, [], 0
        for batch in batches:
            n = batch.num_rows
            if n:
                values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                parts.append((values, batch.column(1).to_numpy(zero_copy_only=False)))
                held += n
            if held >= BLOCK_ROWS:
                yield pa.record_batch([pa.array([block(number, parts)], pa.binary())], ["block"])
                number, parts, held = number + 1, [], 0
        if held:
            yield pa.record_batch([pa.array([block(number, parts)], pa.binary())], ["block"])

    rows = vectors.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"))
    return rows.mapInArrow(run, "block binary")


def _placed(bins: np.ndarray, levels: list) -> np.ndarray:
    """Every row's place behind the last level."""
    n = bins.shape[1]
    at, rows, flat = np.zeros(n, np.intp), np.arange(n), bins.reshape(-1)
    for feature, table in levels:
        one = (feature == feature[0]).all()
        own = bins[feature[0]] if one else flat.take(feature.take(at) * n + rows)
        at = table.reshape(-1).take(at * table.shape[1] + own)
    return at


def _sums(blocks, levels: list, slots: np.ndarray, n_slots: int, widths: list[int]):
    """Counts and sums of the sampled rows per feature, slot and bin, and their squares per slot; one more slot is none."""
    levels = [(feature, table.astype(np.intp)) for feature, table in levels]
    counts, sums = ([np.zeros((n_slots + 1) * w) for w in widths] for _ in range(2))
    squares = np.zeros(n_slots + 1)
    for _, learning, bins, left, keep, _ in blocks:
        if learning:
            at = slots.take(_placed(bins, levels))
            if keep is not None:
                at[~keep] = n_slots
            squares += np.bincount(at, left * left, n_slots + 1)
            for j, w in enumerate(widths):
                cell = at * w + bins[j]
                counts[j] += np.bincount(cell, minlength=(n_slots + 1) * w)
                sums[j] += np.bincount(cell, left, (n_slots + 1) * w)
    yield [*[x[: n_slots * w] for x, w in zip(counts + sums, widths + widths)], squares[:n_slots]]


def _judged(blocks, widths: list[int]):
    """The sums of the root, those of the last tree's leaves, and squares and number of the judged rows."""
    error, leaves = np.zeros(2), [0.0]

    def seen():
        for one in blocks:
            if not one[1]:
                error[:] += one[3] @ one[3], len(one[3])
            elif one[5] is not None:
                leaves[0] = leaves[0] + one[5]
            yield one

    for sums in _sums(seen(), [], np.zeros(1, np.intp), 1, widths):
        yield [*sums, leaves[0], error]


def _stepped(block: tuple, levels: list, steps: np.ndarray, share: float, seed: int, done: int) -> tuple:
    """The block with what a tree leaves of the residuals, and the sums of the rows that it learnt from per leaf."""
    number, learning, bins, left, keep, _ = block
    at, leaves = _placed(bins, levels), None
    if learning:
        own, rest = (at, left) if keep is None else (at[keep], left[keep])
        leaves = np.stack([np.bincount(own, w, len(steps)) for w in (None, rest, rest * rest)])
        keep = _sampled(number, len(left), share, seed, done)
    return number, learning, bins, left - steps.take(at), keep, leaves


def _added(a: list, b: list) -> list:
    return [x + y for x, y in zip(a, b)]


def _added_up(parts: RDD, cells: int) -> list:
    """The sums of all partitions; those that are too many for the driver meet on the executors first."""
    if 16 * cells * parts.getNumPartitions() > DRIVER_BYTES:
        return parts.treeReduce(_added)
    total, *others = parts.collect()
    for other in others:
        total = _added(total, other)
    return total


# -- splits ----------------------------------------------------------------------------------------------------------


def best_splits(nodes: list[Node], found: list, bins: Bins) -> None:
    """Gives every node its sums and, where it gains, the best split, of equal ones the first.

    Features that part the rows alike have the same gain but for rounding, which hangs on the order of the sums.
    """
    a, k = len(nodes), len(bins.widths)
    best, where, lefts = np.full(a, -1.0), np.zeros((a, 2), int), np.zeros((a, 2))
    orders: dict[int, np.ndarray] = {}
    for j, width in enumerate(bins.widths):
        counts, sums = found[j].reshape(a, width), found[k + j].reshape(a, width)
        if j == 0:
            for node, n, s, q in zip(nodes, counts.sum(axis=1), sums.sum(axis=1), found[2 * k]):
                node.count, node.total, node.squares = float(n), float(s), float(q)
        if width < 2:
            continue
        if bins.thresholds[j] is None:
            with np.errstate(invalid="ignore", divide="ignore"):
                orders[j] = np.argsort(np.where(counts > 0, sums / counts, np.inf), axis=1, kind="stable")
            counts, sums = (np.take_along_axis(x, orders[j], axis=1) for x in (counts, sums))
        counts, sums = counts.cumsum(axis=1), sums.cumsum(axis=1)
        n, s, total, whole = counts[:, :-1], sums[:, :-1], counts[:, -1:], sums[:, -1:]
        with np.errstate(invalid="ignore", divide="ignore"):
            gain = n * (total - n) / total**2 * (s / n - (whole - s) / (total - n)) ** 2
        gain = np.where((n > 0) & (n < total), gain, -1.0)
        at = gain.argmax(axis=1)
        gain = gain[np.arange(a), at]
        better, row = gain > np.where(best > 0, best * (1 + EQUAL), best), np.arange(a)
        best[better], where[better] = gain[better], np.stack([np.full(a, j), at], axis=1)[better]
        lefts[better] = np.stack([n[row, at], s[row, at]], axis=1)[better]
    for i, node in enumerate(nodes):
        if not node.count or node.impurity < ROUNDING or best[i] <= ROUNDING * node.squares / node.count:
            continue
        j, at = (int(x) for x in where[i])
        left = np.arange(bins.widths[j]) <= at
        if j in orders:
            left = np.zeros(bins.widths[j], bool)
            left[orders[j][i, : at + 1]] = True
        n, s = (float(x) for x in lefts[i])
        node.gain, node.feature, node.left = float(best[i]), j, left
        node.children = [Node(n, s), Node(node.count - n, node.total - s)]


def _level(frontier: list[Node], bins: Bins) -> tuple[list[Node], tuple[np.ndarray, np.ndarray]]:
    """The nodes behind a level, and the table of their places by node and bin; a node without a split goes on itself."""
    behind: list[Node] = []
    feature = np.array([max(node.feature, 0) for node in frontier], np.intp)
    table = np.empty((len(frontier), max(bins.widths[j] for j in feature)), np.int32)
    for i, node in enumerate(frontier):
        if node.children:
            w = bins.widths[node.feature]
            table[i, :w] = np.where(node.left, len(behind), len(behind) + 1)
            behind += node.children
        else:
            table[i] = len(behind)
            behind.append(node)
    return behind, (feature, table)


def grown(blocks: RDD, root_sums: list, bins: Bins, depth: int) -> Tree:
    """One tree, level by level; the sums of a level are one pass over the blocks, or several where they are too many."""
    root, levels, cells = Node(), [], sum(bins.widths)
    frontier = open_nodes = [root]
    best_splits([root], root_sums, bins)
    if depth == 0:
        root.children = []
    for level in range(1, depth + 1):
        if not any(node.children for node in open_nodes):
            break
        frontier, table = _level(frontier, bins)
        levels.append(table)
        open_nodes = [child for node in open_nodes for child in node.children]
        if level == depth:
            break
        most = max(1, MOST_CELLS // cells)
        for some in (open_nodes[i : i + most] for i in range(0, len(open_nodes), most)):
            place = {id(node): i for i, node in enumerate(some)}
            slots = np.array([place.get(id(node), len(some)) for node in frontier], np.intp)
            n, widths, upto = len(some), bins.widths, list(levels)
            parts = blocks.mapPartitions(lambda part: _sums(part, upto, slots, n, widths))
            best_splits(some, _added_up(parts, n * cells), bins)
    return Tree(root, frontier, levels)


# -- Spark's model ---------------------------------------------------------------------------------------------------


def _doubles(values: np.ndarray):
    """A Java array of doubles, in one transfer."""
    gateway = SparkSession.active().sparkContext._gateway
    out = gateway.new_array(gateway.jvm.double, values.size)
    gateway.jvm.java.nio.ByteBuffer.wrap(values.astype(">f8").tobytes()).asDoubleBuffer().get(out)
    return out


def spark_model(regressor: GBTRegressor, bins: Bins, trees: list[Tree]) -> GBTRegressionModel:
    """The trees as Spark's model; the statistics of all but the first are those of twice the residual."""
    gateway = SparkSession.active().sparkContext._gateway
    ml = gateway.jvm.org.apache.spark.ml
    calculator = gateway.jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator

    def node(one: Node, scale: float):
        sums = calculator(_doubles(np.array([one.count, scale * one.total, scale**2 * one.squares])), int(one.count))
        mean, impurity = float(scale * one.mean), float(scale**2 * one.impurity)
        if not one.children:
            return ml.tree.LeafNode(mean, impurity, sums)
        cuts = bins.thresholds[one.feature]
        if cuts is None:
            of = ml.tree.CategoricalSplit(one.feature, _doubles(np.flatnonzero(one.left)), len(one.left))
        else:
            of = ml.tree.ContinuousSplit(one.feature, float(cuts[one.left.sum() - 1]))
        left, right = (node(child, scale) for child in one.children)
        return ml.tree.InternalNode(mean, impurity, float(scale**2 * one.gain), left, right, of, sums)

    features = len(bins.widths)
    members = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = _doubles(np.array([1.0 if k == 0 else regressor.getStepSize() for k in range(len(trees))]))
    for k, tree in enumerate(trees):
        members[k] = ml.regression.DecisionTreeRegressionModel(node(tree.root, 2.0 if k else 1.0), features)
    model = GBTRegressionModel(ml.regression.GBTRegressionModel(regressor.uid, members, weights, features))
    regressor._copyValues(model)._transfer_params_to_java()
    return model


# -- boosting --------------------------------------------------------------------------------------------------------


def _drop(checkpoint: str | None) -> None:
    """Removes a checkpoint that a later one replaces."""
    if checkpoint:
        sc = SparkSession.active().sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(checkpoint)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def boosted(regressor: GBTRegressor, vectors: DataFrame, judged: DataFrame, settled) -> GBTRegressionModel:
    """``regressor`` fitted on ``vectors``, cut behind the round that ``settled`` names.

    ``settled`` takes the errors on ``judged`` after every round so far and returns the rounds to keep and whether
    boosting ends; it ends with ``maxIter`` rounds at the latest.
    """
    sc = SparkSession.active().sparkContext
    bins, n_rows = bins_of(regressor, vectors)
    share, seed, label = regressor.getSubsamplingRate(), regressor.getSeed(), regressor.getLabelCol()
    waves = max(1, math.ceil(n_rows / PARTITION_ROWS / sc.defaultParallelism))
    stored = binned(vectors, label, bins, True, share, seed).union(binned(judged, label, bins, False, share, seed))
    blocks = stored.repartition(waves * sc.defaultParallelism).rdd.map(lambda row: pickle.loads(row[0]))
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(f"{shared_folder(SparkSession.active())}/shelfcast/checkpoints")
    trees, curve, kept, widths, saved = [], [], 0, bins.widths, None
    sums = _added_up(blocks.mapPartitions(lambda part: _judged(part, widths)), sum(widths))
    if math.isnan(sums[2 * len(widths)][0] + sums[-1][0]):
        raise ValueError(f"{label} must not be null or NaN")
    while True:
        tree = grown(blocks, sums[:-2], bins, regressor.getMaxDepth())
        trees.append(tree)
        # the first tree learns the label; the others twice the residual, the negative gradient
        rate, done, levels = 2 * regressor.getStepSize() if len(trees) > 1 else 1.0, len(trees), tree.levels
        steps = rate * np.array([leaf.mean for leaf in tree.leaves])
        after = blocks.map(lambda block: _stepped(block, levels, steps, share, seed, done))
        after = after.persist(StorageLevel.MEMORY_AND_DISK)
        if done % CHECKPOINT_ROUNDS == 0:
            after.checkpoint()
        sums = _added_up(after.mapPartitions(lambda part: _judged(part, widths)), sum(widths))
        blocks.unpersist()
        blocks = after
        if after.isCheckpointed():
            _drop(saved)
            saved = after.getCheckpointFile()
        for node, n, s, q in zip(tree.leaves, *sums[-2]):
            node.count, node.total, node.squares = float(n), float(s), float(q)
        error, n = sums[-1]
        curve.append(error / n if n else math.nan)
        kept, ends = settled(curve)
        if ends or done == regressor.getMaxIter():
            break
    blocks.unpersist()
    _drop(saved)
    return spark_model(regressor, bins, trees[:kept])
