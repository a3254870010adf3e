"""Forests and boosted trees from histograms of binned rows, as models of ``pyspark.ml``.

Spark's learners visit every row as an object, for each tree and level. Here rows are binned once into blocks of
bytes, which numpy descends and counts whole; the folds of a cross-validation are grown together, over the same blocks.
What is learned follows Spark: the same splits to choose from, bags, subsets of the features for each node, gain of the
variance, least rows and gain, pseudo-residuals and weights. Random draws differ from Spark's and follow seed, tree and block.

Only counts travel: for each node, feature of its subset and bin the rows, their sum and, last, their squares. They are
made for ``HIST_BYTES`` of nodes at a time; what is large is merged and judged in the executors.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.functions.columns import quoted

BLOCK_ROWS = 1 << 16
HIST_BYTES = 32 << 20  # of counts that a task holds
DRIVER_BYTES = 32 << 20  # of counts, of all tasks, that are merged at the driver
SAMPLE = 10_000  # rows that splits are found in, as in Spark, or the square of the bins if that is more
NOISE = 1e-12  # of the mean square, a gain that is none


def supports(estimator: Estimator, features_col: str) -> bool:
    """Whether ``estimator`` asks only for what is built here; others are left to Spark."""
    if not isinstance(estimator, (RandomForestRegressor, GBTRegressor)) or estimator.getFeaturesCol() != features_col:
        return False
    plain = not (estimator.isDefined("weightCol") and estimator.getWeightCol()) and not estimator.getMinWeightFractionPerNode()
    if isinstance(estimator, GBTRegressor):
        plain &= estimator.getLossType() == "squared" and not estimator.isDefined("validationIndicatorCol")
    return plain and not estimator.getLeafCol() and estimator.getImpurity() == "variance" and estimator.getMaxBins() <= 256


def subset_size(strategy: str, n: int, single: bool) -> int:
    """How many of n features a node may choose from, as Spark counts them."""
    if strategy == "auto":
        strategy = "all" if single else "onethird"
    named = {"all": n, "sqrt": math.ceil(math.sqrt(n)), "log2": max(1, math.ceil(math.log2(n))), "onethird": math.ceil(n / 3)}
    if strategy in named:
        return named[strategy]
    return min(n, int(strategy)) if strategy.isdigit() else math.ceil(float(strategy) * n)


def cuts_of(values: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds between the values: between all of them, or at quantiles."""
    found, counts = np.unique(values, return_counts=True)
    between = (found[1:] + found[:-1]) / 2
    if len(between) <= most:
        return between
    stride, out, target, before = counts.sum() / (most + 1), [], counts.sum() / (most + 1), counts[0]
    for k, n in enumerate(counts[1:].tolist()):
        if abs(before - target) < abs(before + n - target):
            out.append(between[k])
            target += stride
        before += n
    return np.array(out)


def thresholds(df: DataFrame, features: list[str], bins: int, seed: int) -> list[np.ndarray]:
    n, wanted = df.count(), max(bins * bins, SAMPLE)
    rows = df if n <= wanted else df.sample(wanted / n, seed)
    found = np.array(rows.select(*[quoted(c).cast("double") for c in features]).collect(), float).reshape(-1, len(features))
    return [cuts_of(found[:, k], bins - 1) for k in range(len(features))]


def binned(df: DataFrame, features: list[str], target: str, cuts: list[np.ndarray], fold: str | None = None) -> RDD:
    """Blocks (bins by feature and row, target, fold) of ``df``, kept."""
    def out(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*held)]
        y, folds, values = columns[0], columns[1], columns[2:]
        if np.isnan(y).any() or not all(np.isfinite(v).all() for v in values):
            raise ValueError("rows to fit to must have a target and finite features")
        bins = np.stack([np.searchsorted(c, v, "left").astype(np.uint8) for c, v in zip(cuts, values)])
        return pa.RecordBatch.from_pydict({k: pa.array([v.tobytes()], pa.binary()) for k, v in (("bins", bins), ("y", y), ("fold", folds.astype(np.int32)))})

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            while b.num_rows:
                part = b.slice(0, BLOCK_ROWS - n)
                b = b.slice(part.num_rows)
                held.append([np.asarray(c.to_numpy(zero_copy_only=False), float) for c in part.columns])
                n += part.num_rows
                if n == BLOCK_ROWS:
                    yield out(held)
                    held, n = [], 0
        if n:
            yield out(held)

    def load(row) -> tuple[np.ndarray, ...]:
        y = np.frombuffer(row[1], np.float64)
        return np.frombuffer(row[0], np.uint8).reshape(-1, len(y)), y, np.frombuffer(row[2], np.int32)
    numbers = [quoted(c).cast("double").alias(f"x{k}") for k, c in enumerate(features)]
    where = F.lit(-1.0) if fold is None else F.coalesce(quoted(fold).cast("double"), F.lit(-1.0))
    rows = df.select(quoted(target).cast("double").alias("y"), where.alias("fold"), *numbers)
    return rows.mapInArrow(blocks, "bins binary, y binary, fold binary").rdd.map(load).persist(StorageLevel.MEMORY_AND_DISK)


@dataclass
class Tree:
    """Nodes by number; the right child follows the left one. A leaf's ``left`` is itself, so rows stay in it."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    cut: np.ndarray = field(default_factory=lambda: np.full(1, 255, np.uint8))
    left: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))
    stats: np.ndarray = field(default_factory=lambda: np.zeros((1, 3)))  # rows, sum and squares of the target
    gain: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def values(self) -> np.ndarray:
        return self.stats[:, 1] / np.maximum(self.stats[:, 0], 1)

    def nodes(self, flat: np.ndarray, n: int, rows: np.ndarray, levels: int) -> np.ndarray:
        """The node of each of ``rows`` of a block of n rows, as far down as there are so many levels."""
        node, at = np.zeros(len(rows), np.int32), self.feature * n
        for _ in range(levels):
            node = self.left.take(node) + (flat.take(at.take(node) + rows) > self.cut.take(node))
        return node

    def split(self, nodes: np.ndarray, found: dict[str, np.ndarray]) -> np.ndarray:
        """Note what was found for ``nodes`` and split those that gain; the new nodes."""
        self.stats[nodes] = found["stats"]
        some = found["gain"] > 0
        nodes = nodes[some]
        new = len(self.left) + 2 * np.arange(len(nodes))
        self.feature[nodes], self.cut[nodes] = found["feature"][some], found["cut"][some]
        self.left[nodes], self.gain[nodes] = new, found["gain"][some]
        both = np.arange(len(self.left), len(self.left) + 2 * len(nodes))
        self.feature = np.append(self.feature, np.zeros(len(both), np.int64))
        self.cut = np.append(self.cut, np.full(len(both), 255, np.uint8))
        self.left = np.append(self.left, both.astype(np.int32))
        self.gain = np.append(self.gain, np.zeros(len(both)))
        self.stats = np.append(self.stats, found["children"][some].reshape(-1, 3), axis=0)
        return both


@dataclass(frozen=True)
class Settings:
    depth: int
    bins: int
    subset: int
    n_features: int
    least: int
    least_gain: float
    rate: float
    replace: bool
    seed: int

    @classmethod
    def of(cls, e: Estimator, n: int) -> Settings:
        boost = isinstance(e, GBTRegressor)
        single = boost or e.getNumTrees() == 1
        return cls(e.getMaxDepth(), e.getMaxBins(), subset_size(e.getFeatureSubsetStrategy(), n, single), n, e.getMinInstancesPerNode(),
                   e.getMinInfoGain(), e.getSubsamplingRate(), not boost and e.getBootstrap(), e.getSeed())

    def bag(self, tree: int, part: int, block: int, n: int) -> np.ndarray | None:
        """How often each row of a block is in a tree's bag; None: all once."""
        if not self.replace and self.rate == 1:
            return None
        rng = np.random.Generator(np.random.SFC64([self.seed % 2 ** 64, tree, part, block]))
        if not self.replace:
            return (rng.random(n, np.float32) < self.rate).astype(np.uint8)
        shares = np.cumsum([math.exp(-self.rate) * self.rate ** k / math.factorial(k) for k in range(20)])
        table = np.searchsorted(shares, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)
        return table.take(rng.integers(0, 1 << 16, n, np.uint16))

    def subsets(self, tree: int, level: int, nodes: int) -> np.ndarray:
        """The features that each node of a level may choose from."""
        if self.subset >= self.n_features:
            return np.tile(np.arange(self.n_features), (nodes, 1))
        rng = np.random.default_rng([self.seed % 2 ** 64, tree, level])
        return np.sort(rng.random((nodes, self.n_features)).argsort(1)[:, :self.subset], 1)


@dataclass
class Unit:
    """Nodes of one tree whose counts are made together; ``held`` is the fold that its model does not see."""

    model: int
    held: int | None
    number: int  # of the tree, for its bag
    tree: Tree
    level: int
    nodes: np.ndarray
    features: np.ndarray
    squares: bool

    def size(self, bins: int) -> int:
        return self.features.size * bins * 8 * (3 if self.squares else 2)


def _counts(part: int, blocks: Iterator[tuple], units: list[Unit], s: Settings, target: Callable) -> Iterator[tuple[int, np.ndarray]]:
    """(unit, counts): rows, sums (and squares) by node, feature of its subset and bin, and at the end the squares of each node."""
    sums: list[np.ndarray | int] = [0] * len(units)
    for k, block in enumerate(blocks):
        flat, n = block[0].reshape(-1), len(block[1])
        bags: dict[int, np.ndarray | None] = {}
        for i, u in enumerate(units):
            if u.number not in bags:
                bags = {u.number: s.bag(u.number, part, k, n)}
            bag = bags[u.number]
            seen = None if u.held is None else block[2] != u.held
            inside = (bag > 0) if bag is not None else None
            keep = inside if seen is None else seen if inside is None else seen & inside
            rows = np.arange(n) if keep is None else np.flatnonzero(keep)
            node = u.tree.nodes(flat, n, rows, u.level)
            slots = np.full(len(u.tree.left), -1)
            slots[u.nodes] = np.arange(len(u.nodes))
            slot = slots.take(node)
            if len(u.nodes) < len(u.tree.left):
                active = np.flatnonzero(slot >= 0)
                rows, slot = rows.take(active), slot.take(active)
            y = target(block, u.model).take(rows)
            w = None if bag is None or not s.replace else bag.take(rows).astype(float)
            wy = y if w is None else w * y
            wyy, size = wy * y, u.features.shape[1] * s.bins
            planes = [w, wy, wyy] if u.squares else [w, wy]
            out = np.empty((len(planes), len(u.nodes) * size))
            cells = []
            for j in range(u.features.shape[1]):
                at = rows + j * n if s.subset >= s.n_features else (u.features[:, j] * n).take(slot) + rows
                cells.append(slot * size + (flat.take(at) + np.int64(j * s.bins)))
            for p, weights in enumerate(planes):
                out[p] = sum(np.bincount(c, weights, len(u.nodes) * size) for c in cells)
            sums[i] = sums[i] + np.concatenate([out.ravel(), np.bincount(slot, wyy, len(u.nodes))])
    for i, found in enumerate(sums):
        if not isinstance(found, int):
            yield i, found


def _best(u: Unit, counts: np.ndarray, s: Settings) -> dict[str, np.ndarray]:
    """For each node its statistics, the split of the highest gain (0: none) and the statistics of the children."""
    m, planes = len(u.nodes), 3 if u.squares else 2
    yy = counts[len(counts) - m:]
    left = counts[:len(counts) - m].reshape(planes, m, -1, s.bins).cumsum(3)
    whole = left[:, :, :1, -1:]
    left = left[..., :-1]
    right = whole - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - whole[1] ** 2 / whole[0]) / whole[0]
    gain[(left[0] < max(s.least, 1)) | (right[0] < max(s.least, 1))] = 0
    flat = gain.reshape(m, -1)
    best = flat.argmax(1)
    found, node = flat[np.arange(m), best], np.arange(m)
    rows = whole[0, :, 0, 0]
    found[(found < s.least_gain) | (found <= NOISE * yy / np.maximum(rows, 1))] = 0
    j, cut = best // (s.bins - 1), best % (s.bins - 1)
    children = np.zeros((m, 2, 3))
    for p in range(planes):
        children[:, 0, p], children[:, 1, p] = left[p, node, j, cut], right[p, node, j, cut]
    return {"stats": np.stack([rows, whole[1, :, 0, 0], yy], 1), "gain": found, "feature": u.features[node, j],
            "cut": cut.astype(np.uint8), "children": children}


def _grow(blocks: RDD, wanted: list[tuple[int, int | None, int]], s: Settings, target: Callable) -> list[Tree]:
    """A tree for each (model, held fold, number), all a level at a time."""
    trees = [Tree() for _ in wanted]
    active = [np.zeros(1, np.int64) for _ in wanted]
    tasks = blocks.getNumPartitions()
    for level in range(max(s.depth, 1)):
        squares, units = level >= s.depth - 1, []
        most = max(1, HIST_BYTES // (s.subset * s.bins * 8 * (3 if squares else 2)))
        for tree, nodes, (model, held, number) in zip(trees, active, wanted):
            subsets = s.subsets(number, level, len(nodes))
            units += [Unit(model, held, number, tree, level, nodes[a:a + most], subsets[a:a + most], squares)
                      for a in range(0, len(nodes), most)]
        found: list[dict] = []
        while len(found) < len(units):
            group, size = [], 0
            for u in units[len(found):]:
                size += u.size(s.bins)
                if group and size > HIST_BYTES:
                    break
                group.append(u)
            counts = blocks.mapPartitionsWithIndex(lambda p, it, group=group: _counts(p, it, group, s, target))
            if sum(u.size(s.bins) for u in group) * tasks <= DRIVER_BYTES:
                merged: dict[int, np.ndarray] = {}
                for k, c in counts.collect():
                    merged[k] = merged[k] + c if k in merged else c
                best = {k: _best(group[k], c, s) for k, c in merged.items()}
            else:
                best = dict(counts.reduceByKey(operator.add, min(len(group), 2 * tasks)).map(
                    lambda kc, group=group: (kc[0], _best(group[kc[0]], kc[1], s))).collect())
            if not best:
                raise ValueError("no rows to fit to")
            found += [best[k] for k in range(len(group))]
        new: dict[int, list] = {id(t): [] for t in trees}
        for u, f in zip(units, found):
            f = f if s.depth else f | {"gain": f["gain"] * 0}
            new[id(u.tree)].append(u.tree.split(u.nodes, f))
        active = [np.concatenate([np.zeros(0, np.int64), *new[id(t)]]) for t in trees]
        if not any(len(a) for a in active):
            break
    return trees


def _plain(block: tuple, model: int) -> np.ndarray:
    return block[1]


def _residual(block: tuple, model: int) -> np.ndarray:
    return 2 * (block[1] - block[3][model])


def _add(block: tuple, trees: list[Tree], weight: float, depth: int) -> tuple:
    """The block with what it predicts for each model, raised by a tree of each."""
    flat, rows = block[0].reshape(-1), np.arange(len(block[1]))
    more = np.stack([t.values().take(t.nodes(flat, len(rows), rows, depth)) for t in trees])
    return *block[:3], weight * more + (block[3] if len(block) > 3 else 0)


def _boosted(blocks: RDD, held: list[int | None], e: GBTRegressor, s: Settings, after: Callable[[int, RDD], None] | None = None) -> list[list[Tree]]:
    """The trees of each round, one a model; ``after`` gets each round's number and the blocks with what the rounds so far predict."""
    out: list[list[Tree]] = []
    first = blocks
    try:
        for r in range(e.getMaxIter()):
            out.append(_grow(blocks, [(m, h, r) for m, h in enumerate(held)], s, _residual if r else _plain))
            if r + 1 < e.getMaxIter() or after:
                weight = e.getStepSize() if r else 1.0
                before, blocks = blocks, blocks.map(lambda b, t=out[-1], w=weight: _add(b, t, w, s.depth)).persist(StorageLevel.MEMORY_AND_DISK)
                blocks.count()
                if before is not first:
                    before.unpersist()
            if after:
                after(r + 1, blocks)
    finally:
        if blocks is not first:
            blocks.unpersist()
    return out


def fit(df: DataFrame, e: Estimator, features: list[str]) -> Model:
    """The model that ``e`` asks for, fitted to the columns ``features`` of ``df``."""
    s = Settings.of(e, len(features))
    cuts = thresholds(df, features, s.bins, s.seed)
    blocks = binned(df, features, e.getLabelCol(), cuts)
    try:
        if isinstance(e, GBTRegressor):
            rounds = _boosted(blocks, [None], e, s)
            trees, weights = [t for t, in rounds], [1.0] + [e.getStepSize()] * (len(rounds) - 1)
        else:
            trees, weights = _grow(blocks, [(0, None, t) for t in range(e.getNumTrees())], s, _plain), None
    finally:
        blocks.unpersist()
    return _model(e, trees, cuts, weights)


def fold_blocks(df: DataFrame, e: Estimator, features: list[str], fold: str) -> RDD:
    """The rows of all folds for ``fold_rmse``, kept until they are unpersisted. The folds share their bins, from all rows."""
    s = Settings.of(e, len(features))
    return binned(df, features, e.getLabelCol(), thresholds(df, features, s.bins, s.seed), fold)


def fold_rmse(blocks: RDD, e: Estimator, n_features: int, folds: list[int], rounds: list[int] | None = None) -> dict[int, dict[int, float]]:
    """For each number of trees in ``rounds`` (that of ``e`` unless given; others for boosting only) the error of each of
    ``folds`` by the model that has not seen it. These models are grown together.
    """
    s, out = Settings.of(e, n_features), {}

    def rmse(errors: RDD) -> dict[int, float]:
        """From the errors by fold of each block."""
        sums = errors.map(lambda d: np.array([[(d[i] ** 2).sum(), len(d[i])] for i in folds])).reduce(operator.add)
        return {i: math.sqrt(a / n) if n else math.nan for i, (a, n) in zip(folds, sums.tolist())}
    if isinstance(e, GBTRegressor):
        wanted = rounds or [e.getMaxIter()]

        def after(r: int, done: RDD) -> None:
            if r in wanted:
                out[r] = rmse(done.map(lambda b: {i: b[3][m][b[2] == i] - b[1][b[2] == i] for m, i in enumerate(folds)}))
        _boosted(blocks, folds, e.copy({e.maxIter: max(wanted)}), s, after)
        return out
    n = e.getNumTrees()
    trees = _grow(blocks, [(m, i, t) for t in range(n) for m, i in enumerate(folds)], s, _plain)
    by = {i: trees[m::len(folds)] for m, i in enumerate(folds)}

    def errors(b: tuple) -> dict[int, np.ndarray]:
        flat, found = b[0].reshape(-1), {}
        for i in folds:
            rows = np.flatnonzero(b[2] == i)
            found[i] = sum(t.values().take(t.nodes(flat, len(b[1]), rows, s.depth)) for t in by[i]) / n - b[1][rows]
        return found
    return {n: rmse(blocks.map(errors))}


def _model(e: Estimator, trees: list[Tree], cuts: list[np.ndarray], weights: list[float] | None) -> Model:
    """The trees as a model of Spark with the columns and settings of ``e``."""
    context = SparkSession.getActiveSession().sparkContext
    gateway, n = context._gateway, len(cuts)
    ml, calculator = gateway.jvm.org.apache.spark.ml, gateway.jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    leaf, inner, threshold = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit
    one, copy = ml.regression.DecisionTreeRegressionModel, gateway.jvm.java.util.Arrays.copyOfRange

    def root(t: Tree):
        all_stats = gateway.new_array(gateway.jvm.double, t.stats.size)
        gateway.jvm.java.nio.ByteBuffer.wrap(t.stats.astype(">f8").tobytes()).asDoubleBuffer().get(all_stats)
        rows, values = np.maximum(t.stats[:, 0], 1), t.values()
        variance = np.maximum(t.stats[:, 2] / rows - values ** 2, 0)
        made: list = [None] * len(t.left)
        for k in range(len(t.left) - 1, -1, -1):  # children have higher numbers
            stats = calculator(copy(all_stats, 3 * k, 3 * k + 3), int(t.stats[k, 0]))
            if t.left[k] == k:
                made[k] = leaf(float(values[k]), float(variance[k]), stats)
            else:
                f, a = int(t.feature[k]), int(t.left[k])
                made[k] = inner(float(values[k]), float(variance[k]), float(t.gain[k]), made[a], made[a + 1],
                                threshold(f, float(cuts[f][t.cut[k]])), stats)
                made[a] = made[a + 1] = None
        return made[0]
    array = gateway.new_array(one, len(trees))
    with ThreadPool(4) as pool:
        for k, top in enumerate(pool.imap(root, trees)):
            array[k] = one(f"dtr_{e.uid}_{k}", top, n)
    if weights is None:
        java = ml.regression.RandomForestRegressionModel(e.uid, array, n)
    else:
        steps = gateway.new_array(gateway.jvm.double, len(weights))
        for k, w in enumerate(weights):
            steps[k] = float(w)
        java = ml.regression.GBTRegressionModel(e.uid, array, steps, n)
    model = e._copyValues(e._create_model(java))
    model._transfer_params_to_java()
    return model
