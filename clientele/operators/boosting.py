"""Boosted trees of a cross-validation, all folds in the same passes over binned rows.

The method is that of Spark's ``GBTClassifier``: inputs scaled by the training rows' mean and deviation, at most 32 bins an
input, regression trees on the slope of the logistic loss, the first tree counted whole and every later one by the step.
The rows are kept as blocks of small numbers: the bin of each input, and the margin so far in each fold's model. A pass sums
counts and slopes per (fold, node, input, bin); only these sums, whose size does not depend on the rows, reach the driver,
which picks the splits of a whole level. So a level costs one job for all folds, and a row some nanoseconds an input.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clientele.functions.columns import count_rows

BINS = 32
SPLIT_SAMPLE = 10_000  # rows from which thresholds are taken, as Spark ML does
BLOCK_ROWS = 1 << 15
TASK_ROWS = 1 << 14  # fewer rows are not worth a task of their own in each of some hundred passes
CHECKPOINT = 10  # rounds between two checkpoints of the margins
TO_DRIVER = 64  # partitions whose sums the driver adds up itself
NOISE = 1e-13  # a gain below this share of what it is the difference of is rounding
POSITIVE = float(1 << 26)  # what a positive adds to a count: more than the rows of a partition


@dataclass(frozen=True)
class Binning:
    """A fold's thresholds as raw values, ascending per input, and the weight of its positives (negatives weigh 1)."""

    cuts: tuple[np.ndarray, ...]
    heavy: float


@dataclass(frozen=True)
class Grid:
    """The thresholds of all folds together: a row has one small number an input, whichever fold looks at it."""

    cuts: tuple[np.ndarray, ...]
    places: tuple[tuple[np.ndarray, ...], ...]  # per fold and input: where the fold's own thresholds stand among ``cuts``

    @staticmethod
    def of(folds: Sequence[Binning]) -> Grid:
        cuts = tuple(np.unique(np.concatenate(own)) for own in zip(*[fold.cuts for fold in folds], strict=True))
        return Grid(cuts, tuple(tuple(np.searchsorted(c, own) for c, own in zip(cuts, fold.cuts, strict=True)) for fold in folds))

    @property
    def width(self) -> int:
        return 1 + max(len(c) for c in self.cuts)

    def bins(self, values: np.ndarray) -> np.ndarray:
        """(inputs, rows) of raw values to the number of thresholds below them."""
        kind = np.uint8 if self.width <= 256 else np.uint16
        return np.stack([np.searchsorted(c, x).astype(kind) for c, x in zip(self.cuts, values, strict=True)])

    def own_bins(self, sums: np.ndarray, fold: int, column: int) -> np.ndarray:
        """(..., ``width``) of sums added up to the fold's own bins, ``BINS`` at most; those it lacks hold 0."""
        starts = np.concatenate([[0], self.places[fold][column] + 1])
        out = np.zeros((*sums.shape[:-1], BINS))
        out[..., : len(starts)] = np.add.reduceat(sums, starts, axis=-1)
        return out


@dataclass(frozen=True)
class Tree:
    """A complete binary tree by place: node n has the children 2n + 1 and 2n + 2; a leaf sends its rows left."""

    variable: np.ndarray
    last_left: np.ndarray  # the last place on the grid that goes left
    value: np.ndarray  # of the deepest places

    def places(self, bins: np.ndarray, steps: int) -> np.ndarray:
        """Where the rows stand after so many steps; ``bins`` holds the inputs one after the other."""
        size = bins.shape[1]
        flat, row, begin = bins.reshape(-1), np.arange(size), self.variable * size
        node = np.zeros(size, np.intp)
        for _ in range(steps):
            right = flat[begin[node] + row] > self.last_left[node]
            node += node
            node += 1
            node += right
        return node

    def values(self, bins: np.ndarray, depth: int) -> np.ndarray:
        return self.value[self.places(bins, depth) - ((1 << depth) - 1)]


@dataclass(frozen=True)
class BoostedModel:
    grid: Grid
    trees: tuple[Tree, ...]
    step: float
    depth: int

    def margin(self, bins: np.ndarray) -> np.ndarray:
        """Weighted sum of the trees for rows on the grid."""
        return sum((_share(i, self.step) * tree.values(bins, self.depth) for i, tree in enumerate(self.trees)), np.zeros(bins.shape[1]))


def _share(number: int, step: float) -> float:
    return step if number else 1.0


def split_points(values: np.ndarray, weights: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Thresholds of one input as Spark ML chooses them: all midpoints, or those that part the weight most evenly."""
    known, place = np.unique(values, return_inverse=True)
    between = (known[:-1] + known[1:]) / 2.0
    between = np.where(between < known[1:], between, known[:-1])  # neighbours among the doubles have no middle
    if len(between) < bins:
        return between
    upto = np.cumsum(np.bincount(place, weights))
    stride = upto[-1] / bins
    chosen, target = [], stride
    for i in range(1, len(known)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            chosen.append(between[i - 1])
            target += stride
    return np.array(chosen[: bins - 1])


def raw_cuts(points: np.ndarray, known: np.ndarray, mean: float, scale: float) -> np.ndarray:
    """The largest raw value that scales to no more than each threshold, so that rows fall as their scaled values do.

    ``known`` are raw values with some of them on either side of every threshold.
    """
    scaled = (known - mean) * scale
    low = np.array([known[scaled <= t].max() for t in points])
    high = np.array([known[scaled > t].min() for t in points])
    while len(points):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        left = (middle - mean) * scale <= points
        low, high = np.where(left, middle, low), np.where(left, high, middle)
    return low


def binning(rows: DataFrame, inputs: Sequence[str], label: str, seed: int) -> Binning:
    """Thresholds and class weight from the training rows of one fold."""
    count = rows.agg(count_rows().alias("n"), F.count_if(F.col(label) == 1).alias("pos")).first()
    n, pos = count["n"], count["pos"]
    if not n:
        raise ValueError("boosting: a model has no rows")
    assembled = VectorAssembler(inputCols=list(inputs), outputCol="raw")
    scaler = Pipeline(stages=[assembled, StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True)]).fit(rows).stages[1]
    chosen = rows.select(label, *inputs)
    seen = (chosen if n <= SPLIT_SAMPLE else chosen.sample(False, SPLIT_SAMPLE / n, seed)).toArrow()
    heavy = (n - pos) / max(pos, 1)
    weights = np.where(seen.column(label).to_numpy() == 1, heavy, 1.0)
    cuts = []
    for column, mean, deviation in zip(inputs, scaler.mean.toArray(), scaler.std.toArray(), strict=True):
        known, scale = seen.column(column).to_numpy(), 1.0 / deviation if deviation else 0.0
        cuts.append(raw_cuts(split_points((known - mean) * scale, weights), np.unique(known), mean, scale))
    return Binning(tuple(cuts), heavy)


# The rows in blocks -------------------------------------------------------------------------------
def _values(rows: pa.RecordBatch | pa.Table, inputs: Sequence[str]) -> np.ndarray:
    return np.stack([np.asarray(rows.column(c)) for c in inputs])


def _blocks(folded: DataFrame, inputs: Sequence[str], label: str, grid: Grid, k: int) -> RDD:
    """Rows in the order of their folds: where each fold begins, labels, bins, and margins of the k - 1 models that train on a row."""

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches)
        fold = np.asarray(rows.column("fold"))
        order = np.argsort(fold, kind="stable")
        starts = np.searchsorted(fold[order], np.arange(k + 1))
        y = np.asarray(rows.column(label))[order].astype(np.int8)
        made = (starts, y, grid.bins(_values(rows, inputs)[:, order]), np.zeros((k - 1, len(y))))
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(made, 5)], pa.binary())], names=["block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield block(waiting)
                waiting, size = [], 0
        if size:
            yield block(waiting)

    made = folded.select(label, "fold", *inputs).mapInArrow(run, "block binary")
    tasks = min(folded.sparkSession.sparkContext.defaultParallelism, -(-folded.count() // TASK_ROWS))
    return made.repartition(max(1, tasks)).rdd.map(lambda row: pickle.loads(row[0]))


def _parts(block: tuple, k: int) -> Iterator[tuple[int, int, slice, np.ndarray]]:
    """Per model and fold that it trains on: model, its row among the margins, the rows, their bins."""
    starts, _, bins, _ = block
    for fold in range(k):
        rows = slice(starts[fold], starts[fold + 1])
        if rows.start == rows.stop:
            continue
        own = np.ascontiguousarray(bins[:, rows])
        for m in range(k):
            if m != fold:
                yield m, m - (m > fold), rows, own


def _slopes(sign: np.ndarray, margin: np.ndarray, first: bool) -> np.ndarray:
    """What the next tree is to predict: the label as -1 or 1, later the negative slope of the logistic loss."""
    return sign if first else 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))


def _sums(blocks: Iterator, trees: Sequence[Tree], level: int, heavy: Sequence[float], first: bool, grid: Grid) -> Iterator[np.ndarray]:
    """(fold, node of the level, input, bin, what): negatives, positives and weighted slopes of the training rows."""
    k, n_inputs, width, nodes = len(trees), len(grid.cuts), grid.width, 1 << level
    found = np.zeros((k, n_inputs, 2, nodes * width))
    for block in blocks:
        y, margins = block[1], block[3]
        counted = 1.0 + y * POSITIVE  # two counts in one exact sum
        sign = 2.0 * y - 1.0
        for m, slot, rows, own in _parts(block, k):
            at = (trees[m].places(own, level) - (nodes - 1)) * width
            slope = _slopes(sign[rows], margins[slot, rows], first) * np.where(y[rows] == 1, heavy[m], 1.0)
            for j in range(n_inputs):
                cell = at + own[j]
                found[m, j, 0] += np.bincount(cell, counted[rows], nodes * width)
                found[m, j, 1] += np.bincount(cell, slope, nodes * width)
    out = np.zeros((k, nodes, n_inputs, BINS, 3))
    for m in range(k):
        for j in range(n_inputs):
            counts, slopes = grid.own_bins(found[m, j].reshape(2, nodes, width), m, j)
            positives = np.floor(counts / POSITIVE)
            out[m, :, j] = np.stack([counts - positives * (POSITIVE + 1), positives, slopes], -1)
    yield out


def _advance(blocks: Iterator, trees: Sequence[Tree], share: float, depth: int) -> Iterator:
    for block in blocks:
        margins = block[3].copy()
        for m, slot, rows, own in _parts(block, len(trees)):
            margins[slot, rows] += share * trees[m].values(own, depth)
        yield (*block[:3], margins)


def _added(found: RDD) -> np.ndarray:
    return reduce(np.add, found.collect()) if found.getNumPartitions() <= TO_DRIVER else found.treeReduce(np.add)


# Growing ------------------------------------------------------------------------------------------
def best_splits(sums: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per (fold, node): input and last bin of the left side of the best split, its gain (0: none), and the node's mean."""
    rows = sums[..., 0] + sums[..., 1]
    weight, slope = sums[..., 0] + heavy[:, None, None, None] * sums[..., 1], sums[..., 2]
    whole, total, count = weight.sum(-1, keepdims=True), slope.sum(-1, keepdims=True), rows.sum(-1, keepdims=True)
    left, left_slope, left_rows = (np.cumsum(x, -1)[..., :-1] for x in (weight, slope, rows))
    right, right_slope = whole - left, total - left_slope
    allowed = (left_rows > 0) & (left_rows < count) & (left > 0) & (right > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = left_slope**2 / left + right_slope**2 / right
        gain = np.where(allowed, parts - total**2 / whole, 0.0)
        gain = np.where(gain > NOISE * parts, gain, 0.0)
        mean = np.where(whole > 0, total / whole, 0.0)[:, :, 0, 0]
    flat = gain.reshape(*gain.shape[:2], -1)
    best = flat.argmax(-1)
    return best // gain.shape[-1], best % gain.shape[-1], np.take_along_axis(flat, best[..., None], -1)[..., 0], mean


def _grow(rows: RDD, grid: Grid, heavy: np.ndarray, depth: int, first: bool) -> list[Tree]:
    """The next tree of every fold, a level a pass; the values of the deepest nodes come from the splits above them."""
    k, inner, deepest = len(heavy), (1 << depth) - 1, 1 << depth
    variable, last_left = np.zeros((k, inner), np.intp), np.full((k, inner), grid.width, np.uint16)
    value, ended = np.zeros((k, inner + deepest)), np.zeros((k, inner), bool)
    for level in range(depth):
        trees = [Tree(variable[m], last_left[m], value[m]) for m in range(k)]
        sums = _added(rows.mapPartitions(partial(_sums, trees=trees, level=level, heavy=heavy.tolist(), first=first, grid=grid)))
        column, cut, gain, mean = best_splits(sums, heavy)
        for m in range(k):
            for i in range(1 << level):
                node = (1 << level) - 1 + i
                if ended[m, (node - 1) // 2] and node:
                    ended[m, node] = True
                    value[m, 2 * node + 1] = value[m, node]
                    continue
                value[m, node] = mean[m, i]
                if gain[m, i] <= 0:
                    ended[m, node] = True
                    value[m, 2 * node + 1] = value[m, node]
                    continue
                variable[m, node], last_left[m, node] = column[m, i], grid.places[m][column[m, i]][cut[m, i]]
                if level == depth - 1:
                    own = sums[m, i, column[m, i]]
                    for side, part in ((1, own[: cut[m, i] + 1]), (2, own[cut[m, i] + 1 :])):
                        weight = part[:, 0].sum() + heavy[m] * part[:, 1].sum()
                        value[m, 2 * node + side] = part[:, 2].sum() / weight
        if ended[:, (1 << level) - 1 : (2 << level) - 1].all():
            for below in range((2 << level) - 1, inner):  # nothing is left to split: hand the values down
                value[:, 2 * below + 1] = value[:, below]
            break
    return [Tree(variable[m], last_left[m], value[m, inner:]) for m in range(k)]


def fit_folds(folded: DataFrame, inputs: Sequence[str], label: str, folds: Sequence[Binning], rounds: int, depth: int, step: float) -> list[BoostedModel]:
    """One model per fold of the column ``fold``, trained on the rows of all others."""
    heavy = np.array([own.heavy for own in folds])
    grid = Grid.of(folds)
    rows = _blocks(folded, inputs, label, grid, len(folds)).persist(StorageLevel.MEMORY_AND_DISK)
    kept, made = [rows], []
    try:
        for number in range(rounds):
            made.append(_grow(rows, grid, heavy, depth, not number))
            rows = rows.mapPartitions(partial(_advance, trees=made[-1], share=_share(number, step), depth=depth)).persist(StorageLevel.MEMORY_AND_DISK)
            kept.append(rows)
            if number % CHECKPOINT == CHECKPOINT - 1 and number + 1 < rounds:
                rows.checkpoint()
            if len(kept) > 2:
                kept.pop(0).unpersist()  # the last but one has been read by the passes since
    finally:
        for old in kept:
            old.unpersist()
    return [BoostedModel(grid, tuple(trees[m] for trees in made), step, depth) for m in range(len(folds))]


def held_out_scores(folded: DataFrame, inputs: Sequence[str], models: Sequence[BoostedModel], keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` and the ``score`` of each row by the model that did not see its fold."""
    schema = StructType([folded.schema[c] for c in keep]).add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold, bins = np.asarray(batch.column("fold")), models[0].grid.bins(_values(batch, inputs))
            score = np.zeros(batch.num_rows)
            for m in np.unique(fold).tolist():
                own = np.flatnonzero(fold == m)
                score[own] = 1.0 / (1.0 + np.exp(-2.0 * models[m].margin(bins[:, own])))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(score)], names=schema.names)

    return folded.select(*dict.fromkeys([*keep, "fold", *inputs])).mapInArrow(run, schema)
