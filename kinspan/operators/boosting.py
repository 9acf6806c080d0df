"""Boosted trees by sums over binned features: those that GBTClassifier grows, without its shuffles, and the same whatever the order of rows.

Residuals are whole numbers of 2^-15, so sums are exact and don't depend on how rows are dealt. A level needs sums over the smaller child of each
split only; the other child's are the parent's less these. Up to HELD values are held by the driver; of more, each level is one job, and
the rows stay with the executors."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from functools import partial
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspan.operators.lineage import cut, prepare

#: Feature values (bytes, once binned) that the driver holds at most.
HELD = 2**26
#: Bytes of rows that a Python worker holds from job to job.
KEPT = 2**28
#: Rows of a partition at least, where rows stay with the executors.
ROWS = 500_000
#: Rows whose packed residuals add up exactly: counts from bit 35 on, residuals of up to 17 bits and a sign below.
CHUNK, ONE, TOP = 2**17, 2.0**35, 2**17
STEP = 4.0 / TOP
MIX = np.uint64(0x9E3779B97F4A7C15)


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    out = [np.nan_to_num(x, nan=np.inf) + 0.0 for x in (batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in names)]
    if not all(np.isfinite(x).all() for x in out):
        raise ValueError("a feature is null or not finite")
    return out


def _edges(cells: np.ndarray) -> np.ndarray:
    """The least value of each cell."""
    bits = cells.astype(np.int64) << 12
    return np.where(bits >= 0, bits, bits ^ 0x7FFFFFFF).astype(np.int32).view(np.float32).astype(np.float64)


def _cells(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many rows each cell of each feature has: cells are the upper 20 bits of a value's 32."""
    for batch in batches:
        for i, x in enumerate(_columns(batch, names)):
            bits = x.astype(np.float32).view(np.int32)
            cell, n = np.unique(np.where(bits >= 0, bits, bits ^ 0x7FFFFFFF) >> 12, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), i, np.int32)), pa.array(cell.astype(np.int32)), pa.array(n.astype(np.int64))], names=["feature", "cell", "n"])


def _cuts(cells: np.ndarray, n: np.ndarray, bins: int) -> np.ndarray:
    """At most bins - 1 thresholds between cells: all there are, or those that part the rows most evenly."""
    at = np.arange(len(cells) - 1)
    if len(cells) > bins:
        upto, want = np.cumsum(n), n.sum() / bins * np.arange(1, bins)
        over = np.clip(np.searchsorted(upto, want), 1, len(cells) - 2)
        at = np.unique(np.where(want - upto[over - 1] < upto[over] - want, over - 1, over))
    low = _edges(cells[at + 1])
    return np.minimum((_edges(cells[at] + 1) + low) / 2, np.nextafter(low, -np.inf))


def thresholds(train: DataFrame, names: list[str], bins: int) -> list[np.ndarray]:
    """Each feature's thresholds, from the values of all rows."""
    sums = train.select(*names).mapInArrow(partial(_cells, names), "feature int, cell int, n long").groupBy("feature", "cell").agg(F.sum("n").alias("n")).toArrow()
    feature, cell, n = (sums.column(c).to_numpy() for c in ("feature", "cell", "n"))
    out = []
    for i in range(len(names)):
        mine = np.flatnonzero(feature == i)
        mine = mine[np.argsort(cell[mine])]
        out.append(_cuts(cell[mine], n[mine], bins) if len(mine) > 1 else np.zeros(0))
    return out


def _binned(names: list[str], cuts: list[np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns, label = _columns(batch, names), batch.column("label").to_numpy(zero_copy_only=False).astype(np.uint8)
        key = label.astype(np.uint64)
        for x in columns:
            key = (key ^ x.view(np.uint64)) * MIX
            key ^= key >> np.uint64(29)
        parts = [label, batch.column("is_val").to_numpy(zero_copy_only=False).astype(np.uint8), key, np.stack([np.searchsorted(c, x).astype(np.uint8) for c, x in zip(cuts, columns, strict=True)])]
        yield pa.RecordBatch.from_arrays([pa.array([len(label)], pa.int64()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]], names=["n", "label", "is_val", "key", "bins"])


class Rows:
    """Binned rows, how far their margins are, and in which node of the tree in growth each one is."""

    def __init__(self, parts: list[tuple], width: int, seed: int, rate: float, bins: int = 32):
        joined = lambda i, kind: np.frombuffer(b"".join(p[i] for p in parts), kind)
        self.y, self.val, self.key = joined(1, np.uint8) * 2.0 - 1, joined(2, np.uint8) > 0, joined(3, np.uint64)
        blocks = [np.frombuffer(p[4], np.uint8).reshape(width, -1) for p in parts]
        self.bins = np.concatenate(blocks, axis=1) if blocks else np.zeros((width, 0), np.uint8)
        self.pairs = [self.bins[f].astype(np.uint16) * bins + self.bins[f + 1] for f in range(0, width - 1, 2)]
        self.seed, self.rate, self.validated = seed, rate, bool(self.val.any())
        self._restart()

    def _restart(self) -> None:
        self.margin, self.trees = np.zeros(len(self.y)), 0
        self._plant()

    def _plant(self) -> None:
        self.depth, self.nodes, self.packed = 0, {0: np.arange(len(self.y))}, None

    def _weigh(self) -> None:
        """Residuals and counts of the rows that this tree is drawn: by a hash of the row, so equal rows are drawn together."""
        residual = 4 * self.y / (1 + np.exp(2 * self.y * self.margin)) if self.trees else self.y
        h = (self.key ^ np.uint64((self.seed << 32) + self.trees + 1)) * MIX
        h = (h ^ (h >> np.uint64(32))) * MIX
        drawn = ((h >> np.uint64(11)).astype(np.float64) < self.rate * 2.0**53) & ~self.val
        self.packed = np.where(drawn, np.clip(np.rint(residual / STEP), 1 - TOP, TOP - 1) + ONE, 0.0)

    def advance(self, trees: list[dict], levels: list[list[tuple]]) -> None:
        """On to where all trees and these levels of the next are grown; from the start where the rows are further."""
        if (self.trees, self.depth) > (len(trees), len(levels)):
            self._restart()
        for tree in trees[self.trees :]:
            self._split(tree["levels"])
            for node, rows in self.nodes.items():
                self.margin[rows] += tree["weight"] * tree["leaves"][node]
            self.trees += 1
            self._plant()
        self._split(levels)

    def _split(self, levels: list[list[tuple]]) -> None:
        for level in levels[self.depth :]:
            for node, feature, last in level:
                rows = self.nodes.pop(node)
                left = self.bins[feature][rows] <= last
                self.nodes[2 * node + 1], self.nodes[2 * node + 2] = rows[left], rows[~left]
            self.depth += 1

    def sums(self, wanted: list[int], bins: int) -> np.ndarray:
        """Counts and residuals by node, feature and bin: two features are counted at once, and their sums follow from those of both."""
        if self.packed is None:
            self._weigh()
        out = np.zeros((len(wanted), len(self.bins), bins, 2), np.int64)
        for i, node in enumerate(wanted):
            rows = None
            if node:
                rows = self.nodes[node]
                rows = rows[self.packed[rows] != 0]
            for start in range(0, len(self.y) if rows is None else len(rows), CHUNK):
                part = slice(start, start + CHUNK) if rows is None else rows[start : start + CHUNK]
                weights = self.packed[part]
                packed = np.zeros((len(self.bins), bins))
                for k, column in enumerate(self.pairs):
                    both = np.bincount(column[part], weights, bins * bins).reshape(bins, bins)
                    packed[2 * k], packed[2 * k + 1] = both.sum(axis=1), both.sum(axis=0)
                if len(self.bins) % 2:
                    packed[-1] = np.bincount(self.bins[-1][part], weights, bins)
                n = np.floor((packed + ONE / 2) / ONE)
                out[i, :, :, 0] += n.astype(np.int64)
                out[i, :, :, 1] += (packed - n * ONE).astype(np.int64)
        return out

    def loss(self) -> np.ndarray:
        """The log loss over the rows for validation, in 2^-24, and their number."""
        z = -2 * self.y[self.val] * self.margin[self.val]
        return np.array([np.rint(2 * np.logaddexp(0, z) * 2**24).sum(dtype=np.float64) if len(z) else 0, len(z)]).astype(np.int64)

    def answer(self, trees: list[dict], levels: list[list[tuple]], wanted: list[int], bins: int) -> tuple[np.ndarray, np.ndarray]:
        self.advance(trees, levels)
        return self.sums(wanted, bins), self.loss() if self.validated and not levels else np.zeros(2, np.int64)


_kept: dict[tuple[str, int], Rows] = {}


def _answers(fit: str, made: Callable[[list], Rows], done, trees: list[dict], levels: list, wanted: list[int], bins: int, partition: int, parts: Iterator[tuple]) -> Iterator[tuple]:
    """A partition's sums. Its rows are kept from job to job where a worker has room; else they are grown again from the trees, with the same sums."""
    for other in [k for k in _kept if k[0] != fit]:
        del _kept[other]
    rows = _kept.get((fit, partition))
    if rows is None:
        rows = made(list(parts))
        if sum(2 * x.bins.nbytes + 60 * len(x.y) for x in [*_kept.values(), rows]) <= KEPT:
            _kept[fit, partition] = rows
    else:
        for _ in parts:  # a worker that leaves input unread is not used again
            pass
    yield rows.answer([*done.value, *trees], levels, wanted, bins)


def _grow(step: Callable, tree: int, first: np.ndarray, p: dict) -> dict:
    """A tree, level by level; nodes are numbered as in a heap."""
    weight, frontier, levels, leaves, splits = 1.0 if not tree else p["stepSize"], {0: first[0]}, [], {}, {}
    width = first.shape[1]
    many = int(np.ceil(p["share"] * width))
    least = p["minInstancesPerNode"]
    mean = lambda n, s: int(s) * STEP / int(n) if n else 0.0
    for depth in range(p["maxDepth"]):
        nodes = sorted(frontier)
        if not nodes:
            break
        h = np.stack([frontier[x] for x in nodes])
        left = np.cumsum(h, axis=2)
        whole, left = left[:, 0, -1], left[:, :, :-1]
        right = whole[:, None, None] - left
        (nl, sl), (nr, sr), (n, s) = ([x[..., i].astype(np.float64) for i in (0, 1)] for x in (left, right, whole))
        with np.errstate(divide="ignore", invalid="ignore"):
            base = np.where(n > 0, s * s / n, 0.0)
            gain = sl * sl / nl + sr * sr / nr - base[:, None, None]
        drawn = np.argsort(np.random.default_rng([p["seed"], tree, depth]).random((2**depth, width)), axis=1)[np.array(nodes) - 2**depth + 1, :many]
        allowed = np.zeros((len(nodes), width), bool)
        np.put_along_axis(allowed, drawn, True, axis=1)
        gain = np.where((nl >= least) & (nr >= least) & allowed[:, :, None] & (gain > 1e-12 * (base[:, None, None] + 1)), gain, -1.0).reshape(len(nodes), -1)
        best = gain.argmax(axis=1)
        level, kids = [], {}
        for i, node in enumerate(nodes):
            if gain[i, best[i]] <= 0:
                leaves[node] = mean(*whole[i])
                continue
            f, b = divmod(int(best[i]), h.shape[2] - 1)
            level.append((node, f, b))
            splits[node] = (f, b, int(whole[i, 0]), mean(*whole[i]), float(gain[i, best[i]] / n[i] * STEP**2))
            kids[node] = left[i, f, b], right[i, f, b]
        frontier_was, frontier = frontier, {}
        if level:
            levels.append(level)
        open_ = lambda x, depth=depth: depth + 1 < p["maxDepth"] and x[0] >= 2 * least
        ask = {node: 2 * node + 1 + int(r[0] < l[0]) for node, (l, r) in kids.items() if open_(l) or open_(r)}
        got = dict(zip(ask, step(levels, list(ask.values()))[0], strict=True)) if ask else {}
        for node, sides in kids.items():
            for child, side in zip((2 * node + 1, 2 * node + 2), sides, strict=True):
                if open_(side):
                    frontier[child] = got[node] if child == ask[node] else frontier_was[node] - got[node]
                else:
                    leaves[child] = mean(*side)
    return {"levels": levels, "leaves": leaves, "weight": weight, "splits": splits}


def boost(step: Callable, rounds: int, p: dict) -> tuple[list[dict], int]:
    """All trees, and how many of them to keep: step(trees, levels, wanted) gives the sums of the wanted nodes and the loss of validation."""
    trees, best, keep = [], None, 0
    for t in range(rounds + 1):
        first, (loss, n) = step(trees, [], [0] if t < rounds else [])
        if n and t:
            error = loss / n / 2**24
            if best is not None and best - error < p["validationTol"] * max(error, 0.01):
                break
            if best is None or error < best:
                best, keep = error, t
        if t < rounds:
            trees.append(_grow(partial(step, trees), t, first, p))
    return trees, keep if best is not None else len(trees)


def _stored(spark, trees: list[dict], cuts: list[np.ndarray], of: GBTClassifier) -> GBTClassificationModel:
    """The trees as Spark's own model, by way of the form that it is saved in. Impurities are not known, and 0 there."""
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/trees-{uuid.uuid4().hex}"
    said = {str(k.name): v for k, v in of.extractParamMap().items()}
    given = {k: v for k, v in said.items() if of.isSet(k) and k != "validationIndicatorCol"}
    usual = {k: v for k, v in said.items() if of.hasDefault(k) and not of.isSet(k)}
    about = lambda kind, uid, **more: json.dumps({"class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid, **more})
    one = about("classification.GBTClassificationModel", of.uid, paramMap=given, defaultParamMap=usual, numFeatures=len(cuts), numTrees=len(trees))
    nodes, heads = [], []
    for t, tree in enumerate(trees):
        heads.append((t, about("regression.DecisionTreeRegressionModel", f"dtr_{uuid.uuid4().hex[:12]}", paramMap={"maxDepth": of.getMaxDepth()}, defaultParamMap={}), tree["weight"]))
        order, stack = [], [0]
        while stack:
            node = stack.pop()
            order.append(node)
            if node in tree["splits"]:
                stack += [2 * node + 2, 2 * node + 1]
        at = {node: i for i, node in enumerate(order)}
        for node in order:
            if node in tree["splits"]:
                f, b, n, value, gain = tree["splits"][node]
                nodes.append((t, (at[node], value, 0.0, [float(n), value * n, 0.0], n, gain, at[2 * node + 1], at[2 * node + 2], (f, [float(cuts[f][b])], -1))))
            else:
                nodes.append((t, (at[node], tree["leaves"][node], 0.0, [0.0, 0.0, 0.0], 0, -1.0, -1, -1, (-1, [], -1))))
    kind = "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
    spark.createDataFrame([(one,)], "value string").coalesce(1).write.text(f"{folder}/metadata")
    spark.createDataFrame(heads, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{folder}/treesMetadata")
    spark.createDataFrame(nodes, kind, verifySchema=False).coalesce(1).write.parquet(f"{folder}/data")
    return GBTClassificationModel.load(folder)


def fit(train: DataFrame, names: list[str], of: GBTClassifier) -> GBTClassificationModel:
    """What of.fit gives, from rows with the named features, label (0 or 1) and is_val; rows with is_val stop the rounds, as validationIndicatorCol does."""
    spark = train.sparkSession
    prepare(spark)
    p = {k: of.getOrDefault(k) for k in ("stepSize", "maxDepth", "minInstancesPerNode", "validationTol", "seed")} | {"share": float(of.getFeatureSubsetStrategy())}
    bins, width = of.getMaxBins(), len(names)
    cuts = thresholds(train, names, bins)
    parts = cut(train.select(*names, "label", "is_val").mapInArrow(partial(_binned, names, cuts), "n long, label binary, is_val binary, key binary, bins binary"))
    made = partial(Rows, width=width, seed=p["seed"], rate=of.getSubsamplingRate(), bins=bins)
    total = parts.agg(F.sum("n")).first()[0]
    if not total:
        raise ValueError("no rows to train on")
    if total * width <= HELD:
        got = parts.toArrow()
        rows = made(list(zip(*[got.column(c).to_pylist() for c in got.column_names], strict=True)))
        del got
        trees, keep = boost(partial(rows.answer, bins=bins), of.getMaxIter(), p)
    else:
        trees, keep = boost(_jobs(parts, int(total), made, bins), of.getMaxIter(), p)
    return _stored(spark, trees[:keep], cuts, of)


def _jobs(parts: DataFrame, total: int, made: Callable[[list], Rows], bins: int) -> Callable:
    """step, by a job: partitions' sums are added on the way, and finished trees are broadcast every 20 rounds."""
    context, name = parts.sparkSession.sparkContext, uuid.uuid4().hex
    spread = parts.rdd.map(tuple)
    spread = spread.coalesce(min(spread.getNumPartitions(), max(context.defaultParallelism, total // ROWS))).persist()
    deep = 1 if spread.getNumPartitions() <= 64 else 2
    old = [context.broadcast([])]

    def step(trees: list[dict], levels: list, wanted: list[int]) -> tuple[np.ndarray, np.ndarray]:
        if len(trees) >= len(old[0].value) + 20:
            old[0].destroy()
            old[0] = context.broadcast([{k: t[k] for k in ("levels", "leaves", "weight")} for t in trees])
        new = trees[len(old[0].value) :]
        work = partial(_answers, name, made, old[0], new, levels, wanted, bins)
        return spread.mapPartitionsWithIndex(work).treeReduce(lambda a, b: tuple(map(add, a, b)), deep)

    return step
