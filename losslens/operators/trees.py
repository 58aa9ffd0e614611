"""Forests and boosted trees over one binned matrix, many fits at a time.

Every feature is binned once.  A row then is its bins, a label and a part for
each scenario (a fold of its training rows, ``TEST`` or ``ABSENT``), so fits on
other labels, folds, features or parameters read the same narrow table.  All
trees of all fits grow together, level by level: a pass routes each row through
the trees so far, counts (node, feature, bin) cells in the tasks that hold the
rows, and adds them up by node in a shuffle that carries only cells with rows;
the best cut of each node comes back to the driver, as models do.  A pass never
holds more than ``CELLS`` cells in a task, further nodes wait for the next.

Bootstrap counts, row shares and the features tried at a node are hashes of the
row, the tree's number and the node's path.  So a tree depends on its own fit
only: whatever else grows beside it, however rows are dealt, or whether a task
ran twice.  Forests that are only measured (``forest_measures``) never lie in the
driver: a piece of their trees grows, scores the rows held out and is dropped.  A forest of 100 trees is the first 100 of 200, one of depth 5 is
the upper part of one of depth 30, and 100 rounds of boosting are the first 100
of 200: those grid points are scored from partial sums of one fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from losslens.operators.ordered import positions
from losslens.session import cut_lineage, stored

BINS = 32
NULL_BIN = 255
TEST, ABSENT = -1, -2
CELLS = 1 << 23  # cells that a task counts in one pass
CELLS_ADDED = 1 << 19  # cells that a task adds up, so that small passes are small jobs
TREE_CELLS = 1 << 21  # cells that a task counts at a time for one tree
CUT_NODES = 512  # nodes of one tree whose cuts are found together, in the processor's cache
NODES = 64  # nodes added up as one block
ROW_FITS = 1 << 26  # rows x fits up to which boosting sends the rows, at most FOREST_ROWS, to the tasks
FOREST_ROWS = 1 << 20  # rows up to which they are sent to the tasks that grow trees
TREES = 4800  # trees that grow at a time
HELD_NODES = 1 << 22  # nodes of trees that the driver holds at a time, some 60 bytes each
PIECE = 50  # trees that are grown, scored and dropped together
STEP = 10  # rounds of boosting between two stored margins
_POISSON = np.exp(-1.0) * np.cumsum([1, 1, 1 / 2, 1 / 6, 1 / 24, 1 / 120, 1 / 720, 1 / 5040, 1 / 40320])
_CUTS = pa.schema([("slot", pa.int64()), ("feature", pa.int32()), ("bin", pa.int32()), ("gain", pa.float64()),
                   ("low", pa.list_(pa.float64())), ("total", pa.list_(pa.float64()))])
_SPLITS = "slot long, feature int, bin int, gain double, low array<double>, total array<double>"


@dataclass(frozen=True)
class Forest:
    """``fold`` is held out; TEST means that all training rows are used.  Its
    trees are numbered from ``first``."""
    name: object
    scenario: int
    fold: int
    features: tuple[int, ...]
    leaf: int
    trees: int
    depth: int
    first: int = 0


@dataclass(frozen=True)
class Boost:
    name: object
    scenario: int
    fold: int
    features: tuple[int, ...]
    depth: int
    rate: float
    share: float
    rounds: int


# ------------------------------------------------------------------ the binned matrix
def bin_edges(df: DataFrame, features, bins: int = BINS) -> list[np.ndarray]:
    """Cuts of each feature at its quantiles (a sketch; features x bins numbers)."""
    found = df.approxQuantile(list(features), [i / bins for i in range(1, bins)], 1 / (8 * bins))
    return [np.unique(np.array(q, float)) for q in found]


def bin_column(features, edges: list[np.ndarray]):
    """Binary column: for each feature the number of cuts below the value."""
    @F.arrow_udf("binary")
    def bins(*columns: pa.Array) -> pa.Array:
        out = np.empty((len(columns[0]), len(columns)), np.uint8)
        for j, c in enumerate(columns):
            x = c.to_numpy(zero_copy_only=False).astype(float)
            out[:, j] = np.where(np.isnan(x), NULL_BIN, np.searchsorted(edges[j], x, "left"))
        at = np.arange(0, out.size + 1, out.shape[1], dtype=np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(at), pa.py_buffer(out.tobytes())])
    return bins(*[F.col(c).cast("double") for c in features])


def bin_rows(df: DataFrame, id_col: str, features, edges: list[np.ndarray]) -> DataFrame:
    """(id, row_key, bins, labels, parts); ``df`` has the last two as arrays."""
    return df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col).cast("string")).alias("row_key"),
                     bin_column(features, edges).alias("bins"), "labels", "parts")


def _matrix(batch: pa.RecordBatch, fills: np.ndarray | None, whole: bool = True):
    """Bins (by scenario, as nulls are filled by its bins), labels and parts of
    a batch; ``whole``: a null that nothing fills is an error."""
    raw = batch.column("bins")
    n = batch.num_rows
    joined = np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(n, -1)
    labels = batch.column("labels").flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.int64)
    parts = batch.column("parts").flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.int64)
    null = joined == NULL_BIN
    if whole and fills is None and null.any():
        raise ValueError("nulls in the features and nothing to fill them with")

    def bins(scenario: int) -> np.ndarray:
        return np.where(null, fills[scenario], joined) if fills is not None and null.any() else joined
    return bins, labels, parts


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _uniform(keys: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) of each (row, salt)."""
    return (_mix(keys.view(np.uint64)[:, None] ^ _mix(salt)[None, :]) >> np.uint64(11)) * 2.0**-53


def part_counts(rows: DataFrame) -> dict[tuple[int, int, int], int]:
    """Rows by (scenario, part, label)."""
    found = (rows.select(F.posexplode(F.arrays_zip("labels", "parts")).alias("s", "x"))
             .groupBy("s", "x.parts", "x.labels").count().collect())  # scenarios x (folds + 2) x 2
    return {(r[0], r[1], r[2]): r[3] for r in found}


def _training(counts: dict, scenario: int, fold: int) -> tuple[int, int]:
    """Training rows of each class without a fold."""
    return tuple(sum(n for (s, p, y), n in counts.items() if s == scenario and p >= 0 and p != fold and y == c)
                 for c in (0, 1))


# ------------------------------------------------------------------ adding up and cutting
def _emit(block: np.ndarray, where: np.ndarray, cells: np.ndarray) -> pa.RecordBatch:
    """Cells with rows, one output row per block; ``block`` is ascending."""
    ids, start = np.unique(block, return_index=True)
    ends = [*start[1:], len(block)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(np.full(len(ids), TaskContext.get().partitionId()), pa.int64()),
         pa.array([where[a:b].astype("<i8").tobytes() for a, b in zip(start, ends)], pa.binary()),
         pa.array([np.ascontiguousarray(cells[a:b]).astype("<f8").tobytes() for a, b in zip(start, ends)], pa.binary())],
        ["block", "task", "places", "cells"])


def _add_up(shape: tuple[int, int, int, int], cut):
    """Blocks in order, one at a time; ``cut`` gives the best cuts of a block."""
    nodes, tried, bins, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, cells = None, None
        for batch in batches:
            for b, places, values in zip(*(batch.column(c).to_pylist() for c in ("block", "places", "cells"))):
                if b != block:
                    if cells is not None:
                        yield cut(block, cells)
                    block, cells = b, np.zeros((nodes, tried, bins, width))
                cells.reshape(-1, width)[np.frombuffer(places, "<i8")] += np.frombuffer(values, "<f8").reshape(-1, width)
        if cells is not None:
            yield cut(block, cells)
    return run


def _lists(x: np.ndarray) -> pa.Array:
    """A column with a list for each row of a matrix."""
    at = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.ascontiguousarray(x, dtype=float).ravel()))


def _best(slots: np.ndarray, gain: np.ndarray, low: list[np.ndarray], total: np.ndarray, feature: np.ndarray) -> pa.RecordBatch:
    """The best cut of each node; feature -1 where none gains.  ``low``: one array
    of (node, feature, bin) for each sum."""
    n, tried, bins = gain.shape
    flat = gain.reshape(n, -1)
    most = flat.max(1, keepdims=True)
    best = (flat >= most - 1e-9 * np.abs(most)).argmax(1)  # the first of equals, in whatever order rows were added up
    j, b = best // bins, best % bins
    row = np.arange(n)
    top = gain[row, j, b]
    found = top > 1e-12
    return pa.RecordBatch.from_arrays(
        [pa.array(slots, pa.int64()), pa.array(np.where(found, feature[row, j], -1), pa.int32()), pa.array(b, pa.int32()),
         pa.array(np.where(found, top, 0.0)), _lists(np.stack([v[row, j, b] for v in low], 1)), _lists(total)],
        ["slot", "feature", "bin", "gain", "low", "total"])


def _passed(rows: DataFrame, count, shape, cut, blocks: int) -> dict[str, np.ndarray]:
    """One pass: counted in tasks, added up by block, cuts to the driver."""
    cells = blocks * shape[0] * shape[1] * shape[2] * shape[3]
    to = max(1, min(rows.sparkSession.sparkContext.defaultParallelism, cells // CELLS_ADDED))
    found = (rows.mapInArrow(count, "block long, task long, places binary, cells binary")
             .repartition(to, "block").sortWithinPartitions("block", "task")
             .mapInArrow(_add_up(shape, cut), _SPLITS).toArrow())
    return _as_arrays(found.to_batches(), shape[3])


def _as_arrays(cuts: list[pa.RecordBatch], width: int) -> dict[str, np.ndarray]:
    """Cuts as arrays, in order of slots."""
    found = pa.Table.from_batches(cuts, _CUTS)
    out = {c: found.column(c).to_numpy() for c in ("slot", "feature", "bin", "gain")}
    for c in ("low", "total"):
        out[c] = found.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    order = np.argsort(out["slot"])
    return {c: x[order] for c, x in out.items()}


# ------------------------------------------------------------------ forests
class Trees:
    """Nodes of the trees of several fits; a child's number is its left
    sibling's or one more."""

    def __init__(self, fits: list[Forest], weights: list[tuple[float, float]], seed: int):
        self.fits, self.weights = fits, np.array(weights, float).reshape(-1, 2)
        self.fit = np.repeat(np.arange(len(fits)), [f.trees for f in fits])
        self.number = np.concatenate([f.first + np.arange(f.trees) for f in fits])  # of the tree in its fit
        n = len(self.fit)
        self.tree = np.arange(n)
        self.feature, self.bin = np.full(n, -1, np.int16), np.zeros(n, np.uint8)
        self.left, self.depth = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.gain, self.rows = np.zeros(n), np.zeros((n, 2))
        self.path = _mix(_mix(np.array([seed], np.uint64)) ^ self.number.astype(np.uint64))

    def cut(self, nodes: np.ndarray, found: dict[str, np.ndarray]) -> np.ndarray:
        """Cuts nodes as found; returns the children."""
        self.rows[nodes] = found["total"]
        at = np.flatnonzero(found["feature"] >= 0)
        node = nodes[at]
        left = len(self.tree) + 2 * np.arange(len(at))
        self.feature[node], self.bin[node] = found["feature"][at], found["bin"][at]
        self.left[node], self.gain[node] = left, found["gain"][at]
        low, total = found["low"][at], found["total"][at]

        def pairs(a, b):
            return np.stack([a, b], 1).reshape(-1, *a.shape[1:])
        new = 2 * len(at)
        self.tree = np.append(self.tree, np.repeat(self.tree[node], 2))
        self.feature = np.append(self.feature, np.full(new, -1, np.int16))
        self.bin = np.append(self.bin, np.zeros(new, np.uint8))
        self.left = np.append(self.left, np.zeros(new, np.int64))
        self.depth = np.append(self.depth, np.repeat(self.depth[node] + 1, 2))
        self.gain = np.append(self.gain, np.zeros(new))
        self.rows = np.concatenate([self.rows, pairs(low, total - low)])
        path = self.path[node]
        self.path = np.append(self.path, pairs(_mix(path ^ np.uint64(1)), _mix(path ^ np.uint64(2))))
        return np.arange(len(self.tree) - new, len(self.tree))

    def chance(self) -> np.ndarray:
        """Weighted share of label 1 at each node."""
        w = self.rows * self.weights[self.fit[self.tree]]
        total = w.sum(1)
        return np.divide(w[:, 1], total, out=np.full(len(total), 0.5), where=total > 0)

    def shares(self, fit: int, trees: int, depth: int) -> np.ndarray:
        """Sum over trees of the share of the loss that each feature takes away."""
        features = self.fits[fit].features
        own = (self.fit[self.tree] == fit) & (self.number[self.tree] < trees) & (self.depth < depth) & (self.feature >= 0)
        by = np.zeros((len(self.fit), max(features) + 1))
        np.add.at(by, (self.tree[own], self.feature[own]), self.gain[own])
        total = by.sum(1)
        by = by[total > 0] / total[total > 0, None]
        return by.sum(0)[list(features)]

    def importances(self, fit: int, trees: int, depth: int) -> np.ndarray:
        """Mean over trees of the share of the loss that each feature takes away."""
        return _of_one(self.shares(fit, trees, depth))


def _of_one(shares: np.ndarray) -> np.ndarray:
    return shares / shares.sum() if shares.sum() > 0 else shares


def _routed(feature, bins_at, left, roots, x, levels: int) -> np.ndarray:
    """Node of each (row, tree) after so many levels."""
    node = np.broadcast_to(roots, (len(x), len(roots))).copy()
    row = np.arange(len(x))[:, None]
    for _ in range(levels):
        f = feature[node]
        node = np.where(f >= 0, left[node] + (x[row, np.maximum(f, 0)] > bins_at[node]), node)
    return node


def _tried(path: np.ndarray, features: tuple[int, ...], tried: int) -> np.ndarray:
    """The features tried at nodes: a draw of their paths."""
    ids = np.array(features, np.int64)
    order = np.argsort(_mix(path[:, None] ^ _mix(ids.astype(np.uint64) + np.uint64(7))[None, :]), axis=1, kind="stable")
    return np.sort(ids[order[:, :tried]], axis=1)


def _count_classes(state):
    """Bootstrap counts of (node, feature, bin, label) in the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = state.value
        tried = s["tried"]
        cells = np.zeros(tried.shape[0] * tried.shape[1] * BINS * 2)
        for batch in batches:
            bins, labels, parts = _matrix(batch, s["fills"])
            keys = batch.column("row_key").to_numpy()
            for f in s["fits"]:
                part = parts[:, f["scenario"]]
                row = np.flatnonzero((part >= 0) & (part != f["fold"]))
                if not len(row):
                    continue
                x, y = bins(f["scenario"])[row], labels[row, f["scenario"]]
                drawn = np.searchsorted(_POISSON, _uniform(keys[row], f["salts"]), "right")
                node = _routed(s["feature"], s["bin"], s["left"], f["roots"], x, s["level"])
                slot = s["slot"][node]
                r, t = np.nonzero((slot >= 0) & (drawn > 0))
                at, w = slot[r, t], drawn[r, t]
                for j in range(tried.shape[1]):
                    by = tried[at, j]
                    on = by >= 0
                    place = ((at * tried.shape[1] + j) * BINS + x[r, np.maximum(by, 0)]) * 2 + y[r]
                    np.add.at(cells, place[on], w[on])
        cells = cells.reshape(-1, 2)
        full = np.flatnonzero(cells.any(1))
        if len(full):
            per_block = NODES * tried.shape[1] * BINS
            yield _emit(full // per_block, full % per_block, cells[full])
    return run


def _class_cuts(slots: np.ndarray, cells: np.ndarray, weight: np.ndarray, leaf: np.ndarray, tried: np.ndarray) -> pa.RecordBatch:
    """Best cuts by the weighted Gini loss."""
    # by class: numpy is slow along an axis of two
    low = [cells[..., c].cumsum(2) for c in (0, 1)]
    total = [v[:, :1, -1:] for v in low]
    high = [t - v for t, v in zip(total, low)]
    w0, w1 = weight[:, 0, None, None], weight[:, 1, None, None]

    def loss(rows):  # weight x Gini
        a, b = rows[0] * w0, rows[1] * w1
        n = a + b
        a *= a
        b *= b
        a += b
        return n - np.divide(a, n, out=np.zeros_like(n), where=n > 0)
    gain = loss(total) - loss(low) - loss(high)
    least = leaf[:, None, None]
    fits = (low[0] + low[1] >= least) & (high[0] + high[1] >= least) & (tried >= 0)[:, :, None]
    return _best(slots, np.where(fits, gain, -1.0), low, np.stack([t[:, 0, 0] for t in total], 1), tried)


def _cut_classes(state):
    def cut(block: int, cells: np.ndarray) -> pa.RecordBatch:
        s = state.value
        slots = np.arange(block * NODES, min((block + 1) * NODES, len(s["tried"])))
        return _class_cuts(slots, cells[:len(slots)], s["weights"][slots], s["leaf"][slots], s["tried"][slots])
    return cut


def _grow_tree(fit: Forest, weights: np.ndarray, path: np.ndarray, x: np.ndarray, y: np.ndarray,
               drawn: np.ndarray) -> dict[str, np.ndarray]:
    """One tree of the rows drawn for it: the levels of ``_grow``, each of which
    moves the rows of open nodes one node down.  Nodes are numbered from the
    root, 0."""
    tries, level = max(1, int(np.sqrt(len(fit.features)))), 0
    tree = {"feature": np.full(1, -1, np.int16), "bin": np.zeros(1, np.uint8), "left": np.zeros(1, np.int64),
            "depth": np.zeros(1, np.int64), "gain": np.zeros(1), "rows": np.zeros((1, 2))}
    nodes, slot = np.zeros(1, np.int64), np.zeros(len(x), np.int64)
    while len(nodes):
        tried, found = _tried(path, fit.features, tries), []
        size = max(1, TREE_CELLS // (tries * BINS * 2))
        for k in range(0, len(nodes), size):
            some = np.arange(k, min(k + size, len(nodes)))
            row = slice(None) if len(some) == len(nodes) else np.flatnonzero((slot >= k) & (slot < k + size))
            at, n = slot[row] - k, drawn[row]
            own, cells = x[row], np.empty((len(some), tries, BINS, 2))
            flat, start, first = own.ravel(), np.arange(len(own)) * own.shape[1], at * (BINS * 2) + y[row]
            for j in range(tries):
                place = flat[start + tried[k:k + size, j][at]].astype(np.int64)
                place *= 2
                place += first
                cells[:, j] = np.bincount(place, n, len(some) * BINS * 2).reshape(-1, BINS, 2)
            for a in range(0, len(some), CUT_NODES):
                part = some[a:a + CUT_NODES]
                found.append(_class_cuts(part, cells[a:a + CUT_NODES], np.broadcast_to(weights, (len(part), 2)),
                                         np.full(len(part), fit.leaf), tried[part]))
        found = _as_arrays(found, 2)
        tree["rows"][nodes] = found["total"]
        cut = np.flatnonzero(found["feature"] >= 0)
        if not len(cut):
            break
        node, feature, place = nodes[cut], found["feature"][cut], found["bin"][cut]
        first, level = len(tree["left"]), level + 1
        tree["feature"][node], tree["bin"][node], tree["gain"][node] = feature, place, found["gain"][cut]
        tree["left"][node] = first + 2 * np.arange(len(cut))
        rows = np.stack([found["low"][cut], found["total"][cut] - found["low"][cut]], 1).reshape(-1, 2)
        for c, more in (("feature", np.full(len(rows), -1)), ("bin", np.zeros(len(rows))), ("left", np.zeros(len(rows))),
                        ("depth", np.full(len(rows), level)), ("gain", np.zeros(len(rows))), ("rows", rows)):
            tree[c] = np.concatenate([tree[c], more.astype(tree[c].dtype)])
        grows = (rows.min(1) > 0) & (rows.sum(1) >= 2 * fit.leaf) & (level < fit.depth)
        rank = np.full(len(nodes), -1, np.int64)  # of the nodes that were cut
        rank[cut] = np.arange(len(cut))
        child = np.cumsum(grows) - 1
        at = rank[slot]
        keep = np.flatnonzero(at >= 0)
        at = at[keep]
        to = 2 * at + (x[keep, feature[at]] > place[at])
        on = grows[to]
        keep = keep[on]
        slot, x, y, drawn = child[to[on]], x[keep], y[keep], drawn[keep]
        path = np.stack([_mix(path[cut] ^ np.uint64(1)), _mix(path[cut] ^ np.uint64(2))], 1).ravel()[grows]
        nodes = first + np.flatnonzero(grows)
    return tree


_NODE_COLUMNS = {"feature": "<i2", "bin": "u1", "left": "<i4", "depth": "u1", "gain": "<f8", "rows": "<i4"}


def _grow_dealt(rows: DataFrame, trees: Trees, fills: np.ndarray | None) -> None:
    """The same trees for at most ``FOREST_ROWS`` rows: every task has all rows
    and grows some of the trees, down to their leaves."""
    spark, fits, weights = rows.sparkSession, trees.fits, trees.weights
    sent = spark.sparkContext.broadcast(rows.orderBy("row_key").drop("id").toArrow())  # at most FOREST_ROWS rows
    roots, n = trees.path.copy(), len(trees.fit)
    of, numbers = trees.fit, trees.number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, last = None, None
        for batch in batches:
            for t in batch.column("tree").to_pylist():
                if table is None:
                    held = sent.value.combine_chunks().to_batches()
                    if not held:
                        return
                    table, keys = _matrix(held[0], fills), held[0].column("row_key").to_numpy()
                f = fits[of[t]]
                if last != of[t]:
                    bins, labels, parts = table
                    part = parts[:, f.scenario]
                    row, last = np.flatnonzero((part >= 0) & (part != f.fold)), of[t]
                    x, y, key = bins(f.scenario)[row], labels[row, f.scenario], keys[row]
                number = numbers[t:t + 1].astype(np.uint64)
                drawn = np.searchsorted(_POISSON, _uniform(key, number)[:, 0], "right")
                on = np.flatnonzero(drawn)
                if not len(on):
                    continue
                tree = _grow_tree(f, weights[of[t]], roots[t:t + 1], x[on], y[on], drawn[on].astype(float))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t], pa.int32()), *[pa.array([tree[c].astype(k).tobytes()], pa.binary())
                                                  for c, k in _NODE_COLUMNS.items()]], ["tree", *_NODE_COLUMNS])

    tasks = max(1, min(n, 4 * spark.sparkContext.defaultParallelism))
    dealt = spark.range(n).select(F.col("id").cast("int").alias("tree")).repartitionByRange(tasks, "tree")
    found = dealt.sortWithinPartitions("tree").mapInArrow(
        run, "tree int, " + ", ".join(f"{c} binary" for c in _NODE_COLUMNS)).toArrow()  # the trees, as models do
    grown = {c: [np.frombuffer(v, k) for v in found.column(c).to_pylist()] for c, k in _NODE_COLUMNS.items()}
    sent.destroy()
    tree = found.column("tree").to_numpy()
    if not len(tree):
        return
    more = np.array([len(v) for v in grown["feature"]]) - 1  # nodes below the root
    base = n + np.cumsum(more) - more

    def spread(c, dtype):
        out = np.concatenate([np.zeros(n, dtype), *[v[1:].astype(dtype) for v in grown[c]]])
        out[tree] = [v[0] for v in grown[c]]
        return out
    left = np.concatenate([np.zeros(n, np.int64), *[np.where(f[1:] >= 0, v[1:] + (b - 1), 0)
                                                    for f, v, b in zip(grown["feature"], grown["left"], base)]])
    left[tree] = [v[0] + b - 1 if f[0] >= 0 else 0 for f, v, b in zip(grown["feature"], grown["left"], base)]
    feature = np.concatenate([np.full(n, -1, np.int16), *[v[1:].astype(np.int16) for v in grown["feature"]]])
    feature[tree] = [v[0] for v in grown["feature"]]
    counts = np.concatenate([np.zeros((n, 2)), *[v.reshape(-1, 2)[1:].astype(float) for v in grown["rows"]]])
    counts[tree] = np.array([v[:2] for v in grown["rows"]])
    trees.tree = np.concatenate([np.arange(n), np.repeat(tree, more)])
    trees.feature, trees.left, trees.rows = feature, left, counts
    trees.bin, trees.depth, trees.gain = spread("bin", np.uint8), spread("depth", np.int64), spread("gain", float)
    trees.path = np.append(roots, np.zeros(len(left) - n, np.uint64))  # not needed once grown


def _grow(rows: DataFrame, trees: Trees, fills: np.ndarray | None) -> None:
    spark = rows.sparkSession
    tries = np.array([max(1, int(np.sqrt(len(f.features)))) for f in trees.fits])
    depth, leaf = np.array([f.depth for f in trees.fits]), np.array([f.leaf for f in trees.fits])
    open_nodes, level = np.arange(len(trees.tree)), 0
    while len(open_nodes):
        children, width = [], int(tries.max())
        size = max(1, CELLS // (width * BINS * 2))
        for k in range(0, len(open_nodes), size):
            nodes = open_nodes[k:k + size]
            fit = trees.fit[trees.tree[nodes]]
            tried = np.full((len(nodes), width), -1, np.int64)
            for f in np.unique(fit):
                own = fit == f
                tried[own, :tries[f]] = _tried(trees.path[nodes[own]], trees.fits[f].features, int(tries[f]))
            slot = np.full(len(trees.tree), -1, np.int64)
            slot[nodes] = np.arange(len(nodes))
            growing = np.unique(trees.tree[nodes])
            state = spark.sparkContext.broadcast({
                "tried": tried, "fills": fills, "level": level, "slot": slot, "feature": trees.feature, "bin": trees.bin,
                "left": trees.left, "weights": trees.weights[fit], "leaf": leaf[fit],
                "fits": [{"scenario": trees.fits[f].scenario, "fold": trees.fits[f].fold,
                          "roots": growing[trees.fit[growing] == f],
                          "salts": trees.number[growing[trees.fit[growing] == f]].astype(np.uint64)}
                         for f in np.unique(trees.fit[growing])]})
            found = _passed(rows, _count_classes(state), (NODES, width, BINS, 2), _cut_classes(state), -(-len(nodes) // NODES))
            children.append(trees.cut(nodes[found["slot"]], found))
            state.destroy()
        level += 1
        new = np.concatenate(children)
        n = trees.rows[new]
        of = trees.fit[trees.tree[new]]
        open_nodes = new[(n.min(1) > 0) & (n.sum(1) >= 2 * leaf[of]) & (level < depth[of])]


def _nodes(counts: dict, fit: Forest) -> int:
    """Nodes that a tree has at most, or nearly: leaves count drawn rows."""
    return min((2 << min(fit.depth, 40)) - 1, 2 * (sum(_training(counts, fit.scenario, fit.fold)) // fit.leaf) + 1)


def grow_forests(rows: DataFrame, fits: list[Forest], fills: np.ndarray | None = None, seed: int = 42) -> Iterator[Trees]:
    """Grows fits a group of at most ``TREES`` trees and, as far as rows and leaves
    tell, ``HELD_NODES`` nodes at a time.

    Up to ``FOREST_ROWS`` rows, they are sent to the tasks and the trees are
    dealt over them; beyond that rows stay where they are and every level is a
    pass over them.  Both make the same trees."""
    counts, n_rows = part_counts(rows), rows.count()
    group, size, held = [], 0, 0
    for f in [*fits, None]:
        if group and (f is None or size + f.trees > TREES or held + f.trees * _nodes(counts, f) > HELD_NODES):
            weights = []
            for g in group:
                n = _training(counts, g.scenario, g.fold)
                weights.append([sum(n) / (2 * c) if c else 1.0 for c in n])
            trees = Trees(group, weights, seed)
            (_grow_dealt if n_rows <= FOREST_ROWS else _grow)(rows, trees, fills)
            yield trees
            group, size, held = [], 0, 0
        if f is not None:
            group.append(f)
            size += f.trees
            held += f.trees * _nodes(counts, f)


def score_forests(rows: DataFrame, trees: Trees, points: list[tuple[int, int]], fills: np.ndarray | None = None,
                  every_row_of: int | None = None) -> DataFrame:
    """(fit, id, label, scores): mean chance over the first trees down to a
    depth, for each point (trees, depth), of the rows that each fit holds out
    (``every_row_of``: of all rows by that fit)."""
    ends = np.searchsorted(trees.fit, np.arange(len(trees.fits) + 1))
    state = rows.sparkSession.sparkContext.broadcast({
        "feature": trees.feature, "bin": trees.bin, "left": trees.left, "chance": trees.chance(), "fills": fills,
        "fits": [(i, f.scenario, f.fold, np.arange(ends[i], ends[i + 1]), f.depth) for i, f in enumerate(trees.fits)
                 if every_row_of is None or i == every_row_of]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = state.value
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, labels, parts = _matrix(batch, s["fills"])
            for i, scenario, fold, roots, deepest in s["fits"]:
                row = (np.flatnonzero(parts[:, scenario] == fold) if every_row_of is None else np.arange(batch.num_rows))
                if not len(row):
                    continue
                x, out, at = bins(scenario)[row], np.zeros((len(row), len(points))), 0
                node = _routed(s["feature"], s["bin"], s["left"], roots, x, 0)
                for depth in sorted({min(d, deepest) for _, d in points}):
                    for _ in range(at, depth):
                        f = s["feature"][node]
                        node = np.where(f >= 0, s["left"][node] + (x[np.arange(len(x))[:, None], np.maximum(f, 0)]
                                                                  > s["bin"][node]), node)
                    at = depth
                    chance = s["chance"][node]
                    for k, (n, d) in enumerate(points):
                        if min(d, deepest) == depth:
                            out[:, k] = chance[:, :n].mean(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), i), pa.int32()), batch.column("id").take(pa.array(row)),
                     pa.array(labels[row, scenario], pa.int32()), _lists(out)],
                    ["fit", "id", "label", "scores"])
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"fit int, id {kind}, label int, scores array<double>")


# ------------------------------------------------------------------ forests that are only measured
BLOCK = 1 << 16  # rows whose scores move together
_SUMS = "fit int, last int, block int, sums binary, shares array<double>"


def _pieces(fits: list[Forest], points: list[tuple[int, int]], size) -> list[tuple[int, Forest]]:
    """(number of a fit, part of it): at most ``size(fit)`` trees, none beyond a
    point's last."""
    out = []
    for i, f in enumerate(fits):
        ends = sorted({*range(size(f), f.trees, size(f)), *[n for n, _ in points if n < f.trees], f.trees})
        out += [(i, replace(f, first=a, trees=b - a)) for a, b in zip([0, *ends], ends)]
    return out


def _class_weights(counts: dict, fit: Forest) -> np.ndarray:
    n = _training(counts, fit.scenario, fit.fold)
    return np.array([sum(n) / (2 * c) if c else 1.0 for c in n])


def _add_scores(tree: dict[str, np.ndarray], weights: np.ndarray, x: np.ndarray, depths: list[int], sums: np.ndarray) -> None:
    """Adds the chances of one tree, cut off at each depth."""
    w = tree["rows"] * weights
    total = w.sum(1)
    chance = np.divide(w[:, 1], total, out=np.full(len(total), 0.5), where=total > 0)
    feature, place, left = tree["feature"].astype(np.int64), tree["bin"], tree["left"]
    flat, width = x.ravel(), x.shape[1]
    node, row, at = np.zeros(len(x), np.int64), np.arange(len(x)), 0  # row: of those that are not at a leaf
    for k, depth in enumerate(depths):
        while at < depth and len(row):
            own = node[row]
            f = feature[own]
            on = f >= 0
            row, own, f = row[on], own[on], f[on]
            node[row] = left[own] + (flat[row * width + f] > place[own])
            at += 1
        sums[:, k] += chance[node]


def _measured(y: np.ndarray, s: np.ndarray) -> tuple[float, list[int]]:
    """Exact AUC (average ranks), and rows by label and ``s > 0.5``."""
    _, at, n = np.unique(s, return_inverse=True, return_counts=True)
    rank = n.cumsum() - (n - 1) / 2
    ones = int(y.sum())
    both = ones * (len(y) - ones)
    auc = (rank[at[y == 1]].sum() - ones * (ones + 1) / 2) / both if both else float("nan")
    return auc, np.bincount(y * 2 + (s > 0.5), minlength=4).tolist()


def _dealt_pieces(rows: DataFrame, fits: list[Forest], points, counts: dict, fills, seed: int):
    """At most ``FOREST_ROWS`` rows: they are sent to the tasks, and pieces of fits
    are dealt over these.  A piece gives, for the rows that its fit holds out, the
    sums of its trees' chances at each depth, and the shares of the features.

    Also gives a function that adds up the pieces of a fit, in order: (fit,
    ids, labels, scores by point, shares by point)."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(rows.orderBy("row_key").toArrow())  # at most FOREST_ROWS rows
    pieces, weights = _pieces(fits, points, lambda f: PIECE), [_class_weights(counts, f) for f in fits]
    depths = sorted({d for _, d in points})

    def table():
        held = sent.value.combine_chunks().to_batches()
        return (held[0], *_matrix(held[0], fills)) if held else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = None, None
        for batch in batches:
            for p in batch.column("piece").to_pylist():
                held = held or table()
                if held is None:
                    return
                i, f = pieces[p]
                if last != i:
                    (batch, bins, labels, parts), last = held, i
                    part = parts[:, f.scenario]
                    row, out = np.flatnonzero((part >= 0) & (part != f.fold)), np.flatnonzero(part == f.fold)
                    x, y, key = bins(f.scenario)[row], labels[row, f.scenario], batch.column("row_key").to_numpy()[row]
                    scored = bins(f.scenario)[out]
                sums, shares = np.zeros((len(out), len(depths))), np.zeros((len(depths), len(f.features)))
                for number in range(f.first, f.first + f.trees):
                    salt = np.array([number], np.uint64)
                    drawn = np.searchsorted(_POISSON, _uniform(key, salt)[:, 0], "right")
                    on = np.flatnonzero(drawn)
                    if not len(on):
                        sums += 0.5
                        continue
                    root = _mix(_mix(np.array([seed], np.uint64)) ^ salt)
                    tree = _grow_tree(f, weights[i], root, x[on], y[on], drawn[on].astype(float))
                    _add_scores(tree, weights[i], scored, depths, sums)
                    for k, depth in enumerate(depths):
                        own = (tree["depth"] < depth) & (tree["feature"] >= 0)
                        by = np.bincount(tree["feature"][own], tree["gain"][own], max(f.features) + 1)
                        shares[k] += by[list(f.features)] / by.sum() if by.sum() > 0 else 0.0
                for b in range(0, max(len(out), 1), BLOCK):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i], pa.int32()), pa.array([f.first + f.trees], pa.int32()), pa.array([b // BLOCK], pa.int32()),
                         pa.array([sums[b:b + BLOCK].tobytes()], pa.binary()),
                         _lists(shares.reshape(1, -1)) if not b else pa.nulls(1, pa.list_(pa.float64()))],
                        ["fit", "last", "block", "sums", "shares"])

    n = len(pieces)
    dealt = spark.createDataFrame([(i,) for i in range(n)], "piece int").repartitionByRange(n, "piece")
    found = stored(dealt.mapInArrow(run, _SUMS), "forest-pieces")

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held, now, total, shares, out, given = None, None, None, None, None, None

        def done():
            batch, bins, labels, parts = held
            f = fits[now]
            row = np.flatnonzero(parts[:, f.scenario] == f.fold)
            return now, batch.column("id").take(pa.array(row)), labels[row, f.scenario], out, given
        for batch in batches:
            for i, last, b, raw, more in zip(*(batch.column(c).to_pylist() for c in ("fit", "last", "block", "sums", "shares"))):
                if i != now:
                    if now is not None:
                        yield done()
                    held = held or table()
                    n = int((held[3][:, fits[i].scenario] == fits[i].fold).sum())
                    now, total, shares = i, np.zeros((n, len(depths))), np.zeros((len(depths), len(fits[i].features)))
                    out, given = np.zeros((n, len(points))), np.zeros((len(points), len(fits[i].features)))
                at = slice(b * BLOCK, (b + 1) * BLOCK)
                total[at] += np.frombuffer(raw, "<f8").reshape(-1, len(depths))
                shares += 0.0 if more is None else np.array(more).reshape(shares.shape)
                for k, (n, depth) in enumerate(points):
                    if min(n, fits[i].trees) == last:
                        out[at, k] = total[at, depths.index(depth)] / last
                        given[k] = shares[depths.index(depth)]
        if now is not None:
            yield done()
    tasks = max(1, min(len(fits), spark.sparkContext.defaultParallelism))
    return found.repartition(tasks, "fit").sortWithinPartitions("fit", "last", "block"), added, sent


def _passed_pieces(rows: DataFrame, fits: list[Forest], points, counts: dict, fills, seed: int):
    """More rows: pieces grow by passes over the rows, as many at a time as
    ``HELD_NODES`` allows.  (fit, id, label, scores by point), shares by fit."""
    of = {f: max(1, min(f.trees, HELD_NODES // _nodes(counts, f))) for f in fits}
    pieces = iter(_pieces(fits, points, of.get))
    depths, shares, parts = sorted({d for _, d in points}), [np.zeros((len(points), len(f.features))) for f in fits], []
    # rows have numbers, since an id may come twice
    rows = cut_lineage(rows.withColumn("id", F.struct("id", F.monotonically_increasing_id().alias("row"))))
    for trees in grow_forests(rows, [f for _, f in _pieces(fits, points, of.get)], fills, seed):
        own = [next(pieces)[0] for _ in trees.fits]
        scored = score_forests(rows, trees, [(max(f.trees for f in fits), d) for d in depths], fills)
        at = F.array(*[F.struct(F.lit(i).alias("fit"), F.lit(f.first + f.trees).alias("last"), F.lit(float(f.trees)).alias("n"))
                       for i, f in zip(own, trees.fits)])[F.col("fit")]
        parts.append(stored(scored.select(at.alias("at"), "id", "label", "scores").select(
            "at.fit", "at.last", "id", "label", F.expr("transform(scores, s -> s * at.n)").alias("sums")), "forest-pieces"))
        for i, (number, f) in enumerate(zip(own, trees.fits)):
            for k, (most, depth) in enumerate(points):
                if f.first < most:
                    shares[number][k] += trees.shares(i, most, depth)
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    every = every.groupBy("fit", "id").agg(F.max("label").alias("label"), F.sort_array(F.collect_list(F.struct("last", "sums"))).alias("p"))
    trees_of = F.array(*[F.lit(f.trees) for f in fits])[F.col("fit")]
    # pieces are added in order, so that equal rows stay equal
    out = every.select("fit", F.col("id.id").alias("id"), "label", F.array(*[
        F.expr(f"aggregate(filter(p, x -> x.last <= {n}), 0D, (a, x) -> a + x.sums[{depths.index(d)}])")
        / F.least(F.lit(n), trees_of) for n, d in points]).alias("scores"))
    return out, shares


def forest_scores(rows: DataFrame, fits: list[Forest], points: list[tuple[int, int]], fills: np.ndarray | None = None,
                  seed: int = 42) -> DataFrame:
    """(fit, id, label, scores) of the rows that each fit holds out, as
    ``score_forests``; the trees are not kept."""
    counts = part_counts(rows)
    if rows.count() > FOREST_ROWS:
        return cut_lineage(_passed_pieces(rows, fits, points, counts, fills, seed)[0])
    found, added, sent = _dealt_pieces(rows, fits, points, counts, fills, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, ids, y, scores, _ in added(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), i), pa.int32()), ids, pa.array(y, pa.int32()),
                                              _lists(scores)], ["fit", "id", "label", "scores"])
    out = cut_lineage(found.mapInArrow(run, f"fit int, id {rows.schema['id'].dataType.simpleString()}, label int, "
                                            "scores array<double>"))
    sent.destroy()
    return out


def forest_measures(rows: DataFrame, fits: list[Forest], points: list[tuple[int, int]], fills: np.ndarray | None = None,
                    seed: int = 42) -> list[list[dict]]:
    """By fit and point (trees, depth): ``auc`` of the rows that the fit holds out,
    ``counts`` of them by (label, score > 0.5) and ``importances`` of its features.

    Neither trees nor scores come to the driver."""
    counts = part_counts(rows)
    out = [[{"auc": float("nan"), "counts": {}, "importances": np.zeros(len(f.features))} for _ in points] for f in fits]

    def put(i, k, auc, n, shares):
        out[i][k] = {"auc": auc, "counts": {(c // 2, c % 2): n[c] for c in range(4)}, "importances": _of_one(np.array(shares))}
    if rows.count() > FOREST_ROWS:
        scored, shares = _passed_pieces(rows, fits, points, counts, fills, seed)
        scored = cut_lineage(scored)
        aucs = auc_by_point(scored)
        found = (scored.select("fit", "label", F.posexplode("scores").alias("point", "s"))
                 .groupBy("fit", "point", "label", (F.col("s") > 0.5).cast("int").alias("p")).count().collect())
        n = {(r[0], r[1], r[2] * 2 + r[3]): r["count"] for r in found}  # fits x points x 4 rows
        for (i, k), auc in aucs.items():
            put(i, k, auc, [n.get((i, k, c), 0) for c in range(4)], shares[i][k])
        return out
    found, added, sent = _dealt_pieces(rows, fits, points, counts, fills, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, _, y, scores, shares in added(batches):
            for k in range(len(points) if len(y) else 0):
                auc, n = _measured(y, scores[:, k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([k], pa.int32()), pa.array([auc]), pa.array([n], pa.list_(pa.int64())),
                     _lists(shares[k:k + 1])], ["fit", "point", "auc", "n", "shares"])
    for r in found.mapInArrow(run, "fit int, point int, auc double, n array<long>, shares array<double>").collect():
        put(r.fit, r.point, r.auc, r.n, r.shares)  # fits x points rows
    sent.destroy()
    return out


# ------------------------------------------------------------------ boosting
def _margins(trees: list[dict], x: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Adds rounds (heap-numbered trees of all fits) to margins."""
    row, fit = np.arange(len(x))[:, None], np.arange(margin.shape[1])[None, :]
    for t in trees:
        at = _fallen(t, x, t["levels"], margin.shape[1])
        margin = margin + t["value"][fit, at]
    return margin


def _fallen(t: dict, x: np.ndarray, levels: int, fits: int) -> np.ndarray:
    """Heap number of the node of each (row, fit)."""
    row, fit = np.arange(len(x))[:, None], np.arange(fits)[None, :]
    at = np.zeros((len(x), fits), np.int64)
    for _ in range(levels):
        f = t["feature"][fit, at]
        at = np.where(f >= 0, 2 * at + 1 + (x[row, np.maximum(f, 0)] > t["bin"][fit, at]), at)
    return at


def _residual_cells(s: dict, x: np.ndarray, y: np.ndarray, part: np.ndarray, keys: np.ndarray, margin: np.ndarray,
                    cells: np.ndarray) -> None:
    """Adds rows, weight, residual and p(1 - p) by (fit, node), feature and bin."""
    fits, nodes, features = s["fits"], 1 << s["level"], s["features"]
    row = np.flatnonzero(part >= 0)
    x, y, part, keys = x[row], y[row], part[row], keys[row]
    margin = _margins(s["pending"], x, margin[row])[:, fits]
    p = 1 / (1 + np.exp(-margin))
    at = _fallen(s["tree"], x, s["level"], len(s["folds"]))[:, fits] - (nodes - 1)
    drawn = _uniform(keys, s["salt"]) < s["share"][fits][None, :]
    r, f = np.nonzero((at >= 0) & (part[:, None] != s["folds"][fits][None, :]) & drawn)
    at, w, p = at[r, f], s["weights"][y[r]], p[r, f]
    values = None, w, w * (y[r] - p), w * p * (1 - p)
    first = (f * nodes + at) * BINS
    for j in range(features):
        place = first + x[r, j]
        for k, v in enumerate(values):
            cells[:, j, :, k] += np.bincount(place, v, len(cells) * BINS).reshape(-1, BINS)


def _unpacked(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(column).to_pylist()), "<f8").reshape(batch.num_rows, -1)


def _count_residuals(state):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = state.value
        nodes, features, scenario = 1 << s["level"], s["features"], s["scenario"]
        cells = np.zeros((len(s["fits"]) * nodes, features, BINS, 4))
        for batch in batches:
            if batch.num_rows:
                bins, labels, parts = _matrix(batch, s["fills"])
                _residual_cells(s, bins(scenario), labels[:, scenario], parts[:, scenario],
                                batch.column("row_key").to_numpy(), _unpacked(batch, "margins"), cells)
        cells = cells.reshape(-1, 4)
        full = np.flatnonzero(cells[:, 0])
        if len(full):
            per_block = nodes * features * BINS
            yield _emit(full // per_block, full % per_block, cells[full])
    return run


def _cut_residuals(s: dict):
    """Best cuts by the weighted difference of mean residuals."""
    def cut(block: int, cells: np.ndarray) -> pa.RecordBatch:
        nodes = 1 << s["level"]
        fit = s["fits"][block]
        low = [cells[..., k].cumsum(2) for k in range(4)]
        total = [v[:, :1, -1:] for v in low]
        gain = np.where(s["uses"][fit][None, :, None], _apart(low, total), -1.0)
        feature = np.broadcast_to(np.arange(cells.shape[1]), (nodes, cells.shape[1]))
        return _best(block * nodes + np.arange(nodes), gain, low, np.stack([t[:, 0, 0] for t in total], 1), feature)
    return cut


def _apart(low: list[np.ndarray], total: list[np.ndarray]) -> np.ndarray:
    """Gains of cuts from rows, weights and residuals below them."""
    high = [t - v for t, v in zip(total[:3], low[:3])]
    both = low[1] + high[1]
    apart = (np.divide(low[2], low[1], out=np.zeros_like(both), where=low[1] > 0)
             - np.divide(high[2], high[1], out=np.zeros_like(both), where=high[1] > 0))
    gain = np.divide(low[1] * high[1], both, out=np.zeros_like(both), where=both > 0) * apart**2
    return np.where((low[0] > 0.5) & (high[0] > 0.5), gain, -1.0)


def _setting(fits: list[Boost], counts: dict, fills: np.ndarray | None) -> tuple[dict, np.ndarray]:
    """What all passes share, and the first margin of each fit."""
    scenario = fits[0].scenario
    n = _training(counts, scenario, TEST)
    weights = np.array([sum(n) / (2 * c) if c else 1.0 for c in n])
    first = []
    for f in fits:
        a, b = np.array(_training(counts, scenario, f.fold)) * weights
        first.append(np.log(b / a) if a and b else 0.0)
    features = 1 + max(max(f.features) for f in fits)
    uses = np.zeros((len(fits), features), bool)
    for i, f in enumerate(fits):
        uses[i, list(f.features)] = True
    return {"scenario": scenario, "fills": fills, "features": features, "folds": np.array([f.fold for f in fits]),
            "share": np.array([f.share for f in fits]), "weights": weights, "uses": uses}, np.array(first)


def _rounds(fits: list[Boost], shared: dict, points: list[int], seed: int, count, store, keep) -> np.ndarray:
    """Grows one tree of each fit a round; importances by point, fit, feature.

    ``count(state)`` is a pass over the rows and gives the best cuts,
    ``store(trees)`` adds rounds to the stored margins, ``keep(point)`` notes
    the margins of a point."""
    features = shared["features"]
    depth, rates = np.array([f.depth for f in fits]), np.array([f.rate for f in fits])
    rounds = np.array([f.rounds for f in fits])
    deepest, heap = int(depth.max()), (2 << int(depth.max())) - 1
    pending, gains, importances = [], np.zeros((len(fits), features)), []

    def newton(sums):
        return np.divide(sums[:, 2], sums[:, 3], out=np.zeros(len(sums)), where=sums[:, 3] > 1e-150)
    for number in range(int(rounds.max())):
        tree = {"feature": np.full((len(fits), heap), -1, np.int64), "bin": np.zeros((len(fits), heap), np.int64),
                "value": np.zeros((len(fits), heap)), "levels": deepest}
        open_nodes = np.zeros((len(fits), heap), bool)
        open_nodes[:, 0] = rounds > number
        for level in range(deepest):
            nodes, base = 1 << level, (1 << level) - 1
            grown = np.flatnonzero(open_nodes[:, base:base + nodes].any(1) & (depth > level))
            size = max(1, CELLS // (nodes * features * BINS * 4))
            for k in range(0, len(grown), size):
                some = grown[k:k + size]
                found = count(shared | {"fits": some, "level": level, "tree": tree, "pending": pending,
                                        "salt": np.array([seed * 1_000_003 + number], np.uint64)})
                fit, at = some[found["slot"] // nodes], base + found["slot"] % nodes
                rate = rates[fit]
                if level == 0:
                    tree["value"][fit, at] = rate * newton(found["total"])
                cut = (found["feature"] >= 0) & open_nodes[fit, at]
                fit, at, rate = fit[cut], at[cut], rate[cut]
                low, high = found["low"][cut], found["total"][cut] - found["low"][cut]
                tree["feature"][fit, at], tree["bin"][fit, at] = found["feature"][cut], found["bin"][cut]
                np.add.at(gains, (fit, found["feature"][cut]), found["gain"][cut])
                for side, sums in ((1, low), (2, high)):
                    tree["value"][fit, 2 * at + side] = rate * newton(sums)
                    open_nodes[fit, 2 * at + side] = sums[:, 0] > 1.5
        pending.append(tree)
        if number + 1 in points or len(pending) == STEP:
            store(pending)
            pending = []
        if number + 1 in points:
            keep(number + 1)
            total = gains.sum(1, keepdims=True)
            importances.append(np.divide(gains, total, out=np.zeros_like(gains), where=total > 0))
    return np.array(importances)


def boost(rows: DataFrame, fits: list[Boost], points: list[int], fills: np.ndarray | None = None,
          seed: int = 42) -> tuple[DataFrame, np.ndarray]:
    """All fits of one scenario, one tree each a round.

    (fit, id, label, scores) of held-out rows, a score (chance of label 1) per
    point (rounds, ascending), and each point's importances by fit and feature.
    Rows of a class weigh n / (2 n_c) by all training rows; leaves take Newton
    steps.

    The table is counted first.  Up to ``ROW_FITS`` rows x fits, the rows are
    sent to the tasks and the fits are dealt over them: a round on so few rows
    takes less time than the job that would share it out.  Beyond that rows
    stay where they are, every level of every round is a pass over them, and
    margins are stored every ``STEP`` rounds.  Both make the same trees."""
    scenario = fits[0].scenario
    if any(f.scenario != scenario for f in fits):
        raise ValueError("fits of several scenarios")
    counts = part_counts(rows)
    n = sum(c for (s, p, _), c in counts.items() if s == scenario and p != ABSENT)
    if n <= FOREST_ROWS and n * len(fits) <= ROW_FITS:
        return _boost_dealt(rows, fits, points, counts, fills, seed)
    shared, first = _setting(fits, counts, fills)
    held = {"rows": cut_lineage(rows.withColumn("margins", F.lit(first.astype("<f8").tobytes())))}

    def count(state):
        sent = rows.sparkSession.sparkContext.broadcast(state)
        found = _passed(held["rows"], _count_residuals(sent), (1 << state["level"], state["features"], BINS, 4),
                        lambda block, cells: _cut_residuals(sent.value)(block, cells), len(state["fits"]))
        sent.destroy()
        return found

    def store(trees):
        held["rows"] = cut_lineage(_added(held["rows"], trees, scenario, fills))

    def keep(point):
        held["rows"] = held["rows"].withColumn(f"margins_{point}", F.col("margins"))
    importances = _rounds(fits, shared, points, seed, count, store, keep)
    return _held_out(held["rows"], fits, scenario, points), importances


def _boost_one(fit: Boost, weights: np.ndarray, first: float, x: np.ndarray, y: np.ndarray, part: np.ndarray, keys: np.ndarray,
               points: list[int], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The rounds of ``_rounds`` for one fit whose rows lie here: scores of the rows
    held out and importances, by point.  Rows move one node down a level, and
    what a node's value needs beside its cut is summed for the cut alone."""
    features, rate = list(fit.features), fit.rate
    train, held = np.flatnonzero((part >= 0) & (part != fit.fold)), np.flatnonzero(part == fit.fold)
    own, own_held, y, keys = np.ascontiguousarray(x[train].T), np.ascontiguousarray(x[held].T), y[train], keys[train]
    margin, margin_held, w = np.full(len(train), first), np.full(len(held), first), weights[y]
    gains, scores, importances = np.zeros(1 + max(features)), [], []

    def newton(residual, curve):
        return np.divide(residual, curve, out=np.zeros(len(curve)), where=curve > 1e-150)

    def fallen(columns, node, cut):
        """Nodes of the next level; -1: none."""
        feature, place, child = cut
        to = np.full(len(node), -1, np.int64)
        for n in np.flatnonzero(feature >= 0):
            at = np.flatnonzero(node == n)
            to[at] = child[n] + (columns[feature[n], at] > place[n])
        return to
    for number in range(fit.rounds):
        p = 1 / (1 + np.exp(-margin))
        residual, curve = w * (y - p), w * p * (1 - p)
        drawn = np.ones(len(train), bool)
        if fit.share < 1:
            drawn = _uniform(keys, np.array([seed * 1_000_003 + number], np.uint64))[:, 0] < fit.share
        row = np.flatnonzero(drawn)
        value = rate * newton(np.array([residual[row].sum()]), np.array([curve[row].sum()]))
        add, add_held = np.full(len(train), value[0]), np.full(len(held), value[0])
        node, node_held, grows = np.zeros(len(train), np.int64), np.zeros(len(held), np.int64), np.ones(1, bool)
        for level in range(fit.depth):
            if not len(row) or not grows.any():
                break
            nodes, label, r = len(grows), y[row], residual[row]
            at = node[row]
            n, s = np.empty((nodes, len(features), BINS, 2)), np.empty((nodes, len(features), BINS))
            first_place = at * BINS
            for j, f in enumerate(features):
                place = first_place + own[f, row]
                n[:, j] = np.bincount(place * 2 + label, minlength=nodes * BINS * 2).reshape(nodes, BINS, 2)
                s[:, j] = np.bincount(place, r, nodes * BINS).reshape(nodes, BINS)
            low = [n.sum(3).cumsum(2), (n @ weights).cumsum(2), s.cumsum(2)]
            total = [v[:, :1, -1:] for v in low]
            found = _as_arrays([_best(np.arange(nodes), _apart(low, total), low, np.stack([t[:, 0, 0] for t in total], 1),
                                      np.broadcast_to(np.array(features), (nodes, len(features))))], 3)
            on = np.flatnonzero((found["feature"] >= 0) & grows)
            if not len(on):
                break
            np.add.at(gains, found["feature"][on], found["gain"][on])
            feature, child = np.full(nodes, -1, np.int64), np.zeros(nodes, np.int64)
            feature[on], child[on] = found["feature"][on], 2 * np.arange(len(on))
            cut = feature, found["bin"], child
            sums = np.stack([found["low"][on], found["total"][on] - found["low"][on]], 1).reshape(-1, 3)
            node, node_held = fallen(own, node, cut), fallen(own_held, node_held, cut)
            row = row[node[row] >= 0]
            value = rate * newton(sums[:, 2], np.bincount(node[row], curve[row], len(sums)))
            add, add_held = np.where(node >= 0, value[node], add), np.where(node_held >= 0, value[node_held], add_held)
            grows = sums[:, 0] > 1.5
        margin, margin_held = margin + add, margin_held + add_held
        if number + 1 in points:
            scores.append(1 / (1 + np.exp(-margin_held)))
            importances.append(gains / gains.sum() if gains.sum() > 0 else np.zeros_like(gains))
    return np.stack(scores, 1), np.array(importances)


def _boost_dealt(rows: DataFrame, fits: list[Boost], points: list[int], counts: dict, fills: np.ndarray | None,
                 seed: int) -> tuple[DataFrame, np.ndarray]:
    """The same rounds, for at most ``ROW_FITS`` rows x fits: every task has
    all rows and some of the fits, which grow one after another."""
    spark, scenario = rows.sparkSession, fits[0].scenario
    table = rows.where(F.col("parts")[scenario] != ABSENT).orderBy("row_key").toArrow()  # at most ROW_FITS / fits rows
    sent = spark.sparkContext.broadcast(table)
    features = 1 + max(max(f.features) for f in fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            for i in batch.column("fit").to_pylist():
                all_rows = sent.value.combine_chunks().to_batches()
                if not all_rows:
                    return
                f = fits[i]
                table = table or _matrix(all_rows[0], fills)
                bins, labels, parts = table
                y, part = labels[:, scenario], parts[:, scenario]
                shared, first = _setting([f], counts, fills)
                scores, gains = _boost_one(f, shared["weights"], first[0], bins(scenario), y, part,
                                           all_rows[0].column("row_key").to_numpy(), points, seed)
                r = np.flatnonzero(part == f.fold)
                yield _scored(i, all_rows[0].column("id").take(pa.array(r)), y[r], scores, None)
                ids = pa.nulls(len(points), all_rows[0].schema.field("id").type)
                yield _scored(i, ids, np.arange(len(points)), np.zeros((len(points), 0)),
                              np.pad(gains, ((0, 0), (0, features - gains.shape[1]))))

    kind = rows.schema["id"].dataType.simpleString()
    tasks = min(len(fits), spark.sparkContext.defaultParallelism)
    # fits of one depth beside each other keep the tasks even
    order = sorted(range(len(fits)), key=lambda i: (fits[i].depth, i))
    dealt = spark.createDataFrame([(i, k % tasks) for k, i in enumerate(order)], "fit int, task int")
    out = cut_lineage(dealt.repartitionByRange(tasks, "task").select("fit").mapInArrow(
        run, f"fit int, id {kind}, label int, scores array<double>, gains array<double>"))
    importances = np.zeros((len(points), len(fits), features))
    for r in out.where("gains IS NOT NULL").select("fit", "label", "gains").collect():  # fits x points rows
        importances[r.label, r.fit] = r.gains
    sent.destroy()
    return out.where("gains IS NULL").drop("gains"), importances


def _scored(fit: int, ids: pa.Array, labels: np.ndarray, scores: np.ndarray, gains: np.ndarray | None) -> pa.RecordBatch:
    kind = pa.list_(pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(ids), fit), pa.int32()), ids, pa.array(labels, pa.int32()), _lists(scores),
         pa.nulls(len(ids), kind) if gains is None else _lists(gains)], ["fit", "id", "label", "scores", "gains"])


def _added(rows: DataFrame, trees: list[dict], scenario: int, fills) -> DataFrame:
    """Rows with the margins of further rounds."""
    state = rows.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, _, _ = _matrix(batch, fills)
            margin = np.frombuffer(b"".join(batch.column("margins").to_pylist()), "<f8").reshape(batch.num_rows, -1)
            margin = np.ascontiguousarray(_margins(state.value, bins(scenario), margin))
            at = batch.schema.get_field_index("margins")
            yield batch.set_column(at, "margins", pa.array([m.tobytes() for m in margin], pa.binary()))
    return rows.mapInArrow(run, rows.schema)


def _held_out(rows: DataFrame, fits: list[Boost], scenario: int, points: list[int]) -> DataFrame:
    """(fit, id, label, scores) of the rows that each fit holds out."""
    folds = np.array([f.fold for f in fits])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            _, labels, parts = _matrix(batch, None, whole=False)
            r, f = np.nonzero(parts[:, scenario][:, None] == folds[None, :])
            scores = []
            for k in points:
                raw = b"".join(batch.column(f"margins_{k}").to_pylist())
                scores.append(1 / (1 + np.exp(-np.frombuffer(raw, "<f8").reshape(batch.num_rows, -1)[r, f])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(f, pa.int32()), batch.column("id").take(pa.array(r)), pa.array(labels[r, scenario], pa.int32()),
                 _lists(np.stack(scores, 1))], ["fit", "id", "label", "scores"])
    kind = rows.schema["id"].dataType.simpleString()
    return cut_lineage(rows.mapInArrow(run, f"fit int, id {kind}, label int, scores array<double>"))


# ------------------------------------------------------------------ scores
def auc_by_point(scored: DataFrame) -> dict[tuple[int, int], float]:
    """Exact AUC (average ranks) of each (fit, point); fits x points numbers."""
    d = scored.select("fit", F.col("label").cast("double").alias("y"), F.posexplode("scores").alias("point", "s"))
    pos = positions(d, ["fit", "point"], "s", sums=["y"])
    found = pos.groupBy("fit", "point").agg(
        F.sum(F.col("_s_y") * (F.col("_cum") - (F.col("_c") - 1) / 2.0)).alias("ranks"), F.sum("_s_y").alias("ones"),
        F.max("_n").alias("n")).collect()
    out = {}
    for r in found:
        zeros = r["n"] - r["ones"]
        both = r["ones"] * zeros
        out[r["fit"], r["point"]] = (r["ranks"] - r["ones"] * (r["ones"] + 1) / 2) / both if both else float("nan")
    return out
