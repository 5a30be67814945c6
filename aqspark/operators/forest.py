"""Random forests of fully grown trees.

A level of a tree costs a pass over the rows, and a fully grown tree has almost as many nodes as rows, so statistics of all nodes of a level
can't be shuffled. Levels are therefore grown by shared passes only while a node has more than ``task_rows`` rows: tasks add up counts and sums per node, feature
and bin, and one row per node comes to the driver. The rows of each smaller node then meet in one task, which grows its whole subtree.

Rows that fall into the same bins are added up before a tree is grown: no cut can separate them. Nodes of few such cells are split from sorted cells, the others from sums per bin.

Each tree sees a row as often as a Poisson variate of mean 1 says, whose seed is that of the forest, the tree and the row's place in a written table of bins, so a task
that runs again sees the same. A feature has at most ``BINS`` candidate cuts: all its values, if they are few, else quantiles. A split lowers the variance and leaves ``least`` rows on
each side; equal splits go to the first feature and cut. Depth counts from the root of the tree.

The fitted trees are a written table of one row per tree, which never comes to the driver as a whole: rows are scored by a model of few nodes in place, by a larger one
in tasks that each hold some trees and some rows. No rows, a null or NaN label and null features are errors.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from threading import Lock
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, functions as F

from aqspark.sources.staging import stage

#: Candidate cuts of a feature.
BINS = 32
#: Rows of a node whose subtree is grown in one task (some 300 MB of it), and sums that a task holds in a shared pass.
TASK_ROWS, CELLS = 1 << 18, 1 << 21
#: Nodes that a task or the driver unpacks at a time (22 bytes each), and rows that a task scores by them.
NODES_AT_ONCE, ROWS_AT_ONCE = 1 << 21, 1 << 18
#: Nodes of fewer cells are split from sorted cells.
_FEW_CELLS = 32
_QUANTILE_ERROR = 0.001
_LEAST_GAIN = 1e-12
#: Sums that differ by less, relatively, are equal: their last digits depend on the order of rows.
_TIE = 1e-10


# ---- bins -----------------------------------------------------------------------------------------


def _matrix(v: pa.Array, k: int) -> np.ndarray:
    return v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), k)


def candidate_cuts(rows: DataFrame, k: int) -> list[np.ndarray]:
    """Ascending cuts of each feature: rows with a value up to the cut go left."""

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = [np.zeros(0)] * k
        for batch in batches:
            x = _matrix(batch.column("v"), k)
            seen = [s if len(s) > BINS + 1 else np.unique(np.concatenate((s, x[:, f])))[: BINS + 2] for f, s in enumerate(seen)]
        at = np.repeat(np.arange(k, dtype=np.int32), [len(s) for s in seen])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.concatenate(seen))], names=["feature", "value"])

    values = rows.select("v").mapInArrow(few, "feature int, value double").distinct()
    small = values.groupBy("feature").agg(F.sort_array(F.collect_set("value")).alias("values")).where(F.size("values") <= BINS + 1)  # tasks times BINS at most
    cuts = {r["feature"]: np.array(r["values"][:-1]) for r in small.collect()}
    wide = [f for f in range(k) if f not in cuts]
    if wide:
        columns = rows.select(*[F.col("v")[f].alias(f"f{f}") for f in wide])
        found = columns.approxQuantile(columns.columns, [i / BINS for i in range(BINS + 1)], _QUANTILE_ERROR)
        for f, q in zip(wide, found):
            cuts[f] = np.unique([x for x in q[:-1] if x < q[-1]])
    return [cuts[f] for f in range(k)]


def binned(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """Rows in chunks: ``chunk`` (a number of its own), ``n``, ``bins`` (a byte per row and feature, by feature) and ``labels``, both compressed."""
    k = len(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = _matrix(batch.column("v"), k), batch.column("y").to_numpy(zero_copy_only=False).astype(float)
                if np.isnan(y).any():
                    raise ValueError("a label is unknown")
                bins = np.column_stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)]).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32()), pa.array([_packed(bins.T)], pa.binary()), pa.array([_packed(y)], pa.binary())], names=["n", "bins", "labels"])

    return rows.mapInArrow(run, "n int, bins binary, labels binary").select(F.monotonically_increasing_id().alias("chunk"), "n", "bins", "labels")


def _packed(a: np.ndarray) -> bytes:
    return zlib.compress(a.tobytes(), 1)


def _unpacked(blob: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob), dtype=kind)


@dataclass
class Bins:
    """The written chunks of a table, its cuts, rows and mean label."""

    chunks: DataFrame
    cuts: list[np.ndarray]
    n: int
    mean: float

    @property
    def sizes(self) -> list[int]:
        return [len(c) + 1 for c in self.cuts]


_made: WeakKeyDictionary[DataFrame, tuple[Lock, dict]] = WeakKeyDictionary()
_making = Lock()


def bins_of(df: DataFrame, features: str, label: str) -> Bins:
    """Made once for all fits of one frame."""
    with _making:
        lock, made = _made.setdefault(df, (Lock(), {}))
    with lock:
        if (features, label) not in made:
            rows = df.select(vector_to_array(features).alias("v"), F.col(label).cast("double").alias("y"))
            first = rows.select(F.size("v")).first()
            if first is None:
                raise ValueError("no rows to fit")
            cuts = candidate_cuts(rows, first[0])
            chunks = stage(binned(rows, cuts), "bins")
            made[features, label] = Bins(chunks, cuts, *df.agg(F.count("*"), F.avg(label)).first())
        return made[features, label]


def in_tasks(chunks: DataFrame, jobs: list[int], run: Callable[[int, list[dict]], Iterator[pa.Table]], schema: str) -> DataFrame:
    """``run(i, rows)`` in a task for each job i, with the chunks of its part (``jobs[i]``) in order. Earlier jobs start first."""
    of_part = F.create_map(*[x for p in sorted(set(jobs)) for x in (F.lit(p), F.array(*[F.lit(i) for i, own in enumerate(jobs) if own == p]))])
    dealt = chunks.withColumn("job", F.explode(of_part[F.col("part")])).repartitionById(len(jobs), F.col("job"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                found.setdefault(row.pop("job"), []).append(row)
        for job in sorted(found):
            for table in run(job, sorted(found.pop(job), key=lambda r: r["chunk"])):
                yield from table.to_batches()

    return dealt.mapInArrow(each, schema)


def shared_out(work: list[tuple[int, float, object]], parts: Sequence[int], cores: int) -> list[tuple[int, list]]:
    """Tasks of (part, cost, item): items of a part go to the task of that part that has least to do, some two tasks a core; the longest tasks come first."""
    each = -(-2 * cores // len(parts))
    tasks: dict[tuple[int, int], list] = {}
    load = {(part, i): 0.0 for part in parts for i in range(each)}
    for part, cost, item in sorted(work, key=lambda x: -x[1]):
        to = min(((part, i) for i in range(each)), key=load.__getitem__)
        load[to] += cost
        tasks.setdefault(to, []).append(item)
    return [(to[0], tasks[to]) for to in sorted(tasks, key=lambda to: -load[to])]


def _rows_of(chunks: list[dict], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins and labels of all rows."""
    if not chunks:
        return np.zeros((0, k), dtype=np.uint8), np.zeros(0)
    return np.concatenate([_unpacked(r["bins"], np.uint8).reshape(k, -1).T for r in chunks]), np.concatenate([_unpacked(r["labels"], np.float64) for r in chunks])


def cells_of(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each row, and the bins of each cell: rows of equal bins share one."""
    if not bins.size:
        return np.zeros(len(bins), dtype=np.int64), bins[:1]
    whole = np.ascontiguousarray(bins)
    if bins.shape[1] <= 8:
        key = np.zeros((len(bins), 8), dtype=np.uint8)
        key[:, : bins.shape[1]] = whole
        key = key.view(np.uint64).ravel()
    else:
        key = whole.view(np.dtype((np.void, bins.shape[1]))).ravel()
    _, first, cell = np.unique(key, return_index=True, return_inverse=True)
    return cell.astype(np.int64), whole[first]


def _chunks(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for chunk, bins, labels in zip(*(batch.column(c).to_pylist() for c in ("chunk", "bins", "labels"))):
            yield chunk, _unpacked(bins, np.uint8).reshape(k, -1).T, _unpacked(labels, np.float64)


def _weights(seed: int, tree: int, chunk: int, n: int) -> np.ndarray:
    return np.random.default_rng([seed, tree, chunk]).poisson(1.0, n).astype(np.uint8)


# ---- splits ---------------------------------------------------------------------------------------


def _best(count: np.ndarray, total: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Per node (row) the cut after which sums of squared means are largest, and that sum (-inf without a valid cut)."""
    if count.shape[1] < 2:
        return np.zeros(len(count), dtype=np.int64), np.full(len(count), -np.inf)
    left, left_sum = np.cumsum(count, axis=1), np.cumsum(total, axis=1)
    right, right_sum = left[:, -1:] - left[:, :-1], left_sum[:, -1:] - left_sum[:, :-1]
    left, left_sum = left[:, :-1], left_sum[:, :-1]
    ok = (left >= least) & (right >= least)
    score = np.where(ok, left_sum**2 / np.where(ok, left, 1.0) + right_sum**2 / np.where(ok, right, 1.0), -np.inf)
    most = score.max(axis=1)
    return (score >= (most - _TIE * np.abs(most))[:, None]).argmax(axis=1), most


def _allowed(rng: np.random.Generator, nodes: int, k: int, subset: int) -> np.ndarray:
    """Which features each node may split by."""
    if subset >= k:
        return np.ones((nodes, k), dtype=bool)
    order = rng.random((nodes, k)).argsort(axis=1)
    return order.argsort(axis=1) < subset


def _best_sorted(columns: np.ndarray, w: np.ndarray, s: np.ndarray, slot: np.ndarray, nodes: int, size: int, least: int, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like :func:`_best`, from cells in the order of their nodes; sums ``s`` are 0 in each node, and ``parent`` is the node's own squared sum over its weight."""
    cut, most = np.zeros(nodes, dtype=np.int64), np.full(nodes, -np.inf)
    step = 65536 // size
    edges = np.searchsorted(slot, np.arange(0, nodes + step, step))
    for begin, (i, j) in enumerate(zip(edges[:-1], edges[1:])):
        if i == j:
            continue
        own = slot[i:j]
        key = ((own - begin * step) * size + columns[i:j]).astype(np.uint16)
        order = key.argsort(kind="stable")  # by radix
        key = key[order]
        left, left_sum = np.cumsum(w[i:j][order]), np.cumsum(s[i:j][order])
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        end = np.append(first[1:], len(own)) - 1
        at = own[first]
        before, total = np.zeros(nodes), np.zeros(nodes)
        before_sum = np.zeros(nodes)
        before[at[1:]], before_sum[at[1:]] = left[end[:-1]], left_sum[end[:-1]]
        total[at] = left[end]
        last = np.flatnonzero(key[1:] != key[:-1])
        node = own[last]
        a = left[last] - before[node]
        b = total[node] - before[node] - a
        ok = (a >= least) & (b >= least)
        last, node, a, b = last[ok], node[ok], a[ok], b[ok]
        if not len(last):
            continue
        score = (left_sum[last] - before_sum[node]) ** 2 * (1 / a + 1 / b) + parent[node]
        begins = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
        best = np.maximum.reduceat(score, begins)
        most[node[begins]] = best
        hit = np.flatnonzero(score >= (most - _TIE * np.abs(most))[node])
        hit = hit[np.concatenate(([True], node[hit][1:] != node[hit][:-1]))]
        cut[node[hit]] = key[last[hit]] % size
    return cut, most


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, sizes: list[int], depth: int, least: int, subset: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """Feature (-1 at leaves), cut, left child (the right one is next to it) and value of each node of a tree over these rows, level by level."""
    cell, own = cells_of(bins)
    return grow_cells(np.ascontiguousarray(own.T), cell, y, w, sizes, depth, least, subset, rng)


def grow_cells(columns: np.ndarray, cell: np.ndarray, y: np.ndarray, w: np.ndarray, sizes: list[int], depth: int, least: int, subset: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """The same from the cells of the rows; ``columns`` has the bins of each cell by feature."""
    k, mean = len(sizes), np.average(y, weights=w)
    w, y = w.astype(float), y - mean
    wy = w * y
    w, s, q = (np.bincount(cell, x, columns.shape[1]) for x in (w, wy, wy * y))
    seen = np.flatnonzero(w)
    columns, w, s, q = columns[:, seen], w[seen], s[seen], q[seen]
    slot, start, next_id = np.zeros(len(w), dtype=np.int64), np.zeros(1, dtype=np.int64), 1
    levels: list[tuple[np.ndarray, ...]] = []
    nodes = 1
    while nodes:
        # the cells are in the order of their nodes
        count, total, held = np.add.reduceat(w, start), np.add.reduceat(s, start), np.diff(np.append(start, len(w)))
        parent = total**2 / count
        spread = np.add.reduceat(q, start) - parent
        feature, cut, best = np.full(nodes, -1, dtype=np.int16), np.zeros(nodes, dtype=np.int64), np.full(nodes, -np.inf)
        if len(levels) < depth:
            may = _allowed(rng, nodes, k, subset)
            open_ = (held > 1) & (count >= 2 * least) & (spread > _LEAST_GAIN * count)
            for large in (True, False):
                part = np.flatnonzero(open_ & ((held >= _FEW_CELLS) == large))
                if not len(part):
                    continue
                place = np.full(nodes, -1, dtype=np.int64)
                place[part] = np.arange(len(part))
                row = np.flatnonzero(place[slot] >= 0)
                own, pw, ps = place[slot[row]], w[row], s[row]
                if not large:
                    ps = ps - pw * (total / count)[part][own]
                for f in range(k):
                    x, size = columns[f].take(row), sizes[f]
                    if size < 2 or not may[part, f].any():
                        continue
                    if large:
                        key = own * size + x
                        c, score = _best(np.bincount(key, pw, len(part) * size).reshape(len(part), -1), np.bincount(key, ps, len(part) * size).reshape(len(part), -1), least)
                    else:
                        some = np.flatnonzero(may[part, f][own]) if subset < k else slice(None)
                        c, score = _best_sorted(x[some], pw[some], ps[some], own[some], len(part), size, least, parent[part])
                    better = may[part, f] & (score - _TIE * np.abs(score) > best[part])
                    to = part[better]
                    feature[to], cut[to], best[to] = f, c[better], score[better]
            gain = best - parent
            feature[~((gain > _LEAST_GAIN * np.maximum(spread, 1e-300)) & (spread > _LEAST_GAIN * count))] = -1
        inner = feature >= 0
        rank = np.cumsum(inner) - 1
        left = np.where(inner, next_id + 2 * rank, -1).astype(np.int32)
        levels.append((feature, np.where(inner, cut, 0).astype(np.uint8), left, total / count + mean))
        keep = np.flatnonzero(inner[slot])
        slot = slot[keep]
        right = columns[feature[slot], keep] > cut[slot]
        slot = 2 * rank[slot] + right
        nodes = 2 * int(inner.sum())
        next_id += nodes
        if nodes:
            # stable, by counting: lefts and rights of a node stay in their order
            sizes_of = np.bincount(slot, minlength=nodes)
            start = np.cumsum(sizes_of) - sizes_of
            lefts = np.cumsum(~right)
            seen_before = np.append(0, lefts)[start[0::2]]
            nth_left = lefts - 1 - seen_before[slot >> 1]
            to = np.where(right, start[slot] + (np.arange(len(slot)) - start[slot & ~1]) - nth_left - 1, start[slot] + nth_left)
            order = np.empty(len(slot), dtype=np.int64)
            order[to] = keep
            sorted_slot = np.repeat(np.arange(nodes), sizes_of)
            columns, w, s, q, slot = columns.take(order, axis=1), w[order], s[order], q[order], sorted_slot
    return tuple(np.concatenate(x) for x in zip(*levels))


def _thresholds(feature: np.ndarray, cut: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(cut))
    for f, c in enumerate(cuts):
        own = feature == f
        out[own] = c[cut[own]]
    return out


def predicted_at(tree: tuple[np.ndarray, ...], columns: np.ndarray, depths: list[int]) -> list[np.ndarray]:
    """What the tree says of each cell if it is cut off at each depth (ascending)."""
    feature, cut, left, value = tree
    at, out, level = np.zeros(columns.shape[1], dtype=np.int64), [], 0
    row = np.flatnonzero(left[at] >= 0)
    for depth in depths:
        while len(row) and level < depth:
            own = at[row]
            own = left[own] + (columns[feature[own], row] > cut[own])
            at[row], level = own, level + 1
            row = row[left[own] >= 0]
        out.append(value[at])
    return out


# ---- upper levels by shared passes -------------------------------------------------------------------


@dataclass
class Top:
    """The upper nodes of a tree. A node without children is grown in a task, unless it is closed."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    rows: list[float] = field(default_factory=lambda: [0.0])
    depth: list[int] = field(default_factory=lambda: [0])
    closed: list[bool] = field(default_factory=lambda: [False])

    def split(self, node: int, feature: int, cut: int, rows: tuple[float, float]) -> None:
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.left)
        for n in rows:
            for column, x in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.value, 0.0), (self.rows, n), (self.depth, self.depth[node] + 1), (self.closed, False)):
                column.append(x)

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The upper node of each row that has no children."""
        at, feature, cut, left = np.zeros(len(bins), dtype=np.int64), np.array(self.feature), np.array(self.cut), np.array(self.left)
        row = np.flatnonzero(left[at] >= 0)
        while len(row):
            own = at[row]
            at[row] = left[own] + (bins[row, feature[own]] > cut[own])
            row = row[left[at[row]] >= 0]
        return at


def _node_splits(chunks: DataFrame, tops: list[Top], wanted: list[tuple[int, int]], sizes: list[int], least: int, subset: int, seed: int) -> list:
    """For each (tree, node) its mean and the best split with the rows on both sides, from sums of all its rows."""
    k, width = len(sizes), max(sizes)
    shared = chunks.sparkSession.sparkContext.broadcast(tops)
    slots: dict[int, dict[int, int]] = {}
    for i, (t, node) in enumerate(wanted):
        slots.setdefault(t, {})[node] = i

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((len(wanted), k, width)), np.zeros((len(wanted), k, width))
        for chunk, bins, y in _chunks(batches, k):
            for t, own in slots.items():
                w = _weights(seed, t, chunk, len(y))
                slot_of = np.full(len(shared.value[t].left), -1, dtype=np.int64)
                slot_of[list(own)] = list(own.values())
                slot = slot_of[shared.value[t].place(bins)]
                hit = np.flatnonzero((slot >= 0) & (w > 0))
                for f in range(k):
                    key = slot[hit], f, bins[hit, f]
                    np.add.at(count, key, w[hit])
                    np.add.at(total, key, w[hit] * y[hit])
        at = np.flatnonzero(count)
        cells = [pa.array((at // (k * width)).astype(np.int32)), pa.array((at % (k * width)).astype(np.int32)), pa.array(count.ravel()[at]), pa.array(total.ravel()[at])]
        yield pa.RecordBatch.from_arrays(cells, names=["slot", "cell", "n", "s"])

    def split(group: pa.Table) -> pa.Table:
        count, total = np.zeros(k * width), np.zeros(k * width)
        cell, i = group.column("cell").to_numpy(), group.column("slot")[0].as_py()
        count[cell], total[cell] = group.column("n").to_numpy(), group.column("s").to_numpy()
        count, total = count.reshape(k, width), total.reshape(k, width)
        n, mean = count[0].sum(), total[0].sum() / count[0].sum()
        cut, score = _best(count, total - mean * count, least)
        score[~_allowed(np.random.default_rng([seed, *wanted[i]]), 1, k, subset)[0]] = -np.inf
        f = int((score >= score.max() - _TIE * abs(score.max())).argmax())
        left = count[f, : cut[f] + 1].sum() if score[f] > 0 else 0.0
        return pa.table({"slot": pa.array([i], pa.int32()), "mean": [float(mean)], "feature": pa.array([f], pa.int32()), "cut": pa.array([int(cut[f])], pa.int32()), "n_left": [float(left)], "n_right": [float(n - left)]})

    cells = chunks.mapInArrow(sums, "slot int, cell int, n double, s double").groupBy("slot", "cell").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    return cells.groupBy("slot").applyInArrow(split, "slot int, mean double, feature int, cut int, n_left double, n_right double").collect()


def upper_levels(chunks: DataFrame, n: int, trees: int, sizes: list[int], depth: int, least: int, subset: int, seed: int, task_rows: int) -> list[Top]:
    tops = [Top(rows=[float(n)]) for _ in range(trees)]
    while True:
        large = [(t, i) for t, top in enumerate(tops) for i, left in enumerate(top.left) if left < 0 and not top.closed[i] and top.rows[i] > task_rows and top.depth[i] < depth]
        if not large:
            return tops
        step = max(1, CELLS // (len(sizes) * max(sizes)))
        for part in (large[i : i + step] for i in range(0, len(large), step)):
            found = {r["slot"]: r for r in _node_splits(chunks, tops, part, sizes, least, subset, seed)}
            for i, (t, node) in enumerate(part):
                r = found[i]
                if r["n_left"] > 0:
                    tops[t].split(node, r["feature"], r["cut"], (r["n_left"], r["n_right"]))
                else:
                    tops[t].closed[node], tops[t].value[node] = True, r["mean"]


# ---- subtrees in tasks ------------------------------------------------------------------------------


def subtrees(chunks: DataFrame, tops: list[Top], cuts: list[np.ndarray], depth: int, least: int, subset: int, seed: int) -> DataFrame:
    """``tree``, ``node`` (of the upper levels) and the arrays of the subtree that begins there."""
    k, sizes = len(cuts), [len(c) + 1 for c in cuts]
    shared = chunks.sparkSession.sparkContext.broadcast(tops)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, bins, y in _chunks(batches, k):
            for t, top in enumerate(shared.value):
                w = _weights(seed, t, chunk, len(y))
                at, hit = top.place(bins), np.flatnonzero(w)
                hit = hit[np.argsort(at[hit], kind="stable")]
                nodes, begin = np.unique(at[hit], return_index=True)
                found = [(i, own) for i, own in zip(nodes.tolist(), np.split(hit, begin[1:])) if not top.closed[i]]
                if found:
                    blobs = [[a[own].tobytes() for _, own in found] for a in (bins, y, w)]
                    columns = [pa.array([t] * len(found), pa.int32()), pa.array([i for i, _ in found], pa.int32()), pa.array([chunk] * len(found), pa.int64()), *(pa.array(b, pa.binary()) for b in blobs)]
                    yield pa.RecordBatch.from_arrays(columns, names=["tree", "node", "chunk", "bins", "labels", "weights"])

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("chunk")  # sums of doubles depend on the order
        t, node = group.column("tree")[0].as_py(), group.column("node")[0].as_py()
        whole = {c: np.concatenate([np.frombuffer(x, dtype=d) for x in group.column(c).to_pylist()]) for c, d in (("bins", np.uint8), ("labels", np.float64), ("weights", np.uint8))}
        rng = np.random.default_rng([seed, t, node])
        feature, cut, left, value = grow(whole["bins"].reshape(-1, k), whole["labels"], whole["weights"], sizes, depth - shared.value[t].depth[node], least, subset, rng)
        arrays = {"feature": feature, "threshold": _thresholds(feature, cut, cuts), "left": left, "value": value}
        return pa.table({"tree": pa.array([t], pa.int32()), "node": pa.array([node], pa.int32()), **{name: pa.array([a.tobytes()], pa.binary()) for name, a in arrays.items()}})

    dealt = chunks.mapInArrow(deal, "tree int, node int, chunk long, bins binary, labels binary, weights binary")
    groups = sum(left < 0 for top in tops for left in top.left)
    spread = dealt.repartition(2 * groups, "tree", "node")  # a task for each subtree, not as many as the session shuffles into
    return spread.groupBy("tree", "node").applyInArrow(run, "tree int, node int, feature binary, threshold binary, left binary, value binary")


_KINDS = {"feature": np.int16, "threshold": np.float64, "left": np.int32, "value": np.float64}
TREES = "tree int, nodes int, " + ", ".join(f"{name} binary" for name in _KINDS)
Tree = dict[str, np.ndarray]


def tree_rows(trees: list[tuple[int, Tree]]) -> pa.Table:
    """Rows of a table of trees: compressed arrays. Leaves have values; inner nodes have thresholds, and left children as the distance from the one before."""
    found: dict[str, list[bytes]] = {name: [] for name in _KINDS}
    for _, tree in trees:
        inner = tree["feature"] >= 0
        stored = {"feature": tree["feature"], "threshold": tree["threshold"][inner], "left": np.diff(tree["left"][inner], prepend=0), "value": tree["value"][~inner]}
        for name, kind in _KINDS.items():
            found[name].append(_packed(stored[name].astype(kind)))
    return pa.table({"tree": pa.array([t for t, _ in trees], pa.int32()), "nodes": pa.array([len(tree["left"]) for _, tree in trees], pa.int32()), **{name: pa.array(blobs, pa.binary()) for name, blobs in found.items()}})


def _tree_of(row: dict) -> Tree:
    stored = {name: _unpacked(row[name], kind) for name, kind in _KINDS.items()}
    inner, n = stored["feature"] >= 0, len(stored["feature"])
    tree = {"feature": stored["feature"], "threshold": np.zeros(n), "left": np.full(n, -1, dtype=np.int32), "value": np.zeros(n)}
    tree["threshold"][inner], tree["left"][inner], tree["value"][~inner] = stored["threshold"], np.cumsum(stored["left"], dtype=np.int32), stored["value"]
    return tree


def _plain_tree(row: dict) -> Tree:
    return {name: np.frombuffer(row[name], dtype=kind) for name, kind in _KINDS.items()}


def _whole(top: Top, cuts: list[np.ndarray], parts: dict[int, Tree], mean: float) -> Tree:
    """The upper nodes first, then the other nodes of each subtree; its first one takes the place of the upper node."""
    threshold = [cuts[f][c] if f >= 0 else 0.0 for f, c in zip(top.feature, top.cut)]
    value = [v if closed or left >= 0 else mean for v, closed, left in zip(top.value, top.closed, top.left)]
    out = [[np.array(x, dtype=d)] for x, d in zip((top.feature, threshold, top.left, value), _KINDS.values())]
    offset = len(top.left)
    for node, part in sorted(parts.items()):
        left = np.where(part["left"] >= 0, part["left"] + offset - 1, -1)
        for column, own in zip(out, (part["feature"], part["threshold"], left, part["value"])):
            column[0][node] = own[0]
            column.append(own[1:])
        offset += len(left) - 1
    return {name: np.concatenate(column).astype(d) for (name, d), column in zip(_KINDS.items(), out)}


def _joined(parts: DataFrame, tops: list[Top], cuts: list[np.ndarray], mean: float) -> DataFrame:
    """Whole trees of subtrees; one tree is put together in a task."""
    spark = parts.sparkSession
    shared = spark.sparkContext.broadcast(tops)

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        t = rows[0]["tree"]
        return tree_rows([(t, _whole(shared.value[t], cuts, {r["node"]: _plain_tree(r) for r in rows if r["node"] is not None}, mean))])

    every = spark.range(len(tops)).select(F.col("id").cast("int").alias("tree"))  # a tree may have no subtree
    return every.join(parts, "tree", "left").groupBy("tree").applyInArrow(run, TREES)


def _trees_in_tasks(bins: Bins, trees: int, depth: int, least: int, subset: int, seed: int) -> DataFrame:
    """Trees of a table whose rows fit into a task; a task grows some of them."""
    tasks = min(trees, 2 * bins.chunks.sparkSession.sparkContext.defaultParallelism)
    sizes, cuts, k = bins.sizes, bins.cuts, len(bins.cuts)

    def run(job: int, chunks: list[dict]) -> Iterator[pa.Table]:
        x, y = _rows_of(chunks, k)
        cell, own = cells_of(x)
        columns = np.ascontiguousarray(own.T)
        for t in range(job, trees, tasks):
            feature, cut, left, value = _tree(chunks, cell, columns, y, sizes, depth, least, subset, seed, t)
            yield tree_rows([(t, {"feature": feature, "threshold": _thresholds(feature, cut, cuts), "left": left, "value": value})])

    return in_tasks(bins.chunks.withColumn("part", F.lit(0)), [0] * tasks, run, TREES)


def _tree(chunks: list[dict], cell: np.ndarray, columns: np.ndarray, y: np.ndarray, sizes: list[int], depth: int, least: int, subset: int, seed: int, t: int) -> tuple[np.ndarray, ...]:
    w = np.concatenate([_weights(seed, t, r["chunk"], r["n"]) for r in chunks])
    if not w.any():  # no row was drawn
        return np.array([-1], dtype=np.int16), np.zeros(1, dtype=np.uint8), np.array([-1], dtype=np.int32), np.array([y.mean()])
    return grow_cells(columns, cell, y, w, sizes, depth, least, subset, np.random.default_rng([seed, t, 0]))


def errors(chunks: DataFrame, sizes: dict[int, list[int]], runs: list[dict], seed: int) -> dict[tuple[int, int], dict[tuple[int, int], float | None]]:
    """For each (run, part) the root mean squared error on its held rows of the wanted (trees, depth). A run has ``wanted``, ``least`` and ``strategy``.

    A forest of fewer trees is the first ones of a larger forest, and one of less depth is its upper levels, which have the same seeds: each tree is grown once.
    """
    work = []  # run, first tree and the one after the last, depths
    cores = chunks.sparkSession.sparkContext.defaultParallelism
    step = -(-sum(max(trees for trees, _ in run["wanted"]) for run in runs) // (2 * -(-2 * cores // len(sizes))))
    for i, run in enumerate(runs):
        ends = sorted({trees for trees, _ in run["wanted"]})
        for begin, end in zip([0, *ends], ends):
            depths = sorted({depth for trees, depth in run["wanted"] if trees >= end})
            pieces = -(-(end - begin) // step)
            edges = [begin + (end - begin) * p // pieces for p in range(pieces + 1)]
            work += [(part, (b - a) * min(depths[-1], 30) / (1 + run["least"]) ** 0.5, (i, a, b, depths)) for part in sizes for a, b in zip(edges, edges[1:])]
    jobs = shared_out(work, list(sizes), cores)

    def grown(job: int, rows: list[dict]) -> Iterator[pa.Table]:
        part, items = jobs[job]
        k = len(sizes[part])
        own_rows, held_rows = [r for r in rows if not r["held"]], [r for r in rows if r["held"]]
        x, y = _rows_of(own_rows, k)
        cell, own = cells_of(x)
        held_x, held_y = _rows_of(held_rows, k)
        held_cell, held = cells_of(held_x)
        columns, held = np.ascontiguousarray(own.T), np.ascontiguousarray(held.T)
        for i, begin, end, depths in items:
            sums = [np.zeros(held.shape[1]) for _ in depths]
            for t in range(begin, end):
                tree = _tree(own_rows, cell, columns, y, sizes[part], depths[-1], runs[i]["least"], features_per_split(runs[i]["strategy"], k), seed, t)
                for total, value in zip(sums, predicted_at(tree, held, depths)):
                    total += value
            m = len(depths)
            first = [begin == 0 and j == 0 for j in range(m)]  # one row has the held labels
            kinds = {"run": ([i] * m, pa.int32()), "part": ([part] * m, pa.int32()), "begin": ([begin] * m, pa.int32()), "end": ([end] * m, pa.int32()), "depth": (depths, pa.int32()), "sums": ([s.tobytes() for s in sums], pa.binary())}
            kinds |= {"labels": ([_packed(held_y) if f else None for f in first], pa.binary()), "cells": ([_packed(held_cell) if f else None for f in first], pa.binary())}
            yield pa.table({name: pa.array(values, kind) for name, (values, kind) in kinds.items()})

    def added(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["begin"], r["depth"]))
        i, part, y, cell = rows[0]["run"], rows[0]["part"], _unpacked(rows[0]["labels"], np.float64), _unpacked(rows[0]["cells"], np.int64)
        found, total = [], {}
        for r in rows:
            depth = r["depth"]
            total[depth] = total.get(depth, 0) + np.frombuffer(r["sums"])
            if (r["end"], depth) in runs[i]["wanted"]:
                found.append((r["end"], depth, float(np.sqrt(np.mean((y - total[depth][cell] / r["end"]) ** 2))) if len(y) else None))
        return pa.table({"run": pa.array([i] * len(found), pa.int32()), "part": pa.array([part] * len(found), pa.int32()), "trees": pa.array([f[0] for f in found], pa.int32()), "depth": pa.array([f[1] for f in found], pa.int32()), "rmse": pa.array([f[2] for f in found], pa.float64())})

    parts = in_tasks(chunks, [job[0] for job in jobs], grown, "run int, part int, begin int, end int, depth int, sums binary, labels binary, cells binary")
    out: dict[tuple[int, int], dict[tuple[int, int], float | None]] = {}
    for r in parts.groupBy("run", "part").applyInArrow(added, "run int, part int, trees int, depth int, rmse double").collect():
        out.setdefault((r["run"], r["part"]), {})[r["trees"], r["depth"]] = r["rmse"]
    return out


# ---- the estimator and its model -----------------------------------------------------------------------


def features_per_split(strategy: str, k: int) -> int:
    return {"all": k, "sqrt": int(np.ceil(np.sqrt(k))), "log2": max(1, int(np.ceil(np.log2(k)))), "onethird": int(np.ceil(k / 3))}[strategy]


class ForestRegressor(Estimator):
    def __init__(self, trees: int, depth: int | None, least: int, strategy: str, seed: int, featuresCol: str = "features", labelCol: str = "label", task_rows: int = TASK_ROWS) -> None:
        super().__init__()
        self.trees, self.depth, self.least, self.strategy, self.seed = trees, depth or 1 << 30, least, strategy, seed
        self.features, self.label, self.task_rows = featuresCol, labelCol, task_rows

    def _fit(self, df: DataFrame) -> ForestModel:
        bins = bins_of(df, self.features, self.label)
        subset = features_per_split(self.strategy, len(bins.cuts))
        if bins.n <= self.task_rows:
            trees = _trees_in_tasks(bins, self.trees, self.depth, self.least, subset, self.seed)
        else:
            tops = upper_levels(bins.chunks, bins.n, self.trees, bins.sizes, self.depth, self.least, subset, self.seed, self.task_rows)
            trees = _joined(subtrees(bins.chunks, tops, bins.cuts, self.depth, self.least, subset, self.seed), tops, bins.cuts, bins.mean)
        return ForestModel(StoredTrees(stage(trees, "trees")))._set(featuresCol=self.features)


class StoredTrees(Sequence):
    """Trees of a written table, read when they are asked for; only their sizes are held."""

    def __init__(self, rows: DataFrame) -> None:
        self.rows = rows
        self.sizes = [r[1] for r in rows.select("tree", "nodes").orderBy("tree").collect()]  # as many rows as trees

    def __len__(self) -> int:
        return len(self.sizes)

    def __getitem__(self, tree: int) -> Tree:
        return self.read([range(len(self))[tree]])[0]

    def read(self, trees: list[int]) -> list[Tree]:
        return [_tree_of(r.asDict()) for r in self.rows.where(F.col("tree").isin(trees)).orderBy("tree").collect()]


class ForestModel(Model, HasFeaturesCol, HasPredictionCol, MLWritable, MLReadable):
    """The mean of its trees. Saved as one row per tree, next to its parameters."""

    def __init__(self, trees: StoredTrees | None = None) -> None:
        super().__init__()
        self.trees = trees
        self._shared = None

    @property
    def treeWeights(self) -> list[float]:
        return [1.0] * len(self.trees)

    @property
    def totalNumNodes(self) -> int:
        return sum(self.trees.sizes)

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    def nodes(self, trees: list[int]) -> np.ndarray:
        """(tree, node, value, left, right, feature, threshold) of these trees; children of leaves are -1."""
        found = []
        for t, tree in zip(sorted(trees), self.trees.read(trees)):
            right = np.where(tree["left"] >= 0, tree["left"] + 1, -1)
            found.append(np.column_stack([np.full(len(right), t), np.arange(len(right)), tree["value"], tree["left"], right, tree["feature"], tree["threshold"]]))
        return np.concatenate(found)

    def _shares(self) -> list[float]:
        return [1.0 / len(self.trees)] * len(self.trees)

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.totalNumNodes > NODES_AT_ONCE:
            return self._by_parts(df)
        self._shared = self._shared or df.sparkSession.sparkContext.broadcast((self._shares(), self.trees.read(list(range(len(self.trees))))))
        shared = self._shared

        @F.arrow_udf("double")
        def predicted(v: pa.Array) -> pa.Array:
            x = v.flatten().to_numpy(zero_copy_only=False)
            x = x.reshape(len(v), -1) if len(v) else np.zeros((0, 1))
            return pa.array(sum(share * _walk(tree, x) for share, tree in zip(*shared.value)))

        return df.withColumn(self.getPredictionCol(), predicted(vector_to_array(self.getFeaturesCol())))

    def _by_parts(self, df: DataFrame) -> DataFrame:
        """Rows are written once; each task has some of the trees and some of the rows, and the parts of a row are added up in the order of the trees."""
        shares, columns = self._shares(), df.columns
        rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
        blocks = max(1, -(-rows.count() // ROWS_AT_ONCE))
        cores = df.sparkSession.sparkContext.defaultParallelism
        at_once = max(1, min(4 * NODES_AT_ONCE // max(self.trees.sizes), -(-len(self.trees) // cores)))  # one is unpacked at a time
        groups = -(-len(self.trees) // at_once)
        points = rows.select("_row", vector_to_array(self.getFeaturesCol()).alias("v")).withColumn("block", F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int"))
        points = points.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        trees = self.trees.rows.withColumn("part", F.floor(F.col("tree") / at_once).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

        def run(trees: pa.Table, points: pa.Table) -> pa.Table:
            v = points.column("v").combine_chunks()
            x = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1) if len(v) else np.zeros((0, 1))
            out, own = np.zeros(len(v)), trees.select(["tree"]).column(0).to_pylist()
            for i in np.argsort(own):
                out += shares[own[i]] * _walk(_tree_of(trees.slice(int(i), 1).to_pylist()[0]), x)
            part = trees.column("part")[0].as_py() if own else 0
            return pa.table({"_row": points.column("_row"), "part": pa.array([part] * len(v), pa.int32()), "value": out})

        pairs = trees.repartition(groups * blocks, "part", "block").groupBy("part", "block").cogroup(points.repartition(groups * blocks, "part", "block").groupBy("part", "block"))
        parts = pairs.applyInArrow(run, "_row long, part int, value double").groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("part", "value"))).alias("parts"))
        total = F.aggregate("parts", F.lit(0.0), lambda a, e: a + e["value"]).alias(self.getPredictionCol())
        return rows.join(parts.select("_row", total), "_row").select(*columns, self.getPredictionCol())

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


def _walk(tree: Tree, x: np.ndarray) -> np.ndarray:
    feature, threshold, left = tree["feature"], tree["threshold"], tree["left"]
    at = np.zeros(len(x), dtype=np.int64)
    row = np.flatnonzero(left[at] >= 0)
    while len(row):
        own = at[row]
        own = left[own] + (x[row, feature[own]] > threshold[own])
        at[row] = own
        row = row[left[own] >= 0]
    return tree["value"][at]


class _Writer(MLWriter):
    def __init__(self, model: ForestModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, SparkSession.active())
        self.model.trees.rows.write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def __init__(self, kind: type[ForestModel]) -> None:
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> ForestModel:
        spark = SparkSession.active()
        rows = spark.read.parquet(f"{path}/trees")
        if "nodes" not in rows.columns:  # saved before trees were compressed
            rows = rows.mapInArrow(lambda batches: (b for batch in batches for b in tree_rows([(r["tree"], _plain_tree(r)) for r in batch.to_pylist()]).to_batches()), TREES)
        model = self.kind(StoredTrees(rows))
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
