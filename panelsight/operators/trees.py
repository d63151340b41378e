"""Boosted trees and random forests on shared histograms (the learners of M2 and M3).

Features are binned once by exact quantiles. The rows are then kept as blocks
of bins, labels and row hashes; every level of all trees that grow together is
one Spark job: tasks add up a histogram over (tree, node, feature, bin), the
histograms are added by ranges of nodes, and each range's best splits are
found where it was added. The driver gets a few numbers for each node, and
nothing is shuffled but histograms, one for each task.

* Sums are of integers (gradients in fixed point), and rows are drawn by
  hashes of their keys: the trees depend on the rows, not on their partitions.
* ``boost``: softmax over all classes, second order, rows drawn per round,
  columns per tree. Margins live on the blocks and are updated once a round,
  when the gradients of the drawn rows are taken as well; their lineage is cut
  by a checkpoint in the shared folder.
* ``forest``: Poisson weights by hash instead of drawn rows, Gini impurity,
  columns drawn per node, class weights applied to the sums.

Finished trees become Spark's own model classes (``as_spark_model``), written
in their saved form and loaded: scoring, saving and loading are Spark's.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelsight.operators.ranks import running_total
from panelsight.session import ensure_checkpoint_dir, remove, work_dir

BLOCK = 16_384  # rows of a block as written
RANGE_BYTES = 1 << 20  # of histograms that one task adds up and judges
LARGE = 65_536  # rows of a block as the histograms are taken
ROWS_PER_TASK = 65_536
FIXED_POINT = 30  # bits after the point of a gradient
CHECKPOINT_EVERY = 20  # rounds
HISTOGRAM_BYTES = 16 << 20  # of the trees of a forest that grow together


@dataclass
class Tree:
    """Nodes in level order; children follow their parent. A row goes left if its value is below the threshold."""
    feature: list  # -1: a leaf
    threshold: list
    cut: list  # the first bin that goes right
    left: list
    right: list
    value: list  # of a leaf: score, or class weights
    cover: list  # hessian or weight of the training rows
    rows: list
    gain: list

    @classmethod
    def root(cls) -> "Tree":
        return cls([-1], [0.0], [0], [-1], [-1], [None], [0.0], [0], [0.0])

    def split(self, node: int, feature: int, cut: int, threshold: float, gain: float) -> tuple[int, int]:
        k = len(self.feature)
        self.feature[node], self.cut[node], self.threshold[node], self.gain[node] = feature, cut, threshold, gain
        self.left[node], self.right[node] = k, k + 1
        for x, v in ((self.feature, -1), (self.threshold, 0.0), (self.cut, 0), (self.left, -1), (self.right, -1), (self.value, None), (self.cover, 0.0), (self.rows, 0), (self.gain, 0.0)):
            x += [v, v]
        return k, k + 1

    def arrays(self) -> tuple:
        """Feature, cut and the children of every node, (left, right) in turn; a leaf is its own child. And the levels."""
        own = np.arange(len(self.feature))
        feature, cut = np.array(self.feature), np.array(self.cut)
        leaf = feature < 0
        children = np.stack([np.where(leaf, own, self.left), np.where(leaf, own, self.right)], axis=1).ravel()
        level = np.zeros(len(own), int)
        for i in np.flatnonzero(~leaf):  # children follow their parent
            level[[self.left[i], self.right[i]]] = level[i] + 1
        return np.where(leaf, 0, feature), cut, children, int(level.max())


def route(arrays: tuple, bins: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """The node where each row (of ``rows``, if given) of ``bins`` (features, rows) ends."""
    feature, cut, children, levels = arrays
    at = np.arange(bins.shape[1]) if rows is None else rows
    node = np.zeros(len(at), np.intp)
    flat, start = bins.ravel(), feature * bins.shape[1]
    for _ in range(levels):
        right = flat.take(start.take(node) + at) >= cut.take(node)
        node = children.take(2 * node + right)
    return node


def hashed(keys: np.ndarray, *salt: int) -> np.ndarray:
    """64-bit mixes of row hashes with the salt."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64)
        for s in salt:
            x = x ^ np.uint64((s * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(31))
    return x


def _uniform(keys: np.ndarray, *salt: int) -> np.ndarray:
    return (hashed(keys, *salt) >> np.uint64(11)) * 2.0**-53


def drawn(count: int, of: int, *salt: int) -> list[int]:
    """``count`` of the numbers below ``of``, by hash, ascending."""
    order = np.argsort(hashed(np.arange(of, dtype=np.uint64), *salt), kind="stable")
    return sorted(order[:count].tolist())


_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate([[1.0], np.arange(1.0, 20.0)])))


def poisson(keys: np.ndarray, *salt: int) -> np.ndarray:
    """Poisson(1) counts by hash."""
    return np.searchsorted(_POISSON, _uniform(keys, *salt), side="right").astype(np.float64)


# --- bins and blocks -----------------------------------------------------------------

def bin_edges(train: DataFrame, n_features: int, bins: int) -> list[np.ndarray]:
    """Per feature the ascending first values of bins 1, 2, ...: bins hold about equal shares of the rows.

    Values are counted and ranked over sorted ranges, exactly and without one
    task for a whole column; at most ``bins`` rows a feature reach the driver.
    """
    values = (train.select(F.posexplode(vector_to_array("features")).alias("f", "x")).groupBy("f", "x").agg(F.count(F.lit(1)).alias("n")))
    ranked, path = running_total(values, ["f"], ["x"], "n")
    place = F.floor(F.col("before") * F.lit(bins) / F.col("total")).cast("int")
    edges = ranked.groupBy("f", place.alias("b")).agg(F.min("x").alias("x")).collect()
    remove(train.sparkSession, path)
    out = [sorted(r["x"] for r in edges if r["f"] == f) for f in range(n_features)]
    return [np.array(x[1:], np.float64) for x in out]


def row_keys(train: DataFrame, keys: list[str]) -> F.Column:
    """What tells rows apart for the draws: their keys, or their contents where there are none."""
    have = [c for c in keys if c in train.columns]
    return F.xxhash64(*have) if have else F.xxhash64(vector_to_array("features"), "label")


def blocks(train: DataFrame, edges: list[np.ndarray], key: F.Column):
    """RDD of (bins, labels, row hashes) of up to BLOCK rows each."""
    spark = train.sparkSession
    d = len(edges)

    def pack(batches):
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            bins = np.stack([np.searchsorted(edges[f], x[:, f], side="right") for f in range(d)], axis=1).astype(np.uint8)
            y, k = b.column("y").to_numpy().astype(np.uint8), b.column("k").to_numpy()
            for i in range(0, len(bins), BLOCK):
                s = slice(i, i + BLOCK)
                yield pa.RecordBatch.from_arrays([pa.array([a[s].tobytes()], pa.binary()) for a in (bins, y, k)], ["bins", "y", "k"])

    rows = train.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("y"), key.alias("k"))
    path = work_dir(spark, "tree-blocks")
    rows.mapInArrow(pack, "bins binary, y binary, k binary").write.parquet(path)
    unpack = lambda r: (np.frombuffer(bytes(r[0]), np.uint8).reshape(-1, d), np.frombuffer(bytes(r[1]), np.uint8), np.frombuffer(bytes(r[2]), np.int64))
    return spark.read.parquet(path).rdd.map(unpack), path


def dealt(base, n: int, most: int = LARGE):
    """The ``n`` rows of the blocks as larger ones (features, rows), dealt evenly to a task for each core or ROWS_PER_TASK rows, whichever are fewer."""
    tasks = max(1, min(-(-n // ROWS_PER_TASK), base.context.defaultParallelism))

    def joined(items):
        held, size = [], 0
        for b in items:
            if held and size + len(b[1]) > most:
                yield one(held)
                held, size = [], 0
            held.append(b)
            size += len(b[1])
        if held:
            yield one(held)

    def one(held):
        bins, y, keys = (np.concatenate(x) for x in zip(*held))
        return np.ascontiguousarray(bins.T), y, keys

    if tasks == 1:
        return base.coalesce(1).mapPartitions(joined)
    return base.zipWithIndex().map(lambda b: (b[1], b[0])).partitionBy(tasks).values().mapPartitions(joined)


def _best(rdd, histogram, nodes: int, node_bytes: int, best) -> list[np.ndarray]:
    """``best`` of the sum of ``histogram(block)`` over all blocks: arrays over the ``nodes``, the first axis of a histogram.

    A range of nodes is added up and judged in one task; histograms don't get to the driver.
    """
    def added(items):
        total = None
        for item in items:
            h = histogram(item)
            total = h if total is None else np.add(total, h, out=total)
        return total

    if rdd.getNumPartitions() == 1:
        found = rdd.mapPartitions(lambda items: [] if (h := added(items)) is None else [best(h)]).collect()  # a row for each node
    else:
        ranges = max(1, min(nodes, rdd.context.defaultParallelism, nodes * node_bytes // RANGE_BYTES))

        def parts(items):
            h = added(items)
            return [] if h is None else list(enumerate(np.array_split(h, ranges)))

        judged = rdd.mapPartitions(parts).reduceByKey(np.add, ranges).mapValues(best).collect()  # a row for each node
        found = [v for _, v in sorted(judged, key=lambda x: x[0])]
    return [np.concatenate(x) for x in zip(*found)]


# --- boosting ------------------------------------------------------------------------

@dataclass
class BoostParams:
    rounds: int = 300
    depth: int = 6
    step: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    l2: float = 1.0
    least_hessian: float = 1.0
    bins: int = 256
    seed: int = 42


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def gradients(margins: np.ndarray, y: np.ndarray, drawn_rows: np.ndarray, unit: float, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fixed-point gradients and hessians of the softmax loss, (rows, classes); 0 for rows that are not drawn."""
    p = softmax(margins)
    w = (weights[y] * drawn_rows)[:, None]
    g = p.copy()
    g[np.arange(len(y)), y] -= 1.0
    return np.rint(g * w * unit), np.rint(np.maximum(2.0 * p * (1.0 - p), 1e-16) * w * unit)


def best_splits(g: np.ndarray, h: np.ndarray, p: BoostParams) -> tuple[np.ndarray, ...]:
    """Of histograms (node, feature, bin): per node the best gain, its place in the features, its first right bin, and the left sums."""
    gl, hl = np.cumsum(g, 2)[:, :, :-1], np.cumsum(h, 2)[:, :, :-1]
    gt, ht = g.sum(2)[:, :, None], h.sum(2)[:, :, None]
    gr, hr = gt - gl, ht - hl
    gain = gl * gl / (hl + p.l2) + gr * gr / (hr + p.l2) - gt * gt / (ht + p.l2)
    gain = np.where((hl >= p.least_hessian) & (hr >= p.least_hessian), gain, -np.inf)
    flat = gain.reshape(len(g), -1)
    best = flat.argmax(1)
    at = np.arange(len(g))
    j, b = np.divmod(best, gain.shape[2])
    return flat[at, best], j, b + 1, gl[at, j, b], hl[at, j, b]


def boost(train: DataFrame, n_features: int, classes: list[int], p: BoostParams = BoostParams(), class_weights: dict | None = None,
          keys: list[str] = ("employee_id", "quarter_label")) -> list[list[Tree]]:
    """Rounds of one tree for each class of ``train(features, label)``; labels are the indices of ``classes``."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    edges = bin_edges(train, n_features, p.bins)
    code = F.element_at(F.map_from_arrays(F.array(*[F.lit(float(c)) for c in classes]), F.array(*[F.lit(i) for i in range(len(classes))])), F.col("label").cast("double"))
    base, path = blocks(train.withColumn("label", code), edges, row_keys(train, list(keys)))
    n = base.map(lambda b: len(b[1])).sum()
    k = len(classes)
    weights = np.array([(class_weights or {}).get(c, 1.0) for c in classes])
    bits = min(FIXED_POINT, 62 - int(np.ceil(np.log2(max(n, 2) * max(weights.max(), 1.0)))))
    unit = float(1 << bits)
    width = max(len(e) for e in edges) + 1
    # a block's sums are exact in doubles
    most = max(1, min(LARGE, int(2.0 ** (53 - bits) / max(weights.max(), 1.0))))
    state = dealt(base, n, most).map(lambda b: (*b, np.zeros((k, len(b[1]))))).persist(StorageLevel.MEMORY_AND_DISK)
    many = state.getNumPartitions() > 1
    columns = max(1, int(p.columns * n_features))
    out, before, drawn_rows = [], None, None
    try:
        for r in range(p.rounds):
            used = [drawn(columns, n_features, p.seed, 1, r, c) for c in range(k)]
            trees = [Tree.root() for _ in range(k)]
            open_nodes = [[0] for _ in range(k)]
            drawn_rows = state.map(_round_gradients(r, unit, weights, p))
            if many:  # of one task's rows the gradients are sooner taken again
                drawn_rows.persist(StorageLevel.MEMORY_AND_DISK)
            for _ in range(p.depth):
                nodes = sum(len(x) for x in open_nodes)
                found = _best(drawn_rows, _boost_histogram([t.arrays() for t in trees], open_nodes, used, width), nodes, 16 * columns * width, _boost_best(unit, p))
                if before is not None:  # the first job of the round has made the blocks anew
                    before.unpersist()
                    before = None
                at = 0
                for c in range(k):
                    here = [x[at : at + len(open_nodes[c])] for x in found]
                    at += len(open_nodes[c])
                    open_nodes[c] = _grow(trees[c], open_nodes[c], here, used[c], edges, p)
                if not any(open_nodes):
                    break
            out.append(trees)
            if many:
                drawn_rows.unpersist()
            if r + 1 < p.rounds:
                before, state = state, _advanced(state, trees, p.step, r)
    finally:
        for x in (before, state, drawn_rows if many else None):
            if x is not None:
                x.unpersist()
        remove(spark, path)
    return out


def _round_gradients(r: int, unit: float, weights: np.ndarray, p: BoostParams):
    """Block -> (bins, gradients, hessians) of the rows that are drawn in round ``r``, (classes, rows)."""
    kind = np.int32 if unit * weights.max() < 1 << 31 else np.float64

    def taken(block):
        bins, y, keys, margins = block
        rows = np.flatnonzero(_uniform(keys, p.seed, 2, r) < p.rows)
        g, h = gradients(margins[:, rows].T, y[rows], np.ones(len(rows)), unit, weights)
        return bins[:, rows], np.ascontiguousarray(g.T, kind), np.ascontiguousarray(h.T, kind)
    return taken


def _boost_histogram(arrays: list, open_nodes: list, used: list, width: int):
    """Block -> (open nodes of all classes, 2, features, bins) sums of gradients and hessians."""
    def histogram(block):
        bins, g, h = block
        parts = []
        for c, nodes in enumerate(open_nodes):
            if not nodes:
                continue
            slot_of = np.full(len(arrays[c][0]), -1)
            slot_of[nodes] = np.arange(len(nodes)) * width
            place = slot_of.take(route(arrays[c], bins))
            rows = np.flatnonzero(place >= 0)
            whole = len(rows) == len(place)
            here = place if whole else place[rows]
            both = [(x if whole else x[rows]).astype(np.float64) for x in (g[c], h[c])]
            size = len(nodes) * width
            part = np.empty((len(nodes), 2, len(used[c]), width), np.int64)
            for j, f in enumerate(used[c]):
                at = here + (bins[f] if whole else bins[f, rows])
                for i, x in enumerate(both):
                    part[:, i, j] = np.bincount(at, x, size).reshape(len(nodes), width)
            parts.append(part)
        return np.concatenate(parts)
    return histogram


def _boost_best(unit: float, p: BoostParams):
    """Histograms -> arrays over their nodes: what ``best_splits`` gives, and the nodes' sums."""
    def best(sums):
        g, h = np.ascontiguousarray(sums[:, 0]) / unit, np.ascontiguousarray(sums[:, 1]) / unit
        return *best_splits(g, h, p), g[:, 0].sum(1), h[:, 0].sum(1)
    return best


def _grow(tree: Tree, nodes: list[int], found: list[np.ndarray], used: list[int], edges: list[np.ndarray], p: BoostParams) -> list[int]:
    """Split the open ``nodes`` where that gains; the nodes that are open next."""
    following = []
    for node, gain, j, cut, gl, hl, gt, ht in zip(nodes, *found):
        tree.cover[node], tree.value[node] = float(ht), float(-gt / (ht + p.l2))
        f = used[j]
        if gain > 1e-6 and cut <= len(edges[f]):
            two = tree.split(node, f, int(cut), float(edges[f][cut - 1]), float(gain))
            for child, (a, b) in zip(two, ((gl, hl), (gt - gl, ht - hl))):
                tree.cover[child], tree.value[child] = float(b), float(-a / (b + p.l2))
            following += two
    return following


def _advanced(state, trees: list[Tree], step: float, r: int):
    """The blocks with margins that hold the trees as well; made by the next job that reads them."""
    arrays = [t.arrays() for t in trees]
    values = [step * np.array([v if f < 0 else 0.0 for f, v in zip(t.feature, t.value)]) for t in trees]

    def add(block):
        bins, y, keys, margins = block
        return bins, y, keys, margins + np.stack([v.take(route(a, bins)) for a, v in zip(arrays, values)])

    following = state.map(add).persist(StorageLevel.MEMORY_AND_DISK)
    if (r + 1) % CHECKPOINT_EVERY == 0:
        following.checkpoint()
    return following


# --- forests -------------------------------------------------------------------------

@dataclass
class ForestParams:
    trees: int = 300
    depth: int = 8
    least_rows: int = 10
    columns: int | None = None  # per node; the root of the number of features if None
    bins: int = 64
    seed: int = 42


def forest(train: DataFrame, n_features: int, n_classes: int, class_weights: dict[int, float], p: ForestParams = ForestParams(),
           keys: list[str] = ("employee_id", "quarter_label")) -> list[Tree]:
    """Trees of ``train(features, label)``; a node's value holds the weighted counts of its classes."""
    spark = train.sparkSession
    edges = bin_edges(train, n_features, p.bins)
    base, path = blocks(train, edges, row_keys(train, list(keys)))
    weights = np.array([class_weights.get(c, 0.0) for c in range(n_classes)])
    columns = p.columns or max(1, int(np.sqrt(n_features)))
    width = max(len(e) for e in edges) + 1
    one = (1 << (p.depth - 1)) * columns * width * (n_classes + 1) * 8
    together = max(1, HISTOGRAM_BYTES // one)
    out: list[Tree] = []
    state = None
    try:
        n = base.map(lambda b: len(b[1])).sum()
        state = dealt(base, n).persist(StorageLevel.MEMORY_AND_DISK)
        for first in range(0, p.trees, together):
            numbers = list(range(first, min(first + together, p.trees)))
            trees = [Tree.root() for _ in numbers]
            open_nodes = [[0] for _ in numbers]
            for depth in range(p.depth + 1):
                last = depth == p.depth  # its nodes are not split: one column gives their sums
                used = [{node: drawn(columns, n_features, p.seed, 3, t, node)[: 1 if last else None] for node in nodes} for t, nodes in zip(numbers, open_nodes)]
                nodes = sum(len(x) for x in open_nodes)
                found = _best(state, _forest_histogram(numbers, [t.arrays() for t in trees], open_nodes, used, width, n_classes, p.seed), nodes, one >> (p.depth - 1), _forest_best(weights, p))
                at = 0
                for i, nodes in enumerate(open_nodes):
                    here = [x[at : at + len(nodes)] for x in found]
                    at += len(nodes)
                    open_nodes[i] = _grow_forest(trees[i], nodes, here, used[i], edges, last)
                if not any(open_nodes):
                    break
            out += trees
    finally:
        if state is not None:
            state.unpersist()
        remove(spark, path)
    return out


def _forest_histogram(numbers: list[int], arrays: list, open_nodes: list, used: list, width: int, n_classes: int, seed: int):
    """Block -> (open nodes, columns, bins, classes + 1): drawn rows of each class, and rows that were drawn at all."""
    both = float(1 << 26)  # a weight holds a row's draws and the row itself: one sum for the two

    def histogram(block):
        bins, y, keys = block
        flat, n = bins.ravel(), len(y)
        parts = []
        for t, tree, nodes, cols in zip(numbers, arrays, open_nodes, used):
            if not nodes:
                continue
            count = poisson(keys, seed, 4, t)
            rows = np.flatnonzero(count)
            slot_of = np.full(len(tree[0]), -1)
            slot_of[nodes] = np.arange(len(nodes))
            slot = slot_of.take(route(tree, bins, rows))
            kept = np.flatnonzero(slot >= 0)
            if len(kept) < len(rows):
                rows, slot = rows[kept], slot[kept]
            features = np.array([cols[node] for node in nodes])
            weight, label = count[rows] * both + 1.0, y[rows]
            start, size = slot * width, len(nodes) * width * n_classes
            part = np.empty((len(nodes), features.shape[1], width, n_classes + 1), np.int64)
            for j in range(features.shape[1]):
                at = (start + flat.take((features[:, j] * n).take(slot) + rows)) * n_classes + label
                sums = np.bincount(at, weight, size).astype(np.int64).reshape(len(nodes), width, n_classes)
                part[:, j, :, :-1] = sums >> 26
                part[:, j, :, -1] = (sums & ((1 << 26) - 1)).sum(2)
            parts.append(part)
        return np.concatenate(parts)
    return histogram


def _forest_best(weights: np.ndarray, p: ForestParams):
    """Histograms -> arrays over their nodes: class weights, drawn rows, and gain, place in the columns and bin of the best split."""
    def best(sums):
        w, rows = sums[..., :-1] * weights, sums[..., -1]
        total = w[:, 0].sum(1)
        left, left_rows = np.cumsum(w, 2)[:, :, :-1], np.cumsum(rows, 2)[:, :, :-1]
        whole = total[:, None, None]
        gain = _gini(whole) - _gini(left) - _gini(whole - left)
        fine = (left_rows >= p.least_rows) & (rows.sum(2)[:, :, None] - left_rows >= p.least_rows)
        gain = np.where(fine, gain, -np.inf)
        if not gain.shape[2]:
            gain = np.full((*gain.shape[:2], 1), -np.inf)
        flat = gain.reshape(len(sums), -1)
        at = flat.argmax(1)
        return total, rows[:, 0].sum(1), flat[np.arange(len(sums)), at], *np.divmod(at, gain.shape[2])
    return best


def _gini(w: np.ndarray) -> np.ndarray:
    """Total weight times Gini impurity of class weights (..., classes)."""
    total = w.sum(-1)
    return total - (w * w).sum(-1) / np.where(total > 0, total, 1.0)


def _grow_forest(tree: Tree, nodes: list[int], found: list[np.ndarray], used: dict, edges: list[np.ndarray], last: bool) -> list[int]:
    """Set the open nodes' values and split those that gain by it; the nodes that are open next."""
    following = []
    for node, total, rows, gain, j, b in zip(nodes, *found):
        tree.value[node], tree.cover[node], tree.rows[node] = total.tolist(), float(total.sum()), int(rows)
        f = used[node][j]
        if not last and gain > 1e-9 * max(tree.cover[node], 1e-300) and b < len(edges[f]):
            following += tree.split(node, f, int(b) + 1, float(edges[f][b]), float(gain))
    return following


# --- Spark's model classes -----------------------------------------------------------

_NODE = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,"
         "leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")


def _node_rows(trees: list[Tree], forest_model: bool):
    for t, tree in enumerate(trees):
        for i, f in enumerate(tree.feature):
            value, cover = tree.value[i], tree.cover[i]
            if forest_model:
                stats, prediction = list(value), float(int(np.argmax(value)))
                impurity = float(_gini(np.array(value)) / cover) if cover > 0 else 0.0
            else:
                stats, prediction, impurity = [cover, 0.0, 0.0], float(value or 0.0), 0.0
            gain = tree.gain[i] / cover if f >= 0 and cover > 0 else -1.0
            # Spark sends values up to the threshold to the left: the largest double below ours
            cut = [float(np.nextafter(tree.threshold[i], -np.inf))] if f >= 0 else []
            yield t, (i, prediction, impurity, stats, int(tree.rows[i]), gain, int(tree.left[i]), int(tree.right[i]), (int(f), cut, -1))


def as_spark_model(spark, trees: list[Tree], n_features: int, n_classes: int | None = None, step: float = 1.0):
    """A ``RandomForestClassificationModel`` (``n_classes`` given) or ``GBTRegressionModel`` (else) of the trees."""
    from pyspark.ml.classification import RandomForestClassificationModel
    from pyspark.ml.regression import GBTRegressionModel
    is_forest = n_classes is not None
    kind, tree_kind = (("classification.RandomForestClassificationModel", "classification.DecisionTreeClassificationModel") if is_forest
                       else ("regression.GBTRegressionModel", "regression.DecisionTreeRegressionModel"))

    def meta(name: str, params: dict | None = None, **more) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.{name}", "timestamp": 0, "sparkVersion": spark.version, "uid": f"histogram_{name.split('.')[1]}",
                           "paramMap": {"impurity": "gini" if is_forest else "variance", **(params or {})}, "defaultParamMap": {}, **more})

    path = work_dir(spark, "tree-model")
    size = {"numFeatures": n_features, "numTrees": len(trees)} | ({"numClasses": n_classes} if is_forest else {})
    spark.createDataFrame([(meta(kind, {"numTrees": len(trees)} if is_forest else {}, **size),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    own = meta(tree_kind, numFeatures=n_features, **({"numClasses": n_classes} if is_forest else {}))
    spark.createDataFrame([(t, own, 1.0 if is_forest else step) for t in range(len(trees))], "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(list(_node_rows(trees, is_forest)), _NODE).coalesce(1).write.parquet(f"{path}/data")
    model = (RandomForestClassificationModel if is_forest else GBTRegressionModel).load(path)
    remove(spark, path)
    return model


def node_table(spark, model) -> list[dict]:
    """Per tree of one of Spark's tree ensembles, arrays over its nodes: feature, threshold (x <= threshold goes left), left, right, value, cover, gain; and its weight."""
    path = work_dir(spark, "tree-nodes")
    model.write().save(path)
    weights = {r[0]: r[2] for r in spark.read.parquet(f"{path}/treesMetadata").collect()}
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()  # as many as the model has
    remove(spark, path)
    by: dict[int, list] = {}
    for r in nodes:
        by.setdefault(r["treeID"], []).append(r)
    out = []
    for t in sorted(by):
        rs = sorted(by[t], key=lambda r: r["id"])
        classes = hasattr(model, "numClasses")
        value = np.array([[x / (sum(r["impurityStats"]) or 1.0) for x in r["impurityStats"]] if classes else [r["prediction"]] for r in rs])
        out.append({"feature": np.array([r["split"]["featureIndex"] if r["leftChild"] >= 0 else -1 for r in rs]),
                    "threshold": np.array([(r["split"]["leftCategoriesOrThreshold"] or [0.0])[0] for r in rs], float),
                    "left": np.array([r["leftChild"] for r in rs]), "right": np.array([r["rightChild"] for r in rs]), "value": value,
                    "cover": np.array([sum(r["impurityStats"]) if classes else r["impurityStats"][0] for r in rs], float),
                    "gain": np.array([r["gain"] for r in rs], float), "weight": weights[t]})
    return out


def walked(nodes: list[dict], x: np.ndarray) -> np.ndarray:
    """(outputs, rows): the weighted sum of the leaf values of trees as ``node_table`` gives them, for the rows of ``x``."""
    flat, start, total = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1], 0.0
    for tree in nodes:
        node = np.zeros(len(x), np.intp)
        inner = tree["feature"] >= 0
        feature, own = np.where(inner, tree["feature"], 0), np.arange(len(inner))
        children = np.stack([np.where(inner, tree["right"], own), np.where(inner, tree["left"], own)], axis=1).ravel()
        while inner.take(node).any():
            node = children.take(2 * node + (flat.take(start + feature.take(node)) <= tree["threshold"].take(node)))
        total = total + tree["weight"] * tree["value"].take(node, 0).T
    return total
