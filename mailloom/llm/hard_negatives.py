"""Hard negatives through a multiway hyperplane tree with distance ranges.

An anchor's positives are its ``n_positives`` best other rows of its label; for
each of them the ``n_negatives`` best rows of other labels are wanted whose score
lies between ``least`` percent of the positive's score and that score.  Scores
are inner products of integer vectors, so results are exact.

* Space.  Every row gets one more component that makes all norms equal to the
  largest, an anchor gets 0 there.  Then a score is a distance, and a window of
  scores an annulus around the anchor.
* Tree.  Split points are chosen far apart in a sample of at most ``SAMPLE``
  rows; every row goes to the nearest of a node's split points, down to a leaf.
  All rows are indexed.  Each split point keeps the range of its distances to
  the rows of every sibling.  A sibling is left out if, by the triangle inequality,
  its range cannot meet the annulus of a window.
* Leaves are exact: all their rows are compared.  A leaf is cut into blocks by
  hash and the anchors into chunks, and a task holds one block and one chunk, so
  neither a crowded leaf nor many anchors gather in one place.
* Bounds.  A first round looks only into the leaf the anchor itself falls into.  The
  worst score found there that would be returned narrows the window of the
  round over the whole tree, so what the blocks report stays small.

No row is left out by the index: a window's bounds are scores of rows that exist.

Rows with a null label, a null or empty vector, or a component that is null or
not finite take no part; shorter vectors end in zeros.  Scores have to fit a
long.  Rows are told apart even if their ids are equal, and such anchors repeat
in the result.  A null id comes after all others.  An empty table gives an
empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

N_POSITIVES, N_NEGATIVES, LEAST = 5, 5, 80
SCALE = 256
#: Rows that split points are chosen from; the tree has at most so many nodes whatever the table holds.
SAMPLE, FANOUT, DEPTH, LEAF_SAMPLE = 4096, 12, 2, 48
BLOCK_ROWS, LEAST_BLOCK_ROWS, CHUNK = 8192, 512, 4096
_COLUMNS = 256
_LAST = (1 << 63) - 1


@dataclass
class Tree:
    """Split points of all nodes; ``child`` holds a node, or -1 - leaf."""

    points: list[np.ndarray]
    child: list[list[int]]
    leaves: int

    def distances(self, node: int, rows: np.ndarray) -> np.ndarray:
        p = self.points[node]
        square = (rows * rows).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * rows @ p.T
        return np.sqrt(np.maximum(square, 0.0))

    def walk(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(node, rows in it, their distances to its split points, the nearest one) from the root down."""
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, own = todo.pop()
            d = self.distances(node, rows[own])
            near = d.argmin(1)
            yield node, own, d, near
            todo += [(c, own[near == j]) for j, c in enumerate(self.child[node]) if c >= 0 and (near == j).any()]

    def leaf(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int64)
        for node, own, _, near in self.walk(rows):
            ends = -1 - np.array(self.child[node])[near]
            out[own[ends >= 0]] = ends[ends >= 0]
        return out

    def slack(self, rows: np.ndarray) -> float:
        """More than rounding can add to a distance."""
        top = max(float(np.abs(rows).max(initial=1.0)), *(float(np.abs(p).max(initial=1.0)) for p in self.points))
        return 1e-6 * top * max(1, rows.shape[1] if rows.ndim > 1 else 1)


def fit_tree(sample: np.ndarray, fanout: int = FANOUT, depth: int = DEPTH, leaf_sample: int = LEAF_SAMPLE) -> Tree:
    """Split points by farthest-first choice: each next one is the row farthest from those chosen."""
    tree = Tree([], [], 0)

    def grow(rows: np.ndarray, level: int) -> int:
        node = len(tree.points)
        chosen, gap = [0], ((rows - rows[0]) ** 2).sum(1)
        while len(chosen) < fanout and gap.max() > 0:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, ((rows - rows[chosen[-1]]) ** 2).sum(1))
        tree.points.append(rows[chosen])
        tree.child.append([])
        near = tree.distances(node, rows).argmin(1)
        for j in range(len(chosen)):
            own = rows[near == j]
            if level + 1 < depth and len(own) > leaf_sample and len(chosen) > 1:
                tree.child[node].append(grow(own, level + 1))
            else:
                tree.child[node].append(-1 - tree.leaves)
                tree.leaves += 1
        return node

    grow(sample, 0)
    return tree


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of integer vectors, ended by zeros up to ``dims``."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), dims), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _lifted(q: np.ndarray, norm: float) -> np.ndarray:
    q = q.astype(float)
    return np.column_stack((q, np.sqrt(np.maximum(norm - (q * q).sum(1), 0.0))))


def _ranges(tree: Broadcast, dims: int, norm: float):
    """The least and the largest distance from each split point to the rows of each sibling, for one partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t: Tree = tree.value
        low = [np.full((len(p), len(p)), np.inf) for p in t.points]
        high = [np.full((len(p), len(p)), -np.inf) for p in t.points]
        for batch in batches:
            for node, _, d, near in t.walk(_lifted(_matrix(batch.column(0), dims), norm)):
                for j in np.unique(near):
                    own = d[near == j]
                    low[node][:, j] = np.minimum(low[node][:, j], own.min(0))
                    high[node][:, j] = np.maximum(high[node][:, j], own.max(0))
        rows = [(n, i, j, low[n][i, j], high[n][i, j]) for n in range(len(low)) for i, j in np.argwhere(low[n] < np.inf).tolist()]
        columns = list(zip(*rows)) if rows else [()] * 5
        types = [pa.int32()] * 3 + [pa.float64()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types)], names=["node", "i", "j", "low", "high"])
    return run


def _leaves(tree: Broadcast, dims: int, norm: float, anchor_side: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column(1), dims)
            rows = np.column_stack((q.astype(float), np.zeros(len(q)))) if anchor_side else _lifted(q, norm)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tree.value.leaf(rows).astype(np.int32))], names=["_uid", "_leaf"])
    return run


def reachable(tree: Tree, low: list[np.ndarray], high: list[np.ndarray], rows: np.ndarray,
              near: np.ndarray, far: np.ndarray) -> list[np.ndarray]:
    """For each leaf the anchors one of whose annuli, near to far, can hold rows of it."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * tree.leaves
    slack, todo = tree.slack(rows), [(0, np.arange(len(rows)))]
    while todo:
        node, own = todo.pop()
        d = tree.distances(node, rows[own])
        for j, c in enumerate(tree.child[node]):
            if not np.isfinite(low[node][:, j]).all():  # no row went there
                continue
            least = np.maximum(low[node][None, :, j] - d, d - high[node][None, :, j]).max(1) - slack
            most = (d + high[node][None, :, j]).min(1) + slack
            with np.errstate(invalid="ignore"):
                meets = ((least[:, None] <= far[own]) & (most[:, None] >= near[own])).any(1)
            if meets.any():
                if c >= 0:
                    todo.append((c, own[meets]))
                else:
                    out[-1 - c] = own[meets]
    return out


_ASKED = "_leaf int, _anchors binary, _count int"


def _packed(uid: np.ndarray, label: np.ndarray, low: np.ndarray, high: np.ndarray, q: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(x).tobytes() for x in (uid, label, low, high, q))


def _unpacked(raw: bytes, m: int, width: int, dims: int) -> list[np.ndarray]:
    out, at = [], 0
    for shape, kind in (((m,), np.int64), ((m,), np.int64), ((m, width), float), ((m, width), float), ((m, dims), np.int64)):
        size = int(np.prod(shape)) * 8
        out.append(np.frombuffer(raw[at:at + size], kind).reshape(shape))
        at += size
    return out


def _route(index: Broadcast, dims: int, norm: float, width: int, home: bool):
    """Chunks of anchors for each leaf their windows reach; at home only the anchor's own leaf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, low, high = index.value
        for batch in batches:
            uid, label = (batch.column(i).to_numpy() for i in (0, 1))
            q = _matrix(batch.column(2), dims)
            window = [batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(len(q), width) for i in (3, 4)]
            rows = np.column_stack((q.astype(float), np.zeros(len(q))))
            if home:
                leaf = tree.leaf(rows)
                hit = [np.flatnonzero(leaf == k) for k in range(tree.leaves)]
            else:
                whole = (rows * rows).sum(1)[:, None] + norm
                far, near = (np.sqrt(np.maximum(whole - 2 * w, 0.0)) for w in window)
                far = np.where(np.isneginf(window[0]), np.inf, far)
                hit = reachable(tree, low, high, rows, near, far)
            out = [(k, _packed(uid[own], label[own], window[0][own], window[1][own], q[own]), len(own))
                   for k, own in enumerate(hit) if len(own)]
            columns = list(zip(*out)) if out else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int32())],
                                             names=["_leaf", "_anchors", "_count"])
    return run


def _scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products; in floating point, where BLAS is, as long as every partial sum is exact."""
    bound = float(np.abs(rows).max(initial=0)) * float(np.abs(anchors).max(initial=0)) * rows.shape[1]
    if bound < 1 << 53:
        return anchors.astype(float) @ rows.T.astype(float)
    return anchors @ rows.T


def _best(dims: int, width: int, same_label: bool, n: int):
    """The best ``n`` rows of a block in each window of each anchor of a chunk, by score and id."""
    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        key = np.where(np.asarray(block.column("_id").is_null()), _LAST, block.column("_id").fill_null(0).to_numpy())
        uid, label = block.column("_uid").to_numpy(), block.column("label").to_numpy()
        order = np.lexsort((uid, key))
        q = _matrix(block.column("_q").chunk(0) if block.num_rows else pa.array([], pa.list_(pa.int64())), dims)[order]
        key, uid, label = key[order], uid[order], label[order]
        found: list[tuple] = []
        for raw, m in zip(asked.column("_anchors").to_pylist(), asked.column("_count").to_pylist()):
            a_uid, a_label, low, high, vectors = _unpacked(raw, m, width, dims)
            for at in range(0, m, _COLUMNS):
                part = slice(at, at + _COLUMNS)
                score = _scores(q, vectors[part])
                if same_label:
                    fit = (label[None, :] == a_label[part][:, None]) & (uid[None, :] != a_uid[part][:, None])
                else:
                    fit = label[None, :] != a_label[part][:, None]
                for w in range(width):
                    inside = fit & (score >= low[part][:, w:w + 1]) & (score <= high[part][:, w:w + 1])
                    for i in np.flatnonzero(inside.any(1)).tolist():
                        rows = np.flatnonzero(inside[i])
                        if len(rows) > n:  # rows are in the order of ids, so equal scores keep it
                            rows = rows[np.argsort(-score[i, rows], kind="stable")[:n]]
                        found += [(int(a_uid[at + i]), w, int(score[i, r]), int(key[r]), int(uid[r])) for r in rows.tolist()]
        columns = list(zip(*found)) if found else [()] * 5
        return pa.table({k: pa.array(c, pa.int64()) for k, c in zip(("anchor", "window", "score", "id", "uid"), columns)})
    return run


class Index:
    """All rows of a table in the leaves of a tree, cut into blocks."""

    def __init__(self, rows: DataFrame, dims: int, norm: float, count: int):
        spark = rows.sparkSession
        self.dims, self.norm = dims, norm
        first = rows.select("_q").orderBy(F.xxhash64("_uid"), "_uid").limit(SAMPLE).collect()
        sample = np.zeros((len(first), dims))
        for i, r in enumerate(first):
            sample[i, :len(r["_q"])] = r["_q"]
        tree = fit_tree(_lifted(sample, norm))
        held = spark.sparkContext.broadcast(tree)
        found = rows.select("_q").mapInArrow(_ranges(held, dims, norm), "node int, i int, j int, low double, high double")
        low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
        high = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
        for r in found.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
            low[r["node"]][r["i"], r["j"]], high[r["node"]][r["i"], r["j"]] = r["low"], r["high"]
        self.held = spark.sparkContext.broadcast((tree, low, high))
        leaf = stored(rows.select("_uid", "_q").mapInArrow(_leaves(held, dims, norm, False), "_uid long, _leaf int"), "leaves")
        size = min(BLOCK_ROWS, max(LEAST_BLOCK_ROWS, count // 64))
        self.blocks = stored(leaf.groupBy("_leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).alias("_blocks")), "blocks")
        self.rows = stored(rows.join(leaf, "_uid").join(self.blocks, "_leaf").withColumn(
            "_block", F.pmod(F.xxhash64("_uid"), F.col("_blocks"))).select("_leaf", "_block", "_uid", "_id", "label", "_q"), "indexed")

    def search(self, anchors: DataFrame, width: int, same_label: bool, n: int, home: bool = False) -> DataFrame:
        """Rows (anchor, window, score, id, uid): of every block the best ``n`` in each window.

        ``anchors`` has _uid, label, _q and arrays _low and _high of ``width`` bounds.
        """
        asked = anchors.select("_uid", F.col("label").cast("long").alias("label"), "_q", "_low", "_high").mapInArrow(
            _route(self.held, self.dims, self.norm, width, home), _ASKED)
        asked = stored(asked.join(self.blocks, "_leaf").select(
            "_leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_block"), "_anchors", "_count",
            F.monotonically_increasing_id().alias("_from")), "asked")
        # What meets in a task: one block, and chunks of anchors up to about CHUNK.
        turn = F.sum("_count").over(Window.partitionBy("_leaf", "_block").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1))
        asked = asked.withColumn("_chunk", F.floor(F.coalesce(turn, F.lit(0)) / F.lit(CHUNK)))
        chunks = asked.groupBy("_leaf", "_block").agg(F.max("_chunk").alias("_last"))
        sent = self.rows.join(chunks, ["_leaf", "_block"]).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))))
        key = ["_leaf", "_block", "_chunk"]
        pairs = sent.select(*key, "_uid", "_id", F.col("label").cast("long").alias("label"), "_q").groupBy(*key).cogroup(
            asked.select(*key, "_anchors", "_count").groupBy(*key))
        return pairs.applyInArrow(_best(self.dims, width, same_label, n), "anchor long, window long, score long, id long, uid long")


def _top(found: DataFrame, n: int) -> DataFrame:
    """The best ``n`` rows of each (anchor, window) over all blocks, with their rank."""
    order = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "id", "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(df: DataFrame, anchors: Column, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding",
         n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES, least: int = LEAST, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of each anchor and positive."""
    spark = df.sparkSession
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = stored(df.where(F.col(label).isNotNull() & (F.size(vector) > 0) & finite).select(
        F.col(vec_id).cast("long").alias("_id"), F.col(label).cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(v * scale)).alias("_q"), anchors.alias("_anchor")).withColumn(
        "_uid", F.monotonically_increasing_id()), "vectors")
    count, dims, norm = rows.agg(F.count(F.lit(1)), F.max(F.size("_q")), F.max(
        F.aggregate("_q", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not count:
        return spark.createDataFrame([], schema)
    index = Index(rows, dims, norm, count)
    asked = stored(rows.where("_anchor").select("_uid", F.col("_id").alias("_anchor_id"), "label", "_q"), "anchors")

    endless = F.array(F.lit(float("inf")))
    first = asked.withColumns({"_low": F.array(F.lit(float("-inf"))), "_high": endless})
    seen = _top(index.search(first, 1, True, n_positives, home=True), n_positives).groupBy("anchor").agg(
        F.when(F.count(F.lit(1)) == n_positives, F.min("score").cast("double")).alias("_worst"))
    bounded = asked.join(seen, F.col("_uid") == F.col("anchor"), "left").drop("anchor").withColumns(
        {"_low": F.array(F.coalesce("_worst", F.lit(float("-inf")))), "_high": endless})
    positives = stored(_top(index.search(bounded, 1, True, n_positives), n_positives).select(
        "anchor", F.col("rank").alias("place"), F.col("score").alias("p_score"), F.col("id").alias("p_id"), F.col("uid").alias("p_uid")), "positives")

    # Windows of an anchor, one for each positive; a window without a positive is empty.
    bound = F.ceil(F.col("p_score") * F.lit(least) / F.lit(100.0)).cast("double")
    wide = positives.withColumn("low", bound)

    def windows(low: DataFrame) -> DataFrame:
        each = low.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("place", F.struct("low", "p_score")))).alias("_w"))
        places = F.array(*[F.lit(k) for k in range(1, n_positives + 1)])
        return asked.join(each, F.col("_uid") == F.col("anchor")).drop("anchor").withColumns({
            "_low": F.transform(places, lambda k: F.coalesce(F.try_element_at("_w", k)["low"], F.lit(float("inf")))),
            "_high": F.transform(places, lambda k: F.coalesce(F.try_element_at("_w", k)["p_score"].cast("double"), F.lit(float("-inf"))))}).drop("_w")

    seen = _top(index.search(windows(wide), n_positives, False, n_negatives, home=True), n_negatives).groupBy("anchor", "window").agg(
        F.when(F.count(F.lit(1)) == n_negatives, F.min("score").cast("double")).alias("_worst"))
    narrow = wide.join(seen.withColumnRenamed("anchor", "_a"), (F.col("anchor") == F.col("_a")) & (F.col("place") == F.col("window") + 1), "left")
    narrow = stored(narrow.select("anchor", "place", "p_score", F.greatest("low", F.coalesce("_worst", "low")).alias("low")), "windows")
    negatives = _top(index.search(windows(narrow), n_positives, False, n_negatives), n_negatives)
    out = negatives.join(positives.withColumnRenamed("anchor", "_a"), (F.col("anchor") == F.col("_a")) & (F.col("window") + 1 == F.col("place")))
    out = out.join(asked.select("_uid", "_anchor_id"), F.col("anchor") == F.col("_uid"))
    name = lambda c: F.nullif(F.col(c), F.lit(_LAST))
    return out.select(F.col("_anchor_id").alias("anchor_id"), name("p_id").alias("positive_id"), "rank", name("id").alias("negative_id"),
                      F.col("p_score").alias("positive_score"), F.col("score").alias("negative_score"))
