"""Resharding by minimum-cost flow.

Documents lie in old shards.  Inside each old shard they form blocks (by a hash
of their id and text); only the bytes and rows of the blocks, a bounded number
however large the data, reach the driver.  A flow from old shards to new
capacities with cost 0 for staying and 1 per byte for moving tells how many
bytes go from each old shard to each new one; whole blocks follow the flow.
The files of the new layout are then written, one folder per shard, and a
shard whose blocks do not change is reported as untouched.

Null text has size 1, null ids share a block with their text, repeated rows
lie side by side in one block.  Shards may stay empty.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_dir

BLOCKS_PER_SHARD = 1024


@dataclass
class Flow:
    """Minimum-cost flow by successive shortest paths on a small graph."""

    n: int
    to: list[int] = field(default_factory=list)
    cap: list[int] = field(default_factory=list)
    cost: list[int] = field(default_factory=list)
    out: list[list[int]] = field(default_factory=list)

    def __post_init__(self):
        self.out = [[] for _ in range(self.n)]

    def edge(self, a: int, b: int, cap: int, cost: int) -> int:
        for x, y, c, w in ((a, b, cap, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.cap.append(c)
            self.cost.append(w)
        return len(self.to) - 2

    def run(self, source: int, sink: int) -> int:
        """Send as much as possible as cheaply as possible; returns the cost."""
        height, total = [0] * self.n, 0
        while True:
            dist, via = [None] * self.n, [-1] * self.n
            dist[source], heap = 0, [(0, source)]
            while heap:
                d, a = heapq.heappop(heap)
                if d > dist[a]:
                    continue
                for e in self.out[a]:
                    if self.cap[e] > 0:
                        nd = d + self.cost[e] + height[a] - height[self.to[e]]
                        if dist[self.to[e]] is None or nd < dist[self.to[e]]:
                            dist[self.to[e]], via[self.to[e]] = nd, e
                            heapq.heappush(heap, (nd, self.to[e]))
            if dist[sink] is None:
                return total
            far = max(d for d in dist if d is not None)
            height = [h + (d if d is not None else far) for h, d in zip(height, dist)]
            push, at = None, sink
            while at != source:
                push = self.cap[via[at]] if push is None else min(push, self.cap[via[at]])
                at = self.to[via[at] ^ 1]
            at = sink
            while at != source:
                self.cap[via[at]] -= push
                self.cap[via[at] ^ 1] += push
                total += push * self.cost[via[at]]
                at = self.to[via[at] ^ 1]


def transfers(old_bytes: list[int], capacities: list[int]) -> np.ndarray:
    """Bytes from each old shard to each new one that move the fewest; capacities hold the total."""
    n, m = len(old_bytes), len(capacities)
    flow = Flow(n + m + 2)
    pairs = {}
    for i, size in enumerate(old_bytes):
        flow.edge(n + m, i, size, 0)
        for j in range(m):
            pairs[i, j] = flow.edge(i, n + j, size, int(i != j))
    for j, room in enumerate(capacities):
        flow.edge(n + j, n + m + 1, room, 0)
    flow.run(n + m, n + m + 1)
    return np.array([[flow.cap[pairs[i, j] ^ 1] for j in range(m)] for i in range(n)], dtype=np.int64)


def place_blocks(blocks: list[tuple[int, int, int]], n_old: int, n_new: int) -> dict[tuple[int, int], int]:
    """New shard of each (old shard, block), from (old, block, bytes) rows.

    Blocks of an old shard go, largest first, to the new shard whose share of
    the flow has most left; the rounding of each step is carried on, and a last
    pass moves blocks from the fullest to the emptiest shard while that evens
    them out.
    """
    old = [0] * n_old
    for i, _, size in blocks:
        old[i] += size
    total = sum(old)
    goal = [total * (j + 1) // n_new - total * j // n_new for j in range(n_new)]
    left = transfers(old, goal).astype(object)
    where, load = {}, [0] * n_new
    for i, b, size in sorted(blocks, key=lambda x: (x[0], -x[2], x[1])):
        j = max(range(n_new), key=lambda j: (left[i][j] > 0, left[i][j], j == i, -j))
        left[i][j] -= size
        where[i, b] = j
        load[j] += size
    own: list[list[tuple[int, int, int]]] = [[] for _ in range(n_new)]
    for i, b, size in blocks:
        own[where[i, b]].append((size, i, b))
    for _ in range(64 * n_new):
        full, bare = max(range(n_new), key=load.__getitem__), min(range(n_new), key=load.__getitem__)
        gap = load[full] - load[bare]
        best = min((x for x in own[full] if x[0] < gap), key=lambda x: abs(2 * x[0] - gap), default=None)
        if best is None or best[0] == 0:
            break
        own[full].remove(best)
        own[bare].append(best)
        load[full] -= best[0]
        load[bare] += best[0]
        where[best[1:]] = bare
    return where


def document_size(text: str) -> Column:
    return (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("long")


def reshard(docs: DataFrame, old_shard: Column, n_old: int, n_new: int, doc_id: str = "doc_id",
            text: str = "text", blocks_per_shard: int = BLOCKS_PER_SHARD) -> tuple[str, DataFrame, DataFrame]:
    """Write the documents into ``n_new`` shards of near equal bytes.

    Returns (folder, plan, shards): ``plan`` has one row per block with its old
    and new shard, bytes and first slot; the folder holds the rows with
    ``_slot`` in one sub-folder per ``_shard``; ``shards`` says per new shard
    how many bytes it has, got from elsewhere, and whether it must be rewritten.
    Columns named ``_old``, ``_slot`` or ``_shard`` are replaced by those of the
    new layout; all others are kept, whatever their names.
    """
    spark = docs.sparkSession
    block = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(blocks_per_shard)).cast("int")
    dealt = docs.withColumns({"__old": old_shard.cast("int"), "__block": block, "__size": document_size(text)})
    rows = dealt.drop("_old", "_slot", "_shard").withColumnRenamed("__old", "_old")
    # At most n_old * blocks_per_shard rows, whatever the size of the table.
    stats = rows.groupBy("_old", F.col("__block").alias("_block")).agg(F.sum("__size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    where = place_blocks([(r["_old"], r["_block"], r["b"]) for r in stats], n_old, n_new)
    first, filled = [], [0] * n_new
    for r in sorted(stats, key=lambda r: (r["_old"], r["_block"])):
        j = where[r["_old"], r["_block"]]
        first.append((r["_old"], r["_block"], j, filled[j], r["b"], r["n"]))
        filled[j] += r["n"]
    plan = spark.createDataFrame(first, "_old int, _block int, _shard int, _first long, _bytes long, _rows long")
    rank = F.row_number().over(Window.partitionBy("_old", "__block").orderBy(
        F.col(doc_id).asc_nulls_first(), F.crc32(F.coalesce(F.col(text), F.lit("")))))
    starts = plan.select("_old", F.col("_block").alias("__block"), "_shard", F.col("_first").alias("__first"))
    placed = rows.withColumn("__rank", rank).join(F.broadcast(starts), ["_old", "__block"]).withColumn(
        "_slot", F.col("__first") + F.col("__rank") - 1).drop("__first", "__rank", "__size", "__block")
    folder = fresh_dir(spark, "shards")
    placed.write.partitionBy("_shard").option("compression", "zstd").parquet(folder)
    shards = plan.groupBy("_shard").agg(
        F.sum("_bytes").alias("bytes"),
        F.sum(F.when(F.col("_old") != F.col("_shard"), F.col("_bytes")).otherwise(0)).alias("moved_bytes"))
    return folder, plan, shards.withColumn("rewritten", F.col("moved_bytes") > 0)
