"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies.  Among all rates
up to ``most`` that give each source its target of words, those are taken that
differ least, in the sense of relative entropy, from one copy of everything.
They are exponentially tilted: min(``most``, exp(t * size / mean size)) with one
multiplier t per source, which solves a convex dual.

1. Words are counted once and stored.  The dual depends on a document only
   through its source and size, so Newton's method runs on the counts of (source,
   size), merged on the map side: a hot source or a large group of copies is
   one row.  Every iteration sums the moments of all sources at once; a step
   that leaves the interval known to hold the root is replaced by its middle.
2. Targets: the share of each source's weight in all words, at most ``most``
   times its own; the excess is shared out by weight until none is above.
3. Copies.  All documents of a (source, size) cell have one rate.  Cells of a
   source are rounded from the largest size down, each taking over the words
   left owed by those before, so a source ends near its target.  The sizes of a
   source differ, so it has at most sqrt(2 * words) cells, which is what one
   task holds.
4. Inside a cell the copies are dealt to slices of about ``_SLICE`` documents by
   hash, and in a slice to the documents first in the order of the hash.

Null text has size 0; documents without words have no copies and a rate of 1.
A null source is a source of its own, the last one.  Rows with null or equal ids
are documents of their own; those that are equal in id, source and size may swap
their copies.  An empty table gives an empty result.  Equal tables give equal
results, however their rows are spread.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_WORD, global_index, stored

WEIGHTS = (1, 2, 3)
MOST = 3
_SLICE = 4096
_TOLERANCE = 1e-10
_ITERATIONS = 200
_REPAIRS = 32


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``target`` to rows (source, source_size): shares of weights that repeat over the sources in order."""
    numbered = global_index(sources.withColumn("_last", F.col("source").isNull()), ["_last", "source"], "_number")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    open_ = numbered.select("source", "source_size", F.get(cycle, (F.col("_number") % len(weights)).cast("int")).alias("_weight"),
                            (F.col("source_size") * F.lit(most)).cast("double").alias("_cap"), F.lit(False).alias("_full"))
    open_ = stored(open_, "sources")
    while True:
        total, fixed, weight = open_.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~F.col("_full"), F.col("_weight"))), F.lit(0))).first()
        share = (F.lit(float(total)) - F.lit(float(fixed))) * F.col("_weight") / F.lit(float(max(weight, 1)))
        target = F.when(F.col("_full"), F.col("_cap")).otherwise(share)
        above = open_.where(~F.col("_full") & (share > F.col("_cap")))
        if above.isEmpty():
            return open_.select("source", "source_size", target.alias("target"))
        open_ = stored(open_.withColumn("_full", F.col("_full") | (share > F.col("_cap"))), "sources")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _exact_sum(term: Column) -> Column:
    """A sum that does not depend on the order of its rows, so reruns agree to the last bit."""
    return F.sum(term.cast("decimal(28, 9)")).cast("double")


def multipliers(cells: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, target, mean, tilt): the root of each source's dual.

    ``cells`` has rows (source, size, n).  The tilt is null where only the bound
    itself reaches the target.  Sources that have converged are left alone.
    """
    counts = cells.where("size > 0").groupBy("source").agg(F.sum("n").alias("_n"), F.max("size").alias("_long"))
    state = targets.join(counts.withColumnRenamed("source", "_s"), _same("source", "_s"), "left").select(
        "source", "source_size", "target", (F.col("source_size") / F.col("_n")).alias("mean"),
        (F.col("_long") * F.col("_n") / F.col("source_size")).alias("_far"))
    # Between the two ends every rate is at the bound, or all words together are far below the target.
    at_bound = F.col("target") >= F.col("source_size") * most * (1 - 1e-12)
    state = stored(state.select(
        "source", "source_size", "target", "mean", "_far", F.when(at_bound | (F.col("source_size") == 0), None).otherwise(0.0).alias("tilt"),
        F.lit(None).cast("double").alias("_low"), F.lit(None).cast("double").alias("_high"),
        (at_bound | (F.col("source_size") == 0)).alias("_done")), "tilts")
    for _ in range(_ITERATIONS):
        busy = state.where(~F.col("_done"))
        if busy.isEmpty():
            break
        x = F.col("size") / F.col("mean")
        rate = F.exp(F.least(F.col("tilt") * x, F.lit(700.0)))
        words = F.col("n") * F.col("size")
        moments = cells.where("size > 0").withColumnRenamed("source", "_s").join(busy, _same("source", "_s")).groupBy("_s").agg(
            _exact_sum(words * F.least(rate, F.lit(float(most)))).alias("_sum"),
            _exact_sum(F.when(rate < most, words * x * rate).otherwise(0.0)).alias("_slope"))
        gap = F.col("target") - F.col("_sum")
        low = F.when(gap > 0, F.col("tilt")).otherwise(F.col("_low"))
        high = F.when(gap > 0, F.col("_high")).otherwise(F.col("tilt"))
        stepped = state.join(moments, _same("source", "_s"), "left").withColumns({
            "_l": low, "_h": high, "_next": F.col("tilt") + gap / F.col("_slope"),
            "_done": F.col("_done") | (F.abs(gap) <= _TOLERANCE * F.greatest(F.col("target"), F.lit(1.0)))})
        # Without an end on one side the tilt doubles away from zero.
        middle = F.when(F.col("_l").isNull(), F.least(F.col("tilt") * 2, F.lit(-1.0))).when(
            F.col("_h").isNull(), F.greatest(F.col("tilt") * 2, F.lit(1.0))).otherwise((F.col("_l") + F.col("_h")) / 2)
        inside = (F.col("_slope") > 0) & (F.col("_l").isNull() | (F.col("_next") > F.col("_l"))) & (
            F.col("_h").isNull() | (F.col("_next") < F.col("_h")))
        bounded = F.col("_l").isNotNull() & F.col("_h").isNotNull()
        far = F.abs(F.col("_next")) > 4 * F.abs(F.col("tilt")) + 4
        chosen = F.when(inside & (bounded | ~far), F.col("_next")).otherwise(middle)
        narrow = bounded & ((F.col("_h") - F.col("_l")) <= 1e-15 * F.greatest(F.abs("_h"), F.abs("_l")))
        done = F.col("_done") | F.coalesce(narrow, F.lit(False))
        state = stored(stepped.select(
            "source", "source_size", "target", "mean", "_far", F.when(done, F.col("tilt")).otherwise(chosen).alias("tilt"),
            F.when(done, F.col("_low")).otherwise(F.col("_l")).alias("_low"),
            F.when(done, F.col("_high")).otherwise(F.col("_h")).alias("_high"), done.alias("_done")), "tilts")
    return state.select("source", "source_size", "target", "mean", "tilt")


def round_cells(size: np.ndarray, n: np.ndarray, rate: np.ndarray, most: int) -> np.ndarray:
    """Copies of each cell, sizes falling.

    First every cell takes the whole number of copies just below or above n * rate, whichever leaves fewer
    words owed.  Then, as long as it brings the words closer to what the rates ask for, a
    cell gives or takes one copy, or one gives while another one takes.  No cell goes two copies or more beyond n * rate.
    """
    out, owed = np.zeros(len(size), np.int64), 0.0
    for k, (s, m, copies) in enumerate(zip(size.tolist(), n.tolist(), (n * rate).tolist())):
        low = min(int(copies), most * m)
        owed += s * (copies - low)
        up = owed > s / 2 and low < most * m and copies > low
        out[k] = low + up
        owed -= s * up
    for _ in range(_REPAIRS):
        grow = np.append(np.flatnonzero((out < most * n) & (out < n * rate + 1)), -1)
        shrink = np.append(np.flatnonzero((out > 0) & (out > n * rate - 1)), -1)
        plus, minus = (np.where(k < 0, 0, size[k]).astype(float) for k in (grow, shrink))
        order = np.argsort(minus, kind="stable")
        # For every cell that could take a copy the one to give whose size comes closest to the rest.
        at = np.searchsorted(minus[order], plus - owed)
        near = np.stack([order[np.clip(at + d, 0, len(order) - 1)] for d in (-1, 0)])
        left = np.abs(owed - plus[None, :] + minus[near])
        i, j = divmod(int(left.argmin()), len(grow))
        if left[i, j] >= abs(owed) - 1e-6:
            break
        out[grow[j]] += grow[j] >= 0
        out[shrink[near[i, j]]] -= shrink[near[i, j]] >= 0
        owed -= plus[j] - minus[near[i, j]]
    return out


def _rounded(most: int):
    def run(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("size", ascending=False)
        copies = round_cells(cells["size"].to_numpy(), cells["n"].to_numpy(), cells["rate"].to_numpy(), most)
        return cells.assign(copies=copies)[["source", "size", "n", "rate", "copies"]]
    return run


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", keep: tuple[str, ...] = (),
        weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per document: id, ``keep``, size, source, source_size, target, rate and copies (0 to ``most``)."""
    keys = [doc_id, *keep]
    sized = stored(docs.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(SPACE_WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.col(doc_id), F.col(text)).alias("_hash")), "sizes")
    cells = stored(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    targets = source_targets(cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most)
    tilts = stored(multipliers(cells, targets, most), "tilts")
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("tilt").isNull(), float(most)).otherwise(
        F.least(F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(700.0))), F.lit(float(most))))
    rated = cells.join(tilts.withColumnRenamed("source", "_s"), _same("source", "_s")).select("source", "size", "n", rate.alias("rate"))
    rounded = rated.where("size > 0").groupBy("source").applyInPandas(
        _rounded(most), "source string, size long, n long, rate double, copies long")
    plan = stored(rounded.unionByName(rated.where("size = 0").withColumn("copies", F.lit(0).cast("long"))), "copies")
    # Slices of a cell share its copies in proportion; one count per slice decides exactly.
    n_slices = F.ceil(F.col("n") / F.lit(_SLICE))
    dealt = sized.join(plan.select(F.col("source").alias("_s"), F.col("size").alias("_z"), "n", "rate", F.col("copies").alias("_all")),
                       _same("source", "_s") & (F.col("size") == F.col("_z"))).drop("_s", "_z")
    dealt = dealt.withColumn("_slice", F.pmod(F.xxhash64(F.lit(13), "_hash"), n_slices))
    slices = dealt.groupBy("source", "size", "_slice").agg(
        F.count(F.lit(1)).alias("_rows"), F.first("n").alias("_n"), F.first("_all").alias("_sum"))
    before = F.coalesce(F.sum("_rows").over(Window.partitionBy("source", "size").orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    share = "cast({0} as decimal(19, 0)) * cast(_sum % _n as decimal(19, 0)) div _n"
    slices = slices.withColumn("_before", before).select(
        F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("_slice").alias("_t"),
        (F.expr(share.format("(_before + _rows)")) - F.expr(share.format("_before"))).alias("_more"))
    placed = dealt.withColumn("_turn", F.row_number().over(Window.partitionBy("source", "size", "_slice").orderBy("_hash", "_k0")))
    placed = placed.join(slices, _same("source", "_s") & (F.col("size") == F.col("_z")) & (F.col("_slice") == F.col("_t")))
    copies = F.floor(F.col("_all") / F.col("n")) + F.when(F.col("_turn") <= F.col("_more"), 1).otherwise(0)
    sums = tilts.select(F.col("source").alias("_o"), "source_size", "target")
    out = placed.select(*[f"_k{i}" for i in range(len(keys))], "size", "source", "rate", copies.cast("long").alias("copies"))
    out = out.join(sums, _same("source", "_o"))
    return out.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys) if k not in ("size", "source")],
                      "size", "source", "source_size", "target", "rate", "copies")
