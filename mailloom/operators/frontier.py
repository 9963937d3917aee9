"""Breadth-first walk over the captured link graph, level by level."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import host_of
from ..session import append_bucketed, cut_lineage, drop_stored, store_bucketed
from .skew import top_k_per_group

# Order of waiting links: older levels first, then class, page and position.
_ORDER = ("found_level", "class_rank", "src", "class_seq", "url")


def expand_frontier(starts: DataFrame, pages: DataFrame, edges: DataFrame,
                    max_pages: int | None = None,
                    per_level: int | None = None,
                    max_levels: int | None = None,
                    queue_factor: int | None = None) -> DataFrame:
    """Pages reached from each seed: (seed, url, level).

    ``starts`` has (seed, url), ``pages`` the canonical ``url`` of captured
    pages, ``edges`` (src, dst, class_rank, class_seq) and, where the class of
    a link depends on the seed, ``sub_rank``: its rank if its host is not the
    seed's.  Without limits everything reachable is reached.  Limits are for
    callers that ask for them: per level and seed at most ``per_level`` waiting
    links are taken, the best first, and the others stay for later levels; a
    seed ends when it has ``max_pages`` pages or when more than
    ``queue_factor * max_pages`` links wait.

    One level is a join on URL and an anti-join on (seed, URL); both spread
    over all keys even if one seed owns most of the graph.  Links and the visited (seed, URL)
    lie in buckets of these keys, to which a level adds its own, so it moves
    only new links, however much was visited before.  Every level is
    stored, so its plan does not grow and lost executors recompute only it.
    """
    spark = starts.sparkSession
    # Several captures of one page count as one; merging them before the shuffle
    # keeps a much-copied page from filling one bucket.
    if "sub_rank" not in edges.columns:
        edges = edges.withColumn("sub_rank", F.lit(None).cast("int"))
    once = edges.groupBy("src", "dst").agg(
        F.min(F.struct("class_rank", "class_seq", "sub_rank")).alias("o"))
    # Stored once, in buckets of the join key: a level only moves its own links.
    stored = (store_bucketed(pages.select("url").distinct(), "url"),
              store_bucketed(once.select("src", "dst", "o.class_rank", "o.class_seq", "o.sub_rank"), "src"))
    try:
        return _walk(starts, *map(spark.table, stored), max_pages, per_level, max_levels,
                     queue_factor)
    finally:
        drop_stored(spark, *stored)


def _walk(starts: DataFrame, captured: DataFrame, links: DataFrame, max_pages: int | None,
          per_level: int | None, max_levels: int | None, queue_factor: int | None) -> DataFrame:
    waiting = cut_lineage(starts.select(
        "seed", "url", F.lit(0).alias("found_level"), F.lit(0).alias("class_rank"),
        F.lit("").alias("src"), F.lit(0).alias("class_seq")))
    spark = starts.sparkSession
    seen = store_bucketed(waiting.select("seed", "url"), "seed", "url")
    try:
        return _levels(starts, waiting, seen, captured, links, max_pages, per_level, max_levels, queue_factor)
    finally:
        drop_stored(spark, seen)


def _levels(starts: DataFrame, waiting: DataFrame, seen: str, captured: DataFrame, links: DataFrame, max_pages: int | None,
            per_level: int | None, max_levels: int | None, queue_factor: int | None) -> DataFrame:
    spark, order = starts.sparkSession, [F.col(c) for c in _ORDER]
    reached: list[DataFrame] = []
    level = 0
    while not waiting.isEmpty() and (max_levels is None or level < max_levels):
        taken, rest = waiting, None
        if per_level is not None:
            taken = top_k_per_group(waiting, ["seed"], order, per_level, ["url"])
            rest = waiting.join(taken, ["seed", "url"], "left_anti")
        hits = taken.join(captured, "url", "left_semi")
        if max_pages is not None and reached:
            hits = _within_budget(hits, _union(reached), max_pages)
        elif max_pages is not None:
            hits = top_k_per_group(hits, ["seed"], order, max_pages, ["url"])
        hits = cut_lineage(hits.select("seed", *_ORDER))
        reached.append(hits.select("seed", "url", F.lit(level).alias("level")))

        found = cut_lineage(_new_links(hits, links, spark.table(seen), level + 1))
        append_bucketed(found.select("seed", "url"), seen, "seed", "url")
        waiting = found if rest is None else rest.unionByName(found)
        if max_pages is not None:  # only then can a seed end early
            waiting = _still_open(waiting, _union(reached), max_pages, queue_factor)
        if waiting is not found:
            waiting = cut_lineage(waiting)
        level += 1
    if not reached:
        return starts.select("seed", "url", F.lit(0).alias("level")).limit(0)
    return _union(reached)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _new_links(hits: DataFrame, links: DataFrame, seen: DataFrame, level: int) -> DataFrame:
    """Links of the pages just reached that no earlier level has queued."""
    out = hits.select("seed", F.col("url").alias("src")).join(links, "src")
    foreign = host_of(F.col("dst")) != host_of(F.col("seed"))
    out = out.withColumn("class_rank", F.when(F.col("sub_rank").isNotNull() & foreign, F.col("sub_rank"))
                         .otherwise(F.col("class_rank")))
    best = F.min(F.struct("class_rank", "src", "class_seq")).alias("best")
    return (
        out.groupBy("seed", F.col("dst").alias("url")).agg(best)
        .join(seen, ["seed", "url"], "left_anti")
        .select("seed", "url", F.lit(level).alias("found_level"), "best.class_rank",
                "best.src", "best.class_seq")
    )


def _within_budget(hits: DataFrame, reached: DataFrame, max_pages: int) -> DataFrame:
    """The best hits of each seed that still fit into its page budget."""
    order = [F.col(c) for c in _ORDER]
    used = reached.groupBy("seed").agg(F.count(F.lit(1)).alias("used"))
    first = top_k_per_group(hits, ["seed"], order, max_pages, ["url"])
    w = Window.partitionBy("seed").orderBy(*order)
    return (
        first.withColumn("rn", F.row_number().over(w)).join(used, "seed", "left")
        .where(F.col("rn") + F.coalesce("used", F.lit(0)) <= max_pages)
    )


def _still_open(waiting: DataFrame, reached: DataFrame, max_pages: int,
                queue_factor: int | None) -> DataFrame:
    """Drop the links of seeds whose budget is used up or whose queue is too long."""
    used = reached.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") >= max_pages).select("seed")
    if queue_factor is not None:
        long = waiting.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where(
            F.col("n") > queue_factor * max_pages).select("seed")
        used = used.unionByName(long)
    return waiting.join(used, "seed", "left_anti")
