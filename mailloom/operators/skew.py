"""Building blocks that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_INDEX_BITS = 33  # monotonically_increasing_id keeps the position in these bits


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                    salt_on: Sequence[str], salts: int = 64) -> DataFrame:
    """The first ``k`` rows of each group.

    A first round ranks inside ``salts`` slices of every group, so a hot group
    is spread over many tasks and only ``k * salts`` of its rows reach the
    final round.  The result is exact.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)))
    inner = Window.partitionBy(*keys, "_salt").orderBy(*order)
    outer = Window.partitionBy(*keys).orderBy(*order)
    return (
        salted.withColumn("_rn", F.row_number().over(inner)).where(F.col("_rn") <= k)
        .withColumn("_rn", F.row_number().over(outer)).where(F.col("_rn") <= k)
        .drop("_rn", "_salt")
    )


def with_global_index(df: DataFrame, order: Sequence[str], name: str = "row_index",
                      partitions: int | None = None) -> DataFrame:
    """Add the 0-based position of each row in the total order of the table.

    A window without partitions would move all rows to one task.  Here rows
    are range-partitioned and sorted, stored once (so that positions cannot
    change between the two reads), and the number of rows in front of each
    partition is added to the position inside it.  Only those counts, one per
    partition, reach the driver; they come back as a table, not as literals.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows equal in ``order`` are told apart by their content, so the position
    # does not depend on the partitioning and equal keys need not share a task.
    by = [*order, "_tie"]
    placed = cut_lineage(
        df.withColumn("_tie", F.xxhash64(*df.columns))
        .repartitionByRange(n, *by).sortWithinPartitions(*by).drop("_tie")
        .withColumn("_place", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_place", _INDEX_BITS))
    counts = sorted(placed.groupBy("_part").count().collect())
    before, rows = 0, []
    for part, number in counts:
        rows.append((part, before))
        before += number
    offsets = spark.createDataFrame(rows, "_part BIGINT, _before BIGINT")
    local = F.col("_place").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    return placed.join(offsets, "_part").withColumn(name, F.col("_before") + local).select(
        *df.columns, name)
