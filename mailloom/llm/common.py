"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import ctypes
import inspect
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: Words are runs of anything but ASCII white space.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
#: After lower-casing A-Z: runs of a-z, 0-9 and everything outside ASCII.
TOKEN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}

_TASK_ROWS = 100_000

_STORED: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(n))


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; removed when the driver ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    _STORED.append((spark, folder))
    return folder


def stored(df: DataFrame, name: str, partition_by: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage for good.

    ``rows``, a bound on how many there are, spares a small table a task and a file for every shuffle partition.
    """
    if rows is not None:
        df = df.coalesce(max(8, -(-rows // _TASK_ROWS)))
    spark, folder = df.sparkSession, fresh_dir(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@atexit.register
def drop_stored() -> None:
    """Delete the folders made so far; data read from them must have been used."""
    while _STORED:
        spark, folder = _STORED.pop()
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001  the session has ended, nothing to ask
            continue


def give_back() -> None:
    """Hand freed memory back to the system: a worker is used again by later stages, which need theirs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def giving_back(fn: Callable) -> Callable:
    """``fn`` for a group of rows, followed by :func:`give_back`."""
    def run(*tables):
        try:
            return fn(*tables)
        finally:
            give_back()

    # The engine tells the form of a function by its arguments.
    return {1: lambda a: run(a), 2: lambda a, b: run(a, b)}[len(inspect.signature(fn).parameters)]


def text_blocks(batches: Iterable[pa.RecordBatch], chars: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches whose first string column holds about so many bytes.

    A single text is never cut, so a slice holds at least one row.
    """
    for batch in batches:
        col = next(i for i, f in enumerate(batch.schema)
                   if pa.types.is_string(f.type) or pa.types.is_large_string(f.type)
                   or pa.types.is_binary(f.type) or pa.types.is_large_binary(f.type))
        sizes = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        start = 0
        total = np.cumsum(sizes)
        while start < batch.num_rows:
            base = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, base + chars, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def rows_out(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def global_index(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add the place of each row in the total order of the table, from 0.

    Rows are range-partitioned by ``order`` (which should tell rows apart, so
    that no range outgrows a task) and stored once; what is joined back is one
    count per partition.
    """
    spark = df.sparkSession
    place = stored(df.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
                   .withColumn("_place", F.monotonically_increasing_id()), "index")
    part, local = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted(place.groupBy(part.alias("p")).count().collect())
    before = np.cumsum([0, *[c for _, c in counts]])
    offsets = spark.createDataFrame([(p, int(b)) for (p, _), b in zip(counts, before)], "_part long, _before long")
    return (place.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + local).drop("_part", "_before", "_place"))
