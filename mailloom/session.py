"""Session helpers."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


def build_session(app_name: str = "mailloom", master: str | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the operators count on.

    Times are naive UTC in the data, so the session zone is UTC.  Adaptive
    execution picks broadcast joins by measured size, splits skewed join
    partitions and sizes shuffles.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # State of seen URLs outgrows executor memory; keep it on local disk.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    } | {k: str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``.  Only a local
    session without that setting gets a fresh temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="mailloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_MADE: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate data below the shared one; see :func:`drop_scratch`."""
    folder = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.append((spark, folder))
    return folder


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def drop_scratch() -> None:
    """Delete all intermediate folders made so far; results read from them must have been used."""
    while _MADE:
        spark, folder = _MADE.pop()
        try:
            delete_folder(spark, folder)
        except Exception:  # noqa: BLE001  the session has ended, nothing to ask
            continue


def store_bucketed(df: DataFrame, *keys: str) -> str:
    """Store a table in buckets of ``keys``; returns its name in the catalog.

    Joins on the keys then move only their other side.  The table is external,
    in the shared folder; :func:`drop_stored` forgets it, and its files go with
    the other intermediate folders.
    """
    name = f"mailloom_{uuid.uuid4().hex}"
    _bucketed(df, keys, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))).option(
        "path", scratch_dir(df.sparkSession, name)).saveAsTable(name)
    return name


def append_bucketed(df: DataFrame, name: str, *keys: str) -> None:
    """Add rows to a table of :func:`store_bucketed`; only the new rows are dealt into its buckets."""
    spark = df.sparkSession
    n = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first()["data_type"]
    _bucketed(df, keys, int(n)).mode("append").saveAsTable(name)


def _bucketed(df: DataFrame, keys: tuple[str, ...], n: int) -> DataFrameWriter:
    return df.repartition(n, *keys).write.format("parquet").bucketBy(n, *keys)


def drop_stored(spark: SparkSession, *tables: str) -> None:
    for name in tables:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store a result as Parquet in the shared folder and continue from the stored copy."""
    spark, folder = df.sparkSession, scratch_dir(df.sparkSession, "stored")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
