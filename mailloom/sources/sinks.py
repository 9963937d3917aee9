"""Sinks.  CSV is the exchange form; Parquet is better for further work."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.emails import is_institutional, is_valid_email, normalize_email
from ..functions.text import csv_safe
from ..operators.contacts import CLEAN_COLUMNS, OCCURRENCE_COLUMNS
from ..operators.replies import class_slug
from ..operators.tracking import master_as_text
from .readers import escape_breaks, read_clean_contacts
from .schemas import ROUTED_COLUMNS

_CSV = {
    "header": True, "quote": '"', "escape": '"', "emptyValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_GUARDED = ("page_title", "context_snippet", "notes")


def _csv(df: DataFrame, mode: str) -> DataFrameWriter:
    text = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    df = df.withColumns({c: escape_breaks(F.col(c)) for c in text})
    return df.write.mode(mode).options(**_CSV)


def write_contacts(df: DataFrame, path: str, mode: str = "append") -> None:
    """Contact occurrences in file order, free-text columns guarded."""
    status = F.coalesce("http_status", F.lit("200")) if "http_status" in df.columns else F.lit(
        "200")
    ready = df.withColumn("http_status", status).withColumns(
        {c: csv_safe(F.col(c)) for c in _GUARDED if c in df.columns})
    _csv(ready.select(*OCCURRENCE_COLUMNS), mode).csv(path)


def clean_as_text(clean: DataFrame) -> DataFrame:
    """Consolidated contacts in file form: sources joined by ';'."""
    if dict(clean.dtypes)["sources"] != "string":
        clean = clean.withColumn("sources", F.array_join("sources", ";"))
    if "part" not in clean.columns:
        clean = clean.withColumn("part", F.lit(0).cast("long"))
    return clean.select(*CLEAN_COLUMNS)


def write_clean_contacts(df: DataFrame, path: str) -> None:
    _csv(clean_as_text(df), "overwrite").csv(path)


def reclean_file(spark: SparkSession, path: str, out_path: str) -> dict[str, int]:
    """Filter a clean contact file into a new folder; returns removed and remaining counts.

    The counts are observed while writing, so the file is read once.
    """
    df = read_clean_contacts(spark, path)
    e = normalize_email(F.col("email"))
    role = is_institutional(e, strict=False)
    seen = Observation("reclean")
    counted = df.where(is_valid_email(e)).observe(
        seen, F.count_if(role).alias("removed"), F.count_if(~role).alias("remaining"))
    _csv(counted.where(~role).select(*CLEAN_COLUMNS), "overwrite").csv(out_path)
    return dict(seen.get)


def write_recipients(df: DataFrame, path: str) -> None:
    """A recipient list; all columns are kept."""
    _csv(df, "overwrite").csv(path)


def write_send_log(df: DataFrame, path: str) -> None:
    _csv(df.select("email", "sent_date", "status", "tracking_id", "batch_number"),
         "append").csv(path)


def route_by_class(df: DataFrame, path: str, mode: str = "append") -> None:
    """One folder per reply class.

    Rows are rebalanced by class: files get a sensible size, and a class that
    holds much of the data is split over several tasks.
    """
    routed = df.select(*ROUTED_COLUMNS, class_slug(F.col("classification")).alias("class_slug"))
    balanced = routed.hint("rebalance", "class_slug")
    _csv(balanced, mode).partitionBy("class_slug").csv(path)


def write_master(df: DataFrame, path: str, version: int) -> None:
    """A complete new version of the master table; older versions stay readable."""
    _csv(master_as_text(df), "overwrite").csv(f"{path}/version={version}")


def write_metrics(df: DataFrame, path: str) -> None:
    """Metrics summary as one file; it has a row per metric and group.

    The aggregate before it keeps its own tasks; only its rows move to one.
    """
    _csv(df.repartition(1), "overwrite").csv(path)
