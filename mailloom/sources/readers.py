"""Batch and streaming scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.charsets import decode_page
from ..functions.emails import normalize_email
from ..functions.text import is_yes, strip
from . import schemas
from .files import child_names, path_exists

# Values may hold quotes, which are written twice.  Line breaks inside values
# are written as escapes (see :func:`escape_breaks`), so files can be split.
CSV_OPTIONS = {
    "header": True, "quote": '"', "escape": '"', "multiLine": False, "enforceSchema": False,
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def escape_breaks(c: Column) -> Column:
    """Line breaks and backslashes as two characters each."""
    return F.replace(F.replace(F.replace(
        c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def restore_breaks(c: Column) -> Column:
    """The inverse of :func:`escape_breaks`: pairs are read from left to right, whatever else the value holds."""
    # Between escaped backslashes every other backslash belongs to a line break.
    pieces = F.transform(F.split(c, r"\\\\", -1), lambda p: F.replace(
        F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.when(F.contains(c, F.lit("\\")), F.array_join(pieces, "\\")).otherwise(c)


def _restored(df: DataFrame) -> DataFrame:
    text = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    return df.withColumns({c: restore_breaks(F.col(c)) for c in text})


def seed_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Seeds from text lines: trimmed, without blank and '#' lines."""
    line = strip(F.col(column))
    return lines.select(line.alias("seed")).where(
        (F.col("seed") != "") & ~F.startswith(F.col("seed"), F.lit("#")))


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seed URLs from a text file; a missing file gives no rows."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "seed STRING")
    return seed_lines(spark.read.text(path))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGES).parquet(path)


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """Pages stored as single files, in the charset each declares: (url = file path, html)."""
    raw = spark.read.format("binaryFile").load(path)
    return raw.select(F.col("path").alias("url"), decode_page(F.col("content")).alias("html"))


def read_captured_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages stored as (page_id, url, content BINARY, content_type): their text by header, mark or tag."""
    raw = spark.read.schema(schemas.CAPTURED).parquet(path)
    return raw.select("page_id", "url", decode_page(F.col("content"), F.col("content_type")).alias("html"))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV folder with a header; a header that does not fit raises on read."""
    return _restored(spark.read.schema(schema).options(**CSV_OPTIONS).csv(path))


def read_contacts(spark: SparkSession, path: str) -> DataFrame:
    """Raw contact occurrences; a missing folder gives no rows."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.OCCURRENCES)
    return read_csv(spark, path, schemas.OCCURRENCES)


def read_clean_contacts(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.CLEAN_CONTACTS)
    if "part" in spark.read.options(**CSV_OPTIONS).csv(path).columns:
        return read_csv(spark, path, schemas.CLEAN_CONTACTS)
    whole = schemas.CLEAN_CONTACTS.removesuffix(", part BIGINT")  # files of others have no parts
    return read_csv(spark, path, whole).withColumn("part", F.lit(0).cast("long"))


def read_recipients(spark: SparkSession, path: str) -> DataFrame:
    """Recipient list: ``email`` is required, all other columns pass through.

    The usual optional columns are added as NULL where the file lacks them;
    rows without an address are dropped.
    """
    df = _restored(spark.read.options(**CSV_OPTIONS).csv(path))
    if "email" not in df.columns:
        raise ValueError(f"recipient list without an 'email' column: {df.columns}")
    for c in ("name", "university", "department"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df.where(F.coalesce(normalize_email(F.col("email")), F.lit("")) != "")


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MESSAGES).json(path)


def read_send_log(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.SEND_LOG)


def read_crawl_rules(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.CRAWL_RULES)


def read_routed(spark: SparkSession, path: str) -> DataFrame:
    """All routed replies with their ``class_slug``."""
    return _restored(spark.read.options(**CSV_OPTIONS).csv(path))


def read_routed_folders(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Routed replies of some folders below a path, each with one sub-folder per class."""
    columns = [*schemas.ROUTED_COLUMNS, "class_slug"]
    schema = ", ".join(f"{c} STRING" for c in columns)
    if not names:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).options(**CSV_OPTIONS, basePath=path).csv([f"{path}/{n}" for n in names])
    return _restored(found.select(*columns))


def master_versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of the master table, oldest first."""
    return sorted(
        int(n.split("=", 1)[1]) for n in child_names(spark, path)
        if n.startswith("version=") and path_exists(spark, f"{path}/{n}/_SUCCESS"))


def read_master(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The given or the newest version of the master table, flags as booleans."""
    if version is None:
        versions = master_versions(spark, path)
        if not versions:
            raise FileNotFoundError(f"no complete master version under {path}")
        version = versions[-1]
    df = read_csv(spark, f"{path}/version={version}", schemas.MASTER)
    return df.withColumns({c: is_yes(F.col(c)) for c in (
        "opened", "replied", "demo_scheduled", "customer")})


def stream_files(spark: SparkSession, path: str, schema: str, fmt: str = "parquet",
                 files_per_batch: int | None = None, name_glob: str | None = None) -> DataFrame:
    """A stream of files that arrive in a folder (inbox, opens, requests, pages)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if name_glob is not None:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.load(path)
