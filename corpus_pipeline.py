"""A corpus from documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``.  All but the last return
the columns of their input; other columns travel along untouched, whatever
their names.  A stage without input rows returns none.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailloom.llm import decontaminate, minhash, packing, quality, suffix_dedup
from mailloom.llm.common import stored, table

#: Packing is an optimisation over all documents, which SQL cannot express.
ORACLE_SQL = None


def _shielded(docs: DataFrame) -> tuple[DataFrame, str, str, dict[str, str]]:
    """The input under names that no operator uses, and how to get the names back."""
    back = {f"_col{i}": c for i, c in enumerate(docs.columns)}
    names = {c: k for k, c in back.items()}
    return docs.toDF(*back), names["doc_id"], names["text"], back


def _named(df: DataFrame, text_key: str, text: str, back: dict[str, str]) -> DataFrame:
    """The columns of documents again, with a new text and its length."""
    columns = [F.col(text if k == text_key else k).alias(c) if c != "n_chars" else
               F.length(text).cast("long").alias(c) for k, c in back.items()]
    return df.select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; so do documents that fail or lose too much."""
    df, _, text, back = _shielded(docs)
    judged = quality.judge_documents(df, text, tuple(k for k in back if k != text), cleaned=True)
    return _named(judged.where("kept"), text, "clean_text", back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, that with the smallest id."""
    df, doc_id, text, back = _shielded(docs)
    kept = minhash.near_duplicates(df, doc_id, text).where("kept").select(F.col(doc_id).alias("_kept"), F.col("text_key").alias("_key"))
    found = stored(kept.distinct(), "kept")
    df = df.withColumn("_kept", minhash.node_id(doc_id, text)).withColumn("_key", minhash.text_key(text))
    return df.join(found, ["_kept", "_key"], "left_semi").dropDuplicates(["_kept", "_key"]).select(
        *[F.col(k).alias(c) for k, c in back.items()])


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings go; so do documents of which nothing but white space is left."""
    df, doc_id, text, back = _shielded(docs)
    keep = tuple(k for k in back if k not in (doc_id, text))
    cut = suffix_dedup.remove_repeats(df, doc_id, text, keep, kept_text=True)
    left = F.coalesce(F.col("kept_text").rlike(r"[^\s]"), F.lit(False))
    return _named(cut.where((F.col("n_removed") == 0) | left), text, "kept_text", back)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    df, _, text, back = _shielded(docs)
    found = decontaminate.find_contamination(df, table(spark, sf_dir, "benchmark"), text, tuple(back))
    return found.where(F.size("spans") == 0).select(*[F.col(k).alias(c) for k, c in back.items()])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and offset."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
