"""Streaming jobs over arriving files.

The folds of opens and replies are mergeable, so each micro-batch is reduced
by itself and stored under its batch number; readers merge the parts.  No
state grows with the campaign, and nothing that arrives late is lost.

A part is written into a folder of its own for each attempt and counts once it
is complete; of several attempts of a batch the first complete one counts, and
none is ever changed, so readers see each event once at any time.
:func:`compact` merges older parts into one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import DEFAULT_SUFFIXES, REPLY_RULES, ROLE_PATTERNS
from ..functions.emails import may_hold_address
from ..functions.urls import is_skipped, normalize_url
from ..operators.contacts import occurrence_rows, page_hits_of
from ..operators.replies import (
    Rules, class_counts, classify_replies, enrich_replies, select_replies, validate_unsubscribes,
)
from ..operators.tracking import (
    fold_opens, fold_replies, master_from_folds, merge_open_folds, merge_reply_folds,
)
from ..session import delete_folder
from ..sources.files import child_names, path_exists
from ..sources.readers import read_routed_folders
from ..sources.sinks import route_by_class


def _start(writer, checkpoint: str, every: str | None) -> StreamingQuery:
    """Run on a schedule, or until all present input is done if ``every`` is None."""
    writer = writer.option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


_BATCH, _BASE = "batch=", "base="


def _part(path: str, batch_id: int) -> str:
    """A new folder for an attempt of a batch."""
    return f"{path}/{_BATCH}{batch_id}.{uuid.uuid4().hex}"


def _complete(spark: SparkSession, path: str, mark: str) -> dict[int, str]:
    """Number and name of the complete parts of a kind; the first attempt by name counts."""
    found: dict[int, str] = {}
    for name in sorted(n for n in child_names(spark, path) if n.startswith(mark)):
        number = int(name[len(mark):].split(".")[0])
        if number not in found and path_exists(spark, f"{path}/{name}/_SUCCESS"):
            found[number] = name
    return found


def _live_parts(spark: SparkSession, path: str) -> list[str]:
    """The newest complete base, which holds all batches up to its number, and the parts after it."""
    bases, parts = _complete(spark, path, _BASE), _complete(spark, path, _BATCH)
    last = max(bases, default=-1)
    return [*([bases[last]] if bases else []), *[n for i, n in sorted(parts.items()) if i > last]]


def _stored_once(spark: SparkSession, path: str, batch_id: int) -> bool:
    """Whether an earlier attempt of a batch is complete."""
    return batch_id in _complete(spark, path, _BATCH) or batch_id <= max(
        _complete(spark, path, _BASE), default=-1)


def _save_part(batch: DataFrame, path: str, batch_id: int) -> None:
    if not _stored_once(batch.sparkSession, path, batch_id):
        batch.write.parquet(_part(path, batch_id))


def _read_parts(spark: SparkSession, path: str, empty: DataFrame) -> DataFrame:
    """All live parts below a path, or no rows before the first batch."""
    names = _live_parts(spark, path)
    if not names:
        return empty.limit(0)
    return spark.read.parquet(*[f"{path}/{n}" for n in names]).select(*empty.columns)


def compact(spark: SparkSession, path: str, read: Callable[[SparkSession, str], DataFrame]) -> int:
    """Merge all live parts into one base; returns how many it replaces.

    ``read`` is the reader of the parts, such as :func:`read_opens`.  The parts
    stay for readers that have already listed them; :func:`drop_compacted`
    deletes them later.
    """
    names = _live_parts(spark, path)
    numbers = _complete(spark, path, _BATCH)
    if len(names) < 2:
        return 0
    read(spark, path).write.parquet(f"{path}/{_BASE}{max(numbers)}.{uuid.uuid4().hex}")
    return len(names)


def drop_compacted(spark: SparkSession, path: str) -> None:
    """Delete what the newest base replaces; call it when no older reader is at work."""
    live = set(_live_parts(spark, path))
    bases = _complete(spark, path, _BASE)
    last = max(bases, default=-1)
    for name in child_names(spark, path):
        mark = next((m for m in (_BATCH, _BASE) if name.startswith(m)), None)
        if mark and name not in live and int(name[len(mark):].split(".")[0]) <= last:
            delete_folder(spark, f"{path}/{name}")


def stream_opens(opens: DataFrame, path: str, checkpoint: str,
                 every: str | None = None) -> StreamingQuery:
    """Fold arriving opens (tracking_id, ts) into one part per micro-batch."""

    def save(batch: DataFrame, batch_id: int) -> None:
        _save_part(fold_opens(batch), path, batch_id)

    return _start(opens.writeStream.foreachBatch(save), checkpoint, every)


def read_opens(spark: SparkSession, path: str) -> DataFrame:
    """Current open fold: first open and count per tracking_id."""
    empty = spark.createDataFrame(
        [], "tracking_id STRING, opened_date TIMESTAMP, opened_count BIGINT")
    return merge_open_folds(_read_parts(spark, path, empty))


def running_opens(opens: DataFrame) -> DataFrame:
    """The open fold as a streaming aggregate, for update or complete mode.

    Its state has one row per mail of the campaign; :func:`stream_opens`
    needs none.
    """
    return fold_opens(opens)


def stream_replies(inbox: DataFrame, recipients: DataFrame, keywords: Sequence[str],
                   self_email: str, routed_path: str, fold_path: str, checkpoint: str,
                   rules: Rules = REPLY_RULES, every: str | None = "5 minutes"
                   ) -> StreamingQuery:
    """Select, classify and route arriving replies, and fold them per address."""

    def save(batch: DataFrame, batch_id: int) -> None:
        chosen = select_replies(batch, recipients, keywords, self_email)
        classified = enrich_replies(classify_replies(chosen, rules), recipients).persist()
        try:
            # An attempt is a folder of its own and never changed; the first complete one of a batch counts.
            if batch_id not in _complete(batch.sparkSession, routed_path, _BATCH):
                route_by_class(classified, _part(routed_path, batch_id), "errorifexists")
            _save_part(fold_replies(classified), fold_path, batch_id)
        finally:
            classified.unpersist()

    return _start(inbox.writeStream.foreachBatch(save), checkpoint, every)


def read_routed_parts(spark: SparkSession, path: str) -> DataFrame:
    """All replies that :func:`stream_replies` has routed, with their ``class_slug``.

    Only complete attempts are listed, one for each batch, so a reader sees a batch whole or not at
    all, and once, also while it is repeated.
    """
    names = [n for _, n in sorted(_complete(spark, path, _BATCH).items())]
    return read_routed_folders(spark, path, [n for n in names if any(
        c.startswith("class_slug=") for c in child_names(spark, f"{path}/{n}"))])


def read_reply_folds(spark: SparkSession, path: str) -> DataFrame:
    """Current reply fold: latest reply and class per address."""
    empty = spark.createDataFrame(
        [], "email STRING, reply_date TIMESTAMP, classification STRING, last_message_id STRING, "
        "first_reply_date TIMESTAMP, reply_count BIGINT, demo_date TIMESTAMP, "
        "customer_date TIMESTAMP, unsubscribed BOOLEAN")
    return merge_reply_folds(_read_parts(spark, path, empty))


def current_master(spark: SparkSession, log: DataFrame, opens_path: str, replies_path: str,
                   **others: DataFrame) -> DataFrame:
    """The tracking table as of now, from the parts the streams have stored."""
    return master_from_folds(log, read_opens(spark, opens_path),
                             read_reply_folds(spark, replies_path), **others)


def running_class_counts(inbox: DataFrame, rules: Rules = REPLY_RULES) -> DataFrame:
    """Replies per class as a streaming aggregate; the state has a row per class."""
    return classify_replies(inbox, rules).groupBy("classification").agg(
        F.count(F.lit(1)).alias("n_replies"))


def stream_class_counts(inbox: DataFrame, path: str, checkpoint: str,
                        rules: Rules = REPLY_RULES, every: str | None = None
                        ) -> StreamingQuery:
    """Count the replies per class, one part per micro-batch."""

    def save(batch: DataFrame, batch_id: int) -> None:
        _save_part(class_counts(classify_replies(batch, rules)), path, batch_id)

    return _start(inbox.writeStream.foreachBatch(save), checkpoint, every)


def read_class_counts(spark: SparkSession, path: str) -> DataFrame:
    """Current number of replies per class."""
    empty = spark.createDataFrame([], "classification STRING, n_replies BIGINT")
    return _read_parts(spark, path, empty).groupBy("classification").agg(
        F.sum("n_replies").alias("n_replies"))


def stream_unsubscribes(requests: DataFrame, tokens: DataFrame, path: str, checkpoint: str,
                        every: str | None = None) -> StreamingQuery:
    """Store valid unsubscribe requests (token, ts) with their address, however late they come.

    Repeated requests are merged inside a batch and again when the table is read.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        _save_part(validate_unsubscribes(batch, tokens), path, batch_id)

    return _start(requests.writeStream.foreachBatch(save), checkpoint, every)


def read_unsubscribes(spark: SparkSession, path: str) -> DataFrame:
    """First valid request per token."""
    empty = spark.createDataFrame([], "token STRING, ts TIMESTAMP, email STRING")
    return _read_parts(spark, path, empty).groupBy("token", "email").agg(F.min("ts").alias("ts"))


def unique_pages(pages: DataFrame, seen: DataFrame, first: Sequence[Column] = ()) -> DataFrame:
    """First capture per canonical URL that is not in ``seen`` (url_hash); login and admin pages left out.

    Of several captures in one batch the smallest in the order ``first``, then by content, stays.
    """
    keyed = pages.where(~is_skipped(F.col("url"))).withColumn(
        "url_norm", normalize_url(F.col("url"))).withColumn("url_hash", url_hash(F.col("url_norm")))
    others = [c for c in keyed.columns if c not in ("url_norm", "url_hash")]
    best = F.min(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(first)], *others)).alias("best")
    return keyed.join(seen, "url_hash", "left_anti").groupBy("url_hash", "url_norm").agg(best).select(
        *[F.col(f"best.{c}").alias(c) for c in others], "url_norm", "url_hash")


def url_hash(url: Column) -> Column:
    """128 bits of a canonical URL."""
    return F.md5(url)


def stream_unique_pages(pages: DataFrame, path: str, checkpoint: str, every: str | None = None,
                        first: Sequence[Column] = ()) -> StreamingQuery:
    """Store the first capture of each canonical URL.

    What was seen is read from the stored parts themselves, so no state grows
    and a page is recognised however late its copy comes.
    """
    spark = pages.sparkSession

    def save(batch: DataFrame, batch_id: int) -> None:
        empty = spark.createDataFrame([], "url_hash STRING")
        _save_part(unique_pages(batch, _read_parts(spark, path, empty), first), path, batch_id)

    return _start(pages.writeStream.foreachBatch(save), checkpoint, every)


def read_unique_pages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return _read_parts(spark, path, spark.createDataFrame([], schema))


_CONTACT_PARTS = ("url STRING, source_url STRING, found_at TIMESTAMP, found STRUCT<title: STRING, "
                  "hits: ARRAY<STRUCT<email: STRING, rank: INT, method: STRING, snippet: STRING>>>, "
                  "url_norm STRING, url_hash STRING")


def stream_contacts(pages: DataFrame, path: str, checkpoint: str,
                    suffixes: Iterable[str] = DEFAULT_SUFFIXES,
                    exclude: Iterable[str] | None = ROLE_PATTERNS,
                    found_at: str | None = None, every: str | None = None) -> StreamingQuery:
    """Store the contacts of arriving pages, each canonical URL once; read with :func:`read_contact_parts`.

    Pages are reduced to their hits before the URLs are compared, so HTML is
    never shuffled.
    """
    when = F.current_timestamp() if found_at is None else F.col(found_at)
    html = F.col("html")
    reduced = pages.select(
        "url", F.col("url").alias("source_url"), when.alias("found_at"),
        F.when(may_hold_address(html), page_hits_of("html", suffixes, exclude)).alias("found"))
    return stream_unique_pages(reduced, path, checkpoint, every)


def read_contact_parts(spark: SparkSession, path: str) -> DataFrame:
    """Contact occurrences of all pages stored so far."""
    rows = read_unique_pages(spark, path, _CONTACT_PARTS).select(
        "source_url", "found_at", F.col("found.title").alias("title"),
        F.explode_outer("found.hits").alias("hit"),
    ).where(F.col("hit").isNotNull())
    return occurrence_rows(rows, [], "html").drop("rank")
