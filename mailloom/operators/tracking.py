"""Folding opens, replies and delivery events into one table, and funnel metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.emails import normalize_email
from ..functions.text import yes_no
from .replies import unique_recipients

# Later states override earlier ones.
STATUS_RANK = {"Sent": 0, "Delivered": 1, "Bounced": 2, "Unsubscribed": 3}

MASTER_COLUMNS = (
    "email", "name", "university", "sent_date", "opened", "opened_date", "opened_count",
    "replied", "reply_date", "classification", "status", "demo_scheduled", "demo_date",
    "customer", "tracking_id", "customer_date",
)


def fold_opens(opens: DataFrame) -> DataFrame:
    """First open and number of opens per tracking_id."""
    return opens.groupBy("tracking_id").agg(
        F.min("ts").alias("opened_date"), F.count(F.lit(1)).alias("opened_count"))


def merge_open_folds(folds: DataFrame) -> DataFrame:
    """Combine partial open folds, such as one per micro-batch."""
    return folds.groupBy("tracking_id").agg(
        F.min("opened_date").alias("opened_date"), F.sum("opened_count").alias("opened_count"))


def fold_replies(replies: DataFrame, tie: str = "message_id") -> DataFrame:
    """Latest reply and its class per address, with the dates other steps need.

    Works on classified replies (email, received_date, classification); equal
    dates are decided by ``tie``.  All columns are mergeable aggregates.
    """
    return _reply_aggregate(
        replies.select(
            normalize_email(F.col("email")).alias("email"),
            F.struct("received_date", F.col(tie).alias("tie"), "classification").alias("last"),
            F.col("received_date").alias("first_reply_date"),
            F.lit(1).cast("long").alias("reply_count"),
            F.when(F.col("classification") == "Demo Scheduled", F.col("received_date"))
            .alias("demo_date"),
            F.when(F.col("classification") == "Customer", F.col("received_date"))
            .alias("customer_date"),
            (F.col("classification") == "Unsubscribe").alias("unsubscribed"),
        ))


def _reply_aggregate(rows: DataFrame) -> DataFrame:
    folded = rows.groupBy("email").agg(
        F.max("last").alias("last"),
        F.min("first_reply_date").alias("first_reply_date"),
        F.sum("reply_count").alias("reply_count"),
        F.min("demo_date").alias("demo_date"),
        F.min("customer_date").alias("customer_date"),
        F.bool_or("unsubscribed").alias("unsubscribed"),
    )
    return folded.select(
        "email", F.col("last.received_date").alias("reply_date"),
        F.col("last.classification").alias("classification"),
        F.col("last.tie").alias("last_message_id"),
        "first_reply_date", "reply_count", "demo_date", "customer_date", "unsubscribed")


def merge_reply_folds(folds: DataFrame) -> DataFrame:
    """Combine partial reply folds, such as one per micro-batch."""
    return _reply_aggregate(folds.withColumn("last", F.struct(
        F.col("reply_date").alias("received_date"), F.col("last_message_id").alias("tie"),
        "classification")))


def fold_status(status: DataFrame) -> DataFrame:
    """Strongest delivery status per address."""
    rank = F.create_map(*[F.lit(x) for kv in STATUS_RANK.items() for x in kv])
    ranked = status.select(
        normalize_email(F.col("email")).alias("email"),
        F.struct(F.element_at(rank, F.col("status")).alias("rank"), "status").alias("s"))
    return ranked.groupBy("email").agg(F.max("s")["status"].alias("status"))


def build_master(log: DataFrame, opens: DataFrame, replies: DataFrame,
                 status: DataFrame | None = None, recipients: DataFrame | None = None,
                 customers: DataFrame | None = None,
                 demos: DataFrame | None = None) -> DataFrame:
    """One row per recipient of the send log with all that happened since.

    ``log`` (email, sent_date, status, tracking_id), ``opens`` (tracking_id,
    ts), ``replies`` classified (email, received_date, classification,
    message_id), further ``status`` events (email, status), ``recipients`` for
    name and university, ``customers`` (email, customer_date) and ``demos``
    (email, demo_date) known from elsewhere.  Opens count for the address that
    their tracking_id was sent to; ``tracking_id`` is that of the first mail.  Every side is aggregated to one
    row per key before its join, so no join multiplies rows and a hot address
    is reduced on the map side.
    """
    return master_from_folds(log, fold_opens(opens), fold_replies(replies), status, recipients,
                             customers, demos)


def master_from_folds(log: DataFrame, opens: DataFrame, replies: DataFrame,
                      status: DataFrame | None = None, recipients: DataFrame | None = None,
                      customers: DataFrame | None = None,
                      demos: DataFrame | None = None) -> DataFrame:
    """As :func:`build_master` from folded opens and replies, such as streams keep."""
    sends = log.groupBy(normalize_email(F.col("email")).alias("email")).agg(
        F.min("sent_date").alias("sent_date"),
        F.min(F.struct("sent_date", "tracking_id"))["tracking_id"].alias("tracking_id"))
    # Every mail of an address counts, not only its first.
    mails = log.select("tracking_id", normalize_email(F.col("email")).alias("email")).distinct()
    opened = mails.join(opens, "tracking_id").groupBy("email").agg(
        F.min("opened_date").alias("opened_date"), F.sum("opened_count").alias("opened_count"))
    states = log.select("email", F.coalesce("status", F.lit("Sent")).alias("status"))
    if status is not None:
        states = states.unionByName(status.select("email", "status"))
    unsubscribed = F.coalesce("unsubscribed", F.lit(False))
    out = (
        sends.join(opened, "email", "left")
        .join(fold_status(states), "email", "left")
        .join(replies, "email", "left")
        .withColumn("status", F.when(unsubscribed, "Unsubscribed").otherwise(F.col("status")))
    )
    if recipients is not None:
        out = out.join(unique_recipients(recipients.select("email", "name", "university")),
                       "email", "left")
    else:
        out = out.withColumns({"name": F.lit(None).cast("string"),
                               "university": F.lit(None).cast("string")})
    for extra, column in ((customers, "customer_date"), (demos, "demo_date")):
        if extra is not None:
            known = extra.groupBy(normalize_email(F.col("email")).alias("email")).agg(
                F.min(column).alias("known_date"))
            out = out.join(known, "email", "left").withColumn(
                column, F.least(column, "known_date")).drop("known_date")
    return out.select(
        "email", "name", "university", "sent_date",
        F.col("opened_count").isNotNull().alias("opened"), "opened_date",
        F.coalesce("opened_count", F.lit(0).cast("long")).alias("opened_count"),
        F.col("reply_date").isNotNull().alias("replied"), "reply_date", "classification",
        "status", F.col("demo_date").isNotNull().alias("demo_scheduled"), "demo_date",
        F.col("customer_date").isNotNull().alias("customer"), "tracking_id", "customer_date",
        "first_reply_date")


def update_master(master: DataFrame, replies: DataFrame) -> DataFrame:
    """Master rows with the outcome of newer replies, matched by address."""
    new = fold_replies(replies).select(
        "email", F.col("reply_date").alias("n_date"), F.col("classification").alias("n_class"),
        F.col("first_reply_date").alias("n_first"), F.col("demo_date").alias("n_demo"),
        F.col("customer_date").alias("n_customer"), F.col("unsubscribed").alias("n_unsubscribed"))
    j = master.join(new, "email", "left")
    newer = F.col("n_date").isNotNull() & (
        F.col("reply_date").isNull() | (F.col("n_date") >= F.col("reply_date")))
    updated = {
        "replied": F.col("replied") | F.col("n_date").isNotNull(),
        "classification": F.when(newer, F.col("n_class")).otherwise(F.col("classification")),
        "reply_date": F.when(newer, F.col("n_date")).otherwise(F.col("reply_date")),
        "status": F.when(F.col("n_unsubscribed"), "Unsubscribed").otherwise(F.col("status")),
        "demo_scheduled": F.col("demo_scheduled") | F.col("n_demo").isNotNull(),
        "demo_date": F.least("demo_date", "n_demo"),
        "customer": F.col("customer") | F.col("n_customer").isNotNull(),
        "customer_date": F.least("customer_date", "n_customer"),
    }
    if "first_reply_date" in master.columns:
        updated["first_reply_date"] = F.least("first_reply_date", "n_first")
    return j.select(*[updated.get(c, F.col(c)).alias(c) for c in master.columns])


def master_as_text(master: DataFrame) -> DataFrame:
    """Master table in its file form: Yes/No flags and the fixed column order."""
    flags = {"opened", "replied", "demo_scheduled", "customer"}
    return master.select(*[
        yes_no(F.col(c)).alias(c) if c in flags else F.col(c) for c in MASTER_COLUMNS])


def _rate(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))


def _days(start: str, end: str) -> Column:
    gap = F.unix_micros(F.col(end).cast("timestamp")) - F.unix_micros(
        F.col(start).cast("timestamp"))
    return F.avg(gap) / F.lit(86_400_000_000)


_METRICS = (
    ("Open Rate", "open_rate"), ("Reply Rate", "reply_rate"),
    ("Open-to-Reply Rate", "open_to_reply"), ("Lead Conversion", "lead_conversion"),
    ("Potential Buyer Rate", "buyer_rate"), ("Demo Conversion", "demo_conversion"),
    ("Customer Conversion", "customer_conversion"), ("Overall Conversion", "customer_conversion"),
    ("Lead-to-Demo Rate", "demo_conversion"), ("Demo-to-Customer Rate", "demo_to_customer"),
    ("Average Time to Reply", "days_to_reply"), ("Average Time to Convert", "days_to_convert"),
)


def funnel_metrics(master: DataFrame, by: Sequence[str] | None = None,
                   first_reply: bool = False) -> DataFrame:
    """(metric, value) rows; with ``by`` per group and for all (``is_total`` > 0).

    One scan and one aggregate compute all terms.  A rate without a
    denominator is NULL.
    """
    reply_date = "first_reply_date" if first_reply else "reply_date"
    sent = F.col("sent_date").isNotNull()
    terms = {
        "sent": sent,
        "opened": sent & F.col("opened"),
        "replied": sent & F.col("replied"),
        "leads": sent & (F.col("classification") == "Leads"),
        "buyers": sent & (F.col("classification") == "Potential Buyers"),
        "demos": sent & F.col("demo_scheduled"),
        "customers": sent & F.col("customer"),
    }
    aggs = [F.count_if(c).alias(n) for n, c in terms.items()] + [
        _days("sent_date", reply_date).alias("days_to_reply"),
        _days("sent_date", "customer_date").alias("days_to_convert")]
    if by:
        base = master.rollup(*by).agg(F.grouping_id().alias("is_total"), *aggs)
    else:
        base = master.agg(*aggs)
    groups = [*by, "is_total"] if by else []
    c = F.col
    wide = base.select(
        *groups,
        _rate(c("opened"), c("sent")).alias("open_rate"),
        _rate(c("replied"), c("sent")).alias("reply_rate"),
        _rate(c("replied"), c("opened")).alias("open_to_reply"),
        _rate(c("leads"), c("sent")).alias("lead_conversion"),
        _rate(c("buyers"), c("sent")).alias("buyer_rate"),
        _rate(c("demos"), c("leads")).alias("demo_conversion"),
        _rate(c("customers"), c("sent")).alias("customer_conversion"),
        _rate(c("customers"), c("demos")).alias("demo_to_customer"),
        "days_to_reply", "days_to_convert",
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), c(v).alias("value"))
                      for n, v in _METRICS])
    return wide.select(*groups, F.explode(pairs).alias("m")).select(*groups, "m.*")


def status_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("n_mails"))


def send_summary(log: DataFrame) -> DataFrame:
    """Mails per batch and status."""
    return log.groupBy("batch_number", "status").agg(F.count(F.lit(1)).alias("n_mails"))
