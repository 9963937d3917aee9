"""Send planning: identifiers, personal texts, batches and quotas.  Nothing is sent."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import BATCH_SIZE, BATCH_WAIT_SECONDS, PILOT_SIZE, PROVIDER_LIMITS
from ..functions.emails import normalize_email
from ..functions.text import fill_template
from .replies import unique_recipients
from .skew import with_global_index

_DAYS_PER_MONTH = 30


def tracking_id(email: Column, campaign: str) -> Column:
    """Identifier of one mail; the same on every run, unlike a random one."""
    return F.sha2(F.concat_ws("|", F.lit(campaign), normalize_email(email)), 256)


def unsubscribe_token(email: Column, campaign: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(campaign), F.lit("unsubscribe"),
                              normalize_email(email)), 256)


def issued_tokens(recipients: DataFrame, campaign: str) -> DataFrame:
    """(token, email) of every unsubscribe link a campaign gives out."""
    return recipients.select(
        unsubscribe_token(F.col("email"), campaign).alias("token"),
        normalize_email(F.col("email")).alias("email")).distinct()


def with_tracking(body: Column, tracking: Column, token: Column, base_url: str) -> Column:
    """HTML body with an unsubscribe link and an open-tracking pixel at its end."""
    base = base_url.rstrip("/")
    return F.concat(
        # Fixed output: the markup of the tracking pixel and of the link.
        F.lit("<html><body>"), body,
        F.lit(f'<p><a href="{base}/unsubscribe?token='), token, F.lit('">Unsubscribe</a></p>'),
        F.lit(f'<img src="{base}/track-open/'), tracking,
        F.lit('" width="1" height="1" style="display:none;" /></body></html>'))


def build_mails(recipients: DataFrame, campaign: str, subject: str, body: str, base_url: str,
                fields: Mapping[str, Column] | None = None) -> DataFrame:
    """Add tracking_id, unsubscribe_token, subject and body_html to recipients."""
    if fields is None:
        fields = {c: F.col(c) for c in recipients.columns}
    tracking = tracking_id(F.col("email"), campaign)
    token = unsubscribe_token(F.col("email"), campaign)
    return recipients.select(
        "*", tracking.alias("tracking_id"), token.alias("unsubscribe_token"),
        fill_template(subject, fields).alias("subject"),
        with_tracking(fill_template(body, fields), tracking, token, base_url).alias("body_html"))


def provider_caps(provider: str) -> tuple[int | None, int | None, int | None]:
    """(per_day, per_month, per_second) of a known provider."""
    for name, *caps in PROVIDER_LIMITS:
        if name == provider:
            return tuple(caps)
    raise KeyError(provider)


@dataclass(frozen=True)
class Pace:
    """How many mails fit into a day and when each of them goes out.

    Batches start ``wait_seconds`` apart, or later if the mails of a batch take
    longer at ``per_second`` mails a second; inside a batch mails follow one
    another at that rate.  Nothing starts after ``window_seconds`` of a day.
    """

    batch_size: int = BATCH_SIZE
    wait_seconds: int = BATCH_WAIT_SECONDS
    daily_cap: int | None = None
    monthly_cap: int | None = None
    per_second: int | None = None
    window_seconds: int = 8 * 3600

    @property
    def batch_seconds(self) -> int:
        needed = -(-self.batch_size // self.per_second) if self.per_second else 0
        return max(self.wait_seconds, needed)

    @property
    def per_day(self) -> int:
        """Mails of one day: what the cap allows and the sending window holds."""
        batches = self.window_seconds // self.batch_seconds + 1 if self.batch_seconds else None
        fits = batches * self.batch_size if batches else None
        return min(x for x in (fits, self.daily_cap, self.monthly_cap, 1 << 62) if x is not None)

    def place(self, index: Column) -> tuple[Column, Column]:
        """(day, mail of the day) of the n-th mail; a month has 30 days."""
        day_cap = F.lit(self.per_day).cast("long")
        if self.monthly_cap is None:
            return F.floor(index / day_cap), F.pmod(index, day_cap)
        month_cap = F.lit(min(self.monthly_cap, self.per_day * _DAYS_PER_MONTH)).cast("long")
        in_month = F.pmod(index, month_cap)
        return (F.floor(index / month_cap) * _DAYS_PER_MONTH + F.floor(in_month / day_cap),
                F.pmod(in_month, day_cap))

    def seconds(self, in_day: Column) -> Column:
        """Seconds after the start of the day."""
        out = F.floor(in_day / F.lit(self.batch_size)) * F.lit(self.batch_seconds)
        if self.per_second:
            out = out + F.floor(F.pmod(in_day, F.lit(self.batch_size)) / F.lit(self.per_second))
        return out.cast("long")


def plan_sends(recipients: DataFrame, start_ts: datetime, order: list[str] | None = None,
               batch_size: int = BATCH_SIZE, wait_seconds: int = BATCH_WAIT_SECONDS,
               daily_cap: int | None = None, monthly_cap: int | None = None,
               per_second: int | None = None, window_seconds: int = 8 * 3600,
               dedupe: bool = True) -> DataFrame:
    """Add batch_number, planned_day and planned_at to recipients.

    Batches follow ``order`` (default: address).  Caps and the length of the
    daily sending window move the rest to later days, so no day runs into the
    next; see :class:`Pace`.  Suppress recipients before planning.
    """
    pace = Pace(batch_size, wait_seconds, daily_cap, monthly_cap, per_second, window_seconds)
    rows = unique_recipients(recipients) if dedupe else recipients
    indexed = with_global_index(rows, order or ["email"], "send_index")
    i = F.col("send_index")
    day, in_day = pace.place(i)
    start = F.lit(start_ts.isoformat(sep=" ")).cast("timestamp")
    seconds = day.cast("long") * F.lit(86_400) + pace.seconds(in_day)
    return indexed.select(
        *rows.columns, "send_index",
        (F.floor(i / F.lit(batch_size)) + 1).cast("long").alias("batch_number"),
        day.cast("long").alias("planned_day"),
        F.timestamp_seconds(F.unix_timestamp(start) + seconds).alias("planned_at"),
    )


def pilot_sample(df: DataFrame, n: int = PILOT_SIZE, key: str = "email") -> DataFrame:
    """A repeatable sample of ``n`` rows, taken by hash of the key.

    Each task keeps its own ``n`` best rows; only those are merged.
    """
    return df.orderBy(F.sha2(F.col(key).cast("string"), 256), F.col(key)).limit(n)


def split_send_results(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sent, failed) rows of a send log."""
    failed = F.coalesce(F.col("status"), F.lit("")).isin("Bounced", "Failed", "Error", "")
    return log.where(~failed), log.where(failed)
