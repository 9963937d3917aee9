"""Inputs derived from the test tables.

The tables hold few addresses and no campaign, so the queries derive them:
pages get a fragment of contact markup, events become sends, opens, replies
and purchases.  Each derivation is one plain SQL expression that both Spark
and the SQL checks use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIXES = (".com", ".net", ".org")
CAMPAIGN = "launch"
SELF_EMAIL = "c3.u@site3.example.com"
BASE_URL = "https://track.example.org"
FANOUT, SITES = 9, 3
# A walk in which the cap per level and the length of the queue decide.
PER_LEVEL, CAPPED_PAGES, QUEUE_FACTOR = 5, 40, 3

PHRASES = (
    "I want to buy", "the cost is too much", "can we schedule a zoom", "not interested",
    "more details please", "send the specs", "too expensive for us", "not the right time",
    "let me think about it", "no thanks", "we don't need it", "not me", "wrong person",
    "I am out of office", "I am unavailable", "please unsubscribe", "stop, no more emails",
    "we bought it", "already implemented", "orders", "épass", "hello", "tell me more",
    "next year maybe", "our manager will review", "quote please", "auto-reply: away",
    "we don’t need it",
)


def sql_text(s: str) -> str:
    """A string literal both dialects read alike."""
    return " || chr(39) || ".join(f"'{part}'" for part in s.split("'"))


def phrase_sql(index: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {sql_text(p)}" for i, p in enumerate(PHRASES))
    return f"CASE ({index}) % {len(PHRASES)} {cases} END"


def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


P = _s("page_id")
# Contact markup appended to a page: a meta tag, visible text (with a role
# address and an encoded '@'), a mailto link, a data attribute and a script.
FRAGMENT = " || ".join([
    "'<meta name=\"author\" content=\"write to m'", P, "'.lee@site'", _s("page_id % 5"),
    "'.example.net now\"><p>Reach staff'", _s("page_id % 3"), "'.zed@lab'", _s("page_id % 4"),
    "'.example.org or info'", P, "'@x.example.com; also p'", P,
    "'.x&#64;a.example.com.</p><a href=\"mailto:P'", P,
    "'.x@a.example.com?subject=s\">w <b>q</b></a><span data-email=\" d'", P,
    "'.yo@b.example.net \">data <i>me</i></span><script>var e=\"s'", P,
    "'.kay@c.example.org\",f=\"p'", P, "'.x@a.example.com\";</script>'",
])
MARKED_HTML = f"html || {FRAGMENT}"

# Elements appended to a page that hold others: nested, closed by what holds them, closed
# twice, empty, open to the end of the page.
NESTED_FRAGMENT = " || ".join([
    "'<div data-email=\"n'", P, "'.one@d.example.org\">out <div>in'", P,
    "'<p>deep <b data-email=\"n'", P, "'.two@d.example.org\">b &amp; <i>c</i></p> after</div> rest</i></div> gone'",
    "'<input data-email=\"n'", P, "'.three@d.example.org\">no<ul><li data-email=\"n'", P,
    "'.four@d.example.org\">item<br>two</ul><section data-email=\"n'", P, "'.five@d.example.org\">tail<em>'", P,
])
NESTED_HTML = f"html || {NESTED_FRAGMENT}"

# Bytes in several charsets, told by a header, a tag, a byte order mark or nothing: (header, tag, codec, text, mark).
CHARSET_CASES = (
    ("text/html; charset=windows-1256", "", "cp1256", "مرحبا بكم", b""),
    ("text/html", "<meta charset=\"windows-1252\">", "cp1252", "“café” €5", b""),
    (None, "<meta http-equiv=x content=\"text/html; charset=KOI8-R\">", "koi8_r", "привет", b""),
    (None, "", "utf_8", "été — 日本", b"\xef\xbb\xbf"),
    ("iso-8859-1", "<meta charset=utf-8>", "latin_1", "señor ÿ", b""),
    (None, "", "utf_8", "plain ü", b""),
    (None, "", "latin_1", "plain é", b""),
)

# Links appended to a page: one of each class, on the page's own site.
SITE = "regexp_extract(url, '([a-z0-9-]+[.][a-z]+)(/|$)', 1)"
LINK_FRAGMENT = " || ".join([
    "'<a href=\"/contact\">x</a><a href=\"?page='", _s("page_id % 7 + 2"),
    "'\">more</a><a href=\"/list\">'", _s("page_id % 4"),
    "'</a><a href=\"/ali-ben'", _s("page_id % 11"), "'\">A</a><a href=\"/faculte/'",
    _s("page_id % 3"), "'\">F</a><a href=\"https://lab'", _s("page_id % 5"), "'.'", SITE,
    "'/\">L</a><a href=\"/staffing\">S</a><a href=\"/login\">in</a>'",
    "'<a href=\"mailto:a@b.example.com\">m</a><a href=\"https://other.dz/\">o</a>'",
    "'<a href=\"/zz/../list/\">dup</a><p>see https://dept'", _s("page_id % 6"), "'.'", SITE,
    "'/staff or http://'", SITE, "'/plain </p>'",
])
LINKED_HTML = f"html || {LINK_FRAGMENT}"


def user_email_sql(key: str) -> str:
    return f"'c' || {_s(key)} || '.u@site' || {_s(f'{key} % 25')} || '.example.com'"


K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
LOG_STATUS = f"CASE WHEN {K} < 5 THEN 'Bounced' WHEN {K} < 50 THEN 'Delivered' ELSE 'Sent' END"
REPLY_SUBJECT = f"CASE WHEN {K} % 10 = 9 THEN 'Lunch' ELSE 'Re: Opportunity' END"
REPLY_BODY = phrase_sql(K)


# Known schemas spare each query the jobs that infer them.
_SCHEMAS = {
    "pages": "page_id BIGINT, url STRING, html STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "pages")


def marked_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with contact markup."""
    return pages(spark, sf).withColumn("html", F.expr(MARKED_HTML))


def linked_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with links of every class."""
    return pages(spark, sf).withColumn("html", F.expr(LINKED_HTML))


def tree_url_sql(n: str) -> str:
    """URL of page ``n`` in the tree: three sites, four hosts each, a path of every link class."""
    return (f"'http://h' || {_s(f'{n} % 4')} || '.tree' || {_s(f'{n} % {SITES}')} || '.net/' || CASE ({n}) % 7 "
            f"WHEN 1 THEN 'contact/' WHEN 2 THEN 'list?page=' WHEN 3 THEN 'ali-ben-' WHEN 4 THEN 'faculte/' "
            f"WHEN 5 THEN 'staff/' ELSE 'n/' END || {_s(n)}")


def tree_child_sql(n: str, k: int) -> str:
    """Number of the k-th child of page ``n``; children lie on the site of their parent."""
    return f"((FLOOR(({n}) / {SITES}) * {FANOUT} + {k}) * {SITES} + ({n}) % {SITES})"


TREE_LINKS = " || ".join(
    f"'<a href=\"' || {tree_url_sql('CAST(' + tree_child_sql('page_id', k) + ' AS BIGINT)')} || '\">t</a>'"
    for k in range(1, FANOUT + 1))
TREE_URL = tree_url_sql("page_id")


def tree_pages(spark: SparkSession, sf: str) -> DataFrame:
    """All pages as trees: each page links to FANOUT later pages of its site.

    Every page but the first of its site has one parent, so all are reached.
    """
    return pages(spark, sf).select(
        "page_id", F.expr(TREE_URL).alias("url"), F.expr(f"html || {TREE_LINKS}").alias("html"))


def page_time() -> Column:
    return F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))
                               + F.col("page_id"))


def conversations_as_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Whole conversation turns, each ending with one of the phrases."""
    return read_table(spark, sf, "conversations").select(
        "conv_id", "turn", F.col("role").alias("subject"),
        F.expr(f"text || ' ' || {phrase_sql('conv_id + turn')}").alias("body"))


def _events(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    return read_table(spark, sf, "events").where(F.col("event_type") == kind).withColumn(
        "ts", F.col("ts").cast("timestamp"))


def recipients(spark: SparkSession, sf: str) -> DataFrame:
    nation = read_table(spark, sf, "nation")
    customer = read_table(spark, sf, "customer")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.expr(user_email_sql("c_custkey")).alias("email"), F.col("c_name").alias("name"),
        F.col("n_name").alias("university"), F.col("c_mktsegment").alias("department"),
        F.col("c_custkey").alias("custkey"))


# Mails of two waves; an address can get both.
WAVE = f"CASE WHEN {K} % 2 = 0 THEN '' ELSE '2' END"


def wave_id(email: Column) -> Column:
    return F.sha2(F.concat(F.lit(CAMPAIGN), F.expr(WAVE), F.lit("|"), email), 256)


def send_log(spark: SparkSession, sf: str) -> DataFrame:
    email = F.expr(user_email_sql("user_id"))
    return _events(spark, sf, "signup").select(
        email.alias("email"), F.col("ts").alias("sent_date"), F.expr(LOG_STATUS).alias("status"),
        wave_id(email).alias("tracking_id"),
        (F.floor(F.col("user_id") / 10) + 1).cast("long").alias("batch_number"))


def opens(spark: SparkSession, sf: str) -> DataFrame:
    email = F.expr(user_email_sql("user_id"))
    return _events(spark, sf, "view").select(wave_id(email).alias("tracking_id"), "ts")


def inbox(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf, "click").select(
        F.col("event_id").alias("message_id"),
        F.expr(user_email_sql("user_id")).alias("from_email"),
        F.expr(REPLY_SUBJECT).alias("subject"), F.expr(REPLY_BODY).alias("body"),
        F.col("ts").alias("received_date"))


def bounces(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf, "error").where(F.expr(K) < 5).select(
        F.expr(user_email_sql("user_id")).alias("email"), F.lit("Bounced").alias("status"))


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf, "purchase").select(
        F.expr(user_email_sql("user_id")).alias("email"), F.col("ts").alias("customer_date"))


def unsubscribe_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Requests from views: k = 7 carries an issued token, k = 8 an unknown one."""
    email = F.expr(user_email_sql("user_id"))
    issued = F.sha2(F.concat(F.lit(f"{CAMPAIGN}|unsubscribe|"), email), 256)
    return _events(spark, sf, "view").where(F.expr(K).isin(7, 8)).select(
        F.when(F.expr(K) == 7, issued).otherwise(
            F.concat(F.lit("bad"), F.col("event_id").cast("string"))).alias("token"), "ts")
