"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import PROVIDER_LIMITS, REPLY_RULES
from ..functions import charsets as CH
from ..functions import emails as E
from ..functions import html as H
from ..functions import text as T
from ..functions import urls as U
from ..operators import campaign as CA
from ..operators import contacts as C
from ..operators import frontier as FR
from ..operators import links as L
from ..operators import replies as R
from ..operators import sites as S
from ..operators import tracking as TR
from ..session import scratch_dir
from ..sources import readers as RD
from ..sources import schemas, sinks
from ..streaming import jobs as ST
from . import inputs as I

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
START = datetime(2024, 3, 1, 9, 0, 0)


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    """Times as plain UTC wall clock values."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _long(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


# --- URLs and sites -------------------------------------------------------

@query
def url_normalized(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("url")
    return I.pages(spark, sf).select(
        "page_id", U.normalize_url(u).alias("url_norm"), U.ensure_https(u).alias("url_https"),
        U.strip_www(U.host_of(u)).alias("host"))


REFERENCES = (
    ("&#00000064;", "@"), ("&#64", "@"), ("&#x0000040;b", "@b"), ("&eacute;", "\u00e9"), ("&eacutex", "\u00e9x"),
    ("&amp ", "& "), ("&#146;", "\u2019"), ("&#128;", "\u20ac"), ("&copy1", "\u00a91"), ("&#0;", "\ufffd"),
    ("&#xD800;", "\ufffd"), ("&#1114112;", "\ufffd"), ("&#8;", ""), ("&unknown;", "&unknown;"), ("&NotEqualTilde;", "\u2242\u0338"),
    ("&notit;", "\u00acit;"), ("&", "&"), ("&amp;lt;", "&lt;"), ("&#x1F600;", "\U0001f600"),
)


@query
def decoded_references(spark: SparkSession, sf: str) -> DataFrame:
    """Character references of every form, one per page, between its number and its path."""
    ref = F.get(F.array(*[F.lit(r) for r, _ in REFERENCES]), (F.col("page_id") % len(REFERENCES)).cast("int"))
    text = F.concat(F.col("page_id").cast("string"), F.lit(" a"), ref, F.lit(" "), F.col("page_id").cast("string"))
    return I.pages(spark, sf).select("page_id", H.unescape_html(text).alias("text"))


@query
def base_domain_counts(spark: SparkSession, sf: str) -> DataFrame:
    host = U.host_of(F.col("url"))
    return (
        I.pages(spark, sf)
        .select(U.base_domain(host, I.SUFFIXES).alias("base_domain"), host.alias("host"),
                U.is_subdomain(host, I.SUFFIXES).alias("sub"))
        .groupBy("base_domain", "host").agg(
            F.count(F.lit(1)).alias("n"), F.count_if("sub").alias("n_sub"))
        .groupBy("base_domain").agg(
            F.sum("n").alias("n_pages"), F.count(F.lit(1)).alias("n_hosts"),
            F.sum("n_sub").alias("n_subdomain_pages"))
    )


def _site_seeds(spark: SparkSession, sf: str) -> DataFrame:
    """One seed per site: its smallest URL."""
    site = U.base_domain(U.host_of(F.col("url")), I.SUFFIXES)
    return I.pages(spark, sf).groupBy(site.alias("site")).agg(F.min("url").alias("seed"))


@query
def same_site_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = S.pair_same_site(_site_seeds(spark, sf).select("seed"), I.pages(spark, sf),
                             I.SUFFIXES)
    return pairs.select("seed", "url", "base_domain")


def _all_seeds(spark: SparkSession, sf: str) -> DataFrame:
    """Every third page is a seed, so sites have many."""
    return I.pages(spark, sf).where(F.col("page_id") % 3 == 0).select(F.col("url").alias("seed"))


@query
def same_site_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Sites with how many seeds and pages they have, instead of all pairs of them."""
    out = S.site_groups(_all_seeds(spark, sf), I.pages(spark, sf), I.SUFFIXES)
    return out.select("base_domain", "first_seed", "n_seeds", "n_pages")


@query
def same_site_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Each page once, with its site and the number of its seeds."""
    p = I.pages(spark, sf)
    sites = S.site_groups(_all_seeds(spark, sf), p, I.SUFFIXES)
    return S.pages_of_sites(p, sites, I.SUFFIXES).select("page_id", "base_domain", "n_seeds")


@query
def www_variant_matches(spark: SparkSession, sf: str) -> DataFrame:
    p = I.pages(spark, sf).select("page_id", "url")
    bare = p.select(F.regexp_replace("url", r"//www\.", "//").alias("url"))
    return S.match_www_variants(p, bare)


@query
def path_parts(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("url")
    return I.pages(spark, sf).select(
        "page_id", F.array_join(U.path_segments(u), "|").alias("segments"),
        U.last_segment(u).alias("last_segment"), L.is_teacher_page(u).alias("teacher_page"))


@query
def links_resolved(spark: SparkSession, sf: str) -> DataFrame:
    out = L.resolve_links(I.linked_pages(spark, sf)).drop("page_url")
    return _long(out, "pos")


@query
def crawl_delay_by_site(spark: SparkSession, sf: str) -> DataFrame:
    host = U.host_of(F.col("url"))
    rules = I.pages(spark, sf).groupBy(
        U.base_domain(host, I.SUFFIXES).alias("base_domain")).agg(
            (F.count(F.lit(1)) % 3).cast("double").alias("crawl_delay"))
    out = S.with_crawl_delay(I.pages(spark, sf), rules, suffixes=I.SUFFIXES)
    return out.select("page_id", "base_domain", "crawl_delay")


@query
def subdomain_candidates(spark: SparkSession, sf: str) -> DataFrame:
    seeds = I.pages(spark, sf).select(
        F.concat(F.lit("https://"), U.base_domain(U.host_of(F.col("url")), I.SUFFIXES))
        .alias("seed")).distinct()
    return S.candidate_subdomains(seeds, suffixes=I.SUFFIXES)


@query
def subdomain_links(spark: SparkSession, sf: str) -> DataFrame:
    rooted = _rooted(I.linked_pages(spark, sf))
    return _long(L.subdomain_links(rooted, I.SUFFIXES).drop("page_url"), "seq")


def _rooted(pages: DataFrame) -> DataFrame:
    """Pages moved to the root host of their site."""
    root = U.base_domain(U.host_of(F.col("url")), I.SUFFIXES)
    return pages.withColumn("url", F.concat(
        F.lit("https://"), root, F.lit("/"), F.col("page_id").cast("string")))


@query
def start_set(spark: SparkSession, sf: str) -> DataFrame:
    """Every page is a seed: pages on a subdomain start alone, others with subdomains."""
    p = I.linked_pages(spark, sf)
    both = _rooted(p).unionByName(p)
    return S.start_set(both.select(F.col("url").alias("seed")), both, I.SUFFIXES)


# --- HTML -----------------------------------------------------------------

@query
def page_titles(spark: SparkSession, sf: str) -> DataFrame:
    return I.pages(spark, sf).select("page_id", H.page_title(F.col("html")).alias("title"))


@query
def visible_text_length(spark: SparkSession, sf: str) -> DataFrame:
    text = H.visible_text(F.col("html"))
    return I.marked_pages(spark, sf).select("page_id", text.alias("text")).select(
        "page_id", F.length("text").cast("long").alias("n_chars"),
        F.md5("text").alias("text_md5"))


@query
def blocked_pages(spark: SparkSession, sf: str) -> DataFrame:
    notice = F.when(F.col("page_id") % 5 == 0, "<p>Access <b>Denied</b></p>").when(
        F.col("page_id") % 5 == 1, "<p>access denied</p>").otherwise("")
    p = I.pages(spark, sf).withColumn("html", F.concat("html", notice))
    html = F.col("html")
    return p.select("page_id", H.is_blocked(
        H.page_title(html), H.visible_text(html)).alias("is_blocked"))


@query
def decoded_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes back to text: even pages as UTF-8, odd ones as Latin-1."""
    latin = F.regexp_replace("html", r"[^\x00-\xff]", "?")
    odd = F.col("page_id") % 2 == 1
    raw = F.when(odd, F.encode(latin, "ISO-8859-1")).otherwise(F.encode("html", "UTF-8"))
    return I.pages(spark, sf).select("page_id", CH.undeclared(raw).alias("text")).select(
        "page_id", F.md5("text").alias("text_md5"))


@query
def declared_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Page URLs and words in seven charsets, told by header, tag, byte order mark or nothing."""
    kind = (F.col("page_id") % len(I.CHARSET_CASES)).cast("int")

    def of(values: list[Column]) -> Column:
        return F.get(F.array(*values), kind)

    front = of([F.unhex(F.lit((mark + tag.encode()).hex())) for _, tag, _, _, mark in I.CHARSET_CASES])
    words = of([F.unhex(F.lit(text.encode(codec).hex())) for _, _, codec, text, _ in I.CHARSET_CASES])
    header = of([F.lit(h).cast("string") for h, *_ in I.CHARSET_CASES])
    raw = I.pages(spark, sf).select("page_id", F.concat(front, F.encode("url", "UTF-8"), words).alias("content"), header.alias("header"))
    return raw.select("page_id", CH.decode_page(F.col("content"), F.col("header")).alias("text"))


@query
def page_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    p = I.marked_pages(spark, sf).withColumn("html", F.when(
        F.col("page_id") % 3 == 0, F.col("html")).otherwise(
            F.regexp_replace("html", r"(?s)<meta name=.author.*\z", "<p>a@b .com</p>")))
    return _long(C.page_diagnostics(p, I.SUFFIXES).drop("url"), "html_length", "n_emails",
                 "at_count", "suffix_count")


# --- Contacts -------------------------------------------------------------

def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return I.read_table(spark, sf, "documents").select(
        "doc_id", "text", F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("url"))


@query
def contacts_text(spark: SparkSession, sf: str) -> DataFrame:
    out = C.extract_contacts_from_text(
        _documents(spark, sf), suffixes=I.SUFFIXES, exclude=None, keep=["doc_id"],
        found_at=F.lit(None).cast("timestamp"))
    return out.select("doc_id", F.col("rank").cast("long").alias("pos"), "email", "local_part",
                      "domain")


@query
def contact_snippets(spark: SparkSession, sf: str) -> DataFrame:
    out = C.extract_contacts_from_text(
        _documents(spark, sf), suffixes=I.SUFFIXES, keep=["doc_id"],
        found_at=F.lit(None).cast("timestamp"))
    return out.select("doc_id", F.col("rank").cast("long").alias("pos"), "email",
                      "context_snippet")


def _per_method(spark: SparkSession, sf: str,
                find: Callable[[Column, tuple[str, ...]], Column]) -> DataFrame:
    hits = I.marked_pages(spark, sf).select(
        "page_id", F.explode_outer(find(F.col("html"), I.SUFFIXES)).alias("h")
    ).where(F.col("h").isNotNull())
    return hits.select("page_id", F.col("h.pos").cast("long").alias("pos"), "h.email",
                       "h.snippet")


@query
def contacts_mailto(spark: SparkSession, sf: str) -> DataFrame:
    return _per_method(spark, sf, C.emails_mailto)


@query
def contacts_data_attr(spark: SparkSession, sf: str) -> DataFrame:
    return _per_method(spark, sf, C.emails_data_attr)


@query
def contacts_nested_attr(spark: SparkSession, sf: str) -> DataFrame:
    """Elements with an address that hold other elements, in well and badly closed markup."""
    p = I.pages(spark, sf).withColumn("html", F.expr(I.NESTED_HTML))
    hits = p.select("page_id", F.explode(C.emails_data_attr(F.col("html"), I.SUFFIXES)).alias("h"))
    return hits.select("page_id", F.col("h.pos").cast("long").alias("pos"), "h.email", "h.snippet")


@query
def contacts_meta(spark: SparkSession, sf: str) -> DataFrame:
    return _per_method(spark, sf, C.emails_meta)


@query
def contacts_script(spark: SparkSession, sf: str) -> DataFrame:
    return _per_method(spark, sf, C.emails_script)


def _page_contacts(spark: SparkSession, sf: str) -> DataFrame:
    return C.extract_contacts(I.marked_pages(spark, sf), I.SUFFIXES, found_at=I.page_time(),
                              keep=["page_id"])


@query
def contacts_extracted(spark: SparkSession, sf: str) -> DataFrame:
    out = _page_contacts(spark, sf).select(
        "page_id", "email", "local_part", "domain", "source_url", "source_type", "page_title",
        "context_snippet", "http_status", "found_at", "parse_method", "notes")
    return _ntz(out, "found_at")


def _occurrences(spark: SparkSession, sf: str) -> DataFrame:
    """Contacts of pages and documents with one order over both."""
    order = lambda kind, key: F.struct(
        F.lit(kind).alias("kind"), F.col(key).alias("id"), F.col("rank").alias("rank"))
    p = _page_contacts(spark, sf).withColumn("seq", order(0, "page_id")).drop("page_id", "rank")
    d = C.extract_contacts_from_text(
        _documents(spark, sf), suffixes=I.SUFFIXES, keep=["doc_id"],
        found_at=F.timestamp_seconds(F.unix_timestamp(
            F.lit("2027-01-15 08:00:00").cast("timestamp")) - F.col("doc_id")))
    d = d.withColumn("seq", order(1, "doc_id")).drop("doc_id", "rank")
    return p.unionByName(d)


@query
def contacts_consolidated(spark: SparkSession, sf: str) -> DataFrame:
    out = C.consolidate_contacts(_occurrences(spark, sf))
    return _ntz(sinks.clean_as_text(out), "first_seen")


@query
def contact_sources(spark: SparkSession, sf: str) -> DataFrame:
    out = C.contact_sources(_occurrences(spark, sf)).select(
        "email", "source_url", F.col("first_seq.kind").cast("long").alias("kind"),
        F.col("first_seq.id").alias("first_page"),
        "first_found_at", "n_occurrences")
    return _ntz(out, "first_found_at")


@query
def exploded_sources(spark: SparkSession, sf: str) -> DataFrame:
    """The sources text split again, counted per URL."""
    clean = sinks.clean_as_text(C.consolidate_contacts(_occurrences(spark, sf)))
    return C.explode_sources(clean).groupBy("source_url").agg(
        F.count(F.lit(1)).alias("n_contacts"))


def _odd_addresses(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses of many shapes, from customer and nation names."""
    key = F.col("c_custkey").cast("string")
    n = F.col("c_custkey") % 8
    local = (
        F.when(n == 0, F.substring(F.col("c_mktsegment"), 1, 2))
        .when(n == 1, F.substring(F.col("c_mktsegment"), 1, 3))
        .when(n == 2, F.concat(F.lit("chef."), key))
        .when(n == 3, F.concat(F.col("c_mktsegment"), F.lit(".info"), key))
        .when(n == 4, F.concat(F.lit("a.b"), F.substring(key, -1, 1)))
        .when(n == 5, F.substring(F.col("c_mktsegment"), 1, 4))
        .when(n == 6, F.lit(""))
        .otherwise(F.concat(F.lit("vr."), F.col("c_mktsegment")))
    )
    at = F.when(F.col("c_custkey") % 13 == 0, "").otherwise("@")
    return I.read_table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit(" "), local, at, F.lit("u.example.org ")).alias("email"))


@query
def institutional_strict(spark: SparkSession, sf: str) -> DataFrame:
    e = E.normalize_email(F.col("email"))
    return _odd_addresses(spark, sf).select(
        "c_custkey", e.alias("email"), E.is_valid_email(e).alias("valid"),
        E.is_institutional(e).alias("institutional"))


@query
def institutional_loose(spark: SparkSession, sf: str) -> DataFrame:
    e = E.normalize_email(F.col("email"))
    return _odd_addresses(spark, sf).select(
        "c_custkey", e.alias("email"), E.is_institutional(e, strict=False).alias("institutional"))


@query
def clean_counts(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_counts(_odd_addresses(spark, sf))


@query
def recleaned_contacts(spark: SparkSession, sf: str) -> DataFrame:
    return C.reclean(_odd_addresses(spark, sf))


# --- Links ----------------------------------------------------------------

def _links(spark: SparkSession, sf: str) -> DataFrame:
    return L.extract_links(I.linked_pages(spark, sf), I.SUFFIXES)


@query
def links_extracted(spark: SparkSession, sf: str) -> DataFrame:
    out = _links(spark, sf).where(F.col("source") == "anchor")
    return _long(out.select("page_id", "seq", "url", "href", "text"), "seq")


@query
def text_links(spark: SparkSession, sf: str) -> DataFrame:
    out = _links(spark, sf).where(F.col("source") == "text")
    return _long(out.select("page_id", "seq", "url"), "seq")


@query
def link_class_counts(spark: SparkSession, sf: str) -> DataFrame:
    return L.classify_links(_links(spark, sf)).groupBy("link_class", "source").agg(
        F.count(F.lit(1)).alias("n_links"))


@query
def frontier_class_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Classes by URL alone and against the seed of the site, as the crawl step sees them."""
    site = U.base_domain(U.host_of(F.col("page_url")), I.SUFFIXES)
    seeds = _site_seeds(spark, sf).select("site", U.normalize_url(F.col("seed")).alias("seed"))
    linked = _links(spark, sf).withColumn("site", site).join(seeds, "site")
    return linked.groupBy(L.walk_class(F.col("url"), F.col("seed")).alias("link_class")).agg(
        F.count(F.lit(1)).alias("n_links"))


@query
def links_ranked_topk(spark: SparkSession, sf: str) -> DataFrame:
    out = L.ranked_links(I.linked_pages(spark, sf), I.SUFFIXES, limit=8)
    return _long(out.select("page_id", "link_rank", "url", "link_class"), "link_rank")


@query
def frontier_levels(spark: SparkSession, sf: str) -> DataFrame:
    return _long(_frontier(spark, sf), "level")


@query
def frontier_budgeted(spark: SparkSession, sf: str) -> DataFrame:
    """The walk with a page budget, which is its feature here: the best twelve pages of each seed."""
    return _long(_frontier(spark, sf, max_pages=12), "level")


@query
def frontier_capped(spark: SparkSession, sf: str) -> DataFrame:
    """The walk with few links per level, which ends a seed when too many wait; both limits are its feature."""
    return _long(_frontier(spark, sf, max_pages=I.CAPPED_PAGES, per_level=I.PER_LEVEL, queue_factor=I.QUEUE_FACTOR), "level")


def _frontier(spark: SparkSession, sf: str, **limits) -> DataFrame:
    tree = I.tree_pages(spark, sf)
    starts = tree.where(F.col("page_id") < I.SITES).select(
        U.normalize_url(F.col("url")).alias("seed")).withColumn("url", F.col("seed"))
    captured = tree.where(~U.is_skipped(F.col("url"))).select(
        U.normalize_url(F.col("url")).alias("url"))
    edges = L.link_edges(tree, I.SUFFIXES)
    return FR.expand_frontier(starts, captured, edges, **limits)


@query
def seed_page_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Pages reached and address occurrences found per seed."""
    reached = _frontier(spark, sf)
    marked = I.marked_pages(spark, sf).withColumn("url", F.expr(I.TREE_URL))
    per_page = C.extract_contacts(
        marked, I.SUFFIXES, found_at=I.page_time()
    ).groupBy(U.normalize_url(F.col("source_url")).alias("url")).agg(
        F.count(F.lit(1)).alias("n"))
    return reached.join(per_page, "url", "left").groupBy("seed").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_occurrences"))


@query
def distinct_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Seeds and found links, each once."""
    seeds = I.pages(spark, sf).select(U.normalize_url(F.col("url")).alias("url"))
    return seeds.unionByName(_links(spark, sf).select("url")).distinct()


@query
def unvisited_links(spark: SparkSession, sf: str) -> DataFrame:
    """Found links that are not captured yet."""
    pages = I.tree_pages(spark, sf)
    captured = pages.select(U.normalize_url(F.col("url")).alias("url"))
    tree = L.extract_links(pages, I.SUFFIXES).select("url").distinct()
    return tree.join(captured, "url", "left_anti")


# --- Replies --------------------------------------------------------------

@query
def reply_classes(spark: SparkSession, sf: str) -> DataFrame:
    out = R.classify_replies(I.conversations_as_messages(spark, sf))
    return out.select("conv_id", "turn", "classification",
                      R.class_slug(F.col("classification")).alias("slug"))


@query
def reply_class_counts(spark: SparkSession, sf: str) -> DataFrame:
    return R.class_counts(R.classify_replies(I.conversations_as_messages(spark, sf)))


@query
def reply_matches(spark: SparkSession, sf: str) -> DataFrame:
    out = R.matched_classes(I.conversations_as_messages(spark, sf))
    return out.select("conv_id", "turn", F.array_join(F.transform(
        "matches", lambda m: F.concat(m["classification"], F.lit("="), m["keyword"])), ";")
        .alias("matches"))


@query
def reply_classes_custom(spark: SparkSession, sf: str) -> DataFrame:
    """Keywords from a table, with reversed priority, and delivery status first."""
    rows = [(len(REPLY_RULES) - i, name, word)
            for i, (name, words) in enumerate(REPLY_RULES) for word in words]
    rules = spark.createDataFrame(rows, "priority INT, classification STRING, keyword STRING")
    msgs = I.conversations_as_messages(spark, sf).withColumn(
        "status", F.when(F.col("conv_id") % 10 == 0, "Bounced").otherwise("Sent"))
    out = R.classify_with_table(msgs, rules, status="status")
    return out.select("conv_id", "turn", "classification")


def _selected(spark: SparkSession, sf: str) -> DataFrame:
    return R.select_replies(I.inbox(spark, sf), I.recipients(spark, sf), ["opportunity"],
                            I.SELF_EMAIL)


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    return R.classify_replies(_selected(spark, sf))


@query
def campaign_replies(spark: SparkSession, sf: str) -> DataFrame:
    out = R.enrich_replies(_classified(spark, sf), I.recipients(spark, sf))
    return _ntz(out.select("message_id", "email", "name", "university", "subject", "body",
                           "received_date", "classification"), "received_date")


@query
def follow_up_actions(spark: SparkSession, sf: str) -> DataFrame:
    return R.follow_up_actions(_classified(spark, sf)).select(
        "message_id", "classification", "action", "suppress")


def _valid_unsubscribes(spark: SparkSession, sf: str) -> DataFrame:
    tokens = CA.issued_tokens(I.recipients(spark, sf), I.CAMPAIGN)
    return R.validate_unsubscribes(I.unsubscribe_requests(spark, sf), tokens)


@query
def valid_unsubscribes(spark: SparkSession, sf: str) -> DataFrame:
    return _ntz(_valid_unsubscribes(spark, sf), "ts")


@query
def rejected_unsubscribes(spark: SparkSession, sf: str) -> DataFrame:
    tokens = CA.issued_tokens(I.recipients(spark, sf), I.CAMPAIGN)
    return _ntz(R.rejected_unsubscribes(I.unsubscribe_requests(spark, sf), tokens), "ts")


def _suppressions(spark: SparkSession, sf: str) -> DataFrame:
    return R.suppression_list(_classified(spark, sf), I.bounces(spark, sf),
                              _valid_unsubscribes(spark, sf))


@query
def suppression_list(spark: SparkSession, sf: str) -> DataFrame:
    return _suppressions(spark, sf)


@query
def suppressed_recipients(spark: SparkSession, sf: str) -> DataFrame:
    """Who may still be mailed."""
    return R.suppress(I.recipients(spark, sf), _suppressions(spark, sf)).select(
        "custkey", "email", "name", "university")


# --- Sends ----------------------------------------------------------------

@query
def send_batches(spark: SparkSession, sf: str) -> DataFrame:
    planned = CA.plan_sends(I.recipients(spark, sf), START, order=["custkey"])
    return planned.groupBy("batch_number").agg(
        F.count(F.lit(1)).alias("n_mails"), F.min("custkey").alias("first_key"),
        F.max("custkey").alias("last_key"),
        F.min("planned_at").cast("timestamp_ntz").alias("planned_at"))


@query
def send_plan(spark: SparkSession, sf: str) -> DataFrame:
    allowed = R.suppress(I.recipients(spark, sf), _suppressions(spark, sf))
    planned = CA.plan_sends(allowed, START, order=["custkey"], batch_size=7, wait_seconds=45)
    return _ntz(planned.select("email", "batch_number", "planned_at"), "planned_at")


@query
def quota_plan(spark: SparkSession, sf: str) -> DataFrame:
    """One plan per known provider, and one with a sending window that binds."""
    to = I.recipients(spark, sf)
    plans = [(name, dict(zip(("daily_cap", "monthly_cap", "per_second"), caps)))
             for name, *caps in PROVIDER_LIMITS] + [("window", {"window_seconds": 300, "wait_seconds": 60})]
    out = [CA.plan_sends(to, START, order=["custkey"], **limits).select(
        F.lit(name).alias("plan"), "custkey", "planned_day", "planned_at") for name, limits in plans]
    return _ntz(reduce(DataFrame.unionByName, out), "planned_at")


@query
def quota_day_ends(spark: SparkSession, sf: str) -> DataFrame:
    """Per plan the number of days whose last mail is not before the next day's first: none."""
    days = quota_plan(spark, sf).groupBy("plan", "planned_day").agg(
        F.min("planned_at").alias("first"), F.max("planned_at").alias("last"))
    after = days.select("plan", (F.col("planned_day") - 1).alias("planned_day"), F.col("first").alias("next"))
    return days.join(after, ["plan", "planned_day"], "left").groupBy("plan").agg(
        F.count_if(F.col("last") >= F.col("next")).alias("n_overlaps"), F.count(F.lit(1)).alias("n_days"))


@query
def personal_mails(spark: SparkSession, sf: str) -> DataFrame:
    mails = CA.build_mails(
        I.recipients(spark, sf), I.CAMPAIGN, "Opportunity for {{university}} Teachers",
        "<p>Dear {{ $json.name }}, {{unknown}}</p>", I.BASE_URL)
    return mails.select("custkey", "tracking_id", "unsubscribe_token", "subject", "body_html")


@query
def pilot_sample(spark: SparkSession, sf: str) -> DataFrame:
    return CA.pilot_sample(I.recipients(spark, sf), 50).select("custkey", "email")


@query
def failed_sends(spark: SparkSession, sf: str) -> DataFrame:
    _, failed = CA.split_send_results(I.send_log(spark, sf))
    return _ntz(failed.select("email", "sent_date", "status"), "sent_date")


@query
def send_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return TR.status_counts(I.send_log(spark, sf))


@query
def send_summary(spark: SparkSession, sf: str) -> DataFrame:
    return TR.send_summary(I.send_log(spark, sf))


# --- Tracking -------------------------------------------------------------

@query
def open_fold(spark: SparkSession, sf: str) -> DataFrame:
    return _ntz(TR.fold_opens(I.opens(spark, sf)), "opened_date")


@query
def reply_fold(spark: SparkSession, sf: str) -> DataFrame:
    out = TR.fold_replies(_classified(spark, sf))
    return _ntz(out, "reply_date", "first_reply_date", "demo_date", "customer_date")


@query
def status_fold(spark: SparkSession, sf: str) -> DataFrame:
    return TR.fold_status(I.send_log(spark, sf).select("email", "status").unionByName(
        I.bounces(spark, sf)))


def _master(spark: SparkSession, sf: str) -> DataFrame:
    return TR.build_master(
        I.send_log(spark, sf), I.opens(spark, sf), _classified(spark, sf),
        status=I.bounces(spark, sf), recipients=I.recipients(spark, sf),
        customers=I.purchases(spark, sf))


@query
def master_tracking(spark: SparkSession, sf: str) -> DataFrame:
    return _ntz(TR.master_as_text(_master(spark, sf)), "sent_date", "opened_date", "reply_date",
                "demo_date", "customer_date")


@query
def master_updated(spark: SparkSession, sf: str) -> DataFrame:
    """Master of the first half of January, then updated by the later replies."""
    replies = _classified(spark, sf)
    cut = F.lit("2024-01-16").cast("timestamp")
    old = TR.build_master(I.send_log(spark, sf), I.opens(spark, sf),
                          replies.where(F.col("received_date") < cut))
    out = TR.update_master(old, replies.where(F.col("received_date") >= cut))
    return _ntz(out.select("email", "replied", "reply_date", "classification", "status",
                           "demo_scheduled", "demo_date", "customer", "customer_date"),
                "reply_date", "demo_date", "customer_date")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.round("value", 6))


@query
def funnel_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(TR.funnel_metrics(_master(spark, sf)))


@query
def funnel_metrics_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(TR.funnel_metrics(_master(spark, sf), by=["university"]))


# --- Sources and sinks ----------------------------------------------------

@query
def seed_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Seed lines made from page URLs, with comments and blank lines between."""
    lines = I.pages(spark, sf).select(F.explode(F.array(
        F.concat(F.lit("  "), F.col("url"), F.lit("\t")),
        F.concat(F.lit(" # "), F.col("url")), F.lit("  "))).alias("value"))
    return RD.seed_lines(lines)


@query
def csv_safe_values(spark: SparkSession, sf: str) -> DataFrame:
    lead = F.element_at(F.array(*[F.lit(x) for x in ("=", "+", "-", "@", "", "'")]),
                        (F.col("page_id") % 6 + 1).cast("int"))
    title = F.concat(lead, H.page_title(F.col("html")))
    return I.pages(spark, sf).select("page_id", T.csv_safe(title).alias("title"))


def _fresh(spark: SparkSession, name: str) -> str:
    return scratch_dir(spark, name)


@query
def recipients_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A recipient list with line breaks and quotes in its values, written and read back."""
    path = _fresh(spark, "recipients")
    note = F.concat(F.lit('a "b"\nc\\n, '), F.col("custkey").cast("string"), F.lit("\r\n"))
    sinks.write_recipients(I.recipients(spark, sf).drop("department").withColumn("note", note), path)
    return RD.read_recipients(spark, path).select(
        "email", "name", "university", "department", F.col("custkey").cast("long").alias("custkey"),
        F.md5("note").alias("note_md5"))


@query
def send_log_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The send log appended in two steps and read back."""
    path = _fresh(spark, "log")
    log = I.send_log(spark, sf)
    for wave in (log.where("batch_number % 2 = 0"), log.where("batch_number % 2 = 1")):
        sinks.write_send_log(wave, path)
    return _ntz(RD.read_send_log(spark, path), "sent_date")


@query
def clean_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The clean contact file, filtered into a second one, with what that counted."""
    path, out = _fresh(spark, "clean"), _fresh(spark, "recleaned")
    occ = _odd_addresses(spark, sf).select(
        "email", F.concat(F.lit("c:"), (F.col("c_custkey") % 50).cast("string")).alias("source_url"),
        F.lit("").alias("domain"), F.col("c_custkey").alias("seq"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("c_custkey")).alias("found_at"))
    sinks.write_clean_contacts(C.consolidate_contacts(occ, exclude=None), path)
    seen = sinks.reclean_file(spark, path, out)
    back = RD.read_clean_contacts(spark, out)
    return _ntz(back, "first_seen").select(
        "email", "domain", "first_seen", "sources", "verified", "status", F.coalesce("notes", F.lit("")).alias("notes"),
        "part", F.lit(seen["removed"]).cast("long").alias("n_removed"),
        F.lit(seen["remaining"]).cast("long").alias("n_remaining"))


@query
def metrics_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The metrics summary through its file."""
    path = _fresh(spark, "metrics")
    sinks.write_metrics(funnel_metrics(spark, sf), path)
    return RD.read_csv(spark, path, "metric STRING, value DOUBLE")


@query
def routed_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Replies written as one folder per class and read back."""
    path = _fresh(spark, "routed")
    sinks.route_by_class(R.enrich_replies(_classified(spark, sf), I.recipients(spark, sf)), path)
    return RD.read_routed(spark, path).groupBy("class_slug", "classification").agg(
        F.count(F.lit(1)).alias("n_replies"),
        F.countDistinct("email").alias("n_senders"))


@query
def contacts_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Occurrences through the CSV files and consolidated from there."""
    path = _fresh(spark, "contacts")
    sinks.write_contacts(_page_contacts(spark, sf), path)
    back = RD.read_contacts(spark, path).withColumn(
        "seq", F.col("found_at"))
    return C.contact_sources(back).groupBy("email").agg(
        F.count(F.lit(1)).alias("n_sources"), F.sum("n_occurrences").alias("n_occurrences"))


@query
def master_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of the master files; the newest one is read."""
    path = _fresh(spark, "master")
    master = _master(spark, sf)
    sinks.write_master(master.where(~F.col("opened")), path, 1)
    sinks.write_master(master, path, 2)
    return RD.read_master(spark, path).groupBy("status", "opened", "replied", "customer").agg(
        F.count(F.lit(1)).alias("n"))


# --- Streams --------------------------------------------------------------

def _event_stream(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    schema = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING")
    return RD.stream_files(spark, sf, schema, name_glob="events.parquet").where(
        F.col("event_type") == kind).withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_open_fold(spark: SparkSession, sf: str) -> DataFrame:
    base = _fresh(spark, "opens")
    email = F.expr(I.user_email_sql("user_id"))
    source = _event_stream(spark, sf, "view").select(
        I.wave_id(email).alias("tracking_id"), "ts")
    ST.stream_opens(source, f"{base}/parts", f"{base}/checkpoint").awaitTermination()
    return _ntz(ST.read_opens(spark, f"{base}/parts"), "opened_date")


def _inbox_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _event_stream(spark, sf, "click").select(
        F.col("event_id").alias("message_id"),
        F.expr(I.user_email_sql("user_id")).alias("from_email"),
        F.expr(I.REPLY_SUBJECT).alias("subject"), F.expr(I.REPLY_BODY).alias("body"),
        F.col("ts").alias("received_date"))


@query
def stream_reply_counts(spark: SparkSession, sf: str) -> DataFrame:
    base = _fresh(spark, "classes")
    ST.stream_class_counts(_inbox_stream(spark, sf), f"{base}/counts",
                           f"{base}/checkpoint").awaitTermination()
    return ST.read_class_counts(spark, f"{base}/counts")


@query
def stream_reply_fold(spark: SparkSession, sf: str) -> DataFrame:
    base = _fresh(spark, "replies")
    ST.stream_replies(_inbox_stream(spark, sf), I.recipients(spark, sf), ["opportunity"],
                      I.SELF_EMAIL, f"{base}/routed", f"{base}/folds", f"{base}/checkpoint",
                      every=None).awaitTermination()
    out = ST.read_reply_folds(spark, f"{base}/folds")
    return _ntz(out, "reply_date", "first_reply_date", "demo_date", "customer_date")


@query
def stream_routed(spark: SparkSession, sf: str) -> DataFrame:
    """Replies per class folder, read from what a stream has routed."""
    base = _fresh(spark, "routed-stream")
    ST.stream_replies(_inbox_stream(spark, sf), I.recipients(spark, sf), ["opportunity"],
                      I.SELF_EMAIL, f"{base}/routed", f"{base}/folds", f"{base}/checkpoint",
                      every=None).awaitTermination()
    return ST.read_routed_parts(spark, f"{base}/routed").groupBy("class_slug", "classification").agg(
        F.count(F.lit(1)).alias("n_replies"))


@query
def stream_master(spark: SparkSession, sf: str) -> DataFrame:
    """The tracking table from what an open stream and a reply stream have stored."""
    base = _fresh(spark, "live")
    email = F.expr(I.user_email_sql("user_id"))
    opened = _event_stream(spark, sf, "view").select(
        I.wave_id(email).alias("tracking_id"), "ts")
    running = [
        ST.stream_opens(opened, f"{base}/opens", f"{base}/cp-opens"),
        ST.stream_replies(_inbox_stream(spark, sf), I.recipients(spark, sf), ["opportunity"],
                          I.SELF_EMAIL, f"{base}/routed", f"{base}/folds", f"{base}/cp-replies",
                          every=None)]
    for q in running:
        q.awaitTermination()
    out = ST.current_master(spark, I.send_log(spark, sf), f"{base}/opens", f"{base}/folds")
    return _ntz(out.select("email", "sent_date", "opened", "opened_date", "opened_count", "replied",
                           "reply_date", "classification", "status", "tracking_id"),
                "sent_date", "opened_date", "reply_date")


BATCHES = 3


def _arriving(spark: SparkSession, df: DataFrame, batch: Column, name: str,
              run: Callable[[DataFrame], StreamingQuery]) -> None:
    """The rows come in three times, by ``batch`` from 0; each time the stream starts again and takes what is new."""
    folder = _fresh(spark, name)
    for i in range(BATCHES):
        df.where(batch == i).write.mode("append").parquet(folder)
        run(RD.stream_files(spark, folder, df.schema)).awaitTermination()


@query
def stream_unsubscribes(spark: SparkSession, sf: str) -> DataFrame:
    """Requests in three micro-batches, each two months older than the one before."""
    base = _fresh(spark, "unsubscribes")
    email = F.expr(I.user_email_sql("user_id"))
    issued = F.sha2(F.concat(F.lit(f"{I.CAMPAIGN}|unsubscribe|"), email), 256)
    k, turn = F.expr(I.K), F.col("event_id") % BATCHES
    views = I.read_table(spark, sf, "events").where((F.col("event_type") == "view") & k.isin(7, 8))
    requests = views.select(
        F.when(k == 7, issued).otherwise(F.concat(F.lit("bad"), F.col("event_id").cast("string"))).alias("token"),
        F.timestamp_seconds(F.unix_timestamp(F.col("ts").cast("timestamp")) - turn * 5_184_000).alias("ts"),
        turn.alias("turn"))
    tokens = CA.issued_tokens(I.recipients(spark, sf), I.CAMPAIGN)
    _arriving(spark, requests, F.col("turn"), "requests", lambda source: ST.stream_unsubscribes(
        source, tokens, f"{base}/parts", f"{base}/checkpoint"))
    return _ntz(ST.read_unsubscribes(spark, f"{base}/parts").select("token", "email", "ts"), "ts")


def _twice(spark: SparkSession, sf: str, html: bool) -> DataFrame:
    """Each page in one batch and again, with a slash behind its path, in a later one."""
    p = I.pages(spark, sf)
    if html:
        p = p.withColumn("html", F.expr(I.MARKED_HTML))
    path = F.regexp_extract("url", "^[^?#]*", 0)
    again = p.withColumn("url", F.concat(path, F.lit("/"), F.substr("url", F.length(path) + 1)))
    out = p.withColumn("turn", F.col("page_id") % 2).unionByName(
        again.withColumn("turn", F.col("page_id") % 2 + 1))
    return out if html else out.drop("html")


@query
def stream_unique_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Each page arrives in two micro-batches under two spellings of its URL; one per URL is kept."""
    base = _fresh(spark, "pages")
    _arriving(spark, _twice(spark, sf, False), F.col("turn"), "page-stream", lambda source: ST.stream_unique_pages(
        source, f"{base}/parts", f"{base}/checkpoint"))
    return ST.read_unique_pages(spark, f"{base}/parts", "page_id BIGINT, url_norm STRING")


@query
def stream_contacts(spark: SparkSession, sf: str) -> DataFrame:
    """Contacts of pages that arrive twice, in three micro-batches."""
    base = _fresh(spark, "contacts")
    _arriving(spark, _twice(spark, sf, True), F.col("turn"), "contact-stream", lambda source: ST.stream_contacts(
        source, f"{base}/parts", f"{base}/checkpoint", I.SUFFIXES))
    return ST.read_contact_parts(spark, f"{base}/parts").select(
        "email", "source_url", "parse_method", "context_snippet")
