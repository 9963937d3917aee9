"""Links of captured pages: extraction, classes and ranking."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    DEFAULT_SUFFIXES, FACULTY_KEYWORDS, FRONTIER_FACULTY_KEYWORDS, FRONTIER_PRIORITY_KEYWORDS,
    PAGINATION_TEXTS, PERSON_LINK_EXCLUDES, PERSON_PAGE_EXCLUDES, PRIORITY_KEYWORDS,
    STAFF_KEYWORDS,
)
from ..functions import html as H
from ..functions import urls as U
from ..functions.text import WS, built_once, contains_any, let, regex_quote

# Output order of the classes; pagination and priority links share a place.
CLASS_RANK = {
    "contact": 0, "pagination": 1, "priority": 2, "teacher": 3, "faculty": 4, "subdomain": 5,
    "regular": 6,
}


@dataclass(frozen=True)
class LinkRules:
    """Keyword lists of the link classes."""

    faculty: Sequence[str] = FACULTY_KEYWORDS
    priority: Sequence[str] = STAFF_KEYWORDS
    text_priority: Sequence[str] = PRIORITY_KEYWORDS
    pagination_texts: Sequence[str] = PAGINATION_TEXTS
    use_text: bool = True


# Rules of the crawl step, which sees only the URL.
FRONTIER_RULES = LinkRules(
    faculty=FRONTIER_FACULTY_KEYWORDS, priority=FRONTIER_PRIORITY_KEYWORDS,
    text_priority=FRONTIER_PRIORITY_KEYWORDS, use_text=False)


def is_teacher_page(u: Column) -> Column:
    """True for personal pages: hyphenated last segment, no other page kind in the path."""
    path = U.path_of(u)
    return F.contains(U.last_segment(u), F.lit("-")) & ~contains_any(
        F.lower(path), PERSON_PAGE_EXCLUDES)


def _resolved(anchor_list: Column, page_url: Column, suffixes: Iterable[str]) -> Column:
    """Anchors with their canonical URL; login and non-web links dropped."""

    def each(a: Column, base: Column) -> Column:
        def build(full: Column) -> Column:
            return let(U.url_parts(full), lambda p: F.struct(
                U.normalize_parts(full, p).alias("url"), a["pos"].alias("pos"),
                a["href"].alias("href"), F.lower(a["text"]).alias("text"),
                U.same_site_parts(base, p, suffixes).alias("same_site"),
                p["scheme"].isin("http", "https", "").alias("web")))

        return let(U.resolve_parts(page_url, base, a["href"]), build)

    kept = F.filter(anchor_list, lambda a: ~U.is_skipped(a["href"]))
    found = let(U.url_parts(page_url), lambda b: F.transform(kept, lambda a: each(a, b)))
    return F.filter(found, lambda x: x["web"])


def _first_per_url(found: Column) -> Column:
    """First link per canonical URL, in page order; sorts inside the row."""
    firsts = let(F.array_sort(found), lambda a: F.filter(a, lambda x, i: (i == 0) | (
        x["url"] != F.get(a, i - 1)["url"])))
    return F.array_sort(F.transform(firsts, lambda x: F.struct(
        x["pos"].alias("pos"), x["url"].alias("url"), x["href"].alias("href"),
        x["text"].alias("text"), x["same_site"].alias("same_site"))))


def _text_urls(html: Column, suffixes: Iterable[str]) -> Column:
    """Distinct canonical URLs written out in the page text, in order."""
    stop = rf"""[^{WS}<>"']"""
    ends = "|".join(regex_quote(s.lstrip(".")) for s in suffixes)
    # A run is taken whole and tested once: its first start decides.
    runs = F.regexp_extract_all(H.plain_text(html), F.lit(rf"(?i)https?://{stop}++"), F.lit(0))
    found = F.filter(runs, lambda r: r.rlike(rf"(?is)^https?://.+\.(?:{ends})"))
    return F.when(
        F.contains(html, F.lit("://")),
        F.array_distinct(F.transform(found, U.normalize_url)),
    ).otherwise(F.array().cast("array<string>"))


def page_links(html: Column, page_url: Column, suffixes: Iterable[str]) -> Column:
    """array<struct(source, url, href, text)>: same-site anchors, then text URLs."""
    suffixes = tuple(suffixes)

    def build(anchored: Column) -> Column:
        seen = F.transform(anchored, lambda x: x["url"])
        written = F.filter(F.array_except(_text_urls(html, suffixes), seen),
                           lambda u: U.same_base_domain(page_url, u, suffixes))
        return F.concat(
            F.transform(F.filter(anchored, lambda x: x["same_site"]), lambda x: F.struct(
                F.lit("anchor").alias("source"), x["url"].alias("url"),
                x["href"].alias("href"), x["text"].alias("text"))),
            F.transform(written, lambda u: F.struct(
                F.lit("text").alias("source"), u.alias("url"), u.alias("href"),
                F.lit("").alias("text"))),
        )

    found = _resolved(H.anchors(H.without_blocks(html)), page_url, suffixes)
    return let(_first_per_url(found), build)


def extract_links(pages: DataFrame, suffixes: Iterable[str] = DEFAULT_SUFFIXES,
                  include_text: bool = True, keep: Iterable[str] = ("page_id",)) -> DataFrame:
    """Distinct same-site links of each page, one row per link, without a shuffle.

    ``seq`` counts from 0 in page order; URLs found in the text follow the
    anchors.
    """
    suffixes = tuple(suffixes)
    found = built_once(("page_links", suffixes),
                       lambda: page_links(F.col("html"), F.col("url"), suffixes))
    rows = pages.select(
        *keep, F.col("url").alias("page_url"), F.posexplode_outer(found).alias("seq", "link"),
    ).where(F.col("link").isNotNull())
    if not include_text:
        rows = rows.where(F.col("link.source") == "anchor")
    return rows.select(*keep, "page_url", "seq", "link.source", "link.url", "link.href",
                       "link.text")


def resolve_links(pages: DataFrame, keep: Iterable[str] = ("page_id",)) -> DataFrame:
    """All anchors of each page with the absolute URL they point to."""
    rows = pages.select(
        *keep, F.col("url").alias("page_url"),
        F.explode_outer(H.anchors(H.without_blocks(F.col("html")))).alias("a"),
    ).where(F.col("a").isNotNull())
    return rows.select(
        *keep, "page_url", F.col("a.pos").alias("pos"), F.col("a.href").alias("href"),
        U.resolve_url(F.col("page_url"), F.col("a.href")).alias("resolved_url"),
        F.col("a.text").alias("text"))


def link_class(url: Column, text: Column, source: Column, page_url: Column,
               rules: LinkRules = LinkRules()) -> Column:
    """Class of a same-site link; the first matching rule decides."""
    u = F.lower(url)
    t = F.lower(text) if rules.use_text else F.lit("")
    in_text = source == "text"

    def mentions(words: Sequence[str]) -> Column:
        hit = contains_any(u, words)
        return hit | contains_any(t, words) if rules.use_text else hit

    contact = F.contains(u, F.lit("contact"))
    pagination = F.contains(u, F.lit("p=")) | F.contains(u, F.lit("page="))
    if rules.use_text:
        contact = contact | F.contains(t, F.lit("contact"))
        pagination = pagination | t.rlike(r"^\p{Nd}+$") | t.isin(list(rules.pagination_texts))
    teacher = F.contains(U.last_segment(url), F.lit("-")) & ~contains_any(
        u, PERSON_LINK_EXCLUDES)
    other_host = U.host_of(url) != U.host_of(page_url)
    priority = F.when(in_text, contains_any(u, rules.text_priority)).otherwise(
        mentions(rules.priority))
    return (
        F.when(~in_text & contact, "contact")
        .when(~in_text & pagination, "pagination")
        .when(~in_text & teacher, "teacher")
        .when(~in_text & mentions(rules.faculty), "faculty")
        .when(other_host, "subdomain")
        .when(priority, "priority")
        .otherwise("regular")
    )


def classify_links(links: DataFrame, rules: LinkRules = LinkRules()) -> DataFrame:
    """Add ``link_class`` and the sort key ``(class_rank, class_seq)`` of a page.

    Pagination links come newest first, all others in page order.
    """
    cls = link_class(F.col("url"), F.col("text"), F.col("source"), F.col("page_url"), rules)
    ranks = F.create_map(*[F.lit(x) for kv in CLASS_RANK.items() for x in kv])
    return (
        links.withColumn("link_class", cls)
        .withColumn("class_rank", F.element_at(ranks, F.col("link_class")))
        .withColumn("class_seq", F.when(F.col("link_class") == "pagination", -F.col("seq"))
                    .otherwise(F.col("seq")))
    )


def _ranked(found: Column, page_url: Column, rules: LinkRules) -> Column:
    """The links of a page in output order, sorted inside the row."""
    ranks = F.create_map(*[F.lit(x) for kv in CLASS_RANK.items() for x in kv])

    def keyed(link: Column, i: Column) -> Column:
        return let(link_class(link["url"], link["text"], link["source"], page_url, rules),
                   lambda cls: F.struct(
                       F.element_at(ranks, cls).alias("class_rank"),
                       F.when(cls == "pagination", -i).otherwise(i).alias("class_seq"),
                       i.alias("seq"), cls.alias("link_class"), link.alias("link")))

    return F.array_sort(F.transform(found, keyed))


def ranked_links(pages: DataFrame, suffixes: Iterable[str] = DEFAULT_SUFFIXES,
                 rules: LinkRules = LinkRules(), keep: Iterable[str] = ("page_id",),
                 limit: int | None = None) -> DataFrame:
    """Links of each page with class and ``link_rank``, their place in output order from 1.

    All links of a page start in its row, so they are classified, sorted and
    cut there: no shuffle.
    """
    suffixes = tuple(suffixes)

    # Two projections: one expression of both would nest too deep for the analyser.
    found = built_once(("page_links", suffixes), lambda: page_links(F.col("html"), F.col("url"), suffixes))
    ranked = built_once(("ranked", repr(rules)), lambda: _ranked(F.col("_links"), F.col("page_url"), rules))
    if limit is not None:
        ranked = F.slice(ranked, 1, limit)
    rows = pages.select(*keep, F.col("url").alias("page_url"), found.alias("_links")).select(
        *keep, "page_url", F.posexplode_outer(ranked).alias("place", "r"),
    ).where(F.col("r").isNotNull())
    return rows.select(
        *keep, "page_url", (F.col("place") + 1).alias("link_rank"), "r.seq", "r.link_class",
        "r.class_rank", "r.class_seq", "r.link.source", "r.link.url", "r.link.href", "r.link.text")


def url_class(url: Column, rules: LinkRules = FRONTIER_RULES) -> Column:
    """Class of a link by its URL alone, apart from the test for another host."""
    u = F.lower(url)
    teacher = F.contains(U.last_segment(url), F.lit("-")) & ~contains_any(u, PERSON_LINK_EXCLUDES)
    return (
        F.when(F.contains(u, F.lit("contact")), "contact")
        .when(F.contains(u, F.lit("p=")) | F.contains(u, F.lit("page=")), "pagination")
        .when(teacher, "teacher")
        .when(contains_any(u, rules.faculty), "faculty")
        .when(contains_any(u, rules.priority), "priority")
        .otherwise("regular"))


def walk_class(url: Column, seed: Column, rules: LinkRules = FRONTIER_RULES) -> Column:
    """Class of a link in a walk from ``seed``: by URL alone, its host against the seed's."""
    foreign = U.host_of(url) != U.host_of(seed)
    return let(url_class(url, rules), lambda c: F.when(
        foreign & c.isin("priority", "regular"), "subdomain").otherwise(c))


def link_edges(pages: DataFrame, suffixes: Iterable[str] = DEFAULT_SUFFIXES,
               rules: LinkRules = FRONTIER_RULES) -> DataFrame:
    """Link graph for a walk: canonical page URL -> link URL, with rank and order.

    Pages hand over their links in output order (:func:`ranked_links`); the
    walk ranks them anew by URL alone.  ``sub_rank`` is the rank of a link
    whose host is not that of the seed, NULL where the host does not matter.
    """
    links = ranked_links(pages, suffixes, keep=()).withColumn("link_class", url_class(F.col("url"), rules))
    ranks = F.create_map(*[F.lit(x) for kv in CLASS_RANK.items() for x in kv])
    return links.select(
        U.normalize_url(F.col("page_url")).alias("src"), F.col("url").alias("dst"), "link_class",
        F.element_at(ranks, F.col("link_class")).alias("class_rank"),
        F.when(F.col("link_class") == "pagination", -F.col("link_rank"))
        .otherwise(F.col("link_rank")).alias("class_seq"),
        F.when(F.col("link_class").isin("priority", "regular"), F.lit(CLASS_RANK["subdomain"]))
        .alias("sub_rank"))


def subdomain_links(pages: DataFrame, suffixes: Iterable[str] = DEFAULT_SUFFIXES,
                    keep: Iterable[str] = ("page_id",)) -> DataFrame:
    """Distinct links of each page to subdomains of its own host."""
    suffixes = tuple(suffixes)

    def links(page_url: Column, html: Column) -> Column:
        own = U.strip_www(U.host_of(page_url))
        full = let(U.url_parts(page_url), lambda b: F.transform(
            H.anchors(H.without_blocks(html)),
            lambda a: U.resolve_parts(page_url, b, a["href"])))

        def below(u: Column, mine: Column) -> Column:
            host = U.strip_www(U.host_of(u))
            return (host != mine) & F.endswith(host, F.concat(F.lit("."), mine))

        inside = let(own, lambda mine: F.filter(full, lambda u: below(u, mine)))
        urls = F.array_distinct(F.transform(inside, U.normalize_url))
        return F.filter(urls, lambda u: U.same_base_domain(page_url, u, suffixes))

    return pages.select(
        *keep, F.col("url").alias("page_url"),
        F.posexplode_outer(links(F.col("url"), F.col("html"))).alias("seq", "url"),
    ).where(F.col("url").isNotNull())
