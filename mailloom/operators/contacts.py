"""Contact extraction from pages and texts, and consolidation by address."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    DEFAULT_SUFFIXES, RENDER_HTML_LENGTH, ROLE_PATTERNS, SCRIPT_CONTEXT, SNIPPET_LENGTH,
    TITLE_LENGTH,
)
from ..functions import emails as E
from ..functions import html as H
from ..functions.elements import elements_with_attr
from ..functions.text import built_once, let, strip
from ..functions.urls import is_skipped
from ..session import cut_lineage
from .skew import with_global_index

_HITS = "array<struct<email:string,pos:int,snippet:string>>"

# Columns of a contact occurrence, in file order.
OCCURRENCE_COLUMNS = (
    "email", "local_part", "domain", "source_url", "source_type", "page_title",
    "context_snippet", "http_status", "found_at", "parse_method", "notes",
)
# Columns of a consolidated contact, in file order.
CLEAN_COLUMNS = ("email", "domain", "first_seen", "sources", "verified", "status", "notes", "part")
SOURCES_PER_PART = 10_000


def _none() -> Column:
    return F.array().cast(_HITS)


def _numbered(hits: Column) -> Column:
    return F.transform(hits, lambda h, i: F.struct(
        h["email"].alias("email"), i.alias("pos"), h["snippet"].alias("snippet")))


def _mailto(markup: Column, suffixes: Iterable[str]) -> Column:
    def address(a: Column) -> Column:
        raw = strip(F.substring_index(F.replace(a["href"], F.lit("mailto:"), F.lit("")), "?", 1))
        return F.struct(raw.alias("email"), a["text"].alias("snippet"))

    links = F.filter(H.anchors(markup), lambda a: F.startswith(a["href"], F.lit("mailto:")))
    return F.when(F.contains(markup, F.lit("mailto:")) | F.contains(markup, F.lit("&#")),
                  _accepted(F.transform(links, address), suffixes)).otherwise(_none())


def data_elements(html: Column) -> Column:
    """The elements of a page that :func:`page_hits` reads data attributes from.

    It holds a Python function, so ``html`` is a column of the table.
    """
    return elements_with_attr(html, "data-email", SNIPPET_LENGTH)


def _data_attr(elements: Column, suffixes: Iterable[str]) -> Column:
    tags = H.attr_elements(elements, "data-email")
    return _accepted(F.transform(tags, lambda t: F.struct(
        strip(t["value"]).alias("email"), t["text"].alias("snippet"))), suffixes)


def _accepted(found: Column, suffixes: Iterable[str]) -> Column:
    """Whole values that look like an address; the suffix is tested as written."""
    kept = F.filter(found, lambda f: F.contains(f["email"], F.lit("@"))
                    & E.has_suffix(f["email"], suffixes))
    return F.transform(kept, lambda f, i: F.struct(
        F.lower(f["email"]).alias("email"), i.alias("pos"),
        F.substring(f["snippet"], 1, SNIPPET_LENGTH).alias("snippet")))


def _meta(markup: Column, suffixes: Iterable[str]) -> Column:
    def of(content: Column) -> Column:
        found = E.find_emails(content, suffixes)
        return F.when(E.mentions_suffix(content, suffixes), F.transform(found, lambda h: F.struct(
            h["email"].alias("email"), h["pos"].alias("pos"),
            F.substring(content, 1, SNIPPET_LENGTH).alias("snippet")))).otherwise(_none())

    return _numbered(F.flatten(F.transform(H.meta_contents(markup), of)))


def _script(html: Column, suffixes: Iterable[str]) -> Column:
    return _numbered(F.flatten(F.transform(
        H.scripts(html), lambda s: E.find_emails(s, suffixes, SCRIPT_CONTEXT, trim=False))))


def emails_mailto(html: Column, suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> Column:
    """array<struct(email, pos, snippet)> of mailto links."""
    return let(H.without_blocks(html), lambda m: _mailto(m, tuple(suffixes)))


def emails_data_attr(html: Column, suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> Column:
    """array<struct(email, pos, snippet)> of data-email attributes."""
    return let(data_elements(html), lambda e: _data_attr(e, tuple(suffixes)))


def emails_meta(html: Column, suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> Column:
    """array<struct(email, pos, snippet)> of <meta content>."""
    return let(H.without_blocks(html), lambda m: _meta(m, tuple(suffixes)))


def emails_script(html: Column, suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> Column:
    """array<struct(email, pos, snippet)> of script bodies."""
    return _script(html, tuple(suffixes))


def emails_visible(html: Column, suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> Column:
    """array<struct(email, pos, snippet)> of the visible text."""
    return let(H.visible_text(html), lambda t: E.find_emails(t, tuple(suffixes)))


def _no_first_hits() -> Column:
    return F.array().cast(
        "array<struct<email:string,rank:int,method:string,snippet:string>>")


def _first_hits(hits: Column) -> Column:
    """First hit per address, by sorting inside the row: no shuffle."""
    ranked = F.array_sort(F.transform(hits, lambda h, i: F.struct(
        h["email"].alias("email"), i.alias("rank"), h["method"].alias("method"),
        h["snippet"].alias("snippet"))))
    return let(ranked, lambda a: F.filter(a, lambda h, i: (i == 0) | (
        h["email"] != F.get(a, i - 1)["email"])))


def page_hits(html: Column, suffixes: Iterable[str] = DEFAULT_SUFFIXES,
              exclude: Iterable[str] | None = ROLE_PATTERNS,
              text: Column | None = None, elements: Column | None = None) -> Column:
    """struct(title, hits) of a page; all five extractors share one pass.

    Order of precedence: mailto, data attribute, meta, visible text, script.
    Role addresses are dropped unless ``exclude`` is None.  Inside a lambda
    ``elements`` (:func:`data_elements`) has to be given.
    """
    suffixes = tuple(suffixes)

    def tagged(hits: Column, method: str) -> Column:
        return F.transform(hits, lambda h: F.struct(
            h["email"].alias("email"), F.lit(method).alias("method"),
            h["snippet"].alias("snippet")))

    def build(page: Column) -> Column:
        markup = page["markup"]
        found = F.concat(
            tagged(_mailto(markup, suffixes), "mailto_link"),
            tagged(_data_attr(page["elements"], suffixes), "data_attribute"),
            tagged(_meta(markup, suffixes), "meta_tag"),
            tagged(emails_visible(html, suffixes) if text is None
                   else E.find_emails(text, suffixes), "regex_html"),
            tagged(_script(html, suffixes), "script_tag"),
        )
        if exclude is not None:
            roles = tuple(exclude)
            found = F.filter(found, lambda h: ~E.is_institutional(h["email"], roles))
        return F.struct(H.title_of(markup).alias("title"), _first_hits(found).alias("hits"))

    elements = data_elements(html) if elements is None else elements
    return let(F.struct(H.without_blocks(html).alias("markup"), elements.alias("elements")), build)


def page_hits_of(html: str, suffixes: Iterable[str] = DEFAULT_SUFFIXES,
                 exclude: Iterable[str] | None = ROLE_PATTERNS) -> Column:
    """:func:`page_hits` of a named column."""
    suffixes = tuple(suffixes)
    exclude = None if exclude is None else tuple(exclude)
    return built_once(("page_hits", html, suffixes, exclude),
                      lambda: page_hits(F.col(html), suffixes, exclude))


def extract_contacts(pages: DataFrame, suffixes: Iterable[str] = DEFAULT_SUFFIXES,
                     exclude: Iterable[str] | None = ROLE_PATTERNS,
                     found_at: Column | None = None,
                     keep: Iterable[str] = ()) -> DataFrame:
    """Contact occurrences of captured pages (``url``, ``html``).

    Everything up to the single explode happens inside the page row, so the
    stage has no shuffle; pages without any '@' are skipped by the scan
    filter.  ``keep`` names further page columns to carry along.
    """
    found = F.current_timestamp() if found_at is None else found_at
    carried = [F.col(c) for c in keep]
    per_page = pages.where(E.may_hold_address(F.col("html"))).select(
        *carried, F.col("url").alias("source_url"), found.alias("found_at"),
        page_hits_of("html", suffixes, exclude).alias("found"))
    rows = per_page.select(
        *carried, "source_url", "found_at", F.col("found.title").alias("title"),
        F.explode_outer("found.hits").alias("hit"),
    ).where(F.col("hit").isNotNull())
    return occurrence_rows(rows, carried, "html")


def extract_contacts_from_text(texts: DataFrame, text: str = "text", url: str = "url",
                               suffixes: Iterable[str] = DEFAULT_SUFFIXES,
                               exclude: Iterable[str] | None = ROLE_PATTERNS,
                               found_at: Column | None = None,
                               source_type: str = "html",
                               keep: Iterable[str] = ()) -> DataFrame:
    """Contact occurrences of plain texts: every match, in order of position."""
    found = F.current_timestamp() if found_at is None else found_at
    carried = [F.col(c) for c in keep]
    rows = texts.where(F.contains(F.col(text), F.lit("@"))).select(
        *carried, F.col(url).alias("source_url"), found.alias("found_at"),
        F.lit("").alias("title"),
        F.explode_outer(E.find_emails(F.col(text), suffixes)).alias("h"),
    ).where(F.col("h").isNotNull())
    if exclude is not None:
        rows = rows.where(~E.is_institutional(F.col("h.email"), exclude))
    rows = rows.withColumn("hit", F.struct(
        F.col("h.email").alias("email"), F.col("h.pos").alias("rank"),
        F.lit(f"regex_{source_type}").alias("method"), F.col("h.snippet").alias("snippet")))
    return occurrence_rows(rows, carried, source_type)


def occurrence_rows(rows: DataFrame, carried: list[Column], source_type: str) -> DataFrame:
    email = F.col("hit.email")
    return rows.select(
        *carried,
        email.alias("email"),
        E.local_part(email).alias("local_part"),
        E.email_domain(email).alias("domain"),
        "source_url",
        F.lit(source_type).alias("source_type"),
        F.substring("title", 1, TITLE_LENGTH).alias("page_title"),
        F.col("hit.snippet").alias("context_snippet"),
        F.lit("200").alias("http_status"),
        "found_at",
        F.col("hit.method").alias("parse_method"),
        F.lit("").alias("notes"),
        F.col("hit.rank").alias("rank"),
    )


def clean_occurrences(occ: DataFrame, exclude: Iterable[str] | None = ROLE_PATTERNS,
                      strict: bool = True) -> DataFrame:
    """Lower-cased, trimmed, valid, non-role occurrences."""
    valid = occ.withColumn("email", E.normalize_email(F.col("email"))).where(
        E.is_valid_email(F.col("email")))
    if exclude is None:
        return valid
    return valid.where(~E.is_institutional(F.col("email"), exclude, strict))


def consolidate_contacts(occ: DataFrame, seq: str = "seq",
                         exclude: Iterable[str] | None = ROLE_PATTERNS,
                         sources_per_part: int = SOURCES_PER_PART) -> DataFrame:
    """Addresses with their distinct sources; the key is (email, part).

    ``seq``, of any type that sorts, is the order of the occurrences.  Equal
    (address, source) pairs are merged first.  Sources stand in first-seen
    order; an address with more than ``sources_per_part`` of them has as many
    parts as that takes, filled in this order, so no list grows with the table.
    The other columns of a part are those of the address.

    Nearly all addresses have one part and are put together by one shuffle.  The
    place of a source of a larger one is its place in the order of all of them,
    made by ranges, less that of the first source of its address.
    """
    rows = clean_occurrences(occ, exclude).select(
        "email",
        F.when(F.col("source_url") != "", F.col("source_url")).alias("source_url"),
        F.lower(F.when(F.coalesce(F.col("domain"), F.lit("")) != "", F.col("domain")).otherwise(
            F.get(F.split("email", "@", -1), 1))).alias("domain"),
        "found_at",
        F.col(seq).alias("seq"),
    )
    # Stored once: several readers follow, and the scan behind it is the big part.
    pairs = cut_lineage(rows.groupBy("email", "source_url").agg(
        F.min(F.struct("seq", "domain")).alias("first"),
        F.min("found_at").alias("found_at"),
    ))
    head = [F.min("first")["domain"].alias("domain"), F.min("found_at").alias("first_seen")]
    large = cut_lineage(pairs.groupBy("email").agg(*head, F.count("source_url").alias("n")).where(
        F.col("n") > sources_per_part).drop("n"))
    source = F.when(F.col("source_url").isNotNull(),
                    F.struct(F.col("first.seq").alias("seq"), "source_url"))
    in_order = F.transform(F.array_sort(F.collect_list(source)), lambda s: s["source_url"]).alias("sources")
    out = pairs.join(large, "email", "left_anti").groupBy("email").agg(
        *head, in_order).withColumn("part", F.lit(0).cast("long"))
    if not large.isEmpty():
        out = out.unionByName(_large_parts(pairs, large, in_order, sources_per_part))
    return out.select(
        "email", "domain", "first_seen", "sources",
        F.lit("false").alias("verified"), F.lit("unknown").alias("status"),
        F.lit("").alias("notes"), "part",
    )


def _large_parts(pairs: DataFrame, large: DataFrame, in_order: Column, sources_per_part: int) -> DataFrame:
    """The parts of the addresses in ``large``; no task holds more than one part."""
    ranked = with_global_index(
        pairs.where(F.col("source_url").isNotNull()).join(large.select("email"), "email", "left_semi").select(
            "email", F.col("first.seq").alias("seq"), "source_url", "first"), ["email", "seq", "source_url"], "place")
    ranked = cut_lineage(ranked)
    start = ranked.groupBy("email").agg(F.min("place").alias("start"))
    part = F.floor((F.col("place") - F.col("start")) / F.lit(sources_per_part)).alias("part")
    parts = ranked.join(start, "email").select("email", part, "first", "source_url")
    return parts.groupBy("email", "part").agg(in_order).join(large, "email")


def contact_sources(occ: DataFrame, seq: str = "seq",
                    exclude: Iterable[str] | None = ROLE_PATTERNS) -> DataFrame:
    """Distinct (address, source) rows with first position and time.

    The row form of the sources list; it never builds a list, so it is the
    form to use for further joins at scale.
    """
    return (
        clean_occurrences(occ, exclude).where(F.col("source_url") != "")
        .groupBy("email", "source_url")
        .agg(F.min(seq).alias("first_seq"), F.min("found_at").alias("first_found_at"),
             F.count(F.lit(1)).alias("n_occurrences"))
    )


def explode_sources(clean: DataFrame) -> DataFrame:
    """One row per address and source from the ';'-joined text or array form."""
    sources = F.col("sources")
    if dict(clean.dtypes)["sources"] == "string":
        sources = F.split(sources, ";", -1)
    return clean.select("email", F.explode_outer(sources).alias("source_url")).where(
        F.col("source_url") != "")


def reclean(clean: DataFrame, exclude: Iterable[str] = ROLE_PATTERNS) -> DataFrame:
    """Drop invalid and role addresses (loose test); columns stay as they are."""
    e = E.normalize_email(F.col("email"))
    return clean.where(E.is_valid_email(e) & ~E.is_institutional(e, exclude, strict=False))


def clean_counts(occ: DataFrame, exclude: Iterable[str] = ROLE_PATTERNS,
                 strict: bool = True) -> DataFrame:
    """Counts of total, invalid, removed and remaining rows, in one pass."""
    e = E.normalize_email(F.col("email"))
    valid = E.is_valid_email(e)
    role = E.is_institutional(e, exclude, strict)
    return occ.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(~valid).alias("n_invalid"),
        F.count_if(valid & role).alias("n_removed"),
        F.count_if(valid & ~role).alias("n_remaining"),
    )


def page_diagnostics(pages: DataFrame, suffixes: Iterable[str] = DEFAULT_SUFFIXES,
                     exclude: Iterable[str] | None = ROLE_PATTERNS,
                     keep: Iterable[str] = ("page_id",)) -> DataFrame:
    """Per page: address counts, and flags for blocked and script-built pages.

    The number of contacts comes from the same row, so no join is needed.
    """
    suffixes = tuple(suffixes)
    html = F.col("html")
    text = F.coalesce(F.col("text"), F.lit(""))
    count = lambda c, s: F.size(F.split(c, s, -1)) - 1
    suffix_hits = F.size(F.regexp_extract_all(text, F.lit(r"\.(?:" + "|".join(
        s.lstrip(".") for s in suffixes) + ")"), F.lit(0)))
    exclude = None if exclude is None else tuple(exclude)

    def read_page() -> Column:
        """Text, title and hits; the text is made once for all uses."""
        parts = F.struct(H.visible_text(html).alias("text"), data_elements(html).alias("elements"))
        return let(parts, lambda p: F.struct(
            p["text"].alias("text"),
            F.when(E.may_hold_address(html), page_hits(html, suffixes, exclude, p["text"], p["elements"]))
            .otherwise(F.struct(H.page_title(html).alias("title"), _no_first_hits().alias("hits")))
            .alias("found")))

    page = built_once(("diagnostics", suffixes, exclude), read_page)
    per_page = pages.select(
        *keep, "url", F.length(html).alias("html_length"), page.alias("page"),
    ).select(*keep, "url", "html_length", "page.text", "page.found", "page.found.title")
    n_emails = F.coalesce(F.size(F.col("found.hits")), F.lit(0))
    n_emails = F.when(n_emails < 0, 0).otherwise(n_emails)
    flagged = per_page.select(
        *keep, "url", "html_length", n_emails.alias("n_emails"),
        count(text, "@").alias("at_count"), suffix_hits.alias("suffix_count"),
        H.is_blocked(F.col("title"), text).alias("is_blocked"),
    )
    return flagged.withColumn(
        "unmatched_address",
        (F.col("n_emails") == 0) & (F.col("at_count") > 0) & (F.col("suffix_count") > 0),
    ).withColumn(
        "needs_render",
        (F.contains(F.lower("url"), F.lit("websites"))
         | ((F.col("n_emails") == 0) & (F.col("html_length") < RENDER_HTML_LENGTH)))
        & ~is_skipped(F.col("url")),
    )
