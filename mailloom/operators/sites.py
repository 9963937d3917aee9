"""Site-level operators: seeds, subdomain candidates, crawl delays, same-site joins."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DEFAULT_CRAWL_DELAY, DEFAULT_SUFFIXES, SUBDOMAIN_PREFIXES
from ..functions import urls as U
from ..functions.text import let
from .links import subdomain_links


def with_crawl_delay(urls: DataFrame, rules: DataFrame, url: str = "url",
                     default: float = DEFAULT_CRAWL_DELAY,
                     suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> DataFrame:
    """Add the delay of the URL's base domain; missing or zero means the default.

    ``rules`` has one row per ``base_domain``.  No broadcast is forced: the
    engine picks it while the measured table is small, and splits skewed
    domains otherwise.
    """
    keyed = urls.withColumn("base_domain", U.base_domain(
        U.strip_www(U.host_of(F.col(url))), suffixes))
    delays = rules.select("base_domain", F.col("crawl_delay").alias("rule_delay"))
    return keyed.join(delays, "base_domain", "left").withColumn(
        "crawl_delay",
        F.coalesce(F.nullif(F.col("rule_delay"), F.lit(0.0)), F.lit(float(default))),
    ).drop("rule_delay")


_SITE = ["base_domain", "scheme_family"]


def with_site(df: DataFrame, url: str, suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> DataFrame:
    """Adds the site of a URL, its base domain and scheme family; rows without a host go."""
    return df.withColumn("base_domain", U.base_domain(U.host_of(F.col(url)), tuple(suffixes))).withColumn(
        "scheme_family", U.scheme_family(F.col(url))).where(F.col("base_domain") != "")


def pair_same_site(seeds: DataFrame, pages: DataFrame,
                   suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> DataFrame:
    """Each page (``url``) with the seeds (``seed``) of its site.

    An equi-join on base domain and scheme family.  It has seeds times pages
    rows for each site; :func:`site_groups` holds the same without them.
    """
    return with_site(pages, "url", suffixes).join(with_site(seeds, "seed", suffixes), _SITE)


def site_groups(seeds: DataFrame, pages: DataFrame,
                suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> DataFrame:
    """One row per site that has seeds and pages: n_seeds, first_seed, n_pages.

    Both sides are merged per site before they meet, so a site with a large part of all pages is one
    row; :func:`pages_of_sites` and :func:`with_site` of the seeds give its members.
    """
    own = with_site(seeds, "seed", suffixes).groupBy(*_SITE).agg(
        F.count(F.lit(1)).alias("n_seeds"), F.min("seed").alias("first_seed"))
    captured = with_site(pages, "url", suffixes).groupBy(*_SITE).agg(F.count(F.lit(1)).alias("n_pages"))
    return own.join(captured, _SITE)


def pages_of_sites(pages: DataFrame, sites: DataFrame,
                   suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> DataFrame:
    """The pages of the sites of :func:`site_groups`, each once, with the site and how many seeds it has."""
    return with_site(pages, "url", suffixes).join(sites.select(*_SITE, "n_seeds"), _SITE)


def match_www_variants(pages: DataFrame, captured: DataFrame,
                       keep: Iterable[str] = ("page_id",)) -> DataFrame:
    """For each page URL and its www variant: how many captured URLs equal it.

    ``captured`` is counted per URL before the join.
    """
    counts = captured.groupBy("url").agg(F.count(F.lit(1)).alias("n_captured"))
    variants = pages.select(*keep, F.explode_outer(U.www_variants(F.col("url"))).alias("variant"))
    return variants.join(counts, variants["variant"] == counts["url"], "left").select(
        *keep, "variant", F.coalesce("n_captured", F.lit(0)).alias("n_captured"))


def _candidates(seed: Column, prefixes: Iterable[str], suffixes: tuple[str, ...]) -> Column:
    """Distinct department subdomains of a seed, as an array; empty or NULL without a host."""
    prefixes = tuple(prefixes)

    def build(x: Column, p: Column) -> Column:
        host = U.strip_www(p["netloc"])
        start = F.concat(F.when(p["scheme"] == "", "https").otherwise(p["scheme"]), F.lit("://"))
        urls = F.transform(F.array(*[F.lit(i) for i in prefixes]), lambda prefix: U.normalize_url(
            F.concat(start, prefix, F.lit("."), host)))
        return F.when(host != "", F.array_distinct(
            F.filter(urls, lambda u: U.same_base_domain(x, u, suffixes))))

    return let(seed, lambda x: let(U.url_parts(x), lambda p: build(x, p)))


def candidate_subdomains(seeds: DataFrame, prefixes: Iterable[str] = SUBDOMAIN_PREFIXES,
                         suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> DataFrame:
    """Department subdomains to look for, per seed (column ``seed``).

    Seeds are made distinct before they grow, so no task aggregates the candidates.
    """
    return seeds.select("seed").distinct().select(
        "seed", F.explode(_candidates(F.col("seed"), prefixes, tuple(suffixes))).alias("url"))


def start_set(seeds: DataFrame, pages: DataFrame,
              suffixes: Iterable[str] = DEFAULT_SUFFIXES,
              prefixes: Iterable[str] = SUBDOMAIN_PREFIXES) -> DataFrame:
    """Distinct (seed, url) to start from.

    A seed that is itself a subdomain starts alone; any other also tries the
    department subdomains and the subdomains linked from its own page.
    """
    suffixes, prefixes = tuple(suffixes), tuple(prefixes)
    norm = seeds.select(U.normalize_url(F.col("seed")).alias("seed")).distinct()
    root = ~U.is_subdomain(U.host_of(F.col("seed")), suffixes)
    # The URLs that a seed gives by itself, distinct in its row.
    own = F.array_union(F.array("seed"), F.coalesce(
        _candidates(F.col("seed"), prefixes, suffixes), F.array().cast("array<string>")))
    # Links are taken inside the page rows and joined afterwards, so that no
    # HTML is shuffled; only pages that can be a root seed are looked at.
    on_root = pages.where(~U.is_subdomain(U.host_of(F.col("url")), suffixes))
    linked = subdomain_links(on_root, suffixes, keep=()).select(
        U.normalize_url(F.col("page_url")).alias("seed"), "url").join(
            norm.where(root), "seed", "left_semi").distinct()
    return norm.select("seed", F.explode(F.when(root, own).otherwise(F.array("seed"))).alias("url")).unionByName(
        linked.where(~F.array_contains(own, F.col("url"))))
