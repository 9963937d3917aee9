"""URL functions (Column -> Column), all built-in expressions.

Any string is accepted: text that is no URL passes through unchanged where a
canonical form is asked for, and never raises.

Each function mentions its arguments once and binds them with :func:`let`:
the optimizer substitutes columns by their definition when it moves filters,
and an argument mentioned five times would then be computed five times.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DEFAULT_SUFFIXES, SKIP_URL_PARTS
from .text import contains_any, let

_SPLIT = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"
_CONTROLS = "".join(map(chr, range(0x21)))
# Schemes whose last path segment may carry ";params", and those that can be
# the base of a relative link.  Fixed values of the generic URL syntax.
_PARAM_SCHEMES = ["", "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps",
                  "rtspu", "sip", "sips", "mms", "sftp", "tel"]
_RELATIVE_SCHEMES = ["", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https",
                     "shttp", "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn",
                     "svn+ssh", "ws", "wss"]
_WEB_SCHEMES = ["http", "https", ""]


def url_parts(u: Column) -> Column:
    """struct(scheme, netloc, path, params, query, fragment); missing parts are ''.

    Control characters and blanks in front are dropped, as are tabs and line
    breaks anywhere; the scheme is lower-cased.
    """
    # Line breaks are gone from a cleaned URL, so they can separate the parts:
    # one pattern run per URL.
    one_line = let(u, lambda x: F.when(
        x.rlike(r"[\t\r\n]"), F.translate(x, "\t\r\n", "")).otherwise(x))
    cleaned = F.ltrim(one_line, F.lit(_CONTROLS))
    pieces = F.split(F.regexp_replace(cleaned, _SPLIT, "$1\n$2\n$3\n$4\n$5"), "\n", -1)

    def build(x: Column) -> Column:
        scheme = F.lower(x[0])
        has_params = F.contains(x[2], F.lit(";")) & scheme.isin(_PARAM_SCHEMES)
        return F.struct(
            scheme.alias("scheme"),
            x[1].alias("netloc"),
            F.when(has_params, F.regexp_replace(x[2], r"(?s);[^/]*\z", ""))
            .otherwise(x[2]).alias("path"),
            F.when(has_params, F.regexp_extract(x[2], r"(?s);([^/]*)\z", 1))
            .otherwise(F.lit("")).alias("params"),
            x[3].alias("query"),
            x[4].alias("fragment"),
        )

    return let(pieces, build)


def _has_bad_brackets(netloc: Column) -> Column:
    return F.contains(netloc, F.lit("[")) != F.contains(netloc, F.lit("]"))


def _tail(p: Column) -> Column:
    """'?query#fragment' with only the parts that are there."""
    return F.concat(
        F.when(p["query"] != "", F.concat(F.lit("?"), p["query"])).otherwise(F.lit("")),
        F.when(p["fragment"] != "", F.concat(F.lit("#"), p["fragment"])).otherwise(F.lit("")),
    )


def host_of(u: Column) -> Column:
    """Network location (host and port, case kept), '' if there is none."""
    return url_parts(u)["netloc"]


def scheme_of(u: Column) -> Column:
    return url_parts(u)["scheme"]


def path_of(u: Column) -> Column:
    return url_parts(u)["path"]


def normalize_url(u: Column) -> Column:
    """Canonical URL: lower-case scheme, no trailing slashes, no ';params'."""
    return let(u, lambda x: let(url_parts(x), lambda p: normalize_parts(x, p)))


def normalize_parts(u: Column, p: Column) -> Column:
    """As :func:`normalize_url` with the parts of the URL already at hand."""
    path = F.rtrim(p["path"], F.lit("/"))
    return F.when((p["netloc"] == "") | _has_bad_brackets(p["netloc"]), u).otherwise(
        F.concat(
            F.when(p["scheme"] == "", F.lit("https")).otherwise(p["scheme"]),
            F.lit("://"), p["netloc"],
            F.when(path == "", F.lit("/")).otherwise(path),
            _tail(p),
        )
    )


def strip_www(host: Column) -> Column:
    """Drop one leading 'www.' (case-sensitive)."""
    return F.regexp_replace(host, r"^www\.", "")


def base_domain(host: Column, suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> Column:
    """Last two labels when the last label is a known suffix, else the whole host."""
    labels = [s.lstrip(".") for s in suffixes]
    return let(host, lambda h: F.when(
        F.contains(h, F.lit(".")) & F.substring_index(h, ".", -1).isin(labels),
        F.substring_index(h, ".", -2)).otherwise(h))


def is_subdomain(host: Column, suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> Column:
    """True where the host (without 'www.') has more labels than its base domain."""
    # The base domain is the host or the end of it.
    return let(strip_www(host),
               lambda h: F.length(h) > F.length(base_domain(h, suffixes)))


def same_base_domain(u1: Column, u2: Column,
                     suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> Column:
    """True where both URLs share a non-empty base domain and a compatible scheme."""
    suffixes = tuple(suffixes)
    return let(url_parts(u1), lambda a: let(url_parts(u2),
                                            lambda b: same_site_parts(a, b, suffixes)))


def same_site_parts(a: Column, b: Column, suffixes: Iterable[str]) -> Column:
    """As :func:`same_base_domain` with the parts of both URLs already at hand."""
    same_base = let(base_domain(a["netloc"], suffixes), lambda x: (x != "") & (
        x == base_domain(b["netloc"], suffixes)))
    schemes = (a["scheme"] == b["scheme"]) | (
        a["scheme"].isin(_WEB_SCHEMES) & b["scheme"].isin(_WEB_SCHEMES))
    valid = ~_has_bad_brackets(a["netloc"]) & ~_has_bad_brackets(b["netloc"])
    return same_base & schemes & valid


def scheme_family(u: Column) -> Column:
    """Join key for scheme agreement: the web schemes count as one."""
    return let(scheme_of(u), lambda s: F.when(s.isin(_WEB_SCHEMES), F.lit("web")).otherwise(s))


def ensure_https(u: Column) -> Column:
    """Upgrade http and scheme-less URLs that name a host to https."""

    def build(x: Column, p: Column) -> Column:
        path = F.when((p["path"] == "") & (p["query"] != ""), F.lit("/")).otherwise(p["path"])
        upgrade = (p["netloc"] != "") & p["scheme"].isin("", "http") & ~_has_bad_brackets(
            p["netloc"])
        return F.when(upgrade, F.concat(F.lit("https://"), p["netloc"], path, _tail(p))
                      ).otherwise(x)

    return let(u, lambda x: let(url_parts(x), lambda p: build(x, p)))


def www_variants(u: Column) -> Column:
    """array(url, the same url with 'www.' added or removed)."""

    def build(x: Column, p: Column) -> Column:
        other = F.when(F.startswith(p["netloc"], F.lit("www.")), strip_www(p["netloc"])).otherwise(
            F.concat(F.lit("www."), p["netloc"]))
        variant = F.concat(
            F.when(p["scheme"] == "", F.lit("https")).otherwise(p["scheme"]),
            F.lit("://"), other,
            F.when(p["path"] == "", F.lit("/")).otherwise(p["path"]),
            _tail(p),
        )
        no_variant = (p["netloc"] == "") | _has_bad_brackets(p["netloc"])
        return F.when(no_variant, F.array(x)).otherwise(F.array(x, variant))

    return let(u, lambda x: let(url_parts(x), lambda p: build(x, p)))


def path_segments(u: Column) -> Column:
    """Non-empty path segments as an array."""
    return F.filter(F.split(path_of(u), "/", -1), lambda s: s != "")


def last_segment(u: Column) -> Column:
    """Last non-empty path segment, '' if there is none."""
    return F.regexp_extract(path_of(u), r"([^/]+)/*$", 1)


def is_skipped(u: Column) -> Column:
    """True for login and admin pages."""
    return contains_any(F.lower(u), SKIP_URL_PARTS)


def _unparse(scheme: Column, netloc: Column, path: Column, p: Column, query: Column) -> Column:
    full = F.when(p["params"] != "", F.concat(path, F.lit(";"), p["params"])).otherwise(path)
    rooted = F.when((full != "") & ~F.startswith(full, F.lit("/")),
                    F.concat(F.lit("/"), full)).otherwise(full)
    with_host = F.when(netloc != "", F.concat(F.lit("//"), netloc, rooted)).otherwise(full)
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        with_host,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
        F.when(p["fragment"] != "", F.concat(F.lit("#"), p["fragment"])).otherwise(F.lit("")),
    )


def _fold_dots(path: Column) -> Column:
    """Remove '.' and '..' segments."""

    def fold(parts: Column) -> Column:
        kept = F.aggregate(
            parts, F.array().cast("array<string>"),
            lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
            .when(s == ".", acc)
            .otherwise(F.concat(acc, F.array(s))),
        )
        ends_dotted = F.element_at(parts, -1).isin(".", "..")
        return F.array_join(
            F.when(ends_dotted, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")

    return let(path, lambda p: F.when(
        F.contains(p, F.lit(".")) & p.rlike(r"(?:^|/)\.\.?(?:/|\z)"),
        let(F.split(p, "/", -1), fold)).otherwise(p))


def resolve_url(base: Column, href: Column) -> Column:
    """Resolve a link against the URL of its page (RFC 3986 style)."""
    return let(base, lambda x: let(url_parts(x), lambda b: let(
        href, lambda h: resolve_parts(x, b, h))))


def resolve_parts(base: Column, b: Column, href: Column) -> Column:
    """As :func:`resolve_url` with the parts of the base already at hand."""

    def build(p: Column) -> Column:
        scheme = F.when(p["scheme"] == "", b["scheme"]).otherwise(p["scheme"])
        foreign = (scheme != b["scheme"]) | ~scheme.isin(_RELATIVE_SCHEMES)
        # Folder of the base path plus the relative path, without empty inner
        # segments; the first and the last segment stay as they are.
        folder = F.regexp_replace(b["path"], r"(?s)[^/]*$", "")
        merged = F.regexp_replace(F.concat(folder, p["path"]), r"/{2,}", "/")
        path = _fold_dots(F.when(F.startswith(p["path"], F.lit("/")), p["path"]).otherwise(merged))
        path = F.coalesce(F.nullif(path, F.lit("")), F.lit("/"))
        stay = (p["path"] == "") & (p["params"] == "")
        stay_parts = F.struct(b["params"].alias("params"), p["fragment"].alias("fragment"))
        return (
            F.when(href == "", base)
            .when(base == "", href)
            .when(foreign, href)
            .when(p["netloc"] != "", _unparse(scheme, p["netloc"], p["path"], p, p["query"]))
            .when(stay, _unparse(
                scheme, b["netloc"], b["path"], stay_parts,
                F.when(p["query"] == "", b["query"]).otherwise(p["query"])))
            .otherwise(let(path, lambda x: _unparse(scheme, b["netloc"], x, p, p["query"])))
        )

    return let(url_parts(href), build)
