"""HTML functions (Column -> Column): title, visible text, anchors, attributes.

Pages are read with regular expressions that follow the tokenising rules of
HTML (comments, raw-text elements, quoted attribute values); no parser runs
and no Python is called per row.  Quantifiers are possessive so that hostile
pages cost linear time and no deep recursion.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, literal_map, strip

# Attribute part of a tag: quotes only count after '='.
_ATTRS = r"""(?:[^>=]++|=[\s]*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_COMMENT = r"!--.*?(?:-->|\z)"
_RAW = rf"(script|style)(?=[\s/>]){_ATTRS}>.*?(?:</\1(?=[\s/>])[^>]*+>|\z)"
_RAW_OR_TEMPLATE = (
    rf"(script|style|template)(?=[\s/>]){_ATTRS}>.*?(?:</\1(?=[\s/>])[^>]*+>|\z)")
_TAG = rf"/?[a-z]{_ATTRS}>|[!?][^>]*+>"

# All patterns start with '<' itself, so other characters are passed quickly.
_BLOCKS = rf"(?is)<(?:{_COMMENT}|{_RAW})"
_NON_TEXT = rf"(?is)<(?:{_COMMENT}|{_RAW_OR_TEMPLATE}|{_TAG})"
# The first title decides, closed or not: no later start is tried.
_TITLE = rf"(?is)<title(?=[\s/>]){_ATTRS}>(.*?)(?:</title|\z)"
_ANCHOR = rf"(?is)<a(?=[\s/>]){_ATTRS}>.*?(?:(?=<a[\s>])|</a(?=[\s>])|\z)"
_ANCHOR_BODY = rf"(?is)^<a{_ATTRS}>(.*?)(?:</a)?\z"
_META = rf"(?is)<meta(?=[\s/])({_ATTRS})>"
_SCRIPT_BODY = rf"(?is)^<script{_ATTRS}>(.*?)(?:</script[^>]*+>)?\z"

# Stands for removed markup; it cannot occur in valid HTML.
MARK = "\u0001"

_NUMBER = r"^#(?:0*+([0-9]++)|[xX]0*+([0-9a-fA-F]++)|[xX]?0++);?"
_NAME = r"^([A-Za-z][A-Za-z0-9]*+);"
# Frequent names come first: a map is searched from its start.
_NAMED = {name: html5[f"{name};"] for name in ("amp", "nbsp", "quot", "lt", "gt", "apos")}
_NAMED |= {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
# Old names also count without a semicolon; the longest one does.
_BARE = {name: text for name, text in html5.items() if not name.endswith(";")}
_BARE_NAME = "^(" + "|".join(sorted(_BARE, key=lambda x: (-len(x), x))) + ")"
# Numbers 128 to 159 stand for the characters of windows-1252.
_CONTROLS = {str(i): bytes([i]).decode("cp1252", "replace") for i in range(128, 160)}
_CONTROLS = {k: chr(int(k)) if v == "\ufffd" else v for k, v in _CONTROLS.items()}  # five are unassigned


def _attr_pattern(name: str) -> str:
    """Match one attribute of a tag or attribute list, skipping all that come before it.

    Group 1 is '=' and the value with its quotes.
    """
    value = r"""(=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']*+))"""
    other = r"""[\s/=<]++|(?!NAME\s*=)[^\s/>=<]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+"""
    return rf"(?is)^(?:{other.replace('NAME', name)})*+{name}\s*+{value}"


def attr_or_null(tag: Column, name: str) -> Column:
    """Value of an attribute with entities decoded; NULL if it is absent."""

    def value(raw: Column) -> Column:
        bare = F.ltrim(F.substr(raw, F.lit(2)))
        quoted = F.startswith(bare, F.lit('"')) | F.startswith(bare, F.lit("'"))
        return F.when(raw != "", unescape_html(
            F.when(quoted, F.substr(bare, F.lit(2), F.length(bare) - F.lit(2))).otherwise(bare),
            attribute=True))

    return let(F.regexp_extract(tag, _attr_pattern(name), 1), value)


def _attr_of_tag(tag: Column, name: str) -> Column:
    """As :func:`attr_or_null` for a whole tag: its own name is no attribute."""
    return attr_or_null(F.regexp_replace(tag, r"^<[^\s/>]*+", ""), name)


def attr(tag: Column, name: str) -> Column:
    """Value of an attribute, entities decoded; '' if it is absent."""
    return F.coalesce(attr_or_null(tag, name), F.lit(""))


def unescape_html(c: Column, attribute: bool = False) -> Column:
    """Decode named and numeric character references, each exactly once.

    Old names count without their semicolon; in an attribute only if neither
    '=' nor a letter or digit follows, so that query strings stay as they are.
    """
    return let(c, lambda x: F.when(
        F.contains(x, F.lit("&")),
        F.array_join(F.transform(F.split(x, "&", -1), lambda p, i: _unescape_piece(p, i, attribute)), ""),
    ).otherwise(x))


def _from_code(code: Column) -> Column:
    """Character of a code point; what is none becomes U+FFFD, control characters vanish."""
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    low = code.bitwiseAND(0xFFFF)
    gone = (code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127)
            | code.between(0xFDD0, 0xFDEF) | (low == 0xFFFE) | (low == 0xFFFF))
    return (
        F.when(code.between(128, 159), F.element_at(literal_map(_CONTROLS), code.cast("string")))
        .when(valid & gone, "")
        .when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        .otherwise("\ufffd"))


def _numeric(ref: Column, part: Column) -> Column:
    """A piece that starts with a numeric reference of any length."""
    digits, hexes = F.regexp_extract(part, _NUMBER, 1), F.regexp_extract(part, _NUMBER, 2)
    beyond = F.lit(0x110000).cast("long")
    code = (F.when((F.length(digits) > 7) | (F.length(hexes) > 6), beyond)
            .when(hexes != "", F.conv(hexes, 16, 10).try_cast("long"))
            .otherwise(F.coalesce(digits.try_cast("long"), F.lit(0).cast("long"))))
    return F.concat(let(code, _from_code), F.substr(part, F.length(ref) + F.lit(1)))


def _unescape_piece(part: Column, i: Column, attribute: bool = False) -> Column:
    """Text after one '&' (the first piece has none in front)."""

    def named(name: Column) -> Column:
        rest = F.substr(part, F.length(name) + F.lit(2))
        return F.when(name != "", F.concat(F.element_at(literal_map(_NAMED), name), rest))

    def bare(name: Column) -> Column:
        rest = F.substr(part, F.length(name) + F.lit(1))
        known = name != ""
        if attribute:
            known = known & ~rest.rlike("^[=A-Za-z0-9]")
        return F.when(known, F.concat(F.element_at(literal_map(_BARE), name), rest))

    number = let(F.regexp_extract(part, _NUMBER, 0),
                 lambda ref: F.when(ref != "", _numeric(ref, part)))
    return F.when(i == 0, part).otherwise(F.coalesce(
        F.when(F.startswith(part, F.lit("#")), number),
        let(F.regexp_extract(part, _NAME, 1), named),
        let(F.regexp_extract(part, _BARE_NAME, 1), bare),
        F.concat(F.lit("&"), part)))


def without_blocks(html: Column) -> Column:
    """HTML with comments, scripts and styles replaced by a mark."""
    return F.regexp_replace(html, _BLOCKS, MARK)


def page_title(html: Column) -> Column:
    """Content of the first <title>, '' if there is none."""
    return title_of(without_blocks(html))


def title_of(markup: Column) -> Column:
    """As :func:`page_title` for HTML already free of comments and scripts."""
    return let(F.regexp_extract(markup, _TITLE, 0), lambda found: F.when(
        F.lower(found).endswith("</title"), unescape_html(F.regexp_extract(found, _TITLE, 1)))
        .otherwise(""))


def _joined_nodes(markup: Column, separator: str) -> Column:
    """Stripped, non-empty text nodes between tags, joined."""
    marked = let(markup, lambda x: F.when(
        F.contains(x, F.lit("<")), F.regexp_replace(x, _NON_TEXT, MARK)).otherwise(x))
    nodes = F.transform(F.split(unescape_html(marked), MARK, -1), strip)
    return F.array_join(F.filter(nodes, lambda x: x != ""), separator)


def visible_text(html: Column) -> Column:
    """Stripped text nodes joined by one blank, title included."""
    return _joined_nodes(html, " ")


def plain_text(html: Column) -> Column:
    """Text nodes joined as they stand, without a separator."""
    return unescape_html(F.regexp_replace(html, _NON_TEXT, ""))


def inner_text(fragment: Column) -> Column:
    """Stripped text nodes of a fragment, joined without a separator."""
    return _joined_nodes(fragment, "")


def anchors(markup: Column) -> Column:
    """array<struct(pos, href, text)> of the <a href> elements, in page order.

    ``markup`` is HTML free of comments and scripts (:func:`without_blocks`).
    """
    def parse(a: Column, i: Column) -> Column:
        return F.struct(
            i.alias("pos"), attr_or_null(a, "href").alias("href"),
            inner_text(F.regexp_extract(a, _ANCHOR_BODY, 1)).alias("text"))

    found = F.regexp_extract_all(markup, F.lit(_ANCHOR), F.lit(0))
    return F.filter(F.transform(found, parse), lambda a: a["href"].isNotNull())


def scripts(html: Column) -> Column:
    """array<string> of script bodies, in page order."""
    blocks = F.regexp_extract_all(html, F.lit(_BLOCKS), F.lit(0))
    only = F.filter(blocks, lambda b: b.rlike(r"(?i)^<script"))
    return F.transform(only, lambda b: F.regexp_extract(b, _SCRIPT_BODY, 1))


def meta_contents(markup: Column) -> Column:
    """array<string> of the content attributes of <meta> tags."""
    found = F.regexp_extract_all(markup, F.lit(_META), F.lit(1))
    return F.transform(found, lambda a: attr(a, "content"))


def attr_elements(elements: Column, name: str) -> Column:
    """array<struct(value, text)> of the elements that carry the attribute.

    ``elements`` comes from :func:`.elements.elements_with_attr`, which reads
    the page; a tag that only mentions the name has no such value.
    """
    found = F.transform(elements, lambda e: F.struct(
        _attr_of_tag(e["tag"], name).alias("value"), e["text"].alias("text")))
    return F.filter(found, lambda t: t["value"].isNotNull())


def is_blocked(title: Column, text: Column) -> Column:
    """True for error pages that refuse access."""
    return (
        F.contains(title, F.lit("403"))
        | F.contains(F.lower(title), F.lit("forbidden"))
        | F.contains(F.lower(text), F.lit("access denied"))
    )
