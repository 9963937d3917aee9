"""E-mail address functions (Column -> Column)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    DEFAULT_SUFFIXES, ROLE_PATTERNS, ROLE_PREFIXES, SNIPPET_LENGTH, TEXT_CONTEXT,
)
from .text import any_of, contains_any, let, regex_quote, strip

_WORD = r"\p{L}\p{N}_"
_LOCAL = _WORD + r".\-+%"
_DOMAIN = _WORD + r".\-"


def _suffix_alternatives(suffixes: Iterable[str]) -> str:
    return "|".join(regex_quote(s.lstrip(".")) for s in suffixes)


def email_regex(suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> str:
    """Java pattern of an address under one of the suffixes.

    A match may only start where a run of address characters starts, or where
    the match before ended.  That finds the same addresses as an unanchored
    search but visits a long run (encoded data in a script) once instead of
    once per character.
    """
    return (
        rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_DOMAIN}]+"
        rf"\.(?i:{_suffix_alternatives(suffixes)})(?![{_WORD}])"
    )


def has_suffix(c: Column, suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> Column:
    """True where the text ends with one of the suffixes (case-sensitive)."""
    out = F.lit(False)
    for s in suffixes:
        out = out | F.endswith(c, F.lit(s))
    return out


def mentions_suffix(c: Column, suffixes: Iterable[str] = DEFAULT_SUFFIXES) -> Column:
    """True where the text contains one of the suffixes (case-sensitive)."""
    return contains_any(c, suffixes)


def may_hold_address(c: Column) -> Column:
    """Cheap test that text or HTML can hold an address at all.

    '@' may be written as a numeric character reference.  The scan can apply
    it to skip most rows before any pattern runs.
    """
    return F.contains(c, F.lit("@")) | F.contains(c, F.lit("&#"))


def local_part(e: Column) -> Column:
    return F.substring_index(e, "@", 1)


def email_domain(e: Column) -> Column:
    """Everything after the first '@'."""
    return F.substr(e, F.instr(e, "@") + F.lit(1))


def is_valid_email(e: Column) -> Column:
    """Non-empty after trimming, with an '@'; NULL counts as invalid."""
    return F.coalesce(F.contains(e, F.lit("@")), F.lit(False))


def normalize_email(e: Column) -> Column:
    return strip(F.lower(e))


def is_institutional(e: Column, patterns: Iterable[str] = ROLE_PATTERNS,
                     strict: bool = True) -> Column:
    """True for role and other non-personal addresses.

    The loose test knows the substring list and very short local parts; the
    strict one adds role prefixes and three-letter codes.
    """
    p = F.lower(local_part(e))
    hit = contains_any(p, patterns) | (F.length(p) < 3)
    if strict:
        hit = (
            hit
            | p.rlike("^" + any_of(ROLE_PREFIXES))
            | ((F.length(p) == 3) & ~p.rlike(r"[.\-]"))
        )
    return F.contains(e, F.lit("@")) & hit


def find_emails(text: Column, suffixes: Iterable[str] = DEFAULT_SUFFIXES,
                context: int = TEXT_CONTEXT, trim: bool = True) -> Column:
    """array<struct(email, pos, snippet)> of all addresses of a text, in order.

    The snippet is the text around the match, ``context`` characters on either
    side.  The text is cut at each '@'; a local part is then the end of one
    piece and a domain the start of the next, so patterns only run next to an
    '@' and never over the whole text.
    """
    suffixes = tuple(suffixes)
    found = let(F.split(text, "@", -1), lambda pieces: _in_pieces(
        text, pieces, suffixes, context, strip if trim else (lambda c: c)))
    return F.coalesce(
        F.when(F.contains(text, F.lit("@")), found),
        F.array().cast("array<struct<email:string,pos:int,snippet:string>>"),
    )


_TAIL = 80  # local parts up to this length need no look at the whole piece


def _in_pieces(text: Column, pieces: Column, suffixes: tuple[str, ...], context: int,
               finish) -> Column:
    domain_pattern = (
        rf"^[{_DOMAIN}]+\.(?i:{_suffix_alternatives(suffixes)})(?![{_WORD}])")

    def run_length(piece: Column) -> Column:
        """Length of the run of address characters at the end of a piece."""
        def run(x: Column) -> Column:
            return F.length(F.regexp_extract(F.reverse(x), f"^[{_LOCAL}]+", 0))

        return let(run(F.right(piece, F.lit(_TAIL))),
                   lambda n: F.when(n < _TAIL, n).otherwise(run(piece)))

    def describe(piece: Column, i: Column) -> Column:
        """What lies around the '@' behind this piece; ``taken`` is the domain
        of the '@' in front of it, which no local part may use again."""
        domain = F.when(i < F.size(pieces) - 1, F.regexp_extract(
            F.get(pieces, i + 1), domain_pattern, 0)).otherwise(F.lit(""))
        return let(domain, lambda d: F.struct(
            piece.alias("piece"), i.alias("i"), d.alias("domain"),
            F.when(d == "", F.lit(0)).otherwise(run_length(piece)).alias("run")))

    def usable(d: Column) -> Column:
        return (d["domain"] != "") & (d["run"] > 0)

    def build(described: Column) -> Column:
        # Two addresses that touch ("a@b.dz@c.dz") share a domain as local
        # part; such a text is left to the plain left-to-right search.
        touching = F.exists(described, lambda d: usable(d) & (d["i"] > 0) & let(
            F.get(described, d["i"] - 1), lambda before: usable(before) & (
                F.length(before["domain"]) >= F.length(d["piece"]))))
        hits = F.filter(described, usable)
        return F.when(touching, _by_search(text, suffixes, context, finish)).otherwise(
            F.transform(hits, lambda d, n: hit(d, n, described)))

    def hit(d: Column, n: Column, described: Column) -> Column:
        before = F.get(described, d["i"] - 1)
        taken = F.when((d["i"] > 0) & usable(before), F.length(before["domain"])).otherwise(
            F.lit(0))
        size = F.length(d["piece"])
        return let(F.least(d["run"], size - taken), lambda local: F.struct(
            F.lower(F.concat(F.right(d["piece"], local), F.lit("@"), d["domain"]))
            .alias("email"),
            n.alias("pos"),
            F.substring(finish(F.concat(
                left_of(d, size - local), F.right(d["piece"], local), F.lit("@"), d["domain"],
                right_of(d))), 1, SNIPPET_LENGTH).alias("snippet"),
        ))

    def left_of(d: Column, length: Column) -> Column:
        near = F.left(d["piece"], length)
        first = F.greatest(d["i"] - F.lit(context), F.lit(0))
        far = F.transform(F.slice(pieces, first + 1, d["i"] - first),
                          lambda x: F.right(x, F.lit(context)))
        return F.right(
            F.when((length >= context) | (d["i"] == 0), near).otherwise(
                F.concat(F.array_join(far, "@"), F.lit("@"), near)), F.lit(context))

    def right_of(d: Column) -> Column:
        def of(near: Column) -> Column:
            far = F.transform(F.slice(pieces, d["i"] + 3, context),
                              lambda x: F.left(x, F.lit(context)))
            enough = (F.length(near) >= context) | (d["i"] + 2 >= F.size(pieces))
            return F.left(F.when(enough, near).otherwise(
                F.concat(near, F.lit("@"), F.array_join(far, "@"))), F.lit(context))

        return let(F.substr(F.get(pieces, d["i"] + 1), F.length(d["domain"]) + 1), of)

    return let(F.transform(pieces, describe), build)


def _by_search(text: Column, suffixes: tuple[str, ...], context: int, finish) -> Column:
    """The same by one search over the text.

    The snippet is put together from the neighbouring pieces between matches.
    """
    pattern = email_regex(suffixes)
    # A match has at least one character, '@', one character and a suffix, so
    # this many matches cover the context.
    shortest = 2 + min(len("." + s.lstrip(".")) for s in suffixes) + 1
    reach = context // shortest + 2

    def build(matches: Column, gaps: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            first = F.greatest(i - F.lit(reach), F.lit(0))
            before = F.concat(
                F.array_join(F.flatten(F.zip_with(
                    F.slice(gaps, first + 1, i - first), F.slice(matches, first + 1, i - first),
                    lambda g, x: F.array(g, x))), ""),
                F.element_at(gaps, i + 1),
            )
            after = F.concat(
                F.element_at(gaps, i + 2),
                F.array_join(F.flatten(F.zip_with(
                    F.slice(matches, i + 2, reach),
                    F.slice(gaps, i + 3, reach),
                    lambda x, g: F.array(x, g))), ""),
            )
            return F.struct(
                F.lower(m).alias("email"),
                i.alias("pos"),
                F.substring(finish(F.concat(
                    F.right(before, F.lit(context)), m, F.left(after, F.lit(context)))),
                    1, SNIPPET_LENGTH).alias("snippet"),
            )

        return F.transform(matches, one)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
               lambda m: let(F.split(text, pattern, -1), lambda g: build(m, g)))
