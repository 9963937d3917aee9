"""Text of page bytes in the charset the page declares.

A byte order mark decides, then the charset of the transport header, then a
``<meta>`` tag in the first 1024 bytes; without any, valid UTF-8 is UTF-8 and
everything else Latin-1.  Code pages of one byte per character are read as
Latin-1, which gives every byte a character of its own, and translated by the table of
the code page.  What is no character in the declared charset becomes U+FFFD.
"""

from __future__ import annotations

from encodings import aliases

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, literal_map

_FAMILIES = ("cp125", "iso8859_", "latin_1", "koi8_", "cp866", "cp874", "tis_620", "mac_roman", "mac_cyrillic")
_PRESCAN = 1024
_META = r"""(?is)<meta[\s/][^>]*?charset\s*=\s*["']?\s*([^\s"'/>;]+)"""
_HEADER = r"""(?i)charset\s*=\s*["']?\s*([^\s"';,]+)"""


def _code_pages() -> dict[str, tuple[str, str]]:
    """Characters of Latin-1 and what stands for them, of each code page of one byte."""
    latin, out = bytes(range(256)).decode("latin-1"), {}
    for name in sorted({*aliases.aliases.values()}):
        if name.startswith(_FAMILIES):
            own = bytes(range(256)).decode(name, "replace")
            other = [(a, b) for a, b in zip(latin, own) if a != b]
            out[name] = ("".join(a for a, _ in other), "".join(b for _, b in other))
    return out


CODE_PAGES = _code_pages()


def _labels() -> dict[str, str]:
    """Every name of the charsets read here, in lower case with '_' for all other signs."""
    known = {*CODE_PAGES, "utf_8", "utf_16", "utf_16_be", "utf_16_le", "ascii"}
    return {k: v for k, v in aliases.aliases.items() if v in known} | {k: k for k in known} | {
        "utf8": "utf_8", "utf_16be": "utf_16_be", "utf_16le": "utf_16_le"}


LABELS = _labels()


def charset_of(label: Column) -> Column:
    """The charset a label names, NULL if it is not read here."""
    name = F.btrim(F.regexp_replace(F.lower(label), r"[^a-z0-9]+", "_"), F.lit("_"))
    return F.try_element_at(literal_map(LABELS), name)


def declared_charset(content: Column, content_type: Column | None = None) -> Column:
    """The charset of page bytes by byte order mark, header and ``<meta>``; NULL if none is declared.

    ``content_type`` is the header's value, or the bare label.
    """
    start = F.hex(F.substring(content, 1, 3))
    mark = (F.when(start == "EFBBBF", "utf_8").when(F.startswith(start, F.lit("FFFE")), "utf_16_le")
            .when(F.startswith(start, F.lit("FEFF")), "utf_16_be"))
    head = F.decode(F.substring(content, 1, _PRESCAN), "ISO-8859-1")
    meta = F.regexp_extract(head, _META, 1)
    # A tag that could be read one byte at a time is not UTF-16.
    found = let(charset_of(F.when(meta != "", meta)), lambda c: F.when(F.startswith(c, F.lit("utf_16")), "utf_8").otherwise(c))
    if content_type is None:
        return F.coalesce(mark, found)
    named = F.regexp_extract(content_type, _HEADER, 1)
    bare = F.when(~content_type.rlike(r"[/=]"), content_type)
    return F.coalesce(mark, charset_of(F.coalesce(F.when(named != "", named), bare)), found)


def _utf16(content: Column, little: bool) -> Column:
    """UTF-16 without its mark; NULL if a surrogate stands alone, which the engine refuses to read."""
    whole = F.substr(content, F.lit(1), (F.octet_length(content) - F.octet_length(content) % 2))
    pair = "..D[89AB]..D[C-F]|..(?!D[89A-F]).." if little else "D[89AB]..D[C-F]..|(?!D[89A-F])...."
    text = F.decode(whole, "UTF-16LE" if little else "UTF-16BE")
    return F.when(F.hex(whole).rlike(f"^(?:{pair})*+$"), F.regexp_replace(text, "^﻿", ""))


def undeclared(content: Column) -> Column:
    """Text of raw bytes: UTF-8 if valid, else Latin-1, which always succeeds."""
    return F.coalesce(F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1"))


def decode_page(content: Column, content_type: Column | None = None) -> Column:
    """Text of page bytes in the declared charset, without a byte order mark."""
    def read(charset: Column) -> Column:
        latin = F.decode(content, "ISO-8859-1")
        utf8 = F.regexp_replace(F.make_valid_utf8(content.cast("string")), "^﻿", "")
        out = F.when(charset == "utf_8", utf8).when(charset == "utf_16_le", _utf16(content, True))
        out = out.when(charset == "utf_16", _utf16(content, True)).when(charset == "utf_16_be", _utf16(content, False))
        for name, (has, means) in CODE_PAGES.items():
            out = out.when(charset == name, F.translate(latin, has, means) if has else latin)
        out = out.when(charset == "ascii", F.regexp_replace(latin, "[\x80-\xff]", "�"))
        return F.coalesce(out, undeclared(content))

    return F.when(content.isNotNull(), let(declared_charset(content, content_type), read))
