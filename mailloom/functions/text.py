"""String helpers shared by the other modules (Column -> Column)."""

from __future__ import annotations

import re
from collections.abc import Callable, Hashable, Iterable, Mapping

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as a Unicode-aware strip() sees it; the second form goes inside [...].
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WS = r"\p{IsWhite_Space}\x1c-\x1f"
_REGEX_SPECIAL = re.compile(r"([\\.^$|?*+()\[\]{}\-])")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    Projections that mention an expensive expression several times may be
    merged and then evaluate it several times; a lambda variable never is.
    """
    return F.transform(F.array(value), body)[0]


_BUILT: dict[Hashable, Column] = {}


def built_once(key: Hashable, build: Callable[[], Column]) -> Column:
    """A large expression over fixed column names, built once per Spark context.

    Expressions are immutable and not tied to a table; building one with
    thousands of nodes takes seconds, which would be paid in every micro-batch.
    """
    context = SparkContext._active_spark_context
    full_key = (None if context is None else context.applicationId, key)
    if full_key not in _BUILT:
        for old in [k for k in _BUILT if k[0] != full_key[0]]:
            del _BUILT[old]
        _BUILT[full_key] = build()
    return _BUILT[full_key]


def strip(c: Column) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.btrim(c, F.lit(WS_CHARS))


def regex_quote(text: str) -> str:
    """Quote text for use inside a Java regular expression."""
    return _REGEX_SPECIAL.sub(r"\\\1", text)


def any_of(words: Iterable[str]) -> str:
    """A regular expression alternation of literal words."""
    return "(?:" + "|".join(regex_quote(w) for w in words) + ")"


def contains_any(c: Column, words: Iterable[str]) -> Column:
    """True where ``c`` holds one of the words as a substring."""
    words = list(words)
    return c.rlike(any_of(words)) if words else F.lit(False)


def csv_safe(c: Column) -> Column:
    """Quote values a spreadsheet would run as a formula."""
    return F.when(c.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), c)).otherwise(c)


def yes_no(flag: Column) -> Column:
    """Boolean to Yes/No text; NULL counts as No."""
    return F.when(flag, F.lit("Yes")).otherwise(F.lit("No"))


def is_yes(text: Column) -> Column:
    """Yes/No text to boolean."""
    return F.coalesce(F.lower(F.trim(text)) == "yes", F.lit(False))


def literal_map(values: Mapping[str, str]) -> Column:
    """A small dictionary as a map; the engine folds it into one constant."""
    pairs = "\x02".join(f"{k}\x03{v}" for k, v in values.items())
    return F.str_to_map(F.lit(pairs), F.lit("\x02"), F.lit("\x03"))


def fill_template(template: Column | str, fields: Mapping[str, Column]) -> Column:
    """Replace each ``{{name}}`` (or ``{{ $json.name }}``) by a field, NULL by ''.

    Fields are filled from left to right over the pieces of the original
    template, so braces inside a value are never expanded again.
    """
    body = template if isinstance(template, Column) else F.lit(template)
    values = F.create_map(
        *[x for name, col in fields.items()
          for x in (F.lit(name), F.coalesce(col.cast("string"), F.lit("")))]
    )

    def piece(part: Column, i: Column) -> Column:
        name = F.regexp_replace(F.trim(F.substring_index(part, "}}", 1)), r"^\$json\.", "")
        rest = F.substr(part, F.instr(part, "}}") + F.lit(2))
        known = F.contains(part, F.lit("}}")) & F.map_contains_key(values, name)
        return (
            F.when(i == 0, part)
            .when(known, F.concat(F.element_at(values, name), rest))
            .otherwise(F.concat(F.lit("{{"), part))
        )

    return F.array_join(F.transform(F.split(body, r"\{\{", -1), piece), "")
