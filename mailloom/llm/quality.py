"""Line-first quality rules.

Every line is judged alone by punctuation, navigation and boilerplate rules and
removed if it fails; then the document is rejected if it is too short, too
repetitive or lost more than ``max_lost`` of its characters.  Work stays in the
row: one pass over Arrow batches, no shuffle, so neither copies nor a hot
source matter and a lost task is simply run again.

Null text counts as empty (no words, rejected, cleaned text empty).  Repeated
rows and ties give repeated results.  A very long text or line costs time in
proportion to its length.  An empty table gives an empty result.  Columns in
``keep`` come back under their names, whatever these are, unless a measure has
the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import SPACE_WORD

_WORD = re.compile(SPACE_WORD)
_SYMBOLS = "#*$%&|<>"
_ENDS = (".", "!", "?", '"', "'", ":", ";", ")", "…", "”", "»", "。", "！", "？")
_MARK = re.compile(r"[.!?…。！？]")
_MENU = re.compile(
    r"\s*(?:home|menu|login|log in|sign in|sign up|register|search|next|previous|back|top|share|print|"
    r"skip to (?:main )?content|read more|click here|contact us|about us|site ?map|faq)\s*[.>»|]*\s*$", re.IGNORECASE)
_SEPARATORS = "|»>›•"
_CELLS = re.compile(r"[|»>›•]")
_BOILERPLATE = re.compile(
    r"lorem ipsum|all rights reserved|copyright (?:©|\(c\)|\d{4})|enable javascript|javascript is (?:disabled|required)|"
    r"(?:use|uses|using) (?:of )?cookies|cookie (?:policy|settings|consent)|privacy policy|terms of (?:use|service)|"
    r"subscribe to (?:our|the) newsletter|follow us on|powered by", re.IGNORECASE)


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the document verdict."""

    min_words: int = 50
    max_repeat_percent: int = 50
    bare_words: int = 8         # a line without any sentence mark needs more words than this
    boilerplate_words: int = 40  # a longer line is prose that only mentions such a phrase
    menu_cells: int = 3         # so many short cells between separators make a menu,
    menu_cell_chars: int = 30   # if they are half of the line or more
    min_letter_share: float = 0.35  # letters and digits among the characters that are not blanks
    max_lost: float = 0.5


def is_menu(line: str, rules: LineRules = LineRules()) -> bool:
    """Whether a line is one navigation word, or for the most part short cells between separators."""
    if _MENU.match(line):
        return True
    if sum(map(line.count, _SEPARATORS)) < rules.menu_cells:
        return False
    cells = _CELLS.split(line)
    short = [len(x) for x in cells if 0 < len(x) <= rules.menu_cell_chars]
    return len(short) >= rules.menu_cells and 2 * sum(short) >= sum(map(len, cells))


def line_ok(line: str, rules: LineRules = LineRules()) -> bool:
    """Whether a line stays.  A line without words is layout and stays."""
    words = line.split()
    if not words:
        return True
    bare = line.strip()
    if not bare.endswith(_ENDS) and len(words) <= rules.bare_words and not _MARK.search(bare):
        return False
    if is_menu(line, rules):
        return False
    if len(words) <= rules.boilerplate_words and _BOILERPLATE.search(line):
        return False
    return sum(map(str.isalnum, bare)) >= rules.min_letter_share * (len(bare) - bare.count(" "))


def repeated_words(words: list[str]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes = np.fromiter(map(ids.__getitem__, words), np.int64, n)
    v = len(ids)
    pairs = codes[:-1] * v + codes[1:]
    if v > 2_000_000:  # keep the triple code inside 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    triples = pairs[:-1] * v + codes[2:]
    _, inverse, counts = np.unique(triples, return_inverse=True, return_counts=True)
    twice = counts[inverse] >= 2
    covered = np.zeros(n, bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def judge(text: str | None, rules: LineRules = LineRules()) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lines removed, cleaned)."""
    text = text or ""
    words = _WORD.findall(text)
    n, chars = len(words), sum(map(len, words))
    symbols = sum(map(text.count, _SYMBOLS))
    lines = text.split("\n")
    with_word = [x for x in lines if _WORD.search(x)]
    repeat = repeated_words(words)
    failed = n < rules.min_words or 100 * repeat > rules.max_repeat_percent * n
    verdicts: dict[str, bool] = {}
    kept_lines = []
    for line in lines:
        ok = verdicts.get(line)
        if ok is None:
            ok = verdicts[line] = line_ok(line, rules)
        if ok:
            kept_lines.append(line)
    left = sum(len(x) - x.count(" ") for x in kept_lines)
    total = sum(len(x) - x.count(" ") for x in lines)
    kept = not failed and total - left <= rules.max_lost * total
    return (n, chars, symbols, len(with_word) - len(set(with_word)), repeat, failed, kept,
            len(lines) - len(kept_lines), "\n".join(kept_lines))


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "kept", "n_lines_removed", "clean_text")
_TYPES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " \
         "base_failed boolean, kept boolean, n_lines_removed long, clean_text string"
_ARROW = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64(), pa.string()]


def judge_documents(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                    cleaned: bool = False, rules: LineRules = LineRules()) -> DataFrame:
    """One row per document: the columns in ``keep``, the measures, and the cleaned text if asked for."""
    source = docs.select(docs[text].cast("string").alias("_text"), *[docs[k].alias(f"_k{i}") for i, k in enumerate(keep)])
    n_out = len(_MEASURES) if cleaned else len(_MEASURES) - 1
    measures = ", ".join(_TYPES.split(", ")[:n_out])
    keys = ", ".join(f"_k{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(x, rules)[:n_out] for x in batch.column(0).to_pylist()]
            columns = list(zip(*rows)) if rows else [()] * n_out
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *[pa.array(c, t) for c, t in zip(columns, _ARROW)]],
                names=[*batch.schema.names[1:], *_MEASURES[:n_out]])

    out = source.mapInArrow(run, f"{keys}, {measures}" if keys else measures)
    return out.withColumnsRenamed({f"_k{i}": k for i, k in enumerate(keep)})
