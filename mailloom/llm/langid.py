"""Language identification of mixed-language text.

Words are scored by hashed character n-grams for every language whose script
can be the word's (script ranges narrow the candidates), and a Viterbi pass
over the words of a document, with a penalty for switching, labels its spans.
The document gets the label of most of its letters.

The n-gram table is fitted on a sample of labelled rows, ``max_rows`` of them
on average, chosen by a hash of the id; it has at most languages x ``buckets``
numbers, so it can be sent to every task.  Prediction is one pass over Arrow
batches without a shuffle; documents of a batch step through the Viterbi
recursion side by side.

Null text, or text without letters, is ``und`` with score 0.  Repeated rows get
equal labels; with no labelled row at all everything is ``und``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_blocks

MAX_ROWS = 20_000
BUCKETS = 1 << 17
ORDERS = (1, 2, 3, 4)
SWITCH_PENALTY = 12.0
WORD_LIMIT = 6.0           # no word counts for more nats than this against a language
SCRIPT_SHARE = 0.01        # a language may be written in a script that holds so much of it
UNDETERMINED = "und"
_WORD = re.compile(r"[^\W\d_]+")
# First code point of each block of letters and its script.
_SCRIPTS = ((0x0, "Latin"), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "Armenian"), (0x590, "Hebrew"),
            (0x600, "Arabic"), (0x700, "Other"), (0x900, "Devanagari"), (0x980, "Bengali"), (0xA00, "Other"),
            (0xE00, "Thai"), (0xE80, "Other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Other"),
            (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x3040, "Kana"), (0x3130, "Hangul"),
            (0x3190, "Kana"), (0x3400, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"),
            (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Other"))
_STARTS = np.array([s for s, _ in _SCRIPTS])
_NAMES = sorted({n for _, n in _SCRIPTS})
_CODES = np.array([_NAMES.index(n) for _, n in _SCRIPTS])


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def script_codes(words: list[str]) -> np.ndarray:
    """Script of the first letter of each word."""
    first = np.fromiter((ord(w[0]) for w in words), np.int64, len(words))
    return _CODES[np.searchsorted(_STARTS, first, side="right") - 1]


def ngrams(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every character n-gram, with marks for the ends of words."""
    chars = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    space = chars == 32
    owner = np.cumsum(space) - 1
    owners, found = [], []
    code = np.zeros(len(chars), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        m = len(chars) - n + 1
        if m <= 0:
            break
        code = code[:m] * np.uint64(1_000_003) + chars[n - 1:]
        ok = ~space[:m] if n == 1 else np.ones(m, bool)
        for k in range(1, n - 1):
            ok &= ~space[k:m + k]
        if n == 2:
            ok &= ~(space[:m] & space[1:])
        if n not in ORDERS:
            continue
        mixed = (code[ok] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        owners.append(owner[:m][ok])
        found.append(((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(found)


class Scorer:
    """Log-probability of words in each language, masked by script."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.languages = languages
        total = counts.sum(0, keepdims=True)
        self.table = np.log((counts + 0.5) / (total + 0.5 * len(counts))).astype(np.float32)
        share = scripts / np.maximum(scripts.sum(0, keepdims=True), 1)
        self.allowed = share >= SCRIPT_SHARE
        self.allowed[~self.allowed.any(1)] = True

    def score(self, words: list[str]) -> np.ndarray:
        owner, bucket = ngrams(words, len(self.table))
        raw = np.stack([np.bincount(owner, self.table[bucket, k], len(words)) for k in range(len(self.languages))], 1)
        raw[~self.allowed[script_codes(words)]] = -np.inf
        raw -= raw.max(1, keepdims=True)
        return np.maximum(raw, -WORD_LIMIT).astype(np.float32)


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best labels of many word sequences, given one after the other, side by side."""
    order = np.argsort(-lengths, kind="stable")
    start = (np.cumsum(lengths) - lengths)[order]
    size = lengths[order]
    k = scores.shape[1]
    own = np.arange(k, dtype=np.int16)
    back = np.empty((len(scores), k), np.int16)
    total = np.zeros((len(order), k), np.float32)
    active = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
    for t, a in enumerate(active):
        at = start[:a] + t
        now = total[:a]
        top = now.argmax(1)
        moved = now[np.arange(a), top][:, None] - penalty
        stay = now >= moved
        back[at] = np.where(stay, own, top[:, None])
        total[:a] = np.where(stay, now, moved) + scores[at]
        if t % 64 == 63:  # keep the sums small
            total[:a] -= total[:a].max(1, keepdims=True)
    labels = np.empty(len(scores), np.int16)
    state = total.argmax(1)
    for t in range(len(active) - 1, -1, -1):
        a = active[t]
        at = start[:a] + t
        labels[at] = state[:a]
        state[:a] = back[at, state[:a]]
    return labels


def _count(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(lang, slot, n): n-gram counts at slot >= 0, script counts at -1 - script."""
    seen: dict[str, Counter] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen.setdefault(lang, Counter()).update(words_of(text))
    for lang, counter in seen.items():
        if not counter:
            continue
        words = list(counter)
        times = np.fromiter(counter.values(), np.float64, len(words))
        owner, bucket = ngrams(words, buckets)
        counts = np.bincount(bucket, times[owner], buckets).astype(np.int64)
        slots = np.flatnonzero(counts)
        scripts = np.bincount(script_codes(words), times, len(_NAMES)).astype(np.int64)
        slot = np.concatenate((slots, -1 - np.arange(len(_NAMES))))
        n = np.concatenate((counts[slots], scripts))
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot)), pa.array(slot), pa.array(n)],
                                         names=["lang", "slot", "n"])


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_on: str = "doc_id",
        max_rows: int = MAX_ROWS, buckets: int = BUCKETS) -> Scorer:
    """Fit on about ``max_rows`` of the labelled rows, chosen by a hash of ``sample_on``."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    n, grain = rows.count(), 1 << 30
    if n > max_rows:
        rows = rows.where(F.pmod(F.xxhash64(sample_on), F.lit(grain)) < F.lit(grain * max_rows // n))
    parts = rows.select(F.col(text).cast("string"), F.col(lang).cast("string")).mapInArrow(
        lambda batches: _count(batches, buckets), "lang string, slot long, n long")
    table = parts.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    names, slot, n = (table.column(c).to_numpy() for c in ("lang", "slot", "n"))
    languages = sorted(set(names.tolist()))
    column = np.searchsorted(np.array(languages, object), names) if languages else np.zeros(0, int)
    counts = np.zeros((buckets, len(languages)), np.float64)
    scripts = np.zeros((len(_NAMES), len(languages)), np.float64)
    up = slot >= 0
    counts[slot[up], column[up]] = n[up]
    scripts[-1 - slot[~up], column[~up]] = n[~up]
    return Scorer(languages, counts, scripts)


class Tagger:
    """Labels the words of texts; remembers the scores of words, in bounded number."""

    def __init__(self, scorer: Scorer, known: int = 150_000):
        self.scorer, self.known = scorer, known
        self.row: dict[str, int] = {}
        self.scores = np.zeros((0, len(scorer.languages)), np.float32)

    def label(self, words: list[str], lengths: np.ndarray) -> np.ndarray:
        new = list(set(words).difference(self.row))
        if new:
            if len(self.row) > self.known:
                self.row, self.scores = {}, self.scores[:0]
                new = list(set(words))
            self.row.update(zip(new, range(len(self.row), len(self.row) + len(new))))
            self.scores = np.concatenate((self.scores, self.scorer.score(new)))
        ids = np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))
        return viterbi(self.scores[ids], lengths)


def identify(docs: DataFrame, scorer: Scorer, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, lang_pred, score (share of letters with that label) and the labelled spans of words."""
    model = docs.sparkSession.sparkContext.broadcast(scorer)
    span = pa.struct([("first_word", pa.int32()), ("words", pa.int32()), ("lang", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model.value)
        names = tagger.scorer.languages
        for batch in text_blocks(batches):
            lists = [words_of(t) if names else [] for t in batch.column(0).to_pylist()]
            lengths = np.array([len(x) for x in lists], np.int64)
            words = list(chain.from_iterable(lists))
            letters = np.fromiter(map(len, words), np.int64, len(words))
            labels = tagger.label(words, lengths) if words else np.zeros(0, np.int16)
            doc = np.repeat(np.arange(len(lists)), lengths)
            k = max(len(names), 1)
            share = np.bincount(doc * k + labels, letters, len(lists) * k).reshape(-1, k)
            whole = share.sum(1)
            best = share.argmax(1)
            edge = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(labels.astype(int), prepend=-1) != 0))
            size = np.diff(np.append(edge, len(words)))
            first = np.cumsum(lengths) - lengths
            spans: list[list[tuple]] = [[] for _ in lists]
            for d, e, n in zip(doc[edge].tolist(), edge.tolist(), size.tolist()):
                spans[d].append((e - int(first[d]), n, names[labels[e]]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:],
                 pa.array([names[b] if w else UNDETERMINED for b, w in zip(best, whole)]),
                 pa.array(np.where(whole > 0, share.max(1) / np.maximum(whole, 1), 0.0)),
                 pa.array(spans, pa.list_(span))],
                names=[*batch.schema.names[1:], "lang_pred", "score", "spans"])

    keys = [f"_k{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(keep)]
    out = docs.select(docs[text].cast("string").alias("_text"), *[docs[k].alias(f"_k{i}") for i, k in enumerate(keep)])
    out = out.mapInArrow(run, ", ".join([*keys, "lang_pred string", "score double",
                                         "spans array<struct<first_word:int,words:int,lang:string>>"]))
    return out.withColumnsRenamed({f"_k{i}": k for i, k in enumerate(keep)})


