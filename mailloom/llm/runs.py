"""Periodic runs of words by common extensions over a difference cover.

A run is a stretch of words that repeats itself at a distance q, its smallest
period, is as long as ``min_words`` and ``min_repeats`` * q, and that no
neighbouring word extends.  Texts of an Arrow batch lie side by side, each
closed by a code of its own, so no run crosses from one text into the next.

1. Harmonic grid.  A run of period p covers ``min_repeats`` places that are
   multiples of p, which all hold the same word.  So for every p only the
   multiples of p are looked at: n / p places, n log n in all.
2. Extensions.  How far the words at two such places agree, forwards and
   backwards, tells the run.  Only suffixes at places whose remainder belongs to
   a difference cover are sorted.  For any two places a shift of less than the
   modulus takes both into the cover: so few words are compared directly, and
   what follows is a minimum over the longest common prefixes of neighbours in
   suffix order, which a sparse table gives.
3. Equal stretches found with several periods belong to the smallest one.

Texts in which no two grid places agree over eight words have no run and are
never sorted.  Everything stays in the row: one pass, no shuffle.  A task holds
about ``_BLOCK`` bytes of texts, or one text if that is longer.

Null, empty and blank texts have no words and no runs; the collapsed text of a
null text is null.  Repeated rows give repeated results, and an empty table
none.  Other columns are passed on under their names, whatever these are.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_WORD, text_blocks

MIN_WORDS, MIN_REPEATS = 24, 3
#: Every remainder of the modulus is a difference of two members of the cover.
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
_BLOCK = 6_000_000
_NEAR = 8
_CANDIDATES = 400_000
_WORD = re.compile(SPACE_WORD)


def agreement(words: np.ndarray, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """How many words, up to ``limit``, agree from the places i and j on."""
    out, live = limit.copy(), np.flatnonzero(limit > 0)
    for step in range(int(limit.max(initial=0))):
        same = words[i[live] + step] == words[j[live] + step]
        out[live[~same]] = step
        live = live[same]
        live = live[limit[live] > step + 1]
        if not len(live):
            break
    return out


class Extensions:
    """Longest common extensions of the suffixes of a sequence of codes, no two suffixes being equal."""

    def __init__(self, words: np.ndarray):
        v, n = MODULUS, len(words)
        self.blocks = n // v + 3
        self.words = np.concatenate((words, words.max(initial=0) + 1 + np.arange(v * (self.blocks + 2) - n)))
        self.member = np.full(v, -1)
        self.member[list(COVER)] = np.arange(len(COVER))
        self.shift_to = np.zeros(v, np.int64)
        for a in COVER:
            for b in COVER:
                self.shift_to[(b - a) % v] = a
        at = (np.array(COVER)[:, None] + v * np.arange(self.blocks)[None, :]).ravel()
        self.rank, neighbours = self._sorted(at)
        table = [neighbours]
        while len(table[-1]) > 1 << len(table) - 1:
            half = 1 << len(table) - 1
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self.table = table

    def _sorted(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each sampled suffix, and the common prefixes of neighbours in that order."""
        m, base = len(at), int(self.words.max()) + 1
        rank, t = np.zeros(m, np.int64), 0
        while t < MODULUS:  # the first words, as many at once as fit into a code
            key, top = rank, int(rank.max()) + 1
            while t < MODULUS and top < (1 << 62) // base:
                key, top, t = key * base + self.words[at + t], top * base, t + 1
            rank = np.unique(key, return_inverse=True)[1]
        levels, step = [rank], 1
        while int(rank.max()) < m - 1:  # twice as many blocks of the same remainder
            after = np.zeros(m, np.int64)
            grid = after.reshape(len(COVER), -1)
            if step < self.blocks:
                grid[:, :-step] = rank.reshape(len(COVER), -1)[:, step:] + 1
            rank = np.unique(rank * (m + 1) + after, return_inverse=True)[1]
            levels.append(rank)
            step *= 2
        order = np.empty(m, np.int64)
        order[rank] = np.arange(m)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(m - 1, np.int64)
        for k in range(len(levels) - 1, -1, -1):
            same = np.flatnonzero(levels[k][a] == levels[k][b])
            a[same] += 1 << k
            b[same] += 1 << k
            common[same] += MODULUS << k
        rest = agreement(self.words, at[a], at[b], np.full(m - 1, MODULUS))
        return rank, common + rest

    def _index(self, at: np.ndarray) -> np.ndarray:
        own = self.member[at % MODULUS]
        return own * self.blocks + (at - np.array(COVER)[own]) // MODULUS

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The number of words that agree from the places i and j on; i and j differ."""
        shift = (self.shift_to[(j - i) % MODULUS] - i) % MODULUS
        out = agreement(self.words, i, j, shift)
        far = np.flatnonzero(out == shift)
        a, b = (self.rank[self._index(x[far] + shift[far])] for x in (i, j))
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(float))[1] - 1
        found = np.empty(len(far), np.int64)
        for k in np.unique(level):
            own = np.flatnonzero(level == k)
            found[own] = np.minimum(self.table[k][low[own]], self.table[k][high[own] - (1 << k)])
        out[far] += found
        return out


def grid_candidates(words: np.ndarray, longest: int, repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of multiples of each period from which ``repeats`` multiples hold the same word."""
    places, periods, held = [], [], 0
    for p in range(1, longest // repeats + 1):
        grid = words[::p]
        same = grid[1:] == grid[:-1]
        span = len(same) - (repeats - 2)
        if span <= 0:
            break
        all_same = same[:span].copy()
        for k in range(1, repeats - 1):
            all_same &= same[k:k + span]
        found = np.flatnonzero(all_same)
        if len(found):
            places.append(found * p)
            periods.append(np.full(len(found), p))
            held += len(found)
        if held >= _CANDIDATES:
            yield np.concatenate(places), np.concatenate(periods)
            places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def _joined(texts: list[np.ndarray], codes: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts side by side, each closed by a code of its own, and where each starts."""
    parts = [x for k, t in enumerate(texts) for x in (t, [codes + k])]
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64), np.cumsum(sizes) - sizes


def find_runs(texts: list[np.ndarray], codes: int, min_words: int = MIN_WORDS,
              min_repeats: int = MIN_REPEATS) -> list[np.ndarray]:
    """Rows (start, length, period) of each text of word codes below ``codes``, by start and period."""
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    if min_repeats < 2 or min_words < 2 * _NEAR:
        raise ValueError("runs need two repeats or more and 16 words or more")
    long = [k for k, t in enumerate(texts) if len(t) >= min_words]
    # Without eight words that agree on one side, two places extend by fewer than 16 words in all.
    words, start = _joined([texts[k] for k in long], codes)
    padded = np.concatenate((-1 - np.arange(_NEAR), words, -1 - _NEAR - np.arange(_NEAR)))
    longest = max((len(texts[k]) for k in long), default=0)
    marked = np.zeros(len(long), bool)
    for i, p in grid_candidates(words, longest, min_repeats):
        eight = np.full(len(i), _NEAR)
        ahead = agreement(padded, i + _NEAR, i + p + _NEAR, eight)
        behind = agreement(padded[::-1], len(padded) - _NEAR - i, len(padded) - _NEAR - i - p, eight)
        hit = (ahead == _NEAR) | (behind == _NEAR) | (ahead + behind + p >= np.maximum(min_words, min_repeats * p))
        marked[np.searchsorted(start, i[hit], side="right") - 1] = True
    long = [k for k, m in zip(long, marked) if m]
    if not long:
        return out
    words, start = _joined([texts[k] for k in long], codes)
    ahead, behind = Extensions(words), Extensions(words[::-1])
    found = []
    for i, p in grid_candidates(words, max(len(texts[k]) for k in long), min_repeats):
        left = i - behind.common(len(words) - i, len(words) - i - p)
        right = i + p + ahead.common(i, i + p)
        good = right - left >= np.maximum(min_words, min_repeats * p)
        found.append(np.unique(np.stack((left[good], right[good], p[good]), 1), axis=0))
    every = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)
    first = np.ones(len(every), bool)
    first[1:] = (every[1:, :2] != every[:-1, :2]).any(1)
    every = every[first]
    owner = np.searchsorted(start, every[:, 0], side="right") - 1
    for k in np.unique(owner):
        own = every[owner == k]
        own = np.stack((own[:, 0] - start[k], own[:, 1] - own[:, 0], own[:, 2]), 1)
        out[long[k]] = own[np.lexsort((own[:, 2], own[:, 0]))]
    return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words no run contains after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


def strongest(runs: np.ndarray) -> int:
    """The index of the run with the greatest exact length / period, then the smallest start and period."""
    ratio = runs[:, 1] / runs[:, 2]
    near = np.flatnonzero(ratio >= ratio.max() * (1 - 1e-9))
    return int(min(near, key=lambda k: (-Fraction(int(runs[k, 1]), int(runs[k, 2])), runs[k, 0], runs[k, 2])))


def repeat_tail(key: object, words: list[str]) -> list[str]:
    """Writes periodic tails into a tenth of the texts, chosen by the crc32 of the decimal key (null: empty)."""
    h, n = zlib.crc32(b"" if key is None else str(key).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a:a + p]
    return words[:a] + (cycle * ((n - a) // p + 1))[:n - a]


_OUT = "n_words long, runs array<struct<start: long, length: long, period: long>>, strongest int, collapsed string"


def _flat(runs: list[np.ndarray]) -> pa.ListArray:
    rows = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
    struct = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], names=["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, runs)]), pa.int32()), struct)


def collapse_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (),
                  change: Callable[[object, list[str]], list[str]] | None = None,
                  min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """One row per document: id, ``keep``, n_words, its runs by start and period, the index of the strongest
    run (null: none) and the words left, joined by one space.  ``change`` rewrites (id, words) first."""
    keys = [doc_id, *keep]
    source = docs.select(F.col(text).cast("string").alias("_text"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    schema = ", ".join(f"_k{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, _BLOCK):
            texts = batch.column(0).to_pylist()
            words = [_WORD.findall(t or "") for t in texts]
            if change:
                words = [change(k, w) for k, w in zip(batch.column(1).to_pylist(), words)]
            codes: dict[str, int] = {}
            numbered = [np.fromiter((codes.setdefault(x, len(codes)) for x in w), np.int64, len(w)) for w in words]
            runs = find_runs(numbered, len(codes), min_words, min_repeats)
            left = []
            for t, w, r in zip(texts, words, runs):
                if len(r):
                    w = [x for x, k in zip(w, kept_words(len(w), r).tolist()) if k]
                left.append(None if t is None else " ".join(w))
            best = [strongest(r) if len(r) else None for r in runs]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(list(map(len, words)), pa.int64()), _flat(runs),
                 pa.array(best, pa.int32()), pa.array(left, pa.string())],
                names=[*batch.schema.names[1:], "n_words", "runs", "strongest", "collapsed"])

    return source.mapInArrow(run, f"{schema}, {_OUT}").withColumnsRenamed({f"_k{i}": k for i, k in enumerate(keys)})
