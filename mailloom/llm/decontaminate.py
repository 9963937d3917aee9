"""Benchmark decontamination with suffix arrays over shards of the training text.

A shard is a slice of an Arrow batch.  Its words become numbers of the
benchmark vocabulary; stretches without a stretch of benchmark words long
enough for any window are left out, since no window can occur there.  A word
suffix array (prefix doubling) is built over the rest, and every suffix of
every benchmark item is binary-searched in it, word by word, all at once.  The
interval that is left after the window length gives all places of the window,
and going on gives the longest verbatim match.

Documents are never shuffled, so copies and hot passages stay where they are.
The benchmark is sent to the tasks in blocks of bounded size, one pass each.

Null text has no words, an item without words has no window, repeated rows and
items change nothing, and an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_blocks

WINDOW = 10
BLOCK_BYTES = 8_000_000
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 or 65 <= c <= 90 else 32
              for c in range(256))


def word_bytes(text: str | None) -> list[bytes]:
    """Words after lower-casing A-Z, as UTF-8: runs of a-z, 0-9 and what is outside ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def suffix_array(seq: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``seq`` ordered by their next ``depth`` numbers at least (prefix doubling)."""
    n = len(seq)
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64) + 1
    order = np.argsort(rank, kind="stable")
    k = 1
    while k < depth and n:
        after = np.zeros(n, np.int64)
        after[:n - k] = rank[k:] if k < n else 0
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([1], 1 + np.cumsum(np.diff(key[order]) != 0)))
        rank, k = new, 2 * k
        if rank.max() == n:
            break
    return order


class TestSuffixes:
    """The suffixes of a block of benchmark items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        items = [(i, w) for i, w in items if w]
        self.names = list(dict.fromkeys(i for i, _ in items))  # rows with equal ids are one item
        number = {name: k for k, name in enumerate(self.names)}
        self.vocab = {w: k for k, w in enumerate(dict.fromkeys(w for _, ws in items for w in ws))}
        self.shortest = min((min(window, len(w)) for _, w in items), default=0)
        self.longest = max((len(w) for _, w in items), default=0)
        start, item, need, end, words, at = [], [], [], [], [], 0
        for name, ws in items:
            need_k = min(window, len(ws))
            for p in range(len(ws) - need_k + 1):
                start.append(at + p)
                item.append(number[name])
                need.append(need_k)
                end.append(at + len(ws))
            words.extend(self.vocab[w] for w in ws)
            at += len(ws)
        self.start, self.item, self.need, self.end = (np.array(x, np.int64) for x in (start, item, need, end))
        self.words = np.array(words, np.int64)

    def search(self, seq: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each depth: (depth, tests, lo, hi, order) of the test suffixes that still match."""
        order = suffix_array(seq, self.longest)
        padded = np.concatenate((seq, np.full(self.longest + 1, -1, np.int64)))
        live = np.arange(len(self.start))
        lo, hi = np.zeros(len(live), np.int64), np.full(len(live), len(seq), np.int64)
        for depth in range(self.longest):
            inside = self.start[live] + depth < self.end[live]
            live, lo, hi = live[inside], lo[inside], hi[inside]
            if not len(live):
                return
            word = self.words[self.start[live] + depth]
            lo = _bound(padded, order, lo, hi, depth, word)
            hi = _bound(padded, order, lo, hi, depth, word + 1)
            found = lo < hi
            live, lo, hi = live[found], lo[found], hi[found]
            yield depth + 1, live, lo, hi, order


def _bound(seq, order, lo, hi, depth, word):
    """First place in [lo, hi) of the suffix order whose number at ``depth`` is not below ``word``."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        below = np.zeros(len(lo), bool)
        below[open_] = seq[order[mid[open_]] + depth] < word[open_]
        lo = np.where(open_ & below, mid + 1, lo)
        hi = np.where(open_ & ~below, mid, hi)


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the intervals and the interval each belongs to."""
    n = hi - lo
    owner = np.repeat(np.arange(len(n)), n)
    return lo[owner] + np.arange(n.sum()) - (np.cumsum(n) - n)[owner], owner


def match_shard(texts: list[str | None], tests: TestSuffixes) -> list[tuple[int, list[int], list[str], int, int]]:
    """For each text: number of words, hit spans (start, stop, ...), items, longest match and its place."""
    words: list[bytes] = []
    counts = []
    for text in texts:
        own = word_bytes(text)
        counts.append(len(own))
        words.extend(own)
        words.append(b"")
    counts = np.array(counts, np.int64)
    first = np.cumsum(counts + 1) - (counts + 1)
    spans: list[list[int]] = [[] for _ in texts]
    items: list[set[int]] = [set() for _ in texts]
    longest, longest_at = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    if tests.names:
        ids = np.fromiter(map(tests.vocab.get, words, repeat(-1)), np.int64, len(words))
        known = ids >= 0
        edges = np.flatnonzero(np.diff(np.concatenate(([False], known, [False]))))
        begin, stop = edges[::2], edges[1::2]
        long_run = stop - begin >= tests.shortest
        place = _spread(begin[long_run], stop[long_run] + 1)[0]  # with the unknown word after each stretch
        seq = ids[place]
        hits = []
        for depth, live, lo, hi, order in tests.search(seq) if len(seq) else ():
            enough = depth >= tests.need[live]
            if not enough.any():
                continue
            at, owner = _spread(lo[enough], hi[enough])
            where = place[order[at]]
            doc = np.searchsorted(first, where, side="right") - 1
            better = np.full(len(texts), -1, np.int64)
            better[doc[::-1]] = where[::-1] - first[doc[::-1]]
            new = (better >= 0) & (longest < depth)
            longest[new], longest_at[new] = depth, better[new]
            exact = depth == tests.need[live[enough]][owner]
            hits.append((where[exact], np.full(exact.sum(), depth), doc[exact], tests.item[live[enough]][owner][exact]))
        if hits:
            where, size, doc, item = (np.concatenate(x) for x in zip(*hits))
            for d, i in np.unique(np.stack((doc, item), 1), axis=0).tolist():
                items[d].add(i)
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, where, 1)
            np.add.at(cover, where + size, -1)
            edges = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(cover) > 0))))
            edges = edges.tolist()
            docs = (np.searchsorted(first, edges[::2], side="right") - 1).tolist()
            for d, a, b in zip(docs, edges[::2], edges[1::2]):
                spans[d] += [a - int(first[d]), b - int(first[d])]
    return [(int(n), s, [tests.names[i] for i in sorted(i)], int(l), int(a))
            for n, s, i, l, a in zip(counts, spans, items, longest, longest_at)]


def _blocks(benchmark: DataFrame, item_id: str, text: str, size: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The benchmark in blocks of bounded size; a block holds one item at least."""
    block, used = [], 0
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    for name, value in rows.toLocalIterator():
        if block and used + len(value) > size:
            yield block
            block, used = [], 0
        block.append((name, word_bytes(value)))
        used += len(value)
    yield block


def _merged(a: list[int], b: list[int]) -> list[int]:
    """Union of two lists of (start, stop) pairs."""
    out: list[int] = []
    for start, stop in sorted([*zip(a[::2], a[1::2]), *zip(b[::2], b[1::2])]):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], stop)
        else:
            out += [start, stop]
    return out


_STATE = "n_words long, spans array<int>, items array<string>, longest long, longest_at long"
_STATE_ARROW = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int64(), pa.int64()]


def _pass(tests, first: bool, last: bool, n_keys: int):
    """A pass over the documents with one block; the text goes on unless it is the last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = tests.value
        for batch in text_blocks(batches):
            found = match_shard(batch.column(0).to_pylist(), held)
            if not first:
                before = list(zip(*[batch.column(n_keys + 1 + i).to_pylist() for i in range(5)]))
                found = [(n, _merged(s, t), sorted({*i, *j}), *max((l, a), (m, b), key=lambda x: x[0]))
                         for (n, s, i, l, a), (_, t, j, m, b) in zip(found, before)]
            columns = list(zip(*found))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1 if last else 0:n_keys + 1], *[pa.array(c, t) for c, t in zip(columns, _STATE_ARROW)]],
                names=[*batch.schema.names[1 if last else 0:n_keys + 1], *[x.split()[0] for x in _STATE.split(", ")]])
    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                       keep: tuple[str, ...] = ("doc_id",), item_id: str = "item_id", item_text: str = "text",
                       window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``keep``, n_words, hit word spans, items, longest match and its place."""
    spark = docs.sparkSession
    df = docs.select(docs[text].cast("string").alias("_text"), *[docs[k].alias(f"_k{i}") for i, k in enumerate(keep)])
    keys = [f"_k{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(keep)]
    blocks = _blocks(benchmark, item_id, item_text, block_bytes)
    block, first = next(blocks), True
    while block is not None:
        after = next(blocks, None)
        tests = spark.sparkContext.broadcast(TestSuffixes(block, window))
        schema = ", ".join([*([] if after is None else ["_text string"]), *keys, _STATE])
        df = df.mapInArrow(_pass(tests, first, after is None, len(keep)), schema)
        block, first = after, False
    return df.withColumnsRenamed({f"_k{i}": k for i, k in enumerate(keep)})


def hit_words() -> Column:
    """Number of words in the hit spans."""
    return F.aggregate(
        F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x).cast("long")),
        F.lit(0).cast("long"), lambda a, x: a + x)
