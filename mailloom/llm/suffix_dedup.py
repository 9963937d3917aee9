"""Removal of repeated byte strings by longest-previous-factor arrays.

A byte goes if a string of ``length`` bytes around it also starts earlier, in
the order of ids and then of places.  Documents are dealt into blocks that
follow this order, so comparing block numbers compares places.

1. Anchors.  Of every window of ``length`` bytes the smallest hash of its
   strings of half that length marks an anchor; equal windows have their anchor
   at the same place.  Blocks send the hash of each anchor and of the bytes
   around it, once per block and kind, to the owners of ranges of the hash.
   An anchor whose surroundings occurred before is settled: they are repeated
   as a whole.  An anchor that never occurs in other surroundings has no
   earlier match.  Only what is between is looked at further.
2. Suffixes.  For the windows of those anchors a block builds a suffix array
   (prefix doubling over its segments, up to ``length`` bytes) and from the
   previous and next smaller positions in its order the longest previous factor of each
   suffix; one of ``length`` bytes is an earlier match.  Suffixes without it in their
   block go, as the hash of their prefix, to the owners of hash ranges, which find
   the previous smaller block with the same prefix.
3. Each block puts the answers together and cuts its documents.

A passage that very many documents share is sent once per block, never
gathered.  Hashes have 64 bits, those of surroundings 48 under an equal anchor.

Null text counts as empty and stays null; rows with a null id come before all
others; repeated rows follow one another, so the first one stays.  A text longer
than a block, or rows with one id that are, make a larger block.  An empty table
gives an empty result.  Other columns are passed on under their names, whatever these are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import giving_back, shuffle_partitions
from .minhash import _BYTE, _P, _P_INV, mix

LENGTH = 100
BLOCK_BYTES = 4_000_000
_SLICE = 1_000_000
_RANGE_BYTES = 16_000_000
_CLUSTER = 500_000
_NONE, _SETTLED, _OPEN = 0, 1, 2


class Powers:
    """Powers of the hash base and of its inverse, as long as needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = np.full(n, _P), np.full(n, _P_INV)
            self.up[0] = self.down[0] = 1
            np.cumprod(self.up, out=self.up)
            np.cumprod(self.down, out=self.down)
        return self.up[:n], self.down[:n]


_POWERS = Powers()


@dataclass
class Slice:
    """Documents that lie side by side in memory, their anchors, and the anchor of each window."""

    data: np.ndarray
    start: np.ndarray          # of each document
    stop: np.ndarray
    left: np.ndarray           # surroundings of each anchor
    right: np.ndarray
    anchor: np.ndarray         # hash of each anchor
    around: np.ndarray         # 48-bit hash of its surroundings
    window: np.ndarray         # places of the windows
    own: np.ndarray            # index of each window's anchor
    summed: np.ndarray
    cover: np.ndarray          # +1 and -1 where repeated stretches start and stop

    def hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the strings of ``length`` bytes at the given places."""
        down = _POWERS.of(len(self.summed))[1]
        return mix((self.summed[at + length] - self.summed[at]) * down[at])

    def mark(self, left: np.ndarray, right: np.ndarray | int) -> None:
        np.add.at(self.cover, left, 1)
        np.add.at(self.cover, right, -1)


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest value of each stretch of ``width`` values."""
    low, at, k = h, np.arange(len(h), dtype=np.int32), 1
    while k < width:
        step = min(k, width - k)
        first = low[:-step] <= low[step:]
        at = np.where(first, at[:-step], at[step:])
        low = np.minimum(low[:-step], low[step:])
        k += step
    return at


def make_slice(texts: list[bytes], length: int) -> Slice:
    data = np.frombuffer(b"".join(texts), np.uint8)
    n, half = len(data), length // 2
    stop = np.cumsum([len(t) for t in texts]).astype(np.int64)
    start = np.concatenate(([0], stop[:-1]))
    up, down = _POWERS.of(n + 1)
    summed = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=summed[1:])
    none = np.zeros(0, np.int64)
    out = Slice(data, start, stop, none, none, none.view(np.uint64), none.view(np.uint64), none, none, summed,
                np.zeros(n + 1, np.int32))
    if n < length:
        return out
    h = mix((summed[half:] - summed[:-half]) * down[:n - half + 1])
    first = _smallest(h, length - half + 1)
    end = np.repeat(stop, stop - start)
    out.window = np.flatnonzero(np.arange(n - length + 1) + length <= end[:n - length + 1]).astype(np.int32)
    if not len(out.window):
        return out
    at = first[out.window].astype(np.int64)
    new = np.concatenate(([True], at[1:] != at[:-1]))
    out.own = np.cumsum(new, dtype=np.int32) - 1
    at = at[new]
    begin = np.repeat(start, stop - start)[at]
    out.left, out.right = np.maximum(begin, at - (length - half)), np.minimum(end[at], at + length)
    shape = (at - out.left).astype(np.uint64) * np.uint64(1 << 20) + (out.right - at).astype(np.uint64)
    out.anchor = h[at]
    out.around = mix((summed[out.right] - summed[out.left]) * down[out.left] + mix(shape)) >> np.uint64(16)
    return out


def make_slices(texts: list[bytes], length: int) -> Iterator[Slice]:
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= _SLICE):
            size += len(texts[j])
            j += 1
        yield make_slice(texts[i:j], length)
        i = j


def _kinds(slices: list[Slice]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The block's distinct (anchor, surroundings) in the order of the anchors' mixed hashes, and for
    each anchor place its kind and whether it is the first of it."""
    anchor = np.concatenate([s.anchor for s in slices]) if slices else np.zeros(0, np.uint64)
    around = np.concatenate([s.around for s in slices]) if slices else np.zeros(0, np.uint64)
    key = mix(anchor ^ (around * np.uint64(0x9E3779B97F4A7C15)))
    _, index, inverse = np.unique(key, return_index=True, return_inverse=True)
    order = np.argsort(mix(anchor[index]), kind="stable")  # an anchor is a minimum, so most are small numbers
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    first = np.zeros(len(anchor), bool)
    first[index] = True
    return anchor[index][order], around[index][order], place[inverse], first


def _range_edges(hashes: np.ndarray, ranges: int) -> list[int]:
    """Where the ranges of equal width start in sorted hashes."""
    owner = (hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
    return np.searchsorted(owner, np.arange(ranges + 1)).tolist()


_ROWS = "_block int, _range int, _kind int, _hashes binary, _more binary"
_ROWS_ARROW = pa.schema([("_block", pa.int32()), ("_range", pa.int32()), ("_kind", pa.int32()),
                         ("_hashes", pa.binary()), ("_more", pa.binary())])


def _rows(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * 5
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROWS_ARROW)], schema=_ROWS_ARROW)


def _ordered(block: pa.Table) -> tuple[pa.Table, list[bytes]]:
    block = block.sort_by([("_order", "ascending"), ("_text", "ascending")])
    return block, [x or b"" for x in block.column("_text").to_pylist()]


def _ask_anchors(length: int, ranges: int):
    def run(block: pa.Table) -> pa.Table:
        number = block.column("_block")[0].as_py()
        _, texts = _ordered(block)
        slices = []
        for s in make_slices(texts, length):
            s.data = s.summed = s.window = s.own = s.cover = None  # only the anchors are needed
            slices.append(s)
        anchor, around, _, _ = _kinds(slices)
        edge = _range_edges(mix(anchor), ranges)
        six = around.view(np.uint8).reshape(-1, 8)[:, :6]
        return _rows([(number, k, 1, anchor[a:b].tobytes(), six[a:b].tobytes())
                      for k, (a, b) in enumerate(zip(edge[:-1], edge[1:])) if a < b])
    return run


def _answer_anchors(asked: pa.Table) -> pa.Table:
    """For each kind of each block: settled, open, or without an earlier match."""
    parts = [np.frombuffer(x, np.uint64) for x in asked.column("_hashes").to_pylist()]
    sizes = [len(p) for p in parts]
    anchor = np.concatenate(parts)
    around = np.zeros((len(anchor), 8), np.uint8)
    around[:, :6] = np.frombuffer(b"".join(asked.column("_more").to_pylist()), np.uint8).reshape(-1, 6)
    around = around.view(np.uint64).ravel()
    blocks = asked.column("_block").to_numpy()
    order = np.lexsort((np.repeat(blocks, sizes), around, anchor))
    a, c = anchor[order], around[order]
    new = np.concatenate(([True], a[1:] != a[:-1]))
    kind = new | np.concatenate(([True], c[1:] != c[:-1]))
    run = np.cumsum(new) - 1
    several = np.bincount(run, kind)[run] > 1
    code = np.empty(len(a), np.uint8)
    code[order] = np.where(kind, np.where(several, _OPEN, _NONE), _SETTLED)
    stop = np.cumsum(sizes)
    ranges = asked.column("_range").to_pylist()
    return _rows([(int(b), r, 1, None, code[e - n:e].tobytes()) for b, r, n, e in zip(blocks, ranges, sizes, stop)])


def _concatenated(replies: pa.Table, kind: int) -> bytes:
    rows = zip(replies.column("_kind").to_pylist(), replies.column("_range").to_pylist(), replies.column("_more").to_pylist())
    return b"".join(m for _, _, m in sorted(((k, r, m) for k, r, m in rows if k == kind), key=lambda x: x[1]))


def _settle(slices: list[Slice], code: np.ndarray) -> list[np.ndarray]:
    """Marks settled surroundings; returns for each slice its windows at open anchors."""
    _, _, kind, first = _kinds(slices)
    code = np.where(first, code[kind] if len(code) else 0, _SETTLED)
    open_, at = [], 0
    for s in slices:
        own = code[at:at + len(s.anchor)]
        at += len(s.anchor)
        done = own == _SETTLED
        s.mark(s.left[done], s.right[done])
        open_.append(s.window[own[s.own] == _OPEN].astype(np.int64) if len(s.window) else s.window.astype(np.int64))
        s.window = s.own = None
    return open_


def suffix_ranks(data: np.ndarray, length: int) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
    """Ranks of all suffixes by their first 8, 16, .. bytes, by prefix doubling, and the first 8 bytes themselves."""
    n, k = len(data), 8
    value = np.zeros(n, np.uint64)
    padded = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    for i in range(8):
        value = (value << np.uint64(8)) | padded[i:n + i]
    levels = [(k, np.unique(value, return_inverse=True)[1].astype(np.int32))]
    while 2 * k <= length:
        after = np.zeros(n, np.int64)
        after[:n - k] = levels[-1][1][k:]
        levels.append((2 * k, np.unique(levels[-1][1] * np.int64(n + 1) + after, return_inverse=True)[1].astype(np.int32)))
        k *= 2
    return levels, value


def common_prefixes(levels: list[tuple[int, np.ndarray]], data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """How many bytes, up to ``length``, the suffixes at the places a and b share; both have so many."""
    out = np.zeros(len(a), np.int64)
    for k, rank in reversed(levels):
        for _ in range(max(1, length // k) if k == levels[-1][0] else 1):
            live = np.flatnonzero(out + k <= length)
            same = live[rank[a[live] + out[live]] == rank[b[live] + out[live]]]
            out[same] += k
    for _ in range(levels[0][0]):
        live = np.flatnonzero(out < length)
        same = live[data[a[live] + out[live]] == data[b[live] + out[live]]]
        if not len(same):
            break
        out[same] += 1
    return out


def _to_smaller(place: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each suffix, in suffix order, the prefix it shares with the nearest one before it that has a smaller place.

    ``common[i]`` is shared by the suffixes i - 1 and i.  Sparse tables of least places and least prefixes
    are walked from wide to narrow, for all suffixes at once.
    """
    m = len(place)
    least, shared = [place], [common]
    while 1 << len(least) < m:
        half = 1 << len(least) - 1
        least.append(np.minimum(least[-1][:-half], least[-1][half:]))   # of the stretch that starts here
        shared.append(np.minimum(shared[-1][:-half], shared[-1][half:]))
    end, out = np.arange(m), np.full(m, 255, np.uint8)  # all places from ``end`` to the suffix are larger
    for k in range(len(least) - 1, -1, -1):
        live = np.flatnonzero(end >= 1 << k)
        first = end[live] - (1 << k)
        skip = least[k][first] > place[live]
        live, first = live[skip], first[skip]
        out[live] = np.minimum(out[live], shared[k][first + 1])
        end[live] = first
    found = end > 0
    out[found] = np.minimum(out[found], common[end[found]])
    out[~found] = 0
    return out


def longest_previous_factors(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The longest prefix, up to ``length`` (at most 255) bytes, of each suffix that starts earlier as well.

    ``at`` rises, and every suffix has ``length`` bytes.  In suffix order the earlier suffix that shares most is that at the
    previous or at the next smaller place.  Prefixes of less than 16 bytes count as 0, so the order falls into
    clusters that are walked apart.
    """
    levels, value = suffix_ranks(data, length)
    top, rank = levels[-1]
    order = np.lexsort((at, rank[at + length - top], rank[at]))
    common = np.zeros(len(at) + 1, np.uint8)
    common[1:-1] = common_prefixes(levels, data, at[order[:-1]], at[order[1:]], length)
    cut = np.flatnonzero(common < 16)  # before each cluster, and after the last one
    common[cut] = 0
    out, i = np.zeros(len(at), np.uint8), 0
    single = np.diff(cut) == 1
    while i < len(cut) - 1:
        j = max(i + 1, int(np.searchsorted(cut, cut[i] + _CLUSTER, side="right")) - 1)
        a, b = int(cut[i]), int(cut[j])
        if not single[i:j].all():
            place = order[a:b].astype(np.int32)
            before = _to_smaller(place, common[a:b])
            after = _to_smaller(place[::-1], np.concatenate(([0], common[a + 1:b][::-1])).astype(np.uint8))[::-1]
            out[order[a:b]] = np.maximum(before, after)
        i = j
    return out


def earlier_factor(rank: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether a prefix, given by its hash, starts at a smaller place too.

    In the order (hash, place) the previous smaller place of a prefix is that of its neighbour.
    """
    order = np.lexsort((place, rank))
    r, p = rank[order], place[order]
    out = np.zeros(len(rank), bool)
    out[order[1:]] = (r[1:] == r[:-1]) & (p[1:] > p[:-1])
    return out


def _segments(slices: list[Slice], open_: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes under the open windows, one stretch after the other, and where each window starts in them."""
    parts, starts, base = [], [], 0
    for s, at in zip(slices, open_):
        if not len(at):
            continue
        new = np.concatenate(([True], np.diff(at) > length))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        size = at[last] + length - at[first]
        shift = np.cumsum(size) - size
        stretch = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at))))
        starts.append(at - at[first][stretch] + shift[stretch] + base)
        index = np.repeat(at[first] - shift, size) + np.arange(size.sum())
        parts.append(s.data[index])
        base += int(size.sum())
    if not parts:
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    return np.concatenate(parts), np.concatenate(starts)


def _packed(x: bytes) -> bytes:
    return zstandard.compress(x, 1)


def _ask_suffixes(length: int, ranges: int):
    def run(block: pa.Table, replies: pa.Table) -> pa.Table:
        number = block.column("_block")[0].as_py()
        _, texts = _ordered(block)
        slices = list(make_slices(texts, length))
        code = np.frombuffer(_concatenated(replies, 1), np.uint8)
        open_ = _settle(slices, code)
        data, at = _segments(slices, open_, length)
        before = longest_previous_factors(data, at, length) >= length if len(at) else np.zeros(0, bool)
        hashes = np.sort(np.concatenate([s.hashes(o, length) for s, o in zip(slices, open_)] or [np.zeros(0, np.uint64)])[~before])
        edge = _range_edges(hashes, ranges)
        state = len(code).to_bytes(8, "little") + code.tobytes() + np.packbits(before).tobytes()
        return _rows([(number, number % ranges, 0, None, _packed(state)),
                      *[(number, k, 2, hashes[a:b].tobytes(), None) for k, (a, b) in enumerate(zip(edge[:-1], edge[1:])) if a < b]])
    return run


def _answer_suffixes(asked: pa.Table) -> pa.Table:
    """For each suffix prefix of each block, whether an earlier block has it; states go through."""
    kinds = asked.column("_kind").to_numpy()
    out = asked.filter(pa.array(kinds == 0))
    asked = asked.filter(pa.array(kinds == 2))
    if not asked.num_rows:
        return out
    parts = [np.frombuffer(x, np.uint64) for x in asked.column("_hashes").to_pylist()]
    sizes = [len(p) for p in parts]
    blocks = asked.column("_block").to_numpy()
    before = earlier_factor(np.concatenate(parts), np.repeat(blocks, sizes))
    stop = np.cumsum(sizes)
    return pa.concat_tables([out.cast(_ROWS_ARROW), _rows(
        [(int(b), r, 2, None, _packed(np.packbits(before[e - n:e]).tobytes() + n.to_bytes(8, "little")))
         for b, r, n, e in zip(blocks, asked.column("_range").to_pylist(), sizes, stop)])])


def _cut(length: int, keys: list[str], kept_text: bool):
    def run(block: pa.Table, replies: pa.Table) -> pa.Table:
        block, texts = _ordered(block)
        slices = list(make_slices(texts, length))
        rows = sorted(zip(replies.column("_kind").to_pylist(), replies.column("_range").to_pylist(),
                          replies.column("_more").to_pylist()), key=lambda x: x[:2])
        state = zstandard.decompress(next(m for k, _, m in rows if k == 0))
        n = int.from_bytes(state[:8], "little")
        open_ = _settle(slices, np.frombuffer(state[8:8 + n], np.uint8))
        total = sum(map(len, open_))
        before = np.unpackbits(np.frombuffer(state[8 + n:], np.uint8), count=total).astype(bool)
        answers = []
        for k, _, m in rows:
            if k == 2:
                m = zstandard.decompress(m)
                answers.append(np.unpackbits(np.frombuffer(m[:-8], np.uint8), count=int.from_bytes(m[-8:], "little")))
        hashes = np.concatenate([s.hashes(o, length) for s, o in zip(slices, open_)]) if total else np.zeros(0, np.uint64)
        asked = np.flatnonzero(~before)
        order = asked[np.argsort(hashes[asked], kind="stable")]
        if answers:
            before[order] = np.concatenate(answers).astype(bool)
        at, out = 0, []
        for s, o in zip(slices, open_):
            hit = o[before[at:at + len(o)]]
            at += len(o)
            s.mark(hit, hit + length)
            gone = np.cumsum(s.cover[:-1]) > 0
            for a, b in zip(s.start.tolist(), s.stop.tolist()):
                own = gone[a:b]
                removed = int(np.count_nonzero(own))
                raw = s.data[a:b]
                left = raw.tobytes() if not removed else raw[~own].tobytes()
                spans = int(own[:1].sum()) + int(np.count_nonzero(own[1:] & ~own[:-1])) if removed else 0
                out.append((b - a, removed, spans, hashlib.sha256(left).hexdigest(),
                            left.decode("utf-8", "ignore") if kept_text else None))
        columns = list(zip(*out))
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * kept_text
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        found = {m: pa.array(c, t) for m, c, t in zip(names, columns, types)}
        if kept_text:
            found["kept_text"] = pc.if_else(block.column("_text").combine_chunks().is_null(), None, found["kept_text"])
        return pa.table({**{k: block.column(k) for k in keys}, **found})
    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (),
                   length: int = LENGTH, kept_text: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: id, ``keep``, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept text.

    The digest is of the bytes that stay; the text leaves out what is then no longer whole UTF-8.
    """
    spark = docs.sparkSession
    order = F.coalesce(F.col(doc_id).cast("long"), -(1 << 62) - F.shiftright(F.xxhash64(text).bitwiseAND((1 << 63) - 1), 2))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    n_blocks = max(1, -(-int(size) // block_bytes))
    # The smallest order of each of so many ranges of rows: one number per block.
    lows = docs.select(order.alias("o")).repartitionByRange(n_blocks, "o").groupBy(
        F.spark_partition_id()).agg(F.min("o").cast("double").alias("low")).collect()
    cuts = sorted({r["low"] for r in lows})[1:]
    keys = [doc_id, *keep]
    dealt = docs.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(text).cast("binary").alias("_text"),
                        order.alias("_order"), order.cast("double").alias("_place"))
    if cuts:
        dealt = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="_place", outputCol="_bucket").transform(
            dealt).withColumn("_block", F.col("_bucket").cast("int")).drop("_place", "_bucket")
    else:
        dealt = dealt.withColumn("_block", F.lit(0)).drop("_place")
    ranges = max(16, shuffle_partitions(spark), -(-int(size) // _RANGE_BYTES))
    blocks = dealt.groupBy("_block")
    anchors = blocks.applyInArrow(giving_back(_ask_anchors(length, ranges)), _ROWS).groupBy("_range").applyInArrow(giving_back(_answer_anchors), _ROWS)
    suffixes = blocks.cogroup(anchors.groupBy("_block")).applyInArrow(giving_back(_ask_suffixes(length, ranges)), _ROWS)
    answers = suffixes.groupBy("_range").applyInArrow(giving_back(_answer_suffixes), _ROWS)
    held = [f"_k{i}" for i in range(len(keys))]
    schema = ", ".join([*[f"{h} {docs.schema[k].dataType.simpleString()}" for h, k in zip(held, keys)],
                        "n_bytes long, n_removed long, n_spans long, kept_sha256 string", *["kept_text string"] * kept_text])
    out = blocks.cogroup(answers.groupBy("_block")).applyInArrow(giving_back(_cut(length, held, kept_text)), schema)
    return out.withColumnsRenamed(dict(zip(held, keys)))
