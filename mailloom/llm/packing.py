"""Packing documents into sequences of a fixed number of tokens.

Each document is tokenised and, if longer than a sequence, cut so that only its
first piece is shorter.  How many pieces there are of each length, at most
``capacity`` numbers, decides the packing: first a dominance reduction in the
manner of Martello and Toth fixes small sets that no other set with the same
largest piece can beat, then best-fit decreasing packs the rest.  Equal
lengths are handled together, so this costs the same for any number of
documents.  The result is a short list of runs; pieces find their sequence by
their place in the order of lengths.

Null text counts as empty: it is one piece with the end id alone.  Repeated
rows are pieces of their own; null ids come first; an empty table gives none.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import global_index, stored

CAPACITY = 2048
CACHE_ENTRIES = 200_000
# The byte-level pattern for texts below U+0250, with its classes written out.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", " \t-\r\x85\xa0"
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_BEYOND = re.compile("[ɐ-\U0010ffff]")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder(dict):
    """Token ids of texts as little-endian 32-bit bytes; remembers pieces, in bounded number."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        alphabet = _byte_alphabet()
        special = {x["content"]: x["id"] for x in model["added_tokens"]}
        ranks = {bytes(alphabet[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
        self.special = {k: np.array([v], "<u4").tobytes() for k, v in special.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.core = tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        ids = np.array(self.core._encode_single_piece(piece), "<u4").tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def plain(self, text: str) -> bytes:
        if _BEYOND.search(text):
            return np.array(self.core.encode_ordinary(text), "<u4").tobytes()
        return b"".join(map(self.__getitem__, _PIECE.findall(text)))

    def encode(self, text: str) -> bytes:
        """The strings of special tokens become their ids, as the vocabulary's own library does."""
        if self.split is None or not any(x in text for x in self.special):
            return self.plain(text)
        return b"".join(self.special[x] if x in self.special else self.plain(x) for x in self.split.split(text) if x)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; only the first may be shorter."""
    head = n % capacity or capacity
    return [(0, head), *[(s, capacity) for s in range(head, n, capacity)]]


def pieces(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
           capacity: int = CAPACITY, end_id: int = 0, ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids."""
    kind = docs.schema[doc_id].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            row, out = [], []
            for i, value in enumerate(batch.column(1).to_pylist()):
                all_ids = encoder.encode(value or "") + end
                for k, (start, length) in enumerate(cut(len(all_ids) // 4, capacity)):
                    own = all_ids[4 * start:4 * (start + length)]
                    row.append(i)
                    out.append((k, start, length, zlib.crc32(own), *([own] if ids else [])))
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*out)) if out else [()] * (4 + ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["_doc", "piece", "start", "length", "ids_crc32", "ids"][:5 + ids])

    schema = f"_doc {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids
    return docs.select(F.col(doc_id).alias("_doc"), F.col(text).cast("string")).mapInArrow(
        run, schema).withColumnRenamed("_doc", doc_id)


class Packer:
    """Packs lengths given as counts into runs: (length, number, first sequence, offset)."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.counts, self.mask = capacity, dict(counts), 0
        for size, n in counts.items():
            self.mask |= (n > 0) << size
        self.runs: list[tuple[int, int, int, int]] = []
        self.sequences = 0

    def _take(self, size: int, n: int) -> None:
        self.counts[size] -= n
        if not self.counts[size]:
            self.mask &= ~(1 << size)

    def _largest(self, limit: int, used: tuple[int, ...]) -> int:
        """Largest size up to ``limit`` of which more than ``used`` is left; 0 if none."""
        mask = self.mask & ((1 << (limit + 1)) - 1)
        while mask:
            size = mask.bit_length() - 1
            if self.counts[size] > used.count(size):
                return size
            mask &= ~(1 << size)
        return 0

    def _smallest(self, number: int, used: int) -> list[int]:
        """The smallest sizes left, with repetition, apart from one piece of size ``used``."""
        out, mask = [], self.mask
        while mask and len(out) < number:
            size = (mask & -mask).bit_length() - 1
            out += [size] * min(number - len(out), self.counts[size] - (size == used))
            mask &= mask - 1
        return out

    def _fix(self, sizes: tuple[int, ...]) -> None:
        n = min(self.counts[s] // sizes.count(s) for s in sizes)
        at = 0
        for s in sizes:
            self.runs.append((s, n, self.sequences, at))
            self._take(s, n)
            at += s
        self.sequences += n

    def reduce(self) -> int:
        """Fix sets that dominate all others with the same largest piece; returns the sequences fixed."""
        changed = True
        while changed:
            changed = False
            for size in sorted((s for s, n in self.counts.items() if n), reverse=True):
                while self.counts[size]:
                    best = self._dominating(size)
                    if best is None:
                        break
                    self._fix(best)
                    changed = True
        return self.sequences

    def _dominating(self, size: int) -> tuple[int, ...] | None:
        room = self.capacity - size
        one = self._largest(room, (size,)) if room else 0
        if not one:
            return (size,)
        if one == room:
            return size, one
        low = self._smallest(3, size)
        if len(low) < 2 or low[0] + low[1] > room:
            return size, one  # one companion at most, so the largest
        if len(low) > 2 and sum(low) <= room:
            return None
        # Two companions at most: (one, two) beats a pair whose smaller piece is at most two.
        two = self._largest(room - one, (size, one))
        half = self._largest(room // 2, (size,))
        return (size, one, two) if two and half <= two else None

    def best_fit(self) -> None:
        """Best-fit decreasing over what is left; sequences with equal room are kept as ranges."""
        ranges: dict[int, list[tuple[int, int]]] = {}
        mask = 0

        def put(room: int, first: int, n: int) -> None:
            nonlocal mask
            if n and room:
                ranges.setdefault(room, []).append((first, n))
                mask |= 1 << room

        def fill(first: int, n: int, room: int, size: int, layers: int) -> None:
            for k in range(layers):
                self.runs.append((size, n, first, self.capacity - room + k * size))
            self._take(size, n * layers)
            put(room - layers * size, first, n)

        for size in sorted((s for s, n in self.counts.items() if n), reverse=True):
            while self.counts[size]:
                fits = mask >> size
                if fits:
                    room = size + (fits & -fits).bit_length() - 1
                    first, n = ranges[room].pop()
                    if not ranges[room]:
                        mask &= ~(1 << room)
                else:
                    room, first = self.capacity, self.sequences
                    n = -(-self.counts[size] // (room // size))
                    self.sequences += n
                layers = room // size
                whole = min(n, self.counts[size] // layers)
                if whole:
                    fill(first, whole, room, size, layers)
                rest = min(self.counts[size], layers) if whole < n else 0
                if rest:
                    fill(first + whole, 1, room, size, rest)
                put(room, first + whole + bool(rest), n - whole - bool(rest))


def pack(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, end_id: int = 0, ids: bool = False) -> DataFrame:
    """Pieces with their sequence and offset."""
    cut_docs = stored(pieces(docs, vocabulary, doc_id, text, capacity, end_id, ids), "pieces")
    counts = {r["length"]: r["count"] for r in cut_docs.groupBy("length").count().collect()}  # at most capacity rows
    packer = Packer(counts, capacity)
    packer.reduce()
    packer.best_fit()
    runs = sorted(enumerate(packer.runs), key=lambda x: (x[1][0], x[0]))
    number = np.array([r[1] for _, r in runs], np.int64)
    begin = np.cumsum(number) - number
    first, offset = (np.array([r[i] for _, r in runs], np.int64) for i in (2, 3))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(batch.schema.get_field_index("_at")).to_numpy()
            run = np.searchsorted(begin, at, side="right") - 1
            names = [n for n in batch.schema.names if n != "_at"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(first[run] + at - begin[run]), pa.array(offset[run])],
                names=[*names, "sequence_id", "offset"])

    indexed = global_index(cut_docs, ["length", doc_id, "piece", "ids_crc32"], "_at")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in indexed.schema if f.name != "_at")
    return indexed.mapInArrow(place, f"{kept}, sequence_id long, offset long")
