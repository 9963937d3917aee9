"""Near-duplicate classes by ProbMinHash, banding and exact verification.

A text is the multiset of its 5-word shingles (fewer words: one shingle of all
of them).  Every shingle is a Poisson process whose rate is its count; each
arrival falls into one of the registers, a register keeps the shingle of its
first arrival, and a shingle stops as soon as its next arrival is later than
all registers of its document.  Two registers agree with the probability
Jaccard of the two texts.  A text that repeats a shingle has further registers
with rate 1 for each distinct shingle, which agree with the set Jaccard; without
repeats both are the same.  Texts that agree in all registers of a band, of
either kind, are candidates; a candidate pair is a link if its exact probability Jaccard or its
set Jaccard is ``threshold`` or more, and classes are the connected components.

Equal word sequences are one node from the start.  Inside a band's bucket all
nodes are compared with one leader, not with each other.  The first leader is the node
with the fewest shingles: texts that share nothing but a passage are linked by its
length and the lengths of their rests, so whatever is linked that way is linked to the
one with the smallest rest.  Buckets whose nodes are still in different classes get
other leaders.  For what is then left in different classes a prefix join finds the
rest.  In an order that puts frequent shingles last, two sets at the threshold t share
one of the first (1 - t) of the larger and (1 - t) / (1 + t) of the smaller one; their
sizes, and the shingles that come after the first shared one, must leave room for the
threshold.  Sizes fall into bins, and a shingle of a set meets only the bins that leave this
room, so a passage that very many texts share brings together no more than links.  Of the
pairs with a text that repeats a shingle, which prefixes by mass find, those go whose registers of both kinds agree far
less than the threshold asks.  So no link is lost but by the bands, which miss
a pair at the threshold with probability (1 - threshold^rows)^bands.

Texts without words are classes of their own.  Rows with a null id take part
under a negative number made from their text.  Rows with equal ids share a
class, whatever their texts.  A very long text is one row of its task.  Other columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_blocks

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 30, 5
LEADER_ROUNDS = 2
# Texts whose shingles tell which are frequent; only the speed of the prefix join depends on it.
FREQUENT_SAMPLE, FREQUENT_KEPT = 5_000, 50_000
# A pair at the threshold agrees in so many deviations less than expected with a probability below 3e-7.
_DEVIATIONS = 5.0
# Shingle sets of about so many bytes meet in a tile of the comparison.
_TILE_BYTES = 32_000_000
_BLOCK = 3_000_000
# Sizes in one bin of the prefix join differ by less than this factor.
_BIN = 1.06
_EPS = 1e-6
_LONG = (1 << 63) - 1
_SPACE = bytes(c in b"\t\n\v\f\r " for c in range(256))
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; wraps around."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_P = np.uint64(0xD1342543DE82EF95)
_P_INV = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
_KEPT_POWERS = 1 << 18


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base of the hash, and their inverses; kept where there are few."""
    if n <= _KEPT_POWERS:
        return tuple(x[:n] for x in _kept_powers())
    out = np.full(n, _P), np.full(n, _P_INV)
    for x in out:
        x[0] = 1
        np.cumprod(x, out=x)
    return out


@functools.cache
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.concatenate(([np.uint64(1)], np.full(_KEPT_POWERS - 1, x)))) for x in (_P, _P_INV))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in turn, and the number of words of each text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") + b" " for t in texts]
    text = b"".join(raw).translate(_FOLD)
    data, space = np.frombuffer(text, np.uint8), np.frombuffer(text.translate(_SPACE), bool)
    before = np.concatenate(([True], space[:-1]))
    start = np.flatnonzero(~space & before)
    stop = np.flatnonzero(space & ~before)
    power, inverse = _powers(len(data) + 1)
    summed = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:-1], out=summed[1:])
    # Dividing by the power of the start makes the sum independent of the place.
    words = mix((summed[stop] - summed[start]) * inverse[start] + (stop - start).astype(np.uint64))
    ends = np.cumsum([len(r) for r in raw])
    return words, np.diff(np.searchsorted(start, ends), prepend=0)


def shingles(texts: list[str | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) sorted by text and shingle, the words of each text and a hash of all its words."""
    words, n = word_hashes(texts)
    first = np.cumsum(n) - n
    full = np.maximum(n - size + 1, 0)
    doc = np.repeat(np.arange(len(n)), full)
    at = np.arange(full.sum()) - (np.cumsum(full) - full)[doc] + first[doc]
    code = np.zeros(len(at), np.uint64)
    for k in range(size):
        code = code * np.uint64(0x9E3779B97F4A7C15) + words[at + k]
    # The whole text, as a polynomial in its words; also the only shingle of a short text.
    place = np.arange(len(words)) - np.repeat(first, n)
    owner = np.repeat(np.arange(len(n)), n)
    weight = mix(place.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    whole = np.zeros(len(n), np.uint64)
    np.add.at(whole, owner, mix(words * weight))
    short = np.flatnonzero((n > 0) & (n < size))
    doc = np.concatenate((doc, short))
    code = mix(np.concatenate((code, whole[short])))
    order = np.lexsort((code, doc))
    doc, code = doc[order], code[order]
    new = np.ones(len(doc), bool)
    new[1:] = (np.diff(doc) != 0) | (code[1:] != code[:-1])
    edge = np.flatnonzero(new)
    return doc[edge], code[edge], np.diff(np.append(edge, len(doc))), n, mix(whole + n.astype(np.uint64))


def signatures(doc: np.ndarray, code: np.ndarray, weight: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    """The shingle of the first arrival in each register, for each document; 0 where a document has none."""
    first = np.full(n_docs * registers, np.inf)
    winner = np.zeros(n_docs * registers, np.uint64)
    time, step = np.zeros(len(doc)), 0
    while len(doc):
        step += 1
        draw = mix(code + np.uint64(step * 0x9E3779B97F4A7C15 % (1 << 64)))
        time = time - np.log1p(-((draw >> np.uint64(11)) * 2.0 ** -53)) / weight
        slot = doc * registers + (mix(draw ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, slot, time)
        won = first[slot] == time
        winner[slot[won]] = code[won]
        latest = first.reshape(n_docs, registers).max(1)
        alive = time < latest[doc]
        doc, code, weight, time = doc[alive], code[alive], weight[alive], time[alive]
    return winner.reshape(n_docs, registers)


def both_signatures(doc: np.ndarray, code: np.ndarray, weight: np.ndarray, n_docs: int,
                    registers: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures by counts; the texts with a repeated shingle, and their signatures by distinct shingles."""
    winners = signatures(doc, code, weight, n_docs, registers)
    repeats = np.zeros(n_docs, bool)
    repeats[doc[weight > 1]] = True
    own, place = np.flatnonzero(repeats), np.cumsum(repeats) - 1
    at = repeats[doc]
    return winners, own, signatures(place[doc[at]], code[at], np.ones(int(at.sum())), len(own), registers)


def band_hashes(winners: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = winners.reshape(len(winners), bands, rows)
    out = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for k in range(rows):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return out.view(np.int64)


def _sketch(bands: int, rows: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, _BLOCK):
            doc, code, weight, n, whole = shingles(batch.column(0).to_pylist(), size)
            winners, own, plain = both_signatures(doc, code, weight, batch.num_rows, bands * rows)
            found = list(band_hashes(winners, bands, rows))
            low = [x.tobytes() for x in winners.astype(np.uint8)]
            for i, more, x in zip(own.tolist(), band_hashes(plain, bands, rows), plain.astype(np.uint8)):
                found[i], low[i] = np.union1d(found[i], more), low[i] + x.tobytes()
            repeats = np.zeros(batch.num_rows, bool)
            repeats[own] = True
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()),
                                             pa.array(np.concatenate(found)))
            # Texts without words are told apart by their ids.
            alone = mix(batch.column(1).to_numpy().astype(np.int64).view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15))
            node = np.where(n > 0, whole, alone)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(node.view(np.int64)), pa.array(n.astype(np.int64)),
                 pa.array(np.bincount(doc, minlength=batch.num_rows).astype(np.int64)), pa.array(repeats), lists, pa.array(low, pa.binary())],
                names=["_id", "_key", "_node", "_words", "_size", "_repeats", "_bands", "_low"])
    return run


_SKETCH = "_id long, _key long, _node long, _words long, _size long, _repeats boolean, _bands array<long>, _low binary"


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, _BLOCK):
            doc, code, weight, _, whole = shingles(batch.column(0).to_pylist(), size)
            edge = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            weight = weight.astype(np.uint32)
            sets = [code[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])]
            # No counts are stored where no shingle occurs twice.
            counts = [weight[a:b].tobytes() if (weight[a:b] > 1).any() else b"" for a, b in zip(edge[:-1], edge[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(whole.view(np.int64)), pa.array(sets, pa.binary()), pa.array(counts, pa.binary())],
                names=["_id", "_set", "_counts"])
    return run


def similarity(a: bytes, wa: bytes, b: bytes, wb: bytes) -> float:
    """The larger of set Jaccard and probability Jaccard of two shingle multisets."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if not len(x) or not len(y):
        return 0.0
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = y[at] == x
    plain = both.sum() / (len(x) + len(y) - both.sum())
    if not (wa or wb) or not both.any():  # without repeats both measures are equal
        return float(plain)
    u = np.frombuffer(wa, np.uint32).astype(float) if wa else np.ones(len(x))
    v = np.frombuffer(wb, np.uint32).astype(float) if wb else np.ones(len(y))
    return max(float(plain), probability_jaccard(u[both], v[at[both]], u, v))


def probability_jaccard(p: np.ndarray, q: np.ndarray, u: np.ndarray, v: np.ndarray) -> float:
    """Sum over shared shingles, weighing p and q, of 1 / sum_j max(u_j / p, v_j / q)."""
    alone_u, alone_v = u.sum() - p.sum(), v.sum() - q.sum()
    # With t = p / q, max(u_j / p, v_j / q) = (u_j if u_j / v_j >= t else t v_j) / p.
    ratio = p / q
    order = np.argsort(ratio, kind="stable")
    up = np.concatenate((np.cumsum(p[order][::-1])[::-1], [0.0]))
    low = np.concatenate(([0.0], np.cumsum(q[order])))
    cut_at = np.searchsorted(ratio[order], ratio, side="left")
    total = alone_u / p + alone_v / q + up[cut_at] / p + low[cut_at] / q
    return float((1.0 / total).sum())


def _links(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            keep = [similarity(*x) >= threshold for x in zip(*[batch.column(i).to_pylist() for i in range(2, 6)])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles that occur in two texts or more of a sample, most frequent first, up to a bound."""
    parts = [np.frombuffer(x, np.uint64) for b in batches for x in b.column(0).to_pylist()]
    code, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
    best = np.lexsort((code, -n))[:FREQUENT_KEPT]
    best = np.sort(best[n[best] > 1])
    yield pa.RecordBatch.from_arrays([pa.array([code[best].tobytes()], pa.binary()), pa.array([n[best].astype(np.int64).tobytes()], pa.binary())],
                                     names=["code", "n"])


def prefix(code: np.ndarray, weight: np.ndarray, frequent: np.ndarray, times: np.ndarray, threshold: float) -> np.ndarray:
    """The first shingles, rare ones first, one of which each text at the threshold must share."""
    seen = np.zeros(len(code), np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, code), len(frequent) - 1)
        seen = np.where(frequent[at] == code, times[at], 0)
    order = np.lexsort((code, seen))
    left = 1 - np.cumsum(weight[order]) / weight.sum()
    by_mass = int(np.argmax(left < threshold - 1e-9)) + 1
    by_number = len(code) - int(np.ceil(threshold * len(code) - 1e-9)) + 1
    return code[order[:max(by_mass, by_number)]]


def _prefixes(frequent, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, times = (np.frombuffer(x, t) for x, t in zip(frequent.value, (np.uint64, np.int64)))
        for batch in batches:
            keys = []
            for s, w in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = np.frombuffer(s, np.uint64)
                weight = np.frombuffer(w, np.uint32).astype(float) if w else np.ones(len(own))
                keys.append(prefix(own, weight, code, times, threshold).view(np.int64) if len(own) else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], names=["id", "keys"])
    return run


def _alike(threshold: float, registers: int):
    """Keeps the pairs unless their registers by counts and those by distinct shingles both speak clearly against the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            pair = [batch.column(i).to_pylist() for i in (2, 3)]
            same = np.zeros(batch.num_rows)
            for part in (slice(None, registers), slice(-registers, None)):
                x, y = (np.frombuffer(b"".join([v[part] for v in low]), np.uint8).reshape(batch.num_rows, -1) for low in pair)
                same = np.maximum(same, (x == y).mean(1))
            least = threshold - _DEVIATIONS * np.sqrt(threshold * (1 - threshold) / registers)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(same >= least))
    return run


def _tile_links(threshold: float):
    """Links among the pairs of a tile; each text of the tile is there once."""
    def run(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        held = dict(zip(sets.column("_id").to_pylist(), zip(sets.column("_set").to_pylist(), sets.column("_counts").to_pylist())))
        keep = [a in held and b in held and similarity(*held[a], *held[b]) >= threshold
                for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist())]
        return pairs.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _links_by_tiles(pairs: DataFrame, sets: DataFrame, threshold: float, groups: int) -> DataFrame:
    """Compares pairs in groups x groups tiles: a text is sent 2 x groups times, however many pairs it has."""
    group = lambda c: F.pmod(F.xxhash64(c), F.lit(groups)).cast("int")
    dealt = pairs.withColumn("tile", group("a") * groups + group("b"))
    every = F.array(*[F.lit(i) for i in range(groups)])
    own = group("_id")
    tiles = F.array_distinct(F.concat(F.transform(every, lambda j: own * groups + j), F.transform(every, lambda j: j * groups + own)))
    spread = sets.select("_id", "_set", "_counts", F.explode(tiles).alias("tile"))
    return dealt.groupBy("tile").cogroup(spread.groupBy("tile")).applyInArrow(_tile_links(threshold), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, class): the smallest id connected with each id that has an edge; edges (a, b) are stored.

    Each round takes the smallest label around and then the label's own label,
    so chains shorten by half; only the number of changes reaches the driver.
    """
    n = 2 * edges.count()
    both = stored(edges.union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), "edges", rows=n)
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("id"), F.least("a", "m").alias("class")), "labels", rows=n)
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("class").alias("m"))
        step = stored(labels.join(near, F.col("id") == F.col("a")).select(
            "id", F.least("class", "m").alias("class"), F.col("class").alias("old")), "labels", rows=n)
        up = step.select(F.col("id").alias("_i"), F.col("class").alias("_c"))
        step = stored(step.join(up, F.col("class") == F.col("_i"), "left").select(
            "id", F.least("class", F.coalesce("_c", "class")).alias("class"), "old"), "labels", rows=n)
        labels = step.select("id", "class")
        if step.where("class <> old").isEmpty():
            return labels


def node_id(doc_id: str, text: str) -> Column:
    """The id, or for a null id a negative number made from the text."""
    return F.coalesce(F.col(doc_id).cast("long"), -1 - F.xxhash64(text).bitwiseAND(F.lit(_LONG)))


def text_key(text: str) -> Column:
    """Tells texts with one id apart."""
    return F.xxhash64(F.col(text).cast("string"))


def _bin(size: Column) -> Column:
    return F.floor(F.log(size.cast("double")) / F.lit(math.log(_BIN))).cast("int")


def _plain_pairs(keyed: DataFrame, threshold: float) -> DataFrame:
    """Candidate pairs of texts without repeated shingles; ``keyed`` has id, class, size, key, pos.

    With i and j the places of the first shared shingle, no more than the shorter of the two remainders
    is shared, and threshold / (1 + threshold) of both sizes together must be.
    """
    part = threshold / (1 + threshold)
    size, pos = F.col("size"), F.col("pos")
    small = keyed.where(size - pos >= 2 * part * size - _EPS).select(
        "key", F.col("id").alias("b"), F.col("class").alias("other"), F.col("size").alias("size_b"), F.col("pos").alias("pos_b"),
        _bin(size).alias("bin"))
    least = F.ceil(threshold * size - _EPS)
    most = F.least(size, F.floor((size - pos) / part - size + _EPS))
    large = keyed.where(most >= least).select(
        "key", F.col("id").alias("a"), "class", "size", "pos", F.explode(F.sequence(_bin(least), _bin(most))).alias("bin"))
    fits = (F.col("class") != F.col("other")) & (
        (F.col("size_b") < size) | ((F.col("size_b") == size) & (F.col("b") < F.col("a")))) & (
        F.col("size_b") >= threshold * size - _EPS) & (
        F.least(size - pos, F.col("size_b") - F.col("pos_b")) >= part * (size + F.col("size_b")) - _EPS)
    l, r = large.alias("l"), small.alias("r")
    return l.join(r, (F.col("l.key") == F.col("r.key")) & (F.col("l.bin") == F.col("r.bin")) & fits).select("a", "b")


def _prefix_pairs(nodes: DataFrame, sets: DataFrame, sketch: DataFrame, threshold: float, registers: int) -> DataFrame:
    """Candidate pairs (a, b) of the given nodes (id, class) in different classes, by their rare shingles."""
    spark = nodes.sparkSession
    nodes = stored(nodes, "open", rows=sets.count())
    own = stored(sets.join(nodes, sets["_id"] == nodes["id"], "left_semi"), "open-sets", rows=4 * nodes.count())
    grain, n = 1 << 30, max(1, own.count())
    sample = own.where(F.pmod(F.xxhash64(F.lit(2), "_id"), F.lit(grain)) < F.lit(min(grain, grain * FREQUENT_SAMPLE // n)))
    frequent = sample.select("_set").repartition(1).mapInArrow(_frequent, "code binary, n binary").first()
    held = spark.sparkContext.broadcast(tuple(frequent) if frequent else (b"", b""))
    about = sketch.select(F.col("_node").alias("id"), F.col("_size").alias("size"), F.col("_repeats").alias("repeats"))
    keyed = own.select("_id", "_set", "_counts").mapInArrow(_prefixes(held, threshold), "id long, keys array<long>").join(
        nodes, "id").join(about, "id")
    keyed = stored(keyed.select("id", "class", "size", "repeats", F.posexplode("keys").alias("pos", "key")), "prefixes")
    plain = _plain_pairs(keyed.where("not repeats"), threshold)
    other = keyed.select("key", F.col("id").alias("b"), F.col("class").alias("other"), F.col("repeats").alias("repeats_b"))
    again = keyed.where("repeats").withColumnRenamed("id", "a").join(other, "key").where(
        "class <> other and (not repeats_b or a < b)").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    low = sketch.select(F.col("_node").alias("id"), "_low")
    again = again.join(low.toDF("a", "low"), "a").join(low.toDF("b", "low_b"), "b").select(
        "a", "b", "low", "low_b").mapInArrow(_alike(threshold, registers), "a long, b long")
    return plain.union(again)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE,
                    threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: id, class_id (smallest id of its class), whether it is kept, and text_key.

    Of each class the rows with the smallest id, then the smallest ``text_key`` (a hash of the text), are kept.
    """
    source = docs.select(F.col(text).cast("string").alias("_text"), node_id(doc_id, text).alias("_id"),
                         text_key(text).alias("_key"))
    sketch = stored(source.select("_text", "_id", "_key").mapInArrow(_sketch(bands, rows, size), _SKETCH), "sketches")
    n_rows = sketch.count()
    row = F.struct("_id", "_key")
    # The first row of every node that has several.
    copies = stored(sketch.groupBy("_node").agg(F.count(F.lit(1)).alias("_n"), F.min(row).alias("_rep")).where(
        "_n > 1").drop("_n"), "copies", rows=n_rows)
    marked = sketch.join(copies, "_node", "left")
    reps = stored(marked.where(F.col("_rep").isNull()).unionByName(
        marked.where(row == F.col("_rep")).dropDuplicates(["_node"])).drop("_rep"), "nodes", rows=4 * n_rows)
    banded = reps.where("_words > 0").select(
        F.col("_node").alias("id"), F.col("_size").alias("size"), F.explode("_bands").alias("bucket"))
    shared = stored(banded.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high"))
                    .where("low < high").select("bucket"), "buckets", rows=bands * n_rows)
    members = stored(banded.join(shared, "bucket").select("bucket", "id", "size"), "members", rows=bands * n_rows)
    n_members = members.count()
    wanted = members.select(F.col("id").alias("_node")).distinct().join(reps.select("_node", "_id", "_key"), "_node").drop("_node")
    sets = stored(source.join(wanted, ["_id", "_key"], "left_semi").select("_text").mapInArrow(
        _sets(size), "_id long, _set binary, _counts binary").dropDuplicates(["_id"]), "sets", rows=4 * n_rows)

    def linked(pairs: DataFrame) -> DataFrame:
        n_pairs = pairs.count()
        ids = stored(pairs.select(F.col("a").alias("_id")).union(pairs.select("b")).distinct(), "ids", rows=2 * n_pairs)
        needed = sets.join(ids, "_id", "left_semi")
        n, size = needed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("_set") + F.octet_length("_counts")), F.lit(0))).first()
        groups = max(6, -(-2 * int(size) // _TILE_BYTES))
        if n_pairs > 4 * groups * n:  # many pairs of few texts: tiles move less
            return stored(_links_by_tiles(pairs, needed, threshold, groups), "links")
        left = sets.select(F.col("_id").alias("a"), F.col("_set").alias("sa"), F.col("_counts").alias("wa"))
        right = sets.select(F.col("_id").alias("b"), F.col("_set").alias("sb"), F.col("_counts").alias("wb"))
        joined = pairs.join(left, "a").join(right, "b")
        return stored(joined.select("a", "b", "sa", "wa", "sb", "wb").mapInArrow(_links(threshold), "a long, b long"), "links", rows=8 * n_pairs)

    # Rows of one id belong together from the start.
    several = sketch.groupBy("_id").agg(F.min("_node").alias("b"), F.max("_node").alias("_high")).where("b < _high").drop("_high")
    same_id = stored(sketch.join(several, "_id").select(F.col("_node").alias("a"), "b").where("a <> b").distinct(), "same-id", rows=n_rows)
    classes, tested = None if same_id.isEmpty() else components(same_id), None
    for turn in range(LEADER_ROUNDS + 1):
        now = members.withColumn("class", F.col("id")) if classes is None else members.join(
            classes, "id", "left").select("bucket", "id", "size", F.coalesce("class", "id").alias("class"))
        # The leader of a bucket: the smallest text at first, later one by a hash that differs from bucket to bucket.
        key = F.col("size") if turn == 0 else F.xxhash64(F.lit(turn), F.col("bucket"), F.col("id"))
        lead = stored(now.groupBy("bucket").agg(
            F.min(F.struct(key.alias("k"), "id", "class")).alias("lead"), F.min("class").alias("low"),
            F.max("class").alias("high")).where("low < high").select(
            "bucket", F.col("lead.id").alias("b"), F.col("lead.class").alias("other")), "leaders", rows=n_members)
        if lead.isEmpty():
            break
        if turn < LEADER_ROUNDS:
            pairs = now.join(lead, "bucket").where("class <> other").select(F.col("id").alias("a"), "b")
        else:  # what is left of the buckets still open
            pairs = _prefix_pairs(now.join(lead.select("bucket"), "bucket").select("id", "class").distinct(),
                                  sets, reps, threshold, bands * rows)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        # No pair is compared twice, so rounds after the first are small.
        pairs = stored(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs", rows=n_members)
        if pairs.isEmpty():
            continue
        tested = pairs if tested is None else tested.union(pairs)
        edges = linked(pairs)
        known = edges if classes is None else edges.union(classes.select(F.col("id").alias("a"), F.col("class").alias("b")))
        classes = components(known)
    # The first row of each class, by way of the first rows of its nodes.
    heads = copies.select("_node", "_rep")
    if classes is not None:
        first = classes.join(reps.select(F.col("_node").alias("id"), row.alias("_rep")), "id")
        heads = first.join(first.groupBy("class").agg(F.min("_rep").alias("_head")), "class").select(
            F.col("id").alias("_node"), F.col("_head").alias("_rep")).unionByName(
            heads.join(classes, heads["_node"] == classes["id"], "left_anti"))
    found = sketch.select("_id", "_key", "_node").join(stored(heads, "heads", rows=n_rows), "_node", "left").withColumn(
        "_rep", F.coalesce("_rep", row))
    return found.select(F.col("_id").alias(doc_id), F.col("_rep._id").alias("class_id"), (row == F.col("_rep")).alias("kept"),
                        F.col("_key").alias("text_key"))
