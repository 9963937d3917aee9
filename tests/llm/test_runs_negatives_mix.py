"""Runs of words, hard negatives and mixing against plain Python and SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from llm_helpers import SF, by_key

from mailloom.llm import hard_negatives, mixing, runs
from mailloom.llm import queries as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w, min_words=24, repeats=3):
    """Every period, every place, one word after the other."""
    n, out = len(w), {}
    for p in range(1, n // repeats + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(min_words, repeats * p):
                out.setdefault((i, j + p), p)
            i = max(j, i) + 1
    return sorted((s, e - s, p) for (s, e), p in out.items())


def plain_row(key, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(b"" if key is None else str(key).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_the_cover_has_every_difference():
    assert {(a - b) % runs.MODULUS for a in runs.COVER for b in runs.COVER} == set(range(runs.MODULUS))


def test_common_extensions():
    r = random.Random(1)
    words = np.array([r.randrange(2) for _ in range(700)] + [r.randrange(2)] * 300)
    found = runs.Extensions(words)
    i = np.array([r.randrange(999) for _ in range(3000)])
    j = np.array([r.randrange(a + 1, 1000) for a in i])
    want = [next((k for k in range(1000 - b) if words[a + k] != words[b + k]), 1000 - b) for a, b in zip(i, j)]
    assert found.common(i, j).tolist() == want and found.common(j, i).tolist() == want


def test_runs_of_random_texts():
    r = random.Random(2)
    for _ in range(150):
        texts = []
        for _ in range(r.randint(1, 5)):
            n, v = r.choice([0, 3, 24, 30, 100, 300]), r.choice([1, 2, 3, 50])
            t = [r.randrange(v) for _ in range(n)]
            if n > 30 and r.random() < 0.6:
                a, p = r.randrange(n), r.randint(1, n // 3)
                t = [x if i < a else t[a + (i - a) % p] for i, x in enumerate(t)]
            texts.append(t)
        got = runs.find_runs([np.array(t, np.int64) for t in texts], 50)
        assert [[tuple(x) for x in a.tolist()] for a in got] == [plain_runs(t) for t in texts]
    # Other limits.
    t = [0, 1, 2, 3] * 4 + [9] + [5, 6] * 20
    assert [tuple(x) for x in runs.find_runs([np.array(t)], 10, 16, 4)[0].tolist()] == plain_runs(t, 16, 4)
    with pytest.raises(ValueError):
        runs.find_runs([np.array(t)], 10, 2, 2)


def test_runs_on_edge_rows(edge, empty):
    df, rows = edge
    out = runs.collapse_runs(df, keep=("kept", "score", "_text"))
    assert out.columns == ["doc_id", "kept", "score", "_text", "n_words", "runs", "strongest", "collapsed"]
    got = Counter((r["doc_id"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in out.collect())
    want = Counter()
    for i, t in rows:
        words = WORD.findall(t or "")
        found = plain_runs(words)
        gone = {k for s, length, q in found for k in range(s + q, s + length)}
        want[(i, tuple(found), None if t is None else " ".join(w for k, w in enumerate(words) if k not in gone))] += 1
    assert got == want and any(k[1] for k in got)
    assert runs.collapse_runs(empty).count() == 0


def test_runs_query(spark):
    out = by_key(Q.llm_queries()["op11_word_runs"](spark, SF))
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert {k: tuple(r)[1:] for k, r in out.items()} == {i: plain_row(i, t) for i, t in docs}
    assert any(r["n_runs"] for r in out.values())


# --- hard negatives -----------------------------------------------------------

VECTORS = "vec_id BIGINT, label INT, embedding ARRAY<FLOAT>, _uid STRING, score INT"


def plain_negatives(rows, is_anchor, n_pos=5, n_neg=5, least=80, scale=256):
    good = [(i, lab, [math.floor(scale * x) for x in v]) for i, lab, v in rows
            if lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))  # noqa: E731  shorter vectors end in zeros
    key = lambda x: (-x[0], x[1] is None, x[1] or 0, x[2])
    out = Counter()
    for k, (i, lab, v) in enumerate(good):
        if not is_anchor(i):
            continue
        scored = [(dot(v, w), j, m, other) for m, (j, other, w) in enumerate(good) if m != k]
        for s, j, _, _ in sorted((x for x in scored if x[3] == lab), key=key)[:n_pos]:
            fit = sorted((x for x in scored if x[3] != lab and least * s <= 100 * x[0] <= 100 * s), key=key)[:n_neg]
            for rank, x in enumerate(fit, 1):
                out[(i, j, rank, x[1], s, x[0])] += 1
    return out


def test_negatives_on_edge_rows(spark):
    r = random.Random(3)
    point = lambda d=4: [float(np.float32(r.gauss(0, 1))) for _ in range(d)]
    hot = point()
    rows = [(i, r.randrange(3), point()) for i in range(150)]
    rows += [(200 + i, i % 2, [x + (0.001 * (i % 3)) for x in hot]) for i in range(60)]  # near copies
    rows += [(300 + i, 1, hot) for i in range(20)] + [(300, 1, hot), (20, 2, hot)]       # equal vectors, equal ids
    rows += [(400, None, hot), (410, 1, None), (420, 1, []), (430, 1, [1.0, None, 0.0, 0.0]), (440, 1, [float("nan")] * 4),
             (450, 0, [float("inf"), 0.0, 0.0, 0.0]), (460, 0, [0.5]), (470, 1, point(3)), (None, 1, hot), (None, 0, hot),
             (480, 2, [0.0] * 4), (490, 7, hot), (-10, 0, [-x for x in hot]), (500, 1, [3e6, 1.0, 0.0, 0.0])]
    rows = [(i, lab, v and [x if x is None else float(np.float32(x)) for x in v]) for i, lab, v in rows]
    df = spark.createDataFrame([(*x, "u", 1) for x in rows], VECTORS).repartition(3)
    got = hard_negatives.mine(df, df["vec_id"] % 10 == 0)
    assert Counter(map(tuple, got.collect())) == plain_negatives(rows, lambda i: i is not None and i % 10 == 0)
    none = hard_negatives.mine(df.limit(0), df["vec_id"] % 10 == 0)
    assert none.count() == 0 and none.columns == got.columns
    assert hard_negatives.mine(df, df["vec_id"] == 1000).count() == 0


def test_siblings_are_left_out_and_only_those_without_hits():
    r = np.random.default_rng(4)
    centres = r.normal(0, 40, (8, 6))
    rows = np.concatenate([c + r.normal(0, 1, (200, 6)) for c in centres])
    tree = hard_negatives.fit_tree(rows[::4])
    low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    high = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
    for node, _, d, near in tree.walk(rows):
        for j in np.unique(near):
            low[node][:, j] = np.minimum(low[node][:, j], d[near == j].min(0))
            high[node][:, j] = np.maximum(high[node][:, j], d[near == j].max(0))
    leaf, asked = tree.leaf(rows), rows[::50]
    d = np.sqrt(((asked[:, None] - rows[None]) ** 2).sum(2))
    near, far = np.full((len(asked), 1), 1.0), np.full((len(asked), 1), 3.0)
    found = hard_negatives.reachable(tree, low, high, asked, near, far)
    for k in range(tree.leaves):
        hit = ((d[:, leaf == k] >= 1.0) & (d[:, leaf == k] <= 3.0)).any(1)
        assert set(np.flatnonzero(hit)) <= set(found[k].tolist())
    assert sum(map(len, found)) < 0.3 * len(asked) * tree.leaves


def test_negatives_query(spark):
    want = duckdb.sql(Q.ORACLE_SQL["op12_hard_negatives"].replace("FROM embeddings", f"FROM '{SF}/embeddings.parquet'")).fetchall()
    got = Q.llm_queries()["op12_hard_negatives"](spark, SF).collect()
    assert Counter(map(tuple, got)) == Counter(want) and want


# --- mixing ---------------------------------------------------------------------

def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        free = sum(w[s] for s in names if s not in full)
        out = {s: most * sizes[s] if s in full else left * w[s] / max(free, 1) for s in names}
        above = {s for s in names if out[s] > most * sizes[s]}
        if not above:
            return out
        full |= above


def plain_rates(docs, target, most=3):
    """Rates of one source by bisection on its multiplier."""
    words = sum(docs)
    if target >= most * words:
        return {z: float(most) for z in docs}
    mean = words / sum(z > 0 for z in docs)
    rate = lambda t, z: min(most, math.exp(min(700.0, t * z / mean)))
    low, high = -1e6, 1e6
    for _ in range(300):
        mid = (low + high) / 2
        if sum(z * rate(mid, z) for z in docs) < target:
            low = mid
        else:
            high = mid
    return {z: rate(low, z) for z in docs}


def check_mix(rows, out):
    """Everything but which of equal documents gets a copy more."""
    size = lambda t: len(WORD.findall(t or ""))
    sizes, of = Counter(), defaultdict(list)
    for _, t, s in rows:
        sizes[s] += size(t)
        of[s].append(size(t))
    targets = plain_targets(sizes)
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in out) == Counter((i, size(t), s) for i, t, s in rows)
    copies = defaultdict(list)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], targets[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["copies"] <= 3 and (r["size"] or not r["copies"])
        copies[(r["source"], r["size"])].append(r["copies"])
    for s, docs in of.items():
        taken = sum(z * sum(copies[(s, z)]) for z in set(docs))
        worded = [z for z in docs if z]
        if not worded:
            assert taken == 0
            continue
        rates = plain_rates(docs, targets[s])
        assert abs(taken - targets[s]) <= max(worded)
        for z, n in Counter(worded).items():
            own = copies[(s, z)]
            assert abs(sum(own) - n * rates[z]) <= 3 and max(own) - min(own) <= 1, (s, z)
    for r in out:
        if r["size"]:
            assert math.isclose(r["rate"], plain_rates(of[r["source"]], targets[r["source"]])[r["size"]], rel_tol=1e-6, abs_tol=1e-9)


def test_mix_on_edge_rows(spark, edge, empty):
    r = random.Random(6)
    words = lambda n: " ".join("w%d" % r.randrange(50) for _ in range(n))
    rows = [(i, words(r.choice([3, 10, 10, 200, 1000])), r.choice(["b", "hot", "hot", "ü", "B", None])) for i in range(300)]
    rows += [(400 + k, "x y z", "copies") for k in range(50)] + [(i, None, "nothing") for i in range(3)] + [(7, "", "b"), (7, "a", "tiny"), (None, words(5), None)]
    schema = "doc_id BIGINT, text STRING, source STRING, size STRING, rate STRING, copies STRING, _hash STRING"
    df = spark.createDataFrame([(*x, "s", "r", "c", "h") for x in rows], schema)
    first = mixing.mix(df.repartition(3)).collect()
    check_mix(rows, first)
    again = mixing.mix(df.repartition(5, "text")).collect()
    assert Counter(map(tuple, first)) == Counter(map(tuple, again))
    assert mixing.mix(empty).count() == 0
    df, rows = edge
    check_mix([(i, t, "s") for i, t in rows], mixing.mix(df, keep=("kept", "score", "_text")).collect())


def test_slices_of_a_large_group_share_its_copies(spark, monkeypatch):
    monkeypatch.setattr(mixing, "_SLICE", 8)
    rows = [(i, "one two three", "a") for i in range(200)] + [(300 + i, "x " * (i + 1), "b") for i in range(40)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")).collect()
    check_mix(rows, out)


def test_mix_query(spark):
    out = Q.llm_queries()["op13_entropy_mix"](spark, SF).collect()
    docs = duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet'").fetchall()
    size = {i: len(WORD.findall(t or "")) for i, t, _ in docs}
    sizes, source, taken = Counter(), {i: s for i, _, s in docs}, Counter()
    for i, _, s in docs:
        sizes[s] += size[i]
    want = plain_targets(sizes)
    assert sorted(r["doc_id"] for r in out) == sorted(size)
    for r in out:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[s] and math.isclose(r["target"], want[s], rel_tol=1e-9)
        assert r["taken"] in {k * r["size"] for k in range(4)}
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] + 5 for s in sizes)
