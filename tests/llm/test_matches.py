"""Repeat removal and decontamination against plain Python."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import SF, by_key

from mailloom.llm import decontaminate, suffix_dedup
from mailloom.llm import queries as Q

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_removal(rows, length=100):
    """Every byte string of the length, looked up one by one; null ids come first, in any order."""
    seen, out = set(), []
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            w = raw[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for p in range(len(raw)) if gone[p] and (p == 0 or not gone[p - 1]))
        left = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("block_bytes", [8_000_000, 3000])
def test_removal_on_edge_rows(edge, empty, block_bytes):
    df, rows = edge
    out = suffix_dedup.remove_repeats(df, keep=("kept", "_text"), kept_text=True, block_bytes=block_bytes)
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out.collect())
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == Counter(plain_removal(ordered))
    texts = {r["doc_id"]: r["kept_text"] for r in out.collect() if r["doc_id"] is not None}
    assert texts[2] is None and texts[3] == "" and texts[5] == "" and texts[9] == "one two"
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_removal_query(spark):
    out = by_key(Q.llm_queries()["op2_repeat_removal"](spark, SF))
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
    assert {tuple(r) for r in out.values()} == set(plain_removal(docs))


def test_suffix_ranks_order_prefixes():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 3, 700).astype(np.uint8)
    at = np.arange(len(data) - 100)
    levels, _ = suffix_dedup.suffix_ranks(data, 100)
    assert [k for k, _ in levels] == [8, 16, 32, 64]
    rank = levels[-1][1]
    order = np.lexsort((rank[at + 36], rank[at]))
    want = sorted(at, key=lambda p: data[p:p + 100].tobytes())
    assert [data[p:p + 100].tobytes() for p in order] == [data[p:p + 100].tobytes() for p in want]


@pytest.mark.parametrize("cluster", [1, 10, 500_000])
def test_longest_previous_factors(monkeypatch, cluster):
    """Against every earlier suffix, byte by byte; less than 16 bytes count as none."""
    monkeypatch.setattr(suffix_dedup, "_CLUSTER", cluster)
    r = random.Random(cluster)
    for _ in range(25):
        length, v = r.choice([16, 20, 100]), r.choice([1, 2, 4, 50])
        data = [r.randrange(v) for _ in range(r.choice([length, length + 30, 350]))]
        for _ in range(5):
            a, b, n = r.randrange(len(data)), r.randrange(len(data)), r.randrange(150)
            data[a:a + n] = data[b:b + n][:len(data[a:a + n])]
        at = sorted(r.sample(range(len(data) - length + 1), r.randint(1, len(data) - length + 1))) if len(data) >= length else []
        data, want = np.array(data, np.uint8), []
        for i, p in enumerate(at):
            best = max((next((k for k in range(length) if data[p + k] != data[q + k]), length) for q in at[:i]), default=0)
            want.append(best if best >= 16 else 0)
        if at:
            assert suffix_dedup.longest_previous_factors(data, np.array(at), length).tolist() == want


def test_anchors_are_spread_over_the_ranges():
    """An anchor is a minimum; its mixed hash is not, so ranges get equal shares."""
    rows = duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()
    block = pa.table({"_block": [0] * len(rows), "_order": list(range(len(rows))), "_text": [(t or "").encode() for t, in rows]})
    asked = suffix_dedup._ask_anchors(100, 16)(block)
    sizes = dict(zip(asked.column("_range").to_pylist(), map(len, asked.column("_hashes").to_pylist())))
    assert len(sizes) == 16 and max(sizes.values()) < 1.3 * min(sizes.values())


def plain_contamination(docs, items, window=10):
    words = lambda t: WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = {}
    for name, text in items:
        w = words(text)
        k = min(window, len(w))
        for p in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[p:p + k]), set()).add("" if name is None else str(name))
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for p in range(len(w) - k + 1):
                if tuple(w[p:p + k]) in windows:
                    found |= windows[tuple(w[p:p + k])]
                    hit.update(range(p, p + k))
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return out


@pytest.mark.parametrize("block_bytes", [8_000_000, 200])
def test_contamination_on_edge_rows(spark, edge, empty, block_bytes):
    df, rows = edge
    text = dict(rows)
    items = [("a", text[8]), ("b", text[-3]), ("b", text[-3]), ("c", "ONE two"), ("d", None), ("e", ""), (None, text[16]),
             ("f", "日本語"), ("g", "in " * 12), ("10", text[14][:300])]
    benchmark = spark.createDataFrame(items, "item_id STRING, text STRING")
    out = decontaminate.find_contamination(df, benchmark, keep=("doc_id", "kept"), block_bytes=block_bytes)
    out = out.withColumn("n_hit", decontaminate.hit_words()).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(sorted(r["items"]))) for r in out) == Counter(
        plain_contamination(rows, items))
    longest = {r["doc_id"]: r["longest"] for r in out}
    assert longest[-3] == len(WORD.findall(text[-3])) and longest[2] == 0
    assert decontaminate.find_contamination(empty, benchmark).count() == 0
    assert all(not r["spans"] for r in decontaminate.find_contamination(df, benchmark.limit(0)).collect())


def test_suffix_array_by_words():
    seq = np.random.default_rng(1).integers(-1, 4, 300)
    order = decontaminate.suffix_array(seq, 400)
    assert order.tolist() == sorted(range(300), key=lambda p: seq[p:].tolist())
