"""Packing, resharding and archives: exact round trips and brute force."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from llm_helpers import SF, by_key
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mailloom.llm import packing, sharding, warc
from mailloom.llm import queries as Q
from mailloom.llm.common import global_index, remainder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def check_packing(rows, capacity):
    """Gapless, within the capacity; returns the number of sequences."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def plain_pieces(rows, capacity=2048):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    out = Counter()
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        head = len(ids) % capacity or capacity
        cuts = [0, *range(head, len(ids), capacity), len(ids)]
        for k, (a, b) in enumerate(itertools.pairwise(cuts)):
            out[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    return out


def test_packing_on_edge_rows(edge, empty):
    df, rows = edge
    rows = [*rows, (50, "a <|endoftext|> b"), (51, "ǅ Ⅷ x٣ ½ \x1c\x85 don't  \n\n ")]
    df = df.select("doc_id", "text").unionByName(df.sparkSession.createDataFrame(rows[-2:], "doc_id BIGINT, text STRING"))
    for capacity in (2048, 50):
        out = packing.pack(df, VOCABULARY, capacity=capacity, ids=True).collect()
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == plain_pieces(rows, capacity)
        assert check_packing(out, capacity) <= 1.1 * sum(r["length"] for r in out) / capacity + 2
        assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in out)
    assert packing.pack(empty, VOCABULARY).count() == 0


def test_packing_query(spark):
    rows = Q.llm_queries()["op6_reduced_packing"](spark, SF).collect()
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == plain_pieces(docs)
    n = check_packing(rows, 2048)
    assert n <= -(-sum(r["length"] for r in rows) // 2048) + 1


def fewest(sizes, capacity):
    """Fewest bins by trying all placements."""
    best = [len(sizes)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity:
                bins[k] += sizes[i]
                put(i + 1, bins)
                bins[k] -= sizes[i]
        put(i + 1, [*bins, sizes[i]])

    sizes = sorted(sizes, reverse=True)
    put(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(40))
def test_reduction_keeps_an_optimum_and_best_fit_is_close(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 17, 30])
    sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
    packer = packing.Packer(dict(Counter(sizes)), capacity)
    fixed = packer.reduce()
    rest = [s for s, n in packer.counts.items() for _ in range(n)]
    assert fixed + fewest(rest, capacity) == fewest(sizes, capacity)  # the fixed sets lose nothing
    packer.best_fit()
    load, count = Counter(), Counter()
    for size, n, first, offset in packer.runs:
        count[size] += n
        for s in range(first, first + n):
            load[s] = max(load[s], offset + size)
    assert count == Counter(sizes) and max(load.values()) <= capacity and len(load) == packer.sequences
    assert packer.sequences <= fewest(sizes, capacity) + 1


def test_global_index_is_gapless(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    rows = sorted((r["i"], r["k"], r["id"]) for r in global_index(df, ["k", "id"], "i").collect())
    assert [i for i, _, _ in rows] == list(range(1000)) and rows == sorted(rows, key=lambda r: r[1:])


def test_flow_moves_the_fewest_bytes():
    rng = random.Random(2)
    for _ in range(60):
        n, m = rng.randint(1, 4), rng.randint(1, 4)
        old = [rng.randint(0, 5) for _ in range(n)]
        total = sum(old)
        room = [total // m + (j < total % m) for j in range(m)]
        found = sharding.transfers(old, room)
        assert found.sum(1).tolist() == old and all(found.sum(0) <= room)
        kept = sum(found[i, i] for i in range(min(n, m)))
        assert kept == sum(min(old[i], room[i]) for i in range(min(n, m)))  # no plan can keep more


def test_resharding_on_edge_rows(spark, edge, empty):
    df, rows = edge
    folder, plan, shards = sharding.reshard(df, remainder("doc_id", 3), 3, 4, blocks_per_shard=8)
    out = spark.read.parquet(folder).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter(rows) and "class_id" in out[0].asDict()
    for j in {r["_shard"] for r in out}:
        assert sorted(r["_slot"] for r in out if r["_shard"] == j) == list(range(sum(r["_shard"] == j for r in out)))
    assert sum(r["bytes"] for r in shards.collect()) == sum(len((t or "").encode()) + 1 for _, t in rows)
    assert all(r["rewritten"] == (r["moved_bytes"] > 0) for r in shards.collect())
    folder, plan, _ = sharding.reshard(empty, F.lit(0), 1, 2)
    assert plan.count() == 0


def test_resharding_with_columns_of_any_name(spark):
    df = spark.createDataFrame([(i, "t" * i, "a", "b", "c", "d", "e") for i in range(30)],
                               "doc_id INT, text STRING, _size STRING, _slot STRING, _shard STRING, _first STRING, _block STRING")
    folder, _, _ = sharding.reshard(df, F.col("doc_id") % 3, 3, 4)
    out = spark.read.parquet(folder).collect()
    assert sorted((r["doc_id"], r["_size"], r["_first"], r["_block"]) for r in out) == [(i, "a", "d", "e") for i in range(30)]
    assert all(isinstance(r["_slot"], int) and r["_shard"] in range(4) for r in out)


def test_resharding_query(spark):
    out = by_key(Q.llm_queries()["op7_flow_resharding"](spark, SF))
    docs = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall()
    assert {(i, r["size"], r["text_crc32"]) for i, r in out.items()} == {
        (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in docs}
    load = Counter()
    for j in range(16):
        own = [r for r in out.values() if r["shard"] == j]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        load[j] = sum(r["size"] for r in own)
    largest = max(r["size"] for r in out.values())
    assert max(load.values()) - min(load.values()) <= largest


def test_archive_round_trip(spark):
    same = "<p>" + "x" * 1200 + "</p>"
    rows = [(1, "http://a/1", same), (2, "http://a/2", same), (3, "http://a/3", "short"), (4, "http://a/4", "short"),
            (5, None, None), (6, "http://a/6 7\r\n", ""), (7, "http://a/7", "é" * 500), (8, "http://a/8", "é" * 500),
            (None, "http://a/n", same), (9, "http://a/9", "y" * 400_000), (10, "u", "\r\n\r\nWARC/1.1\r\n"), (2, "http://a/2", same)]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").withColumn("_digest", F.lit("clash"))
    index = warc.write_archives(pages)
    out = warc.read_archives(spark, index).collect()
    got = Counter((r["record"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out)
    want = Counter()
    for k, _, html in rows:
        body = (html or "").encode()
        equal = [i for i, _, h in rows if (h or "") == (html or "") and i is not None]
        last = max(equal, default=None)
        again = len(body) >= 1000 and last is not None and (k is None or k < last)
        want[(None if k is None else str(k), len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response",
              str(last) if again else None)] += 1
    assert got == want
    payloads = {r["record"]: bytes(r["payload"]) for r in out if r["record_type"] == "response"}
    for r in index.collect():  # every index entry leads to its own record
        headers, block = warc.read_record(r["bundle"], r["frame"], r["offset"], r["length"])
        key = headers["WARC-Record-ID"][len("<urn:page:"):-1] or None
        assert key == (None if r["page_id"] is None else str(r["page_id"]))
        if headers["WARC-Type"] == "response":
            assert block.split(b"\r\n\r\n", 1)[1] == payloads[key]
    none = spark.createDataFrame([], "page_id BIGINT, url STRING, html STRING")
    read = warc.read_archives(spark, index)
    assert read.rdd.getNumPartitions() == index.select("bundle").distinct().count()  # a task for each part, few frames each here
    assert warc.read_archives(spark, warc.write_archives(none)).count() == 0
