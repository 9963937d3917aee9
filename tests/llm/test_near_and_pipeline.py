"""Near-duplicate classes against all pairs, and the pipeline stage by stage."""

import hashlib
import itertools
import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import SF, by_key, prose
from test_layout import check_packing, plain_pieces
from test_matches import plain_contamination, plain_removal

import corpus_pipeline
from mailloom.llm import minhash, quality
from mailloom.llm import queries as Q


def shingle_counts(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    k = min(5, len(words))
    return Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if words else Counter()


def plain_similarity(a, b):
    if not a or not b:
        return 0.0
    both, union = a.keys() & b.keys(), a.keys() | b.keys()
    if max(a.values()) == max(b.values()) == 1:  # both measures are equal
        return len(both) / len(union)
    weighted = sum(1 / sum(max(a[y] / a[x], b[y] / b[x]) for y in union) for x in both)
    return max(len(both) / len(union), weighted)


def plain_classes(rows):
    """Components over all pairs; equal ids are one node."""
    counts = [(i, shingle_counts(t)) for i, t in rows]
    label = {i: i for i, _ in counts}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    index = {}
    for n, (_, c) in enumerate(counts):
        for s in c:
            index.setdefault(s, []).append(n)
    pairs = {p for l in index.values() for p in itertools.combinations(l, 2)}
    for m, n in pairs:
        a, b = counts[m], counts[n]
        if plain_similarity(a[1], b[1]) >= 0.8 and top(a[0]) != top(b[0]):
            label[max(top(a[0]), top(b[0]))] = min(top(a[0]), top(b[0]))
    return {i: top(i) for i, _ in counts}


def test_similarity_of_multisets():
    rng = random.Random(1)
    for _ in range(50):
        texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 40))) for _ in range(2)]
        doc, code, weight, _, _ = minhash.shingles(texts)
        parts = [(code[doc == k].tobytes(), weight[doc == k].astype(np.uint32).tobytes()) for k in (0, 1)]
        got = minhash.similarity(*parts[0], *parts[1])
        assert abs(got - plain_similarity(*map(shingle_counts, texts))) < 1e-9


def test_registers_estimate_probability_jaccard():
    a, b = prose(1, 300), prose(1, 300).replace("e", "x", 9) + " " + prose(2, 40)
    doc, code, weight, n, _ = minhash.shingles([a, b])
    winners = minhash.signatures(doc, code, weight, 2, 4000)
    estimate = (winners[0] == winners[1]).mean()
    x, y = map(shingle_counts, (a, b))
    assert abs(estimate - plain_similarity(x, y)) < 0.05
    assert (minhash.signatures(doc, code, weight * 3, 2, 64) == minhash.signatures(doc, code, weight, 2, 64)).all()


def test_word_hashes_depend_on_words_alone():
    a, n = minhash.word_hashes(["Ab  c\td", None, "", "x ab", " é"])
    assert n.tolist() == [3, 0, 0, 2, 1] and a[0] == a[4] and len(set(a.tolist())) == 5


def test_classes_on_edge_rows(edge, empty):
    df, rows = edge
    got = [(r["doc_id"], r["class_id"], r["kept"]) for r in minhash.near_duplicates(df).collect()]
    want = plain_classes([(i, t) for i, t in rows if i is not None])
    assert Counter(i for i, _, _ in got if i >= -3) == Counter(i for i, _ in rows if i is not None)
    assert {i: c for i, c, _ in got if i >= -3} == want and all(k == (i == c) for i, c, k in got)
    assert sum(i < -3 for i, _, _ in got) == 2
    assert minhash.near_duplicates(empty).count() == 0


def test_large_groups_of_near_copies(spark):
    """Copies that each differ from the first, so that many pairs of them are below the threshold."""
    rng, rows = random.Random(7), []
    for family in range(3):
        words = prose(family, 150).split()
        for k in range(120):
            own = list(words)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(10 ** 6)}"
            rows.append((family * 1000 + k, " ".join(own)))
    passage = prose(50, 100)
    rows += [(5000 + k, passage + " " + prose(100 + k, 100)) for k in range(60)]  # alike, but not near copies
    rng.shuffle(rows)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()}
    assert got == plain_classes(rows)


def test_texts_that_share_a_passage_meet_only_if_their_rests_leave_room(spark, monkeypatch):
    """One passage and rests of their own: the links follow from the lengths, and few other pairs come up."""
    passage, r, found = prose(60, 200), random.Random(4), []
    rows = [(k, " ".join([f"r{k}w{i}" for i in range(r.randint(0, 70))]) + " " + passage + " " + " ".join(
        f"q{k}w{i}" for i in range(r.choice([0, 0, 9])))) for k in range(400)]
    keep = minhash._prefix_pairs
    monkeypatch.setattr(minhash, "_prefix_pairs", lambda *a: found.append(keep(*a)) or found[-1])
    got = {x["doc_id"]: x["class_id"] for x in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()}
    assert got == plain_classes(rows) and len(set(got.values())) > 40
    assert sum(df.distinct().count() for df in found) < 4 * len(rows)  # all pairs would be 80,000


def test_candidates_hold_every_pair_at_the_threshold(spark):
    """All pairs of the prefix join, every text in a class of its own, against all pairs."""
    r, texts = random.Random(3), []
    for family in range(12):
        words = [f"f{family}w{i}" for i in range(r.choice([6, 12, 40, 90]))]
        for _ in range(25):
            own = words[:]
            for _ in range(r.randint(0, 3)):
                own[r.randrange(len(own))] = f"x{r.randrange(10 ** 6)}"
            texts.append(" ".join(own[r.randint(0, 2):] + [f"y{r.randrange(10 ** 6)}" for _ in range(r.randint(0, 4))]
                                  + (own[:7] * 2 if r.random() < 0.1 else [])))
    rows = spark.createDataFrame([(t, i, i) for i, t in enumerate(texts)], "_text STRING, _id BIGINT, _key BIGINT")
    sketch = rows.mapInArrow(minhash._sketch(30, 5, 5), minhash._SKETCH).dropDuplicates(["_node"]).persist()
    sets = rows.select("_text").mapInArrow(minhash._sets(5), "_id long, _set binary, _counts binary").dropDuplicates(["_id"])
    nodes = sketch.selectExpr("_node AS id", "_node AS class")
    of = {x["_node"]: shingle_counts(texts[x["_id"]]) for x in sketch.collect()}
    got = {tuple(sorted(x)) for x in minhash._prefix_pairs(nodes, sets, sketch, 0.8, 150).collect()}
    want = {tuple(sorted(p)) for p in itertools.combinations(of, 2) if plain_similarity(of[p[0]], of[p[1]]) >= 0.8}
    assert want <= got and len(want) > 100


def test_ids_with_several_texts(spark):
    """Rows of one id share a class, and every text is compared."""
    a, b, c = prose(70, 90), prose(71, 90), prose(72, 90)
    rows = [(3, a), (5, a), (5, b), (7, c), (7, b + " x"), (8, c + " y"), (9, ""), (9, prose(73, 80)), (10, ""), (11, prose(73, 80))]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    out = minhash.near_duplicates(df).collect()
    assert sorted((x["doc_id"], x["class_id"]) for x in out) == [
        (3, 3), (5, 3), (5, 3), (7, 3), (7, 3), (8, 3), (9, 9), (9, 9), (10, 10), (11, 9)]
    kept = corpus_pipeline.near_duplicates(spark, df, SF).collect()
    assert len(kept) == 3 and {x["doc_id"] for x in kept} == {3, 9, 10}
    assert Counter(x["doc_id"] for x in out if x["kept"]) == {3: 1, 9: 1, 10: 1}


def repeated(seed, n, phrase, times):
    """Distinct words, then a phrase so often, each time in the same surroundings."""
    return " ".join([f"s{seed}w{k}" for k in range(n)] + [f"{phrase}{seed}p{k}" for _ in range(times) for k in range(20)])


def test_equal_sets_with_other_repeat_counts(spark):
    """Set Jaccard 1, probability Jaccard about a half: linked by the set alone."""
    rows = [(10 * s + k, repeated(s, 420, "q", times)) for s in range(40) for k, times in enumerate((2, 30))]
    a, b = (shingle_counts(t) for _, t in rows[:2])
    assert a.keys() == b.keys() and max(a.values()) < max(b.values())
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()}
    assert got == plain_classes(rows) and set(got.values()) == {10 * s for s in range(40)}


def test_registers_of_either_kind_keep_a_pair():
    texts = [repeated(1, 420, "q", 2), repeated(1, 420, "q", 30), prose(3, 400)]
    doc, code, weight, _, _ = minhash.shingles(texts)
    winners, own, plain = minhash.both_signatures(doc, code, weight, 3, 150)
    low = [x.tobytes() for x in winners.astype(np.uint8)]
    assert {0, 1} <= set(own.tolist())
    for i, x in zip(own.tolist(), plain.astype(np.uint8)):
        low[i] += x.tobytes()
    batch = pa.RecordBatch.from_pydict({"a": [0, 0], "b": [1, 2], "low": [low[0]] * 2, "low_b": [low[1], low[2]]})
    assert (winners[0] == winners[1]).mean() < 0.64
    out, = minhash._alike(0.8, 150)(iter([batch]))
    assert out.column("b").to_pylist() == [1]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (103, 100)]
    random.Random(1).shuffle(edges)
    from mailloom.llm.common import stored
    df = stored(spark.createDataFrame(edges, "a BIGINT, b BIGINT"), "t")
    assert {r["id"]: r["class"] for r in minhash.components(df).collect()} == {
        **dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 104), 100)}


def test_near_duplicate_query(spark):
    out = by_key(Q.llm_queries()["op8_probminhash_classes"](spark, SF))
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert {i: r["class_id"] for i, r in out.items()} == plain_classes(docs)


# --- The pipeline --------------------------------------------------------------

def plain_cut(rows, length=100):
    seen, out = set(), []
    for i, text in rows:
        raw = text.encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            w = raw[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        left = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
        if not any(gone) or left.strip():
            out.append((i, left))
    return out


def plain_pipeline(rows, items):
    rows = [(i, j[8]) for i, t in rows for j in [quality.judge(t)] if j[6]]
    yield rows
    classes = plain_classes(rows)
    rows = sorted(dict((i, t) for i, t in rows if classes[i] == i).items())
    yield rows
    rows = plain_cut(rows)
    yield rows
    bad = {i for i, _, hit, _ in plain_contamination(rows, items) if hit}
    yield [(i, t) for i, t in rows if i not in bad]


@pytest.fixture(scope="module")
def items():
    return duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()


def test_pipeline_equals_plain_python(spark, items):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    *_, last = plain_pipeline(docs, items)
    out = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == plain_pieces(last)
    check_packing(out, 2048)


def test_stages_on_edge_rows(spark, edge, empty, items):
    df, rows = edge
    for (name, stage), want in zip(corpus_pipeline.STAGES, plain_pipeline([r for r in rows if r[0] is not None], items)):
        df = stage(spark, df, SF)
        assert df.columns == edge[0].columns and df.dtypes == edge[0].dtypes, name
        got = df.collect()
        assert {(r["doc_id"], r["text"]) for r in got if r["doc_id"] is not None} == set(want), name
        assert all(r["n_chars"] == len(r["text"]) or name == "near_duplicates" for r in got)
        df = spark.createDataFrame(got, edge[0].schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


def test_digest_of_plain_removal():
    assert plain_removal([(1, "ab")])[0][4] == hashlib.sha256(b"ab").hexdigest()
