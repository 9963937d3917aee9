"""Language identification and language-model scoring."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
from llm_helpers import SF, by_key
from pyspark.sql import functions as F

from mailloom.llm import langid, lm
from mailloom.llm import queries as Q


def plain_viterbi(scores, penalty):
    best, back = [list(scores[0])], []
    for row in scores[1:]:
        last = best[-1]
        top = max(range(len(row)), key=lambda k: last[k])
        step = [k if last[k] >= last[top] - penalty else top for k in range(len(row))]
        back.append(step)
        best.append([max(last[k], last[top] - penalty) + row[k] for k in range(len(row))])
    state = max(range(len(scores[0])), key=lambda k: best[-1][k])
    out = [state]
    for step in reversed(back):
        state = step[state]
        out.append(state)
    return out[::-1]


def test_viterbi_side_by_side_equals_one_by_one():
    rng = np.random.default_rng(5)
    lengths = np.array([0, 7, 1, 300, 40, 40, 0, 3])
    scores = rng.normal(0, 3, (lengths.sum(), 4)).astype(np.float32)
    got = langid.viterbi(scores, lengths, 4.0)
    at = 0
    for n in lengths:
        if n:
            own = scores[at:at + n].astype(float)
            want = plain_viterbi(own, 4.0)
            value = lambda p: sum(own[i, k] - 4.0 * (i > 0 and p[i - 1] != k) for i, k in enumerate(p))
            assert abs(value(got[at:at + n].tolist()) - value(want)) < 1e-3
        at += n


def test_ngrams_by_hand():
    owner, bucket = langid.ngrams(["ab", "c"])
    # ab: a b | ' a' 'ab' 'b ' | ' ab' 'ab ' | ' ab '; c: c | ' c' 'c ' | ' c '
    assert Counter(owner.tolist()) == {0: 8, 1: 4}
    again = langid.ngrams(["c"])[1]
    assert sorted(bucket[owner == 1]) == sorted(again)


def test_scripts_narrow_the_candidates(spark):
    rows = [(i, "the cat and the dog and the house", "en") for i in range(20)] + [
        (100 + i, "это кошка и собака и дом", "ru") for i in range(20)]
    scorer = langid.fit(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING"))
    assert scorer.languages == ["en", "ru"]
    mixed = "the cat and the dog and the house and the cat " * 2 + "это кошка и собака " * 6
    out = langid.identify(spark.createDataFrame([(1, mixed), (2, "дом"), (3, "12 34 !"), (4, None)],
                                                "doc_id BIGINT, text STRING"), scorer).collect()
    assert [r["lang_pred"] for r in out] == ["ru", "ru", "und", "und"]
    assert [s["lang"] for s in out[0]["spans"]] == ["en", "ru"] and out[2]["score"] == 0
    assert sum(s["words"] for s in out[0]["spans"]) == len(langid.words_of(mixed))


def test_more_languages_than_a_byte_holds(spark):
    word = lambda k: chr(97 + k % 26) * 3 + chr(97 + k // 26) * 3
    rows = [(3 * k + i, f"{word(k)} " * 20, f"l{k:03}") for k in range(160) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    out = langid.identify(df, langid.fit(df), keep=("doc_id", "lang")).collect()
    assert len(out) == 480 and all(r["lang_pred"] == r["lang"] for r in out)


def test_language_on_edge_rows(edge, empty):
    df, rows = edge
    scorer = langid.fit(df, max_rows=5)
    out = langid.identify(df, scorer, keep=("doc_id", "score"))
    out = [(r[0], r["lang_pred"]) for r in out.collect()]
    assert Counter(i for i, _ in out) == Counter(i for i, _ in rows)
    und = {i for i, t in rows if not langid.words_of(t)}
    assert {i for i, p in out if p == "und"} >= und - {None}
    nothing = langid.fit(empty)
    assert {r["lang_pred"] for r in langid.identify(df, nothing).collect()} == {"und"}
    assert langid.identify(empty, scorer).count() == 0


def test_language_query_is_right_on_held_out_rows(spark):
    out = by_key(Q.llm_queries()["op5_viterbi_language"](spark, SF))
    truth = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet'").fetchall()
    held = [i for i, _, _ in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {k for k, r in out.items() if r["held_out"]} == set(held)
    judged = [(out[i]["lang_pred"], lang) for i, t, lang in truth if i in set(held) and lang and langid.words_of(t)]
    assert sum(a == b for a, b in judged) >= 0.95 * len(judged)
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_gradients_against_differences():
    model = lm.GatedModel(30, hidden=5, class_size=7, seed=1)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    rng = np.random.default_rng(2)
    ids, target = rng.integers(0, 30, (3, 6)), rng.integers(0, 30, (3, 6))
    live = np.ones((3, 6), bool)
    live[1, 4:] = False
    h = rng.normal(size=(3, 5))
    _, grads, _ = model.window(h, ids, target, live)
    for name, g in grads.items():
        for at in [tuple(rng.integers(0, s) for s in g.shape) for _ in range(4)]:
            old = model.w[name][at]
            losses = []
            for d in (1e-5, -1e-5):
                model.w[name][at] = old + d
                losses.append(model.window(h, ids, target, live)[2])
            model.w[name][at] = old
            assert abs((losses[0] - losses[1]) / 2e-5 - g[at]) < 1e-4


def test_scores_are_probabilities_and_do_not_depend_on_windows():
    model = lm.GatedModel(40, seed=3)
    rng = np.random.default_rng(4)
    lengths = np.array([1, 50, 7, 130])
    ids = rng.integers(0, 40, lengths.sum())
    whole = lm.document_scores(model, ids, lengths, 3, width=1000)
    assert np.allclose(whole, lm.document_scores(model, ids, lengths, 3, width=3, lanes=2), rtol=1e-5)
    h = rng.normal(size=(1, model.hidden)).astype(np.float32).repeat(40, 0)
    assert abs(np.exp(model.log_probs(h, np.arange(40))[0]).sum() - 1) < 1e-4


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_base(rows, trained):
    tokens = [(i, WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + [None]) for i, t in rows]
    counts = Counter(w for k, (_, ws) in enumerate(tokens) if trained[k] for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [(i, len(ws), sum(counts[w] > 0 for w in ws), round(sum(
        math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 4)) for i, ws in tokens], n


def test_base_scores_on_edge_rows(edge, empty):
    df, rows = edge
    training = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True))
    out, known = lm.score_documents(df, training, block_bytes=20_000)
    want, n = plain_base(rows, [i is None or i % 3 != 0 for i, _ in rows])
    got = out.collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in got) == Counter(want)
    assert known.tokens == n and all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert lm.score_documents(empty, training)[0].count() == 0


def test_score_query_beats_the_base_on_held_out_rows(spark):
    out = by_key(Q.llm_queries()["op9_gated_scores"](spark, SF))
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs}
    want, n = plain_base(docs, [not held[i] for i, _ in docs])
    assert {(i, r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for i, r in out.items()} == set(want)
    assert {i: r["held_out"] for i, r in out.items()} == held and {r["train_tokens"] for r in out.values()} == {n}
    rows = [r for r in out.values() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_model_learns_from_all_training_documents(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(12)) + " and the end") for i in range(10_000)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    training = F.col("doc_id") % 5 != 1
    _, known = lm.score_documents(df, training)
    assert known.learned == known.tokens == 8000 * 16
    assert known.size - 1 == lm.vocabulary_size(8000 * 12 + 4) > 2000  # grows with the distinct tokens
    monkeypatch.setattr(lm, "_PART_BYTES", 500_000)  # several partitions
    _, known = lm.score_documents(df, training)
    assert known.learned == known.tokens


def test_long_documents_are_learned_from_as_a_whole():
    """Every token of every stretch is a target once, after the token before it."""
    trainer, seen = lm.Trainer(lm.first_weights(np.ones(50)), 0.01), Counter()
    rng = np.random.default_rng(3)
    lengths = np.array([1, 2000, 512, 513, 40])
    ids = rng.integers(0, 50, lengths.sum())
    keep = trainer.model.window

    def window(h, before, target, live, grads):
        assert not any(x.any() for x in grads.values())  # cleared after each window
        seen.update(zip(before[live].tolist(), target[live].tolist()))
        return keep(h, before, target, live, grads)

    trainer.model.window = window
    trainer.learn(ids, lengths, 7)
    start = np.cumsum(lengths) - lengths
    assert seen == Counter((7 if i in set(start.tolist()) else int(ids[i - 1]), int(x)) for i, x in enumerate(ids))


def test_few_and_many_targets_score_alike():
    model = lm.GatedModel(96, seed=3)
    rng = np.random.default_rng(4)
    h, target = rng.normal(size=(300, model.hidden)).astype(np.float32), rng.integers(0, 96, 300)
    whole = model.log_probs(h, target)[0]
    assert np.allclose(whole, [model.log_probs(h[i:i + 1], target[i:i + 1])[0][0] for i in range(300)], atol=1e-4)


def test_average_of_weights_keeps_what_one_partition_learned():
    w = lm.first_weights(np.ones(3000))
    other = {k: x + 1 for k, x in w.items()}
    met = np.zeros(3000, np.float32)
    met[7] = 5
    rows = [*lm._pack(w, np.zeros(3000, np.float32), 30), *lm._pack(other, met, 10)]
    out = []
    for shard in sorted({r[0] for r in rows}):
        part = lm.pa.Table.from_pylist([dict(zip(("shard", "n", "seen", "w"), r)) for r in rows if r[0] == shard])
        out.append((shard, lm._average(part).column("w")[0].as_py()))
    got = lm._unpack(out, w)
    assert {k: x.shape for k, x in got.items()} == {k: x.shape for k, x in w.items()}
    assert np.allclose(got["u"], w["u"] + 0.25) and np.allclose(got["x"][7], other["x"][7], atol=1e-3)
    assert np.allclose(got["ob"][2999], w["ob"][2999] + 0.25)


def test_many_classes_are_factored_again():
    model = lm.GatedModel(122, hidden=5, class_size=4, seed=1)
    assert model.groups > 1 and model.groups + model.fan + model.class_size < model.classes  # numbers for a target
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    rng = np.random.default_rng(2)
    h = rng.normal(size=(1, 5)).repeat(122, 0)
    assert abs(np.exp(model.log_probs(h, np.arange(122))[0]).sum() - 1) < 1e-9
    ids, target, live, h = rng.integers(0, 122, (30, 6)), rng.integers(0, 122, (30, 6)), np.ones((30, 6), bool), rng.normal(size=(30, 5))
    target[:20] = 121  # more of one class than a block holds, the last class being short
    grads = model.window(h, ids, target, live)[1]
    for name, g in grads.items():
        for at in [tuple(rng.integers(0, s) for s in g.shape) for _ in range(6)] + [tuple(s - 1 for s in g.shape)]:
            old, losses = model.w[name][at], []
            for d in (1e-5, -1e-5):
                model.w[name][at] = old + d
                losses.append(model.window(h, ids, target, live)[2])
            model.w[name][at] = old
            assert abs((losses[0] - losses[1]) / 2e-5 - g[at]) < 1e-4


def test_large_weights_do_not_overflow():
    model, rng = lm.GatedModel(3000, seed=1), np.random.default_rng(2)
    model.w = {k: v * 300 for k, v in model.w.items()}
    h = rng.uniform(-1, 1, (1, model.hidden)).astype(np.float32).repeat(3000, 0)
    found = model.log_probs(h, np.arange(3000))[0]
    assert np.isfinite(found).all() and abs(np.exp(found).sum() - 1) < 1e-3


def test_windows_stay_full():
    """Lanes go on with the next stretch, so few places of the windows are empty."""
    trainer, places, rng = lm.Trainer(lm.first_weights(np.ones(50)), 0.01), [], np.random.default_rng(3)
    lengths, keep = rng.integers(1, 600, 2000), trainer.model.window
    trainer.model.window = lambda h, b, t, live, g: places.append(live.size) or keep(h, b, t, live, g)
    trainer.learn(rng.integers(0, 50, lengths.sum()), lengths, 7)
    full = min(max(lm.BATCH, 2200 // 8), lm.LARGE_BATCH) * lm.WINDOW
    assert sum(places) < 1.06 * lengths.sum() and len(places) < 1.15 * lengths.sum() / full


def test_scores_by_hand():
    """Gates, candidate and all levels of the softmax, one token after the other; a long document takes few windows."""
    model, rng = lm.GatedModel(122, hidden=5, class_size=4, seed=1), np.random.default_rng(2)
    model.w = {k: v * 5 for k, v in model.w.items()}
    model.w |= {k: rng.normal(size=model.w[k].shape).astype(np.float32) for k in ("ob", "cb", "gb")}
    w, k, head = {n: x.astype(float) for n, x in model.w.items()}, 5, model.head
    assert model.groups > 1 and head > 0
    lengths, want = np.array([3, 20_000, 40]), []
    ids = rng.integers(0, 122, lengths.sum())
    softmax = lambda x, i: x[i] - x.max() - np.log(np.exp(x - x.max()).sum())
    for doc in np.split(ids, np.cumsum(lengths)[:-1]):
        h, last, total = np.zeros(k), 7, 0.0
        for i in doc.tolist():
            x = w["x"][last]
            z, r = np.split(1 / (1 + np.exp(-(h @ w["u"] + x[:2 * k]))), 2)
            n = np.tanh((r * h) @ w["n"] + x[2 * k:])
            h, last = z * h + (1 - z) * n, i
            words, classes, groups = w["o"] @ h + w["ob"], h @ w["c"] + w["cb"], h @ w["g"] + w["gb"]
            c = (i - head) // 4
            total += softmax(np.concatenate((words[:head], groups)), i if i < head else head + c // model.fan)
            if i >= head:
                g = c // model.fan * model.fan
                total += softmax(classes[g:g + model.fan], c - g) + softmax(words[head:][4 * c:4 * c + 4], i - head - 4 * c)
        want.append(total)
    calls, keep = [], model.log_probs
    model.log_probs = lambda *a: calls.append(1) or keep(*a)
    assert np.allclose(lm.document_scores(model, ids, lengths, 7), want, rtol=1e-4)
    assert len(calls) < 10


def test_tokens_are_found_whatever_their_prefix():
    top = (1 << 64) - 1
    hashes = np.array([5, 6, 7, 1 << 63, (1 << 63) + 1, top - 2, top - 1], np.uint64)
    known = lm.Vocabulary(hashes, np.arange(1, 8), 0, 0, 0, 8)
    tokens = [0, 5, 6, 7, 8, 1 << 63, (1 << 63) + 1, (1 << 63) + 2, top - 3, top - 2, top - 1, top, 1 << 40]
    assert known.encode(np.array(tokens, np.uint64)).tolist() == [0, 1, 2, 3, 0, 4, 5, 0, 0, 6, 7, 0, 0]


def test_hashes_do_not_depend_on_what_is_hashed_together():
    texts = ["Ab c", None, "x ab\x0by " * 60_000, "c", "é ab"]  # one longer than the powers that are kept
    words, n = lm.token_hashes(texts)
    alone = [lm.token_hashes([t]) for t in texts]
    assert words.tolist() == [h for a, _ in alone for h in a.tolist()] and n.tolist() == [int(x[0]) for _, x in alone]
    assert (words == lm.token_hashes(texts, 10_000_000)[0]).all() and len(set(words.tolist())) == 6
