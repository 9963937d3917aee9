import random

import pytest

from mailloom.operators.frontier import expand_frontier


def walk(starts, pages, edges, max_pages, per_level, queue_factor=5):
    """The same walk, one seed after the other, in plain Python."""
    out = set()
    for seed in {s for s, _ in starts}:
        waiting = [(0, 0, "", 0, u) for s, u in starts if s == seed]
        seen, used, level = {w[4] for w in waiting}, 0, 0
        while waiting:
            waiting.sort()
            taken = waiting[:per_level] if per_level else waiting
            rest = waiting[len(taken):]
            hits = [w for w in taken if w[4] in pages]
            if max_pages:
                hits = hits[:max_pages - used]
            used += len(hits)
            out |= {(seed, w[4], level) for w in hits}
            found = {}
            for w in hits:
                for src, dst, rank, seq in edges:
                    if src == w[4] and dst not in seen:
                        key = (rank, src, seq)
                        found[dst] = min(found.get(dst, key), key)
            seen |= set(found)
            waiting = rest + [(level + 1, *k, dst) for dst, k in found.items()]
            if max_pages and (used >= max_pages or len(waiting) > queue_factor * max_pages):
                break
            level += 1
    return out


@pytest.mark.parametrize("max_pages,per_level", [(None, None), (6, None), (None, 3), (9, 4), (3, 2)])
def test_against_plain_walk(spark, max_pages, per_level):
    rng = random.Random(max_pages or 0)
    urls = [f"p{i:02d}" for i in range(40)]
    pages = set(rng.sample(urls, 30)) | {"p00", "p01"}
    edges = [(rng.choice(urls), rng.choice(urls), rng.randint(0, 6), i) for i in range(110)]
    starts = [("p00", "p00"), ("p01", "p01"), ("p01", "p02")]
    got = expand_frontier(
        spark.createDataFrame(starts, "seed STRING, url STRING"),
        spark.createDataFrame([(p,) for p in pages], "url STRING"),
        spark.createDataFrame(edges, "src STRING, dst STRING, class_rank INT, class_seq INT"),
        max_pages=max_pages, per_level=per_level)
    rows = [tuple(r) for r in got.select("seed", "url", "level").collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == walk(starts, pages, edges, max_pages, per_level)


def test_level_limit_and_empty(spark):
    empty = spark.createDataFrame([], "seed STRING, url STRING")
    pages = spark.createDataFrame([("a",), ("b",)], "url STRING")
    edges = spark.createDataFrame([("a", "b", 0, 0)],
                                  "src STRING, dst STRING, class_rank INT, class_seq INT")
    assert expand_frontier(empty, pages, edges).count() == 0
    one = spark.createDataFrame([("a", "a")], "seed STRING, url STRING")
    assert expand_frontier(one, pages, edges, max_levels=1).count() == 1
    assert expand_frontier(one, pages, edges).count() == 2


def test_a_level_moves_only_new_links(spark):
    """What was visited lies in buckets: no level shuffles it, and later ones only append."""
    from mailloom import session
    from mailloom.operators import frontier

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    name = session.store_bucketed(spark.createDataFrame([("s", f"u{i}") for i in range(50)], "seed STRING, url STRING"), "seed", "url")
    try:
        links = spark.createDataFrame([("u1", f"v{i}", 0, i, None) for i in range(9)] + [("u1", "u7", 0, 99, None)],
                                      "src STRING, dst STRING, class_rank INT, class_seq INT, sub_rank INT")
        hits = spark.createDataFrame([("s", "u1")], "seed STRING, url STRING")
        for level in (1, 2):
            out = frontier._new_links(hits, links, spark.table(name), level)
            plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
            at = next(i for i, line in enumerate(plan) if "FileScan" in line and name in line)
            join = max(i for i, line in enumerate(plan[:at]) if "LeftAnti" in line)
            assert "Bucketed: true" in plan[at]
            right = plan[join + 1:at + 1]
            depth = len(right[-1]) - len(right[-1].lstrip(" :+-"))
            above = []
            for line in reversed(right[:-1]):  # the operators between the scan and the join
                d = len(line) - len(line.lstrip(" :+-"))
                if d < depth:
                    above.append(line)
                    depth = d
            assert not [x for x in above if "Exchange" in x], above
            assert {r["url"] for r in out.collect()} == ({f"v{i}" for i in range(9)} if level == 1 else set())
            session.append_bucketed(out.select("seed", "url"), name, "seed", "url")
        assert spark.table(name).count() == 59
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        session.drop_stored(spark, name)
