from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mailloom.operators import contacts as C

T = [datetime(2024, 1, d) for d in range(1, 9)]


def pages(spark, *htmls):
    return spark.createDataFrame(
        [(i, f"https://u.dz/{i}", h) for i, h in enumerate(htmls)],
        "page_id BIGINT, url STRING, html STRING")


def occ(spark, rows):
    return spark.createDataFrame(
        rows, "seq BIGINT, email STRING, domain STRING, source_url STRING, found_at TIMESTAMP")


def test_first_hit_and_methods(spark):
    html = ("<title>=T</title><meta content='see m.eta@u.dz'><a href='mailto:Ali.B@u.dz?s=1'>mail</a>"
            "<a href='mailto:X.Y@U.DZ'>n</a><b data-email='d.e@u.dz'>dd</b> ali.b@u.dz info@u.dz "
            "<script>var a='s.c@u.dz m.eta@u.dz'</script>")
    rows = C.extract_contacts(pages(spark, html, "<p>nothing</p>")).orderBy("rank").collect()
    assert [(r["email"], r["parse_method"]) for r in rows] == [
        ("ali.b@u.dz", "mailto_link"), ("d.e@u.dz", "data_attribute"), ("m.eta@u.dz", "meta_tag"),
        ("s.c@u.dz", "script_tag")]
    assert rows[0]["context_snippet"] == "mail" and rows[0]["page_title"] == "=T"
    assert rows[2]["context_snippet"] == "see m.eta@u.dz"
    assert {r["http_status"] for r in rows} == {"200"}


def test_mailto_suffix_is_case_sensitive_but_text_is_not(spark):
    rows = C.extract_contacts(pages(spark, "<a href='mailto:x.y@A.DZ'>x.y@A.DZ</a>")).collect()
    assert [(r["email"], r["parse_method"]) for r in rows] == [("x.y@a.dz", "regex_html")]


def test_extraction_has_no_shuffle(spark):
    plan = C.extract_contacts(pages(spark, "a.b@u.dz"))._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()


def test_consolidation_order(spark):
    df = occ(spark, [(0, "Ali.B@u.dz ", "", "u1", T[2]), (1, "ali.b@u.dz", "u.dz", "u2", T[1]),
                     (2, "ali.b@u.dz", "u.dz", "u1", T[3]), (3, "info@u.dz", "", "u1", T[0]),
                     (4, "nobody", "", "u1", T[0]), (5, "c.dd@u.dz", "", None, T[4])])
    rows = {r["email"]: r for r in C.consolidate_contacts(df).collect()}
    assert set(rows) == {"ali.b@u.dz", "c.dd@u.dz"}
    ali = rows["ali.b@u.dz"]
    assert (ali["sources"], ali["first_seen"], ali["domain"]) == (["u1", "u2"], T[1], "u.dz")
    assert rows["c.dd@u.dz"]["sources"] == []
    assert (ali["verified"], ali["status"], ali["notes"]) == ("false", "unknown", "")


@pytest.mark.parametrize("partitions", ["1", "4", "50"])
def test_hot_address_is_split_and_whole(spark, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        hot = spark.range(2000).select(
            "id", F.lit("hot.x@u.dz").alias("email"),
            F.concat(F.lit("u"), F.col("id") % 700).alias("source_url"))
        cold = spark.range(2000, 3000).select(
            "id", F.concat(F.lit("c.x"), F.col("id") % 100, F.lit("@u.dz")).alias("email"),
            F.concat(F.lit("v"), F.col("id")).alias("source_url"))
        df = hot.unionByName(cold).select(
            F.col("id").alias("seq"), "email", F.lit("u.dz").alias("domain"), "source_url",
            F.timestamp_seconds(F.col("id")).alias("found_at"))
        rows = C.consolidate_contacts(df, sources_per_part=64).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    parts = sorted((r["part"], r["sources"]) for r in rows if r["email"] == "hot.x@u.dz")
    assert [len(s) for _, s in parts] == [64] * 10 + [60] and [p for p, _ in parts] == list(range(11))
    assert [u for _, s in parts for u in s] == [f"u{i}" for i in range(700)]
    rest = [r for r in rows if r["email"] != "hot.x@u.dz"]
    assert len(rest) == 100 and all(r["part"] == 0 and len(r["sources"]) == 10 for r in rest)


def test_sources_explode_and_reclean(spark):
    clean = spark.createDataFrame([("a.bc@u.dz", "u1;u2"), ("info@u.dz", "u1"), ("x", "u3"),
                                   ("abc@u.dz", "")], "email STRING, sources STRING")
    assert C.explode_sources(clean).count() == 4
    assert sorted(r["email"] for r in C.reclean(clean).collect()) == ["a.bc@u.dz", "abc@u.dz"]
    assert C.clean_counts(clean).first().asDict() == {
        "n_total": 4, "n_invalid": 1, "n_removed": 2, "n_remaining": 1}


def test_diagnostics(spark):
    p = pages(spark, "<p>a @ b .dz</p>", "<p>a.bc@u.dz</p>", "<title>403</title>" + "x" * 10000)
    rows = C.page_diagnostics(p).orderBy("page_id").collect()
    assert [r["n_emails"] for r in rows] == [0, 1, 0]
    assert [r["unmatched_address"] for r in rows] == [True, False, False]
    assert [r["needs_render"] for r in rows] == [True, False, False]
    assert [r["is_blocked"] for r in rows] == [False, False, True]


def test_sources_of_a_large_address_keep_their_order_over_all_parts(spark):
    """25,000 sources that come in an order unlike that of their names, some again later, one without."""
    n = 25_000
    hot = spark.range(n + 5_000).select(
        F.col("id").alias("seq"), F.lit("hot.x@u.dz").alias("email"), F.lit("").alias("domain"),
        F.concat(F.lit("u"), F.col("id") * 7919 % n).alias("source_url"),
        F.timestamp_seconds(F.lit(10 ** 9) - F.col("id")).alias("found_at"))
    more = occ(spark, [(-1, "hot.x@u.dz", "U.dz", "", T[0]), (40_000, "cold.x@u.dz", "", "u1", T[1])])
    rows = C.consolidate_contacts(hot.repartition(7).unionByName(more)).collect()
    parts = sorted((r["part"], r["sources"]) for r in rows if r["email"] == "hot.x@u.dz")
    assert [(p, len(s)) for p, s in parts] == [(0, 10_000), (1, 10_000), (2, 5_000)]
    assert [u for _, s in parts for u in s] == [f"u{i * 7919 % n}" for i in range(n)]
    heads = {(r["domain"], r["first_seen"].timestamp()) for r in rows if r["email"] == "hot.x@u.dz"}
    assert heads == {("u.dz", float(10 ** 9 - n - 4_999))}
    assert [r["sources"] for r in rows if r["email"] == "cold.x@u.dz"] == [["u1"]]
