from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mailloom.functions.text import csv_safe, fill_template
from mailloom.operators import campaign as CA
from mailloom.operators.skew import top_k_per_group, with_global_index

START = datetime(2024, 3, 1, 9)


def people(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("p"), F.lpad(F.col("id").cast("string"), 4, "0"), F.lit("@u.dz"))
        .alias("email"))


def test_batches(spark):
    rows = CA.plan_sends(people(spark, 23), START).orderBy("email").collect()
    assert [r["batch_number"] for r in rows] == [1] * 10 + [2] * 10 + [3] * 3
    assert sorted({(r["planned_at"] - START).total_seconds() for r in rows}) == [0, 60, 120]


def test_caps(spark):
    rows = CA.plan_sends(people(spark, 50), START, daily_cap=7, monthly_cap=20,
                         batch_size=5).orderBy("email").collect()
    days = [r["planned_day"] for r in rows]
    assert days[:20] == [0] * 7 + [1] * 7 + [2] * 6
    assert days[20:27] == [30] * 7 and days[40] == 60
    # 30 daily caps fit into a month before the monthly cap does
    rows = CA.plan_sends(people(spark, 40), START, daily_cap=1, monthly_cap=1000).orderBy(
        "email").collect()
    assert [r["planned_day"] for r in rows] == list(range(40))
    assert CA.provider_caps("mailjet") == (200, 6000, None)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_global_index(spark, partitions):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("k"))
    rows = with_global_index(df, ["k"], partitions=partitions).collect()
    assert all(r["k"] == r["row_index"] for r in rows) and len(rows) == 500
    assert with_global_index(df.limit(0), ["k"]).count() == 0


def test_top_k(spark):
    df = spark.range(3000).select((F.col("id") % 3 % 2).alias("g"), "id")
    got = top_k_per_group(df, ["g"], [F.col("id").desc()], 4, ["id"], salts=8)
    assert sorted((r["g"], r["id"]) for r in got.collect()) == [
        (0, 2994), (0, 2996), (0, 2997), (0, 2999), (1, 2989), (1, 2992), (1, 2995), (1, 2998)]


def test_mails(spark):
    df = people(spark, 1).withColumn("name", F.lit("{{email}}")).withColumn(
        "university", F.lit(None).cast("string"))
    m = CA.build_mails(df, "c1", "To {{ name }} at {{$json.university}}", "<p>{{name}}</p>",
                       "https://t.example.org/").first()
    assert m["subject"] == "To {{email}} at "
    assert f"/track-open/{m['tracking_id']}" in m["body_html"]
    assert f"token={m['unsubscribe_token']}" in m["body_html"]
    assert m["tracking_id"] != m["unsubscribe_token"]


def test_template_keeps_unknown(spark):
    df = spark.createDataFrame([("{{a}} {{b}} {{ x", "1")], "t STRING, a STRING")
    assert df.select(fill_template(F.col("t"), {"a": F.col("a")})).first()[0] == "1 {{b}} {{ x"


def test_pilot_is_repeatable(spark):
    df = people(spark, 200)
    a = {r[0] for r in CA.pilot_sample(df, 20).collect()}
    b = {r[0] for r in CA.pilot_sample(df.repartition(7), 20).collect()}
    assert a == b and len(a) == 20


def test_split_results(spark):
    log = spark.createDataFrame([("a", "Sent"), ("b", "Bounced"), ("c", None)],
                                "email STRING, status STRING")
    sent, failed = CA.split_send_results(log)
    assert [r[0] for r in sent.collect()] == ["a"] and failed.count() == 2


def test_csv_safe(spark):
    df = spark.createDataFrame([("=1+1",), ("+a",), ("a=",), ("",), (None,)], "v STRING")
    assert [r[0] for r in df.select(csv_safe(F.col("v"))).collect()] == [
        "'=1+1", "'+a", "a=", "", None]


def test_days_do_not_overlap_and_seconds_are_kept(spark):
    rows = CA.plan_sends(people(spark, 300), START, batch_size=10, wait_seconds=60, per_second=1,
                         window_seconds=600).orderBy("send_index").collect()
    times = [r["planned_at"] for r in rows]
    assert len(set(times)) == 300 and times == sorted(times)  # one mail a second
    assert [r["planned_day"] for r in rows] == [i // 110 for i in range(300)]  # eleven batches start in the window
    assert CA.provider_caps("ses") == (200, None, 1)
    slow = CA.Pace(batch_size=100, wait_seconds=10, per_second=2)
    assert slow.batch_seconds == 50
