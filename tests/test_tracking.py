from datetime import datetime, timedelta

import pytest

from mailloom.operators import tracking as TR

D = [datetime(2024, 1, 1) + timedelta(days=i) for i in range(20)]


@pytest.fixture()
def tables(spark):
    log = spark.createDataFrame(
        [("A@u.dz", D[0], "Sent", "ta"), ("b@u.dz", D[0], "Delivered", "tb"),
         ("c@u.dz", D[0], "Sent", "tc"), ("d@u.dz", D[0], None, "td")],
        "email STRING, sent_date TIMESTAMP, status STRING, tracking_id STRING")
    opens = spark.createDataFrame([("ta", D[2]), ("ta", D[1]), ("tb", D[3]), ("zz", D[3])],
                                  "tracking_id STRING, ts TIMESTAMP")
    replies = spark.createDataFrame(
        [(1, "a@u.dz", D[4], "Demo Scheduled"), (2, "a@u.dz", D[6], "Leads"),
         (3, "b@u.dz", D[5], "Unsubscribe")],
        "message_id INT, email STRING, received_date TIMESTAMP, classification STRING")
    return log, opens, replies


def test_master(spark, tables):
    log, opens, replies = tables
    bounced = spark.createDataFrame([("c@u.dz", "Bounced")], "email STRING, status STRING")
    buyers = spark.createDataFrame([("a@u.dz", D[9])], "email STRING, customer_date TIMESTAMP")
    m = {r["email"]: r for r in TR.build_master(
        log, opens, replies, status=bounced, customers=buyers).collect()}
    a = m["a@u.dz"]
    assert (a["opened"], a["opened_date"], a["opened_count"]) == (True, D[1], 2)
    assert (a["reply_date"], a["classification"], a["demo_date"]) == (D[6], "Leads", D[4])
    assert a["demo_scheduled"] and a["customer"] and a["customer_date"] == D[9]
    assert [m[e + "@u.dz"]["status"] for e in "abcd"] == [
        "Sent", "Unsubscribed", "Bounced", "Sent"]
    assert m["d@u.dz"]["opened_count"] == 0 and not m["d@u.dz"]["replied"]
    assert list(TR.master_as_text(TR.build_master(log, opens, replies)).columns) == list(
        TR.MASTER_COLUMNS)


def test_update_equals_rebuild(tables):
    log, opens, replies = tables
    old = TR.build_master(log, opens, replies.where("message_id = 1"))
    new = TR.update_master(old, replies.where("message_id > 1"))
    full = TR.build_master(log, opens, replies)
    assert sorted(map(tuple, new.collect()), key=str) == sorted(
        map(tuple, full.collect()), key=str)


def test_partial_folds_merge(tables):
    _, opens, replies = tables
    parts = TR.fold_opens(opens.where("ts < '2024-01-03'")).unionByName(
        TR.fold_opens(opens.where("ts >= '2024-01-03'")))
    assert sorted(TR.merge_open_folds(parts).collect()) == sorted(TR.fold_opens(opens).collect())
    parts = TR.fold_replies(replies.where("message_id = 2")).unionByName(
        TR.fold_replies(replies.where("message_id <> 2")))
    assert sorted(map(tuple, TR.merge_reply_folds(parts).collect()), key=str) == sorted(
        map(tuple, TR.fold_replies(replies).collect()), key=str)


def metrics(spark, rows):
    df = spark.createDataFrame(
        rows, "sent_date TIMESTAMP, opened BOOLEAN, replied BOOLEAN, reply_date TIMESTAMP, "
        "classification STRING, demo_scheduled BOOLEAN, customer BOOLEAN, "
        "customer_date TIMESTAMP, university STRING")
    return df


def test_metrics(spark):
    df = metrics(spark, [
        (D[0], True, True, D[2], "Leads", False, False, None, "U"),
        (D[0], True, False, None, None, False, False, None, "U"),
        (D[0], False, False, None, None, False, False, None, "V"),
        (D[0], False, False, None, None, False, False, None, None)])
    got = dict(map(tuple, TR.funnel_metrics(df).collect()))
    assert (got["Open Rate"], got["Reply Rate"], got["Open-to-Reply Rate"]) == (50, 25, 50)
    assert (got["Lead Conversion"], got["Demo Conversion"]) == (25, 0)
    assert got["Demo-to-Customer Rate"] is None and got["Average Time to Reply"] == 2
    by = TR.funnel_metrics(df, by=["university"]).where("metric = 'Open Rate'").collect()
    assert {(r["university"], r["is_total"]): r["value"] for r in by} == {
        ("U", 0): 100, ("V", 0): 0, (None, 0): 0, (None, 1): 50}


def test_no_sends(spark):
    assert all(r["value"] is None for r in TR.funnel_metrics(metrics(spark, [])).collect())


def test_summaries(spark):
    log = spark.createDataFrame([(1, "Sent"), (1, "Sent"), (2, "Bounced")],
                                "batch_number BIGINT, status STRING")
    assert sorted(map(tuple, TR.send_summary(log).collect())) == [(1, "Sent", 2),
                                                                  (2, "Bounced", 1)]
    assert sorted(map(tuple, TR.status_counts(log).collect())) == [("Bounced", 1), ("Sent", 2)]


def test_opens_of_every_mail_count(spark):
    log = spark.createDataFrame([("a@u.dz", D[0], "Sent", "t1"), ("A@u.dz", D[1], "Sent", "t2")],
                                "email STRING, sent_date TIMESTAMP, status STRING, tracking_id STRING")
    opens = spark.createDataFrame([("t2", D[3]), ("t2", D[2])], "tracking_id STRING, ts TIMESTAMP")
    replies = spark.createDataFrame([], "email STRING, received_date TIMESTAMP, classification STRING, message_id BIGINT")
    row = TR.build_master(log, opens, replies).collect()
    assert [(r["opened"], r["opened_count"], r["opened_date"], r["tracking_id"]) for r in row] == [(True, 2, D[2], "t1")]
