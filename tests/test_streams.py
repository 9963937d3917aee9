from datetime import datetime, timedelta

from pyspark.sql import functions as F

from mailloom.operators import replies as R
from mailloom.operators import tracking as TR
from mailloom.sources import readers as RD
from mailloom.sources import schemas
from mailloom.sources.sinks import route_by_class
from mailloom.streaming import jobs as ST

D = datetime(2024, 1, 1)


def arrive(df, folder, n):
    """Write rows as ``n`` files of a watched folder."""
    df.repartition(n).write.mode("append").parquet(folder)


def test_opens_equal_batch_over_restart(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    opens = spark.range(200).select(
        F.concat(F.lit("t"), F.col("id") % 17).alias("tracking_id"),
        F.timestamp_seconds(F.col("id") * 61 % 200).alias("ts"))
    arrive(opens.where("id < 120"), src, 3)
    stream = RD.stream_files(spark, src, schemas.OPENS, files_per_batch=1)
    ST.stream_opens(stream, out, cp).awaitTermination()
    arrive(opens.where("id >= 120"), src, 2)
    ST.stream_opens(stream, out, cp).awaitTermination()
    assert sorted(ST.read_opens(spark, out).collect()) == sorted(TR.fold_opens(opens).collect())
    assert ST.read_opens(spark, str(tmp_path / "none")).count() == 0


def test_running_opens(spark, tmp_path):
    src = str(tmp_path / "in")
    arrive(spark.createDataFrame([("a", D), ("a", D), ("b", D)], schemas.OPENS), src, 2)
    q = ST.running_opens(RD.stream_files(spark, src, schemas.OPENS)).writeStream.outputMode(
        "complete").format("memory").queryName("opens_now").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r["tracking_id"]: r["opened_count"] for r in spark.table("opens_now").collect()} == {
        "a": 2, "b": 1}


def test_replies_equal_batch(spark, tmp_path):
    src, routed, folds, cp = (str(tmp_path / x) for x in ("in", "routed", "folds", "cp"))
    texts = ["buy", "no thanks", "demo", "hello", "unsubscribe"]
    inbox = spark.createDataFrame(
        [(str(i), f"P{i % 7}@u.dz", "Offer" if i % 9 else "x", texts[i % 5],
          D + timedelta(minutes=i)) for i in range(60)], schemas.MESSAGES)
    people = spark.createDataFrame([(f"p{i}@u.dz", f"N{i}", "U") for i in range(6)],
                                   "email STRING, name STRING, university STRING")
    arrive(inbox, src, 4)
    stream = RD.stream_files(spark, src, schemas.MESSAGES, files_per_batch=2)
    ST.stream_replies(stream, people, ["offer"], "p0@u.dz", routed, folds, cp,
                      every=None).awaitTermination()
    chosen = R.classify_replies(R.select_replies(inbox, people, ["offer"], "p0@u.dz"))
    assert sorted(map(tuple, ST.read_reply_folds(spark, folds).collect()), key=str) == sorted(
        map(tuple, TR.fold_replies(chosen).collect()), key=str)
    back = RD.read_routed(spark, routed)
    assert back.count() == chosen.count()
    assert {(r["class_slug"], r["count"]) for r in back.groupBy("class_slug").count().collect()} \
        == {(r["slug"], r["count"]) for r in chosen.groupBy(
            R.class_slug(F.col("classification")).alias("slug")).count().collect()}


def test_routed_batches_are_read_whole_and_once(spark, tmp_path):
    """A reader at any time while a batch is repeated: after a broken attempt, between two, after both."""
    src, routed, folds, cp = (str(tmp_path / x) for x in ("in", "routed", "folds", "cp"))
    inbox = spark.createDataFrame([(str(i), f"p{i}@u.dz", "Offer", "buy" if i % 2 else "no thanks\n\\ now", D) for i in range(6)], schemas.MESSAGES)
    people = spark.createDataFrame([(f"p{i}@u.dz", "N", "U") for i in range(6)], "email STRING, name STRING, university STRING")
    count = lambda: sorted((r["class_slug"], r["body"]) for r in ST.read_routed_parts(spark, routed).collect())
    assert count() == []
    arrive(inbox.where("message_id < 4"), src, 1)
    broken = tmp_path / "routed" / "batch=0.a" / "class_slug=unsubscribes"
    broken.mkdir(parents=True)
    (broken / "part-0.csv").write_text("email\nhalf")
    run = lambda: ST.stream_replies(RD.stream_files(spark, src, schemas.MESSAGES), people, ["offer"], "x@u.dz", routed, folds, cp,
                                    every=None).awaitTermination()
    run()
    buy, no = ("potential_buyers", "buy"), ("not_interested", "no thanks\n\\ now")
    assert count() == [no] * 2 + [buy] * 2
    reader = ST.read_routed_parts(spark, routed)
    # A second complete attempt of the batch, as a driver that comes back may write it, adds nothing.
    classified = R.enrich_replies(R.classify_replies(R.select_replies(inbox, people, ["offer"], "x@u.dz")), people)
    route_by_class(classified, f"{routed}/batch=0.zz", "errorifexists")
    assert count() == [no] * 2 + [buy] * 2 and reader.count() == 4
    arrive(inbox.where("message_id >= 4"), src, 1)
    run()
    assert count() == [no] * 3 + [buy] * 3 and reader.count() == 4


def test_class_counts(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    inbox = spark.createDataFrame([(str(i), "a@u.dz", "s", ["buy", "x"][i % 2], D)
                                   for i in range(10)], schemas.MESSAGES)
    arrive(inbox, src, 3)
    ST.stream_class_counts(RD.stream_files(spark, src, schemas.MESSAGES, files_per_batch=1), out,
                           cp).awaitTermination()
    assert sorted(ST.read_class_counts(spark, out).collect()) == sorted(
        R.class_counts(R.classify_replies(inbox)).collect())


def test_unsubscribes(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    arrive(spark.createDataFrame([("t1", D), ("t1", D), ("t2", D), ("bad", D)],
                                 schemas.UNSUBSCRIBES), src, 3)
    tokens = spark.createDataFrame([("t1", "a@u.dz"), ("t2", "b@u.dz")],
                                   "token STRING, email STRING")
    ST.stream_unsubscribes(RD.stream_files(spark, src, schemas.UNSUBSCRIBES, files_per_batch=1),
                           tokens, out, cp).awaitTermination()
    assert sorted(r["email"] for r in ST.read_unsubscribes(spark, out).collect()) == [
        "a@u.dz", "b@u.dz"]


def test_contacts_once_per_url(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    pages = spark.createDataFrame(
        [(1, "https://u.dz/a", "a.bc@u.dz"), (2, "https://u.dz/b", "x.yz@u.dz none"),
         (3, "https://u.dz/login", "l.og@u.dz")], schemas.PAGES)
    arrive(pages, src, 2)
    stream = RD.stream_files(spark, src, schemas.PAGES)
    ST.stream_contacts(stream, out, cp).awaitTermination()
    arrive(spark.createDataFrame([(4, "https://u.dz/a/", "a.bc@u.dz")], schemas.PAGES), src, 1)
    ST.stream_contacts(stream, out, cp).awaitTermination()
    rows = ST.read_contact_parts(spark, out).select("email", "source_url").collect()
    assert sorted(map(tuple, rows)) == [("a.bc@u.dz", "https://u.dz/a"),
                                        ("x.yz@u.dz", "https://u.dz/b")]


def test_late_requests_and_pages_are_kept(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    tokens = spark.createDataFrame([(f"t{i}", f"e{i}@u.dz") for i in range(4)], "token STRING, email STRING")
    for i in range(4):  # each batch is three months older
        arrive(spark.createDataFrame([(f"t{i}", D - timedelta(days=90 * i)), ("t0", D - timedelta(days=90 * i))],
                                     schemas.UNSUBSCRIBES), src, 1)
        ST.stream_unsubscribes(RD.stream_files(spark, src, schemas.UNSUBSCRIBES), tokens, out, cp).awaitTermination()
    rows = {r["token"]: r["ts"] for r in ST.read_unsubscribes(spark, out).collect()}
    assert sorted(rows) == ["t0", "t1", "t2", "t3"] and rows["t0"] == D - timedelta(days=270)


def test_parts_are_complete_once_and_compacted(spark, tmp_path):
    path = str(tmp_path / "parts")
    opens = spark.createDataFrame([("a", D), ("b", D)], schemas.OPENS)
    for i in range(20):
        ST._save_part(TR.fold_opens(opens), path, i)
    ST._save_part(TR.fold_opens(opens), path, 3)  # a batch that runs again
    broken = tmp_path / "parts" / "batch=20.x"
    broken.mkdir()  # an attempt that did not finish
    (broken / "part-0.parquet").write_bytes(b"half")
    want = {"a": 20, "b": 20}
    count = lambda: {r["tracking_id"]: r["opened_count"] for r in ST.read_opens(spark, path).collect()}
    assert count() == want
    reader = ST.read_opens(spark, path)
    assert ST.compact(spark, path, ST.read_opens) == 20
    assert count() == want and len(ST._live_parts(spark, path)) == 1
    assert {r["tracking_id"]: r["opened_count"] for r in reader.collect()} == want
    ST._save_part(TR.fold_opens(opens), path, 3)
    ST._save_part(TR.fold_opens(opens), path, 21)
    assert count() == {"a": 21, "b": 21}
    ST.drop_compacted(spark, path)
    assert count() == {"a": 21, "b": 21} and len(ST._live_parts(spark, path)) == 2
