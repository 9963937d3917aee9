from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mailloom.operators import contacts as C
from mailloom.operators import tracking as TR
from mailloom.sources import readers as RD
from mailloom.sources import sinks

T = datetime(2024, 1, 2, 3, 4, 5, 678901)


def test_seeds(spark, tmp_path):
    p = tmp_path / "seeds.txt"
    p.write_text("# c\n\n  https://a.dz \n#x\nhttps://b.dz\n", encoding="utf-8")
    assert [r[0] for r in RD.read_seeds(spark, str(p)).collect()] == ["https://a.dz",
                                                                      "https://b.dz"]
    assert RD.read_seeds(spark, str(tmp_path / "none")).count() == 0


def test_contacts_round_trip(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [("a.bc@u.dz", "a.bc", "u.dz", "https://u.dz", "html", '=T "q", x', " two\nlines ", T,
             "regex_html", "")]
    df = spark.createDataFrame(
        rows, "email STRING, local_part STRING, domain STRING, source_url STRING, "
        "source_type STRING, page_title STRING, context_snippet STRING, found_at TIMESTAMP, "
        "parse_method STRING, notes STRING")
    sinks.write_contacts(df, path)
    sinks.write_contacts(df, path)
    back = RD.read_contacts(spark, path).collect()
    assert len(back) == 2
    r = back[0]
    assert (r["page_title"], r["context_snippet"], r["found_at"], r["http_status"]) == (
        "'=T \"q\", x", " two\nlines ", T, "200")
    assert list(back[0].asDict()) == list(C.OCCURRENCE_COLUMNS)
    assert RD.read_contacts(spark, str(tmp_path / "none")).count() == 0


def test_iso_times_without_fraction(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text("email,domain,first_seen,sources,verified,status,notes\n"
                 "a.bc@u.dz,u.dz,2024-01-02T03:04:05,u1;u2,false,unknown,\n", encoding="utf-8")
    assert RD.read_clean_contacts(spark, str(p)).first()["first_seen"] == T.replace(microsecond=0)


def test_wrong_header_fails(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text("x,y\n1,2\n", encoding="utf-8")
    with pytest.raises(Exception):
        RD.read_contacts(spark, str(p)).collect()


def test_clean_and_reclean(spark, tmp_path):
    clean = spark.createDataFrame(
        [("a.bc@u.dz", "u.dz", T, ["u1", "u2"], "false", "unknown", ""),
         ("info@u.dz", "u.dz", T, ["u1"], "false", "unknown", "")],
        "email STRING, domain STRING, first_seen TIMESTAMP, sources ARRAY<STRING>, "
        "verified STRING, status STRING, notes STRING")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    sinks.write_clean_contacts(clean, a)
    sinks.write_clean_contacts(clean, a)
    assert sinks.reclean_file(spark, a, b) == {"removed": 1, "remaining": 1}
    row = RD.read_clean_contacts(spark, b).collect()
    assert [(r["email"], r["sources"]) for r in row] == [("a.bc@u.dz", "u1;u2")]


def test_recipients(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("email,name,room\na@u.dz,Ali,7\n,No,8\n", encoding="utf-8")
    rows = RD.read_recipients(spark, str(p)).collect()
    assert [(r["email"], r["name"], r["room"], r["university"]) for r in rows] == [
        ("a@u.dz", "Ali", "7", None)]
    q = tmp_path / "q.csv"
    q.write_text("name\nx\n", encoding="utf-8")
    with pytest.raises(ValueError):
        RD.read_recipients(spark, str(q))


def test_page_files(spark, tmp_path):
    (tmp_path / "a.html").write_bytes("é".encode())
    (tmp_path / "b.html").write_bytes("é".encode("latin-1"))
    assert [r["html"] for r in RD.read_page_files(spark, str(tmp_path)).collect()] == ["é", "é"]


def test_routing_keeps_all_rows(spark, tmp_path):
    df = spark.range(300).select(
        F.concat("id", F.lit("@u.dz")).alias("email"), F.lit("n").alias("name"),
        F.lit("u").alias("university"), F.lit("s").alias("subject"), F.lit("b").alias("body"),
        F.lit(T).alias("received_date"),
        F.when(F.col("id") % 3 == 0, "Leads").when(F.col("id") % 3 == 1, "Unknown")
        .otherwise("Unsubscribe").alias("classification"))
    path = str(tmp_path / "routed")
    sinks.route_by_class(df, path)
    back = RD.read_routed(spark, path)
    assert back.count() == 300 and back.select("email").distinct().count() == 300
    assert sorted(r[0] for r in back.select("class_slug").distinct().collect()) == [
        "leads", "unknown", "unsubscribes"]


def test_master_versions(spark, tmp_path):
    log = spark.createDataFrame([("a@u.dz", T, "Sent", "t")], "email STRING, sent_date TIMESTAMP, "
                                "status STRING, tracking_id STRING")
    opens = spark.createDataFrame([("t", T)], "tracking_id STRING, ts TIMESTAMP")
    replies = spark.createDataFrame([], "message_id INT, email STRING, received_date TIMESTAMP, "
                                    "classification STRING")
    path = str(tmp_path / "master")
    sinks.write_master(TR.build_master(log, opens.limit(0), replies), path, 1)
    sinks.write_master(TR.build_master(log, opens, replies), path, 2)
    assert RD.master_versions(spark, path) == [1, 2]
    assert RD.read_master(spark, path).first()["opened"] is True
    assert RD.read_master(spark, path, 1).first()["opened"] is False
    with pytest.raises(FileNotFoundError):
        RD.read_master(spark, str(tmp_path / "none"))


def test_metrics_file_is_one_file(spark, tmp_path):
    sinks.write_metrics(spark.range(5).repartition(4), str(tmp_path / "m"))
    assert len(list((tmp_path / "m").glob("part-*.csv"))) == 1


def test_any_value_comes_back_from_its_escapes(spark):
    values = ["\u0001\\", "\\n", "\\\n", "a\r\n\\\\n\u0001", "\\", "\n\\\\\n", "", "\\r\r", None, "x"]
    df = spark.createDataFrame([(v,) for v in values], "v STRING")
    got = df.select("v", RD.restore_breaks(RD.escape_breaks(F.col("v"))).alias("w")).collect()
    assert [r["w"] for r in got] == [r["v"] for r in got] and len(got) == len(values)
