import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mailloom.constants import REPLY_RULES
from mailloom.operators import replies as R

FIXED = {
    "I want to buy": "Potential Buyers", "the cost is too much": "Potential Buyers",
    "not interested": "Leads", "no thanks": "Not Interested", "more details please": "Leads",
    "send the specs": "More Information", "too expensive": "Price Objection",
    "not the right time": "Not Right Time", "not me": "Wrong Person",
    "I am unavailable": "Out of Office", "please unsubscribe": "Unsubscribe",
    "we purchased it": "Customer", "orders": "Unknown", "épass": "Not Interested",
    "don’t need": "Unknown", "don't need": "Not Interested", "": "Unknown",
    "interested in buying": "Potential Buyers", "can you call": "Demo Scheduled",
}


def classify(spark, texts, **kw):
    df = spark.createDataFrame([(i, "", t) for i, t in enumerate(texts)],
                               "i INT, subject STRING, body STRING")
    return [r["classification"] for r in R.classify_replies(df, **kw).orderBy("i").collect()]


def test_fixed(spark):
    assert classify(spark, list(FIXED)) == list(FIXED.values())


def test_one_pass_equals_rule_by_rule(spark):
    rng = random.Random(11)
    words = [w for _, ws in REPLY_RULES for w in ws] + ["é", "not", "more", "x", "in", "the", "_a"]
    glue = [" ", " ", ", ", "", "-", "_", "é", "\n"]
    texts = ["".join(rng.choice(words) + rng.choice(glue) for _ in range(rng.randint(1, 4)))
             for _ in range(3000)]

    def by_rule(text):
        text = " " + text.lower()
        for name, keywords in REPLY_RULES:
            if re.search(r"\b(" + "|".join(map(re.escape, keywords)) + r")\b", text, re.ASCII):
                return name
        return "Unknown"

    assert classify(spark, texts) == [by_rule(t) for t in texts]


def test_bounce_null_and_passthrough(spark):
    df = spark.createDataFrame([("buy", None, "Bounced", 7), (None, "demo", "Sent", 8)],
                               "subject STRING, body STRING, status STRING, extra INT")
    rows = R.classify_replies(df, status="status").orderBy("extra").collect()
    assert [r["classification"] for r in rows] == ["Bounce", "Demo Scheduled"]
    assert [r["extra"] for r in rows] == [7, 8]
    assert classify(spark, ["buy"], rules=()) == ["Unknown"]


def test_rule_table(spark):
    rules = spark.createDataFrame([(2, "A", "x"), (1, "B", "c++"), (1, "B", "y z")],
                                  "priority INT, classification STRING, keyword STRING")
    df = spark.createDataFrame([("x", "y z"), ("x", "")], "subject STRING, body STRING")
    assert sorted(r["classification"] for r in R.classify_with_table(df, rules).collect()) == [
        "A", "B"]


def test_matches(spark):
    df = spark.createDataFrame([("", "not interested, cost too much")],
                               "subject STRING, body STRING")
    got = [tuple(m) for m in R.matched_classes(df).first()["matches"]]
    assert got == [("Potential Buyers", "cost"), ("Leads", "interested"),
                   ("Price Objection", "cost"), ("Not Interested", "not interested")]


def test_selection_and_enrichment(spark):
    day = datetime(2024, 1, 1)
    inbox = spark.createDataFrame(
        [(1, " Ali@U.dz", "RE: Offer", "b", day), (2, "ali@u.dz", "other", "b", day),
         (3, "who@u.dz", "offer", "b", day), (4, "me@u.dz", "offer", "b", day)],
        "message_id INT, from_email STRING, subject STRING, body STRING, received_date TIMESTAMP")
    recipients = spark.createDataFrame(
        [("ali@u.dz", "Ali", "U"), ("ALI@u.dz", "Zed", "U"), ("me@u.dz", "Me", "U")],
        "email STRING, name STRING, university STRING")
    chosen = R.select_replies(inbox, recipients, ["offer"], "Me@u.dz")
    rows = R.enrich_replies(chosen, recipients).collect()
    assert [(r["message_id"], r["name"]) for r in rows] == [(1, "Ali")]


def test_suppression(spark):
    classified = spark.createDataFrame([("a@u.dz", "Unsubscribe"), ("b@u.dz", "Leads")],
                                       "email STRING, classification STRING")
    status = spark.createDataFrame([("A@u.dz", "Bounced"), ("c@u.dz", "Bounced"),
                                    ("d@u.dz", "Sent")], "email STRING, status STRING")
    listed = R.suppression_list(classified, status)
    assert sorted(map(tuple, listed.collect())) == [("a@u.dz", "unsubscribe"),
                                                    ("c@u.dz", "bounce")]
    people = spark.createDataFrame([("A@u.dz",), ("b@u.dz",), ("C@u.dz",)], "email STRING")
    assert [r[0] for r in R.suppress(people, listed).collect()] == ["b@u.dz"]
    with pytest.raises(ValueError):
        R.suppression_list()


def test_tokens(spark):
    day = datetime(2024, 1, 1)
    requests = spark.createDataFrame([("t1", day), ("t1", day), ("bad", day)],
                                     "token STRING, ts TIMESTAMP")
    tokens = spark.createDataFrame([("t1", "a@u.dz")], "token STRING, email STRING")
    assert R.validate_unsubscribes(requests, tokens).count() == 1
    assert [r["token"] for r in R.rejected_unsubscribes(requests, tokens).collect()] == ["bad"]


def test_rule_table_of_any_size(spark):
    rows = [(2, f"C{i % 7}", f"word{i} here") for i in range(5000)] + [
        (1, "Best", "Buy Now"), (3, "Late", "buy"), (1, "Empty", ""), (2, "Sign", "??"), (4, "Accent", "\u00e9pass")]
    rules = spark.createDataFrame(rows, "priority INT, classification STRING, keyword STRING")
    msgs = spark.createDataFrame([("buy NOW", ""), ("buy", None), ("", "word4999 here"), ("word499", "here"), (None, "a ?? b"),
                                  ("\u00e9pass", "x"), ("rebuy now", "")], "subject STRING, body STRING")
    got = R.classify_with_table(msgs, rules).collect()
    want = {"buy NOW": "Best", "buy": "Late", "": "C1", "word499": "C2", None: "Sign", "\u00e9pass": "Accent", "rebuy now": "Unknown"}
    assert {r["subject"]: r["classification"] for r in got} == want


def test_slugs_and_actions(spark):
    df = spark.createDataFrame([("Unsubscribe",), ("Bounce",), ("My Class",)],
                               "classification STRING")
    assert [r[0] for r in df.select(R.class_slug(F.col("classification"))).collect()] == [
        "unsubscribes", "bounces", "my_class"]
    acts = R.follow_up_actions(df).collect()
    assert [r["suppress"] for r in acts] == [True, True, False] and acts[2]["action"] is None


def test_rule_table_equals_patterns_tried_one_by_one(spark):
    r = random.Random(8)
    words = ["the", "not", "me", "e", "mail", "a_b", "5", "stop"]
    gaps = [" ", "  ", "-", ", ", "! ", "é", "."]
    make = lambda n: "".join(r.choice(words) + r.choice(gaps) for _ in range(n))
    keywords = {r.choice(["", "", "-", " ", "!"]) + make(r.randint(1, 3))[:-1] + r.choice(["", "", "?", " ", "!"]) for _ in range(150)}
    keywords |= {"?!", "!", " ", "é", "- ", ".", "not the", "the"}
    rows = [(r.randint(1, 40), f"C{r.randint(1, 9)}", k) for k in sorted(keywords)]
    texts = sorted({make(r.randint(0, 12)) + r.choice(["", "me", "?!", "the?"]) for _ in range(200)})
    msgs = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "body STRING, i INT").withColumn("subject", F.lit(""))
    rules = spark.createDataFrame(rows, "priority INT, classification STRING, keyword STRING")
    got = {x["i"]: x["classification"] for x in R.classify_with_table(msgs, rules).collect()}
    for i, t in enumerate(texts):
        hits = [(p, c) for p, c, k in rows
                if re.search(r"(?<![A-Za-z0-9_])" + re.escape(k.lower()) + r"(?![A-Za-z0-9_])", " " + t.lower())]
        assert got[i] == min(hits, default=(0, "Unknown"))[1], (t, hits)


def test_keywords_that_start_alike_are_filed_apart(spark):
    """A stop word that all keywords start with and all messages hold brings nothing together."""
    rules = spark.createDataFrame([(i, f"C{i}", f"the word{i}") for i in range(5000)] + [(9999, "All", "the")],
                                  "priority INT, classification STRING, keyword STRING")
    msgs = spark.range(300).select(F.lit("").alias("subject"), F.concat(
        F.lit("the " * 50 + "the word"), F.col("id") * 30, F.lit(" the the")).alias("body"), "id")
    places = msgs.select(F.col("id").alias("_text_id"), F.posexplode(R._words(F.col("body"))).alias("place", "token"))
    filed = {x["keyword"]: (x["token"], x["offset"]) for x in R.filed_keywords(rules, places).collect()}
    # Words no message holds are rarest of all.
    assert filed == {"the": ("the", 0)} | {f"the word{i}": (f"word{i}", 1) for i in range(5000)}
    out = R.classify_with_table(msgs, rules)
    assert {x["id"]: x["classification"] for x in out.collect()} == {
        i: f"C{30 * i}" if 30 * i < 5000 else "All" for i in range(300)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    generated = [line for line in plan.splitlines() if "Generate" in line]
    assert generated and not [line for line in generated if "_text#" in line.split("], ")[-1]]
