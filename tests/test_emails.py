import random
import re

from pyspark.sql import functions as F

from mailloom.functions import emails as E


def search(text, suffix=r"\.dz", context=100, trim=True):
    """The documented behaviour, by one regular expression."""
    out = []
    for m in re.finditer(r"[\w.\-+%]+@[\w.\-]+" + suffix + r"\b", text, re.IGNORECASE):
        snippet = text[max(0, m.start() - context):m.end() + context]
        out.append((m.group(0).lower(), (snippet.strip() if trim else snippet)[:200]))
    return out


def test_against_search(spark):
    rng = random.Random(7)
    parts = ["a", "B.c", "@", "@", ".dz", ".dz", "x", "-", " ", "é", "+", "%", ",", ".DZ", "\n",
             ".com", "word " * 9, "_", "@u.dz", "a@b.dz"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(3000)]
    texts += ["a@b.dz@c.dz", "a@b.dz@c.dz@d.dz e@f.dz", "a@b.dz.c@d.dz", "x" * 300 + "@u.dz",
              "abcd@x.dza", "a.bcd@x.dz.com", "😀 a@b.dz 😀" * 40, "@b.dz a@", "a@b.dz",
              "é" * 90 + "@u.dz" + "é" * 150, "@" * 300 + "a@b.dz" + "@" * 300]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    for context, trim in ((100, True), (50, False)):
        found = df.select("i", E.find_emails(F.col("t"), [".dz"], context, trim).alias("h"))
        for r in found.collect():
            want = search(texts[r["i"]], context=context, trim=trim)
            assert [(h["email"], h["snippet"]) for h in r["h"]] == want, texts[r["i"]]
            assert [h["pos"] for h in r["h"]] == list(range(len(want)))


def test_long_runs_stay_fast(spark):
    df = spark.createDataFrame([("ab" * 400_000 + " x@" + "cd" * 400_000 + " e.f@u.dz",)],
                               "t STRING")
    assert [h["email"] for h in df.select(E.find_emails(F.col("t"))).first()[0]] == ["e.f@u.dz"]


def test_roles(spark):
    cases = [("k", True, True), ("abc", True, False), ("a.b", False, False),
             ("abcd", False, False), ("chef.x", True, False), ("vr.x", True, False),
             ("sacomi", True, True), ("ali.ben", False, False), ("INFO", True, True)]
    df = spark.createDataFrame([(p + "@u.dz", s, o) for p, s, o in cases],
                               "e STRING, s BOOLEAN, o BOOLEAN")
    e = F.col("e")
    wrong = df.where((E.is_institutional(e) != F.col("s"))
                     | (E.is_institutional(e, strict=False) != F.col("o")))
    assert wrong.count() == 0
    assert spark.range(1).select(E.is_institutional(F.lit("info"))).first()[0] is False


def test_strict_keeps_less(spark):
    rng = random.Random(3)
    df = spark.createDataFrame(
        [("".join(rng.choices("abcvr.-xl", k=rng.randint(1, 7))) + "@u.dz",) for _ in range(500)],
        "e STRING")
    e = F.col("e")
    assert df.where(~E.is_institutional(e) & E.is_institutional(e, strict=False)).count() == 0
