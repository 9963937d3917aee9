import random
from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from mailloom.functions import urls as U


def column(spark, values, expr, schema="a STRING"):
    rows = [(i, *v) if isinstance(v, tuple) else (i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i INT, " + schema)
    return [r["x"] for r in df.select("i", expr.alias("x")).orderBy("i").collect()]


def test_normalize_fixed(spark):
    cases = {
        "https://a.dz//x///?q=1#f": "https://a.dz//x?q=1#f",
        "https://A.dz": "https://A.dz/",
        "HTTP://a.dz/b/": "http://a.dz/b",
        "staff.a.dz/b/": "staff.a.dz/b/",
        "https://a.dz/p;v=1": "https://a.dz/p",
        "https://[a.dz/x/": "https://[a.dz/x/",
        "//a.dz/x/": "https://a.dz/x",
    }
    got = column(spark, list(cases), U.normalize_url(F.col("a")))
    assert got == list(cases.values())
    assert column(spark, got, U.normalize_url(F.col("a"))) == got


def test_base_domain(spark):
    cases = [("staff.univ.dz", "univ.dz"), ("www.x.com", "www.x.com"), ("x.y.dz:8080",
             "x.y.dz:8080"), ("dz", "dz"), ("", ""), ("univ.dz", "univ.dz")]
    got = column(spark, [c for c, _ in cases], U.base_domain(F.col("a"), [".dz"]))
    assert got == [e for _, e in cases]


def test_same_base_domain(spark):
    cases = [("https://a.u.dz/x", "http://b.u.dz", True), ("https://u.dz", "ftp://u.dz", False),
             ("https://u.dz", "//u.dz", True), ("u.dz", "u.dz", False),
             ("https://u.dz", "https://v.dz", False)]
    got = column(spark, [(a, b) for a, b, _ in cases],
                 U.same_base_domain(F.col("a"), F.col("b"), [".dz"]), "a STRING, b STRING")
    assert got == [e for *_, e in cases]


def test_https_www_and_subdomain(spark):
    assert column(spark, ["http://a.dz?q=1", "//a.dz/x", "ftp://a.dz", "a.dz", "https://a.dz"],
                  U.ensure_https(F.col("a"))) == [
        "https://a.dz/?q=1", "https://a.dz/x", "ftp://a.dz", "a.dz", "https://a.dz"]
    assert column(spark, ["https://www.a.dz/x?q", "http://a.dz", "x"],
                  U.www_variants(F.col("a"))) == [
        ["https://www.a.dz/x?q", "https://a.dz/x?q"], ["http://a.dz", "http://www.a.dz/"], ["x"]]
    assert column(spark, ["www.u.dz", "s.u.dz", "u.dz", "a.b.com"],
                  U.is_subdomain(F.col("a"), [".dz"])) == [False, True, False, False]


@pytest.mark.parametrize("seed", [1, 2])
def test_resolve_and_parts_against_urllib(spark, seed):
    rng = random.Random(seed)
    pieces = ["/", "..", ".", "a", "b-c", "?", "#", "=", "&", ";", "//", "x.y", "%20", ":", "é"]
    bases = ["https://a.dz", "http://a.dz/x/y?q=1#f", "https://s.a.dz/x//y/z;p=1",
             "http://a.dz/../x/"]
    cases = [(rng.choice(bases), "".join(rng.choices(pieces, k=rng.randint(0, 7))))
             for _ in range(400)]
    got = column(spark, cases, U.resolve_url(F.col("a"), F.col("b")), "a STRING, b STRING")
    assert got == [urljoin(a, b) for a, b in cases]
    urls = [u for u in got] + [b for _, b in cases]
    p = U.url_parts(F.col("a"))
    parts = column(spark, urls, F.struct(p["scheme"], p["netloc"], p["path"], p["params"],
                                         p["query"], p["fragment"]))
    assert [tuple(x) for x in parts] == [tuple(urlparse(u)) for u in urls]


def test_skip_and_segments(spark):
    assert column(spark, ["/LOGIN", "/x/user?id=1", "/users", "?a=1&login=2", "/b/admin_panel"],
                  U.is_skipped(F.col("a"))) == [True, True, False, True, True]
    assert column(spark, ["https://a.dz//x//y/", "https://a.dz"],
                  U.path_segments(F.col("a"))) == [["x", "y"], []]
