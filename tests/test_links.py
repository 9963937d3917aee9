from pyspark.sql import functions as F

from mailloom.operators import links as L
from mailloom.operators import sites as S


def page(spark, html, url="https://staff.u.dz/websites"):
    return spark.createDataFrame([(1, url, html)], "page_id BIGINT, url STRING, html STRING")


def classes(spark, html, url="https://staff.u.dz/websites", rules=L.LinkRules()):
    links = L.classify_links(L.extract_links(page(spark, html, url), [".dz"]), rules)
    return {r["href"]: r["link_class"] for r in links.collect()}


def anchor(href, text="x"):
    return f'<a href="{href}">{text}</a>'


def test_classes(spark):
    html = "".join(map(anchor, ["/contact", "?page=2", "/ali-ben", "/faculte", "https://lab.u.dz/",
                                "/login", "mailto:a@u.dz", "https://other.dz/", "/xyz", "?lp=3"]))
    html += anchor("/n1", "12") + anchor("/n2", "Suivant") + anchor("/n3", "Contact us")
    assert classes(spark, html) == {
        "/contact": "contact", "?page=2": "pagination", "/ali-ben": "teacher",
        "/faculte": "faculty", "https://lab.u.dz/": "subdomain", "/xyz": "priority",
        "?lp=3": "pagination", "/n1": "pagination", "/n2": "pagination", "/n3": "contact"}
    assert classes(spark, anchor("/xyz"), "https://u.dz/") == {"/xyz": "regular"}
    assert classes(spark, anchor("/xyz", "contact"), "https://u.dz/", L.FRONTIER_RULES) == {
        "/xyz": "regular"}


def test_walk_class_sees_the_url_and_the_seed(spark):
    df = spark.createDataFrame([("https://u.dz/contact", "contact"), ("https://u.dz/websites?page=2", "pagination"),
                                ("https://u.dz/ali-ben", "teacher"), ("https://lab.u.dz/x", "subdomain"),
                                ("https://u.dz/staff", "priority"), ("https://u.dz/x", "regular"),
                                ("https://lab.u.dz/contact", "contact")], "url STRING, expected STRING")
    got = df.withColumn("c", L.walk_class(F.col("url"), F.lit("https://u.dz/"))).collect()
    assert [r["c"] for r in got] == [r["expected"] for r in got]


def test_first_link_wins_and_order(spark):
    html = (anchor("/a?p=2") + anchor("/reg") + anchor("/reg/", "again") + anchor("/a?p=3")
            + anchor("/staff") + "text https://lab.u.dz/x and https://u.dz/reg2, end")
    links = L.ranked_links(page(spark, html, "https://u.dz/"), [".dz"])
    assert "Exchange" not in links._jdf.queryExecution().executedPlan().toString()
    rows = links.orderBy("link_rank").collect()
    assert [r["url"] for r in rows] == [
        "https://u.dz/a?p=3", "https://u.dz/a?p=2", "https://u.dz/staff", "https://lab.u.dz/x",
        "https://u.dz/reg", "https://u.dz/reg2,"]
    assert [r["source"] for r in rows] == ["anchor"] * 3 + ["text", "anchor", "text"]


def test_text_url_that_is_an_anchor_is_not_repeated(spark):
    html = anchor("https://u.dz/a") + " https://u.dz/a/ "
    assert L.extract_links(page(spark, html, "https://u.dz/"), [".dz"]).count() == 1


def test_extraction_has_no_shuffle(spark):
    plan = L.extract_links(page(spark, anchor("/a")))._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()


def test_start_set(spark):
    pages = spark.createDataFrame(
        [(1, "https://u.dz/", anchor("https://lab.u.dz/a/") + anchor("https://u.dz/b")),
         (2, "https://s.v.dz/", anchor("https://t.s.v.dz/"))],
        "page_id BIGINT, url STRING, html STRING")
    seeds = spark.createDataFrame([("https://u.dz",), ("https://s.v.dz",)], "seed STRING")
    got = {(r["seed"], r["url"]) for r in S.start_set(seeds, pages, [".dz"], ["math"]).collect()}
    assert got == {("https://u.dz/", "https://u.dz/"), ("https://u.dz/", "https://math.u.dz/"),
                   ("https://u.dz/", "https://lab.u.dz/a"), ("https://s.v.dz/", "https://s.v.dz/")}


def test_start_set_grows_after_its_aggregates(spark):
    """Each (seed, url) comes once, and no aggregate stands above the rows that the prefixes multiply."""
    pages = spark.createDataFrame(
        [(1, "https://u.dz/", anchor("https://math.u.dz/") + anchor("https://lab.u.dz/")),
         (2, "https://u.dz", anchor("https://lab.u.dz")), (3, None, anchor("https://t.dz/")),
         (4, "https://www.w.dz/", anchor("https://math.w.dz/x"))], "page_id BIGINT, url STRING, html STRING")
    seeds = spark.createDataFrame([("https://u.dz",), ("https://u.dz/",), ("https://www.w.dz",), ("no host",), (None,)],
                                  "seed STRING")
    out = S.start_set(seeds, pages, [".dz"], ["math", "www", "math"])
    assert sorted(((r["seed"], r["url"]) for r in out.collect()), key=str) == sorted([
        ("https://u.dz/", "https://u.dz/"), ("https://u.dz/", "https://math.u.dz/"), ("https://u.dz/", "https://www.u.dz/"),
        ("https://u.dz/", "https://lab.u.dz/"), ("https://www.w.dz/", "https://www.w.dz/"),
        ("https://www.w.dz/", "https://math.w.dz/"), ("https://www.w.dz/", "https://math.w.dz/x"),
        ("no host", "no host"), (None, None)], key=str)
    for df in (out, S.candidate_subdomains(seeds, ["math"], [".dz"])):
        above = df._jdf.queryExecution().optimizedPlan().toString().split("Generate explode")
        assert len(above) == 2 and "Aggregate" not in above[0] and "Aggregate" in above[1]


def test_crawl_delay(spark):
    urls = spark.createDataFrame([("https://a.u.dz/x",), ("https://v.dz",), ("https://w.dz",)],
                                 "url STRING")
    rules = spark.createDataFrame([("u.dz", 5.0), ("v.dz", 0.0)],
                                  "base_domain STRING, crawl_delay DOUBLE")
    got = {r["base_domain"]: r["crawl_delay"] for r in S.with_crawl_delay(urls, rules).collect()}
    assert got == {"u.dz": 5.0, "v.dz": 2.0, "w.dz": 2.0}


def test_teacher_page(spark):
    df = spark.createDataFrame([("https://u.dz/ali-ben",), ("https://u.dz/websites/a-b",),
                                ("https://u.dz/ali",)], "u STRING")
    assert [r[0] for r in df.select(L.is_teacher_page(F.col("u"))).collect()] == [
        True, False, False]
