"""Quality rules and license scan against plain Python."""

import random
import re
from collections import Counter

import duckdb
from llm_helpers import SF, by_key

from mailloom.llm import licenses, quality
from mailloom.llm import queries as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered), failed)


def test_quality_on_edge_rows(edge, empty):
    df, rows = edge
    out = quality.judge_documents(df, cleaned=True).collect()
    want = Counter((i, *base_measures(t)) for i, t in rows)
    assert Counter((r["doc_id"], *r[1:7]) for r in out) == want
    assert all(not r["kept"] or not r["base_failed"] for r in out)
    assert quality.judge_documents(empty).count() == 0


def test_line_rules():
    ok = quality.line_ok
    assert ok("A sentence of prose that ends as it should.") and ok("") and ok("   ")
    assert ok("a line of a poem without any mark but with many words in it all the same")
    assert not ok("Home | About | Contact | Shop | Help")
    assert not ok("All rights reserved.") and not ok("Read more") and not ok("Table of contents")
    assert not ok("#### $$$$ %%%% ^^^^ a.")
    good, bad = "This is a proper sentence of prose with words. " * 8, "home | shop | cart | help | login | about\n" * 30
    words = " ".join(f"w{i}" for i in range(80)) + "."
    assert quality.judge(words)[6] and quality.judge(words + "\nAll rights reserved.")[8] == words
    assert not quality.judge(words + "\n" + bad)[6] and not quality.judge(good)[6]


MENU_WORDS = ["home", "menu", "login", "log in", "sign in", "sign up", "register", "search", "next", "previous", "back", "top",
              "share", "print", "skip to content", "skip to main content", "read more", "click here", "contact us", "about us",
              "sitemap", "site map", "faq"]
PHRASES_OUT = ["lorem ipsum", "all rights reserved", "copyright ©", "copyright (c)", "enable javascript", "javascript is disabled",
               "javascript is required", "cookie policy", "cookie settings", "cookie consent", "privacy policy", "terms of use",
               "terms of service", "subscribe to our newsletter", "subscribe to the newsletter", "follow us on", "powered by",
               *[f"{u} {o}cookies" for u in ("use", "uses", "using") for o in ("", "of ")]]


def plain_line_ok(line):
    """The line rules character by character, without patterns."""
    words, bare, low = line.split(), line.strip(), line.lower()
    if not words:
        return True
    if len(words) <= 8 and bare[-1] not in ".!?\"':;)…”»。！？" and not any(c in ".!?…。！？" for c in bare):
        return False
    tail = low.strip()
    while tail and (tail[-1] in ".>»|" or tail[-1].isspace()):
        tail = tail[:-1]
        if tail.strip() in MENU_WORDS:
            return False
    if low.strip() in MENU_WORDS:
        return False
    cells, cell = [], ""
    for c in line:
        if c in "|»>›•":
            cells.append(cell)
            cell = ""
        else:
            cell += c
    cells.append(cell)
    short = [len(c) for c in cells if 1 <= len(c) <= 30]
    if len(cells) > 3 and len(short) >= 3 and sum(short) * 2 >= len(line) - len(cells) + 1:
        return False
    year = any(low[i:].startswith("copyright ") and low[i + 10:i + 14].isdigit() and len(low[i + 10:i + 14]) == 4 for i in range(len(low)))
    if len(words) <= 40 and (year or any(p in low for p in PHRASES_OUT)):
        return False
    return sum(c.isalnum() for c in bare) >= 0.35 * sum(c != " " for c in bare)


def test_line_rules_equal_the_plain_form():
    r = random.Random(9)
    docs = [t or "" for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()]
    lines = {x for t in docs for x in t.split("\n")}
    pieces = [*MENU_WORDS, *PHRASES_OUT, "|", " > ", "•", "word", "a longer cell of more than thirty letters", ".", "»", "copyright 2020", "#", "  ", "x", "!"]
    lines |= {"".join(r.choice(pieces) + r.choice(["", " "]) for _ in range(r.randint(1, 9))) for _ in range(4000)}
    assert [x for x in lines if quality.line_ok(x) != plain_line_ok(x)] == []
    long = "A sentence of many words that only has a | here, a > there and a • at its end, with no cell short enough for any menu at all."
    assert quality.line_ok(long) and not quality.line_ok("Shop | " * 4 + "Home")


def test_quality_query(spark):
    out = by_key(Q.llm_queries()["op1_line_quality"](spark, SF))
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert {k: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
            for k, r in out.items()} == {i: base_measures(t) for i, t in docs}
    for i, t in docs:
        lines = (t or "").split("\n")
        size = lambda rows: sum(len(x) - x.count(" ") for x in rows)
        lost = size(x for x in lines if not plain_line_ok(x))
        assert out[i]["kept"] == (not out[i]["base_failed"] and lost <= 0.5 * size(lines))


TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def base_places(text):
    words = TOKEN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    hits = [(i, v) for p, v in PHRASES.items() for i in range(len(words)) if tuple(words[i:i + len(p)]) == p]
    places = [i for i, _ in hits]
    return (len(words), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({v for _, v in hits})))


def plain_labels(text):
    """All rule matches by the standard library, containment by comparing every pair."""
    low = (text or "").lower()
    if licenses.GATE not in low:
        return set()
    hits = [(m.start(), m.end(), r.level, i, r.label) for i, r in enumerate(licenses.default_rules()) if r.keyword in low
            for m in re.finditer(r.pattern, low, re.ASCII)]

    def contained(h):
        return any(g is not h and g[0] <= h[0] and g[1] >= h[1] and g[2] <= h[2]
                   and ((g[0], g[1]) != (h[0], h[1]) or g[2:4] < h[2:4]) for g in hits)
    return {h[4] for h in hits if not contained(h)}


LICENSED = [
    "Licensed under the Apache License, Version 2.0 (the License).", "SPDX-License-Identifier: GPL-2.0-only",
    "released under the MIT license and the BSD 3-Clause License", "license: cc-by-sa", "unlicensed work of mit",
    "GNU Lesser General Public License v2.1, General Public License", "MIT License mit license MIT\nlicense",
    "the mit-license; permit license", "License = 'Mozilla Public License 2.0'", "LICENSE", None, "",
]


def test_licenses_on_edge_rows(spark, edge, empty):
    df, rows = edge
    more = spark.createDataFrame(list(enumerate(LICENSED, 100)), "doc_id BIGINT, text STRING")
    out = licenses.license_scan(df.select("doc_id", "text").unionByName(more))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") == plan.count("REPARTITION_BY_NUM")
    got = Counter((r["doc_id"], *r[1:6], r["labels"]) for r in out.collect())
    want = Counter()
    for i, t in [*rows, *enumerate(LICENSED, 100)]:
        measured = base_places(t)
        labels = plain_labels(t) | set(filter(None, measured[4].split(",")))
        want[(i, *measured, ",".join(sorted(labels)))] += 1
    assert got == want
    assert licenses.license_scan(empty).count() == 0


def test_there_are_hundreds_of_rules():
    assert len(licenses.default_rules()) > 200


def test_license_query(spark):
    out = by_key(Q.llm_queries()["op10_license_scan"](spark, SF))
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert {k: tuple(r)[1:6] for k, r in out.items()} == {i: base_places(t) for i, t in docs}
    assert all(0 <= r["score"] <= 1 and (r["labels"] == "") == (r["score"] == 0) for r in out.values())
    assert any(r["labels"] not in ("", r["base_labels"]) for r in out.values())


def labels_of_all_rules(text):
    """As plain_labels, but without gate words and keywords."""
    low = (text or "").lower()
    hits = [(m.start(), m.end(), r.level, i, r.label) for i, r in enumerate(licenses.default_rules())
            for m in re.finditer(r.pattern, low, re.ASCII)]

    def contained(h):
        return any(g is not h and g[0] <= h[0] and g[1] >= h[1] and g[2] <= h[2]
                   and ((g[0], g[1]) != (h[0], h[1]) or g[2:4] < h[2:4]) for g in hits)
    return {h[4] for h in hits if not contained(h)}


WORDINGS = [
    ("distributed under the GPL v3", "gpl-3.0"), ("It was released under the MIT.", "mit"),
    ("This work is licensed under the Creative Commons Attribution-ShareAlike license.", "cc-by-sa"),
    ("licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives license", "cc-by-nc-nd"),
    ("licensed under the Creative Commons Attribution-NoDerivs license", "cc-by-nd"),
    ("under a Creative Commons Attribution license", "cc-by"), ("Creative Commons Zero License", "cc0"),
    ("released under the Un license", "unlicense"), ("available under commercial", "proprietary"),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided", "bsd"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and", "mit"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
]


def test_license_prefilters_drop_nothing(spark):
    rows = [(i, t) for i, (t, _) in enumerate(WORDINGS)] + list(enumerate(LICENSED, 100))
    out = by_key(licenses.license_scan(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")))
    for i, text in rows:
        want = labels_of_all_rules(text) | set(filter(None, base_places(text)[4].split(",")))
        assert out[i]["labels"] == ",".join(sorted(want)), text
    assert all(label in out[i]["labels"].split(",") for i, (_, label) in enumerate(WORDINGS))


def test_every_name_holds_its_keyword():
    names = {n: k for _, _, n, k in licenses.FAMILIES}
    for name, keyword in names.items():
        alternatives = name[3:-1].split("|") if name.startswith("(?:") and name.endswith(")") else [name]
        assert all(keyword in re.sub(r"\([^()]*\)\?", "", a) for a in alternatives), name
    for _, _, words, keyword in licenses.NOTICES:
        assert keyword in words


def test_every_notice_is_found_in_its_own_words(spark):
    """Whatever white space stands between the words, and through the gate words and keywords."""
    rows = [(i, "Text before.\n" + w.replace("* ", "the one two ").replace(" ", " \n ").upper() + " and after")
            for i, (_, _, w, _) in enumerate(licenses.NOTICES)]
    assert len(rows) >= 150 and len({w for _, _, w, _ in licenses.NOTICES}) == len(rows)
    out = by_key(licenses.license_scan(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")))
    for i, (label, _, words, _) in enumerate(licenses.NOTICES):
        found = set(out[i]["labels"].split(","))
        # A longer wording that holds this one may stand for it.
        assert label in found or found - {""}, words
        assert found == labels_of_all_rules(rows[i][1]) | set(filter(None, base_places(rows[i][1])[4].split(","))), words


def test_licenses_keep_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "mit license", "a", "b", "c")], "doc_id INT, text STRING, _low STRING, _norm STRING, _found STRING")
    out = licenses.license_scan(df, keep=("doc_id", "_low", "_norm", "_found", "text")).first()
    assert (out["_low"], out["_norm"], out["_found"], out["text"], out["base_labels"]) == ("a", "b", "c", "mit license", "mit")
