import pytest
from pyspark.sql import functions as F

from mailloom.functions import charsets as CH
from mailloom.sources import readers as RD


def decoded(spark, rows):
    df = spark.createDataFrame([(i, bytearray(b) if b is not None else None, h) for i, (b, h) in enumerate(rows)],
                               "i INT, c BINARY, h STRING")
    out = df.select("i", CH.decode_page(F.col("c"), F.col("h")).alias("t")).collect()
    return [r["t"] for r in sorted(out)]


def test_code_pages_equal_the_standard_codecs(spark):
    every = bytes(range(256))
    names = sorted(CH.CODE_PAGES)
    assert {"cp1252", "cp1256", "iso8859_6", "koi8_r", "cp866"} <= set(names)
    got = decoded(spark, [(every, f"text/html; charset={n}") for n in names])
    assert got == [every.decode(n, "replace") for n in names]


@pytest.mark.parametrize("label,codec", [
    ("windows-1256", "cp1256"), ("WINDOWS-1252", "cp1252"), ("'cp1251'", "cp1251"), ("ISO-8859-6", "iso8859_6"), ("latin1", "latin_1"),
    ("iso8859-15", "iso8859_15"), ("KOI8-R", "koi8_r"), ("us-ascii", "ascii"), ("arabic", "iso8859_6"), ("utf8", "utf_8"), ("x-unknown", None),
])
def test_labels(spark, label, codec):
    text = "café مرحبا".encode(codec or "utf_8", "replace")
    want = text.decode(codec or "utf_8", "replace")
    assert decoded(spark, [(text, f'text/html; Charset = "{label}"'), (text, label),
                           (b"<meta charset=" + label.encode() + b">" + text, None)])[:2] == [want] * 2


def test_what_declares_a_charset(spark):
    arabic = "مرحبا"
    page = arabic.encode("cp1256")
    meta = b'<html><META http-equiv=x content="text/html; charset=windows-1256">'
    rows = [
        (meta + page, None, meta.decode() + arabic),                                 # a tag
        (b"<meta charset='windows-1256' />" + page, "text/html", "<meta charset='windows-1256' />" + arabic),
        (meta + page, "text/html; charset=utf-8", None),                             # the header beats the tag
        (b"\xef\xbb\xbf" + arabic.encode(), "text/html; charset=windows-1256", arabic),  # the mark beats both
        (b"\xff\xfe" + arabic.encode("utf-16-le"), None, arabic),
        (b"\xfe\xff" + (arabic + "\U0001f600").encode("utf-16-be"), "latin1", arabic + "\U0001f600"),
        (b"\xff\xfe" + arabic.encode("utf-16-le") + b"x", None, arabic),              # half a character at the end
        (b"\xff\xfea\x00\x00\xd8", None, "\xff\xfea\x00\x00\xd8"),                    # a surrogate alone: not UTF-16
        (b"<meta charset=utf-16>" + arabic.encode(), None, "<meta charset=utf-16>" + arabic),
        (b"x" * 1100 + meta + page, None, ("x" * 1100) + meta.decode() + page.decode("latin-1")),  # too late
        (arabic.encode(), None, arabic), (page, None, page.decode("latin-1")), (b"", "latin1", ""), (None, "latin1", None),
        (b"a\xff\xe2\x82b", "utf-8", b"a\xff\xe2\x82b".decode("utf-8", "replace")),
        (b"caf\xe9", "text/html; charset=us-ascii", "caf�"), (b"caf\xe9", "shift_jis", "caf\xe9"),
    ]
    got = decoded(spark, [r[:2] for r in rows])
    want = [(meta + page).decode("utf-8", "replace") if r[2] is None and r[0] is not None and r[1] and "utf-8" in r[1] else r[2] for r in rows]
    assert got == want


def test_page_files_are_read_in_their_charset(spark, tmp_path):
    (tmp_path / "a.html").write_bytes(b"<meta charset=windows-1251>" + "при".encode("cp1251"))
    (tmp_path / "b.html").write_bytes("é".encode("latin-1"))
    got = {r["url"][-6:]: r["html"] for r in RD.read_page_files(spark, str(tmp_path)).collect()}
    assert got == {"a.html": "<meta charset=windows-1251>при", "b.html": "é"}
