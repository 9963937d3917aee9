import pytest
from llm_helpers import prose

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, kept BOOLEAN, score STRING, _text STRING, class_id STRING"


def edge_rows():
    """Null, empty, blank, long, equal and repeated texts, null ids, and other columns with clashing names."""
    long = prose(1, 20_000, 3000)
    base = prose(2, 120)
    passage = prose(3, 60)
    texts = [
        (1, base), (2, None), (3, ""), (4, " \t\n\x0b "), (5, base), (6, long), (7, prose(4, 80) + " " + passage),
        (8, passage + "\n" + prose(5, 80)), (9, "one two"), (10, "one two"), (11, "日本語 テキスト です " * 30),
        (12, "In " * 300), (13, base + " tail"), (14, prose(6, 300)), (None, prose(7, 90)), (None, None),
        (15, prose(8, 60)), (15, prose(8, 60)), (-3, passage), (16, "MIT License\n\nmit license, Apache License"),
        (17, prose(9, 50) + passage[:99]), (18, "\u0000 x\r\ny z"), (19, "😀 " * 70),
    ]
    return [(i, t, ["en", None, "de"][k % 3], "s", len(t or ""), True, "x", "y", "z") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge(spark):
    rows = edge_rows()
    return spark.createDataFrame(rows, SCHEMA).repartition(3), [(r[0], r[1]) for r in rows]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
