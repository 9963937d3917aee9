"""Helpers of the tests in this folder."""

import random

SF = "/root/testdata/sf0.001"


def by_key(df, key="doc_id"):
    rows = df.collect()
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows)
    return out


def prose(seed, n, words=400):
    """Invented prose: ``n`` words of a small vocabulary, in lines."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghiklmnoprstuvwéß") for _ in range(r.randint(2, 9))) for _ in range(words)]
    out = []
    for i in range(n):
        out.append(r.choice(vocabulary) + ("." if i % 9 == 8 else "") + ("\n" if i % 40 == 39 else " "))
    return "".join(out).strip()
