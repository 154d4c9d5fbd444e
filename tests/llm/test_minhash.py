"""Near copies against brute force over all pairs of a small corpus."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.llm import minhash as mh

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, n bigint, key string"


def brute(rows, least=0.8):
    """{row number: class members} by reading every pair; rows without words link to equal texts only."""
    counts = [mh.word_counts(t or "") for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][1] is not None and rows[i][1] == rows[j][1]
            if same or mh.weighted_jaccard(counts[i], counts[j]) >= least:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def compare(spark, rows, least=0.8):
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], SCHEMA)
    got = {}
    for r in mh.near_duplicates(df, least=least).collect():
        got.setdefault((r["doc_id"], r["digest"]), []).append(r)
    roots = brute(rows, least)
    members = {}
    for (i, _), root in zip(rows, roots):
        members.setdefault(root, []).append(i)
    import hashlib
    for (i, t), root in zip(rows, roots):
        d = "-" if t is None else hashlib.md5(t.encode()).hexdigest()
        r = got[i, d][0]
        assert r["class_size"] == len(members[root]), (i, t, r)
        own = members[root]
        assert r["class_id"] == (None if None in own else min(own))
    return df


def test_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = compare(spark, rows)
    assert mh.keep_one(df).count() == len(set(brute(rows)))


def test_chains_thresholds_and_odd_texts(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(120)]
    rows, text = [], list(base)
    for i in range(40):  # a chain: each near the one before, the ends far apart
        text = list(text)
        text[rng.randrange(120)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(100, "one two"), (101, "One  two"), (102, "one two three four five"), (103, ""), (104, ""), (105, None), (106, None),
             (107, " \n "), (108, rows[3][1]), (None, "key less " * 9), (110, "a b c d e " * 50), (111, "a b c d e " * 49)]
    compare(spark, rows)


@pytest.mark.parametrize("crowd", [8, 1000])
def test_crowded_loose_bucket_keeps_its_links(spark, monkeypatch, crowd):
    """Half of every text is one passage, so bands collide for all; only the planted pairs are near."""
    monkeypatch.setattr(mh, "CROWD", crowd)
    monkeypatch.setattr(mh, "BLOCK", 9)
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = []
    for i in range(60):
        own = [f"u{i}x{j}" for j in range(26)]
        rows.append((2 * i, passage + " " + " ".join(own)))
        own[rng.randrange(26)] = "changed"
        rows.append((2 * i + 1, passage + " " + " ".join(own)))
    compare(spark, rows)


def test_equal_rows_leave_one(spark):
    rows = [(1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, "a b c d e f g h"), (3, None), (3, None), (4, "other words here")]
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], SCHEMA)
    left = sorted((r["doc_id"], r["text"] or "") for r in mh.keep_one(df).collect())
    assert left == [(1, "a b c d e f g h"), (3, ""), (3, ""), (4, "other words here")]
    assert mh.keep_one(df).columns == df.columns
    empty = df.filter("doc_id > 99")
    assert mh.near_duplicates(empty).count() == 0 and mh.keep_one(empty).count() == 0


@pytest.mark.parametrize("share", [0.5, 0.8])
def test_darts_agree_as_often_as_sets_are_similar(share):
    rng = np.random.default_rng(1)
    element = rng.integers(0, 2**63, 300).astype(np.uint64)
    a = rng.integers(1, 6, 300) * 0.7
    b = a * np.where(np.arange(300) < 300 * share, 1.0, 0.1)
    doc = np.repeat([0, 1], 300)
    s = mh.darts(np.tile(element, 2), np.concatenate((a, b)), doc, 2, t=4096)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((s[0] == s[1]).mean() - want) < 0.04
    assert (mh.darts(element, b, np.zeros(300, int), 1, t=4096)[0] == s[1]).all()


def test_signature_ignores_the_batch(spark):
    texts = ["a b c d e f", "z", "q w e r t y u i o p"]
    known = {}
    _, together = mh._signatures(texts, known)
    for t, row in zip(texts, together):
        assert (mh._signatures([t], {})[1][0] == row).all()
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.size(mh.signed(F.col("t"))["bands"]).alias("n"))
    assert {r["n"] for r in df.collect()} == {mh.COORDINATES // mh.ROWS}
