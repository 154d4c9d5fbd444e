"""License texts: runs of grams against all runs, whole texts with their spans, relatives told apart."""

import random

import pytest

from tabspark.llm import fingerprint, licenses
from tabspark.llm.license_texts import DECISIVE, TEXTS


def plain_aligned(places, ats, key, slack):
    """Every earlier gram as a predecessor."""
    hits = sorted(zip(places, ats))
    runs = []
    for i, (p, a) in enumerate(hits):
        own = [(a == key, 1)]
        for (has, n), (q, b) in zip(runs, hits):
            if q < p and b < a and abs((p - a) - (q - b)) <= slack:
                own.append((has or a == key, n + 1))
        runs.append(max(own))
    return max(runs)


def test_runs_are_those_of_all_predecessors():
    rng = random.Random(5)
    for _ in range(400):
        pairs = sorted({(rng.randrange(30), rng.randrange(12)) for _ in range(rng.randrange(1, 40))})
        places, ats = map(list, zip(*pairs))
        key = rng.choice([None, 3])
        got = licenses.aligned(places, ats, key, 3)
        assert (got[3], got[0]) == plain_aligned(places, ats, key, 3)
        assert got[1] <= got[2] and got[1] in places and got[2] in places


def words_of(text):
    return licenses.re.findall(licenses.WORD, text.lower())


def test_whole_texts_are_found_with_their_words(spark):
    rows = [(i, f"Some words first. {text} And more after it.") for i, (_, text) in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in licenses.by_document(licenses.find(df)).collect()}
    for i, (label, text) in enumerate(TEXTS):
        assert label in got[i]["labels"].split(",")
        n = len(words_of(text))
        ends = [s.split(":")[1] for s in got[i]["spans"].split(",") if s.startswith(label + ":")]
        assert any(3 <= int(e.split("-")[0]) <= 5 and n <= int(e.split("-")[1]) <= n + 2 for e in ends), (label, ends)


def test_relatives_are_told_apart(spark):
    df = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(TEXTS)], "doc_id bigint, text string")
    got = {TEXTS[r["doc_id"]][0]: set(r["labels"].split(",")) for r in licenses.by_document(licenses.find(df)).collect()}
    for family in ({"lgpl", "agpl"}, {"cc-by-sa", "cc-by-nc", "cc-by-nd", "cc-by"}, {"mit", "isc", "boost", "zlib"}):
        for label in family:
            assert got[label] & family == {label}, (label, got[label])
    assert set(DECISIVE) <= {label for label, _ in TEXTS}


def test_edited_shuffled_and_odd_texts(spark):
    mit = next(t for n, t in TEXTS if n == "mit")
    w = words_of(mit)
    shuffled = list(w)
    random.Random(1).shuffle(shuffled)
    edited = " ".join(x for i, x in enumerate(w) if i % 25 != 7)
    reversed_halves = " ".join(w[len(w) // 2:] + ["x"] * 40 + w[:len(w) // 2])
    rows = [(1, edited), (2, " ".join(shuffled)), (3, None), (4, "the software " * 5000), (5, " ".join(w)), (5, " ".join(w)), (6, reversed_halves)]
    found = licenses.find(spark.createDataFrame(rows, "doc_id bigint, text string"), notices=[("mit", mit)])
    got = licenses.by_document(found).collect()
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert labels == {1: "mit", 2: "", 3: "", 4: "", 5: "mit", 6: ""} and len(got) == len(rows)
    assert all(r["spans"] == f"mit:0-{len(w) - 1}" and r["score"] == 1 for r in got if r["doc_id"] == 5)


@pytest.mark.parametrize("most", [1, 3])
def test_fingerprints_with_few_ranges(spark, monkeypatch, most):
    rows = [(i, f"text number {i * i} of a table {'ab' * i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted(map(tuple, fingerprint.against_next(df).collect()))
    monkeypatch.setattr(fingerprint, "MAX_RANGES", most)
    assert sorted(map(tuple, fingerprint.against_next(df, rows_per_range=5).collect())) == want
