"""Toxicity, source divergence and collocations against plain versions on odd input."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from tabspark.llm import divergence, phrases, queries, sampling, toxicity

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, lang string, source string, text string"


def table(spark, rows):
    """Documents with further columns named like those the operators make."""
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("term", "n", "docs", "words", "label", "h", "rank", "shard", "p", "key")})


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(5)
    words = ["the", "The", "a", "été", "ÉTÉ", "x1y", "日本", "of", "zz", "q"]
    rows = [(i, rng.choice(["en", "en", "en", "fr", None]), rng.choice(["s1", "s1", "s1", "s2", "s3", None, "é"]),
             "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "!", "\x0b"]) for _ in range(rng.randrange(1, 60)))) for i in range(150)]
    rows += [rows[3]] * 5 + [(None, "en", "s1", None), (900, "de", "s1", "only one"), (901, "en", "s9", ""), (902, "en", "s9", "123 ..."),
                             (903, "xx", "a", None), (904, "xx", "b", ""), (905, "en", "s2", "the a of " * 3000)]
    return table(spark, rows)


# --- divergence -------------------------------------------------------------------------------

def plain_audit(rows, least, top):
    groups, docs, counts, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), set()
    for r in rows:
        lang, source, text = r["lang"] or "", r["source"] or "", r["text"] or ""
        terms = [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        groups[lang, source].update(terms)
        counts[lang].update(terms)
        docs[lang].update(set(terms))
        langs.add(lang)
    out = set()
    for lang in langs:
        kept = [t for t, n in docs[lang].items() if n >= least]
        v = len(kept)

        def share(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + (10**9 * (c[t] + 2)) // (n + 2 * v) for t in kept}
        whole = share(counts[lang])
        own = {s: share(c) for (g, s), c in groups.items() if g == lang}
        for a, p in own.items():
            def f(q, t):
                return (p[t] - q[t]) ** 2 // (p[t] + q[t])
            pairs = sorted(((-sum(f(q, t) for t in kept), b.encode(), b) for b, q in own.items() if b != a))
            out |= {(lang, a, "pair", b, -v_, i + 1) for i, (v_, _, b) in enumerate(pairs)}
            terms = sorted((-f(whole, t), t.encode(), t) for t in kept if groups[lang, a][t] and p[t] > whole[t])[:top]
            out |= {(lang, a, "term", t, -v_, i + 1) for i, (v_, _, t) in enumerate(terms)}
    return out


def rows_of(df):
    got = df.collect()
    assert len(got) == len({tuple(r) for r in got})
    return {tuple(r) for r in got}


def test_divergence(odd, monkeypatch):
    want = plain_audit(odd.collect(), 3, 4)
    assert rows_of(divergence.audit(odd, 3, 4)) == want
    # many parts give the same rows
    for name, value in (("UNIT_ROWS", 3), ("TILE", 2), ("BAND_TERMS", 2), ("MERGED", 2), ("TERMS_HELD", 8)):
        monkeypatch.setattr(divergence, name, value)
    assert rows_of(divergence.audit(odd, 3, 4)) == want
    assert divergence.audit(odd.filter("doc_id < -1")).count() == 0
    assert divergence.audit(odd).columns == ["lang", "source", "part", "item", "value", "rank"]


def test_skyband_is_that_of_all_pairs():
    import numpy as np

    rng = np.random.default_rng(0)
    for k in (1, 2, 5):
        n, of, place = rng.integers(0, 6, 200), rng.integers(0, 6, 200), rng.permutation(200)
        beats = (n[:, None] >= n) & (of[:, None] <= of) & (place[:, None] < place)
        assert set(divergence.skyband(n, of, place, k).tolist()) == set(np.flatnonzero(beats.sum(0) < k).tolist())


# --- phrases ----------------------------------------------------------------------------------

def plain_phrases(rows, least, longest, ranks, covered):
    f, n = defaultdict(Counter), Counter()
    for r in rows:
        lang = "und" if r["lang"] is None else r["lang"]
        text = re.sub("[A-Z]", lambda m: m.group().lower(), r["text"] or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f[lang].update(tuple(words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = set()
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in cand.items():
            for k in range(2, len(p)):
                inside |= {p[i:i + k] for i in range(len(p) - k + 1) if 100 * a >= covered * c[p[i:i + k]]}
        scored = []
        for p, a in cand.items():
            if p not in inside:
                s, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), a, c[p[:k]], c[p[k:]]))
        out |= {(lang, i + 1, p.decode(), a, x, y, n[lang], -s) for i, (s, _, p, a, x, y) in enumerate(sorted(scored)[:ranks])}
    return out


@pytest.mark.parametrize("shards,slots,covered,ranks", [(3, 1 << 16, 100, 2000), (1, 1 << 16, 60, 7), (4, 64, 100, 2000)])
def test_phrases(odd, shards, slots, covered, ranks):
    got = rows_of(phrases.collocations(odd, 4, 5, ranks, covered, shards, slots))
    assert got == plain_phrases(odd.collect(), 4, 5, ranks, covered)


def test_a_phrase_in_a_reached_slot_is_counted_for_a_whole_cycle(spark):
    import numpy as np

    least, longest, shards = 6, 5, 3
    for seed in (1, 2):
        rng = np.random.default_rng(seed)
        ids, texts, want = rng.integers(1, 2**63, 30, dtype=np.uint64), [], Counter()
        for shard in range(shards):
            tokens = ids[rng.choice(30, 600, p=rng.dirichlet(np.full(30, 0.3)))].copy()
            tokens[rng.random(600) < 0.1] = 0
            tokens[-1] = 0
            texts.append((shard, "en", bytearray(tokens.tobytes())))
            windows = [tokens[i:i + k] for k in range(1, longest + 1) for i in range(600 - k + 1)]
            want.update(w.tobytes() for w in windows if w.all())
        found = phrases.count_phrases(spark.createDataFrame(texts, "shard int, lang string, tokens binary"), least, longest, shards, 64)
        assert {bytes(r["words"]): r["n"] for r in found.collect()} == {w: n for w, n in want.items() if n >= least}


def test_phrases_of_nothing(spark, odd):
    assert phrases.collocations(odd.filter("doc_id < -1")).count() == 0
    assert phrases.collocations(table(spark, [(1, None, None, None), (2, "en", "a", " . ,")]), 1).count() == 0
    got = phrases.collocations(table(spark, [(1, None, None, "b a b a")]), 1)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.first()["lang"] == "und"


def test_two_words_with_one_hash_are_hashed_anew(spark, monkeypatch):
    real = phrases.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(phrases.xxhash, "xxh3_64_intdigest", lambda x, seed=0: 77 if seed == 0 and x in (b"one", b"two") else real(x, seed))
    words = phrases._Words(0)
    assert words[b"one"] == words[b"two"] != phrases._Words(1)[b"one"]


# --- toxicity ---------------------------------------------------------------------------------

def test_fold():
    assert toxicity.fold("You 1d10t! $tup1d, IDIОT") == " you idiot stupid idiot "  # the O is Cyrillic
    assert toxicity.fold("call 555-1234 now 3") == " call now "
    assert toxicity.fold("дом а") == " дом а " and toxicity.fold("i​diot ｉｄｉｏｔ") == " idiot idiot "
    assert toxicity.fold("").strip() == "" and toxicity.fold("###").strip() == ""


def plain_hits(entries, exceptions, folded):
    out = {}
    for at in range(len(folded)):
        for text, w in entries.items():
            if folded.startswith(text, at):
                out[at] = max(w, out.get(at, 0.0))
    for e in exceptions:
        for m in re.finditer(f"(?={re.escape(e)})", folded):
            out = {a: w for a, w in out.items() if not m.start() <= a < m.start() + len(e) - 1}
    return out


def test_matches_are_those_of_a_plain_search():
    rng = random.Random(1)
    entries = {" ba": 1.0, " bab ": 3.0, " c": 0.5, " abc ": 2.0, " a ": 1.5}
    exceptions = [" bab c ", " a a "]
    lex = toxicity.Lexicon(entries, exceptions)
    for _ in range(300):
        folded = f" {' '.join(''.join(rng.choice('abc') for _ in range(rng.randrange(1, 4))) for _ in range(12))} "
        assert lex.hits(folded) == plain_hits(entries, exceptions, folded)


def labelled(spark, rows):
    docs = table(spark, [(i, "en", "s", t) for i, t, _ in rows])
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")


def test_lexicon_learns_words_stems_and_exceptions(spark):
    rng = random.Random(2)
    plain = ["tree", "house", "river", "stone", "cloud", "green", "walk", "sing"]
    rows = []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 40))]
        toxic = i % 4 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["vermin", f"grox{rng.choice('abcdefgh')}{rng.choice('xyzuv')}"]))
        elif i % 40 == 1:
            words.insert(rng.randrange(len(words)), "vermin control")
        rows.append((i, " ".join(words), int(toxic)))
    docs, labels = labelled(spark, rows)
    lex = toxicity.fit(docs, labels)
    entries, spared = toxicity.entries_of(lex)
    assert any(e.startswith(" gro") for e in entries) and " vermin control " in spared
    assert lex.score("the v3rmin there")[0] > 0.5 > lex.score("vermin control by the river")[0]
    assert lex.score("groxqq near the tree")[0] > 0.5 > lex.score("tree house")[0] == lex.score("")[0]
    got = docs.select("doc_id", toxicity.score(docs, lex)["score"].alias("s")).collect()
    assert sum((r["s"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in got) >= 0.99 * len(got)
    text = {i: t for i, t, _ in rows}
    assert all(abs(r["s"] - lex.score(text[r["doc_id"]])[0]) < 1e-12 for r in got)


def test_toxicity_of_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    lex = toxicity.fit(odd, none)
    got = odd.select("doc_id", toxicity.score(odd, lex).alias("r")).collect()
    assert len(got) == odd.count() and len({r["r"]["score"] for r in got}) == 1 and all(0 <= r["r"]["score"] <= 1 for r in got)
    ones = spark.createDataFrame([(1, 1), (2, None), (None, 1)], "doc_id bigint, toxic int")
    assert 0.5 <= toxicity.fit(odd, ones).score("anything")[0] <= 1
    assert odd.filter("doc_id < -1").select(toxicity.score(odd, lex)).count() == 0


def test_sample_is_bounded_and_distinct(spark):
    docs = table(spark, [(i % 50, "en", "s", f"text {i % 40}") for i in range(100)] + [(7, "en", "s", None)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] * 2 + [(3, 0), (None, 1)], "doc_id bigint, toxic int")
    got = sampling.labelled(docs, labels, "toxic", 10).collect()
    assert len(got) == len({r["text"] for r in got}) and {r["label"] for r in got} == {0, 1}
    assert all(sum(r["label"] == k for r in got) <= 20 for k in (0, 1))
    whole = {r["text"]: r["label"] for r in sampling.labelled(docs, labels, "toxic", 100).collect()}
    assert len(whole) == 40 and whole["text 3"] == 1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.QUERIES["op11_toxicity"](spark, sf)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = out.join(spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all((r["score"] >= 0.5) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in rows)
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.95 * len(held)


def test_exact_where_products_pass_64_bits(spark):
    big = 3_000_000_000_000
    df = spark.createDataFrame([(big, big * 900, big, big + 1), (100, 10**15, 100, 100)], "a bigint, n bigint, l bigint, r bigint")
    got = [r[0] for r in df.select(phrases.score(*(F.col(c) for c in "anlr"))).collect()]
    assert got == [1000 * big * big * 900 // (big * (big + 1)), 1000 * 100 * 10**15 // 10**4]
    shares = spark.createDataFrame([(c, t, v) for c, t, v in product((0, 1, 999_999), (10**6, 7 * 10**14), (1, 12345))], "c bigint, t bigint, v bigint")
    for r in shares.select("c", "t", "v", divergence.share(F.col("c"), F.col("t"), F.col("v")).alias("p")).collect():
        assert r["p"] == 1 + 10**9 * (r["c"] + 2) // (r["t"] + 2 * r["v"]), r
    assert math.isclose(toxicity.probability((0.0, 1.0, 0.0, 0.0), (0.0, 0.0, 0.0)), 0.5)
