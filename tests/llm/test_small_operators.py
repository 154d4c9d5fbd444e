"""Packing, languages, quality, BPE and fingerprints against plain versions and on odd tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from tabspark.llm import bpe, fingerprint as fp, language, packing, quality
from tabspark.llm import queries as q

SF = "/root/testdata/sf0.001"
ODD = [(1, None, None, None), (2, "", "en", "a"), (3, "   \n\t", "en", "a"), (4, "one", None, "a"), (4, "one", None, "a"),
       (None, "no key here", "de", None), (5, "word " * 30000, "en", "b"), (6, "x" * 200000, "fr", "b"), (7, "é　ü 漢字 \U0001f600", "fr", "c")]
SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    # extra columns with the names of results
    return spark.createDataFrame(ODD, SCHEMA).withColumns({"n_words": F.lit("x"), "shard": F.lit(1), "lang_pred": F.lit("y"), "key": F.lit(0)})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def plain_fit(items, capacity, per_source):
    """Tightest open bin, first made of equals, by looking at every bin."""
    bins, out = [], []
    for length, source, cluster in items:
        fits = [(b["room"], i) for i, b in enumerate(bins) if b["room"] >= length
                and (cluster is None or cluster not in b["clusters"]) and (source is None or b["sources"][source] < per_source)]
        if fits:
            at = min(fits)[1]
        else:
            at = len(bins)
            bins.append({"room": capacity, "clusters": set(), "sources": Counter()})
        b = bins[at]
        b["room"] -= length
        b["clusters"].add(cluster)
        b["sources"][source] += 1
        out.append(at)
    return out


@pytest.mark.parametrize("capacity,per_source", [(50, 1), (100, 2), (37, 3)])
def test_best_fit_is_the_tightest_compatible_bin(capacity, per_source):
    import random
    rng = random.Random(capacity)
    items = sorted(((rng.randint(1, capacity), rng.choice(["a", "a", "b", "c", None]), rng.choice([1, 1, 2, 3, None, *range(9, 90)]))
                    for _ in range(400)), key=lambda x: -x[0])
    assert packing.best_fit(items, capacity, per_source) == plain_fit(items, capacity, per_source)


def test_packing_is_whole_and_keeps_its_conflicts(docs):
    rows = packing.pack(docs, rows_per_shard=50).collect()
    words = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs.collect()}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    total, bins = Counter(), defaultdict(list)
    for r in rows:
        total[r["doc_id"]] += r["n_tokens"]
        if r["bin_id"]:
            bins[r["bin_id"]].append(r)
    assert total == Counter(words)
    for inside in bins.values():
        assert sum(r["n_tokens"] for r in inside) == inside[0]["bin_fill"] <= packing.CAPACITY
        assert sorted(r["slot"] for r in inside) == list(range(len(inside)))
        assert max(Counter(source[r["doc_id"]] for r in inside).values()) <= packing.PER_SOURCE
    again = packing.pack(docs.repartition(5), rows_per_shard=50).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_packing_odd_tables(odd):
    rows = packing.pack(odd).collect()
    got = Counter((r["doc_id"], r["n_tokens"]) for r in rows)
    assert got[1, 0] == got[2, 0] == got[3, 0] == 1 and got[4, 1] == 2 and got[None, 3] == 1
    assert sum(r["n_tokens"] for r in rows if r["doc_id"] == 5) == 30000 and got[5, 2048] == 14
    ones = [r["bin_id"] for r in rows if r["doc_id"] == 4]
    assert len(set(ones)) == 2  # copies do not share a bin
    assert packing.pack(odd.filter("doc_id > 99")).count() == 0


def test_packing_spreads_repeated_rows(spark):
    rows = [(7, "same words here", "en", "a")] * 3000 + [(None, None, None, None)] * 1000 + [(8, "one text", "en", f"s{i}") for i in range(1000)]
    df = spark.createDataFrame(rows + [(100 + i, f"own text {i}", "en", f"t{i}") for i in range(4000)], SCHEMA)
    got = packing.pack(df, rows_per_shard=500).collect()
    assert Counter(r["doc_id"] for r in got if r["doc_id"] is None or r["doc_id"] < 100) == {7: 3000, None: 1000, 8: 1000} and len(got) == 9000
    for k in (7, 8):
        mine = [r["bin_id"] for r in got if r["doc_id"] == k]
        assert len(set(mine)) == len(mine)  # copies do not share a bin
        assert max(Counter(b.split("-")[0] for b in mine).values()) < len(mine) / 3
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, packing.pack(df.repartition(9), rows_per_shard=500).collect()), key=str)


def test_language_holds_out_and_rejects(spark, docs, odd):
    rows = q.op3_language(spark, SF).collect()
    truth = {r["doc_id"]: (r["lang"], len(r["text"])) for r in docs.collect()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"] and truth[r["doc_id"]][1] > 100 and not r["rejected"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]][0] for r in held) >= 0.93 * len(held)
    content = language.fit(docs)
    got = [r["r"] for r in odd.select("doc_id", "text", language.identify(odd, content).alias("r")).collect()]
    assert [g["lang"] for g in got[:3]] == ["und"] * 3 and all(g["score"] == 0 for g in got[:3])
    assert {g["lang"] for g in got} <= {"en", "de", "fr", "es", "und"}
    marks = spark.createDataFrame([("12 \u0301\u0308 !",)], "text string")
    assert marks.select(language.identify(marks, content)["lang"]).first()[0] == "und"
    none = odd.filter("doc_id > 99")
    assert language.fit(none) == {} and odd.select(language.identify(odd, {})["lang"]).distinct().collect()[0][0] == "und"
    assert none.select(language.identify(none, content)).count() == 0


def test_language_sample_takes_a_text_once(spark, monkeypatch):
    monkeypatch.setattr(language, "TEXTS", 20)
    rows = [("en", "the same text again")] * 500 + [("en", f"text {chr(97 + i % 26)}{chr(97 + i // 26)} own") for i in range(300)] + [("de", "ein Wort"), (None, "x")]
    content = language.fit(spark.createDataFrame(rows, "lang string, text string").repartition(7))
    assert set(content) == {"en", "de"} and len(content["en"].decode().split(" own")) >= 19
    assert content == language.fit(spark.createDataFrame(rows[::-1], "lang string, text string"))


def test_language_sizes_are_those_of_the_dictionaries():
    content = {"a": b"the quick brown fox " * 20, "b": b"lorem ipsum dolor sit " * 20}
    coding = language.coders(content)
    assert language.decide(b" the quick brown dog ", coding)[0] == "a"
    assert language.decide(b" ipsum dolor amet ", coding)[0] == "b"
    assert language.decide(b" zz ", coding)[2] < language.MARGIN


def plain_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, dup = [], 0
    for line in text.split("\n"):
        dup += line in lines
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines.append(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    repeat = len({i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)})
    failed = len(words) < 10 or 100 * repeat > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, repeat, failed


def test_quality_counts(docs, odd):
    for df in (docs, odd.filter("doc_id is null or doc_id <> 6")):
        for r in df.select("text", quality.rules(F.col("text")).alias("q")).collect():
            g = r["q"]
            assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"], g["base_failed"]) == plain_quality(r["text"])
            assert not (g["base_failed"] and g["kept"])


def test_quality_bands():
    import random
    rng = random.Random(1)
    compress = zstandard.ZstdCompressor(level=quality.LEVEL, write_checksum=False, write_content_size=False).compress
    noise = " ".join("".join(chr(rng.randrange(33, 126)) for _ in range(8)) for _ in range(900)).encode()
    verdict = quality.judge(noise, compress)
    assert not verdict[-1] and not verdict[-4]
    count = " ".join(f"{i % 7} {i}" for i in range(100)) * 60
    assert quality.band_verdict(b"ab" * 5000, compress)[2] is False and quality.band_verdict(count.encode(), compress)[2] is False
    assert quality.band_verdict(b"short", compress) == (None, 0.0, True)


def test_quality_rejects_what_does_not_compress(docs):
    import base64
    import random
    rng = random.Random(2)
    compress = zstandard.ZstdCompressor(level=quality.LEVEL, write_checksum=False, write_content_size=False).compress
    texts = [r["text"].encode() for r in docs.filter("text is not null").collect()]
    clean = [t for t in texts if 256 <= len(t) and quality.band_verdict(t, compress)[0] > 0.3]
    assert len(clean) > 150 and all(quality.band_verdict(t, compress)[2] for t in clean)
    prose = b" ".join(clean)

    def base64_words(n, width=60):
        coded = base64.b64encode(rng.randbytes(n))
        return b" ".join(coded[i:i + width] for i in range(0, n, width))[:n]

    def printable(n):
        return b" ".join(bytes(rng.randrange(33, 127) for _ in range(8)) for _ in range(n // 9 + 1))[:n]

    def ascii_any(n):
        return bytes(rng.randrange(128) for _ in range(n))

    def mixed_characters(n):
        return "".join(chr(rng.randrange(0x80, 0xD7FF)) for _ in range(n)).encode()[:n].decode(errors="ignore").encode()

    for noise in (base64_words, printable, ascii_any, mixed_characters):
        for n in (300, 500, 700, 1000, 2000, 3000, 4096, 5000, 9000, 20000, 70000, 200000):
            ratio, odd, inside = quality.band_verdict(noise(n), compress)
            assert not inside and odd == 1.0, (noise.__name__, n, ratio, odd)
        for n in (1024, 2048, 4096, 8192, 32768, 131072):  # half prose and half noise
            assert not quality.band_verdict(prose[:n // 2] + noise(n // 2), compress)[2], (noise.__name__, n)
        chunks = [prose[i * 4096:][:4096] for i in range(3)] + [noise(4096) for _ in range(4)]
        rng.shuffle(chunks)
        assert quality.band_verdict(b"".join(chunks), compress)[1] > 0.5
        assert quality.judge(noise(20000), compress)[-1] is False
    cyrillic = "".join(rng.choice("оеаинтсрвлкмдпуяыьгзбчйхжшюцщэф  ") for _ in range(30)).encode()
    assert quality.most(cyrillic * 100) == pytest.approx(quality.most(b"x" * len(cyrillic * 100)))
    assert quality.most("漢".encode() * 200) > quality.most(b"x" * 600)


def test_bpe_equals_the_rank_coder(spark, docs, odd):
    import base64

    import public_tokenizers as p
    import tiktoken
    path = p.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    other = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rare = spark.createDataFrame([(50 + i, t, None, None) for i, t in enumerate(
        ["a՘֋ b", " ​ \n\n x", "<|endoftext|>", "I'll we've 'S", "aaaa" * 40, "\x85\x1c\t\t z", "한국어 텍스트 ꟎"])], SCHEMA)
    for df in (docs, odd.select("doc_id", "text", "lang", "source"), rare):
        for r in df.select("text", bpe.round_trip(spark, F.col("text"), path, p.PATTERN).alias("r")).collect():
            ids = other.encode_ordinary(r["text"] or "")
            assert r["r"]["n_tokens"] == len(ids)
            assert r["r"]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r["r"]["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    both = rare.select("text", bpe.encode(spark, F.col("text"), path, p.PATTERN).alias("e"))
    both = both.select("text", "e", bpe.decode(spark, F.col("e.ids"), path, p.PATTERN).alias("d")).collect()
    for r in both:
        assert r["d"]["text"] == r["text"] and bytes(r["d"]["bytes"]) == r["text"].encode()
        starts, ends = r["e"]["starts"], r["e"]["ends"]
        assert starts[0] == 0 and ends[-1] == len(r["text"]) and all(a < b for a, b in zip(starts, ends))
        assert all(b in (a, a + 1) for a, b in zip(starts[1:], ends)) or all(b <= a + 1 for a, b in zip(starts[1:], ends))
    split = other.encode_ordinary("\U0001f9ff")
    if len(split) > 1:
        one = spark.createDataFrame([(split[:1],)], "i array<int>").select(bpe.decode(spark, F.col("i"), path, p.PATTERN)["text"]).first()[0]
        assert "�" in one


def test_bpe_cuts_alike_on_common_characters():
    import public_tokenizers as p
    import regex
    from tokenizers import Regex, pre_tokenizers
    cut, find = pre_tokenizers.Split(Regex(p.PATTERN), behavior="isolated"), regex.compile(p.PATTERN).findall
    for low, high in bpe.SAFE:
        for c in range(low, high + 1, 1 if high < 0x2100 else 7):
            text = f"a{chr(c)}{chr(c)}b {chr(c)}1{chr(c)}"
            assert find(text) == [x for x, _ in cut.pre_tokenize_str(text)]


def plain_phrases(text):
    seen, phrase = set(), ""
    for c in text:
        phrase += c
        if phrase not in seen:
            seen.add(phrase)
            phrase = ""
    return seen


def plain_next(rows):
    """Fingerprints by parsing every text and every edited text anew."""
    rows = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (k, t) in enumerate(rows):
        n = rows[(i + 1) % len(rows)][1]
        third = len(t) // 3
        edited = t[:len(t) - third] + n[:third]
        a, b, c = (fp.signature(fp.digest(sorted(plain_phrases(x)))) for x in (t, edited, n))
        out.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, fp.likeness(a, b), fp.likeness(a, c)))
    return out


def test_fingerprints_in_ranges_and_with_odd_texts(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(-5, None), (-6, ""), (None, "no key"), (10**9, "word " * 20000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("p", F.lit(1))
    want = sorted(plain_next(rows), key=str)
    for size in (7, 8192):
        assert sorted(map(tuple, fp.against_next(df, rows_per_range=size).collect()), key=str) == want
    one = df.filter("doc_id = -6")
    assert [tuple(r) for r in fp.against_next(one).collect()] == plain_next([(-6, "")])
    assert fp.against_next(df.filter("doc_id = -99")).count() == 0


def test_fingerprints_of_repeated_rows(spark):
    rows = [(3, "abcabcabc")] * 40 + [(2, "xyz"), (4, "something else")]
    got = fp.against_next(spark.createDataFrame(rows, "doc_id bigint, text string"), rows_per_range=5).collect()
    assert Counter(r["doc_id"] for r in got) == {3: 40, 2: 1, 4: 1}
    assert len({r["fingerprint"] for r in got if r["doc_id"] == 3}) == 1
