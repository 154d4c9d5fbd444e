"""Keys, clashing names, learned limits and shared evaluations."""

import math
import re
import statistics
from collections import Counter

import corpus_pipeline as cp
import pytest
import zstandard
from pyspark.sql import functions as F

from tabspark.llm import bpe, language, lines, minhash as mh, packing, quality

SF = "/root/testdata/sf0.001"


# --- packing ----------------------------------------------------------------------------------

@pytest.mark.parametrize("kind,keys", [("bigint", [None, 2**60 + 1, 2**60 + 3, -7]), ("string", ["b", None, "é", ""])])
def test_packing_keeps_every_digit_of_a_key(spark, kind, keys):
    rows = [(k, f"w{i} " * (i + 1), "s") for i, k in enumerate(keys)]
    got = packing.pack(spark.createDataFrame(rows, f"doc_id {kind}, text string, source string"))
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got.collect()) == Counter((k, i + 1) for i, k in enumerate(keys))
    assert dict(got.dtypes)["doc_id"] == kind


# --- quality ----------------------------------------------------------------------------------

def plain_limits(points, at):
    """Least and greatest at a length, by hand: the line between the learned lengths around it."""
    for (a, la, ha), (b, lb, hb) in zip(points, points[1:]):
        if a <= at <= b:
            t = (at - a) / (b - a)
            return la + t * (lb - la), ha + t * (hb - ha)
    return None


def test_limits_are_medians_and_spreads():
    import random

    rng = random.Random(3)
    own = [(0, rng.uniform(8, 13), 0.0) for _ in range(3000)]
    own = [(0, x, 0.9 - 0.04 * x + rng.gauss(0, 0.01)) for _, x, _ in own]
    limits = quality.learn(own)
    x, low, high = next(p for p in limits.points[0] if p[0] == 10.0)
    near = [r for _, a, r in own if abs(a - 10.0) <= 0.5]
    centre = statistics.median(near)
    spread = 1.4826 * statistics.median(abs(r - centre) for r in near)
    assert low < centre < high and 2 * spread < centre - low < 4.5 * spread and 2 * spread < high - centre < 7 * spread
    inside = [plain_limits(limits.points[0], a) for _, a, _ in own]
    lost = sum(lim is not None and r < lim[0] for (_, _, r), lim in zip(own, inside))
    assert lost <= 0.004 * len(own)
    assert quality.learn(own[:30]).points == {}  # too few to tell


def test_limits_are_learned_from_every_good_text(spark):
    # 9,000 good texts of 280 to 840 bytes; the last 700 compress unlike the rest
    word = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), (20 + F.col("doc_id") % 40).cast("int")), lambda i: F.concat(
        F.hex(F.xxhash64("doc_id", i) % F.when(F.col("doc_id") < 8300, 1 << 24).otherwise(1 << 40)), F.lit("an"), (i % 10).cast("string"))))
    docs = spark.range(9000, numPartitions=8).select(F.col("id").alias("doc_id")).withColumn("text", word)
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    q = docs.select(quality.rules(F.col("text"), figures=True).alias("q")).filter("q.ratio is not null and not q.base_failed")
    figures = [(r["script"], r["size"], r["ratio"]) for r in q.select("q.script", "q.size", "q.ratio").collect()]
    want, got = quality.learn(figures).points, quality.fit(docs, labels.unionByName(labels)).points
    assert len(figures) > 8000 and set(got) == set(want) and len(want[0]) >= 3
    assert [x for p in got[0] for x in p] == pytest.approx([x for p in want[0] for x in p], rel=1e-9)


def test_limits_decide_and_keep_clean_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    limits = quality.fit(docs, labels)
    rows = docs.join(labels, "doc_id").select("text", "quality", quality.rules(F.col("text"), limits).alias("q")).collect()
    compress = zstandard.ZstdCompressor(level=quality.LEVEL, write_checksum=False, write_content_size=False).compress
    by = Counter()
    for r in rows:
        q, data = r["q"], r["text"].encode()
        if not q["base_failed"] and len(data) >= 256 and quality.script(data) == 0:
            lim = plain_limits(limits.points[0], math.log2(len(data)))
            ratio = len(compress(data)) / len(data)
            if lim is not None and abs(ratio - lim[0]) > 1e-9:
                assert (q["band"] == "low") == (ratio < lim[0])
        assert q["kept"] == (not q["base_failed"] and q["band"] is None)
        if not q["base_failed"]:
            by[r["quality"], q["kept"]] += 1
    assert by[1, False] <= 0.01 * (by[1, True] + by[1, False])
    assert by[0, False] >= 0.5 * (by[0, True] + by[0, False])


def test_limits_without_labels_are_the_fixed_bands(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.fit(docs, none).points == {}


# --- language ---------------------------------------------------------------------------------

def test_language_is_that_of_the_smallest_sum_of_sizes(spark):
    """An independent version: letters by a regular expression, sizes by a fresh compressor per chunk."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    content = language.fit(docs)
    for r in docs.select("text", language.identify(docs, content).alias("f")).collect():
        words = re.findall(r"[^\W\d_]+", r["text"].lower())
        words = [w for i, w in enumerate(words) if i == 0 or words[i - 1] != w]
        if any(re.search(r"[^\x00-\x7F]", w) and not w.isalpha() for w in words):
            continue  # marks are letters of the operator only
        clean = (" ".join(words) + " ").encode()
        lead = b" " if re.match(r"[\W\d_]", r["text"]) else b""
        sizes = {}
        for name, data in content.items():
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            sizes[name] = sum(len(zstandard.ZstdCompressor(level=language.LEVEL, dict_data=d, write_content_size=False, write_checksum=False,
                                                           write_dict_id=False).compress((lead + clean)[i:i + language.CHUNK]))
                              for i in range(0, len(lead + clean), language.CHUNK))
        best = sorted((s, n) for n, s in sizes.items())
        if len(best) > 1 and best[1][0] - best[0][0] > 2:
            assert r["f"]["lang"] == best[0][1]


def test_pipeline_finds_the_language_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = cp.language_id(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"ArrowEvalPython", plan)) == 1


# --- names ------------------------------------------------------------------------------------

def test_columns_of_any_name(spark):
    names = ("done", "site_lines", "site_host", "n_dropped", "d0", "d_text", "gone_id", "gone_digest", "again_id", "again_digest", "own_id", "found", "host")
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    docs = docs.unionByName(docs.limit(3)).withColumns({n: F.lit(n) for n in names})
    for stage in (cp.quality_rules, cp.language_id, cp.line_dedup, cp.near_dedup):
        out = stage(spark, docs, SF)
        rows = out.collect()
        assert out.columns == docs.columns and rows and all(r[n] == n for r in rows for n in names)
    assert lines.drop_lines(docs).columns == [c for c in docs.columns if c != "n_dropped"] + ["n_dropped"]
    assert mh.keep_one(docs.filter("doc_id < -1")).count() == 0


# --- tokens -----------------------------------------------------------------------------------

def test_tokens_are_alike_when_the_memory_turns_over(monkeypatch):
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        own = bpe.Codec(f.read(), public_tokenizers.PATTERN)
    ranks = {b: r for r, b in own.bytes.items()}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(bpe, "PIECES", 20)
    monkeypatch.setattr(bpe, "TOGETHER", 7)
    texts = [f"word{i % 13} Ünïcode {i} x" * (i % 5) + "日本語 " * (i % 3) + "q" * (i % 80) for i in range(120)]
    for text, pieces in zip(texts, own.entries(texts), strict=True):
        ids = [i for e in pieces for i in e[0]]
        assert ids == plain.encode_ordinary(text) and b"".join(e[2] for e in pieces) == text.encode()
        assert ",".join(e[1] for e in pieces) == ",".join(map(str, ids))
    assert own.old
