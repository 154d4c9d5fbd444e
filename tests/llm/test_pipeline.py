"""The pipeline against its stages in plain Python, and the entry without the subpackage."""

import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline as cp
import zstandard

from tabspark.llm import language, lines, minhash as mh, packing, quality

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def test_stages_keep_what_plain_versions_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    compress = zstandard.ZstdCompressor(level=quality.LEVEL, write_checksum=False, write_content_size=False).compress
    one = cp.quality_rules(spark, docs, SF)
    assert one.columns == docs.columns
    kept = {r["doc_id"] for r in one.collect()}
    assert kept == {i for i, r in rows.items() if quality.judge(r["text"].encode(), compress)[-1]}
    two = cp.language_id(spark, one, SF)
    coding = language.coders(language.fit(one))
    clear = {r["doc_id"]: language.decide(r["c"].encode(), coding) for r in one.select("doc_id", language.letters(one["text"]).alias("c")).collect()}
    assert {r["doc_id"]: r["lang"] for r in two.collect()} == {i: d[0] for i, d in clear.items() if d[0] != "und" and d[2] >= language.MARGIN}
    three = cp.line_dedup(spark, two, SF)
    assert three.columns == docs.columns and all(r["n_chars"] == len(r["text"]) for r in three.collect())
    four = cp.near_dedup(spark, three, SF)
    left, before = four.collect(), three.collect()
    counts = {r["doc_id"]: mh.word_counts(r["text"]) for r in before}
    for r in left:
        assert not any(o["doc_id"] < r["doc_id"] and mh.weighted_jaccard(counts[o["doc_id"]], counts[r["doc_id"]]) >= 0.8 for o in before)
    words = Counter({r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in left})
    total = Counter()
    for r in cp.run(spark, SF).collect():
        total[r["doc_id"]] += r["n_tokens"]
        assert (r["bin_fill"] or 0) <= packing.CAPACITY
    assert total == words and lines.RATIO < 1


def test_empty_documents(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 0")
    for _, stage in cp.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_library_does_not_import_the_subpackage():
    code = "import sys, tabspark.plans as p; p.load(); assert not any(m.startswith('tabspark.llm') for m in sys.modules)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
