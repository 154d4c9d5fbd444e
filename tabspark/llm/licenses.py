"""License notices by diagonal voting of word k-grams."""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tabspark.llm.license_texts import DECISIVE, TEXTS

#: Words of a gram, diagonals that count as one alignment, share of a notice's grams that makes a finding.
GRAM, SLACK, COVER = 2, 3, 0.75
#: Words from which a text is long: a gram at more than this many of its places does not vote for it.
LONG, COMMON = 50, 2

#: Phrases that any place counts for (fixed values).
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Common notices (public texts) and their labels.
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_grams(spark: SparkSession, phrases: dict[str, str], notices: list[tuple[str, str]], k: int) -> DataFrame:
    """(template, base, label, n_grams, at, gram, key_at) of the voting grams of every template: about 1,000 rows.

    ``key_at`` is the place of the label's decisive gram, null where the template has none. The row of
    template -1 stands for a place that every document has, so a document without a hit keeps a row
    through the join.
    """
    rows = [(-1, False, None, 0, -1, "", None)]
    texts = [(label, phrase, True) for phrase, label in phrases.items()] + [(label, text, False) for label, text in notices]
    cut = []
    for label, text, base in texts:
        words = re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))
        if len(words) < k:
            raise ValueError(f"a template needs at least {k} words: {text!r}")
        cut.append((label, base, len(words), [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)]))
    for t, (label, base, n_words, grams) in enumerate(cut):
        places = Counter(grams)
        ends = (0, len(grams) - 1)  # these vote always, so that a span has all words of the text
        own = [(i, g) for i, g in enumerate(grams) if n_words < LONG or places[g] <= COMMON or i in ends or g == DECISIVE.get(label)]
        key = None if base else next((i for i, g in own if g == DECISIVE.get(label)), None)
        rows += [(t, base, label, len(own), i, g, key) for i, g in own]
    return spark.createDataFrame(rows, "template int, base boolean, label string, n_grams int, at int, t_gram string, key_at int")


def aligned(places: list[int], ats: list[int], key: int | None, slack: int) -> tuple[int, int, int, bool]:
    """(grams, first place, last place, decisive gram in it) of the longest run of a template's grams in a text.

    A run rises in the text and in the template, and from one gram to the next its
    diagonal moves by at most ``slack``. Runs with the decisive gram go before all others.
    """
    best: dict[int, list[tuple]] = {}  # by diagonal, the runs that end there: (at, has key, grams, first place, place)
    top = (False, 0, -1, -1)
    for place, at in sorted(zip(places, ats)):
        d, run = place - at, (at == key, 1, place)
        for near in range(d - slack, d + slack + 1):
            for a, has, n, first, p in reversed(best.get(near, ())):
                if a < at and p < place:
                    run = max(run, (has or at == key, n + 1, first), key=lambda r: (r[0], r[1], r[2]))
                    break
        # the newest run of a diagonal is its longest; older ones matter only within the slack
        best[d] = best.get(d, [])[-2 * slack - 1:] + [(at, *run, place)]
        top = max(top, (run[0], run[1], run[2], place), key=lambda r: r[:3])
    return top[1], top[2], top[3], top[0]


def _verified(slack: int):
    @F.pandas_udf("struct<grams int, first bigint, last bigint, decisive boolean>")
    def verify(places: pd.Series, ats: pd.Series, key: pd.Series) -> pd.DataFrame:
        rows = [(0, None, None, False) if p is None else aligned(list(p), list(a), None if pd.isna(k) else int(k), slack)
                for p, a, k in zip(places, ats, key)]
        out = pd.DataFrame(rows, columns=["grams", "first", "last", "decisive"])
        return out.astype({"grams": "int32", "first": "Int64", "last": "Int64", "decisive": "bool"})

    # one evaluation, also where a filter and a column use the result
    return verify.asNondeterministic()


def find(df: DataFrame, key: str = "doc_id", text: str = "text", phrases: dict[str, str] | None = None,
         notices: list[tuple[str, str]] | None = None, k: int = GRAM, slack: int = SLACK,
         cover: float = COVER) -> DataFrame:
    """License texts found, one row per document and template, and a row per document.

    Every rolling k-gram of every whole text is hashed and joined to the templates'
    grams (the templates are constants, so that side is broadcast); the words of a
    gram must be equal too, so hashes alone decide nothing. A hit votes for the
    diagonal ``place - place in the template``. A phrase is found on a diagonal
    where all its grams vote. For a notice, diagonals at most ``slack`` apart whose
    places overlap within its length are one alignment, which takes in words put in
    or left out. Its grams are then verified in order (:func:`aligned`): it is a finding if the
    longest run holds ``cover`` of the notice's voting grams, and the decisive gram where there is one.

    Columns: doc_id, doc_key (hash of the text), n_words, template (-1: the row that
    every document has), base, label, n_grams, n (places), first_word, last_word
    (smallest and largest start), spans (first and last word of each finding, in order),
    coverage, copies (equal rows, on template -1).
    Equal rows vote once. Null is an empty text; a document with fewer than k words
    has no gram; a null key is a key. Votes combine before the shuffle, which
    carries hits and one row a document, never texts.
    """
    words = F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))
    docs = df.select(F.col(key).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("doc_key"), words.alias("w"))
    grams = F.col("w")
    for i in range(1, k):
        tail = F.slice("w", i + 1, F.greatest(F.size("w") - i, F.lit(0)))
        grams = F.zip_with(grams, tail, lambda a, b: F.concat(a, F.lit(" "), b))
    places = docs.select("doc_id", "doc_key", F.size("w").cast("bigint").alias("n_words"),
                         F.posexplode(F.concat(F.array(F.lit("")), grams)).alias("place", "gram"))
    places = places.filter(F.col("gram").isNotNull()).withColumn("place", F.col("place") - 1)
    templates = template_grams(df.sparkSession, PHRASES if phrases is None else phrases,
                               NOTICES + TEXTS if notices is None else notices, k)
    hits = places.join(F.broadcast(templates), (F.xxhash64("gram") == F.xxhash64("t_gram")) & (F.col("gram") == F.col("t_gram")))
    found = ["doc_id", "doc_key", "n_words", "template", "base", "label", "n_grams", "key_at"]
    votes = hits.groupBy(*found, (F.col("place") - F.col("at")).cast("bigint").alias("diagonal")).agg(
        F.collect_set("at").alias("ats"), F.count("*").alias("hits"))
    # single chance grams of a long notice vote for no alignment
    votes = votes.filter(F.col("base") | (F.col("n_grams") < 8) | (F.size("ats") > 1))
    own = Window.partitionBy(*found).orderBy("diagonal")
    far = F.col("base") | (F.col("diagonal") - F.lag("diagonal").over(own) > slack)
    votes = votes.withColumn("new", F.coalesce(far.cast("int"), F.lit(1)))
    votes = votes.withColumn("alignment", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    hit = F.transform("ats", lambda a: F.struct((F.col("diagonal") + a).alias("place"), a.alias("at")))
    spans = votes.groupBy(*found, "alignment").agg(
        F.flatten(F.collect_list(hit)).alias("e"), F.min("diagonal").alias("start"), F.max("hits").alias("copies"))
    none, base = F.col("template") < 0, F.col("base")
    covered = F.size(F.array_distinct(F.transform("e", lambda e: e["at"])))
    spans = spans.filter(none | (covered >= F.when(base, F.col("n_grams")).otherwise(F.lit(cover) * F.col("n_grams"))))
    check = ~none & ~base
    places = [F.when(check, F.transform("e", lambda e: e[c])) for c in ("place", "at")]
    spans = spans.withColumn("v", _verified(slack)(*places, F.col("key_at")))
    grams = F.when(check, F.col("v.grams")).otherwise(F.col("n_grams"))
    first = F.when(check, F.col("v.first")).otherwise(F.col("start"))
    last = F.when(check, F.col("v.last") + k - 1).otherwise(F.col("start") + F.col("n_grams") + k - 2)
    spans = spans.select(*found, "copies", first.alias("first"), last.alias("last"),
                         F.when(none, 0.0).otherwise(grams / F.col("n_grams")).alias("coverage"), F.col("v.decisive").alias("decisive"))
    spans = spans.filter(none | base | ((F.col("coverage") >= cover) & (F.col("key_at").isNull() | F.col("decisive"))))
    return spans.groupBy(*found).agg(
        F.count(F.when(~none, True)).alias("n"), F.min(F.when(~none, F.col("first"))).alias("first_word"),
        F.max(F.when(~none, F.col("first"))).alias("last_word"),
        F.sort_array(F.collect_list(F.when(~none, F.struct("first", "last")))).alias("spans"),
        F.max("coverage").alias("coverage"), F.max(F.when(none, F.col("copies"))).alias("copies")).drop("key_at")


def by_document(found: DataFrame) -> DataFrame:
    """One row per input row of :func:`find`: places of the phrases, labels, the best coverage as score, and spans.

    ``spans`` are the words that a notice was verified on, ``label:first-last``, in order.
    """
    base = F.col("base")

    def names(where):
        return F.array_join(F.sort_array(F.array_distinct(F.collect_list(F.when(where & (F.col("n") > 0), F.col("label"))))), ",")

    one = F.transform("spans", lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), F.col("label").alias("label")))
    every = F.array_distinct(F.sort_array(F.flatten(F.collect_list(F.when(~base & (F.col("template") >= 0), one)))))
    text = F.array_join(F.transform(every, lambda s: F.concat(s["label"], F.lit(":"), s["first"].cast("string"), F.lit("-"), s["last"].cast("string"))), ",")
    docs = found.groupBy("doc_id", "doc_key", "n_words").agg(
        F.coalesce(F.sum(F.when(base, F.col("n"))), F.lit(0)).alias("n_base"), F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("last_word"))).alias("last_word"), names(base).alias("base_labels"),
        names(F.lit(True)).alias("labels"), F.max("coverage").alias("score"), text.alias("spans"), F.max("copies").alias("copies"))
    return docs.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copy", "copies", "doc_key")
