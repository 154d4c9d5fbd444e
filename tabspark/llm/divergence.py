"""How the sources of a language differ: divergence of every two sources, and the terms a source overuses."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabspark.llm.scratch import cut, drop

#: Documents of a language from which a term is kept, terms listed per group, the scale of a share.
LEAST_DOCS, TOP, SCALE = 10, 10, 1_000_000_000
#: Distinct terms a task counts before it sends them on.
TERMS_HELD = 300_000
#: Rows of a unit of pair sums, sources of a tile, terms of a first skyband, skybands merged at a time.
UNIT_ROWS, TILE, BAND_TERMS, MERGED = 200_000, 256, 4096, 64

#: ASCII other than letters becomes a space, A-Z becomes a-z; every byte of another character stays.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(df: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term in every group; nulls are ''."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}

        def flush():
            for (lang, source), (n, docs) in held.items():
                k = len(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()), pa.array(n.keys(), pa.binary()),
                                                  pa.array(n.values(), pa.int64()), pa.array([docs[t] for t in n], pa.int64())], schema=schema)
            held.clear()

        for batch in batches:
            for lang, source, text in zip(*(batch.column(i) for i in range(3))):
                words = text.as_py().translate(LETTERS).split()
                own = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                own[0].update(words)
                own[1].update(set(words))
                if len(own[0]) > TERMS_HELD // 8 and sum(len(n) for n, _ in held.values()) > TERMS_HELD:
                    yield from flush()
        yield from flush()

    rows = df.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "lang string, source string, term binary, n bigint, docs bigint")
    return rows.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10**9 (count + 2) / (total + 2 kept)), three digits at a time, so that no product passes 64 bits."""
    of, left = total + 2 * kept, count + 2
    out = F.lit(1).cast("bigint")
    for scale in (1_000_000, 1_000, 1):
        out = out + _div(left * 1000, of) * scale
        left = (left * 1000) % of
    return out


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def divergence(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def skyband(n: np.ndarray, of: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Rows that fewer than ``k`` others dominate: count not lower, language count not higher, place earlier.

    Rows are visited so that a row comes after all that dominate it; those that
    dominate a row k times over are in the band themselves, so only the band is searched.
    """
    order = np.lexsort((place, of, -n))
    band, m = np.empty(len(n), np.int64), 0
    bo, bp = np.empty(len(n), of.dtype), np.empty(len(n), place.dtype)
    for i in order:
        if m < k or np.count_nonzero((bo[:m] <= of[i]) & (bp[:m] < place[i])) < k:
            band[m], bo[m], bp[m] = i, of[i], place[i]
            m += 1
    return band[:m]


def _bands(df: DataFrame, k: int) -> DataFrame:
    """The skyband of every (lang, source, salt)."""
    def run(own: pa.Table) -> pa.Table:
        order = pc.sort_indices(pc.cast(own["term"], pa.binary())).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return own.take(pa.array(skyband(own["n"].to_numpy(), own["lang_n"].to_numpy(), place, k)))

    return df.groupBy("lang", "source", "salt").applyInArrow(run, df.schema)


def top_terms(terms: DataFrame, most: int, k: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank) of the ``k`` first terms of each group of ``terms``.

    ``value`` grows with the group's count and falls with the language's, and ties go
    to the earlier term, so a term that k others dominate in all three is not among
    the k first. A group of a language with ``kept`` terms is cut by term into parts of about
    ``BAND_TERMS`` rows, whose skybands are merged, ``MERGED`` at a time; ``most`` is the greatest ``kept``.
    """
    cols = ("lang", "source", "term", "n", "lang_n", "value")
    parts = F.greatest(F.ceil(F.col("kept") / BAND_TERMS), F.lit(1))
    band = _bands(terms.select(*cols, F.pmod(F.xxhash64("term"), parts).alias("salt")), k)
    salts = max(1, -(-most // BAND_TERMS))
    while salts > 1:
        salts = -(-salts // MERGED)
        band = _bands(band.withColumn("salt", F.pmod("salt", F.lit(salts))), k)
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    ranked = band.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
    return ranked.select("lang", "source", F.col("term").alias("item"), "value", "rank")


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def pair_sums(entries: DataFrame, groups: DataFrame, count: int) -> DataFrame:
    """(lang, i, j, value), i < j: what the occurring terms add to the divergence of two sources beyond absent ones.

    Terms are dealt over blocks of about ``UNIT_ROWS`` rows and sources over tiles of
    ``TILE``; a unit has one block and two tiles as a matrix of shares, and gives one
    sum for each pair of its sources.
    """
    blocks = max(1, -(-count // UNIT_ROWS))
    tile = _div(F.col("idx"), F.lit(TILE))
    place = [F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block")]
    rows = entries.select("lang", *place, "tiles", tile.alias("tile"), "idx", "term", "p").unionByName(
        groups.filter("kept > 0").select("lang", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "tiles", tile.alias("tile"),
                                         "idx", F.lit(None).cast("string").alias("term"), F.col("absent").alias("p")))
    dealt = rows.select("lang", "block", "tile", "idx", "term", "p", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)).alias("other"))
    dealt = dealt.select("lang", "block", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "idx", "term", "p")

    def run(own: pa.Table) -> pa.Table:
        idx, p = own["idx"].to_numpy(), own["p"].to_numpy()
        bare = own["term"].is_null().to_numpy()
        ids, first = np.unique(idx[bare], return_index=True)
        absent = p[bare][first]
        coded = own["term"].combine_chunks().dictionary_encode()
        terms, code = coded.dictionary, coded.indices.drop_null().to_numpy()
        shares = np.repeat(absent[:, None], len(terms), axis=1)
        shares[np.searchsorted(ids, idx[~bare]), code] = p[~bare]
        a, b = own["a"][0].as_py(), own["b"][0].as_py()
        i, j, value = [], [], []
        for x in np.flatnonzero(ids // TILE == a):
            right = np.flatnonzero((ids // TILE == b) & (ids > ids[x]))
            i.append(np.full(len(right), ids[x]))
            j.append(ids[right])
            value.append(_f(shares[x], shares[right]).sum(axis=1) - len(terms) * _f(absent[x], absent[right]))
        made = [np.concatenate(v) if v else np.zeros(0, np.int64) for v in (i, j, value)]
        lang = pa.array([own["lang"][0].as_py()] * len(made[0]), pa.string())
        return pa.table([lang, *(pa.array(v.astype(np.int64)) for v in made)], names=["lang", "i", "j", "value"])

    parts = dealt.groupBy("lang", "block", "a", "b").applyInArrow(run, "lang string, i bigint, j bigint, value bigint")
    return parts.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))


def audit(df: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source of each language differs from the others.

    Terms are runs of letters (A-Z lower-cased, every character outside ASCII is a
    letter). A language keeps the terms of at least ``least_docs`` of its documents. The share
    of a term in a group or language is 1 + floor(10**9 (count + 2) / (total + 2 kept)), its
    part of a divergence floor((p - q)**2 / (p + q)). Part ``pair`` has each other source of
    the language with the sum over all kept terms; part ``term`` the ``top`` terms
    whose share in the group is above that in the language.

    Null text, lang and source are ''. A group without kept terms has pairs and no
    terms; a language without kept terms has pairs of value 0; a language of one
    source has no pair; equal rows count as often as they occur; an empty table
    gives no rows. Other columns play no part. Counts go to their groups by term, so
    a hot source or term is summed before it travels; the rest works on written tables.
    """
    docs = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = cut(term_counts(docs), "terms")
    words = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(
        F.col("docs") >= least_docs).select("lang", "term", "lang_n")
    found = cut(counts.join(words, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept")
    drop(df.sparkSession, counts)
    langs = found.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total"))
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "kept", "lang_total")),
        (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("bigint").alias("idx"),
        (F.floor((F.count("*").over(Window.partitionBy("lang")) - 1) / TILE) + 1).alias("tiles"))
    zero = F.lit(0).cast("bigint")
    groups = cut(named.withColumn("absent", F.when(F.col("kept") > 0, share(zero, F.col("total"), F.col("kept")))), "groups")
    entries = found.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
    count = found.count()

    sums = pair_sums(entries, groups, count)
    one = groups.select("lang", "source", "kept", "idx", "absent")
    two = groups.select("lang", F.col("source").alias("item"), F.col("idx").alias("other"), F.col("absent").alias("q"))
    pairs = one.join(two, "lang").filter("idx != other").withColumns({"i": F.least("idx", "other"), "j": F.greatest("idx", "other")})
    pairs = pairs.join(sums, ["lang", "i", "j"], "left").select(
        "lang", "source", "item", F.when(F.col("kept") > 0, F.coalesce("value", zero) + F.col("kept") * divergence(F.col("absent"), F.col("q")))
        .otherwise(zero).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    q = share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    above = entries.withColumn("q", q).filter("p > q").withColumn("value", divergence(F.col("p"), F.col("q")))
    terms = top_terms(above, groups.agg(F.max("kept")).first()[0] or 0, top)
    cols = ("lang", "source", "part", "item", "value", "rank")
    return pairs.withColumn("part", F.lit("pair")).select(*cols).unionByName(terms.withColumn("part", F.lit("term")).select(*cols))
