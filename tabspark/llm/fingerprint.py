"""Lempel-Ziv phrase fingerprints: texts that a dictionary coder would parse alike look alike."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

#: Coordinates of a fingerprint, hex digits of each, rows that one task handles in order.
COORDINATES, DIGITS, ROWS_PER_RANGE = 64, 4, 8192
#: Ranges at most, so that their bounds stay below 10 MB; beyond that a range has more rows, which are read in order.
MAX_RANGES = 65_536

RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
NAMES = [c.split()[0] for c in RESULT.split(", ")]
EMPTY = "-" * COORDINATES * DIGITS


def parse(text: str, seen: set[str], out: list[str], ends: list[int], at: int = 0) -> None:
    """LZ78: append each new phrase of text[at:] and the place where it ends; ``seen`` is the dictionary so far."""
    phrase = ""
    for i, c in enumerate(text[at:] if at else text, at + 1):
        phrase += c
        if phrase not in seen:
            seen.add(phrase)
            out.append(phrase)
            ends.append(i)
            phrase = ""


def digest(phrases: list[str]) -> np.ndarray:
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(p) for p in phrases), np.uint64, len(phrases))


def signature(hashes: np.ndarray) -> str:
    """One-permutation minimum hashes of the phrase set; an empty coordinate borrows from the next filled one."""
    if not len(hashes):
        return EMPTY
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    low = np.full(COORDINATES, none)
    np.minimum.at(low, (hashes % np.uint64(COORDINATES)).astype(np.int64), hashes // np.uint64(COORDINATES))
    filled = np.flatnonzero(low != none)
    source = filled[np.searchsorted(filled, np.arange(COORDINATES)) % len(filled)]
    steps = (source - np.arange(COORDINATES)) % COORDINATES
    mixed = (low[source] + steps.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xFF51AFD7ED558CCD)
    return (mixed >> np.uint64(48)).astype(">u2").tobytes().hex()


def fingerprint(text: str) -> str:
    phrases: list[str] = []
    parse(text, set(), phrases, [])
    return signature(digest(phrases))


def likeness(a: str, b: str) -> float:
    """Share of equal coordinates; two texts without phrases are alike, one without is like no other."""
    if EMPTY in (a, b):
        return float(a == b)
    return sum(a[i:i + DIGITS] == b[i:i + DIGITS] for i in range(0, len(a), DIGITS)) / COORDINATES


def with_edit(text: str, after: str) -> tuple[str, str, str]:
    """(edited text, fingerprint, fingerprint of the edited text).

    The edited text keeps the first two thirds, so its parse starts as that of the
    text: phrases that end before the cut are taken over.
    """
    third = len(text) // 3
    cut = len(text) - third
    edited = text[:cut] + after[:third]
    phrases: list[str] = []
    ends: list[int] = []
    parse(text, set(), phrases, ends)
    hashes = digest(phrases)
    same = int(np.searchsorted(ends, cut, side="right"))
    more: list[str] = []
    parse(edited, set(phrases[:same]), more, [], ends[same - 1] if same else 0)
    return edited, signature(hashes), signature(np.concatenate((hashes[:same], digest(more))))


def against_next(df: DataFrame, key: str = "doc_id", text: str = "text", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Every row with its fingerprint, that of its edited text, and their likeness to it and to the next row.

    The next row is the following one by descending key, ties by the hash of the
    text, null keys last, and the first after the last. Keys and hashes alone are
    sorted first to find ranges of about ``rows_per_range`` rows; a hot key is cut
    by its hashes. Each range is then read in order by one task, together with one
    copy of the head of the range below, so a text moves once and no task needs
    another's. Null is an empty text; empty texts have a fingerprint of dashes. A
    table of one row is its own successor, an empty table gives an empty result.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("bigint").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.withColumn("h", F.xxhash64("t"))
    ids = rows.select("k", "h")
    n = min(MAX_RANGES, max(1, -(-ids.count() // rows_per_range)))
    order = [F.desc_nulls_last("k"), F.asc("h")]
    # the first row of every range, one line a range
    heads = (ids.repartitionByRange(n, *order).withColumn("p", F.spark_partition_id())
             .groupBy("p").agg(F.min(F.struct(F.col("k").isNull().alias("last"), (-F.coalesce("k", F.lit(0)).cast("decimal(20,0)")).alias("down"), "h")).alias("low"))
             .select("p", "low.*").collect())
    bounds = sorted((bool(r["last"]), int(r["down"]), r["h"]) for r in heads)
    state = spark.sparkContext.broadcast(bounds)

    def ranges(keys: pa.Array, hashes: pa.Array) -> pa.Array:
        from bisect import bisect_right

        low, out = state.value, []
        for k, h in zip(keys.to_pylist(), hashes.to_pylist()):
            place = (k is None, -(k or 0), h)
            p = max(0, bisect_right(low, place) - 1)
            out.append([p, (p - 1) % len(low)] if place == low[p] else [p])
        return pa.array(out, pa.list_(pa.int32()))

    ranges.__annotations__ = {"keys": pa.Array, "hashes": pa.Array, "return": pa.Array}
    # a copy of a head for the range above says so; several rows equal to a head give equal copies
    dealt = rows.select("k", "h", "t", F.posexplode(F.arrow_udf(ranges, "array<int>")("k", "h")).alias("copy", "p"))
    dealt = dealt.repartitionById(n, "p").sortWithinPartitions("p", "copy", *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cells():
            for b in batches:
                cols = [b.column(c) for c in ("p", "copy", "k", "t")]
                for i in range(b.num_rows):
                    yield [c[i].as_py() for c in cols]

        out, held, size = [], None, 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(c)) if i else pa.array(list(c), pa.int64())
                                               for i, c in enumerate(zip(*out))], names=NAMES)

        def finish(row, after_text):
            edited, own, other = with_edit(row[3], after_text)
            return [row[2], len(row[3]), sha256(edited.encode()).hexdigest(), own, other, likeness(own, other), None]

        open_row = None  # judged but for its likeness to the next
        last_p = None
        for row in cells():
            if row[0] != last_p:
                last_p, held, open_row = row[0], None, None
            if held is not None:
                done = finish(held, row[3])
                if open_row is not None:
                    open_row[-1] = likeness(open_row[3], done[3])
                    out.append(open_row)
                open_row, size = done, size + len(row[3])
            if row[1]:  # the head of the next range ends this one
                if open_row is not None:
                    open_row[-1] = likeness(open_row[3], fingerprint(row[3]))
                    out.append(open_row)
                open_row = held = None
            else:
                held = row
            if len(out) >= 1000:
                yield flush()
                out = []
        if out:
            yield flush()

    return dealt.drop("h").mapInArrow(run, RESULT)
