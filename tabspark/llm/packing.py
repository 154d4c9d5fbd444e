"""Best-fit packing of documents into fixed windows under conflicts."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

#: Tokens a bin holds; documents of one source it may hold; rows one task packs together.
CAPACITY, PER_SOURCE, ROWS_PER_SHARD = 2048, 2, 4096
#: Equal rows that are dealt to a shard together.
COPIES = 64

PIECES = "piece bigint, start bigint, n_tokens bigint, bin_id string, slot bigint, bin_fill bigint"
NAMES = ["doc_id", "piece", "start", "n_tokens", "bin_id", "slot", "bin_fill"]


def best_fit(items: list[tuple[int, object, object]], capacity: int, per_source: int) -> list[int]:
    """Bin numbers of (length, source, cluster) items taken in the given order.

    Open bins stand in one list ordered by (room left, bin). The search starts at
    the successor of the item's length and goes on until the first, that is
    tightest, bin whose bitmaps let the item in. A bin has one bitmap of its
    clusters and ``per_source`` bitmaps of its sources, one per repetition; null
    sources and clusters never conflict.
    """
    sources = {s: 1 << i for i, s in enumerate(dict.fromkeys(s for _, s, _ in items if s is not None))}
    many = Counter(c for _, _, c in items if c is not None)
    clusters = {c: 1 << i for i, c in enumerate(c for c, n in many.items() if n > 1)}
    room: list[tuple[int, int]] = []
    full: list[list[int]] = []
    held: list[int] = []
    out = []
    for length, source, cluster in items:
        s, c = sources.get(source, 0), clusters.get(cluster, 0)
        at = bisect_left(room, (length, -1))
        while at < len(room) and (held[room[at][1]] & c or full[room[at][1]][-1] & s):
            at += 1
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = capacity, len(held)
            held.append(0)
            full.append([0] * per_source)
        held[b] |= c
        for k in range(per_source):
            if not full[b][k] & s:
                full[b][k] |= s
                break
        if left > length:
            insort(room, (left - length, b))
        out.append(b)
    return out


def pack(df: DataFrame, key: str = "doc_id", length: Column | None = None, source: Column | None = None,
         cluster: Column | None = None, capacity: int = CAPACITY, per_source: int = PER_SOURCE,
         rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """One row per piece of every document, with the bin that holds it.

    A document longer than ``capacity`` gives whole pieces, each a bin of its own,
    and a rest; rests are packed longest first. A bin never holds two documents of
    one duplicate cluster, nor more than ``per_source`` documents of one source.
    Defaults: words as length, the ``source`` column, and the text without case and
    spaces as cluster (64-bit hash: a collision costs at most one placement). Near copies
    are no cluster by default; pass their class as ``cluster``.

    Rows are dealt over shards of about ``rows_per_shard`` rows by a hash of key and
    text, equal rows counted first and dealt ``COPIES`` at a time, so neither a hot
    source nor a hot key gathers in a task, and only ids, lengths, hashes and counts
    are shuffled. A shard leaves a few bins part-filled, well
    under one in a hundred. Nulls: a null text has no tokens, a null source no
    conflict, a null key is packed like others; keys may be numbers, texts, dates or times. A row without tokens keeps one row
    with piece 0 and no bin. Equal rows are packed one by one. Same input, same bins.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    length = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")) if length is None else length
    source = F.col("source") if source is None else source
    cluster = F.xxhash64(F.translate(F.lower(text), " \t\n\r", "")) if cluster is None else cluster
    shards = max(1, -(-df.count() // rows_per_shard))
    rows = df.select(F.col(key).alias("doc_id"), F.coalesce(length.cast("bigint"), F.lit(0)).alias("length"),
                     F.xxhash64(source, F.lit(1)).alias("hash"), source.isNotNull().alias("known"),
                     cluster.alias("cluster"), F.xxhash64(F.col(key), text).alias("row"))
    light = rows.columns
    together = min(COPIES, rows_per_shard)
    rows = rows.groupBy(*light).agg(F.count("*").alias("n")).select(
        *light, "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / together))).alias("chunk"))
    # rows that differ in source, length or cluster alone spread too
    rows = rows.select(*(c for c in light if c != "row"), F.least(F.lit(together), F.col("n") - F.col("chunk") * together).alias("copies"),
                       F.pmod(F.xxhash64("row", "hash", "known", "length", "cluster", "chunk"), F.lit(shards)).alias("shard"))

    def shard(batch: pa.Table) -> pa.Table:
        batch = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), batch["copies"].to_numpy())))
        batch = batch.take(pc.sort_indices(batch, sort_keys=[("length", "descending"), *((c, "ascending") for c in ("doc_id", "cluster", "hash"))],
                                           null_placement="at_start"))
        lengths = batch["length"].to_pylist()
        rests = [(n % capacity, i) for i, n in enumerate(lengths) if n % capacity]
        rests.sort(key=lambda x: (-x[0], x[1]))
        known, hashes, groups = (batch[c].to_pylist() for c in ("known", "hash", "cluster"))
        bins = best_fit([(n, hashes[i] if known[i] else None, groups[i]) for n, i in rests], capacity, per_source)
        name, fill, slot = batch["shard"][0].as_py(), Counter(), Counter()
        for (n, _), b in zip(rests, bins):
            fill[b] += n
        rows, whole = [], max(bins, default=-1) + 1
        for i, n in enumerate(lengths):
            for p in range(n // capacity):
                rows.append((i, p, p * capacity, capacity, f"{name}-{whole}", 0, capacity))
                whole += 1
            if not n:
                rows.append((i, 0, 0, 0, None, None, None))
        for (n, i), b in zip(rests, bins):
            whole_pieces = lengths[i] // capacity
            rows.append((i, whole_pieces, whole_pieces * capacity, n, f"{name}-{b}", slot[b], fill[b]))
            slot[b] += 1
        who, *columns = zip(*rows)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        # keys stay Arrow values: no number passes through a double
        return pa.table([batch["doc_id"].take(pa.array(who)), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=NAMES)

    schema = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), *StructType.fromDDL(PIECES)])
    return rows.groupBy("shard").applyInArrow(shard, schema)
