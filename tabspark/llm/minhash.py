"""Near-duplicate classes: DartMinHash signatures of weighted word shingles, banded joins, exact checks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tabspark.llm.components import connected_components
from tabspark.llm.scratch import cut, drop

#: Words of a shingle and the similarity that links two texts.
SHINGLE, SIMILARITY = 5, 0.8
#: Coordinates of a signature and rows of a band: a pair at 0.8 shares no band once in 2 * 10**7.
COORDINATES, ROWS = 128, 4
#: Members of a block, members above which a bucket is crowded, times a crowded bucket is dealt anew by a further band.
BLOCK, CROWD, DEPTH = 1024, 8192, 2
#: Share of equal coordinates below which a pair is not read: five deviations under 0.8.
LEAST_EQUAL = 0.62
#: Words that one pass over a batch holds, and distinct words a task remembers.
WORDS_AT_ONCE, WORDS_KNOWN = 50_000, 100_000

_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _salt(n: int) -> np.uint64:
    return np.uint64((n * 0xD1B54A32D192ED03 + 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF)


def word_hashes(text: str, known: dict[str, int]) -> np.ndarray:
    words = text.lower().split()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of each window of ``size`` words; a shorter text is one window of what it has."""
    n = min(size, len(hashes))
    if not n:
        return hashes
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * _P + hashes[k:len(hashes) - n + 1 + k]
    return _mix(out ^ _salt(n))


def darts(element: np.ndarray, weight: np.ndarray, doc: np.ndarray, docs: int, t: int = COORDINATES) -> np.ndarray:
    """Signatures (docs x t, uint64) of weighted sets; ``doc`` numbers the set of each element, each at least one.

    Over each element stands a plane of weight and rank on which darts fall at
    random, one on average per unit of area, the same for every set: the hash of
    element, strip and dart number fixes them. Strips of weight are [0, 1), [1, 2),
    [2, 4) and so on, and within a strip darts come in order of rank. A set sees the
    darts under its weights and under a rank that lets about t (ln t + 2) of them in,
    so work follows t log t and not weight times t. A dart belongs to one coordinate,
    which keeps its earliest; sets with an empty coordinate look twice as far. Two
    sets agree in a coordinate with the probability of their weighted Jaccard
    similarity.
    """
    out = np.zeros((docs, t), np.uint64)
    total = np.bincount(doc, weights=weight, minlength=docs)
    limit = t * (np.log(t) + 2.0) / np.maximum(total, 1e-300)
    open_docs = np.ones(docs, bool)
    while open_docs.any():
        mine = open_docs[doc]
        e, w, d = element[mine], weight[mine], doc[mine]
        best = np.full(docs * t, np.inf)
        thrown = []
        strip, low, width = 0, 0.0, 1.0
        top = w.max(initial=0.0)
        while low < top:
            tall = w > low
            se, sw, sd = e[tall], w[tall], d[tall]
            rank, number = np.zeros(len(se)), 0
            while len(se):
                h = _mix(se + _salt(strip * 1_000_003 + number))
                u = ((h >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53
                rank = rank - np.log(u) / width
                near = rank <= limit[sd]
                se, sw, sd, rank, h = se[near], sw[near], sd[near], rank[near], h[near]
                if len(se):
                    g = _mix(h + _P)
                    place = low + width * ((g >> np.uint64(11)).astype(np.float64) * 2.0**-53)
                    hit = place < sw
                    cell = sd[hit] * t + (_mix(g + _P)[hit] % np.uint64(t)).astype(np.int64)
                    np.minimum.at(best, cell, rank[hit])
                    thrown.append((cell, rank[hit], g[hit]))
                number += 1
            strip, low, width = strip + 1, low + width, (1.0 if strip == 0 else width * 2)
        filled = np.isfinite(best).reshape(docs, t).all(axis=1)
        flat = out.reshape(-1)
        for cell, rank, g in thrown:
            first = (best[cell] == rank) & open_docs[cell // t]
            flat[cell[first]] = g[first]
        open_docs &= ~filled
        limit = np.where(open_docs, limit * 2, limit)
    return out


def _signatures(texts: list[str], known: dict[str, int]) -> tuple[list[int], np.ndarray]:
    """(shingles of each text, signatures; a text without words has a row of zeros)."""
    own = [shingles(word_hashes(t, known)) for t in texts]
    sizes = [len(s) for s in own]
    full = np.flatnonzero(sizes)
    signs = np.zeros((len(texts), COORDINATES), np.uint64)
    if len(full):
        doc = np.repeat(np.arange(len(full)), [sizes[i] for i in full])
        element = np.concatenate([own[i] for i in full])
        order = np.lexsort((element, doc))
        element, doc = element[order], doc[order]
        new = np.flatnonzero(np.concatenate(([True], (element[1:] != element[:-1]) | (doc[1:] != doc[:-1]))))
        weight = np.diff(np.concatenate((new, [len(element)]))).astype(np.float64)
        signs[full] = darts(element[new], weight, doc[new], len(full))
    return sizes, signs


def _bands(signs: np.ndarray, rows: int = ROWS) -> np.ndarray:
    grouped = signs.reshape(len(signs), -1, rows)
    out = np.zeros(grouped.shape[:2], np.uint64)
    with np.errstate(over="ignore"):
        for k in range(rows):
            out = _mix(out * _P + grouped[:, :, k])
        out = _mix(out + np.arange(out.shape[1], dtype=np.uint64) * _P)
    return out.view(np.int64)


def signed(text: Column) -> Column:
    """``struct<n, bands, sign>``: shingles, 32 band keys, and a byte of each coordinate."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, int] = {}
        for batch in batches:
            sizes, bands, signs, part, words = [], [], [], [], 0

            def flush():
                n, s = _signatures(part, known)
                sizes.extend(n)
                bands.append(_bands(s))
                signs.extend(r.tobytes() for r in (s & np.uint64(0xFF)).astype(np.uint8))

            for cell in batch:
                part.append(cell.as_py() or "")
                words += len(part[-1]) // 6
                if words >= WORDS_AT_ONCE:
                    flush()
                    part, words = [], 0
                    if len(known) > WORDS_KNOWN:
                        known.clear()
            if part:
                flush()
            keys = np.concatenate(bands) if bands else np.zeros((0, COORDINATES // ROWS), np.int64)
            ends = np.arange(len(keys) + 1, dtype=np.int32) * keys.shape[1]
            yield pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel())),
                                              pa.array(signs, pa.binary())], names=["n", "bands", "sign"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "struct<n:bigint,bands:array<bigint>,sign:binary>")(text)


def _equal_share(a: Column, b: Column) -> Column:
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([float(np.mean(np.frombuffer(p, np.uint8) == np.frombuffer(q, np.uint8)))
                         for p, q in zip(x.to_pylist(), y.to_pylist())], pa.float64())

    run.__annotations__ = {"x": pa.Array, "y": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "double")(a, b)


def word_counts(text: str, size: int = SHINGLE) -> Counter:
    words = text.lower().split()
    n = min(size, len(words))
    return Counter(zip(*(words[k:] for k in range(n)))) if n else Counter()


def weighted_jaccard(a: Counter, b: Counter) -> float:
    if len(b) < len(a):
        a, b = b, a
    low = sum(min(c, b[s]) for s, c in a.items() if s in b)
    high = a.total() + b.total() - low
    return low / high if high else 0.0


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of (shingle, number of its place): plain sets that are as similar as the weighted ones."""
    own = np.sort(shingles(hashes))
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else own.astype(np.int64)
    number = np.arange(len(own)) - np.repeat(first, np.diff(np.concatenate((first, [len(own)]))))
    with np.errstate(over="ignore"):
        return np.unique(np.where(number > 0, _mix(own + number.astype(np.uint64) * _P), own))


def whole_set(text: Column) -> Column:
    """The :func:`shingle_set` of a whole text, as bytes."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, int] = {}
        for batch in batches:
            out = []
            for cell in batch:
                out.append(shingle_set(word_hashes(cell.as_py() or "", known)).tobytes())
                if len(known) > WORDS_KNOWN:
                    known.clear()
            yield pa.array(out, pa.binary())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "binary")(text)


def set_similarity(p: np.ndarray, q: np.ndarray) -> float:
    both = np.sort(np.concatenate((p, q)))
    equal = int(np.count_nonzero(both[1:] == both[:-1]))
    return equal / (len(both) - equal) if len(both) else 0.0


def similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of two shingle sets given as bytes."""
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([set_similarity(np.frombuffer(p.as_py(), np.uint64), np.frombuffer(q.as_py(), np.uint64))
                         for p, q in zip(x, y)], pa.float64())

    run.__annotations__ = {"x": pa.Array, "y": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "double")(a, b)


def links_within(nodes: list[int], sides: list[int], labels: list[int], n: list[int], signs: np.ndarray,
                 sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Links that join the labels of one block, or of two blocks whose members have different sides.

    Every pair of members that is not joined yet is looked at: by size, by the
    signature, and by the whole sets; a pair already joined by others is not.
    """
    index = {x: i for i, x in enumerate(dict.fromkeys(labels))}
    root = np.array([index[x] for x in labels])
    sizes, side = np.array(n, np.float64), np.array(sides)
    two, out = len(set(sides)) > 1, []
    for i in range(len(nodes) - 1):
        open_ = root[i + 1:] != root[i]
        open_ &= np.minimum(sizes[i + 1:], sizes[i]) >= least * np.maximum(sizes[i + 1:], sizes[i])
        if two:
            open_ &= side[i + 1:] != side[i]
        rest = np.flatnonzero(open_) + i + 1
        if len(rest):
            rest = rest[(signs[rest] == signs[i]).mean(axis=1) >= LEAST_EQUAL]
        for j in rest:
            if root[i] != root[j] and set_similarity(sets[i], sets[j]) >= least:
                out.append((nodes[i], nodes[j]))
                root[root == root[j]] = root[i]
    return out


def links_in_blocks(members: DataFrame, nodes: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b) links between the labels of each bucket in ``members`` (key, node, label, size).

    A bucket is cut into blocks of about ``BLOCK`` members; each pair of blocks is
    one unit of work that gives no more links than it has members.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = members.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int")).select(
        "key", "node", "label", "own", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = dealt.select("node", "label", "own", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("unit"))
    full = dealt.join(nodes.select("node", "n", "sign"), "node").join(sets.select("node", F.col("own").alias("shingles")), "node")
    full = full.repartition("unit").sortWithinPartitions("unit", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, []

        def done():
            own = links_within([r["node"] for r in rows], [r["own"] for r in rows], [r["label"] for r in rows], [r["n"] for r in rows],
                               np.array([np.frombuffer(r["sign"], np.uint8) for r in rows]),
                               [np.frombuffer(r["shingles"], np.uint64) for r in rows], least)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in own], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                if row["unit"] != unit and rows:
                    yield done()
                    rows = []
                unit = row["unit"]
                rows.append(row)
        if rows:
            yield done()

    return full.mapInArrow(run, "a bigint, b bigint")


class _Linker:
    """Checks pairs of nodes and keeps what they are linked to."""

    def __init__(self, nodes: DataFrame, sets: DataFrame, least: float):
        self.nodes, self.sets, self.least = nodes, sets, least
        self.labels: DataFrame | None = None  # node, component of linked nodes

    def labelled(self, df: DataFrame) -> DataFrame:
        if self.labels is None:
            return df.withColumn("label", F.col("node"))
        return df.join(self.labels, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")

    def check(self, pairs: DataFrame) -> None:
        """Read pairs (a, b) whose signatures are near enough, keep those that are similar, and merge."""
        sign = self.nodes.select("node", "n", "sign")
        near = pairs.join(sign.toDF("a", "na", "sa"), "a").join(sign.toDF("b", "nb", "sb"), "b").filter(
            F.least("na", "nb") >= F.greatest("na", "nb") * self.least)  # sizes alone rule the others out
        near = cut(near.filter(_equal_share(F.col("sa"), F.col("sb")) >= LEAST_EQUAL).select("a", "b"), "near")
        both = near.join(self.sets.toDF("a", "ta"), "a").join(self.sets.toDF("b", "tb"), "b")
        self.merge(both.filter(similarity(F.col("ta"), F.col("tb")) >= self.least).select("a", "b"))
        drop(near.sparkSession, near)

    def merge(self, found: DataFrame) -> None:
        """Take in links (a, b). What is linked already takes part as its component, so the work follows the new links."""
        if self.labels is not None:
            ends = self.labels.select("node", "component")
            found = (found.join(ends.toDF("a", "ca"), "a", "left").join(ends.toDF("b", "cb"), "b", "left")
                     .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
        merged = cut(connected_components(found, "a", "b").select("node", "component"), "merged")
        if self.labels is None:
            self.labels = merged
        elif not merged.isEmpty():
            moved = merged.toDF("component", "to")
            old = self.labels.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
            new = merged.join(self.labels.select("node"), "node", "left_anti")
            self.labels = cut(old.unionByName(new), "labels")


def _open_buckets(members: DataFrame) -> DataFrame:
    """Members (key, node, label, size) of buckets that hold more than one label."""
    state = members.groupBy("key").agg(F.count("*").alias("size"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    return members.join(state.filter("lo < hi").select("key", "size"), "key")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row per row of ``df``: key, digest of the text, class_id, class_size, and whether it is the one that stays.

    Texts with a weighted Jaccard similarity of five-word shingles (lower case,
    white space between words, weight the number of places) of ``least`` or more are
    linked, and a class is what links join; class_id is its smallest key.

    Exact copies collapse first, by digest, so a class of copies is one node.
    DartMinHash signatures are cut into bands; texts sharing a band are candidates.
    In every bucket each member is first paired with the smallest one, which links a
    group of copies by a star and not by all its pairs. Buckets that then still hold
    several components are compared in blocks: a task has two blocks of a bucket, looks
    at the pairs that are not joined yet, and gives at most one link per member. A
    bucket of more than ``CROWD`` members is first dealt anew by a further band,
    ``DEPTH`` times at most, so a member meets a bounded number of others, and after
    that at any size. So a pair whose common bands are all crowded is met only if it has
    two of them, or three where the finer buckets are crowded too: at similarity 0.8
    it is missed with a probability of 1.1e-6, or 1.2e-5. No other candidate is dropped
    (a star may still join such a pair). What decides is the similarity of the
    two whole shingle sets (64-bit hashes of the words; a collision of two shingles
    moves it by one place).

    A text without words (null too) is in no link: a class by itself with its exact
    copies; null texts are one class each. Texts under five words have one shingle.
    A null key sorts first; equal rows are one class, of which one stays. Signatures,
    shingle sets, links and labels are written tables, so a lost executor repeats
    tasks and not the job.
    """
    spark = df.sparkSession
    docs = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    digest = F.coalesce(F.md5("text"), F.lit("-"))
    made = cut(docs.select("doc_id", digest.alias("digest"), signed(F.col("text")).alias("s")).select("doc_id", "digest", "s.*"), "signed")
    reps = made.filter("n > 0").groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("low"), F.first("n").alias("n"),
        F.first("bands").alias("bands"), F.first("sign").alias("sign"))
    nodes = cut(reps.select(F.monotonically_increasing_id().alias("node"), "digest", F.col("low.doc_id").alias("doc_id"), "n", "bands", "sign"), "nodes")
    bands = nodes.select("node", F.posexplode("bands").alias("at", "key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("leader")).filter("n > 1").select("key", "leader")
    members = cut(bands.join(shared, "key"), "buckets")
    wanted = members.select("node").distinct().join(nodes.select("node", "digest", F.col("doc_id").alias("first_id")), "node")
    whole = docs.filter(F.col("text").isNotNull()).withColumn("digest", digest).join(wanted, "digest").filter(
        F.col("doc_id").eqNullSafe(F.col("first_id")))
    sets = cut(whole.groupBy("node").agg(F.first("text").alias("text")).select("node", whole_set(F.col("text")).alias("own")), "sets")
    linker = _Linker(nodes, sets, least)
    linker.check(members.filter("leader < node").groupBy("node").agg(F.min("leader").alias("b")).select(F.col("node").alias("a"), "b"))
    level = members.select("key", "node", "at")
    for depth in range(DEPTH + 1):
        rest = cut(_open_buckets(linker.labelled(level)), "open")
        sizes = rest.agg(F.count("*"), F.max("size")).first()
        if not sizes[0]:
            break
        last = depth == DEPTH or sizes[1] <= CROWD
        found = links_in_blocks(rest if last else rest.filter(F.col("size") <= CROWD), nodes, sets, least)
        linker.merge(found)
        if last:
            break
        crowded = rest.filter(F.col("size") > CROWD)
        low = crowded.groupBy("key").agg(F.min(F.struct("node", "label")).alias("low"))
        linker.check(crowded.join(low, "key").filter(F.col("label") != F.col("low.label")).select(
            F.col("node").alias("a"), F.col("low.node").alias("b")).distinct())
        crowded = _open_buckets(linker.labelled(crowded.select("key", "node", "at")))
        # later bands only: a pair that shares bands i < j < k is met at i, at (i, j) and at (i, j, k)
        finer = crowded.select("key", "node", F.col("at").alias("from")).join(nodes.select("node", "bands"), "node").select(
            "node", "from", "key", F.posexplode("bands").alias("at", "band")).filter(F.col("at") > F.col("from"))
        finer = cut(finer.select("node", "at", F.xxhash64("key", "band").alias("key")), "finer")
        many = finer.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
        level = finer.join(many, "key")
    classes = nodes.select("node", "digest", "doc_id")
    if linker.labels is not None:
        classes = classes.join(linker.labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    else:
        classes = classes.withColumn("component", F.col("node"))
    copies = made.groupBy("digest").agg(F.count("*").alias("copies"))
    classes = classes.join(copies, "digest")
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "digest")
    groups = classes.groupBy("component").agg(F.min(order).alias("first"), F.sum("copies").alias("class_size"))
    joined = classes.join(groups, "component").select("digest", F.col("first.doc_id").alias("class_id"),
                                                      F.col("first.digest").alias("first_digest"), "class_size")
    # texts without words: exact copies are a class, null texts stand alone
    bare = made.filter("n = 0 and digest != '-'").groupBy("digest").agg(F.min(F.struct(
        F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("low"), F.count("*").alias("class_size")).select(
        "digest", F.col("low.doc_id").alias("class_id"), F.col("digest").alias("first_digest"), "class_size")
    out = made.select("doc_id", "digest").join(joined.unionByName(bare), "digest", "left")
    alone = F.col("digest") == "-"
    return out.select(
        "doc_id", "digest", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("bigint").alias("class_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("first_digest")))).alias("kept"))


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``df`` with one row of each near-duplicate class: the smallest key. Of equal rows one stays.

    The rows that go are looked up by key and digest; other columns play no part.
    """
    found = cut(near_duplicates(df, key, text, least), "classes")
    # numbered names meet no name of the lists
    own = df.select(*(F.col(f"`{c}`").alias(f"d{i}") for i, c in enumerate(df.columns)), F.col(f"`{key}`").alias("own_id"),
                    F.coalesce(F.md5(F.col(f"`{text}`")), F.lit("-")).alias("own_digest"))
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest"))
    left = own.join(gone.distinct(), F.col("own_id").eqNullSafe(F.col("gone_id")) & (F.col("own_digest") == F.col("gone_digest")), "left_anti")
    # repeated rows share key and digest with the one that stays
    repeated = found.filter(F.col("kept") & (F.col("class_size") > 1)).groupBy("doc_id", "digest").count().filter("count > 1")
    if not repeated.isEmpty():
        twice = repeated.select(F.col("doc_id").alias("again_id"), F.col("digest").alias("again_digest"))
        match = F.col("own_id").eqNullSafe(F.col("again_id")) & (F.col("own_digest") == F.col("again_digest"))
        once = left.join(twice, match, "left_semi").dropDuplicates(["own_id", "own_digest"])
        left = left.join(twice, match, "left_anti").unionByName(once)
    return left.select(*(F.col(f"d{i}").alias(c) for i, c in enumerate(df.columns)))
