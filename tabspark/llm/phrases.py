"""Collocations by dynamic itemset counting over cyclic scans of shards."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabspark.llm.scratch import cut, drop
from tabspark.sources.io import scratch_dir

#: Words of the longest phrase, least places of a candidate, ranks per language, share in a hundred at which a longer one covers.
LONGEST, LEAST, RANKS, COVERED = 5, 100, 2000, 100
#: Shards of a cycle, slots of the table of steps (bytes), distinct words a task remembers.
SHARDS, SLOTS, WORDS_KNOWN = 3, 1 << 23, 300_000
UNSET = 255
#: Tokens that are counted together.
TOKENS_AT_ONCE = 500_000
#: Slots of one row when reached slots go to the driver.
SLOT_ROW = 1 << 16

#: A-Z lower-cased; every character that ends a piece becomes a line feed.
FOLDED = bytes(10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_P = np.uint64(0x9E3779B97F4A7C15)
COUNTED = "lang string, words binary, start int, n bigint"
COUNTED_COLUMNS = ("lang", "words", "start", "n")


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


def _first(words: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """Keys of single words of languages with these salts; a slot is the low bits of a key."""
    return _mix(_mix(words) ^ salts)


def _longer(key: np.ndarray, word: np.ndarray, k: int) -> np.ndarray:
    """Keys of phrases of ``k`` words with one more word."""
    with np.errstate(over="ignore"):
        return _mix(key * _P + word + np.uint64(k))


def _salts(langs) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(x) for x in langs], np.uint64)


class _Words(dict):
    """Word to a hash other than 0; new words are noted."""

    def __init__(self, seed: int):
        self.seed, self.new = seed, []

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word, self.seed) or 1
        self[word] = h
        self.new.append(word)
        return h


def encode(docs: DataFrame, seed: int, shards: int = SHARDS) -> DataFrame:
    """Every text as hashes of its words with a 0 between pieces, and (shard -1) the words behind the hashes."""
    schema = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("tokens", pa.binary()), ("n_words", pa.int64()),
                        ("hash", pa.int64()), ("word", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words(seed)
        for batch in batches:
            data, n = [], []
            for cell in batch.column(2):
                ids: list[int] = []
                for piece in cell.as_py().translate(FOLDED).split(b"\n"):
                    if words := piece.split():
                        ids.extend(map(known.__getitem__, words))
                        ids.append(0)
                data.append(np.array(ids, np.uint64).tobytes())
                n.append(len(ids) - ids.count(0))
            k, new = len(data), known.new
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary()), pa.array(n, pa.int64()),
                                              pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary())], schema=schema)
            hashes = np.array([known[w] for w in new], np.uint64).view(np.int64)
            k = len(new)
            yield pa.RecordBatch.from_arrays([pa.array([-1] * k, pa.int32()), pa.nulls(k, pa.string()), pa.nulls(k, pa.binary()),
                                              pa.nulls(k, pa.int64()), pa.array(hashes), pa.array(new, pa.binary())], schema=schema)
            known.new = []
            if len(known) > WORDS_KNOWN:
                known.clear()

    dealt = docs.select(F.pmod(F.xxhash64("text", "lang"), F.lit(shards)).cast("int").alias("shard"), "lang", F.col("text").cast("binary").alias("text"))
    return dealt.mapInArrow(run, "shard int, lang string, tokens binary, n_words bigint, hash bigint, word binary")


def count_batch(tokens: np.ndarray, salts: np.ndarray, steps: np.ndarray, step: int, shards: int, longest: int):
    """(length, first place of a phrase, start, count) of the active phrases of a stretch of tokens.

    ``steps`` has, by slot of a phrase's hash, the step from which the phrase counts
    as frequent. A word is active from step 0, a longer phrase from the later of the steps
    of its two parts without the last and the first word, and each for ``shards`` steps.
    """
    key = _first(tokens, salts)
    at = np.flatnonzero(tokens)
    start = np.zeros(len(at), np.int64)
    for k in range(1, longest + 1):
        slot = (key[at] & np.uint64(len(steps) - 1)).astype(np.int64)
        active = (start <= step) & (step < start + shards)
        if active.any():
            places, own = at[active], key[at[active]]
            _, first, inverse, n = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
            alike = places[first][inverse]  # equal hashes must be equal words of one language
            if (salts[places] != salts[alike]).any() or any((tokens[places + w] != tokens[alike + w]).any() for w in range(k)):
                raise ValueError("two phrases of a batch share a hash")
            yield k, places[first], start[active][first], n
        reached = np.full(len(tokens) + 1, UNSET, np.uint8)
        # a phrase in the slot of an earlier one is reached when its parts are, not before
        reached[at] = np.maximum(steps[slot], start)
        if k == longest:
            break
        # both parts frequent: the next word belongs to the same piece, or it would not be in the list
        both = at[(reached[at] != UNSET) & (reached[at + 1] != UNSET)]
        longer = _longer(key[both], tokens[both + k], k)
        start = np.maximum(reached[both], reached[both + 1]).astype(np.int64)
        key[both] = longer
        at = both


def count_step(shard: DataFrame, table, step: int, shards: int, longest: int) -> DataFrame:
    """Counts of the active phrases in one shard; a phrase is the bytes of its word hashes."""
    schema = pa.schema([("lang", pa.string()), ("words", pa.binary()), ("start", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = np.frombuffer(table.value, np.uint8)

        def counted(langs: list[str], parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            number = {x: i for i, x in enumerate(dict.fromkeys(langs))}
            lang = np.repeat(np.array([number[x] for x in langs], np.int32), [len(p) for p in parts])
            salts = _salts(number)
            names, tokens = pa.array(list(number), pa.string()), np.concatenate(parts)
            for k, place, start, n in count_batch(tokens, salts[lang], steps, step, shards, longest):
                words = np.stack([tokens[place + i] for i in range(k)], axis=1).tobytes()
                yield pa.RecordBatch.from_arrays([
                    names.take(pa.array(lang[place])), pa.array([words[i:i + 8 * k] for i in range(0, len(words), 8 * k)], pa.binary()),
                    pa.array(start.astype(np.int32)), pa.array(n.astype(np.int64))], schema=schema)

        for batch in batches:
            langs, parts, held = [], [], 0
            for lang, cell in zip(batch.column(0), batch.column(1)):
                langs.append(lang.as_py())
                parts.append(np.frombuffer(cell.as_py(), np.uint64))
                held += len(parts[-1])
                if held >= TOKENS_AT_ONCE:
                    yield from counted(langs, parts)
                    langs, parts, held = [], [], 0
            if held:
                yield from counted(langs, parts)

    return shard.select("lang", "tokens").mapInArrow(run, COUNTED)


def reached_slots(phrases: DataFrame, slots: int) -> np.ndarray:
    """Slots of ``phrases``, gathered as bitmaps of at most ``slots`` bits in all."""
    row = min(SLOT_ROW, slots)

    def slot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            salts = _salts(names.dictionary.to_pylist())[names.indices.to_numpy()]
            words = batch.column(1).to_pylist()
            size = np.array([len(w) // 8 for w in words])
            out = np.zeros(len(words), np.uint64)
            for k in np.unique(size).tolist():
                own = np.flatnonzero(size == k)
                tokens = np.frombuffer(b"".join(words[i] for i in own), np.uint64).reshape(-1, k)
                key = _first(tokens[:, 0], salts[own])
                for i in range(1, k):
                    key = _longer(key, tokens[:, i], i)
                out[own] = key
            yield pa.RecordBatch.from_arrays([pa.array((out & np.uint64(slots - 1)).astype(np.int32))], names=["slot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[int, np.ndarray] = {}
        for batch in batches:
            own = batch.column(0).to_numpy()
            for part in np.unique(own // row).tolist():
                maps.setdefault(part, np.zeros(row, bool))[own[own // row == part] % row] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(maps), pa.int32()), pa.array([np.packbits(m).tobytes() for m in maps.values()], pa.binary())],
                                         names=["part", "bits"])

    dealt = phrases.select("lang", "words").mapInArrow(slot, "slot int").repartition(F.floor(F.col("slot") / row))
    out = [p["part"] * row + np.flatnonzero(np.unpackbits(np.frombuffer(p["bits"], np.uint8)))
           for p in dealt.mapInArrow(run, "part int, bits binary").collect()]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def count_phrases(encoded: DataFrame, least: int, longest: int, shards: int, slots: int) -> DataFrame:
    """(lang, words, n) of every phrase of 1 to ``longest`` words with at least ``least`` places.

    Step after step reads the next shard, in a cycle. What has ``least`` places so far is
    entered in the table of steps, and longer phrases of two entered parts are counted from the
    next step on, beside those already counted, each until it has met every shard once.
    Two phrases in one slot only start a count too early, but never before the parts of its phrase
    are reached; it is a whole cycle all the same.
    """
    spark = encoded.sparkSession
    steps = np.full(slots, UNSET, np.uint8)
    live, out = None, []
    step = 0
    while True:
        state = spark.sparkContext.broadcast(steps.tobytes())
        seen = count_step(encoded.filter(F.col("shard") == step % shards), state, step, shards, longest)
        if live is not None:
            seen = seen.unionByName(live.filter("not whole").drop("whole"))
        step += 1
        if step >= UNSET:
            raise ValueError(f"more than {UNSET} steps")
        total = seen.groupBy("lang", "words").agg(F.sum("n").alias("n"), F.min("start").alias("start"))
        total = total.withColumn("whole", F.col("start") + shards <= step).filter(~F.col("whole") | (F.col("n") >= least))
        table = cut(total.select(*COUNTED_COLUMNS, "whole"), "phrases")
        state.unpersist()
        drop(spark, *([live] if live is not None else []))
        live = table
        if step >= shards:  # no phrase has met every shard before
            out.append(cut(live.filter("whole").select("lang", "words", "n"), "whole"))
        new = reached_slots(live.filter((F.col("n") >= least) & (F.length("words") < 8 * longest)), slots)
        new = new[steps[new] == UNSET]
        steps[new] = step
        if step >= int(steps[steps != UNSET].max(initial=0)) + shards:  # every phrase that could start has had its cycle
            break
    found = cut(reduce(DataFrame.unionByName, out), "frequent")
    drop(spark, live, *out)
    return found


def _part(words: Column, first: Column | int, n: Column) -> Column:
    """``n`` words from the word ``first`` (from 0) on."""
    return F.call_function("substring", words, (F.lit(8) * first + 1).cast("int"), (F.lit(8) * n).cast("int"))


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) in decimals of 38 digits."""
    big = "decimal(19,0)"
    return F.call_function("div", (a * 1000).cast(big) * n.cast(big), left.cast(big) * right.cast(big))


def collocations(df: DataFrame, least: int = LEAST, longest: int = LONGEST, ranks: int = RANKS, covered: int = COVERED,
                 shards: int = SHARDS, slots: int = SLOTS, seed: int = 0) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of each language that stand together most.

    Texts are cut into pieces at ``. , ; : ! ?`` and line ends, pieces into words at spaces and
    tabs, A-Z lower-cased. A candidate has 2 to ``longest`` words and ``least`` places, overlaps
    included. Its score floor(1000 a n / (l r)) is that of its weakest cut, the first
    of equal ones. It goes if a longer candidate holds its words and has at least ``covered`` in a
    hundred of its places. Each language lists its first ``ranks``.

    A null lang is ``und``, a null text empty; texts without words, rows of an empty
    table and single words give nothing; equal rows count as often as they occur;
    other columns play no part. Words are 64-bit hashes while they are counted; where
    two words of the candidates share one, all is hashed anew with another ``seed``.
    ``slots`` (a power of two) is the size of the table of steps, which is all that is broadcast.
    A phrase, a hot one too, is counted in each batch before it travels.
    """
    spark = df.sparkSession
    docs = df.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    path = scratch_dir(spark, "encoded")
    encode(docs, seed, shards).write.option("compression", "zstd").partitionBy("shard").parquet(path)
    encoded = spark.read.schema("lang string, tokens binary, n_words bigint, hash bigint, word binary, shard int").parquet(path)
    found = count_phrases(encoded, least, longest, shards, slots).withColumn("k", (F.length("words") / 8).cast("int"))
    totals = encoded.filter("shard >= 0").groupBy("lang").agg(F.sum("n_words").alias("n"))
    named = found.select("lang", "words", F.col("n").alias("f"))
    cand = found.filter("k > 1").withColumnRenamed("n", "a")

    inner = cand.filter("k > 2").select("lang", F.col("a").alias("longer"), "words", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    inner = inner.select("lang", "longer", "words", "size", F.explode(F.sequence(F.lit(0), F.col("k") - F.col("size"))).alias("from"))
    inner = inner.groupBy("lang", _part(F.col("words"), F.col("from"), F.col("size")).alias("words")).agg(F.max("longer").alias("longer"))
    free = cand.join(inner, ["lang", "words"], "left").filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered)).drop("longer")

    cuts = free.select("lang", "words", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("at")).withColumns({
        "x": _part(F.col("words"), F.lit(0), F.col("at")), "y": _part(F.col("words"), F.col("at"), F.col("k") - F.col("at"))})
    cuts = cuts.join(named.toDF("lang", "x", "l"), ["lang", "x"]).join(named.toDF("lang", "y", "r"), ["lang", "y"]).join(totals, "lang")
    scored = cuts.withColumn("score", score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    weakest = scored.groupBy("lang", "words", "k", "a", "n").agg(F.min(F.struct("score", "at", "l", "r")).alias("cut"))
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = weakest.select("lang", "words", "k", "a", "n", "cut.score", "cut.l", "cut.r").withColumn("place", F.rank().over(first)).filter(
        F.col("place") <= ranks)
    best = cut(best, "best")

    # the words behind the hashes of what is listed
    spelled = best.select("lang", "words", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda i: _part(F.col("words"), i, F.lit(1)))).alias("pos", "hash"))
    # hashes are stored least byte first
    vocabulary = encoded.filter("shard = -1").select(_bytes(F.col("hash")).alias("hash"), "word")
    wanted = cut(vocabulary.join(spelled.select("hash").distinct(), "hash", "left_semi").groupBy("hash").agg(
        F.min("word").alias("word"), F.max("word").alias("last")), "vocabulary")
    drop(spark, encoded, found)
    if not wanted.filter("word != last").isEmpty():
        return collocations(df, least, longest, ranks, covered, shards, slots, seed + 1)
    spelled = spelled.join(wanted, "hash").groupBy("lang", "words").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.col("word").cast("string").alias("word")))), lambda w: w["word"]), " ").alias("phrase"))
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = best.join(spelled, ["lang", "words"]).withColumn("rank", F.row_number().over(last).cast("bigint")).filter(F.col("rank") <= ranks)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _bytes(number: Column) -> Column:
    """The eight bytes of a bigint, least first."""
    digits = F.lpad(F.hex(number), 16, "0")
    return F.unhex(F.concat(*(F.substring(digits, 15 - 2 * i, 2) for i in range(8))))
