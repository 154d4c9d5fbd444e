"""Language by compression: the dictionary that shrinks a text most names its language."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Bounds of the fitted state: languages, labelled texts per language, characters per text.
LANGUAGES, TEXTS, CHARS = 200, 1000, 360
#: Times the wanted texts of a language that are sent for the choice.
SPARE = 4
#: Bytes compressed at a time, level, and the least margin of a decision.
CHUNK, LEVEL, MARGIN = 2048, 3, 0.01

UNKNOWN = "und"
RESULT = "struct<lang:string,score:double,margin:double>"


def letters(text: Column) -> Column:
    """Lower case, every run of other characters as one space, a word said many times in a row once."""
    words = F.concat(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " "), F.lit(" "))
    return F.regexp_replace(words, r"(?<![\p{L}\p{M}])([\p{L}\p{M}]+ )\1+", "$1")


def fit(df: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Raw-content dictionary per language from a bounded sample of labelled texts.

    The sample has the ``TEXTS`` smallest text hashes of each of the ``LANGUAGES``
    most frequent labels, and ``CHARS`` characters of each text at a place that its
    hash chooses. So the fitted state is at most LANGUAGES * TEXTS * CHARS
    characters whatever the input. Copies are one text. Hashes above a bound that
    leaves about ``SPARE`` times as many texts as wanted are not sent, so a task
    sees that many of a language and not all. Null labels and texts without letters
    teach nothing; without labelled rows the result is empty.
    """
    known = df.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    names = known.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("h").alias("texts")).orderBy(
        F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not names:
        return {}
    bounds = F.create_map(*[F.lit(x) for r in names for x in (
        r["lang"], min(2**63 - 1, int(2**64 * min(1.0, SPARE * TEXTS / r["texts"])) - 2**63))])
    at = F.pmod("h", F.greatest(F.length("text") - CHARS, F.lit(0)) + 1) + 1
    # only the piece of a text travels
    pieces = known.filter(F.col("h") <= bounds[F.col("lang")]).groupBy("lang", "h").agg(
        F.min(F.substring(F.col("text"), at.cast("int"), F.lit(CHARS))).alias("piece"))
    first = Window.partitionBy("lang").orderBy("h")
    sample = pieces.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= TEXTS).select(
        "lang", "h", F.trim(letters(F.col("piece"))).alias("clean"))
    texts: dict[str, list] = {}
    for r in sample.collect():
        texts.setdefault(r["lang"], []).append((r["h"], r["clean"]))
    return {k: " ".join(dict.fromkeys(t for _, t in sorted(v))).encode() for k, v in sorted(texts.items())}


def coders(content: dict[str, bytes], level: int = LEVEL) -> list[tuple[str, Callable[[bytes], bytes]]]:
    out = []
    for name, data in sorted(content.items()):
        d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        out.append((name, zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False,
                                                   write_checksum=False, write_dict_id=False).compress))
    return out


def decide(clean: bytes, coding: list, chunk: int = CHUNK) -> tuple[str, float, float]:
    """(language, score, margin): sizes are summed over chunks of the whole text, ties go to the first name."""
    if not clean.strip() or not coding:
        return UNKNOWN, 0.0, 0.0
    pieces = [clean[i:i + chunk] for i in range(0, len(clean), chunk)]
    sizes = sorted((sum(len(c(p)) for p in pieces), name) for name, c in coding)
    best = sizes[0][0]
    margin = 1.0 if len(sizes) == 1 else 1.0 - best / sizes[1][0]
    # odds of the languages when a saved hundredth of the size counts as one unit of log odds
    score = 1.0 / sum(2.718281828459045 ** (100.0 * (1.0 - s / best)) for s, _ in sizes)
    return sizes[0][1], score, margin


def identify(df: DataFrame, content: dict[str, bytes], text: str = "text") -> Column:
    """Column ``struct<lang, score, margin>`` for the whole text of every row of ``df``.

    A null text and a text without letters (marks alone are none) are ``und`` with
    score and margin 0, and so is every text when nothing was learned. The dictionaries go out as one
    broadcast of the bounded fitted state.
    """
    state = df.sparkSession.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coding = coders(state.value)
        for batch in batches:
            rows = [decide(t.as_py() or b"", coding) for t in batch]
            yield pa.StructArray.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), *(pa.array([r[i] for r in rows], pa.float64()) for i in (1, 2))],
                names=["lang", "score", "margin"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    clean = F.when(F.col(text).rlike(r"\p{L}"), letters(F.col(text)))
    # not deterministic in name only: a filter and a column that use it then share one evaluation
    return F.arrow_udf(run, RESULT).asNondeterministic()(clean.cast("binary"))


def rejected(result: Column, least: float = MARGIN) -> Column:
    """True where no language was found or the two best are too close to tell."""
    return (result["lang"] == UNKNOWN) | (result["margin"] < least)
