"""Quality rules with compression bands."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from math import log2

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.scalar import bound_index
from tabspark.llm.scratch import cut, drop
from tabspark.operators.quantiles import exact_quantiles

#: Bytes of a chunk, compression level.
CHUNK, LEVEL = 4096, 3
#: (from bytes, least) of compressed / original size of the whole text, by its length; below the first no limit.
BANDS = ((256, 0.10), (1024, 0.08), (4096, 0.06), (65536, 0.05))
#: (bytes, most, most in scripts of three bytes and more) of compressed / original size, of whole texts and chunks alike;
#: between two lengths by their logarithm. The first lie above every document of the given tables (0.82, 0.71, 0.62, 0.56,
#: 0.51, 0.45, 0.41 at most from these lengths on) and 99 % of the pieces of documentation files and of Cyrillic, Greek,
#: Arabic and Hebrew messages, the second above 99 % of Chinese, Japanese, Korean, Hindi and Thai messages. Unrelated
#: German messages in a row pass the first (0.58 at 4,096 bytes). Base64 has 0.92, 0.84, 0.79, 0.77, 0.76, 0.75, 0.75 at least.
MOST = ((256, 0.85, 1.00), (512, 0.75, 0.88), (1024, 0.665, 0.765), (2048, 0.60, 0.68), (4096, 0.56, 0.60),
        (16384, 0.52, 0.52), (65536, 0.46, 0.46))
#: Lengths of the fitted limits (steps of half a power of two), texts a length needs, values of a length that one task may hold.
STEP, NEAR, HELD = 0.5, 40, 50_000
#: Shares of the clean texts that the fitted lower and upper limits may lose, and how much wider they are set.
LOSS, SLACK = (0.002, 0.001), (1.0, 1.25)
#: A chunk is odd below this ratio or above the most of its length; a text with more than this share of odd chunks is rejected.
CHUNK_LEAST, ODD_SHARE = 0.05, 0.5
#: A word repetition window, and the base rules: least words, most repeated words in a hundred.
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
#: Bytes of UTF-8 that continue a character.
CONTINUED = bytes(range(0x80, 0xC0))
#: Bytes of UTF-8 that begin a character of three bytes or more.
WIDE = bytes(range(0xE0, 0x100))
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = pa.struct([*((f, pa.int64()) for f in FIELDS), ("band", pa.string()), ("base_failed", pa.bool_()), ("ratio", pa.float64()),
                    ("odd_share", pa.float64()), ("kept", pa.bool_())])


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in a window of ``size`` words found twice or more, first places included."""
    if len(words) <= size:
        return 0
    windows = list(zip(*(islice(words, k, None) for k in range(size))))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = end = 0
    for at, w in enumerate(windows):
        if counts[w] > 1:
            covered += at + size - max(at, end)
            end = at + size
    return covered


def most(data: bytes) -> float:
    """The upper limit of the ratio for a text of this length and share of wide characters."""
    wide = min(1.0, 3 * (len(data) - len(data.translate(None, WIDE))) / len(data))
    limits = [narrow + wide * (broad - narrow) for _, narrow, broad in MOST]
    at = min(max(log2(len(data) / MOST[0][0]), 0.0), log2(MOST[-1][0] / MOST[0][0]))
    for (a, *_), (b, *_), low, high in zip(MOST, MOST[1:], limits, limits[1:]):
        start, end = log2(a / MOST[0][0]), log2(b / MOST[0][0])
        if at <= end:
            return low + (high - low) * (at - start) / (end - start)
    return limits[-1]


def script(data: bytes) -> int:
    """0: mostly characters of one or two bytes; 1: of three and more."""
    return int(6 * (len(data) - len(data.translate(None, WIDE))) > len(data))


class Limits:
    """Least and greatest ratio by length and script, as learned from clean texts; without texts nothing but the fixed bands.

    ``points`` has for each script rows (log2 of bytes, least, greatest), in order of the first.
    """

    def __init__(self, points: dict[int, list[tuple[float, float, float]]]):
        self.points = points

    def of(self, data: bytes) -> tuple[float, float]:
        """(least, greatest): between two lengths in a line, outside the learned lengths only the fixed bands hold."""
        low, high = next(lo for start, lo in reversed(BANDS) if len(data) >= start), most(data)
        known, at = self.points.get(script(data)), log2(len(data))
        if not known or not known[0][0] <= at <= known[-1][0]:
            return low, high
        k = max(1, bisect_left(known, (at,)))
        (a, la, ha), (b, lb, hb) = known[k - 1], known[min(k, len(known) - 1)]
        part = 0.0 if b == a else (at - a) / (b - a)
        return max(low, la + part * (lb - la)), min(high, ha + part * (hb - ha))


def learn(figures: list[tuple[int, float, float]]) -> Limits:
    """Limits from (script, log2 of bytes, ratio) of clean texts.

    At every half power of two stands the median of the texts within one, and their spread (1.4826 times
    the median deviation). The limits lie as many spreads off the median as lose at most ``LOSS`` of
    the texts, times ``SLACK``. Lengths with fewer than ``NEAR`` texts have none.
    """
    points: dict[int, list] = {}
    for which in {f[0] for f in figures}:
        own = np.array([f[1:] for f in figures if f[0] == which])
        at, ratio = own[:, 0], own[:, 1]
        grid = []
        for x in np.arange(np.floor(at.min()), np.ceil(at.max()) + STEP, STEP):
            near = ratio[np.abs(at - x) <= STEP]
            if len(near) >= NEAR:
                centre = float(np.median(near))
                grid.append((float(x), centre, 1.4826 * float(np.median(np.abs(near - centre)))))
        if len(grid) < 2:
            continue
        x, centre, spread = map(np.array, zip(*grid))
        inside = (at >= x[0]) & (at <= x[-1])
        off = (ratio[inside] - np.interp(at[inside], x, centre)) / np.maximum(np.interp(at[inside], x, spread), 1e-9)
        down, up = (SLACK[0] * max(0.0, -float(np.quantile(off, LOSS[0]))), SLACK[1] * max(0.0, float(np.quantile(off, 1 - LOSS[1]))))
        points[which] = [(float(a), float(m - down * s), float(m + up * s)) for a, m, s in zip(x, centre, spread)]
    return Limits(points)


def _line(at: Column, x: list[float], y: list[float]) -> Column:
    """The line through the points, at a place between the first and the last."""
    k = F.greatest(F.lit(0), F.least(bound_index(at, x) - 1, F.lit(len(x) - 2)))
    points = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y")) for a, b in zip(x, y)])
    low, high = F.get(points, k), F.get(points, k + 1)
    return low["y"] + (high["y"] - low["y"]) * (at - low["x"]) / (high["x"] - low["x"])


def learn_all(figures: DataFrame) -> Limits:
    """:func:`learn` of a table (script, size, ratio); medians and losses are exact and computed by Spark."""
    at, ratio = F.col("size"), F.col("ratio")
    ends = {r["script"]: r for r in figures.groupBy("script").agg(F.min("size").alias("a"), F.max("size").alias("b")).collect()}
    near = {(w, float(x)): (F.col("script") == w) & (F.abs(at - F.lit(float(x))) <= STEP)
            for w, r in ends.items() for x in np.arange(np.floor(r["a"]), np.ceil(r["b"]) + STEP, STEP)}
    if not near:
        return Limits({})
    n = dict(zip(near, figures.agg(*[F.count_if(c) for c in near.values()]).first()))
    near = {p: c for p, c in near.items() if n[p] >= NEAR}
    middle = exact_quantiles(figures, {p: F.when(c, ratio) for p, c in near.items()}, [0.5], HELD, counts=n) if near else {}
    spread = exact_quantiles(figures, {p: F.when(c, F.abs(ratio - F.lit(middle[p][0]))) for p, c in near.items()}, [0.5], HELD, counts=n) if near else {}
    grid = {w: [(x, middle[v, x][0], 1.4826 * spread[v, x][0]) for v, x in sorted(near) if v == w] for w in ends}
    grid = {w: g for w, g in grid.items() if len(g) >= 2}
    off = {}
    for w, g in grid.items():
        x, centre, wide = map(list, zip(*g))
        inside = (F.col("script") == w) & at.between(x[0], x[-1])
        off[w] = F.when(inside, (ratio - _line(at, x, centre)) / F.greatest(_line(at, x, wide), F.lit(1e-9)))
    lost = exact_quantiles(figures, off, [LOSS[0], 1 - LOSS[1]], HELD) if off else {}
    points = {}
    for w, g in grid.items():
        down, up = SLACK[0] * max(0.0, -lost[w][0]), SLACK[1] * max(0.0, lost[w][1])
        points[w] = [(x, m - down * s, m + up * s) for x, m, s in g]
    return Limits(points)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id") -> Limits:
    """Limits learned from every distinct text that ``labels`` calls good (1) and the base rules pass.

    No text moves: the figures of the documents meet the labels. Null ids and texts teach nothing.
    """
    good = labels.filter(F.col(label) == 1).select(F.col(key).alias("key")).distinct()
    seen = docs.filter(F.col("text").isNotNull()).select(
        F.col(key).alias("key"), F.xxhash64("text").alias("h"), rules(F.col("text"), NO_LIMITS, figures=True).alias("q"))
    seen = seen.select("key", "h", "q.script", "q.size", "q.ratio", "q.base_failed").join(good, "key", "left_semi").drop("key")
    # filtered behind the write, or every text is judged once more for the filter
    figures = cut(seen.distinct(), "figures")
    figures = figures.filter("ratio is not null and not base_failed")
    limits = learn_all(figures)
    drop(docs.sparkSession, figures)
    return limits


NO_LIMITS = Limits({})


def band_verdict(data: bytes, compress, limits: Limits = NO_LIMITS) -> tuple[float | None, float, bool]:
    """(ratio of the whole, share of odd chunks, inside the bands)."""
    ratio, odd, band = bands(data, compress, limits)
    return ratio, odd, band is None


def bands(data: bytes, compress, limits: Limits = NO_LIMITS) -> tuple[float | None, float, str | None]:
    """(ratio of the whole, share of odd chunks, the band it breaks: low, high, chunks or none)."""
    if len(data) < BANDS[0][0]:
        return None, 0.0, None
    ratio = len(compress(data)) / len(data)
    chunks = [data[i:i + CHUNK] for i in range(0, len(data), CHUNK)]
    if len(chunks) > 1 and len(chunks[-1]) < BANDS[0][0]:
        chunks.pop()  # too short to tell; the whole ratio has it
    ratios = [ratio] if len(chunks) == 1 else [len(compress(c)) / len(c) for c in chunks]
    odd = sum(not CHUNK_LEAST <= r <= most(c) for r, c in zip(ratios, chunks)) / len(ratios)
    low, high = limits.of(data)
    return ratio, odd, "low" if ratio < low else "high" if ratio > high else "chunks" if odd > ODD_SHARE else None


def judge(data: bytes | None, compress, limits: Limits = NO_LIMITS) -> tuple:
    """The values of :data:`RESULT` for one text in UTF-8."""
    data = data or b""
    words = data.split()
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    solid = data.translate(None, SPACES)
    chars = len(solid.translate(None, CONTINUED))
    seen, dup = set(), 0
    for line in data.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip(SPACES):
            seen.add(line)
    repeat = repeated_words(words)
    failed = len(words) < LEAST_WORDS or 100 * repeat > MOST_REPEATED * len(words)
    ratio, odd, band = bands(data, compress, limits)
    return len(words), chars, symbols, dup, repeat, band, failed, ratio, odd, band is None and not failed


def rules(text: Column, limits: Limits = NO_LIMITS, figures: bool = False) -> Column:
    """Struct of counts, compression figures and verdict for the whole text of every row.

    Words are runs of characters other than the ASCII white space; symbols are
    counted in the text; a duplicate line has a word and equals an earlier line.
    The base rules fail texts under ten words and texts with over a fifth of their
    words in repeated windows. The bands reject texts whose zstd ratio as a whole
    lies outside the limits of their length and script, or of whose chunks over half are odd;
    ``band`` says which (low, high, chunks; null: none). ``limits`` are the learned ones
    (:func:`fit`) beside the fixed. Null is an empty text: no words, base rules failed, not kept. A text
    below the shortest band is judged by the base rules alone. With ``figures`` the struct has script and size too.
    """
    fields = [*RESULT, *((pa.field("script", pa.int64()), pa.field("size", pa.float64())) if figures else ())]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compress = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False).compress
        for batch in batches:
            rows = []
            for t in batch:
                data = t.as_py() or b""
                rows.append((*judge(data, compress, limits), *((script(data), log2(max(len(data), 1))) if figures else ())))
            columns = zip(*rows) if rows else [[]] * len(fields)
            yield pa.StructArray.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, fields)], fields=fields)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    kinds = {"int64": "bigint", "double": "double", "bool": "boolean", "string": "string"}
    ddl = ",".join(f"{f.name}:{kinds[str(f.type)]}" for f in fields)
    return F.arrow_udf(run, f"struct<{ddl}>")(text.cast("binary"))
