"""Toxicity: a weighted lexicon, learned from labels, matched by one automaton in folded text."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabspark.llm.sampling import labelled

#: Bounds of the fitted state: labelled texts of each label, entries, exception phrases.
TEXTS, ENTRIES, EXCEPTIONS = 12_000, 5_000, 2_000
#: Letters of a word beginning that may be an entry of its own.
STEMS = range(3, 9)
#: Toxic texts an entry is in at least, the least weight, clean texts an exception is in at least.
LEAST, WEIGHT, CLEAN = 4, 2.0, 3
#: Distinct features a task counts before it sends them on.
HELD = 400_000

# Characters that look like a Latin letter, and digits and signs that stand for one inside a word.
ALIKE = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "к": "k", "м": "m",
         "т": "t", "в": "b", "н": "h", "ԁ": "d", "ո": "n", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
         "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l"}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}

_ALIKE = str.maketrans(ALIKE)
_OTHER = re.compile("[%s]" % "".join(ALIKE))
_LATIN = re.compile(r"[a-z]*[%s][a-zа-яα-ω%s]*" % ("".join(ALIKE), "".join(ALIKE)))
_HIDDEN = re.compile(r"(?<=[^\W\d_])[0134578@$!|]+(?=[^\W\d_])")
_LED = re.compile(r"(?<![\w@$!|])[134578@$](?=[^\W\d_]{2})")
_INSIDE = str.maketrans(DIGITS)
_GAPS = re.compile(r"[\W\d_]+")
_INVISIBLE = re.compile("[­​-‍⁠﻿]")


def _plain(word: re.Match) -> str:
    """A word with look-alikes in Latin; a word of another script, that is without a Latin letter, stays."""
    w = word.group()
    return w.translate(_ALIKE) if re.search("[a-z]", w) else w


def fold(text: str) -> str:
    """Words of a text, lower case, look-alikes and digits resolved, between single spaces (one at each end).

    Digits and signs are letters only between letters, or before two of them at a word's start.
    """
    text = text.lower()
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text)).lower()
        if _OTHER.search(text):
            text = _LATIN.sub(_plain, text)
    text = _HIDDEN.sub(lambda m: m.group().translate(_INSIDE), text)
    text = _LED.sub(lambda m: m.group().translate(_INSIDE), text)
    return f" {_GAPS.sub(' ', text).strip()} "


def features(folded: str) -> set[str]:
    """Whole words (with both spaces) and beginnings of words (with the first)."""
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in STEMS if k < len(w))
    return out


def weight(toxic: float, clean: float, n_toxic: int, n_clean: int) -> float:
    """Log odds of a feature less one standard error."""
    odds = math.log((toxic + 0.02) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
    return odds - math.sqrt(1 / max(toxic, 0.02) + 1 / (clean + 0.5))


class Lexicon:
    """Entries with weights and exception phrases in one automaton, and the curve from hits to a score."""

    def __init__(self, entries: dict[str, float], exceptions: list[str], curve: tuple = (-4.0, 0.5, 0.5, 0.5)):
        self.curve = curve
        self.automaton = ahocorasick.Automaton()
        for text, w in entries.items():
            self.automaton.add_word(text, (len(text), w))
        for text in exceptions:
            self.automaton.add_word(text, (len(text), None))
        self.size = len(entries) + len(exceptions)
        if self.size:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> dict[int, float]:
        """Greatest weight by the place of the word it begins; words inside an exception phrase have none."""
        out: dict[int, float] = {}
        spans = []
        if self.size:
            for end, (length, w) in self.automaton.iter(folded):
                start = end - length + 1
                if w is None:
                    spans.append((start, end))
                elif w > out.get(start, 0.0):
                    out[start] = w
        for a, b in spans:
            for at in [x for x in out if a <= x < b]:
                del out[at]
        return out

    def score(self, text: str) -> tuple[float, int]:
        folded = fold(text)
        own = self.hits(folded)
        return probability(self.curve, shape(own.values(), folded.count(" ") - 1)), len(own)


def shape(weights, words: int) -> tuple[float, float, float]:
    """Greatest weight, weight in all, and weight per hundred words, the last two as logarithms."""
    total = sum(weights)
    return max(weights, default=0.0), math.log1p(total), math.log1p(100.0 * total / max(words, 1))


def probability(curve: tuple, x: tuple) -> float:
    z = curve[0] + sum(a * b for a, b in zip(curve[1:], x))
    return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, z))))


def _counted(df: DataFrame, found) -> DataFrame:
    """Sums of ``found(text, label)``, an iterable of features, by feature and label; counted per task first."""
    names = pa.schema([("feature", pa.string()), ("label", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (Counter(), Counter())

        def flush():
            for label, own in enumerate(held):
                yield pa.RecordBatch.from_arrays([pa.array(own.keys(), pa.string()), pa.array([label] * len(own), pa.int32()), pa.array(own.values(), pa.int64())], schema=names)
                own.clear()

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1)):
                held[label.as_py()].update(found(text.as_py()))
                if len(held[0]) + len(held[1]) > HELD:
                    yield from flush()
        yield from flush()

    rows = df.select("text", "label").mapInArrow(run, "feature string, label int, n bigint")
    return rows.groupBy("feature").agg(*(F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(c) for k, c in enumerate(("clean", "toxic"))))


def _entries(rows, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Weighted entries; one whose shorter beginning weighs as much is left out, for that matches wherever it does."""
    out: dict[str, float] = {}
    for feature, toxic, clean in sorted(rows, key=lambda r: len(r[0])):
        w = weight(toxic, clean, n_toxic, n_clean)
        if toxic >= LEAST and w >= WEIGHT and all(out.get(feature[:k + 1], 0.0) < w for k in STEMS if k + 1 < len(feature)):
            out[feature] = w
    return out


def _curve(x: np.ndarray, y: np.ndarray, prior: float) -> tuple:
    """Logistic regression of the label on the three figures by Newton steps, moved to the share ``prior`` of label 1."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, ridge = np.zeros(4), np.diag([1e-9, 1e-2, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge + 1e-9 * np.eye(4), x.T @ (y - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    seen = min(max(y.mean(), 1e-9), 1 - 1e-9)
    beta[0] += math.log(prior / (1 - prior)) - math.log(seen / (1 - seen))
    return tuple(float(b) for b in beta)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", texts: int = TEXTS, entries: int = ENTRIES, exceptions: int = EXCEPTIONS) -> Lexicon:
    """The lexicon of the documents that ``labels`` (``doc_id`` and ``label`` 0 or 1) names.

    It is learned from at most ``texts`` whole texts of each label
    (:func:`sampling.labelled`), counted by Spark: entries are words and beginnings of words that are in more
    toxic than clean texts, ``entries`` of them at most, the heaviest first. An exception is
    an entry's word with the one before or after it, found in ``CLEAN`` clean texts and no toxic one.
    The curve is fitted to the sample with each text's own part taken out of the
    weights. Without texts of both labels nothing is an entry and every score is equal.
    """
    spark = docs.sparkSession
    own = labelled(docs, labels, label, texts).persist()
    try:
        shares = {r["label"]: r["n"] for r in labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("label")).agg(
            F.count("*").alias("n")).collect()}
        n = {r["label"]: r["count"] for r in own.groupBy("label").count().collect()}
        if len(n) < 2:
            return Lexicon({}, [], (4.0 if 1 in n else -4.0, 0.0, 0.0, 0.0))
        prior = min(max(shares[1] / (shares[0] + shares[1]), 1e-6), 1 - 1e-6)
        counts = _counted(own, lambda text: features(fold(text)))
        odds = F.log((F.col("toxic") + 0.02) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
        heavy = odds - F.sqrt(1 / F.greatest("toxic", F.lit(0.02)) + 1 / (F.greatest(F.col("clean") - 1, F.lit(0)) + 0.5))
        rows = [(r["feature"], r["toxic"], r["clean"]) for r in counts.filter((F.col("toxic") >= LEAST) & (heavy + 0.7 >= WEIGHT)).orderBy(
            F.desc(heavy), "feature").limit(entries).collect()]
        found = _entries(rows, n[1], n[0])
        state = spark.sparkContext.broadcast({"lexicon": found, "rows": rows, "n": n})

        def phrases(text: str):
            lexicon = _of(state.value)
            folded = fold(text)
            out = set()
            for at in lexicon.hits(folded):
                end = folded.index(" ", at + 1)
                if end + 1 < len(folded):
                    out.add(folded[at:folded.index(" ", end + 1) + 1])
                if at:
                    out.add(folded[folded.rindex(" ", 0, at):end + 1])
            return out

        def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            value = state.value
            pool = {f: (t, c) for f, t, c in value["rows"]}
            wide = Lexicon({f: 1.0 for f in pool}, [])
            for batch in batches:
                rows = []
                for text, label in zip(batch.column(0), batch.column(1)):
                    folded, y = fold(text.as_py()), label.as_py()
                    best: dict[int, float] = {}
                    if wide.size:
                        for end, (length, _) in wide.automaton.iter(folded):
                            t, c = pool[folded[end - length + 1:end + 1]]
                            t, c = (t - 1, c) if y else (t, c - 1)
                            w = weight(t, max(c, 0), value["n"][1], value["n"][0]) if t >= LEAST else 0.0
                            if w >= WEIGHT:
                                best[end - length + 1] = max(w, best.get(end - length + 1, 0.0))
                    rows.append((*shape(best.values(), folded.count(" ") - 1), float(y)))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.float64()) for k in range(4)], names=["a", "b", "c", "y"])

        pairs = _counted(own, phrases)
        spared = [r["feature"] for r in pairs.filter((F.col("toxic") == 0) & (F.col("clean") >= CLEAN)).orderBy(
            F.desc("clean"), "feature").limit(exceptions).collect()]
        data = np.array([tuple(r) for r in own.select("text", "label").mapInArrow(_shapes, "a double, b double, c double, y double").collect()])
        return Lexicon(found, spared, _curve(data[:, :3], data[:, 3], prior))
    finally:
        own.unpersist()


def _of(state: dict) -> Lexicon:
    """The lexicon of a broadcast state, made once per worker."""
    if "made" not in state:
        state["made"] = Lexicon(state["lexicon"], state.get("exceptions", []), state.get("curve", (0.0,) * 4))
    return state["made"]


def entries_of(lexicon: Lexicon) -> tuple[dict[str, float], list[str]]:
    items = list(lexicon.automaton.items()) if lexicon.size else []
    return {t: w for t, (_, w) in items if w is not None}, [t for t, (_, w) in items if w is None]


def score(df: DataFrame, lexicon: Lexicon, text: str = "text") -> Column:
    """``struct<score, hits>`` of the whole text of every row of ``df``.

    The text is folded, the automaton finds entries at the beginnings of words, each word counts with its
    heaviest entry, words in an exception phrase do not count, and the greatest weight, the sum and
    the sum per hundred words give a score between 0 and 1. Null is an empty text, which has the score of no hit.
    The lexicon, at most ``ENTRIES`` + ``EXCEPTIONS`` short strings, is broadcast.
    """
    own, spared = entries_of(lexicon)
    state = df.sparkSession.sparkContext.broadcast({"lexicon": own, "exceptions": spared, "curve": lexicon.curve})

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found = _of(state.value)
        for batch in batches:
            rows = [found.score(t.as_py() or "") for t in batch]
            yield pa.StructArray.from_arrays([pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.int64())], names=["score", "hits"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "struct<score:double,hits:bigint>")(F.col(text))
