"""Byte-level BPE over Arrow batches: ids, byte and character offsets, and decoding."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession, functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

#: Distinct pieces of a generation a worker remembers, the longest it keeps, and pieces that are looked up together.
PIECES, PIECE_CHARS, TOGETHER = 150_000, 64, 100_000
#: Characters on which the regex module and the tokenizers library cut alike; other texts are cut by the latter.
SAFE = ((0x0, 0x557), (0x2000, 0x208E), (0x3040, 0x9FFF), (0xAC00, 0xD7A3))
COMMON = regex.compile("[^%s]" % "".join(f"{chr(a)}-{chr(b)}" for a, b in SAFE))


def byte_table() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    table = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """A rank file (base64 token and rank per line), read where the driver finds it; about 1 MB."""
    if "://" in path:
        return b"\n".join(r[0].encode() for r in spark.read.text(path).collect())
    with open(path, "rb") as f:
        return f.read()


def _is_text(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


class Codec:
    """Encoder and decoder for one rank file and one splitting pattern.

    Every way to join two tokens into a third is a merge with the third's rank, so
    the lowest rank merges first and a piece that is a token stays whole.
    """

    def __init__(self, ranks: bytes, pattern: str):
        table = byte_table()
        tokens = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
        shown = {t: "".join(table[b] for b in t) for t in tokens}
        merges = [(shown[t[:i]], shown[t[i:]]) for t in sorted(tokens, key=tokens.get) for i in range(1, len(t))
                  if t[:i] in tokens and t[i:] in tokens]
        self.cut = pre_tokenizers.Split(Regex(pattern), behavior="isolated")
        self.find = regex.compile(pattern).findall
        self.model = Tokenizer(models.BPE(vocab={shown[t]: r for t, r in tokens.items()}, merges=merges, ignore_merges=True))
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        back = {c: b for b, c in enumerate(table)}
        self.bytes = {r: bytes(back[c] for c in self.model.id_to_token(r)) for r in tokens.values()}
        self.whole = {t.decode(): r for t, r in tokens.items() if _is_text(t)}
        # pieces of this generation and the one before: (ids, ids as text, bytes of the ids)
        self.new: dict[str, tuple[tuple[int, ...], str, bytes]] = {}
        self.old: dict[str, tuple[tuple[int, ...], str, bytes]] = {}

    def pieces(self, text: str) -> list[str]:
        if COMMON.search(text):
            return [p for p, _ in self.cut.pre_tokenize_str(text)]
        return self.find(text)

    def entry(self, ids) -> tuple[tuple[int, ...], str, bytes]:
        return tuple(ids), ",".join(map(str, ids)), self.decode_bytes(ids)

    def entries(self, texts: Iterable[str]) -> Iterator[list[tuple[tuple[int, ...], str, bytes]]]:
        """The entry of every piece of every text.

        Pieces of several texts are looked up together: in the memory, in the generation before, in
        the vocabulary, and what is left in one call of the library. A full memory becomes the older generation.
        """
        held, many = [], 0
        for text in texts:
            held.append(self.pieces(text))
            many += len(held[-1])
            if many >= TOGETHER:
                yield from self._looked_up(held)
                held, many = [], 0
        yield from self._looked_up(held)

    def _looked_up(self, held: list[list[str]]) -> Iterator[list[tuple[tuple[int, ...], str, bytes]]]:
        known, extra, rest = self.new, {}, []
        for p in {p for pieces in held for p in pieces if p not in known}:
            if p in self.old:
                known[p] = self.old[p]
            elif p in self.whole:
                known[p] = self.entry((self.whole[p],))
            else:
                rest.append(p)
        for p, e in zip(rest, self.model.encode_batch_fast(rest, add_special_tokens=False) if rest else ()):
            (known if len(p) <= PIECE_CHARS else extra)[p] = self.entry(e.ids)
        for pieces in held:
            yield [known[p] for p in pieces] if not extra else [known[p] if p in known else extra[p] for p in pieces]
        if len(known) > PIECES:
            self.old, self.new = known, {}

    def encode(self, text: str) -> list[int]:
        return [i for own in self.entries([text]) for e in own for i in e[0]]

    def decode_bytes(self, ids: list[int]) -> bytes:
        table = self.bytes
        return b"".join([table[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        """Text of ids; bytes of a character split at either end show as U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def offsets(self, text: str, ids: list[int]) -> list[tuple[int, int]]:
        """Character range [start, end) that each token touches; tokens that share a split character overlap."""
        data = np.frombuffer(text.encode(), np.uint8)
        char = np.cumsum((data & 0xC0) != 0x80) - 1  # character of each byte
        ends = np.cumsum([len(self.bytes[i]) for i in ids], dtype=np.int64)
        starts = np.concatenate(([0], ends[:-1])).astype(np.int64)[: len(ids)]
        return [(int(char[a]), int(char[b - 1]) + 1) for a, b in zip(starts, ends)]


def codec(state: dict) -> Codec:
    """The codec of a broadcast state, made once per worker, which keeps broadcast values between tasks."""
    if "codec" not in state:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks have the cores already
        state["codec"] = Codec(state["ranks"], state["pattern"])
    return state["codec"]


def shipped(spark: SparkSession, path: str, pattern: str):
    return spark.sparkContext.broadcast({"ranks": read_ranks(spark, path), "pattern": pattern})


def _udf(fn, kind: str):
    fn.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(fn, kind)


def encode(spark: SparkSession, text: Column, path: str, pattern: str) -> Column:
    """``struct<ids, starts, ends>`` per row: token ids and the character range of each. Null is an empty text."""
    state = shipped(spark, path, pattern)

    def run(batches):
        own = codec(state.value)
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            ids = [own.encode(t) for t in texts]
            spans = [own.offsets(t, i) for t, i in zip(texts, ids)]
            yield pa.StructArray.from_arrays(
                [pa.array(ids, pa.list_(pa.int32())), *(pa.array([[s[k] for s in x] for x in spans], pa.list_(pa.int64())) for k in (0, 1))],
                names=["ids", "starts", "ends"])

    return _udf(run, "struct<ids:array<int>,starts:array<bigint>,ends:array<bigint>>")(text)


def decode(spark: SparkSession, ids: Column, path: str, pattern: str) -> Column:
    """``struct<bytes, text>`` of an array of ids; null is no ids, an unknown id fails the query."""
    state = shipped(spark, path, pattern)

    def run(batches):
        own = codec(state.value)
        for batch in batches:
            data = [own.decode_bytes(i or []) for i in batch.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array(data, pa.binary()), pa.array([d.decode("utf-8", "replace") for d in data])],
                                             names=["bytes", "text"])

    return _udf(run, "struct<bytes:binary,text:string>")(ids)


def round_trip(spark: SparkSession, text: Column, path: str, pattern: str) -> Column:
    """``struct<n_tokens, ids_sha256, decoded_sha256>``: encode, decode, and digests of both; ids are decoded piece by piece."""
    state = shipped(spark, path, pattern)

    def run(batches):
        own = codec(state.value)
        for batch in batches:
            n, a, b = [], [], []
            for pieces in own.entries(cell.as_py() or "" for cell in batch):
                n.append(sum([len(ids) for ids, _, _ in pieces]))
                a.append(sha256(",".join([text for _, text, _ in pieces]).encode()).hexdigest())
                b.append(sha256(b"".join([data for _, _, data in pieces])).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                             names=["n_tokens", "ids_sha256", "decoded_sha256"])

    return _udf(run, "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")(text)
