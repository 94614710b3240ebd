"""Operator 4: byte-level BPE encoding and decoding.

A vocabulary file (one base64 token and its rank per line) is read once and
broadcast: its size is fixed by the file, not by the data. Every regex match
("piece") of a text is encoded on its own:

* a piece that is itself a token is that token (as the public library does);
* otherwise bytes are mapped to Latin-1 characters and the encoder walks left to
  right. At every place it visits, the Aho-Corasick automaton's trie gives the
  longest token that starts there. It takes the longest token whose neighbourhood
  with the last token is *compatible*: byte-pair merging would never have merged
  or cut across the border of the two. If none fits it shortens the token, and if
  no prefix fits either it takes the last token back. A position given up once is
  never tried again, so the work is linear in the bytes.

Compatibility is decided by undoing merges on both sides of the border and is
memoised per token pair. Pieces repeat a lot in running text, so their ids are
memoised too. Each table has two generations of fixed size: a full young one
becomes the old one, and what is still used moves back. That changes the speed only.

Defined results: a null or empty text has no ids; repeated rows and ids give
repeated results; a text of any length is processed in slices of matches.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import ahocorasick
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiergrain.llm.common import id_text, only_memos_of

PIECES_KEPT = 100_000      # memoised pieces per generation and Python worker
PAIRS_KEPT = 150_000       # memoised token pairs per generation and Python worker
MATCHES_PER_SLICE = 1 << 16
CODED_PER_BATCH = 1 << 20  # bytes of ids after which a worker hands its rows on


class _Memo(dict):
    """Results by key, worked out at the first look-up; two generations of at most ``size``."""

    def __init__(self, work: Callable, size: int):
        super().__init__()
        self.work, self.size, self.old = work, size, {}

    def __missing__(self, key):
        if len(self) >= self.size:
            self.old = {}            # freed before its successor is made
            self.old = dict(self)
            self.clear()
        known = self.old.get(key)
        if known is None:
            known = self.work(key)
        self[key] = known
        return known

    def forget(self) -> None:
        self.old = {}
        self.clear()


class BytePairCodec:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens) if t}
        self.pattern = regex.compile(pattern)
        self.sizes = [len(t) for t in tokens]
        self.packed = [i.to_bytes(4, "little") for i in range(len(tokens))]
        self._compatible = _Memo(lambda key: self._decide(*divmod(key, len(tokens))), PAIRS_KEPT)
        self._pieces = _Memo(self._pack, PIECES_KEPT)
        self._build()

    def forget(self) -> None:
        """Empty the memo tables."""
        self._compatible.forget()
        self._pieces.forget()

    def _pack(self, piece: str) -> bytes:
        return b"".join([self.packed[i] for i in self.encode_piece(piece.encode("utf-8"))])

    def _build(self) -> None:
        """Find for every token the last merge that makes it.

        ``cut[t]`` is the pair that merges into ``t`` (``(t, t)`` for single
        bytes); ``merged`` maps such a pair back. Tokens are taken by rank, so
        the pairs a decision needs are already known. Tokens that merging
        cannot reach stay out of the automaton: they only occur as whole
        pieces.
        """
        tokens, rank = self.tokens, self.rank
        self.cut = [(i, i) for i in range(len(tokens))]
        self.merged: dict[tuple[int, int], int] = {}
        reachable = {i for i, t in enumerate(tokens) if len(t) == 1}
        for i, t in enumerate(tokens):
            if len(t) < 2:
                continue
            for k in range(len(t) - 1, 0, -1):
                a, b = rank.get(t[:k]), rank.get(t[k:])
                if (a is not None and b is not None and a in reachable and b in reachable
                        and max(self._made_at(a), self._made_at(b)) < i and self._decide(a, b)):
                    self.cut[i] = (a, b)
                    self.merged[(a, b)] = i
                    reachable.add(i)
                    break
        self.shorter = [-1] * len(tokens)
        automaton = ahocorasick.Automaton()
        for i in reachable:
            t = tokens[i]
            automaton.add_word(t.decode("latin-1"), i)
            for k in range(len(t) - 1, 0, -1):
                p = rank.get(t[:k], -1)
                if p in reachable:
                    self.shorter[i] = p
                    break
        automaton.make_automaton()
        self.automaton = automaton
        self.words = {tokens[i].decode("latin-1"): i for i in reachable}
        self.longest = max(map(len, self.words), default=1)

    def _made_at(self, token: int) -> int:
        """When merging makes the token; single bytes are there from the start."""
        return -1 if len(self.tokens[token]) == 1 else token

    def _decide(self, left: int, right: int) -> bool:
        """May ``left`` and ``right`` stand side by side in a merged sequence?

        Undo the later of the two inner merges step by step. Whenever the two
        tokens that touch the border could merge *before* the step just undone,
        merging would have crossed the border.
        """
        before = len(self.tokens)
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < before:
                return False
            made_left, made_right = self._made_at(left), self._made_at(right)
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                # the right neighbour merges first on equal ranks further left
                before = made_left
                left = self.cut[left][1]
            else:
                before = made_right + 1
                right = self.cut[right][0]

    def compatible(self, left: int, right: int) -> bool:
        return self._compatible[left * len(self.tokens) + right]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.rank.get(piece)
        if whole is not None or not piece:
            return [whole] if piece else []
        text, n = piece.decode("latin-1"), len(piece)
        pairs, shorter, sizes, many = self._compatible, self.shorter, self.sizes, len(self.tokens)
        reach, path, word = self.longest, self.automaton.longest_prefix, self.words.get
        given_up: set[int] = set()
        out: list[int] = []
        at, last, token = 0, -1, None
        while True:
            if token is None:          # the longest token from here on; the trie's path bounds the look-ups
                rest = text[at:at + reach]
                size = path(rest)
                token = word(rest[:size])
                while token is None:
                    size -= 1
                    token = word(rest[:size])
            while token >= 0:
                end = at + sizes[token]
                if end not in given_up and (last < 0 or pairs[last * many + token]):
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                if end == n:
                    return out
                at, last, token = end, token, None
            else:
                given_up.add(at)
                token = out.pop()
                at -= sizes[token]
                last = out[-1] if out else -1

    def encode_packed(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if len(text) <= MATCHES_PER_SLICE:
            matches = iter(self.pattern.findall(text))
        else:
            matches = (m.group() for m in self.pattern.finditer(text))
        slices = []
        while part := list(islice(matches, MATCHES_PER_SLICE)):
            slices.append(b"".join(map(self._pieces.__getitem__, part)))
        return b"".join(slices)

    def decode_packed(self, packed: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in memoryview(packed).cast("I")])


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a base64 rank file; unused ranks are empty."""
    with open(path, "rb") as f:
        pairs = [(int(r), base64.b64decode(t)) for t, r in (line.split() for line in f if line.strip())]
    tokens = [b""] * (max(r for r, _ in pairs) + 1)
    for r, t in pairs:
        tokens[r] = t
    return tokens


@lru_cache(maxsize=2)
def _codec(tokens: tuple[bytes, ...], pattern: str) -> BytePairCodec:
    return BytePairCodec(list(tokens), pattern)


def _worker_codec(tokens: tuple[bytes, ...], pattern: str) -> BytePairCodec:
    codec = _codec(tokens, pattern)
    only_memos_of("bpe", codec.forget)
    return codec


def coded_batches(batches: Iterator[pa.RecordBatch], codec: BytePairCodec) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids, decoded) of (doc_id, text) rows: every text is encoded once, results leave in small batches."""
    def made(doc_ids: list, ids: list) -> pa.RecordBatch:
        decoded = pa.array([codec.decode_packed(b) for b in ids], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(ids, pa.binary()), decoded],
                                          ["doc_id", "ids", "decoded"])

    for batch in batches:
        doc_ids, ids, size = [], [], 0
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            doc_ids.append(doc_id.as_py())
            ids.append(codec.encode_packed(text.as_py() or ""))
            size += len(ids[-1])
            if size >= CODED_PER_BATCH:
                yield made(doc_ids, ids)
                doc_ids, ids, size = [], [], 0
        if ids:
            yield made(doc_ids, ids)


class Tokenizer:
    """Columns and frames that are encoded and decoded with one broadcast vocabulary."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        ranks = spark.sparkContext.broadcast((tuple(read_ranks(path)), pattern))

        @F.pandas_udf(T.BinaryType())
        def encode(texts: pd.Series) -> pd.Series:
            codec = _worker_codec(*ranks.value)
            return texts.map(lambda t: codec.encode_packed(t or ""))

        @F.pandas_udf(T.BinaryType())
        def decode(ids: pd.Series) -> pd.Series:
            codec = _worker_codec(*ranks.value)
            return ids.map(lambda b: codec.decode_packed(b or b""))

        def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from coded_batches(batches, _worker_codec(*ranks.value))

        self._encode, self._decode, self._code = encode, decode, code

    def encode(self, text: Column) -> Column:
        """Packed ids (little-endian unsigned 32 bit) of a text column."""
        return self._encode(text)

    def decode(self, ids: Column) -> Column:
        """The bytes that packed ids stand for."""
        return self._decode(ids)

    def both(self, rows: DataFrame) -> DataFrame:
        """``doc_id``, ``ids`` and ``decoded`` of (``doc_id``, ``text``) rows.

        The two columns side by side, ``encode`` and ``decode`` of it, would make Spark encode twice.
        """
        return rows.mapInArrow(self._code, "doc_id long, ids binary, decoded binary")


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (packed), ``n_tokens`` and ``decoded`` bytes of every row.

    One narrow pass: no shuffle, any row order, one result per input row.
    """
    tok = Tokenizer(docs.sparkSession, path, pattern)
    return tok.both(id_text(docs, id_col, text_col)).select(
        "doc_id", "ids", (F.length("ids") / 4).cast("long").alias("n_tokens"), "decoded")
