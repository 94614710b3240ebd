"""Operator 2: benchmark decontamination by spaced-seed hashing.

Texts and benchmark items become tokens (lower-cased runs of letters and
digits). A *mask* picks 6 of 8 neighbouring tokens and ignores the others; the
hash of the picked tokens is the seed. The two masks together hit every stretch
of 13 aligned tokens with up to 2 substitutions. Training seeds meet benchmark
seeds in a hash join; every hit names a diagonal (text place minus item place),
and the diagonal is verified token by token: it counts as overlap if any stretch
of at least 13 tokens (the whole item, if that is shorter) is 80 % equal. The
best-scoring stretch (+1 for an equal token, ``MISMATCH`` for another) is
reported if it is such a stretch, else the best-scoring one of 13 to 25 tokens
that is (a longer one always has a half that is).

Items of fewer than 13 tokens are looked for whole, with masks of their length:
one of them misses the substitutions of any copy that is 80 % equal.

**Plan.** Benchmark seeds set bits in a Bloom field of fixed size, the only thing
every task gets. Training seeds outside it are dropped where they are computed,
so the seed join shuffles little more than true hits, and it is an ordinary join
for a benchmark of any size. Equal texts are joined once, by text hash. The hits, a
few numbers each, are written to the shared folder; a second bit field of fixed size holds the
hashes of the texts that were hit, so hardly any other text is shuffled to be verified.

Defined results: null and empty texts and items overlap nothing; repeated rows
give repeated results; a null id is kept; an empty table on either side gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiergrain.llm.common import id_text, may_be_in, only_memos_of, stored

MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
MIN_TOKENS = 13
MIN_EQUAL = 0.8
MISMATCH = -3
FIELD_BITS = 1 << 22       # Bloom field with two probes: 512 KB, whatever the benchmark
HIT_BITS = 1 << 20         # field of the hashes of hit texts: 128 KB, whatever their number
HASHES_KEPT = 200_000
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class _TokenHashes(dict):
    def __missing__(self, token: str) -> int:
        h = self[token] = xxhash.xxh64_intdigest(token)
        return h


_hashes = _TokenHashes()


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def seeds(words: list[str], masks) -> Iterator[np.ndarray]:
    """For each mask the seeds from every place (as signed numbers)."""
    only_memos_of("decontamination", _hashes.clear)
    if len(_hashes) > HASHES_KEPT:
        _hashes.clear()
    h = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    for no, mask in enumerate(masks):
        n = max(0, len(h) - mask[-1])
        s = np.full(n, no + 1, dtype=np.uint64)
        for offset in mask:
            s = s * _M1 + h[offset:offset + n]
        s = (s ^ (s >> np.uint64(29))) * _M2
        yield (s ^ (s >> np.uint64(32))).view(np.int64)


def _short_masks(n: int) -> tuple[tuple[int, ...], ...]:
    """Masks over a whole item of ``n`` tokens; each leaves out some groups of places, together every choice of them."""
    wrong = int(n * (1 - MIN_EQUAL) + 1e-9)
    groups = 2 * wrong + 1
    return tuple(tuple(i for i in range(n) if i % groups not in out) for out in combinations(range(groups), wrong))


def _masks(short: list[int]):
    return MASKS + tuple(m for n in short for m in _short_masks(n))


def _probes(seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u = seed.view(np.uint64)
    return (u & np.uint64(FIELD_BITS - 1)).astype(np.int64), (u >> np.uint64(40)).astype(np.int64) & (FIELD_BITS - 1)


def _item_seeds(short: list[int]):
    sizes = (0,) * len(MASKS) + tuple(n for n in short for _ in _short_masks(n))     # 0: items of 13 tokens and more

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: tuple[list, list, list] = ([], [], [])
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = tokens(text)
                for size, s in zip(sizes, seeds(words, _masks(short))):
                    if size != (len(words) if len(words) < MIN_TOKENS else 0):
                        continue
                    if size:
                        s = s[:1]
                    rows[0].append(s)
                    rows[1].append(np.full(len(s), item, dtype=np.int64))
                    rows[2].append(np.arange(len(s), dtype=np.int32))
            if rows[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(r)) for r in rows],
                                                 names=["seed", "item", "at"])
    return run


def _text_seeds(short: list[int], field: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(field, dtype=np.uint8), bitorder="little").astype(bool)
        for b in batches:
            rows: tuple[list, list, list] = ([], [], [])
            for key, text in dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist())).items():
                for s in seeds(tokens(text), _masks(short)):
                    one, two = _probes(s)
                    at = np.flatnonzero(bits[one])
                    at = at[bits[two[at]]]
                    if len(at):
                        rows[0].append(s[at])
                        rows[1].append(np.full(len(at), key, dtype=np.int64))
                        rows[2].append(at.astype(np.int32))
            if rows[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(r)) for r in rows],
                                                 names=["seed", "key", "place"])
    return run


def best_stretch(equal: np.ndarray) -> tuple[int, int]:
    """Bounds of the best-scoring stretch of an equality row (+1 / ``MISMATCH``)."""
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1, MISMATCH))])
    gain = score[1:] - np.minimum.accumulate(score)[:-1]
    end = int(gain.argmax()) + 1
    start = int(score[:end].argmin())
    return start, end


def equal_stretch(equal: np.ndarray, least: int) -> tuple[int, int] | None:
    """Bounds of the best-scoring stretch of ``least`` to 2 * ``least`` - 1 places that is ``MIN_EQUAL`` equal.

    A longer stretch that is equal enough has a half that is, so there is none at all if none is found.
    """
    same = np.concatenate([[0], np.cumsum(equal)])
    best = None
    for n in range(least, min(2 * least - 1, len(equal)) + 1):
        count = same[n:] - same[:-n]
        start = int(count.argmax())
        score = int(count[start]) + MISMATCH * (n - int(count[start]))
        if count[start] >= MIN_EQUAL * n and (best is None or score > best[0]):
            best = score, start, start + n
    return best and best[1:]


def overlap(words: list[str], item: list[str], diagonal: int) -> tuple[int, int, int] | None:
    """Start in the text, tokens and equal tokens of the overlap on a diagonal, if it counts."""
    a, z = max(0, -diagonal), min(len(item), len(words) - diagonal)
    if z <= a:
        return None
    equal = np.array([words[diagonal + q] == item[q] for q in range(a, z)])
    least = min(MIN_TOKENS, len(item))
    if len(equal) < least:
        return None
    start, end = best_stretch(equal)
    n, same = end - start, int(equal[start:end].sum())
    if n < least or same < MIN_EQUAL * n:
        found = equal_stretch(equal, least)
        if found is None:
            return None
        start, end = found
        n, same = end - start, int(equal[start:end].sum())
    return diagonal + a + start, n, same


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: dict[str, list] = {n: [] for n in ("doc_id", "key", "item_id", "start", "n_tokens", "n_equal")}
        last, words = None, []
        for doc, key, text, item, item_text, diagonal in zip(*(b.column(i).to_pylist() for i in range(6))):
            if (key, text) != last:
                last, words = (key, text), tokens(text)
            found = overlap(words, tokens(item_text), diagonal)
            if found:
                for name, v in zip(out, (doc, key, item, *found)):
                    out[name].append(v)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out.values()], names=list(out))


def find_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per text and item that overlap: the longest overlap.

    ``doc_id``, ``key`` (hash of the text), ``item_id``, ``start`` (token), ``n_tokens``,
    ``n_equal``, ``similarity``.
    """
    rows = id_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("key"), "text")
    items = id_text(benchmark, item_col, item_text_col).select(F.col("doc_id").alias("item"),
                                                              F.col("text").alias("item_text"))

    def sizes(batches):
        for b in batches:
            n = sorted({len(tokens(t)) for t in b.column(0).to_pylist()} & set(range(1, MIN_TOKENS)))
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int32())], names=["n"])

    short = sorted(r.n for r in items.select("item_text").mapInArrow(sizes, "n int").distinct().collect())  # 12 at most
    item_seeds = items.mapInArrow(_item_seeds(short), "seed long, item long, at int")

    def words_of_field(batches):
        for b in batches:
            one, two = _probes(b.column(0).to_numpy(zero_copy_only=False))
            at = np.unique(np.concatenate([one, two]))
            word, first = np.unique(at >> 6, return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits.view(np.int64))], names=["word", "bits"])

    # at most FIELD_BITS / 64 rows reach the driver
    field = np.zeros(FIELD_BITS // 64, dtype=np.int64)
    set_bits = item_seeds.select("seed").mapInArrow(words_of_field, "word long, bits long") \
        .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    field[set_bits["word"].to_numpy()] = set_bits["bits"].to_numpy()
    hits = stored(rows.select("key", "text").mapInArrow(_text_seeds(short, field.tobytes()), "seed long, key long, place int")
                  .join(item_seeds, "seed").select("key", "item", (F.col("place") - F.col("at")).alias("diagonal")).distinct(),
                  "decontamination-hits")
    checked = (rows.where(may_be_in(hits, "key", HIT_BITS)).join(hits, "key").join(items, "item")
               .select("doc_id", "key", "text", "item", "item_text", "diagonal")
               .mapInArrow(_verify, "doc_id long, key long, item_id long, start long, n_tokens long, n_equal long"))
    best = checked.groupBy("doc_id", "key", "item_id").agg(
        F.max(F.struct("n_equal", (-F.col("n_tokens")).alias("n"), (-F.col("start")).alias("s"))).alias("m"))
    return best.select("doc_id", "key", "item_id", (-F.col("m.s")).alias("start"), (-F.col("m.n")).alias("n_tokens"),
                       "m.n_equal", (F.col("m.n_equal") / -F.col("m.n")).alias("similarity"))
