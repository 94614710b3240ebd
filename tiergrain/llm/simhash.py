"""Operator 6: SimHash near-duplicates by covering-code anchors.

Every text gets a 64-bit SimHash of its word shingles; fingerprints that
differ in at most ``max_bits`` (3) bits are linked, and linked groups carry
the smallest document id they reach.

**Anchors.** The 64 bits are two halves of 32. Two fingerprints within 3 bits
differ in at most 1 bit of one of the halves. On 31 bits of a half the perfect
Hamming code [31, 26] is the covering code: each word lies within radius 1 of
exactly one codeword (the anchors, 2^26 per half). A fingerprint is copied to
every anchor within covering radius + 1 = 2 bits of its half, at most 16, so
two fingerprints that differ there in at most 1 bit meet at the anchor nearest
to either of them. At an anchor only distinct fingerprints are compared.

**Hot anchors.** Exact copies are folded into one row before anything is
copied. An anchor with more than ``bucket`` fingerprints is divided again by
the bytes of the other half: two fingerprints within 3 bits agree on at least
one of the four. Whatever is still large is compared in tiles of rows, so no
task holds an unbounded group. All paths find the same links; only a spanning
set of links within each compared set is kept, never all pairs.

**Groups.** Links go through large-star / small-star rounds, each written to
the shared folder, until nothing changes.

Defined results: a null or empty text has fingerprint zero, linked like any
other; repeated rows and ids keep one result row per input row; a null id is
no candidate for the smallest id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiergrain.llm.common import id_text, only_memos_of, stored

MAX_BITS = 3
SHINGLE = 3
SEED = 42
BUCKET = 512           # fingerprints compared at once
SHINGLES_PER_SLICE = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 values of a text's word shingles."""
    words = text.encode("utf-8").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - np.array([len(w) + 1 for w in words])).tolist()
    ends = (ends - 1).tolist()
    n = max(1, len(words) - shingle + 1)
    ends = ends[min(shingle, len(words)) - 1:]
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, SHINGLES_PER_SLICE):
        to = min(n, at + SHINGLES_PER_SLICE)
        h = np.array([digest(line[a:b], SEED) for a, b in zip(starts[at:to], ends[at:to])], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``key`` (hash of the text) and ``fp`` (the 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_memos_of("simhash")
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(2).to_pylist()], dtype="<u8")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fps.view("<i8"), pa.int64())], names=["doc_id", "key", "fp"])

    rows = id_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("key"), "text")
    return rows.mapInArrow(run, "doc_id long, key long, fp long")


# Syndrome masks of the Hamming code on bits 0..30 of a half: bit b is position b + 1.
_MASKS = [sum(1 << (p - 1) for p in range(1, 32) if p >> i & 1) for i in range(5)]
# By syndrome: the flips within 2 bits that lead to a codeword. Any two positions
# whose XOR is the syndrome do, and so does the syndrome's own position alone.
_FLIPS = [np.array([0])] + [
    np.array([(1 << a >> 1) ^ (1 << (a ^ s) >> 1) for a in range(32) if a < a ^ s], dtype=np.int64)
    for s in range(1, 32)]


def _anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (anchor key, fingerprint) copies of an array of signed fingerprints."""
    keys, copies = [], []
    for half in (0, 1):
        bits = (fps >> (32 * half)) & ((1 << 31) - 1)
        syndrome = np.zeros(len(fps), dtype=np.int64)
        for i, mask in enumerate(_MASKS):
            syndrome |= (np.bitwise_count(bits & mask).astype(np.int64) & 1) << i
        for s in range(32):
            at = np.flatnonzero(syndrome == s)
            near = bits[at][:, None] ^ _FLIPS[s][None, :]
            keys.append((near | (half << 32)).ravel())
            copies.append(np.repeat(fps[at], near.shape[1]))
    return np.concatenate(keys), np.concatenate(copies)


_ROWS = "key long, fp long"
_FOUND = "key long, a long, b long"


def _to_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = b.column(0).to_numpy(zero_copy_only=False)
        for part in np.array_split(fps, max(1, len(fps) // 20_000)):
            if len(part):
                key, fp = _anchors(part)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp)], names=["key", "fp"])


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Divide anchors: 3 differences leave one of four bytes of the other half equal."""
    for b in batches:
        key, fp = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        other = np.where(key >> 32 & 1, fp, fp >> 32)
        keys = [key | (1 << 36) | (j << 42) | ((other >> (8 * j) & 255) << 44) for j in range(4)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys)), pa.array(np.tile(fp, 4))], names=["key", "fp"])


def _star(sets: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of ``m`` sets of ``s`` fingerprints each (an m x s array)."""
    m, s = sets.shape
    sets = sets.view(np.uint64)     # bit counts of signed numbers would take their absolute value
    near = np.bitwise_count(sets[:, :, None] ^ sets[:, None, :]) <= max_bits
    label = np.broadcast_to(np.arange(s, dtype=np.int32), (m, s)).copy()
    while True:
        least = np.where(near, label[:, None, :], s).min(axis=2)
        if (least == label).all():
            break
        label = least
    at, i = np.nonzero(label != np.arange(s))
    return sets[at, i].view(np.int64), sets[at, label[at, i]].view(np.int64)


def _compare(max_bits: int, bucket: int):
    """Task function: rows sorted by key in, links and unresolved rows out.

    Rows of one key come in a run. A run of at most ``bucket`` rows is compared
    here; of a longer one the rows go out unresolved (``b`` null) as they come.
    """

    def links(key: np.ndarray, fp: np.ndarray, size: np.ndarray, first: np.ndarray):
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for s in np.unique(size[(size > 1) & (size <= bucket)]):
            starts = first[size == s]
            step = max(1, 2_000_000 // int(s * s))
            for i in range(0, len(starts), step):
                found.append(_star(fp[starts[i:i + step, None] + np.arange(s)], max_bits))
        return (np.concatenate(x) for x in zip(*found))

    def out(key, a, b):
        return pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
            names=["key", "a", "b"])

    def unresolved(key, fp):
        return pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(fp), pa.nulls(len(fp), pa.int64())], names=["key", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp, long_run = np.zeros(0, np.int64), np.zeros(0, np.int64), None

        def settle(key, fp):
            edge = np.flatnonzero(np.diff(key)) + 1
            first = np.concatenate([[0], edge])
            size = np.diff(np.concatenate([first, [len(key)]]))
            a, b = links(key, fp, size, first)
            if len(a):
                yield out(np.zeros(len(a), np.int64), a, b)
            over = np.repeat(size > bucket, size)
            if over.any():
                yield unresolved(key[over], fp[over])

        for batch in batches:
            if not batch.num_rows:
                continue
            k, f = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if long_run is not None:         # the rest of a run already known to be long
                same = k == long_run
                if same.any():
                    yield unresolved(k[same], f[same])
                k, f = k[~same], f[~same]
                if not len(k):
                    continue
                long_run = None
            key, fp = np.concatenate([key, k]), np.concatenate([fp, f])
            open_at = int(np.searchsorted(key, key[-1]))    # the last run may go on
            if open_at:
                yield from settle(key[:open_at], fp[:open_at])
                key, fp = key[open_at:], fp[open_at:]
            if len(key) > bucket:
                long_run = int(key[0])
                yield unresolved(key, fp)
                key, fp = key[:0], fp[:0]
        if len(key):
            yield from settle(key, fp)

    return run


def _found(rows: DataFrame, name: str, max_bits: int, bucket: int) -> tuple[DataFrame, DataFrame]:
    """Links, and the rows of keys that were too large to compare at once."""
    got = stored(rows.repartition("key").sortWithinPartitions("key")
                 .mapInArrow(_compare(max_bits, bucket), _FOUND), name)
    links = got.where(F.col("b").isNotNull()).select("a", "b")
    rest = got.where(F.col("b").isNull()).select("key", F.col("a").alias("fp"))
    return links, rest


def link_fingerprints(distinct_fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all fingerprints within ``max_bits``, by anchors.

    ``distinct_fps`` has one long column without repeats. ``max_bits`` is at
    most 3: the anchors cover that much.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the covering code serves up to 3 bits")
    links, rest = _found(distinct_fps.mapInArrow(_to_anchors, _ROWS), "simhash-anchors", max_bits, bucket)
    if rest.isEmpty():
        return links
    more, rest = _found(rest.mapInArrow(_to_blocks, _ROWS), "simhash-blocks", max_bits, bucket)
    links = links.unionByName(more)
    if rest.isEmpty():
        return links
    # tiles: every pair of tiles of a key is a key of its own
    half = max(1, bucket // 4)
    tiles = rest.groupBy("key").agg(F.ceil(F.count("*") / half).cast("int").alias("tiles"))
    tile = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    pairs = (rest.join(tiles, "key").withColumn("tile", tile)
             .select("key", "fp", "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("with"))
             .select(F.xxhash64("key", F.least("tile", "with"), F.greatest("tile", "with")).alias("key"), "fp"))
    return links.unionByName(_found(pairs, "simhash-tiles", max_bits, 1 << 30)[0])


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node reachable) of every linked node.

    Alternates large-star and small-star rounds. Minima are combined before
    the shuffle and come back by a join, so a node with very many neighbours
    is neither collected nor sorted in one task.
    """

    def stars(e: DataFrame, both_ways: bool) -> DataFrame:
        # e has hi > lo; large-star looks at all neighbours, small-star at the lower ones
        near = e.select(F.col("hi").alias("n"), F.col("lo").alias("o"))
        if both_ways:
            near = near.unionByName(e.select(F.col("lo").alias("n"), F.col("hi").alias("o")))
        least = near.groupBy("n").agg(F.min("o").alias("m")).select(
            "n", F.least("n", "m").alias("m"))
        joined = near.join(least, "n")
        if both_ways:
            made = joined.where(F.col("o") > F.col("n")).select(F.col("o").alias("hi"), F.col("m").alias("lo"))
        else:
            made = joined.where(F.col("o") != F.col("m")).select(
                F.col("o").alias("hi"), F.col("m").alias("lo")).unionByName(
                least.select(F.col("n").alias("hi"), F.col("m").alias("lo")))
        return made.where(F.col("hi") > F.col("lo")).distinct()

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()

    edges = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges = stored(edges, "simhash-links")
    before = state(edges)
    while before[0]:
        edges = stored(stars(stored(stars(edges, True), "simhash-large"), False), "simhash-small")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """``doc_id``, ``key``, ``fp`` (signed long), ``component_id`` and ``root`` of every input row.

    ``root`` names the group, also where ids are missing or repeated.
    """
    # equal fingerprints are dealt over places, written with the rows: no join or aggregate meets a whole group of copies
    places = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(places)).cast("int")
    fps = stored(fingerprints(docs, id_col, text_col, shingle).withColumn("place", dealt), "simhash-fingerprints")
    parts = stored(fps.groupBy("fp", "place").agg(F.min("doc_id").alias("first")), "simhash-parts")
    firsts = stored(parts.groupBy("fp").agg(F.min("first").alias("first")), "simhash-distinct")
    linked = components(link_fingerprints(firsts.select("fp"), max_bits, bucket))
    members = linked.unionByName(linked.select(F.col("root").alias("node"), "root").distinct())
    named = members.join(firsts, members["node"] == firsts["fp"]).select("node", "root", "first")
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    group = named.join(least, "root").select(F.col("node").alias("fp"), "least", "root")
    ids = firsts.join(group, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"),
                                                  F.coalesce("root", "fp").alias("root"))
    ids = parts.select("fp", "place").join(ids, "fp")      # at most ``places`` rows a fingerprint
    return fps.join(ids, ["fp", "place"]).select("doc_id", "key", "fp", "component_id", "root")


def hex_fingerprint(fp: Column) -> Column:
    """16 lowercase hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
