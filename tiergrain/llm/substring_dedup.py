"""Operator 8: substring dedup with a compressed FM-index per shard.

A window is 13 consecutive words of one text. A word goes if a window covers it
whose words also start in a document with a smaller id.

**Shards by content.** Every window is assigned to its *minimizer*, the 5-word
sequence inside it with the least hash; equal windows have equal minimizers.
Neighbouring windows with the same minimizer form a segment (13 to 21 words,
more where a text repeats itself).
A minimizer that only one document has cannot hide a repeat, so only segments with
shared minimizers travel, to the shard their minimizer belongs to. The work
grows with the input: no text meets all shards. A minimizer that very many
texts share is spread further, by the hash of each whole window.

**FM-index.** A shard's distinct segments are concatenated, suffix-sorted on 13
words, and their Burrows-Wheeler transform is kept as a wavelet matrix of
packed bit vectors with rank counts. The segments are streamed against it:
backward search extends every window to the left word by word, both interval
ends by one rank query per bit level, and stops where the interval holds the
window's own occurrence only. Intervals that reach 13 words are repeats; the
least document id in the interval decides who keeps it.

**Back to the documents.** Segments are folded to one row per content before
they travel, and results come back by a join on the content, so a passage that
a third of all documents share is one segment. Texts meet their results by
hash; every result is checked against the words it speaks of.

Defined results: a null text has no words; texts under 13 words keep all; a row
without an id keeps everything and removes nothing elsewhere; rows of equal id
do not remove each other's words; repeats inside one text stay; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiergrain.llm.common import id_text, stored

WINDOW = 13
GRAM = 5                   # words of a minimizer
SHARD_WORDS = 1_000_000    # words indexed at once
HOT_TEXTS = 5_000          # a minimizer shared by more texts is spread by window
CHUNK_BYTES = 1 << 20      # texts worked on side by side; a longer text is a chunk of its own
NO_ID = np.iinfo(np.int64).max
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M2
    return h ^ (h >> np.uint64(27))


def _powers(base: int) -> np.ndarray:
    steps = np.full(CHUNK_BYTES, base % (1 << 64), dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


_WORD = np.ones(256, dtype=bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_LETTER = _mixed(np.arange(1, 257, dtype=np.uint64) * _M1)
_UP, _DOWN = _powers(int(_M2)), _powers(pow(int(_M2), -1, 1 << 64))


def _sequence_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from every position."""
    n = max(0, len(words) - size + 1)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        h = h * _M1 + words[j:j + n]
    return _mixed(h)


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every word: a polynomial over its bytes, from prefix sums over blocks of words."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        z = int(np.searchsorted(ends, base + CHUNK_BYTES, side="right"))
        if z == at:                                   # a word longer than a block
            out[at] = xxhash.xxh64_intdigest(data[base:ends[at]].tobytes())
            at += 1
            continue
        a, e = starts[at:z] - base, ends[at:z] - base
        terms = _LETTER[data[base:base + e[-1]]] * _UP[:e[-1]]
        sums = np.cumsum(terms)
        out[at:z] = (sums[e - 1] - sums[a] + terms[a]) * _DOWN[a]
        at = z
    return _mixed(out)


class _Words:
    """The words of some texts side by side, as places in their bytes."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
        self.data = data[offsets[0]:offsets[-1]]
        self.offsets = offsets - offsets[0]
        inside = _WORD[self.data]
        opens, closes = np.zeros(len(inside) + 1, dtype=bool), np.zeros(len(inside) + 1, dtype=bool)
        opens[:-1] = inside
        opens[1:-1] &= ~inside[:-1]
        closes[1:] = inside
        closes[1:-1] &= ~inside[1:]
        border = self.offsets[:-1][np.diff(self.offsets) > 0]        # where a text begins, a word does not go on
        opens[border] = inside[border]
        later = border[border > 0]
        closes[later] = inside[later - 1]
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes)
        self.text = np.searchsorted(self.offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.text, minlength=len(texts))
        self.begin = np.cumsum(self.counts) - self.counts

    def line(self, first: int, last: int) -> bytes:
        """The bytes from one word to another (both included)."""
        return self.data[self.starts[first]:self.ends[last]].tobytes()


class _Segments(_Words):
    """Words, the minimizer of every window, and segments.

    A segment is a run of windows with the same minimizer; windows that would
    cross the end of a text do not exist.
    """

    def __init__(self, texts: pa.Array):
        super().__init__(texts)
        self.hashes = _word_hashes(self.data, self.starts, self.ends)
        n = len(self.hashes)
        none = np.zeros(0, dtype=np.int64)
        self.first, self.last, self.minimizer = none, none, none
        if n < WINDOW:
            return
        grams = _sequence_hashes(self.hashes, GRAM)
        m = n - WINDOW + 1
        least = grams[:m].copy()
        for j in range(1, WINDOW - GRAM + 1):
            np.minimum(least, grams[j:j + m], out=least)
        whole = self.text[:m] == self.text[WINDOW - 1:]
        # equal neighbours belong together if both windows exist
        joined = np.concatenate([[False], whole[1:] & whole[:-1] & (least[1:] == least[:-1]), [False]])
        self.first = np.flatnonzero(whole & ~joined[:-1])
        self.last = np.flatnonzero(whole & ~joined[1:])
        self.minimizer = least[self.first].view(np.int64)


def _parts(batch: pa.RecordBatch, text_at: int) -> Iterator[pa.RecordBatch]:
    """A batch's rows in runs of about ``CHUNK_BYTES`` of text."""
    size = np.cumsum(pa.compute.binary_length(batch.column(text_at)).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = size[at - 1] if at else 0
        z = max(at + 1, int(np.searchsorted(size, done + CHUNK_BYTES, side="right")))
        yield batch.slice(at, z - at)
        at = z


def _minimizers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key``, ``gram``, ``doc``: the minimizers of every row's segments."""
    for b in batches:
        for part in _parts(b, 2):            # every row counts here, also copies: their ids matter
            chunk = _Segments(part.column(2))
            if not len(chunk.first):
                continue
            at = pa.array(chunk.text[chunk.first])
            yield pa.RecordBatch.from_arrays(
                [part.column(1).take(at), pa.array(chunk.minimizer), part.column(0).take(at)],
                names=["key", "gram", "doc"])


def _content(line: bytes) -> int:
    """64-bit hash of a segment, signed; with its route it names the segment."""
    h = xxhash.xxh3_64_intdigest(line)
    return h - (1 << 64) if h >> 63 else h


_PLACES = "key long, start int, route long, content long"
_SEGMENTS = "route long, content long, words binary, lo long, hi long"


def _longs(values) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _cut(part: str):
    """Task function: segments with shared minimizers, as ``places`` or as distinct ``segments``.

    Rows come sorted by key, so copies of a text follow each other and are cut once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            keys = _longs(b.column(1))
            new = np.concatenate([[last is None or keys[0] != last], keys[1:] != keys[:-1]])
            last = keys[-1]
            for rows in _parts(b.filter(pa.array(new)), 2):
                yield from cut(rows)

    def cut(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        chunk = _Segments(rows.column(2))
        # a minimizer in any row's list is shared, whichever text of the chunk has it
        shared, hot = _longs(rows.column(3).flatten()), _longs(rows.column(4).flatten())
        chosen = np.isin(chunk.minimizer, shared)
        first, last, route = chunk.first[chosen], chunk.last[chosen], chunk.minimizer[chosen]
        spread = np.isin(route, hot)
        if spread.any():
            whole = _sequence_hashes(chunk.hashes, WINDOW).view(np.int64)
            single = np.concatenate([np.arange(a, z + 1) for a, z in zip(first[spread], last[spread])])
            first, last, route = (np.concatenate([x[~spread], y]) for x, y in (
                (first, single), (last, single), (route, whole[single])))
        if not len(first):
            return
        raw = chunk.data.tobytes()
        lines = [raw[a:z] for a, z in zip(chunk.starts[first].tolist(), chunk.ends[last + WINDOW - 1].tolist())]
        content = np.array([_content(x) for x in lines], dtype=np.int64)
        text = chunk.text[first]
        if part == "places":
            start = (first - chunk.begin[text]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (_longs(rows.column(1))[text], start, route, content)],
                names=["key", "start", "route", "content"])
            return
        distinct, at, which = np.unique(content, return_index=True, return_inverse=True)
        lo, hi = _longs(rows.column(5))[text], _longs(rows.column(6))[text]
        least, most = lo[at], hi[at]
        np.minimum.at(least, which, lo)
        np.maximum.at(most, which, hi)
        yield pa.RecordBatch.from_arrays(
            [pa.array(route[at]), pa.array(distinct), pa.array([lines[i] for i in at.tolist()], pa.binary()),
             pa.array(least), pa.array(most)], names=["route", "content", "words", "lo", "hi"])

    return run


class WaveletMatrix:
    """Symbol ranks over packed bit vectors, one per bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels = max(1, int(alphabet - 1).bit_length())
        self.bits, self.before, self.zeros = [], [], []
        n = len(symbols)
        for level in range(self.levels - 1, -1, -1):
            bit = (symbols >> level) & 1
            packed = np.zeros((n >> 6) + 1, dtype=np.uint64)
            raw = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed.view(np.uint8)[:len(raw)] = raw
            ones = np.bitwise_count(packed)
            self.bits.append(packed)
            self.before.append(np.concatenate([[0], np.cumsum(ones[:-1], dtype=np.int64)]).astype(np.int32))
            self.zeros.append(n - int(bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        every = np.arange(alphabet)
        self.origin = self._descend(every, np.zeros(alphabet, dtype=np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for depth, (bits, before, zeros) in enumerate(zip(self.bits, self.before, self.zeros)):
            block = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[block] + np.bitwise_count(bits[block] & mask)
            up = (symbol >> (self.levels - 1 - depth)) & 1
            at = np.where(up == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        return self._descend(symbol, at) - self.origin[symbol]


class FMIndex:
    """Backward search over texts joined by symbol 0, for patterns up to ``depth``."""

    def __init__(self, text: np.ndarray, alphabet: int, depth: int = WINDOW):
        self.text = text
        self.order = self._sorted(text, depth)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])
        self.matrix = WaveletMatrix(text[self.order - 1], alphabet)

    @staticmethod
    def _sorted(text: np.ndarray, depth: int) -> np.ndarray:
        """Suffix order by the first ``depth`` symbols (doubling, the last step overlaps)."""
        n, rank, have = len(text), text.astype(np.int64), 1
        while True:
            shift = min(have, depth - have) if have < depth else 0
            second = np.zeros(n, dtype=np.int64)
            if shift:
                second[:-shift] = rank[shift:] + 1
            key = rank * (int(rank.max()) + 2) + second
            order = np.argsort(key)
            have += shift
            if have >= depth:
                return order
            key = key[order]
            rank[order] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))

    def intervals(self, starts: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries (text positions) whose ``size`` symbols occur more than once, and their intervals."""
        symbol = self.text[starts + size - 1]
        live, lo, hi = np.arange(len(starts)), self.first[symbol], self.first[symbol + 1]
        for j in range(size - 2, -1, -1):
            more = hi - lo > 1
            live, lo, hi = live[more], lo[more], hi[more]
            symbol = self.text[starts[live] + j]
            both = self.matrix.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
            lo, hi = self.first[symbol] + both[:len(lo)], self.first[symbol] + both[len(lo):]
        more = hi - lo > 1
        return live[more], lo[more], hi[more]


def least_owners(lines: list[bytes], owners: list[int], window: int = WINDOW) -> list[np.ndarray]:
    """For every window of every distinct segment, the least owner of a segment that has it."""
    ids: dict[bytes, int] = {}
    text, lengths = [], []
    for line in lines:
        words = line.split()
        text.extend([ids.setdefault(w, len(ids) + 1) for w in words])
        text.append(0)
        lengths.append(len(words))
    text = np.array(text, dtype=np.int64)
    lengths = np.array(lengths)
    begin = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    count = lengths - window + 1
    segment = np.repeat(np.arange(len(lines)), count)
    within = np.arange(len(segment)) - np.repeat(np.cumsum(count) - count, count)
    owner = np.array(owners, dtype=np.int64)
    index = FMIndex(text, len(ids) + 1, window)
    live, lo, hi = index.intervals(begin[segment] + within, window)
    least = owner[segment]
    if len(live):
        by_row = np.repeat(owner, lengths + 1)[index.order]
        starts, which = np.unique(lo, return_inverse=True)       # intervals of one depth are equal or apart
        ends = np.zeros(len(starts), dtype=np.int64)
        ends[which] = hi
        edges = np.minimum(np.column_stack([starts, ends]).ravel(), len(by_row) - 1)
        smallest = np.minimum.reduceat(by_row, edges)[::2]
        smallest = np.where(ends == len(by_row), np.minimum(smallest, by_row[-1]), smallest)
        least[live] = smallest[which]
    return np.split(least, np.cumsum(count)[:-1])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by route in; windows' least owners of the segments that lose words out, shard by shard."""
    held: dict[tuple[int, int], list] = {}
    words, route = 0, None

    def shard():
        found = least_owners([v[0] for v in held.values()], [v[1] for v in held.values()])
        hit = [(k, f) for (k, v), f in zip(held.items(), found) if (f < v[2]).any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k, _ in hit], pa.int64()), pa.array([k[1] for k, _ in hit], pa.int64()),
             pa.array([f.tolist() for _, f in hit], pa.list_(pa.int64()))], names=["route", "content", "least"])

    for b in batches:
        for r, content, line, lo, hi in zip(*(b.column(i).to_pylist() for i in range(5))):
            if r != route:
                if words >= SHARD_WORDS:
                    yield from shard()
                    held, words = {}, 0
                route = r
            known = held.get((r, content))
            if known is None:
                held[r, content] = [line, lo, hi]
                words += len(line.split())
            else:
                known[1], known[2] = min(known[1], lo), max(known[2], hi)
    if held:
        yield from shard()


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Apply the results of a text's segments to its words."""
    for b in batches:
        for part in _parts(b, 2):
            yield _kept(part)


def _kept(rows: pa.RecordBatch) -> pa.RecordBatch:
    chunk = _Words(rows.column(2))
    n = len(chunk.starts)
    hits = rows.column(3)
    text = np.repeat(np.arange(rows.num_rows), _longs(hits.value_lengths().fill_null(0)))
    flat = hits.flatten()
    start, content = _longs(flat.field(0)), _longs(flat.field(1))
    owners = flat.field(2)
    windows = _longs(owners.value_lengths())
    owner = _longs(owners.flatten())
    doc = _longs(rows.column(0).fill_null(-NO_ID))       # a row without an id loses nothing
    hit = np.repeat(np.arange(len(text)), windows)       # the result that a window belongs to
    lost = owner < doc[text[hit]] if len(hit) else np.zeros(0, dtype=bool)
    # only a result that speaks of this text's own words counts, not one of another text with the same hash
    own = np.zeros(len(text), dtype=bool)
    for i in np.unique(hit[lost]).tolist():
        z = start[i] + windows[i] + WINDOW - 1
        a = chunk.begin[text[i]]
        own[i] = z <= chunk.counts[text[i]] and _content(chunk.line(a + start[i], a + z - 1)) == content[i]
    lost &= own[hit]
    first = np.cumsum(windows) - windows
    at = (chunk.begin[text] + start)[hit[lost]] + np.flatnonzero(lost) - first[hit[lost]]
    step = np.bincount(at, minlength=n + 1) - np.bincount(at + WINDOW, minlength=n + 1)
    stay = np.cumsum(step[:n]) == 0
    # the bytes of the words that stay, and the one after each that another follows
    kept = np.flatnonzero(stay)
    ends = chunk.ends[kept]
    between = ends[:-1][chunk.text[kept[1:]] == chunk.text[kept[:-1]]]
    edges = np.zeros(len(chunk.data) + 1, dtype=np.int8)
    edges[chunk.starts[kept]] += 1
    edges[ends] -= 1
    mask = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    mask[between] = True
    data = chunk.data.copy()
    data[between] = 32
    offsets = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[chunk.offsets]
    texts = pa.Array.from_buffers(pa.large_string(), rows.num_rows,
                                  [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[mask].tobytes())])
    gone = chunk.counts - np.bincount(chunk.text[kept], minlength=rows.num_rows)
    return pa.RecordBatch.from_arrays(
        [rows.column(0), pa.array(chunk.counts.astype(np.int64)), pa.array(gone.astype(np.int64)), texts.cast(pa.string())],
        names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   hot_texts: int = HOT_TEXTS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (words joined by a space) of every row."""
    # key comes from the text alone, so equal texts are worked on once
    rows = id_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("key"), "text")
    grams = rows.mapInArrow(_minimizers, "key long, gram long, doc long")
    shared = stored(grams.groupBy("gram").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count("*").alias("n"))
                    .where(F.col("lo") < F.col("hi")).select("gram", (F.col("n") > hot_texts).alias("hot")),
                    "repeats-grams")
    lists = (grams.select("key", "gram").join(shared, "gram").groupBy("key")
             .agg(F.collect_set("gram").alias("grams"), F.collect_set(F.when(F.col("hot"), F.col("gram"))).alias("hot")))
    owners = rows.groupBy("key").agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("lo"),
                                     F.coalesce(F.max("doc_id"), F.lit(-NO_ID)).alias("hi"))
    # the same columns of ``rows`` here and below, so that its shuffle by key serves all three joins
    marked = rows.join(lists.join(owners, "key"), "key").select("doc_id", "key", "text", "grams", "hot", "lo", "hi")
    found = (marked.mapInArrow(_cut("segments"), _SEGMENTS).repartition("route").sortWithinPartitions("route")
             .mapInArrow(_search, "route long, content long, least array<bigint>"))
    hits = marked.mapInArrow(_cut("places"), _PLACES).join(found, ["route", "content"]).groupBy("key").agg(
        F.collect_set(F.struct("start", "content", "least")).alias("hits"))
    both = rows.join(hits, "key", "left").select("doc_id", "key", "text", "hits")
    return both.mapInArrow(_keep, "doc_id long, n_words long, n_removed long, kept string")
