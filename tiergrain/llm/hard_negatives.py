"""Operator 11: hard-negative mining over an inverted multi-index.

For every anchor the best-scoring rows of its label are its positives, and for
every positive the best-scoring rows of other labels whose score lies in a
window below the positive's are its hard negatives. Scores are exact integer
inner products.

**Index.** The two halves of the vectors have a codebook each (k-means on a
bounded sample of rows, ``SAMPLE_ROWS``). Every row, in the sample or not, goes
to the cell of its two codewords. A codeword's radius is the largest distance
of a row's half from it, so for an anchor ``q`` a cell scores at most the sum of two
half-scores ``q_h . c_h + |q_h| r_h``.

**Search.** Cells are packed into shards of about ``SHARD_ROWS`` rows in cell order; a
larger cell is spread over shards of its own. Shards hold their rows, and anchors
stream past them. In a shard a heap walks the two sorted lists of half bounds
(multi-sequence order), so cells come by falling bound; rows are scored exactly
cell by cell, and an anchor stops at the first bound below what it
already has for certain: its fifth positive, or the third negative of
each of its windows. Windows make this certain because a row above a
window cannot enter it and a row below the best three cannot either.

An anchor first visits only the shards of its best cells (``SEED_ROWS`` rows). The scores
found there bound the fifth positive from below, and the second visit
skips every shard whose cells are all bounded below that. Negatives are only
looked for in shards that can reach a window. All this saves work; results are exact.

**Scale.** The codebooks, radii and the list of cells (``CODEWORDS`` squared) are
bounded and go to the driver; rows and anchors do not. A task holds one shard's
rows. Every (anchor, shard) adds at most 5, or 3 a positive, rows to the merge.

Defined results: rows with a null id, label or vector, or a null or non-finite
component take no part; of several rows with one id the one with the least
label, then vector, counts; shorter vectors are filled up with zeros; ties go
to the smaller id; an anchor without positives has no rows; empty tables give
an empty result. Scores must fit 64 bits.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiergrain.llm.common import stored

POSITIVES, NEGATIVES = 5, 3
LOWEST, HIGHEST = 50, 95       # percent of the positive's score
CODEWORDS = 32                 # of each half
SAMPLE_ROWS = 16_384           # the codebooks are fitted on
SHARD_ROWS = 16_384
SEED_ROWS = 4_096
STEP_ROWS = 1_024              # rows scored at once, from as many cells as that takes
EXACT = float(1 << 52)         # sums of products below this are exact in doubles


def usable_rows(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``id``, ``label`` and ``vector`` (long components ``floor(scale * x)``), one row an id."""
    kept = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                       F.col(vector_col).cast("array<double>").alias("vector"))
    kept = kept.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(
        ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    whole = F.transform("vector", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    return kept.groupBy("id").agg(F.min(F.struct("label", whole.alias("vector"))).alias("r")) \
        .select("id", "r.label", "r.vector")


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as doubles, filled up with zeros to ``width``."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width).astype(np.float64)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def fit_codebook(points: np.ndarray, size: int, rounds: int = 8) -> np.ndarray:
    """k-means from spread starting points; empty input gives one zero codeword."""
    points = np.unique(points, axis=0)
    if not len(points):
        return np.zeros((1, points.shape[1]))
    words = points[np.linspace(0, len(points) - 1, min(size, len(points))).astype(int)]
    for _ in range(rounds):
        nearest = _nearest(points, words)
        sums = np.zeros_like(words)
        np.add.at(sums, nearest, points)
        n = np.bincount(nearest, minlength=len(words))[:, None]
        words = np.where(n > 0, sums / np.maximum(n, 1), words)
    return words


def _nearest(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.argmin((words * words).sum(1) - 2 * points @ words.T, axis=1)


class MultiIndex:
    """Two codebooks with radii and the cells in use. Bounded: it fits any task."""

    def __init__(self, books: list[np.ndarray], width: int):
        self.books, self.width = books, width
        self.half = width // 2
        self.radii = [np.zeros(len(b)) for b in books]

    def halves(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, :self.half], x[:, self.half:]]

    def cells(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Codewords and distances of every row's halves."""
        words, far = [], []
        for part, book in zip(self.halves(x), self.books):
            near = _nearest(part, book)
            words.append(near)
            far.append(np.sqrt(((part - book[near]) ** 2).sum(1)))
        return words, far

    def half_bounds(self, x: np.ndarray) -> list[np.ndarray]:
        """For every anchor and codeword the most a row's half can add to the score."""
        out = []
        for part, book, radius in zip(self.halves(x), self.books, self.radii):
            bound = part @ book.T + np.sqrt((part * part).sum(1))[:, None] * radius
            out.append(bound + 1e-9 * np.abs(bound) + 1e-6)        # rounding never lowers a bound
        return out


def multi_sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Pairs of positions by falling sum of two score lists."""
    a, b = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    x, y = first[a].tolist(), second[b].tolist()
    heap = [(-(x[0] + y[0]), 0, 0)]
    while heap:
        least, i, j = heapq.heappop(heap)
        yield -least, a[i], b[j]
        if j + 1 < len(b):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))


def build_index(rows: DataFrame, codewords: int = CODEWORDS, sample_rows: int = SAMPLE_ROWS,
                shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, MultiIndex, list]:
    """Rows with ``shard``, ``first`` and ``second`` codeword; the index; the cells.

    A cell is ``(first, second, shard, shards, n)``: its n rows are spread over ``shards`` shards from ``shard`` on.
    """
    spark = rows.sparkSession
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    width = max(width, 2)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows) if n > sample_rows else rows
    points = _matrix(pa.array(sample.select("vector").toPandas()["vector"].tolist(), pa.list_(pa.int64())), width)
    index = MultiIndex([], width)
    index.books = [fit_codebook(p, codewords) for p in index.halves(points)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, far = index.cells(_matrix(b.column(2), width))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *(pa.array(w.astype(np.int32)) for w in words), *(pa.array(d) for d in far)],
                names=["id", "label", "vector", "first", "second", "far_first", "far_second"])

    placed = stored(rows.mapInArrow(assign, "id long, label long, vector array<long>, first int, second int, "
                                            "far_first double, far_second double"), "negatives-cells")
    # at most codewords x codewords rows
    found = placed.groupBy("first", "second").agg(F.count("*").alias("n"), F.max("far_first").alias("x"),
                                                  F.max("far_second").alias("y")).orderBy("first", "second").collect()
    index.radii = [np.zeros(len(b)) for b in index.books]
    cells, shard, held = [], 0, 0
    for c in found:
        for h, (word, far) in enumerate(((c["first"], c["x"]), (c["second"], c["y"]))):
            index.radii[h][word] = max(index.radii[h][word], far * (1 + 1e-9) + 1e-6)
        parts = -(-c["n"] // shard_rows)
        if held and (parts > 1 or held + c["n"] > shard_rows):
            shard, held = shard + 1, 0
        cells.append((c["first"], c["second"], shard, parts, c["n"]))
        held += c["n"]
        if parts > 1:
            shard, held = shard + parts, 0
    layout = F.broadcast(spark.createDataFrame(cells, "first int, second int, from_shard int, shards int, n long"))
    shard_of = (F.col("from_shard") + F.pmod(F.xxhash64("id"), F.col("shards"))).cast("int")
    sharded = placed.drop("far_first", "far_second").join(layout, ["first", "second"]) \
        .select(shard_of.alias("shard"), "id", "label", "vector", "first", "second")
    return sharded, index, cells


class _Shard:
    """One shard's rows by cell, and the search for one anchor at a time."""

    def __init__(self, index: MultiIndex, ids, labels, x, first, second):
        order = np.lexsort((ids, second, first))
        self.index = index
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        first, second = first[order], second[order]
        self.most = float(np.abs(self.x).max()) if self.x.size else 0.0
        new = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
        ends = np.append(new[1:], len(first))
        self.words = [np.unique(first), np.unique(second)]
        at = [np.searchsorted(w, c[new]) for w, c in zip(self.words, (first, second))]
        self.cells = {(i, j): (a, z) for i, j, a, z in zip(*(v.tolist() for v in (*at, new, ends)))}
        self.whole: np.ndarray | None = None

    def scores(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if self.most * float(np.abs(anchor).max(initial=0.0)) * self.x.shape[1] < EXACT:
            return (self.x[rows] @ anchor).astype(np.int64)
        if self.whole is None:
            self.whole = self.x.astype(np.int64).astype(object)
        return np.array((self.whole[rows] @ anchor.astype(np.int64).astype(object)).tolist(), dtype=np.int64)

    def visits(self, bounds: list[np.ndarray]) -> Iterator[tuple[float, np.ndarray]]:
        """Rows by falling bound, ``STEP_ROWS`` or more at once, with the bound of what is left."""
        rows, size, left = [], 0, len(self.cells)
        for bound, i, j in multi_sequence(bounds[0][self.words[0]], bounds[1][self.words[1]]):
            span = self.cells.get((i, j))
            if span is None:
                continue
            if size >= STEP_ROWS:
                yield bound, np.concatenate(rows)
                rows, size = [], 0
            rows.append(np.arange(*span))
            size += span[1] - span[0]
            left -= 1
            if not left:
                break
        if rows:
            yield -np.inf, np.concatenate(rows)


def _best(score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties by smaller id."""
    if len(score) > n:
        floor = np.partition(score, len(score) - n)[len(score) - n]
        at = np.flatnonzero(score >= floor)
        return at[np.lexsort((ids[at], -score[at]))[:n]]
    return np.lexsort((ids, -score))


def find_positives(shard: _Shard, anchor: np.ndarray, own: int, label: int, floor: int, bounds) -> list[tuple[int, int]]:
    """The shard's best ``(score, id)`` of the anchor's label, none below ``floor``."""
    score, ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for bound, rows in shard.visits(bounds):
        rows = rows[(shard.labels[rows] == label) & (shard.ids[rows] != own)]
        new = shard.scores(anchor, rows)
        rows, new = rows[new >= floor], new[new >= floor]
        score, ids = np.concatenate([score, new]), np.concatenate([ids, shard.ids[rows]])
        best = _best(score, ids, POSITIVES)
        score, ids = score[best], ids[best]
        if bound < floor or (len(score) == POSITIVES and bound < score[-1]):
            break
    return list(zip(score.tolist(), ids.tolist()))


def find_negatives(shard: _Shard, anchor: np.ndarray, label: int, positives: list[int], bounds) -> list[list[tuple[int, int]]]:
    """For every positive's score the shard's best ``(score, id)`` of other labels within its window."""
    # 50 p <= 100 n <= 95 p in whole numbers
    windows = [(-(-LOWEST * p // 100), HIGHEST * p // 100) for p in positives]
    lowest = min(w[0] for w in windows)
    none = np.zeros(0, dtype=np.int64)
    found = [(none, none)] * len(windows)
    for bound, rows in shard.visits(bounds):
        rows = rows[shard.labels[rows] != label]
        new = shard.scores(anchor, rows)
        near = new >= lowest
        new, ids = new[near], shard.ids[rows[near]]
        certain = True
        for k, (low, high) in enumerate(windows):
            fits = (new >= low) & (new <= high)
            score, own = np.concatenate([found[k][0], new[fits]]), np.concatenate([found[k][1], ids[fits]])
            best = _best(score, own, NEGATIVES)
            found[k] = score[best], own[best]
            certain &= bound < low or low > high or (len(best) == NEGATIVES and bound < found[k][0][-1])
        if certain:
            break
    return [list(zip(s.tolist(), i.tolist())) for s, i in found]


_STREAM = "shard int, kind byte, id long, label long, vector array<long>, first int, second int, asked array<long>"
_FOUND = "anchor long, positive long, positive_score long, id long, score long"


def _search(index: MultiIndex, what: str):
    """Task function: a shard's rows (kind 0) come first, then its anchors (kind 1) stream past.

    ``asked`` is the floor of the anchor's positives, or its positives as
    pairs (id, score).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, shard = None, [], None
        for b in batches:
            numbers = b.column(0).to_numpy()
            kinds = b.column(1).to_numpy()
            cuts = np.flatnonzero((numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                if a == z:
                    continue
                if numbers[a] != number:
                    number, held, shard = numbers[a], [], None
                part = b.slice(a, z - a)
                if kinds[a] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                if shard is None:
                    rows = pa.Table.from_batches(held).combine_chunks()
                    columns = [rows.column(i).combine_chunks() for i in range(rows.num_columns)]
                    ids, labels, first, second = (columns[i].to_numpy(zero_copy_only=False) for i in (2, 3, 5, 6))
                    shard = _Shard(index, ids, labels, _matrix(columns[4], index.width), first, second)
                yield answer(shard, part)

    def answer(shard: _Shard, anchors: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(anchors.column(4), index.width)
        bounds = index.half_bounds(x)
        out = []
        ids, labels, asked = (anchors.column(i).to_pylist() for i in (2, 3, 7))
        for k, (anchor, label, ask) in enumerate(zip(ids, labels, asked)):
            own = [h[k] for h in bounds]
            if what == "positives":
                out += [(anchor, i, s, i, s) for s, i in find_positives(shard, x[k], anchor, label, ask[0], own)]
            else:
                pairs = list(zip(ask[::2], ask[1::2]))
                for (p, ps), rows in zip(pairs, find_negatives(shard, x[k], label, [s for _, s in pairs], own)):
                    out += [(anchor, p, ps, i, s) for s, i in rows]
        columns = list(zip(*out)) if out else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                          names=["anchor", "positive", "positive_score", "id", "score"])

    return run


def _routes(index: MultiIndex, cells: list, which: str):
    """Task function: the shards an anchor visits.

    ``seeds``: those of its best cells; ``rest``: all others that can reach its
    floor; ``windows``: all that can reach the lowest of its windows.
    """
    known = {(c[0], c[1]): c[2:] for c in cells}

    def visited(bounds, limit: float = -np.inf, most_rows: float = np.inf) -> set[int]:
        """Shards of the cells by falling bound, down to ``limit`` or until they have ``most_rows`` rows."""
        rows, shards = 0, set()
        for bound, i, j in multi_sequence(*bounds):
            if bound < limit or rows >= most_rows:
                break
            if (i, j) in known:
                shard, parts, n = known[i, j]
                shards.update(range(shard, shard + parts))
                rows += n
        return shards

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            half = index.half_bounds(_matrix(b.column(2), index.width))
            at, to = [], []
            for k, ask in enumerate(b.column(3).to_pylist()):
                own = [h[k] for h in half]
                if which == "seeds":
                    go = visited(own, most_rows=SEED_ROWS)
                elif which == "rest":
                    go = visited(own, ask[0]) - visited(own, most_rows=SEED_ROWS)
                else:
                    go = visited(own, min(-(-LOWEST * s // 100) for s in ask[1::2]))
                at += [k] * len(go)
                to += sorted(go)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int32()), *(b.column(i).take(at) for i in (0, 1, 2, 3))],
                names=["shard", "id", "label", "vector", "asked"])

    return run


def _probe(anchors: DataFrame, sharded: DataFrame, index: MultiIndex, cells: list, which: str,
           what: str) -> DataFrame:
    """Send anchors (``id``, ``label``, ``vector``, ``asked``) to their shards and search there."""
    routed = anchors.mapInArrow(_routes(index, cells, which),
                                "shard int, id long, label long, vector array<long>, asked array<long>")
    none = F.lit(None)
    stream = sharded.select("shard", F.lit(0).cast("byte").alias("kind"), "id", "label", "vector", "first", "second",
                            none.cast("array<long>").alias("asked")) \
        .unionByName(routed.select("shard", F.lit(1).cast("byte").alias("kind"), "id", "label", "vector",
                                   none.cast("int").alias("first"), none.cast("int").alias("second"), "asked"))
    return stream.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(_search(index, what), _FOUND)


def _top(found: DataFrame, by: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(rows: DataFrame, is_anchor: Column, codewords: int = CODEWORDS, sample_rows: int = SAMPLE_ROWS,
         shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Hard negatives of the rows (``id``, ``label``, ``vector`` of longs) that ``is_anchor`` marks.

    ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.
    """
    rows = stored(rows, "negatives-rows")
    sharded, index, cells = build_index(rows, codewords, sample_rows, shard_rows)
    sharded = stored(sharded, "negatives-shards")
    anchors = rows.where(is_anchor)
    least = F.lit(-(1 << 63)).cast("long")

    def probe(asking: DataFrame, which: str, what: str) -> DataFrame:
        return _probe(asking.select("id", "label", "vector", "asked"), sharded, index, cells, which, what)

    seeds = stored(_top(probe(anchors.withColumn("asked", F.array(least)), "seeds", "positives"), ["anchor"], POSITIVES),
                   "negatives-seeds")
    floors = seeds.groupBy("anchor").agg(F.min("score").alias("floor"), F.count("*").alias("n")) \
        .where(F.col("n") == POSITIVES)
    asked = anchors.join(floors, anchors["id"] == floors["anchor"], "left") \
        .withColumn("asked", F.array(F.coalesce("floor", least)))
    both = seeds.drop("rank").unionByName(probe(asked, "rest", "positives"))
    positives = stored(_top(both, ["anchor"], POSITIVES), "negatives-positives")
    # a negative score's window is empty; at most five pairs an anchor
    pairs = positives.where("score >= 0").groupBy("anchor").agg(
        F.flatten(F.collect_list(F.array("id", "score"))).alias("asked"))
    found = probe(anchors.join(pairs, anchors["id"] == pairs["anchor"]), "windows", "negatives")
    return _top(found, ["anchor", "positive"], NEGATIVES).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mine_hard_negatives(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                        label_col: str = "label", scale: int = 256, anchor_every: int = 50, moved_every: int = 7,
                        labels: int = 10, **index) -> DataFrame:
    """Mine the table: components ``floor(scale * x)``; the label of every ``moved_every``-th id moves on by one."""
    rows = usable_rows(embeddings, id_col, vector_col, label_col, scale)
    moved = F.when(F.pmod("id", F.lit(moved_every)) == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.pmod("id", F.lit(anchor_every)) == 0, **index)
