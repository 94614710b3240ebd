"""Operator 13: filter interaction audit with wide packed counters.

Five quality filters can run in 120 orders. What a document does at each of the
600 steps follows from its *mask* alone, the set of filters it fails. So every
mask (with the two label flags) is mapped once to a big integer whose fields
hold all outcomes of that mask at all 600 steps. Per part these integers are
added up, each times the number of its documents, and the sum is unpacked into
the counts. A field has 64 bits and holds at most the number of documents, so
no sum carries over into its neighbour.

Filters (a document fails if): A under 100 words; B fewer than 80 % distinct
words; C more than 10 % of the characters are A-Z; D holds any of ``#$%&*|``;
E its text is that of a document with a smaller id, in any part.

**Scale.** One narrow pass reads the texts and leaves id, part, mask and a
128-bit digest of the text per document; equal rows are folded to one with
their number. The least id of a digest comes back by a join on digest *and* id,
so a text that a third of all documents share is no hot key. Masks are
counted per part before anything is added up: a part has at most 128 rows of
(mask, flags, number), however many documents it has.

Defined results: a null text is empty (fails A only); a null part is the empty
string; a row without an id never fails E, makes no other row fail it and has no
labels; rows with one id and one text do not make each other fail E and count
each; if an id has several label rows it is good or toxic if any of them says
so; an empty table gives an empty result. Texts are equal if their digests are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiergrain.llm.common import stored

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 100, 80, 10
CAPITALS, MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(ORDERS) * len(FILTERS)
OUTCOMES = ("kept", "removed", "redundant", "good_lost", "toxic_lost")
COUNTS = "part string, filter_order string, step int, kept long, removed long, redundant long, " \
         "unique_fails long, good_lost long, toxic_lost long, shapley long"


def text_mask(text: str) -> int:
    """Filters A to D that a text fails, one bit each from A on."""
    raw = text.encode()
    words = raw.split()
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    fails = (len(words) < MIN_WORDS, 100 * len(set(words)) < DISTINCT_PERCENT * len(words),
             100 * capitals > CAPITALS_PERCENT * len(text), len(raw.translate(None, MARKS)) < len(raw))
    return sum(1 << i for i, f in enumerate(fails) if f)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column(2).to_pylist()
        digests = [xxhash.xxh3_128_digest(t) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(digests, pa.binary()),
             pa.array([text_mask(t) for t in texts], pa.int32())], names=["doc_id", "part", "digest", "mask"])


def packed_outcomes(mask: int, good: bool, toxic: bool) -> int:
    """All outcomes of one document as a big integer of 64-bit fields.

    Field ``(order * 5 + step) * 5 + outcome`` for the 600 steps, then one field
    per filter that says whether it is the only one failed.
    """
    fields = np.zeros((len(ORDERS), len(FILTERS), len(OUTCOMES)), dtype="<u8")
    for o, order in enumerate(ORDERS):
        gone = False
        for s, letter in enumerate(order):
            fails = bool(mask >> FILTERS.index(letter) & 1)
            removed = fails and not gone
            gone = gone or fails
            fields[o, s] = (not gone, removed, fails and not removed, removed and good, removed and toxic)
    only = np.array([mask == 1 << i for i in range(len(FILTERS))], dtype="<u8")
    return int.from_bytes(fields.tobytes() + only.tobytes(), "little")


def unpacked(total: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts ``[order, step, outcome]`` and ``unique[filter]`` from a sum of packed integers."""
    fields = np.frombuffer(total.to_bytes(8 * (STEPS * len(OUTCOMES) + len(FILTERS)), "little"), dtype="<u8")
    fields = fields.astype(np.int64)
    return fields[:-len(FILTERS)].reshape(len(ORDERS), len(FILTERS), len(OUTCOMES)), fields[-len(FILTERS):]


def _tally(rows: pd.DataFrame) -> pd.DataFrame:
    """One part's rows of (mask, good, toxic, n), 128 at most, to its 600 counts."""
    total = sum(int(n) * packed_outcomes(int(m), bool(g), bool(t))
                for m, g, t, n in zip(rows["mask"], rows["good"], rows["toxic"], rows["n"]))
    counts, unique = unpacked(total)
    letter = np.array([[FILTERS.index(c) for c in order] for order in ORDERS])
    shapley = np.zeros(len(FILTERS), dtype=np.int64)
    np.add.at(shapley, letter.ravel(), counts[:, :, OUTCOMES.index("removed")].ravel())
    flat = counts.reshape(STEPS, len(OUTCOMES))
    columns = {name: flat[:, i] for i, name in enumerate(OUTCOMES)}
    return pd.DataFrame({
        "part": rows["part"].iloc[0], "filter_order": np.repeat(ORDERS, len(FILTERS)),
        "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS)),
        "kept": columns["kept"], "removed": columns["removed"], "redundant": columns["redundant"],
        "unique_fails": unique[letter.ravel()], "good_lost": columns["good_lost"],
        "toxic_lost": columns["toxic_lost"], "shapley": shapley[letter.ravel()]})


def failure_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``doc_id``, ``part``, ``mask`` of all five filters and ``n``, the number of such rows."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    judged = rows.mapInArrow(_judge, "doc_id long, part string, digest binary, mask int")
    judged = stored(judged.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n")), "audit-masks")
    known, unknown = judged.where("doc_id IS NOT NULL"), judged.where("doc_id IS NULL")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    again = F.when(F.col("is_first").isNull(), F.lit(1 << FILTERS.index("E"))).otherwise(0)
    return known.join(first, ["digest", "doc_id"], "left") \
        .select("doc_id", "part", F.col("mask").bitwiseOR(again).alias("mask"), "n") \
        .unionByName(unknown.select("doc_id", "part", "mask", "n"))


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "lang", good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """Counts of every part, order of the filters and step; 600 rows a part."""
    masks = failure_masks(docs, id_col, text_col, part_col)
    marks = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id"))
             .agg(F.max(F.coalesce(F.col(good_col) == 1, F.lit(False))).alias("good"),
                  F.max(F.coalesce(F.col(toxic_col) == 1, F.lit(False))).alias("toxic"))
             .where("good OR toxic"))
    no = F.lit(False)
    known = masks.where("doc_id IS NOT NULL").join(marks, "doc_id", "left")
    unknown = masks.where("doc_id IS NULL").withColumns({"good": no, "toxic": no})
    flagged = known.unionByName(unknown).select(
        "part", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"), "n")
    counted = flagged.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    return counted.groupBy("part").applyInPandas(_tally, COUNTS)
