"""Operator 9: document fingerprints by consistent weighted sampling (native).

A text is a weighted set: its lower-cased words, weighted by how often they
occur. For every sample ``k`` a word ``w`` of weight ``S`` has fixed random
numbers r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1) drawn from its hash, and

    t = floor(ln S / r + b),    ln a = ln c - r (t - b + 1).

The sample is the (word, t) with the least ``a``. Two texts pick the same one
with a probability equal to their generalised Jaccard similarity (sum of the
smaller weights over sum of the larger). ``a`` follows from (word, t) alone and
is continuous, so the least ``ln a`` itself stands for the sample: the signature
is ``SAMPLES`` minima, 16 bits of each, the likeness of two signatures the share that are
equal. (Different samples agree in their 16 bits once in 65,536 times.)

**Plan.** For the edited text every row needs its successor in descending id.
Rows go to buckets of id ranges (approximate quantiles of all ids; a repeated
id that spans several ranges is spread over them by its text's hash), each
bucket gets a copy of the row that follows its last one, and one shuffle by
bucket serves everything after it: the successor's text, the words, their
counts, the minima and the successor's signature. Word counts and minima are
hash aggregates over fixed-width values. All of it is DataFrame expressions.

Defined results: a null text is the empty text; the empty text has its own
constant signature, equal only to itself; equal ids are ordered by the hash of
their texts, null ids come last; a single row follows itself; an empty table
gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiergrain.llm.common import id_text

SAMPLES = 32
SPACE = r"[\x20\x09-\x0D]+"
_LOWEST = -(1 << 63)


def log_a(word_hash: Column, log_weight: Column, k: int) -> Column:
    """``ln a`` of one word for sample ``k``: gamma draws from two hashes."""
    h1, h2 = F.xxhash64(word_hash, F.lit(2 * k)), F.xxhash64(word_hash, F.lit(2 * k + 1))

    def uniform(h: Column, shift: int) -> Column:      # 26 bits, never 0
        bits = F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << 26) - 1))
        return (bits.cast("double") + 0.5) / float(1 << 26)

    r = -F.log(uniform(h1, 0) * uniform(h1, 26))
    c = -F.log(uniform(h2, 0) * uniform(h2, 26))
    b = (F.shiftrightunsigned(h1, 52) * 4096 + F.shiftrightunsigned(h2, 52)).cast("double") / float(1 << 24)
    return F.log(c) - r * (F.floor(log_weight / r + b).cast("double") - b + 1.0)


def compact(samples: Column) -> Column:
    """16 bits of every sample: what a fingerprint holds and likenesses compare."""
    return F.transform(samples, lambda x: F.xxhash64(x).bitwiseAND(F.lit(65535)))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples of two compact signatures (0 to 1)."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y).cast("int")), F.lit(0), lambda s, x: s + x)
    return equal.cast("double") / F.size(a)


def signature_text(samples: Column) -> Column:
    """Four hex digits for every sample."""
    return F.array_join(F.transform(samples, lambda x: F.lower(F.lpad(F.hex(x), 4, "0"))), "")


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    """``bucket``: ranges of the order (id, hash), about equally full."""
    key = F.coalesce("doc_id", F.lit(_LOWEST))
    rows = rows.withColumn("order_id", key).withColumn("order_hash", F.xxhash64("text"))
    at = [i / buckets for i in range(1, buckets)]
    edges = rows.agg(F.percentile_approx("order_id", at, max(10_000, 4 * buckets)).alias("e")).first().e if at else None
    if not edges:
        return rows.withColumn("bucket", F.lit(0))
    # two steps keep the search short for many buckets: coarse steps, then one step's edges
    step = max(1, math.isqrt(len(edges)))
    every = F.split(F.lit(",".join(map(str, edges))), ",").cast("array<bigint>")
    coarse = F.split(F.lit(",".join(map(str, edges[step - 1::step]))), ",").cast("array<bigint>")

    def below(strict: bool) -> Column:
        less = (lambda e: e < F.col("order_id")) if strict else (lambda e: e <= F.col("order_id"))
        whole = F.size(F.filter(coarse, less)) * step
        return whole + F.size(F.filter(F.slice(every, whole + 1, step), less))

    share = (F.shiftrightunsigned("order_hash", 11).cast("double") / float(1 << 53))
    return rows.withColumn("lo", below(True)).withColumn("hi", below(False)).withColumn(
        "bucket", F.col("lo") + F.floor(share * (F.col("hi") - F.col("lo") + 1)).cast("int")).drop("lo", "hi")


def with_successors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    buckets: int | None = None) -> DataFrame:
    """``bucket``, ``rn``, ``doc_id``, ``text``, ``following`` in descending id.

    Every bucket ends with one row more (``extra``): the first row after it,
    for the last bucket the very first row.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _bucketed(id_text(docs, id_col, text_col), buckets)
    # the hash orders like its unsigned value, which the buckets' shares follow too
    high = F.shiftrightunsigned("order_hash", 11)
    first = rows.groupBy("bucket").agg(F.max(F.struct("order_id", high.alias("high"), "order_hash")).alias("top")) \
        .select("bucket", "top.order_id", "top.order_hash")
    # at most one row of three numbers per bucket
    heads = rows.join(F.broadcast(first), ["bucket", "order_id", "order_hash"]).dropDuplicates(["bucket"])
    used = sorted(r.bucket for r in rows.select("bucket").distinct().collect())      # at most ``buckets`` numbers
    before = {b: used[(i + 1) % len(used)] for i, b in enumerate(used)}              # the bucket it follows
    owner = F.split(F.lit(",".join(str(before.get(b, -1)) for b in range(buckets))), ",").cast("array<int>")
    ends = heads.select(F.get(owner, F.col("bucket")).alias("bucket"), "doc_id", "text",
                        F.lit(0).cast("long").alias("order_id"), F.lit(0).cast("long").alias("order_hash"),
                        F.lit(1).alias("extra"))
    both = rows.select("bucket", "doc_id", "text", "order_id", "order_hash", F.lit(0).alias("extra")).unionByName(ends)
    w = Window.partitionBy("bucket").orderBy(
        "extra", F.col("order_id").desc(), F.shiftrightunsigned("order_hash", 11).desc(), F.col("order_hash").desc())
    return both.select("bucket", F.row_number().over(w).alias("rn"), "doc_id", "text", "extra",
                       F.lead("text").over(w).alias("following"))


def edited_text(text: Column, following: Column) -> Column:
    """The last floor(n / 2) code points replaced by as many of the next text."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - half),
                    F.substr(F.coalesce(following, F.lit("")), F.lit(1), half))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          samples: int = SAMPLES, buckets: int | None = None) -> DataFrame:
    """Signatures of every text, of its edited text, and their likenesses.

    ``doc_id``, ``n_chars``, ``edited_sha256``, ``samples``, ``edited_samples``
    (16-bit numbers), ``near_edited``, ``near_next``.
    """
    rows = with_successors(docs, id_col, text_col, buckets)
    rows = rows.select("bucket", "rn", "doc_id", "text", "extra",
                       edited_text(F.col("text"), F.col("following")).alias("edited"))
    # side 2 carries the row's own values through the aggregates, as a single word
    own = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.length("text").cast("string"),
                      F.col("extra").cast("string"), F.sha2("edited", 256))
    sides = rows.select("bucket", "rn", F.posexplode(F.array(F.lower("text"), F.lower("edited"), own))
                        .alias("side", "body"))
    words = sides.select("bucket", "rn", "side", F.explode(F.split("body", SPACE)).alias("word"))
    weighed = words.groupBy("bucket", "rn", "side", "word").agg(F.count("*").alias("tf"))
    value = F.split("word", r"\|")

    def number(i: int, at: int | None = None) -> Column:
        part = F.get(value, F.lit(i))
        if at is not None:
            part = F.conv(F.substr(part, F.lit(at), F.lit(16)), 16, -10)
        return F.when((F.col("side") == 2) & (part != ""), part.cast("long"))

    meta = {"id": number(0), "n": number(1), "x": number(2),
            **{f"s{i}": number(3, 16 * i + 1) for i in range(4)}}
    terms = weighed.select(
        "bucket", "rn", "side", *[v.alias(k) for k, v in meta.items()],
        F.when((F.col("word") != "") & (F.col("side") < 2), F.xxhash64("word")).alias("h"),
        F.log(F.col("tf").cast("double")).alias("ls"))
    minima = terms.groupBy("bucket", "rn", "side").agg(
        *[F.min(F.when(F.col("h").isNotNull(), log_a(F.col("h"), F.col("ls"), k))).alias(f"m{k}")
          for k in range(samples)], *[F.max(k).alias(k) for k in meta])
    packed = minima.select("bucket", "rn", "side", compact(F.array(*[f"m{k}" for k in range(samples)])).alias("m"),
                           F.struct(*meta).alias("meta"))
    w = Window.partitionBy("bucket").orderBy("rn", "side")
    lined = packed.select("side", "m", F.lead("m", 1).over(w).alias("edited"), F.lead("meta", 2).over(w).alias("meta"),
                          F.lead("m", 3).over(w).alias("next"))
    hexed = F.concat(*[F.lower(F.lpad(F.hex(F.col(f"meta.s{i}")), 16, "0")) for i in range(4)])
    return lined.where((F.col("side") == 0) & (F.col("meta.x") == 0)).select(
        F.col("meta.id").alias("doc_id"), F.col("meta.n").alias("n_chars"), hexed.alias("edited_sha256"),
        F.col("m").alias("samples"), F.col("edited").alias("edited_samples"),
        likeness(F.col("m"), F.col("edited")).alias("near_edited"),
        likeness(F.col("m"), F.col("next")).alias("near_next"))
