"""Corpus pipeline: documents through five training-data operators in order.

``STAGES`` lists ``(name, function)``; every function takes ``(spark, docs,
sf_dir)`` and returns a frame, which is written and read again before the next.
All stages but the last return the columns of ``docs``.

1. toxicity: documents whose grade is at least mild (P >= 1/2) go;
2. near_duplicates: one document of each SimHash group stays, the one with the
   least id (of equal rows one);
3. decontamination: documents that overlap a benchmark item go;
4. personal_data: every span found is replaced by its kind in brackets;
5. bpe: texts are encoded and decoded; ids and bytes are reported as digests.

Clean documents pass all filters unchanged. Null ids and repeated rows pass like
any others; rows meet an operator's decisions by id and text hash. SQL cannot
express a stage, so there is no oracle; tests compare every stage with
plain code.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiergrain.llm import toxicity as tox
from tiergrain.llm.byte_bpe import encode_documents
from tiergrain.llm.common import stored, table
from tiergrain.llm.decontaminate import find_overlaps
from tiergrain.llm.pii import personal_data, redact
from tiergrain.llm.simhash import near_duplicates

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _text(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit(""))


def _same(docs: DataFrame, decided: DataFrame) -> Column:
    """Join condition: id (nulls equal) and text hash."""
    return docs["doc_id"].eqNullSafe(decided["d_id"]) & (F.xxhash64(_text(docs)) == decided["d_key"])


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = tox.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(~model.column(F.col("text"))["toxic"])


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = near_duplicates(docs).groupBy("root", "doc_id", "key").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "n")).alias("m")
    stay = stored(rows.groupBy("root").agg(first).select(
        F.col("m.doc_id").alias("d_id"), F.col("m.key").alias("d_key"), "m.n"), "pipeline-groups")
    kept = docs.join(stay, _same(docs, stay), "left_semi")
    if stay.where("n > 1").isEmpty():
        return kept
    # the same id and text several times: one of these rows stays
    once, often = stay.where("n = 1"), stay.where("n > 1")
    again = docs.join(often, _same(docs, often), "left_semi")
    key = _free(docs, "d_key")
    return docs.join(once, _same(docs, once), "left_semi").unionByName(
        again.withColumn(key, F.xxhash64(_text(again))).dropDuplicates(["doc_id", key]).drop(key))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = find_overlaps(docs, table(spark, sf_dir, "benchmark"))
    gone = found.select(F.col("doc_id").alias("d_id"), F.col("key").alias("d_key")).distinct()
    return docs.join(gone, _same(docs, gone), "left_anti")


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = personal_data(docs).select(F.col("doc_id").alias("d_id"), F.col("key").alias("d_key"),
                                       F.sort_array(F.concat("base", "added")).alias("d_spans"))
    found = found.where(F.size("d_spans") > 0).distinct()
    both = docs.join(found, _same(docs, found), "left")
    spans = found["d_spans"]
    text = F.when(spans.isNotNull(), redact(docs["text"], spans)).otherwise(docs["text"])
    out = both.select(*[text.alias(c) if c == "text" else docs[c] for c in docs.columns])
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else out


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = encode_documents(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicate),
    ("decontamination", decontamination),
    ("personal_data", redaction),
    ("bpe", bpe),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
