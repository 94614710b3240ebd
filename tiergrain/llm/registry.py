"""Query keys of this subpackage: thin callables over the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiergrain.llm.common import table
from tiergrain.llm.oracle_sql import ORACLE  # noqa: F401  (read by the entry file)

MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tiergrain.llm.html_text import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tiergrain.llm.decontaminate import find_overlaps

    return find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tiergrain.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(MULTI_RANKS),
                        public_tokenizers.PATTERN)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tiergrain.llm.byte_bpe import encode_documents

    coded = encode_documents(table(spark, sf_dir, "documents"),
                             public_tokenizers.path(MULTI_RANKS), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tiergrain.llm.pii import KINDS, personal_data, span_text

    found = personal_data(table(spark, sf_dir, "documents"))

    def count(kind: str):
        no = KINDS.index(kind)
        return F.size(F.filter("base", lambda x: x["no"] == no)).cast("long").alias(f"n_{kind}")

    n = [count(k) for k in KINDS[:-1]]
    return found.select("doc_id", *n, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                        span_text(F.sort_array(F.concat("base", "added"))).alias("spans"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tiergrain.llm.simhash import hex_fingerprint, near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tiergrain.llm.license_scan import scan_licences

    found = scan_licences(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                        F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tiergrain.llm.substring_dedup import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tiergrain.llm.weighted_fingerprints import fingerprint_documents, signature_text

    found = fingerprint_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", signature_text(F.col("samples")).alias("fingerprint"),
                        signature_text(F.col("edited_samples")).alias("edited_fingerprint"),
                        "near_edited", "near_next")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tiergrain.llm.toxicity import grade_documents

    return grade_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tiergrain.llm.hard_negatives import mine_hard_negatives

    return mine_hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tiergrain.llm.quality import score_documents

    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tiergrain.llm.filter_audit import audit_filters

    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_decontaminate": op2_decontaminate,
    "op3_token_counts": op3_token_counts,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_pii": op5_pii,
    "op6_simhash": op6_simhash,
    "op7_licences": op7_licences,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_fingerprints": op9_fingerprints,
    "op10_toxicity": op10_toxicity,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_quality": op12_quality,
    "op13_filter_audit": op13_filter_audit,
}
