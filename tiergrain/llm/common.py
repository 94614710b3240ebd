"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiergrain.session import shared_dir

_memos: dict[str, Callable[[], None]] = {}      # of this Python worker: operator -> what empties its memo tables
_ran: list[str] = []                            # the operator that this Python worker ran last
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on; a null text is the empty text.

    Selecting them by name first keeps extra input columns, also ones that
    clash with an operator's own names, out of its plan.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would change other letters too)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage without keeping blocks on executors, so a lost executor
    costs a reread instead of a recomputation. The write's shuffle files go
    when it is done.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.select("*").write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def may_be_in(keys: DataFrame, column: str, bits: int) -> Column:
    """A test of ``column`` (an evenly spread long): false only for values that ``keys[column]`` does not have.

    The values set bits in a field of ``bits`` bits, which is all that the driver and the tasks
    get, whatever the number of keys; the test runs in the JVM.
    """
    slot = F.pmod(F.col(column), F.lit(bits))
    word, bit = F.shiftright(slot, 6).cast("int"), (slot % 64).cast("int")
    set_bits = keys.select(word.alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("b"))
    field = [0] * (bits // 64)
    for r in set_bits.groupBy("w").agg(F.bit_or("b").alias("b")).collect():      # at most ``bits`` / 64 rows
        field[r.w] = r.b
    packed = F.split(F.lit(",".join(map(str, field))), ",").cast("array<bigint>")      # folded to one literal
    return F.getbit(F.element_at(packed, word + 1), bit) == 1


def only_memos_of(operator: str, release: Callable[[], None] | None = None) -> None:
    """Empty the memo tables that other operators' tasks left in this Python worker; ``release`` empties the caller's.

    What they and their batches took goes back to the system, once at each change of operator. Spark reuses Python workers, so the stages of a pipeline would otherwise hold their tables
    all at once. Call it from module-level code: functions pickled by value have tables of their own.
    """
    for other in [o for o in _memos if o != operator]:
        _memos.pop(other)()
    if _ran != [operator]:
        _ran[:] = [operator]
        _give_back()
    if release is not None:
        _memos[operator] = release


def _give_back() -> None:
    """Hand freed memory, which the allocators keep for later, back to the system (malloc's where it is glibc)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
