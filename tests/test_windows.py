"""Windows in slices equal the plain window."""

import pytest
from pyspark.sql import functions as F

from tiergrain.operators.windows import SLICES, ordered_within


def skewed(spark):
    # key 'H' holds 2/3 of the rows; null key and ties included
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 != 0, F.lit("H")).when(F.col("id") % 7 == 0, F.lit(None))
         .otherwise(F.concat(F.lit("K"), (F.col("id") % 50).cast("string"))).alias("k"),
        (F.col("id") % 97).alias("o1"), F.col("id").alias("o2"), (F.col("id") % 13).cast("double").alias("x"))
    return df


@pytest.mark.parametrize("width", [1, 10, 1000])
def test_slices_match_the_plain_window(spark, width):
    df = skewed(spark)
    asked = dict(rank="rn", sums={"run": "x"}, leads={"next": "x", "next_o": "o2"})
    plain = ordered_within(df, ["k"], ["o1", "o2"], **asked)
    got = ordered_within(df, ["k"], ["o1", "o2"], F.col("o1").cast("long"), width, **asked)
    exp = {(r.k, r.o2): (r.rn, r.run, r.next, r.next_o) for r in plain.collect()}
    assert {(r.k, r.o2): (r.rn, r.run, r.next, r.next_o) for r in got.collect()} == exp and len(exp) == 3000
    assert got.schema == plain.schema and got.schema["rn"].dataType.typeName() == "integer"


def test_hot_key_is_spread_and_nothing_runs_while_built(spark):
    tracker = spark.sparkContext.statusTracker()
    df = skewed(spark)
    spark.sparkContext.setJobGroup("sliced-build", "")
    got = ordered_within(df, ["k"], ["o1", "o2"], F.col("o1").cast("long"), 1, rank="rn")
    spark.sparkContext.setJobGroup("tests", "")
    assert not tracker.getJobIdsForGroup("sliced-build")
    # the rows are shuffled once, by key and slice, and joined where they are
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = got.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    by_slice = [line for line in plan.splitlines() if "Exchange hashpartitioning(_key" in line]
    assert len([line for line in by_slice if "_slice" in line]) == 3 and len(by_slice) == 4, plan


def test_null_positions_negative_positions_and_an_empty_table(spark):
    df = spark.createDataFrame([("A", None, 3), ("A", None, 1), ("A", -5, 2), ("A", 0, 4), (None, -1, 5), (None, None, 6)],
                               "k string, o long, t int")
    asked = dict(rank="rn", sums={"s": "t"}, leads={"n": "t"})
    for rows in (df, df.limit(0)):
        exp = sorted(ordered_within(rows, ["k"], ["o", "t"], **asked).collect(), key=str)
        assert sorted(ordered_within(rows, ["k"], ["o", "t"], F.col("o"), 3, **asked).collect(), key=str) == exp


def test_next_value_that_is_null_is_not_skipped(spark):
    df = spark.createDataFrame([("A", 1, 7), ("A", 2, None), ("A", 3, 9)], "k string, o long, v int")
    got = {r.o: r.n for r in ordered_within(df, ["k"], ["o"], F.col("o"), 1, leads={"n": "v"}).collect()}
    assert got == {1: None, 2: 9, 3: None}


def test_running_sums_with_nulls_in_slices(spark):
    df = spark.range(400).select(F.lit("H").alias("k"), F.col("id").alias("o"),
                                 F.when((F.col("id") > 20) & (F.col("id") < 60), F.col("id").cast("double")).alias("x"))
    plain = {r.o: r.run for r in ordered_within(df, ["k"], ["o"], sums={"run": "x"}).collect()}
    got = {r.o: r.run for r in ordered_within(df, ["k"], ["o"], F.col("o"), 6, sums={"run": "x"}).collect()}
    assert got == plain and plain[0] is None and plain[399] is not None


def test_claim_versions_skip_dropped_ranks(spark):
    from tiergrain.params import TEST_PARAMS
    from tiergrain.plans.extensions import claim_versions
    rows = [("A", 1, "2001-01-01"), ("A", 3, "2001-03-01"), ("B", 2, "2001-02-01")]
    df = spark.createDataFrame(rows, "claim_id string, cumulative_paid_rank int, loss_date string").selectExpr(
        "*", "1.0d AS incurred_amount", "'OPEN' AS status")
    got = {(r.claim_id, r.cumulative_paid_rank): (r.valid_to, r.is_current)
           for r in claim_versions(df, TEST_PARAMS).collect()}
    assert got == {("A", 1): ("2001-03-01", False), ("A", 3): (None, True), ("B", 2): (None, True)}


def test_checkpoint_folder_is_required_on_a_cluster(spark, monkeypatch):
    import pytest
    from tiergrain import session

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Cluster())


def test_windows_over_kept_slices_share_one_shuffle(spark):
    """Ranks, then rows dropped, then sums and leads over the rest in the same slices."""
    df = skewed(spark)
    at, kept = F.col("o1").cast("long"), "o2 % 5 <> 0"
    ranked = ordered_within(df, ["k"], ["o1", "o2"], at, 10, rank="rn", keep_slices=True)
    assert ranked.columns == [*df.columns, "rn", *SLICES]
    asked = dict(sums={"run": "x"}, leads={"next": "o2"})
    got = ordered_within(ranked.where(kept), ["k"], ["rn"], at, 10, counts_from=df.where(kept),
                         counts_order=["o1", "o2"], **asked)
    plain = ordered_within(df, ["k"], ["o1", "o2"], rank="rn")
    exp = ordered_within(plain.where(kept), ["k"], ["rn"], **asked)
    assert got.columns == exp.columns
    assert sorted(got.collect(), key=str) == sorted(exp.collect(), key=str)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = got.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # rows once; counts by (key, slice), by key and for the join, for both windows
    assert plan.count("Exchange hashpartitioning(_key") == 1 + 2 * 3, plan


def test_a_slice_with_nothing_around_sends_no_row(spark):
    df = spark.range(500).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("k"), F.col("id").alias("o"))
    got = ordered_within(df, ["k"], ["o"], F.col("o"), 10, rank="rn", sums={"s": "o"})
    assert {(r.k, r.o, r.rn, r.s) for r in got.collect()} == {(f"K{i}", i, 1, i) for i in range(500)}
    plan = got.select("*")._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(_n_before" in plan and "isnotnull(_b_s" in plan, plan
