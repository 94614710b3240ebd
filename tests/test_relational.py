from pyspark.sql import Window
from pyspark.sql import functions as F

from tiergrain.operators.compliance import breach_flags, rule_report, threshold_rule
from tiergrain.operators.relational import left_lookup, pct_of, scalar_or_default, scan_bytes, top1_per_group


def test_left_lookup_keeps_unmatched_and_repeats_duplicates(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    dim = spark.createDataFrame([("a", "A1"), ("a", "A2"), ("b", "B")], "k string, name string")
    out = left_lookup(fact, dim, "k", "k", ["name"])
    got = sorted((r.id, r.name) for r in out.collect())
    assert got == [(1, "A1"), (1, "A2"), (2, "B"), (3, None)]


def test_scan_bytes_follows_the_files_and_runs_no_job(spark):
    from conftest import SF01
    small, large = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("nation", "lineitem"))
    spark.sparkContext.setJobGroup("scan-bytes", "")
    try:
        assert 0 < scan_bytes(small) < 100_000 < scan_bytes(large)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("scan-bytes")
    finally:
        spark.sparkContext.setJobGroup("tests", "")


def test_scalar_or_default(spark):
    src = spark.createDataFrame([(0.0,), (0.0,)], "v double")
    one = spark.range(1)
    assert one.select(scalar_or_default(F.sum("v"), src, 0.3).alias("x")).first().x == 0.3
    empty = src.filter(F.lit(False))
    assert one.select(scalar_or_default(F.avg("v"), empty, 1.0).alias("x")).first().x == 1.0
    src2 = spark.createDataFrame([(0.4,), (0.2,)], "v double")
    assert abs(one.select(scalar_or_default(F.avg("v"), src2, 9.0).alias("x")).first().x - 0.3) < 1e-12


def test_pct_of_zero_total_is_null(spark):
    r = spark.range(1).select(pct_of(F.lit(5.0), F.lit(0.0)).alias("p"), pct_of(F.lit(1.0), F.lit(4.0)).alias("q")).first()
    assert r.p is None and r.q == 25.0


def test_top1_matches_row_number(spark):
    rows = [("T1", "P1", "2001-01-01", "E1", 1.0), ("T1", "P1", "2001-04-01", "E2", 2.0),
            ("T1", "P1", "2001-04-01", "E3", 3.0), (None, "P1", "2000-01-01", "E4", 4.0),
            (None, "P1", None, "E5", 5.0), ("T2", "P2", None, "E6", 6.0)]
    df = spark.createDataFrame(rows, "t string, p string, d string, e string, v double").withColumn("d", F.col("d").cast("date"))
    got = sorted((tuple(r) for r in top1_per_group(df, ["t", "p"], ["d", "e"], ["v", "e"]).collect()), key=str)
    w = Window.partitionBy("t", "p").orderBy(F.col("d").desc_nulls_last(), F.col("e").desc_nulls_last())
    ref = sorted((tuple(r) for r in df.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
                 .select("t", "p", "v", "e").collect()), key=str)
    assert got == ref
    assert ("T1", "P1", 3.0, "E3") in got


def test_threshold_edges(spark):
    df = spark.createDataFrame([("a", 10.0), ("b", 8.0), ("c", 9.0), ("d", 10.5), ("e", None)], "k string, v double")
    rep = rule_report([threshold_rule(df, "R", F.col("v"), F.col("k"), 10.0, 0.8)], "2001-06-30")
    got = {r.entity: (r.is_breached, r.is_near_breach, r.severity) for r in rep.collect()}
    assert got["a"] == (False, True, "WARNING")   # exactly t: near, not breached
    assert got["b"] == (False, False, "CLEAR")    # exactly 0.8 t: clear
    assert got["c"][2] == "WARNING" and got["d"] == (True, False, "CRITICAL")
    assert got["e"][2] == "CLEAR"                 # null value: flags null -> CLEAR
    b, n = breach_flags(F.lit(1.0), 1.0)
    assert spark.range(1).select(b.alias("b"), n.alias("n")).first() == (False, True)
