"""Reconciliation, text sources, sketches, streaming dedup."""

import tempfile
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiergrain.operators import sketches
from tiergrain.sources import reconcile as R
from tiergrain.sources import text_files as X
from tiergrain.streaming.dedup import dedup_stream, read_deduplicated


def folder():
    return tempfile.mkdtemp(prefix="tiergrain-test-")


def test_reconcile_reads_differing_ranges_only_and_counts_copies(spark):
    old = [(i, f"v{i}") for i in range(200)] + [(5, "v5")] * 3 + [(None, "x"), (7, None)]
    new = [r for r in old if r[0] not in (3, 9)] + [(500, "n"), (9, "w"), (7, None), (None, "x")]
    new.remove((5, "v5"))
    a, b = folder(), folder()
    for rows, base in ((old, a), (new, b)):
        R.write_digested(spark.createDataFrame(rows, "k int, v string"), base, ["k"], ranges=16)
    got = R.reconcile(spark, a, b, ["k"])
    x, y = Counter(old), Counter(new)
    want = [(*r, "changed_from" if any(s[0] == r[0] for s in y) else "removed", n) for r, n in (x - y).items()]
    want += [(*r, "changed_to" if any(s[0] == r[0] for s in x) else "added", n) for r, n in (y - x).items()]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    differ = R.differing_ranges(spark, a, b)
    assert 0 < len(differ) <= 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == plan.count("PartitionFilters: [_range") >= 2      # no other folder is scanned
    assert R.reconcile(spark, a, a, ["k"]).count() == 0


SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("c", T.DoubleType())])


def test_no_line_is_lost_and_every_broken_one_has_its_reason(spark):
    lines = ["1,x,2.5", "2,,", '3,"p,q",1', "4,y", "5,y,1,2", "z,y,1", "6,y,oops", "7,é,1e3"]
    base = folder()
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{base}/csv")
    rows = X.read_delimited(spark, f"{base}/csv", SCHEMA)
    assert sorted(map(tuple, X.clean(rows).collect())) == [(1, "x", 2.5), (2, None, None), (3, "p,q", 1.0), (7, "é", 1000.0)]
    assert {(r.line, r.reason) for r in X.broken(rows, SCHEMA, ",").collect()} == {
        ("4,y", "missing_field"), ("5,y,1,2", "surplus_field"), ("z,y,1", "bad_value"), ("6,y,oops", "bad_value")}
    assert X.clean(rows).select("b").count() == 4              # fewer columns, same judgement

    lines = ['{"a":1,"b":"x","c":2.5}', '{"a":2}', '{"a":"z"}', '{"a":3,"d":1}', '{"a":4', "", "[]", "null"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{base}/json")
    rows = X.read_json(spark, f"{base}/json", SCHEMA)
    kept, gone = X.clean(rows).collect(), X.broken(rows, SCHEMA).collect()
    assert sorted((r.a, r.b, r.c) for r in kept) == [(1, "x", 2.5), (2, None, None)] and len(kept) + len(gone) == len(lines)
    reasons = {r.line: r.reason for r in gone}
    assert reasons['{"a":"z"}'] == "bad_value" and reasons['{"a":3,"d":1}'] == "surplus_field"
    assert reasons['{"a":4'] == reasons[""] == reasons["[]"] == reasons["null"] == "not_json"


def test_merged_sketches_equal_direct_ones_and_keep_the_bound(spark):
    df = spark.range(60_000).select((F.col("id") % 7).alias("g"), (F.col("id") % 30).alias("d"), (F.col("id") % 20_011).alias("v"))
    daily = sketches.daily_sketches(df, ["g"], F.col("d"), "v")
    merged = {r.g: r.n for r in sketches.merged_counts(daily, ["g"], "n").collect()}
    direct = {r.g: r.n for r in df.groupBy("g").agg(F.hll_sketch_estimate(F.hll_sketch_agg("v", F.lit(sketches.LOG_SIZE))).alias("n")).collect()}
    exact = {r.g: r.n for r in df.groupBy("g").agg(F.count_distinct("v").alias("n")).collect()}
    for g, n in exact.items():
        assert abs(direct[g] - n) <= 4 * sketches.STANDARD_ERROR * n
        assert abs(merged[g] - n) <= 4 * sketches.STANDARD_ERROR * n


def test_dedup_over_refreshes_and_a_bounded_delay(spark):
    base = folder()
    schema = "id long, ts timestamp, x long"

    def refresh(rows, delay="1 hour"):
        spark.createDataFrame(rows, "id long, s long, x long").select("id", F.timestamp_seconds("s").alias("ts"), "x") \
            .coalesce(1).write.mode("append").parquet(f"{base}/in")
        return dedup_stream(spark, f"{base}/in", spark.createDataFrame([], schema).schema, f"{base}/out", f"{base}/ck",
                            ["id"], "ts", delay)

    assert refresh([(1, 100, 1), (1, 100, 1), (2, 200, 1), (None, 200, 1), (None, 200, 1)]) == 2
    assert refresh([(1, 100, 2), (3, 300, 2)]) == 3
    assert refresh([(4, 400, 3)]) == 3
    assert sorted((r.id or 0) for r in read_deduplicated(spark, f"{base}/out").collect()) == [0, 1, 2, 3, 4]
