import tempfile

from pyspark.sql import functions as F

from tiergrain.operators.quality import DROP, WARN, RuleSet
from tiergrain.sources.sinks import publish_view, read_view
from tiergrain.streaming.refresh import append_stream, enrich_stream, full_refresh, read_enriched

TRADE_SCHEMA = "trade_id string, security_id string, qty double"
RULES = RuleSet.of("t", DROP, {"positive_qty": "qty > 0"})


def _land(spark, rows, path):
    spark.createDataFrame(rows, TRADE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_point_in_time_dimension_and_exactly_once(spark):
    base = tempfile.mkdtemp(prefix="tg-stream-")
    src, sink, ckpt, dims = f"{base}/src", f"{base}/sink", f"{base}/ckpt", f"{base}/dims"
    schema = spark.createDataFrame([], TRADE_SCHEMA).schema
    publish_view(spark.createDataFrame([("SEC-1", "old")], "security_id string, name string"), dims)

    def enrich(batch):
        return batch.join(read_view(spark, dims), "security_id", "left")

    _land(spark, [("T1", "SEC-1", 5.0), ("T2", "SEC-1", -1.0)], src)
    r1 = enrich_stream(spark, src, schema, sink, ckpt, enrich, RULES)
    publish_view(spark.createDataFrame([("SEC-1", "new")], "security_id string, name string"), dims)
    _land(spark, [("T3", "SEC-1", 7.0)], src)
    r2 = enrich_stream(spark, src, schema, sink, ckpt, enrich, RULES)
    got = {r.trade_id: r.name for r in read_enriched(spark, sink).collect()}
    assert got == {"T1": "old", "T3": "new"}
    assert r1.metrics == {"_evaluated": 2, "positive_qty": 1} and r2.metrics["_evaluated"] == 1
    r3 = enrich_stream(spark, src, schema, sink, ckpt, enrich, RULES)
    assert r3.batches == 0 and read_enriched(spark, sink).count() == 2


def test_file_sink_rerun_and_full_refresh(spark):
    base = tempfile.mkdtemp(prefix="tg-stream-")
    src = f"{base}/src"
    schema = spark.createDataFrame([], TRADE_SCHEMA).schema
    warn = RuleSet("t", WARN, RULES.rules)
    _land(spark, [("T1", "S", 1.0), ("T2", "S", -2.0)], src)
    sink, ckpt = f"{base}/sink", f"{base}/ckpt"
    r = append_stream(spark, src, schema, sink, ckpt, ruleset=warn)
    assert r.metrics == {"_evaluated": 2, "positive_qty": 1}
    append_stream(spark, src, schema, sink, ckpt, ruleset=warn)
    assert spark.read.parquet(sink).count() == 2          # rerun adds nothing
    _land(spark, [("T3", "S", 3.0)], src)
    append_stream(spark, src, schema, sink, ckpt, ruleset=warn)
    assert spark.read.parquet(sink).count() == 3          # only the new file
    sink2, ckpt2 = full_refresh(spark, "t")
    append_stream(spark, src, schema, sink2, ckpt2, ruleset=RULES)
    assert sorted(x.trade_id for x in spark.read.parquet(sink2).collect()) == ["T1", "T3"]


def test_view_versions(spark):
    base = tempfile.mkdtemp(prefix="tg-view-") + "/v"
    p1 = publish_view(spark.range(3).withColumn("k", F.col("id") % 2), base, cluster_by=["k"])
    p2 = publish_view(spark.range(5), base)
    assert p1.endswith("version=00000001") and p2.endswith("version=00000002")
    assert read_view(spark, base).count() == 5


def test_write_table_overwrites(spark):
    from tiergrain.sources.sinks import write_table
    path = tempfile.mkdtemp(prefix="tg-raw-") + "/t"
    write_table(spark.range(5), path)
    write_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_row_count_audit(spark):
    from tiergrain.sources.sinks import row_count_audit
    a = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    out = {(r.table_name, r.check): (r.row_count, r.matching) for r in
           row_count_audit({"a": a, "b": spark.range(4)}, {"a": {"null_x": "x IS NULL"}}).collect()}
    assert out == {("a", "null_x"): (3, 1), ("b", None): (4, None)}


def test_metrics_count_every_batch_and_survive_a_restart(spark):
    import tempfile

    from tiergrain.streaming.refresh import batch_metrics
    base = tempfile.mkdtemp(prefix="tg-many-")
    spark.range(130).selectExpr("CAST(id AS int) AS id").repartitionByRange(130, "id").write.parquet(f"{base}/in")
    schema = spark.read.parquet(f"{base}/in").schema
    rules = RuleSet.of("many", "warn", {"small": "id < 100"})
    run = append_stream(spark, f"{base}/in", schema, f"{base}/out", f"{base}/ckpt", ruleset=rules, max_files=1)
    n = spark.read.parquet(f"{base}/out").count()
    assert n == 130 and run.batches > 100
    want = {"_evaluated": 130, "small": 30}
    assert {k: run.metrics[k] for k in want} == want
    assert {k: v for k, v in batch_metrics(spark, f"{base}/ckpt").items() if k in want} == want
    again = append_stream(spark, f"{base}/in", schema, f"{base}/out", f"{base}/ckpt", ruleset=rules, max_files=1)
    assert again.batches == 0 and batch_metrics(spark, f"{base}/ckpt")["_evaluated"] == 130


def test_micro_batches_are_bounded_by_bytes(spark):
    import os
    base = tempfile.mkdtemp(prefix="tg-bytes-")
    spark.range(4000).selectExpr("CAST(id AS int) AS id").repartitionByRange(8, "id").write.parquet(f"{base}/in")
    sizes = [os.path.getsize(f"{base}/in/{f}") for f in os.listdir(f"{base}/in") if f.endswith(".parquet")]
    schema = spark.read.parquet(f"{base}/in").schema
    few = append_stream(spark, f"{base}/in", schema, f"{base}/few", f"{base}/few-ckpt", max_bytes=2 * max(sizes))
    one = append_stream(spark, f"{base}/in", schema, f"{base}/one", f"{base}/one-ckpt", max_bytes=2 * sum(sizes))
    assert (few.batches, one.batches) == (4, 1)
    assert spark.read.parquet(f"{base}/few").distinct().count() == spark.read.parquet(f"{base}/one").count() == 4000


def test_number_of_micro_batches_does_not_grow_with_the_input(spark):
    from tiergrain.streaming.refresh import batch_bytes
    base = tempfile.mkdtemp(prefix="tg-number-")
    spark.range(12000).selectExpr("CAST(id AS int) AS id").repartitionByRange(24, "id").write.parquet(f"{base}/in")
    schema = spark.read.parquet(f"{base}/in").schema
    size = batch_bytes(spark, f"{base}/in", 1, 4)
    run = append_stream(spark, f"{base}/in", schema, f"{base}/out", f"{base}/ckpt", max_bytes=size)
    assert 4 <= run.batches <= 5 and spark.read.parquet(f"{base}/out").distinct().count() == 12000
    assert batch_bytes(spark, f"{base}/in", 1 << 30, 4) == 1 << 30


def test_streams_cut_a_refresh_into_few_micro_batches(spark, tmp_path):
    from pyspark.sql import functions as F
    from tiergrain.params import TEST_PARAMS
    from tiergrain.plans.streams import InvestmentStreams
    p = TEST_PARAMS.replace(stream_batch_bytes=1, stream_refresh_batches=3)
    for name, cols in {"part": ["p_partkey", "CAST('b' AS string) p_brand", "CAST('n' AS string) p_name", "CAST('t' AS string) p_type",
                                "CAST(id AS int) p_size"]}.items():
        spark.range(0, 4000, 1, 20).withColumn("p_partkey", F.col("id")).selectExpr(*cols).write.parquet(f"{tmp_path}/{name}.parquet")
    st = InvestmentStreams(spark, str(tmp_path), p)
    assert st.table("bronze_securities_master").count() == 4000
    files = spark.read.parquet(st.raw_dir("raw_securities_master")).inputFiles()
    assert len(files) > 5 and st.runs["bronze_securities_master"][0].batches <= 4
