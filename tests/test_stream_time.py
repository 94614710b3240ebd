"""Event-time windows with late rows, stream-stream joins and quantile sketches on small rows."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tiergrain.operators import sketches
from tiergrain.streaming import joins
from tiergrain.streaming.event_windows import EventWindows, Measure

SECOND = 1_000_000
ROWS = "id long, k string, s long"


def folder():
    return tempfile.mkdtemp(prefix="tiergrain-time-")


def timed(spark, rows):
    return spark.createDataFrame(rows, ROWS).select("id", "k", F.timestamp_seconds("s").alias("ts"))


def arrivals(seed):
    """Three arrivals, times falling back by up to 60 s; key h holds most rows; null keys and times."""
    rng = random.Random(seed)
    rows, at = [], 0
    for i in range(300):
        at += rng.randrange(4)
        rows.append((i, "h" if rng.random() < 0.7 else rng.choice(["a", None]),
                     None if i % 50 == 7 else max(0, at - rng.choice([0, 0, 0, 5, 60]))))
    return rows[:100], rows[100:200], rows[200:]

def measures():
    return {"n": Measure(F.count("*"), F.sum), "last_id": Measure(F.max("id"), F.max)}


def windows(spark, slide=None):
    schema = timed(spark, []).schema
    return EventWindows(spark, folder(), schema, "ts", ["k"], measures(), 20 * SECOND, 15 * SECOND, slide and slide * SECOND)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_windows_equal_the_built_in_ones_and_no_row_is_lost(spark):
    """The same closed windows as Spark's append-mode aggregate; the rows that it drops are in ``late``."""
    ours, base = windows(spark), folder()
    parts = arrivals(1)
    for part in parts:
        timed(spark, part).coalesce(1).write.mode("append").parquet(f"{base}/in")
        ours.run(f"{base}/in")
        stream = spark.readStream.schema(timed(spark, []).schema).parquet(f"{base}/in").withWatermark("ts", "15 seconds")
        query = (stream.groupBy(F.window("ts", "20 seconds").alias("w"), "k").agg(F.count("*").alias("n"), F.max("id").alias("last_id"))
                 .writeStream.format("parquet").option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start(f"{base}/out"))
        query.awaitTermination()
    built_in = spark.read.parquet(f"{base}/out").select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "k", "n", "last_id")
    names = ["window_start", "k", "n", "last_id"]
    assert rows_of(ours.closed(), *names) == rows_of(built_in, *names)
    late = ours.late()
    total = sum(df.agg(F.sum("n")).first()[0] for df in (ours.closed(), ours.still_open())) + late.count()
    assert total == 300 and late.where("window_start IS NULL").count() == 6 and late.where("window_start IS NOT NULL").count() > 0
    assert ours.closed().groupBy("window_start", "k").count().where("count > 1").count() == 0
    assert ours.still_open().count() > 0


def test_a_repeated_batch_changes_nothing_and_an_unfinished_one_is_unseen(spark):
    ours = windows(spark)
    parts = [timed(spark, p) for p in arrivals(2)]
    assert ours.closed().count() == ours.still_open().count() == ours.late().count() == 0

    def state():
        return [rows_of(df, *df.columns) for df in (ours.closed(), ours.still_open(), ours.late())]
    for n, part in enumerate(parts):
        ours.apply(part, n)
        before = state()
        ours.apply(part, n)
        assert state() == before
    os.remove(f"{ours.base}/watermark/batch=2/_SUCCESS")          # as if the driver had been lost before the end of the batch
    assert ours.committed() == 1
    ours.apply(parts[2], 2)
    assert state() == before
    ours.apply(parts[0].limit(0), 3)   # an empty batch closes nothing
    assert state() == before


def test_sliding_windows(spark):
    ours = windows(spark, slide=8)
    part = arrivals(3)[0]
    ours.apply(timed(spark, part), 0)
    want = {}
    for _, k, s in part:
        for start in range(-16, 400, 8):
            if s is not None and start <= s < start + 20:
                want[start, k] = want.get((start, k), 0) + 1
    got = ours.closed().unionByName(ours.still_open())
    assert {(r.s, r.k): r.n for r in got.select(F.unix_micros(F.col("window_start").cast("timestamp")).alias("s"), "k", "n")
            .withColumn("s", (F.col("s") / SECOND).cast("long")).collect()} == want
    with pytest.raises(ValueError):
        windows(spark, slide=21)
    with pytest.raises(ValueError):
        EventWindows(spark, "x", timed(spark, []).schema, "ts", ["k"], {"window_end": measures()["n"]}, 1, 0)


LEFT, RIGHT = "a long, x long, s long", "b long, y long, s long"


def sides(seed):
    rng = random.Random(seed)
    left = [(None if i % 40 == 5 else 1 if rng.random() < 0.5 else rng.randrange(30), i, rng.randrange(900)) for i in range(120)]
    right = [(None if i % 40 == 6 else 1 if rng.random() < 0.3 else rng.randrange(30), i, rng.randrange(900)) for i in range(120)]
    return left, right


def joined(spark, left, right, seed):
    """Three refreshes; within 400 s arrivals are in any order."""
    base, rng = folder(), random.Random(seed)

    def rows(data, schema, at):
        df = spark.createDataFrame(data, schema)
        return df.withColumn(at, F.timestamp_seconds("s")).drop("s")

    def order(data):
        return sorted(data, key=lambda r: r[2] + rng.randrange(400))
    left, right = order(left), order(right)
    a = joins.Side(f"{base}/l", rows([], LEFT, "at").schema, "at", "401 seconds")
    b = joins.Side(f"{base}/r", rows([], RIGHT, "bt").schema, "bt", "401 seconds")
    for n in range(3):
        for data, side, schema in ((left, a, LEFT), (right, b, RIGHT)):
            rows(data[n * 40:n * 40 + 40], schema, side.at).coalesce(1).write.mode("append").parquet(side.folder)
        joins.join_streams(spark, a, b, [("a", "b")], "-10 SECONDS", "100 SECONDS", f"{base}/out", f"{base}/ck")
    joins.join_streams(spark, a, b, [("a", "b")], "-10 SECONDS", "100 SECONDS", f"{base}/out", f"{base}/ck")      # nothing new
    got = joins.read_joined(spark, f"{base}/out").select("a", "x", "b", "y", F.unix_seconds("at").alias("at"))
    batch = joins.bounded(rows(left, LEFT, "at"), rows(right, RIGHT, "bt"), "at", "bt", [("a", "b")],
                          "-10 SECONDS", "100 SECONDS", "left_outer").select("a", "x", "b", "y", F.unix_seconds("at").alias("at"))
    return [tuple(r) for r in got.collect()], [tuple(r) for r in batch.collect()]


def test_stream_join_equals_the_batch_join_for_any_order_of_arrival(spark):
    left, right = sides(4)
    first, want = joined(spark, left, right, 1)
    second, _ = joined(spark, left, right, 2)
    assert sorted(first, key=str) == sorted(second, key=str)
    mark = min(max(r[2] for r in left), max(r[2] for r in right)) - 401
    due = [r for r in want if r[2] is not None or r[4] + 100 < mark]
    assert sorted(first, key=str) == sorted(due, key=str)
    assert any(r[2] is None for r in due) and any(r[2] is not None for r in due)


def arriving(seed):
    """Refreshes of a left and a right side: rows later than any delay, null keys and times, a refresh with one side only."""
    rng, at, n = random.Random(seed), 5000, 0
    for both in (True, True, False, True):
        at += 300
        data = [[], []]
        for rows in data[:2 if both else 1]:
            for _ in range(40):
                n += 1
                rows.append((None if n % 23 == 5 else 1 if rng.random() < 0.4 else rng.randrange(8), n,
                             None if n % 29 == 7 else at - rng.choice([0, rng.randrange(100), rng.randrange(900)])))
        yield data


@pytest.mark.parametrize("how, lower, upper", [("left_outer", "-10 SECONDS", "100 SECONDS"), ("left_outer", "-200 SECONDS", "-20 SECONDS"),
                                               ("inner", "20 SECONDS", "150 SECONDS")])
def test_stream_join_equals_the_built_in_one_without_its_state_stores(spark, how, lower, upper):
    """After every refresh the same rows as Spark's own join; what waits is parquet, not a store in the executors' memory."""
    base = folder()

    def rows(data, schema, at):
        return spark.createDataFrame(data, schema).withColumn(at, F.timestamp_seconds("s")).drop("s")
    a = joins.Side(f"{base}/l", rows([], LEFT, "at").schema, "at", "1 minute 30 seconds")
    b = joins.Side(f"{base}/r", rows([], RIGHT, "bt").schema, "bt", "60 seconds")
    sizes = []
    for data in arriving(7):
        for part, side, schema in zip(data, (a, b), (LEFT, RIGHT)):
            if part:
                rows(part, schema, side.at).coalesce(1).write.mode("append").parquet(side.folder)
        joins.join_streams(spark, a, b, [("a", "b")], lower, upper, f"{base}/out", f"{base}/ck", how)
        left, right = (joins.read_stream(spark, s.folder, s.schema).withWatermark(s.at, s.delay) for s in (a, b))
        query = (joins.bounded(left, right, "at", "bt", [("a", "b")], lower, upper, how).writeStream.format("parquet")
                 .option("checkpointLocation", f"{base}/ck_built_in").trigger(availableNow=True).start(f"{base}/built_in"))
        query.awaitTermination()
        built_in = spark.read.parquet(f"{base}/built_in")
        want = rows_of(built_in, *built_in.columns)
        assert rows_of(joins.read_joined(spark, f"{base}/out"), *built_in.columns) == want
        sizes.append(len(want))
    assert 0 < sizes[0] < sizes[-1]
    assert not os.path.exists(f"{base}/ck/state") and os.path.exists(f"{base}/ck_built_in/state")


def test_stream_join_repeats_a_batch_and_drops_what_has_expired(spark):
    base = folder()

    def rows(data, schema, at):
        return spark.createDataFrame(data, schema).withColumn(at, F.timestamp_seconds("s")).drop("s")
    sides = [joins.Side(f"{base}/{at}", rows([], schema, at).schema, at, "10 seconds") for schema, at in ((LEFT, "at"), (RIGHT, "bt"))]

    def batch(first, left, right):
        for n, repeat in ((first, False), (first, True)):        # as after a driver lost before Spark's commit
            parts = [rows(data, schema, at).select(F.struct("*").alias(name))
                     for data, schema, at, name in ((left, LEFT, "at", "l"), (right, RIGHT, "bt", "r"))]
            join = joins._Join(spark, tuple(sides), [("a", "b")], "0 SECONDS", "20 SECONDS", f"{base}/out", f"{base}/ck", "left_outer")
            join.apply(parts[0].unionByName(parts[1], allowMissingColumns=True), n)
        join.expire()
        return rows_of(joins.read_joined(spark, f"{base}/out"), "x", "y")
    assert batch(0, [(1, 10, 100), (1, 10, 100), (2, 11, 100)], [(1, 20, 110)]) == [(10, 20), (10, 20)]
    assert batch(1, [(3, 12, 1000)], [(1, 21, 120), (3, 22, 1000)]) == sorted(
        [(10, 20), (10, 20), (10, 21), (10, 21), (11, None), (12, 22)], key=str)
    batch(2, [(4, 13, 1005)], [(4, 23, 1006)])
    kept = sorted(n for n in os.listdir(f"{base}/ck-state") if not n.startswith("."))
    assert kept == ["left_step=2", "left_step=4", "right_step=2", "right_step=4"]
    with pytest.raises(ValueError):
        joins._Join(spark, tuple(sides), [("a", "b")], "0 SECONDS", "1 MONTH", f"{base}/out", f"{base}/ck", "inner")


def test_stream_join_refuses_what_it_cannot_do(spark):
    a = spark.createDataFrame([], "a long, at timestamp")
    with pytest.raises(ValueError):
        joins.bounded(a, a, "at", "at", [("a", "a")], "0 SECONDS", "1 SECONDS", "inner")
    with pytest.raises(ValueError):
        joins.bounded(a, a.toDF("b", "bt"), "at", "bt", [("a", "b")], "0 SECONDS", "1 SECONDS", "full_outer")


def test_merged_quantiles_keep_the_rank_bound(spark):
    df = spark.range(50_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 40).alias("d"),
                                    F.when(F.col("id") % 3 != 2, (F.col("id") * 7919) % 50_021).alias("v"))
    ranks = {"low": 0.05, "mid": 0.5, "top": 0.99}
    daily = sketches.daily_quantiles(df, ["g"], F.col("d"), "v")
    got = {r.g: r for r in sketches.merged_quantiles(daily, ["g"], ranks).collect()}
    for g in (0, 1):
        values = sorted(r.v for r in df.where(F.col("g") == g).select("v").collect())
        for name, rank in ranks.items():
            at = sum(v <= got[g][name] for v in values) / len(values)
            assert abs(at - rank) <= sketches.RANK_ERROR + 1 / len(values)
    assert tuple(got[2]) == (2, None, None, None)
    assert sketches.merged_quantiles(daily.limit(0), ["g"], ranks).count() == 0
