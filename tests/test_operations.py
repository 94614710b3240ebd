"""Sliced windows, interval joins, fail-the-update and change application on small and skewed rows."""

import random
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tiergrain.operators import intervals, sliced
from tiergrain.operators.quality import RuleSet
from tiergrain.sources import updates
from tiergrain.sources.changes import ChangeTable, crowded, history_of
from tiergrain.sources.sinks import read_view

WIDTH = 10


def skewed(seed, n=600):
    """(id, k, p, v): key 1 holds two thirds of the rows; null keys and positions."""
    rng = random.Random(seed)
    rows = [(i, 1 if rng.random() < 0.67 else rng.choice([2, 3, None]), rng.choice([None, rng.randrange(-40, 200)])
             if rng.random() < 0.05 else rng.randrange(-40, 200), rng.choice([None, rng.randrange(50)])) for i in range(n)]
    return rows


SCHEMA = "id long, k int, p long, v long"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_slices_equal_plain_windows(spark):
    df = spark.createDataFrame(skewed(1), SCHEMA)
    timed = df.where("p IS NOT NULL")
    w = Window.partitionBy("k").orderBy("p", "id")
    lagged = sliced.previous_in_order(df, ["k"], F.col("p"), ["id"], ["id", "v"], WIDTH)
    want = timed.withColumn("previous_id", F.lag("id").over(w)).withColumn("previous_v", F.lag("v").over(w))
    assert rows_of(lagged.where("p IS NOT NULL")) == rows_of(want)
    assert {(r.previous_id, r.previous_v) for r in lagged.where("p IS NULL").collect()} == {(None, None)}

    ranked = sliced.dense_rank_in_order(df, ["k"], F.col("p"), "rank", WIDTH)
    want = timed.withColumn("rank", F.dense_rank().over(Window.partitionBy("k").orderBy("p")).cast("long"))
    assert rows_of(ranked.where("p IS NOT NULL")) == rows_of(want) and ranked.count() == df.count()

    frames = {"s": F.sum("v"), "a": F.min("v"), "z": F.max("v"), "n": F.count("*")}
    for span in (0, 7, 25):
        got = sliced.rolling(df, ["k"], F.col("p"), span, frames, WIDTH)
        r = Window.partitionBy("k").orderBy("p").rangeBetween(-span, 0)
        want = timed.select("*", *[c.over(r).alias(n) for n, c in frames.items()])
        assert rows_of(got.where("p IS NOT NULL")) == rows_of(want) and got.count() == df.count()


def test_no_task_needs_a_whole_key(spark):
    df = spark.createDataFrame(skewed(2), SCHEMA).where("p IS NOT NULL")
    per = df.groupBy("k", ((F.col("p") - F.pmod("p", F.lit(WIDTH))) / WIDTH).cast("long").alias("s")).count()
    assert max(r["count"] for r in per.collect()) < 0.15 * df.where("k = 1").count()
    for out in (sliced.previous_in_order(df, ["k"], F.col("p"), ["id"], ["v"], WIDTH),
                sliced.rolling(df, ["k"], F.col("p"), 5, {"s": F.sum("v")}, WIDTH)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "_slice" in plan.split("Window", 1)[1]


def test_asof_join_equals_a_scan(spark):
    rng = random.Random(3)
    left = [(i, rng.choice([1, 1, 1, 2, 9, None]), rng.choice([None, *range(-30, 200)])) for i in range(300)]
    right = [(rng.choice([1, 1, 2, 3, None]), rng.choice([None, *range(-30, 190, 7)]), i, rng.choice([None, i])) for i in range(120)]
    got = sliced.asof_join(spark.createDataFrame(left, "id long, k int, p long"),
                           spark.createDataFrame(right, "k int, q long, r long, x long"), ["k"], F.col("p"), F.col("q"),
                           ["r", "x"], "r", WIDTH)
    want = []
    for i, k, p in left:
        able = [(q, r, x) for kk, q, r, x in right if kk is not None and kk == k and q is not None and p is not None and q <= p]
        best = max(able, key=lambda t: t[:2], default=(None, None, None))
        want.append((i, k, p, best[1], best[2]))
    assert rows_of(got) == sorted(want, key=str)


def test_sessions_cross_slices_and_hot_users(spark):
    rng = random.Random(4)
    rows = [(i, 1 if i % 3 else 2, rng.randrange(0, 4000)) for i in range(400)] + [(1000, None, 5), (1001, None, 6), (1002, 1, None)]
    df = spark.createDataFrame(rows, "id long, k int, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = sliced.sessions(df, ["k"], "ts", ["id"], gap=20_000_000, width=60_000_000)
    got = sorted(((r.k, int(r.session_start.timestamp()), int(r.session_end.timestamp()), r.n) for r in got.collect()), key=str)
    want = []
    for k in (1, 2, None):
        times = sorted(s for _, kk, s in rows if kk == k and s is not None)
        for j, s in enumerate(times):
            if j and s - times[j - 1] <= 20:
                want[-1] = (*want[-1][:2], s, want[-1][3] + 1)
            else:
                want.append((k, s, s, 1))
    import datetime as dt
    off = int(dt.datetime.fromtimestamp(0).timestamp())
    assert [(k, a - off, z - off, n) for k, a, z, n in got] == sorted(want, key=str)


@pytest.mark.parametrize("hot", [1_000_000, 20])
def test_interval_joins_equal_nested_loops(spark, hot):
    rng = random.Random(5)
    points = [(i, rng.choice([7] * 6 + [*range(-50, 300), None]), rng.choice([1, 2, None])) for i in range(400)]
    spans = [(i, a := rng.randrange(-60, 300), a + rng.choice([-3, 0, 1, 5, 40, 160]), rng.choice([1, 2, None])) for i in range(120)]
    spans += [(500, None, 5, 1), (501, 5, None, 1)]
    p = spark.createDataFrame(points, "i long, at long, k int")
    s = spark.createDataFrame(spans, "j long, a long, z long, k int")
    got = intervals.points_in_periods(p, s, "at", "a", "z", 10, ["k"], hot)
    fits = lambda x, a, z: None not in (x, a, z) and a <= x < z
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.i, r.j) for r in got.collect()) == sorted(
        (i, j) for i, x, k in points for j, a, z, kk in spans if k is not None and k == kk and fits(x, a, z))
    both = intervals.points_in_periods(p.drop("k"), s.drop("k"), "at", "a", "z", 25, hot_rows=hot)
    assert sorted((r.i, r.j) for r in both.collect()) == sorted(
        (i, j) for i, x, _ in points for j, a, z, _ in spans if fits(x, a, z))
    other = s.select(F.col("j").alias("jj"), F.col("a").alias("aa"), F.col("z").alias("zz"), "k")
    pairs = intervals.overlapping_periods(s, other, ("a", "aa"), ("z", "zz"), 10, ["k"], hot)
    real = [x for x in spans if None not in x and x[1] < x[2]]
    assert sorted((r.j, r.jj) for r in pairs.collect()) == sorted(
        (x[0], y[0]) for x in real for y in real if x[3] == y[3] and x[1] < y[2] and y[1] < x[2])


RULES = RuleSet.of("t", "fail", {"positive": "v > 0", "has_id": "id IS NOT NULL"})
ROW = "id long, v long"


def test_failed_refresh_leaves_the_version_before(spark):
    base = tempfile.mkdtemp(prefix="tiergrain-test-")
    good, bad = spark.createDataFrame([(1, 5), (2, 6)], ROW), spark.createDataFrame([(1, 5), (2, -6), (None, None)], ROW)
    assert updates.refresh_or_fail(bad, base, RULES) == updates.Attempt(False, 3, {"positive": 2, "has_id": 1})
    with pytest.raises(FileNotFoundError):
        read_view(spark, base)
    assert updates.refresh_or_fail(good, base, RULES).committed
    assert not updates.refresh_or_fail(bad, base, RULES).committed
    assert rows_of(read_view(spark, base)) == [(1, 5), (2, 6)]
    assert updates.refresh_or_fail(good.limit(0), base, RULES).committed
    assert rows_of(read_view(spark, base)) == []


def test_failed_stream_batch_stays_hidden_and_is_repeated(spark):
    base = tempfile.mkdtemp(prefix="tiergrain-test-")
    land = lambda rows: spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(f"{base}/in")
    schema = spark.createDataFrame([], ROW).schema
    run = lambda t: updates.append_or_fail(spark, f"{base}/in", schema, f"{base}/out", f"{base}/ck", RULES, t)
    seen = lambda: rows_of(updates.read_appended(spark, f"{base}/out", schema))
    assert seen() == []
    land([(1, 1)])
    run(lambda df: df)
    land([(2, -2), (3, 3)])
    for _ in range(2):
        with pytest.raises(updates.ExpectationFailed) as e:
            run(lambda df: df)
        assert e.value.failed == {"positive": 1} and seen() == [(1, 1)]
    run(lambda df: df.withColumn("v", F.abs("v")))            # mended: the same batch goes through
    assert seen() == [(1, 1), (2, 2), (3, 3)]
    run(lambda df: df)
    assert seen() == [(1, 1), (2, 2), (3, 3)]


def test_changes_in_any_order_and_repeated(spark):
    rng = random.Random(6)
    rows = list({(k, s): (k, s, rng.choice(["upsert", "upsert", "delete"]), rng.randrange(100))
                 for k, s in ((rng.choice([1, 1, 1, 2, 3]), rng.randrange(200)) for _ in range(150))}.values())
    want = []
    for k in (1, 2, 3):
        own = sorted(r for r in rows if r[0] == k)
        want += [(k, v, s, nxt) for (_, s, op, v), nxt in zip(own, [r[1] for r in own[1:]] + [None]) if op == "upsert"]
    schema = "k int, sequence long, operation string, x int"
    for seed in (1, 2):
        order = rows[:]
        random.Random(seed).shuffle(order)
        t = ChangeTable(spark, tempfile.mkdtemp(prefix="tiergrain-test-"), ["k"], "sequence", ["x"],
                        spark.createDataFrame([], schema).schema, width=16)
        parts = [order[:40], order[40:90] + order[:5] + [(None, 1, "upsert", 1), (4, None, "upsert", 1)], order[90:]]
        for i, part in enumerate(parts):
            t.apply(spark.createDataFrame(part, schema), i)
        assert rows_of(t.history()) == sorted(want, key=str)
        t.apply(spark.createDataFrame(parts[1], schema), 1)
        assert rows_of(t.history()) == sorted(want, key=str)
        assert rows_of(t.current()) == sorted((w[:3] for w in want if w[3] is None), key=str)


def test_history_of_few_changes_takes_one_window_and_crowded_keys_slices(spark):
    rng = random.Random(8)
    rows = [(1, s, "upsert", s % 7) for s in range(300)] + \
           [(rng.randrange(2, 40), rng.randrange(6), rng.choice(["upsert", "delete"]), rng.choice([None, 1, 2])) for _ in range(200)]
    rows += rows[:50] + [(None, 1, "upsert", 1), (4, None, "upsert", 1)]
    log = spark.createDataFrame(rows, "k int, sequence long, operation string, x int")
    (bucket,) = crowded(log, ["k"], 100)
    assert crowded(log, ["k"], 10_000) == []
    known = {}
    for k, s, op, x in rows:
        if k is not None and s is not None:
            known[k, s] = max(known.get((k, s), ("", False, 0)), (op, x is not None, x or 0))
    want = []
    for (k, s), (op, there, x) in known.items():
        later = [t for j, t in known if j == k and t > s]
        want += [(k, x if there else None, s, min(later, default=None))] if op == "upsert" else []
    few = history_of(log, ["k"], "sequence", ["x"], 16)
    assert few._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert rows_of(few) == sorted(want, key=str)
    assert rows_of(history_of(log, ["k"], "sequence", ["x"], 16, [bucket])) == sorted(want, key=str)
