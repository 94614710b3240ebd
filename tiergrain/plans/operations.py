"""Queries of the operators that the reference names or implies but does not have:
fail-the-update, change application, interval joins, as-of join, frames,
sessions, sketches, event-time windows, stream-stream joins. All over the given tables; the DuckDB oracle of each is written apart.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiergrain.operators import intervals, sketches, sliced
from tiergrain.operators.quality import RuleSet
from tiergrain.session import shared_dir
from tiergrain.sources import text_files
from tiergrain.sources.changes import DELETE, UPSERT, ChangeTable
from tiergrain.sources.reconcile import reconcile, write_digested
from tiergrain.sources.sinks import read_view
from tiergrain.sources.tables import Tables
from tiergrain.sources.updates import refresh_or_fail
from tiergrain.streaming.dedup import dedup_stream, read_deduplicated
from tiergrain.streaming.event_windows import START, EventWindows, Measure
from tiergrain.streaming.joins import Side, join_streams, read_joined

DAY = 86_400_000_000
HOUR = DAY // 24

BOOK_RULES = RuleSet.of("order_book", "fail", {
    "valid_key": "o_orderkey IS NOT NULL", "positive_price": "o_totalprice > 0",
    "valid_status": "o_orderstatus IN ('O', 'F', 'P')"})


def fail_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three refreshes of an order book; the second has negative prices and leaves no trace for readers."""
    orders = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    broken = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 97 == 0, -F.col("o_totalprice"))
                               .otherwise(F.col("o_totalprice")))
    base, rows = shared_dir(spark, "views", "order_book"), []
    for attempt, df in enumerate((orders.where("o_orderkey % 3 = 0"), broken, orders), 1):
        done = refresh_or_fail(df, base, BOOK_RULES)
        seen = read_view(spark, base).count()
        rows += [(BOOK_RULES.dataset, attempt, done.committed, r, done.evaluated, n, seen) for r, n in done.failed.items()]
    return spark.createDataFrame(rows, "dataset string, attempt int, committed boolean, rule string, evaluated bigint, "
                                       "failed bigint, visible_rows bigint")


FAIL_UPDATE_SQL = """
WITH a AS (SELECT 1 AS attempt, o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT 2, o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 97 = 0 THEN -o_totalprice ELSE o_totalprice END FROM orders
  UNION ALL SELECT 3, o_orderkey, o_orderstatus, o_totalprice FROM orders),
c AS (SELECT attempt, count(*) AS evaluated,
        count(*) FILTER (WHERE o_orderkey IS NULL) AS valid_key,
        count(*) FILTER (WHERE NOT coalesce(o_totalprice > 0, false)) AS positive_price,
        count(*) FILTER (WHERE NOT coalesce(o_orderstatus IN ('O', 'F', 'P'), false)) AS valid_status FROM a GROUP BY attempt),
s AS (SELECT *, valid_key + positive_price + valid_status = 0 AS committed FROM c),
v AS (SELECT *, last_value(CASE WHEN committed THEN evaluated END IGNORE NULLS) OVER (ORDER BY attempt) AS visible_rows FROM s),
u AS (SELECT attempt, committed, evaluated, visible_rows, unnest(['valid_key', 'positive_price', 'valid_status']) AS rule,
        unnest([valid_key, positive_price, valid_status]) AS failed FROM v)
SELECT 'order_book' AS dataset, attempt, committed, rule, evaluated, CAST(failed AS BIGINT) AS failed, visible_rows FROM u"""


def order_changes(orders: DataFrame) -> DataFrame:
    """Changes of every order with the arrival that brings them, out of order."""
    key, cents = F.col("o_orderkey"), F.round(F.col("o_totalprice") * 100).cast("long")

    def change(seq: int, keep, operation: str, status, more: int):
        return F.when(keep, F.struct(F.lit(seq).cast("long").alias("sequence"), F.lit(operation).alias("operation"),
                                     status.alias("status"), (cents + more).alias("price_cents")))
    changes = F.array(
        change(1, key.isNotNull(), UPSERT, F.lit("NEW"), 0), change(2, key % 2 == 0, UPSERT, F.lit("OPEN"), 1000),
        change(3, key.isNotNull(), UPSERT, F.col("o_orderstatus"), 2000), change(4, key % 11 == 0, DELETE, F.lit(None).cast("string"), 0),
        change(5, key % 33 == 0, UPSERT, F.lit("BACK"), 0))
    return orders.select("o_orderkey", F.explode(changes).alias("c")).where("c IS NOT NULL").select(
        "o_orderkey", "c.*", ((F.col("o_orderkey") * 7 + F.col("c.sequence") * 5) % 3).alias("arrival"))


def change_table(spark: SparkSession, sf_dir: str) -> ChangeTable:
    """Three arrivals applied as a stream, then one of them once more."""
    changes = order_changes(Tables(spark, sf_dir).orders)
    schema = changes.drop("arrival").schema
    base = shared_dir(spark, "changes", "orders")
    table = ChangeTable(spark, f"{base}/table", ["o_orderkey"], "sequence", ["status", "price_cents"], schema)
    for arrival in range(3):
        changes.where(F.col("arrival") == arrival).drop("arrival").write.mode("append").parquet(f"{base}/landed")
        table.run(f"{base}/landed")
    table.apply(changes.where("arrival = 1").drop("arrival"), 1)
    return table


_CHANGES_SQL = """
WITH o AS (SELECT o_orderkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders),
ch AS (SELECT o_orderkey, 1 AS s, 'upsert' AS op, 'NEW' AS status, c AS price_cents FROM o
  UNION ALL SELECT o_orderkey, 2, 'upsert', 'OPEN', c + 1000 FROM o WHERE o_orderkey % 2 = 0
  UNION ALL SELECT o_orderkey, 3, 'upsert', o_orderstatus, c + 2000 FROM o
  UNION ALL SELECT o_orderkey, 4, 'delete', NULL, NULL FROM o WHERE o_orderkey % 11 = 0
  UNION ALL SELECT o_orderkey, 5, 'upsert', 'BACK', c FROM o WHERE o_orderkey % 33 = 0),
h AS (SELECT *, lead(s) OVER (PARTITION BY o_orderkey ORDER BY s) AS e FROM ch)
"""
HISTORY_SQL = _CHANGES_SQL + """SELECT o_orderkey, status, price_cents, CAST(s AS BIGINT) AS valid_from, CAST(e AS BIGINT) AS valid_to
FROM h WHERE op = 'upsert'"""
CURRENT_SQL = _CHANGES_SQL + """SELECT o_orderkey, arg_max(status, s) AS status, arg_max(price_cents, s) AS price_cents,
  CAST(max(s) AS BIGINT) AS valid_from FROM ch GROUP BY o_orderkey HAVING arg_max(op, s) = 'upsert'"""


def lines_in_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large order lines shipped within 30 days from the day of some chosen orders; no equality between the two."""
    t = Tables(spark, sf_dir)
    begins = sliced.micros("o_orderdate")
    periods = t.orders.where("o_orderkey % 101 = 0").select("o_orderkey", begins.alias("begins"), (begins + 30 * DAY).alias("ends"))
    lines = t.lineitem.where("l_quantity >= 45").select("l_quantity", sliced.micros("l_shipdate").alias("shipped"))
    pairs = intervals.points_in_periods(lines, periods, "shipped", "begins", "ends", width=30 * DAY)
    return pairs.groupBy("o_orderkey").agg(F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity"))


LINES_IN_PERIODS_SQL = """
SELECT o_orderkey, count(*) AS n_lines, sum(l_quantity) AS quantity
FROM orders JOIN lineitem ON l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL 30 DAY
WHERE o_orderkey % 101 = 0 AND l_quantity >= 45 GROUP BY o_orderkey"""


def overlapping_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a customer's orders whose 60 days from the order date overlap."""
    orders = Tables(spark, sf_dir).orders.where("o_orderkey % 5 = 0")
    begins = sliced.micros("o_orderdate")

    def side(name: str) -> DataFrame:
        return orders.select("o_custkey", F.col("o_orderkey").alias(f"{name}_order"), begins.alias(f"{name}_begins"),
                             (begins + 60 * DAY).alias(f"{name}_ends"))
    pairs = intervals.overlapping_periods(side("first"), side("second"), ("first_begins", "second_begins"),
                                          ("first_ends", "second_ends"), width=60 * DAY, keys=["o_custkey"])
    return pairs.where("first_order < second_order").select("o_custkey", "first_order", "second_order")


OVERLAPPING_ORDERS_SQL = """
SELECT a.o_custkey, a.o_orderkey AS first_order, b.o_orderkey AS second_order
FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey
  AND a.o_orderdate < b.o_orderdate + INTERVAL 60 DAY AND b.o_orderdate < a.o_orderdate + INTERVAL 60 DAY
WHERE a.o_orderkey % 5 = 0 AND b.o_orderkey % 5 = 0"""

# the events' month is stretched over the order lines' seven years
_EVENTS_FROM, _LINES_FROM, _STRETCH = 1_704_067_200_000_000, 788_918_400_000_000, 84


def lines_last_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line with its customer's last event up to the shipping day."""
    t = Tables(spark, sf_dir)
    customers = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.floor(F.col("o_custkey") / 10).alias("user_id"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate").join(customers, "l_orderkey")
    event_at = (sliced.micros("ts") - _EVENTS_FROM) * _STRETCH + _LINES_FROM
    found = sliced.asof_join(lines, t.events, ["user_id"], sliced.micros("l_shipdate"), event_at, ["event_id", "event_type"],
                             "event_id", width=90 * DAY)
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "user_id", "event_id", "event_type")


LINES_LAST_EVENT_SQL = f"""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, epoch_us(l_shipdate) AS at, CAST(floor(o_custkey / 10) AS BIGINT) AS user_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
e AS (SELECT user_id, event_id, event_type, (epoch_us(ts) - {_EVENTS_FROM}) * {_STRETCH} + {_LINES_FROM} AS at FROM events)
SELECT l_orderkey, l_linenumber, l_partkey, l.user_id, event_id, event_type
FROM l ASOF LEFT JOIN e ON l.user_id = e.user_id AND l.at >= e.at"""


def event_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event: sum, least and largest value of the user's last 36 hours, the event before, the user's day number."""
    events = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts", F.round(F.col("value") * 100).cast("long").alias("cents"))
    at = sliced.micros("ts")
    frames = {"sum_36h": F.sum("cents"), "least_36h": F.min("cents"), "largest_36h": F.max("cents")}
    rows = sliced.rolling(events, ["user_id"], at, 36 * HOUR, frames, width=5 * DAY)
    rows = sliced.previous_in_order(rows, ["user_id"], at, ["event_id"], ["event_id"], width=5 * DAY)
    day = sliced.micros("ts") - F.pmod(sliced.micros("ts"), F.lit(DAY))
    rows = sliced.dense_rank_in_order(rows, ["user_id"], day, "day_number", width=5 * DAY)
    return rows.select("event_id", "user_id", *frames, F.col("previous_event_id").alias("previous_event"), "day_number")


EVENT_FRAMES_SQL = """
WITH e AS (SELECT event_id, user_id, ts, CAST(round(value * 100) AS BIGINT) AS c FROM events)
SELECT event_id, user_id, CAST(sum(c) OVER w AS BIGINT) AS sum_36h, min(c) OVER w AS least_36h, max(c) OVER w AS largest_36h,
  lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_event,
  CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS BIGINT) AS day_number
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 36 HOUR PRECEDING AND CURRENT ROW)"""


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a user's events at most six hours apart."""
    events = Tables(spark, sf_dir).events
    return sliced.sessions(events, ["user_id"], "ts", ["event_id"], 6 * HOUR, width=5 * DAY)


EVENT_SESSIONS_SQL = """
WITH p AS (SELECT user_id, event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
s AS (SELECT user_id, ts, sum(CASE WHEN before IS NULL OR ts - before > INTERVAL 6 HOUR THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM p)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n FROM s GROUP BY user_id, no"""


def reconciled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences of two versions of the orders: removed, added, repriced and doubled ones."""
    old = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    part = F.col("o_orderkey") % 1000
    new = old.where(part != 1).withColumn("cents", F.col("cents") + F.when(part == 2, 1).otherwise(0))
    new = new.unionByName(old.where(part == 3).withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000)) \
        .unionByName(old.where(part == 4)).unionByName(old.where(part == 4))
    base = shared_dir(spark, "reconcile", "orders")
    write_digested(old, f"{base}/old", ["o_orderkey"], ranges=32)
    write_digested(new, f"{base}/new", ["o_orderkey"], ranges=32)
    return reconcile(spark, f"{base}/old", f"{base}/new", ["o_orderkey"])


RECONCILED_SQL = """
WITH a AS (SELECT o_orderkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
b AS (SELECT o_orderkey, o_orderstatus, cents + CASE WHEN o_orderkey % 1000 = 2 THEN 1 ELSE 0 END AS cents FROM a WHERE o_orderkey % 1000 <> 1
  UNION ALL SELECT o_orderkey + 1000000000, o_orderstatus, cents FROM a WHERE o_orderkey % 1000 = 3
  UNION ALL SELECT a.* FROM a, range(2) WHERE o_orderkey % 1000 = 4),
gone AS (SELECT *, count(*) AS copies FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL),
come AS (SELECT *, count(*) AS copies FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY ALL)
SELECT o_orderkey, o_orderstatus, cents, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM b) THEN 'changed_from' ELSE 'removed' END AS change, copies FROM gone
UNION ALL
SELECT o_orderkey, o_orderstatus, cents, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM a) THEN 'changed_to' ELSE 'added' END, copies FROM come"""

_TEXT_SCHEMA = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                             T.StructField("o_orderstatus", T.StringType()), T.StructField("cents", T.LongType())])


def text_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed as delimited and as JSON lines, some of them broken, and read back: clean rows and quarantine."""
    key = F.col("o_orderkey")
    orders = Tables(spark, sf_dir).orders.select(
        key, "o_custkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    fields = [F.col(c).cast("string") for c in orders.columns]
    line = F.concat_ws(",", *fields[:3], F.when(key % 50 == 7, F.lit("12x")).otherwise(fields[3]),
                       F.when(key % 50 == 8, F.lit("more")))
    line = F.when(key % 50 == 9, F.concat_ws(",", *fields[:2])).otherwise(line)
    whole = F.to_json(F.struct(*orders.columns))
    json = F.when(key % 50 == 7, F.concat(F.lit('{"o_orderkey":'), fields[0], F.lit(',"cents":"12x"}'))) \
        .when(key % 50 == 8, F.concat(F.lit('{"o_orderkey":'), fields[0], F.lit(',"more":1}'))) \
        .when(key % 50 == 9, F.concat(F.lit('{"o_orderkey":'), fields[0])).otherwise(whole)
    base = shared_dir(spark, "landing", "orders")
    orders.select(line.alias("value")).write.text(f"{base}/delimited")
    orders.select(json.alias("value")).write.text(f"{base}/json")
    none = F.lit(None).cast("string")
    parts = []
    for name, rows, sep in (("delimited", text_files.read_delimited(spark, f"{base}/delimited", _TEXT_SCHEMA), ","),
                            ("json", text_files.read_json(spark, f"{base}/json", _TEXT_SCHEMA), None)):
        parts.append(text_files.clean(rows).select(F.lit(name).alias("format"), *orders.columns, none.alias("line"), none.alias("reason")))
        parts.append(text_files.broken(rows, _TEXT_SCHEMA, sep).select(
            F.lit(name).alias("format"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in _TEXT_SCHEMA], "line", "reason"))
    return reduce(DataFrame.unionByName, parts)


TEXT_SOURCES_SQL = """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderkey % 50 AS p FROM orders)
SELECT f AS format, o_orderkey, o_custkey, o_orderstatus, cents, NULL AS line, NULL AS reason
FROM o, (VALUES ('delimited'), ('json')) x(f) WHERE p NOT IN (7, 8, 9)
UNION ALL SELECT 'delimited', NULL, NULL, NULL, NULL,
  CASE p WHEN 7 THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus, '12x')
         WHEN 8 THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus, cents, 'more') ELSE concat_ws(',', o_orderkey, o_custkey) END,
  CASE p WHEN 7 THEN 'bad_value' WHEN 8 THEN 'surplus_field' ELSE 'missing_field' END FROM o WHERE p IN (7, 8, 9)
UNION ALL SELECT 'json', NULL, NULL, NULL, NULL,
  '{"o_orderkey":' || o_orderkey || CASE p WHEN 7 THEN ',"cents":"12x"}' WHEN 8 THEN ',"more":1}' ELSE '' END,
  CASE p WHEN 7 THEN 'bad_value' WHEN 8 THEN 'surplus_field' ELSE 'not_json' END FROM o WHERE p IN (7, 8, 9)"""


def distinct_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers per status and year from daily sketches; the exact count and whether the estimate is within 4 errors."""
    orders = Tables(spark, sf_dir).orders.withColumn("order_year", F.year("o_orderdate"))
    base = shared_dir(spark, "sketches", "customers")
    sketches.daily_sketches(orders, ["o_orderstatus", "order_year"], F.to_date("o_orderdate"), "o_custkey") \
        .write.parquet(f"{base}/daily")
    groups = ["o_orderstatus", "order_year"]
    found = sketches.merged_counts(spark.read.parquet(f"{base}/daily"), groups, "estimate")
    exact = orders.groupBy(*groups).agg(F.count_distinct("o_custkey").alias("customers"))
    near = F.abs(F.col("estimate") - F.col("customers")) <= 4 * sketches.STANDARD_ERROR * F.col("customers") + 1
    return exact.join(found, groups).select(*groups, "customers", near.alias("estimate_within_bound"))


DISTINCT_CUSTOMERS_SQL = """
SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(DISTINCT o_custkey) AS customers, true AS estimate_within_bound
FROM orders GROUP BY ALL"""


def deduplicated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arriving in three refreshes, some of them twice: one row each, and the number dropped."""
    events = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts")
    base = shared_dir(spark, "streams", "dedup")
    dropped = 0
    for arrival in range(3):
        own = F.col("event_id") % 3 == arrival
        again = (F.col("event_id") % 3 < arrival) & (F.col("event_id") % 10 == 0)
        events.where(own | again).write.mode("append").parquet(f"{base}/in")
        dropped = dedup_stream(spark, f"{base}/in", events.schema, f"{base}/out", f"{base}/_checkpoint", ["event_id"], "ts", "60 days")
    kept = read_deduplicated(spark, f"{base}/out")
    return kept.groupBy("user_id").agg(F.count("*").alias("events"), F.count_distinct("event_id").alias("distinct_events")) \
        .withColumn("dropped_in_all", F.lit(dropped).cast("long"))


DEDUPLICATED_SQL = """
SELECT user_id, count(*) AS events, count(*) AS distinct_events,
  (SELECT CAST(sum(2 - event_id % 3) AS BIGINT) FROM events WHERE event_id % 10 = 0) AS dropped_in_all
FROM events GROUP BY user_id"""



def _price_ranks(orders: DataFrame, found: DataFrame, groups: list[str], ranks: dict[str, float]) -> DataFrame:
    """Per group whether each estimate's rank among all prices is within the bound (ties: any of their ranks)."""
    rows = orders.join(found, groups)
    near = []
    for name, rank in ranks.items():
        below = F.avg((F.col("cents") < F.col(name)).cast("double"))
        upto = F.avg((F.col("cents") <= F.col(name)).cast("double"))
        slack = 2 * sketches.RANK_ERROR + 1 / F.count("cents")
        near.append(((below <= rank + slack) & (upto >= rank - slack)).alias(f"{name}_within_bound"))
    return rows.groupBy(*groups).agg(F.count("cents").alias("orders"), *near)


def price_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price quantiles per status and year from daily sketches; whether each rank is within twice the stated error."""
    orders = Tables(spark, sf_dir).orders.select("o_orderstatus", F.year("o_orderdate").alias("order_year"), "o_orderdate",
                                                 F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    base, groups = shared_dir(spark, "sketches", "prices"), ["o_orderstatus", "order_year"]
    sketches.daily_quantiles(orders, groups, F.to_date("o_orderdate"), "cents").write.parquet(f"{base}/daily")
    ranks = {"median": 0.5, "p95": 0.95}
    found = sketches.merged_quantiles(spark.read.parquet(f"{base}/daily"), groups, ranks)
    return _price_ranks(orders, found, groups, ranks)


PRICE_QUANTILES_SQL = """
SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS orders, true AS median_within_bound,
  true AS p95_within_bound
FROM orders GROUP BY ALL"""


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hour windows of events that arrive in three refreshes, some too late: closed and open windows, late rows."""
    third = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2))
    arrival = F.when(F.col("event_id") % 20 == 0, F.least(third + 1 + F.col("event_id") % 40 / 20, F.lit(2))).otherwise(third)
    events = Tables(spark, sf_dir).events.select("event_id", "event_type", "ts", F.round(F.col("value") * 100).cast("long").alias("cents"),
                                                 arrival.cast("int").alias("arrival"))
    base = shared_dir(spark, "streams", "windows")
    windows = EventWindows(spark, f"{base}/table", events.drop("arrival").schema, "ts", ["event_type"],
                           {"events": Measure(F.count("*"), F.sum), "cents": Measure(F.sum("cents"), F.sum)}, 6 * HOUR, DAY)
    for n in range(3):
        events.where(F.col("arrival") == n).drop("arrival").write.mode("append").parquet(f"{base}/in")
        windows.run(f"{base}/in")
    late = windows.late().groupBy(START, "event_type").agg(F.count("*").alias("events"), F.sum("cents").alias("cents"))
    parts = (("closed", windows.closed()), ("open", windows.still_open()), ("late", late))
    return reduce(DataFrame.unionByName, [df.select(F.lit(kind).alias("kind"), START, "event_type", "events", "cents") for kind, df in parts])


EVENT_WINDOWS_SQL = f"""
WITH d AS (SELECT event_id, event_type, ts, CAST(round(value * 100) AS BIGINT) AS cents, least((day(ts) - 1) // 10, 2) AS third,
    make_timestamp(epoch_us(ts) - epoch_us(ts) % {6 * HOUR}) AS window_start FROM events),
e AS (SELECT *, CASE WHEN event_id % 20 <> 0 THEN third WHEN event_id % 40 = 0 THEN least(third + 1, 2) ELSE 2 END AS arrival FROM d),
w AS (SELECT a, (SELECT max(ts) - INTERVAL 1 DAY FROM e WHERE arrival < a) AS mark FROM range(4) r(a)),
k AS (SELECT e.*, CASE WHEN coalesce(window_start + INTERVAL 6 HOUR <= mark, false) THEN 'late'
    WHEN window_start + INTERVAL 6 HOUR <= (SELECT mark FROM w WHERE a = 3) THEN 'closed' ELSE 'open' END AS kind
  FROM e JOIN w ON arrival = a)
SELECT kind, window_start, event_type, count(*) AS events, CAST(sum(cents) AS BIGINT) AS cents FROM k GROUP BY ALL"""

_JOIN_DELAY = "800 days 5 hours"


def orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and lines shipped within a year, arriving in separate streams, a tenth of each a refresh late."""
    t = Tables(spark, sf_dir)

    def arrivals(rows: DataFrame, at: str, late) -> DataFrame:
        third = F.when(F.col(at) < F.lit("1997-03-01").cast("timestamp"), 0).when(F.col(at) < F.lit("1999-05-01").cast("timestamp"), 1).otherwise(2)
        return rows.withColumn("arrival", F.least(third + F.when(late, 1).otherwise(0), F.lit(2)))
    orders = arrivals(t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp")), "o_orderdate", F.col("o_orderkey") % 10 == 3)
    lines = arrivals(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("timestamp")), "l_shipdate",
                     F.col("l_partkey") % 10 == 7)
    base = shared_dir(spark, "streams", "order_lines")
    left = Side(f"{base}/orders", orders.drop("arrival").schema, "o_orderdate", _JOIN_DELAY)
    right = Side(f"{base}/lines", lines.drop("arrival").schema, "l_shipdate", _JOIN_DELAY)
    for n in range(3):
        for rows, side in ((orders, left), (lines, right)):
            rows.where(F.col("arrival") == n).drop("arrival").write.mode("append").parquet(side.folder)
        join_streams(spark, left, right, [("o_orderkey", "l_orderkey")], "0 DAYS", "365 DAYS", f"{base}/out", f"{base}/_checkpoint")
    return read_joined(spark, f"{base}/out").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp_ntz"),
                                                    "l_linenumber", "l_partkey", F.col("l_shipdate").cast("timestamp_ntz"))


ORDERS_WITH_LINES_SQL = f"""
WITH m AS (SELECT least((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem)) - INTERVAL '{_JOIN_DELAY}' AS mark)
SELECT o_orderkey, o_custkey, o_orderdate, l_linenumber, l_partkey, l_shipdate
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 365 DAYS
WHERE l_orderkey IS NOT NULL OR o_orderdate + INTERVAL 365 DAYS < (SELECT mark FROM m)"""

QUERIES = {
    "refresh_fail_update": (fail_update, FAIL_UPDATE_SQL),
    "cdc_orders_history": (lambda spark, sf_dir: change_table(spark, sf_dir).history(), HISTORY_SQL),
    "cdc_orders_current": (lambda spark, sf_dir: change_table(spark, sf_dir).current(), CURRENT_SQL),
    "join_lines_in_periods": (lines_in_periods, LINES_IN_PERIODS_SQL),
    "join_overlapping_orders": (overlapping_orders, OVERLAPPING_ORDERS_SQL),
    "asof_lines_last_event": (lines_last_event, LINES_LAST_EVENT_SQL),
    "frames_event_values": (event_frames, EVENT_FRAMES_SQL),
    "sessions_events": (event_sessions, EVENT_SESSIONS_SQL),
    "reconcile_orders": (reconciled_orders, RECONCILED_SQL),
    "text_sources_orders": (text_sources, TEXT_SOURCES_SQL),
    "sketch_distinct_customers": (distinct_customers, DISTINCT_CUSTOMERS_SQL),
    "stream_dedup_events": (deduplicated_events, DEDUPLICATED_SQL),
    "sketch_price_quantiles": (price_quantiles, PRICE_QUANTILES_SQL),
    "stream_event_windows": (event_windows, EVENT_WINDOWS_SQL),
    "stream_orders_with_lines": (orders_with_lines, ORDERS_WITH_LINES_SQL),
}
