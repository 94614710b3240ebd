"""Raw tables of the two pipelines, bound to the input tables.

The reference generates its twelve raw tables with planted defects. Here each
raw table is a projection of the TPC-H-like inputs whose column expressions
plant the same kinds of defect (nulls, negatives, zeros, orphan codes,
inverted ranges) by key modulo, so the data grows with the inputs and both
Spark and the DuckDB oracle produce identical raw rows from one text.

Each column is ``(name, type, SQL expression)``. Spark evaluates the
expressions with ``selectExpr`` over a DataFrame join; the oracle wraps the
same text in a CTE (``duck_ctes``).
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiergrain.sources.tables import Tables

SPARK_TYPES = {"string": "string", "double": "double", "long": "bigint",
               "date": "date", "timestamp": "timestamp_ntz", "int": "int"}
DUCK_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "long": "BIGINT",
              "date": "DATE", "timestamp": "TIMESTAMP", "int": "INTEGER"}


@dataclasses.dataclass(frozen=True)
class Binding:
    name: str
    duck_from: str
    columns: tuple[tuple[str, str, str], ...]

    def spark_columns(self) -> list[str]:
        return [f"CAST({e} AS {SPARK_TYPES[t]}) AS {c}" for c, t, e in self.columns]

    def duck_cte(self) -> str:
        cols = ",\n    ".join(f"CAST({e} AS {DUCK_TYPES[t]}) AS {c}" for c, t, e in self.columns)
        return f"{self.name} AS (\n  SELECT\n    {cols}\n  FROM {self.duck_from}\n)"

    def spark_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T._parse_datatype_string(SPARK_TYPES[t]))
                             for c, t, _ in self.columns])


_TRADE_FROM = "lineitem JOIN orders ON l_orderkey = o_orderkey"
_POLICY_FROM = ("orders JOIN customer ON o_custkey = c_custkey "
                "JOIN nation ON c_nationkey = n_nationkey "
                "JOIN region ON n_regionkey = r_regionkey")
_FX_FROM = ("(SELECT CAST(o_orderdate AS DATE) AS d, o_custkey % 4 AS pr, min(o_orderkey) AS k "
            "FROM orders GROUP BY 1, 2) g")
_EXPOSURE_FROM = (
    "(SELECT r_name AS rn, 'PERIL-' || least(o_orderkey % 13, o_orderkey % 17) AS pl, "
    "CAST(date_trunc('quarter', o_orderdate) AS DATE) AS qd, sum(o_totalprice) AS tp, "
    "min(o_orderkey) AS k FROM " + _POLICY_FROM +
    " WHERE least(o_orderkey % 13, o_orderkey % 17) < 5 GROUP BY 1, 2, 3) g")

BINDINGS: dict[str, Binding] = {b.name: b for b in (
    Binding("raw_trade_executions", _TRADE_FROM, (
        ("trade_id", "string", "CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE 'TRD-' || l_orderkey || '-' || l_linenumber END"),
        ("order_id", "string", "'ORD-' || o_orderkey"),
        ("security_id", "string", "'SEC-' || l_partkey"),
        ("counterparty_id", "string", "'CP-' || l_suppkey"),
        ("fund_id", "string", "'FUND-' || (o_custkey % 27)"),
        ("trade_date", "timestamp", "CASE WHEN l_orderkey % 331 = 0 THEN NULL ELSE l_shipdate END"),
        ("trade_type", "string", "CASE WHEN l_returnflag = 'R' THEN 'SELL' WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN 'XFER' ELSE 'BUY' END"),
        ("quantity", "double", "CASE WHEN l_orderkey % 61 = 0 THEN -l_quantity ELSE l_quantity END"),
        ("price", "double", "CASE WHEN l_orderkey % 67 = 0 THEN -l_extendedprice / l_quantity ELSE l_extendedprice / l_quantity END"),
        ("currency", "string", "CASE WHEN l_partkey % 211 = 0 THEN NULL WHEN l_suppkey % 5 = 0 THEN 'EUR' WHEN l_suppkey % 5 = 1 THEN 'GBP' ELSE 'USD' END"),
        ("broker_id", "string", "'BRK-0' || (l_suppkey % 5 + 1)"),
        ("execution_venue", "string", "CASE l_linenumber % 4 WHEN 0 THEN 'NYSE' WHEN 1 THEN 'LSE' WHEN 2 THEN 'XETRA' ELSE 'OTC' END"),
        ("asset_class", "string", "CASE l_partkey % 4 WHEN 0 THEN 'Equity' WHEN 1 THEN 'Fixed Income' WHEN 2 THEN 'ETF' ELSE 'FX Forward' END"),
        ("settlement_status", "string", "CASE WHEN o_orderstatus = 'F' THEN 'Settled' WHEN o_orderstatus = 'O' THEN 'Pending' WHEN o_orderpriority = '1-URGENT' THEN 'Failed' ELSE 'Partially Settled' END"),
    )),
    Binding("raw_securities_master", "part", (
        ("security_id", "string", "CASE WHEN p_partkey % 83 = 0 THEN NULL ELSE 'SEC-' || p_partkey END"),
        ("isin", "string", "CASE WHEN p_partkey % 40 = 0 THEN NULL ELSE 'ISIN' || p_partkey END"),
        ("ticker", "string", "p_brand"),
        ("security_name", "string", "CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE p_name || ' ' || p_partkey END"),
        ("asset_class", "string", "CASE WHEN p_partkey % 71 = 0 THEN NULL ELSE p_type END"),
        ("sector", "string", "p_brand"),
        ("country", "string", "'US'"),
        ("currency", "string", "'USD'"),
        ("exchange", "string", "'X' || (p_size % 5)"),
        ("issuer_name", "string", "p_brand"),
        ("maturity_date", "date", "CASE WHEN p_size > 40 THEN DATE '2010-06-15' END"),
        ("coupon_rate", "double", "CASE WHEN p_size > 40 THEN p_size / 10.0e0 END"),
        ("esg_score", "double", "CAST(p_size AS DOUBLE)"),
    )),
    Binding("raw_counterparties", "supplier", (
        ("counterparty_id", "string", "CASE WHEN s_suppkey % 19 = 0 THEN NULL ELSE 'CP-' || s_suppkey END"),
        ("counterparty_name", "string", "CASE WHEN s_suppkey % 23 = 0 THEN NULL ELSE s_name END"),
        ("counterparty_type", "string", "CASE WHEN s_suppkey % 3 = 0 THEN 'Custodian' ELSE 'Broker' END"),
        ("lei", "string", "CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE 'LEI' || s_suppkey END"),
        ("country", "string", "'N' || s_nationkey"),
        ("credit_rating", "string", "CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal < 5000 THEN 'A' ELSE 'AA-' END"),
    )),
    Binding("raw_fund_structures", "nation JOIN region ON n_regionkey = r_regionkey", (
        ("fund_id", "string", "CASE WHEN n_nationkey = 24 THEN NULL ELSE 'FUND-' || n_nationkey END"),
        ("fund_name", "string", "CASE WHEN n_nationkey = 23 THEN NULL ELSE n_name END"),
        ("strategy", "string", "CASE WHEN n_nationkey = 22 THEN NULL ELSE r_name END"),
        ("benchmark_id", "string", "'BM-' || n_regionkey"),
        ("inception_date", "date", "CASE WHEN n_nationkey = 21 THEN NULL ELSE DATE '1994-01-01' END"),
        ("target_return", "double", "CASE WHEN n_nationkey = 20 THEN -0.05e0 ELSE n_nationkey / 100.0e0 END"),
        ("base_currency", "string", "CASE WHEN n_regionkey = 3 THEN 'EUR' ELSE 'USD' END"),
    )),
    Binding("raw_market_data", "events", (
        ("security_id", "string", "CASE WHEN event_id % 101 = 0 THEN NULL ELSE 'SEC-' || user_id END"),
        ("price_date", "date", "CASE WHEN event_id % 103 = 0 THEN NULL ELSE CAST(ts AS DATE) END"),
        ("close_price", "double", "CASE WHEN event_id % 109 = 0 THEN -value ELSE value * (1.0e0 + (event_id % 61 - 30) / 1000.0e0) END"),
        ("open_price", "double", "CASE WHEN event_id % 107 = 0 THEN -value WHEN event_id % 131 = 0 THEN 0.0e0 ELSE value END"),
        ("high_price", "double", "CASE WHEN event_id % 113 = 0 THEN value * 0.95e0 ELSE value * 1.05e0 END"),
        ("low_price", "double", "CASE WHEN event_id % 113 = 0 THEN value * 1.05e0 ELSE value * 0.95e0 END"),
        ("volume", "long", "CASE WHEN event_id % 127 = 0 THEN -1 - event_id ELSE 100 + event_id * 10 END"),
        ("currency", "string", "'USD'"),
        ("source", "string", "CASE event_id % 3 WHEN 0 THEN 'Bloomberg' WHEN 1 THEN 'Reuters' ELSE 'ICE' END"),
    )),
    Binding("raw_fx_rates", _FX_FROM, (
        ("rate_date", "date", "CASE WHEN k % 101 = 0 THEN NULL ELSE d END"),
        ("from_currency", "string", "CASE WHEN k % 103 = 0 THEN NULL WHEN pr < 2 THEN 'EUR' ELSE 'GBP' END"),
        ("to_currency", "string", "CASE WHEN k % 103 = 0 THEN NULL WHEN pr % 2 = 0 THEN 'USD' ELSE 'JPY' END"),
        ("rate", "double", "CASE WHEN k % 107 = 0 THEN 0.0e0 WHEN k % 109 = 0 THEN -1.0e0 ELSE 1.0e0 + pr + (k % 50) / 10000.0e0 END"),
        ("source", "string", "CASE k % 2 WHEN 0 THEN 'ECB' ELSE 'Fed' END"),
    )),
    # reference-like small tables, each row derived from a nation
    Binding("raw_lines_of_business", "nation", (
        ("lob_id", "string", "CASE WHEN n_nationkey % 9 = 8 OR n_nationkey > 8 THEN NULL ELSE 'LOB-0' || (n_nationkey + 1) END"),
        ("lob_name", "string", "n_name || ' line'"),
        ("segment", "string", "'SEG-' || n_regionkey"),
        ("description", "string", "n_name || ' cover'"),
    )),
    Binding("raw_brokers", "nation", (
        ("broker_id", "string", "CASE WHEN n_nationkey > 5 THEN 'BRX-' || n_nationkey ELSE 'BRK-0' || (n_nationkey + 1) END"),
        ("broker_name", "string", "n_name || ' brokers'"),
        ("segment", "string", "'MKT-' || n_regionkey"),
        ("country", "string", "'N' || n_nationkey"),
        ("rating", "string", "CASE WHEN n_nationkey % 3 = 0 THEN 'A+' WHEN n_nationkey % 3 = 1 THEN 'A' ELSE 'A-' END"),
    )),
    Binding("raw_reinsurers", "region", (
        ("reinsurer_id", "string", "'RE-0' || (r_regionkey + 1)"),
        ("reinsurer_name", "string", "r_name || ' re'"),
        ("credit_rating", "string", "CASE WHEN r_regionkey < 2 THEN 'AA' ELSE 'A+' END"),
        ("country", "string", "'R' || r_regionkey"),
        ("cession_rate", "double", "0.2e0 + r_regionkey * 0.05e0"),
    )),
    Binding("raw_policies", _POLICY_FROM, (
        ("policy_id", "string", "CASE WHEN o_orderkey % 33 = 0 THEN NULL ELSE 'POL-' || o_orderkey END"),
        ("lob_id", "string", "CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN 'LOB-99' ELSE 'LOB-0' || (o_custkey % 8 + 1) END"),
        ("broker_id", "string", "'BRK-0' || (o_custkey % 7 + 1)"),
        ("insured_name", "string", "c_name"),
        ("territory", "string", "r_name"),
        ("inception_date", "timestamp", "o_orderdate"),
        ("currency", "string", "CASE o_custkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'GBP' ELSE 'EUR' END"),
        ("gross_premium", "double", "CASE WHEN o_orderkey % 29 = 0 THEN -o_totalprice WHEN o_orderkey % 173 = 0 THEN NULL ELSE o_totalprice END"),
        ("limit_amount", "double", "CASE WHEN o_orderkey % 47 = 1 THEN 0.0e0 ELSE o_totalprice * (5 + 4 * n_regionkey) END"),
        ("deductible", "double", "o_totalprice / 100.0e0"),
        ("peril", "string", "'PERIL-' || least(o_orderkey % 13, o_orderkey % 17)"),
        ("status", "string", "CASE WHEN o_orderkey % 6 < 3 THEN 'BOUND' WHEN o_orderkey % 6 = 3 THEN 'QUOTED' WHEN o_orderkey % 6 = 4 THEN 'EXPIRED' ELSE 'CANCELLED' END"),
        ("expiry_date", "date", "date_add(CAST(o_orderdate AS DATE), 365)"),
    )),
    Binding("raw_claims", _TRADE_FROM, (
        ("claim_id", "string", "CASE WHEN l_orderkey % 51 = 0 THEN NULL ELSE 'CLM-' || l_orderkey || '-' || l_linenumber END"),
        ("policy_id", "string", "CASE WHEN l_orderkey % 43 = 0 THEN NULL ELSE 'POL-' || (l_orderkey + l_orderkey % 7 * 100000) END"),
        ("loss_date", "timestamp", "l_shipdate"),
        ("notification_date", "timestamp", "o_orderdate"),
        ("peril", "string", "'PERIL-' || least(o_orderkey % 13, o_orderkey % 17)"),
        ("territory", "string", "'T' || (o_custkey % 5)"),
        ("incurred_amount", "double", "CASE WHEN l_orderkey % 31 = 0 THEN -l_extendedprice * 30 WHEN l_partkey % 59 = 0 THEN NULL ELSE l_extendedprice * 30 END"),
        ("paid_amount", "double", "CASE WHEN l_orderkey % 26 = 0 THEN l_extendedprice * 60 ELSE l_extendedprice * 30 * (1 - l_discount) END"),
        ("reserve_amount", "double", "l_extendedprice * 30 * l_tax"),
        ("status", "string", "CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'OPEN' ELSE 'RESERVED' END"),
        ("adjuster", "string", "'ADJ-' || (l_suppkey % 6)"),
        ("cause_code", "string", "CASE l_partkey % 5 WHEN 0 THEN 'NAT-CAT' WHEN 1 THEN 'ATTRITIONAL' WHEN 2 THEN 'LARGE-LOSS' WHEN 3 THEN 'CATASTROPHE' ELSE 'FRAUD' END"),
    )),
    Binding("raw_exposure_accumulations", _EXPOSURE_FROM, (
        ("exposure_id", "string", "'EXP-' || k"),
        ("territory", "string", "CASE WHEN k % 37 = 0 THEN NULL ELSE rn END"),
        ("peril", "string", "pl"),
        ("as_of_date", "date", "qd"),
        ("total_insured_value", "double", "CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN 0.0e0 ELSE tp * 100 END"),
        ("probable_max_loss", "double", "CASE WHEN k % 9 = 0 THEN tp * 120 WHEN k % 11 = 0 THEN 0.0e0 ELSE tp * (5 + k % 20) END"),
        ("currency", "string", "'USD'"),
        ("model_source", "string", "CASE k % 3 WHEN 0 THEN 'RMS' WHEN 1 THEN 'AIR' ELSE 'Internal' END"),
    )),
)}


# --- Spark side: the FROM clauses as DataFrame plans -------------------------

def _policy_base(t: Tables) -> DataFrame:
    # nation (25 rows) and region (5 rows) are fixed-size TPC-H tables, so
    # broadcasting them has a proven bound; customer is left to the planner.
    geo = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    return (t.orders
            .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")))


def _spark_from(name: str, t: Tables) -> DataFrame:
    if name in ("raw_trade_executions", "raw_claims"):
        return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if name == "raw_securities_master":
        return t.part
    if name == "raw_counterparties":
        return t.supplier
    if name == "raw_fund_structures":
        return t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    if name == "raw_market_data":
        return t.events
    if name == "raw_fx_rates":
        return (t.orders
                .groupBy(F.to_date("o_orderdate").alias("d"), (F.col("o_custkey") % 4).alias("pr"))
                .agg(F.min("o_orderkey").alias("k")))
    if name == "raw_policies":
        return _policy_base(t)
    if name == "raw_exposure_accumulations":
        m = F.least(F.col("o_orderkey") % 13, F.col("o_orderkey") % 17)
        return (_policy_base(t)
                .filter(m < 5)
                .groupBy(F.col("r_name").alias("rn"),
                         F.concat(F.lit("PERIL-"), m.cast("string")).alias("pl"),
                         F.date_trunc("quarter", "o_orderdate").cast("date").alias("qd"))
                .agg(F.sum("o_totalprice").alias("tp"), F.min("o_orderkey").alias("k")))
    if name in ("raw_lines_of_business", "raw_brokers"):
        return t.nation
    if name == "raw_reinsurers":
        return t.region
    raise KeyError(name)


def raw_table(t: Tables, name: str) -> DataFrame:
    """The bound raw table ``name`` as a lazy DataFrame."""
    return _spark_from(name, t).selectExpr(*BINDINGS[name].spark_columns())


class RawTables(dict):
    """Mapping name -> raw DataFrame, each built on first access."""

    def __init__(self, tables: Tables):
        super().__init__()
        self.tables = tables

    def __missing__(self, name: str) -> DataFrame:
        if name not in BINDINGS:
            raise KeyError(name)
        df = raw_table(self.tables, name)
        self[name] = df
        return df


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(Tables(spark, sf_dir))


def duck_ctes(names=None) -> str:
    """``WITH`` prefix defining raw tables for the DuckDB oracle."""
    names = list(BINDINGS) if names is None else list(names)
    return "WITH " + ",\n".join(BINDINGS[n].duck_cte() for n in names)
