"""The nine streaming tables of the investment pipeline, run incrementally.

Raw tables (bound to the input tables) are landed as parquet files in a
fresh folder under the shared checkpoint root; bronze streams read them,
silver streams read the bronze sinks, and every refresh is one
``availableNow`` trigger. The trades arrive in two parts with a refresh after
each, and a final rerun must add nothing (exactly-once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiergrain.params import Params
from tiergrain.plans import investment as inv
from tiergrain.operators.relational import scan_bytes
from tiergrain.session import shared_dir
from tiergrain.sources.sinks import write_bucketed
from tiergrain.sources.bindings import raw_tables
from tiergrain.streaming.refresh import StreamRun, append_stream, batch_bytes, batch_metrics, enrich_stream, full_refresh, read_enriched, stage_arrivals

ROWS_PER_FILE = 20_000     # landed files are cut by rows: no shuffle, any number of files


class InvestmentStreams:
    def __init__(self, spark: SparkSession, sf_dir: str, params: Params, trade_arrivals: int = 2):
        """``params.stream_batch_bytes`` and ``stream_refresh_batches`` set a micro-batch's size."""
        self.spark = spark
        self.params = params
        self.raw = raw_tables(spark, sf_dir)
        self.base = shared_dir(spark, "inv-streams")
        self.trade_arrivals = trade_arrivals
        self.runs: dict[str, list[StreamRun]] = {}
        self._staged: set[str] = set()

    # --- folders ---------------------------------------------------------------
    def raw_dir(self, raw: str) -> str:
        return f"{self.base}/raw/{raw}"

    def sink(self, table: str) -> str:
        return f"{self.base}/tables/{table}"

    def ckpt(self, table: str) -> str:
        return f"{self.base}/checkpoints/{table}"

    def schema(self, raw: str):
        return self.raw[raw].schema

    def batch_bytes(self, folder: str) -> int:
        return batch_bytes(self.spark, folder, self.params.stream_batch_bytes, self.params.stream_refresh_batches)

    # --- refreshes ---------------------------------------------------------------
    def _stage(self, raw: str, part: int | None = None) -> None:
        tag = f"{raw}:{part}"
        if tag in self._staged:
            return
        df = self.raw[raw]
        if part is not None:
            df = df.filter(F.pmod(F.xxhash64("order_id"), F.lit(self.trade_arrivals)) == part)
        stage_arrivals(df, self.raw_dir(raw), ROWS_PER_FILE)
        self._staged.add(tag)

    def refresh_bronze(self, table: str) -> StreamRun:
        raw = inv.BRONZE_SOURCES[table]
        run = append_stream(self.spark, self.raw_dir(raw), self.schema(raw), self.sink(table), self.ckpt(table),
                            ruleset=inv.BRONZE_RULES[table], max_bytes=self.batch_bytes(self.raw_dir(raw)))
        self.runs.setdefault(table, []).append(run)
        return run

    def bronze(self, table: str) -> str:
        """Land the raw table (trades: in parts, refreshing after each)."""
        if table in self.runs:
            return self.sink(table)
        raw = inv.BRONZE_SOURCES[table]
        if table == "bronze_trade_executions":
            for part in range(self.trade_arrivals):
                self._stage(raw, part)
                self.refresh_bronze(table)
        else:
            self._stage(raw)
            self.refresh_bronze(table)
        return self.sink(table)

    def _silver_dim(self, table: str) -> DataFrame:
        """Batch read of a bronze sink, cleaned into its silver dimension."""
        src = {"silver_securities_master": ("bronze_securities_master", inv.silver_securities_master),
               "silver_counterparties": ("bronze_counterparties", inv.silver_counterparties),
               "silver_fund_structures": ("bronze_fund_structures", inv.silver_fund_structures)}[table]
        # with the schema given, a micro-batch needs no job to find it out
        schema = self.schema(inv.BRONZE_SOURCES[src[0]])
        return src[1](self.spark.read.schema(schema).parquet(self.bronze(src[0])))

    def silver_market_data(self) -> str:
        t = "silver_market_data"
        if t not in self.runs:
            src = self.bronze("bronze_market_data")
            run = append_stream(self.spark, src, self.schema("raw_market_data"), self.sink(t), self.ckpt(t),
                                transform=inv.market_data_unfiltered, ruleset=inv.SILVER_RULES[t],
                                max_bytes=self.batch_bytes(src))
            self.runs[t] = [run]
        return self.sink(t)

    def silver_fx_rates(self) -> str:
        t = "silver_fx_rates"
        if t not in self.runs:
            src = self.bronze("bronze_fx_rates")
            run = append_stream(self.spark, src, self.schema("raw_fx_rates"), self.sink(t), self.ckpt(t),
                                transform=lambda d: d.select(*inv.FX_COLUMNS), ruleset=inv.SILVER_RULES[t],
                                max_bytes=self.batch_bytes(src))
            self.runs[t] = [run]
        return self.sink(t)

    def _dimension_readers(self) -> dict:
        """Per dimension, how a micro-batch reads it during this refresh.

        A dimension within ``stream_dimension_bytes`` (estimated from its files)
        is re-read for every batch. A larger one is written once per refresh,
        bucketed on its key, so a batch's sort-merge join shuffles only the batch.
        """
        keys = {"silver_securities_master": "security_id", "silver_counterparties": "counterparty_id",
                "silver_fund_structures": "fund_id"}
        readers = {}
        self._refresh_no = getattr(self, "_refresh_no", 0) + 1
        for dim, key in keys.items():
            df = self._silver_dim(dim)
            if scan_bytes(df) <= self.params.stream_dimension_bytes:
                readers[dim] = (lambda d=dim: self._silver_dim(d))
            else:
                name = f"tg_{self.base.rsplit('-', 1)[-1]}_{dim}_{self._refresh_no}"
                path = f"{self.base}/dims/{dim}/refresh={self._refresh_no}"
                n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
                table = write_bucketed(df, name, key, n, path)
                readers[dim] = (lambda t=table: t)
        return readers

    def refresh_enriched(self) -> StreamRun:
        t = "silver_enriched_trades"
        dims = self._dimension_readers()

        def enrich(batch: DataFrame) -> DataFrame:
            # small dimensions re-read per micro-batch (point in time); large
            # ones read from this refresh's bucketed copy
            return inv.enriched_trades_unfiltered(batch, dims["silver_securities_master"](),
                                                  dims["silver_counterparties"](),
                                                  dims["silver_fund_structures"](), self.params)

        src = self.sink("bronze_trade_executions")
        run = enrich_stream(self.spark, src, self.schema("raw_trade_executions"), self.sink(t), self.ckpt(t), enrich,
                            inv.SILVER_RULES[t], max_bytes=self.batch_bytes(src))
        self.runs.setdefault(t, []).append(run)
        return run

    def silver_enriched_trades(self) -> str:
        t = "silver_enriched_trades"
        if t in self.runs:
            return self.sink(t)
        for d in ("bronze_securities_master", "bronze_counterparties", "bronze_fund_structures"):
            self.bronze(d)
        raw = "raw_trade_executions"
        for part in range(self.trade_arrivals):
            self._stage(raw, part)
            self.refresh_bronze("bronze_trade_executions")
            self.refresh_enriched()
        self.runs.setdefault("bronze_trade_executions", [])
        return self.sink(t)

    def full_refresh(self, table: str) -> DataFrame:
        """Everything that has arrived, reprocessed into a new sink under a new checkpoint."""
        raw = inv.BRONZE_SOURCES[table]
        self.bronze(table)
        sink, checkpoint = full_refresh(self.spark, table)
        append_stream(self.spark, self.raw_dir(raw), self.schema(raw), sink, checkpoint,
                      ruleset=inv.BRONZE_RULES[table], max_bytes=self.batch_bytes(self.raw_dir(raw)))
        return self.spark.read.parquet(sink)

    def rerun_is_noop(self, table: str) -> bool:
        """A refresh with nothing new adds no rows."""
        before = self.spark.read.parquet(self.sink(table)).count()
        if table == "silver_enriched_trades":
            self.refresh_enriched()
            after = read_enriched(self.spark, self.sink(table)).count()
        else:
            self.refresh_bronze(table)
            after = self.spark.read.parquet(self.sink(table)).count()
        return before == after

    # --- results --------------------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        if name in inv.BRONZE_SOURCES:
            return self.spark.read.parquet(self.bronze(name))
        if name == "silver_market_data":
            return self.spark.read.parquet(self.silver_market_data())
        if name == "silver_fx_rates":
            return self.spark.read.parquet(self.silver_fx_rates())
        if name == "silver_enriched_trades":
            return read_enriched(self.spark, self.silver_enriched_trades())
        raise KeyError(name)

    def metrics(self, table: str) -> dict[str, int]:
        """Rule counts of all micro-batches of ``table``, from its metrics files."""
        return batch_metrics(self.spark, self.ckpt(table))


STREAM_TABLES = tuple(inv.BRONZE_SOURCES) + ("silver_enriched_trades", "silver_market_data", "silver_fx_rates")
