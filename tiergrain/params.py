"""Typed pipeline parameters.

The reference reads strings from pipeline configuration and parses them to
floats when a module loads; here they are one frozen object passed to every
dataset function, with ``from_conf`` reading the same configuration keys.
The clock (``current_date`` / ``current_timestamp``) is the ``as_of`` field so
that a rerun gives the same rows.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import SparkSession


@dataclasses.dataclass(frozen=True)
class Params:
    as_of: dt.datetime = dt.datetime(2001, 6, 30, 0, 0, 0)
    base_currency: str = "USD"
    max_single_risk_pct: float = 10.0
    max_peril_concentration_pct: float = 25.0
    min_loss_ratio_threshold: float = 0.75
    max_aggregate_limit_usd: float = 500_000_000.0
    near_breach_factor: float = 0.8
    default_cession_rate: float = 0.30
    expense_ratio: float = 0.32
    # a streaming refresh re-reads a dimension for every micro-batch up to this
    # many (estimated) bytes; a larger one is written once per refresh, bucketed
    # on its key, so that a micro-batch never shuffles it
    stream_dimension_bytes: int = 10 << 20
    # a micro-batch of a streaming table takes whole files of about this many bytes, or more
    # if a refresh of all that has arrived would need over stream_refresh_batches of them
    stream_batch_bytes: int = 1 << 30
    stream_refresh_batches: int = 8
    # windows over the rows of one claim run in slices of this many days of its
    # losses, so that no task holds a whole claim; None = plain window
    claim_slice_days: int | None = 1

    @property
    def as_of_date(self) -> dt.date:
        return self.as_of.date()

    @property
    def claim_slice(self) -> int | None:
        """``claim_slice_days`` in microseconds."""
        return None if self.claim_slice_days is None else self.claim_slice_days * 86_400_000_000

    def replace(self, **kw) -> "Params":
        return dataclasses.replace(self, **kw)

    @classmethod
    def from_conf(cls, spark: SparkSession, base: "Params | None" = None) -> "Params":
        """Override fields from session configuration (``ins.*`` keys)."""
        p = base or cls()
        keys = {
            "ins.base_currency": ("base_currency", str),
            "ins.max_single_risk_pct": ("max_single_risk_pct", float),
            "ins.max_peril_concentration_pct": ("max_peril_concentration_pct", float),
            "ins.min_loss_ratio_threshold": ("min_loss_ratio_threshold", float),
            "ins.max_aggregate_limit_usd": ("max_aggregate_limit_usd", float),
        }
        kw = {}
        for key, (field, conv) in keys.items():
            v = spark.conf.get(key, None)
            if v is not None:
                kw[field] = conv(v)
        asof = spark.conf.get("ins.as_of", None)
        if asof:
            kw["as_of"] = dt.datetime.fromisoformat(asof)
        return p.replace(**kw)


# The reference's configured defaults.
REFERENCE_PARAMS = Params()

# Test thresholds (FIXTURES.md): chosen so CRITICAL, WARNING and CLEAR all
# occur for every compliance rule on the testdata bindings.
TEST_PARAMS = Params(
    max_single_risk_pct=0.12,
    max_peril_concentration_pct=11.0,
    max_aggregate_limit_usd=5e9,
    stream_batch_bytes=4 << 20,     # several micro-batches at sf0.1
)
