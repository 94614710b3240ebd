"""tiergrain: layered (raw -> bronze -> silver -> gold) analytics on PySpark.

Every dataset is a plain function from DataFrames (and a frozen parameter
object) to a lazy DataFrame, so Catalyst sees one plan per dataset and can
push filters, prune columns and pick join strategies on its own.
"""

from tiergrain.params import Params, REFERENCE_PARAMS, TEST_PARAMS
from tiergrain.session import build_session, shared_dir

__all__ = ["Params", "REFERENCE_PARAMS", "TEST_PARAMS", "build_session", "shared_dir"]
