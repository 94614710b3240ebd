"""Plan checks over every batch key: no cartesian / nested-loop joins and no
Python evaluation (everything stays in JVM codegen)."""

import pytest

from tiergrain.plans.registry import REGISTRY

from conftest import SF001

BATCH_KEYS = sorted(k for k in REGISTRY if not k.startswith(("stream_", "refresh_")))
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_plan_shape(spark, key):
    df = REGISTRY[key].build(spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{key}: {op}"


def test_building_a_frame_runs_no_job(spark):
    """Before the action only schemas are read."""
    keys = [k for k in REGISTRY if k.startswith(("inv_", "ins_", "ext_", "dq_"))]
    tracker = spark.sparkContext.statusTracker()
    for key in keys:
        spark.sparkContext.setJobGroup(f"build-{key}", "")
        try:
            REGISTRY[key].build(spark, SF001)
        finally:
            spark.sparkContext.setJobGroup("tests", "")
        for job in tracker.getJobIdsForGroup(f"build-{key}"):
            for stage in tracker.getJobInfo(job).stageIds:
                assert tracker.getStageInfo(stage).name.startswith("parquet at "), (key, tracker.getStageInfo(stage).name)
