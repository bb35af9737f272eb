"""Plan guards: no cartesian products or nested-loop joins, no Python UDFs in
any registered query; top-n queries are limited before their shuffle."""
import pytest

import __spark_entry__ as E
from matchmart.plans.queries import registry

SMALL = "/root/testdata/sf0.001"
SKIP = {"boosted_classifier", "isotonic_calibration", "kfold_accuracy", "feature_importance",
        "feature_ranking", "predict_batch", "incremental_stream", "mat_table", "scan_raw",
        "model_params_io", "poisson_fit", "temporal_split", "model_registry"}
KEYS = [k for k in registry() if k not in SKIP]


def _plan(spark, key):
    df = E.queries()[key](spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_cross_join_no_python_udf(spark, key):
    plan = _plan(spark, key)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in plan, (key, bad)


@pytest.mark.parametrize("key", ["last_n_per_pair", "h2h_stats", "latest_per_key", "match_features"])
def test_top_n_uses_window_group_limit(spark, key):
    assert "WindowGroupLimit" in _plan(spark, key)
