import contextlib
import io

from tillguard.catalog import queries as Q
from tillguard.operators.metrics import roc_auc
from tillguard.plans.features import build_features
from tillguard.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_feature_plan_shape(spark):
    p = _plan(build_features(fx.transactions(spark, SF), bin_mode="bucketed", terminal_mode="bucketed"))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "SinglePartition" not in p                  # no global window / single task
    assert "BatchEvalPython" not in p                  # no row-at-a-time Python UDF
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string," in p


def test_alert_and_metric_plans_have_no_pair_joins(spark):
    for df in (Q._alerts(spark, SF), roc_auc(Q._scored_labeled(spark, SF), "fraud_probability", "is_fraud")):
        p = _plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p and "BatchEvalPython" not in p
