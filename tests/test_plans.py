"""Plan-shape checks for the heavy paths: pruned scans, partial aggregation before the
shuffle, and no cartesian / nested-loop joins over data."""

import contextlib
import io

from churnwatch.operators import counts as K
from churnwatch.operators import evaluate as EV
from churnwatch.sources import tables as S
from tests.conftest import SF001


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_paired_counts_plan(spark):
    d = S.drift_frame(spark, SF001)
    p = plan_of(K.paired_counts(d, S.DRIFT_NUMERIC, S.DRIFT_CATEGORICAL))
    assert "partial_count" in p                       # map-side combine before the exchange
    assert p.count("Exchange hashpartitioning") <= 1 or "hashpartitioning(fid" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    # lineitem read with only the columns the melt needs
    li = [line for line in p.splitlines() if line.startswith("ReadSchema: struct<l_orderkey")][0]
    assert "l_tax" not in li and "l_shipdate" not in li and "l_partkey" not in li


def test_sweep_has_no_cross_join(spark):
    s = S.scored_events(spark, SF001)
    p = plan_of(EV.threshold_sweep(s))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p and "Generate" in p


def test_running_sums_stay_inside_a_range(spark):
    d = S.drift_frame(spark, SF001)
    num = K.numeric_counts(K.paired_counts(d, ["l_extendedprice"], []))
    p = plan_of(K.with_cumulative(num))
    windows = [line for line in p.splitlines() if "windowspecdefinition(feature" in line and "value#" in line]
    assert windows and all("part#" in line for line in windows)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
