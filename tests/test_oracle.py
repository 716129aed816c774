"""Every registered query against its SQL oracle on the smallest tables."""

import pytest

from checks.compare import compare, connect
from checks.queries import QUERIES
from layer_cases import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, SF, name)
    assert ok, note


def test_no_unbounded_cross_joins(spark):
    for name in ("q_clip_points", "q_clip_lines", "q_sample_elevation", "q_line_self_crossing", "q_terrain_mesh", "q_raster_warp"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
