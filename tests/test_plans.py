"""Plan checks: no Cartesian products or nested-loop joins on facts, no Python
evaluation outside the radius geometry, pruned scans."""

import pytest

from conftest import SF_SMALL
from panelcast.operators import links, rollup, spatial, threads
from panelcast.plans import network as NW
from panelcast.plans import nowcast as N
from panelcast.sources import bindings as B

BAD = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _pipelines(spark):
    sf = SF_SMALL
    ev = B.outbreak_events(spark, sf)
    presence = links.presence_set(NW.monthly_panel(spark, sf))
    static, yearly = NW.link_edges(spark, sf)
    return {
        "rollup": rollup.rollup_reports(B.six_month_reports(spark, sf), taxa_list=B.B1_TAXA_LIST,
                                        taxa_drop=[], taxa_merge=B.B1_TAXA_MERGE),
        "lagged_panel": N.lagged_panel(N.init_reports(spark, sf), 3),
        "thread_panel": threads.thread_month_panel(ev, B.GRID_START, B.AS_OF),
        "import_pressure": links.import_pressure(presence, static, yearly),
        "import_pairs": links.import_origins(presence, links.merged_edges(static, yearly, B.GRID_START.year, B.AS_OF.year)),
        "scored": N.scored_baseline(spark, sf),
    }


@pytest.mark.parametrize("name", ["rollup", "lagged_panel", "thread_panel", "import_pressure",
                                  "import_pairs", "scored"])
def test_no_pairs_no_python(spark, name):
    plan = _plan(_pipelines(spark)[name])
    for bad in BAD:
        assert bad not in plan, f"{name}: {bad}"


def test_radius_python_is_grouped_pandas_only(spark):
    pts = B.outbreak_points(spark, SF_SMALL)
    plan = _plan(spatial.bounding_radius(pts, ["species_name"]))
    assert "MapInPandas" in plan
    for bad in BAD:
        assert bad not in plan


def test_scan_is_pruned(spark):
    plan = _plan(B.six_month_reports(spark, SF_SMALL))
    scan = [line for line in plan.splitlines() if "lineitem" in line and "FileScan" in line][0]
    for unused in ("l_extendedprice", "l_discount", "l_tax", "l_orderkey"):
        assert unused not in scan
