"""Chain blocks grow with the data, so no plan broadcasts them, however small their files look."""

from locus.plans.registry import QUERIES


def test_lifting_points_broadcasts_no_blocks(spark):
    plan = QUERIES["liftover_points"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert [x.split("[")[0] for x in plan.split("\n") if "_rc#" in x and "BroadcastHashJoin" in x] == []
    assert "SortMergeJoin" in plan
