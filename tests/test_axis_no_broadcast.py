from locus.plans.registry import QUERIES


def test_placing_annotation_broadcasts_no_rows(spark):
    plan = QUERIES["place_annotation_on_axis"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert [x.split("[")[0] for x in plan.split("\n") if "_rc#" in x and "BroadcastHashJoin" in x] == []
    assert "SortMergeJoin" in plan
