"""Rows that a task's aggregates hold: distinct rows stand in as many tasks as the session shuffles into."""

import pytest

from locus.plans.registry import QUERIES
from locus.plans.standins import distinct_rows, standin


@pytest.mark.parametrize("name", ["interval_join", "annotate_repeat", "annotate_genes"])
def test_distinct_rows_are_not_gathered(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_distinct_rows_are_those_of_the_standin(spark):
    cols = ["site", "contig", "start", "end"]
    a, b = (x.select(*cols).collect() for x in (distinct_rows(spark, "/root/testdata/sf0.001", "sites", cols), standin(spark, "/root/testdata/sf0.001", "sites").select(*cols).distinct()))
    assert sorted(a) == sorted(b)
