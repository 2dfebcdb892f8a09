"""Interval joins ask only in bins of the levels that the right side has."""

import random

import pytest

from locus.operators import intervals as iv


@pytest.mark.parametrize("lengths", [(5,), (5, 300_000), (9_000_000_000,), ()])
@pytest.mark.parametrize("both", [False, True])
def test_pairs_at_the_levels_in_use(spark, lengths, both):
    rng = random.Random(3)
    kind = "contig string, start long, `end` long, ord long"
    spans = lambda n, sizes: [(rng.choice(["a", "b", None]), s := rng.randrange(-500, 40_000), s + rng.randrange(0, 2 * rng.choice(sizes)), i) for i in range(n)]
    rows, far = spans(60, (5, 40_000) if both else (5, 900)), spans(60, lengths) if lengths else []
    out = iv.interval_join(spark.createDataFrame(rows, kind), spark.createDataFrame(far, kind), both=both)
    want = sorted((x[3], y[3]) for x in rows for y in far if x[0] and x[0] == y[0] and y[1] < x[2] and y[2] > x[1])
    assert sorted(map(tuple, out.select("ord", "r_ord").collect())) == want


def test_point_asks_in_one_bin_of_short_intervals(spark):
    """It stood in a bin of each of the four levels, and all were shuffled."""
    left = spark.range(1000).selectExpr("'a' as contig", "id * 500 + 7 as start", "id * 500 + 8 as `end`")
    right = spark.range(1000).selectExpr("'a' as contig", "id * 500 as start", "id * 500 + 10 as `end`", "id as ord")
    out = iv.interval_join(left, right.hint("merge"))
    assert out.count() == 1000

    def rows(node):  # rows of the exchanges' inputs, from the metrics of the run
        name, kids = node.nodeName(), node.children()
        if name == "AdaptiveSparkPlan":
            return rows(node.executedPlan())
        if "QueryStage" in name:
            return rows(node.plan())
        own = [node.metrics().apply("shuffleRecordsWritten").value()] if name == "Exchange" and node.metrics().contains("shuffleRecordsWritten") else []
        return own + [x for i in range(kids.size()) for x in rows(kids.apply(i))]

    out._jdf.collectToPython()
    assert max(rows(out._jdf.queryExecution().executedPlan())) == 1000
