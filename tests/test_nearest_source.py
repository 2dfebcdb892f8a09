from locus.operators import elements


def test_sources_are_picked_without_sorting_pairs(spark):
    kind = "contig string, start long, `end` long, strand string, name string, ord long, kind_rank int"
    l1 = [("c", 1000, 1100, "-", "a", 1, 2), ("c", 1000, 1100, "-", "b", 2, 1), ("c", 1000, 1100, "-", "b2", 3, 1), ("c", 1500, 1600, "-", "c", 4, 0), ("c", 900, 950, ".", "no", 5, 0),
          ("c", 8500, 8600, "+", "d", 6, 1), ("c", 8000, 8100, "+", "e", 7, 0), ("c", 8200, 8300, "+", "f", 8, 0), ("c", 8200, 8300, "+", "f2", None, 0)]
    sites = [(1, "c", 900, 910, "+"), (2, "c", 9000, 9010, "-"), (3, "c", 20000, 20010, "+"), (4, "c", 9000, 9010, None), (5, "d", 900, 910, "+")]
    s = spark.createDataFrame(sites, "site long, contig string, start long, `end` long, source_dir string")
    got = elements.nearest_source_l1(s, spark.createDataFrame(l1, kind), ["site"])
    assert {r.site: r.source for r in got.collect()} == {1: "b2", 2: "f", 3: None, 4: None, 5: None}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
