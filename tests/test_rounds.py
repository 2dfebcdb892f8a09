"""Loops of joins: their state's estimated size does not grow with the rounds."""

from pyspark.sql import functions as F

from locus.operators import sv


def test_a_chain_in_text_order_settles_with_a_small_estimate(spark):
    n = F.concat(F.lit("n"), F.col("id").cast("string"))
    edges = spark.range(90, 400).where("id <> 250").select(n.alias("a"), F.concat(F.lit("n"), (F.col("id") + 1).cast("string")).alias("b"))
    got = sv.connected(edges, "a", "b")
    assert int(str(got._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 1 << 63
    low, high = min(f"n{i}" for i in range(90, 251)), min(f"n{i}" for i in range(251, 401))
    assert {(r.node, r.path) for r in got.collect()} == {(f"n{i}", low if i <= 250 else high) for i in range(90, 401)}
