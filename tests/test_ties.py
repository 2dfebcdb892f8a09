"""Ties and constants: what a query and its SQL pick does not hang on the order of rows or on the size of the tables."""

import os

from pyspark.sql import functions as F

from locus.operators import elements as e
from locus.plans.registry import QUERIES, SQL

from .oracle import TABLES, same

BIG = "/root/testdata/sf0.1"


def beside(path, small="/root/testdata/sf0.001", own=()):
    """A folder of tables: those named in `own` are the test's."""
    for t in set(TABLES) - set(own):
        os.symlink(f"{small}/{t}.parquet", path / f"{t}.parquet")
    return str(path)


def test_end_alignments_with_equal_places_of_equal_reads(spark):
    rows = [("k", 1, c, s, s + 40, "+", 9, 49, 7) for c, s in ((2, 5), (1, 8), (1, 3), (3, 1))]
    names = "insert_key string, hap long, contig long, start long, `end` long, strand string, q_start long, q_end long, ord long"
    poly = spark.createDataFrame([("k", "polyT")], "insert_key string, poly string")
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        got = e.end_alignments(spark.createDataFrame(order, names).coalesce(1), poly).collect()
        assert [(r.contig, r.start) for r in got] == [(1, 3)]


def test_best_hits_over_more_than_ten_thousand_parts(spark):
    same(spark, QUERIES["best_hit_per_family"], SQL["best_hit_per_family"], BIG)


def test_peaks_with_a_root_far_below_the_normal_rule(spark, tmp_path):
    """Four levels, each shared by thousands: the bandwidth is less than 0.005 times the normal rule's."""
    k = F.col("id")
    rows = spark.range(60000).select(k.alias("l_orderkey"), F.element_at(F.array(*[F.lit(x) for x in (10, 20, 30, 40)]), (k % 4 + 1).cast("int")).cast("long").alias("l_partkey"), F.lit(3).cast("long").alias("l_suppkey"), F.lit(1).alias("l_linenumber"), (k % 50 + 1).cast("double").alias("l_quantity"))
    rows.toPandas().to_parquet(tmp_path / "lineitem.parquet")
    sf = beside(tmp_path, own=["lineitem"])
    same(spark, QUERIES["detect_peaks"], SQL["detect_peaks"], sf)
    assert QUERIES["detect_peaks"](spark, sf).count() > 0
