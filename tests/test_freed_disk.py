"""Stored steps and rounds leave nothing behind on disk that is not read again."""

import os
import time
from urllib.parse import urlparse

from pyspark.sql import functions as F

from locus.operators import checkpoints, sv


def shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",")
    return {f for f in files.split(",") if "/shuffle_" in f}


def test_stored_steps_leave_no_shuffle_files(spark):
    for step in (checkpoints.checkpointed, checkpoints.stored):
        before = shuffles(spark)
        got = step(spark.range(3000).groupBy((F.col("id") % 100).alias("k")).count())
        end = time.time() + 20  # executors are told, not waited for
        while (rest := shuffles(spark) - before) and time.time() < end:
            time.sleep(0.1)
        assert not rest and got.agg(F.sum("count")).first()[0] == 3000
    assert spark.conf.get(checkpoints.FREED) == "false"


def test_rounds_leave_their_last_table(spark):
    """A path of 40 edges takes six rounds, each of which was a table that stayed."""
    folder = urlparse(checkpoints.shared_folder(spark)).path
    tables = lambda: {n for n in os.listdir(folder) if n.startswith("rows-")}
    before = tables()
    edges = spark.createDataFrame([(f"p{i:02}", f"p{i + 1:02}", "+", "+", i, "x") for i in range(40)], "from_sv string, to_sv string, from_turn string, to_turn string, first_size long, sizes string")
    svs = spark.createDataFrame([(f"p{i:02}", "c", 10 * i, "+", "d", 10 * i + 5, "-") for i in range(41)], "sv_id string, chr1 string, pos1 long, dir1 string, chr2 string, pos2 long, dir2 string")
    assert sv.link_rearrangements(edges, svs).count() == 41
    assert len(tables() - before) == 3  # edges, steps and the last round
