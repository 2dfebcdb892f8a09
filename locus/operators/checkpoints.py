"""Cutting lineage in a folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which a query's shuffle files go when it has ended.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, set from spark.checkpoint.dir if need be.

    Only on a local master, where driver and executors are one process, may the setting be absent.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that begin inside leave no shuffle files behind; else these stay until the driver happens to collect its garbage.

    For steps whose rows are stored: nothing reads their shuffles again, and many steps' shuffles would lie on disk at once.
    """
    before = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as they are now, reliably stored: what is drawn from them does not change if an executor is lost."""
    shared_folder(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a query of its own, as the setting is read when it is made


def stored(df: DataFrame) -> DataFrame:
    """As checkpointed(), for loops: a table in the shared folder, whose size is that of its files.

    A checkpoint keeps the estimate of the plan that made it, and that of a join is the product of its sides: in a loop it
    is squared at each round, until the number itself fills the driver. Only columns that a step reads are read again.
    """
    path = f"{shared_folder(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._rows_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Removes the files of stored() tables that nothing reads any more, such as those of a loop's earlier rounds."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._rows_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
