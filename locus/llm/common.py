"""What several corpus operators share: checkpoints, let-bindings, word splitting, ranks and components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from locus.operators.checkpoints import checkpointed as checkpointed
from locus.operators.checkpoints import shared_folder

#: The white space that separates words in the corpus contracts.
WS = r"[\x20\x09-\x0D]+"
_WS_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Reads one of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Binds a value once, so that lambdas in the body don't evaluate it again for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_WS_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS, -1))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ranked(df: DataFrame, key: str, order: Sequence[str], rank: str = "rank") -> DataFrame:
    """Numbers the rows of each key from 1 in the given order, without gathering a key in one task.

    Rows are range-partitioned by key and order, so that a hot key spreads over tasks; each row's place in its
    partition is moved by the number of rows that the key has in earlier partitions. The offsets have one row
    for each key and partition that meet. The order should be total; ties are numbered arbitrarily but once.
    The result is checkpointed, as ranks must not be drawn anew.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, key, *order).sortWithinPartitions(key, *order).withColumn("_at", F.monotonically_increasing_id())
    placed = checkpointed(placed.withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND((1 << 33) - 1)}))
    runs = placed.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_run")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_key").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    joined = placed.join(runs, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_run")))
    return joined.withColumn(rank, F.col("_at") - F.col("_first") + F.col("_before") + 1).drop("_at", "_part", "_key", "_run", "_first", "_n", "_before")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (a, b), where root is the smallest node that can be reached.

    Alternates large-star and small-star steps (Kiveris et al., Connected Components in MapReduce and Beyond)
    until nothing changes; the number of rounds grows with the logarithm of the longest path. Each round is
    checkpointed. Stars are taken by aggregates and joins, so no component is gathered in a task.
    """
    now = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    state = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        now = checkpointed(small.where("a <> b").distinct())
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components have not settled in {most_rounds} rounds")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes a table under the checkpoint folder, which all executors share, and reads it back.

    The result is lazy, so its files stay until the folder is cleared, like those of checkpoints.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def nullable(kind: T.DataType) -> T.DataType:
    """The type with all parts nullable, as Arrow results of grouped functions are checked against."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType), True)
    return kind
