"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, n_words, ranked, table

WEIGHTS, SHARE, CAP = (5, 2, 1), 1.5, 2.0


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row for each source with its size, document count and target.

    Sources in code point order, null last, take the weights in turn and split `share` times all sizes by them. A
    target stops at `cap` times its source's size and the excess is shared again by weight: in order of size over
    weight, sources reach their caps one after another, and the rest share what is left, so running sums give the
    final level without a loop. The windows run over one row per source, already aggregated, in one task: enough for
    millions of sources. An empty table has no source and gives no row.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, whole = by_room.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    nth = (F.row_number().over(everything) - 1) % len(weights)
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (nth + 1).cast("int")))
    per = per.withColumns({"_all": F.sum("source_size").over(whole), "_w": F.sum("weight").over(whole)})
    per = per.withColumns({"_full": F.coalesce(F.sum("source_size").over(earlier), F.lit(0)), "_spent": F.coalesce(F.sum("weight").over(earlier), F.lit(0))})
    level = (F.lit(float(share)) * F.col("_all") - F.lit(float(cap)) * F.col("_full")) / (F.col("_w") - F.col("_spent"))
    per = per.withColumn("_level", level)
    # The level that holds is the first that no later source's cap is below.
    holds = F.min(F.when(F.col("_level") * F.col("weight") <= F.lit(float(cap)) * F.col("source_size"), F.struct("_spent", "_level"))).over(whole)["_level"]
    limit = F.lit(float(cap)) * F.col("source_size")
    return per.withColumn("_held", holds).select("source", "source_size", "n_docs", F.when(F.col("_held").isNull() | (F.col("_held") * F.col("weight") > limit), limit).otherwise(F.col("_held") * F.col("weight")).alias("target"))


def offset(source: Column) -> Column:
    """The source's offset in [0, 1), drawn from a hash of its name so that reruns agree."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(source, F.lit("\x00")))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def draws(sized: DataFrame, order: Sequence[str] = ("size", "doc_id")) -> DataFrame:
    """Adds source_size, target and copies to rows that have source and size.

    Each document of a source expects target / source size copies. Going through the source in order of size, the
    running sum of expected copies is expected x rank; a document is emitted once for each integer that this sum,
    moved by the source's offset, crosses at it. Neighbours in size take turns, so the words taken come near the
    target. Empty texts have size 0 and take no words. A source holding most rows is ranked over many tasks. Repeated
    rows are drawn each on its own; ties in `order` are ranked once and kept. Columns named rank, source_size, target or
    copies must not be among the rows, which should hold keys alone.
    """
    at = ranked(sized, "source", order)
    per = checkpointed(targets(at))
    per = per.select(F.col("source").alias("_s"), "source_size", "target")
    joined = at.join(per, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(offset(F.col("source")) + expected * F.col("rank")) - F.floor(offset(F.col("source")) + expected * (F.col("rank") - 1))
    return joined.withColumn("copies", crossed.cast("long")).drop("rank")


def mixed(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """The rows of docs, each as many times as the mix takes it.

    Only keys and sizes are ranked. Rows that agree in id, source and text are counted together and the copies
    that fall to them are shared out in turn, over many tasks if they are many. Nulls in any column are values of their
    own; an empty table gives an empty result, and other columns come along whatever their names. A very long text is
    counted like any other and never gathered with its source.
    """
    key = {"_id": F.col("doc_id"), "_src": F.col(f"`{source}`"), "_h": F.xxhash64(F.col(f"`{text}`"))}
    keyed = docs.select(*[v.alias(k) for k, v in key.items()], n_words(F.col(f"`{text}`")).alias("size"))
    drawn = draws(keyed.select(F.col("_src").alias("source"), "size", F.col("_id").alias("doc_id"), "_h"), ("size", "doc_id", "_h"))
    per_key = drawn.groupBy("doc_id", "source", "_h").agg(F.sum("copies").alias("_c"), F.count(F.lit(1)).alias("_m"))
    per_key = checkpointed(per_key.select(F.col("doc_id").alias("_id2"), F.col("source").alias("_src2"), F.col("_h").alias("_h2"), "_c", "_m").where("_c > 0"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(row, *[v.alias(k) for k, v in key.items()])
    same = F.col("_id").eqNullSafe(F.col("_id2")) & F.col("_src").eqNullSafe(F.col("_src2")) & (F.col("_h") == F.col("_h2"))
    rows = rows.join(per_key, same)
    taken = rows.select("_row", F.col("_c").alias("_take"))
    if not per_key.where("_m > 1").isEmpty():
        # Equal keys take turns: their rows are numbered by content, and those equal in all columns in any order.
        turns = rows.where("_m > 1").select("_row", "_c", "_m", F.to_json(F.struct("_id", "_src", "_h")).alias("_k"), F.xxhash64(F.to_json("_row")).alias("_o"), F.monotonically_increasing_id().alias("_u"))
        turns = ranked(turns, "_k", ("_o", "_u"), "_turn")
        take = F.expr("_c div _m") + F.when(F.col("_turn") <= F.col("_c") % F.col("_m"), 1).otherwise(0)
        taken = rows.where("_m = 1").select("_row", F.col("_c").alias("_take")).unionByName(turns.select("_row", take.alias("_take"))).where("_take > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_take")))).select("_row.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    return draws(sized).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


SQL = {
    "op9_mixing": r"""
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3)::INT] AS weight FROM p),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER e, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER e, 0)) AS level,
             coalesce(sum(weight) OVER e, 0) AS spent
      FROM w WINDOW e AS (ORDER BY source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
h AS (SELECT arg_min(level, spent) AS held FROM l WHERE level * weight <= 2.0::DOUBLE * source_size),
t AS (SELECT source, source_size, CASE WHEN held IS NULL OR held * weight > 2.0::DOUBLE * source_size THEN 2.0::DOUBLE * source_size ELSE held * weight END AS target FROM l, h),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS x,
             ('0x' || substr(md5('mix:' || coalesce(d.source, chr(0))), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS o,
             row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS k
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (floor(o + x * k) - floor(o + x * (k - 1)))::BIGINT * size AS taken FROM r
"""
}
QUERIES = {"op9_mixing": op9_mixing}
