"""Samples, pairs and contig chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def validate_manifest(df: DataFrame) -> DataFrame:
    """Violations as (sample, problem): names, types, one normal, assembly pairs, sequencing data."""
    bad = df.select("sample", F.explode(F.array_compact(F.array(
        F.when(F.col("sample") == "", "empty name"), F.when(~F.col("type").isin("tumor", "normal"), "unknown type"),
        F.when((F.col("assembly_hap1") == "") | (F.col("assembly_hap2") == ""), "no assembly pair"), F.when((F.size("ont") == 0) & (F.size("hifi") == 0), "no reads"),
    ))).alias("problem"))
    twice = df.groupBy("sample").count().where("count > 1").select("sample", F.lit("repeated name").alias("problem"))
    normals = df.agg(F.count(F.when(F.col("type") == "normal", 1)).alias("n"), F.count_distinct("assembly_hap1", "assembly_hap2").alias("pairs"))
    whole = normals.select(F.lit("*").alias("sample"), F.explode(F.array_compact(F.array(F.when(F.col("n") != 1, "not one normal"), F.when(F.col("pairs") != 1, "not one assembly pair")))).alias("problem"))
    return bad.unionByName(twice).unionByName(whole)


def pair_samples(df: DataFrame) -> DataFrame:
    """Each tumour with its normal (named in paired_normal, else the only one) and the sequencing types of both."""
    kinds = F.array_compact(F.array(F.when(F.size("hifi") > 0, "hifi"), F.when(F.size("ont") > 0, "ont")))
    t = df.withColumn("kinds", kinds)
    n = t.where("type = 'normal'").select(F.col("sample").alias("normal"), F.col("kinds").alias("nk"))
    named = F.col("paired_normal") if "paired_normal" in df.columns else F.lit(None).cast("string")
    named = F.nullif(named, F.lit(""))
    tumours = t.where("type = 'tumor'").select("sample", "kinds", named.alias("_named"))
    only = n.agg(F.min("normal").alias("_only"))
    pairs = tumours.join(F.broadcast(only)).withColumn("normal", F.coalesce("_named", "_only")).join(n, "normal")
    both = F.array_intersect("kinds", "nk")
    return pairs.select("sample", "normal", both.alias("seqtypes"), F.get(both, F.lit(0)).alias("primary"))


def chunk_manifest(lengths: DataFrame, min_bp: int) -> DataFrame:
    """Contigs of at least min_bp alone, the rest together: chunk, n, bp, contigs."""
    big = F.col("length") >= min_bp
    key = F.when(big, F.col("contig").cast("string")).otherwise("rest")
    g = lengths.groupBy(key.alias("chunk")).agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bp"), F.array_sort(F.collect_list(F.col("contig").cast("string"))).alias("c"))
    return g.select("chunk", "n", "bp", F.array_join("c", ",").alias("contigs"))


def sort_by_contig_order(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """Rows by the contig table's order and position; an unknown contig is an error."""
    out = df.join(contigs.select(F.col("contig").alias("_c"), F.col("ord").alias("_o")), F.col("contig") == F.col("_c"), "left")
    known = F.coalesce("_o", F.when(F.col("_o").isNull(), F.raise_error(F.lit("unknown contig")).cast("bigint")))
    return out.withColumn("_o", known).orderBy("_o", "pos").drop("_c", "_o")


def sort_by_locus(df: DataFrame, contig: str = "contig", start: str = "start") -> DataFrame:
    """Rows by contig name and start, as interval files are kept."""
    return df.orderBy(contig, start)


def contigs_by_size(lengths: DataFrame) -> DataFrame:
    return lengths.orderBy(F.desc("length"), "contig")
