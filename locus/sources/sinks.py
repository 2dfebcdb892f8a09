"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_sentinels(df: DataFrame, missing: str = "-") -> DataFrame:
    """All columns as text: nulls as the sentinel, booleans as True and False."""
    out = {}
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        text = F.when(c, "True").otherwise("False") if kind == "boolean" else c.cast("string")
        out[name] = F.when(c.isNull(), missing).otherwise(text)
    return df.select(*[v.alias(k) for k, v in out.items()])


def write_table_tsv(df: DataFrame, path: str, missing: str = "-") -> None:
    with_sentinels(df, missing).write.csv(path, sep="\t", header=True, quote="", emptyValue="")


def write_intervals_sorted(df: DataFrame, path: str) -> None:
    """Range-partitioned and sorted by (contig, start), so that row groups can be skipped by place."""
    df.repartitionByRange("contig", "start").sortWithinPartitions("contig", "start").write.parquet(path)


def distinct_header(lines: DataFrame) -> DataFrame:
    """First-seen distinct lines: (line, ord)."""
    return lines.groupBy("line").agg(F.min("ord").alias("ord"))


#: INFO fields that annotated variants carry. Fixed values.
ADDED_INFO = {"HAPLOTYPE": "Haplotype", "KMER_RATIO": "K-mer ratio", "VAF": "Variant allele fraction", "DEPTH": "Depth", "NORMAL_VAF": "VAF in the normal"}


def variant_set(chunks: list[DataFrame], headers: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(variants, metadata) of caller chunks: rows united, meta lines distinct, contig lines from the lengths."""
    first, *rest = chunks
    for c in rest:
        if c.schema.simpleString() != first.schema.simpleString():
            raise ValueError("the chunks' columns differ")
        first = first.unionByName(c)
    meta = distinct_header(headers.where(~F.col("line").startswith("##contig")))
    contigs = lengths.select(F.concat(F.lit("##contig=<ID="), "contig", F.lit(",length="), F.col("length").cast("string"), F.lit(">")).alias("line"), F.lit(None).cast("bigint").alias("ord"))
    added = headers.sparkSession.createDataFrame([(f'##INFO=<ID={k},Number=1,Type=String,Description="{v}">', None) for k, v in ADDED_INFO.items()], "line string, ord bigint")
    return first, meta.unionByName(contigs).unionByName(added)


def write_variant_set(variants: DataFrame, metadata: DataFrame, path: str) -> None:
    variants.write.partitionBy("contig").parquet(f"{path}/variants")
    metadata.write.parquet(f"{path}/metadata")


def flank_sequences(df: DataFrame, chunks: DataFrame, lengths: DataFrame, chunk: int, flank: int = 100) -> DataFrame:
    """(id, seq): the sequence around each variant."""
    from locus.operators.intervals import extract_sequence, flank_window

    rows = df.join(lengths, "contig")
    a, b = flank_window(F.col("start"), F.col("end"), F.col("length"), flank)
    return extract_sequence(rows.select("id", "contig", a.alias("start"), b.alias("end"), F.lit("+").alias("strand")), chunks, ["id"], chunk)
