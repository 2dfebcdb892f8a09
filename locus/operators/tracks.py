"""Annotation tracks: selection, unions and overlap sums."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locus.functions.fields import with_version

from .intervals import interval_join


def mask_tracks(track: DataFrame, drop_first: bool = True) -> DataFrame:
    """Satellite rows (hor, mon, hsat in the name); the first kept row is dropped unless asked otherwise."""
    kept = track.where(F.col("name").rlike("hor|mon|hsat"))
    if not drop_first:
        return kept
    first = kept.agg(F.min("ord").alias("_first"))  # one row
    return kept.join(F.broadcast(first)).where("ord > _first").drop("_first")


def drop_chr_y(df: DataFrame, sex: str, column: str = "contig") -> DataFrame:
    return df.where(~F.col(column).startswith("chrY")) if sex == "female" else df


def subset_chrom(df: DataFrame, chrom: str, column: str = "contig") -> DataFrame:
    return df.where(F.col(column) == chrom)


def gene_bed_from_gff(gff: DataFrame) -> DataFrame:
    """contig, start (0-based), end, gene_name, strand, gene_id, biotype of named genes that are no pseudogenes."""
    a = F.col("attrs")
    genes = gff.where((F.col("feature") == "gene") & a["gene_name"].isNotNull() & ~F.coalesce(a["gene_biotype"], F.lit("")).contains("pseudogene"))
    return genes.select("contig", (F.col("start") - 1).alias("start"), "end", a["gene_name"].alias("gene_name"), "strand", a["gene_id"].alias("gene_id"), a["gene_biotype"].alias("biotype"), "ord")


def exon_bed_from_gtf(gff: DataFrame) -> DataFrame:
    """contig, start (0-based), end, transcript, exon_number, strand of exons."""
    a = F.col("attrs")
    return gff.where(F.col("feature") == "exon").select("contig", (F.col("start") - 1).alias("start"), "end", with_version(a["transcript_id"], a["transcript_version"]).alias("transcript"), a["exon_number"].alias("exon_number"), "strand", "ord")


def min_copies(track: DataFrame, least: float = 4.0) -> DataFrame:
    return track.where(F.col("copies") >= least)


def medically_relevant_genes(genes: DataFrame) -> DataFrame:
    """Distinct flagged genes of chromosomes other than X, Y and MT."""
    return genes.where((F.col("flag") == "TRUE") & ~F.col("chrom").isin("X", "Y", "MT")).select("gene").distinct()


def united(*parts: DataFrame) -> DataFrame:
    """Tables of the same columns one after another: haplotypes, variant kinds, chunks or masks."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def satellite_overlap(rows: DataFrame, satellites: DataFrame, keys: list[str]) -> DataFrame:
    """Bases that each interval shares with the track's intervals, which are not merged first."""
    pairs = interval_join(rows.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "contig", "start", "end"), satellites.select("contig", "start", "end"), width=10_000)
    sums = pairs.groupBy(*[f"_k_{k}" for k in keys]).agg(F.sum(F.least("end", "r_end") - F.greatest("start", "r_start")).alias("overlap"))
    return rows.join(sums.select(*[F.col(f"_k_{k}").alias(k) for k in keys], "overlap"), keys, "left").withColumn("overlap", F.coalesce("overlap", F.lit(0)))
