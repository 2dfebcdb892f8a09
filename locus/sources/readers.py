"""Readers of the text formats that genome pipelines exchange. All attach `ord`, the order within the input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locus.functions.fields import attributes, header_tag, info

from .order import with_last


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(ord, line, file) of text files, gz too. ord rises along a file: the partition and the place in it."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("ord"), F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))


def read_table(spark: SparkSession, path: str, required: Sequence[str] = (), sep: str = "\t") -> DataFrame:
    """Headered table, all columns as text by name; a missing required column is an error."""
    df = spark.read.csv(path, sep=sep, header=True, quote="")
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    return df


def _fields(df: DataFrame, n: int, sep: str = "\t") -> DataFrame:
    """Rows of at least n fields, with the fields as an array f."""
    return df.withColumn("f", F.split("line", sep)).where(F.size("f") >= n)


def _f(i: int):  # noqa: ANN202
    return F.get("f", F.lit(i))


def parse_bed(df: DataFrame, names: Sequence[str] = ()) -> DataFrame:
    """contig, start, end, more fields by name; lines with fewer than three fields or no integers are skipped."""
    rows = _fields(df, 3).select("ord", _f(0).alias("contig"), _f(1).try_cast("bigint").alias("start"), _f(2).try_cast("bigint").alias("end"), *[_f(3 + i).alias(n) for i, n in enumerate(names)])
    return rows.where("start is not null and end is not null")


def read_bed(spark: SparkSession, path: str, names: Sequence[str] = ()) -> DataFrame:
    return parse_bed(lines(spark, path), names)


def parse_gff(df: DataFrame) -> DataFrame:
    """Features with 1-based start and their attributes as a map; comment lines go."""
    rows = _fields(df.where(~F.col("line").startswith("#")), 9)
    return rows.select("ord", _f(0).alias("contig"), _f(1).alias("source"), _f(2).alias("feature"), _f(3).try_cast("bigint").alias("start"), _f(4).try_cast("bigint").alias("end"), _f(6).alias("strand"), attributes(_f(8)).alias("attrs"))


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    return parse_gff(lines(spark, path))


def parse_vcf(df: DataFrame) -> DataFrame:
    """Records with INFO as a map and the first sample's field; '#' lines go."""
    rows = _fields(df.where(~F.col("line").startswith("#")), 8)
    return rows.select("ord", _f(0).alias("contig"), _f(1).try_cast("bigint").alias("pos"), _f(2).alias("id"), _f(3).alias("ref"), _f(4).alias("alt"), _f(5).try_cast("double").alias("qual"), _f(6).alias("filter"), info(_f(7)).alias("info"), _f(8).alias("format"), _f(9).alias("sample"))


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    return parse_vcf(lines(spark, path))


def parse_paf(df: DataFrame) -> DataFrame:
    """Alignments with the target as the contig and the query as the reference chromosome."""
    n = lambda i: _f(i).try_cast("bigint")
    return _fields(df, 12).select("ord", _f(5).alias("contig"), n(7).alias("c_start"), n(8).alias("c_end"), _f(4).alias("strand"), _f(0).alias("chrom"), n(2).alias("r_start"), n(3).alias("r_end"), n(9).alias("matched"), _f(11).try_cast("int").alias("mapq"), n(6).alias("contig_length"), n(1).alias("chrom_length"))


def read_paf(spark: SparkSession, path: str) -> DataFrame:
    return parse_paf(lines(spark, path))


def parse_chain(df: DataFrame) -> DataFrame:
    """Header and block rows in file order for lift.chain_blocks()."""
    t = df.withColumn("f", F.split(F.btrim("line"), r"\s+")).where(F.col("line").rlike(r"\S"))
    n = lambda i: _f(i).try_cast("bigint")
    head = F.get("f", F.lit(0)) == "chain"
    h = lambda c: F.when(head, c)
    b = lambda c: F.when(~head, c)
    # The chain's own id may repeat between files; the line it stands on does not.
    return t.select("ord", *[c for c in ("file",) if c in df.columns], F.when(head, "chain").otherwise("block").alias("kind"), h(_f(2)).alias("src"), h(n(5)).alias("src_start"), h(n(6)).alias("src_end"), h(_f(7)).alias("dst"), h(n(8)).alias("dst_size"), h(_f(9)).alias("dst_strand"), h(n(10)).alias("dst_start"), h(F.col("ord")).alias("chain_id"), b(n(0)).alias("size"), b(n(1)).alias("d_src"), b(n(2)).alias("d_dst"))


def read_chain(spark: SparkSession, path: str) -> DataFrame:
    from locus.operators.lift import chain_blocks

    return chain_blocks(parse_chain(lines(spark, path)))


def parse_fasta(df: DataFrame) -> DataFrame:
    """Sequence lines as chunks: contig (first token), header, chunk_start, seq, in order of lines."""
    head = F.when(F.col("line").startswith(">"), F.struct(F.col("ord").alias("id"), F.substring("line", 2, 1 << 30).alias("header")))
    rows = with_last(df.withColumn("_head", head), "_head", "h").where(~F.col("line").startswith(">"))
    before = Window.partitionBy("h.id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(F.split_part("h.header", F.lit(" "), F.lit(1)).alias("contig"), "h.header", F.coalesce(F.sum(F.length("line")).over(before), F.lit(0)).alias("chunk_start"), F.col("line").alias("seq"), "ord")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    return parse_fasta(lines(spark, path))


def contig_lengths(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("contig", "header").agg(F.sum(F.length("seq")).alias("length"))


def keep_primary_contigs(chunks: DataFrame) -> DataFrame:
    """Contigs tagged rl:Chromosome; all of them if none has an rl tag."""
    tag = header_tag(F.col("header"), "rl")
    tagged = chunks.agg(F.max(tag.isNotNull()).alias("_any"))  # one row
    return chunks.join(F.broadcast(tagged)).where(~F.col("_any") | (tag == "Chromosome")).drop("_any")


def parse_blast6(df: DataFrame) -> DataFrame:
    """0-based hits with strand and matches from the 10 or 12 standard fields."""
    n = lambda i: _f(i).try_cast("bigint")
    t = _fields(df, 12)
    return t.select("ord", _f(0).alias("query"), _f(1).alias("contig"), F.when(n(8) <= n(9), "+").otherwise("-").alias("strand"), (F.least(n(8), n(9)) - 1).alias("start"), F.greatest(n(8), n(9)).alias("end"), (n(6) - 1).alias("q_start"), n(7).alias("q_end"), F.bround(_f(3).try_cast("double") * _f(2).try_cast("double") / 100).cast("bigint").alias("n_match"), _f(11).try_cast("double").alias("bits"))


def parse_rmsk_out(df: DataFrame) -> DataFrame:
    """Repeat hits of a whitespace table; its three kinds of header lines go."""
    t = df.withColumn("f", F.split(F.btrim("line"), r"\s+")).where((F.size("f") >= 11) & ~_f(0).isin("SW", "score", "There"))
    rows = t.select("ord", _f(4).alias("insert_key"), (_f(5).try_cast("bigint") - 1).alias("start"), _f(6).try_cast("bigint").alias("end"), F.when(_f(8) == "C", "-").otherwise("+").alias("strand"), _f(9).alias("repeat"), _f(10).alias("family"))
    return rows.orderBy("insert_key", "start", "end", "ord")


def parse_gene_list(df: DataFrame, skip_first: bool = True) -> DataFrame:
    """Distinct first fields; the first line is skipped by default, header or not."""
    rows = df.select("ord", F.split_part("line", F.lit("\t"), F.lit(1)).alias("gene"))
    if skip_first:
        first = df.agg(F.min("ord").alias("_first"))
        rows = rows.join(F.broadcast(first)).where("ord > _first")
    return rows.select("gene").distinct()


def parse_mane(df: DataFrame) -> DataFrame:
    """gene, gene_id of its first row, transcripts; columns by name without a leading '#'."""
    df = df.withColumnsRenamed({c: c.lstrip("#") for c in df.columns})
    if missing := [c for c in ("symbol", "Ensembl_Gene", "Ensembl_nuc") if c not in df.columns]:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    at = F.monotonically_increasing_id()
    rows = df.select(F.col("symbol").alias("gene"), F.col("Ensembl_Gene").alias("gene_id"), F.col("Ensembl_nuc").alias("tx"), at.alias("ord"))
    return rows.groupBy("gene").agg(F.min_by("gene_id", "ord").alias("gene_id"), F.transform(F.array_sort(F.collect_list(F.struct("ord", "tx"))), lambda x: x["tx"]).alias("transcripts"))


def parse_window_means(df: DataFrame) -> DataFrame:
    rows = _fields(df, 4)
    return rows.select("ord", _f(0).alias("contig"), _f(1).try_cast("bigint").alias("start"), _f(2).try_cast("bigint").alias("end"), F.element_at("f", -1).try_cast("double").alias("mean"))


def parse_support_reads(df: DataFrame) -> DataFrame:
    """Supporting reads of lines of eleven fields: the seven of the variant's key, its id, read, place and direction."""
    return _fields(df, 11).select("ord", _f(7).alias("sv_id"), _f(8).alias("read"), _f(9).try_cast("bigint").alias("read_pos"), _f(10).alias("dir"))


def parse_contig_list(df: DataFrame) -> DataFrame:
    """Distinct contigs named by the first field of each line."""
    return df.select(F.split_part("line", F.lit("\t"), F.lit(1)).alias("contig")).where("contig <> ''").distinct()


def parse_kmer_ratio(df: DataFrame) -> DataFrame:
    return _fields(df, 4).select(_f(0).alias("read"), _f(3).try_cast("double").alias("ratio"))


def parse_ucsc_centromeres(df: DataFrame) -> DataFrame:
    """Columns 2 to 4 with start - 1, as the masking step takes them (one base wider)."""
    return _fields(df, 4).select("ord", _f(1).alias("contig"), (_f(2).try_cast("bigint") - 1).alias("start"), _f(3).try_cast("bigint").alias("end")).where("start is not null")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The sample sheet with comma lists as arrays and missing cells as empty."""
    df = read_table(spark, path, ("sample", "type", "assembly_hap1", "assembly_hap2")).na.fill("")
    for c in ("ont", "hifi"):
        text = F.col(c) if c in df.columns else F.lit("")
        df = df.withColumn(c, F.filter(F.split(text, ","), lambda x: x != ""))
    return df


def read_aligned_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("read", "flag", "contig", "start", "end", "mapq", "strand", "cigar", "seq")
