"""k-mer sets and reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locus.functions.seq import kmers

from .checkpoints import stored
from .intervals import bins

#: Parts of a site's reads that are cut on their own before they meet.
SALTS = 64
#: Least width of the bins in which sites meet spans without text.
SPAN = 250


def exploded(seqs: DataFrame, k: int, seq: str = "seq") -> DataFrame:
    """contig, position (0-based) and k-mer of every place; chunked rows add their chunk_start."""
    base = F.col("chunk_start") if "chunk_start" in seqs.columns else F.lit(0)
    return seqs.select("contig", base.alias("_b"), F.posexplode(kmers(F.col(seq), k)).alias("_i", "kmer")).select("contig", (F.col("_b") + F.col("_i")).alias("pos"), "kmer")


def count_kmers(seqs: DataFrame, k: int = 21) -> DataFrame:
    return exploded(seqs, k).groupBy("kmer").agg(F.count(F.lit(1)).alias("n"))


def single_copy(counts: DataFrame) -> DataFrame:
    return counts.where("n = 1")


def unique_kmers(own: DataFrame, other: DataFrame) -> DataFrame:
    """k-mers of one haplotype that the other lacks."""
    return own.join(other, "kmer", "left_anti")


def locate_kmers(seqs: DataFrame, wanted: DataFrame, k: int = 21) -> DataFrame:
    """Places of the wanted k-mers."""
    return exploded(seqs, k).join(wanted.select("kmer").distinct(), "kmer", "left_semi").select("contig", "pos", "kmer")


def read_kmer_ratio(reads: DataFrame, own: DataFrame, other: DataFrame, prior: float, k: int = 21) -> DataFrame:
    """Share of a read's haplotype-specific k-mers that are its own haplotype's; the prior if it has none."""
    marks = own.select("kmer", F.lit(1).alias("mine")).unionByName(other.select("kmer", F.lit(0).alias("mine")))
    each = reads.select("read", F.explode(kmers(F.col("seq"), k)).alias("kmer"))
    hits = each.join(marks, "kmer").groupBy("read").agg((F.sum("mine") / F.count(F.lit(1))).alias("ratio"))
    return reads.select("read").distinct().join(hits, "read", "left").withColumn("ratio", F.coalesce("ratio", F.lit(prior)))


def kmer_source(samples: DataFrame) -> DataFrame:
    """The smallest sample name of each assembly pair."""
    return samples.groupBy("assembly_hap1", "assembly_hap2").agg(F.min("sample").alias("source"))


def filter_alignment_flags(reads: DataFrame, drop: int = 2308, min_mapq: int = 0) -> DataFrame:
    """Alignments without any of the flag bits and with at least the mapping quality."""
    return reads.where((F.col("flag").bitwiseAND(drop) == 0) & (F.col("mapq") >= min_mapq))


def _foremost(df: DataFrame, keys: list[str], order: str, most: int, number: Callable[[], Column]) -> DataFrame:
    """Rows of each key up to the number `most` in order. They are cut before they are exchanged, beyond what Spark cuts early in SALTS parts first."""
    early = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    for part in ([],) if most <= early else ([F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))], []):
        df = df.withColumn("_r", number().over(Window.partitionBy(*keys, *part).orderBy(order))).where(F.col("_r") <= most).drop("_r")
    return df


def pileup_at_sites(sites: DataFrame, blocks: DataFrame, keys: list[str], max_depth: int | None = None, piece: int = 1000) -> DataFrame:
    """Depth, bases and reads at sites, bases in order of reads, from ungapped blocks (contig, start, end, seq, read).

    Blocks are cut at the edges of bins of `piece` bases, so each base of a sequence moves once, and a site is in one bin: its
    reads meet in the join, and their list takes no exchange of its own. With `qual` in the blocks their qualities come
    along; max_depth keeps the first reads of a site. Then sites meet the blocks' spans first, without their text, in bins of
    SPAN bases at least; the reads that stay, with all that tie for the last place, are stored and ask their block for a base.
    Reads are cut where they meet, before they are exchanged, so a hot site may be split among tasks. keys name one place each.
    """
    text = [c for c in ("seq", "qual") if c in blocks.columns]
    own = list(dict.fromkeys([*keys, "contig"]))
    base = lambda begin: F.struct(F.col("_read").alias("read"), *[F.substring(F.col(f"_{c}"), (F.col("_pos") - F.col(begin) + 1).cast("int"), F.lit(1)).alias(c) for c in text]).alias("x")

    def met(blocks: DataFrame, width: int, columns: list[str]) -> DataFrame:
        """Sites with the piece of each block that covers them."""
        low, high = F.greatest("start", F.col("_bin") * width), F.least("end", (F.col("_bin") + 1) * width)
        cut = blocks.select("contig", "start", "end", F.col("read").alias("_read"), *[F.col(c).alias(f"_{c}") for c in columns], F.explode(bins(F.col("start"), F.col("end"), width)).alias("_bin"))
        part = [F.substring(F.col(f"_{c}"), (low - F.col("start") + 1).cast("int"), (high - low).cast("int")).alias(f"_{c}") for c in columns]
        span = [low.alias("_low"), high.alias("_high"), *part] if columns else [F.col("start").alias("_low"), F.col("end").alias("_high")]
        pieces = cut.select("contig", "_bin", "_read", *span)
        return sites.select(*own, F.col("pos").alias("_pos"), F.floor(F.col("pos") / width).alias("_bin")).join(pieces, ["contig", "_bin"]).where("_low <= _pos and _high > _pos")

    if max_depth is None:
        place, seen = [*own, "_bin"], met(blocks, piece, text).select(*own, "_bin", base("_low"))
    else:
        place, width = keys, max(piece, SPAN)
        # Blocks that agree in all but their text stand for each other here; each of them answers below.
        kept = stored(_foremost(met(blocks, width, []).drop("_bin"), keys, "_read", max_depth, F.rank).distinct())
        whole = blocks.select("contig", F.col("start").alias("_low"), F.col("end").alias("_end"), F.col("read").alias("_read"), *[F.col(c).alias(f"_{c}") for c in text])
        # The ends are no key of the join: blocks that lie by contig, start and read, as distinct ones do, stay where they are.
        seen = kept.join(whole, ["contig", "_low", "_read"]).where("_high <= _end and _high >= _end").select(*place, base("_low"))
        if not kept.where("_read is null").isEmpty():  # a block without a name can't be asked by it
            seen = seen.unionByName(met(blocks.where("read is null"), width, text).select(*place, base("_low")))
        seen = _foremost(seen, keys, "x", max_depth, F.row_number)
    g = seen.groupBy(*place).agg(F.array_sort(F.collect_list("x")).alias("x"))
    joined = lambda c, sep: F.array_join(F.transform("x", lambda r: r[c].cast("string")), sep)
    quals = [joined("qual", "").alias("quals")] if "qual" in text else []
    return g.select(*keys, F.size("x").cast("long").alias("depth"), joined("seq", "").alias("bases"), *quals, joined("read", ",").alias("reads"))


def methylation_pileup(calls: DataFrame) -> DataFrame:
    """Modified and total counts and percent per CpG; '-' calls are moved onto the plus C, one base before."""
    site = F.when(F.col("strand") == "-", F.col("pos") - 1).otherwise(F.col("pos"))
    g = calls.groupBy("contig", site.alias("pos")).agg(F.sum(F.col("is_mod").cast("bigint")).alias("n_mod"), F.count(F.lit(1)).alias("n_total"))
    return g.withColumn("percent", F.round(100 * F.col("n_mod") / F.col("n_total"), 4))
