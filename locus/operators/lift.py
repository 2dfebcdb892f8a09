"""Liftover through chain blocks, and the table work on alignments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locus.functions.seq import reverse_complement
from locus.sources.order import with_last

from .intervals import interval_join, reach_before, tiles


def chain_blocks(lines: DataFrame) -> DataFrame:
    """Ungapped blocks of chains from header and block rows in file order.

    lines: ord, kind ('chain' or 'block'), src, src_start, src_end, dst, dst_size, dst_strand, dst_start, chain_id, size, d_src,
    d_dst. A header opens a chain; block offsets are running sums. On '-' the coordinates of dst count from its end
    and are turned to the forward strand: [d0, d1) is always forward.
    """
    head = F.when(F.col("kind") == "chain", F.struct("src", "src_start", "dst", "dst_size", "dst_strand", "dst_start", "chain_id"))
    # Chains are named by their line; in file order each hands its header down to its blocks.
    rows = with_last(lines.withColumn("_head", head), "_head", "h").where(F.col("kind") == "block")
    w = Window.partitionBy("h.chain_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    ds = F.coalesce(F.sum(F.col("size") + F.coalesce("d_src", F.lit(0))).over(w), F.lit(0))
    dd = F.coalesce(F.sum(F.col("size") + F.coalesce("d_dst", F.lit(0))).over(w), F.lit(0))
    rows = rows.select("h.*", "size", (F.col("h.src_start") + ds).alias("s0"), (F.col("h.dst_start") + dd).alias("q0"))
    minus = F.col("dst_strand") == "-"
    d0 = F.when(minus, F.col("dst_size") - F.col("q0") - F.col("size")).otherwise(F.col("q0"))
    return rows.select("chain_id", F.col("src").alias("contig"), F.col("s0").alias("start"), (F.col("s0") + F.col("size")).alias("end"), F.col("dst_strand").alias("strand"), F.col("dst").alias("dst_contig"), d0.alias("d0"), (d0 + F.col("size")).alias("d1"))


def _lifted(pos: Column) -> Column:
    return F.when(F.col("strand") == "-", F.col("d1") - 1 - (pos - F.col("r_start"))).otherwise(F.col("d0") + (pos - F.col("r_start")))


def liftover_points(points: DataFrame, blocks: DataFrame, keys: Sequence[str], width: int = 10_000) -> DataFrame:
    """One row per chain that covers a point: keys, status (Match or Gap), dst_contig, dst_pos, dst_end, chain_id.

    A point in a block is a Match; between two blocks of a chain it is a Gap with the span between them. Points that no
    chain covers have one row with status Unmapped.
    """
    # Blocks grow with the chains, and the estimate by file size does not know their bins: they are shuffled, never broadcast.
    blocks = blocks.hint("merge")
    p = points.select(*keys, "contig", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"))
    hit = interval_join(p, blocks, width=width).select(*keys, F.lit("Match").alias("status"), "dst_contig", _lifted(F.col("start")).alias("dst_pos"), F.lit(None).cast("bigint").alias("dst_end"), "chain_id")
    w = Window.partitionBy("chain_id").orderBy("start")
    nxt = F.lead(F.struct("start", "d0", "d1")).over(w)
    gaps = blocks.withColumn("n", nxt).where(F.col("n.start") > F.col("end"))
    low, high = F.least("d1", F.col("n.d1")), F.greatest("d0", F.col("n.d0"))
    gaps = gaps.select("contig", F.col("end").alias("start"), F.col("n.start").alias("end"), "dst_contig", low.alias("g0"), high.alias("g1"), "chain_id")
    miss = interval_join(p, gaps, width=width).select(*keys, F.lit("Gap").alias("status"), "dst_contig", F.col("g0").alias("dst_pos"), F.col("g1").alias("dst_end"), "chain_id")
    found = hit.unionByName(miss)
    rest = points.select(*keys).join(found.select(*keys).distinct(), list(keys), "left_anti")
    return found.unionByName(rest.withColumns({"status": F.lit("Unmapped"), "dst_contig": F.lit(None).cast(found.schema["dst_contig"].dataType), "dst_pos": F.lit(None).cast("bigint"), "dst_end": F.lit(None).cast("bigint"), "chain_id": F.lit(None).cast(found.schema["chain_id"].dataType)}))


def liftover_alleles(variants: DataFrame, blocks: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(lifted, rejected): variants whose whole reference allele lies in one block, alleles turned on '-'."""
    pairs = interval_join(variants, blocks.hint("merge"), width=10_000).where("start >= r_start and end <= r_end")
    minus = F.col("strand") == "-"
    begin = F.when(minus, F.col("d1") - (F.col("end") - F.col("r_start"))).otherwise(F.col("d0") + F.col("start") - F.col("r_start"))
    turned = lambda c: F.when(minus, reverse_complement(F.col(c))).otherwise(F.col(c))
    lifted = pairs.select(*[F.col(c) for c in variants.columns], "dst_contig", begin.alias("dst_pos"), turned("ref").alias("dst_ref"), turned("alt").alias("dst_alt"))
    return lifted, variants.join(lifted.select(*keys).distinct(), list(keys), "left_anti")


def invert_chain(blocks: DataFrame) -> DataFrame:
    """Blocks from destination to source; the strand is relative and stays."""
    return blocks.select("chain_id", F.col("dst_contig").alias("contig"), F.col("d0").alias("start"), F.col("d1").alias("end"), "strand", F.col("contig").alias("dst_contig"), F.col("start").alias("d0"), F.col("end").alias("d1"))


def break_alignments(blocks: DataFrame, size: int = 10_000) -> DataFrame:
    """Blocks of at most `size` bases, mapped piece by piece."""
    out = blocks.withColumn("_t", F.explode(tiles(F.col("start"), F.col("end"), size)))
    a, b = F.col("_t.start") - F.col("start"), F.col("_t.end") - F.col("start")
    minus = F.col("strand") == "-"
    return out.select("chain_id", "contig", F.col("_t.start").alias("start"), F.col("_t.end").alias("end"), "strand", "dst_contig", F.when(minus, F.col("d1") - b).otherwise(F.col("d0") + a).alias("d0"), F.when(minus, F.col("d1") - a).otherwise(F.col("d0") + b).alias("d1"))


def trim_overlaps(blocks: DataFrame, by: str = "contig") -> DataFrame:
    """Later blocks lose what earlier ones of the contig cover, on the source axis and then on the destination's."""

    def once(df: DataFrame, name: str, lo: str, hi: str, other_lo: str, other_hi: str) -> DataFrame:
        df = reach_before(df, [name], lo, hi, "_top", [hi, "chain_id"])
        cut = F.greatest(F.coalesce("_top", lo) - F.col(lo), F.lit(0))
        df = df.withColumn("_cut", cut).drop("_top").where(F.col("_cut") < F.col(hi) - F.col(lo))
        minus = F.col("strand") == "-"
        return df.withColumns({lo: F.col(lo) + F.col("_cut"), other_lo: F.when(minus, F.col(other_lo)).otherwise(F.col(other_lo) + F.col("_cut")), other_hi: F.when(minus, F.col(other_hi) - F.col("_cut")).otherwise(F.col(other_hi))}).drop("_cut")

    return once(once(blocks, by, "start", "end", "d0", "d1"), "dst_contig", "d0", "d1", "start", "end")
