"""The three tables that the steps add up to: annotated mutations, annotated variants, copy number.

Every step works on the rows' keys and places, stored once, and its new columns are joined back by the key. So the plan
grows by one join a step, and the rows stay partitioned by their key from the first join on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import copynumber, kmers, sv, variants
from .checkpoints import checkpointed, stored
from .intervals import first_containing_each

#: Contigs whose lengths are broadcast; those of more are joined by exchange.
MOST_CONTIGS = 100_000


def _joined(base: DataFrame, parts: Sequence[DataFrame], key: str) -> DataFrame:
    return reduce(lambda a, b: a.join(b, key, "left"), parts, base)


def _part(out: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """The key and what a step added."""
    return out.select(key, *[c for c in out.columns if c not in base.columns])


def annotated_mutations(calls: DataFrame, tracks: Mapping[str, DataFrame], key: str = "id") -> DataFrame:
    """Calls (id, contig, start, end, ref, alt) with every annotation; steps without their track leave nulls.

    tracks: repeats, misassembly (contig, start, end), centromeres, segdups, features (and mane, cancer_genes,
    relevant_genes for them), other_caller, lengths, lift_<name> (id, dst_contig, dst_pos, status), and population, which
    needs the lift that it is placed on as lift_GRCh38. Each track is as the step of that name takes it.
    """
    t = dict(tracks)
    lifts = {n.removeprefix("lift_"): x for n, x in t.items() if n.startswith("lift_")}
    # Ids are long texts: lifts, which go by them, come first. Then rows are numbered, and every step moves the number alone.
    base, names, key = stored(variants.attach_lift_snv(calls, lifts, key).withColumn("_row", F.monotonically_increasing_id())), list(calls.columns), "_row"
    place = base.select(key, "contig", "start", "end")
    parts: list[DataFrame] = []
    kinds: dict[str, str] = {}
    keys = [key]

    def add(found: DataFrame) -> None:
        """Steps return the rows that they found something for. They are stored one after another, so no two have their shuffles on disk at once."""
        parts.append(stored(found))
        names.extend(c for c in found.columns if c != key)

    # Tracks of which the first interval around a call counts are probed together.
    around = {"repeats": {"rmsk_class": "string", "rmsk_type": "string"}, "misassembly": {}, "centromeres": {"centromere": "string"}, "segdups": {"similarity": "string"}}
    kinds |= {c: kind for columns in around.values() for c, kind in columns.items()} | {"misassembly": "boolean", "segdup": "boolean"}
    probed = {n: (t[n], list(columns)) for n, columns in around.items() if columns and n in t}
    if "misassembly" in t:
        probed["misassembly"] = (t["misassembly"].select("contig", "start", "end", F.lit(True).alias("flag")), ["flag"])
    none: dict[str, bool | str] = {}  # what a row without a hit has, if not null
    if probed:
        found = first_containing_each(place, probed, keys)
        flags = {"misassembly": "misassembly", "segdups": "segdup"}
        add(found.select(key, *[F.col(f"{n}.{c}").alias(c) for n in probed for c in around[n]], *[F.col(n).isNotNull().alias(flag) for n, flag in flags.items() if n in probed]))
        none |= {flag: False for n, flag in flags.items() if n in probed}
    kinds |= {"contig_length": "bigint", "other_caller": "boolean", "genes": "string", "transcripts": "string", "cancer": "string", "medically_relevant": "string", "population": "string"}
    lengths = t.get("lengths")
    if lengths is not None:
        lengths = checkpointed(lengths.select("contig", "length"))
        names.append("contig_length")
        if lengths.count() > MOST_CONTIGS:
            add(variants.contig_size(place, lengths).select(key, "contig_length"))
            names.remove("contig_length")
            lengths = None
    if "other_caller" in t:
        on = ["contig", "start", "ref", "alt"]
        add(base.select(key, *on).join(t["other_caller"].select(*on).distinct(), on, "left_semi").select(key, F.lit(True).alias("other_caller")))
        none["other_caller"] = False
    if "features" in t:
        sets = {flag: t[n] for n, flag in (("cancer_genes", "cancer"), ("relevant_genes", "medically_relevant")) if n in t}
        add(variants.genes_found(place, t["features"], keys, t.get("mane"), gene_sets=sets))
        none |= dict.fromkeys(sets, "False")
    names += [c for n in lifts for c in (f"{n}_contig", f"{n}_pos", f"{n}_status")]
    if "population" in t and "GRCh38" in lifts:
        placed = base.select(key, "ref", "alt", F.col("GRCh38_contig").alias("ref_contig"), F.col("GRCh38_pos").alias("ref_pos"))
        add(variants.population_found(placed, t["population"], keys))
    out = _joined(base, parts, key)
    if lengths is not None:
        out = variants.contig_size(out, F.broadcast(lengths))
    out = out.withColumns({c: F.coalesce(c, F.lit(value)) for c, value in none.items()}).select(*names)
    for name, kind in kinds.items():
        out = variants.fill_unevaluated(out, [name], kind)
    return out


def annotated_svs(svs: DataFrame, tracks: Mapping[str, DataFrame]) -> DataFrame:
    """Variants (sv_id, chr1, pos1, dir1, chr2, pos2, dir2, ins_len, is_filter) with every annotation.

    tracks: genes and repeats and centromeres (payload columns gene, rmsk_class, centromere at both break ends), lengths,
    other_svs, reftable, simple_repeats and repeat_scores, kmer_reads with kmer_ratios. Steps without their track add no
    column. Variants get their type first, by contig and, with a reference table, by reference.
    """
    c = F.col
    base = checkpointed(svs.withColumn("identical", c("identical") if "identical" in svs.columns else c("sv_id")))
    ends = base.select("sv_id", "chr1", "pos1", "dir1", "chr2", "pos2", "dir2", "ins_len", "is_filter", "identical")
    t, key = dict(tracks), "sv_id"
    if "reftable" in t:
        parts = [_part(sv.attach_ref_contig(ends, t["reftable"]), base, key)]
    else:
        parts = [ends.select(key, sv.classify_sv_type(c("chr1"), c("pos1"), c("dir1"), c("chr2"), c("pos2"), c("dir2"), c("ins_len")).alias("sv_type"))]
    for name, payload in (("genes", "gene"), ("repeats", "rmsk_class"), ("centromeres", "centromere")):
        if name in t:
            parts.append(_part(sv.annotate_bp(ends, t[name], [payload]), base, key))
    if "lengths" in t:
        parts.append(_part(sv.sv_contig_size(ends, t["lengths"]), base, key))
    if "other_svs" in t:
        parts.append(_part(sv.match_sv_callset(ends, t["other_svs"]), base, key))
    if "kmer_reads" in t:
        parts.append(_part(sv.mean_support_kmer_ratio(ends, t["kmer_reads"], t["kmer_ratios"]), base, key))
    out = base
    if "simple_repeats" in t:
        scores = t.get("repeat_scores")
        flagged = sv.decide_array_change(sv.in_simple_repeat(ends.drop("ins_len"), t["simple_repeats"]), scores)
        out = out.drop("is_filter")
        parts.append(flagged.select(key, "in_repeat", "repeat_reason", "is_filter"))
    return _joined(out, parts, key)


def copy_number_table(reftable: DataFrame, alignments: DataFrame, gap_track: DataFrame | None = None, size: int = copynumber.WINDOW, min_mapq: int = 40, ploidy: float | DataFrame | None = None) -> DataFrame:
    """From a reference table and aligned blocks to segments in copies, by sample, haplotype and chromosome.

    reftable: hap and the columns of the reference table with ord; alignments: sample, type (tumor or normal), hap,
    contig, start, end, mapq, flag. Windows stand on the axis of their haplotype; segments lose its assembly gaps.
    """
    by = ["hap"]
    axis = checkpointed(copynumber.window_index(reftable, by=by))
    tiles = copynumber.tile_windows(axis, size).join(axis.select("contig", "axis_start", *by), "contig")
    windows = checkpointed(tiles.select(*by, "contig", "start", "end", "chrom", (F.col("axis_start") + F.col("k")).alias("window_index")))
    reads = kmers.filter_alignment_flags(alignments, min_mapq=min_mapq)
    sums = None
    for kind in ("tumor", "normal"):
        mine = reads.where(F.col("type") == kind)
        depth = copynumber.window_depths(windows, mine, ["sample"] if kind == "tumor" else [], f"{kind}_depth", min_mapq)
        keys = ["contig", "start", "end"]
        sums = depth if sums is None else sums.join(depth.select(*keys, f"{kind}_depth"), keys, "left")
    sums = checkpointed(sums.withColumn("normal_depth", F.coalesce("normal_depth", F.lit(0))))
    segments = copynumber.call_copy_number(sums.select("sample", "hap", "chrom", "window_index", "tumor_depth", "normal_depth"), ploidy)
    gaps = copynumber.assembly_gaps(reftable, by=by) if gap_track is None else gap_track
    return copynumber.split_gaps(checkpointed(segments), gaps, ["sample", "hap", "chrom"])
