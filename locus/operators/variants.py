"""Point mutations: parsing, annotation, liftover columns and duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locus.functions.fields import safe_float, without_version
from locus.functions.seq import canonical_allele, reverse_complement

from .checkpoints import checkpointed
from .intervals import exists_overlap, first_containing, first_match, interval_join


def split_snv_indel(df: DataFrame, ref: str = "ref", alt: str = "alt") -> tuple[DataFrame, DataFrame]:
    """(substitutions, with equal lengths; insertions and deletions)."""
    same = F.length(ref) == F.length(alt)
    return df.where(same), df.where(~same)


#: Places of VAF, depth, normal VAF and normal depth in the sample field of each caller; None is zero. Fixed values.
CALLERS = {"clairs": (3, 2, 5, 6), "deepsomatic": (4, 2, None, None)}


def parse_caller_vcf(vcf: DataFrame, tool: str) -> DataFrame:
    """PASS records as one row per ALT: contig, start, end, ref, alt, score, vaf, depth, normal_vaf, normal_depth, id.

    vcf has contig, pos, ref, alt, qual, filter, sample and ord; ids are ID_n, counted from 0 in (ord, allele) order
    with partition offsets, so no single task sorts the table.
    """
    vaf, depth, nvaf, ndepth = CALLERS[tool]
    field = lambda i: F.get(F.split("sample", ":"), F.lit(i)) if i is not None else F.lit("0")
    rows = vcf.where(F.col("filter") == "PASS")
    alleles = F.arrays_zip(F.split("alt", ",").alias("a"), F.split(field(vaf), ",").alias("v"))
    rows = rows.select("*", F.posexplode(alleles).alias("_k", "_x"))
    text = F.col("_x.v")
    value = F.when(text == "1", F.lit("1.0")).otherwise(text)
    out = rows.select(
        "contig", (F.col("pos") - 1).alias("start"), (F.col("pos") - 1 + F.length("ref")).alias("end"), "ref", F.col("_x.a").alias("alt"), F.col("qual").alias("score"),
        value.try_cast("double").alias("vaf"), field(depth).try_cast("int").alias("depth"), field(nvaf).try_cast("double").alias("normal_vaf"), field(ndepth).try_cast("int").alias("normal_depth"), "ord", "_k",
    )
    numbered = numbered_in_order(out, ["ord", "_k"])
    return numbered.withColumn("id", F.concat(F.lit("ID_"), F.col("_n").cast("string"))).drop("_n", "ord", "_k")


def numbered_in_order(df: DataFrame, order: Sequence[str], name: str = "_n") -> DataFrame:
    """Numbers rows from 0 in a global order: range partitions, numbered inside, moved by the rows before them."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    parts = parts.withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND((1 << 33) - 1)})
    # The rows are needed twice in the same partitions, and a repeated task could order ties otherwise.
    parts = checkpointed(parts)
    counts = parts.groupBy("_part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return parts.join(F.broadcast(counts.select("_part", before.alias("_b"))), "_part").withColumn(name, F.col("_at") + F.col("_b")).drop("_at", "_part", "_b")


def annotate_repeat(sites: DataFrame, track: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rmsk_class and rmsk_type of the first repeat that contains the variant."""
    return first_containing(sites, track, keys, ["rmsk_class", "rmsk_type"])


def annotate_misassembly(sites: DataFrame, hap1: DataFrame, hap2: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whether a flagged region of either haplotype contains the variant."""
    return exists_overlap(sites, hap1.unionByName(hap2), keys, "misassembly", contained=True)


def annotate_centromere(sites: DataFrame, track: DataFrame, keys: Sequence[str]) -> DataFrame:
    return first_containing(sites, track, keys, ["centromere"])


def annotate_segdup(sites: DataFrame, track: DataFrame, keys: Sequence[str]) -> DataFrame:
    """segdup flag and the similarity of the first duplication that contains the variant."""
    out = first_containing(sites, track, keys, ["similarity"])
    return out.withColumn("segdup", F.col("similarity").isNotNull())


def annotate_genes(sites: DataFrame, features: DataFrame, keys: Sequence[str], mane: DataFrame | None = None, gff_start_quirk: bool = True) -> DataFrame:
    """genes ('a;b') and transcripts ('tx:feature,tx:feature;...') of the protein-coding features that contain a variant.

    features: contig, start (1-based), end, ord, feature, biotype, gene, gene_id, transcript. With the quirk the 1-based
    start is compared as it is, so a variant on a feature's first base misses. Of a gene and transcript the last
    feature in file order counts; genes and transcripts stand in order of their first hit. mane: gene, gene_id,
    transcripts (array): only its transcripts stay, and genes it lacks go.
    """
    return sites.join(genes_found(sites, features, keys, mane, gff_start_quirk), list(keys), "left")


def genes_found(sites: DataFrame, features: DataFrame, keys: Sequence[str], mane: DataFrame | None = None, gff_start_quirk: bool = True, gene_sets: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """What annotate_genes() adds, with the keys of variants in some feature alone; for each of the sets a flag as that of flag_gene_sets(), null for none.

    Hits are exchanged once, by their keys. Genes are marked by the sets before the variants meet them.
    """
    f = features.where((F.col("biotype") == "protein_coding") & (F.col("feature") != "gene"))
    if not gff_start_quirk:
        f = f.withColumn("start", F.col("start") - 1)
    if mane is not None:
        # Features are fewer than hits, so what is not listed goes before the variants meet them.
        m = mane.select(F.col("gene").alias("_g"), F.col("gene_id").alias("_i"), F.col("transcripts").alias("_t"))
        f = f.join(m, (F.col("gene") == F.col("_g")) & (F.col("gene_id") == F.col("_i"))).where(F.array_contains("_t", F.col("transcript"))).drop("_g", "_i", "_t")
    marks = {flag: f"_in_{flag}" for flag in gene_sets or {}}
    for flag, mark in marks.items():
        each = f.select("gene", F.explode(F.split("gene", ";")).alias("_one")).distinct().join(gene_sets[flag].select(F.col("gene").alias("_one")).distinct(), "_one", "left_semi")
        f = f.join(each.groupBy("gene").agg(F.array_join(F.collect_set("_one"), ";").alias(mark)), "gene", "left")
    order = F.struct("r_start", "ord")
    hits = interval_join(sites.select(*keys, "contig", "start", "end"), f).where("start >= r_start and end <= r_end")
    hits = hits.select(*keys, "gene", "transcript", "feature", order.alias("_order"), *marks.values()).repartition(*keys)
    tx = hits.groupBy(*keys, "gene", "transcript").agg(F.max_by("feature", "_order").alias("feature"), F.min("_order").alias("first"), *[F.min(m).alias(m) for m in marks.values()])
    gene = tx.groupBy(*keys, "gene").agg(F.min("first").alias("first"), F.array_sort(F.collect_list(F.struct("first", F.concat_ws(":", "transcript", "feature").alias("t")))).alias("ts"), *[F.min(m).alias(m) for m in marks.values()])
    text = gene.withColumn("ts", F.array_join(F.transform("ts", lambda x: x["t"]), ","))
    all_genes = text.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("first", "gene", "ts"))).alias("g"), *[F.collect_set(m).alias(m) for m in marks.values()])
    flags = [F.when(F.size(m) > 0, F.array_join(F.array_sort(F.array_distinct(F.split(F.array_join(m, ";"), ";"))), ",")).alias(flag) for flag, m in marks.items()]
    return all_genes.select(*keys, F.array_join(F.transform("g", lambda x: x["gene"]), ";").alias("genes"), F.array_join(F.transform("g", lambda x: x["ts"]), ";").alias("transcripts"), *flags)


def mane_mismatch_report(features: DataFrame, mane: DataFrame, examples: int = 3) -> DataFrame:
    """One row: how many pairs differ in the version alone, and the first few as gene:transcript:mane_transcript."""
    pairs = mane_version_mismatch(features, mane).select(F.concat_ws(":", "gene", "transcript", "mane_transcript").alias("pair"))
    first = pairs.orderBy("pair").limit(examples).agg(F.array_join(F.array_sort(F.collect_list("pair")), ",").alias("examples"))
    return pairs.agg(F.count(F.lit(1)).alias("n")).join(first)  # one row each


def mane_version_mismatch(features: DataFrame, mane: DataFrame) -> DataFrame:
    """Distinct (gene, transcript, mane_transcript) that agree but for the version."""
    m = mane.select("gene", F.explode("transcripts").alias("mane_transcript"))
    pairs = features.select("gene", "transcript").distinct().join(m, "gene")
    return pairs.where((without_version(F.col("transcript")) == without_version(F.col("mane_transcript"))) & (F.col("transcript") != F.col("mane_transcript")))


def flag_gene_sets(df: DataFrame, gene_set: DataFrame, flag: str, keys: Sequence[str], genes: str = "genes") -> DataFrame:
    """Comma list, sorted, of a row's genes that are in the set (column gene), or False."""
    each = df.select(*keys, F.explode(F.array_distinct(F.split(genes, ";"))).alias("gene")).join(gene_set.select("gene").distinct(), "gene", "left_semi")
    hits = each.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("gene")), ",").alias(flag))
    return df.join(hits, list(keys), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit("False")))


def match_other_caller(df: DataFrame, other: DataFrame, flag: str = "other_caller") -> DataFrame:
    """Whether the other callset has the same contig, start, ref and alt."""
    on = ["contig", "start", "ref", "alt"]
    return df.join(other.select(*on).distinct().withColumn(flag, F.lit(True)), on, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def annotate_population(df: DataFrame, population: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First population record at (ref_contig, ref_pos) with the alleles on either strand: `population` text."""
    return df.join(population_found(df, population, keys), list(keys), "left")


def population_found(df: DataFrame, population: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What annotate_population() adds, with the keys of the rows that have a record alone."""
    left = df.where(F.col("ref_pos").isNotNull()).select(*keys, "ref_contig", "ref_pos", canonical_allele(F.col("ref"), F.col("alt")).alias("_a"))
    right = population.select(F.col("contig").alias("ref_contig"), F.col("pos").alias("ref_pos"), canonical_allele(F.col("ref"), F.col("alt")).alias("_a"), "ord", F.concat_ws(",", F.col("contig").cast("string"), F.col("pos").cast("string"), "id", "ref", "alt").alias("population"))
    return left.join(right, ["ref_contig", "ref_pos", "_a"]).groupBy(*keys).agg(F.min_by("population", "ord").alias("population"))


def contig_size(df: DataFrame, lengths: DataFrame, on: str = "contig") -> DataFrame:
    """Adds the contig's length; an unknown contig is an error."""
    out = df.join(lengths.select(F.col("contig").alias("_c"), F.col("length").alias("contig_length")), F.col(on) == F.col("_c"), "left").drop("_c")
    fail = F.when(F.col("contig_length").isNull(), F.raise_error(F.concat(F.lit("unknown contig "), F.col(on).cast("string"))).cast("bigint"))
    return out.withColumn("contig_length", F.coalesce("contig_length", fail))


def attach_lift_snv(df: DataFrame, lifts: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """Contig, position and status columns of each reference; other statuses than Match and Gap have no place."""
    for name, lift in lifts.items():
        placed = F.col("status").isin("Match", "Gap")
        cols = lift.select(key, F.when(placed, F.col("dst_contig")).alias(f"{name}_contig"), F.when(placed, F.col("dst_pos")).alias(f"{name}_pos"), F.col("status").alias(f"{name}_status"))
        df = df.join(cols, key, "left")
    return df


def attach_lift_indel(df: DataFrame, lifted: DataFrame, rejected: DataFrame, name: str) -> DataFrame:
    """Lifted contig, position and alleles by (haplotype, contig, end, ref, alt); Match, Rejected or null."""
    on = ["haplotype", "contig", "end", "ref", "alt"]
    good = lifted.select(*on, F.col("dst_contig").alias(f"{name}_contig"), F.col("dst_pos").alias(f"{name}_pos"), F.col("dst_ref").alias(f"{name}_ref"), F.col("dst_alt").alias(f"{name}_alt"), F.lit("Match").alias("_ok"))
    bad = rejected.select(*on).distinct().withColumn("_no", F.lit("Rejected"))
    return df.join(good, on, "left").join(bad, on, "left").withColumn(f"{name}_status", F.coalesce("_ok", "_no")).drop("_ok", "_no")


def drop_unassigned_duplicates(df: DataFrame, contig: str = "ref_contig", pos: str = "ref_pos", indel: tuple[str, str] | None = None) -> DataFrame:
    """Of rows at one reference place with one allele: the haplotype-assigned, else the best by VAF, depth and order.

    Substitutions agree on either strand; indels by the lifted alleles named in `indel`. Rows without a place stay.
    df has ref, alt, haplotype (null or - if unassigned), vaf, depth (text or numbers) and ord.
    """
    allele = canonical_allele(F.col("ref"), F.col("alt")) if indel is None else F.struct(F.col(indel[0]).alias("ref"), F.col(indel[1]).alias("alt"))
    keyed = df.withColumns({"_a": allele, "_assigned": F.coalesce(F.col("haplotype") != "-", F.lit(False))})
    w = Window.partitionBy(contig, pos, "_a")
    rank = F.row_number().over(w.orderBy(safe_float(F.col("vaf").cast("string")).desc(), safe_float(F.col("depth").cast("string")).desc(), "ord"))
    placed = keyed.where(F.col(pos).isNotNull()).withColumns({"_any": F.max("_assigned").over(w), "_rank": rank})
    kept = placed.where((F.col("_any") & F.col("_assigned")) | (~F.col("_any") & (F.col("_rank") == 1))).drop("_any", "_rank")
    return kept.unionByName(keyed.where(F.col(pos).isNull())).drop("_a", "_assigned")


def indel_back_to_vcf(indels: DataFrame, vcf: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Indels joined to the first original record with the same contig and alleles that overlaps; others are left out."""
    v = vcf.select("contig", F.col("ref").alias("v_ref"), F.col("alt").alias("v_alt"), (F.col("pos") - 1).alias("start"), (F.col("pos") - 1 + F.length("ref")).alias("end"), "ord", "record")
    pairs = interval_join(indels, v).where("ref = v_ref and alt = v_alt")
    return indels.join(first_match(pairs, keys, ["record"], order="ord" if "ord" not in indels.columns else "r_ord"), list(keys))


def variants_per_contig(df: DataFrame) -> DataFrame:
    return df.groupBy("contig").agg(F.count(F.lit(1)).alias("n"))


def fill_unevaluated(df: DataFrame, names: Sequence[str], kind: str = "string") -> DataFrame:
    """Adds null columns for steps that were not run, so that the schema does not change."""
    return df.withColumns({n: F.lit(None).cast(kind) for n in names if n not in df.columns})


def reverse_alleles(df: DataFrame) -> DataFrame:
    return df.withColumns({"ref": reverse_complement(F.col("ref")), "alt": reverse_complement(F.col("alt"))})


def vaf(support: Column, depth: Column) -> Column:
    return F.try_divide(support, depth)
