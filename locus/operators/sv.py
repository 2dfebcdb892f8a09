"""Structural variants: classification, filters, break-end annotation, matching and linking."""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locus.functions.fields import add_flag, flip, locus, mean3

from .checkpoints import checkpointed, dropped, stored
from .intervals import first_at_point, interval_join
from .variants import numbered_in_order


def classify_sv_type(chr1: Column, pos1: Column, dir1: Column, chr2: Column, pos2: Column, dir2: Column, inserted: Column) -> Column:
    """The type of a break-end pair; `inserted` is the length of the inserted sequence."""
    return (
        F.when(chr1 != chr2, "Translocation").when(dir1 == dir2, "Inversion").when((dir1 == "-") & (dir2 == "+"), "Duplication")
        .when(inserted > pos2 - pos1 + 1, "Insertion").otherwise("Deletion")
    )


def sv_hard_filter(df: DataFrame, min_vaf: float = 0.05, min_normal_depth: int = 10, min_tumor_depth: int = 10) -> DataFrame:
    """Flags for low depths, a low VAF and false duplications; no tumour reads give no VAF and so no VAF flag."""
    flags = F.col("is_filter")
    flags = add_flag(flags, "Low_normal_depth", F.col("checked_control") < min_normal_depth)
    flags = add_flag(flags, "Low_tumor_depth", F.col("checked_tumor") < min_tumor_depth)
    flags = add_flag(flags, "Low_VAF", F.try_divide("support_tumor", "checked_tumor") < min_vaf)
    flags = add_flag(flags, "False_dup", F.col("sv_id").startswith("d") & (F.col("dir1") == "-") & (F.col("dir2") == "+"))
    return df.withColumn("is_filter", flags)


def keep_pass(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_filter") == "PASS")


def drop_flagged(df: DataFrame, flags: Sequence[str] = ("Simple_repeat", "Too_small_size")) -> DataFrame:
    return df.where(~F.arrays_overlap(F.split("is_filter", ";"), F.array(*[F.lit(f) for f in flags])))


def sv_to_breakpoints(df: DataFrame) -> DataFrame:
    """Two rows of one base each per variant: contig, start, end, sv_id, bp."""
    ends = F.array(*[F.struct(F.col(f"chr{k}").alias("contig"), (F.col(f"pos{k}") - 1).alias("start"), F.col(f"pos{k}").alias("end"), F.lit(k).alias("bp")) for k in (1, 2)])
    return df.select("sv_id", F.inline(ends)).select("contig", "start", "end", "sv_id", "bp")


def annotate_bp(df: DataFrame, track: DataFrame, payload: Sequence[str]) -> DataFrame:
    """payload_1 and payload_2 of the first record at each break end: start <= pos and end > pos."""
    ends = F.array(*[F.struct(F.col(f"chr{k}").alias("contig"), F.col(f"pos{k}").alias("pos"), F.lit(k).alias("bp")) for k in (1, 2)])
    points = df.select("sv_id", F.inline(ends))
    hits = first_at_point(points, track, ["sv_id", "bp"], payload)
    wide = hits.groupBy("sv_id").agg(*[F.max(F.when(F.col("bp") == k, F.col(c))).alias(f"{c}_{k}") for c in payload for k in (1, 2)])
    return df.join(wide, "sv_id", "left")


def sv_contig_size(df: DataFrame, lengths: DataFrame) -> DataFrame:
    """size_1 and size_2; an unknown contig is an error."""
    for k in (1, 2):
        side = lengths.select(F.col("contig").alias(f"chr{k}"), F.col("length").alias(f"size_{k}"))
        df = df.join(side, f"chr{k}", "left").withColumn(f"size_{k}", F.coalesce(f"size_{k}", F.when(F.col(f"size_{k}").isNull(), F.raise_error(F.lit("unknown contig")).cast("bigint"))))
    return df


def attach_liftover_sv(df: DataFrame, lifts: DataFrame, name: str) -> DataFrame:
    """{name}_1/_2 (Match places, else Gap places) and {name}_lifted (any Match) from lifts (sv_id, contig, pos, ...)."""
    place = F.when(F.col("status") == "Match", locus(F.col("dst_contig"), F.col("dst_pos"))).when(F.col("status") == "Gap", locus(F.col("dst_contig"), F.col("dst_pos"), F.col("dst_end")))
    g = lifts.where(F.col("status").isin("Match", "Gap")).select("sv_id", "contig", "pos", "status", "ord", place.alias("place"))
    lists = g.groupBy("sv_id", "contig", "pos").pivot("status", ["Match", "Gap"]).agg(F.array_sort(F.collect_list(F.struct("ord", "place"))))
    text = lambda c: F.array_join(F.transform(c, lambda x: x["place"]), ",")
    lists = lists.select("sv_id", "contig", "pos", F.when(F.size("Match") > 0, text("Match")).otherwise(text("Gap")).alias("p"), (F.size("Match") > 0).alias("m"))
    for k in (1, 2):
        side = lists.select("sv_id", F.col("contig").alias(f"chr{k}"), F.col("pos").alias(f"pos{k}"), F.col("p").alias(f"{name}_{k}"), F.col("m").alias(f"_m{k}"))
        df = df.join(side, ["sv_id", f"chr{k}", f"pos{k}"], "left")
    return df.withColumn(f"{name}_lifted", F.coalesce(F.col("_m1"), F.lit(False)) | F.coalesce(F.col("_m2"), F.lit(False))).drop("_m1", "_m2")


def mean_support_kmer_ratio(df: DataFrame, reads: DataFrame, ratios: DataFrame) -> DataFrame:
    """Mean ratio of the reads that support any of a row's identical variants ('a,b'), three decimals.

    reads: (sv_id, read), counted once per variant; a read of two identical variants counts twice.
    """
    each = df.select("sv_id", F.explode(F.split("identical", ",")).alias("_one"))
    got = each.join(reads.select(F.col("sv_id").alias("_one"), "read").distinct(), "_one").join(ratios, "read")
    return df.join(got.groupBy("sv_id").agg(mean3(F.avg("ratio")).alias("kmer_ratio")), "sv_id", "left")


def match_sv_callset(df: DataFrame, other: DataFrame, margin: int = 100, name: str = "other_sv") -> DataFrame:
    """The first of the other callset with equal contigs and directions and both positions within the margin."""
    keys = ["chr1", "chr2", "dir1", "dir2"]
    left = df.select("sv_id", *keys, "pos1", "pos2", F.floor(F.col("pos1") / margin).alias("_b"))
    right = other.select(*keys, F.col("pos1").alias("_p1"), F.col("pos2").alias("_p2"), F.col("sv_id").alias("_id"), "ord", F.explode(F.sequence(F.floor(F.col("pos1") / margin) - 1, F.floor(F.col("pos1") / margin) + 1)).alias("_b"))
    hits = left.join(right, [*keys, "_b"]).where((F.abs(F.col("pos1") - F.col("_p1")) <= margin) & (F.abs(F.col("pos2") - F.col("_p2")) <= margin))
    return df.join(hits.groupBy("sv_id").agg(F.min_by("_id", "ord").alias(name)), "sv_id", "left")


def merge_sv_callsets(a: DataFrame, b: DataFrame, margin: int = 100) -> DataFrame:
    """Both callsets as one: rows of a with sources [a] or [a, b], and rows of b that match none of a."""
    on_a = match_sv_callset(a, b, margin, "match")
    on_b = match_sv_callset(b, a, margin, "match")
    cols = [*a.columns]
    mine = on_a.select(*cols, "match", F.when(F.col("match").isNull(), F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b"))).alias("sources"))
    rest = on_b.where(F.col("match").isNull()).select(*cols, "match", F.array(F.lit("b")).alias("sources"))
    return mine.unionByName(rest)


def in_population_order(df: DataFrame) -> DataFrame:
    """ref_chr1, ref_pos1, ref_chr2, ref_pos2 with the ends exchanged where population tables have them the other way.

    Autosomes stand in order of their numbers. An end on X or Y comes first to last, whatever the other is; one that is
    second changes places with a greater name only. The rule for X and Y is a precedence of "or" over "and" that results depend on.
    """
    number = lambda c: F.regexp_extract(F.col(c).cast("string"), "^chr([0-9]+)$", 1).try_cast("int")
    sex = lambda c: F.col(c).cast("string").isin("chrX", "chrY")
    one, two = "ref_chr1", "ref_chr2"
    swap = F.coalesce((~sex(one) & ~sex(two) & (number(one) > number(two))) | sex(one) | (sex(two) & (F.col(one) > F.col(two))), F.lit(False))
    ends = {one: two, two: one, "ref_pos1": "ref_pos2", "ref_pos2": "ref_pos1"}
    return df.select(*[F.when(swap, F.col(ends[c])).otherwise(F.col(c)).alias(c) if c in ends else F.col(f"`{c}`") for c in df.columns])


def annotate_population_sv(df: DataFrame, population: DataFrame, margin: int = 50) -> DataFrame:
    """The first population variant near the lifted break ends.

    df: sv_id, ref_chr1, ref_pos1, ref_chr2, ref_pos2, compared in population order (see above). population: chr1, start, end, chr2, end2, name,
    ord. On one chromosome |pos1 - start| and |pos2 - end2| are within the margin; across two, pos1 lies within the
    margin of [start, end]. Positions below the margin match nothing. Two equi-joins on binned starts.
    """
    p = population.where(F.col("end2").isNotNull())
    left = in_population_order(df).where(F.col("ref_pos1") >= margin).select("sv_id", F.col("ref_chr1").alias("chr1"), F.col("ref_chr2").alias("chr2"), "ref_pos1", "ref_pos2")
    points = left.select("*", F.col("chr1").alias("contig"), (F.col("ref_pos1") - margin).alias("start"), (F.col("ref_pos1") + margin + 1).alias("end"))
    near2 = F.abs(F.col("ref_pos2") - F.col("end2")) <= margin
    same = interval_join(points.where("chr1 = chr2"), p.where("chr1 = chr2").select(F.col("chr1").alias("contig"), "start", (F.col("start") + 1).alias("end"), "end2", "name", "ord")).where(near2)
    other = interval_join(points.where("chr1 <> chr2"), p.where("chr1 <> chr2").select(F.col("chr1").alias("contig"), "start", (F.col("end") + 1).alias("end"), F.col("chr2").alias("p_chr2"), "end2", "name", "ord")).where(near2 & (F.col("chr2") == F.col("p_chr2")))
    hits = same.select("sv_id", "r_start", "ord", "name").unionByName(other.select("sv_id", "r_start", "ord", "name"))
    return df.join(hits.groupBy("sv_id").agg(F.min_by("name", F.struct("r_start", "ord")).alias("population")), "sv_id", "left")


def link_ref_callset(df: DataFrame, links: DataFrame, ref: DataFrame, name: str = "ref") -> DataFrame:
    """Flag and comma list of the filters of the reference variants that links (sv_id, ref_id, ord) names."""
    got = links.join(ref.select(F.col("sv_id").alias("ref_id"), F.col("is_filter").alias("_f")), "ref_id")
    lists = got.groupBy("sv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "_f"))), lambda x: x["_f"]), ",").alias(f"{name}_filter"))
    return df.join(lists, "sv_id", "left").withColumn(name, F.col(f"{name}_filter").isNotNull())


def filter_support_reads(reads: DataFrame, svs: DataFrame) -> DataFrame:
    """Supporting reads of retained variants; a trailing _part of a read's variant id does not count."""
    return reads.withColumn("_k", F.regexp_replace("sv_id", "_[^_]*$", "")).join(svs.select(F.regexp_replace("sv_id", "_[^_]*$", "").alias("_k")).distinct(), "_k", "left_semi").drop("_k")


def in_simple_repeat(df: DataFrame, repeats: DataFrame, margin: int = 30) -> DataFrame:
    """Whether a +,- variant on one contig lies in a repeat within the margin."""
    local = df.where("chr1 = chr2 and dir1 = '+' and dir2 = '-'").select("sv_id", F.col("chr1").alias("contig"), F.greatest(F.col("pos1") - (margin - 1), F.lit(0)).alias("start"), (F.col("pos1") + margin).alias("end"), "pos2")
    hit = interval_join(local, repeats.select("contig", "start", "end")).where(F.col("r_end") >= F.col("pos2") - margin).select("sv_id").distinct()
    return df.join(hit.withColumn("in_repeat", F.lit(True)), "sv_id", "left").withColumn("in_repeat", F.coalesce("in_repeat", F.lit(False)))


def decide_array_change(df: DataFrame, scores: DataFrame | None) -> DataFrame:
    """Adds repeat_reason and flags Simple_repeat by the ordered rules over repeat scores (keyed by sv_id)."""
    if scores is None:
        reason = F.when(~F.col("in_repeat"), "outside").otherwise("no_scores")
        out = df.withColumn("repeat_reason", reason)
    else:
        out = df.join(scores.withColumn("_has", F.lit(True)), "sv_id", "left")
        reason = (
            F.when(~F.col("in_repeat"), "outside").when(F.col("_has").isNull(), "unscored").when(F.col("sv_id").startswith("d_"), "deletion")
            .when(F.col("self_repeat") >= 0.70, "self_repeat").when((F.col("flank_coverage") >= 0.60) & (F.col("flank_self_repeat") >= 0.48), "flank")
            .when(F.col("ins_len") < 50, "short").otherwise("kept")
        )
        out = out.withColumn("repeat_reason", reason).select(*df.columns, "repeat_reason")
    return out.withColumn("is_filter", add_flag(F.col("is_filter"), "Simple_repeat", ~F.col("repeat_reason").isin("outside", "kept")))


def repeat_flag_summary(df: DataFrame) -> DataFrame:
    return df.where(~F.col("repeat_reason").isin("outside", "kept")).groupBy("repeat_reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "repeat_reason")


def attach_ref_contig(df: DataFrame, reftable: DataFrame) -> DataFrame:
    """Reclassifies variants between contigs by each contig's longest reference span.

    reftable: contig, hap, strand, chrom, r_start, r_end, ord. Adds ref_chr1/2, ref_strand1/2, hap1/2 and sv_type; unknown
    contigs give nulls and keep the plain type.
    """
    span = F.struct((F.col("r_end") - F.col("r_start")).alias("span"), (-F.col("ord")).alias("back"))
    best = reftable.groupBy("contig").agg(F.max_by(F.struct("chrom", "strand", "r_start", "hap"), span).alias("b"))
    for k in (1, 2):
        df = df.join(best.select(F.col("contig").alias(f"chr{k}"), F.col("b").alias(f"b{k}")), f"chr{k}", "left")
    d1, d2 = flip(F.col("dir1"), F.col("b1.strand")), flip(F.col("dir2"), F.col("b2.strand"))
    swap = F.col("b2.r_start") < F.col("b1.r_start")
    first, second = F.when(swap, d2).otherwise(d1), F.when(swap, d1).otherwise(d2)
    between = (
        F.when((F.col("b1.chrom") != F.col("b2.chrom")) | (F.col("b1.hap") != F.col("b2.hap")), "Translocation").when(first == second, "Inversion").when((first == "-") & (second == "+"), "Duplication")
        .when(F.col("ins_len") > F.abs(F.col("b2.r_start") - F.col("b1.r_start")) + 1, "Insertion").otherwise("Deletion")
    )
    plain = classify_sv_type(F.col("chr1"), F.col("pos1"), F.col("dir1"), F.col("chr2"), F.col("pos2"), F.col("dir2"), F.col("ins_len"))
    kind = F.when((F.col("chr1") == F.col("chr2")) | F.col("b1").isNull() | F.col("b2").isNull(), plain).otherwise(between)
    out = df.withColumn("sv_type", kind)
    for k in (1, 2):
        out = out.withColumns({f"ref_chr{k}": F.col(f"b{k}.chrom"), f"ref_strand{k}": F.col(f"b{k}.strand"), f"hap{k}": F.col(f"b{k}.hap")})
    return out.drop("b1", "b2")


def sort_support_reads(reads: DataFrame) -> DataFrame:
    """Supporting reads by read and place along it."""
    return reads.orderBy("read", "read_pos", "ord")


def read_adjacent_pairs(reads: DataFrame, margin: float = 1.3) -> DataFrame:
    """Pairs of variants that follow each other along a read and whose distances agree within a factor of `margin`.

    reads: read, read_pos, ord, sv_id, chr2, pos2 (leaving end) and chr1, pos1 (entering end). Returns an edge per pair
    with the first read distance and all of them. Every read counts, the last too. With read_dir, dir1, dir2 and ins_len
    see oriented_pairs(); without them every variant is taken as read forwards, and directions do not count.
    """
    if "read_dir" in reads.columns:
        return oriented_pairs(reads, margin)
    w = Window.partitionBy("read").orderBy("read_pos", "ord")
    nxt = F.lead(F.struct("sv_id", "chr1", "pos1", "read_pos")).over(w)
    pairs = reads.withColumn("n", nxt).where(F.col("n").isNotNull())
    d_read, d_ref = F.col("n.read_pos") - F.col("read_pos"), F.abs(F.col("n.pos1") - F.col("pos2"))
    ok = (F.col("chr2") == F.col("n.chr1")) & (d_ref <= d_read * margin) & (d_read <= d_ref * margin)
    edges = pairs.where(ok).select(F.col("sv_id").alias("from_sv"), F.col("n.sv_id").alias("to_sv"), d_read.alias("d"), "read", "ord")
    return edges.groupBy("from_sv", "to_sv").agg(F.min_by("d", F.struct("read", "ord")).alias("first_size"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("read", "ord", "d"))), lambda x: x["d"].cast("string")), ",").alias("sizes"))


def oriented_pairs(reads: DataFrame, margin: float = 1.3) -> DataFrame:
    """Pairs along reads with directions: read_dir tells how the read runs through a variant, ins_len what it inserts.

    Read places move past inserted bases, and a variant read backwards is entered by its second end. The segment between
    must leave by - and enter by +, or the reverse: then the pair is turned around, so both strands give one edge.
    from_turn and to_turn are - where a variant's ends are exchanged; first_size is the segment's size on the reference.
    """
    forward = F.col("read_dir") == "+"
    end = lambda k: F.struct(F.col(f"chr{k}").alias("chr"), F.col(f"pos{k}").alias("pos"), F.col(f"dir{k}").alias("dir"))
    ins = F.coalesce(F.col("ins_len"), F.lit(0))
    r = reads.select(
        "read", "read_pos", "ord", "sv_id", "read_dir", F.when(forward, end(1)).otherwise(end(2)).alias("enter"), F.when(forward, end(2)).otherwise(end(1)).alias("leave"),
        (F.col("read_pos") + F.when(forward, ins).otherwise(0)).alias("last"), (F.col("read_pos") - F.when(forward, 0).otherwise(ins)).alias("first"),
    )
    w = Window.partitionBy("read").orderBy("read_pos", "ord")
    pairs = r.withColumn("n", F.lead(F.struct("sv_id", "read_dir", "enter", "first")).over(w)).where(F.col("n").isNotNull() & (F.col("leave.chr") == F.col("n.enter.chr")))
    out, into = F.col("leave.dir"), F.col("n.enter.dir")
    gap, d = F.col("n.enter.pos") - F.col("leave.pos"), F.col("n.first") - F.col("last")
    size = F.when((out == "-") & (into == "+"), gap).when((out == "+") & (into == "-"), -gap)
    turn = lambda c: F.when(F.col(c) == "+", "-").otherwise("+")
    way = lambda back, on: F.when(out == "+", back).otherwise(on)
    edges = pairs.where((size <= d * margin) & (size * margin >= d)).select(
        way(F.col("n.sv_id"), F.col("sv_id")).alias("from_sv"), way(F.col("sv_id"), F.col("n.sv_id")).alias("to_sv"),
        way(turn("n.read_dir"), F.col("read_dir")).alias("from_turn"), way(turn("read_dir"), F.col("n.read_dir")).alias("to_turn"), size.alias("size"), d.alias("d"), "read", "ord",
    )
    return edges.groupBy("from_sv", "to_sv", "from_turn", "to_turn").agg(F.min_by("size", F.struct("read", "ord")).alias("first_size"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("read", "ord", "d"))), lambda x: x["d"].cast("string")), ",").alias("sizes"))


def connected(edges: DataFrame, a: str, b: str, rounds: int = 40) -> DataFrame:
    """(node, path): the nodes that edges connect, named by the smallest, by label propagation; each round is stored."""
    nodes = edges.select(F.col(a).alias("node")).unionByName(edges.select(F.col(b).alias("node"))).distinct().withColumn("path", F.col("node"))
    both = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).unionByName(edges.select(F.col(b).alias("a"), F.col(a).alias("b"))).distinct()
    state, both = stored(nodes), stored(both)
    for _ in range(rounds):
        # A label's own label is nearer to the smallest: paths are halved at each round.
        ahead = state.join(state.select(F.col("node").alias("path"), F.col("path").alias("further")), "path")
        low = both.join(ahead.select("node", "further"), both.b == F.col("node")).groupBy("a").agg(F.min("further").alias("low"))
        best = F.least("further", "low")
        # What a node hears from its neighbours goes to its label too, so one hop tells all that share the label.
        told = ahead.join(low, F.col("node") == F.col("a")).select(F.inline(F.array(F.struct("node", best.alias("path"), F.col("path").alias("was")), F.struct(F.col("path").alias("node"), best.alias("path"), F.lit(None).alias("was")))))
        new = stored(told.groupBy("node").agg(F.min("path").alias("path"), F.max("was").alias("was")))
        dropped(state)
        state = new.select("node", "path")
        state._rows_at = new._rows_at
        if new.where("path <> was").isEmpty():
            dropped(both)
            return state
    raise RuntimeError("paths have not settled")


def link_rearrangements(edges: DataFrame, svs: DataFrame) -> DataFrame:
    """Ordered paths over edges of oriented_pairs(): path, step, sv_id, turn, size (to the next step), reads.

    Variants are told apart by their break ends (svs: sv_id, chr1, pos1, dir1, chr2, pos2, dir2), not by their ids. Edges
    that end where others begin are joined, turned around if need be, until no pair joins; in order of (from_sv, to_sv,
    turns) a path takes the first that fits. An edge stands in one path. Where every end meets one other at most there is
    nothing to choose, and steps are numbered by pointer doubling over all tasks, whatever the length of a path. Components with a
    choice, found by label propagation, are laid one by one, each by one task.
    """
    end = lambda k: F.concat_ws(":", *[F.col(f"{c}{k}").cast("string") for c in ("chr", "pos", "dir")])
    ends = svs.select(F.col("sv_id"), end(1).alias("a"), end(2).alias("b"))

    def oriented(side: str, back: bool = False) -> Column:
        a, b = F.col(f"{side}_a"), F.col(f"{side}_b")
        turned = F.col(f"{side}_turn") == ("+" if back else "-")
        return F.when(turned, F.concat_ws("|", b, a)).otherwise(F.concat_ws("|", a, b))

    # Edges are numbered in their order once, and every step moves the number in place of the names, a text of some 20 characters.
    e = numbered_in_order(edges.select("from_sv", "to_sv", "from_turn", "to_turn", F.col("first_size").cast("long").alias("size"), F.col("sizes").alias("reads")), ["from_sv", "to_sv", "from_turn", "to_turn"], "edge")
    for side in ("from", "to"):
        e = e.join(ends.select(F.col("sv_id").alias(f"{side}_sv"), F.col("a").alias(f"{side}_a"), F.col("b").alias(f"{side}_b")), f"{side}_sv")
    key = lambda side: F.concat_ws("|", F.least(f"{side}_a", f"{side}_b"), F.greatest(f"{side}_a", f"{side}_b"))
    e = stored(e).withColumns({"head": oriented("from"), "tail": oriented("to"), "head_turned": oriented("from", True), "tail_turned": oriented("to", True)})
    # An edge goes on from its tail, or backwards from its head; what leads on from a label begins with it.
    states = e.select("edge", F.inline(F.array(F.struct(F.lit(True).alias("on"), F.col("head").alias("enter"), F.col("tail").alias("leave")), F.struct(F.lit(False).alias("on"), F.col("tail_turned").alias("enter"), F.col("head_turned").alias("leave")))))
    choice = states.groupBy("enter").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("enter")
    # Ends that read alike from both sides may meet themselves.
    choice = choice.unionByName(e.where("head = head_turned").select(F.col("head").alias("enter"))).unionByName(e.where("tail = tail_turned").select(F.col("tail").alias("enter"))).distinct()
    chosen = checkpointed(states.join(choice, "enter", "left_semi").select("edge").distinct())
    if chosen.isEmpty():
        return _numbered(e, states)
    e = e.withColumns({"from_key": key("from"), "to_key": key("to")}).drop("from_a", "from_b", "to_a", "to_b")
    roots = connected(e, "from_key", "to_key").select(F.col("node").alias("from_key"), F.col("path").alias("component"))
    placed = stored(e.join(roots, "from_key"))
    branched = placed.join(chosen, "edge", "left_semi").select("component").distinct()

    def lay(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_laid(pdf.sort_values("edge").to_dict("records")), columns=["path", "step", "sv_id", "turn", "size", "reads"])

    laid = placed.join(branched, "component", "left_semi").groupBy("component").applyInPandas(lay, "path string, step int, sv_id string, turn string, size long, reads string")
    plain = checkpointed(placed.join(branched, "component", "left_anti").drop("component"))
    return laid.unionByName(_numbered(plain, states.join(plain.select("edge"), "edge", "left_semi")))


def _ranked_lists(steps: DataFrame, most: int = 64) -> tuple[DataFrame, DataFrame]:
    """(ranked, cyclic) of linked lists (node, next): node, last (where its list ends) and how far away it is; nodes of cycles.

    Pointers double each round, so a list of n nodes takes log n rounds. Each round some node of every list sees its end;
    when none does, what is left goes round in cycles. Only the last round's table stays.
    """
    # far counts the steps to next, or to last where next is null.
    now = stored(steps.select("node", "next", F.when(F.col("next").isNull(), F.col("node")).alias("last"), F.when(F.col("next").isNull(), 0).otherwise(1).cast("bigint").alias("far")))
    left = now.where("next is not null").count()
    for _ in range(most):
        if not left:
            break
        ahead = now.select(F.col("node").alias("_n"), F.col("next").alias("_next"), F.col("last").alias("_last"), F.col("far").alias("_far"))
        joined = now.join(ahead, F.col("next") == F.col("_n"), "left")
        old, now = now, stored(joined.select("node", F.col("_next").alias("next"), F.coalesce("last", "_last").alias("last"), (F.col("far") + F.coalesce("_far", F.lit(0))).alias("far")))
        dropped(old)
        before, left = left, now.where("next is not null").count()
        if left == before:
            break
    return now.where("next is null").select("node", "last", "far"), now.where("next is not null").select("node")


def _numbered(e: DataFrame, states: DataFrame) -> DataFrame:
    """Paths of edges none of whose ends has a choice, by list ranking; a ring is opened behind its last edge.

    A node is an edge's number with its way in the last digit: even backwards, odd on.
    """
    edge, on = F.expr("node div 2"), F.col("node") % 2 == 1
    s = states.select((F.col("edge") * 2 + F.col("on").cast("bigint")).alias("node"), "enter", "leave")
    into = s.select(F.col("enter").alias("_e"), F.col("node").alias("next"))
    steps = stored(s.join(into, F.col("leave") == F.col("_e"), "left").select("node", "next"))
    ranked, cyclic = _ranked_lists(steps)
    rings = checkpointed(steps.join(cyclic, "node", "left_semi"))
    if not rings.isEmpty():
        ring = connected(rings.select(edge.alias("_x"), F.expr("next div 2").alias("_y")), "_x", "_y").select(F.col("node").alias("edge"), F.col("path").alias("ring"))
        of = rings.withColumn("edge", edge)
        last = of.join(ring, "edge").groupBy("ring").agg(F.max("edge").alias("edge")).select("edge", F.lit(True).alias("_cut"))
        opened = of.join(last, "edge", "left").withColumn("next", F.when(F.col("_cut").isNull(), F.col("next")))
        ranked = ranked.unionByName(_ranked_lists(opened)[0])
    # Each path is there in both directions; that counts in which its first edge is gone forwards.
    at = ranked.select("last", "far", edge.alias("edge"), on.alias("on"))
    lists = at.groupBy("last").agg(F.min(F.struct("edge", ~F.col("on"))).alias("f"), F.count(F.lit(1)).alias("n")).where("not f.col2").select("last", F.col("f.edge").alias("first"), "n")
    rows = at.join(lists, "last").join(e.select("edge", "from_sv", "to_sv", "from_turn", "to_turn", "size", "reads"), "edge")
    flip = lambda c: F.when(F.col(c) == "+", "-").otherwise("+")
    way = lambda f, t: F.when(F.col("on"), f).otherwise(t)
    a = F.struct(way(F.col("from_sv"), F.col("to_sv")).alias("sv_id"), way(F.col("from_turn"), flip("to_turn")).alias("turn"), F.col("size"), F.col("reads"))
    b = F.struct(way(F.col("to_sv"), F.col("from_sv")).alias("sv_id"), way(F.col("to_turn"), flip("from_turn")).alias("turn"), F.lit(None).cast("bigint").alias("size"), F.lit(None).cast("string").alias("reads"))
    names = rows.groupBy("last").agg(F.min(F.least("from_sv", "to_sv")).alias("_least"), F.max(F.when(F.col("edge") == F.col("first"), F.concat("from_sv", F.lit(">"), "to_sv"))).alias("_of"))
    step = (F.col("n") - 1 - F.col("far")).cast("int")
    out = rows.join(names, "last").select(F.concat("_least", F.lit(":"), "_of").alias("path"), F.inline(F.when(F.col("far") > 0, F.array(F.struct(step.alias("step"), a.alias("r")))).otherwise(F.array(F.struct(step.alias("step"), a.alias("r")), F.struct((step + 1).alias("step"), b.alias("r"))))))
    return out.select("path", "step", "r.*")


def _turned(oriented: str) -> str:
    return "|".join(oriented.split("|")[::-1])


def _laid(edges: list[dict]) -> list[tuple]:
    """Rows of the paths that edges give, each edge looked up by its ends."""
    at: dict[str, list[tuple[int, bool]]] = {}  # a path that comes to this end goes on with the edge, turned or not
    for i, e in enumerate(edges):
        at.setdefault(e["head"], []).append((i, False))
        at.setdefault(_turned(e["tail"]), []).append((i, True))
    used: set[int] = set()
    out: list[tuple] = []

    def following(end: str) -> tuple[int, bool] | None:
        return next(((i, back) for i, back in at.get(end, ()) if i not in used), None)

    def walked(i: int, back: bool) -> tuple[tuple[str, str], tuple[str, str], str]:
        """(variant and turn where the edge begins, where it ends, the oriented ends it leads to) in the way it is gone."""
        e = edges[i]
        a, b = (e["from_sv"], e["from_turn"]), (e["to_sv"], e["to_turn"])
        if not back:
            return a, b, e["tail"]
        flip_ = {"+": "-", "-": "+"}
        return (b[0], flip_[b[1]]), (a[0], flip_[a[1]]), _turned(e["head"])

    for first in range(len(edges)):
        if first in used:
            continue
        used.add(first)
        path = deque([(first, False)])
        head, tail = _turned(edges[first]["head"]), edges[first]["tail"]  # where it can go on, backwards and forwards
        while True:
            on, before = following(tail), following(head)
            if on is None and before is None:
                break
            if before is None or (on is not None and on[0] <= before[0]):
                used.add(on[0])
                path.append(on)
                tail = walked(*on)[2]
            else:
                used.add(before[0])
                path.appendleft((before[0], not before[1]))
                head = walked(*before)[2]
        name = min(x for i, _ in path for x in (edges[i]["from_sv"], edges[i]["to_sv"])) + f":{edges[first]['from_sv']}>{edges[first]['to_sv']}"
        for step, (i, back) in enumerate(path):
            a, b, _ = walked(i, back)
            out.append((name, step, *a, edges[i]["size"], edges[i]["reads"]))
        out.append((name, len(path), *b, None, None))
    return out
