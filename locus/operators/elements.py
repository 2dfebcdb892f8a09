"""LINE-1 elements from alignment hits, and inserted sequences."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locus.functions.seq import kmers, poly_at, self_repeat

from .checkpoints import stored
from .intervals import interval_join, merge_intervals
from .intervals import union_of_spans as _union
from .variants import numbered_in_order

#: Bases of a section of hits that one task chains.
SECTION = 1 << 19


def union_length(hits: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bases of the union of query intervals (start, end) of each group."""
    return merge_intervals(hits, by).groupBy(*by).agg(F.sum(F.col("end") - F.col("start")).alias("length"))


def chain_hsps(hits: DataFrame, query_len: int, max_gap: int = 300, tolerance: int = 200, min_cov: float = 0.55, min_span: int = 3000, max_span: int = 6300) -> DataFrame:
    """Chains of hits of one contig and strand: contig, strand, start, end, covered, n_hits, identity.

    hits: contig, strand, start, end (target), q_start, q_end, and n_match and aligned, whose sums give the identity to four
    decimals; without them it is null. By target start, a hit extends the open chain if it
    follows the last one within the gap, does not step back over the chain's query by more than the tolerance (its end
    on +, its start on -) and keeps the span. The open chain decides, so where chains begin depends on all hits before. A
    contig is cut into sections; a task of one section walks from each hit at which a chain of the section before can leave
    off, which lies within the span of its first base, and walks meet soon. It returns their chains, with the entries that
    lead to each, and the exit of each entry; exits of a contig's sections, a row of a few numbers each, give the true entries.
    """
    counted = {"n_match", "aligned"} <= set(hits.columns)
    kind = hits.schema["contig"].dataType.simpleString()
    by, width = ["contig", "strand"], max(SECTION, 4 * max_span)
    order = [c for c in ("start", "end", "q_start", "q_end", "n_match", "aligned") if c in hits.columns]
    columns = ["contig", "strand", "section", "start", "end", "covered", "n_hits", "identity", "bounds", "exits"]

    def walked(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        keys = (pdf["contig"].iloc[0], pdf["strand"].iloc[0], int(pdf["section"].iloc[0]))
        start, end, qs, qe = (pdf[c].to_numpy() for c in ("start", "end", "q_start", "q_end"))
        n, near = int(pdf["own"].sum()), start[1:] - end[:-1] <= max_gap

        def behind(i: int) -> int:
            """The first hit that a chain which opens at i does not take."""
            size = 64
            while True:
                k = min(i + 1 + size, len(start))
                query = qe[i + 1 : k] <= np.minimum.accumulate(qs[i : k - 1]) + tolerance if keys[1] == "-" else qs[i + 1 : k] >= np.maximum.accumulate(qe[i : k - 1]) - tolerance
                fits = near[i : k - 1] & (end[i + 1 : k] <= start[i] + max_span) & query
                if not fits.all():
                    return i + 1 + int(fits.argmin())
                if k == len(start):
                    return k
                size *= 4

        # Entries are hits from the first to that behind the last within the span; a walk's next hit is always further on.
        entries = int((start[:n] - keys[2] * width < max_span).sum()) + 1 if n else 0
        after: dict[int, int] = {}
        for e in range(entries):
            while e < n and e not in after:
                after[e] = e = behind(e)
        left: dict[int, int] = {}
        for h in sorted(after, reverse=True):
            left[h] = left[after[h]] if after[h] < n else after[h] - n
        led = {h: 1 << h if h < entries else 0 for h in after}
        out = []
        for h in sorted(after):
            k = after[h]
            if k < n:
                led[k] |= led[h]
            lo, hi = start[h], end[h:k].max()
            if not min_span <= hi - lo <= max_span:
                continue
            covered = sum(b - a for a, b in _union(zip(qs[h:k], qe[h:k], strict=True)))
            if covered >= min_cov * query_len:
                identity = round(float(pdf["n_match"].iloc[h:k].sum() / (pdf["aligned"].iloc[h:k].sum() or 1)), 4) if counted else None
                inside = [led[h] >> e & 1 for e in range(entries)]
                bounds = [e for e, (x, y) in enumerate(zip([0, *inside], [*inside, 0], strict=True)) if x != y]
                out.append((*keys, lo, hi, covered, k - h, identity, bounds, None))
        exits = [left.get(e, 0) for e in range(entries)]
        runs = [x for e in range(entries) if e == 0 or exits[e] != exits[e - 1] for x in (e, exits[e])]
        if n:
            out.append((*keys, None, None, None, None, None, None, runs))
        frame = pd.DataFrame(out, columns=columns)
        return frame.astype({c: "Int64" for c in ("start", "end", "covered", "n_hits")})

    def entered(pdf: pd.DataFrame) -> pd.DataFrame:
        entry, last, out = 0, None, []
        for section, runs in sorted(zip(pdf["section"], pdf["exits"], strict=True), key=lambda x: x[0]):
            entry = entry if section - 1 == last else 0
            out.append((pdf["contig"].iloc[0], pdf["strand"].iloc[0], section, entry))
            entry, last = [x for e, x in zip(runs[::2], runs[1::2], strict=True) if e <= entry][-1], section
        return pd.DataFrame(out, columns=["contig", "strand", "section", "entry"])

    # A hit stands in its section and, within the span of the section's first base, in the one before.
    own = F.floor(F.col("start") / width)
    both = F.when(F.col("start") - own * width < max_span, F.array(own, own - 1)).otherwise(F.array(own))
    rows = hits.where("start is not null").select(*by, *order, own.alias("_own"), F.explode(both).alias("section"))
    rows = rows.select(*by, *order, (F.col("_own") == F.col("section")).alias("own"), "section")
    walks = stored(rows.groupBy(*by, "section").applyInPandas(walked, f"contig {kind}, strand string, section long, start long, end long, covered long, n_hits int, identity double, bounds array<int>, exits array<int>"))
    true = walks.where("exits is not null").select(*by, "section", "exits").groupBy(*by).applyInPandas(entered, f"contig {kind}, strand string, section long, entry int")
    true = true.select(*[F.col(c).alias(f"_{c}") for c in true.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*by, "section")]
    led_to = F.size(F.filter("bounds", lambda b: b <= F.col("_entry"))) % 2 == 1
    return walks.where("exits is null").join(true, [*same, led_to]).select(*by, "start", "end", "covered", "n_hits", "identity")


def best_hit_per_family(hits: DataFrame) -> DataFrame:
    """The best hit of each locus and family by (bits, model, lo, hi)."""
    return hits.groupBy("locus", "family").agg(F.max(F.struct("bits", "model", "lo", "hi")).alias("b")).select("locus", "family", "b.*")


def top_families(hits: DataFrame, young: Sequence[str], margin: float = 3.0) -> DataFrame:
    """Loci whose best family is young: family lists all young ones within the margin of the top; else a reason."""
    best = best_hit_per_family(hits)
    w = Window.partitionBy("locus")
    r = best.withColumns({"_top": F.max("bits").over(w), "_rank": F.row_number().over(w.orderBy(F.desc("bits"), F.desc("model"), F.desc("family")))})
    is_young = F.col("family").isin(*young)
    near = F.array_sort(F.collect_list(F.when(is_young & (F.col("bits") >= F.col("_top") - margin), F.struct("_rank", "family"))))
    g = r.groupBy("locus").agg(F.max(F.when(F.col("_rank") == 1, is_young)).alias("ok"), near.alias("n"), F.max_by("lo", -F.col("_rank")).alias("lo"), F.max_by("hi", -F.col("_rank")).alias("hi"))
    return g.select("locus", F.when(F.col("ok"), F.array_join(F.transform("n", lambda x: x["family"]), "/")).alias("family"), F.when(~F.col("ok"), "old_family").alias("reason"), "lo", "hi")


def refine_elements(loci: DataFrame, three: DataFrame, five: DataFrame, young: Sequence[str], min_span: int = 5800, max_span: int = 6300) -> DataFrame:
    """Elements with a young 3' end and a 5' model before it: contig, start, end, strand, family, name, reason.

    loci: locus, contig, start, end, strand; hits are in locus coordinates. Rejected loci keep their reason.
    """
    t = top_families(three, young).withColumnRenamed("lo", "_lo3").withColumnRenamed("hi", "_hi3")
    pairs = t.join(five.select("locus", F.col("bits").alias("_b5"), F.col("lo").alias("_lo5")), "locus", "left").where(F.col("_lo5").isNull() | (F.col("_lo5") < F.col("_lo3")))
    start5 = pairs.groupBy("locus").agg(F.max_by("_lo5", F.struct("_b5", "_lo5")).alias("_s"))
    j = loci.join(t, "locus", "left").join(start5, "locus", "left")
    span = F.col("_hi3") - F.col("_s")
    reason = F.when(F.col("family").isNull() & F.col("reason").isNull(), "no_three_end").when(F.col("reason").isNotNull(), F.col("reason")).when(F.col("_s").isNull(), "no_five_end").when(~span.between(min_span, max_span), "span")
    minus = F.col("strand") == "-"
    a, b = F.when(minus, F.col("end") - F.col("_hi3")).otherwise(F.col("start") + F.col("_s")), F.when(minus, F.col("end") - F.col("_s")).otherwise(F.col("start") + F.col("_hi3"))
    out = j.select("locus", "contig", a.alias("start"), b.alias("end"), "strand", "family", reason.alias("reason"))
    return out.withColumn("name", F.concat_ws(",", F.col("contig").cast("string"), F.col("start").cast("string"), F.col("end").cast("string"), "strand", "family"))


def refine_summary(refined: DataFrame) -> DataFrame:
    return refined.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


# inserted sequences


def min_insert_len(df: DataFrame, least: int = 100) -> DataFrame:
    """Insertions of at least `least` bases with their seven-part key."""
    parts = [F.col(c).cast("string") for c in ("chr1", "pos1", "dir1", "chr2", "pos2", "dir2")]
    return df.where(F.length("inserted") >= least).withColumn("insert_key", F.concat_ws(",", *parts, F.length("inserted").cast("string")))


def aligned_blocks(alignments: DataFrame) -> DataFrame:
    """Blocks of alignments cut at N: read, contig, strand, start, end, q_start, q_end (0-based, on the read as sequenced).

    One pass over the CIGAR operations of a row: they move the places on both axes, and an N closes a block.
    """
    numbers = F.transform(F.expr("regexp_extract_all(cigar, '(\\\\d+)[MIDNSHP=X]', 1)"), lambda x: x.cast("bigint"))
    kinds = F.expr("regexp_extract_all(cigar, '\\\\d+([MIDNSHP=X])', 1)")
    ops = F.concat(F.arrays_zip(numbers.alias("n"), kinds.alias("k")), F.array(F.struct(F.lit(0).cast("bigint").alias("n"), F.lit("N").alias("k"))))
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    found = "array<struct<a:bigint,b:bigint,qa:bigint,qb:bigint>>"
    begin = F.struct(zero.alias("r"), zero.alias("q"), none.alias("a"), none.alias("b"), none.alias("qa"), none.alias("qb"), F.array().cast(found).alias("found"))

    def step(acc: Column, o: Column) -> Column:
        n, k, here = o["n"], o["k"], o["k"].isin("M", "=", "X")
        r, q = acc["r"] + F.when(k.isin("M", "D", "N", "=", "X"), n).otherwise(0), acc["q"] + F.when(k.isin("M", "I", "S", "H", "=", "X"), n).otherwise(0)
        closed = (k == "N") & acc["a"].isNotNull()
        kept = lambda new, old: F.when(k == "N", none).when(here, new).otherwise(old)
        return F.struct(
            r.alias("r"), q.alias("q"), kept(F.coalesce(acc["a"], acc["r"]), acc["a"]).alias("a"), kept(r, acc["b"]).alias("b"), kept(F.coalesce(acc["qa"], acc["q"]), acc["qa"]).alias("qa"), kept(q, acc["qb"]).alias("qb"),
            F.when(closed, F.array_append(acc["found"], F.struct(acc["a"].alias("a"), acc["b"].alias("b"), acc["qa"].alias("qa"), acc["qb"].alias("qb")))).otherwise(acc["found"]).alias("found"),
        )

    # Length and blocks leave in one array: a second use of the walk, as in the filter that a plain inline() adds, would repeat it.
    walked = F.transform(F.array(F.aggregate(ops, begin, step)), lambda w: F.struct(w["q"].alias("_len"), w["found"].alias("_found")))
    rows = alignments.select("read", "contig", "strand", F.col("start").alias("_s"), F.inline_outer(walked)).select("read", "contig", "strand", "_s", "_len", F.inline_outer("_found")).where("a is not null")
    minus = F.col("strand") == "-"
    return rows.select("read", "contig", "strand", (F.col("_s") + F.col("a")).alias("start"), (F.col("_s") + F.col("b")).alias("end"), F.when(minus, F.col("_len") - F.col("qb")).otherwise(F.col("qa")).alias("q_start"), F.when(minus, F.col("_len") - F.col("qa")).otherwise(F.col("qb")).alias("q_end"))


def exon_support(blocks: DataFrame, exons: DataFrame, least: float = 0.5, exons_least: int = 2, overhang: int = 10) -> DataFrame:
    """Transcripts that an insert's blocks follow: insert_key, transcript, match_ratio, n_exons, bars.

    blocks: insert_key, ins_len, contig, start, end, strand, q_start, q_end (0-based, on the insert); exons: contig, start,
    end, transcript, exon_number. An overlap counts up to the aligned length; an exon counts if the overlap is 95 % of
    exon and block. bars are the aligned stretches in order, without ends that hang over the exon, each as
    first,last,exon,share of the exon.
    """
    pairs = interval_join(blocks, exons)
    c = F.col
    over = F.least("end", "r_end") - F.greatest("start", "r_start")
    both = (over >= 0.95 * (c("end") - c("start"))) & (over >= 0.95 * (c("r_end") - c("r_start")))
    plus, left, right = c("strand") == "+", c("r_start") - c("start"), c("end") - c("r_end")
    a1 = F.when((left > overhang) & plus, F.least(c("q_end"), c("q_start") + left)).otherwise(c("q_start"))
    z1 = F.when((left > overhang) & ~plus, F.greatest(c("q_start"), c("q_end") - left)).otherwise(c("q_end"))
    pairs = pairs.withColumns({"_over": over, "_both": both, "_a": a1, "_z": z1})
    a2 = F.when((right > overhang) & ~plus, F.least(c("_z"), c("_a") + right)).otherwise(c("_a"))
    z2 = F.when((right > overhang) & plus, F.greatest(c("_a"), c("_z") - right)).otherwise(c("_z"))
    bar = F.struct(a2.alias("a"), z2.alias("z"), c("exon_number").alias("x"), (c("_over") / (c("r_end") - c("r_start"))).alias("share"))
    g = pairs.groupBy("insert_key", "transcript").agg((F.sum(F.least(c("_over"), c("q_end") - c("q_start"))) / F.max("ins_len")).alias("match_ratio"), F.sum(c("_both").cast("int")).alias("n_exons"), F.array_sort(F.collect_list(bar)).alias("b"))
    text = F.array_join(F.transform("b", lambda x: F.concat_ws(",", (x["a"] + 1).cast("string"), x["z"].cast("string"), x["x"].cast("string"), F.round(x["share"], 4).cast("string"))), ";")
    kept = g.where((F.col("match_ratio") >= least) & (F.col("n_exons") >= exons_least))
    return kept.select("insert_key", "transcript", F.round("match_ratio", 4).alias("match_ratio"), "n_exons", text.alias("bars"))


def best_pseudogene(support: DataFrame) -> DataFrame:
    """The transcript with the highest ratio of each insert, the first name on ties."""
    order = F.struct("match_ratio", "n_exons")
    top = support.groupBy("insert_key").agg(F.max(order).alias("_o"))
    return support.join(top, "insert_key").where(order == F.col("_o")).groupBy("insert_key").agg(F.min_by(F.struct("transcript", "match_ratio", "n_exons"), "transcript").alias("b")).select("insert_key", "b.*")


def repeat_composition(hits: DataFrame) -> DataFrame:
    """Ratios and class of each insert from repeat hits (insert_key, ins_len, start, end, strand, repeat, family, ord).

    Lengths of L1, Alu and SVA over the length without the poly-A/T tail; L1 over 0.8 is Simple, Inverted (two hits of
    different strands) or Other, and Alu and then SVA over 0.8 override.
    """
    n = F.col("end") - F.col("start")
    length = lambda f: F.sum(F.when(F.col("family") == f, n).otherwise(0))
    l1 = F.col("family") == "LINE/L1"
    g = hits.groupBy("insert_key").agg(
        F.max("ins_len").alias("total"), length("LINE/L1").alias("_l"), length("SINE/Alu").alias("_a"), length("Retroposon/SVA").alias("_s"),
        F.min_by(n, F.when(F.col("repeat") == "(T)n", F.struct("start", "ord"))).alias("_t"), F.max_by(n, F.when(F.col("repeat") == "(A)n", F.struct("start", "ord"))).alias("_p"),
        F.count(F.when(l1, 1)).alias("_n"), F.countDistinct(F.when(l1, F.col("strand"))).alias("_d"),
    )
    rest = F.col("total") - F.coalesce("_p", "_t", F.lit(0))
    ratio = lambda c: F.when(rest <= 0, 0.0).otherwise(F.least(F.lit(1.0), F.col(c) / rest))
    g = g.select("insert_key", ratio("_l").alias("l1_ratio"), ratio("_a").alias("alu_ratio"), ratio("_s").alias("sva_ratio"), "_n", "_d")
    l1_class = F.when(F.col("_n") == 1, "Simple_LINE1").when((F.col("_n") == 2) & (F.col("_d") == 2), "Inverted_LINE1").otherwise("Other_LINE1")
    return g.withColumn("repeat_class", F.when(F.col("sva_ratio") >= 0.8, "SVA").when(F.col("alu_ratio") >= 0.8, "Alu").when(F.col("l1_ratio") >= 0.8, l1_class)).drop("_n", "_d")


def nearest_source_l1(sites: DataFrame, elements: DataFrame, keys: Sequence[str], near: int = 50, far: int = 5000) -> DataFrame:
    """The element that a transduction came from: for + the lowest minus-strand start in [start - near, start + far), for
    - the highest plus-strand start in [start - far, end + near).

    Elements may have `kind_rank` (0 for the assembly's own annotation, then 1 and 2 for population callsets): before -
    the best kind decides and then the place, before + the place and then the kind.
    """
    plus = F.col("source_dir") == "+"
    rank = F.col("kind_rank") if "kind_rank" in elements.columns else F.lit(0)
    minus = F.col("strand") == "-"
    # Elements are numbered in the order in which they are chosen, so a pick is the least number: picks of whole rows would sort all pairs.
    ranked = elements.where(F.col("strand").isin("+", "-")).select("contig", "start", "end", "strand", "name", "ord", rank.cast("long").alias("kind_rank"))
    ranked = ranked.withColumns({"_first": F.when(minus, F.col("start")).otherwise(F.col("kind_rank")), "_then": F.when(minus, F.col("kind_rank")).otherwise(-F.col("start"))})
    ranked = numbered_in_order(ranked, [F.asc_nulls_last("_first"), F.asc_nulls_last("_then"), F.desc("ord")])
    own = [F.col(k).alias(f"_k_{k}") for k in keys]
    s = sites.select(*own, "contig", "source_dir", F.when(plus, F.col("start") - near).otherwise(F.col("start") - far).alias("start"), F.when(plus, F.col("start") + far).otherwise(F.col("end") + near).alias("end")).where("start >= 0")
    pairs = interval_join(s, ranked.select("contig", "start", "end", "strand", "_n"), width=far)
    ok = pairs.where((plus & minus) | (~plus & (F.col("strand") == "+")))
    g = ok.groupBy(*[f"_k_{k}" for k in keys]).agg(F.min("_n").alias("_n")).join(ranked.select("_n", F.col("name").alias("source")), "_n")
    return sites.join(g.select(*[F.col(f"_k_{k}").alias(k) for k in keys], "source"), list(keys), "left")


def near_insertion_site(alignments: DataFrame, sites: DataFrame, keys: Sequence[str], margin: int = 5000) -> DataFrame:
    """The last insertion site within the margin of each primary alignment."""
    s = sites.select("contig", F.greatest(F.col("start") - margin, F.lit(0)).alias("start"), (F.col("end") + margin).alias("end"), "site", "ord")
    own = alignments.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "contig", "start", "end")
    hit = interval_join(own, s, width=margin).groupBy(*[f"_k_{k}" for k in keys]).agg(F.max_by("site", "ord").alias("site"))
    return alignments.join(hit.select(*[F.col(f"_k_{k}").alias(k) for k in keys], "site"), list(keys), "left")


def supplementary_near_primary(primary: DataFrame, supplementary: DataFrame, margin: int = 5000, same_contig: bool = False) -> DataFrame:
    """Supplementary alignments of a read near its primary; the contig is compared only if asked for.

    One near primary suffices, so the surroundings of a read's primaries are united first and an alignment meets few of
    them, however many primaries share its read.
    """
    by = ["read", "contig"] if same_contig else ["read"]
    known = " and ".join(f"{c} is not null" for c in by)
    # Ends count as near: spans have one base more.
    around = primary.where(known).select(F.struct(*by).alias("_group"), (F.col("start") - margin).alias("start"), (F.col("end") + margin + 1).alias("end"))
    own = supplementary.where(known).distinct().withColumns({"_group": F.struct(*by), "_from": F.col("start"), "_to": F.col("end") + 1})
    # Unions are apart and longer than twice the margin, so a bin holds few and the axis bounds their bins.
    pairs = interval_join(own, merge_intervals(around, ["_group"]), width=max(10 * margin, 1000), on="_group", left_span=("_from", "_to"), long=False)
    return pairs.select(*supplementary.columns).distinct()


def end_alignments(alignments: DataFrame, poly: DataFrame) -> DataFrame:
    """For each insert and slot the alignment at its polyT or polyA end: insert_key, slot, contig, start, end, strand, poly.

    alignments: insert_key, hap (1 or 2), contig, start, end, strand, q_start, q_end, ord (the primary first). poly:
    insert_key, poly. polyT takes the least q_start, polyA the largest q_end, the first on ties and without a tail: by ord, and where that ties too by contig, start, end and strand.
    An insert aligned to one haplotype alone has it in slot 1.
    """
    a = alignments.join(poly.select("insert_key", "poly"), "insert_key", "left")
    order = F.struct(F.when(F.col("poly") == "polyT", F.col("q_start")).when(F.col("poly") == "polyA", -F.col("q_end")).otherwise(F.lit(0)).alias("at"), "ord", "contig", "start", "end", "strand")
    best = a.groupBy("insert_key", "hap").agg(F.min_by(F.struct("contig", "start", "end", "strand", "poly"), order).alias("b"))
    return best.select("insert_key", F.row_number().over(Window.partitionBy("insert_key").orderBy("hap")).alias("slot"), "b.*")


def transduction_sources(alignments: DataFrame, poly: DataFrame, elements: DataFrame) -> DataFrame:
    """insert_key, source_1 and source_2, and whether the slots' directions disagree, which gives no source.

    A tail at the end where the alignment leaves decides the direction: + for polyT on + and polyA on -, else -.
    """
    tail = ((F.col("strand") == "+") & (F.col("poly") == "polyT")) | ((F.col("strand") == "-") & (F.col("poly") == "polyA"))
    ends = end_alignments(alignments, poly).withColumn("source_dir", F.when(tail, "+").otherwise("-"))
    ways = ends.groupBy("insert_key").agg((F.min("source_dir") != F.max("source_dir")).alias("discordant"))
    agreed = ends.join(ways, "insert_key").where(F.col("poly").isNotNull() & ~F.col("discordant"))
    found = nearest_source_l1(agreed, elements, ["insert_key", "slot"]).groupBy("insert_key").agg(*[F.max(F.when(F.col("slot") == k, F.col("source"))).alias(f"source_{k}") for k in (1, 2)])
    return ways.join(found, "insert_key", "left")


def transduction_class(repeat_class: Column, source_1: Column, source_2: Column, l1_ratio: Column) -> tuple[Column, Column]:
    """Solo, Orphan or Partnered for each slot: a source tells by the L1 ratio; without one slot 2 takes slot 1's class."""
    solo = F.when(repeat_class.endswith("LINE1"), "Solo")
    known = F.when(F.coalesce(l1_ratio, F.lit(0.0)) < 0.01, "Orphan").otherwise("Partnered")
    first = F.when(source_1.isNotNull(), known).otherwise(solo)
    return first, F.when(source_2.isNotNull(), known).otherwise(first)


def insertion_type(class_1: Column, class_2: Column, repeat_class: Column, pseudogene: Column) -> Column:
    """Orphan_L1, Partnered_L1, Solo_L1, Alu, SVA or PSD, in this priority over both slots; null for none."""
    either = lambda x: (class_1 == x) | (class_2 == x)
    return F.when(either("Orphan"), "Orphan_L1").when(either("Partnered"), "Partnered_L1").when(either("Solo"), "Solo_L1").when(repeat_class == "Alu", "Alu").when(repeat_class == "SVA", "SVA").when(pseudogene.isNotNull(), "PSD")


def union_keys(parts: Sequence[DataFrame], key: str = "insert_key", defaults: dict | None = None) -> DataFrame:
    """Full outer join of partial results with defaults for what is missing."""
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, key, "full")
    return out.na.fill(defaults) if defaults else out


def target_site_duplication(inserts: DataFrame, arm: int = 20, penalty: int = 8, offset: int = 2, least: int = 5, identity: float = 0.8) -> DataFrame:
    """The best duplicated target site of each insert: insert_key, tsd_len, side.

    inserts: insert_key, seq, right (the bases after the second break end), left (those before the first, reversed and
    complemented) and seq_rc. A site is an alignment of both that begins within `offset` bases of both, has `least` equal bases, the
    identity and a score of `least` by +1 for equal bases and -penalty for others and for each base of a gap; the best scores
    most, then is on the right, then ends first, then is the longer. Banded dynamic programming over the bases of the arm, side
    by side for the rows of a batch; the band holds every alignment that can score `least`.
    """
    reach = offset + (arm - least) // penalty
    text = lambda seq, ref, n: F.substring(F.coalesce(F.col(seq), F.lit("")), 1, n).alias(ref)
    rows = inserts.select("insert_key", text("seq", "a1", arm), text("right", "b1", arm + reach), text("seq_rc", "a0", arm), text("left", "b0", arm + reach))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right, left = (_best_sites(_codes(batch[f"a{k}"], arm, -1), _codes(batch[f"b{k}"], arm + reach, -2), reach, penalty, offset, least, identity) for k in (1, 0))
            on_right = right >> 16 >= left >> 16  # the score decides, then the side
            best = np.where(on_right, right, left)
            columns = [batch["insert_key"], pa.array((best & 255).astype(np.int32)), pa.array(np.where(on_right, "right", "left").astype(object), pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["insert_key", "tsd_len", "side"]).filter(pa.array(best > 0))

    kind = rows.schema["insert_key"].dataType.simpleString()
    return rows.mapInArrow(run, f"insert_key {kind}, tsd_len int, side string")


def _codes(texts: pa.Array, width: int, none: int) -> np.ndarray:
    """Code points of texts of up to `width` characters, a row for each place; `none` behind their end."""
    out = np.full((len(texts), width), none, np.int32)
    for k, t in enumerate(texts.to_pylist()):
        out[k, : len(t)] = np.frombuffer(t.encode("utf-32-le"), np.int32)
    return np.ascontiguousarray(out.T)


def _best_sites(a: np.ndarray, b: np.ndarray, reach: int, penalty: int, offset: int, least: int, identity: float) -> np.ndarray:
    """The best site of each column as score * 2^16 + bases of the arm behind its end * 2^8 + columns, 0 for none."""
    unit, never = 64, np.int32(-(1 << 24))  # a cell is score * 64 + columns, so the greater score wins and then the longer
    off = 1 - penalty * unit
    arm, rows = a.shape
    best = np.zeros(rows, np.int64)
    cells = [np.full(rows, never, np.int32)] * (2 * reach + 1)
    for i in range(arm):
        row: list[np.ndarray] = []
        for at, j in enumerate(range(i - reach, i + reach + 1)):
            if not 0 <= j < len(b):
                row.append(np.full(rows, never, np.int32))
                continue
            before = np.maximum(cells[at], 0) if i <= offset and j <= offset else cells[at]
            cell = before + np.where(a[i] == b[j], np.int32(unit + 1), np.int32(off))
            if at + 1 < len(cells):
                cell = np.maximum(cell, cells[at + 1] + off)
            if row:
                cell = np.maximum(cell, row[-1] + off)
            cell = np.where(b[j] >= 0, np.maximum(cell, never), never)
            row.append(cell)
            n, score = cell & (unit - 1), cell >> 6
            same = n - (n - score) / (penalty + 1)
            found = (score >= least) & (same >= least) & (same >= identity * n) & (a[i] >= 0)
            best = np.where(found, np.maximum(best, (score.astype(np.int64) << 16) + (arm - 1 - i << 8) + n), best)
        cells = row
    return best


def flank_repeat_score(inserts: DataFrame, k: int = 11) -> DataFrame:
    """How much of each insert its flanks hold, and how repetitive it is: what decide_array_change() asks for.

    inserts: sv_id, seq, left, right. flank_coverage is the share of the insert's k-mers that its better flank holds
    (best_flank, left on ties); self_repeat and self_period are of the whole insert, flank_self_repeat is of the stretch
    between the first and the last of those k-mers.
    """
    ins = inserts.select("sv_id", F.posexplode(kmers(F.col("seq"), k)).alias("at", "kmer"))
    total = ins.groupBy("sv_id").agg(F.count_distinct("kmer").alias("total"))
    flanks = inserts.select("sv_id", F.inline(F.array(*[F.struct(F.lit(s).alias("flank"), F.col(s).alias("s")) for s in ("left", "right")])))
    fk = flanks.select("sv_id", "flank", F.explode(F.array_distinct(kmers(F.col("s"), k))).alias("kmer"))
    hit = ins.join(fk, ["sv_id", "kmer"]).groupBy("sv_id", "flank").agg(F.count_distinct("kmer").alias("h"), F.min("at").alias("first"), F.max("at").alias("last")).join(total, "sv_id")
    best = hit.groupBy("sv_id").agg(F.max(F.struct((F.col("h") / F.col("total")).alias("share"), (F.col("flank") == "left").alias("is_left"), "first", "last")).alias("b"))
    j = inserts.select("sv_id", "seq").join(best, "sv_id", "left")
    whole, part = self_repeat(F.col("seq")), self_repeat(F.substring(F.col("seq"), F.col("b.first") + 1, F.col("b.last") - F.col("b.first") + k))
    return j.select(
        "sv_id", F.length("seq").alias("ins_len"), F.coalesce("b.share", F.lit(0.0)).alias("flank_coverage"), F.when(F.col("b").isNotNull(), F.when(F.col("b.is_left"), "left").otherwise("right")).alias("best_flank"),
        whole["share"].alias("self_repeat"), whole["period"].alias("self_period"), F.coalesce(part["share"], F.lit(0.0)).alias("flank_self_repeat"),
    )


def insertion_evidence(svs: DataFrame, composition: DataFrame, alignments: DataFrame, elements: DataFrame, tsd: DataFrame, pseudogenes: DataFrame) -> DataFrame:
    """Insertions with their type and evidence by the seven-part key; what no part knows is null, and so is the type.

    composition is of repeat_composition(), tsd of target_site_duplication() and pseudogenes of best_pseudogene();
    alignments are as end_alignments() takes them, elements as nearest_source_l1() does.
    """
    rows = min_insert_len(svs).withColumn("poly", poly_at(F.col("inserted")))
    sources = transduction_sources(alignments, rows.select("insert_key", "poly").distinct(), elements)
    parts = union_keys([composition, sources, tsd, pseudogenes.select("insert_key", "transcript", "match_ratio", "n_exons")])
    out = rows.join(parts.withColumn("_known", F.lit(True)), "insert_key", "left")
    first, second = transduction_class(F.col("repeat_class"), F.col("source_1"), F.col("source_2"), F.col("l1_ratio"))
    out = out.withColumns({"class_1": first, "class_2": second})
    inversion = F.coalesce(*[F.when(F.col("repeat_class").startswith(x), x) for x in ("Simple", "Inverted", "Other")], F.when(F.col("_known"), "NA"))
    return out.withColumns({"insert_type": insertion_type(F.col("class_1"), F.col("class_2"), F.col("repeat_class"), F.col("transcript")), "is_inversion": inversion}).drop("_known")
