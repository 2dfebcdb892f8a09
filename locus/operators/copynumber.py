"""Depth windows, their axis, normalisation, ploidy and copy numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .checkpoints import checkpointed, stored
from .density import bin_level, segment_level
from .intervals import interval_join, subtract_intervals, tiles
from .segmentation import segment

WINDOW = 50_000
#: Thresholds of the copy-number steps. Fixed values.
MIN_NORMAL, MIN_TUMOR = 100_000, 10_000


def tile_windows(reftable: DataFrame, size: int = WINDOW) -> DataFrame:
    """Strand-aware windows of the reference table's contig spans: contig, start, end, chrom, k (place along the chromosome)."""
    t = reftable.select("contig", "chrom", "strand", "r_start", "r_end", F.posexplode(tiles(F.col("c_start"), F.col("c_end"), size, F.col("strand"))).alias("k", "w"))
    return t.select("contig", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "chrom", "strand", "r_start", "k")


def window_depth_sum(windows: DataFrame, blocks: DataFrame, name: str = "depth", min_mapq: int = 40) -> DataFrame:
    """Bases of blocks with the mapping quality in each window; windows without any have 0."""
    pairs = interval_join(windows.select("contig", "start", "end"), blocks.where(F.col("mapq") >= min_mapq).select("contig", "start", "end"), width=WINDOW, long=False)
    sums = pairs.groupBy("contig", "start", "end").agg(F.sum(F.least("end", "r_end") - F.greatest("start", "r_start")).alias(name))
    return windows.join(sums, ["contig", "start", "end"], "left").withColumn(name, F.coalesce(name, F.lit(0)))


def mean_to_sum(mean: Column, length: Column) -> Column:
    """The sum that a window's mean came from, half to even, 0 for none."""
    return F.coalesce(F.bround(mean * length), F.lit(0.0)).cast("bigint")


def window_depths(windows: DataFrame, blocks: DataFrame, by: Sequence[str], name: str = "depth", min_mapq: int = 40) -> DataFrame:
    """window_depth_sum() for every sample of the blocks (column `by`, one at most); windows without any have 0."""
    if not by:
        return window_depth_sum(windows, blocks, name, min_mapq)
    (sample,) = by
    known = blocks.agg(F.array_sort(F.collect_set(sample)).alias("_all"))  # one row
    grid = windows.join(F.broadcast(known)).select("*", F.explode("_all").alias(sample)).drop("_all")
    pairs = interval_join(windows.select("contig", "start", "end"), blocks.where(F.col("mapq") >= min_mapq).select("contig", "start", "end", sample), width=WINDOW, long=False)
    key = [sample, "contig", "start", "end"]
    sums = pairs.groupBy(*key).agg(F.sum(F.least("end", "r_end") - F.greatest("start", "r_start")).alias(name))
    return grid.join(sums, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def window_index(reftable: DataFrame, size: int = WINDOW, by: Sequence[str] = ()) -> DataFrame:
    """Rows with axis_start, their fractional window index: gaps before them over the size plus windows emitted before.

    Order within a chromosome is (r_start, ord); the first row starts at r_start / size, a later one moves by the gap to
    the row before it, which may be negative. `by` names the columns that tell assemblies apart.
    """
    w = Window.partitionBy(*by, "chrom").orderBy("r_start", "ord")
    gap = F.col("r_start") - F.coalesce(F.lag("r_end").over(w), F.lit(0))
    n = F.ceil((F.col("c_end") - F.col("c_start")) / size)
    rows = reftable.withColumns({"_g": gap, "_n": n})
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("axis_start", F.sum("_g").over(w.rowsBetween(Window.unboundedPreceding, 0)) / size + F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumnRenamed("_n", "n_windows").drop("_g")


def assembly_gaps(reftable: DataFrame, min_bins: float = 5.0, size: int = WINDOW, by: Sequence[str] = ()) -> DataFrame:
    """Spans of the window axis between rows: (by, chrom, start, end) of more than `min_bins`."""
    a = window_index(reftable, size, by)
    w = Window.partitionBy(*by, "chrom").orderBy("r_start", "ord")
    low = F.lag(F.col("axis_start") + F.col("n_windows")).over(w) - 1
    return a.select(*by, "chrom", low.alias("start"), F.col("axis_start").alias("end")).where(F.col("end") - F.col("start") > min_bins)


def plot_axis_layout(reftable: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows with axis_bp: gaps below zero count as none and lengths are in bases."""
    w = Window.partitionBy(*by, "chrom").orderBy("r_start", "ord")
    gap = F.greatest(F.col("r_start") - F.coalesce(F.lag("r_end").over(w), F.lit(0)), F.lit(0))
    rows = reftable.withColumns({"_g": gap, "_n": F.col("c_end") - F.col("c_start")})
    before = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("axis_bp", F.sum("_g").over(w.rowsBetween(Window.unboundedPreceding, 0)) + before).drop("_g", "_n")


def chrom_offsets(lengths: DataFrame) -> DataFrame:
    """offset, midpoint and boundary of chromosomes in the order 1..22, X, Y (one row per chromosome)."""
    name = F.regexp_replace(F.col("chrom").cast("string"), "^chr", "")
    place = F.when(name == "X", 23).when(name == "Y", 24).otherwise(name.try_cast("int"))
    w = Window.orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
    out = lengths.withColumn("_o", place).where(F.col("_o").isNotNull()).withColumn("offset", F.coalesce(F.sum("length").over(w), F.lit(0)))
    return out.withColumns({"midpoint": F.col("offset") + F.col("length") / 2, "boundary": F.col("offset") + F.col("length")}).drop("_o")


def chrom_extent(a: DataFrame, b: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The largest window index of each chromosome over both haplotypes."""
    return a.select(*by, "chrom", "window_index").unionByName(b.select(*by, "chrom", "window_index")).groupBy(*by, "chrom").agg(F.max("window_index").alias("extent"))


def median_bp_per_bin(ends: DataFrame) -> DataFrame:
    """Median over chromosomes 1 to 22 of r_end / bins."""
    auto = F.regexp_replace(F.col("chrom").cast("string"), "^chr", "").try_cast("int").between(1, 22)
    return ends.where(auto).agg(F.median(F.col("r_end") / F.col("bins")).alias("bp_per_bin"))


def rolling_mean(df: DataFrame, value: str = "ratio", by: Sequence[str] = ("chrom",), order: str = "window_index", around: int = 3) -> DataFrame:
    """Centred mean over complete frames; edges are dropped."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-around, around)
    return df.withColumns({"rolled": F.avg(value).over(w), "_n": F.count(value).over(w)}).where(F.col("_n") == 2 * around + 1).drop("_n")


def depth_totals(df: DataFrame, by: list[str]) -> DataFrame:
    """Sums over windows with enough normal depth, their count, and the count with enough tumour depth."""
    ok = F.col("normal_depth") > MIN_NORMAL
    return df.groupBy(*by).agg(F.sum(F.when(ok, F.col("normal_depth"))).alias("normal_sum"), F.sum(F.when(ok, F.col("tumor_depth"))).alias("tumor_sum"), F.count(F.when(ok, 1)).alias("normal_rows"), F.count(F.when(ok & (F.col("tumor_depth") > MIN_TUMOR), 1)).alias("tumor_rows"))


def depth_ratio(df: DataFrame, totals: DataFrame, by: list[str], ploidy: Column | float = 2.0) -> DataFrame:
    """Windows with ratio = t/n * N/T * tumor_rows * ploidy / normal_rows; unusable windows are dropped."""
    out = df.join(totals, by).where(F.col("normal_depth") > MIN_NORMAL)
    p = ploidy if isinstance(ploidy, Column) else F.lit(ploidy)
    ratio = F.try_divide("tumor_depth", "normal_depth") * F.try_divide("normal_sum", "tumor_sum") * F.col("tumor_rows") * p / F.col("normal_rows")
    return out.withColumn("ratio", ratio).where(F.col("ratio").isNotNull()).select(*df.columns, "ratio")


def winsorised(ratio: Column, mu: Column | float = 1.0, top: float = 20.0) -> Column:
    return F.least(ratio / (mu if isinstance(mu, Column) else F.lit(mu)), F.lit(top))


def mode_value(df: DataFrame, by: list[str], value: str = "ratio", width: float = 0.05) -> DataFrame:
    """The middle of the fullest bin, the lowest on ties."""
    b = df.groupBy(*by, F.floor(F.col(value) / width).alias("_b")).count()
    return b.groupBy(*by).agg(F.max_by((F.col("_b") + 0.5) * width, F.struct("count", -F.col("_b"))).alias("mode"))


def half_window_ploidy(segments: DataFrame, by: list[str], baseline: str = "level", cutoff: float = 0.09) -> DataFrame:
    """Copies at the baseline, 1, 2, 4 or 8: while the share of length in (0.40, 0.60) of the baseline is over the cutoff, halve it.

    Segments need mean, n_marks and the baseline; means that are not finite or at most 0.05 do not count.
    """
    s = segments.where((F.col("mean") > 0.05) & ~F.isnan("mean") & (F.col("mean") < float("inf")))
    share = [F.sum(F.when((F.col("mean") > 0.4 * F.col(baseline) / 2**k) & (F.col("mean") < 0.6 * F.col(baseline) / 2**k), F.col("n_marks")).otherwise(0)) / F.sum("n_marks") for k in range(3)]
    h = s.groupBy(*by).agg(*[x.alias(f"_h{k}") for k, x in enumerate(share)])
    times = F.when(F.col("_h0") <= cutoff, 0).when(F.col("_h1") <= cutoff, 1).when(F.col("_h2") <= cutoff, 2).otherwise(3)
    return h.select(*by, F.pow(F.lit(2), times).cast("int").alias("ploidy"))


def smooth_outliers(df: DataFrame, by: list[str], value: str = "ratio", order: str = "window_index", around: int = 10, limit: float = 4.0, pull: float = 2.0) -> DataFrame:
    """Points beyond all neighbours by more than `limit` deviations come to the neighbours' median and `pull` of them."""
    w = Window.partitionBy(*by).orderBy(order)
    beside = lambda a, b: F.collect_list(value).over(w.rowsBetween(a, b))
    sd = F.stddev(value).over(Window.partitionBy(*by))
    out = df.withColumns({"_near": F.concat(beside(-around, -1), beside(1, around)), "_sd": sd})
    middle = F.expr("sort_array(_near)[cast(size(_near) / 2 as int)]")
    high, low = F.col(value) > F.array_max("_near") + limit * F.col("_sd"), F.col(value) < F.array_min("_near") - limit * F.col("_sd")
    smooth = F.when(F.size("_near") == 0, F.col(value)).when(high, middle + pull * F.col("_sd")).when(low, middle - pull * F.col("_sd")).otherwise(F.col(value))
    return out.withColumn("smoothed", smooth).drop("_near", "_sd")


def trimmed_sd(df: DataFrame, by: list[str], value: str = "smoothed", order: str = "window_index", trim: float = 0.025, inside: Sequence[str] = ()) -> DataFrame:
    """Deviation of neighbours' differences over sqrt(2), without the outer `trim` on both sides.

    One value for `by`; neighbours are those within `inside`, such as a chromosome.
    """
    d = df.withColumn("_d", F.col(value) - F.lag(value).over(Window.partitionBy(*by, *inside).orderBy(order))).where("_d is not null")
    cut = d.groupBy(*by).agg(F.percentile("_d", F.array(F.lit(trim), F.lit(1 - trim))).alias("_q"))
    return d.join(cut, by).where((F.col("_d") >= F.get("_q", F.lit(0))) & (F.col("_d") <= F.get("_q", F.lit(1)))).groupBy(*by).agg((F.stddev("_d") / 2**0.5).alias("sd"))


def segment_means(segments: DataFrame, windows: DataFrame, by: list[str], value: str = "ratio", order: str = "window_index") -> DataFrame:
    """Segments with the mean of the uncapped values inside, four decimals. Both meet in bins of 1000 windows."""
    bin_ = lambda c: F.floor(F.col(c) / 1000)
    s = segments.select(*by, "start", "end", "n_marks", F.explode(F.sequence(bin_("start"), bin_("end"))).alias("_bin"))
    hit = windows.withColumn("_bin", bin_(order)).join(s, [*by, "_bin"]).where((F.col(order) >= F.col("start")) & (F.col(order) <= F.col("end")))
    return hit.groupBy(*by, "start", "end", "n_marks").agg(F.round(F.avg(value), 4).alias("mean"))


def split_gaps(segments: DataFrame, gaps: DataFrame, by: list[str]) -> DataFrame:
    """Segments without the assembly gaps of their chromosome; pieces keep marks and mean."""
    axis = F.concat_ws("\x01", *[F.col(c).cast("string") for c in by if c in gaps.columns])
    keyed = segments.withColumn("contig", axis)
    # The index counts windows, so the bins of the join are windows too.
    return subtract_intervals(keyed, gaps.select(axis.alias("contig"), "start", "end"), [*by, "start", "end"]).drop("contig")


def call_copy_number(df: DataFrame, ploidy: float | DataFrame | None = None) -> DataFrame:
    """Windows (sample, hap, chrom, window_index, tumor_depth, normal_depth) to segments in copies.

    A first pass segments the raw ratio, with a plain undo, and gives the level L and the ploidy of each sample and
    haplotype, unless it is set: for all by a number, or by a table (sample, hap, ploidy) for those in it. One copy is
    the highest peak of the windows' ratios over the ploidy, or L over the ploidy where there is no peak. A second pass segments
    copies, capped at 20; its means are those of uncapped values. Columns: sample, hap, chrom, start, end, n_marks,
    mean, ploidy, level.

    No sample or haplotype is dropped: where the depths give no ratio, or the ratios no level, each of its chromosomes is one row with a null mean.
    """
    by, chrom = ["sample", "hap"], ["sample", "hap", "chrom"]
    df = stored(df.select(*chrom, "window_index", "tumor_depth", "normal_depth"))  # totals, ratios and the spans at the end read it
    ratio = checkpointed(depth_ratio(df, depth_totals(df, by), by, 1.0).select(*chrom, "window_index", "ratio"))
    smooth = checkpointed(smooth_outliers(ratio, chrom))  # four steps read it
    first = checkpointed(segment(smooth, chrom, trimmed_sd(smooth, by, inside=["chrom"]), plain=True))
    level = segment_level(first, by, ["chrom", "start"]).join(bin_level(ratio, by), by, "left")
    found = half_window_ploidy(first.join(level, by), by).withColumnRenamed("ploidy", "_found")
    scale = level.join(found, by, "left")
    chosen = F.coalesce(F.col("_found"), F.lit(1)).cast("double")
    if isinstance(ploidy, DataFrame):
        scale = scale.join(ploidy.select(*by, F.col("ploidy").cast("double").alias("_set")), by, "left")
        chosen = F.coalesce("_set", chosen)
    elif ploidy is not None:
        chosen = F.lit(float(ploidy))
    scale = checkpointed(scale.select(*by, chosen.alias("ploidy"), F.coalesce("bin_level", "level").alias("level")))
    copies = ratio.join(scale, by).where("level is not null").withColumn("ratio", F.col("ratio") / F.col("level") * F.col("ploidy")).drop("level", "ploidy")
    capped = checkpointed(smooth_outliers(copies.withColumn("capped", F.least("ratio", F.lit(20.0))), chrom, "capped"))
    called = segment_means(segment(capped, chrom, trimmed_sd(capped, by, inside=["chrom"])), copies, chrom).join(scale, by)
    usable_ = F.count(F.when(F.col("normal_depth") > MIN_NORMAL, 1))
    spans = df.groupBy(*chrom).agg(F.min("window_index").cast("double").alias("start"), F.max("window_index").cast("double").alias("end"), usable_.alias("n_marks"))
    without = spans.join(scale.where("level is not null").select(*by), by, "left_anti").join(scale, by, "left")
    return called.unionByName(without.select(*chrom, "start", "end", "n_marks", F.lit(None).cast("double").alias("mean"), "ploidy", "level"))


def leading_inter_trailing_gaps(segments: DataFrame, extents: DataFrame, inner: float = 5.0, trailing: float = 20.0, by: Sequence[str] = ()) -> DataFrame:
    """Spans of a chromosome that no segment covers: before, between and after; whole chromosomes without segments."""
    key = [*by, "chrom"]
    w = Window.partitionBy(*key).orderBy("start", "end")
    s = segments.select(*key, "start", "end").withColumns({"_p": F.lag("end").over(w), "_n": F.lead("start").over(w)})
    before = s.select(*key, F.coalesce("_p", F.lit(0.0)).alias("start"), F.col("start").alias("end")).where(F.col("end") - F.col("start") > inner)
    after = s.where("_n is null").join(extents, key).select(*key, F.col("end").alias("start"), F.col("extent").alias("end")).where(F.col("end") - F.col("start") > trailing)
    whole = extents.join(segments.select(*key).distinct(), key, "left_anti").select(*key, F.lit(0.0).alias("start"), F.col("extent").alias("end"))
    return before.unionByName(after).unionByName(whole)


def place_annotation_on_axis(annotation: DataFrame, rows: DataFrame, size: int = WINDOW) -> DataFrame:
    """Annotation clipped to the mapped span of its contig, in axis windows by strand: rows have axis_start.

    Placed rows grow with the assembly and stand in several bins each, so they are shuffled however small their files are.
    """
    pairs = interval_join(annotation, rows.select("contig", F.col("c_start").alias("start"), F.col("c_end").alias("end"), "strand", "chrom", "axis_start").hint("merge"), width=WINDOW)
    a, b = F.greatest("start", "r_start"), F.least("end", "r_end")
    minus = F.col("strand") == "-"
    lo = F.when(minus, F.col("r_end") - b).otherwise(a - F.col("r_start")) / size
    hi = F.when(minus, F.col("r_end") - a).otherwise(b - F.col("r_start")) / size
    return pairs.select(*[F.col(c) for c in annotation.columns if c not in ("start", "end")], "chrom", (F.col("axis_start") + lo).alias("axis_lo"), (F.col("axis_start") + hi).alias("axis_hi"))


def gap_fill_annotation(gaps: DataFrame, track: DataFrame) -> DataFrame:
    """A reference track inside each gap, mapped linearly to the gap's axis span; ct entries are left out.

    gaps: contig, start, end (reference), axis_lo, axis_hi. track: contig, start, end, name.
    """
    pairs = interval_join(gaps, track.where(~F.col("name").startswith("ct")), width=WINDOW)
    scale = (F.col("axis_hi") - F.col("axis_lo")) / (F.col("end") - F.col("start"))
    place = lambda x: F.col("axis_lo") + (x - F.col("start")) * scale
    return pairs.select("contig", "name", place(F.greatest("start", "r_start")).alias("lo"), place(F.least("end", "r_end")).alias("hi"))


def terminal_extent(extents: list[DataFrame], reference: DataFrame, size: int = WINDOW) -> DataFrame:
    """The largest extent of each chromosome over haplotypes and the reference length in windows."""
    out = reference.select("chrom", (F.col("length") / size).alias("extent"))
    for e in extents:
        out = out.unionByName(e.select("chrom", F.col("extent").cast("double").alias("extent")))
    return out.groupBy("chrom").agg(F.max("extent").alias("extent"))
