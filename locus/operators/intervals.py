"""Interval joins and algebra over (contig, start, end), 0-based and half-open.

A range predicate alone would be planned as a nested loop. Intervals are cut into bins and joined on (contig, bin), which is
a hash or sort-merge join that Spark can split on skewed bins; the pair is kept in one bin only. Bins are nested: an interval's
own length says how wide its bins are, so it is cut into few pieces whatever its length, and nothing is looked up before
the join is planned. Orders along a contig are taken inside tiles, into which long intervals are cut.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Nested bins: each level's are WIDER times as wide, and an interval takes the first level where it touches some MOST_BINS at most.
WIDER, LEVELS, MOST_BINS = 32, 4, 16
#: Bases of a tile.
TILE = 1 << 22


def bins(start: Column, end: Column, width: int | Column) -> Column:
    """All bins that [start, end) touches; an empty interval touches that of its start."""
    first = F.floor(start / width)
    return F.sequence(first, F.greatest(first, F.ceil(end / width) - 1))


def level(start: Column, end: Column, width: int) -> Column:
    """The level of an interval's bins, by its length; the last one takes all that are longer."""
    out = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        out = F.when(end - start <= MOST_BINS * width * WIDER**k, k).otherwise(out)
    return out


def wide(at: Column, width: int) -> Column:
    """Width of a level's bins."""
    return F.element_at(F.array(*[F.lit(width * WIDER**i) for i in range(LEVELS)]), at + 1)


def interval_join(left: DataFrame, right: DataFrame, width: int = 500, on: str = "contig", left_span: tuple[str, str] = ("start", "end"), right_span: tuple[str, str] = ("start", "end"), long: bool = True, both: bool = False) -> DataFrame:
    """Pairs of rows whose intervals overlap on the same contig, each once.

    Right columns that the left side has too come out with the prefix r_. Rows with a null contig or span, or with no
    partner, are left out; first_match() and the flags below join back to the left side. A right row stands in the bins of
    its own level, a left row asks in those of every level that the right side has, which one broadcast row lists: one
    exchange for each side, and no look at the data before the plan. The left side's intervals should be short; with
    `both` they may be long too, and then each side stands at its own level and those above. Without `long` the right ones
    are taken to be short and have bins of `width` whatever their length.
    """
    (ls, le), (rs, re) = left_span, right_span
    # Names are moved out of the way, so both sides may share them.
    r = right.select(F.col(on).alias("_rc"), *[F.col(f"`{c}`").alias(f"_r_{c}") for c in right.columns if c != on])
    l0, l1, r0, r1 = F.col(f"`{ls}`"), F.col(f"`{le}`"), F.col(f"_r_{rs}"), F.col(f"_r_{re}")
    meets = (F.col(on) == F.col("_rc")) & (r0 < l1) & (r1 > l0)
    if not long:
        far = r.withColumn("_bin", F.explode(bins(r0, r1, width)))
        near = left.withColumn("_lbin", F.explode(bins(l0, l1, width)))
        # The pair counts in the bin where the later of both begins.
        meets = meets & (F.col("_lbin") == F.col("_bin")) & (F.col("_bin") == F.floor(F.greatest(l0, r0) / width))
    else:
        levels = F.array(*[F.lit(k) for k in range(LEVELS)])
        far = r.withColumn("_rlevel", level(r0, r1, width))
        used = r.agg(F.array_compact(F.array(*[F.max(F.when(level(r0, r1, width) == k, k)) for k in range(LEVELS)])).alias("_used"))  # one row, by a hash aggregate
        far = far.withColumn("_level", F.explode(levels)).where("_level >= _rlevel") if both else far.withColumn("_level", F.col("_rlevel"))
        far = far.withColumn("_bin", F.explode(bins(r0, r1, wide(F.col("_level"), width))))
        near = left.withColumn("_llevel", level(l0, l1, width)) if both else left
        near = near.join(F.broadcast(used)).withColumn("_on", F.explode(levels if both else F.col("_used")))
        if both:
            near = near.where((F.col("_on") == F.col("_llevel")) | ((F.col("_on") > F.col("_llevel")) & F.array_contains("_used", F.col("_on"))))
        near = near.withColumn("_lbin", F.explode(bins(l0, l1, wide(F.col("_on"), width))))
        meets = meets & (F.col("_on") == F.col("_level")) & (F.col("_lbin") == F.col("_bin")) & (F.col("_bin") == F.floor(F.greatest(l0, r0) / wide(F.col("_level"), width)))
        if both:
            meets = meets & (F.col("_level") == F.greatest("_llevel", "_rlevel"))
    joined = near.join(far, meets, "inner")
    return joined.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"`_r_{c}`").alias(c if c not in left.columns else f"r_{c}") for c in right.columns if c != on])


def overlap(pairs: DataFrame) -> Column:
    """Length of the overlap of an interval_join of two (start, end) tables."""
    return F.least("end", "r_end") - F.greatest("start", "r_start")


def first_match(pairs: DataFrame, keys: Sequence[str], payload: Sequence[str], start: str = "r_start", order: str = "r_ord", last: bool = False) -> DataFrame:
    """For each key the payload of the match that comes first by (start, order), or last."""
    pick = F.max_by if last else F.min_by
    row = pick(F.struct(*[F.col(c) for c in payload]), F.struct(F.col(start), F.col(order)))
    return pairs.groupBy(*keys).agg(row.alias("_m")).select(*keys, *[F.col(f"_m.`{c}`").alias(c) for c in payload])


def first_containing(left: DataFrame, right: DataFrame, keys: Sequence[str], payload: Sequence[str], width: int = 500) -> DataFrame:
    """left with the payload of the first right interval that contains it, null without one.

    right has (contig, start, end, ord, payload); keys identify rows of left.
    """
    probe = left.select(*dict.fromkeys([*keys, "contig", "start", "end"]))  # whole rows move once, to meet their match
    pairs = interval_join(probe, right, width=width).where("start >= r_start and end <= r_end")
    names = {c: c if c not in probe.columns else f"r_{c}" for c in payload}
    found = first_match(pairs, keys, list(names.values()), order="ord" if "ord" not in probe.columns else "r_ord")
    return left.join(found.withColumnsRenamed({v: k if k not in left.columns else f"r_{k}" for k, v in names.items()}), list(keys), "left")


def first_containing_each(left: DataFrame, tracks: Mapping[str, tuple[DataFrame, Sequence[str]]], keys: Sequence[str], width: int = 500) -> DataFrame:
    """keys and, for each track by name, a struct of the payload of its first interval that contains the row, null without one.

    All tracks are probed at once: one tagged table, one interval join, one aggregate with a pick for each tag. Tracks have
    (contig, start, end, payload) and an order in ord, if it matters.
    """
    tagged = None
    for name, (track, payload) in tracks.items():
        own = track.select("contig", "start", "end", (F.col("ord") if "ord" in track.columns else F.lit(0)).cast("bigint").alias("_ord"), F.lit(name).alias("_tag"), F.struct(*payload).alias(f"_p_{name}"))
        tagged = own if tagged is None else tagged.unionByName(own, allowMissingColumns=True)
    probe = left.select(*dict.fromkeys([*keys, "contig", "start", "end"]))
    pairs = interval_join(probe, tagged, width=width).where("start >= r_start and end <= r_end")
    picks = [F.min_by(f"_p_{n}", F.when(F.col("_tag") == n, F.struct("r_start", "_ord"))).alias(n) for n in tracks]
    return pairs.groupBy(*keys).agg(*picks)


def first_at_point(left: DataFrame, right: DataFrame, keys: Sequence[str], payload: Sequence[str], pos: str = "pos", width: int = 500) -> DataFrame:
    """As first_containing for points: start <= pos and end > pos."""
    points = left.select(*keys, "contig", F.col(pos).alias("start"), (F.col(pos) + 1).alias("end"))
    names = [c if c not in points.columns else f"r_{c}" for c in payload]
    found = first_match(interval_join(points, right, width=width), keys, names, order="ord")
    return left.join(found, list(keys), "left")


def exists_overlap(left: DataFrame, right: DataFrame, keys: Sequence[str], flag: str, contained: bool = False, width: int = 500) -> DataFrame:
    """left with a boolean: some right interval overlaps it, or contains it."""
    probe = left.select(*dict.fromkeys([*keys, "contig", "start", "end"]))
    pairs = interval_join(probe, right.select("contig", "start", "end"), width=width)
    if contained:
        pairs = pairs.where("start >= r_start and end <= r_end")
    hit = pairs.select(*keys).distinct().withColumn(flag, F.lit(True))
    return left.join(hit, list(keys), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def _tiles_of(start: Column, end: Column, tile: int) -> Column:
    """Tiles that [start, end) touches, in whole bases or fractions."""
    first = F.floor(start / tile)
    return F.sequence(first, F.greatest(first, F.ceil(end / tile) - 1))


def reach_before(df: DataFrame, by: Sequence[str], start: str, end: str, name: str, ties: Sequence[str | Column] = (), gap: int = 0, tile: int = TILE) -> DataFrame:
    """Adds the furthest `end` of the rows before each in order of (start, ties) within `by`, if it comes within `gap` of the row's start; else null or less.

    A window over a whole contig would be one task. Every row stands in all tiles that it reaches, so a tile holds what
    reaches into it from before: one exchange, and no task sees more than a tile.
    """
    tiled = df.withColumn("_tile", F.explode(_tiles_of(F.col(start), F.col(end) + gap + 1, tile)))
    inside = Window.partitionBy(*by, "_tile").orderBy(start, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return tiled.withColumn(name, F.max(end).over(inside)).where(F.col("_tile") == F.floor(F.col(start) / tile)).drop("_tile")


def _unions(df: DataFrame, by: Sequence[str], gap: int) -> DataFrame:
    """Unions of (by, start, end) within each `by`, by one exchange."""
    w = Window.partitionBy(*by).orderBy("start", "end")
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.withColumn("_opens", F.when(before.isNull() | (F.col("start") > before + gap), 1).otherwise(0)).withColumn("_n", F.sum("_opens").over(w))
    return rows.groupBy(*by, "_n").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_n")


def merge_intervals(df: DataFrame, by: Sequence[str] = ("contig",), gap: int = 0, tile: int = TILE) -> DataFrame:
    """Unions of intervals that overlap, abut, or are at most `gap` apart. Rows with a null span are left out.

    Intervals are cut at the tiles' edges and united inside each tile. Unions within `gap` of an edge then meet those of
    other tiles, a few rows for each tile of a contig; the others are final and stay by tile. One scan and two exchanges.
    """
    pieces = df.select(*by, "start", "end", F.explode(_tiles_of(F.col("start"), F.col("end"), tile)).alias("_tile"))
    cut = pieces.select(*by, "_tile", F.greatest(F.col("start"), F.col("_tile") * tile).alias("start"), F.least(F.col("end"), (F.col("_tile") + 1) * tile).alias("end"))
    inner = _unions(cut, [*by, "_tile"], gap)
    outer = (F.col("start") <= F.col("_tile") * tile + gap) | (F.col("end") >= (F.col("_tile") + 1) * tile - gap)
    return _unions(inner.select(*by, F.when(~outer, F.col("_tile")).alias("_tile"), "start", "end"), [*by, "_tile"], gap).select(*by, "start", "end")


def islanded(df: DataFrame, by: Sequence[str] = ("contig",), gap: int = 0, name: str = "island", span: tuple[str, str] = ("start", "end"), tile: int = TILE) -> DataFrame:
    """Adds the start of each row's island: the rows whose spans overlap, abut, or are at most `gap` apart.

    Islands are unions, which stand in every tile that they reach; a row takes the last one that begins at or before it in its tile.
    """
    start, end = span
    spans = merge_intervals(df.select(*by, F.col(start).alias("start"), F.col(end).alias("end")), by, gap, tile)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    starts = spans.select(*by, F.explode(_tiles_of(F.col("start"), F.col("end") + 1, tile)).alias("_tile"), F.col("start").alias("_at"), F.col("start").alias("_island"), F.lit(None).cast(df.select(row.alias("r")).schema["r"].dataType).alias("_row"))
    rows = df.select(*by, F.floor(F.col(start) / tile).alias("_tile"), F.col(start).alias("_at"), F.lit(None).cast(starts.schema["_island"].dataType).alias("_island"), row.alias("_row"))
    w = Window.partitionBy(*by, "_tile").orderBy("_at", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    return starts.unionByName(rows).withColumn("_last", F.last("_island", ignorenulls=True).over(w)).where("_row is not null").select("_row.*", F.col("_last").alias(name))


def union_of_spans(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps that cover the same places: a helper for grouped functions."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def subtract_intervals(df: DataFrame, gaps: DataFrame, keys: Sequence[str], width: int = 500) -> DataFrame:
    """Pieces of each row outside the gaps, in whole bases or in fractions of an axis; every piece keeps its row's other columns."""
    merged = merge_intervals(gaps)
    pairs = interval_join(df, merged, width=width).select(*keys, F.col("r_start").alias("gs"), F.col("r_end").alias("ge"))
    cuts = pairs.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("gs", "ge"))).alias("_cuts"))
    rows = df.join(cuts, list(keys), "left")
    kind = "double" if "double" in (df.schema["start"].dataType.typeName(), gaps.schema["start"].dataType.typeName()) else "bigint"
    spans = f"array<struct<gs:{kind},ge:{kind}>>"
    c = F.coalesce(F.col("_cuts").cast(spans), F.array().cast(spans))
    begins = F.concat(F.array(F.col("start").cast(kind)), F.transform(c, lambda x: x["ge"]))
    ends = F.concat(F.transform(c, lambda x: x["gs"]), F.array(F.col("end").cast(kind)))
    pieces = F.filter(F.arrays_zip(begins.alias("s"), ends.alias("e")), lambda x: x["s"] < x["e"])
    out = rows.withColumn("_p", F.explode(pieces))
    return out.select(*[F.col("_p.s").alias("start") if x == "start" else F.col("_p.e").alias("end") if x == "end" else F.col(f"`{x}`") for x in df.columns])


def tiles(start: Column, end: Column, size: int, strand: Column | None = None) -> Column:
    """Windows of [start, end) as array of (start, end); from the right on '-', so that the last is short in both."""
    forward = F.transform(F.sequence(start, end - 1, F.lit(size).cast("bigint")), lambda s: F.struct(s.alias("start"), F.least(s + size, end).alias("end")))
    if strand is None:
        return forward
    backward = F.transform(F.sequence(end, start + 1, F.lit(-size).cast("bigint")), lambda e: F.struct(F.greatest(e - size, start).alias("start"), e.alias("end")))
    return F.when(strand == "-", backward).otherwise(forward)


def padded(df: DataFrame, lengths: DataFrame, pad: int) -> DataFrame:
    """Intervals extended by `pad` within their contig, named contig:start+1-end. lengths: (contig, length)."""
    out = df.join(lengths, "contig")
    out = out.withColumns({"start": F.greatest(F.col("start") - pad, F.lit(0)), "end": F.least(F.col("end") + pad, F.col("length"))}).drop("length")
    return out.withColumn("name", F.concat(F.col("contig").cast("string"), F.lit(":"), (F.col("start") + 1).cast("string"), F.lit("-"), F.col("end").cast("string")))


def flank_window(start: Column, end: Column, length: Column, flank: int = 100, first: int = 1) -> tuple[Column, Column]:
    """max(start - flank, first) and min(end + flank, length); first = 1 keeps the customary lower bound of 1 although the axis counts from 0."""
    return F.greatest(start - flank, F.lit(first)), F.least(end + flank, length)


def extract_sequence(df: DataFrame, chunks: DataFrame, keys: Sequence[str], chunk: int) -> DataFrame:
    """(keys, seq): the stranded sequence of each interval from (contig, chunk_start, seq) rows of `chunk` bases."""
    from locus.functions.seq import reverse_complement

    spans = chunks.select("contig", F.col("chunk_start").alias("start"), (F.col("chunk_start") + F.length("seq")).alias("end"), "seq")
    pairs = interval_join(df.select(*keys, "contig", "start", "end", "strand"), spans, width=chunk)
    begin = F.greatest("start", "r_start")
    part = F.substring(F.col("seq"), (begin - F.col("r_start") + 1).cast("int"), (F.least("end", "r_end") - begin).cast("int"))
    parts = pairs.groupBy(*keys, "strand").agg(F.array_sort(F.collect_list(F.struct(begin.alias("at"), part.alias("s")))).alias("p"))
    joined = F.array_join(F.transform("p", lambda x: x["s"]), "")
    return parts.select(*keys, F.when(F.col("strand") == "-", reverse_complement(joined)).otherwise(joined).alias("seq"))


def mask_sequence(chunks: DataFrame, mask: DataFrame) -> DataFrame:
    """Chunks with the bases inside the mask's intervals replaced by N."""
    spans = chunks.select("contig", F.col("chunk_start").alias("start"), (F.col("chunk_start") + F.length("seq")).alias("end"))
    pairs = interval_join(spans, merge_intervals(mask), width=10_000)
    local = F.struct((F.greatest("start", "r_start") - F.col("start")).cast("int").alias("a"), (F.least("end", "r_end") - F.col("start")).cast("int").alias("b"))
    cuts = pairs.groupBy("contig", F.col("start").alias("chunk_start")).agg(F.array_sort(F.collect_list(local)).alias("cuts"))
    seq = F.aggregate("cuts", F.col("seq"), lambda acc, x: F.overlay(acc, F.repeat(F.lit("N"), x["b"] - x["a"]), x["a"] + 1))
    return chunks.join(cuts, ["contig", "chunk_start"], "left").select("contig", "chunk_start", F.when(F.col("cuts").isNull(), F.col("seq")).otherwise(seq).alias("seq"))
