"""Queries over depth windows, copy number, contig placement and elements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.operators import copynumber as c
from locus.operators import elements as e
from locus.operators import flanks
from locus.operators import reftable as r

from .standins import sql, standin

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(text: str | None = None):  # noqa: ANN201
    def put(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if text is not None:
            SQL[f.__name__] = text
        return f

    return put


def rows(spark: SparkSession, sf: str) -> DataFrame:
    return standin(spark, sf, "reftable")


def depths(spark: SparkSession, sf: str) -> DataFrame:
    return standin(spark, sf, "depths")


@query(f"""WITH {sql('regions', 'blocks')}, w AS (SELECT DISTINCT contig, ord * 50 AS "start", ord * 50 + 500 AS "end" FROM regions), b AS (SELECT contig, "start", "end" FROM blocks WHERE mapq >= 40)
SELECT w.contig, w."start", w."end", coalesce(sum(least(w."end", b."end") - greatest(w."start", b."start")) FILTER (b.contig IS NOT NULL), 0)::BIGINT AS depth FROM w LEFT JOIN b ON w.contig = b.contig AND b."start" < w."end" AND b."end" > w."start" GROUP BY ALL""")
def window_depth_sum(spark: SparkSession, sf: str) -> DataFrame:
    w = standin(spark, sf, "regions").select("contig", (F.col("ord") * 50).alias("start"), (F.col("ord") * 50 + 500).alias("end")).distinct()
    return c.window_depth_sum(w, standin(spark, sf, "blocks"))


@query("SELECT event_id, coalesce(round_even(CASE WHEN event_id % 5 > 0 THEN floor(value) / 2 END * 3, 0), 0)::BIGINT AS total FROM events")
def mean_to_sum(spark: SparkSession, sf: str) -> DataFrame:
    v = spark.read.parquet(f"{sf}/events.parquet")
    return v.select("event_id", c.mean_to_sum(F.when(F.col("event_id") % 5 > 0, F.floor("value") / 2), F.lit(3)).alias("total"))


_AXIS = """g AS (SELECT *, r_start - coalesce(lag(r_end) OVER w, 0) AS gap, CAST(ceil((c_end - c_start) / 50000.0) AS BIGINT) AS n FROM reftable WINDOW w AS (PARTITION BY chrom ORDER BY r_start, ord)),
x AS (SELECT *, sum(gap) OVER (PARTITION BY chrom ORDER BY r_start, ord ROWS UNBOUNDED PRECEDING) / 50000 + coalesce(sum(n) OVER (PARTITION BY chrom ORDER BY r_start, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS axis FROM g)"""


@query(f"WITH {sql('reftable')}, {_AXIS} SELECT contig, n AS n_windows, round(axis, 6)::DOUBLE AS axis_start FROM x")
def window_index(spark: SparkSession, sf: str) -> DataFrame:
    return c.window_index(rows(spark, sf)).select("contig", "n_windows", F.round("axis_start", 6).alias("axis_start"))


@query(f"""WITH {sql('reftable')}, {_AXIS}, y AS (SELECT chrom, lag(axis + n) OVER (PARTITION BY chrom ORDER BY r_start, ord) - 1 AS a, axis AS b FROM x) SELECT chrom, round(a, 6)::DOUBLE AS "start", round(b, 6)::DOUBLE AS "end" FROM y WHERE b - a > 5""")
def assembly_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return c.assembly_gaps(rows(spark, sf)).select("chrom", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query(f"""WITH {sql('reftable')}, g AS (SELECT *, greatest(r_start - coalesce(lag(r_end) OVER (PARTITION BY chrom ORDER BY r_start, ord), 0), 0) AS gap FROM reftable)
SELECT contig, (sum(gap) OVER (PARTITION BY chrom ORDER BY r_start, ord ROWS UNBOUNDED PRECEDING) + coalesce(sum(c_end - c_start) OVER (PARTITION BY chrom ORDER BY r_start, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS axis_bp FROM g""")
def plot_axis_layout(spark: SparkSession, sf: str) -> DataFrame:
    return c.plot_axis_layout(rows(spark, sf)).select("contig", "axis_bp")


@query(f"""WITH {sql('reftable')}, l AS (SELECT chrom, max(r_end) AS length FROM reftable WHERE chrom BETWEEN 1 AND 22 GROUP BY chrom), o AS (SELECT chrom, length, coalesce(sum(length) OVER (ORDER BY chrom ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS o FROM l)
SELECT chrom, length, o AS "offset", o + length / 2 AS midpoint, o + length AS boundary FROM o""")
def chrom_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return c.chrom_offsets(rows(spark, sf).where("chrom between 1 and 22").groupBy("chrom").agg(F.max("r_end").alias("length")))


@query(f"WITH {sql('depths')} SELECT chrom, max(w) AS extent FROM depths GROUP BY chrom")
def chrom_extent(spark: SparkSession, sf: str) -> DataFrame:
    d = depths(spark, sf).withColumnRenamed("w", "window_index")
    return c.chrom_extent(d.where("hap = 0"), d.where("hap = 1"))


@query(f"WITH {sql('reftable')}, g AS (SELECT chrom, max(r_end) / (max(contig) + 1) AS x FROM reftable WHERE chrom BETWEEN 1 AND 22 GROUP BY chrom) SELECT round(median(x), 6) AS bp_per_bin FROM g")
def median_bp_per_bin(spark: SparkSession, sf: str) -> DataFrame:
    g = rows(spark, sf).groupBy("chrom").agg(F.max("r_end").alias("r_end"), (F.max("contig") + 1).alias("bins"))
    return c.median_bp_per_bin(g).select(F.round("bp_per_bin", 6).alias("bp_per_bin"))


_ONE = "o AS (SELECT chrom, w, min(normal_depth) AS v FROM depths GROUP BY ALL)"


def _one(spark: SparkSession, sf: str) -> DataFrame:
    return depths(spark, sf).groupBy("chrom", F.col("w").alias("window_index")).agg(F.min("normal_depth").alias("ratio"))


@query(f"WITH {sql('depths')}, o AS (SELECT sample, hap, chrom, w, min(normal_depth) AS v FROM depths GROUP BY ALL), r AS (SELECT sample, hap, chrom, w, avg(v) OVER f AS m, count(*) OVER f AS n FROM o WINDOW f AS (PARTITION BY sample, hap, chrom ORDER BY w ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)) SELECT sample, hap, chrom, w AS window_index, round(m, 4) AS rolled FROM r WHERE n = 7")
def rolling_mean(spark: SparkSession, sf: str) -> DataFrame:
    key = ["sample", "hap", "chrom"]
    o = depths(spark, sf).groupBy(*key, F.col("w").alias("window_index")).agg(F.min("normal_depth").alias("ratio"))
    return c.rolling_mean(o, by=key).select(*key, "window_index", F.round("rolled", 4).alias("rolled"))


_TOTALS = "t AS (SELECT sample, hap, sum(normal_depth) FILTER (normal_depth > 100000)::BIGINT AS normal_sum, sum(tumor_depth) FILTER (normal_depth > 100000)::BIGINT AS tumor_sum, count(*) FILTER (normal_depth > 100000) AS normal_rows, count(*) FILTER (normal_depth > 100000 AND tumor_depth > 10000) AS tumor_rows FROM depths GROUP BY ALL)"


@query(f"WITH {sql('depths')}, {_TOTALS} SELECT * FROM t")
def depth_totals(spark: SparkSession, sf: str) -> DataFrame:
    return c.depth_totals(depths(spark, sf), ["sample", "hap"])


@query(f"WITH {sql('depths')}, {_TOTALS} SELECT sample, hap, chrom, w, normal_depth, tumor_depth, round(tumor_depth / normal_depth * (normal_sum / tumor_sum) * tumor_rows * 2 / normal_rows, 6) AS ratio FROM depths JOIN t USING (sample, hap) WHERE normal_depth > 100000")
def depth_ratio(spark: SparkSession, sf: str) -> DataFrame:
    d = depths(spark, sf)
    out = c.depth_ratio(d, c.depth_totals(d, ["sample", "hap"]), ["sample", "hap"])
    return out.withColumn("ratio", F.round("ratio", 6))


@query(f"WITH {sql('depths')}, {_TOTALS} SELECT sample, hap, chrom, w, normal_depth, tumor_depth, round(least(tumor_depth / normal_depth / 0.4, 20.0), 6) AS capped FROM depths WHERE normal_depth > 100000")
def winsorised(spark: SparkSession, sf: str) -> DataFrame:
    d = depths(spark, sf).where("normal_depth > 100000")
    return d.withColumn("capped", F.round(c.winsorised(F.col("tumor_depth") / F.col("normal_depth"), 0.4), 6))


@query(f"WITH {sql('depths')}, b AS (SELECT sample, tumor_depth // 5000 AS b, count(*) AS n FROM depths GROUP BY ALL) SELECT sample, (arg_max(b, n * 100000 - b) + 0.5) * 5000.0::DOUBLE AS mode FROM b GROUP BY sample")
def mode_value(spark: SparkSession, sf: str) -> DataFrame:
    return c.mode_value(depths(spark, sf), ["sample"], "tumor_depth", 5000.0)


_SHARE = "coalesce(sum(n) FILTER (m > 0.4 * lv / {k} AND m < 0.6 * lv / {k}), 0) / sum(n)"


@query(f"WITH {sql('depths')}, s AS (SELECT sample, hap, (normal_depth % 70000) / 35000 AS m, w % 50 + 1 AS n, 1.0 AS lv FROM depths), h AS (SELECT sample, hap, {_SHARE.format(k=1)} AS a, {_SHARE.format(k=2)} AS b, {_SHARE.format(k=4)} AS c FROM s WHERE m > 0.05 GROUP BY ALL) SELECT sample, hap, CASE WHEN a <= 0.09 THEN 1 WHEN b <= 0.09 THEN 2 WHEN c <= 0.09 THEN 4 ELSE 8 END::INT AS ploidy FROM h")
def half_window_ploidy(spark: SparkSession, sf: str) -> DataFrame:
    s = depths(spark, sf).select("sample", "hap", ((F.col("normal_depth") % 70000) / 35000).alias("mean"), (F.col("w") % 50 + 1).alias("n_marks"), F.lit(1.0).alias("level"))
    return c.half_window_ploidy(s, ["sample", "hap"])


@query()
def call_copy_number(spark: SparkSession, sf: str) -> DataFrame:
    d = depths(spark, sf).groupBy("sample", "hap", "chrom", F.col("w").alias("window_index")).agg(F.min("tumor_depth").alias("tumor_depth"), F.min("normal_depth").alias("normal_depth"))
    return c.call_copy_number(d)


@query(f"""WITH {sql('depths')}, {_ONE}, s AS (SELECT chrom, w // 4000 AS k, min(w)::DOUBLE + 20 AS a, max(w)::DOUBLE - 20 AS b, count(*) AS n FROM o GROUP BY ALL) SELECT s.chrom, a AS "start", b AS "end", n AS n_marks, round(avg(v), 4) AS mean FROM s JOIN o ON s.chrom = o.chrom AND o.w BETWEEN a AND b GROUP BY ALL""")
def segment_means(spark: SparkSession, sf: str) -> DataFrame:
    o = _one(spark, sf)
    s = o.groupBy("chrom", F.expr("window_index div 4000").alias("k")).agg((F.min("window_index").cast("double") + 20).alias("start"), (F.max("window_index").cast("double") - 20).alias("end"), F.count(F.lit(1)).alias("n_marks")).where("start <= end").drop("k")
    return c.segment_means(s, o, ["chrom"])


@query(f"""WITH {sql('reftable')}, s AS (SELECT chrom, r_start / 50000 AS a, r_end / 50000 AS b FROM reftable), f AS (SELECT chrom, max(r_end) / 50000 + 25 AS x FROM reftable GROUP BY chrom), e AS (SELECT * FROM f UNION ALL SELECT chrom + 100, x FROM f),
w AS (SELECT *, lag(b) OVER (PARTITION BY chrom ORDER BY a, b) AS p, lead(a) OVER (PARTITION BY chrom ORDER BY a, b) AS n FROM s)
SELECT chrom, round(coalesce(p, 0), 6)::DOUBLE AS "start", round(a, 6)::DOUBLE AS "end" FROM w WHERE a - coalesce(p, 0) > 5 UNION ALL SELECT chrom, round(b, 6), round(x, 6) FROM w JOIN e USING (chrom) WHERE n IS NULL AND x - b > 20 UNION ALL SELECT chrom, 0, round(x, 6) FROM e WHERE chrom NOT IN (SELECT chrom FROM s)""")
def leading_inter_trailing_gaps(spark: SparkSession, sf: str) -> DataFrame:
    t = rows(spark, sf)
    s = t.select("chrom", (F.col("r_start") / 50000).alias("start"), (F.col("r_end") / 50000).alias("end"))
    x = t.groupBy("chrom").agg((F.max("r_end") / 50000 + 25).alias("extent"))
    x = x.unionByName(x.withColumn("chrom", F.col("chrom") + 100))  # chromosomes without a segment
    return c.leading_inter_trailing_gaps(s, x).select("chrom", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query(f"""WITH {sql('reftable', 'regions')}, {_AXIS}, a AS (SELECT ord, ord % 100 AS contig, (ord % 100) * 1000 + (ord * 71) % 100000 AS s, (ord % 100) * 1000 + (ord * 71) % 100000 + size * 500 AS e FROM regions),
j AS (SELECT a.ord, x.chrom, x.strand, x.axis, greatest(s, c_start) AS lo, least(e, c_end) AS hi, c_start, c_end FROM a JOIN x ON a.contig = x.contig AND s < c_end AND e > c_start)
SELECT ord, chrom, round(axis + CASE WHEN strand = '-' THEN c_end - hi ELSE lo - c_start END / 50000, 6)::DOUBLE AS axis_lo, round(axis + CASE WHEN strand = '-' THEN c_end - lo ELSE hi - c_start END / 50000, 6)::DOUBLE AS axis_hi FROM j""")
def place_annotation_on_axis(spark: SparkSession, sf: str) -> DataFrame:
    a = standin(spark, sf, "regions").selectExpr("ord", "ord % 100 as contig", "(ord % 100) * 1000 + (ord * 71) % 100000 as start", "(ord % 100) * 1000 + (ord * 71) % 100000 + size * 500 as `end`")
    out = c.place_annotation_on_axis(a, c.window_index(rows(spark, sf)))
    return out.select("ord", "chrom", F.round("axis_lo", 6).alias("axis_lo"), F.round("axis_hi", 6).alias("axis_hi"))


@query(f"""WITH {sql('regions', 'reftable')}, g AS (SELECT chrom AS contig, r_start AS s, r_end AS e, r_start / 50000 AS lo, r_start / 50000 + 3 AS hi FROM reftable), t AS (SELECT ord % 25 AS contig, ord * 4500 AS s, ord * 4500 + size * 900 AS e, CASE WHEN ord % 6 = 0 THEN 'ct_' ELSE 'x' END || brand AS name FROM regions)
SELECT g.contig, name, round(lo + (greatest(g.s, t.s) - g.s) * (hi - lo) / (g.e - g.s), 3)::DOUBLE AS lo, round(lo + (least(g.e, t.e) - g.s) * (hi - lo) / (g.e - g.s), 3)::DOUBLE AS hi FROM g JOIN t ON g.contig = t.contig AND t.s < g.e AND t.e > g.s WHERE name NOT LIKE 'ct%'""")
def gap_fill_annotation(spark: SparkSession, sf: str) -> DataFrame:
    gaps = rows(spark, sf).select(F.col("chrom").cast("long").alias("contig"), F.col("r_start").alias("start"), F.col("r_end").alias("end"), (F.col("r_start") / 50000).alias("axis_lo"), (F.col("r_start") / 50000 + 3).alias("axis_hi"))
    name = F.concat(F.when(F.col("ord") % 6 == 0, "ct_").otherwise("x"), "brand")
    t = standin(spark, sf, "regions").select((F.col("ord") % 25).alias("contig"), (F.col("ord") * 4500).alias("start"), (F.col("ord") * 4500 + F.col("size") * 900).alias("end"), name.alias("name"))
    return c.gap_fill_annotation(gaps, t).select("contig", "name", F.round("lo", 3).alias("lo"), F.round("hi", 3).alias("hi"))


@query(f"WITH {sql('reftable')}, l AS (SELECT chrom, max(r_end) AS n, max(contig)::DOUBLE AS x FROM reftable GROUP BY chrom) SELECT chrom, round(greatest(n / 50000, x), 6) AS extent FROM l")
def terminal_extent(spark: SparkSession, sf: str) -> DataFrame:
    t = rows(spark, sf)
    out = c.terminal_extent([t.groupBy("chrom").agg(F.max("contig").alias("extent"))], t.groupBy("chrom").agg(F.max("r_end").alias("length")))
    return out.select("chrom", F.round("extent", 6).alias("extent"))


# contig placement

_MEMBERS = "m AS (SELECT contig % 20 AS contig, chrom % 4 AS chrom, strand, c_start, c_end, r_start, r_end, matched, ord FROM reftable)"


def members(spark: SparkSession, sf: str) -> DataFrame:
    return rows(spark, sf).select((F.col("contig") % 20).cast("string").alias("contig"), (F.col("chrom") % 4).cast("string").alias("chrom"), "strand", "c_start", "c_end", "r_start", "r_end", (F.col("matched") * 100).alias("matched"), F.lit(60).alias("mapq"), "ord")


@query(f"WITH {sql('reftable')}, {_MEMBERS} SELECT contig::VARCHAR AS contig, chrom::VARCHAR AS chrom, strand, min(c_start) AS c_start, max(c_end) AS c_end, min(r_start) AS r_start, max(r_end) AS r_end, sum(matched * 100)::BIGINT AS matched, sum(c_end - c_start)::BIGINT AS c_span, sum(r_end - r_start)::BIGINT AS r_span, count(*) AS n FROM m GROUP BY ALL")
def chain_stats(spark: SparkSession, sf: str) -> DataFrame:
    return r.chain_stats(members(spark, sf))


@query(f"""WITH {sql('reftable')}, {_MEMBERS}, s AS (SELECT contig::VARCHAR AS contig, chrom::VARCHAR AS chrom, strand, sum(matched * 100) / greatest(max(c_end) - min(c_start), sum(c_end - c_start)) AS d, sum(matched * 100) / greatest(max(r_end) - min(r_start), sum(r_end - r_start)) AS rd FROM m GROUP BY ALL)
SELECT contig, chrom, strand, round(d, 6) AS density, round(rd, 6) AS ref_density FROM s WHERE d >= 0.1 AND rd >= 0.02""")
def drop_sparse_chains(spark: SparkSession, sf: str) -> DataFrame:
    return r.drop_sparse_chains(r.chain_stats(members(spark, sf))).select("contig", "chrom", "strand", F.round("density", 6).alias("density"), F.round("ref_density", 6).alias("ref_density"))


@query(f"WITH {sql('reftable')}, {_MEMBERS} SELECT contig::VARCHAR AS contig, CASE WHEN sum(CASE WHEN strand = '-' THEN matched ELSE 0 END) > sum(CASE WHEN strand = '+' THEN matched ELSE 0 END) THEN '-' ELSE '+' END AS strand FROM m GROUP BY contig")
def majority_strand(spark: SparkSession, sf: str) -> DataFrame:
    return r.majority_strand(members(spark, sf), ["contig"])


@query(f"WITH {sql('reftable')} SELECT hap, chrom, sum(r_end - r_start)::BIGINT AS span FROM reftable GROUP BY ALL")
def ref_span(spark: SparkSession, sf: str) -> DataFrame:
    return r.ref_span(rows(spark, sf))


@query(f"WITH {sql('reftable')}, {_MEMBERS} SELECT contig::VARCHAR AS contig, arg_max(r_start, (r_end - r_start) * 100000 - ord) AS r_start, max(r_end - r_start) AS span FROM m GROUP BY contig")
def longest_span_per_contig(spark: SparkSession, sf: str) -> DataFrame:
    return r.longest_span_per_contig(members(spark, sf)).select("contig", "r_start", (F.col("r_end") - F.col("r_start")).alias("span"))


@query(f"""WITH {sql('reftable')}, f AS (SELECT *, c_start + 30000 AS lo, c_start + 70000 AS hi, (r_end - r_start) / (c_end - c_start) AS k FROM reftable),
p AS (SELECT contig, strand, chrom, c_start AS a, least(c_end, lo) AS b, c_start, c_end, r_start, r_end, k, matched FROM f UNION ALL SELECT contig, strand, chrom, greatest(c_start, hi), c_end, c_start, c_end, r_start, r_end, k, matched FROM f),
q AS (SELECT *, round_even((a - c_start) * k, 0)::BIGINT AS o, round_even((b - a) * k, 0)::BIGINT AS n FROM p WHERE b > a)
SELECT contig, a AS c_start, b AS c_end, CASE WHEN strand = '-' THEN r_end - o - n ELSE r_start + o END AS r_start, round_even(matched * (b - a) / (c_end - c_start), 0)::BIGINT AS matched FROM q""")
def proportional_clip(spark: SparkSession, sf: str) -> DataFrame:
    t = rows(spark, sf).withColumns({"lo": F.col("c_start") + 30000, "hi": F.col("c_start") + 70000})
    return r.proportional_clip(t).select("contig", "c_start", "c_end", "r_start", "matched")


@query(f"""WITH {sql('reftable')}, {_MEMBERS}, d AS (SELECT contig, chrom, r_start, r_start + 20000 AS lo, r_end + 500000 AS hi FROM m) SELECT d.contig::VARCHAR AS contig, d.chrom::VARCHAR AS chrom, d.r_start, round(sum(m.matched * 100 * (least(m.r_end, hi) - greatest(m.r_start, lo)) / (m.r_end - m.r_start)), 4) AS support FROM d JOIN m ON d.contig = m.contig AND d.chrom = m.chrom AND least(m.r_end, hi) > greatest(m.r_start, lo) GROUP BY ALL""")
def row_support(spark: SparkSession, sf: str) -> DataFrame:
    m = members(spark, sf)
    d = m.select("contig", "chrom", "r_start", (F.col("r_start") + 20000).alias("lo"), (F.col("r_end") + 500000).alias("hi"))
    return r.row_support(d, m).select("contig", "chrom", "r_start", F.round("support", 4).alias("support"))


@query()
def reference_table(spark: SparkSession, sf: str) -> DataFrame:
    """Chains, contigs, jumps, chromosomes and reference overlaps in one flow, for the assemblies of two haplotypes."""
    m = members(spark, sf).withColumn("hap", F.col("ord") % 2)
    satellites = standin(spark, sf, "regions").select((F.col("ord") % 4).cast("string").alias("contig"), (F.col("ord") * 45000).alias("start"), (F.col("ord") * 45000 + F.col("size") * 900).alias("end"))
    return r.reference_table(m, satellites, min_density=0.01, min_ref_density=0.001, **termini(m))


def termini(m: DataFrame) -> dict[str, DataFrame]:
    """Contigs end soon after their last alignment, chromosomes after theirs; a third of the contigs has a telomere at each end."""
    contigs = m.groupBy("contig").agg((F.max("c_end") + 20_000).alias("length"))
    ends = F.when(F.col("contig").cast("long") % 3 == 0, "start").when(F.col("contig").cast("long") % 3 == 1, "end")
    return {"telomeres": contigs.select("contig", ends.alias("side")).where("side is not null"), "contig_lengths": contigs, "chrom_lengths": m.groupBy("chrom").agg((F.max("r_end") + 30_000).alias("length"))}


@query()
def consolidate_sex_chroms(spark: SparkSession, sf: str) -> DataFrame:
    names = F.when(F.col("chrom") == "0", "chrX").when(F.col("chrom") == "1", "chrY").otherwise(F.concat(F.lit("chr"), "chrom"))
    m = members(spark, sf).withColumns({"chrom": names, "hap": F.col("ord") % 2})
    return r.consolidate_sex_chroms(m.select(*r.ROW_NAMES, "hap"), m)


# elements and inserts


@query(f"""WITH {sql('blocks')}, h AS (SELECT DISTINCT contig, "start", "end" FROM blocks), m AS (SELECT *, max("end") OVER (PARTITION BY contig ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM h) SELECT contig, sum(greatest("end" - greatest("start", coalesce(b, "start")), 0))::BIGINT AS length FROM m GROUP BY contig""")
def union_length(spark: SparkSession, sf: str) -> DataFrame:
    return e.union_length(standin(spark, sf, "blocks").select("contig", "start", "end"), ["contig"])


@query(f"""WITH {sql('regions')}, b AS (SELECT ord % 50 AS locus, brand AS family, max(struct_pack(bits := size * 10, model := kind, lo := "start", hi := "end")) AS b FROM regions GROUP BY ALL) SELECT locus, family, b.bits AS bits, b.model AS model FROM b""")
def best_hit_per_family(spark: SparkSession, sf: str) -> DataFrame:
    """Scores tie often here, so the model decides."""
    return e.best_hit_per_family(_hits(spark, sf).withColumn("bits", F.col("size") * 10)).select("locus", "family", "bits", "model")


def _hits(spark: SparkSession, sf: str) -> DataFrame:
    return standin(spark, sf, "regions").select((F.col("ord") % 50).alias("locus"), F.col("brand").alias("family"), (F.col("size") * 100000 + F.col("ord")).alias("bits"), F.col("kind").alias("model"), F.col("start").alias("lo"), F.col("end").alias("hi"), "size")


@query(f"""WITH {sql('regions')}, b AS (SELECT ord % 50 AS locus, brand AS family, max(size * 100000 + ord) AS bits FROM regions GROUP BY ALL), t AS (SELECT *, max(bits) OVER (PARTITION BY locus) AS top FROM b)
SELECT locus, CASE WHEN max(CASE WHEN bits = top THEN family END) <= 'Brand#3' THEN string_agg(CASE WHEN family <= 'Brand#3' AND bits >= top - 300000 THEN family END, '/' ORDER BY bits DESC) END AS family, CASE WHEN max(CASE WHEN bits = top THEN family END) > 'Brand#3' THEN 'old_family' END AS reason FROM t GROUP BY locus""")
def top_families(spark: SparkSession, sf: str) -> DataFrame:
    hits = _hits(spark, sf)
    return e.top_families(hits, [f"Brand#{i}" for i in range(1, 100) if f"Brand#{i}" <= "Brand#3"], 300_000).select("locus", "family", "reason")


@query(f"WITH {sql('svs')} SELECT sv_id, chr1 || ',' || pos1 || ',' || dir1 || ',' || chr2 || ',' || pos2 || ',' || dir2 || ',' || ins_len AS insert_key FROM svs WHERE ins_len >= 100")
def min_insert_len(spark: SparkSession, sf: str) -> DataFrame:
    return e.min_insert_len(standin(spark, sf, "svs").withColumn("inserted", F.repeat(F.lit("A"), F.col("ins_len").cast("int")))).select("sv_id", "insert_key")


@query(f"""WITH {sql('sites', 'regions')}, s AS (SELECT DISTINCT site, contig, "start", "end", CASE WHEN sk % 2 = 0 THEN '+' ELSE '-' END AS d FROM sites), l AS (SELECT contig, "start", "end", CASE WHEN size % 2 = 0 THEN '+' ELSE '-' END AS strand, brand || ord AS name, ord FROM regions),
w AS (SELECT *, CASE WHEN d = '+' THEN "start" - 50 ELSE "start" - 5000 END AS a, CASE WHEN d = '+' THEN "start" + 5000 ELSE "end" + 50 END AS z FROM s),
h AS (SELECT w.site, w.contig, w."start", w."end", w.d, arg_min(l.name, l."start" * 10000000 - l.ord) FILTER (l.strand = '-') AS lo, arg_max(l.name, l."start" * 10000000 + l.ord) FILTER (l.strand = '+') AS hi FROM w LEFT JOIN l ON w.contig = l.contig AND l."start" < w.z AND l."end" > w.a AND w.a >= 0 GROUP BY ALL)
SELECT site, contig, "start", "end", CASE WHEN d = '+' THEN lo ELSE hi END AS source FROM h""")
def nearest_source_l1(spark: SparkSession, sf: str) -> DataFrame:
    s = standin(spark, sf, "sites").select("site", "contig", "start", "end", F.when(F.col("sk") % 2 == 0, "+").otherwise("-").alias("source_dir")).distinct()
    l1 = standin(spark, sf, "regions").select("contig", "start", "end", F.when(F.col("size") % 2 == 0, "+").otherwise("-").alias("strand"), F.concat("brand", F.col("ord").cast("string")).alias("name"), "ord")
    return e.nearest_source_l1(s, l1, ["site", "contig", "start", "end", "source_dir"]).select("site", "contig", "start", "end", "source")


@query(f"""WITH {sql('regions')}, h AS (SELECT (ord // 5) AS insert_key, size * 20 AS n, CASE ord % 4 WHEN 0 THEN 'LINE/L1' WHEN 1 THEN 'SINE/Alu' WHEN 2 THEN 'Retroposon/SVA' ELSE 'Simple' END AS family FROM regions), g AS (SELECT insert_key, coalesce(sum(n) FILTER (family = 'LINE/L1'), 0) AS l, coalesce(sum(n) FILTER (family = 'SINE/Alu'), 0) AS a, coalesce(sum(n) FILTER (family = 'Retroposon/SVA'), 0) AS s, count(*) FILTER (family = 'LINE/L1') AS c FROM h GROUP BY ALL)
SELECT insert_key, round(least(1.0, l / 1000), 6)::DOUBLE AS l1_ratio, round(least(1.0, a / 1000), 6)::DOUBLE AS alu_ratio, CASE WHEN s >= 800 THEN 'SVA' WHEN a >= 800 THEN 'Alu' WHEN l >= 800 THEN CASE c WHEN 1 THEN 'Simple_LINE1' ELSE 'Other_LINE1' END END AS repeat_class FROM g""")
def repeat_composition(spark: SparkSession, sf: str) -> DataFrame:
    o = F.col("ord") % 4
    family = F.when(o == 0, "LINE/L1").when(o == 1, "SINE/Alu").when(o == 2, "Retroposon/SVA").otherwise("Simple")
    h = standin(spark, sf, "regions").select(F.expr("ord div 5").alias("insert_key"), F.lit(1000).alias("ins_len"), F.lit(0).cast("long").alias("start"), (F.col("size") * 20).cast("long").alias("end"), F.lit("+").alias("strand"), F.lit("r").alias("repeat"), family.alias("family"), "ord")
    return e.repeat_composition(h).select("insert_key", F.round("l1_ratio", 6).alias("l1_ratio"), F.round("alu_ratio", 6).alias("alu_ratio"), "repeat_class")


@query(f"""WITH {sql('regions')}, h AS (SELECT ord // 6 AS k, ord % 6 AS i, ord, size FROM regions),
x AS (SELECT k, CASE i WHEN 0 THEN '(T)n' WHEN 1 THEN '(A)n' ELSE 'L1' END AS r, CASE WHEN i < 2 THEN 'Simple' WHEN i < 4 AND k % 3 > 0 THEN 'LINE/L1' WHEN i = 4 AND k % 3 = 1 THEN 'LINE/L1' ELSE 'DNA' END AS f, CASE i WHEN 3 THEN '-' ELSE '+' END AS st, i * 100 AS s, CASE WHEN i < 2 THEN size ELSE 200 + size END AS n, ord FROM h WHERE NOT (i = 1 AND k % 2 = 0)),
g AS (SELECT k, coalesce(sum(n) FILTER (f = 'LINE/L1'), 0) AS l, arg_max(n, s) FILTER (r = '(A)n') AS a, arg_min(n, s) FILTER (r = '(T)n') AS t, count(*) FILTER (f = 'LINE/L1') AS c, count(DISTINCT st) FILTER (f = 'LINE/L1') AS d FROM x GROUP BY k)
SELECT k AS insert_key, round(least(1.0, l / (600 - coalesce(a, t, 0))), 6)::DOUBLE AS l1_ratio, CASE WHEN l / (600 - coalesce(a, t, 0)) >= 0.8 THEN CASE WHEN c = 1 THEN 'Simple_LINE1' WHEN c = 2 AND d = 2 THEN 'Inverted_LINE1' ELSE 'Other_LINE1' END END AS repeat_class FROM g""")
def repeat_composition_tails(spark: SparkSession, sf: str) -> DataFrame:
    """Inserts with poly-T and poly-A tails, and elements of two strands."""
    i, k, size = F.col("ord") % 6, F.expr("ord div 6"), F.col("size")
    family = F.when(i < 2, "Simple").when((i < 4) & (k % 3 > 0), "LINE/L1").when((i == 4) & (k % 3 == 1), "LINE/L1").otherwise("DNA")
    start = (i * 100).cast("long")
    h = standin(spark, sf, "regions").where(~((i == 1) & (k % 2 == 0))).select(k.alias("insert_key"), F.lit(600).alias("ins_len"), start.alias("start"), (start + F.when(i < 2, size).otherwise(size + 200)).alias("end"), F.when(i == 3, "-").otherwise("+").alias("strand"), F.when(i == 0, "(T)n").when(i == 1, "(A)n").otherwise("L1").alias("repeat"), family.alias("family"), "ord")
    return e.repeat_composition(h).select("insert_key", F.round("l1_ratio", 6).alias("l1_ratio"), "repeat_class")


@query()
def chain_hsps(spark: SparkSession, sf: str) -> DataFrame:
    h = standin(spark, sf, "blocks").select("contig", "strand", "start", "end", (F.col("start") % 6000).alias("q_start"), (F.col("start") % 6000 + F.col("end") - F.col("start")).alias("q_end"), (F.col("end") - F.col("start")).alias("aligned"), (F.col("end") - F.col("start") - F.col("start") % 7).alias("n_match")).distinct()
    return e.chain_hsps(h, 6000, max_gap=1000, tolerance=1000)


@query(f"""WITH {sql('seqs')}, r AS (SELECT contig, seq, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc FROM seqs), s AS (SELECT contig, 1 AS r, substr(seq, 1, 20) AS a, substr(seq, 2, 21) AS b FROM r UNION ALL SELECT contig, 0, substr(rc, 1, 20), substr(rc, 2, 21) FROM r),
d AS (SELECT *, unnest(range(-2, 3)) AS d FROM s), i AS (SELECT *, unnest(range(0, 3)) AS i FROM d), e AS (SELECT *, unnest(range(i, least(length(a), length(b) - d))) AS e FROM i WHERE i + d BETWEEN 0 AND 2),
v AS (SELECT contig, r, e, e - i + 1 AS n, list_sum(list_transform(range(i, e + 1), lambda k: CASE WHEN substr(a, (k + 1)::INT, 1) = substr(b, (k + d + 1)::INT, 1) THEN 1 ELSE -8 END))::BIGINT AS score FROM e),
z AS (SELECT *, unnest(range(1, 19)) AS p FROM (SELECT *, unnest(range(0, 3)) AS j FROM (SELECT *, unnest(range(0, 3)) AS i FROM s))),
y AS (SELECT *, unnest(range(1, 20)) AS q FROM (SELECT *, unnest(range(0, 2)) AS g FROM z WHERE substr(a, (i + 1)::INT, p::INT) = substr(b, (j + 1)::INT, p::INT) AND i + p < length(a) AND j + p < length(b))),
x AS (SELECT contig, r, i + p + g + q - 1 AS e, p + q + 1 AS n, p + q - 8 AS score FROM y WHERE p + q >= 13 AND i + p + g + q <= length(a) AND j + p + 1 - g + q <= length(b) AND substr(a, (i + p + g + 1)::INT, q::INT) = substr(b, (j + p + 1 - g + 1)::INT, q::INT)),
t AS (SELECT contig, max(struct_pack(score := score, r := r, back := -e, n := n)) AS t FROM (SELECT contig, r, e, n, score FROM v UNION ALL SELECT contig, r, e, n, score FROM x) WHERE score >= 5 AND n >= 5 AND n - (n - score) / 9 >= 0.8 * n GROUP BY contig) SELECT contig AS insert_key, t.n AS tsd_len, CASE t.r WHEN 1 THEN 'right' ELSE 'left' END AS side FROM t""")
def target_site_duplication(spark: SparkSession, sf: str) -> DataFrame:
    from locus.functions.seq import reverse_complement

    s = standin(spark, sf, "seqs")
    rc = reverse_complement(F.col("seq"))
    return e.target_site_duplication(s.select(F.col("contig").alias("insert_key"), "seq", F.substring("seq", 2, 21).alias("right"), rc.alias("seq_rc"), F.substring(rc, 2, 21).alias("left"))).withColumn("tsd_len", F.col("tsd_len").cast("long"))


@query(f"""WITH {sql('seqs')}, i AS (SELECT contig, seq, p, substr(seq, p::INT + 1, 7) AS k FROM (SELECT contig, seq, unnest(range(0, 26)) AS p FROM seqs)),
fl AS (SELECT contig, 1 AS is_left, substr(seq, 5, 20) AS s FROM seqs UNION ALL SELECT contig, 0, reverse(seq) FROM seqs), fk AS (SELECT DISTINCT contig, is_left, substr(s, p::INT + 1, 7) AS k FROM (SELECT *, unnest(range(0, length(s) - 6)) AS p FROM fl)),
h AS (SELECT i.contig, is_left, count(DISTINCT i.k) AS h, min(p) AS a, max(p) AS z FROM i JOIN fk ON i.contig = fk.contig AND i.k = fk.k GROUP BY ALL), n AS (SELECT contig, count(DISTINCT k) AS n FROM i GROUP BY contig),
b AS (SELECT contig, max(struct_pack(share := h / n, l := is_left, a := a, z := z)) AS b FROM h JOIN n USING (contig) GROUP BY contig),
t AS (SELECT contig, 'w' AS part, seq AS s FROM seqs UNION ALL SELECT seqs.contig, 'p', substr(seq, b.a::INT + 1, (b.z - b.a + 7)::INT) FROM seqs JOIN b USING (contig)),
r AS (SELECT contig, part, p, len(list_filter(range(1, length(s) - p + 1), lambda x: substr(s, x::INT, 1) = substr(s, (x + p)::INT, 1))) / (length(s) - p) AS share FROM (SELECT *, unnest(range(1, length(s) // 2 + 1)) AS p FROM t)),
q AS (SELECT contig, part, arg_min(p, struct_pack(x := -share, y := p)) AS period, max(share) AS share FROM r GROUP BY ALL)
SELECT seqs.contig AS sv_id, length(seq) AS ins_len, round(coalesce(b.share, 0), 9) AS flank_coverage, CASE b.l WHEN 1 THEN 'left' WHEN 0 THEN 'right' END AS best_flank, round(w.share, 9) AS self_repeat, w.period AS self_period, round(coalesce(p.share, 0), 9) AS flank_self_repeat
FROM seqs LEFT JOIN b USING (contig) LEFT JOIN q w ON w.contig = seqs.contig AND w.part = 'w' LEFT JOIN q p ON p.contig = seqs.contig AND p.part = 'p'""")
def flank_repeat_score(spark: SparkSession, sf: str) -> DataFrame:
    s = standin(spark, sf, "seqs")
    f = e.flank_repeat_score(s.select(F.col("contig").alias("sv_id"), "seq", F.substring("seq", 5, 20).alias("left"), F.reverse("seq").alias("right")), 7)
    return f.select("sv_id", F.col("ins_len").cast("long").alias("ins_len"), F.round("flank_coverage", 9).alias("flank_coverage"), "best_flank", F.round("self_repeat", 9).alias("self_repeat"), F.col("self_period").cast("long").alias("self_period"), F.round("flank_self_repeat", 9).alias("flank_self_repeat"))


def flanked(spark: SparkSession, sf: str) -> DataFrame:
    """Inserts of 90 bases whose left flank lacks four of them and whose right one is another's order."""
    t = standin(spark, sf, "longseqs")
    left = F.concat(F.substring("seq", 1, 70), F.substring("seq", 75, 90))
    return t.select(F.col("contig").alias("sv_id"), F.substring("seq", 30, 90).alias("seq"), left.alias("left"), F.concat(F.substring("seq", 81, 60), F.substring("seq", 1, 60)).alias("right"))


@query()
def flank_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return flanks.flank_alignment(flanked(spark, sf))
