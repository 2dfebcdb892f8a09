"""Queries over structural variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.operators import sv as s

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


def svs(spark: SparkSession, sf: str) -> DataFrame:
    return standin(spark, sf, "svs")


_TYPE = "CASE WHEN chr1 <> chr2 THEN 'Translocation' WHEN dir1 = dir2 THEN 'Inversion' WHEN dir1 = '-' AND dir2 = '+' THEN 'Duplication' WHEN ins_len > pos2 - pos1 + 1 THEN 'Insertion' ELSE 'Deletion' END"


@query(f"WITH {sql('svs')} SELECT sv_id, {_TYPE} AS sv_type FROM svs")
def classify_sv_type(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return svs(spark, sf).select("sv_id", s.classify_sv_type(c("chr1"), c("pos1"), c("dir1"), c("chr2"), c("pos2"), c("dir2"), c("ins_len")).alias("sv_type"))


@query(f"""WITH {sql('svs')}, f AS (SELECT *, array_to_string(list_filter([CASE WHEN checked_control < 10 THEN 'Low_normal_depth' END, CASE WHEN checked_tumor < 10 THEN 'Low_tumor_depth' END, CASE WHEN checked_tumor > 0 AND support_tumor / checked_tumor < 0.05 THEN 'Low_VAF' END, CASE WHEN sv_id LIKE 'd%' AND dir1 = '-' AND dir2 = '+' THEN 'False_dup' END], lambda x: x IS NOT NULL), ';') AS n FROM svs)
SELECT sv_id, CASE WHEN n = '' THEN is_filter WHEN is_filter = 'PASS' THEN n ELSE is_filter || ';' || n END AS is_filter FROM f""")
def sv_hard_filter(spark: SparkSession, sf: str) -> DataFrame:
    return s.sv_hard_filter(svs(spark, sf)).select("sv_id", "is_filter")


@query(f"WITH {sql('svs')} SELECT sv_id FROM svs WHERE is_filter = 'PASS'")
def keep_pass(spark: SparkSession, sf: str) -> DataFrame:
    return s.keep_pass(svs(spark, sf)).select("sv_id")


@query(f"WITH {sql('svs')} SELECT sv_id FROM svs WHERE is_filter <> 'Too_small_size'")
def drop_flagged(spark: SparkSession, sf: str) -> DataFrame:
    return s.drop_flagged(svs(spark, sf)).select("sv_id")


@query(f"""WITH {sql('svs')} SELECT chr1 AS contig, pos1 - 1 AS "start", pos1 AS "end", sv_id, 1 AS bp FROM svs UNION ALL SELECT chr2, pos2 - 1, pos2, sv_id, 2 FROM svs""")
def sv_to_breakpoints(spark: SparkSession, sf: str) -> DataFrame:
    return s.sv_to_breakpoints(svs(spark, sf))


def _bp(k: int) -> str:
    return f"""h{k} AS (SELECT sv_id, arg_min(r.brand, r."start" * 100000 + r.ord) AS gene_{k} FROM svs JOIN regions r ON svs.chr{k} = r.contig AND r."start" <= pos{k} AND r."end" > pos{k} GROUP BY sv_id)"""


@query(f"WITH {sql('svs', 'regions')}, {_bp(1)}, {_bp(2)} SELECT sv_id, gene_1, gene_2 FROM svs LEFT JOIN h1 USING (sv_id) LEFT JOIN h2 USING (sv_id)")
def annotate_bp(spark: SparkSession, sf: str) -> DataFrame:
    track = standin(spark, sf, "regions").select("contig", "start", "end", "ord", F.col("brand").alias("gene"))
    return s.annotate_bp(svs(spark, sf), track, ["gene"]).select("sv_id", "gene_1", "gene_2")


@query(f"""WITH {sql('svs', 'regions')}, l AS (SELECT contig, max("end") AS n FROM regions GROUP BY contig) SELECT sv_id, a.n AS size_1, b.n AS size_2 FROM svs JOIN l a ON chr1 = a.contig JOIN l b ON chr2 = b.contig""")
def sv_contig_size(spark: SparkSession, sf: str) -> DataFrame:
    return s.sv_contig_size(svs(spark, sf), standin(spark, sf, "regions").groupBy("contig").agg(F.max("end").alias("length"))).select("sv_id", "size_1", "size_2")


_LIFT = """l AS (SELECT sv_id, chr1 AS contig, pos1 AS pos, CASE ck % 3 WHEN 0 THEN 'Match' WHEN 1 THEN 'Gap' ELSE 'Lost' END AS status, 'c' || chr2 AS d, pos2 AS p, pos2 + 5 AS e, sv AS ord FROM svs UNION ALL SELECT sv_id, chr1, pos1, CASE WHEN ck % 2 = 0 THEN 'Match' ELSE 'Gap' END, 'x', pos1, pos1 + 9, sv + 1 FROM svs WHERE sv % 3 = 0)"""


@query(f"""WITH {sql('svs')}, {_LIFT}, g AS (SELECT sv_id, string_agg(CASE WHEN status = 'Match' THEN d || ':' || p END, ',' ORDER BY ord) AS m, string_agg(CASE WHEN status = 'Gap' THEN d || ':' || p || '-' || e END, ',' ORDER BY ord) AS x FROM l GROUP BY sv_id)
SELECT sv_id, coalesce(m, x) AS g_1, NULL::VARCHAR AS g_2, m IS NOT NULL AS g_lifted FROM svs LEFT JOIN g USING (sv_id)""")
def attach_liftover_sv(spark: SparkSession, sf: str) -> DataFrame:
    v = svs(spark, sf)
    c = F.col
    a = v.select("sv_id", c("chr1").alias("contig"), c("pos1").alias("pos"), F.when(c("ck") % 3 == 0, "Match").when(c("ck") % 3 == 1, "Gap").otherwise("Lost").alias("status"), F.concat(F.lit("c"), c("chr2").cast("string")).alias("dst_contig"), c("pos2").alias("dst_pos"), (c("pos2") + 5).alias("dst_end"), c("sv").alias("ord"))
    b = v.where("sv % 3 = 0").select("sv_id", c("chr1").alias("contig"), c("pos1").alias("pos"), F.when(c("ck") % 2 == 0, "Match").otherwise("Gap").alias("status"), F.lit("x").alias("dst_contig"), c("pos1").alias("dst_pos"), (c("pos1") + 9).alias("dst_end"), (c("sv") + 1).alias("ord"))
    return s.attach_liftover_sv(v.withColumn("pos2", -c("pos2")), a.unionByName(b), "g").select("sv_id", "g_1", "g_2", "g_lifted")


@query(f"""WITH {sql('reads')}, d AS (SELECT sv_id, 'error,click' AS identical FROM (SELECT DISTINCT sv_id FROM reads) UNION ALL SELECT 'z' || sv_id, sv_id FROM (SELECT DISTINCT sv_id FROM reads)),
q AS (SELECT DISTINCT sv_id, read FROM reads), t AS (SELECT read, min(ratio) AS ratio FROM reads GROUP BY read), e AS (SELECT d.sv_id, unnest(string_split(identical, ',')) AS one FROM d) SELECT d.sv_id, round(avg(ratio), 3) AS kmer_ratio FROM d LEFT JOIN e ON d.sv_id = e.sv_id LEFT JOIN q ON e.one = q.sv_id LEFT JOIN t ON q.read = t.read GROUP BY d.sv_id""")
def mean_support_kmer_ratio(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "reads")
    names = r.select("sv_id").distinct()
    d = names.withColumn("identical", F.lit("error,click")).unionByName(names.select(F.concat(F.lit("z"), "sv_id").alias("sv_id"), F.col("sv_id").alias("identical")))
    return s.mean_support_kmer_ratio(d, r, r.groupBy("read").agg(F.min("ratio").alias("ratio"))).select("sv_id", "kmer_ratio")


_OTHER = "o AS (SELECT 'o_' || sv AS id, chr1, pos1 + ck % 120 AS pos1, dir1, chr2, pos2 + ck % 90 AS pos2, dir2, sv AS ord FROM svs)"


def _other(spark: SparkSession, sf: str) -> DataFrame:
    return svs(spark, sf).withColumns({"sv_id": F.concat(F.lit("o_"), F.col("sv").cast("string")), "pos1": F.col("pos1") + F.col("ck") % 120, "pos2": F.col("pos2") + F.col("ck") % 90, "ord": F.col("sv")})


_MATCH = "JOIN o ON svs.chr1 = o.chr1 AND svs.chr2 = o.chr2 AND svs.dir1 = o.dir1 AND svs.dir2 = o.dir2 AND abs(svs.pos1 - o.pos1) <= 100 AND abs(svs.pos2 - o.pos2) <= 100"


@query(f"WITH {sql('svs')}, {_OTHER} SELECT sv_id, arg_min(id, ord) AS other_sv FROM svs LEFT {_MATCH} GROUP BY sv_id")
def match_sv_callset(spark: SparkSession, sf: str) -> DataFrame:
    return s.match_sv_callset(svs(spark, sf), _other(spark, sf)).select("sv_id", "other_sv")


@query(f"""WITH {sql('svs')}, {_OTHER}, m AS (SELECT svs.sv_id, arg_min(id, o.ord) AS hit FROM svs LEFT {_MATCH} GROUP BY sv_id), n AS (SELECT DISTINCT id FROM svs {_MATCH})
SELECT sv_id, CASE WHEN hit IS NULL THEN 'a' ELSE 'a,b' END AS sources FROM m UNION ALL SELECT id, 'b' FROM o WHERE id NOT IN (FROM n)""")
def merge_sv_callsets(spark: SparkSession, sf: str) -> DataFrame:
    a = svs(spark, sf).withColumn("ord", F.col("sv"))
    return s.merge_sv_callsets(a, _other(spark, sf)).select("sv_id", F.array_join("sources", ",").alias("sources"))


@query(f"""WITH {sql('svs')}, l AS (SELECT sv_id, least(chr1, chr2) AS c1, greatest(chr1, chr2) AS c2, pos1, pos2 FROM svs),
p AS (SELECT least(chr1, chr2) AS c1, pos1 + ck % 70 AS s, pos1 + ck % 70 + 20 AS e, greatest(chr1, chr2) AS c2, CASE WHEN ck % 10 > 0 THEN pos2 + ck % 60 END AS e2, 'p' || sv AS name, sv AS ord FROM svs),
h AS (SELECT l.sv_id, p.name, p.s, p.ord FROM l JOIN p ON l.c1 = p.c1 AND l.c2 = p.c2 AND abs(l.pos2 - p.e2) <= 50 AND l.pos1 >= 50 AND ((l.c1 = l.c2 AND abs(l.pos1 - p.s) <= 50) OR (l.c1 <> l.c2 AND l.pos1 >= p.s - 50 AND l.pos1 <= p.e + 50)))
SELECT svs.sv_id, arg_min(name, s * 1000000 + h.ord) AS population FROM svs LEFT JOIN h USING (sv_id) GROUP BY svs.sv_id""")
def annotate_population_sv(spark: SparkSession, sf: str) -> DataFrame:
    v, c = svs(spark, sf), F.col
    left = v.select("sv_id", F.least("chr1", "chr2").alias("ref_chr1"), c("pos1").alias("ref_pos1"), F.greatest("chr1", "chr2").alias("ref_chr2"), c("pos2").alias("ref_pos2"))
    pop = v.select(F.least("chr1", "chr2").alias("chr1"), (c("pos1") + c("ck") % 70).alias("start"), (c("pos1") + c("ck") % 70 + 20).alias("end"), F.greatest("chr1", "chr2").alias("chr2"), F.when(c("ck") % 10 > 0, c("pos2") + c("ck") % 60).alias("end2"), F.concat(F.lit("p"), c("sv").cast("string")).alias("name"), c("sv").alias("ord"))
    return s.annotate_population_sv(left, pop).select("sv_id", "population")


_NAME = "CASE {c} WHEN 5 THEN 'chrX' WHEN 6 THEN 'chrY' ELSE concat('chr', {c} * 3 + 1) END"


@query(f"""WITH {sql('svs')}, n AS (SELECT sv_id, {_NAME.format(c='chr1')} AS a, pos1 AS p, {_NAME.format(c='chr2')} AS b, pos2 AS q FROM svs),
w AS (SELECT *, CASE WHEN a IN ('chrX', 'chrY') THEN TRUE WHEN b IN ('chrX', 'chrY') THEN a > b ELSE substr(a, 4)::INT > substr(b, 4)::INT END AS w FROM n)
SELECT sv_id, CASE WHEN w THEN b ELSE a END AS ref_chr1, CASE WHEN w THEN q ELSE p END AS ref_pos1, CASE WHEN w THEN a ELSE b END AS ref_chr2, CASE WHEN w THEN p ELSE q END AS ref_pos2 FROM w""")
def in_population_order(spark: SparkSession, sf: str) -> DataFrame:
    named = svs(spark, sf).select("sv_id", F.expr(_NAME.format(c="chr1")).alias("ref_chr1"), F.col("pos1").alias("ref_pos1"), F.expr(_NAME.format(c="chr2")).alias("ref_chr2"), F.col("pos2").alias("ref_pos2"))
    return s.in_population_order(named)


@query(f"""WITH {sql('svs')}, l AS (SELECT 's' || (sv % 50) AS k, sv_id, sv FROM svs) SELECT k AS sv_id, string_agg(svs.is_filter, ',' ORDER BY l.sv) AS ref_filter, TRUE AS ref FROM l JOIN svs ON l.sv_id = svs.sv_id GROUP BY k UNION ALL SELECT 'none', NULL, FALSE""")
def link_ref_callset(spark: SparkSession, sf: str) -> DataFrame:
    v = svs(spark, sf)
    links = v.select(F.concat(F.lit("s"), (F.col("sv") % 50).cast("string")).alias("sv_id"), F.col("sv_id").alias("ref_id"), F.col("sv").alias("ord"))
    rows = links.select("sv_id").distinct().unionByName(spark.createDataFrame([("none",)], "sv_id string"))
    return s.link_ref_callset(rows, links, v).select("sv_id", "ref_filter", "ref")


@query(f"WITH {sql('svs')} SELECT 's' || ck || '_' || sv AS sv_id, sv AS read FROM svs WHERE ck IN (SELECT ck FROM svs WHERE is_filter = 'PASS' AND dir1 = dir2)")
def filter_support_reads(spark: SparkSession, sf: str) -> DataFrame:
    named = svs(spark, sf).withColumn("sv_id", F.concat(F.lit("s"), F.col("ck").cast("string"), F.lit("_"), F.col("sv").cast("string")))
    return s.filter_support_reads(named.select("sv_id", F.col("sv").alias("read")), named.where("is_filter = 'PASS' and dir1 = dir2").select("sv_id"))


_REPEAT = """q AS (SELECT svs.*, chr1 = chr2 AND dir1 = '+' AND dir2 = '-' AND EXISTS (SELECT 1 FROM regions r WHERE r.contig = chr1 AND r."start" < pos1 + 30 AND r."end" > greatest(pos1 - 29, 0) AND r."end" >= pos2 - 30) AS in_repeat FROM svs)"""


@query(f"WITH {sql('svs', 'regions')}, {_REPEAT} SELECT sv_id, in_repeat FROM q")
def in_simple_repeat(spark: SparkSession, sf: str) -> DataFrame:
    return s.in_simple_repeat(svs(spark, sf), standin(spark, sf, "regions")).select("sv_id", "in_repeat")


_DECIDE = f"""{_REPEAT}, c AS (SELECT sv_id, ck % 100 AS il, (ck % 11) / 10 AS fc, (ck % 7) / 10 AS fs, (ck % 13) / 13 AS sr FROM svs WHERE is_filter = 'PASS'),
d AS (SELECT q.sv_id, q.is_filter, CASE WHEN NOT in_repeat THEN 'outside' WHEN c.sv_id IS NULL THEN 'unscored' WHEN q.sv_id LIKE 'd\\_%' ESCAPE '\\' THEN 'deletion' WHEN sr >= 0.70 THEN 'self_repeat' WHEN fc >= 0.60 AND fs >= 0.48 THEN 'flank' WHEN il < 50 THEN 'short' ELSE 'kept' END AS reason FROM q LEFT JOIN c ON q.sv_id = c.sv_id)"""


def _decided(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("ck")
    scores = svs(spark, sf).where("is_filter = 'PASS'").select("sv_id", (c % 100).alias("ins_len"), ((c % 11) / 10).alias("flank_coverage"), ((c % 7) / 10).alias("flank_self_repeat"), ((c % 13) / 13).alias("self_repeat"))
    return s.decide_array_change(s.in_simple_repeat(svs(spark, sf).drop("ins_len"), standin(spark, sf, "regions")), scores)


@query(f"WITH {sql('svs', 'regions')}, {_DECIDE} SELECT sv_id, reason AS repeat_reason, CASE WHEN reason IN ('outside', 'kept') THEN is_filter WHEN is_filter = 'PASS' THEN 'Simple_repeat' ELSE is_filter || ';Simple_repeat' END AS is_filter FROM d")
def decide_array_change(spark: SparkSession, sf: str) -> DataFrame:
    return _decided(spark, sf).select("sv_id", "repeat_reason", "is_filter")


@query(f"WITH {sql('svs', 'regions')}, {_DECIDE} SELECT reason AS repeat_reason, count(*) AS n FROM d WHERE reason NOT IN ('outside', 'kept') GROUP BY reason")
def repeat_flag_summary(spark: SparkSession, sf: str) -> DataFrame:
    return s.repeat_flag_summary(_decided(spark, sf))


@query(f"""WITH {sql('svs', 'reftable')}, t AS (SELECT contig % 5 AS contig, arg_max(struct_pack(chrom := chrom, strand := strand, r_start := r_start, hap := hap), (r_end - r_start) * 1000000 - ord) AS b FROM reftable GROUP BY ALL),
j AS (SELECT svs.*, a.b AS a, z.b AS z FROM svs LEFT JOIN t a ON chr1 = a.contig LEFT JOIN t z ON chr2 = z.contig),
f AS (SELECT *, CASE WHEN a.strand = '-' THEN CASE dir1 WHEN '+' THEN '-' ELSE '+' END ELSE dir1 END AS d1, CASE WHEN z.strand = '-' THEN CASE dir2 WHEN '+' THEN '-' ELSE '+' END ELSE dir2 END AS d2 FROM j),
g AS (SELECT *, CASE WHEN z.r_start < a.r_start THEN d2 ELSE d1 END AS e1, CASE WHEN z.r_start < a.r_start THEN d1 ELSE d2 END AS e2 FROM f)
SELECT sv_id, CASE WHEN chr1 = chr2 OR a IS NULL OR z IS NULL THEN {_TYPE} WHEN a.chrom <> z.chrom OR a.hap <> z.hap THEN 'Translocation' WHEN e1 = e2 THEN 'Inversion' WHEN e1 = '-' AND e2 = '+' THEN 'Duplication' WHEN ins_len > abs(z.r_start - a.r_start) + 1 THEN 'Insertion' ELSE 'Deletion' END AS sv_type, a.chrom AS ref_chr1, z.chrom AS ref_chr2 FROM g""")
def attach_ref_contig(spark: SparkSession, sf: str) -> DataFrame:
    return s.attach_ref_contig(svs(spark, sf), standin(spark, sf, "reftable").withColumn("contig", F.col("contig") % 5)).select("sv_id", "sv_type", "ref_chr1", "ref_chr2")


@query(f"""WITH {sql('reads')}, e AS (SELECT read, read_pos, ord, 'v' || (ord % 97) AS sv_id, chr1 % 2 AS chr1, pos1, chr1 % 2 AS chr2, pos1 + 3 AS pos2 FROM reads),
n AS (SELECT *, lead(sv_id) OVER w AS t, lead(chr1) OVER w AS nc, lead(pos1) OVER w AS np, lead(read_pos) OVER w AS nr FROM e WINDOW w AS (PARTITION BY read ORDER BY read_pos, ord))
SELECT sv_id AS from_sv, t AS to_sv, arg_min(nr - read_pos, read * 10000000 + ord) AS first_size, string_agg((nr - read_pos)::VARCHAR, ',' ORDER BY read, ord) AS sizes FROM n WHERE t IS NOT NULL AND chr2 = nc AND abs(np - pos2) <= (nr - read_pos) * 1.3 AND nr - read_pos <= abs(np - pos2) * 1.3 GROUP BY ALL""")
def read_adjacent_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return s.read_adjacent_pairs(_walks(spark, sf))


def _walks(spark: SparkSession, sf: str) -> DataFrame:
    r, c = standin(spark, sf, "reads"), F.col
    return r.select("read", "read_pos", "ord", F.concat(F.lit("v"), (c("ord") % 97).cast("string")).alias("sv_id"), (c("chr1") % 2).alias("chr1"), "pos1", (c("chr1") % 2).alias("chr2"), (c("pos1") + 3).alias("pos2"))


@query(f"""WITH RECURSIVE {sql('svs')}, e AS (SELECT 'n' || ck AS a, 'n' || (ck + 1) AS b FROM svs), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), w(a, b) AS (SELECT a, a FROM u UNION SELECT w.a, u.b FROM w JOIN u ON w.b = u.a) SELECT a AS sv_id, min(b) AS path FROM w GROUP BY a""")
def connected_variants(spark: SparkSession, sf: str) -> DataFrame:
    v, c = svs(spark, sf), F.col("ck")
    n = lambda x: F.concat(F.lit("n"), x.cast("string"))
    return s.connected(v.select(n(c).alias("a"), n(c + 1).alias("b")).distinct(), "a", "b").withColumnRenamed("node", "sv_id")


# Reads of even users run forwards over variants that follow each other, those of odd users backwards.
_WALK = """e AS (SELECT user_id AS read, event_id AS ord, event_id * 7 AS read_pos, 'v' || event_id AS sv, user_id % 5 AS chr, CASE WHEN user_id % 2 = 0 THEN event_id * 7 ELSE 10000000 - event_id * 7 END AS p1, CASE WHEN user_id % 2 = 0 THEN '+' ELSE '-' END AS rd, event_id % 4 AS ins, CASE WHEN event_id % 9 = 0 THEN '-' ELSE '+' END AS d1 FROM events),
o AS (SELECT *, CASE WHEN rd = '+' THEN p1 ELSE p1 + 3 END AS ip, CASE WHEN rd = '+' THEN d1 ELSE '-' END AS di, CASE WHEN rd = '+' THEN p1 + 3 ELSE p1 END AS lp, CASE WHEN rd = '+' THEN '-' ELSE d1 END AS dl, read_pos + CASE WHEN rd = '+' THEN ins ELSE 0 END AS last, read_pos - CASE WHEN rd = '+' THEN 0 ELSE ins END AS first FROM e),
n AS (SELECT *, lead(sv) OVER w AS t, lead(chr) OVER w AS tc, lead(ip) OVER w AS tp, lead(di) OVER w AS td, lead(rd) OVER w AS tr, lead(first) OVER w AS tf FROM o WINDOW w AS (PARTITION BY read ORDER BY read_pos, ord)),
g AS (SELECT *, tf - last AS d, CASE WHEN dl = '-' AND td = '+' THEN tp - lp WHEN dl = '+' AND td = '-' THEN lp - tp END AS size FROM n WHERE t IS NOT NULL AND chr = tc),
k AS (SELECT CASE WHEN dl = '+' THEN t ELSE sv END AS from_sv, CASE WHEN dl = '+' THEN sv ELSE t END AS to_sv, CASE WHEN dl = '+' THEN CASE tr WHEN '+' THEN '-' ELSE '+' END ELSE rd END AS from_turn, CASE WHEN dl = '+' THEN CASE rd WHEN '+' THEN '-' ELSE '+' END ELSE tr END AS to_turn, size, d, read, ord FROM g WHERE size <= d * 1.3 AND size * 1.3 >= d)"""


def _oriented(spark: SparkSession, sf: str) -> DataFrame:
    e, c = spark.read.parquet(f"{sf}/events.parquet"), F.col
    even = c("user_id") % 2 == 0
    p1 = F.when(even, c("event_id") * 7).otherwise(10000000 - c("event_id") * 7)
    return e.select(c("user_id").alias("read"), (c("event_id") * 7).alias("read_pos"), c("event_id").alias("ord"), F.concat(F.lit("v"), c("event_id").cast("string")).alias("sv_id"), (c("user_id") % 5).alias("chr1"), p1.alias("pos1"), F.when(c("event_id") % 9 == 0, "-").otherwise("+").alias("dir1"), (c("user_id") % 5).alias("chr2"), (p1 + 3).alias("pos2"), F.lit("-").alias("dir2"), (c("event_id") % 4).alias("ins_len"), F.when(even, "+").otherwise("-").alias("read_dir"))


@query(f"""WITH {_WALK} SELECT from_sv, to_sv, from_turn, to_turn, arg_min(size, struct_pack(r := read, o := ord)) AS first_size, string_agg(d::VARCHAR, ',' ORDER BY read, ord) AS sizes FROM k GROUP BY ALL""")
def oriented_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return s.read_adjacent_pairs(_oriented(spark, sf))


@query(f"""WITH RECURSIVE {_WALK}, u AS (SELECT from_sv AS a, to_sv AS b FROM k UNION SELECT to_sv, from_sv FROM k), w(a, b) AS (SELECT a, a FROM u UNION SELECT w.a, u.b FROM w JOIN u ON w.b = u.a), c AS (SELECT a, min(b) AS root FROM w GROUP BY a), x AS (SELECT root, count(*) AS n_variants FROM c GROUP BY root)
SELECT root AS first_variant, n_variants, (SELECT sum(size) FROM k JOIN c ON k.from_sv = c.a WHERE c.root = x.root)::BIGINT AS total_size FROM x""")
def link_rearrangements(spark: SparkSession, sf: str) -> DataFrame:
    """Here each variant stands between two others at most, so a component is one path: its length and size are known."""
    r = _oriented(spark, sf)
    paths = s.link_rearrangements(s.oriented_pairs(r), r.select("sv_id", "chr1", "pos1", "dir1", "chr2", "pos2", "dir2").distinct())
    return paths.groupBy("path").agg(F.min("sv_id").alias("first_variant"), F.count(F.lit(1)).alias("n_variants"), F.sum("size").alias("total_size")).drop("path")
