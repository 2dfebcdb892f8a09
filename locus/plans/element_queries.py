"""Queries over inserted sequences, elements, and the numeric steps of copy number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.operators import copynumber as c
from locus.operators import density as kde
from locus.operators import elements as e
from locus.operators import lift

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


def text(c_: str) -> F.Column:
    return F.col(c_).cast("string")


# alignments of inserts


@query(f"""WITH {sql('blocks')}, a AS (SELECT read, contig, strand, "start" AS s, q, mapq % 4 + 1 AS h FROM blocks), p AS (SELECT *, s AS s1, s + q + 5 AS e1, 5 AS q1, q + 8 AS z1, s + q + 55 AS s2, s + q + 75 AS e2, q + 8 AS q2, q + 29 AS z2, q + 29 + h AS n FROM a),
u AS (SELECT read, contig, strand, s1 AS "start", e1 AS "end", CASE WHEN strand = '-' THEN n - z1 ELSE q1 END AS q_start, CASE WHEN strand = '-' THEN n - q1 ELSE z1 END AS q_end FROM p UNION ALL SELECT read, contig, strand, s2, e2, CASE WHEN strand = '-' THEN n - z2 ELSE q2 END, CASE WHEN strand = '-' THEN n - q2 ELSE z2 END FROM p) SELECT * FROM u""")
def aligned_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Clips, a deletion, an intron, an insertion and hard clips on both strands."""
    cigar = F.concat(F.lit("5S"), text("q"), F.lit("M2D3M50N9M1I11M"), (F.col("mapq") % 4 + 1).cast("string"), F.lit("H"))
    return e.aligned_blocks(standin(spark, sf, "blocks").select("read", "contig", "strand", "start", cigar.alias("cigar")))


_SUPPORT = """b AS (SELECT 'i' || (read // 80) AS k, contig, "start" AS bs, "end" AS be, strand, 5 AS qs, 5 + "end" - "start" AS qe FROM blocks),
x AS (SELECT b.*, brand AS tx, size, r."start" AS es, r."end" AS ee, least(be, r."end") - greatest(bs, r."start") AS o FROM b JOIN regions r ON b.contig = r.contig AND r."start" < be AND r."end" > bs),
y AS (SELECT *, CASE WHEN es - bs > 10 AND strand = '+' THEN least(qe, qs + es - bs) ELSE qs END AS a1, CASE WHEN es - bs > 10 AND strand = '-' THEN greatest(qs, qe - (es - bs)) ELSE qe END AS z1 FROM x),
z AS (SELECT *, CASE WHEN be - ee > 10 AND strand = '-' THEN least(z1, a1 + be - ee) ELSE a1 END AS a2, CASE WHEN be - ee > 10 AND strand = '+' THEN greatest(a1, z1 - (be - ee)) ELSE z1 END AS z2 FROM y),
g AS (SELECT k AS insert_key, tx AS transcript, sum(least(o, qe - qs))::BIGINT / 400 AS ratio, sum(CASE WHEN o >= 0.95 * (ee - es) AND o >= 0.95 * (be - bs) THEN 1 ELSE 0 END)::BIGINT AS n_exons,
string_agg((a2 + 1) || ',' || z2 || ',' || size || ',' || round(o / (ee - es), 4), ';' ORDER BY a2, z2, size::VARCHAR, o / (ee - es)) AS bars FROM z GROUP BY ALL), s AS (SELECT * FROM g WHERE ratio >= 0.5 AND n_exons >= 2)"""


def _support(spark: SparkSession, sf: str) -> DataFrame:
    q = F.col("end") - F.col("start")
    b = standin(spark, sf, "blocks").select(F.concat(F.lit("i"), F.expr("read div 80").cast("string")).alias("insert_key"), F.lit(400).alias("ins_len"), "contig", "start", "end", "strand", F.lit(5).cast("long").alias("q_start"), (q + 5).alias("q_end"))
    x = standin(spark, sf, "regions").select("contig", "start", "end", F.col("brand").alias("transcript"), text("size").alias("exon_number"))
    return e.exon_support(b, x)


@query(f"WITH {sql('blocks', 'regions')}, {_SUPPORT} SELECT insert_key, transcript, round(ratio, 4) AS match_ratio, n_exons, bars FROM s")
def exon_support(spark: SparkSession, sf: str) -> DataFrame:
    return _support(spark, sf)


@query(f"WITH {sql('blocks', 'regions')}, {_SUPPORT} SELECT insert_key, transcript, round(ratio, 4) AS match_ratio, n_exons FROM s QUALIFY row_number() OVER (PARTITION BY insert_key ORDER BY round(ratio, 4) DESC, n_exons DESC, transcript) = 1")
def best_pseudogene(spark: SparkSession, sf: str) -> DataFrame:
    return e.best_pseudogene(_support(spark, sf))


@query(f"""WITH {sql('blocks', 'regions')}, h AS (SELECT b.read, b."start", r.name, r.ord FROM blocks b JOIN regions r ON b.contig = r.contig AND r.ord % 20 = 0 AND b."end" > greatest(r."start" - 5000, 0) AND b."start" < r."end" + 5000), m AS (SELECT read, "start", arg_max(name, ord) AS site FROM h GROUP BY ALL)
SELECT DISTINCT b.read, b."start", m.site FROM blocks b LEFT JOIN m ON b.read = m.read AND b."start" = m."start" """)
def near_insertion_site(spark: SparkSession, sf: str) -> DataFrame:
    sites = standin(spark, sf, "regions").where("ord % 20 = 0").select("contig", "start", "end", F.col("name").alias("site"), "ord")
    return e.near_insertion_site(standin(spark, sf, "blocks").select("read", "contig", "start", "end"), sites, ["read", "contig", "start", "end"]).select("read", "start", "site").distinct()


_NEAR = """p AS (SELECT q AS read, contig, "start" AS s, "end" AS z FROM blocks WHERE flag = 0 AND mapq = 30), x AS (SELECT q AS read, contig, "start", "end" FROM blocks WHERE flag > 0)"""


@query(f"""WITH {sql('blocks')}, {_NEAR} SELECT DISTINCT x.*, FALSE AS same FROM x JOIN p USING (read) WHERE s - 5000 <= "end" AND z + 5000 >= "start" UNION ALL SELECT DISTINCT x.*, TRUE FROM x JOIN p ON x.read = p.read AND x.contig = p.contig WHERE s - 5000 <= "end" AND z + 5000 >= "start" """)
def supplementary_near_primary(spark: SparkSession, sf: str) -> DataFrame:
    b = standin(spark, sf, "blocks").select(F.col("q").alias("read"), "contig", "start", "end", "flag", "mapq")
    cols = ("read", "contig", "start", "end")
    primary, more = b.where("flag = 0 and mapq = 30").select(*cols), b.where("flag > 0").select(*cols)
    either = e.supplementary_near_primary(primary, more).withColumn("same", F.lit(False))
    return either.unionByName(e.supplementary_near_primary(primary, more, same_contig=True).withColumn("same", F.lit(True)))


_ALIGNED = """al AS (SELECT 'i' || (read % 300) AS k, read % 2 + 1 AS hap, contig, "start" AS s, "end" AS z, strand, q * 3 AS qs, q * 3 + 40 AS qz, read * 100 + q AS ord, CASE read % 300 % 3 WHEN 0 THEN 'polyA' WHEN 1 THEN 'polyT' END AS poly FROM blocks WHERE read % 300 < 200 OR read % 2 = 1),
en AS (SELECT k, hap, any_value(poly) AS poly, arg_min(struct_pack(contig := contig, s := s, z := z, strand := strand), struct_pack(e := CASE poly WHEN 'polyT' THEN qs WHEN 'polyA' THEN -qz ELSE 0 END, o := ord, c := contig, s := s, z := z, st := strand)) AS b FROM al GROUP BY k, hap, poly),
sl AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY hap) AS slot, b.contig AS contig, b.s AS s, b.z AS z, b.strand AS strand, poly FROM en)"""


def _alignments(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    r = F.col("read")
    key = F.concat(F.lit("i"), (r % 300).cast("string"))
    b = standin(spark, sf, "blocks").where("read % 300 < 200 or read % 2 = 1")
    a = b.select(key.alias("insert_key"), (r % 2 + 1).alias("hap"), "contig", "start", "end", "strand", (F.col("q") * 3).alias("q_start"), (F.col("q") * 3 + 40).alias("q_end"), (r * 100 + F.col("q")).alias("ord"))
    poly = b.select(key.alias("insert_key"), F.when(r % 300 % 3 == 0, "polyA").when(r % 300 % 3 == 1, "polyT").alias("poly")).distinct()
    return a, poly


@query(f"""WITH {sql('blocks')}, {_ALIGNED} SELECT k AS insert_key, slot, contig, s AS "start", z AS "end", strand, poly FROM sl""")
def end_alignments(spark: SparkSession, sf: str) -> DataFrame:
    return e.end_alignments(*_alignments(spark, sf)).withColumn("slot", F.col("slot").cast("long"))


def _elements(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("size")
    return standin(spark, sf, "regions").select("contig", "start", "end", F.when(size % 2 == 0, "+").otherwise("-").alias("strand"), F.concat("brand", text("ord")).alias("name"), "ord", (size % 3).alias("kind_rank"))


@query(f"""WITH {sql('blocks', 'regions')}, {_ALIGNED}, d AS (SELECT *, CASE WHEN (strand = '+' AND poly = 'polyT') OR (strand = '-' AND poly = 'polyA') THEN '+' ELSE '-' END AS dir FROM sl), w AS (SELECT k, min(dir) <> max(dir) AS discordant FROM d GROUP BY k),
l AS (SELECT contig, "start" AS ls, "end" AS lz, CASE WHEN size % 2 = 0 THEN '+' ELSE '-' END AS st, brand || ord AS name, ord, size % 3 AS kr FROM regions),
j AS (SELECT d.k, d.slot, CASE WHEN d.dir = '+' THEN d.s - 50 ELSE d.s - 5000 END AS a, CASE WHEN d.dir = '+' THEN d.s + 5000 ELSE d.z + 50 END AS b, d.dir, d.contig FROM d JOIN w USING (k) WHERE NOT discordant AND poly IS NOT NULL),
h AS (SELECT j.k, j.slot, CASE WHEN any_value(dir) = '+' THEN arg_max(name, struct_pack(x := -ls, y := -kr, o := ord)) FILTER (st = '-') ELSE arg_max(name, struct_pack(y := -kr, x := ls, o := ord)) FILTER (st = '+') END AS src FROM j JOIN l ON j.contig = l.contig AND ls < b AND lz > a AND a >= 0 GROUP BY j.k, j.slot)
SELECT w.k AS insert_key, w.discordant, max(src) FILTER (slot = 1) AS source_1, max(src) FILTER (slot = 2) AS source_2 FROM w LEFT JOIN h USING (k) GROUP BY ALL""")
def transduction_sources(spark: SparkSession, sf: str) -> DataFrame:
    return e.transduction_sources(*_alignments(spark, sf), _elements(spark, sf))


@query(f"""WITH {sql('regions')}, r AS (SELECT ord, CASE size % 5 WHEN 0 THEN 'Simple_LINE1' WHEN 1 THEN 'Alu' WHEN 2 THEN 'SVA' WHEN 3 THEN 'Inverted_LINE1' END AS rc, CASE WHEN ord % 3 = 0 THEN brand END AS s1, CASE WHEN ord % 4 = 0 THEN kind END AS s2, (ord % 30) / 1000.0 AS l1, CASE WHEN ord % 2 = 0 THEN name END AS psd FROM regions),
k AS (SELECT *, CASE WHEN l1 < 0.01 THEN 'Orphan' ELSE 'Partnered' END AS known, CASE WHEN rc LIKE '%LINE1' THEN 'Solo' END AS solo FROM r), t AS (SELECT *, CASE WHEN s1 IS NOT NULL THEN known ELSE solo END AS c1, CASE WHEN s2 IS NOT NULL THEN known WHEN s1 IS NOT NULL THEN known ELSE solo END AS c2 FROM k)
SELECT ord, c1 AS class_1, c2 AS class_2, CASE WHEN 'Orphan' IN (coalesce(c1, ''), coalesce(c2, '')) THEN 'Orphan_L1' WHEN 'Partnered' IN (coalesce(c1, ''), coalesce(c2, '')) THEN 'Partnered_L1' WHEN 'Solo' IN (coalesce(c1, ''), coalesce(c2, '')) THEN 'Solo_L1' WHEN rc = 'Alu' THEN 'Alu' WHEN rc = 'SVA' THEN 'SVA' WHEN psd IS NOT NULL THEN 'PSD' END AS insert_type FROM t""")
def insertion_type(spark: SparkSession, sf: str) -> DataFrame:
    o, m = F.col("ord"), F.col("size") % 5
    r = standin(spark, sf, "regions").select("ord", F.when(m == 0, "Simple_LINE1").when(m == 1, "Alu").when(m == 2, "SVA").when(m == 3, "Inverted_LINE1").alias("rc"), F.when(o % 3 == 0, F.col("brand")).alias("s1"), F.when(o % 4 == 0, F.col("kind")).alias("s2"), ((o % 30) / 1000).alias("l1"), F.when(o % 2 == 0, F.col("name")).alias("psd"))
    first, second = e.transduction_class(F.col("rc"), F.col("s1"), F.col("s2"), F.col("l1"))
    r = r.withColumns({"class_1": first, "class_2": second})
    return r.select("ord", "class_1", "class_2", e.insertion_type(F.col("class_1"), F.col("class_2"), F.col("rc"), F.col("psd")).alias("insert_type"))


@query(f"""WITH {sql('regions')}, a AS (SELECT ord AS k, brand FROM regions WHERE ord % 2 = 0), b AS (SELECT ord AS k, size FROM regions WHERE ord % 3 = 0) SELECT coalesce(a.k, b.k) AS insert_key, coalesce(brand, '---') AS brand, coalesce(size, 0) AS size FROM a FULL JOIN b ON a.k = b.k""")
def union_keys(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "regions").withColumnRenamed("ord", "insert_key")
    return e.union_keys([r.where("insert_key % 2 = 0").select("insert_key", "brand"), r.where("insert_key % 3 = 0").select("insert_key", "size")], defaults={"brand": "---", "size": 0})


@query()
def insertion_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Every part of the evidence over all insertions; the parts know different ones."""
    v = standin(spark, sf, "svs")
    c_ = F.col
    tail = F.when(c_("sv") % 3 == 0, F.repeat(F.lit("A"), F.lit(12))).when(c_("sv") % 3 == 1, "").otherwise("GC")
    seq = F.concat(F.when(c_("sv") % 3 == 1, F.repeat(F.lit("T"), F.lit(14))).otherwise(""), F.repeat(F.lit("GATTC"), (c_("ins_len") / 20).cast("int")), tail)
    svs = v.withColumn("inserted", seq)
    keys = e.min_insert_len(svs).select("sv", "ck", "chr1", "pos1", "dir1", "insert_key", F.length("inserted").alias("n"), "inserted")
    repeat = F.when(c_("sv") % 4 == 0, "LINE/L1").when(c_("sv") % 4 == 1, "SINE/Alu").when(c_("sv") % 4 == 2, "Retroposon/SVA").otherwise("Simple")
    hits = keys.select("insert_key", c_("n").alias("ins_len"), F.lit(0).cast("long").alias("start"), (c_("n") - c_("ck") % 90).cast("long").alias("end"), F.lit("+").alias("strand"), F.lit("r").alias("repeat"), repeat.alias("family"), c_("sv").alias("ord"))
    al = keys.where("ck % 2 = 0").select("insert_key", (c_("sv") % 2 + 1).alias("hap"), c_("chr1").alias("contig"), c_("pos1").alias("start"), (c_("pos1") + 80).alias("end"), c_("dir1").alias("strand"), F.lit(1).cast("long").alias("q_start"), F.lit(80).cast("long").alias("q_end"), c_("sv").alias("ord"))
    tsd = e.target_site_duplication(keys.select("insert_key", c_("inserted").alias("seq"), F.substring("inserted", 2, 21).alias("right"), F.reverse("inserted").alias("seq_rc"), F.lit("").alias("left")))
    support = keys.where("ck % 5 = 0").select("insert_key", F.lit("tx").alias("transcript"), F.lit(0.9).alias("match_ratio"), F.lit(3).cast("long").alias("n_exons"))
    out = e.insertion_evidence(svs, e.repeat_composition(hits), al, _elements(spark, sf), tsd, e.best_pseudogene(support))
    return out.select("sv_id", "insert_key", "insert_type", "is_inversion", "poly", "source_1", "source_2", "class_1", "class_2", "tsd_len", "transcript", F.round("l1_ratio", 6).alias("l1_ratio"))


# elements


_LOCI = """lo AS (SELECT ord AS locus, contig, "start" * 100 AS s, "start" * 100 + 6500 AS z, CASE WHEN size % 2 = 0 THEN '+' ELSE '-' END AS strand FROM regions WHERE ord < 100),
th AS (SELECT ord % 120 AS locus, 'F' || size % 4 AS family, size * 10.0 + ord % 7 + ord / 1000000.0 AS bits, kind AS model, 5500 + ord % 500 AS lo, 6000 + ord % 300 AS hi FROM regions), fi AS (SELECT (ord * 7) % 90 AS locus, size + ord / 1000000.0 AS bits, (ord % 40) * 10 AS lo FROM regions),
bf AS (SELECT locus, family, max(struct_pack(bits := bits, model := model, lo := lo, hi := hi)) AS b FROM th GROUP BY ALL), tp AS (SELECT locus, max(struct_pack(bits := b.bits, model := b.model, family := family, lo := b.lo, hi := b.hi)) AS t FROM bf GROUP BY locus),
ff AS (SELECT bf.locus, string_agg(family, '/' ORDER BY b.bits DESC, b.model DESC, family DESC) AS family FROM bf JOIN tp USING (locus) WHERE family IN ('F0', 'F1', 'F2') AND b.bits >= t.bits - 3 GROUP BY bf.locus),
f5 AS (SELECT fi.locus, arg_max(fi.lo, struct_pack(b := fi.bits, l := fi.lo)) AS s5 FROM fi JOIN tp USING (locus) WHERE fi.lo < t.lo GROUP BY fi.locus),
re AS (SELECT lo.locus, contig, strand, CASE WHEN t.family <> 'F3' THEN ff.family END AS family, CASE WHEN t IS NULL THEN 'no_three_end' WHEN t.family = 'F3' THEN 'old_family' WHEN s5 IS NULL THEN 'no_five_end' WHEN t.hi - s5 NOT BETWEEN 5800 AND 6300 THEN 'span' END AS reason,
CASE WHEN strand = '-' THEN z - t.hi ELSE s + s5 END AS "start", CASE WHEN strand = '-' THEN z - s5 ELSE s + t.hi END AS "end" FROM lo LEFT JOIN tp USING (locus) LEFT JOIN ff USING (locus) LEFT JOIN f5 USING (locus))"""


def _refined(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "regions")
    o, small = F.col("ord"), F.col("ord") / 1000000
    loci = r.where("ord < 100").select(o.alias("locus"), "contig", (F.col("start") * 100).alias("start"), (F.col("start") * 100 + 6500).alias("end"), F.when(F.col("size") % 2 == 0, "+").otherwise("-").alias("strand"))
    three = r.select((o % 120).alias("locus"), F.concat(F.lit("F"), (F.col("size") % 4).cast("string")).alias("family"), (F.col("size") * 10.0 + o % 7 + small).alias("bits"), F.col("kind").alias("model"), (5500 + o % 500).alias("lo"), (6000 + o % 300).alias("hi"))
    five = r.select((o * 7 % 90).alias("locus"), (F.col("size") + small).alias("bits"), ((o % 40) * 10).alias("lo"))
    return e.refine_elements(loci, three, five, ["F0", "F1", "F2"])


@query(f"""WITH {sql('regions')}, {_LOCI} SELECT locus, contig, "start", "end", strand, family, reason FROM re""")
def refine_elements(spark: SparkSession, sf: str) -> DataFrame:
    return _refined(spark, sf).drop("name")


@query(f"""WITH {sql('regions')}, {_LOCI} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM re GROUP BY 1""")
def refine_summary(spark: SparkSession, sf: str) -> DataFrame:
    return e.refine_summary(_refined(spark, sf))


# alignments without overlaps


@query(f"""WITH {sql('reftable')}, b AS (SELECT contig AS chain_id, contig % 10 AS contig, c_start AS s, c_end AS e, strand, chrom, r_start AS d0, r_start + c_end - c_start AS d1 FROM reftable),
m AS (SELECT *, greatest(coalesce(max(e) OVER (PARTITION BY contig ORDER BY s, e, chain_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), s) - s, 0) AS k FROM b), n AS (SELECT chain_id, contig, s + k AS s, e, strand, chrom, CASE WHEN strand = '-' THEN d0 ELSE d0 + k END AS d0, CASE WHEN strand = '-' THEN d1 - k ELSE d1 END AS d1 FROM m WHERE k < e - s),
o AS (SELECT *, greatest(coalesce(max(d1) OVER (PARTITION BY chrom ORDER BY d0, d1, chain_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), d0) - d0, 0) AS k FROM n)
SELECT chain_id, CASE WHEN strand = '-' THEN s ELSE s + k END AS "start", CASE WHEN strand = '-' THEN e - k ELSE e END AS "end", d0 + k AS d0, d1 FROM o WHERE k < d1 - d0""")
def trim_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "reftable")
    b = r.select(F.col("contig").alias("chain_id"), (F.col("contig") % 10).alias("contig"), F.col("c_start").alias("start"), F.col("c_end").alias("end"), "strand", F.col("chrom").alias("dst_contig"), F.col("r_start").alias("d0"), (F.col("r_start") + F.col("c_end") - F.col("c_start")).alias("d1"))
    return lift.trim_overlaps(b).select("chain_id", "start", "end", "d0", "d1")


# depth values

_V = "o AS (SELECT sample, chrom, w, min(tumor_depth) / 90000.0 AS v FROM depths GROUP BY ALL)"
_SMOOTH = f"""{_V}, n AS (SELECT *, list_sort(list_concat(coalesce(list(v) OVER (g ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), []), coalesce(list(v) OVER (g ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING), []))) AS l, stddev_samp(v) OVER (PARTITION BY sample, chrom) AS sd FROM o WINDOW g AS (PARTITION BY sample, chrom ORDER BY w)),
s AS (SELECT sample, chrom, w, CASE WHEN len(l) = 0 THEN v WHEN v > l[-1] + 0.2 * sd THEN l[len(l) // 2 + 1] + 2 * sd WHEN v < l[1] - 0.2 * sd THEN l[len(l) // 2 + 1] - 2 * sd ELSE v END AS smoothed FROM n)"""


def _smooth(spark: SparkSession, sf: str) -> DataFrame:
    v = standin(spark, sf, "depths").groupBy("sample", "chrom", "w").agg((F.min("tumor_depth") / 90000).alias("ratio")).withColumnRenamed("w", "window_index")
    return c.smooth_outliers(v, ["sample", "chrom"], limit=0.2)


@query(f"WITH {sql('depths')}, {_SMOOTH} SELECT sample, chrom, w AS window_index, round(smoothed, 6) AS smoothed FROM s")
def smooth_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return _smooth(spark, sf).select("sample", "chrom", "window_index", F.round("smoothed", 6).alias("smoothed"))


@query(f"""WITH {sql('depths')}, {_SMOOTH}, d AS (SELECT sample, smoothed - lag(smoothed) OVER (PARTITION BY sample, chrom ORDER BY w) AS d FROM s), q AS (SELECT sample, quantile_cont(d, 0.025) AS a, quantile_cont(d, 0.975) AS b FROM d GROUP BY sample)
SELECT d.sample, round(stddev_samp(d) / sqrt(2), 5) AS sd FROM d JOIN q ON d.sample = q.sample WHERE d BETWEEN a AND b GROUP BY d.sample""")
def trimmed_sd(spark: SparkSession, sf: str) -> DataFrame:
    return c.trimmed_sd(_smooth(spark, sf), ["sample"], inside=["chrom"]).select("sample", F.round("sd", 5).alias("sd"))


_D = "((k * step / ({h})) ** 2)"
_F4 = f"(2 * sum(p * exp(-{_D} / 2) * ({_D} ** 2 - 6 * {_D} + 3)) + any_value(n) * 3) / any_value(n * (n - 1) * ({{h}}) ** 5 * sqrt(2 * pi()))"
_F6 = f"(2 * sum(p * exp(-{_D} / 2) * ({_D} ** 3 - 15 * {_D} ** 2 + 45 * {_D} - 15)) - any_value(n) * 15) / any_value(n * (n - 1) * ({{h}}) ** 7 * sqrt(2 * pi()))"
_EXCESS = f"(CASE WHEN {_F4.format(h='al * {h} ** (5.0 / 7)')} > 0 THEN (1 / (2 * sqrt(pi()) * any_value(n) * ({_F4.format(h='al * {h} ** (5.0 / 7)')}))) ** 0.2 END - any_value({{h}}))"
#: The bandwidth: a bracket from a tenth of the normal rule's width up to it is widened by 1.2, above and below in turn, until it holds
#: a root, and halved 100 times. Then the kernel over cells that share out each value.
_KDE = f"""x AS (SELECT sample, hap, tumor_depth / normal_depth * 9 AS x FROM depths WHERE tumor_depth / normal_depth * 9 > 0.3 AND tumor_depth / normal_depth * 9 < 5),
m AS (SELECT sample, hap, count(*)::DOUBLE AS n, (max(x) - min(x)) * 1.01 / 1000 AS step, least(stddev_samp(x), (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / 1.349) AS scale FROM x GROUP BY ALL HAVING count(*) >= 100),
b AS (SELECT x.sample, x.hap, floor(x / step) AS b, count(*)::DOUBLE AS c FROM x JOIN m ON x.sample = m.sample AND x.hap = m.hap GROUP BY ALL),
k AS (SELECT b.sample, b.hap, abs(b.b - z.b) AS k, sum(CASE WHEN b.b = z.b THEN b.c * (b.c - 1) / 2 ELSE b.c * z.c END) AS p FROM b JOIN b z ON b.sample = z.sample AND b.hap = z.hap AND b.b <= z.b GROUP BY ALL),
km AS (SELECT k.*, n, step, scale FROM k JOIN m ON k.sample = m.sample AND k.hap = m.hap),
al AS (SELECT sample, hap, 1.357 * ({_F4.format(h="1.24 * scale * n ** (-1.0 / 7)")} / -({_F6.format(h="1.23 * scale * n ** (-1.0 / 9)")})) ** (1.0 / 7) AS al FROM km GROUP BY ALL),
r AS (SELECT m.sample, m.hap, 0 AS i, 0 AS halved, 0.1144 * scale * n ** -0.2 AS lo, 1.144 * scale * n ** -0.2 AS hi, FALSE AS rising, al FROM m JOIN al ON m.sample = al.sample AND m.hap = al.hap
  UNION ALL SELECT sample, hap, CASE WHEN found THEN i ELSE i + 1 END, CASE WHEN found THEN halved + 1 ELSE 0 END,
    CASE WHEN found THEN CASE WHEN (e_mid > 0) = up THEN lo ELSE (lo + hi) / 2 END WHEN i % 2 = 1 THEN lo / 1.2 ELSE lo END, CASE WHEN found THEN CASE WHEN (e_mid > 0) = up THEN (lo + hi) / 2 ELSE hi END WHEN i % 2 = 0 THEN hi * 1.2 ELSE hi END, up, al FROM (
    SELECT *, halved > 0 OR coalesce(e_lo * e_hi <= 0, FALSE) AS found, CASE WHEN halved > 0 THEN rising ELSE coalesce(e_hi > e_lo, FALSE) END AS up FROM (
      SELECT r.sample, r.hap, any_value(i) AS i, any_value(halved) AS halved, any_value(lo) AS lo, any_value(hi) AS hi, any_value(rising) AS rising, any_value(al) AS al, {_EXCESS.format(h="lo")} AS e_lo, {_EXCESS.format(h="hi")} AS e_hi, {_EXCESS.format(h="((lo + hi) / 2)")} AS e_mid
      FROM r JOIN km ON r.sample = km.sample AND r.hap = km.hap WHERE i < 100 AND halved < 100 GROUP BY r.sample, r.hap)) WHERE NOT found OR e_mid IS NOT NULL),
h AS (SELECT sample, hap, (lo + hi) / 2 AS h FROM r WHERE halved = 100),
c AS (SELECT x.sample, x.hap, (x - 0.3) / 4.7 * 2047 AS pl FROM x JOIN m ON x.sample = m.sample AND x.hap = m.hap),
v AS (SELECT sample, hap, a AS cell, sum(w) AS w FROM (SELECT sample, hap, floor(pl) AS a, 1 - (pl - floor(pl)) AS w FROM c UNION ALL SELECT sample, hap, floor(pl) + 1, pl - floor(pl) FROM c) GROUP BY ALL),
g AS (SELECT unnest(range(2048)) AS i),
d AS (SELECT v.sample, v.hap, i, 0.3 + i * (4.7 / 2047) AS gx, sum(w * exp(-0.5 * ((i - cell) * 4.7 / 2047 / h) ** 2)) / (sum(w) * any_value(h) * sqrt(2 * pi())) AS y FROM v JOIN h ON v.sample = h.sample AND v.hap = h.hap, g GROUP BY ALL)"""


def _kde(spark: SparkSession, sf: str) -> DataFrame:
    d = standin(spark, sf, "depths").select("sample", "hap", (F.col("tumor_depth") / F.col("normal_depth") * 9).alias("x"), F.lit(1.0).alias("one"))
    return kde.density(d.where("x > 0.3 and x < 5"), ["sample", "hap"], "x", "one", 0.3, 5.0, least=100)


@query(f"""WITH RECURSIVE {sql('depths')}, {_KDE}, p AS (SELECT *, lag(y) OVER k AS a, lead(y) OVER k AS z, max(y) OVER (PARTITION BY sample, hap) AS top FROM d WINDOW k AS (PARTITION BY sample, hap ORDER BY i)),
rk AS (SELECT *, row_number() OVER (PARTITION BY sample, hap ORDER BY y DESC, i) AS r FROM p WHERE y > a AND y > z AND y >= 0.2 * top) SELECT sample, hap, round(gx, 6) AS x, round(y, 6) AS density FROM rk WHERE r <= 8""")
def detect_peaks(spark: SparkSession, sf: str) -> DataFrame:
    return kde.detect_peaks(_kde(spark, sf), ["sample", "hap"]).select("sample", "hap", F.round("x", 6).alias("x"), F.round("density", 6).alias("density"))


@query(f"""WITH RECURSIVE {sql('depths')}, {_KDE} SELECT sample, hap, round(arg_max(gx, struct_pack(y := y, i := -i)), 6) AS level FROM d GROUP BY ALL""")
def dominant_level(spark: SparkSession, sf: str) -> DataFrame:
    return kde.dominant_level(_kde(spark, sf), ["sample", "hap"]).select("sample", "hap", F.round("level", 6).alias("level"))
