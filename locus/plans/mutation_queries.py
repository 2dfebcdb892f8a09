"""Queries over point mutations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.operators import variants as v

from .standins import distinct_rows, sql, standin

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(text: str | None = None):  # noqa: ANN201
    def put(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if text is not None:
            SQL[f.__name__] = text
        return f

    return put


KEYS = ["site", "contig", "start", "end"]
_S = 's AS (SELECT DISTINCT site, contig, "start", "end" FROM sites)'


def sites(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_rows(spark, sf, "sites", KEYS)


def _first(payload: str, where: str = "TRUE") -> str:
    return f"""WITH {sql('sites', 'regions')}, {_S}, h AS (SELECT s.site, s.contig, s."start", s."end", arg_min(r.ord, r."start" * 100000 + r.ord) AS o FROM s JOIN regions r ON s.contig = r.contig AND s."start" >= r."start" AND s."end" <= r."end" AND {where} GROUP BY ALL)
SELECT s.site, s.contig, s."start", s."end", {payload} FROM s LEFT JOIN h ON s.site = h.site AND s.contig = h.contig AND s."start" = h."start" AND s."end" = h."end" LEFT JOIN regions r ON r.ord = h.o"""


@query(_first("r.brand AS rmsk_class, r.kind AS rmsk_type"))
def annotate_repeat(spark: SparkSession, sf: str) -> DataFrame:
    track = standin(spark, sf, "regions").select("contig", "start", "end", "ord", F.col("brand").alias("rmsk_class"), F.col("kind").alias("rmsk_type"))
    return v.annotate_repeat(sites(spark, sf), track, KEYS)


@query(_first("r.name AS centromere", "r.size >= 25"))
def annotate_centromere(spark: SparkSession, sf: str) -> DataFrame:
    track = standin(spark, sf, "regions").where("size >= 25").select("contig", "start", "end", "ord", F.col("name").alias("centromere"))
    return v.annotate_centromere(sites(spark, sf), track, KEYS)


@query(_first("r.size AS similarity, r.size IS NOT NULL AS segdup", "r.size > 20"))
def annotate_segdup(spark: SparkSession, sf: str) -> DataFrame:
    track = standin(spark, sf, "regions").where("size > 20").select("contig", "start", "end", "ord", F.col("size").alias("similarity"))
    return v.annotate_segdup(sites(spark, sf), track, KEYS)


@query(f"""WITH {sql('sites', 'regions')}, {_S} SELECT s.*, EXISTS (SELECT 1 FROM regions r WHERE r.size < 12 AND s.contig = r.contig AND s."start" >= r."start" AND s."end" <= r."end") AS misassembly FROM s""")
def annotate_misassembly(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "regions").where("size < 12").select("contig", "start", "end", "ord")
    return v.annotate_misassembly(sites(spark, sf), r.where("ord % 2 = 0").drop("ord"), r.where("ord % 2 = 1").drop("ord"), KEYS)


_GENES = """f AS (SELECT contig, "start", "end", ord, CASE ord % 3 WHEN 0 THEN 'exon' WHEN 1 THEN 'CDS' ELSE 'gene' END AS feature, 'G' || (ord // 4) AS gene, 'T' || (ord // 2) AS tx FROM regions)"""


@query(f"""WITH {sql('sites', 'regions')}, {_S}, {_GENES},
h AS (SELECT s.site, s.contig, s."start", s."end", f.gene, f.tx, f.feature, f."start" * 1000000 + f.ord AS o FROM s JOIN f ON s.contig = f.contig AND s."start" >= f."start" AND s."end" <= f."end" WHERE feature <> 'gene'),
t AS (SELECT site, contig, "start", "end", gene, tx, arg_max(feature, o) AS feature, min(o) AS o FROM h GROUP BY ALL),
g AS (SELECT site, contig, "start", "end", gene, min(o) AS o, string_agg(tx || ':' || feature, ',' ORDER BY o) AS ts FROM t GROUP BY ALL),
a AS (SELECT site, contig, "start", "end", string_agg(gene, ';' ORDER BY o) AS genes, string_agg(ts, ';' ORDER BY o) AS transcripts FROM g GROUP BY ALL) SELECT s.*, genes, transcripts FROM s LEFT JOIN a USING (site, contig, "start", "end")""")
def annotate_genes(spark: SparkSession, sf: str) -> DataFrame:
    return v.annotate_genes(sites(spark, sf), _features(spark, sf), KEYS)


def _features(spark: SparkSession, sf: str) -> DataFrame:
    name = lambda p, n: F.concat(F.lit(p), F.expr(f"ord div {n}").cast("string"))
    kind = F.when(F.col("ord") % 3 == 0, "exon").when(F.col("ord") % 3 == 1, "CDS").otherwise("gene")
    return standin(spark, sf, "regions").select("contig", "start", "end", "ord", kind.alias("feature"), F.lit("protein_coding").alias("biotype"), name("G", 4).alias("gene"), name("I", 4).alias("gene_id"), name("T", 2).alias("transcript"))


@query(f"""WITH {sql('sites', 'regions')}, {_S}, {_GENES}, h AS (SELECT DISTINCT s.site, s.contig, s."start", s."end", f.gene FROM s JOIN f ON s.contig = f.contig AND s."start" >= f."start" AND s."end" <= f."end" WHERE feature <> 'gene' AND f.gene LIKE '%1'),
a AS (SELECT site, contig, "start", "end", string_agg(gene, ',' ORDER BY gene) AS cancer FROM h GROUP BY ALL) SELECT s.*, coalesce(cancer, 'False') AS cancer FROM s LEFT JOIN a USING (site, contig, "start", "end")""")
def flag_gene_sets(spark: SparkSession, sf: str) -> DataFrame:
    f = _features(spark, sf)
    out = v.flag_gene_sets(v.annotate_genes(sites(spark, sf), f, KEYS), f.select("gene").where("gene like '%1'"), "cancer", KEYS)
    return out.select(*KEYS, "cancer")


@query(f"""WITH {sql('sites')}, m AS (SELECT DISTINCT site, contig, "start", ref, alt FROM sites), o AS (SELECT DISTINCT contig, "start", ref, alt FROM sites WHERE ln >= 4) SELECT m.*, o.ref IS NOT NULL AS other_caller FROM m LEFT JOIN o USING (contig, "start", ref, alt)""")
def match_other_caller(spark: SparkSession, sf: str) -> DataFrame:
    s = standin(spark, sf, "sites")
    return v.match_other_caller(s.select("site", "contig", "start", "ref", "alt").distinct(), s.where("ln >= 4"))


_CANON = "least(struct_pack(r := ref, a := alt), struct_pack(r := reverse(translate(ref, 'ACGT', 'TGCA')), a := reverse(translate(alt, 'ACGT', 'TGCA'))))"


@query(f"""WITH {sql('sites')}, m AS (SELECT DISTINCT site, contig, "start", ref, alt FROM sites), k AS (SELECT *, {_CANON} AS c FROM m),
p AS (SELECT contig, "start", {_CANON} AS c, arg_min(contig || ',' || "start" || ',x,' || ref || ',' || alt, site * 100 + length(ref)) AS population FROM (SELECT DISTINCT site, contig, "start", ref, alt FROM sites WHERE ln < 5) GROUP BY ALL)
SELECT k.site, k.contig, k."start", k.ref, k.alt, population FROM k LEFT JOIN p ON k.contig = p.contig AND k."start" = p."start" AND k.c = p.c""")
def annotate_population(spark: SparkSession, sf: str) -> DataFrame:
    s = standin(spark, sf, "sites").select("site", "contig", "start", "ref", "alt", "ln").distinct()
    left = s.drop("ln").distinct().select("site", "contig", "start", "ref", "alt", F.col("contig").alias("ref_contig"), F.col("start").alias("ref_pos"))
    pop = s.where("ln < 5").select("contig", F.col("start").alias("pos"), "ref", "alt", F.lit("x").alias("id"), (F.col("site") * 100 + F.length("ref")).alias("ord"))
    return v.annotate_population(left, pop, ["site", "contig", "start", "ref", "alt"]).drop("ref_contig", "ref_pos")


@query(f"""WITH {sql('sites', 'regions')}, {_S}, l AS (SELECT contig, max("end") AS contig_length FROM regions GROUP BY contig) SELECT s.*, contig_length FROM s JOIN l USING (contig)""")
def contig_size(spark: SparkSession, sf: str) -> DataFrame:
    return v.contig_size(sites(spark, sf), standin(spark, sf, "regions").groupBy("contig").agg(F.max("end").alias("length")))


@query(f"""WITH {sql('sites')}, m AS (SELECT DISTINCT site, contig, "start", ref, alt FROM sites) SELECT *, length(ref) = length(alt) AS snv FROM m""")
def split_snv_indel(spark: SparkSession, sf: str) -> DataFrame:
    snv, indel = v.split_snv_indel(standin(spark, sf, "sites").select("site", "contig", "start", "ref", "alt").distinct())
    return snv.withColumn("snv", F.lit(True)).unionByName(indel.withColumn("snv", F.lit(False)))


@query("""WITH r AS (SELECT p_partkey AS ord, p_partkey % 7 AS contig, p_partkey * 3 + 1 AS pos, 'AC' AS ref, 'A,ACC' AS alt, (p_size % 30) AS d, p_size / 100 AS v FROM part WHERE p_size % 3 = 0),
e AS (SELECT *, unnest([0, 1]) AS k FROM r)
SELECT contig, pos - 1 AS "start", pos + 1 AS "end", ref, CASE k WHEN 0 THEN 'A' ELSE 'ACC' END AS alt, 9.5::DOUBLE AS score, CASE k WHEN 0 THEN v ELSE 1.0 END AS vaf, d AS depth, 0.0::DOUBLE AS normal_vaf, 0 AS normal_depth, 'ID_' || (row_number() OVER (ORDER BY ord, k) - 1) AS id FROM e""")
def parse_caller_vcf(spark: SparkSession, sf: str) -> DataFrame:
    p = spark.read.parquet(f"{sf}/part.parquet")
    text = F.concat_ws(":", F.lit("GT"), F.lit("q"), (F.col("p_size") % 30).cast("string"), F.lit("x"), F.concat((F.col("p_size") / 100).cast("string"), F.lit(",1")))
    vcf = p.select(F.col("p_partkey").alias("ord"), (F.col("p_partkey") % 7).alias("contig"), (F.col("p_partkey") * 3 + 1).alias("pos"), F.lit("AC").alias("ref"), F.lit("A,ACC").alias("alt"), F.lit(9.5).alias("qual"), F.when(F.col("p_size") % 3 == 0, "PASS").otherwise("LowQual").alias("filter"), text.alias("sample"))
    return v.parse_caller_vcf(vcf, "deepsomatic")


@query("""WITH r AS (SELECT p_partkey AS ord, p_partkey % 7 AS contig, p_partkey * 3 + 1 AS pos, p_size AS n FROM part WHERE p_size % 3 <> 0)
SELECT contig, pos - 1 AS "start", pos AS "end", 'G' AS ref, 'T' AS alt, 7.0::DOUBLE AS score, n / 64 AS vaf, n % 30 AS depth, n / 128 AS normal_vaf, n AS normal_depth, 'ID_' || (row_number() OVER (ORDER BY ord) - 1) AS id FROM r""")
def parse_first_caller_vcf(spark: SparkSession, sf: str) -> DataFrame:
    """The layout with the normal's VAF and depth in the sample field."""
    p, n = spark.read.parquet(f"{sf}/part.parquet"), F.col("p_size")
    text = F.concat_ws(":", F.lit("GT"), F.lit("q"), (n % 30).cast("string"), (n / 64).cast("string"), F.lit("x"), (n / 128).cast("string"), n.cast("string"))
    vcf = p.select(F.col("p_partkey").alias("ord"), (F.col("p_partkey") % 7).alias("contig"), (F.col("p_partkey") * 3 + 1).alias("pos"), F.lit("G").alias("ref"), F.lit("T").alias("alt"), F.lit(7.0).alias("qual"), F.when(n % 3 != 0, "PASS").otherwise("LowQual").alias("filter"), text.alias("sample"))
    return v.parse_caller_vcf(vcf, "clairs")


@query(f"""WITH {sql('sites', 'regions')}, {_S}, {_GENES}, k AS (SELECT * FROM f WHERE feature <> 'gene' AND gene LIKE '%2' AND tx LIKE '%4'),
h AS (SELECT s.site, s.contig, s."start", s."end", k.gene, k.tx, k.feature, k."start" * 1000000 + k.ord AS o FROM s JOIN k ON s.contig = k.contig AND s."start" >= k."start" AND s."end" <= k."end"),
t AS (SELECT site, contig, "start", "end", gene, tx, arg_max(feature, o) AS feature, min(o) AS o FROM h GROUP BY ALL), g AS (SELECT site, contig, "start", "end", gene, min(o) AS o, string_agg(tx || ':' || feature, ',' ORDER BY o) AS ts FROM t GROUP BY ALL),
a AS (SELECT site, contig, "start", "end", string_agg(gene, ';' ORDER BY o) AS genes, string_agg(ts, ';' ORDER BY o) AS transcripts FROM g GROUP BY ALL) SELECT s.*, genes, transcripts FROM s LEFT JOIN a USING (site, contig, "start", "end")""")
def annotate_genes_mane(spark: SparkSession, sf: str) -> DataFrame:
    """Only the transcripts that a summary of chosen ones lists; a gene of another id does not count."""
    f = _features(spark, sf)
    chosen = f.where("gene like '%2' and transcript like '%4'").groupBy("gene", "gene_id").agg(F.collect_set("transcript").alias("transcripts"))
    wrong = f.where("gene like '%3'").groupBy("gene").agg(F.lit("other").alias("gene_id"), F.collect_set("transcript").alias("transcripts"))
    return v.annotate_genes(sites(spark, sf), f, KEYS, chosen.select("gene", "gene_id", "transcripts").unionByName(wrong))


@query(f"""WITH {sql('regions')}, f AS (SELECT DISTINCT 'G' || (ord // 4) AS gene, 'T' || (ord // 2) || '.1' AS transcript FROM regions), p AS (SELECT gene || ':' || transcript || ':' || regexp_replace(transcript, '[.]1$', '.2') AS pair FROM f WHERE CAST(substr(gene, 2) AS INT) % 2 = 0)
SELECT count(*) AS n, (SELECT string_agg(pair, ',' ORDER BY pair) FROM (SELECT pair FROM p ORDER BY pair LIMIT 3)) AS examples FROM p""")
def mane_mismatch_report(spark: SparkSession, sf: str) -> DataFrame:
    return v.mane_mismatch_report(*_versions(spark, sf))


@query(f"""WITH {sql('sites')}, m AS (SELECT DISTINCT site, pk % 50 AS ref_pos, contig AS ref_contig, ref, alt, sk, pk FROM sites), d AS (SELECT *, {_CANON} AS c, CASE WHEN sk % 4 = 0 THEN 'hap1' ELSE '-' END AS haplotype, (pk % 11) / 10 AS vaf, sk % 9 AS depth, site * 1000000 + pk * 100 + sk AS ord FROM m),
w AS (SELECT *, bool_or(haplotype <> '-') OVER (PARTITION BY ref_contig, ref_pos, c) AS any_hap, row_number() OVER (PARTITION BY ref_contig, ref_pos, c ORDER BY vaf DESC, depth DESC, ord) AS r FROM d)
SELECT site, ref_contig, ref_pos, ref, alt, haplotype, round(vaf, 3) AS vaf, depth, ord FROM w WHERE (any_hap AND haplotype <> '-') OR (NOT any_hap AND r = 1)""")
def drop_unassigned_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    s = standin(spark, sf, "sites").select("site", (F.col("pk") % 50).alias("ref_pos"), F.col("contig").alias("ref_contig"), "ref", "alt", "sk", "pk").distinct()
    rows = s.select("site", "ref_contig", "ref_pos", "ref", "alt", F.when(F.col("sk") % 4 == 0, "hap1").otherwise("-").alias("haplotype"), ((F.col("pk") % 11) / 10).alias("vaf"), (F.col("sk") % 9).alias("depth"), (F.col("site") * 1000000 + F.col("pk") * 100 + F.col("sk")).alias("ord"))
    return v.drop_unassigned_duplicates(rows).withColumn("vaf", F.round("vaf", 3))


@query(f"""WITH {sql('regions')} SELECT ord AS id, CASE WHEN size % 3 < 2 THEN brand END AS GRCh38_contig, CASE WHEN size % 3 < 2 THEN "start" END AS GRCh38_pos, CASE size % 3 WHEN 0 THEN 'Match' WHEN 1 THEN 'Gap' ELSE 'Split' END AS GRCh38_status,
CASE WHEN ord % 2 = 0 THEN kind END AS chm13_contig, CASE WHEN ord % 2 = 0 THEN "end" END AS chm13_pos, CASE WHEN ord % 2 = 0 THEN 'Match' END AS chm13_status FROM regions""")
def attach_lift_snv(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "regions")
    status = F.when(F.col("size") % 3 == 0, "Match").when(F.col("size") % 3 == 1, "Gap").otherwise("Split")
    a = r.select(F.col("ord").alias("id"), F.col("brand").alias("dst_contig"), F.col("start").alias("dst_pos"), status.alias("status"))
    b = r.where("ord % 2 = 0").select(F.col("ord").alias("id"), F.col("kind").alias("dst_contig"), F.col("end").alias("dst_pos"), F.lit("Match").alias("status"))
    return v.attach_lift_snv(r.select(F.col("ord").alias("id")), {"GRCh38": a, "chm13": b})


@query(f"""WITH {sql('regions')} SELECT size % 2 AS haplotype, contig, "end", brand AS ref, kind AS alt, ord, CASE WHEN ord % 3 = 0 THEN name END AS g_contig, CASE WHEN ord % 3 = 0 THEN "start" END AS g_pos, CASE WHEN ord % 3 = 0 THEN kind END AS g_ref, CASE WHEN ord % 3 = 0 THEN brand END AS g_alt, CASE ord % 3 WHEN 0 THEN 'Match' WHEN 1 THEN 'Rejected' END AS g_status FROM regions""")
def attach_lift_indel(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "regions").select((F.col("size") % 2).alias("haplotype"), "contig", "start", "end", F.col("brand").alias("ref"), F.col("kind").alias("alt"), "name", "ord")
    good = r.where("ord % 3 = 0").select("haplotype", "contig", "end", "ref", "alt", F.col("name").alias("dst_contig"), F.col("start").alias("dst_pos"), F.col("alt").alias("dst_ref"), F.col("ref").alias("dst_alt"))
    return v.attach_lift_indel(r.drop("start", "name"), good, r.where("ord % 3 = 1"), "g")


@query(f"""WITH {sql('sites')}, i AS (SELECT DISTINCT site, contig, "start", "end", ref, alt FROM sites WHERE length(ref) <> length(alt)), w AS (SELECT DISTINCT contig, "start" + 1 AS pos, ref, alt, pk * 1000 + sk AS ord FROM sites),
h AS (SELECT i.site, i.contig, i."start", i."end", i.ref, i.alt, arg_min(w.ord, (w.pos - 1) * 10000000 + w.ord) AS record FROM i JOIN w ON i.contig = w.contig AND i.ref = w.ref AND i.alt = w.alt AND w.pos - 1 < i."end" AND w.pos - 1 + length(w.ref) > i."start" GROUP BY ALL) SELECT * FROM h""")
def indel_back_to_vcf(spark: SparkSession, sf: str) -> DataFrame:
    s = standin(spark, sf, "sites")
    indels = v.split_snv_indel(s.select("site", "contig", "start", "end", "ref", "alt").distinct())[1]
    vcf = s.select("contig", (F.col("start") + 1).alias("pos"), "ref", "alt", (F.col("pk") * 1000 + F.col("sk")).alias("ord")).distinct().withColumn("record", F.col("ord"))
    return v.indel_back_to_vcf(indels, vcf, ["site", "contig", "start", "end", "ref", "alt"])


@query(f"""WITH {sql('sites')}, {_S} SELECT contig, count(*) AS n FROM s GROUP BY contig""")
def variants_per_contig(spark: SparkSession, sf: str) -> DataFrame:
    return v.variants_per_contig(sites(spark, sf))


@query(f"""WITH {sql('regions')}, f AS (SELECT DISTINCT 'G' || (ord // 4) AS gene, 'T' || (ord // 2) || '.1' AS transcript FROM regions) SELECT gene, transcript, regexp_replace(transcript, '\\.1$', '.2') AS mane_transcript FROM f WHERE hash(gene) IS NOT NULL AND CAST(substr(gene, 2) AS INT) % 2 = 0""")
def mane_version_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    return v.mane_version_mismatch(*_versions(spark, sf))


def _versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    f = _features(spark, sf).select("gene", F.concat("transcript", F.lit(".1")).alias("transcript"))
    shift = F.when(F.substring("gene", 2, 9).cast("int") % 2 == 0, ".2").otherwise(".1")
    mane = f.withColumn("t", F.concat(F.regexp_replace("transcript", r"\.1$", ""), shift)).groupBy("gene").agg(F.collect_set("t").alias("transcripts"))
    return f, mane
