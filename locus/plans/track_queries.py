"""Queries over intervals, sequences, k-mers, liftover and contigs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.functions import fields, seq
from locus.operators import intervals as iv
from locus.operators import kmers, lift, manifest, tracks
from locus.sources import readers, sinks

from .standins import distinct_rows, sql, standin

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(text: str | None = None):  # noqa: ANN201
    """Registers a query under its name with its SQL."""

    def put(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if text is not None:
            SQL[f.__name__] = text
        return f

    return put


# intervals


@query(f"""WITH {sql('sites', 'regions')}, s AS (SELECT DISTINCT site, contig, "start", "end" FROM sites)
SELECT s.site, s.contig, s."start", s."end", count(*) AS n, min(r.ord) AS first_ord FROM s JOIN regions r ON s.contig = r.contig AND r."start" < s."end" AND r."end" > s."start" GROUP BY ALL""")
def interval_join(spark: SparkSession, sf: str) -> DataFrame:
    pairs = iv.interval_join(distinct_rows(spark, sf, "sites", ["site", "contig", "start", "end"]), standin(spark, sf, "regions").select("contig", "start", "end", "ord"))
    return pairs.groupBy("site", "contig", "start", "end").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"))


@query(f"""WITH {sql('blocks', 'regions')}, b AS (SELECT DISTINCT read, contig, "start", "end" FROM blocks)
SELECT b.read, r.ord, least(b."end", r."end") - greatest(b."start", r."start") AS overlap FROM b JOIN regions r ON b.contig = r.contig AND r."start" < b."end" AND r."end" > b."start" """)
def intersect_wo(spark: SparkSession, sf: str) -> DataFrame:
    pairs = iv.interval_join(standin(spark, sf, "blocks").select("read", "contig", "start", "end").distinct(), standin(spark, sf, "regions").select("contig", "start", "end", "ord"))
    return pairs.select("read", "ord", iv.overlap(pairs).alias("overlap"))


@query(f"""WITH {sql('regions')}, m AS (SELECT *, max("end") OVER (PARTITION BY contig ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM regions),
i AS (SELECT *, sum(CASE WHEN b IS NULL OR "start" > b THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY "start", "end") AS k FROM m)
SELECT contig, min("start") AS "start", max("end") AS "end" FROM i GROUP BY contig, k""")
def merge_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return iv.merge_intervals(standin(spark, sf, "regions"))


@query(f"""WITH {sql('blocks')}, b AS (SELECT DISTINCT contig, "start", "end" FROM blocks), g AS (SELECT contig, "start", least("end", "start" + 30) AS "end" FROM b),
m AS (SELECT *, max("end") OVER (PARTITION BY contig ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM g),
k AS (SELECT *, sum(CASE WHEN p IS NULL OR "start" > p THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY "start", "end") AS k FROM m),
u AS (SELECT contig, min("start") AS gs, max("end") AS ge FROM k GROUP BY contig, k),
pr AS (SELECT b.contig, b."start" AS ss, b."end" AS se, u.gs, u.ge FROM b JOIN u ON b.contig = u.contig AND u.gs < b."end" AND u.ge > b."start"),
tail AS (SELECT contig, ss, se, max(ge) AS a, se AS z FROM pr GROUP BY contig, ss, se),
x AS (SELECT contig, ss, se, coalesce(lag(ge) OVER (PARTITION BY contig, ss, se ORDER BY gs), ss) AS a, gs AS z FROM pr UNION ALL SELECT contig, ss, se, a, z FROM tail)
SELECT contig, ss AS seg_start, se AS seg_end, a AS "start", z AS "end" FROM x WHERE a < z""")
def subtract_intervals(spark: SparkSession, sf: str) -> DataFrame:
    b = standin(spark, sf, "blocks").select("contig", "start", "end").distinct()
    gaps = b.select("contig", "start", F.least(F.col("end"), F.col("start") + 30).alias("end"))
    keyed = b.withColumns({"seg_start": F.col("start"), "seg_end": F.col("end")})
    return iv.subtract_intervals(keyed, gaps, ["contig", "seg_start", "seg_end"]).select("contig", "seg_start", "seg_end", "start", "end")


@query(f"""WITH {sql('regions')}, l AS (SELECT contig, max("end") AS length FROM regions GROUP BY contig)
SELECT r.ord, greatest(r."start" - 1000, 0) AS "start", least(r."end" + 1000, l.length) AS "end", r.contig || ':' || (greatest(r."start" - 1000, 0) + 1) || '-' || least(r."end" + 1000, l.length) AS name FROM regions r JOIN l USING (contig)""")
def pad_intervals(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "regions")
    return iv.padded(r.select("ord", "contig", "start", "end"), r.groupBy("contig").agg(F.max("end").alias("length")), 1000).select("ord", "start", "end", "name")


@query(f"""WITH {sql('sites', 'regions')}, l AS (SELECT contig, max("end") AS length FROM regions GROUP BY contig)
SELECT DISTINCT site, s.contig, greatest("start" - 100, 1) AS lo, least("end" + 100, length) AS hi FROM sites s JOIN l ON s.contig = l.contig""")
def flank_window(spark: SparkSession, sf: str) -> DataFrame:
    lengths = standin(spark, sf, "regions").groupBy("contig").agg(F.max("end").alias("length"))
    a, b = iv.flank_window(F.col("start"), F.col("end"), F.col("length"))
    return standin(spark, sf, "sites").join(lengths, "contig").select("site", "contig", a.alias("lo"), b.alias("hi")).distinct()


@query(f"""WITH {sql('reftable')}, t AS (SELECT contig, strand, c_start, c_end, unnest(range(CAST(ceil((c_end - c_start) / 50000.0) AS BIGINT))) AS k FROM reftable)
SELECT contig, k, CASE WHEN strand = '-' THEN greatest(c_end - 50000 * (k + 1), c_start) ELSE c_start + 50000 * k END AS "start", CASE WHEN strand = '-' THEN c_end - 50000 * k ELSE least(c_start + 50000 * (k + 1), c_end) END AS "end" FROM t""")
def tile_windows(spark: SparkSession, sf: str) -> DataFrame:
    from locus.operators.copynumber import tile_windows as tile

    return tile(standin(spark, sf, "reftable")).select("contig", F.col("k").cast("long").alias("k"), "start", "end")


@query(f"""WITH {sql('seqs', 'regions')}, i AS (SELECT ord % 1000 AS contig, ord, ord % 20 AS a, ord % 20 + 1 + size % 12 AS b, CASE WHEN size % 2 = 0 THEN '+' ELSE '-' END AS strand FROM regions)
SELECT ord, CASE WHEN strand = '-' THEN reverse(translate(substr(seq, (a + 1)::INT, (b - a)::INT), 'ACGT', 'TGCA')) ELSE substr(seq, (a + 1)::INT, (b - a)::INT) END AS seq FROM i JOIN seqs ON i.contig = seqs.contig WHERE a < 32""")
def extract_sequence(spark: SparkSession, sf: str) -> DataFrame:
    i = standin(spark, sf, "regions").selectExpr("ord % 1000 as contig", "ord", "ord % 20 as start", "ord % 20 + 1 + size % 12 as `end`", "case when size % 2 = 0 then '+' else '-' end as strand")
    s = standin(spark, sf, "seqs")
    halves = s.select("contig", F.inline(F.array(F.struct(F.lit(0).cast("long").alias("chunk_start"), F.substring("seq", 1, 16).alias("seq")), F.struct(F.lit(16).cast("long").alias("chunk_start"), F.substring("seq", 17, 16).alias("seq")))))
    return iv.extract_sequence(i, halves, ["ord"], 16)


@query(f"""WITH {sql('seqs')} SELECT contig, substr(seq, 1, (contig % 20)::INT) || repeat('N', 5) || substr(seq, (contig % 20 + 6)::INT) AS seq FROM seqs""")
def mask_sequence(spark: SparkSession, sf: str) -> DataFrame:
    s = standin(spark, sf, "seqs")
    mask = s.select("contig", (F.col("contig") % 20).alias("start"), (F.col("contig") % 20 + 5).alias("end"))
    return iv.mask_sequence(s.select("contig", F.lit(0).cast("long").alias("chunk_start"), "seq"), mask).select("contig", "seq")


# sequences and fields


@query(f"""WITH {sql('seqs')} SELECT contig, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc FROM seqs""")
def reverse_complement(spark: SparkSession, sf: str) -> DataFrame:
    return standin(spark, sf, "seqs").select("contig", seq.reverse_complement(F.col("seq")).alias("rc"))


@query(f"""WITH {sql('seqs')}, x AS (SELECT contig, CASE contig % 5 WHEN 0 THEN 'TTTTTTTTTTTT' || seq WHEN 1 THEN seq || 'AAAAAAAAAAAAA' WHEN 2 THEN substr(seq, 1, 9) || repeat('T', 11) || seq ELSE seq END AS s FROM seqs)
SELECT contig, CASE WHEN regexp_matches(s, 'AAAAAAAAAA([ACGT]{{1,20}})?$') THEN 'polyA' WHEN regexp_matches(s, '^([ACGT]{{1,20}})?TTTTTTTTTT') THEN 'polyT' END AS poly FROM x""")
def poly_at(spark: SparkSession, sf: str) -> DataFrame:
    c, s = F.col("contig") % 5, F.col("seq")
    text = F.when(c == 0, F.concat(F.lit("T" * 12), s)).when(c == 1, F.concat(s, F.lit("A" * 13))).when(c == 2, F.concat(F.substring(s, 1, 9), F.lit("T" * 11), s)).otherwise(s)
    return standin(spark, sf, "seqs").select("contig", seq.poly_at(text).alias("poly"))


@query(f"""WITH {sql('seqs')}, p AS (SELECT contig, seq, unnest(range(1, 17)) AS p FROM seqs),
s AS (SELECT contig, p, len(list_filter(range(1, 33 - p), lambda i: substr(seq, i::INT, 1) = substr(seq, (i + p)::INT, 1))) / (32 - p) AS share FROM p),
b AS (SELECT contig, max(share) AS share FROM s GROUP BY contig) SELECT s.contig, round(b.share, 9) AS share, min(s.p)::INT AS period FROM s JOIN b ON s.contig = b.contig AND s.share = b.share GROUP BY ALL""")
def self_repeat(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "seqs").select("contig", seq.self_repeat(F.col("seq")).alias("r"))
    return r.select("contig", F.round("r.share", 9).alias("share"), F.col("r.period").alias("period"))


@query("""SELECT p_partkey, 'G' || p_brand AS gene_name, p_type AS biotype FROM part""")
def parse_attributes(spark: SparkSession, sf: str) -> DataFrame:
    p = spark.read.parquet(f"{sf}/part.parquet")
    text = F.concat(F.lit('gene_name "G'), "p_brand", F.lit('"; gene_biotype "'), "p_type", F.lit('"; exon_number "'), F.col("p_size").cast("string"), F.lit('";'))
    a = p.select("p_partkey", fields.attributes(text).alias("a"))
    return a.select("p_partkey", F.col("a")["gene_name"].alias("gene_name"), F.col("a")["gene_biotype"].alias("biotype"))


@query("""SELECT p_partkey, p_brand AS caller, p_size::VARCHAR AS depth FROM part""")
def parse_info(spark: SparkSession, sf: str) -> DataFrame:
    p = spark.read.parquet(f"{sf}/part.parquet")
    m = p.select("p_partkey", fields.info(F.concat(F.lit("CALLER="), "p_brand", F.lit(";DP="), F.col("p_size").cast("string"))).alias("i"))
    return m.select("p_partkey", F.col("i")["CALLER"].alias("caller"), F.col("i")["DP"].alias("depth"))


@query("""SELECT n_nationkey, CASE WHEN n_nationkey = 3 THEN 'chrM' ELSE 'chr' || n_nationkey END AS chr, CASE WHEN n_nationkey = 3 THEN 'M' ELSE n_nationkey::VARCHAR END AS bare, replace('h#' || n_name, '#', '_HASH_') AS safe, 'h#' || n_name AS back, 'ENSG' || n_nationkey AS base, 'ENSG' || n_nationkey || '.' || n_regionkey AS versioned FROM nation""")
def contig_names(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("n_nationkey").cast("string")
    named = fields.add_chr(F.when(F.col("n_nationkey") == 3, "MT").when(F.col("n_nationkey") == 4, "chr4").otherwise(key))
    name = fields.sanitized(F.concat(F.lit("h#"), "n_name"))
    versioned = fields.with_version(F.concat(F.lit("ENSG"), key), F.col("n_regionkey").cast("string"))
    n = spark.read.parquet(f"{sf}/nation.parquet")
    return n.select("n_nationkey", named.alias("chr"), fields.strip_chr(named).alias("bare"), name.alias("safe"), fields.restored(name).alias("back"), fields.without_version(versioned).alias("base"), versioned.alias("versioned"))


@query(f"""WITH {sql('reftable')} SELECT contig, 'c' || contig || ':' || c_start AS place, 'c' || contig || ':' || c_start || '-' || c_end AS span, round_even(matched / 64, 3) AS mean3, coalesce(try_cast('x' || matched AS DOUBLE), 0.0) AS bad, matched::DOUBLE AS good FROM reftable""")
def format_fields(spark: SparkSession, sf: str) -> DataFrame:
    c = F.concat(F.lit("c"), F.col("contig").cast("string"))
    m = F.col("matched")
    return standin(spark, sf, "reftable").select("contig", fields.locus(c, F.col("c_start")).alias("place"), fields.locus(c, F.col("c_start"), F.col("c_end")).alias("span"), fields.mean3(m / 64).alias("mean3"), fields.safe_float(F.concat(F.lit("x"), m.cast("string"))).alias("bad"), fields.safe_float(m.cast("string")).alias("good"))


# k-mers and reads

_KM = "k AS (SELECT contig, hap, p, substr(seq, p::INT + 1, 6) AS kmer FROM (SELECT contig, hap, seq, unnest(range(0, 27)) AS p FROM seqs))"


def _hap(spark: SparkSession, sf: str, hap: int) -> DataFrame:
    return standin(spark, sf, "seqs").where(F.col("hap") == hap).select("contig", "seq")


_LK = "k AS (SELECT substr(seq, p::INT + 1, 21) AS kmer FROM (SELECT seq, unnest(range(0, length(seq) - 20)) AS p FROM longseqs))"


@query(f"""WITH {sql('longseqs')}, {_LK} SELECT kmer, count(*) AS n FROM k GROUP BY kmer""")
def count_kmers(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.count_kmers(standin(spark, sf, "longseqs"), 21)


@query(f"""WITH {sql('longseqs')}, {_LK} SELECT kmer FROM k GROUP BY kmer HAVING count(*) = 1""")
def single_copy(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.single_copy(kmers.count_kmers(standin(spark, sf, "longseqs"), 21)).select("kmer")


@query(f"""WITH {sql('seqs')}, {_KM} SELECT DISTINCT kmer FROM k WHERE hap = 0 AND kmer NOT IN (SELECT kmer FROM k WHERE hap = 1)""")
def unique_kmers(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.unique_kmers(kmers.count_kmers(_hap(spark, sf, 0), 6), kmers.count_kmers(_hap(spark, sf, 1), 6)).select("kmer")


@query(f"""WITH {sql('seqs')}, {_KM}, u AS (SELECT kmer FROM k WHERE hap = 0 AND kmer NOT IN (SELECT kmer FROM k WHERE hap = 1) GROUP BY kmer HAVING count(*) = 1) SELECT contig, p::BIGINT AS pos, kmer FROM k WHERE hap = 0 AND kmer IN (SELECT kmer FROM u)""")
def locate_kmers(spark: SparkSession, sf: str) -> DataFrame:
    own = _hap(spark, sf, 0)
    wanted = kmers.unique_kmers(kmers.single_copy(kmers.count_kmers(own, 6)), kmers.count_kmers(_hap(spark, sf, 1), 6))
    return kmers.locate_kmers(own, wanted, 6).select("contig", F.col("pos").cast("long").alias("pos"), "kmer")


@query(f"""WITH {sql('seqs')}, {_KM}, a AS (SELECT DISTINCT kmer FROM k WHERE hap = 0), b AS (SELECT DISTINCT kmer FROM k WHERE hap = 1),
m AS (SELECT kmer, 1 AS mine FROM a WHERE kmer NOT IN (FROM b) UNION ALL SELECT kmer, 0 FROM b WHERE kmer NOT IN (FROM a)),
h AS (SELECT contig, sum(mine) / count(*) AS r FROM k JOIN m USING (kmer) GROUP BY contig) SELECT s.contig AS read, round(coalesce(h.r, 0.8), 9) AS ratio FROM seqs s LEFT JOIN h ON s.contig = h.contig""")
def read_kmer_ratio(spark: SparkSession, sf: str) -> DataFrame:
    a, b = kmers.count_kmers(_hap(spark, sf, 0), 6), kmers.count_kmers(_hap(spark, sf, 1), 6)
    reads = standin(spark, sf, "seqs").select(F.col("contig").alias("read"), "seq")
    return kmers.read_kmer_ratio(reads, kmers.unique_kmers(a, b), kmers.unique_kmers(b, a), 0.8, 6).select("read", F.round("ratio", 9).alias("ratio"))


@query(f"""WITH {sql('blocks')} SELECT read, contig, "start", mapq FROM blocks WHERE (flag & 2308) = 0 AND mapq >= 30""")
def filter_alignment_flags(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.filter_alignment_flags(standin(spark, sf, "blocks"), min_mapq=30).select("read", "contig", "start", "mapq")


@query(f"""WITH {sql('sites', 'blocks')}, s AS (SELECT DISTINCT contig, pk * 50 + ln * 4 AS pos FROM sites), b AS (SELECT DISTINCT read, contig, "start", "start" + 32 AS "end", translate(md5(read::VARCHAR), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq FROM blocks)
SELECT s.contig, s.pos, count(*) AS depth, string_agg(substr(seq, (pos - "start" + 1)::INT, 1), '' ORDER BY read, substr(seq, (pos - "start" + 1)::INT, 1)) AS bases, string_agg(read::VARCHAR, ',' ORDER BY read) AS reads FROM s JOIN b ON s.contig = b.contig AND "start" <= pos AND "end" > pos GROUP BY ALL""")
def pileup_at_sites(spark: SparkSession, sf: str) -> DataFrame:
    s = standin(spark, sf, "sites").select("contig", (F.col("pk") * 50 + F.col("ln") * 4).alias("pos")).distinct()
    b = standin(spark, sf, "blocks").select("read", "contig", "start").distinct()  # the text follows from the read
    b = b.select("*", (F.col("start") + 32).alias("end"), F.translate(F.md5(F.col("read").cast("string")), "0123456789abcdef", "ACGT" * 4).alias("seq"))
    out = kmers.pileup_at_sites(s.withColumn("p", F.col("pos")), b, ["contig", "p"])
    return out.select("contig", F.col("p").alias("pos"), "depth", "bases", "reads")


@query(f"""WITH {sql('sites', 'blocks')}, s AS (SELECT DISTINCT contig, pk * 50 + ln * 4 AS pos FROM sites), b AS (SELECT DISTINCT read, contig, "start", "start" + 96 AS "end", translate(md5(read::VARCHAR) || md5('a' || read) || md5('b' || read), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq, md5('q' || read) || md5('r' || read) || md5('s' || read) AS qual FROM blocks),
j AS (SELECT s.contig, s.pos, read, substr(seq, (pos - "start" + 1)::INT, 1) AS b, substr(qual, (pos - "start" + 1)::INT, 1) AS q FROM s JOIN b ON s.contig = b.contig AND "start" <= pos AND "end" > pos), k AS (SELECT *, row_number() OVER (PARTITION BY contig, pos ORDER BY read, b, q) AS r FROM j)
SELECT contig, pos, count(*) AS depth, string_agg(b, '' ORDER BY r) AS bases, string_agg(q, '' ORDER BY r) AS quals, string_agg(read::VARCHAR, ',' ORDER BY r) AS reads FROM k WHERE r <= 3 GROUP BY ALL""")
def pileup_with_qualities(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks over several pieces, qualities, and three reads a site at most."""
    s = standin(spark, sf, "sites").select("contig", (F.col("pk") * 50 + F.col("ln") * 4).alias("pos")).distinct()
    r = F.col("read").cast("string")
    three = lambda *x: F.concat(*[F.md5(F.concat(F.lit(p), r)) for p in x])
    b = standin(spark, sf, "blocks").select("read", "contig", "start").distinct()
    b = b.select("*", (F.col("start") + 96).alias("end"), F.translate(three("", "a", "b"), "0123456789abcdef", "ACGT" * 4).alias("seq"), three("q", "r", "s").alias("qual"))
    return kmers.pileup_at_sites(s.withColumn("p", F.col("pos")), b, ["contig", "p"], max_depth=3, piece=40).withColumnRenamed("p", "pos")


@query(f"""WITH {sql('blocks')} SELECT contig, CASE WHEN strand = '-' THEN "start" - 1 ELSE "start" END AS pos, sum((q % 2))::BIGINT AS n_mod, count(*) AS n_total, round(100 * sum(q % 2) / count(*), 4) AS percent FROM blocks GROUP BY ALL""")
def methylation_pileup(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.methylation_pileup(standin(spark, sf, "blocks").select("contig", F.col("start").alias("pos"), "strand", (F.col("q") % 2).alias("is_mod")))


@query(f"""WITH {sql('reftable')} SELECT strand AS assembly_hap1, hap::VARCHAR AS assembly_hap2, min('s' || contig) AS source FROM reftable GROUP BY ALL""")
def kmer_source(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "reftable")
    return kmers.kmer_source(r.select(F.concat(F.lit("s"), F.col("contig").cast("string")).alias("sample"), F.col("strand").alias("assembly_hap1"), F.col("hap").cast("string").alias("assembly_hap2")))


# liftover: two blocks with a gap for each contig of the reference table, on both strands

_CHAIN = """blk AS (SELECT contig AS chain_id, contig, c_start AS "start", c_start + 40000 AS "end", strand, chrom AS dst, CASE WHEN strand = '-' THEN r_start + 45000 ELSE r_start END AS d0, CASE WHEN strand = '-' THEN r_start + 85000 ELSE r_start + 40000 END AS d1 FROM reftable
UNION ALL SELECT contig, contig, c_start + 43000, c_start + 80000, strand, chrom, CASE WHEN strand = '-' THEN r_start ELSE r_start + 48000 END, CASE WHEN strand = '-' THEN r_start + 37000 ELSE r_start + 85000 END FROM reftable)"""


def _blocks(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "reftable")
    minus = F.col("strand") == "-"

    def part(a: int, b: int, m0: int, p0: int) -> DataFrame:
        d0 = F.when(minus, F.col("r_start") + m0).otherwise(F.col("r_start") + p0)
        return r.select(F.col("contig").alias("chain_id"), "contig", (F.col("c_start") + a).alias("start"), (F.col("c_start") + b).alias("end"), "strand", F.col("chrom").alias("dst_contig"), d0.alias("d0"), (d0 + (b - a)).alias("d1"))

    return part(0, 40000, 45000, 0).unionByName(part(43000, 80000, 0, 48000))


@query(f"""WITH {sql('reftable', 'regions')}, {_CHAIN}, p AS (SELECT ord, ord % 100 AS contig, (ord % 100) * 1000 + (ord * 977) % 90000 AS pos FROM regions),
m AS (SELECT p.ord, 'Match' AS status, dst AS dst_contig, CASE WHEN strand = '-' THEN d1 - 1 - (pos - "start") ELSE d0 + pos - "start" END AS dst_pos, NULL::BIGINT AS dst_end FROM p JOIN blk ON p.contig = blk.contig AND "start" <= pos AND "end" > pos),
g AS (SELECT p.ord, 'Gap', a.dst, least(a.d1, b.d1), greatest(a.d0, b.d0) FROM p JOIN blk a ON p.contig = a.contig JOIN blk b ON a.chain_id = b.chain_id AND b."start" > a."start" WHERE pos >= a."end" AND pos < b."start"),
f AS (SELECT * FROM m UNION ALL SELECT * FROM g) SELECT ord, status, dst_contig, dst_pos, dst_end FROM f UNION ALL SELECT ord, 'Unmapped', NULL, NULL, NULL FROM p WHERE ord NOT IN (SELECT ord FROM f)""")
def liftover_points(spark: SparkSession, sf: str) -> DataFrame:
    p = standin(spark, sf, "regions").selectExpr("ord", "ord % 100 as contig", "(ord % 100) * 1000 + (ord * 977) % 90000 as pos")
    return lift.liftover_points(p, _blocks(spark, sf), ["ord"]).select("ord", "status", "dst_contig", "dst_pos", "dst_end")


@query(f"""WITH {sql('reftable')}, {_CHAIN} SELECT chain_id, dst AS contig, d0 AS "start", d1 AS "end", strand, contig AS dst_contig, "start" AS d0, "end" AS d1 FROM blk""")
def invert_chain(spark: SparkSession, sf: str) -> DataFrame:
    return lift.invert_chain(_blocks(spark, sf))


@query(f"""WITH {sql('reftable')}, {_CHAIN}, t AS (SELECT *, unnest(range(CAST(ceil(("end" - "start") / 10000.0) AS BIGINT))) * 10000 AS a FROM blk), u AS (SELECT *, least(a + 10000, "end" - "start") AS b FROM t)
SELECT chain_id, "start" + a AS "start", "start" + b AS "end", CASE WHEN strand = '-' THEN d1 - b ELSE d0 + a END AS d0, CASE WHEN strand = '-' THEN d1 - a ELSE d0 + b END AS d1 FROM u""")
def break_alignments(spark: SparkSession, sf: str) -> DataFrame:
    return lift.break_alignments(_blocks(spark, sf)).select("chain_id", "start", "end", "d0", "d1")


@query(f"""WITH {sql('reftable', 'regions')}, {_CHAIN}, v AS (SELECT ord, ord % 100 AS contig, (ord % 100) * 1000 + (ord * 977) % 90000 AS "start", (ord % 100) * 1000 + (ord * 977) % 90000 + 3 AS "end" FROM regions)
SELECT v.ord, dst AS dst_contig, CASE WHEN strand = '-' THEN d1 - (v."end" - blk."start") ELSE d0 + v."start" - blk."start" END AS dst_pos, CASE WHEN strand = '-' THEN 'GTT' ELSE 'AAC' END AS dst_ref, CASE WHEN strand = '-' THEN 'A' ELSE 'T' END AS dst_alt FROM v JOIN blk ON v.contig = blk.contig AND v."start" >= blk."start" AND v."end" <= blk."end" """)
def liftover_alleles(spark: SparkSession, sf: str) -> DataFrame:
    v = standin(spark, sf, "regions").selectExpr("ord", "ord % 100 as contig", "(ord % 100) * 1000 + (ord * 977) % 90000 as start", "(ord % 100) * 1000 + (ord * 977) % 90000 + 3 as `end`", "'AAC' as ref", "'T' as alt")
    return lift.liftover_alleles(v, _blocks(spark, sf), ["ord"])[0].select("ord", "dst_contig", "dst_pos", "dst_ref", "dst_alt")


# contigs


@query(f"""WITH {sql('reftable')}, l AS (SELECT contig, c_end - c_start AS length FROM reftable) SELECT CASE WHEN length >= 400000 THEN contig::VARCHAR ELSE 'rest' END AS chunk, count(*) AS n, sum(length)::BIGINT AS bp, string_agg(contig::VARCHAR, ',' ORDER BY contig::VARCHAR) AS contigs FROM l GROUP BY chunk""")
def chunk_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.chunk_manifest(standin(spark, sf, "reftable").select("contig", (F.col("c_end") - F.col("c_start")).alias("length")), 400_000)


@query(f"""WITH {sql('regions')}, k AS (SELECT contig, "start", "end", kind, ord FROM regions WHERE regexp_matches(lower(kind), 'o|mon|hsat')) SELECT * FROM k WHERE ord > (SELECT min(ord) FROM k)""")
def mask_tracks(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "regions").withColumn("name", F.when(F.lower("kind").rlike("o|mon|hsat"), "hor").otherwise("x"))
    return tracks.mask_tracks(r).select("contig", "start", "end", "kind", "ord")


@query("SELECT 'chr' || CASE WHEN n_nationkey % 3 = 0 THEN 'Y' || n_nationkey ELSE n_name END AS contig FROM nation WHERE n_nationkey % 3 <> 0")
def drop_chr_y(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("n_nationkey")
    n = spark.read.parquet(f"{sf}/nation.parquet").select(F.concat(F.lit("chr"), F.when(k % 3 == 0, F.concat(F.lit("Y"), k.cast("string"))).otherwise(F.col("n_name"))).alias("contig"))
    return tracks.drop_chr_y(n, "female")


def _gff(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "regions")
    feature = F.when(F.col("ord") % 3 == 0, "gene").otherwise("exon")
    biotype = F.when(F.col("ord") % 5 == 0, "processed_pseudogene").otherwise("protein_coding")
    text = F.concat(F.lit('gene_id "I'), F.col("ord").cast("string"), F.lit('"; gene_name "'), "brand", F.lit('"; gene_biotype "'), biotype, F.lit('"; transcript_id "T'), F.col("ord").cast("string"), F.lit('"; transcript_version "2"; exon_number "'), F.col("size").cast("string"), F.lit('";'))
    line = F.concat_ws("\t", F.concat(F.lit("c"), F.col("contig").cast("string")), F.lit("s"), feature, F.col("start").cast("string"), F.col("end").cast("string"), F.lit("."), F.lit("+"), F.lit("."), text)
    return readers.parse_gff(r.select("ord", line.alias("line")))


@query(f"""WITH {sql('regions')} SELECT 'c' || contig AS contig, "start" - 1 AS "start", "end", brand AS gene_name, '+' AS strand, 'I' || ord AS gene_id, 'protein_coding' AS biotype FROM regions WHERE ord % 3 = 0 AND ord % 5 <> 0""")
def gene_bed_from_gff(spark: SparkSession, sf: str) -> DataFrame:
    return tracks.gene_bed_from_gff(_gff(spark, sf)).drop("ord")


@query(f"""WITH {sql('regions')} SELECT 'c' || contig AS contig, "start" - 1 AS "start", "end", 'T' || ord || '.2' AS transcript, size::VARCHAR AS exon_number, '+' AS strand FROM regions WHERE ord % 3 <> 0""")
def exon_bed_from_gtf(spark: SparkSession, sf: str) -> DataFrame:
    return tracks.exon_bed_from_gtf(_gff(spark, sf)).drop("ord")


@query(f"""WITH {sql('regions')} SELECT contig, "start", "end", size AS copies FROM regions WHERE size >= 4""")
def min_copies(spark: SparkSession, sf: str) -> DataFrame:
    return tracks.min_copies(standin(spark, sf, "regions").select("contig", "start", "end", F.col("size").alias("copies")))


@query(f"""WITH {sql('regions')} SELECT DISTINCT brand AS gene FROM regions WHERE size % 4 = 0 AND contig NOT IN (0, 1)""")
def medically_relevant_genes(spark: SparkSession, sf: str) -> DataFrame:
    chrom = F.when(F.col("contig") == 0, "X").when(F.col("contig") == 1, "MT").otherwise(F.col("contig").cast("string"))
    return tracks.medically_relevant_genes(standin(spark, sf, "regions").select(F.col("brand").alias("gene"), F.when(F.col("size") % 4 == 0, "TRUE").otherwise("FALSE").alias("flag"), chrom.alias("chrom")))


@query(f"""WITH {sql('regions')} SELECT contig, "start", "end", ord FROM regions""")
def union_haplotypes(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "regions").select("contig", "start", "end", "ord")
    return tracks.united(r.where("ord % 2 = 0"), r.where("ord % 2 = 1"))


@query(f"""WITH {sql('reftable', 'regions')}, s AS (SELECT ord % 25 AS contig, ord * 4500 AS a, ord * 4500 + size * 900 AS z FROM regions)
SELECT r.contig AS ord, coalesce(sum(least(r_end, z) - greatest(r_start, a)) FILTER (s.contig IS NOT NULL), 0)::BIGINT AS overlap FROM reftable r LEFT JOIN s ON r.chrom = s.contig AND s.a < r_end AND s.z > r_start GROUP BY r.contig""")
def satellite_overlap(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "reftable").select(F.col("contig").alias("ord"), F.col("chrom").cast("long").alias("contig"), F.col("r_start").alias("start"), F.col("r_end").alias("end"))
    s = standin(spark, sf, "regions").select((F.col("ord") % 25).alias("contig"), (F.col("ord") * 4500).alias("start"), (F.col("ord") * 4500 + F.col("size") * 900).alias("end"))
    return tracks.satellite_overlap(r, s, ["ord"]).select("ord", "overlap")


@query("SELECT CASE WHEN c_custkey % 2 = 0 THEN '##x' || (c_custkey % 50) ELSE c_mktsegment END AS line, min(c_custkey) AS ord FROM customer GROUP BY 1")
def distinct_header(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    lines = spark.read.parquet(f"{sf}/customer.parquet").select(F.when(k % 2 == 0, F.concat(F.lit("##x"), (k % 50).cast("string"))).otherwise(F.col("c_mktsegment")).alias("line"), k.alias("ord"))
    return sinks.distinct_header(lines)


@query(f"""WITH {sql('seqs')} SELECT DISTINCT contig AS id, substr(seq, 2, 30) AS seq FROM seqs""")
def flank_sequences(spark: SparkSession, sf: str) -> DataFrame:
    s = standin(spark, sf, "seqs")
    v = s.select(F.col("contig").alias("id"), "contig", F.lit(10).cast("long").alias("start"), F.lit(11).cast("long").alias("end"))
    lengths = s.select("contig", F.lit(31).cast("long").alias("length"))
    return sinks.flank_sequences(v, s.select("contig", F.lit(0).cast("long").alias("chunk_start"), "seq"), lengths, 32, 20)


@query("SELECT p_partkey AS ord, 'c' || p_partkey % 7 AS contig, p_partkey * 2 AS \"start\", p_partkey * 2 + p_size AS \"end\", p_brand AS name FROM part WHERE p_partkey % 3 <> 0")
def read_bed(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    line = F.concat_ws("\t", F.concat(F.lit("c"), (k % 7).cast("string")), F.when(k % 3 == 0, "x").otherwise((k * 2).cast("string")), (k * 2 + F.col("p_size")).cast("string"), "p_brand")
    return readers.parse_bed(spark.read.parquet(f"{sf}/part.parquet").select(k.alias("ord"), line.alias("line")), ["name"])


@query("SELECT p_partkey AS ord, 'c' || p_partkey % 7 AS contig, p_partkey + 1 AS pos, p_size AS depth, CASE WHEN p_partkey % 2 = 0 THEN 'PASS' ELSE 'q' END AS filter FROM part WHERE p_partkey % 10 > 0")
def read_vcf(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    line = F.concat_ws("\t", F.concat(F.lit("c"), (k % 7).cast("string")), (k + 1).cast("string"), F.lit("."), F.lit("A"), F.lit("C"), F.lit("9"), F.when(k % 2 == 0, "PASS").otherwise("q"), F.concat(F.lit("DP="), F.col("p_size").cast("string"), F.lit(";X=1")))
    v = readers.parse_vcf(spark.read.parquet(f"{sf}/part.parquet").select(k.alias("ord"), F.when(k % 10 == 0, F.concat(F.lit("#"), line)).otherwise(line).alias("line")))
    return v.select("ord", "contig", "pos", F.col("info")["DP"].cast("int").alias("depth"), "filter")


@query("SELECT s_suppkey AS ord, 't' || s_suppkey AS contig, s_suppkey * 3 AS c_start, s_suppkey * 3 + 9 AS c_end, 'q' || s_nationkey AS chrom, s_suppkey AS r_start, s_suppkey + 9 AS r_end, 8::BIGINT AS matched, s_nationkey::INT AS mapq FROM supplier")
def read_paf(spark: SparkSession, sf: str) -> DataFrame:
    k, t = F.col("s_suppkey"), lambda c: c.cast("string")
    line = F.concat_ws("\t", F.concat(F.lit("q"), t(F.col("s_nationkey"))), F.lit("99"), t(k), t(k + 9), F.lit("+"), F.concat(F.lit("t"), t(k)), F.lit("88"), t(k * 3), t(k * 3 + 9), F.lit("8"), F.lit("9"), t(F.col("s_nationkey")))
    p = readers.parse_paf(spark.read.parquet(f"{sf}/supplier.parquet").select(k.alias("ord"), line.alias("line")))
    return p.select("ord", "contig", "c_start", "c_end", "chrom", "r_start", "r_end", "matched", "mapq")
