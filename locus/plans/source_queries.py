"""Queries over readers and writers, which go through real files in the shared folder, and over orders and manifests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.operators import manifest, reftable, sv, tracks, variants
from locus.operators.checkpoints import checkpointed, shared_folder
from locus.sources import readers, sinks

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


def folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def file(spark: SparkSession, lines: DataFrame, packed: bool = False) -> str:
    """Text files of the one column of `lines`; a value may hold several lines."""
    path = folder(spark, "lines")
    lines.write.text(path, compression="gzip" if packed else None)
    return path


def text(c: str) -> F.Column:
    return F.col(c).cast("string")


def tabbed(*cols) -> F.Column:  # noqa: ANN002
    return F.concat_ws("\t", *[F.lit(c[1:]) if isinstance(c, str) and c.startswith("=") else text(c) if isinstance(c, str) else c.cast("string") for c in cols]).alias("value")


def placed(ordered: DataFrame) -> DataFrame:
    """Rows with the place, from 1, that an ordered table gives them."""
    at = checkpointed(ordered.withColumn("_at", F.monotonically_increasing_id()))
    return variants.numbered_in_order(at, ["_at"], "_n").withColumn("place", F.col("_n") + 1).drop("_at", "_n")


# tables


@query(f"""WITH {sql('regions')} SELECT ord::VARCHAR AS ord, brand, CASE WHEN size % 5 = 0 THEN '-' ELSE size::VARCHAR END AS size FROM regions""")
def read_table(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "table")
    sinks.write_table_tsv(standin(spark, sf, "regions").select("ord", "brand", F.when(F.col("size") % 5 != 0, F.col("size")).alias("size")), path)
    return readers.read_table(spark, path, ["ord", "brand"])


@query(f"""WITH {sql('regions')} SELECT ord || chr(9) || CASE WHEN size % 3 = 0 THEN '-' WHEN size % 2 = 0 THEN 'True' ELSE 'False' END || chr(9) || kind AS line FROM regions""")
def write_table_tsv(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "table")
    flag = F.when(F.col("size") % 3 != 0, F.col("size") % 2 == 0)
    sinks.write_table_tsv(standin(spark, sf, "regions").select("ord", flag.alias("flag"), "kind"), path)
    return readers.lines(spark, path).where("line <> 'ord\tflag\tkind'").select("line")


@query(f"""WITH {sql('regions')} SELECT contig, count(*) AS n, sum("start")::BIGINT AS total, 0::BIGINT AS misplaced FROM regions GROUP BY contig""")
def write_intervals_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by contig, and rows that stand before their place in their file."""
    from pyspark.sql.window import Window

    path = folder(spark, "intervals")
    sinks.write_intervals_sorted(standin(spark, sf, "regions").select("contig", "start", "end", "ord"), path)
    back = spark.read.parquet(path).withColumns({"_file": F.col("_metadata.file_path"), "_at": F.monotonically_increasing_id()})
    before = F.lag(F.struct("contig", "start")).over(Window.partitionBy("_file").orderBy("_at"))
    return back.withColumn("_bad", before > F.struct("contig", "start")).groupBy("contig").agg(F.count(F.lit(1)).alias("n"), F.sum("start").alias("total"), F.count(F.when(F.col("_bad"), 1)).alias("misplaced"))


# intervals, features and alignments from files


@query(f"""WITH {sql('regions')} SELECT 'c' || contig AS contig, "start", "end", name FROM regions WHERE ord % 3 <> 0""")
def read_bed_files(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "regions")
    lines = r.select(tabbed(F.concat(F.lit("c"), text("contig")), F.when(F.col("ord") % 3 == 0, "x").otherwise(text("start")), "end", "name"))
    return readers.read_bed(spark, file(spark, lines, packed=True), ["name"]).drop("ord")


@query(f"""WITH {sql('regions')} SELECT 'c' || contig AS contig, CASE WHEN ord % 3 = 0 THEN 'gene' ELSE 'exon' END AS feature, "start", "end", 'G ' || ord AS gene, brand AS tag FROM regions""")
def read_gff(spark: SparkSession, sf: str) -> DataFrame:
    """Both dialects of attributes: `key "value";` and `key=value;`."""
    attrs = F.when(F.col("ord") % 2 == 0, F.concat(F.lit('gene_id "G '), text("ord"), F.lit('"; tag "'), F.col("brand"), F.lit('";'))).otherwise(F.concat(F.lit("gene_id=G "), text("ord"), F.lit(";tag="), F.col("brand")))
    line = tabbed(F.concat(F.lit("c"), text("contig")), "=s", F.when(F.col("ord") % 3 == 0, "gene").otherwise("exon"), "start", "end", "=.", "=+", "=.", attrs)
    lines = standin(spark, sf, "regions").select(F.concat(F.lit("# note\n"), line).alias("value"))
    g = readers.read_gff(spark, file(spark, lines))
    return g.select("contig", "feature", "start", "end", F.col("attrs")["gene_id"].alias("gene"), F.col("attrs")["tag"].alias("tag"))


@query(f"""WITH {sql('reftable')}, blk AS (SELECT contig, c_start AS "start", c_start + 40000 AS "end", strand, chrom, CASE WHEN strand = '-' THEN 9000000 - r_start - 40000 ELSE r_start END AS d0 FROM reftable
UNION ALL SELECT contig, c_start + 43000, c_start + 80000, strand, chrom, CASE WHEN strand = '-' THEN 9000000 - r_start - 85000 ELSE r_start + 48000 END FROM reftable)
SELECT 'h' || contig AS contig, "start", "end", strand, 'chr' || chrom AS dst_contig, d0, d0 + "end" - "start" AS d1 FROM blk""")
def read_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Two blocks a chain; the places of the - strand are counted from the end of the destination."""
    r = standin(spark, sf, "reftable").where("r_start < 9000000 or strand = '+' or strand = '-'")
    head = F.concat_ws(" ", F.lit("chain 1"), F.concat(F.lit("h"), text("contig")), F.lit("9999999 +"), text("c_start"), text("c_end"), F.concat(F.lit("chr"), text("chrom")), F.lit("9000000"), "strand", text("r_start"), text("r_end"), text("contig"))
    return readers.read_chain(spark, file(spark, r.select(F.concat(head, F.lit("\n40000\t3000\t8000\n37000\n")).alias("value")))).drop("chain_id")


@query(f"""WITH {sql('longseqs')} SELECT 'd' || contig AS contig, 'd' || contig || ' rl:' || CASE WHEN contig % 4 = 0 THEN 'Unplaced' ELSE 'Chromosome' END AS header, seq FROM longseqs""")
def read_fasta(spark: SparkSession, sf: str) -> DataFrame:
    """Sequences over several lines, put together again in order of their lines."""
    chunks = readers.read_fasta(spark, file(spark, _fasta(spark, sf)))
    joined = chunks.groupBy("contig", "header").agg(F.array_sort(F.collect_list(F.struct("chunk_start", "seq"))).alias("s"))
    return joined.select("contig", "header", F.array_join(F.transform("s", lambda x: x["seq"]), "").alias("seq"))


def _fasta(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("contig") % 4 == 0, "Unplaced").otherwise("Chromosome")
    wrapped = F.concat_ws("\n", F.substring("seq", 1, 60), F.substring("seq", 61, 60), F.substring("seq", 121, 1000))
    return standin(spark, sf, "longseqs").select(F.concat(F.lit(">d"), text("contig"), F.lit(" rl:"), kind, F.lit("\n"), wrapped).alias("value"))


@query(f"""WITH {sql('longseqs')} SELECT 'd' || contig AS contig, length(seq) AS length FROM longseqs WHERE contig % 4 <> 0""")
def keep_primary_contigs(spark: SparkSession, sf: str) -> DataFrame:
    chunks = readers.read_fasta(spark, file(spark, _fasta(spark, sf)))
    return readers.contig_lengths(readers.keep_primary_contigs(chunks)).select("contig", "length")


@query(f"""WITH {sql('blocks')} SELECT 'q' || q AS query, 't' || contig AS contig, strand, "start", "end", 10::BIGINT AS q_start, 10 + q::BIGINT AS q_end, round_even(q * (80 + q % 20) / 100.0, 0)::BIGINT AS n_match, (q * 1.5)::DOUBLE AS bits FROM blocks""")
def read_blast6(spark: SparkSession, sf: str) -> DataFrame:
    minus, q = F.col("strand") == "-", F.col("q")
    first, last = F.when(minus, F.col("end")).otherwise(F.col("start") + 1), F.when(minus, F.col("start") + 1).otherwise(F.col("end"))
    lines = standin(spark, sf, "blocks").select(tabbed(F.concat(F.lit("q"), text("q")), F.concat(F.lit("t"), text("contig")), 80 + q % 20, q, "=0", "=0", F.lit(11), q + 10, first, last, "=0", q * 1.5))
    return readers.parse_blast6(readers.lines(spark, file(spark, lines))).drop("ord")


@query(f"""WITH {sql('regions')} SELECT 'i' || ord // 5 AS insert_key, (ord % 5 * 100)::BIGINT AS "start", (ord % 5 * 100 + size)::BIGINT AS "end", CASE WHEN size % 2 = 0 THEN '-' ELSE '+' END AS strand, 'R' || size AS repeat, 'F/' || contig AS family FROM regions""")
def read_rmsk_out(spark: SparkSession, sf: str) -> DataFrame:
    o = F.col("ord")
    line = F.concat_ws("  ", F.lit(" 99 1 2 3"), F.concat(F.lit("i"), F.expr("ord div 5").cast("string")), (o % 5 * 100 + 1).cast("string"), (o % 5 * 100 + F.col("size")).cast("string"), F.lit("(0)"), F.when(F.col("size") % 2 == 0, "C").otherwise("+"), F.concat(F.lit("R"), text("size")), F.concat(F.lit("F/"), text("contig")), F.lit("1 2 (3) 4"))
    head = F.lit("   SW   perc perc perc  query position in query matching repeat position in repeat\nscore   div. del. ins.  sequence begin end (left) repeat class/family begin end (left) ID\n\n")
    return readers.parse_rmsk_out(readers.lines(spark, file(spark, standin(spark, sf, "regions").select(F.concat(head, line).alias("value"))))).drop("ord")


@query(f"""WITH {sql('regions')} SELECT DISTINCT brand AS gene FROM regions WHERE ord > (SELECT min(ord) FROM regions)""")
def read_gene_list(spark: SparkSession, sf: str) -> DataFrame:
    lines = standin(spark, sf, "regions").select("ord", tabbed("brand", "kind").alias("line"))
    return readers.parse_gene_list(lines)


@query(f"""WITH {sql('regions')} SELECT brand AS gene, count(*) AS n, count(DISTINCT kind) AS kinds, min(ord)::VARCHAR AS any_id FROM regions GROUP BY brand""")
def read_mane(spark: SparkSession, sf: str) -> DataFrame:
    """A headered summary: transcripts of each gene. Which row is first depends on the files, so ids are checked as a set."""
    path = folder(spark, "mane")
    r = standin(spark, sf, "regions")
    first = r.groupBy("brand").agg(F.min("ord").alias("o"))
    sinks.write_table_tsv(r.join(first, "brand").select(F.col("brand").alias("#symbol"), text("o").alias("Ensembl_Gene"), F.col("kind").alias("Ensembl_nuc")), path)
    m = readers.parse_mane(readers.read_table(spark, path))
    return m.select("gene", F.size("transcripts").cast("long").alias("n"), F.size(F.array_distinct("transcripts")).cast("long").alias("kinds"), F.col("gene_id").alias("any_id"))


@query(f"""WITH {sql('regions')} SELECT 'c' || contig AS contig, "start", "end", size / 4.0 AS mean FROM regions""")
def read_window_means(spark: SparkSession, sf: str) -> DataFrame:
    lines = standin(spark, sf, "regions").select(tabbed(F.concat(F.lit("c"), text("contig")), "start", "end", "name", F.col("size") / 4))
    return readers.parse_window_means(readers.lines(spark, file(spark, lines, packed=True))).drop("ord")


@query(f"""WITH {sql('svs')} SELECT sv_id, sv AS read_pos, 'r' || ck AS read, dir2 AS dir, CASE WHEN ck % 2 = 0 THEN ck / 64.0 END AS ratio FROM svs WHERE chr1 <> 3""")
def read_read_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Supporting reads, their ratios and a contig list, each from its file."""
    v = standin(spark, sf, "svs")
    read = F.concat(F.lit("r"), text("ck"))
    reads = readers.parse_support_reads(readers.lines(spark, file(spark, v.select(tabbed("chr1", "pos1", "dir1", "chr2", "pos2", "dir2", "ins_len", "sv_id", read, "sv", "dir2")))))
    ratios = readers.parse_kmer_ratio(readers.lines(spark, file(spark, v.where("ck % 2 = 0").select(tabbed(read, "=1", "=2", F.col("ck") / 64)).distinct())))
    contigs = readers.parse_contig_list(readers.lines(spark, file(spark, v.where("chr1 <> 3").select(tabbed("chr1", "=x")).distinct())))
    own = v.select("sv_id", text("chr1").alias("contig"))
    return reads.join(own, "sv_id").join(contigs, "contig", "left_semi").join(ratios, "read", "left").select("sv_id", "read_pos", "read", "dir", "ratio")


@query(f"""WITH {sql('regions')} SELECT 'chr' || contig AS contig, "start" - 1 AS "start", "end" FROM regions""")
def read_ucsc_centromeres(spark: SparkSession, sf: str) -> DataFrame:
    lines = standin(spark, sf, "regions").select(tabbed("ord", F.concat(F.lit("chr"), text("contig")), "start", "end", "name"))
    return readers.parse_ucsc_centromeres(readers.lines(spark, file(spark, lines))).drop("ord")


def _sheet(spark: SparkSession, sf: str) -> DataFrame:
    """A sample sheet: one normal, tumours, one of unknown type, one without reads."""
    n = spark.read.parquet(f"{sf}/nation.parquet")
    k = F.col("n_nationkey")
    kind = F.when(k == 0, "normal").when(k == 1, "odd").otherwise("tumor")
    ont = F.when(k % 5 == 2, "").otherwise(F.concat(F.lit("a"), k.cast("string"), F.lit(".bam,b.bam")))
    return n.select(F.col("n_name").alias("sample"), kind.alias("type"), ont.alias("ont"), F.when(k % 4 == 1, "").otherwise("h.bam").alias("hifi"), F.lit("h1.fa").alias("assembly_hap1"), F.when(k == 7, "").otherwise("h2.fa").alias("assembly_hap2"), F.when(k % 2 == 0, "NATION_0").otherwise("").alias("paired_normal"))


_SHEET = """m AS (SELECT n_name AS sample, CASE n_nationkey WHEN 0 THEN 'normal' WHEN 1 THEN 'odd' ELSE 'tumor' END AS type, CASE WHEN n_nationkey % 5 = 2 THEN 0 ELSE 2 END AS ont, CASE WHEN n_nationkey % 4 = 1 THEN 0 ELSE 1 END AS hifi, n_nationkey AS k FROM nation)"""


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "sheet")
    _sheet(spark, sf).write.csv(path, sep="\t", header=True, emptyValue="")
    return readers.read_manifest(spark, path)


@query(f"WITH {_SHEET} SELECT sample, type, ont, hifi FROM m")
def read_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return _manifest(spark, sf).select("sample", "type", F.size("ont").alias("ont"), F.size("hifi").alias("hifi"))


@query(f"""WITH {_SHEET} SELECT sample, 'unknown type' AS problem FROM m WHERE type = 'odd' UNION ALL SELECT sample, 'no assembly pair' FROM m WHERE k = 7 UNION ALL SELECT sample, 'no reads' FROM m WHERE ont = 0 AND hifi = 0 UNION ALL SELECT '*', 'not one assembly pair'""")
def validate_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.validate_manifest(_manifest(spark, sf))


@query(f"""WITH {_SHEET} SELECT sample, 'NATION_0' AS normal, CASE WHEN hifi > 0 AND ont > 0 THEN 'hifi,ont' WHEN hifi > 0 THEN 'hifi' ELSE CASE WHEN ont > 0 THEN 'ont' ELSE '' END END AS seqtypes, CASE WHEN hifi > 0 THEN 'hifi' WHEN ont > 0 THEN 'ont' END AS first_type FROM m WHERE type = 'tumor'""")
def pair_samples(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.pair_samples(_manifest(spark, sf)).select("sample", "normal", F.array_join("seqtypes", ",").alias("seqtypes"), F.col("primary").alias("first_type"))


@query(f"""WITH {sql('blocks')} SELECT read, flag, contig, "start", "end", mapq, strand, q || 'M' AS cigar, repeat('A', q) AS seq FROM blocks""")
def read_aligned_blocks(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "alignments")
    b = standin(spark, sf, "blocks").withColumns({"cigar": F.concat(text("q"), F.lit("M")), "seq": F.repeat(F.lit("A"), F.col("q")), "other": F.lit(1)})
    b.write.parquet(path)
    return readers.read_aligned_blocks(spark, path)


# variant sets


def _variant_set(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    s = standin(spark, sf, "sites").select("site", "contig", "start", "ref", "alt")
    headers = standin(spark, sf, "regions").select(F.when(F.col("ord") % 2 == 0, F.concat(F.lit("##x="), text("size"))).otherwise(F.concat(F.lit("##contig=<ID="), text("ord"))).alias("line"), "ord")
    lengths = standin(spark, sf, "regions").groupBy(text("contig").alias("contig")).agg(F.max("end").alias("length"))
    return sinks.variant_set([s.where("site % 2 = 0"), s.where("site % 2 <> 0")], headers, lengths)


@query(f"""WITH {sql('sites')} SELECT site, contig, "start", ref, alt FROM sites""")
def variant_set(spark: SparkSession, sf: str) -> DataFrame:
    """Written and read back by contig."""
    path = folder(spark, "variants")
    variants_, metadata = _variant_set(spark, sf)
    sinks.write_variant_set(variants_, metadata, path)
    return spark.read.parquet(f"{path}/variants").select("site", F.col("contig").cast("long").alias("contig"), "start", "ref", "alt")


@query(f"""WITH {sql('regions')} SELECT '##x=' || size AS line, min(ord) AS ord FROM regions WHERE ord % 2 = 0 GROUP BY size UNION ALL SELECT '##contig=<ID=' || contig || ',length=' || max("end") || '>', NULL FROM regions GROUP BY contig
UNION ALL SELECT '##INFO=<ID=' || k || ',Number=1,Type=String,Description="' || d || '">', NULL FROM (VALUES ('HAPLOTYPE', 'Haplotype'), ('KMER_RATIO', 'K-mer ratio'), ('VAF', 'Variant allele fraction'), ('DEPTH', 'Depth'), ('NORMAL_VAF', 'VAF in the normal')) t(k, d)""")
def variant_set_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return _variant_set(spark, sf)[1]


@query(f"""WITH {sql('sites')}, s AS (SELECT DISTINCT site, ref, alt FROM sites) SELECT site, ref, alt, length(ref) <> length(alt) AS indel FROM s""")
def union_snv_indel(spark: SparkSession, sf: str) -> DataFrame:
    snv, indel = variants.split_snv_indel(standin(spark, sf, "sites").select("site", "ref", "alt").distinct())
    return tracks.united(snv.withColumn("indel", F.lit(False)), indel.withColumn("indel", F.lit(True)))


@query(f"""WITH {sql('regions', 'blocks')} SELECT contig, "start", "end" FROM regions UNION ALL SELECT contig, "start", "end" FROM blocks""")
def mask_union(spark: SparkSession, sf: str) -> DataFrame:
    cols = ("contig", "start", "end")
    return tracks.united(standin(spark, sf, "regions").select(*cols), standin(spark, sf, "blocks").select(*cols))


@query(f"""WITH {sql('regions')} SELECT contig, "start", "end", ord FROM regions WHERE contig = 3""")
def subset_chrom(spark: SparkSession, sf: str) -> DataFrame:
    return tracks.subset_chrom(standin(spark, sf, "regions").select("contig", "start", "end", "ord"), 3)


@query(f"""WITH {sql('regions')} SELECT ord, brand, '-' AS segdup, '-' AS population FROM regions""")
def fill_unevaluated(spark: SparkSession, sf: str) -> DataFrame:
    r = standin(spark, sf, "regions").select(text("ord").cast("long").alias("ord"), "brand")
    filled = variants.fill_unevaluated(r, ["brand", "segdup", "population"])
    return sinks.with_sentinels(filled).withColumn("ord", F.col("ord").cast("long"))


# orders, by the place that each row gets


@query(f"""WITH {sql('sites', 'regions')}, c AS (SELECT contig, min(ord) AS o FROM regions GROUP BY contig), s AS (SELECT DISTINCT contig, "start" AS pos FROM sites) SELECT contig, pos, row_number() OVER (ORDER BY o, pos) AS place FROM s JOIN c USING (contig)""")
def sort_by_contig_order(spark: SparkSession, sf: str) -> DataFrame:
    c = standin(spark, sf, "regions").groupBy("contig").agg(F.min("ord").alias("ord"))
    return placed(manifest.sort_by_contig_order(standin(spark, sf, "sites").select("contig", F.col("start").alias("pos")).distinct(), c))


@query(f"""WITH {sql('sites')}, s AS (SELECT DISTINCT contig, "start" FROM sites) SELECT contig, "start", row_number() OVER (ORDER BY contig, "start") AS place FROM s""")
def sort_by_locus(spark: SparkSession, sf: str) -> DataFrame:
    return placed(manifest.sort_by_locus(standin(spark, sf, "sites").select("contig", "start").distinct()))


@query(f"""WITH {sql('reftable')} SELECT chrom, r_start, ord, row_number() OVER (ORDER BY chrom, r_start, ord) AS place FROM reftable""")
def sort_ref_table(spark: SparkSession, sf: str) -> DataFrame:
    return placed(reftable.sort_ref_table(standin(spark, sf, "reftable").select("chrom", "r_start", "ord")))


@query(f"""WITH {sql('reads')} SELECT read, read_pos, ord, row_number() OVER (ORDER BY read, read_pos, ord) AS place FROM reads""")
def sort_support_reads(spark: SparkSession, sf: str) -> DataFrame:
    return placed(sv.sort_support_reads(standin(spark, sf, "reads").select("read", "read_pos", "ord")))


@query(f"""WITH {sql('reftable')} SELECT contig, c_end - c_start AS length, row_number() OVER (ORDER BY c_end - c_start DESC, contig) AS place FROM reftable""")
def contigs_by_size(spark: SparkSession, sf: str) -> DataFrame:
    return placed(manifest.contigs_by_size(standin(spark, sf, "reftable").select("contig", (F.col("c_end") - F.col("c_start")).alias("length"))))
