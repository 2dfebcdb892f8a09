"""The three flows over all rows, their SQL composed of that of their steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.operators import pipelines

from . import mutation_queries as mutations
from . import sv_queries as svs
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


_PLACE, _ALLELE = 'USING (site, contig, "start", "end")', 'USING (site, contig, "start", ref, alt)'
_STEPS = {"annotate_repeat": _PLACE, "annotate_misassembly": _PLACE, "annotate_centromere": _PLACE, "annotate_segdup": _PLACE, "annotate_genes": _PLACE, "flag_gene_sets": _PLACE, "contig_size": _PLACE, "match_other_caller": _ALLELE, "annotate_population": _ALLELE}
_CALLS = """m AS (SELECT DISTINCT concat_ws('_', site, contig, "start", "end", ref, alt) AS id, site, contig, "start", "end", ref, alt FROM sites)"""
_COLUMNS = ("rmsk_class", "rmsk_type", "misassembly", "centromere", "similarity", "segdup", "genes", "transcripts", "cancer", "contig_length", "other_caller")


@query(f"""WITH {sql('sites')}, {_CALLS}, {', '.join(f"q_{n} AS ({mutations.SQL[n]})" for n in _STEPS)}
SELECT id, {', '.join(_COLUMNS)}, CASE WHEN site % 3 < 2 THEN q_annotate_population.population END AS population, CASE WHEN site % 3 < 2 THEN contig END AS GRCh38_contig, CASE WHEN site % 3 < 2 THEN "start" END AS GRCh38_pos, CASE site % 3 WHEN 0 THEN 'Match' WHEN 1 THEN 'Gap' ELSE 'Unmapped' END AS GRCh38_status
FROM m {' '.join(f'LEFT JOIN q_{n} {on}' for n, on in _STEPS.items())}""")
def annotated_mutation_table(spark: SparkSession, sf: str) -> DataFrame:
    cols = ("site", "contig", "start", "end", "ref", "alt")
    s = standin(spark, sf, "sites")
    calls = s.select(*cols).distinct().select(F.concat_ws("_", *[F.col(c).cast("string") for c in cols]).alias("id"), *cols)  # the id follows from them
    r = standin(spark, sf, "regions")
    track = lambda where, **payload: r.where(where).select("contig", "start", "end", "ord", *[F.col(v).alias(k) for k, v in payload.items()])
    features = mutations._features(spark, sf)
    tracks = {
        "repeats": track("true", rmsk_class="brand", rmsk_type="kind"), "misassembly": r.where("size < 12").select("contig", "start", "end"), "centromeres": track("size >= 25", centromere="name"), "segdups": track("size > 20", similarity="size"),
        "features": features, "cancer_genes": features.select("gene").where("gene like '%1'"), "other_caller": s.where("ln >= 4"), "lengths": r.groupBy("contig").agg(F.max("end").alias("length")),
    }
    # Two of three calls lift to where they are; the population stands there.
    status = F.when(F.col("site") % 3 == 0, "Match").when(F.col("site") % 3 == 1, "Gap").otherwise("Unmapped")
    tracks["lift_GRCh38"] = calls.select("id", F.col("contig").alias("dst_contig"), F.col("start").alias("dst_pos"), status.alias("status"))
    tracks["population"] = s.where("ln < 5").select("site", "contig", F.col("start").alias("pos"), "ref", "alt", F.lit("x").alias("id")).distinct().select("*", (F.col("site") * 100 + F.length("ref")).alias("ord"))
    return pipelines.annotated_mutations(calls, tracks).select("id", *_COLUMNS, "population", "GRCh38_contig", "GRCh38_pos", "GRCh38_status")


_SV_STEPS = ("classify_sv_type", "annotate_bp", "sv_contig_size", "match_sv_callset", "in_simple_repeat", "decide_array_change")


def _at(k: int, name: str, column: str, where: str) -> str:
    """The first record of a track at a break end, as a CTE's text."""
    return f"""{name}_{k} AS (SELECT sv_id, arg_min(r.{column}, r."start" * 100000 + r.ord) AS {name}_{k} FROM svs JOIN regions r ON svs.chr{k} = r.contig AND r."start" <= pos{k} AND r."end" > pos{k} AND {where} GROUP BY sv_id)"""


_BOTH = [(n, c, w, k) for n, c, w in (("rmsk_class", "kind", "size >= 10"), ("centromere", "name", "size >= 25")) for k in (1, 2)]


@query(f"""WITH {sql('svs', 'regions')}, {', '.join(f"q_{n} AS ({svs.SQL[n]})" for n in _SV_STEPS)}, {', '.join(_at(k, n, c, w) for n, c, w, k in _BOTH)}
SELECT sv_id, sv_type, gene_1, gene_2, {', '.join(f"{n}_{k}" for n, _, _, k in _BOTH)}, size_1, size_2, other_sv, in_repeat, repeat_reason, q_decide_array_change.is_filter, CASE WHEN svs.sv % 3 > 0 THEN round_even((svs.ck % 50 + 50 + svs.ck % 7) / 128.0::DOUBLE, 3) END AS kmer_ratio
FROM q_{_SV_STEPS[0]} {' '.join(f'LEFT JOIN q_{n} USING (sv_id)' for n in _SV_STEPS[1:])} {' '.join(f'LEFT JOIN {n}_{k} USING (sv_id)' for n, _, _, k in _BOTH)} JOIN svs USING (sv_id)""")
def annotated_sv_table(spark: SparkSession, sf: str) -> DataFrame:
    v, r = svs.svs(spark, sf).withColumn("identical", F.col("sv_id")), standin(spark, sf, "regions")
    c = F.col("ck")
    scores = v.where("is_filter = 'PASS'").select("sv_id", (c % 100).alias("ins_len"), ((c % 11) / 10).alias("flank_coverage"), ((c % 7) / 10).alias("flank_self_repeat"), ((c % 13) / 13).alias("self_repeat"))
    reads = v.where("sv % 3 > 0").select("sv_id", F.explode(F.array(c % 50, c % 7 + 50)).alias("read"))
    track = lambda where, column, name: r.where(where).select("contig", "start", "end", "ord", F.col(column).alias(name))
    tracks = {
        "genes": track("true", "brand", "gene"), "repeats": track("size >= 10", "kind", "rmsk_class"), "centromeres": track("size >= 25", "name", "centromere"), "lengths": r.groupBy("contig").agg(F.max("end").alias("length")),
        "other_svs": svs._other(spark, sf), "simple_repeats": r, "repeat_scores": scores, "kmer_reads": reads, "kmer_ratios": reads.select("read").distinct().withColumn("ratio", F.col("read") / 64),
    }
    columns = ("sv_id", "sv_type", "gene_1", "gene_2", "rmsk_class_1", "rmsk_class_2", "centromere_1", "centromere_2", "size_1", "size_2", "other_sv", "in_repeat", "repeat_reason", "is_filter")
    return pipelines.annotated_svs(v, tracks).select(*columns, "kmer_ratio")


@query()
def copy_number_table(spark: SparkSession, sf: str) -> DataFrame:
    """From the reference table and alignments of tumour and normal to segments in copies."""
    c = F.col
    rows = standin(spark, sf, "reftable").withColumn("chrom", c("chrom") % 3)
    start = c("l_suppkey") * 1000 + (c("l_partkey") * 37) % 150000
    reads = spark.read.parquet(f"{sf}/lineitem.parquet").select((c("l_linenumber") % 2).alias("sample"), F.when(c("l_orderkey") % 2 == 0, "tumor").otherwise("normal").alias("type"), (c("l_suppkey") % 2).alias("hap"), c("l_suppkey").alias("contig"), start.alias("start"), (start + 40000 + c("l_quantity").cast("int") * 400).alias("end"), F.lit(60).alias("mapq"), F.lit(0).alias("flag"))
    return pipelines.copy_number_table(rows, reads)
