"""Every query with SQL against it; the others against naive definitions over the same rows."""

import pytest
from pyspark.sql import functions as F

from locus.operators import pipelines, reftable
from locus.operators.intervals import union_of_spans
from locus.plans import copy_queries, element_queries, pipeline_queries
from locus.plans.registry import QUERIES, SQL
from locus.plans.standins import standin
from tests.oracle import same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, name):
    same(spark, QUERIES[name], SQL[name], SF)


def test_queries_without_sql_have_a_test_here():
    assert set(QUERIES) - set(SQL) == {"chain_hsps", "reference_table", "consolidate_sex_chroms", "call_copy_number", "copy_number_table", "insertion_evidence", "flank_alignment"}


def test_chain_hsps(spark):
    """One walk over all hits of a contig's strand, without islands."""
    hits = standin(spark, SF, "blocks").select("contig", "strand", "start", "end").distinct().collect()
    groups, want = {}, []
    for h in hits:
        groups.setdefault((h.contig, h.strand), []).append((h.start, h.end, h.start % 6000, h.start % 6000 + h.end - h.start))
    for (contig, strand), found in groups.items():
        chains = []
        for s, e, a, b in sorted(found):
            c = chains[-1] if chains else None
            if c and s - c[-1][1] <= 1000 and e - c[0][0] <= 6300 and (a >= max(x[3] for x in c) - 1000 if strand == "+" else b <= min(x[2] for x in c) + 1000):
                c.append((s, e, a, b))
            else:
                chains.append([(s, e, a, b)])
        for c in chains:
            covered, lo, hi = sum(b - a for a, b in union_of_spans((x[2], x[3]) for x in c)), c[0][0], max(x[1] for x in c)
            if covered >= 0.55 * 6000 and 3000 <= hi - lo <= 6300:
                want.append((contig, strand, lo, hi, covered, len(c), round(sum(x[1] - x[0] - x[0] % 7 for x in c) / sum(x[1] - x[0] for x in c), 4)))
    assert sorted(tuple(r) for r in copy_queries.chain_hsps(spark, SF).collect()) == sorted(want) and want


def disjoint(rows, key, lo, hi):
    by = {}
    for r in rows:
        by.setdefault(key(r), []).append((r[lo], r[hi]))
    return all(a[1] <= b[0] for spans in by.values() for a, b in zip(sorted(spans), sorted(spans)[1:], strict=False))


def test_reference_table(spark):
    """No overlap within an assembly; every row lies on alignments of its contig and chromosome, matches included, or reaches a terminus by a telomere."""
    got = copy_queries.reference_table(spark, SF).collect()
    m = copy_queries.members(spark, SF).withColumn("hap", F.col("ord") % 2)
    ends = copy_queries.termini(m)
    chrom, contig = ({r[0]: r.length for r in ends[k].collect()} for k in ("chrom_lengths", "contig_lengths"))
    telomeres = {(r.contig, r.side) for r in ends["telomeres"].collect()}
    own, snapped = {}, 0
    for r in m.collect():
        own.setdefault((r.hap, r.contig, r.chrom), []).append(r)
    assert got and disjoint(got, lambda r: (r.hap, r.chrom), "r_start", "r_end")
    for r in got:
        mine = own[r.hap, r.contig, r.chrom]
        assert r.r_start < r.r_end and r.c_start < r.c_end and r.matched <= sum(x.matched for x in mine)
        start, end = (r.contig, "start") in telomeres, (r.contig, "end") in telomeres
        p_arm, q_arm = (start, end) if r.strand == "+" else (end, start)
        assert min(x.r_start for x in mine) <= r.r_start or (p_arm and r.r_start == 0)
        assert r.r_end <= max(x.r_end for x in mine) or (q_arm and r.r_end == chrom[r.chrom])
        assert r.c_start >= min(x.c_start for x in mine) or (start and r.c_start == 0)
        assert r.c_end <= max(x.c_end for x in mine) or (end and r.c_end == contig[r.contig])
        snapped += r.r_start < min(x.r_start for x in mine) or r.r_end > max(x.r_end for x in mine)
    assert snapped


def test_reference_table_one_contig_at_a_time(spark):
    """Placement does not look at other contigs: each alone gives the rows that all together give."""
    m = copy_queries.members(spark, SF)
    placed = lambda df: sorted(tuple(r) for r in reftable.choose_chromosomes(reftable.resolve_contigs(reftable.best_chain(df), 0.01).drop("chain")).select(*reftable.ROW_NAMES).collect())
    contigs = [r.contig for r in m.select("contig").distinct().limit(3).collect()]
    assert placed(m.where(F.col("contig").isin(contigs))) == sorted(x for c in contigs for x in placed(m.where(F.col("contig") == c)))


def test_consolidate_sex_chroms(spark):
    got = copy_queries.consolidate_sex_chroms(spark, SF).collect()
    sex = [r for r in got if r.chrom in ("chrX", "chrY")]
    assert disjoint(sex, lambda r: (r.hap, r.chrom), "r_start", "r_end") and len({r.hap for r in sex if r.chrom == "chrX"}) == 1
    assert not {r.hap for r in sex if r.chrom == "chrX"} & {r.hap for r in sex if r.chrom == "chrY"}
    plain = copy_queries.members(spark, SF).where("chrom not in ('0', '1')").count()
    assert sum(r.chrom not in ("chrX", "chrY") for r in got) == plain


def test_insertion_evidence(spark):
    """Types follow from the evidence beside them, and every insertion of 100 bases has one row."""
    got = element_queries.insertion_evidence(spark, SF).collect()
    assert len({r.sv_id for r in got}) == len(got) > 100
    seen = set()
    for r in got:
        sources = [x for x in (r.source_1, r.source_2) if x]
        if sources:
            want = "Orphan_L1" if (r.l1_ratio or 0.0) < 0.01 else "Partnered_L1"
        elif r.class_1 == "Solo":
            want = "Solo_L1"
        else:
            want = r.insert_type if r.insert_type in ("Alu", "SVA") else "PSD" if r.transcript else None
        assert r.insert_type == want, r
        seen.add(want)
    assert {"Alu", "SVA", "PSD", "Solo_L1", None} <= seen and seen & {"Orphan_L1", "Partnered_L1"}


def test_steps_without_tracks_keep_the_schema(spark):
    calls = spark.createDataFrame([("a", "c", 5, 6, "A", "T")], "id string, contig string, start long, `end` long, ref string, alt string")
    bare = pipelines.annotated_mutations(calls, {})
    assert {"rmsk_class", "genes", "cancer", "population", "segdup", "contig_length"} <= set(bare.columns) and bare.first().genes is None
    lengths = spark.createDataFrame([("c", 99)], "contig string, length long")
    lift = spark.createDataFrame([("a", "chr1", 7, "Match")], "id string, dst_contig string, dst_pos long, status string")
    known = spark.createDataFrame([("chr1", 7, "rs1", "A", "T", 0)], "contig string, pos long, id string, ref string, alt string, ord long")
    full = pipelines.annotated_mutations(calls, {"lengths": lengths, "lift_GRCh38": lift, "population": known})
    assert set(bare.columns) <= set(full.columns) and full.first().contig_length == 99 and full.first().population == "chr1,7,rs1,A,T"


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
