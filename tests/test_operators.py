"""Operators against naive definitions, and the behaviours that a reader would not guess."""

import random

import pytest
from pyspark.sql import functions as F

from locus.functions import fields, seq
from locus.operators import copynumber, elements, lift, manifest, reftable, sv, variants
from locus.operators import intervals as iv
from locus.sources import readers, sinks


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def text(spark, *lines):
    return spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "ord long, line string")


def spans(spark, data, extra=""):
    return spark.createDataFrame(data, "contig string, start long, `end` long" + extra)


def test_interval_join_is_naive_join(spark):
    r = random.Random(1)
    a = [(r.choice("xyz"), s := r.randrange(3000), s + r.randrange(1, 900), i) for i in range(200)]
    b = [(r.choice("xyw"), s := r.randrange(3000), s + r.randrange(1, 40), i) for i in range(300)]
    got = rows(iv.interval_join(spans(spark, a, ", i long"), spans(spark, b, ", j long"), width=100), "i", "j")
    assert got == sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and y[1] < x[2] and y[2] > x[1])


def test_merge_and_subtract_by_base(spark):
    r = random.Random(2)
    a = [("c", s := r.randrange(200), s + r.randrange(1, 30)) for _ in range(12)]
    g = [("c", s := r.randrange(200), s + r.randrange(1, 9)) for _ in range(9)]
    base = lambda x: {p for _, s, e in x for p in range(s, e)}
    merged = rows(iv.merge_intervals(spans(spark, a)), "contig", "start", "end")
    assert base(merged) == base(a) and all(x[2] < y[1] for x, y in zip(merged, merged[1:], strict=False))
    keyed = spans(spark, a).distinct().withColumns({"s0": F.col("start"), "e0": F.col("end")})
    pieces = rows(iv.subtract_intervals(keyed, spans(spark, g), ["contig", "s0", "e0"]), "contig", "start", "end", "s0", "e0")
    for s0, e0 in {(x[1], x[2]) for x in a}:
        assert base([p[:3] for p in pieces if p[3:] == (s0, e0)]) == set(range(s0, e0)) - base(g)


def test_first_match_takes_order_on_ties(spark):
    sites = spans(spark, [("c", 10, 11), ("absent", 10, 11)])
    track = spans(spark, [("c", 5, 20, 2, "late"), ("c", 5, 15, 1, "early"), ("c", 8, 12, 0, "later start")], ", ord long, name string")
    assert rows(iv.first_containing(sites, track, ["contig", "start", "end"], ["name"]), "contig", "name") == [("absent", None), ("c", "early")]


def test_reverse_complement(spark):
    s = spark.createDataFrame([("ACGTNacgtn-",), ("RYKM",)], "s string")
    assert [r[0] for r in s.select(seq.reverse_complement(seq.reverse_complement(F.col("s")))).collect()] == ["ACGTNacgtn-", "RYKM"]
    assert s.select(seq.reverse_complement(F.col("s"), "iupac")).collect()[1][0] == "KMRY"


def test_gff_start_quirk(spark):
    site = spans(spark, [("c", 9, 10)])
    f = spark.createDataFrame([("c", 10, 20, 0, "exon", "protein_coding", "g", "i", "t")], "contig string, start long, `end` long, ord long, feature string, biotype string, gene string, gene_id string, transcript string")
    assert variants.annotate_genes(site, f, ["contig", "start", "end"]).first().genes is None
    assert variants.annotate_genes(site, f, ["contig", "start", "end"], gff_start_quirk=False).first().genes == "g"


def test_duplicates_keep_assigned(spark):
    d = spark.createDataFrame([(1, "r", 5, "A", "C", "-", "0.9", "9"), (2, "r", 5, "T", "G", "hap1", "0.1", "3"), (3, "r", 6, "A", "T", "-", "x", "1"), (4, "r", 6, "A", "T", "-", "0.2", "1"), (5, None, None, "A", "T", "-", "1", "1")], "ord long, ref_contig string, ref_pos long, ref string, alt string, haplotype string, vaf string, depth string")
    assert rows(variants.drop_unassigned_duplicates(d), "ord") == [(2,), (4,), (5,)]


def test_hard_filter_without_reads(spark):
    d = spark.createDataFrame([("d_1", "-", "+", "PASS", 0, 0, 0), ("s", "+", "-", "x", 20, 5, 50)], "sv_id string, dir1 string, dir2 string, is_filter string, checked_tumor int, support_tumor int, checked_control int")
    assert rows(sv.sv_hard_filter(d), "sv_id", "is_filter") == [("d_1", "Low_normal_depth;Low_tumor_depth;False_dup"), ("s", "x")]


def test_flags(spark):
    d = spark.createDataFrame([("PASS",), ("a",)], "f string")
    assert [r[0] for r in d.select(fields.add_flag(F.col("f"), "b", F.lit(True))).collect()] == ["b", "a;b"]


def test_chain_both_strands(spark):
    t = text(spark, "chain 1 src 100 + 10 40 dst 200 + 20 52 7", "10 5 7", "15", "", "chain 1 src 100 + 50 80 dst 200 - 10 40 8", "30")
    blocks = lift.chain_blocks(readers.parse_chain(t))
    assert rows(blocks, "start", "end", "strand", "d0", "d1") == [(10, 20, "+", 20, 30), (25, 40, "+", 37, 52), (50, 80, "-", 160, 190)]
    p = spark.createDataFrame([("a", "src", 12), ("b", "src", 22), ("c", "src", 50), ("d", "src", 45)], "id string, contig string, pos long")
    assert rows(lift.liftover_points(p, blocks, ["id"]), "id", "status", "dst_pos", "dst_end") == [("a", "Match", 22, None), ("b", "Gap", 30, 37), ("c", "Match", 189, None), ("d", "Unmapped", None, None)]


def test_trimmed_blocks_do_not_overlap(spark):
    b = spark.createDataFrame([(1, "c", 0, 100, "+", "d", 0, 100), (2, "c", 80, 150, "-", "d", 90, 160), (3, "c", 90, 95, "+", "d", 300, 305)], "chain_id long, contig string, start long, `end` long, strand string, dst_contig string, d0 long, d1 long")
    got = rows(lift.trim_overlaps(b), "start", "end", "d0", "d1")
    assert all(x[1] <= y[0] for x, y in zip(got, got[1:], strict=False)) and all(e - s == d1 - d0 for s, e, d0, d1 in got)


def test_heaviest_increasing():
    r = random.Random(4)
    for _ in range(300):
        n = r.randrange(1, 9)
        keys, weights = [r.randrange(6) for _ in range(n)], [r.randrange(1, 9) for _ in range(n)]
        got = reftable.heaviest_increasing(keys, weights)
        assert [keys[i] for i in got] == sorted({keys[i] for i in got}) and got == sorted(got)
        best = max(sum(weights[i] for i in range(n) if m >> i & 1) for m in range(1 << n) if (k := [keys[i] for i in range(n) if m >> i & 1]) == sorted(set(k)))
        assert sum(weights[i] for i in got) == best


def test_cigar_blocks(spark):
    a = spark.createDataFrame([("r", "c", 100, "+", "5S10M2D3M50N20M4H"), ("q", "c", 0, "-", "3S7M")], "read string, contig string, start long, strand string, cigar string")
    assert rows(elements.aligned_blocks(a), "read", "start", "end", "q_start", "q_end") == [("q", 0, 7, 0, 7), ("r", 100, 115, 5, 18), ("r", 165, 185, 18, 38)]


def test_resolved_rows_do_not_overlap(spark):
    data = [("a", 0, 100, "+", "chr1", 0, 1000, 90), ("b", 0, 80, "-", "chr1", 900, 1700, 70), ("c", 0, 10, "+", "chr1", 100, 200, 9)]
    t = spark.createDataFrame(data, reftable.ROW)
    got = rows(reftable.resolve_ref_overlaps(t, t), "r_start", "r_end", "contig")
    assert [x[2] for x in got] == ["a", "b"] and got[0][1] <= got[1][0]


def test_readers(spark):
    assert rows(readers.parse_bed(text(spark, "c\t1\t5\tx", "c\tx\t5", "c\t1"), ["name"]), "contig", "start", "end", "name") == [("c", 1, 5, "x")]
    g = readers.parse_gff(text(spark, "#x", 'c\ts\texon\t3\t9\t.\t+\t.\tgene_id "G"; tag "a"; tag "b c";')).first()
    assert g.attrs == {"gene_id": "G", "tag": "b c"} and g.start == 3
    v = readers.parse_vcf(text(spark, "##m", "c\t7\t.\tA\tC,G\t5\tPASS\tDP=3;AF=0.1\tGT:DP\t0/1:4")).first()
    assert v.info["AF"] == "0.1" and v.alt == "C,G"
    f = readers.parse_fasta(text(spark, ">c1 rl:Chromosome", "ACGT", "AC", ">c2 x", "GG"))
    assert rows(readers.contig_lengths(f), "contig", "length") == [("c1", 6), ("c2", 2)]
    assert rows(readers.keep_primary_contigs(f), "contig").count(("c1",)) == 2
    assert rows(readers.parse_gene_list(text(spark, "A\t1", "B\t2", "B\t3")), "gene") == [("B",)]
    assert readers.parse_blast6(text(spark, "q\tt\t90.0\t5\t0\t0\t1\t5\t20\t16\t0\t50")).first().strand == "-"
    assert rows(readers.parse_rmsk_out(text(spark, "SW x x x x x x x x x x", "1 2 3 4 ins 1 9 (0) C L1 LINE/L1 1 2 3 4")), "insert_key", "start", "strand") == [("ins", 0, "-")]


def test_sentinels(spark):
    d = spark.createDataFrame([(1, None, True), (None, "x", None)], "a long, b string, c boolean")
    assert rows(sinks.with_sentinels(d), "a", "b", "c") == [("-", "x", "-"), ("1", "-", "True")]


def test_tsv_round_trip(spark, tmp_path):
    d = spark.createDataFrame([("c", 1, None), ("d", 2, 'q"')], "a string, b long, c string")
    sinks.write_table_tsv(d, f"{tmp_path}/t")
    assert rows(readers.read_table(spark, f"{tmp_path}/t", ["a"]), "a", "b", "c") == [("c", "1", "-"), ("d", "2", 'q"')]
    with pytest.raises(ValueError):
        readers.read_table(spark, f"{tmp_path}/t", ["z"])


def test_manifest(spark):
    m = spark.createDataFrame([("t", "tumor", ["o"], ["h"], "a", "b"), ("n", "normal", [], ["h"], "a", "b"), ("n", "odd", [], [], "", "b")], "sample string, type string, ont array<string>, hifi array<string>, assembly_hap1 string, assembly_hap2 string")
    assert {p for _, p in rows(manifest.validate_manifest(m), "sample", "problem")} >= {"unknown type", "no reads", "no assembly pair", "repeated name"}
    assert rows(manifest.pair_samples(m.where("assembly_hap1 <> ''")), "sample", "normal", "primary") == [("t", "n", "hifi")]


@pytest.mark.parametrize("strand", ["+", "-"])
def test_ref_jumps_keep_further_placements(spark, strand):
    """Kept: the largest block and those mostly off it; dropped: one placed already and one without a seed."""
    data = [("a", 0, 1_000_000, 0, 900_000, 60), ("b", 1_000_000, 1_400_000, 8_000_000, 390_000, 60), ("placed", 1_100_000, 1_150_000, 20_000_000, 40_000, 60), ("quarter", 1_390_000, 1_430_000, 40_000_000, 30_000, 60), ("no seed", 1_430_000, 1_480_000, 60_000_000, 40_000, 40)]
    flip = lambda r, n: 100_000_000 - r - n if strand == "-" else r
    got = [(c, s, e, strand, k, r := flip(t, e - s), r + e - s, m, q) for c, k in (("cut", "chr1"), ("other", "chr2")) for _, s, e, t, m, q in data]
    whole = ("whole", 0, 50_000, strand, "chr1", 0, 50_000, 40_000, 60)
    members = spark.createDataFrame([*got, whole], reftable.ROW + ", mapq int")
    chains = reftable.chain_stats(reftable.split_ref_jumps(members))
    want = [(c, k, s, e, m) for c, k in (("cut", "chr1"), ("other", "chr2")) for n, s, e, _, m, _ in data if n in ("a", "b", "quarter")]
    assert rows(chains, "contig", "chrom", "c_start", "c_end", "matched") == sorted([*want, ("whole", "chr1", 0, 50_000, 40_000)])


def test_satellites_are_taken_off_each_block(spark):
    """Two blocks of one chain on an acrocentric chromosome: each loses its own satellite once."""
    chains = spark.createDataFrame([("c", 0, 900_000, "+", "chr13", 0, 900_000, 800_000, 60), ("c", 900_000, 1_800_000, "+", "chr13", 9_000_000, 9_900_000, 800_000, 60), ("c", 1_900_000, 2_900_000, "+", "chr1", 0, 1_000_000, 900_000, 60)], reftable.ROW + ", mapq int")
    satellites = spans(spark, [("chr13", 0, 600_000), ("chr13", 9_000_000, 9_100_000)])
    # 300 kb and 800 kb are left of chr13
    assert {r.chrom for r in reftable.choose_chromosomes(chains, satellites).collect()} == {"chr1", "chr13"}


def test_adjacent_pairs_follow_directions(spark):
    """One segment of 1000 bases read on both strands, an insert between, and pairs whose directions do not fit."""
    kind = "read string, read_pos long, ord long, sv_id string, chr1 string, pos1 long, dir1 string, chr2 string, pos2 long, dir2 string, ins_len long, read_dir string"
    a, b, wrong = ("a", "x", 5, "+", "y", 1000, "-", 0), ("b", "y", 2000, "+", "z", 9, "-", 0), ("wrong", "y", 2000, "-", "z", 9, "-", 0)
    inserted = ("inserted", "x", 7, "+", "y", 1000, "-", 500)
    reads = [("r1", 100, a, "+"), ("r1", 1150, b, "+"), ("r2", 300, b, "-"), ("r2", 1280, a, "-"), ("r3", 100, a, "+"), ("r3", 1100, wrong, "+"), ("r4", 100, inserted, "+"), ("r4", 1600, b, "+"), ("r5", 100, b, "+"), ("r5", 1100, a, "+")]
    data = [(read, at, i, *v, turn) for i, (read, at, v, turn) in enumerate(reads)]
    got = rows(sv.read_adjacent_pairs(spark.createDataFrame(data, kind)), "from_sv", "to_sv", "from_turn", "to_turn", "first_size", "sizes")
    assert got == [("a", "b", "+", "+", 1000, "1050,980"), ("inserted", "b", "+", "+", 1000, "1000")]


def alignments(spark, data, mapq=60):
    return spark.createDataFrame([(*x, mapq) for x in data], reftable.ROW + ", mapq int")


def placed(df):
    return rows(df, "contig", "chrom", "c_start", "c_end", "r_start", "r_end")


def test_chains_between_chromosomes(spark):
    """Contained on both axes, denser by twice, and clipped with the seed checked again."""
    m = 1_000_000
    inside = alignments(spark, [("c", 0, 4 * m, "+", "chr1", 0, 4 * m, 3 * m), ("c", m, 2 * m, "+", "chr2", m, 2 * m, 900_000)])
    assert placed(reftable.resolve_contigs(inside)) == [("c", "chr1", 0, 4 * m, 0, 4 * m)]
    apart = alignments(spark, [("c", 0, 4 * m, "+", "chr1", 0, 4 * m, 3 * m), ("c", m, 2 * m, "+", "chr2", 90 * m, 91 * m, 900_000)])
    # Inside on the contig alone: no containment, no winner by density, so both lose the shared stretch.
    assert placed(reftable.resolve_contigs(apart)) == [("c", "chr1", 0, m, 0, m), ("c", "chr1", 2 * m, 4 * m, 2 * m, 4 * m)]
    denser = alignments(spark, [("c", 0, 2 * m, "+", "chr1", 0, 2 * m, 2 * m), ("c", m, 3 * m, "+", "chr2", 0, 2 * m, 600_000)])
    assert placed(reftable.resolve_contigs(denser)) == [("c", "chr1", 0, 2 * m, 0, 2 * m)]
    clipped = alignments(spark, [("c", 0, 2 * m, "-", "chr1", 0, 2 * m, 2 * m), ("c", m, 3 * m, "+", "chr2", 0, 2 * m, 1_500_000)])
    assert placed(reftable.resolve_contigs(clipped)) == [("c", "chr1", 0, m, m, 2 * m), ("c", "chr2", 2 * m, 3 * m, m, 2 * m)]
    seed = alignments(spark, [("c", 0, 2 * m, "+", "chr1", 0, 2 * m, 2 * m), ("c", 1_995_000, 2_003_000 + 5_000, "+", "chr2", 0, 13_000, 12_000)])
    assert {x[1] for x in placed(reftable.resolve_contigs(seed))} == {"chr1"}


def test_strands_of_one_chromosome_are_merged(spark):
    m = 1_000_000
    data = [(c, s, e, t, "chr1", s, e, e - s) for c, s, e, t in (("near", 0, 2 * m, "+"), ("near", 2 * m, 3 * m, "-"), ("far", 0, 2 * m, "+"), ("far", 9 * m, 10 * m, "-"))]
    got = {(r.contig, r.c_start, r.chain) for r in reftable.resolve_contigs(alignments(spark, data)).collect()}
    assert got == {("near", 0, 0), ("near", 2 * m, 0), ("far", 0, 0), ("far", 9 * m, 1)}


def test_pieces_of_a_chromosome(spark):
    """Cut at a jump of the reference; one row where the pieces overlap on the contig or satellite lies between."""
    m = 1_000_000
    cut = alignments(spark, [("c", 0, 2 * m, "+", "chr1", 0, 2 * m, 2 * m), ("c", 2 * m, 4 * m, "+", "chr1", 12 * m, 14 * m, 2 * m)])
    assert placed(reftable.choose_chromosomes(cut)) == [("c", "chr1", 0, 2 * m, 0, 2 * m), ("c", "chr1", 2 * m, 4 * m, 12 * m, 14 * m)]
    satellites = spans(spark, [("chr1", 3 * m, 11 * m)])
    assert placed(reftable.choose_chromosomes(cut, satellites)) == [("c", "chr1", 0, 4 * m, 0, 14 * m)]
    overlapping = alignments(spark, [("c", 0, 2 * m, "+", "chr1", 0, 2 * m, 2 * m), ("c", 1_800_000, 4 * m, "+", "chr1", 12 * m, 14_200_000, 2 * m)])
    assert placed(reftable.choose_chromosomes(overlapping)) == [("c", "chr1", 0, 4 * m, 0, 14_200_000)]
    small = alignments(spark, [("c", 0, 500_000, "+", "chr1", 0, 500_000, 1), ("c", 0, 400_000, "+", "chr2", 0, 400_000, 9)])
    assert placed(reftable.choose_chromosomes(small)) == [("c", "chr1", 0, 500_000, 0, 500_000)]


def test_rows_are_clipped_by_their_alignments(spark):
    """Less support loses the overlap and is cut back to its own alignments; a row inside another goes; both ways."""
    m = 1_000_000
    r = [("a", 0, 10 * m, "+", "chr1", 0, 10 * m, 9 * m), ("b", 0, 6 * m, "+", "chr1", 8 * m, 14 * m, 4 * m), ("in", 0, m, "+", "chr1", 3 * m, 4 * m, m)]
    backing = [("a", 0, 10 * m, "+", "chr1", 0, 10 * m, 9 * m), ("b", 0, 500_000, "+", "chr1", 8 * m, 8_500_000, 100_000), ("b", 3 * m, 6 * m, "+", "chr1", 11 * m, 14 * m, 3 * m), ("in", 0, m, "+", "chr1", 3 * m, 4 * m, m)]
    got = placed(reftable.resolve_ref_overlaps(spark.createDataFrame(r, reftable.ROW), alignments(spark, backing)))
    # b's claim from 10 Mb on begins at its first alignment there.
    assert got == [("a", "chr1", 0, 10 * m, 0, 10 * m), ("b", "chr1", 3 * m, 6 * m, 11 * m, 14 * m)]
    weak = alignments(spark, backing, 10)
    assert {x[0] for x in placed(reftable.resolve_ref_overlaps(spark.createDataFrame(r, reftable.ROW), weak))} <= {"a", "b"}


def test_assemblies_are_apart(spark):
    """The same rows of two haplotypes do not clash with each other."""
    r = spark.createDataFrame([("a", 0, 100, "+", "chr1", 0, 100, 90, h) for h in (1, 2)], reftable.ROW + ", hap int")
    assert reftable.resolve_ref_overlaps(r, r).count() == 2


def test_sex_chromosomes(spark):
    """chrX to the haplotype with more of it, chrY to the other; a contig that goes on through an overlap stays whole."""
    m = 1_000_000
    r = [("x1", 0, 10 * m, "+", "chrX", 0, 10 * m, 8 * m, 1), ("x2", 0, 2 * m, "+", "chrX", 4 * m, 6 * m, 2 * m, 2), ("y", 0, m, "+", "chrY", 0, m, m, 1), ("c", 0, m, "+", "chr1", 0, m, m, 2)]
    backing = [("x1", 0, 4 * m, "+", "chrX", 0, 4 * m, 4 * m), ("x1", 6 * m, 10 * m, "+", "chrX", 6 * m, 10 * m, 4 * m), ("x2", 0, 2 * m, "+", "chrX", 4 * m, 6 * m, 2 * m), ("y", 0, m, "+", "chrY", 0, m, m)]
    frame = spark.createDataFrame(r, reftable.ROW + ", hap int")
    got = rows(reftable.consolidate_sex_chroms(frame, alignments(spark, backing)), "contig", "hap", "r_start", "r_end")
    assert got == [("c", 2, 0, m), ("x1", 1, 0, 10 * m), ("y", 2, 0, m)]
    # A hole of the contig instead: x2 keeps the middle, x1 its flanks.
    hole = [(*backing[0],), ("x1", 4_100_000, 8_100_000, "+", "chrX", 6 * m, 10 * m, 4 * m), *backing[2:]]
    got = rows(reftable.consolidate_sex_chroms(frame, alignments(spark, hole)), "contig", "hap", "r_start", "r_end")
    assert got == [("c", 2, 0, m), ("x1", 1, 0, 4 * m), ("x1", 1, 6 * m, 10 * m), ("x2", 1, 4 * m, 6 * m), ("y", 2, 0, m)]
    # Both flanks on one stretch of the contig: the one with more matches stays.
    twice = [("x1", 0, 4 * m, "+", "chrX", 0, 4 * m, 4 * m), ("x1", 0, 4 * m, "+", "chrX", 6 * m, 10 * m, 3 * m), *backing[2:]]
    narrow = [("x1", 0, 4 * m, "+", "chrX", 0, 10 * m, 8 * m, 1), *r[1:]]
    got = rows(reftable.consolidate_sex_chroms(spark.createDataFrame(narrow, reftable.ROW + ", hap int"), alignments(spark, twice)).where("contig = 'x1'"), "r_start", "r_end")
    assert got == [(0, 4 * m)]
    plain = rows(reftable.consolidate_sex_chroms(frame), "contig", "r_start")
    assert plain == [("c", 0), ("x1", 0), ("y", 0)]


def test_rows_snap_to_telomeres(spark):
    r = spark.createDataFrame([("a", 50, 1000, "+", "chr1", 80, 1030, 900), ("b", 10, 900, "-", "chr1", 60, 950, 800), ("far", 900, 1000, "+", "chr2", 10, 110, 90)], reftable.ROW)
    contigs = spark.createDataFrame([("a", 1000), ("b", 1000), ("far", 1000)], "contig string, length long")
    chroms = spark.createDataFrame([("chr1", 5000), ("chr2", 5000)], "chrom string, length long")
    telo = spark.createDataFrame([("a", "start"), ("b", "end"), ("far", "start")], "contig string, side string")
    # a and b both reach the p arm of chr1: a has more matches. far lies too far from its contig's end.
    assert placed(reftable.snap_to_telomeres(r, contigs, chroms, telo)) == [("a", "chr1", 0, 1000, 0, 1030), ("b", "chr1", 10, 900, 60, 950), ("far", "chr2", 900, 1000, 10, 110)]


def test_paths_of_rearrangements(spark):
    """Edges in any order and on either strand give one path; the same break ends under another id are one variant."""
    ends = {"a": ("x", 5, "+", "y", 100, "-"), "b": ("y", 200, "+", "z", 300, "-"), "b2": ("z", 300, "-", "y", 200, "+"), "c": ("z", 400, "+", "w", 1, "-"), "lone": ("q", 1, "+", "q", 9, "-"), "pair": ("q", 50, "+", "q", 90, "-")}
    svs = spark.createDataFrame([(k, *v) for k, v in ends.items()], "sv_id string, chr1 string, pos1 long, dir1 string, chr2 string, pos2 long, dir2 string")
    # b2 is b turned around, so b2 with turn - is b as it stands; c comes first in the order of edges.
    edges = spark.createDataFrame([("b2", "c", "-", "+", 100, "7"), ("a", "b", "+", "+", 100, "5,6"), ("lone", "pair", "+", "+", 41, "9")], "from_sv string, to_sv string, from_turn string, to_turn string, first_size long, sizes string")
    got = rows(sv.link_rearrangements(edges, svs), "path", "step", "sv_id", "turn", "size", "reads")
    paths = {}
    for path, _, sv_id, turn, size, reads in got:
        paths.setdefault(path, []).append((sv_id, turn, size, reads))
    assert sorted(paths.values()) == [[("a", "+", 100, "5,6"), ("b2", "-", 100, "7"), ("c", "+", None, None)], [("lone", "+", 41, "9"), ("pair", "+", None, None)]]
    turned = spark.createDataFrame([("a", "b", "+", "+", 100, "5"), ("c", "b", "-", "-", 60, "8")], edges.schema)
    got = rows(sv.link_rearrangements(turned, svs), "step", "sv_id", "turn")
    assert got == [(0, "a", "+"), (1, "b", "+"), (2, "c", "+")]


def test_long_intervals_join_like_short_ones(spark):
    r = random.Random(9)
    a = [(r.choice("xy"), s := r.randrange(900_000), s + r.randrange(1, 2000), i) for i in range(150)]
    b = [(r.choice("xy"), s := r.randrange(900_000), s + r.choice([5, 300, 9_000, 400_000]), i) for i in range(150)]
    left, right = spans(spark, a, ", i long"), spans(spark, b, ", j long")
    want = sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and y[1] < x[2] and y[2] > x[1])
    assert rows(iv.interval_join(left, right, width=100), "i", "j") == want == rows(iv.interval_join(left, right, width=100, long=False), "i", "j")


def exchanges(df):
    """Exchanges and scans of a plan, reused ones left out."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange"), plan.count("Scan ")


def test_nested_bins_on_all_levels(spark):
    """Lengths on every level on either side, empty intervals and fractions; no job before the join is asked for."""
    r = random.Random(11)
    sizes = [0, 1, 50, 1500, 40_000, 900_000, 40_000_000]
    a = [(r.choice("xy"), s := r.randrange(60_000_000), s + r.choice(sizes), i) for i in range(120)]
    b = [(r.choice("xy"), s := r.randrange(60_000_000), s + r.choice(sizes), i) for i in range(120)]
    left, right = spans(spark, a, ", i long"), spans(spark, b, ", j long")
    want = sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and y[1] < x[2] and y[2] > x[1])
    before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    joined = iv.interval_join(left, right, width=100, both=True)
    assert spark.sparkContext._jsc.sc().dagScheduler().nextJobId() == before and exchanges(joined)[0] <= 2
    assert rows(joined, "i", "j") == want
    fine = [(c, s / 7, e / 7, i) for c, s, e, i in a], [(c, s / 7, e / 7, i) for c, s, e, i in b]
    kind = "contig string, start double, `end` double, "
    got = rows(iv.interval_join(spark.createDataFrame(fine[0], kind + "i long"), spark.createDataFrame(fine[1], kind + "j long"), width=100, both=True), "i", "j")
    assert got == sorted((x[3], y[3]) for x in fine[0] for y in fine[1] if x[0] == y[0] and y[1] < x[2] and y[2] > x[1])


@pytest.mark.parametrize(("gap", "tile"), [(0, 64), (7, 64), (150, 64), (0, 1 << 22)])
def test_unions_and_islands_by_a_walk(spark, gap, tile):
    r = random.Random(12)
    for n in (1, 40, 300):
        a = [(r.choice("xy"), s := r.randrange(3000), s + r.choice([0, 1, 5, 30, 64, 400]), i) for i in range(n)]
        want, island = [], {}
        for c in "xy":
            now = None
            for _, s, e, i in sorted(x for x in a if x[0] == c):
                if now and s <= now[2] + gap:
                    now[2] = max(now[2], e)
                else:
                    now = [c, s, e]
                    want.append(now)
                island[i] = now[1]
        df = spans(spark, a, ", i long")
        assert rows(iv.merge_intervals(df, gap=gap, tile=tile), "contig", "start", "end") == sorted(map(tuple, want))
        assert rows(iv.islanded(df, gap=gap, tile=tile), "i", "island") == sorted(island.items())


def test_unions_take_two_exchanges_and_one_scan(spark, tmp_path):
    spans(spark, [("x", 1, 5)]).write.parquet(str(tmp_path / "a"))
    assert exchanges(iv.merge_intervals(spark.read.parquet(str(tmp_path / "a")))) == (2, 1)


def test_trimmed_blocks_by_a_walk(spark):
    """Later blocks lose what earlier ones cover, whatever tiles they lie in."""
    r = random.Random(13)
    blocks, at = [], 0
    for i in range(150):
        at += r.choice([0, 3, 50, 3_000_000])
        n = r.choice([1, 60, 500, 9_000_000])
        blocks.append((i, "c", at, at + n, r.choice("+-"), "d", at * 2 + i, at * 2 + i + n))

    def once(rows_, lo, hi, other_lo, other_hi):
        out, top = [], None
        for b in sorted(rows_, key=lambda x: (x[lo], x[hi], x[0])):
            b, cut = list(b), max((top if top is not None else b[lo]) - b[lo], 0)
            top = max(top or 0, b[hi])
            if cut < b[hi] - b[lo]:
                b[lo] += cut
                if b[4] == "-":
                    b[other_hi] -= cut
                else:
                    b[other_lo] += cut
                out.append(b)
        return out

    want = once(once(blocks, 2, 3, 6, 7), 6, 7, 2, 3)
    df = spark.createDataFrame(blocks, "chain_id long, contig string, start long, `end` long, strand string, dst_contig string, d0 long, d1 long")
    assert rows(lift.trim_overlaps(df), "chain_id", "start", "end", "d0", "d1") == sorted((b[0], b[2], b[3], b[6], b[7]) for b in want)


def test_gaps_between_windows_are_cut_exactly(spark):
    segments = spark.createDataFrame([("a", "chr1", 13.0, 27.0, 6)], "hap string, chrom string, start double, `end` double, n_marks int")
    gaps = spark.createDataFrame([("a", "chr1", 8.4, 13.5), ("a", "chr1", 20.25, 21.0), ("b", "chr1", 14.0, 15.0)], "hap string, chrom string, start double, `end` double")
    assert rows(copynumber.split_gaps(segments, gaps, ["hap", "chrom"]), "start", "end", "n_marks") == [(13.5, 20.25, 6), (21.0, 27.0, 6)]


def test_merging_repeated_intervals(spark):
    a = [("c", s, s + n) for s in range(0, 3500, 350) for n in (10, 30, 30, 30, 20)] * 4
    assert rows(iv.merge_intervals(spans(spark, a)), "contig", "start", "end") == [("c", s, s + 30) for s in range(0, 3500, 350)]


def test_merging_across_tiles(spark):
    r = random.Random(10)
    a = [(r.choice("xy"), s := r.randrange(40_000_000), s + r.choice([1_000, 300_000, 9_000_000])) for _ in range(60)]
    want = []
    for s, e in (x for c in "xy" for x in iv.union_of_spans((s + (c == "y") * 10**9, e + (c == "y") * 10**9) for k, s, e in a if k == c)):
        want.append(("y" if s >= 10**9 else "x", s % 10**9, e % 10**9))
    assert rows(iv.merge_intervals(spans(spark, a)), "contig", "start", "end") == sorted(want)


def test_files_of_several_parts_keep_their_headers(spark, tmp_path, monkeypatch):
    """Runs of lines hand their header on, and files do not mix."""
    from locus.sources import order

    monkeypatch.setattr(order, "RUN", 3)
    for f in range(3):
        (tmp_path / f"{f}.fa").write_text("".join(f">c{f}{k} x\n" + "ACGTA\n" * (4 * k + f) + "AC\n" for k in range(3)))
    got = rows(readers.contig_lengths(readers.read_fasta(spark, str(tmp_path))), "contig", "length")
    assert got == [(f"c{f}{k}", 5 * (4 * k + f) + 2) for f in range(3) for k in range(3)]


def test_insertion_evidence_by_hand(spark):
    """Types in their priority; the polyT end decides the source; slots that disagree give none."""
    t, a = "T" * 12, "A" * 12
    svs = spark.createDataFrame([(n, "c", i, "+", "c", i + 1, "-", seq) for i, (n, seq) in enumerate([("orphan", t + "ACG" * 40), ("alu", "GATTC" * 30), ("disc", "GATTC" * 30 + a), ("none", "GC" * 80), ("short", "ACGT")])], "sv_id string, chr1 string, pos1 long, dir1 string, chr2 string, pos2 long, dir2 string, inserted string")
    keys = {r.sv_id: r.insert_key for r in elements.min_insert_len(svs).collect()}
    assert set(keys) == {"orphan", "alu", "disc", "none"}
    comp = spark.createDataFrame([(keys["orphan"], 0.001, 0.0, 0.0, None), (keys["alu"], 0.0, 0.9, 0.0, "Alu"), (keys["disc"], 0.9, 0.0, 0.0, "Inverted_LINE1")], "insert_key string, l1_ratio double, alu_ratio double, sva_ratio double, repeat_class string")
    al = spark.createDataFrame([(keys["orphan"], 2, "k", 1000, 1100, "+", 50, 90, 0), (keys["orphan"], 2, "m", 9000, 9100, "+", 5, 40, 1), (keys["disc"], 1, "k", 1000, 1100, "+", 1, 90, 0), (keys["disc"], 2, "k", 1000, 1100, "-", 1, 90, 0)], "insert_key string, hap int, contig string, start long, `end` long, strand string, q_start long, q_end long, ord long")
    l1 = spark.createDataFrame([("m", 9500, 9900, "-", "near", 0), ("m", 9800, 9990, "-", "further", 1), ("m", 9400, 9450, "+", "wrong strand", 2)], "contig string, start long, `end` long, strand string, name string, ord long")
    tsd = spark.createDataFrame([(keys["alu"], 12, "right")], "insert_key string, tsd_len int, side string")
    psd = spark.createDataFrame([(keys["alu"], "tx", 0.8, 2)], "insert_key string, transcript string, match_ratio double, n_exons long")
    got = {r.sv_id: r for r in elements.insertion_evidence(svs, comp, al, l1, tsd, psd).collect()}
    assert {k: (r.insert_type, r.is_inversion, r.poly, r.source_1, r.source_2) for k, r in got.items()} == {"orphan": ("Orphan_L1", "NA", "polyT", "near", None), "alu": ("Alu", "NA", None, None, None), "disc": ("Solo_L1", "Inverted", "polyA", None, None), "none": (None, None, None, None, None)}
    assert got["alu"].tsd_len == 12 and got["disc"].discordant


def test_chains_of_hits(spark):
    """A deletion in the element is no break; a step back over the query is; so is a gap."""
    kind = "contig string, strand string, start long, `end` long, q_start long, q_end long"
    hits = [("del", "+", 0, 2000, 0, 2000), ("del", "+", 2000, 4000, 3500, 5500), ("back", "+", 0, 3100, 0, 3100), ("back", "+", 3100, 6200, 100, 3200), ("minus", "-", 0, 2000, 3500, 5500), ("minus", "-", 2100, 4100, 0, 2000), ("gap", "+", 0, 2000, 0, 2000), ("gap", "+", 2400, 4400, 2000, 4000)]
    got = rows(elements.chain_hsps(spark.createDataFrame(hits, kind), 6000, min_cov=0.5), "contig", "start", "end", "covered")
    assert got == [("back", 0, 3100, 3100), ("back", 3100, 6200, 3100), ("del", 0, 4000, 4000), ("minus", 0, 4100, 4000)]
