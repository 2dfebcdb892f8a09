"""Target sites with gaps against plain dynamic programming, bounded pileups, and identities of chains."""

import random

from pyspark.sql import functions as F

from locus.operators import elements, kmers

TURN = str.maketrans("ACGT", "TGCA")


def plain_site(a, b, right):
    """All alignments that begin within two bases of both ends, over the whole matrix: (score, side, -end, columns) at best."""
    cells, found = {}, []
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            ways = [(0, 0)] if i <= 2 and j <= 2 else []
            ways += [cells[i - 1, j - 1]] if (i - 1, j - 1) in cells else []
            here = [(s + (1 if x == y else -8), n + 1) for s, n in ways]
            here += [(s - 8, n + 1) for s, n in (cells[k] for k in ((i - 1, j), (i, j - 1)) if k in cells)]
            if here:
                cells[i, j] = s, n = max(here)
                same = n - (n - s) / 9
                if s >= 5 and same >= 5 and same >= 0.8 * n:
                    found.append((s, right, -i, n))
    return max(found, default=None)


def test_sites_with_planted_gaps(spark):
    rng = random.Random(41)
    data, want = [], {}
    for k in range(1000):
        seq = "".join(rng.choice("ACGT") for _ in range(60))
        right = list(seq[rng.randrange(0, 4) :][:21])
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            at = rng.randrange(3, len(right))
            right[at : at + rng.choice([0, 1, 1])] = rng.choice(["", "A", "C", "GT"])
        right = ("".join(rng.choice("ACGT") for _ in range(rng.choice([0, 0, 1, 2, 4]))) + "".join(right))[:21] if k % 7 else ""
        rc = seq[::-1].translate(TURN)
        left = rc[1:22] if k % 5 == 0 else "".join(rng.choice("ACGT") for _ in range(21))
        data.append((k, seq, right, left, rc))
        best = max((t for t in (plain_site(seq[:20], right, 1), plain_site(rc[:20], left, 0)) if t), default=None)
        if best:
            want[k] = (best[3], "right" if best[1] else "left")
    got = {r.insert_key: (r.tsd_len, r.side) for r in elements.target_site_duplication(spark.createDataFrame(data, "insert_key int, seq string, right string, left string, seq_rc string")).collect()}
    assert got == want and len(want) > 400
    assert any(n > 13 for n, _ in want.values())


def test_sites_take_no_expression_for_each_cell(spark):
    """The band was unfolded into the plan: hundreds of interpreted cells for each row and step."""
    rows = [(k, "ACGTTGCAAC" * 6, "CGTTGCAACACGTTGCAACAC" if k % 2 else None, "", "é" * 30) for k in range(50_000)]
    out = elements.target_site_duplication(spark.createDataFrame(rows, "insert_key int, seq string, right string, left string, seq_rc string"))
    assert "greatest" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert {(r.tsd_len, r.side, r["count"]) for r in out.groupBy("tsd_len", "side").count().collect()} == {(19, "right", 25_000)}


def test_pileups_keep_the_first_reads(spark):
    """A hot site with more reads than parts, cut before its list is made."""
    reads = spark.range(20_000).select(F.format_string("r%05d", "id").alias("read"), F.lit("c").alias("contig"), F.lit(10).cast("long").alias("start"), F.lit(14).cast("long").alias("end"), F.lit("ACGT").alias("seq"))
    sites = spark.createDataFrame([("s", "c", 12), ("t", "c", 99)], "site string, contig string, pos long")
    r = kmers.pileup_at_sites(sites, reads, ["site"], max_depth=50).collect()
    assert [(x.site, x.depth, x.bases) for x in r] == [("s", 50, "G" * 50)]
    assert r[0].reads.split(",") == [f"r{i:05}" for i in range(50)]
    cut = kmers.pileup_at_sites(sites, reads, ["site"], max_depth=50)._jdf.queryExecution().optimizedPlan().toString()
    assert cut.index("collect_list") < cut.index("row_number")


def test_pileups_cut_reads_before_they_move(spark):
    """Each pair was exchanged twice for its cut, and lists once more; pieces stood in every bin that they touched."""
    reads = spark.range(300).select(F.col("id").alias("read"), F.lit("c").alias("contig"), (F.col("id") * 7).alias("start"), (F.col("id") * 7 + 95).alias("end"), F.repeat(F.lit("ACGTA"), F.lit(19)).alias("seq"))
    sites = spark.range(0, 2200, 11).select(F.lit("c").alias("contig"), F.col("id").alias("pos"), F.col("id").alias("p"))
    want = {}
    for p in range(0, 2200, 11):
        at = [k for k in range(300) if k * 7 <= p < k * 7 + 95]
        if at:
            want[p] = (len(at), "".join("ACGTA"[(p - k * 7) % 5] for k in at), ",".join(map(str, at)))
    whole = kmers.pileup_at_sites(sites, reads, ["contig", "p"], piece=40)
    assert {r.p: (r.depth, r.bases, r.reads) for r in whole.collect()} == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert plan(kmers.pileup_at_sites(sites, reads, ["contig", "p"], piece=40)).count("Exchange hash") == 2
        first = kmers.pileup_at_sites(sites, reads, ["contig", "p"], max_depth=3, piece=40)
        assert plan(first).count("Exchange hash") == 3 and "WindowGroupLimit" in plan(first)
        assert {r.p: (r.depth, r.bases) for r in first.collect()} == {p: (min(n, 3), b[:3]) for p, (n, b, _) in want.items()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_chain_identity(spark):
    kind = "contig string, strand string, start long, `end` long, q_start long, q_end long, n_match long, aligned long"
    hits = [("c", "+", 0, 2000, 0, 2000, 1900, 2000), ("c", "+", 2100, 4000, 2100, 4000, 1000, 1900)]
    got = elements.chain_hsps(spark.createDataFrame(hits, kind), 6000, min_cov=0.5).first()
    assert (got.n_hits, got.identity, got.covered) == (2, round(2900 / 3900, 4), 3900)
    assert elements.chain_hsps(spark.createDataFrame(hits, kind).drop("n_match"), 6000, min_cov=0.5).first().identity is None
