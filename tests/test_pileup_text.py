"""Depth-limited pileups: texts stay where they are until it is known which reads stay."""

from pyspark.sql import functions as F

from locus.operators import kmers


def test_ties_twins_and_nameless_reads(spark):
    """One read may cover a site twice, two blocks may differ in their text alone, and a read may lack a name: order is that of (read, base, quality)."""
    kind = "read string, contig string, start long, `end` long, seq string, qual string"
    rows = [("a", "c", 0, 4, "ACGT", "1234"), ("a", "c", 2, 5, "TTT", "555"), ("a", "c", 2, 5, "CTT", "666"), ("a", "c", 2, 6, "CAAA", "5777"), ("b", "c", 2, 5, "GGG", "888"), ("z", "d", 0, 3, "TGA", "999")]
    sites = spark.createDataFrame([(1, "c", 2), (2, "c", 4), (3, "d", 9), (4, "d", 1)], "k int, contig string, pos long")
    for more in ([], [(None, "c", 1, 4, "CCC", "000"), (None, "c", 1, 4, "CCC", "000"), (None, None, 1, 4, "CCC", "000")]):
        for most in (1, 2, 3, 4, 9, 2000):
            want = {}
            for k, c, p in sites.collect():
                at = sorted(((r is not None, r or "", s[p - a], q[p - a]) for r, d, a, b, s, q in rows + more if d == c and a <= p < b))[:most]
                if at:
                    want[k] = (len(at), "".join(x[2] for x in at), "".join(x[3] for x in at), ",".join(x[1] for x in at if x[0]))
            got = kmers.pileup_at_sites(sites, spark.createDataFrame(rows + more, kind), ["k"], max_depth=most)
            assert {r.k: (r.depth, r.bases, r.quals, r.reads) for r in got.collect()} == want


def test_texts_of_distinct_blocks_are_not_exchanged(spark):
    """Of 96 bases and qualities a block all were exchanged in pieces, for three reads a site."""
    reads = spark.range(3000).select((F.col("id") % 1500).alias("read"), (F.col("id") % 2).alias("contig"), (F.col("id") % 10).alias("start")).distinct()
    reads = reads.select("*", (F.col("start") + 96).alias("end"), F.repeat(F.md5(F.col("read").cast("string")), F.lit(3)).alias("seq"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = kmers.pileup_at_sites(spark.range(0, 96, 5).select((F.col("id") % 2).alias("contig"), F.col("id").alias("pos"), F.col("id").alias("p")), reads, ["p"], max_depth=3, piece=40)
        exchanged = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hash" in line]
        # Of the blocks before they have a text, of the reads that stay on their way to them, and of the bases to their sites.
        assert (len(exchanged), sum("_low" in line for line in exchanged)) == (3, 1), "\n".join(line.strip() for line in exchanged)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
