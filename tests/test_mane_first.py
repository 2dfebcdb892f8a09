"""Chosen transcripts: features that are not listed go before the variants meet them."""

from locus.operators import variants


def test_features_are_chosen_before_the_join(spark):
    f = spark.createDataFrame([("a", 0, 90, i, "exon", "protein_coding", f"G{i % 3}", f"I{i % 3}", f"T{i}") for i in range(9)], "contig string, start long, `end` long, ord long, feature string, biotype string, gene string, gene_id string, transcript string")
    mane = spark.createDataFrame([("G1", "I1", ["T4", "T1", "T8"]), ("G2", "I0", ["T2"])], "gene string, gene_id string, transcripts array<string>")
    sites = spark.createDataFrame([(1, "a", 5, 6), (2, "b", 5, 6), (3, "a", 80, 91)], "site long, contig string, start long, `end` long")
    out = variants.annotate_genes(sites, f, ["site"], mane).select("site", "genes", "transcripts")
    assert sorted(map(tuple, out.collect())) == [(1, "G1", "T1:exon,T4:exon"), (2, None, None), (3, None, None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("array_contains(_t") > plan.index("_lbin")  # further down, on the side of the features
