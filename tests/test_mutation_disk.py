"""The mutation flow stores what each step finds; genes are exchanged once and marked by gene sets before variants meet them."""

from locus.operators import pipelines, variants

FEATURES = "contig string, start long, `end` long, ord long, feature string, biotype string, gene string, gene_id string, transcript string"


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_steps_leave_one_exchange_each(spark, monkeypatch):
    calls = spark.createDataFrame([(f"i{k}", "c", k, k + 1, "A", "C") for k in range(30)], "id string, contig string, start long, `end` long, ref string, alt string")
    gene = lambda k: None if k == 4 else ("G1;H" if k % 3 == 1 else f"G{k % 3}")
    f = spark.createDataFrame([("c", k, k + 9, k, "CDS" if k % 2 else "exon", "protein_coding", gene(k), "i", f"T{k // 3}") for k in range(0, 20, 2)], FEATURES)
    sets = {"cancer_genes": spark.createDataFrame([("G1",), ("H",), ("H",), (None,)], "gene string"), "relevant_genes": spark.createDataFrame([("G0",), ("no",)], "gene string")}
    lengths, other = spark.createDataFrame([("c", 77), ("d", 5)], "contig string, length long"), calls.where("start % 4 = 0")
    tracks = {"features": f, "lengths": lengths, "other_caller": other.unionByName(other), **sets}
    genes = variants.annotate_genes(calls, f, ["id"])
    for n, flag in (("cancer_genes", "cancer"), ("relevant_genes", "medically_relevant")):
        genes = variants.flag_gene_sets(genes, sets[n], flag, ["id"])
    columns = ("id", "genes", "transcripts", "cancer", "medically_relevant", "contig_length", "other_caller")
    want = rows(variants.match_other_caller(variants.contig_size(genes, lengths), other), *columns)
    assert {r[3] for r in want} == {"False", "G1,H"} and {r[4] for r in want} == {"False", "G0"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = pipelines.annotated_mutations(calls, tracks)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hash") == 3 and "_lbin" not in plan  # calls, genes and the other caller, by the row's number
        assert variants.annotate_genes(calls, f, ["id"])._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(id") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(out, *columns) == want
    monkeypatch.setattr(pipelines, "MOST_CONTIGS", 1)
    assert rows(pipelines.annotated_mutations(calls, tracks), *columns) == want
