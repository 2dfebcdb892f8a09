"""The mutation flow moves a number for each call, not the call's long id."""

from locus.operators import pipelines


def test_steps_are_joined_by_a_number(spark):
    kind = "id string, contig string, start long, `end` long, ref string, alt string, note int"
    calls = spark.createDataFrame([(f"call_{k}_" + "x" * 60, "c", k * 10, k * 10 + 1, "A", "C", k) for k in range(40)], kind)
    spans = spark.createDataFrame([("c", 95, 205, 1, "R", "t")], "contig string, start long, `end` long, ord int, rmsk_class string, rmsk_type string")
    lift = calls.selectExpr("id", "contig as dst_contig", "start + 1 as dst_pos", "if(note % 2 = 0, 'Match', 'Unmapped') as status")
    other = calls.where("note % 4 = 0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = pipelines.annotated_mutations(calls, {"repeats": spans, "misassembly": spans.select("contig", "start", "end"), "other_caller": other, "lift_GRCh38": lift})
        assert "hashpartitioning(id" not in out._jdf.queryExecution().executedPlan().toString()
        assert set(calls.columns) < set(out.columns) and "_row" not in out.columns
        got = {r.note: (r.id, r.rmsk_class, r.misassembly, r.other_caller, r.GRCh38_pos, r.GRCh38_status) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    inside = lambda k: 10 <= k <= 20
    want = {k: (f"call_{k}_" + "x" * 60, "R" if inside(k) else None, inside(k), k % 4 == 0, k * 10 + 1 if k % 2 == 0 else None, "Match" if k % 2 == 0 else "Unmapped") for k in range(40)}
    assert got == want
