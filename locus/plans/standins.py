"""Genome-shaped tables derived from the given tables, by expressions that read the same in Spark and other SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: name: (source table, distinct, select list). Only integer and text expressions that both engines share.
TABLES: dict[str, tuple[str, bool, list[str]]] = {
    "sites": ("lineitem", True, [
        "l_orderkey * 8 + l_linenumber as site", "l_partkey % 7 as contig", "l_partkey * 50 + (l_linenumber * 97) % 400 as start", "l_partkey * 50 + (l_linenumber * 97) % 400 + 1 + l_orderkey % 3 as end",
        "substr('ACGTACG', cast(1 + l_orderkey % 4 as int), cast(1 + l_orderkey % 3 as int)) as ref", "substr('TGCATGC', cast(1 + l_partkey % 4 as int), cast(1 + l_suppkey % 3 as int)) as alt",
        "l_partkey as pk", "l_suppkey as sk", "l_linenumber as ln"]),
    "regions": ("part", False, ["p_partkey % 7 as contig", "p_partkey * 50 as start", "p_partkey * 50 + p_size * 20 as end", "p_brand as brand", "p_type as kind", "p_name as name", "p_partkey as ord", "p_size as size"]),
    "svs": ("orders", False, [
        "o_orderkey as sv", "o_custkey % 7 as chr1", "o_orderkey * 10 as pos1", "case when o_orderkey % 2 = 0 then '+' else '-' end as dir1",
        "case when o_orderkey % 5 = 0 then (o_custkey + 1) % 7 else o_custkey % 7 end as chr2", "o_orderkey * 10 + o_custkey as pos2", "case when (o_orderkey + o_custkey) % 3 = 0 then '+' else '-' end as dir2",
        "o_orderkey % 2000 as ins_len", "case when o_orderstatus = 'F' then 'PASS' else 'Too_small_size' end as is_filter", "case when o_orderkey % 4 = 0 then 'd_' || cast(o_orderkey as varchar(20)) else 's_' || cast(o_orderkey as varchar(20)) end as sv_id",
        "o_custkey % 40 as checked_tumor", "o_orderkey % 7 as support_tumor", "(o_custkey + o_orderkey) % 30 as checked_control", "o_custkey as ck"]),
    "blocks": ("lineitem", True, ["l_orderkey * 8 + l_linenumber as read", "l_partkey % 7 as contig", "l_partkey * 50 as start", "l_partkey * 50 + cast(l_quantity as int) * 10 as end", "l_suppkey % 60 as mapq", "(l_linenumber % 3) * 256 as flag", "case when l_suppkey % 2 = 0 then '+' else '-' end as strand", "cast(l_quantity as int) as q"]),
    "reads": ("events", False, ["user_id as read", "event_id as ord", "event_id * 7 as read_pos", "event_type as sv_id", "round(value) / 500 as ratio", "event_id % 13 as chr1", "event_id * 7 + user_id as pos1"]),
    "reftable": ("supplier", False, [
        "s_suppkey as contig", "s_suppkey * 1000 as c_start", "s_suppkey * 1000 + 120000 + s_nationkey * 17000 as c_end", "case when s_suppkey % 2 = 0 then '+' else '-' end as strand", "s_nationkey as chrom",
        "s_suppkey * 90000 as r_start", "s_suppkey * 90000 + 110000 + s_nationkey * 15000 as r_end", "s_suppkey % 2 as hap", "s_suppkey as ord", "100 + s_suppkey * 37 % 900 as matched"]),
    "depths": ("lineitem", True, ["l_suppkey % 3 as sample", "l_partkey % 2 as hap", "l_suppkey % 11 as chrom", "l_orderkey * 8 + l_linenumber as w", "cast(l_quantity as int) * 9000 as normal_depth", "cast(l_quantity as int) * (l_partkey % 50) * 100 as tumor_depth"]),
    "longseqs": ("documents", False, ["doc_id as contig", "translate(concat(md5(text), md5(concat(text, '1')), md5(concat(text, '2')), md5(concat(text, '3')), md5(concat(text, '4'))), '0123456789abcdef', 'ACGTACGTACGTacgN') as seq"]),
    "seqs": ("documents", False, ["doc_id as contig", "doc_id % 2 as hap", "translate(md5(text), '0123456789abcdef', 'ACGTACGTACGTACGT') as seq"]),
}


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, distinct, columns = TABLES[name]
    fixed = [c.replace(" as end", " as `end`") for c in columns]
    df = spark.read.parquet(f"{sf_dir}/{source}.parquet").selectExpr(*fixed)
    return df.distinct() if distinct else df


def distinct_rows(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of some columns of a stand-in, in as many tasks as the session shuffles into.

    A shuffle without a number is gathered to 64 MB of compressed rows a task, some three million rows here, which every
    aggregate on them holds at once.
    """
    source, _, exprs = TABLES[name]
    rows = spark.read.parquet(f"{sf_dir}/{source}.parquet").selectExpr(*[c.replace(" as end", " as `end`") for c in exprs]).select(*columns)
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *columns).distinct()


def sql(*names: str) -> str:
    """The WITH clause of the named tables, without WITH."""
    out = []
    for n in names:
        source, distinct, columns = TABLES[n]
        cols = ", ".join(c.replace(" as end", ' as "end"').replace(" as start", ' as "start"') for c in columns)
        out.append(f"{n} AS (SELECT {'DISTINCT ' if distinct else ''}{cols} FROM {source})")
    return ",\n".join(out)
