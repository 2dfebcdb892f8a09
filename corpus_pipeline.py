"""The corpus pipeline: quality, near duplicates, repeated passages, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from locus.llm import mixing, pieces, quality, simhash, suffixes
from locus.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the threshold table. Null and short texts go; repeated rows stay or go alike."""
    return quality.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, that of the smallest id; of repeated rows one, and one of those without ids."""
    return simhash.deduplicated(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 100-byte strings that start earlier; n_chars follows. Null texts stay null."""
    return suffixes.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them; a null source is one of its own, empty texts take no words."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document taken: its number of tokens, and digests of its ids and of what they decode to."""
    return pieces.digests(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("source mix", source_mix),
    ("token ids", token_ids),
]

#: Fingerprints, suffixes and the piece model are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet in the shared folder and read again.

    Rows with nulls in any column, repeated rows, very long texts and further columns pass as each stage states; an empty
    table gives an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
