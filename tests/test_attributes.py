from pyspark.sql import functions as F

from locus.functions.fields import attributes


def test_attributes_are_parsed_once_a_row(spark):
    """The expression holds one parse of the list; inside the lambda that drops repeated keys it ran for each attribute."""
    assert str(attributes(F.col("a"))).count("regexp_extract(") == 1
    row = spark.createDataFrame([('gene_id "I1"; tag "a"; n=2; tag "b"; ',), ("",), (None,)], "a string").select(attributes(F.col("a")).alias("m")).collect()
    assert [r.m for r in row] == [{"gene_id": "I1", "n": "2", "tag": "b"}, {}, None]
