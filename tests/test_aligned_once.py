"""Alignments cut at N: the walk over the operations is made once a row."""

from locus.operators import elements


def test_walk_is_made_once(spark):
    """The filter that a plain inline() adds walked every row again, below the shuffle that makes rows distinct."""
    kind = "read long, contig string, strand string, start long, cigar string"
    rows = [(1, "a", "+", 100, "5S10M2D3M50N9M1I11M2H"), (1, "a", "-", 100, "5S10M2D3M50N9M1I11M2H"), (2, "a", "+", 0, None), (3, "a", "+", 0, "*"), (4, "a", "-", 7, "4M"), (5, None, None, 7, "3H4=2N1X"), (6, "b", "+", 0, "9N")]
    out = elements.aligned_blocks(spark.createDataFrame([*rows, rows[0]], kind).distinct())
    want = [(1, "a", "+", 100, 115, 5, 18), (1, "a", "+", 165, 185, 18, 39), (1, "a", "-", 100, 115, 23, 36), (1, "a", "-", 165, 185, 2, 23), (4, "a", "-", 7, 11, 0, 4), (5, None, None, 7, 11, 3, 7), (5, None, None, 13, 14, 7, 8)]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 2  # numbers and kinds, in one walk
