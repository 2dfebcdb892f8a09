"""Supplementary alignments near one of many primaries."""

import random

from locus.operators import elements


def test_supplementary_meets_united_primaries(spark):
    """A join by read alone made every pair of a read's primaries and supplementaries: here 4 million."""
    rng = random.Random(5)
    kind = "read int, contig string, start long, `end` long"
    near = [(1, rng.choice("ab"), s, s + 50) for s in range(0, 200_000, 100)] + [(None, "a", 0, 10), (2, None, 900_000, 900_010)]
    rows = [(1, rng.choice("abc"), s := rng.choice([rng.randrange(0, 230_000), 204_950, 204_951]), s + rng.randrange(1, 30_000)) for _ in range(2000)]
    rows += [(None, "a", 0, 10), (2, "a", 895_000 - 5, 895_000), (2, "a", 894_990, 894_999), (2, None, 905_010, 905_020), (2, "b", 905_011, 905_020), (1, "a", 500_000, 700_000)]
    p, s = spark.createDataFrame(near, kind), spark.createDataFrame(rows + rows[:9], kind)
    for same in (False, True):
        want = {x for x in rows if any(x[0] is not None and x[0] == y[0] and (not same or None not in (x[1], y[1]) and x[1] == y[1]) and y[2] - 5000 <= x[3] and y[3] + 5000 >= x[2] for y in near)}
        out = elements.supplementary_near_primary(p, s, same_contig=same)
        assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
        assert "_bin" in out._jdf.queryExecution().optimizedPlan().toString()
