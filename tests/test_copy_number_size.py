import numpy as np
from pyspark.sql import functions as F

from locus.operators import copynumber, segmentation


def test_an_arc_search_with_a_floor_skips_lengths_and_finds_the_same():
    rng = np.random.default_rng(3)
    for n in (5, 40, 700):
        x = rng.normal(size=n)
        z, i, j = segmentation.best_arc(x)
        assert segmentation.best_arc(x, floor=z * 0.99) == (z, i, j)
        assert segmentation.best_arc(x, floor=2 * z)[0] <= z
        x[n // 3 : n // 2] += 4
        assert segmentation.best_arc(x, floor=0.9 * segmentation.best_arc(x)[0]) == segmentation.best_arc(x)


def test_medians_are_not_built_without_cuts(monkeypatch):
    monkeypatch.setattr(segmentation, "Medians", lambda x: 1 / 0)
    assert segmentation.undo_weak(np.zeros(1000), [], 1.0) == []


def test_neighbours_are_rows_beside_a_row(spark):
    """No lambda runs over the neighbours of each row."""
    v = [1.0, 1.1, 9.0, 1.2, 0.9, 1.0, None, 1.1]
    df = spark.createDataFrame([("c", i, x) for i, x in enumerate(v)], "chrom string, window_index long, ratio double")
    got = copynumber.smooth_outliers(df, ["chrom"], around=2, limit=0.5)
    assert "lambdafunction" not in got._jdf.queryExecution().analyzed().toString()
    sd = float(np.std([x for x in v if x is not None], ddof=1))
    out = {r.window_index: r.smoothed for r in got.select("window_index", F.round("smoothed", 9).alias("smoothed")).collect()}
    assert out[2] == round(1.1 + 2 * sd, 9) and out[1] == 1.1 and out[6] is None
