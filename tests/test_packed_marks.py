"""Segments from packed halves of blocks against the functions that they call, block by block."""

import math

import numpy as np

from locus.operators import segmentation as g

KIND = "sample string, chrom int, window_index long, smoothed double"


def test_packed_halves_like_blocks_of_rows(spark):
    rng, half = np.random.default_rng(5), 16
    sizes = {0: 1, 1: 3, 2: half, 3: half + 1, 4: 2 * half, 5: 5 * half, 6: 7 * half + 5, 7: 400}
    marks = {k: np.where(np.arange(n) // 23 % 2 == 1, 2.0, 0.0) * (k > 3) + rng.normal(0, 0.1, n) for k, n in sizes.items()}
    rows = [("s", k, 3 * i + k, float(v)) for k, x in marks.items() for i, v in enumerate(x)] + [("s", 7, 5000, None)]
    df = spark.createDataFrame(rows, KIND).repartition(5)
    got = g.segment(df, ["sample", "chrom"], spark.createDataFrame([("s", 0.1)], "sample string, sd double"), block=2 * half)
    want = []
    for k, x in marks.items():
        cuts = [c + b * half for b in range(-(-len(x) // half)) for c in g.arc_cuts(x[b * half : (b + 2) * half], 0.1)]
        edges = [0, *g.undo_weak(x, g.settled(x, cuts, 0.1), 0.1), len(x)]
        want += [("s", k, 3.0 * a + k, 3.0 * (b - 1) + k, b - a, x[a:b].mean()) for a, b in zip(edges, edges[1:], strict=False)]
    have = sorted(map(tuple, got.collect()))
    assert [r[:5] for r in have] == [r[:5] for r in want] and len(want) > 20
    assert all(math.isclose(a[5], b[5], rel_tol=1e-12) for a, b in zip(have, want, strict=True))
    # A block was a group of rows, each of which had the keys and went to Python twice.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroupsIn" not in plan.replace("FlatMapCoGroupsIn", "")
