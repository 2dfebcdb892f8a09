"""Flank alignments by anchors against the whole matrix."""

import random

from locus.operators import flanks
from locus.plans import copy_queries


def plain(query, target):
    """Equal bases and columns of the best local alignment with affine gaps, over all cells."""
    n, m = len(query), len(target)
    low = (-(10**9), 0, 0)
    best, up, top = [(0, 0, 0)] * (m + 1), [low] * (m + 1), (0, 0, 0)
    for i in range(1, n + 1):
        corner, left = best[0], low
        for j in range(1, m + 1):
            up[j] = max((best[j][0] - 10, best[j][1], best[j][2] + 1), (up[j][0] - 1, up[j][1], up[j][2] + 1))
            left = max((best[j - 1][0] - 10, best[j - 1][1], best[j - 1][2] + 1), (left[0] - 1, left[1], left[2] + 1))
            same = query[i - 1] == target[j - 1]
            over = (corner[0] + (2 if same else -6), corner[1] + same, corner[2] + 1)
            corner, best[j] = best[j], max(over, up[j], left, (0, 0, 0))
            top = max(top, best[j])
    return top[1] / n, top[1] / top[2] if top[2] else 0.0


def changed(rng, s, rate):
    out = []
    for c in s:
        x = rng.random()
        out.append("" if x < rate / 4 else rng.choice("ACGT") if x < rate else c + rng.choice("ACGT") if x < 1.25 * rate else c)
    return "".join(out)


def test_coverage_and_identity_of_planted_repeats():
    rng = random.Random(51)
    for trial in range(40):
        n = rng.choice([60, 150, 300])
        unit = "".join(rng.choice("ACGT") for _ in range(rng.choice([n, n, 23, 37])))
        query = (unit * (n // len(unit) + 1))[:n]
        copy = changed(rng, query, rng.choice([0, 0.01, 0.03]))
        target = "".join(rng.choice("ACGT") for _ in range(rng.randrange(50, 200))) + copy[: rng.choice([n, n, n // 2])] + "".join(rng.choice("ACGT") for _ in range(100))
        cov, identity, lo, hi = flanks.aligned(query, target)
        want = plain(query, target)
        assert abs(cov - want[0]) <= 0.02 and abs(identity - want[1]) <= 0.02, (trial, n, cov, identity, want)
        assert 0 <= lo < hi <= len(target)


def test_flanks_of_rows(spark):
    rng = random.Random(52)
    seq = "".join(rng.choice("ACGT") for _ in range(200))
    other = "".join(rng.choice("ACGT") for _ in range(500))
    rows = [("both", seq, seq[:100] + other, other + seq.lower()), ("none", seq, other, other[::-1]), ("empty", "", seq, seq), ("null", None, None, None), ("n", seq[:80] + "N" * 40 + seq[120:], seq, other)]
    got = {r.sv_id: r for r in flanks.flank_alignment(spark.createDataFrame(rows, "sv_id string, seq string, left string, right string")).collect()}
    assert (got["both"].best_flank, got["both"].flank_coverage, got["both"].flank_aln_identity, got["both"].flank_block) == ("right", 1.0, 1.0, seq)
    assert all(got[k].flank_coverage == 0 and got[k].best_flank is None for k in ("empty", "null")) and got["none"].flank_coverage < 0.2
    assert got["n"].best_flank == "left" and got["n"].flank_coverage >= 0.4


def test_flank_alignment_of_the_tables(spark):
    """Every row against the whole matrix: the better flank, its share and its identity."""
    sf = "/root/testdata/sf0.001"
    given = {r.sv_id: r for r in copy_queries.flanked(spark, sf).collect()}
    got = copy_queries.flank_alignment(spark, sf).collect()
    assert len(got) == len(given) > 100
    for r in got[:60]:
        x = given[r.sv_id]
        want = max((plain(x.seq.upper(), t.upper()) for t in (x.left, x.right)), key=lambda w: w[0])
        assert abs(r.flank_coverage - want[0]) <= 0.02 and abs(r.flank_aln_identity - want[1]) <= 0.02
