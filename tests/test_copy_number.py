"""Densities, segmentation and copy numbers against plain definitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from locus.operators import copynumber, segmentation
from locus.operators import density as kde
from locus.plans import copy_queries, pipeline_queries
from locus.plans.standins import standin

SF = "/root/testdata/sf0.001"


def plain_bandwidth(x):
    """The plug-in equation over all pairs of binned values."""
    n, q = len(x), np.quantile(x, [0.25, 0.75])
    scale, step = min(x.std(ddof=1), (q[1] - q[0]) / 1.349), (x.max() - x.min()) * 1.01 / 1000
    i, j = np.triu_indices(n, 1)
    apart = np.abs(np.floor(x / step)[i] - np.floor(x / step)[j]) * step

    def fourth(h):
        u = (apart / h) ** 2
        return (2 * (np.exp(-u / 2) * (u * u - 6 * u + 3)).sum() + 3 * n) / (n * (n - 1) * h**5 * np.sqrt(2 * np.pi))

    def sixth(h):
        u = (apart / h) ** 2
        return (2 * (np.exp(-u / 2) * (u**3 - 15 * u * u + 45 * u - 15)).sum() - 15 * n) / (n * (n - 1) * h**7 * np.sqrt(2 * np.pi))

    t4, t6 = fourth(1.24 * scale * n ** (-1 / 7)), -sixth(1.23 * scale * n ** (-1 / 9))
    if not (scale > 0 and t4 > 0 and t6 > 0):
        return None
    ratio = 1.357 * (t4 / t6) ** (1 / 7)
    gap = lambda h: (1 / (2 * np.sqrt(np.pi) * n * fourth(ratio * h ** (5 / 7)))) ** 0.2 - h
    low, high = 0.1144 * scale * n**-0.2, 1.144 * scale * n**-0.2
    for _ in range(40):
        if gap(low) * gap(high) <= 0:
            break
        low, high = low / 1.2, high * 1.2
    else:
        return None
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if gap(mid) > 0 else (low, mid)
    return low


def plain_level(means, marks):
    """The level of segments: the mode of a weighted density, or the longest segment."""
    keep = [(m, w) for m, w in zip(means, marks, strict=True) if np.isfinite(m) and m > 0.05]
    if not keep:
        return None
    m, w = np.array([k[0] for k in keep]), np.array([k[1] for k in keep], float)
    h = plain_bandwidth(m) if len(m) > 1 and m.max() > m.min() else None
    if h is None:
        return m[w.argmax()]
    grid = np.linspace(0.1, m.max() * 1.05, 2048)
    return grid[(np.exp(-0.5 * ((grid[:, None] - m) / h) ** 2) * w).sum(1).argmax()]


def test_bandwidths_of_twenty_samples(spark):
    rng = np.random.default_rng(1)
    data, want = [], {}
    for k in range(20):
        x = np.concatenate([rng.normal(1, rng.uniform(0.05, 0.3), 60), rng.normal(2, 0.2, int(rng.integers(5, 200)))])
        data += [(k, float(v), 1.0) for v in x]
        want[k] = plain_bandwidth(x)
    grid = kde.density(spark.createDataFrame(data, "k int, v double, w double"), ["k"], "v", "w", 0.0, None)
    got = {r.k: (r.h, r.area, r.n) for r in grid.groupBy("k").agg(F.max("bandwidth").alias("h"), (F.sum("density") * (F.max("x") - F.min("x")) / 2047).alias("area"), F.count("*").alias("n")).collect()}
    for k, h in want.items():
        assert got[k][0] == pytest.approx(h, rel=1e-6) and got[k][1] == pytest.approx(1, abs=0.1) and got[k][2] == 2048


def test_levels_of_every_group(spark):
    """Few, equal, high and missing means: a group is never lost."""
    data = [("a", "1", 1.0, 7.5, 10), ("a", "1", 2.0, 7.5, 4), ("b", "1", 1.0, 9.0, 3), ("b", "2", 1.0, 2.0, 30), ("c", "1", 1.0, None, 5), ("c", "1", 2.0, 0.01, 5), ("d", "1", 1.0, float("nan"), 5)]
    rng = np.random.default_rng(2)
    many = [("e", "1", float(i), float(v), int(w)) for i, (v, w) in enumerate(zip(np.r_[rng.normal(6, 0.2, 40), rng.normal(12, 0.3, 20)], rng.integers(1, 90, 60), strict=True))]
    df = spark.createDataFrame(data + many, "s string, chrom string, start double, mean double, n_marks long")
    got = {r.s: r.level for r in kde.segment_level(df, ["s"], ["chrom", "start"]).collect()}
    assert (got["a"], got["c"], got["d"]) == (7.5, None, None) and got["b"] == pytest.approx(2.0, abs=0.01)
    assert got["e"] == pytest.approx(plain_level([m[3] for m in many], [m[4] for m in many]), abs=0.01)


def test_arcs_find_a_short_gain_in_a_long_arm():
    rng = np.random.default_rng(3)
    x = np.r_[np.full(1500, 1.0), np.full(12, 2.0), np.full(1500, 1.0)] + rng.normal(0, 0.25, 3012)
    s, k = np.cumsum(x)[:-1], np.arange(1, 3012)
    one = np.abs(s / k - (x.sum() - s) / (3012 - k)) / (0.25 * np.sqrt(1 / k + 1 / (3012 - k)))
    assert one.max() < segmentation.threshold(3012)  # no single split sees it
    assert segmentation.arc_cuts(x, 0.25) == [1500, 1512]


def test_best_arc_by_plain_loops():
    rng = np.random.default_rng(4)
    for _ in range(40):
        x = rng.normal(size=int(rng.integers(4, 40)))
        n, best = len(x), 0.0
        for i in range(n):
            for j in range(i + 2, n + 1):
                if n - (j - i) >= 2:
                    inside, rest = x[i:j], np.r_[x[:i], x[j:]]
                    best = max(best, abs(inside.mean() - rest.mean()) / np.sqrt(1 / len(inside) + 1 / len(rest)))
        z, i, j = segmentation.best_arc(x)
        assert z == pytest.approx(best)


def test_noise_is_not_cut():
    """The chance of a cut stays below its bound, by simulation."""
    rng = np.random.default_rng(5)
    assert sum(bool(segmentation.arc_cuts(rng.normal(size=200), 1.0)) for _ in range(300)) <= 3
    b, over = 4.0, 0
    for _ in range(200):
        over += segmentation.best_arc(rng.normal(size=200))[0] > b
    assert over / 200 <= segmentation.chance(b, 200)
    assert segmentation.arc_cuts(np.ones(9), 1e-9) == [] and segmentation.arc_cuts(np.zeros(0), 1.0) == []


def plain_undo(x, cuts, sd, short=1.5, long=1.0, min_long=100, min_step=0.3):
    edges = [0, *cuts, len(x)]
    while len(edges) > 2:
        m = [np.median(x[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
        weak = []
        for i in range(len(m) - 1):
            both = edges[i + 1] - edges[i] >= min_long and edges[i + 2] - edges[i + 1] >= min_long
            step, limit = abs(m[i + 1] - m[i]), min(short * sd, max(long * sd, min_step)) if both else short * sd
            if step < limit:
                weak.append((step, i))
        if not weak:
            break
        del edges[min(weak)[1] + 1]
    return edges[1:-1]


def test_undo_by_recomputed_medians():
    rng = np.random.default_rng(6)
    for _ in range(150):
        n = int(rng.integers(2, 300))
        x = np.round(rng.normal(size=n), int(rng.integers(0, 3)))
        cuts = sorted(rng.choice(np.arange(1, n), int(rng.integers(0, min(n - 1, 50))), replace=False).tolist())
        sd, longer = float(rng.uniform(0.1, 0.6)), int(rng.choice([5, 20, 100]))
        assert segmentation.undo_weak(x, cuts, sd, min_long=longer) == plain_undo(x, cuts, sd, min_long=longer)


def test_undo_of_many_edges_is_fast():
    import time

    rng = np.random.default_rng(7)
    x = rng.normal(size=200_000)
    cuts = np.sort(rng.choice(np.arange(1, len(x)), 100_000, replace=False)).tolist()
    began = time.time()
    left = segmentation.undo_weak(x, cuts, 1.0)
    assert 0 < len(left) < 50_000 and time.time() - began < 60


def test_blocks_agree_with_the_whole(spark):
    """Segments from overlapping blocks of 128 marks are those of one block."""
    rng = np.random.default_rng(8)
    data = []
    for chrom in ("1", "2", "3"):
        x = np.concatenate([np.full(int(rng.integers(12, 200)), float(v)) for v in rng.permutation([0.5, 1, 1.5, 2, 3, 1, 2, 4])])
        data += [("s", chrom, float(3 * i), float(v)) for i, v in enumerate(x + rng.normal(0, 0.1, len(x)))]
    df = spark.createDataFrame(data, "s string, chrom string, window_index double, smoothed double")
    sd = spark.createDataFrame([("s", 0.1)], "s string, sd double")
    cut, whole = (sorted(map(tuple, segmentation.segment(df, ["s", "chrom"], sd, block=b).collect())) for b in (128, 1 << 20))
    assert cut == whole and 20 < len(whole) <= 24


def plain_calls(windows, set_ploidy=None):
    """The whole of call_copy_number() in loops over lists, chromosomes in one block."""

    def smooth(v):
        sd = np.std(v, ddof=1) if len(v) > 1 else None
        out = []
        for i, x in enumerate(v):
            near = sorted([*v[max(0, i - 10) : i], *v[i + 1 : i + 11]])
            mid = near[len(near) // 2] if near else None
            out.append(x if not near or sd is None else mid + 2 * sd if x > near[-1] + 4 * sd else mid - 2 * sd if x < near[0] - 4 * sd else x)
        return out

    def deviation(chroms):
        d = np.concatenate([np.diff(v) for v in chroms.values()])
        if len(d) == 0:
            return None
        lo, hi = np.quantile(d, [0.025, 0.975])
        kept = d[(d >= lo) & (d <= hi)]
        return np.std(kept, ddof=1) / np.sqrt(2) if len(kept) > 1 else None

    def cut(v, sd, plain):
        x = np.array(v)
        if sd is None:
            return [0, len(x)]
        noise = max(sd, 1e-9)
        return [0, *plain_undo(x, segmentation.settled(x, segmentation.arc_cuts(x, noise), noise), sd, min_long=np.inf if plain else 100), len(x)]

    groups, out = {}, {}
    for w in windows:
        groups.setdefault((w.sample, w.hap), []).append(w)
    for key, ws in groups.items():
        good = sorted((w for w in ws if w.normal_depth > 100_000), key=lambda w: (w.chrom, w.window_index))
        n_sum, t_sum, t_rows = sum(w.normal_depth for w in good), sum(w.tumor_depth for w in good), sum(w.tumor_depth > 10_000 for w in good)
        chroms, at = {}, {}
        for w in good:
            if t_sum:
                chroms.setdefault(w.chrom, []).append(w.tumor_depth / w.normal_depth * n_sum / t_sum * t_rows / len(good))
                at.setdefault(w.chrom, []).append(w.window_index)
        smoothed = {c: smooth(v) for c, v in chroms.items()}
        sd = deviation(smoothed) if chroms else None
        first = [(float(np.mean(smoothed[c][a:b])), b - a) for c in sorted(chroms) for e in [cut(smoothed[c], sd, True)] for a, b in zip(e, e[1:], strict=False)]
        level = plain_level([m for m, _ in first], [w for _, w in first])
        if level is None:
            for c in {w.chrom for w in ws}:
                own = [w for w in ws if w.chrom == c]
                out[(*key, c, float(min(w.window_index for w in own)))] = (sum(w.normal_depth > 100_000 for w in own), None)
            continue
        usable, times, base = [(m, w) for m, w in first if m > 0.05], 1, level
        while times < 8 and sum(w for m, w in usable if 0.4 * base < m < 0.6 * base) / sum(w for _, w in usable) > 0.09:
            times, base = times * 2, base / 2
        inside = np.array([v for c in chroms.values() for v in c if 0.3 < v < 5])
        h = plain_bandwidth(inside) if len(inside) >= 100 else None
        if h is not None:
            grid = np.linspace(0.3, 5, 2048)
            y = np.exp(-0.5 * ((grid[:, None] - inside) / h) ** 2).sum(1)
            tops = [i for i in range(1, 2047) if y[i] > y[i - 1] and y[i] > y[i + 1] and y[i] >= 0.2 * y.max()]
            level = grid[max(tops, key=lambda i: y[i])] if tops else level
        ploidy = times if set_ploidy is None else set_ploidy
        copies = {c: [v / level * ploidy for v in vs] for c, vs in chroms.items()}
        capped = {c: smooth([min(v, 20.0) for v in vs]) for c, vs in copies.items()}
        sd = deviation(capped)
        for c in capped:
            e = cut(capped[c], sd, False)
            for a, b in zip(e, e[1:], strict=False):
                out[(*key, c, float(at[c][a]))] = (b - a, round(float(np.mean(copies[c][a:b])), 4))
    return out


def agrees(got, want):
    assert {(r.sample, r.hap, r.chrom, r.start): r.n_marks for r in got} == {k: v[0] for k, v in want.items()}
    for r in got:
        mean = want[r.sample, r.hap, r.chrom, r.start][1]
        # The grid's cells round a level by some 1e-3 of it.
        assert (r.mean is None) == (mean is None) and (mean is None or r.mean == pytest.approx(mean, rel=4e-3, abs=2e-3))


def test_call_copy_number_by_its_definition(spark):
    d = standin(spark, SF, "depths").groupBy("sample", "hap", "chrom", F.col("w").alias("window_index")).agg(F.min("tumor_depth").alias("tumor_depth"), F.min("normal_depth").alias("normal_depth"))
    agrees(copy_queries.call_copy_number(spark, SF).collect(), plain_calls(d.collect()))


def test_steps_in_copies_and_samples_that_have_no_level(spark):
    """A shallow tumour, one without reads, one whose ratios are over 5, and one without normal depth."""
    rng = np.random.default_rng(9)
    data = []
    for sample in ("steps", "shallow", "none", "high", "bare"):
        for chrom in ("1", "2"):
            for w in range(200):
                copies = 2 if chrom == "1" or w < 90 else 3 if w < 150 else 1
                tumor = {"steps": 1_000_000 * copies, "shallow": 20_000 if w < 2 else 900, "none": 0, "high": 400_000, "bare": 5}[sample]
                noisy = 0 if sample == "none" else int(tumor * rng.normal(1, 0.03))
                data.append((sample, 1, chrom, float(w), noisy, 50 if sample == "bare" else int(2_000_000 * rng.normal(1, 0.02))))
    df = spark.createDataFrame(data, "sample string, hap int, chrom string, window_index double, tumor_depth long, normal_depth long")
    got = copynumber.call_copy_number(df).collect()
    assert {r.sample for r in got} == {"steps", "shallow", "none", "high", "bare"}
    agrees(got, plain_calls(df.collect()))
    steps = sorted((r.chrom, r.start, r.n_marks, round(r.mean)) for r in got if r.sample == "steps")
    one = [r for r in got if r.sample == "steps"][0].ploidy / 2
    assert [(c, s, n) for c, s, n, _ in steps] == [("1", 0.0, 200), ("2", 0.0, 90), ("2", 90.0, 60), ("2", 150.0, 50)] and one in (0.5, 1, 2)
    assert all(r.mean is None and r.level is None and r.n_marks == (200 if r.sample == "none" else 0) for r in got if r.sample in ("none", "bare"))
    own = spark.createDataFrame([("steps", 1, 4.0)], "sample string, hap int, ploidy double")
    forced = copynumber.call_copy_number(df, own).collect()
    assert {r.ploidy for r in forced if r.sample == "steps"} == {4.0} and {r.ploidy for r in forced if r.sample == "high"} == {r.ploidy for r in got if r.sample == "high"}


def test_copy_number_table_by_segments(spark):
    """The flow is its windows' calls without the gaps of their haplotype's axis."""
    rows = standin(spark, SF, "reftable").withColumn("chrom", F.col("chrom") % 3)
    gaps = copynumber.assembly_gaps(rows, by=["hap"]).collect()
    got = pipeline_queries.copy_number_table(spark, SF).collect()
    assert got and {r.sample for r in got} == {0, 1} and {r.hap for r in got} == {0, 1}
    assert not [(s, g) for s in got for g in gaps if (s.hap, s.chrom) == (g.hap, g.chrom) and min(s.end, g.end) > max(s.start, g.start)]
