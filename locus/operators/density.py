"""Weighted kernel densities with the Sheather-Jones bandwidth, by group."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

POINTS, BINS = 2048, 1000


def pair_counts(counts: np.ndarray) -> np.ndarray:
    """How many pairs of values lie each number of bins apart, from the values in each bin."""
    apart = np.convolve(counts, counts[::-1])[len(counts) - 1 :].astype(float)
    apart[0] = (counts * (counts - 1)).sum() / 2
    return apart


def functional(pairs: np.ndarray, n: float, step: float, h: float, order: int) -> float:
    """The estimate of the integrated derivative functional of order 4 or 6 with a Gaussian kernel of width h."""
    d = (np.arange(len(pairs)) * step / h) ** 2
    near = d < 1000
    d, p = d[near], pairs[near]
    poly, at_zero = (d * d - 6 * d + 3, 3.0) if order == 4 else (d**3 - 15 * d * d + 45 * d - 15, -15.0)
    total = 2 * float((p * np.exp(-d / 2) * poly).sum()) + n * at_zero
    return total / (n * (n - 1) * h ** (order + 1) * math.sqrt(2 * math.pi))


def sheather_jones(counts: np.ndarray, step: float, sd: float, iqr: float) -> float | None:
    """The bandwidth that solves the plug-in equation (Sheather and Jones 1991); None where the values are too sparse for one.

    counts: values in each bin of width `step`. Two pilot widths give the functionals; the root is sought from a tenth
    of the normal rule's width up to it, and outside if need be.
    """
    n = float(counts.sum())
    scale = min(sd, iqr / 1.349)
    if n < 2 or not scale > 0 or not step > 0:
        return None
    pairs = pair_counts(counts)
    sixth = -functional(pairs, n, step, 1.23 * scale * n ** (-1 / 9), 6)
    fourth = functional(pairs, n, step, 1.24 * scale * n ** (-1 / 7), 4)
    if not (math.isfinite(sixth) and sixth > 0 and math.isfinite(fourth) and fourth > 0):
        return None
    ratio = 1.357 * (fourth / sixth) ** (1 / 7)

    def excess(h: float) -> float:
        f = functional(pairs, n, step, ratio * h ** (5 / 7), 4)
        return (1 / (2 * math.sqrt(math.pi) * n * f)) ** 0.2 - h if f > 0 else math.nan

    top = 1.144 * scale * n**-0.2
    low, high = 0.1 * top, top
    for i in range(100):
        if excess(low) * excess(high) <= 0:
            break
        low, high = (low, high * 1.2) if i % 2 == 0 else (low / 1.2, high)
    else:
        return None
    rising = excess(high) > excess(low)
    for _ in range(100):
        mid = (low + high) / 2
        e = excess(mid)
        if math.isnan(e):
            return None
        low, high = (low, mid) if (e > 0) == rising else (mid, high)
    return (low + high) / 2


def density(df: DataFrame, by: list[str], value: str, weight: str, low: float, high: float | None, points: int = POINTS, least: int = 2) -> DataFrame:
    """Grids of weighted densities: by, x, density, bandwidth. From `low` to `high`, or to 1.05 times the group's largest value.

    The bandwidth is that of the values without their weights. Values are counted in bins for it and shared out to
    grid cells for the kernel, by aggregates; a group's last step has some thousands of rows, however many values it
    has. Groups of fewer than `least` values, or too sparse for a bandwidth, have no grid.
    """
    v = df.where(F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))).select(*by, F.col(value).cast("double").alias("_v"), F.col(weight).cast("double").alias("_w"))
    top = F.max("_v") * 1.05 if high is None else F.lit(float(high))
    # Quartiles of a group keep its distinct values; a group has as many windows as a genome at most.
    stats = v.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.stddev("_v").alias("_sd"), F.percentile("_v", F.array(F.lit(0.25), F.lit(0.75))).alias("_q"), (F.max("_v") - F.min("_v")).alias("_range"), top.alias("_hi"))
    stats = stats.where((F.col("_n") >= max(least, 2)) & (F.col("_range") > 0) & (F.col("_hi") > low)).select(*by, "_sd", (F.get("_q", F.lit(1)) - F.get("_q", F.lit(0))).alias("_iqr"), (F.col("_range") * 1.01 / BINS).alias("_step"), "_hi")
    rows = v.join(stats, by)
    place = (F.col("_v") - low) / (F.col("_hi") - low) * (points - 1)
    cell, share = F.floor(place), place - F.floor(place)
    parts = F.array(
        F.struct(F.lit(0).alias("kind"), F.floor(F.col("_v") / F.col("_step")).alias("at"), F.lit(1.0).alias("amount")),
        F.struct(F.lit(1).alias("kind"), cell.alias("at"), (F.col("_w") * (1 - share)).alias("amount")),
        F.struct(F.lit(1).alias("kind"), (cell + 1).alias("at"), (F.col("_w") * share).alias("amount")),
    )
    summed = rows.select(*by, F.explode(parts).alias("_p")).groupBy(*by, "_p.kind", "_p.at").agg(F.sum("_p.amount").alias("amount")).join(stats, by)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in by], "x double", "density double", "bandwidth double"])

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        b = pdf[pdf["kind"] == 0]
        at = b["at"].to_numpy() - b["at"].min()
        h = sheather_jones(np.bincount(at, b["amount"]), first["_step"], first["_sd"], first["_iqr"])
        grid = np.linspace(low, first["_hi"], points)
        if h is None:
            return pd.DataFrame({**{c: pdf[c].iloc[:0] for c in by}, "x": grid[:0], "density": grid[:0], "bandwidth": grid[:0]})
        c = pdf[(pdf["kind"] == 1) & (pdf["amount"] > 0)].sort_values("at")
        x, w = low + c["at"].to_numpy(float) * (first["_hi"] - low) / (points - 1), c["amount"].to_numpy()
        y = (np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2) * w).sum(1) / (w.sum() * h * math.sqrt(2 * math.pi))
        return pd.DataFrame({**{k: [first[k]] * points for k in by}, "x": grid, "density": y, "bandwidth": h})

    return summed.groupBy(*by).applyInPandas(fill, schema)


def detect_peaks(grid: DataFrame, by: list[str], share: float = 0.20, top: int = 8) -> DataFrame:
    """Local maxima, higher than both neighbours, of at least `share` of the highest; the `top` highest of them, by x."""
    w = Window.partitionBy(*by).orderBy("x")
    peak = (F.col("density") > F.lag("density").over(w)) & (F.col("density") > F.lead("density").over(w))
    marked = grid.withColumns({"_p": peak, "_max": F.max("density").over(Window.partitionBy(*by))}).where(F.col("_p") & (F.col("density") >= share * F.col("_max")))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("density"), "x"))
    return marked.withColumn("_r", rank).where(F.col("_r") <= top).select(*by, "x", "density").orderBy(*by, "x")


def dominant_level(grid: DataFrame, by: list[str]) -> DataFrame:
    """Where the density is highest."""
    return grid.groupBy(*by).agg(F.max_by("x", F.struct("density", -F.col("x"))).alias("level"))


def usable(mean: str | Column) -> Column:
    """Levels that count: finite and over 0.05."""
    m = F.col(mean) if isinstance(mean, str) else mean
    return m.isNotNull() & ~F.isnan(m) & (m > 0.05) & (m < float("inf"))


def segment_level(segments: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """by, level: where the density of segment means, weighted by marks, is highest; without a density the longest segment's mean.

    Every group of the segments has a row; its level is null only if no mean is finite and over 0.05.
    """
    good = segments.where(usable("mean"))
    kde = dominant_level(density(good, by, "mean", "n_marks", 0.1, None), by)
    longest = good.groupBy(*by).agg(F.min_by("mean", F.struct(-F.col("n_marks"), *order)).alias("_longest"))
    groups = segments.select(*by).distinct()
    return groups.join(kde, by, "left").join(longest, by, "left").select(*by, F.coalesce("level", "_longest").alias("level"))


def bin_level(windows: DataFrame, by: list[str], value: str = "ratio") -> DataFrame:
    """by, bin_level: the highest peak of the windows' density between 0.30 and 5, if there are 100 of them and a peak."""
    inside = windows.where((F.col(value) > 0.30) & (F.col(value) < 5.0)).withColumn("_one", F.lit(1.0))
    peaks = detect_peaks(density(inside, by, value, "_one", 0.30, 5.0, least=100), by)
    return peaks.groupBy(*by).agg(F.max_by("x", F.struct("density", -F.col("x"))).alias("bin_level"))
