"""Change points of depth ratios: arcs in blocks, stitched by chromosome, and the undoing of weak steps."""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .checkpoints import stored

#: Chance of a change where there is none, and the least marks of a segment.
ALPHA, LEAST = 0.01, 2
#: Marks of a block; blocks overlap by half.
BLOCK = 2048
#: Arcs up to this length are bounded one by one, longer ones by the tail of the maximum.
SHORT = 25
#: Undo limits in deviations, marks of a long segment and its least step in copies: fixed values.
UNDO_SD, UNDO_SD_LONG, LONG_MARKS, LONG_STEP = 1.5, 1.0, 100, 0.3


def _cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def chance(b: float, n: int) -> float:
    """An upper estimate of the chance that some arc of n noise values has a statistic over b.

    Short arcs by the sum of their chances; longer ones by Siegmund's tail approximation for the largest arc.
    """
    short = 2 * n * min(SHORT, n // 2) * _cdf(-b)
    if n <= 2 * SHORT:
        return short
    t = np.linspace(SHORT / n, 1 - SHORT / n, 400)
    x = b / np.sqrt(n * t * (1 - t))
    half = np.array([_cdf(v / 2) for v in x])
    over = (2 / x) * (half - 0.5) / ((x / 2) * half + np.exp(-x * x / 8) / math.sqrt(2 * math.pi))
    tail = np.trapezoid(over**2 / (t * t * (1 - t)), t)
    return short + 0.5 * b**3 * math.exp(-b * b / 2) / math.sqrt(2 * math.pi) * tail


@lru_cache(maxsize=4096)
def threshold(n: int, alpha: float = ALPHA) -> float:
    """The statistic that noise of n values passes with chance alpha at most."""
    low, high = 2.0, 12.0
    for _ in range(30):
        mid = (low + high) / 2
        low, high = (mid, high) if chance(mid, n) > alpha else (low, mid)
    return high


def best_arc(x: np.ndarray, least: int = LEAST, floor: float = 0.0) -> tuple[float, int, int]:
    """The arc [i, j) whose mean differs most from that of the rest, both with `least` values at least, as a deviation of means for unit noise.

    Lengths at which no arc can pass `floor`, by the range of the running sums, are left out.
    """
    n = len(x)
    s = np.concatenate([[0.0], np.cumsum(x - x.mean())])
    best = (0.0, 0, n)
    sizes = np.arange(least, n - least + 1)
    most = (s.max() - s.min()) / np.sqrt(sizes * (n - sizes) / n)
    for size in sizes[most >= floor * (1 - 1e-9)].tolist():
        d = np.abs(s[size:] - s[:-size])
        # What stands before, or behind, is a segment too.
        i = int(d.argmax())
        z = float(d[i]) / math.sqrt(size * (n - size) / n)
        if z > best[0] + 1e-12:
            best = (z, i, i + size)
    return best


def arc_cuts(x: np.ndarray, noise: float, least: int = LEAST, alpha: float = ALPHA) -> list[int]:
    """Change points by circular binary segmentation: both ends of the best arc at once, again within the parts, while its statistic is over the threshold.

    A part that is noisier than `noise` is judged by its own neighbours' differences, whose median steps do not move.
    """
    found: set[int] = set()
    todo = [(0, len(x))]
    while todo:
        a, b = todo.pop()
        if b - a < 2 * least:
            continue
        own = float(np.median(np.abs(np.diff(x[a:b])))) / (0.6745 * math.sqrt(2))
        floor = threshold(b - a, alpha) * max(noise, own)
        z, i, j = best_arc(x[a:b], least, floor)
        if z > floor:
            ends = [e for e in (a + i, a + j) if a < e < b]
            found.update(ends)
            todo += list(zip([a, *ends], [*ends, b], strict=True))
    return sorted(found)


def settled(x: np.ndarray, cuts: Sequence[int], noise: float, limit: float = 2.576) -> list[int]:
    """Cuts of several blocks as those of one: the weakest goes while the means beside it differ by less than `limit`
    deviations, then each moves to where it divides its neighbours' span best."""
    s = np.concatenate([[0.0], np.cumsum(x)])
    edges = [0, *sorted(set(cuts) - {0, len(x)}), len(x)]

    def z(a: int, b: int, c: int) -> float:
        return float(abs((s[b] - s[a]) / (b - a) - (s[c] - s[b]) / (c - b))) / (noise * math.sqrt(1 / (b - a) + 1 / (c - b)))

    for _ in range(20):
        before = list(edges)
        edges = _pruned(edges, lambda a, b, c: v if (v := z(a, b, c)) < limit else None)
        for k in range(1, len(edges) - 1):
            a, c = edges[k - 1], edges[k + 1]
            m = np.arange(a + 1, c)
            v = np.abs((s[m] - s[a]) / (m - a) - (s[c] - s[m]) / (c - m)) / np.sqrt(1 / (m - a) + 1 / (c - m))
            edges[k] = int(m[v.argmax()])
        if edges == before:
            break
    return edges[1:-1]


def _pruned(edges: Sequence[int], weak: Callable[[int, int, int], float | None]) -> list[int]:
    """Removes the weakest inner edge again and again. weak(a, b, c) is the step at b, or None if it stays.

    Edges are linked; a heap holds the weak ones, and entries of edges whose neighbours have changed since are skipped.
    """
    before, after = dict(zip(edges[1:], edges, strict=False)), dict(zip(edges, edges[1:], strict=False))
    version = dict.fromkeys(edges, 0)
    heap: list[tuple] = []

    def push(b: int) -> None:
        if b in before and b in after and (key := weak(before[b], b, after[b])) is not None:
            heapq.heappush(heap, (key, b, version[b]))

    for b in edges[1:-1]:
        push(b)
    while heap:
        _, b, v = heapq.heappop(heap)
        if version.get(b) != v:
            continue
        a, c = before.pop(b), after.pop(b)
        after[a], before[c] = c, a
        del version[b]
        for e in (a, c):
            version[e] += 1
            push(e)
    return sorted(version)


class Medians:
    """Medians of any stretch of a fixed array in log n: a wavelet matrix over ranks, one level of prefix counts for each bit."""

    def __init__(self, x: np.ndarray) -> None:
        self.values = array("d", np.sort(x, kind="stable").astype(float).tobytes())
        rank = np.empty(len(x), np.int64)
        rank[np.argsort(x, kind="stable")] = np.arange(len(x))
        self.levels: list[tuple[int, array, int]] = []  # eight bytes a mark and level, as plain numbers
        for bit in range(max(len(x) - 1, 0).bit_length() - 1, -1, -1):
            one = (rank >> bit) & 1 == 1
            zeros = np.concatenate([[0], np.cumsum(~one)])
            self.levels.append((bit, array("q", zeros.astype(np.int64).tobytes()), int(zeros[-1])))
            rank = np.concatenate([rank[~one], rank[one]])

    def nth(self, a: int, b: int, k: int) -> float:
        """The k-th smallest of x[a:b], from 0."""
        out = 0
        for bit, zeros, total in self.levels:
            lo, hi = zeros[a], zeros[b]
            if k < hi - lo:
                a, b = lo, hi
            else:
                k -= hi - lo
                a, b, out = total + a - lo, total + b - hi, out | 1 << bit
        return self.values[out]

    def median(self, a: int, b: int) -> float:
        n = b - a
        upper = self.nth(a, b, n // 2)
        return upper if n % 2 else (self.nth(a, b, n // 2 - 1) + upper) / 2


def undo_weak(x: np.ndarray, cuts: Sequence[int], sd: float, short: float = UNDO_SD, long: float = UNDO_SD_LONG, min_long: float = LONG_MARKS, min_step: float = LONG_STEP) -> list[int]:
    """Removes the weakest step between medians again and again while it is below its limit.

    Between two long segments the limit is min(1.5 sd, max(1.0 sd, 0.3)), else 1.5 sd. One removal costs two medians of
    merged segments, so n marks and m cuts take (n + m) log n.
    """
    if not len(cuts):
        return []
    medians = Medians(x)
    known: dict[tuple[int, int], float] = {}

    def median(a: int, b: int) -> float:
        if (a, b) not in known:
            known[a, b] = medians.median(a, b)
        return known[a, b]

    def weak(a: int, b: int, c: int) -> float | None:
        step = abs(median(b, c) - median(a, b))
        both = min(b - a, c - b) >= min_long
        return step if step < (min(short * sd, max(long * sd, min_step)) if both else short * sd) else None

    return _pruned([0, *cuts, len(x)], weak)[1:-1]


def repeated(pdf: pd.DataFrame, by: Sequence[str], n: int) -> dict[str, pd.Series]:
    """The group's keys n times, as objects, so that text comes in one piece."""
    return {c: pd.Series([pdf[c].iloc[0]] * n, dtype=object) for c in by}


def segment(df: DataFrame, by: list[str], sd: DataFrame, value: str = "smoothed", order: str = "window_index", plain: bool = False, block: int = BLOCK) -> DataFrame:
    """Segments of each chromosome: by, start, end (of the order), n_marks, mean. `by` ends with the chromosome.

    Arcs are sought in blocks of `block` marks that overlap by half, each packed in a row of its own, so the quadratic search is
    bounded; cuts of all blocks meet in a group of the chromosome, where they are settled and weak steps undone in n log n
    of its marks. Rows without a value are left out;
    without a deviation (too few neighbours) a chromosome is one segment. `plain` undoes by deviations alone.
    """
    marks = Window.partitionBy(*by).orderBy(order)
    half = max(block // 2, 2 * LEAST)
    rows = df.where(F.col(value).isNotNull()).join(sd, [c for c in by if c in sd.columns], "left")
    rows = rows.select(*by, F.col(order).cast("double").alias("_at"), F.col(value).cast("double").alias("_x"), F.coalesce("sd", F.lit(float("inf"))).alias("_sd"), (F.row_number().over(marks) - 1).alias("_k"))
    # Marks are packed, a row a half of a block, where they are numbered: Python takes them as they are, without a row for each.
    packed = rows.groupBy(*by, F.floor(F.col("_k") / half).alias("_half")).agg(F.min("_sd").alias("_sd"), F.array_sort(F.collect_list(F.struct("_k", "_x", "_at"))).alias("_m"))
    packed = stored(packed.select(*by, "_half", "_sd", F.col("_m._x").alias("_x"), F.col("_m._at").alias("_at")))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    keys = ", ".join(f"`{c}` {kinds[c]}" for c in by)
    noise = lambda sd: max(float(sd), 1e-9)

    def sought(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sds, firsts, xs = batch.column("_sd"), batch.column("_half"), batch.column("_x")
            found = [arc_cuts(xs[i].values.to_numpy(zero_copy_only=False), noise(sds[i].as_py())) for i in range(len(xs))]
            own = np.repeat(np.arange(len(xs)), [len(f) for f in found])
            cuts = np.concatenate([np.array(f, np.int64) + firsts[i].as_py() * half for i, f in enumerate(found)]) if len(own) else np.array([], np.int64)
            yield from pa.Table.from_batches([batch]).select(by).take(pa.array(own)).append_column("cut", pa.array(cuts)).to_batches()

    # A block is a half and the one behind it, or the last half.
    behind = F.lead("_x").over(Window.partitionBy(*by).orderBy("_half"))
    blocks = packed.select(*by, "_half", "_sd", F.concat("_x", F.coalesce(behind, F.array().cast("array<double>"))).alias("_x"))
    # A number of tasks is given, as the search takes more time than its few bytes let Spark expect.
    blocks = blocks.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by, "_half")
    cuts = blocks.mapInArrow(sought, f"{keys}, cut long")

    def joined(pdf: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_half")
        x, at, sd_ = np.concatenate(pdf["_x"].to_list()), np.concatenate(pdf["_at"].to_list()), float(pdf["_sd"].iloc[0])
        inner = settled(x, found["cut"].tolist(), noise(sd_))
        inner = undo_weak(x, inner, sd_, min_long=math.inf) if plain else undo_weak(x, inner, sd_)
        edges = np.array([0, *inner, len(x)])
        a, b = edges[:-1], edges[1:]
        means = [float(x[i:j].mean()) for i, j in zip(a, b, strict=True)]
        return pd.DataFrame({**repeated(pdf, by, len(a)), "start": at[a], "end": at[b - 1], "n_marks": b - a, "mean": means})

    return packed.groupBy(*by).cogroup(cuts.groupBy(*by)).applyInPandas(joined, f"{keys}, start double, end double, n_marks long, mean double")
