"""How an insert's own flanks hold it: anchors, a chain of them, and alignment between anchors only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Scores of the alignment. Fixed values.
MATCH, MISMATCH, GAP_OPEN, GAP_EXTEND = 2, -6, 10, 1
#: Bases of an anchor, the most cells that are filled between two of them, and bases that are tried beyond the outer ones.
ANCHOR, CELLS, BEYOND = 9, 40_000, 60


def anchors(query: str, target: str, k: int = ANCHOR) -> list[tuple[int, int, int]]:
    """Longest exact matches of k bases and more: (place in query, in target, length)."""
    at: dict[str, list[int]] = {}
    for j in range(len(target) - k + 1):
        at.setdefault(target[j : j + k], []).append(j)
    open_: dict[int, list[int]] = {}
    out = []
    for i in range(len(query) - k + 1):
        for j in at.get(query[i : i + k], ()):
            run = open_.get(j - i)
            if run and run[0] + run[1] == i + k - 1:
                run[1] += 1
            else:
                if run:
                    out.append((run[0], run[0] + j - i, run[1]))
                open_[j - i] = [i, k]
    return sorted(out + [(i, i + d, n) for d, (i, n) in open_.items()])


def gap_cost(n: int) -> int:
    return GAP_OPEN + GAP_EXTEND * (n - 1) if n else 0


def between(a: str, b: str, whole: bool = True) -> tuple[int, int, int, int]:
    """Score, equal bases, columns and bases of b of the best alignment of two short stretches from their beginnings, by affine gaps: end to end, or to wherever it scores most."""
    n, m = len(a), len(b)
    if whole and (not n or not m or n * m > CELLS):
        return -gap_cost(n) - gap_cost(m), 0, n + m, m
    low = (-(10**9), 0, 0)
    best = [(0, 0, 0)] + [(-gap_cost(j), 0, j) for j in range(1, m + 1)]
    up = [low] * (m + 1)  # alignments that end in a base of a over a gap
    top = (0, 0, 0, 0)
    for i in range(1, n + 1):
        corner, best[0] = best[0], (-gap_cost(i), 0, i)
        left = low
        for j in range(1, m + 1):
            up[j] = max((best[j][0] - GAP_OPEN, best[j][1], best[j][2] + 1), (up[j][0] - GAP_EXTEND, up[j][1], up[j][2] + 1))
            left = max((best[j - 1][0] - GAP_OPEN, best[j - 1][1], best[j - 1][2] + 1), (left[0] - GAP_EXTEND, left[1], left[2] + 1))
            same = a[i - 1] == b[j - 1]
            over = (corner[0] + (MATCH if same else MISMATCH), corner[1] + same, corner[2] + 1)
            corner, best[j] = best[j], max(over, up[j], left)
            if best[j][0] > top[0]:
                top = (*best[j], j)
    return (*best[m], m) if whole else top


def chained(found: list[tuple[int, int, int]]) -> list[int]:
    """The anchors of the chain that scores most: both places rise, and a change of diagonal costs a gap. An anchor may lose its first bases to the one before."""
    if not found:
        return []
    i, j, n = (np.array(x) for x in zip(*found, strict=True))
    total, came = MATCH * n.astype(float), np.full(len(n), -1)
    for x in range(1, len(n)):
        room = np.minimum(i[x] - i[:x], j[x] - j[:x])
        lost = np.maximum(n[:x] - room, 0)
        shift = np.abs((j[x] - i[x]) - (j[:x] - i[:x]))
        cost = np.where(shift > 0, GAP_OPEN + GAP_EXTEND * (shift - 1), 0)
        # Bases between two anchors are taken as half mismatches, half equal.
        score = total[:x] - cost - MATCH * lost - np.maximum(room - n[:x], 0) * 0.5
        score[(room <= 0) | (lost >= n[x])] = -np.inf
        b = int(score.argmax())
        if score[b] > 0:
            total[x], came[x] = total[x] + score[b], b
    out, x = [], int(total.argmax())
    while x >= 0:
        out.append(x)
        x = int(came[x])
    return out[::-1]


def aligned(query: str, target: str, k: int = ANCHOR) -> tuple[float, float, int, int]:
    """Share of the query that is equal, share of the alignment's columns that are, and the stretch of the target."""
    found = anchors(query, target, k)
    chain = [found[x] for x in chained(found)]
    if not chain:
        return 0.0, 0.0, 0, 0
    laid: list[tuple[int, int, int]] = []  # anchors less what they share with those before
    runs: list[tuple[int, int, int]] = []  # score, equal bases and columns of a stretch that begins at `begun`
    i, j = chain[0][0], chain[0][1]
    best, begun, top = (-1, 0, 0), 0, (0, 0)
    for a, b, n in chain:
        cut = max(i - a, j - b, 0)
        a, b, n = a + cut, b + cut, n - cut
        gap = between(query[i:a], target[j:b])
        here = tuple(x + y for x, y in zip(runs[-1] if runs else (0, 0, 0), gap, strict=False))
        # A stretch that does not pay for what lies before the next anchor is left behind.
        here, begun = (here, begun) if here[0] > 0 else ((0, 0, 0), len(laid))
        runs.append((here[0] + MATCH * n, here[1] + n, here[2] + n))
        laid.append((a, b, n))
        i, j = a + n, b + n
        if runs[-1][0] > best[0]:
            best, top = runs[-1], (begun, len(laid) - 1)
    _, same, columns = best
    (i, j, _), (a, b, n) = laid[top[0]], laid[top[1]]
    # Beyond the outer anchors there is none for BEYOND bases, or the chain has left it out.
    back = between(query[max(i - BEYOND, 0) : i][::-1], target[max(j - BEYOND, 0) : j][::-1], False)
    begin, i, j = j - back[3], a + n, b + n
    on = between(query[i : i + BEYOND], target[j : j + BEYOND], False)
    same, columns = same + back[1] + on[1], columns + back[2] + on[2]
    return same / len(query), same / columns, begin, j + on[3]


def flank_alignment(inserts: DataFrame) -> DataFrame:
    """How much of each insert its better flank holds: sv_id, flank_coverage, best_flank, flank_aln_identity, flank_block.

    inserts: sv_id, seq, left, right. Anchors are exact matches, the best chain of them is laid out, and only what lies between
    two anchors, and beyond the outer ones, is aligned; so the work grows with the anchors and not with the product of the lengths. Coverage is the
    share of the insert's bases that are equal, identity that of the alignment's columns, the block is the stretch of the flank. Case does
    not count. Without an anchor coverage is 0 and the flank null; empty inserts likewise. A row needs nothing of others.
    """
    rows = inserts.select(F.struct("sv_id").alias("_k"), *[F.upper(F.coalesce(c, F.lit(""))).alias(c) for c in ("seq", "left", "right")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for q, left, right in zip(*[b[c].to_pylist() for c in ("seq", "left", "right")], strict=True):
                best = (0.0, None, 0.0, "")
                for name, t in (("left", left), ("right", right)):
                    cov, identity, lo, hi = aligned(q, t) if q and t else (0.0, 0.0, 0, 0)
                    best = (cov, name, identity, t[lo:hi]) if cov > best[0] else best
                out.append(best)
            kinds = (pa.float64(), pa.string(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([b["_k"], *[pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)]], names=["_k", *names])

    names = ["flank_coverage", "best_flank", "flank_aln_identity", "flank_block"]
    kind = rows.schema["_k"].dataType.simpleString()
    return rows.mapInArrow(run, f"_k {kind}, flank_coverage double, best_flank string, flank_aln_identity double, flank_block string").select("_k.sv_id", *names)
