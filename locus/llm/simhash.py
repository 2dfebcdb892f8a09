"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits that differ in at most 4 differ in at most 1 bit of some table of bits: of one of three blocks
(22, 21 and 21 bits), or of one pair out of five blocks (26 or 25 bits). Of a table's bits the anchors are the codewords
of the [15, 11] Hamming code on the low 15 joined with all words on the others: every value has an anchor within the
covering radius 1. A fingerprint is replicated to every anchor within radius + threshold (1 + 1), so the nearest anchor
of either of two partners also holds the other, and fingerprints are compared per anchor: those at home there (nearest)
against all that visit. Wider tables have more anchors, so the cut follows the number of fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, components, table

#: Differing bits that link.
NEAR = 4


@dataclass(frozen=True)
class Cut:
    """The 64 bits in blocks, and how many of them a table joins. NEAR differing bits leave one at most in some table."""

    blocks: int
    join: int

    def __post_init__(self) -> None:
        spread = sorted(NEAR // self.blocks + (i < NEAR % self.blocks) for i in range(self.blocks))
        if sum(spread[: self.join]) > 1 or 64 // self.blocks * self.join < 15:
            raise ValueError("a pair could differ in more than one bit of every table")

    @property
    def tables(self) -> list[list[tuple[int, int]]]:
        """For each table its blocks (first bit, width)."""
        edges = [64 * i // self.blocks for i in range(self.blocks + 1)]
        return [list(t) for t in combinations([(a, b - a) for a, b in pairwise(edges)], self.join)]

    def values(self, fp: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """The bits of each table side by side, and their number."""
        for table_ in self.tables:
            value, width = np.zeros(len(fp), np.int64), 0
            for first, n in table_:
                value |= ((fp.view(np.uint64) >> np.uint64(first)) & np.uint64((1 << n) - 1)).astype(np.int64) << width
                width += n
            yield value, width


#: Some 40 replicas of a fingerprint over 2**19 anchors, and some 220 over 10 * 2**22 for tables beyond MANY.
FEW_ANCHORS, MANY_ANCHORS, MANY = Cut(3, 1), Cut(5, 2), 200_000_000
#: Members of an anchor that one cell compares at most, at home and visiting.
CELL = 4096


def fingerprint(text: str | None, size: int = 4) -> int:
    """The SimHash of a whole text over its word shingles; zero for a text without words."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(found) < size:
        return digest(b" ".join(found), 42)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n, ones = len(found) - size + 1, np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        to = min(n, at + (1 << 16))
        hashes = np.fromiter([digest(joined[a:b], 42) for a, b in zip(starts[at:to].tolist(), ends[at + size - 1 : to + size - 1].tolist(), strict=True)], np.uint64, to - at)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprinted(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, h, fp) of every row: fp is the fingerprint as a signed long, h the hash of the text as it is."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.col(f"`{text}`").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py()) for t in b["t"]], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["h"], pa.array(fps)], names=["doc_id", "h", "fp"])

    return rows.mapInArrow(run, "doc_id long, h long, fp long")


def _errors() -> tuple[np.ndarray, list[np.ndarray]]:
    """The syndrome of every 15-bit word, and for each syndrome the errors of weight at most 2 that explain it."""
    word = np.arange(1 << 15)
    syndrome = np.zeros(1 << 15, np.int64)
    for bit in range(15):
        syndrome ^= np.where(word >> bit & 1, bit + 1, 0)
    light = np.bitwise_count(word) <= 2
    return syndrome, [word[light & (syndrome == s)] for s in range(16)]


_SYNDROME, _ERRORS = _errors()


def anchors(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the value, anchor, whether the value is at home) for every anchor within 2 bits of each value."""
    low, high = values & 0x7FFF, values >> 15
    s = _SYNDROME[low]
    near = low ^ np.where(s > 0, 1 << np.maximum(s - 1, 0), 0)
    out: list[tuple[np.ndarray, np.ndarray, bool]] = [(np.arange(len(values)), high << 15 | near, True)]
    for k in range(16):  # other codewords within 2 of the low bits
        at = np.flatnonzero(s == k)
        out += [(at, high[at] << 15 | (low[at] ^ e), False) for e in _ERRORS[k] if e != (1 << (k - 1) if k else 0)]
    flips = [1 << i for i in range(width - 15)]
    out += [(np.arange(len(values)), (high ^ f) << 15 | near, False) for f in flips]
    at = np.flatnonzero(s == 0)
    out += [(at, (high[at] ^ f ^ g) << 15 | near[at], False) for i, f in enumerate(flips) for g in flips[:i]]
    home = np.concatenate([np.full(len(a), h) for a, _, h in out])
    return np.concatenate([a for a, _, _ in out]), np.concatenate([x for _, x, _ in out]), home


def replicated(prints: DataFrame, cut: Cut = FEW_ANCHORS) -> DataFrame:
    """(anchor, fp, home) for every distinct fingerprint and anchor that it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b["fp"].to_numpy(zero_copy_only=False)
            for n, (values, width) in enumerate(cut.values(fp)):
                at, anchor, home = anchors(values, width)
                for k in range(0, len(at), 50_000):
                    part = slice(k, k + 50_000)
                    yield pa.RecordBatch.from_arrays([pa.array(anchor[part] | n << 26), pa.array(fp[at[part]]), pa.array(home[part])], names=["anchor", "fp", "home"])

    return prints.select("fp").mapInArrow(run, "anchor long, fp long, home boolean")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning star for each component of the links (a, b): (node, smallest node of its component)."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y, label = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while (jump := new[new]).tobytes() != new.tobytes():
            new = jump
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _links(cell: np.ndarray, fp: np.ndarray, home: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Spanning links of near fingerprints within runs of equal cells, at most `most` comparisons at a time."""
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    lengths = np.diff(np.r_[starts, len(cell)])
    run = np.repeat(np.arange(len(starts)), lengths)
    at_home = np.flatnonzero(home & (lengths[run] > 1))
    todo = np.cumsum(lengths[run[at_home]])
    lo = 0
    while lo < len(at_home):
        hi = max(lo + 1, int(np.searchsorted(todo, (todo[lo - 1] if lo else 0) + most, "right")))
        mine = at_home[lo:hi]
        n = lengths[run[mine]]
        left = np.repeat(mine, n)
        right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[run[mine]], n)
        apart = np.bitwise_count(fp[left] ^ fp[right])
        near = (apart <= NEAR) & (apart > 0)
        if near.any():
            yield forest(fp[left[near]], fp[right[near]])
        lo = hi


def compared(cells: DataFrame) -> DataFrame:
    """Spanning links (a, b) of rows (anchor, part, fp, home) that arrive sorted by anchor and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            anchor, part, fp, home = (np.concatenate(x) for x in zip(*held, strict=True))
            cell = np.cumsum(np.r_[True, (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])])
            # The last run may go on in the next batch.
            cut = len(cell) if last else int(np.searchsorted(cell, cell[-1], "left"))
            for a, b in _links(cell[:cut], fp[:cut], home[:cut]):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            held[:] = [[anchor[cut:], part[cut:], fp[cut:], home[cut:]]]

        for b in batches:
            if b.num_rows:
                held.append([b[c].to_numpy(zero_copy_only=False) for c in ("anchor", "part", "fp", "home")])
                if sum(len(x[0]) for x in held) > 200_000:
                    yield from flush(False)
        if held:
            yield from flush(True)

    return cells.mapInArrow(run, "a long, b long")


def links(prints: DataFrame, cut: Cut | None = None) -> DataFrame:
    """Spanning links (a, b) between near ones of the distinct fingerprints (fp).

    An anchor with more than CELL members is cut into a grid: members at home are dealt to rows, all members as
    visitors to columns. Those at home are replicated along their row and visitors along their column, so every pair
    still meets once and every cell stays bounded; while those at home fit one row, visitors are not replicated.
    """
    if cut is None:
        cut = FEW_ANCHORS if prints.count() <= MANY else MANY_ANCHORS
    rows = replicated(prints, cut)
    size = F.col("n") / CELL
    crowded = rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("home"), 1)).alias("h")).where(size > 1)
    crowded = checkpointed(crowded.select(F.col("anchor").alias("_a"), F.ceil(size).cast("long").alias("_columns"), F.greatest(F.lit(1), F.ceil(F.col("h") / CELL)).cast("long").alias("_rows")))
    zero = F.lit(0).cast("long")
    if n := crowded.count():
        # The grid's few rows are sent to all executors only when there are few of them.
        rows = rows.join(F.broadcast(crowded) if n <= 20_000 else crowded, F.col("anchor") == F.col("_a"), "left")
        hashed, (across, down) = F.xxhash64("fp"), (F.col("_columns"), F.col("_rows"))
        column, row = F.pmod(hashed, across), F.pmod(hashed, down)
        visits = F.when(across.isNull(), F.array(zero)).otherwise(F.transform(F.sequence(zero, down - 1), lambda i: i * across + column))
        houses = F.when(across.isNull(), F.array(zero)).otherwise(F.transform(F.sequence(zero, across - 1), lambda j: row * across + j))
        visiting = rows.select("anchor", "fp", F.lit(False).alias("home"), F.explode(visits).alias("part"))
        living = rows.where("home").select("anchor", "fp", F.lit(True).alias("home"), F.explode(houses).alias("part"))
        cells = visiting.unionByName(living)
    else:
        cells = rows.withColumn("part", zero)
    cells = cells.select("anchor", "part", "fp", "home").repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    return compared(cells)


def grouped(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, h, fp, root, component_id) of every row.

    Distinct fingerprints are nodes; links() joins them to components, and root is a component's smallest fingerprint.
    component_id is the smallest id of its rows, any long; null if no row has one. Null and blank texts have fingerprint
    zero and are linked like any other. Rows are told apart by their texts: two rows with one id and different texts
    are two nodes and join only if their fingerprints do, while repeated rows get equal results. Texts are hashed whole,
    a very long one in slices. An empty table gives an empty result. Other columns are not read, so their names
    cannot clash.
    """
    prints = checkpointed(fingerprinted(docs, text, key))
    nodes = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes)).select(F.col("node").alias("fp"), "root")
    linked = checkpointed(nodes.join(roots, "fp"))
    named = linked.join(linked.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")
    alone = nodes.join(roots, "fp", "left_anti").select("fp", F.col("fp").alias("root"), F.col("least").alias("component_id"))
    return prints.join(named.unionByName(alone), "fp").select("doc_id", "h", "fp", "root", "component_id")


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each component of docs, with its own columns: that of the smallest id, nulls last, then text hash.

    Of rows that agree in id and text one stays: the least as JSON, so reruns agree. A component without ids keeps one
    row too. Empty tables, null texts and very long texts are as in grouped().
    """
    marked = grouped(docs, text, key)
    each = marked.groupBy("root", "doc_id", "h").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "h", "n")
    keep = checkpointed(each.groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias("_id2"), F.col("k.h").alias("_h2"), F.col("k.n").alias("_n")))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(row, F.col(f"`{key}`").cast("long").alias("_id"), F.xxhash64(F.col(f"`{text}`")).alias("_h"))
    kept = rows.join(keep, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_h") == F.col("_h2")))
    if keep.where("_n > 1").isEmpty():
        return kept.select("_row.*")
    several = kept.where("_n > 1").groupBy("_id", "_h").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return kept.where("_n = 1").select("_row").unionByName(several.select("_row")).select("_row.*")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = grouped(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op1_simhash": op1_simhash}
SQL: dict[str, str] = {}
