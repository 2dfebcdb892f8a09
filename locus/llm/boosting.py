"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, table
from .quality import STOP_WORDS

#: Labelled rows that training takes at most, by a hash of their ids.
SAMPLE = 20_000
FOLDS, CUTOFF = 5, 0.3

_STOP = frozenset(w.encode() for w in STOP_WORDS)
#: Byte classes whose shares are statistics.
CLASSES = {
    "upper": bytes(range(0x41, 0x5B)), "lower": bytes(range(0x61, 0x7B)), "digit": b"0123456789", "blank": b" \t", "newline": b"\n", "stop": b".", "comma": b",;:", "shout": b"!", "question": b"?",
    "bar": b"|", "symbol": b"#*$%&<>~^=+_\\@{}[]", "quote": b"\"'`()/-", "control": bytes([*range(9), *range(11, 32), 127]), "wide": bytes(range(0x80, 0x100)),
}
_CLASS_OF = np.full(256, len(CLASSES), np.int64)
for _i, _members in enumerate(CLASSES.values()):
    _CLASS_OF[list(_members)] = _i
FEATURES = (
    "log_bytes", "log_words", "mean_word", "longest_word", "short_words", "long_words", "stop_words", "distinct_words", "distinct_pairs", "commonest_word", "capital_words", "shouted_words", "odd_ends",
    "log_lines", "mean_line", "distinct_lines", "ended_lines", "bulleted_lines", "entropy", *CLASSES,
)


def statistics(text: str | None) -> list[float]:
    """The document statistics of a whole text; those of an empty text are zero."""
    raw = (text or "").encode()
    ws = raw.split()
    if not ws:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = np.bincount(_CLASS_OF, counts, len(CLASSES) + 1)[: len(CLASSES)] / len(raw)
    some = counts[counts > 0] / len(raw)
    sizes = np.fromiter(map(len, ws), np.int64, len(ws))
    n, seen = len(ws), {}
    for w in ws:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = [w for w in ws if w[:1].isalpha()]
    return [
        np.log1p(len(raw)), np.log1p(n), sizes.mean(), np.log1p(sizes.max()), np.mean(sizes <= 2), np.mean(sizes >= 14), sum(c for w, c in seen.items() if w.lower() in _STOP) / n, len(seen) / n,
        len(set(zip(ws, ws[1:], strict=False))) / n, max(seen.values()) / n, sum(w[:1].isupper() for w in letters) / n, sum(len(w) > 1 and w.isupper() for w in letters) / n, sum(w[-1] in b"#*$%&|!<>" for w in ws) / n,
        np.log1p(len(lines)), np.log1p(len(raw) / len(lines)), len(set(lines)) / len(lines), sum(x.rstrip()[-1:] in b".!?:\"" for x in lines) / len(lines), sum(x.lstrip()[:1] in b"-*|#" for x in lines) / len(lines),
        float(-(some * np.log2(some)).sum()), *shares,
    ]


@dataclass(frozen=True)
class Trees:
    """Complete trees in arrays: inner node i of tree t asks whether feature[t, i] is over threshold[t, i] and leads to 2i + 1 or 2i + 2."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            while inner and len(at) and at[0] < inner:
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at - inner]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Cuts between quantiles of each feature; a value's bin is the number of cuts below it."""
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]


def best_splits(binned: np.ndarray, node: np.ndarray, nodes: int, g: np.ndarray, h: np.ndarray, bins: int, l2: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each node the feature and bin whose histogram of gradients gains most when rows of higher bins go right, and the gain."""
    gain_, feature, cut = np.zeros(nodes), np.zeros(nodes, np.int64), np.full(nodes, bins)
    for f in range(binned.shape[1]):
        cell = node * bins + binned[:, f]
        left_g = np.bincount(cell, g, nodes * bins).reshape(nodes, bins).cumsum(1)
        left_h = np.bincount(cell, h, nodes * bins).reshape(nodes, bins).cumsum(1)
        all_g, all_h = left_g[:, -1:], left_h[:, -1:]
        right_g, right_h = all_g - left_g, all_h - left_h
        gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - all_g**2 / (all_h + l2)
        gain[(left_h < least) | (right_h < least)] = 0
        k = gain.argmax(1)
        top = gain[np.arange(nodes), k]
        better = top > gain_ + 1e-12
        gain_[better], feature[better], cut[better] = top[better], f, k[better]
    return feature, cut, gain_


def trained(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 0.5, least: float = 0.5) -> Trees:
    """Trees for the logistic loss, each grown level by level on binned statistics. Without rows the score is 0.5; a single class keeps its prior."""
    inner, leaves = (1 << depth) - 1, 1 << depth
    p = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(p / (1 - p)))
    if not 0 < y.sum() < len(y):
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = bin_edges(x, bins)
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], 1)
    feature, threshold, value = np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf), np.zeros((rounds, leaves))
    margin = np.full(len(y), base)
    rows = np.arange(len(y))
    for t in range(rounds):
        s = 1 / (1 + np.exp(-margin))
        g, h = s - y, s * (1 - s)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, nodes = (1 << level) - 1, 1 << level
            f, cut, gain = best_splits(binned, node, nodes, g, h, bins + 1, l2, least)
            for i in range(nodes):
                if gain[i] > 0 and cut[i] < len(edges[f[i]]):
                    feature[t, first + i], threshold[t, first + i] = f[i], edges[f[i]][cut[i]]
                else:
                    f[i], cut[i] = 0, bins + 1  # all rows go left
            node = 2 * node + (binned[rows, f[node]] > cut[node])
        value[t] = -rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + l2)
        margin += value[t][node]
    return Trees(base, feature, threshold, value)


def _measured(rows: DataFrame, name: str) -> DataFrame:
    """(_k, _t) with the statistics of _t in place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["_k"], pa.array([statistics(t.as_py()) for t in b["_t"]], pa.list_(pa.float64()))], names=["_k", name])

    return rows.select("_k", "_t").mapInArrow(run, T.StructType([rows.schema["_k"], T.StructField(name, T.ArrayType(T.DoubleType()))]))


def held_out(key: str, folds: int = FOLDS) -> Column:
    """Whether a row's hash keeps it from training; a null key has none and is not held out."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string")) % folds == 0, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", most: int = SAMPLE) -> Trees:
    """Trees from labelled rows that are not held out: all of them, or the `most` whose ids have the least hashes.

    Labels other than 0 and 1, null ids and rows without a document are left out; of an id with several labels the least
    counts, and of a repeated document the one with the least statistics. Statistics of the sample alone reach the driver.
    """
    own = labels.select(F.col(f"`{key}`").alias("_k"), F.col(f"`{label}`").alias("_y")).where(F.col("_k").isNotNull() & F.col("_y").isin(0, 1) & ~held_out("_k"))
    chosen = own.groupBy("_k").agg(F.min("_y").alias("_y")).orderBy(F.xxhash64("_k"), "_k").limit(most)
    chosen = checkpointed(chosen)
    rows = docs.select(F.col(f"`{key}`").alias("_k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_t")).join(F.broadcast(chosen.select("_k")), "_k", "left_semi")
    found = _measured(rows, "_x").groupBy("_k").agg(F.min("_x").alias("_x")).join(F.broadcast(chosen), "_k").orderBy("_k").toArrow()
    x = np.array(found["_x"].to_pylist(), float).reshape(-1, len(FEATURES))
    return trained(x, np.array(found["_y"].to_pylist(), float))


def scored(docs: DataFrame, trees: Trees, text: str = "text", key: str = "doc_id", cutoff: float = CUTOFF) -> DataFrame:
    """key, held_out, score and predicted of every whole text, batch by batch in numpy.

    A null text is an empty one, whose statistics are zero. Rows are independent, so repeated rows get equal scores; other
    columns are not read. A very long text is measured by one task; an empty table gives an empty result.
    """
    rows = docs.select(F.struct(F.col(f"`{key}`").alias("k"), held_out(key).alias("h")).alias("_k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t.as_py()) for t in b["_t"]], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b["_k"], pa.array(trees.score(x), pa.float64())], names=["_k", "score"])

    out = rows.select("_k", "_t").mapInArrow(run, T.StructType([rows.schema["_k"], T.StructField("score", T.DoubleType())]))
    return out.select(F.col("_k.k").alias(key), F.col("_k.h").alias("held_out"), "score", (F.col("score") >= cutoff).cast("int").alias("predicted"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fitted(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op13_quality_classifier": op13_quality_classifier}
SQL: dict[str, str] = {}
