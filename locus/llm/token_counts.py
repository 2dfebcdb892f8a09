"""Token counts by heap-and-linked-list pair merging, without emitting identifiers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .piece_model import PieceModel, Remembered, loaded

#: Stretches whose counts a worker remembers; forgotten all at once when full.
REMEMBERED = 600_000
LIMIT = 4096


class Counter:
    """Counts a text's tokens stretch by stretch: initial symbols less merges."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.known = Remembered(model, lambda s: model.initial(s) - model.n_merges(s), 0, REMEMBERED)

    def count(self, text: str) -> int:
        return sum(self.known.values(text))


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(loaded(path))
    return _COUNTERS[path]


def counted(docs: DataFrame, model: str | None = None, text: str = "text", key: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """key, n_bytes, n_tokens, over_limit of every whole text; a null text is an empty one with no tokens.

    One pass without a shuffle; rows are independent, so repeated rows get equal counts, and other columns are not read,
    so names cannot clash. A very long text is counted stretch by stretch by one task; an empty table gives an empty
    result.
    """
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.octet_length(body).cast("long").alias("n_bytes"), body.alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(model)
        for b in batches:
            n = [c.count(t.as_py()) for t in b["t"]]
            yield pa.RecordBatch.from_arrays([b["k"], b["n_bytes"], pa.array(n, pa.int64())], names=["k", "n_bytes", "n_tokens"])

    kind = rows.schema["k"].dataType.simpleString()
    out = rows.mapInArrow(run, f"k {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(table(spark, sf_dir, "documents"))


QUERIES = {"op8_token_counts": op8_token_counts}
SQL: dict[str, str] = {}
