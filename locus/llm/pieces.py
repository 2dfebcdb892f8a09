"""SentencePiece encoding with byte offsets, and decoding."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .piece_model import SPACE, PieceModel, Remembered, loaded

#: Stretches that a worker remembers; forgotten all at once when full, so memory stays bounded.
REMEMBERED = 400_000
#: Bytes of text that a worker encodes at once; a batch of rows has some hundred times as many numbers as it needs at a time.
AT_ONCE = 1 << 20


class Encoder:
    """Encodes whole texts through remembered stretches: ids, and for each id its bytes of the source."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.packed = {p: n << 32 | i for p in model.id_of for (i,), (n,) in [model.stretch_pieces([p])]}
        self.known = Remembered(model, self._stretch, b"", REMEMBERED)

    def _stretch(self, stretch: str) -> bytes:
        """A 64-bit number for each piece, its id below and its size above; bytes are no load for the garbage collector."""
        symbols = self.model.merged(stretch) if len(stretch) > 1 else [stretch]
        try:
            return array("q", map(self.packed.__getitem__, symbols)).tobytes()
        except KeyError:
            return array("q", [n << 32 | i for i, n in zip(*self.model.stretch_pieces(symbols), strict=True)]).tobytes()

    def encode(self, text: str, end: bool = True) -> list[int]:
        return self.spans(text, end)[0]

    def spans(self, text: str, end: bool = True) -> tuple[list[int], list[int], list[int]]:
        """ids, and the first and past-the-last byte of the source that each stands for.

        Pieces tile the normalised text; the alignment takes their borders to the source. Of the byte pieces of a
        character the last has its bytes, the others are empty. The end id has the empty span at the end.
        """
        found, borders = self.bordered(text)
        ids, at = found.tolist(), borders.tolist()
        starts, ends = at[:-1], at[1:]
        if end:
            ids.append(self.model.end)
            starts.append(at[-1])
            ends.append(at[-1])
        return ids, starts, ends

    def bordered(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """ids without the end, and the places in the source where they begin and the last one ends.

        A plain model's character map is empty, so its walk replaces nothing: places in the source are running sums of the
        pieces' bytes. Other texts and models are aligned byte by byte.
        """
        model = self.model
        simple = model.plain and SPACE not in text
        if simple:
            found = self.known.values(text)
        else:
            norm, to = model.aligned(text)
            found = self.known.cut(norm)
        packed = np.frombuffer(b"".join(found), np.int64)
        ids, sizes = packed & 0xFFFFFFFF, packed >> 32
        borders = np.zeros(len(ids) + 1, np.int64)
        if simple:
            np.cumsum(sizes, out=borders[1:])
            # The prefix mark, which opens the text, stands for no byte of it.
            borders -= 1
            return ids, np.maximum(borders, 0, out=borders)
        if model.plain:  # marks of the source itself are counted as one byte: count the normalised ones
            sizes = np.fromiter(chain.from_iterable(map(model.sizes, model.stretch.findall(norm))), np.int64, len(ids))
        np.cumsum(sizes, out=borders[1:])
        return ids, np.asarray(to, np.int64)[borders]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(loaded(path))
    return _ENCODERS[path]


def _model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


PIECES = pa.list_(pa.struct([("id", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def _pieces(e: Encoder, texts: pa.Array) -> pa.ListArray:
    """The pieces (id, start, end) of each whole text, the end id last."""
    ids, starts, ends, sizes, last = [], [], [], [0], np.array([e.model.end])
    for t in texts:
        own, borders = e.bordered(t.as_py() or "")
        ids += (own, last)
        starts.append(borders)
        ends += (borders[1:], borders[-1:])
        sizes.append(len(borders))
    whole = lambda parts: pa.array(np.concatenate(parts).astype(np.int32) if parts else [], pa.int32())
    rows = pa.StructArray.from_arrays([whole(ids), whole(starts), whole(ends)], fields=list(PIECES.value_type))
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), rows, type=PIECES)


def portions(texts: pa.Array, most: int = AT_ONCE) -> Iterator[slice]:
    """Runs of rows whose texts have `most` bytes together, or one row that has more."""
    first, size = 0, 0
    for k, n in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
        if k > first and size + n > most:
            yield slice(first, k)
            first, size = k, 0
        size += n
    if first < len(texts):
        yield slice(first, len(texts))


def encoded(docs: DataFrame, model: str | None = None, text: str = "text") -> DataFrame:
    """docs with `pieces`: an array of (id, start, end), the bytes of the source that each piece covers.

    A null text is an empty one: only the end id. Other columns pass through unread by Python; one named `pieces` is
    replaced. Empty tables, repeated rows and very long texts are as in digests().
    """
    path = model or _model_path()

    @F.arrow_udf("array<struct<id:int,start:int,end:int>>")
    def pieces(texts):  # noqa: ANN001, ANN202
        return pa.concat_arrays([_pieces(encoder(path), texts[p]) for p in portions(texts)] or [pa.array([], PIECES)])

    return docs.withColumn("pieces", pieces(F.coalesce(F.col(f"`{text}`"), F.lit(""))))


def digests(docs: DataFrame, model: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256, spans_sha256 of every whole text; null and empty texts have the end id alone.

    One pass without a shuffle: each text is encoded to the pieces of encoded(), whose ids are counted, digested and
    decoded again, and whose spans are digested as pairs (start, end) of 32-bit numbers, least byte first. Spans that do not
    tile a text fail the query. Rows are independent, so repeated rows and ties need no
    care; a very long text is held by one task once. An empty table gives an empty result; only text and key are read,
    so other names cannot clash.
    """
    path = model or _model_path()
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        decimal = [str(i) for i in range(len(e.model.pieces))]
        for b in (b.slice(p.start, p.stop - p.start) for b in batches for p in portions(b["t"])):
            pieces = _pieces(e, b["t"])
            offsets = pieces.offsets.to_numpy()
            all_ids, starts, ends = (pieces.values.field(n).to_numpy() for n in ("id", "start", "end"))
            if e.model.plain:
                tiled(offsets, starts, ends, pc.binary_length(b["t"]).to_numpy(zero_copy_only=False))
            ids_sha, text_sha, spans_sha = [], [], []
            spans = np.stack([starts, ends], 1).astype("<i4")
            for a, z in pairwise(offsets.tolist()):
                ids = all_ids[a:z].tolist()
                ids_sha.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                text_sha.append(hashlib.sha256(e.model.decode(ids).encode()).hexdigest())
                spans_sha.append(hashlib.sha256(spans[a:z].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays([b["k"], pa.array(np.diff(offsets), pa.int64()), *[pa.array(x, pa.string()) for x in (ids_sha, text_sha, spans_sha)]], names=[key, "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])

    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")


def tiled(offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> None:
    """Fails unless the spans of each text begin at 0, follow each other and end at its size."""
    first, last = offsets[:-1], offsets[1:] - 1
    follows = starts[1:] == ends[:-1]
    follows[first[1:] - 1] = True
    if starts[first].any() or not follows.all() or (ends[last] != sizes).any() or (ends < starts).any():
        raise ValueError("pieces do not tile their text")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


QUERIES = {"op3_sentencepiece": op3_sentencepiece}
SQL: dict[str, str] = {}
