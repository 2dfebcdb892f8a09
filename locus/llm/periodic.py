"""Runs of repeated word sequences, found in tiles of one octave of periods each and stitched by document and period."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import checkpointed, let, nullable, table, words

#: A run has at least LEAST words and TIMES periods.
LEAST, TIMES = 6, 4
#: Texts of more bytes are cut into sections for several tasks.
LONG = 1 << 20
#: Words of a section, and words that are solved together.
SECTION, TOGETHER = 1 << 16, 1 << 17
#: Words of a Z value that are compared for all tiles side by side; longer ones are finished tile by tile.
AHEAD = 32


@dataclass(frozen=True)
class Section:
    """Words of a document that hold all tiles of some octaves whose boundaries lie in a range."""

    base: int  # where the first word is in the array
    offset: int  # its number in the document
    n: int  # words of the document
    octaves: range
    first: int  # boundaries from here
    last: int  # to before here


def octaves(n: int) -> range:
    """Octaves of the periods that a run in n words can have: k stands for periods from 2^k to before 2^(k+1)."""
    return range((n // TIMES).bit_length() if n >= LEAST else 0)


def z_function(s: list[int]) -> list[int]:
    """For each place the length of what is there and also at the beginning."""
    n, z, lo, hi = len(s), [0] * len(s), 0, 0
    for i in range(1, n):
        k = min(hi - i, z[i - lo]) if i < hi else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > hi:
            lo, hi = i, i + k
        z[i] = k
    return z


def tile_extents(left: list[int], right: list[int], periods: range) -> tuple[list[int], list[int]]:
    """How far each period holds beyond the boundary between left and right: forwards from it, and backwards."""
    ahead = z_function(right)
    back = left[::-1]
    behind = z_function([*back, -1, *right[: periods.stop - 1][::-1], *back])
    at = len(back) + 1 + min(periods.stop - 1, len(right))
    return [ahead[q] for q in periods], [behind[at - q] for q in periods]


def _reach(ids: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """Equal words from a and b on, up to `most` and AHEAD."""
    out = np.zeros(len(a), np.int64)
    live = np.flatnonzero(most > 0)
    for t in range(AHEAD):
        live = live[ids[a[live] + step * t] == ids[b[live] + step * t]]
        out[live] += 1
        live = live[most[live] > t + 1]
        if not len(live):
            break
    return out


def fragments(ids: np.ndarray, sections: Sequence[Section]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(section, period, start, end) of stretches that keep a period around a boundary of its octave's tiles.

    Octave k has boundaries every B = 2^(k+1) words; a run of period q has at least 3q > B places where a period begins, so
    a boundary is among them. Its tile reaches B words back and 2B ahead. Two Z functions tell how far each period of the
    octave holds in it. Stretches that a tile's edge cuts share 2B words with the next one; others stay if they are runs.
    """
    found: list[tuple[np.ndarray, ...]] = []
    for k in range(max((s.octaves.stop for s in sections), default=0)):
        low, wide = 1 << k, 2 << k
        own = [(i, s) for i, s in enumerate(sections) if k in s.octaves]
        if not own:
            continue
        at = [np.arange(-(-s.first // wide) * wide, min(s.last, s.n - low), wide) for _, s in own]
        many = [len(x) for x in at]
        which, b, n = np.repeat([i for i, _ in own], many), np.concatenate(at), np.repeat([s.n for _, s in own], many)
        to = np.repeat([s.base - s.offset for _, s in own], many)  # a word's place in the array, less its number
        left, right = np.maximum(b - wide, 0), np.minimum(b + 2 * wide, n)
        tiles = max(1, TOGETHER // low)
        for c in range(0, len(b), tiles):
            t = np.arange(c, min(c + tiles, len(b)))
            q = np.arange(low, wide)
            inside = b[t][:, None] + q < n[t][:, None]
            same = inside & (ids[np.where(inside, (b + to)[t][:, None] + q, 0)] == ids[(b + to)[t]][:, None])
            row, col = np.nonzero(same)
            row, per = t[row], low + col
            here = b[row] + to[row]
            room = np.stack([right[row] - b[row] - per, b[row] - left[row]])
            ahead = _reach(ids, here, here + per, room[0], 1)
            # A stretch that ends ahead needs its other words behind.
            behind = _reach(ids, here - 1, here + per - 1, room[1], -1)
            open_ = ((ahead == AHEAD) & (room[0] > AHEAD)) | ((behind == AHEAD) & (room[1] > AHEAD))
            hopeless = (ahead + behind < (TIMES - 1) * per) & ~open_ & (ahead < room[0]) & (behind < room[1])
            row, per, ahead, behind, open_ = (x[~hopeless] for x in (row, per, ahead, behind, open_))
            for r in np.unique(row[open_]):
                p = np.flatnonzero(row == r)
                i, j = left[r] + to[r], right[r] + to[r]
                m = b[r] + to[r]
                f, g = tile_extents(ids[i:m].tolist(), ids[m:j].tolist(), range(low, int(min(wide, j - m))))
                ahead[p], behind[p] = np.array(f)[per[p] - low], np.array(g)[per[p] - low]
            start, end = b[row] - behind, b[row] + per + ahead
            cut = ((start == left[row]) & (start > 0)) | ((end == right[row]) & (end < n[row]))
            keep = cut | (end - start >= np.maximum(LEAST, TIMES * per))
            found.append((which[row[keep]], per[keep], start[keep], end[keep]))
    if not found:
        return (np.empty(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes split at the ASCII white space of the contracts


def numbered(found: list[bytes]) -> np.ndarray:
    return pa.array(found, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int32)


def _solved_batches(batches: Iterator[pa.RecordBatch], whole: bool, cut: bool) -> Iterator[pa.RecordBatch]:
    """Rows (_key, _t) to (_key, n_words, _sha, _text, _f): texts of all rows or of those with fragments; without `cut` no fragments are sought."""

    def emit(keys: pa.Array, texts: list[str], parts: list[list[bytes]]) -> pa.RecordBatch:
        places = np.cumsum([0, *[len(p) for p in parts]])
        sections = [Section(int(places[i]), 0, len(p), octaves(len(p) if cut else 0), 0, len(p)) for i, p in enumerate(parts)]
        which, per, start, end = fragments(numbered([w for p in parts for w in p]), sections)
        order = np.argsort(which, kind="stable")
        sizes = np.bincount(which, minlength=len(parts))
        found = pa.StructArray.from_arrays([pa.array(x[order]) for x in (per, start, end)], names=["period", "start", "end"])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), found)
        plain = [hashlib.sha256(b" ".join(p)).hexdigest() for p in parts]
        kept = [t if whole or not cut or sizes[i] else None for i, t in enumerate(texts)]
        return pa.RecordBatch.from_arrays([keys, pa.array([len(p) for p in parts], pa.int64()), pa.array(plain), pa.array(kept, pa.string()), lists], names=["_key", "n_words", "_sha", "_text", "_f"])

    for batch in batches:
        texts, parts, n, begun = [], [], 0, 0
        for i, t in enumerate(batch["_t"]):
            texts.append(t.as_py())
            parts.append(split_words(texts[-1]))
            n += len(parts[-1])
            if n >= TOGETHER or i == batch.num_rows - 1:
                yield emit(batch["_key"].slice(begun, i + 1 - begun), texts, parts)
                texts, parts, n, begun = [], [], 0, i + 1


def _sections(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """A long text's words by number, in overlapping sections: those of `size` words hold the tiles of all octaves that fit,
    and of each higher octave every tile is a section."""
    for batch in batches:
        for u, t in zip(batch["_u"].to_pylist(), batch["_t"], strict=True):
            ids = numbered(split_words(t.as_py()))
            n = len(ids)
            fit = [k for k in octaves(n) if 4 << k <= size]
            cuts = [(fit[0], len(fit), a, a + size, 2 << fit[-1]) for a in range(0, n, size)] if fit else []
            cuts += [(k, k + 1, a, a + 1, 2 << k) for k in octaves(n) if k not in fit for a in range(0, n, 2 << k)]
            for lo, hi, first, last, wide in cuts:
                i, j = max(0, first - wide), min(n, last - 1 + 2 * wide)
                rows = [[u], [n], [lo], [hi], [first], [last], [i], [ids[i:j].tobytes()]]
                yield pa.RecordBatch.from_arrays([*[pa.array(r, pa.int64()) for r in rows[:-1]], pa.array(rows[-1], pa.binary())], names=["_u", "n", "lo", "hi", "first", "last", "offset", "ids"])


def _solved_sections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            s = Section(0, r["offset"], r["n"], range(r["lo"], r["hi"]), r["first"], r["last"])
            _, per, start, end = fragments(np.frombuffer(r["ids"], np.int32), [s])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(per), r["_u"], np.int64)), *[pa.array(x, pa.int64()) for x in (per, start, end)]], names=["_u", "period", "start", "end"])


def stitched(cut: DataFrame) -> DataFrame:
    """Runs (_u, start, length, period) of fragments (_u, period, start, end).

    Fragments of one document and period that share a period's words belong to one stretch. Of equal stretches the least
    period counts: a stretch's other periods are its multiples.
    """
    w = Window.partitionBy("_u", "period").orderBy("start", "end")
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("start") > before - F.col("period")), 1).otherwise(0)
    numbered_ = cut.withColumn("_o", opens).withColumn("_g", F.sum("_o").over(w))
    whole = numbered_.groupBy("_u", "period", "_g").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start")
    long_enough = whole.where(length >= F.greatest(F.lit(LEAST), TIMES * F.col("period")))
    return long_enough.groupBy("_u", "start", "end").agg(F.min("period").alias("period")).select("_u", "start", (F.col("end") - F.col("start")).alias("length"), "period")


@F.pandas_udf(T.StringType())
def _collapsed(text: pd.Series, runs: pd.Series) -> pd.Series:
    def kept(t: str | None, found) -> str | None:
        if t is None:
            return None
        parts = split_words(t)
        gone = np.zeros(len(parts) + 1, np.int64)
        for r in () if found is None else found:
            gone[r["start"] + r["period"]] += 1
            gone[r["start"] + r["length"]] -= 1
        stays = np.cumsum(gone)[:-1] == 0
        return b" ".join([p for p, s in zip(parts, stays.tolist(), strict=True) if s]).decode()

    return pd.Series([kept(t, r) for t, r in zip(text, runs, strict=True)], dtype=object)


def analysed(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", whole: bool = True, long: int | None = None, section: int | None = None) -> DataFrame:
    """keep columns, n_words, runs (array of start, length, period by start and period), collapsed, plain_sha256 of every row.

    A run is a longest stretch of words with smallest period q and at least 6 words and 4q. `collapsed` has the words
    that no run holds after its first q, joined by one space. With `whole` unset it is null for texts without fragments, whose
    words are all kept; plain_sha256 is the digest of all words so joined. Null texts have no words; repeated rows are judged
    each on its own; other columns are not read. Texts of more than `long` bytes are cut into overlapping sections by octave and solved
    over tasks; one tile of the highest octave is at most 1.5 times its text's words. An empty table gives an empty result.
    """
    long, section = LONG if long is None else long, SECTION if section is None else section
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_key"), body.alias("_t"), F.octet_length(body).alias("_n"))
    long_words = T.LongType()
    fragment = T.StructType([T.StructField(c, long_words) for c in ("period", "start", "end")])
    kinds = {"_key": rows.schema["_key"].dataType, "n_words": long_words, "_sha": T.StringType(), "_text": T.StringType(), "_f": T.ArrayType(fragment)}
    schema = T.StructType([T.StructField(c, nullable(kind)) for c, kind in kinds.items()])
    short = rows.where(F.col("_n") <= long).select("_key", "_t").mapInArrow(lambda it: _solved_batches(it, whole, True), schema)
    # Numbers are drawn once and stored, as rows may repeat and keys may be null.
    base = checkpointed(short.withColumn("_u", F.monotonically_increasing_id()))
    cut = base.select("_u", F.explode("_f").alias("_x")).select("_u", "_x.*")
    large = checkpointed(rows.where(F.col("_n") > long).select("_key", "_t", (-1 - F.monotonically_increasing_id()).alias("_u")))
    if not large.isEmpty():
        kept = large.select(F.struct("_key", "_u").alias("_key"), "_t").mapInArrow(lambda it: _solved_batches(it, whole, False), T.StructType([T.StructField("_key", nullable(T.StructType([T.StructField("_key", kinds["_key"]), T.StructField("_u", long_words)]))), *schema.fields[1:]]))
        base = base.unionByName(kept.select(F.col("_key._key").alias("_key"), *schema.names[1:], F.col("_key._u").alias("_u")))
        numbers = ", ".join(f"{c} long" for c in ("_u", "n", "lo", "hi", "first", "last", "offset"))
        parts = large.select("_u", "_t").mapInArrow(lambda it: _sections(it, section), f"{numbers}, ids binary").repartition("_u", "lo", "first")
        cut = cut.unionByName(parts.mapInArrow(_solved_sections, "_u long, period long, start long, end long"))
    runs = stitched(cut).groupBy("_u").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("_r"))
    runs = runs.select("_u", F.transform("_r", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"))).alias("runs"))
    none = F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>")
    out = base.drop("_f").join(runs, "_u", "left")
    return out.select("_key.*", "n_words", F.coalesce("runs", none).alias("runs"), _collapsed("_text", "runs").alias("collapsed"), F.col("_sha").alias("plain_sha256"))


def greatest(runs: Column) -> Column:
    """Of runs by start and period the first with the greatest exact length / period; null if there is none."""
    kind = "struct<start:bigint,length:bigint,period:bigint>"
    return F.aggregate(runs, F.lit(None).cast(kind), lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def planted(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth, by a hash of its id, repeats words from some place on. Null ids and texts stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))

    def repeated(ws: Column) -> Column:
        n, g = F.size(ws), F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(ws, lambda w, i: F.when(i >= a, F.get(ws, (a + (i - a) % p).cast("int"))).otherwise(w)), " ")

    chosen = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return docs.withColumn("text", F.when(chosen, let(words(F.col("text")), repeated)).otherwise(F.col("text")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = analysed(planted(table(spark, sf_dir, "documents").select("doc_id", "text")), whole=False)
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    digests = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), greatest(F.col("runs")).alias("_b"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"), F.coalesce(F.sha2("collapsed", 256), "plain_sha256").alias("collapsed_sha256"),
    )
    milli = F.expr("(1000 * _b.length) div _b.period").alias("exponent_milli")
    return digests.select("doc_id", "n_runs", "_b.start", "_b.length", "_b.period", milli, "runs_sha256", "collapsed_sha256")


SQL = {
    "op11_periodic_runs": r"""
WITH h AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS v,
         xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
           lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT)::BIGINT AS h
  FROM documents),
p AS (SELECT *, len(v) AS n, (h // 10) % greatest(len(v), 1) AS a, 1 + (len(v) - (h // 10) % greatest(len(v), 1)) // (3 + (h // 10) % 8) AS p FROM h),
d AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: v[(CASE WHEN i < a THEN i ELSE a + (i - a) % p END) + 1]) ELSE v END AS w FROM p),
m AS (SELECT doc_id, q, unnest(list_filter(range(n - q), lambda i: w[i + 1] = w[i + q + 1])) AS i FROM (SELECT doc_id, w, n, unnest(range(1, n // 4 + 1)) AS q FROM d WHERE n >= 6)),
g AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM m),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM g GROUP BY doc_id, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s GROUP BY doc_id, start, length),
x AS (SELECT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
z AS (SELECT doc_id, list(DISTINCT i) AS gone FROM x GROUP BY doc_id),
k AS (SELECT d.doc_id, CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(list_transform(list_filter(range(n), lambda i: NOT list_contains(gone, i)), lambda i: w[i + 1]), ' ') END AS kept FROM d LEFT JOIN z ON d.doc_id = z.doc_id),
t AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM r GROUP BY doc_id),
b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1)
SELECT k.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM k LEFT JOIN t ON k.doc_id = t.doc_id LEFT JOIN b ON k.doc_id = b.doc_id
"""
}
QUERIES = {"op11_periodic_runs": op11_periodic_runs}
