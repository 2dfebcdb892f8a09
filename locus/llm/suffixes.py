"""Suffix-array dedup: removes bytes of repeated strings of 100 bytes or more.

Sorting every suffix would shuffle some twenty bytes for each byte of text, so the suffix array is sampled by content:
in every 100-byte string the suffix that starts with the least hashed 48-byte gram is its anchor, and equal strings
have equal anchors. The strings that share an anchor in a row of places are a unit: a few dozen strings, one suffix.

1. Units go to ranges of leading bytes, cut by sampled splitters; each bucket sorts its suffixes by multikey quicksort.
   Of equal units all but the first are repeats as a whole. First units whose gram other units have too are open: some
   of their strings may be repeats. So are those whose leading bytes a boundary between buckets cuts.
2. The strings of open units are sorted in the same way, and each that is not the first of its equals is a repeat. This
   also compares across the boundaries of step 1. Leading bytes that many strings share are cut by digest.
3. Repeats return to their documents, whose covered bytes are removed.

Texts meet their marks in groups of bounded bytes, by a hash of the row; nothing is gathered by content alone. Equal
units or strings that meet in one task are reduced to the first before they are shuffled, so a passage that a third of
the corpus shares reaches its bucket a few times. Units are equal if 8 leading bytes, 32 bits of the gram's hash and a
digest agree, strings if 8 leading bytes and a digest do; carrying the strings themselves took too much disk. The digest
has 64 bits, and 128 for inputs beyond WIDE_BYTES: of n strings with the same leading bytes, n * n / 2**65 pairs are
expected to be taken for equal by 64 bits and n * n / 2**129 by 128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import nullable, table

LENGTH, GRAM = 100, 48
SLAB = 1 << 21
#: Units that a task holds before it passes them on, bytes of text in a bucket's share, and in a group of documents.
HELD, BUCKET_BYTES, GROUP_BYTES, MOST_SPLITTERS = 700_000, 12_000_000, 8_000_000, 4096
#: Bytes of text beyond which digests have 128 bits.
WIDE_BYTES = 1 << 36
_M = np.uint64(0x9E3779B97F4A7C15)
Docs = tuple[np.ndarray, np.ndarray, np.ndarray]


# arrays in binary columns


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; their bytes are laid out by significance, which packs numbers better."""
    head = np.array([len(a) for a in arrays], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays))


def unpack(payload: bytes, kinds: Sequence[type]) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    at, out = 8 * len(kinds), []
    for n, kind in zip(np.frombuffer(raw, np.int64, len(kinds)).tolist(), kinds, strict=True):
        size = np.dtype(kind).itemsize
        out.append(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T.copy().view(kind).ravel())
        at += n * size
    return out


def pack_rows(did: np.ndarray, rk: np.ndarray, *cols: np.ndarray) -> bytes:
    """pack() of rows of documents that come one after another: ids and row hashes once for each document."""
    new = np.flatnonzero(np.r_[True, (did[1:] != did[:-1]) | (rk[1:] != rk[:-1])])
    return pack(did[new], rk[new], np.diff(np.r_[new, len(did)]).astype(np.uint32), *cols)


def unpack_rows(payload: bytes, kinds: Sequence[type]) -> list[np.ndarray]:
    did, rk, n, *cols = unpack(payload, (np.int64, np.int64, np.uint32, *kinds))
    return [np.repeat(did, n), np.repeat(rk, n), *cols]


def bodies(column: pa.ChunkedArray | pa.Array) -> Docs:
    """All bytes of a binary column, and where each value starts and ends."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(a, pa.ChunkedArray):
        a = pa.concat_arrays(a.chunks)
    kind = np.int64 if pa.types.is_large_binary(a.type) else np.int32
    off = np.frombuffer(a.buffers()[1], kind)[a.offset : a.offset + len(a) + 1].astype(np.int64) if len(a) else np.zeros(1, np.int64)
    data = np.frombuffer(a.buffers()[2], np.uint8) if len(a) and a.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, off[:-1], off[1:]


# anchors and units


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """A mixed hash of the 48 bytes from every place, by doubling."""
    h = (b.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    of = {}
    for k in (1, 2, 4, 8, 16):
        of[2 * k] = h = h[:-k] * np.uint64(pow(int(_M), k, 1 << 64)) + h[k:]
    h = of[32][: len(b) - GRAM + 1] * np.uint64(pow(int(_M), 16, 1 << 64)) + of[16][32 : 32 + len(b) - GRAM + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def least(h: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost least hash in every window of `width`, by doubling."""
    v, at, k = h, np.arange(len(h), dtype=np.int32), 1
    while True:
        step = min(k, width - k)
        if not step:
            return at
        take = v[step:] < v[:-step]
        v, at = np.where(take, v[step:], v[:-step]), np.where(take, at[step:], at[:-step])
        k += step


def digests(b: np.ndarray, lo: np.ndarray, hi: np.ndarray, wide: bool) -> np.ndarray:
    """A row of one or two words for each stretch of bytes."""
    view = memoryview(b)
    if not wide:
        digest = xxhash.xxh3_64_intdigest
        return np.fromiter([digest(view[x:y]) for x, y in zip(lo.tolist(), hi.tolist(), strict=True)], np.uint64, len(lo)).reshape(-1, 1)
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(view[x:y]) for x, y in zip(lo.tolist(), hi.tolist(), strict=True)]), np.uint64).reshape(-1, 2)


def units(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, wide: bool = False) -> Iterator[tuple[np.ndarray, ...]]:
    """(document index, first string, past the last string's bytes, lead, gram hash, digests) of units, in slabs.

    A slab ends after SLAB bytes; it cuts units but loses no string.
    """
    if not len(starts):
        return
    for begin in range(int(starts[0]), int(ends[-1]), SLAB):
        stop = min(begin + SLAB, int(ends[-1]))  # string starts
        top = min(stop + LENGTH - 1, int(ends[-1]))
        if top - begin < LENGTH:
            continue
        n = top - begin - LENGTH + 1
        whole = np.zeros(n, bool)
        for i in range(int(np.searchsorted(ends, begin, "right")), int(np.searchsorted(starts, stop, "left"))):
            whole[max(0, int(starts[i]) - begin) : max(0, int(ends[i]) - LENGTH + 1 - begin)] = True
        s = np.flatnonzero(whole)
        if not len(s):
            continue
        b = data[begin:top]
        h = gram_hashes(b)
        at = least(h, LENGTH - GRAM + 1)[:n][s]
        new = np.flatnonzero(np.r_[True, (s[1:] != s[:-1] + 1) | (at[1:] != at[:-1])])
        lo, hi, anchor = s[new], s[np.r_[new[1:], len(s)] - 1] + LENGTH, at[new]
        dig = digests(b, lo, hi, wide)
        lead = np.lib.stride_tricks.sliding_window_view(b, 16)[anchor]
        doc = np.searchsorted(starts, lo + begin, "right") - 1
        yield doc, lo + begin - starts[doc], hi + begin - starts[doc], lead, (h[anchor] >> np.uint64(32)).astype(np.uint32), dig


def multikey(words: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort over columns of words: the order, and for each place whether it equals the one before.

    Rows are sorted by their first word; only rows that tie go on to the next word, inside their ties.
    """
    n = len(words[0])
    order = np.argsort(words[0], kind="stable")
    same = np.zeros(n, bool)
    same[1:] = words[0][order][1:] == words[0][order][:-1]
    for w in words[1:]:
        tied = same.copy()
        tied[:-1] |= same[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        run, rows = np.cumsum(~same)[at], order[at]
        order[at] = rows[np.lexsort((w[rows], run))]
        v = w[order[at]]
        equal = np.zeros(len(at), bool)
        equal[1:] = (v[1:] == v[:-1]) & (run[1:] == run[:-1])
        same[at] &= equal
    return order, same


def first_of_runs(same: np.ndarray) -> np.ndarray:
    """For each place the place where its run of equals began."""
    return np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))


def by_id(did: np.ndarray) -> np.ndarray:
    """Ids as unsigned words in the same order."""
    return did.view(np.uint64) ^ np.uint64(1 << 63)


# ranges of leading bytes


class Ranges:
    """Buckets of leading bytes: sampled splitters, and beyond MOST_SPLITTERS a hash within a range.

    For units a splitter is a lead and a document id, so that a lead of many units is cut between documents; such leads
    are `split`. For strings a lead that is several splitters is spread by digest over the ranges between them, so that
    equal strings still meet.
    """

    def __init__(self, keys: np.ndarray, strings: np.ndarray, buckets: int, wide: bool = False) -> None:
        n = min(buckets, MOST_SPLITTERS)
        quantiles = lambda a: np.sort(a)[(np.arange(1, n) * len(a)) // n] if len(a) else a
        self.cuts, self.leads = np.unique(quantiles(keys)), quantiles(strings)
        self.split = np.unique(self.cuts.astype("S16"))
        self.parts, self.wide = -(-buckets // n), wide

    def of_units(self, lead: np.ndarray, did: np.ndarray, gram: np.ndarray) -> np.ndarray:
        """The bucket of units; those with one gram share it unless their lead is split."""
        return np.searchsorted(self.cuts, keyed(lead, did), "right") * self.parts + gram.astype(np.int64) % self.parts

    def is_split(self, lead: np.ndarray) -> np.ndarray:
        lead = np.ascontiguousarray(lead).view("S16").ravel()
        return np.searchsorted(self.split, lead, "right") > np.searchsorted(self.split, lead, "left")

    def of_strings(self, lead: np.ndarray, digest: np.ndarray) -> np.ndarray:
        """The bucket of strings; equal strings share it."""
        lead = np.ascontiguousarray(lead).view("S16").ravel()
        first, last = np.searchsorted(self.leads, lead, "left"), np.searchsorted(self.leads, lead, "right")
        low, high = (digest & np.uint64(0xFFFFFFFF)).astype(np.int64), (digest >> np.uint64(32)).astype(np.int64)
        return (first + low % (last - first + 1)) * self.parts + high % self.parts


def keyed(lead: np.ndarray, did: np.ndarray) -> np.ndarray:
    return np.concatenate([lead, by_id(did).astype(">u8").view(np.uint8).reshape(-1, 8)], axis=1).copy().view("S24").ravel()


def word(lead: np.ndarray, k: int = 0) -> np.ndarray:
    """The k-th eight bytes as a word that sorts like them."""
    return np.ascontiguousarray(lead[:, 8 * k : 8 * k + 8]).view(">u8").ravel().astype(np.uint64)


def _split(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0])
    for a, b in zip(cut, [*cut[1:], len(order)], strict=True):
        yield int(bucket[order[a]]), order[a:b]


#: Marks: document id, row hash, first and past-the-last byte, 1 for an open unit and 0 for a repeat.
MARKS = (np.int64, np.int64, np.uint32, np.uint32, np.uint8)
#: Units: first string, bytes, 1 for a repeat that only passes through and 2 for a split lead, lead, gram hash; digests follow.
UNITS = (np.uint32, np.uint8, np.uint8, np.uint64, np.uint32)
#: Strings: place, lead; digests follow.
STRINGS = (np.uint32, np.uint64)


def _digest_kinds(wide: bool) -> tuple[type, ...]:
    return (np.uint64,) * (1 + wide)


def joined(did: np.ndarray, rk: np.ndarray, lo: np.ndarray, hi: np.ndarray, kind: np.ndarray) -> list[np.ndarray]:
    """Marks in order, repeats that touch or overlap in one row joined."""
    order = np.lexsort((lo, kind, rk, did))
    did, rk, lo, hi, kind = (c[order].astype(k) for c, k in zip((did, rk, lo, hi, kind), MARKS, strict=True))
    if not len(did):
        return [did, rk, lo, hi, kind]
    apart = np.r_[True, (did[1:] != did[:-1]) | (rk[1:] != rk[:-1]) | (kind[1:] != kind[:-1])]
    part = np.cumsum(apart) - 1
    span = int(hi.max()) + 1
    top = np.maximum.accumulate(hi + part * span) - part * span  # the largest end so far in the row
    new = apart | (kind == 1)
    new[1:] |= lo[1:] > top[:-1]
    begin = np.flatnonzero(new)
    return [did[begin], rk[begin], lo[begin], np.maximum.reduceat(hi, begin), kind[begin]]


def _marks(groups: int, cols: Sequence[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """Joined marks packed for each group of documents."""
    cols = joined(*cols)
    for group, rows in _split(np.mod(cols[1], groups)):
        yield group, pack(*(c[rows] for c in cols))


def _batch(rows: Iterator[tuple[int, bytes]], first: str) -> Iterator[pa.RecordBatch]:
    """Record batches of (number, payload) rows, each of bounded bytes."""
    a, p, size = [], [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(p, pa.binary())], names=[first, "payload"])

    for n, payload in rows:
        a.append(n)
        p.append(payload)
        size += len(payload)
        if size > 4_000_000:
            yield out()
            a, p, size = [], [], 0
    if a:
        yield out()


def _unit_chunks(held: list[list[np.ndarray]], ranges: Ranges) -> Iterator[tuple[int, bytes]]:
    """Chunks (bucket, payload) of the units that a task holds; repeats within the task are passed on as such."""
    did, rk, lo, hi, lead, gram, dig = (np.concatenate(x) for x in zip(*held, strict=True))
    first8 = word(lead)
    repeat = _repeats([first8, gram, *dig.T], did, lo)
    bucket = ranges.of_units(lead, did, gram)
    bucket[repeat] = np.mod(rk[repeat], len(ranges.cuts) + 1) * ranges.parts  # anywhere: they only pass through
    kind = np.where(repeat, 1, np.where(ranges.is_split(lead), 2, 0)).astype(np.uint8)
    first8[repeat], gram[repeat], dig[repeat] = 0, 0, 0
    for b, at in _split(bucket):
        yield b, pack_rows(did[at], rk[at], lo[at].astype(np.uint32), (hi[at] - lo[at]).astype(np.uint8), kind[at], first8[at], gram[at], *dig[at].T)


def unit_rows(docs: DataFrame, ranges) -> DataFrame:  # noqa: ANN001
    """(bucket, payload) of the units of docs (did, rk, t)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            did, rk = b["did"].to_numpy(zero_copy_only=False), b["rk"].to_numpy(zero_copy_only=False)
            for doc, lo, hi, lead, gram, dig in units(*bodies(b["t"]), ranges.value.wide):
                held.append([did[doc], rk[doc], lo, hi, lead, gram, dig])
                n += len(doc)
                if n > HELD:
                    yield from _batch(_unit_chunks(held, ranges.value), "bucket")
                    held, n = [], 0
        if held:
            yield from _batch(_unit_chunks(held, ranges.value), "bucket")

    return docs.select("did", "rk", "t").mapInArrow(run, "bucket int, payload binary")


def unit_marks(chunks: DataFrame, groups: int, wide: bool = False) -> DataFrame:
    """(pid, payload) of marks: repeated units, and open ones."""

    def run(t: pa.Table) -> pa.Table:
        did, rk, lo, n, kind, w, g, *d = (np.concatenate(x) for x in zip(*(unpack_rows(p.as_py(), UNITS + _digest_kinds(wide)) for p in t["payload"]), strict=True))
        passed = kind == 1
        through = [did[passed], rk[passed], lo[passed], lo[passed] + n[passed]]
        did, rk, lo, hi, kind, w, g, *d = (c[~passed] for c in (did, rk, lo, lo + n, kind, w, g, *d))
        order, _ = multikey([w, g, *d, by_id(did), lo])
        did, rk, lo, hi, kind, w, g, *d = (c[order] for c in (did, rk, lo, hi, kind, w, g, *d))
        grams = np.zeros(len(order), bool)
        grams[1:] = (w[1:] == w[:-1]) & (g[1:] == g[:-1])
        same = grams.copy()
        for c in d:
            same[1:] &= c[1:] == c[:-1]
        first = first_of_runs(same)
        repeat = (did != did[first]) | (lo != lo[first])
        run_of = np.cumsum(~grams) - 1
        several = np.bincount(run_of, ~same) > 1 if len(order) else np.zeros(0, bool)
        mark = repeat | several[run_of] | (kind == 2) if len(order) else repeat
        out = [np.concatenate([a, b[mark]]) for a, b in zip(through, (did, rk, lo, hi), strict=True)]
        opened = np.concatenate([np.zeros(passed.sum(), np.uint8), (~repeat[mark]).astype(np.uint8)])
        return _table(_marks(groups, [*out, opened]), "pid")

    return chunks.groupBy("bucket").applyInArrow(run, "pid int, payload binary")


def _table(rows: Iterator[tuple[int, bytes]], first: str) -> pa.Table:
    kept = list(rows)
    return pa.table({first: pa.array([a for a, _ in kept], pa.int32()), "payload": pa.array([p for _, p in kept], pa.binary())})


def _of_docs(marks: pa.Table, docs: pa.Table, kind: int) -> tuple[np.ndarray, ...]:
    """(row of docs, lo, hi) of the marks of a kind; repeated rows get the marks each."""
    parts = [unpack(p.as_py(), MARKS) for p in marks["payload"]]
    if not parts or not docs.num_rows:
        return (np.zeros(0, np.int64),) * 3
    did, rk, lo, hi, k = (np.concatenate(x) for x in zip(*parts, strict=True))
    did, rk, lo, hi = (c[k == kind] for c in (did, rk, lo, hi))
    own = np.rec.fromarrays([docs["rk"].to_numpy(), docs["did"].to_numpy()])
    order = np.argsort(own, kind="stable")
    mine = np.rec.fromarrays([rk, did])
    a, b = np.searchsorted(own[order], mine, "left"), np.searchsorted(own[order], mine, "right")
    n = b - a
    row = order[np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    return row, np.repeat(lo, n).astype(np.int64), np.repeat(hi, n).astype(np.int64)


def _repeats(content: Sequence[np.ndarray], did: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Whether each row is a repeat: not the first of those with equal content in order of ids and places."""
    order, _ = multikey([*content, by_id(did), lo])
    same = np.ones(len(order), bool)
    same[:1] = False
    for c in content:
        c = c[order]
        same[1:] &= c[1:] == c[:-1]
    first = order[first_of_runs(same)]
    out = np.zeros(len(order), bool)
    out[order] = (did[order] != did[first]) | (lo[order] != lo[first])
    return out


def string_rows(docs: DataFrame, marks: DataFrame, ranges) -> DataFrame:  # noqa: ANN001
    """(bucket, pid, payload): strings of open units for their bucket, or with a pid repeats found within a group."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row, lo, hi = _of_docs(right, left, 1)
        rows: list[tuple[int, int, bytes]] = []
        if len(row):
            data, starts, _ = bodies(left["t"])
            all_did, all_rk, pid = left["did"].to_numpy(), left["rk"].to_numpy(), left["pid"][0].as_py()
            n = hi - lo - LENGTH + 1
            cut = np.flatnonzero(np.r_[True, np.diff(np.cumsum(n) // 200_000) > 0])
            for a, b in zip(cut, [*cut[1:], len(n)], strict=True):
                m = n[a:b]
                owner = np.repeat(row[a:b], m)
                at = np.repeat(lo[a:b], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                spot = starts[owner] + at
                lead = np.lib.stride_tricks.sliding_window_view(data, 16)[spot]
                first8, dig = word(lead), digests(data, spot, spot + LENGTH, ranges.value.wide)
                did, rk = all_did[owner], all_rk[owner]
                repeat = _repeats([first8, *dig.T], did, at)
                r, k = np.flatnonzero(repeat), np.flatnonzero(~repeat)
                if len(r):
                    rows.append((pid, pid, pack(*joined(did[r], rk[r], at[r], at[r] + LENGTH, np.zeros(len(r))))))
                for bucket, x in _split(ranges.value.of_strings(lead[k], dig[k, 0])):
                    x = k[x]
                    rows.append((bucket, -1, pack_rows(did[x], rk[x], at[x].astype(np.uint32), first8[x], *dig[x].T)))
        return pa.table({"bucket": pa.array([x for x, _, _ in rows], pa.int32()), "pid": pa.array([x for _, x, _ in rows], pa.int32()), "payload": pa.array([x for _, _, x in rows], pa.binary())})

    return docs.groupBy("pid").cogroup(marks.groupBy("pid")).applyInArrow(run, "bucket int, pid int, payload binary")


def string_marks(rows: DataFrame, groups: int, wide: bool = False) -> DataFrame:
    """(pid, payload) of the repeats among strings that meet in a bucket, and those that pass through."""

    def run(t: pa.Table) -> pa.Table:
        out = [(pid, p) for pid, p in zip(t["pid"].to_pylist(), t["payload"].to_pylist(), strict=True) if pid >= 0]
        parts = [unpack_rows(p, STRINGS + _digest_kinds(wide)) for pid, p in zip(t["pid"].to_pylist(), t["payload"].to_pylist(), strict=True) if pid < 0]
        if parts:
            did, rk, lo, *content = (np.concatenate(x) for x in zip(*parts, strict=True))
            r = np.flatnonzero(_repeats(content, did, lo))
            out += _marks(groups, [did[r], rk[r], lo[r], lo[r] + LENGTH, np.zeros(len(r))])
        return _table(iter(out), "pid")

    return rows.groupBy("bucket").applyInArrow(run, "pid int, payload binary")


def cleaned(docs: DataFrame, marks: DataFrame, text: bool) -> DataFrame:
    """row, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the remaining text of every document."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row, lo, hi = _of_docs(right, left, 0)
        data, starts, ends = bodies(left["t"])
        order = np.lexsort((lo, row))
        row, lo, hi = row[order], lo[order], hi[order]
        at = np.searchsorted(row, np.arange(left.num_rows + 1))
        n_removed, n_spans, sha, kept_text = [], [], [], []
        for i in range(left.num_rows):
            body = data[starts[i] : ends[i]]
            removed = spans = 0
            if at[i] < at[i + 1]:
                keep = np.ones(len(body), bool)
                for x, y in zip(lo[at[i] : at[i + 1]].tolist(), hi[at[i] : at[i + 1]].tolist(), strict=True):
                    keep[x:y] = False
                removed = len(body) - int(keep.sum())
                spans = int((np.diff(np.r_[True, keep].astype(np.int8)) == -1).sum())
                body = body[keep]
            raw = body.tobytes()
            n_removed.append(removed)
            n_spans.append(spans)
            sha.append(hashlib.sha256(raw).hexdigest())
            kept_text.append(raw.decode("utf-8", "ignore") if text else None)
        cols = {"row": left["row"], "n_bytes": pa.array(ends - starts, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(sha, pa.string())}
        return pa.table(cols | ({"kept": pa.array(kept_text, pa.string())} if text else {}))

    numbers = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    schema = T.StructType([T.StructField("row", docs.schema["row"].dataType), *numbers, T.StructField("kept_sha256", T.StringType()), *([T.StructField("kept", T.StringType())] if text else [])])
    return docs.groupBy("pid").cogroup(marks.groupBy("pid")).applyInArrow(run, schema)


def sampled_ranges(docs: DataFrame, count: int, buckets: int, wide: bool = False) -> Ranges:
    """Splitters from the leads of about 1000 documents (64 units and 64 strings of each), drawn by a hash of the row."""
    share = min(1.0, max(1000, min(buckets, MOST_SPLITTERS) // 2) / max(1, count))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            did = b["did"].to_numpy(zero_copy_only=False)
            data, starts, ends = bodies(b["t"])
            for i in range(b.num_rows):
                found = [keyed(lead, did[doc + i]) for doc, _, _, lead, _, _ in units(data, starts[i : i + 1], ends[i : i + 1])]
                if found:
                    keys = np.concatenate(found)
                    places = np.arange(starts[i], ends[i] - LENGTH + 1)
                    strings = np.lib.stride_tricks.sliding_window_view(data, 16)[places[:: -(-len(places) // 64)]]
                    yield pa.RecordBatch.from_arrays([pa.array([keys[:: -(-len(keys) // 64)].tobytes()], pa.binary()), pa.array([strings.tobytes()], pa.binary())], names=["keys", "strings"])

    sample = docs.where(F.col("rk").bitwiseAND((1 << 30) - 1) < int(share * (1 << 30)) + 1)
    got = sample.select("did", "t").mapInArrow(run, "keys binary, strings binary").collect()
    return Ranges(np.frombuffer(b"".join(bytes(r.keys) for r in got), "S24"), np.frombuffer(b"".join(bytes(r.strings) for r in got), "S16"), buckets, wide)


def deduped(docs: DataFrame, row: Column, text: str = "text", key: str = "doc_id", with_text: bool = False, wide: bool | None = None) -> DataFrame:
    """`row` of every document with n_bytes, n_removed, n_spans, kept_sha256 (and kept, the remaining text).

    Null texts are empty and lose nothing; texts under 100 bytes hold no string. A null id comes after all others.
    Rows with equal ids are one document to the order of ids: a string at the same place of the same id is not
    earlier. Repeated rows get equal results. A removal may cut a multi-byte character: kept_sha256 is of the bytes,
    while the text leaves broken characters out. Very long texts are cut in slabs that lose no string; an empty table
    gives an empty result. Only text, key and `row` are read, so other names cannot clash. `wide` digests have 128
    bits; the default goes by the bytes of text.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    did = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit((1 << 63) - 1))
    rows = docs.select(did.alias("did"), F.xxhash64(did, body).alias("rk"), body.cast("binary").alias("t"), row.alias("row"))
    rows = rows.withColumn("row", F.col("row").cast(nullable(rows.schema["row"].dataType)))
    size = rows.agg(F.sum(F.octet_length("t")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    total = size.b or 0
    buckets, groups = max(64, total // BUCKET_BYTES), max(128, total // GROUP_BYTES)
    wide = total > WIDE_BYTES if wide is None else wide
    ranges = spark.sparkContext.broadcast(sampled_ranges(rows, size.n, buckets, wide))
    grouped = rows.select(F.pmod("rk", F.lit(groups)).cast("int").alias("pid"), "did", "rk", "t", "row")
    marks = unit_marks(unit_rows(rows, ranges), groups, wide)
    more = string_marks(string_rows(grouped, marks, ranges), groups, wide)
    return cleaned(grouped, marks.unionByName(more), with_text)


def without_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", n_chars: str | None = "n_chars") -> DataFrame:
    """docs with repeated strings cut out of the text; its length column, if there is one, follows."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    out = deduped(docs, row, text, key, with_text=True)
    cols = {c: F.col(f"row.`{c}`") for c in docs.columns}
    cols[text] = F.when(F.col(f"row.`{text}`").isNotNull(), F.col("kept"))
    if n_chars in cols:
        cols[n_chars] = F.when(F.col("n_removed") > 0, F.length("kept").cast(docs.schema[n_chars].dataType)).otherwise(cols[n_chars])
    return out.select(*[v.alias(k) for k, v in cols.items()])


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduped(table(spark, sf_dir, "documents"), F.col("doc_id"))
    return out.select(F.col("row").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES = {"op10_suffixes": op10_suffixes}
#: Every 100-byte string by its place, on hexadecimal text.
SQL = {
    "op10_suffixes": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
p AS (SELECT doc_id, h, unnest(range(n - 99)) AS i FROM d WHERE n >= 100),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS k FROM p),
f AS (SELECT k, min(doc_id * 1000000000 + i) AS first FROM w GROUP BY k),
r AS (SELECT w.doc_id, w.i, lag(w.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) AS before FROM w JOIN f ON w.k = f.k WHERE f.first <> w.doc_id * 1000000000 + w.i),
g AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
s AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS z FROM g GROUP BY doc_id, run),
c AS (SELECT s.doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY s.doc_id ORDER BY a), 0) AS b FROM s),
k AS (SELECT c.doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * b + 1, 2 * (a - b)), '' ORDER BY a) || substr(any_value(h), 2 * max(z) + 1) AS kept FROM c JOIN d ON c.doc_id = d.doc_id GROUP BY c.doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
}
