"""Reading a SentencePiece BPE model: pieces, character map, normalisation with alignment, merging.

The model file is a protocol buffer; only the fields that encoding needs are read.
"""

from __future__ import annotations

import heapq
import math
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise
from typing import Any

SPACE = "▁"
#: Characters up to which a stretch is merged by scans rather than with a heap.
SHORT = 64
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        c = b[i]
        i += 1
        value |= (c & 127) << shift
        shift += 7
        if c < 128:
            return value, i


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The (field number, value) pairs of a protocol buffer message."""
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(b, i)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, i = _varint(b, i)
            value, i = b[i : i + size], i + size
        yield key >> 3, value


class CharMap:
    """The compiled character map: a double-array trie of byte strings and a pool of zero-ended replacements.

    Units are 32-bit words: bit 8 says that a value follows, bits 10 and up with the shift in bit 9 give the offset
    to the children, the low byte and the top bit are the label that a child must carry.
    """

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.pool = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """The length of the longest prefix at `at` that the map has, and its replacement."""
        if not self.units:
            return None
        step = lambda unit: (unit >> 10) << ((unit & 512) >> 6)
        node, found = step(self.units[0]), None
        for k in range(at, len(text)):
            node ^= text[k]
            if node >= len(self.units) or self.units[node] & 0x800000FF != text[k]:
                break
            has, node = self.units[node] & 256, node ^ step(self.units[node])
            if has:
                value = self.units[node] & 0x7FFFFFFF
                found = k + 1 - at, self.pool[value : self.pool.index(b"\0", value)]
        return found


class PieceModel:
    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            blob = f.read()
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        charmap, self.dummy_prefix, self.strip, self.escape = b"", True, True, True
        model_type = 1
        for number, value in _fields(blob):
            if number == 1:
                d = dict(_fields(value))
                self.pieces.append(d[1].decode())
                scores.append(struct.unpack("<f", d[2])[0] if 2 in d else 0.0)
                self.kinds.append(d.get(3, NORMAL))
            elif number == 2:
                model_type = dict(_fields(value)).get(3, 1)
            elif number == 3:
                d = dict(_fields(value))
                charmap = d.get(2, b"")
                self.dummy_prefix, self.strip, self.escape = (bool(d.get(k, 1)) for k in (3, 4, 5))
        if model_type != 2 or USER_DEFINED in self.kinds or UNUSED in self.kinds:
            raise ValueError("only BPE models without user-defined or unused pieces are read")
        self.charmap = CharMap(charmap)
        self.id_of = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == NORMAL}
        self.order = {p: -scores[i] for p, i in self.id_of.items()}
        self.byte_id = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        self.unknown = self.kinds.index(UNKNOWN)
        self.end = self.pieces.index("</s>")
        self.controls = [i for i, k in enumerate(self.kinds) if k == CONTROL]
        #: Normalising only marks spaces and adds the prefix mark.
        self.plain = not self.charmap.units and not self.strip and self.dummy_prefix and self.escape
        # Where no piece holds a character before a space mark, or a line feed beside anything, merging cannot cross,
        # so a text is merged in independent stretches.
        cut_spaces = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id_of)
        lone = "".join(re.escape(c) for c in "\n\t\r" if not any(c in p and len(p) > 1 for p in self.id_of))
        self.stretch = re.compile((f"{SPACE}*[^{SPACE}{lone}]+|{SPACE}+" + (f"|[{lone}]" if lone else "")) if cut_spaces else "(?s).+")
        self.surface = [b"" if k in (CONTROL,) else b" \xe2\x81\x87 " if k == UNKNOWN else bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode() for p, k in zip(self.pieces, self.kinds, strict=True)]

    # normalisation

    def normalised(self, text: str) -> str:
        return self.aligned(text)[0] if self.charmap.units or self.strip else (SPACE if self.escape else " ") * (self.dummy_prefix and text != "") + (text.replace(" ", SPACE) if self.escape else text)

    def aligned(self, text: str) -> tuple[str, list[int]]:
        """The normalised text and, for each of its UTF-8 bytes and its end, the byte of the source it came from.

        At each place the longest prefix in the character map is replaced; without one the character stays. Bytes
        of a replacement point at the start of what they replace; the prefix mark points at the first byte.
        """
        source, out, to = text.encode(), bytearray(), []
        mark = SPACE.encode() if self.escape else b" "

        def add(b: bytes, at: int) -> None:
            out.extend(b)
            to.extend([at] * len(b))

        i = 0
        parts: list[tuple[bytes, int]] = []
        while i < len(source):
            n, b = self.charmap.longest(source, i) or (0, b"")
            if not n:
                n = 1 + (source[i] >= 0xC0) + (source[i] >= 0xE0) + (source[i] >= 0xF0)
                b = source[i : i + n]
            parts.append((b, i))
            i += n
        if self.strip:
            while parts and not parts[0][0].strip(b" "):
                parts.pop(0)
        if parts and self.dummy_prefix:
            add(mark, parts[0][1])
        blank = self.strip
        for b, at in parts:
            if self.strip and blank:
                b = b.lstrip(b" ")
            if self.strip:
                b = re.sub(rb" +", b" ", b)
            if b:
                blank = b.endswith(b" ")
                add(b.replace(b" ", mark), at)
        end = len(source)
        while self.strip and out.endswith(mark):
            end = to[-len(mark)]
            del out[-len(mark) :], to[-len(mark) :]
        return out.decode(), [*to, end]

    # merging

    def merged(self, stretch: str) -> list[str]:
        """The symbols left when no two neighbours make a piece: always the best-scored pair, leftmost on ties."""
        return self._scanned(stretch) if len(stretch) <= SHORT else self._heaped(stretch)

    def _scanned(self, stretch: str) -> list[str]:
        """merged() for a word: the orders of all pairs are looked through for each merge, which few symbols do fastest."""
        order, never = self.order.get, math.inf
        symbols = [*stretch]
        orders = [order(a + b, never) for a, b in pairwise(symbols)]
        while orders and (low := min(orders)) != never:
            i = orders.index(low)
            symbols[i : i + 2] = (both := symbols[i] + symbols[i + 1],)
            del orders[i]
            if i < len(orders):
                orders[i] = order(both + symbols[i + 1], never)
            if i:
                orders[i - 1] = order(symbols[i - 1] + both, never)
        return symbols

    def _heaped(self, stretch: str) -> list[str]:
        """merged() for any length, in n log n.

        Symbols are a doubly linked list over their first characters; candidate pairs wait in a heap, and a pair
        whose symbols have changed since is skipped when it comes up.
        """
        order, n = self.order, len(stretch)
        symbols: list[str | None] = list(stretch)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(o, i, 2) for i in range(n - 1) if (o := order.get(stretch[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            left = symbols[i]
            j = after[i]
            if left is None or j < 0 or len(left) + len(symbols[j]) != size:
                continue
            symbols[i] = both = left + symbols[j]
            symbols[j] = None
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (o := order.get(both + symbols[k])) is not None:
                    heapq.heappush(heap, (o, i, len(both) + len(symbols[k])))
            h = before[i]
            if h >= 0 and (o := order.get(symbols[h] + both)) is not None:
                heapq.heappush(heap, (o, h, len(symbols[h]) + len(both)))
        return [s for s in symbols if s is not None]

    def n_merges(self, stretch: str) -> int:
        """How many merges merged() makes, by the same heap and list without keeping symbols or ids.

        Symbols are spans of the stretch: `end` of a live symbol is past its last character, 0 when merged away.
        """
        order, n, done = self.order, len(stretch), 0
        heap = [(o, i, i + 2) for i in range(n - 1) if (o := order.get(stretch[i : i + 2])) is not None]
        if not heap:
            return 0
        heapq.heapify(heap)
        end, start_of = [*range(1, n + 1)], [*range(n)]  # start_of[last character] = first character of its symbol
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            _, i, e = pop(heap)
            j = end[i]
            if not j or j >= e or end[j] != e:
                continue
            done += 1
            end[i], end[j] = e, 0
            start_of[e - 1] = i
            if e < n and (o := order.get(stretch[i : (t := end[e])])) is not None:
                push(heap, (o, i, t))
            if i and (o := order.get(stretch[(h := start_of[i - 1]) : e])) is not None:
                push(heap, (o, h, e))
        return done

    def stretch_ids(self, stretch: str) -> list[int]:
        return self.stretch_pieces(self.merged(stretch) if len(stretch) > 1 else [stretch])[0]

    def stretch_pieces(self, symbols: list[str]) -> tuple[list[int], list[int]]:
        """ids of merged symbols, and the bytes of each: of the source for a plain model, else of the normalised text.

        A space mark of a plain model stands for one space. Of the byte pieces of a character the last has its bytes.
        """
        ids: list[int] = []
        sizes: list[int] = []
        plain = self.plain
        for s in symbols:
            size = len(s) if s.isascii() else len(s.encode()) - (2 * s.count(SPACE) if plain else 0)
            if (i := self.id_of.get(s)) is not None:
                ids.append(i)
                sizes.append(size)
            elif self.byte_id:
                raw = s.encode()
                ids += [self.byte_id[b] for b in raw]
                sizes += [0] * (len(raw) - 1) + [size] if plain else [1] * len(raw)
            else:
                ids.append(self.unknown)
                sizes.append(size)
        return ids, sizes

    def sizes(self, stretch: str) -> list[int]:
        """The bytes of the normalised text that each id of the stretch stands for, a byte piece its own."""
        out: list[int] = []
        for s in self.merged(stretch) if len(stretch) > 1 else [stretch]:
            n = len(s.encode())
            out += [1] * n if s not in self.id_of and self.byte_id else [n]
        return out

    def initial(self, stretch: str) -> int:
        """Symbols before merging: characters, those outside the vocabulary as their bytes."""
        if not self.byte_id:
            return len(stretch)
        known = self.id_of
        return sum(1 if c in known else len(c.encode()) for c in stretch)

    # decoding

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: marks become spaces, the prefix mark goes, byte pieces that are no UTF-8 become U+FFFD."""
        surface, kinds = self.surface, self.kinds
        inside = sum(map(ids.count, self.controls)) - (bool(ids) and kinds[ids[-1]] == CONTROL)
        if inside:  # a control id ends a run of byte pieces
            at = next(n for n, i in enumerate(ids) if kinds[i] == CONTROL)
            rest = self._plain(ids[at + 1 :]) if any(kinds[i] != CONTROL for i in ids[:at]) else self.decode(ids[at + 1 :])
            return self.decode(ids[:at]) + rest
        raw = b"".join(map(surface.__getitem__, ids))
        if self.dummy_prefix or self.strip:
            first = next((i for i in ids if kinds[i] != CONTROL), None)
            if first is not None and kinds[first] == NORMAL and raw[:1] == b" ":
                raw = raw[1:]
        return _text(raw)

    def _plain(self, ids: list[int]) -> str:
        """decode() of ids that are not the first."""
        runs: list[list[int]] = [[]]
        for i in ids:
            if self.kinds[i] == CONTROL:
                runs.append([])
            else:
                runs[-1].append(i)
        return "".join(_text(b"".join(map(self.surface.__getitem__, r))) for r in runs)


class Remembered:
    """Values of a text's stretches, each computed once while it is remembered.

    Where the model merges nothing across a space or a line feed, words between single spaces are looked up as they
    are: `inner` has them behind a space mark, `edge` at the start of a line. Other texts are cut by the model's
    pattern. All is forgotten when `most` stretches are known or they hold MOST_CHARS characters, so memory stays
    bounded for long words too.
    """

    MOST_CHARS = 8_000_000

    def __init__(self, model: PieceModel, value: Callable[[str], Any], nothing: Any, most: int) -> None:  # noqa: ANN401
        self.model, self.value, self.most, self.nothing = model, value, most, nothing
        self.chars = 0
        self.whole: dict[str, Any] = {}
        self.inner: dict[str, Any] = {}
        self.edge: dict[str, Any] = {"": nothing}
        self.words = model.plain and model.stretch.findall(f"a{SPACE}b\nc") == ["a", f"{SPACE}b", "\n", "c"]
        self.feed = value("\n") if self.words else nothing

    def _look(self, known: dict[str, Any], keys: list[str], prefix: str) -> list[Any]:
        try:
            return list(map(known.__getitem__, keys))
        except KeyError:
            fresh = [k for k in {*keys} if k not in known]
            more = sum(map(len, fresh))
            if len(known) + len(fresh) > self.most or self.chars + more > self.MOST_CHARS:
                for d in (self.whole, self.inner, self.edge):
                    d.clear()
                self.edge[""], self.chars = self.nothing, 0
                fresh = [*{*keys}]
                more = sum(map(len, fresh))
            self.chars += more
            for k in fresh:
                known[k] = self.value(prefix + k)
            return list(map(known.__getitem__, keys))

    def cut(self, norm: str) -> list[Any]:
        """Values of the stretches of a normalised text."""
        return self._look(self.whole, self.model.stretch.findall(norm), "")

    def values(self, text: str) -> list[Any]:
        if not text:
            return []
        if not self.words or "  " in text or SPACE in text or text[0] == " ":
            return self.cut(self.model.normalised(text))
        out: list[Any] = []
        first, *lines = text.split("\n")
        out += self._look(self.inner, first.split(" "), SPACE)
        for line in lines:
            start, *rest = line.split(" ")
            out.append(self.feed)
            out += self._look(self.edge, [start], "")
            if rest:
                out += self._look(self.inner, rest, SPACE)
        return out


def _text(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return "".join(c if c is not None else "\ufffd" for c in _each(raw))


def _each(raw: bytes) -> Iterator[str | None]:
    """Characters of the bytes, None for each byte that begins no valid one."""
    i = 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                c = raw[i : i + n].decode()
            except UnicodeDecodeError:
                continue
            if c:
                yield c
                i += n
                break
        else:
            yield None
            i += 1


@lru_cache(maxsize=4)
def loaded(path: str) -> PieceModel:
    """The model, read once in each Python worker."""
    return PieceModel(path)
