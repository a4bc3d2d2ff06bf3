"""Secret scans over nested encodings.

A text is the first layer. A worklist takes a layer, scans it for secrets, and puts back what each decoder
makes of it: URL escapes, Unicode escapes, and base64; the bytes of each may be compressed, several times and
in several members. Segments near each other are replaced together, and the new layer is only the part around
them, `CONTEXT` code points on either side and on to the end of a run of value characters, not a copy of the
text. A layer already seen is not taken again, and the work stops when no decoder finds anything new. Each
layer carries, for every code point, the span of the original text it came from; spans of secrets found deeper
are mapped back with it. A secret that holds compressed characters gets the whole encoded segment.

A base64 run that is UTF-8 as a whole is replaced like the others. Any run is also read at its other
alignments, from compressed data inside it, and joined over line ends, each reading in a layer of its own in
which only decoded characters are decoded on; so a prefix like `cookie_` or `cb/` hides nothing. Bytes that
are not UTF-8 stay as single characters that no pattern matches.

Decoding only shortens a text; inflating does not. One segment may inflate to `max_decoded` bytes, those of a
document to `INFLATED` times as many. A segment beyond that is left alone while all others are read; the
document is reported with `complete` false, and `mask` replaces the unread segment as a whole. Nulls and empty
texts have no spans. Texts without an escape or base64 segment have one layer.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluiceway.llm.common import Texts, map_arrow, map_texts, slices

#: Fixed values of the contract: kinds in their order, patterns, least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Runs of 24 or more are the only ones the contract keeps; looking for them alone gives the same spans.
_LONG_HEX = re.compile(rf"[0-9a-f]{{{LEAST['hex']},}}")
_LONG_ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{LEAST['access'] - 4},}}")

#: Escapes and the least length of a base64 segment.
URL_ESCAPES = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_ESCAPES = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+")
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")
_ONE_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]+)\}|\\[uUx]([0-9A-Fa-f]+)|&#([0-9]+);|&#[xX]([0-9A-Fa-f]+);")

#: Runs of base64 over line ends (also written as \\n), and the starts of compressed data inside decoded or escaped bytes.
_LINE_END = r"[ \t]*+(?:\r?\n|(?:\\r)?\\n)[ \t]*+"
WRAPPED_RUN = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{12,}}+(?:{_LINE_END}[A-Za-z0-9+/_-]++)++={{0,2}}")
_LINE_ENDS = re.compile(_LINE_END)
_PACKED = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|\xfd7zXZ\x00|x[\x01\x5e\x9c\xda]")
URL_PACKED = re.compile(r"(?:%1[Ff]%8[Bb]%08|BZh[1-9]1AY%26SY|%[Ff][Dd]7zXZ%00|x%(?:01|5[Ee]|9[Cc]|[Dd][Aa]))(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~/!*'()-])*")
_ASCII = re.compile(rb"[\x09\x0a\x0d\x20-\x7e]{8,}")

#: Bytes that one segment may inflate to, and how many times as many those of a document.
MAX_DECODED = 64 << 20
INFLATED = 16
#: Code points around decoded segments that are scanned with them.
CONTEXT = 512
_VALUE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")

Span = tuple[int, int, int]  # start, number of the kind, end
#: A replaced segment: start, end, its new text, and for each new code point its start and end in the segment (None: the whole).
Segment = tuple[int, int, str, np.ndarray | None, np.ndarray | None]


class TooLarge(Exception):
    """A segment inflates beyond its bound."""


class Room:
    """What a document's segments may still inflate to."""

    def __init__(self, one: int):
        self.one, self.left = one, one * INFLATED

    def inflate(self, data: bytes) -> tuple[bytes | None, bool]:
        """The content of data compressed once or more (None if it is not compressed), and whether it was read to the end."""
        plain, seen = None, {data}
        try:
            while (more := _inflate(data, min(self.one, self.left))) and more not in seen:
                plain = data = more
                self.left -= len(more)
                seen.add(more)
        except TooLarge:  # what the next ones are tried with falls, so that bombs together cost little more than one
            self.one = max(self.one // 2, min(self.one, 1 << 20))
            return plain, False
        return plain, True


def scan(text: str) -> list[Span]:
    """Spans of the base patterns, leftmost and non-overlapping for each kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [(m.start(), 1, m.end()) for m in _LONG_ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(found)


def _text_of(data: bytes) -> str:
    """Bytes as UTF-8; what is not UTF-8 becomes one lone surrogate a byte."""
    return data.decode("utf-8", "surrogateescape")


def _is_text(data: bytes) -> bool:
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def _utf8_segment(start: int, end: int, data: bytes, at: np.ndarray, to: np.ndarray) -> Segment:
    """A segment of bytes at known places."""
    text = _text_of(data)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    lengths[(points >= 0xDC80) & (points <= 0xDCFF)] = 1
    first = np.cumsum(lengths) - lengths
    return start, end, text, at[first], to[first + lengths - 1]


def _meet(one: tuple[int, int], other: tuple[int, int]) -> bool:
    return one[0] < other[1] and other[0] < one[1]


def url_segments(text: str, room: Room, within: tuple[int, int]) -> tuple[list[Segment], list[tuple[int, int]]]:
    """Runs of %XX, also with the plain characters between them if they hold compressed data; and what is unread."""
    found, unread, last = [], [], 0
    if "%" not in text:
        return found, unread
    for m in URL_PACKED.finditer(text):
        if not _meet(m.span(), within):
            continue
        plain, whole = room.inflate(unquote_to_bytes(m[0]))
        if not whole:
            unread.append(m.span())
        if plain is not None:
            found.append((*m.span(), _text_of(plain), None, None))
    taken, found, k = found, [], 0
    for m in URL_ESCAPES.finditer(text):
        if not _meet(m.span(), within):
            continue
        while k < len(taken) and taken[k][0] <= m.start():
            found.append(taken[k])
            last, k = taken[k][1], k + 1
        if m.start() < last or (k < len(taken) and taken[k][0] < m.end()):
            continue
        data = bytes.fromhex(m[0].replace("%", ""))
        places = np.arange(0, len(m[0]), 3)
        found.append(_utf8_segment(m.start(), m.end(), data, places, places + 3))
    return found + taken[k:], unread


def unicode_segments(text: str, room: Room, within: tuple[int, int]) -> tuple[list[Segment], list[tuple[int, int]]]:
    r"""Runs of \uXXXX, \u{X}, \UXXXXXXXX, \xXX and numeric character references; surrogate pairs are joined."""
    found, unread = [], []
    for m in UNICODE_ESCAPES.finditer(text):
        if not _meet(m.span(), within):
            continue
        points, at, to = [], [], []
        for one in _ONE_ESCAPE.finditer(m[0]):
            point = int(one[3]) if one[3] else int(one[1] or one[2] or one[4], 16)
            if points and 0xDC00 <= point < 0xE000 and 0xD800 <= points[-1] < 0xDC00:
                points[-1] = 0x10000 + ((points[-1] - 0xD800) << 10) + point - 0xDC00
                to[-1] = one.end()
                continue
            points.append(point)
            at.append(one.start())
            to.append(one.end())
        if max(points) < 256:
            plain, whole = room.inflate(bytes(points))
            if not whole:
                unread.append(m.span())
            if plain is not None:
                found.append((*m.span(), _text_of(plain), None, None))
                continue
        points = [p if p < 0x110000 and not 0xD800 <= p < 0xE000 else 0xFFFD for p in points]
        found.append((m.start(), m.end(), "".join(map(chr, points)), np.asarray(at, dtype=np.int64), np.asarray(to, dtype=np.int64)))
    return found, unread


def _inflate(data: bytes, room: int) -> bytes | None:
    """The content of gzip, zlib, bzip2 or xz data, all members; None if it is none of them or broken."""
    out = b""
    while True:
        if data[:2] == b"\x1f\x8b" or (len(data) > 2 and data[0] & 15 == 8 and (data[0] << 8 | data[1]) % 31 == 0):
            opened = zlib.decompressobj(wbits=47)
        elif data[:3] == b"BZh":
            opened = bz2.BZ2Decompressor()
        elif data[:6] == b"\xfd7zXZ\x00":
            opened = lzma.LZMADecompressor(memlimit=256 << 20)
        else:
            return out or None
        try:
            out += opened.decompress(data, room + 1 - len(out))
        except (zlib.error, OSError, lzma.LZMAError, EOFError) as e:
            if "emory usage limit" in str(e):
                raise TooLarge from e
            return out or None
        if len(out) > room:
            raise TooLarge
        if not opened.eof or not opened.unused_data:
            return out or None
        data = opened.unused_data


def _base64_bytes(body: str) -> bytes:
    """The bytes of a run in either alphabet; a last single character holds none."""
    body = body.rstrip("=").replace("-", "+").replace("_", "/")
    body = body[: len(body) - (len(body) % 4 == 1)]
    return binascii.a2b_base64(body + "=" * (-len(body) % 4))


def base64_segments(text: str, room: Room, within: tuple[int, int], focus: tuple[int, int]) -> tuple[list[Segment], list[Segment], list[tuple[int, int]]]:
    """Runs of base64 that are UTF-8 text, possibly compressed; other readings of runs that touch the focus; what is unread."""
    found, others, unread = [], [], []

    def read(chars: str, places: np.ndarray, whole_run: bool) -> None:
        end = int(places[-1]) + 1
        for shift in range(4):
            data = _base64_bytes(chars[shift:])
            if not data:
                continue
            main = whole_run and shift == 0
            if not main and not _meet((int(places[0]), end), focus):
                continue
            starts = [0] if shift == 0 else []
            starts += [x.start() for x in _PACKED.finditer(data) if x.start() % 3 == 0 and (x.start() or shift)]
            used = False
            for first in starts:
                plain, whole = room.inflate(data[first:])
                begin = int(places[shift + first // 3 * 4])
                if not whole:
                    unread.append((begin, end))
                if plain is not None:
                    used |= first == 0
                    (found if main and first == 0 and len(plain) < 1 << 16 else others).append((begin, end, _text_of(plain), None, None))
            if used:
                continue
            joint = main and len(chars.rstrip("=")) % 4 != 1 and _is_text(data)
            if not joint and not _ASCII.search(data):
                continue
            n = np.arange(len(data))
            begin = int(places[shift])
            at = places[shift + n // 3 * 4 + n % 3] - begin
            to = places[np.minimum(shift + n // 3 * 4 + n % 3 + 1, len(places) - 1)] + 1 - begin
            to[-1] = end - begin
            (found if joint else others).append(_utf8_segment(begin, end, data, at, to))

    for m in BASE64_RUN.finditer(text):
        if _meet(m.span(), within):
            read(m[0], np.arange(m.start(), m.end()), True)
    for m in WRAPPED_RUN.finditer(text):
        if _meet(m.span(), focus):
            gaps = np.ones(len(m[0]), dtype=bool)
            for gap in _LINE_ENDS.finditer(m[0]):
                gaps[gap.start() : gap.end()] = False
            read(_LINE_ENDS.sub("", m[0]), m.start() + np.flatnonzero(gaps), False)
    return found, others, unread


def _replace(text: str, starts: np.ndarray, ends: np.ndarray, segments: list[Segment], low: int, high: int) -> tuple[str, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """text[low:high] with segments replaced, the original span of each of its code points, and where the new ones are."""
    parts, s, e, new_at, last, size = [], [], [], [], low, 0
    for begin, end, new, at, to in segments:
        parts += [text[last:begin], new]
        s += [starts[last:begin], np.full(len(new), starts[begin], starts.dtype) if at is None else starts[begin + at]]
        e += [ends[last:begin], np.full(len(new), ends[end - 1], ends.dtype) if to is None else ends[begin + to - 1]]
        new_at.append((size + begin - last, size + begin - last + len(new)))
        size = new_at[-1][1]
        last = end
    return "".join([*parts, text[last:high]]), np.concatenate([*s, starts[last:high]]), np.concatenate([*e, ends[last:high]]), new_at


def _may_hold_segments(text: str) -> bool:
    return "%" in text or "\\" in text or "&#" in text or BASE64_RUN.search(text) is not None


def _surroundings(text: str, begin: int, end: int) -> tuple[int, int]:
    """Where the part to scan with text[begin:end] begins and ends: no run of spaces or value characters is cut."""
    low, high = max(begin - CONTEXT, 0), min(end + CONTEXT, len(text))
    for some in (" ", _VALUE):
        while low > 0 and text[low - 1] in some:
            low -= 1
    for some in (" ", _VALUE):
        while high < len(text) and text[high] in some:
            high += 1
    return low, high


def _groups(segments: list[Segment]) -> Iterator[list[Segment]]:
    """Segments so near each other that their surroundings meet."""
    group: list[Segment] = []
    for x in segments:
        if group and x[0] - group[-1][1] > 2 * CONTEXT:
            yield group
            group = []
        group.append(x)
    if group:
        yield group


def _touching(spans: list[Span], new_at: list[tuple[int, int]]) -> Iterator[Span]:
    """The spans that touch new code points; others were found in the layer before."""
    lows = [low for low, _ in new_at]
    for span in spans:
        k = bisect_right(lows, span[2]) - 1
        if k >= 0 and new_at[k][1] >= span[0]:
            yield span


def _scan_layers(text: str | None, max_decoded: int) -> tuple[list[Span], list[Span], int, list[tuple[int, int]]]:
    """Base spans, all spans (both sorted), the number of layers, and the places of segments that were not read."""
    text = text or ""
    base = scan(text)
    if not _may_hold_segments(text):
        return base, base, 1, []
    every, unread, room = set(base), set(), Room(max_decoded)
    seen = {(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest(), 0, len(text))}
    place = np.arange(len(text), dtype=np.int32)

    def below(layer: str, starts: np.ndarray, ends: np.ndarray, within: tuple[int, int], focus: tuple[int, int]) -> Iterator[tuple]:
        """The layers made of one: by each decoder, from segments that meet `within`; other readings, from runs that meet `focus`."""

        def one(group: list[Segment], other: bool) -> Iterator[tuple]:
            low, high = _surroundings(layer, group[0][0], group[-1][1])
            new, s, e, new_at = _replace(layer, starts, ends, group, low, high)
            mark = (hashlib.sha256(new.encode("utf-8", "surrogatepass")).digest(), int(s[0]), int(e[-1]))
            if mark in seen:
                return
            seen.add(mark)
            every.update((int(s[a]), kind, int(e[b - 1])) for a, kind, b in _touching(scan(new), new_at))
            hull = (new_at[0][0], new_at[-1][1])
            grown = len(new) - (high - low)
            kept = (max(min(within[0], group[0][0]) - low, 0), min(max(within[1], group[-1][1]), high) - low + grown)
            yield new, s, e, hull if other else kept, hull

        def lost(places: list[tuple[int, int]]) -> None:
            unread.update((int(starts[a]), int(ends[b - 1])) for a, b in places)

        for decode in (url_segments, unicode_segments):
            found, rest = decode(layer, room, within)
            lost(rest)
            for group in _groups(found):
                yield from one(group, False)
        found, others, rest = base64_segments(layer, room, within, focus)
        lost(rest)
        for group in _groups(found):
            yield from one(group, False)
        for x in others:
            yield from one([x], True)

    whole = (0, len(text))
    work = [below(text, place, place + 1, whole, whole)]
    while work:
        if (layer := next(work[-1], None)) is None:
            work.pop()
        else:
            work.append(below(*layer))
    return base, sorted(every), len(seen), sorted(unread)


def scan_nested(text: str | None, max_decoded: int = MAX_DECODED) -> tuple[list[Span], list[Span], int, bool]:
    """Base spans, all spans (both sorted), the number of layers, and whether every layer could be read."""
    base, every, layers, unread = _scan_layers(text, max_decoded)
    return base, every, layers, not unread


def spans_text(spans: list[Span]) -> str:
    """kind:start:end, comma-joined."""
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_secrets(df: DataFrame, key: str = "doc_id", text: str = "text", max_decoded: int = MAX_DECODED) -> DataFrame:
    """key, n_assign, n_access, n_hex, base_sha256 (of the base spans), spans (all), n_layers, complete."""

    def one(value: str | None) -> tuple:
        base, every, layers, complete = scan_nested(value, max_decoded)
        counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
        return *counts, hashlib.sha256(spans_text(base).encode()).hexdigest(), spans_text(every), layers, complete

    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers", "complete"]

    def make() -> Callable[[Texts], dict[str, list]]:
        return lambda texts: dict(zip(names, map(list, zip(*map(one, texts), strict=True)), strict=True))

    return map_texts(df, key, text, make, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long, complete boolean")


def mask(text: str | None, fill: str = "[secret]", max_decoded: int = MAX_DECODED) -> str | None:
    """The text with every span, also those found in decoded layers, and every unread segment replaced; overlapping ones become one."""
    if not text:
        return text
    _, every, _, unread = _scan_layers(text, max_decoded)
    if not every and not unread:
        return text
    parts, last = [], 0
    for start, end in sorted([(a, b) for a, _, b in every] + unread):
        if start >= last:
            parts += [text[last:start], fill]
        last = max(last, end)
    return "".join([*parts, text[last:]])


def mask_secrets(df: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """All rows and columns, with secrets masked; the length column follows, if there is one."""
    at = df.columns.index(text)
    size = df.columns.index(length) if length in df.columns else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, at):
                masked = [mask(t) for t in texts]
                columns = list(part.columns)
                columns[at] = pa.array(masked, part.schema.types[at])
                if size is not None:
                    known = part.column(size).to_pylist()
                    columns[size] = pa.array([n if n is None or new == old else n + len(new) - len(old) for n, old, new in zip(known, texts, masked, strict=True)], part.schema.types[size])
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return map_arrow(df, run, df.schema)
