"""Operator 4, secret scans: a worklist of decoded layers, each rescanned, with spans mapped to the original text.

The text is the first layer. Regions that look URL-encoded, Unicode-escaped or base64-encoded are decoded, and
gzip, zlib or bzip2 streams that begin anywhere in decoded bytes are unpacked; each result is a new layer that is scanned
and searched for further encoded regions until the worklist is empty. A base64 run may be glued to a path or a name and
broken into lines, so it is decoded from each of its first four characters and also joined across line breaks. Bytes
that are no text become a layer, too, if a finding or a further region is in them.

A layer's findings are kept in its own characters, and each layer knows which characters of the one above gave each of
its own. So equal layers are searched once, and their findings are mapped to every place that holds one, level by
level up to the original's code points. A layer that equals one it lies in is not entered, which ends cycles.

Streams are unpacked bit by bit, and what they hold is scanned in pieces. A piece ends at a space between two plain words, which no
finding or encoded region can contain, however long it is; so the pieces give what the whole would give.
"""

from __future__ import annotations

import binascii
import bz2
import codecs
import hashlib
import re
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import lean
from ._util import fresh

KINDS = ("assign", "access", "hex")
PIECE, FEED = 4 << 20, 1 << 16
ROWS = 256  # texts held as Python strings at a time, beside their batch

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6

URL = re.compile(r"(?:[A-Za-z0-9_.~!*'();:@&=+$,/?#\[\]-]|%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
BASE64_LEAST = 16
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[\x20\t]*+\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)++={0,2}")
_PERCENT = re.compile(r"%[0-9A-Fa-f]{2}")
_STANDARD = str.maketrans("-_", "+/", "= \t\r\n")
_MAGIC = (b"\x1f\x8b", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda", b"BZh")
_ESCAPED = re.compile("[\udc80-\udcff]")
_STREAM = re.compile(b"|".join(map(re.escape, _MAGIC)))
_APART = re.compile(r"(?<=\s)[A-Za-z0-9.,]+(?=\x20[A-Za-z0-9.,]+\s)")

Span = tuple[int, int]
Finding = tuple[str, int, int]


def base_spans(text: str) -> list[Finding]:
    """Findings of one layer, by kind."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


class Layer:
    """A decoded text with the span of each character in the layer above: a list of each, or one span for all."""

    def __init__(self, text: str, starts: array | None = None, ends: array | None = None, span: Span | None = None):
        self.text, self.starts, self.ends, self.span = text, starts, ends, span

    def above(self, start: int, end: int) -> Span:
        return self.span or (min(self.starts[start:end]), max(self.ends[start:end]))


def _legible(text: str) -> bool:
    return sum(not (c.isprintable() or c in "\t\r\n") for c in text) * 20 <= len(text)


def _runs(text: str) -> Iterator[tuple[re.Match, str, Sequence[int]]]:
    """Base64 runs, those of one line and those joined across line breaks: match, characters, where each of them is."""
    for m in BASE64.finditer(text):
        body = m[0].translate(_STANDARD)
        yield m, body, range(m.start(), m.start() + len(body))
    if "\n" in text:
        for m in WRAPPED.finditer(text):
            body = m[0].translate(_STANDARD)
            if len(body) >= BASE64_LEAST:
                yield m, body, [i for i in range(m.start(), m.end()) if text[i] not in "= \t\r\n"]


def _holds(text: str) -> bool:
    """Whether a finding or an encoded region is in a text."""
    return bool(_PERCENT.search(text) or ESCAPE.search(text) or base_spans(text)) or next(_runs(text), None) is not None


def _from_bytes(raw: bytes, origin: Callable[[int], Span]) -> Layer | None:
    """A layer of bytes as UTF-8; bytes that are not are replaced one by one. None where they are no text and hold nothing."""
    text = raw.decode("utf-8", "surrogateescape")
    plain = _ESCAPED.sub("\ufffd", text)
    if (plain != text or not _legible(text)) and not _holds(plain):
        return None
    starts, ends, i = array("q"), array("q"), 0
    for c in text:
        width = 1 if c < "\x80" or "\udc80" <= c <= "\udcff" else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4
        starts.append(origin(i)[0])
        ends.append(origin(i + width - 1)[1])
        i += width
    return Layer(plain, starts, ends)


def _inside(raw: bytes, origin: Callable[[int], Span], end: int) -> Iterator[Layer]:
    """Layers of decoded bytes: the streams that begin in them, each of which may reach to ``end``, and the bytes as text."""
    for m in _STREAM.finditer(raw):
        span = origin(m.start())[0], end
        yield from (Layer(text, span=span) for text in _unpacked(raw[m.start() :]))
    if inner := _from_bytes(raw, origin):
        yield inner


def _url(m: re.Match) -> Iterator[Layer]:
    text, raw, starts, ends, i = m.string, bytearray(), array("q"), array("q"), m.start()
    while i < m.end():
        step = 3 if text[i] == "%" else 1
        raw.append(int(text[i + 1 : i + 3], 16) if step == 3 else ord(text[i]))
        starts.append(i)
        ends.append(i + step)
        i += step
    yield from _inside(bytes(raw), lambda k: (starts[k], ends[k]), m.end())


def _escapes(text: str) -> Layer | None:
    """The whole layer with its escapes resolved, so that a secret partly escaped is found as well."""
    out, starts, ends, at = [], array("q"), array("q"), 0

    def plain(upto: int) -> None:
        out.append(text[at:upto])
        starts.extend(range(at, upto))
        ends.extend(range(at + 1, upto + 1))

    for m in ESCAPE.finditer(text):
        digits = next(g for g in m.groups() if g is not None)
        code = int(digits, 10 if m[6] else 16)
        plain(m.start())
        at = m.end()
        if code < 0x110000 and not 0xD800 <= code < 0xE000:
            out.append(chr(code))
            starts.append(m.start())
            ends.append(m.end())
    plain(len(text))
    return Layer("".join(out), starts, ends) if starts else None


class _Stream:
    """A compressed stream that is fed bit by bit, and the streams that begin in what it unpacks to.

    A stream ends where it is complete, damaged or cut off. One that begins with the same FEED bytes as a stream that it lies
    in, or is equal to it if shorter, is a cycle and is left out.
    """

    def __init__(self, above: tuple[bytes, ...]):
        self.above, self.waiting, self.machine, self.over = above, b"", None, False
        self.decoder, self.text, self.edge = codecs.getincrementaldecoder("utf-8")("replace"), "", b""
        self.inner: list[_Stream] = []

    def feed(self, data: bytes | None) -> Iterator[bytes]:
        """What the next bytes (None: no more) unpack to, in pieces of at most PIECE bytes."""
        if self.machine is None and not self.over:
            self.waiting += data or b""
            if data is not None and len(self.waiting) < FEED:
                return
            data, self.waiting = self.waiting, b""
            key = hashlib.blake2b(data[:FEED], digest_size=16).digest()
            self.over = key in self.above
            self.above = (*self.above, key)
            self.bz = data[:3] == b"BZh"
            self.machine = bz2.BZ2Decompressor() if self.bz else zlib.decompressobj(47)
        while data and not self.over:
            try:
                piece = self.machine.decompress(data, PIECE)
            except (OSError, zlib.error):
                self.over = True
                return
            data = b"" if self.bz else self.machine.unconsumed_tail
            self.over = self.machine.eof
            if piece:
                yield piece
            while self.bz and not self.over and not self.machine.needs_input:
                piece = self.machine.decompress(b"", PIECE)
                self.over = self.machine.eof
                if piece:
                    yield piece

    def begun(self, piece: bytes) -> Iterator[tuple[_Stream, bytes]]:
        """The inner streams, each with what the next unpacked bytes mean to it; new ones begin in these bytes."""
        old, joined = list(self.inner), self.edge + piece
        yield from ((s, piece) for s in old)
        for m in _STREAM.finditer(joined):
            if m.end() > len(self.edge):
                self.inner.append(_Stream(self.above))
                yield self.inner[-1], joined[m.start() :]
        self.edge = joined[-2:]

    def texts(self, piece: bytes | None) -> Iterator[str]:
        """The text unpacked so far as far as it can be cut off; with None all that is left."""
        self.text += self.decoder.decode(piece or b"", piece is None)
        at = len(self.text) if piece is None else 0
        if piece is not None and len(self.text) >= PIECE:
            reach = FEED
            while not at and reach < 2 * len(self.text):
                for m in _APART.finditer(self.text, max(0, len(self.text) - reach)):
                    at = m.end()
                reach *= 2
        if at:
            out, self.text = self.text[:at], self.text[at:]
            if _legible(out) or _holds(out):
                yield out


def _unpacked(raw: bytes) -> Iterator[str]:
    """Texts that a stream holds, and the streams in it, however often they are packed."""
    root = _Stream(())
    for data in (*(raw[k : k + FEED] for k in range(0, len(raw), FEED)), None):
        work = [(root, data, root.feed(data))]
        while work:
            stream, last, pieces = work[-1]
            piece = next(pieces, None)
            if piece is not None:
                yield from stream.texts(piece)
                work += [(s, d, s.feed(d)) for s, d in stream.begun(piece)]
                continue
            work.pop()
            if last is None:
                yield from stream.texts(None)
                work += [(s, None, s.feed(None)) for s in stream.inner]


def _base64(m: re.Match, body: str, at: Sequence[int]) -> Iterator[Layer]:
    for skip in range(4):  # a run that begins later is aligned with one of these
        size = len(body) - skip
        raw = binascii.a2b_base64(body[skip : len(body) - (size % 4 == 1)] + "=" * (-size % 4 if size % 4 > 1 else 0))
        # byte i lies in characters i * 8 // 6 to the one that holds its last bit
        yield from _inside(raw, lambda i, skip=skip: (at[skip + i * 4 // 3], at[skip + (i * 8 + 7) // 6] + 1), m.end())


def _deeper(text: str) -> Iterator[Layer]:
    if "%" in text:
        for m in URL.finditer(text):
            if "%" in m[0]:
                yield from _url(m)
    if ("\\" in text or "&#" in text) and ESCAPE.search(text) and (inner := _escapes(text)):
        yield inner
    for run in _runs(text):
        yield from _base64(*run)


def _mark(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _order(x: Finding) -> tuple[int, int, int]:
    return x[1], KINDS.index(x[0]), x[2]


def scan(text: str | None) -> tuple[list[Finding], list[Finding], int]:
    """(base spans, all spans, number of distinct decoded layers) of a text, both sorted by start, then kind."""
    text = text or ""
    base = base_spans(text)
    found = set(base)
    first = next(inner := _deeper(text), None)
    if first is None:  # as for most texts
        return sorted(base, key=_order), sorted(found, key=_order), 0
    known: dict[bytes, list[Finding]] = {}  # the findings of layers that are done, in their own characters
    work = [(_mark(text), None, found, _chain(first, inner))]  # a layer, its findings so far, and what is left of its layers
    open_marks = {work[0][0]}
    while work:
        mark, layer, own, rest = work[-1]
        if (inner := next(rest, None)) is not None:
            below = _mark(inner.text)
            if below in known:
                own.update((kind, *inner.above(s, e)) for kind, s, e in known[below])
            elif below not in open_marks:
                open_marks.add(below)
                work.append((below, inner, set(base_spans(inner.text)), _deeper(inner.text)))
            continue
        work.pop()
        open_marks.discard(mark)
        if layer is not None:
            known[mark] = list(own)
            work[-1][2].update((kind, *layer.above(s, e)) for kind, s, e in own)
    return sorted(base, key=_order), sorted(found, key=_order), len(known)


def _chain(first: Layer, rest: Iterator[Layer]) -> Iterator[Layer]:
    yield first
    yield from rest


def redact(text: str, spans: list[Finding], mark: str) -> str:
    """``text`` with each maximal run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for _, s, e in sorted(spans, key=lambda x: x[1:]):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def joined(spans: list[Finding]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan_documents(docs: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """One row per document: key columns, n_assign, n_access, n_hex, base, spans (as kind:start:end lists) and n_layers.

    Null and empty texts have no spans. Rows are independent: repeated rows give repeated results, and an empty table gives
    an empty one. Texts are scanned whole; only what a compressed stream unpacks to is scanned in pieces. Findings of
    one start are ordered by kind, then end. A result column that clashes with ``key`` gets a trailing underscore.
    """
    shape = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in key)
    names = [fresh(docs.select(*key), n) for n in (*[f"n_{k}" for k in KINDS], "base", "spans", "n_layers")]
    body = fresh(docs.select(*key), "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = [scan(t) for t in batch.column(len(key)).to_pylist()]
            counts = [pa.array([sum(k == kind for k, _, _ in base) for base, _, _ in results], pa.int64()) for kind in KINDS]
            lists = [pa.array([joined(r[k]) for r in results], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(key)], *counts, *lists, pa.array([n for _, _, n in results], pa.int64())], [*key, *names])

    kinds = ("bigint", "bigint", "bigint", "string", "string", "bigint")
    out = ", ".join([shape, *[f"`{n}` {k}" for n, k in zip(names, kinds, strict=True)]])
    return docs.select(*[F.col(f"`{k}`") for k in key], F.col(f"`{text}`").alias(body)).mapInArrow(lean(run), out)


def redact_documents(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span found in ``text`` replaced by ``mark``; other columns stay as they are.

    Null texts stay null; texts without findings stay as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, ROWS) for whole in batches for k in range(0, whole.num_rows, ROWS)):
            at = batch.schema.get_field_index(text)
            column = batch.column(at)
            clean = [t if t is None or not (spans := scan(t)[1]) else redact(t, spans, mark) for t in column.to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, column.type))

    return docs.mapInArrow(lean(run), docs.schema)
