"""Secret scans through nested encodings.

A text is scanned as it stands. Each line that holds something encoded then enters a worklist: percent escapes, Unicode and
character escapes, and base64 tokens (inflated when they hold a compressed stream) are replaced by what they stand for, the
result is scanned and goes back on the list, until nothing decodes further. Every character of a layer knows the stretch of
the original text that it came from, so a finding in any layer has a span in the original. A layer whose text has been seen
with the same places is not entered again, and a stream whose bytes have been seen is not inflated again, which ends cycles
such as a stream that inflates to itself.

Streams are inflated piece by piece, through all streams inside them. A layer that they make longer than twice ``WINDOW`` (or
its source, if longer) goes on the list in windows that overlap by a quarter of that, so memory is bounded whatever a stream
inflates to; time is in proportion to it. Only an encoded token longer than the overlap, inside such a layer, may be cut.

No secret spans lines in its plain form, so decoding by line loses no context; base64 wrapped at a fixed width is one token
over all its lines. The scan is a map over rows.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]{32,}")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")
#: Characters of a window (or as many as the layer it was made from), bytes that go into and come out of a decompressor at once.
WINDOW, FEED, PIECE = 1 << 20, 1 << 12, 1 << 18
#: Bytes that show whether a stream begins, characters that must be readable before the rest of a path is decoded.
MAGIC, PROBE = 6, 48
#: The share of readable characters that makes a layer a text, the kinds of blanks and marks that count, bytes that are not UTF-8.
READABLE, TEXT, LOST = 0.8, {"Zs", "Zl", "Zp", "Cf"}, re.compile("[\udc80-\udcff]")

Span = tuple[int, int]
#: A decoded text in pieces; with each the starts and ends of its characters in the token, or None where all have the whole token.
Pieces = Iterable[tuple[str, tuple[array, array] | None]]


def scan(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind number, start, end) in code points, leftmost and non-overlapping by kind."""
    low = text.lower()
    if any(n in low for n in NAMES):
        yield from ((0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8)
    if "AKIA" in text:
        yield from ((1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16)
    yield from ((2, m.start(), m.end()) for m in HEX.finditer(text))


@dataclass
class Layer:
    """A decoded text and, for each of its characters, the stretch of the original it came from."""

    text: str
    low: array
    high: array
    depth: int


def _spans(sizes: Iterable[int]) -> tuple[array, array]:
    starts, ends, at = array("q"), array("q"), 0
    for size in sizes:
        starts.append(at)
        at += size
        ends.append(at)
    return starts, ends


def _percent(m: re.Match[str]) -> Pieces | None:
    text = bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "replace")
    spans = _spans(3 * len(c.encode()) if c != "\ufffd" else 3 for c in text)
    return [(text, spans if spans[1][-1] == len(m[0]) else None)]


def _escape(m: re.Match[str]) -> Pieces | None:
    body = m[0].strip("\\&#;{}uUxX")
    number = int(body, 10 if m[0][0] == "&" and m[0][2] not in "xX" else 16)
    if number > 0x10FFFF or 0xD800 <= number < 0xE000:
        return None
    return [(chr(number), None)]


def _stream(raw: bytes) -> Callable | None:
    """What makes a decompressor for the gzip, zlib, bzip2 or xz stream at the start, or None where there is none."""
    if raw[:2] == b"\x1f\x8b":
        return lambda: zlib.decompressobj(31)
    if raw[:1] == b"\x78" and len(raw) > 2 and (raw[0] * 256 + raw[1]) % 31 == 0:
        return zlib.decompressobj
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor
    if raw[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor
    return None


def _inflated(source: Iterator[bytes]) -> Iterator[bytes | None]:
    """What the streams one after another hold, in pieces, and None at the end of each; ends where none begins or one breaks."""
    held = b""
    while True:
        while len(held := held.lstrip(b"\0")) < MAGIC and (more := next(source, None)) is not None:  # xz pads its streams
            held += more
        if (make := _stream(held)) is None:
            return
        try:
            tool = make()
            while not tool.eof:
                if not held and getattr(tool, "needs_input", True) and not (held := next(source, b"")):
                    return
                if out := tool.decompress(held, PIECE):
                    yield out
                held = getattr(tool, "unconsumed_tail", b"")
        except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
            return
        held = tool.unused_data
        yield None


def _first(pieces: Callable[[], Iterator[bytes]], size: int) -> Iterator[bytes]:
    """The first ``size`` bytes that the streams in ``pieces`` hold."""
    for out in _inflated(pieces()):
        if out:
            yield out[:size]
            size -= len(out)
            if size <= 0:
                return


def _innermost(raw: bytes) -> Callable[[], Iterator[bytes]] | None:
    """What gives the bytes inside all nested streams, again at every call; None where no whole stream begins or one holds itself."""
    pieces, seen, whole = lambda: (raw[at : at + FEED] for at in range(0, len(raw), FEED)), set(), None
    while True:
        head, source = b"", pieces()
        while len(head) < MAGIC and (more := next(source, None)) is not None:
            head += more
        if _stream(head) is None:
            return whole
        size, ended, digest, mark = 0, 0, hashlib.blake2b(), b""
        for out in _inflated(pieces()):
            if out is None:
                ended, mark = size, digest.digest()
            else:
                size += len(out)
                digest.update(out)
        if not ended:
            return whole
        if mark in seen:
            return None
        seen.add(mark)
        pieces = whole = partial(_first, pieces, ended)


def _texts(pieces: Iterable[bytes]) -> Iterator[str]:
    """The readable ones of the texts, of about a window each, that the pieces make."""
    decoder, held, size = codecs.getincrementaldecoder("utf-8")("surrogateescape"), [], 0
    for piece in pieces:
        held.append(decoder.decode(piece))
        size += len(held[-1])
        if size >= WINDOW:
            text, held, size = "".join(held), [], 0
            if _readable(text):
                yield LOST.sub("\ufffd", text)
    text = "".join([*held, decoder.decode(b"", True)])
    if text and _readable(text):
        yield LOST.sub("\ufffd", text)


def _readable(text: str) -> bool:
    """Whether enough of the characters are such as texts have; surrogates stand for bytes that are not UTF-8."""
    if text.isprintable():
        return True
    return sum(c.isprintable() or unicodedata.category(c) in TEXT or c in "\t\r\n\f\v" for c in text) >= READABLE * len(text)


def _raw(token: str) -> bytes | None:
    token = token.rstrip("=")
    if len(token) % 4 == 1 or ("+" in token or "/" in token) and ("-" in token or "_" in token):
        return None
    try:
        return base64.b64decode(token.replace("-", "+").replace("_", "/") + "=" * (-len(token) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _base64(m: re.Match[str] | Stretch) -> Pieces | None:
    if (raw := _raw(m[0])) is None:
        return None
    if _stream(raw) is not None and (inner := _innermost(raw)) is not None:
        texts = _texts(inner())
        if (first := next(texts, None)) is None:
            return None
        return ((text, None) for some in ([first], texts) for text in some)
    text = raw.decode("utf-8", "surrogateescape")
    if not text or not _readable(text):
        return None
    starts, ends = _spans(1 if "\udc80" <= c <= "\udcff" else len(c.encode()) for c in text)
    return [(LOST.sub("\ufffd", text), (array("q", (s * 4 // 3 for s in starts)), array("q", (min(len(m[0]), -(-e * 4 // 3)) for e in ends))))]


@dataclass
class Stretch:
    """Several lines that are one base64 token, in the manner of a match."""

    at: int
    body: str
    places: list[int]

    def start(self) -> int:
        return self.at

    def end(self) -> int:
        return self.at + self.places[-1] + 1

    def __getitem__(self, _: int) -> str:
        return self.body


class Wrapped:
    """Runs of lines that are wholly base64 and equally long, with the shorter line that may end them."""

    LINE = re.compile(r"^[ \t]*([A-Za-z0-9+/_-]+={0,2})[ \t\r]*$", re.MULTILINE)

    def finditer(self, text: str) -> Iterator[Stretch]:
        run: list[re.Match[str]] = []
        for m in self.LINE.finditer(text):
            follows = run and text.count("\n", run[-1].end(1), m.start(1)) == 1
            if follows and len(run[-1][1]) == len(run[0][1]) >= len(m[1]) and "=" not in run[-1][1]:
                run.append(m)
                continue
            yield from self._found(run)
            run = [m]
        yield from self._found(run)

    def _found(self, run: list[re.Match[str]]) -> Iterator[Stretch]:
        if len(run) < 2 or len(run[0][1]) < 12:
            return
        for lines in (run, run[:-1]):  # the last line may be a word of the text
            at = lines[0].start(1)
            one = Stretch(at, "".join(m[1] for m in lines), [i - at for m in lines for i in range(m.start(1), m.end(1))])
            if len(lines) > 1 and _base64(one) is not None:
                yield one
                return


def _wrapped(m: Stretch) -> Pieces | None:
    if (found := _base64(m)) is None:
        return None
    return ((text, spans and (array("q", (m.places[s] for s in spans[0])), array("q", (m.places[e - 1] + 1 for e in spans[1])))) for text, spans in found)


class Tail:
    """The end of a path such as ``/data/aGVsbG8=``, from the first slash after which it is base64."""

    def finditer(self, text: str) -> Iterator[Stretch]:
        for m in BASE64.finditer(text):
            if "/" not in m[0] or _base64(m) is not None:
                continue
            at = m[0].find("/") + 1
            while at and len(m[0]) - at >= 12:
                one = Stretch(m.start() + at, m[0][at:], range(len(m[0]) - at)) if self._begins(m[0][at : at + PROBE]) else None
                if one is not None and _base64(one) is not None:
                    yield one
                    break
                at = m[0].find("/", at) + 1

    @staticmethod
    def _begins(head: str) -> bool:
        raw = _raw(head[: len(head) // 4 * 4])
        return raw is not None and (_stream(raw) is not None or _readable(raw.decode("utf-8", "surrogateescape")))


DECODERS = ((PERCENT, _percent), (ESCAPE, _escape), (BASE64, _base64), (Wrapped(), _wrapped), (Tail(), _base64))


def _pieces(layer: Layer, pattern: re.Pattern[str] | Wrapped | Tail, decode: Callable) -> Iterator[tuple[str, array, array]]:
    """The layer with every match that decodes replaced, in pieces with their places; nothing where none does."""
    at = 0
    for m in pattern.finditer(layer.text):
        if (found := decode(m)) is None:
            continue
        a, b = m.start(), m.end()
        yield layer.text[at:a], layer.low[at:a], layer.high[at:a]
        for text, spans in found:
            if spans is None:
                yield text, array("q", [layer.low[a]]) * len(text), array("q", [layer.high[b - 1]]) * len(text)
            else:
                yield text, array("q", (layer.low[a + s] for s in spans[0])), array("q", (layer.high[a + e - 1] for e in spans[1]))
        at = b
    if at:
        yield layer.text[at:], layer.low[at:], layer.high[at:]


def _unwrapped(layer: Layer, pattern: re.Pattern[str] | Wrapped | Tail, decode: Callable) -> Iterator[Layer]:
    """The layer with every match that decodes replaced, in overlapping windows where that is much longer than the layer."""
    room, texts, low, high, size = max(WINDOW, len(layer.text)), [], array("q"), array("q"), 0
    for text, starts, ends in _pieces(layer, pattern, decode):
        for k in range(0, len(text), room):
            texts.append(text[k : k + room])
            low += starts[k : k + room]
            high += ends[k : k + room]
            size += len(texts[-1])
            if size > 2 * room:
                whole = "".join(texts)
                yield Layer(whole, low, high, layer.depth + 1)
                cut = size - room // 4
                blank = re.compile(r"\s").search(whole, cut)
                cut = blank.end() if blank else cut
                texts, low, high, size = [whole[cut:]], low[cut:], high[cut:], size - cut
    if texts:
        yield Layer("".join(texts), low, high, layer.depth + 1)


def _encoded_lines(text: str) -> list[Span]:
    """The lines in which some decoder finds something to decode."""
    lines: set[Span] = set()
    for pattern, decode in DECODERS:
        if pattern is PERCENT and "%" not in text or pattern is ESCAPE and "\\" not in text and "&#" not in text:
            continue
        for m in pattern.finditer(text):
            if decode(m) is not None:
                end = text.find("\n", m.end())
                lines.add((text.rfind("\n", 0, m.start()) + 1, len(text) if end < 0 else end))
    return sorted(lines)


def findings(text: str | None) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, depth) by start, kind and end; depth 0 is the text itself, others the layer that showed it first."""
    text = text or ""
    found = {x: 0 for x in scan(text)}
    for a, b in _encoded_lines(text):
        work, seen = [iter([Layer(text[a:b], array("q", range(a, b)), array("q", range(a + 1, b + 1)), 0)])], set()
        while work:
            if (layer := next(work[-1], None)) is None:
                work.pop()
                continue
            if layer.depth:
                mark = hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"))
                mark.update(layer.low)
                mark.update(layer.high)
                if mark.digest() in seen:
                    continue
                seen.add(mark.digest())
                for kind, s, e in scan(layer.text):
                    span = kind, min(layer.low[s:e]), max(layer.high[s:e])
                    found[span] = min(layer.depth, found.get(span, layer.depth))
            work += [_unwrapped(layer, pattern, decode) for pattern, decode in DECODERS]
    return [(KINDS[k], s, e, d) for (k, s, e), d in sorted(found.items(), key=lambda x: (x[0][1], x[0][0], x[0][2]))]


FINDINGS = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("depth", pa.int32())])


def with_findings(docs: DataFrame, text_col: str = "text", name: str = "findings") -> DataFrame:
    """``docs`` with the array ``name`` of structs (kind, start, end, depth), an existing column of that name replaced.

    A null or empty text has none; rows may repeat; texts are scanned whole; an empty table stays empty.
    """

    @F.arrow_udf("array<struct<kind:string,start:bigint,end:bigint,depth:int>>")
    def run(text: pa.Array) -> pa.Array:
        return pa.array([[dict(zip(("kind", "start", "end", "depth"), f, strict=True)) for f in findings(x.as_py())] for x in text], pa.list_(FINDINGS))

    return docs.withColumn(name, run(F.col(text_col).cast("string")))
