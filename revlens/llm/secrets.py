"""Secret scan with a recursive decoding worklist.

Base patterns run over every whole text.  Then each text is a worklist of
layers: a layer's percent escapes, Unicode escapes, base64 runs and compressed
runs (base64 or hex of gzip or zlib data) are decoded in place, one kind (of base64,
one phase) at a time, and every new layer is scanned again until nothing new appears.  A layer
already seen (by digest) is not visited twice, which ends cycles.  A layer is a
list of segments that know their place in the original text, so a finding in
any layer maps back to a span there; findings that touch no decoded segment are
the base findings already known.

Spans are (kind, start, end) in code points of the original text, end exclusive.

Decoded data must be text: UTF-8 or UTF-16 without control characters.  Base64 may
be wrapped in lines.  A run that doesn't decode as a whole is decoded in each of the
four phases that base64 can have in it, and texts of 16 characters and more, and
compressed data, are taken from there: so payloads behind a path, a name or other
bytes are found in linear time.  Decompression stops at ``max_layer_bytes`` bytes of output (a guard against bombs; the run is
then left as it is).

Defined results: null text counts as empty and has no spans; a span found in
several layers counts once; repeated rows each get a result; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import accumulate
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame

from revlens.llm.common import text_rows

#: Base patterns (fixed values), each with the test a match must pass.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{16,}")
KINDS: dict[str, tuple[re.Pattern, Callable[[re.Match], bool]]] = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= 12),
    "access": (ACCESS, lambda m: len(m[0]) >= 18),
    # runs are maximal, so the runs of 16 and more are the matches that pass
    "hex": (LONG_HEX, lambda m: True),
}
ORDER = {k: i for i, k in enumerate(KINDS)}

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\}|&#(?:x[0-9A-Fa-f]{1,6}|[0-9]{1,7});)+")
ONE_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\u\{([0-9A-Fa-f]{1,6})\}|&#(?:x([0-9A-Fa-f]{1,6})|([0-9]{1,7}));")
#: The shortest secret has 16 characters, which base64 writes with 22.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Lines of base64; possessive and begun at a run's first character only, so linear.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{20,}+\r?\n[\x20\t]*+)+[A-Za-z0-9+/_-]++={0,2}")
#: Text of at least 16 characters (the shortest secret) inside other bytes, in UTF-8 or as ASCII in UTF-16.
PRINTABLE = re.compile(rb"(?:[\x20-\x7e\t\n\r]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}){16,}"
                       rb"|(?:[\x20-\x7e\t\n\r]\x00){15,}[\x20-\x7e]?|(?:\x00[\x20-\x7e\t\n\r]){16,}")
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")
HEX_DATA = re.compile(r"(?:[0-9a-f]{2}){16,}|(?:[0-9A-F]{2}){16,}")
CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")

Span = tuple[str, int, int]


@dataclass(frozen=True)
class Segment:
    """A part of a layer: plain parts map character by character, decoded ones as a whole."""
    text: str
    start: int
    end: int
    decoded: bool


def base_spans(text: str) -> list[Span]:
    return [(kind, m.start(), m.end()) for kind, (pattern, passes) in KINDS.items()
            for m in pattern.finditer(text) if passes(m)]


def as_text(data: bytes) -> str | None:
    """Text in UTF-8, or in UTF-16 (by its mark, or where every second byte is mostly zero)."""
    names = ["utf-8"]
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        names = ["utf-16"]
    elif len(data) % 2 == 0 and 4 * data.count(0) > len(data):
        names = ["utf-16-le" if data[1::2].count(0) > data[::2].count(0) else "utf-16-be"]
    for name in names:
        try:
            text = data.decode(name)
        except UnicodeDecodeError:
            continue
        if not CONTROL.search(text):
            return text
    return None


def decode_percent(run: str, limit: int) -> str | None:
    return as_text(unquote_to_bytes(run))


def decode_escapes(run: str, limit: int) -> str | None:
    units = [int(next(filter(None, g[:4]), "0"), 16) if not g[4] else int(g[4]) for g in ONE_ESCAPE.findall(run)]
    if any(u > 0x10FFFF for u in units):
        return None
    raw = "".join(map(chr, units)).encode("utf-16-le", "surrogatepass")
    try:
        text = raw.decode("utf-16-le")  # joins surrogate pairs
    except UnicodeDecodeError:
        return None
    return None if CONTROL.search(text) else text


def unpack(data: bytes, limit: int) -> str | None:
    """Text of gzip or zlib data; None if it is neither, or too large."""
    if data[:2] != b"\x1f\x8b" and (len(data) < 2 or data[0] & 0x0F != 8 or (data[0] << 8 | data[1]) % 31):
        return None
    try:
        reader = zlib.decompressobj(wbits=47)
        out = reader.decompress(data, limit)
    except zlib.error:
        return None
    return as_text(out) if reader.eof else None


def decode_base64(run: str, limit: int) -> str | None:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        data = base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None
    return as_text(data) or unpack(data, limit)


def decode_hex(run: str, limit: int) -> str | None:
    return unpack(bytes.fromhex(run), limit)


Piece = tuple[int, int, str]


def whole(decode: Callable[[str, int], str | None]) -> Callable[[str, int], Iterator[Piece]]:
    """A decoder of whole runs."""
    def pieces(run: str, limit: int) -> Iterator[Piece]:
        plain = decode(run, limit)
        if plain is not None and plain != run:
            yield 0, len(run), plain
    return pieces


def wrapped_base64(run: str, limit: int) -> Iterator[Piece]:
    """Lines of one base64 run; the last line may be plain text that follows it."""
    for end in (len(run), len(run[:run.rindex("\n")].rstrip())):
        plain = decode_base64("".join(run[:end].split()), limit)
        if plain is not None:
            yield 0, end, plain
            return


def packed(data: bytes, limit: int) -> Iterator[tuple[int, int, str]]:
    """Compressed runs inside other bytes (of which 4 kB give some output)."""
    done, view = 0, memoryview(data)
    for m in MAGIC.finditer(data):
        if m.start() < done:
            continue
        reader = zlib.decompressobj(wbits=47)
        try:
            out = reader.decompress(view[m.start():m.start() + 4096], limit)
            if out and not reader.eof and len(out) < limit:
                out += reader.decompress(view[m.start() + 4096:], limit - len(out))
        except zlib.error:
            continue
        plain = as_text(out) if reader.eof else None
        if plain:
            done = len(data) - len(reader.unused_data)
            yield m.start(), done, plain


def shifted_base64(phase: int) -> Callable[[str, int], Iterator[Piece]]:
    """Texts and compressed runs inside a run that doesn't decode as a whole.

    Every place where base64 can begin has one of four phases, so decoding the run
    once a phase finds data behind names or paths of the same characters, and
    between control characters, in time linear in the run."""
    def pieces(run: str, limit: int) -> Iterator[Piece]:
        plain = decode_base64(run, limit)
        if plain is not None and plain.isascii():  # other bytes may be UTF-16 by chance
            return
        body = run.rstrip("=")[phase:].replace("-", "+").replace("_", "/")
        data = base64.b64decode(body + "A" * (-len(body) % 4))[:len(body) * 3 // 4]
        found = [(m.start(), m.end(), m[0].decode("utf-8", "replace").replace("\0", ""))
                 for m in PRINTABLE.finditer(data)] + list(packed(data, limit))
        done = 0
        for start, end, plain in sorted(found):
            if start >= done:  # a character may hold bits of two pieces
                left = phase + start // 3 * 4
                yield left, min(phase + -(-end // 3) * 4, len(run)), plain
                done = -(-end // 3) * 3
    return pieces


DECODERS: tuple[tuple[re.Pattern, Callable[[str, int], Iterator[Piece]]], ...] = (
    (PERCENT, whole(decode_percent)), (ESCAPE, whole(decode_escapes)), (BASE64, whole(decode_base64)),
    (WRAPPED, wrapped_base64), *((BASE64, shifted_base64(p)) for p in range(4)), (HEX_DATA, whole(decode_hex)))


def flat(layer: list[Segment]) -> str:
    return "".join(s.text for s in layer)


def offsets(layer: list[Segment]) -> list[int]:
    """Where each segment starts in the layer's text."""
    return list(accumulate((len(s.text) for s in layer[:-1]), initial=0))


def reached(layer: list[Segment], starts: list[int], start: int, end: int) -> Iterator[tuple[int, Segment]]:
    """The segments, with their starts, that hold characters of a layer's span."""
    for k in range(max(bisect_right(starts, start) - 1, 0), len(layer)):
        if starts[k] >= end:
            return
        if starts[k] + len(layer[k].text) > start:
            yield starts[k], layer[k]


def place(layer: list[Segment], starts: list[int], start: int, end: int) -> tuple[int, int, bool]:
    """The original span of a layer's span, and whether it touches decoded text."""
    left, right, decoded = None, None, False
    for at, s in reached(layer, starts, start, end):
        if left is None:
            left = s.start if s.decoded else s.start + start - at
        right = s.end if s.decoded else s.start + min(end, at + len(s.text)) - at
        decoded |= s.decoded
    return left, right, decoded


def cut(layer: list[Segment], starts: list[int], start: int, end: int) -> Iterator[Segment]:
    """The segments of a layer's span."""
    for at, s in reached(layer, starts, start, end):
        lo, hi = max(start - at, 0), min(end - at, len(s.text))
        if lo < hi:
            yield s if s.decoded and lo == 0 and hi == len(s.text) else Segment(
                s.text[lo:hi], s.start if s.decoded else s.start + lo, s.end if s.decoded else s.start + hi, s.decoded)


def unwrapped(layer: list[Segment], text: str, pattern, decode, limit: int) -> list[Segment] | None:
    """The layer with all runs of one encoding decoded; None if there are none."""
    out, done, starts = [], 0, None
    for m in pattern.finditer(text):
        for start, end, plain in decode(m[0], limit):
            starts = offsets(layer) if starts is None else starts
            start, end = m.start() + start, m.start() + end
            left, right, _ = place(layer, starts, start, end)
            out += [*cut(layer, starts, done, start), Segment(plain, left, right, True)]
            done = end
    if not done:
        return None
    return [*out, *cut(layer, starts, done, len(text))]


def hints(text: str) -> bool:
    """Whether any decoder could find a run (data runs as hex are base64 runs too)."""
    return ("%" in text and PERCENT.search(text) is not None) or "\\" in text or "&#" in text or BASE64.search(text) is not None


def decoded_spans(text: str, limit: int) -> set[Span]:
    """Spans of findings in the decoded layers of a text."""
    found: set[Span] = set()
    seen = {blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()}
    work = [[Segment(text, 0, len(text), False)]]
    while work:
        layer = work.pop()
        current = flat(layer)
        for pattern, decode in DECODERS:
            new = unwrapped(layer, current, pattern, decode, limit)
            if new is None:
                continue
            inner = flat(new)
            digest = blake2b(inner.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            if digest in seen:
                continue
            seen.add(digest)
            work.append(new)
            starts = offsets(new)
            for kind, start, end in base_spans(inner):
                left, right, decoded = place(new, starts, start, end)
                if decoded:
                    found.add((kind, left, right))
    return found


def scan_text(text: str, limit: int) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, by start, then kind as listed, then end."""
    base = base_spans(text)
    spans = set(base) | (decoded_spans(text, limit) if hints(text) else set())
    def key(s):
        return s[1], ORDER[s[0]], s[2]
    return sorted(base, key=key), sorted(spans, key=key)


SPANS = "array<struct<kind:string,start:int,end:int>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def span_array(rows: list[list[Span]]) -> pa.Array:
    return pa.array([[dict(zip(("kind", "start", "end"), s)) for s in spans] for spans in rows], SPAN_TYPE)


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
         max_layer_bytes: int = 64 << 20) -> DataFrame:
    """doc_id, base_spans, spans."""
    rows = text_rows(docs, id_col, text_col)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found = [scan_text(t, max_layer_bytes) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), span_array([b for b, _ in found]), span_array([s for _, s in found])],
                    names=["doc_id", "base_spans", "spans"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
                                f"base_spans {SPANS}, spans {SPANS}")
