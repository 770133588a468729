"""Secret scans that also look into encoded layers.

Every text starts a worklist of layers. A layer is scanned, then unwrapped in every way that applies:
percent escapes and character escapes are undone over the whole layer, base64 runs are decoded. An
escape that gives the first character of another is followed to its end at once, so texts with
thousands of nested escapes take one layer. Each result is a new layer, until nothing new comes; a
layer that was met before, with the same text from the same place, is not taken again. Each character
of a layer knows the span of the original text it came from, and what is found in a layer is reported
as a span of the original.

Layers of bytes may hold compressed streams. These wait on a stack of their own and are read in
windows, each of which starts a worklist again. A window that a text has shown before is not scanned
again, and a stream that was met before is not opened again.
""" 

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.arrays import add_columns, release_memory, slices

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex")
#: What a secret of each kind looks like.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 16
HEX = re.compile(r"[0-9a-f]{32,}")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
BYTE = re.compile(r"%([0-9A-Fa-f]{2})")
ESCAPE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
    r"|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});|%u([0-9A-Fa-f]{4})"
)
#: What makes an escape behind each first character; the decimal one is the named group.
TAILS = {
    "%": re.compile(r"([0-9A-Fa-f]{2})|u([0-9A-Fa-f]{4})"),
    "\\": re.compile(
        r"u\{([0-9A-Fa-f]{1,6})\}|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2})"
    ),
    "&": re.compile(r"#x([0-9A-Fa-f]{1,6});|#(?P<decimal>[0-9]{1,7});"),
}
FIRST = re.compile(r"%(?:25|26|5[Cc])")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
SAFE_ALPHABET = str.maketrans("-_", "+/")
#: Lines of base64 that only line breaks, real or written as escapes, keep apart.
FOLDED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+"
    r"(?:(?:[\x20\t]*+(?:\r\n|\r|\n)[\x20\t]*+|\\r\\n|\\n)[A-Za-z0-9+/_-]++)++={0,2}"
)
FOLD = re.compile(r"[\x20\t]*[\r\n]+[\x20\t]*|\\r\\n|\\n")
#: Characters of two or four bytes of which all but one are NUL.
WIDE = re.compile(r"(?:[\x01-\xff]\x00){8,}[\x01-\xff]?|(?:[\x01-\xff]\x00{3}){8,}[\x01-\xff]?")
#: What percent escapes of bytes stand in.
PERCENT_RUN = re.compile(r"[!-~]+")
#: How compressed streams start: gzip, zlib, bzip2, xz, and Zstandard with its skippable frames.
COMPRESSED = re.compile(
    r"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00"
    r"|\x28\xb5\x2f\xfd|[\x50-\x5f]\x2a\x4d\x18"
)
#: Bytes of an inflated layer that are scanned at once, and those that the next window sees again.
WINDOW, OVERLAP = 1 << 20, 1 << 16
#: Bytes that a decompressor gets at once, which bounds what zlib and Zstandard return at once.
STEP = 64
#: Where spaces are allowed any number is, so long runs of them are shortened between windows.
SPACES, FEW_SPACES = re.compile(rb"\x20{1025,}"), b" " * 1024


@dataclass(frozen=True)
class Layer:
    text: str
    starts: np.ndarray | None = None  # of each character in the original; None: the original
    ends: np.ndarray | None = None
    depth: int = 0
    close: int | None = None  # of decoded bytes: the end, with padding, of what they come from

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())

    def places(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        if self.starts is None:
            return np.arange(start, end), np.arange(start + 1, end + 1)
        return self.starts[start:end], self.ends[start:end]


def matches(text: str) -> Iterator[tuple[str, int, int]]:
    """Kind, start and end of every secret that stands in plain sight."""
    for found in ASSIGN.finditer(text):
        if found.end(2) - found.start(2) >= ASSIGN_LEAST:
            yield "assign", *found.span()
    for found in ACCESS.finditer(text):
        if found.end() - found.start() >= ACCESS_LEAST:
            yield "access", *found.span()
    for found in HEX.finditer(text):
        yield "hex", *found.span()


@dataclass
class Part:
    """A part of a layer and the text that takes its place; `edges` are the places in the layer where
    the new characters begin, and the end of the last."""

    start: int
    end: int
    new: str
    edges: list[int]


def spliced(layer: Layer, parts: list[Part], text: str | None = None) -> Layer:
    """The layer with parts replaced; `text` stands in for its text, character by character."""
    text = layer.text if text is None else text
    pieces, lows, highs, at = [], [], [], 0
    for part in [*parts, Part(len(text), len(text), "", [])]:
        kept = np.arange(at, part.start)
        pieces += [text[at : part.start], part.new]
        lows += [kept, part.edges[:-1]]
        highs += [kept + 1, part.edges[1:]]
        at = part.end
    low, high = (np.concatenate(edges).astype(np.int64) for edges in (lows, highs))
    # Characters keep the order of what they come from.
    if layer.starts is not None:
        low, high = layer.starts[low], layer.ends[high - 1]
    return Layer("".join(pieces), low, high, layer.depth + 1)


def code_of(found: re.Match, decimal: bool) -> int:
    return int(next(group for group in found.groups() if group), 10 if decimal else 16)


def followed(text: str, code: int, end: int) -> tuple[int, int]:
    """The character that an escape comes to, if it gives the first one of another, and its end."""
    while code < 128 and (tail := TAILS.get(chr(code))) and (found := tail.match(text, end)):
        code, end = code_of(found, "decimal" in (found.lastgroup or "")), found.end()
    return code, end


def without_percent(layer: Layer) -> Iterator[Layer]:
    """Percent escapes undone, each a byte; with pluses beside them as spaces, too.

    Runs around compressed bytes are also a layer each.
    """
    text = layer.text
    if "%" not in text:
        return
    parts: list[Part] = []
    found = PERCENT.search(text)
    while found:
        start, end = found.span()
        run = found.group()
        if not FIRST.search(run):
            new = bytes.fromhex(run.replace("%", "")).decode("latin-1")
            edges = list(range(start, end + 1, 3))
        else:
            codes, edges, at = [], [start], start
            while escape := BYTE.match(text, at):
                code, at = followed(text, int(escape.group(1), 16), escape.end())
                if not character(code):
                    # Half of a surrogate pair, or no character at all: only the byte is undone.
                    code, at = int(escape.group(1), 16), escape.end()
                codes.append(chr(code))
                edges.append(at)
            new, end = "".join(codes), at
        parts.append(Part(start, end, new, edges))
        found = PERCENT.search(text, end)
    if not parts:
        return
    yield spliced(layer, parts)
    end, spaced = 0, list(text)
    for place, part in enumerate(parts):
        if part.start < end:
            continue
        start, before = part.start, end
        end = max(part.end, PERCENT_RUN.match(text, start).end())
        while start > before and "!" <= text[start - 1] <= "~":
            start -= 1
        run = text[start:end]
        inner = [
            Part(p.start - start, p.end - start, p.new, [edge - start for edge in p.edges])
            for p in parts[place : bisect_left(parts, end, key=lambda p: p.start)]
        ]
        starts, ends = layer.places(start, end)
        # A plus that is not escaped may be a space.
        spaced[start:end] = run.replace("+", " ")
        for some in {run, run.replace("+", " ")}:
            new = spliced(Layer(some, starts, ends, layer.depth), inner)
            if COMPRESSED.search(new.text):
                yield replace(new, close=int(ends[-1]))
    if (form := "".join(spaced)) != text:
        yield spliced(layer, parts, form)


def character(code: int) -> bool:
    return code < 0xD800 or 0xE000 <= code < 0x110000


def without_escapes(layer: Layer) -> Iterator[Layer]:
    """Character escapes undone; two that are a surrogate pair are one character."""
    text = layer.text
    if "\\" not in text and "&#" not in text and "%u" not in text:
        return
    parts: list[Part] = []
    found = ESCAPE.search(text)
    while found:
        start, end = found.span()
        code, end = followed(text, code_of(found, found.group(6) is not None), end)
        before = parts[-1] if parts else None
        if 0xDC00 <= code < 0xE000 and before and before.end == start and len(before.new) == 1:
            high = ord(before.new)
            if 0xD800 <= high < 0xDC00:
                pair = chr(0x10000 + (high - 0xD800 << 10) + code - 0xDC00)
                parts[-1] = Part(before.start, end, pair, [before.start, end])
                found = ESCAPE.search(text, end)
                continue
        if code < 0x110000:
            parts.append(Part(start, end, chr(code), [start, end]))
        found = ESCAPE.search(text, end)
    # Half of a surrogate pair alone is no character.
    parts = [part for part in parts if character(ord(part.new))]
    if parts:
        yield spliced(layer, parts)


def opener(head: bytes):
    """A decompressor for the stream that starts so, or None."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:1] == b"\x78" and len(head) > 1 and int.from_bytes(head[:2]) % 31 == 0:
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    if head[:4] == b"\x28\xb5\x2f\xfd" or re.match(rb"[\x50-\x5f]\x2a\x4d\x18", head):
        import zstandard

        return zstandard.ZstdDecompressor(max_window_size=1 << 31).decompressobj()
    return None


def drained(opened, data: bytes) -> Iterator[bytes]:
    """What a decompressor makes of some bytes, in bounded pieces."""
    if not hasattr(opened, "needs_input"):
        yield opened.decompress(data)
        return
    yield opened.decompress(data, WINDOW)
    while not opened.eof and not opened.needs_input:
        yield opened.decompress(b"", WINDOW)


def member(data: memoryview, step: int, at: int = 0) -> Iterator[bytes]:
    """The content of one stream, which gets `step` bytes at once, from where `at` of it are in.

    Returns how many bytes it takes, and whether it ends early; None if it is no stream.
    """
    if (opened := opener(bytes(data[:8]))) is None:
        return None
    try:
        for low in range(0, at, STEP):
            for _ in drained(opened, bytes(data[low : min(at, low + STEP)])):
                pass
        while at < len(data) and not opened.eof:
            given = bytes(data[at : at + step])
            yield from drained(opened, given)
            at += len(given)
    except Exception as error:
        kinds = (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError, RuntimeError)
        if not isinstance(error, kinds) and type(error).__name__ != "ZstdError":
            raise
        if step > 1:
            # What came before the fault may have been lost with it.
            return (yield from member(data, 1, at))
        return max(at, 1), False
    return at - len(opened.unused_data), not opened.eof


def inflated(source: list[memoryview]) -> Iterator[bytes]:
    """The content of the compressed streams that stand one after another, in bounded pieces.

    Returns how many bytes the streams take, and whether the last ends early. What a damaged or
    cut stream gave before its fault is content, too.
    """
    (data,) = source
    at = used = 0
    early = False
    while not early and (taken := (yield from member(data[at:], STEP))):
        used, early = at + taken[0], taken[1]
        at = used
        while data[at : at + 1] == b"\0":
            at += 1
    return used, early


def measured(data: memoryview) -> tuple[int, bool, bytes | None]:
    """How many bytes the streams take, whether the last ends early, and the content if small."""
    held, pieces = bytearray(), iter(inflated([data]))
    while True:
        try:
            piece = next(pieces)
        except StopIteration as stop:
            used, early = stop.value or (len(data), False)
            return used, early, None if held is None else bytes(held)
        if held is not None:
            held += piece
            if len(held) > WINDOW:
                held = None


class Windows:
    """The content of a compressed stream, in overlapping windows."""

    def __init__(self, data: bytes, content: bytes | None):
        self.pieces = iter([content]) if content is not None else iter(inflated([memoryview(data)]))
        self.held, self.size, self.last = bytearray(), WINDOW, False

    def current(self) -> bytes:
        while len(self.held) < self.size and not self.last:
            try:
                self.held += next(self.pieces)
            except StopIteration:
                self.last = True
            if len(self.held) >= self.size or self.last:
                self.held = bytearray(SPACES.sub(FEW_SPACES, self.held))
        return bytes(self.held)

    def enlarge(self) -> None:
        """The window ends within something that has to be seen whole."""
        self.size = 2 * len(self.held)

    def advance(self) -> None:
        cut = len(self.held) - OVERLAP
        # A window starts with a line if one starts nearby.
        cut = self.held.find(b"\n", cut, cut + OVERLAP // 2) + 1 or cut
        self.held, self.size = self.held[cut:], WINDOW


def opens(head: memoryview) -> bool:
    """Whether a stream seems to start here: its first bytes give something, or want for more."""
    pieces = iter(inflated([head]))
    while True:
        try:
            if next(pieces):
                return True
        except StopIteration as stop:
            return stop.value is not None and stop.value[1]


@dataclass(frozen=True)
class Stream:
    """A compressed stream in a layer, or several in a row."""

    data: bytes
    content: bytes | None  # if it is small
    span: tuple[int, int]
    depth: int
    cut: bool  # whether its end is missing


def streams_in(layer: Layer) -> Iterator[Stream]:
    if layer.close is None or not (found := COMPRESSED.search(layer.text)):
        return
    data = memoryview(layer.text.encode("latin-1"))
    while found:
        start = at = found.start()
        if opens(data[start : start + STEP]):
            used, early, content = measured(data[start:])
            at += used
            low, high = layer.span(start, max(at, start + 1))
            if at == len(data):
                high = max(high, layer.close)
            yield Stream(bytes(data[start:at]), content, (low, high), layer.depth + 1, early)
        found = COMPRESSED.search(layer.text, max(at, start + 1))


def without_nuls(layer: Layer) -> Iterator[Layer]:
    """Text in characters of two or four bytes, as UTF-16 and UTF-32 write ASCII."""
    if "\0" not in layer.text:
        return
    for found in WIDE.finditer(layer.text):
        start, end = found.span()
        width = 2 if found.group()[2] != "\0" else 4
        starts, ends = layer.places(start, end)
        yield Layer(found.group()[::width], starts[::width], ends[::width], layer.depth + 1)


def from_base64(layer: Layer) -> Iterator[Layer]:
    """The bytes in each base64 run, and in runs that line breaks fold, from each of four offsets.

    Bytes are taken as Latin-1: every secret and every escape is ASCII.
    """
    for pattern in (BASE64, FOLDED):
        for found in pattern.finditer(layer.text):
            start, end = found.span()
            starts, ends = layer.places(start, end)
            close = int(ends[-1])
            run = found.group()
            if pattern is FOLDED:
                keep = np.ones(len(run), bool)
                for fold in FOLD.finditer(run):
                    keep[slice(*fold.span())] = False
                run, starts, ends = FOLD.sub("", run), starts[: len(keep)][keep], ends[keep]
            run = run.rstrip("=").translate(SAFE_ALPHABET)
            for offset in range(4):
                part = run[offset:]
                # One character alone is less than a byte.
                part = part[: len(part) - (len(part) % 4 == 1)]
                data = base64.b64decode(part + "=" * (-len(part) % 4))
                if not data:
                    continue
                # Byte i comes from the characters that hold its eight bits.
                last = np.arange(1, len(data) + 1)
                low, high = (last - 1) * 4 // 3, np.minimum(-(-last * 4 // 3), len(part))
                # Characters of the run keep their order in the original.
                yield Layer(
                    data.decode("latin-1"),
                    starts[offset + low],
                    ends[offset + high - 1],
                    layer.depth + 1,
                    close,
                )


UNWRAP = (without_percent, without_escapes, without_nuls, from_base64)


def digest(data: bytes | str) -> bytes:
    if isinstance(data, str):
        data = data.encode("utf-8", "surrogatepass")
    return hashlib.sha256(data).digest()


def unwrapped(
    text: str, raw: bool = False
) -> tuple[dict[tuple[str, int, int], int], list[Stream]]:
    """Least depth by kind, start and end in all layers of a text that take no inflating, and the
    compressed streams in them. `raw`: the characters are bytes."""
    found: dict[tuple[str, int, int], int] = {}
    streams: list[Stream] = []
    work = deque([Layer(text, close=len(text) if raw else None)])
    met = {(digest(text), 0, len(text))}
    while work:
        layer = work.popleft()
        for kind, start, end in matches(layer.text):
            name = (kind, *layer.span(start, end))
            found[name] = min(layer.depth, found.get(name, layer.depth))
        streams += streams_in(layer)
        for unwrap in UNWRAP:
            for new in unwrap(layer):
                if new.text:
                    name = (digest(new.text), *new.span(0, len(new.text)))
                    if name not in met:
                        met.add(name)
                        work.append(new)
    return found, streams


def layers_of(text: str) -> dict[tuple[str, int, int], int]:
    """Least depth by kind, start and end of all secrets in a text and its layers."""
    found, streams = unwrapped(text)
    #: Streams that are being read, each within the one before, and what has been read and opened.
    open_: list[tuple[Windows, tuple[int, int], int]] = []
    ends: dict[tuple, bool] = {}
    met: set[tuple] = set()

    def enter(some: list[Stream], span: tuple[int, int] | None, depth: int) -> None:
        for stream in some:
            # Within a stream everything comes from where the outermost one stands.
            whole = span or stream.span
            name = (digest(stream.data), *whole)
            if name not in met:
                met.add(name)
                open_.append((Windows(stream.data, stream.content), whole, depth + stream.depth))

    enter(streams, None, 0)
    while open_:
        windows, span, depth = open_[-1]
        window = windows.current()
        name = (digest(window), *span)
        inner: list[Stream] = []
        if name not in ends:
            kinds, inner = unwrapped(window.decode("latin-1"), raw=True)
            for (kind, _, _), below in kinds.items():
                least = found.get((kind, *span), depth + below)
                found[kind, *span] = min(depth + below, least)
            ends[name] = any(s.cut and s.span[1] >= len(window) - 4 for s in inner)
        if windows.last:
            open_.pop()
        elif ends[name]:
            windows.enlarge()
            inner = [stream for stream in inner if not stream.cut]
        else:
            windows.advance()
        enter(inner, span, depth)
    return found


def scan(text: str) -> list[tuple[str, int, int, int]]:
    """Kind, start, end and depth of every secret, by start, kind and end; depth 0 is plain.

    A span that more than one layer shows is listed once, with its least depth.
    """
    found = layers_of(text)
    order = {kind: place for place, kind in enumerate(KINDS)}
    return sorted(
        ((*span, depth) for span, depth in found.items()),
        key=lambda span: (span[1], order[span[0]], span[2]),
    )


SPAN = pa.struct(
    [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("depth", pa.int32())]
)


def find_secrets(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add `secrets`, an array of (kind, start, end, depth), replacing such a column.

    Offsets count code points of the text, `end` is exclusive, depth counts the layers around the
    secret. NULL or empty text gives an empty array; equal texts give equal arrays.
    """

    def spans(texts: pa.Array) -> list[pa.Array]:
        rows = [
            [dict(zip(("kind", "start", "end", "depth"), span, strict=True)) for span in scan(t)]
            for t in texts.to_pylist()
        ]
        return [pa.array(rows, pa.list_(SPAN))]

    return add_columns(
        documents,
        "secrets array<struct<kind: string, start: int, end: int, depth: int>>",
        spans,
        text,
    )


def redacted(text: str, mark: str) -> str:
    parts, at = [], 0
    spans = sorted((start, end) for _, start, end, _ in scan(text))
    for start, end in spans:
        if end <= at:
            continue
        if start >= at:
            parts += [text[at:start], mark]
        at = end
    return "".join([*parts, text[at:]])


def redact(documents: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The rows with every secret in their text replaced by `mark`, overlapping ones together.

    NULL text stays NULL; the column keeps its name and place.
    """

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        parts = [pa.array([], pa.string())]
        for start, end in slices(texts, 1 << 19):
            some = texts.slice(start, end - start).to_pylist()
            parts.append(
                pa.array([t if t is None else redacted(t, mark) for t in some], pa.string())
            )
        release_memory()
        return pa.concat_arrays(parts)

    return documents.withColumn(text, clean(F.col(text)))


def joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def secret_report(documents: DataFrame) -> DataFrame:
    """Counts and a digest of the plain secrets of every document, and all spans as text."""
    found = find_secrets(documents.select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["depth"] == 0)

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )
