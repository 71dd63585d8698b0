"""Secret scans of whole texts and of everything they unwrap to.

Each text starts a worklist of layers. A layer is scanned, then unwrapped: URL escapes and Unicode
escapes are replaced where they stand, base64 runs are decoded, compressed bytes are expanded. Each
result is a new layer, until none is new; a layer that was seen before, also in a cycle, is not
taken up again. Every find is mapped back to the characters of the original text.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railstream.llm.blocks import text_blocks
from railstream.llm.store import rejoined

KINDS = ("assign", "access", "hex")
# Bytes of a compressed run that are held at once. A longer run is read in blocks of this size that
# overlap, and counted in ``unread``, as what is wrapped again across two blocks may be missed.
EXPANDED_BYTES = 64 << 20
OVERLAP_BYTES = 1 << 16
PART_BYTES = 1 << 18
# Bytes of the shortest find.
SHORTEST = len("token=") + 6
# Characters of a text whose finds are mapped one by one.
MAPPED = 1 << 20
MASK = "[SECRET]"

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Only whole runs match, as a run's start is where the leftmost match begins.
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
_WRAPPED = re.compile(r"(?:[A-Za-z0-9+/]{40,}\r?\n)+[A-Za-z0-9+/]*={0,2}")
_PART = re.compile(r"[A-Za-z0-9+/]{16,}={0,2}")
_MAGIC = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
_ASCII = re.compile(rb"[\x00-\x7f]{%d,}" % SHORTEST)
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")


class Span(NamedTuple):
    """A find of one kind, in code points of the original text."""

    start: int
    order: int
    end: int

    def text(self) -> str:
        return f"{KINDS[self.order]}:{self.start}:{self.end}"


class Layer(NamedTuple):
    """Text with, for each character, where it came from; or all of it from one range."""

    text: str
    starts: list[int] | range | None
    ends: list[int] | range | None
    whole: tuple[int, int]

    def origin(self, start: int, end: int) -> tuple[int, int]:
        """Range of the original text that the characters ``start`` to ``end`` came from."""
        if self.starts is None:
            return self.whole
        return self.starts[start], self.ends[end - 1]


def matches(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, kind, end) of the base finds of one text."""
    for found in _ASSIGN.finditer(text):
        if len(found[2]) >= 6:
            yield found.start(), 0, found.end()
    for found in _ACCESS.finditer(text):
        if found.end() - found.start() >= 20:
            yield found.start(), 1, found.end()
    for found in _HEX.finditer(text):
        yield found.start(), 2, found.end()


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with each match of ``pattern`` decoded, or None where nothing changes."""
    text, starts, ends, at = [], [], [], 0
    for found in pattern.finditer(layer.text):
        value = decode(found[0])
        if value is None:
            continue
        text += [layer.text[at:found.start()], value]
        if layer.starts is not None:
            starts += layer.starts[at:found.start()]
            ends += layer.ends[at:found.start()]
            first, last = layer.origin(found.start(), found.end())
            starts += [first] * len(value)
            ends += [last] * len(value)
        at = found.end()
    if not text:
        return None
    text.append(layer.text[at:])
    if layer.starts is None:
        return Layer("".join(text), None, None, layer.whole)
    starts += layer.starts[at:]
    ends += layer.ends[at:]
    return Layer("".join(text), starts, ends, layer.whole)


def _kept_escapes(bad: UnicodeDecodeError) -> tuple[str, int]:
    return "".join(f"%{b:02X}" for b in bad.object[bad.start:bad.end]), bad.end


codecs.register_error("railstream-escapes", _kept_escapes)


def _url(found: str) -> str | None:
    """The characters of a run of URL escapes; bytes that are not UTF-8 stay escapes."""
    text = bytes.fromhex(found.replace("%", "")).decode("utf-8", "railstream-escapes")
    return None if text == found.upper() else text


def _unicode(found: str) -> str | None:
    code = int(found.strip("\\ux{}") or "0", 16)
    return None if code > 0x10FFFF or 0xD800 <= code < 0xE000 else chr(code)


def _zstd_end(data: bytes, at: int) -> int:
    """Where the zstandard frame at ``at`` ends; the end of the data if it is cut short."""
    try:
        checked = zstandard.get_frame_parameters(data[at:at + 18]).has_checksum
        at += zstandard.frame_header_size(data[at:at + 18])
    except zstandard.ZstdError:
        return len(data)
    last = False
    while not last and at + 3 <= len(data):
        head = int.from_bytes(data[at:at + 3], "little")
        last = head & 1
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
    return min(len(data), at + 4 * checked)


def _member(data: bytes, at: int) -> Iterator[bytes | int]:
    """Parts of what the compressed member at ``at`` expands to, then the place where it ends.

    A broken member gives what comes before the break, and no end.
    """
    try:
        if data[at:at + 4] == b"\x28\xb5\x2f\xfd":
            end = _zstd_end(data, at)
            with zstandard.ZstdDecompressor().stream_reader(data[at:end]) as reader:
                while part := reader.read(PART_BYTES):
                    yield part
            yield end
        elif data[at:at + 1] in b"\x1f\x78":
            opened = zlib.decompressobj(47)
            given = data[at:]
            while not opened.eof:
                part = opened.decompress(given, PART_BYTES)
                given = opened.unconsumed_tail
                if not part and not given:
                    break
                yield part
            yield len(data) - len(opened.unused_data)
        else:
            opened = bz2.BZ2Decompressor() if data[at:at + 1] == b"B" else lzma.LZMADecompressor()
            part = opened.decompress(data[at:], PART_BYTES)
            while part:
                yield part
                part = b"" if opened.eof or opened.needs_input else opened.decompress(b"", PART_BYTES)
            yield len(data) - len(opened.unused_data)
    except (zlib.error, OSError, lzma.LZMAError, EOFError, zstandard.ZstdError, ValueError):
        return


def _blocks_of(data: bytes, limit: int) -> Iterator[tuple[int, bytes | None]]:
    """(place, bytes) of all that is compressed in ``data``.

    Members that follow each other are one run, whatever stands before, between and behind runs.
    A run that expands beyond ``limit`` comes in blocks of that size, which overlap, and once
    as None.
    """
    at = 0
    while found := _MAGIC.search(data, at):
        first = at = found.start()
        held, beyond = bytearray(), False
        while _MAGIC.match(data, at):
            end = None
            for part in _member(data, at):
                if isinstance(part, int):
                    end = part
                    break
                held += part
                while len(held) > limit:
                    if not beyond:
                        yield first, None
                    beyond = True
                    yield first, bytes(held[:limit])
                    del held[:limit - min(OVERLAP_BYTES, limit // 2)]
            at = max(at + 1, end or 0)
            if end is None:
                break
        if held:
            yield first, bytes(held)


def _runs(text: str) -> Iterator[tuple[int, int]]:
    """Where base64 may stand: runs, their parts between dashes, and runs over several lines."""
    for run in _BASE64.finditer(text):
        yield run.span()
        if "-" in run[0] or "_" in run[0]:
            for part in _PART.finditer(text, *run.span()):
                yield part.span()
    if "\n" in text:
        for run in _WRAPPED.finditer(text):
            yield run.span()


def _decoded(run: str) -> Iterator[tuple[range | np.ndarray, bytes]]:
    """(places of its characters, bytes) of one base64 run, read from each of its first four.

    What stands before the base64 proper, a path or letters, is a run of other bytes in one of
    the four. A single character that is left at the end holds no byte.
    """
    body = "".join(run.split()).rstrip("=").replace("-", "+").replace("_", "/")
    at = range(len(body))
    if "\n" in run:
        at = np.flatnonzero(np.frombuffer(run.encode("ascii"), np.uint8) > 32)[:len(body)]
    for skip in range(4):
        part = body[skip:]
        part = part[:len(part) - (len(part) % 4 == 1)]
        if part:
            yield at[skip:], base64.b64decode(part + "=" * (-len(part) % 4))


class _Bytes(NamedTuple):
    """Bytes that a compressed run expands to, and the range of the original text it came from."""

    data: bytes
    whole: tuple[int, int]


def _shifted(layer: Layer, run: str, start: int, end: int, at: range | np.ndarray,
             data: bytes) -> Iterator[Layer]:
    """Texts in a run that is read from a later character.

    What comes behind the first sign of a path or sum begins there, anything else with the run; so
    does all of a very long text. Finds, and all that wraps them, are ASCII.
    """
    for found in _ASCII.finditer(data):
        first, text = found.start(), found[0].decode("ascii")
        low, high = layer.origin(start, end)
        border = next((p for p in range(-(-first // 3), found.end() // 3)
                       if run[at[4 * p] - 1] in "/+-_"), None) if len(text) <= MAPPED else None
        if border is None:
            yield Layer(text, None, None, (low, high))
            continue
        near, before = layer.origin(start + int(at[4 * border]), end)[0], 3 * border - first
        yield Layer(text, [low] * before + [near] * (len(text) - before), [high] * len(text),
                    (low, high))


def _unwrapped(layer: Layer, limit: int, unread: list) -> Iterator[Layer | _Bytes | None]:
    """The layers that one text holds."""
    yield _replaced(layer, _URL, _url)
    yield _replaced(layer, _UNICODE, _unicode)
    for start, end in _runs(layer.text):
        run = layer.text[start:end]
        for skip, (at, data) in enumerate(_decoded(run)):
            if skip:
                yield from _shifted(layer, run, start, end, at, data)
            else:
                yield Layer(data.decode("utf-8", "replace"), None, None, layer.origin(start, end))
            for place, block in _blocks_of(data, limit):
                whole = layer.origin(start + int(at[place // 3 * 4]), end)
                if block is None:
                    unread.append(whole)
                else:
                    yield _Bytes(block, whole)


def scan(text: str, limit: int = EXPANDED_BYTES) -> tuple[list[Span], list[Span], int]:
    """Base finds, all finds, and the number of runs that expand beyond ``limit``; both in order."""
    base, every, unread = scanned(text, limit)
    return base, every, len(unread)


def scanned(text: str, limit: int = EXPANDED_BYTES
            ) -> tuple[list[Span], list[Span], list[tuple[int, int]]]:
    """Base finds, all finds, and the ranges of the runs that expand beyond ``limit``.

    Such a run is read to its end in blocks. Only what is wrapped once more inside it, over the
    border of two blocks, can be missed there.
    """
    base = sorted(Span(*m) for m in matches(text))
    found, unread, seen = set(base), [], set()

    def taken(layer: Layer | _Bytes) -> Iterator[Layer | _Bytes | None]:
        # A text counts as seen for its own range: the same secret elsewhere is another find.
        raw = layer.data if isinstance(layer, _Bytes) else layer.text.encode("utf-8", "surrogatepass")
        key = isinstance(layer, _Bytes), hashlib.blake2b(raw, digest_size=16).digest(), layer.whole
        if key in seen:
            return
        seen.add(key)
        if isinstance(layer, Layer):
            for start, kind, end in matches(layer.text):
                first, last = layer.origin(start, end)
                found.add(Span(first, kind, last))
            yield from _unwrapped(layer, limit, unread)
            return
        yield Layer(layer.data.decode("utf-8", "replace"), None, None, layer.whole)
        for _, block in _blocks_of(layer.data, limit):
            if block is None:
                unread.append(layer.whole)
            else:
                yield _Bytes(block, layer.whole)

    # Layers are made one at a time, deepest first, so that blocks of a long run do not pile up.
    work = [taken(Layer(text, range(len(text)), range(1, len(text) + 1), (0, len(text))))]
    while work:
        new = next(work[-1], work)
        if new is work:
            work.pop()
        elif new is not None:
            work.append(taken(new))
    return base, sorted(found), unread


def masked(text: str, spans: list[Span], mask: str = MASK) -> str:
    """The text with every find replaced; finds that overlap are replaced together."""
    out, at = [], 0
    ranges: list[list[int]] = []
    for span in spans:
        if ranges and span.start < ranges[-1][1]:
            ranges[-1][1] = max(ranges[-1][1], span.end)
        else:
            ranges.append([span.start, span.end])
    for start, end in ranges:
        out += [text[at:start], mask]
        at = end
    return "".join(out) + text[at:]


def _class(chars: str) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(chars.encode())] = True
    return flags


_IN_HEX = _class("0123456789abcdef")
_IN_BASE64 = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


def _suspects(texts: pa.LargeBinaryArray, raw: list[bytes]) -> np.ndarray:
    """Texts that may hold a find; the others are certain to hold none and are not decoded.

    A run that reaches over the border of two texts only marks a text for nothing.
    """
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    marked = np.zeros(n, bool)
    for inside, least in ((_IN_HEX, 24), (_IN_BASE64, 16)):
        flags = np.concatenate([[False], inside[data], [False]])
        edges = np.flatnonzero(flags[1:] != flags[:-1])
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= least
        for start, end in zip(starts[long], ends[long]):
            first = np.searchsorted(offsets, start, "right") - 1
            last = np.searchsorted(offsets, end - 1, "right") - 1
            marked[first:last + 1] = True
    for row, text in enumerate(raw):
        if not marked[row]:
            low = text.lower()
            marked[row] = (b"%" in low or b"\\" in low or b"AKIA" in text
                           or any(k in low for k in _KEYWORDS))
    return marked


def _scanned(batch: pa.RecordBatch, texts: pa.LargeBinaryArray, limit: int):
    raw = texts.to_pylist()
    marked = _suspects(texts, raw)
    for row, data in enumerate(raw):
        text = data.decode("utf-8") if marked[row] else ""
        yield row, data, text, *(scanned(text, limit) if marked[row] else ([], [], []))


def finds(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          limit: int = EXPANDED_BYTES) -> DataFrame:
    """One row for each input row: doc_id, base and all finds, and the number of unread runs.

    Finds are (kind, start, end) in code points, in order. A missing text is an empty one and
    has no finds; repeated rows each have theirs. An empty table gives no rows. Other columns
    are not read.
    """
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def rows(found: list[Span]) -> list[dict]:
        return [{"kind": KINDS[s.order], "start": s.start, "end": s.end} for s in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, "text"):
            base, every, unread = [], [], []
            for _, _, _, own, all_, missed in _scanned(batch, texts, limit):
                base.append(rows(own))
                every.append(rows(all_))
                unread.append(len(missed))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, spans), pa.array(every, spans),
                 pa.array(unread, pa.int64())], ["doc_id", "base", "every", "unread"])

    kind = "array<struct<kind: string, start: long, end: long>>"
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"doc_id long, base {kind}, every {kind}, unread long"))


def redacted(docs: DataFrame, text_col: str = "text", limit: int = EXPANDED_BYTES,
             mask: str = MASK) -> DataFrame:
    """The rows of ``docs`` with every find masked in the text; a missing text stays missing.

    A run that expands beyond ``limit`` is masked whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, "text"):
            clean = [masked(text, sorted([*every, *(Span(a, 0, b) for a, b in unread)]), mask)
                     .encode("utf-8") if every or unread else data
                     for _, data, text, _, every, unread in _scanned(batch, texts, limit)]
            new = pa.array(clean, pa.binary()).cast(pa.string())
            missing = batch.column("text").is_null()
            new = pc.if_else(missing, pa.scalar(None, pa.string()), new)
            yield pa.RecordBatch.from_arrays([batch.column("row"), new], ["row", "text"])

    cols = docs.columns
    others = [c for c in cols if c != text_col]
    read = docs.select((F.struct(*others) if others else F.lit(0)).alias("row"),
                       F.col(text_col).alias("text"))
    got = read.mapInArrow(run, f"row {read.schema['row'].dataType.simpleString()}, text string")
    return got.select(rejoined(cols, text_col))
