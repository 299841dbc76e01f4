"""Secret scan by a recursive decoding worklist.

Every whole text is scanned for three kinds of secrets. Then its encoded layers are unwrapped: percent
escapes, Unicode escapes, base64 runs and compressed streams, which are looked for at every place of a
layer. Each new layer is scanned and put on the worklist again, until no layer yields a new one. Decoded
bytes that are not ASCII make two layers: the UTF-8 text, and one in which each byte is the character of
its number, so that nothing binary is lost. A layer that equals one of its ancestors,
or was already reached from the same place, is not opened again, so cyclic encodings end. Finds in a
layer are mapped back, layer by layer, to the characters of the original text.

Null texts are empty. Every input row gives one output row, repeated rows and null ids included.
Compressed content of more than `window` bytes becomes several layers: windows of that size, each half over the one before.
All of them have the same place in the text, so finds in them give the same spans as finds in the whole. Memory stays
bounded: layers are opened depth first, and content is inflated a block at a time. Only a stream in a stream can be cut by a
window; those of up to half a window are whole in the next one, and n_cut counts all that were cut anywhere.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from orderpulse.llm.common import id_and_text, record_batch

KINDS = ("assign", "access", "hex")
WINDOW = 16 << 20

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
# Runs are maximal, so asking for the least length at once finds the same matches.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
    r"|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
# Unbroken, or wrapped at any width and indented by any space.
_BASE64 = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{4,}+(?:(?:[\x20\t]*+\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)++|(?<=[A-Za-z0-9+/_-]{16}))"
)
_LINE = re.compile(r"[^\x20\t\r\n]+")
_PLUS = re.compile(r"(?:%[0-9A-Fa-f]{2}|\+)+")
_SIMPLE = {"a": 7, "b": 8, "t": 9, "n": 10, "v": 11, "f": 12, "r": 13, "0": 0} | {c: ord(c) for c in "\\'\"/"}
_ANY_ESCAPE = re.compile(_ESCAPE.pattern + r"|\\([abtnvfr0\\'\"/])")
_LATIN = re.compile("[\x00-\xff]*")
# gzip, bzip2, xz, zstd, zlib
_MAGICS = ("\x1f\x8b", "BZh", "\xfd7zXZ", "(\xb5/\xfd", "x\x01", "x^", "x\x9c", "x\xda")
_MAGIC = re.compile("|".join(map(re.escape, _MAGICS)).encode("latin-1"))
_FED, _MOST = 1024, 1 << 20  # bytes that a decompressor gets and gives at a time
_READABLE = re.compile(rb"[\t\n\r\x20-\x7e]{16,}")  # secrets are ASCII, and none is shorter

Span = tuple[int, int, int]  # start, index of the kind, end


def scan(text: str) -> list[Span]:
    """Leftmost matches that do not overlap, for each kind; matches under the least length are dropped."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


class Layer:
    """A decoded text and where its characters come from: `up` turns a stretch of it into one of its parent."""

    __slots__ = ("text", "parent", "up", "cut")

    def __init__(self, text: str, parent: Layer | None = None, up: Callable | None = None, cut: bool = False):
        self.text, self.parent, self.up = text, parent, up
        self.cut = cut or parent is not None and parent.cut

    def origin(self, start: int, end: int) -> tuple[int, int]:
        """The place in the original text that [start, end) of this layer was decoded from."""
        layer = self
        while layer.parent is not None:
            start, end = layer.up(start, end)
            layer = layer.parent
        return start, end

    def key(self) -> tuple[int, int, bytes]:
        """Its place and a digest of its text."""
        content = self.text.encode("utf-8", "surrogatepass")
        return *self.origin(0, len(self.text)), hashlib.blake2b(content, digest_size=16).digest()

    def repeats_ancestor(self) -> bool:
        layer = self.parent
        while layer is not None:
            if layer.text == self.text:
                return True
            layer = layer.parent
        return False


class Runs:
    """Places by runs: from starts[i] on, each character stands for widths[i] characters of the parent, from firsts[i] on."""

    def __init__(self):
        self.starts, self.firsts, self.widths = array("q"), array("q"), array("q")

    def add(self, start: int, first: int, width: int) -> None:
        if self.starts and self.widths[-1] == width and first == self.firsts[-1] + (start - self.starts[-1]) * width:
            return
        self.starts.append(start)
        self.firsts.append(first)
        self.widths.append(width)

    def place(self, at: int) -> int:
        i = bisect_right(self.starts, at) - 1
        return self.firsts[i] + (at - self.starts[i]) * self.widths[i]

    def up(self, start: int, end: int) -> tuple[int, int]:
        i = bisect_right(self.starts, end - 1) - 1
        return self.place(start), self.firsts[i] + (end - self.starts[i]) * self.widths[i]


def _opener(data: bytes, at: int):
    """A decompressor for the stream that begins at a place, by its magic number."""
    if data.startswith(b"\x1f\x8b", at):
        return zlib.decompressobj(31)
    if data.startswith(b"BZh", at):
        return bz2.BZ2Decompressor()
    if data.startswith(b"\xfd7zXZ", at):
        return lzma.LZMADecompressor()
    if data.startswith(b"\x28\xb5\x2f\xfd", at):
        return zstandard.ZstdDecompressor().decompressobj()
    return zlib.decompressobj() if data.startswith(b"x", at) else None


def inflated(data: bytes, at: int = 0) -> Iterator[tuple[bytes, int, bool]]:
    """Blocks of the stream at a place and of those of its kind that follow it, where they end, and whether a stream ended."""
    size, magic = 0, data[at : at + 2]
    while (opener := _opener(data, at)) is not None and data[at : at + 2] == magic:
        most = () if magic == b"\x28\xb5" else (_MOST,)
        try:
            while not opener.eof:
                fed = data[at : at + _FED] if getattr(opener, "needs_input", True) else b""
                block = opener.decompress(fed, *most)
                at, size = at + len(fed) - len(getattr(opener, "unconsumed_tail", b"")), size + len(block)
                if block:
                    yield block, at, False
                elif not fed:
                    break
        except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError, zstandard.ZstdError):
            if size:
                yield b"", at, True
            return
        at -= len(opener.unused_data)
        yield b"", at, opener.eof
        while data.startswith(b"\0", at):  # padding between streams
            at += 1


def windows(blocks: Iterator[bytes], size: int) -> Iterator[bytes]:
    """The content in windows of `size` bytes, each of which begins in the middle of the one before."""
    held = bytearray()
    for block in blocks:
        held += block
        while len(held) > size:
            yield bytes(held[:size])
            del held[: size // 2]
    yield bytes(held)


def streams(data: bytes, window: int) -> Iterator[tuple[bytes, int, int, bool, bool]]:
    """The compressed streams anywhere in the data: content or a window of it, place, if it is a window, if it has its end."""
    done = 0
    for m in _MAGIC.finditer(data):
        start = m.start()
        if start < done:
            continue
        held, size, end, ended = [], 0, start, False
        for block, end, ended in inflated(data, start):
            size += len(block)
            held = held + [block] if size <= window else []
        if size:
            done = end
            if size <= window:
                yield b"".join(held), start, end, False, ended
            else:
                for content in windows((block for block, _, _ in inflated(data, start)), window):
                    yield content, start, end, True, ended


def _rewritten(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every match of the pattern decoded: decode gives texts and the source length of their characters."""
    out, runs, size, last = [], Runs(), 0, 0
    for m in pattern.finditer(layer.text):
        if m.start() > last:
            runs.add(size, last, 1)
            out.append(layer.text[last : m.start()])
            size += m.start() - last
        at = m.start()
        for chars, length in decode(m):
            runs.add(size, at, length)
            out.append(chars)
            size, at = size + len(chars), at + length * len(chars)
        last = m.end()
    if not out and not last:
        return None
    if last < len(layer.text):
        runs.add(size, last, 1)
        out.append(layer.text[last:])
    return Layer("".join(out), layer, runs.up)


def _percent_chars(m: re.Match) -> Iterator[tuple[str, int]]:
    data = bytes.fromhex(m[0].replace("%", ""))
    if data.isascii():
        yield data.decode(), 3
        return
    i = 0
    while i < len(data):
        width = 1 + (data[i] >= 0xC0) + (data[i] >= 0xE0) + (data[i] >= 0xF0)
        try:
            char = data[i : i + width].decode()
        except UnicodeDecodeError:
            char, width = "\ufffd", 1
        yield char, 3 * width
        i += width


def _percent_bytes(m: re.Match) -> Iterator[tuple[str, int]]:
    for part in re.finditer(r"(?:%..)+|\++", m[0]):
        if part[0][0] == "+":
            yield " " * len(part[0]), 1
        else:
            yield bytes.fromhex(part[0].replace("%", "")).decode("latin-1"), 3


def _escaped_char(m: re.Match) -> Iterator[tuple[str, int]]:
    code = int(m[6]) if m[6] else int(next(g for g in m.groups()[:5] if g), 16)
    yield (chr(code) if code <= 0x10FFFF else "\ufffd"), m.end() - m.start()


def _any_escaped_char(m: re.Match) -> Iterator[tuple[str, int]]:
    if m[7]:
        yield chr(_SIMPLE[m[7]]), 2
    else:
        yield from _escaped_char(m)


def _may_hold_stream(text: str) -> bool:
    return any(magic in text for magic in _MAGICS)


def _opened(data: bytes, layer: Layer, place: Callable, window: int) -> Iterator[Layer | None]:
    """The streams in the data as text and, if they are not ASCII, byte by byte; None stands for one that a window cut."""
    for content, start, end, part, ended in streams(data, window):
        first, last = place(start, end)
        for text in (content.decode("utf-8", "replace"), None if content.isascii() else content.decode("latin-1")):
            if text is not None:
                yield Layer(text, layer, _always(first, last), part)
        if layer.cut and not ended:
            yield None


def _unwrapped(layer: Layer, window: int) -> Iterator[Layer | None]:
    """The layers directly inside a layer; None stands for a stream that a window cut."""
    text = layer.text
    if "%" in text and (child := _rewritten(layer, _PERCENT, _percent_chars)) is not None:
        yield child
        data = child if child.text.isascii() else _rewritten(layer, _PERCENT, _percent_bytes)
        if data is not child:
            yield data
        if "+" in text and _may_hold_stream(data.text):
            yield _rewritten(layer, _PLUS, _percent_bytes)
    if "\\" in text or "&#" in text:
        if (child := _rewritten(layer, _ESCAPE, _escaped_char)) is not None:
            yield child
        if "\\\\" in text or "\\" in text and _may_hold_stream(text if child is None else child.text):
            if (child := _rewritten(layer, _ANY_ESCAPE, _any_escaped_char)) is not None:
                yield child
    if _may_hold_stream(text):
        for run in _LATIN.finditer(text):
            offset = run.start()
            yield from _opened(run[0].encode("latin-1"), layer, lambda a, b: (offset + a, offset + b), window)
    for m in _BASE64.finditer(text):
        yield from _from_base64(layer, m, window)


def _from_base64(layer: Layer, m: re.Match, window: int) -> Iterator[Layer | None]:
    """Readable stretches and compressed streams that a base64 run holds, at any of four alignments."""
    runs, size, run = Runs(), 0, m[0]
    if "\n" in run:
        lines = []
        for line in _LINE.finditer(run):
            runs.add(size, m.start() + line.start(), 1)
            lines.append(line[0])
            size += len(line[0])
        run = "".join(lines)
    else:
        runs.add(0, m.start(), 1)
    run = run.replace("-", "+").replace("_", "/")
    for shift in range(4):
        size = len(run) - shift - ((len(run) - shift) % 4 == 1)
        if size < 16:
            break
        data = base64.b64decode(run[shift : shift + size] + "=" * (-size % 4))

        def place(start: int, end: int, shift: int = shift) -> tuple[int, int]:
            """The characters that hold the first and the last bit of the bytes [start, end)."""
            return runs.place(shift + 8 * start // 6), runs.place(shift + (8 * end - 1) // 6) + 1

        yield from _opened(data, layer, place, window)
        for stretch in _READABLE.finditer(data):
            yield Layer(stretch[0].decode(), layer, _from_byte(place, stretch.start()))


def _always(first: int, last: int) -> Callable:
    return lambda start, end: (first, last)


def _from_byte(place: Callable, first: int) -> Callable:
    return lambda start, end: place(first + start, first + end)


def find(text: str, window: int = WINDOW) -> tuple[list[Span], list[Span], int, int]:
    """Base spans, all spans, layers opened, and streams that a window cut."""
    base = scan(text)
    spans, work, seen, opened, cut = set(base), [_unwrapped(Layer(text), window)], set(), 0, 0
    while work:
        child = next(work[-1], ...)
        if child is ...:
            work.pop()
            continue
        if child is None:
            cut += 1
            continue
        if not child.text or child.repeats_ancestor():
            continue
        if (key := child.key()) in seen:
            continue
        seen.add(key)
        opened += 1
        for start, kind, end in scan(child.text):
            first, last = child.origin(start, end)
            spans.add((first, kind, last))
        work.append(_unwrapped(child, window))
    return base, sorted(spans), opened, cut


def written(spans: list[Span]) -> str:
    """kind:start:end by start, then kind; code points, end exclusive."""
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with every covered stretch replaced; overlapping spans make one stretch."""
    out, last = [], 0
    for start, _, end in spans:
        if start >= last:
            out += [text[last:start], mark]
        elif end <= last:
            continue
        last = max(last, end)
    return "".join(out) + text[last:]


SCHEMA = pa.schema(
    [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()),
     ("spans", pa.string()), ("n_layers", pa.int64()), ("n_cut", pa.int64())]
)
DDL = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "n_layers long, n_cut long"
)


def secret_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: counts of the base finds, their digest, and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                base, spans, opened, cut = find(text or "", window)
                counts = [sum(s[1] == k for s in base) for k in range(len(KINDS))]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((doc_id, *counts, digest, written(spans), opened, cut))
            yield record_batch(SCHEMA, list(zip(*rows)) if rows else [[]] * len(SCHEMA))

    return id_and_text(docs).mapInArrow(run, DDL)


def redact_secrets(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The same rows and columns with every secret replaced by a mark; n_chars, if present, follows the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.schema.names, batch["text"].to_pylist()
            for i, text in enumerate(texts):
                if text and (spans := find(text, window)[1]):
                    texts[i] = redact(text, spans)
            new = {"text": pa.array(texts, batch.schema.field("text").type)}
            if "n_chars" in names:
                field = batch.schema.field("n_chars")
                kept = batch["n_chars"].to_pylist()
                new["n_chars"] = pa.array([n if t is None else len(t) for t, n in zip(texts, kept)], field.type)
            yield pa.RecordBatch.from_arrays([new.get(c, batch[c]) for c in names], schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
