"""Secret scans with a recursive decoding worklist.

Three kinds of secrets are looked for in a text. Then a worklist starts with the text; each layer
taken from it is scanned, and what is encoded inside it (URL escapes, Unicode escapes and
character references, base64, zlib or gzip data) is decoded into further layers until none is
new: a layer whose text was seen before from the same place is not taken again, whatever chain led
to it; equal texts from other places are layers of their own. Each layer keeps where its
characters stem from, so every finding maps to a span of the original text.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import html
import mmap
import re
import tempfile
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabforge.llm.tables import in_batches, text_of

KINDS = ("assign", "access", "hex")
#: Characters of a layer, run or decoded run that is held in memory; longer ones are read in chunks,
#: again for each step, or from a temporary file, so that a few bytes cannot fill a worker's memory.
LAYER_CHARS = 50_000_000
CHUNK = 1 << 20
#: Layers that are remembered so as not to be taken twice; beyond, work is repeated but not results.
SEEN_LAYERS = 100_000

# What a secret looks like. Runs are taken whole, then tested for their length.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|U\+([0-9A-Fa-f]{4,6})|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|&(?:amp|lt|gt|quot|apos);")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_RUN, _LEAST_RUN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 16
_STANDARD = bytes.maketrans(b"-_", b"+/")
_HEADER = re.compile(rb"(?=\x1f\x8b\x08|[\x08\x18\x28\x38\x48\x58\x68\x78])")
_SPACES = re.compile(" {2,}")
#: Characters that the shortest match of each secret, spaces made one, and of each escape fits in.
_OVERLAP, _ESCAPE = 64, 12


def _order(span: tuple[str, int, int]) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the secrets that stand openly in a text."""
    lowered = text.lower()
    named = any(word in lowered for word in ("passw", "secret", "token", "apikey", "api_key"))
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6] if named else []
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


class _Layer:
    """A text and where its characters stem from.

    ``parts`` are (start, end, from, to, exact): characters start..end stem from from..to of the
    original text; one to one if ``exact``, all of them from the whole span if not.
    """

    def __init__(self, text: str, parts: list[tuple[int, int, int, int, bool]]):
        self.text, self.parts = text, parts
        self.ends = [p[1] for p in parts]

    @property
    def key(self) -> bytes:
        return hashlib.blake2b(repr(self.parts).encode() + self.text.encode(errors="surrogatepass"), digest_size=16).digest()

    def origin(self, start: int, end: int) -> tuple[int, int]:
        first, last = (self.parts[bisect_right(self.ends, i)] for i in (start, end - 1))
        return first[2] + (start - first[0] if first[4] else 0), last[2] + end - last[0] if last[4] else last[3]

    def crossing(self, start: int, end: int) -> Iterator[tuple[int, int, int, bool]]:
        """(length, from, to, exact) of the parts between two places."""
        k = bisect_right(self.ends, start)
        while start < end:
            lo, hi, frm, to, exact = self.parts[k]
            stop = min(hi, end)
            yield (stop - start, frm + start - lo, frm + stop - lo, True) if exact else (stop - start, frm, to, False)
            start, k = stop, k + 1

    def findings(self) -> set[tuple[str, int, int]]:
        return {(kind, *self.origin(lo, hi)) for kind, lo, hi in scan(self.text)}

    def inner(self) -> Iterator[_Layer | _Long]:
        steps = []
        if "%" in self.text:
            steps.append((_URL, _url))
        if "\\" in self.text or "&" in self.text or "U+" in self.text:
            steps.append((_UNICODE, _unicode))
        for pattern, decode in steps:
            found = _unescaped(self, pattern, decode)
            if found:
                yield found
        for m in _BASE64.finditer(self.text):
            yield from _decoded(m[0].rstrip("=").encode(), self.origin(m.start(), m.end()))


class _Long:
    """A layer that is too long to hold; all of it stems from one span. ``read`` gives its chunks anew.

    A secret anywhere in it is one of that span, so chunks need only overlap by the shortest match.
    """

    def __init__(self, read: Callable[[], Iterator[str]], span: tuple[int, int]):
        self.read, self.span = read, span
        self.kinds: set[str] = set()
        self.steps = {}
        digest, tail = hashlib.blake2b(repr(span).encode(), digest_size=16), ""
        for chunk in read():
            digest.update(chunk.encode(errors="surrogatepass"))
            window = _SPACES.sub(" ", tail + chunk)
            self.kinds.update(kind for kind, _, _ in scan(window))
            for pattern, decode in ((_URL, _url), (_UNICODE, _unicode)):
                if any(decode(m) for m in pattern.finditer(window)):
                    self.steps[pattern] = decode
            tail = window[-_OVERLAP:]
        self.key = digest.digest()

    def findings(self) -> set[tuple[str, int, int]]:
        return {(kind, *self.span) for kind in self.kinds}

    def inner(self) -> Iterator[_Layer | _Long]:
        for pattern, decode in self.steps.items():
            yield _layer(lambda pattern=pattern, decode=decode: _unescaped_chunks(self.read(), pattern, decode), self.span)
        for run in _runs(self.read()):
            yield from _decoded(run, self.span)


class _Store:
    """Bytes that are collected, in a temporary file once they are many."""

    def __init__(self):
        self.pieces, self.size, self.file = [], 0, None

    def add(self, data: bytes) -> None:
        self.size += len(data)
        if self.file is None and self.size <= LAYER_CHARS:
            self.pieces.append(data)
            return
        if self.file is None:
            self.file = tempfile.TemporaryFile()
            self.file.writelines(self.pieces)
            self.pieces = []
        self.file.write(data)

    def data(self) -> bytes | mmap.mmap:
        if self.file is None:
            return b"".join(self.pieces)
        self.file.flush()
        return mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)


def _layer(read: Callable[[], Iterator[str]], span: tuple[int, int]) -> _Layer | _Long:
    pieces, size = [], 0
    for chunk in read():
        pieces.append(chunk)
        size += len(chunk)
        if size > LAYER_CHARS:
            del pieces
            return _Long(read, span)
    return _Layer("".join(pieces), [(0, size, *span, False)])


def _runs(chunks: Iterator[str]) -> Iterator[bytes | mmap.mmap]:
    """The base64 runs of a text in chunks, without padding."""
    store = _Store()
    for chunk in chunks:
        head = len(chunk) - len(chunk.lstrip(_RUN))
        store.add(chunk[:head].encode())
        if head == len(chunk):
            continue
        if store.size >= _LEAST_RUN:
            yield store.data()
        tail = len(chunk.rstrip(_RUN))
        for m in _BASE64.finditer(chunk, head, tail):
            yield m[0].rstrip("=").encode()
        store = _Store()
        store.add(chunk[tail:].encode())
    if store.size >= _LEAST_RUN:
        yield store.data()


def _unescaped_chunks(chunks: Iterator[str], pattern: re.Pattern, decode: Callable[[re.Match], list[tuple[str, int]]]) -> Iterator[str]:
    """A text in chunks with all matches decoded; what may be the begin of a match waits for the next chunk."""

    def plain(m: re.Match) -> str:
        return "".join(c for c, _ in decode(m)) or m[0]

    held = ""
    for chunk in chunks:
        text = held + chunk
        last = max(0, len(text) - _ESCAPE)
        stop = min((k for k in (text.find(c, last) for c in "%\\&U") if k >= 0), default=len(text))
        if stop and text[stop - 1] == "\\":
            stop -= 1
        held = text[stop:]
        yield pattern.sub(plain, text[:stop])
    yield pattern.sub(plain, held)


def _unescaped(layer: _Layer, pattern: re.Pattern, decode: Callable[[re.Match], list[tuple[str, int]]]) -> _Layer | None:
    """The layer with all matches decoded, or None if nothing changes.

    ``decode`` gives characters with the number of characters each took in the match.
    """
    if len(layer.parts) == 1 and not layer.parts[0][4]:  # all from one span
        text = "".join(_unescaped_chunks(iter([layer.text]), pattern, decode))
        return _Layer(text, [(0, len(text), *layer.parts[0][2:])]) if text != layer.text else None
    pieces: list[str] = []
    parts: list[tuple[int, int, int, int, bool]] = []
    at = size = 0

    def add(text: str, spans: Iterable[tuple[int, int, int, bool]]) -> None:
        nonlocal size
        pieces.append(text)
        for n, frm, to, exact in spans:
            parts.append((size, size + n, frm, to, exact))
            size += n

    for m in pattern.finditer(layer.text):
        new = decode(m)
        if not new:
            continue
        add(layer.text[at : m.start()], layer.crossing(at, m.start()))
        at = m.start()
        for char, n in new:
            add(char, [(len(char), *layer.origin(at, at + n), False)])
            at += n
    if not parts:
        return None
    add(layer.text[at:], layer.crossing(at, len(layer.text)))
    return _Layer("".join(pieces), parts)


def _url(m: re.Match) -> list[tuple[str, int]]:
    data = bytes.fromhex(m[0].replace("%", ""))
    try:
        return [(c, 3 * len(c.encode())) for c in data.decode()]
    except UnicodeDecodeError:
        return [(c, 3) for c in data.decode("latin-1")]


def _unicode(m: re.Match) -> list[tuple[str, int]]:
    digits = next((g for g in m.groups() if g), None)
    if digits is None:
        char = html.unescape(m[0])
        return [] if char == m[0] or not char else [(char, len(m[0]))]
    code = int(digits, 16)
    return [(chr(code), len(m[0]))] if code < 0x110000 and not 0xD800 <= code < 0xE000 else []


def _worth(text: str) -> bool:
    """Whether a decoded text is readable, or holds a secret or an encoded run: nothing else is lost."""
    if text and all(c.isprintable() and c != "\ufffd" or c in "\t\n\r" for c in text):
        return True
    return bool(scan(text) or _URL.search(text) or _UNICODE.search(text) or _BASE64.search(text))


def _texts(chunks: Iterator[bytes]) -> Iterator[str]:
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for chunk in chunks:
        yield decoder.decode(chunk)
    yield decoder.decode(b"", True)


def _pieces(data: bytes | mmap.mmap) -> Iterator[bytes]:
    for at in range(0, len(data), CHUNK):
        yield data[at : at + CHUNK]


def _packed(data: bytes | mmap.mmap, at: int) -> bool:
    """Whether zlib or gzip data may start at a place."""
    head = data[at : at + 3]
    return head == b"\x1f\x8b\x08" or (len(head) == 3 and head[0] & 0x8F == 8 and not head[1] & 0x20 and (head[0] * 256 + head[1]) % 31 == 0)


def _inflated(data: bytes | mmap.mmap, at: int, ends: list[int]) -> Iterator[bytes]:
    """What zlib or gzip data from a place on hold, member after member, as far as it is sound.

    The end of each whole member is added to ``ends``.
    """
    while _packed(data, at):
        unpack, left = zlib.decompressobj(wbits=47), b""
        while not unpack.eof:
            piece = left or data[at : at + CHUNK // 16]
            at += 0 if left else len(piece)
            before = unpack.copy()
            try:
                out = unpack.decompress(piece, CHUNK)
            except zlib.error:
                for k in range(len(piece)):
                    try:
                        yield before.decompress(piece[k : k + 1])
                    except zlib.error:
                        break
                return
            if out:
                yield out
            elif not piece:  # the data end within the member
                return
            left = unpack.unconsumed_tail
        at -= len(unpack.unused_data)
        ends.append(at)
        while data[at : at + 1] == b"\0":
            at += 1


def _plain(run: bytes | mmap.mmap, shift: int) -> bytes | mmap.mmap:
    """A base64 run decoded from one of its first four characters on."""
    store, end = _Store(), len(run) - ((len(run) - shift) % 4 == 1)
    for at in range(shift, end, 4 * CHUNK):
        piece = run[at : min(at + 4 * CHUNK, end)].translate(_STANDARD)
        store.add(base64.b64decode(piece + b"=" * (-len(piece) % 4)))
    return store.data()


def _decoded(run: bytes | mmap.mmap, span: tuple[int, int]) -> Iterator[_Layer | _Long]:
    """Layers inside a base64 run, which may be glued to a word before it: of the four ways to read
    it, and of compressed data that start at a character. Of a long word hardly any are worth it."""
    for shift in range(4):
        data = _plain(run, shift)
        read = [lambda: _texts(_pieces(data))]
        until = 0
        for m in _HEADER.finditer(data):
            at = m.start()
            if at < until or at % 3 or not _packed(data, at):
                continue
            ends: list[int] = []
            for _ in _inflated(data, at, ends):
                pass
            until = max([until, *ends])
            read.append(lambda at=at: _texts(_inflated(data, at, [])))
        for again in read:
            found = _layer(again, span)
            if isinstance(found, _Long) or (found.text and _worth(found.text)):
                yield found


def scan_layers(text: str, base: list[tuple[str, int, int]]) -> tuple[list[tuple[str, int, int]], int, bool]:
    """All spans: ``base`` and those in the layers inside a text; number of layers; whether one was cut, which none is."""
    spans = set(base)
    work = [iter([_Layer(text, [(0, len(text), 0, len(text), True)])] if text else [])]
    path: list[bytes] = []  # of the layer taken last, from the text down
    seen: set[bytes] = set()
    layers = 0
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            if path:
                path.pop()
            continue
        key = layer.key
        if key in seen or key in path:
            continue
        if len(seen) >= SEEN_LAYERS:
            seen.clear()
        seen.add(key)
        layers += 1
        if path:
            spans |= layer.findings()
        path.append(key)
        work.append(layer.inner())
    return sorted(spans, key=_order), layers, False


def _redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span replaced by its kind in brackets; spans that overlap once, by the kind of the first."""
    pieces, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            pieces += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_secrets(df: DataFrame, text_col: str = "text", redact: bool = False) -> DataFrame:
    """The rows of ``df`` with a column ``secrets``: struct of base, spans, n_layers, cut, redacted.

    ``base`` are spans (kind, start, end) that stand openly, ``spans`` all of them with those
    inside encoded layers, ordered by start and kind. Positions are code points of the text, the
    end excluded. A finding in a base64 or compressed layer spans the whole encoded run. ``cut`` is
    false: layers of any size are scanned whole. With
    ``redact``, ``redacted`` is the text with each span replaced by ``[kind]``, null else. Null and
    empty texts have no spans. Every row is scanned by itself, so repeated rows get equal results;
    other columns stay as they are, and one named ``secrets`` is replaced.
    """
    one = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    kind = pa.struct([("base", one), ("spans", one), ("n_layers", pa.int32()), ("cut", pa.bool_()), ("redacted", pa.string())])

    @F.arrow_udf(f"struct<base:{_SPANS},spans:{_SPANS},n_layers:int,cut:boolean,redacted:string>")
    def look(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            text = text.as_py() or ""
            base = sorted(scan(text), key=_order)
            spans, layers, cut = scan_layers(text, base)
            lists = [[dict(zip(("kind", "start", "end"), s)) for s in own] for own in (base, spans)]
            rows.append((*lists, layers, cut, _redacted(text, spans) if redact else None))
        columns = zip(*rows) if rows else [()] * 5
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], [f.name for f in kind])

    return in_batches(df).withColumn("secrets", look(text_of(text_col)))


def joined(spans: str) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
