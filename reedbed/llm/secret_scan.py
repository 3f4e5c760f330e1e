"""Secrets in texts, also below layers of encoding.

Each text is a worklist of layers. A layer is scanned, its percent, Unicode and HTML escapes are
undone, its base64, hex and escaped bytes are decoded and unpacked where they hold anything readable, and
what comes out goes on the list, until nothing new comes out. Every character of a layer
knows the span of the text it came from, so all findings are spans of the text itself.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import html
import itertools
import lzma
import re
import urllib.parse
import zlib
from array import array
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from reedbed.llm.common import keyed_text, text_batches

#: The kinds and what they look like; letters of ``assign`` stand for either case.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

#: Runs that an encoding could have made.
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|amp|quot|apos|equals|colon);)+")
UNICODE_ONE = re.compile(r"\\u\{([0-9A-Fa-f]+)\}|\\(?:u|U|x)([0-9A-Fa-f]+)|(&[^;]+;)")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
HEX_BYTES = re.compile(r"[0-9A-Fa-f]{24,}")
#: The end of a line, real or escaped, and runs that are wrapped to lines; the first and the last may be short.
BREAK = re.compile(r"[ \t>]*(?:\r?\n|\r|(?:\\r)?\\n)[ \t>]*")


def _lines(char: str, end: str) -> re.Pattern:
    gap, least = BREAK.pattern, 16
    return re.compile(rf"(?<!{char})(?:{char}{{4,}}+(?:{gap}{char}{{{least},}}+)++(?:{gap}{char}++)?+|{char}{{{least},}}+{gap}{char}++){end}")


BASE64_LINES, HEX_LINES = _lines("[A-Za-z0-9+/_-]", "={0,2}"), _lines("[0-9A-Fa-f]", "")
#: All that is looked for, and every encoding of it, holds so many ASCII characters in a row; without them bytes are no text.
STRETCHES = [
    (re.compile(rb"[\t\n\r\x20-\x7e]{12,}"), 0, 1),
    (re.compile(rb"(?:[\t\n\r\x20-\x7e]\0){12,}"), 0, 2),
    (re.compile(rb"(?:\0[\t\n\r\x20-\x7e]){12,}"), 1, 2),
]
#: Bytes of a URL, those that need no escape as they are; and bytes in a text that was made of escapes.
URL_BYTES = re.compile(r"(?<![A-Za-z0-9_.~!*'()+-])[A-Za-z0-9_.~!*'()+-]*+(?:%[0-9A-Fa-f]{2}[A-Za-z0-9_.~!*'()+-]*+){2,}+")
RAW_BYTES, BYTES = re.compile(r"\x1f\x8b\x08|x[\x01\x9c\xda]|BZh[1-9]1AY|\xfd7zXZ\0|PK\x03\x04"), re.compile(r"[\0-\xff]*+")
#: Where a compressed blob may begin.
PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\0|PK\x03\x04")
#: Characters of a run for so many of its bytes.
BASE64_RATE, HEX_RATE, BYTE_RATE = (4, 3), (2, 1), (1, 1)
#: Blobs are unpacked and scanned in blocks of about so many bytes, cut behind what no encoded run holds. Each repeats so much of the one before.
BLOCK, OVERLAP = 4 << 20, 4096
CUT = re.compile(rb"\0\0|[^A-Za-z0-9+/_=%\\&#;\s>{}\0-]")


def scan(text: str) -> list[tuple[str, int, int]]:
    """The spans (kind, start, end) of one layer, of each kind leftmost and without overlap."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    return found + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def _unpacker(data: bytes):
    """What undoes the compression of data that begins like this, and where the compressed part begins; None if it is of no known format."""
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31), 0
    if data[:1] == b"\x78" and len(data) > 2 and int.from_bytes(data[:2], "big") % 31 == 0:
        return zlib.decompressobj(), 0
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor(), 0
    if data[:6] == b"\xfd7zXZ\0":
        return lzma.LZMADecompressor(), 0
    if data[:4] == b"PK\x03\x04" and data[8:10] == b"\x08\0":
        return zlib.decompressobj(-15), 30 + int.from_bytes(data[26:28], "little") + int.from_bytes(data[28:30], "little")
    return None


class _Unpacking:
    """Undoes compressed blobs, one behind the other, as their bytes come. ``done`` is the length of the whole ones."""

    def __init__(self, unpacker=None):
        self.unpacker, self.rest, self.fed, self.done, self.zip, self.over = unpacker, b"", 0, 0, False, False

    def push(self, block: bytes, more: bool = True) -> Iterator[bytes]:
        """What comes out, block by block, as far as it can be read. The next block is pushed when this one is read off."""
        self.rest, self.fed = self.rest + block, self.fed + len(block)
        while self.rest and not self.over:
            if self.unpacker is None and not self._open(more):
                return
            try:
                while not self.unpacker.eof:
                    out = self.unpacker.decompress(self.rest, BLOCK)
                    self.rest = getattr(self.unpacker, "unconsumed_tail", b"")
                    if out:
                        yield out
                    elif not self.rest:
                        break
            except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
                self.over = True
                return
            if self.unpacker.eof:
                self.rest, self.unpacker = self.unpacker.unused_data, None
                self.done = self.fed - len(self.rest)

    def _open(self, more: bool) -> bool:
        """Begins the next blob; false if there is none, or none yet."""
        if self.zip:  # other records of the archive stand between its members
            at = self.rest.find(b"PK\x03\x04")
            self.rest = self.rest[at:] if at >= 0 else self.rest[-3:]
            if at < 0:
                return False
        self.rest = self.rest.lstrip(b"\0")  # archives are padded with them
        if more and len(self.rest) < 30:
            return False
        opened = _unpacker(self.rest)
        if opened is None:
            self.over = not self.zip
            self.rest = self.rest[4:]
            return self.zip and self._open(more)
        if len(self.rest) < opened[1]:
            return False
        self.unpacker, self.zip = opened[0], opened[1] > 0
        self.rest = self.rest[opened[1] :]
        return True


class _Pieces:
    """Blocks anew, cut only where no encoded run can pass; each begins with the end of the one before."""

    def __init__(self) -> None:
        self.held, self.given = b"", 0  # so much of what is held was given already

    def push(self, block: bytes) -> Iterator[bytes]:
        begin = max(self.given, len(self.held) - 1)
        self.held += block
        if len(self.held) - self.given < BLOCK:
            return
        near = max(begin, len(self.held) - 4096)
        cut = max((m.end() for m in CUT.finditer(self.held, near)), default=0) or max((m.end() for m in CUT.finditer(self.held, begin)), default=0)
        if cut > self.given:
            yield self.held[:cut]
            keep = max(0, cut - OVERLAP)
            self.held, self.given = self.held[keep:], cut - keep

    def last(self) -> Iterator[bytes]:
        if len(self.held) > self.given:
            yield self.held


def _contents(data: bytes, at: int, outer: _Unpacking) -> Iterator[bytes]:
    """The pieces of what a compressed blob holds, and of all compressed layers in it; an archive that holds itself ends.

    Every layer's blocks go on to the next layer as they come, by a worklist, so each is unpacked once however deep it lies.
    """
    chain, pieces, heads = [outer], [], {data[at : at + 4096]}
    todo = [(0, outer.push(data[i : i + BLOCK], i + BLOCK < len(data))) for i in range(at, len(data), BLOCK)][::-1]
    flushed = 0
    while todo or flushed < len(pieces):
        if not todo:
            # Nothing more comes into this layer: its end goes on.
            yield from pieces[flushed].last()
            flushed += 1
            if chain[flushed] is not None:
                todo.append((flushed, chain[flushed].push(b"", False)))
            continue
        level, blocks = todo[-1]
        block = next(blocks, None)
        if block is None:
            todo.pop()
            continue
        if level == len(pieces):
            head = block[:4096]
            pieces.append(_Pieces())
            chain.append(_Unpacking() if _unpacker(head) is not None and head not in heads else None)
            heads.add(head)
        yield from pieces[level].push(block)
        if chain[level + 1] is not None:
            todo.append((level + 1, chain[level + 1].push(block)))


def _texts(data: bytes) -> Iterator[tuple[str, list[tuple[int, int]], int]]:
    """What can be read in a piece of data as ASCII, also in UTF-16: the stretches joined by NULs, the begin and
    length of each in characters, and the bytes of a character."""
    for pattern, first, size in STRETCHES:
        found = list(pattern.finditer(data))
        if found:
            yield "\0".join(m.group()[first::size].decode("ascii") for m in found), [(m.start(), (m.end() - m.start()) // size) for m in found], size


def _from_base64(run: str) -> bytes:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    body = body[:-1] if len(body) % 4 == 1 else body
    return binascii.a2b_base64(body + "=" * (-len(body) % 4))


class _Layer:
    """A text with, for each character, the span of the document it stands for (None: itself), or one span for all."""

    def __init__(self, text: str, starts: list[int] | None = None, ends: list[int] | None = None, whole: tuple[int, int] | None = None):
        self.text, self.starts, self.ends, self.whole = text, starts, ends, whole

    def place(self) -> bytes:
        """What tells a layer from one of the same text that stands elsewhere: its findings have other spans."""
        return repr(self.whole).encode() if self.starts is None else repr((self.starts[:1], self.ends[-1:])).encode()

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.whole:
            return self.whole
        return (start, end) if self.starts is None else (min(self.starts[start:end]), max(self.ends[start:end]))

    def inline(self, pattern: re.Pattern, decode) -> _Layer | None:
        """The layer with each run of the pattern undone; None if there is none to undo."""
        out, starts, ends, at = [], [], [], 0

        def plain(low: int, high: int) -> None:
            out.append(self.text[low:high])
            if self.whole:
                return
            starts.extend(range(low, high) if self.starts is None else self.starts[low:high])
            ends.extend(range(low + 1, high + 1) if self.starts is None else self.ends[low:high])

        for m in pattern.finditer(self.text):
            pieces = decode(m.group())
            if pieces is None:
                continue
            plain(at, m.start())
            for char, low, high in pieces:
                out.append(char)
                if self.whole:
                    continue
                span = self.span(m.start() + low, m.start() + high)
                starts.extend([span[0]] * len(char))
                ends.extend([span[1]] * len(char))
            at = m.end()
        if not at:
            return None
        plain(at, len(self.text))
        return _Layer("".join(out), whole=self.whole) if self.whole else _Layer("".join(out), starts, ends)

    def blobs(self, data: bytes, places: Sequence[int], end: int, rate: tuple[int, int]) -> Iterator[_Layer]:
        """The layers that a decoded run may hold. ``places`` has the place of each of its characters, ``rate`` of which
        make a byte. Uncompressed base64 maps by groups of characters, all else to the run."""
        for text, stretches, size in _texts(data):
            if self.whole or rate != BASE64_RATE:
                yield _Layer(text, whole=self.span(places[0], end))
                continue
            starts, ends, last = [], [], len(places) - 1
            for begin, count in stretches:
                for at in range(begin, begin + count * size, size):
                    span = self.span(places[at * 4 // 3], places[min(last, -(-(at + size) * 4 // 3) - 1)] + 1)
                    starts.append(span[0])
                    ends.append(span[1])
                starts.append(starts[-1])  # the NUL between
                ends.append(ends[-1])
            yield _Layer(text, starts[:-1], ends[:-1])
        behind = 0
        for m in PACKED.finditer(data):
            if m.start() >= behind:
                outer = _Unpacking()
                yield from self._unpacked(data, m.start(), outer, self.span(places[m.start() * rate[0] // rate[1]], end))
                behind = m.start() + outer.done
        if not behind:
            # Deflated data without a header tell nothing of themselves; what makes no sense ends at once.
            yield from self._unpacked(data, 0, _Unpacking(zlib.decompressobj(-15)), self.span(places[0], end))

    @staticmethod
    def _unpacked(data: bytes, at: int, outer: _Unpacking, span: tuple[int, int]) -> Iterator[_Layer]:
        for piece in _contents(data, at, outer):
            for text, _, _ in _texts(piece):
                yield _Layer(text, whole=span)


def _percent(run: str) -> list[tuple[str, int, int]] | None:
    data = bytes.fromhex(run.replace("%", ""))
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        text = data.decode("latin-1")
        return [(c, 3 * i, 3 * i + 3) for i, c in enumerate(text)]
    out, at = [], 0
    for char in text:
        width = 3 * len(char.encode())
        out.append((char, at, at + width))
        at += width
    return out


def _unicode(run: str) -> list[tuple[str, int, int]] | None:
    out = []
    for m in UNICODE_ONE.finditer(run):
        code = m.group(1) or m.group(2)
        if code:
            value = int(code, 16)
            if value > 0x10FFFF:
                return None
            out.append((chr(value) if not 0xD800 <= value < 0xE000 else "\ufffd", m.start(), m.end()))
        else:
            out.append((html.unescape(m.group(3)), m.start(), m.end()))
    return out


def _runs(text: str, one: re.Pattern, wrapped: re.Pattern) -> Iterator[tuple[str, Sequence[int], int]]:
    """Runs of an encoding, each also joined over the ends of its lines: characters, their places, the end."""
    for m in one.finditer(text):
        yield m.group(), range(m.start(), m.end()), m.end()
    if "\n" in text or "\r" in text or "\\n" in text:
        for m in wrapped.finditer(text):
            lines, at = [], m.start()
            for gap in BREAK.finditer(text, m.start(), m.end()):
                lines.append(range(at, gap.start()))
                at = gap.end()
            lines.append(range(at, m.end()))
            yield "".join(text[x.start : x.stop] for x in lines), array("l", itertools.chain.from_iterable(lines)), m.end()


def _below(layer: _Layer) -> Iterator[_Layer]:
    """The layers that come out of one, one at a time: what a blob unpacks to is not held together."""
    made = []
    if "%" in layer.text:
        made.append(layer.inline(PERCENT, _percent))
    if "\\" in layer.text or "&" in layer.text:
        made.append(layer.inline(UNICODE, _unicode))
    yield from (new for new in made if new is not None)
    # A run may begin behind characters that are glued to it, so it is read from each place in a group.
    for run, places, end in _runs(layer.text, BASE64, BASE64_LINES):
        for skip in range(4):
            yield from layer.blobs(_from_base64(run[skip:]), places[skip:], end, BASE64_RATE)
    for run, places, _ in _runs(layer.text, HEX_BYTES, HEX_LINES):
        for skip in range(2):
            size = (len(run) - skip) // 2 * 2
            yield from layer.blobs(bytes.fromhex(run[skip : skip + size]), places[skip:], places[skip + size - 1] + 1, HEX_RATE)
    if "%" in layer.text:
        for m in URL_BYTES.finditer(layer.text):
            data, places, at = urllib.parse.unquote_to_bytes(m.group()), array("l"), m.start()
            while at < m.end():
                places.append(at)
                at += 3 if layer.text[at] == "%" else 1
            if PACKED.search(data):
                yield from layer.blobs(data, places, m.end(), BYTE_RATE)
    behind = 0
    for m in RAW_BYTES.finditer(layer.text):
        if m.start() >= behind:
            behind = BYTES.match(layer.text, m.start()).end()
            yield from layer.blobs(layer.text[m.start() : behind].encode("latin-1"), range(m.start(), behind), behind, BYTE_RATE)


def layers(text: str) -> Iterator[_Layer]:
    """The text and all layers below it, each different one once."""
    todo, seen = [iter([_Layer(text)])], set()
    while todo:
        layer = next(todo[-1], None)
        if layer is None:
            todo.pop()
            continue
        digest = hashlib.sha256(layer.text.encode() + b"\0" + layer.place()).digest()
        if digest not in seen:
            seen.add(digest)
            yield layer
            todo.append(_below(layer))


def find_secrets(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Spans of the text itself, and those together with the ones found below, in order of place and kind."""
    order = lambda x: (x[1], KINDS.index(x[0]), x[2])
    base, every = [], set()
    for depth, layer in enumerate(layers(text)):
        found = scan(layer.text)
        if depth == 0:
            base = sorted(found, key=order)
        every.update((kind, *layer.span(start, end)) for kind, start, end in found)
    return base, sorted(every, key=order)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by the kind that begins it."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPANS = "array<struct<kind:string,start:long,end:long>>"


def scan_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``base`` and ``spans`` (arrays of kind, start, end in code points) and ``redacted``.

    One row for each row, repeated ones included. A null or empty text has no spans. ``redacted`` is
    the text with all spans replaced. Other columns are not carried.
    """
    source = keyed_text(docs, key, text)
    kind = source.schema["key"].dataType.simpleString()
    cell = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_cell = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in spans]
        for keys, texts in text_batches(batches):
            found = [find_secrets(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array([as_cell(b) for b, _ in found], cell), pa.array([as_cell(s) for _, s in found], cell), pa.array([redact(t, s) for t, (_, s) in zip(texts, found)])],
                [key, "base", "spans", "redacted"],
            )

    return source.mapInArrow(run, f"`{key}` {kind}, base {SPANS}, spans {SPANS}, redacted string")


def redact_documents(docs: DataFrame, text: str = "text", chars: str = "n_chars") -> DataFrame:
    """The same rows and columns with all spans of ``text`` replaced and ``chars``, if it is there, to match.

    A null text stays null. All other columns are as they were.
    """
    schema = docs.schema
    plain = [f"c{i}" for i in range(len(schema))]  # any names pass, dots and blanks included
    at, count = schema.names.index(text), schema.names.index(chars) if chars in schema.names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            texts = [None if t is None else redact(t, find_secrets(t)[1]) for t in batch.column(at).to_pylist()]
            columns[at] = pa.array(texts, columns[at].type)
            if count is not None:
                columns[count] = pa.array([None if t is None else len(t) for t in texts], columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, plain)

    numbered = docs.toDF(*plain)
    return numbered.mapInArrow(run, numbered.schema).toDF(*schema.names)
