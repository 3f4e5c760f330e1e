"""Byte-level BPE by dynamic programming over prefixes.

For a fixed vocabulary every prefix of a byte string has one BPE encoding, and a sequence of
tokens is the encoding of its bytes exactly if each two neighbours are. So it is enough to keep,
for each prefix, the last token of its encoding: that token is the one suffix of the prefix that
is a token and fits behind the last token of what is left. Bytes added at the end extend the table,
and behind an edit it is filled in again only until it agrees with the old one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from reedbed.llm.common import WHITE, char_classes, code_points, keyed_text, text_batches

#: Fixed value: the pattern for which ``cuts`` finds the matches without a regex engine.
KNOWN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: What that pattern takes off behind an apostrophe.
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")
#: Above any rank.
NEVER = 1 << 40
#: Places for digests of pieces seen once, emptied when a quarter is taken.
PLACES = 1 << 22


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def cuts(text: str) -> np.ndarray:
    """Where the matches of ``KNOWN_PATTERN`` begin, and the length of the text (code points).

    The matches cover a text. They begin where the class of character changes; the last white
    character before other text stands alone or, if it is a space, leads the next match; and an
    apostrophe that begins a match takes one of the known endings with it.
    """
    points = code_points(text)
    if not len(points):
        return np.zeros(1, np.int64)
    kind = char_classes()[points]
    begins = np.ones(len(points), bool)
    begins[1:] = kind[1:] != kind[:-1]
    last = np.flatnonzero((kind[:-1] == WHITE) & (kind[1:] != WHITE))
    begins[last] = True
    begins[last[points[last] == ord(" ")] + 1] = False
    for at in np.flatnonzero((points == ord("'")) & begins).tolist():
        took = 2 if text[at + 1 : at + 2] in SHORT_ENDINGS else 3 if text[at + 1 : at + 3] in LONG_ENDINGS else 0
        if took and at + took <= len(points):
            begins[at + 1] = False
            if at + took < len(points):
                begins[at + took] = True
    return np.append(np.flatnonzero(begins), len(points))


class Bpe:
    """The encoding of one vocabulary. Memory is bounded by ``cached`` pieces and pairs."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = KNOWN_PATTERN, cached: int = 700_000):
        self.ranks, self.cached = ranks, cached
        self.vocabulary = {rank: token for token, rank in ranks.items()}
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        self.reach = max(map(len, ranks))
        #: Gives all tokens that end at each byte; it takes text, so bytes stand as code points below 256.
        self.suffixes = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.suffixes.add_word(token.decode("latin-1"), rank)
        self.suffixes.make_automaton()
        self.other_pattern = None if pattern == KNOWN_PATTERN else regex.compile(pattern)
        self.fits: dict[tuple[int, int], bool] = {}
        self.joined: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.edges: dict[tuple[int, bool], list[tuple[bytes, int]]] = {}
        self.pieces = _Pieces(self)

    def split(self, text: str) -> list[bytes]:
        """The UTF-8 bytes of each match of the pattern."""
        if self.other_pattern:
            return [m.group().encode() for m in self.other_pattern.finditer(text)]
        if not text:
            return []
        data, at = text.encode(), cuts(text)[:-1]
        if len(data) != len(text):
            points = code_points(text)
            width = 1 + (points >= 0x80) + (points >= 0x800).astype(np.int64) + (points >= 0x10000)
            at = (np.cumsum(width) - width)[at]
        # 0xFF is no byte of UTF-8: put before each match it makes them the parts of one split.
        marked = np.full(len(data) + len(at), 0xFF, np.uint8)
        keep = np.ones(len(marked), bool)
        keep[at + np.arange(len(at))] = False
        marked[keep] = np.frombuffer(data, np.uint8)
        return marked[1:].tobytes().split(b"\xff")

    def merged(self, data: bytes, parts_left: int = 1) -> list[int]:
        """Plain BPE: the pair of lowest rank first, the leftmost of equal ones."""
        parts, ranks = [data[i : i + 1] for i in range(len(data))], self.ranks
        while len(parts) > parts_left:
            best, at = min((ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def halves(self, part: bytes) -> tuple[bytes, bytes] | None:
        """The two parts BPE joins last in a token; empty ones for a byte, None if BPE does not give the token."""
        if len(part) == 1:
            return b"", b""
        if part not in self.joined:
            two = self.merged(part, 2)
            whole = len(two) == 2 and self.merged(part) == [self.ranks[part]]
            self.joined[part] = tuple(map(self.vocabulary.get, two)) if whole else None
        return self.joined[part]

    def edge(self, token: int, right: bool) -> list[tuple[bytes, int]]:
        """What stands at one edge of a token while BPE builds it: each part and the rank that takes it up.

        Parts have lower ranks than the token made of them, so BPE makes all tokens of a text in the
        order of ranks. Empty: BPE of the token's bytes does not give the token.
        """
        known = self.edges.get((token, right))
        if known is None:
            part, known, above = self.vocabulary[token], [], NEVER
            while part:
                known.append((part, above))
                above, halves = self.ranks[part], self.halves(part)
                if halves is None:
                    known = []
                    break
                part = halves[right]
            known.reverse()
            self.edges[token, right] = known
        return known

    def fit(self, before: int, token: int) -> bool:
        """Whether BPE of the joined bytes gives these two tokens; ``before`` -1: the token alone.

        It does unless at some time the two parts that meet at the border make a token of a rank
        below those that take them up within their own tokens (the left one goes first at a tie).
        """
        known = self.fits.get((before, token))
        if known is None:
            behind = self.edge(token, False)
            known = bool(behind)
            if known and before >= 0:
                ahead, i, j = self.edge(before, True), 0, 0
                while known:
                    (left, takes_left), (right, takes_right) = ahead[i], behind[j]
                    rank = self.ranks.get(left + right, NEVER)
                    known = not (rank < takes_left and rank <= takes_right and rank < NEVER)
                    if takes_left == takes_right == NEVER:
                        break
                    i, j = (i + 1, j) if takes_left <= takes_right else (i, j + 1)
            if len(self.fits) >= self.cached:
                self.fits = {}
            self.fits[before, token] = known
        return known

    def fill(self, data: bytes, last: list[int], stop: int | None = None) -> None:
        """Bring ``last``, the last tokens of the shorter prefixes of ``data``, up to the first ``stop`` bytes."""
        begin, fits, lengths = len(last), self.fits, self.lengths
        low = max(0, begin + 1 - self.reach)
        last += [-1] * ((len(data) if stop is None else stop) - begin)
        for end, token in self.suffixes.iter(data[low : len(last)].decode("latin-1")):
            end += low
            if last[end] < 0:
                start = end - lengths[token]
                before = last[start] if start >= 0 else -1
                known = fits.get((before, token))
                if known or known is None and self.fit(before, token):
                    last[end] = token
        if min(last[begin:], default=0) < 0:
            raise ValueError("a byte is not in the vocabulary")

    def encode_piece(self, piece: bytes) -> list[int]:
        token = self.ranks.get(piece)
        if token is not None:
            return [token]
        last, end, out = [], len(piece), []
        self.fill(piece, last)
        while end:
            out.append(token := last[end - 1])
            end -= self.lengths[token]
        return out[::-1]

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def append(self, text: str, ids: bytes, more: str) -> bytes:
        """``encode(text + more)`` from ``ids = encode(text)``: only the last two matches can change."""
        pieces = self.split(text)[-2:]
        dropped = sum(len(self.pieces[p]) for p in pieces)
        return ids[: len(ids) - dropped] + self.encode(b"".join(pieces).decode() + more)


class _Pieces(dict):
    """Packed ids by piece; when full, the older half is let go unless it is asked for again.

    A piece is kept when it is seen again, as most are not: it takes a place of one byte first.
    """

    def __init__(self, bpe: Bpe):
        super().__init__()
        self.bpe, self.older, self.once, self.taken = bpe, {}, bytearray(PLACES), 0

    def __missing__(self, piece: bytes) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            packed = np.array(self.bpe.encode_piece(piece), "<u4").tobytes()
            at = hash(piece) % PLACES
            if not self.once[at]:
                if self.taken >= PLACES // 4:
                    self.once, self.taken = bytearray(PLACES), 0
                self.once[at], self.taken = 1, self.taken + 1
                return packed
        if len(self) >= self.bpe.cached // 2:
            self.older = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = packed
        return packed


class Prefixes:
    """The table of one piece: ``last[i]`` is the last token of the encoding of its first i + 1 bytes."""

    def __init__(self, bpe: Bpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.fill(self.data, self.last)

    def edit(self, at: int, removed: int, inserted: bytes) -> int:
        """Put ``inserted`` in place of ``removed`` bytes; the number of entries computed anew.

        An entry depends on the bytes and entries of one longest token before it. Once so many
        entries in a row behind the edit are what they were, all others are too.
        """
        reach, rest = self.bpe.reach, self.last[at + removed :]
        self.data = self.data[:at] + inserted + self.data[at + removed :]
        self.last = self.last[:at]
        done = at + len(inserted)
        while done < len(self.data):
            self.bpe.fill(self.data, self.last, done := min(done + reach, len(self.data)))
            was = done - at - len(inserted)
            if was >= reach and self.last[done - reach :] == rest[was - reach : was]:
                self.last += rest[was:]
                return done - at
        self.bpe.fill(self.data, self.last)
        return len(self.data) - at

    def tokens(self, end: int | None = None) -> list[int]:
        """The encoding of the first ``end`` bytes (all)."""
        end, out = len(self.data) if end is None else end, []
        while end:
            out.append(self.last[end - 1])
            end -= self.bpe.lengths[out[-1]]
        return out[::-1]


_loaded: dict[tuple[str, str], Bpe] = {}


def load(path: str, pattern: str = KNOWN_PATTERN) -> Bpe:
    """The encoder of a ranks file, kept while the worker lives."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Bpe(read_ranks(path), pattern)
    return _loaded[path, pattern]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str = KNOWN_PATTERN, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` (the bytes of the ids).

    One row for each row of the input, repeated ones included. A null text counts as empty; an empty
    text has no ids. Other columns are not carried.
    """
    source = keyed_text(docs, key, text)
    schema = f"`{key}` {source.schema['key'].dataType.simpleString()}, ids binary, decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(ranks_path, pattern)
        for keys, texts in text_batches(batches):
            ids = [bpe.encode(t) for t in texts]
            yield pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.binary()), pa.array([bpe.decode(i) for i in ids], pa.binary())], [key, "ids", "decoded"])

    return source.mapInArrow(run, schema)
