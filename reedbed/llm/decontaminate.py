"""Benchmark passages in documents, whole or with small edits.

A test item of n characters may differ in a budget of edits. Cut in one piece more than its budget,
at least one piece of it stands unchanged in every copy within the budget. So documents are searched for all pieces
at once, and around each hit Myers' bit-parallel distance, run over the text there with one bit for
each character of the item, tells whether the item ends nearby within its budget.

Texts and items are compared in lower case with runs of white space as one space.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, StructField, StructType

from reedbed.llm.common import column, keyed_text, materialize, text_batches

#: Edits allowed for each character of an item; at most so many pieces of it are looked for.
EDIT_RATE = 0.05
#: Items searched for in one pass over the documents, by their characters: it bounds what a worker holds.
PASS_CHARS = 4_000_000


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def budget(item: str, rate: float = EDIT_RATE) -> int:
    return math.floor(len(item) * rate)


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """The item in ``edits + 1`` pieces of nearly equal length, with their places."""
    cuts = [len(item) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


class Pattern:
    """One item, with the bits of its characters."""

    def __init__(self, item_id, text: str, rate: float):
        self.item_id, self.text, self.edits = item_id, text, budget(text, rate)
        self.bits: dict[str, int] = {}
        for i, char in enumerate(text):
            self.bits[char] = self.bits.get(char, 0) | 1 << i

    def best(self, window: str) -> tuple[int, int]:
        """The least distance of the item to a stretch of the window, and where the first such ends."""
        size = len(self.text)
        full, top = (1 << size) - 1, 1 << (size - 1)
        plus, minus, score = full, 0, size
        least, at = size, 0
        for i, char in enumerate(window, 1):
            equal = self.bits.get(char, 0)
            vertical = equal | minus
            across = (((equal & plus) + plus) ^ plus) | equal
            up, down = minus | (full & ~(across | plus)), plus & across
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up, down = (up << 1) & full, (down << 1) & full
            plus, minus = down | (full & ~(vertical | up)), up & vertical
            if score < least:
                least, at = score, i
                if not least:
                    break
        return least, at


class Matcher:
    """All items of one pass."""

    def __init__(self, items: list[tuple], rate: float = EDIT_RATE):
        self.patterns = [Pattern(i, t, rate) for i, t in items if t]
        self.automaton, places = ahocorasick.Automaton(), {}
        for number, pattern in enumerate(self.patterns):
            for at, piece in pieces(pattern.text, pattern.edits):
                places.setdefault(piece, []).append((number, at))
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def find(self, text: str) -> list[tuple]:
        """(item, least edits) for each item within its budget somewhere in the text, by item."""
        if self.empty:
            return []
        spans: dict[int, list[list[int]]] = {}
        for end, (length, found) in self.automaton.iter(text):
            begin = end + 1 - length
            for number, at in found:
                pattern = self.patterns[number]
                low = max(0, begin - at - pattern.edits)
                high = begin - at + len(pattern.text) + pattern.edits
                held = spans.setdefault(number, [])
                if held and held[-1][0] <= low <= held[-1][1] and low - held[-1][0] <= 4 * len(pattern.text):
                    held[-1][1] = max(held[-1][1], high)
                else:
                    held.append([low, high])
        out = []
        for number, windows in spans.items():
            pattern = self.patterns[number]
            least = min(pattern.best(text[low:high])[0] for low, high in windows)
            if least <= pattern.edits:
                out.append((pattern.item_id, least))
        return sorted(out, key=lambda x: str(x[0]))


def _passes(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """The items, normalised, in lists of at most ``PASS_CHARS`` characters (or one item)."""
    rows = benchmark.select(column(item).alias("item"), column(text).alias("text")).where("text IS NOT NULL").distinct()
    held, size = [], 0
    for row in rows.toLocalIterator():
        made = normalised(row.text)
        if not made:
            continue
        if held and size + len(made) > PASS_CHARS:
            yield held
            held, size = [], 0
        held.append((row.item, made))
        size += len(made)
    if held:
        yield held


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", rate: float = EDIT_RATE) -> DataFrame:
    """``key``, ``item`` and ``edits`` for each item that a document holds within its budget.

    ``edits`` is the least distance to a stretch of the document. Null and blank texts and items match
    nothing; an item too short for an edit must stand there exactly. Repeated documents give a row each,
    repeated items one. No matches: no rows. Other columns are not carried.

    The items of a pass have a bounded size and are broadcast; more items take more passes.
    """
    spark = docs.sparkSession
    source = keyed_text(docs, key, text)
    schema = StructType([StructField(key, source.schema["key"].dataType), StructField(item, benchmark.select(column(item)).schema[0].dataType), StructField("edits", IntegerType())])
    out = None
    for items in _passes(benchmark, item, item_text):
        shared = spark.sparkContext.broadcast(items)
        found = source.mapInArrow(_search(shared, rate, key, item, schema), schema)
        if sum(len(t) for _, t in items) > PASS_CHARS // 2:
            found = materialize(found, "leaks")  # a large pass is over before the next one's items are held
            shared.unpersist()
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def _search(shared, rate: float, key: str, item: str, schema: StructType):
    item_arrow = to_arrow_type(schema[1].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = None
        for keys, texts in text_batches(batches):
            matcher = matcher or Matcher(shared.value, rate)
            at, items, edits = [], [], []
            for i, text in enumerate(texts):
                for found, least in matcher.find(normalised(text)):
                    at.append(i)
                    items.append(found)
                    edits.append(least)
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), pa.array(items, item_arrow), pa.array(edits, pa.int32())], [key, item, "edits"])

    return run
