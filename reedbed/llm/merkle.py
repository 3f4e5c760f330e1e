"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces.

A section is what blank lines part, a paragraph is a line, and a paragraph is cut into pieces behind words
whose own digest says so, which is why an edit moves no cut but its own. A node's digest is that of
its children's digests; equal roots mean equal texts, and where two trees differ, the branches
lead to the edit.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reedbed.llm.common import column, materialize

SECTION = re.compile(r".+?(?:\n[^\S\n]*\n+|\Z)", re.S)
WORD = re.compile(r"\S+\s*|\s+")
#: A piece ends behind one word in so many, as the word's checksum has it.
WORDS_A_PIECE = 8
#: Hex digits of the digests inside a fingerprint; its root is whole.
DIGITS = 10


def _digest(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def pieces(paragraph: str) -> list[str]:
    out, start = [], 0
    for m in WORD.finditer(paragraph):
        if zlib.crc32(m.group().strip().encode()) % WORDS_A_PIECE == 0:
            out.append(paragraph[start : m.end()])
            start = m.end()
    return out + [paragraph[start:]] * (start < len(paragraph))


def tree(text: str) -> list[list[list[str]]]:
    """The text as sections of paragraphs of pieces, which joined give the text."""
    return [[pieces(p) for p in section.splitlines(keepends=True)] for section in SECTION.findall(text)]


def fingerprint(text: str) -> str:
    """``root``, then by section ``;digest``, by paragraph ``,digest`` and by piece ``.digest:length``."""
    out, sections = [], []
    for section in tree(text):
        branch, lines = [], []
        for paragraph in section:
            leaves = [(_digest(p), len(p)) for p in paragraph]
            node = _digest("p" + "".join(d for d, _ in leaves))
            branch.append(node)
            lines.append("," + node[:DIGITS] + "".join(f".{d[:DIGITS]}:{n}" for d, n in leaves))
        sections.append(_digest("s" + "".join(branch)))
        out.append(";" + sections[-1][:DIGITS] + "".join(lines))
    return _digest("r" + "".join(sections)) + "".join(out)


def leaves(mark: str) -> list[tuple[str, int]]:
    """The digest and length of each piece of a fingerprint, in order."""
    return [(d, int(n)) for d, n in re.findall(r"\.([0-9a-f]+):([0-9]+)", mark)]


def likeness(one: str, two: str) -> float:
    """The share of the longer text that lies in pieces both have; 1 exactly for equal roots."""
    if one.split(";", 1)[0] == two.split(";", 1)[0]:
        return 1.0
    a, b = leaves(one), leaves(two)
    both = Counter(a) & Counter(b)
    longer = max(sum(n for _, n in a), sum(n for _, n in b))
    return min(sum(n * k for (_, n), k in both.items()) / max(longer, 1), 1 - 1e-9)


def edits(one: str, two: str) -> list[tuple[int, int]]:
    """Where the second text differs: spans (start, end) of its pieces that lie in no branch of the first.

    Branches with a digest the first fingerprint has are skipped whole.
    """
    known = Counter(re.findall(r"[;,.]([0-9a-f]+)", one))
    out, at = [], 0
    for section in two.split(";")[1:]:
        skip_section = known[section.split(",", 1)[0]] > 0
        for paragraph in section.split(",")[1:]:
            skip = skip_section or known[paragraph.split(".", 1)[0]] > 0
            for digest, size in (x.split(":") for x in paragraph.split(".")[1:]):
                if not skip and not known[digest]:
                    if out and out[-1][1] == at:
                        out[-1] = (out[-1][0], at + int(size))
                    else:
                        out.append((at, at + int(size)))
                at += int(size)
    return out


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fingerprint`` of each row; a null text counts as empty. Other columns are not carried."""
    source = docs.select(column(key).alias("key"), F.coalesce(column(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(marks, pa.string())], [key, "fingerprint"])

    return source.mapInArrow(run, f"`{key}` {source.schema['key'].dataType.simpleString()}, fingerprint string")


RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _bucketed(source: DataFrame, buckets: int) -> DataFrame:
    """With ``bucket``, a number that rises with the key, cut at its approximate quantiles; null keys come first.

    Only the cuts, fewer than ``buckets`` numbers, come to the driver.
    """
    shares = [i / buckets for i in range(1, buckets)]
    cuts = source.select(F.percentile_approx("key", shares, 100_000).alias("cuts")).first().cuts or []
    splits = [-math.inf, *sorted({float(c) for c in cuts or [0]}), math.inf]
    held = source.withColumn("_at", F.col("key").cast("double"))
    cut = Bucketizer(splits=splits, inputCol="_at", outputCol="_cut", handleInvalid="keep").transform(held)
    return cut.select("key", "text", F.when(F.col("key").isNull(), -1).otherwise(F.col("_cut").cast("int")).alias("bucket"))


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text (``edited``) and their likeness, also to the next text.

    The next document is that of the next higher key (and text, where keys repeat; null keys come first);
    the last one is followed by the first. A single document follows itself. One row for each row; keys
    are numbers. Other columns are not carried.

    The texts are shuffled once, into ranges of the key, where each row meets the next. The last row of a
    range meets the first of the next one beside that: two rows for each range, found by partial aggregates.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = _bucketed(docs.select(column(key).alias("key"), F.coalesce(column(text), F.lit("")).alias("text")), 3 * tasks)
    schema = f"key {source.schema['key'].dataType.simpleString()}, {RESULT}"
    names = ["key", *(x.split()[0] for x in RESULT.split(", "))]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def compared(keys: pa.Array, texts: list[tuple[str, str]], marks: list[tuple[str, str]]) -> pa.RecordBatch:
        rows = []
        for (one, two), (mark, next_mark) in zip(texts, marks):
            new = edited(one, two)
            new_mark = mark if new == one else fingerprint(new)
            rows.append((len(one), hashlib.sha256(new.encode()).hexdigest(), mark, new_mark, likeness(mark, new_mark), likeness(mark, next_mark)))
        return pa.RecordBatch.from_arrays([keys, *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))], names)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All rows but the last of each range, each with the next one."""
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, buckets = batch.column("text").to_pylist(), batch.column("bucket").to_pylist()
            marks, keys = [fingerprint(t) for t in texts], batch.column("key")
            if last and last[0] == buckets[0]:
                yield compared(last[1], [(last[2], texts[0])], [(last[3], marks[0])])
            met = [i for i in range(len(texts) - 1) if buckets[i] == buckets[i + 1]]
            yield compared(keys.take(pa.array(met, pa.int64())), [(texts[i], texts[i + 1]) for i in met], [(marks[i], marks[i + 1]) for i in met])
            last = buckets[-1], keys.slice(len(texts) - 1), texts[-1], marks[-1]

    def border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(zip(batch.column("text").to_pylist(), batch.column("next_text").to_pylist()))
            yield compared(batch.column("key"), texts, [(fingerprint(a), fingerprint(b)) for a, b in texts])

    ends = source.groupBy("bucket").agg(F.min(F.struct("key", "text")).alias("first"), F.max(F.struct("key", "text")).alias("last"))
    ends = materialize(ends, "merkle-ends")
    numbers = ends.groupBy().agg(F.sort_array(F.collect_list("bucket")).alias("every")).select(F.posexplode("every").alias("at", "bucket"), "every")
    follows = numbers.select("bucket", F.element_at("every", (F.col("at") + 1) % F.size("every") + 1).alias("next"))
    firsts = ends.select(F.col("bucket").alias("next"), F.col("first.text").alias("next_text"))
    lasts = ends.select("bucket", "last.key", "last.text").join(follows, "bucket").join(firsts, "next").select("key", "text", "next_text")
    rows = source.repartition(tasks, "bucket").sortWithinPartitions("bucket", "key", "text").mapInArrow(inside, schema)
    return rows.unionByName(lasts.mapInArrow(border, schema)).withColumnRenamed("key", key)
