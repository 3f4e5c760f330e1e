"""Training-order files of token ids.

Texts are encoded and cut into sequences of one length, the last of a text filled up. The sequences are
numbered, and a keyed Feistel network, walked until it stays within their number, permutes the numbers: it
gives every sequence its slot in training order without a sort. A slot's file and place are plain arithmetic, as
all records have one size, so a reader starts anywhere and reads on. Sequences are dealt out by ranges of slots, and
each task writes the files of its range one after the other. This takes a few turns, each with its part of the files, so
that only a part of the sequences is in a shuffle at any time.
"""

from __future__ import annotations

import hashlib
import math
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from reedbed.llm.bpe import KNOWN_PATTERN, Bpe, read_ranks
from reedbed.llm.common import keyed_text, materialize, scratch_dir, text_batches
from reedbed.session import passing_shuffles

#: Tokens of a record, records of a file (16 MB), and files of a task where there are very many.
LENGTH, RECORDS, FILES = 256, 32_640, 16
#: Turns in which the files are written; each reads the written sequences once and shuffles its part of them.
TURNS = 2
ROUNDS = 6
_PRIME = np.uint64(0xBF58476D1CE4E5B9)


_loaded: dict[str, LibraryBpe] = {}


class LibraryBpe(Bpe):
    """The same splitting and cache, with new pieces encoded by the tokenizer library: here ids are input, not the method."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__(ranks)
        self.library = tiktoken.Encoding("ranks", pat_str=KNOWN_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode_piece(self, piece: bytes) -> list[int]:
        return self.library._encode_single_piece(piece)


def load(path: str) -> LibraryBpe:
    if path not in _loaded:
        _loaded[path] = LibraryBpe(read_ranks(path))
    return _loaded[path]


def round_keys(key: str) -> list[np.uint64]:
    digest = hashlib.sha512(key.encode()).digest()
    return [np.uint64(int.from_bytes(digest[8 * i : 8 * i + 8], "little")) for i in range(ROUNDS)]


def slots(numbers: np.ndarray, total: int, key: str) -> np.ndarray:
    """The slot of each sequence number: a permutation of the numbers below ``total``.

    The network permutes an even number of bits, fewer than four times the total; a value beyond the total
    is sent through again until it is within.
    """
    half = max(1, math.ceil(math.log2(max(total, 2)) / 2))
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    value = np.asarray(numbers, np.uint64).copy()
    out = np.arange(len(value))
    keys = round_keys(key)
    while len(out):
        left, right = value[out] >> shift, value[out] & mask
        for k in keys:
            mixed = (right + k) * _PRIME
            mixed = (mixed ^ (mixed >> np.uint64(31))) * _PRIME
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        value[out] = (left << shift) | right
        out = out[value[out] >= total]
    return value.astype(np.int64)


def id_width(vocabulary: int) -> int:
    """Bytes of an id: two, or four for vocabularies that need them."""
    return 2 if vocabulary <= 1 << 16 else 4


def stride(length: int, width: int = 2) -> int:
    """Bytes of a record: the number of tokens that count, then the ids, all unsigned little-endian of one width."""
    return width * (length + 1)


def place(slot: int, records: int, length: int, width: int = 2) -> tuple[int, int]:
    """File number and byte offset of a slot."""
    return slot // records, slot % records * stride(length, width)


def shard_name(number: int) -> str:
    return f"shard-{number:06d}.bin"


def read_records(folder: str, first: int, count: int, total: int, records: int = RECORDS, length: int = LENGTH, width: int = 2) -> Iterator[np.ndarray]:
    """The token ids of ``count`` slots from ``first`` on, in training order; a reader resumes by its slot alone."""
    files, root = pa.fs.FileSystem.from_uri(folder)
    slot, end, size = first, min(first + count, total), stride(length, width)
    while slot < end:
        number, offset = place(slot, records, length, width)
        many = min(end - slot, records - slot % records)
        with files.open_input_file(f"{root}/{shard_name(number)}") as file:
            data = np.frombuffer(file.read_at(many * size, offset), f"<u{width}").reshape(many, length + 1)
        for row in data:
            yield row[1 : 1 + row[0]]
        slot += many


def _sequences(source: DataFrame, ranks_path: str, length: int, width: int) -> DataFrame:
    """(key, text) to (key, part, ids); ids are packed. An empty text has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(ranks_path)
        for keys, texts in text_batches(batches):
            at, parts, ids = [], [], []
            for i, text in enumerate(texts):
                packed = np.frombuffer(bpe.encode(text), "<u4").astype(f"<u{width}").tobytes()
                for part, begin in enumerate(range(0, len(packed), width * length)):
                    at.append(i)
                    parts.append(part)
                    ids.append(packed[begin : begin + width * length])
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), pa.array(parts, pa.int64()), pa.array(ids, pa.binary())], ["key", "part", "ids"])

    return source.mapInArrow(run, StructType([source.schema["key"], StructField("part", LongType()), StructField("ids", BinaryType())]))


def unpacked(packed: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """How many ids each element holds, and the ids of all, one after the other."""
    packed = packed.cast(pa.large_binary())
    ends = np.frombuffer(packed.buffers()[1], np.int64)[packed.offset : packed.offset + len(packed) + 1]
    return np.diff(ends) // width, np.frombuffer(packed.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(f"<u{width}")


def _numbered(parts: DataFrame) -> DataFrame:
    """With ``task`` and ``within``, which number the rows of each task: set by the high and low bits of Spark's row id."""
    row = F.monotonically_increasing_id()
    return parts.withColumn("_row", row).select("key", "part", "ids", F.shiftright("_row", 33).alias("task"), F.col("_row").bitwiseAND((1 << 33) - 1).alias("within"))


RESULT = [("part", LongType()), ("slot", LongType()), ("shard", LongType()), ("byte_offset", LongType()), ("n_tokens", IntegerType()), ("ids_crc32", LongType())]


def write_shards(docs: DataFrame, ranks_path: str, folder: str, seed: str = "0", key: str = "doc_id", text: str = "text", records: int = RECORDS, length: int = LENGTH) -> DataFrame:
    """Write all sequences below ``folder`` in training order; one row for each sequence.

    The rows hold ``key``, the ``part`` of the text, its ``slot``, ``shard``, ``byte_offset``, ``n_tokens``
    (without filling, which is zeros) and the checksum of its ids. Null and empty texts have no sequences. Repeated
    rows are sequences of their own. No sequences: no files and no rows. Other columns are not carried. The
    order is that of the seed and of the rows as they are read.

    The sequences are written once, so that a lost executor changes no number. Then they are dealt out by ranges of
    slots, which are even by construction, and sorted. A file is put together by one task, under another name, and
    renamed at the end: a file that is there is whole. A task that is run again skips a file of the same content.

    The files are there when this returns. They are written in ``TURNS`` turns, and the shuffle files of a turn are deleted
    when its files and rows are written.
    """
    spark = docs.sparkSession
    width = id_width(len(read_ranks(ranks_path)))
    source = keyed_text(docs, key, text)
    path = scratch_dir(spark, "sequences")
    numbered = _numbered(_sequences(source, ranks_path, length, width))
    numbered.write.option("compression", "zstd").parquet(path)
    held = spark.read.schema(numbered.schema).parquet(path)
    # One row for each task that made sequences: their offsets are sums over few rows.
    tasks = [(r.task, r.n) for r in held.groupBy("task").agg(F.count("*").alias("n")).orderBy("task").collect()]
    known = np.array([task for task, _ in tasks], np.int64)
    offsets, total = np.cumsum([0, *(n for _, n in tasks)]), sum(n for _, n in tasks)
    shards = -(-total // records)
    schema = StructType([StructField(key, source.schema["key"].dataType), *(StructField(*f) for f in RESULT)])
    if not total:
        return spark.createDataFrame([], schema)

    def assign(low: int, high: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """Adds the slots, and keeps those from ``low`` up to ``high``."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                first = offsets[np.searchsorted(known, batch.column("task").to_numpy())]
                slot = slots(first + batch.column("within").to_numpy(), total, seed)
                here = np.flatnonzero((slot >= low) & (slot < high))
                kept = batch.select(["key", "part", "ids"]).take(pa.array(here))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(slot[here])], ["key", "part", "ids", "slot"])

        return run

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by slot."""
        files, root = pa.fs.FileSystem.from_uri(folder)
        files.create_dir(root)
        now, data, rows = None, None, []

        def finish() -> pa.RecordBatch:
            final, made = f"{root}/{shard_name(now)}", f"{root}/_{shard_name(now)}-{uuid.uuid4().hex}"
            if files.get_file_info(final).size != data.nbytes or files.open_input_file(final).read() != data.tobytes():
                with files.open_output_stream(made) as out:
                    out.write(data.tobytes())
                files.move(made, final)
            table = pa.Table.from_batches(rows)
            slot = table.column("slot").to_numpy()
            at = slot - now * records
            checks = [zlib.crc32(data[i, 1 : 1 + data[i, 0]].tobytes()) for i in at]
            arrays = [table.column("key").combine_chunks(), table.column("part").combine_chunks(), pa.array(slot), pa.array(np.full(len(slot), now, np.int64)), pa.array(at * stride(length, width)), pa.array(data[at, 0].astype(np.int32)), pa.array(checks, pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, ["key", *(name for name, _ in RESULT)])

        for batch in batches:
            slot = batch.column("slot").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(slot // records)) + 1).tolist(), len(slot)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if slot[a] // records != now:
                    if rows:
                        yield finish()
                    now, rows = int(slot[a] // records), []
                    data = np.zeros((min(records, total - now * records), length + 1), f"<u{width}")
                sizes, ids = unpacked(batch.column("ids").slice(a, b - a), width)
                filled = np.zeros((b - a, length), data.dtype)
                filled[np.arange(length) < sizes[:, None]] = ids
                data[slot[a:b] - now * records, 0], data[slot[a:b] - now * records, 1:] = sizes, filled
                rows.append(batch.slice(a, b - a).select(["key", "part", "slot"]))
        if rows:
            yield finish()

    whole = held.select("key", "part", "ids", "task", "within")
    slotted = StructType([*held.select("key", "part", "ids").schema, StructField("slot", LongType())])
    least = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = None
    for turn in range(min(TURNS, shards)):
        first, end = (shards * t // min(TURNS, shards) for t in (turn, turn + 1))
        ranges = min(end - first, max(least, -(-(end - first) // FILES)))
        shard = F.expr(f"slot div {records}L") - first
        dealt = whole.mapInArrow(assign(first * records, end * records), slotted)
        dealt = dealt.repartitionById(ranges, (shard * ranges / F.lit(end - first)).cast("int")).sortWithinPartitions("slot")
        with passing_shuffles(spark):
            written = materialize(dealt.mapInArrow(write, StructType([StructField("key", source.schema["key"].dataType), *schema.fields[1:]])), "slots")
        made = written if made is None else made.unionByName(written)
    return made.toDF(*schema.names)
