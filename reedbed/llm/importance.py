"""Importance resampling towards a target: hashed word features, gains of their buckets, Gumbel scores.

Features are runs of words; the bucket of one is the CRC of its bytes. A CRC is linear: each byte adds a
number that depends on the byte and on how far it stands from the feature's end only, and the length adds
a constant. So the CRCs of all features of a batch are one lookup in a table of byte and distance, and one
XOR over spans. Spans longer than the table are cut into blocks from their end and folded together.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from reedbed.llm.common import column, keyed_text, materialize, text_batches

BUCKETS, NGRAMS, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
#: Longest distance from the end that the table holds; bytes looked up at a time.
REACH, AT_ONCE = 128, 1 << 22
POLYNOMIAL = 0xEDB88320
_LOWER = bytes.maketrans(ascii_uppercase.encode(), ascii_lowercase.encode())
_IN_WORD = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
_BLANK = 0x20
_COUNTS = [StructField("n_words", LongType()), StructField("n_features", LongType())]


def _position_table(reach: int) -> np.ndarray:
    """What byte b with d bytes behind it adds to a CRC, at ``[d, b]``."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = (first >> 1) ^ np.where(first & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    table = np.empty((reach, 256), np.uint32)
    table[0] = first
    for d in range(1, reach):
        table[d] = (table[d - 1] >> 8) ^ first[table[d - 1] & 0xFF]
    return table


_TABLE = _position_table(REACH)
#: The same for the four bytes of a CRC that stands before a whole block: byte k of it at ``[k]``.
_OVER_BLOCK = np.stack([_TABLE[REACH - 1 - k] for k in range(4)])
#: The CRC of so many zero bytes: what the length alone adds.
_ZEROS = np.array([zlib.crc32(bytes(n)) for n in range(REACH + 1)], np.uint32)


def _block_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """What the bytes of each span add; no span is empty or longer than the table. A bounded number of bytes at a time."""
    sizes = ends - starts
    found = np.empty(len(starts), np.uint32)
    upto = np.cumsum(sizes)
    at = 0
    while at < len(starts):
        done = upto[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(upto, done + AT_ONCE, "right")))
        size = sizes[at:stop]
        first = np.cumsum(size) - size
        behind = np.repeat(first + size, size) - 1 - np.arange(size.sum())
        where = np.repeat(ends[at:stop], size) - 1 - behind
        found[at:stop] = np.bitwise_xor.reduceat(_TABLE[behind, data[where]], first)
        at = stop
    return found


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of each span ``data[start:end]``, none of them empty."""
    if not len(starts):
        return np.zeros(0, np.uint32)
    sizes = ends - starts
    blocks = -(-sizes // REACH)
    if blocks.max() == 1:
        return _block_crcs(data, starts, ends) ^ _ZEROS[sizes]
    span = np.repeat(np.arange(len(starts)), blocks)
    last = np.cumsum(blocks)
    to_end = last[span] - 1 - np.arange(len(span))
    block_end = ends[span] - to_end * REACH
    each = _block_crcs(data, np.maximum(starts[span], block_end - REACH), block_end)
    at, folded = last - blocks, np.zeros(len(starts), np.uint32)
    going = np.arange(len(starts))
    for k in range(int(blocks.max())):
        going = going[blocks[going] > k]
        held = folded[going]
        moved = np.zeros(len(going), np.uint32)
        for b in range(4):
            moved ^= _OVER_BLOCK[b, (held >> np.uint32(8 * b)) & np.uint32(0xFF)]
        folded[going] = moved ^ each[at[going] + k]
    long = sizes > REACH
    constant = _ZEROS[np.where(long, 0, sizes)]
    constant[long] = [zlib.crc32(bytes(int(n))) for n in sizes[long]]
    return folded ^ constant


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts with one blank behind each: the bytes, where words start and end, and whose they are."""
    raw = [t.encode().translate(_LOWER) for t in texts]
    data = np.frombuffer(b"\0".join([*raw, b""]), np.uint8)
    inside = np.append(_IN_WORD[data], False)
    keep = inside[:-1].copy()
    keep[1:] |= inside[:-2]
    edges = np.diff(np.concatenate([[False], inside]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    owner = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), starts, "right")
    # One byte behind each word stays, as the blank.
    sizes = ends - starts
    packed = np.where(inside[:-1], data, np.uint8(_BLANK))[keep]
    moved = np.cumsum(sizes + 1) - sizes - 1
    return packed, moved, moved + sizes, owner


def features(texts: list[str], ngrams: int = NGRAMS, buckets: int = BUCKETS) -> tuple[np.ndarray, list[np.ndarray]]:
    """The number of words of each text, and the buckets of the features of each."""
    data, starts, ends, owner = _words(texts)
    counts = np.bincount(owner, minlength=len(texts))
    found, whose = [], []
    for n in range(1, ngrams + 1):
        if len(starts) < n:
            break
        whole = owner[n - 1 :] == owner[: len(owner) - n + 1]
        one, two = starts[: len(starts) - n + 1][whole], ends[n - 1 :][whole]
        found.append(span_crcs(data, one, two) % np.uint32(buckets))
        whose.append(owner[: len(owner) - n + 1][whole])
    if not found:
        return counts, [np.zeros(0, np.uint32)] * len(texts)
    every, texts_of = np.concatenate(found), np.concatenate(whose)
    order = np.argsort(texts_of, kind="stable")
    return counts, np.split(every[order], np.cumsum(np.bincount(texts_of, minlength=len(texts)))[:-1])


def featured(docs: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> DataFrame:
    """(key, text) to (key, n_words, n_features, packed): the buckets of all features as little-endian 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_batches(batches):
            counts, each = features(texts, ngrams, buckets)
            columns = [keys, pa.array(counts, pa.int64()), pa.array([len(e) for e in each], pa.int64()), pa.array([e.astype("<u4").tobytes() for e in each], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_words", "n_features", "packed"])

    return docs.mapInArrow(run, StructType([docs.schema["key"], *_COUNTS, StructField("packed", BinaryType())]))


def bucket_counts(packed: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all rows. Each task sends one row for each bucket it has seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for held in batch.column("packed"):
                total += np.bincount(np.frombuffer(held.as_buffer(), "<u4"), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["bucket", "n"])

    return packed.select("packed").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket, from the (bucket, n) of both sides; ``buckets`` rows."""
    spark = source.sparkSession
    counted = spark.range(buckets).withColumnRenamed("id", "bucket")
    for side, name in ((source, "s"), (target, "t")):
        counted = counted.join(F.broadcast(side.withColumnRenamed("n", name)), "bucket", "left").fillna(0, [name])
    counted = materialize(counted, "bucket-counts")
    totals = counted.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    more = F.lit(buckets).cast("double")
    up = (F.col("t") + 1).cast("double") * (F.lit(totals["s"]).cast("double") + more)
    down = (F.col("s") + 1).cast("double") * (F.lit(totals["t"]).cast("double") + more)
    return counted.select("bucket", F.floor(F.lit(1000.0) * F.log(up / down)).alias("gain"))


def _weighed(packed: DataFrame, table: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = [int(table[np.frombuffer(held.as_buffer(), "<u4")].sum()) for held in batch.column("packed")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight, pa.int64())], ["key", "n_words", "n_features", "weight"])

    out = StructType([packed.schema["key"], *_COUNTS, StructField("weight", LongType())])
    return packed.select("key", "n_words", "n_features", "packed").mapInArrow(run, out)


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the digest of seed and key; a null key counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def ranked(scored: DataFrame, percent: int) -> DataFrame:
    """``rank`` of the best ``percent`` of the rows that are ``eligible``, null for all others.

    Rows are dealt out by ranges of (eligible, score, key) and numbered within their range; a range's first number
    comes from the counts of those before it, one row for each range. No task holds more than its range.
    """
    order = [F.col("eligible").desc(), F.col("score").desc(), F.col("key").asc_nulls_last()]
    # The number of a row within its partition is the low 33 bits of this id; written, as it depends on the order.
    dealt = scored.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    dealt = materialize(dealt, "ranges").withColumn("range", F.call_function("shiftright", F.col("at"), F.lit(33)))
    sizes = dealt.groupBy("range").agg(F.count("*").alias("n"), F.count_if("eligible").alias("eligible")).orderBy("range").collect()
    most, before, first = sum(r["eligible"] for r in sizes) * percent // 100, 0, []
    for r in sizes:
        first.append((r["range"], before))
        before += r["n"]
    offsets = F.broadcast(scored.sparkSession.createDataFrame(first, "range long, before long"))
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return dealt.join(offsets, "range").withColumn("rank", F.when(F.col("eligible") & (rank <= most), rank))


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    ngrams: int = NGRAMS, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """``key``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row.

    The gain of a bucket is how much more common it is in ``target`` than in ``docs``; a row's weight is the sum over
    its features, its score that with noise. Of the rows with ``least_words`` words or more, ``percent`` of a hundred are
    drawn by score, ties to the smaller key, a null key last; the others' rank is null. A null or empty text
    has no feature and weight 0. Equal rows have equal scores and ranks of their own. An empty side counts nothing. The gains
    (``buckets`` numbers) go to all tasks. Other columns are not carried.
    """
    packed = materialize(featured(keyed_text(docs, key, text), ngrams, buckets), "features")
    wanted = featured(target.select(F.lit(0).alias("key"), F.coalesce(column(target_text), F.lit("")).alias("text")), ngrams, buckets)
    table = np.zeros(buckets, np.int64)
    for bucket, gain in gains(bucket_counts(packed, buckets), bucket_counts(wanted, buckets), buckets).collect():
        table[bucket] = gain
    weighed = _weighed(packed, table)
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("key"), seed)).withColumn("eligible", F.col("n_words") >= least_words)
    return ranked(scored, percent).select(F.col("key").alias(key), "n_words", "n_features", "weight", "score", "rank")
