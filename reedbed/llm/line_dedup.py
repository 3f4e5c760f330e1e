"""Lines that stand in several documents, kept in the first one only, as bitmaps of kept lines.

Each line has a key: the line without ASCII white space at its ends, A-Z in lower case. The keys' digests
are dealt out by ranges and sorted within them by document and position, so the first occurrence of a
key leads its run and is carried along it. What comes back is not text but one bit for each line.

Built-in functions only. A key of a large share of all lines would be one long run: such keys are found
by a histogram of the digests first, there are few of them by their share, and their lines never shuffle.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reedbed.llm.common import column, materialize

BLANKS = " \t\n\x0b\x0c\r"
LEAST_CHARS = 10
#: Digests are counted by this many leading bits to find the frequent ones.
RADIX_BITS = 16
#: A key is frequent if it holds more than one part in so many, for each shuffle partition, of all lines.
PARTS = 4


def line_key(line: Column) -> Column:
    """The line as compared with others."""
    bare = F.btrim(line, F.lit(BLANKS))
    # Lower case of all-ASCII text is the same and much faster.
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, ascii_uppercase, ascii_lowercase))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _digests(value: Column, one: str, two: str) -> list[Column]:
    """128 bits of two hashes whose seeds differ."""
    return [F.xxhash64(value).alias(one), F.xxhash64(F.lit(7), value).alias(two)]


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Document, text and the text's digest, which tells rows of a repeated document apart."""
    content = F.coalesce(column(text), F.lit(""))
    return docs.select(column(key).alias("doc"), content.alias("text"), *_digests(content, "t1", "t2"))


def occurrences(keyed: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc, t1, t2, pos, h1, h2) of all lines whose key is long enough."""
    lines = keyed.select("doc", "t1", "t2", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keys = lines.select("doc", "t1", "t2", "pos", line_key(F.col("line")).alias("line")).where(F.length("line") >= least_chars)
    return keys.select("doc", "t1", "t2", "pos", *_digests(F.col("line"), "h1", "h2"))


def frequent(found: DataFrame) -> DataFrame:
    """(h1, h2, first) of the keys with more than their part of all lines, and the least document of each.

    A histogram of leading bits has 65,536 rows at most; only keys in its full slots are then counted. Keys and
    slots of more than one part in n are fewer than n, so both are small at any size of the input.
    """
    spark = found.sparkSession
    slot = F.call_function("shiftrightunsigned", F.col("h1"), F.lit(64 - RADIX_BITS))
    histogram = materialize(found.groupBy(slot.alias("slot")).agg(F.count("*").alias("n")), "line-slots")
    total = histogram.agg(F.sum("n")).first()[0] or 0
    least = total // (PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))) + 1
    full = F.broadcast(histogram.where(F.col("n") > least).select("slot"))
    counted = found.withColumn("slot", slot).join(full, "slot", "left_semi").groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc").alias("first"))
    return materialize(counted.where(F.col("n") > least).select("h1", "h2", "first"), "frequent-lines")


def repeats(found: DataFrame) -> DataFrame:
    """The occurrences of keys that an earlier document holds; documents without an id come last and count as one."""
    often = F.broadcast(frequent(found))
    other = ~F.col("doc").eqNullSafe(F.col("first"))
    hot = found.join(often, ["h1", "h2"]).where(other)
    order = Window.partitionBy("h1", "h2").orderBy(F.col("doc").asc_nulls_last(), "pos")
    # The window's groups are those of the ranges, so it sorts within them and deals nothing out again.
    dealt = found.join(often, ["h1", "h2"], "left_anti").repartitionByRange("h1", "h2")
    rest = dealt.withColumn("first", F.first("doc").over(order)).where(other)
    return hot.select("doc", "t1", "t2", "pos").unionByName(rest.select("doc", "t1", "t2", "pos"))


def bitmaps(gone: DataFrame) -> DataFrame:
    """(doc, t1, t2, n_dropped, keep): 64 lines to a number, bit ``i % 64`` of number ``i / 64`` set if line i stays."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos").bitwiseAND(F.lit(63)))
    words = gone.groupBy("doc", "t1", "t2", F.call_function("shiftright", F.col("pos"), F.lit(6)).alias("word")).agg(F.bit_or(bit).alias("bits"))
    held = words.groupBy("doc", "t1", "t2").agg(F.sum(F.bit_count("bits")).alias("n_dropped"), F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))
    before = F.concat(F.array(F.lit(-1)), F.transform("words", lambda w: w["word"]))
    all_kept = F.lit(-1).cast("long")
    filled = F.zip_with("words", before, lambda w, b: F.when(w.isNull(), F.array().cast("array<long>")).otherwise(F.concat(F.array_repeat(all_kept, w["word"] - b - 1), F.array(F.bitwise_not(w["bits"])))))
    return held.select("doc", "t1", "t2", "n_dropped", F.flatten(filled).alias("keep"))


def kept_text(text: Column, keep: Column) -> Column:
    """The text's lines whose bit in ``keep`` is set; lines behind the bitmap's end stay. ``keep`` must be a plain column."""

    def stays(_, i: Column) -> Column:
        word = F.coalesce(F.get(keep, F.call_function("shiftright", i, F.lit(6))), F.lit(-1).cast("long"))
        return F.call_function("shiftright", word, i.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1)) == 1

    return F.when(keep.isNull(), text).otherwise(F.array_join(F.filter(_lines(text), stays), "\n"))


def line_bitmaps(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """``key``, ``text``, ``n_lines``, ``n_dropped`` and ``keep`` of every row.

    A key of ``least_chars`` code points or more that several documents hold loses all its lines but those of the
    document of the smallest ``key``. ``keep`` is null where no line goes, and ends with the last number
    that has one; whoever needs no text leaves the column unread. A null or empty text is one empty line.
    Rows with the same key are one document and each keeps its own bitmap; equal rows have equal ones.
    Documents whose key is null count as one, behind all others. Other columns are not carried.
    """
    keyed = _keyed(docs, key, text)
    found = materialize(occurrences(keyed, least_chars), "line-digests")
    marked = materialize(bitmaps(repeats(found)), "line-bitmaps")
    right = marked.select(F.col("doc").alias("doc_"), F.col("t1").alias("t1_"), F.col("t2").alias("t2_"), "n_dropped", "keep")
    same = F.col("doc").eqNullSafe(F.col("doc_")) & (F.col("t1") == F.col("t1_")) & (F.col("t2") == F.col("t2_"))
    placed = keyed.withColumn("n_lines", F.size(_lines(F.col("text"))).cast("long")).join(right, same, "left")
    return placed.select(F.col("doc").alias(key), "text", "n_lines", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep")
