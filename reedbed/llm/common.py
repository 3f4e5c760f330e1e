"""Small helpers shared by the operators of this package.

All operators read the columns they are told to and return the key with their own results, so
further columns of the input, whatever their names, cannot clash with them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reedbed.session import materialize, scratch_dir

__all__ = ["column", "keyed_text", "partitions_for", "materialize", "scratch_dir", "parted", "code_points", "char_classes", "OTHER", "LETTER", "NUMBER", "WHITE", "text_batches", "tokenizer_path"]

OTHER, LETTER, NUMBER, WHITE = 0, 1, 2, 3
#: The bitmap of wanted digests has 64 bits for each of 2 to this power words.
FILTER_WORDS = 18
_classes: list[np.ndarray] = []


def column(name: str) -> Column:
    """The column of exactly this name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def keyed_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """Key and text as ``key`` and ``text``; a null text is an empty one."""
    return df.select(column(key).alias("key"), F.coalesce(column(text), F.lit("")).alias("text"))


def partitions_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Partitions for so many rows, at least as many as a shuffle has."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / rows_each))


def parted(rows: DataFrame, wanted: DataFrame, *names: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose values of these columns ``wanted`` does not hold for sure, and the others, most of which it holds.

    A bitmap of the values' digests goes to all tasks, 2 MB at any size of the input, so a search for exact matches has
    only the others to shuffle. Nulls are values like any other.
    """
    mark = F.xxhash64(*names)
    word, bit = mark.bitwiseAND(F.lit((1 << FILTER_WORDS) - 1)), F.call_function("shiftright", mark, F.lit(FILTER_WORDS)).bitwiseAND(F.lit(63)).cast("int")
    words = wanted.groupBy(word.alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    held = (word == F.col("_word")) & (F.call_function("shiftright", F.col("_bits"), bit).bitwiseAND(F.lit(1)) == 1)
    return rows.join(F.broadcast(words), held, "left_anti"), rows.join(F.broadcast(words), held, "left_semi")


def tokenizer_path(name: str) -> str:
    """The place of a public vocabulary file, the default of the tokenizer parameters."""
    import public_tokenizers

    return public_tokenizers.path(name)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def char_classes() -> np.ndarray:
    """For each code point whether it is a letter, a number, white space or something else."""
    if not _classes:
        table = np.zeros(0x110000, np.uint8)
        # Surrogates are no characters of a text; a blank control stands in for them.
        every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\0" for c in range(0x110000))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\p{White_Space}+")):
            for found in regex.finditer(pattern, every):
                table[found.start() : found.end()] = kind
        _classes.append(table)
    return _classes[0]


def text_batches(batches: Iterator[pa.RecordBatch], most: int = 2_000_000) -> Iterator[tuple[pa.Array, list[str]]]:
    """Keys and texts of at most about ``most`` bytes at a time; one text is never cut."""
    for batch in batches:
        start, held = 0, 0
        sizes = pc.binary_length(batch.column("text")).to_pylist()
        for i, size in enumerate(sizes):
            if i > start and held + size > most:
                part = batch.slice(start, i - start)
                yield part.column("key"), part.column("text").to_pylist()
                start, held = i, 0
            held += size
        if batch.num_rows > start:
            part = batch.slice(start)
            yield part.column("key"), part.column("text").to_pylist()
