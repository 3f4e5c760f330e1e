"""CSV whose quoted fields may hold line breaks, read by byte ranges instead of one task a file.

Quotes stand around fields and doubled inside them, so a line break ends a record exactly where the number of
quotes before it in the file is even. The text source deals files out in blocks. One pass counts the quotes of each
block; the running parity over a file's blocks tells which of them begin inside quotes; a second pass cuts each block into
records. Only the pieces of records that lie over a border, two a block at most, are put together by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reedbed.session import materialize, show_package

PIECE = "file long, block long, part int, opens boolean, is_first boolean, text string"


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, block, value) of each line in the order of the file within a block; blocks are those of the session's split size."""
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return spark.read.option("lineSep", "\n").text(path).select(*place, "value")


def _begin_inside(lines: DataFrame) -> DataFrame:
    """(file, block) of the blocks that begin inside quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    blocks = materialize(lines.groupBy("file", "block").agg((F.sum(quotes) % 2).cast("int").alias("odd")), "csv-blocks")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("before", F.sum("odd").over(before)).where("before % 2 = 1").select("file", "block")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of a task to pieces of records.

    ``part`` is 0 for a whole record, 1 for what a block holds of a record of an earlier one, and 2 for the begin
    of one that does not end here. ``opens`` tells that the record goes on in a later block.
    """
    here, inside, held, started, first = None, False, [], True, False
    out: list[tuple] = []

    def end(goes_on: bool) -> None:
        nonlocal held, started, first
        out.append((*here, (2 if goes_on else 0) if started else 1, goes_on, first, "\n".join(held)))
        held, started, first = [], True, False

    def packed() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string()]
        names = ["file", "block", "part", "opens", "is_first", "text"]
        columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        odd = pc.count_substring(batch.column("value"), '"').to_pylist()
        rows = zip(*(batch.column(c).to_pylist() for c in ("file", "block", "inside", "value")), odd)
        for file, block, begins_inside, line, quotes in rows:
            if (file, block) != here:
                if held:
                    end(True)
                here, inside = (file, block), begins_inside
                started, first = not begins_inside, block == 0
            held.append(line)
            inside ^= bool(quotes % 2)
            if not inside:
                end(False)
        yield packed()
    if held:
        end(True)
        yield packed()


def records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(text, is_first): the records of the files; ``is_first`` marks the first one of a file.

    A line break inside quotes is kept as it is, but in a file whose lines end in carriage return and line feed it is a line
    feed, as Spark's own CSV source has it. Quotes that are open at the end of a file end there.
    """
    show_package(spark)
    lines = _lines(spark, path)
    # 16 bytes for each block that begins inside quotes: 13 MB for 100 TB in blocks of 128 MB if all did. Lines stay in order.
    odd = F.broadcast(_begin_inside(lines).withColumn("_odd", F.lit(True)))
    marked = lines.join(odd, ["file", "block"], "left").select("file", "block", F.coalesce("_odd", F.lit(False)).alias("inside"), "value")
    pieces = materialize(marked.mapInArrow(_cut, PIECE), "csv-records")
    torn = pieces.where("part > 0")
    # A piece belongs to the last record before it that was left open.
    order = Window.partitionBy("file").orderBy("block", "part")
    torn = torn.withColumn("record", F.last(F.when(F.col("part") == 2, F.col("block")), ignorenulls=True).over(order))
    piece = F.struct("block", "text")
    mended = torn.groupBy("file", "record").agg(F.sort_array(F.collect_list(piece)).alias("_p"), F.bool_or("is_first").alias("is_first"))
    mended = mended.select("file", F.array_join(F.col("_p.text"), "\n").alias("text"), "is_first")
    every = pieces.where("part = 0").select("file", "text", "is_first").unionByName(mended)
    # 8 bytes for each file of this kind.
    returns = F.broadcast(every.where(F.col("is_first") & F.col("text").endswith("\r")).select("file", F.lit(True).alias("_returns")).distinct())
    text = F.regexp_replace("text", "\\r$", "")
    return every.join(returns, "file", "left").select(F.when(F.col("_returns"), F.replace(text, F.lit("\r\n"), F.lit("\n"))).otherwise(text).alias("text"), "is_first")


def read_quoted_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Rows of files that all begin with the header of ``schema``; another header is an error. Blank records are skipped.

    Fields are read as Spark's own CSV source reads them, with ``multiLine`` and quotes doubled.
    """
    options = {"escape": '"', "multiLine": "true"}
    texts = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(schema))])
    found = records(spark, path).where(F.trim("text") != "")
    names = F.from_csv(F.regexp_replace("text", "^﻿", ""), texts.simpleString()[7:-1].replace(":", " "), options)
    same = F.lit(True)
    for i, name in enumerate(schema.fieldNames()):
        same = same & F.coalesce(F.lower(names[f"_{i}"]) == name.lower(), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("another header than expected: "), F.col("text"))).cast("boolean")
    rows = found.where(F.when(~F.col("is_first"), True).when(same, False).otherwise(wrong))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    # A generator, so that a record is parsed once and not anew for each column.
    return rows.select(F.inline(F.array(F.from_csv("text", ddl, options))))
