"""Token counts from a cache of content digests.

The cache is a table of (content digest, tokenizer digest, tokens). Documents meet it by the digests
alone; only contents it does not know are encoded, each once, and their counts are appended.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reedbed.llm.common import column, text_batches
from reedbed.sources.tables import read_or_empty, write_table

CACHE_LAYOUT = "content string, tokenizer string, tokens long"
_loaded: dict[str, object] = {}


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file, so a changed file never meets old counts."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _counter(path: str):
    if path not in _loaded:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = lambda texts: [len(i) for i in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            _loaded[path] = lambda texts: [len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)]
    return _loaded[path]


def encode_counts(contents: DataFrame, path: str) -> DataFrame:
    """(key, text) to (key, tokens), every text encoded whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for keys, texts in text_batches(batches, 500_000):
            yield pa.RecordBatch.from_arrays([keys, pa.array(count(texts), pa.int64())], ["key", "tokens"])

    return contents.mapInArrow(run, "key string, tokens long")


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes`` and ``n_tokens`` of every row; appends what was missing to the table ``cache``.

    The normalised content is the text with null as empty: any further change of the text could change
    its count. Repeated rows and equal texts give one encoding and a row each. Equal texts are dropped
    before the shuffle by the partial aggregate, so a text of a third of all rows is sent once by each
    task. A cache written twice by two runs at once holds equal counts; one of them is used. Other
    columns are not carried.
    """
    spark, version = docs.sparkSession, tokenizer_version(tokenizer)
    content = F.coalesce(column(text), F.lit(""))
    keyed = docs.select(column(key).alias(key), content.alias("_text"), F.octet_length(content).cast("long").alias("n_bytes"), F.sha2(content, 256).alias("content"))

    def known() -> DataFrame:
        stored = read_or_empty(spark, cache, CACHE_LAYOUT).where(F.col("tokenizer") == version)
        return stored.groupBy("content").agg(F.max("tokens").alias("n_tokens"))

    misses = keyed.join(known(), "content", "left_anti").groupBy(F.col("content").alias("key")).agg(F.first("_text").alias("text"))
    counted = encode_counts(misses, tokenizer)
    write_table(counted.select(F.col("key").alias("content"), F.lit(version).alias("tokenizer"), "tokens"), cache)
    return keyed.select(key, "n_bytes", "content").join(known(), "content").select(key, "n_bytes", "n_tokens")
