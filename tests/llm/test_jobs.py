"""The registered queries and the pipeline on the smallest tables."""

import random
from pathlib import Path

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

from reedbed.llm import near_dup, secret_scan
from reedbed.llm.common import parted
from reedbed.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", QUERIES)
def test_query_rows(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    many = {"op1_preference_pairs": "conversations", "op9_main_text": "pages"}.get(name, "documents")
    if name not in ("op1_preference_pairs", "op2_benchmark_leaks", "op4_training_order", "op11_hard_negatives"):
        assert len(rows) == spark.read.parquet(f"{sf_dir}/{many}.parquet").count()
    if name in ORACLES:
        db = duckdb.connect()
        for name_of in ("benchmark", "conversations", "documents", "embeddings"):
            db.execute(f"CREATE VIEW {name_of} AS SELECT * FROM '{sf_dir}/{name_of}.parquet'")
        found = db.execute(ORACLES[name])
        names = [d[0] for d in found.description]
        assert sorted(map(str, (tuple(r[n] for n in names) for r in rows))) == sorted(map(str, found.fetchall()))


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    bench = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = docs
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], ("language", "near_duplicates", "benchmark_leaks", "secrets"), strict=True):
        assert name == want
        kept = corpus_pipeline.materialize(stage(spark, kept, sf_dir), "test-stage")
        assert kept.schema.simpleString() == docs.schema.simpleString()
    ids = {r.doc_id for r in kept.collect()}
    labels = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs.where(F.col("text").rlike(r"\p{L}"))).collect()}
    want = {d for d, c in labels.items() if d == c and not any(b in texts[d] for b in bench)}
    assert ids == want
    assert all(r.text == secret_scan.redact(texts[r.doc_id], secret_scan.find_secrets(texts[r.doc_id])[1]) for r in kept.collect())
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()} == ids


@pytest.fixture
def shuffled(spark):
    """Runs a job as one over large tables, whose joins shuffle both sides; gives its rows and the MB it shuffled."""
    name, places = "spark.sql.autoBroadcastJoinThreshold", list(spark._jsparkSession.sparkContext().env().blockManager().diskBlockManager().localDirsString())
    held = lambda: {f: f.stat().st_size for p in places for f in Path(p).rglob("shuffle_*.data")}
    before = spark.conf.get(name)

    def run(stage, docs, folder):
        old = held()
        rows = stage(spark, docs, folder).collect()
        return rows, sum(size for f, size in held().items() if f not in old) / 1e6

    spark.conf.set(name, "-1")
    yield run
    spark.conf.set(name, before)


def test_stages_shuffle_only_documents_that_may_go(spark, tmp_path, shuffled):
    rng = random.Random(1)
    # Five words, so one shingle, of many characters that cannot be compressed.
    plain = [" ".join(rng.randbytes(4000).hex() for _ in range(5)) for _ in range(150)]
    leak = "a passage of the benchmark that some of the documents hold"
    docs = [(i, t) for i, t in enumerate(plain)] + [(1000 + i, plain[i].upper()) for i in range(6)] + [(None, plain[0]), (None, plain[1])]
    docs += [(2000, plain[20] + "0")] * 3 + [(2001, None)] * 2 + [(2002, " ")] * 2 + [(None, None)] * 2 + [(3000, f"{plain[30]} {leak}")]
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs, total = spark.read.parquet(f"{tmp_path}/documents.parquet"), sum(len(t or "") for _, t in docs) / 1e6
    ids = lambda rows: sorted(((r.doc_id, r.text) for r in rows), key=str)
    whole = [*enumerate(plain)]

    unique, moved = shuffled(corpus_pipeline.deduplicated, docs, str(tmp_path))
    ones = [(2000, plain[20] + "0"), *[(2001, None), (2002, " "), (None, None)] * 2, (3000, f"{plain[30]} {leak}")]
    assert ids(unique) == sorted([*whole, *ones], key=str)
    assert moved < total / 2

    clean, moved = shuffled(corpus_pipeline.decontaminated, docs, str(tmp_path))
    assert ids(clean) == ids(docs.where("doc_id IS NULL OR doc_id <> 3000").collect())
    assert moved < total / 20


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_scan_long_texts_in_small_batches(spark, sf_dir, name, stage):
    setting, docs = "spark.sql.parquet.columnarReaderBatchSize", spark.read.parquet(f"{sf_dir}/documents.parquet").limit(5)
    before = spark.conf.get(setting, None)
    try:
        spark.conf.unset(setting)
        stage(spark, docs, sf_dir)
        assert spark.conf.get(setting) == "512"
        spark.conf.set(setting, "100")
        stage(spark, docs, sf_dir)
        assert spark.conf.get(setting) == "100"
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def test_rows_parted_by_a_bitmap(spark):
    schema = "a long, b string"
    rows = spark.createDataFrame([(i if i % 10 else None, None if i % 7 == 0 else str(i)) for i in range(1000)], schema).withColumn("c", F.lit(1))
    for wanted in ([], [(None, None)], [(i, str(i)) for i in range(1, 300, 2)] + [(None, "20"), (1, None), (7, None)]):
        others, likely = (x.collect() for x in parted(rows, spark.createDataFrame(wanted, schema), "a", "b"))
        assert sorted(others + likely, key=str) == sorted(rows.collect(), key=str)
        assert not {(r.a, r.b) for r in others} & {*wanted}
        assert sum((r.a, r.b) not in {*wanted} for r in likely) < 5
