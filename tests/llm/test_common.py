"""What operators share."""

import gc
import time
import types
import weakref

import corpus_pipeline
import pyarrow as pa
from solarspark.llm import bpe, common, toxicity
from solarspark.llm.queries import tokenizer


def test_a_process_keeps_what_one_operator_left():
    sent = types.SimpleNamespace(value=toxicity.Network())
    scorer = weakref.ref(toxicity._scorer(sent))
    assert toxicity._scorer(sent) is scorer()
    loaded = bpe.load(tokenizer("word_bpe_49k.json"))
    gc.collect()
    assert scorer() is None
    assert bpe.load(tokenizer("word_bpe_49k.json")) is loaded
    assert common.kept("other") == {} and common.kept("bpe") == {}


def test_the_pipeline_gets_few_texts_at_once(spark, documents):
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = [spark.conf.get(n) for n in names]

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    try:
        docs = documents([f"text {i}" for i in range(2000)]).coalesce(1)
        found = corpus_pipeline.secrets(spark, docs, "").mapInArrow(sizes, "n bigint").collect()
        assert sum(r.n for r in found) == 2000 and max(r.n for r in found) <= common.TEXTS_AT_ONCE
        spark.conf.set(names[0], 7)
        common.few_at_once(spark)
        assert spark.conf.get(names[0]) == "7"
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def test_staged_tables_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}

    setting, old = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"), shuffled()
    table = common.staged(spark.range(1000).selectExpr("id % 7 k").groupBy("k").count())
    until = time.time() + 20
    while shuffled() - old and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - old
    assert table.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
