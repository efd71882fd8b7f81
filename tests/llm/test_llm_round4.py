"""What the stages of the pipeline keep in an executor's memory."""

import pyarrow as pa
import pytest

import corpus_pipeline
from millrace.llm import quality

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def largest_batch(spark):
    """The rows of the largest batch that Spark hands to a Python worker in this session."""
    sizes = spark.range(0, 4000, 1, 1).mapInArrow(
        lambda batches: (pa.record_batch({"n": [b.num_rows]}) for b in batches), "n bigint")
    return max(r.n for r in sizes.collect())


@pytest.mark.parametrize("stage", ["language", "near_duplicates"])
def test_stages_hand_few_texts_to_python_at_once(spark, stage):
    own = spark.newSession()
    docs = own.createDataFrame([(i, f"some words of text number {i}", "en") for i in range(40)],
                               "doc_id long, text string, lang string")
    result = dict(corpus_pipeline.STAGES)[stage](own, docs, "")
    assert largest_batch(own) <= corpus_pipeline.TEXTS_AT_ONCE
    assert result.count() <= 40
    assert spark.conf.get(ARROW_ROWS) == "10000"


def test_stages_leave_smaller_batches_as_they_are(spark):
    own = spark.newSession()
    own.conf.set(ARROW_ROWS, 7)
    corpus_pipeline.small_batches(own)
    assert own.conf.get(ARROW_ROWS) == "7"
    own.conf.set(ARROW_ROWS, 0)  # no limit
    corpus_pipeline.small_batches(own)
    assert own.conf.get(ARROW_ROWS) == str(corpus_pipeline.TEXTS_AT_ONCE)


def test_quality_reads_no_rows_of_python_objects(spark, monkeypatch):
    texts = [" ".join(f"w{i}x{k}" for k in range(60 + i)) + "!" * (i % 2 * 30) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, quality int")

    def refuse(*_, **__):
        raise AssertionError("rows of Python objects need Python workers of their own")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refuse)
    model = quality.fit_quality(docs, labels)
    assert model.forest is not None and 0 < model.threshold < 1
