"""Words of ``documents``."""

from millrace.operators import count_by, words
from millrace.sources import stream_parquet
from millrace.streaming import stream_to_parquet
from millrace.workspace import scratch_path

from .registry import query, table

WORDS = "SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents"


@query("words", WORDS)
def document_words(spark, sf_dir):
    return words(table(spark, sf_dir, "documents"), "text", ("doc_id",))


@query("word_counts", f"SELECT word, count(*) AS n FROM ({WORDS}) GROUP BY word")
def word_counts(spark, sf_dir):
    return count_by(words(table(spark, sf_dir, "documents"), "text"), "word", name="n")


@query("stream_words", WORDS)
def stream_words(spark, sf_dir):
    path = scratch_path(spark, "words")
    # A pattern, since a stream takes a directory and the table may be a single file.
    documents = stream_parquet(spark, f"{sf_dir}/documents.parquet*")
    stream_to_parquet(
        words(documents, "text", ("doc_id",)), path, scratch_path(spark, "checkpoint"),
        trigger={"availableNow": True},
    ).awaitTermination()
    return spark.read.parquet(path)
