"""Fewer files for what a stream has written, while it goes on writing.

The sink's own log says which files count.  A compaction rewrites those that no compaction before it
has taken into a folder of its own, and then notes in one file which ones these were; only that
makes it count.  Readers take the compacted rows and the files that are in no note.  Nothing of the
stream's own output is changed or deleted, as its log goes on naming it.
"""

from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from ..sinks import write_parquet

NOTES = "generation string, file string"


def compact_output(spark: SparkSession, path: str, target: str,
                   partition_by: list[str] | None = None) -> int:
    """Rewrite the files of the stream output ``path`` that are new; returns how many there were.

    ``partition_by`` should be that of the stream; values get few files each.
    """
    done = {row.file for row in _notes(spark, target).collect()}
    new = _files_of(spark, path, done)
    if new:
        generation = uuid4().hex
        rows = spark.read.option("basePath", path).parquet(*new)
        write_parquet(rows, f"{target}/data/generation={generation}", partition_by=partition_by)
        spark.createDataFrame([(generation, file) for file in new], NOTES).coalesce(1) \
            .write.parquet(f"{target}/notes/{generation}")
    return len(new)


def read_compacted(spark: SparkSession, path: str, target: str) -> DataFrame:
    """All rows the stream has written, compacted or not."""
    notes = _notes(spark, target)
    # As many names as the sink's log has, which every reader of the output has to hold.
    done = {row.file for row in notes.collect()}
    rest = _files_of(spark, path, done)
    parts = []
    if done:
        rows = spark.read.option("basePath", f"{target}/data").parquet(f"{target}/data")
        parts.append(rows.join(notes.select("generation").distinct(), "generation", "left_semi")
                     .drop("generation"))
    if rest or not done:
        parts.append(spark.read.option("basePath", path).parquet(*rest) if rest
                     else spark.read.parquet(path))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _notes(spark: SparkSession, target: str) -> DataFrame:
    spark.createDataFrame([], NOTES).write.mode("ignore").parquet(f"{target}/notes/start")
    return spark.read.schema(NOTES).parquet(f"{target}/notes", recursiveFileLookup=True)


def _files_of(spark: SparkSession, path: str, done: set[str]) -> list[str]:
    # The names come as in a URL, and are read as they are.
    return sorted({unquote(name) for name in spark.read.parquet(path).inputFiles()} - done)
