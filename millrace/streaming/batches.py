"""Output of a stream batch by batch, safe against batches that come twice.

Each batch is written to a folder of its own for each attempt, ``data/batch=<n>/attempt=<id>``.  When
all of it is there, one line is added to the ledger, and only that makes the attempt count.  A batch
that is in the ledger is not written again; if two drivers write one batch at the same time, readers
take the attempt that is smaller.  What a broken attempt leaves behind is never read.  All folders
must be on shared storage.
"""

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType
from pyspark.sql.streaming import StreamingQuery

from .sinks import _writer

LEDGER = "batch bigint, attempt string, row_count bigint, late_count bigint, max_time timestamp"


def batch_ledger(spark: SparkSession, path: str) -> DataFrame:
    """``batch, attempt, row_count, late_count, max_time`` of each committed batch."""
    entries = spark.read.schema(LEDGER).json(
        f"{path}/ledger", recursiveFileLookup=True, timestampFormat=_EXACT)
    chosen = F.min_by(F.struct(*[c for c in entries.columns if c != "batch"]), "attempt")
    return entries.groupBy("batch").agg(chosen.alias("entry")).select("batch", "entry.*")


def batch_writer(spark: SparkSession, path: str) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``: writes a batch and commits it, once however often it comes."""
    return _committing(spark, path, lambda batch, before: batch.withColumn("late", F.lit(False)))


def late_splitter(spark: SparkSession, path: str, time_column: str = "event_time",
                  width: str = "2 minutes", delay: str = "10 minutes"
                  ) -> Callable[[DataFrame, int], None]:
    """Like ``batch_writer``, with rows that come too late put aside.

    A row is late if its window of ``width`` ended at or before the watermark of the batch before:
    the highest time of all batches before, less ``delay``.  That is the rule by which a stream in
    append mode drops rows from windows it has closed.  Rows without time are not late.
    """
    def mark(batch: DataFrame, before: DataFrame) -> DataFrame:
        (top,) = before.agg(F.unix_micros(F.max("max_time"))).first()
        if top is None:
            return batch.withColumn("late", F.lit(False))
        # A stream counts time in milliseconds.
        watermark = F.date_trunc("MILLISECOND", F.timestamp_micros(F.lit(top))) \
            - F.expr(f"INTERVAL {delay}")
        late = _window_end(F.col(time_column), width) <= watermark
        return batch.withColumn("late", F.coalesce(late, F.lit(False)))

    return _committing(spark, path, mark, time_column)


def stream_in_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                      trigger: dict | None = None) -> StreamingQuery:
    """Hand each batch to ``write`` (``batch_writer``, ``late_splitter``)."""
    return _writer(df, trigger, checkpoint).foreachBatch(write).start()


def read_committed(spark: SparkSession, path: str, late: bool | None = False) -> DataFrame:
    """The rows of committed batches, with ``batch``; those on time, the late ones, or all (None).

    Folders of other attempts are pruned by the ledger before files are read.
    """
    rows = spark.read.option("basePath", f"{path}/data").parquet(f"{path}/data")
    if late is not None:
        rows = rows.where(F.col("late") == F.lit(late))
    # One short line for each batch.
    committed = batch_ledger(spark, path).select("batch", "attempt")
    columns = [c for c in rows.columns if c not in ("batch", "attempt", "late")]
    return rows.withColumn("batch", F.col("batch").cast("bigint")).join(
        committed, ["batch", "attempt"], "left_semi").select(*columns, "batch")


def _window_end(time: Column, width: str) -> Column:
    """The end of the window a time is in; unlike ``window`` this keeps rows without time."""
    size = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {width}"))
    micros = F.unix_micros(time.cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, size) + size)


def _committing(spark: SparkSession, path: str, mark: Callable[[DataFrame, DataFrame], DataFrame],
                time_column: str | None = None) -> Callable[[DataFrame, int], None]:
    spark.createDataFrame([], LEDGER).write.mode("append").json(f"{path}/ledger/start")

    def write(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        ledger = batch_ledger(session, path)
        if not ledger.where(F.col("batch") == epoch_id).isEmpty():
            # Computed all the same: what the stream remembers is only kept if the batch is read.
            batch.write.format("noop").mode("overwrite").save()
            return
        attempt = uuid4().hex
        folder = f"{path}/data/batch={epoch_id}/attempt={attempt}"
        mark(batch, ledger.where(F.col("batch") < epoch_id)).write.partitionBy("late").parquet(folder)
        # Counted from what was written, so that the batch is computed once.
        schema = StructType([*batch.schema.fields, StructField("late", BooleanType())])
        written = session.read.schema(schema).parquet(folder)
        top = F.max(time_column).cast("timestamp") if time_column else F.lit(None).cast("timestamp")
        written.agg(F.lit(epoch_id).cast("long").alias("batch"), F.lit(attempt).alias("attempt"),
                    F.count("*").alias("row_count"), F.count_if("late").alias("late_count"),
                    top.alias("max_time")) \
            .write.json(f"{path}/ledger/batch={epoch_id}-{attempt}", timestampFormat=_EXACT)

    return write


# Spark's own format stops at milliseconds.
_EXACT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
