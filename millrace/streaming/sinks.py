"""Stream sinks.  All append: a row is written once, a window when it is closed.

``trigger`` takes the arguments of ``DataStreamWriter.trigger`` as a dict, e.g.
``{"processingTime": "1 minute"}``, ``{"continuous": "1 second"}`` or ``{"availableNow": True}``;
without it a batch starts as soon as the last one is done.  ``checkpoint`` must be on storage that
every executor and the next driver can reach; it belongs to one query.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from ..operators.windows import flatten_window
from ..sources.files import read_sse


def stream_to_parquet(df: DataFrame, path: str, checkpoint: str,
                      partition_by: list[str] | None = None, trigger: dict | None = None,
                      files_per_batch: int | None = None) -> StreamingQuery:
    """Append to Parquet files, each batch exactly once.

    ``partition_by`` makes one directory per value, so partition by something coarse: a two-minute
    window start alone makes 720 directories a day.  A count is written by as many tasks as hold its
    state, each with a file per directory; where that is thousands of small files,
    ``files_per_batch`` shuffles the few rows of the closed windows to so many tasks.
    """
    if files_per_batch is not None:
        df = df.repartition(files_per_batch)
    writer = _writer(df, trigger, checkpoint).format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def stream_to_console(df: DataFrame, trigger: dict | None = None,
                      checkpoint: str | None = None, **options) -> StreamingQuery:
    """Print each batch.  A continuous trigger takes projections and filters only, and holds one
    task slot per source partition."""
    return _writer(df, trigger, checkpoint).format("console").options(**options).start()


def kafka_sink(messages: DataFrame, bootstrap_servers: str, topic: str,
               checkpoint: str | None = None, trigger: dict | None = None,
               **options) -> StreamingQuery | None:
    """Send ``key, value`` rows (``operators.encode_messages``) to a topic.

    A batch frame is sent at once, a stream needs ``checkpoint``.  Delivery is at least once.
    """
    options = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic, **options}
    if messages.isStreaming:
        return _writer(messages, trigger, checkpoint).format("kafka").options(**options).start()
    messages.write.format("kafka").options(**options).save()
    return None


def stream_to_jdbc(df: DataFrame, url: str, table: str, checkpoint: str, driver: str,
                   trigger: dict | None = None, **writer_options) -> StreamingQuery:
    """Write each micro-batch to a database table, see ``jdbc_batch_writer``."""
    write = jdbc_batch_writer(url, table, driver, **writer_options)
    return _writer(df, trigger, checkpoint).foreachBatch(write).start()


def jdbc_batch_writer(url: str, table: str, driver: str, user: str | None = None,
                      password: str | None = None, mode: str = "append",
                      max_connections: int | None = None, epoch_column: str | None = None,
                      **options) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``: a window struct is flattened, then the batch is written.

    The default appends.  ``mode="overwrite"`` leaves only the last batch in the table.  A batch that
    is repeated after a failure is written again: ``epoch_column`` adds the batch's number, the same
    in each attempt, so that a key of the table can refuse the second one.
    ``max_connections`` bounds the tasks that write at the same time.
    """
    connection = {"url": url, "dbtable": table, "driver": driver, **options}
    if user is not None:
        connection["user"] = user
    if password is not None:
        connection["password"] = password
    if max_connections is not None:
        connection["numPartitions"] = str(max_connections)

    def write(batch: DataFrame, epoch_id: int) -> None:
        for field in batch.schema.fields:
            if isinstance(field.dataType, StructType) and field.dataType.names == ["start", "end"]:
                batch = flatten_window(batch, field.name)
        if epoch_column is not None:
            batch = batch.withColumn(epoch_column, F.lit(epoch_id).cast("long"))
        batch.write.format("jdbc").options(**connection).mode(mode).save()

    return write


def stream_sse(spark: SparkSession, path: str, write: Callable[[DataFrame, int], object],
               checkpoint: str, trigger: dict | None = None,
               files_per_batch: int = 1000) -> StreamingQuery:
    """Hand the events of captured files to ``write(events, batch number)`` as files are added.

    The stream itself holds file names only, at most ``files_per_batch`` at a time; the files of a
    batch are then read by line in as many tasks as they have splits, see ``sources.read_sse``.  A
    batch may come again after a failure, with the same number and files.
    """
    names = spark.readStream.format("binaryFile").schema(_FILE_NAMES).option(
        "maxFilesPerTrigger", files_per_batch).load(path).select("path")

    def read(batch: DataFrame, epoch_id: int) -> None:
        files = [row.path for row in batch.collect()]
        if files:
            write(read_sse(batch.sparkSession, files), epoch_id)

    return _writer(names, trigger, checkpoint).foreachBatch(read).start()


# The reader's own schema, which a stream has to name; only the path is read.
_FILE_NAMES = "path string, modificationTime timestamp, length long, content binary"


def _writer(df: DataFrame, trigger: dict | None, checkpoint: str | None) -> DataStreamWriter:
    writer = df.writeStream.outputMode("append")
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer
