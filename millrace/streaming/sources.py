"""Unbounded sources."""

from pyspark.sql import DataFrame, SparkSession


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str,
                 starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None, **options) -> DataFrame:
    """Stream of a Kafka topic in the shape of ``schemas.KAFKA_MESSAGE``.

    ``starting_offsets`` counts for a new checkpoint only: a query with a checkpoint goes on from
    there.  To replay a topic, give ``"earliest"`` and a new checkpoint folder.
    ``max_offsets_per_trigger`` bounds the micro-batches of such a replay, ``min_partitions`` splits
    few or uneven topic partitions over more tasks.  Needs the Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    return reader.options(**options).load()


def line_source(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines of a text socket as column ``value``.

    One reader, and lines lost with it are not sent again: for trying things out.
    """
    return spark.readStream.format("socket").options(host=host, port=port).load()
