"""Files: delimited text, CSV, JSON, event text and Parquet.

Paths are handed to Spark as they are, so any configured file system works.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import AtomicType, StructType

from ..functions import strip


def read_delimited(spark: SparkSession, path: str | list[str], schema: StructType,
                   delimiter: str = ",", date_format: str | None = None,
                   **options) -> DataFrame:
    """Delimited text with a fixed schema and no header; the delimiter may be several characters.

    Columns beyond the schema are dropped, columns a line lacks are NULL, and a cell that does not
    parse is NULL while its row is kept.
    """
    reader = spark.read.schema(schema).option("delimiter", delimiter).options(**options)
    if date_format is not None:
        reader = reader.option("dateFormat", date_format)
    return reader.csv(path)


def read_csv_inferred(spark: SparkSession, path: str | list[str], header: bool = True,
                      infer_schema: bool = True, delimiter: str = ",") -> DataFrame:
    """CSV whose column types are found by reading it all once before; all text if not inferred.

    That first pass is as large as the query itself, so give large inputs a schema
    (``read_delimited``).
    """
    return spark.read.csv(path, sep=delimiter, header=header, inferSchema=infer_schema)


def read_json(spark: SparkSession, path: str | list[str],
              schema: StructType | str | None = None) -> DataFrame:
    """JSON lines.  Without a schema one is inferred by a full pass over the input; a broken line
    then shows up in ``_corrupt_record``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_sse(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Captured event streams as one row of text per event, for ``operators.decode_sse``.

    Files are read by line, so one large file is read by many tasks, and the task that reads a split
    puts its lines together again up to each blank one.  Only the first and the last piece of a split
    may go on in the next one; these few are joined in a second step, for which the files are read
    again, so that no event text is shuffled or stored.  (A reader that cuts at two newlines in a row
    would be simpler, but where a third one follows and a split ends among them it gives the next
    event twice.)
    """
    lines = spark.read.text(path, lineSep="\n")
    # Two sums stand for a file's path, which would be longer than most lines.
    found = lines.select(
        # Bytes, as lines need not be valid text.
        F.col("value").cast("binary").alias("value"),
        (strip(F.col("value")) == "").alias("blank"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.xxhash64(F.lit("second"), F.col("_metadata.file_path")).alias("file_2"),
        F.col("_metadata.file_block_start").alias("split"),
    )
    inside = found.mapInArrow(lambda batches: _pieces(batches, edges=False), "value binary")
    edges = found.mapInArrow(lambda batches: _pieces(batches, edges=True),
                             "value binary, file long, file_2 long, split long, opens boolean") \
        .withColumn("value", F.col("value").cast("string"))
    # At most two pieces per split, so even a huge file leaves little to put in order here.
    in_file = Window.partitionBy("file", "file_2").orderBy("split", "opens")
    over_splits = (
        edges.withColumn("event", F.count_if("opens").over(in_file))
        .groupBy("file", "file_2", "event")
        .agg(_joined("split", "opens", "value"))
    )
    return inside.select(F.col("value").cast("string")).unionByName(over_splits.select("value"))


def _pieces(batches: Iterator[pa.RecordBatch], edges: bool) -> Iterator[pa.RecordBatch]:
    """Lines in their order put together to pieces, each from a blank line up to the next.

    Without ``edges`` the pieces that lie inside a split, as texts.  With ``edges`` the others: the
    lines before the first blank one of a split, which a piece of the split before may go on in, and
    its last piece; ``opens`` tells the two apart.  The open piece goes from batch to batch.
    """
    place: tuple | None = None
    opens, texts = False, []

    def closed(last: bool) -> list[tuple]:
        """The open piece, if it is wanted."""
        at_edge = last or not opens
        return [(b"\n".join(texts), *place, opens)] if at_edge == edges and place else []

    for batch in batches:
        if not batch.num_rows:
            continue
        value, blank, file, file_2, split = batch.columns
        blank = blank.to_numpy(zero_copy_only=False)
        where = [column.to_numpy() for column in (file, file_2, split)]
        new_split = np.zeros(batch.num_rows, dtype=bool)
        for column in where:
            new_split[1:] |= column[1:] != column[:-1]
        here = tuple(int(column[0]) for column in where)
        new_split[0] = here != place
        starts = np.flatnonzero(new_split | blank)
        if not len(starts):
            texts += value.to_pylist()
            continue
        texts += value.slice(0, starts[0]).to_pylist()
        out = closed(bool(new_split[starts[0]]))
        # Pieces that begin and end within the batch.
        last = new_split[starts[1:]]
        at_edge = last | ~blank[starts[:-1]]
        wanted = np.flatnonzero(at_edge == edges)
        if edges:
            for k in wanted:
                start, end = int(starts[k]), int(starts[k + 1])
                out.append((b"\n".join(value.slice(start, end - start).to_pylist()),
                            *(int(column[start]) for column in where), bool(blank[start])))
            yield from _edge_rows(out)
        else:
            joined = pc.binary_join(pa.ListArray.from_arrays(
                pa.array(starts, pa.int32()), value), b"\n").take(pa.array(wanted))
            whole = pa.array([text for text, *_ in out], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([whole, joined])], ["value"])
        start = int(starts[-1])
        place, opens = tuple(int(column[start]) for column in where), bool(blank[start])
        texts = value.slice(start).to_pylist()
    out = closed(True)
    if edges:
        yield from _edge_rows(out)


def _edge_rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
            ["value", "file", "file_2", "split", "opens"])


def _joined(*columns: str) -> Column:
    """The last of the columns, sorted by the others, as lines of one text."""
    rows = F.array_sort(F.collect_list(F.struct(*columns)))
    return F.array_join(F.transform(rows, lambda row: row["value"]), "\n").alias("value")


def stream_parquet(spark: SparkSession, path: str, schema: StructType | None = None,
                   **options) -> DataFrame:
    """A growing directory of Parquet files as a stream; the schema is that of the files there."""
    schema = schema or spark.read.parquet(path).schema
    return spark.readStream.schema(schema).options(**options).parquet(path)


def read_stream_output(spark: SparkSession, path: str, order_by: list[str] | None = None,
                       k: int | None = None) -> DataFrame:
    """What a stream has written, highest ``order_by`` first, with ``k`` only the first k rows.

    Columns may be nested (``window.start``).  Other columns break ties, so that equal counts, which
    are many, spread over the tasks of a full sort.  The sink's own log in the directory keeps files
    of unfinished batches out.
    """
    written = spark.read.parquet(path)
    if order_by:
        ties = [
            field.name for field in written.schema
            if field.name not in order_by and isinstance(field.dataType, AtomicType)
        ]
        written = written.orderBy(*[F.desc(column) for column in order_by], *ties)
    return written if k is None else written.limit(k)
