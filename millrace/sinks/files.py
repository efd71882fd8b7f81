"""Batch output to files."""

import logging
import os
import re
import shutil

from pyspark.sql import DataFrame, SparkSession

from millrace.workspace import scratch_path

logger = logging.getLogger(__name__)

#: Bytes that one task copies into a shared file.
COPIED = 64 << 20


def write_csv(df: DataFrame, path: str, mode: str = "overwrite",
              num_files: int | None = None, sort_by: list[str] | None = None) -> None:
    """CSV with a header; logs start and end, logs and re-raises a failure.

    By default each task writes its own file.  ``num_files`` shuffles the finished rows into that
    many files, so what comes before keeps its parallelism (a ``coalesce`` would not).  ``sort_by``
    orders the rows within and across the files.

    One unsorted file in a mounted folder is written by many tasks, see ``write_one_csv``.  With
    other file counts or orders, and in stores whose files cannot be written from several places,
    each file is written by one task, so there few files are for small results.
    """
    write = None
    if num_files == 1 and not sort_by and all(
            mounted(df.sparkSession, p) for p in (path, scratch_path(df.sparkSession, "csv"))):
        write = write_one_csv
    elif sort_by:
        parts = [] if num_files is None else [num_files]
        df = df.repartitionByRange(*parts, *sort_by).sortWithinPartitions(*sort_by)
    elif num_files is not None:
        df = df.repartition(num_files)
    logger.info("writing CSV to %s", path)
    try:
        if write:
            write(df, path, mode)
        else:
            df.write.csv(path, mode=mode, header=True)
    except Exception:
        logger.exception("writing CSV to %s failed", path)
        raise
    logger.info("wrote CSV to %s", path)


def mounted(spark: SparkSession, path: str) -> bool:
    """Whether the path is one of the ordinary file system."""
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    if scheme is None:
        default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
        scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", default or "file:")
    return scheme is not None and scheme[1].lower() == "file"


def plain_path(path: str) -> str:
    """A path of the ordinary file system without ``file:``."""
    return re.sub(r"^file:(//)?(?=/)", "", path)


def write_one_csv(df: DataFrame, path: str, mode: str) -> None:
    """One CSV file with a header, written by as many tasks as ``df`` has.

    Each task stores its rows as a piece under the checkpoint folder; then stretches of the pieces
    are copied to their own places in the file, which gets its name when it is whole.  Spark's writer makes the
    folder and the header, so it decides what ``mode`` means.
    """
    spark = df.sparkSession
    pieces = scratch_path(spark, "csv-pieces")
    df.write.csv(pieces, header=False)
    folder = plain_path(path)
    there = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    spark.createDataFrame([], df.schema).coalesce(1).write.csv(path, mode=mode, header=True)
    new = [name for name in os.listdir(folder) if name.endswith(".csv") and name not in there]
    if not new:
        return  # the mode is to leave what is there
    (name,) = new
    target, whole = os.path.join(folder, name), os.path.join(folder, f"_{name}")
    shutil.copyfile(target, whole)
    found = spark.read.format("binaryFile").load(pieces).select("path", "length").collect()
    offset, places = os.path.getsize(target), []
    for piece, length in sorted(found, key=lambda r: int(re.search(r"part-(\d+)", r.path)[1])):
        places += [(plain_path(piece), begin, min(COPIED, length - begin), offset + begin)
                   for begin in range(0, length, COPIED)]
        offset += length

    def put(place: tuple[str, int, int, int]) -> None:
        piece, begin, left, start = place
        with open(piece, "rb") as source, open(whole, "r+b") as out:
            source.seek(begin)
            out.seek(start)
            while left:
                some = source.read(min(left, 1 << 20))
                if not some:
                    raise OSError(f"{piece} is shorter than it was")
                out.write(some)
                left -= len(some)
            out.flush()
            os.fsync(out.fileno())

    if places:
        spark.sparkContext.parallelize(places, len(places)).foreach(put)
    # The checksum that Spark's writer kept is that of the header alone.
    checksum = os.path.join(folder, f".{name}.crc")
    if os.path.exists(checksum):
        os.remove(checksum)
    os.replace(whole, target)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None, cluster: bool = True) -> None:
    """Parquet, with ``partition_by`` in one directory per value; NULL has a directory of its own.

    Rows are first brought together by those columns, or every task would write a file in every
    directory.  The rebalance hint lets adaptive execution split a value that holds much of the
    data over several tasks and merge the small ones.  ``cluster=False`` skips that shuffle.
    Overwriting replaces all partitions unless ``spark.sql.sources.partitionOverwriteMode`` is
    dynamic.
    """
    if partition_by and cluster:
        df = df.hint("rebalance", *partition_by)
    df.write.parquet(path, mode=mode, partitionBy=partition_by)
