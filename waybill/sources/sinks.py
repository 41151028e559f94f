"""Writers: intermediate tables in shared scratch, single files, and their removal."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


#: Files that a task writing partitions keeps open before it sorts instead.
OPEN_FILES = 8
#: Stored bytes that a task of ``packed`` reads at least, where there are as many.
FILE_BYTES = 32 << 20


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables in the cluster's shared storage: the one that
    ``spark.checkpoint.dir`` names or, where it is unset, the session's warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
    unique = spark.sparkContext.applicationId
    return f"{shared.rstrip('/')}/waybill-{unique}-{os.urandom(4).hex()}"


def staged(df: DataFrame, folder: str, name: str, by: str | None = None) -> DataFrame:
    """Write ``df``, a partition for each value of ``by`` if given, and continue from the
    written table.

    Cuts the lineage for good: a lost executor costs a re-read, not a recomputation.
    """
    path = f"{folder}/{name}"
    writer = df.write.mode("overwrite")
    if by:
        # A task keeps a file open for each of the few values instead of sorting by them.
        df.sparkSession.conf.set("spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES)
        writer = writer.partitionBy(by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _located(spark: SparkSession, path: str):
    """A path's file system, under the session's own storage settings, and the path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def packed(df: DataFrame, path: str) -> DataFrame:
    """Rows read from the files under ``path`` in no more tasks than fill a file each, by the
    stored size; none is moved. An absent folder holds nothing."""
    files, place = _located(df.sparkSession, path)
    stored = files.getContentSummary(place).getLength() if files.exists(place) else 0
    return df.coalesce(max(1, -(-stored // FILE_BYTES)))


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a folder of intermediate tables; an absent one is no error."""
    files, place = _located(spark, folder)
    files.delete(place, True)


def single_file(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> str:
    """Write a small table as one file of exactly this name.

    One task writes it into a folder aside, from which a rename moves it into place, so
    readers meet a whole file or none.
    """
    spark, aside = df.sparkSession, f"{path}.{os.urandom(4).hex()}"
    write(df.coalesce(1), aside)
    files, folder = _located(spark, aside)
    target = _located(spark, path)[1]
    parts = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise OSError(f"{len(parts)} parts in {aside}")
    if not files.rename(parts[0], target):
        # Some stores do not rename onto a file.
        files.delete(target, False)
        if not files.rename(parts[0], target):
            raise OSError(f"cannot move {aside} to {path}")
    files.delete(folder, True)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """A small table as one CSV file with a header."""
    return single_file(df, path, lambda part, aside: part.write.option("header", True).csv(aside))


def write_json(df: DataFrame, path: str) -> str:
    return single_file(df, path, lambda part, aside: part.write.json(aside))
