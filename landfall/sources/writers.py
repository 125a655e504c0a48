"""Parquet sinks. Each returns the number of rows it wrote, counted during the write."""

from pyspark.sql import Observation
from pyspark.sql import functions as F


def observed(df, measures=None):
    """``df`` with its rows and the aggregates ``measures`` to be seen when an action runs it."""
    seen = Observation()
    named = [column.alias(name) for name, column in (measures or {}).items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *named), seen


def write_measured(df, path, measures=None, partitions=(), sorted_by=(), grouped=False):
    """Replace the dataset at ``path``; a dict of ``rows`` and the aggregates ``measures``.

    They are computed over the rows on their way into the files, without another pass. The files of
    a partitioned dataset are sorted by ``sorted_by``, so that their statistics narrow a search.
    ``grouped`` says that the rows are read from a dataset of the same partitions: its tasks hold few
    partitions each, and the rows are written where they are read, without a shuffle.
    """
    if partitions:
        writer, seen = _partition_writer(df, partitions, measures, sorted_by, grouped)
        writer.option("partitionOverwriteMode", "static").parquet(path)
    else:
        counted, seen = observed(df, measures)
        counted.write.mode("overwrite").parquet(path)
    return dict(seen.get)


def write_split(df, path, column, measures=None):
    """Replace the dataset at ``path``, split by a column of few values, in the tasks that made the rows."""
    counted, seen = observed(df, measures)
    counted.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(column).parquet(path)
    return dict(seen.get)


def write_table(df, path):
    """Replace the whole dataset at ``path``."""
    return write_measured(df, path)["rows"]


def _partition_writer(df, columns, measures=None, sorted_by=(), grouped=False):
    # Rebalancing groups rows by the partition columns to avoid many small files, but
    # adaptive execution still splits a partition that is far larger than the others.
    if not grouped:
        df = df.hint("rebalance", *columns)
    if sorted_by:
        df = df.sortWithinPartitions(*columns, *sorted_by)
    counted, seen = observed(df, measures)
    return counted.write.mode("overwrite").partitionBy(*columns), seen


def write_partitioned(df, path, columns):
    """Replace the whole dataset, split by ``columns``."""
    return write_measured(df, path, partitions=columns)["rows"]


def refresh_partitions(df, path, columns):
    """Replace only the partitions that occur in ``df``; the others stay as they are."""
    writer, seen = _partition_writer(df, columns)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return seen.get["rows"]


def stage_parquet(df, path):
    """Write a columnar staging copy and return the frame that reads it.

    Later steps read only the columns they need, and lost executors cost no recompute.
    """
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_staged(spark, path):
    """Delete a staging copy that this run made and no longer reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
