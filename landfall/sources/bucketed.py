"""Parquet tables bucketed and sorted by an integral key: two of them join without a shuffle.

Spark knows buckets only of catalogue tables. A bucketed folder is therefore read through an external
table of the session's catalogue, which is declared where it is first read; the files stay plain Parquet.
"""

import hashlib

from pyspark.sql import functions as F

from landfall.functions.names import quoted
from landfall.sources import writers


def _name(path):
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"


def integral(column):
    """A double that is a whole number as a long; NULL for all others, NULL and NaN."""
    whole = (column == F.floor(column)) & (F.abs(column) < float(1 << 53))
    return F.when(whole, column.cast("long"))


def write_bucketed(df, path, key, buckets, measures=None, grouped=False):
    """Replace the dataset at ``path``, one sorted file a bucket; rows and ``measures`` as a dict.

    Rows without a key share one bucket. The number of buckets stays for the table's life: choose it so
    that a bucket of the full-grown table fits a task. ``grouped`` rows lie by the hash of the key
    already and are written where they are read: a bucket then has several sorted files.
    """
    if not grouped:
        df = df.repartition(buckets, F.col(quoted(key)))
    counted, seen = writers.observed(df, measures)
    name = _name(path)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    counted.write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key).option(
        "path", path).saveAsTable(name)
    return dict(seen.get)


def read_bucketed(spark, path, schema, key, buckets):
    """A folder that ``write_bucketed`` wrote, under ``schema``, which names the key."""
    name = _name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({quoted(key)}) "
                  f"SORTED BY ({quoted(key)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
