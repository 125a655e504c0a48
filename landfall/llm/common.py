"""Helpers shared by the training-data operators."""

import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from landfall.functions.names import fresh
from landfall.session import scratch_dir

BROADCAST_BYTES = 32 * 1024 * 1024


def stored(spark, df, name):
    """``df`` written to the shared scratch folder and read back: the plan starts anew there.

    A lost executor then costs nothing that ran before, and a join that follows shuffles
    both of its sides plainly, so that adaptive execution may split a hot key.
    """
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized(df, row_bytes):
    """``df`` marked for broadcast only if its measured size is within ``BROADCAST_BYTES``.

    ``row_bytes`` is a column or number with an upper bound of a row's bytes. Beyond the
    limit the join shuffles both sides.
    """
    bound = row_bytes if not isinstance(row_bytes, (int, float)) else F.lit(row_bytes)
    total = df.agg(F.coalesce(F.sum(bound.cast("long")), F.lit(0)).alias("b")).first()["b"]
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def remainder(column, n):
    """crc32 of the column as text, modulo ``n``; NULL counts as 0 of its own: never held out."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def slices(batches, rows=256):
    """Arrow batches cut small, so that a task's Python side holds few texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_slices(batches, rows=256, size=1 << 22):
    """The same, cut also where texts add up to ``size`` bytes; a longer text stands alone."""
    for batch in slices(batches, rows):
        start = held = 0
        for i, n in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
            if held and held + (n or 0) > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        yield batch.slice(start)


def numbered(spark, rows, key, name):
    """``rows`` with a number (from 0) among those of equal ``key``, a column that is never NULL.

    Rows are numbered within the tasks that wrote them, and tasks are set one behind the other by
    their counts, so that a frequent key never meets in one task. Which of several rows gets which
    number may differ between runs; use it only where they are alike.
    """
    part, count, first, inside = (fresh(n, rows) for n in ("part_", "count_", "first_", "inside_"))
    rows = stored(spark, rows.withColumn(part, F.spark_partition_id()), name)
    counts = rows.groupBy(key, part).agg(F.count("*").alias(count))
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(spark, counts.select(key, part, F.coalesce(F.sum(count).over(before), F.lit(0)).alias(first)),
                    f"{name}-first")
    among = F.row_number().over(Window.partitionBy(key, part).orderBy(F.lit(0))) - 1
    small = sized(counts, F.octet_length(F.col(key).cast("string")) + 32)
    numbers = rows.withColumn(inside, among).join(small, [key, part])
    return numbers.withColumn("number", F.col(first) + F.col(inside)).drop(part, first, inside)


def unit_hash(*columns):
    """A number in [0, 1) that depends only on the values."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11)).cast("double") / F.lit(float(1 << 53))
