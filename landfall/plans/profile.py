"""Column profiles that grow with the data: one summary per part and column, merged for the whole."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.missing import is_present, ratio
from landfall.functions.names import quoted

SUMMARY = T.StructType([
    T.StructField("column_name", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("null_count", T.LongType()),
    T.StructField("least_number", T.DoubleType()), T.StructField("greatest_number", T.DoubleType()),
    T.StructField("least_text", T.StringType()), T.StructField("greatest_text", T.StringType()),
    T.StructField("distinct_sketch", T.BinaryType()),
])


def _number(df, name):
    """Numbers as doubles, dates as day numbers from 1970-01-01; NULL for texts."""
    kind, column = df.schema[name].dataType, F.col(quoted(name))
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    return column.cast("double") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")


def summaries(df, parts=()):
    """A row of ``SUMMARY`` for every part (distinct values of the columns ``parts``) and other column.

    One aggregate over one scan. Missing values count as such and have no part in the rest.
    """
    names = [c for c in df.columns if c not in parts]
    wanted = []
    for i, name in enumerate(names):
        present = is_present(df, name)
        text = isinstance(df.schema[name].dataType, T.StringType)
        value, plain = F.when(present, _number(df, name)), F.when(present, F.col(quoted(name)).cast("string"))
        kept = plain if text else F.lit(None).cast("string")
        wanted.append(F.struct(
            F.lit(name).alias("column_name"), F.count(F.lit(1)).alias("rows"), F.count_if(~present).alias("null_count"),
            F.min(value).alias("least_number"), F.max(value).alias("greatest_number"),
            F.min(kept).alias("least_text"), F.max(kept).alias("greatest_text"),
            F.hll_sketch_agg(plain).alias("distinct_sketch")).alias(f"summary_{i}"))
    groups = df.groupBy(*[F.col(quoted(p)) for p in parts]).agg(*wanted)
    return groups.select(*parts, F.explode(F.array(*[f"summary_{i}" for i in range(len(names))])).alias("s")).select(
        *parts, "s.*")


def merged(found):
    """One row per column from ``summaries`` of any parts: counts, share of missing values, ends, and how
    many distinct values there are (estimated). Equals the profile of all rows of these parts."""
    whole = found.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.sum("null_count").alias("null_count"),
        F.min("least_number").alias("least_number"), F.max("greatest_number").alias("greatest_number"),
        F.min("least_text").alias("least_text"), F.max("greatest_text").alias("greatest_text"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct"))
    share = ratio(F.col("null_count"), F.col("rows")).alias("ratio_to_total")
    return whole.select("column_name", "rows", "null_count", share, *whole.columns[3:])
