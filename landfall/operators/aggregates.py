"""Counts, sums, averages, top-k and stable samples."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.names import fresh, quoted


def row_count(df):
    return df.agg(F.count(F.lit(1)).alias("rows"))


def group_count(df, key):
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def group_sum(df, key, measure, name=None):
    return df.groupBy(key).agg(F.sum(measure).alias(name or f"sum_{measure}"))


def global_avg(df, measure, name=None):
    return df.agg(F.avg(measure).alias(name or f"avg_{measure}"))


def numeric_avgs(df):
    """The mean of every numeric column, named ``avg_<column>``; NULLs are skipped."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.agg(*[F.avg(quoted(c)).alias(f"avg_{c}") for c in numbers])


def top_k(df, measure, key, k=10):
    """Largest ``k`` by ``measure``; equal values are ordered by ``key``, NULL key last."""
    return df.orderBy(F.desc(measure), F.asc_nulls_last(key)).limit(k)


def head_sample(df, key, n=5):
    """The first ``n`` rows in key order."""
    return df.orderBy(F.asc_nulls_last(key)).limit(n)


def duplicate_count(df):
    """One row: ``rows``, and how many of them repeat an earlier row."""
    copies = fresh("_copies", df)
    per_row = df.groupBy(*[F.col(quoted(c)) for c in df.columns]).agg(F.count(F.lit(1)).alias(copies))
    return per_row.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col(copies) - 1), F.lit(0)).alias("duplicates"),
    )
