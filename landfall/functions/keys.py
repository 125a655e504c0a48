"""Surrogate keys that do not depend on partitioning or on the run."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.names import quoted


def date_key(column):
    """yyyymmdd as a long; 0 stands for the unknown date."""
    digits = F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)
    return F.coalesce(digits, F.lit(0)).cast("long")


def hash_key(df, names):
    """60-bit key over the named columns.

    Each value enters with its length, so neighbouring values cannot run together,
    and NULL differs from every text. Floating-point values enter as the shortest text
    that reads back as the same double, with -0.0 as 0.0; NaN is a value of its own.
    Check the result with ``quality.unique_key_report`` on large tables.
    """
    parts = []
    for name in names:
        column = F.col(quoted(name))
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            column = column.cast("double") + F.lit(0.0)
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-")))
    digest = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15)
    return F.conv(digest, 16, 10).cast("long")
