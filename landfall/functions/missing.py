"""Missing-value tests: NULL always, NaN for floating-point columns."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.names import quoted


def is_missing(df, name):
    column = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def is_present(df, name):
    """Written so that the not-null half reaches the Parquet scan as a pushed filter."""
    column = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNotNull() & ~F.isnan(column)
    return column.isNotNull()


def missing_count(df, name):
    return F.count_if(is_missing(df, name))


def ratio(part, whole, digits=3):
    """Rounded share; NULL for an empty whole.

    Scaled, rounded half to even, and scaled back, as NumPy and pandas round; this
    differs from ``bround`` where the scaled share falls just beside a half.
    """
    scale = F.lit(float(10**digits))
    return F.rint(F.try_divide(part, whole) * scale) / scale
