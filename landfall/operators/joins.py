"""Joins of a large table to a lookup table of unknown size."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.names import quoted
from landfall.session import scratch_dir
from landfall.sources.writers import stage_parquet

BROADCAST_LIMIT = 32 * 1024 * 1024


def payload_bytes(df):
    """Bytes of data in ``df``: text by its length, everything else 8 bytes a value."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = 8 * (len(df.columns) - len(texts))
    row_bytes = sum(
        (F.coalesce(F.octet_length(F.col(quoted(c))), F.lit(0)) + 8 for c in texts), F.lit(fixed)
    )
    return df.agg(F.coalesce(F.sum(row_bytes.cast("long")), F.lit(0)).alias("bytes")).first()["bytes"]


def lookup_join(df, lookup, on, how="left", limit=BROADCAST_LIMIT, computed=False):
    """Join ``df`` to a lookup table, broadcast only if its measured size is small.

    Measuring is one aggregate over the lookup. A larger lookup is joined by
    shuffling both sides, where adaptive execution splits hot keys. A lookup that is
    ``computed``, not read from a table, is stored in the shared scratch folder first, so that
    measuring and joining do not compute it twice.
    """
    if computed:
        lookup = stage_parquet(lookup, scratch_dir(lookup.sparkSession, "lookup"))
    small = payload_bytes(lookup) <= limit
    return df.join(F.broadcast(lookup) if small else lookup, on, how)


def sized_broadcast(df, limit=BROADCAST_LIMIT):
    """``df``, marked for broadcast only if its measured size is small."""
    return F.broadcast(df) if payload_bytes(df) <= limit else df


def sized_semi_join(df, wanted, on, limit=BROADCAST_LIMIT):
    """The rows of ``df`` whose ``on`` occurs in ``wanted``, which is broadcast only if it is small."""
    return df.join(sized_broadcast(wanted, limit), on, "left_semi")
