"""Checks of written tables: row counts, duplicates, keys, types and orphans."""

from typing import NamedTuple

from pyspark.sql import functions as F

from landfall.functions.missing import is_missing
from landfall.functions.names import fresh, quoted
from landfall.operators.aggregates import duplicate_count
from landfall.operators.joins import BROADCAST_LIMIT

#: Bytes of a broadcast hash, with what the hash table adds.
SUSPECT_BYTES = 64

# Wording of the check's outcome.
EMPTY = "Data quality check failed. Table has 0 records."
REPEATED = "Data quality check failed. Table has %d duplicates."
PASSED = "Data quality check passed. Table has %d and no duplicates."


class TableCheck(NamedTuple):
    table_name: str
    total_rows: int
    duplicates: int
    status: str
    message: str


CHECK_SCHEMA = (
    "table_name string, total_rows long, duplicates long, status string, message string"
)


def quality_report(df, table):
    """One lazy row: fails on an empty table or on repeated rows.

    Rows are told apart by 128 bits of hashes that cover which columns are NULL, so that only these are
    shuffled: two of 1e12 different rows would pass for equal with a chance of about 2^-48.
    """
    failed = (F.col("rows") == 0) | (F.col("duplicates") > 0)
    return duplicate_count(df.select(*[h.alias(n) for n, h in _row_hashes(df).items()])).select(
        F.lit(table).alias("table_name"),
        F.col("rows").alias("total_rows"),
        "duplicates",
        F.when(failed, "failed").otherwise("passed").alias("status"),
        F.when(F.col("rows") == 0, EMPTY)
        .when(F.col("duplicates") > 0, F.format_string(REPEATED, F.col("duplicates")))
        .otherwise(F.format_string(PASSED, F.col("rows"))).alias("message"),
    )


def check_table(df, table, keys=None):
    """The same outcome, run now, for tables that are expected to be free of repeats.

    Rows with unique ``keys`` are distinct, and proving that reads the key columns only. Else
    the rows' 64-bit hashes are counted: equal rows have equal hashes, so rows are compared only
    if they share one. The hash covers which columns are NULL.
    """
    if keys:
        found = unique_key_report(df, table, keys).first()
        if found["total_rows"] and not found["repeated_keys"] and found["rows_without_key"] <= 1:
            return _outcome(table, found["total_rows"], 0)
    h, n = fresh("_h", df), fresh("_n", df)
    columns = [F.col(quoted(c)) for c in df.columns]
    columns += [c.isNull() for c in columns]
    marked = df.withColumn(h, F.xxhash64(*columns))
    groups = marked.groupBy(h).agg(F.count(F.lit(1)).alias(n))
    screen = groups.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("rows"), F.count_if(F.col(n) > 1).alias("suspects")
    ).first()
    duplicates = 0
    if screen["suspects"] * SUSPECT_BYTES > BROADCAST_LIMIT:
        # Finding the suspects would shuffle all rows once more than comparing them all does.
        duplicates = duplicate_count(df).first()["duplicates"]
    elif screen["suspects"]:
        shared = F.broadcast(groups.filter(F.col(n) > 1).select(h))
        suspects = marked.join(shared, [h], "left_semi").drop(h)
        duplicates = duplicate_count(suspects).first()["duplicates"]
    return _outcome(table, screen["rows"], duplicates)


def _outcome(table, rows, duplicates):
    if not rows:
        return TableCheck(table, 0, 0, "failed", EMPTY)
    if duplicates:
        return TableCheck(table, rows, duplicates, "failed", REPEATED % duplicates)
    return TableCheck(table, rows, 0, "passed", PASSED % rows)


def _row_hashes(df):
    """Two 64-bit hashes of a row, which cover which columns are NULL."""
    columns = [F.col(quoted(c)) for c in df.columns]
    columns += [c.isNull() for c in columns]
    return {"hash_1": F.xxhash64(*columns), "hash_2": F.xxhash64(F.lit(1), *columns)}


def fingerprint(df):
    """Aggregates that tell the rows of ``df`` as a multiset, in any order, apart from others.

    Two sums of 64-bit row hashes; the hashes cover which columns are NULL. Each is summed in three
    pieces of at most 22 bits, as long numbers, which is exact for 1e12 rows and far cheaper than
    decimals. Together with the number of rows, equal contents always agree, and a changed, lost or
    repeated row shows but for a chance of about 2^-64 or less.
    """
    def total(h):
        pieces = (F.shiftright(h, 44), F.shiftright(h, 22).bitwiseAND(F.lit((1 << 22) - 1)),
                  h.bitwiseAND(F.lit((1 << 22) - 1)))
        high, middle, low = (F.coalesce(F.sum(p), F.lit(0)).cast("decimal(20,0)") for p in pieces)
        one = F.lit(1 << 22).cast("decimal(8,0)")
        return (((high * one + middle) * one) + low).cast("decimal(38,0)")

    return {name: total(h) for name, h in _row_hashes(df).items()}


def content(df):
    """A row of ``rows`` and the fingerprint."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in fingerprint(df).items()])


def source_target_report(source, target, table):
    """One row: rows of both frames, and whether they hold the same rows equally often.

    ``target`` is read in the column order of ``source``; each side is scanned once.
    """
    sides = content(source).select(F.lit(True).alias("is_source"), "*").unionByName(
        content(target.select([F.col(quoted(c)) for c in source.columns])).select(
            F.lit(False).alias("is_source"), "*"))
    same = F.lit(True)
    for name in ("rows", "hash_1", "hash_2"):
        same = same & (F.min(name) == F.max(name))
    return sides.agg(
        F.max(F.when(F.col("is_source"), F.col("rows"))).alias("source_rows"),
        F.max(F.when(~F.col("is_source"), F.col("rows"))).alias("target_rows"), same.alias("same_content"),
    ).select(F.lit(table).alias("table_name"), "*")


def unique_key_report(df, table, keys):
    """One row: rows, distinct keys, keys that occur more than once, rows without a key."""
    missing, n = fresh("_no_key", df), fresh("_n", df)
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | is_missing(df, key)
    per_key = df.groupBy(*[F.col(quoted(k)) for k in keys], no_key.alias(missing)).agg(
        F.count(F.lit(1)).alias(n)
    )
    return per_key.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_rows"),
        F.count_if(~F.col(missing)).alias("distinct_keys"),
        F.count_if(~F.col(missing) & (F.col(n) > 1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(F.col(missing), F.col(n))), F.lit(0)).alias("rows_without_key"),
    ).select(F.lit(table).alias("table_name"), "*")


def orphan_report(df, key, parent, parent_key):
    """One row: rows of ``df`` whose key has no row in ``parent``; NULL keys do not count.

    Keys are counted before the join, so a frequent key crosses it once.
    """
    children = df.filter(F.col(quoted(key)).isNotNull()).groupBy(
        F.col(quoted(key)).alias("_key")
    ).agg(F.count(F.lit(1)).alias("_n"))
    parents = parent.select(F.col(quoted(parent_key)).alias("_key"))
    return children.join(parents, "_key", "left_anti").agg(
        F.count(F.lit(1)).alias("orphan_keys"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows"),
    )


def schema_problems(df, contract):
    """Texts for absent, extra and wrongly typed columns; empty if all agree."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    expected = {f.name: f.dataType for f in contract.fields}
    problems = [f"{n} is absent" for n in expected if n not in actual]
    problems += [f"{n} is not in the contract" for n in actual if n not in expected]
    return problems + [
        f"{n} is {actual[n].simpleString()}, not {t.simpleString()}"
        for n, t in expected.items() if n in actual and actual[n] != t
    ]
