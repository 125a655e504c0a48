"""CSV scans that set broken lines aside: one scan, good rows and broken lines in one write."""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.names import fresh, quoted
from landfall.sources import writers
from landfall.sources.readers import csv_lines

#: Columns of the side table.
REJECTED = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("line", T.StringType()), T.StructField("reason", T.StringType())])
FIELD_COUNT = "wrong number of fields"


class TooManyBadLines(RuntimeError):
    """More of a source's lines break its contract than the job tolerates."""


class Staged(NamedTuple):
    """Good rows, the broken lines with file and reason, and how many lines there were of each."""

    rows: DataFrame
    rejected: DataFrame
    good: int
    bad: int


def reason(line, schema, sep):
    """Why a line breaks the contract: its number of fields, or the first column with a value of another type."""
    corrupt = "corrupt_"
    while corrupt in schema.names:
        corrupt += "_"
    texts = ", ".join(f"{quoted(f.name)} STRING" for f in schema.fields)
    fields = F.from_csv(line, f"{texts}, {corrupt} STRING", {"sep": sep, "columnNameOfCorruptRecord": corrupt})
    found = F.when(fields[corrupt].isNotNull(), FIELD_COUNT)
    for f in schema.fields:
        value = fields[f.name]
        found = found.when(value.isNotNull() & value.try_cast(f.dataType).isNull(),
                           f"{f.name} is not {f.dataType.simpleString()}")
    return found.otherwise("unreadable")


def stage_csv(spark, path, schema, staging, sep=",", tolerance=0.0):
    """Convert a CSV source to Parquet under ``staging``, its broken lines apart: a ``Staged``.

    A line is broken if it has a field too many or too few, or a value of the wrong type. More than
    ``tolerance`` of all lines, as a share, raise ``TooManyBadLines``; the broken lines then stay under
    ``staging`` to be looked at. The source is scanned once; a wrong header fails as it always does.
    """
    lines, bad = csv_lines(spark, path, schema, sep)
    names = {n: fresh(n, lines) for n in ("is_bad", *REJECTED.names)}
    split = lines.select(
        *[F.col(quoted(c)) for c in schema.names], F.col(bad).isNotNull().alias(names["is_bad"]),
        F.when(F.col(bad).isNotNull(), F.col("_metadata.file_path")).alias(names["file"]),
        F.col(bad).alias(names["line"]),
        F.when(F.col(bad).isNotNull(), reason(F.col(bad), schema, sep)).alias(names["reason"]))
    # No rebalancing: it would shuffle the source for two folders.
    seen = writers.write_split(split, staging, names["is_bad"], {"bad": F.count_if(F.col(names["is_bad"]))})

    def part(value, fields):
        found = spark.read.schema(T.StructType(fields)).option("basePath", staging)
        share = seen["bad"] if value == "true" else seen["rows"] - seen["bad"]
        if not share:
            return spark.createDataFrame([], T.StructType(fields))
        return found.parquet(f"{staging}/{names['is_bad']}={value}").select(*[F.col(quoted(f.name)) for f in fields])

    side = part("true", [T.StructField(names[f.name], f.dataType) for f in REJECTED])
    result = Staged(part("false", schema.fields), side.toDF(*REJECTED.names), seen["rows"] - seen["bad"], seen["bad"])
    if result.bad > tolerance * seen["rows"]:
        raise TooManyBadLines(f"{path}: {result.bad} of {seen['rows']} lines are broken; see {staging}")
    return result
