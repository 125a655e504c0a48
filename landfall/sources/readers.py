"""Source scans with an explicit column contract."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import schemas
from landfall.functions.names import fresh, quoted


def read_parquet(spark, path, schema=None):
    """Parquet folder scan. With a contract, a column that no file has is an error, not NULLs.

    Files may hold their columns in any order. A column that only some files lack reads as NULL
    in these: with a contract the schemas of all files are merged, so whether it is found does
    not depend on which file's footer was read, and columns of unlike types fail.
    """
    if schema is None:
        return spark.read.parquet(path)
    return conform(spark.read.option("mergeSchema", True).parquet(path), schema, path)


def conform(df, schema, source="input"):
    """Select the contract's columns in its order and types."""
    absent = [f.name for f in schema.fields if f.name not in df.columns]
    if absent:
        raise ValueError(f"{source} lacks columns {absent}")
    return df.select([
        F.col(quoted(f.name)) if df.schema[f.name].dataType == f.dataType
        else F.col(quoted(f.name)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def _csv(spark, sep, mode):
    return spark.read.option("header", True).option("sep", sep).option("mode", mode)


def read_csv(spark, path, schema=None, sep=",", mode="FAILFAST"):
    """CSV scan with a header line.

    With a contract, the header is checked against it while scanning, and a line that breaks it
    (a value of the wrong type in a column that is read, a field too many or too few) fails the
    job; ``csv_malformed`` counts such lines in all columns and mode PERMISSIVE reads on with
    NULLs. Without a contract the types are inferred by an extra pass.
    """
    if schema is None:
        return _csv(spark, sep, "PERMISSIVE").option("inferSchema", True).csv(path)
    return (
        _csv(spark, sep, mode).schema(schema).option("enforceSchema", False)
        .option("columnPruning", False).csv(path)
    )


def csv_lines(spark, path, schema, sep=","):
    """(rows, name of a further column): all rows of a CSV source, broken ones included.

    The further column holds the text of a line that breaks the contract, and NULL for the others.
    """
    bad = fresh("_malformed", spark.createDataFrame([], schema))
    lines = (
        _csv(spark, sep, "PERMISSIVE").schema(T.StructType([*schema.fields, T.StructField(bad, T.StringType())]))
        .option("enforceSchema", False).option("columnNameOfCorruptRecord", bad).option("columnPruning", False)
        .csv(path)
    )
    return lines, bad


def csv_malformed(spark, path, schema, sep=","):
    """One row: ``rows`` of the files, and how many of them break the contract."""
    lines, bad = csv_lines(spark, path, schema, sep)
    # Spark parses only the columns that a plan names, so the test names them all.
    text = F.concat_ws("", *[F.col(quoted(c)).cast("string") for c in schema.names]) != "\0"
    return lines.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(bad).isNotNull() & text).alias("malformed"),
    )


def read_arrivals(spark, path):
    return read_parquet(spark, path, schemas.ARRIVALS)


def read_temperatures(spark, path):
    return read_csv(spark, path, schemas.TEMPERATURES)


def read_demographics(spark, path):
    return read_csv(spark, path, schemas.DEMOGRAPHICS, sep=";")
