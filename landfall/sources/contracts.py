"""Column contracts of Parquet folders, file by file.

Footers are read by the tasks of a Spark job; the driver lists names only. Tasks open files with
Arrow, so their store must be one that Arrow knows: a file system that all executors mount, S3, GCS or HDFS.
"""

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

#: Schemes of Hadoop that Arrow calls otherwise.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _spark_type(kind):
    try:
        return from_arrow_type(kind).simpleString()
    except Exception:  # a type that Spark lacks is still reported, by its own name
        return str(kind)


def _footers(batches):
    for batch in batches:
        rows = []
        for path in batch.column("path").to_pylist():
            scheme, rest = path.split(":", 1)
            # Hadoop writes file:/x, Arrow file:///x.
            rest = "//" + rest if not rest.startswith("//") else rest
            store, name = fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")
            with store.open_input_file(name) as file:
                rows += [(path, f.name, _spark_type(f.type)) for f in pq.read_schema(file)]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["file", "column", "type"])


def parquet_files(spark, path):
    """path and length of the Parquet files below ``path``."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.parquet").load(path).select("path", "length")


def file_columns(spark, path):
    """file, column, type: what the footer of every Parquet file below ``path`` holds."""
    return parquet_files(spark, path).mapInArrow(_footers, "file string, column string, type string")


def contract_problems(spark, path, schema):
    """file, column, problem: files that lack a column of the contract or hold it in another type."""
    wanted = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("wanted")) for f in schema.fields])
    needed = parquet_files(spark, path).select(F.col("path").alias("file"), F.explode(wanted).alias("w")).select("file", "w.*")
    found = needed.join(file_columns(spark, path), ["file", "column"], "left")
    problem = F.when(F.col("type").isNull(), "absent").when(
        F.col("type") != F.col("wanted"), F.concat(F.lit("is "), "type", F.lit(", not "), "wanted"))
    return found.select("file", "column", problem.alias("problem")).where(F.col("problem").isNotNull())
