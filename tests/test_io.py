import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import schemas
from landfall.operators.columns import rename_columns
from landfall.session import input_bytes, scale_conf, scratch_dir
from landfall.sources import readers, writers
from landfall.sources.paths import join_path


def test_join_path():
    assert join_path("", "t") == "t"
    assert join_path("out", "t") == "out/t" == join_path("out/", "t")
    assert join_path("s3a://bucket/lake/", "t") == "s3a://bucket/lake/t"


def test_parquet_contract(spark, tmp_path):
    path = str(tmp_path / "arrivals")
    spark.range(3).selectExpr(*[
        f"CAST(id AS {'INT' if f.name == 'cicid' else f.dataType.simpleString()}) AS `{f.name}`"
        for f in reversed(schemas.ARRIVALS.fields)
    ]).write.parquet(path)
    assert readers.read_arrivals(spark, path).schema == schemas.ARRIVALS
    narrow = str(tmp_path / "narrow")
    spark.read.parquet(path).drop("gender").write.parquet(narrow)
    with pytest.raises(ValueError, match="gender"):
        readers.read_arrivals(spark, narrow)


HEADER = "City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;" \
         "Foreign-born;Average Household Size;State Code;Race;Count\n"


def test_demographics_file(spark, tmp_path):
    file = tmp_path / "d.csv"
    file.write_text(HEADER + "Here;There;33.5;10;11;21;;3;2.6;TH;White;9\n")
    row = readers.read_demographics(spark, str(file)).first()
    assert row["Median Age"] == 33.5 and row["Number of Veterans"] is None and row["Count"] == 9
    inferred = readers.read_csv(spark, str(file), sep=";")
    assert dict(inferred.dtypes)["Median Age"] == "double" and dict(inferred.dtypes)["Count"] == "int"


def test_wrong_separator_or_header_fails(spark, tmp_path):
    file = tmp_path / "d.csv"
    file.write_text(HEADER.replace(";", ","))
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_demographics(spark, str(file)).collect()
    file2 = tmp_path / "t.csv"
    file2.write_text("dt;AverageTemperature;AverageTemperatureUncertainty;City;Country;Latitude;Longitude\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_temperatures(spark, str(file2)).collect()


def test_temperatures_file(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text(
        "dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude\n"
        "1743-11-01,6.07,1.74,Here,There,57.05N,10.33E\n1743-12-01,,,Here,There,57.05N,10.33E\n"
    )
    first, second = readers.read_temperatures(spark, str(file)).collect()
    assert (first.dt, first.AverageTemperature) == (dt.date(1743, 11, 1), 6.07)
    assert second.AverageTemperature is None


def test_rename_is_strict(spark):
    df = spark.createDataFrame([(1, 2)], "City int, `Foreign-born` int")
    assert rename_columns(df, {"City": "city", "Foreign-born": "foreign_born"}).columns == ["city", "foreign_born"]
    with pytest.raises(ValueError, match="Town"):
        rename_columns(df, {"Town": "city"})


def test_writers_count_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.write_table(spark.range(10), path) == 10
    assert writers.write_table(spark.range(4), path) == 4
    assert spark.read.parquet(path).count() == 4
    assert writers.write_table(spark.range(0), path) == 0
    assert spark.read.parquet(path).count() == 0
    assert writers.write_table(spark.range(5).filter("id < 0").distinct(), path) == 0


def test_partitions_are_replaced_only_where_new_rows_arrive(spark, tmp_path, rows, plan):
    path = str(tmp_path / "t")
    base = spark.range(100).selectExpr("id", "CAST(id % 3 AS INT) AS year", "CAST(id % 2 AS INT) AS month")
    assert writers.write_partitioned(base, path, ["year", "month"]) == 100
    fresh = spark.createDataFrame([(7, 1, 1), (8, 9, 9)], "id long, year int, month int")
    assert writers.refresh_partitions(fresh, path, ["year", "month"]) == 2
    back = spark.read.parquet(path)
    assert back.columns == ["id", "year", "month"]
    kept = base.filter("NOT (year = 1 AND month = 1)").unionByName(fresh)
    assert rows(back) == rows(kept)
    assert "PartitionFilters: [isnotnull(year" in plan(back.filter("year = 1"))
    assert writers.write_partitioned(fresh, path, ["year", "month"]) == 2
    assert spark.read.parquet(path).count() == 2


def test_unknown_partition_survives(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, None), (2, 2016)], "id int, year int")
    writers.write_partitioned(df, path, ["year"])
    assert {(r.id, r.year) for r in spark.read.parquet(path).collect()} == {(1, None), (2, 2016)}


def test_staging_reads_back_the_same_rows(spark, tmp_path, rows):
    df = spark.range(50).withColumn("x", F.lit("v"))
    assert rows(writers.stage_parquet(df, str(tmp_path / "s"))) == rows(df)


def test_scratch_lies_under_the_checkpoint_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.gettempdir()
    path = scratch_dir(spark, "x")
    assert path.startswith(shared.rstrip("/") + "/") and path.endswith("/x")
    assert path != scratch_dir(spark, "x")


def test_scale_conf_grows_with_the_input():
    small, huge = scale_conf(10**6, 8), scale_conf(100 * 10**12, 4000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    partitions = int(huge["spark.sql.shuffle.partitions"])
    scans = 100 * 10**12 / int(huge["spark.sql.files.maxPartitionBytes"])
    assert 8 * 4000 <= partitions <= 40_000 and scans <= 110_000


def test_a_broken_csv_line_fails_and_is_counted(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("a,b\n1,2\n3,x\n5,6,7\n")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    with pytest.raises(Exception, match="(?i)malformed|failed_read_file"):
        readers.read_csv(spark, str(folder), schema).select("a").collect()
    assert tuple(readers.csv_malformed(spark, str(folder), schema).first()) == (3, 2)


def test_input_size_is_measured(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"a" * 1000)
    (tmp_path / "y").write_bytes(b"b" * 500)
    assert input_bytes(spark, [str(tmp_path), str(tmp_path / "y")]) == 2000
