import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landfall.functions.dates import calendar_parts, date_to_day_number, day_number_to_date
from landfall.functions.keys import date_key, hash_key

EPOCH = dt.date(1960, 1, 1)


def expected_date(x):
    if x is None or math.isnan(x) or math.isinf(x):
        return None
    try:
        return EPOCH + dt.timedelta(days=math.floor(x))
    except OverflowError:
        return None


def convert(spark, numbers):
    df = spark.createDataFrame([(float(x) if x is not None else None,) for x in numbers], "x double")
    return [r.d for r in df.select("x", day_number_to_date(F.col("x")).alias("d")).collect()]


def test_edge_numbers(spark):
    numbers = [0.0, -0.0, -1.0, -0.5, 20545.0, 20545.9, 1e300, -1e300, None, math.nan, math.inf, -math.inf,
               2936549.0, 2936549.9, 2936550.0, -715509.0, -715509.1]
    assert convert(spark, numbers) == [expected_date(x) for x in numbers]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-800000, 3000000) | st.integers(-800000, 3000000), min_size=200, max_size=200))
def test_any_number(spark, numbers):
    assert convert(spark, numbers) == [expected_date(x) for x in numbers]


def test_integer_and_text_free_round_trip(spark):
    df = spark.range(-30000, 30000, 7).select("id", day_number_to_date(F.col("id")).alias("d"))
    assert df.filter(date_to_day_number(F.col("d")) != F.col("id")).count() == 0


def test_calendar_parts_against_python(spark):
    df = spark.range(-5000, 30000, 11).select(day_number_to_date(F.col("id")).alias("d"))
    parts = calendar_parts(F.col("d"))
    for r in df.select("d", *[c.alias(n) for n, c in parts.items()], date_key(F.col("d")).alias("id")).collect():
        assert (r.year, r.month, r.day) == (r.d.year, r.d.month, r.d.day)
        assert r.week == r.d.isocalendar()[1]
        assert r.weekday == r.d.isoweekday() % 7 + 1
        assert r.id == int(r.d.strftime("%Y%m%d"))


def test_unknown_date_has_key_zero(spark):
    assert spark.sql("SELECT CAST(NULL AS DATE) AS d").select(date_key(F.col("d"))).first()[0] == 0


def test_hash_key_tells_values_apart(spark):
    data = [("a|b", "c", 1.5), ("a", "b|c", 1.5), (None, "c", 1.5), ("", "c", 1.5), ("-", "c", 1.5),
            ("a", "b", None), ("a", "b", math.nan), ("1:a", "b", 0.0), ("a", "b", 0.0)]
    df = spark.createDataFrame(data, "s string, t string, x double")
    keys = [r.k for r in df.select(hash_key(df, df.columns).alias("k")).collect()]
    # Rows that de-duplication keeps apart have different keys, NULL and NaN among them.
    assert len(set(keys)) == len(data)
    assert all(0 <= k < 2**60 for k in keys)


def test_hash_key_does_not_depend_on_partitioning(spark):
    df = spark.range(2000).selectExpr("id", "concat('n', id) AS s")
    keys = {tuple(r) for r in df.select("id", hash_key(df, ["id", "s"])).collect()}
    assert keys == {tuple(r) for r in df.repartition(13).select("id", hash_key(df, ["id", "s"])).collect()}
    assert len({k for _, k in keys}) == 2000


def test_hash_key_tells_doubles_apart(spark):
    values = [(2.5,), (2.5000000000000004,), (1e15,), (2e15,), (float("nan"),), (None,), (0.0,)]
    df = spark.createDataFrame(values, "x double")
    keys = [r.k for r in df.select(hash_key(df, ["x"]).alias("k")).collect()]
    assert len(set(keys)) == len(values)
    zero = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    assert zero.select(hash_key(zero, ["x"]).alias("k")).distinct().count() == 1


def test_helper_columns_do_not_meet_columns_of_the_user(spark):
    from landfall.operators import aggregates, cleaning

    df = spark.createDataFrame([(1, 5, 6, 7), (1, 5, 6, 7)], "_row_in_key int, _rows int, _copies int, k int")
    assert [tuple(r) for r in cleaning.drop_duplicate_rows(df, ["k"]).collect()] == [(1, 5, 6, 7)]
    assert cleaning.null_profile(df).count() == 4
    assert tuple(aggregates.duplicate_count(df).first()) == (2, 1)
