import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landfall.functions.missing import ratio
from landfall.operators import cleaning
from landfall.operators.aggregates import duplicate_count

NAN = float("nan")


@pytest.fixture
def mixed(spark):
    return spark.createDataFrame(
        [(1.0, "a", True), (None, None, None), (NAN, None, None), (NAN, "b", None), (None, None, False)],
        "x double, s string, b boolean",
    )


def test_only_wholly_missing_rows_go(mixed, rows):
    assert rows(cleaning.drop_empty_rows(mixed)) == sorted(
        [(1.0, "a", True), ("nan", "b", None), (None, None, False)], key=repr
    )


def test_subset_counts_null_and_nan(mixed, rows):
    assert rows(cleaning.drop_empty_rows(mixed, ["x"])) == [(1.0, "a", True)]
    assert len(rows(cleaning.drop_empty_rows(mixed, ["x", "s"]))) == 2


def test_profile_handles_every_type(mixed, rows):
    assert rows(cleaning.null_profile(mixed)) == [("b", 3, 0.6), ("s", 3, 0.6), ("x", 4, 0.8)]


def test_profile_of_an_empty_table_drops_nothing(spark, rows):
    empty = spark.createDataFrame([], "x double, s string")
    assert rows(cleaning.null_profile(empty)) == [("s", 0, None), ("x", 0, None)]
    assert cleaning.drop_high_null_columns(empty).columns == ["x", "s"]


def test_threshold_uses_the_rounded_ratio(spark):
    """70.00 %, 70.04 % and 70.05 % round to 0.700 and stay; 70.06 % and 71 % go."""
    present = {"p7000": 3000, "p7004": 2996, "p7005": 2995, "p7006": 2994, "p7100": 2900}
    columns = [f"if(id < {n}, id, null) AS {name}" for name, n in present.items()]
    df = spark.range(10000).selectExpr(*columns)
    assert cleaning.drop_high_null_columns(df, 0.7).columns == ["p7000", "p7004", "p7005"]
    assert cleaning.drop_high_null_columns(df, 0.71).columns == list(present)
    assert cleaning.drop_high_null_columns(df, 0.5).columns == []


def test_ratios_round_as_pandas_does(spark):
    """Every share of 2,000 rows, among them all exact halves of the third digit."""
    shares = spark.range(2001).select("id", ratio(F.col("id"), F.lit(2000)).alias("r")).toPandas()
    assert (shares.r == (shares.id / 2000).round(3)).all()


def test_column_names_with_blanks_and_hyphens(spark):
    df = spark.createDataFrame([(None, None, 1), (None, 2, 1)], "`Foreign-born` int, `Median Age` int, `a.b` int")
    assert cleaning.drop_high_null_columns(df, 0.5).columns == ["Median Age", "a.b"]
    assert cleaning.drop_duplicate_rows(df, ["a.b"]).collect()[0]["Median Age"] == 2


def test_full_row_duplicates_treat_nulls_and_nans_as_equal(spark, rows):
    df = spark.createDataFrame([(NAN, None), (NAN, None), (None, "a"), (None, "a"), (0.0, "a")], "x double, s string")
    assert len(rows(cleaning.drop_duplicate_rows(df))) == 3
    assert duplicate_count(df).first().asDict() == {"rows": 5, "duplicates": 2}


def test_keyed_duplicates_keep_the_first_in_column_order(spark, rows):
    df = spark.createDataFrame(
        [(1, "b", 1.0), (1, "a", NAN), (1, "a", 2.0), (1, None, 0.0), (None, "x", 1.0), (None, "w", 1.0)],
        "k int, s string, x double",
    )
    assert rows(cleaning.drop_duplicate_rows(df, ["k"])) == [(1, "a", 2.0), (None, "w", 1.0)]


def test_key_that_is_the_whole_row(spark):
    df = spark.createDataFrame([(1, 2), (1, 2)], "a int, b int")
    assert cleaning.drop_duplicate_rows(df, ["b", "a"]).count() == 1


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_keyed_result_does_not_depend_on_partitioning(spark, rows, partitions):
    data = [(i % 50, (i * 37) % 101, float((i * 17) % 13)) for i in range(1000)]
    expected = sorted({k: min((s, x) for j, s, x in data if j == k) for k in range(50)}.items())
    df = spark.createDataFrame(data, "k int, s int, x double").repartition(partitions, "x")
    found = rows(cleaning.drop_duplicate_rows(df, ["k"]))
    assert sorted((k, (s, x)) for k, s, x in found) == expected


def test_clean_is_idempotent_and_never_grows(spark, rows):
    data = [(i % 7 if i % 5 else None, "v" if i % 3 else None, NAN if i % 2 else 1.0) for i in range(100)]
    df = spark.createDataFrame(data, "k int, s string, x double")
    for subset in (None, ["k"], ["k", "s"]):
        once = df.transform(cleaning.clean(subset))
        assert rows(once.transform(cleaning.clean(subset))) == rows(once)
        assert once.count() <= df.count()


def test_ratios_are_taken_after_deduplication(spark):
    """Before de-duplication 3 of 4 rows lack ``s``; after it only 1 of 2 does."""
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "a")], "k int, s string")
    assert df.transform(cleaning.clean(drop_cols=True)).columns == ["k", "s"]
    assert cleaning.drop_high_null_columns(df).columns == ["k"]


def test_named_rules(spark, rows):
    arrivals = spark.createDataFrame(
        [(1.0, "x", None, None, None, 2.0), (1.0, None, "u", "1", "b", 2.0), (NAN, None, None, None, "b", 3.0)],
        "cicid double, occup string, entdepu string, insnum string, airline string, i94bir double",
    )
    assert rows(cleaning.ARRIVALS_BY_ID(arrivals)) == [(1.0, "b", 2.0)]
    demographics = spark.createDataFrame(
        [("A", 1, 2, 3, 2.5, "r1"), ("A", 1, 2, 3, 2.5, "r0"), (None, None, None, None, math.nan, "r2")],
        "City string, `Male Population` int, `Female Population` int, `Foreign-born` int, "
        "`Average Household Size` double, Race string",
    )
    assert [r.Race for r in cleaning.DEMOGRAPHICS_BY_CITY(demographics).collect()] == ["r0"]
    assert cleaning.FULL_ROW(demographics).count() == 3


def test_staged_clean_gives_the_same_rows(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, None, 1), (1, None, 2), (2, None, 3)], "k int, s string, v int")
    staged = df.transform(cleaning.clean(["k"], drop_cols=True, staging=str(tmp_path / "s")))
    assert rows(staged) == rows(df.transform(cleaning.clean(["k"], drop_cols=True))) == [(1, 1), (2, 3)]


COLUMNS = ["k", "x", "s"]
ROWS = st.lists(st.tuples(
    st.none() | st.integers(0, 3), st.none() | st.just(NAN) | st.integers(0, 2).map(float), st.none() | st.sampled_from("ab"),
), min_size=1, max_size=30)


def plain_clean(data, subset, thresh):
    """The same cleaning over a Python list: the kept columns and rows."""
    gone = lambda v: v is None or v != v
    # NULL sorts last and NaN above every number.
    order = lambda v: (2, 0) if v is None else (1, 0) if v != v else (0, v)
    at = [COLUMNS.index(c) for c in subset or COLUMNS]
    kept = {}
    for row in data:
        if not all(gone(row[i]) for i in at):
            key = tuple(order(row[i]) for i in at)
            kept[key] = min(kept.get(key, row), row, key=lambda r: [order(v) for v in r])
    missing = [sum(gone(r[i]) for r in kept.values()) for i in range(3)]
    columns = [i for i in range(3) if not kept or not round(missing[i] / len(kept) * 1000) / 1000 > thresh]
    return [COLUMNS[i] for i in columns], [
        tuple("nan" if r[i] is not None and r[i] != r[i] else r[i] for i in columns) for r in kept.values()
    ]


@settings(max_examples=12, deadline=None)
@given(ROWS, st.sampled_from([None, ["k"], ["k", "s"], ["x"]]), st.sampled_from([0.25, 0.5, 0.7]))
def test_clean_against_plain_python(spark, data, subset, thresh):
    df = spark.createDataFrame(data, "k int, x double, s string")
    cleaned = df.transform(cleaning.clean(subset, drop_cols=True, thresh=thresh))
    columns, expected = plain_clean(data, subset, thresh)
    assert cleaned.columns == columns
    found = [tuple("nan" if v is not None and v != v else v for v in r) for r in cleaned.collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
