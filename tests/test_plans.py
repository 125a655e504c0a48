"""The physical plans that large inputs depend on, and results under heavy skew."""

import pytest
from pyspark.sql import functions as F

from landfall import schemas
from landfall.functions.dates import day_number_to_date
from landfall.operators import cleaning
from landfall.operators.aggregates import duplicate_count, head_sample
from landfall.operators.joins import lookup_join, payload_bytes
from landfall.plans import jobs, model, questions, star
from landfall.sources.writers import write_partitioned
from suite.inputs import ARRIVALS

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "arrivals")
    ARRIVALS.frame(spark, SF_DIR).write.parquet(path)
    return spark.read.schema(schemas.ARRIVALS).parquet(path)


def scanned(text):
    """Columns named in the plan's scan."""
    return {c.split(":")[0] for c in text.split("ReadSchema: struct<")[1].split(">")[0].split(",")}


def test_keyed_dedup_cuts_rows_before_the_shuffle(stored, plan):
    text = plan(cleaning.drop_duplicate_rows(stored, ["cicid"]))
    assert text.count("Exchange") == 1
    below_shuffle = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle


def test_full_row_dedup_combines_before_the_shuffle(stored, plan):
    text = plan(cleaning.drop_duplicate_rows(stored))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_required_column_filter_reaches_the_scan(stored, plan):
    assert "PushedFilters: [IsNotNull(cicid)]" in plan(cleaning.drop_empty_rows(stored, ["cicid"]))


def test_clean_arrivals_scans_only_model_columns(spark, stored):
    cleaned = jobs.clean_arrivals(stored, cleaning.ARRIVALS_BY_ID)
    assert set(cleaned.columns) == set(model.arrivals_model_columns())
    text = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert "insnum" not in text.split("Relation")[0]


def test_question_scans_two_columns(stored, plan):
    text = plan(questions.top_states_by_sum(model.fact_arrivals(stored)))
    assert scanned(text) == {"count", "i94addr"}
    assert "TakeOrderedAndProject(limit=10" in text and text.count("HashAggregate") == 2


def test_sample_is_a_top_n(stored, plan):
    text = plan(head_sample(stored, "cicid"))
    assert "TakeOrderedAndProject(limit=5" in text and "Exchange" not in text


def test_no_python_in_the_plans(stored, plan):
    for df in (
        model.dim_calendar(stored), model.fact_arrivals(stored), model.with_departure_date(stored),
        cleaning.null_profile(stored), stored.select(day_number_to_date(F.col("arrdate"))),
    ):
        assert "Python" not in plan(df)


def test_calendar_shuffles_once_and_only_dates(stored, plan):
    text = plan(model.dim_calendar(stored))
    assert scanned(text) == {"arrdate"}
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2
    assert "weekofyear" not in text.split("Exchange")[1]


def test_profile_is_one_pass(stored, plan):
    assert plan(cleaning.null_profile(stored)).count("FileScan") == 1


def test_lookup_is_broadcast_only_below_the_limit(spark, plan):
    big = spark.range(1000).selectExpr("id AS k", "id AS v")
    lookup = spark.range(100).selectExpr("id AS k", "concat('name', id) AS name")
    assert payload_bytes(lookup) == 100 * 16 + sum(len(f"name{i}") for i in range(100))
    assert "BroadcastHashJoin" in plan(lookup_join(big, lookup, "k"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = lookup_join(big, lookup, "k", limit=100)
        assert "SortMergeJoin" in plan(shuffled) and "Broadcast" not in plan(shuffled)
        assert shuffled.filter("name IS NOT NULL").count() == 100 and shuffled.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_computed_lookup_is_stored_before_it_is_joined(spark, plan):
    big = spark.range(1000).selectExpr("id AS k", "id AS v")
    lookup = spark.range(300).selectExpr("id % 100 AS k").groupBy("k").count()
    joined = lookup_join(big, lookup, "k", computed=True)
    assert "HashAggregate" not in plan(joined) and "FileScan" in plan(joined)
    assert joined.filter("count = 3").count() == 100


def test_no_cartesian_products(stored, plan):
    fact, calendar = model.fact_arrivals(stored), model.dim_calendar(stored)
    for df in (star.fact_with_calendar(fact, calendar), star.fact_with_immigrant(fact, model.dim_immigrant(stored))):
        assert "Cartesian" not in plan(df) and "NestedLoop" not in plan(df)


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one key, and a third are copies of one row."""
    return spark.range(60000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 3 = 1 THEN 2 ELSE id END AS k",
        "CASE WHEN id % 3 = 1 THEN 7 ELSE id END AS v",
    ).repartition(16)


def test_hot_keys_and_copies(spark, hot):
    kept = cleaning.drop_duplicate_rows(hot, ["k"])
    assert kept.count() == 20002 - 1  # ids 2, 5, 8, ... hold the keys; 2 is also the copies' key
    assert {r.k: r.v for r in kept.filter("k IN (1, 2)").collect()} == {1: 0, 2: 2}
    assert cleaning.drop_duplicate_rows(hot).count() == 40001


def shuffle_records(df):
    """Rows written to each shuffle of an executed plan, outermost first."""
    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        metrics, children = node.metrics(), node.children()
        own = [metrics.apply("shuffleRecordsWritten").value()] if node.nodeName() == "Exchange" else []
        return own + [n for i in range(children.size()) for n in walk(children.apply(i))]

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def test_hot_keys_leave_each_map_task_as_one_row(hot):
    """40,000 rows of two keys in 16 map tasks: at most 32 rows are shuffled."""
    assert shuffle_records(cleaning.drop_duplicate_rows(hot.filter("k IN (1, 2)"), ["k"]))[0] <= 32


def test_copies_leave_each_map_task_as_one_row(hot):
    copies = hot.filter("k = 2 AND v = 7")
    assert copies.count() == 20000
    assert shuffle_records(cleaning.drop_duplicate_rows(copies))[0] <= 16
    assert shuffle_records(duplicate_count(copies))[1] <= 16


def test_hot_key_join_beyond_the_broadcast_limit_splits_the_key(spark, hot, plan):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        lookup = spark.range(60000).selectExpr("id AS k", "id * 2 AS w")
        joined = lookup_join(hot, lookup, "k", limit=1)
        assert len(joined.collect()) == 60000
        assert "skew=true" in plan(joined)
        assert joined.filter("w = k * 2").count() == 60000
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """Year 1 holds most rows: several files there, and one in a small year.

    A small year that hashes to the hot year's shuffle partition is split along with it.
    """
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "200KB")
    try:
        df = spark.range(0, 400000, 1, 8).selectExpr(
            "xxhash64(id) AS v", "CAST(IF(id % 100 < 5, 2 + id % 100, 1) AS INT) AS year"
        )
        assert write_partitioned(df, str(tmp_path / "t"), ["year"]) == 400000
        files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").glob("year=*")}
        assert files.pop("year=1") > 4
        assert len(files) == 5 and sorted(files.values())[:4] == [1, 1, 1, 1]
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("partitions", ["1", "4", "16"])
def test_tables_do_not_depend_on_shuffle_partitions(spark, stored, rows, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    cleaned = jobs.clean_arrivals(stored.repartition(5), cleaning.ARRIVALS_BY_ID)
    expected = rows(model.fact_arrivals(cleaned)), rows(model.dim_calendar(cleaned))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        again = jobs.clean_arrivals(stored, cleaning.ARRIVALS_BY_ID)
        assert (rows(model.fact_arrivals(again)), rows(model.dim_calendar(again))) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
