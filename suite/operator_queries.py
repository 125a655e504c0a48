"""Scans, sinks, projections, cleaning, aggregates and scalar functions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.dates import calendar_parts, day_number_to_date
from landfall.functions.keys import date_key, hash_key
from landfall.operators import aggregates, cleaning
from landfall.operators.columns import rename_columns
from landfall.plans import quality
from landfall.session import scratch_dir
from landfall.sources import readers, writers
from suite.inputs import ARRIVALS, CODED_DAYS, DEMOGRAPHICS, DIRTY_EVENTS, TEMPERATURES, load
from suite.registry import query

# --- scans and sinks -------------------------------------------------------

NATION = T.StructType([
    T.StructField("n_nationkey", T.IntegerType()),
    T.StructField("n_name", T.StringType()),
    T.StructField("n_regionkey", T.IntegerType()),
])
SUPPLIER = T.StructType([
    T.StructField("Supplier Key", T.LongType()),
    T.StructField("Supplier-name", T.StringType()),
    T.StructField("Nation Key", T.IntegerType()),
    T.StructField("Account Balance", T.DoubleType()),
])
SUPPLIER_NAMES = {
    "s_suppkey": "Supplier Key",
    "s_name": "Supplier-name",
    "s_nationkey": "Nation Key",
    "s_acctbal": "Account Balance",
}


@query("parquet_scan", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def parquet_scan(spark, sf_dir):
    return readers.read_parquet(spark, f"{sf_dir}/nation.parquet", NATION)


@query("csv_comma_roundtrip", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_comma_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    load(spark, sf_dir, "nation").write.option("header", True).csv(path)
    return readers.read_csv(spark, path, NATION)


def _supplier_csv(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    named = rename_columns(load(spark, sf_dir, "supplier"), SUPPLIER_NAMES)
    named.write.option("header", True).option("sep", ";").csv(path)
    return path


@query("csv_semicolon_roundtrip", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_semicolon_roundtrip(spark, sf_dir):
    back = readers.read_csv(spark, _supplier_csv(spark, sf_dir), SUPPLIER, sep=";")
    return rename_columns(back, {new: old for old, new in SUPPLIER_NAMES.items()})


@query("csv_malformed_counted", """
    SELECT count(*) AS rows,
      CAST(count(*) FILTER (s_suppkey % 7 = 0 OR s_suppkey % 11 = 0) AS BIGINT) AS malformed FROM supplier""")
def csv_malformed_counted(spark, sf_dir):
    """Every seventh balance with a semicolon, every eleventh key with a letter."""
    path = scratch_dir(spark, "csv")
    broken = rename_columns(load(spark, sf_dir, "supplier"), SUPPLIER_NAMES).withColumns({
        "Account Balance": F.expr("if(`Supplier Key` % 7 = 0, '6;1', string(`Account Balance`))"),
        "Nation Key": F.expr("if(`Supplier Key` % 11 = 0, 'x', string(`Nation Key`))"),
    })
    broken.select(*SUPPLIER.names).write.option("header", True).csv(path)
    return readers.csv_malformed(spark, path, SUPPLIER)


@query("csv_inferred_schema", """
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def csv_inferred_schema(spark, sf_dir):
    back = readers.read_csv(spark, _supplier_csv(spark, sf_dir), sep=";")
    names = rename_columns(back, {new: old for old, new in SUPPLIER_NAMES.items()})
    return names.withColumn("s_suppkey", F.col("s_suppkey").cast("long"))


@query("parquet_overwrite", "SELECT * FROM part")
def parquet_overwrite(spark, sf_dir):
    path = scratch_dir(spark, "parquet")
    part = load(spark, sf_dir, "part")
    writers.write_table(part.filter("p_size > 10"), path)
    writers.write_table(part, path)
    return readers.read_parquet(spark, path)


@query("partitioned_sink_pruned", """
    SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month, 1997 AS year
    FROM orders WHERE year(o_orderdate) = 1997""")
def partitioned_sink_pruned(spark, sf_dir):
    path = scratch_dir(spark, "partitioned")
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    writers.write_partitioned(orders, path, ["year", "month"])
    return spark.read.parquet(path).filter("year = 1997")


@query("staging_convert", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def staging_convert(spark, sf_dir):
    raw = csv_semicolon_roundtrip(spark, sf_dir)
    return writers.stage_parquet(raw, scratch_dir(spark, "staged"))


@query("head_sample", "SELECT * FROM customer ORDER BY c_custkey LIMIT 5")
def head_sample(spark, sf_dir):
    return aggregates.head_sample(load(spark, sf_dir, "customer"), "c_custkey", 5)


# --- projections -----------------------------------------------------------

@query("select_columns", "SELECT c_custkey, c_mktsegment FROM customer")
def select_columns(spark, sf_dir):
    return load(spark, sf_dir, "customer").select(["c_custkey", "c_mktsegment"])


@query("rename_columns", """
    SELECT p_partkey AS "Part Key", p_name AS name, p_brand AS brand, p_type AS "P_TYPE",
           p_size AS size, p_retailprice AS "retail-price" FROM part""")
def rename(spark, sf_dir):
    return rename_columns(load(spark, sf_dir, "part"), {
        "p_partkey": "Part Key", "p_name": "name", "p_brand": "brand", "p_type": "P_TYPE",
        "p_size": "size", "p_retailprice": "retail-price",
    })


@query("replace_column", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders""")
def replace_column(spark, sf_dir):
    return load(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("date").cast("string")
    )


@query("drop_columns", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def drop_columns(spark, sf_dir):
    return load(spark, sf_dir, "customer").drop("c_acctbal", "c_mktsegment", "no_such_column")


# --- missing data and duplicates -------------------------------------------

EVENTS_CTE = f"WITH dirty AS ({DIRTY_EVENTS.sql()})"
EVENT_COLUMNS = tuple(DIRTY_EVENTS.columns)


def _gone(column):
    return f"({column} IS NULL OR isnan({column}))" if column == "value" else f"({column} IS NULL)"


def _profile_sql(source):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE {_gone(c)}) AS null_count,
            round_even(count(*) FILTER (WHERE {_gone(c)}) / count(*) * 1000.0::DOUBLE, 0) / 1000.0::DOUBLE
              AS ratio_to_total
            FROM {source}"""
        for c in EVENT_COLUMNS
    )


@query("null_profile", f"{EVENTS_CTE} {_profile_sql('dirty')}")
def null_profile(spark, sf_dir):
    return cleaning.null_profile(DIRTY_EVENTS.frame(spark, sf_dir))


@query("missing_counts", f"""{EVENTS_CTE} SELECT {", ".join(
    f'count(*) FILTER (WHERE {_gone(c)}) AS "{c}"' for c in EVENT_COLUMNS)} FROM dirty""")
def missing_counts(spark, sf_dir):
    dirty = DIRTY_EVENTS.frame(spark, sf_dir)
    return dirty.agg(*[cleaning.missing_count(dirty, c).alias(c) for c in dirty.columns])


@query("high_null_profile", f"""{EVENTS_CTE}, profile AS ({_profile_sql('dirty')})
    SELECT * FROM profile WHERE ratio_to_total > 0.7""")
def high_null_profile(spark, sf_dir):
    return cleaning.high_null_profile(DIRTY_EVENTS.frame(spark, sf_dir), 0.7)


@query("high_null_columns", f"{EVENTS_CTE} SELECT id, value, kind, sixty FROM dirty")
def high_null_columns(spark, sf_dir):
    return cleaning.drop_high_null_columns(DIRTY_EVENTS.frame(spark, sf_dir), 0.7)


@query("dropna_all", f"""{EVENTS_CTE} SELECT value, kind FROM dirty
    WHERE (value IS NOT NULL AND NOT isnan(value)) OR kind IS NOT NULL""")
def dropna_all(spark, sf_dir):
    return cleaning.drop_empty_rows(DIRTY_EVENTS.frame(spark, sf_dir).select("value", "kind"))


@query("dropna_subset", f"""{EVENTS_CTE} SELECT * FROM dirty
    WHERE (value IS NOT NULL AND NOT isnan(value)) OR sparse IS NOT NULL""")
def dropna_subset(spark, sf_dir):
    return cleaning.drop_empty_rows(DIRTY_EVENTS.frame(spark, sf_dir), ["value", "sparse"])


@query("dropna_one_column", f"""{EVENTS_CTE} SELECT * FROM dirty
    WHERE value IS NOT NULL AND NOT isnan(value)""")
def dropna_one_column(spark, sf_dir):
    return cleaning.drop_empty_rows(DIRTY_EVENTS.frame(spark, sf_dir), ["value"])


@query("dedup_full_row", f"{EVENTS_CTE} SELECT DISTINCT * FROM dirty")
def dedup_full_row(spark, sf_dir):
    return cleaning.drop_duplicate_rows(DIRTY_EVENTS.frame(spark, sf_dir))


LINE_ORDER = """l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
    l_tax, l_returnflag, l_linestatus, l_shipdate"""


@query("dedup_keyed", f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) AS pick
      FROM lineitem) WHERE pick = 1""")
def dedup_keyed(spark, sf_dir):
    return cleaning.drop_duplicate_rows(load(spark, sf_dir, "lineitem"), ["l_orderkey"]).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )


@query("distinct_dates", "SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders")
def distinct_dates(spark, sf_dir):
    dates = load(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    return dates.distinct().select(F.col("d").cast("string").alias("d"))


CLEANED_EVENTS = f"""{EVENTS_CTE}, kept AS (
      SELECT id, value, kind, sixty FROM (
        SELECT *, row_number() OVER (PARTITION BY id, kind
          ORDER BY value NULLS LAST, sixty NULLS LAST, sparse NULLS LAST) AS pick
        FROM dirty WHERE id IS NOT NULL OR kind IS NOT NULL) WHERE pick = 1)"""


@query("clean_dataset", f"{CLEANED_EVENTS} SELECT * FROM kept")
def clean_dataset(spark, sf_dir):
    return DIRTY_EVENTS.frame(spark, sf_dir).transform(
        cleaning.clean(["id", "kind"], drop_cols=True, thresh=0.7, staging=scratch_dir(spark, "clean"))
    )


@query("clean_dataset_full_row", f"""{EVENTS_CTE}
    SELECT DISTINCT * FROM dirty WHERE id IS NOT NULL OR (value IS NOT NULL AND NOT isnan(value))
      OR kind IS NOT NULL OR sixty IS NOT NULL OR sparse IS NOT NULL""")
def clean_dataset_full_row(spark, sf_dir):
    return DIRTY_EVENTS.frame(spark, sf_dir).transform(cleaning.clean())


TEMPERATURES_CLEAN = f"""WITH raw AS ({TEMPERATURES.sql()}), kept AS (
      SELECT * EXCLUDE (pick) FROM (
        SELECT *, row_number() OVER (PARTITION BY dt, "City", "Country"
          ORDER BY "AverageTemperature", "AverageTemperatureUncertainty" NULLS LAST,
                   "Latitude", "Longitude") AS pick
        FROM raw WHERE "AverageTemperature" IS NOT NULL AND NOT isnan("AverageTemperature"))
      WHERE pick = 1)"""


@query("clean_temperatures_by_key", f"""{TEMPERATURES_CLEAN}
    SELECT CAST(dt AS VARCHAR) AS dt, * EXCLUDE (dt) FROM kept""")
def clean_temperatures_by_key(spark, sf_dir):
    kept = cleaning.TEMPERATURES_BY_CITY_DATE(TEMPERATURES.frame(spark, sf_dir))
    return kept.withColumn("dt", F.col("dt").cast("string"))


CITY_KEY = ("City", "Male Population", "Female Population", "Foreign-born", "Average Household Size")
DEMOGRAPHICS_KEY = ", ".join(f'"{c}"' for c in CITY_KEY)
DEMOGRAPHICS_REST = ", ".join(
    f'"{c}" NULLS LAST' for c in DEMOGRAPHICS.columns if c not in CITY_KEY
)


@query("clean_demographics_by_key", f"""SELECT * EXCLUDE (pick) FROM (
      SELECT *, row_number() OVER (PARTITION BY {DEMOGRAPHICS_KEY} ORDER BY {DEMOGRAPHICS_REST}) AS pick
      FROM ({DEMOGRAPHICS.sql()})) WHERE pick = 1""")
def clean_demographics_by_key(spark, sf_dir):
    return cleaning.DEMOGRAPHICS_BY_CITY(DEMOGRAPHICS.frame(spark, sf_dir))


# --- aggregates ------------------------------------------------------------

@query("row_count", "SELECT count(*) AS rows FROM lineitem")
def row_count(spark, sf_dir):
    return aggregates.row_count(load(spark, sf_dir, "lineitem"))


@query("group_count", "SELECT l_returnflag, count(*) AS count FROM lineitem GROUP BY l_returnflag")
def group_count(spark, sf_dir):
    return aggregates.group_count(load(spark, sf_dir, "lineitem"), "l_returnflag")


@query("group_sum", """
    SELECT l_returnflag, sum(l_quantity) AS sum_l_quantity FROM lineitem GROUP BY l_returnflag""")
def group_sum(spark, sf_dir):
    return aggregates.group_sum(load(spark, sf_dir, "lineitem"), "l_returnflag", "l_quantity")


@query("global_avg", "SELECT avg(l_quantity) AS avg_l_quantity FROM lineitem")
def global_avg(spark, sf_dir):
    return aggregates.global_avg(load(spark, sf_dir, "lineitem"), "l_quantity")


@query("numeric_averages", """
    SELECT avg(l_partkey) AS avg_l_partkey, avg(l_linenumber) AS avg_l_linenumber,
      avg(l_quantity) AS avg_l_quantity FROM lineitem""")
def numeric_averages(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    return aggregates.numeric_avgs(lines.select("l_partkey", "l_returnflag", "l_linenumber", "l_quantity"))


@query("top_k_groups", """
    SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY l_partkey
    ORDER BY count DESC, l_partkey LIMIT 10""")
def top_k_groups(spark, sf_dir):
    counts = aggregates.group_count(load(spark, sf_dir, "lineitem"), "l_partkey")
    return aggregates.top_k(counts, "count", "l_partkey", 10)


@query("duplicate_count", f"""{EVENTS_CTE}
    SELECT (SELECT count(*) FROM dirty) AS rows,
           (SELECT count(*) FROM dirty) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty))
             AS duplicates""")
def duplicate_count(spark, sf_dir):
    return aggregates.duplicate_count(DIRTY_EVENTS.frame(spark, sf_dir))


ARRIVALS_CTE = f"WITH raw AS ({ARRIVALS.sql()})"
REPORT_COUNTS = """(SELECT count(*) FROM {t}) AS n,
    (SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS d"""
REPORT_COLUMNS = """n AS total_rows, d AS duplicates,
    CASE WHEN n = 0 OR d > 0 THEN 'failed' ELSE 'passed' END AS status,
    CASE WHEN n = 0 THEN 'Data quality check failed. Table has 0 records.'
         WHEN d > 0 THEN 'Data quality check failed. Table has ' || d || ' duplicates.'
         ELSE 'Data quality check passed. Table has ' || n || ' and no duplicates.' END AS message"""


@query("quality_report", f"""{ARRIVALS_CTE}, counts AS (
      SELECT 'arrivals' AS table_name, {REPORT_COUNTS.format(t='raw')}
      UNION ALL SELECT 'orders', {REPORT_COUNTS.format(t='orders')}
      UNION ALL SELECT 'nothing', 0, 0)
    SELECT table_name, {REPORT_COLUMNS} FROM counts""")
def quality_report(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    return (
        quality.quality_report(ARRIVALS.frame(spark, sf_dir), "arrivals")
        .unionByName(quality.quality_report(orders, "orders"))
        .unionByName(quality.quality_report(orders.filter("o_orderkey < 0"), "nothing"))
    )


# --- dates and keys --------------------------------------------------------

DAYS_CTE = f"""WITH coded AS ({CODED_DAYS.sql()}), dated AS (
    SELECT *, CASE WHEN day_number >= -715509 AND day_number < 2936550
      THEN DATE '1960-01-01' + CAST(floor(day_number) AS INTEGER) END AS d FROM coded)"""


@query("sas_date", f"{DAYS_CTE} SELECT o_orderkey, day_number, CAST(d AS VARCHAR) AS iso_date FROM dated")
def sas_date(spark, sf_dir):
    coded = CODED_DAYS.frame(spark, sf_dir)
    return coded.withColumn("iso_date", day_number_to_date(F.col("day_number")).cast("string"))


@query("calendar_parts", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
      CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day,
      CAST(weekofyear(o_orderdate) AS INTEGER) AS week,
      CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS weekday FROM orders""")
def parts_of_date(spark, sf_dir):
    parts = calendar_parts(F.col("o_orderdate"))
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", *[column.alias(name) for name, column in parts.items()]
    )


@query("date_key", f"""{DAYS_CTE}
    SELECT o_orderkey, coalesce(CAST(strftime(d, '%Y%m%d') AS BIGINT), 0) AS id FROM dated""")
def key_of_date(spark, sf_dir):
    coded = CODED_DAYS.frame(spark, sf_dir)
    return coded.select("o_orderkey", date_key(day_number_to_date(F.col("day_number"))).alias("id"))


def hash_key_sql(columns, doubles=()):
    """Check SQL of ``hash_key``; ``doubles`` names the floating-point columns."""
    parts = []
    for name in columns:
        value = f"(CAST({name} AS DOUBLE) + 0.0::DOUBLE)" if name in doubles else name
        parts.append(f"coalesce(length(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')")
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 15) AS BIGINT)"


@query("hash_key", f"""
    SELECT p_partkey, {hash_key_sql(["p_name", "p_brand", "p_size", "p_retailprice"], ["p_retailprice"])}
      AS id FROM part""")
def key_of_hash(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    return part.select("p_partkey", hash_key(part, ["p_name", "p_brand", "p_size", "p_retailprice"]).alias("id"))
