"""Table builders, jobs, questions, star joins and integrity checks."""

from dataclasses import replace

from pyspark.sql import functions as F

from landfall.operators import cleaning
from landfall.plans import jobs, model, quality, questions, star
from landfall.session import free_disk, scratch_dir
from landfall.sources import writers
from landfall.sources.paths import join_path
from suite.inputs import ARRIVALS, DEMOGRAPHICS, TEMPERATURES, load
from suite.operator_queries import REPORT_COLUMNS, REPORT_COUNTS, TEMPERATURES_CLEAN, hash_key_sql
from suite.registry import query


def _iso(df, *names):
    """Dates as ISO text, so that both engines report them alike."""
    return df.withColumns({n: F.col(n).cast("string") for n in names})


# --- check SQL of the model ------------------------------------------------

def _date_sql(column):
    return (
        f"CASE WHEN {column} >= -715509 AND {column} < 2936550 "
        f"THEN DATE '1960-01-01' + CAST(floor({column}) AS INTEGER) END"
    )


def _names(columns):
    return ", ".join(f'"{c}"' for c in columns)


RAW = f"raw AS ({ARRIVALS.sql()})"
# Written out, not taken from the library: a column lost there must show here.
FACT_COLUMNS = (
    "cicid", "arrdate", "count", "visapost", "entdepa", "entdepd", "biryear", "dtaddto", "airline", "fltno",
    "visatype", "i94addr", "i94visa",
)
IMMIGRANT_COLUMNS = ("cicid", "i94cit", "i94res", "i94mode", "depdate", "i94bir", "gender")
MODEL_COLUMNS = (
    "cicid", "i94cit", "i94res", "arrdate", "i94mode", "i94addr", "depdate", "i94bir", "i94visa", "count",
    "visapost", "entdepa", "entdepd", "biryear", "dtaddto", "gender", "airline", "fltno", "visatype",
)
CITY_COLUMNS = {
    "City": "city", "State": "state", "Median Age": "median_age", "Male Population": "male_pop",
    "Female Population": "female_pop", "Total Population": "total_pop", "Number of Veterans": "veteran_number",
    "Foreign-born": "foreign_born", "Average Household Size": "avg_household_size", "State Code": "state_code",
    "Race": "race", "Count": "count",
}
READING_COLUMNS = {
    "dt": "dt", "AverageTemperature": "avg_temp", "AverageTemperatureUncertainty": "avg_temp_uncertainty",
    "City": "city", "Country": "country", "Latitude": "latitude", "Longitude": "longitude",
}
CLEAN = f"""clean AS (SELECT * EXCLUDE (pick) FROM (
      SELECT {_names(MODEL_COLUMNS)}, row_number() OVER (PARTITION BY cicid ORDER BY
        {", ".join(f'"{c}" NULLS LAST' for c in MODEL_COLUMNS if c != "cicid")}) AS pick
      FROM raw WHERE cicid IS NOT NULL AND NOT isnan(cicid)) WHERE pick = 1)"""
FACT = f"""fact AS (SELECT * REPLACE ({_date_sql('arrdate')} AS arrdate)
      FROM (SELECT {_names(FACT_COLUMNS)} FROM clean))"""
IMMIGRANT = f"immigrant AS (SELECT {_names(IMMIGRANT_COLUMNS)} FROM clean)"


def _calendar(name, source):
    return f"""{name} AS (SELECT arrdate, coalesce(CAST(strftime(arrdate, '%Y%m%d') AS BIGINT), 0) AS id,
      CAST(year(arrdate) AS INTEGER) AS year, CAST(month(arrdate) AS INTEGER) AS month,
      CAST(day(arrdate) AS INTEGER) AS day, CAST(weekofyear(arrdate) AS INTEGER) AS week,
      CAST(dayofweek(arrdate) + 1 AS INTEGER) AS weekday
      FROM (SELECT DISTINCT {_date_sql('arrdate')} AS arrdate FROM {source}))"""


CALENDAR = _calendar("calendar", "clean")
STAR = f"WITH {RAW}, {CLEAN}, {FACT}, {IMMIGRANT}, {CALENDAR}"
DEMOGRAPHICS_ID = hash_key_sql(
    list(CITY_COLUMNS.values()), ("median_age", "avg_household_size")
)
DEMOGRAPHICS_DIM = f"""demographics_rows AS (SELECT DISTINCT * FROM ({DEMOGRAPHICS.sql()})),
    renamed AS (SELECT {", ".join(f'"{a}" AS {b}' for a, b in CITY_COLUMNS.items())}
      FROM demographics_rows),
    demographics AS (SELECT *, {DEMOGRAPHICS_ID} AS id FROM renamed)"""
TEMPERATURES_RENAMED = ", ".join(f'"{a}" AS {b}' for a, b in READING_COLUMNS.items())
TEMPERATURES_DIM = f"{TEMPERATURES_CLEAN}, temperatures AS (SELECT {TEMPERATURES_RENAMED} FROM kept)"


# --- the same inputs in Spark ----------------------------------------------

def _clean_arrivals(spark, sf_dir):
    return jobs.clean_arrivals(ARRIVALS.frame(spark, sf_dir), cleaning.ARRIVALS_BY_ID)


def _staged_arrivals(spark, sf_dir):
    """Cleaned once and stored, for queries that build several tables from it."""
    return writers.stage_parquet(_clean_arrivals(spark, sf_dir), scratch_dir(spark, "staged"))


def _demographics(spark, sf_dir):
    return model.dim_demographics(cleaning.FULL_ROW(DEMOGRAPHICS.frame(spark, sf_dir)))


def _temperatures(spark, sf_dir):
    raw = TEMPERATURES.frame(spark, sf_dir)
    return model.dim_temperatures(cleaning.TEMPERATURES_BY_CITY_DATE(raw))


# --- builders --------------------------------------------------------------

@query("clean_arrivals_by_key", f"WITH {RAW}, {CLEAN} SELECT * FROM clean")
def clean_arrivals_by_key(spark, sf_dir):
    return _clean_arrivals(spark, sf_dir)


RULE_DROPS = ("occup", "entdepu", "insnum")
RULE_ORDER = [c for c in MODEL_COLUMNS if c != "cicid"] + [
    c for c in ARRIVALS.columns if c not in MODEL_COLUMNS and c not in RULE_DROPS]


@query("clean_arrivals_rule", f"""WITH {RAW} SELECT * EXCLUDE (pick) FROM (
    SELECT * EXCLUDE ({_names(RULE_DROPS)}), row_number() OVER (PARTITION BY cicid ORDER BY
      {", ".join(f'"{c}" NULLS LAST' for c in RULE_ORDER)}) AS pick
    FROM raw WHERE cicid IS NOT NULL AND NOT isnan(cicid)) WHERE pick = 1""")
def clean_arrivals_rule(spark, sf_dir):
    """The rule itself on all its 25 columns."""
    return cleaning.ARRIVALS_BY_ID(ARRIVALS.frame(spark, sf_dir))


@query("dim_calendar", f"""WITH {RAW}, {_calendar('calendar', 'raw')}
    SELECT * REPLACE (CAST(arrdate AS VARCHAR) AS arrdate) FROM calendar""")
def dim_calendar(spark, sf_dir):
    return _iso(model.dim_calendar(ARRIVALS.frame(spark, sf_dir)), "arrdate")


@query("dim_calendar_known_dates", f"""WITH {RAW}, {_calendar('calendar', 'raw')}
    SELECT * REPLACE (CAST(arrdate AS VARCHAR) AS arrdate) FROM calendar WHERE arrdate IS NOT NULL""")
def dim_calendar_known_dates(spark, sf_dir):
    return _iso(model.dim_calendar(ARRIVALS.frame(spark, sf_dir), keep_unknown=False), "arrdate")


@query("dim_immigrant", f"{STAR} SELECT * FROM immigrant")
def dim_immigrant(spark, sf_dir):
    return model.dim_immigrant(_clean_arrivals(spark, sf_dir))


@query("dim_demographics", f"WITH {DEMOGRAPHICS_DIM} SELECT * FROM demographics")
def dim_demographics(spark, sf_dir):
    return _demographics(spark, sf_dir)


@query("dim_temperatures", f"""{TEMPERATURES_DIM}
    SELECT * REPLACE (CAST(dt AS VARCHAR) AS dt) FROM temperatures""")
def dim_temperatures(spark, sf_dir):
    return _iso(_temperatures(spark, sf_dir), "dt")


@query("fact_arrivals", f"{STAR} SELECT * REPLACE (CAST(arrdate AS VARCHAR) AS arrdate) FROM fact")
def fact_arrivals(spark, sf_dir):
    return _iso(model.fact_arrivals(_clean_arrivals(spark, sf_dir)), "arrdate")


@query("departure_date", f"""{STAR}
    SELECT * EXCLUDE (d), CAST(d AS VARCHAR) AS depdate_dt
    FROM (SELECT *, {_date_sql('depdate')} AS d FROM immigrant)""")
def departure_date(spark, sf_dir):
    immigrant = model.dim_immigrant(_clean_arrivals(spark, sf_dir))
    return _iso(model.with_departure_date(immigrant), "depdate_dt")


# --- jobs ------------------------------------------------------------------

def _lake(spark, sf_dir, **sources):
    """Write the named source views in their file formats; the config that reads them."""
    base = scratch_dir(spark, "lake")
    cfg = jobs.LakeConfig(
        output=join_path(base, "output"), staging=join_path(base, "staging"), inputs=join_path(base, "input")
    )
    for name, (view, sep) in sources.items():
        target = view.frame(spark, sf_dir).write
        path = join_path(cfg.inputs, getattr(cfg, name))
        if sep:
            target.option("header", True).option("sep", sep).csv(path)
        else:
            target.parquet(path)
    return cfg


ARRIVALS_SOURCE = {"arrivals": (ARRIVALS, None)}
DEMOGRAPHICS_SOURCE = {"demographics": (DEMOGRAPHICS, ";")}
TEMPERATURES_SOURCE = {"temperatures": (TEMPERATURES, ",")}


def _report(*tables):
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {REPORT_COUNTS.format(t=cte)}" for name, cte in tables
    )
    return f"SELECT table_name, {REPORT_COLUMNS} FROM ({counts})"


ARRIVALS_TABLES = (
    ("dim_calendar", "calendar"), ("dim_immigrant", "immigrant"), ("fact_i94_immigration", "fact"),
)


@query("job_arrivals", f"{STAR} {_report(*ARRIVALS_TABLES)}")
def job_arrivals(spark, sf_dir):
    return jobs.report_frame(spark, jobs.run_arrivals(spark, _lake(spark, sf_dir, **ARRIVALS_SOURCE)))


@query("job_demographics", f"WITH {DEMOGRAPHICS_DIM} {_report(('dim_usa_demographics', 'demographics'))}")
def job_demographics(spark, sf_dir):
    cfg = _lake(spark, sf_dir, **DEMOGRAPHICS_SOURCE)
    return jobs.report_frame(spark, jobs.run_demographics(spark, cfg))


@query("job_temperatures", f"{TEMPERATURES_DIM} {_report(('dim_temperatures', 'temperatures'))}")
def job_temperatures(spark, sf_dir):
    cfg = _lake(spark, sf_dir, **TEMPERATURES_SOURCE)
    return jobs.report_frame(spark, jobs.run_temperatures(spark, cfg))


WHOLE_LAKE = STAR.replace(RAW, f"arrivals_{RAW}", 1).replace("FROM raw ", "FROM arrivals_raw ", 1)
WHOLE_LAKE += f", {DEMOGRAPHICS_DIM}, {TEMPERATURES_DIM.removeprefix('WITH ')}"


@query("run_all_jobs", f"""{WHOLE_LAKE} {_report(
    *ARRIVALS_TABLES, ('dim_usa_demographics', 'demographics'), ('dim_temperatures', 'temperatures'))}""")
def run_all_jobs(spark, sf_dir):
    cfg = _lake(spark, sf_dir, **ARRIVALS_SOURCE, **DEMOGRAPHICS_SOURCE, **TEMPERATURES_SOURCE)
    return jobs.report_frame(spark, jobs.run_all(spark, cfg))


@query("job_arrivals_fact", f"{STAR} SELECT * REPLACE (CAST(arrdate AS VARCHAR) AS arrdate) FROM fact")
def job_arrivals_fact(spark, sf_dir):
    cfg = _lake(spark, sf_dir, **ARRIVALS_SOURCE)
    jobs.run_arrivals(spark, cfg)
    return _iso(jobs.read_table(spark, cfg, "fact_i94_immigration"), "arrdate")


@query("monthly_refresh", f"""WITH
    first AS (SELECT CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE)
      AS arrdate FROM orders),
    later AS (SELECT CAST(date_diff('day', DATE '1960-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE)
      AS arrdate FROM lineitem WHERE year(l_shipdate) >= 2001),
    {_calendar('before', 'first')}, {_calendar('batch', 'later')}
    SELECT * REPLACE (CAST(arrdate AS VARCHAR) AS arrdate) FROM batch
    UNION SELECT * REPLACE (CAST(arrdate AS VARCHAR) AS arrdate) FROM before""")
def monthly_refresh(spark, sf_dir):
    cfg = _lake(spark, sf_dir)
    days = "CAST(datediff(CAST({} AS DATE), DATE '1960-01-01') AS DOUBLE) AS arrdate"
    orders = load(spark, sf_dir, "orders").selectExpr(days.format("o_orderdate"))
    writers.write_partitioned(
        model.dim_calendar(orders), join_path(cfg.output, "dim_calendar"), jobs.CALENDAR_PARTITIONS
    )
    later = load(spark, sf_dir, "lineitem").filter(F.year("l_shipdate") >= 2001)
    jobs.refresh_calendar(later.selectExpr(days.format("l_shipdate")), cfg)
    return _iso(jobs.read_table(spark, cfg, "dim_calendar"), "arrdate")


# A day in the middle of a month: the batch adds to a stored month and brings later ones.
LATER = "coalesce(arrdate >= 13000 OR isnan(arrdate), false)"
LATER_DT = "coalesce(dt >= DATE '2024-01-16', false)"
MONTHLY_CLEAN = CLEAN.replace(
    "PARTITION BY cicid", f"PARTITION BY cicid, year({_date_sql('arrdate')}), month({_date_sql('arrdate')})", 1)


@query("monthly_refresh_fact", f"""WITH {RAW}, {MONTHLY_CLEAN}, {FACT}
    SELECT * REPLACE (CAST(arrdate AS VARCHAR) AS arrdate) FROM fact""")
def monthly_refresh_fact(spark, sf_dir):
    cfg = replace(_lake(spark, sf_dir), monthly=True)
    raw = ARRIVALS.frame(spark, sf_dir)
    raw.filter(f"NOT {LATER}").write.parquet(join_path(cfg.inputs, cfg.arrivals))
    jobs.run_arrivals(spark, cfg)
    jobs.refresh_arrivals(raw.filter(LATER), cfg)
    return _iso(jobs.read_table(spark, cfg, "fact_i94_immigration"), "arrdate")


@query("monthly_refresh_temperatures", f"""{TEMPERATURES_DIM}
    SELECT * REPLACE (CAST(dt AS VARCHAR) AS dt) FROM temperatures""")
def monthly_refresh_temperatures(spark, sf_dir):
    cfg = replace(_lake(spark, sf_dir), monthly=True)
    raw = writers.stage_parquet(TEMPERATURES.frame(spark, sf_dir), scratch_dir(spark, "raw"))
    raw.filter(f"NOT {LATER_DT}").write.option("header", True).csv(join_path(cfg.inputs, cfg.temperatures))
    jobs.run_temperatures(spark, cfg)
    jobs.refresh_temperatures(raw.filter(LATER_DT), cfg)
    return _iso(jobs.read_table(spark, cfg, "dim_temperatures"), "dt")


# --- questions -------------------------------------------------------------

@query("top_states_sum", f"""{STAR} SELECT i94addr, sum("count") AS sum_count FROM fact
    GROUP BY i94addr ORDER BY sum_count DESC, i94addr NULLS LAST LIMIT 10""")
def top_states_sum(spark, sf_dir):
    return questions.top_states_by_sum(model.fact_arrivals(_clean_arrivals(spark, sf_dir)))


@query("top_states_count", f"""{STAR} SELECT i94addr, count(*) AS count FROM fact
    GROUP BY i94addr ORDER BY count(*) DESC, i94addr NULLS LAST LIMIT 10""")
def top_states_count(spark, sf_dir):
    return questions.top_states_by_rows(model.fact_arrivals(_clean_arrivals(spark, sf_dir)))


@query("top_countries", f"""{STAR} SELECT i94cit, count(*) AS count FROM immigrant
    GROUP BY i94cit ORDER BY count(*) DESC, i94cit NULLS LAST LIMIT 10""")
def top_countries(spark, sf_dir):
    return questions.top_birth_countries(model.dim_immigrant(_clean_arrivals(spark, sf_dir)))


@query("gender_distribution", f"""{STAR} SELECT gender, count(*) AS count FROM immigrant
    GROUP BY gender ORDER BY count(*) DESC, gender NULLS LAST LIMIT 10""")
def gender_distribution(spark, sf_dir):
    return questions.gender_distribution(model.dim_immigrant(_clean_arrivals(spark, sf_dir)))


@query("average_age", f"{STAR} SELECT avg(i94bir) AS avg_i94bir FROM immigrant")
def average_age(spark, sf_dir):
    return questions.average_age(model.dim_immigrant(_clean_arrivals(spark, sf_dir)))


def written_top_states(spark, sf_dir):
    """Build and write the arrivals tables, then ask the written fact."""
    cfg = _lake(spark, sf_dir, **ARRIVALS_SOURCE)
    jobs.run_arrivals(spark, cfg)
    return questions.top_states_by_sum(jobs.read_table(spark, cfg, "fact_i94_immigration"))


query("written_top_states", f"""{STAR} SELECT i94addr, sum("count") AS sum_count FROM fact
    GROUP BY i94addr ORDER BY sum_count DESC, i94addr NULLS LAST LIMIT 10""")(written_top_states)


# --- star joins ------------------------------------------------------------

JOIN_IMMIGRANT = f"""WITH {RAW}, {CLEAN.replace("clean AS (", "clean AS MATERIALIZED (", 1)},
    f AS (SELECT cicid, {_date_sql('arrdate')} AS arrdate, "count" FROM clean),
    i AS (SELECT cicid, i94cit, i94bir, gender FROM clean)
    SELECT f.cicid, CAST(f.arrdate AS VARCHAR) AS arrdate, f."count", i.i94cit, i.i94bir, i.gender
    FROM f JOIN i ON f.cicid = i.cicid"""
JOINED = ("cicid", "arrdate", "count", "i94cit", "i94bir", "gender")


@query("join_fact_immigrant", JOIN_IMMIGRANT)
def join_fact_immigrant(spark, sf_dir):
    cleaned = _staged_arrivals(spark, sf_dir)
    joined = star.fact_with_immigrant(model.fact_arrivals(cleaned), model.dim_immigrant(cleaned))
    return _iso(joined.select(*JOINED), "arrdate")


@query("join_fact_immigrant_bucketed", JOIN_IMMIGRANT)
def join_fact_immigrant_bucketed(spark, sf_dir):
    """The same from written tables that are bucketed by the id: no shuffle."""
    cfg = replace(_lake(spark, sf_dir, **ARRIVALS_SOURCE), buckets=8)
    jobs.run_arrivals(spark, cfg)
    return _iso(jobs.join_fact_immigrant(spark, cfg).select(*JOINED), "arrdate")


@query("join_fact_immigrant_full_row", f"""WITH {RAW},
    kept AS MATERIALIZED (SELECT DISTINCT * FROM raw),
    i AS (SELECT * FROM (SELECT cicid, i94cit, i94bir, gender, row_number() OVER (PARTITION BY cicid ORDER BY
        {", ".join(f"{c} NULLS LAST" for c in IMMIGRANT_COLUMNS[1:])}) AS pick
      FROM kept WHERE cicid IS NOT NULL AND NOT isnan(cicid)) WHERE pick = 1)
    SELECT f.cicid, CAST({_date_sql('f.arrdate')} AS VARCHAR) AS arrdate, f."count", i.i94cit, i.i94bir, i.gender
    FROM kept f JOIN i ON f.cicid = i.cicid""")
def join_fact_immigrant_full_row(spark, sf_dir):
    """Cleaned by whole rows: ids are missing, NaN and repeated on both sides."""
    rows = jobs.clean_whole_arrivals(ARRIVALS.frame(spark, sf_dir), cleaning.FULL_ROW)
    cleaned = writers.stage_parquet(rows.select(*model.arrivals_model_columns()), scratch_dir(spark, "rows"))
    del rows
    free_disk(spark)
    joined = star.fact_with_immigrant(model.fact_arrivals(cleaned), model.dim_immigrant(cleaned))
    return _iso(joined.select(*JOINED), "arrdate")


@query("join_fact_calendar_quarter", f"""{STAR}
    SELECT f.cicid, CAST(f.arrdate AS VARCHAR) AS arrdate, f.airline, c.year, c.month, c.weekday
    FROM fact f JOIN calendar c ON f.arrdate = c.arrdate WHERE c.year = 1995 AND c.month BETWEEN 4 AND 6""")
def join_fact_calendar_quarter(spark, sf_dir):
    """One quarter of a monthly lake: the calendar's condition prunes the fact's folders."""
    cfg = replace(_lake(spark, sf_dir, **ARRIVALS_SOURCE), monthly=True, one_row_per_key=True)
    jobs.run_arrivals(spark, cfg)
    found = jobs.fact_in_calendar(spark, cfg, "year = 1995 AND month BETWEEN 4 AND 6")
    return _iso(found.select("cicid", "arrdate", "airline", "year", "month", "weekday"), "arrdate")


@query("join_fact_calendar", f"""{STAR}
    SELECT f.cicid, CAST(f.arrdate AS VARCHAR) AS arrdate, c.id, c.year, c.week, c.weekday
    FROM fact f LEFT JOIN calendar c ON f.arrdate = c.arrdate""")
def join_fact_calendar(spark, sf_dir):
    cleaned = _staged_arrivals(spark, sf_dir)
    calendar = writers.stage_parquet(model.dim_calendar(cleaned), scratch_dir(spark, "calendar"))
    joined = star.fact_with_calendar(model.fact_arrivals(cleaned), calendar)
    return _iso(joined.select("cicid", "arrdate", "id", "year", "week", "weekday"), "arrdate")


CITY_TOTALS = ("total_pop", "male_pop", "female_pop", "foreign_born", "veteran_number")
CITIES = f"""cities AS (SELECT state_code, city, {", ".join(f"max({c}) AS {c}" for c in CITY_TOTALS)}
    FROM demographics GROUP BY state_code, city)"""


@query("join_fact_state", f"""{STAR}, {DEMOGRAPHICS_DIM}, {CITIES}, states AS (
      SELECT state_code, count(*) AS cities,
        {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in CITY_TOTALS)}
      FROM cities GROUP BY state_code)
    SELECT f.cicid, f.i94addr, s.cities, s.total_pop, s.foreign_born, s.veteran_number
    FROM fact f LEFT JOIN states s ON f.i94addr = s.state_code""")
def join_fact_state(spark, sf_dir):
    fact = model.fact_arrivals(_clean_arrivals(spark, sf_dir))
    joined = star.fact_with_state(fact, _demographics(spark, sf_dir))
    return joined.select("cicid", "i94addr", "cities", "total_pop", "foreign_born", "veteran_number")


@query("join_city_temperature", f"""{TEMPERATURES_DIM}, {DEMOGRAPHICS_DIM}, {CITIES}, names AS (
      SELECT lower(trim(city)) AS k, count(DISTINCT state_code) AS states,
        CAST(sum(total_pop) AS BIGINT) AS total_pop FROM cities GROUP BY 1)
    SELECT CAST(t.dt AS VARCHAR) AS dt, t.city, t.country, t.avg_temp, n.states, n.total_pop
    FROM temperatures t JOIN names n ON lower(trim(t.city)) = n.k
    WHERE t.country = 'United States'""")
def join_city_temperature(spark, sf_dir):
    joined = star.temperatures_with_city(_temperatures(spark, sf_dir), _demographics(spark, sf_dir))
    return _iso(joined.select("dt", "city", "country", "avg_temp", "states", "total_pop"), "dt")


# --- integrity -------------------------------------------------------------

def _key_sql(name, source, key, missing):
    return f"""SELECT '{name}' AS table_name, (SELECT count(*) FROM {source}) AS total_rows,
      count(*) AS distinct_keys, count(*) FILTER (WHERE n > 1) AS repeated_keys,
      (SELECT count(*) FROM {source} WHERE {missing}) AS rows_without_key
      FROM (SELECT {key}, count(*) AS n FROM {source} WHERE NOT ({missing}) GROUP BY {key})"""


@query("unique_keys", f"""{STAR}
    {_key_sql('raw', 'raw', 'cicid', 'cicid IS NULL OR isnan(cicid)')}
    UNION ALL {_key_sql('fact', 'fact', 'cicid', 'cicid IS NULL')}
    UNION ALL {_key_sql('lineitem', 'lineitem', 'l_orderkey, l_linenumber', 'l_orderkey IS NULL')}""")
def unique_keys(spark, sf_dir):
    fact = model.fact_arrivals(_clean_arrivals(spark, sf_dir))
    return (
        quality.unique_key_report(ARRIVALS.frame(spark, sf_dir), "raw", ["cicid"])
        .unionByName(quality.unique_key_report(fact, "fact", ["cicid"]))
        .unionByName(quality.unique_key_report(
            load(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]))
    )


@query("orphan_rows", """
    SELECT count(DISTINCT o_custkey) AS orphan_keys, count(*) AS orphan_rows FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def orphan_rows(spark, sf_dir):
    parents = load(spark, sf_dir, "customer").filter("c_acctbal > 0")
    return quality.orphan_report(load(spark, sf_dir, "orders"), "o_custkey", parents, "c_custkey")


@query("source_target_count", f"""WITH {RAW} SELECT count(*) AS source_rows, count(*) AS written_rows,
    count(*) AS target_rows FROM raw""")
def source_target_count(spark, sf_dir):
    source = ARRIVALS.frame(spark, sf_dir)
    path = scratch_dir(spark, "counted")
    written = writers.write_table(source, path)
    target = spark.read.parquet(path).count()
    return source.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.lit(written).cast("long").alias("written_rows"),
        F.lit(target).cast("long").alias("target_rows"),
    )
