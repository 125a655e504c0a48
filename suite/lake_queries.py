"""The lake as a whole: what is published, where rows went, refreshes across months, broken lines."""

from dataclasses import replace

from pyspark.sql import functions as F

from landfall.operators import cleaning
from landfall.plans import jobs, quality
from landfall.session import scratch_dir
from landfall.sources import contracts, quarantine, writers
from landfall.sources.paths import join_path
from suite.inputs import ARRIVALS, load
from suite.model_queries import (
    ARRIVALS_SOURCE, CLEAN, DEMOGRAPHICS_DIM, DEMOGRAPHICS_SOURCE, FACT, LATER, RAW, STAR, TEMPERATURES_DIM,
    TEMPERATURES_SOURCE, _iso, _lake,
)
from suite.operator_queries import SUPPLIER
from suite.registry import query


@query("job_failed_check_keeps_old", f"""{STAR}
    SELECT cicid, CAST(arrdate AS VARCHAR) AS arrdate, i94addr, 'failed,passed,passed' AS later_checks FROM fact""")
def job_failed_check_keeps_old(spark, sf_dir):
    """The second run keeps rows that repeat in one of its tables: none of its three is published."""
    cfg = _lake(spark, sf_dir, **ARRIVALS_SOURCE)
    jobs.run_arrivals(spark, cfg)
    later = jobs.run_arrivals(spark, replace(cfg, arrivals_rule=cleaning.FULL_ROW))
    fact = _iso(jobs.read_table(spark, cfg, "fact_i94_immigration"), "arrdate")
    return fact.select("cicid", "arrdate", "i94addr", F.lit(",".join(sorted(c.status for c in later))).alias("later_checks"))


@query("source_target_content", f"""WITH {RAW}
    SELECT 'written' AS table_name, count(*) AS source_rows, count(*) AS target_rows, TRUE AS same_content FROM raw
    UNION ALL SELECT 'one cell changed', count(*), count(*), FALSE FROM raw
    UNION ALL SELECT 'one row for another', count(*), count(*), FALSE FROM raw""")
def source_target_content(spark, sf_dir):
    source = writers.stage_parquet(ARRIVALS.frame(spark, sf_dir), scratch_dir(spark, "source"))
    target = writers.stage_parquet(source.sortWithinPartitions("dtaddto"), scratch_dir(spark, "target"))
    first = target.where("cicid > 0").agg(F.min("cicid")).first()[0]
    changed = target.withColumn("insnum", F.when(F.col("cicid") == first, "other").otherwise(F.col("insnum")))
    again = target.where(f"cicid IS NULL OR cicid <> {first}").union(
        target.where("cicid IS NULL").limit(source.count() - target.where(f"cicid IS NULL OR cicid <> {first}").count()))
    return (
        quality.source_target_report(source, target, "written")
        .unionByName(quality.source_target_report(source, changed, "one cell changed"))
        .unionByName(quality.source_target_report(source, again, "one row for another"))
    )


@query("job_flows", f"""{STAR.replace(RAW, f'arrivals_{RAW}', 1).replace('FROM raw ', 'FROM arrivals_raw ', 1)},
    {DEMOGRAPHICS_DIM}, {TEMPERATURES_DIM.removeprefix('WITH ')}, t AS (
      SELECT 'arrivals' AS dataset, (SELECT count(*) FROM arrivals_raw) AS rows_read,
        (SELECT count(*) FROM arrivals_raw WHERE cicid IS NULL OR isnan(cicid)) AS rows_emptied,
        (SELECT count(*) FROM clean) AS rows_kept
      UNION ALL SELECT 'demographics', (SELECT count(*) FROM part) + (SELECT count(*) FROM part WHERE p_type = 'SMALL'),
        0, (SELECT count(*) FROM demographics)
      UNION ALL SELECT 'temperatures', (SELECT count(*) FROM raw),
        (SELECT count(*) FROM raw WHERE "AverageTemperature" IS NULL OR isnan("AverageTemperature")),
        (SELECT count(*) FROM temperatures))
    SELECT dataset, rows_read, rows_emptied, rows_read - rows_emptied - rows_kept AS rows_repeated, rows_kept FROM t""")
def job_flows(spark, sf_dir):
    """Where the rows of all three sources went, counted along the plans that wrote the tables."""
    cfg = _lake(spark, sf_dir, **ARRIVALS_SOURCE, **DEMOGRAPHICS_SOURCE, **TEMPERATURES_SOURCE)
    return jobs.flow_frame(spark, jobs.run(spark, cfg).flows)


def _kept(column, share=0.2):
    """SQL of a column that is emptied if more than ``share`` of it is missing."""
    return f"""CASE WHEN (SELECT round(count(*) FILTER ({column} IS NULL) / count(*), 3) FROM clean) <= {share}
      THEN {column} END AS {column}"""


@query("job_arrivals_drop_cols", f"""WITH {RAW}, {CLEAN.replace("clean AS", "clean AS MATERIALIZED", 1)}
    SELECT cicid, {_kept('visapost')}, {_kept('gender')}, {_kept('i94addr')}, {_kept('airline')} FROM clean""")
def job_arrivals_drop_cols(spark, sf_dir):
    """Columns with more than a fifth of their values missing after cleaning are emptied by the job."""
    cfg = _lake(spark, sf_dir, **ARRIVALS_SOURCE)
    jobs.run_arrivals(spark, replace(cfg, arrivals_rule=replace(cleaning.ARRIVALS_BY_ID, thresh=0.2)))
    fact, people = (jobs.read_table(spark, cfg, t) for t in ("fact_i94_immigration", "dim_immigrant"))
    return fact.select("cicid", "visapost", "i94addr", "airline").join(people.select("cicid", "gender"), "cicid")


CORRECTED = "cicid % 100 = 31 AND NOT isnan(cicid)"


@query("monthly_refresh_moved", f"""WITH sent AS ({ARRIVALS.sql()}), raw AS (
      SELECT * FROM sent UNION ALL SELECT * REPLACE (arrdate - 62 AS arrdate) FROM sent WHERE {CORRECTED}), {CLEAN}, {FACT}
    SELECT cicid, CAST(arrdate AS VARCHAR) AS arrdate, airline, i94addr FROM fact""")
def monthly_refresh_moved(spark, sf_dir):
    """A later batch brings new arrivals, and earlier ones with corrected dates: these change their month."""
    cfg = replace(_lake(spark, sf_dir), monthly=True, one_row_per_key=True)
    raw = ARRIVALS.frame(spark, sf_dir)
    raw.filter(f"NOT {LATER}").write.parquet(join_path(cfg.inputs, cfg.arrivals))
    jobs.run_arrivals(spark, cfg)
    corrected = raw.filter(CORRECTED).withColumn("arrdate", F.col("arrdate") - 62)
    jobs.refresh_arrivals(raw.filter(LATER).unionByName(corrected), cfg)
    fact = _iso(jobs.read_table(spark, cfg, "fact_i94_immigration"), "arrdate")
    return fact.select("cicid", "arrdate", "airline", "i94addr")


NUMBERS = ("cicid", "i94cit", "i94res", "arrdate", "i94mode", "depdate", "i94bir", "i94visa", "count", "biryear")
TEXTS = ("i94addr", "visapost", "entdepa", "entdepd", "dtaddto", "gender", "airline", "fltno", "visatype")


def _summary(column, number):
    missing = f'"{column}" IS NULL' + (f' OR isnan("{column}")' if number else "")
    least, greatest = (f'{f}("{column}") FILTER (NOT ({missing}))' for f in ("min", "max"))
    none = "CAST(NULL AS {})".format("VARCHAR" if number else "DOUBLE")
    ends = f"{least}, {greatest}, {none}, {none}" if number else f"{none}, {none}, {least}, {greatest}"
    return f"""SELECT '{column}', count(*), count(*) FILTER ({missing}),
      round_even(count(*) FILTER ({missing}) / count(*), 3), {ends} FROM clean"""


@query("monthly_profile", f"""WITH {RAW}, {CLEAN.replace("clean AS (", "clean AS MATERIALIZED (", 1)},
    p(column_name, rows, null_count, ratio_to_total, least_number, greatest_number, least_text, greatest_text) AS (
      {" UNION ALL ".join(_summary(c, c in NUMBERS) for c in (*NUMBERS, *TEXTS))})
    SELECT * FROM p""")
def monthly_profile(spark, sf_dir):
    """Profile of a lake after a refresh, from its months' summaries; only touched months were profiled."""
    cfg = replace(_lake(spark, sf_dir), monthly=True, one_row_per_key=True)
    raw = ARRIVALS.frame(spark, sf_dir)
    raw.filter(f"NOT {LATER}").write.parquet(join_path(cfg.inputs, cfg.arrivals))
    jobs.run_arrivals(spark, cfg)
    jobs.refresh_arrivals(raw.filter(LATER), cfg)
    return jobs.read_profile(spark, cfg).drop("distinct")


# Lines of the suppliers' file: some with a field too many or too few, some with a wrong value.
LINE = """CASE WHEN s_suppkey % 13 = 0 THEN concat_ws(',', s_suppkey, s_name, s_nationkey, '1.5', 'more')
    WHEN s_suppkey % 11 = 0 THEN concat_ws(',', s_suppkey, s_name)
    WHEN s_suppkey % 7 = 0 THEN concat_ws(',', s_suppkey, s_name, 'x', '1.5')
    ELSE concat_ws(',', s_suppkey, s_name, s_nationkey, '1.5') END"""
REASON = """CASE WHEN s_suppkey % 13 = 0 OR s_suppkey % 11 = 0 THEN 'wrong number of fields'
    WHEN s_suppkey % 7 = 0 THEN 'Nation Key is not {}' END"""


@query("csv_quarantine", f"""SELECT CASE WHEN reason IS NULL THEN s_suppkey END AS supplier,
      CASE WHEN reason IS NOT NULL THEN line END AS line, reason
    FROM (SELECT s_suppkey, {LINE} AS line, {REASON.format(SUPPLIER['Nation Key'].dataType.simpleString())} AS reason
      FROM supplier)""")
def csv_quarantine(spark, sf_dir):
    """Good rows go on, broken lines go to a side table with the reason."""
    path = scratch_dir(spark, "lines")
    lines = load(spark, sf_dir, "supplier").select(F.expr(LINE).alias(",".join(SUPPLIER.names)))
    # One column and a separator that no line holds: lines are written as they are.
    lines.write.option("header", True).option("sep", "\x01").csv(path)
    staged = quarantine.stage_csv(spark, path, SUPPLIER, scratch_dir(spark, "staged"), tolerance=0.5)
    good = staged.rows.select(F.col(SUPPLIER.names[0]).cast("long").alias("supplier"),
                              F.lit(None).cast("string").alias("line"), F.lit(None).cast("string").alias("reason"))
    return good.unionByName(staged.rejected.select(F.lit(None).cast("long").alias("supplier"), "line", "reason"))


@query("parquet_contract_per_file", """
    SELECT folder, "column", problem, count(*) > 0 AS found FROM supplier, (VALUES
      ('lacks', 's_acctbal', 'absent'), ('lacks', 's_name', 'absent'),
      ('retyped', 's_nationkey', 'is string, not int')) v(folder, "column", problem) GROUP BY ALL""")
def parquet_contract_per_file(spark, sf_dir):
    """Folders of whole files, of files that lack columns, and of files with a column of another type."""
    path = scratch_dir(spark, "files")
    supplier = load(spark, sf_dir, "supplier").withColumn("s_nationkey", F.col("s_nationkey").cast("int"))
    supplier.write.parquet(join_path(path, "whole"))
    supplier.drop("s_acctbal", "s_name").write.parquet(join_path(path, "lacks"))
    supplier.withColumn("s_nationkey", F.col("s_nationkey").cast("string")).write.parquet(join_path(path, "retyped"))
    found = contracts.contract_problems(spark, path, supplier.schema)
    folder = F.element_at(F.split("file", "/"), -2).alias("folder")
    return found.groupBy(folder, "column", "problem").agg((F.count(F.lit(1)) > 0).alias("found"))
