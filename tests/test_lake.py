"""Publishing, contents, row flows, moves between months, broken lines."""

import datetime as dt
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from landfall import schemas
from landfall.operators import cleaning
from landfall.plans import jobs, model, quality
from landfall.sources import contracts, quarantine, readers, versions, writers
from tests.test_model import DAY, NAN, arrivals, few, lake  # noqa: F401

TABLES = ("dim_calendar", "dim_immigrant", "fact_i94_immigration")


def contents(spark, cfg, rows):
    return {t: rows(jobs.read_table(spark, cfg, t)) for t in TABLES}


@pytest.fixture
def published(spark, tmp_path, few):  # noqa: F811
    cfg = lake(spark, tmp_path, few)
    assert jobs.run(spark, cfg).manifest == 1
    return cfg


def test_a_failed_check_publishes_nothing(spark, published, rows):
    before = contents(spark, published, rows)
    keep_all = lambda df: df
    keep_all.keys = None
    for later in (replace(published, arrivals_rule=keep_all), replace(published, arrivals="none")):
        arrivals(spark).write.mode("overwrite").parquet(f"{published.inputs}/none")
        report = jobs.run(spark, later)
        assert report.manifest is None and "failed" in {c.status for c in report.checks}
        assert contents(spark, published, rows) == before
    assert versions.read_manifest(spark, published.output)[0] == 1


def test_a_run_that_dies_publishes_nothing(spark, published, rows, monkeypatch):
    before = contents(spark, published, rows)
    real = quality.check_table

    def dies(df, table, keys=None):
        if table == "fact_i94_immigration":  # two tables are written and checked by then, or about to be
            raise RuntimeError("lost")
        return real(df, table, keys)

    arrivals(spark, dict(cicid=7.0, arrdate=DAY, count=1.0)).write.mode("overwrite").parquet(
        f"{published.inputs}/{published.arrivals}")
    monkeypatch.setattr(quality, "check_table", dies)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.run(spark, published)
    assert contents(spark, published, rows) == before
    monkeypatch.undo()
    assert jobs.run(spark, published).manifest == 2
    assert [r.cicid for r in jobs.read_table(spark, published, "dim_immigrant").collect()] == [7.0]


def test_a_reader_keeps_the_version_it_opened(spark, published, rows):
    fact = jobs.read_table(spark, published, "fact_i94_immigration")
    before = rows(fact)
    arrivals(spark, dict(cicid=7.0, arrdate=DAY, count=1.0)).write.mode("overwrite").parquet(
        f"{published.inputs}/{published.arrivals}")
    jobs.run_arrivals(spark, published)
    assert rows(fact) == before and jobs.read_table(spark, published, "fact_i94_immigration").count() == 1
    # The other tables are still named by the new manifest.
    assert jobs.read_table(spark, published, "dim_temperatures").count() == 1


def test_runs_on_one_base_conflict(spark, published):
    seen = {"dim_calendar": versions.table_parts(spark, published.output, "dim_calendar", jobs.CALENDAR_PARTITIONS)}
    assert versions.publish(spark, published.output, {"dim_calendar": {"": "a"}}, seen) == 2
    with pytest.raises(versions.PublishConflict):
        versions.publish(spark, published.output, {"dim_calendar": {"": "b"}}, seen)
    assert versions.publish(spark, published.output, {"other": {"": "c"}}) == 3
    assert versions.read_manifest(spark, published.output)[1]["dim_calendar"] == {"": "a"}


def test_a_number_that_another_run_took_is_not_replaced(spark, published, monkeypatch):
    real, calls = versions.read_manifest, []

    def late(spark_, output, number=None):
        calls.append(1)
        found = real(spark_, output, number)
        if len(calls) == 1:  # between the look and the rename, another run publishes
            monkeypatch.setattr(versions, "read_manifest", real)
            versions.publish(spark_, output, {"other": {"": "first"}})
        return found

    monkeypatch.setattr(versions, "read_manifest", late)
    assert versions.publish(spark, published.output, {"mine": {"": "second"}}) == 3
    tables = real(spark, published.output)[1]
    assert tables["other"] == {"": "first"} and tables["mine"] == {"": "second"}


def test_old_versions_are_removed_on_request(spark, published, rows):
    for _ in range(2):
        jobs.run(spark, published)
    before = contents(spark, published, rows)
    assert versions.remove_old(spark, published.output, keep=1) == []  # all are young
    time.sleep(1.1)
    gone = versions.remove_old(spark, published.output, keep=1, idle_hours=0)
    assert len(gone) == 10 and contents(spark, published, rows) == before


def test_a_lake_written_without_a_manifest_is_found(spark, tmp_path, few, rows):  # noqa: F811
    cfg = lake(spark, tmp_path, few)
    calendar, people = model.dim_calendar(few), model.dim_immigrant(few)
    writers.write_partitioned(calendar, f"{cfg.output}/dim_calendar", jobs.CALENDAR_PARTITIONS)
    writers.write_table(people, f"{cfg.output}/dim_immigrant")
    assert rows(jobs.read_table(spark, cfg, "dim_calendar")) == rows(calendar)
    assert rows(jobs.read_table(spark, cfg, "dim_immigrant")) == rows(people)
    assert jobs.read_table(spark, cfg, "dim_temperatures").count() == 0


# --- contents --------------------------------------------------------------

def test_contents_agree_only_if_all_rows_do(spark):
    rows_ = [(1, "a", 1.5), (1, "a", 1.5), (None, "", NAN), (2, None, -0.0), (None, None, None)]
    df = spark.createDataFrame(rows_, "k int, s string, x double")

    def same(other):
        return quality.source_target_report(df, other, "t").first()["same_content"]

    assert same(df.repartition(3).orderBy(F.col("x").desc()).select("x", "s", "k"))
    for changed in (df.union(df.limit(1)), df.limit(4), df.withColumn("s", F.when(F.col("k") == 2, "").otherwise(F.col("s"))),
                    df.where("k IS NULL OR k = 2").union(df.where("k = 2")).union(df.where("k = 2")),
                    df.select(F.col("k"), F.reverse("s").alias("s"), (F.col("x") + 1e-9).alias("x"))):
        assert not same(changed)
    report = quality.source_target_report(df.limit(0), df.limit(0), "t").first()
    assert (report["source_rows"], report["target_rows"], report["same_content"]) == (0, 0, True)


def test_a_changed_cell_in_a_written_table_fails_the_job(spark, published, monkeypatch):
    real = jobs._write

    def corrupting(df, cfg, run, table, *args, **kwargs):
        parts, stored, measured = real(df, cfg, run, table, *args, **kwargs)
        if table == "fact_i94_immigration":
            stored = stored.withColumn("airline", F.when(F.col("cicid") == 2, "??").otherwise(F.col("airline")))
        return parts, stored, measured

    monkeypatch.setattr(jobs, "_write", corrupting)
    with pytest.raises(jobs.CheckFailed, match="fact_i94_immigration.*read back"):
        jobs.run_arrivals(spark, published)
    assert versions.read_manifest(spark, published.output)[0] == 1


# --- flows and sparse columns ----------------------------------------------

def test_flows_add_up(spark, tmp_path, few):  # noqa: F811
    for name, options in (("a", {}), ("b", {"monthly": True}), ("c", {"arrivals_rule": cleaning.FULL_ROW})):
        cfg = lake(spark, tmp_path / name, few.union(arrivals(spark, {}, {})), **options)
        flows = {f.dataset: tuple(f)[1:] for f in jobs.run(spark, cfg).flows}
        assert flows["arrivals"] == ((9, 2, 1, 6) if name == "c" else (9, 3, 1, 5))
        assert flows["demographics"] == (3, 0, 1, 2) and flows["temperatures"] == (3, 1, 1, 1)
        assert all(f[0] == f[1] + f[2] + f[3] for f in flows.values())


def test_flows_are_counted_anew_if_they_do_not_add_up(spark, few):  # noqa: F811
    flow = cleaning.RowFlow("arrivals")
    flow.counts = lambda: cleaning.FlowCount("arrivals", 99, 1, 1, 5)
    assert jobs._flows(flow, few, cleaning.ARRIVALS_BY_ID, 5) == [cleaning.FlowCount("arrivals", 7, 1, 1, 5)]


def test_sparse_columns_are_emptied(spark, tmp_path, few):  # noqa: F811
    # Of five kept arrivals, gender is missing in two, i94cit in two, the age in two, arrdate in two.
    for thresh, left in ((0.4, {"F", "M", None}), (0.39, {None})):
        cfg = lake(spark, tmp_path / str(thresh), few, arrivals_rule=replace(cleaning.ARRIVALS_BY_ID, thresh=thresh))
        assert jobs.run(spark, cfg).manifest == 1
        people = jobs.read_table(spark, cfg, "dim_immigrant")
        assert {r.gender for r in people.collect()} == left and people.schema == schemas.DIM_IMMIGRANT
    cfg = lake(spark, tmp_path / "t", few, temperatures_rule=replace(cleaning.TEMPERATURES_BY_CITY_DATE, thresh=0.0))
    assert jobs.run(spark, cfg).manifest == 1 and not list((tmp_path / "t" / "stage").glob("*"))


# --- moves between months --------------------------------------------------

def test_a_corrected_date_moves_the_row(spark, tmp_path, few, rows):  # noqa: F811
    batch = arrivals(
        spark,
        dict(cicid=1.0, arrdate=DAY - 40, count=1.0, i94addr="CA", gender="F", i94cit=101.0, i94bir=30.0),  # earlier month
        dict(cicid=3.0, arrdate=DAY, count=5.0, i94addr="NY", i94cit=102.0),  # stays: the stored date is earlier
        dict(cicid=5.0, arrdate=DAY + 70, count=1.0, gender="F", i94bir=50.0),  # from the unknown date
        dict(cicid=8.0, arrdate=DAY + 70, count=1.0), dict(cicid=8.0, arrdate=DAY + 71, count=1.0),
    )
    options = {"monthly": True, "one_row_per_key": True}
    step = lake(spark, tmp_path / "a", few, **options)
    whole = lake(spark, tmp_path / "b", few.union(batch), **options)
    jobs.run(spark, step)
    jobs.run(spark, whole)
    for _ in range(2):
        assert {c.status for c in jobs.refresh_arrivals(batch, step)} == {"passed"}
        assert contents(spark, step, rows) == contents(spark, whole, rows)
    fact = {r.cicid: r.arrdate for r in jobs.read_table(spark, step, "fact_i94_immigration").collect()}
    assert fact[1.0] == dt.date(2016, 2, 21) and fact[3.0] == dt.date(1960, 1, 1) and fact[5.0] == dt.date(2016, 6, 10)
    assert len(fact) == 6


def test_a_month_that_loses_its_last_row_goes(spark, tmp_path):
    rows_ = [dict(cicid=1.0, arrdate=DAY, count=1.0, airline="A"), dict(cicid=2.0, arrdate=DAY + 40, count=1.0)]
    cfg = lake(spark, tmp_path, arrivals(spark, *rows_), monthly=True, one_row_per_key=True)
    jobs.run(spark, cfg)
    jobs.refresh_arrivals(arrivals(spark, dict(cicid=2.0, arrdate=DAY - 1, count=1.0)), cfg)
    parts = versions.table_parts(spark, cfg.output, "fact_i94_immigration", jobs.ARRIVAL_MONTH)
    assert sorted(parts) == ["arrival_year=2016/arrival_month=3", "arrival_year=2016/arrival_month=4"]
    assert {str(r.arrdate) for r in jobs.read_table(spark, cfg, "dim_calendar").collect()} == {"2016-03-31", "2016-04-01"}


def test_the_search_for_stored_keys_reads_the_key_alone(spark, tmp_path, few, plan):  # noqa: F811
    cfg = lake(spark, tmp_path, few, monthly=True, one_row_per_key=True)
    jobs.run_arrivals(spark, cfg)
    parts = versions.table_parts(spark, cfg.output, jobs.CLEAN_ARRIVALS, jobs.ARRIVAL_MONTH)
    columns = [f for f in schemas.ARRIVALS.fields if f.name in model.arrivals_model_columns()]
    stored = versions.read_parts(spark, cfg.output, parts, jobs._with_folders(columns, jobs.ARRIVAL_MONTH))
    near = stored.filter(F.col("cicid").between(1.0, 2.0)).select("cicid", *jobs.ARRIVAL_MONTH)
    assert "ReadSchema: struct<cicid:double>" in plan(near) and "GreaterThanOrEqual(cicid,1.0)" in plan(near)
    keys = spark.createDataFrame([(1.0,), (3.0,), (77.0,)], "cicid double")
    assert jobs._months_of_keys(stored, keys, ("cicid",), jobs.ARRIVAL_MONTH) == [196001, 201604]
    assert jobs._months_of_keys(stored, keys.limit(0), ("cicid",), jobs.ARRIVAL_MONTH) == []


# --- broken lines ----------------------------------------------------------

GOOD = "1743-11-01,6.07,1.74,Here,There,57.05N,10.33E\n"
BAD = {
    "1743-11-01,6.07,1.74,Here,There,57.05N\n": quarantine.FIELD_COUNT,
    "1743-11-01,6.07,1.74,Here,There,57.05N,10.33E,more\n": quarantine.FIELD_COUNT,
    "1743-13-01,6.07,1.74,Here,There,57.05N,10.33E\n": "dt is not date",
    "1743-11-02,warm,1.74,Here,There,57.05N,10.33E\n": "AverageTemperature is not double",
}


def temperatures_file(path, lines):
    path.write_text(",".join(schemas.TEMPERATURES.names) + "\n" + "".join(lines))


def test_broken_lines_are_set_aside(spark, tmp_path):
    temperatures_file(tmp_path / "t.csv", [GOOD, *BAD, "1743-12-01,,,,,,\n"])
    staged = quarantine.stage_csv(spark, str(tmp_path / "t.csv"), schemas.TEMPERATURES, str(tmp_path / "s"), tolerance=0.7)
    assert (staged.good, staged.bad) == (2, 4) and staged.rows.schema == schemas.TEMPERATURES
    assert {str(r.dt) for r in staged.rows.collect()} == {"1743-11-01", "1743-12-01"}
    found = staged.rejected.collect()
    assert {r.line + "\n": r.reason for r in found} == BAD and all(r.file.endswith("/t.csv") for r in found)
    assert readers.csv_malformed(spark, str(tmp_path / "t.csv"), schemas.TEMPERATURES).first().malformed == 4
    with pytest.raises(quarantine.TooManyBadLines, match="4 of 6"):
        quarantine.stage_csv(spark, str(tmp_path / "t.csv"), schemas.TEMPERATURES, str(tmp_path / "s2"), tolerance=0.5)
    temperatures_file(tmp_path / "t.csv", [GOOD])
    staged = quarantine.stage_csv(spark, str(tmp_path / "t.csv"), schemas.TEMPERATURES, str(tmp_path / "s3"))
    assert (staged.rows.count(), staged.rejected.count()) == (1, 0)
    temperatures_file(tmp_path / "t.csv", [])
    staged = quarantine.stage_csv(spark, str(tmp_path / "t.csv"), schemas.TEMPERATURES, str(tmp_path / "s4"))
    assert (staged.rows.count(), staged.rejected.count()) == (0, 0)


def test_a_job_publishes_its_broken_lines(spark, tmp_path, few):  # noqa: F811
    cfg = lake(spark, tmp_path, few, csv_tolerance=0.8)
    temperatures_file(tmp_path / "in" / cfg.temperatures, [GOOD, *BAD])
    assert jobs.run(spark, cfg).manifest == 1
    assert jobs.read_table(spark, cfg, "dim_temperatures").count() == 1
    assert jobs.read_rejected(spark, cfg, "temperatures").count() == 4
    assert jobs.read_rejected(spark, cfg, "demographics").count() == 0
    with pytest.raises(quarantine.TooManyBadLines):
        jobs.run(spark, replace(cfg, csv_tolerance=0.1))
    with pytest.raises(Exception, match="(?i)malformed"):
        jobs.run(spark, replace(cfg, csv_tolerance=None))
    assert versions.read_manifest(spark, cfg.output)[0] == 1


# --- joins and profiles of written tables ----------------------------------

def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, few, plan, rows):  # noqa: F811
    cfg = lake(spark, tmp_path, few, buckets=4)
    jobs.run_arrivals(spark, cfg)
    for key, table in ((None, "dim_immigrant"), (None, "fact_i94_immigration")):
        assert jobs.read_table(spark, cfg, table).schema == schemas.TARGETS[table]
    joined = jobs.join_fact_immigrant(spark, cfg)
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    fact, people = (jobs.read_table(spark, cfg, t) for t in ("fact_i94_immigration", "dim_immigrant"))
    from landfall.plans import star
    want = star.fact_with_immigrant(fact, people)
    assert rows(joined.select(*want.columns)) == rows(want) and want.count() == 5
    # By whole rows ids may repeat: people are reduced inside their buckets.
    loose = replace(cfg, arrivals_rule=cleaning.FULL_ROW, output=str(tmp_path / "loose"))
    few.union(few.withColumn("airline", F.lit("B")).withColumn("gender", F.lit("Z"))).write.mode("overwrite").parquet(
        f"{cfg.inputs}/{cfg.arrivals}")
    jobs.run_arrivals(spark, loose)
    joined = jobs.join_fact_immigrant(spark, loose)
    assert "Exchange" not in plan(joined) and joined.count() == 10


def test_bucketed_tables_need_whole_ids(spark, tmp_path):
    cfg = lake(spark, tmp_path, arrivals(spark, dict(cicid=1.5, arrdate=DAY, count=1.0)), buckets=4)
    with pytest.raises(jobs.CheckFailed, match="whole"):
        jobs.run_arrivals(spark, cfg)
    with pytest.raises(ValueError, match="monthly"):
        replace(cfg, monthly=True)


def files_read(node):
    """Files that the fact's scans of an executed plan have read."""
    if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return files_read(node.executedPlan())
    if node.getClass().getSimpleName().endswith("QueryStageExec"):
        return files_read(node.plan())
    found = 0
    if "arrival_year" in node.toString().split("\n")[0] and node.getClass().getSimpleName() == "FileSourceScanExec":
        found = node.metrics().get("numFiles").get().value()
    children = node.children()
    return found + sum(files_read(children.apply(i)) for i in range(children.size()))


def test_the_calendar_prunes_the_fact_while_the_query_runs(spark, tmp_path, few, plan):  # noqa: F811
    cfg = lake(spark, tmp_path, few, monthly=True)
    jobs.run_arrivals(spark, cfg)
    for _ in range(2):  # after a refresh, the months lie in two runs' folders
        by_month = jobs.fact_in_calendar(spark, cfg, "year = 2016 AND month = 4")
        assert "(arrival_month" in plan(by_month).split("PartitionFilters: [")[1]
        by_day = jobs.fact_in_calendar(spark, cfg, "id BETWEEN 20160401 AND 20160430")
        assert "dynamicpruning" in plan(by_day)
        for found in (by_month, by_day):
            assert {r.cicid for r in found.collect()} == {1.0, 2.0}
        scans = by_day._jdf.queryExecution().executedPlan()
        assert 1 <= files_read(scans) <= 2  # one month of the fact, whose files lie in one folder
        assert jobs.fact_in_calendar(spark, cfg, "year = 1999").count() == 0
        jobs.refresh_arrivals(arrivals(spark, dict(cicid=9.0, arrdate=DAY + 70, count=1.0)), cfg)


def test_profiles_of_months_merge_to_the_profile_of_all_rows(spark, tmp_path, rows):
    def batch(low, high):
        return spark.range(low, high).selectExpr(*[
            f"CAST({e} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schemas.ARRIVALS.fields
            for e in [{"cicid": "id", "arrdate": f"{DAY} + id % 90", "gender": "IF(id % 3 = 0, NULL, string(id % 7))",
                       "i94bir": "IF(id % 5 = 0, double('NaN'), id % 50)", "airline": "concat('A', id)"}.get(f.name, "NULL")]])

    cfg = lake(spark, tmp_path, batch(0, 900), monthly=True, one_row_per_key=True)
    jobs.run_arrivals(spark, cfg)
    jobs.refresh_arrivals(batch(900, 1200).where("arrdate < 20570"), cfg)
    parts = versions.table_parts(spark, cfg.output, jobs.PROFILE, jobs.ARRIVAL_MONTH)
    assert len(set(parts.values())) == 2  # months that the batch does not touch keep their summaries
    folders = jobs._with_folders(schemas.ARRIVALS.fields[:0], jobs.ARRIVAL_MONTH)
    cleaned = versions.table_parts(spark, cfg.output, jobs.CLEAN_ARRIVALS, jobs.ARRIVAL_MONTH)
    columns = [f for f in schemas.ARRIVALS.fields if f.name in model.arrivals_model_columns()]
    whole = versions.read_parts(spark, cfg.output, cleaned, jobs._with_folders(columns, jobs.ARRIVAL_MONTH))
    from landfall.plans import profile
    assert rows(jobs.read_profile(spark, cfg)) == rows(profile.merged(profile.summaries(whole.drop(*folders.names))))
    found = {r.column_name: r for r in jobs.read_profile(spark, cfg).collect()}
    n = whole.count()
    assert found["cicid"].rows == n and abs(found["airline"].distinct - n) < 0.05 * n and found["gender"].distinct == 7
    assert (found["i94bir"].least_number, found["i94bir"].greatest_number) == (1.0, 49.0)
    assert found["gender"].ratio_to_total == round(whole.where("gender IS NULL").count() / n, 3)
    assert (found["gender"].least_text, found["occup" if "occup" in found else "visapost"].null_count) == ("0", n)


# --- contracts of single files ---------------------------------------------

def test_files_that_break_the_contract_are_named(spark, tmp_path):
    path = str(tmp_path / "files")
    whole = spark.range(6).selectExpr("id", "string(id) AS s", "double(id) AS x", "date'2020-01-01' AS d",
                                      "timestamp'2020-01-01 00:00:00' AS t", "CAST(id AS DECIMAL(12,2)) AS m")
    whole.repartition(2).write.parquet(f"{path}/a=1")
    whole.drop("x").withColumn("s", F.lit(1)).coalesce(1).write.parquet(f"{path}/a=2")
    assert contracts.contract_problems(spark, f"{path}/a=1", whole.schema).count() == 0
    found = contracts.contract_problems(spark, path, whole.schema).collect()
    assert {(r.file.split("/")[-2], r.column, r.problem) for r in found} == {
        ("a=2", "x", "absent"), ("a=2", "s", "is int, not string")}
    columns = contracts.file_columns(spark, path)
    assert columns.select("file").distinct().count() == 3 and columns.count() == 2 * 6 + 5
    # The listing alone does not open the files.
    assert "content" not in columns._jdf.queryExecution().executedPlan().toString()
