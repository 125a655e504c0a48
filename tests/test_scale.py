"""What keeps the shared steps' shuffles in proportion to the rows that need them."""

import time
from dataclasses import replace

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.operators import cleaning
from landfall.plans import jobs, quality
from landfall.session import free_disk
from landfall.sources import writers
from suite.inputs import View

SHAPE = View("t", "day", {"id": "id", "kind": "CASE WHEN id % 5 = 0 THEN NULL ELSE 'a' END", "n": "id * 2"},
             (("id % 2 = 0", {}), ("id % 3 = 0", {"kind": "'b'"}), ("id = NULL", {"n": "0"})))


def test_a_view_reads_its_table_once(spark, tmp_path, plan, rows):
    spark.range(20).toDF("id").write.parquet(str(tmp_path / "t.parquet"))
    got = SHAPE.frame(spark, str(tmp_path))
    assert plan(got).count("FileScan") == 1 and "Exchange" not in plan(got)
    base = [(i, None if i % 5 == 0 else "a", i * 2) for i in range(20)]
    copies = [r for r in base if r[0] % 2 == 0] + [(r[0], "b", r[2]) for r in base if r[0] % 3 == 0]
    assert rows(got) == sorted(base + copies, key=repr)


def test_a_view_lists_copies_without_a_lambda(spark, tmp_path, plan):
    # Lambdas are interpreted row by row; all other expressions are compiled.
    spark.range(4).toDF("id").write.parquet(str(tmp_path / "t.parquet"))
    assert "lambda" not in plan(SHAPE.frame(spark, str(tmp_path)))


def test_quality_report_shuffles_hashes_only(spark, plan):
    df = spark.createDataFrame(
        [(1, None, 0.0), (1, None, -0.0), (None, 1, 2.0), (None, None, float("nan")), (None, None, float("nan"))],
        "a long, b long, c double")
    report = quality.quality_report(df, "t")
    assert report.first()[:3] == ("t", 5, 2)
    assert all(line.split("hashpartitioning(")[1].startswith("hash_1") for line in plan(report).splitlines()
               if "hashpartitioning(" in line)


def test_fingerprint_is_the_exact_sum_of_the_hashes(spark, plan):
    df = spark.range(5_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("t"))
    columns = [F.col("id"), F.col("t"), F.col("id").isNull(), F.col("t").isNull()]
    found = df.select(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b")).collect()
    content = quality.content(df)
    assert tuple(map(int, content.first())) == (5_000, sum(r.a for r in found), sum(r.b for r in found))
    assert tuple(map(int, quality.content(df.limit(0)).first())) == (0, 0, 0)
    assert "sum(cast(xxhash64" not in plan(content)


def test_many_suspects_are_compared_without_a_join(spark, monkeypatch):
    monkeypatch.setattr(quality, "BROADCAST_LIMIT", 0)
    monkeypatch.setattr(DataFrame, "join", lambda *_: pytest.fail("rows are shuffled twice"))
    df = spark.range(20).selectExpr("id % 15 AS id", "NULL AS t")
    assert quality.check_table(df, "t")[:4] == ("t", 20, 5, "failed")


ARRIVED = [(float(c), float(d), "CA") for c, d in ((1, 12000), (2, 12000), (2, 12000), (3, 12040), (4, 12000))]


def _arrivals(spark, rows):
    df = spark.createDataFrame(rows, "cicid double, arrdate double, i94addr string")
    return df.select([F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                      for f in jobs.schemas.ARRIVALS.fields])


def test_monthly_tables_are_written_where_their_rows_are_read(spark, tmp_path, monkeypatch, rows):
    cfg = jobs.LakeConfig(f"{tmp_path}/out", f"{tmp_path}/staging", f"{tmp_path}/in", monthly=True)
    _arrivals(spark, ARRIVED[:2]).write.parquet(f"{tmp_path}/in/{cfg.arrivals}")
    seen, write = [], writers._partition_writer

    def spy(df, columns, measures=None, sorted_by=(), grouped=False):
        seen.append((tuple(columns), grouped, "rebalance" in df._jdf.queryExecution().analyzed().toString().lower()))
        return write(df, columns, measures, sorted_by, grouped)

    monkeypatch.setattr(writers, "_partition_writer", spy)
    jobs.run_arrivals(spark, cfg)
    assert sum(grouped for columns, grouped, _ in seen if columns == jobs.ARRIVAL_MONTH) == 2
    assert not any(hinted for _, _, hinted in seen)
    jobs.refresh_arrivals(_arrivals(spark, ARRIVED[1:]), cfg)
    fact = jobs.read_table(spark, cfg, "fact_i94_immigration").select("cicid", F.col("arrdate").cast("string"))
    assert rows(fact) == [(1.0, "1992-11-08"), (2.0, "1992-11-08"), (3.0, "1992-12-18"), (4.0, "1992-11-08")]


def test_a_batch_whose_months_are_merged_is_not_cleaned_twice(spark, plan):
    raw = _arrivals(spark, ARRIVED + [(None, 12000.0, "CA")])
    kept = jobs.clean_arrivals(raw, cleaning.ARRIVALS_BY_ID, True, repeats=True)
    assert "Window" not in plan(kept) and kept.count() == 5
    assert jobs.clean_arrivals(raw, replace(cleaning.ARRIVALS_BY_ID), True).count() == 4


def test_bucketed_tables_are_written_where_their_rows_are_read(spark, tmp_path, monkeypatch, plan, rows):
    cfg = jobs.LakeConfig(f"{tmp_path}/out", f"{tmp_path}/staging", f"{tmp_path}/in", buckets=3)
    raw = [(None, 12000.0, "CA"), (-0.0, 12001.0, "NV"), (0.0, 12000.0, "CA"), (float("nan"), 12000.0, "CA")]
    raw += [(float(c % 40), 12000.0 + c, "CA") for c in range(60)]
    _arrivals(spark, raw).repartition(4).write.parquet(f"{tmp_path}/in/{cfg.arrivals}")
    want = jobs.clean_arrivals(_arrivals(spark, raw), cleaning.ARRIVALS_BY_ID).selectExpr(
        "cicid + 0.0 AS cicid", "CAST(date_add(DATE '1960-01-01', CAST(arrdate AS INT)) AS STRING) AS arrdate")
    # Several files a bucket: adaptive execution would leave one task.
    monkeypatch.setattr(DataFrame, "repartition", lambda *_: pytest.fail("cleaned rows are shuffled again"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.files.openCostInBytes", "64m")
    try:
        report = jobs.run(spark, cfg, ("arrivals",))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert report.flows[0][1:] == (64, 2, 22, 40) and report.manifest == 1
    joined = jobs.join_fact_immigrant(spark, cfg)
    assert "Exchange" not in plan(joined)
    files = [f.rsplit("_", 1)[1] for f in jobs.read_table(spark, cfg, "dim_immigrant").inputFiles()]
    assert len(files) > len({f.split(".")[0] for f in files}) == 3
    assert rows(joined.selectExpr("cicid + 0.0 AS cicid", "CAST(arrdate AS STRING) AS arrdate")) == rows(want)
    # Ids that are not whole still fail the job, though they share a missing key.
    _arrivals(spark, [(1.5, 12000.0, "CA"), (2.5, 12000.0, "CA"), (3.0, 12000.0, "CA")]).write.parquet(f"{tmp_path}/in/odd")
    with pytest.raises(jobs.CheckFailed, match="whole"):
        jobs.run(spark, replace(cfg, arrivals="odd"), ("arrivals",))


def test_a_scan_tasks_arrivals_are_sorted_in_parts(spark, tmp_path, monkeypatch, plan, rows):
    # Half of the tasks' rows in a sort each; NULL, NaN and both zeros are keys like others.
    cfg = jobs.LakeConfig(f"{tmp_path}/out", f"{tmp_path}/staging", f"{tmp_path}/in")
    raw = [(c, 12000.0, "CA") for c in (None, float("nan"), float("nan"), -0.0)]
    raw += [(0.0, 11999.0, "NV")] + [(float(c % 40), 12000.0 + c, "CA") for c in range(60)]
    source = f"{tmp_path}/in/{cfg.arrivals}"
    _arrivals(spark, raw).coalesce(1).write.parquet(source)
    seen, clean = [], jobs.clean_arrivals
    monkeypatch.setattr(jobs, "clean_arrivals", lambda df, *rest, **named: seen.append(df) or clean(df, *rest, **named))
    report = jobs.run(spark, cfg, ("arrivals",))
    assert report.flows[0][1:] == (65, 3, 22, 40) and report.manifest == 1
    (dealt,) = seen
    assert plan(dealt).count("FileScan") == 2 and "Exchange" not in plan(dealt)
    assert rows(dealt) == rows(spark.read.parquet(source))
    tasks = dealt.select((F.col("cicid") + 0.0).alias("id"), F.spark_partition_id().alias("task")).distinct()
    assert tasks.select("task").distinct().count() == 2 and tasks.groupBy("id").count().where("count > 1").count() == 0
    fact = jobs.read_table(spark, cfg, "fact_i94_immigration").selectExpr("cicid + 0.0", "CAST(arrdate AS STRING)")
    want = clean(_arrivals(spark, raw), cleaning.ARRIVALS_BY_ID).selectExpr(
        "cicid + 0.0", "CAST(date_add(DATE '1960-01-01', CAST(arrdate AS INT)) AS STRING)")
    assert rows(fact) == rows(want)


# Rows that differ in one column, or in NULL against NaN or empty text; both zeros are equal.
WHOLE = [(1.0, 12000.0, "CA")] * 3 + [(1.0, 12000.0, "NV"), (1.0, None, "CA"), (1.0, float("nan"), "CA"), (0.0, 12000.0, None),
         (0.0, 12000.0, ""), (-0.0, 12000.0, "")] + [(None, None, "CA"), (float("nan"), None, "CA")] * 2 + [(None, None, None)]


def test_whole_rows_meet_by_their_record_without_a_table_in_the_scan_task(spark, tmp_path, plan, rows):
    _arrivals(spark, WHOLE + [(float(c % 40), 12000.0, "CA") for c in range(2, 60)]).repartition(4).write.parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    flow = cleaning.RowFlow("arrivals")
    got = jobs.clean_whole_arrivals(raw, cleaning.FULL_ROW, flow=flow)
    scanned = [part.split("FileScan")[0] for part in plan(got).split("Exchange hashpartitioning(")[1:]]
    assert len(scanned) == jobs.WHOLE_ROW_PARTS and not any("Aggregate" in s for s in scanned)
    want = rows(cleaning.FULL_ROW(raw))
    assert len(want) == 47 and rows(got) == want
    assert flow.counts()[1:] == (72, 1, 24, 47)
    dropped = replace(cleaning.FULL_ROW, drop_cols=("i94addr", *jobs.RECORD))
    assert rows(jobs.clean_whole_arrivals(raw, dropped)) == rows(dropped(raw)) == []


def test_whole_rows_stage_the_models_columns_only(spark, tmp_path, monkeypatch):
    cfg = jobs.LakeConfig(f"{tmp_path}/out", f"{tmp_path}/staging", f"{tmp_path}/in", arrivals_rule=cleaning.FULL_ROW)
    _arrivals(spark, ARRIVED).withColumn("insnum", F.col("cicid").cast("string")).write.parquet(f"{tmp_path}/in/{cfg.arrivals}")
    staged, write = [], writers.write_measured
    monkeypatch.setattr(writers, "write_measured", lambda df, path, *rest, **named: (
        staged.append(df.columns) if path.startswith(cfg.staging) else None) or write(df, path, *rest, **named))
    report = jobs.run(spark, cfg, ("arrivals",))
    assert staged == [jobs.model.arrivals_model_columns()] and report.manifest == 1
    assert report.flows[0][1:] == (5, 0, 1, 4)


def test_a_check_shuffles_one_hash_a_row(spark, monkeypatch, plan):
    seen, count = [], quality.duplicate_count
    monkeypatch.setattr(quality, "duplicate_count", lambda df: seen.append(plan(df)) or count(df))
    df = spark.createDataFrame([(1, None), (1, None), (None, 1), (None, 1), (None, None)], "a long, b long")
    assert quality.check_table(df, "t")[:4] == ("t", 5, 2, "failed")
    assert seen[0].count("hashpartitioning(") == 1 and "hash(a" not in seen[0].replace("xxhash64(a", "")


def _shuffle_files(spark):
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (kept.apply(i).getName() for i in range(kept.size())) if n.startswith("shuffle_")}


def test_a_finished_querys_shuffle_files_go_when_asked(spark):
    before = _shuffle_files(spark)
    spark.range(100).repartition(3).write.format("noop").mode("overwrite").save()
    new = _shuffle_files(spark) - before
    free_disk(spark)
    until = time.time() + 30
    while new & _shuffle_files(spark) and time.time() < until:
        time.sleep(0.2)
    assert new and not new & _shuffle_files(spark)


def test_cleanings_shuffle_is_freed_before_the_tables_are_written(spark, tmp_path, monkeypatch):
    cfg = jobs.LakeConfig(f"{tmp_path}/out", f"{tmp_path}/staging", f"{tmp_path}/in")
    _arrivals(spark, ARRIVED).write.parquet(f"{tmp_path}/in/{cfg.arrivals}")
    steps, write = [], writers.write_measured
    monkeypatch.setattr(jobs, "free_disk", lambda _: steps.append("freed"))
    monkeypatch.setattr(writers, "write_measured", lambda df, path, *rest, **named: (
        steps.append("staged" if path.startswith(cfg.staging) else "table"), write(df, path, *rest, **named))[1])
    jobs.run(spark, cfg, ("arrivals",))
    assert steps == ["staged", "freed", "table", "table", "table", "freed"]
