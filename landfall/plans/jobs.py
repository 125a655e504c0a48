"""The batch jobs: read, clean, build, write, check what was written, then publish it.

A run writes new folders. Its tables become the lake's all at once, by one manifest, and only if every
check has passed; see ``landfall.sources.versions``.
"""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import schemas
from landfall.functions.dates import day_number_to_date
from landfall.functions.missing import is_present
from landfall.operators import cleaning
from landfall.operators.joins import sized_semi_join
from landfall.plans import model, profile, quality, star
from landfall.session import free_disk
from landfall.sources import bucketed, quarantine, readers, versions, writers
from landfall.sources.paths import join_path

CALENDAR_PARTITIONS = ("year", "month")
#: Folders of the monthly layout; 0 and 0 stand for an unknown date. They are no columns of a target.
ARRIVAL_MONTH = ("arrival_year", "arrival_month")
READING_MONTH = ("reading_year", "reading_month")
CLEAN_ARRIVALS = "arrivals_clean"
REJECTED = "rejected_"
#: Summaries of the cleaned arrivals' columns by month.
PROFILE = "arrivals_profile"
#: The integral form of ``cicid`` by which two tables are bucketed; no column of a target.
BUCKET_KEY = "cicid_key"
BUCKETED = ("dim_immigrant", "fact_i94_immigration")
#: Tasks that share a scan task's rows. A row group of 128 MB holds some 1.1 GB of arrivals to sort, with the
#: sort's own arrays 1.4 GB: more than one of four tasks of a 6 GB heap has.
SORT_PARTS = 2
#: Columns that tell most arrivals apart, and shares in which whole rows are compared: a shuffled partition
#: of 128 MB holds some 0.6 GB of whole rows in a hash table, and Spark plans two such tables in a task.
RECORD = ("cicid", "admnum", "arrdate", "fltno")
WHOLE_ROW_PARTS = 3


@dataclass(frozen=True)
class LakeConfig:
    """Locations may be local folders or object-store prefixes.

    ``staging`` holds the cleaned arrivals between the three writes that read them;
    it must be a folder that all executors can reach.

    ``monthly`` splits the arrivals' tables by month of arrival and the temperatures by month, and
    keeps the cleaned arrivals beside them, so that ``refresh_arrivals`` and ``refresh_temperatures``
    can replace single months. The row key of arrivals then counts within its month: a cicid that
    comes again in another month is another arrival. With ``one_row_per_key`` it counts across months:
    a refresh looks up the stored months of its keys and takes these months in, so a corrected date
    moves a row.

    ``csv_tolerance`` is the share of broken lines that a CSV source may have: they go to a side table
    (``read_rejected``). Without it the first broken line fails the job.

    ``buckets`` stores fact and immigrants bucketed and sorted by their id, so that
    ``join_fact_immigrant`` needs no shuffle. It is for lakes that are not monthly.
    """

    output: str
    staging: str
    inputs: str = ""
    # The usual names of the source files.
    arrivals: str = "sas_data"
    temperatures: str = "GlobalLandTemperaturesByCity.csv"
    demographics: str = "us-cities-demographics.csv"
    arrivals_rule: cleaning.CleanRule = field(default=cleaning.ARRIVALS_BY_ID)
    temperatures_rule: cleaning.CleanRule = field(default=cleaning.TEMPERATURES_BY_CITY_DATE)
    demographics_rule: cleaning.CleanRule = field(default=cleaning.FULL_ROW)
    monthly: bool = False
    one_row_per_key: bool = False
    csv_tolerance: float | None = None
    buckets: int | None = None

    def __post_init__(self):
        if self.buckets and self.monthly:
            raise ValueError("a monthly lake is split by folders, not bucketed")


class CheckFailed(RuntimeError):
    """A written table does not hold what was sent to it, or breaks its contract."""


class RunReport(NamedTuple):
    """Checks of the tables, where each dataset's rows went, and the manifest (None: not published)."""

    checks: list
    flows: list
    manifest: int | None


class _Written(NamedTuple):
    """What a job hands to the publication: {table: parts}, its checks, its flow."""

    tables: dict
    checks: list
    flows: list


def _folders_of(table, cfg):
    if table == "dim_calendar":
        return CALENDAR_PARTITIONS
    if not cfg.monthly or table == "dim_usa_demographics":
        return ()
    return READING_MONTH if table == "dim_temperatures" else ARRIVAL_MONTH


def read_table(spark, cfg, table):
    """A published table with its columns in contract order."""
    contract = schemas.TARGETS[table]
    rows = _stored(spark, cfg, table, contract.fields, _folders_of(table, cfg))
    return rows.select(*contract.names)


def _with_folders(columns, partitions):
    fields = [f for f in columns if f.name not in partitions]
    return T.StructType(fields + [T.StructField(p, T.IntegerType()) for p in partitions])


def _stored(spark, cfg, table, columns, partitions):
    """A published table with its folder columns; ``columns`` are its fields. No rows if there is none."""
    parts = versions.table_parts(spark, cfg.output, table, partitions)
    return versions.read_parts(spark, cfg.output, parts, _with_folders(columns, partitions))


def read_months(spark, cfg, table):
    """A published table that is split by month: a frame for each run that wrote some of its months."""
    folders = _folders_of(table, cfg)
    parts = versions.table_parts(spark, cfg.output, table, folders)
    return versions.part_frames(spark, cfg.output, parts, _with_folders(schemas.TARGETS[table].fields, folders))


def fact_in_calendar(spark, cfg, condition):
    """Fact rows of a monthly lake on the days that meet a condition on the calendar's columns."""
    _needs_months(cfg)
    table = "fact_i94_immigration"
    return star.fact_in_calendar(
        read_months(spark, cfg, table), read_table(spark, cfg, "dim_calendar"), condition, _folders_of(table, cfg))


def join_fact_immigrant(spark, cfg):
    """Every fact row that has a cicid with its person, from the bucketed tables: no shuffle.

    With one row per cicid, which the job has checked, people are joined as they are stored.
    """
    sides = []
    for table in BUCKETED:
        (folder,) = versions.table_parts(spark, cfg.output, table).values()
        schema = _with_key(schemas.TARGETS[table])
        rows = bucketed.read_bucketed(spark, join_path(cfg.output, folder), schema, BUCKET_KEY, cfg.buckets)
        sides.append(rows.where(F.col(BUCKET_KEY).isNotNull()))
    people, fact = sides
    people = people.drop("cicid")
    if cfg.arrivals_rule.keys != ("cicid",):
        people = cleaning.drop_duplicate_rows(people, [BUCKET_KEY])
    return fact.join(people.hint("merge"), BUCKET_KEY).drop(BUCKET_KEY)


def _with_key(schema):
    return T.StructType([*schema.fields, T.StructField(BUCKET_KEY, T.LongType())])


def _write(df, cfg, run, table, partitions=(), measures=None, sorted_by=(), grouped=False):
    """Write a new version of a table: (parts, rows as they are read back, what was measured).

    ``grouped`` rows are read from a table of the same partitions, or that lies by the bucket key.
    """
    spark, folder = df.sparkSession, f"{table}/{run}"
    path = join_path(cfg.output, folder)
    if cfg.buckets and table in BUCKETED:
        # The key must be exact: an id with a fraction has none, and would be lost to the join.
        exact = F.count_if(F.col(BUCKET_KEY).isNull() & is_present(df, "cicid"))
        df = df.withColumn(BUCKET_KEY, bucketed.integral(F.col("cicid")))
        measured = bucketed.write_bucketed(
            df, path, BUCKET_KEY, cfg.buckets, (measures or {}) | {"inexact": exact}, grouped)
        if measured.pop("inexact"):
            raise CheckFailed(f"{table}: cicid holds numbers that are not whole")
    else:
        measured = writers.write_measured(df, path, measures, partitions, sorted_by, grouped)
    parts = versions.written_parts(spark, cfg.output, folder, partitions)
    stored = versions.read_parts(spark, cfg.output, parts, _with_folders(df.schema.fields, partitions))
    return parts, stored, measured


def _write_and_check(df, cfg, run, table, partitions=(), keys=None, grouped=False):
    """(parts, check) of a new version of a target table.

    What is read back must equal, row for row, what went into the files. ``keys`` are tried first
    as a proof that no row repeats; they need not be unique.
    """
    contract = schemas.TARGETS[table]
    folders = [c for c in partitions if c not in contract.names]
    problems = quality.schema_problems(df.drop(*folders), contract)
    if problems:
        raise CheckFailed(f"{table}: {'; '.join(problems)}")
    parts, stored, measured = _write(
        df, cfg, run, table, partitions, quality.fingerprint(df.select(*contract.names)), grouped=grouped)
    stored = stored.select(*contract.names)
    back = quality.content(stored).first().asDict()
    if back != measured:
        raise CheckFailed(f"{table}: {measured} written, {back} read back")
    return parts, quality.check_table(stored, table, keys)


def clean_arrivals(raw, rule, monthly=False, flow=None, one_row_per_key=False, repeats=False):
    """Cleaned arrivals. With a row key, columns that no target reads are never scanned.

    ``monthly`` adds the month of arrival and makes it part of the row key, unless ``one_row_per_key``.
    ``repeats`` keeps rows that repeat, for a caller that removes them later.
    """
    if rule.keys:
        wanted = set(model.arrivals_model_columns()) | set(rule.keys) | set(rule.required or ())
        raw = raw.select([c for c in raw.columns if c in wanted])
    if monthly:
        raw = _with_month(raw, day_number_to_date(F.col("arrdate")), ARRIVAL_MONTH)
        rule = _monthly_rule(rule, one_row_per_key)
    if repeats:
        return cleaning.drop_empty_rows(raw.drop(*rule.drop_cols), list(rule.required) if rule.required else None)
    return rule(raw, flow) if flow else rule(raw)


def clean_whole_arrivals(raw, rule, monthly=False, flow=None):
    """The rows of ``clean_arrivals`` for a rule without a row key, if the source lies in files.

    Equal rows agree in their record's columns, so shares by these are cleaned each by itself.
    """
    together = tuple(c for c in RECORD if c in raw.columns and c not in rule.drop_cols)
    if not together:
        return clean_arrivals(raw, rule, monthly, flow)
    rule = replace(rule, together=together)
    return reduce(DataFrame.union, [
        clean_arrivals(share, rule, monthly, flow) for share in _shares(raw, together, WHOLE_ROW_PARTS)])


def _monthly_rule(rule, one_row_per_key=False):
    """The rule for rows that carry their month, which is never missing."""
    keys = rule.keys if one_row_per_key else (*rule.keys, *ARRIVAL_MONTH) if rule.keys else None
    required = rule.required or tuple(c for c in schemas.ARRIVALS.names if c not in rule.drop_cols)
    # The month follows from the date, so it must not order rows before the other columns do.
    return replace(rule, keys=keys, required=required, first_by=(*rule.first_by, *_others(rule)))


def _others(rule):
    return tuple(c for c in schemas.ARRIVALS.names if c not in rule.drop_cols and c not in rule.first_by)


def _with_month(df, date, columns):
    year, month = columns
    return df.withColumns({
        year: F.coalesce(F.year(date), F.lit(0)), month: F.coalesce(F.month(date), F.lit(0)),
    })


def _months(df, columns):
    """The months of ``df`` as year * 100 + month: at most twelve for each of 9999 years."""
    year, month = columns
    number = (F.col(year) * 100 + F.col(month)).alias("number")
    return sorted(r.number for r in df.select(number).distinct().collect())


def _in_months(stored, months, columns):
    """A filter on the folders alone, so that files of other months are not read."""
    year, month = columns
    return stored.filter((F.col(year) * 100 + F.col(month)).isin(months))


def _side_by_side(spark, *steps):
    """Run independent Spark actions at once, so that short ones fill idle executors."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [r.result() for r in [pool.submit(inheritable_thread_target(spark)(s)) for s in steps]]


def _flow_of(dataset, rule):
    return cleaning.RowFlow(dataset) if isinstance(rule, cleaning.CleanRule) else None


def _flows(flow, raw, rule, rows):
    """The flow of a job that wrote ``rows``, as a list.

    Counts are taken along the plan. If an executor was lost and part of the plan ran twice, they
    may not add up; then the rows are counted anew.
    """
    counts = flow and flow.counts()
    if not counts:
        return []
    if counts.rows_kept != rows or counts.rows_read != counts.rows_emptied + counts.rows_repeated + rows:
        raw = raw.drop(*rule.drop_cols)
        present = cleaning.drop_empty_rows(raw, list(rule.required) if rule.required else None)
        read, left = raw.count(), present.count()
        counts = cleaning.FlowCount(flow.dataset, read, read - left, left - rows, rows)
    return [counts]


def _emptied(df, columns):
    """Sparse columns without their values: tables keep their contracts."""
    return df.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in columns})


def _lies_by_bucket_key(cfg):
    """Whether cleaning leaves the arrivals by the hash of their bucket key: all have a cicid, one row each."""
    rule = cfg.arrivals_rule
    return bool(cfg.buckets) and isinstance(rule, cleaning.CleanRule) and rule.keys == rule.required == ("cicid",)


def _clean_by_bucket_key(raw, rule, flow):
    """The same rows, with cleaning's shuffle by the key of the buckets, so that writing these needs none.

    Ids that are not whole share a missing key. One of them is left then, and fails the write.
    """
    raw = raw.withColumn(BUCKET_KEY, bucketed.integral(F.col("cicid")))
    rule = replace(rule, keys=(BUCKET_KEY,), first_by=tuple(c for c in rule.first_by if c != "cicid"))
    return clean_arrivals(raw, rule, flow=flow).drop(BUCKET_KEY)


def _in_parts(df, keys, parts=SORT_PARTS):
    """The same rows in ``parts`` times as many tasks, so that each sorts fewer and need not spill.

    Every task reads its files' rows and goes on with its share of the keys: a key's rows stay together, and
    nothing is shuffled. Only for rows that lie in files, which read the same every time and cheaply.
    """
    return reduce(DataFrame.union, _shares(df, keys, parts))


def _shares(df, keys, parts):
    share = F.pmod(F.hash(*keys), F.lit(parts))
    return [df.filter(share == i) for i in range(parts)]


def _arrivals(spark, cfg, run):
    raw = readers.read_arrivals(spark, join_path(cfg.inputs, cfg.arrivals))
    rule = cfg.arrivals_rule
    flow = _flow_of("arrivals", rule)
    dealt = _in_parts(raw, rule.keys) if getattr(rule, "keys", None) else raw
    if _lies_by_bucket_key(cfg):
        cleaned = _clean_by_bucket_key(dealt, rule, flow)
    elif isinstance(rule, cleaning.CleanRule) and not rule.keys:
        cleaned = clean_whole_arrivals(raw, rule, cfg.monthly, flow)
    else:
        cleaned = clean_arrivals(dealt, rule, cfg.monthly, flow, cfg.one_row_per_key)
    if not cfg.monthly:
        wanted = set(model.arrivals_model_columns())
        cleaned = cleaned.select([c for c in cleaned.columns if c in wanted])
    thresh = getattr(rule, "thresh", None)
    measures = cleaning.missing_counts(cleaned) if thresh is not None else None
    tables, staged, columns = {}, None, cleaned.columns
    if cfg.monthly:
        tables[CLEAN_ARRIVALS], cleaned, measured = _write(
            cleaned, cfg, run, CLEAN_ARRIVALS, ARRIVAL_MONTH, measures, rule.keys or ())
        tables[PROFILE] = _write_profile(cleaned, cfg, run)
    else:
        staged, schema = join_path(cfg.staging, f"arrivals-{run}"), cleaned.schema
        measured = writers.write_measured(cleaned, staged, measures)
        cleaned = spark.read.schema(schema).parquet(staged)
    free_disk(spark)
    flows = _flows(flow, raw, rule, measured["rows"])
    if thresh is not None:
        sparse = cleaning.sparse_columns(columns, measured, thresh)
        cleaned = _emptied(cleaned, [c for c in sparse if c not in ARRIVAL_MONTH])
    checked = _arrivals_tables(spark, cfg, run, cleaned)
    if staged:
        writers.remove_staged(spark, staged)
    free_disk(spark)
    return _Written(tables | {t: parts for t, (parts, _) in checked.items()}, [c for _, c in checked.values()], flows)


def _write_profile(cleaned, cfg, run):
    """Summaries of the months in ``cleaned``, as parts of the profile table."""
    found = profile.summaries(cleaned, ARRIVAL_MONTH)
    return _write(found.select(*profile.SUMMARY.names, *ARRIVAL_MONTH), cfg, run, PROFILE, ARRIVAL_MONTH)[0]


def read_profile(spark, cfg):
    """Profile of all cleaned arrivals of a monthly lake, merged from its months' summaries."""
    _needs_months(cfg)
    return profile.merged(_stored(spark, cfg, PROFILE, profile.SUMMARY.fields, ARRIVAL_MONTH).drop(*ARRIVAL_MONTH))


def _arrivals_tables(spark, cfg, run, cleaned):
    """{table: (parts, check)} of the three tables that are built from cleaned arrivals."""
    keys, folders = cfg.arrivals_rule.keys, ARRIVAL_MONTH if cfg.monthly else ()
    frames = {
        "dim_calendar": (model.dim_calendar(cleaned), CALENDAR_PARTITIONS, ["arrdate"]),
        "dim_immigrant": (model.dim_immigrant(cleaned, folders), folders, keys),
        "fact_i94_immigration": (model.fact_arrivals(cleaned, folders), folders, keys),
    }
    # Cleaned arrivals that are read month by month, or by the bucket key, stay where they are.
    done = _side_by_side(spark, *[
        lambda table=table, df=df, parts=parts, by=by: _write_and_check(
            df, cfg, run, table, parts, by, parts == ARRIVAL_MONTH or _lies_by_bucket_key(cfg))
        for table, (df, parts, by) in frames.items()])
    return dict(zip(frames, done))


def _one_table(cfg, run, dataset, table, raw, rule, build, folders, keys):
    flow = _flow_of(dataset, rule)
    cleaned = rule(raw, flow) if flow else rule(raw)
    thresh = getattr(rule, "thresh", None)
    if thresh is not None:
        staged = join_path(cfg.staging, f"{dataset}-{run}")
        schema = cleaned.schema
        measured = writers.write_measured(cleaned, staged, cleaning.missing_counts(cleaned))
        cleaned = raw.sparkSession.read.schema(schema).parquet(staged)
        cleaned = _emptied(cleaned, cleaning.sparse_columns(schema.names, measured, thresh))
    parts, check = _write_and_check(build(cleaned), cfg, run, table, folders, keys)
    if thresh is not None:
        writers.remove_staged(raw.sparkSession, staged)
    return _Written({table: parts}, [check], _flows(flow, raw, rule, check.total_rows))


def _from_csv(spark, cfg, run, dataset, read, schema, sep, job):
    """``job`` (a function of the raw rows) over a CSV source, whose broken lines go to a side table."""
    path = join_path(cfg.inputs, getattr(cfg, dataset))
    if cfg.csv_tolerance is None:
        return job(read(spark, path))
    staged = join_path(cfg.staging, f"{dataset}-lines-{run}")
    lines = quarantine.stage_csv(spark, path, schema, staged, sep, cfg.csv_tolerance)
    parts, _, _ = _write(lines.rejected, cfg, run, f"{REJECTED}{dataset}")
    done = job(lines.rows)
    writers.remove_staged(spark, staged)
    return done._replace(tables=done.tables | {f"{REJECTED}{dataset}": parts})


def read_rejected(spark, cfg, dataset):
    """The broken lines of ``demographics`` or ``temperatures`` in the published run: file, line, reason."""
    return _stored(spark, cfg, f"{REJECTED}{dataset}", quarantine.REJECTED.fields, ())


def _demographics(spark, cfg, run):
    return _from_csv(spark, cfg, run, "demographics", readers.read_demographics, schemas.DEMOGRAPHICS, ";",
                     lambda raw: _one_table(cfg, run, "demographics", "dim_usa_demographics", raw,
                                            cfg.demographics_rule, model.dim_demographics, (), ["id"]))


def _temperatures(spark, cfg, run):
    return _from_csv(spark, cfg, run, "temperatures", readers.read_temperatures, schemas.TEMPERATURES, ",",
                     lambda raw: _one_table(cfg, run, "temperatures", "dim_temperatures", raw, cfg.temperatures_rule,
                                            lambda cleaned: _temperatures_table(cleaned, cfg),
                                            _folders_of("dim_temperatures", cfg), _temperature_keys(cfg)))


def _temperatures_table(cleaned, cfg):
    table = model.dim_temperatures(cleaned)
    return _with_month(table, F.col("dt"), READING_MONTH) if cfg.monthly else table


def _temperature_keys(cfg):
    return [model.TEMPERATURES_NAMES[k] for k in cfg.temperatures_rule.keys or ()]


JOBS = {"arrivals": _arrivals, "demographics": _demographics, "temperatures": _temperatures}


def run(spark, cfg, datasets=tuple(JOBS)):
    """Run the jobs of ``datasets`` side by side and publish all their tables at once.

    If a check fails, or a job does, nothing is published: readers keep the tables they had.
    """
    name = versions.new_run()
    done = _side_by_side(spark, *[lambda job=JOBS[d]: job(spark, cfg, name) for d in datasets])
    checks = [c for d in done for c in d.checks]
    tables = {t: parts for d in done for t, parts in d.tables.items()}
    return RunReport(checks, [f for d in done for f in d.flows], _publish(spark, cfg, tables, checks))


def _publish(spark, cfg, tables, checks, seen=None):
    if any(c.status != "passed" for c in checks):
        return None
    return versions.publish(spark, cfg.output, tables, seen)


def run_arrivals(spark, cfg):
    return run(spark, cfg, ("arrivals",)).checks


def run_demographics(spark, cfg):
    return run(spark, cfg, ("demographics",)).checks


def run_temperatures(spark, cfg):
    return run(spark, cfg, ("temperatures",)).checks


def run_all(spark, cfg):
    """The three jobs share no table, so they run side by side."""
    return run(spark, cfg).checks


def _part(month, partitions):
    """The folder of a month (year * 100 + month; 0: unknown, NULL in the calendar)."""
    values = (month // 100, month % 100)
    if partitions == CALENDAR_PARTITIONS and not month:
        values = (versions.NULL_PART,) * 2
    return "/".join(f"{p}={v}" for p, v in zip(partitions, values))


def _merged_parts(old, new, months, partitions):
    """``old`` with the parts of ``months`` replaced by ``new``; months left without rows go."""
    touched = {_part(m, partitions) for m in months}
    return {p: f for p, f in old.items() if p not in touched} | new


def refresh_calendar(arrivals, cfg):
    """Add the dates of ``arrivals`` to the calendar; months without new dates are not touched.

    The months that occur in ``arrivals`` are written anew with their stored dates and the new ones,
    and published.
    """
    spark, run_name = arrivals.sparkSession, versions.new_run()
    new = model.dim_calendar(arrivals.filter(F.col("arrdate").isNotNull()), keep_unknown=False)
    staged = join_path(cfg.staging, f"calendar-{run_name}")
    new = writers.stage_parquet(new, staged)
    months = _months(new, CALENDAR_PARTITIONS)
    if not months:
        writers.remove_staged(spark, staged)
        return 0
    old = versions.table_parts(spark, cfg.output, "dim_calendar", CALENDAR_PARTITIONS)
    stored = versions.read_parts(spark, cfg.output, old, _with_folders(schemas.DIM_CALENDAR.fields, CALENDAR_PARTITIONS))
    merged = new.unionByName(_in_months(stored, months, CALENDAR_PARTITIONS)).dropDuplicates(["arrdate"])
    parts, check = _write_and_check(
        merged.select(*schemas.DIM_CALENDAR.names), cfg, run_name, "dim_calendar", CALENDAR_PARTITIONS, ["arrdate"])
    writers.remove_staged(spark, staged)
    versions.publish(spark, cfg.output, {"dim_calendar": old | parts}, {"dim_calendar": old})
    return check.total_rows


def _needs_months(cfg):
    if not cfg.monthly:
        raise ValueError("only a lake with monthly=True can be refreshed by month")


def _months_of_keys(stored, rows, keys, columns):
    """The months in which ``stored`` has keys of ``rows``.

    Only the key column and the folders are read, and of the key column only row groups within
    the range of the new keys: the cleaned arrivals are sorted by key inside their files.
    """
    key = keys[0]
    ends = rows.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if ends["lo"] is None:
        return []
    near = stored.filter(F.col(key).between(ends["lo"], ends["hi"])).select(*keys, *columns)
    return _months(sized_semi_join(near, rows.select(*keys).distinct(), list(keys)), columns)


def refresh_arrivals(batch, cfg):
    """Merge the raw arrivals ``batch`` into the months that it touches; the others stay unread.

    The cleaning rule runs over stored and new rows of a month together, so the tables equal those
    of a whole run over all rows; there rows that repeat within the batch's months go as well. With ``one_row_per_key`` the stored months of the batch's keys are
    touched too. Merging a batch twice changes nothing. All tables are published at once, and
    only if their checks pass. Returns checks of the touched months; none for a batch without rows.
    """
    _needs_months(cfg)
    spark, run_name, rule = batch.sparkSession, versions.new_run(), cfg.arrivals_rule
    new = readers.conform(batch, schemas.ARRIVALS, "the batch")
    new = clean_arrivals(new, rule, True, one_row_per_key=cfg.one_row_per_key, repeats=not cfg.one_row_per_key)
    staged = join_path(cfg.staging, f"arrivals-{run_name}")
    new = writers.stage_parquet(new, staged)
    months = _months(new, ARRIVAL_MONTH)
    checks = []
    if months:
        names = {t: _folders_of(t, cfg) for t in (
            CLEAN_ARRIVALS, PROFILE, "dim_calendar", "dim_immigrant", "fact_i94_immigration")}
        old = {t: versions.table_parts(spark, cfg.output, t, folders) for t, folders in names.items()}
        stored = versions.read_parts(
            spark, cfg.output, old[CLEAN_ARRIVALS], _with_folders(new.schema.fields, ARRIVAL_MONTH))
        if cfg.one_row_per_key and rule.keys:
            months = sorted({*months, *_months_of_keys(stored, new, rule.keys, ARRIVAL_MONTH)})
        both = new.unionByName(_in_months(stored, months, ARRIVAL_MONTH))
        merged = _monthly_rule(rule, cfg.one_row_per_key)(both)
        tables = {}
        tables[CLEAN_ARRIVALS], cleaned, _ = _write(
            merged, cfg, run_name, CLEAN_ARRIVALS, ARRIVAL_MONTH, sorted_by=rule.keys or ())
        tables[PROFILE] = _write_profile(cleaned, cfg, run_name)
        # These months' dates anew, since a stored row may have given way to one of another day.
        done = _arrivals_tables(spark, cfg, run_name, cleaned)
        checks = [done[t][1] for t in ("dim_immigrant", "fact_i94_immigration")]
        tables |= {t: parts for t, (parts, _) in done.items()}
        _publish(spark, cfg, {t: _merged_parts(old[t], parts, months, names[t]) for t, parts in tables.items()},
                 [c for _, c in done.values()], old)
    writers.remove_staged(spark, staged)
    return checks


def refresh_temperatures(batch, cfg):
    """The same for raw temperature readings."""
    _needs_months(cfg)
    spark, run_name = batch.sparkSession, versions.new_run()
    new = readers.conform(batch, schemas.TEMPERATURES, "the batch")
    new = _temperatures_table(cfg.temperatures_rule(new), cfg)
    staged = join_path(cfg.staging, f"temperatures-{run_name}")
    new = writers.stage_parquet(new, staged)
    months = _months(new, READING_MONTH)
    checks = []
    if months:
        table, keys = "dim_temperatures", _temperature_keys(cfg)
        old = versions.table_parts(spark, cfg.output, table, READING_MONTH)
        stored = versions.read_parts(
            spark, cfg.output, old, _with_folders(schemas.DIM_TEMPERATURES.fields, READING_MONTH))
        both = new.unionByName(_in_months(stored, months, READING_MONTH))
        merged = cleaning.drop_duplicate_rows(both, keys or None)
        parts, check = _write_and_check(merged, cfg, run_name, table, READING_MONTH, keys)
        checks = [check]
        _publish(spark, cfg, {table: _merged_parts(old, parts, months, READING_MONTH)}, checks, {table: old})
    writers.remove_staged(spark, staged)
    return checks


def report_frame(spark, checks):
    return spark.createDataFrame(checks, quality.CHECK_SCHEMA)


def flow_frame(spark, flows):
    """One row per dataset: rows read, emptied, repeated and kept."""
    return spark.createDataFrame(flows, cleaning.FLOW_SCHEMA)
