"""Empty-row removal, de-duplication, missing-value profile and the combined clean."""

from dataclasses import dataclass

from typing import NamedTuple

import numpy as np
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from landfall import schemas
from landfall.functions.missing import is_present, missing_count, ratio
from landfall.functions.names import fresh, quoted
from landfall.sources.writers import stage_parquet


def drop_empty_rows(df, subset=None):
    """Drop rows whose listed columns (default: all) are every one missing."""
    if subset is not None and len(subset) == 1:
        return df.filter(is_present(df, subset[0]))
    return df.na.drop(how="all", subset=subset)


def drop_duplicate_rows(df, keys=None, first_by=(), together=()):
    """Keep one row per distinct row, or per key.

    Per key the kept row is the first in the order of the columns ``first_by``, then of all
    other columns, so the result does not depend on partitioning. Columns of ``first_by``
    that the frame lacks are passed over. Spark limits each map task to one row
    per key before the shuffle, so a key that holds much of the data stays cheap.

    Whole rows with columns ``together`` go by these alone to the task that compares them. The map tasks
    then keep no table of whole rows, which would spill, and rows that differ elsewhere lie side by side in
    the shuffle. Choose columns that tell most rows apart: all rows that agree in them meet in one task.
    """
    if keys is None and together:
        home = fresh("_home", df)
        dealt = df.withColumn(home, F.hash(*[F.col(quoted(c)) for c in together])).repartition(F.col(home))
        return dealt.dropDuplicates().drop(home)
    if keys is None:
        return df.dropDuplicates()
    leading = [c for c in first_by if c in df.columns and c not in keys]
    others = leading + [c for c in df.columns if c not in keys and c not in leading]
    if not others:
        return df.dropDuplicates(keys)
    order = [F.col(quoted(c)).asc_nulls_last() for c in others]
    window = Window.partitionBy(*[F.col(quoted(k)) for k in keys]).orderBy(*order)
    row = fresh("_row_in_key", df)
    return df.withColumn(row, F.row_number().over(window)).filter(F.col(row) == 1).drop(row)


def null_profile(df):
    """(column_name, null_count, ratio_to_total) for every column, in one pass."""
    rows = fresh("_rows", df)
    counts = df.agg(
        F.count(F.lit(1)).alias(rows),
        *[missing_count(df, c).alias(c) for c in df.columns],
    )
    long = counts.unpivot(
        rows, [F.col(quoted(c)) for c in df.columns], "column_name", "null_count"
    )
    return long.select(
        "column_name", "null_count", ratio(F.col("null_count"), F.col(rows)).alias("ratio_to_total")
    )


def high_null_profile(df, thresh=0.7):
    """Profile rows of the columns whose rounded missing ratio exceeds ``thresh``."""
    return null_profile(df).filter(F.col("ratio_to_total") > thresh)


def drop_high_null_columns(df, thresh=0.7):
    """Runs one aggregate job; at most one small row per column reaches the driver."""
    flagged = [r.column_name for r in high_null_profile(df, thresh).select("column_name").collect()]
    return df.drop(*[F.col(quoted(c)) for c in flagged])


def missing_counts(df):
    """{name: aggregate}: the missing values of every column, to be measured while ``df`` is written."""
    return {f"missing_{i}": missing_count(df, c) for i, c in enumerate(df.columns)}


def sparse_columns(columns, measured, thresh):
    """Those of ``columns`` whose rounded missing ratio exceeds ``thresh``, by what a write has measured."""
    rows = measured["rows"]
    return [c for i, c in enumerate(columns)
            if rows and np.rint(measured[f"missing_{i}"] / rows * 1000) / 1000 > thresh]


def clean(subset=None, drop_cols=False, thresh=0.7, staging=None):
    """For ``df.transform``: empty rows, then duplicates, then sparse columns.

    ``drop_cols`` looks at the data while the plan is built. With ``staging``, a
    folder that all executors can reach, the de-duplicated rows are stored there
    first, so that the look and the later use compute them once.
    """
    def apply(df):
        cleaned = drop_duplicate_rows(drop_empty_rows(df, subset), subset)
        if not drop_cols:
            return cleaned
        if staging:
            cleaned = stage_parquet(cleaned, staging)
        return drop_high_null_columns(cleaned, thresh)

    return apply


class FlowCount(NamedTuple):
    """rows_read = rows_emptied + rows_repeated + rows_kept."""

    dataset: str
    rows_read: int
    rows_emptied: int
    rows_repeated: int
    rows_kept: int


FLOW_SCHEMA = "dataset string, rows_read long, rows_emptied long, rows_repeated long, rows_kept long"


class RowFlow:
    """Counts where a rule's rows go, inside the one plan that cleans and writes them.

    Pass it to a ``CleanRule`` and let an action run the plan; ``counts`` then waits for the numbers.
    Rows read, and those without a required value, are counted before the first step; rows left
    after each step behind it. A rule that cleans a dataset in shares is passed it for each of them.
    """

    def __init__(self, dataset):
        self.dataset = dataset
        self._seen = {}

    def _observe(self, df, name, *columns):
        seen = Observation()
        self._seen.setdefault(name, []).append(seen)
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *columns)

    def read(self, df, required):
        present = F.lit(False)
        for c in required or df.columns:
            present = present | is_present(df, c)
        return self._observe(df, "read", F.count_if(~present).alias("emptied"))

    def present(self, df):
        return self._observe(df, "present")

    def kept(self, df):
        return self._observe(df, "kept")

    def counts(self):
        """The ``FlowCount``; None if no rule was observed."""
        if len(self._seen) < 3:
            return None
        read, present, kept = (sum(s.get["rows"] for s in self._seen[n]) for n in ("read", "present", "kept"))
        emptied = sum(s.get["emptied"] for s in self._seen["read"])
        return FlowCount(self.dataset, read, emptied, present - kept, kept)


@dataclass(frozen=True)
class CleanRule:
    """Columns to drop, columns of which one must be present, and the row key.

    ``first_by`` orders the rows of a key before all other columns do, so that the kept row's
    values in these columns do not depend on which further columns were read. ``thresh`` is for
    jobs: columns whose rounded missing ratio after cleaning exceeds it are sparse and emptied.
    ``together`` is for whole rows, see ``drop_duplicate_rows``.
    """

    drop_cols: tuple = ()
    required: tuple | None = None
    keys: tuple | None = None
    first_by: tuple = ()
    thresh: float | None = None
    together: tuple = ()

    def __call__(self, df, flow=None):
        required = list(self.required) if self.required else None
        df = df.drop(*self.drop_cols)
        if flow:
            df = flow.read(df, required)
        df = drop_empty_rows(df, required)
        if flow:
            df = flow.present(df)
        df = drop_duplicate_rows(df, list(self.keys) if self.keys else None, self.first_by, self.together)
        return flow.kept(df) if flow else df


# The documented cleaning keys of each dataset.
FULL_ROW = CleanRule()
ARRIVALS_BY_ID = CleanRule(
    ("occup", "entdepu", "insnum"), ("cicid",), ("cicid",),
    tuple(c.name for c in schemas.ARRIVALS if c.name in {*schemas.DIM_IMMIGRANT.names, *schemas.FACT_ARRIVALS.names}),
)
TEMPERATURES_BY_CITY_DATE = CleanRule((), ("AverageTemperature",), ("dt", "City", "Country"))
DEMOGRAPHICS_BY_CITY = CleanRule(
    (),
    ("City", "Male Population", "Female Population", "Foreign-born", "Average Household Size"),
    ("City", "Male Population", "Female Population", "Foreign-born", "Average Household Size"),
)
