"""Builders of the four dimensions and the fact: frame in, frame out, no I/O."""

from pyspark.sql import functions as F

from landfall import schemas
from landfall.functions.dates import calendar_parts, day_number_to_date
from landfall.functions.keys import date_key, hash_key
from landfall.operators.columns import rename_columns

# Business names of the source columns.
DEMOGRAPHICS_NAMES = {
    "City": "city",
    "State": "state",
    "Median Age": "median_age",
    "Male Population": "male_pop",
    "Female Population": "female_pop",
    "Total Population": "total_pop",
    "Number of Veterans": "veteran_number",
    "Foreign-born": "foreign_born",
    "Average Household Size": "avg_household_size",
    "State Code": "state_code",
    "Race": "race",
    "Count": "count",
}
TEMPERATURES_NAMES = {
    "dt": "dt",
    "AverageTemperature": "avg_temp",
    "AverageTemperatureUncertainty": "avg_temp_uncertainty",
    "City": "city",
    "Country": "country",
    "Latitude": "latitude",
    "Longitude": "longitude",
}


def dim_calendar(arrivals, keep_unknown=True):
    """One row per arrival date, with one row for the unknown date if there is any.

    Each task reduces its rows to their few distinct dates before the one shuffle;
    the parts are derived after it.
    """
    dates = arrivals.select(day_number_to_date(F.col("arrdate")).alias("arrdate")).distinct()
    if not keep_unknown:
        dates = dates.filter(F.col("arrdate").isNotNull())
    parts = calendar_parts(F.col("arrdate"))
    return dates.select(
        "arrdate", date_key(F.col("arrdate")).alias("id"), *[c.alias(n) for n, c in parts.items()]
    )


def dim_immigrant(arrivals, folders=()):
    """``folders`` are further columns by which the table is to be split."""
    return arrivals.select(*schemas.DIM_IMMIGRANT.names, *folders)


def fact_arrivals(arrivals, folders=()):
    return arrivals.select(*schemas.FACT_ARRIVALS.names, *folders).withColumn(
        "arrdate", day_number_to_date(F.col("arrdate"))
    )


def dim_demographics(demographics):
    """The key covers every column, so rows that differ at all get different keys."""
    renamed = rename_columns(demographics, DEMOGRAPHICS_NAMES)
    return renamed.withColumn("id", hash_key(renamed, list(DEMOGRAPHICS_NAMES.values())))


def dim_temperatures(temperatures):
    return rename_columns(temperatures, TEMPERATURES_NAMES)


def with_departure_date(df):
    """Adds ``depdate_dt``; the raw day number stays."""
    return df.withColumn("depdate_dt", day_number_to_date(F.col("depdate")))


def arrivals_model_columns():
    """The source columns that any target built from arrivals reads."""
    wanted = set(schemas.DIM_IMMIGRANT.names) | set(schemas.FACT_ARRIVALS.names)
    return [c for c in schemas.ARRIVALS.names if c in wanted]
