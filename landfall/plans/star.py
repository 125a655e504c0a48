"""Joins along the relationships that the star schema declares."""

from pyspark.sql import functions as F

from landfall.functions.missing import is_present
from landfall.operators.cleaning import drop_duplicate_rows
from landfall.operators.joins import lookup_join, sized_broadcast


def fact_with_immigrant(fact, immigrant):
    """Every fact row that has a cicid with its person: a shuffled equi-join.

    Rows without cicid (NULL or NaN) match nothing. Of several people under one cicid the first
    in the order of the other columns counts, so no fact row is multiplied.
    """
    people = drop_duplicate_rows(immigrant.filter(is_present(immigrant, "cicid")), ["cicid"])
    return fact.filter(is_present(fact, "cicid")).join(people, "cicid", "inner")


def fact_in_calendar(parts, calendar, condition, folders):
    """Fact rows of the calendar days that meet ``condition``, with the days' columns.

    ``parts`` are frames of a fact split by the columns ``folders``, year and month of ``arrdate``. A
    condition on year and month prunes the folders when the query is planned, one on other columns
    while it runs, by the months of the days found: files of other months are not read.
    """
    days = calendar.where(condition).where(F.col("arrdate").isNotNull())
    days = sized_broadcast(days.withColumnsRenamed({"arrdate": "_day", "year": "_year", "month": "_month"}))
    year, month = folders
    result = None
    for part in parts:
        joined = part.join(days, (F.col(year) == F.col("_year")) & (F.col(month) == F.col("_month"))
                           & (F.col("arrdate") == F.col("_day"))).drop("_day")
        joined = joined.withColumnsRenamed({"_year": "year", "_month": "month"}).drop(*folders)
        result = joined if result is None else result.unionByName(joined)
    return result


def fact_with_calendar(fact, calendar):
    """Every fact row; an unknown arrival date matches no calendar row.

    ``calendar`` should be the written table: it is read once to measure it and once to join.
    """
    return lookup_join(fact, calendar, "arrdate")


def city_rows(demographics):
    """One row per state and city: the source repeats a city's totals for every race."""
    totals = ["total_pop", "male_pop", "female_pop", "foreign_born", "veteran_number"]
    return demographics.groupBy("state_code", "city").agg(*[F.max(c).alias(c) for c in totals])


def state_population(demographics):
    totals = ["total_pop", "male_pop", "female_pop", "foreign_born", "veteran_number"]
    return city_rows(demographics).groupBy("state_code").agg(
        F.count(F.lit(1)).alias("cities"), *[F.sum(c).alias(c) for c in totals]
    )


def fact_with_state(fact, demographics):
    """Adds the population of the state of arrival; rows of unknown states stay."""
    states = state_population(demographics).withColumnRenamed("state_code", "i94addr")
    return lookup_join(fact, states, "i94addr", computed=True)


def _city_key(column):
    return F.lower(F.trim(column))


def city_population(demographics):
    """One row per city name, since temperatures carry no state: states are added up."""
    return city_rows(demographics).groupBy(_city_key(F.col("city")).alias("city_key")).agg(
        F.countDistinct("state_code").alias("states"), F.sum("total_pop").alias("total_pop")
    )


def temperatures_with_city(temperatures, demographics, country="United States"):
    """Readings of one country's cities with the cities' population."""
    readings = temperatures.filter(F.col("country") == country).withColumn(
        "city_key", _city_key(F.col("city"))
    )
    cities = city_population(demographics)
    return lookup_join(readings, cities, "city_key", "inner", computed=True).drop("city_key")
