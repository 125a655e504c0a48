"""Day numbers counted from 1960-01-01, and calendar parts."""

from pyspark.sql import functions as F

# The epoch of the day numbers, and its distance in days from the
# first and the last date of the four-digit calendar.
EPOCH = "1960-01-01"
FIRST_DAY = -715509
LAST_DAY = 2936549


def day_number_to_date(column):
    """Date of a day number; fractions are floored.

    NULL, NaN and numbers outside years 1 to 9999 give NULL. NaN sorts above every
    number, so the upper bound excludes it.
    """
    days = column.cast("double")
    in_calendar = (days >= FIRST_DAY) & (days < LAST_DAY + 1)
    return F.when(
        in_calendar, F.date_add(F.lit(EPOCH).cast("date"), F.floor(days).cast("int"))
    )


def date_to_day_number(column):
    return F.datediff(column, F.lit(EPOCH).cast("date")).cast("double")


def calendar_parts(column):
    """Year, month, day, ISO week and weekday (1 = Sunday) of a date, by output name."""
    return {
        "year": F.year(column),
        "month": F.month(column),
        "day": F.dayofmonth(column),
        "week": F.weekofyear(column),
        "weekday": F.dayofweek(column),
    }
