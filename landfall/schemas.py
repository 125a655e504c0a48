"""Column contracts of the three sources, the five targets and the code dictionary."""

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE, DATE = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType(),
)


def _schema(*fields):
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


# Column names of the published datasets and of the star schema.
ARRIVALS = _schema(
    ("cicid", DOUBLE), ("i94yr", DOUBLE), ("i94mon", DOUBLE), ("i94cit", DOUBLE),
    ("i94res", DOUBLE), ("i94port", STRING), ("arrdate", DOUBLE), ("i94mode", DOUBLE),
    ("i94addr", STRING), ("depdate", DOUBLE), ("i94bir", DOUBLE), ("i94visa", DOUBLE),
    ("count", DOUBLE), ("dtadfile", STRING), ("visapost", STRING), ("occup", STRING),
    ("entdepa", STRING), ("entdepd", STRING), ("entdepu", STRING), ("matflag", STRING),
    ("biryear", DOUBLE), ("dtaddto", STRING), ("gender", STRING), ("insnum", STRING),
    ("airline", STRING), ("admnum", DOUBLE), ("fltno", STRING), ("visatype", STRING),
)

TEMPERATURES = _schema(
    ("dt", DATE), ("AverageTemperature", DOUBLE), ("AverageTemperatureUncertainty", DOUBLE),
    ("City", STRING), ("Country", STRING), ("Latitude", STRING), ("Longitude", STRING),
)

DEMOGRAPHICS = _schema(
    ("City", STRING), ("State", STRING), ("Median Age", DOUBLE), ("Male Population", LONG),
    ("Female Population", LONG), ("Total Population", LONG), ("Number of Veterans", LONG),
    ("Foreign-born", LONG), ("Average Household Size", DOUBLE), ("State Code", STRING),
    ("Race", STRING), ("Count", LONG),
)

DIM_IMMIGRANT = _schema(
    ("cicid", DOUBLE), ("i94cit", DOUBLE), ("i94res", DOUBLE), ("i94mode", DOUBLE),
    ("depdate", DOUBLE), ("i94bir", DOUBLE), ("gender", STRING),
)

DIM_DEMOGRAPHICS = _schema(
    ("city", STRING), ("state", STRING), ("median_age", DOUBLE), ("male_pop", LONG),
    ("female_pop", LONG), ("total_pop", LONG), ("veteran_number", LONG),
    ("foreign_born", LONG), ("avg_household_size", DOUBLE), ("state_code", STRING),
    ("race", STRING), ("count", LONG), ("id", LONG),
)

DIM_TEMPERATURES = _schema(
    ("dt", DATE), ("avg_temp", DOUBLE), ("avg_temp_uncertainty", DOUBLE), ("city", STRING),
    ("country", STRING), ("latitude", STRING), ("longitude", STRING),
)

DIM_CALENDAR = _schema(
    ("arrdate", DATE), ("id", LONG), ("year", INT), ("month", INT), ("day", INT),
    ("week", INT), ("weekday", INT),
)

FACT_ARRIVALS = _schema(
    ("cicid", DOUBLE), ("arrdate", DATE), ("count", DOUBLE), ("visapost", STRING),
    ("entdepa", STRING), ("entdepd", STRING), ("biryear", DOUBLE), ("dtaddto", STRING),
    ("airline", STRING), ("fltno", STRING), ("visatype", STRING), ("i94addr", STRING),
    ("i94visa", DOUBLE),
)

CODE_LABELS = _schema(
    ("fmt", STRING), ("raw_code", STRING), ("code", STRING), ("label", STRING),
)

TARGETS = {
    "dim_immigrant": DIM_IMMIGRANT,
    "dim_usa_demographics": DIM_DEMOGRAPHICS,
    "dim_temperatures": DIM_TEMPERATURES,
    "dim_calendar": DIM_CALENDAR,
    "fact_i94_immigration": FACT_ARRIVALS,
}
