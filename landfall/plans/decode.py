"""Decoding and normalising codes with a label dictionary ``(fmt, code, label)``.

The rules follow the wording of the dictionary; the lookups are joins.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.missing import is_missing
from landfall.functions.names import fresh, quoted
from landfall.operators.joins import lookup_join

# Names of the dictionary's formats and its catch-all state code.
COUNTRY, PORT, MODE, STATE = "i94cntyl", "i94prtl", "i94model", "i94addrl"
OTHER_STATE = "99"

# The three visa categories.
VISA_CATEGORIES = {1: "Business", 2: "Pleasure", 3: "Student"}

# Wordings that mark a code as unusable.
LABEL_CLASSES = {
    r"^INVALID\b": "invalid",
    r"^Collapsed\b": "collapsed",
    r"^No (?:PORT|Country) Code\b": "no_code",
}
COLLAPSED_PORT = r"^Collapsed (?:into |\()(\w+)"
# Two collapsed countries that the dictionary names only in words.
COLLAPSED_COUNTRIES = {"311": "353", "741": "721"}

# Remarks that follow a port's name, and the form "CITY, ST".
PORT_REMARK = r"(?:\s*(?:\([^)]*\)|#\w+))+\s*$"
PORT_PLACE = r"^(.*?)[,\s]\s*([A-Z]{2})$"


def code_text(df, name):
    """A code as dictionary text: whole numbers without a fraction, text trimmed."""
    column = F.col(quoted(name))
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(column == F.floor(column), column.try_cast("long")).cast("string")
    return F.trim(column.cast("string"))


def _lookup(labels, fmt, value, name):
    """One row per code of a format, so a repeated entry cannot multiply rows."""
    entries = labels.filter((F.col("fmt") == fmt) & value.isNotNull())
    return entries.groupBy("code").agg(F.min(value).alias(name))


def _with_lookup(df, lookup, column):
    code = fresh("_code", df, lookup)
    keyed = df.withColumn(code, code_text(df, column))
    return lookup_join(keyed, lookup.withColumnRenamed("code", code), code).drop(code)


def decode(df, labels, fmt, column, name):
    """Adds the label of ``column`` as ``name``; unlisted codes keep their row with NULL."""
    return _with_lookup(df, _lookup(labels, fmt, F.col("label"), name), column)


def normalise_state(df, labels, column="i94addr", name="state_code"):
    """Listed state codes stay; every other code, and NULL, becomes ``99``."""
    lookup = _lookup(labels, STATE, F.col("code"), name)
    return _with_lookup(df, lookup, column).withColumn(
        name, F.coalesce(F.col(name), F.lit(OTHER_STATE))
    )


def visa_category(df, column="i94visa", name="visa_category"):
    pairs = [F.lit(x) for item in VISA_CATEGORIES.items() for x in (str(item[0]), item[1])]
    return df.withColumn(name, F.try_element_at(F.create_map(*pairs), code_text(df, column)))


def travel_mode(df, labels, column="i94mode", name="travel_mode"):
    """The mode's label; a missing mode is ``Missing``, apart from ``Not reported``."""
    missing = is_missing(df, column) | (code_text(df, column) == "")
    return decode(df, labels, MODE, column, name).withColumn(
        name, F.when(missing, "Missing").otherwise(F.col(name))
    )


def label_class(label):
    """``invalid``, ``collapsed``, ``no_code`` or ``valid``; NULL without a label."""
    result = F.when(label.isNotNull(), "valid")
    for pattern, name in reversed(LABEL_CLASSES.items()):
        result = F.when(label.rlike(pattern), name).otherwise(result)
    return result


def collapsed_target(fmt, code, label):
    """The code that replaces a collapsed one, else NULL."""
    pairs = [F.lit(x) for item in COLLAPSED_COUNTRIES.items() for x in item]
    port = F.regexp_extract(label, COLLAPSED_PORT, 1)
    return F.when(label_class(label) == "collapsed", (
        F.when((fmt == PORT) & (port != ""), port)
        .when(fmt == COUNTRY, F.try_element_at(F.create_map(*pairs), code))
    ))


def remap_collapsed(df, labels, fmt, column, name):
    """Adds the code to use instead of ``column``; other codes stay as they are."""
    target = collapsed_target(F.col("fmt"), F.col("code"), F.col("label"))
    joined = _with_lookup(df, _lookup(labels, fmt, target, name), column)
    return joined.withColumn(name, F.coalesce(F.col(name), code_text(df, column)))


def port_places(labels):
    """(code, label, city, state) of the valid ports; no state outside the listed states."""
    ports = labels.filter((F.col("fmt") == PORT) & (label_class(F.col("label")) == "valid"))
    states = labels.filter(
        (F.col("fmt") == STATE) & (F.col("code") != OTHER_STATE)
    ).select(F.col("code").alias("state")).distinct()
    name = F.regexp_replace("label", PORT_REMARK, "")
    split = ports.select(
        "code", "label", name.alias("_name"),
        F.nullif(F.regexp_extract(name, PORT_PLACE, 2), F.lit("")).alias("state"),
    )
    matched = lookup_join(split, states.withColumn("_listed", F.lit(True)), "state")
    return matched.select(
        "code", "label",
        F.when(F.col("_listed"), F.regexp_extract("_name", PORT_PLACE, 1))
        .otherwise(F.col("_name")).alias("city"),
        F.when(F.col("_listed"), F.col("state")).alias("state"),
    )
