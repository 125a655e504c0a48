"""Source-shaped views of the test tables.

The test tables hold no missing values and no repeated rows, so the views make both:
each is a list of portable SQL expressions, used by Spark as ``F.expr`` and by the
check SQL as text. ``DAYS`` is the one expression that differs between the two.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from landfall.functions.names import fresh
from landfall.sources.labels import parse_labels

SPARK_WORDS = {
    "DAYS": "CAST(datediff(CAST({} AS DATE), DATE '1960-01-01') AS DOUBLE)",
    "NAN": "CAST('NaN' AS DOUBLE)",
}
CHECK_WORDS = {
    "DAYS": "CAST(date_diff('day', DATE '1960-01-01', CAST({} AS DATE)) AS DOUBLE)",
    "NAN": "CAST('NaN' AS DOUBLE)",
}


def load(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@dataclass(frozen=True)
class View:
    """Columns over one table, and extra copies of some of its rows.

    ``repeats`` lists (row condition, columns that differ in the copy).
    """

    table: str
    date: str
    columns: dict
    repeats: tuple = ()

    def _parts(self):
        yield "TRUE", self.columns
        for condition, changed in self.repeats:
            yield condition, {**self.columns, **changed}

    def frame(self, spark, sf_dir):
        """One scan of the table: a row and its copies come from the same task."""
        words = {"DAYS": SPARK_WORDS["DAYS"].format(self.date), "NAN": SPARK_WORDS["NAN"]}
        rows = load(spark, sf_dir, self.table)
        copy, copies = fresh("_copy", rows), [F.array(F.lit(0))]
        for i, (condition, _) in enumerate(self.repeats, 1):
            copies.append(F.when(F.expr(condition), F.array(F.lit(i))).otherwise(F.array().cast("array<int>")))
        if self.repeats:
            rows = rows.withColumn(copy, F.explode(F.concat(*copies)))
        columns = {n: F.expr(e.format(**words)) for n, e in self.columns.items()}
        for i, (_, changed) in enumerate(self.repeats, 1):
            for n, e in changed.items():
                columns[n] = F.when(F.col(copy) == i, F.expr(e.format(**words))).otherwise(columns[n])
        return rows.select([c.alias(n) for n, c in columns.items()])

    def sql(self):
        words = {"DAYS": CHECK_WORDS["DAYS"].format(self.date), "NAN": CHECK_WORDS["NAN"]}
        return " UNION ALL ".join(
            "SELECT "
            + ", ".join(f'{e.format(**words)} AS "{n}"' for n, e in columns.items())
            + f" FROM {self.table} WHERE {condition}"
            for condition, columns in self._parts()
        )


# Thirty two-letter codes, the first 25 of which the test dictionary lists; ``substr`` picks one.
STATES = "".join((
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA",
    "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "NE", "NV", "NH", "NJ", "NM",
))

ARRIVALS = View(
    "lineitem",
    "l_shipdate",
    {
        "cicid": "CASE WHEN l_orderkey % 97 = 0 THEN NULL "
                 "WHEN l_orderkey % 89 = 0 THEN {NAN} "
                 "ELSE CAST(l_orderkey * 10 + l_linenumber AS DOUBLE) END",
        "i94yr": "CAST(year(CAST(l_shipdate AS DATE)) AS DOUBLE)",
        "i94mon": "CAST(month(CAST(l_shipdate AS DATE)) AS DOUBLE)",
        "i94cit": "CASE WHEN l_partkey % 61 = 0 THEN NULL ELSE CAST(l_partkey % 800 AS DOUBLE) END",
        "i94res": "CAST(l_suppkey AS DOUBLE)",
        "i94port": "CASE WHEN l_partkey % 53 = 0 THEN 'none' ELSE CAST(l_partkey AS STRING) END",
        "arrdate": "CASE WHEN l_partkey % 50 = 3 THEN NULL WHEN l_partkey % 47 = 5 THEN {NAN} "
                   "WHEN l_partkey % 41 = 2 THEN {DAYS} + 0.9 ELSE {DAYS} END",
        "i94mode": "CASE WHEN l_linenumber = 7 THEN NULL WHEN l_suppkey % 10 = 1 THEN {NAN} "
                   "ELSE CAST(l_linenumber - 1 AS DOUBLE) END",
        "i94addr": "CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN 'CA' "
                   f"ELSE substr('{STATES}', CAST(1 + 2 * (l_suppkey % 30) AS INT), 2) END",
        "depdate": "CASE WHEN l_partkey % 37 = 0 THEN NULL WHEN l_partkey % 31 = 0 THEN -0.5 "
                   "WHEN l_partkey % 29 = 0 THEN 1e300 ELSE {DAYS} + 14 END",
        "i94bir": "CASE WHEN l_partkey % 43 = 1 THEN NULL ELSE CAST(l_partkey % 90 AS DOUBLE) END",
        "i94visa": "CAST(l_partkey % 5 AS DOUBLE)",
        "count": "l_quantity",
        "dtadfile": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
        "visapost": "CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE 'V' || CAST(l_suppkey AS STRING) END",
        "occup": "CASE WHEN l_orderkey % 10 = 0 THEN 'STU' END",
        "entdepa": "l_returnflag",
        "entdepd": "l_linestatus",
        "entdepu": "CASE WHEN l_orderkey % 20 = 0 THEN 'U' END",
        "matflag": "'M'",
        "biryear": "CAST(1900 + l_partkey % 90 AS DOUBLE)",
        "dtaddto": "CAST(l_partkey AS STRING)",
        "gender": "CASE WHEN l_suppkey % 4 = 0 THEN 'M' WHEN l_suppkey % 4 = 1 THEN 'F' "
                  "WHEN l_suppkey % 4 = 2 THEN 'X' END",
        "insnum": "CASE WHEN l_orderkey % 12 = 0 THEN CAST(l_orderkey AS STRING) END",
        "airline": "'A' || CAST(l_suppkey % 20 AS STRING)",
        "admnum": "l_extendedprice",
        "fltno": "CAST(l_partkey % 1000 AS STRING)",
        "visatype": "'B' || CAST(l_linenumber AS STRING)",
    },
    (
        ("l_returnflag = 'R'", {}),
        ("l_linestatus = 'O'", {"airline": "'0X'"}),
    ),
)

TEMPERATURES = View(
    "events",
    "ts",
    {
        "dt": "CAST(ts AS DATE)",
        "AverageTemperature": "CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN {NAN} "
                              "ELSE value END",
        "AverageTemperatureUncertainty": "CASE WHEN event_id % 3 = 0 THEN NULL "
                                         "ELSE CAST(event_id % 100 AS DOUBLE) / 8 END",
        "City": "CASE WHEN event_id % 3 = 0 THEN 'cITY ' ELSE 'City ' END "
                "|| CAST(user_id % 60 AS STRING)",
        "Country": "CASE WHEN event_type IN ('view', 'click') THEN 'United States' "
                   "ELSE upper(event_type) END",
        "Latitude": "CAST(user_id % 90 AS STRING) || 'N'",
        "Longitude": "CAST(user_id % 180 AS STRING) || 'W'",
    },
    (("event_type = 'click'", {}),),
)

DEMOGRAPHICS = View(
    "part",
    "CURRENT_DATE",
    {
        "City": "'City ' || CAST(p_size AS STRING)",
        "State": "'State of ' || p_type",
        "Median Age": "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(p_partkey % 97 AS DOUBLE) / 2 END",
        "Male Population": "p_partkey % 977",
        "Female Population": "p_partkey % 983",
        "Total Population": "p_partkey % 977 + p_partkey % 983",
        "Number of Veterans": "CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_partkey % 101 END",
        "Foreign-born": "p_partkey % 103",
        "Average Household Size": "p_retailprice",
        "State Code": "CASE WHEN p_type = 'ECONOMY' THEN 'AL' WHEN p_type = 'SMALL' THEN 'AK' "
                      "WHEN p_type = 'LARGE' THEN 'CA' ELSE 'CO' END",
        "Race": "p_brand",
        "Count": "p_partkey",
    },
    (("p_type = 'SMALL'", {}),),
)

DIRTY_EVENTS = View(
    "events",
    "ts",
    {
        "id": "CASE WHEN event_id % 100 = 0 THEN NULL ELSE event_id END",
        "value": "CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN {NAN} ELSE value END",
        "kind": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END",
        "sixty": "CASE WHEN event_id % 10 < 4 THEN 'y' END",
        "sparse": "CASE WHEN event_id % 5 = 0 THEN 'x' END",
    },
    (("event_type = 'view'", {}), ("event_type = 'error'", {"kind": "'again'"})),
)

CODED_DAYS = View(
    "orders",
    "o_orderdate",
    {
        "o_orderkey": "o_orderkey",
        "day_number": "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN {NAN} "
                      "WHEN o_orderkey % 19 = 0 THEN 1e300 WHEN o_orderkey % 23 = 0 THEN {DAYS} + 0.9 "
                      "WHEN o_orderkey % 29 = 0 THEN -0.5 WHEN o_orderkey % 31 = 0 THEN 0.0 "
                      "WHEN o_orderkey % 37 = 0 THEN -3e6 ELSE {DAYS} END",
    },
)

# The label dictionary: entries of four formats, taken from part, nation and region.
PORT_LABEL = (
    "CASE WHEN p_partkey % 8 = 0 THEN 'INVALID - ' || upper(p_name) "
    "WHEN p_partkey % 8 = 1 THEN 'Collapsed into ' || CAST(p_partkey + 1 AS STRING) || ', MN' "
    "WHEN p_partkey % 8 = 2 THEN 'Collapsed (' || CAST(p_partkey + 2 AS STRING) || ') 06/15' "
    "WHEN p_partkey % 8 = 3 THEN 'No PORT Code (' || CAST(p_partkey AS STRING) || ')' "
    "WHEN p_partkey % 8 = 4 THEN 'INT''L ' || upper(p_name) || ', CA (BPS)' "
    "WHEN p_partkey % 8 = 5 THEN upper(p_name) || ', CO #ARPT' "
    "WHEN p_partkey % 8 = 6 THEN upper(p_name) || ', NM' "
    "ELSE upper(p_name) || ', FRANCE' END"
)
COUNTRY_LABEL = (
    "CASE WHEN p_partkey IN (311, 741) THEN 'Collapsed elsewhere (should not show)' "
    "WHEN p_partkey % 9 = 0 THEN 'INVALID: ' || upper(p_brand) "
    "WHEN p_partkey % 9 = 1 THEN 'No Country Code (' || CAST(p_partkey AS STRING) || ')' "
    "ELSE upper(p_name) END"
)
STATE_CODE = f"substr('{STATES}', CAST(1 + 2 * n_nationkey AS INT), 2)"
DICTIONARY = (
    ("part", "i94prtl", "CAST(p_partkey AS STRING)", PORT_LABEL),
    ("part", "i94cntyl", "CAST(p_partkey AS STRING)", COUNTRY_LABEL),
    ("nation", "i94addrl", STATE_CODE, "n_name"),
    ("region", "i94model", "CAST(r_regionkey AS STRING)", "r_name"),
)
CODES_SQL = " UNION ALL ".join(
    f"SELECT '{fmt}' AS fmt, {code} AS code, {label} AS label FROM {table}"
    for table, fmt, code, label in DICTIONARY
)


def label_texts(spark, sf_dir):
    """Dictionary texts written from the tables: a comment, then one block an entry."""
    result = None
    for table, fmt, code, label in DICTIONARY:
        number = fmt in ("i94cntyl", "i94model")
        entry = F.concat(
            F.lit("/* the codes of 'x' = 'y' */\n"),
            F.lit(f"  value {'' if number else '$'}{fmt}\n   "),
            F.expr(code) if number else F.concat(F.lit("'"), F.expr(code), F.lit(" '\t")),
            F.lit("=\t'"),
            F.replace(F.expr(label), F.lit("'"), F.lit("''")),
            F.lit("    '\n;\n"),
        )
        part = load(spark, sf_dir, table).select(entry.alias("value"))
        result = part if result is None else result.unionByName(part)
    return result


def label_blocks(spark, sf_dir, most=500):
    """The same dictionary as blocks of up to ``most`` entries, a text each."""
    result = None
    for table, fmt, code, label in DICTIONARY:
        number = fmt in ("i94cntyl", "i94model")
        line = F.concat(
            F.lit("   "), F.expr(code) if number else F.concat(F.lit("'"), F.expr(code), F.lit(" '\t")),
            F.lit(" =  '"), F.replace(F.expr(label), F.lit("'"), F.lit("''")), F.lit("'\n"))
        block = F.concat(
            F.lit(f"/* 'old' = 'label' */\nvalue {'' if number else '$'}{fmt}\n"),
            F.array_join(F.sort_array(F.collect_list(line)), ""), F.lit(";\n"))
        part = load(spark, sf_dir, table).groupBy(
            F.floor(F.col(f"{table[0]}_{table}key") / most).alias("block")).agg(block.alias("value"))
        part = part.select("value")
        result = part if result is None else result.unionByName(part)
    return result


def codes(spark, sf_dir):
    return parse_labels(label_texts(spark, sf_dir))
