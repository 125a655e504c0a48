"""The code dictionary, and decoding and normalising with it."""

from pyspark.sql import functions as F

from landfall.operators import cleaning
from landfall.plans import decode, jobs
from landfall.session import scratch_dir
from landfall.sources.labels import read_labels
from suite.inputs import ARRIVALS, CODES_SQL, codes, label_blocks
from suite.model_queries import CLEAN, RAW
from suite.registry import query

CTES = f"WITH {RAW}, {CLEAN}, codes AS ({CODES_SQL})"


def _arrivals(spark, sf_dir, *columns):
    raw = ARRIVALS.frame(spark, sf_dir)
    return jobs.clean_arrivals(raw, cleaning.ARRIVALS_BY_ID).select("cicid", *columns)


def _arrivals_with_port(spark, sf_dir):
    """Arrivals by port are taken from the raw view: the model drops the port."""
    return ARRIVALS.frame(spark, sf_dir).select("cicid", "i94port", "admnum")


def _lookup(fmt, column):
    """Left join of one format to a numeric or text code column of ``a``."""
    return f"LEFT JOIN (SELECT * FROM codes WHERE fmt = '{fmt}') {fmt} ON {fmt}.code = {column}"


def _whole(column):
    return (
        f"CASE WHEN NOT isnan({column}) AND {column} = floor({column}) "
        f"THEN CAST(CAST({column} AS BIGINT) AS VARCHAR) END"
    )


LABELS = f"""WITH codes AS ({CODES_SQL})
    SELECT fmt, CASE WHEN fmt IN ('i94prtl', 'i94addrl') THEN code || ' ' ELSE code END AS raw_code,
      code, label FROM codes"""


@query("label_dictionary", LABELS)
def label_dictionary(spark, sf_dir):
    return codes(spark, sf_dir)


@query("label_dictionary_file", LABELS)
def label_dictionary_file(spark, sf_dir):
    """The dictionary written as files with blocks of many entries, and read from them."""
    path = scratch_dir(spark, "dictionary")
    label_blocks(spark, sf_dir).write.text(path)
    return read_labels(spark, path)


@query("decode_codes", f"""{CTES}
    SELECT cicid, i94cit, i94cntyl.label AS country FROM clean a {_lookup('i94cntyl', _whole('a.i94cit'))}""")
def decode_codes(spark, sf_dir):
    arrivals = _arrivals(spark, sf_dir, "i94cit")
    return decode.decode(arrivals, codes(spark, sf_dir), decode.COUNTRY, "i94cit", "country")


@query("decode_ports", f"""{CTES}
    SELECT cicid, i94port, admnum, i94prtl.label AS port FROM raw a {_lookup('i94prtl', 'a.i94port')}""")
def decode_ports(spark, sf_dir):
    arrivals = _arrivals_with_port(spark, sf_dir)
    return decode.decode(arrivals, codes(spark, sf_dir), decode.PORT, "i94port", "port")


@query("normalise_state", f"""{CTES}
    SELECT cicid, i94addr, coalesce(i94addrl.code, '99') AS state_code
    FROM clean a {_lookup('i94addrl', 'a.i94addr')}""")
def normalise_state(spark, sf_dir):
    return decode.normalise_state(_arrivals(spark, sf_dir, "i94addr"), codes(spark, sf_dir))


@query("visa_category", f"""{CTES}
    SELECT cicid, i94visa, CASE i94visa WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure'
      WHEN 3 THEN 'Student' END AS visa_category FROM clean""")
def visa_category(spark, sf_dir):
    return decode.visa_category(_arrivals(spark, sf_dir, "i94visa"))


@query("mode_category", f"""{CTES}
    SELECT cicid, i94mode, CASE WHEN i94mode IS NULL OR isnan(i94mode) THEN 'Missing'
      ELSE i94model.label END AS travel_mode
    FROM clean a {_lookup('i94model', _whole('a.i94mode'))}""")
def mode_category(spark, sf_dir):
    return decode.travel_mode(_arrivals(spark, sf_dir, "i94mode"), codes(spark, sf_dir))


@query("code_validity", f"""WITH codes AS ({CODES_SQL})
    SELECT fmt, code, CASE WHEN label LIKE 'INVALID%' THEN 'invalid'
      WHEN label LIKE 'Collapsed %' THEN 'collapsed'
      WHEN label LIKE 'No PORT Code%' OR label LIKE 'No Country Code%' THEN 'no_code'
      ELSE 'valid' END AS class FROM codes""")
def code_validity(spark, sf_dir):
    return codes(spark, sf_dir).select(
        "fmt", "code", decode.label_class(F.col("label")).alias("class")
    )


@query("collapsed_remap", f"""{CTES}
    SELECT cicid, i94port, admnum, CASE
        WHEN label LIKE 'Collapsed into %' THEN regexp_extract(label, 'into ([^,]*),', 1)
        WHEN label LIKE 'Collapsed (%' THEN regexp_extract(label, '\\(([^)]*)\\)', 1)
        ELSE i94port END AS port
    FROM raw a {_lookup('i94prtl', 'a.i94port')}""")
def collapsed_remap(spark, sf_dir):
    arrivals = _arrivals_with_port(spark, sf_dir)
    return decode.remap_collapsed(arrivals, codes(spark, sf_dir), decode.PORT, "i94port", "port")


@query("collapsed_countries", f"""{CTES}
    SELECT cicid, i94cit, CASE i94cit WHEN 311 THEN '353' WHEN 741 THEN '721'
      ELSE {_whole('i94cit')} END AS country_code FROM clean""")
def collapsed_countries(spark, sf_dir):
    return decode.remap_collapsed(
        _arrivals(spark, sf_dir, "i94cit"), codes(spark, sf_dir), decode.COUNTRY, "i94cit", "country_code"
    )


@query("port_city_state", f"""WITH codes AS ({CODES_SQL}), ports AS (
      SELECT code, label, CASE WHEN label LIKE '% (BPS)' THEN left(label, length(label) - 6)
        WHEN label LIKE '% #ARPT' THEN left(label, length(label) - 6) ELSE label END AS name
      FROM codes WHERE fmt = 'i94prtl' AND label NOT LIKE 'INVALID%'
        AND label NOT LIKE 'Collapsed%' AND label NOT LIKE 'No PORT%'),
    split AS (SELECT *, split_part(name, ', ', 2) IN
        (SELECT code FROM codes WHERE fmt = 'i94addrl') AS listed FROM ports)
    SELECT code, label, CASE WHEN listed THEN split_part(name, ', ', 1) ELSE name END AS city,
      CASE WHEN listed THEN split_part(name, ', ', 2) END AS state FROM split""")
def port_city_state(spark, sf_dir):
    return decode.port_places(codes(spark, sf_dir))
