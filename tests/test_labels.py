import pytest
from pyspark.sql import functions as F

from landfall import schemas
from landfall.plans import decode
from landfall.sources.labels import read_labels

# A dictionary of our own: blanks around codes and labels, tabs, doubled quotes,
# comments with quoted text, entries that end the block on their own or on the next line.
SAMPLE = """libname library 'somewhere' ;
proc format library=library ;

/* the countries; value 'x' = 'not an entry' */
  value i94cntyl
   1 =  'FREEDONIA (A, B; and C)'
   0  =  'INVALID: NOWHERE'
   311 =  'Collapsed Tanzania (should not show)'
   741 =  'Collapsed Curacao (should not show)'  
   54 =  'No Country Code (54)' ;

  value $i94prtl
\t'AAA'\t=\t'ALPHA, AK             '
\t'INT'\t=\t'INT''L PORT, MN      '
\t'''Q'\t=\t'QUOTED'
\t'CP '\t=\t'No PORT Code (CP)'
\t'IWA'\t=\t'INVALID - FIELD, JAPAN'
\t'GTF'\t=\t'Collapsed into INT, MN'
\t'FRG' \t=\t'Collapsed (AAA) 06/15'
\t'BPS'\t=\t'BRAVO, TX (BPS)'
\t'ARP'\t=\t'CHARLIE FIELD, DELTA, VA #ARPT'
\t'MXX'\t=\t'ECHO, MX'
\t'FOR'\t=\t'FOXTROT #ARPT, GABON'
\t'DCC'\t=\t'GOLF DC'
;

value i94model
\t1 = 'Air'
\t9 = 'Not reported' ;
VALUE i94addrl
\t'AK'='ALASKA'
\t'MN'='MINNESOTA'
\t'TX'='TEXAS'
\t'VA'='VIRGINIA'
\t'DC'='DISTRICT' 
\t'99'='All Other Codes' ;

/* visa: 1 = Business */
run ;
"""


@pytest.fixture(scope="module")
def labels(spark, tmp_path_factory):
    file = tmp_path_factory.mktemp("labels") / "labels.txt"
    file.write_text(SAMPLE)
    return read_labels(spark, str(file)).cache()


def test_every_entry_is_parsed(labels):
    assert [(f.name, f.dataType) for f in labels.schema] == [(f.name, f.dataType) for f in schemas.CODE_LABELS]
    counts = {r.fmt: r["count"] for r in labels.groupBy("fmt").count().collect()}
    assert counts == {"i94cntyl": 5, "i94prtl": 12, "i94model": 2, "i94addrl": 6}
    found = {(r.fmt, r.raw_code): (r.code, r.label) for r in labels.collect()}
    assert found["i94cntyl", "1"] == ("1", "FREEDONIA (A, B; and C)")
    assert found["i94prtl", "AAA"] == ("AAA", "ALPHA, AK")
    assert found["i94prtl", "INT"] == ("INT", "INT'L PORT, MN")
    assert found["i94prtl", "'Q"] == ("'Q", "QUOTED")
    assert found["i94prtl", "CP "] == ("CP", "No PORT Code (CP)")
    assert found["i94addrl", "99"] == ("99", "All Other Codes")


def test_several_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("value a\n 1 = 'x' ;")
    (tmp_path / "b.txt").write_text("value b\n 2 = 'y' ;")
    (tmp_path / "c.txt").write_text("no block here")
    assert {(r.fmt, r.code) for r in read_labels(spark, str(tmp_path)).collect()} == {("a", "1"), ("b", "2")}


def test_decode_keeps_every_row(spark, labels, rows):
    df = spark.createDataFrame([(1.0,), (54.0,), (7.0,), (1.5,), (None,), (float("nan"),)], "c double")
    assert rows(decode.decode(df, labels, "i94cntyl", "c", "country")) == sorted([
        (1.0, "FREEDONIA (A, B; and C)"), (54.0, "No Country Code (54)"), (7.0, None), (1.5, None),
        (None, None), ("nan", None)], key=repr)


def test_repeated_dictionary_entries_do_not_multiply_rows(spark, labels):
    df = spark.createDataFrame([("AAA",), ("CP",), ("CP ",)], "p string")
    doubled = labels.unionByName(labels)
    found = decode.decode(df, doubled, "i94prtl", "p", "port").collect()
    assert sorted(r.port for r in found) == ["ALPHA, AK", "No PORT Code (CP)", "No PORT Code (CP)"]


def test_states(spark, labels):
    df = spark.createDataFrame([("AK",), ("XX",), (None,), ("99",)], "i94addr string")
    found = {r.i94addr: r.state_code for r in decode.normalise_state(df, labels).collect()}
    assert found == {"AK": "AK", "XX": "99", None: "99", "99": "99"}


def test_visa_and_mode(spark, labels):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 9.0), (3.0, None), (4.0, 5.0), (None, float("nan"))],
                               "i94visa double, i94mode double")
    visa = {r.i94visa: r.visa_category for r in decode.visa_category(df).collect()}
    assert visa == {1.0: "Business", 2.0: "Pleasure", 3.0: "Student", 4.0: None, None: None}
    modes = [r.travel_mode for r in decode.travel_mode(df, labels).orderBy("i94visa").collect()]
    assert modes == ["Missing", "Air", "Not reported", "Missing", None]


def test_classes(labels):
    found = {r.code: r.c for r in labels.filter("fmt IN ('i94prtl', 'i94cntyl')").select(
        "code", decode.label_class(F.col("label")).alias("c")).collect()}
    assert {k for k, v in found.items() if v == "invalid"} == {"0", "IWA"}
    assert {k for k, v in found.items() if v == "collapsed"} == {"311", "741", "GTF", "FRG"}
    assert {k for k, v in found.items() if v == "no_code"} == {"54", "CP"}


def test_collapsed_codes(spark, labels):
    ports = spark.createDataFrame([("GTF",), ("FRG",), ("AAA",), ("none",), (None,)], "p string")
    found = {r.p: r.t for r in decode.remap_collapsed(ports, labels, "i94prtl", "p", "t").collect()}
    assert found == {"GTF": "INT", "FRG": "AAA", "AAA": "AAA", "none": "none", None: None}
    countries = spark.createDataFrame([(311.0,), (741.0,), (1.0,)], "c double")
    found = {r.c: r.t for r in decode.remap_collapsed(countries, labels, "i94cntyl", "c", "t").collect()}
    assert found == {311.0: "353", 741.0: "721", 1.0: "1"}


def test_port_places(labels):
    found = {r.code: (r.city, r.state) for r in decode.port_places(labels).collect()}
    assert found == {
        "AAA": ("ALPHA", "AK"), "INT": ("INT'L PORT", "MN"), "'Q": ("QUOTED", None),
        "BPS": ("BRAVO", "TX"), "ARP": ("CHARLIE FIELD, DELTA", "VA"), "MXX": ("ECHO, MX", None),
        "FOR": ("FOXTROT #ARPT, GABON", None), "DCC": ("GOLF", "DC"),
    }
