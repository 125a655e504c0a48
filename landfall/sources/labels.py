"""Code dictionaries: ``value`` blocks of ``code = 'label'`` entries, parsed to rows."""

from pyspark.sql import functions as F

# The syntax of a dictionary file. Inside a quoted text, a doubled
# quote stands for one quote.
COMMENT = r"(?s)/\*.*?\*/"
BLOCK_START = r"(?mi)^\s*value\s+"
FORMAT_NAME = r"^\$?(\w+)"
QUOTED = r"'[^']*+(?:''[^']*+)*+'"
ENTRY = rf"({QUOTED}|\d+)\s*=\s*({QUOTED})"


def _unquote(column):
    inner = F.regexp_replace(column, r"^'|'$", "")
    return F.replace(inner, F.lit("''"), F.lit("'"))


def parse_labels(texts, column="value"):
    """(fmt, raw_code, code, label) of every entry; code and label without outer blanks."""
    blocks = F.split(F.regexp_replace(F.col(column), COMMENT, ""), BLOCK_START)
    entries = (
        texts.select(F.explode(F.slice(blocks, 2, F.size(blocks))).alias("block"))
        .select(
            F.regexp_extract("block", FORMAT_NAME, 1).alias("fmt"),
            F.explode(F.arrays_zip(
                F.regexp_extract_all("block", F.lit(ENTRY), F.lit(1)).alias("code"),
                F.regexp_extract_all("block", F.lit(ENTRY), F.lit(2)).alias("label"),
            )).alias("entry"),
        )
    )
    raw_code = _unquote(F.col("entry.code"))
    return entries.select(
        "fmt",
        raw_code.alias("raw_code"),
        F.trim(raw_code).alias("code"),
        F.trim(_unquote(F.col("entry.label"))).alias("label"),
    )


def read_labels(spark, path):
    """Each file is one text, so no order of lines is assumed."""
    return parse_labels(spark.read.text(path, wholetext=True))
