"""A training corpus in five stages, each a DataFrame over all that the one before kept."""

from pyspark.sql import functions as F

from landfall.functions.names import fresh
from landfall.llm import decontam, langid, mixing, neardup, pii
from landfall.llm.common import sized, stored
from landfall.session import scratch_dir

ORACLE_SQL = None


def language_id(spark, docs, sf_dir):
    """Documents with a language; texts without letters, and NULL texts, go."""
    names = [fresh(n, docs) for n in ("lang_pred", "score", "lettered")]
    tagged = langid.predict(spark, docs, langid.fit(spark, docs), names=names)
    return tagged.where(F.col(names[2])).select(*docs.columns)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near-duplicates: the one with the smallest doc_id.

    Rows are told apart by a number of their own, so also rows without doc_id, or with one that
    repeats, are linked, and exactly one row of a group stays. Rows of no group, and without words, stay.
    """
    row = fresh("row", docs)
    rows = stored(spark, docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    linked = neardup.link_documents(spark, rows.select(F.col(row).alias("doc_id"), "text"))
    linked = stored(spark, linked.select(F.col("doc_id").alias("linked"), "component_id"), "linked")
    groups = linked.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id")
    members = stored(spark, linked.join(sized(stored(spark, groups, "groups"), 16), "component_id"), "members")
    ids = rows.select(F.col(row).alias("linked"), F.col("doc_id").alias("id"))
    members = stored(spark, ids.join(sized(members, 24), "linked"), "member-ids")
    first = members.groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "linked"))["linked"].alias("linked"))
    gone = members.select("linked").join(first, "linked", "left_anti")
    gone = stored(spark, gone.withColumnRenamed("linked", fresh("gone", rows)), "near-duplicates")
    return rows.join(sized(gone, 16), F.col(row) == F.col(gone.columns[0]), "left_anti").select(*docs.columns)


def decontaminate(spark, docs, sf_dir):
    """Documents that do not repeat the benchmark, judged by their texts."""
    return decontam.clean_documents(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark, docs, sf_dir):
    """All documents, with personal data replaced by its kind."""
    return pii.redact(spark, docs)


def mix_sources(spark, docs, sf_dir):
    """The mix: the whole document for every copy taken, with copy, size and the source's target."""
    return mixing.emit(mixing.mix(spark, docs, keep=None)).select(
        *docs.columns, "copy", "size", "source_size", "target")


STAGES = [
    ("language ID", language_id),
    ("near-dedup", near_dedup),
    ("decontamination", decontaminate),
    ("personal data", personal_data),
    ("mixing", mix_sources),
]


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
