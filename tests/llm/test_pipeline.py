"""The pipeline stage by stage against plain decisions on its own input."""

from pyspark.sql import functions as F

import corpus_pipeline
from landfall.llm import decontam, neardup, pii

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    lettered = {r["doc_id"] for r in docs.collect() if r["text"] and any(map(str.isalpha, r["text"]))}
    (_, language), (_, near), (_, clean), (_, masked), (_, mix) = corpus_pipeline.STAGES
    one = language(spark, docs, SF).cache()
    assert {r["doc_id"] for r in one.collect()} == lettered and one.columns == columns
    two = near(spark, one, SF).cache()
    linked = neardup.link_documents(spark, one)
    assert {r[0] for r in two.select("doc_id").collect()} == {r[0] for r in linked.where("kept").select("doc_id").collect()}
    three = clean(spark, two, SF).cache()
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    bad = {r[0] for r in decontam.decontaminate(spark, two, items).where("contaminated").select("doc_id").collect()}
    assert {r["doc_id"] for r in three.collect()} == {r["doc_id"] for r in two.collect()} - bad
    four = masked(spark, three, SF).cache()
    assert four.columns == columns and four.count() == three.count()
    assert all(not pii.base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in four.collect())
    five = mix(spark, four, SF)
    assert five.agg(F.max("copy")).first()[0] <= 2
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(whole.collect()) == sorted(five.collect())


def test_the_mix_holds_whole_documents(spark):
    """Also those that cannot be told apart by doc_id: every row comes as often as it has copies."""
    rows = [(None, "a b c", "x", 5), (None, "d e", "x", 3), (7, "f g h i", "y", 7), (7, "j", "y", 1),
            (8, None, None, 0), (9, "k l", None, 3)] + [(i, f"word {i}", "xy"[i % 2], 7) for i in range(20, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    assert mixed.columns == [*docs.columns, "copy", "size", "source_size", "target"]
    got = sorted(map(str, mixed.select(*docs.columns).collect()))
    assert len(set(got)) > 20
    taken = {(r["doc_id"], r["source"], r["size"]): r["copies"] for r in corpus_pipeline.mixing.mix(spark, docs).collect()}
    want = [r for r in docs.collect() for _ in range(taken[r["doc_id"], r["source"], len((r["text"] or "").split())])]
    assert got == sorted(map(str, want))
