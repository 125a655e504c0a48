"""Mixing sources to target weights by whole copies of documents and one that a hash draws."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from landfall.llm.common import numbered, sized, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2.0
WORD = r"[^\x20\x09-\x0D]+"


def row_key(doc_id, text):
    """A text that tells rows apart by doc_id and text; NULLs read as empty."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"),
                          F.coalesce(F.md5(text.cast("binary")), F.lit(""))))


def drawn(key, number, seed):
    """A number in [0, 1) from the first 52 bits of an md5, which any SQL engine can repeat.

    ``number`` (from 0) counts rows of equal ``key``, so that these draw apart.
    """
    text = F.concat(key, F.lit(":"), number.cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def words_of(column):
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes, weights=WEIGHTS, share=SHARE, most=MOST_REPEATS):
    """Tokens to take from every source.

    ``sizes`` has a row per source: source, source_size, largest (the size of its largest
    document). Sources in code-point order, NULL last, weigh ``weights`` in turn and share
    ``share`` times all tokens. A target stops at ``most`` times its source; what is left
    goes to the others by weight until none is above. In closed form that is one level:
    target = min(cap, level * weight), found by walking sources in the order of
    cap / weight. The table has one row per source, so the window runs over a summary.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights)) + 1
    )
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    return (
        sizes.withColumn("weight", weight.cast("double"))
        .withColumn("cap", F.lit(most) * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.lit(share) * F.sum("source_size").over(whole))
        .withColumn(
            "level",
            (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / F.sum("weight").over(after),
        )
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level")))
                    .over(whole)["level"])
        .withColumn("target", F.least("cap", F.col("level") * F.col("weight")))
        .withColumn("target", F.coalesce("target", "cap"))
        .select("source", "source_size", "target",
                F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                .otherwise(0.0).alias("rate"))
    )


def mix(spark, docs, weights=WEIGHTS, share=SHARE, most=MOST_REPEATS, seed=17, keep=("doc_id", "source")):
    """Every document with the number of copies that the mix takes of it.

    Returns the columns of ``docs`` named in ``keep`` (all with None; their names must then not be
    size, source_size, target, copies or copy), size, source_size, target, copies. A document of a source
    with rate r has floor(r) copies and one more with probability r - floor(r), drawn from a hash of
    its doc_id, its text, a number among rows equal in both, and ``seed``. So reruns agree, and
    rows without doc_id, or with one that repeats, still draw one by one: every source's words come
    near its target. NULL text has size 0; NULL sources form one source, last in order; an empty
    table gives no rows. Sources are added up from word counts alone; their rates are broadcast to
    the documents (if small), so the text is not shuffled, but for rows that repeat.
    """
    kept = [c for c in docs.columns if keep is None or c in keep]
    clash = {"size", "source_size", "target", "copies", "copy"} & set(kept)
    if clash:
        raise ValueError(f"columns with names of the mix: {sorted(clash)}")
    rows = docs.select(F.struct(*kept).alias("kept"), F.col("source").alias("from"),
                       words_of(F.col("text")).alias("size"), row_key(F.col("doc_id"), F.col("text")).alias("key"))
    counted = stored(spark, rows if keep else rows.drop("kept"), "sizes")
    sizes = counted.groupBy(F.col("from").alias("source")).agg(F.sum("size").alias("source_size"))
    targets = stored(spark, source_targets(sizes, weights, share, most), "targets")
    small = sized(targets, F.coalesce(F.octet_length("source"), F.lit(0)) + 64)
    rows = _numbered_rows(spark, counted if keep else rows, counted)
    rate = F.col("of.rate")
    more = drawn(F.col("key"), F.col("number"), seed) < rate - F.floor(rate)
    copies = (F.floor(rate) + more.cast("int")).cast("int")
    return rows.join(
        small.select(F.struct("*").alias("of")), F.col("from").eqNullSafe(F.col("of.source"))
    ).select("kept.*", "size", "of.source_size", "of.target", copies.alias("copies"))


def _numbered_rows(spark, rows, counted):
    """``rows`` with number: 0, or the place among rows of the same key where a key repeats."""
    seen = F.xxhash64("key").alias("seen")
    repeated = stored(spark, counted.groupBy(seen).agg(F.count("*").alias("n")).where("n > 1").select("seen"), "repeated")
    if repeated.isEmpty():
        return rows.withColumn("number", F.lit(0).cast("long"))
    repeated, same = sized(repeated, 16), F.xxhash64("key") == F.col("seen")
    alike = numbered(spark, rows.join(repeated, same, "left_semi"), "key", "alike")
    return rows.join(repeated, same, "left_anti").withColumn("number", F.lit(0).cast("long")).unionByName(alike)


def emit(mixed):
    """One row per copy: the columns of ``mix``, and copy (from 1)."""
    copies = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies")))
    return mixed.select("*", F.explode(copies).alias("copy"))
