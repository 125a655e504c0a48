"""Audit of how far the sources of a language diverge in their words.

Arrow's compute functions cut texts into terms and count them inside every task; Spark adds the
partial counts up. A term's share in a source, against its share in another source or in the whole
language, gives its part of a triangular discrimination, (p - q)^2 / (p + q), in whole numbers.
Pairs of sources are compared in cells: a block of sources against a block, over a shard of terms.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from landfall.llm.common import sized, slices, stored

#: What stands between terms: all of ASCII but letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 10
BEST_TERMS = 10
UNIT = 1_000_000_000
#: Expected size of a cell: so many sources on each side, and so many terms. It bounds memory alone.
BLOCK_SOURCES = 256
SHARD_TERMS = 256
#: Partial counts that a task holds before it hands them on.
HELD_ROWS = 400_000


def _codes(column):
    encoded = column.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def count_terms(batch):
    """A table of lang, source, term, n (occurrences) and docs (rows that hold it) of one batch."""
    lists = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), BETWEEN)
    rows, terms = pc.list_parent_indices(lists), pc.list_flatten(lists)
    real = pc.not_equal(terms, "")
    rows, terms = rows.filter(real), terms.filter(real).dictionary_encode()
    langs, lang_names = _codes(batch.column("lang"))
    sources, source_names = _codes(batch.column("source"))
    group = pa.array(langs * len(source_names) + sources)
    per_row = pa.table({"row": rows, "term": terms.indices}).group_by(["row", "term"], use_threads=False)
    per_row = per_row.aggregate([([], "count_all")])
    counted = pa.table({
        "group": pc.take(group, per_row.column("row")), "term": per_row.column("term"),
        "n": per_row.column("count_all")}).group_by(["group", "term"], use_threads=False)
    counted = counted.aggregate([("n", "sum"), ("n", "count")])
    of = counted.column("group").to_numpy()
    return pa.table({
        "lang": lang_names.take(pa.array(of // len(source_names))),
        "source": source_names.take(pa.array(of % len(source_names))),
        "term": terms.dictionary.take(counted.column("term").combine_chunks()),
        "n": counted.column("n_sum"), "docs": counted.column("n_count")})


def _merged(tables):
    whole = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False)
    whole = whole.aggregate([("n", "sum"), ("docs", "sum")])
    return whole.rename_columns([c.removesuffix("_sum") for c in whole.column_names])


def _counts(batches):
    held, rows = [], 0
    for batch in slices(batches, 512):
        held.append(count_terms(batch))
        rows += len(held[-1])
        if rows > HELD_ROWS:
            held = [_merged(held)]
            rows = len(held[0])
            if rows > HELD_ROWS // 2:
                yield from held[0].to_batches(65_536)
                held, rows = [], 0
    if held:
        yield from _merged(held).to_batches(65_536)


def term_counts(spark, docs):
    """lang, source, term, n, docs: whole counts of every term, NULL read as the empty text."""
    texts = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    partial = texts.mapInArrow(_counts, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n, total, terms):
    """1 + floor(UNIT * (n + 2) / (total + 2 * terms)), exact for all longs."""
    return F.expr(
        f"1 + CAST({UNIT} AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(19,0)) "
        f"div CAST({total} + 2 * {terms} AS DECIMAL(19,0))")


def _shares(n, total):
    """The same over arrays, with ``total`` = total + 2 * terms, by long division in base 1000."""
    rest, out = n + 2, np.zeros(np.broadcast(n, total).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def _divergences(one, many):
    gap = many - one
    return (gap * gap // (many + one)).sum(axis=1)


def _cell(table):
    """Partial divergences of all pairs of sources of one cell.

    Rows without a term name the cell's sources, and how many kept terms its shard has: terms that
    none of the cell's sources hold differ only through the sources' totals.
    """
    named = pc.is_null(table.column("term"))
    heads, held = table.filter(named), table.filter(pc.invert(named))
    names = heads.column("source").to_pylist()
    place = {s: i for i, s in enumerate(names)}
    block = heads.column("block").to_numpy()
    total = heads.column("total").to_numpy() + 2 * heads.column("terms").to_numpy()
    terms = held.column("term").combine_chunks().dictionary_encode()
    at = np.array([place[s] for s in held.column("source").to_pylist()], np.int64)
    kept = heads.column("kept")[0].as_py() if names else 0
    if not kept:
        plain = np.ones(len(names), np.int64)  # a language without kept terms: all is 0
    else:
        plain = _shares(np.zeros(len(names), np.int64), total)
    shares = np.repeat(plain[:, None], len(terms.dictionary), axis=1)
    if len(at):
        shares[at, terms.indices.to_numpy(zero_copy_only=False)] = _shares(held.column("n").to_numpy(), total[at])
    rest = kept - len(terms.dictionary)
    same = table.column("row_block")[0].as_py() == table.column("column_block")[0].as_py()
    rows = np.flatnonzero(block == table.column("row_block")[0].as_py())
    columns = np.flatnonzero(block == table.column("column_block")[0].as_py())
    one, two, value = [], [], []
    for k, i in enumerate(rows):
        others = columns[k + 1:] if same else columns
        if len(others):
            found = _divergences(shares[i], shares[others])
            found = found + rest * _divergences(plain[i], plain[others, None])
            one += [names[i]] * len(others)
            two += [names[j] for j in others]
            value.append(found)
    lang = table.column("lang")[0].as_py()
    return pa.table({
        "lang": pa.array([lang] * len(one), pa.string()), "one": pa.array(one, pa.string()),
        "two": pa.array(two, pa.string()),
        "value": pa.array(np.concatenate(value) if value else np.empty(0, np.int64))})


def pair_divergences(spark, counts, groups):
    """lang, one, two, value: every unordered pair of sources of a language, once.

    ``counts``: lang, source, term, n of kept terms; ``groups``: lang, source, total (of its counts),
    terms (kept ones of the language). Sources are dealt into blocks and terms into shards by hashes.
    """
    sizes = groups.groupBy("lang").agg(
        F.max("terms").alias("v"), F.ceil(F.count("*") / BLOCK_SOURCES).cast("int").alias("blocks"))
    sizes = stored(spark, sizes.withColumn("shards", F.greatest(
        F.ceil(F.col("v") / SHARD_TERMS), F.lit(1)).cast("long")), "sizes")
    small = sized(sizes, F.octet_length("lang") + 64)
    shard = F.pmod(F.xxhash64("term"), F.col("shards")).alias("shard")
    placed = stored(spark, counts.join(small, "lang").select("lang", "source", "term", "n", "blocks", shard), "placed")
    shards = placed.select("lang", "shard", "term").distinct().groupBy("lang", "shard").agg(
        F.count("*").alias("kept"))
    none = sizes.where("v = 0").select("lang", F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("kept"))
    shards = stored(spark, shards.union(none), "shards")
    heads = groups.join(small, "lang").join(sized(shards, F.octet_length("lang") + 64), "lang").select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"),
        "blocks", "shard", "total", "terms", "kept")
    nothing = F.lit(None).cast("long")
    rows = heads.unionByName(placed.select(
        "*", nothing.alias("total"), nothing.alias("terms"), nothing.alias("kept")))
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    rows = rows.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "lang", "source", "term", "n", "shard", "total", "terms", "kept", "block",
        F.least("block", "other").alias("row_block"), F.greatest("block", "other").alias("column_block"))
    cells = rows.groupBy("lang", "shard", "row_block", "column_block").applyInArrow(
        _cell, "lang string, one string, two string, value long")
    return cells.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))


def audit(spark, docs, least_docs=LEAST_DOCS, best_terms=BEST_TERMS):
    """lang, source, part, item, value, rank: how every source stands apart in its language.

    Terms are runs of letters and other non-ASCII characters, A-Z lower-cased; a language keeps those
    in at least ``least_docs`` of its rows. Part ``pair`` has every other source of the language with
    the sum of all kept terms' divergences; part ``term`` the ``best_terms`` terms that a source uses
    more than its language does. Ties go to the item first in UTF-8.

    NULL in text, lang or source is the empty text; every (lang, source) that occurs counts, also
    without terms; rows are documents, so repeated rows count again. A language without kept terms has
    pairs of value 0, one with a single source has no pairs. Other columns play no part, and an empty
    table gives no rows.
    """
    docs = docs.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")])
    counts = stored(spark, term_counts(spark, docs), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    kept = stored(spark, kept.where(F.col("docs") >= least_docs).drop("docs"), "kept")
    counts = stored(spark, counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    langs = stored(spark, kept.groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total")), "langs")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    occurring = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    zero = F.lit(0).cast("long")
    groups = occurring.join(totals, ["lang", "source"], "left").join(
        sized(langs, F.octet_length("lang") + 64), "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")])
    groups = stored(spark, groups, "groups")

    pairs = stored(spark, pair_divergences(spark, counts.select("lang", "source", "term", "n"), groups), "pairs")
    both = pairs.select("lang", F.col("one").alias("source"), F.col("two").alias("item"), "value").union(
        pairs.select("lang", "two", "one", "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    both = both.withColumn("rank", F.row_number().over(order))

    small = sized(groups, F.octet_length("lang") + F.octet_length("source") + 64)
    over = counts.join(small, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q")).where("p > q")
    over = over.withColumn("value", F.expr("(p - q) * (p - q) div (p + q)"))
    best = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best_terms)

    def part(rows, name):
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part(both, "pair").union(part(best, "term"))
