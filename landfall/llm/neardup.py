"""Near-duplicates by bottom-k sketches from one hash function.

Every document is the set of its five-word shingles. One 63-bit hash orders all shingles;
the ``K`` smallest of a set are its sketch. Of the values in a union's bottom k, a share equal
to the Jaccard similarity lies in both sketches, so two sets at or above the threshold share
many sketch values. Inverted lists of these values give candidates, the union sketch drops most
false ones, and full sets decide.

Hot lists. A value's list is entered only by documents for which the value is among their
rarest: sketches that share at least ``LEAST`` values meet in one of their ``K - LEAST + 1``
rarest (prefix filter), so lines common to many documents open no list. Copies with equal sets
are one node from the start. In a list, all compare with its most typical node, the one with the
most common values; after that only nodes not yet joined to the same node are compared with each
other, and of these only pairs that can reach the threshold by the shingles they share with anyone.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from landfall.llm.common import sized, slices, stored

SHINGLE = 5
K = 48
#: Two sets of similarity 0.75 share fewer of a union's 48 smallest values with a chance of about 1e-9.
LEAST = 17
PERCENT = 75
FEW = 10
CACHE_WORDS = 100_000
PIECE = 1 << 22
_FACTORS = [np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class _WordHash(dict):
    def __missing__(self, word):
        if len(self) > CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _words(text):
    """Words of the ASCII-lower-cased bytes, piece by piece, cut only at white space."""
    data = text.encode("utf-8", "surrogatepass").lower()
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[at:end].split()
        at = end


def _mixed(h):
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h >> np.uint64(1)


def shingle_set(text, cache, width=SHINGLE):
    """Sorted distinct 63-bit hashes of the word shingles; empty for no text or no words."""
    if not text:
        return np.empty(0, np.int64)
    parts = [np.fromiter(map(cache.__getitem__, w), np.uint64, len(w)) for w in _words(text)]
    words = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    n = len(words)
    if not n:
        return np.empty(0, np.int64)
    span = min(n, width)
    total = np.full(n - span + 1, span, np.uint64)
    for i in range(span):
        total += (words[i:n - span + 1 + i] ^ np.uint64(i + 1)) * _FACTORS[i % 5]
        total = (total << np.uint64(7)) | (total >> np.uint64(57))
    return np.unique(_mixed(total)).astype(np.int64)


def _lists(arrays):
    ends = np.cumsum([0, *(len(a) for a in arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int64)))


def _sketches(batches):
    cache = _WordHash()
    for batch in slices(batches):
        sets = [shingle_set(t, cache) for t in batch.column("text").to_pylist()]
        prints = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        halves = np.frombuffer(b"".join(prints), ">i8").reshape(-1, 2).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array(halves[:, 0]), pa.array(halves[:, 1]), _lists([s[:K] for s in sets])],
            names=["doc_id", "n", "f1", "f2", "sketch"],
        )


def _full_sets(batches):
    cache = _WordHash()
    for batch in slices(batches, 64):
        sets = [shingle_set(t, cache) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("node"), _lists(sets)], names=["node", "items"])


def _prefix_length():
    """How many of its rarest sketch values a set of n shingles enters into the index.

    Below 36 shingles every possible partner has its whole set as sketch, and the overlap is at
    least 75 % of the set; above, it is LEAST.
    """
    small = F.col("n") - F.ceil(F.col("n") * F.lit(PERCENT / 100)) + 1
    return F.when(F.col("n") < K * PERCENT // 100, small).otherwise(F.least("n", F.lit(K)) - LEAST + 1)


def _inverted_lists(spark, nodes):
    """(v, node, n, typical): the lists of retained values that hold at least two nodes."""
    values = nodes.select("node", "n", F.explode("sketch").alias("v"))
    common = values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    common = stored(spark, common, "common")
    ranked = (
        values.join(common, "v").groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("shared"))
        .withColumn("typical", F.aggregate("shared", F.lit(0).cast("long"), lambda t, x: t + x["df"]))
        .withColumn("room", _prefix_length() - (F.least("n", F.lit(K)) - F.size("shared")))
        .where("room > 0")
        .select("node", "n", "typical", F.explode(F.expr("slice(shared, 1, cast(room as int))")).alias("s"))
    )
    return stored(spark, ranked.select(F.col("s.v").alias("v"), "node", "n", "typical"), "lists")


def _near_sizes(a, b):
    return (100 * F.least(a, b)) >= (PERCENT * F.greatest(a, b))


def _sets_of(spark, docs, needed, name):
    """(node, items): the full shingle sets of the nodes ``needed``."""
    needed = stored(spark, needed, f"{name}-needed")
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(
        sized(needed, 16), F.col("node") == F.col("needed"), "left_semi")
    return stored(spark, texts.mapInArrow(_full_sets, "node long, items array<long>"), name)


def _rest_pairs(spark, docs, open_):
    """Pairs of nodes of ``open_`` (v, node, n, at) in different places ``at`` that may be similar.

    A shingle that at most ``FEW`` of the nodes have is rare among them. Pairs that share a rare
    one come from the rare shingles' lists, which are short. All other pairs share common shingles
    only, so the smaller count of these bounds their similarity, whatever their sketches say; copies
    edited in many places, and texts that share only a passage, are ruled out by it alone.
    """
    nodes = stored(spark, open_.select("node", "n", "at").distinct(), "open-nodes")
    items = _sets_of(spark, docs, nodes.select(F.col("node").alias("needed")), "open-sets")
    items = items.select("node", F.explode("items").alias("item"))
    counts = items.groupBy("item").agg(F.min("node").alias("node"), F.count("*").alias("c"))
    counts = stored(spark, counts.where(F.col("c") <= FEW), "rare")
    rare = stored(spark, items.join(counts.where("c > 1").select("item"), "item"), "rare-lists")
    alone = counts.where("c = 1").groupBy("node").agg(F.count("*").alias("u"))
    few = rare.groupBy("node").agg(F.count("*").alias("f"))
    nodes = stored(spark, nodes.join(alone, "node", "left").join(few, "node", "left").select(
        "node", "n", "at", (F.col("n") - F.coalesce("u", F.lit(0))).alias("any"),
        (F.col("n") - F.coalesce("u", F.lit(0)) - F.coalesce("f", F.lit(0))).alias("common")), "bounds")

    def able(lists, bound):
        return lists.join(nodes.select("node", "n", "at", F.col(bound).alias("x")), "node").where(
            100 * F.col("x") >= PERCENT * F.col("n"))

    def meeting(rows, key):
        one = [F.col(c).alias(f"{c}_1") for c in rows.columns if c != key]
        two = [F.col(c).alias(f"{c}_2") for c in rows.columns if c != key]
        most = F.least("x_1", "x_2")
        return rows.select(key, *one).join(rows.select(key, *two), key).where(
            (F.col("node_1") < F.col("node_2")) & (F.col("at_1") != F.col("at_2"))
            & (100 * most >= PERCENT * (F.col("n_1") + F.col("n_2") - most)))

    # Common shingles: hot lists, so a pair is taken only from the first list that both are in.
    owned = able(open_.select("v", "node"), "common").groupBy("node", "n", "at", "x").agg(
        F.sort_array(F.collect_set("v")).alias("all"))
    owned = stored(spark, owned, "owned")
    hot = stored(spark, owned.select(F.explode("all").alias("v"), *owned.columns), "meeting")
    hot = meeting(hot, "v").where(F.array_intersect("all_1", "all_2")[0] == F.col("v"))
    # Rare shingles: lists of at most FEW nodes.
    short = meeting(stored(spark, able(rare, "any"), "meeting-rare"), "item")
    pairs = hot.select("node_1", "node_2").union(short.select("node_1", "node_2"))
    return pairs.distinct().toDF("a", "b")


def _confirmed(spark, docs, nodes, pairs):
    """Those (a, b) of ``pairs`` whose full shingle sets reach the threshold."""
    def sketch(name):
        return nodes.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"),
                            F.col("sketch").alias(f"s_{name}"))

    drawn = pairs.join(sketch("a"), "a").join(sketch("b"), "b")
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, K)
    drawn = drawn.withColumn("u", union).withColumn(
        "both", F.size(F.array_intersect(F.array_intersect("u", "s_a"), "s_b")))
    drawn = stored(spark, drawn.where(
        F.when(F.size("u") < K, 100 * F.col("both") >= PERCENT * F.size("u"))
        .otherwise(F.col("both") >= LEAST)
    ).select("a", "b", "n_a", "n_b"), "estimated")
    sets = _sets_of(spark, docs, drawn.select(F.explode(F.array("a", "b")).alias("needed")).distinct(), "sets")
    both = (
        drawn.join(sets.toDF("a", "i_a"), "a").join(sets.toDF("b", "i_b"), "b")
        .withColumn("both", F.size(F.array_intersect("i_a", "i_b")))
        .where(100 * F.col("both") >= PERCENT * (F.col("n_a") + F.col("n_b") - F.col("both")))
    )
    return stored(spark, both.select("a", "b").distinct(), "links")


def components(spark, links):
    """(node, root) for every node of ``links`` (a, b): root is the smallest reachable node.

    Alternates large-star and small-star steps: every step keeps the components and the number
    of steps grows with the logarithm of the longest chain. Minima are aggregated and written
    before they meet the edges again, so a hub is pre-aggregated and its join can be split.
    """
    edges = stored(spark, links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = stored(spark, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(spark, large.distinct(), "large-star")
        least = stored(spark, large.groupBy("u").agg(F.min("v").alias("m")), "small")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = stored(spark, small.union(least).distinct(), "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.toDF("node", "root")
        seen = now


def link_documents(spark, docs):
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Documents whose sets have 100 * intersection >= 75 * union are linked; component_id is the
    smallest doc_id reachable and kept marks it. Texts without words, and NULL, have no shingles
    and stand alone. doc_id should be unique: repeated rows each get a row with the same result.
    Rows without doc_id link to nothing, have component_id NULL and are kept. An empty table
    gives no rows. Further columns of ``docs`` play no part.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = stored(spark, docs.mapInArrow(
        _sketches, "doc_id long, n long, f1 long, f2 long, sketch array<long>"), "sketches")
    able = sketches.where("n > 0 and doc_id is not null")
    copies = stored(spark, able.groupBy("f1", "f2", "n").agg(
        F.min("doc_id").alias("node"), F.count("*").alias("c")).where("c > 1").drop("c"), "copies")
    classed = stored(spark, able.join(copies, ["f1", "f2", "n"], "left").select(
        "doc_id", F.coalesce("node", "doc_id").alias("node")).where("doc_id <> node"), "members")
    nodes = able.join(sized(classed.select("doc_id"), 16), "doc_id", "left_anti").select(
        F.col("doc_id").alias("node"), "n", "sketch")
    nodes = stored(spark, nodes.dropDuplicates(["node"]), "nodes")

    lists = _inverted_lists(spark, nodes)
    first = stored(spark, lists.groupBy("v").agg(
        F.max(F.struct("typical", -F.col("node"), "n")).alias("f")).select(
        "v", (-F.col("f.col2")).alias("a"), F.col("f.n").alias("n_a")), "first")
    tried = stored(spark, lists.join(first, "v").where(
        (F.col("a") != F.col("node")) & _near_sizes(F.col("n"), F.col("n_a"))
    ).select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct(), "tried")
    links = _confirmed(spark, docs, nodes, tried)

    joined = components(spark, links).withColumnRenamed("root", "at")
    placed = lists.join(joined, "node", "left").withColumn("at", F.coalesce("at", "node"))
    placed = stored(spark, placed.select("v", "node", "n", "at"), "placed")
    mixed = stored(spark, placed.groupBy("v").agg(
        F.min("at").alias("lo"), F.max("at").alias("hi")).where("lo < hi").select("v"), "mixed")
    open_ = stored(spark, placed.join(mixed, "v"), "open")
    rest = _rest_pairs(spark, docs, open_).join(tried, ["a", "b"], "left_anti")
    links = links.union(_confirmed(spark, docs, nodes, stored(spark, rest, "rest")))

    roots = components(spark, links)
    members = classed.join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("root"))
    placed = stored(spark, members.union(roots.select("node", "root")).distinct(), "placed-all")
    known = placed.toDF("known", "root")
    return sketches.join(known, F.col("doc_id") == F.col("known"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"),
        F.coalesce(F.col("root") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
