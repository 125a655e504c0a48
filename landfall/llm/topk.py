"""Exact top-k by inner product: norm-bucketed retrieval.

Vectors are dealt into buckets of like length and bounded size. A query's k-th best score among
the longest vectors is a lower bound of its final k-th score; divided by the two lengths it is
the local cosine a bucket must offer. By that threshold a bucket is skipped, cut by length, or
cut by coordinates, and the products of what is left are taken exactly.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from landfall.llm.common import stored

K = 20
BUCKET = 4096
QUERIES = 512
SEEDS = 2048
#: Below this local cosine the coordinates of unit vectors bound too little to be worth a look.
COORDINATE_COSINE = 0.6
FOCUS = 4
EXACT = float(1 << 52)
BLOCK = "dim int, longest double, n int, ids binary, keys binary, data binary, norms binary"


def _block(dim, rows):
    rows.sort(key=lambda r: (-r[3], r[0]))
    return (dim, rows[0][3], len(rows), np.array([r[0] for r in rows], np.int64).tobytes(),
            np.array([r[1] for r in rows], np.int64).tobytes(),
            np.array([r[2] for r in rows], np.int64).tobytes(), np.array([r[3] for r in rows]).tobytes())


def _blocks(size):
    """Rows (vec_id, key, v, norm) to blocks of at most ``size`` vectors of one dimension."""
    def run(batches):
        open_ = {}
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("vec_id", "key", "v", "norm"))
            for row in zip(*columns):
                rows = open_.setdefault(len(row[2]), [])
                rows.append(row)
                if len(rows) == size or sum(map(len, open_.values())) >= 4 * size:
                    dim = max(open_, key=lambda d: len(open_[d]))
                    yield _batch([_block(dim, open_.pop(dim))])
        for dim, rows in open_.items():
            yield _batch([_block(dim, rows)])

    return run


def _batch(blocks):
    kinds = (pa.int32(), pa.float64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    names = ("dim", "longest", "n", "ids", "keys", "data", "norms")
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*blocks), kinds)], names=names)


def _array(row, name, kind=np.int64):
    return np.frombuffer(row[name], kind)


def _products(points, query, bound):
    if bound < EXACT:
        return (points @ query.astype(np.float64)).astype(np.int64)
    return points.astype(np.int64) @ query


def _best(scores, ids, k):
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]


def _by_coordinates(units, query, cosine):
    """Rows of ``units`` whose focus coordinates allow ``cosine`` with the unit vector ``query``."""
    reach = np.arccos(min(1.0, cosine)) + 1e-9
    keep = None
    for f in np.argsort(-np.abs(query))[:FOCUS]:
        angle = np.arccos(np.clip(query[f], -1, 1))
        low = np.cos(min(np.pi, angle + reach)) - 1e-9
        high = np.cos(max(0.0, angle - reach)) + 1e-9
        x = units[:, f] if keep is None else units[keep, f]
        inside = np.flatnonzero((x >= low) & (x <= high))
        keep = inside if keep is None else keep[inside]
    return keep


def search_block(queries, points, thresholds, k):
    """(query position, point position, score) of candidates that may be among the best k.

    ``queries`` and ``points`` are dicts with ids, data (int64 matrix), norms, longest first. Every
    point of the bucket that belongs to a query's best k in it and reaches the query's threshold
    is returned.
    """
    data = points["data"].astype(np.float64)
    norms, longest = points["norms"], points["norms"][0]
    units = None
    out = []
    for i in range(len(queries["ids"])):
        q, length, least = queries["data"][i], queries["norms"][i], thresholds[i]
        cosine = least / (length * longest) if length * longest > 0 else -np.inf
        if least > 0 and cosine > 1 + 1e-9 or least > 0 and length == 0:
            continue
        if cosine < COORDINATE_COSINE:
            # Length pruning: points are ordered by length, so the long enough ones are a prefix.
            m = len(norms) if least <= 0 else np.searchsorted(-norms, -(least / length) * (1 - 1e-9), side="right")
            near = slice(0, m)
        else:
            if units is None:
                units = data / np.where(norms > 0, norms, 1)[:, None]
            near = _by_coordinates(units, q / length, cosine)
        scores = _products(data[near], q, length * longest)
        ids = points["ids"][near]
        open_ = np.flatnonzero((scores >= least) & (ids != queries["ids"][i]))
        if len(open_):
            best = open_[_best(scores[open_], ids[open_], k)]
            at = best if isinstance(near, slice) else near[best]
            out.append((np.full(len(best), i), at, scores[best]))
    if not out:
        return np.empty(0, int), np.empty(0, int), np.empty(0, np.int64)
    return tuple(map(np.concatenate, zip(*out)))


def quantised(embeddings):
    """vec_id, key (hash of the vector), v (floor(64 * x)) and norm of the vectors that take part."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    fine = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
                            & (F.size("embedding") > 0)).where(F.coalesce(fine, F.lit(False)))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.transform(x, lambda e: F.floor(64 * e).cast("long")).alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))
    return rows.select("vec_id", F.xxhash64("v").alias("key"), "v", F.sqrt(square).alias("norm"))


def top_k(spark, embeddings, is_query, k=K):
    """query_id, rank, vec_id, score: the k highest inner products of every query.

    ``is_query`` is a condition on vec_id. Candidates are all vectors with the query's number of
    components but those with its vec_id; ties go to the smaller vec_id. Vectors that are NULL or
    empty or hold NULL or non-finite components, and rows without vec_id, take no part. Repeated
    rows are candidates each; a repeated query is asked once, and different vectors under one
    vec_id are separate queries. Fewer than k candidates are all returned; empty tables give no
    rows. Scores are exact while they fit in 64 bits.

    The queries, a stated set, meet all vectors in blocks of bounded size; what is shuffled are
    blocks, and at most k rows per query and bucket that reach the query's threshold.
    """
    vectors = stored(spark, quantised(embeddings), "vectors")
    total = vectors.count()
    parts = max(1, -(-total // (4 * BUCKET)))
    dealt = vectors.repartitionByRange(parts, F.size("v"), F.desc("norm"), "vec_id")
    dealt = dealt.sortWithinPartitions(F.size("v"), F.desc("norm"), "vec_id")

    def numbered(df, name):
        return stored(spark, df.withColumn("block", F.monotonically_increasing_id()), name)

    points = numbered(dealt.mapInArrow(_blocks(BUCKET), BLOCK), "buckets")
    asked = vectors.where(is_query).dropDuplicates(["vec_id", "key"])
    asked = asked.repartition(max(1, parts // 4)).mapInArrow(_blocks(QUERIES), BLOCK)

    seeds = {}
    for r in vectors.orderBy(F.desc("norm"), "vec_id", "key").limit(SEEDS).collect():
        seeds.setdefault(len(r["v"]), []).append((r["vec_id"], r["v"], r["norm"]))
    seeds = {d: (np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.int64),
                 max(r[2] for r in rows)) for d, rows in seeds.items()}
    shared = spark.sparkContext.broadcast(seeds)

    def bounded(frames):
        for frame in frames:
            found = []
            for row in frame.to_dict("records"):
                ids, dim, n = _array(row, "ids"), row["dim"], row["n"]
                data = _array(row, "data").reshape(n, dim)
                least = np.full(n, -np.inf)
                known = shared.value.get(dim)
                if known is not None:
                    far = row["longest"] * known[2] >= EXACT
                    scores = (known[1] @ data.T if far else
                              (known[1].astype(np.float64) @ data.T.astype(np.float64)))
                    for i in range(n):
                        own = scores[known[0] != ids[i], i]
                        if len(own) >= k:
                            least[i] = np.partition(own, len(own) - k)[len(own) - k]
                found.append(least.tobytes())
            frame["least"] = found
            frame["weakest"] = [np.frombuffer(x).min() for x in found]
            yield frame

    asked = numbered(asked.mapInPandas(bounded, BLOCK + ", least binary, weakest double"), "queries")
    left = asked.select(F.col("block").alias("q"), "dim", F.col("longest").alias("lq"), "weakest")
    right = points.select(F.col("block").alias("p"), F.col("dim").alias("dp"), F.col("longest").alias("lp"))
    pairs = stored(spark, left.join(right, F.col("dim") == F.col("dp")).where(
        (F.col("weakest") <= 0) | (F.col("lq") * F.col("lp") * (1 + 1e-9) >= F.col("weakest"))
    ).select("q", "p"), "block-pairs")
    named = [F.col(c).alias(f"q_{c}") for c in ("dim", "n", "ids", "keys", "data", "norms", "least")]
    met = pairs.join(asked.select(F.col("block").alias("q"), *named), "q").join(
        points.select(F.col("block").alias("p"), "n", "ids", "data", "norms"), "p")

    def search(frames):
        for frame in frames:
            for row in frame.to_dict("records"):
                dim = row["q_dim"]
                queries = {"ids": _array(row, "q_ids"), "norms": _array(row, "q_norms", np.float64),
                           "data": _array(row, "q_data").reshape(-1, dim)}
                bucket = {"ids": _array(row, "ids"), "norms": _array(row, "norms", np.float64),
                          "data": _array(row, "data").reshape(-1, dim)}
                i, j, scores = search_block(queries, bucket, _array(row, "q_least", np.float64), k)
                yield pd.DataFrame({"query_id": queries["ids"][i], "key": _array(row, "q_keys")[i],
                                    "vec_id": bucket["ids"][j], "score": scores})

    found = met.mapInPandas(search, "query_id long, key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
