"""Toxicity: a factorization machine over hashed terms.

Terms are a text's words and their beginnings, hashed into a fixed table; every word takes part.
The machine learns a weight and a factor vector for each bucket, so that pairs of terms count beyond
the sum of the two.
"""

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import functions as F

from landfall.llm.common import remainder, sized, stored, unit_hash

#: Documented bounds: buckets of terms (the machine is 9 MB), expected training documents per class,
#: and the bytes of their terms that reach the driver.
BUCKET_BITS = 18
SAMPLE_DOCS = 8_000
SAMPLE_BYTES = 128 * 1024 * 1024
#: Weights of buckets with less evidence (likelihood ratio) of their own learn at this share of the rate,
#: so that the many chance words of a text do not stand in for those that tell the classes apart.
LEAST_EVIDENCE = 20.0
SLOW = 0.03
#: Shares of the rate at which their factors may learn. A pair of words of which neither tells anything
#: by itself needs the full rate, long texts of chance words the slow one; learning rows held back decide.
FACTOR_PACES = (SLOW, 1.0)
#: At most so many rows take part in that, a fifth of them held back.
VALIDATION_ROWS = 4_000
BEGINNINGS = (4, 5)
FACTORS = 8
EPOCHS = 12
CACHE_WORDS = 100_000
_WORD = re.compile(r"[^\W\d_]+")


def _hash(term):
    return xxhash.xxh32_intdigest(term) >> (32 - BUCKET_BITS)


class _Terms(dict):
    """word -> buckets of the word and of its beginnings"""

    def __missing__(self, word):
        if len(self) > CACHE_WORDS:
            self.clear()
        value = self[word] = (_hash("=" + word), *(
            _hash("^" + word[:n]) for n in BEGINNINGS if len(word) > n))
        return value


def terms_of(text, cache):
    """Sorted distinct term buckets of a whole text; none for NULL."""
    if not text:
        return np.empty(0, np.int64)
    found = set()
    for word in set(_WORD.findall(text.lower())):
        found.update(cache[word])
    return np.array(sorted(found), np.int64)


def _slices(batches, rows=256):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _index(batches):
    cache = _Terms()
    for batch in _slices(batches):
        at = [terms_of(t, cache).astype("<i4").tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"), pa.array(at, pa.binary())],
            names=["doc_id", "toxic", "at"])


def _ragged(arrays):
    sizes = np.array([len(a) for a in arrays], int)
    flat = np.concatenate(arrays).astype(int) if len(arrays) else np.empty(0, int)
    return flat, np.repeat(np.arange(len(arrays)), sizes)


def _added(owner, rows, n):
    """Sums of ``rows`` by their ``owner``."""
    return np.stack([np.bincount(owner, column, n) for column in rows.T], axis=1)


def _telling(arrays, labels):
    """Which buckets have evidence of their own."""
    counts = [np.bincount(np.concatenate([x for x, y in zip(arrays, labels) if y == label]),
                          minlength=1 << BUCKET_BITS) for label in (0, 1)]
    both, share = counts[0] + counts[1], labels.mean()
    evidence = np.zeros(1 << BUCKET_BITS)
    for seen, part in zip(counts, (1 - share, share)):
        evidence += 2 * seen * np.log(np.maximum(seen, 1) / np.maximum(both * part, 1e-9))
    return (evidence >= LEAST_EVIDENCE) & (both >= 3)


def _even(labels):
    """Importances that make both classes count alike."""
    toxic = labels.sum()
    return np.where(labels == 1, len(labels) / (2 * toxic), len(labels) / (2 * (len(labels) - toxic)))


def _learned(arrays, labels, factor_pace):
    telling = _telling(arrays, labels)
    return FactorizationMachine(1 << BUCKET_BITS).fit(
        arrays, labels, _even(labels), np.where(telling, 1.0, SLOW), np.where(telling, 1.0, factor_pace))


def _factor_pace(arrays, labels):
    """The one of ``FACTOR_PACES`` with the fewest errors, by class, on rows held back; the slower of equals."""
    order = np.random.default_rng(12).permutation(len(arrays))[:VALIDATION_ROWS]
    back, rest = order[::5], [i for i in order if i not in set(order[::5].tolist())]
    truth, known = labels[back], labels[rest]
    if len(set(truth.tolist())) < 2 or len(set(known.tolist())) < 2:
        return FACTOR_PACES[0]
    errors = []
    for pace in FACTOR_PACES:
        found = _learned([arrays[i] for i in rest], known, pace).raw([arrays[i] for i in back])[0] >= 0
        errors.append((found[truth == 0].mean() + 1 - found[truth == 1].mean(), pace))
    return min(errors)[1]


class FactorizationMachine:
    """score = bias + sum of weights + sum over pairs of the products of their factors"""

    def __init__(self, n, seed=11):
        rng = np.random.default_rng(seed)
        self.bias, self.weights = 0.0, np.zeros(n)
        self.factors = rng.normal(0, 0.02, (n, FACTORS))

    def raw(self, arrays):
        flat, owner = _ragged(arrays)
        linear = np.bincount(owner, self.weights[flat], len(arrays))
        factors = self.factors[flat]
        sums = _added(owner, factors, len(arrays))
        squares = np.bincount(owner, np.einsum("ij,ij->i", factors, factors), len(arrays))
        return self.bias + linear + 0.5 * ((sums ** 2).sum(axis=1) - squares), flat, owner, sums

    def fit(self, arrays, labels, importance, paces, factor_paces, epochs=EPOCHS, rate=0.1, ridge=1e-4, size=256,
            seed=11):
        """Adaptive gradient descent; ``paces`` and ``factor_paces`` are shares of the rate by bucket."""
        rng = np.random.default_rng(seed)
        past = [1.0, np.ones(len(self.weights)), np.ones(self.factors.shape)]
        place = np.zeros(len(self.weights), np.int64)
        for _ in range(epochs):
            order = rng.permutation(len(arrays))
            for at in range(0, len(order), size):
                rows = order[at:at + size]
                z, flat, owner, sums = self.raw([arrays[i] for i in rows])
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[rows]) * importance[rows] / 8
                # Only buckets that occur in the batch move.
                seen = np.flatnonzero(np.bincount(flat, minlength=len(self.weights)))
                place[seen] = np.arange(len(seen))
                local = place[flat]
                weights = np.bincount(local, error[owner], len(seen))
                factors = _added(local, error[owner, None] * (sums[owner] - self.factors[flat]), len(seen))
                weights += ridge * self.weights[seen]
                factors += ridge * self.factors[seen]
                past[0] += error.sum() ** 2
                past[1][seen] += weights ** 2
                past[2][seen] += factors ** 2
                self.bias -= rate * error.sum() / np.sqrt(past[0])
                self.weights[seen] -= rate * paces[seen] * weights / np.sqrt(past[1][seen])
                self.factors[seen] -= (rate * factor_paces[seen])[:, None] * factors / np.sqrt(past[2][seen])
        return self


def labelled_texts(spark, docs, labels):
    """text, doc_id and toxic of the documents to learn from: those whose remainder is not 0.

    A document labelled more than once takes the larger label; NULL labels teach nothing.
    """
    known = labels.select("doc_id", "toxic").where("toxic is not null and doc_id is not null").where(
        remainder("doc_id", 5) != 0)
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    known = stored(spark, known.withColumnRenamed("doc_id", "of"), "known")
    return docs.select("doc_id", "text").join(sized(known, 24), F.col("doc_id") == F.col("of")).select(
        "doc_id", "toxic", "text"), known


def fit(spark, docs, labels, sample_docs=SAMPLE_DOCS, sample_bytes=SAMPLE_BYTES):
    """The machine over all buckets, or None without labels of both classes.

    An expected ``sample_docs`` documents of each class, by a hash, reach the driver as the buckets of
    all their terms, in all at most three times as many, those of the least hash; fewer, by the same
    hash, if these take more than ``sample_bytes``.
    """
    rows, known = labelled_texts(spark, docs, labels)
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    rate = F.when(F.col("toxic") == 1, sample_docs / sizes[1]).otherwise(sample_docs / sizes[0])
    chance = unit_hash("doc_id", F.lit(9))
    sample = stored(spark, rows.where(chance < rate).mapInArrow(
        _index, "doc_id long, toxic int, at binary"), "sample")
    taken = sample.agg(F.coalesce(F.sum(F.octet_length("at") + 64), F.lit(0)).alias("b")).first()["b"]
    if taken > sample_bytes:
        sample = sample.where(chance < F.least(rate, F.lit(1.0)) * (sample_bytes / taken))
    sample = sample.orderBy(chance, "doc_id", "at").limit(3 * sample_docs).collect()
    sample.sort(key=lambda r: (r["doc_id"], bytes(r["at"])))
    truth = np.array([r["toxic"] for r in sample], float)
    if not 0 < truth.sum() < len(truth):
        return None
    arrays = [np.frombuffer(r["at"], "<i4") for r in sample]
    machine = _learned(arrays, truth, _factor_pace(arrays, truth))
    # Buckets never learned from say nothing, alone or in pairs.
    unseen = np.ones(1 << BUCKET_BITS, bool)
    unseen[np.concatenate(arrays)] = False
    machine.factors[unseen] = 0.0
    machine.weights, machine.factors = machine.weights.astype(np.float32), machine.factors.astype(np.float32)
    return machine


def score(spark, docs, labels):
    """doc_id, held_out, score and predicted for every row of ``docs``, over whole texts.

    Texts that are NULL or empty, or share no term with the learned ones, get its bias alone; without
    labels of both classes every score is 0. Rows without doc_id are not held out. Repeated rows
    get equal scores; other columns play no part.
    """
    model = fit(spark, docs, labels)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        cache = _Terms()
        for batch in _slices(batches, 512):
            scores = np.zeros(batch.num_rows)
            if shared.value:
                arrays = [terms_of(t, cache) for t in batch.column("text").to_pylist()]
                scores = 1 / (1 + np.exp(-np.clip(shared.value.raw(arrays)[0], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores)],
                names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.coalesce(remainder("doc_id", 5), F.lit(1)) == 0).alias("held_out"), "text")
    out = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
