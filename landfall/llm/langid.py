"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.names import quoted
from landfall.llm.common import remainder, slices, stored, unit_hash

BUCKET_BITS = 15
#: Languages scored together, by one matrix of at most 16 MB, and blocks of them between two writes.
BLOCK_LANGUAGES = 128
BLOCKS_AT_ONCE = 8
SAMPLE_DOCS = 10_000
#: Characters looked at together, and the numbers that scoring them may hold at a time.
PIECE = 100_000
CELLS = 1_600_000
UNKNOWN = "und"


def _letters(code):
    """Code points with everything in ASCII that is no letter set to 0."""
    plain = code < 128
    keep = ((code >= 97) & (code <= 122)) | ~plain
    return np.where(keep, code, 0).astype(np.uint32)


def _grams(code):
    """Buckets of all 1- to 3-grams that start with a letter, and the start of each."""
    first = np.flatnonzero(code)
    padded = np.concatenate([code, np.zeros(2, np.uint32)])
    a, b, c = padded[first], padded[first + 1], padded[first + 2]
    shift = np.uint32(32 - BUCKET_BITS)
    one = a * np.uint32(2654435761)
    two = (one ^ b) * np.uint32(2246822519) + np.uint32(374761393)
    three = (two ^ (c + np.uint32(77))) * np.uint32(3266489917) + np.uint32(668265263)
    return first, (one >> shift), (two >> shift), (three >> shift)


def _pieces(texts, size=PIECE):
    """Batches of at most about ``size`` characters: (code points of each part, their owners).

    A longer text is cut into several pieces, which together cover all of it.
    """
    codes, owners, room = [], [], size
    for i, text in enumerate(texts):
        if not text:
            continue
        text = text.lower()
        for at in range(0, len(text), size):
            part = text[at:at + size]
            codes.append(np.frombuffer((part + "\x00\x00").encode("utf-32-le", "surrogatepass"), np.uint32))
            owners.append(i)
            room -= len(part)
            if room <= 0:
                yield codes, owners
                codes, owners, room = [], [], size
    if codes:
        yield codes, owners


def _count(batches):
    size = 1 << BUCKET_BITS
    sums = {}
    for batch in slices(batches):
        langs = batch.column("lang").to_pylist()
        for codes, owners in _pieces(batch.column("text").to_pylist()):
            for code, i in zip(codes, owners):
                _, one, two, three = _grams(_letters(code))
                total = sums.setdefault(langs[i], np.zeros(size, np.int64))
                for gram in (one, two, three):
                    total += np.bincount(gram, minlength=size)
    for lang, total in sums.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])],
            names=["lang", "bucket", "n"],
        )


class Model(NamedTuple):
    """Sorted languages, the logarithms of their shares of the learning rows, and the counts of their
    n-grams as a table of lang, bucket, n."""

    languages: list
    priors: np.ndarray
    grams: object

    def blocks(self, size=None):
        """(languages, log-probability matrix of buckets x languages, priors), block by block."""
        size = size or BLOCK_LANGUAGES
        for at in range(0, len(self.languages), size):
            langs = self.languages[at:at + size]
            found = self.grams.where(F.col("lang").isin(langs)).toPandas()
            table = np.full((1 << BUCKET_BITS, len(langs)), 0.5)
            column = found["lang"].map({lang: i for i, lang in enumerate(langs)}).to_numpy(int)
            table[found["bucket"].to_numpy(int), column] += found["n"].to_numpy(float)
            yield langs, np.log(table / table.sum(axis=0)).astype(np.float32), self.priors[at:at + size]


def fit(spark, docs, sample_docs=SAMPLE_DOCS):
    """A ``Model`` of labelled rows.

    Learns from rows with a text and a language whose crc32(doc_id) mod 4 is not 2, from an
    expected ``sample_docs`` of them per language, chosen by a hash of the row. Any number of
    languages may occur; their names and numbers of rows reach the driver, their counts block by block.
    """
    rows = docs.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
        & (F.coalesce(remainder("doc_id", 4), F.lit(0)) != 2)
    )
    counts = sorted((r["lang"], r["count"]) for r in rows.groupBy("lang").count().collect())
    rates = spark.createDataFrame(
        [(lang, min(1.0, sample_docs / n)) for lang, n in counts], "known string, rate double"
    )
    sample = (
        rows.join(F.broadcast(rates), F.col("lang") == F.col("known"))
        .where(unit_hash("doc_id", "text", F.lit(5)) < F.col("rate")).select("lang", "text")
    )
    grams = sample.mapInArrow(_count, "lang string, bucket int, n long")
    grams = stored(spark, grams.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "grams")
    sizes = np.array([n for _, n in counts], float)
    return Model([lang for lang, _ in counts], np.log(sizes / max(sizes.sum(), 1.0)), grams)


def _has_letter(text):
    return text is not None and any(map(str.isalpha, text))


def _sums(texts, logs):
    """Log-likelihoods of whole texts (texts x languages), and how many n-grams each has."""
    languages = logs.shape[1]
    sums, grams = np.zeros((len(texts), languages)), np.zeros(len(texts))
    for codes, owners in _pieces(texts, min(PIECE, CELLS // max(1, languages))):
        code = _letters(np.concatenate(codes))
        ends = np.cumsum([len(c) for c in codes])
        first, *parts = _grams(code)
        piece = np.searchsorted(ends, first, side="right")
        starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]]) if len(piece) else []
        if not len(starts):
            continue
        owner = np.asarray(owners)[piece[starts]]
        for part in parts:
            np.add.at(sums, owner, np.add.reduceat(logs[part], starts, axis=0, dtype=np.float64))
        np.add.at(grams, owner, 3 * np.diff(np.r_[starts, len(piece)]))
    return sums, grams


def _scored(languages, logs, priors):
    """A function over batches that carries the best of these languages, and of those before, on."""
    def run(batches):
        matrix = logs.value
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            langs = batch.column("lang_pred").to_pylist()
            best = batch.column("best").to_numpy().copy()
            weight = batch.column("weight").to_numpy().copy()
            sums, grams = _sums(texts, matrix)
            sums += priors
            scale = np.sqrt(np.maximum(grams, 1))
            top = sums.argmax(axis=1)
            for i, text in enumerate(texts):
                if _has_letter(text):
                    high = max(best[i], sums[i][top[i]])
                    # Equal likelihoods go to the language first in order.
                    if sums[i][top[i]] > best[i]:
                        langs[i] = languages[top[i]]
                    before = weight[i] * np.exp((best[i] - high) / scale[i]) if weight[i] else 0.0
                    weight[i] = before + np.exp((sums[i] - high) / scale[i]).sum()
                    best[i] = high
            new = {"lang_pred": pa.array(langs, pa.string()), "best": pa.array(best), "weight": pa.array(weight)}
            for name, column in new.items():
                batch = batch.set_column(batch.schema.get_field_index(name), name, column)
            yield batch

    return run


def predict(spark, docs, model, keep=None, names=("lang_pred", "score", "lettered")):
    """``docs`` with lang_pred, score and lettered, over whole texts; ``names`` gives them other names.

    A text that is NULL or has no letter is ``und`` with score 0 and not lettered; if nothing was
    learned, every text is ``und`` with score 0. Equal likelihoods go to the language first in code-point
    order. The score is the largest softmax value of the log-likelihoods, priors included, divided by
    the root of the number of n-grams. All input columns, or those named in ``keep``, are kept.

    Languages are scored in blocks, each pass carrying the best so far on; after ``BLOCKS_AT_ONCE``
    blocks the rows are written, so that no more matrices are held at a time.
    """
    kept = [c for c in docs.columns if keep is None or c in keep]
    # The text travels once, beside the other columns, whatever these are called.
    others = {c: f"c{i}" for i, c in enumerate(kept) if c != "text"}
    held = F.struct(*[F.col(quoted(c)).alias(n) for c, n in others.items()]) if others else F.lit(None)
    rows = docs.select(
        held.alias("kept"), "text", F.lit(UNKNOWN).alias("lang_pred"),
        F.lit(float("-inf")).alias("best"), F.lit(0.0).alias("weight"))
    for i, (languages, matrix, priors) in enumerate(model.blocks()):
        if i and i % BLOCKS_AT_ONCE == 0:
            rows = stored(spark, rows, "language-blocks")
        rows = rows.mapInArrow(_scored(languages, spark.sparkContext.broadcast(matrix), priors), rows.schema)
    score = F.when(F.col("weight") > 0, 1 / F.col("weight")).otherwise(0.0)
    lettered = F.col("weight") > 0
    if not model.languages:
        lettered = F.coalesce(F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False))
    made = [F.col("lang_pred"), score, lettered]
    return rows.select(*[F.col("text") if c == "text" else F.col(f"kept.{others[c]}").alias(c) for c in kept],
                       *[c.alias(n) for c, n in zip(made, names)])


def identify(spark, docs, sample_docs=SAMPLE_DOCS):
    """doc_id, held_out, lang_pred and score for every row. NULL doc_id is not held out."""
    model = fit(spark, docs, sample_docs)
    rows = docs.select(
        "doc_id", (F.coalesce(remainder("doc_id", 4), F.lit(0)) == 2).alias("held_out"), "text"
    )
    return predict(spark, rows, model, ("doc_id", "held_out")).select("doc_id", "held_out", "lang_pred", "score")
