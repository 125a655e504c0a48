"""Alignment of two tokenizers over the same bytes.

``pandas.merge_asof``, keyed by document, finds for every token's start the token of the other side
that covers it; both directions together are all overlaps. Places where tokens of both sides end
cut a document into groups.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from landfall.llm.common import sized, stored, text_slices
from landfall.llm.tokens import PieceBpe, byte_bpe

ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "a array<int>, b array<int>, n array<int>")


class _Side:
    """Tokens of a batch in a row: ids, and byte offsets counted through all its documents."""

    def __init__(self, ids, names, sizes):
        self.counts = np.array([len(i) for i in ids], np.int64)
        self.ids = np.concatenate(ids) if ids else np.empty(0, np.int32)
        self.doc = np.repeat(np.arange(len(ids)), self.counts)
        length = sizes[self.ids]
        self.ends = np.cumsum(length)
        self.starts = self.ends - length

    def frame(self, name):
        return pd.DataFrame({"doc": self.doc, "at": self.starts, name: np.arange(len(self.ids))})


def _covering(tokens, others, name):
    """For every row of ``tokens`` the other side's token that covers its start."""
    return pd.merge_asof(tokens, others, on="at", by="doc")[name].to_numpy(np.int64)


def links(a, b):
    """Indices (into a, into b) of all pairs of tokens whose bytes overlap, each pair once."""
    left, right = a.frame("a"), b.frame("b")
    over = _covering(left, right, "b")
    under = _covering(right, left, "a")
    # A pair that starts together is found from both sides.
    new = a.starts[under] != b.starts
    return (np.concatenate([np.arange(len(over)), under[new]]),
            np.concatenate([over, np.flatnonzero(new)]))


#: What follows an id: nothing at a document's end, an id of the same side, the other side, the next group.
_MARKS = (b"", b",", b"|", b";")


def id_texts(size):
    """Every id below ``size`` in decimal with each of ``_MARKS`` behind it, padded by zero bytes."""
    numbers = np.arange(size).astype(f"S{len(str(size))}")
    return np.stack([np.char.add(numbers, mark).astype(f"S{len(str(size)) + 1}") for mark in _MARKS])


def _group_texts(a, b, cuts, n_docs, table):
    """``a1,a2|b1;a3|b2,b3`` for every document: ids of both sides, group by group."""
    group = np.concatenate([2 * np.searchsorted(cuts, a.ends), 2 * np.searchsorted(cuts, b.ends) + 1])
    ids, doc = np.concatenate([a.ids, b.ids]), np.concatenate([a.doc, b.doc])
    order = np.argsort(group, kind="stable")
    group, doc = group[order], doc[order]
    mark = np.where(np.diff(group, append=0) == 0, 1, np.where(group % 2 == 0, 2, 3))
    if len(mark):
        mark[np.append(doc[1:] != doc[:-1], True)] = 0
    texts = table[mark, ids[order]]
    ends = np.cumsum(np.bincount(doc, minlength=n_docs))
    return [texts[lo:hi].tobytes().translate(None, b"\0").decode() for lo, hi in zip(np.r_[0, ends[:-1]], ends)]


class Aligner:
    """Both tokenizers, loaded once in a task."""

    def __init__(self, path_a, path_b):
        self.one, self.two = byte_bpe(path_a), PieceBpe(path_b)
        self.names_a, self.names_b = self.one.token_bytes(), self.two.token_bytes()
        self.sizes_a, self.sizes_b = (np.array([len(n) for n in names]) for names in (self.names_a, self.names_b))
        self.texts = id_texts(max(len(self.names_a), len(self.names_b)))

    def encode(self, texts):
        """Ids of both sides; none for texts that either side does not give back byte by byte."""
        none = np.empty(0, np.int32)
        full = [i for i, t in enumerate(texts) if t]
        ids_a, ids_b = [none] * len(texts), [none] * len(texts)
        for i, b in zip(full, self.two.ids([texts[i] for i in full])):
            want = f" {texts[i]}".encode()
            if b"".join(map(self.names_b.__getitem__, b.tolist())) == want:
                a = self.one.ids(f" {texts[i]}")
                if self.one.whole or b"".join(map(self.names_a.__getitem__, a.tolist())) == want:
                    ids_a[i], ids_b[i] = a, b
        return ids_a, ids_b

    def align(self, texts):
        """(n_a, n_b, n_groups, n_links, group texts, (ends, a, b, n)) of a list of texts.

        The last holds every document's distinct linked id pairs and how often they are linked.
        """
        ids_a, ids_b = self.encode(texts)
        a, b = _Side(ids_a, self.names_a, self.sizes_a), _Side(ids_b, self.names_b, self.sizes_b)
        at = np.minimum(np.searchsorted(b.ends, a.ends), max(len(b.ends) - 1, 0))
        cuts = a.ends[b.ends[at] == a.ends]  # ends are sorted on both sides
        at_a, at_b = links(a, b)
        doc = a.doc[at_a]
        pair = a.ids[at_a].astype(np.int64) * len(self.names_b) + b.ids[at_b]
        key, n = np.unique(doc * (len(self.names_a) * len(self.names_b)) + pair, return_counts=True)
        doc_of, pair = np.divmod(key, len(self.names_a) * len(self.names_b))
        n_docs = len(texts)
        return (
            a.counts, b.counts, np.bincount(a.doc[np.searchsorted(a.ends, cuts)], minlength=n_docs),
            np.bincount(doc, minlength=n_docs), _group_texts(a, b, cuts, n_docs, self.texts),
            (np.cumsum(np.r_[0, np.bincount(doc_of, minlength=n_docs)]),
             pair // len(self.names_b), pair % len(self.names_b), n))


def align(docs, path_a, path_b):
    """Every row of ``docs`` aligned: doc_id, counts, groups as text, and its linked id pairs.

    ``path_a``: a byte-level BPE file, which reads a space and the text; ``path_b``: a sentencepiece
    file, which puts that space itself. a, b and n hold each distinct pair of ids whose bytes overlap
    somewhere, and how often. row numbers the rows of this plan; store the result before using it.
    Texts that are NULL or empty, or that a tokenizer does not give back, have no tokens.
    """
    def run(batches):
        aligner = Aligner(path_a, path_b)
        for batch in text_slices(batches):
            *counts, groups, (ends, a, b, n) = aligner.align(batch.column("text").to_pylist())
            ends = pa.array(ends.astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (a, b, n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), *(pa.array(c.astype(np.int64)) for c in counts),
                 pa.array(groups, pa.string()), *lists],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "a", "b", "n"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       "text")
    return rows.mapInArrow(run, ALIGNED)


def pair_counts(spark, linked):
    """a, b, docs and best: in how many rows of ``linked`` (a, b) stands, and whether no pair of a has more."""
    counts = stored(spark, linked.groupBy("a", "b").agg(F.count("*").alias("docs")), "pair-counts")
    # One row per id of the first vocabulary.
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return stored(spark, counts.join(sized(stored(spark, most, "most"), 16), "a").select(
        "a", "b", "docs", (F.col("docs") == F.col("most")).alias("best")), "pairs")


def agreement(spark, docs, path_a, path_b):
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``.

    A pair of ids counts the rows that link it anywhere. n_best adds up a row's links whose pair has the
    highest count of its first id, ties included; count_sum the counts over all its links. Rows
    without tokens (see ``align``) have zeros, and '' for groups_sha256. Rows are documents: repeated
    rows count again, and rows without doc_id like others. Other columns play no part; an empty
    table gives no rows.

    Every row lists a pair once, and tasks add pairs up before the shuffle. The table of pairs is
    broadcast while it is small; beyond that both sides are shuffled and adaptive execution splits
    the pairs that most rows hold.
    """
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    rows = stored(spark, align(docs, path_a, path_b).select(
        "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "a", "b", "n"), "aligned")
    linked = rows.select("row", F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("row", "p.*")
    pairs = pair_counts(spark, linked)
    scores = linked.join(sized(pairs, 32), ["a", "b"]).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("docs")).alias("count_sum"))
    scores = stored(spark, scores, "scores")
    zero = F.lit(0).cast("long")
    return rows.join(scores, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
