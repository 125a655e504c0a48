"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans.

The field scores whole segments of a region (neighbouring tokens with a digit or an at sign):
features see a segment's full text, its grouping and what stands on both sides. Dynamic
programming over segments of bounded length chooses boundaries and kinds together.
"""

import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import slices, unit_hash

#: Fixed order of the kinds.
KINDS = ("email", "ip", "card", "phone")
OTHER = "other"
SAMPLE_DOCS = 8_000
MAX_EXAMPLES = 1_500
#: A span has at most so many parts and characters, holds a digit or an at sign, and cuts no run of
#: letters and digits.
MAX_PARTS = 12
MAX_SPAN = 320
#: Segments whose scores a task remembers.
KNOWN_SEGMENTS = 100_000
EPOCHS = 4
RATE = 0.25

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match of the stated pattern always begins at the first digit of a run, so these need no retry.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_PART = re.compile(r"[0-9]+|[A-Za-z]+|[^\W\d_]+|[^\s]| ")
#: Begins only where a token does, so a long token without a digit is walked once.
_REGION = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?: [^\s0-9@]*+[0-9@]\S*+)*+")
_NUMBER = re.compile(r"[0-9]+")
_DIGIT = re.compile(r"[0-9@]")


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text):
    """Leftmost non-overlapping matches. The part before an at sign is the run of allowed
    characters that ends there; each run is walked once, so long runs stay linear."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            end = host.end()
        else:
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))


def _digits(text):
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text):
    """(start, kind index, end) of the stated patterns, by start and then kind."""
    found = []
    if "@" in text:
        found += [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def regions(text):
    """(start, end) of runs of neighbouring tokens that hold a digit or an at sign."""
    return [m.span() for m in _REGION.finditer(text)] if _DIGIT.search(text) else []


def _parts(text, start, end):
    return [m.span() for m in _PART.finditer(text, start, end)]


def _shape(piece):
    """Runs of digits as their length, runs of letters as a, the rest as it is."""
    runs = re.sub(r"[A-Za-z]+", "a", piece)
    return re.sub(r"[0-9]+", lambda m: f"<{min(len(m.group()), 20)}>", runs)[:48]


def segment_features(text, start, end, low, high):
    """Features of a whole segment; ``low`` and ``high`` bound the region it lies in."""
    piece = text[start:end]
    digits = _digits(piece)
    n = len(digits)
    shape = _shape(piece)
    groups = [len(g) for g in re.findall("[0-9]+", piece)]
    out = [f"shape={shape}", f"first={_shape(piece[:1])[:1]}", f"last={_shape(piece[-1:])[:1]}",
           f"digits={min(n, 20)}", f"groups={min(len(groups), 6)}",
           "marks=" + "".join(sorted({c for c in piece if not c.isalnum()}))[:8]]
    before, after = text[start - 1:start], text[end:end + 1]
    if before.isalnum() or after.isalnum():
        out.append("cuts a word")
    if before and before in "+(=\"'-.@_" or after and after in ")-@_=" and end < high:
        out.append("cuts a mark")
    if piece.count("@") == 1 and _HOST.fullmatch(piece.split("@")[1] or " "):
        out.append("address")
    if len(groups) == 4 and piece.count(".") == 3:
        parts = piece.split(".")
        out.append("octets" if all(_NUMBER.fullmatch(p) and int(p[:6]) <= 255 for p in parts) else "no octets")
    if 14 <= n <= 19:
        out.append("luhn" if luhn(digits) else "no luhn")
    if 10 <= n <= 15 and re.fullmatch(r"[+(]?[0-9][ ().0-9-]+[0-9]", piece):
        out.append("dialled")
        if groups[-2:] == [3, 4]:
            out.append("ends 3-4")
        if groups[-3:] == [3, 3, 4] and not _NUMBER.fullmatch(piece):
            out.append("ends 3-3-4")
    if any(c.isalpha() for c in piece) and "@" not in piece:
        out.append("letters")
    return out


def _lattice(text, cut):
    """(i, j) of all segments that may be an entity, by their ends."""
    marks = np.cumsum([0, *(_DIGIT.search(text, s, e) is not None for s, e in cut)]).tolist()
    # Parts at whose beginning a segment may begin.
    free = [s for s, (at, _) in enumerate(cut)
            if text[at] != " " and not (text[at].isalnum() and text[at - 1:at].isalnum())]
    at = 0
    for j in range(1, len(cut) + 1):
        end = cut[j - 1][1]
        if marks[j] == marks[max(0, j - MAX_PARTS)] or text[end - 1] == " " or (
                text[end - 1].isalnum() and text[end:end + 1].isalnum()):
            continue
        while at < len(free) and free[at] < j - MAX_PARTS:
            at += 1
        for i in free[at:at + MAX_PARTS]:
            if i >= j or marks[j] == marks[i]:
                break
            if end - cut[i][0] <= MAX_SPAN:
                yield i, j


class SegmentField:
    """Weights of (kind, feature); a part outside entities has the score of its kind ``other``."""

    def __init__(self, weights=None):
        self.weights = weights or {}
        self._known = {}

    def _scores(self, feats):
        w = self.weights
        return [sum(w.get((k, f), 0.0) for f in feats) for k in KINDS]

    def _segment(self, text, start, end, low, high):
        """Scores of a segment by kind, remembered by all that its features look at."""
        key = text[start - 1:start], text[start:end], text[end:end + 1], end < high
        scores = self._known.get(key)
        if scores is None:
            if len(self._known) >= KNOWN_SEGMENTS:
                self._known.clear()
            scores = self._known[key] = self._scores(segment_features(text, start, end, low, high))
        return scores

    def _edges(self, n, lattice):
        other = self.weights.get((OTHER, "part"), 0.0)
        edges = [[]] + [[(j, OTHER, other, ("part",))] for j in range(n)]
        for i, j, feats in lattice:
            for kind, score in zip(KINDS, self._scores(feats)):
                edges[j].append((i, kind, score, feats))
        return edges

    def decode(self, text, start, end):
        """Best segmentation of a region: [(start, kind index, end)] of its entities.

        A region of any length is decoded as one, in time linear in its parts: segments come by
        their ends, and only scores and one back pointer per part are kept.
        """
        cut = _parts(text, start, end)
        other = self.weights.get((OTHER, "part"), 0.0)
        best, back = [0.0] * (len(cut) + 1), [None] * (len(cut) + 1)
        done = 0
        for i, j in [*_lattice(text, cut), (len(cut), len(cut) + 1)]:
            while done < min(j, len(cut)):  # every part may stand alone
                done += 1
                best[done], back[done] = best[done - 1] + other, (done - 1, None)
            if j <= len(cut):
                scores = self._segment(text, cut[i][0], cut[j - 1][1], start, end)
                k = max(range(len(KINDS)), key=scores.__getitem__)
                if best[i] + scores[k] > best[j]:
                    best[j], back[j] = best[i] + scores[k], (i, k)
        found, j = [], len(cut)
        while j:
            i, kind = back[j]
            if kind is not None:
                found.append((cut[i][0], kind, cut[j - 1][1]))
            j = i
        return found[::-1]

    def fit(self, examples, epochs=EPOCHS, rate=RATE):
        """Gradient ascent on the conditional likelihood; ``examples``: (text, spans)."""
        squares, known = {}, []
        for text, spans in examples:
            for start, end in regions(text):
                cut = _parts(text, start, end)
                lattice = [(i, j, segment_features(text, cut[i][0], cut[j - 1][1], start, end))
                           for i, j in _lattice(text, cut)]
                known.append((len(cut), lattice, self._gold(cut, spans, {(i, j) for i, j, _ in lattice})))
        for _ in range(epochs):
            for n, lattice, gold in known:
                self._step(n, lattice, gold, squares, rate)
        self.weights = {k: v for k, v in self.weights.items() if abs(v) > 1e-3}
        self._known = {}
        return self

    def _step(self, n, lattice, gold, squares, rate):
        edges = self._edges(n, lattice)
        forward, backward = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        forward[0] = backward[n] = 0.0
        for j in range(1, n + 1):
            forward[j] = np.logaddexp.reduce([forward[i] + s for i, _, s, _ in edges[j]])
        for j in range(n, 0, -1):
            for i, _, s, _ in edges[j]:
                backward[i] = np.logaddexp(backward[i], backward[j] + s)
        grads = {}
        for j in range(1, n + 1):
            for i, kind, s, feats in edges[j]:
                p = float(np.exp(forward[i] + s + backward[j] - forward[n]))
                g = (1.0 if (i, j, kind) in gold else 0.0) - p
                if abs(g) > 1e-3:
                    for f in (feats if kind != OTHER else ("part",)):
                        grads[kind, f] = grads.get((kind, f), 0.0) + g
        for key, g in grads.items():
            g -= 1e-3 * self.weights.get(key, 0.0)
            squares[key] = squares.get(key, 1.0) + g * g
            self.weights[key] = self.weights.get(key, 0.0) + rate * g / np.sqrt(squares[key])

    @staticmethod
    def _gold(cut, spans, able):
        starts = {s: i for i, (s, _) in enumerate(cut)}
        ends = {e: i + 1 for i, (_, e) in enumerate(cut)}
        gold, covered = set(), set()
        for s, kind, e in spans:
            i, j = starts.get(s), ends.get(e)
            if (i, j) in able and not covered & set(range(i, j)):
                gold.add((i, j, KINDS[kind]))
                covered |= set(range(i, j))
        return gold | {(i, i + 1, OTHER) for i in range(len(cut)) if i not in covered}


#: Numbers that are no personal data, in the forms in which they occur in prose.
_PLAIN = ("on 2023-11-05 at", "at 12:30 in", "about 3.14 of", "sold 1,234,567 in", "version 10.2.1 of",
          "No. 4521 of", "in 1987 and 1993", "page 12-15 of", "ISBN 978-3-16-148410-0 by",
          "ratio 0.75 or 75% of", "order 20231105123000 was", "id 1234567890 is", "key a9f3e07b21c4d5 is")


def training_examples(texts):
    """(text, spans) around each region: base spans as labels, and phones without country code.

    The second form teaches the grouping of a phone number apart from its plus sign.
    """
    examples = []
    for text in texts:
        spans = base_spans(text)
        for low, high in regions(text):
            a, b = max(0, low - 12), min(high + 12, low + 400)
            inside = [(s - a, k, e - a) for s, k, e in spans if low <= s and e <= min(high, b)]
            examples.append((text[a:b], inside))
            for s, k, e in inside:
                country = re.match(r"\+[0-9]{1,3} (?=\()", text[a + s:a + e]) if k == 3 else None
                if country:
                    cut = text[a:b][:s] + text[a:b][s + country.end():]
                    examples.append((cut, [(s, 3, e - country.end())]))
                    break
    return examples


SPAN = "array<struct<start: long, kind: int, end: long>>"


def _examples(batches):
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            found = training_examples(batch.slice(at, 512).column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([t for t, _ in found], pa.string()), pa.array([s for _, s in found], span)],
                names=["text", "spans"])


def fit_field(docs, sample_docs=SAMPLE_DOCS, most=MAX_EXAMPLES):
    """A field fitted on the regions of an expected ``sample_docs`` texts with a digit or an at sign.

    Texts are chosen by a hash and read whole; of their regions, the ``most`` with the smallest
    hash reach the driver, as pieces of at most 424 characters.
    """
    some = docs.where(F.col("text").rlike("[0-9@]")).select("text")
    n = some.count()
    rate = min(1.0, sample_docs / n) if n else 0.0
    rows = some.where(unit_hash("text", F.lit(3)) < rate).mapInArrow(_examples, f"text string, spans {SPAN}")
    rows = rows.orderBy(F.xxhash64("text"), "text").limit(most).collect()
    plain = [(t, []) for t in _PLAIN for _ in range(8)]
    found = [(r["text"], [tuple(s) for s in r["spans"]]) for r in rows]
    examples = plain + found
    order = np.random.default_rng(7).permutation(len(examples))
    return SegmentField().fit([examples[i] for i in order])


def _union(spans):
    """Disjoint [start, end] of what sorted ``spans`` cover."""
    out = []
    for s, _, e in spans:
        if out and s < out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def all_spans(text, field):
    """(base spans, base and added spans). A segment that touches a base span adds nothing."""
    if not text:
        return [], []
    base = base_spans(text)
    covered = _union(base)
    starts, ends = [s for s, _ in covered], [e for _, e in covered]
    added = []
    for low, high in regions(text):
        near = covered[bisect_right(ends, low):bisect_left(starts, high)]
        if sum(min(e, high) - max(s, low) for s, e in near) >= high - low - 1:
            continue
        for s, k, e in field.decode(text, low, high):
            at = bisect_right(ends, s)
            if at == len(ends) or e <= starts[at]:
                added.append((s, k, e))
    return base, sorted(base + added)


def find_spans(spark, docs, field):
    """``docs`` with base and spans: arrays of (kind, start, end) in code points, end exclusive.

    Whole texts are read; NULL texts have no spans. All input columns are kept.
    """
    shared = spark.sparkContext.broadcast(field.weights)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def find(batches):
        model = SegmentField(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                both = [all_spans(t, model) for t in part.column("text").to_pylist()]
                columns = [pa.array([[(KINDS[k], s, e) for s, k, e in spans] for spans in found], span)
                           for found in zip(*both)] if both else [pa.array([], span)] * 2
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *columns], names=[*part.schema.names, "base", "spans"])

    kind = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                     T.StructField("end", T.LongType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField("base", kind), T.StructField("spans", kind)])
    return docs.mapInArrow(find, schema)


def _counted(kind):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def listed(spans):
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def detect(spark, docs, sample_docs=SAMPLE_DOCS):
    """doc_id, counts per kind of the base spans, base_sha256 and spans, for every row of ``docs``.

    NULL and empty texts have none. Repeated rows give equal rows; other columns play no part.
    """
    rows = docs.select("doc_id", "text")
    found = find_spans(spark, rows, fit_field(rows, sample_docs))
    return found.select("doc_id", *map(_counted, KINDS), F.sha2(listed("base"), 256).alias("base_sha256"),
                        listed("spans").alias("spans"))


def redact(spark, docs, sample_docs=SAMPLE_DOCS):
    """``docs`` with every span of the text replaced by its kind in brackets, and n_chars anew.

    Rows and other columns stay; overlapping spans are replaced together by the first one's kind.
    """
    field = fit_field(docs, sample_docs)
    shared = spark.sparkContext.broadcast(field.weights)

    def masked(text, model):
        out, at = [], 0
        for s, k, e in all_spans(text, model)[1]:
            if s >= at:
                out += [text[at:s], f"[{KINDS[k].upper()}]"]
            at = max(at, e)
        return "".join(out) + text[at:]

    def mask(batches):
        model = SegmentField(shared.value)
        for batch in slices(batches):
            i, n = batch.schema.get_field_index("text"), batch.schema.get_field_index("n_chars")
            texts = [t and masked(t, model) for t in batch.column("text").to_pylist()]
            batch = batch.set_column(i, batch.schema.field(i), pa.array(texts, batch.schema.field(i).type))
            if n >= 0:
                sizes = [c if t is None else len(t) for t, c in zip(texts, batch.column("n_chars").to_pylist())]
                batch = batch.set_column(n, batch.schema.field(n), pa.array(sizes, batch.schema.field(n).type))
            yield batch

    return docs.mapInArrow(mask, docs.schema)
