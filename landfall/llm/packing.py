"""Packing of tokenized documents into sequences of fixed capacity.

Only the histogram of piece lengths, at most one number per length, decides how sequences are made
up. Its configuration linear program (how often to use each combination of lengths, so that all
pieces are covered by the fewest sequences) is solved by multiplicative weights: a dynamic programme
over the capacity prices the best combination around every length, lengths that lag behind gain
weight. Rounding takes whole sequences first; what is left is solved again, and the rest is placed
by best fit. Pieces then find their places by their rank among those of their length.
"""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from landfall.llm.common import sized, stored, text_slices
from landfall.llm.tokens import byte_bpe

CAPACITY = 2048
END_ID = 0
ROUNDS = 16
#: A length that lags by one round gains this share (as exponent) of its value.
PACE = 0.1
#: Values so close are equal; combinations so far below the best price are not used.
NEAR = 1e-9
SLACK = 1e-3
#: Lengths without a combination after which the rest is priced anew.
STUCK = 32
PRICINGS = 100
#: A change of values may lower the dual bound by this share.
LOSS = 1e-4

PIECES = "doc_id long, piece int, start long, length long, ids binary, part int, nth long"


class _Pricing:
    """Knapsack over the capacity: the best value of every room, and which lengths reach it."""

    def __init__(self, lengths, values, capacity):
        self.lengths, self.best = lengths, np.zeros(capacity + 1)
        self.near = np.zeros((capacity + 1, len(lengths)), bool)
        fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
        for room in range(1, capacity + 1):
            k = fits[room]
            best = self.best[room - 1]
            if k:
                found = self.best[room - lengths[:k]] + values[:k]
                best = max(best, found.max())
                self.near[room, :k] = found >= best - NEAR
            self.best[room] = best

    def column(self, first, need, capacity):
        """The best combination around ``first`` of what is still needed, the longest of equals first.

        Returns ((length index, copies), ...) or None where nothing needed reaches the best value.
        """
        inside, room = {first: 1}, capacity - int(self.lengths[first])
        need = need.copy()
        need[first] -= 1
        while room > 0 and self.best[room] > 0:
            able = np.flatnonzero(self.near[room] & (need >= 1))
            if len(able):
                j = int(able[-1])
                inside[j] = inside.get(j, 0) + 1
                need[j] -= 1
                room -= int(self.lengths[j])
            elif self.best[room - 1] >= self.best[room] - NEAR:
                room -= 1
            else:
                return None
        return tuple(sorted(inside.items()))


def solve(lengths, counts, capacity=CAPACITY, rounds=ROUNDS, pace=PACE):
    """({combination: uses}, values, lower bound): the linear program by multiplicative weights.

    Every round uses combinations within ``SLACK`` of the best price, those around lagging lengths
    first, for its share of the sequences; no length runs ahead of its share. A length that finds no
    such combination lags and gains value until it does; a change of values that lowers the dual bound
    is taken back, and smaller ones follow. Uses never cover a length more than ``counts``; they may
    fall short. ``values`` are the last prices, the bound holds for any packing.
    """
    covered, uses = np.zeros(len(lengths)), {}
    values, pricing, bound = lengths / capacity, None, 0.0
    for t in range(rounds):
        lag = t - covered * rounds / counts
        tried = values * np.exp(pace * lag) if t else values
        found = _Pricing(lengths, tried, capacity)
        lower = float(tried @ counts) / found.best[capacity]
        if lower >= bound * (1 - LOSS):
            values, pricing, bound = tried, found, max(bound, lower)
        else:
            pace /= 2
        price = pricing.best[capacity]
        goal, room = np.minimum(counts, counts * ((t + 1) / rounds)), max(bound, 1.0) / rounds
        scale = rounds / counts
        for i in np.lexsort((-lengths, np.round(covered * scale))):
            while room > 0 and goal[i] - covered[i] > 1e-9:
                # Copies are counted in units of what a round may use, so that rare lengths take part.
                column = pricing.column(i, np.ceil(np.maximum(goal - covered - 1e-9, 0) * scale) * capacity, capacity)
                if column is None or sum(values[j] * n for j, n in column) < price * (1 - SLACK):
                    break
                step = min(room, *((goal[j] - covered[j]) / n for j, n in column))
                uses[column] = uses.get(column, 0.0) + step
                room -= step
                for j, n in column:
                    covered[j] += step * n
                    if goal[j] - covered[j] <= 1e-9:
                        covered[j] = goal[j]
    return uses, values, bound


def _whole(lengths, left, values, capacity):
    """{combination: uses} in whole numbers, longest first; priced anew when a length has run out.

    ``left`` is lowered by what they hold. Stops where no combination reaches the best price.
    """
    made, stuck = Counter(), 1
    for _ in range(PRICINGS):
        if not stuck or not left.any():
            break
        live = np.flatnonzero(left)
        pricing = _Pricing(lengths[live], values[live], capacity)
        most, stuck, taken = pricing.best[capacity], 0, 0
        for i in range(len(live) - 1, -1, -1):
            while left[live[i]]:
                column = pricing.column(i, left[live], capacity)
                if column is None or sum(values[live[j]] * n for j, n in column) < most * (1 - SLACK):
                    stuck += 1
                    break
                n = min(int(left[live[j]]) // k for j, k in column)
                whole = tuple((int(live[j]), k) for j, k in column)
                made[whole] += n
                taken += n
                for j, k in whole:
                    left[j] -= n * k
            if stuck >= STUCK and taken:
                break
        stuck = stuck if taken else 0
    return made


def _best_fit(lengths, counts, capacity):
    """[(combination, uses)]: longest first, each into the fullest open sequence that has room."""
    open_, rooms = {}, np.zeros(capacity + 1, bool)

    def put(room, held, n):
        open_.setdefault(room, []).append((held, n))
        rooms[room] = True

    for i in range(len(lengths) - 1, -1, -1):
        length, left = int(lengths[i]), int(counts[i])
        while left:
            at = np.flatnonzero(rooms[length:])
            room = length + int(at[0]) if len(at) else capacity
            held, n = open_[room].pop() if len(at) else ((), left)
            if len(at) and not open_[room]:
                del open_[room]
                rooms[room] = False
            copies = room // length
            full, rest = divmod(left, copies)
            used = min(n, full)
            if used:
                put(room - copies * length, held + ((i, copies),), used)
                left -= used * copies
            if used < n and left and left < copies:
                put(room - left * length, held + ((i, left),), 1)
                used, left = used + 1, 0
            if used < n and len(at):
                put(room, held, n - used)
    return [(held, n) for groups in open_.values() for held, n in groups]


def plan(lengths, counts, capacity=CAPACITY, rounds=ROUNDS):
    """([(combination, uses)], lower bound): whole uses that hold every piece exactly once.

    A combination is ((length index, copies), ...). The size of the plan follows the number of
    different lengths, not that of pieces.
    """
    lengths, left = np.asarray(lengths, np.int64), np.array(counts, np.int64)
    if not len(lengths):
        return [], 0.0
    uses, values, bound = solve(lengths, left.astype(float), capacity, rounds)
    made = Counter()
    for column, x in uses.items():
        n = int(x + 1e-6)
        if n:
            made[column] += n
            for j, k in column:
                left[j] -= n * k
    # What is left, by best fit alone or after more combinations at the last prices.
    rests = [Counter(), None]
    priced = left.copy()
    rests[1] = _whole(lengths, priced, values, capacity)
    for rest, unplaced in zip(rests, (left, priced)):
        for column, n in _best_fit(lengths, unplaced, capacity):
            rest[column] += n
    made += min(rests, key=Counter.total)
    return sorted(made.items()), bound


def _places(lengths, combinations):
    """{length: (first rank, copies, first sequence, offset) arrays}, by rank among its pieces."""
    rows = {int(n): [] for n in lengths}
    rank = dict.fromkeys(rows, 0)
    sequence = 0
    for held, uses in combinations:
        offset = 0
        for i, copies in held:
            n = int(lengths[i])
            rows[n].append((rank[n], copies, sequence, offset))
            rank[n] += copies * uses
            offset += copies * n
        sequence += uses
    return {n: tuple(np.array(r, np.int64).T) for n, r in rows.items()}


def cut(n, capacity=CAPACITY):
    """Lengths of the pieces of a document of ``n`` ids: whole ones, before them what is left over."""
    return [*([n % capacity] if n % capacity else []), *[capacity] * (n // capacity)]


def tokenize(docs, path, capacity=CAPACITY, end_id=END_ID):
    """The pieces of all documents (columns as in ``PIECES``; ids as little-endian 32-bit numbers).

    part is the number of the task, nth counts pieces of one length within it.
    """
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        encoder, seen = byte_bpe(path, specials=True), Counter()
        for batch in text_slices(batches):
            ids, starts, sizes, rows, parts, nth = [], [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                whole = encoder.packed(text or "") + end
                at = 0
                for i, n in enumerate(cut(len(whole) // 4, capacity)):
                    ids.append(whole[4 * at:4 * (at + n)])
                    starts.append(at)
                    sizes.append(n)
                    rows.append(row)
                    parts.append(i)
                    nth.append(seen[n])
                    seen[n] += 1
                    at += n
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), pa.array(parts, pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), batch.column("part").take(rows),
                 pa.array(nth, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids", "part", "nth"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.spark_partition_id().alias("part"))
    return rows.mapInArrow(run, PIECES)


def _lists(column):
    """Arrays of ids from their bytes."""
    flat = np.frombuffer(b"".join(column.to_pylist()), "<i4")
    ends = np.cumsum([0, *pc.binary_length(column).to_pylist()]) // 4
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))


def _checksums(column):
    return pa.array([zlib.crc32(ids) for ids in column.to_pylist()], pa.int64())


def pack(spark, docs, path, capacity=CAPACITY, end_id=END_ID, checksums=False):
    """doc_id, piece, start, length, ids, sequence_id and offset: a row for every piece.

    With ``checksums`` there is ids_crc32, of little-endian unsigned 32-bit ids, in place of ids.

    ``path`` is a byte-level BPE file. Every document's ids, and ``end_id`` behind them, stay together
    unless they exceed ``capacity``. NULL and empty texts are ``end_id`` alone. Rows are documents,
    so repeated rows, and rows without doc_id, are packed one by one; other columns play no part;
    an empty table gives no rows.

    Ranks among pieces of one length come from counts per task and length, so no length, however
    frequent, meets in one task. Texts are encoded once and their pieces written.
    """
    pieces = stored(spark, tokenize(docs, path, capacity, end_id), "pieces")
    counts = stored(spark, pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    # At most ``capacity`` rows.
    found = sorted(counts.groupBy("length").agg(F.sum("n").alias("n")).collect())
    lengths = np.array([r["length"] for r in found], np.int64)
    combinations, _ = plan(lengths, [r["n"] for r in found], capacity)
    shared = spark.sparkContext.broadcast(_places(lengths, combinations))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = stored(spark, counts.select(
        "part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "first")

    name, made, kind = ("ids_crc32", _checksums, "long") if checksums else ("ids", _lists, "array<int>")

    def place(batches):
        places = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else ():
                n = int(length[rows[0]])
                low, copies, start, at = places[n]
                k = np.searchsorted(low, rank[rows], side="right") - 1
                inside = rank[rows] - low[k]
                sequence[rows] = start[k] + inside // copies[k]
                offset[rows] = at[k] + inside % copies[k] * n
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length")]
            yield pa.RecordBatch.from_arrays(
                [*kept, made(batch.column("ids")), pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", name, "sequence_id", "offset"])

    ranked = pieces.join(sized(first, 24), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids", (F.col("first") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(place, f"doc_id long, piece int, start long, length long, {name} {kind}, "
                                    "sequence_id long, offset long")


def sequences(packed):
    """sequence_id and ids: the packed sequences themselves."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))

