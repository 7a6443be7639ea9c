"""Packing of tokenised documents into sequences of a fixed length, by linear grouping.

Only lengths matter to the packing, and there are no more of them than a sequence has
tokens. So the plan is made on the driver from the histogram of lengths, whose size the
sequence length bounds, and Spark does everything that grows with the documents:

1. Lengths above a fraction of the sequence are sorted and cut into groups of equally many
   documents; each length is rounded up to the largest of its group.
2. Over these few sizes, the configurations (which sizes share a sequence, and how many
   sequences do so) are optimised as a linear program by column generation; its values are
   rounded down.
3. Actual lengths take the slots of their group, which leaves them some room.
4. What is left, small documents above all, goes best-fit into the tightest room, the
   longest first, and into new sequences where none is large enough.

A plan is a list of runs: the documents of one length with ranks ``first`` to ``first + n``
lie in sequences from ``sequence`` on, at ``offset``. Steps move whole intervals of
sequences, never single ones, so the number of runs doesn't grow with the documents.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import groups_for, whole, written
from tidemark.llm.tokens import encoder, in_pieces

_ROWS_PER_BUCKET = 5_000
_IDS_PER_BATCH = 1 << 20


@dataclass(frozen=True)
class Settings:
    """``large``: lengths above this part of a sequence are grouped; ``groups``: numbers of groups that are tried,
    the plan with the fewest sequences is taken."""

    capacity: int = 4096
    large: float = 0.125
    groups: tuple[int, ...] = (8, 16, 32, 64)


# Plan


def _optimise(sizes: list[int], demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations (how many of each size) and how many sequences use each, rounded down."""
    k = len(sizes)
    columns = np.diag([capacity // s for s in sizes]).astype(float)
    for _ in range(40 * k + 40):
        amounts, prices = np.linalg.solve(columns, demand), np.linalg.solve(columns.T, np.ones(k))
        worth, column = _best_configuration(sizes, prices, capacity)
        if worth <= 1 + 1e-6:
            break
        change = np.linalg.solve(columns, column)
        grows = change > 1e-9
        if not grows.any():
            break
        ratios = np.where(grows, np.maximum(amounts, 0) / np.where(grows, change, 1), np.inf)
        columns[:, int(ratios.argmin())] = column
    amounts = np.linalg.solve(columns, demand)
    return [(columns[:, j].astype(int), int(amounts[j] + 1e-6)) for j in np.argsort(-amounts) if amounts[j] >= 1 - 1e-6]


def _best_configuration(sizes: list[int], prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of the highest price: an unbounded knapsack, one more item in each round."""
    value, choices = np.zeros(capacity + 1), []
    for _ in range(capacity // min(sizes)):
        best, choice = value.copy(), np.full(capacity + 1, -1)
        for i, (size, price) in enumerate(zip(sizes, prices)):
            if price > 0:
                with_it = value[: capacity + 1 - size] + price
                better = with_it > best[size:] + 1e-12
                best[size:][better], choice[size:][better] = with_it[better], i
        choices.append(choice)
        value = best
    column, room = np.zeros(len(sizes)), capacity
    for choice in reversed(choices):
        i = choice[room]
        if i >= 0:
            column[i] += 1
            room -= sizes[i]
    return float(prices @ column), column


class _Plan:
    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity, self.left, self.used = capacity, dict(histogram), defaultdict(int)
        self.runs: list[tuple[int, int, int, int, int]] = []  # length, first, n, sequence, offset
        self.room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by free tokens: first sequence, n
        self.rooms: list[int] = []
        self.sequences = 0

    def put(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.runs.append((length, self.used[length], n, sequence, offset))
        self.used[length] += n
        self.left[length] -= n

    def free(self, room: int, sequence: int, n: int) -> None:
        if room and n:
            if not self.room[room]:
                bisect.insort(self.rooms, room)
            self.room[room].append((sequence, n))

    def open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def substitute(self, lengths: dict[int, list[int]], configuration: np.ndarray, n: int) -> None:
        """Give the slots of ``n`` sequences of one configuration to actual lengths of their groups, longest first."""
        held = [(self.open(n), n, 0)]
        for group, times in enumerate(configuration):
            for _ in range(times):
                after = []
                for sequence, m, offset in held:
                    while m:
                        queue = lengths[group]
                        while queue and not self.left[queue[0]]:
                            queue.pop(0)
                        if not queue:  # fewer documents than slots: the rest stays free
                            after.append((sequence, m, offset))
                            break
                        taken = min(m, self.left[queue[0]])
                        self.put(queue[0], taken, sequence, offset)
                        after.append((sequence, taken, offset + queue[0]))
                        sequence, m = sequence + taken, m - taken
                held = after
        for sequence, m, offset in held:
            self.free(self.capacity - offset, sequence, m)

    def best_fit(self) -> None:
        for length in sorted(self.left, reverse=True):
            while self.left[length]:
                at = bisect.bisect_left(self.rooms, length)
                if at < len(self.rooms):
                    room = self.rooms[at]
                    sequence, n = self.room[room].pop()
                    if not self.room[room]:
                        self.rooms.pop(at)
                    taken = min(n, self.left[length])
                    self.put(length, taken, sequence, self.capacity - room)
                    self.free(room, sequence + taken, n - taken)
                    self.free(room - length, sequence, taken)
                    continue
                each = self.capacity // length
                for n, times in ((self.left[length] // each, each), (1, self.left[length] % each)):
                    if n and times:
                        sequence = self.open(n)
                        for i in range(times):
                            self.put(length, n, sequence, i * length)
                        self.free(self.capacity - times * length, sequence, n)


def plan(histogram: dict[int, int], settings: Settings = Settings()) -> _Plan:
    """The runs for so many documents of each length (1 to ``capacity``)."""
    best = None
    large = sorted((x for x in histogram if x > settings.capacity * settings.large), reverse=True)
    total = sum(histogram[x] for x in large)
    for k in settings.groups if large else (0,):
        made = _Plan(histogram, settings.capacity)
        if k:
            groups: dict[int, list[int]] = defaultdict(list)
            seen = 0
            for length in large:
                groups[min(k - 1, (seen + histogram[length] // 2) * k // total)].append(length)
                seen += histogram[length]
            members = [groups[g] for g in sorted(groups)]
            demand = np.array([sum(histogram[x] for x in g) for g in members], float)
            for configuration, n in _optimise([g[0] for g in members], demand, settings.capacity):
                made.substitute({i: g for i, g in enumerate(members)}, configuration, n)
        made.best_fit()
        if best is None or made.sequences < best.sequences:
            best = made
    return best


# Spark


def token_pieces(documents: DataFrame, tokenizer: str, kind: str, end_id: int, capacity: int,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents' ids with ``end_id`` after each, cut after every ``capacity`` of them.

    A row for each piece: doc_id, piece (from 0), start (ids of the document before it), length, ids (unsigned
    32-bit little-endian). A null text is an empty one; repeated rows are documents of their own.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        coder = encoder(tokenizer, kind)
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            at = 0
            for some in in_pieces(texts):
                for coded in coder.encode(some):
                    coded += end
                    for piece, start in enumerate(range(0, len(coded), 4 * capacity)):
                        part = coded[start : start + 4 * capacity]
                        rows.append((ids[at], piece, start // 4, len(part) // 4, part))
                        held += len(part) // 4
                    at += 1
                    if held > _IDS_PER_BATCH:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids"])

    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    return source.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")


def place(pieces: DataFrame, settings: Settings = Settings(), keys: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` from 1 to the capacity.

    Documents of one length change places freely, so each gets a rank among those of its length: those in earlier
    buckets (of a hash of the keys) plus those before it in its own. No length, however common, meets in one task.
    ``pieces`` is read twice and should be written. Rows with equal keys get different ranks.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(groups_for(pieces, F.lit(1), _ROWS_PER_BUCKET))).alias("_bucket")
    keyed = pieces.select("*", bucket)
    counts = keyed.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    runs = np.array(sorted(plan(histogram, settings).runs), np.int64).reshape(-1, 5)
    shared = pieces.sparkSession.sparkContext.broadcast(runs)

    @F.arrow_udf("sequence_id long, offset long")
    def locate(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        runs, lengths, ranks = shared.value, np.asarray(lengths), np.asarray(ranks)
        wide = np.int64(1) << np.int64(42)
        at = np.searchsorted(runs[:, 0] * wide + runs[:, 1], lengths * wide + ranks, side="right") - 1
        return pa.StructArray.from_arrays(
            [pa.array(runs[at, 3] + ranks - runs[at, 1]), pa.array(runs[at, 4])], ["sequence_id", "offset"]
        )

    within = Window.partitionBy("_bucket", "length").orderBy(*keys)
    ranked = keyed.join(counts.drop("_n"), ["_bucket", "length"]).withColumn(
        "_rank", F.row_number().over(within) - 1 + F.col("_before")
    )
    placed = ranked.withColumn("_at", locate(F.col("length"), F.col("_rank")))
    return placed.select(*pieces.columns, "_at.sequence_id", "_at.offset")


def pack(documents: DataFrame, tokenizer: str, kind: str, end_id: int, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """The written pieces with their ids, and the same pieces without ids but with their places.

    Other columns of the documents are not looked at. An empty table gives empty results.
    """
    pieces = written(token_pieces(documents, tokenizer, kind, end_id, settings.capacity), "pieces")
    return pieces, place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), settings)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, n, ids (joined in order), and the lengths of the pieces as attention blocks."""
    parts = placed.select("doc_id", "piece", "sequence_id", "offset").join(pieces, ["doc_id", "piece"])
    inside = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return (
        parts.groupBy("sequence_id").agg(inside.alias("p"))
        .select("sequence_id", F.aggregate("p.length", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"),
                F.aggregate("p.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"), F.col("p.length").alias("blocks"))
    )
