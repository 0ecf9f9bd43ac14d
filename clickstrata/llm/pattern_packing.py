"""Packing by patterns of lengths, fitted by non-negative least squares.

Documents become pieces of at most one sequence. The histogram of piece lengths
decides everything: patterns of up to three lengths that fill a sequence are
enumerated, repeat counts fitted to the histogram and rounded, and what is left
over is packed best fit decreasing, into the room the patterns leave first. The
plan works on counts, so its size depends on the capacity, not on the data. It
says which ranks of each length go to which sequences; ranks are found without
sorting any length in one task.

Defined results: a null or empty text is the end id alone; null ids are packed
like others; repeated rows are packed each for itself; an empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clickstrata.llm.best_fit import RoomTree, pieces
from clickstrata.llm.common import store
from clickstrata.llm.tokens import WordIds, slices

CAPACITY = 4096
END_ID = 1
# Lengths are rounded up to this for the patterns; a sequence loses at most
# three times as much room, which short documents fill afterwards.
UNIT = 8
STEPS = 600
# Parts a length is ranked in, so that a very common one is not one task's.
RANK_PARTS = 64

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """The pieces of every document, with the checksum of their ids."""
    end = np.asarray([end_id], dtype="<u4").tobytes()
    arrow = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("piece", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids_crc32", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What Arrow keeps from earlier stages of this worker.
        pa.default_memory_pool().release_unused()
        coder = WordIds(tokenizer, special=True)
        for batch in batches:
            ids_of = batch.column("doc_id").to_pylist()
            for first, texts in slices(batch):
                rows = []
                for doc_id, ids in zip(ids_of[first:], coder.encode(texts)):
                    ids += end
                    for piece, (start, length) in enumerate(pieces(len(ids) // 4, capacity)):
                        checksum = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        rows.append((doc_id, piece, start, length, checksum))
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return source.mapInArrow(run, PIECES)


def patterns(parts: int) -> np.ndarray:
    """All ways to write ``parts`` as up to three numbers, largest first; 0 fills up."""
    found = [np.array([[parts, 0, 0]])]
    for third in range(parts // 3 + 1):
        second = np.arange(max(third, 1), (parts - third) // 2 + 1)
        first = parts - third - second
        found.append(np.stack([first, second, np.full_like(second, third)], axis=1))
    return np.concatenate(found)


def fitted(shapes: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative repeat counts whose use of each length is closest to the histogram.

    Accelerated projected gradient; the matrix is applied through the shapes.
    """
    if not len(shapes):
        return np.zeros(0)
    scale = histogram.max()
    goal = histogram / scale

    def used(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(shapes[:, k], x, len(goal)) for k in range(3))
        total[0] = 0
        return total

    probe = np.ones(len(shapes))
    for _ in range(20):
        probe = probe / np.linalg.norm(probe)
        probe = used(probe)[shapes].sum(axis=1)
    pace = 1 / np.linalg.norm(probe)
    x = ahead = np.zeros(len(shapes))
    t = 1.0
    for _ in range(steps):
        short = used(ahead) - goal
        short[0] = 0
        new = np.maximum(0, ahead - pace * short[shapes].sum(axis=1))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x * scale


class Plan:
    """Rows (length, from rank, to rank, first sequence, items a sequence)."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = dict(counts)
        self.rank = dict.fromkeys(counts, 0)
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.tree = RoomTree(capacity)

    def take(self, length: int, first: int, n: int, each: int = 1) -> None:
        """The next n items of a length, ``each`` in a sequence, from sequence ``first`` on."""
        start = self.rank[length]
        self.rows.append((length, start, start + n, first, each))
        self.rank[length] += n
        self.left[length] -= n

    def leave(self, room: int, first: int, n: int) -> None:
        if room and n:
            self.open[room].append((first, n))
            self.tree.mark(room, True)

    def repeat(self, classes: list[list[int]], n: int) -> None:
        """n sequences with an item from each class; a class lists its lengths, longest first."""
        first, bounds, takes = self.sequences, {0, n}, []
        for lengths in classes:
            at, runs = 0, []
            for length in lengths:
                some = min(self.left[length], n - at)
                if some:
                    runs.append((at, length))
                    self.take(length, first + at, some)
                    at += some
                    bounds.add(at)
                if at == n:
                    break
            takes.append(runs)
        edges = sorted(bounds)
        for a, b in zip(edges, edges[1:]):
            full = sum(max(run for run in runs if run[0] <= a)[1] for runs in takes)
            self.leave(self.capacity - full, first + a, b - a)
        self.sequences += n

    def fill(self) -> None:
        """Pack what is left best fit decreasing, into open room first."""
        for length in sorted(self.left, reverse=True):
            while m := self.left[length]:
                room = self.tree.least(length)
                if room is None:
                    room, first, n = self.capacity, self.sequences, -(-m // (self.capacity // length))
                    self.sequences += n
                else:
                    first, n = self.open[room].pop()
                    if not self.open[room]:
                        self.tree.mark(room, False)
                each = room // length
                full = min(n, m // each)
                if full:
                    self.take(length, first, full * each, each)
                    self.leave(room - each * length, first, full)
                rest = m - full * each
                if full < n:
                    if rest:
                        # Fewer than a sequence takes: they share the next one.
                        self.take(length, first + full, rest, each)
                        self.leave(room - rest * length, first + full, 1)
                        full += 1
                    self.leave(room, first + full, n - full)


def planned(counts: dict[int, int], capacity: int = CAPACITY, unit: int = UNIT) -> Plan:
    """The plan for a histogram of lengths from 1 to the capacity."""
    plan = Plan(counts, capacity)
    parts = capacity // unit
    if parts < 1 or capacity % unit:
        raise ValueError("the capacity must be a multiple of the unit")
    classes: list[list[int]] = [[] for _ in range(parts + 1)]
    for length in sorted(counts, reverse=True):
        classes[-(-length // unit)].append(length)
    histogram = np.array([sum(counts[x] for x in lengths) for lengths in classes], dtype=float)
    shapes = patterns(parts)
    # Only patterns of lengths that occur can be used.
    shapes = shapes[((histogram[shapes] > 0) | (shapes == 0)).all(axis=1)]
    repeats = np.floor(fitted(shapes, histogram) + 0.5).astype(np.int64)
    left = histogram.astype(np.int64)
    for at in np.argsort(-repeats, kind="stable"):
        if not repeats[at]:
            break
        shape = [int(part) for part in shapes[at] if part]
        n = min(int(repeats[at]), *(int(left[part]) // shape.count(part) for part in shape))
        if n:
            for part in shape:
                left[part] -= n
            plan.repeat([classes[part] for part in shape], n)
    plan.fill()
    return plan


def ranked(cuts: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0, in parts of bounded share."""
    keys = ["length", "rank_part"]
    cuts = cuts.withColumn(
        "rank_part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(RANK_PARTS))
    )
    counts = cuts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("rank_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    first = counts.select(*keys, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    own = Window.partitionBy(*keys).orderBy("doc_id", "start")
    return (
        cuts.withColumn("own", F.row_number().over(own) - 1)
        .join(first, keys)
        .select(*PIECE_COLUMNS, (F.col("first") + F.col("own")).alias("rank"))
    )


PIECE_COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32")


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Each piece with its sequence and its place there."""
    spark = docs.sparkSession
    cuts = store(cut(docs, capacity, tokenizer), "pieces")
    # At most as many rows as a sequence has places.
    counts = {r["length"]: r["count"] for r in cuts.groupBy("length").count().collect()}
    plan = planned(counts, capacity)
    schema = "plan_length long, from_rank long, to_rank long, first_sequence long, each long"
    rows = spark.createDataFrame(plan.rows, schema)
    placed = (
        ranked(cuts)
        .join(
            F.broadcast(rows),
            (F.col("length") == F.col("plan_length"))
            & (F.col("rank") >= F.col("from_rank"))
            & (F.col("rank") < F.col("to_rank")),
        )
        .select(
            *PIECE_COLUMNS,
            "rank",
            F.expr("first_sequence + (rank - from_rank) div each").alias("sequence_id"),
        )
    )
    before = (
        Window.partitionBy("sequence_id")
        .orderBy(F.desc("length"), "rank")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.select(
        *PIECE_COLUMNS,
        "sequence_id",
        F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"),
    )
