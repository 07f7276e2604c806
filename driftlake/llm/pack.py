"""Best-fit packing of tokenised documents into fixed-size sequences.

Each document is its ids and a closing id 0. Documents longer than a sequence are cut into full
pieces; the rest, one piece a document, is packed by the linear grouping scheme. Spark counts the
pieces of each length: at most ``size`` numbers, whatever the corpus. The plan is made from them on
the driver and says which ranks of each length go where; Spark then gives every piece its rank and
reads its place from the plan. No document is collected, and no length gathers in one task, because
ranks are counted for each input partition first and offset afterwards.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftlake.llm.common import durable, small_batches
from driftlake.llm.tokens import default_vocabulary, word_bpe

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, size: int = 2048, vocabulary: str | None = None) -> DataFrame:
    """One row for each piece of at most ``size`` ids; a null or empty text is its closing id alone."""
    small_batches(docs.sparkSession)
    path = vocabulary or default_vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_bpe(path)
        for batch in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokenizer.many(batch.column(1).to_pylist()), strict=True):
                data = ids + b"\0\0\0\0"
                for i, at in enumerate(range(0, len(data), 4 * size)):
                    part = data[at : at + 4 * size]
                    doc.append(doc_id)
                    piece.append(i)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECE_SCHEMA)


class Simplex:
    """The fractional optimum of few-size configurations by column generation.

    Rows are rounded sizes with demands, columns are configurations that fit in a sequence. New
    columns come from an exact knapsack over the current prices.
    """

    def __init__(self, sizes: list[int], demands: list[int], capacity: int):
        self.sizes, self.capacity = np.array(sizes), capacity
        self.columns = [np.eye(len(sizes))[i] * (capacity // s) for i, s in enumerate(sizes)]
        self.amounts = np.array(demands, float) / [capacity // s for s in sizes]

    def _best(self, prices: np.ndarray) -> np.ndarray:
        low = int(self.sizes.min())
        worth, last = np.zeros(self.capacity + 1), np.full(self.capacity + 1, -1)
        for room in range(low, self.capacity + 1):
            fits = self.sizes <= room
            gain = np.where(fits, worth[np.maximum(room - self.sizes, 0)] + prices, -1.0)
            i = int(gain.argmax())
            if gain[i] > worth[room - 1] + 1e-12:
                worth[room], last[room] = gain[i], i
            else:
                worth[room], last[room] = worth[room - 1], -1
        column, room = np.zeros(len(self.sizes)), self.capacity
        while room >= low:
            if last[room] < 0:
                room -= 1
            else:
                column[last[room]] += 1
                room -= int(self.sizes[last[room]])
        return column

    def solve(self, rounds: int = 400) -> list[tuple[np.ndarray, float]]:
        for _ in range(rounds):
            basis = np.array(self.columns).T
            prices = np.linalg.solve(basis.T, np.ones(len(self.columns)))
            column = self._best(prices)
            if prices @ column <= 1 + 1e-9:
                break
            change = np.linalg.solve(basis, column)
            ratios = np.where(change > 1e-9, self.amounts / np.where(change > 1e-9, change, 1), np.inf)
            out = int(ratios.argmin())
            step = ratios[out]
            self.amounts = np.maximum(self.amounts - step * change, 0)
            self.amounts[out] = step
            self.columns[out] = column
        return list(zip(self.columns, self.amounts, strict=True))


class Stock:
    """Runs of equally filled sequences, found by the room they have left."""

    def __init__(self, size: int):
        self.size = size
        self.runs: dict[int, list[list]] = {}
        self.rooms: list[int] = []

    def add(self, lengths: tuple[int, ...], count: int) -> None:
        if count:
            room = self.size - sum(lengths)
            if room not in self.runs:
                self.runs[room] = []
                insort(self.rooms, room)
            self.runs[room].append([lengths, count])

    def best_fit(self, length: int, count: int) -> None:
        """Put ``count`` pieces where the least room is left over, opening sequences when none fits."""
        while count:
            i = bisect_left(self.rooms, length)
            if i == len(self.rooms):
                each = self.size // length
                self.add((length,) * each, count // each)
                if count % each:
                    self.add((length,) * (count % each), 1)
                return
            room = self.rooms[i]
            lengths, there = self.runs[room].pop()
            if not self.runs[room]:
                del self.runs[room]
                self.rooms.pop(i)
            each = min(room // length, count)
            used = min(there, count // each)
            self.add(lengths, there - used)
            self.add(lengths + (length,) * each, used)
            count -= used * each


class Supply:
    """How many pieces of each length are still to be placed."""

    def __init__(self, counts: dict[int, int]):
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.lengths = sorted(self.left)

    def longest(self, limit: int, taken: list[int]) -> int | None:
        """The longest remaining length up to ``limit``, besides those already ``taken``."""
        i = bisect_right(self.lengths, limit) - 1
        while i >= 0 and taken.count(self.lengths[i]) >= self.left[self.lengths[i]]:
            i -= 1
        return self.lengths[i] if i >= 0 else None

    def take(self, length: int, count: int) -> None:
        self.left[length] -= count
        if not self.left[length]:
            del self.left[length]
            self.lengths.pop(bisect_left(self.lengths, length))


def plan(counts: dict[int, int], size: int = 2048, groups: int = 40) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths, number of sequences)`` runs that hold exactly ``counts`` pieces of each length.

    Lengths over a third of a sequence are dealt, longest first, into ``groups`` groups of equal
    cardinality and rounded up to their group's longest. The fractional optimum over the rounded
    sizes says how often each configuration is used. Each whole use takes actual lengths: the longest
    left within every slot's rounded size, and in the last slot the longest that fits the actual
    room, which is never less than planned. All lengths left over then go by best fit, longest first,
    into the room left.
    """
    supply, stock = Supply(counts), Stock(size)
    large = sorted(((n, c) for n, c in supply.left.items() if 3 * n > size), reverse=True)
    quota = max(1, -(-sum(c for _, c in large) // groups))
    demands: Counter = Counter()
    dealt, top = 0, 0
    for length, count in large:
        while count:
            if dealt % quota == 0:
                top = length
            part = min(count, quota - dealt % quota)
            demands[top] += part
            dealt += part
            count -= part
    if demands:
        tops = sorted(demands, reverse=True)
        uses = Simplex(tops, [demands[t] for t in tops], size).solve()
        for column, amount in sorted(uses, key=lambda u: tuple(u[0]), reverse=True):
            slots = [t for t, n in zip(tops, column.round().astype(int).tolist(), strict=True) for _ in range(n)]
            amount = int(amount + 1e-6)
            while amount and slots:
                chosen: list[int] = []
                for slot in slots[:-1]:
                    if (length := supply.longest(slot, chosen)) is not None:
                        chosen.append(length)
                if (length := supply.longest(size - sum(chosen), chosen)) is not None:
                    chosen.append(length)
                if not chosen:
                    break
                need = Counter(chosen)
                steps = min(amount, *(supply.left[n] // c for n, c in need.items()))
                for n, c in need.items():
                    supply.take(n, c * steps)
                stock.add(tuple(chosen), steps)
                amount -= steps
    for length in reversed(list(supply.lengths)):
        stock.best_fit(length, supply.left[length])
    return [(lengths, count) for runs in stock.runs.values() for lengths, count in runs]


def places(runs: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """The plan as rows (length, first rank, first sequence, pieces of the length in a sequence, offset)."""
    ranks: Counter = Counter()
    rows, sequence = [], 0
    for lengths, count in runs:
        offset = 0
        for length, each in sorted(Counter(lengths).items(), reverse=True):
            rows.append((length, ranks[length], sequence, each, offset))
            ranks[length] += each * count
            offset += length * each
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, size: int = 2048, vocabulary: str | None = None) -> DataFrame:
    """Every piece with its sequence and its place there.

    Null or empty texts are packed as their closing id. Repeated rows are packed as often as they
    occur. Only ``doc_id`` and ``text`` are read, so other columns may have any names. An empty table
    gives an empty result.
    """
    cut = durable(pieces(docs, size, vocabulary).withColumn("_part", F.spark_partition_id()))
    found = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most `size` rows
    full = found.pop(size, 0)
    table = places(plan(found, size) + ([((size,), full)] if full else []))

    of_part = cut.groupBy("_part", "length").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = of_part.select("_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_part", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.withColumn("_rank", F.row_number().over(within) - 1).join(offsets, ["_part", "length"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("_rank")).alias("_rank"))

    lengths, firsts = table[:, 0], table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows = np.searchsorted(lengths, np.arange(size + 2))
        for batch in batches:
            length = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            at = np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(rows):
                    low, high = lows[length[rows[0]]], lows[length[rows[0]] + 1]
                    at[rows] = low + np.searchsorted(firsts[low:high], rank[rows], "right") - 1
            run = table[at].reshape(-1, 5)
            step = rank - run[:, 1]
            sequence = run[:, 2] + step // run[:, 3]
            offset = run[:, 4] + step % run[:, 3] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, PIECE_SCHEMA + ", sequence_id long, offset long")
