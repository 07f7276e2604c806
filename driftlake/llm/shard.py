"""Contiguous shards of near-equal bytes by minimax partition, in DataFrame operations alone.

Rows with equal texts form one atomic group. Groups stand in the order of their least ``doc_id``; a
shard is a run of groups. The smallest capacity for which a greedy filling needs no more than the
wanted number of shards is found by binary search. The greedy check only asks where running
sums end, so the driver holds a summary of the running sums of bounded size, whatever the number of
groups: spans with their first and last group end. Where a span leaves a check open, the spans that the
checks reach are cut finer by one aggregation, until the capacity and its cuts are exact.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftlake.llm.common import durable, partitions, text_or_empty

#: Spans that one refinement brings to the driver, at most.
SPANS = 8192


class Ends:
    """What is known of the sorted group ends: spans that hold at least their first and last."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.put(spans)

    def put(self, spans: list[tuple[int, int]]) -> None:
        self.spans = sorted(spans)
        self.firsts = [a for a, _ in self.spans]

    def floor(self, x: int, low: bool) -> int:
        """The greatest end up to ``x``, or a bound for it where a span leaves it open."""
        i = bisect_right(self.firsts, x) - 1
        if i < 0:
            return 0
        first, last = self.spans[i]
        if x >= last:
            return last
        return first if low else x

    def cuts(self, capacity: int, shards: int, low: bool) -> list[int]:
        out, at = [], 0
        for _ in range(shards):
            at = self.floor(at + capacity, low)
            out.append(at)
        return out


def search(ends: Ends, total: int, shards: int) -> tuple[int, int]:
    """``(a, b)``: capacity ``a`` is too small for sure, ``b`` is enough for sure."""

    def least(low: bool) -> int:
        a, b = 0, total
        while b - a > 1:
            mid = (a + b) // 2
            if ends.cuts(mid, shards, low)[-1] >= total:
                b = mid
            else:
                a = mid
        return b

    return least(False) - 1, least(True)


def minimax_cuts(fetch: Callable[[list[tuple[int, int, int]]], list[tuple[int, int]]], total: int, shards: int) -> list[int]:
    """The ends of the shards under the smallest feasible capacity.

    ``fetch`` gives, for windows ``(first, last, width)``, the first and last group end in each block
    of that width.
    """
    ends = Ends(fetch([(0, total, -(-total // SPANS))]))
    while True:
        small, enough = search(ends, total, shards)
        lows, highs = ends.cuts(small + 1, shards, True), ends.cuts(enough, shards, False)
        if enough - small == 1 and lows == highs:
            return lows
        merged: list[list[int]] = []
        widest = 1
        for x, y in sorted(zip(lows, highs, strict=True)):
            near = [s for s in ends.spans if s[0] < s[1] and x <= s[1] and s[0] <= y]
            widest = max([widest, *(b - a + 1 for a, b in near)])
            if near and merged and near[0][0] <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], near[-1][1])
            elif near:
                merged.append([near[0][0], near[-1][1]])
        width = -(-2 * sum(b - a + 1 for a, b in merged) // SPANS)
        width = max(1, min(width, widest // 2))  # never coarser than before
        windows = [(a, b, width) for a, b in merged]
        kept = [s for s in ends.spans if not any(a <= s[0] and s[1] <= b for a, b, _ in windows)]
        ends.put(kept + fetch(windows))


def spans_of(sums: DataFrame) -> Callable[[list[tuple[int, int, int]]], list[tuple[int, int]]]:
    """``fetch`` of :func:`minimax_cuts` over a table with one ``end`` for each group: one job, a bounded result."""

    def fetch(windows: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
        block = F.coalesce(
            *[F.when(F.col("end").between(a, b), F.struct(F.lit(i).alias("w"), F.expr(f"(end - {a}L) div {w}L").alias("b"))) for i, (a, b, w) in enumerate(windows)]
        )
        rows = sums.groupBy(block.alias("block")).agg(F.min("end").alias("a"), F.max("end").alias("z"))
        return [(r["a"], r["z"]) for r in rows.where("block IS NOT NULL").collect()]

    return fetch


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row, by the law of bytes.

    A null text counts as an empty one: size 1, checksum 0, one group with empty texts. Repeated rows
    share their group. Slots follow ``doc_id`` within a shard; nulls come first and ties have any order. Only
    ``doc_id`` and ``text`` are read. An empty table gives an empty result.
    """
    text = text_or_empty()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("_text"),
    )
    rows = durable(rows)
    groups = rows.groupBy("_text").agg(F.min("doc_id").alias("first"), F.sum("size").alias("bytes"))
    # the order of groups, dealt by range: a running sum in each part, then the parts before it
    parted = durable(groups.repartitionByRange(partitions(docs.sparkSession), "first", "_text").withColumn("_part", F.spark_partition_id()))
    weights = parted.groupBy("_part").agg(F.sum("bytes").alias("bytes"))  # a row for each part
    before = weights.select("_part", (F.sum("bytes").over(Window.orderBy("_part")) - F.col("bytes")).alias("_before"))
    within = Window.partitionBy("_part").orderBy("first", "_text").rowsBetween(Window.unboundedPreceding, 0)
    sums = durable(parted.join(F.broadcast(before), "_part").select("_text", (F.sum("bytes").over(within) + F.col("_before")).alias("end")))
    total = sums.agg(F.max("end")).first()[0] or 0
    cuts = minimax_cuts(spans_of(sums), total, shards) if total else []
    number = sum([(F.col("end") > c).cast("int") for c in cuts[:-1]], F.lit(0))
    placed = rows.join(sums.select("_text", number.alias("shard")), "_text").drop("_text")
    # slots in the same way: counted in parts of a range order, then offset
    slots = durable(placed.repartitionByRange(partitions(docs.sparkSession), "shard", "doc_id", "text_crc32").withColumn("_part", F.spark_partition_id()))
    held = slots.groupBy("shard", "_part").agg(F.count("*").alias("n"))  # a row for each part and shard in it
    ahead = held.select("shard", "_part", (F.sum("n").over(Window.partitionBy("shard").orderBy("_part")) - F.col("n")).alias("_ahead"))
    spot = F.row_number().over(Window.partitionBy("_part", "shard").orderBy("doc_id", "text_crc32")) - 1
    return slots.join(F.broadcast(ahead), ["shard", "_part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_ahead") + spot).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
