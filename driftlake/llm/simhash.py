"""SimHash near-duplicates: 64-bit fingerprints linked at four or fewer differing bits.

Fingerprints that differ in at most four bits agree wholly on some of the blocks that the 64 bits are
cut into, so each distinct fingerprint is dealt once for each choice of blocks, keyed by their bits. In
each bucket a hierarchical index finds the links: codes are sorted by Gray rank, runs of neighbours
are factored into nodes that hold the bits all members share, nodes into upper nodes, and a search
adds up the differences on the way down and drops a node's whole group once they exceed four, or once
all its members are known to be connected with the query. A bucket sends on a star for each
connected group, never its pairs. Equal fingerprints are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlake.llm.common import durable, small_batches
from driftlake.llm.components import components

FAN = 8


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes; zero without any."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = np.ascontiguousarray(hashes[at : at + 65_536], "<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, words: int = 4) -> int:
    """The unsigned fingerprint of a text; zero without words."""
    import xxhash

    data = b" ".join((text or "").encode().lower().split())
    if not data:
        return 0
    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts, ends = [0, *(spaces + 1).tolist()], [*spaces.tolist(), len(data)]
    digest = xxhash.xxh64_intdigest
    if len(starts) < words:
        return digest(data, 42)
    total, n = np.zeros(64, np.int64), len(starts) - words + 1
    for at in range(0, n, 65_536):  # a block of a long text at a time
        spans = zip(starts[at : min(at + 65_536, n)], ends[at + words - 1 :], strict=False)
        hashes = np.array([digest(data[a:b], 42) for a, b in spans], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``doc_id, fp``: the fingerprint's 64 bits as a signed long. A null text has no words."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Nodes over Gray-sorted codes: ``bits`` shared by all members where ``mask`` is set."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        full = np.full(len(codes), ~np.uint64(0))
        self.levels = [(codes, full)]
        low = high = codes
        while len(low) > 1:
            cuts = np.arange(0, len(low), FAN)
            low, high = np.bitwise_and.reduceat(low, cuts), np.bitwise_or.reduceat(high, cuts)
            mask = ~(low ^ high)
            self.levels.append((low & mask, mask))
        self.labels = np.arange(len(codes))

    def connect(self, a: np.ndarray, b: np.ndarray) -> None:
        """Give the components of each pair one label, the least."""
        labels = self.labels
        while len(a):
            x, y = labels[a], labels[b]
            differ = x != y
            if not differ.any():
                break
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = labels[labels]
                if (up == labels).all():
                    break
                labels[:] = up

    def uniform(self) -> list[np.ndarray]:
        """For each level the label that all members of a node have, or -1."""
        low = high = self.labels
        out = [self.labels]
        for _ in self.levels[1:]:
            cuts = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            out.append(np.where(low == high, low, -1))
        return out

    def search(self, queries: np.ndarray, limit: int, apart: np.ndarray | None) -> None:
        """Connect each query with the members after it within ``limit`` bits (``apart``: of another chunk)."""
        same = self.uniform()
        top = len(self.levels) - 1
        query = queries
        node = np.zeros(len(query), np.int64)
        bits, mask = self.levels[top]
        spent = np.bitwise_count((self.codes[query] ^ bits[node]) & mask[node]).astype(np.int64)
        keep = spent <= limit
        query, node, spent = query[keep], node[keep], spent[keep]
        for level in range(top - 1, -1, -1):
            upper = self.levels[level + 1][1]
            bits, mask = self.levels[level]
            child = (node[:, None] * FAN + np.arange(FAN)).ravel()
            query, spent, parent = np.repeat(query, FAN), np.repeat(spent, FAN), np.repeat(node, FAN)
            last = (child + 1) * FAN**level - 1  # the last member, if the node is full
            keep = (child < len(bits)) & (last > query)
            query, spent, parent, child = query[keep], spent[keep], parent[keep], child[keep]
            keep = same[level][child] != self.labels[query]
            query, spent, parent, child = query[keep], spent[keep], parent[keep], child[keep]
            more = np.bitwise_count((self.codes[query] ^ bits[child]) & mask[child] & ~upper[parent])
            spent = spent + more
            keep = spent <= limit
            query, node, spent = query[keep], child[keep], spent[keep]
        if apart is not None:
            keep = apart[query] != apart[node]
            query, node = query[keep], node[keep]
        self.connect(query, node)


def stars(codes: np.ndarray, limit: int, chunk: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect exactly the codes that pairs within ``limit`` bits connect."""
    order = np.argsort(gray_rank(codes), kind="stable")
    codes = codes[order]
    index = GrayIndex(codes)
    block = 256
    for at in range(0, len(codes), block):
        index.search(np.arange(at, min(at + block, len(codes))), limit, None if chunk is None else chunk[order])
    linked = index.labels != np.arange(len(codes))
    return codes[index.labels[linked]], codes[linked]


def tables_for(count: int, limit: int = 4) -> tuple[list[int], list[tuple[int, ...]]]:
    """Block widths and the block choices that serve as tables; finer as the corpus grows, always exact."""
    blocks = limit + 1 if count <= 1 << 25 else limit + 2 if count <= 1 << 33 else limit + 3
    widths = [64 // blocks + (i < 64 % blocks) for i in range(blocks)]
    return widths, list(combinations(range(blocks), blocks - limit))


def _key(choice: tuple[int, ...], widths: list[int]) -> Column:
    """The bits of the chosen blocks, in place."""
    mask = 0
    for i in choice:
        mask |= ((1 << widths[i]) - 1) << sum(widths[:i])
    return F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def links(prints: DataFrame, limit: int = 4, most: int = 20_000) -> DataFrame:
    """``a, b`` links between distinct fingerprints ``fp`` that connect all within ``limit`` bits.

    A bucket with over ``most`` codes is cut into chunks, and each pair of chunks is a task of its own.
    """
    widths, choices = tables_for(prints.count(), limit)
    dealt = prints.select(
        "fp", F.explode(F.array(*[F.struct(F.lit(i).alias("t"), _key(c, widths).alias("k")) for i, c in enumerate(choices)])).alias("x")
    ).select("fp", "x.t", "x.k")
    sizes = dealt.groupBy("t", "k").count().where(F.col("count") > 1)
    chunks = F.ceil(F.col("count") / F.lit(most)).cast("int")
    held = dealt.join(sizes, ["t", "k"]).withColumn("m", chunks).withColumn("c", F.pmod(F.xxhash64("fp"), F.col("m")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("m") - 1))
    spread = held.select("fp", "t", "k", "m", "c", other.alias("o")).select(
        "t", "k", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "c", "fp"
    )
    spread = spread.repartition("t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush(rows: np.ndarray) -> pa.RecordBatch:
            bounds = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(1)) + 1
            left, right = [], []
            for part in np.split(rows, bounds):
                if len(part) > 1:
                    apart = part[:, 4] if part[0, 2] != part[0, 3] else None
                    a, b = stars(part[:, 5].view(np.uint64), limit, apart)
                    left.append(a)
                    right.append(b)
            columns = [np.concatenate([*x, np.zeros(0, np.uint64)]).view(np.int64) for x in (left, right)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b"])

        for batch in batches:
            rows = np.ascontiguousarray(np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], axis=1))
            if len(rows):
                held.append(rows)
                edge = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(1))
                if len(edge):  # whole buckets go, the last one may go on in the next batch
                    cut = int(edge[-1]) + 1
                    yield flush(np.concatenate([*held[:-1], rows[:cut]]))
                    held = [rows[cut:]]
        if held:
            yield flush(np.concatenate(held))

    return spread.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 4, limit: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Rows with null or empty texts have fingerprint zero and link as any other; repeated rows share
    their component; a null ``doc_id`` is never a component's name unless all its members are null. Only ``doc_id`` and
    ``text`` are read. An empty table gives an empty result.
    """
    found = durable(fingerprints(docs, words))
    prints = durable(found.groupBy("fp").agg(F.min("doc_id").alias("first")))
    groups = components(links(prints, limit)).withColumnRenamed("node", "fp")
    named = groups.join(prints, "fp")
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    linked = named.join(least, "root").select("fp", "least")
    ids = prints.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return found.join(ids, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 5, limit: int = 4) -> DataFrame:
    """``docs`` with one row of each group of near copies, for corpora: similarity decides, fingerprints come first.

    The Gray index links documents whose fingerprints differ in at most ``limit`` bits; every such link is verified by
    the Jaccard similarity of the whole shingle sets, which needs to be 4/5, and similar documents that fingerprints leave
    apart are found by an exact join. Null and blank texts are one group. A group keeps the row of least ``doc_id``, null
    ids last, of several the first. Repeated rows are copies. Any column names are safe; an empty table gives an empty result.
    """
    from driftlake.llm import neardup

    return neardup.keep_one(docs, words, limit)
