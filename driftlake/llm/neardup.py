"""Near copies of whole documents: what follows the Gray index of :mod:`simhash` when similarity decides.

A document's tokens are its distinct five-word shingles, of ASCII-lower-cased words; shorter texts have all their
words as one token. Documents with equal words are one node, and so are all without words. Two nodes are linked
if the Jaccard similarity of their token sets is at least 4/5. At that similarity about ten of 64 fingerprint bits
differ, far more than an index can search exactly, so fingerprints within four bits only bring the closest copies
together. An exact join finds the others. Tokens are ordered by rarity, as in
:mod:`linededup`: by the logarithm of the count of the token's hash bucket, then by hash. Linked nodes share a token
among the first n - ceil(4n/5) + 1 of the longer and the first n - ceil(8n/9) + 1 of the shorter, so only these prefixes
are joined, and every pair that the length and positional filters and sketches of the sets leave is verified by its whole token sets. No link is
missed but those whose nodes are connected already: besides what the index links, each node meets the least and the
greatest node of its tokens' groups, and after that only nodes of different components are paired.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftlake.llm import simhash
from driftlake.llm.common import durable, free_name, mark, partitions, release, small_batches
from driftlake.llm.components import components

WORDS = 5
BUCKETS = 1 << 16
#: Hash buckets of nodes whose token sets verification may need.
FLAGS = 1 << 18
#: Row numbers that may be broadcast.
FEW = 1 << 20
#: Tokens of buckets with so many times the mean count are grouped by partial aggregates and a join instead of a window.
HOT = 16
#: Bits of a token set's sketch.
BITS = 1024


def words_of(text: str | None) -> bytes:
    """The lower-cased words of a text, one space apart."""
    return b" ".join((text or "").encode().lower().split())


def node_of(data: bytes) -> int:
    """The hash of the words."""
    import xxhash

    return xxhash.xxh64_intdigest(data, 42)


def tokens_of(data: bytes, words: int = WORDS) -> np.ndarray:
    """The hashes of the distinct shingles of :func:`words_of`; none without words."""
    import xxhash

    if not data:
        return np.zeros(0, np.uint64)
    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts, ends = [0, *(spaces + 1).tolist()], [*spaces.tolist(), len(data)]
    n = max(1, len(starts) - words + 1)
    spans = zip(starts[:n], ends[words - 1 :] or ends[-1:], strict=True)  # a short text is one span
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(data[a:b], 42) for a, b in spans), np.uint64, n))


def by_rarity(tokens: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The tokens as non-negative longs in the order of their rarity."""
    low = (tokens >> np.uint64(8)).astype(np.int64)
    return np.unique(ranks[(tokens & np.uint64(BUCKETS - 1)).astype(np.int64)] << 56 | low)


def bucket_counts(copy: DataFrame, words: int) -> np.ndarray:
    """For each hash bucket the count of its tokens over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount((tokens_of(words_of(text), words) & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["b", "n"])

    counts = copy.select(F.col("text").cast("string")).mapInArrow(run, "b int, n long").groupBy("b").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in counts.collect():  # at most BUCKETS rows
        out[row["b"]] = row["n"]
    return out


def rank(count: int) -> int:
    return min(100, int(4 * math.log2(count))) if count else 0


def prefixes(copy: DataFrame, ranks: np.ndarray, words: int) -> DataFrame:
    """``row, doc_id, node, fp, n, tokens``: each row's node and fingerprint, its number of tokens and the first of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, prints, sizes, firsts = [], [], [], []
            for text in batch.column(2).to_pylist():
                data = words_of(text)
                tokens = tokens_of(data, words)
                ordered = by_rarity(tokens, ranks)
                n = len(ordered)
                nodes.append(node_of(data))
                prints.append(simhash.majority(tokens))
                sizes.append(n)
                firsts.append(ordered[: n - (4 * n + 4) // 5 + 1] if n else ordered)
            ends = np.cumsum([0, *map(len, firsts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*firsts, np.zeros(0, np.int64)])))
            ids, codes = (pa.array(np.array(x, np.uint64).view(np.int64)) for x in (nodes, prints))
            columns = [batch.column(0), batch.column(1), ids, codes, pa.array(sizes, pa.int32()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "node", "fp", "n", "tokens"])

    needed = copy.select("row", F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return needed.mapInArrow(run, "row long, doc_id long, node long, fp long, n int, tokens array<long>")


def sketch_of(tokens: np.ndarray) -> np.ndarray:
    """``BITS`` bits as longs, one flipped for each token: two sketches differ in at most as many bits as the sets do in tokens."""
    odd = np.bincount(tokens & (BITS - 1), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def token_sets(copy: DataFrame, ranks: np.ndarray, words: int, nodes: DataFrame) -> DataFrame:
    """``node, n, sketch, tokens`` of all ``nodes``; a hash bucket's flag spares most others the work."""
    flags = np.zeros(FLAGS, bool)
    for row in nodes.select((F.col("node").bitwiseAND(F.lit(FLAGS - 1))).cast("int").alias("b")).distinct().collect():  # at most FLAGS rows
        flags[row["b"]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sets = [], []
            for text in batch.column(0).to_pylist():
                data = words_of(text)
                node = node_of(data)
                if data and flags[node & (FLAGS - 1)]:
                    ids.append(node)
                    sets.append(by_rarity(tokens_of(data, words), ranks))
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*sets, np.zeros(0, np.int64)])))
            bits = np.concatenate([*map(sketch_of, sets), np.zeros(0, np.int64)])
            sketches = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * (BITS // 64)), pa.array(bits))
            columns = [pa.array(np.array(ids, np.uint64).view(np.int64)), pa.array(np.diff(ends)), sketches, lists]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "sketch", "tokens"])

    found = copy.select(F.col("text").cast("string")).mapInArrow(run, "node long, n int, sketch array<long>, tokens array<long>")
    return found.join(nodes, "node", "left_semi").dropDuplicates(["node"])


def candidates(met: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that the tokens met in both prefixes leave possible, as in :func:`linededup.candidates`."""
    pairs = met.groupBy("a", "b", "n", "on").agg(F.count("*").alias("k"), F.max(F.struct("pos", "opos")).alias("last"))
    return pairs.where("9 * (k + least(n - last.pos, on - last.opos) - 1) >= 4 * (n + on)").select("a", "b")


def similar(copy: DataFrame, ranks: np.ndarray, words: int, pairs: DataFrame) -> DataFrame:
    """Those of the pairs ``a, b`` whose token sets are similar.

    Sketches drop most of the others, and none of these, before whole sets travel to each pair.
    """
    pairs = durable(pairs.where("a <> b").distinct())
    tokens = durable(token_sets(copy, ranks, words, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
    drawn = pairs.join(tokens.select(F.col("node").alias("a"), "n", "sketch"), "a")
    drawn = drawn.join(tokens.select(F.col("node").alias("b"), F.col("n").alias("on"), F.col("sketch").alias("osketch")), "b")
    differ = " + ".join(f"bit_count(sketch[{i}] ^ osketch[{i}])" for i in range(BITS // 64))
    pairs = durable(drawn.where(f"9 * ({differ}) <= n + on").select("a", "b"))
    mine = tokens.select(F.col("node").alias("a"), F.col("tokens").alias("t"))
    theirs = tokens.select(F.col("node").alias("b"), F.col("tokens").alias("o"))
    shared = F.size(F.array_intersect("t", "o"))
    return pairs.join(mine, "a").join(theirs, "b").where(5 * shared >= 4 * (F.size("t") + F.size("o") - shared)).select("a", "b")


def print_links(firsts: DataFrame, limit: int) -> DataFrame:
    """``a, b`` pairs of nodes that the index of :mod:`simhash` connects, a star for each fingerprint and links between stars."""
    prints = durable(firsts.groupBy("fp").agg(F.min("node").alias("node")))
    found = simhash.links(prints.select("fp"), limit)
    ends = found.join(prints.toDF("a", "na"), "a").join(prints.toDF("b", "nb"), "b")
    same = firsts.select("fp", F.col("node").alias("b")).distinct().join(prints.withColumnRenamed("node", "a"), "fp")
    return ends.select(F.col("na").alias("a"), F.col("nb").alias("b")).union(same.select("a", "b"))


def groups_of(placed: DataFrame, hot_rank: int) -> DataFrame:
    """``token, node, n, pos`` of the tokens with several nodes, with ``low`` and ``high``, the least and the greatest node.

    One exchange deals all rows by their token, frequent ones by a salt as well. Those are then brought together by partial
    aggregates and a join, which no single task has to read.
    """
    hot = F.expr(f"shiftright(token, 56) >= {hot_rank}")
    salt = F.when(hot, F.pmod(F.xxhash64("node"), F.lit(partitions(placed.sparkSession)))).otherwise(0)
    group, whole = Window.partitionBy("token", "salt"), F.struct("node", "n", "pos")
    met = placed.withColumn("salt", salt).withColumn("nodes", F.count("*").over(group)).where((F.col("nodes") > 1) | hot)
    met = met.withColumn("low", F.min(whole).over(group)).withColumn("high", F.max(whole).over(group))
    own = ["token", "node", "n", "pos"]
    met = durable(met.select(*own, "low", "high", hot.alias("hot")))
    cold = met.where("NOT hot").drop("hot")
    if not met.where("hot").limit(1).count():
        return cold
    ends = met.where("hot").groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low.node <> high.node")
    return durable(cold.unionByName(met.where("hot").select(*own).join(ends, "token")))


def links(copy: DataFrame, firsts: DataFrame, ranks: np.ndarray, hot_rank: int, words: int, limit: int) -> DataFrame:
    """``a, b`` links that connect exactly the nodes that pairs of similar nodes connect.

    Tables that only an earlier step reads go before the pairs of the last one are made, when the disk is fullest.
    """
    spark, began = copy.sparkSession, mark()
    nodes = firsts.groupBy("node").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    met = groups_of(nodes.select("node", "n", F.posexplode("tokens").alias("pos", "token")), hot_rank)

    near = "5 * on >= 4 * n AND 5 * n >= 4 * on AND 9 * (least(pos, opos) + least(n - pos, on - opos)) >= 4 * (n + on)"
    led = met.select(F.col("node").alias("a"), "n", "pos", F.explode(F.array_distinct(F.array("low", "high"))).alias("o"))
    led = led.select("a", "n", "pos", F.col("o.node").alias("b"), F.col("o.n").alias("on"), F.col("o.pos").alias("opos")).where(f"a <> b AND {near}")
    grouped = mark()
    first = durable(similar(copy, ranks, words, print_links(firsts, limit).union(candidates(led))))
    release(spark, grouped, but=1)
    roots = components(first)
    held = durable(met.select("token", "node", "n", "pos").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    release(spark, began, read_by=first.select("a").union(held.select("node")))
    release(spark, began, read_by=first.select("a").union(held.select("node")))
    apart = held.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("token")
    held = held.join(apart, "token")
    other = held.select("token", F.col("node").alias("b"), F.col("n").alias("on"), F.col("pos").alias("opos"), F.col("root").alias("oroot"))
    short = "CASE WHEN n < on OR n = on AND a < b THEN 9 * pos <= n ELSE 9 * opos <= on END"
    pairs = held.withColumnRenamed("node", "a").join(other, "token").where(f"a < b AND root <> oroot AND {near} AND {short}")
    return first.union(similar(copy, ranks, words, candidates(pairs)))


def keep_one(docs: DataFrame, words: int = WORDS, limit: int = 4, hot: int = HOT, floor: int = 10_000) -> DataFrame:
    """One row of each group, as :func:`simhash.keep_one` has it.

    The result reads a copy of ``docs`` in the shared folder, until :func:`common.release`; the other
    intermediate tables go before this returns, or when it fails.
    """
    spark, began = docs.sparkSession, mark()
    small_batches(spark)
    row = free_name(docs, "_near_row")
    try:
        copy = durable(docs.withColumn(row, F.monotonically_increasing_id()))
        own = mark()
        texts = copy.select(F.col(row).alias("row"), "doc_id", "text")
        counts = bucket_counts(texts, words)
        ranks = np.array([rank(n) for n in counts.tolist()], np.int64)
        firsts = durable(prefixes(texts, ranks, words))
        roots = components(links(texts, firsts, ranks, rank(max(floor, hot * int(counts.sum()) // BUCKETS)), words, limit))
        best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("best")
        nodes = firsts.groupBy("node").agg(best).join(roots, "node", "left")
        groups = nodes.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("best").alias("best"))
        gone = durable(firsts.select("row").join(groups.select("best.row"), "row", "left_anti").withColumnRenamed("row", row))
        release(spark, own, but=1)
    except BaseException:
        release(spark, began)
        raise
    few = gone.count() <= FEW
    return copy.join(F.broadcast(gone) if few else gone, row, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
