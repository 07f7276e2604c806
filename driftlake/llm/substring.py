"""Substring dedup: words that lie in a window which also starts in an earlier document go.

Every window of 13 words gets a Rabin-Karp hash, a polynomial over the words' codes, and a second one of 32 bits. Shuffling
them all would cost several times the text, so a first pass only sends on each window's anchor: the least of the
hashes of the seven-word runs in it. Equal windows have equal anchors and neighbouring windows mostly share
one, so about a quarter as many rows show, without missing any, which windows can repeat between
documents. A second pass sends those windows' own hashes, Spark finds the least document of each,
and repeated windows merge into maximal removal intervals. Frequent anchors and their windows are dealt by a salt as
well, and brought together by partial aggregates and a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftlake.llm.common import durable, mark, partitions, release, small_batches, text_or_empty
from driftlake.llm.linededup import keyed_copy

WINDOW, ANCHOR = 13, 7
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BLOCK = 1 << 16
#: Hash buckets of anchors, and how many times the mean count makes a bucket a frequent one.
BUCKETS, HOT = 1 << 16, 16


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, _BLOCK + 1), _powers(_INVERSE, _BLOCK + 1)
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _rolling(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomial hash of codes[start:end] for spans inside one block."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(codes * _UP[: len(codes)], dtype=np.uint64)])
    return (sums[ends] - sums[starts]) * _DOWN[starts]


def word_codes(words: list[bytes]) -> np.ndarray:
    """A mixed 64-bit code for each word; words of over a block's bytes go through SHA-256."""
    out = np.empty(len(words), np.uint64)
    at = 0
    while at < len(words):
        end, size = at, 0
        while end < len(words) and size + len(words[end]) <= _BLOCK:
            size += len(words[end])
            end += 1
        if end == at:
            out[at] = int.from_bytes(hashlib.sha256(words[at]).digest()[:8], "little")
            at += 1
            continue
        lengths = np.fromiter(map(len, words[at:end]), np.int64, end - at)
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(words[at:end]), np.uint8).astype(np.uint64) + np.uint64(1)
        out[at:end] = _mix(_rolling(data, ends - lengths, ends) + lengths.astype(np.uint64))
        at = end
    return out


def runs(codes: np.ndarray, n: int) -> np.ndarray:
    """The Rabin-Karp hash of every run of ``n`` codes."""
    count = len(codes) - n + 1
    if count < 1:
        return np.zeros(0, np.uint64)
    out = np.empty(count, np.uint64)
    step = _BLOCK - n
    for at in range(0, count, step):
        part = codes[at : at + step + n - 1]
        starts = np.arange(len(part) - n + 1)
        out[at : at + len(starts)] = _mix(_rolling(part, starts, starts + n))
    return out


def checks(codes: np.ndarray, n: int) -> np.ndarray:
    """A second hash of every run, of 32 bits, over other codes of the words."""
    return (runs(_mix(codes ^ _SECOND), n) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def anchors(codes: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> np.ndarray:
    """For every window the least hash of the anchor runs in it."""
    hashes = runs(codes, anchor)
    count = len(codes) - window + 1
    if count < 1:
        return np.zeros(0, np.uint64)
    out = hashes[:count].copy()
    for shift in range(1, window - anchor + 1):
        np.minimum(out, hashes[shift : shift + count], out)
    return out


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def anchor_counts(rows: DataFrame, window: int, anchor: int) -> np.ndarray:
    """For each hash bucket of anchors the count of its rows over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = np.unique(anchors(word_codes(_split(text)), window, anchor))
                total += np.bincount((found & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["b", "n"])

    out = np.zeros(BUCKETS, np.int64)
    few = rows.select("text").coalesce(partitions(rows.sparkSession))  # each task sends on a row for each bucket
    for row in few.mapInArrow(run, "b int, n long").groupBy("b").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        out[row["b"]] = row["n"]
    return out


def meeting(rows: DataFrame, keys: list[str], keep: str) -> DataFrame:
    """The rows of ``key, hot`` and ``keys`` for which ``keep`` holds of the least and greatest ``key`` of their ``keys``, ``low`` and ``high``.

    What holds within a salt's part of a group holds in the whole, so only frequent rows for which it does not meet the group's ends.
    """
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("key", "row"), F.lit(partitions(rows.sparkSession)))).otherwise(0)
    group = Window.partitionBy(*keys, "salt")
    met = rows.withColumn("salt", salt).withColumn("low", F.min("key").over(group)).withColumn("high", F.max("key").over(group))
    met = durable(met.where(f"hot OR {keep}").drop("salt"))
    own = [c for c in rows.columns if c != "hot"]
    known, open_ = met.where(keep).select(*own), met.where(f"hot AND NOT ({keep})")
    if not open_.limit(1).count():
        return known
    ends = met.where("hot").groupBy(*keys).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return known.unionByName(open_.drop("low", "high").join(ends, keys).where(keep).select(*own))


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, keep_text: bool = True, hot: int = HOT, floor: int = 1000) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row; ``kept``: the words left, joined by one space.

    Windows are judged on the input. A null or short text has no windows and loses nothing. Rows that
    repeat a ``doc_id`` count as one document, so they don't remove each other's words, though each loses its own
    repeated windows; a row without a ``doc_id`` neither removes nor loses any. Only ``doc_id`` and ``text`` are read; an
    empty table gives an empty result. The result reads a copy of both in the shared folder, until
    :func:`common.release`; the other intermediate tables go before this returns, or when it fails.
    """
    spark, began = docs.sparkSession, mark()
    small_batches(spark)
    try:
        copy = keyed_copy(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "key", "row")
        own = mark()
        rows = copy.select("key", "row", "doc_id", text_or_empty().alias("text"))
        starts = durable(_starts(rows, window, anchor, hot, floor))
        release(spark, own, but=1)
    except BaseException:
        release(spark, began)
        raise

    def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            counts, removed, kept = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = _split(text)
                gone = np.zeros(len(words) + 1, np.int64)
                if lists[i].is_valid:
                    spots = lists[i].values.to_numpy()
                    np.add.at(gone, spots, 1)
                    np.add.at(gone, spots + window, -1)  # overlapping windows merge to intervals
                left = (np.cumsum(gone)[:-1] == 0).tolist()
                rest = [w for w, keep in zip(words, left, strict=True) if keep]
                counts.append(len(words))
                removed.append(len(words) - len(rest))
                whole = b" ".join(rest)
                kept.append(whole.decode() if keep_text else hashlib.sha256(whole).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])

    whole = rows.join(starts, ["key", "row"], "left").select("doc_id", "text", "starts")
    return whole.mapInArrow(cut_rows, "doc_id long, n_words long, n_removed long, kept string")


def _starts(rows: DataFrame, window: int, anchor: int, hot: int, floor: int) -> DataFrame:
    """``key, row, starts``: where the windows that an earlier document has begin."""
    named = rows.where("doc_id IS NOT NULL")
    counts = anchor_counts(named, window, anchor)
    often = counts >= max(floor, hot * int(counts.sum()) // BUCKETS)

    def is_hot(found: np.ndarray) -> np.ndarray:
        return often[(found & np.uint64(BUCKETS - 1)).astype(np.int64)]

    def anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(anchors(word_codes(_split(text)), window, anchor)) for text in batch.column(2).to_pylist()]
            sizes, whole = [len(x) for x in found], np.concatenate([*found, np.zeros(0, np.uint64)])
            keys = [pa.array(np.repeat(batch.column(i).to_numpy(), sizes)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(whole.view(np.int64)), *keys, pa.array(is_hot(whole))], ["anchor", "key", "row", "hot"])

    seen = named.select("key", "row", "text").mapInArrow(anchor_rows, "anchor long, key long, row long, hot boolean")
    shared = meeting(seen, ["anchor"], "low < high").groupBy("key", "row").agg(F.collect_set("anchor").alias("anchors"))  # of one document

    def window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            out: list[list[np.ndarray]] = [[] for _ in range(6)]
            for i, (key, row, text) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)):
                codes = word_codes(_split(text))
                of_window = anchors(codes, window, anchor)
                spots = np.flatnonzero(np.isin(of_window, lists[i].values.to_numpy().view(np.uint64)))
                n = len(spots)
                columns = (runs(codes, window)[spots].view(np.int64), checks(codes, window)[spots], np.full(n, key, np.int64), np.full(n, row, np.int64), spots.astype(np.int32), is_hot(of_window[spots]))
                for column, values in zip(out, columns, strict=True):
                    column.append(values)
            kinds = (np.int64, np.int32, np.int64, np.int64, np.int32, np.bool_)
            arrays = [pa.array(np.concatenate([*x, np.zeros(0, k)])) for x, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["hash", "check", "key", "row", "spot", "hot"])

    held = named.join(shared, ["key", "row"]).select("key", "row", "text", "anchors")
    windows = held.mapInArrow(window_rows, "hash long, check int, key long, row long, spot int, hot boolean")
    repeated = meeting(windows, ["hash", "check"], "low < key")
    return repeated.groupBy("key", "row").agg(F.collect_set("spot").alias("starts"))
