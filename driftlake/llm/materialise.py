"""Training-order materialisation: token ids in fixed-stride binary shards, in a keyed random order.

The documents' ids, each with a closing id, form one stream in the order of ``doc_id``, cut into sequences of ``length``
ids; only the last sequence is padded. A document's place in the stream is a running sum of lengths, made from one small
row for each document, so neither texts nor ids are sorted, and the stream doesn't depend on how the files are split.
Sequences are numbered without gaps, and a keyed Feistel permutation of the numbers, cycle-walking where its domain of
even bits is larger, gives each its global slot: no sort by a random key, no table of the order, and any slot can be
computed alone. A shard holds a fixed number of slots. Documents are cut, placed, gathered by shard and compressed in one
call before the shuffle, since each call of its own is one more Python worker beside every task; range partitions of several shards put them in place and write one file for each, through Spark's committer, so a
lost task leaves no half file. A record is ``2 * length`` bytes of little-endian ids, padded with id 0,
two bytes of length and a newline, so a reader that stopped after slot n goes on at byte
``(n mod rows) * stride`` of shard ``n div rows``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftlake.llm.common import durable, mark, partitions, release, shared_dir, small_batches
from driftlake.llm.tokens import default_vocabulary, word_bpe

ROUNDS = 6
#: Shards that a range partition writes, of 8 MB each by default.
SHARDS_EACH = 16
#: The id after each document, four bytes as the tokenizer gives them.
CLOSING = bytes(4)


def stride(length: int) -> int:
    return 2 * length + 3


def feistel(number: int, total: int, key: int) -> int:
    """The slot of a sequence number: the same permutation as :func:`slots`, one value at a time."""
    half = max(1, ((total - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = number >> half, number & mask
        for r in range(ROUNDS):
            mixed = (right * 0x9E3779B1 + (key + r) * 0x85EBCA6B) & 0x7FFFFFFF
            mixed = ((mixed ^ (mixed >> 15)) * 0x2C1B3C6D) & 0x7FFFFFFFFFFFFFFF
            mixed = (mixed ^ (mixed >> 17)) & mask
            left, right = right, left ^ mixed
        number = (left << half) | right
        if number < total:
            return number


def slots(numbers: np.ndarray, total: int, key: int) -> np.ndarray:
    """:func:`feistel` of many numbers; those outside the domain walk on until they are in it."""
    half = max(1, ((total - 1).bit_length() + 1) // 2)
    mask = np.int64((1 << half) - 1)
    out = numbers.astype(np.int64).copy()
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> half, out[walking] & mask
        for r in range(ROUNDS):
            mixed = ((right & 0x7FFFFFFF) * 0x9E3779B1 + (key + r) * 0x85EBCA6B) & 0x7FFFFFFF
            mixed = ((mixed ^ (mixed >> 15)) * 0x2C1B3C6D) & 0x7FFFFFFFFFFFFFFF
            mixed = (mixed ^ (mixed >> 17)) & mask
            left, right = right, left ^ mixed
        out[walking] = (left << half) | right
        walking = walking[out[walking] >= total]
    return out


def coded(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids, n``: each document's ids, two bytes each, with the closing id 0, and their number."""
    small_batches(docs.sparkSession)
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_bpe(path)
        for batch in batches:
            ids = tokenizer.many(batch.column(1).to_pylist())
            wide = np.frombuffer(b"".join([x + CLOSING for x in ids]), "<u4")
            if len(wide) and int(wide.max()) >= 1 << 16:
                raise ValueError("ids do not fit into two bytes")
            n = np.array([len(x) // 4 + 1 for x in ids], np.int64)
            ends = np.cumsum([0, *(2 * n)]).astype(np.int32)
            narrow = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(wide.astype("<u2"))])
            yield pa.RecordBatch.from_arrays([batch.column(0), narrow, pa.array(n)], ["doc_id", "ids", "n"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary, n long")


def starts_of(tokens: DataFrame) -> DataFrame:
    """``row, begin``: where each document's ids begin in the stream, by ``doc_id``, nulls first, then by ``h``, a hash of the ids.

    Ranges of the order are summed each by itself and offset by the sums of those before them.
    """
    light = tokens.select("row", "doc_id", "h", "n")
    ranged = durable(light.repartitionByRange(partitions(tokens.sparkSession), "doc_id", "h", "row").withColumn("part", F.spark_partition_id()))
    sums = ranged.groupBy("part").agg(F.sum("n").alias("n"))  # a row for each range
    before = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    within = Window.partitionBy("part").orderBy("doc_id", "h", "row").rowsBetween(Window.unboundedPreceding, 0)
    begun = ranged.select("row", "part", (F.sum("n").over(within) - F.col("n")).alias("inside"))
    return begun.join(F.broadcast(before), "part").select("row", (F.col("before") + F.col("inside")).alias("begin"))


def cuts(begin: np.ndarray, n: np.ndarray, length: int, total: int, rows: int, key: int) -> dict[str, np.ndarray]:
    """The pieces of documents of ``n`` ids that begin there in the stream, in order, each with the number ``at`` of its document."""
    first = begin // length
    count = np.where(n > 0, (begin + n - 1) // length - first + 1, 0)
    at = np.repeat(np.arange(len(n)), count)
    piece = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    sequence = first[at] + piece
    low = np.maximum(begin[at], sequence * length)
    high = np.minimum(begin[at] + n[at], (sequence + 1) * length)
    slot = slots(sequence, total, key)
    found = {"piece": piece, "start": low - begin[at], "offset": low - sequence * length, "length": high - low, "sequence": sequence, "slot": slot}
    return {"at": at} | found | {"shard": slot // rows, "place": slot % rows}


MANIFEST = "doc_id long, piece int, start long, offset int, length int, ids_crc32 long, sequence long, slot long, shard int, place int"


def manifest(placed: DataFrame, length: int, total: int, rows: int, key: int) -> DataFrame:
    """A row for each piece of the documents of ``doc_id, ids, begin``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in MANIFEST.split(", ")]
        kinds = [pa.int64() if x.endswith("long") else pa.int32() for x in MANIFEST.split(", ")]
        for batch in batches:
            doc_ids, ids, begin = batch.columns
            n = np.array([len(x.as_buffer()) // 2 for x in ids], np.int64)
            found = cuts(begin.to_numpy(), n, length, total, rows, key)
            views = [memoryview(x.as_buffer()) for x in ids]
            spans = zip(found["at"].tolist(), (2 * found["start"]).tolist(), (2 * (found["start"] + found["length"])).tolist(), strict=True)
            sums = np.array([zlib.crc32(views[i][a:b]) for i, a, b in spans], np.int64)
            columns = [doc_ids.take(pa.array(found["at"])), *(pa.array(found.get(x, sums), k) for x, k in zip(names[1:], kinds[1:], strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return placed.select("doc_id", "ids", "begin").mapInArrow(run, MANIFEST)


def gather(placed: DataFrame, length: int, total: int, rows: int, key: int) -> DataFrame:
    """``shard, run``: the pieces of a batch of ``ids, begin`` that go to one shard, with their places, offsets and lengths, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            views = [memoryview(x.as_buffer()) for x in batch.column(0)]
            n = np.array([len(x) // 2 for x in views], np.int64)
            found = cuts(batch.column(1).to_numpy(), n, length, total, rows, key)
            shard, at = found["shard"], found["at"].tolist()
            low, high = (2 * found["start"]).tolist(), (2 * (found["start"] + found["length"])).tolist()
            spots = np.stack([found[x] for x in ("place", "offset", "length")], axis=1).astype("<i4")
            order = np.argsort(shard, kind="stable")
            groups = np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(order) else []
            runs = [squeeze.compress(b"".join((len(g).to_bytes(4, "little"), spots[g].tobytes(), *(views[at[i]][low[i] : high[i]] for i in g)))) for g in groups]
            yield pa.RecordBatch.from_arrays([pa.array([int(shard[g[0]]) for g in groups], pa.int32()), pa.array(runs, pa.binary())], ["shard", "run"])

    return placed.select("ids", "begin").mapInArrow(run, "shard int, run binary")


def assemble(runs: DataFrame, length: int) -> DataFrame:
    """``shard, content`` from runs that are ordered by shard; at most one shard of fixed size is held."""
    size = stride(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor()
        held, content, used = None, bytearray(), {}

        def out() -> pa.RecordBatch:
            for place, n in used.items():
                end = (place + 1) * size
                content[end - 3 : end] = n.to_bytes(2, "little") + b"\n"
            return pa.RecordBatch.from_arrays([pa.array([held], pa.int32()), pa.array([bytes(content)], pa.binary())], ["shard", "content"])

        for batch in batches:
            for shard, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if shard != held:
                    if held is not None:
                        yield out()
                    held, content, used = shard, bytearray(), {}
                data = expand.decompress(packed)
                n = int.from_bytes(data[:4], "little")
                at = 4 + 12 * n
                for place, offset, count in np.frombuffer(data[4:at], "<i4").reshape(-1, 3).tolist():
                    if len(content) < (place + 1) * size:
                        content.extend(bytes((place + 1) * size - len(content)))
                    begin = place * size + 2 * offset
                    content[begin : begin + 2 * count] = data[at : at + 2 * count]
                    used[place] = max(used.get(place, 0), offset + count)
                    at += 2 * count
        if held is not None:
            yield out()

    return runs.mapInArrow(run, "shard int, content binary")


def materialise(docs: DataFrame, path: str, length: int = 2048, rows: int = 2048, key: int = 20, vocabulary: str | None = None) -> DataFrame:
    """Write the shards to ``path/shards/shard=N``, one file of records each, and return the manifest.

    It has a row for each document's piece in a sequence: ``doc_id, piece, start, offset, length, ids_crc32, sequence, slot,
    shard, place``. A null or empty text is its closing id; texts of any length are cut, never shortened; rows without a
    ``doc_id`` come first; repeated rows are all written, next to each other; rows that share a ``doc_id`` follow a hash of
    their ids. Only ``doc_id`` and ``text`` are read; an empty table writes no shard. ``length`` is at most 65,535. The manifest
    reads the token table in the shared folder, until :func:`common.release`.
    """
    if not 0 < length < 1 << 16:
        raise ValueError("a sequence has 1 to 65,535 ids")
    spark, began = docs.sparkSession, mark()
    try:
        numbered = coded(docs, vocabulary).withColumn("row", F.monotonically_increasing_id())
        tokens = durable(numbered.withColumn("h", F.xxhash64("ids")), "row")  # so that only the cutting reads the ids again
        total = tokens.agg(F.sum("n")).first()[0] or 0
        count = -(-total // length)
        placed = tokens.join(starts_of(tokens), "row")
        if shards := -(-count // rows):
            # the partition of a shard is known, so no sample of the runs has to be gathered for ranges
            each = min(SHARDS_EACH, -(-shards // partitions(spark)))
            dealt = gather(placed, length, count, rows, key).repartitionById(-(-shards // each), F.expr(f"shard div {each}").cast("int"))
            runs = dealt.sortWithinPartitions("shard")
            # the last record's own newline is the line's end, so the text writer puts out the bytes as they are
            body = F.expr("substring(content, 1, length(content) - 1)").cast("string").alias("value")
            assemble(runs, length).select("shard", body).write.partitionBy("shard").text(f"{path}/shards", lineSep="\n")
    except BaseException:
        release(spark, began)
        raise
    return manifest(placed, length, max(count, 1), rows, key)


def read_slots(spark: SparkSession, path: str, first: int, count: int, length: int = 2048, rows: int = 2048) -> DataFrame:
    """``slot, length`` and the raw ``ids`` of a run of slots: how a stopped reader goes on."""
    size = stride(length)
    wanted = list(range(first // rows, (first + count - 1) // rows + 1))
    files = spark.read.format("binaryFile").load(f"{path}/shards").where(F.col("shard").isin(wanted))
    spot: Column = F.explode(F.expr(f"sequence(0, cast(length(content) div {size} as int) - 1)"))
    rows_of = files.select("shard", "content", spot.alias("place"))
    slot = F.col("shard").cast("long") * rows + F.col("place")
    record = F.expr(f"substring(content, place * {size} + 1, {size})")
    out = rows_of.where(slot.between(first, first + count - 1)).select(slot.alias("slot"), record.alias("record"))
    high, low = (F.conv(F.hex(F.expr(f"substring(record, {2 * length + i}, 1)")), 16, 10).cast("int") for i in (2, 1))
    used = high * 256 + low
    return out.select("slot", used.alias("length"), F.col("record").substr(F.lit(1), 2 * used).alias("ids"))


def scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/sequences-{uuid4().hex}"
