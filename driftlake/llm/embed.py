"""Embedding near-duplicates by Euclidean p-stable hashing and exact cosine checks.

Vectors are scaled to unit length; a table hashes them by quantised random projections,
``floor((a . v + b) / width)``, several to a key. Equal vectors of a label are one node with a weight,
so copies are never paired. Vectors that share a label and a key in some table are candidates, and
their cosine in double precision decides. A pair counts in the first table that brings it together, so
link counts are exact sums without a table of pairs: a bucket sends on, for each vector, the weight
of its new partners, and a star for each connected group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.common import durable
from driftlake.llm.components import components

#: With these, a pair at cosine 0.93 shares one of the tables with a probability of 0.99.
TABLES, PROJECTIONS, WIDTH, SEED = 16, 8, 2.0, 11


def projections(dimension: int, tables: int, each: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian directions and uniform offsets, the same in every process."""
    random = np.random.default_rng([SEED, dimension])
    return random.standard_normal((dimension, tables * each)), random.uniform(0, width, tables * each)


def bucket_keys(units: np.ndarray, tables: int, each: int, width: float) -> np.ndarray:
    """One long for each vector and table, mixed from its quantised projections."""
    directions, offsets = projections(units.shape[1], tables, each, width)
    cells = np.floor((units @ directions + offsets) / width).astype(np.int64).view(np.uint64).reshape(len(units), tables, each)
    keys = np.zeros((len(units), tables), np.uint64)
    for i in range(each):
        keys = (keys ^ cells[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def unit(values: list | None) -> np.ndarray | None:
    """The vector at unit length in double precision; None if it links with nothing."""
    if not values or any(x is None for x in values):
        return None
    vector = np.array(values, np.float64)
    if not np.isfinite(vector).all() or not (top := np.abs(vector).max()):
        return None
    vector = vector / top  # squares then neither overflow nor vanish
    return vector / np.sqrt(vector @ vector)


def compare(units: np.ndarray, weights: np.ndarray, keys: np.ndarray, table: int, least: float, apart: np.ndarray | None):
    """New links of one bucket: partner weights of each row and a label for each connected group."""
    n = len(units)
    gained, labels = np.zeros(n, np.int64), np.arange(n)
    for at in range(0, n, 256):
        rows = np.arange(at, min(at + 256, n))
        near = units[rows] @ units.T >= least
        near[np.arange(len(rows)), rows] = False
        if apart is not None:
            near &= apart[rows][:, None] != apart[None, :]
        if not near.any():
            continue
        new = near.copy()
        for earlier in range(table):
            new &= keys[rows, earlier][:, None] != keys[None, :, earlier]
        gained[rows] += new @ weights
        a, b = np.nonzero(near)
        a = rows[a]
        while len(a):
            x, y = labels[a], labels[b]
            differ = x != y
            if not differ.any():
                break
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
            while not (labels[labels] == labels).all():
                labels = labels[labels]
    return gained, labels


def near_duplicates(
    vectors: DataFrame, least: float = 0.93, tables: int = TABLES, each: int = PROJECTIONS, width: float = WIDTH, most: int = 4000
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Rows link only under equal labels that are not null. Vectors that are null, empty or zero, or hold
    null or non-finite components, and vectors of different length, link with nothing. Repeated rows
    are copies of each other and link. A null ``vec_id`` names no component unless all its members are null, and is
    not kept. Only ``vec_id``, ``embedding`` and ``label`` are read; an empty table gives an empty
    result. A bucket with over ``most`` distinct vectors is cut into chunks, and each pair of chunks is
    compared in a task of its own.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label")
    )
    rows = rows.withColumn("node", F.when(F.col("label").isNotNull() & F.col("embedding").isNotNull(), F.unhex(F.sha2(F.to_json(F.struct("label", "embedding")), 256))))
    rows = durable(rows)
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("vec_id").alias("first"), F.count("*").alias("weight"))
    ids = rows.where("node IS NOT NULL").groupBy("node").agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"))

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [unit(v) for v in batch.column(2).to_pylist()]
            groups: dict[int, list[int]] = {}
            for i, u in enumerate(units):
                if u is not None:
                    groups.setdefault(len(u), []).append(i)
            for found in groups.values():
                block = np.array([units[i] for i in found])
                keys = bucket_keys(block, tables, each, width)
                at = pa.array(found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array([u.tobytes() for u in block], pa.binary()), pa.array([k.tobytes() for k in keys], pa.binary()), pa.array(list(keys), pa.list_(pa.int64()))],
                    ["node", "label", "unit", "keys", "k"],
                )

    hashed = ids.select("node", "label", "embedding").mapInArrow(hash_rows, "node binary, label string, unit binary, keys binary, k array<long>")
    hashed = durable(hashed.join(nodes, "node").withColumn("number", F.monotonically_increasing_id()))
    dealt = hashed.select("number", "label", F.length("unit").alias("d"), F.posexplode("k").alias("t", "k"))
    sizes = dealt.groupBy("label", "d", "t", "k").count().where(F.col("count") > 1)
    held = dealt.join(sizes, ["label", "d", "t", "k"]).withColumn("m", F.ceil(F.col("count") / most).cast("int"))
    held = held.withColumn("c", F.pmod(F.xxhash64("number"), F.col("m")).cast("int")).withColumn("o", F.explode(F.expr("sequence(0, m - 1)")))
    held = held.select("number", F.xxhash64("label", "d", "t", "k").alias("bucket"), "t", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "c")
    spread = held.join(hashed.select("number", "unit", "keys", "weight"), "number").select("bucket", "t", "i", "j", "c", "number", "weight", "unit", "keys")
    spread = spread.repartition("bucket", "t", "i", "j").sortWithinPartitions("bucket", "t", "i", "j")

    def link_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(got: pa.Table) -> pa.RecordBatch:
            number, weight = got["number"].to_numpy(), got["weight"].to_numpy()
            place = np.stack([got[c].to_numpy().astype(np.int64) for c in ("bucket", "t", "i", "j")], axis=1)
            chunk = got["c"].to_numpy()
            units, keys = got["unit"].to_pylist(), got["keys"].to_pylist()
            out: list[list[np.ndarray]] = [[], [], []]
            bounds = np.flatnonzero((place[1:] != place[:-1]).any(1)) + 1
            for a, z in zip([0, *bounds.tolist()], [*bounds.tolist(), len(number)], strict=True):
                if z - a < 2:
                    continue
                block = np.frombuffer(b"".join(units[a:z])).reshape(z - a, -1)
                table_keys = np.frombuffer(b"".join(keys[a:z]), np.int64).reshape(z - a, -1)
                apart = chunk[a:z] if place[a, 2] != place[a, 3] else None
                gained, labels = compare(block, weight[a:z], table_keys, int(place[a, 1]), least, apart)
                linked = labels != np.arange(z - a)
                some = (gained > 0) | linked
                out[0].append(number[a:z][some])
                out[1].append(number[a:z][labels[some]])
                out[2].append(gained[some])
            columns = [pa.array(np.concatenate([*x, np.zeros(0, np.int64)])) for x in out]
            return pa.RecordBatch.from_arrays(columns, ["number", "root", "gained"])

        for batch in batches:
            if not batch.num_rows:
                continue
            place = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)], axis=1)
            held.append(batch)
            edge = np.flatnonzero((place[1:] != place[:-1]).any(1))
            if len(edge):
                cut = int(edge[-1]) + 1
                yield flush(pa.Table.from_batches([*held[:-1], batch.slice(0, cut)]))
                held = [batch.slice(cut)]
        if held:
            yield flush(pa.Table.from_batches(held))

    found = durable(spread.mapInArrow(link_rows, "number long, root long, gained long"))
    gained = found.groupBy("number").agg(F.sum("gained").alias("gained"))
    groups = components(found.select(F.col("number").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "number")
    named = groups.join(hashed.select("number", "first"), "number")
    least_id = named.groupBy("root").agg(F.min("first").alias("least"))
    linked = named.join(least_id, "root").select("number", "least")
    per_node = (
        hashed.select("node", "number", "first", "weight").join(gained, "number", "left").join(linked, "number", "left")
        .select("node", (F.col("weight") - 1 + F.coalesce("gained", F.lit(0))).alias("n_links"), F.coalesce("least", "first").alias("component_id"))
    )
    out = rows.select("vec_id", "node").join(per_node, "node", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
