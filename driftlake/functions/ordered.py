"""Ordered look-ups along time that split a long series into time buckets.

A window over a whole device is one task. Here every window is over one device and time bucket; what
crosses a bucket's edge travels in a summary with one row for each bucket, which is small enough for a
window over the device. Results equal those of the plain windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEEK_S = 7 * 86_400


def bucket_of(at: str, width: int) -> Column:
    return F.floor(F.col(at) / F.lit(width)).cast("long")


def neighbours(probes: DataFrame, anchors: DataFrame, by: list[str], at: str, anchor_at: str, equal: str, width: int = WEEK_S) -> DataFrame:
    """Each probe with ``prev`` and ``next``, the anchors around it as structs that start with their time.

    ``equal``: ``"before"`` makes an anchor at the probe's very time its ``prev`` (the last of several),
    ``"after"`` its ``next`` (the first of several). Anchors with equal times are ordered by their other
    columns. A side without anchors is null.
    """
    rest = [c for c in anchors.columns if c not in by and c != anchor_at]
    found = anchors.where(F.col(anchor_at).isNotNull()).select(*by, F.col(anchor_at).cast("long").alias("_t"), F.struct(anchor_at, *rest).alias("_a"))
    kind = found.schema["_a"].dataType
    probe_side = 1 if equal == "before" else 0
    both = probes.withColumn("_t", F.col(at).cast("long")).withColumn("_a", F.lit(None).cast(kind)).withColumn("_s", F.lit(probe_side))
    both = both.unionByName(found.withColumn("_s", F.lit(1 - probe_side)), allowMissingColumns=True).withColumn("_b", bucket_of("_t", width))
    within = Window.partitionBy(*by, "_b").orderBy("_t", "_s", "_a")
    both = both.withColumn("_p", F.last("_a", True).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    both = both.withColumn("_n", F.first("_a", True).over(within.rowsBetween(0, Window.unboundedFollowing)))
    # the nearest anchors outside each bucket, from the anchors alone: steps between their buckets are filled
    # in, and beyond the first and last bucket the series' first and last anchor hold
    edges = found.withColumn("_b", bucket_of("_t", width)).groupBy(*by, "_b").agg(F.min("_a").alias("lo"), F.max("_a").alias("hi"))
    across = Window.partitionBy(*by).orderBy("_b")
    chain = edges.select(*by, "_b", "lo", "hi", F.lag("hi").over(across).alias("p"), F.lag("_b").over(across).alias("q"), F.lead("lo").over(across).alias("n"))
    inner = chain.where("q IS NOT NULL AND _b - q > 1").select(*by, F.explode(F.expr("sequence(q + 1, _b - 1)")).alias("_b"), F.col("p").alias("_before"), F.col("lo").alias("_after"))
    carried = chain.select(*by, "_b", F.col("p").alias("_before"), F.col("n").alias("_after")).unionByName(inner)
    ends = edges.groupBy(*by).agg(F.min("_b").alias("_b0"), F.max("_b").alias("_b1"), F.min("lo").alias("_first"), F.max("hi").alias("_last"))
    out = both.where(F.col("_s") == probe_side).join(carried, [*by, "_b"], "left").join(ends, by, "left")
    before = F.coalesce(F.col("_p"), F.col("_before"), F.when(F.col("_b") > F.col("_b1"), F.col("_last")))
    after = F.coalesce(F.col("_n"), F.col("_after"), F.when(F.col("_b") < F.col("_b0"), F.col("_first")))
    return out.select(*probes.columns, before.alias("prev"), after.alias("next"))


def lookups(probes: DataFrame, anchors: DataFrame, by: list[str], spots: dict[str, Column], anchor_at: str, width: int = WEEK_S) -> DataFrame:
    """``probes`` with, for each of ``spots``, a struct of the ``prev`` anchor (up to that time) and the ``next``.

    All times go through one pass of :func:`neighbours`.
    """
    several = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.cast("long").alias("at")) for n, c in spots.items()]))
    stacked = probes.withColumn("_x", several).select(*probes.columns, F.col("_x.name").alias("_name"), F.col("_x.at").alias("_at"))
    found = neighbours(stacked, anchors, by, "_at", anchor_at, "before", width)
    pair = F.struct("prev", "next")
    sides = [F.max(F.when(F.col("_name") == n, pair)).alias(n) for n in spots]
    joined = found.groupBy(*probes.columns).agg(F.count("*").alias("_n"), *sides)
    times = F.explode(F.sequence(F.lit(1), F.expr(f"cast(_n div {len(spots)} as int)")))  # equal probes were one group
    return joined.select(*probes.columns, *spots, times.alias("_i")).drop("_i")


def running_total(df: DataFrame, by: list[str], at: str, order: list[str], totals: dict[str, Column], width: int = WEEK_S) -> DataFrame:
    """``df`` with a running sum for each of ``totals``, in the order of ``at`` and ``order``."""
    marked = df.withColumn("_b", bucket_of(at, width))
    for name, value in totals.items():
        marked = marked.withColumn(f"_v_{name}", value)
    sums = marked.groupBy(*by, "_b").agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in totals])
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*by, "_b", *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in totals])
    within = Window.partitionBy(*by, "_b").orderBy(at, *order).rowsBetween(Window.unboundedPreceding, 0)
    out = marked.join(sums, [*by, "_b"])
    return out.select(*df.columns, *[(F.sum(f"_v_{n}").over(within) + F.col(f"_o_{n}")).alias(n) for n in totals])


def previous(df: DataFrame, by: list[str], at: str, order: list[str], name: str = "prev_at", width: int = WEEK_S) -> DataFrame:
    """``df`` with the time of the row before, in the order of ``at`` and ``order``; null for the first."""
    marked = df.withColumn("_b", bucket_of(at, width))
    tops = marked.groupBy(*by, "_b").agg(F.max(at).alias("_top"))
    tops = tops.select(*by, "_b", F.lag("_top").over(Window.partitionBy(*by).orderBy("_b")).alias("_carry"))
    within = Window.partitionBy(*by, "_b").orderBy(at, *order)
    out = marked.join(tops, [*by, "_b"])
    return out.select(*df.columns, F.coalesce(F.lag(at).over(within), F.col("_carry")).alias(name))
