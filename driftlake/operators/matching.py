"""Temporal matches between a series and its anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlake.functions.ordered import WEEK_S, lookups, neighbours, running_total
from driftlake.session import settled


def nearest(probes: DataFrame, candidates: DataFrame, by: list[str], at: str, candidate_at: str, tolerance: int, strict: bool = False, width: int = WEEK_S) -> DataFrame:
    """Each probe with ``match``, the nearest candidate, and ``distance``; both null beyond ``tolerance``.

    Of two at equal distance the earlier wins; of several at one time the last by its other columns on
    the earlier side, the first on the later. ``strict`` excludes the tolerance itself.
    """
    found = neighbours(probes, candidates, by, at, candidate_at, "before", width)
    back, ahead = F.col(at) - F.col("prev")[candidate_at], F.col("next")[candidate_at] - F.col(at)
    chosen = F.when(F.col("next").isNull() | (back <= ahead), F.col("prev")).otherwise(F.col("next"))
    found = found.withColumn("match", chosen).withColumn("distance", F.abs(F.col(at) - F.col("match")[candidate_at]))
    inside = F.col("distance") < tolerance if strict else F.col("distance") <= tolerance
    return found.select(*probes.columns, F.when(inside, F.col("match")).alias("match"), F.when(inside, F.col("distance")).alias("distance"))


def quality_label(delta: Column) -> Column:
    """How good a match at a distance in seconds is."""
    return F.when(delta <= 10, "excellent").when(delta <= 300, "good").when(delta <= 3600, "acceptable").when(delta.isNotNull(), "poor")


def quality_confidence(label: Column) -> Column:
    """The confidence that belongs to a match label."""
    values = {"excellent": 1.0, "good": 0.9, "acceptable": 0.7, "poor": 0.5, "interpolated": 0.7, "no_nearby_reference": 0.3, "no_reference_data": 0.1}
    out = F.lit(0.5)
    for name, value in values.items():
        out = F.when(label == name, value).otherwise(out)
    return out


def with_sums(anchors: DataFrame, by: list[str], width: int = WEEK_S) -> DataFrame:
    """Anchors ``unix, received`` with their drift in microseconds, and running counts and drift sums."""
    drift = (F.col("received") - F.col("unix") * 1_000_000).cast("long")
    one = anchors.select(*by, "unix", "received").withColumn("drift", drift)
    return running_total(one, by, "unix", ["received"], {"seen": F.lit(1), "drifts": F.col("drift")}, width)


def between(low: str, high: str, name: str) -> Column:
    """A sum over the anchors after the look-up ``low`` up to the look-up ``high``, from running sums."""
    return (F.coalesce(F.col(high)["prev"][name], F.lit(0)) - F.coalesce(F.col(low)["prev"][name], F.lit(0))).cast("long")


def range_totals(probes: DataFrame, summed: DataFrame, by: list[str], low: Column, high: Column, count: str, total: str | None = None, width: int = WEEK_S) -> DataFrame:
    """``probes`` with the number (and drift sum) of anchors with ``unix`` in [low, high]."""
    out = lookups(probes, summed, by, {"_under": low - 1, "_upto": high}, "unix", width)
    columns = [between("_under", "_upto", "seen").alias(count)] + ([between("_under", "_upto", "drifts").alias(total)] if total else [])
    return out.select(*probes.columns, *columns)


def closest_of(at: Column, hit: str, low: str, high: str, horizon: int) -> dict[str, Column]:
    """The closest anchor of a probe whose look-ups of itself and its surroundings are at hand."""
    prev, after = F.col(hit)["prev"], F.col(hit)["next"]
    best = F.when(after.isNull() | (at - prev["unix"] <= after["unix"] - at), prev).otherwise(after)
    distance = F.abs(at - best["unix"])
    inside = distance <= horizon
    near = between(low, high, "seen")
    mean = F.round(at * 1e6 + between(low, high, "drifts") / F.nullif(near, F.lit(0))).cast("long")
    label = F.when(best.isNull(), "no_reference_data").when(inside, quality_label(distance)).when(near > 0, "interpolated").otherwise("no_nearby_reference")
    return {
        "matched_unix": F.when(inside, best["unix"]),
        "match_received": F.when(inside, best["received"]).when(near > 0, mean),
        "match_delta": F.when(inside, distance),
        "match_quality": label,
    }


def closest_anchor(probes: DataFrame, anchors: DataFrame, by: list[str], at: str, horizon: int = 86_400, around: int = 7 * 86_400, width: int = WEEK_S) -> DataFrame:
    """Each probe with its closest anchor: ``matched_unix, match_received, match_delta, match_quality``.

    Beyond ``horizon`` seconds the mean drift of the anchors within ``around`` seconds stands in
    (``interpolated``); without any there is no time (``no_nearby_reference``, or ``no_reference_data``
    where the series has no anchor at all).
    """
    x, summed = F.col(at), with_sums(anchors, by, width)
    found = neighbours(probes, summed, by, at, "unix", "before", width)
    near = F.least(x - F.col("prev.unix"), F.col("next.unix") - x) <= horizon
    nothing = F.lit(None).cast(found.select(F.struct("prev", "next").alias("s")).schema["s"].dataType)
    found = settled(found.select(*probes.columns, F.struct("prev", "next").alias("_hit"), (~near).alias("_far")))
    # only probes without an anchor within the horizon look up what lies around them
    own = [*probes.columns, "_hit"]
    close = found.where("NOT coalesce(_far, false)").select(*own, nothing.alias("_low"), nothing.alias("_high"))
    far = lookups(found.where("_far").select(*own), summed, by, {"_low": x - around - 1, "_high": x + around}, "unix", width)
    columns = closest_of(x, "_hit", "_low", "_high", horizon)
    return close.unionByName(far).select(*probes.columns, *[c.alias(n) for n, c in columns.items()])


def usable_counts(rows: DataFrame, by: list[str], least: float) -> DataFrame:
    """The rows of at least this confidence in each group, which can serve as anchors of others."""
    return rows.where(F.col("confidence") >= least).groupBy(*by).agg(F.count("*").alias("n"))
