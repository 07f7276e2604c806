"""Clock alignment: corrected times and confidences from the anchors of a device.

Rows carry ``rtc``, the device's time in microseconds, ``segment_id`` and ``position``; anchors carry
``unix`` in seconds and ``received`` in microseconds. All strategies of all segments are one plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlake.config import Settings
from driftlake.functions.ordered import WEEK_S, lookups, neighbours
from driftlake.operators.matching import between, closest_anchor, closest_of, quality_confidence, with_sums

STRATEGIES = ("adaptive", "anchor", "interpolate", "linear_drift")


def interpolate(rows: DataFrame, anchors: DataFrame, by: list[str], at: str = "unix_time", width: int = WEEK_S) -> DataFrame:
    """``rows`` with ``interp_time``, ``interp_drift`` and ``interp_confidence``: piecewise-linear drift, flat beyond the ends."""
    plain = anchors.select(*by, "unix", ((F.col("received") - F.col("unix") * 1_000_000) / 1e6).alias("drift"))
    found = neighbours(rows, plain, by, at, "unix", "after", width)
    x, p, n = F.col(at), F.col("prev"), F.col("next")
    drift = (
        F.when(n.isNull(), p["drift"]).when(p.isNull() | (n["unix"] == x), n["drift"])
        .otherwise((n["drift"] - p["drift"]) / (n["unix"] - p["unix"]) * (x - p["unix"]) + p["drift"])
    )
    beyond = F.when(n.isNull(), x - p["unix"]).when(p.isNull(), n["unix"] - x)
    gap = n["unix"] - p["unix"]
    confidence = (
        F.when(p.isNull() & n.isNull(), None)
        .when(p.isNull() & (n["unix"] == x), 0.7)
        .when(beyond < 3_600, 0.5).when(beyond < 86_400, 0.3).when(beyond.isNotNull(), 0.2)
        .when(gap < 3_600, 0.9).when(gap < 7_200, 0.85).when(gap < 14_400, 0.8).when(gap < 86_400, 0.7).otherwise(0.5)
    )
    time = F.round((x + F.col("interp_drift")) * 1e6).cast("long")
    out = found.withColumn("interp_drift", drift).withColumn("interp_confidence", confidence).withColumn("interp_time", time)
    return out.select(*rows.columns, "interp_time", "interp_drift", "interp_confidence")


def decide(rows: DataFrame, anchors: DataFrame, by: list[str], settings: Settings = Settings(), width: int = WEEK_S) -> DataFrame:
    """One row of facts for each segment and position: both ends, their closest anchors, the anchors in range."""
    group = [*by, "segment_id", "position"]
    ends = rows.groupBy(*group).agg(F.min("rtc").alias("first_rtc"), F.max("rtc").alias("last_rtc"))
    ends = ends.withColumn("first_unix", F.expr("first_rtc div 1000000")).withColumn("last_unix", F.expr("last_rtc div 1000000"))
    pad, around = settings.range_padding_s, settings.neighbour_window_s
    spots = {"_start": F.col("first_unix") - pad - 1, "_end": F.col("last_unix") + pad}
    for end in ("first", "last"):
        x = F.col(f"{end}_unix")
        spots |= {f"_{end}": x, f"_{end}_low": x - around - 1, f"_{end}_high": x + around}
    found = lookups(ends, with_sums(anchors, by, width), by, spots, "unix", width)
    facts = {"anchors_in_range": between("_start", "_end", "seen")}
    for end in ("first", "last"):
        columns = closest_of(F.col(f"{end}_unix"), f"_{end}", f"_{end}_low", f"_{end}_high", settings.match_horizon_s)
        facts |= {f"{end}_{n}": c for n, c in columns.items()}
    ends = found.select(*ends.columns, *[c.alias(n) for n, c in facts.items()])
    good = [F.coalesce(F.col(f"{e}_match_quality").isin("excellent", "good", "acceptable"), F.lit(False)).cast("int") for e in ("first", "last")]
    few = F.when(good[0] + good[1] == 2, "linear_drift").when(good[0] + good[1] == 1, "anchor").otherwise("interpolate")
    return ends.withColumn("choice", F.when(F.col("anchors_in_range") >= settings.min_anchors_in_range, "interpolate").otherwise(few))


def align(rows: DataFrame, anchors: DataFrame, by: list[str], strategy: str = "adaptive", settings: Settings = Settings(), width: int = WEEK_S) -> DataFrame:
    """``rows`` with ``unix_time, aligned, confidence, method, reference_delta_seconds, drift_rate, drift_seconds``.

    By default an anchor is moved by its distance from the row that it is matched with;
    ``strict_reference`` takes its time as the row's own.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")
    base = interpolate(rows.withColumn("unix_time", F.expr("rtc div 1000000")), anchors, by, width=width)
    facts = decide(rows, anchors, by, settings, width)

    def reference(end: str) -> Column:
        moved = F.col(f"{end}_match_received") + (F.col(f"{end}_rtc") - F.col(f"{end}_matched_unix") * 1_000_000)
        return F.col(f"{end}_match_received") if settings.strict_reference else F.coalesce(moved, F.col(f"{end}_match_received"))

    duration = F.col("last_rtc") - F.col("first_rtc")
    facts = facts.withColumn("t0", reference("first")).withColumn("t1", reference("last"))
    facts = facts.withColumn("rate", F.when(duration != 0, (F.col("t1") - F.col("t0") - duration) / duration))
    wanted = F.col("choice") if strategy == "adaptive" else F.lit(strategy)
    used = (
        F.when((wanted == "linear_drift") & F.col("rate").isNotNull(), "linear_drift")
        .when(wanted.isin("linear_drift", "anchor") & F.col("t0").isNotNull(), "anchor")
        .otherwise("interpolate")
    )
    keep = [*by, "segment_id", "position", "first_rtc", "t0", "rate", "first_match_quality", "first_match_delta", used.alias("used")]
    out = base.join(facts.select(*keep), [*by, "segment_id", "position"])
    elapsed = F.col("rtc") - F.col("first_rtc")
    linear = F.col("rtc") + F.round(elapsed * F.col("rate")).cast("long") + (F.col("t0") - F.col("first_rtc"))
    is_linear, is_anchor = F.col("used") == "linear_drift", F.col("used") == "anchor"
    out = out.withColumn("aligned", F.when(is_linear, linear).when(is_anchor, F.col("t0") + elapsed).otherwise(F.col("interp_time")))
    return out.select(
        *rows.columns,
        "unix_time",
        "aligned",
        F.when(is_linear, 0.85).when(is_anchor, quality_confidence(F.col("first_match_quality"))).otherwise(F.col("interp_confidence")).alias("confidence"),
        F.when(is_linear, "linear_drift").when(is_anchor, "anchor").otherwise("interpolated_drift").alias("method"),
        F.when(is_anchor, F.col("first_match_delta")).alias("reference_delta_seconds"),
        F.when(is_linear, F.col("rate")).alias("drift_rate"),
        ((F.col("aligned") - F.col("rtc")) / 1e6).alias("drift_seconds"),
    )


def borrow_positions(aligned: DataFrame, by: list[str], settings: Settings = Settings()) -> DataFrame:
    """Positions without a usable row take the median drift of their segment's position 0, or its least one."""
    segment = [*by, "segment_id"]
    facts = aligned.groupBy(*segment, "position").agg(F.max("confidence").alias("_best"), F.median(F.col("aligned") - F.col("rtc")).alias("_drift"))
    leads = facts.groupBy(*segment).agg(F.min(F.struct((F.col("position") != 0).alias("n"), "position", "_drift")).alias("_lead"))
    marked = facts.join(leads, segment)
    poor = (F.col("position") != F.col("_lead.position")) & ~F.coalesce(F.col("_best") >= settings.usable_confidence, F.lit(False))
    borrowed = marked.where(poor & F.col("_lead._drift").isNotNull()).select(*segment, "position", F.round("_lead._drift").cast("long").alias("_borrowed"))
    out = aligned.join(borrowed, [*segment, "position"], "left")
    hit = F.col("_borrowed").isNotNull()
    out = out.withColumn("aligned", F.when(hit, F.col("rtc") + F.col("_borrowed")).otherwise(F.col("aligned")))
    out = out.withColumn("confidence", F.when(hit, settings.borrowed_confidence).otherwise(F.col("confidence")))
    out = out.withColumn("method", F.when(hit, "fallback_anchor_drift").otherwise(F.col("method")))
    return out.withColumn("drift_seconds", (F.col("aligned") - F.col("rtc")) / 1e6).select(*aligned.columns)


def drift_rate(ranges: DataFrame, anchors: DataFrame, by: list[str], settings: Settings = Settings(), width: int = WEEK_S) -> DataFrame:
    """``ranges`` (``start, end`` in seconds) with the drift rate between the anchors closest to their ends; null without them."""
    out = ranges
    for end in ("start", "end"):
        out = closest_anchor(out, anchors, by, end, settings.match_horizon_s, settings.neighbour_window_s, width)
        out = out.withColumnRenamed("match_received", f"_{end}").drop("matched_unix", "match_delta", "match_quality")
    span = (F.col("end") - F.col("start")) * 1e6
    return out.withColumn("drift_rate", F.when(span != 0, (F.col("_end") - F.col("_start") - span) / span)).select(*ranges.columns, "drift_rate")


def propagate_back(aligned: DataFrame, by: list[str], settings: Settings = Settings()) -> DataFrame:
    """Early rows of low confidence take the drift of the first usable row of their position.

    The confidence stays as it was. Of usable rows at one time the least aligned is the first.
    """
    group = [*by, "position"]
    usable = F.when(F.col("confidence") >= settings.usable_confidence, F.struct("rtc", "aligned"))
    first = aligned.groupBy(*group).agg(F.min(usable).alias("_ref"))  # one row for each device and position
    hit = (F.col("rtc") < F.col("_ref.rtc")) & (F.col("confidence") < settings.low_confidence)
    out = aligned.join(first, group, "left")
    out = out.withColumn("aligned", F.when(hit, F.col("rtc") + (F.col("_ref.aligned") - F.col("_ref.rtc"))).otherwise(F.col("aligned")))
    return out.withColumn("drift_seconds", (F.col("aligned") - F.col("rtc")) / 1e6).select(*aligned.columns)


def correct_groups(aligned: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Rows recovered from one line share the drift of the most confident of them, the first by ``order`` on ties."""
    rank = F.struct((-F.col("confidence")).alias("c"), "rtc", *order)
    usable = F.when(F.col("aligned").isNotNull() & F.col("rtc").isNotNull() & F.col("confidence").isNotNull(), rank)
    best = aligned.groupBy(*group).agg(F.count("*").alias("_n"), F.min_by(F.col("aligned") - F.col("rtc"), usable).alias("_drift"))
    out = aligned.join(best.where("_n > 1 AND _drift IS NOT NULL").select(*group, "_drift"), group, "left")
    out = out.withColumn("aligned", F.coalesce(F.col("rtc") + F.col("_drift"), F.col("aligned")))
    return out.withColumn("drift_seconds", (F.col("aligned") - F.col("rtc")) / 1e6).select(*aligned.columns)
