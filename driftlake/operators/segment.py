"""Uninterrupted runs of a series, and reports on gaps."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftlake.config import SECOND
from driftlake.functions.ordered import WEEK_S, bucket_of, previous


def cutoff(df: DataFrame, at: str, since) -> DataFrame:
    """Rows from ``since`` on."""
    return df.where(F.col(at) >= F.lit(since))


def in_range(df: DataFrame, at: str, low, high) -> DataFrame:
    """``df`` with ``is_valid``, an inclusive range test; rows are kept."""
    return df.withColumn("is_valid", F.coalesce(F.col(at).between(F.lit(low), F.lit(high)), F.lit(False)))


def segments(df: DataFrame, by: list[str], at: str, order: list[str], max_gap: int = 120 * SECOND, min_size: int = 5, width: int = WEEK_S * SECOND) -> DataFrame:
    """``df`` with dense ``segment_id`` from 0 for each ``by``, without runs of under ``min_size`` rows.

    A run ends before a step of more than ``max_gap``. ``at`` and ``max_gap`` are integers of one unit.
    """
    # one exchange by series and time bucket serves the rows and the buckets' summary
    within = Window.partitionBy(*by, "_b").orderBy(at, *order)
    step = F.col(at) - F.lag(at).over(within)
    marked = df.withColumn("_b", bucket_of(at, width)).withColumn("_gap", F.coalesce(step > max_gap, F.lit(False)).cast("int"))
    buckets = marked.groupBy(*by, "_b").agg(F.min(at).alias("_lo"), F.max(at).alias("_hi"), F.sum("_gap").alias("_gaps"))
    across = Window.partitionBy(*by).orderBy("_b")
    edge = F.col("_lo") - F.lag("_hi").over(across)
    buckets = buckets.withColumn("_edge", F.coalesce(edge > max_gap, F.lit(True)).cast("int"))
    buckets = buckets.select(*by, "_b", (F.sum(F.col("_edge") + F.col("_gaps")).over(across) - F.col("_gaps")).alias("_base"))
    running = F.sum("_gap").over(within.rowsBetween(Window.unboundedPreceding, 0))
    runs = marked.withColumn("_in", running).join(buckets, [*by, "_b"]).select(*df.columns, (F.col("_base") + F.col("_in")).alias("_run"))
    sizes = runs.groupBy(*by, "_run").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_size)
    dense = sizes.select(*by, "_run", (F.row_number().over(Window.partitionBy(*by).orderBy("_run")) - 1).cast("int").alias("segment_id"))
    return runs.join(dense, [*by, "_run"]).select(*df.columns, "segment_id")


def segment_summary(df: DataFrame, by: list[str], at: str, file: str | None = None) -> DataFrame:
    """Size, first and last time, minutes and distinct files of each segment."""
    files = F.countDistinct(file) if file else F.lit(None).cast("long")
    return df.groupBy(*by, "segment_id").agg(
        F.count("*").alias("size"),
        F.min(at).alias("start_time"),
        F.max(at).alias("end_time"),
        ((F.max(at) - F.min(at)) / (60.0 * SECOND)).alias("duration_minutes"),
        files.alias("num_files"),
    )


def gap_report(df: DataFrame, by: list[str], at: str, order: list[str], limit: int, width: int = WEEK_S * SECOND) -> DataFrame:
    """The greatest step and the number of steps over ``limit``."""
    step = F.col(at) - F.col("_prev")
    return previous(df, by, at, order, "_prev", width).groupBy(*by).agg(F.max(step).alias("max_gap"), F.count_if(step > limit).alias("large_gaps"))


def distinct_segments(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows and percentage of rows of each segment."""
    counts = df.groupBy(*by, "segment_id").agg(F.count("*").alias("rows"))
    return counts.withColumn("pct", 100.0 * F.col("rows") / F.sum("rows").over(Window.partitionBy(*by)))


def problem_segments(df: DataFrame, by: list[str], confidence: str = "confidence", least: float = 0.6) -> DataFrame:
    """Segments of a mean confidence under ``least``.

    Sums of doubles depend on the order of the rows, so means next to ``least`` are decided by exact decimal sums.
    """
    c, bound = F.col(confidence), F.lit(Decimal(str(least)))
    exact = F.sum(c.try_cast("decimal(28,18)")) < bound * F.count(c)
    means = df.groupBy(*by, "segment_id").agg(F.count("*").alias("rows"), F.avg(c).alias("mean_confidence"), F.min(c).alias("min_confidence"), exact.alias("_under"))
    plain = F.col("mean_confidence") < least
    under = F.when(F.abs(F.col("mean_confidence") - least) < 1e-6, F.coalesce("_under", plain)).otherwise(plain)
    return means.where(under).drop("_under").orderBy("mean_confidence", *by, "segment_id")
