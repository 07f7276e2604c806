"""From corrected rows to hourly files: de-duplication, spreading, local hours, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlake.config import SECOND, Settings
from driftlake.functions.ordered import previous

#: The names of the data columns by width.
HEADER_SHORT = ["Sensor_Volt", "CH4_Raw", "CO2_ppm", "Temp_C", "RH_pct"]
HEADER_SIX = [*HEADER_SHORT, "Extra1"]
HEADER_LONG = [*HEADER_SHORT, "DO_mgL", "DO_sat_pct", "Topt_C", "Extra4", "Sal"]


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each combination of ``keys``."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r")


def distinct_anchors(anchors: DataFrame, by: list[str]) -> DataFrame:
    """One anchor for each ``unix``, the earliest received, then by the other columns."""
    rest = [c for c in anchors.columns if c not in by and c not in ("unix", "received")]
    best = anchors.groupBy(*by, "unix").agg(F.min(F.struct("received", *rest)).alias("_a"))
    return best.select(*by, "unix", "_a.*").select(*anchors.columns)


def mark_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with ``is_duplicate``: another row has the same ``keys``."""
    return df.withColumn("is_duplicate", F.count("*").over(Window.partitionBy(*keys)) > 1)


def spread(df: DataFrame, by: list[str], at: str, rtc: str, order: list[str], interval: Column | int, settings: Settings = Settings(), width: int = 7 * 86_400 * SECOND) -> DataFrame:
    """``df`` with ``spread``: rows of equal ``at`` follow each other in steps.

    The step is the row's own distance in ``rtc`` from the row before when that lies within
    ``step_bounds_s``, else the device's ``interval`` in seconds. A run of equal times is one window, so
    no series is one task.
    """
    # rows without a time get none, so they need not meet
    within = Window.partitionBy(*by, at, F.when(F.col(at).isNull(), F.col(rtc))).orderBy(rtc, *order)
    low, high = (s * SECOND for s in settings.step_bounds_s)
    interval = F.lit(interval) if isinstance(interval, int) else interval
    step = F.col(rtc) - F.lag(rtc).over(within)
    marked = df.withColumn("_step", F.when(F.lag(rtc).over(within).isNull(), 0).when(step.between(low, high), step).otherwise((interval * SECOND).cast("long")))
    running = F.sum("_step").over(within.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("spread", F.col(at) + running).drop("_step")


def local_time(at: str, zone: str) -> Column:
    """The wall-clock time of a zone, with its daylight saving, for microseconds since the epoch."""
    return F.from_utc_timestamp(F.timestamp_micros(at), zone)


def local_hours(df: DataFrame, at: str, zone: str) -> DataFrame:
    """``df`` with ``hour_key`` (``yyMMddHH``) and ``month_folder`` of its local time."""
    local = local_time(at, zone)
    return df.withColumn("hour_key", F.date_format(local, "yyMMddHH")).withColumn("month_folder", F.date_format(local, "MM"))


def manifest(df: DataFrame, by: list[str], at: str = "spread") -> DataFrame:
    """Rows, first and last time, mean confidence and widest row of each hourly file."""
    return df.groupBy(*by, "month_folder", "hour_key").agg(
        F.count("*").alias("lines"),
        F.min(at).alias("start_time"),
        F.max(at).alias("end_time"),
        F.avg("confidence").alias("mean_confidence"),
        F.max(F.size("data_values")).alias("width"),
    )


def pad(values: str, width: str) -> Column:
    """An array filled up with empty strings."""
    return F.concat(values, F.array_repeat(F.lit(""), F.greatest(F.col(width) - F.size(values), F.lit(0))))


def header(width: str) -> Column:
    """The data columns' names for a row of ``width`` values."""

    def names(words: list[str]) -> Column:
        return F.array(*map(F.lit, words))

    beyond = F.transform(F.sequence(F.lit(11), F.col(width)), lambda i: F.concat(F.lit("Extra"), (i - 6).cast("string")))
    return (
        F.when(F.col(width) <= 5, F.slice(names(HEADER_SHORT), F.lit(1), F.greatest(F.col(width), F.lit(0))))
        .when(F.col(width) == 6, names(HEADER_SIX))
        .when(F.col(width) <= 10, F.slice(names(HEADER_LONG), F.lit(1), F.col(width)))
        .otherwise(F.concat(names(HEADER_LONG), F.when(F.col(width) > 10, beyond)))
    )


def hour_of_name(name: str) -> Column:
    """The hour of a file named ``yyMMddHH.TXT``; null for other names."""
    stem = F.regexp_extract(F.col(name), r"^(\d{8})\.[tT][xX][tT]$", 1)
    return F.when(stem != "", F.try_to_timestamp(stem, F.lit("yyMMddHH")))


def bad_names(df: DataFrame, name: str) -> DataFrame:
    """Rows whose file name is not eight digits and the suffix."""
    return df.where(~F.col(name).rlike(r"^\d{8}\.TXT$"))


def coverage_gaps(hours: DataFrame, by: list[str], hour: str, low=None, high=None) -> DataFrame:
    """Runs of missing hours as ``gap_start, gap_end, duration_hours, status``; one ``complete`` row where none is.

    The expected hours go from ``low`` to ``high``, by default the first and last present. Gaps come
    from steps between present hours, so no expected hour is written out.
    """
    present = hours.where(F.col(hour).isNotNull()).select(*by, F.date_trunc("hour", F.col(hour)).alias("_h")).distinct()
    step = F.expr("interval 1 hour")
    ends = [F.lit(x).cast("timestamp") for x in (low, high) if x is not None]
    if len(ends) == 2:
        present = present.where(F.col("_h").between(*ends))
        edge = [F.array(F.date_trunc("hour", ends[0]) - step, F.date_trunc("hour", ends[1]) + step)]
        owners = hours.select(*by).distinct() if by else hours.sparkSession.range(1).select()
        present = present.union(owners.select(*by, F.explode(*edge).alias("_h")))
    seconds = present.withColumn("_s", F.unix_seconds("_h"))
    jumps = previous(seconds, by, "_s", [], "_p") if by else previous(seconds.withColumn("_one", F.lit(1)), ["_one"], "_s", [], "_p").drop("_one")
    missing = ((F.col("_s") - F.col("_p")) / 3600 - 1).cast("long")
    marked = jumps.withColumn("_m", F.coalesce(missing, F.lit(0)))
    gaps = marked.where("_m > 0").select(
        *by, F.timestamp_seconds(F.col("_p") + 3600).alias("gap_start"), F.timestamp_seconds(F.col("_s") - 3600).alias("gap_end"), F.col("_m").alias("duration_hours"), F.lit("missing").alias("status")
    )
    full = marked.groupBy(*by).agg(F.max("_m").alias("_m"), F.count("*").alias("_c")).where("_m = 0 AND _c > 0")
    none = F.lit(None)
    return gaps.union(full.select(*by, none.cast("timestamp"), none.cast("timestamp"), none.cast("long"), F.lit("complete")))
