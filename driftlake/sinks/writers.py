"""Outputs: hourly text files with exact names, tables, reports and the run log."""

from __future__ import annotations

import json
import logging
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.operators.rebuild import header, local_time, pad

log = logging.getLogger("driftlake")
STAMP = "dd.MM.yyyy HH:mm:ss"


def hourly_lines(df: DataFrame, zone: str, by: list[str]) -> DataFrame:
    """The lines of every hourly file, header first: ``month_folder, hour_key, rank, line``.

    ``df`` holds ``rtc`` and ``spread`` in microseconds, ``data_values``, ``hour_key`` and ``month_folder``.
    """
    file = [*by, "month_folder", "hour_key"]
    widths = df.groupBy(*file).agg(F.max(F.size("data_values")).alias("width"))
    wide = df.join(widths, file)
    times = [F.date_format(F.timestamp_micros("rtc"), STAMP), F.date_format(F.timestamp_micros("spread"), STAMP), F.date_format(local_time("spread", zone), STAMP)]
    rows = wide.select(*file, F.col("spread").alias("rank"), F.concat_ws(",", times[0], F.array_join(pad("data_values", "width"), ","), times[1], times[2]).alias("line"))
    tops = widths.select(*file, F.lit(-(1 << 63)).alias("rank"), F.concat_ws(",", F.lit("Original_RTC"), F.array_join(header("width"), ","), F.lit("Corrected_Time"), F.lit("Corrected_Local_Time")).alias("line"))
    return tops.unionByName(rows)


def write_hourly(df: DataFrame, path: str, zone: str, by: list[str]) -> dict[str, int]:
    """Write ``{device}/hourly/{MM}/{YYMMDDHH}.TXT`` under ``path``, for the one key in ``by``, and return each device's number of files.

    Spark's committer writes one file for each hour into a staging folder; the driver then only renames, several at a time.
    """
    spark, (key,) = df.sparkSession, by
    staging = f"{path.rstrip('/')}/_staging-{uuid4().hex}"
    lines = hourly_lines(df, zone, by).select(F.col(key).alias("_device"), "month_folder", "hour_key", "rank", "line")
    lines = lines.repartition("_device", "month_folder", "hour_key").sortWithinPartitions("_device", "month_folder", "hour_key", "rank", "line")
    lines.select("_device", "month_folder", "hour_key", F.col("line").alias("value")).write.partitionBy("_device", "month_folder", "hour_key").text(staging)
    hadoop = spark._jvm.org.apache.hadoop.fs
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    root = hadoop.Path(staging)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def found():
        files = fs.listFiles(root, True)
        while files.hasNext():
            at = files.next().getPath()
            if at.getName().startswith("part-"):
                yield at

    def put(at) -> str:
        hour, month, device = (unescape(p.getName().split("=", 1)[1]) for p in (at.getParent(), at.getParent().getParent(), at.getParent().getParent().getParent()))
        folder = hadoop.Path(f"{path.rstrip('/')}/{device}/hourly/{month}")
        fs.mkdirs(folder)
        target = hadoop.Path(folder, f"{hour}.TXT")
        fs.delete(target, False)
        if not fs.rename(at, target):
            raise OSError(f"cannot write {target}")
        return device

    with ThreadPoolExecutor(16) as pool:
        count = Counter(pool.map(put, found()))
    fs.delete(root, True)
    return count


@contextmanager
def run_log(spark: SparkSession, path: str):
    """What is logged meanwhile, as text lines under ``path``, through Spark's writer; the console gets it as well if it listens."""
    lines: list[tuple[str]] = []

    class Keep(logging.Handler):
        def emit(self, record: logging.LogRecord) -> None:
            lines.append((self.format(record),))

    keep, before = Keep(), log.level
    keep.setFormatter(logging.Formatter("%(asctime)s - %(levelname)s - %(message)s"))
    log.addHandler(keep)
    log.setLevel(logging.INFO)
    try:
        yield
    except BaseException:
        log.exception("the run failed")
        raise
    finally:
        log.removeHandler(keep)
        log.setLevel(before)
        spark.createDataFrame(lines or [("",)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """``parquet`` or ``csv`` with a header, replacing what is there."""
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.parquet(path)


def write_report(row: DataFrame, path: str) -> dict:
    """One row of nested structs as JSON and as indented text, through Spark's writer; returns the report."""
    found = row.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    found.coalesce(1).write.mode("overwrite").text(f"{path}/json")
    report = json.loads(found.first()["value"])
    text = [(json.dumps(report, indent=2, ensure_ascii=False),)]
    row.sparkSession.createDataFrame(text, "value string").coalesce(1).write.mode("overwrite").text(f"{path}/text")
    return report


def append_run(row: DataFrame, path: str) -> None:
    """Add one run to the log; the workbook's summary and device sheets are views of it."""
    row.write.mode("append").parquet(path)


def merge_devices(frames: dict[str, DataFrame]) -> DataFrame:
    """Tables of several devices as one, with their ``device_id``; columns that some lack are null there."""
    out = None
    for device, df in frames.items():
        tagged = df.withColumn("device_id", F.lit(device))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no devices")
    return out


def high_confidence(df: DataFrame, least: float = 0.9) -> DataFrame:
    """The rows of at least this confidence."""
    return df.where(F.col("confidence") >= least)


def kept_share(df: DataFrame, least: float = 0.9) -> DataFrame:
    """How many rows :func:`high_confidence` keeps, and their percentage."""
    kept = F.count_if(F.col("confidence") >= least)
    return df.agg(F.count("*").alias("rows"), kept.alias("kept"), (100.0 * kept / F.count("*")).alias("kept_pct"))
