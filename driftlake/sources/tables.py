"""Readers of what the pipeline writes: aligned tables, hourly files, reports and the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftlake.sources.sd_text import parse_time, read_files, split_lines, strip

#: The columns that an aligned table must have.
REQUIRED = ("original_rtc", "aligned_time", "confidence")
TIME_NAMES = ("aligned_time", "corrected_time", "timestamp", "time", "datetime")


def read_aligned(spark: SparkSession, path: str) -> DataFrame:
    """An aligned Parquet table; ``ValueError`` if columns are missing or not of their type."""
    df = spark.read.parquet(path)
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    kinds = dict(df.dtypes)
    wrong = [c for c in REQUIRED[:2] if not kinds[c].startswith("timestamp")] + [c for c in REQUIRED[2:] if kinds[c] not in ("double", "float")]
    if wrong:
        raise ValueError(f"columns of a wrong type: {wrong}")
    return df


def time_column(df: DataFrame) -> str:
    """The column to take as time: a known name, else the first timestamp."""
    for name in TIME_NAMES:
        if name in df.columns:
            return name
    for name, kind in df.dtypes:
        if kind.startswith("timestamp"):
            return name
    raise ValueError("no time column")


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    """Hourly files: ``file_name, line_number, fields, original_rtc, corrected_local, n_fields``; headers are left out."""
    lines = split_lines(read_files(spark, path)).where("line NOT LIKE 'Original_RTC%'")
    fields = F.transform(F.split("line", ",", -1), strip)
    rows = lines.select("file_path", "file_name", "line_number", fields.alias("fields")).withColumn("n_fields", F.size("fields") - 1)
    return rows.withColumn("original_rtc", F.when(F.size("fields") >= 3, parse_time(F.col("fields")[0]))).withColumn(
        "corrected_local", F.when(F.size("fields") >= 3, parse_time(F.element_at("fields", -1)))
    )


#: The names of a reconstructed file's columns.
SENSOR_NAMES = ("CH4_1", "CH4_2", "CO2", "RH", "Temp", "Pressure", "timestamp")


def read_sensors(spark: SparkSession, path: str, names: tuple[str, ...] = SENSOR_NAMES) -> DataFrame:
    """Files without a header as typed columns: numbers, and a ``timestamp`` as the last; unreadable values are null."""
    raw = spark.read.option("recursiveFileLookup", "true").schema(", ".join(f"`{n}` string" for n in names)).csv(path)
    numbers = [F.expr(f"try_cast(trim(`{n}`) AS double)").alias(n) for n in names if n != "timestamp"]
    return raw.select(*numbers, *[parse_time(strip(F.col(n))).alias(n) for n in names if n == "timestamp"])


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, multiLine=True)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, file_name, month_folder, length, modificationTime``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
    parts = F.split("path", "/")
    return files.withColumn("file_name", F.element_at(parts, -1)).withColumn("month_folder", F.element_at(parts, -2))


def device_history(log: DataFrame, device_id: str) -> DataFrame:
    """All runs of a device with their run number."""
    return log.where(F.col("device_id") == device_id).withColumn("run_number", F.row_number().over(Window.partitionBy("device_id").orderBy("processed_at", "run_id")))


def latest_runs(log: DataFrame) -> DataFrame:
    """The latest run of each device, with its number of runs."""
    latest = log.groupBy("device_id").agg(F.max(F.struct("processed_at", "run_id")).alias("m"), F.count("*").alias("runs"))
    rows = latest.select(F.col("device_id").alias("d"), "m.*", "runs").withColumnsRenamed({"processed_at": "p", "run_id": "r"})
    return log.join(rows, (F.col("device_id") == F.col("d")) & (F.col("processed_at") == F.col("p")) & (F.col("run_id") == F.col("r"))).drop("d", "p", "r")
