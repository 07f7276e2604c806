"""Parameters of a correction run, and the device dimension."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

SECOND = 1_000_000
DAY = 86_400 * SECOND

#: Seconds between samples of the devices that differ from the default.
DEFAULT_INTERVAL_S = 5
DEFAULT_OFFSET_MIN = 60


@dataclass(frozen=True)
class Settings:
    """Thresholds of the pipeline; times in seconds, confidences in [0, 1]."""

    max_gap_s: int = 120
    min_segment_size: int = 5
    cutoff: str = "2025-03-25 00:00:00"
    valid_from: str = "2023-01-01 00:00:00"
    valid_to: str = "2026-12-31 23:59:59"
    match_horizon_s: int = 86_400
    neighbour_window_s: int = 7 * 86_400
    range_padding_s: int = 3_600
    min_anchors_in_range: int = 3
    direct_tolerance_s: int = 30
    holdout_fraction: float = 0.2
    holdout_seed: int = 42
    min_anchors_for_holdout: int = 50
    step_bounds_s: tuple[int, int] = (2, 20)
    file_gap_s: int = 300
    usable_confidence: float = 0.7
    low_confidence: float = 0.6
    high_confidence: float = 0.9
    borrowed_confidence: float = 0.65
    local_zone: str = "Europe/Copenhagen"
    strict_reference: bool = False
    intervals: dict[str, int] = field(default_factory=dict)
    offsets: dict[str, int] = field(default_factory=dict)


def device_table(spark: SparkSession, settings: Settings, devices: list[str]) -> DataFrame:
    """``device_id, sample_interval_s, rtc_offset_min``: one row for each device."""
    rows = [(d, settings.intervals.get(d, DEFAULT_INTERVAL_S), settings.offsets.get(d, DEFAULT_OFFSET_MIN)) for d in devices]
    return spark.createDataFrame(rows, "device_id string, sample_interval_s int, rtc_offset_min int")


def check_paths(spark: SparkSession, text_dir: str, anchor_dir: str) -> tuple[list[str], list[str]]:
    """``(errors, warnings)`` about the input folders, through Spark's own file systems."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    errors, warnings = [], []
    for name, path, suffix in (("text", text_dir, ".txt"), ("anchor", anchor_dir, ".txt")):
        at = jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(conf)
        if not fs.exists(at):
            errors.append(f"{name} folder is missing: {path}")
            continue
        files, found = fs.listFiles(at, True), False
        while files.hasNext() and not found:
            found = files.next().getPath().getName().lower().endswith(suffix)
        if not found:
            warnings.append(f"{name} folder has no text files: {path}")
    return errors, warnings
