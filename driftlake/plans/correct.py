"""The whole correction of one or many devices as DataFrame plans."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.config import DEFAULT_INTERVAL_S, DEFAULT_OFFSET_MIN, SECOND, Settings, check_paths
from driftlake.functions import stats
from driftlake.operators import align, matching, rebuild, segment
from driftlake.session import settled
from driftlake.sinks import writers
from driftlake.sources import anchors as anchor_source
from driftlake.sources import sd_text, tables

log = logging.getLogger("driftlake")

BY = ["device_id"]
ORDER = ["file_path", "line_number", "concat_position"]


@dataclass
class Result:
    """The tables of a run; each is lazy."""

    rows: DataFrame
    segments: DataFrame
    aligned: DataFrame
    spread: DataFrame
    manifest: DataFrame


def correct(rows: DataFrame, anchors: DataFrame, settings: Settings = Settings(), interval_s: Column | int = 5, strategy: str = "adaptive") -> Result:
    """Parsed ``rows`` and ``anchors`` of any number of devices, corrected, spread and dealt to local hours."""
    good = rows.where("reject_reason IS NULL") if "reject_reason" in rows.columns else rows
    since = F.lit(settings.cutoff).cast("timestamp")
    kept = good.where(F.col("rtc_time") >= since).withColumn("rtc", F.unix_micros("rtc_time")).withColumn("position", F.col("concat_position"))
    cut = settled(segment.segments(kept, BY, "rtc", ORDER, settings.max_gap_s * SECOND, settings.min_segment_size))
    aligned = settled(align.align(cut, anchors, BY, strategy, settings))
    aligned = align.propagate_back(align.borrow_positions(aligned, BY, settings), BY, settings)
    aligned = settled(align.correct_groups(aligned, [*BY, "concat_group_id"], ["position", "file_path"]))
    unique = rebuild.keep_first(aligned, [*BY, "concat_group_id", "rtc", "data_values"], ["aligned", "rtc", *ORDER])
    laid = rebuild.spread(unique, BY, "aligned", "rtc", ORDER, interval_s, settings)
    laid = rebuild.local_hours(laid, "spread", settings.local_zone)
    return Result(kept, segment.segment_summary(cut, BY, "rtc", "file_path"), aligned, laid, rebuild.manifest(laid, BY))


def validate(aligned: DataFrame, anchors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Anchors with the nearest corrected row within the tolerance, and the errors there."""
    return _errors_at(aligned, anchors, settings, strict=False)


def validate_holdout(aligned: DataFrame, anchors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The same at the test rows of the hold-out split alone, where the tolerance itself is excluded."""
    split = stats.holdout(anchors, BY, settings.holdout_fraction, settings.min_anchors_for_holdout, settings.holdout_seed)
    return _errors_at(aligned, split.where("is_test"), settings, strict=True)


def _errors_at(aligned: DataFrame, anchors: DataFrame, settings: Settings, strict: bool) -> DataFrame:
    probes = anchors.select(*BY, "unix", "received")
    rows = aligned.select(*BY, "aligned", "rtc", "confidence", "position", "concat_group_id")
    width = 7 * 86_400 * SECOND
    found = matching.nearest(probes, rows, BY, "received", "aligned", settings.direct_tolerance_s * SECOND, strict, width).where("match IS NOT NULL")
    return stats.errors(found.select(*BY, "unix", "received", "match.*"))


def check_output(spark: SparkSession, out: str, devices: list[str], settings: Settings = Settings()) -> DataFrame:
    """File quality of the hourly files as they were written, for files with at least two readable times."""
    lines = None
    for device in devices:
        read = tables.read_hourly(spark, f"{out}/{device}/hourly").withColumn("device_id", F.lit(device))
        lines = read if lines is None else lines.unionByName(read)
    lines = lines.withColumn("at", F.unix_micros("corrected_local")).withColumn("drift", (F.col("at") - F.unix_micros("original_rtc")) / SECOND)
    hour = F.substring("file_name", 7, 2).cast("int")
    return stats.file_qa(lines, [*BY, "file_name"], "at", "line_number", hour, "drift", settings.file_gap_s, least=2)


def _first_of(df: DataFrame) -> dict[str, dict]:
    """A table of one row for each device, by device."""
    return {r["device_id"]: r.asDict(recursive=True) for r in df.collect()}


def load(spark: SparkSession, devices: dict[str, tuple[str, str]], settings: Settings, reports: dict[str, dict]) -> tuple[DataFrame, DataFrame] | None:
    """The rows and anchors of all devices whose folders exist; the others are reported."""
    rows = marks = None
    for device, (text_dir, anchor_dir) in devices.items():
        errors, warnings = check_paths(spark, text_dir, anchor_dir)
        for text in warnings:
            log.warning("%s: %s", device, text)
        if errors:
            reports[device] = {"status": f"failed: {'; '.join(errors)}"}
            continue
        try:
            more = sd_text.load(spark, text_dir, device, settings.offsets.get(device, DEFAULT_OFFSET_MIN), settings.strict_reference)
            points = anchor_source.load(spark, anchor_dir, device)
        except (ValueError, AnalysisException) as error:
            reports[device] = {"status": f"failed: {str(error).splitlines()[0]}"}
            continue
        rows, marks = (more, points) if rows is None else (rows.unionByName(more), marks.unionByName(points))
    return None if rows is None else (settled(rows), settled(marks))


def run(spark: SparkSession, devices: dict[str, tuple[str, str]], out: str, settings: Settings = Settings(), strategy: str = "adaptive") -> dict[str, dict]:
    """Correct all devices' ``(text folder, anchor folder)`` in one plan and write everything under ``out``.

    Hourly files go to ``out/device/hourly``; the tables ``load_check``, ``anchor_check``, ``aligned``, ``segments``,
    ``manifest``, ``direct_validation``, ``holdout_validation``, ``output_validation``, ``problem_files`` and ``run_log`` hold all
    devices, the reports and the log of the run lie in ``out/reports`` and ``out/logs``. A device without folders, rows, rows
    from the cutoff on, anchors or an overlap in time is reported as such and does not stop the others.
    """
    run_id, reports = uuid4().hex, {}
    with writers.run_log(spark, f"{out}/logs/{run_id}"):
        log.info("run %s of %d devices", run_id, len(devices))
        loaded = load(spark, devices, settings, reports)
        if loaded is not None:
            _run_all(spark, *loaded, [d for d in devices if d not in reports], out, settings, strategy, run_id, reports)
        for device in devices:
            log.info("%s: %s", device, reports[device]["status"])
        status = [(d, run_id, reports[d]["status"], reports[d].get("rows"), reports[d].get("mean_drift_seconds"), reports[d].get("max_drift_seconds"),
                   reports[d].get("mean_confidence"), reports[d].get("files"), reports[d].get("chronological_pct"), reports[d].get("issues")) for d in devices]
        kinds = "device_id string, run_id string, status string, rows long, mean_drift_seconds double, max_drift_seconds double, mean_confidence double, files long, chronological_pct double, issues string"
        if status:
            writers.append_run(spark.createDataFrame(status, kinds).withColumn("processed_at", F.current_timestamp()), f"{out}/run_log")
    return reports


def _run_all(spark, rows: DataFrame, anchors: DataFrame, devices: list[str], out: str, settings: Settings, strategy: str, run_id: str, reports: dict[str, dict]) -> None:
    good = rows.where("reject_reason IS NULL").withColumn("rtc", F.unix_micros("rtc_time"))
    low, high, since = (F.unix_micros(F.lit(t).cast("timestamp")) for t in (settings.valid_from, settings.valid_to, settings.cutoff))
    writers.write_table(stats.load_check(good, BY, "rtc", "file_path", "is_concatenated", low, high), f"{out}/load_check", "csv")
    writers.write_table(stats.anchor_check(anchors, BY, "received"), f"{out}/anchor_check")
    kept = _first_of(good.groupBy(*BY).agg(F.count_if(F.col("rtc") >= since).alias("n")))
    meets = _first_of(stats.overlap(good, anchors, BY, "rtc", "received"))
    for device in devices:
        if device not in kept:
            reports[device] = {"status": "failed: no rows"}
        elif not kept[device]["n"]:
            reports[device] = {"status": f"failed: no rows from {settings.cutoff} on"}
        elif not meets[device]["overlaps"]:
            reports[device] = {"status": "no overlap"}
    devices = [d for d in devices if d not in reports]
    if not devices:
        return
    log.info("correcting %s", ", ".join(devices))
    wanted = F.col("device_id").isin(devices)
    interval = F.coalesce(*[F.when(F.col("device_id") == d, s) for d, s in settings.intervals.items()], F.lit(DEFAULT_INTERVAL_S))
    result = correct(rows.where(wanted), anchors.where(wanted), settings, interval, strategy)
    result.aligned.write.mode("overwrite").partitionBy(*BY).parquet(f"{out}/aligned")
    writers.write_table(result.segments, f"{out}/segments", "csv")
    writers.write_table(result.manifest, f"{out}/manifest", "csv")
    log.info("writing hourly files")
    files = writers.write_hourly(result.spread, out, settings.local_zone, BY)
    direct, tested = settled(validate(result.aligned, anchors, settings)), settled(validate_holdout(result.aligned, anchors, settings))
    writers.write_table(direct, f"{out}/direct_validation", "csv")
    writers.write_table(tested, f"{out}/holdout_validation", "csv")
    log.info("reading the hourly files back")
    qa = settled(check_output(spark, out, devices, settings))
    writers.write_table(qa, f"{out}/output_validation", "csv")
    writers.write_table(stats.problem_files(qa), f"{out}/problem_files", "csv")
    for device in devices:  # one small report each; what they read is written
        own = F.col("device_id") == device
        errors = [stats.error_stats(e.where(own), []) for e in (direct, tested)]
        report = writers.write_report(stats.summary(result.aligned.where(own), qa.where(own), BY, *errors), f"{out}/reports/{run_id}/{device}")
        done, broken = report["output"], report["output"]["files"] - report["output"]["chronological_files"]
        reports[device] = {
            "status": "ok", "files": files[device], "rows": report["data"]["rows"], "mean_confidence": report["confidence"]["mean"],
            "mean_drift_seconds": report["drift"]["mean_s"], "max_drift_seconds": report["drift"]["max_s"],
            "chronological_pct": 100.0 * done["chronological_files"] / done["files"] if done["files"] else None,
            "issues": f"{broken} files out of order" if broken else "none", "report": report,
        }
