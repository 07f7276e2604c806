"""Dirty text to rows, anchors of both formats, and a whole run from folders to hourly files."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from driftlake.config import Settings, check_paths
from driftlake.plans import correct
from driftlake.sources import anchors, sd_text, tables


def parsed(spark, line, strict=False):
    df = spark.createDataFrame([("F.TXT", 1, line)], "file_name string, line_number int, line string")
    rows = sd_text.parse(df, strict, 60).orderBy("rtc_time", "concat_position").collect()
    return [(r["concat_position"], str(r["rtc_time"])[11:], r["data_values"]) for r in rows if r["reject_reason"] is None]


CASES = {
    "12.3,45.6,25.03.2025 10:00:00": [(0, "09:00:00", ["12.3", "45.6"])],
    "1,2,1.3.2025 1:2:3": [(0, "00:02:03", ["1", "2"])],
    "1,2,25.03.2025 10:00:00 3,4,25.03.2025 10:00:02": [(0, "09:00:00", ["1", "2"]), (1, "09:00:02", ["3", "4"])],
    "1,2,25.03.2025 10:00:00,3,4,25.03.2025 10:00:05": [(0, "09:00:00", ["1", "2"]), (1, "09:00:05", ["3", "4"])],
    "1,2,25.03.2025 10:00:10 3,4,25.03.2025 10:00:05": [(1, "09:00:05", ["3", "4"]), (0, "09:00:10", ["1", "2"])],
    "1,2,25.03.2025 10:00:00 3,4,25.03.2025 10:00:00": [(0, "09:00:00", ["1", "2"]), (1, "09:00:00", ["3", "4"])],
    "1,2,25.03.2025 10:00:00 3,4,25.03.2025  10:00:00": [(0, "09:00:00", ["1", "2"]), (1, "09:00:00", ["3", "4"])],
    "1,2,25.03.2025 10:00:00 é,4,25.03.2025 10:00:02": [(0, "09:00:00", ["1", "2"])],
    "1,2,99.03.2025 10:00:00": [],
    "25.03.2025 10:00:00,1,2": [],
    "abc": [],
}


@pytest.mark.parametrize("line", CASES)
def test_lines(spark, line):
    assert parsed(spark, line) == CASES[line]


def test_strict_mode_loses_equal_times(spark):
    assert parsed(spark, "1,2,25.03.2025 10:00:00 3,4,25.03.2025 10:00:00", True) == [(0, "09:00:00", ["1", "2"])]
    line = "1,2,25.03.2025 10:00:00 3,4,25.03.2025 10:00:00 5,6,25.03.2025 10:00:02"
    glued = [(0, "09:00:00", ["1", "2"]), (2, "09:00:02", ["3", "4", "25.03.2025 10:00:00 5", "6"])]
    assert parsed(spark, line, True) == glued and len(parsed(spark, line)) == 3


NEW = [
    ("2025-03-25 10:00:02 dev=B1 type=ghg_v1 unix=1742896800", [1742896800]),
    ("2025-03-25 10:00:02 dev=B1 type=ghg_v2\n2025-03-25 10:00:02 raw unix=1742896800", [1742896800]),
    ("2025-03-25 10:00:02 type=ghg\n2025-03-26 10:00:02 raw unix=1742896800", []),
    ("2025-03-25 10:00:02 type=ghg\n\n2025-03-25 10:00:02 raw unix=1742896800", []),
    ("2025-03-25 10:00:02 type=ghg unix=0\n2025-03-25 10:00:02 type=ghg unix=-5\n2025-03-25 10:00:02 type=ghg unix=1.5", []),
    ("2025-03-25 10:00:02 dev=B1 unix=1742896800", []),
    ("something else\n2025-03-25 10:00:02 type=ghg unix=7", []),
    ("2025-03-25 10:00:02 type=ghg unix=3 unix=4", [4]),
    ("received_at\tdecoded_payload\n2025-03-25T10:00:02Z\t{'unix': 42, 'ok': True, 'x': None}\nbad\t{'unix': 1}\n2025-03-25T10:00:02Z\t{}", [42]),
    ("received_at\tother\n2025-03-25T10:00:02Z\t{'unix': 42}", []),
]


@pytest.mark.parametrize("content,unix", NEW)
def test_anchor_formats(spark, content, unix):
    files = spark.createDataFrame([("a.txt", content)], "file_name string, content string")
    assert [r["unix"] for r in anchors.parse(files).collect()] == unix


def test_whole_run(spark, tmp_path):
    text, log, out = tmp_path / "data" / "03", tmp_path / "log", tmp_path / "out"
    text.mkdir(parents=True)
    log.mkdir()
    start = datetime(2025, 6, 1, 12, 0, 0)
    stamp = "%d.%m.%Y %H:%M:%S"
    lines = [f"{i},2,3,4,5,{(start + timedelta(seconds=5 * i)).strftime(stamp)}" for i in range(100)]
    (text / "25060112.TXT").write_text("\r\n".join(lines[:60]) + "\n\n" + " ".join(lines[60:62]) + "\n" + "\n".join(lines[62:]) + "\nbroken\n")
    unix = 1748775600  # 11:00 UTC on that day
    marks = [datetime(2025, 6, 1, 11) + timedelta(seconds=100 * k + 40) for k in range(6)]
    (log / "a.txt").write_text("\n".join(f"{m:%Y-%m-%d %H:%M:%S} dev=A type=ghg unix={unix + 100 * k}" for k, m in enumerate(marks)))
    assert check_paths(spark, str(tmp_path / "data"), str(tmp_path / "none"))[0] == [f"anchor folder is missing: {tmp_path / 'none'}"]
    got = correct.run(spark, {"A": (str(tmp_path / "data"), str(log)), "B": (str(tmp_path / "data"), str(tmp_path / "out"))}, str(out), Settings())
    assert got["A"]["status"] == "ok" and got["A"]["rows"] == 100 and got["A"]["files"] == 1
    assert got["B"]["status"].startswith("failed") or got["B"]["status"] == "no overlap"
    assert abs(got["A"]["mean_drift_seconds"] - 40) < 1e-6
    assert os.listdir(out / "A" / "hourly" / "06") == ["25060113.TXT"] or "25060113.TXT" in os.listdir(out / "A" / "hourly" / "06")
    written = (out / "A" / "hourly" / "06" / "25060113.TXT").read_text().splitlines()
    assert written[0] == "Original_RTC,Sensor_Volt,CH4_Raw,CO2_ppm,Temp_C,RH_pct,Corrected_Time,Corrected_Local_Time" and len(written) == 101
    assert written[1] == "01.06.2025 11:00:00,0,2,3,4,5,01.06.2025 11:00:40,01.06.2025 13:00:40"
    assert got["A"]["chronological_pct"] == 100 and got["A"]["report"]["direct_validation"]["n"] > 0 and got["B"]["status"].startswith("failed: anchor folder")
    for name in ("aligned", "anchor_check", "run_log"):
        assert spark.read.parquet(str(out / name)).count() >= 1
    for name in ("load_check", "segments", "manifest", "direct_validation", "holdout_validation", "output_validation", "problem_files"):
        assert (out / name).is_dir()
    runs = spark.read.parquet(str(out / "run_log"))
    assert {r["device_id"]: r["status"][:6] for r in tables.latest_runs(runs).collect()} == {"A": "ok", "B": "failed"}
    assert any("A: ok" in r[0] for r in spark.read.option("recursiveFileLookup", "true").text(str(out / "logs")).collect())
    late = correct.run(spark, {"A": (str(tmp_path / "data"), str(log))}, str(tmp_path / "late"), Settings(cutoff="2030-01-01 00:00:00"))
    assert late["A"]["status"].startswith("failed: no rows from 2030")
    back = tables.read_hourly(spark, str(out / "A" / "hourly"))
    assert back.count() == 100 and back.where(F.col("corrected_local").isNull()).count() == 0
    assert tables.list_files(spark, str(out / "A" / "hourly")).where("file_name = '25060113.TXT'").count() == 1


def test_holdout_validation(spark):
    marks = [("A", 60 * i, 60_000_000 * i + 1_000_000) for i in range(1000)] + [("B", 60 * i, 60_000_000 * i) for i in range(49)]
    anchors = spark.createDataFrame(marks, "device_id string, unix long, received long")
    late = {("A", 60 * i): 30_000_000 - i % 2 for i in range(1000)}  # at the tolerance, or just within
    rows = [(d, r + late.get((d, u), 0), u * 1_000_000, 0.9, 1, u) for d, u, r in marks]
    aligned = spark.createDataFrame(rows, "device_id string, aligned long, rtc long, confidence double, position int, concat_group_id long")
    test = correct.stats.holdout(anchors, ["device_id"]).where("is_test").collect()
    assert {r["device_id"] for r in test} == {"A"} and 150 < len(test) < 250
    got = correct.validate_holdout(aligned, anchors, Settings()).collect()
    assert {r["unix"] for r in got} == {r["unix"] for r in test if r["unix"] // 60 % 2}
    assert correct.validate(aligned, anchors, Settings()).count() > 1000
    assert correct.validate_holdout(aligned, anchors, Settings(min_anchors_for_holdout=1001)).count() == 0


def test_live_segments(spark, tmp_path):
    from driftlake.streaming.live import live_segments

    rows = [("a", datetime(2025, 1, 1, 0, 0, s)) for s in range(5)] + [("a", datetime(2025, 1, 1, 1))] + [("a", datetime(2025, 1, 2))]
    spark.createDataFrame(rows, "device_id string, t timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("device_id string, t timestamp").parquet(str(tmp_path / "in"))
    query = live_segments(stream, ["device_id"], "t").writeStream.format("memory").queryName("live").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    assert [r["size"] for r in spark.sql("SELECT * FROM live").collect()] == [5]


def test_typed_files(spark, tmp_path):
    (tmp_path / "25060113.TXT").write_text("1,2.5,400,50,x,1013,01.06.2025 11:00:00\n1,2,3,4,5,6,later\n")
    rows = tables.read_sensors(spark, str(tmp_path)).collect()
    assert rows[0]["CO2"] == 400.0 and rows[0]["Temp"] is None and str(rows[0]["timestamp"]) == "2025-06-01 11:00:00" and rows[1]["timestamp"] is None


def test_live_hours(spark, tmp_path):
    from driftlake.streaming.live import live_hours

    rows = [("a", datetime(2025, 1, 1, h, m), 0.5 + h / 10) for h in (0, 1) for m in (0, 30)] + [("a", datetime(2025, 1, 2), 0.9)]
    spark.createDataFrame(rows, "device_id string, t timestamp, confidence double").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("device_id string, t timestamp, confidence double").parquet(str(tmp_path / "in"))
    query = live_hours(stream, ["device_id"], "t").writeStream.format("memory").queryName("hours").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    assert sorted((r["hour"].hour, r["lines"]) for r in spark.sql("SELECT * FROM hours").collect()) == [(0, 2), (1, 2)]
