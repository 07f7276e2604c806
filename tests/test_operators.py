"""Tie and boundary rules of the correction operators, and differential tests against pandas and numpy."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from driftlake.config import SECOND, Settings
from driftlake.functions import stats
from driftlake.functions.ordered import previous, running_total
from driftlake.operators import align, matching, rebuild, segment

BY = ["device_id"]


def test_segments_follow_gap_and_size_rules(spark):
    times = [0, 120, 240, 360, 480, 601, 700, 800, 900, 1100, 1200, 1300, 1400, 1500]
    df = spark.createDataFrame([("a", t) for t in times], "device_id string, t long")
    got = {r["t"]: r["segment_id"] for r in segment.segments(df, BY, "t", [], 120, 4, 500).collect()}
    assert [t for t in times if got.get(t) == 0] == [0, 120, 240, 360, 480]  # a step of 120 stays, 121 splits
    assert [t for t in times if got.get(t) == 1] == [601, 700, 800, 900]
    assert [t for t in times if got.get(t) == 2] == [1100, 1200, 1300, 1400, 1500]
    assert set(r["t"] for r in segment.segments(df, BY, "t", [], 120, 5, 500).collect()) == {0, 120, 240, 360, 480, 1100, 1200, 1300, 1400, 1500}


@pytest.mark.parametrize("width", [50, 10_000])
def test_nearest_equals_merge_asof(spark, width):
    rng = np.random.default_rng(3)
    left = pd.DataFrame({"t": np.sort(rng.integers(0, 900, 120))}).drop_duplicates()
    right = pd.DataFrame({"u": np.sort(rng.integers(0, 900, 80)), "v": np.arange(80)})
    want = pd.merge_asof(left, right, left_on="t", right_on="u", direction="nearest", tolerance=7)
    probes = spark.createDataFrame([("a", int(t)) for t in left.t], "device_id string, t long")
    rows = spark.createDataFrame([("a", int(u), int(v)) for u, v in right.itertuples(index=False)], "device_id string, u long, v long")
    got = matching.nearest(probes, rows, BY, "t", "u", 7, width=width).select("t", F.col("match.u").alias("u")).toPandas().sort_values("t")
    assert [None if x != x else x for x in got.u.tolist()] == [None if x != x else x for x in want.u.tolist()]


def test_nearest_tolerance_and_ties(spark):
    probes = spark.createDataFrame([("a", 100), ("b", 5)], "device_id string, t long")
    rows = spark.createDataFrame([("a", 70), ("a", 130)], "device_id string, u long")
    inside = {r["device_id"]: r["match"] for r in matching.nearest(probes, rows, BY, "t", "u", 30).collect()}
    assert inside["a"]["u"] == 70 and inside["b"] is None
    assert all(r["match"] is None for r in matching.nearest(probes, rows, BY, "t", "u", 30, strict=True).collect())


@pytest.mark.parametrize("width", [60, 1_000_000])
def test_interpolation_equals_numpy(spark, width):
    rng = np.random.default_rng(5)
    unix = np.sort(rng.choice(2000, 25, replace=False)) + 1000
    drift = rng.integers(-5000, 5000, 25) / 1000
    anchors = spark.createDataFrame([("a", int(u), int(u * SECOND + round(d * 1e6))) for u, d in zip(unix, drift)], "device_id string, unix long, received long")
    x = np.unique(np.concatenate([unix, rng.integers(0, 4000, 200)]))
    rows = spark.createDataFrame([("a", int(t)) for t in x], "device_id string, unix_time long")
    got = align.interpolate(rows, anchors, BY, width=width).toPandas().sort_values("unix_time")
    assert np.allclose(got.interp_drift, np.interp(x, unix, drift), atol=1e-9)


def test_interpolation_confidence_ladder(spark):
    anchors = spark.createDataFrame([("a", t, t * SECOND) for t in (100_000, 103_599, 107_199, 114_399, 200_799)], "device_id string, unix long, received long")
    x = {100_000: 0.7, 100_001: 0.9, 103_600: 0.85, 107_200: 0.8, 114_400: 0.5, 96_401: 0.5, 96_400: 0.3, 13_601: 0.3, 13_600: 0.2, 204_398: 0.5, 204_399: 0.3}
    rows = spark.createDataFrame([("a", t) for t in x], "device_id string, unix_time long")
    got = {r["unix_time"]: r["interp_confidence"] for r in align.interpolate(rows, anchors, BY).collect()}
    assert got == x


def test_no_anchor_gives_no_time(spark):
    anchors = spark.createDataFrame([("b", 5, 5 * SECOND)], "device_id string, unix long, received long")
    rows = spark.createDataFrame([("a", 0, 0, 0, 7 * SECOND), ("a", 0, 0, 0, 9 * SECOND)], "device_id string, segment_id int, position int, line int, rtc long")
    out = align.align(rows, anchors, BY).collect()
    assert [(r["aligned"], r["confidence"], r["method"]) for r in out] == [(None, None, "interpolated_drift")] * 2


def test_match_quality_boundaries(spark):
    anchors = spark.createDataFrame([("a", 1_000_000, 1_000_000 * SECOND + 2 * SECOND)], "device_id string, unix long, received long")
    steps = [10, 11, 300, 301, 3600, 3601, 86_400, 86_401, 604_800, 604_801]
    probes = spark.createDataFrame([("a", 1_000_000 + s) for s in steps], "device_id string, t long")
    got = {r["t"] - 1_000_000: r for r in matching.closest_anchor(probes, anchors, BY, "t").collect()}
    want = ["excellent", "good", "good", "acceptable", "acceptable", "poor", "poor", "interpolated", "interpolated", "no_nearby_reference"]
    assert [got[s]["match_quality"] for s in steps] == want
    assert got[86_401]["match_received"] == (1_086_401 + 2) * SECOND and got[604_801]["match_received"] is None


def test_back_propagation_and_groups(spark):
    rows = [("a", 0, 0, 10, 10, 0.5, "x"), ("a", 0, 0, 20, 20, 0.65, "y"), ("a", 0, 0, 30, 37, 0.7, "z"), ("a", 0, 1, 5, 5, 0.1, "x")]
    df = spark.createDataFrame(rows, "device_id string, segment_id int, position int, rtc long, aligned long, confidence double, concat_group_id string").withColumn("drift_seconds", F.lit(0.0))
    back = {(r["position"], r["rtc"]): r["aligned"] for r in align.propagate_back(df, BY).collect()}
    assert back == {(0, 10): 17, (0, 20): 20, (0, 30): 37, (1, 5): 5}
    grouped = {r["rtc"]: r["aligned"] for r in align.correct_groups(df, ["concat_group_id"], ["position"]).collect()}
    assert grouped == {10: 10, 5: 5, 20: 20, 30: 37}


def test_spreading_keeps_the_first_and_bounds_steps(spark):
    rows = [("a", 100 * SECOND, t * SECOND, i) for i, t in enumerate([0, 2, 3, 23, 44, 44])]
    df = spark.createDataFrame(rows, "device_id string, at long, rtc long, n int")
    got = [r["spread"] // SECOND - 100 for r in rebuild.spread(df, BY, "at", "rtc", ["n"], 5).orderBy("n").collect()]
    assert got == [0, 2, 7, 27, 32, 37]


def test_local_hours_over_both_clock_changes(spark):
    df = spark.createDataFrame([("2025-10-26 00:30:00",), ("2025-10-26 01:30:00",), ("2025-03-30 00:59:59",), ("2025-03-30 01:00:00",)], "t string")
    df = df.select(F.unix_micros(F.col("t").cast("timestamp")).alias("at"))
    got = [r["hour_key"] for r in rebuild.local_hours(df, "at", "Europe/Copenhagen").collect()]
    assert got == ["25102602", "25102602", "25033001", "25033003"]


def test_coverage_gaps(spark):
    df = spark.createDataFrame([("a", "2025-01-01 00:10:00"), ("a", "2025-01-01 01:00:00"), ("a", "2025-01-01 05:59:00"), ("b", "2025-01-01 05:00:00")], "device_id string, s string")
    got = rebuild.coverage_gaps(df.withColumn("hour", F.col("s").cast("timestamp")), BY, "hour").collect()
    gaps = {r["device_id"]: (str(r["gap_start"]), str(r["gap_end"]), r["duration_hours"], r["status"]) for r in got}
    assert gaps == {"a": ("2025-01-01 02:00:00", "2025-01-01 04:00:00", 3, "missing"), "b": ("None", "None", None, "complete")}
    both = rebuild.coverage_gaps(df.where("device_id = 'b'").withColumn("hour", F.col("s").cast("timestamp")), BY, "hour", "2025-01-01 04:00:00", "2025-01-01 07:00:00").collect()
    assert sorted((str(r["gap_start"]), r["duration_hours"]) for r in both) == [("2025-01-01 04:00:00", 1), ("2025-01-01 06:00:00", 2)]


def test_bands(spark):
    df = spark.createDataFrame([(0.4,), (0.5,), (0.7,), (1.0,)], "confidence double")
    assert [r["b"] for r in df.select(stats.band_b().alias("b")).collect()] == ["low", "medium", "high", None]
    assert [r["b"] for r in df.select(stats.band_a().alias("b")).collect()] == ["low", "low", "medium", "high"]


def test_ordered_helpers_do_not_depend_on_the_bucket(spark):
    rng = np.random.default_rng(1)
    rows = [("ab"[int(d)], int(t), int(i)) for i, (d, t) in enumerate(zip(rng.integers(0, 2, 200), rng.integers(0, 5000, 200)))]
    df = spark.createDataFrame(rows, "device_id string, t long, n long")
    one, many = (running_total(previous(df, BY, "t", ["n"], "p", w), BY, "t", ["n"], {"s": F.col("n")}, w).toPandas().sort_values("n").reset_index(drop=True) for w in (100_000, 37))
    pd.testing.assert_frame_equal(one, many)


def test_empty_series(spark):
    rows = spark.createDataFrame([], "device_id string, segment_id int, position int, rtc long")
    anchors = spark.createDataFrame([], "device_id string, unix long, received long")
    assert align.borrow_positions(align.align(rows, anchors, BY), BY).count() == 0
    with pytest.raises(ValueError):
        align.align(rows, anchors, BY, "best", Settings())


def test_quantiles_equal_the_exact_ones(spark):
    import random

    import numpy as np

    from driftlake.functions import stats

    rng = random.Random(3)
    for values in ([rng.choice([1.5, rng.random(), float(rng.randint(0, 5))]) for _ in range(999)], [2.0] * 50, [7.25], [1.0, None, 4.0]):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        got = stats.quantiles(df, {"low": ("x", 0.0), "middle": ("x", 0.5), "high": ("x", 0.95), "top": ("x", 1.0)})
        known = [v for v in values if v is not None]
        assert [got[k] for k in ("low", "middle", "high", "top")] == pytest.approx([np.quantile(known, q) for q in (0, 0.5, 0.95, 1)])
    assert stats.quantiles(spark.createDataFrame([], "x double"), {"m": ("x", 0.5)}) == {"m": None}


def test_statuses_and_ranges(spark):
    from driftlake.functions import stats

    lines = spark.createDataFrame([("a", 1, 0, 3), ("a", 2, 5_000_000, 3), ("b", 1, None, 1), ("c", 1, 7, 2)], "f string, i int, at long, n_fields int")
    files = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "f string")
    qa = stats.file_qa(lines, ["f"], "at", "i", F.lit(0), samples=2, files=files)
    assert {r["f"]: r["status"] for r in stats.file_status(qa).collect()} == {"a": "OK", "b": "NO_VALID_TIMESTAMPS", "c": "UNEXPECTED_COUNT", "d": "EMPTY"}
    assert [r["f"] for r in stats.file_qa(lines, ["f"], "at", "i", F.lit(0), least=2).collect()] == ["a"]
    odd = spark.createDataFrame([(0.0,), (1.0,), (-0.1,), (1.1,), (None,), (float("nan"),)], "confidence double")
    assert stats.invalid_confidence(odd).count() == 3


def test_a_mean_at_the_bound_is_no_problem_in_any_order(spark):
    """Sums of doubles put a mean of exactly 0.6 below or above it, by the order of the rows."""
    values = (0.5, 0.9, 0.7, 0.3)
    found = [("a", i, float(c)) for i, order in enumerate(itertools.permutations(values)) for c in order]
    df = spark.createDataFrame([*found, ("b", 0, 0.59), ("b", 0, 0.6), ("c", 0, float("nan")), ("c", 0, 0.1), ("d", 0, None), ("d", 0, 0.5)], "device_id string, segment_id int, confidence double")
    got = [(r["device_id"], r["segment_id"], r["rows"]) for r in segment.problem_segments(df.coalesce(1), BY).collect()]
    assert got == [("d", 0, 2), ("b", 0, 2)]
