"""Statistics of corrections, files and runs, each one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlake.config import SECOND
from driftlake.functions.ordered import previous
from driftlake.session import settled


def share(condition: Column) -> Column:
    """The percentage of rows for which a condition holds."""
    return 100.0 * F.count_if(condition) / F.count("*")


def band_a(confidence: str = "confidence") -> Column:
    c = F.col(confidence)
    return F.when(c >= 0.9, "high").when(c >= 0.6, "medium").when(c.isNotNull(), "low")


def band_b(confidence: str = "confidence", closed: bool = False) -> Column:
    """The bands of the validation; a confidence of exactly 1 has none unless ``closed``."""
    c = F.col(confidence)
    top = (c >= 0.7) & ((c <= 1.0) if closed else (c < 1.0))
    return F.when(top, "high").when((c >= 0.5) & (c < 0.7), "medium").when((c >= 0.0) & (c < 0.5), "low")


def quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> dict[str, float | None]:
    """Exact quantiles of whole columns, interpolated between neighbours: ``{name: (column, share)}`` to ``{name: value}``.

    No task holds a column: equal values are counted, dealt to ordered ranges, and only the counts of the ranges
    come to the driver; the wanted places are then read from the ranges that hold them.
    """
    out: dict[str, float | None] = dict.fromkeys(wanted)
    for column in {c for c, _ in wanted.values()}:
        values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count("*").alias("n"))
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranged = settled(values.repartitionByRange(parts, "v").withColumn("part", F.spark_partition_id()))
        held = sorted((r["part"], r["n"]) for r in ranged.groupBy("part").agg(F.sum("n").alias("n")).collect())  # a row for each range
        total, before, at = sum(n for _, n in held), {}, 0
        for part, n in held:
            before[part] = at
            at += n
        if not total:
            continue
        places = {name: share * (total - 1) for name, (c, share) in wanted.items() if c == column}
        ranks = sorted({r for x in places.values() for r in (int(x), min(int(x) + 1, total - 1))})
        of = {r: max(p for p, n in before.items() if n <= r) for r in ranks}
        upto = F.sum("n").over(Window.partitionBy("part").orderBy("v"))
        offset = F.coalesce(*[F.when(F.col("part") == p, F.lit(before[p])) for p in sorted(set(of.values()))])
        rows = ranged.where(F.col("part").isin(sorted(set(of.values())))).select("v", (upto + offset).alias("last"), F.col("n"))
        hit = [(F.col("last") > r) & (F.col("last") - F.col("n") <= r) for r in ranks]
        found = rows.agg(*[F.max(F.when(h, F.col("v"))).alias(f"r{r}") for h, r in zip(hit, ranks, strict=True)]).first()
        for name, x in places.items():
            low, high = found[f"r{int(x)}"], found[f"r{min(int(x) + 1, total - 1)}"]
            out[name] = low + (high - low) * (x - int(x))
    return out


def spread_of(x: Column, name: str, range_too: bool = False, median: Column | None = None) -> list[Column]:
    """Mean, median, deviation and range of a column; without a key the ``median`` comes from :func:`quantiles`."""
    middle = F.median(x) if median is None else median
    out = [F.avg(x).alias(f"mean_{name}"), middle.alias(f"median_{name}"), F.stddev_samp(x).alias(f"std_{name}"), F.min(x).alias(f"min_{name}"), F.max(x).alias(f"max_{name}")]
    return out + ([(F.max(x) - F.min(x)).alias(f"range_{name}")] if range_too else [])


def drift_pattern(df: DataFrame) -> DataFrame:
    """The spread of the drift over all rows."""
    middle = quantiles(df, {"m": ("drift_seconds", 0.5)})["m"]
    return df.agg(*spread_of(F.col("drift_seconds"), "drift", True, F.lit(middle).cast("double")))


def alignment_stats(df: DataFrame, by: list[str]) -> DataFrame:
    """Counts, drift and confidence of each group, with its rows by method."""
    methods = df.groupBy(*by, "method").agg(F.count("*").alias("n"))
    maps = methods.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("method", "n")))).alias("alignment_methods"))  # a row for each method
    c = F.col("confidence")
    stats = df.groupBy(*by).agg(
        F.count("*").alias("num_samples"), *spread_of(F.col("drift_seconds"), "drift_seconds"), F.avg(c).alias("mean_confidence"),
        share(c >= 0.9).alias("pct_high_confidence"), share(c < 0.6).alias("pct_low_confidence"),
    )
    return stats.join(maps, by) if by else stats.crossJoin(F.broadcast(maps))  # one row each


def method_comparison(df: DataFrame) -> DataFrame:
    c, d = F.col("confidence"), F.col("drift_seconds")
    return df.groupBy("method").agg(
        F.round(F.avg(c), 2).alias("confidence_mean"), F.round(F.min(c), 2).alias("confidence_min"), F.round(F.max(c), 2).alias("confidence_max"),
        F.count("*").alias("count"), F.round(F.avg(d), 2).alias("drift_mean"), F.round(F.stddev_samp(d), 2).alias("drift_std"),
        F.round(F.min(d), 2).alias("drift_min"), F.round(F.max(d), 2).alias("drift_max"),
    )


def error_stats(df: DataFrame, by: list[str], error: str = "error_seconds", improvement: str = "correction_improvement") -> DataFrame:
    """Error statistics of matched rows: mean, median, root mean square, 95th percentile, maximum."""
    e = F.col(error)
    if by:
        middle, high = F.median(F.abs(e)), F.percentile(F.abs(e), F.lit(0.95))
    else:
        df = settled(df.select(error, improvement, F.abs(e).alias("_abs")))
        found = quantiles(df, {"m": ("_abs", 0.5), "p": ("_abs", 0.95)})
        middle, high = (F.lit(found[k]).cast("double") for k in "mp")
    return df.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), middle.alias("median_abs"), F.sqrt(F.avg(e * e)).alias("rmse"),
        high.alias("p95"), F.max(F.abs(e)).alias("max_abs"), F.avg(improvement).alias("mean_improvement"),
    )


def errors(matched: DataFrame) -> DataFrame:
    """``received``, ``aligned`` and ``rtc`` in microseconds to errors in seconds and what the correction gained."""
    error, raw = (F.col("aligned") - F.col("received")) / 1e6, (F.col("rtc") - F.col("received")) / 1e6
    return matched.withColumns({"error_seconds": error, "abs_error_seconds": F.abs(error), "rtc_error_seconds": raw, "correction_improvement": F.abs(raw) - F.abs(error)})


def invalid_confidence(df: DataFrame, confidence: str = "confidence") -> DataFrame:
    """The rows whose confidence lies outside [0, 1]; a null one is no number to test."""
    return df.where((F.col(confidence) < 0) | (F.col(confidence) > 1) | F.isnan(confidence))


def confidence_distribution(df: DataFrame, by: list[str]) -> DataFrame:
    c = F.col("confidence")
    return df.groupBy(*by).agg(
        F.avg(c).alias("mean_confidence"), F.median(c).alias("median_confidence"),
        share(c >= 0.9).alias("pct_high"), share((c >= 0.6) & (c < 0.9)).alias("pct_medium"), share(c < 0.6).alias("pct_low"),
    )


def counts_of(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row with a map from each value of a column of few values to its count."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(column, "n")))).alias(name))  # a row for each value


def quality_report(df: DataFrame, by: list[str]) -> DataFrame:
    """Totals, ranges, confidence, drift, segment sizes and method counts in one row; ``by`` are the keys that segment ids begin anew for."""
    sizes = settled(df.groupBy(*by, "segment_id").agg(F.count("*").alias("size")))
    middles = quantiles(df, {"c": ("confidence", 0.5), "d": ("drift_seconds", 0.5)}) | quantiles(sizes, {"s": ("size", 0.5)})
    middle = {k: F.lit(v).cast("double") for k, v in middles.items()}
    sizes = sizes.agg(F.count("*").alias("num_segments"), F.avg("size").alias("mean_segment"), middle["s"].alias("median_segment"))
    c, d = F.col("confidence"), F.col("drift_seconds")
    total = df.agg(
        F.count("*").alias("total"), F.min("rtc").alias("first_rtc"), F.max("rtc").alias("last_rtc"), F.min("aligned").alias("first_time"), F.max("aligned").alias("last_time"),
        *spread_of(c, "confidence", median=middle["c"]),
        share(c >= 0.9).alias("pct_high"), share((c >= 0.6) & (c < 0.9)).alias("pct_medium"), share(c < 0.6).alias("pct_low"),
        *spread_of(d, "drift", median=middle["d"]), ((F.max(d) - F.min(d)) / 3600).alias("drift_range_hours"),
    )
    return total.crossJoin(F.broadcast(sizes)).crossJoin(F.broadcast(counts_of(df, "method", "methods")))  # one row each


def load_check(rows: DataFrame, by: list[str], at: str, file: str, recovered: str, low, high) -> DataFrame:
    """What was loaded: rows, files, range, validity, duplicates and recovered rows."""
    valid = F.col(at).between(F.lit(low), F.lit(high))
    repeats = rows.groupBy(*by, at, file).agg(F.count("*").alias("_n")).groupBy(*by).agg(F.sum(F.col("_n") - 1).alias("duplicates"))
    total = rows.groupBy(*by).agg(
        F.count("*").alias("total_rows"), F.countDistinct(file).alias("files"), F.min(at).alias("first_time"), F.max(at).alias("last_time"),
        F.count_if(valid).alias("valid_rows"), (F.count("*") - F.count_if(valid)).alias("invalid_rows"), share(valid).alias("valid_pct"),
        F.count_if(recovered).alias("recovered_rows"), share(F.col(recovered)).alias("recovered_pct"), F.countDistinct(F.when(F.col(recovered), F.col(file))).alias("files_recovered"),
        F.count_if(F.col(recovered) & valid).alias("recovered_valid_rows"),
    )
    return total.join(repeats, by) if by else total.crossJoin(F.broadcast(repeats))  # one row each


def anchor_check(anchors: DataFrame, by: list[str], received: str = "received_at") -> DataFrame:
    """What was loaded of the anchors: points, ranges of both times, repeats of ``unix``, and points by format."""
    points = anchors.groupBy(*by, "unix", "format").agg(F.count("*").alias("_n"), F.min(received).alias("_lo"), F.max(received).alias("_hi"))
    formats = points.groupBy(*by, "format").agg(F.sum("_n").alias("n"))
    maps = formats.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("format", "n")))).alias("formats"))  # a row for each format
    units = points.groupBy(*by, "unix").agg(F.sum("_n").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    total = units.groupBy(*by).agg(
        F.sum("_n").alias("total_points"), F.min("_lo").alias("first_received"), F.max("_hi").alias("last_received"),
        F.min("unix").alias("first_unix"), F.max("unix").alias("last_unix"), (F.sum("_n") - F.count("*")).alias("duplicates"),
    )
    return total.join(maps, by) if by else total.crossJoin(F.broadcast(maps))  # one row each


def overlap(rows: DataFrame, anchors: DataFrame, by: list[str], at: str, anchor_at: str) -> DataFrame:
    """Whether series and anchors meet in time, and for how many days. Times in microseconds."""
    a = rows.groupBy(*by).agg(F.min(at).alias("a0"), F.max(at).alias("a1"))
    b = anchors.groupBy(*by).agg(F.min(anchor_at).alias("b0"), F.max(anchor_at).alias("b1"))
    both = a.join(b, by, "left") if by else a.crossJoin(F.broadcast(b))  # one row each
    start, end = F.greatest("a0", "b0"), F.least("a1", "b1")
    meets = F.coalesce(F.col("b0").isNotNull() & (start <= end), F.lit(False))
    return both.select(*by, meets.alias("overlaps"), F.when(meets, (end - start) / (86_400.0 * SECOND)).otherwise(0.0).alias("overlap_days"))


def file_qa(lines: DataFrame, file: list[str], at: str, order: str, expected_hour: Column, drift: str | None = None, gap_s: int = 300, samples: int | None = None, least: int = 0, files: DataFrame | None = None) -> DataFrame:
    """Order, reversals, gaps, hours and widths of each file.

    ``lines`` hold ``at`` in microseconds (null where unreadable), the line's ``order`` and ``n_fields``. A
    file is at most an hour of one device, so a window over it stays small. Files with fewer than ``least`` readable
    times are left out; ``files``, a list of all there are, adds those without lines.
    """
    seen = lines.where(F.col(at).isNotNull())
    within = Window.partitionBy(*file).orderBy(order)
    step = (F.col(at) - F.lag(at).over(within)) / SECOND
    stepped = seen.withColumn("_step", step).withColumn("_i", F.row_number().over(within) - 1).withColumn("_hour", expected_hour)
    right = F.hour(F.timestamp_micros(at)) == F.col("_hour")
    s = F.col("_step")
    out = stepped.groupBy(*file).agg(
        F.count("*").alias("num_valid_timestamps"), (F.count_if(s < 0) == 0).alias("is_chronological"), F.count_if(s < 0).alias("num_reversals"),
        F.min(F.when(s < 0, F.col("_i"))).alias("first_reversal"), F.abs(F.min(F.when(s < 0, s))).alias("max_reversal_seconds"),
        F.max(s).alias("max_gap_seconds"), F.avg(s).alias("mean_gap_seconds"), F.median(s).alias("median_gap_seconds"), F.count_if(s > gap_s).alias("num_large_gaps"),
        F.first("_hour").alias("expected_hour"), share(right).alias("correct_hour_pct"),
        F.min(at).alias("start_time"), F.max(at).alias("end_time"), ((F.max(at) - F.min(at)) / (60.0 * SECOND)).alias("duration_minutes"),
        F.min("n_fields").alias("min_fields"), F.max("n_fields").alias("max_fields"), (F.countDistinct("n_fields") > 1).alias("inconsistent_fields"),
        F.avg(drift if drift else F.lit(None).cast("double")).alias("mean_drift_seconds"),
    )
    total = lines.groupBy(*file).agg(F.count("*").alias("num_lines"))
    if files is not None:
        total = files.select(*file).join(total, file, "left").withColumn("num_lines", F.coalesce("num_lines", F.lit(0)))
    out = total.join(out, file, "left").withColumn("expected_samples", F.lit(samples).cast("long"))
    if least:
        out = out.where(F.col("num_valid_timestamps") >= least)
    return out.withColumn("sample_count_deviation", F.col("num_valid_timestamps") - F.col("expected_samples"))


def file_status(qa: DataFrame) -> DataFrame:
    """``qa`` with ``status`` and ``num_issues``."""
    n = F.col("num_valid_timestamps")
    issues = F.array_compact(F.array(
        F.when(~F.col("is_chronological"), F.lit("NOT_CHRONOLOGICAL")),
        F.when(F.col("num_reversals") > 0, F.concat(F.col("num_reversals").cast("string"), F.lit("_REVERSALS"))),
        F.when(F.col("num_large_gaps") > 0, F.concat(F.col("num_large_gaps").cast("string"), F.lit("_LARGE_GAPS"))),
        F.when(F.col("correct_hour_pct") < 80, F.lit("WRONG_HOUR")),
        F.when(F.abs("sample_count_deviation") > 0.2 * F.col("expected_samples"), F.lit("UNEXPECTED_COUNT")),
    ))
    status = F.when(F.col("num_lines") == 0, "EMPTY").when(n.isNull() | (n == 0), "NO_VALID_TIMESTAMPS").when(F.size(issues) == 0, "OK").otherwise(F.array_join(issues, "; "))
    return qa.withColumn("status", status).withColumn("num_issues", F.when(n > 0, F.size(issues)))


def problem_files(qa: DataFrame) -> DataFrame:
    return qa.where(~F.col("is_chronological") | (F.col("num_reversals") > 0) | (F.col("correct_hour_pct") < 80))


def qa_report(status: DataFrame) -> DataFrame:
    """Totals over all checked files."""
    return status.agg(
        F.count("*").alias("files"), F.count_if(F.col("status") == "OK").alias("ok_files"), F.sum("num_lines").alias("lines"), F.avg("num_lines").alias("mean_lines"),
        F.count_if("is_chronological").alias("chronological_files"), F.sum("num_reversals").alias("reversals"), F.sum("num_large_gaps").alias("large_gaps"),
        F.avg("correct_hour_pct").alias("mean_hour_pct"), F.count_if(F.col("correct_hour_pct") >= 80).alias("files_in_hour"),
    )


def top_issues(status: DataFrame, name: list[str], n: int = 10) -> DataFrame:
    """The files with the most issues."""
    return status.orderBy(F.desc("num_issues"), *name).limit(n)


def interval_stats(df: DataFrame, by: list[str], at: str, order: list[str], expected_s: float, near: tuple[float, float]) -> DataFrame:
    """Steps between rows: spread, and how many are as expected, nearly so, or over a minute."""
    steps = previous(df, by, at, order, "_p", 7 * 86_400 * SECOND).where("_p IS NOT NULL").withColumn("s", (F.col(at) - F.col("_p")) / SECOND)
    s = F.col("s")
    return steps.groupBy(*by).agg(
        F.count("*").alias("intervals"), F.avg(s).alias("mean_s"), F.median(s).alias("median_s"), F.stddev_pop(s).alias("std_s"),
        share(F.abs(s - expected_s) < 0.1).alias("pct_exact"), share(s.between(*near)).alias("pct_near"), F.count_if(s > 60).alias("over_minute"),
    )


def gap_stats(df: DataFrame, by: list[str], at: str, order: list[str], limit_s: int = 600) -> DataFrame:
    """Count, mean, median, greatest and total of the steps over a limit."""
    steps = previous(df, by, at, order, "_p", 7 * 86_400 * SECOND).withColumn("s", (F.col(at) - F.col("_p")) / SECOND).where(F.col("s") > limit_s)
    return steps.groupBy(*by).agg(F.count("*").alias("gaps"), F.avg("s").alias("mean_s"), F.median("s").alias("median_s"), F.max("s").alias("max_s"), F.sum("s").alias("total_s"))


def lines_per_file(df: DataFrame, file: list[str], expected: int) -> DataFrame:
    """Spread of the files' line counts, and how much of the expected lines is there."""
    n, sizes = F.col("n"), settled(df.groupBy(*file).agg(F.count("*").alias("n")))
    middle = F.lit(quantiles(sizes, {"m": ("n", 0.5)})["m"]).cast("double")
    return sizes.agg(
        F.count("*").alias("files"), F.avg(n).alias("mean_lines"), middle.alias("median_lines"), F.min(n).alias("min_lines"), F.max(n).alias("max_lines"),
        F.stddev_pop(n).alias("std_lines"), (100.0 * F.sum(n) / (F.count("*") * expected)).alias("coverage_pct"),
    )


def file_spans(df: DataFrame, file: list[str], at: str) -> DataFrame:
    """Minutes that each file spans, and the minute of the hour it starts at."""
    start = F.timestamp_micros(F.min(at))
    return df.groupBy(*file).agg(((F.max(at) - F.min(at)) / (60.0 * SECOND)).alias("minutes"), (F.minute(start) + F.second(start) / 60.0).alias("start_minute"))


def span_summary(spans: DataFrame) -> DataFrame:
    spans, m = settled(spans), F.col("minutes")
    middle = F.lit(quantiles(spans, {"m": ("minutes", 0.5)})["m"]).cast("double")
    return spans.agg(F.count("*").alias("files"), F.avg(m).alias("mean_minutes"), middle.alias("median_minutes"), F.count_if(m < 45).alias("under_45"), F.count_if(m < 30).alias("under_30"), F.avg("start_minute").alias("mean_start_minute"))


def reconcile(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """Rows of a table against lines of its files; a difference of over one percent is critical."""
    both = rows.agg(F.count("*").alias("rows")).crossJoin(F.broadcast(lines.agg(F.count("*").alias("lines"))))  # one row each
    pct = F.when(F.col("rows") > 0, 100.0 * F.abs(F.col("rows") - F.col("lines")) / F.col("rows")).otherwise(F.when(F.col("lines") > 0, 100.0).otherwise(0.0))
    return both.withColumn("difference_pct", pct).withColumn("is_critical", pct > 1)


def score_label(score: Column, bounds: tuple[int, int, int], third: str) -> Column:
    a, b, c = bounds
    return F.when(score >= a, "excellent").when(score >= b, "good").when(score >= c, third).otherwise("poor")


def quality_score(totals: DataFrame) -> DataFrame:
    """The weighted score of ``valid_pct, chronological_pct, interval_pct, duplicate_free_pct``."""
    score = 0.3 * F.col("valid_pct") + 0.3 * F.col("chronological_pct") + 0.2 * F.col("interval_pct") + 0.2 * F.col("duplicate_free_pct")
    return totals.withColumn("quality_score", score).withColumn("quality_label", score_label(score, (95, 85, 70), "fair"))


def verdict(totals: DataFrame) -> DataFrame:
    """The final score of ``critical, quality_score, reversals, duplicates``."""
    q = F.col("quality_score")
    score = (
        F.when(F.col("critical") == 0, 40).otherwise(0) + F.when(q >= 90, 30).when(q >= 80, 20).when(q >= 70, 10).otherwise(0)
        + F.when(F.col("reversals") == 0, 15).otherwise(0) + F.when(F.col("duplicates") < 10, 15).otherwise(0)
    )
    return totals.withColumn("verdict_score", score).withColumn("verdict", score_label(score, (90, 75, 50), "acceptable"))


def severity_lists(issues: DataFrame, shown: int | None = None) -> DataFrame:
    """Issues with their ``severity``, one of four, and ``place`` among those of it, in the order of ``number``.

    Rows stay rows: ranges of the order are numbered each by itself and offset by the counts of those before, so a
    severity's issues never meet in one task. With ``shown`` only the first ones of each severity are returned.
    """
    severity = F.coalesce(F.lower("severity"), F.lit("other"))
    known = F.when(severity.isin("critical", "warning", "info"), severity).otherwise("other")
    rows = issues.select(known.alias("severity"), "number", "message")
    parts = int(issues.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settled(rows.repartitionByRange(parts, "severity", "number", "message").withColumn("_part", F.spark_partition_id()))
    held = ranged.groupBy("severity", "_part").agg(F.count("*").alias("_n"))  # a row for each range and severity in it
    before = held.select("severity", "_part", (F.sum("_n").over(Window.partitionBy("severity").orderBy("_part")) - F.col("_n")).alias("_before"))
    spot = F.row_number().over(Window.partitionBy("severity", "_part").orderBy("number", "message"))
    out = ranged.withColumn("_spot", spot).join(F.broadcast(before), ["severity", "_part"])
    out = out.select("severity", (F.col("_before") + F.col("_spot")).alias("place"), "number", "message")
    return out if shown is None else out.where(F.col("place") <= shown)


def severity_counts(issues: DataFrame) -> DataFrame:
    severity = F.coalesce(F.lower("severity"), F.lit("other"))
    known = F.when(severity.isin("critical", "warning", "info"), severity).otherwise("other")
    return issues.groupBy(known.alias("severity")).agg(F.count("*").alias("n"))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int = 50) -> DataFrame:
    """Counts in equal bins; the last one includes ``high``."""
    spot = F.least(F.floor((F.col(column) - low) / ((high - low) / bins)), F.lit(bins - 1)).cast("int")
    return df.where(F.col(column).between(low, high)).groupBy(spot.alias("bin")).agg(F.count("*").alias("n"))


def drift_line(df: DataFrame, by: list[str], points: int = 1000) -> DataFrame:
    """Plot data of the drift over time: its mean, least and greatest in ``points`` equal spans of each series."""
    ends = df.groupBy(*by).agg(F.min("aligned").alias("_lo"), F.max("aligned").alias("_hi"))
    spot = F.least(F.floor((F.col("aligned") - F.col("_lo")) * F.lit(points) / (F.col("_hi") - F.col("_lo") + 1)), F.lit(points - 1)).cast("int")
    d = F.col("drift_seconds")
    return df.join(F.broadcast(ends), by).groupBy(*by, spot.alias("bin")).agg(F.count("*").alias("n"), F.avg(d).alias("mean_drift"), F.min(d).alias("min_drift"), F.max(d).alias("max_drift"))


def segment_bars(df: DataFrame, by: list[str]) -> DataFrame:
    """Plot data of the segments: rows and mean confidence of each."""
    return df.groupBy(*by, "segment_id").agg(F.count("*").alias("n"), F.avg("confidence").alias("mean_confidence"))


def keyed_hash(seed: int, *columns: str) -> Column:
    """A digest of the columns' texts, the same in every engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws(":", *[F.col(c).cast("string") for c in columns])))


def plot_sample(df: DataFrame, keys: list[str], n: int = 10_000, seed: int = 42) -> DataFrame:
    """At most ``n`` rows for a scatter plot, the same on every run: the first by a digest of their ``keys``."""
    return df.orderBy(keyed_hash(seed, *keys), *keys).limit(n)


def shortest(spans: DataFrame, file: list[str], n: int = 10) -> DataFrame:
    """The files that span the fewest minutes."""
    return spans.orderBy("minutes", *file).limit(n)


def sensor_summary(df: DataFrame, file: list[str], at: str, sensors: list[str], order: list[str]) -> DataFrame:
    """Rows, range, steps and sensor statistics of each hourly file."""
    within = Window.partitionBy(*file).orderBy(at, *order)
    s = F.col("_s")
    parts = [c for x in sensors for c in (F.avg(x).alias(f"{x}_mean"), F.stddev_samp(x).alias(f"{x}_std"))]
    return df.withColumn("_s", (F.col(at) - F.lag(at).over(within)) / SECOND).groupBy(*file).agg(
        F.count("*").alias("num_samples"), F.min(at).alias("start_time"), F.max(at).alias("end_time"),
        ((F.max(at) - F.min(at)) / (60.0 * SECOND)).alias("duration_minutes"), F.avg(s).alias("mean_interval"), F.max(s).alias("max_gap"), *parts,
    )


def holdout(anchors: DataFrame, by: list[str], fraction: float = 0.2, least: int = 50, seed: int = 42) -> DataFrame:
    """``anchors`` with ``is_test``, a split by a digest of ``unix`` that needs no shuffle of rows.

    Series with fewer than ``least`` anchors have no test rows.
    """
    size = anchors.groupBy(*by).agg(F.count("*").alias("_n"))
    number = F.conv(F.substring(keyed_hash(seed, "unix"), -7, 7), 16, 10).cast("long")
    return anchors.join(size, by).withColumn("is_test", (number % 10_000 < int(10_000 * fraction)) & (F.col("_n") >= least)).drop("_n")


def summary(df: DataFrame, qa: DataFrame, by: list[str], direct: DataFrame | None = None, holdout_errors: DataFrame | None = None) -> DataFrame:
    """The run's report as one row of nested structs; ``by`` are the keys that segment ids begin anew for.

    ``direct`` and ``holdout_errors`` are one-row results of :func:`error_stats`.
    """
    c, d = F.col("confidence"), F.col("drift_seconds")
    main = df.agg(
        F.struct(
            F.count("*").alias("rows"), F.countDistinct(F.struct(*by, "segment_id")).alias("segments"), F.min("rtc").alias("first_rtc"), F.max("rtc").alias("last_rtc"),
            F.min("aligned").alias("first"), F.max("aligned").alias("last"),
        ).alias("data"),
        F.struct(share(c >= 0.9).alias("high_pct"), share((c >= 0.6) & (c < 0.9)).alias("medium_pct"), share(c < 0.6).alias("low_pct"), F.avg(c).alias("mean")).alias("confidence"),
        F.struct(F.avg(d).alias("mean_s"), F.min(d).alias("min_s"), F.max(d).alias("max_s"), (F.avg(d) / 86_400).alias("mean_days"), (F.max(d) / 86_400).alias("max_days")).alias("drift"),
    )
    files = qa.agg(F.struct(
        F.count("*").alias("files"), F.sum("num_lines").alias("lines"), F.count_if("is_chronological").alias("chronological_files"), F.count_if(F.col("num_reversals") > 0).alias("files_with_reversals"),
        F.sum("num_reversals").alias("reversals"), F.sum("num_large_gaps").alias("large_gaps"), F.avg("correct_hour_pct").alias("mean_hour_pct"),
    ).alias("output"))
    out = main.crossJoin(F.broadcast(files))  # one row each
    for name, stats_row in (("direct_validation", direct), ("holdout_validation", holdout_errors)):
        if stats_row is not None:
            out = out.crossJoin(F.broadcast(stats_row.select(F.struct("*").alias(name))))
    return out
