"""Every operator as a query over the ``events`` table, with its DuckDB equivalent.

Events stand in for telemetry: a user is a device, sign-ups are anchors whose drift is their value in
milliseconds, other events are measurements; a user's day is a file. Doubles are rounded to six digits on
both sides, since sums may differ in their last bit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.config import SECOND, Settings
from driftlake.functions import stats
from driftlake.operators import align, matching, rebuild, segment
from driftlake.session import settled
from driftlake.sinks import writers
from driftlake.sources import anchors as anchor_source
from driftlake.sources import sd_text, tables

BY = ["user_id"]
GAP = 43_200 * SECOND
DAY_US = 86_400 * SECOND
WIDE = 7 * DAY_US
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CTE = """
ev AS (SELECT event_id, epoch_us(ts) AS us, user_id, event_type, value FROM events),
anchors AS (SELECT user_id, us // 1000000 AS unix, min((us // 1000000) * 1000000 + CAST(round(value * 1000) AS BIGINT) * 1000) AS received
  FROM ev WHERE event_type = 'signup' GROUP BY ALL),
rows AS (SELECT event_id, user_id, us AS rtc, us // 1000000 AS unix_time, (event_id % 3)::INTEGER AS position FROM ev WHERE event_type <> 'signup')
"""
SEG = CTE + f""",
s0 AS (SELECT *, CASE WHEN rtc - lag(rtc) OVER w <= {GAP} THEN 0 ELSE 1 END AS n FROM rows WINDOW w AS (PARTITION BY user_id ORDER BY rtc, event_id)),
s1 AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY rtc, event_id ROWS UNBOUNDED PRECEDING) AS run FROM s0),
s2 AS (SELECT *, count(*) OVER (PARTITION BY user_id, run) AS c FROM s1),
seg AS (SELECT event_id, user_id, rtc, unix_time, position, (dense_rank() OVER (PARTITION BY user_id ORDER BY run) - 1)::INTEGER AS segment_id FROM s2 WHERE c >= 2)
"""
INTERP = """,
around AS (SELECT r.*, a.unix AS x0, (a.received - a.unix * 1000000) / 1e6 AS d0, b.unix AS x1, (b.received - b.unix * 1000000) / 1e6 AS d1
  FROM {rows} r ASOF LEFT JOIN anchors a ON r.user_id = a.user_id AND r.unix_time > a.unix
  ASOF LEFT JOIN anchors b ON r.user_id = b.user_id AND r.unix_time <= b.unix),
interp AS (SELECT *, CASE WHEN x1 IS NULL THEN d0 WHEN x0 IS NULL OR x1 = unix_time THEN d1
    ELSE (d1 - d0) / (x1 - x0) * (unix_time - x0) + d0 END AS interp_drift,
  CASE WHEN x0 IS NULL AND x1 IS NULL THEN NULL WHEN x0 IS NULL AND x1 = unix_time THEN 0.7
    WHEN x1 IS NULL OR x0 IS NULL THEN CASE WHEN coalesce(unix_time - x0, x1 - unix_time) < 3600 THEN 0.5 WHEN coalesce(unix_time - x0, x1 - unix_time) < 86400 THEN 0.3 ELSE 0.2 END
    WHEN x1 - x0 < 3600 THEN 0.9 WHEN x1 - x0 < 7200 THEN 0.85 WHEN x1 - x0 < 14400 THEN 0.8 WHEN x1 - x0 < 86400 THEN 0.7 ELSE 0.5 END::DOUBLE AS interp_confidence
  FROM around)
"""
CLOSEST = """
SELECT p.*, CASE WHEN hit THEN m_unix END AS matched_unix,
  CASE WHEN hit THEN m_received WHEN n > 0 THEN CAST(round(x * 1e6 + s / n) AS BIGINT) END AS match_received, CASE WHEN hit THEN dist END AS match_delta,
  CASE WHEN m_unix IS NULL THEN 'no_reference_data' WHEN hit THEN CASE WHEN dist <= 10 THEN 'excellent' WHEN dist <= 300 THEN 'good' WHEN dist <= 3600 THEN 'acceptable' ELSE 'poor' END
    WHEN n > 0 THEN 'interpolated' ELSE 'no_nearby_reference' END AS match_quality
FROM (SELECT *, abs(x - m_unix) AS dist, coalesce(abs(x - m_unix) <= 86400, false) AS hit FROM (
  SELECT p.*, CASE WHEN b.unix IS NULL OR p.x - a.unix <= b.unix - p.x THEN a.unix ELSE b.unix END AS m_unix,
    CASE WHEN b.unix IS NULL OR p.x - a.unix <= b.unix - p.x THEN a.received ELSE b.received END AS m_received
  FROM {probes} p ASOF LEFT JOIN anchors a ON p.user_id = a.user_id AND p.x >= a.unix ASOF LEFT JOIN anchors b ON p.user_id = b.user_id AND p.x < b.unix)) p
LEFT JOIN (SELECT p.id AS near_id, count(*) AS n, sum(a.received - a.unix * 1000000)::BIGINT AS s FROM {probes} p JOIN anchors a ON a.user_id = p.user_id AND a.unix BETWEEN p.x - 604800 AND p.x + 604800 GROUP BY ALL) ON near_id = p.id
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    return df.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "user_id", "event_type", "value")


def anchors_of(ev: DataFrame) -> DataFrame:
    unix = F.expr("us div 1000000")
    received = unix * 1_000_000 + F.round(F.col("value") * 1000).cast("long") * 1000
    return rebuild.distinct_anchors(ev.where("event_type = 'signup'").select("user_id", unix.alias("unix"), received.alias("received")), BY)


def rows_of(ev: DataFrame) -> DataFrame:
    return ev.where("event_type <> 'signup'").select("event_id", "user_id", F.col("us").alias("rtc"), F.expr("us div 1000000").alias("unix_time"), F.expr("cast(event_id % 3 as int)").alias("position"))


def segments_of(ev: DataFrame) -> DataFrame:
    return settled(segment.segments(rows_of(ev), BY, "rtc", ["event_id"], GAP, 2, WIDE))


#: Added before rounding: engines break decimal ties differently, and no true digit is this small.
NUDGE = 1.3e-9


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[(F.round(F.col(c) + NUDGE, 6) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _rounded_sql(sql: str) -> str:
    """``round(x, 4)`` of the oracles as what :func:`rounded` does."""
    out, at = [], 0
    while (start := sql.find("round(", at)) >= 0:
        depth, end = 1, start + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = _rounded_sql(sql[start + 6 : end - 1])
        whole = f"(round(({inner[:-3]}) + {NUDGE}::DOUBLE, 6) + 0.0::DOUBLE)" if inner.endswith(", 4") else f"round({inner})"
        out += [sql[at:start], whole]
        at = end
    return "".join(out) + sql[at:]


def query(sql: str | None = None, cte: str = CTE):
    """Register a function of the events under its name, with its oracle."""

    def put(f: Callable[[DataFrame], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: rounded(f(events(spark, sf_dir)))
        if sql:
            ORACLES[f.__name__] = _rounded_sql(f"WITH {cte} {sql}")
        return f

    return put


# interpolation and matching


@query("SELECT event_id, user_id, CAST(round((unix_time + interp_drift) * 1e6) AS BIGINT) AS interp_time, round(interp_drift, 4) AS interp_drift, interp_confidence FROM interp", CTE + INTERP.format(rows="rows"))
def interp_drift(ev):
    out = align.interpolate(rows_of(ev), anchors_of(ev), BY)
    return out.select("event_id", "user_id", "interp_time", "interp_drift", "interp_confidence")


NEAREST = """SELECT unix, user_id, CASE WHEN d {op} 3600000000 THEN m END AS matched, CASE WHEN d {op} 3600000000 THEN d END AS distance FROM (SELECT *, abs(received - m) AS d FROM (
  SELECT p.*, CASE WHEN b.rtc IS NULL OR p.received - a.rtc <= b.rtc - p.received THEN a.rtc ELSE b.rtc END AS m FROM anchors p
  ASOF LEFT JOIN rows a ON p.user_id = a.user_id AND p.received >= a.rtc ASOF LEFT JOIN rows b ON p.user_id = b.user_id AND p.received < b.rtc))"""


def _nearest(ev, strict):
    rows = rows_of(ev).select("user_id", "rtc", "event_id")
    out = matching.nearest(anchors_of(ev), rows, BY, "received", "rtc", 3600 * SECOND, strict, WIDE)
    return out.select("unix", "user_id", F.col("match.rtc").alias("matched"), "distance")


@query(NEAREST.format(op="<="))
def asof_nearest(ev):
    return _nearest(ev, False)


@query(NEAREST.format(op="<"))
def holdout_nearest(ev):
    return _nearest(ev, True)


@query("SELECT id AS event_id, user_id, matched_unix, match_received, match_delta, match_quality FROM (" + CLOSEST.format(probes="(SELECT event_id AS id, user_id, unix_time AS x FROM rows)") + ")")
def closest_anchor_quality(ev):
    out = matching.closest_anchor(rows_of(ev), anchors_of(ev), BY, "unix_time")
    return out.select("event_id", "user_id", "matched_unix", "match_received", "match_delta", "match_quality")


@query("SELECT r.event_id, count(a.unix) AS n, round(avg(a.received - a.unix * 1000000), 4) AS mean_drift_us FROM rows r LEFT JOIN anchors a ON a.user_id = r.user_id AND a.unix BETWEEN r.unix_time - 604800 AND r.unix_time + 604800 GROUP BY ALL")
def neighbour_avg_drift(ev):
    week = 604_800
    out = matching.range_totals(rows_of(ev), matching.with_sums(anchors_of(ev), BY), BY, F.col("unix_time") - week, F.col("unix_time") + week, "n", "s")
    return out.select("event_id", "n", F.when(F.col("n") > 0, F.col("s") / F.col("n")).alias("mean_drift_us"))


@query("SELECT g.*, (SELECT count(*) FROM anchors a WHERE a.user_id = g.user_id AND a.unix BETWEEN g.lo - 3600 AND g.hi + 3600) AS n FROM (SELECT user_id, segment_id, min(unix_time) AS lo, max(unix_time) AS hi FROM seg GROUP BY ALL) g", SEG)
def anchors_in_range(ev):
    groups = segments_of(ev).groupBy("user_id", "segment_id").agg(F.min("unix_time").alias("lo"), F.max("unix_time").alias("hi"))
    return matching.range_totals(groups, matching.with_sums(anchors_of(ev), BY), BY, F.col("lo") - 3600, F.col("hi") + 3600, "n")


# segments


@query("SELECT event_id, user_id, segment_id FROM seg", SEG)
def segment_gaps(ev):
    return segments_of(ev).select("event_id", "user_id", "segment_id")


@query("SELECT user_id, segment_id, count(*) AS size, min(rtc) AS start_time, max(rtc) AS end_time, round((max(rtc) - min(rtc)) / 60000000.0::DOUBLE, 4) AS duration_minutes, count(DISTINCT rtc // 86400000000) AS num_files FROM seg GROUP BY ALL", SEG)
def segment_summary(ev):
    return segment.segment_summary(segments_of(ev).withColumn("day", F.expr(f"rtc div {DAY_US}")), BY, "rtc", "day")


@query("SELECT user_id, segment_id, n AS rows, round(100.0::DOUBLE * n / sum(n) OVER (PARTITION BY user_id), 4) AS pct FROM (SELECT user_id, segment_id, count(*) AS n FROM seg GROUP BY ALL)", SEG)
def segment_counts(ev):
    return segment.distinct_segments(segments_of(ev), BY)


@query("SELECT user_id, max(g) AS max_gap, count(*) FILTER (WHERE g > 3600) AS large_gaps FROM (SELECT user_id, unix - lag(unix) OVER (PARTITION BY user_id ORDER BY unix) AS g FROM anchors) GROUP BY ALL")
def anchor_gap_report(ev):
    return segment.gap_report(anchors_of(ev), BY, "unix", [], 3600, 7 * 86_400)


# alignment

FACTS = SEG + INTERP.format(rows="seg") + """,
ends AS (SELECT user_id, segment_id, position, min(rtc) AS r0, max(rtc) AS r1, min(rtc) // 1000000 AS u0, max(rtc) // 1000000 AS u1, row_number() OVER () AS id FROM seg GROUP BY user_id, segment_id, position),
m0 AS (""" + CLOSEST.format(probes="(SELECT id, user_id, u0 AS x FROM ends)") + """),
m1 AS (""" + CLOSEST.format(probes="(SELECT id, user_id, u1 AS x FROM ends)") + """),
facts0 AS (SELECT e.*, (SELECT count(*) FROM anchors a WHERE a.user_id = e.user_id AND a.unix BETWEEN e.u0 - 3600 AND e.u1 + 3600) AS k,
  m0.match_quality AS q0, m0.match_delta AS dd0, m1.match_quality AS q1,
  coalesce(m0.match_received + (e.r0 - m0.matched_unix * 1000000), m0.match_received) AS t0, coalesce(m1.match_received + (e.r1 - m1.matched_unix * 1000000), m1.match_received) AS t1
  FROM ends e JOIN m0 USING (id) JOIN m1 USING (id)),
facts AS (SELECT *, CASE WHEN r1 <> r0 THEN (t1 - t0 - (r1 - r0)) / (r1 - r0) END AS rate,
  CASE WHEN k >= 3 THEN 'interpolate' WHEN q0 IN ('excellent', 'good', 'acceptable') AND q1 IN ('excellent', 'good', 'acceptable') THEN 'linear_drift'
    WHEN q0 IN ('excellent', 'good', 'acceptable') OR q1 IN ('excellent', 'good', 'acceptable') THEN 'anchor' ELSE 'interpolate' END AS choice FROM facts0),
used AS (SELECT i.*, f.r0, f.t0, f.rate, f.q0, f.dd0, CASE WHEN {want} = 'linear_drift' AND rate IS NOT NULL THEN 'linear_drift' WHEN {want} IN ('linear_drift', 'anchor') AND t0 IS NOT NULL THEN 'anchor' ELSE 'interpolate' END AS how
  FROM interp i JOIN facts f USING (user_id, segment_id, position)),
aligned AS (SELECT event_id, user_id, segment_id, position, rtc,
  CASE how WHEN 'linear_drift' THEN rtc + CAST(round((rtc - r0) * rate) AS BIGINT) + (t0 - r0) WHEN 'anchor' THEN t0 + (rtc - r0) ELSE CAST(round((unix_time + interp_drift) * 1e6) AS BIGINT) END AS aligned,
  CASE how WHEN 'linear_drift' THEN 0.85 WHEN 'anchor' THEN CASE q0 WHEN 'excellent' THEN 1.0 WHEN 'good' THEN 0.9 WHEN 'acceptable' THEN 0.7 WHEN 'poor' THEN 0.5 WHEN 'interpolated' THEN 0.7 WHEN 'no_nearby_reference' THEN 0.3 ELSE 0.1 END
    ELSE interp_confidence END::DOUBLE AS confidence,
  CASE how WHEN 'interpolate' THEN 'interpolated_drift' ELSE how END AS method, CASE WHEN how = 'anchor' THEN dd0 END AS reference_delta_seconds, CASE WHEN how = 'linear_drift' THEN rate END AS drift_rate FROM used)
"""
SHOWN = "SELECT event_id, user_id, segment_id, position, aligned, confidence, method, reference_delta_seconds, round(drift_rate, 4) AS drift_rate, round((aligned - rtc) / 1e6, 4) AS drift_seconds FROM {t}"
ADAPTIVE = FACTS.format(want="choice")
BORROWED = ADAPTIVE + """,
pf AS (SELECT user_id, segment_id, position, max(confidence) AS best, median(aligned - rtc) AS drift FROM aligned GROUP BY ALL),
lead AS (SELECT user_id, segment_id, arg_min(position, (position <> 0, position)) AS lp, arg_min(drift, (position <> 0, position)) AS ld FROM pf GROUP BY ALL),
borrowed AS (SELECT a.* REPLACE (CASE WHEN hit THEN rtc + CAST(round(ld) AS BIGINT) ELSE aligned END AS aligned, CASE WHEN hit THEN 0.65 ELSE confidence END AS confidence, CASE WHEN hit THEN 'fallback_anchor_drift' ELSE method END AS method) FROM (
  SELECT a.*, ld, (position <> lp AND coalesce(best, 0) < 0.7 AND ld IS NOT NULL) AS hit FROM aligned a JOIN pf USING (user_id, segment_id, position) JOIN lead USING (user_id, segment_id)) a)
"""
BACK = BORROWED + """,
ref AS (SELECT user_id, position, min((rtc, aligned)) AS r FROM borrowed WHERE confidence >= 0.7 GROUP BY ALL),
back AS (SELECT b.* REPLACE (CASE WHEN rtc < r[1] AND confidence < 0.6 THEN rtc + (r[2] - r[1]) ELSE aligned END AS aligned) FROM borrowed b LEFT JOIN ref USING (user_id, position))
"""


def aligned_of(ev, strategy="adaptive", settings=Settings()):
    return settled(align.align(segments_of(ev).drop("unix_time"), anchors_of(ev), BY, strategy, settings))


def borrowed_of(ev):
    return settled(align.borrow_positions(aligned_of(ev), BY))


def shown(df):
    return df.select("event_id", "user_id", "segment_id", "position", "aligned", "confidence", "method", "reference_delta_seconds", "drift_rate", "drift_seconds")


@query(SHOWN.format(t="aligned"), ADAPTIVE)
def align_adaptive(ev):
    return shown(aligned_of(ev))


@query(SHOWN.format(t="aligned"), FACTS.format(want="'anchor'"))
def align_anchor(ev):
    return shown(aligned_of(ev, "anchor"))


@query(SHOWN.format(t="aligned"), FACTS.format(want="'linear_drift'"))
def align_linear(ev):
    return shown(aligned_of(ev, "linear_drift"))


@query("SELECT user_id, segment_id, position, k AS anchors_in_range, q0 AS first_match_quality, q1 AS last_match_quality, choice FROM facts", ADAPTIVE)
def alignment_choice(ev):
    out = align.decide(segments_of(ev), anchors_of(ev), BY)
    return out.select("user_id", "segment_id", "position", "anchors_in_range", "first_match_quality", "last_match_quality", "choice")


@query(SHOWN.format(t="borrowed"), BORROWED)
def position_fallback(ev):
    return shown(borrowed_of(ev))


@query(SHOWN.format(t="back"), BACK)
def backward_propagation(ev):
    return shown(align.propagate_back(borrowed_of(ev), BY))


@query("SELECT event_id, CASE WHEN n > 1 THEN rtc + d ELSE aligned END AS aligned FROM (SELECT *, count(*) OVER g AS n, first_value(aligned - rtc) OVER (PARTITION BY event_id // 4 ORDER BY confidence DESC, rtc, event_id) AS d FROM borrowed WINDOW g AS (PARTITION BY event_id // 4))", BORROWED)
def group_correction(ev):
    grouped = borrowed_of(ev).withColumn("line", F.expr("event_id div 4"))
    return align.correct_groups(grouped, ["line"], ["event_id"]).select("event_id", "aligned")


@query("SELECT sg.user_id, segment_id, lo AS start, hi AS \"end\", round(CASE WHEN hi <> lo THEN (b.match_received - a.match_received - (hi - lo) * 1000000) / ((hi - lo) * 1e6) END, 4) AS drift_rate FROM sg JOIN da a USING (id) JOIN db b USING (id)",
       SEG + ", sg AS (SELECT user_id, segment_id, min(unix_time) AS lo, max(unix_time) AS hi, row_number() OVER () AS id FROM seg GROUP BY user_id, segment_id), da AS (" + CLOSEST.format(probes="(SELECT id, user_id, lo AS x FROM sg)") + "), db AS (" + CLOSEST.format(probes="(SELECT id, user_id, hi AS x FROM sg)") + ")")
def segment_drift_rate(ev):
    spans = segments_of(ev).groupBy("user_id", "segment_id").agg(F.min("unix_time").alias("start"), F.max("unix_time").alias("end"))
    return align.drift_rate(spans, anchors_of(ev), BY)


# statistics of the alignment

METHODS = "string_agg(method || ':' || n, ',' ORDER BY method)"


def method_text(column: str):
    """A map of method counts as one text, which both engines can compare."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(column)), lambda x: F.concat(x["key"], F.lit(":"), x["value"].cast("string"))), ",")


@query(f"SELECT * FROM (SELECT user_id, segment_id, count(*) AS num_samples, round(avg(d), 4) AS mean_drift_seconds, round(median(d), 4) AS median_drift_seconds, round(stddev_samp(d), 4) AS std_drift_seconds, round(min(d), 4) AS min_drift_seconds, round(max(d), 4) AS max_drift_seconds, round(avg(confidence), 4) AS mean_confidence, round(100.0::DOUBLE * count(*) FILTER (WHERE confidence >= 0.9) / count(*), 4) AS pct_high_confidence, round(100.0::DOUBLE * count(*) FILTER (WHERE confidence < 0.6) / count(*), 4) AS pct_low_confidence FROM (SELECT *, (aligned - rtc) / 1e6 AS d FROM borrowed) GROUP BY ALL) JOIN (SELECT user_id, segment_id, {METHODS} AS methods FROM (SELECT user_id, segment_id, method, count(*) AS n FROM borrowed GROUP BY ALL) GROUP BY ALL) USING (user_id, segment_id)", BORROWED)
def alignment_stats(ev):
    return stats.alignment_stats(borrowed_of(ev), [*BY, "segment_id"]).withColumn("methods", method_text("alignment_methods")).drop("alignment_methods")


@query("SELECT method, round(avg(confidence), 2) AS confidence_mean, round(min(confidence), 2) AS confidence_min, round(max(confidence), 2) AS confidence_max, count(*) AS count, round(avg(d), 2) AS drift_mean, round(stddev_samp(d), 2) AS drift_std, round(min(d), 2) AS drift_min, round(max(d), 2) AS drift_max FROM (SELECT *, (aligned - rtc) / 1e6 AS d FROM borrowed) GROUP BY ALL", BORROWED)
def method_comparison(ev):
    return stats.method_comparison(borrowed_of(ev))


PCT = "round(100.0::DOUBLE * count(*) FILTER (WHERE confidence >= 0.9) / count(*), 4) AS pct_high, round(100.0::DOUBLE * count(*) FILTER (WHERE confidence >= 0.6 AND confidence < 0.9) / count(*), 4) AS pct_medium, round(100.0::DOUBLE * count(*) FILTER (WHERE confidence < 0.6) / count(*), 4) AS pct_low"


@query(f"SELECT user_id, round(avg(confidence), 4) AS mean_confidence, round(median(confidence), 4) AS median_confidence, {PCT} FROM borrowed GROUP BY ALL", BORROWED)
def confidence_bands(ev):
    return stats.confidence_distribution(borrowed_of(ev), BY)


def _five(x, name):
    return f"round(avg({x}), 4) AS mean_{name}, round(median({x}), 4) AS median_{name}, round(stddev_samp({x}), 4) AS std_{name}, round(min({x}), 4) AS min_{name}, round(max({x}), 4) AS max_{name}"


@query(f"SELECT {_five('d', 'drift')}, round(max(d) - min(d), 4) AS range_drift FROM (SELECT (aligned - rtc) / 1e6 AS d FROM borrowed)", BORROWED)
def drift_pattern(ev):
    return stats.drift_pattern(borrowed_of(ev))


@query(f"SELECT * FROM (SELECT count(*) AS total, min(rtc) AS first_rtc, max(rtc) AS last_rtc, min(aligned) AS first_time, max(aligned) AS last_time, {_five('confidence', 'confidence')}, {PCT}, {_five('d', 'drift')}, round((max(d) - min(d)) / 3600, 4) AS drift_range_hours FROM (SELECT *, (aligned - rtc) / 1e6 AS d FROM borrowed)), (SELECT count(*) AS num_segments, round(avg(size), 4) AS mean_segment, round(median(size), 4) AS median_segment FROM (SELECT count(*) AS size FROM borrowed GROUP BY user_id, segment_id)), (SELECT {METHODS} AS methods FROM (SELECT method, count(*) AS n FROM borrowed GROUP BY ALL))", BORROWED)
def quality_report(ev):
    return stats.quality_report(borrowed_of(ev), BY).withColumn("methods", method_text("methods"))


@query("SELECT event_id, c AS confidence FROM (SELECT event_id, confidence + CASE event_id % 5 WHEN 0 THEN 0.5 WHEN 1 THEN -0.5 ELSE 0 END AS c FROM borrowed) WHERE c < 0 OR c > 1", BORROWED)
def confidence_out_of_range(ev):
    shifted = F.when(F.expr("event_id % 5 = 0"), 0.5).when(F.expr("event_id % 5 = 1"), -0.5).otherwise(0.0)
    return stats.invalid_confidence(borrowed_of(ev).withColumn("confidence", F.col("confidence") + shifted)).select("event_id", "confidence")


ERR = BORROWED + """,
near AS (SELECT p.*, CASE WHEN b.aligned IS NULL OR p.received - a.aligned <= b.aligned - p.received THEN a ELSE b END AS m FROM anchors p
  ASOF LEFT JOIN (SELECT user_id, aligned, max(struct_pack(aligned := aligned, rtc := rtc, confidence := confidence, position := position, event_id := event_id)) AS s FROM borrowed GROUP BY ALL) a ON p.user_id = a.user_id AND p.received >= a.aligned
  ASOF LEFT JOIN (SELECT user_id, aligned, min(struct_pack(aligned := aligned, rtc := rtc, confidence := confidence, position := position, event_id := event_id)) AS s FROM borrowed GROUP BY ALL) b ON p.user_id = b.user_id AND p.received < b.aligned),
err AS (SELECT user_id, unix, received, m.s.aligned AS aligned, m.s.rtc AS rtc, m.s.confidence AS confidence, m.s.position AS position, (m.s.aligned - received) / 1e6 AS e, (m.s.rtc - received) / 1e6 AS r FROM near WHERE abs(received - m.s.aligned) <= 3600000000)
"""
ERRORS = "count(*) AS n, round(avg(abs(e)), 4) AS mae, round(median(abs(e)), 4) AS median_abs, round(sqrt(avg(e * e)), 4) AS rmse, round(quantile_cont(abs(e), 0.95), 4) AS p95, round(max(abs(e)), 4) AS max_abs, round(avg(abs(r) - abs(e)), 4) AS mean_improvement"


def errors_of(ev, probes=None, strict=False, borrowed=None):
    rows = (borrowed_of(ev) if borrowed is None else borrowed).select("user_id", "aligned", "rtc", "confidence", "position", "event_id")
    probes = anchors_of(ev) if probes is None else probes.select("user_id", "unix", "received")
    found = matching.nearest(probes, rows, BY, "received", "aligned", 3600 * SECOND, strict, WIDE).where("match IS NOT NULL")
    return stats.errors(found.select("user_id", "unix", "received", "match.*"))


@query("SELECT user_id, unix, aligned, confidence, round(e, 4) AS error_seconds, round(abs(e), 4) AS abs_error_seconds, round(r, 4) AS rtc_error_seconds, round(abs(r) - abs(e), 4) AS correction_improvement FROM err", ERR)
def direct_validation(ev):
    return errors_of(ev).select("user_id", "unix", "aligned", "confidence", "error_seconds", "abs_error_seconds", "rtc_error_seconds", "correction_improvement")


@query(f"SELECT CASE WHEN confidence >= 0.7 AND confidence < 1.0 THEN 'high' WHEN confidence >= 0.5 AND confidence < 0.7 THEN 'medium' WHEN confidence >= 0 AND confidence < 0.5 THEN 'low' END AS band, {ERRORS} FROM err GROUP BY ALL", ERR)
def error_stats_by_band(ev):
    return stats.error_stats(errors_of(ev).withColumn("band", stats.band_b()), ["band"])


@query(f"SELECT position, {ERRORS} FROM err GROUP BY ALL", ERR)
def error_stats_by_position(ev):
    return stats.error_stats(errors_of(ev), ["position"])


#: The split's hash: the last seven of a digest's digits, as a number in DuckDB and in Spark.
TESTED = "CAST('0x' || right(md5('42:' || unix), 7) AS BIGINT) % 10000 < 2000"


@query(f"SELECT user_id, unix, k >= 5 AND {TESTED} AS is_test FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS k FROM anchors)")
def holdout_split(ev):
    return stats.holdout(anchors_of(ev), BY, least=5).select("user_id", "unix", "is_test")


@query(f"SELECT {ERRORS} FROM err JOIN (SELECT user_id, count(*) AS k FROM anchors GROUP BY ALL) USING (user_id) WHERE k >= 5 AND {TESTED} AND abs(received - aligned) < 3600000000", ERR)
def holdout_stats(ev):
    tests = stats.holdout(anchors_of(ev), BY, least=5).where("is_test")
    return stats.error_stats(errors_of(ev, tests, strict=True), [])


@query("SELECT position, count(*) AS n FROM borrowed WHERE confidence >= 0.7 GROUP BY ALL", BORROWED)
def anchor_counts(ev):
    return matching.usable_counts(borrowed_of(ev), ["position"], Settings().usable_confidence)


@query("SELECT user_id, segment_id, count(*) AS rows, round(avg(confidence), 4) AS mean_confidence, min(confidence) AS min_confidence FROM borrowed GROUP BY ALL HAVING avg(confidence) < 0.6", BORROWED)
def problem_segments(ev):
    return segment.problem_segments(borrowed_of(ev), BY)


@query("SELECT event_id, confidence FROM borrowed WHERE confidence >= 0.9", BORROWED)
def high_confidence(ev):
    return writers.high_confidence(borrowed_of(ev)).select("event_id", "confidence")


@query("SELECT count(*) AS rows, count(*) FILTER (WHERE confidence >= 0.9) AS kept, round(100.0::DOUBLE * count(*) FILTER (WHERE confidence >= 0.9) / count(*), 4) AS kept_pct FROM borrowed", BORROWED)
def high_confidence_share(ev):
    return writers.kept_share(borrowed_of(ev))


@query("SELECT least(floor(confidence / 0.02::DOUBLE), 49)::INTEGER AS bin, count(*) AS n FROM borrowed WHERE confidence BETWEEN 0 AND 1 GROUP BY ALL", BORROWED)
def hist_confidence(ev):
    return stats.histogram(borrowed_of(ev), "confidence", 0.0, 1.0)


@query("SELECT event_id, rtc, aligned FROM borrowed ORDER BY md5('42:' || event_id), event_id LIMIT 1000", BORROWED)
def plot_sample(ev):
    return stats.plot_sample(borrowed_of(ev).select("event_id", "rtc", "aligned"), ["event_id"], 1000)


@query("SELECT user_id, least(floor((aligned - lo) * 100.0::DOUBLE / (hi - lo + 1)), 99)::INTEGER AS bin, count(*) AS n, round(avg(d), 4) AS mean_drift, round(min(d), 4) AS min_drift, round(max(d), 4) AS max_drift FROM (SELECT *, (aligned - rtc) / 1e6 AS d FROM borrowed) JOIN (SELECT user_id, min(aligned) AS lo, max(aligned) AS hi FROM borrowed GROUP BY ALL) USING (user_id) GROUP BY ALL", BORROWED)
def plot_drift_line(ev):
    return stats.drift_line(borrowed_of(ev), BY, 100)


@query("SELECT user_id, segment_id, count(*) AS n, round(avg(confidence), 4) AS mean_confidence FROM borrowed GROUP BY ALL", BORROWED)
def plot_segment_bars(ev):
    return stats.segment_bars(borrowed_of(ev), BY)


@query("SELECT user_id, count(*) AS total_points, min(unix) AS first_unix, max(unix) AS last_unix, min(us) AS first_received, max(us) AS last_received, count(*) - count(DISTINCT unix) AS duplicates, count(*) FILTER (WHERE f = 'NEW') AS new_points, count(*) FILTER (WHERE f = 'OLD') AS old_points FROM (SELECT *, us // 86400000000 AS unix, CASE WHEN event_id % 3 = 0 THEN 'OLD' ELSE 'NEW' END AS f FROM ev) GROUP BY ALL")
def anchor_load_check(ev):
    kind = F.when(F.expr("event_id % 3 = 0"), "OLD").otherwise("NEW")
    out = stats.anchor_check(ev.withColumn("unix", F.expr(f"us div {DAY_US}")).withColumn("format", kind), BY, "us")
    n = {k: F.coalesce(F.try_element_at("formats", F.lit(k)), F.lit(0)) for k in ("NEW", "OLD")}
    return out.withColumns({"new_points": n["NEW"], "old_points": n["OLD"]}).drop("formats")


# rebuilding

STEP = "(SELECT event_id, user_id, us - us % 600000000 AS slot, us AS rtc FROM ev)"


@query(f"SELECT event_id, slot + sum(step) OVER (PARTITION BY user_id, slot ORDER BY rtc, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS spread FROM (SELECT *, CASE WHEN lag(rtc) OVER w IS NULL THEN 0 WHEN rtc - lag(rtc) OVER w BETWEEN 2000000 AND 20000000 THEN rtc - lag(rtc) OVER w ELSE 5000000 END AS step FROM {STEP} WINDOW w AS (PARTITION BY user_id, slot ORDER BY rtc, event_id))")
def spread_duplicates(ev):
    rows = ev.select("event_id", "user_id", F.expr("us - us % 600000000").alias("slot"), F.col("us").alias("rtc"))
    return rebuild.spread(rows, BY, "slot", "rtc", ["event_id"], 5).select("event_id", "spread")


@query("SELECT event_id, count(*) OVER (PARTITION BY us // 600000000) > 1 AS is_duplicate FROM ev")
def duplicate_counts(ev):
    return rebuild.mark_duplicates(ev.withColumn("slot", F.expr("us div 600000000")), ["slot"]).select("event_id", "is_duplicate")


@query("SELECT event_id, strftime(l, '%y%m%d%H') AS hour_key, strftime(l, '%m') AS month_folder FROM (SELECT event_id, to_timestamp(us / 1000000) AT TIME ZONE 'Europe/Copenhagen' AS l FROM ev)")
def hour_local(ev):
    return rebuild.local_hours(ev, "us", "Europe/Copenhagen").select("event_id", "hour_key", "month_folder")


@query("SELECT strftime(l, '%m') AS month_folder, strftime(l, '%y%m%d%H') AS hour_key, count(*) AS lines, min(us) AS start_time, max(us) AS end_time, round(avg(value), 4) AS mean_confidence, max(event_id % 12 + 1)::INTEGER AS width FROM (SELECT *, to_timestamp(us / 1000000) AT TIME ZONE 'Europe/Copenhagen' AS l FROM ev) GROUP BY ALL")
def hour_manifest(ev):
    rows = ev.withColumn("confidence", F.col("value")).withColumn("data_values", F.array_repeat(F.lit("x"), F.expr("cast(event_id % 12 + 1 as int)")))
    return rebuild.manifest(rebuild.local_hours(rows, "us", "Europe/Copenhagen"), [], "us")


NAMES = "['Sensor_Volt', 'CH4_Raw', 'CO2_ppm', 'Temp_C', 'RH_pct', 'DO_mgL', 'DO_sat_pct', 'Topt_C', 'Extra4', 'Sal']"


@query(f"SELECT event_id, array_to_string(list_concat(list_transform(range(0, w), lambda i: i::VARCHAR), list_transform(range(0, 14 - w), lambda i: '')), ',') AS padded, array_to_string(CASE WHEN w = 6 THEN list_concat({NAMES}[1:5], ['Extra1']) WHEN w <= 10 THEN {NAMES}[1:w] ELSE list_concat({NAMES}, list_transform(range(11, w + 1), lambda i: 'Extra' || (i - 6)::VARCHAR)) END, ',') AS header FROM (SELECT event_id, event_id % 13 + 1 AS w FROM ev)")
def pad_and_header(ev):
    rows = ev.select("event_id", F.expr("cast(event_id % 13 + 1 as int)").alias("w"), F.lit(14).alias("full"))
    rows = rows.withColumn("v", F.transform(F.sequence(F.lit(0), F.col("w") - 1), lambda i: i.cast("string")))
    return rows.select("event_id", F.array_join(rebuild.pad("v", "full"), ",").alias("padded"), F.array_join(rebuild.header("w"), ",").alias("header"))


@query("SELECT user_id, to_timestamp(p + 3600) AT TIME ZONE 'UTC' AS gap_start, to_timestamp(h - 3600) AT TIME ZONE 'UTC' AS gap_end, ((h - p) // 3600 - 1)::BIGINT AS duration_hours, 'missing' AS status FROM (SELECT user_id, h, lag(h) OVER (PARTITION BY user_id ORDER BY h) AS p FROM (SELECT DISTINCT user_id, us // 3600000000 * 3600 AS h FROM ev)) WHERE h - p > 3600")
def coverage_gaps(ev):
    hours = ev.withColumn("hour", F.timestamp_micros("us"))
    out = rebuild.coverage_gaps(hours, BY, "hour")
    return out.select("user_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("gap_start", "gap_end")], "duration_hours", "status")


@query("SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, us // 86400000000, event_type ORDER BY us, event_id) AS n FROM ev) WHERE n = 1")
def dedup_keep_first(ev):
    return rebuild.keep_first(ev.withColumn("day", F.expr(f"us div {DAY_US}")), ["user_id", "day", "event_type"], ["us", "event_id"]).select("event_id", "user_id")


@query("SELECT user_id, unix, received FROM anchors")
def distinct_anchors(ev):
    return anchors_of(ev)


@query("SELECT event_id, ts - INTERVAL 60 MINUTE AS utc, epoch_us(ts) // 1000000 AS unix_time FROM events")
def fixed_offset_to_utc(ev):
    utc = sd_text.to_utc(F.timestamp_micros("us"), 60)
    return ev.select("event_id", utc.cast("timestamp_ntz").alias("utc"), F.expr("us div 1000000").alias("unix_time"))


FROM, TO = 1704844800000000, 1705708800000000


@query(f"SELECT count(*) AS n, count(*) FILTER (WHERE us BETWEEN {FROM} AND {TO}) AS valid FROM ev")
def range_validity(ev):
    return segment.in_range(ev, "us", FROM, TO).agg(F.count("*").alias("n"), F.count_if("is_valid").alias("valid"))


@query(f"SELECT event_id FROM ev WHERE us >= {FROM}")
def cutoff(ev):
    return segment.cutoff(ev, "us", FROM).select("event_id")


@query("SELECT user_id, coalesce(greatest(a0, b0) <= least(a1, b1), false) AS overlaps, round(CASE WHEN greatest(a0, b0) <= least(a1, b1) AND b0 IS NOT NULL THEN (least(a1, b1) - greatest(a0, b0)) / 86400000000.0::DOUBLE ELSE 0 END, 4) AS overlap_days FROM (SELECT user_id, min(rtc) AS a0, max(rtc) AS a1 FROM rows GROUP BY ALL) LEFT JOIN (SELECT user_id, min(received) AS b0, max(received) AS b1 FROM anchors GROUP BY ALL) USING (user_id)")
def overlap(ev):
    return stats.overlap(rows_of(ev), anchors_of(ev), BY, "rtc", "received")


@query(f"SELECT * FROM (SELECT user_id, count(*) AS total_rows, count(DISTINCT us // {DAY_US}) AS files, min(us) AS first_time, max(us) AS last_time, count(*) FILTER (WHERE us BETWEEN {FROM} AND {TO}) AS valid_rows, count(*) FILTER (WHERE NOT us BETWEEN {FROM} AND {TO}) AS invalid_rows, round(100.0::DOUBLE * count(*) FILTER (WHERE us BETWEEN {FROM} AND {TO}) / count(*), 4) AS valid_pct, count(*) FILTER (WHERE event_type = 'error') AS recovered_rows, round(100.0::DOUBLE * count(*) FILTER (WHERE event_type = 'error') / count(*), 4) AS recovered_pct, count(DISTINCT us // {DAY_US}) FILTER (WHERE event_type = 'error') AS files_recovered, count(*) FILTER (WHERE event_type = 'error' AND us BETWEEN {FROM} AND {TO}) AS recovered_valid_rows FROM ev GROUP BY ALL) JOIN (SELECT user_id, sum(n - 1)::BIGINT AS duplicates FROM (SELECT user_id, count(*) AS n FROM ev GROUP BY user_id, us, us // {DAY_US}) GROUP BY ALL) USING (user_id)")
def load_check(ev):
    rows = ev.withColumn("file", F.expr(f"us div {DAY_US}")).withColumn("recovered", F.col("event_type") == "error")
    return stats.load_check(rows, BY, "us", "file", "recovered", FROM, TO)


# file quality: a user's day is a file, its lines stand in the order of their ids

FILES = CTE + f""",
lines AS (SELECT user_id, us // {DAY_US} AS day, us, event_id, event_id % 4 + 3 AS f FROM ev),
st AS (SELECT *, (us - lag(us) OVER w) / 1000000 AS s, row_number() OVER w - 1 AS i FROM lines WINDOW w AS (PARTITION BY user_id, day ORDER BY event_id)),
qa AS (SELECT user_id, day, count(*) AS num_lines, count(*) AS num_valid_timestamps, count(*) FILTER (WHERE s < 0) = 0 AS is_chronological, count(*) FILTER (WHERE s < 0) AS num_reversals, (min(i) FILTER (WHERE s < 0))::INTEGER AS first_reversal, abs(min(s) FILTER (WHERE s < 0)) AS max_reversal_seconds, max(s) AS max_gap_seconds, avg(s) AS mean_gap_seconds, median(s) AS median_gap_seconds, count(*) FILTER (WHERE s > 300) AS num_large_gaps, (user_id % 24)::INTEGER AS expected_hour, 100.0::DOUBLE * count(*) FILTER (WHERE us // 3600000000 % 24 = user_id % 24) / count(*) AS correct_hour_pct, min(us) AS start_time, max(us) AS end_time, (max(us) - min(us)) / 60000000.0::DOUBLE AS duration_minutes, min(f) AS min_fields, max(f) AS max_fields, count(DISTINCT f) > 1 AS inconsistent_fields, 3 AS expected_samples, count(*) - 3 AS sample_count_deviation FROM st GROUP BY user_id, day)
"""
STATUS = FILES + """,
flags AS (SELECT *, list_filter([CASE WHEN NOT is_chronological THEN 'NOT_CHRONOLOGICAL' END, CASE WHEN num_reversals > 0 THEN num_reversals || '_REVERSALS' END, CASE WHEN num_large_gaps > 0 THEN num_large_gaps || '_LARGE_GAPS' END, CASE WHEN correct_hour_pct < 80 THEN 'WRONG_HOUR' END, CASE WHEN abs(sample_count_deviation) > 0.2 * expected_samples THEN 'UNEXPECTED_COUNT' END], lambda x: x IS NOT NULL) AS issues FROM qa),
status AS (SELECT *, CASE WHEN len(issues) = 0 THEN 'OK' ELSE array_to_string(issues, '; ') END AS status, len(issues)::INTEGER AS num_issues FROM flags)
"""


def qa_of(ev, least=2):
    lines = ev.select("user_id", F.expr(f"us div {DAY_US}").alias("day"), "us", "event_id", F.expr("event_id % 4 + 3").alias("n_fields"))
    return stats.file_qa(lines, ["user_id", "day"], "us", "event_id", F.expr("cast(user_id % 24 as int)"), samples=3, least=least)


def status_of(ev):
    return stats.file_status(qa_of(ev, 0))


QA = "user_id, day, num_lines, num_valid_timestamps, is_chronological, num_reversals, first_reversal, round(max_reversal_seconds, 4) AS max_reversal_seconds, round(max_gap_seconds, 4) AS max_gap_seconds, round(mean_gap_seconds, 4) AS mean_gap_seconds, round(median_gap_seconds, 4) AS median_gap_seconds, num_large_gaps, expected_hour, round(correct_hour_pct, 4) AS correct_hour_pct, start_time, end_time, round(duration_minutes, 4) AS duration_minutes, min_fields, max_fields, inconsistent_fields, sample_count_deviation"


@query(f"SELECT {QA} FROM qa WHERE num_valid_timestamps >= 2", FILES)
def file_qa(ev):
    return qa_of(ev).drop("mean_drift_seconds", "expected_samples")


@query("SELECT user_id, day, status, num_issues FROM status", STATUS)
def file_qa_status(ev):
    return status_of(ev).select("user_id", "day", "status", "num_issues")


@query("SELECT user_id, day FROM qa WHERE num_valid_timestamps >= 2 AND (NOT is_chronological OR num_reversals > 0 OR correct_hour_pct < 80)", FILES)
def problem_files(ev):
    return stats.problem_files(qa_of(ev)).select("user_id", "day")


@query("SELECT count(*) AS files, count(*) FILTER (WHERE status = 'OK') AS ok_files, sum(num_lines)::BIGINT AS lines, round(avg(num_lines), 4) AS mean_lines, count(*) FILTER (WHERE is_chronological) AS chronological_files, sum(num_reversals)::BIGINT AS reversals, sum(num_large_gaps)::BIGINT AS large_gaps, round(avg(correct_hour_pct), 4) AS mean_hour_pct, count(*) FILTER (WHERE correct_hour_pct >= 80) AS files_in_hour FROM status", STATUS)
def qa_report(ev):
    return stats.qa_report(status_of(ev))


@query("SELECT user_id, day, num_issues FROM status ORDER BY num_issues DESC, user_id, day LIMIT 10", STATUS)
def top_issue_files(ev):
    return stats.top_issues(status_of(ev), ["user_id", "day"]).select("user_id", "day", "num_issues")


STEPS = "(SELECT user_id, (us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id)) / 1000000 AS s FROM ev)"


@query(f"SELECT user_id, count(*) AS intervals, round(avg(s), 4) AS mean_s, round(median(s), 4) AS median_s, round(stddev_pop(s), 4) AS std_s, round(100.0::DOUBLE * count(*) FILTER (WHERE abs(s - 3600) < 0.1) / count(*), 4) AS pct_exact, round(100.0::DOUBLE * count(*) FILTER (WHERE s BETWEEN 2880 AND 4320) / count(*), 4) AS pct_near, count(*) FILTER (WHERE s > 60) AS over_minute FROM {STEPS} WHERE s IS NOT NULL GROUP BY ALL")
def interval_stats(ev):
    return stats.interval_stats(ev, BY, "us", ["event_id"], 3600, (2880, 4320))


@query(f"SELECT user_id, count(*) AS gaps, round(avg(s), 4) AS mean_s, round(median(s), 4) AS median_s, round(max(s), 4) AS max_s, round(sum(s), 4) AS total_s FROM {STEPS} WHERE s > 600 GROUP BY ALL")
def gap_stats(ev):
    return stats.gap_stats(ev, BY, "us", ["event_id"])


SPANS = f"(SELECT user_id, us // {DAY_US} AS day, (max(us) - min(us)) / 60000000.0::DOUBLE AS minutes, min(us) // 60000000 % 60 + (min(us) // 1000000 % 60) / 60.0::DOUBLE AS start_minute FROM ev GROUP BY ALL)"


@query(f"SELECT user_id, day, round(minutes, 4) AS minutes, round(start_minute, 4) AS start_minute FROM {SPANS}")
def file_span(ev):
    return stats.file_spans(ev.withColumn("day", F.expr(f"us div {DAY_US}")), ["user_id", "day"], "us")


@query(f"SELECT count(*) AS files, round(avg(minutes), 4) AS mean_minutes, round(median(minutes), 4) AS median_minutes, count(*) FILTER (WHERE minutes < 45) AS under_45, count(*) FILTER (WHERE minutes < 30) AS under_30, round(avg(start_minute), 4) AS mean_start_minute FROM {SPANS}")
def span_summary(ev):
    return stats.span_summary(stats.file_spans(ev.withColumn("day", F.expr(f"us div {DAY_US}")), ["user_id", "day"], "us"))


@query(f"SELECT user_id, day, round(minutes, 4) AS minutes FROM {SPANS} ORDER BY minutes, user_id, day LIMIT 10")
def shortest_files(ev):
    spans = stats.file_spans(ev.withColumn("day", F.expr(f"us div {DAY_US}")), ["user_id", "day"], "us")
    return stats.shortest(spans, ["user_id", "day"]).select("user_id", "day", "minutes")


@query(f"SELECT count(*) AS files, round(avg(n), 4) AS mean_lines, round(median(n), 4) AS median_lines, min(n) AS min_lines, max(n) AS max_lines, round(stddev_pop(n), 4) AS std_lines, round(100.0::DOUBLE * sum(n) / (count(*) * 3), 4) AS coverage_pct FROM (SELECT count(*) AS n FROM ev GROUP BY user_id, us // {DAY_US})")
def lines_per_file(ev):
    return stats.lines_per_file(ev.withColumn("day", F.expr(f"us div {DAY_US}")), ["user_id", "day"], 3)


@query("SELECT a.n AS rows, b.n AS lines, round(100.0::DOUBLE * abs(a.n - b.n) / a.n, 4) AS difference_pct, 100.0::DOUBLE * abs(a.n - b.n) / a.n > 1 AS is_critical FROM (SELECT count(*) AS n FROM ev) a, (SELECT count(*) AS n FROM rows) b")
def row_reconciliation(ev):
    return stats.reconcile(ev, rows_of(ev))


LABEL = "CASE WHEN {x} >= {a} THEN 'excellent' WHEN {x} >= {b} THEN 'good' WHEN {x} >= {c} THEN '{third}' ELSE 'poor' END"
TOTALS = """(SELECT user_id, 100.0::DOUBLE * count(*) FILTER (WHERE value >= 0) / count(*) AS valid_pct, 100.0::DOUBLE * count(*) FILTER (WHERE event_type <> 'error') / count(*) AS chronological_pct, 100.0::DOUBLE * count(*) FILTER (WHERE event_type <> 'view') / count(*) AS interval_pct, 100.0::DOUBLE * count(*) FILTER (WHERE event_id % 10 > 0) / count(*) AS duplicate_free_pct, count(*) FILTER (WHERE event_id % 97 = 0) AS critical, count(*) FILTER (WHERE event_id % 31 = 0) AS reversals, count(*) FILTER (WHERE event_id % 7 = 0) AS duplicates FROM ev GROUP BY ALL)"""
SCORE = "0.3 * valid_pct + 0.3 * chronological_pct + 0.2 * interval_pct + 0.2 * duplicate_free_pct"


def totals_of(ev):
    value, kind, i = F.col("value"), F.col("event_type"), F.col("event_id")
    return ev.groupBy("user_id").agg(
        stats.share(value >= 0).alias("valid_pct"), stats.share(kind != "error").alias("chronological_pct"), stats.share(kind != "view").alias("interval_pct"), stats.share(i % 10 > 0).alias("duplicate_free_pct"),
        F.count_if(i % 97 == 0).alias("critical"), F.count_if(i % 31 == 0).alias("reversals"), F.count_if(i % 7 == 0).alias("duplicates"),
    )


@query(f"SELECT user_id, round(q, 4) AS quality_score, {LABEL.format(x='q', a=95, b=85, c=70, third='fair')} AS quality_label FROM (SELECT *, {SCORE} AS q FROM {TOTALS})")
def quality_score(ev):
    return stats.quality_score(totals_of(ev)).select("user_id", "quality_score", "quality_label")


@query(f"SELECT user_id, v AS verdict_score, {LABEL.format(x='v', a=90, b=75, c=50, third='acceptable')} AS verdict FROM (SELECT *, CASE WHEN critical = 0 THEN 40 ELSE 0 END + CASE WHEN q >= 90 THEN 30 WHEN q >= 80 THEN 20 WHEN q >= 70 THEN 10 ELSE 0 END + CASE WHEN reversals = 0 THEN 15 ELSE 0 END + CASE WHEN duplicates < 10 THEN 15 ELSE 0 END AS v FROM (SELECT *, {SCORE} AS q FROM {TOTALS}))")
def verdict(ev):
    return stats.verdict(stats.quality_score(totals_of(ev))).select("user_id", "verdict_score", "verdict")


SEVERITY = "CASE event_type WHEN 'error' THEN 'critical' WHEN 'click' THEN 'warning' ELSE 'other' END"


def issues_of(ev):
    kind = F.when(F.col("event_type") == "error", "CRITICAL").when(F.col("event_type") == "click", "warning").otherwise(F.col("event_type"))
    return ev.select(kind.alias("severity"), F.col("event_id").alias("number"), F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"))


@query(f"SELECT {SEVERITY} AS severity, row_number() OVER (PARTITION BY {SEVERITY} ORDER BY event_id) AS place, event_id AS number, 'event ' || event_id AS message FROM ev")
def severity_lists(ev):
    return stats.severity_lists(issues_of(ev))


@query(f"SELECT {SEVERITY} AS severity, count(*) AS n FROM ev GROUP BY ALL")
def severity_counts(ev):
    return stats.severity_counts(issues_of(ev))


@query(f"SELECT user_id, day, count(*) AS num_samples, min(us) AS start_time, max(us) AS end_time, round((max(us) - min(us)) / 60000000.0::DOUBLE, 4) AS duration_minutes, round(avg(s), 4) AS mean_interval, round(max(s), 4) AS max_gap, round(avg(value), 4) AS value_mean, round(stddev_samp(value), 4) AS value_std FROM (SELECT *, us // {DAY_US} AS day, (us - lag(us) OVER (PARTITION BY user_id, us // {DAY_US} ORDER BY us, event_id)) / 1000000 AS s FROM ev) GROUP BY ALL")
def hourly_sensor_summary(ev):
    return stats.sensor_summary(ev.withColumn("day", F.expr(f"us div {DAY_US}")), ["user_id", "day"], "us", ["value"], ["event_id"])


# text: lines made from events and read back

TEXT_ORACLE = "SELECT event_id // 2 AS line_number, CASE WHEN n > 1 THEN (event_id % 2)::INTEGER ELSE 0 END AS concat_position, n > 1 AS is_concatenated, to_timestamp(us // 1000000 - 3600) AT TIME ZONE 'UTC' AS rtc_time, event_id::VARCHAR AS id, user_id::VARCHAR AS user FROM (SELECT *, count(*) OVER (PARTITION BY event_id // 2) AS n FROM ev)"


def lines_of(ev):
    piece = F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.date_format(F.timestamp_micros("us"), "dd.MM.yyyy HH:mm:ss"))
    pairs = ev.groupBy(F.expr("cast(event_id div 2 as int)").alias("line_number")).agg(F.array_sort(F.collect_list(F.struct("event_id", piece.alias("p")))).alias("x"))
    return pairs.select(F.lit("F1.TXT").alias("file_name"), "line_number", F.array_join(F.transform("x", lambda x: x["p"]), " ").alias("line"))


@query(TEXT_ORACLE)
def concat_recovery(ev):
    rows = sd_text.parse(lines_of(ev)).where("reject_reason IS NULL")
    return rows.select(F.col("line_number").cast("long"), "concat_position", "is_concatenated", F.col("rtc_time").cast("timestamp_ntz").alias("rtc_time"), F.col("data_values")[0].alias("id"), F.col("data_values")[1].alias("user"))


@query("SELECT j AS join_type, (2 * count(*))::BIGINT AS rows FROM (SELECT CASE WHEN min(us // 1000000) <> max(us // 1000000) THEN 1 ELSE 2 END AS j FROM ev GROUP BY event_id // 2 HAVING count(*) > 1) GROUP BY ALL")
def concat_types(ev):
    return sd_text.join_types(sd_text.parse(lines_of(ev)))


@query("SELECT 1::BIGINT AS files, count(*) AS lines, 0::BIGINT AS skipped_lines, count(*) FILTER (WHERE n > 1) AS joined_lines, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::BIGINT AS recovered_rows, round(avg(CASE WHEN n > 1 THEN n END), 4) AS rows_per_joined_line, round(100.0::DOUBLE * count(*) FILTER (WHERE n > 1) / count(*), 4) AS pct_joined FROM (SELECT count(*) AS n FROM ev GROUP BY event_id // 2)")
def recovery_counters(ev):
    return sd_text.counters(sd_text.parse(lines_of(ev)))


@query("SELECT DISTINCT event_id // 2 AS line_number, event_id % 2 AS p FROM ev")
def in_file_dedup(ev):
    rows = sd_text.parse(lines_of(ev)).where("reject_reason IS NULL")
    rows = sd_text.drop_repeats(rows.unionByName(rows))
    return rows.select(F.col("line_number").cast("long"), F.expr("cast(data_values[0] as bigint) % 2").alias("p"))


PARSED = "SELECT us // 1000000 AS unix, to_timestamp(us // 1000000 + event_id % 9) AT TIME ZONE 'UTC' AS received_at, '{kind}' AS format, user_id::VARCHAR AS source_file FROM ev WHERE event_type = 'signup'"


@query(PARSED.format(kind="NEW_SERVER"))
def new_anchor_text(ev):
    stamp = F.date_format(F.timestamp_seconds(F.expr("us div 1000000 + event_id % 9")), "yyyy-MM-dd HH:mm:ss")
    unix = F.concat(F.lit("unix="), F.expr("us div 1000000").cast("string"))
    one, two = F.concat_ws(" ", stamp, F.lit("dev=x type=ghg_v1"), unix), F.concat(stamp, F.lit(" dev=x type=ghg_v2\n"), stamp, F.lit(" raw "), unix)
    lines = ev.where("event_type = 'signup'").select("user_id", "event_id", F.when(F.expr("event_id % 2 = 0"), one).otherwise(two).alias("l"))
    files = lines.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "l"))).alias("x"))
    files = files.select(F.col("user_id").cast("string").alias("file_name"), F.array_join(F.transform("x", lambda x: x["l"]), "\n").alias("content"))
    return anchor_source.parse(files).withColumn("received_at", F.col("received_at").cast("timestamp_ntz"))


@query(PARSED.format(kind="OLD_TTN"))
def old_anchor_text(ev):
    stamp = F.date_format(F.timestamp_seconds(F.expr("us div 1000000 + event_id % 9")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    payload = F.concat(F.lit("{'co2': 410, 'ok': True, 'unix': "), F.expr("us div 1000000").cast("string"), F.lit(", 'x': None}"))
    lines = ev.where("event_type = 'signup'").select("user_id", "event_id", F.concat_ws("\t", F.lit("7"), stamp, payload).alias("l"))
    files = lines.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "l"))).alias("x"))
    body = F.array_join(F.transform("x", lambda x: x["l"]), "\n")
    files = files.select(F.col("user_id").cast("string").alias("file_name"), F.concat(F.lit("id\treceived_at\tdecoded_payload\n"), body).alias("content"))
    return anchor_source.parse(files).withColumn("received_at", F.col("received_at").cast("timestamp_ntz"))


@query("SELECT event_id, strptime(n, '%y%m%d%H') AS hour FROM (SELECT event_id, strftime(to_timestamp(us / 1000000) AT TIME ZONE 'UTC', '%y%m%d%H') AS n FROM ev WHERE event_id % 3 > 0)")
def hour_from_name(ev):
    name = F.concat(F.date_format(F.timestamp_micros("us"), "yyMMddHH"), F.when(F.expr("event_id % 3 = 0"), ".bak").otherwise(".TXT"))
    out = ev.withColumn("name", name)
    return out.select("event_id", rebuild.hour_of_name("name").cast("timestamp_ntz").alias("hour")).where("hour IS NOT NULL")


@query("SELECT event_id FROM ev WHERE event_id % 3 = 0")
def bad_file_names(ev):
    name = F.concat(F.date_format(F.timestamp_micros("us"), "yyMMddHH"), F.when(F.expr("event_id % 3 = 0"), ".bak").otherwise(".TXT"))
    return rebuild.bad_names(ev.withColumn("name", name), "name").select("event_id")


LINES = """,
h AS (SELECT *, to_timestamp(us / 1000000) AT TIME ZONE 'Europe/Copenhagen' AS l FROM ev),
k AS (SELECT *, strftime(l, '%m') AS m, strftime(l, '%y%m%d%H') AS hk FROM h)"""


@query("SELECT m AS month_folder, hk AS hour_key, 'Original_RTC,Sensor_Volt,CH4_Raw,Corrected_Time,Corrected_Local_Time' AS line FROM k GROUP BY ALL UNION ALL SELECT m, hk, concat_ws(',', strftime(to_timestamp(us / 1000000) AT TIME ZONE 'UTC', '%d.%m.%Y %H:%M:%S'), event_id, user_id, strftime(to_timestamp(us / 1000000) AT TIME ZONE 'UTC', '%d.%m.%Y %H:%M:%S'), strftime(l, '%d.%m.%Y %H:%M:%S')) FROM k", CTE + LINES)
def hourly_lines(ev):
    rows = ev.select(F.col("us").alias("rtc"), F.col("us").alias("spread"), F.array(F.col("event_id").cast("string"), F.col("user_id").cast("string")).alias("data_values"))
    return writers.hourly_lines(rebuild.local_hours(rows, "spread", "Europe/Copenhagen"), "Europe/Copenhagen", []).drop("rank")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'B' END AS device_id, CASE WHEN event_id % 2 = 0 THEN value END AS value FROM ev")
def device_merge(ev):
    a, b = ev.where("event_id % 2 = 0").select("event_id", "value"), ev.where("event_id % 2 = 1").select("event_id")
    return writers.merge_devices({"A": a, "B": b})


@query("SELECT user_id AS device_id, max(us) AS processed_at, arg_max(event_id, (us, event_id)) AS run_id, count(*) AS runs FROM ev GROUP BY ALL")
def run_log_latest(ev):
    return tables.latest_runs(ev.select(F.col("user_id").alias("device_id"), F.col("us").alias("processed_at"), F.col("event_id").alias("run_id")))


@query("SELECT user_id AS device_id, event_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id)::INTEGER AS run_number FROM ev WHERE user_id = 3")
def device_history(ev):
    log = ev.select(F.col("user_id").alias("device_id"), F.col("us").alias("processed_at"), F.col("event_id").alias("run_id"))
    return tables.device_history(log, 3).select("device_id", "run_id", "run_number")


@query("SELECT * FROM (SELECT count(*) AS rows, count(DISTINCT (user_id, segment_id)) AS segments, min(rtc) AS first_rtc, max(rtc) AS last_rtc, min(aligned) AS first_time, max(aligned) AS last_time, round(avg(confidence), 4) AS mean_confidence, round(100.0::DOUBLE * count(*) FILTER (WHERE confidence >= 0.9) / count(*), 4) AS high_pct, round(100.0::DOUBLE * count(*) FILTER (WHERE confidence >= 0.6 AND confidence < 0.9) / count(*), 4) AS medium_pct, round(100.0::DOUBLE * count(*) FILTER (WHERE confidence < 0.6) / count(*), 4) AS low_pct, round(avg((aligned - rtc) / 1e6), 4) AS mean_drift, round(avg((aligned - rtc) / 1e6) / 86400, 4) AS mean_days, round(max((aligned - rtc) / 1e6) / 86400, 4) AS max_days FROM borrowed), "
       "(SELECT count(*) AS files, sum(num_lines)::BIGINT AS lines, count(*) FILTER (WHERE is_chronological) AS chronological_files, count(*) FILTER (WHERE num_reversals > 0) AS files_with_reversals, round(avg(correct_hour_pct), 4) AS mean_hour_pct FROM qa WHERE num_valid_timestamps >= 2), "
       "(SELECT count(*) AS points, round(avg(abs(e)), 4) AS mae, round(median(abs(e)), 4) AS median_abs FROM err)", ERR + "," + FILES.removeprefix(CTE).lstrip().removeprefix(","))
def summary_report(ev):
    borrowed = borrowed_of(ev)
    out = stats.summary(borrowed, qa_of(ev), BY, stats.error_stats(errors_of(ev, borrowed=borrowed), []))
    data, drift, files = ("rows", "segments", "first_rtc", "last_rtc"), ("mean_days", "max_days"), ("files", "lines", "chronological_files", "files_with_reversals", "mean_hour_pct")
    return out.select(
        *(f"data.{c}" for c in data), F.col("data.first").alias("first_time"), F.col("data.last").alias("last_time"), F.col("confidence.mean").alias("mean_confidence"),
        "confidence.high_pct", "confidence.medium_pct", "confidence.low_pct", F.col("drift.mean_s").alias("mean_drift"), *(f"drift.{c}" for c in drift), *(f"output.{c}" for c in files),
        F.col("direct_validation.n").alias("points"), "direct_validation.mae", "direct_validation.median_abs",
    )


STRICT = FACTS.replace("coalesce(m0.match_received + (e.r0 - m0.matched_unix * 1000000), m0.match_received) AS t0, coalesce(m1.match_received + (e.r1 - m1.matched_unix * 1000000), m1.match_received) AS t1", "m0.match_received AS t0, m1.match_received AS t1")


@query(SHOWN.format(t="aligned"), STRICT.format(want="'anchor'"))
def align_anchor_strict(ev):
    return shown(aligned_of(ev, "anchor", Settings(strict_reference=True)))


@query(SHOWN.format(t="aligned"), STRICT.format(want="'linear_drift'"))
def align_linear_strict(ev):
    return shown(aligned_of(ev, "linear_drift", Settings(strict_reference=True)))
