"""Sensor text: files to lines to measurement rows, with recovery of lines that lost their breaks.

Everything is an expression over the line; rejected lines stay as rows with a ``reject_reason``, so every
counter is an aggregate of the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A time inside a line, and a field that is wholly a time.
TIME = r"\d{2}\.\d{2}\.\d{4}\s+\d{2}:\d{2}:\d{2}"
FIELD = r"^\d{1,2}\.\d{1,2}\.\d{4}\s+\d{1,2}:\d{1,2}:\d{1,2}$"
LINE_END = r"\r\n|\r|\n"


def strip(x: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def read_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """``file_path, file_name, content`` of the text files under ``path``, suffix in any case."""
    options = {"wholetext": True, "pathGlobFilter": "*.[tT][xX][tT]"}
    reader = spark.read.option("ignoreCorruptFiles", "true").option("recursiveFileLookup", str(recursive).lower())
    files = reader.text(path, **options)
    return files.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"), F.make_valid_utf8("value").alias("content"))


def split_lines(files: DataFrame) -> DataFrame:
    """One row for each line that is not blank, with its number from 1; blank lines count."""
    rest = [c for c in files.columns if c != "content"]
    lines = files.select(*rest, F.posexplode(F.split("content", LINE_END)).alias("_i", "line"))
    lines = lines.select(*rest, (F.col("_i") + 1).alias("line_number"), strip(F.col("line")).alias("line"))
    return lines.where("line <> ''")


def parse_time(field: Column) -> Column:
    """Day first, one or two digits, any white space between date and time; null if the field is anything else."""
    plain = F.regexp_replace(field, r"\s+", " ")
    return F.when(field.rlike(FIELD), F.try_to_timestamp(plain, F.lit("d.M.yyyy H:m:s")))


def pieces(line: str, strict: bool) -> Column:
    """A joined line's pieces, each up to the end of one of its times.

    ``strict`` looks every time up by its text, so of equal times only the first is found; otherwise each
    occurrence ends a piece of its own and no row is lost.
    """
    if not strict:
        even = rf"regexp_replace({line}, '(\\d{{2}}\\.\\d{{2}}\\.\\d{{4}})\\s+(\\d{{2}}:\\d{{2}}:\\d{{2}})', '$1 $2')"
        cut = rf"split({even}, '(?<=\\d{{2}}\\.\\d{{2}}\\.\\d{{4}} \\d{{2}}:\\d{{2}}:\\d{{2}})')"
        return F.expr(f"slice({cut}, 1, size({cut}) - 1)")
    found = f"regexp_extract_all({line}, r'{TIME}', 0)"
    placed = f"array_sort(transform({found}, (t, i) -> named_struct('p', locate(t, {line}), 'i', i, 'z', locate(t, {line}) + length(t))))"
    start = f"if(i = 0, 1, {placed}[i - 1].z)"
    return F.expr(f"transform({placed}, (x, i) -> substring({line}, {start}, x.z - {start}))")


def to_utc(local: Column, offset_min: Column | int) -> Column:
    """The UTC time of a device's local one, less its fixed offset in minutes."""
    minutes = F.lit(offset_min) if isinstance(offset_min, int) else offset_min
    return local - F.make_dt_interval(F.lit(0), F.lit(0), minutes)


def parse(lines: DataFrame, strict: bool = False, offset_min: Column | int = 60) -> DataFrame:
    """Measurement rows from lines with ``file_name, line_number, line``.

    Adds ``concat_group_id, rtc_time, timestamp_str, data_values, num_fields, is_concatenated, concat_position,
    line_content, reject_reason``. ``rtc_time`` is UTC: the text's time less the device's fixed offset.
    """
    joined = F.regexp_count("line", F.lit(TIME)) > 1
    marked = lines.withColumn("is_concatenated", joined)
    cut = F.when(joined, pieces("line", strict)).otherwise(F.array("line"))
    rows = marked.select(*lines.columns, "is_concatenated", F.posexplode_outer(cut).alias("concat_position", "_piece"))
    body = strip(F.col("_piece"))
    foreign = F.col("is_concatenated") & ~body.rlike(r"^[\x01-\x7F]*$")
    body = F.when(F.col("is_concatenated"), F.regexp_replace(body, "^,", "")).otherwise(body)
    fields = F.split(body, ",", -1)
    rows = rows.withColumn("line_content", body).withColumn("_foreign", foreign).withColumn("_f", fields)
    last = strip(F.element_at("_f", -1))
    local = F.when(~F.col("_foreign") & (F.size("_f") >= 2), parse_time(last))
    reason = (
        F.when(F.col("_piece").isNull() | (F.col("line_content") == ""), "empty piece").when(F.col("_foreign"), "foreign characters")
        .when(F.size("_f") < 2, "too few fields").when(F.col("rtc_time").isNull(), "no time in the last field")
    )
    values = F.transform(F.slice("_f", F.lit(1), F.greatest(F.size("_f") - 1, F.lit(0))), strip)
    out = rows.withColumn("rtc_time", to_utc(local, offset_min)).withColumn("timestamp_str", last).withColumn("data_values", values)
    return out.select(
        *lines.columns,
        F.concat_ws(":", "file_name", F.col("line_number").cast("string")).alias("concat_group_id"),
        "rtc_time", "timestamp_str", "data_values", F.size("data_values").alias("num_fields"), "is_concatenated",
        F.coalesce("concat_position", F.lit(0)).alias("concat_position"), "line_content", reason.alias("reject_reason"),
    )


def join_types(rows: DataFrame) -> DataFrame:
    """Recovered rows by type of join: 1 the first two times differ, 2 the values, 3 neither."""
    good = rows.where("is_concatenated AND reject_reason IS NULL")
    keys = [c for c in ("device_id", "file_path", "concat_group_id") if c in rows.columns]
    ordered = F.array_sort(F.collect_list(F.struct("rtc_time", "concat_position", "data_values")))  # the pieces of one line
    groups = good.groupBy(*keys).agg(ordered.alias("r")).where(F.size("r") >= 2)
    first, second = F.col("r")[0], F.col("r")[1]
    kind = F.when(first["rtc_time"] != second["rtc_time"], 1).when(first["data_values"] != second["data_values"], 2).otherwise(3)
    return groups.groupBy(kind.alias("join_type")).agg(F.sum(F.size("r")).cast("long").alias("rows"))


def counters(rows: DataFrame, file: str = "file_name") -> DataFrame:
    """Files, lines, skipped and joined lines, and rows recovered from them."""
    lines = rows.groupBy(file, "line_number").agg(F.max("is_concatenated").alias("joined"), F.count_if(F.col("reject_reason").isNull()).alias("good"))
    joined = F.col("joined") & (F.col("good") > 0)
    return lines.agg(
        F.countDistinct(file).alias("files"), F.count("*").alias("lines"), F.count_if(F.col("good") == 0).alias("skipped_lines"),
        F.count_if(joined).alias("joined_lines"), F.sum(F.when(joined, F.col("good")).otherwise(0)).alias("recovered_rows"),
        F.avg(F.when(joined, F.col("good"))).alias("rows_per_joined_line"), (100.0 * F.count_if(joined) / F.count("*")).alias("pct_joined"),
    )


def drop_repeats(rows: DataFrame) -> DataFrame:
    """Without rows of equal file, time, values, position and group; a whole load has none."""
    return rows.dropDuplicates([c for c in ("device_id", "file_path", "rtc_time", "data_values", "concat_position", "concat_group_id") if c in rows.columns])


def load(spark: SparkSession, path: str, device_id: str, offset_min: int = 60, strict: bool = False) -> DataFrame:
    """All lines of a device's folder as rows, the rejected ones among them."""
    lines = split_lines(read_files(spark, path)).withColumn("device_id", F.lit(device_id))
    return parse(lines, strict, offset_min)
