"""Reception logs: two text formats, sniffed by their first line, to anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.sources.sd_text import LINE_END, read_files, strip

#: What the first line of each format looks like, and the mark of a usable message.
OLD_MARK = "received_at"
NEW_START = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"
MESSAGE_MARK = "type=ghg"


def sniff(files: DataFrame) -> DataFrame:
    """``files`` with their ``lines`` and ``format``."""
    lines = F.split("content", LINE_END)
    first = lines[0]
    kind = F.when(first.contains(OLD_MARK), "OLD_TTN").when(strip(first).rlike(NEW_START), "NEW_SERVER").otherwise("UNKNOWN")
    return files.select(*[c for c in files.columns if c != "content"], lines.alias("lines"), kind.alias("format"))


def parse_old(files: DataFrame) -> DataFrame:
    """Tab-separated rows under a header; the payload is a dictionary literal that holds ``unix``."""
    names = F.split(F.col("lines")[0], "\t")
    rows = files.where("format = 'OLD_TTN'").select("file_name", names.alias("n"), F.explode(F.slice("lines", F.lit(2), F.size("lines"))).alias("line"))
    cells = F.split("line", "\t", -1)

    def cell(name: str):
        return F.regexp_replace(F.try_element_at(cells, F.nullif(F.array_position("n", name), F.lit(0)).cast("int")), '^"|"$', "")

    unix = F.nullif(F.regexp_extract(cell("decoded_payload"), r"""['"]unix['"]\s*:\s*['"]?(-?\d+)""", 1), F.lit(""))
    out = rows.select(unix.try_cast("bigint").alias("unix"), cell("received_at").try_cast("timestamp").alias("received_at"), F.lit("OLD_TTN").alias("format"), F.col("file_name").alias("source_file"))
    return out.where("unix IS NOT NULL AND received_at IS NOT NULL")


def parse_new(files: DataFrame) -> DataFrame:
    """Message lines of ``key=value`` tokens; ``unix`` is on the line or on the very next one of the same date."""
    after = F.concat(F.slice("lines", F.lit(2), F.size("lines")), F.array(F.lit("")))
    rows = files.where("format = 'NEW_SERVER'").select("file_name", F.explode(F.arrays_zip(F.col("lines").alias("line"), after.alias("after"))).alias("x"))
    rows = rows.select("file_name", strip(F.col("x.line")).alias("line"), strip(F.col("x.after")).alias("after")).where(F.col("line").contains(MESSAGE_MARK))
    rows = rows.withColumn("t", F.split("line", r"\s+")).withColumn("u", F.split("after", r"\s+"))

    def values(tokens: str):
        return F.filter(tokens, lambda x: x.startswith("unix="))

    own, other = values("t"), values("u")
    date = F.col("t")[0]
    beside = F.when(F.col("after").startswith(date) & F.col("after").contains("unix="), F.try_element_at(other, F.lit(1)))
    token = F.coalesce(F.try_element_at(own, F.lit(-1)), beside)
    unix = F.substring(token, 6, 1 << 30).try_cast("bigint")
    time = F.try_to_timestamp(F.concat_ws(" ", date, F.try_element_at("t", F.lit(2))), F.lit("yyyy-MM-dd HH:mm:ss"))
    out = rows.select(unix.alias("unix"), time.alias("received_at"), F.lit("NEW_SERVER").alias("format"), F.col("file_name").alias("source_file"))
    return out.where("unix > 0 AND received_at IS NOT NULL")


def parse(files: DataFrame) -> DataFrame:
    """``unix, received_at, format, source_file`` of all known files, as they stand."""
    known = sniff(files)
    return parse_old(known).unionByName(parse_new(known))


def load(spark: SparkSession, path: str, device_id: str) -> DataFrame:
    """The anchors of a folder, one for each ``unix``, the earliest received; ``ValueError`` if there are none."""
    from driftlake.operators.rebuild import distinct_anchors

    folder = path.rsplit("/", 1)[0] if path.lower().endswith(".txt") else path
    found = parse(read_files(spark, folder, recursive=False)).withColumn("device_id", F.lit(device_id))
    found = found.withColumn("received", F.unix_micros("received_at"))
    if found.isEmpty():
        raise ValueError(f"no anchors in {folder}")
    return distinct_anchors(found, ["device_id"])
