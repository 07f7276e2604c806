"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts: space, tab, LF, VT, FF, CR.
ASCII_SPACE = "\t\n\x0b\x0c\r "
#: Bytes that a writer of intermediate tables holds before it writes a group of rows.
_ROW_GROUP = 8 << 20
#: Files that a bucketed table may have without a shuffle before it.
FILES = 50_000
#: Paths of intermediate tables that results may still read, and whether the catalog knows them.
_HELD: list[tuple[str, bool]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark alone so that any file system works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches sent to Python by bytes, so long texts cannot fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, which ``spark.checkpoint.dir`` of the session names.

    A local one is set only where a local session names none, as in tests.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files, which else stay until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _tasks(df: DataFrame) -> int:
    """The tasks that write ``df``; a plan with exchanges isn't asked, since it would run them to answer."""
    if df._jdf.queryExecution().executedPlan().nodeName() == "AdaptiveSparkPlan":
        return partitions(df.sparkSession)
    return df.rdd.getNumPartitions()


def durable(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` by way of a compressed table in the shared folder: its lineage ends there, whatever executors are lost.

    With ``keys`` its rows lie in buckets of them, so that joins on the keys need not shuffle it. Each task writes to
    each bucket as long as that makes at most ``FILES`` files, beyond which the rows are first dealt by their keys. The
    table stays until :func:`release`; the shuffle files that led to it go at once.
    """
    spark, name = df.sparkSession, f"held_{uuid4().hex}"
    path, options = f"{shared_dir(spark)}/{name}", {"compression": "zstd", "parquet.block.size": _ROW_GROUP}
    _HELD.append((path, bool(keys)))
    with shuffles_removed(spark):
        if keys:
            if _tasks(df) * partitions(spark) > FILES:
                df = df.repartition(partitions(spark), *keys)
            df.write.format("parquet").options(**options).option("path", path).bucketBy(partitions(spark), *keys).saveAsTable(name)
            return spark.table(name)
        df.write.options(**options).parquet(path)
    return spark.read.parquet(path)


def mark() -> int:
    """Where the tables made from now on begin, for :func:`release`."""
    return len(_HELD)


def release(spark: SparkSession, since: int = 0, but: int = 0, read_by: DataFrame | None = None) -> None:
    """Remove the tables made since :func:`mark`, all but the last ``but`` and those that ``read_by`` reads.

    Nothing else may read them any more. A driver that dies leaves its tables behind, all named ``held_...``.
    """
    needed = set() if read_by is None else {part for f in read_by.inputFiles() for part in f.split("/") if part.startswith("held_")}
    stay = []
    for path, named in _HELD[since : len(_HELD) - but]:
        name = path.rpartition("/")[2]
        if name in needed:
            stay.append((path, named))
            continue
        if named:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _HELD[since : len(_HELD) - but] = stay


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes to clash with no column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(name: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
