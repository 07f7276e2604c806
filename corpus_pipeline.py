"""The corpus pipeline: quality rules, line dedup, near-dedup, personal data, packing.

Each stage takes all that the one before kept and writes its result out. All but the last return the
columns of ``documents``; where a stage changes a text, ``n_chars`` follows it. A stage reads what the one before
wrote, so it begins by removing the intermediate tables from there that its input does not read.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.llm import linededup, pack, pii, quality, simhash
from driftlake.llm.common import release, shared_dir, table

#: DuckDB cannot express the trained stages; tests hold the pipeline against brute force.
ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _named(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _count_chars(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and the classifier trained on the labelled ones.

    Null and empty texts have no words and go; repeated rows are judged alike; without labels only the rules count.
    """
    release(spark, read_by=docs)
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line is similar to; see :func:`linededup.remove_lines` for nulls and ties."""
    release(spark, read_by=docs)
    return _count_chars(linededup.remove_lines(docs).select(*_named(docs)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, five-word shingles and Jaccard similarity 0.8: that of least ``doc_id``.

    Null and blank texts are one group, and repeated rows copies; see :func:`simhash.keep_one`.
    """
    release(spark, read_by=docs)
    return simhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; null texts stay null, no row goes."""
    release(spark, read_by=docs)
    return _count_chars(pii.mask(docs, pii.train(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences; a null or empty text is its closing id."""
    release(spark, read_by=docs)
    return pack.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("line dedup", drop_lines),
    ("near dedup", drop_near_copies),
    ("personal data", mask_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written to the shared folder and read again.

    Only the last one's folder stays. A table without rows goes through all stages and gives none.
    """
    docs, at = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid4().hex}"
    files = spark._jvm.org.apache.hadoop.fs.Path(at).getFileSystem(spark._jsc.hadoopConfiguration())
    done = 0
    try:
        for i, (_, stage) in enumerate(STAGES):
            stage(spark, docs, sf_dir).write.parquet(f"{at}/{i}")
            docs, done = spark.read.parquet(f"{at}/{i}"), i
            if i:
                files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{at}/{i - 1}"), True)
    finally:
        release(spark)
        if done < len(STAGES) - 1:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(at), True)
    return docs
