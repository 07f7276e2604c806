"""One query for each training-data operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.llm.common import table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from driftlake.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from driftlake.llm.shard import shard

    return shard(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from driftlake.llm.bpe import digests, encode

    return digests(encode(table(spark, sf_dir, "documents")))


def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from driftlake.llm.materialise import materialise, scratch

    return materialise(table(spark, sf_dir, "documents"), scratch(spark))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from driftlake.llm.quality import score, train

    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from driftlake.llm.pii import KINDS, find, train

    docs = table(spark, sf_dir, "documents")
    found = find(docs, train(docs))
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from driftlake.llm.pack import pack

    return pack(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from driftlake.llm.substring import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), keep_text=False).withColumnRenamed("kept", "kept_sha256")


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from driftlake.llm.embed import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from driftlake.llm.linededup import remove_lines

    left = remove_lines(table(spark, sf_dir, "documents"))
    return left.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


#: Every window as text, the least document of each, and the words that no repeated window covers.
OP8_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, s, array_to_string(words[s:s + 12], ' ') AS w FROM docs, unnest(range(1, len(words) - 11)) AS t(s)),
repeated AS (SELECT doc_id, s FROM (SELECT *, min(doc_id) OVER (PARTITION BY w) AS first FROM windows) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, s + k AS i FROM repeated, unnest(range(13)) AS t(k)),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS rest
  FROM placed LEFT JOIN gone USING (doc_id, i) WHERE gone.i IS NULL GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""


#: All pairs of lines with a common token, by their whole token sets: five-word shingles, or all the words of a shorter line.
OP10_SQL = r"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS no FROM split),
words AS (SELECT doc_id, no, regexp_extract_all(line, '[^\x20\x09\x0B-\x0D]+') AS ws FROM lines),
shingles AS (
  SELECT DISTINCT doc_id, no, array_to_string(ws[i:i + 4], ' ') AS s
  FROM words, unnest(range(1, greatest(len(ws) - 3, 2))) AS t(i) WHERE len(ws) > 0),
sizes AS (SELECT doc_id, no, count(*) AS n FROM shingles GROUP BY ALL),
pairs AS (
  SELECT a.doc_id, a.no, b.doc_id AS od, b.no AS ono, count(*) AS c FROM shingles a JOIN shingles b USING (s)
  WHERE (b.doc_id, b.no) < (a.doc_id, a.no) GROUP BY ALL),
gone AS (
  SELECT DISTINCT p.doc_id, p.no, true AS g FROM pairs p JOIN sizes x ON x.doc_id = p.doc_id AND x.no = p.no
  JOIN sizes y ON y.doc_id = p.od AND y.no = p.ono WHERE 5 * c >= 4 * (x.n + y.n - c)),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(g) AS n_removed,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE g IS NULL), '')) AS kept_sha256
  FROM lines LEFT JOIN gone USING (doc_id, no) GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_substring_dedup": OP8_SQL, "op10_line_dedup": OP10_SQL}
