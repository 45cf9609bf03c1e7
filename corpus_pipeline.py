"""From raw documents to training shards.

Five stages, each on all that the stage before it kept: quality rules,
near duplicates, benchmark decontamination, mixing to target weights and
sharding.  ``run`` writes every stage's result as Parquet in the shared
checkpoint folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from promoscope.llm import containment, extendible, mix_threshold, rule_cascade, setsketch
from promoscope.llm import queries as _sql
from promoscope.llm._common import findable, materialize, scratch_dir

#: Short clean texts stay: only texts without words are too short here,
#: and repetition is judged from 20 words on.
MIN_WORDS = 1
MIN_REPEAT_WORDS = 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a quality rule rejects."""
    return rule_cascade.accepted(docs, rule_cascade.rules(MIN_WORDS, MIN_REPEAT_WORDS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return setsketch.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain a benchmark item."""
    return containment.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents, some twice, so that sources meet their weights."""
    return mix_threshold.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds each document's shard."""
    return extendible.shard(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of ``documents`` after all stages."""
    findable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_dir(spark)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, folder, name)
    return docs


def _over(sql: str, table: str) -> str:
    return sql.replace("FROM documents", f"FROM {table}")


ORACLE_SQL = f"""
WITH quality AS (SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM ({_sql.OP7_METRICS}
  SELECT doc_id FROM m WHERE NOT (n_words < {MIN_WORDS}
    OR (n_words >= {MIN_REPEAT_WORDS} AND 100 * n_repeat_words > {rule_cascade.MAX_REPEAT_PCT} * n_words)
    OR {_sql._REJECTED})))),
near AS (SELECT * FROM quality WHERE doc_id IN (
  SELECT doc_id FROM ({_over(_sql.near_sql(5), "quality")}) WHERE kept)),
clean AS (SELECT * FROM near WHERE doc_id NOT IN (
  SELECT doc_id FROM ({_over(_sql.OP9_SQL, "near")}))),
taken AS (SELECT doc_id, CASE WHEN size > 0 THEN taken // size ELSE 0 END AS copies
  FROM ({_over(_sql.OP8_SQL, "clean")})),
mixed AS (SELECT clean.* FROM clean JOIN taken USING (doc_id), (VALUES (1), (2)) AS t(i) WHERE i <= copies),
placed AS (SELECT DISTINCT * FROM ({_over(_sql.OP2_SQL, "mixed")}))
SELECT mixed.*, placed.* EXCLUDE (doc_id) FROM mixed JOIN placed USING (doc_id)
"""
