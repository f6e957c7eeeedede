"""Pipeline over ``documents``: STAGES in order, each written to the shared folder and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns of
``documents``: language identification drops texts whose language is not clear, the n-gram join keeps the first
document of each group of near copies, decontamination drops documents with passages of benchmark items, personal data
is replaced in the texts, and the rest is mixed by source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from propensity.llm import common, decontaminate, language, mixing, ngram_join, pii
from propensity.llm.common import read, remainder
from propensity.session import materialize


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or with a narrow margin between languages; learn from labelled rows of ``docs``."""
    return language.accepted(docs, language.fit(docs.where(remainder("doc_id", 3) != 1)))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each component of near copies, and one row of it. Rows without an id stay."""
    found = ngram_join.linked_components(docs).where("doc_id is not null")
    # an id with several texts may lie in several components: it goes if it is a copy in any
    ids = found.groupBy("doc_id").agg(F.min("component_id").alias("first"), F.count("*").alias("rows"))
    ids = materialize(ids, "ids")
    gone = ids.where("first != doc_id").select("doc_id")
    again = ids.where("first = doc_id and rows > 1").select("doc_id")
    # most documents are neither: their texts stay where they are
    apart, docs = common.parted(docs, F.xxhash64("doc_id"), gone.union(again).select(F.xxhash64("doc_id").alias("h")), "h")
    kept = docs.join(gone, "doc_id", "left_anti")
    once = kept.join(again, "doc_id", "left_anti")
    once = once.unionByName(kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])).select(docs.columns)
    return apart.unionByName(once)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a copy of a benchmark item, edited or not, with an id or without."""
    return decontaminate.without(docs, read(spark, sf_dir, "benchmark")).select(docs.columns)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and terms that disclose it; every document stays."""
    return pii.sanitised(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deal what is left into blocks by source weights."""
    return mixing.mix(docs)


STAGES = [
    ("language", identify),
    ("ngram_join", deduplicate),
    ("decontaminate", decontaminated),
    ("pii", sanitise),
    ("mixing", mix),
]

#: Compression, alignment and tokens by class are not SQL: the pipeline is tested against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
