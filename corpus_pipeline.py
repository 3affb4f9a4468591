"""A corpus from raw documents to packed sequences, in stages.

Every stage takes what its predecessor kept, as (spark, docs, sf_dir), and returns a frame
with the columns of ``documents``; the last one returns the packed pieces. ``run`` writes
each stage's result as Parquet to the shared checkpoint folder and rereads it.

Columns beyond those of ``documents`` are dropped by the first stage. An empty table gives
an empty result. Null and empty texts fail the quality rules. Of rows with the same doc_id
and text the near-duplicate stage keeps one; rows without doc_id go on unlinked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomframe.llm import decontaminate, near_copies, packing, pii, quality
from loomframe.llm.shared import ready, stored, table
from loomframe.plans.registry import Registry

plan = Registry()
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their group's fences."""
    ready(spark)
    return quality.passed(docs.select(*COLUMNS))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked ones."""
    ready(spark)
    return near_copies.first_of_each(docs.select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data masked in text, and n_chars counted anew."""
    ready(spark)
    return pii.mask(docs.select(*COLUMNS), length="n_chars")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences."""
    ready(spark)
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("ngram_jaccard_join", ngram_jaccard_join),
          ("benchmark_decontamination", benchmark_decontamination), ("personal_data", personal_data),
          ("best_fit_packing", best_fit_packing)]

#: Two stages (masking by a trained field, packing) can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


plan.add(name="pipeline")(run)
