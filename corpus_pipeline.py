"""A corpus pipeline of the training-data operators.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps; :func:`run` writes every
stage's result as Parquet and reads it back as the next one's documents. All stages but the
last return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formspark.llm import decontaminate, langid, mixing, setjoin, sharding
from formspark.llm._tables import ready, written
from formspark.llm.queries import SHARDS, remainder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents of undetermined language go, those without letters.

    No score is asked for: the network spreads all probability over the languages it learned, so a
    text in two or more of them, or a short one, scores as low as one in none. Where no row is
    labelled there is nothing to tell languages by, and documents with letters stay.
    """
    ready(spark)
    net = langid.fit(docs, remainder("doc_id", 5) != 0)
    if net is None:
        return docs.where(langid.lettered("text"))
    return langid.predict(docs, net).where(F.col("lang_pred") != langid.UNDETERMINED).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: the document with the smallest id of each group stays.

    Groups are those of the library's default for near duplicates: five words, similarity 0.8.
    Documents without words are in no group.
    """
    ready(spark)
    return setjoin.representatives(docs, k=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark item go."""
    return decontaminate.clean(docs, ready(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: a row for every time that the mix takes a document."""
    ready(spark)
    return mixing.repeated(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sharding: the shard and slot of every row."""
    ready(spark)
    return sharding.shard(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mix),
    ("sharding", shards),
]

#: The network and the budget fitting have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{i}")
    return docs
