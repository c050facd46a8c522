"""Documents to packed training sequences, in stages that are each written and read again.

The stages of this file keep the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridebase.llm import decontaminate, neighbours, ngram_join, packing
from stridebase.llm.queries import TOKENIZER
from stridebase.llm.tables import cut_lineage, table


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their labelled neighbours vote for; the labels are those of ``docs`` itself."""
    voters = neighbours.fit_voters(docs, table(spark, sf_dir, "labels"))
    scored = neighbours.quality_scores(docs, voters)
    return scored.where(F.col("score") >= neighbours.ACCEPTED).drop("score")


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near-duplicates."""
    return ngram_join.one_of_each_class(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of what is left, one row per piece of a document."""
    pieces = packing.token_pieces(docs, TOKENIZER).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(pieces)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good_documents),
    ("n-gram Jaccard join", keep_one_of_each_class),
    ("benchmark decontamination", keep_uncontaminated),
    ("best-fit packing", pack_documents),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
