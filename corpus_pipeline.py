"""Training text from documents: a chain of stages, each over all rows that its predecessor kept.

Quality rules, line deduplication, near-deduplication, mixing to target weights and
packing.  Each stage takes (spark, docs, sf_dir); all but the last return rows with
the columns of documents.  ``run`` writes each stage's rows as a table and reads
them for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import line_dedup, mixing, packing, quality_rules, queries, shingle_sets
from siltstone.llm.common import cut, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go that an earlier line of the corpus is like; every document stays."""
    return line_dedup.dedup_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays, that with the smallest doc_id.

    SimHash fingerprints and their trie self-join find them, shingle sets verify; an exact join finds what fingerprints miss.
    """
    return shingle_sets.keep_first(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mixture of their sources."""
    return mixing.mixed_documents(docs, queries.MIX_WEIGHTS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, placed in sequences of fixed length that follow the mixture.

    Tables promise no order, so the mixture's places are computed again from the same rows.
    """
    return packing.pack_mixture(docs, *queries.tokenizer_paths(), queries.MIX_WEIGHTS)


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("mixture", mixture), ("sequences", sequences)]

#: SQL has neither the shingles' XXH64 nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
