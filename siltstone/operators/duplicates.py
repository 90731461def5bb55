"""Classes of duplicates, and their disposition, never by order of arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def classified(df: DataFrame, id_column: str, content: str, archive: str) -> DataFrame:
    """(id, content, rows, archives, contents, dup_class), a row for each id and content.

    unique; exact_duplicate: again in one archive; source_duplicate: in more than
    one; identity_collision: one id with more than one content.
    """
    # One row per archive first: copies, however many, are summed where they lie.
    here = df.groupBy(id_column, content, archive).agg(F.count("*").alias("_n"))
    by_content = here.groupBy(id_column, content).agg(F.sum("_n").alias("rows"), F.count("*").alias("archives"))
    by_id = by_content.groupBy(id_column).agg(F.count("*").alias("contents"))
    kind = F.when(F.col("contents") > 1, "identity_collision").when(F.col("archives") > 1, "source_duplicate").when(F.col("rows") > 1, "exact_duplicate").otherwise("unique")
    return by_content.join(by_id, id_column).withColumn("dup_class", kind)


def class_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("dup_class").agg(F.count("*").alias("contents"), F.sum("rows").alias("rows"))


def collisions(df: DataFrame, id_column: str, content: str) -> DataFrame:
    """Ids with more than one content: (id, contents, rows)."""
    by_content = df.groupBy(id_column, content).agg(F.count("*").alias("_n"))
    return by_content.groupBy(id_column).agg(F.count("*").alias("contents"), F.sum("_n").alias("rows")).where("contents > 1")


def collapse(df: DataFrame, id_column: str, content: str, provenance: str) -> DataFrame:
    """One row per id and content, with every different provenance, in order.

    Which row stands for the rest does not matter: they have one content.
    """
    return df.groupBy(id_column, content).agg(F.sort_array(F.collect_set(provenance)).alias("provenance"), F.count("*").alias("copies"))


def quarantine(df: DataFrame, id_column: str, content: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined): all rows of an id that has more than one content are held back."""
    bad = collisions(df, id_column, content).select(id_column)
    return df.join(bad, id_column, "left_anti"), df.join(bad, id_column, "left_semi")


def collision_examples(df: DataFrame, id_column: str, content: str, locator: str, k: int = 3) -> DataFrame:
    """For each collision its rows and its first ``k`` different locators, in order.

    Ranks over ``k`` are dropped before the shuffle, so that an id's locators are never gathered.
    """
    _, bad = quarantine(df, id_column, content)
    rank = F.row_number().over(Window.partitionBy(id_column).orderBy(locator))
    first = bad.where(F.col(locator).isNotNull()).select(id_column, locator).distinct().withColumn("_rank", rank).where(F.col("_rank") <= k)
    first = first.groupBy(id_column).agg(F.sort_array(F.collect_list(locator)).alias("examples"))  # k each
    none = F.array().cast(first.schema["examples"].dataType)
    return collisions(df, id_column, content).select(id_column, "rows").join(first, id_column, "left").select(id_column, "rows", F.coalesce("examples", none).alias("examples"))
