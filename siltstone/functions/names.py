"""File names of public archives, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the public name of an archive: kind, expansion and format; tokens hold no dots.
PATTERN = r"^(replay|game|draft)_data_public\.([^.]+)\.([^.]+)\.csv\.gz$"


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def recognise(name: Column) -> Column:
    """Struct of source_kind, expansion, format, diagnostic; case matters, and nothing is guessed."""
    known = name.rlike(PATTERN)
    part = lambda k: F.when(known, F.regexp_extract(name, PATTERN, k))
    return F.struct(
        F.when(known, F.regexp_extract(name, PATTERN, 1)).otherwise("unknown").alias("source_kind"),
        part(2).alias("expansion"),
        part(3).alias("format"),
        F.when(~F.coalesce(known, F.lit(False)), F.when(name.rlike(r"(?i)\.csv\.gz$"), "unrecognised_name").otherwise("not_an_archive")).alias("diagnostic"),
    )
