"""The thin queries over the operators, and the SQL of those that SQL can express.

Each takes (spark, sf_dir), applies its operator with production parameters to
the whole of its table, and derives the columns of its result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import filter_audit, line_dedup, media, mixing, oracles, packing, page_template, periodic_runs, pu_quality, quality_rules, simhash, toxicity, transcripts, warc
from siltstone.llm.common import table

#: Names of the tokenizer's files, to be found in the folder of public tokenizers.
TOKENIZER_RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER_JSON = "byte_bpe_50k.json"


#: Weights of the sources; others have weight 1.
MIX_WEIGHTS = {"src0": 8, "src1": 4, "src2": 2}


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER_RANKS)), str(public_tokenizers.path(TOKENIZER_JSON))


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.read_media(media.store_media(table(spark, sf_dir, "documents")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents")).drop("char_distance", "common_distance")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), *tokenizer_paths())


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.removed_lines(table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join("removed", ",").alias("removed"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = transcripts.parse(transcripts.raw_transcripts(table(spark, sf_dir, "conversations")))
    return found.select(F.col("conv").cast("long").alias("conv_id"), F.col("position").alias("turn"), "role", "turns_begun", "n_lines", "rendered")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"))
    return mixing.mix(docs, MIX_WEIGHTS)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_pages(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "timestamp", "capture_place", "history_place")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_page_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_template.extract(table(spark, sf_dir, "pages"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.detected(table(spark, sf_dir, "documents"), periodic_runs.planted))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_media": op1_media,
        "op2_toxicity": op2_toxicity,
        "op3_quality_rules": op3_quality_rules,
        "op4_packing": op4_packing,
        "op5_line_dedup": op5_line_dedup,
        "op6_simhash": op6_simhash,
        "op7_pu_quality": op7_pu_quality,
        "op8_transcripts": op8_transcripts,
        "op9_mixing": op9_mixing,
        "op10_warc": op10_warc,
        "op11_filter_audit": op11_filter_audit,
        "op12_page_template": op12_page_template,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_quality_rules": oracles.quality(),
        "op5_line_dedup": oracles.line_dedup(),
        "op9_mixing": oracles.mixture(MIX_WEIGHTS),
        "op10_warc": oracles.warc_captures(),
        "op11_filter_audit": oracles.filter_audit(),
    }
