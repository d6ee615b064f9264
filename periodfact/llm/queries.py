"""The registered queries of this subpackage, one for each operator, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodfact.llm import (bpe, chat, fill_middle, fingerprints, html_extract, neardup, packing, quality, runs, secret_scan,
                            token_counts, token_files, toxicity)
from periodfact.llm.common import shared_table, table
from periodfact.llm.oracle import CHAT, NEARDUP, QUOTED_REPLIES
from periodfact.session import scratch_path


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


RANKS = "byte_bpe_50k.tiktoken"  # byte_bpe_50k.json's vocabulary as ranks


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(RANKS))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def op3_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, vocabulary(RANKS), bpe.lexicon_of(docs, vocabulary(RANKS)))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_followers(table(spark, sf_dir, "documents"))


def op7_consensus_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op8_min_max_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(table(spark, sf_dir, "conversations"))


def quoted_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9's operator on the conversations with quotations put into them."""
    quoting = chat.with_quotations(table(spark, sf_dir, "conversations"))
    # stored once, as it is read several times, by at least a task for each core: the texts are short and the work on them isn't
    return chat.digests(shared_table(quoting.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))),
                                                         "conv_id", "turn"), "quoting"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs.withColumn("doc_id", F.col("doc_id").cast("long")), model)


def op11_simple8b_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "op11")
    token_files.write_files(table(spark, sf_dir, "documents"), folder, vocabulary(RANKS))
    return token_files.digests(token_files.read_files(spark, folder))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(table(spark, sf_dir, "documents")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(runs.periodic_runs(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_best_fit_packing, op2_secret_scan, op3_quality_ledger, op4_token_counts, op5_bpe_round_trip,
        op6_winnowing, op7_consensus_extraction, op8_min_max_neardup, op9_quotation_links, op10_toxicity, op11_simple8b_files,
        op12_fill_in_middle, op13_periodic_runs, quoted_replies)}


def oracle_sql() -> dict[str, str]:
    return {"op3_quality_ledger": quality.ORACLE, "op8_min_max_neardup": NEARDUP, "op9_quotation_links": CHAT,
            "quoted_replies": QUOTED_REPLIES}
