"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.llm import sql
from larder.llm.alignment import ByteTokens, PieceTokens, alignment_report
from larder.llm.common import table, tokenizer_path
from larder.llm.compression import fit_compression, held_out, with_score
from larder.llm.covering import covering_groups
from larder.llm.decision_list import rule_report
from larder.llm.exact_mph import exact_report
from larder.llm.mixing import mix_documents
from larder.llm.near_dedup import NearRules, near_groups
from larder.llm.reply_trees import conversation_report
from larder.llm.revisits import page_revisits, ruled_revisits
from larder.llm.rollups import TokenTotals, withdrawn_corpus_totals
from larder.llm.secrets import secret_report
from larder.llm.sentencepieces import PieceModel, encoding_report
from larder.llm.structure_repair import repair_report
from larder.plans.lineage import scratch


def op1_revisits(spark: SparkSession, folder: str) -> DataFrame:
    return page_revisits(spark, folder)


def op1_revisits_ruled(spark: SparkSession, folder: str) -> DataFrame:
    return ruled_revisits(spark, folder)


def op2_entropy_mix(spark: SparkSession, folder: str) -> DataFrame:
    mix = mix_documents(table(spark, folder, "documents"))
    return mix.copies(mix.sized).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op3_piece_spans(spark: SparkSession, folder: str) -> DataFrame:
    model = PieceModel.load(tokenizer_path("piece_bpe_32k.model"))
    return encoding_report(table(spark, folder, "documents"), model)


def op4_hyperminhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(table(spark, folder, "documents"), NearRules(width=4))


def op5_reply_trees(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], rows.schema)
    return conversation_report(rows.unionByName(extra))


def op6_compression(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit_compression(docs, table(spark, folder, "labels"))
    return with_score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op7_markov_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_report(table(spark, folder, "documents"))


def op8_token_rollups(spark: SparkSession, folder: str) -> DataFrame:
    tables = TokenTotals(spark, scratch(spark, "rollups"))
    return withdrawn_corpus_totals(spark, folder, tables)


def op9_decision_list(spark: SparkSession, folder: str) -> DataFrame:
    found = rule_report(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_exact_mph(spark: SparkSession, folder: str) -> DataFrame:
    return exact_report(table(spark, folder, "documents")).drop("in_history")


def op11_covering_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return covering_groups(table(spark, folder, "documents"))


def op12_path_ranks(spark: SparkSession, folder: str) -> DataFrame:
    return repair_report(table(spark, folder, "conversations"))


def op13_pair_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    a, b = ByteTokens.load(tokenizer_path("byte_bpe_50k.json")), PieceTokens.load(tokenizer_path("piece_bpe_32k.model"))
    return alignment_report(table(spark, folder, "documents"), a, b)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_revisits": op1_revisits,
    "op1_revisits_ruled": op1_revisits_ruled,
    "op2_entropy_mix": op2_entropy_mix,
    "op3_piece_spans": op3_piece_spans,
    "op4_hyperminhash": op4_hyperminhash,
    "op5_reply_trees": op5_reply_trees,
    "op6_compression": op6_compression,
    "op7_markov_secrets": op7_markov_secrets,
    "op8_token_rollups": op8_token_rollups,
    "op9_decision_list": op9_decision_list,
    "op10_exact_mph": op10_exact_mph,
    "op11_covering_simhash": op11_covering_simhash,
    "op12_path_ranks": op12_path_ranks,
    "op13_pair_bitmaps": op13_pair_bitmaps,
}

ORACLES: dict[str, str] = {
    "op1_revisits": sql.REVISITS,
    "op1_revisits_ruled": sql.REVISITS_RULED,
    "op2_entropy_mix": sql.MIX,
    "op5_reply_trees": sql.CHAT,
    "op10_exact_mph": sql.EXACT,
}
