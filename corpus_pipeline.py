"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as
Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.llm.common import table, tokenizer_path
from larder.llm.compression import fit_compression, keep_good
from larder.llm.exact_mph import drop_exact
from larder.llm.mixing import mixed_corpus
from larder.llm.near_dedup import drop_near
from larder.llm.sentencepieces import PieceModel, encoded
from larder.plans.lineage import scratch

TOKENIZER = "piece_bpe_32k.model"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier takes for good ones."""
    return keep_good(docs, fit_compression(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space aside."""
    return drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8."""
    return drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, or up to three times."""
    return mixed_corpus(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document with begin and end marks, and the bytes that each id stands for."""
    return encoded(docs, PieceModel.load(tokenizer_path(TOKENIZER))).withColumn("n_tokens", F.size("ids"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mix sources", mix_sources),
    ("encode pieces", encode_pieces),
]

#: SQL can't express the classifier, the sketches or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them goes to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    base = scratch(spark, "corpus")
    for k, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return made
        made.write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
