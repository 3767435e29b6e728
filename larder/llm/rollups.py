"""Token totals kept by signed deltas.

Totals by source, language and tokenizer version are sums, so a batch of changes
needs no recount: what a changed document counted before is subtracted and what it
counts now is added. A batch writes its document rows and its summed deltas under
its number and then a commit record. Only committed batches are read, a committed
batch is not applied again, and a batch that died half-way is written anew from
the same input, so each counts exactly once.

Document rows lie in buckets by id, so a batch reads the buckets that it touches and
no others, and ``compact`` puts the last row of each living document into a snapshot,
so that it reads one row a document and what came after, however long the history.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.llm.common import slices, table, tokenizer_path

KEYS = ("source", "lang", "version")
_DOC_LOG = "doc_id long, source string, lang string, version string, tokens long, alive boolean, batch long, bucket int"
_DELTAS = "source string, lang string, version string, docs long, tokens long, batch long"
_COMMITS = "done boolean, batch long"
#: Folders of a batch's document rows; a batch of few documents has few of them.
BUCKETS = 64


@lru_cache(2)
def _encoding(raw: bytes, pattern: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """doc_id, source, lang and the tokens of each whole text by a byte-level BPE; null and empty texts have none."""
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(*shared.value)
        for batch in batches:
            for part in slices(batch):
                counts = [len(encoding.encode_ordinary(t)) if t else 0 for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {c: part.column(c) for c in ("doc_id", "source", "lang")} | {"tokens": pa.array(counts, pa.int64())}
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "text")
    return rows.mapInArrow(run, "doc_id long, source string, lang string, tokens long")


class TokenTotals:
    """Totals in a folder of shared storage."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _commits(self) -> DataFrame:
        return self._read("commits", _COMMITS).distinct()

    def is_committed(self, batch: int) -> bool:
        return not self._commits().filter(F.col("batch") == batch).isEmpty()

    def document_rows(self) -> DataFrame:
        """The log of committed document rows, a row per document and batch."""
        return self._read("documents", _DOC_LOG).join(self._commits(), "batch", "left_semi")

    def _before(self, batch: int, buckets: list[int] | None = None) -> DataFrame:
        """The last row before ``batch`` of each document, of some buckets or all; a bucket is at most a folder a batch."""
        made = self._read("snapshots", _COMMITS).filter(F.col("batch") < batch).agg(F.max("batch")).first()[0]
        start = -1 if made is None else made
        since = self.document_rows().filter((F.col("batch") < batch) & (F.col("batch") > start))
        rows = since.unionByName(self._read("state", _DOC_LOG).filter(F.col("batch") == start))
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin(buckets))
        return rows

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("doc_id", "bucket").agg(F.max_by(F.struct(*KEYS, "tokens", "alive"), "batch").alias("x")).select("doc_id", "bucket", "x.*")

    def compact(self) -> bool:
        """Store the last row of each living document as of the last commit; False if that is done or there is none.

        Totals don't change. A snapshot counts from its record on, which is written last.
        """
        last = self._commits().agg(F.max("batch")).first()[0]
        if last is None or not self._read("snapshots", _COMMITS).filter(F.col("batch") == last).isEmpty():
            return False
        self._replace(self._newest(self._before(last + 1)).filter("alive"), f"{self.folder}/state", last, "bucket")
        self._replace(self.spark.createDataFrame([(True, last)], _COMMITS), f"{self.folder}/snapshots", last)
        return True

    def totals(self) -> DataFrame:
        """source, lang, version, docs, tokens of all committed batches; groups that have nothing left are gone."""
        deltas = self._read("deltas", _DELTAS).join(self._commits(), "batch", "left_semi")
        sums = deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.filter("docs <> 0 or tokens <> 0")

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Applies ``changes`` (doc_id, seq, op, source, lang, version, tokens) once; False if it was committed before.

        ``op`` is insert, revise or delete. An insert of a known document revises it, a
        revision of an unknown one inserts it, a delete of an unknown one does nothing.
        Of a document's changes in one batch the one of largest seq counts; among equals
        a delete, then the largest by version, source, lang and tokens. Null doc_ids
        are left out, null tokens count 0, null source or lang are groups like others.
        Batches come in rising order: a number below the last committed one that wasn't
        committed itself is refused with a ValueError, as later batches have already
        been counted without it.
        """
        if self.is_committed(batch):
            return False
        last = self._commits().agg(F.max("batch")).first()[0]
        if last is not None and batch < last:
            raise ValueError(f"batch {batch} comes after batch {last}")
        value = F.struct("version", "source", "lang", F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))
        order = F.struct(F.coalesce("seq", F.lit(-1)).alias("seq"), (F.col("op") == "delete").alias("gone"), value.alias("value"))
        last = changes.filter("doc_id is not null").groupBy("doc_id").agg(F.max(order).alias("x")).select(
            "doc_id", "x.value.*", (~F.col("x.gone")).alias("alive"), F.lit(batch).cast("long").alias("batch"),
            F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int").alias("bucket"),
        )
        names = [f.split()[0] for f in _DOC_LOG.split(", ")]
        log = f"{self.folder}/documents"
        self._replace(last.select(*names).hint("rebalance", F.col("bucket")), log, batch, "bucket")
        mine = self._read("documents", _DOC_LOG).filter(F.col("batch") == batch)
        # what these documents counted before: their last committed rows, from the buckets that they are in
        touched = [row["bucket"] for row in mine.select("bucket").distinct().collect()]  # as many as buckets
        earlier = self._before(batch, touched).join(mine.select("doc_id"), "doc_id", "left_semi")
        newest = self._newest(earlier)
        signed = newest.filter("alive").select(*KEYS, F.lit(-1).alias("docs"), (-F.col("tokens")).alias("tokens")).unionByName(
            mine.filter("alive").select(*KEYS, F.lit(1).alias("docs"), "tokens")
        )
        sums = signed.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        self._replace(sums.withColumn("batch", F.lit(batch).cast("long")), f"{self.folder}/deltas", batch)
        self._replace(self.spark.createDataFrame([(True, batch)], _COMMITS), f"{self.folder}/commits", batch)
        return True

    def _replace(self, rows: DataFrame, folder: str, batch: int, *by: str) -> None:
        """The batch's own subfolder, whatever a failed attempt left there; ``by`` names folders inside it."""
        writer = rows.drop("batch").write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(f"{folder}/batch={batch}")


def withdrawn_corpus_totals(spark: SparkSession, folder: str, tables: TokenTotals) -> DataFrame:
    """Totals of ``documents`` after three batches.

    Documents come in with an estimate (a token per four UTF-8 bytes), get their counts by
    the byte-level BPE, and those that ``labels`` marks as bad are withdrawn. The second
    batch is sent twice, as after a lost acknowledgement, and counts once; the last one
    meets a snapshot.
    """
    import public_tokenizers

    docs = table(spark, folder, "documents")
    with open(tokenizer_path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    change = lambda rows, op, seq: rows.withColumns({"op": F.lit(op), "seq": F.lit(seq)})
    estimate = docs.select("doc_id", "source", "lang", F.lit("bytes_over_4").alias("version"), F.ceil(F.octet_length(F.coalesce("text", F.lit(""))) / 4).alias("tokens"))
    tables.commit(1, change(estimate, "insert", 0))
    counted = token_counts(docs, ranks, public_tokenizers.PATTERN).withColumn("version", F.lit("byte_bpe_50k"))
    for _ in range(2):
        tables.commit(2, change(counted, "revise", 0))
    tables.compact()
    nothing = {c: F.lit(None).cast("string") for c in KEYS} | {"tokens": F.lit(None).cast("long")}
    bad = table(spark, folder, "labels").filter("quality = 0").select("doc_id").withColumns(nothing)
    tables.commit(3, change(bad, "delete", 0))
    return tables.totals()
