"""What the operators share: word rules, document columns, batches bounded by bytes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Text bytes that a Python worker handles at a time (one longer text goes alone).
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(name: str = "text") -> Column:
    """Words of a text as long; null has none."""
    return F.coalesce(F.regexp_count(F.col(name), F.lit(WORD)), F.lit(0)).cast("long")


def fresh(taken: list[str], name: str) -> str:
    """``name``, with underscores added until no column is called so."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name += "_"
    return name


def give_back() -> None:
    """Return memory that is no longer used to the system: a worker outlives its tasks, and several wait beside those at work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, *columns: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts (``columns``, or ``text``) hold at most ``most`` bytes, or of one row."""
    lengths = [pc.fill_null(pc.binary_length(batch.column(c)), 0) for c in columns or ("text",)]
    sizes = [sum(x) for x in zip(*(n.to_pylist() for n in lengths))]
    begin = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield batch.slice(begin)


def map_texts(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, *columns: str) -> DataFrame:
    """``work`` on slices of the rows by their texts in ``columns`` (or ``text``), in Arrow, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, *columns):
                yield work(part)
        give_back()

    return df.mapInArrow(run, schema)


#: Bits of an id bitmap at most, as a power of two: 2**18 rows, a few MB when broadcast.
MOST_BITMAP_BITS = 24


def _bit(id_: Column, bits: int) -> tuple[Column, Column]:
    place = F.shiftrightunsigned(F.xxhash64(id_), 64 - bits)
    return F.shiftright(place, 6), place.bitwiseAND(F.lit(63)).cast("int")


def marked(rows: DataFrame, id_: Column, ids: DataFrame, name: str) -> DataFrame:
    """``rows`` with a boolean that is true for all ids in ``ids`` (one column) and for few others.

    A semi-join's first sieve that doesn't shuffle the rows. The bitmap of hashed ids
    has at most ``MOST_BITMAP_BITS`` bits however many ids there are, which bounds the
    broadcast; when it is full, more rows are true, never fewer.
    """
    count = ids.count()
    bits = min(MOST_BITMAP_BITS, max(10, (16 * count).bit_length()))
    word, place = _bit(F.col(ids.columns[0]), bits)
    words = ids.select(word.alias("_word"), F.lit(1).cast("long").alias("_one"), place.alias("_place")).select(
        "_word", F.expr("shiftleft(_one, _place)").alias("_mask")
    ).groupBy("_word").agg(F.bit_or("_mask").alias("_mask"))
    word, place = _bit(id_, bits)
    keyed = rows.withColumns({"_at": word, "_place": place})
    hit = F.coalesce(F.expr("getbit(_mask, _place)") == 1, F.lit(False))
    return (
        keyed.join(F.broadcast(words), keyed["_at"] == words["_word"], "left")
        .withColumn(name, hit)
        .drop("_at", "_place", "_word", "_mask")
    )


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)
