"""Quality by compression: dictionaries of good and of bad text compete for each document.

Two zstandard dictionaries are built from labelled text. A document is cut into
pieces; each is compressed with either dictionary, and the difference of the
sizes, normalised by their sum, says which kind of text it resembles. Pieces keep
the dictionaries in play: over a long text the compressor would learn the text
itself and forget them. The mean difference, that of the text's worst tenth and how
far it compresses at all become a probability by logistic regression on labelled
rows that neither dictionary has seen. None of these grows or falls with the length.

Labels come from a bounded sample of rows (``CompressionRules``), of which whole texts
are read: the calibration measures them with the scoring code in Spark tasks, and the
dictionaries are trained on pieces drawn from all of their pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from larder.llm.common import fresh, slices
from larder.plans.lineage import pin


@dataclass(frozen=True)
class CompressionRules:
    """``rows_per_class`` labelled rows at most are read for fitting.

    Half of them calibrate. A dictionary is trained on ``pieces_per_class`` pieces at most
    of the other half, drawn by hash from all pieces of their whole texts.
    """

    rows_per_class: int = 3000
    pieces_per_class: int = 5000
    dictionary_bytes: int = 110_000
    piece_bytes: int = 2048
    level: int = 3


@dataclass(frozen=True)
class CompressionModel:
    """Two dictionaries and the weights of the calibration."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    piece_bytes: int
    level: int


def held_out(id_name: str = "doc_id"):
    """Rows that labels may not be learnt from: CRC-32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_name).cast("string").cast("binary")) % 3 == 1, F.lit(False))


#: The share of a text's pieces that counts as its worst.
_WORST = 0.1


def cut(raw: bytes, piece_bytes: int) -> list[bytes]:
    """A text's bytes in pieces; the last one may be short."""
    return [raw[at : at + piece_bytes] for at in range(0, len(raw), piece_bytes)]


class _Scales:
    """Measures texts with both dictionaries; one per task."""

    def __init__(self, good: bytes, bad: bytes, piece_bytes: int, level: int):
        self.piece_bytes = piece_bytes
        self.packers = [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(d),
                compression_params=zstandard.ZstdCompressionParameters.from_level(
                    level, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False
                ),
            )
            for d in (good, bad)
        ]
        self.plain = zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters.from_level(
            level, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False
        ))

    def features(self, text: str | None) -> tuple[float, ...]:
        """Normalised difference of all pieces together, of the worst tenth, and the ratios of compression."""
        raw = (text or "").encode()
        good = bad = plain = 0
        diffs = []
        for piece in cut(raw, self.piece_bytes):
            g, b = (len(p.compress(piece)) for p in self.packers)
            good, bad, plain = good + g, bad + b, plain + len(self.plain.compress(piece))
            diffs.append((b - g) / (b + g))
        if not raw:
            return 0.0, 0.0, 0.0, 0.0
        return (bad - good) / (bad + good), float(np.quantile(diffs, _WORST)), plain / len(raw), min(good, bad) / len(raw)


N_FEATURES = 4


def _basis(x: np.ndarray) -> np.ndarray:
    """Features with a constant, squares and products, for the calibration."""
    columns = [np.ones(len(x)), *x.T]
    columns += [x[:, i] * x[:, j] for i in range(N_FEATURES) for j in range(i, N_FEATURES)]
    return np.stack(columns, axis=1)


def _fit_logistic(x: np.ndarray, y: np.ndarray, good_share: float, ridge: float = 1e-4) -> np.ndarray:
    """Weights by Newton's method, the classes weighing as they do among all labels; the columns are scaled inside."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    z, w = x / scale, np.zeros(x.shape[1])
    share = np.where(y == 1, good_share / max(y.sum(), 1), (1 - good_share) / max((1 - y).sum(), 1)) * len(y)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (share * (p - y)) / len(y) + ridge * w
        curve = (z * (share * p * (1 - p))[:, None]).T @ z / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def usable_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, quality) of the rows that may be learnt from; ids with both labels or none give nothing."""
    return (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_most")).filter("quality = _most").drop("_most")
    )


def labelled_sample(docs: DataFrame, marks: DataFrame, rules: CompressionRules = CompressionRules()) -> DataFrame:
    """(quality, half, text): at most ``rows_per_class`` rows of each class of ``marks``.

    The rows with the least hashed ids are taken, half for the dictionaries and half for
    the calibration. Rows without a text give nothing.
    """
    marks, rows = marks.withColumn("_draw", F.xxhash64(F.lit(11), "doc_id")), None
    for quality in (0, 1):
        some = marks.filter(F.col("quality") == quality).orderBy("_draw", "doc_id").limit(rules.rows_per_class)
        rows = some if rows is None else rows.unionByName(some)
    return docs.select("doc_id", "text").join(F.broadcast(pin(rows)), "doc_id").filter(F.length("text") > 0).select(
        "quality", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(2)).alias("half"), "text", "doc_id"
    )


def _drawn_pieces(sample: DataFrame, quality: int, rules: CompressionRules) -> list[bytes]:
    """At most ``pieces_per_class`` pieces of a class's whole texts, those of least hash, in that order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                pieces = [
                    (xxhash.xxh64_intdigest(f"{doc}:{k}") >> 1, piece)
                    for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())
                    for k, piece in enumerate(cut(text.encode(), rules.piece_bytes))
                ]
                yield pa.RecordBatch.from_pydict({
                    "draw": pa.array([d for d, _ in pieces], pa.int64()), "piece": pa.array([p for _, p in pieces], pa.binary()),
                })

    texts = sample.filter((F.col("quality") == quality) & (F.col("half") == 0)).select("doc_id", "text")
    best = texts.mapInArrow(run, "draw long, piece binary").orderBy("draw", "piece").limit(rules.pieces_per_class)
    return [bytes(row["piece"]) for row in best.collect()]


def _measured(sample: DataFrame, good: bytes, bad: bytes, rules: CompressionRules) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the calibration's rows, measured on whole texts in Spark tasks."""
    shared = sample.sparkSession.sparkContext.broadcast((good, bad, rules.piece_bytes, rules.level))
    names = [f"f{k}" for k in range(N_FEATURES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scales = _Scales(*shared.value)
        for batch in batches:
            for part in slices(batch):
                x = np.array([scales.features(t) for t in part.column("text").to_pylist()], float).reshape(-1, N_FEATURES)
                yield pa.RecordBatch.from_arrays([part.column("quality").cast(pa.int64()), *map(pa.array, x.T)], names=["quality", *names])

    rows = sample.filter("half = 1").select("quality", "text").mapInArrow(run, "quality long, " + ", ".join(f"{n} double" for n in names))
    found = sorted(map(tuple, rows.collect()))
    return np.array([r[1:] for r in found], float).reshape(-1, N_FEATURES), np.array([r[0] for r in found], float)


def _dictionaries(good: list[bytes], bad: list[bytes], size: int) -> tuple[bytes, bytes]:
    """A trained dictionary of each class, or, where either has too little text to train on, the pieces themselves."""
    samples = [good, bad]
    try:
        return tuple(
            zstandard.train_dictionary(max(1024, min(size, sum(map(len, x)) // 8)), x).as_bytes() for x in samples
        )
    except zstandard.ZstdError:
        return tuple(b"".join(x)[:size].ljust(8, b" ") for x in samples)


def fit_compression(docs: DataFrame, labels: DataFrame, rules: CompressionRules = CompressionRules()) -> CompressionModel:
    """The model of a bounded sample; with one class or none every score is one half or near."""
    marks = pin(usable_labels(labels))
    good_share = marks.agg(F.avg("quality")).first()[0]
    sample = pin(labelled_sample(docs, marks, rules))
    good, bad = _dictionaries(*(_drawn_pieces(sample, quality, rules) for quality in (1, 0)), rules.dictionary_bytes)
    x, y = _measured(sample, good, bad, rules)
    weights = _fit_logistic(_basis(x), y, good_share) if len(set(y)) == 2 else np.zeros(_basis(np.zeros((1, N_FEATURES))).shape[1])
    return CompressionModel(good, bad, tuple(map(float, weights)), rules.piece_bytes, rules.level)


def scores(model: CompressionModel, batch: pa.RecordBatch, scales: _Scales) -> np.ndarray:
    x = np.array([scales.features(t) for t in batch.column("text").to_pylist()], float).reshape(-1, N_FEATURES)
    return 1 / (1 + np.exp(-np.clip(_basis(x) @ np.array(model.weights), -30, 30)))


def with_score(docs: DataFrame, model: CompressionModel, name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for each whole text; null and empty texts get the score of no text.

    Repeated rows are scored each, equal texts alike. Other columns stay as they are;
    ``name`` must be a new one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.withColumn(name, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        scales = _Scales(m.good, m.bad, m.piece_bytes, m.level)
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores(m, part, scales))], names=[*part.schema.names, name])

    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: CompressionModel, least: float = 0.5) -> DataFrame:
    """``docs`` whose score is at least ``least``; columns as they came."""
    score = fresh(docs.columns, "score")
    return with_score(docs, model, score).filter(F.col(f"`{score}`") >= least).drop(score)
