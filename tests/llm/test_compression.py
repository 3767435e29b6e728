import math
import random
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from larder.llm.compression import CompressionRules, fit_compression, held_out, keep_good, with_score


def prose(rng, n):
    syllables = ["the", "an", "ing", "er", "on", "re", "st", "ly", "of", "tion"]
    return " ".join("".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def corpus(spark, make_docs):
    rng = random.Random(4)
    rows, marks = [], []
    for i in range(400):
        good = i % 4 != 0
        text = prose(rng, rng.randrange(20, 200))
        rows.append((i, text if good else text.replace(" ", rng.choice(["### ", " | ", "!! "])).upper()))
        marks.append((i, int(good), 0))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    return make_docs(rows), labels


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    model = fit_compression(docs, labels)
    rows = with_score(docs, model).withColumn("held", held_out()).join(labels, "doc_id").collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held]
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_change_nothing(corpus):
    docs, labels = corpus
    flipped = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert fit_compression(docs, flipped) == fit_compression(docs, labels)


def test_odd_rows_and_labels(spark, corpus, make_docs):
    docs, labels = corpus
    odd = spark.createDataFrame([(2, 0, 0), (2, 1, 0), (None, 1, 0), (3, None, None), (999_999, 0, 0)], "doc_id long, quality int, toxic int")
    model = fit_compression(docs, labels.unionByName(odd), CompressionRules(rows_per_class=60))
    rows = make_docs([(1, None), (None, ""), (2, "word " * 200_000), (2, "word " * 200_000)]).withColumn("score", F.lit("own"))
    kept = keep_good(rows, model, least=0.0)
    assert kept.columns == rows.columns and kept.count() == 4
    assert keep_good(make_docs([]), model).count() == 0


def test_without_labels_nothing_is_known(make_docs, corpus):
    docs, labels = corpus
    model = fit_compression(docs, labels.filter("false"))
    assert {r.score for r in with_score(docs, model).collect()} == {0.5}


def plain_features(model, text):
    """The same measures with compressors made anew for each piece, in plain Python."""
    raw = (text or "").encode()
    if not raw:
        return [0.0] * 4
    params = dict(format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)

    def size(piece, dictionary=None):
        extra = {} if dictionary is None else {"dict_data": zstandard.ZstdCompressionDict(dictionary)}
        return len(zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters.from_level(model.level, **params), **extra).compress(piece))

    pieces = [raw[k:k + model.piece_bytes] for k in range(0, len(raw), model.piece_bytes)]
    good, bad, plain = [size(p, model.good) for p in pieces], [size(p, model.bad) for p in pieces], [size(p) for p in pieces]
    diffs = sorted((b - g) / (b + g) for g, b in zip(good, bad))
    place = 0.1 * (len(diffs) - 1)
    low = diffs[int(place)]
    worst = low + (diffs[min(int(place) + 1, len(diffs) - 1)] - low) * (place - int(place))
    g, b = sum(good), sum(bad)
    return [(b - g) / (b + g), worst, sum(plain) / len(raw), min(g, b) / len(raw)]


def test_scores_equal_brute_force(corpus, make_docs):
    docs, labels = corpus
    model = fit_compression(docs, labels)
    rng = random.Random(5)
    texts = [None, "", " ", "x", "é" * 5000, prose(rng, 3000), prose(rng, 30), "A | B ### C !! " * 900]
    got = {r.doc_id: r.score for r in with_score(make_docs(list(enumerate(texts))), model).collect()}
    for k, text in enumerate(texts):
        f = plain_features(model, text)
        terms = [1.0, *f, *[f[i] * f[j] for i in range(4) for j in range(i, 4)]]
        total = max(-30.0, min(30.0, sum(w * t for w, t in zip(model.weights, terms))))
        assert got[k] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)


def test_long_texts_keep_their_verdict(corpus, make_docs):
    """Good texts, and bad ones, joined to up to half a megabyte are still that."""
    docs, labels = corpus
    model = fit_compression(docs, labels)
    rng = random.Random(6)
    rows = [(k, " ".join(prose(rng, 200) for _ in range(n))) for k, n in enumerate((1, 10, 100, 600))]
    rows += [(10 + k, text.replace(" ", "### ").upper()) for k, text in rows]
    assert len(rows[3][1]) > 400_000
    scores = {r.doc_id: r.score for r in with_score(make_docs(rows), model).collect()}
    assert all((scores[k] >= 0.5) == (k < 10) for k, _ in rows)


def test_whole_texts_are_fitted(corpus, spark, make_docs):
    """What lies late in a long labelled text changes the model as what lies early does."""
    docs, labels = corpus
    tail = F.when(F.col("doc_id") % 8 == 0, F.concat(F.repeat("text", 60), F.lit(" zebra zymurgy " * 2000))).otherwise(F.col("text"))
    assert fit_compression(docs.withColumn("text", tail), labels) != fit_compression(docs, labels)
