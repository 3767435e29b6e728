"""Each stage of the pipeline against plain Python that is fed with the same rows."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import combinations

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from larder.llm.common import table
from larder.llm.compression import fit_compression

from test_compression import plain_features
from test_mixing import water_fill

FOLDER = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    """The rows before and after each stage."""
    docs, out = table(spark, FOLDER, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, FOLDER)
        path = str(tmp_path_factory.mktemp("stage") / "rows")
        made.write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs.collect(), after.collect(), after.columns))
        docs = after
    return {name: rest for name, *rest in out}


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def test_columns(spark, chain):
    documents = table(spark, FOLDER, "documents").columns
    assert [name for name, _ in corpus_pipeline.STAGES[:-1]] == [n for n, (_, _, columns) in chain.items() if columns == documents]


def test_quality_classifier(spark, chain):
    before, after, _ = chain["quality classifier"]
    model = fit_compression(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    kept = []
    for r in before:
        f = plain_features(model, r.text)
        terms = [1.0, *f, *[f[i] * f[j] for i in range(4) for j in range(i, 4)]]
        if 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w * t for w, t in zip(model.weights, terms)))))) >= 0.5:
            kept.append(r)
    assert sorted(after) == sorted(kept) and 0 < len(kept) < len(before)
    quality = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    good = [r.doc_id for r in before if quality.get(r.doc_id) == 1]
    assert sum(d in {r.doc_id for r in kept} for d in good) >= 0.9 * len(good)


def test_exact_dedup(chain):
    before, after, _ = chain["exact dedup"]
    groups = defaultdict(list)
    for r in before:
        groups[re.sub("[\x20\x09-\x0d]+", "", r.text or "")].append(r)
    assert sorted(after) == sorted(min(g, key=lambda r: (-len(r.text or ""), r.doc_id)) for g in groups.values())


def test_near_dedup(chain):
    before, after, _ = chain["near dedup"]
    sets = {}
    for r in before:
        low = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in words(r.text)]
        sets[r.doc_id] = {tuple(low[k:k + 5]) for k in range(max(1, len(low) - 4))} if low else set()
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    assert sorted(after) == sorted(r for r in before if root(r.doc_id) == r.doc_id)


def test_mix_sources(chain):
    before, after, _ = chain["mix sources"]
    sizes = Counter()
    for r in before:
        sizes[r.source] += len(words(r.text))
    targets, expected = water_fill(dict(sizes)), Counter()
    for source, target in targets.items():
        rate = round(target / sizes[source], 9) if sizes[source] else 0
        whole, through = math.floor(rate), 0
        budget = target - whole * sizes[source]
        rows = sorted((hashlib.md5(f"{r.doc_id}:{r.text or ''}".encode()).hexdigest()[:12], r.doc_id, len(words(r.text))) for r in before if r.source == source)
        for _, doc, size in rows:
            through += size
            expected[doc] = whole + (rate > whole and through - size / 2 <= budget)
    assert Counter(r.doc_id for r in after) == +expected
    assert set(after) <= set(before) and max(expected.values()) <= 3


def test_encode_pieces(chain):
    before, after, columns = chain["encode pieces"]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = Counter((r.doc_id, tuple(library.encode(r.text or "", add_bos=True, add_eos=True))) for r in before)
    assert Counter((r.doc_id, tuple(r.ids)) for r in after) == expected
    assert all(r.n_tokens == len(r.ids) for r in after) and {"begins", "ends"} <= set(columns)


def test_run_is_the_chain(spark, chain):
    _, after, columns = chain["encode pieces"]
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == columns
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows.collect()) == Counter((r.doc_id, tuple(r.ids)) for r in after)
