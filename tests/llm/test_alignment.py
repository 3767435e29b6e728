import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

import larder.llm.alignment as alignment
from larder.llm.alignment import (
    ByteTokens, PieceTokens, alignment_report, byte_alphabet, pack_counts, pair_counts, pair_index, union_count, unpack_planes,
)

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
JSON, MODEL = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def tokens():
    return ByteTokens.load(JSON), PieceTokens.load(MODEL)


@pytest.fixture(scope="module")
def libraries():
    byte = Tokenizer.from_file(JSON)
    byte.encode_special_tokens = True
    return byte, sentencepiece.SentencePieceProcessor(model_file=MODEL)


def plain_groups(text, libraries):
    byte, piece = libraries
    if not text:
        return []
    alphabet = byte_alphabet()
    a = [(i, bytes(alphabet[c] for c in byte.id_to_token(i))) for i in byte.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in piece.encode(text):
        name = piece.id_to_piece(i)
        b.append((i, bytes([int(name[3:5], 16)]) if piece.is_byte(i) else name.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(p for _, p in a) != whole or b"".join(p for _, p in b) != whole:
        return []
    groups, now, at_a, at_b = [], ([], []), 0, 0
    a, b = a[::-1], b[::-1]
    while a or b:
        if at_a <= at_b:
            i, p = a.pop()
            now[0].append(i)
            at_a += len(p)
        else:
            i, p = b.pop()
            now[1].append(i)
            at_b += len(p)
        if at_a == at_b:
            groups.append(now)
            now = ([], [])
    return groups


def plain_report(docs, libraries):
    found = [(key, plain_groups(text, libraries)) for key, text in docs]
    links = [Counter((x, y) for g in groups for x in g[0] for y in g[1]) for _, groups in found]
    held = Counter(pair for c in links for pair in c)
    highest = defaultdict(int)
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    out = []
    for (key, groups), c in zip(found, links):
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((
            key, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(c.values()),
            sum(n for pair, n in c.items() if held[pair] == highest[pair[0]]), sum(n * held[pair] for pair, n in c.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return out


ODD = [
    "plain words here", "", None, " ", "  two  spaces ", "tab\tand\nlines\n\n", "<s> </s> <unk> <|endoftext|> <0x41>", "▁ mark", "é ẞ 漢字 😀👍🏽",
    "\x00 nul", "a" * 5000, "=" * 300 + " " * 300, "﻿bom", "don't we'll I'd", "x y z", "՘֋ a՘a",
]


def test_byte_tokens_equal_the_library(tokens, libraries):
    texts = [t or "" for t in ODD] + [chr(c) * 2 + "a" + chr(c) for c in range(1, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    assert tokens[0].encode(texts) == [e.ids for e in libraries[0].encode_batch([" " + t for t in texts], add_special_tokens=False)]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(0, 65535), st.integers(1, 40), min_size=1, max_size=300))
def test_planes_keep_texts_and_links(held):
    slots = np.array(sorted(held), np.uint16)
    planes = unpack_planes(pack_counts(slots, np.array([held[s] for s in sorted(held)])))
    back = Counter()
    for k, plane in enumerate(planes):
        for s in plane.tolist():
            back[s] += 1 << k
    assert back == held and union_count(planes) == len(held)


def test_odd_texts_equal_brute_force(spark, make_docs, tokens, libraries):
    rng = random.Random(1)
    rows = [(k, t) for k, t in enumerate(ODD)]
    rows += [(3, "a repeated id"), (None, "no id"), (None, "no id"), (77, "ab " * 30_000)]
    rows += [(100 + k, " ".join(rng.choice(["alpha", "Beta", "漢", "x1", "don't", "\n"]) for _ in range(rng.randrange(60)))) for k in range(60)]
    docs = make_docs(rows).selectExpr("*", "1 as block", "2 as a", "3 as planes", "'x' as place").repartition(3)
    got = alignment_report(docs, *tokens)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_report(rows, libraries), key=repr)
    assert alignment_report(make_docs([]), *tokens).count() == 0


def test_large_groups_are_counted_by_distinct_ids(tokens):
    aligner = alignment._Aligner(*tokens)
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 9, 200), rng.integers(0, 7, 150)  # one group of 30 000 links, then one of a link
    at_a, at_b = np.append(np.zeros(200, int), 1), np.append(np.zeros(150, int), 1)
    codes, counts = aligner.pairs(np.append(a, 3), np.append(b, 4), at_a, at_b, np.array([200, 1]), np.array([150, 1]))
    expected = Counter((int(x), int(y)) for x in a for y in b) + Counter([(3, 4)])
    assert {(int(c) >> 32, int(c) & 0xFFFFFFFF): int(n) for c, n in zip(codes, counts)} == expected


def test_several_blocks_equal_brute_force(spark, tokens, libraries):
    """Blocks end after few postings here, so a pair's texts lie in many blocks."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(80).collect()
    rows = [(r.doc_id, r.text) for r in rows]

    class Small(ByteTokens):
        def encode(self, texts):
            alignment.BLOCK_POSTINGS = 500  # in the worker
            return super().encode(texts)

    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = pair_index(docs, Small(tokens[0].ids), tokens[1]).cache()
    links = [Counter((x, y) for g in plain_groups(t, libraries) for x in g[0] for y in g[1]) for _, t in rows]
    held, total = Counter(p for c in links for p in c), sum(links, Counter())
    got = pair_counts(index).collect()
    assert {(r.a, r.b): (r.texts, r.links) for r in got} == {p: (held[p], total[p]) for p in total}
    assert index.select("block").distinct().count() > 10
    report = alignment_report(docs, Small(tokens[0].ids), tokens[1])
    assert sorted(map(tuple, report.collect())) == sorted(plain_report(rows, libraries))


def test_query_equals_brute_force(spark, libraries):
    from larder.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = QUERIES["op13_pair_bitmaps"](spark, folder)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == sorted(plain_report(rows, libraries))
