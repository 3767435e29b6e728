import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as pb

from larder.llm.sentencepieces import Normaliser, PieceModel, decoded, encode_batch, encoded, encoding_report

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", None, " ", "Hello  world ", "Héllo wörld 😀\x00 x▁y\n\tz", "<s> </s> <0x41>", "ﬁ ①②", "a" * 5000, "漢字かな " * 300, "́start",
]


@pytest.fixture(scope="module")
def model():
    return PieceModel.load(PATH)


def test_report_matches_the_library(make_docs, model):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = {r.doc_id: r for r in encoding_report(make_docs(list(enumerate(TEXTS))), model).collect()}
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == sha(np.array(ids, "<u4").tobytes())
        assert got[i].decoded_sha256 == sha(library.decode(ids).encode())
        assert got[i].covered_bytes == len((t or "").encode())


def test_spans_cover_the_source_in_order(model):
    for t in filter(None, TEXTS):
        made = encode_batch(model, [t])
        raw = t.encode()
        begins, ends = (made[x].to_pylist()[0] for x in ("begins", "ends"))
        assert begins[0] == ends[0] == 0 and begins[-1] == ends[-1] == len(raw)
        assert begins[1:] == ends[:-1]
        for piece, a, b in zip(made["ids"].to_pylist()[0], begins, ends):
            name = model.processor.id_to_piece(piece)
            if not model.processor.is_control(piece) and not model.processor.is_byte(piece):
                # the dummy prefix and escaped spaces aside, a piece is its span
                assert name.replace("▁", " ").strip(" ") == raw[a:b].decode().replace("▁", " ").strip(" ")


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
def test_longest_rule_normalisation_equals_the_library(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    proto = pb.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    own = Normaliser(proto)
    rng = random.Random(rule)
    letters = "aé éﾊﾟﾝ①ﬁ　  Ａß​ İ가각가ẛ̣\n\t▁"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(300)]
    for t in texts:
        normal, source = own(t.encode())
        expected, places = library.normalize(t, with_offsets=True)
        assert normal.decode() == expected, t
        # the library counts in code points of both strings
        at_char = {len(t[:k].encode()): k for k in range(len(t) + 1)}
        starts = np.cumsum([0] + [len(c.encode()) for c in expected])
        if expected:
            assert [at_char[int(source[s])] for s in starts] == places[: len(starts)], t


def test_tables_go_there_and_back(make_docs, model):
    docs = make_docs([(1, "Hello world"), (None, None), (3, "ab\ncd")]).withColumn("ids", F.lit("mine")).withColumn("extra", F.array(F.lit(1)))
    there = encoded(docs, model)
    assert there.columns == ["doc_id", "lang", "source", "n_chars", "extra", "ids", "begins", "ends"]
    back = {r.doc_id: (r.text, r.extra) for r in decoded(there, model).collect()}
    assert back == {1: ("Hello world", [1]), None: ("", [1]), 3: ("ab\ncd", [1])}
    assert encoded(make_docs([]), model).count() == 0
