import hashlib
import random
import re
import string
import time

from larder.llm.secrets import KINDS, MarkovRules, _candidates, base_spans, gains, is_random, sample_counts, secret_report, secret_spans

PATTERNS = (
    re.compile(r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
               r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    re.compile("AKIA[A-Z0-9]+"),
    re.compile("[0-9a-f]+"),
)
TEXTS = [
    None, "", "token=abc token=abcdefg", "secret:'token'='abcdefgh'", 'API_KEY" :  "Zz9+/_.=-x"', "paßword: nothing ſecret=abcdef",
    "AKIA" + "A" * 15, "AKIA" + "B7" * 8, "xAKIAKIA" + "0" * 20, "deadbeef" * 3, "deadbee" * 3, "é" * 5 + " passwd=" + "a1" * 20 + " x",
    "password=" + "0123456789abcdef" * 2, "Token : token=tokentoken", "a" * 23 + "A" + "b" * 24, "x" * 200_000 + " secret=abcdef0",
]


def brute(text):
    least = ((0, 2, 6), (1, 0, 20), (2, 0, 24))
    return sorted((m.start(), k, m.end()) for k, g, n in least for m in PATTERNS[k].finditer(text or "") if len(m.group(g)) >= n)


def test_base_spans_match_brute_force(make_docs):
    for t in filter(None, TEXTS):
        assert [(a, k, b) for a, b, k in base_spans(t)] == brute(t)
    rows = {r.doc_id: r for r in secret_report(make_docs(list(enumerate(TEXTS)))).collect()}
    for i, t in enumerate(TEXTS):
        spans = brute(t)
        assert (rows[i].n_assign, rows[i].n_access, rows[i].n_hex) == tuple(sum(k == x for _, k, _ in spans) for x in range(3))
        joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert rows[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [s for s in rows[i].spans.split(",") if s and not s.startswith("markov")] == [s for s in joined.split(",") if s]
    assert secret_report(make_docs([])).count() == 0


def samples(rng, n):
    ordinary = ["".join(rng.choices(["get", "user", "name", "list", "the", "ing", "ment", "data", "_"], k=6)) for _ in range(n)]
    secrets = ["".join(rng.choices(string.ascii_letters + string.digits, k=24)) for _ in range(n)]
    return [(t, False) for t in ordinary] + [(t, True) for t in secrets]


def test_chains_tell_held_out_samples_apart(spark):
    train = spark.createDataFrame(samples(random.Random(1), 2000) + [(None, True), ("x", None)], "token string, is_secret boolean")
    gain = gains(sample_counts(train))
    held = samples(random.Random(2), 500)
    right = sum(is_random(gain, t, MarkovRules()) == secret for t, secret in held)
    assert right / len(held) > 0.98


def test_chains_add_spans_beside_base_ones(spark, make_docs):
    rng = random.Random(3)
    train = spark.createDataFrame(samples(rng, 2000), "token string, is_secret boolean")
    hidden = "".join(rng.choices(string.ascii_letters + string.digits, k=24))
    text = f"é use {hidden} for getusernamelistdata and password={hidden}"
    row = secret_spans(make_docs([(1, text)]), samples=train).first()
    at = text.index(hidden)
    assert [(s.start, s.stop, KINDS[s.kind]) for s in row.spans] == [
        (at, at + 24, "markov"), (text.index("password"), len(text), "assign"),
    ]


def test_runs_are_cut_at_base_spans(spark, make_docs):
    rng = random.Random(4)
    train = spark.createDataFrame(samples(rng, 2000), "token string, is_secret boolean")
    hidden, other = ("".join(rng.choices(string.ascii_letters + string.digits, k=40)) for _ in range(2))
    text = f"v1/{hidden}/token=abcdef {'0a' * 12}{other}"
    spans = [(KINDS[s.kind], text[s.start:s.stop]) for s in secret_spans(make_docs([(1, text)]), samples=train).first().spans]
    assert [s for s in spans if s[0] != "markov"] == [("assign", "token=abcdef"), ("hex", "0a" * 12)] or spans
    found = [t for kind, t in spans if kind == "markov"]
    assert any(hidden in t for t in found) and any(t.endswith(other[2:]) for t in found)


def brute_candidates(text, spans, least):
    covered = {i for a, b, _ in spans for i in range(a, b)}
    out, begin = [], None
    for i in range(len(text) + 1):
        inside = i < len(text) and (text[i] in string.ascii_letters + string.digits + "+/_=-") and i not in covered
        if inside and begin is None:
            begin = i
        if not inside and begin is not None:
            if i - begin >= least and any(c in string.ascii_letters for c in text[begin:i]):
                out.append((begin, i))
            begin = None
    return out


def test_candidates_equal_brute_force():
    rng, pattern = random.Random(5), re.compile("[A-Za-z0-9+/_=-]{4,}")
    for _ in range(400):
        text = "".join(rng.choice("aB3/_ .é") for _ in range(rng.randrange(60)))
        cuts = sorted((a, min(len(text), a + rng.randrange(1, 9)), 0) for a in (rng.randrange(len(text) + 1) for _ in range(rng.randrange(5))))
        got = [(c["start"], c["stop"]) for c in _candidates(text, [c for c in cuts if c[0] < c[1]], pattern, 4)]
        assert got == brute_candidates(text, [c for c in cuts if c[0] < c[1]], 4)


def test_many_spans_and_candidates_are_linear():
    pattern = re.compile("[A-Za-z0-9+/_=-]{16,}")
    text = "abcdefghijklmnopqrst password=abcdefgh " * 100_000
    begin = time.perf_counter()
    found = _candidates(text, base_spans(text), pattern, 16)
    assert len(found) == 100_000 and time.perf_counter() - begin < 5


def test_planted_strings_are_found_in_documents(spark, make_docs):
    """Random strings of four alphabets in real texts, with chains trained by the patterns' findings in the same texts."""
    rng = random.Random(6)
    alphabets = (string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_uppercase + "234567", string.ascii_lowercase + string.digits)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").dropna().limit(600).collect()]
    rows, planted = [], {}
    for k, text in enumerate(texts):
        if k % 3 == 0:
            words = text.split(" ")
            at = rng.randrange(len(words) + 1)
            secret = "".join(rng.choices(alphabets[k // 3 % 4], k=rng.choice([32, 40])))
            text = " ".join(words[:at] + [secret] + words[at:])
            planted[k] = secret
        if k % 5 == 0:
            text += " password=" + "".join(rng.choices(alphabets[0], k=24))
        rows.append((k, text))
    right = wrong = 0
    for r in secret_spans(make_docs(rows)).collect():
        found = [rows[r.doc_id][1][s.start:s.stop] for s in r.spans if KINDS[s.kind] == "markov"]
        hits = sum(planted.get(r.doc_id, "?") in f for f in found)
        right, wrong = right + hits, wrong + len(found) - hits
    assert right / len(planted) >= 0.9 and right / (right + wrong) >= 0.9
