"""Secrets in texts: patterns, and character Markov models for what patterns miss.

Two first-order Markov chains over the characters of identifiers, one of random
strings and one of ordinary words, are trained from labelled samples. A run of
identifier characters is a secret when the random chain explains it so much better
that it outweighs how rare secrets are. In a corpus without other labels, the
values that the patterns find are the samples of random strings and all text
outside them is ordinary, but for the candidates that are to be judged; both are
counted over all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larder.llm.common import map_texts
from larder.plans.lineage import pin

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
_LETTER = re.compile("[A-Za-z]")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "markov")

#: Characters of identifiers; any other character is a boundary.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
STATES = len(ALPHABET) + 1
_STATE = np.zeros(256, np.int64)
for _i, _c in enumerate(ALPHABET):
    _STATE[ord(_c)] = _i + 1


@dataclass(frozen=True)
class MarkovRules:
    """``least_chars`` of a candidate, log prior odds it must outweigh, mean gain per character, smoothing."""

    least_chars: int = 16
    prior_odds: float = 1e-7
    mean_gain: float = 1.0
    smoothing: float = 1.0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the patterns' matches, leftmost and without overlap within a kind, sorted.

    A match that is too short is dropped, but what it covers stays used.
    """
    found = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def _values(text: str, spans: list[tuple[int, int, int]]) -> list[str]:
    """The random strings that the patterns found: of assignments, the value alone."""
    return [ASSIGN.match(text, a, b).group(2) if kind == 0 else text[a:b] for a, b, kind in spans]


def pair_counts(raw: bytes) -> np.ndarray:
    """Counts of neighbouring states, STATES squared; text begins and ends with a boundary."""
    states = _STATE[np.frombuffer(b" " + raw + b" ", np.uint8)]
    return np.bincount(states[:-1] * STATES + states[1:], minlength=STATES * STATES)


SCAN_SCHEMA = (
    "doc_id long, base array<struct<start:int,stop:int,kind:int>>, "
    "maybe array<struct<start:int,stop:int,token:string>>, counts binary"
)


def _disjoint(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What sorted spans cover, as spans apart from each other."""
    out: list[tuple[int, int]] = []
    for a, b, _ in spans:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _candidates(text: str, spans: list[tuple[int, int, int]], pattern: re.Pattern, least: int) -> list[dict]:
    """Runs of identifier characters with a letter, cut where base spans lie; linear in runs and spans together."""
    out, covered, at = [], _disjoint(spans), 0
    for m in pattern.finditer(text):
        begin, end = m.span()
        while at < len(covered) and covered[at][1] <= begin:
            at += 1
        while begin < end:
            # the next free piece; a span that goes on beyond the run stays the next one
            stop = min(end, covered[at][0]) if at < len(covered) else end
            if stop - begin >= least and _LETTER.search(text, begin, stop):
                out.append({"start": begin, "stop": stop, "token": text[begin:stop]})
            if at == len(covered) or covered[at][0] >= end:
                break
            begin = max(begin, covered[at][1])
            if covered[at][1] <= end:
                at += 1
    return out


def _scan(rules: MarkovRules, batch: pa.RecordBatch) -> pa.RecordBatch:
    pattern = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % rules.least_chars)
    texts = [t or "" for t in batch.column("text").to_pylist()]
    base, maybe, random = [], [], []
    for t in texts:
        spans = base_spans(t)
        base.append([{"start": a, "stop": b, "kind": k} for a, b, k in spans])
        maybe.append(_candidates(t, spans, pattern, rules.least_chars))
        random += _values(t, spans)
    found = pair_counts(" ".join(random).encode())
    open_ = pair_counts(" ".join(c["token"] for some in maybe for c in some).encode())
    every = pair_counts(" ".join(texts).encode())
    # the first row of a slice carries the slice's counts: of random strings, and of what is neither that nor a candidate
    counts = [np.stack([found, np.maximum(every - found - open_, 0)]).astype("<i8").tobytes()] + [None] * (len(texts) - 1)
    return pa.RecordBatch.from_pydict({
        "doc_id": batch.column("doc_id"),
        "base": pa.array(base, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.int32())]))),
        "maybe": pa.array(maybe, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("token", pa.string())]))),
        "counts": pa.array(counts, pa.binary()),
    })


def scan(docs: DataFrame, rules: MarkovRules = MarkovRules()) -> DataFrame:
    """One pass over all texts: base spans, candidates and the counts that train the chains."""
    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), partial(_scan, rules), SCAN_SCHEMA)


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(2 * STATES * STATES, np.int64)
    for batch in batches:
        for raw in batch.column("counts").to_pylist():
            if raw is not None:
                total += np.frombuffer(raw, "<i8")
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"place": pa.array(at), "n": pa.array(total[at])})


def _totals(rows: DataFrame) -> np.ndarray:
    """(2, STATES, STATES) counts over all rows; the driver gets one number for each cell."""
    out = np.zeros(2 * STATES * STATES, np.int64)
    sums = rows.groupBy("place").agg(F.sum("n").alias("n"))
    for place, n in sums.collect():
        out[place] = n
    return out.reshape(2, STATES, STATES)


def corpus_counts(scanned: DataFrame) -> np.ndarray:
    return _totals(scanned.select("counts").filter("counts is not null").mapInArrow(_sum_counts, "place long, n long"))


def sample_counts(samples: DataFrame) -> np.ndarray:
    """Counts from labelled samples (token, is_secret) for ``gains``; null tokens or labels count for nothing."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros((2, STATES * STATES), np.int64)
            for token, secret in zip(*(batch.column(x).to_pylist() for x in ("token", "is_secret"))):
                total[0 if secret else 1] += pair_counts(token.encode())
            flat = total.ravel()
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_pydict({"place": pa.array(at), "n": pa.array(flat[at])})

    usable = samples.select("token", F.col("is_secret").cast("boolean").alias("is_secret")).dropna()
    return _totals(usable.mapInArrow(count, "place long, n long"))


def gains(counts: np.ndarray, rules: MarkovRules = MarkovRules()) -> np.ndarray:
    """Log-likelihood ratio of random to ordinary for each pair of states.

    Where pairs are rare the chains fall back: the ordinary one to how often the second
    character occurs at all, the random one to any character, so that random strings of
    other alphabets than the samples' still look random.
    """
    any_ = np.full(STATES, 1 / STATES)
    common = counts[1].sum(axis=0) + rules.smoothing
    back = np.stack([any_, common / common.sum()])[:, None, :]
    weight = rules.smoothing * STATES
    chance = np.log((counts + weight * back) / (counts.sum(axis=2, keepdims=True) + weight))
    return chance[0] - chance[1]


def token_gain(gain: np.ndarray, token: str) -> float:
    """How much better the random chain explains a token, its first character included, its end not."""
    states = _STATE[np.frombuffer(b" " + token.encode("ascii"), np.uint8)]
    return float(gain[states[:-1], states[1:]].sum())


def is_random(gain: np.ndarray, token: str, rules: MarkovRules) -> bool:
    total = token_gain(gain, token)
    return total >= -np.log(rules.prior_odds) and total >= rules.mean_gain * len(token)


SPANS_SCHEMA = "doc_id long, spans array<struct<start:int,stop:int,kind:int>>"


def _judge(gain: np.ndarray, rules: MarkovRules, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for base, maybe in zip(batch.column("base").to_pylist(), batch.column("maybe").to_pylist()):
            more = [{"start": c["start"], "stop": c["stop"], "kind": 3} for c in maybe if is_random(gain, c["token"], rules)]
            out.append(sorted(base + more, key=lambda s: (s["start"], s["kind"])))
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.int32())]))
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "spans": pa.array(out, kind)})


def secret_spans(docs: DataFrame, rules: MarkovRules = MarkovRules(), samples: DataFrame | None = None) -> DataFrame:
    """(doc_id, spans) per row of ``docs``: start and stop in code points, and the place of the kind in ``KINDS``.

    The chains are trained from ``samples`` if given, else from the patterns' findings and
    the ordinary text of all documents. Null and empty texts have no spans; base spans stay as they are, and spans
    of the chains never overlap them: a run is cut at base spans, and each piece that is
    long enough is judged by itself. Runs of any length are judged whole, in time linear
    in the text. Other columns aren't looked at.
    """
    scanned = pin(scan(docs, rules))
    gain = gains(corpus_counts(scanned) if samples is None else sample_counts(samples), rules)
    return scanned.select("doc_id", "base", "maybe").mapInArrow(partial(_judge, gain, rules), SPANS_SCHEMA)


def _joined(spans):
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))
    return F.concat_ws(",", F.transform(spans, text))


def secret_report(docs: DataFrame, rules: MarkovRules = MarkovRules()) -> DataFrame:
    """Per row: counts of the base kinds, the hash of their spans and all spans as text."""
    found = pin(secret_spans(docs, rules))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined("spans").alias("spans"),
    )
