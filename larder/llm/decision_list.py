"""Quality rules learnt as a decision list from the statistics of labelled texts.

Sequential covering: a rule is grown condition by condition on two thirds of the
labelled rows, each condition a threshold on one statistic chosen by information
gain, until it covers no good text; it is pruned from its end on the other third,
kept if it is precise enough there, and what it covers is taken away before the
next rule is grown. The list is a Spark conditional expression, read from the top.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from larder.llm.common import map_texts
from larder.llm.compression import usable_labels
from larder.plans.lineage import pin

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
STATS_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_upper_words long, n_distinct_words long"
)


def _repeated(codes: np.ndarray, top: int) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(codes) < 4:
        return 0
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    if top**3 < 2**63:
        windows = (a * top + b) * top + c
    else:
        windows = np.unique(a * top + b, return_inverse=True)[1] * top + c
    _, back, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[back] > 1
    covered = np.zeros(len(codes), bool)
    for k in range(3):
        covered[k : len(codes) - 2 + k] |= twice
    return int(covered.sum())


def _line_stats(text: str) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return len(lines), len(lines) - len(set(lines))


def _stats(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = pc.fill_null(batch.column("text"), "")
    parts = pc.ascii_split_whitespace(texts)
    offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    coded = parts.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    upper = np.fromiter((w.isupper() for w in words), bool, len(words))
    codes = coded.indices.to_numpy().astype(np.int64)
    out = {name: [] for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words", "n_distinct_words")}
    for text, a, b in zip(texts.to_pylist(), offsets[:-1], offsets[1:]):
        own = codes[a:b]
        own = own[lengths[own] > 0]
        raw = text.encode()
        lines, again = _line_stats(text)
        out["n_words"].append(len(own))
        out["word_chars"].append(int(lengths[own].sum()))
        out["n_symbols"].append(len(raw) - len(raw.translate(None, SYMBOLS)))
        out["n_dup_lines"].append(again)
        out["n_repeat_words"].append(_repeated(own, len(words)))
        out["n_lines"].append(lines)
        out["n_upper_words"].append(int(upper[own].sum()))
        out["n_distinct_words"].append(len(np.unique(own)))
    return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | {k: pa.array(v, pa.int64()) for k, v in out.items()})


def text_stats(docs: DataFrame) -> DataFrame:
    """``STATS_SCHEMA`` of every whole text; null counts as a text without words."""
    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _stats, STATS_SCHEMA)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


#: What rules may speak of: a name and how it is made from the statistics.
_PER_WORD = {"symbols_per_word": "n_symbols", "repeat_share": "n_repeat_words", "upper_share": "n_upper_words", "distinct_share": "n_distinct_words", "word_length": "word_chars"}
FEATURES = ("n_words", *_PER_WORD, "dup_line_share")


def features() -> dict[str, Column]:
    """Each feature as an expression of the statistics; without words or lines a share is 0."""
    share = lambda top, of: F.when(F.col(of) > 0, F.col(top) / F.col(of)).otherwise(0.0)
    shares = {name: share(top, "n_words") for name, top in _PER_WORD.items()}
    return {"n_words": F.col("n_words").cast("double"), **shares, "dup_line_share": share("n_dup_lines", "n_lines")}


@dataclass(frozen=True)
class Condition:
    """``feature`` at most (or at least) ``threshold``."""

    feature: str
    at_most: bool
    threshold: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        x = table[self.feature]
        return x <= self.threshold if self.at_most else x >= self.threshold

    def column(self) -> Column:
        x = features()[self.feature]
        return x <= self.threshold if self.at_most else x >= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'<=' if self.at_most else '>='} {self.threshold:.6g}"


@dataclass(frozen=True)
class ListRules:
    """Bounds of learning: labelled rows of a class that are read, conditions a rule, rules, cut points a feature, precision."""

    rows_per_class: int = 20_000
    most_conditions: int = 4
    most_rules: int = 12
    cuts: int = 64
    precision: float = 0.95
    least_covered: int = 5


def _covered(rule: list[Condition], table: dict[str, np.ndarray]) -> np.ndarray:
    hit = np.ones(len(table["bad"]), bool)
    for condition in rule:
        hit &= condition.holds(table)
    return hit


def _cuts(x: np.ndarray, most: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, most))) if len(x) else x


def _grow(table: dict[str, np.ndarray], rules: ListRules) -> list[Condition]:
    """Adds the condition of the largest information gain until no good row is covered."""
    rule: list[Condition] = []
    hit = np.ones(len(table["bad"]), bool)
    while len(rule) < rules.most_conditions:
        bad, good = int((hit & table["bad"]).sum()), int((hit & ~table["bad"]).sum())
        if not bad or not good:
            break
        before, best = np.log2(bad / (bad + good)), (0.0, None)
        for feature in FEATURES:
            own = table[feature][hit & table["bad"]]
            for threshold in _cuts(own, rules.cuts):
                for at_most in (True, False):
                    condition = Condition(feature, at_most, float(threshold))
                    now = hit & condition.holds(table)
                    p, n = int((now & table["bad"]).sum()), int((now & ~table["bad"]).sum())
                    gain = p * (np.log2(p / (p + n)) - before) if p else 0.0
                    if gain > best[0] + 1e-9:
                        best = (gain, condition)
        if best[1] is None:
            break
        rule.append(best[1])
        hit &= best[1].holds(table)
    return rule


def _prune(rule: list[Condition], table: dict[str, np.ndarray]) -> list[Condition]:
    """The beginning of the rule that does best on rows it was not grown on."""
    def worth(part: list[Condition]) -> float:
        hit = _covered(part, table)
        p, n = int((hit & table["bad"]).sum()), int((hit & ~table["bad"]).sum())
        return (p - n) / (p + n) if p + n else -1.0

    ranked = [(worth(rule[:k]), k) for k in range(1, len(rule) + 1)]
    return rule[: max(ranked, default=(0, 0))[1]]


def learn_list(table: dict[str, np.ndarray], rules: ListRules = ListRules()) -> list[list[Condition]]:
    """Ordered conjunctions for bad rows. ``table``: the features and ``bad``; the order of rows sets the split."""
    found: list[list[Condition]] = []
    left = {k: np.asarray(v) for k, v in table.items()}
    while len(found) < rules.most_rules and left["bad"].sum() >= rules.least_covered:
        third = np.arange(len(left["bad"])) % 3 == 2
        grow, prune = ({k: v[m] for k, v in left.items()} for m in (~third, third))
        rule = _prune(_grow(grow, rules), prune)
        if not rule:
            break
        hit = _covered(rule, left)
        bad = int((hit & left["bad"]).sum())
        # the verdict comes from the pruning rows, or from all when those have none of its kind
        check = prune if _covered(rule, prune).any() else left
        seen = _covered(rule, check)
        if bad < rules.least_covered or check["bad"][seen].mean() < rules.precision:
            break
        found.append(rule)
        left = {k: v[~hit] for k, v in left.items()}
    return found


def list_verdict(found: list[list[Condition]]) -> Column:
    """True for rows that no rule rejects: WHEN conditions THEN false ..., ELSE true."""
    verdict = None
    for rule in found:
        met = rule[0].column()
        for condition in rule[1:]:
            met = met & condition.column()
        verdict = F.when(met, F.lit(False)) if verdict is None else verdict.when(met, F.lit(False))
    return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))


def learn_from(stats: DataFrame, labels: DataFrame, rules: ListRules = ListRules()) -> list[list[Condition]]:
    """The list of a bounded sample of labelled rows that pass the base rules, by least hashed id."""
    marks = usable_labels(labels).withColumn("_draw", F.xxhash64(F.lit(3), "doc_id"))
    rows = (
        stats.filter(~base_failed()).join(marks, "doc_id")
        .select("doc_id", "_draw", "quality", *[x.alias(name) for name, x in features().items()])
    )
    sample = None
    for quality in (0, 1):
        some = rows.filter(F.col("quality") == quality).orderBy("_draw", "doc_id").limit(rules.rows_per_class)
        sample = some if sample is None else sample.unionByName(some)
    local = sample.toPandas().sort_values(["_draw", "doc_id", *FEATURES])
    table = {name: local[name].to_numpy(float) for name in FEATURES} | {"bad": (local.quality == 0).to_numpy(bool)}
    return learn_list(table, rules)


def rule_report(docs: DataFrame, labels: DataFrame, rules: ListRules = ListRules()) -> DataFrame:
    """Statistics of each row of ``docs`` with ``base_failed`` and ``kept``: false if the base rules fail, else the list's verdict.

    Without labels, or with labels of one kind, the list is empty and keeps what the base rules keep.
    """
    stats = pin(text_stats(docs))
    verdict = list_verdict(learn_from(stats, labels, rules))
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict)
