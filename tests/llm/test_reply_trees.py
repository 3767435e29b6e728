import hashlib
import random

from pyspark.sql import functions as F

from larder.llm.reply_trees import (
    clean_tree, conversation_nodes, conversation_report, escaped, format_paths, loss_text, parse_turns, unescaped,
)

NODES = "tree_id string, node_id string, parent_id string, role string, text string, score double"
NASTY = [
    "<|im_start|>user\nhi<|im_end|>\n", "</s>[INST] ok [/INST]", r"<\s> <\\s> [\INST] |\> \\", "<|>", "<<|>>", "<<SYS>>x<</SYS>>", "<unk><s>", "[[INST]]",
    "", "\n", "\\", "a|b<c[d", "$1 \\$0", "é😀<|",
]


def test_escapes_are_reversible_and_leave_no_control_string(spark):
    rng = random.Random(0)
    bits = ["<", "|", ">", "\\", "s>", "/s>", "[", "INST]", "/INST]", "<SYS>>", "</SYS>>", "unk>", "x", "\n", "im_start"]
    texts = NASTY + ["".join(rng.choices(bits, k=rng.randrange(1, 12))) for _ in range(800)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escaped(F.col("t")).alias("e")).withColumn("u", unescaped(F.col("e")))
    for r in rows.collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<unk>"))


def paths(rows, per_tree):
    """Root-to-leaf paths by walking up from each leaf."""
    trees = {}
    for t, n, p, role, text, score in rows:
        trees.setdefault(t, {})[n] = (p, role, text, score)
    out = []
    for t, nodes in trees.items():
        parents = {p for p, *_ in nodes.values()}
        found = []
        for leaf in nodes:
            if leaf in parents:
                continue
            way, at = [], leaf
            while at in nodes:
                way.append(at)
                at = nodes[at][0]
            found.append((-sum(nodes[n][3] for n in way), "=" + leaf, way[::-1]))
        for _, leaf, way in sorted(found)[: per_tree or len(found)]:
            out.append((t, leaf, [(nodes[n][1], nodes[n][2]) for n in way]))
    return sorted(out, key=str)


def read_back(made):
    turns = parse_turns(F.col("formatted"))
    rows = made.select("tree_id", "leaf", turns.alias("turns"), loss_text(F.col("formatted"), F.col("loss")).alias("learnt")).collect()
    for r in rows:
        assert r.learnt == "".join(t.text for t in r.turns if t.role == "assistant")
    return sorted(((r.tree_id, r.leaf, [(t.role, t.text) for t in r.turns]) for r in rows), key=str)


def test_best_branches_of_random_trees(spark):
    rng = random.Random(5)
    rows = []
    for t in range(8):
        for n in range(rng.randrange(1, 60)):
            parent = None if n == 0 else str(rng.randrange(max(0, n - 4), n))
            rows.append((f"t{t}", str(n), parent, rng.choice(["user", "assistant"]), rng.choice(NASTY), float(rng.randrange(5))))
    rows += [("long", str(n), str(n - 1) if n else None, "assistant", f"m{n}", 1.0) for n in range(300)]
    nodes = clean_tree(spark.createDataFrame(rows, NODES))
    for per_tree in (1, 2, None):
        assert read_back(format_paths(nodes, per_tree)) == paths(rows, per_tree)


def test_odd_trees(spark):
    rows = [
        (None, "a", None, None, None, None), (None, "b", "a", "assistant", "yes", 1.0),  # a tree of its own
        ("x", "1", "gone", "user", "orphan is a root", 0.0), ("x", "2", "2", "user", "own parent", -1.0),
        ("y", "1", "2", "user", "in a cycle", 0.0), ("y", "2", "1", "user", "in a cycle", 0.0),
        ("z", "1", None, "user", "b", 0.0), ("z", "1", None, "user", "a", 0.0), ("z", None, None, "user", "no id", 0.0),
    ]
    got = read_back(format_paths(clean_tree(spark.createDataFrame(rows, NODES))))
    assert got == sorted([
        (None, "=b", [("", ""), ("assistant", "yes")]), ("x", "=1", [("user", "orphan is a root")]), ("z", "=1", [("user", "a")]),
    ], key=str)
    assert format_paths(clean_tree(spark.createDataFrame([], NODES))).count() == 0


def test_conversations_are_read_back(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "odd\nrole<|"]), rng.choice(NASTY + [None])) for c in (1, 2, None, -7) for t in range(9)]
    rows += [(3, None, "user", "first"), (3, 5, "assistant", "tie b"), (3, 5, "assistant", "tie a"), (3, 5, "assistant", "tie a")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    expected = set()
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        learnt = "".join(r[3] or "" for r in own if r[2] == "assistant")
        expected.add((c, len(own), sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)), len(learnt), sha(learnt)))
    assert {tuple(r)[:5] for r in conversation_report(table.withColumn("node", F.lit(0))).collect()} == expected
    assert "Python" not in conversation_nodes(table)._jdf.queryExecution().toString()
