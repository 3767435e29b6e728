"""Chat formatting of reply trees, with DataFrame operations only.

A tree's messages point at the message they answer. Self-joins by pointer doubling
give every message its ancestor 1, 2, 4, ... steps up with the score on the way, so
a path of n messages takes log2(n) joins. Leaves stand for root-to-leaf paths; they
are ranked by the path's score, and the chosen ones are filled with their messages
by the same steps taken downwards in size: each ancestor is met exactly once.

A path becomes one text. Control strings mark turns and never occur inside: a
backslash goes in after the first character of each that a message contains (or
contains with backslashes there), and comes out again when reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.plans.lineage import pin

START, END, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
#: After `<`, `|` and `[`, with any backslashes between: what makes a control string.
_AFTER = r"<(?=\\{n}(?:\||/?s>|</?SYS>>|unk>))|\|(?=\\{n}>)|\[(?=\\{n}/?INST\])"
_ESCAPE = _AFTER.replace("{n}", "*")
_UNESCAPE = "(" + _AFTER.replace("{n}", "+") + r")\\"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1")


def clean_tree(nodes: DataFrame) -> DataFrame:
    """(tree, node, parent, role, text, score): keys as text that keep null apart from all else.

    ``nodes``: tree_id, node_id, parent_id, role, text, score. Rows without a node_id are
    left out; of rows that repeat a node the least by parent, role, text and score stays.
    A parent that the tree doesn't have, or the node itself, makes it a root; null text and
    role are empty, a null score is 0.
    """
    key = lambda name: F.concat(F.lit("="), F.col(name).cast("string"))
    rows = nodes.filter("node_id is not null").select(
        F.coalesce(key("tree_id"), F.lit("null")).alias("tree"), F.col("tree_id"), key("node_id").alias("node"),
        F.struct(
            key("parent_id").alias("parent"), F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        ).alias("row"),
    )
    one = pin(rows.groupBy("tree", "tree_id", "node").agg(F.min("row").alias("row")).select("tree", "tree_id", "node", "row.*"))
    there = one.select(F.col("tree").alias("_tree"), F.col("node").alias("_node"))
    known = one.join(there, (F.col("tree") == F.col("_tree")) & (F.col("parent") == F.col("_node")), "left")
    return pin(known.withColumn("parent", F.when(F.col("_node") != F.col("node"), F.col("_node"))).drop("_tree", "_node"))


def ancestors(nodes: DataFrame) -> list[DataFrame]:
    """Per doubling k, for every node: ``up`` (2**k steps up, null past the root), and the score and length of the way.

    In the last one ``up`` is null for all nodes but those in cycles, which no root reaches.
    """
    state = pin(nodes.select("tree", "node", F.col("parent").alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("length")))
    levels, most = [state], state.count()
    while (1 << (len(levels) - 1)) <= most and not state.filter("up is not null").isEmpty():
        going, done = state.filter("up is not null"), state.filter("up is null")
        there = state.select(F.col("tree").alias("_tree"), F.col("node").alias("_node"), F.col("up").alias("_up"), F.col("total").alias("_total"), F.col("length").alias("_length"))
        further = going.join(there, (F.col("tree") == F.col("_tree")) & (F.col("up") == F.col("_node"))).select(
            "tree", "node", F.col("_up").alias("up"), (F.col("total") + F.col("_total")).alias("total"), (F.col("length") + F.col("_length")).alias("length")
        )
        state = pin(done.unionByName(further))
        levels.append(state)
    return levels


def chosen_paths(nodes: DataFrame, paths_per_tree: int | None = 1) -> DataFrame:
    """(tree, leaf, place, node): the nodes of each chosen path, the root at the least place.

    Paths rank by the sum of their scores, then by leaf; None takes all. Spark drops what
    can't be among the first ones before the shuffle, so a tree may hold most leaves.
    """
    levels = ancestors(nodes)
    parents = nodes.filter("parent is not null").select(F.col("tree").alias("_tree"), F.col("parent").alias("_node")).distinct()
    leaf = (F.col("tree") == F.col("_tree")) & (F.col("node") == F.col("_node"))
    leaves = levels[-1].filter("up is null").join(parents, leaf, "left_anti").select("tree", F.col("node").alias("leaf"), "total")
    if paths_per_tree is not None:
        order = Window.partitionBy("tree").orderBy(F.col("total").desc(), "leaf")
        leaves = leaves.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= paths_per_tree)
    path = pin(leaves.select("tree", "leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("place")))
    for k in reversed(range(len(levels) - 1)):
        hops = levels[k].filter("up is not null").select(F.col("tree").alias("_tree"), F.col("node").alias("_node"), "up")
        higher = path.join(hops, (F.col("tree") == F.col("_tree")) & (F.col("node") == F.col("_node"))).select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("place") - (1 << k)).alias("place")
        )
        path = pin(path.unionByName(higher))
    return path


def format_turns(turns: Column) -> Column:
    """(formatted, loss): the text of an array of (role, text), and the spans of assistant texts in it, by code point."""
    piece = lambda t: F.struct(
        F.concat(F.lit(START), F.regexp_replace(escaped(t["role"]), "\n", LINE), F.lit("\n")).alias("head"),
        escaped(t["text"]).alias("body"), (t["role"] == "assistant").alias("learn"),
    )
    pieces = F.transform(turns, piece)
    tail = END + "\n"
    text = F.array_join(F.transform(pieces, lambda p: F.concat(p["head"], p["body"], F.lit(tail))), "")
    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,stop:int>>)").alias("spans"))

    def step(state: Column, p: Column) -> Column:
        start = state["at"] + F.length(p["head"])
        stop = start + F.length(p["body"])
        span = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        spans = F.when(p["learn"], F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((stop + len(tail)).alias("at"), spans.alias("spans"))

    return F.struct(text.alias("formatted"), F.aggregate(pieces, zero, step, lambda s: s["spans"]).alias("loss"))


def format_paths(nodes: DataFrame, paths_per_tree: int | None = 1) -> DataFrame:
    """(tree_id, leaf, formatted, loss) of each chosen path of ``clean_tree`` nodes.

    A path is one value and so has to fit into one row.
    """
    path = chosen_paths(nodes, paths_per_tree).select(F.col("tree").alias("_tree"), "leaf", F.col("node").alias("_node"), "place")
    rows = nodes.select("tree", "tree_id", "node", "role", "text").join(
        path, (F.col("tree") == F.col("_tree")) & (F.col("node") == F.col("_node"))
    )
    turns = F.array_sort(F.collect_list(F.struct("place", "role", "text")))
    return (
        rows.groupBy("tree", "tree_id", "leaf").agg(turns.alias("turns"))
        .select("tree_id", "leaf", format_turns(F.col("turns")).alias("made")).select("tree_id", "leaf", "made.*")
    )


def parse_turns(formatted: Column) -> Column:
    """The array of (role, text) that a formatted text was made from."""
    parts = F.filter(F.split(formatted, START.replace("|", r"\|")), lambda x: x != "")

    def turn(x: Column) -> Column:
        role = F.substring_index(x, "\n", 1)
        body = F.substring(x, F.length(role) + F.lit(2), F.length(x) - F.length(role) - F.lit(1 + len(END) + 1))
        return F.struct(unescaped(F.regexp_replace(role, LINE.replace("|", r"\|"), "\n")).alias("role"), unescaped(body).alias("text"))

    return F.transform(parts, turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(loss, lambda s: unescaped(F.substring(formatted, s["start"] + F.lit(1), s["stop"] - s["start"]))), ""
    )


def conversation_nodes(rows: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as trees without branches: each row answers the one before it.

    Rows go by turn (null first), then role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = rows.withColumn("node_id", F.row_number().over(order))
    return placed.select(
        F.col("conv_id").alias("tree_id"), "node_id",
        F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"),
    )


def conversation_report(rows: DataFrame) -> DataFrame:
    """Digests of each conversation, read back from its formatted text and loss mask."""
    made = pin(format_paths(clean_tree(conversation_nodes(rows))))
    turns = parse_turns(F.col("formatted"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.withColumn("turns", turns).withColumn("learnt", loss_text(F.col("formatted"), F.col("loss"))).select(
        F.col("tree_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
