"""Repair of conversation structure by the cheapest edits, ties by prefix-doubling path ranking.

Rows of a conversation, in order, are read by an automaton of four states: nothing yet,
after a system, a user and an assistant row. A node is a place between rows and a state,
an arc an edit: Keep, Rerole or Delete of the next row, or Insert of a row.

1. Rows are sorted over range partitions and numbered; a slice is a run of a bounded
   number of them, a segment the part of a conversation that lies in one slice.
   So a conversation of any length is many bounded pieces of work.
2. Cost DP: an edit matrix per row, min-plus products by doubling within a segment, and
   one product per segment chained along a conversation.
3. Path ranking: arcs on cheapest paths only. Nodes are ranked by their least audits of
   1, 2, 4, ... edits: the rank for twice a length comes from the node's own rank and the
   rank of the node that its pointer reaches; pointers double along. Each node then takes
   the arc of least letter and rank, and the doubled pointers unroll the least path.
   Edits out of one node have different letters, so audits of one node part at a letter
   and nodes of different segments need no common order.
4. The paths of a conversation's segments are chained by their states.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from larder.plans.lineage import pin

#: Most rows of a slice, as a power of two.
SLICE_BITS = 16

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an inserted or reroled row leads to, from each state.
NEXT = np.array([USER, USER, ASSISTANT, USER])
#: States that keeping a row of a state's role leads from.
KEPT_FROM = {SYSTEM: (START,), USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
#: Cost of the inserts that end a conversation properly, from each state.
ENDING = np.array([0, 10, 5, 0])
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4  # in the order of their initials
LETTERS = " DIKR"
COSTS = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
TRUNCATED_COST = 5
ROLES = " sua"
FULL_ROLES = {"u": "user", "a": "assistant"}
_FAR = 1 << 40

FINE, CUT_OFF, REMOVE = range(3)


# Damage and faults -----------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults by crc32 of ``conv_id:turn``; nulls are one space."""
    blank = F.lit(" ")
    spot = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    return (
        rows.select(
            "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), blank).alias("role"),
            F.coalesce("text", blank).alias("text"), (F.crc32(spot) % 20).alias("fault"),
        )
        .filter("fault <> 0")
        .select(
            "conv_id", "turn",
            F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"),
        )
        .drop("again")
    )


def in_order(rows: DataFrame) -> DataFrame:
    """``rows`` with ``same``, a digest of role and text, and ``seq``, which grows with conv_id, turn (nulls first) and ``same``."""
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    copies = pin(rows.withColumns({"same": F.unhex(same), "copy": F.monotonically_increasing_id()}))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("same"), F.col("copy")]
    return pin(
        copies.repartitionByRange(*order).sortWithinPartitions(*order).drop("copy").withColumn("seq", F.monotonically_increasing_id())
    )


def _state_of(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(START)


def faults(ordered: DataFrame, slice_bits: int = SLICE_BITS) -> DataFrame:
    """Narrow rows: conv_id, seq, slice, state (of the role) and fault: blank, duplicate, truncated or null."""
    trimmed = F.rtrim("text", F.lit(" \t\n\x0b\f\r"))
    first = ordered.select("conv_id", "same", "seq").groupBy("conv_id", "same").agg(F.min("seq").alias("first"))
    seen = F.col("first").isNull()
    rows = ordered.select(
        "conv_id", "seq", _state_of(F.col("role")).alias("state"), (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    marked = rows.join(first.select("first"), F.col("seq") == F.col("first"), "left")
    return marked.select(
        "conv_id", "seq", F.shiftright("seq", slice_bits).alias("slice"), "state",
        F.when(F.col("blank"), "blank").when(seen, "duplicate").when(F.col("cut"), "truncated").alias("fault"),
    )


# Cost DP ---------------------------------------------------------------------------

def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus products of stacks of 4 x 4 matrices."""
    return np.minimum((a[:, :, :, None] + b[:, None, :, :]).min(axis=2), _FAR)


def _inserts() -> np.ndarray:
    """Cheapest inserts from each state to each."""
    cost = np.full((4, 4), _FAR)
    for state in range(4):
        at, paid = state, 0
        for _ in range(3):
            cost[state, at] = min(cost[state, at], paid)
            at, paid = NEXT[at], paid + COSTS[INSERT]
    return cost


def _edit_costs(state: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cost and target state of Delete, Keep and Rerole (by letter) at each row and state; ``_FAR`` if not allowed."""
    n = len(state)
    cost, target = np.full((n, 4, 5), _FAR), np.zeros((n, 4, 5), np.int64)
    extra = np.where(kind == CUT_OFF, TRUNCATED_COST, 0)
    stays = kind != REMOVE
    for q in range(4):
        cost[:, q, DELETE], target[:, q, DELETE] = COSTS[DELETE], q
        cost[:, q, REROLE], target[:, q, REROLE] = np.where(stays, COSTS[REROLE] + extra, _FAR), NEXT[q]
        fits = stays & np.isin(state, [role for role, before in KEPT_FROM.items() if q in before])
        cost[:, q, KEEP], target[:, q, KEEP] = np.where(fits, COSTS[KEEP] + extra, _FAR), state
    return cost, target


def _suffix_products(cost: np.ndarray, target: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each row the min-plus product of its edits and those of all later rows of its segment."""
    n = len(cost)
    step = np.full((n, 4, 4), _FAR)
    for letter in (DELETE, KEEP, REROLE):
        for q in range(4):
            at = (np.arange(n), q, target[:, q, letter])
            step[at] = np.minimum(step[at], cost[:, q, letter])
    total = _product(np.broadcast_to(_inserts(), step.shape), step) if n else step
    reach, place = 1, np.arange(n)
    while True:
        more = np.flatnonzero(place + reach < ends)
        if not len(more):
            return total
        total[more] = _product(total[more], total[more + reach])
        reach *= 2


class _Slice:
    """The rows of a slice in order, cut into segments."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("seq").combine_chunks()
        self.conv, self.seq = rows["conv_id"].combine_chunks(), rows["seq"].to_numpy()
        self.state = rows["state"].to_numpy().astype(np.int64)
        fault = rows["fault"].to_pylist()
        self.fault = np.array([x or "" for x in fault])
        self.kind = np.array([{"": FINE, "truncated": CUT_OFF}.get(x, REMOVE) for x in self.fault])
        a, b = self.conv[1:], self.conv[:-1]
        apart = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.not_equal(pc.is_null(a), pc.is_null(b)))
        self.starts = np.concatenate([[0], np.flatnonzero(apart.to_numpy(zero_copy_only=False)) + 1])
        self.stops = np.append(self.starts[1:], len(self.seq))
        self.segment = np.repeat(np.arange(len(self.starts)), self.stops - self.starts)
        self.cost, self.target = _edit_costs(self.state, self.kind)
        self.products = _suffix_products(self.cost, self.target, self.stops[self.segment])


def _segments(rows: pa.Table) -> pa.Table:
    """What a conversation's summary needs of each segment."""
    cut = _Slice(rows)
    state, starts = cut.state, cut.starts
    legal = np.isin(state[:-1] * 4 + state[1:], [SYSTEM * 4 + USER, USER * 4 + ASSISTANT, ASSISTANT * 4 + USER])
    illegal = np.append(~legal & (cut.segment[:-1] == cut.segment[1:]), False)
    count = lambda mask: pa.array(np.add.reduceat(mask.astype(np.int64), starts))
    return pa.table({
        "conv_id": cut.conv.take(pa.array(starts)), "segment": pa.array(cut.seq[starts]), "slice": rows["slice"].combine_chunks().take(pa.array(starts)),
        "product": pa.array(list(cut.products[starts].reshape(len(starts), 16)), pa.list_(pa.int64())),
        "first": pa.array(state[starts]), "last": pa.array(state[cut.stops - 1]), "illegal": count(illegal),
        **{name: count(cut.fault == name) for name in ("blank", "duplicate", "truncated")},
    })


def _ends(rows: pa.Table) -> pa.Table:
    """Cost to go at the end of each segment of one conversation, from its last one backwards."""
    rows = rows.sort_by([("segment", "descending")])
    cost, ends = ENDING, []
    for product in rows["product"].to_pylist():
        ends.append(cost)
        cost = np.minimum((np.array(product).reshape(4, 4) + cost).min(axis=1), _FAR)
    return rows.select(["segment", "slice"]).append_column("ends", pa.array([list(map(int, x)) for x in ends], pa.list_(pa.int64())))


# Path ranking ----------------------------------------------------------------------

def _dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1]


def rank_paths(letters: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each node's arc on its least path, and pointers 1, 2, 4, ... edits along it.

    ``letters`` (nodes x arcs) are 0 for no arc; letters of one node differ. Nodes
    without arcs end a path and point to themselves. There are no cycles.
    """
    nodes = np.arange(len(letters))
    none = len(LETTERS)
    least = np.where(letters > 0, letters, none).argmin(axis=1)
    ended = ~(letters > 0).any(axis=1)
    pointer = np.where(ended, nodes, targets[nodes, least])
    rank = np.where(ended, 0, letters[nodes, least])  # of audits of one edit
    while not ended[pointer].all():
        rank = _dense(rank * (rank.max() + 1) + rank[pointer])
        pointer = pointer[pointer]
    # of all audits now; an arc's audit is its letter before its target's audit
    order = np.where(letters > 0, letters, none) * (rank.max() + 1) + rank[targets]
    arc = order.argmin(axis=1)
    pointers = [np.where(ended, nodes, targets[nodes, arc])]
    while not ended[pointers[-1]].all():
        pointers.append(pointers[-1][pointers[-1]])
    return np.where(ended, 0, letters[nodes, arc]), pointers


def _paths(rows: pa.Table, ends: pa.Table) -> pa.Table:
    """The least path through each segment, by the state it is entered with.

    A row of the slice has its edits (``K``, ``D``, ``Ru``, ``Iu``, ...) after inserts; a
    segment, without seq, its cost to go and the state it is left with.
    """
    cut = _Slice(rows)
    at_end = {s: (x, first) for s, x, first in zip(*(ends[c].to_pylist() for c in ("segment", "ends", "is_first")))}
    known = [at_end[int(x)] for x in cut.seq[cut.starts]]
    end_cost = np.array([x for x, _ in known]).reshape(-1, 4)
    n, seg = len(cut.seq), cut.segment
    to_go = np.minimum((cut.products + end_cost[seg][:, None, :]).min(axis=2), _FAR)
    # nodes: 4 a row, then 4 a segment, where it ends
    cost_to_go = np.concatenate([to_go.ravel(), end_cost.ravel()])
    after = np.where(np.arange(n) + 1 < cut.stops[seg], 4 * (np.arange(n) + 1), 4 * n + 4 * seg)
    total = len(cost_to_go)
    letters, targets = np.zeros((total, 4), np.int64), np.zeros((total, 4), np.int64)
    here = np.arange(4 * n)
    state = here % 4
    for letter in (DELETE, KEEP, REROLE):
        goal = np.repeat(after, 4) + cut.target[:, :, letter].ravel()
        ok = cut.cost[:, :, letter].ravel() + cost_to_go[goal] == cost_to_go[here]
        letters[here, letter - 1], targets[here, letter - 1] = np.where(ok, letter, 0), goal
    goal = here - state + NEXT[state]
    ok = COSTS[INSERT] + cost_to_go[goal] == cost_to_go[here]
    letters[here, INSERT - 1], targets[here, INSERT - 1] = np.where(ok, INSERT, 0), goal
    letters[:4 * n][cost_to_go[:4 * n] >= _FAR] = 0
    taken, pointers = rank_paths(letters, targets)

    entries = [(k, q) for k, (_, first) in enumerate(known) for q in ((START,) if first else range(4))]
    path = np.arange(len(entries))
    roots = node = np.array([4 * cut.starts[k] + q for k, q in entries], np.int64)
    place = np.zeros(len(entries), np.int64)
    for k, pointer in enumerate(pointers):  # places 0 .. 2^k - 1 give those up to 2^(k+1) - 1
        far = pointer[node]
        on = far < 4 * n
        path, place, node = (np.concatenate([x, y[on]]) for x, y in ((path, path), (place, place + (1 << k)), (node, far)))
    order = np.lexsort((place, path))
    path, node = path[order], node[order]
    goal = pointers[0][node] % 4
    tokens = [LETTERS[x] + (ROLES[g] if x in (INSERT, REROLE) else "") for x, g in zip(taken[node].tolist(), goal.tolist())]
    row = node // 4
    new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (path[1:] != path[:-1]))) if len(node) else np.zeros(0, np.int64)
    edits = ["".join(tokens[a:b]) for a, b in zip(new.tolist(), np.append(new[1:], len(node)).tolist())]
    of_segment = np.array([k for k, _ in entries], np.int64)
    entered = np.array([q for _, q in entries], np.int64)
    segment = cut.seq[cut.starts][of_segment]
    left = pointers[-1][roots] % 4
    both = lambda x, y, kind: pa.concat_arrays([pa.array(x, kind), pa.array(y, kind)])
    return pa.table({
        "segment": both(segment[path[new]], segment, pa.int64()), "entered": both(entered[path[new]], entered, pa.int64()),
        "seq": both(cut.seq[row[new]], [None] * len(entries), pa.int64()), "edits": both(edits, [None] * len(entries), pa.string()),
        "leaves": both([None] * len(new), left, pa.int64()), "cost": both([None] * len(new), cost_to_go[roots], pa.int64()),
    })


def _chain(rows: pa.Table) -> pa.Table:
    """The state that each segment of one conversation is entered with."""
    leaves = {(s, q): x for s, q, x in zip(*(rows[c].to_pylist() for c in ("segment", "entered", "leaves")))}
    state, chosen = START, []
    for segment in sorted({s for s, _ in leaves}):
        chosen.append((segment, state))
        state = leaves[segment, state]
    return pa.table({"segment": pa.array([s for s, _ in chosen], pa.int64()), "entered": pa.array([q for _, q in chosen], pa.int64())})


# Repaired conversations ------------------------------------------------------------

class _Repaired:
    """The audit and the digest of a conversation whose rows come one by one."""

    def __init__(self):
        self.audit, self.digest, self.lines, self.state = [], hashlib.sha256(), 0, START

    def line(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
        self.lines += 1

    def row(self, role: str, text: str, edits: str) -> None:
        marks = iter(edits)
        for letter in marks:
            self.audit.append(letter)
            if letter == "K":
                self.state = ROLES.index(role[0])
                self.line(role, text)
            elif letter != "D":
                to = next(marks)
                self.state = ROLES.index(to)
                self.line(FULL_ROLES[to], text if letter == "R" else "")

    def end(self) -> tuple[str, str]:
        while self.state in (SYSTEM, USER):
            self.state = int(NEXT[self.state])
            self.audit.append("I")
            self.line(FULL_ROLES[ROLES[self.state]], "")
        return "".join(self.audit), self.digest.hexdigest()


def _assemble(kind: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audits and digests of conversations whose rows come in order; texts are not held."""
    open_id, now = None, None

    def done():
        audit, digest = now.end()
        return pa.RecordBatch.from_pydict({
            "conv_id": pa.array([open_id], kind), "audit": pa.array([audit], pa.string()), "repaired_sha256": pa.array([digest], pa.string()),
        })

    for batch in batches:
        for conv, role, text, edits in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "edits"))):
            if now is None or conv != open_id:
                if now is not None:
                    yield done()
                open_id, now = conv, _Repaired()
            now.row(role, text, edits)
    if now is not None:
        yield done()


def repair_report(rows: DataFrame, slice_bits: int = SLICE_BITS) -> DataFrame:
    """Per conv_id of ``rows`` (conv_id, turn, role, text): counts of faults, cost, audit and digest after damage and repair.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. A null role or text is one space. A null conv_id is a conversation
    of its own; rows of null turns come first and count for no gap. Rows of one turn are
    in the order of a digest of role and text, so repeated rows are adjacent, and all
    but the first are duplicates. A conversation without rows after the damage has zeros, an empty
    audit and the digest of nothing; an empty table has no rows. Other columns aren't
    looked at. Texts, however long, are read once for their faults and once for the
    digest, which reads a conversation in order and holds none of it; its audit, a
    letter an edit, has to fit into a row.
    """
    key = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"
    ordered = in_order(damaged(rows))
    narrow = pin(faults(ordered, slice_bits))
    found = narrow.groupBy("slice").applyInArrow(
        _segments, f"{key}, segment long, slice long, product array<long>, first long, last long, illegal long, "
                   "blank long, duplicate long, truncated long",
    )
    whole, along = Window.partitionBy("conv_id"), Window.partitionBy("conv_id").orderBy("segment")
    pair = F.lag("last").over(along) * 4 + F.col("first")
    segments = pin(
        pin(found).withColumn("pieces", F.count("*").over(whole)).withColumn("pair", pair)
        .withColumn("is_first", F.col("pair").isNull()).withColumn(
            "illegal", F.col("illegal") + (~F.coalesce(F.col("pair"), F.lit(USER * 4 + ASSISTANT)).isin(
                SYSTEM * 4 + USER, USER * 4 + ASSISTANT, ASSISTANT * 4 + USER)).cast("long"))
    )
    # conversations of one segment end with it; there are two others a slice at most
    single = segments.filter("pieces = 1").select("segment", "slice", F.array(*[F.lit(int(x)).cast("long") for x in ENDING]).alias("ends"))
    several = segments.filter("pieces > 1")
    chained = several.groupBy("conv_id").applyInArrow(_ends, "segment long, slice long, ends array<long>")
    ends = single.unionByName(chained).join(segments.select("segment", "is_first"), "segment")

    def paths(left: pa.Table, right: pa.Table) -> pa.Table:
        return _paths(left, right)

    walked = pin(narrow.groupBy("slice").cogroup(ends.groupBy("slice")).applyInArrow(
        paths, "segment long, entered long, seq long, edits string, leaves long, cost long"))
    left = walked.filter("seq is null").select("segment", "entered", "leaves", "cost")
    in_chain = several.select("conv_id", "segment").join(left, "segment").groupBy("conv_id").applyInArrow(_chain, "segment long, entered long")
    entered = pin(segments.filter("pieces = 1").select("segment", F.lit(START).cast("long").alias("entered")).unionByName(in_chain))
    edits = walked.filter("seq is not null").join(entered, ["segment", "entered"], "left_semi").select("seq", "edits")
    lines = ordered.select("conv_id", "seq", "role", "text").join(edits, "seq").select("conv_id", "seq", "role", "text", "edits")
    kind = to_arrow_type(rows.schema["conv_id"].dataType)
    made = lines.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(
        lambda batches: _assemble(kind, batches), f"{key}, audit string, repaired_sha256 string")

    at_start = segments.filter("is_first").join(left.filter(F.col("entered") == START).select("segment", "cost"), "segment")
    costs = at_start.select("conv_id", "cost")
    counts = segments.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    turns = ordered.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    report = rows.select("conv_id").distinct()
    for part in (turns, counts, costs, made):
        other = part.withColumnRenamed("conv_id", "_conv")
        report = report.join(other, report["conv_id"].eqNullSafe(other["_conv"]), "left").drop("_conv")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return report.select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")
    )
