"""Near-duplicate groups by HyperMinHash sketches, banding and exact verification.

1. Every text becomes the set of its word shingles and a sketch of it. Rows of
   equal sets are one class, so a text with many copies is one row from here on.
2. Bands of the compressed registers are keys; classes that share a key may be
   similar. Empty registers borrow from full ones for banding only.
3. In each key, members are compared with two pivots: the one that shares most
   keys with others (the middle of a family of copies) and one at random. The
   collision-corrected estimate drops hopeless pairs, the others are confirmed on
   their full sets. That links nearly all of a group with work linear in its size.
4. What a key holds outside its pivot's component is compared with everything in
   that key, in blocks of bounded size; only confirmed links leave a block. So no
   link between different texts is lost and no list of all pairs is ever made.
5. Links become connected components.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from larder.llm.common import fresh, give_back, map_texts, marked, slices
from larder.llm.components import components
from larder.llm.hyperminhash import (
    BUCKETS, EMPTY, band_keys, estimated_jaccard, exact_overlap, registers, shingle_sets,
)
from larder.plans.lineage import pin


@dataclass(frozen=True)
class NearRules:
    """``width`` words a shingle, ``percent`` similarity, ``band_rows`` registers a band.

    A block of leftovers holds about ``block`` documents or ``block_shingles`` shingles,
    whichever is less, or one document.

    With 128 registers in bands of 4, a pair at 0.8 shares no band with probability 5e-8.
    """

    width: int = 5
    percent: int = 80
    band_rows: int = 4
    block: int = 256
    block_shingles: int = 1 << 17


#: Standard errors by which an estimate may fall short before a pair is dropped.
_SLACK = 5.0
SKETCH_SCHEMA = "doc_id long, n_shingles long, set_hash binary, sketch binary"


def _sketch(rules: NearRules, batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = shingle_sets(batch.column("text"), rules.width)
    return pa.RecordBatch.from_pydict({
        "doc_id": batch.column("doc_id"),
        "n_shingles": pa.array([len(x) for x in sets], pa.int64()),
        "set_hash": pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets], pa.binary()),
        "sketch": pa.array([registers(x).tobytes() if len(x) else None for x in sets], pa.binary()),
    })


def sketches(docs: DataFrame, rules: NearRules) -> DataFrame:
    """doc_id, n_shingles, set_hash and sketch of each text; null hash and sketch without words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_texts(rows, partial(_sketch, rules), SKETCH_SCHEMA)


def _regs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def _bands(rules: NearRules, batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = band_keys(_regs(batch.column("sketch")), rules.band_rows)
        ids = np.repeat(batch.column("id").to_numpy(), keys.shape[1])
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys.ravel()), "id": pa.array(ids)})
    give_back()


def _hopeful(rules: NearRules, regs_a, regs_b, n_a, n_b) -> np.ndarray:
    """Which pairs may reach the similarity, by sizes and then by the corrected estimate."""
    goal, ok = rules.percent / 100, 100 * np.minimum(n_a, n_b) >= rules.percent * np.maximum(n_a, n_b)
    estimate, used = estimated_jaccard(regs_a[ok], regs_b[ok], n_a[ok], n_b[ok])
    slack = _SLACK * np.sqrt(goal * (1 - goal) / np.maximum(used, 1)) + 0.02
    ok[ok] = estimate >= goal - slack
    return ok


def _similar(rules: NearRules, a: np.ndarray, b: np.ndarray) -> bool:
    shared = exact_overlap(a, b)
    return 100 * shared >= rules.percent * (len(a) + len(b) - shared)


def _estimate_pairs(rules: NearRules, batches):
    for batch in batches:
        if batch.num_rows:
            ok = _hopeful(rules, *(_regs(batch.column(x)) for x in ("sketch_a", "sketch_b")),
                          *(batch.column(x).to_numpy() for x in ("n_a", "n_b")))
            yield batch.select(["a", "b"]).filter(pa.array(ok))
    give_back()


def _confirm_pairs(rules: NearRules, batch: pa.RecordBatch) -> pa.RecordBatch:
    a, b = (shingle_sets(batch.column(x), rules.width) for x in ("text", "text_b"))
    return batch.select(["a", "b"]).filter(pa.array([_similar(rules, x, y) for x, y in zip(a, b)], pa.bool_()))


class _Groups:
    """Union-find over the positions of a block."""

    def __init__(self, labels: list[int]):
        self.up = {x: x for x in labels}

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.root(x)] = self.root(y)


def _compare_blocks(rules: NearRules, rows: pa.Table) -> pa.Table:
    """Confirmed links between a block of leftovers and another block (or itself), between different components."""
    rows = rows.combine_chunks()
    sets = [x for part in rows.to_batches() for some in slices(part) for x in shingle_sets(some.column("text"), rules.width)]
    regs, sizes = np.array([registers(x) for x in sets]), np.array([len(x) for x in sets])
    ids, labels = rows["id"].to_numpy(), rows["component"].to_pylist()
    left, right = (np.flatnonzero(rows[x].to_numpy(zero_copy_only=False)) for x in ("is_left", "is_right"))
    groups, links = _Groups(labels), []
    for i in left:
        ok = _hopeful(rules, regs[right], np.broadcast_to(regs[i], (len(right), BUCKETS)), sizes[right], np.full(len(right), sizes[i]))
        for j in right[ok]:
            if groups.root(labels[i]) != groups.root(labels[j]) and _similar(rules, sets[i], sets[j]):
                groups.join(labels[i], labels[j])
                links.append((ids[i], ids[j]))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _star_links(edges: DataFrame, classes: DataFrame, texts: DataFrame, rules: NearRules) -> DataFrame:
    regs = lambda s: classes.select(F.col("id").alias(s), F.col("sketch").alias(f"sketch_{s}"), F.col("n_shingles").alias(f"n_{s}"))
    hopeful = edges.join(regs("a"), "a").join(regs("b"), "b").mapInArrow(partial(_estimate_pairs, rules), "a long, b long")
    with_a = pin(hopeful).join(texts.select(F.col("id").alias("a"), "text"), "a")
    with_b = with_a.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text", "text_b")
    return pin(map_texts(with_b, partial(_confirm_pairs, rules), "a long, b long", "text", "text_b"))


def _settled(people: DataFrame) -> DataFrame:
    """``people`` with the home of their home's home, so that small homes around a large one become part of it."""
    homes = people.select("id", "home")
    for near, far in (("_a", "_b"), ("_c", "_d")):
        people = people.join(homes.toDF(near, far), F.col("home") == F.col(near), "left")
        people = people.withColumn("home", F.coalesce(far, "home")).drop(near, far)
    return pin(people)


def _leftover_links(ranked: DataFrame, labels: DataFrame, sizes: DataFrame, texts: DataFrame, rules: NearRules) -> DataFrame:
    """Links between what a key holds outside its pivot's component and the rest of that key; ``sizes``: id, n_shingles."""
    of = lambda at, name: labels.select(F.col("id").alias(at), F.col("component").alias(name))
    named = ranked.join(of("_i", "component"), F.col("id") == F.col("_i"), "left").join(of("_p", "main"), F.col("pivot") == F.col("_p"), "left")
    named = pin(
        named.select("key", "id", "home", F.coalesce("component", "id").alias("component"), F.coalesce("main", "pivot").alias("main"))
        .withColumn("apart", F.col("component") != F.col("main"))
    )
    members = named.join(named.filter("apart").select("key").distinct(), "key", "left_semi")
    # a document is in one block: with others of its home, leftovers apart from the rest
    people = members.groupBy("id").agg(F.first("home").alias("home"), F.first("component").alias("component"), F.max("apart").alias("apart"))
    people = _settled(pin(people.join(sizes, "id")))
    size = F.greatest(F.count("*") / rules.block, F.sum("n_shingles") / rules.block_shingles)
    crowd = people.groupBy("home", "apart").agg(F.ceil(size).cast("long").alias("salts"))
    blocks = pin(
        people.join(crowd, ["home", "apart"])
        .withColumn("block", F.xxhash64("home", "apart", F.pmod(F.xxhash64("id"), F.col("salts"))))
        .select("id", "component", "apart", "block")
    )
    at = pin(members.select("key", "id").join(blocks, "id").select("key", "block", "apart").distinct())
    pairs = (
        at.filter("apart").select("key", F.col("block").alias("left_block"))
        .join(at.select("key", F.col("block").alias("right_block"), F.col("apart").alias("both")), "key")
        .filter("not both or left_block <= right_block")
        .select("left_block", "right_block").distinct()
    )
    sides = pairs.select("left_block", "right_block", F.explode(F.array_distinct(F.array("left_block", "right_block"))).alias("block"))
    filled = blocks.join(texts, "id").select("id", "component", "block", "text").join(sides, "block").select(
        "left_block", "right_block", "id", "component", "text",
        (F.col("block") == F.col("left_block")).alias("is_left"), (F.col("block") == F.col("right_block")).alias("is_right"),
    )

    def compare(block: pa.Table) -> pa.Table:
        links = _compare_blocks(rules, block)
        give_back()
        return links

    return pin(filled.groupBy("left_block", "right_block").applyInArrow(compare, "a long, b long"))


def near_links(classes: DataFrame, docs: DataFrame, rules: NearRules) -> tuple[DataFrame, DataFrame]:
    """Components of ``classes`` (id, doc, n_shingles, sketch, set_hash) by most links, and the links between those that are left.

    ``doc`` is the doc_id of a row with the class's set.
    Links inside a component that is already joined may be left out of the second.
    """
    bands = pin(classes.select("id", "sketch").mapInArrow(partial(_bands, rules), "key long, id long"))
    shared = pin(bands.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"))
    own = Window.partitionBy("id")  # a document has one row per band
    scored = pin(bands.join(shared, "key").withColumn("score", F.sum("size").over(own)))
    pivots = pin(
        scored.groupBy("key").agg(
            (-F.max(F.struct("score", (-F.col("id")).alias("minus"))).getField("minus")).alias("pivot"),
            F.min(F.struct(F.xxhash64("id", "key").alias("draw"), "id")).getField("id").alias("other"),
        )
    )
    home = F.max(F.struct("size", "pivot")).over(own).getField("pivot")
    ranked = pin(scored.join(pivots, "key").withColumn("home", home).select("key", "id", "pivot", "other", "home"))
    toward = F.explode(F.array("pivot", "other")).alias("to")
    edges = pin(
        ranked.select("id", toward).select(F.least("id", "to").alias("a"), F.greatest("id", "to").alias("b")).filter("a <> b").distinct()
    )
    wanted = pin(ranked.select("id").distinct())
    asked = pin(classes.join(wanted, "id", "left_semi").select("id", "doc", "set_hash"))
    owners = pin(asked.select("doc").distinct())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    sieved = marked(rows, F.col("doc"), owners, "_wanted").filter("_wanted").select("doc", "text")
    texts = pin(_texts_of(sieved, owners, asked, rules))
    labels = pin(components(_star_links(edges, classes, texts, rules)))
    return labels, _leftover_links(ranked, labels, classes.select("id", "n_shingles"), texts, rules)


def _texts_of(rows: DataFrame, owners: DataFrame, asked: DataFrame, rules: NearRules) -> DataFrame:
    """(id, text) of the classes in ``asked``: of the rows of its doc_id, for each the one with its set."""
    own = rows.join(owners, "doc", "left_semi")
    hashed = map_texts(own, partial(_with_hash, rules), "doc long, text string, set_hash binary")
    return hashed.join(asked, ["doc", "set_hash"]).groupBy("id").agg(F.min("text").alias("text"))


def _with_hash(rules: NearRules, batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = shingle_sets(batch.column("text"), rules.width)
    digests = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
    return pa.RecordBatch.from_pydict({"doc": batch.column("doc"), "text": batch.column("text"), "set_hash": pa.array(digests, pa.binary())})


def near_groups(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id reached by links, and ``kept`` says whether
    it is the row's own. Texts without words (null, empty, white space) and rows without
    an id are linked with nothing; the latter have a null component and are kept. Rows
    that repeat a doc_id count as one document with the links of all of them.
    """
    rows = pin(sketches(docs, rules))
    linked = rows.filter(F.col("set_hash").isNotNull() & F.col("doc_id").isNotNull())
    sets = linked.groupBy("set_hash").agg(
        F.min("doc_id").alias("doc"), F.min_by(F.struct("n_shingles", "sketch"), "doc_id").alias("own"), F.count("*").alias("copies")
    ).select("set_hash", "doc", F.col("own.n_shingles").alias("n_shingles"), F.col("own.sketch").alias("sketch"), "copies")
    # a class is one set; its id grows with its smallest doc_id, which several classes may have
    classes = pin(sets.orderBy("doc", "set_hash").withColumn("id", F.monotonically_increasing_id()))
    first, links = near_links(classes, docs, rules)
    copied = classes.filter("copies > 1").select(F.col("set_hash").alias("_h"), "id")
    copied = pin(linked.join(copied, F.col("set_hash") == F.col("_h")).select("doc_id", "id").distinct())
    held = copied.unionByName(classes.filter("copies = 1").select(F.col("doc").alias("doc_id"), "id"))
    labels = _joined_labels(first, links.unionByName(_same_document(held)))
    heads = _heads(labels, classes)
    named = heads.select(F.col("id").alias("_id"), "doc", "head")
    # the row of smallest id is found by its class, copies by theirs
    of_docs = named.select(F.col("doc").alias("id"), "head").unionByName(
        copied.join(named, F.col("id") == F.col("_id")).select(F.col("doc_id").alias("id"), "head")
    ).groupBy("id").agg(F.min("head").alias("component"))
    return (
        rows.join(of_docs, rows["doc_id"] == of_docs["id"], "left")
        .withColumn("component_id", F.coalesce("component", "doc_id"))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def _same_document(held: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of each doc_id that holds several; ``held``: doc_id, id."""
    several = held.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("last")).filter("a < last").select("doc_id", "a")
    return held.join(pin(several), "doc_id").select("a", F.col("id").alias("b")).filter("a <> b")


def _heads(labels: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, doc, head) of each class with copies or a label: the smallest doc_id of it and of its component."""
    own = classes.select("id", "doc", "copies").join(labels.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left")
    own = pin(own.filter("copies > 1 or component is not null").select("id", "doc", F.coalesce("component", "id").alias("component")))
    # ids of classes are in the order of their documents, so a component's least class has its least document
    least = own.filter("id = component").select("component", F.col("doc").alias("head"))
    return pin(own.join(least, "component").select("id", "doc", "head"))


def _joined_labels(first: DataFrame, links: DataFrame) -> DataFrame:
    """The components of ``first`` (id, component) after ``links`` (a, b) join some of them."""
    name = lambda at: first.select(F.col("id").alias(f"_{at}"), F.col("component").alias(f"of_{at}"))
    between = links.join(name("a"), F.col("a") == F.col("_a"), "left").join(name("b"), F.col("b") == F.col("_b"), "left")
    joined = pin(components(pin(between.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))))
    over = joined.select(F.col("id").alias("_old"), F.col("component").alias("_new"))
    renamed = first.join(over, F.col("component") == F.col("_old"), "left").select("id", F.coalesce("_new", "component").alias("component"))
    return pin(renamed.unionByName(joined.join(first, "id", "left_anti")).groupBy("id").agg(F.min("component").alias("component")))


def drop_near(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:
    """``docs`` with one document of each group, the one of smallest doc_id; columns as they came.

    Only rows whose id may be among the dropped ones are shuffled for the exact test.
    """
    lost = pin(near_groups(docs.select("doc_id", "text"), rules).filter("not kept").select(F.col("doc_id").alias("_lost")).distinct())
    return without_ids(docs, lost)


def without_ids(docs: DataFrame, lost: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``lost`` (one column of longs)."""
    body = fresh(["id"], "row_")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(body), F.col("doc_id").cast("long").alias("id"))
    seen = marked(rows, F.col("id"), lost, "_maybe")
    sure = seen.filter("not _maybe").select(f"{body}.*")
    tested = seen.filter("_maybe").join(lost, F.col("id") == F.col(lost.columns[0]), "left_anti").select(f"{body}.*")
    return sure.unionByName(tested)
