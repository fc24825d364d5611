"""Merkle manifest of a table: one tree per group of rows, and one over the groups' roots.

Only every few levels of a tree are stored. A proof takes the siblings on the way up: those on a
level between two stored ones are computed again from the stored nodes below, for one aligned
subtree at a time, written into the proof and dropped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import ascii_lower, fold, looked_up, stored

#: Nodes that have one parent, as a power of two, and levels from one stored level to the next.
RUN_BITS, STEP = 3, 2
RUN = 1 << RUN_BITS
#: What makes up a leaf, and one row in how many is tampered with by the query.
FIELDS, TAMPERED = ("doc_id", "source", "lang", "n_chars", "text"), 3
#: Rows that a task numbers at most, as Spark numbers them.
ROW_BITS = 33


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(values: Sequence[Column]) -> Column:
    """The hash of a record: of every value its length in bytes, a colon and the value as UTF-8
    text, or ``-`` for a NULL."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(F.concat(*map(part, values)))


def group_key(value: Column) -> Column:
    """Bytes that are ordered as the values are: NULL first, then by UTF-8 bytes."""
    key = F.concat(F.lit(b"\x01"), value.cast("string").cast("binary"))
    return F.coalesce(key, F.lit(b"\x00"))


@dataclass(frozen=True)
class Tree:
    """The stored part of one tree per ``key``.

    ``levels[i]`` holds the nodes of level ``i * STEP`` as ``key, pos, size, node``, size being the
    number of leaves below the key; level 0 has the columns of the leaves' rows too. ``tops`` has
    ``key, size, node`` of the last node of every key.
    """

    levels: list[DataFrame]
    tops: DataFrame


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, the row's place within its ``key`` by ``order``, and ``size``, the
    number of rows of the key; both stored.

    Rows are sorted over all tasks by key and order, equal ones by where they were read, so that
    neither a large key nor repeated rows fill one task. A place is the number of rows in the tasks
    before, plus the row's place in its own. Only one count per task and what ``looked_up`` finds
    hot is broadcast.
    """
    by = ["key", *order, "tie"]
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    in_order = tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("tie")
    in_order = stored(in_order.withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", ROW_BITS)
    parts = in_order.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    before = parts.selectExpr("part", "sum(rows) OVER (ORDER BY part) - rows AS before")
    place = F.col("before") + F.col("at").bitwiseAND((1 << ROW_BITS) - 1)
    placed = (
        in_order.withColumn("part", part).join(F.broadcast(before), "part").withColumn("place", place)
    )
    keys = placed.groupBy("key").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    keys = stored(keys.withColumn("size", F.col("n")), "keys")
    total = in_order.count()
    found = looked_up(placed, keys, ["key"], total, ["place"])
    pos = (F.col("place") - F.col("first")).alias("pos")
    return stored(found.select(*rows.columns, pos, "size"), "numbered")


def count_at(level: int) -> Column:
    """Nodes of a key on a level."""
    bits = level * RUN_BITS
    return F.shiftright(F.col("size") + ((1 << bits) - 1), bits)


def subtrees(nodes: DataFrame, level: int, carried: Sequence[str] = ()) -> DataFrame:
    """A row ``key, block, size, entries, l0 ... lSTEP`` for every aligned subtree that reaches from
    a stored level up to the next: its stored nodes in order, and the nodes above, computed from
    them. Above the top of a key nothing is hashed; the last list has one node in any case."""
    block = F.shiftright("pos", STEP * RUN_BITS).alias("block")
    entries = F.sort_array(F.collect_list(F.struct("pos", "node", *carried)))
    rows = nodes.groupBy("key", block).agg(F.max("size").alias("size"), entries.alias("entries"))
    rows = rows.withColumn("l0", F.col("entries.node"))
    for k in range(STEP):
        parents = F.when(count_at(level + k) > 1, _parents(f"l{k}")).otherwise(F.col(f"l{k}"))
        rows = rows.withColumn(f"l{k + 1}", parents)
    return rows


def _parents(nodes: str) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / RUN).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(nodes, i * RUN + 1, RUN), "")))


def grown(leaves: DataFrame, order: Sequence[str]) -> Tree:
    """The trees over ``leaves(key, node, ...)``, the leaves of a key in the given order.

    Each round reads one stored level and writes the next, with a sixty-fourth of its rows. The
    leaves are stored first, so that sorting them does not hash the records again.
    """
    levels, tops = [numbered(stored(leaves, "leaves"), order)], []
    most = levels[0].agg(F.max("size")).first()[0] or 0
    while True:
        level = STEP * (len(levels) - 1)
        rows = subtrees(levels[-1].select("key", "pos", "size", "node"), level)
        node = F.element_at(f"l{STEP}", 1).alias("node")
        above = stored(rows.select("key", F.col("block").alias("pos"), "size", node), "level")
        last = count_at(level + STEP) <= 1
        tops.append(above.where(last).select("key", "size", "node"))
        if most <= 1 << (level + STEP) * RUN_BITS:
            return Tree(levels, reduce(DataFrame.unionAll, tops))
        levels.append(above.where(~last))


def _siblings(level: int) -> Column:
    """Of every entry of a subtree, the entry and its siblings on the levels of the subtree, each as
    the text left of the node on the way and the text right of it."""

    def along(entry: Column, i: Column) -> Column:
        steps = []
        for k in range(STEP):
            own = F.floor(i / (1 << k * RUN_BITS)).cast("int")
            start = own - own % RUN
            left = F.array_join(F.slice(f"l{k}", start + 1, own - start), "")
            right = F.array_join(F.slice(f"l{k}", own + 2, start + RUN - 1 - own), "")
            step = F.struct(left.alias("left"), right.alias("right"))
            steps.append(F.when(count_at(level + k) > 1, step))
        return F.struct(entry.alias("entry"), F.array_compact(F.array(*steps)).alias("steps"))

    return F.transform("entries", along)


def proven(tree: Tree, above: DataFrame) -> DataFrame:
    """The rows of the leaves with ``proof``, an array of ``left, right`` from the leaf up.

    ``above(key, proof, ...)`` has what follows beyond the top of each key, one row a key; its other
    columns are handed down. A proof is computed once for a stored node and handed to the subtree
    below it, so what is shuffled is one row per subtree and not one per leaf.
    """
    given = [c for c in above.columns if c not in ("key", "proof")]
    sizes = tree.tops.select("key", "size")
    starts = above.join(sizes, "key").withColumn("pos", F.lit(0).cast("long"))
    handed = None
    for stage in reversed(range(len(tree.levels))):
        level = STEP * stage
        nodes = tree.levels[stage]
        carried = [c for c in nodes.columns if c not in ("key", "pos", "size", "node")]
        # keys whose tree ends with this stage's subtrees; a key of one leaf ends with the first
        bits = (level + STEP) * RUN_BITS
        ends = F.col("size") <= 1 << bits
        if stage:
            ends &= F.col("size") > 1 << level * RUN_BITS
        parents = starts.where(ends).select("key", F.col("pos").alias("block"), "proof", *given)
        if handed is not None:
            parents = parents.unionByName(handed)
        rows = subtrees(nodes, level, carried).withColumn("all", _siblings(level))
        rows = rows.select("key", "block", "all").join(parents, ["key", "block"])
        rows = rows.select("key", "proof", *given, F.inline("all"))
        proof = F.concat("steps", "proof").alias("proof")
        if stage:
            up = rows.select("key", F.col("entry.pos").alias("block"), proof, *given)
            handed = stored(up, "proofs")
        else:
            fields = [F.col(f"entry.{c}").alias(c) for c in ("pos", "node", *carried)]
            return rows.select("key", *fields, proof, *given)


def proof_digest(proof: Column) -> Column:
    """The hash of the siblings, level by level, left to right."""
    sides = F.transform(proof, lambda step: F.concat(step["left"], step["right"]))
    return digest(F.array_join(sides, ""))


def folded(node: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(
        proof, node, lambda below, step: digest(F.concat(step["left"], below, step["right"]))
    )


def manifest(leaves: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows of ``leaves(node, ...)`` with ``subroot``, ``root`` and ``proof``.

    A tree over the rows of each value of ``group``, NULL being one of them, in the given order,
    and a tree over these trees' roots by that value, NULL first and then bytewise.
    """
    trees = grown(leaves.withColumn("key", group_key(F.col(group))), order)
    roots = trees.tops.select(F.lit(b"").alias("key"), F.col("key").alias("of"), "node")
    top = grown(roots, ["of"])
    nothing = F.array().cast("array<struct<left:string,right:string>>").alias("proof")
    root = top.tops.select("key", F.col("node").alias("root"), nothing)
    above = proven(top, root).select(
        F.col("of").alias("key"), F.col("node").alias("subroot"), "root", "proof"
    )
    return proven(trees, stored(above, "roots")).drop("key", "pos")


def verified(docs: DataFrame, fields: Sequence[str] = FIELDS, tampered: int = TAMPERED) -> DataFrame:
    """The manifest of ``docs`` by lang and doc_id, each leaf checked against the root.

    Rows whose crc32 of the decimal ``doc_id`` is divisible by ``tampered`` are checked with the
    letters A-Z of their text lower-cased; a NULL text stays, and a NULL ``doc_id`` is not tampered
    with. Rows of one ``doc_id`` follow each other by their hash, NULL ids come first. Repeated rows
    stay rows of their own. Columns that are no ``fields``, whatever their names, are left out.
    """
    values = [F.col(name) for name in fields]
    changed = [ascii_lower(F.col(name)) if name == "text" else F.col(name) for name in fields]
    touched = fold("doc_id", tampered) == 0
    leaves = docs.select(
        "doc_id",
        F.col("lang"),
        leaf(values).alias("node"),
        F.when(touched, leaf(changed)).alias("changed"),
    )
    rows = manifest(leaves, "lang", ["doc_id", "node"])
    shown = F.coalesce("changed", "node")
    return rows.select(
        "doc_id",
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("proof")).alias("proof_sha256"),
        folded(shown, F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
