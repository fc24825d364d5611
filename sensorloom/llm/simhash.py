"""Near-duplicates by SimHash, linked exactly through a vantage-point tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.common import looked_up, stored, word_spans
from sensorloom.llm.graph import components

#: Words in a shingle, seed of the shingle hash, differing bits that still link.
SHINGLE, SEED, RADIUS = 3, 42, 3
#: Fingerprints the top of the tree is fitted on at most, those aimed at in a shard, and those
#: that one task compares at once.
SAMPLE, SHARD, BLOCK = 65_536, 2_048, 512
#: Visitors of a shard that one task takes, as estimated from the sample.
VISITORS = 400_000


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the lower-cased (A-Z) words' shingles: a bit is set if it is in over half."""
    words = raw.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    _, starts, ends = word_spans(text)
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[a:b], SEED) for a, b in zip(first, last)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for chunk in np.array_split(hashes, 1 + n // 65_536):
        bits = np.unpackbits(chunk.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            prints = [fingerprint(raw or b"", shingle) for raw in batch.column("raw").to_pylist()]
            prints = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints)], ["doc_id", "print"]
            )

    return rows


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, print`` (64 bits as a long) of every row of ``docs(doc_id, text)``. A text that is
    NULL or without words has the fingerprint zero."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("raw")
    ).mapInArrow(_fingerprints(shingle), "doc_id long, print long")


class Tree:
    """Top of a vantage-point tree: every leaf is a shard.

    An inner node has a vantage fingerprint and a distance: what lies no farther goes left. By the
    triangle inequality all within ``radius`` of a fingerprint at distance d from the vantage lie
    at d - radius to d + radius, so a side that these bounds do not touch is never visited.
    """

    def __init__(self, sample: np.ndarray, depth: int, radius: int):
        self.radius, self.nodes, self.leaves = radius, [], 0
        self._grow(sample, depth, np.random.default_rng(1))

    def _grow(self, sample: np.ndarray, depth: int, random) -> int:
        at = len(self.nodes)
        self.nodes.append(None)
        vantage = cut = None
        if depth and len(sample) > 1:
            # of a few vantages the one whose median splits with the fewest near the boundary
            best = len(sample) + 1
            for v in random.choice(sample, min(8, len(sample)), replace=False):
                d = np.bitwise_count(sample ^ v)
                m = int(np.median(d))
                m = m if (d > m).any() else m - 1
                both = int(((d > m - self.radius) & (d <= m + self.radius)).sum())
                both += abs(len(sample) - 2 * int((d <= m).sum()))
                if (d <= m).any() and both < best:
                    best, vantage, cut = both, v, m
        if vantage is None:
            self.nodes[at] = self.leaves
            self.leaves += 1
        else:
            near = np.bitwise_count(sample ^ vantage) <= cut
            left = self._grow(sample[near], depth - 1, random)
            right = self._grow(sample[~near], depth - 1, random)
            self.nodes[at] = (vantage, cut, left, right)
        return at

    def route(self, prints: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The home leaf of every fingerprint, and for every leaf the positions of those that
        visit it: whose radius reaches it and whose home is this leaf or one before it."""
        home = np.zeros(len(prints), np.int32)
        visits: list[np.ndarray] = [np.zeros(0, np.int64)] * self.leaves
        todo = [(0, np.arange(len(prints)), np.ones(len(prints), bool))]
        while todo:
            at, who, own = todo.pop()
            node = self.nodes[at]
            if isinstance(node, int):
                home[who[own]] = node
                visits[node] = who
                continue
            vantage, cut, left, right = node
            d = np.bitwise_count(prints[who] ^ vantage).astype(np.int16)
            go = d - self.radius <= cut
            todo.append((left, who[go], own[go] & (d[go] <= cut)))
            go = d + self.radius > cut
            todo.append((right, who[go], own[go] & (d[go] > cut)))
        return home, [who[home[who] <= leaf] for leaf, who in enumerate(visits)]


def near_pairs(home: np.ndarray, visitors: np.ndarray, radius: int) -> Iterator[tuple]:
    """Positions ``(i, j)`` of all ``home[i]`` and ``visitors[j]`` that differ in at most
    ``radius`` bits, in bounded blocks; the tree goes on below its shards by the same bounds."""
    random = np.random.default_rng(len(home))
    todo = [(np.arange(len(home)), np.arange(len(visitors)))]
    while todo:
        left, right = todo.pop()
        if not len(left) or not len(right):
            continue
        d = np.zeros(0)
        if len(left) > BLOCK:
            vantage = home[random.choice(left)]
            d = np.bitwise_count(home[left] ^ vantage).astype(np.int16)
            cut = int(np.median(d))
            cut = cut if (d > cut).any() else cut - 1
        if len(d) and (d <= cut).any():
            e = np.bitwise_count(visitors[right] ^ vantage).astype(np.int16)
            todo.append((left[d <= cut], right[e - radius <= cut]))
            todo.append((left[d > cut], right[e + radius > cut]))
            continue
        for some in np.array_split(left, 1 + (len(left) - 1) // BLOCK):
            for others in np.array_split(right, 1 + (len(right) - 1) // 8_192):
                near = np.bitwise_count(home[some][:, None] ^ visitors[others][None, :]) <= radius
                i, j = np.nonzero(near)
                yield some[i], others[j]


class Forest:
    """Joins what is linked, one block of links at a time, so that no list of all links is kept."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            a, b = self.root[a], self.root[b]
            apart = a != b
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def links(prints: DataFrame, radius: int = RADIUS, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints ``prints(print)`` that join exactly those
    which a chain of pairs with at most ``radius`` differing bits joins.

    The top of a vantage-point tree is fitted on at most ``sample`` of them. Every fingerprint
    goes to its home shard and, within the triangle bounds, to later shards as a visitor. A task
    takes one shard, or one slice of its home fingerprints and of its visitors where the sample
    says that there are many, compares exactly, and returns one link per fingerprint that is
    joined to another one, not all pairs.
    """
    n = prints.count()
    some = prints.sample(min(1.0, sample * 0.9 / max(n, 1)), seed=7).limit(sample)
    some = np.sort(np.array([r[0] for r in some.collect()], np.int64).view(np.uint64))
    depth = int(np.ceil(np.log2(max(1, min(n / shard, len(some) / 8)))))
    tree = Tree(some, depth, radius)
    home, visits = tree.route(some)
    scale = max(1.0, n / max(1, len(some)))
    slices = 1 + (np.bincount(home, minlength=tree.leaves) * scale / (16 * shard)).astype(int)
    parts = 1 + (np.array([len(v) for v in visits]) * scale / VISITORS).astype(int)

    def route(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # packed: a row for each shard and batch, not for each visit
        for batch in source:
            values = np.asarray(batch.column("print")).view(np.uint64)
            at, visiting = tree.route(values)
            out = {"task": [], "home": [], "visitors": []}
            for leaf, who in enumerate(visiting):
                if not len(who):
                    continue
                mine = who[at[who] == leaf]
                for s in range(slices[leaf]):
                    for p in range(parts[leaf]):
                        own = values[mine[mine_slice(values[mine], slices[leaf]) == s]]
                        go = values[who[mine_slice(values[who], parts[leaf]) == p]]
                        if len(own) or len(go):
                            out["task"].append(f"{leaf}.{s}.{p}")
                            out["home"].append(own.tobytes())
                            out["visitors"].append(go.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["task"], pa.string())]
                + [pa.array(out[c], pa.binary()) for c in ("home", "visitors")],
                list(out),
            )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        own, go = (np.frombuffer(b"".join(group[c]), np.uint64) for c in ("home", "visitors"))
        nodes, at = np.unique(np.concatenate([own, go]), return_inverse=True)
        forest = Forest(len(nodes))
        for i, j in near_pairs(own, go, radius):
            forest.link(at[i], at[len(own) + j])
        joined = np.flatnonzero(forest.root != np.arange(len(nodes)))
        return pd.DataFrame(
            {"a": nodes[joined].view(np.int64), "b": nodes[forest.root[joined]].view(np.int64)}
        )

    routed = prints.select("print").mapInArrow(route, "task string, home binary, visitors binary")
    return routed.groupBy("task").applyInPandas(compare, "a long, b long")


def mine_slice(values: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` slices of its shard each fingerprint belongs to."""
    return (values * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(n)


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs(doc_id, text)``.

    ``fingerprint`` is in 16 hexadecimal digits; ``component_id`` is the smallest doc_id that
    links of at most ``radius`` differing bits reach, itself included. Equal fingerprints count as
    one node however many documents have them. Rows with a NULL doc_id have a fingerprint and the
    component of their fingerprint, NULL if no other row is in it; they give no component its id.
    Repeated rows stay. Other columns are ignored.
    """
    prints = stored(fingerprints(docs, shingle), "prints")
    nodes = prints.groupBy("print").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    nodes = stored(nodes, "nodes")
    roots = components(links(nodes, radius))
    joined = nodes.join(roots.withColumnRenamed("node", "print"), "print").withColumn(
        "root", F.coalesce("root", "print")
    )
    # roots themselves are no node in the links' answer
    members = joined.select("print", "root", "least").unionByName(
        roots.select(F.col("root").alias("print")).distinct().join(nodes, "print")
        .select("print", F.col("print").alias("root"), "least")
    )
    least = members.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = members.join(least, "root").select("print", "component_id")
    of_print = nodes.join(linked, "print", "left").select(
        "print", "n", F.coalesce("component_id", "least").alias("component_id")
    )
    of_print = stored(of_print, "classes")
    total = nodes.agg(F.sum("n")).first()[0] or 0
    return looked_up(prints, of_print, ["print"], total, ["doc_id"]).select(
        "doc_id",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def representatives(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One row of ``docs``, with all its columns, of each component of near-duplicates: that of
    the smallest doc_id.

    Only rows of a component compete for it: of a doc_id with texts in several, those in one where
    it is the smallest. If several rows of it are then in question, the one with the smallest text
    stays (NULL first). Rows with a NULL doc_id are in no group and stay.
    """
    ids = (
        near_duplicates(docs.select("doc_id", "text"), radius, shingle)
        .where("doc_id = component_id")
        .groupBy(F.col("doc_id").alias("keep_id"), F.conv("fingerprint", 16, -10).cast("long").alias("keep_print"))
        .agg(F.count("*").alias("keep_rows"))
    )
    whole = F.struct(*docs.columns).alias("doc")
    marked = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("keep_id"), whole)

    def printed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts = batch.column("raw").to_pylist()
            prints = np.array([fingerprint(raw or b"", shingle) for raw in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("keep_id"), batch.column("doc"), pa.array(prints)], ["keep_id", "doc", "keep_print"]
            )

    schema = T.StructType([*marked.schema.fields, T.StructField("keep_print", T.LongType())])
    rows = marked.withColumn("raw", F.col("doc.text").cast("string").cast("binary")).mapInArrow(printed, schema)
    rows = rows.join(ids, ["keep_id", "keep_print"])
    # an id can be the smallest of several components
    several = ids.groupBy("keep_id").agg(F.sum("keep_rows").alias("keep_rows"))
    rows = rows.drop("keep_rows").join(several, "keep_id")
    first = Window.partitionBy("keep_id").orderBy("doc.text")
    again = rows.where("keep_rows > 1").withColumn("at", F.row_number().over(first)).where("at = 1")
    kept = rows.where("keep_rows = 1").select("doc").unionByName(again.select("doc"))
    kept = kept.unionByName(docs.where("doc_id IS NULL").select(whole))
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
