"""Near-duplicates by the Jaccard similarity of word shingles, found exactly by prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import Spans, mixed, stored, word_hashes
from sensorloom.llm.graph import components

#: Words in a shingle, similarity that links.
SHINGLE, SIMILAR = 5, 0.8
#: One text in so many is looked at to find common shingles, and how many of these are put last.
#: Both set only the order of shingles, of which any gives the same links.
SEEN, COMMON = 16, 1 << 20
#: Rounds in which the texts of a shingle are compared with one of them, before all those still
#: apart are compared.
STARS = 2

_SHINGLES = Spans(0xA0761D6478BD642F)


def shingles(raw: bytes | None, words: int = SHINGLE) -> np.ndarray:
    """The distinct shingle hashes of the lower-cased (A-Z) words, sorted; a shorter text is one
    shingle, one without words has none."""
    found = word_hashes((raw or b"").lower())
    if not len(found):
        return np.zeros(0, np.uint64)
    return np.unique(_SHINGLES.windows(mixed(found), min(words, len(found))))


def key_of(found: np.ndarray) -> int:
    """Equal sets have equal keys, other sets other ones (64 bits)."""
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "big", signed=True)


def prefix(found: np.ndarray, common: np.ndarray, ranks: np.ndarray, similar: float) -> np.ndarray:
    """The first of a set's shingles, common ones last: sets of the similarity share one of them.

    Sets of similarity s share at least s of either's shingles, so not all that they share can
    come after the first n - ceil(s n) + 1 of both.
    """
    n = len(found)
    order = np.zeros(n, np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        order = np.where(common[at] == found, ranks[at], 0)
    first = n - int(np.ceil(similar * n - 1e-9)) + 1 if n else 0
    return found[np.lexsort((found, order))[:first]]


def _shingled(docs: DataFrame, schema: str, names: list[str], row) -> DataFrame:
    """``row(found)`` gives the values of ``names``, a list of each, for every text."""

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            made = [row(shingles(raw)) for raw in batch.column("raw").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([m[i] for m in made]) if len(made) else [], pa.int64()) for i in range(len(names))],
                names,
            )

    return docs.select(F.col("text").cast("string").cast("binary").alias("raw")).mapInArrow(rows, schema)


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several of the texts looked at have, sorted, and their ranks by count."""
    some = docs.where(F.pmod(F.xxhash64(F.col("text").cast("string")), F.lit(SEEN)) == 0)
    counts = _shingled(some, "token long", ["token"], lambda found: [found.view(np.int64)]).groupBy("token").count()
    # at most COMMON rows
    table = counts.where("count > 1").orderBy(F.desc("count"), "token").limit(COMMON).toArrow()
    tokens = np.asarray(table.column("token"), np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.asarray(table.column("count"), np.int64)[order]


def links(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``(node, root)``: for every key of ``docs(text)`` that a chain of pairs with a similarity of
    at least ``similar`` joins to a smaller one, the smallest of them."""
    common, ranks = common_shingles(docs)

    def prefixes(found: np.ndarray) -> list[np.ndarray]:
        first = prefix(found, common, ranks, similar).view(np.int64)
        return [first, np.full(len(first), key_of(found)), np.full(len(first), len(found))]

    names = ["token", "key", "size"]
    rows = stored(_shingled(docs, "token long, key long, size long", names, prefixes), "prefixes")
    ends = rows.groupBy("token").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo <> hi")
    shared = stored(rows.join(ends.select("token"), "token", "left_semi").distinct(), "shared")

    def keyed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            made = [key_of(shingles(raw)) for raw in batch.column("raw").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.int64()), batch.column("raw")], ["key", "raw"])

    texts = docs.select(F.col("text").cast("string").cast("binary").alias("raw")).mapInArrow(keyed, "key long, raw binary")
    wanted = shared.select("key").distinct()
    texts = texts.join(wanted, "key", "left_semi").groupBy("key").agg(F.first("raw").alias("found"))

    def whole(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = [shingles(raw).tobytes() for raw in batch.column("found").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.binary())], ["key", "found"])

    sets = stored(texts.mapInArrow(whole, "key long, found binary"), "sets")

    def check(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= similar * (len(x) + len(y) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    def verified(pairs: DataFrame, round: int) -> DataFrame:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "size", "other")
        pairs = pairs.groupBy("a", "b").agg(
            F.count("*").alias("n"), F.max(F.col("size") + F.col("other")).alias("sizes"), F.max(F.greatest("size", "other")).alias("most")
        )
        # what two sets share is in both prefixes, or behind the prefix of that whose prefix ends first
        behind = F.ceil(F.lit(similar) * F.col("most") - 1e-9) - 1
        pairs = pairs.where(F.col("n") + behind >= F.lit(similar / (1 + similar)) * F.col("sizes") - 1e-6)
        pairs = pairs.join(sets.select(F.col("key").alias("a"), F.col("found").alias("x")), "a")
        pairs = pairs.join(sets.select(F.col("key").alias("b"), F.col("found").alias("y")), "b")
        return stored(pairs.select("a", "b", "x", "y").mapInArrow(check, "a long, b long"), f"links{round}")

    near = (F.col("size") >= F.lit(similar) * F.col("other") - 1e-9) & (F.col("other") >= F.lit(similar) * F.col("size") - 1e-9)
    # the stars see a pair at some of its shingles only and may pass it over, the last round at all
    found, parted = None, shared.withColumn("root", F.col("key"))
    for round in range(STARS + 1):
        if round < STARS:
            hub = F.min(F.struct(F.xxhash64("key", F.lit(round)), "key", "size", "root")).alias("hub")
            hubs = parted.groupBy("token").agg(hub).select("token", F.col("hub.key").alias("b"), F.col("hub.size").alias("other"), F.col("hub.root").alias("there"))
            pairs = parted.join(hubs, "token").where(F.col("root") != F.col("there"))
        else:
            others = parted.select("token", F.col("key").alias("b"), F.col("size").alias("other"), F.col("root").alias("there"))
            pairs = parted.join(others, "token").where(F.col("root") < F.col("there"))
        new = verified(pairs.where(near).select(F.col("key").alias("a"), "b", "size", "other"), round)
        found = new if found is None else found.unionByName(new)
        roots = components(found)
        if round < STARS:
            root = roots.withColumnRenamed("node", "key")
            parted = shared.join(root, "key", "left").withColumn("root", F.coalesce("root", "key"))
            # shingles whose texts are all in one component tell nothing more
            apart = parted.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
            parted = stored(parted.join(apart.select("token"), "token", "left_semi"), "apart")
    return roots


def representatives(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One row of ``docs(doc_id, text, ...)``, with all its columns, of each component of
    near-duplicates: that of the smallest doc_id.

    Texts are linked if their sets of ``SHINGLE``-word shingles have a Jaccard similarity of at
    least ``similar``; every such pair is found. NULL texts and those without words are copies of
    each other. Only rows of one component compete, so rows of one doc_id whose texts are in
    several components may each stay; of several of one component one does. Rows with a NULL doc_id
    are in no group and stay.
    """
    text = F.col("text").cast("string")
    marked = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("keep_id"), F.xxhash64(text).alias("keep_tag"), F.struct(*docs.columns).alias("doc"))

    def keys(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            made = [key_of(shingles(raw)) for raw in batch.column("raw").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("keep_id"), batch.column("keep_tag"), pa.array(made, pa.int64())],
                ["keep_id", "keep_tag", "key"],
            )

    raw = F.col("doc.text").cast("string").cast("binary").alias("raw")
    rows = marked.select("keep_id", "keep_tag", raw).mapInArrow(keys, "keep_id long, keep_tag long, key long")
    rows = rows.groupBy("keep_id", "keep_tag", "key").agg(F.count("*").alias("keep_rows"))
    least = F.min(F.struct("keep_id", "keep_tag", "keep_rows")).alias("least")
    nodes = stored(rows.groupBy("key").agg(least), "nodes")
    roots = links(docs.where("doc_id IS NOT NULL"), similar).withColumnRenamed("node", "key")
    groups = nodes.join(roots, "key", "left").groupBy(F.coalesce("root", "key").alias("root"))
    chosen = stored(groups.agg(F.min("least").alias("least")).select("least.*"), "chosen")
    kept = marked.join(chosen, ["keep_id", "keep_tag"])
    first = Window.partitionBy("keep_id", "keep_tag").orderBy(F.xxhash64("doc"))
    again = kept.where("keep_rows > 1").withColumn("at", F.row_number().over(first)).where("at = 1")
    kept = kept.where("keep_rows = 1").select("doc").unionByName(again.select("doc"))
    kept = kept.unionByName(docs.where("doc_id IS NULL").select(F.struct(*docs.columns).alias("doc")))
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
