import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from sensorloom.llm import simhash
from sensorloom.llm.graph import components


def answer(df):
    return sorted(map(tuple, df.collect()))


def test_whole_table_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert answer(simhash.near_duplicates(docs)) == brute.near_duplicates(rows)


def test_hard_cases(spark):
    long = "alpha beta " * 60_000
    rows = [
        (9, None), (3, ""), (5, " \t\n"), (4, "one"), (8, "One"), (7, "two words"), (11, long),
        (10, long + "gamma"), (12, "É é"), (13, "é É"), (4, "one"), (20, "a b c d"),
    ]
    docs = spark.createDataFrame(
        [(i, t, "x", -1, None) for i, t in rows],
        "doc_id long, text string, print string, component_id int, root string",
    )
    got = answer(simhash.near_duplicates(docs))
    assert got == sorted(brute.near_duplicates(rows))
    assert (3, "0" * 16, 3) in got and (9, "0" * 16, 3) in got
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c"), (2, "a b c"), (None, "z")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(None, 2), (2, 2), (None, None)}


@pytest.mark.parametrize("shard, blocks", [(4, False), (16, True), (4096, False)])
def test_links_join_what_all_pairs_join(spark, monkeypatch, shard, blocks):
    random = np.random.default_rng(3)
    if blocks:
        monkeypatch.setattr(simhash, "VISITORS", 50)
        monkeypatch.setattr(simhash, "BLOCK", 8)
    seeds = random.integers(0, 1 << 63, 60, dtype=np.uint64)
    values = np.concatenate([seeds, *[seeds ^ (np.uint64(1) << random.integers(0, 64, 60, dtype=np.uint64)) for _ in range(6)]])
    chain = np.cumsum(np.uint64(7) << np.arange(0, 60, 3, dtype=np.uint64), dtype=np.uint64)
    values = np.unique(np.concatenate([values, chain, [np.uint64(0)]]))
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "print long").repartition(3)
    got = simhash.links(frame, shard=shard).collect()
    at = {int(v): i for i, v in enumerate(values.view(np.int64))}
    pairs = [
        (i, j)
        for i in range(len(values))
        for j in range(i + 1, len(values))
        if np.bitwise_count(values[i] ^ values[j]) <= 3
    ]
    assert brute.roots(len(values), [(at[r.a], at[r.b]) for r in got]) == brute.roots(len(values), pairs)
    assert len(got) < 8 * len(values)


def test_components(spark):
    random = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in random.integers(0, 400, (260, 2))]
    pairs += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 50)]
    frame = spark.createDataFrame([*pairs, (None, 3), (5, 5)], "a long, b long")
    nodes = sorted({x for p in pairs for x in p})
    at = {x: i for i, x in enumerate(nodes)}
    root = brute.roots(len(nodes), [(at[a], at[b]) for a, b in pairs])
    expected = {(x, nodes[root[i]]) for i, x in enumerate(nodes) if root[i] != i}
    assert {tuple(r) for r in components(frame).collect()} == expected
    assert components(frame.limit(0)).collect() == []


@pytest.mark.parametrize("kind", ["string", "binary", "int"])
def test_components_of_hubs_and_other_kinds(spark, kind):
    """A node with most of the links, a chain through it, and nodes that are no long numbers."""
    pairs = [(5_000, i) for i in range(600)] + [(i, 6_000 + i) for i in range(0, 600, 7)]
    pairs += [(7_000 + i, 7_001 + i) for i in range(30)] + [(7_030, 9_000 + i) for i in range(400)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    if kind != "int":
        frame = frame.select(*[F.lpad(F.col(c).cast("string"), 5, "0").cast(kind).alias(c) for c in "ab"])
    else:
        frame = frame.select(F.col("a").cast("int"), F.col("b").cast("int"))
    found = components(frame)
    assert dict(found.dtypes) == {"node": kind, "root": kind}
    got = {int(n): int(r) for n, r in (map(as_text, row) for row in found.collect())}
    first = {i for pair in pairs for i in pair if i < 7_000} - {0}
    second = {i for pair in pairs for i in pair if i > 7_000}
    assert got == dict.fromkeys(first, 0) | dict.fromkeys(second, 7_000)


def as_text(value):
    return bytes(value).decode() if isinstance(value, (bytes, bytearray)) else str(value)


def test_representatives_keep_a_component_whose_id_has_a_copy_elsewhere(spark):
    a, b = "alpha beta gamma delta epsilon zeta", "one two three four five six seven"
    rows = [(1, a), (2, a), (2, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(simhash.representatives(docs)) == [(1, a), (2, b)]
