import random

import pytest

import brute
from sensorloom.llm import shingles
from sensorloom.llm.common import table


def sets_of(text):
    words = brute.low(text).split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def kept(rows):
    """rows: (doc_id, text) with distinct ids -> ids that brute-force Jaccard keeps."""
    rows = sorted(rows)
    sets = [sets_of(t) for _, t in rows]
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    pairs = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if alike(sets[i], sets[j])]
    root = brute.roots(len(rows), pairs)
    return [r[0] for i, r in enumerate(rows) if root[i] == i]


def edited(words, edits, draw):
    words = list(words)
    for at in draw.sample(range(len(words)), edits):
        words[at] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def test_stage_against_brute_force_on_a_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = sorted(r.doc_id for r in shingles.representatives(docs).collect())
    assert got == kept([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("seen", [1, 16])
def test_stage_against_brute_force_on_edited_copies(spark, sf_dir, monkeypatch, seen):
    monkeypatch.setattr(shingles, "SEEN", seen)
    draw = random.Random(4)
    line = " ".join(f"common{i}" for i in range(12))
    texts = [None, "", " \n", "one", "One", "one two three four", "one two three four five", line]
    for n in (6, 10, 11, 25, 26, 60, 140, 300):
        base = [f"w{draw.randrange(10**6)}" for _ in range(n)]
        texts += [edited(base, min(n, e), draw) for e in (0, 1, 1, 2, 3, 4, 5, 7)]
        texts += [" ".join(base) + " " + line, " ".join(base[: int(n * 0.8)]), " ".join(base[: int(n * 0.8) + 1])]
    base = [f"v{i}" for i in range(100)]
    texts += [edited(base, 1 + i % 3, draw) for i in range(60)]
    rows = list(zip(draw.sample(range(10**6), len(texts)), texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(r.doc_id for r in shingles.representatives(docs).collect())
    assert got == kept(rows)


def test_rows_of_one_id_compete_inside_their_component_only(spark, sf_dir):
    a, b = " ".join(f"a{i}" for i in range(20)), " ".join(f"b{i}" for i in range(20))
    rows = [(1, a, 0), (2, a, 1), (2, b, 2), (2, b, 2), (3, b, 3), (None, a, 4), (None, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = shingles.representatives(docs).collect()
    assert sorted(r.n for r in got) == [0, 2, 4, 5]
    assert shingles.representatives(docs.limit(0)).collect() == []
