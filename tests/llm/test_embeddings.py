import math

import numpy as np
import pytest

import brute
from sensorloom.llm import embeddings


def answer(df):
    return sorted(map(tuple, df.collect()))


def test_whole_table_against_brute_force(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    assert answer(embeddings.near_vectors(vectors)) == brute.close_vectors(rows)


@pytest.mark.parametrize("interval, visitors, block", [(40, 10**6, 512), (25, 30, 8)])
def test_clusters_against_brute_force(spark, monkeypatch, interval, visitors, block):
    monkeypatch.setattr(embeddings, "VISITORS", visitors)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    random = np.random.default_rng(2)
    centres = random.normal(size=(12, 6))
    data = [c + random.normal(size=6) * s for c in centres for s in (0.02, 0.2, 0.5) for _ in range(8)]
    data += [centres[0] + random.normal(size=6) * 1e-4 for _ in range(150)]  # one hot cell
    data += data[:20]
    rows = [(i * 3, [float(x) for x in v]) for i, v in enumerate(data)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = answer(embeddings.near_vectors(frame, interval=interval))
    assert got == brute.close_vectors(rows)


def test_hard_cases(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [math.nan, 1.0]), (6, [math.inf, 1.0]),
        (7, [1.0, 0.0]), (8, [5.0, 0.0]), (9, [-1.0, 0.0]), (10, [1.0, 0.0]), (11, [1.0, 0.0, 0.0]),
        (12, [1e300, 1e299]), (13, [1e-300, 1e-301]), (14, [0.9, math.sqrt(1 - 0.81)]),
    ]
    frame = spark.createDataFrame(
        [(i, v, "n", 1) for i, v in rows], "vec_id long, embedding array<double>, node string, least int"
    )
    got = answer(embeddings.near_vectors(frame))
    units = {12: [1.0, 0.1], 13: [1.0, 0.1]}  # the plain version overflows
    assert got == brute.close_vectors([(i, units.get(i, v)) for i, v in rows])
    assert embeddings.near_vectors(frame.limit(0)).collect() == []
    again = spark.createDataFrame([(1, [1.0]), (1, [1.0]), (None, [1.0])], "vec_id long, embedding array<float>")
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(again).collect()) == [
        (0, 0, None, True), (1, 1, 1, True), (1, 1, 1, True)
    ]
