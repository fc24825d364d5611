import math
import re
import zlib
from collections import Counter

import numpy as np

from sensorloom.llm import maxent

SCHEMA = "doc_id long, text string, n long"


def words(text):
    raw = (text or "").encode().lower()
    return [w for w in re.split(rb"[\x20\x09-\x0D]+", raw) if w] + [None]


def test_counts_and_base_against_brute_force(spark):
    rows = [(i, f"Alpha beta {'gamma ' * (i % 4)}w{i % 7}\tö{i}", i) for i in range(60)]
    rows += [(60, None, 0), (61, "", 0), (62, " \n ", 0), (63, "alpha " * 9_000, 0), (None, "beta new", 0), (3, "beta", 0), (3, "beta", 0)]
    learned = Counter()
    for id, text, _ in rows:
        if id is not None and zlib.crc32(str(id).encode()) % 10:
            learned.update(words(text))
    total, distinct = sum(learned.values()), len(learned)
    want = []
    for id, text, _ in rows:
        held = id is not None and zlib.crc32(str(id).encode()) % 10 == 0
        base = sum(math.log10((learned[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words(text))
        want.append((id, held, len(words(text)), sum(w in learned for w in words(text)), total, round(base, 6)))
    out = maxent.predictions(spark.createDataFrame(rows, SCHEMA)).collect()
    got = [(*r[:5], round(r.base_score, 6)) for r in out]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)


def test_empty_table(spark):
    assert maxent.predictions(spark.createDataFrame([], SCHEMA)).collect() == []


def test_class_shares_and_words_sum_to_one():
    counts = np.arange(1, 200)
    hashes = np.random.default_rng(1).integers(1, 2**63, len(counts)).astype(np.uint64)
    rare = 17  # distinct words that are not among the frequent ones, each seen once
    words = maxent.Vocabulary.of(int(counts.sum()) + rare, len(counts) + rare, hashes, counts)
    shares = np.bincount(words.classes, words.counts + 0.1, len(words.log_mass))
    shares[1] += rare * 1.1 + 0.1
    mass = np.exp(words.log_mass)
    used = shares > 0
    assert np.allclose(shares[used], mass[used])
    assert (words.look_up(hashes)[0] == counts).all() and words.look_up(hashes + np.uint64(1))[0].sum() == 0
    model = maxent.Model(words.log_mass)
    rows = maxent.features(hashes)
    model.learn(rows, words.look_up(hashes)[1])
    assert np.allclose(np.exp(model.log_classes(rows)).sum(axis=1), 1, atol=1e-4)


def test_texts_together_have_the_features_of_each_alone():
    texts = [b"a b c d", b"", None, b"one", b"a b", b"x " * 5_000, b"tail of it"]
    alone = np.concatenate([maxent.features(maxent.tokens(t)) for t in texts])
    for least in (1, 7, 6_000, 1_000_000):
        parts = list(maxent.joined(iter(texts), least))
        assert np.array_equal(np.concatenate([maxent.features(*part) for part in parts]), alone)
        assert sum(len(starts) for _, starts in parts) == len(texts)
    assert list(maxent.joined(iter([]))) == []


def test_a_score_does_not_hang_on_the_texts_beside(spark):
    rows = [(i, f"w{i % 5} v{i % 3} " * (1 + i % 40), 0) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    counts = maxent.word_counts(docs).checkpoint()
    words = maxent.vocabulary(counts)
    model = maxent.train(docs, words, 1)
    every = {r.doc_id: r for r in maxent.scored(docs, counts, words, model).collect()}
    one = maxent.scored(docs.where("doc_id = 77"), counts, words, model).first()
    assert one.n_tokens == every[77].n_tokens and abs(one.score - every[77].score) < 1e-3


def test_context_lowers_the_loss_on_held_out_rows(spark):
    random = np.random.default_rng(0)
    rows = []
    for i in range(400):
        text = " ".join(f"k{n} v{n}" for n in random.integers(0, 20, 60))
        rows.append((i, text, 0))
    out = [r for r in maxent.predictions(spark.createDataFrame(rows, SCHEMA)).collect() if r.held_out]
    assert sum(r.score for r in out) > 0.8 * sum(r.base_score for r in out)
