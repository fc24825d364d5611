import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sensorloom.llm import langid


def grams(text):
    text = " " + " ".join(text.lower().split()) + " "
    return Counter(text[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1))


@pytest.mark.parametrize("text", ["", "a", "Ärger  Ähre\nÄ", "日本語 テキスト", "x" * 500, "né né né", "🙂 𝔘nicode"])
def test_counts_are_of_code_points(text):
    """As many different n-grams, as often, as strings of code points have."""
    at, n = langid.counts(text, 1 << 62)
    expected = grams(text)
    assert sorted(n.tolist()) == sorted(expected.values()) and len(at) == len(expected)


def test_scripts_of_several_bytes_a_letter(spark):
    """Two languages of one such script that differ in the order of letters alone."""
    rng = random.Random(3)
    letters = "कखगघचछजझटठ"
    follow = [{a: rng.sample(letters, 3) for a in letters} for _ in range(2)]

    def word(lang):
        out = rng.choice(letters)
        while len(out) < 6:
            out += rng.choice(follow[lang][out[-1]])
        return out

    rows = [(i, " ".join(word(i % 2) for _ in range(25)), f"l{i % 2}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = [r for r in langid.predictions(docs).collect() if r.held_out]
    right = sum(r.lang_pred == f"l{r.doc_id % 2}" for r in found)
    assert len(found) > 150 and right >= 0.98 * len(found)


def plain_ftrl(rows, labels, k, epochs, order):
    """The same learner in dictionaries, one weight at a time."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(f, c):
        v = z[f, c]
        if abs(v) <= langid.LASSO:
            return 0.0
        rate = (langid.BETA + math.sqrt(n[f, c])) / langid.ALPHA + langid.RIDGE
        return -(v - math.copysign(langid.LASSO, v)) / rate

    for e in range(epochs):
        for i in order[e]:
            x, y = rows[i], labels[i]
            w = {(f, c): weight(f, c) for f in x for c in range(k)}
            scores = [sum(v * w[f, c] for f, v in x.items()) for c in range(k)]
            top = max(scores)
            e_ = [math.exp(s - top) for s in scores]
            for c in range(k):
                p = e_[c] / sum(e_) - (c == y)
                for f, v in x.items():
                    g = p * v
                    sigma = (math.sqrt(n[f, c] + g * g) - math.sqrt(n[f, c])) / langid.ALPHA
                    z[f, c] += g - sigma * w[f, c]
                    n[f, c] += g * g
    return weight


def test_learner_against_a_plain_one():
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(60):
        at = np.sort(rng.choice(30, 6, replace=False))
        rows.append((at, rng.random(6)))
        labels.append(int(at[0]) % 3)
    model = langid.Model(["a", "b", "c"], np.ones(30, np.float32), np.zeros((30, 3)), np.zeros(3))
    langid.train(rows, np.array(labels), model)
    random_ = np.random.default_rng(0)
    order = [random_.permutation(len(rows)) for _ in range(langid.EPOCHS)]
    dicts = [{**dict(zip(at.tolist(), v.tolist())), 30: 1.0} for at, v in rows]
    weight = plain_ftrl(dicts, labels, 3, langid.EPOCHS, order)
    expected = np.array([[weight(f, c) for c in range(3)] for f in range(31)])
    assert np.allclose(model.weights, expected[:30], atol=1e-5)
    assert np.allclose(model.bias, expected[30], atol=1e-9)


def test_lasso_keeps_weights_at_zero(monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(np.arange(20), rng.random(20)) for _ in range(40)]
    labels = rng.integers(0, 2, 40)
    zeros = []
    for lasso in (0.0, 0.5, 100.0):
        monkeypatch.setattr(langid, "LASSO", lasso)
        model = langid.Model(["a", "b"], np.ones(20, np.float32), np.zeros((20, 2)), np.zeros(2))
        langid.train(rows, labels, model)
        zeros.append(int((model.weights == 0).sum()))
    assert zeros[0] < zeros[1] < zeros[2] == 40


@pytest.mark.parametrize("scale", [0.2, 1.0, 7.0])
def test_temperature_undoes_a_scale(scale):
    """Labels drawn from the softmax of logits, which are then scaled."""
    rng = np.random.default_rng(6)
    logits = rng.normal(0, 2, (4_000, 3))
    p = langid.softmax(logits)
    labels = (rng.random(4_000)[:, None] > p.cumsum(axis=1)).sum(axis=1)
    assert langid.temperature(logits * scale, labels) == pytest.approx(scale, rel=0.15)
    assert langid.temperature(np.zeros((0, 3)), labels[:0]) == 1.0


def rows_of(rng, n):
    words = {"xa": ["bada", "dabo", "obad"], "yb": ["klikt", "tilk", "kitl"]}
    return [(i, " ".join(rng.choices(words[lang], k=12)), lang) for i in range(n) for lang in [("xa", "yb")[i % 2]]]


def test_repeated_rows_ties_long_texts_and_names(spark):
    rng = random.Random(8)
    rows = rows_of(rng, 200)
    rows += [rows[3]] * 400 + [(900, "bada dabo " * 200_000, None), (901, "x" * 300_000, None), (902, "12 34", "xa"),
             (903, None, "yb"), (None, "klikt tilk", "yb"), (904, "", None)]
    docs = spark.createDataFrame(
        [(*row, "n", 1.0, True, "z") for row in rows],
        "doc_id long, text string, lang string, lang_pred string, score double, held_out boolean, rank string",
    )
    found = langid.predictions(docs)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows_found = found.collect()
    assert len(rows_found) == len(rows)
    by_id = {r.doc_id: r for r in rows_found}
    assert len({tuple(r) for r in rows_found if r.doc_id == 3}) == 1
    assert by_id[900].lang_pred == "xa" and by_id[None].lang_pred == "yb" and not by_id[None].held_out
    assert {by_id[i].lang_pred for i in (902, 903, 904)} == {"und"}
    assert all(0 <= r.score <= 1 for r in rows_found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows_found if r.doc_id is not None)
    # repeated rows of one id teach as one
    plain = langid.fit(spark.createDataFrame(rows[:200], "doc_id long, text string, lang string"))
    often = langid.fit(spark.createDataFrame(rows[:200] + [rows[3]] * 400, "doc_id long, text string, lang string"))
    assert plain.languages == often.languages == ["xa", "yb"]
    assert np.argmax(plain.logits(*plain.vector("klikt"))) == np.argmax(often.logits(*often.vector("klikt"))) == 1


def test_a_tie_goes_to_the_first_language():
    model = langid.Model(["a", "b"], np.ones(64, np.float32), np.zeros((64, 2)), np.zeros(2))
    assert model.predict("text") == ("a", 0.5)
