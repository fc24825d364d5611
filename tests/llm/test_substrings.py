import random

import brute
from sensorloom.llm.common import word_hashes
from sensorloom.llm import substrings


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert answer(substrings.digest(docs)) == brute.substrings(rows)


def test_random_texts_against_brute_force(spark):
    chance = random.Random(4)
    passages = [[chance.choice("abcdefgh") for _ in range(chance.randint(3, 30))] for _ in range(12)]
    rows = []
    for id in range(120):
        parts = [chance.choice(passages) for _ in range(chance.randint(0, 5))]
        words = [w if chance.random() > 0.02 else "x" for p in parts for w in p]
        rows.append((chance.randint(0, 100), chance.choice([" ", "\n\t", " \x0b"]).join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = answer(substrings.digest(docs, 10, 4))
    assert got == brute.substrings(rows, 10)
    assert sum(r[2] for r in got) > 300


def test_hard_cases(spark):
    passage = " ".join(f"w{i}" for i in range(50))
    rows = [
        (1, None), (2, ""), (3, passage), (4, passage.replace(" ", "\n")), (5, passage[:-3]),
        (6, "x " + passage + " y"), (6, "x " + passage + " y"), (None, passage), (7, "zz " * 90_000),
        (8, "zz " * 60), (9, passage + " " + passage),
    ]
    docs = spark.createDataFrame(
        [(i, t, "q", 1, "r") for i, t in rows],
        "doc_id long, text string, kept string, starts int, anchors string",
    )
    assert answer(substrings.digest(docs)) == brute.substrings(rows)
    cut = substrings.cut_documents(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    kept = {r.doc_id: r.text for r in cut.collect() if r.doc_id}
    assert kept[1] is None and kept[3] == passage and kept[4] == "" and kept[6] == "x y"
    assert substrings.digest(docs.limit(0)).collect() == []


def test_spans_are_maximal(spark):
    passage = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(1, passage), (2, f"a b {passage} c")], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in substrings.remove_repeats(docs).collect()}
    assert got == {1: [], 2: [[2, 82]]}


def test_words_that_agree_in_powers_of_any_base(spark):
    """The Thue-Morse sequence and its complement: equal in every polynomial modulo 2**64."""
    one = "a"
    for _ in range(10):
        one += one.translate(str.maketrans("ab", "ba"))
    two = one.translate(str.maketrans("ab", "ba"))
    words = [f"w{i}" for i in range(49)]
    rows = [(1, " ".join([*words, one])), (2, " ".join([*words, two])), (3, " ".join([*words, one]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substrings.digest(docs).collect()}
    assert got == {1: 0, 2: 0, 3: 50}
    assert len(set(word_hashes(f"{one} {two} {one}x {two}x".encode()).tolist())) == 4
