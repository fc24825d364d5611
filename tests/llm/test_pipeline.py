from collections import defaultdict

import corpus_pipeline
from sensorloom.llm import decontam, langid, simhash, toxicity
from sensorloom.llm.common import table


def test_representatives_against_all_pairs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: simhash.fingerprint((t or "").encode()) for i, t in rows.items()}
    root = {i: i for i in rows}
    changed = True
    while changed:
        changed = False
        for a in rows:
            for b in rows:
                if root[b] < root[a] and (prints[a] ^ prints[b]).bit_count() <= 3:
                    root[a], changed = root[b], True
    want = sorted(i for i in rows if root[i] == i)
    assert sorted(r.doc_id for r in simhash.representatives(docs).collect()) == want


def test_representatives_of_repeated_and_missing_ids(spark):
    text = "one two three four five six"
    rows = [(2, text, 1), (2, "a " + text, 2), (2, text, 1), (5, text, 3), (None, text, 4), (None, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep int")
    got = sorted((str(r.doc_id), str(r.text)) for r in simhash.representatives(docs).collect())
    assert got == [("2", text if text < "a " + text else "a " + text), ("None", "None"), ("None", text)]


def test_leaks_are_dropped_and_clean_documents_stay(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    hit = {r.doc_id for r in decontam.matches(docs, items).collect()}
    exact = set()
    for r in docs.collect():
        text = decontam.plain(r.text)
        if any(decontam.plain(i.text) in text for i in items.collect() if decontam.plain(i.text)):
            exact.add(r.doc_id)
    assert exact <= hit
    kept = {r.doc_id for r in decontam.without_leaks(docs, items).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - hit


def test_all_stages_keep_whole_rows(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "text", "lang", "source", "n_chars", "mix_weight"} <= set(out.columns)
    weights = defaultdict(set)
    for r in out.select("source", "mix_weight").collect():
        weights[r.source].add(r.mix_weight)
    assert all(len(w) == 1 for w in weights.values())


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = langid.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert sum(r.lang_pred == r.lang for r in out) >= 0.97 * len(out)
    out = toxicity.predictions(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in out) >= 0.9 * len(out)


def test_classifiers_on_empty_and_missing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert langid.predictions(empty).collect() == []
    assert toxicity.predictions(empty, labels).collect() == []
    docs = spark.createDataFrame([(1, None, None), (None, "", "en"), (2, "12 34", None)], empty.schema)
    assert {r.lang_pred for r in langid.predictions(docs).collect()} == {"und"}
    assert all(0 <= r.score <= 1 for r in toxicity.predictions(docs, labels).collect())
