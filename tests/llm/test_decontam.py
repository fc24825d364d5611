import random
import re

from sensorloom.llm import decontam


def plain_distance(item, text):
    """Sellers' table: least edits that turn ``item`` into any part of ``text``."""
    column = list(range(len(item) + 1))
    best = column[-1]
    for c in text:
        last, column[0] = column[0], 0
        for i, x in enumerate(item, 1):
            last, column[i] = column[i], min(column[i] + 1, column[i - 1] + 1, last + (x != c))
        best = min(best, column[-1])
    return best


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcdé ")
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, rng.choice("abcdé"))
    return "".join(out)


def test_distance_against_the_whole_table():
    rng = random.Random(3)
    for _ in range(300):
        item = "".join(rng.choices("abc", k=rng.randint(1, 90)))
        text = "".join(rng.choices("abc", k=rng.randint(0, 120)))
        want = plain_distance(item, text)
        for k in (0, 2, len(item)):
            assert decontam.distance(item, text, k) == (want if want <= k else None)


def test_pieces_cover_the_item():
    for n in (1, 5, 77):
        for k in range(n):
            parts = decontam.pieces("x" * n, k)
            assert len(parts) == k + 1 and all(p for _, p in parts)
            assert "".join(p for _, p in parts) == "x" * n


def whole(text, start, end):
    before, after = text[:start][-1:], text[end:][:1]
    return not (before.isalnum() and text[start].isalnum() or after.isalnum() and text[end - 1].isalnum())


def brute(docs, items, errors):
    out = []
    for id, text in docs:
        text = decontam.plain(text)
        for item_id, item in items:
            item = decontam.plain(item)
            if item_id is None or not item:
                continue
            d = plain_distance(item, text)
            if not decontam.budget(item, errors):
                places = (m.start() for m in re.finditer(f"(?={re.escape(item)})", text))
                d = min((0 for at in places if whole(text, at, at + len(item))), default=1)
            if d <= decontam.budget(item, errors):
                out.append((id, item_id, d))
    return sorted(out, key=str)


def test_matches_against_all_pairs(spark):
    rng = random.Random(11)
    words = ["abba", "cab", "dé", "bad", "add", "ace"]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(3, 14)))) for i in range(14)]
    items += [(14, ""), (15, None), (None, "abba cab"), (3, items[3][1])]
    docs = []
    for i in range(60):
        filler = [" ".join(rng.choices(words, k=rng.randint(0, 20))) for _ in range(2)]
        item = items[rng.randrange(14)][1]
        k = decontam.budget(item, 0.15)
        text = f"{filler[0]}  {edited(rng, item, rng.randint(0, k + 2)).upper()}\n{filler[1]}"
        docs.append((i, text.replace("É", "é")))
    docs += [(60, None), (61, ""), (None, items[0][1]), (5, docs[5][1])]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    table = spark.createDataFrame(items, "item_id long, text string")
    for pass_chars in (50, 1_000_000):
        got = decontam.matches(frame, table, 0.15, pass_chars).collect()
        got = sorted(((r.doc_id, r.item_id, r.edits) for r in got), key=str)
        assert got == brute(docs, items, 0.15)
    hit = {d for d, _, _ in brute(docs, items, 0.15)}
    kept = decontam.without_leaks(frame, table, 0.15, 50)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in hit)


def test_no_items_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a"), (None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.matches(docs, none).collect() == []
    assert decontam.without_leaks(docs, none).count() == 2
    items = spark.createDataFrame([(1, "a passage")], none.schema)
    assert decontam.matches(docs.where("false"), items).collect() == []


def test_a_long_text_holds_an_item_at_its_end(spark):
    item = "the quick brown fox jumps over the lazy dog and runs away from it"
    docs = spark.createDataFrame([(1, "word " * 200_000 + item.replace("lazy", "lacy"))], "doc_id long, text string")
    items = spark.createDataFrame([(9, item)], "item_id long, text string")
    assert [tuple(r) for r in decontam.matches(docs, items).collect()] == [(1, 9, 1)]


def test_short_items_are_whole_words(spark):
    items = spark.createDataFrame([(1, "yes"), (2, "E"), (3, "a b"), (4, "c++"), (5, "né")], "item_id long, text string")
    texts = ["the eyes of yesterday", "nothing here", "Yes, really: e=mc2", "yesyes yes", "extra best a  b.", "a bc++", "c++x", "née né", "x-yes"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontam.matches(docs, items).collect())
    assert got == [(2, 1), (2, 2), (3, 1), (4, 3), (6, 4), (7, 5), (8, 1)]
    assert got == sorted((d, i) for d, i, _ in brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], decontam.ERRORS))
    assert sorted(r.doc_id for r in decontam.without_leaks(docs, items).collect()) == [0, 1, 5]
