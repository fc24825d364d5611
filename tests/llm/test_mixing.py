import hashlib
import math
from collections import Counter, defaultdict

import pytest

from sensorloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, mix_rank string"


def chance(*parts):
    text = "\x1f".join("\x1e" if p is None else str(p) for p in parts)
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def plain_mix(rows, budget=None, entropy=0.9, repeats=None, blocks=8, seed=0):
    """rows: (doc_id, text, source) -> Counter of (doc_id, epoch, block, rank), and the weights."""
    docs = [(id, len((text or "").encode().split()), "n" if s is None else "s" + s) for id, text, s in rows]
    tokens = Counter()
    for _, n, key in docs:
        tokens[key] += n
    tokens = {k: n for k, n in tokens.items() if n}
    budget = sum(tokens.values()) if budget is None else budget

    def weights(a):
        power = {k: n**a for k, n in tokens.items()}
        return {k: p / sum(power.values()) for k, p in power.items()}

    def good(a):
        w = weights(a)
        if repeats is not None:
            return max(budget * w[k] / tokens[k] for k in w) <= repeats
        top = math.log(len(w))
        return top == 0 or -sum(p * math.log(p) for p in w.values()) / top >= entropy

    if repeats is not None:
        a = next((i / 4096 for i in range(4097) if good(i / 4096)), 1.0)
    else:
        a = next((i / 4096 for i in range(4096, -1, -1) if good(i / 4096)), 0.0)
    w = weights(a)
    out = Counter()
    for key, share in w.items():
        quota = round(share * budget)
        epochs = quota // tokens[key]
        left = quota - epochs * tokens[key]
        sizes, members = Counter(), defaultdict(lambda: defaultdict(list))
        for id, n, k in docs:
            if k == key:
                h = chance(seed, id)
                sizes[h % blocks] += n
                members[h % blocks][h].append((id, n))
        for epoch in range(epochs):
            for b in members:
                for same in members[b].values():
                    for id, _ in same:
                        out[id, epoch, b, chance(seed, "order", epoch, key, b)] += 1
        for b in sorted(members, key=lambda b: (chance(seed, "order", epochs, key, b), b)):
            inside = left
            whole = left >= sizes[b]
            for h in sorted(members[b]):
                if (left > 0 and whole) or (not whole and inside > 0):
                    for id, n in members[b][h]:
                        out[id, epochs, b, chance(seed, "order", epochs, key, b)] += 1
                    inside -= sum(n for _, n in members[b][h])
            left -= sizes[b]
    return out, w


def some_rows():
    rows = []
    for i in range(240):
        source = "hot" if i % 3 else ("web", "wiki", None, "tiny")[i // 3 % 4]
        rows.append((i, " ".join(["w"] * (1 + i * 7 % 23)), source))
    rows += [(7, rows[7][1], "hot"), (300, None, "web"), (301, "", "void"), (None, "a b", "wiki")]
    return rows


@pytest.mark.parametrize(
    "options", [{}, {"entropy": 0.99}, {"entropy": None, "repeats": 2.0, "budget": 5_000.0}]
)
def test_against_a_plain_mix(spark, options):
    rows = some_rows()
    docs = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    got = mixing.mixed(docs, blocks=8, **options).collect()
    want, weights = plain_mix(rows, **options)
    # the plain version looks at 4,097 exponents alone: at a boundary a document may differ
    have = Counter((r.doc_id, r.mix_epoch, r.mix_block, r.mix_rank) for r in got)
    assert sum((have - want).values()) + sum((want - have).values()) <= len(weights)
    for r in got:
        key = "n" if r.source is None else "s" + r.source
        assert abs(r.mix_weight - weights[key]) < 1e-3


def test_quotas_are_met_to_one_document(spark):
    rows = some_rows()
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = mixing.mixed(docs, budget=9_000.0, blocks=8).collect()
    taken, weights, longest = Counter(), {}, Counter()
    for r in got:
        taken[r.source] += r.mix_tokens
        weights[r.source] = r.mix_weight
        longest[r.source] = max(longest[r.source], r.mix_tokens)
    assert "void" not in taken
    assert abs(sum(weights.values()) - 1) < 1e-9
    for source, weight in weights.items():
        # a repeated row shares its hash: both copies are taken together
        assert 0 <= taken[source] - round(weight * 9_000) < 2 * longest[source]


def test_no_rows_and_no_tokens(spark):
    assert mixing.mixed(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([(1, None, "a", "x"), (2, " ", None, "x")], SCHEMA)
    assert mixing.mixed(docs).collect() == []


def test_one_source_is_taken_whole(spark):
    rows = [(i, "a b c", "only", "x") for i in range(50)]
    got = mixing.mixed(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.doc_id for r in got) == list(range(50))
    assert {(r.mix_epoch, r.mix_weight) for r in got} == {(0, 1.0)}


def test_same_order_however_rows_are_dealt(spark):
    docs = spark.createDataFrame([(*r, "x") for r in some_rows()], SCHEMA)
    one, other = (
        sorted(map(str, mixing.mixed(docs.repartition(n), blocks=8).collect())) for n in (1, 7)
    )
    assert one == other
