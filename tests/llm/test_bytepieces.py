import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorloom.llm import bytepieces

RANKS = {token: rank for rank, token in enumerate(bytepieces.read_vocabulary())}
PLAIN = tiktoken.Encoding(
    "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)


def expected(rows):
    out = []
    for id, text in rows:
        ids = PLAIN.encode_ordinary(text or "")
        raw = PLAIN.decode_bytes(ids)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        out.append((id, len(ids), digest, hashlib.sha256(raw).hexdigest()))
    return sorted(out, key=str)


def answer(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_table_as_the_plain_library(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert answer(bytepieces.digests(docs)) == expected(rows)


def test_hard_cases(spark):
    rows = [
        (1, None), (2, ""), (2, ""), (None, "a"), (3, " \t\n \r\n  x"), (4, "a" * 300_000),
        (5, "né é́ 日本語 🙂‍🙂 \x00\x7f <unk> <|endoftext|> ▁ Ā"), (6, "word " * 60_000),
        (7, "I'll we've 12345678 !!!??    z"), (8, "-" * 5_000 + "=" * 5_000),
    ]
    docs = spark.createDataFrame(
        [(i, t, -1, "x", None) for i, t in rows],
        "doc_id long, text string, n_tokens int, ids string, ids_sha256 binary",
    )
    assert answer(bytepieces.digests(docs)) == expected(rows)
    assert bytepieces.digests(docs.limit(0)).collect() == []


def test_round_trip_and_bytes_that_are_no_text(spark):
    pieces = bytepieces.BytePieces.read()
    frame = spark.createDataFrame([(b"ok \xff\xfe caf\xc3",), (b"plain",), (None,)], "raw binary")
    ids = frame.select(F.col("raw").cast("string").alias("text")).select(
        "text", pieces.encode(F.col("text")).alias("ids")
    )
    decoded = ids.select(pieces.decode(F.col("ids"))).collect()
    assert [bytes(r[0]) for r in decoded] == ["ok �� caf�".encode(), b"plain", b""]
    nothing = spark.createDataFrame([(None,), ([],), ([0, 1],)], "ids array<int>")
    back = nothing.select(pieces.decode(F.col("ids"))).collect()
    assert [r[0] and bytes(r[0]) for r in back] == [None, b"", b"!\""]


def test_every_token_is_the_piece_of_its_rank():
    model = bytepieces.serialised(bytepieces.read_vocabulary())
    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    for token, rank in RANKS.items():
        assert processor.piece_to_id(bytepieces.as_letters(token)) == rank
        assert bytepieces.as_bytes(processor.id_to_piece(rank)) == token
        assert processor.get_score(rank) == -rank
    assert processor.unk_id() == len(RANKS) and processor.bos_id() == -1


ENCODER = bytepieces.Encoder(bytepieces.serialised(bytepieces.read_vocabulary()), bytepieces.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_as_the_plain_library(text):
    raw = text.encode("utf-8", "replace")
    ids = ENCODER(raw)
    found = [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)]
    assert found == PLAIN.encode_ordinary(raw.decode())


def test_another_vocabulary_and_what_is_remembered(spark, tmp_path, monkeypatch):
    """Merges in an order of their own, and a worker that forgets all the time."""
    tokens = [bytes([b]) for b in range(256)] + [b"bc", b"ab", b"abc", b"aa", b"aaaa", b"ca", b"cbcb"]
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(b"%s %d\n" % (base64.b64encode(t), i) for i, t in enumerate(tokens)))
    own = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks={t: i for i, t in enumerate(tokens)},
        special_tokens={},
    )
    rng = random.Random(3)
    texts = ["cbcb", " cbcb", *["".join(rng.choice("abc ") for _ in range(40)) for _ in range(200)]]
    monkeypatch.setattr(bytepieces, "REMEMBERED", 2)
    encoder = bytepieces.Encoder(bytepieces.serialised(bytepieces.read_vocabulary(path)), bytepieces.PATTERN)
    for text in texts:
        assert np.frombuffer(encoder(text.encode()), "<i4").tolist() == own.encode_ordinary(text)
    pieces = bytepieces.BytePieces.read(path)
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = frame.select("t", pieces.encode(F.col("t")).alias("ids")).collect()
    assert all(r.ids == own.encode_ordinary(r.t) for r in got)


def test_faulty_vocabularies(tmp_path):
    path = tmp_path / "v"
    path.write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError, match="ranks"):
        bytepieces.read_vocabulary(path)
    path.write_bytes(b"YQ== 0\nYg== 1\n")
    with pytest.raises(ValueError, match="254 bytes"):
        bytepieces.read_vocabulary(path)


def test_texts_are_encoded_once(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = bytepieces.digests(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ids(cast(text") == 1 and plan.count("ArrowEvalPython") == 2, plan
