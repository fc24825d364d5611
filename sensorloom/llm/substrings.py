"""Removal of passages that an earlier document already has."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import WORD, Spans, batches, looked_up, stored, word_digests, word_hashes

#: Words in a window, and in the shorter spans of which each window picks its smallest.
WINDOW, SPAN = 50, 12

_FIRST, _SECOND, _SHORT = Spans(0x2545F4914F6CDD1D), Spans(0x9E3779B97F4A7C15), Spans(0xD1342543DE82EF95)


def window_anchors(words: np.ndarray, window: int, span: int) -> np.ndarray:
    """For every window the smallest span hash inside it: equal windows have equal anchors."""
    if len(words) < window:
        return np.zeros(0, np.uint64)
    short = _SHORT.windows(words, span)
    return np.lib.stride_tricks.sliding_window_view(short, window - span + 1).min(axis=1)


def tag_of(raw: bytes | None) -> int:
    """Tells texts of one repeated doc_id apart; never zero."""
    return int.from_bytes(hashlib.blake2b(raw or b"", digest_size=7).digest(), "big") + 1


def _anchor_rows(window: int, span: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("tag", pa.int64()),
            ("content", pa.binary()),
            ("windows", pa.int64()),
            ("anchors", pa.list_(pa.int64())),
        ]
    )

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out = {"doc_id": batch.column("doc_id"), "tag": [], "content": [], "windows": [], "anchors": []}
            for raw in batch.column("raw").to_pylist():
                words = word_hashes(raw or b"")
                whole = len(words) >= window
                anchors = np.unique(window_anchors(words, window, span)).view(np.int64)
                content = hashlib.blake2b(b" ".join((raw or b"").split()), digest_size=16).digest()
                out["tag"].append(tag_of(raw))
                out["content"].append(content if whole else None)
                out["windows"].append(max(0, len(words) - window + 1))
                out["anchors"].append(anchors)
            yield batches(schema, out)

    return rows, "doc_id long, tag long, content binary, windows long, anchors array<long>"


def _window_rows(window: int, span: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("tag", pa.int64()),
            ("start", pa.int32()),
            ("h1", pa.int64()),
            ("h2", pa.int64()),
        ]
    )

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "raw", "many"))
            for id, raw, many, shared in zip(*columns, batch.column("shared")):
                if not shared.is_valid:
                    continue
                wanted = np.asarray(shared.values).view(np.uint64)
                anchors = window_anchors(word_hashes(raw or b""), window, span)
                at = np.flatnonzero(np.isin(anchors, wanted))
                if len(at):
                    # anchors only find candidates; what counts as equal goes by better hashes
                    first, second = word_digests(raw or b"").T
                    yield batches(
                        schema,
                        {
                            "doc_id": np.full(len(at), id),
                            "tag": np.full(len(at), tag_of(raw) if many else 0),
                            "start": at.astype(np.int32),
                            "h1": _FIRST.of(first, at, at + window).view(np.int64),
                            "h2": _SECOND.of(second, at, at + window).view(np.int64),
                        },
                    )

    return rows, "doc_id long, tag long, start int, h1 long, h2 long"


def _cut(window: int):
    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out = {"n_words": [], "n_removed": [], "kept": [], "spans": []}
            columns = (batch.column(c).to_pylist() for c in ("raw", "removed"))
            for raw, removed in zip(*columns):
                words = (raw or b"").split()
                spans, found = [], removed or []
                if any(r["tag"] for r in found):
                    own = tag_of(raw)
                    found = [r for r in found if r["tag"] == own]
                if any(r["starts"] is None for r in found):
                    spans = [[0, len(words)]]
                elif found:
                    at = np.sort(np.concatenate([r["starts"] for r in found]))
                    breaks = np.flatnonzero(np.diff(at) > window) + 1
                    spans = [[int(x[0]), int(x[-1]) + window] for x in np.split(at, breaks)]
                kept, end = [], 0
                for first, last in spans:
                    kept += words[end:first]
                    end = last
                kept += words[end:]
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["kept"].append(b" ".join(kept) if spans else raw)
                out["spans"].append(spans)
            types = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("other"),
                    *(pa.array(values, kind) for values, kind in zip(out.values(), types)),
                ],
                ["doc_id", "other", *out],
            )

    return rows, "n_words long, n_removed long, kept binary, spans array<array<long>>"


def remove_repeats(docs: DataFrame, window: int = WINDOW, span: int = SPAN) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, other, n_words, n_removed, kept, spans``.

    A word goes if a window of ``window`` words that covers it also starts in a document with a
    smaller doc_id; windows are judged on the input. ``spans`` are the maximal removed intervals
    (first word, word after the last). ``kept`` is the text: untouched where nothing goes, else
    the kept words joined by one space.

    Every window has a Rabin-Karp hash, counted in Spark. Only those can repeat whose anchor (the
    smallest hash of ``span`` words inside the window) stands in two documents, so anchors, one
    for about nineteen windows, are counted first, and the windows below shared anchors then, by
    128 bits. Documents of equal words are counted as the one with the smallest id. A window that
    stands in very many places, and a text of very many copies, are looked up by broadcast.

    A NULL text has no words and stays NULL; a text shorter than a window stays whole. A row
    with a NULL doc_id is neither before nor after any other: nothing of it goes and it makes
    nothing go. Rows of equal doc_id do not count against each other. All input columns but the
    text come along unchanged in the struct ``other``.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("raw"),
        F.struct(*[c for c in docs.columns if c != "text"]).alias("other"),
    )
    function, schema = _anchor_rows(window, span)
    per_text = stored(
        rows.where("doc_id IS NOT NULL").select("doc_id", "raw").mapInArrow(function, schema),
        "anchors",
    )
    # ids with several texts; elsewhere the id alone names the text
    many = (
        per_text.groupBy("doc_id")
        .agg((F.min("tag") < F.max("tag")).alias("many"))
        .where("many")
    )
    # one row per distinct sequence of words, that of the smallest id
    long_texts = per_text.where("content IS NOT NULL")
    firsts = long_texts.groupBy("content").agg(F.min(F.struct("doc_id", "anchors")).alias("first"))
    anchors = firsts.select("first.doc_id", F.explode("first.anchors").alias("anchor"))
    shared = (
        anchors.groupBy("anchor")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most")
        .select("anchor")
    )
    of_doc = (
        anchors.join(shared, "anchor")
        .groupBy("doc_id")
        .agg(F.collect_list("anchor").alias("shared"))
        .join(many, "doc_id", "left")
    )
    # both joins of the texts are left joins on the same columns of the same rows: Spark reuses
    # their exchange, so that texts are shuffled once; the windows are hashed again instead of kept
    function, schema = _window_rows(window, span)
    windows = rows.join(of_doc, "doc_id", "left").mapInArrow(function, schema)
    earliest = windows.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("n")
    )
    total, texts = per_text.agg(F.sum("windows"), F.count("content")).first()
    starts = (
        looked_up(windows, earliest, ["h1", "h2"], total or 0, ["doc_id", "start"])
        .where("doc_id > least")
        .groupBy("doc_id", "tag")
        .agg(F.collect_list("start").alias("starts"))
    )
    least = long_texts.groupBy("content").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("n")
    )
    copies = (
        looked_up(
            long_texts.select("doc_id", "tag", "content"), least, ["content"], texts, ["doc_id", "tag"]
        )
        .where("doc_id > least")
        .join(many, "doc_id", "left")
        .select(
            "doc_id",
            F.when(F.col("many"), F.col("tag")).otherwise(0).alias("tag"),
            F.lit(None).cast("array<int>").alias("starts"),
        )
        .distinct()
    )
    removed = (
        copies.unionByName(starts)
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("tag", "starts")).alias("removed"))
    )
    function, schema = _cut(window)
    other = rows.schema["other"].dataType.simpleString()
    return rows.join(removed, "doc_id", "left").mapInArrow(
        function, f"doc_id long, other {other}, {schema}"
    )


def cut_documents(docs: DataFrame, window: int = WINDOW, span: int = SPAN) -> DataFrame:
    """``docs`` with its columns; ``text`` without the repeats, ``n_chars`` (if there) its length."""
    cut = remove_repeats(docs, window, span).withColumn("text", F.col("kept").cast("string"))
    columns = {c: F.col("other").getField(c) for c in docs.columns if c != "text"}
    columns["text"] = F.col("text")
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(
            columns["n_chars"]
        ).cast(docs.schema["n_chars"].dataType)
    return cut.select(*[columns[c].alias(c) for c in docs.columns])


def digest(docs: DataFrame, window: int = WINDOW, span: int = SPAN) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document, from its kept words."""
    # words of an untouched text are joined here; the built-in functions are faster than a join
    # of words in Python, and leave the text itself behind
    words = F.regexp_extract_all(F.col("kept").cast("string"), F.lit(WORD), 0)
    kept = F.coalesce(F.array_join(words, " "), F.lit(""))
    return remove_repeats(docs.select("doc_id", "text"), window, span).select(
        "doc_id", "n_words", "n_removed", F.sha2(kept.cast("binary"), 256).alias("kept_sha256")
    )
