"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import fold, mixed, stored, word_hashes

#: One document in so many is held out of everything that is learned.
FOLDS = 10
#: Added to every count.
ADDED = 0.1
#: Words with at least this share of all tokens are sent to every task (never more than its
#: inverse); the frequent ones among them are classes of their own, the others share a class with
#: words of like frequency.
SHARE, HEADS, BANDS = 1 / (1 << 20), 32, 14
#: Rows of weights of each kind of feature: the word before, the two words before, the one before
#: those (a skip). Rows that travel together when the tasks' models are averaged.
ROWS, KINDS, BLOCK = 8_192, 3, 64
#: Averaging rounds (each learns from its own part of the documents), tokens of a step, step size.
ROUNDS, STEP, RATE = 2, 2_048, 0.3
#: Distinct words that a task counts before it passes the counts on; tokens scored at once.
BUFFER, CHUNK = 1 << 21, 2_048

END = np.uint64(0x9E3779B97F4A7C15)  # as hash of the end token, and of what stands before a text


def tokens(raw: bytes | None) -> np.ndarray:
    """Hashes of the lower-cased (A-Z) words and of the end token."""
    return np.append(word_hashes((raw or b"").lower()), END)


def joined(texts: Iterable[bytes | None], least: int = STEP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens of neighbouring texts together, at least so many but at the end, and where each text
    begins: numpy works on a few long arrays faster than on many short ones."""
    parts, starts, size = [], [], 0
    for raw in texts:
        found = tokens(raw)
        parts.append(found)
        starts.append(size)
        size += len(found)
        if size >= least:
            yield np.concatenate(parts), np.array(starts)
            parts, starts, size = [], [], 0
    if parts:
        yield np.concatenate(parts), np.array(starts)


@dataclass
class Vocabulary:
    """Numbers of all training tokens, and the frequent words (sorted by hash) with counts and
    classes. Class 0 is the end token's, 1 that of all words without a class of their own."""

    total: int
    distinct: int
    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    log_mass: np.ndarray

    def __post_init__(self) -> None:
        # words by the leading bits of their hash: a look-up is one step, not a search
        bits = max(1, int(2 * len(self.words)).bit_length())
        self.shift = np.uint64(64 - bits)
        firsts = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.starts = np.append(np.searchsorted(self.words, firsts), len(self.words)).astype(np.int32)

    @classmethod
    def of(cls, total: int, distinct: int, words: np.ndarray, counts: np.ndarray) -> Vocabulary:
        order = np.argsort(words)
        words, counts = words[order], counts[order]
        classes = np.ones(len(words), np.int16)
        # ties in count go by hash
        ranked = np.lexsort((words, -counts))
        ranked = ranked[words[ranked] != END]
        classes[words == END] = 0
        heads = ranked[:HEADS]
        classes[heads] = 2 + np.arange(len(heads))
        rest = ranked[HEADS:]
        if len(rest):
            # bands of equal width in the logarithm of the count
            logs = np.log(counts[rest])
            width = (logs[0] - logs[-1]) / BANDS + 1e-9
            classes[rest] = 2 + HEADS + np.minimum((logs[0] - logs) // width, BANDS - 1)
        n = 2 + HEADS + BANDS
        of_class = np.bincount(classes, counts, n), np.bincount(classes, minlength=n)
        mass = of_class[0] + ADDED * of_class[1]
        # class 1 holds every other word, and those never seen
        mass[1] = total - of_class[0].sum() + of_class[0][1] + ADDED * (distinct - len(words) + of_class[1][1] + 1)
        return cls(total, distinct, words, counts, classes, np.log(np.maximum(mass, 1e-300)))

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count (0 if it is no frequent word) and class of each token."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.where(hashes == END, 0, 1).astype(np.int16)
        bucket = (hashes >> self.shift).astype(np.intp)
        at, end = self.starts[bucket], self.starts[bucket + 1]
        here = (at < end) & (self.words[np.minimum(at, len(self.words) - 1)] == hashes)
        # buckets hold half a word on average; a few tokens look at the next one of theirs
        todo = np.flatnonzero(~here & (at + 1 < end))
        while len(todo):
            at[todo] += 1
            here[todo] = self.words[at[todo]] == hashes[todo]
            todo = todo[~here[todo] & (at[todo] + 1 < end[todo])]
        at = np.minimum(at, len(self.words) - 1)
        none = np.where(hashes == END, 0, 1).astype(np.int16)
        return np.where(here, self.counts[at], 0), np.where(here, self.classes[at], none)


def features(hashes: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """Rows of weights, one of each kind, that each token is predicted from. The tokens are those of
    one text, or of several that begin at ``starts`` and each end in an end token."""
    before = np.concatenate([[END, END], hashes])[: len(hashes) + 1]
    one, two = before[1:], before[:-1]
    if starts is not None:
        # one back from a start stands the end of the text before, as it should; two back a word
        two[starts] = END
        one = np.concatenate([[END], hashes])[: len(hashes)]
    both = mixed(one * np.uint64(3) + two)
    rows = [h % np.uint64(ROWS) for h in (mixed(one), both, mixed(two + np.uint64(1)))]
    return np.stack(rows, axis=1).astype(np.int32) + np.arange(KINDS, dtype=np.int32) * ROWS


class Model:
    """Weights of the features for each class; a word's share of its class is that of its count."""

    def __init__(self, prior: np.ndarray):
        self.prior = prior.astype(np.float32)
        self.weights = np.zeros((ROWS * KINDS, len(prior)), np.float32)
        self.squares = np.zeros(ROWS * KINDS, np.float32)

    def _odds(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The logits of all classes less the greatest of each row, their powers, and the sums of
        these."""
        x = self.weights[rows[:, 0]]
        for kind in range(1, KINDS):
            x += self.weights[rows[:, kind]]
        x += self.prior
        x -= x.max(axis=1, keepdims=True)
        powers = np.exp(x)
        return x, powers, powers.sum(axis=1)

    def log_classes(self, rows: np.ndarray) -> np.ndarray:
        x, _, sums = self._odds(rows)
        return x - np.log(sums)[:, None]

    def log_class(self, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The same of one class for each row, which spares a pass over all others."""
        x, _, sums = self._odds(rows)
        return x[np.arange(len(classes)), classes] - np.log(sums)

    def learn(self, rows: np.ndarray, classes: np.ndarray) -> None:
        """One gradient step of the log likelihood, its size by what each row has moved before."""
        _, gradient, sums = self._odds(rows)
        gradient /= sums[:, None]
        gradient[np.arange(len(classes)), classes] -= 1
        for kind in range(KINDS):
            # numbers of 16 bits are sorted without comparing them
            own = (rows[:, kind] - kind * ROWS).astype(np.uint16 if ROWS <= 1 << 16 else np.int32)
            order = np.argsort(own, kind="stable")
            at = rows[order, kind]
            starts = np.flatnonzero(np.diff(at, prepend=-1))
            # rows met once need no sum
            sums = gradient[order[starts]]
            sizes = np.diff(starts, append=len(at))
            more = np.flatnonzero(sizes > 1)
            if len(more):
                within = np.repeat(sizes > 1, sizes)
                first = np.cumsum(np.append(0, sizes[more][:-1]))
                sums[more] = np.add.reduceat(gradient[order[within]], first, axis=0)
            at = at[starts]
            self.squares[at] += np.einsum("ij,ij->i", sums, sums)
            sums *= (RATE / np.sqrt(self.squares[at] + 1))[:, None]
            self.weights[at] -= sums


def _raw(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(*more, F.col("text").cast("string").cast("binary").alias("raw"))


def _count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the task's words, passed on whenever there are many distinct ones."""
    kept, size = [], 0

    def merged(parts):
        words = np.concatenate([w for w, _ in parts])
        words, at = np.unique(words, return_inverse=True)
        return words, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)

    def out(words, counts):
        columns = [pa.array(words.view(np.int64)), pa.array(counts)]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    for batch in source:
        for raw in batch.column("raw"):
            found = tokens(raw.as_py())
            kept.append((found, np.ones(len(found), np.int64)))
            size += len(found)
            if size > 2 * BUFFER:
                kept = [merged(kept)]
                size = len(kept[0][0])
                if size > BUFFER:
                    yield out(*kept[0])
                    kept, size = [], 0
    if kept:
        yield out(*merged(kept))


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: the hash of every distinct token of all of ``docs(text)`` and its count."""
    return (
        _raw(docs).mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    )


def vocabulary(counts: DataFrame) -> Vocabulary:
    sums = counts.agg(F.sum("n"), F.count("*")).first()
    total, distinct = int(sums[0] or 0), int(sums[1])
    # fewer than 1 / SHARE words can reach the share
    frequent = counts.where(F.col("n") >= F.lit(total * SHARE)).toArrow()
    words = np.asarray(frequent.column("word"), np.int64).view(np.uint64)
    return Vocabulary.of(total, distinct, words, np.asarray(frequent.column("n"), np.int64))


def train(docs: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> Model:
    """Learns the class weights from all of ``docs(doc_id, text)``.

    In every round each task goes once, in small gradient steps, through its documents of the
    round's part, starting from the common weights; the tasks' weights are then averaged, every
    row by how much each task has learned for it. There are at most as many tasks as cores, so
    that what travels is a bounded model for each core.
    """
    prior = words.log_mass - np.logaddexp.reduce(words.log_mass)
    model = Model(prior)
    spark = docs.sparkSession
    cores = max(2, spark.sparkContext.defaultParallelism)
    width = len(prior)
    for round in range(rounds):
        part = docs.where(F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / FOLDS) % rounds == round)

        def local(source: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            before = model.squares.copy()
            for found, starts in joined(raw.as_py() for batch in source for raw in batch.column("raw")):
                r, c = features(found, starts), words.look_up(found)[1]
                for i in range(0, len(c), STEP):
                    model.learn(r[i : i + STEP], c[i : i + STEP])
            gained = model.squares - before
            for block in range(0, ROWS * KINDS, BLOCK):
                cut = slice(block, block + BLOCK)
                if gained[cut].any():
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([block], pa.int32()),
                            pa.array([gained[cut].tobytes()], pa.binary()),
                            pa.array([model.weights[cut].tobytes()], pa.binary()),
                        ],
                        ["block", "gained", "weights"],
                    )

        def average(group: pd.DataFrame) -> pd.DataFrame:
            gained, sums = np.zeros(BLOCK), np.zeros((BLOCK, width))
            for g, w in zip(group["gained"], group["weights"]):
                g = np.frombuffer(g, np.float32)
                gained += g
                sums += g[:, None] * np.frombuffer(w, np.float32).reshape(BLOCK, width)
            sums /= np.maximum(gained, 1e-30)[:, None]
            return pd.DataFrame(
                {
                    "block": [group["block"].iloc[0]],
                    "gained": [gained.astype(np.float32).tobytes()],
                    "weights": [sums.astype(np.float32).tobytes()],
                }
            )

        schema = "block int, gained binary, weights binary"
        done = _raw(part).coalesce(cores).mapInArrow(local, schema).groupBy("block").applyInPandas(average, schema)
        updated = Model(prior)
        updated.weights, updated.squares = model.weights.copy(), model.squares.copy()
        # the model itself: ROWS * KINDS rows, whatever the input
        for row in done.toLocalIterator():
            gained = np.frombuffer(row.gained, np.float32)
            moved = gained > 0
            at = row.block + np.flatnonzero(moved)
            updated.weights[at] = np.frombuffer(row.weights, np.float32).reshape(BLOCK, width)[moved]
            updated.squares[at] += gained[moved]
        model = updated
    return model


def scored(docs: DataFrame, counts: DataFrame, words: Vocabulary, model: Model) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` of every row of ``docs(doc_id, text)``."""

    def score(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out = {"n_tokens": [], "n_known": [], "logs": [], "classes": [], "rare": []}
            for found, starts in joined(raw.as_py() for raw in batch.column("raw")):
                count, classes = words.look_up(found)
                rows, by_class = features(found, starts), np.empty(len(found))
                for i in range(0, len(found), CHUNK):
                    c = classes[i : i + CHUNK]
                    by_class[i : i + CHUNK] = model.log_class(rows[i : i + CHUNK], c)
                by_class -= words.log_mass[classes]
                known = count > 0
                logs = np.where(known, np.log10(count + ADDED), 0.0)
                out["n_tokens"] += np.diff(starts, append=len(found)).tolist()
                out["n_known"] += np.add.reduceat(known, starts, dtype=np.int64).tolist()
                out["logs"] += np.add.reduceat(logs, starts).tolist()
                out["classes"] += (np.add.reduceat(by_class, starts) / np.log(10)).tolist()
                for text, here in zip(np.split(found, starts[1:]), np.split(known, starts[1:])):
                    out["rare"].append(np.sort(text[~here]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(out["n_tokens"], pa.int64()),
                    pa.array(out["n_known"], pa.int64()),
                    pa.array(out["logs"], pa.float64()),
                    pa.array(out["classes"], pa.float64()),
                    pa.array(out["rare"], pa.list_(pa.int64())),
                ],
                ["doc_id", "n_tokens", "n_known", "logs", "classes", "rare"],
            )

    schema = "doc_id long, n_tokens long, n_known long, logs double, classes double, rare array<long>"
    rows = _raw(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(score, schema)
    # the row's number is fixed once, when it is written
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "scores")
    rare = rows.select("row", F.explode("rare").alias("word"))
    known = (
        rare.join(counts, "word")
        .groupBy("row")
        .agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + ADDED)).alias("more_logs"))
    )
    more = F.coalesce("more", F.lit(0))
    n_known = F.col("n_known") + more
    logs = (
        F.col("logs")
        + F.coalesce("more_logs", F.lit(0.0))
        + (F.col("n_tokens") - n_known) * F.log10(F.lit(ADDED))
    )
    whole = float(np.log10(words.total + ADDED * (words.distinct + 1)))
    base = logs - F.col("n_tokens") * F.lit(whole)
    return rows.drop("rare").join(known, "row", "left").select(
        "doc_id",
        "n_tokens",
        n_known.alias("n_known"),
        base.alias("base_score"),
        (logs + F.col("classes") if words.total else base).alias("score"),
    )


def predictions(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of
    ``docs(doc_id, text)``; both scores are log10 probabilities of the whole text.

    The base is the unigram probability with 0.1 added to each count. The model factors a token's
    probability: that of its class by a maximum-entropy model over the two tokens before it, and
    its share of the class by the same counts, so that all words, one for those never seen
    included, sum to one. A NULL text counts as empty: the end token alone. Rows with a NULL
    doc_id are not held out and not learned from; repeated rows stay and are learned from as often.
    If nothing can be learned every score is 0. Words are told apart by 64-bit hashes. Other columns
    are ignored.

    Frequent words (below 1 / SHARE of them) are looked up in the tasks; the others, none of which
    is a hot key, are joined to the table of counts.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    learned = rows.where(fold("doc_id", folds) != 0)
    counts = stored(word_counts(learned), "words")
    words = vocabulary(counts)
    model = train(learned, words)
    return scored(rows, counts, words, model).select(
        "doc_id",
        F.coalesce(fold("doc_id", folds) == 0, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(words.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
