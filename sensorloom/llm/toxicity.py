"""Toxicity by a weighted finite-state grammar over clauses, its lexicon and weights learned."""

from __future__ import annotations

import bisect
import heapq
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Collection, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.common import fold

#: Labelled documents of each label that the model is fitted on at most, in order of crc32.
SAMPLE = 4_000
#: One document in so many is held out of everything that is learned.
FOLDS = 5
#: Lengths of word beginnings looked at as stems.
STEMS = range(3, 11)

#: Words of the grammar's classes in English, German, French and Spanish.
TARGETS = "you your yours he she they him her them du dich ihr euch sie tu toi vous ils elles usted ustedes ellos ellas".split()
NEGATIONS = "not no never neither nor isn't aren't nicht kein keine nie niemals pas jamais aucun nunca ni jamás tampoco".split()
REPORTS = "said says wrote writes claimed claims quoted quotes reported reports sagte schrieb behauptet dit écrit affirme dijo escribió afirma".split()
THREATS = "kill hurt destroy stab strangle töten umbringen vernichten tuer détruire frapper matar destruir golpear".split()
INSULTS = "idiot moron stupid fool jerk liar scum loser dumm trottel dummkopf imbécile crétin idiota estúpido tonto".split()

#: Log-odds that a stem has at least, kept stems that a toxic document is to have, toxic documents
#: that a stem must add to those with fewer, and how many of them one clean document outweighs.
ODDS, COVER, LEAST, COST = 2.0, 8, 2, 4
#: Strength of a listed insult or threat that the labels say nothing about.
LISTED = 2.0
WORD_REST = re.compile(r"\w*")
CLAUSE_END = re.compile(r"[.!?;:\n]+")
OUTPUTS = ("plain", "aimed", "threat", "idle", "negated", "reported")


#: What the grammar makes of an insult or a threat, and how much of its strength an arc that writes
#: it carries: the weight by which the best path through a clause is chosen.
ARC_WEIGHTS = {"plain": 1.0, "aimed": 1.5, "threat": 1.5, "idle": 0.25, "negated": 0.1, "reported": 0.1}

Arc = tuple  # next state, symbol written, weight


@dataclass(frozen=True)
class Transducer:
    """Maps a clause's symbols to symbols. ``arcs[state, symbol]`` lists next states with what is
    written and the arc's weight; a symbol without an arc passes unchanged, weighs nothing and
    leaves the state. A path counts if it ends in a state that is not in ``open``."""

    arcs: dict[tuple, tuple[Arc, ...]]
    start: object = "start"
    open: frozenset = frozenset()

    def steps(self, state: object, symbol: str) -> tuple[Arc, ...]:
        return self.arcs.get((state, symbol), ((state, symbol, 0.0),))

    def after(self, other: Transducer, alphabet: Iterable[str]) -> Transducer:
        """The composition: ``other`` reads a clause, and this one what ``other`` writes."""
        start, arcs, seen, todo = (other.start, self.start), {}, set(), [(other.start, self.start)]
        while todo:
            state = todo.pop()
            if state in seen:
                continue
            seen.add(state)
            for symbol in alphabet:
                found = tuple(
                    ((p, q), last, v + w)
                    for p, written, v in other.steps(state[0], symbol)
                    for q, last, w in self.steps(state[1], written)
                )
                arcs[state, symbol] = found
                todo += [arc[0] for arc in found]
        unfinished = {s for s in seen if s[0] in other.open or s[1] in self.open}
        return Transducer(arcs, start, frozenset(unfinished))

    def best(self, clause: Iterable[tuple[str, float]]) -> tuple[float, list[str]]:
        """The weight and the writing of the heaviest path through a clause of symbols and their
        strengths; an arc's weight counts by the strength of what it reads. Of equal paths the first
        in the order of arcs is taken."""
        paths = {self.start: (0.0, None)}
        for symbol, strength in clause:
            further: dict = {}
            for state, (weight, written) in paths.items():
                for nearest, out, w in self.steps(state, symbol):
                    total = weight + w * strength
                    if nearest not in further or total > further[nearest][0]:
                        further[nearest] = (total, (written, out))
            paths = further
        weight, written = max((p for s, p in paths.items() if s not in self.open), key=lambda p: p[0])
        out = []
        while written:
            written, symbol = written
            out.append(symbol)
        return weight, out[::-1]


def _written(symbol: str, state: str = "start") -> tuple[Arc, ...]:
    return ((state, symbol, ARC_WEIGHTS.get(symbol, 0.0)),)


#: After a verb of saying, insults and threats are somebody else's.
REPORTED = Transducer(
    {
        ("start", "report"): _written("report", "said"),
        ("said", "insult"): _written("reported", "said"),
        ("said", "threat"): _written("reported", "said"),
    }
)
#: A negation reaches the next insult or threat of its clause; a second one takes it back.
NEGATED = Transducer(
    {
        ("start", "negation"): _written("negation", "denied"),
        ("denied", "negation"): _written("negation"),
        ("denied", "insult"): _written("negated"),
        ("denied", "threat"): _written("negated"),
    }
)
#: An insult is aimed, a threat meant, if a target stands in its clause: before it, or after it,
#: which the machine has to guess and which a target must make good before the clause ends.
TARGET = Transducer(
    {
        ("start", "target"): (("named", "target", 0.0),),
        ("start", "insult"): (("start", "insult", 0.0), ("owed", "aimed", ARC_WEIGHTS["aimed"])),
        ("start", "threat"): (("start", "threat", 0.0), ("owed", "meant", 0.0)),
        ("owed", "target"): (("named", "target", 0.0),),
        ("owed", "insult"): _written("aimed", "owed"),
        ("owed", "threat"): _written("meant", "owed"),
        ("named", "insult"): _written("aimed", "named"),
        ("named", "threat"): _written("meant", "named"),
    },
    open=frozenset({"owed"}),
)
#: What is left of insults is plain, of threats nothing but words.
INSULT = Transducer({("start", "insult"): _written("plain")})
THREAT = Transducer({("start", "meant"): _written("threat"), ("start", "threat"): _written("idle")})

#: Symbols of words; the machines write more between them.
SYMBOLS = ("insult", "threat", "target", "negation", "report")
MACHINES = (REPORTED, NEGATED, TARGET, INSULT, THREAT)


def compose(machines: Iterable[Transducer], alphabet: Iterable[str] = SYMBOLS) -> Transducer:
    """One table for all machines, each reading what those before it wrote."""
    first, *rest = machines
    return reduce(lambda done, machine: machine.after(done, alphabet), rest, first)


GRAMMAR = compose(MACHINES)


@dataclass
class Model:
    """Stems (``lowered beginning``, or a whole word with ``$`` after it) with their strength, and
    the weights of the grammar's outputs."""

    strengths: dict[str, float]
    weights: list[float] = field(default_factory=lambda: [0.0] * (3 * len(OUTPUTS)))
    bias: float = 0.0

    def matcher(self) -> ahocorasick.Automaton:
        automaton = ahocorasick.Automaton()
        words = defaultdict(list)
        lists = (("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS), ("threat", THREATS))
        for symbol, some in lists:
            for word in some:
                words[word].append((symbol, True, LISTED))
        for stem, strength in self.strengths.items():
            words[stem.rstrip("$")].append(("insult", stem.endswith("$"), strength))
        for word, uses in words.items():
            automaton.add_word(word, (len(word), uses))
        automaton.make_automaton()
        return automaton

    def features(self, text: str | None, automaton: ahocorasick.Automaton) -> np.ndarray:
        """For each output of the grammar whether a clause's best path has it, the log of the strength
        of the different words behind it, and that of all their occurrences."""
        text = (text or "").lower()
        hits = []
        for end, (length, uses) in automaton.iter(text):
            first, after = end + 1 - length, end + 1
            if first and text[first - 1].isalnum():
                continue
            whole = after == len(text) or not text[after].isalnum()
            if whole or not all(exact for _, exact, _ in uses):
                word = WORD_REST.match(text, first).group()
                hits += [(first, s, strength, word) for s, exact, strength in uses if whole or not exact]
        words = {output: {} for output in OUTPUTS}
        sums = dict.fromkeys(OUTPUTS, 0.0)
        if any(h[1] in ("insult", "threat") for h in hits):
            ends = [m.start() for m in CLAUSE_END.finditer(text)]
            clauses = defaultdict(dict)
            for first, symbol, strength, word in sorted(hits):
                # of stems that begin at one place the strongest counts
                clause = clauses[bisect.bisect(ends, first)]
                if strength >= clause.get((first, symbol), (0, ""))[0]:
                    clause[first, symbol] = (strength, word)
            for clause in clauses.values():
                order = sorted(clause)
                _, written = GRAMMAR.best([(key[1], clause[key][0]) for key in order])
                for key, output in zip(order, written):
                    if output in words:
                        strength, word = clause[key]
                        words[output][word] = strength
                        sums[output] += strength
        distinct = np.array([sum(found.values()) for found in words.values()])
        return np.concatenate([distinct > 0, np.log1p(distinct), np.log1p(list(sums.values()))])

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(features @ self.weights + self.bias, -30, 30))))


def stems_of(text: str | None) -> set[str]:
    words = {w for w in re.findall(r"[^\W\d_]+", (text or "").lower())}
    return {w + "$" for w in words if len(w) > 1} | {w[:n] for w in words for n in STEMS if len(w) > n}


def telling_stems(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """The log-odds of the stems that stand in toxic documents far more often than by chance, given
    how many toxic and clean documents have each."""
    telling = {}
    least = 2 * np.log(max(2, len(counts))) + 8
    for stem, (a, b) in counts.items():
        odds = np.log((a + 0.5) / (toxic + 1)) - np.log((b + 0.5) / (clean + 1))
        if odds < ODDS:
            continue
        both = (a + b) / (toxic + clean)
        cells = ((a, both * toxic), (b, both * clean), (toxic - a, (1 - both) * toxic), (clean - b, (1 - both) * clean))
        if 2 * sum(n * np.log(n / e) for n, e in cells if n) >= least:
            telling[stem] = float(odds)
    return telling


def lexicon(
    telling: dict[str, float], documents: Sequence[Collection[str]], clean: dict[str, int]
) -> dict[str, float]:
    """The strengths of the stems that are worth keeping, given which of them each toxic document
    has and how many clean documents have each.

    A stem goes if longer ones that begin as it does reach all the toxic documents that it reaches.
    Then greedily: next comes the stem that adds most to toxic documents with fewer than ``COVER``
    kept ones so far, less what clean documents that have it cost; none that adds under ``LEAST``.
    So words that stand beside each other in copies of one text bring in a few stems, not hundreds.
    """
    reached = defaultdict(list)
    for number, stems in enumerate(documents):
        for stem in stems:
            reached[stem].append(number)
    beside = defaultdict(set)
    for stem in sorted(reached, key=lambda s: (-len(s), s)):
        if beside[stem].issuperset(reached[stem]):
            del reached[stem]
            continue
        whole = stem.rstrip("$")
        for n in STEMS:
            if len(whole[:n]) == n and whole[:n] != stem:
                beside[whole[:n]].update(reached[stem])
    short = [COVER] * len(documents)
    kept = {}

    def gain(stem: str) -> float:
        return sum(1 for n in reached[stem] if short[n]) - COST * clean[stem]

    # what a stem adds only shrinks, so an old figure bounds the new one; of equals the longest
    queue = [(-gain(stem), -len(stem), stem) for stem in reached]
    heapq.heapify(queue)
    while queue:
        old, length, stem = heapq.heappop(queue)
        now = gain(stem)
        if now < LEAST:
            continue
        if queue and (-now, length, stem) > queue[0]:
            heapq.heappush(queue, (-now, length, stem))
            continue
        kept[stem] = float(np.clip(telling[stem], 1, 8))
        for number in reached[stem]:
            short[number] = max(0, short[number] - 1)
    return {w + "$": LISTED for w in INSULTS} | kept


def regression(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's steps."""
    rows = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(rows.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        step = np.linalg.solve((rows.T * (p * (1 - p))) @ rows + np.diag(penalty), rows.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def first_pair(text: str | None) -> int:
    """The least hash of two neighbouring words: the same for most copies of a text that differ in
    few words, and seldom for other texts."""
    words = (text or "").lower().split()
    pairs = set(zip(words, words[1:])) or {tuple(words)}
    return min(zlib.crc32(" ".join(pair).encode()) for pair in pairs)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = FOLDS) -> Model:
    """Learns from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``: from rows whose crc32 of
    the id modulo ``folds`` is not 0, of these at most ``sample`` of each label, by crc32, and of
    the rows of one id and label, and of copies of one text, that with the smallest text. The share
    of toxic documents is that of all such labels. Without labels of both kinds the listed words
    have the weights below."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("toxic IN (0, 1)").where(fold("doc_id", folds) != 0).distinct()
    shares = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = (F.crc32(F.col("doc_id").cast("string").cast("binary")), "doc_id")
    some = [known.where(F.col("toxic") == y).orderBy(*order).limit(sample) for y in (0, 1)]
    # at most 2 x ``sample`` rows: of rows with the same id one is enough
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(some[0].unionByName(some[1])), "doc_id"
    ).select("doc_id", "toxic", F.col("text").cast("string").alias("text"))
    texts = texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def mark(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            pairs = [first_pair(text) for text in batch.column("text").to_pylist()]
            columns = [batch.column("toxic"), pa.array(pairs, pa.int64()), batch.column("text")]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "copy", "text"])

    texts = texts.select("toxic", "text").mapInArrow(mark, "toxic int, copy long, text string")
    texts = texts.groupBy("toxic", "copy").agg(F.min("text").alias("text")).select("toxic", "text")

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (Counter(), Counter())
        for batch in source:
            for y, text in zip(*(batch.column(c).to_pylist() for c in ("toxic", "text"))):
                found[y][""] += 1
                found[y].update(stems_of(text))
        stems = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(stems, pa.string())]
            + [pa.array([c[s] for s in stems], pa.int64()) for c in found],
            ["stem", "clean", "toxic"],
        )

    counts = (
        texts.mapInArrow(count, "stem string, clean long, toxic long")
        .groupBy("stem")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    totals = counts.where("stem = ''").first()
    clean, toxic = (totals.clean, totals.toxic) if totals else (0, 0)
    prior = [0.0 if o in ("idle", "negated", "reported") else 1.0 for o in OUTPUTS]
    model = Model({w + "$": LISTED for w in INSULTS}, prior + prior + [0.0] * len(OUTPUTS), -4.0)
    if not clean or not toxic:
        return model
    # stems of one document in twenty thousand toxic ones tell nothing
    often = counts.where((F.col("toxic") >= 3) & (F.col("toxic") * clean > F.col("clean") * toxic) & (F.col("stem") != ""))
    often = {r.stem: (r.toxic, r.clean) for r in often.collect()}
    telling = telling_stems(often, toxic, clean)

    def find(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows = [sorted(stems_of(t) & telling.keys()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], ["stems"])

    # at most ``sample`` rows
    found = texts.where("toxic = 1").select("text").mapInArrow(find, "stems array<string>")
    others = {stem: clean for stem, (_, clean) in often.items()}
    model.strengths = lexicon(telling, [r.stems for r in found.collect()], others)

    def measure(source: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
        automaton = model.matcher()
        for batch in source:
            rows = [model.features(t, automaton) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "x"]
            )

    table = texts.mapInArrow(measure, "toxic int, x array<double>").toArrow()
    y = np.asarray(table.column("toxic"), float)
    x = np.array(table.column("x").to_pylist())
    weights, bias = regression(x, y)
    # the sample is even, the labels are not
    natural = np.log(shares[1] / shares[0]) - np.log(toxic / clean)
    return Model(model.strengths, [float(w) for w in weights], bias + float(natural))


def scored(docs: DataFrame, model: Model, into: str = "toxicity") -> DataFrame:
    """``docs`` with the column ``into``, 0 to 1, of the whole text; NULL and empty texts have
    the score of a text without any match. Nothing is shuffled. A column of that name in ``docs``
    is an error."""
    names = docs.columns
    if into.lower() in map(str.lower, names):
        raise ValueError(f"there is a column {into!r} already")

    def score(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.matcher()
        for batch in source:
            texts = batch.column("text").to_pylist()
            scores = [model.score(model.features(t, automaton)) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*names, into])

    schema = T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())])
    return docs.mapInArrow(score, schema)


def predictions(docs: DataFrame, labels: DataFrame, folds: int = FOLDS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs(doc_id, text)``.

    Learned from ``labels(doc_id, toxic)`` of documents that are not held out; ids and labels
    are no input of a score. A row with a NULL doc_id is not held out and not learned from. Labels
    that are neither 0 nor 1 count as none; contradicting labels both count. Repeated rows stay.
    """
    model = fit(docs, labels, folds=folds)
    return scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).select(
        "doc_id",
        F.coalesce(fold("doc_id", folds) == 0, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def non_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score below 0.5, with all their columns, whatever their names."""
    into = "toxicity"
    while into in map(str.lower, docs.columns):
        into += "_"
    return scored(docs, fit(docs, labels), into).where(F.col(into) < 0.5).drop(into)
