"""Benchmark passages in documents: pigeonhole pieces, then Myers' bit-parallel distance."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edits allowed for each character of an item, and characters of items scanned for in one pass.
ERRORS, PASS_CHARS = 0.08, 2_000_000


def plain(text: str | None) -> str:
    """Lower-cased (A-Z), runs of whitespace as one space."""
    return b" ".join((text or "").encode().lower().split()).decode()


def budget(item: str, errors: float) -> int:
    return int(len(item) * errors)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``k + 1`` pieces with their offsets: k edits leave at least one of them whole."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def distance(item: str, text: str, k: int) -> int | None:
    """Least number of edits that turn ``item`` into a part of ``text``, if at most ``k``: Myers'
    recurrence, one column of the table in two bit vectors."""
    last = 1 << (len(item) - 1)
    full = (last << 1) - 1
    at: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        at[c] |= 1 << i
    up, down, score, best = full, 0, len(item), len(item)
    for c in text:
        match = at.get(c, 0)
        across = (((match & up) + up) ^ up) | match | down
        plus = down | ~(across | up) & full
        minus = up & across
        if plus & last:
            score += 1
        elif minus & last:
            score -= 1
        plus, minus = plus << 1 & full, minus << 1 & full
        down = plus & (across0 := match | down)
        up = minus | ~(across0 | plus) & full
        if score < best:
            best = score
    return best if best <= k else None


def wider(n: int) -> list[list[tuple[int, int]]]:
    """For each of ``n`` pieces the growing ranges of pieces around it, halves of halves; the
    range of all pieces is left out."""
    around: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    todo = [(0, n)]
    while todo:
        a, b = todo.pop()
        if b - a > 1:
            if b - a < n:
                for i in range(a, b):
                    around[i].insert(0, (a, b))
            m = (a + b) // 2
            todo += [(a, m), (m, b)]
    return around


def stands_alone(text: str, start: int, end: int) -> bool:
    """Whether no word goes on beyond either end of a part of a text."""

    def joined(at: int) -> bool:
        return 0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum()

    return not joined(start) and not joined(end)


class Matcher:
    """Finds all items of one pass in a text.

    j pieces are given j - 1 edits. With as many edits or fewer in the whole, one of two halves
    keeps to its own edits, and so on down to a piece without any. So a hit of a piece counts only
    if each range around it keeps to its edits too, the smallest checked first.
    """

    def __init__(self, items: list[tuple[int, str]], errors: float):
        self.items, where = [], defaultdict(list)
        for id, item in items:
            k = budget(item, errors)
            parts = pieces(item, k)
            cuts = [offset for offset, _ in parts] + [len(item)]
            ranges = [
                [(cuts[i] - cuts[a], item[cuts[a] : cuts[b]], b - a - 1) for a, b in around]
                for i, around in enumerate(wider(k + 1))
            ]
            for i, (offset, piece) in enumerate(parts):
                where[piece].append((len(self.items), offset, ranges[i]))
            self.items.append((id, item, k))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in where.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int]]:
        """``(item_id, least edits)`` of every item in the text."""
        text = plain(text)
        starts = defaultdict(set)
        for end, (length, uses) in self.automaton.iter(text):
            at = end + 1 - length
            for n, offset, ranges in uses:
                # an item too short for any edit is its own only piece, and must be whole words
                if not self.items[n][2] and not stands_alone(text, at, end + 1):
                    continue
                for before, part, k in ranges:
                    first = at - before
                    window = text[max(0, first - k) : first + len(part) + k]
                    if distance(part, window, k) is None:
                        break
                else:
                    starts[n].add(at - offset)
        found = []
        for n, places in starts.items():
            id, item, k = self.items[n]
            best, first, reach = None, None, None
            for place in [*sorted(places), None]:
                # windows that overlap are verified as one
                if first is not None and (place is None or place - k > reach):
                    d = distance(item, text[max(0, first - k) : reach], k)
                    best = d if best is None or d is not None and d < best else best
                    first = None
                if place is not None:
                    first = place if first is None else first
                    reach = place + len(item) + k
            if best is not None:
                found.append((id, best))
        return sorted(found)


def passes(items: DataFrame, chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items ``(item_id, text)`` in parts of bounded size; NULL ids and empty texts are left out."""
    some, size = [], 0
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    for id, text in rows.toLocalIterator():
        item = plain(text)
        if id is None or not item:
            continue
        if some and size + len(item) > chars:
            yield some
            some, size = [], 0
        some.append((id, item))
        size += len(item)
    if some:
        yield some


def matches(
    docs: DataFrame, items: DataFrame, errors: float = ERRORS, pass_chars: int = PASS_CHARS
) -> DataFrame:
    """``doc_id, item_id, edits``: every item of ``items(item_id, text)`` that stands in a document
    of ``docs(doc_id, text)`` with at most ``errors`` edits for each of its characters, and the
    least number of edits.

    Case (A-Z) and the kind and number of whitespace characters do not count. An item too short for
    an edit must stand as whole words: ``yes`` is not in ``yesterday``. NULL and empty texts
    hold nothing and are held by nothing; items with a NULL id are left out, documents with a NULL
    id are reported with it. Repeated documents are reported as often, repeated items once for
    each. The items are a query set: documents are scanned once for every ``pass_chars`` characters
    of it, and nothing is shuffled. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for part in passes(items, pass_chars):

        def scan(source: Iterator[pa.RecordBatch], part=part) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(part, errors)
            for batch in source:
                out = [
                    (id, item, edits)
                    for id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")))
                    for item, edits in matcher.find(text)
                ]
                columns = list(zip(*out)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "edits"]
                )

        some = rows.mapInArrow(scan, "doc_id long, item_id long, edits long")
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = rows.where("false").selectExpr("doc_id", "0L AS item_id", "0L AS edits")
    return found


def without_leaks(
    docs: DataFrame, items: DataFrame, errors: float = ERRORS, pass_chars: int = PASS_CHARS
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; rules as for ``matches``."""
    for part in passes(items, pass_chars):

        def keep(source: Iterator[pa.RecordBatch], part=part) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(part, errors)
            for batch in source:
                clean = [not matcher.find(text) for text in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
