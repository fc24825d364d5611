"""Near-duplicates of vectors by an epsilon grid order join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import looked_up, stored
from sensorloom.llm.graph import components
from sensorloom.llm.simhash import Forest, mine_slice

#: Vectors that the principal axes and the cuts are fitted on at most, axes with a grid, axes
#: that distances are bounded by, intervals at most, vectors aimed at in an interval.
SAMPLE, GRID_AXES, AXES, INTERVALS, INTERVAL = 20_000, 4, 12, 512, 8_192
#: Vectors compared at once on either side, and visitors that one task takes.
BLOCK, VISITORS = 512, 65_536
#: Added to the distance bound, for rounding.
SLACK = 1e-6


class Order:
    """The epsilon grid order: unit vectors sorted by their cells on the leading principal axes,
    cut into intervals of the sequence."""

    def __init__(self, sample: np.ndarray, epsilon: float, intervals: int):
        self.epsilon, self.centre = epsilon, sample.mean(axis=0)
        _, _, axes = np.linalg.svd(sample - self.centre, full_matrices=False)
        self.axes = axes[:AXES].T
        keys = np.sort(self.keys(self.project(sample)))
        self.cuts = np.unique(keys[np.linspace(0, len(keys) - 1, intervals + 1).astype(int)[1:-1]])

    def project(self, units: np.ndarray) -> np.ndarray:
        """Orthonormal, so no distance grows."""
        return (units - self.centre) @ self.axes

    def keys(self, places: np.ndarray) -> np.ndarray:
        """Cells in order of the axes, then the place inside the first cell, as one number."""
        cells = np.clip(np.floor(places[:, :GRID_AXES] / self.epsilon), -512, 511).astype(np.int64)
        key = np.zeros(len(places), np.int64)
        for axis in range(cells.shape[1]):
            key = key * 1024 + cells[:, axis] + 512
        inside = places[:, 0] / self.epsilon - np.floor(places[:, 0] / self.epsilon)
        return key * 1024 + np.minimum(inside * 1024, 1023).astype(np.int64)

    def interval(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts, self.keys(places), side="right")


def apart(low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray):
    """Least distance between boxes, given by their corners."""
    gap = np.maximum(0, np.maximum(other_low - high, low - other_high))
    return np.sqrt((gap * gap).sum(axis=-1))


def units_of(column: pa.Array) -> np.ndarray:
    values = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    scale = np.abs(values).max(axis=1, keepdims=True)
    extreme = (scale > 1e100) | (scale < 1e-100)
    values = values / np.where(extreme, scale, 1)  # so that no square overflows or vanishes
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def close_pairs(
    left: np.ndarray, left_at: np.ndarray, right: np.ndarray, right_at: np.ndarray, least: float, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs with a cosine of ``least`` or more, each once.

    Both sides are sequences in grid order. Two sequences are skipped if their boxes are farther
    apart than such a pair can be; else the longer one is halved, down to blocks.
    """
    epsilon = np.sqrt(max(0.0, 2 - 2 * least)) + SLACK
    small, other = left.astype(np.float32), right.astype(np.float32)
    todo = [(0, len(left), 0, len(right))]
    while todo:
        a, b, c, d = todo.pop()
        if a == b or c == d or (same and d <= a):
            continue
        one, two = left_at[a:b], right_at[c:d]
        if apart(one.min(0), one.max(0), two.min(0), two.max(0)) > epsilon:
            continue
        if b - a > BLOCK or d - c > BLOCK:
            if b - a >= d - c:
                m = (a + b) // 2
                todo += [(a, m, c, d), (m, b, c, d)]
            else:
                m = (c + d) // 2
                todo += [(a, b, c, m), (a, b, m, d)]
            continue
        # single precision finds candidates with room for its rounding, double decides
        i, j = np.nonzero(small[a:b] @ other[c:d].T >= least - 1e-4)
        i, j = i + a, j + c
        if same:
            i, j = i[i < j], j[i < j]
        exact = np.einsum("ij,ij->i", left[i], right[j]) >= least
        yield i[exact], j[exact]


def _links(nodes: DataFrame, least: float, sample: int, interval: int) -> DataFrame:
    """``nodes(node, n, vector)`` of one dimension -> ``node, root, links`` per task."""
    total = nodes.count()
    some = nodes.sample(min(1.0, sample * 0.9 / max(total, 1)), seed=7).limit(sample)
    table = some.select("vector").toArrow()
    if not table.num_rows:
        return nodes.sparkSession.createDataFrame([], "node string, root string, links long")
    epsilon = np.sqrt(max(0.0, 2 - 2 * least)) + SLACK
    fitted = units_of(table.column("vector").combine_chunks())
    order = Order(fitted, epsilon, int(min(INTERVALS, max(1, total // interval))))
    axes = order.axes.shape[1]
    count = len(order.cuts) + 1

    def boxes(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            places = order.project(units_of(batch.column("vector")))
            at = order.interval(places)
            for k in np.unique(at):
                mine = places[at == k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(k)] * axes, pa.int32()), pa.array(range(axes), pa.int32())]
                    + [pa.array(x) for x in (mine.min(0), mine.max(0))]
                    + [pa.array([len(mine)] * axes, pa.int64())],
                    ["interval", "axis", "low", "high", "n"],
                )

    # at most INTERVALS x AXES rows
    low, high = np.full((count, axes), np.inf), np.full((count, axes), -np.inf)
    sizes = np.zeros(count, np.int64)
    bounds = nodes.select("vector").mapInArrow(
        boxes, "interval int, axis int, low double, high double, n long"
    )
    for r in (
        bounds.groupBy("interval", "axis")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
        .collect()
    ):
        low[r.interval, r.axis], high[r.interval, r.axis] = r.low, r.high
        sizes[r.interval] = r.n
    # an interval that cannot be cut finer holds several slots; slots are what tasks are made of
    slots = np.maximum(1, -(-sizes // (2 * interval)))
    first = np.concatenate([[0], np.cumsum(slots)])
    earlier = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    parts = 1 + (earlier + sizes) // VISITORS

    def route(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["task", "home", "node", "n", "vector"]
        for batch in source:
            places = order.project(units_of(batch.column("vector")))
            at = order.interval(places)
            spread = np.array([int(x[:8], 16) for x in batch.column("node").to_pylist()], np.uint64)
            for k in range(count):
                own = first[at] + mine_slice(spread, int(slots[k])).astype(np.int64)
                reach = (at <= k) & (apart(places, places, low[k], high[k]) <= epsilon)
                part = mine_slice(spread + np.uint64(1), int(parts[k]))
                for s in range(first[k], first[k + 1]):
                    mine = (at == k) & (own == s)
                    before = reach & ((at < k) | (own < s))
                    for p in range(parts[k]):
                        for home, who in ((True, mine), (False, before & (part == p))):
                            who = np.flatnonzero(who)
                            if len(who):
                                yield pa.RecordBatch.from_arrays(
                                    [
                                        pa.array([f"{s}.{p}"] * len(who)),
                                        pa.array([home] * len(who)),
                                        *batch.take(pa.array(who)).columns,
                                    ],
                                    names,
                                )

    def compare(key, group):
        group = group.combine_chunks()
        units = units_of(group.column("vector").combine_chunks())
        places = order.project(units)
        order_of = np.argsort(order.keys(places), kind="stable")
        home = np.asarray(group.column("home"))[order_of]
        units, places = units[order_of], places[order_of]
        names = np.asarray(group.column("node").to_pylist(), object)[order_of]
        weight = np.asarray(group.column("n"))[order_of]
        known, at = np.unique(names, return_inverse=True)
        forest, found = Forest(len(known)), np.zeros(len(known), np.int64)
        own, go = np.flatnonzero(home), np.flatnonzero(~home)
        sides = [(go, own, False)]
        if key[0].as_py().endswith(".0"):  # pairs inside a slot are one part's work
            sides.append((own, own, True))
        for a, b, same in sides:
            for i, j in close_pairs(units[a], places[a], units[b], places[b], least, same):
                i, j = a[i], b[j]
                np.add.at(found, at[i], weight[j])
                np.add.at(found, at[j], weight[i])
                forest.link(at[i], at[j])
        linked = np.flatnonzero(found)
        return pa.table(
            {
                "node": pa.array(known[linked], pa.string()),
                "root": pa.array(known[forest.root[linked]], pa.string()),
                "links": pa.array(found[linked], pa.int64()),
            }
        )

    kind = nodes.schema["vector"].dataType.simpleString()
    routed = nodes.mapInArrow(route, f"task string, home boolean, node string, n long, vector {kind}")
    return routed.groupBy("task").applyInArrow(compare, "node string, root string, links long")


def near_vectors(
    vectors: DataFrame, least: float = 0.9, sample: int = SAMPLE, interval: int = INTERVAL
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors(vec_id, embedding)``.

    Vectors are linked if their cosine in double precision is ``least`` (over 0) or more.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest vec_id that
    links reach, ``kept`` says whether it is the row's own.

    Equal vectors are compared once, as one node. Nodes are put in epsilon grid order: principal
    axes and the cuts between intervals of the sequence are fitted on at most ``sample`` vectors,
    the intervals' boxes are those of all vectors. A vector goes to the task of its own interval
    and, where a box is not provably too far, to those of later intervals; inside a task sequences
    are halved and skipped by the same bound. A task returns a row per linked node, not per pair.

    A vector that is NULL, empty, zero or holds NULL or non-finite components links with nothing,
    nor do vectors of different lengths or rows with a NULL vec_id (their component_id is NULL
    and kept is true). Repeated rows are vectors of their own. Other columns are ignored.
    """
    vector = F.col("embedding")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.coalesce(
        F.col("vec_id").isNotNull()
        & (F.size(vector) > 0)
        & ~bad
        & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(good, vector).alias("vector"),
    ).withColumn(
        "node",
        F.when(
            F.col("vector").isNotNull(),
            F.concat(
                F.lpad(F.hex(F.xxhash64("vector")), 16, "0"),
                F.lpad(F.hex(F.xxhash64(F.lit(1), "vector")), 16, "0"),
            ),
        ),
    )
    nodes = stored(
        rows.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.count("*").alias("n"), F.min("vec_id").alias("least"), F.first("vector").alias("vector")),
        "nodes",
    )
    lengths = [r[0] for r in nodes.select(F.size("vector")).distinct().collect()]
    found = None
    for length in lengths:
        some = nodes.where(F.size("vector") == length).select("node", "n", "vector")
        some = _links(some, least, sample, interval)
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "node string, root string, links long")
    found = stored(found, "links")
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    totals = found.groupBy("node").agg(F.sum("links").alias("links"))
    members = (
        nodes.drop("vector")
        .join(totals, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    smallest = members.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = members.join(smallest, "root").select(
        F.col("node").cast("binary").alias("node"),
        "n",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        "component_id",
    )
    classes = stored(classes, "classes")
    # rows of a vector that very many have are not gathered, and those without one wait for nothing
    total = classes.agg(F.sum("n")).first()[0] or 0
    own = rows.where("node IS NOT NULL").select("vec_id", F.col("node").cast("binary").alias("node"))
    found = looked_up(own, classes, ["node"], total, ["vec_id"]).select(
        "vec_id", "n_links", "component_id"
    )
    alone = rows.where("node IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return found.unionByName(alone).select(
        "vec_id",
        F.col("n_links").cast("long").alias("n_links"),
        "component_id",
        F.expr("vec_id <=> component_id").alias("kept"),
    )
