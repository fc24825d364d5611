"""Key/value pairs and records as arrays of structs and maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pair(key: str, value: Column) -> Column:
    """One ``(k, v)`` pair; values are text so that pairs of any field fit one collection."""
    return F.struct(F.lit(key).alias("k"), value.cast("string").alias("v"))


def typed_pair(key: str, value: Column) -> Column:
    """One ``(k, v)`` pair whose value keeps its type, as VARIANT: still any field fits one
    collection, and a number stays a number."""
    return F.struct(F.lit(key).alias("k"), value.cast("variant").alias("v"))


def last_wins(pairs: Column) -> Column:
    """The pairs of an array with every key kept once, in its last occurrence.

    Meant for the fields of one record; a collection of rows is reduced by
    ``combine_pairs`` instead.
    """
    return F.filter(
        pairs,
        lambda entry, i: ~F.exists(
            F.slice(pairs, i + 2, F.size(pairs)), lambda later: later["k"] == entry["k"]
        ),
    )


def pairs_to_map(pairs: Column) -> Column:
    """An array of pairs as one map, later key wins, whatever the session's dedupe policy."""
    return F.map_from_entries(last_wins(pairs))


def update_map(base: Column, changes: Column) -> Column:
    """``base`` with the entries of ``changes`` put over it."""
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(changes, k))
    return F.map_concat(kept, changes)


def without_key(record: Column, key: str) -> Column:
    return F.map_filter(record, lambda k, _: k != key)


def one_item_list(value: Column) -> Column:
    return F.array(value)


def one_entry_map(entry: Column) -> Column:
    """A pair as a map of one entry."""
    return F.create_map(entry["k"], entry["v"])


def first_item(values: Column) -> Column:
    """The first element of an array; NULL for an empty one."""
    return F.get(values, 0)
