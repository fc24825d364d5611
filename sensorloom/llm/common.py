"""What the operators share: tables, folds, the shared folder, words and their hashes."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes between words: space and 0x09 to 0x0D, as ``bytes.split`` takes them.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
WORD = r"[^\x20\x09-\x0D]+"
#: A key is hot if it has more than this part of all rows; so there are fewer hot keys than this.
HOT_KEYS = 4_096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; only where that is unset, as in tests, a
    temporary one takes its place."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
        named = tempfile.mkdtemp(prefix="sensorloom-shared-")
        spark.sparkContext.setCheckpointDir(named)
    return f"{named.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends, a lost executor costs
    no work done before, and later plans know the size."""
    spark = df.sparkSession
    path = shared_folder(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def looked_up(
    rows: DataFrame, facts: DataFrame, keys: list[str], total: int, spread: list[str]
) -> DataFrame:
    """``rows`` with the columns of ``facts``, which has one row for each combination of the ``keys``
    (long or binary) that are in ``rows``, and in ``n`` how many of the ``total`` rows have it.

    The fewer than ``HOT_KEYS`` keys with many rows are broadcast; their rows have what they look
    for already and are dealt by the columns ``spread`` instead of the key, so that no task gets
    all rows of one key. Rows with a NULL key find nothing.
    """
    found = [c for c in facts.columns if c not in keys and c != "n"]
    hot = facts.where(F.col("n") > total / HOT_KEYS).select(
        *keys, F.lit(True).alias("hot"), *[F.col(c).alias(f"hot_{c}") for c in found]
    )
    # the condition is always true; it keeps ``n``, so that Spark reuses one exchange for both
    facts = facts.where("n > 0").select(
        *[F.col(c).alias(f"dealt_{c}") for c in keys], *[F.col(c).alias(f"all_{c}") for c in found]
    )

    def elsewhere(key: str) -> Column:
        number = F.xxhash64(F.lit(key), *spread)
        return number.cast("string").cast("binary") if types[key] == "binary" else number

    types = dict(rows.dtypes)
    dealt = [
        F.when(F.col("hot"), elsewhere(c)).otherwise(F.col(c)).alias(f"dealt_{c}") for c in keys
    ]
    out = rows.join(F.broadcast(hot), keys, "left").select("*", *dealt)
    return out.join(facts, [f"dealt_{c}" for c in keys], "left").select(
        *rows.columns,
        *[F.when(F.col("hot"), F.col(f"hot_{c}")).otherwise(F.col(f"all_{c}")).alias(c) for c in found],
    )


def fold(id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL for a NULL id."""
    column = F.col(id) if isinstance(id, str) else id
    return F.crc32(column.cast("string").cast("binary")) % parts


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def batches(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[field.name], field.type) for field in schema], schema=schema
    )


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as far as they have been needed."""

    def __init__(self, base: int):
        self.base = np.uint64(base)
        self.inverse = np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; it is a bijection, so it adds no collisions."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Spans:
    """Rabin-Karp hashes of spans of a sequence, from its prefix sums."""

    def __init__(self, base: int):
        self.powers = Powers(base)

    def of(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of ``values[starts[i]:ends[i]]`` for every i; equal spans hash equally wherever
        they stand."""
        up, down = self.powers.upto(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * down[starts])

    def windows(self, values: np.ndarray, width: int) -> np.ndarray:
        starts = np.arange(max(0, len(values) - width + 1))
        return self.of(values, starts, starts + width)


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text's bytes, and the start and end of each of its words."""
    buffer = np.frombuffer(raw, np.uint8)
    gap = np.ones(len(buffer) + 2, np.int8)
    gap[1:-1] = SPACE[buffer]
    edges = np.flatnonzero(np.diff(gap))
    return buffer, edges[0::2], edges[1::2]


#: Words that a worker remembers, and the longest of them in bytes. Others are hashed anew.
REMEMBERED, LONGEST = 1 << 18, 64


def _factors(start: int, end: int) -> np.ndarray:
    """An odd factor for each place in a word."""
    place = np.arange(start + 1, end + 1, dtype=np.uint64)
    return mixed(place * np.uint64(0x9E6C63D0876A9A47)) | np.uint64(1)


_FACTORS = _factors(0, 256)


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of every word of a text, in order, for counting and for finding candidates.

    It sums a word's bytes times factors drawn for their places. Sequences that are built to agree
    in the powers of any base modulo 2**64 differ in it.
    """
    buffer, starts, ends = word_spans(raw)
    if not len(starts):
        return np.zeros(0, np.uint64)
    first = np.zeros(len(buffer), np.int32 if len(buffer) < 1 << 31 else np.int64)
    first[starts] = starts
    place = np.arange(len(buffer), dtype=first.dtype) - np.maximum.accumulate(first)
    longest = int((ends - starts).max())
    factors = _FACTORS if longest <= len(_FACTORS) else _factors(0, longest)
    sums = np.zeros(len(buffer) + 1, np.uint64)
    # bytes between words count for none; they may lie farther out than any word reaches
    each = factors[np.minimum(place, len(factors) - 1)]
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * each, out=sums[1:])
    return mixed(sums[ends] - sums[starts])


class _Digests(dict):
    """128 bits of every word, by a hash of which no two words with one value are known."""

    def __missing__(self, word: bytes) -> bytes:
        digest = hashlib.blake2b(word, digest_size=16).digest()
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = digest
        return digest


_DIGESTS = _Digests()


def word_digests(raw: bytes) -> np.ndarray:
    """Two independent 64-bit hashes of every word of a text, in order, one row per word: what words
    are told apart by where no test of the words themselves follows."""
    found = b"".join(map(_DIGESTS.__getitem__, raw.split()))
    return np.frombuffer(found, "<u8").reshape(-1, 2)
