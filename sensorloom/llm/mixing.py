"""Mixing of sources to target weights: a temperature on token shares, realised in whole blocks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorloom.llm.common import WORD, stored

#: Blocks of a source; steps that bisect the exponent; exponents looked at in one pass.
BLOCKS, HALVINGS, AT_ONCE = 1_024, 40, 5
#: Powers are summed in this type, so that the order of rows does not show in any digit.
EXACT = "decimal(28,18)"
#: Up to so many rows the plan of all blocks is broadcast; past it, it is joined by shuffle.
BROADCAST_ROWS = 200_000


def chance(*parts: Column) -> Column:
    """A number from 0 to 2**32 - 1 that the parts alone decide."""
    text = F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x1e")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def exponent(
    sources: DataFrame, budget: float, entropy: float | None = None, repeats: float | None = None
) -> float:
    """The greatest exponent in [0, 1] (nearest to the natural shares) for which ``sources(tokens)``
    reach the target: an entropy of weights of at least ``entropy`` (as a share of the greatest
    possible one), or, with ``repeats``, the smallest exponent whose most repeated source is taken
    at most so often for ``budget`` tokens in all. If the target cannot be met, the nearest end.

    Bisected: every pass over the sources evaluates the exponents of the next ``AT_ONCE`` halvings.
    """
    if (entropy is None) == (repeats is None):
        raise ValueError("give either entropy or repeats")
    total = sources.agg(F.sum("tokens"), F.max("tokens"), F.count("*")).first()
    if not total[2]:
        return 1.0

    def passes(values: list[float]) -> dict[float, bool]:
        grid = F.explode(F.array(*[F.lit(v) for v in values])).alias("a")
        # relative to the largest source, so that no power overflows
        power = F.pow(F.col("tokens") / F.lit(float(total[1])), F.col("a"))
        rows = sources.select("tokens", grid).withColumn("p", power)
        sums = rows.groupBy("a").agg(
            F.sum(F.col("p").cast(EXACT)).cast("double").alias("z"),
            F.sum((F.col("p") * F.ln("p")).cast(EXACT)).cast("double").alias("plogp"),
            F.max(F.col("p") / F.col("tokens")).alias("most"),
        )
        out = {}
        for r in sums.collect():
            if repeats is not None:
                out[r.a] = budget * r.most / r.z <= repeats
            else:
                top = math.log(total[2])
                out[r.a] = top == 0 or (math.log(r.z) - r.plogp / r.z) / top >= entropy
        return out

    # low entropy at 1, many repeats at 0
    low, high = 0.0, 1.0
    ends = passes([low, high])
    if repeats is not None:
        if ends[0.0] or not ends[1.0]:
            return 0.0 if ends[0.0] else 1.0
    elif ends[1.0] or not ends[0.0]:
        return 1.0 if ends[1.0] else 0.0
    for _ in range(HALVINGS // AT_ONCE):
        parts = 2**AT_ONCE
        grid = [low + (high - low) * i / parts for i in range(1, parts)]
        good = passes(grid)
        for _ in range(AT_ONCE):
            middle = len(grid) // 2
            at = grid[middle]
            if good[at] == (repeats is not None):
                high, grid = at, grid[:middle]
            else:
                low, grid = at, grid[middle + 1 :]
    return high if repeats is not None else low


def mixed(
    docs: DataFrame,
    budget: float | None = None,
    entropy: float | None = None,
    repeats: float | None = None,
    blocks: int = BLOCKS,
    seed: int = 0,
) -> DataFrame:
    """The training order of ``docs(doc_id, text, source)``: a row for every time a document is
    taken, with all columns of ``docs`` and ``mix_tokens, mix_weight, mix_epoch, mix_block,
    mix_rank`` (read in order of epoch, then rank; then of doc_id's hash).

    A source's weight is its share of tokens (words) to the power of the exponent that meets the
    target, normalised; its quota is that share of ``budget`` tokens (all tokens by default), rounded. The
    quota is filled in epochs. Each epoch permutes the source's blocks, which the document's hash
    makes; all but the last take every block, the last takes blocks in order while they fit, and of
    the block at the boundary documents in order of hash while they start below the quota. So a
    source exceeds its quota by less than one document.

    Default target: an entropy of weights of 0.9 of the greatest possible one. Sources without a
    token (NULL or empty texts alone) have no weight and give no row, and a document without tokens
    in another source is taken like the documents of its block. A NULL source is a source of its
    own. Repeated rows count as often as they stand. Column names with ``mix_`` are replaced.
    """
    if entropy is None and repeats is None:
        entropy = 0.9
    plain = [c for c in docs.columns if not c.startswith("mix_")]
    key = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    rows = docs.select(
        F.struct(*plain).alias("doc"),
        key.alias("key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
        chance(F.lit(seed), F.col("doc_id")).alias("hash"),
    ).withColumn("block", (F.col("hash") % blocks).cast("int"))
    # at most ``blocks`` rows for a source, whatever its size
    sums = stored(rows.groupBy("key", "block").agg(F.sum("tokens").alias("tokens")), "blocks")
    sources = stored(
        sums.groupBy("key").agg(F.sum("tokens").alias("tokens")).where("tokens > 0"), "sources"
    )
    all_tokens = sources.agg(F.sum("tokens"), F.max("tokens")).first()
    budget = float(all_tokens[0] or 0) if budget is None else float(budget)
    a = exponent(sources, budget, entropy, repeats)
    power = F.pow(F.col("tokens") / F.lit(float(all_tokens[1] or 1)), F.lit(a))
    z = float(sources.agg(F.sum(power.cast(EXACT))).first()[0] or 1.0)
    quotas = sources.select(
        "key",
        (power / F.lit(z)).alias("weight"),
        # whole tokens: a rounding error above a whole number of epochs must take no document
        F.round(power / F.lit(z) * F.lit(budget)).alias("quota"),
        F.col("tokens").alias("whole"),
    ).withColumn("epochs", F.floor(F.col("quota") / F.col("whole")).cast("int"))
    order = Window.partitionBy("key").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        sums.join(quotas, "key")
        .withColumn("turn", chance(F.lit(seed), F.lit("order"), F.col("epochs"), F.col("key"), F.col("block")))
        .withColumn("before", F.coalesce(F.sum("tokens").over(order), F.lit(0)))
        .withColumn("left", F.col("quota") - F.col("epochs") * F.col("whole") - F.col("before"))
        .select("key", "block", "weight", "epochs", "turn", "left", F.col("tokens").alias("in_block"))
    )
    last = stored(last, "plan")
    plan = F.broadcast(last) if last.count() <= BROADCAST_ROWS else last
    # the cut inside the boundary blocks, one for each source
    edges = plan.where("left > 0 AND left < in_block").select("key", "block", "left")
    inside = Window.partitionBy("key", "block").orderBy("hash")
    cuts = (
        rows.drop("doc")
        .join(edges, ["key", "block"])
        .groupBy("key", "block", "left", "hash")
        .agg(F.sum("tokens").alias("tokens"))
        .withColumn("before", F.sum("tokens").over(inside) - F.col("tokens"))
        .where("before < left")
        .groupBy("key", "block")
        .agg(F.max("hash").alias("upto"))
    )
    plan = stored(
        plan.join(cuts, ["key", "block"], "left").select(
            "key", "block", "weight", "epochs",
            F.when(F.col("left") <= 0, -1)
            .when(F.col("left") >= F.col("in_block"), 1 << 32)
            .otherwise(F.col("upto"))
            .alias("upto"),
        ),
        "plan",
    )
    plan = F.broadcast(plan) if plan.count() <= BROADCAST_ROWS else plan
    taken = (
        rows.join(plan, ["key", "block"])
        .withColumn("times", F.col("epochs") + (F.col("hash") <= F.col("upto")).cast("int"))
        .where("times > 0")
        .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    )
    return taken.select(
        *[F.col("doc").getField(c).alias(c) for c in plain],
        F.col("tokens").alias("mix_tokens"),
        F.col("weight").alias("mix_weight"),
        "mix_epoch",
        F.col("block").alias("mix_block"),
        chance(F.lit(seed), F.lit("order"), F.col("mix_epoch"), F.col("key"), F.col("block")).alias("mix_rank"),
    )
