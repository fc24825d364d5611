"""Connected components of a graph whose links are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import looked_up, shared_folder


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node in ``links(a, b)``, numbers, texts or bytes: root is the
    smallest node reachable.

    Alternates two steps until neither changes a link: every node's greater neighbours are linked
    to the smallest node beside it, then its smaller ones are. Each step is one grouped minimum
    with map-side combine and one look-up, so no neighbourhood is ever gathered: what the links of
    a node with very many look for is broadcast. Rounds grow with the logarithm of the component's
    size. Rows with a NULL end or linking a node to itself link nothing. Every round ends in a
    ``checkpoint`` in the shared folder.
    """
    spark = links.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        shared_folder(spark, "links")
    kind = dict(links.dtypes)["a"]
    if kind == "string":
        links = links.select(F.col("a").cast("binary"), F.col("b").cast("binary"))
    elif kind not in ("bigint", "binary"):
        links = links.select(F.col("a").cast("long"), F.col("b").cast("long"))

    def kept(df: DataFrame) -> tuple[DataFrame, tuple]:
        df = df.distinct().checkpoint()
        # order-free digest of the links: equal digests mean that the step changed nothing
        sums = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return df, tuple(sums)

    # a > b in every link
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, before = kept(down.where("a <> b"))
    while before[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        counted = F.count("*").alias("n")
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"), counted)
        greater = current.select(F.col("b").alias("a"), F.col("a").alias("v"))
        large = looked_up(greater, least, ["a"], 2 * before[0], ["v"]).select(
            F.col("v").alias("a"), F.col("m").alias("b")
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"), counted)
        small = (
            looked_up(large, least, ["a"], before[0], ["b"])
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
        )
        current, now = kept(small)
        if now == before:
            break
        before = now
    return current.select(F.col("a").cast(kind).alias("node"), F.col("b").cast(kind).alias("root"))
