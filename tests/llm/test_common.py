from pyspark.sql import functions as F

from sensorloom.llm.common import looked_up


def test_hot_keys_find_what_others_find(spark):
    rows = [(i, 7 if i % 3 else i % 50, i % 5) for i in range(30_000)] + [(1, None, 3)] * 2
    rows = spark.createDataFrame(rows, "doc_id long, k long, j long")
    facts = rows.where("k IS NOT NULL").groupBy("k", "j").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    out = looked_up(rows, facts, ["k", "j"], 30_002, ["doc_id"])
    assert out.columns == ["doc_id", "k", "j", "least"]
    want = rows.join(facts.drop("n"), ["k", "j"], "left").select(out.columns)
    assert out.exceptAll(want).count() == 0 and want.exceptAll(out).count() == 0
    assert out.where("k IS NULL AND least IS NULL").count() == 2


def test_rows_of_a_hot_key_are_dealt_out(spark):
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for c, value in zip(old, ("false", "-1")):
        spark.conf.set(c, value)
    try:
        rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(7).cast("long").alias("k"))
        facts = rows.groupBy("k").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
        out = looked_up(rows, facts, ["k"], 20_000, ["doc_id"])
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 6_000
    finally:
        for c, value in old.items():
            spark.conf.set(c, value)
