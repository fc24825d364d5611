"""Session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "sensorloom") -> SparkSession:
    """A session for tests and the local benchmark; a cluster brings its own settings."""
    shuffles = 8 if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffles))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .getOrCreate()
    )


def pin_utc(spark: SparkSession) -> None:
    """Readings carry no zone; every time text is read and written as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for ``DataFrame.checkpoint``.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder: on a cluster no other machine could read one.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current:
        return current
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that every executor can reach"
            )
        named = tempfile.mkdtemp(prefix="sensorloom-checkpoint-")
    context.setCheckpointDir(named)
    return named
