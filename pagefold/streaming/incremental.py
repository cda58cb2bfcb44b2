"""Incremental runs: skip what is done, or follow a landing folder as a stream of available files."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint(spark: SparkSession) -> None:
    """The shared folder of spark.checkpoint.dir is used where it is set; a local run, as in tests, takes a temporary one."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pagefold-"))


def not_done(wanted: DataFrame, done: DataFrame, key: list[str], force: bool = False) -> DataFrame:
    """Rows whose key has no output yet; all of them with force."""
    return wanted if force else wanted.join(done.select(*key).distinct(), key, "left_anti")


def follow(spark: SparkSession, landing: str, schema: str, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], file_format: str = "json") -> None:
    """Brings all files that have landed since the last run through transform, each once, then stops."""
    stream = spark.readStream.schema(schema).format(file_format).load(landing)
    transform(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
