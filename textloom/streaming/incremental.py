"""Incremental runs: what is new since the last run, exactly once."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: below ``spark.checkpoint.dir``, or, where
    that is unset and Spark runs in one process, a local one."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="textloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drain(spark: SparkSession, source: str, schema: StructType, sink: str, checkpoint: str, transform=lambda df: df) -> StreamingQuery:
    """Read the files of ``source`` that no run has read, transform, append, and end.

    The checkpoint replaces done markers and locks: a run that breaks off goes on where it
    stopped.  Both folders must be shared storage on a cluster.
    """
    new = transform(spark.readStream.schema(schema).parquet(source))
    return new.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class DeadlinePassed(Exception):
    """No work is begun any more."""


def drain_until(spark: SparkSession, source: str, schema: StructType, sink: str, checkpoint: str, deadline: float, transform=lambda df: df, clock: Callable[[], float] = time.monotonic, files_a_batch: int = 1) -> bool:
    """As ``drain``, file by file, until the clock has reached the deadline; whether all is done.

    Work that has begun is finished; nothing is begun after the deadline.  What was not
    begun is in the checkpoint, and the next run begins with it.  A batch has a folder of its
    own below the sink, which the same batch would replace, so none counts twice.
    """
    stopped = []

    def work(batch: DataFrame, number: int) -> None:
        if clock() >= deadline:
            stopped.append(number)
            raise DeadlinePassed
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    new = transform(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(source))
    query = new.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not stopped:
            raise
    return not stopped


def batches(spark: SparkSession, sink: str, schema: StructType | str) -> DataFrame:
    """What runs have put below the sink, a folder for each batch."""
    return spark.read.schema(schema).option("basePath", sink).parquet(sink).drop("batch")


def succeeded(results: DataFrame) -> DataFrame:
    """Results that came through, once per id."""
    return results.where("type = 'succeeded'").dropDuplicates(["custom_id"])
