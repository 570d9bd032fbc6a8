"""Results of an outside job, read as a stream until the job has ended.

The job's folder holds numbered result files (JSON lines) and a status.  The stream's offset
is the number of files taken, so a run that breaks off goes on where its checkpoint stands,
and results are merged by batch: a batch that comes twice replaces what it wrote.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyarrow import fs as arrow_fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from textloom.sources.store import located
from textloom.streaming.incremental import batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers that plan a source may lack this package

#: ``number``: the result's place in the job.
RESULT = "custom_id string, type string, text string, input_tokens long, output_tokens long, number long"


def job_status(path: str) -> dict:
    """``ended`` and ``files``, the number of result files so far; a job not seen yet has none."""
    fs, root = located(path)
    if fs.get_file_info(f"{root}/status.json").type == arrow_fs.FileType.NotFound:
        return {"ended": False, "files": 0}
    with fs.open_input_stream(f"{root}/status.json") as f:
        return json.loads(f.read())


def set_status(path: str, files: int, ended: bool) -> None:
    """Written aside and moved, so that a reader sees the old status or the new one."""
    fs, root = located(path)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/.status.new") as f:
        f.write(json.dumps({"files": files, "ended": ended}).encode())
    fs.move(f"{root}/.status.new", f"{root}/status.json")


#: Tasks among which the new files of a batch are dealt at most.
SLICES = 200


@dataclass
class ResultFiles(InputPartition):
    """Files from ``first`` to before ``end``."""

    first: int
    end: int


class ResultReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {"files": 0}

    def latestOffset(self) -> dict:
        return {"files": job_status(self.path)["files"]}

    def partitions(self, start: dict, end: dict) -> list[ResultFiles]:
        each = max(1, -(-(end["files"] - start["files"]) // SLICES))
        return [ResultFiles(n, min(n + each, end["files"])) for n in range(start["files"], end["files"], each)]

    def read(self, partition: ResultFiles) -> Iterator[tuple]:
        fs, root = located(self.path)
        fields = [field.split()[0] for field in RESULT.split(", ")]
        for number in range(partition.first, partition.end):
            with fs.open_input_stream(f"{root}/results/{number:06d}.json") as f:
                for i, line in enumerate(f.read().decode("utf-8").splitlines()):
                    row = json.loads(line) | {"number": number * 1_000_000 + i}
                    yield tuple(row.get(field) for field in fields)

    def commit(self, end: dict) -> None:
        """Result files belong to the job, so nothing is cleared."""


class JobResults(DataSource):
    """Stream of ``RESULT`` rows; option ``path``."""

    @classmethod
    def name(cls) -> str:
        return "job_results"

    def schema(self) -> str:
        return RESULT

    def streamReader(self, schema) -> ResultReader:
        return ResultReader(self.options["path"])


def upsert_batch(sink: str) -> Callable[[DataFrame, int], None]:
    """Writes a batch to a folder of its own, which the same batch replaces."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return write


def merged(spark: SparkSession, sink: str) -> DataFrame:
    """``RESULT``: the last of each id that succeeded."""
    rows = batches(spark, sink, RESULT).where("type = 'succeeded'")
    return rows.groupBy("custom_id").agg(F.max_by(F.struct(*rows.columns), "number").alias("r")).select("r.*")


def drain_job(spark: SparkSession, path: str, sink: str, checkpoint: str, wait: float = 60.0, sleep: Callable[[float], None] = time.sleep, looks: int | None = None) -> bool:
    """Take results until the job has ended and all are in; whether that is so.

    Between looks at the status it sleeps ``wait`` seconds.  ``looks`` bounds them, as a run
    that dies would; the next run goes on from the checkpoint.
    """
    spark.dataSource.register(JobResults)
    results = spark.readStream.format("job_results").option("path", path).load()
    query = results.writeStream.foreachBatch(upsert_batch(sink)).option("checkpointLocation", checkpoint).start()
    try:
        while True:
            ended = job_status(path)["ended"]
            query.processAllAvailable()
            looks = looks and looks - 1
            if ended or looks == 0:
                return ended
            sleep(wait)
    finally:
        query.stop()
        query.awaitTermination()


def token_sums(results: DataFrame) -> DataFrame:
    """``tokens_in``, ``tokens_out`` of what succeeded."""
    done = results.where("type = 'succeeded'")
    return done.agg(F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("tokens_in"), F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("tokens_out"))
