"""Plumbing shared by the operators: written intermediates, shipped code, Arrow bytes."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset and Spark
    runs in one process (a test) is a folder made here.
    """
    sc = spark.sparkContext
    if named := sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None):
        return f"{named.rstrip('/')}/{sc.applicationId}"
    if sc.getCheckpointDir() is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-"))
    return sc.getCheckpointDir()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage at files that outlive any executor, and makes what
    follows read columns instead of computing them once more for every use.
    """
    return _written(df, f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}")


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Tables:
    """Written intermediates of one operator.

    Those of ``written`` are deleted at the end of the ``with`` block or by ``drop``, so
    only what ``kept`` writes, the tables that the operator's result reads, stays.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_dir(spark)}/tables-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *_) -> None:
        self._delete(self.folder)

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        made = _written(df, path)
        self.paths[id(made)] = path
        self._release()
        return made

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        made = written(df, name)
        self._release()
        return made

    def drop(self, *made: DataFrame) -> None:
        """Delete tables of ``written`` that nothing reads any more."""
        for df in made:
            self._delete(self.paths.pop(id(df)))

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def _release(self) -> None:
        """Spark deletes the shuffle files of a finished step once the driver has
        collected its garbage, which may otherwise take longer than the operator."""
        gc.collect(0)
        self.spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Return this process's freed memory to the system, where its C library can."""
    gc.collect()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    out = Path(tempfile.mkdtemp(prefix="textloom-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, os.path.join(package.name, p.relative_to(package)))
    sc.addPyFile(str(out))
    _SHIPPED.add(sc.applicationId)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; a null counts as an empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def fold_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def safe_names(df: DataFrame, *needed: str) -> DataFrame:
    """Only the needed columns: extra columns, whatever their names, can't clash."""
    return df.select(*needed)
