"""Files as relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.positions import with_positions


def texts(spark: SparkSession, path: str, key_pattern: str) -> DataFrame:
    """``key``, ``text`` of whole files; of files with one key the last name wins."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), key_pattern, 1).alias("key"), "value", F.input_file_name().alias("name"))
    return whole.where("key <> ''").groupBy("key").agg(F.max_by("value", "name").alias("text"))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Paths and sizes only; contents aren't read."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")


def json_array(spark: SparkSession, path: str, schema: str, optional: bool = False) -> DataFrame:
    """Rows of a JSON array; of an ``optional`` file that isn't there, none."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if optional and not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).json(path)


#: Columns of a table of seed terms.
SEED = "english string, chinese string, sanskrit string, category string"


def seed_terms(spark: SparkSession, path: str) -> DataFrame:
    """``pos`` (order of the rows, from 0) and ``SEED`` of a table with tabs and a header.

    Missing values are empty.
    """
    rows = spark.read.csv(path, sep="\t", header=True, schema=SEED).fillna("")
    return with_positions(rows, [], "pos").select("pos", *rows.columns)


def write_seed(terms: DataFrame, path: str) -> None:
    """Seed terms (``pos`` and ``SEED``) as such a table, rows by ``pos``."""
    columns = [c.split()[0] for c in SEED.split(", ")]
    terms.orderBy("pos").select(*columns).write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="")


def timings(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def write_keyed(df: DataFrame, path: str, key: str, text: str) -> None:
    """Texts in one folder per key."""
    df.select(key, F.col(text).alias("value")).write.mode("overwrite").partitionBy(key).text(path)


def write_titled(df: DataFrame, path: str, key: str, header: list, text: str) -> None:
    """Texts below their header lines (columns; nulls are left out), in one folder per key."""
    whole = F.concat_ws("\n", *header, F.lit(""), F.col(text))
    df.select(key, whole.alias("value")).write.mode("overwrite").partitionBy(key).text(path)


def write_catalogue(df: DataFrame, path: str) -> None:
    """Rows as JSON, one object a line; nulls stay visible."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
