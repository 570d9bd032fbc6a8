"""Global positions without a window over all rows, and orders that ignore marks and case.

Rows are dealt to ranges of the order, numbered within each range, and every range begins
where the counts of those before it end.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textloom.streaming.incremental import shared_folder

#: Rows that one task numbers, on average.
TOGETHER = 100_000


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read from there."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Tasks for each core among which ``spread`` deals rows.
SPREAD = 4


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt to all cores, at random or by columns: a file that compresses well is one
    task, however much there is to do with its rows."""
    return df.repartition(SPREAD * df.sparkSession.sparkContext.defaultParallelism, *by)


def with_positions(df: DataFrame, order: list[str], name: str = "pos", together: int = TOGETHER) -> DataFrame:
    """``df`` with ``name``: places from 0 in the order of these columns, gapless.

    Rows that are equal in the order keep that of the input.  Ranges are cut between such
    rows too, so a value that a third of all rows have fills no single task.
    """
    placed = kept(df.withColumn("__at", F.monotonically_increasing_id()), "rows")  # read for its count, its ranges, and its rows
    n = max(1, -(-placed.count() // together))
    ranged = kept(placed.repartitionByRange(n, *order, "__at").withColumn("__range", F.spark_partition_id()), "ranges") if n > 1 else placed.withColumn("__range", F.lit(0))
    local = ranged.withColumn("__local", F.row_number().over(Window.partitionBy("__range").orderBy(*order, "__at")) - 1)
    before = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per range
    starts = ranged.groupBy("__range").agg(F.count("*").alias("n")).select("__range", before.alias("__before"))
    return local.join(starts, "__range").select(*df.columns, (F.col("__before") + F.col("__local")).cast("long").alias(name))


def folded(text: Column | str) -> Column:
    """Compatibility decomposition without combining marks, in lower case; for any script.

    Spark has no function that decomposes, so this runs in Python; fold distinct values.
    """

    @F.pandas_udf(StringType())
    def fold(values: pd.Series) -> pd.Series:
        return values.map(lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower(), na_action="ignore")

    return fold(text)
