"""Catalogues and outstanding work: filters, anti-joins, histograms, counters, costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Upper ends of the size classes; fixed values.
SIZES = (1, 5, 20, 60)
#: Price of a million tokens in and out; fixed values.
PRICE_IN, PRICE_OUT = 2.50, 12.50


def size_class(n: Column) -> Column:
    low = 0
    out = F
    for high in SIZES:
        out = out.when(n <= high, f"{low + 1}-{high}" if low + 1 < high else f"{high}")
        low = high
    return out.otherwise(f">{low}")


def outstanding(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return work.join(done.select(key), key, "left_anti")


def from_start(work: DataFrame, key: str, start, pos: str) -> DataFrame:
    """Rows from the first with ``key >= start`` on, in order of ``pos``; without such a row, all."""
    first = work.where(F.col(key) >= F.lit(start)).agg(F.coalesce(F.min(pos), F.lit(0)).alias("__from"))
    return work.join(F.broadcast(first), F.col(pos) >= F.col("__from")).drop("__from")  # one row


def routed(work: DataFrame, splits: DataFrame, key: str, size: str, cap: int) -> DataFrame:
    """``route``: whole up to the cap; beyond it by sections if there are any, else skipped."""
    has = splits.select(F.col(key).alias("__key")).distinct()
    large = F.col(size) > cap
    return work.join(has, F.col(key) == F.col("__key"), "left").withColumn("route", F.when(~large, "whole").when(F.col("__key").isNotNull(), "sections").otherwise("skipped")).drop("__key")


def zero_filled(rows: DataFrame, category: str, domain: list[str]) -> DataFrame:
    """Counts over a fixed domain, zeros kept."""
    spark = rows.sparkSession
    names = spark.createDataFrame([(d,) for d in domain], f"{category} string")
    return names.join(rows.groupBy(category).agg(F.count("*").alias("n")), category, "left").select(category, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def upsert(log: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    return outstanding(log, fresh, key).unionByName(fresh)


def cost(tokens_in: Column, tokens_out: Column) -> Column:
    return tokens_in / 1e6 * PRICE_IN + tokens_out / 1e6 * PRICE_OUT


def estimate(n_chars: Column, prompt_chars: int) -> Column:
    """``struct<tokens_in, tokens_out>`` before a run."""
    tokens_in = F.floor(n_chars / 2) + F.lit(prompt_chars // 4)
    return F.struct(tokens_in.cast("long").alias("tokens_in"), (2 * tokens_in).cast("long").alias("tokens_out"))


def hourly_rate(total: Column, seconds: Column) -> Column:
    """Per hour, half to even; 0 without time."""
    return F.coalesce(F.bround(total / F.nullif(seconds / 3600, F.lit(0.0)), 0), F.lit(0.0))


def at_most(work: DataFrame, column: str, most: int | None) -> DataFrame:
    """Rows up to ``most``; 0 or None is no limit."""
    return work.where(F.col(column) <= most) if most else work


def batch_plan(work: DataFrame, done: DataFrame, key: str, pos: str, group: str, only: str | None, start_key: str, start, size: str, most: int | None) -> DataFrame:
    """What a batch run works on, in this order: one group (None: all), from the start on,
    less what is done, at most so large; smallest first."""
    if only is not None:
        work = work.where(F.col(group) == only)
    if start is not None:
        work = from_start(work, start_key, start, pos)
    return at_most(outstanding(work, done, key), size, most).orderBy(size, pos)


def interactive_plan(work: DataFrame, done: DataFrame, key: str, pos: str, start_key: str, start, size: str, most: int | None) -> DataFrame:
    """What an interactive run works on: the limit comes before the start, so the first row
    at or after the start is looked for among small texts only."""
    work = at_most(work, size, most)
    if start is not None:
        work = from_start(work, start_key, start, pos)
    return outstanding(work, done, key).orderBy(size, pos)


def preview(work: DataFrame, order: list[str], most: int) -> DataFrame:
    """The first rows, each with ``more``, how many the preview leaves out."""
    rest = work.agg(F.greatest(F.count("*") - most, F.lit(0)).alias("more"))  # one row
    return work.orderBy(*order).limit(most).crossJoin(F.broadcast(rest))


def finished(files: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """Keys that have a file and an entry in the log."""
    return files.select(key).join(log.select(key), key, "left_semi").distinct()


def looked_up(work: DataFrame, table: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with what the table has for their key, and the rows that miss it, to be warned of."""
    return work.join(table, key), outstanding(work, table, key)


def by_rank(rows: DataFrame, category: str, ranks: list[str], *then: Column) -> DataFrame:
    """``rank`` by the listed order, 99 if not listed; in this order."""
    place = F.array_position(F.array(*map(F.lit, ranks)), F.col(category))
    return rows.withColumn("rank", F.when(F.coalesce(place, F.lit(0)) > 0, place).otherwise(99).cast("int")).orderBy("rank", *then)


def grouped_files(files: DataFrame, pattern: str) -> DataFrame:
    """``id``, ``n_files``, ``paths`` in order, of a listing (``path``).

    Group 1 of the pattern is the id; paths that don't match belong to none.  The paths of
    one id become one row.
    """
    named = files.select("path", F.regexp_extract("path", pattern, 1).alias("id")).where("id <> ''")
    return named.groupBy("id").agg(F.count("*").alias("n_files"), F.array_sort(F.collect_list("path")).alias("paths"))


def summary(rows: DataFrame, category: str, size: str) -> DataFrame:
    """``category``, ``n``, ``total``, ``share`` (per cent with one decimal, as text), of a catalogue."""
    sums = rows.groupBy(category).agg(F.count("*").alias("n"), F.sum(size).alias("total"))
    whole = rows.agg(F.sum(size).alias("__whole"))  # one row
    return sums.crossJoin(F.broadcast(whole)).select(category, "n", F.format_number("total", 0).alias("total"), F.format_string("%.1f", F.bround(F.col("total") * 100 / F.col("__whole"), 1)).alias("share"))


#: Characters that a draft and a review have at least, and bytes of a file that counts; fixed values.
LEAST_DRAFT, LEAST_REVIEW, LEAST_BYTES = 50, 100, 100


def valid(text: Column, error: Column, least: int) -> Column:
    """Whether a result came through and is long enough."""
    return error.isNull() & (F.length(text) >= least)


def real_files(files: DataFrame, size: str) -> DataFrame:
    """Files that hold more than a stub."""
    return files.where(F.col(size) > LEAST_BYTES)


def up_to_last_page(lines: DataFrame, bounds: DataFrame, key: str, ref: str, last: str) -> DataFrame:
    """Lines whose page, the first four characters of the reference, isn't beyond the last page of their text."""
    return lines.join(bounds.select(key, last), key).where(F.substring(ref, 1, 4) <= F.col(last)).drop(last)


def paired(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """All columns of both and ``side``: both, or the one that has the key alone."""
    marked = left.withColumn("__left", F.lit(True)).join(right.withColumn("__right", F.lit(True)), key, "full_outer")
    return marked.withColumn("side", F.when(F.col("__right").isNull(), "left").when(F.col("__left").isNull(), "right").otherwise("both")).drop("__left", "__right")


def chosen(work: DataFrame, key: str, ids: DataFrame | None = None, tier: int | None = None) -> DataFrame:
    """Rows of the ids, or of the tier, or all."""
    if ids is not None:
        return work.join(ids.select(key).distinct(), key, "left_semi")
    return work if tier is None else work.where(F.col("tier") == tier)
