"""Sections: as-of assignment of lines, paragraphs from runs of lines, banner splitting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of(rows: DataFrame, starts: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Each row with the ``value`` of the latest start at or before it (backward as-of).

    Both sides are united and sorted once per key; no pairs are made.  A row before the
    first start takes the first start.
    """
    left = rows.withColumn("__side", F.lit(1)).withColumn("__value", F.lit(None).cast(starts.schema[value].dataType))
    right = starts.select(key, order, F.col(value).alias("__value")).withColumn("__side", F.lit(0))
    w = Window.partitionBy(key).orderBy(order, "__side")
    last = F.last("__value", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    first = F.first("__value", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return left.unionByName(right, allowMissingColumns=True).withColumn(value, F.coalesce(last, first)).where("__side = 1").drop("__side", "__value")


#: Width of an ideographic space, which lines may begin with; a fixed value.
WIDE_SPACE = "\u3000"


def trimmed(text: Column) -> Column:
    """Without white space of any kind at both ends; null counts as empty."""
    return F.coalesce(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), F.lit(""))


def paragraphs(lines: DataFrame, key: str, order: str, text: str, section: str | None = None) -> DataFrame:
    """Runs of non-empty lines joined without separator, each without ideographic spaces in
    front; an empty line or a new section ends a run (gaps and islands)."""
    w = Window.partitionBy(key).orderBy(order)
    empty = trimmed(F.col(text)) == ""
    begins = empty if section is None else empty | (F.col(section) != F.lag(section).over(w))
    numbered = lines.withColumn("__break", begins.cast("int")).withColumn("__empty", empty)
    grouped = numbered.withColumn("island", F.sum(F.coalesce("__break", F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0))).where(~F.col("__empty"))
    line = F.regexp_replace(text, f"^{WIDE_SPACE}+", "")
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("t"))))
    more = [] if section is None else [F.first(section).alias(section)]
    return grouped.groupBy(key, "island").agg(F.array_join(F.transform(parts, lambda p: p["t"]), "").alias("paragraph"), F.count("*").alias("n_lines"), F.min(order).alias("first"), *more)


def lines_in_sections(lines: DataFrame, starts: DataFrame, key: str, order: str) -> DataFrame:
    """Each line with ``section``: how many starts after the first it has reached.

    ``starts``: key, order, ``idx`` (from 0).  A start is reached by a line at or after it
    and after all starts before it in the list, so positions that run back wait for the
    largest before them.  The first start's own position doesn't matter: lines before it
    are in section 0, as are the lines of a key without starts.
    """
    reached = F.max(order).over(Window.partitionBy(key).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0))
    later = starts.where("idx > 0").select(key, reached.alias(order), F.col("idx").alias("__idx"), F.lit(0).alias("__side"))
    both = lines.withColumn("__side", F.lit(1)).unionByName(later, allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(order, "__side", "__idx").rowsBetween(Window.unboundedPreceding, 0)
    last = F.coalesce(F.last("__idx", ignorenulls=True).over(w), F.lit(0))
    return both.withColumn("section", last.cast("int")).where("__side = 1").drop("__side", "__idx")


def sectioned_text(lines: DataFrame, starts: DataFrame, key: str, order: str, text: str, noise: Callable[[Column], Column]) -> DataFrame:
    """``key``, ``seq``, ``kind`` (header or paragraph), ``section`` (from 1), ``content``: the
    events of each text in order.

    ``starts``: key, order, ``idx`` (from 0), ``title``.  Noise lines go first, so they reach
    nothing.  A line that reaches several starts emits a header for each, also for those
    that hold no line; the first section has one only if the first line is in it; starts
    after the last line, and texts without starts, have none.  Headers and empty lines end
    a paragraph.
    """
    line = trimmed(F.col(text))
    kept = lines.select(key, order, line.alias("__line")).where(~noise(line))
    placed = lines_in_sections(kept, starts, key, order)
    before = F.lag("section").over(Window.partitionBy(key).orderBy(order))
    first = F.when(before.isNull(), F.least(F.col("section"), F.lit(1))).otherwise(before + 1)
    crossed = placed.withColumn("__from", first).where(F.col("__from") <= F.col("section"))
    titles = starts.select(key, "idx", F.col("title").alias("content"))
    headers = (
        crossed.select(key, F.col(order).alias("first"), F.explode(F.sequence("__from", "section")).alias("idx")).join(titles, [key, "idx"])
        .select(key, "first", F.lit(0).alias("__rank"), F.col("idx").alias("section"), F.lit("header").alias("kind"), "content")
    )
    runs = paragraphs(placed, key, order, "__line", "section").select(key, "first", F.lit(1).alias("__rank"), "section", F.lit("paragraph").alias("kind"), F.col("paragraph").alias("content"))
    seq = F.row_number().over(Window.partitionBy(key).orderBy("first", "__rank", "section"))
    return headers.unionByName(runs).select(key, seq.cast("long").alias("seq"), "kind", (F.col("section") + 1).cast("long").alias("section"), "content")


def section_counts(texts: DataFrame, starts: DataFrame, key: str) -> DataFrame:
    """``n_sections`` of every text: its starts, or 1 without any."""
    n = starts.groupBy(key).agg(F.count("*").alias("n_sections"))
    return texts.select(key).join(n, key, "left").select(key, F.coalesce("n_sections", F.lit(1)).cast("long").alias("n_sections"))


#: Bars of a section's banner; fixed format.
BAR = "=" * 40


def rendered_sections(events: DataFrame, key: str) -> DataFrame:
    """``key``, ``body``: banners and paragraphs as lines."""
    banner = F.concat(F.lit(f"\n{BAR}\nFascicle "), F.format_string("%03d", "section"), F.lit(": "), F.col("content"), F.lit(f"\n{BAR}\n"))
    part = F.when(F.col("kind") == "header", banner).otherwise(F.col("content"))
    parts = F.sort_array(F.collect_list(F.struct("seq", part.alias("part"))))
    return events.groupBy(key).agg(F.array_join(F.transform(parts, lambda p: p["part"]), "\n").alias("body"))


#: A banner with a number and a title; fixed format.
BANNER = r"={10,}\nFascicle (\d+): [^\n]+\n={10,}\n"


def split_by_banner(text: Column, banner: str = BANNER) -> Column:
    """``array<struct<num, content>>`` in order; what stands before the first banner is left out."""
    numbers = F.regexp_extract_all(text, F.lit(banner), F.lit(1))
    contents = F.slice(F.split(text, banner, -1), 2, F.greatest(F.size(numbers), F.lit(1)))
    return F.when(F.size(numbers) == 0, F.array().cast("array<struct<num:int,content:string>>")).otherwise(
        F.zip_with(numbers, contents, lambda n, c: F.struct(n.cast("int").alias("num"), F.regexp_replace(c, r"(?U)^\s+|\s+$", "").alias("content")))
    )


def merge_sections(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Contents of equal numbers joined in order; ``of_n`` counts all numbers, empty ones
    too, which themselves are left out."""
    parts = texts.select(key, F.posexplode(split_by_banner(F.col(text)))).select(key, "pos", "col.num", "col.content")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "content"))), lambda p: p["content"]), "\n\n")
    merged = parts.groupBy(key, "num").agg(joined.alias("content"))
    return merged.withColumn("of_n", F.count("*").over(Window.partitionBy(key))).where(trimmed(F.col("content")) != "")


def split_sections(text: Column, pattern: str) -> Column:
    """``array<struct<num, content>>``: what lies between the matches, without parts that are
    blank or begin with ``#``, numbered anew from 1; equal titles are not merged."""
    parts = F.filter(F.transform(F.split(text, pattern, -1), lambda x: F.trim(x)), lambda x: (x != "") & ~x.startswith("#"))
    return F.transform(parts, lambda x, i: F.struct((i + 1).cast("int").alias("num"), x.alias("content")))
