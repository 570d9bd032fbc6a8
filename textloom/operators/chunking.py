"""Capped chunks: stateful folds over arrays, and ordered reassembly."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _extents(items: Column, cap: int) -> Column:
    """``array<struct<start, n, items, large>>`` of chunks over items (n, large, first).

    A new chunk begins where the cap would be exceeded, at a first item, and where large
    items and others meet.  A fold copies its state at each step, so there are two: one over
    runs of some sqrt(n) items, which carries all chunks, and within it one over the items,
    which carries those of the run.
    """
    kind = "array<struct<start:bigint,n:bigint,items:bigint,large:boolean>>"
    number = lambda x: F.lit(x).cast("bigint")
    none = F.array().cast(kind)
    fields = ("at", "start", "n", "items", "large")
    state = lambda done, s: F.struct(done.alias("done"), *(s[f].alias(f) for f in fields))
    start = F.struct(none.alias("done"), number(0).alias("at"), number(0).alias("start"), number(0).alias("n"), number(0).alias("items"), F.lit(False).alias("large"))
    chunk = lambda s: F.array(F.struct(s["start"], s["n"], s["items"], s["large"]))

    def item(s: Column, x: Column) -> Column:
        new = (s["items"] > 0) & ((s["n"] + x["n"] > cap) | x["first"] | (x["large"] != s["large"]))
        return F.struct(
            F.when(new, F.concat(s["done"], chunk(s))).otherwise(s["done"]).alias("done"), (s["at"] + 1).alias("at"), F.when(new, s["at"]).otherwise(s["start"]).alias("start"),
            F.when(new, x["n"]).otherwise(s["n"] + x["n"]).alias("n"), F.when(new, number(1)).otherwise(s["items"] + 1).alias("items"), x["large"].alias("large"),
        )

    def folded(xs: Column) -> Column:
        size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(xs).cast("double"))).cast("int"))
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / size).cast("int")), lambda i: F.slice(xs, i * size + 1, size))
        run = lambda s, r: let(F.aggregate(r, state(none, s), item), lambda made: state(F.concat(s["done"], made["done"]), made))
        return F.aggregate(runs, start, run, lambda s: F.concat(s["done"], F.filter(chunk(s), lambda c: c["items"] > 0)))

    return let(items, lambda xs: F.when(F.size(xs) == 0, none).otherwise(folded(xs)))


def _chunks(items: Column, cap: int, separator: str) -> Column:
    """``array<struct<text, n, items>>`` of items (text, n, large, first)."""
    joined = lambda items, c: F.call_function("array_join", F.transform(F.slice(items, c["start"].cast("int") + 1, c["items"].cast("int")), lambda x: x["text"]), F.when(c["large"], "").otherwise(separator))
    return let(items, lambda xs: F.transform(_extents(xs, cap), lambda c: F.struct(joined(xs, c).alias("text"), c["n"].alias("n"), c["items"].alias("items"))))


def _item(text: Column, size: Callable[[Column], Column], large: Column, first: Column) -> Column:
    return F.struct(text.alias("text"), size(text).cast("long").alias("n"), large.alias("large"), first.alias("first"))


def greedy(items: Column, size: Callable[[Column], Column], cap: int, separator: str) -> Column:
    """Chunks of consecutive items; a new one begins where ``cap`` would be exceeded.

    ``array<struct<text, n, items>>``.  An item beyond the cap is a chunk of its own.
    """
    no = F.lit(False)
    return _chunks(F.transform(items, lambda x: _item(x, size, no, no)), cap, separator)


def two_level(text: Column, size: Callable[[Column], Column], cap: int, outer: str, inner: str, separator: str) -> Column:
    """Chunks by paragraphs; one beyond the cap is cut by itself into sentences, which are
    joined without separator and share no chunk with other paragraphs."""
    no, yes = F.lit(False), F.lit(True)

    def units(p: Column) -> Column:
        return F.when(size(p) > cap, F.transform(F.split(p, inner, -1), lambda s, i: _item(s, size, yes, i == 0))).otherwise(F.array(_item(p, size, no, no)))

    return _chunks(F.flatten(F.transform(F.split(text, outer, -1), units)), cap, separator)


def numbered(df: DataFrame, key: str, order: str) -> DataFrame:
    """``i`` of ``n`` within each key."""
    from pyspark.sql import Window

    w = Window.partitionBy(key)
    return df.withColumn("i", F.row_number().over(w.orderBy(order)).cast("long")).withColumn("n", F.count("*").over(w))


def reassemble(df: DataFrame, key: str, order: str, text: str, separator: str) -> DataFrame:
    """Texts of a key joined in order; gaps in the numbers don't matter."""
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return df.groupBy(key).agg(F.array_join(F.transform(parts, lambda p: p["t"]), separator).alias("text"), F.count("*").alias("parts"))
