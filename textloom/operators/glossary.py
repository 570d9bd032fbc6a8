"""Term glossaries: attestation in texts, merging of variants, overlay of two lists."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import has_diacritics, term_key

#: Categories in the order in which they are listed; fixed values.
CATEGORIES = ("doctrinal", "practice", "cosmological", "person", "place", "title", "monastic_item", "other")
#: Words that tell a category, tried in this order; fixed values.
HINTS = (
    ("person", ("person", "saint", "sage", "buddha", "bodhisattva", "monk", "king", "deity", "god", "goddess", "demon")),
    ("place", ("place", "land", "realm", "mountain", "city", "heaven", "hell", "world", "continent")),
    ("practice", ("meditation", "practice", "concentration", "attainment", "perfection", "stage", "path", "precept", "virtue")),
    ("cosmological", ("eon", "kalpa", "age", "period", "realm", "existence", "rebirth", "cycle")),
)


def _sources(entries: DataFrame) -> list[Column]:
    """The sources of merged entries, for entries that list theirs."""
    return [F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("sources")] if "sources" in entries.columns else []


def _best(entries: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order``, with the sources of all.

    A minimum over a struct has a partial aggregate, where a window would sort whole groups.
    """
    rank = F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)))
    kept = F.struct("english", "chinese", "sanskrit", "category")
    sources = _sources(entries)
    return entries.groupBy(*keys).agg(F.min_by(kept, rank).alias("best"), *sources, F.min("pos").alias("first_pos")).select("best.*", *["sources"] * len(sources), "first_pos")


def dedup_by_source_term(entries: DataFrame) -> DataFrame:
    """Rows of one source term and category merged: with marks first, then shorter, then by
    alphabet; rows without source term by English without plural: most sources, then
    shorter, then first.  Entries have ``sources``, or ``n_sources``, their number, where
    nothing that follows needs more."""
    n_sources = F.size("sources") if "sources" in entries.columns else F.col("n_sources")
    with_term = entries.where("chinese <> ''")
    without = entries.where("chinese = ''").withColumn("norm", term_key(F.col("english")))
    a = _best(with_term, ["chinese", "category"], [~has_diacritics(F.col("english")), F.length("english"), F.col("english"), F.col("pos")]).withColumn("part", F.lit(0))
    b = _best(without, ["norm", "category"], [-n_sources, F.length("english"), F.col("pos")]).withColumn("part", F.lit(1))
    return a.unionByName(b)


def dedup_across_categories(entries: DataFrame) -> DataFrame:
    """One row per English term in any case: the first in (part, first_pos) order."""
    kept = F.struct("english", "chinese", "sanskrit", "category", "part", "first_pos")
    sources = _sources(entries)
    return entries.groupBy(F.lower("english").alias("__key")).agg(F.min_by(kept, F.struct("part", "first_pos")).alias("best"), *sources).select("best.*", *["sources"] * len(sources))


def overlay(own: DataFrame, published: DataFrame, prefix: str = "") -> DataFrame:
    """Full outer merge on the trimmed English term in lower case.

    Own values win for english, chinese and category (of repeated own keys the last row);
    the published list gives definition and source (last row), and sanskrit where own is
    empty (first non-empty one).  Missing values are empty strings.  ``prefix`` goes before
    every published source, also before one that has it already.
    """
    key = F.lower(F.trim("english")).alias("key")
    last = lambda c: F.max_by(c, "pos").alias(c)
    left = own.groupBy(key).agg(last("english"), last("chinese"), last("sanskrit"), last("category"), F.min("pos").alias("own_pos"))
    right = published.groupBy(key).agg(
        F.min_by("english", "pos").alias("p_english"), F.max_by("definition", "pos").alias("p_definition"), F.max_by("source", "pos").alias("p_source"),
        F.min_by(F.col("sanskrit"), F.when(F.col("sanskrit") != "", F.col("pos"))).alias("p_sanskrit"),
        F.min_by(F.concat_ws(" ", "definition", "english"), "pos").alias("p_hint"),
    )
    return left.join(right, "key", "full_outer").select(
        F.coalesce("english", "p_english").alias("english"),
        F.coalesce("chinese", F.lit("")).alias("chinese"),
        F.coalesce(F.nullif("sanskrit", F.lit("")), "p_sanskrit", F.lit("")).alias("sanskrit"),
        F.coalesce("category", classify(F.col("p_hint"))).alias("category"),
        F.coalesce("p_definition", F.lit("")).alias("definition"),
        F.coalesce(F.concat(F.lit(prefix), F.col("p_source")), F.lit("own")).alias("source"),
    )


def classify(text: Column) -> Column:
    """The first category with a hint in the text, else doctrinal."""

    def first(lowered: Column) -> Column:
        out = F
        for name, hints in HINTS:
            out = out.when(reduce(or_, (lowered.contains(h) for h in hints)), name)
        return out.otherwise("doctrinal")

    return F.element_at(F.transform(F.array(F.lower(text)), first), 1)  # lowered once


def render(english: Column, chinese: Column, sanskrit: Column, definition: Column, source: Column) -> Column:
    """One glossary line."""
    head = F.concat_ws(
        " ", F.concat(F.lit("**"), english, F.lit("**")), F.when(chinese != "", F.concat(F.lit("("), chinese, F.lit(")"))),
        F.when((sanskrit != "") & (sanskrit != english), F.concat(F.lit("Skt. *"), sanskrit, F.lit("*"))),
    )
    return F.concat(head, F.when(definition != "", F.concat(F.lit(": "), definition)).otherwise(""), F.when(source != "own", F.concat(F.lit(" ["), source, F.lit("]"))).otherwise(""))


def sections(entries: DataFrame) -> DataFrame:
    """Per listed category its count and its terms in order; other categories vanish."""
    order = F.array(*map(F.lit, CATEGORIES))
    return (
        entries.where(F.col("category").isin(*CATEGORIES)).groupBy("category")
        .agg(F.count("*").alias("n"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.lower("english").alias("k"), "english"))), lambda e: e["english"]), ";").alias("terms"))
        .withColumn("rank", F.array_position(order, F.col("category")).cast("long"))
    )


def first_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key."""
    return df.groupBy(key).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("__row")).select("__row.*")


#: Bold term, parenthetical, definition; fixed format.
ENTRY = r"(?s)^\*\*(.+?)\*\*\s*(?:\(([^)]*)\))?\s*(?::\s*)?(.*)"


def parse_markdown(text: Column) -> Column:
    """``array<struct<term, parenthetical, definition>>`` of paragraphs that are entries."""
    paragraphs = F.transform(F.split(text, r"\n\s*\n", -1), lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", ""))
    entries = F.filter(paragraphs, lambda p: (p != "") & ~p.startswith("#") & p.rlike(ENTRY))
    get = lambda p, k: F.trim(F.regexp_extract(p, ENTRY, k))
    return F.transform(entries, lambda p: F.struct(get(p, 1).alias("term"), get(p, 2).alias("parenthetical"), get(p, 3).alias("definition")))
