"""Whole runs, composed of operators; each is one lazy plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import drop_comment_lines
from textloom.operators import attestation, catalog, chunking, glossary, positions, rewrite
from textloom.operators.external import transform_chunks


def batch_run(sources: DataFrame, done: DataFrame, fn: Callable[[str], str], size: Callable[[Column], Column], cap: int, separator: str = "\n\n") -> DataFrame:
    """``key``, ``text``, ``parts``, ``failed`` of every source (key, text) that isn't done.

    Headers are dropped, texts without content left out, the rest chunked, each chunk given
    to ``fn`` and results joined in order.  A text whose chunks all failed has no row; a
    failed chunk leaves a gap and is counted, not written into the text.
    """
    body = drop_comment_lines(F.col("text"), keep_subheadings=False)
    todo = catalog.outstanding(sources, done, "key").select("key", body.alias("body")).where(size(F.col("body")) > 0)
    chunks = todo.select("key", F.posexplode(chunking.greedy(F.split("body", separator, -1), size, cap, separator)).alias("no", "chunk")).select("key", "no", F.col("chunk.text").alias("chunk"))
    results = transform_chunks(chunks, "chunk", fn)
    parts = F.sort_array(F.collect_list(F.when(F.col("error").isNull(), F.struct("no", "result"))))
    joined = results.groupBy("key").agg(F.array_join(F.transform(parts, lambda p: p["result"]), separator).alias("text"), F.count_if(F.col("error").isNull()).alias("parts"), F.count_if(F.col("error").isNotNull()).alias("failed"))
    return joined.where("parts > 0")


def glossary_run(texts: DataFrame, seed: DataFrame, published: DataFrame) -> DataFrame:
    """Seed terms that texts attest, merged by the number of their texts, and overlaid.

    ``texts``: key, text; ``seed``: pos, english, chinese, sanskrit, category, of any size;
    ``published``: pos, english, sanskrit, definition, source.  Merged entries keep the order
    of the seed, which decides which of several rows with one term is the last.
    """
    pairs = attestation.attested_pairs(texts, "key", "text", seed, "english")
    sources = pairs.groupBy(F.col("term").alias("english")).agg(F.count("key").alias("n_sources"))
    merged = glossary.dedup_across_categories(glossary.dedup_by_source_term(seed.join(sources, "english")))
    return glossary.overlay(positions.with_positions(merged, ["part", "first_pos"]), published)


def cleanup_run(texts: DataFrame) -> DataFrame:
    """``key``, ``text`` after the four rewrites in order, and how often each changed something."""
    step = lambda df, name, made: df.withColumn("__r", made).withColumn("text", F.col("__r.text")).withColumn(name, F.col("__r.n")).drop("__r")
    df = positions.spread(texts.select("key", "text"))
    df = step(df, "n_marks", rewrite.whole_words(F.col("text"), rewrite.MARKS))
    df = step(df, "n_spellings", rewrite.literal(F.col("text"), rewrite.SPELLINGS))
    df = step(df, "n_case", rewrite.outside_headings(F.col("text"), rewrite.RUNNING_TEXT))
    return step(df, "n_dashes", rewrite.dashes(F.col("text")))


def cleanup_summary(cleaned: DataFrame) -> DataFrame:
    """``rule``, ``fixes``, ``texts`` of each kind of rewrite that changed something, most first."""
    kinds = ("n_marks", "n_spellings", "n_case", "n_dashes")
    long = cleaned.select(F.explode(F.array(*(F.struct(F.lit(k[2:]).alias("rule"), F.col(k).alias("n")) for k in kinds))).alias("r")).select("r.*")
    return long.groupBy("rule").agg(F.sum("n").alias("fixes"), F.count_if(F.col("n") > 0).alias("texts")).where("fixes > 0").orderBy(F.desc("fixes"), "rule")
