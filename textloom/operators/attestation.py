"""Which texts hold which terms, for term lists of any size.

Each term is keyed by one gram: the q characters of it that the fewest texts hold.  Texts
are taken apart into their distinct grams, and those that key a term propose it; what is
proposed is then looked for in the text itself.  So the plan is the same for one term or a
million, no term meets every text, and the result is that of a search for each term in each
text, whichever gram keys it.

A term without white space lies within a word, between white space, so such terms are
looked for once in each distinct word of all texts, and a text holds those of its words.
Terms with white space are looked for in the texts; only those that have no word of q
characters are keyed by grams with white space.  Terms of up to ``SHORT`` characters count
as whole words only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.positions import kept, spread

#: Terms of up to this length match whole words only; a fixed value.
SHORT = 3
Q = 4
#: One in so many texts is counted to see which grams are rare.
SAMPLED = 16
#: Grams of terms that are broadcast at most, some 10 MB.
MOST_BROADCAST = 200_000
#: Before a short term that a text may hold elsewhere than as a word.
ANYWHERE = "\x01"
_WORD = r"[\p{L}\p{N}_]"


def grams(text: Column, q: int, of: str = ".") -> Column:
    """All runs of q characters (of a class), overlapping, in order; one pass over the text."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?=({of}{{{q}}}))"), F.lit(1))


def word_grams(text: Column, q: int) -> Column:
    """Grams without white space, of each distinct word."""
    return grams(F.array_join(F.array_distinct(F.split(text, r"\s+")), " "), q, r"\S")


def short_words(text: Column) -> Column:
    """Words of up to ``SHORT`` characters."""
    return F.regexp_extract_all(text, F.lit(rf"(?<!{_WORD}){_WORD}{{1,{SHORT}}}(?!{_WORD})"), F.lit(0))


def _proposals(term: Column, q: int) -> Column:
    """Grams that a text with the term must hold.

    A short word keys itself, and whoever has it as a word holds it; another short term is
    marked, as characters of it may stand anywhere.
    """
    inner = F.array_distinct(grams(term, q, r"\S"))
    short = F.length(term) <= SHORT
    return F.when(short & _whole_word(term), F.array(term)).when(short, F.array(F.concat(F.lit(ANYWHERE), term))).when(F.size(inner) > 0, inner).otherwise(F.array_distinct(grams(term, q)))


def _whole_word(term: Column) -> Column:
    return term.rlike(rf"^{_WORD}+\z")


def _own_grams(text: Column, odd: list[int], spaced: bool, q: int) -> Column:
    """Distinct grams of a text; ``odd``: lengths of short terms that aren't all word
    characters, ``spaced``: whether grams with white space are asked for."""
    marked = lambda n: F.transform(F.array_distinct(grams(text, n)), lambda g: F.concat(F.lit(ANYWHERE), g))
    parts = [short_words(text), word_grams(text, q), *map(marked, odd)] + [grams(text, q)] * spaced
    return F.array_distinct(F.concat(*parts))


def holds(text: Column, term: Column) -> Column:
    """Whether a text that was proposed has the term: short ones as whole words, others anywhere."""
    quoted = F.concat(F.lit(rf"(?<!{_WORD})\Q"), F.replace(term, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(rf"\E(?!{_WORD})"))
    return F.when(F.length(term) > SHORT, F.contains(text, term)).when(_whole_word(term), F.lit(True)).otherwise(F.regexp_like(text, quoted))


def _searched(own: DataFrame, terms: DataFrame, q: int, most_broadcast: int) -> DataFrame:
    """``term``, ``key``: the texts (``key``, ``text``) that hold the terms, by grams, once."""
    keyed = kept(terms.select("term", F.explode(_proposals(F.col("term"), q)).alias("gram")), "grams")
    short = F.length("term") <= SHORT
    odd = F.collect_set(F.when(short & ~_whole_word(F.col("term")), F.length("term")))  # SHORT of them at most
    known = keyed.agg(odd.alias("odd"), F.count_if(~short & F.col("gram").rlike(r"\s")).alias("spaced"), F.count("*").alias("n")).first()
    small = known["n"] <= most_broadcast
    sent = F.broadcast if small else (lambda df: df)
    exploded = F.explode(_own_grams(F.col("text"), sorted(known["odd"]), known["spaced"] > 0, q)).alias("gram")
    sample = own.where(F.pmod(F.xxhash64("key"), F.lit(SAMPLED)) == 0)
    held = sample.select(exploded).join(sent(keyed.select("gram").distinct()), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    best = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("best")
    rarest = kept(keyed.join(held, "gram", "left").groupBy("term").agg(best).select("term", F.col("best.gram").alias("gram")), "rarest")
    if small:
        proposed = own.select("key", "text", exploded).join(F.broadcast(rarest), "gram")
    else:
        of_key = own.select("key", exploded).join(rarest, "gram").groupBy("key").agg(F.collect_set("term").alias("terms"))
        proposed = own.join(of_key, "key").select("key", "text", F.explode("terms").alias("term"))
    return proposed.where(holds(F.col("text"), F.col("term"))).select("term", "key").distinct()


def attested_pairs(texts: DataFrame, key: str, text: str, terms: DataFrame, term: str, q: int = Q, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """``term``, ``key``: every pair in which a text of that key holds the term, once.

    Empty and null terms are in no text.  How many texts hold a gram is counted on one in
    ``SAMPLED`` texts; it decides what a search costs, not what it finds.  Up to
    ``most_broadcast`` rows, the terms' grams and the words that hold terms go to every task,
    and texts stay where they are; beyond that, they are shuffled.
    """
    wanted = kept(terms.select(F.col(term).alias("term")).where("term <> ''").distinct(), "terms")
    spaced = F.col("term").rlike(r"\s")
    own = texts.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text <> ''")
    words = F.explode(F.array_distinct(F.split("text", r"\s+"))).alias("word")
    vocabulary = kept(spread(own.select("text")).select(words).where("word <> ''").distinct(), "words")
    vocabulary = spread(vocabulary.select(F.col("word").alias("key"), F.col("word").alias("text")))
    found = _searched(vocabulary, wanted.where(~spaced), q, most_broadcast)
    holding = kept(found.groupBy(F.col("key").alias("word")).agg(F.collect_list("term").alias("terms")), "holding")
    sent = F.broadcast(holding) if holding.count() <= most_broadcast else holding
    # dealt by their keys, so that pairs are made single where they are
    of_words = spread(own, "key").select("key", words).join(sent, "word").select(F.explode("terms").alias("term"), "key").distinct()
    if wanted.where(spaced).isEmpty():
        return of_words
    return of_words.unionByName(_searched(own, wanted.where(spaced), q, most_broadcast))


def attestation(texts: DataFrame, key: str, text: str, terms: DataFrame | list[str]) -> DataFrame:
    """``term``, ``n_texts``, ``first_key`` of every term that a text has; ``terms`` has a column of that name."""
    if isinstance(terms, list):
        terms = texts.sparkSession.createDataFrame([(t,) for t in terms], "term string")
    return attested_pairs(texts, key, text, terms, "term").groupBy("term").agg(F.count("*").alias("n_texts"), F.min("key").alias("first_key"))
