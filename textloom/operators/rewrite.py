"""Ordered rewrites that count what they change."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.operators.chunking import let

#: Transliterations with their marks restored, in order; fixed values.
MARKS = (
    ("Sakyamuni", "Śākyamuni"), ("Shakyamuni", "Śākyamuni"), ("Surangama", "Śūraṅgama"), ("sramanera", "śrāmaṇera"), ("Sramanera", "Śrāmaṇera"),
    ("sramana", "śrāmaṇa"), ("nirvana", "nirvāṇa"), ("Nirvana", "Nirvāṇa"), ("NIRVANA", "NIRVĀṆA"), ("samadhi", "samādhi"), ("Samadhi", "Samādhi"),
    ("dharani", "dhāraṇī"), ("Dharani", "Dhāraṇī"), ("prajna", "prajñā"), ("Prajna", "Prajñā"), ("bhiksu", "bhikṣu"), ("Bhiksu", "Bhikṣu"),
    ("bhiksuni", "bhikṣuṇī"), ("Bhiksuni", "Bhikṣuṇī"), ("kashaya", "kāṣāya"), ("Kashaya", "Kāṣāya"), ("sutras", "sūtras"), ("Sutras", "Sūtras"),
    ("sutra", "sūtra"), ("Sutra", "Sūtra"), ("SUTRA", "SŪTRA"), ("Dogen", "Dōgen"), ("Obaku", "Ōbaku"), ("kasaya", "kāṣāya"),
)
#: Spellings, in order; an earlier one can make a later one unreachable; fixed values.
SPELLINGS = (
    ("Saṅgha", "Sangha"), ("saṅgha", "sangha"), ("Pure Regulations", "Pure Rules"), ("buddha-nature", "Buddha-nature"), ("Three Jewels", "Three Treasures"),
    ("three jewels", "Three Treasures"), ("Blessed One", "World-Honored One"), ("Blessed Ones", "World-Honored Ones"), ("expedient means", "skillful means"),
    ("Expedient Means", "Skillful Means"), ("Expedient means", "Skillful means"), ("wholesome roots", "roots of merit"), ("Wholesome roots", "Roots of merit"),
    ("five skandhas", "five aggregates"), ("Thus-Come One", "Tathāgata"), ("Thus Come One", "Tathāgata"),
)
#: Case in running text; fixed values.
RUNNING_TEXT = (("Dharma Hall", "Dharma hall"), ("Sangha Hall", "Sangha hall"), ("Buddha Hall", "Buddha hall"), ("Bath Hall", "bath hall"))
#: Lines at the top that the dash rewrite leaves alone.
HEADER_LINES = 8


def _table(rules: tuple[tuple[str, str], ...]) -> Column:
    return F.array(*(F.struct(F.lit(a).alias("find"), F.lit(b).alias("put")) for a, b in rules))


def _start(text: Column) -> Column:
    return F.struct(text.alias("text"), F.lit(0).cast("long").alias("n"))


def _if_held(s: Column, find: Column, rewritten) -> Column:
    """The state after a rule; a text that doesn't hold what the rule finds is only looked through once."""
    return F.when(~F.contains(s["text"], find), s).otherwise(rewritten)


def whole_words(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """``struct<text, n>``: each rule (literal text, what is put for it) on the result of those before, whole words only.

    A fold over the table of rules, so a count never nests the rewrites before it.  A pattern
    begins with the text that is looked for, which lets a search skip most characters.
    """
    word = r"[\p{L}\p{N}_]"
    table = F.array(*(F.struct(F.lit(a).alias("find"), F.lit(b).alias("put"), F.lit(rf"\Q{a}\E(?<!{word}\Q{a}\E)(?!{word})").alias("pattern")) for a, b in rules))

    def step(s: Column, r: Column) -> Column:
        made = lambda parts: F.struct(F.call_function("array_join", parts, r["put"]).alias("text"), (s["n"] + F.size(parts) - 1).alias("n"))
        return _if_held(s, r["find"], let(F.split(s["text"], r["pattern"], -1), made))

    return F.when(text.isNotNull(), F.aggregate(table, _start(text), step))


def literal(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """``struct<text, n>``: each rule on the result of those before, anywhere."""

    def step(s: Column, r: Column) -> Column:
        without = F.length(F.call_function("replace", s["text"], r["find"], F.lit("")))
        n = F.floor((F.length(s["text"]) - without) / F.length(r["find"])).cast("long")
        return _if_held(s, r["find"], F.struct(F.call_function("replace", s["text"], r["find"], r["put"]).alias("text"), (s["n"] + n).alias("n")))

    return F.when(text.isNotNull(), F.aggregate(_table(rules), _start(text), step))


def _by_line(text: Column, rewrite) -> Column:
    """``struct<text, n>`` from one such struct per line."""
    whole = lambda parts: F.struct(
        F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"),
        F.aggregate(parts, F.lit(0).cast("long"), lambda s, p: s + p["n"]).alias("n"),
    )
    return let(F.transform(F.split(text, "\n", -1), rewrite), whole)


def outside_headings(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """As ``literal``, on lines that don't begin with #."""
    return _by_line(text, lambda line, _: F.when(line.startswith("#"), _start(line)).otherwise(literal(line, rules)))


def dashes(text: Column, dash: str = "—", header_lines: int = HEADER_LINES) -> Column:
    """Dashes as other punctuation.

    Headings get colons and count every dash; other lines below the header count once if
    they change; header lines stay.
    """

    def body(line: Column) -> Column:
        x = F.regexp_replace(line, rf"([\p{{L}}\p{{N}}_]){dash}([^{dash}]+){dash}([\p{{L}}\p{{N}}_])", "$1, $2, $3")
        x = F.regexp_replace(x, rf"([\p{{L}}\p{{N}}_]){dash}([\p{{L}}\p{{N}}_])", "$1; $2")
        x = F.regexp_replace(x, rf"(?U){dash}\s*$", "...")
        x = F.regexp_replace(x, rf"(?U)\s{dash}\s", "; ")
        return F.replace(x, F.lit(dash), F.lit("; "))

    def one(line: Column, i: Column) -> Column:
        heading = F.struct(F.replace(line, F.lit(dash), F.lit(":")).alias("text"), (F.length(line) - F.length(F.replace(line, F.lit(dash), F.lit("")))).cast("long").alias("n"))
        changed = F.struct(body(line).alias("text"), F.lit(1).cast("long").alias("n"))
        return F.when(~line.contains(dash), _start(line)).when(line.startswith("#"), heading).when(i < header_lines, _start(line)).otherwise(changed)

    return _by_line(text, one)
