"""Column builders over text: no UDF, all inside whole-stage code generation where Spark can."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Character classes by which sizes are counted; fixed values.
IDEOGRAPHS = r"\x{4E00}-\x{9FFF}"
IDEOGRAPHS_AND_A = r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}"
IDEOGRAPHS_WIDE = r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
#: Characters that cleaning preserves; fixed values.
PRESERVED = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}\x{2B740}-\x{2B81F}"
    r"\x{3000}-\x{303F}\x{FF01}-\x{FF5E}\x{FE30}-\x{FE4F}\x{2018}-\x{201F}\x{2E80}-\x{2EFF}"
)
#: Letters with marks of transliterated words; fixed values.
DIACRITICS = "āīūṛṝḷḹṃḥṅñṭḍṇśṣĀĪŪṚṜḶḸṂḤṄÑṬḌṆŚṢ"


def count_class(text: Column, chars: str) -> Column:
    """Characters of a class."""
    return F.regexp_count(text, F.lit(f"[{chars}]")).cast("long")


def without_space(text: Column) -> Column:
    """All white space of Unicode removed, the ideographic space too."""
    return F.regexp_replace(text, r"(?U)\s+", "")


def strip(text: Column) -> Column:
    """Both ends without white space of Unicode."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def preserve(text: Column, chars: str = PRESERVED, annotations: bool = False) -> Column:
    """Runs of preserved characters; ``annotations`` also keeps ``{...}``."""
    pattern = rf"[{chars}]+"
    if annotations:
        pattern = r"\{[^}]+\}|" + pattern
    return F.array_join(F.regexp_extract_all(without_space(text), F.lit(pattern), F.lit(0)), "")


def has_diacritics(text: Column) -> Column:
    return text.rlike(f"[{DIACRITICS}]")


def term_key(text: Column) -> Column:
    """Lower case without any s at the end."""
    return F.regexp_replace(F.lower(text), "s+$", "")


def text_number(name: Column) -> Column:
    """``T`` and at least four digits, with a suffix a or b; what doesn't match stays."""
    digits = F.regexp_extract(name, r"(\d+)[abAB]?$", 1)
    suffix = F.regexp_extract(name, r"\d+([abAB]?)$", 1)
    plain = F.regexp_replace(digits, "^0+(?=.)", "")
    number = F.when(F.length(plain) < 4, F.lpad(plain, 4, "0")).otherwise(plain)
    return F.when(digits == "", name).otherwise(F.concat(F.lit("T"), number, suffix))


def paragraphs(text: Column) -> Column:
    return F.split(text, "\n\n", -1)


def sentences(text: Column, ends: str = "。！？") -> Column:
    """Split after sentence ends; an empty rest stays."""
    return F.split(text, f"(?<=[{ends}])", -1)


def drop_comment_lines(text: Column, keep_subheadings: bool) -> Column:
    """Without lines that begin with #; those with ## can stay."""
    lines = F.split(text, "\n", -1)
    plain = F.filter(lines, lambda x: ~x.startswith("#") | x.startswith("##")) if keep_subheadings else F.filter(lines, lambda x: ~x.startswith("#"))
    return F.array_join(plain, "\n")


def leading_header(text: Column) -> Column:
    """The # lines at the top, blank lines skipped, up to the first other line."""
    block = F.regexp_extract(text, r"^((?:#[^\n]*(?:\n|$)|[^\S\n]*(?:\n|$))*)", 1)
    return F.array_join(F.filter(F.split(block, "\n", -1), lambda x: x.startswith("#")), "\n")


def is_noise_line(text: Column, floor: str = "2000") -> Column:
    """A catalogue number or only characters below a code point; an empty line is none."""
    return (text != "") & (text.rlike(r"^No\.\s*\d+") | ~text.rlike(rf"[\x{{{floor}}}-\x{{10FFFF}}]"))


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]+>", "")


def code_point(name: Column) -> Column:
    """The code point that ``U+XXXX`` names, or null."""
    hexadecimal = F.regexp_extract(name, "^U\\+([0-9A-Fa-f]{1,6})$", 1)
    return F.when(hexadecimal == "", None).otherwise(F.conv(hexadecimal, 16, 10).cast("long"))


def composite_key(custom_id: Column, separator: str = "_fasc_") -> Column:
    """``struct<t_number, fasc_num>`` of ids such as T0001_fasc_02."""
    return F.struct(F.split_part(custom_id, F.lit(separator), F.lit(1)).alias("t_number"), F.split_part(custom_id, F.lit(separator), F.lit(2)).cast("int").alias("fasc_num"))


def markdown_sections(text: Column, titles: list[str]) -> Column:
    """``map<title, body>`` of the named sections of level 2, without their heading lines."""
    parts = F.filter(F.split(text, r"(?m)^## ", -1), lambda p: F.split_part(p, F.lit("\n"), F.lit(1)).isin(*titles))
    return F.map_from_entries(F.transform(parts, lambda p: F.struct(F.split_part(p, F.lit("\n"), F.lit(1)), F.regexp_replace(p, r"^[^\n]*\n?", ""))))


def first_match(text: Column, pattern: str, default: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")), default)


def without_blank_pairs(text: Column) -> Column:
    """Each pair of blank lines that follow each other removed."""
    return F.regexp_replace(text, r"(?m)^[^\S\n]*\n[^\S\n]*\n", "")


def prompt(template: str, *values: Column) -> Column:
    """A template with %s for each value."""
    return F.format_string(template, *values)


def batch_request(custom_id: Column, system: str, text: Column, limit: int) -> Column:
    """A request of a batch interface as JSON."""
    message = F.struct(F.lit("user").alias("role"), text.alias("content"))
    return F.to_json(F.struct(custom_id.alias("custom_id"), F.struct(F.lit(limit).alias("max_tokens"), F.lit(system).alias("system"), F.array(message).alias("messages")).alias("params")))


def minutes_and_seconds(text: Column) -> Column:
    """``struct<seconds, shared>`` of m:ss, which a star marks as the time of several texts."""
    part = lambda k: F.regexp_extract(text, r"^\s*(\d+):(\d\d)\**\s*$", k)
    return F.struct((F.nullif(part(1), F.lit("")).cast("long") * 60 + F.nullif(part(2), F.lit("")).cast("long")).alias("seconds"), text.endswith("*").alias("shared"))
