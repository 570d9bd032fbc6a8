"""Secret scans over a ledger of blobs, in DataFrame functions alone.

Every version of every path is content-addressed (sha256 of its text).  A ledger holds
which (blob, rule set version) pairs were scanned and what was found.  Only pairs that the
ledger lacks are scanned, each blob once however many paths and versions hold it, and
findings are joined back to all of them.

``scan_increment`` keeps the ledger as a Parquet folder and appends to it; a load that dies
leaves the ledger as it was, and scanning again adds what is missing.

Positions come from splitting a text at the matches of a rule: the lengths of the pieces
and of the matches, summed alternately, are the matches' code points.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import read, shared_dir
from textloom.operators.chunking import let


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost, non-overlapping matches; of these, those stay that
    also match ``keep`` as a whole.  ``hint`` is a cheap test without which no match is."""

    kind: str
    pattern: str
    keep: str
    hint: str
    base: bool = False


RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8,}$""", r"[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]", True),
    Rule("access", r"AKIA[A-Z0-9]+", r"^.{16,}$", "AKIA", True),
    Rule("hex", r"[0-9a-f]{32,}", r"^.{32,}$", r"[0-9a-f]{32}", True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", r"^.{40,}$", r"gh[pousr]_"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", r"^.{15,}$", "xox"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", r"^.{30,}$", r"\.eyJ"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"^-", "PRIVATE KEY-----"),
)
RULES_VERSION = 1

SPAN = "struct<start:bigint,rank:int,end:bigint>"


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """``array<struct<start, rank, end>>`` of one rule, code points, end exclusive.

    The group that ``keep`` measures begins after at most one quote, and no quote can be
    part of it; so a kept match is one whose tail of allowed characters is long enough.
    """
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, rule.pattern, -1)
    # state: where the next piece begins, and the spans so far
    none = F.array().cast(f"array<{SPAN}>")
    state = lambda at, spans: F.struct(at.alias("at"), spans.alias("spans"))

    def step(s: Column, x: Column) -> Column:
        begin = s["at"] + F.length(x["piece"])
        end = begin + F.length(x["match"])
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))
        return state(end, F.when(x["match"].rlike(rule.keep), F.concat(s["spans"], F.array(span))).otherwise(s["spans"]))

    def folded(pairs: Column) -> Column:
        """A fold copies its state at each step, so one over runs of some sqrt(n) pairs carries
        all spans, and one within it those of the run."""
        size = F.ceil(F.sqrt(F.size(pairs).cast("double"))).cast("int")  # there is one pair at least
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / size).cast("int")), lambda i: F.slice(pairs, i * size + 1, size))
        run = lambda s, r: let(F.aggregate(r, state(s["at"], none), step), lambda made: state(made["at"], F.concat(s["spans"], made["spans"])))
        return F.aggregate(runs, state(F.lit(0).cast("bigint"), none), run, lambda s: s["spans"])

    pairs = F.zip_with(pieces, found, lambda p, m: F.struct(p.alias("piece"), F.coalesce(m, F.lit("")).alias("match")))
    spans = let(pairs, folded)
    return F.when(text.rlike(rule.hint), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob``, ``spans``: of all rules, by start, then rule as listed."""
    parts = [rule_spans(F.col("text"), r, i) for i, r in enumerate(rules)]
    return blobs.select("blob", F.array_sort(F.concat(*parts)).alias("spans"))


def content_address(versions: DataFrame) -> DataFrame:
    """``path``, ``version``, ``blob``, ``text``; a null text is an empty blob."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return versions.select("path", "version", F.sha2(text, 256).alias("blob"), text.alias("text"))


def unseen(blobs: DataFrame, ledger: DataFrame | None, rules_version: int) -> DataFrame:
    """One row per blob that has no entry under this rule version.

    ``dropDuplicates`` keeps one text per blob before the shuffle, so copies that fill a
    third of the rows leave each task as one row.
    """
    if ledger is not None:
        blobs = blobs.join(ledger.where(F.col("rules_version") == rules_version).select("blob"), "blob", "left_anti")
    return blobs.select("blob", "text").dropDuplicates(["blob"])


def ledger_entries(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, rules_version: int = RULES_VERSION) -> DataFrame:
    """New ledger rows (``blob``, ``rules_version``, ``spans``), to be appended to the ledger."""
    found = scan(unseen(content_address(versions), ledger, rules_version), rules)
    return found.select("blob", F.lit(rules_version).alias("rules_version"), "spans")


LEDGER = f"blob string, rules_version int, spans array<{SPAN}>"


def open_ledger(spark, path: str) -> DataFrame:
    """The ledger in ``path``; one that isn't there yet is empty."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.read.schema(LEDGER).parquet(path)
    return spark.createDataFrame([], LEDGER)


def scan_increment(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, rules_version: int = RULES_VERSION) -> DataFrame:
    """Scan what the ledger in ``path`` lacks of ``versions``, append it, return the ledger.

    Versions seen before, at whatever path, are not scanned again; none at all: the ledger
    stays as it is.
    """
    spark = versions.sparkSession
    ledger_entries(versions, open_ledger(spark, path), rules, rules_version).write.mode("append").parquet(path)
    return open_ledger(spark, path)


def findings(versions: DataFrame, ledger: DataFrame, rules_version: int = RULES_VERSION) -> DataFrame:
    """``path``, ``version``, ``blob``, ``spans`` of every version, clean ones with none.

    Only blobs with findings meet the paths; each has one row, so a blob that a third of
    the paths share multiplies nothing, and the skewed side can be split.
    """
    hits = ledger.where((F.col("rules_version") == rules_version) & (F.size("spans") > 0)).select("blob", "spans")
    all_paths = content_address(versions).drop("text")
    return all_paths.join(hits, "blob", "left").select("path", "version", "blob", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def joined(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_secrets(spark, sf_dir: str) -> DataFrame:
    """Over ``documents``: each is the one version of the path doc_id.

    They come in two loads, which share a ledger: the second scans only blobs that the first
    hasn't brought.  Every document has its row.
    """
    versions = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.lit(1).alias("version"), "text")
    path = f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
    early = F.pmod(F.xxhash64("path"), F.lit(2)) == 0
    for load in (versions.where(early), versions.where(~early)):
        ledger = scan_increment(load, path)
    found = findings(versions, ledger)
    n_base = sum(r.base for r in RULES)
    count = lambda k: F.size(F.filter("spans", lambda s: s["rank"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < n_base)
    return found.select(
        F.col("path").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(base, RULES), 256).alias("base_sha256"), joined(F.col("spans"), RULES).alias("spans"),
    )


def oracle_op2() -> str:
    """Matches by splitting at a rule's matches; letters in either case are spelled out."""
    any_case = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    words = "|".join(map(any_case, ("password", "passwd", "secret", "token"))) + "|" + any_case("api") + "_?" + any_case("key")
    assign = f"(?:{words})[\"'']?\\x20*[:=]\\x20*[\"'']?[A-Za-z0-9+/_.=-]+"
    patterns = [assign, *(r.pattern for r in RULES[1:])]
    keeps = [r"^[A-Za-z_]+[\"'']?\x20*[:=]\x20*[\"'']?[A-Za-z0-9+/_.=-]{8,}$", *(r.keep for r in RULES[1:])]
    parts = " UNION ALL ".join(
        f"SELECT r, {i} AS k, '{rule.kind}' AS kind, regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS s, '{keep}' AS keep FROM d"
        for i, (rule, p, keep) in enumerate(zip(RULES, patterns, keeps, strict=True))
    )
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
x AS ({parts}),
e AS (SELECT r, k, kind, unnest(range(1, len(m) + 1)) AS i, m, s, keep FROM x WHERE len(m) > 0),
sp AS (SELECT r, k, kind, length(array_to_string(s[1:i], '')) + length(array_to_string(m[1:i - 1], '')) AS a, length(m[i]) AS n FROM e
  WHERE regexp_matches(m[i], keep)),
o AS (SELECT r, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2,
  string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, k) FILTER (k < 3) AS base,
  string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, k) AS spans FROM sp GROUP BY r)
SELECT doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access,
  CAST(coalesce(n2, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN o USING (r)"""
