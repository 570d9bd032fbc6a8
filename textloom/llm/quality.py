"""Quality rules of documents, and verdicts on hosts.

Rules are counted per document.  Failures are summed by host (the document's source).
The hosts' failure rates are taken as draws from a beta distribution, whose mean and
strength come from the rates themselves (moments); each host's rate is shrunk towards
that mean by as much as its few documents demand.  A host whose shrunk rate reaches
``host_limit`` is rejected, and its verdict is joined back to its documents.

Sums go up from partial aggregates and there is one row per host, so a host that holds
a third of the documents is no hot spot; verdicts go back by a join that adaptive
execution may split or broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import read, ship, text_bytes, written

MIN_WORDS = 50
#: Percent of words in repeated windows beyond which a document fails.
MAX_REPEATED = 50
#: Shrunk failure rate at which a host is rejected.
HOST_LIMIT = 0.5
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
WHITE = b" \t\n\x0b\x0c\r"

COUNTS = "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def counts(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in them, symbols, repeated lines, words in repeated 3-word windows."""
    words = text.split()  # at exactly the bytes of WHITE
    chars = len(text.translate(None, CONTINUATION + WHITE))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    repeated = 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            repeated += line in seen
            seen.add(line)
    return len(words), chars, symbols, repeated, repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a window of three that occurs twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    n = len(number)
    if n == len(words):
        return 0
    pairs = ids[:-1] * n + ids[1:]
    if n < 2_000_000:  # n ** 3 fits in 63 bits
        keys = pairs[:-1] * n + ids[2:]
    else:
        keys = np.unique(pairs, return_inverse=True)[1][:-1] * n + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k : k + len(keys)] |= twice
    return int(covered.sum())


def document_counts(docs: DataFrame, host: str = "source") -> DataFrame:
    """``COUNTS`` of each row; a null or empty text counts nothing."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([counts(t) for t in text_bytes(batch.column(2))], dtype=np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(found[:, k]) for k in range(5))], names=["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])

    ship(docs.sparkSession)
    return docs.select("doc_id", F.col(host).cast("string").alias("host"), "text").mapInArrow(run, COUNTS)


def host_verdicts(judged: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """``host``, its failures and documents, the prior, the shrunk rate, ``host_kept``.

    Moments: with m and v the mean and variance of the hosts' rates, the prior's strength
    is m (1 - m) / v - 1, held between 1 and 1e6.  One host alone, or rates without
    variance, give the greatest strength: all shrink to the mean.
    """
    hosts = judged.groupBy("host").agg(F.sum(F.col("base_failed").cast("long")).alias("n_failed"), F.count("*").alias("n_docs"))
    rate = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(F.avg(rate).alias("m"), F.coalesce(F.var_pop(rate), F.lit(0.0)).alias("v")).select(
        "m", F.greatest(F.lit(1.0), F.least(F.lit(1e6), F.when(F.col("v") > 1e-12, F.col("m") * (1 - F.col("m")) / F.col("v") - 1).otherwise(1e6))).alias("strength")
    )
    shrunk = (F.col("n_failed") + F.col("strength") * F.col("m")) / (F.col("n_docs") + F.col("strength"))
    # the prior is one row
    return hosts.join(F.broadcast(prior)).select("host", "n_failed", "n_docs", "m", "strength", shrunk.alias("host_rate"), (shrunk < host_limit).alias("host_kept"))


def quality(docs: DataFrame, host: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """``COUNTS`` with ``base_failed``, the host's shrunk rate, and ``kept``.

    Documents without a host count as one host.  No document: no row.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    judged = written(document_counts(docs, host).withColumn("base_failed", failed), "quality")  # read twice below
    verdicts = host_verdicts(judged, host_limit).select(F.col("host").alias("judged_host"), "host_rate", "host_kept")
    return judged.join(verdicts, F.col("host").eqNullSafe(F.col("judged_host"))).select(judged["*"], "host_rate", (~F.col("base_failed") & F.col("host_kept")).alias("kept"))


def op10_quality(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents``; null and empty texts have no words and fail. Null sources are one host."""
    return quality(read(spark, sf_dir, "documents")).drop("host", "host_rate")


def oracle_op10() -> str:
    return r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
ln AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
g AS (SELECT r, p, words[p:p + 2] AS gram FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS p FROM w WHERE len(words) > 2)),
rep AS (SELECT r, count(DISTINCT k) AS n_repeat_words FROM (
  SELECT r, unnest([p, p + 1, p + 2]) AS k FROM (SELECT r, p, count(*) OVER (PARTITION BY r, gram) AS c FROM g) WHERE c > 1) GROUP BY r),
j AS (SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN ln USING (r) LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM j),
h AS (SELECT source, sum(base_failed::INT) AS bad, count(*) AS n FROM f GROUP BY source),
pr AS (SELECT avg(bad / n) AS m, var_pop(bad / n) AS v FROM h),
k AS (SELECT source, (bad + s * m) / (n + s) < 0.5 AS host_kept FROM h,
  (SELECT m, greatest(1.0, least(1e6, CASE WHEN v > 1e-12 THEN m * (1 - m) / v - 1 ELSE 1e6 END)) AS s FROM pr))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_kept AS kept
FROM f JOIN k ON f.source IS NOT DISTINCT FROM k.source"""
