"""Benchmark passages in documents, by one Aho-Corasick automaton.

Texts are normalised to words (see ``WORD_BYTES``) with one space around each.  Every
window of ``window`` consecutive words of a benchmark item (a shorter item as a whole) is
a pattern; the automaton reads a normalised document once and reports every occurrence.
Word numbers are mapped back to code points of the original text.

The automaton goes to every worker, so its size is checked: the patterns are counted
first and cut into blocks of at most ``block_windows``; each block makes an automaton of
its own, and the documents are read once per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import read, safe_names, ship, text_bytes, written

WINDOW = 10
#: Windows in one automaton: some 100 MB at 60 characters each.
BLOCK_WINDOWS = 100_000
#: What is part of a word: digits, letters, and all bytes beyond ASCII.  A-Z become a-z.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))



def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def windows_of(words: list[bytes], window: int) -> set[bytes]:
    """Patterns of one item: words joined and enclosed by spaces."""
    last = max(1, len(words) - window + 1) if words else 0
    return {b" " + b" ".join(words[i : i + window]) + b" " for i in range(last)}


class Matcher:
    def __init__(self, patterns: Iterable[tuple[bytes, list]]):
        self.automaton = ahocorasick.Automaton()
        for pattern, items in patterns:
            # one character per byte, as the automaton takes strings
            self.automaton.add_word(pattern.decode("latin-1"), (len(pattern), pattern.count(b" ") - 1, items))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple[int, np.ndarray, list]:
        """Words of the text, which of them are hit, and the items that occur."""
        words = words_of(text)
        if self.empty or not words:
            return len(words), np.zeros(0, dtype=np.int64), []
        line = f" {b' '.join(words).decode('latin-1')} "
        found = list(self.automaton.iter(line))
        if not found:
            return len(words), np.zeros(0, dtype=np.int64), []
        spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), dtype=np.uint8) == 32)
        begins = np.searchsorted(spaces, [end - size + 1 for end, (size, _, _) in found])
        delta = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(delta, begins, 1)
        np.add.at(delta, begins + [n for _, (_, n, _) in found], -1)
        return len(words), np.flatnonzero(np.cumsum(delta[:-1]) > 0), sorted({i for _, (_, _, items) in found for i in items}, key=lambda i: (i is None, str(i)))


def original_spans(text: bytes, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as code points of the original text, end exclusive."""
    raw = np.frombuffer(text, dtype=np.uint8)
    inside = np.frombuffer(text.translate(WORD_BYTES), dtype=np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    runs = [[k for _, k in run] for _, run in groupby(enumerate(hit.tolist()), lambda x: x[1] - x[0])]
    return [{"start": int(points[starts[run[0]]]), "end": int(points[ends[run[-1]]])} for run in runs]


def scan_documents(docs: DataFrame, patterns: list[tuple[bytes, list]]) -> DataFrame:
    """Per row: words, hit words, items and spans for one block of patterns."""
    held = docs.sparkSession.sparkContext.broadcast(patterns)
    names = ["doc_id", "n_words", "hit", "item_ids", "spans"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(held.value)
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for text in text_bytes(batch.column(1)):
                n, hit, items = matcher.scan(text)
                for row, value in zip(rows, (n, hit.tolist(), items, original_spans(text, hit) if len(hit) else []), strict=True):
                    row.append(value)
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(r, k) for r, k in zip(rows, kinds, strict=True)), *batch.columns[2:]], names=[*names, *batch.schema.names[2:]])

    extra = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[2:])
    return docs.mapInArrow(run, "doc_id long, n_words long, hit array<long>, item_ids array<long>, spans array<struct<start:long,end:long>>" + extra)


def benchmark_patterns(benchmark: DataFrame, window: int) -> DataFrame:
    """``pattern`` and the sorted ids of the items that have it; a null text has none."""
    rows = safe_names(benchmark, "item_id", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(p, i) for i, t in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True) for p in sorted(windows_of(words_of(t), window))]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in made], pa.binary()), pa.array([i for _, i in made], pa.int64())], names=["pattern", "item_id"])

    return rows.mapInArrow(run, "pattern binary, item_id long").groupBy("pattern").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


def spans_of(rows: DataFrame) -> DataFrame:
    """``rows`` (text, hit, ...) with ``spans`` instead of ``text``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            made = [original_spans(t, np.array(h, dtype=np.int64)) if h else [] for t, h in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(made, kind), *batch.columns[1:]], names=["spans", *batch.schema.names[1:]])

    rest = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, "spans array<struct<start:long,end:long>>, " + rest)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS, with_row: bool = False) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with ``n_words``, ``hit`` (word numbers),
    ``item_ids`` and ``spans`` (code points of the original text, one for each run of hit
    words); with ``row``, the whole row of ``docs``, if asked for.

    A null or empty text has no words and no hit.  Repeated rows are scanned each.  An
    empty benchmark hits nothing; an item without words or id is no item.
    """
    spark = docs.sparkSession
    ship(spark)
    patterns = benchmark_patterns(benchmark.where(F.col("item_id").isNotNull()), window)
    n_blocks = max(1, -(-patterns.count() // block_windows))
    rows = docs.select("doc_id", "text", *[F.struct("*").alias("row")] * with_row)
    if n_blocks == 1:
        return scan_documents(rows, [(bytes(r["pattern"]), r["items"]) for r in patterns.collect()])
    # each block reads all rows; a row number from a written table ties its parts together
    numbered = written(rows.withColumn("row_id", F.monotonically_increasing_id()), "decontaminate")
    blocked = written(patterns.withColumn("block", F.pmod(F.xxhash64("pattern"), F.lit(n_blocks))), "patterns")
    parts = None
    for block in range(n_blocks):
        own = [(bytes(r["pattern"]), r["items"]) for r in blocked.where(F.col("block") == block).collect()]
        part = scan_documents(numbered.select("doc_id", "text", "row_id"), own)
        parts = part if parts is None else parts.unionByName(part)
    merged = lambda name: F.array_sort(F.array_distinct(F.flatten(F.collect_list(name)))).alias(name)
    found = parts.groupBy("row_id").agg(F.first("n_words").alias("n_words"), merged("hit"), merged("item_ids"))
    # windows of different blocks overlap, so spans follow from all hits together
    columns = ["doc_id", "n_words", "hit", "item_ids", "spans"] + ["row"] * with_row
    return spans_of(numbered.join(found, "row_id").select("text", "hit", *(c for c in columns if c not in ("hit", "spans")))).select(*columns)


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` against ``benchmark``; windows of 10 words.

    Null and empty texts have no words; repeated documents and items count each for themselves.
    """
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    items = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words",
        F.size("hit").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"),
    )


def uncontaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows without a benchmark passage, as they came.

    Each row is judged by its own text; null and empty texts stay.  Columns of whatever
    names pass through.  No rows: no rows.
    """
    return contamination(docs, read(spark, sf_dir, "benchmark"), with_row=True).where(F.size("hit") == 0).select("row.*")


def oracle_op3() -> str:
    return r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM b WHERE len(w) > 0)),
g AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
occ AS (SELECT g.doc_id, g.p, g.n, win.item_id FROM g JOIN win ON g.gram = win.gram AND g.n = win.n),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS k FROM (SELECT DISTINCT doc_id, p, n FROM occ)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""
