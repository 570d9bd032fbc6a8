"""Divergence of sources by their terms, over integer dictionaries.

Terms are counted per (lang, source) within each task, then summed.  Sorted by (lang, term),
the sums are cut into chunks; a chunk keeps the terms that enough documents of the language
hold as one sorted array.  ``searchsorted`` in that array turns terms into ids, in the order
of their UTF-8 bytes, and a ``bincount`` per source makes dense vectors of counts, so
distances are sums over vectors, and ties of a chunk resolve by id.

All arithmetic is exact: rates are long divisions of integers in three steps of a thousand.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import read, ship, text_bytes, written

LEAST_DOCUMENTS = 30
PSEUDO = 5
SCALE_STEPS = 3  # of a thousand each
RANKS = 50
#: Distinct entries that a task counts before it passes them on, rows of a chunk, cells of a dense tile.
COUNTED_TOGETHER, CHUNK_ROWS, TILE_CELLS = 400_000, 500_000, 2_000_000
#: Sums and terms that a task gathers over chunks before it passes them on.
HELD_CELLS = 4_000_000
#: Bytes of a text that are taken apart at once.
SLICE = 1 << 22

#: A-Z to lower case; what is neither a letter nor beyond ASCII to a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_COUNTED = "lang string, source string, term string, docs long, times long"
_CHUNK = "chunk long, lang string, terms array<string>, sources array<string>, totals array<long>, ids array<binary>, counts array<binary>"
_FOUND = "lang string, source string, part string, item string, value long"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text in slices, none of which cuts a term."""
    folded, at = text.translate(FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + SLICE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def batch_of(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()).cast(pa.string()) if k == "string" and c and isinstance(c[-1], bytes) else pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def counted_terms(docs: DataFrame) -> DataFrame:
    """``_COUNTED`` sums: documents with the term and its occurrences, per lang and source.

    Each group has a row of null term, so that groups without terms are there.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (docs, times) in groups.items():
                yield batch_of([[lang], [source], [None], [0], [0]], _COUNTED)
                if times:
                    yield batch_of([[lang] * len(times), [source] * len(times), list(times), [docs[t] for t in times], list(times.values())], _COUNTED)
            groups.clear()

        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), text_bytes(batch.column(2)), strict=True):
                docs, times = groups.setdefault((lang, source), (Counter(), Counter()))
                seen: set[bytes] = set()
                for terms in terms_of(text):
                    times.update(terms)
                    seen.update(terms)
                docs.update(seen)
            if sum(len(times) for _, times in groups.values()) > COUNTED_TOGETHER:
                yield from flush()
        yield from flush()

    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    parts = docs.select(blank("lang"), blank("source"), "text").mapInArrow(run, _COUNTED)
    return parts.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("times").alias("times"))


def dictionary_chunks(counted: DataFrame, least: int, chunk_rows: int) -> DataFrame:
    """``_CHUNK``: kept terms of a lang, and each source's ids and counts (0 left out).

    All rows of a term stand together; a chunk ends between terms.  The rows of null terms
    make a chunk without terms, which names all sources of its lang.
    """

    def encoded(chunk: int, lang: str, table: pa.Table) -> tuple | None:
        term = table.column("term")
        if term.null_count:
            sources = sorted(set(table.column("source").to_pylist()))
            return (chunk, lang, [], sources, [0] * len(sources), [b""] * len(sources), [b""] * len(sources))
        runs = term.combine_chunks().dictionary_encode()  # sorted, so in order of first occurrence
        runs = runs.combine_chunks() if isinstance(runs, pa.ChunkedArray) else runs
        code = runs.indices.to_numpy().astype(np.int64)
        docs, times = (table.column(c).to_numpy() for c in ("docs", "times"))
        held = np.zeros(len(runs.dictionary), dtype=np.int64)
        np.add.at(held, code, docs)
        kept = np.flatnonzero(held >= least)
        if not len(kept):
            return None
        stays = held[code] >= least
        ids = np.searchsorted(kept, code[stays]).astype("<i4")
        names = table.column("source").combine_chunks().dictionary_encode()
        names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
        source, times = names.indices.to_numpy()[stays], times[stays]
        order = np.lexsort((ids, source))
        ids, source, times = ids[order], source[order], times[order].astype("<i8")
        at = np.flatnonzero(np.diff(source, prepend=-1, append=len(names.dictionary)))
        present = source[at[:-1]]
        cut = [(a, b) for a, b in zip(at[:-1], at[1:], strict=True)]
        known = names.dictionary.to_pylist()
        return (chunk, lang, runs.dictionary.take(pa.array(kept)).to_pylist(), [known[i] for i in present], [int(times[a:b].sum()) for a, b in cut], [ids[a:b].tobytes() for a, b in cut], [times[a:b].tobytes() for a, b in cut])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, rows = TaskContext.get().partitionId() << 32, [], 0

        def cut(table: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal chunk
            made = encoded(chunk, table.column("lang")[0].as_py(), table)
            if made:
                chunk += 1
                yield batch_of([[x] for x in made], _CHUNK)

        for batch in batches:
            at = 0
            langs, terms = batch.column(0), batch.column(1)
            same = np.array(pa.compute.and_(pa.compute.equal(langs[1:], langs[:-1]), pa.compute.fill_null(pa.compute.equal(terms[1:], terms[:-1]), False)).to_numpy(zero_copy_only=False), dtype=bool)
            nulls = terms.is_null().to_numpy(zero_copy_only=False)
            other = langs.to_numpy(zero_copy_only=False)
            for i in range(batch.num_rows):
                if i:
                    new_lang, new_term = other[i] != other[i - 1] or nulls[i] != nulls[i - 1], not (same[i - 1] or nulls[i] and nulls[i - 1])
                elif held:
                    last = held[-1].slice(held[-1].num_rows - 1)
                    new_lang = last.column(0)[0].as_py() != other[0] or last.column(1).null_count != int(nulls[0])
                    new_term = new_lang or last.column(1)[0].as_py() != terms[0].as_py()
                else:
                    continue
                if new_lang or new_term and rows + i - at >= chunk_rows:
                    if i > at:
                        held.append(batch.slice(at, i - at))
                    yield from cut(pa.Table.from_batches(held))
                    held, rows, at = [], 0, i
            held.append(batch.slice(at))
            rows += batch.num_rows - at
        if rows:
            yield from cut(pa.Table.from_batches(held))

    rows = counted.select("lang", "term", "source", "docs", "times").repartition("lang", "term").sortWithinPartitions("lang", "term")
    return rows.mapInArrow(run, _CHUNK)


def rates(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 5) / (total + 5 * terms)), whole numbers throughout."""
    whole = total + PSEUDO * terms
    q, r = np.divmod(counts + PSEUDO, whole)
    for _ in range(SCALE_STEPS):
        step, r = np.divmod(r * 1000, whole)
        q = q * 1000 + step
    return q + 1


Sparse = dict[int, tuple[np.ndarray, np.ndarray]]


def first_terms(chunk: dict, sparse: Sparse, totals: np.ndarray, n_terms: int, ranks: int) -> Iterator[tuple[int, list[tuple[int, str]]]]:
    """Of each source, the chunk's terms that it has more of than its lang: (difference, term), the first ``ranks``."""
    width = len(chunk["terms"])
    all_counts = np.zeros(width, dtype=np.int64)
    for ids, counts in sparse.values():
        all_counts += dense(ids, counts, 0, width)
    q = rates(all_counts, int(totals.sum()), n_terms)
    for i, (ids, counts) in sparse.items():
        f = rates(counts, int(totals[i]), n_terms) - q[ids]
        more = np.flatnonzero(f > 0)
        yield i, [(int(f[x]), chunk["terms"][ids[x]]) for x in more[np.lexsort((ids[more], -f[more]))[:ranks]]]


def pair_sums(width: int, sparse: Sparse, totals: np.ndarray, n_terms: int, tile_cells: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Sums of differences over the chunk's terms, for bands of sources: (first row, first column, sums)."""
    n = len(totals)
    band = max(1, min(n, int(tile_cells**0.5)))
    columns = max(1, tile_cells // band)
    none = np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)

    def tile(lo: int, start: int) -> np.ndarray:
        end = min(start + columns, width)
        return np.stack([rates(dense(*sparse.get(i, none), start, end), int(totals[i]), n_terms) for i in range(lo, min(lo + band, n))])

    for lo in range(0, n, band):
        for hi in range(lo, n, band):
            sums = np.zeros((min(band, n - lo), min(band, n - hi)), dtype=np.int64)
            for start in range(0, width, columns):
                left = tile(lo, start)
                right = left if hi == lo else tile(hi, start)
                for k, p in enumerate(left):
                    sums[k] += np.abs(right - p).sum(axis=1)
            yield lo, hi, sums


class Found:
    """What a task has found of one lang: sums of pairs by band and the first terms of each source."""

    def __init__(self, lang: str, names: list[str], ranks: int):
        self.lang, self.names, self.ranks = lang, names, ranks
        self.sums: dict[tuple[int, int], np.ndarray] = {}
        self.terms: dict[int, list[tuple[int, str]]] = {}

    def add(self, chunk: dict, tile_cells: int) -> None:
        place = {s: i for i, s in enumerate(self.names)}
        totals = np.array(chunk["all_totals"], dtype=np.int64)
        sparse = {place[s]: (np.frombuffer(i, dtype="<i4"), np.frombuffer(c, dtype="<i8")) for s, i, c in zip(chunk["sources"], chunk["ids"], chunk["counts"], strict=True)}
        for i, terms in first_terms(chunk, sparse, totals, chunk["n_terms"], self.ranks) if chunk["terms"] else ():
            both = self.terms.get(i, []) + terms
            self.terms[i] = sorted(both, key=lambda x: (-x[0], x[1].encode()))[: self.ranks]
        for lo, hi, sums in pair_sums(len(chunk["terms"]), sparse, totals, chunk["n_terms"], tile_cells):
            self.sums[lo, hi] = self.sums.get((lo, hi), 0) + sums

    def cells(self) -> int:
        return sum(x.size for x in self.sums.values()) + sum(map(len, self.terms.values()))

    def rows(self) -> Iterator[list[tuple]]:
        for i, terms in self.terms.items():
            yield [(self.lang, self.names[i], "term", term, f) for f, term in terms]
        for (lo, hi), sums in self.sums.items():
            for k, row in enumerate(sums.tolist()):
                yield [(self.lang, self.names[lo + k], "pair", self.names[hi + j], value) for j, value in enumerate(row) if hi + j > lo + k]


def dense(ids: np.ndarray, counts: np.ndarray, start: int, end: int) -> np.ndarray:
    """Counts of the ids from ``start`` to ``end``; ids are sorted and distinct."""
    a, b = np.searchsorted(ids, (start, end))
    out = np.zeros(end - start, dtype=np.int64)
    out[ids[a:b] - start] = counts[a:b]
    return out


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, ranks: int = RANKS, chunk_rows: int = CHUNK_ROWS, tile_cells: int = TILE_CELLS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` of every (lang, source) that occurs.

    Part ``pair``: the lang's other sources by the sum of differences of rates over kept
    terms.  Part ``term``: terms that the source has more of than its lang, the first
    ``ranks``.  Equal values rank by the UTF-8 bytes of the item.  Null lang, source and text
    are empty; a group without terms has rates too, and a lang that keeps no term has pairs
    of value 0.  Repeated rows count each; extra columns are left out; a table without rows
    gives none.
    """
    ship(docs.sparkSession)
    chunks = written(dictionary_chunks(counted_terms(docs.select("lang", "source", "text")), least, chunk_rows), "chunks")
    groups = chunks.select("lang", F.explode(F.arrays_zip("sources", "totals")).alias("g")).groupBy("lang", F.col("g.sources").alias("source")).agg(F.sum("g.totals").alias("total"))
    sizes = chunks.groupBy("lang").agg(F.sum(F.size("terms")).alias("n_terms"))
    listed = F.array_sort(F.collect_list(F.struct("source", "total")))
    sides = written(groups.groupBy("lang").agg(listed.alias("g")).join(sizes, "lang").select("lang", F.col("g.source").alias("names"), F.col("g.total").alias("all_totals"), "n_terms"), "sides")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Found] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for found in held.values():
                for rows in found.rows():
                    if rows:
                        yield batch_of(list(zip(*rows, strict=True)), _FOUND)
            held.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                chunk = batch.slice(i, 1).to_pylist()[0]
                held.setdefault(chunk["lang"], Found(chunk["lang"], chunk["names"], ranks)).add(chunk, tile_cells)
                if sum(f.cells() for f in held.values()) > HELD_CELLS:
                    yield from flush()
        yield from flush()

    found = written(chunks.join(sides, "lang").mapInArrow(run, _FOUND), "distances")
    sums = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = sums.withColumn("way", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))))
    pairs = both.select("lang", F.col("way.source").alias("source"), F.lit("pair").alias("part"), F.col("way.item").alias("item"), "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``: terms in at least 30 documents of their lang, term ranks to 50."""
    return divergence(read(spark, sf_dir, "documents"))


def oracle_op13() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rate = "1 + ({n} + 5)::HUGEINT * 1000000000 // ({total} + 5 * v)::HUGEINT"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), '{upper}', '{upper.lower()}') AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
s AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
gt AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source),
p AS (SELECT gt.lang, gt.source, k.term, coalesce(c.n, 0) AS n, {rate.format(n="coalesce(c.n, 0)", total="gt.total")} AS p
  FROM gt JOIN s ON s.lang = gt.lang JOIN k ON k.lang = gt.lang LEFT JOIN c ON c.lang = gt.lang AND c.source = gt.source AND c.term = k.term),
q AS (SELECT x.lang, x.term, {rate.format(n="x.n", total="y.total")} AS q
  FROM (SELECT lang, term, sum(n) AS n FROM p GROUP BY lang, term) x JOIN (SELECT lang, sum(total) AS total FROM gt GROUP BY lang) y ON y.lang = x.lang JOIN s ON s.lang = x.lang),
o AS (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
e AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
f AS (SELECT o.lang, o.source, 'pair' AS part, o.item, coalesce(e.value, 0) AS value FROM o LEFT JOIN e ON e.lang = o.lang AND e.source = o.source AND e.item = o.item
  UNION ALL SELECT p.lang, p.source, 'term', p.term, p.p - q.q FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q),
w AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM w WHERE part = 'pair' OR rank <= 50"""
