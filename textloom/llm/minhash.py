"""Near duplicates: SuperMinHash signatures, bands, verification, components.

A document's set is that of its word shingles (64-bit hashes).  In SuperMinHash every
element draws a random permutation of the signature's places and gives its j-th place the
value j + r.  Ranks of one element are correlated, which lowers the variance for small
sets, and values of rank j and more can't matter once all places hold less than j, so
most sets stop after a few ranks.  Here ranks are worked off one after another for all
sets of a batch at once.

Documents with equal sets are one class; only classes go on.  Classes that share the
values of a band are candidates; ``bucket_components`` says which of them are compared.
Candidates are verified on their full sets, computed anew from their texts.

With 24 bands of 5 a pair of similarity 0.8 shares no band with probability 0.00007.
Pairs whose signatures agree in less than ``least_agreement`` places (5 standard
deviations under what similarity 0.8 gives) are not verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import Tables, read, safe_names, ship, text_bytes, written
from textloom.llm.components import bucket_components

BANDS, ROWS = 24, 5
PLACES = BANDS * ROWS
PERCENT = 80
#: Words of a shingle, and those of op7's contract.
WORDS, OP7_WORDS = 5, 2
#: Elements whose permutations are in memory at once, 120 bytes each.
CHUNK = 300_000

SETS = "node long, elements array<long>"
SIGNED = "doc_id long, n_shingles long, set_key binary, bands array<long>, places array<long>"

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes, hashes: WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, dtype=_U)
    h = np.fromiter((hashes[w] for w in parts), dtype=_U, count=len(parts))
    n = min(words, len(h))
    made = np.full(len(h) - n + 1, n, dtype=_U)
    for k in range(n):
        made = mix(made * _U(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k])
    return np.unique(made)


def superminhash(elements: np.ndarray, owner: np.ndarray, n_sets: int, places: int = PLACES, seed: int = 1) -> np.ndarray:
    """Signatures (n_sets x places): rank in the upper, fraction in the lower 32 bits.

    ``owner`` numbers the set of each element.  Sets without elements keep the largest
    value everywhere.
    """
    signature = np.full(n_sets * places, np.iinfo(np.uint64).max, dtype=_U)
    low = _U(0xFFFFFFFF)
    at = owner.astype(np.int64) * places
    order = None
    for rank in range(places):
        x = mix(elements + _U(((rank + 1) * 0xD1B54A32D192ED03 + seed) & 0xFFFFFFFFFFFFFFFF))
        pick = (rank + (((x & low) * _U(places - rank)) >> _U(32))).astype(np.int64)
        value = (x >> _U(32)) | _U(rank << 32)
        if rank == 0:
            place = pick
        else:
            rows = np.arange(len(elements))
            place = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, rank]
        np.minimum.at(signature, at + place, value)
        highest = signature.reshape(n_sets, places).max(axis=1)
        active = highest[at // places] >= _U((rank + 1) << 32)
        if not active.any():
            break
        if rank == 0:
            elements, at, place = elements[active], at[active], place[active]
            order = np.tile(np.arange(places, dtype=np.uint8), (len(elements), 1))
            order[np.arange(len(elements)), place] = 0
        elif active.mean() < 0.6:
            elements, at, order = elements[active], at[active], order[active]
    return signature.reshape(n_sets, places)


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    keys = np.empty((len(signature), bands), dtype=_U)
    for b in range(bands):
        key = np.full(len(signature), b + 1, dtype=_U)
        for k in range(rows):
            key = mix(key * _U(0x9E3779B97F4A7C15) + signature[:, b * rows + k])
        keys[:, b] = key
    return keys


def chunks(sizes: list[int], most: int) -> Iterator[slice]:
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    yield slice(start, len(sizes))


def _lists(rows: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(rows).view(np.int64).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), flat)


def sign(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``SIGNED`` of each row; ``places`` has the low byte of each value, 8 to a long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, hashes, words) for t in text_bytes(batch.column(1))]
            sizes = [len(s) for s in sets]
            for part in chunks(sizes, CHUNK):
                own, n = sets[part], sizes[part]
                signature = superminhash(np.concatenate([*own, np.zeros(0, _U)]), np.repeat(np.arange(len(own)), n), len(own))
                keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in own]
                low = mix(signature).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.start, len(own)), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), _lists(band_keys(signature)), _lists(low.view(_U))],
                    names=["doc_id", "n_shingles", "set_key", "bands", "places"],
                )

    ship(docs.sparkSession)
    return safe_names(docs, "doc_id", "text").mapInArrow(run, SIGNED)


def full_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``SETS``: the whole set of each row, computed anew from its text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, hashes, words) for t in text_bytes(batch.column(1))]
            for part in chunks([len(s) for s in sets], CHUNK):
                own = sets[part]
                at = np.concatenate([[0], np.cumsum([len(s) for s in own])]).astype(np.int32)
                flat = pa.array(np.concatenate([*own, np.zeros(0, _U)]).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, len(own)), pa.ListArray.from_arrays(pa.array(at), flat)], names=["node", "elements"])

    return safe_names(docs, "doc_id", "text").mapInArrow(run, SETS)


def agreement(a: Column, b: Column, longs: int = PLACES // 8) -> Column:
    """In how many bytes two packed signatures agree: zero bytes of their difference."""
    total = F.lit(8 * longs)
    for k in range(longs):
        x = a[k].bitwiseXOR(b[k])
        for shift in (4, 2, 1):  # bit 0 of each byte gathers all bits of that byte
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        total = total - F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))
    return total


def least_agreement(percent: int = PERCENT, places: int = PLACES) -> int:
    s = percent / 100
    return math.floor(places * s - 5 * math.sqrt(places * s * (1 - s)))


def similar_size(a: Column, b: Column, percent: int = PERCENT) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of ``pairs`` (a, b) those whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    return pairs.join(left, "a").join(right, "b").where(both * 100 >= (F.size("of_a") + F.size("of_b") - both) * percent).select("a", "b")


class Block:
    """Sets of the held members of a block, by element."""

    def __init__(self, percent: int):
        self.percent, self.held, self.index = percent, [], None

    def add(self, node: int, component: int, elements: np.ndarray) -> None:
        self.held.append((node, component, elements))

    def links(self, node: int, component: int, elements: np.ndarray) -> list[tuple[int, int]]:
        """Held members of other components whose sets are similar enough."""
        if not self.held:
            return []
        if self.index is None:
            every = np.concatenate([e for _, _, e in self.held])
            order = np.argsort(every, kind="stable")
            self.sizes = np.array([len(e) for _, _, e in self.held])
            self.owner = np.repeat(np.arange(len(self.held)), self.sizes)[order]
            self.index = every[order]
        first, last = np.searchsorted(self.index, elements, side="left"), np.searchsorted(self.index, elements, side="right")
        n = last - first
        at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(self.owner[at], minlength=len(self.held))
        near = np.flatnonzero(both * 100 >= (self.sizes + len(elements) - both) * self.percent)
        return [(self.held[k][0], node) for k in near.tolist() if self.held[k][1] != component]


def linked_in_blocks(rows: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links between held and passing members; held ones come first in each block, and are
    all that a task keeps."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, Block(percent)
        for batch in batches:
            found: list[tuple[int, int]] = []
            elements = batch.column(5)
            flat, ends = np.asarray(elements.values), np.asarray(elements.offsets)
            for i, (pivot, number, passing, node, component) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True)):
                if (pivot, number) != key:
                    key, block = (pivot, number), Block(percent)
                own = flat[ends[i] : ends[i + 1]]
                if passing:
                    found += block.links(node, component, own)
                else:
                    block.add(node, component, own)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(2)], names=["a", "b"])

    full = rows.join(sets, "node").select("pivot", "block", (~F.col("held")).alias("passing"), "node", "component", "elements")
    return full.repartition("pivot", "block").sortWithinPartitions("pivot", "block", "passing", "node").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` of each row of ``docs``.

    A document without words (null, empty, white space) is linked with nothing.  A row
    without doc_id is linked with nothing and stays, its component is null.  Rows that
    share a doc_id are one document.  Ties: the smallest doc_id stands for its component.
    """
    with Tables(docs.sparkSession) as tables:
        return _near_duplicates(docs, tables, percent, words)


def _near_duplicates(docs: DataFrame, tables: Tables, percent: int, words: int) -> DataFrame:
    signed = tables.written(sign(docs, words), "signed")
    named = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # equal sets have equal bands; copies are merged before the shuffle
    classes = tables.written(
        named.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("places").alias("places")), "classes"
    )
    places = classes.select("node", "places")
    texts = safe_names(docs, "doc_id", "text")
    made: list[DataFrame] = []

    def linked(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """Pairs whose signatures agree often enough and whose full sets are similar."""
        if not made:
            made.append(tables.written(full_sets(texts.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi"), words), "sets"))
        signed_pairs = pairs.join(places.select(F.col("node").alias("a"), F.col("places").alias("of_a")), "a").join(places.select(F.col("node").alias("b"), F.col("places").alias("of_b")), "b")
        alike = signed_pairs.where(agreement(F.col("of_a"), F.col("of_b")) >= least_agreement(percent)).select("a", "b")
        return verified(alike, made[0], percent).distinct()

    entries = classes.select(F.explode("bands").alias("band"), "node", F.col("n").alias("info"))
    final = bucket_components(entries, lambda a, b: similar_size(a, b, percent), linked, lambda rows: linked_in_blocks(rows, made[0], percent), tables)
    by_class = classes.select("set_key", "node").join(final, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"))
    joined = signed.select("doc_id", "n_shingles", "set_key").join(by_class, "set_key", "left")
    # a row without id may share a set with others, but is none of theirs
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    result = joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    return tables.kept(result, "near-duplicates")


def op7_minhash(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` by shingles of two words; those without words link with nothing."""
    return near_duplicates(read(spark, sf_dir, "documents"), words=OP7_WORDS)


def one_of_each(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that stay, all columns kept; by shingles of five words.

    Rows that share a doc_id are one document and stay or go together; those without an
    id, and those without words, stay.  No rows: no rows.
    """
    # written, so that the join knows how few they are: texts need no shuffle for a few ids
    gone = written(near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def oracle_op7() -> str:
    """All pairs that share a shingle, their exact similarity, and labels spread along links."""
    return r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[p] || ' ' || w[p + 1] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS p FROM d WHERE len(w) > 1)
  UNION SELECT doc_id, w[1] FROM d WHERE len(w) = 1),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
rare AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
sh AS (SELECT s.doc_id, s.g, n.n FROM s JOIN rare USING (g) JOIN n USING (doc_id)),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id
  AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80 GROUP BY ALL),
l AS (SELECT a, b FROM i WHERE 100 * c >= 80 * (na + nb - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.y) AS component_id, d.doc_id = min(r.y) AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.x = d.doc_id GROUP BY d.doc_id, n.n"""
