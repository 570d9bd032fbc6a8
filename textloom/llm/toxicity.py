"""Toxicity by subword bags, averaged into a linear softmax.

A word's vector is the mean of the vectors of its character n-grams (3 to 5 characters of
``<word>``, hashed into buckets) and of itself; a document's is the mean over its words;
a linear softmax tells both classes.  Vectors and softmax are trained jointly in numpy, by
full-batch Adam on a bounded sample of labelled rows.  Vectors start at the log odds of
their bucket between the classes' documents; buckets whose log odds are less than
``LEAST_Z`` standard errors from 0 stay at 0, as a few thousand rows can't tell more.
Words never seen, misspelt ones among them, are scored by the n-grams that they share with
known ones.

As all is linear up to the softmax, a word adds one number to its document's logit.  Those
numbers are computed once per word and task and looked up for whole texts.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import fold_of, give_back, read, ship, text_bytes

#: Bytes of words: digits, letters (A-Z as a-z), all beyond ASCII.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: The sample for the fit: labelled rows of each class at most, with their whole texts.
TOXIC_ROWS, CLEAN_ROWS = 900, 1500
BUCKETS, SIZE = 1 << 17, 4
LEAST_Z = 3.0
#: How strongly vectors are held at where they start.
PULL = 0.1
LIMIT = 0.7
HELD_OUT = (3, 1)


def buckets_of(word: bytes) -> list[int]:
    text = f"<{word.decode('utf-8', 'replace')}>"
    grams = {text[i : i + n] for n in (3, 4, 5) for i in range(len(text) - n + 1)} | {text}
    return [zlib.crc32(g.encode()) & (BUCKETS - 1) for g in sorted(grams)]


@dataclass
class Model:
    vectors: np.ndarray
    direction: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        # what each bucket adds to the logit of class 1
        self.logits = (self.vectors @ self.direction).astype(np.float64)

    def of_word(self, word: bytes) -> float:
        return float(self.logits[buckets_of(word)].mean())


class WordLogits(dict):
    def __init__(self, model: Model, most: int = 300_000):
        super().__init__()
        self.model, self.most = model, most

    def __missing__(self, word: bytes) -> float:
        if len(self) > self.most:
            self.clear()
        self[word] = x = self.model.of_word(word)
        return x


def distinct_rows(bags: list[Counter], labels: list[int]) -> list[int]:
    """The first of rows that have the same words as often and the same label."""
    first: dict[tuple, int] = {}
    for i, (bag, label) in enumerate(zip(bags, labels, strict=True)):
        first.setdefault((label, frozenset(bag.items())), i)
    return sorted(first.values())


def log_odds(docs_with: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per bucket: log odds of class 1 against 0, and how many standard errors they are
    from 0.  ``docs_with`` (2 x buckets) counts the documents that hold a bucket."""
    yes = docs_with + 0.5
    no = docs[:, None] - docs_with + 0.5
    odds = np.log(yes / no)
    delta = odds[1] - odds[0]
    return delta, delta / np.sqrt((1 / yes + 1 / no).sum(axis=0))


def train(texts: list[bytes], labels: list[int], rounds: int = 300, rate: float = 0.03, seed: int = 7) -> Model:
    """Joint fit of bucket vectors and softmax; classes weigh equally."""
    bags = [Counter(t.translate(WORD_BYTES).split()) for t in texts]
    chosen = [i for i in distinct_rows(bags, labels) if bags[i]]
    bags, target = [bags[i] for i in chosen], np.array([labels[i] for i in chosen], dtype=np.int64)
    vectors = np.zeros((BUCKETS, SIZE), dtype=np.float32)
    if len(set(target.tolist())) < 2:
        share = float(np.mean(labels)) if labels else 0.0
        return Model(vectors, np.zeros(SIZE, np.float32), math.log((share + 1e-4) / (1 - share + 1e-4)))
    grams = {w: np.unique(buckets_of(w)) for bag in bags for w in bag}
    docs_with = np.zeros((2, BUCKETS))
    for bag, y in zip(bags, target.tolist(), strict=True):
        docs_with[y, np.unique(np.concatenate([grams[w] for w in bag]))] += 1
    delta, z = log_odds(docs_with, np.bincount(target, minlength=2).astype(float))
    used = np.flatnonzero(np.abs(z) >= LEAST_Z)
    number = np.full(BUCKETS, -1)
    number[used] = np.arange(len(used))
    # per document and used bucket: its share of the mean over words and n-grams
    rows, columns, parts = [], [], []
    for d, bag in enumerate(bags):
        total = bag.total()
        for w, c in bag.items():
            own = number[grams[w]]
            own = own[own >= 0]
            if len(own):
                rows.append(np.full(len(own), d))
                columns.append(own)
                parts.append(np.full(len(own), c / total / len(grams[w])))
    x = np.zeros((len(bags), len(used)), dtype=np.float32)
    if rows:
        np.add.at(x, (np.concatenate(rows), np.concatenate(columns)), np.concatenate(parts))
    rng = np.random.default_rng(seed)
    own = (rng.normal(size=(len(used), SIZE)) * 0.01).astype(np.float32)
    own[:, 0] += delta[used]
    weights = np.zeros((SIZE, 2), dtype=np.float32)
    spread = float((x @ own[:, 0]).std()) + 1e-6
    weights[0] = -1 / spread, 1 / spread
    bias = np.zeros(2, dtype=np.float32)
    hot = np.eye(2, dtype=np.float32)[target]
    weight = (hot / hot.sum(axis=0)).sum(axis=1, keepdims=True) / 2
    slots, steps = [own, weights, bias], [rate, rate / spread, rate]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in slots]
    start = own.copy()
    for step in range(1, rounds + 1):
        docs = x @ own
        scores = docs @ weights + bias
        scores -= scores.max(axis=1, keepdims=True)
        p = np.exp(scores)
        p /= p.sum(axis=1, keepdims=True)
        off = (p - hot) * weight
        found = [x.T @ (off @ weights.T) + PULL * (own - start) / len(used), docs.T @ off, off.sum(axis=0)]
        for q, g, (m, v), r in zip(slots, found, moments, steps, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            q -= r * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    vectors[used] = own
    return Model(vectors, weights[:, 1] - weights[:, 0], float(bias[1] - bias[0]))


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text``, ``toxic`` of the sample: the labelled rows that are not held out, in the
    order of a hash, up to the bounds; contradicting labels of an id count as toxic."""
    modulus, held = HELD_OUT
    named = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    open_to = named.where(fold_of(F.col("doc_id"), modulus) != held)
    ordered = lambda x, n: open_to.where(F.col("toxic") == x).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    ids = ordered(1, TOXIC_ROWS).unionByName(ordered(0, CLEAN_ROWS))
    # at most TOXIC_ROWS + CLEAN_ROWS rows
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    rows = sorted(((r["doc_id"], (r["text"] or "").encode(), r["toxic"]) for r in sample(docs, labels).limit(2 * (TOXIC_ROWS + CLEAN_ROWS)).collect()), key=lambda r: (r[0], r[1]))
    model = train([t for _, t, _ in rows], [x for _, _, x in rows])
    del rows
    give_back()  # the driver lives on for as long as what follows takes
    return model


def score(docs: DataFrame, model: Model, with_row: bool = False) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) of each row, over whole texts; with ``row``, the whole
    row of ``docs``, if asked for.

    A text without words (null, empty) has the score of the bias alone.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.vectors, model.direction, model.bias))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = WordLogits(Model(*held.value))
        bias = held.value[2]
        for batch in batches:
            found = []
            for text in text_bytes(batch.column(1)):
                words = text.translate(WORD_BYTES).split()
                logit = bias + (math.fsum([of[w] for w in words]) / len(words) if words else 0.0)
                found.append(1 / (1 + math.exp(-min(700.0, max(-700.0, logit)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64()), *batch.columns[2:]], names=["doc_id", "score", *batch.schema.names[2:]])

    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text", *[F.struct("*").alias("row")] * with_row)
    rest = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    return rows.mapInArrow(run, "doc_id long, score double" + rest)


def toxicity(docs: DataFrame, labels: DataFrame, with_row: bool = False) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of each row (and ``row``, if asked
    for).

    Each row is scored by its own text, repeated ones alike.  Without labels of both
    classes every document has the score of the labels' share (0.5 at most without any).
    Rows whose labels are null, or that have no id, aren't learned from.  No rows: no rows.
    """
    modulus, held = HELD_OUT
    scored = score(docs, fit(docs, labels), with_row)
    return scored.select("doc_id", (fold_of(F.col("doc_id"), modulus) == held).alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"), *["row"] * with_row)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents``, learned from ``labels`` outside the held-out fold.

    Null and empty texts have the score of no words; each row has its row; rows without a label teach nothing.
    """
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def clean_only(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows that are not predicted toxic, as they came.

    Each row is judged by its own text; columns of whatever names pass through.
    """
    return toxicity(docs, read(spark, sf_dir, "labels"), with_row=True).where("predicted = 0").select("row.*")
