"""Language-model scores by a probabilistic suffix tree over bytes.

Symbols are the bytes of a text's words (A-Z lowered), one space between words and one end
symbol after the last.  Counts of all sequences of ``DEPTH + 1`` symbols in the training
texts are summed over the whole corpus; those of shorter contexts follow from them.  A
context is a candidate if it occurs ``LEAST_COUNT`` times.  It is retained if the symbols
that follow it diverge from those of its longest retained suffix: occurrences times
Kullback-Leibler divergence must reach ``LEAST_GAIN`` for each kind of symbol that follows,
a test of significance.  Neither bound tightens with the corpus, so the tree grows with it.
Each retained distribution is smoothed by that of the suffix.

A sequence is one number, its last symbol in the highest byte: what it is without its oldest
symbols is its highest bytes.  The tree is grown level by level as a table of the sequences
whose context is retained.  A sequence that it lacks has the probability of the one without
its oldest symbol, times the weight that the context leaves to its suffix.

For scoring, the table goes to the workers in blocks of at most ``BLOCK_ENTRIES`` entries, by
the last two symbols of the contexts (a block is larger only if one such pair is); a worker
holds one block at a time.  Each sequence of a text is looked up in the block of its context.
As no context is longer than DEPTH, a text can be cut anywhere and each part started DEPTH
symbols early; so parts of bounded size are scored, and whole texts.

The unigram base needs the count of every word.  The most frequent ones, a bounded number,
are looked up in the workers; all others are joined with the table of counts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import Tables, fold_of, read, safe_names, ship, text_bytes

DEPTH = 6
LEAST_COUNT = 16
#: Nats that a context must save over all its occurrences, for each kind of next symbol.
LEAST_GAIN = 6.0
#: Entries of the tree that a worker holds: 20 bytes each at most.
BLOCK_ENTRIES = 4_000_000
#: Words that workers look up by themselves, and their greatest length in bytes.
HEAD_WORDS, HEAD_BYTES = 65_536, 64
#: Bytes that are counted or scored together.
TOGETHER = 4_000_000
#: Entries that a task counts before it sends them on.
HELD_WORDS, HELD_GRAMS = 300_000, 4_000_000
HELD_OUT = (7, 2)
END = b"\n"


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def padded(words: list[bytes]) -> bytes:
    """Start context, words, end."""
    return END * DEPTH + b" ".join(words) + END


def parts_of(text: bytes) -> Iterator[bytes]:
    """A padded text in parts of bounded size, each with the context of its first symbol."""
    for start in range(0, len(text) - DEPTH, TOGETHER):
        yield text[start : start + TOGETHER + DEPTH]


def sequences_of(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences of DEPTH + 1 bytes as numbers, part by part, and where each part begins."""
    raw = np.frombuffer(b"".join(parts), dtype=np.uint8)
    keys = np.zeros(max(0, len(raw) - DEPTH), dtype=np.int64)
    for k in range(DEPTH, -1, -1):
        keys = (keys << 8) | raw[k : len(raw) - DEPTH + k]
    ends = np.cumsum([len(p) for p in parts])
    within = np.ones(len(raw), dtype=bool)
    within[(ends[:, None] - DEPTH + np.arange(DEPTH)).ravel()] = False
    return keys[within[: len(keys)]], ends - [len(p) for p in parts] - DEPTH * np.arange(len(parts))


def grams_of(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences of padded texts or their parts, with their counts."""
    return np.unique(sequences_of(parts)[0], return_counts=True)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts)


def count_corpus(docs: DataFrame) -> DataFrame:
    """Partial counts: ``word`` with ``n``, or ``gram`` with ``n``; gram -1 counts texts."""

    def rows(words: Counter, grams: list, n_texts: int) -> Iterator[pa.RecordBatch]:
        kinds = (pa.binary(), pa.int64(), pa.int64())
        keys, counts = merged(grams) if grams else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        keys, counts = np.append(keys, -1), np.append(counts, n_texts)
        for columns in ((list(words), None, list(words.values())), (None, keys, counts)):
            n = len(columns[2])
            yield pa.RecordBatch.from_arrays([pa.nulls(n, k) if c is None else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "gram", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        grams: list = []
        held = n_texts = size = 0
        buffer: list[bytes] = []
        for batch in batches:
            for text in text_bytes(batch.column(0)):
                own = words_of(text)
                words.update(own)
                n_texts += 1
                for part in parts_of(padded(own)):
                    buffer.append(part)
                    size += len(part)
                    if size > TOGETHER:
                        grams.append(grams_of(buffer))
                        held += len(grams[-1][0])
                        buffer, size = [], 0
                if held > HELD_GRAMS:
                    grams = [merged(grams)]
                    held = len(grams[0][0])
                if len(words) > HELD_WORDS or held > HELD_GRAMS // 2 and len(grams) == 1:
                    yield from rows(words, grams, n_texts)
                    words, grams, held, n_texts = Counter(), [], 0, 0
        if buffer:
            grams.append(grams_of(buffer))
        yield from rows(words, grams, n_texts)

    ship(docs.sparkSession)
    return docs.select("text").mapInArrow(run, "word binary, gram long, n long")


def context_of(gram, level: int):
    """Of a sequence with ``level`` symbols before the last."""
    return gram & ((1 << (8 * level)) - 1)


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is in the sorted table, and where."""
    if not len(table):
        return np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return table[at] == keys, at


class Tree:
    """Some retained contexts: sequences with log10 probabilities and weights by level."""

    def __init__(self, root: np.ndarray, level: np.ndarray, gram: np.ndarray, log10: np.ndarray, weight: np.ndarray):
        """``root``: log10 probabilities without context; the rest, a place per sequence."""
        self.root, self.levels = root, []
        for k in range(DEPTH, 0, -1):
            own = np.flatnonzero(level == k)
            own = own[np.argsort(gram[own], kind="stable")]
            contexts, first = np.unique(context_of(gram[own], k), return_index=True)
            self.levels.append((k, gram[own], log10[own].astype(np.float32), contexts, weight[own][first].astype(np.float32)))

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of the last symbol of each sequence after the others."""
        total = np.zeros(len(keys))
        still = np.arange(len(keys))
        for k, grams, log10, contexts, weight in self.levels:
            own = keys[still] >> (8 * (DEPTH - k))
            known, at = find(grams, own)
            total[still[known]] += log10[at[known]]
            still, own = still[~known], own[~known]
            known, at = find(contexts, context_of(own, k))
            total[still[known]] += weight[at[known]]
        total[still] += self.root[keys[still] >> (8 * DEPTH)]
        return total


def scores(texts: list[bytes], blocks: list, block_of: np.ndarray) -> np.ndarray:
    """log10 probability of each padded text; ``blocks``: functions that give a Tree each,
    ``block_of``: the block of each pair of last symbols."""
    total = np.zeros(len(texts))
    parts: list[bytes] = []
    owner: list[int] = []

    def add() -> None:
        found, starts = sequences_of(parts)
        keys, place = np.unique(found, return_inverse=True)
        block = block_of[(keys >> (8 * (DEPTH - 2))) & 0xFFFF]
        value = np.zeros(len(keys))
        for b, tree in enumerate(blocks):
            own = np.flatnonzero(block == b)
            if len(own):
                value[own] = tree().log10(keys[own])
        total[:] += np.bincount(owner, weights=np.add.reduceat(value[place], starts), minlength=len(texts))
        parts.clear(), owner.clear()

    held = 0
    for i, text in enumerate(texts):
        for part in parts_of(text):
            parts.append(part)
            owner.append(i)
            held += len(part)
            if held >= TOGETHER:
                add()
                held = 0
    if parts:
        add()
    return total


def grow(grams: DataFrame, tables: Tables) -> tuple[np.ndarray, DataFrame]:
    """Probabilities without context, and ``level``, ``gram``, ``p``, ``weight`` of the
    sequences whose context is retained."""
    counts = [grams]
    for k in range(DEPTH - 1, -1, -1):
        counts.append(tables.written(counts[-1].groupBy(F.shiftright("gram", 8).alias("gram")).agg(F.sum("n").alias("n")), f"grams-{k}"))
    root = np.ones(256)
    for r in counts[-1].collect():  # a row per symbol
        root[r["gram"]] += r["n"]
    root /= root.sum()
    above = grams.sparkSession.createDataFrame(list(enumerate(root.tolist())), "gram long, p double")
    made = []
    for k in range(1, DEPTH + 1):
        # what is in no candidate's suffix is in no candidate, so the join loses none
        parents = above.select(F.col("gram").alias("suffix"), F.col("p").alias("parent"))
        joined = counts[DEPTH - k].withColumn("suffix", F.shiftright("gram", 8)).join(parents, "suffix")
        grouped = joined.groupBy(F.col("gram").bitwiseAND((1 << (8 * k)) - 1).alias("context")).agg(
            F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum(F.col("n") * F.log(F.col("n") / F.col("parent"))).alias("own"),
            F.collect_list(F.struct("gram", "n", "parent")).alias("rows"),  # at most 256
        ).where(F.col("total") >= LEAST_COUNT)
        kept = F.col("own") - F.col("total") * F.log("total") >= LEAST_GAIN * F.col("kinds")
        rows = grouped.select("total", "kinds", kept.alias("kept"), F.inline("rows"))
        # the more kinds of symbols follow, the more weight has the suffix
        smoothed = (F.col("n") + F.col("kinds") * F.col("parent")) / (F.col("total") + F.col("kinds"))
        above = tables.written(rows.select("gram", "kept", F.when(F.col("kept"), smoothed).otherwise(F.col("parent")).alias("p"), (F.col("kinds") / (F.col("total") + F.col("kinds"))).alias("weight")), f"level-{k}")
        made.append(above.where("kept").select(F.lit(k).alias("level"), "gram", "p", "weight"))
    entries = made[0]
    for level in made[1:]:
        entries = entries.unionByName(level)
    return root, entries


def in_blocks(root: np.ndarray, entries: DataFrame) -> tuple[list, np.ndarray]:
    """A broadcast Tree for each block, and the block of each pair of last symbols."""
    sc = entries.sparkSession.sparkContext
    # sequences of one symbol of context, at most 65,536, are in all blocks
    pair = F.expr(f"CASE WHEN level > 1 THEN CAST(shiftright(gram, 8 * (level - 2)) & {0xFFFF} AS INT) END")
    entries = entries.withColumn("pair", pair)
    sizes = np.zeros(1 << 16, dtype=np.int64)
    for r in entries.where("pair IS NOT NULL").groupBy("pair").agg(F.count("*").alias("n")).collect():
        sizes[r["pair"]] = r["n"]
    block_of = np.zeros(1 << 16, dtype=np.int64)
    block = held = 0
    for p, n in enumerate(sizes.tolist()):
        if held and held + n > BLOCK_ENTRIES:
            block, held = block + 1, 0
        block_of[p] = block
        held += n
    trees = []
    for b in range(block + 1):
        pairs = np.flatnonzero(block_of == b)
        own = entries.where(F.col("pair").isNull() | F.col("pair").between(int(pairs[0]), int(pairs[-1])))
        table = own.select("level", "gram", F.log10("p").cast("float").alias("p"), F.log10("weight").cast("float").alias("weight")).toArrow()
        trees.append(sc.broadcast(Tree(np.log10(root), *(table.column(c).to_numpy() for c in ("level", "gram", "p", "weight")))))
    return trees, block_of


def score_texts(docs: DataFrame, trees: list, block_of: np.ndarray, head: dict[bytes, int], n_texts: int) -> DataFrame:
    """Per row: ``score``, the base sum over head words and the end, and the other words."""
    held = docs.sparkSession.sparkContext.broadcast(({w: math.log10(c + 1) for w, c in head.items()}, math.log10(n_texts + 1), block_of))

    def loader(tree):
        def load() -> Tree:
            value = tree.value
            if len(trees) > 1:
                vars(tree).pop("_value", None)  # a worker holds one block at a time
            return value

        return load

    names = ["n_tokens", "head_known", "head_sum", "rest", "score"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, end, block_of = held.value
        blocks = [loader(t) for t in trees]
        for batch in batches:
            texts = text_bytes(batch.column(1))
            start = 0
            while start < len(texts):
                stop, size, rows, own = start, 0, [[] for _ in range(4)], []
                while stop < len(texts) and (stop == start or size < TOGETHER):
                    words = words_of(texts[stop])
                    known = [x for x in map(logs.get, words) if x is not None]
                    rest = [w for w in words if w not in logs] if len(known) < len(words) else []
                    for row, value in zip(rows, (len(words) + 1, len(known) + (n_texts > 0), math.fsum(known) + end, rest), strict=True):
                        row.append(value)
                    own.append(padded(words))
                    size += len(own[-1])
                    stop += 1
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary()))
                made = [pa.array(r, k) for r, k in zip(rows, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), *made, pa.array(scores(own, blocks, block_of))], names=["doc_id", *names])
                start = stop

    return docs.mapInArrow(run, "doc_id long, n_tokens long, head_known long, head_sum double, rest array<binary>, score double")


def language_model_scores(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` of each row.

    A null or empty text is the end alone.  Without training texts all counts are 0 and
    every symbol has probability 1/256.
    """
    modulus, held_out = HELD_OUT
    rows = safe_names(docs, "doc_id", "text")
    held = fold_of(F.col("doc_id"), modulus) == held_out
    with Tables(docs.sparkSession) as tables:
        parts = tables.written(count_corpus(rows.where(~held)), "counts")
        vocabulary = tables.kept(parts.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
        grams = tables.written(parts.where("gram >= 0").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
        n_texts = parts.where("gram = -1").agg(F.sum("n")).first()[0] or 0
        tables.drop(parts)
        trees, block_of = in_blocks(*grow(grams, tables))
        totals = vocabulary.agg(F.count("*").alias("kinds"), F.sum("n").alias("n")).first()
        n_tokens = (totals["n"] or 0) + n_texts
        kinds = totals["kinds"] + (n_texts > 0)
        head_rows = vocabulary.where(F.octet_length("word") <= HEAD_BYTES).orderBy(F.desc("n"), "word").limit(HEAD_WORDS).collect()
        made = score_texts(rows, trees, block_of, {bytes(r["word"]): r["n"] for r in head_rows}, n_texts)
        scored = tables.kept(made.withColumn("row_id", F.monotonically_increasing_id()), "scored")
    # words without a count add nothing to the sum
    rest = scored.select("row_id", F.explode("rest").alias("word")).join(vocabulary, "word").groupBy("row_id").agg(F.count("*").alias("rest_known"), F.sum(F.log10(F.col("n") + 1)).alias("rest_sum"))
    return scored.drop("rest").join(rest, "row_id", "left").select(
        "doc_id", held.alias("held_out"), "n_tokens",
        (F.col("head_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("head_sum") + F.coalesce("rest_sum", F.lit(0.0)) - F.col("n_tokens") * math.log10(n_tokens + kinds + 1)).alias("base_score"),
        "score",
    )


def op9_suffix_tree(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents``; a null or blank text is its end token. Repeated rows count each in training."""
    return language_model_scores(read(spark, sf_dir, "documents"))
