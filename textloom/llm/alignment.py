"""Alignment of two tokenizers' tokens by elementary intervals of bytes.

Both tokenizers encode the same bytes.  The ends of their tokens together (``union1d``) cut
the text into elementary intervals; ``searchsorted`` gives the token of either side that owns
an interval, so each interval is one overlap of two tokens.  An end that both sides share
closes a group; within a group, every token of one side may be matched with every token of
the other (the group's product), and the two tokens that end with it are a link.

How often an id pair is linked in all the corpus decides which links are the best of their
B id.  Counts are summed within blocks of documents first: a block holds at most
``BLOCK_LINKS`` links (or one document with more), its links refer to the block's own sorted
table of pairs, and only those tables meet the corpus-wide counts.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import read, safe_names, ship, text_bytes, written
from textloom.llm.tokens import default_vocabulary, encoder

BLOCK_LINKS = 1_000_000
#: U+2581 stands for a space in pieces; a fixed value of this kind of vocabulary.
SPACE = "▁"

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_overlaps long, n_products long, groups string, groups_sha256 string"
_BLOCKED = f"block long, {ALIGNED}, links binary, pairs array<long>, times array<long>"


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """Ids of a piece model, which sets a space before the text, and the bytes of its pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]


class Aligner:
    """Tokens of both sides for a text, and how they meet.

    A space that stands alone between other characters ends tokens of both sides, so such a
    text is encoded word by word, and the ids of words are remembered.  That holds for the
    byte level as ``tokens`` states, and for piece models none of whose pieces holds a space
    after another character.  Other texts are encoded as a whole.
    """

    def __init__(self, path_a: str, path_b: str, most_words: int = 400_000):
        self.a, self.b = encoder(path_a), PieceModel(path_b)
        self.tokens = self.a.token_bytes(), self.b.tokens
        self.lengths = [np.array([len(t) for t in tokens], dtype=np.int64) for tokens in self.tokens]
        self.inner = [np.array([f"{i}," for i in range(len(tokens))], dtype=object) for tokens in self.tokens]
        self.last = [np.array([f"{i}{mark}" for i in range(len(tokens))], dtype=object) for tokens, mark in zip(self.tokens, "|;", strict=True)]
        self.most, self.words = most_words, {}

    def remember(self, words: list[str]) -> None:
        """Ids of words that stand alone, both sides; None where either side's bytes differ."""
        of_a, of_b = self.tokens
        for word, b in zip(words, self.b.model.encode(words, num_threads=1), strict=True):
            a = self.a.bpe.encode_ordinary(f" {word}")
            alone = not word[0].isspace() and not word[-1].isspace() and SPACE not in word
            same = alone and b"".join([of_a[i] for i in a]) == b"".join([of_b[i] for i in b]) == f" {word}".encode()
            self.words[word] = (array("I", a).tobytes(), array("I", b).tobytes()) if same else None

    def encoded(self, text: str) -> list[np.ndarray]:
        """Ids of both sides; none where either doesn't give back the text's bytes."""
        words = text.split(" ")
        if self.b.by_word and "" not in words:
            if len(self.words) > self.most:
                self.words.clear()
            if new := [w for w in dict.fromkeys(words) if w not in self.words]:
                self.remember(new)
            found = [self.words[w] for w in words]
            if None not in found:
                return [np.frombuffer(b"".join(side), dtype="<u4").astype(np.int64) for side in zip(*found, strict=True)]
        whole = f" {text}"
        sides = [np.frombuffer(self.a.whole(whole), dtype="<u4").astype(np.int64), np.asarray(self.b.model.encode(text), dtype=np.int64)]
        if text and all(b"".join([tokens[i] for i in ids.tolist()]) == whole.encode() for ids, tokens in zip(sides, self.tokens, strict=True)):
            return sides
        return [np.empty(0, np.int64)] * 2

    def groups(self, ids: list[np.ndarray], group: list[np.ndarray], ends_group: list[np.ndarray]) -> str:
        """``a1,a2|b1;a3|b2,b3``: ids in order, groups in order."""
        marked = np.concatenate([np.where(last, self.last[k][i], self.inner[k][i]) for k, (i, last) in enumerate(zip(ids, ends_group, strict=True))])
        order = np.argsort(np.concatenate([group[0] * 2, group[1] * 2 + 1]), kind="stable")
        return "".join(marked[order].tolist())[:-1]

    def aligned(self, text: bytes) -> tuple[tuple, np.ndarray, str]:
        """Numbers of tokens (A, B), groups, overlaps and products; links as a << 32 | b; the groups."""
        a, b = ids = self.encoded(text.decode("utf-8"))
        if not len(a):
            return (0, 0, 0, 0, 0), np.empty(0, np.int64), ""
        ends = [np.cumsum(n[i]) for n, i in zip(self.lengths, ids, strict=True)]
        cuts = np.union1d(*ends)
        owner = [np.searchsorted(e, cuts) for e in ends]
        shared = (ends[0][owner[0]] == cuts) & (ends[1][owner[1]] == cuts)
        closing = cuts[shared]
        group = [np.searchsorted(closing, e) for e in ends]
        ends_group = [closing[g] == e for g, e in zip(group, ends, strict=True)]
        sizes = [np.bincount(g, minlength=len(closing)) for g in group]
        links = a[owner[0][shared]] << 32 | b[owner[1][shared]]
        return (len(a), len(b), len(closing), len(cuts), int((sizes[0] * sizes[1]).sum())), links, self.groups(ids, group, ends_group)


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker process."""
    return Aligner(path_a, path_b)


def blocks_of(docs: DataFrame, path_a: str, path_b: str, with_groups: bool, block_links: int) -> DataFrame:
    """A row per document, its links as places in the pair table of its block, and a row per block with that table.

    A block is numbered by its partition and its place there, so a repeated task makes it once more.
    """
    kinds = [pa.int64()] * 7 + [pa.string(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = [field.split()[0] for field in _BLOCKED.split(", ")]

    def flush(block: int, rows: list[tuple], links: list[np.ndarray]) -> pa.RecordBatch:
        pairs, place, times = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
        place = place.astype("<u2" if len(pairs) <= 1 << 16 else "<u4")
        at = np.cumsum([0, *map(len, links)])
        rows = [(block, *row, place[at[i] : at[i + 1]].tobytes(), None, None) for i, row in enumerate(rows)]
        rows.append((block, *[None] * 9, pairs, times))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        block, rows, links, held = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                counts, linked, groups = both.aligned(text)
                digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
                rows.append((doc_id, *counts, groups if with_groups else None, digest))
                links.append(linked)
                held += len(linked)
                if held >= block_links or len(rows) >= 50_000:
                    yield flush(block, rows, links)
                    block, rows, links, held = block + 1, [], [], 0
        if rows:
            yield flush(block, rows, links)

    ship(docs.sparkSession)
    return safe_names(docs, "doc_id", "text").mapInArrow(run, _BLOCKED)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair``, ``links``, ``best`` (none of its B id has more) over the whole corpus.

    Blocks bring each pair once, so a frequent pair reaches its sum as one row per block at most.
    """
    corpus = blocks.groupBy("pair").agg(F.sum("times").alias("links")).withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    most = corpus.groupBy("b").agg(F.max("links").alias("most"))
    return corpus.join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, with_groups: bool = True, block_links: int = BLOCK_LINKS) -> DataFrame:
    """``ALIGNED`` and ``n_links``, ``n_best``, ``count_sum`` of each document.

    Null and empty texts, and texts whose bytes a tokenizer doesn't give back (it may fold
    characters), have no tokens: zeros, no groups, an empty digest.  Each row of ``docs`` has
    its row here, repeated rows too, whose links all count; null ids stay null.  Extra columns
    are left out.  A table without rows gives none.  Of B ids with several best pairs, the
    links of all of them are best.
    """
    path_a, path_b = path_a or default_vocabulary(), path_b or default_pieces()
    table = written(blocks_of(docs, path_a, path_b, with_groups, block_links), "aligned")
    blocks = table.where("pairs IS NOT NULL").select("block", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("block", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    known = blocks.select("block", "pair").join(pair_counts(blocks), "pair").select(F.col("block").alias("of_block"), "pair", "links", "best")
    own = ALIGNED + ", n_links long, n_best long, count_sum long"
    columns = [c.split()[0] for c in ALIGNED.split(", ")]

    def counted(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs = right.column("pair").to_numpy()
        order = np.argsort(pairs)
        links, best = (right.column(c).to_numpy(zero_copy_only=False)[order].astype(np.int64) for c in ("links", "best"))
        small = len(pairs) <= 1 << 16
        n = [[], [], []]
        for place in left.column("links").to_pylist():
            at = np.frombuffer(place, dtype="<u2" if small else "<u4")
            for out, value in zip(n, (len(at), int(best[at].sum()), int(links[at].sum())), strict=True):
                out.append(value)
        out = left.select(columns)
        for name, value in zip(("n_links", "n_best", "count_sum"), n, strict=True):
            out = out.append_column(name, pa.array(value, pa.int64()))
        return out

    rows = table.where("pairs IS NULL").select("block", *columns, "links")
    return rows.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(counted, own)


def op12_alignment(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents``, the byte-level vocabulary against the piece model."""
    return align(read(spark, sf_dir, "documents"), with_groups=False).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps", "n_products")
