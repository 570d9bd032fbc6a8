"""Packing of documents into token sequences by shortest-pack-first.

Every document is encoded once.  Its ids are cut into full sequences and one
remainder.  The histogram of piece lengths has at most ``capacity`` entries however
large the corpus is; it alone goes to the driver, where lengths are placed longest
first, each into the packs with the most room left, and whole counts of equal packs
move at once.  What results are patterns (lengths of a pack, number of such packs).
Each piece then takes its place by its rank among the pieces of its length; ranks come
from salted groups, so that a length that a third of all pieces share is spread.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import read, safe_names, ship, text_bytes, written
from textloom.llm.tokens import default_vocabulary, encoder

CAPACITY = 1024
END_ID = 0
#: Pieces that one task ranks, on average.
RANKED_TOGETHER = 500_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = PIECES + ", sequence_id long, offset long, padded_to long"


def encode_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``PIECES`` of each document (and, if asked for, ``ids`` as bytes)."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    end = np.asarray([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                ids = bpe.encode(text.decode("utf-8")) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    for row, value in zip(rows, (doc_id, start, len(piece) // 4, zlib.crc32(piece), total, piece), strict=False):
                        row.append(value)
            kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names=names)

    ship(docs.sparkSession)
    return safe_names(docs, "doc_id", "text").mapInArrow(run, PIECES + ", ids binary" * with_ids)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(number of packs, lengths in a pack) for all pieces of the histogram.

    Where no open pack has room for a length, new ones take as many pieces of it as fit.
    """
    by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, packs in by_room.items() if packs), default=0)
            if room < length:
                fit = capacity // length
                full, rest = divmod(left, fit)
                for count, times in ((full, fit), (1, rest)):
                    if count and times:
                        by_room[capacity - times * length].append((count, (length,) * times))
                break
            count, pack = by_room[room].pop()
            if count > left:
                by_room[room].append((count - left, pack))
                count = left
            by_room[room - length].append((count, (*pack, length)))
            left -= count
    return [packed for packs in by_room.values() for packed in packs]


class Places:
    """Where the piece of rank r among those of its length goes."""

    def __init__(self, patterns: list[tuple[int, tuple[int, ...]]], capacity: int):
        first_id, self.capacity = 0, capacity
        taken: dict[int, int] = defaultdict(int)
        rows = []
        for count, lengths in sorted(patterns, key=lambda x: (x[1], x[0])):
            used, at = sum(lengths), 0
            for length in sorted(set(lengths), reverse=True):
                times = lengths.count(length)
                rows.append((length, taken[length], first_id, times, at, used))
                taken[length] += count * times
                at += length * times
            first_id += count
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)
        self.key = (table[:, 0] << 48) | table[:, 1]
        self.table = table

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence id, offset, and the length that the sequence is padded to."""
        row = self.table[np.searchsorted(self.key, (length << 48) | rank, side="right") - 1]
        nth = rank - row[:, 1]
        used = row[:, 5]
        whole = (used & (used - 1)) == 0
        return row[:, 2] + nth // row[:, 3], row[:, 4] + nth % row[:, 3] * length, np.where(whole, used, self.capacity)


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """``rank`` from 0 among the pieces of equal length.

    Within (length, salt) a window numbers the rows; what lies before a salt is a sum
    over at most lengths x salts counts.
    """
    salts = max(1, total // RANKED_TOGETHER) * 8
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)))
    before = (
        salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
        .select("length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    )
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    return (
        salted.withColumn("nth", F.row_number().over(order) - 1)
        .join(before, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("nth"))
        .drop("salt", "before", "nth")
    )


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``PLACED`` (and ``ids`` as bytes, if asked for).

    A null or empty text has the end id alone.  Repeated rows are packed as often as
    they occur; a null doc_id is kept.  No document: no row.
    """
    pieces = written(encode_pieces(docs, path or default_vocabulary(), capacity, with_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = Places(shortest_pack_first(histogram, capacity), capacity)

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(k), dtype=np.int64) for k in ("length", "rank"))
            found = places.of(length, rank) if len(length) else (length, length, length)
            kept = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *(pa.array(x, pa.int64()) for x in found)], names=[*kept, "sequence_id", "offset", "padded_to"])

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    schema = PIECES + ", ids binary" * with_ids + ", sequence_id long, offset long, padded_to long"
    return ranked(pieces, sum(histogram.values())).select(*columns, "rank").mapInArrow(put, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """Token sequences: ids padded with the end id, and a document number per position.

    Needs pieces placed ``with_ids``; a group is one sequence, at most its capacity long.
    """

    def join(parts: list, padded: int) -> bytes:
        ids = b"".join(bytes(p["ids"]) for p in sorted(parts, key=lambda p: p["offset"]))
        return ids + np.full(padded - len(ids) // 4, END_ID, dtype="<u4").tobytes()

    gathered = placed.groupBy("sequence_id", "padded_to").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "ids"))).alias("parts"))
    return gathered.select(
        "sequence_id",
        F.udf(join, "binary")("parts", F.col("padded_to").cast("int")).alias("ids"),
        F.transform("parts", lambda p: F.struct(p["offset"].alias("offset"), p["length"].alias("length"), p["doc_id"].alias("doc_id"))).alias("segments"),
    )


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of 1024 tokens; a null text is its end token alone.

    Repeated rows are packed each; which of several equal pieces takes which place is left open.
    """
    return pack_documents(read(spark, sf_dir, "documents"))
