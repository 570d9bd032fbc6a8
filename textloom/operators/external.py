"""Calls of outside functions on chunks, with status as columns instead of text.

A call is remembered by its stage and the content given to it, so neither a task that is run
again nor a later run of the job calls twice for what is done, and the tries of what keeps
failing add up across runs.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import astuple, dataclass

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.shipping import ship
from textloom.sources.store import TASKS, located

RESULT = "result string, error string, attempts int, elapsed double"
RESULT_COLUMNS = [c.split()[0] for c in RESULT.split(", ")]
#: Tries and seconds of the first wait of a draft or review; fixed values.
DRAFT_TRIES, DRAFT_WAIT = 5, 60.0
#: Digits of a content's hash that name its bucket, and the column that holds them meanwhile.
BUCKET_DIGITS, BUCKET = 3, "__bucket"
#: Seconds after which a memo's file is closed.
OPEN_SECONDS = 1.0


@dataclass
class Outcome:
    result: str | None = None
    error: str | None = None
    attempts: int = 0
    elapsed: float = 0.0


class Memo:
    """Outcomes of one stage in a shared folder.

    Contents are dealt to buckets by the first digits of their hash, a folder each.  Every try is appended to a
    file of the memo's own as soon as it has ended, a line each; a file is closed at the end
    of its bucket, or after the first try that ends when it is ``OPEN_SECONDS`` old, for stores
    that show what is written only then.  All files of a bucket are read when its first
    content comes, so contents should come by bucket.
    """

    def __init__(self, folder: str, stage: str):
        self.folder, self.stage = folder, stage
        self.bucket: str | None = None
        self.known: dict[str, Outcome] = {}
        self.out = None
        self.opened = 0.0

    def _turn_to(self, bucket: str) -> str:
        """The bucket's folder, whose outcomes are ``known`` now."""
        fs, root = located(self.folder)
        at = f"{root}/{self.stage}/{bucket}"
        if bucket != self.bucket:
            self.close()
            self.bucket, self.known = bucket, {}
            for info in fs.get_file_info(arrow_fs.FileSelector(at, allow_not_found=True)):
                with fs.open_input_stream(info.path) as f:
                    # what follows the last line's end was broken off
                    for line in f.read().split(b"\n")[:-1]:
                        self._note(*json.loads(line))
        return at

    def _note(self, digest: str, *outcome) -> None:
        made, before = Outcome(*outcome), self.known.get(digest, Outcome())
        if (made.result is not None, made.attempts) > (before.result is not None, before.attempts):
            self.known[digest] = made

    def get(self, content: str) -> Outcome:
        digest = _digest(content)
        self._turn_to(digest[:BUCKET_DIGITS])
        return self.known.get(digest, Outcome())

    def put(self, content: str, outcome: Outcome) -> None:
        digest = _digest(content)
        at = self._turn_to(digest[:BUCKET_DIGITS])
        if self.out is None:
            fs, _ = located(self.folder)
            fs.create_dir(at, recursive=True)
            self.out, self.opened = fs.open_output_stream(f"{at}/{uuid.uuid4().hex}.jsonl"), time.monotonic()
        self.out.write(json.dumps([digest, *astuple(outcome)]).encode() + b"\n")
        self.out.flush()
        self._note(digest, *astuple(outcome))
        if time.monotonic() - self.opened >= OPEN_SECONDS:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _digest(content: str) -> str:
    return hashlib.sha256(content.encode()).hexdigest()


def by_bucket(chunks: DataFrame, text: str) -> DataFrame:
    """``chunks`` dealt and sorted by the memo's buckets, so that a content has one task, and a
    bucket is read once; rows without text stay spread as they came."""
    tasks = max(TASKS * chunks.sparkSession.sparkContext.defaultParallelism, int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bucket = F.coalesce(F.substring(F.sha2(F.col(f"`{text}`"), 256), 1, BUCKET_DIGITS), F.spark_partition_id().cast("string"))
    return chunks.withColumn(BUCKET, bucket).repartition(tasks, BUCKET).sortWithinPartitions(BUCKET).drop(BUCKET)


def called(fn: Callable[[str], str], content: str, tries: int, wait: Callable[[int], float], memo: Memo | None) -> Outcome:
    """The outcome of up to ``tries`` calls in all, those that the memo knows included.

    ``wait`` gives the seconds after the n-th failed try.  A timeout is not tried again.
    """
    known = memo.get(content) if memo else Outcome()
    while known.result is None and known.attempts < tries:
        began = time.monotonic()
        try:
            known = Outcome(fn(content), None, known.attempts + 1, known.elapsed + time.monotonic() - began)
        except Exception as e:  # noqa: BLE001  any failure of the outside function is a result
            attempts = tries if isinstance(e, TimeoutError) else known.attempts + 1
            known = Outcome(None, str(e), attempts, known.elapsed + time.monotonic() - began)
        if memo:
            memo.put(content, known)
        if known.result is None and known.attempts < tries:
            time.sleep(wait(known.attempts))
    return known


def transform_chunks(chunks: DataFrame, text: str, fn: Callable[[str], str], tries: int = 2, wait: float = 0.0, backoff: Callable[[int], float] | None = None, memo: str | None = None, stage: str = "call") -> DataFrame:
    """Each row with ``RESULT``; a row whose calls all failed has the last error, a null text no call.

    ``memo`` names a shared folder of outcomes; without it, a task that is run again calls
    ``fn`` again.
    """
    pause = backoff or (lambda n: wait)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Memo(memo, stage) if memo else None
        try:
            for batch in batches:
                made = [Outcome(error="no text") if value is None else called(fn, value, tries, pause, known) for value in batch[text]]
                columns = {c: pd.Series([getattr(o, c) for o in made], dtype=object if c in ("result", "error") else None) for c in RESULT_COLUMNS}
                yield batch.reset_index(drop=True).assign(**columns).astype({"attempts": "int32", "elapsed": "float64"})
        finally:
            if known:
                known.close()

    ship(chunks.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chunks.schema)
    return (by_bucket(chunks, text) if memo else chunks).mapInPandas(run, f"{schema}, {RESULT}")


#: What a call in JSON form answers with.
REPLY = "result string, session_id string"


def parsed_reply(answer: Column) -> Column:
    """``struct<result, session_id, error>`` of a JSON answer.

    No answer, what isn't JSON, and an empty result are errors, without a result.
    """
    reply = F.from_json(answer, REPLY)
    text = F.nullif(reply["result"], F.lit(""))
    error = F.when(F.coalesce(answer, F.lit("")) == "", "no output").when(F.coalesce(reply["result"], reply["session_id"]).isNull(), "not an answer").when(text.isNull(), "empty result")
    return F.struct(text.alias("result"), reply["session_id"].alias("session_id"), error.alias("error"))


def growing(first: float = DRAFT_WAIT) -> Callable[[int], float]:
    """The n-th wait is n times the first."""
    return lambda n: first * n


def draft_and_review(chunks: DataFrame, text: str, draft: Callable[[str], str], review: Callable[[str], str], tries: int = DRAFT_TRIES, backoff: Callable[[int], float] | None = None, memo: str | None = None) -> DataFrame:
    """``draft``, ``final`` and of both stages the error and the tries.

    Waits are none unless ``backoff`` gives them, as ``growing()`` does.  ``final``: the review, or the draft where the review failed.  A row whose draft failed
    stays, without either.
    """
    named = lambda df, stage, result: df.select(*[c for c in df.columns if c not in RESULT_COLUMNS], F.col("result").alias(result), F.col("error").alias(f"{stage}_error"), F.col("attempts").alias(f"{stage}_tries"))
    drafted = named(transform_chunks(chunks, text, draft, tries, backoff=backoff, memo=memo, stage="draft"), "draft", "draft")
    reviewed = named(transform_chunks(drafted, "draft", review, tries, backoff=backoff, memo=memo, stage="review"), "review", "reviewed")
    lost = F.col("draft").isNull()
    return reviewed.withColumn("final", F.coalesce("reviewed", "draft")).withColumn("review_error", F.when(~lost, F.col("review_error"))).drop("reviewed")


def reviewed_texts(results: DataFrame, key: str, order: str, separator: str = "\n\n", more: Iterable[Column] = ()) -> DataFrame:
    """``text``, ``parts``, ``failed`` of each key, and ``more`` aggregates: what has a final text, in order; keys without any have no row."""
    parts = F.sort_array(F.collect_list(F.when(F.col("final").isNotNull(), F.struct(F.col(order).alias("o"), F.col("final").alias("t")))))
    joined = results.groupBy(key).agg(F.array_join(F.transform(parts, lambda p: p["t"]), separator).alias("text"), F.count("final").alias("parts"), F.count_if(F.col("final").isNull()).alias("failed"), *more)
    return joined.where("parts > 0")
