"""Uniform shuffle into shards of exact sizes, in DataFrame functions alone.

The number of rows that each input partition sends to each shard is drawn first: the
communication matrix, whose columns sum to the shards' sizes.  Given such a matrix, a
partition permutes its rows, deals the first of them to shard 0, the next to shard 1 and so
on, and every shard permutes what arrives.  All arrangements are then equally likely.

The matrix is drawn down a tree over the partitions (``FANOUT`` children a node), so no task
handles more than one node: what a node sends to each shard is dealt to its children one
after another, each by univariate hypergeometric draws from what is left.  A draw inverts the
distribution from its mode outwards, with weights by the ratio of neighbouring
probabilities, so no factorials are needed; a window of ``SIGMAS`` standard deviations leaves
out less than a double can tell.

Nothing depends on a task's luck: every draw and every order comes from a hash of the seed
and of places that were written down before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import read, written

SHARDS = 8
FANOUT_BITS = 6  # 64 children
SIGMAS = 9.0
#: Rows that one task permutes within a shard, on average.
PERMUTED_TOGETHER = 20_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def uniform(*seeds: Column) -> Column:
    """A number in [0, 1) of 53 bits, from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*seeds), 11).cast("double") * F.lit(2.0**-53)


def hypergeometric(u: Column, drawn: Column, good: Column, total: Column) -> Column:
    """Of ``drawn`` rows out of ``total``, how many are among the ``good`` ones.

    ``u`` in [0, 1) picks the value.  Values are tried from the mode upwards, then from
    below the mode downwards; each has its exact probability up to rounding.
    """
    n, k, t = (x.cast("double") for x in (drawn, good, total))
    low = F.greatest(F.lit(0).cast("bigint"), drawn + good - total)
    high = F.least(drawn, good)
    mode = F.floor((n + 1) * (k + 1) / (t + 2)).cast("bigint")
    spread = F.sqrt(F.greatest(F.lit(0.0), n * (k / F.greatest(t, F.lit(1.0))) * (1 - k / F.greatest(t, F.lit(1.0))) * (t - n) / F.greatest(t - 1, F.lit(1.0))))
    reach = F.ceil(spread * SIGMAS).cast("bigint") + 30

    def walk(m: Column) -> Column:
        """Sums the weights both ways, then goes the way that ``u`` points."""
        mode, below, above = m["mode"], m["below"], m["above"]
        x = lambda at: at.cast("double")

        def up(at: Column) -> Column:  # p(at + 1) / p(at)
            return (k - x(at)) * (n - x(at)) / ((x(at) + 1) * (t - k - n + x(at) + 1))

        def down(at: Column) -> Column:  # p(at - 1) / p(at)
            return x(at) * (t - k - n + x(at)) / ((k - x(at) + 1) * (n - x(at) + 1))

        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"))
        zero = F.lit(0).cast("bigint")
        ups = F.aggregate(F.sequence(zero, above), start, lambda a, i: F.struct((a["w"] * up(mode + i)).alias("w"), (a["s"] + a["w"]).alias("s")), lambda a: a["s"])
        downs = F.aggregate(F.sequence(zero, below), start, lambda a, i: F.struct((a["w"] * down(mode - i)).alias("w"), (a["s"] + F.when(i > 0, a["w"]).otherwise(0.0)).alias("s")), lambda a: a["s"])

        def find(steps: Column, left: Column, ratio, sign: int, counts_mode: bool) -> Column:
            """The value at which the weights passed exceed ``left``; the last one if rounding leaves none."""
            state = F.struct(F.lit(1.0).alias("w"), left.alias("left"), F.lit(None).cast("bigint").alias("at"))

            def step(a: Column, i: Column) -> Column:
                here = a["w"] if counts_mode else F.when(i > 0, a["w"]).otherwise(0.0)
                value = mode + i * sign
                hit = a["at"].isNull() & (a["left"] < here)
                return F.struct((a["w"] * ratio(value)).alias("w"), F.when(hit, a["left"]).otherwise(a["left"] - here).alias("left"), F.when(hit, value).otherwise(a["at"]).alias("at"))

            return F.aggregate(F.sequence(zero, steps), state, step, lambda a: F.coalesce(a["at"], mode + steps * sign))

        def choose(s: Column) -> Column:
            left = u * (s["ups"] + s["downs"])
            return F.when((left < s["ups"]) | (below == 0), find(above, left, up, 1, True)).otherwise(find(below, left - s["ups"], down, -1, False))

        return let(F.struct(ups.alias("ups"), downs.alias("downs")), choose)

    def bounded(b: Column) -> Column:
        return let(F.struct(b["mode"].alias("mode"), F.least(b["mode"] - b["low"], b["reach"]).alias("below"), F.least(b["high"] - b["mode"], b["reach"]).alias("above")), walk)

    return let(F.struct(F.greatest(low, F.least(high, mode)).alias("mode"), low.alias("low"), high.alias("high"), reach.alias("reach")), bounded)


def dealt_to_children(kids: Column, left: Column, shards: int, seed: int, level: int) -> Column:
    """``array<struct<kid, counts>>``: what the node's shard counts ``left`` give to each child.

    A child takes its rows from what the node has left; shard by shard, each draw is
    conditional on those before it.
    """
    empty = F.array().cast("array<bigint>")

    def child(state: Column, kid: Column) -> Column:
        def shard(s: Column, k: Column) -> Column:
            have = F.element_at(state["left"], k + 1)
            draw = hypergeometric(uniform(F.lit(seed), F.lit(level), kid["kid"], k), s["need"], have, s["pool"])
            return let(draw, lambda x: F.struct((s["need"] - x).alias("need"), (s["pool"] - have).alias("pool"), F.concat(s["counts"], F.array(x)).alias("counts")))

        pool = F.aggregate(state["left"], F.lit(0).cast("bigint"), lambda a, x: a + x)
        first = F.struct(kid["n"].alias("need"), pool.alias("pool"), empty.alias("counts"))
        counts = F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), first, shard, lambda s: s["counts"])
        return let(counts, lambda c: F.struct(F.zip_with(state["left"], c, lambda a, x: a - x).alias("left"), F.concat(state["dealt"], F.array(F.struct(kid["kid"].alias("kid"), c.alias("counts")))).alias("dealt")))

    start = F.struct(left.alias("left"), F.array().cast("array<struct<kid:bigint,counts:array<bigint>>>").alias("dealt"))
    return F.aggregate(kids, start, child, lambda s: s["dealt"])


def shard_sizes(total: int, shards: int) -> list[int]:
    """At most one apart."""
    return [total // shards + (k < total % shards) for k in range(shards)]


def communication_matrix(counts: DataFrame, sizes: list[int], seed: int) -> DataFrame:
    """``part``, ``counts`` (array over shards) from ``counts`` (``part``, ``n``).

    Rows of the matrix sum to ``n``, columns to ``sizes``.
    """
    spark, shards = counts.sparkSession, len(sizes)
    level = [counts.select(F.col("part").cast("bigint").alias("kid"), F.col("n").cast("bigint").alias("n"))]
    nodes = []
    top = counts.agg(F.max("part")).first()[0] or 0
    while not nodes or top > 0:
        kids = F.array_sort(F.collect_list(F.struct("kid", "n")))  # at most FANOUT of them
        nodes.append(level[-1].groupBy(F.shiftright("kid", FANOUT_BITS).alias("node")).agg(kids.alias("kids"), F.sum("n").alias("n")))
        level.append(nodes[-1].select(F.col("node").alias("kid"), "n"))
        top >>= FANOUT_BITS
    got = spark.createDataFrame([(0, sizes)], "node bigint, left array<bigint>")
    for depth in range(len(nodes) - 1, -1, -1):
        dealt = nodes[depth].join(got, "node").select(F.explode(dealt_to_children(F.col("kids"), F.col("left"), shards, seed, depth)).alias("d"))
        got = dealt.select(F.col("d.kid").alias("node"), F.col("d.counts").alias("left"))
    return got.select(F.col("node").alias("part"), F.col("left").alias("counts"))


def shuffle_into_shards(df: DataFrame, shards: int = SHARDS, seed: int = 11, together: int = PERMUTED_TOGETHER) -> DataFrame:
    """All columns of ``df`` and ``shard`` (from 0) and ``slot`` (from 0 in the shard, gapless).

    Shard sizes differ by one at most.  Repeated rows are rows of their own, and where a row
    goes doesn't depend on what it holds, so nulls, ties, long texts and hot values change
    nothing; a table without rows gives none.  Columns of ``df`` named shard or slot are
    replaced.

    The order in a shard is that of a hash of the row's place, taken in ranges of it: one
    task numbers one range, and what lies before a range is a sum of counts.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns if c not in ("shard", "slot")))
    # permuted within its partition; the order is written down, so that it holds from here on
    placed = df.select(row.alias("row"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    mixed = placed.sortWithinPartitions(F.xxhash64(F.lit(seed), "at"), "at")
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = written(mixed.select("row", "part", "at", nth.alias("nth")), "permuted")
    counts = written(rows.groupBy("part").agg(F.count("*").alias("n")), "partition-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    matrix = communication_matrix(counts, shard_sizes(total, shards), seed)
    ends = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda k: F.aggregate(F.slice("counts", F.lit(1), k), F.lit(0).cast("bigint"), lambda a, x: a + x))
    parts = matrix.select("part", ends.alias("ends"))
    shard = F.size(F.filter("ends", lambda e: e <= F.col("nth")))
    ranges = max(1, -(-total // (shards * together)))
    sent = rows.join(parts, "part").select("row", shard.alias("shard"), F.xxhash64(F.lit(seed + 1), "at").alias("key"), "at")
    sent = sent.withColumn("range", F.floor((F.col("key") / F.lit(2.0**64) + 0.5) * ranges).cast("int"))
    arrived = written(sent, "arrived") if ranges > 1 else sent
    local = arrived.withColumn("local", F.row_number().over(Window.partitionBy("shard", "range").orderBy("key", "at")) - 1)
    if ranges > 1:
        before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        sums = arrived.groupBy("shard", "range").agg(F.count("*").alias("n")).select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
        local = local.join(sums, ["shard", "range"])
    else:
        local = local.withColumn("before", F.lit(0))
    return local.select("row.*", "shard", (F.col("local") + F.col("before")).cast("bigint").alias("slot"))


def op11_shards(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` into 8 shards by the law ``rows``.

    A null text has no bytes, so its size is 1 and its crc32 that of an empty text.  The
    text itself isn't moved.
    """
    text = F.coalesce("text", F.lit(""))
    rows = read(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return shuffle_into_shards(rows).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
