"""Shards, alignment and divergence against brute force, SQL and counted distributions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from pathlib import Path

import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_edge_cases import LONG, table
from tokenizers import Tokenizer

from textloom.llm import alignment, divergence, sharding
from textloom.llm.tokens import default_vocabulary

DATA = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


# Shards


def inverse(u: float, n: int, k: int, t: int) -> int:
    """The value that ``hypergeometric`` states, by whole-number arithmetic."""
    low, high = max(0, n + k - t), min(n, k)
    mode = max(low, min(high, (n + 1) * (k + 1) // (t + 2)))
    left = Fraction(u) * math.comb(t, n)
    for x in [*range(mode, high + 1), *range(mode - 1, low - 1, -1)]:
        left -= math.comb(k, x) * math.comb(t - k, n - x)
        if left < 0:
            return x
    raise AssertionError


def test_draws_invert_the_hypergeometric_distribution(spark):
    cases = [(i / 97 + 0.003, n, k, t) for i in range(97) for n, k, t in ((10, 5, 20), (1, 1, 2), (50, 30, 60), (7, 300, 2000), (40, 41, 41), (0, 3, 9), (5, 0, 9), (9, 4, 9), (0, 0, 0), (400, 250, 1000))]
    df = spark.createDataFrame(cases, "u double, n long, k long, t long")
    got = df.select("*", sharding.hypergeometric(*(F.col(c) for c in "unkt")).alias("x")).collect()
    assert len(got) == len(cases)
    assert all(r["x"] == inverse(r["u"], r["n"], r["k"], r["t"]) for r in got)


@pytest.mark.parametrize("sizes", [[5, 5], [3, 3, 2, 2], [1] * 10, [0, 0, 10], [10]])
def test_margins_are_exact(spark, sizes):
    counts = {0: 3, 1: 0, 2: 4, 5: 1, 64: 1, 5000: 1}
    df = spark.createDataFrame(list(counts.items()), "part int, n long")
    for seed in (len(sizes),):
        got = {r["part"]: r["counts"] for r in sharding.communication_matrix(df, sizes, seed).collect()}
        assert {p: sum(c) for p, c in got.items()} == counts
        assert [sum(c) for c in zip(*got.values(), strict=True)] == sizes


def test_all_matrices_come_up_as_often_as_they_should(spark):
    """Two partitions of 3 and 4 rows into shards of 4 and 3, over many seeds."""
    n, seeds = Counter(), 400
    kids = F.array(F.struct(F.lit(0).cast("long").alias("kid"), F.lit(3).cast("long").alias("n")), F.struct(F.lit(1).cast("long").alias("kid"), F.lit(4).cast("long").alias("n")))
    left = F.array(F.lit(4).cast("long"), F.lit(3).cast("long"))
    made = spark.range(seeds).select(sharding.dealt_to_children(kids, left, 2, F.col("id"), 0)[0]["counts"][0].alias("x"))
    n.update(r["x"] for r in made.collect())
    expected = {x: math.comb(4, x) * math.comb(3, 3 - x) / math.comb(7, 3) * seeds for x in range(4)}
    assert sum((n[x] - e) ** 2 / e for x, e in expected.items()) < 16.3  # 0.999 of chi-square with 3 degrees


@pytest.mark.parametrize("together", [3, 20_000])
def test_shards_are_exact_and_gapless(spark, together):
    docs = documents(spark).repartition(7).select("doc_id")
    got = sharding.shuffle_into_shards(docs.unionByName(docs.limit(21)), 4, together=together).collect()
    assert Counter(r["doc_id"] for r in got) == Counter([r["doc_id"] for r in docs.collect()] + [r["doc_id"] for r in docs.limit(21).collect()])
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert sorted(map(len, by.values())) == [55, 55, 55, 56]
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_every_row_comes_to_every_place_as_often(spark):
    """Copies of one row, which no hash of contents could part; places by their origin."""
    rows = spark.range(0, 40, 1, 4).select(F.col("id").alias("was"), F.lit("same").alias("text"))
    shard, first = Counter(), Counter()
    for seed in range(12):
        for r in sharding.shuffle_into_shards(rows, 4, seed, together=5).collect():
            shard[r["was"] // 10, r["shard"]] += 1
            first[r["was"] // 10] += r["slot"] < 5
    assert all(abs(n - 30) < 22 for n in shard.values()) and len(shard) == 16
    assert all(abs(n - 60) < 30 for n in first.values())


def test_shards_of_odd_tables(spark):
    docs = table(spark, clash=True).withColumn("shard", F.lit("x")).withColumn("slot", F.lit("y"))
    got = sharding.shuffle_into_shards(docs, 3).collect()
    assert len(got) == docs.count() and sorted(Counter(r["shard"] for r in got).values()) == [3, 3, 4]
    assert all(r["rank"] == "x" for r in got) and sum(r["text"] is None for r in got) == 1
    assert sharding.shuffle_into_shards(table(spark, []), 3).collect() == []
    assert [r["slot"] for r in sharding.shuffle_into_shards(spark.range(1), 8).collect()] == [0]


def test_shards_query(spark):
    got = sharding.op11_shards(spark, DATA).collect()
    texts = {r["doc_id"]: r["text"] for r in documents(spark).collect()}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got} == {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts.items()}
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}


# Alignment


def brute_alignment(texts: dict) -> dict:
    """Token by token, with the tokenizers themselves and sets of ends."""
    own = Tokenizer.from_file(default_vocabulary())
    own.encode_special_tokens = True
    from textloom.llm.tokens import byte_alphabet

    alphabet, pieces = byte_alphabet(), sentencepiece.SentencePieceProcessor(model_file=alignment.default_pieces())
    sides = {}
    for key, text in texts.items():
        sides[key] = ([], [])
        if text:
            a = [(i, bytes(alphabet[c] for c in own.id_to_token(i))) for i in own.encode(f" {text}", add_special_tokens=False).ids]
            named = [(i, pieces.id_to_piece(i)) for i in pieces.encode(text)]
            b = [(i, bytes.fromhex(p[3:5]) if re.fullmatch("<0x[0-9A-F]{2}>", p) and pieces.is_byte(i) else p.replace("▁", " ").encode()) for i, p in named]
            if b"".join(x for _, x in a) == b"".join(x for _, x in b) == f" {text}".encode():
                sides[key] = (a, b)
    out, links = {}, {}
    for key, (a, b) in sides.items():
        ends = []
        for side in (a, b):
            at, here = 0, {}
            for n, (_, x) in enumerate(side):
                at += len(x)
                here[at] = n
            ends.append(here)
        shared = sorted(set(ends[0]) & set(ends[1]))
        links[key] = [(a[ends[0][e]][0], b[ends[1][e]][0]) for e in shared]
        groups, last = [], (0, 0)
        for e in shared:
            now = (ends[0][e] + 1, ends[1][e] + 1)
            groups.append(",".join(str(i) for i, _ in a[last[0] : now[0]]) + "|" + ",".join(str(i) for i, _ in b[last[1] : now[1]]))
            last = now
        out[key] = (len(a), len(b), len(groups), ";".join(groups))
    counts = Counter(x for found in links.values() for x in found)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return {k: (*v, len(links[k]), sum(counts[x] == most[x[1]] for x in links[k]), sum(counts[x] for x in links[k])) for k, v in out.items()}


ODD = {
    -1: None, -2: "", -3: " ", -4: "a  b", -5: " lead", -6: "tail ", -7: "▁x y", -8: "x▁ y", -9: "漢字 😀 ok", -10: "<s> </s> <unk> <|endoftext|>", -11: "a\tb\n\nc d", -12: "é ﬁ Å",
    -13: "<0x41> A", -14: "nul\x00 x", -15: "it's we'll 12345 !!", -16: "a　b c", -17: "\nstart", -18: "word", -19: "word", -20: LONG[:60_000],
}


@pytest.mark.parametrize("block_links", [50, alignment.BLOCK_LINKS])
def test_alignment_is_that_of_brute_force(spark, block_links):
    texts = {r["doc_id"]: r["text"] for r in documents(spark).collect()} | ODD
    want = brute_alignment(texts)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in alignment.align(docs, block_links=block_links).collect()}
    assert {k: (r["n_a"], r["n_b"], r["n_groups"], r["groups"], r["n_links"], r["n_best"], r["count_sum"]) for k, r in got.items()} == want
    assert all(r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["n_a"] else "") for r in got.values())
    assert sum(w[0] == 0 for w in want.values()) == 2 + sum("▁" in (t or "") for t in ODD.values())
    products = lambda g: sum(len(a.split(",")) * len(b.split(",")) for a, b in (x.split("|") for x in g.split(";")))
    assert all(r["n_products"] == products(r["groups"]) and r["n_overlaps"] == r["n_a"] + r["n_b"] - r["n_groups"] for r in got.values() if r["n_a"])


def test_alignment_query(spark):
    want = brute_alignment({r["doc_id"]: r["text"] for r in documents(spark).collect()})
    names = ("n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum")
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in alignment.op12_alignment(spark, DATA).collect()}
    assert got == {k: (*w[:3], hashlib.sha256(w[3].encode()).hexdigest() if w[0] else "", *w[4:]) for k, w in want.items()}


def test_alignment_of_odd_tables(spark):
    rows = alignment.align(table(spark, clash=True).withColumn("links", F.lit(1)).withColumn("block", F.lit(2))).collect()
    assert len(rows) == 10 and sum(r["n_a"] == 0 for r in rows) == 2
    twice = [r for r in rows if r["doc_id"] == 2]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert alignment.align(table(spark, [])).collect() == []
    assert [r["count_sum"] for r in alignment.align(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()] == [0]


# Divergence


def brute_divergence(rows: list, least: int, ranks: int) -> set:
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs = [(lang or "", source or "", [t.translate(lower) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for lang, source, text in rows]
    out = set()
    for lang in {x[0] for x in docs}:
        own = [x for x in docs if x[0] == lang]
        held = Counter(t for _, _, terms in own for t in set(terms))
        kept = sorted(t for t, n in held.items() if n >= least)
        counts = {s: Counter(t for _, source, terms in own if source == s for t in terms) for s in {x[1] for x in own}}
        whole = sum(counts.values(), Counter())
        rate = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[k] for k in kept) + 5 * len(kept)) for t in kept}
        p, q = {s: rate(c) for s, c in counts.items()}, rate(whole)
        for s in p:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in p if o != s)
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t])[:ranks]
            out |= {(lang, s, part, item.decode(), -v, i + 1) for part, found in (("pair", pairs), ("term", terms)) for i, (v, item) in enumerate(found)}
    return out


MIXED = [
    ("en", "a", "Zebra zebra apple Ünïİ apple"), ("en", "b", "zebra 1apple2 ünïİ"), ("en", "a", "apple"), ("en", None, None), ("en", "", "zebra"), (None, None, "x y"), ("", "s", "x X"), ("fr", "only", "mot"),
    ("de", "a", "😀 aé ÿ"), ("de", "b", "aé 😀  x"), ("de", "c", "x  😀"), ("en", "b", "tie tie tie zebra"), ("en", "c", "eit eit tie"), ("en", "a", "apple"), ("en", "a", "apple"),
]


@pytest.mark.parametrize(("least", "ranks", "chunk_rows", "tile_cells"), [(1, 50, 1, 1), (1, 2, 5, 4), (2, 50, 3, 2_000_000), (3, 1, 500_000, 6), (30, 50, 500_000, 2_000_000)])
def test_divergence_is_that_of_brute_force(spark, least, ranks, chunk_rows, tile_cells):
    docs = spark.createDataFrame(MIXED, "lang string, source string, text string").withColumn("rank", F.lit("x")).withColumn("term", F.lit(1)).repartition(3)
    got = divergence.divergence(docs, least, ranks, chunk_rows, tile_cells).collect()
    assert len(got) == len(set(got)) and set(map(tuple, got)) == brute_divergence(MIXED, least, ranks)


def test_divergence_of_documents(spark):
    docs = documents(spark).select("lang", "source", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert set(map(tuple, divergence.divergence(docs, 4, chunk_rows=300, tile_cells=64).collect())) == brute_divergence(rows, 4, 50)


def test_divergence_of_odd_tables(spark):
    docs = table(spark, clash=True)
    rows = [tuple(r) for r in docs.select("lang", "source", "text").collect()]
    assert set(map(tuple, divergence.divergence(docs, 1).collect())) == brute_divergence(rows, 1, 50)
    assert divergence.divergence(table(spark, [])).collect() == []


def test_rates_are_exact_for_large_counts():
    import numpy as np

    counts = np.array([0, 1, 9_876_543_210, 4 * 10**14], dtype=np.int64)
    total = 5 * 10**14
    assert divergence.rates(counts, total, 3).tolist() == [1 + 10**9 * (c + 5) // (total + 15) for c in counts.tolist()]


def test_long_texts_are_cut_between_terms():
    text = ("é" * 3 + " Ab1") * 400_000
    assert sum(len(x) for x in divergence.terms_of(text.encode())) == 800_000
    assert {t for x in divergence.terms_of(text.encode()) for t in x} == {"é".encode() * 3, b"ab"}


def test_sql_is_there():
    assert "op13_divergence" in __import__("textloom.llm.queries", fromlist=["x"]).ORACLES and Path(DATA).exists()
