"""The pipeline's near-duplicate stage goes by shingles of five words."""

import random
from itertools import combinations

import brute

from textloom.llm import minhash


def shingles(text, k=5):
    w = brute.words(text, r"[^\x20\x09-\x0D]+")
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_stage_goes_by_five_words(spark):
    rng = random.Random(5)
    docs = []
    for i in range(20):
        base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        # every 25th word changed: similarity 0.85 of pairs of words, 0.67 of five words
        docs += [(3 * i, " ".join(base)), (3 * i + 1, " ".join("x" if k % 25 == 12 else w for k, w in enumerate(base))), (3 * i + 2, " ".join([*base, "tail"]))]
    sets = {i: shingles(t) for i, t in docs}
    links = [(a, b) for a, b in combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    top = brute.groups(list(sets), links)
    got = {r["doc_id"] for r in minhash.one_of_each(spark, spark.createDataFrame(docs, "doc_id long, text string"), "").collect()}
    assert got == {i for i in sets if top[i] == i}
    assert len(got) == 40
