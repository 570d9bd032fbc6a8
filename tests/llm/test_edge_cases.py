"""Nulls, empty and long texts, ties and repeated rows, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

from textloom.llm import chat, decontaminate, langid, line_dedup, minhash, packing, quality, secrets, suffix_tree, toxicity

LONG = " ".join(f"word{i % 997} and{i % 13}" for i in range(30_000)) + "\n" + "x" * 200_000
WORDS = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, WORDS, "en", "a"), (2, WORDS + " tail", "en", "a"), (2, WORDS + " tail", "en", "a"), (3, None, None, None), (4, "", "fr", "b"), (5, " \n\t\n ", "fr", "b"),
    (6, LONG, "en", "b"), (7, "Ünïcode 漢字 \U0001d4d0 ok", "fr", ""), (None, "no id " + WORDS, "en", "a"), (8, "\x00\x1c nul \x85", None, "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that the operators use inside.
CLASHING = ("score", "hit", "blob", "path", "spans", "node", "component", "band", "rank", "salt", "row_id", "host", "kept", "n_lines", "gone_id", "toxic_id", "hit_id", "text_id", "words", "n")


def table(spark, rows=ROWS, clash=False):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *(F.lit("x").alias(c) for c in CLASHING)) if clash else df


def labels(spark, rows=((1, 1), (2, 0), (3, None), (9, 1), (None, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, toxic int")


def benchmark(spark, rows=((1, " ".join(f"w{i}" for i in range(12))), (2, None), (3, ""), (4, "nul"), (None, "ok"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "secrets": lambda s, d: secrets.findings(v := d.select(F.col("doc_id").alias("path"), F.lit(1).alias("version"), "text"), secrets.ledger_entries(v)),
    "decontaminate": lambda s, d: decontaminate.contamination(d, benchmark(s)),
    "toxicity": lambda s, d: toxicity.toxicity(d, labels(s)),
    "lines": lambda s, d: line_dedup.dedup_lines(d),
    "packing": lambda s, d: packing.pack_documents(d),
    "minhash": lambda s, d: minhash.near_duplicates(d),
    "language": lambda s, d: langid.language(d),
    "suffix_tree": lambda s, d: suffix_tree.language_model_scores(d),
    "quality": lambda s, d: quality.quality(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_rows_and_clashing_columns(spark, name):
    rows = OPERATORS[name](spark, table(spark, clash=True)).collect()
    if name == "packing":
        assert sum(r["start"] == 0 for r in rows) == len(ROWS)
    else:
        assert len(rows) == len(ROWS)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_no_rows(spark, name):
    assert OPERATORS[name](spark, table(spark, [])).collect() == []


STAGES = {"toxicity": toxicity.clean_only, "lines": line_dedup.first_lines, "near": minhash.one_of_each, "decontaminate": decontaminate.uncontaminated}
KEPT = {"toxicity": {1, 2, 3, 4, 5, 6, 7, 8, None}, "lines": {1, 2, 3, 4, 5, 6, 7, 8, None}, "near": {1, 3, 4, 5, 6, 7, 8, None}, "decontaminate": {3, 4, 5, 6, 7}}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    labels(spark, ((1, 0), (2, 0))).write.parquet(f"{d}/labels.parquet")
    benchmark(spark).where("item_id IS NOT NULL").write.parquet(f"{d}/benchmark.parquet")
    return d


@pytest.mark.parametrize("name", sorted(STAGES))
def test_stages_on_odd_tables(spark, folder, name):
    """Nulls, repeated rows, clashing columns and no rows at all."""
    docs = table(spark, clash=True)
    after = STAGES[name](spark, docs, folder)
    assert after.columns == docs.columns
    rows = after.collect()
    assert {r["doc_id"] for r in rows} == KEPT[name]
    assert all(r[c] == "x" for r in rows for c in CLASHING)
    if name != "lines":
        assert all(r["text"] in {x[1] for x in ROWS} for r in rows)
    assert STAGES[name](spark, table(spark, [], clash=True), folder).collect() == []


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_minhash_results(spark):
    got = by_id(minhash.near_duplicates(table(spark), words=2))
    assert {i: r["component_id"] for i, r in got.items()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, None: None, 8: 8}
    assert got[3]["n_shingles"] == 0 and got[None]["kept"] and not got[2]["kept"]


def test_one_word_documents_link(spark):
    rows = [(i, t, None, None) for i, t in ((1, "Word"), (2, " word\n"), (3, "other"))]
    assert {i: r["component_id"] for i, r in by_id(minhash.near_duplicates(table(spark, rows))).items()} == {1: 1, 2: 1, 3: 3}


def test_quality_results(spark):
    got = by_id(quality.quality(table(spark)))
    assert got[3]["n_words"] == 0 and got[3]["base_failed"] and not got[1]["base_failed"]
    assert got[5]["n_dup_lines"] == 0


def test_decontaminate_results(spark):
    got = by_id(decontaminate.contamination(table(spark), benchmark(spark)))
    assert list(got[1]["hit"]) == list(range(12)) and got[1]["item_ids"] == [1]
    text = WORDS
    assert text[got[1]["spans"][0]["start"] : got[1]["spans"][0]["end"]] == " ".join(f"w{i}" for i in range(12))
    assert got[8]["item_ids"] == [4] and got[7]["item_ids"] == []


def test_decontaminate_in_blocks(spark):
    whole = by_id(decontaminate.contamination(table(spark), benchmark(spark)))
    blocks = by_id(decontaminate.contamination(table(spark), benchmark(spark), block_windows=2))
    assert {i: (r["hit"], r["item_ids"], r["spans"]) for i, r in whole.items()} == {i: (r["hit"], r["item_ids"], r["spans"]) for i, r in blocks.items()}


def test_language_of_letterless_texts(spark):
    got = by_id(langid.language(table(spark)))
    assert [got[i]["lang_pred"] for i in (3, 4, 5)] == ["und"] * 3 and got[7]["lang_pred"] in ("en", "fr")


def test_chat_rows(spark):
    turns = [(1, 2, "assistant", "b"), (1, 1, "user", None), (1, 1, "user", None), (2, None, None, "\\### x </turn>\n"), (None, 1, "assistant", LONG), (3, 1, "a:\n###", "\\")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(1)).withColumn("loss", F.lit(1))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert {i: r["n_turns"] for i, r in got.items()} == {1: 3, 2: 1, None: 1, 3: 1}
    assert got[None]["loss_chars"] == len(LONG)
    assert chat.read_back(chat.format_conversations(df.limit(0))).collect() == []


def test_pack_stage_on_odd_tables(spark, folder):
    """Ids of each document, read back from its pieces; repeated rows are packed each."""
    import corpus_pipeline
    import numpy as np

    from textloom.llm.tokens import default_vocabulary, encoder

    rows = corpus_pipeline.pack(spark, table(spark, clash=True), folder).collect()
    bpe = encoder(default_vocabulary())
    texts = [(i, t or "") for i, t, _, _ in ROWS]
    pieces = {}
    for r in rows:
        pieces.setdefault((r["doc_id"], r["start"]), []).append(r["ids"])
    for key, text in set(texts):
        whole = np.append(np.frombuffer(bpe.encode(text), dtype="<u4"), np.uint32(0)).astype("<u4")
        for start in range(0, len(whole), 1024):
            assert [bytes(x) for x in pieces.pop((key, start))] == [whole[start : start + 1024].tobytes()] * texts.count((key, text))
    assert not pieces
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in by_sequence.values():
        ends = [0, *(o + n for o, n in sorted(placed))]
        assert [o for o, _ in sorted(placed)] == ends[:-1] and ends[-1] <= 1024
    assert corpus_pipeline.pack(spark, table(spark, [], clash=True), folder).collect() == []


def test_suffix_tree_results(spark):
    got = by_id(suffix_tree.language_model_scores(table(spark, clash=True)))
    assert got[3]["n_tokens"] == got[4]["n_tokens"] == got[5]["n_tokens"] == 1
    assert got[3]["base_score"] == got[4]["base_score"] == got[5]["base_score"] < 0
    assert got[1]["n_tokens"] == 61 and got[2]["n_tokens"] == 62 and len({r["train_tokens"] for r in got.values()}) == 1
    twice = [r for r in suffix_tree.language_model_scores(table(spark)).collect() if r["doc_id"] == 2]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_many_matches_take_time_in_proportion(spark):
    import time

    def seconds(n):
        text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("token=abcdefgh"), i.cast("string"))), " ")
        df = spark.range(1).select(F.size(secrets.rule_spans(text, secrets.RULES[0], 0)).alias("n"))
        began = time.perf_counter()
        assert df.first()["n"] == n
        return time.perf_counter() - began

    seconds(1_000)
    small, large = seconds(8_000), seconds(32_000)
    assert large < 6 * small + 2
