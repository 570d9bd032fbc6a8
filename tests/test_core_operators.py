"""Operators against plain versions and hand-made rows."""

import re

from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import catalog, chunking, external, glossary, segments
from textloom.sources import files, markup
from textloom.streaming.incremental import drain, succeeded


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "text string").select(column.alias("x")).first()["x"]


def plain_two_level(text, cap):
    chunks, current, n = [], [], 0
    for p in text.split("\n"):
        if len(p) > cap:
            if current:
                chunks.append("\n".join(current))
            current, n = [], 0
            own, k = [], 0
            for s in re.split(r"(?<=[.!?] )", p):
                if own and k + len(s) > cap:
                    chunks.append("".join(own))
                    own, k = [], 0
                own.append(s)
                k += len(s)
            chunks.append("".join(own))
        else:
            if current and n + len(p) > cap:
                chunks.append("\n".join(current))
                current, n = [], 0
            current.append(p)
            n += len(p)
    return [*chunks, "\n".join(current)] if current else chunks


def test_two_level_chunks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    made = docs.select("text", F.transform(chunking.two_level(F.col("text"), F.length, 300, "\n", r"(?<=[.!?] )", "\n"), lambda c: c["text"]).alias("c")).collect()
    assert all(r["c"] == plain_two_level(r["text"], 300) for r in made)


def test_greedy_keeps_large_and_empty_items(spark):
    chunks = one(spark, "aaaa||b", chunking.greedy(F.split("text", r"\|", -1), F.length, 3, "+"))
    assert [(c["text"], c["n"], c["items"]) for c in chunks] == [("aaaa", 4, 1), ("+b", 1, 2)]


def test_sentences_keep_an_empty_rest(spark):
    assert one(spark, "甲。乙！", T.sentences(F.col("text"))) == ["甲。", "乙！", ""]


def test_paragraph_runs(spark):
    assert one(spark, "a\n\n\n\nb", T.paragraphs(F.col("text"))) == ["a", "", "b"]


def test_space_and_trim(spark):
    assert one(spark, "　甲 乙\n", T.without_space(F.col("text"))) == "甲乙"
    assert one(spark, "　甲 ", T.strip(F.col("text"))) == "甲"


def test_annotations_stay(spark):
    assert one(spark, "a{引}甲b", T.preserve(F.col("text"), annotations=True)) == "{引}甲"


def test_code_points(spark):
    assert [one(spark, t, T.code_point(F.col("text"))) for t in ("U+4E00", "U+XY", "")] == [0x4E00, None, None]


def test_term_key(spark):
    assert one(spark, "Vowss", T.term_key(F.col("text"))) == "vow"


def test_rows_before_the_first_start(spark):
    rows = spark.createDataFrame([("t", 1), ("t", 5), ("u", 1)], "k string, o int")
    starts = spark.createDataFrame([("t", 3, "a"), ("t", 5, "b")], "k string, o int, v string")
    got = {(r["k"], r["o"]): r["v"] for r in segments.as_of(rows, starts, "k", "o", "v").collect()}
    assert got == {("t", 1): "a", ("t", 5): "b", ("u", 1): None}


def test_start_without_hit_keeps_all(spark):
    work = spark.createDataFrame([("a", 1), ("b", 2)], "k string, pos int")
    assert catalog.from_start(work, "k", "z", "pos").count() == 2
    assert [r["k"] for r in catalog.from_start(work, "k", "b", "pos").collect()] == ["b"]


def test_rate_without_time(spark):
    assert spark.range(1).select(catalog.hourly_rate(F.lit(5), F.lit(0.0)).alias("r")).first()["r"] == 0


def test_failures_are_recorded(spark):
    def fn(x):
        if x == "bad":
            raise ValueError("no")
        return x.upper()

    rows = spark.createDataFrame([("a",), ("bad",)], "t string")
    got = {r["t"]: (r["result"], r["error"], r["attempts"]) for r in external.transform_chunks(rows, "t", fn, tries=3).collect()}
    assert got == {"a": ("A", None, 1), "bad": (None, "no", 3)}


def test_failed_review_keeps_the_draft(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "t string")

    def review(x):
        if x == "B":
            raise ValueError
        return x + "!"

    assert {r["final"] for r in external.draft_and_review(rows, "t", lambda x: x.upper(), review).collect()} == {"A!", "B"}


def test_spoken_notes_stay_in_spells(spark):
    xml = '<t><p type="dharani">a<note place="inline">二合、引</note><note place="inline">3</note>b</p></t>'
    rows = markup.xml_blocks(spark.createDataFrame([("p", xml)], "path string, xml string")).collect()
    assert [(r["type"], r["text"]) for r in rows] == [("dharani", "a{二合}{引}b")]


def test_catalogue_page(spark):
    html = 'x data-n=\\"2185_56\\">T2185 title a</span> data-n=\\"1_2\\">T0001 b</span>'
    got = one(spark, html, markup.catalogue_entries(F.col("text")))
    assert [(e["web_id"], e["volume"], e["t_number"], e["title"]) for e in got] == [("2185", 56, "T2185", "title a"), ("1", 2, "T0001", "b")]


def test_files_by_key(spark, tmp_path):
    for name, text in (("T0001.txt", "one"), ("T0001a.txt", "two"), ("x.md", "no")):
        (tmp_path / name).write_text(text)
    got = {r["key"]: r["text"] for r in files.texts(spark, str(tmp_path), r"(T\d+)[ab]?\.txt").collect()}
    assert got == {"T0001": "two"}
    assert files.listing(spark, str(tmp_path)).count() == 3


def test_incremental_run_reads_each_file_once(spark, tmp_path):
    source, sink, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    rows = lambda *ids: spark.createDataFrame([(i, "succeeded" if i != "c" else "errored") for i in ids], "custom_id string, type string")
    rows("a", "c").write.parquet(source)
    schema = rows("a").schema
    drain(spark, source, schema, sink, check, lambda df: df.where("type = 'succeeded'")).awaitTermination()
    rows("b").write.mode("append").parquet(source)
    drain(spark, source, schema, sink, check, lambda df: df.where("type = 'succeeded'")).awaitTermination()
    assert sorted(r["custom_id"] for r in spark.read.parquet(sink).collect()) == ["a", "b"]
    assert succeeded(rows("a", "a", "c")).count() == 1


def test_category_precedence(spark):
    for text, want in (("A monk of the city", "person"), ("a heavenly abode", "place"), ("the age of x", "cosmological"), ("x", "doctrinal"), ("realm of rebirth", "place")):
        assert one(spark, text, glossary.classify(F.col("text"))) == want


def test_sinks_and_lookups(spark, tmp_path):
    df = spark.createDataFrame([("T1", "Heart", None, "a\nb"), ("T2", None, "x", "")], "key string, title string, author string, text string")
    files.write_titled(df, str(tmp_path / "titled"), "key", [F.concat(F.lit("# "), "title"), F.concat(F.lit("Author: "), "author")], "text")
    back = {r["key"]: r["value"] for r in spark.read.text(str(tmp_path / "titled"), wholetext=True).collect()}
    assert back == {"T1": "# Heart\n\na\nb\n", "T2": "Author: x\n\n\n"}
    files.write_catalogue(df, str(tmp_path / "catalogue"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "catalogue")).collect())[1] == '{"key":"T2","title":null,"author":"x","text":""}'
    found, missing = catalog.looked_up(df.select("key"), df.where("title IS NOT NULL").select("key", "title"), "key")
    assert [tuple(r) for r in found.collect()] == [("T1", "Heart")] and [r["key"] for r in missing.collect()] == ["T2"]
    assert catalog.at_most(df, "key", 0).count() == 2 == catalog.at_most(df, "key", None).count()


def test_rewrites_are_dealt_to_all_cores(spark):
    from textloom.operators import rewrite
    from textloom.plans import runs

    one = spark.createDataFrame([(str(i), "a sutra, xsutra (sutra) Dogen" if i else None) for i in range(40)], "key string, text string").coalesce(1)
    cleaned = runs.cleanup_run(one)  # a file that compresses well is one partition
    assert cleaned.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    got = {(r["text"], r["n"]) for r in one.select(rewrite.whole_words(F.col("text"), rewrite.MARKS).alias("r")).select("r.*").collect()}
    assert got == {("a sūtra, xsutra (sūtra) Dōgen", 3), (None, None)}


def test_terms_are_looked_for_in_distinct_words(spark):
    from textloom.operators import attestation

    texts = spark.createDataFrame([(1, "a-b xx the\ttheory"), (1, "the"), (2, "in the\nend"), (None, "the end"), (3, "")], "id int, t string")
    terms = spark.createDataFrame([("the",), ("theo",), ("e end",), ("the\nend",), ("a-b",), ("",), (None,)], "term string")
    want = {("the", 1), ("theo", 1), ("the", 2), ("the\nend", 2), ("the", None), ("e end", None), ("a-b", 1)}
    for most in (1000, 0):
        found = attestation.attested_pairs(texts, "id", "t", terms, "term", most_broadcast=most)
        rows = [tuple(r) for r in found.collect()]
        assert len(rows) == len(set(rows)) and {r for r in rows if r[1] is not None} == {w for w in want if w[1] is not None}
        assert most == 0 or set(rows) == want
    deal = attestation.attested_pairs(texts.coalesce(1), "id", "t", terms.where("term = 'the'"), "term")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" in deal
