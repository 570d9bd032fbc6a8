"""Whole runs on hand-made rows."""

from pyspark.sql import functions as F

from textloom.plans import runs


def test_batch_run(spark):
    sources = spark.createDataFrame([("a", "# h\none\n\ntwo\n\nbad"), ("b", "x"), ("c", "# only"), ("d", "bad")], "key string, text string")
    done = spark.createDataFrame([("b",)], "key string")

    def fn(x):
        if "bad" in x:
            raise ValueError("no")
        return x.upper()

    got = {r["key"]: (r["text"], r["parts"], r["failed"]) for r in runs.batch_run(sources, done, fn, F.length, 3).collect()}
    assert got == {"a": ("ONE\n\nTWO", 2, 1)}


def test_glossary_run(spark):
    texts = spark.createDataFrame([("T1", "the bodhisattva and bodhisattvas"), ("T2", "a bodhisattva")], "key string, text string")
    seed = spark.createDataFrame([(0, "bodhisattvas", "菩薩", "", "person"), (1, "bodhisattva", "菩薩", "", "person"), (2, "arhat", "羅漢", "", "person")], "pos int, english string, chinese string, sanskrit string, category string")
    published = spark.createDataFrame([(0, "Bodhisattva", "bodhisattva", "a being", "Pub")], "pos int, english string, sanskrit string, definition string, source string")
    row = runs.glossary_run(texts, seed, published).collect()
    assert [(r["english"], r["sanskrit"], r["definition"], r["source"]) for r in row] == [("bodhisattva", "bodhisattva", "a being", "Pub")]


def test_cleanup_run(spark):
    text = "# Bath Hall—x\n" + "\n" * 8 + "nirvana—sutra in the Bath Hall, Three Jewels"
    df = runs.cleanup_run(spark.createDataFrame([("k", text)], "key string, text string"))
    r = df.first()
    assert r["text"] == "# Bath Hall:x\n" + "\n" * 8 + "nirvāṇa; sūtra in the bath hall, Three Treasures"
    assert (r["n_marks"], r["n_spellings"], r["n_case"], r["n_dashes"]) == (2, 1, 1, 2)
    assert [(s["rule"], s["fixes"]) for s in runs.cleanup_summary(df).collect()] == [("dashes", 2), ("marks", 2), ("case", 1), ("spellings", 1)]
