"""Sources, sinks and streams that go on where a run broke off."""

import json
import random
import unicodedata
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from textloom.operators import attestation, external, positions, segments
from textloom.sources import files, markup, paged, store
from textloom.streaming import claims, incremental, polled

# Terms in texts


@pytest.mark.parametrize("most_broadcast", [0, attestation.MOST_BROADCAST])
def test_attested_pairs_are_those_of_a_search(spark, most_broadcast):
    import regex

    rng = random.Random(5)
    letters = "abcé —x_1\n"
    texts = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(0, 60)))) for i in range(150)] + [(900, None), (901, ""), (3, "again abc")]
    terms = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 7))) for _ in range(300)} | {"", r"\E", "a.c", "zzzz", "abcabc"}
    got = attestation.attested_pairs(spark.createDataFrame(texts, "k long, t string"), "k", "t", spark.createDataFrame([(t,) for t in terms] + [(None,)], "term string"), "term", most_broadcast=most_broadcast).collect()

    def holds(text, term):
        if len(term) <= 3:
            return bool(regex.search(r"(?<![\p{L}\p{N}_])" + regex.escape(term) + r"(?![\p{L}\p{N}_])", text))
        return term in text

    want = {(term, k) for term in terms if term for k, text in texts if text and holds(text, term)}
    assert len(got) == len(set(got)) and {(r["term"], r["key"]) for r in got} == want


def test_the_plan_doesnt_grow_with_the_terms(spark):
    texts = spark.createDataFrame([(1, "a b")], "k long, t string")
    size = lambda n: len(attestation.attested_pairs(texts, "k", "t", spark.range(n).select(F.format_string("term%d", "id").alias("term")), "term")._jdf.queryExecution().optimizedPlan().toString())
    assert abs(size(10) - size(5000)) < 40


# Positions


@pytest.mark.parametrize("together", [7, 1000])
def test_positions_are_gapless_and_stable(spark, together):
    rng = random.Random(3)
    rows = [(rng.randrange(5), i) for i in range(100)]
    df = spark.createDataFrame(rows, "v int, i int").coalesce(1)
    got = sorted((r["pos"], r["v"], r["i"]) for r in positions.with_positions(df, ["v"], together=together).collect())
    assert [(v, i) for _, v, i in got] == sorted(rows, key=lambda r: r[0]) and [p for p, _, _ in got] == list(range(100))
    assert positions.with_positions(df.limit(0), ["v"]).collect() == []


def test_folding_is_full(spark):
    words = ["Śākya", "ﬁn", "Ǆ", "é", "Ṩ", "한", None]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(positions.folded("w")).collect()]
    assert got == ["sakya", "fin", "dz", "e", "s", unicodedata.normalize("NFKD", words[5]), None]


# Sections


def plain_sections(lines, starts, noise):
    """One text as a loop over its lines; starts in list order."""
    out, current, idx, begun = [], [], 0, False
    for ref, text in sorted(lines):
        text = text.strip()
        if noise(text):
            continue
        if starts:
            while idx < len(starts) - 1 and ref >= starts[idx + 1][0]:
                if current:
                    out.append(("paragraph", idx + 1, "".join(current)))
                    current = []
                idx += 1
                out.append(("header", idx + 1, starts[idx][1]))
                begun = True
            if not begun:
                out.append(("header", 1, starts[0][1]))
                begun = True
        if not text:
            if current:
                out.append(("paragraph", idx + 1 if starts else 1, "".join(current)))
                current = []
        else:
            current.append(text)
    return out + ([("paragraph", idx + 1 if starts else 1, "".join(current))] if current else [])


def test_sections_are_those_of_a_loop(spark):
    rng = random.Random(8)
    texts = {}
    for k in range(60):
        lines = [(f"{i:04d}", rng.choice(["", " ", "甲", "　乙 ", "No. 12 x", "plain", "丙丁"])) for i in rng.sample(range(60), rng.randrange(0, 25))]
        starts = [(f"{i:04d}", f"t{i}") for i in (sorted if k % 3 else list)(rng.choices(range(70), k=rng.randrange(0, 7)))]
        texts[k] = (lines, starts)
    lines = spark.createDataFrame([(k, r, t) for k, (ls, _) in texts.items() for r, t in ls], "k int, ref string, text string")
    starts = spark.createDataFrame([(k, r, i, t) for k, (_, ss) in texts.items() for i, (r, t) in enumerate(ss)], "k int, ref string, idx int, title string")
    from textloom.functions.text import is_noise_line

    got = {}
    for r in segments.sectioned_text(lines, starts, "k", "ref", "text", is_noise_line).orderBy("k", "seq").collect():
        got.setdefault(r["k"], []).append((r["kind"], r["section"], r["content"]))
    noise = lambda t: bool(t) and (t.startswith("No. 12") or all(ord(c) < 0x2000 for c in t))
    assert got == {k: v for k, (ls, ss) in texts.items() if (v := plain_sections(ls, ss, noise))}
    counts = {r["k"]: r["n_sections"] for r in segments.section_counts(lines.select("k").distinct(), starts, "k").collect()}
    assert counts == {k: len(ss) or 1 for k, (ls, ss) in texts.items() if ls}


# One file per key


def test_files_are_written_whole_and_once(spark, tmp_path):
    at = str(tmp_path / "files")
    rows = spark.createDataFrame([(f"d{i % 3}/n é+{i}.txt", f"text {i}\n\r\n甲") for i in range(40)] + [("empty.txt", None)], "n string, t string").repartition(5)
    store.write_files(rows, at, F.col("n"), F.col("t"))
    assert {str(p.relative_to(at)) for p in Path(at).rglob("*") if p.is_file()} == {r["n"] for r in rows.collect()}
    assert {(r["name"], r["content"]) for r in store.read_files(spark, at).collect()} == {(r["n"], r["t"]) for r in rows.collect() if r["t"]}  # Spark's readers pass over empty files
    store.write_files(rows.where("n = 'empty.txt'"), at, F.col("n"), F.lit("new"))
    assert Path(at, "empty.txt").read_text() == "new" and len(list(Path(at).rglob("*.txt"))) == 41


@pytest.mark.parametrize("bad", [("same.txt", "x"), ("../up.txt", "x"), ("", "x"), (None, "x")])
def test_an_aborted_job_leaves_no_file(spark, tmp_path, bad):
    at = str(tmp_path / "files")
    rows = spark.createDataFrame([(f"{i}.txt", "t") for i in range(30)] + [("same.txt", "y"), bad], "n string, t string").repartition(6)
    with pytest.raises(Exception):  # noqa: B017
        store.write_files(rows, at, F.col("n"), F.col("t"))
    assert [p for p in Path(at).rglob("*") if p.is_file()] == []


def test_many_small_files_are_written_by_all_cores(spark, tmp_path):
    at = str(tmp_path / "files")
    store.write_files(spark.range(64).select(F.col("id").cast("string").alias("n")), at, F.col("n"), F.lit("x"))
    assert len({p.stat().st_ino for p in Path(at).iterdir()}) == 64 and not Path(at, "_staging").exists()
    for i in range(64, 1200):
        Path(at, str(i)).write_text("x")
    whole = store.read_files(spark, at)
    assert whole.rdd.getNumPartitions() <= 16 and whole.count() == 1200  # else 32 files a task


def test_sections_say_which_of_how_many(spark, tmp_path):
    rows = spark.createDataFrame([("T1", 1, "one", 3), ("T1", 2, " \n　", 3), ("T1", 12, "two", 3)], "k string, num int, c string, n long")
    store.write_sections(rows, str(tmp_path / "s"), "k", "num", "c", "n", F.concat(F.lit("Title "), "k"))
    assert {p.name: p.read_text() for p in (tmp_path / "s").iterdir()} == {"T1_f001.txt": "# Title T1\n# Fascicle 1 of 3\n\none", "T1_f012.txt": "# Title T1\n# Fascicle 12 of 3\n\ntwo"}


# Pages


def anchor(ref, text):
    return f'<a name="{ref}" class="al"><span class="tx"><span class="ec">{text}</span></span></a>'


class Logged(paged.PagedTexts):
    """Pages of a folder; the first two requests for a page named flaky fail, every one for a page named dead."""

    @classmethod
    def name(cls):
        return "logged_pages"

    def fetch(self):
        stored, folder = paged.StoredPages(self.options["path"]), self.options["path"]

        def fetch(text_id, page):
            log = Path(folder) / "log.txt"
            before = log.read_text().count(f"{text_id} {page}\n") if log.exists() else 0
            with log.open("a") as f:
                f.write(f"{text_id} {page}\n")
            if text_id == "dead" and page == "0003" or text_id == "flaky" and before < 2:
                raise OSError("no answer")
            return stored(text_id, page)

        return fetch


def test_pages_by_cursor(spark, tmp_path):
    at = str(tmp_path)
    pages = [
        ("flaky", 1, anchor("0001a01", "x") + anchor("0001a01", "again") + anchor("0002b01", "y")), ("flaky", 2, "never asked for"), ("flaky", 3, anchor("0003a01", "z") + anchor("0009a01", "beyond")), ("flaky", 4, ""),
        ("stuck", 1, anchor("0001a01", "x")), ("stuck", 2, anchor("0001a01", "old")), ("stuck", 3, anchor("0003a01", "lost")), ("dead", 1, anchor("0002a01", "x")), ("dead", 3, anchor("0003a01", "lost")), ("other", 1, anchor("0001a01", "o")),
    ]
    paged.store_pages(spark.createDataFrame(pages, "text_id string, page int, html string"), at, slices=3)
    df = paged.paged_texts(spark, at, Logged, delay=0.0)
    got = {(r["text_id"], r["ref"], r["text"]) for r in df.where("text_id <> 'other'").collect()}
    assert got == {("flaky", "0001a01", "x"), ("flaky", "0002b01", "y"), ("flaky", "0003a01", "z"), ("stuck", "0001a01", "x"), ("dead", "0002a01", "x")}
    asked = (tmp_path / "log.txt").read_text().split("\n")
    assert asked.count("flaky 0001") == 3 and asked.count("dead 0003") == 3 and asked.count("flaky 0002") == 0


def test_filters_spare_requests(spark, tmp_path):
    at = str(tmp_path)
    paged.store_pages(spark.createDataFrame([(t, p, anchor(f"{p:04d}a01", t)) for t in "abc" for p in (1, 2, 3)], "text_id string, page int, html string"), at)
    df = paged.paged_texts(spark, at, Logged, delay=0.0)
    assert {(r["text_id"], r["ref"]) for r in df.where("text_id IN ('a', 'b') AND ref <= '0002a01'").collect()} == {(t, f"{p:04d}a01") for t in "ab" for p in (1, 2)}
    assert set((tmp_path / "log.txt").read_text().split("\n")) == {"", "a 0001", "a 0002", "b 0001", "b 0002"}


def test_pages_of_five_digits(spark, tmp_path):
    at, numbers = str(tmp_path / "long"), range(9997, 10004)
    pages = [("a", p, anchor(f"{p:04d}a01", f"t{p}")) for p in numbers] + [("b", 7, anchor("0007a01", "t7")), ("b", 8, anchor("0008a01", "t8"))]
    paged.store_pages(spark.createDataFrame(pages, "text_id string, page int, html string"), at)
    df = paged.paged_texts(spark, at, delay=0.0)
    whole = {("a", f"{p:04d}a01", f"t{p}") for p in numbers} | {("b", "0007a01", "t7"), ("b", "0008a01", "t8")}
    assert set(map(tuple, df.collect())) == whole
    for bound in ("0007a01", "1000", "9998a01"):  # references are compared as strings
        assert set(map(tuple, df.where(F.col("ref") <= bound).collect())) == {r for r in whole if r[1] <= bound}


def test_pauses_grow_between_tries():
    slept = []

    def fetch(*_):
        raise OSError

    assert paged.Polite(fetch, 1.5, 3, slept.append)("t", "1") is None
    assert slept == [1.5, 3.0, 1.5, 4.5, 1.5]


# Results of a job


def test_results_over_a_restart(spark, tmp_path):
    row = lambda i, kind, text: json.dumps({"custom_id": i, "type": kind, "text": text, "input_tokens": 2, "output_tokens": 3})
    parts = [[row("a", "succeeded", "1"), row("b", "errored", None)], [row("b", "succeeded", "2")], [row("a", "succeeded", "new"), row("c", "errored", None)]]

    def run(folder, looks):
        at, sink, progress = (str(tmp_path / folder / x) for x in ("job", "sink", "progress"))
        for n, part in enumerate(parts):
            Path(at, "results").mkdir(parents=True, exist_ok=True)
            Path(at, "results", f"{n:06d}.json").write_text("\n".join(part))
        for there, ended in looks:
            polled.set_status(at, there, ended)
            assert polled.drain_job(spark, at, sink, progress, looks=1) == ended
        return sink, sorted((r["custom_id"], r["text"]) for r in polled.merged(spark, sink).collect())

    sink, broken = run("a", [(0, False), (1, False), (2, False), (3, True)])
    _, whole = run("b", [(3, True)])
    assert broken == whole == [("a", "new"), ("b", "2")]
    again = spark.read.parquet(f"{sink}/batch=0")
    polled.upsert_batch(sink)(spark.createDataFrame(again.collect(), again.schema), 0)  # a batch that comes twice
    assert sorted((r["custom_id"], r["text"]) for r in polled.merged(spark, sink).collect()) == whole
    assert tuple(polled.token_sums(polled.merged(spark, sink)).first()) == (4, 6)


def test_waits_until_the_job_has_ended(spark, tmp_path):
    at, waits = str(tmp_path / "job"), []
    Path(at, "results").mkdir(parents=True)
    Path(at, "results", "000000.json").write_text(json.dumps({"custom_id": "a", "type": "succeeded", "text": "t"}))

    def sleep(seconds):
        waits.append(seconds)
        polled.set_status(at, 1, len(waits) == 2)

    assert polled.drain_job(spark, at, str(tmp_path / "sink"), str(tmp_path / "progress"), wait=60.0, sleep=sleep)
    assert waits == [60.0, 60.0] and polled.merged(spark, str(tmp_path / "sink")).count() == 1


def test_result_files_are_dealt_to_a_bounded_number_of_tasks(tmp_path):
    for n in range(1000):
        (tmp_path / "results").mkdir(exist_ok=True)
        (tmp_path / "results" / f"{n:06d}.json").write_text("\n".join(json.dumps({"custom_id": f"{n}.{k}"}) for k in range(2)))
    reader = polled.ResultReader(str(tmp_path))
    for start, end in ((0, 1000), (3, 1000), (0, 1), (7, 7)):
        parts = reader.partitions({"files": start}, {"files": end})
        assert len(parts) <= 200
        assert [(r[0], r[5]) for p in parts for r in reader.read(p)] == [(f"{n}.{k}", n * 1_000_000 + k) for n in range(start, end) for k in range(2)]


# Claims


def test_claims_lapse_and_survive_restarts(spark, tmp_path):
    source, sink, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    schema = "key long, claim long, at long"
    for batch in ([(1, 1, 0), (1, 2, 5), (2, 3, 0), (1, 9, 5)], [(1, 4, 9), (1, 5, 10), (1, 6, 15)], [(2, 7, 100), (2, 8, 105)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        claims.granted(stream, 10).writeStream.format("parquet").option("path", sink).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    grants = spark.read.schema(claims.GRANTED).parquet(sink)
    assert sorted((r["key"], r["claim"]) for r in grants.collect()) == [(1, 1), (1, 5), (2, 3), (2, 7)]
    assert {r["key"]: (r["claim"], r["until"]) for r in claims.holders(grants).collect()} == {1: (5, 20), 2: (7, 110)}


# Calls that are remembered


def counting(folder, fails):
    def fn(x):
        with (folder / "calls.txt").open("a") as f:
            f.write(f"{x}\n")
        if fails(x, (folder / "calls.txt").read_text().split("\n").count(x)):
            raise ValueError("no")
        return x.upper()

    return fn


def test_a_repeated_task_calls_once(spark, tmp_path):
    rows = spark.createDataFrame([(f"t{i}",) for i in range(12)], "t string").repartition(3)
    fn = counting(tmp_path, lambda x, n: x == "t5")
    done = external.transform_chunks(rows, "t", fn, tries=2, memo=str(tmp_path / "memo"))
    dead = external.transform_chunks(rows, "t", fn, tries=2, memo=str(tmp_path / "memo")).select(F.when(F.col("t") == "t7", F.raise_error(F.lit("executor lost"))).otherwise(F.col("t")))
    with pytest.raises(Exception, match="executor lost"):
        dead.collect()
    got = {r["t"]: (r["result"], r["error"], r["attempts"]) for r in done.collect()}
    assert got == {f"t{i}": (f"T{i}", None, 1) for i in range(12) if i != 5} | {"t5": (None, "no", 2)}
    called = (tmp_path / "calls.txt").read_text().split()
    assert sorted(called) == sorted([f"t{i}" for i in range(12)] + ["t5"])
    more = external.transform_chunks(rows, "t", counting(tmp_path, lambda x, n: False), tries=3, memo=str(tmp_path / "memo"))
    assert {r["attempts"] for r in more.where("t = 't5'").collect()} == {3}  # tries add up


def test_failed_drafts_stay_as_rows(spark, tmp_path):
    rows = spark.createDataFrame([("k", 1, "ok"), ("k", 2, "bad"), ("k", 3, "flaky"), ("k", 4, None), ("l", 1, "bad")], "k string, n int, t string")

    def draft(x):
        if x == "bad":
            raise ValueError("refused")
        return x.upper()

    def review(x):
        if x == "FLAKY":
            raise TimeoutError("slow")
        return f"{x}!"

    done = external.draft_and_review(rows, "t", draft, review, memo=str(tmp_path / "memo"))
    got = {(r["k"], r["n"]): (r["draft"], r["final"], r["draft_tries"], r["review_tries"], r["draft_error"], r["review_error"]) for r in done.collect()}
    assert got == {
        ("k", 1): ("OK", "OK!", 1, 1, None, None), ("k", 2): (None, None, 5, 0, "refused", None), ("k", 3): ("FLAKY", "FLAKY", 1, 5, None, "slow"),
        ("k", 4): (None, None, 0, 0, "no text", None), ("l", 1): (None, None, 5, 0, "refused", None),
    }
    assert [(r["k"], r["text"], r["parts"], r["failed"]) for r in external.reviewed_texts(done, "k", "n").collect()] == [("k", "OK!\n\nFLAKY", 2, 2)]
    assert [external.growing()(n) for n in (1, 2, 3)] == [60.0, 120.0, 180.0]


def test_tries_of_a_memo_are_lines_of_few_files(spark, tmp_path):
    """However often a content is tried; rows of one content, in whatever tasks they were, call once."""
    rows = spark.createDataFrame([(f"bad{i % 3}",) for i in range(60)], "t string").repartition(5)
    fn = counting(tmp_path, lambda x, n: True)
    done = external.transform_chunks(rows, "t", fn, tries=4, memo=str(tmp_path / "memo"))
    assert {r["attempts"] for r in done.collect() + done.collect()} == {4}
    assert len((tmp_path / "calls.txt").read_text().split()) == 3 * 4
    files = [p for p in (tmp_path / "memo").rglob("*") if p.is_file()]
    assert len(files) <= 3 and sum(len(p.read_text().splitlines()) for p in files) == 3 * 4


def test_a_memo_ends_at_a_broken_line(tmp_path):
    memo = external.Memo(str(tmp_path), "call")
    memo.put("a", external.Outcome("A", None, 1, 0.0))
    memo.close()
    (file,) = (p for p in tmp_path.rglob("*") if p.is_file())
    with file.open("a") as f:
        f.write('["dead')
    again = external.Memo(str(tmp_path), "call")
    assert (again.get("a").result, again.get("b").attempts) == ("A", 0)


# Deadlines


def test_two_short_runs_are_one_long_run(spark, tmp_path):
    source = str(tmp_path / "in")
    docs = spark.range(40).select(F.col("id").alias("doc_id"))
    docs.repartition(5).write.parquet(source)

    def run(name, deadlines):
        ends, clock = [], iter(range(1000)).__next__
        for deadline in deadlines:
            ends.append(incremental.drain_until(spark, source, docs.schema, str(tmp_path / name / "out"), str(tmp_path / name / "progress"), deadline, clock=clock))
        return ends, sorted(r["doc_id"] for r in incremental.batches(spark, str(tmp_path / name / "out"), docs.schema).collect())

    assert run("long", [1000]) == ([True], list(range(40)))
    ends, rows = run("short", [2, 1000])
    assert ends == [False, True] and rows == list(range(40))
    assert run("none", [0, 1000])[0] == [False, True]


# Blocks of texts


def test_blocks_over_the_files_of_a_text(spark):
    char = lambda i, v: f'<char xml:id="{i}"><charProp><localName>other</localName><value>no</value></charProp>{v}</char>'
    normal = lambda v: f"<charProp><localName>normalized form</localName><value>{v}</value></charProp>"
    file = lambda chars, body: f'<TEI xmlns="u"><teiHeader><p>head</p><charDecl>{chars}</charDecl></teiHeader><text><body>{body}</body></text></TEI>'
    rows = [
        ("T1", "b.xml", file(char("c1", normal("second")) + char("c2", '<mapping type="normal_unicode">U+ZZ</mapping><mapping type="unicode">u+4E01</mapping>'), '<p><g ref="#c1"/><g ref="#c2"/><g ref="#c9"/>.</p><p><g ref="#c9"/></p>')),
        ("T1", "a.xml", file(char("c1", normal("first")), '<juan n="1"/><lg><l><g ref="#c9"/></l><l>x<g ref="#c1"/></l></lg>')),
        ("T1", "c.xml", "<bad"), ("T2", "z.xml", file("", '<p>y<g ref="#c1"/></p>')),
    ]
    got = [(r["text_id"], r["pos"], r["type"], r["text"]) for r in markup.text_blocks(spark.createDataFrame(rows, "text_id string, path string, xml string")).orderBy("text_id", "pos").collect()]
    assert got == [("T1", 0, "juan", ""), ("T1", 1, "verse", "xfirst"), ("T1", 2, "para", "first丁."), ("T2", 0, "para", "y")]


def test_a_json_array_that_may_be_missing(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"x": 1}, {"x": 2}]')
    assert [r["x"] for r in files.json_array(spark, str(tmp_path / "a.json"), "x int").collect()] == [1, 2]
    assert files.json_array(spark, str(tmp_path / "none.json"), "x int", optional=True).collect() == []


def test_seed_terms_keep_their_order(spark, tmp_path):
    rows = [(i, f"térm {i} \"q\"", "" if i % 9 == 0 else f"字{i}", "", "other") for i in range(557)]
    random.Random(2).shuffle(rows)
    files.write_seed(spark.createDataFrame(rows, "pos long, english string, chinese string, sanskrit string, category string").repartition(4), str(tmp_path / "seed"))
    assert sorted(map(tuple, files.seed_terms(spark, str(tmp_path / "seed")).collect())) == sorted(rows)


def test_chunks_take_time_in_proportion(spark):
    import time

    from textloom.operators import chunking

    def seconds(n):
        df = spark.range(1).select(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("line "), i.cast("string"))), "\n").alias("t"))
        made = df.select(F.size(chunking.greedy(F.split("t", "\n", -1), F.length, 20, "\n")).alias("a"), F.size(chunking.two_level(F.col("t"), F.length, 20, "\n", "(?<= )", "\n")).alias("b"))
        began = time.perf_counter()
        assert made.first()["a"] == n // 2 or made.first()["a"] > n // 3
        return time.perf_counter() - began

    seconds(2_000)
    small, large = seconds(8_000), seconds(32_000)
    assert large < 5 * small + 1
