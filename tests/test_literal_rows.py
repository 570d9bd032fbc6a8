"""Operators on a few hand-made rows, each against SQL over the same rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import catalog, glossary, rewrite, segments
from textloom.sources import markup

CASES = {}


def query(sql):
    def add(f):
        CASES[f.__name__] = (f, sql)
        return f

    return add


def inline(spark, rows: list[tuple], schema: str):
    return spark.createDataFrame(rows, schema)


def values(rows: list[tuple], names: str) -> str:
    def one(x) -> str:
        if x is None:
            return "NULL"
        if isinstance(x, list):
            return "[" + ", ".join(map(one, x)) + "]"
        return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)

    return "(VALUES " + ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows) + f") AS v({names})"




CHARS = [(1, "漢字㐀abc"), (2, "豈𠀀。"), (3, ""), (4, "　「經」 x1")]
B = "=" * 12
BANNERS = [(1, f"# h\n{B}\nFascicle 1: a\n{B}\none\n{B}\nFascicle 2: b\n{B}\n \n{B}\nFascicle 1: c\n{B}\nmore "), (2, "no banner")]
MARKED = [(1, "# sutra Sutra\nsutra sutras, Dogen\x27s nirvana sutra's"), (2, "xsutra sutraā"), (3, "unwholesome roots—Blessed Ones—x")]
HEADED = [(1, "# Bath Hall\nBath Hall and Bath Hall\n## Dharma Hall"), (2, "Sangha Hall")]
TOP = "\n" * 8
DASHED = [(1, "a—b"), (2, TOP + "a—b—c\nx—y\nend—\n p — q\n—"), (3, "# a—b—c"), (4, TOP + "ā—ś")]
ENTRIES = [
    (0, "bodhisattvas", "菩薩", "bodhisattva", "person", ["T2"]), (1, "bodhisattva", "菩薩", "bodhisattva", "person", ["T1"]), (2, "dhāraṇī", "陀羅尼", "", "doctrinal", ["T3", "T1"]),
    (3, "dharani", "陀羅尼", "", "doctrinal", ["T4"]), (4, "Vow", "", "", "practice", ["T1"]), (5, "vows", "", "", "practice", ["T2", "T3"]), (6, "Bodhisattva", "大士", "", "title", ["T9"]),
]
ENTRY_SCHEMA = "pos int, english string, chinese string, sanskrit string, category string, sources array<string>"
_DEDUP = (
    "WITH e AS (SELECT * FROM " + values(ENTRIES, "pos, english, chinese, sanskrit, category, sources") + "), "
    f"a AS (SELECT *, row_number() OVER (PARTITION BY chinese, category ORDER BY NOT regexp_matches(english, '[{T.DIACRITICS}]'), length(english), english, pos) AS k, min(pos) OVER (PARTITION BY chinese, category) AS first_pos FROM e WHERE chinese <> ''), "
    "b AS (SELECT *, row_number() OVER (PARTITION BY rtrim(lower(english), 's'), category ORDER BY -len(sources), length(english), pos) AS k, min(pos) OVER (PARTITION BY rtrim(lower(english), 's'), category) AS first_pos FROM e WHERE chinese = ''), "
    "sa AS (SELECT chinese, category, list_sort(list_distinct(flatten(list(sources)))) AS s FROM a GROUP BY ALL), sb AS (SELECT rtrim(lower(english), 's') AS n, category, list_sort(list_distinct(flatten(list(sources)))) AS s FROM b GROUP BY ALL), "
    "u AS (SELECT english, chinese, sanskrit, category, s AS sources, first_pos, 0 AS part FROM a JOIN sa USING (chinese, category) WHERE k = 1 UNION ALL SELECT english, chinese, sanskrit, b.category, s, first_pos, 1 FROM b JOIN sb ON n = rtrim(lower(english), 's') AND sb.category = b.category WHERE k = 1) "
)
PUBLISHED = [(0, "Vow ", "praṇidhāna", "a solemn practice", "Pub 1"), (1, "vow", "other", "", "Pub 2"), (2, "Naga", "nāga", "a serpent deity", "Pub 1"), (3, "Eon", "", "a long period", "Pub 3")]
RENDERED = [("a", "甲", "", "", "own"), ("b", "", "b", "d", "Pub 1"), ("c", "乙", "k", "d", "own")]
BATCH = [("T0001_fasc_02", "succeeded", 1000, 2000), ("T0001_fasc_01", "succeeded", 10, 20), ("T0002_fasc_10", "errored", 5, 0)]
BATCH_SCHEMA = "custom_id string, type string, input_tokens long, output_tokens long"
NAMES = [("T01n0001",), ("T54n2131a",), ("12345",), ("0007B",), ("none",)]
HEADERS = [(1, "# a\n\n# b\nbody\n# c\n## d"), (2, "x\n# y"), (3, "# only")]
GLOSSARY = [(1, "# Title\n\n**Arhat** (阿羅漢; Skt. *arhat*): A saint.\n\n**Vow**: A promise\nkept.\n\nplain")]
LINES = [(1, '<a name="0001a01" class="al"><span class="tx"><span class="ec">甲</span><span class="ec" lang="x">乙</span></span></a><a name="0001a02" class="al"><span class="tx"></span></a>')]
XML = [("a.xml", '<t xmlns="u"><head>H</head><p>a<note>n</note>b<app><lem>c</lem><rdg>d</rdg></app>e<g ref="#x"/></p><lg><l>v1</l><l>v2</l></lg>tail</t>'), ("b.xml", "<bad")]
PAGES = [(1, 'x name="0012a01" y name="0010c29"'), (2, "none")]
DECLARED = [("c1", "unicode", "U+4E00", 0), ("c1", "normalized form", "丁", 0), ("c1", "normalized form", "丙", 1), ("c2", "unicode", "U+20000", 1), ("c2", "normal_unicode", "U+ZZ", 1), ("c3", "other", "x", 0)]


@query(
    "SELECT id, CAST(length(regexp_replace(text, '[^\\x{4E00}-\\x{9FFF}\\x{3400}-\\x{4DBF}]', '', 'g')) AS BIGINT) AS n1, "
    "CAST(length(regexp_replace(text, '[^\\x{4E00}-\\x{9FFF}]', '', 'g')) AS BIGINT) AS n2, "
    "CAST(length(regexp_replace(text, '[^\\x{4E00}-\\x{9FFF}\\x{3400}-\\x{4DBF}\\x{20000}-\\x{2A6DF}\\x{F900}-\\x{FAFF}\\x{2F800}-\\x{2FA1F}]', '', 'g')) AS BIGINT) AS n3 FROM " + values(CHARS, "id, text")
)  # C1, C2, C3
def ideograph_counts(spark, d):
    rows = inline(spark, CHARS, "id int, text string")
    return rows.select("id", *(T.count_class(F.col("text"), c).alias(n) for n, c in (("n1", T.IDEOGRAPHS_AND_A), ("n2", T.IDEOGRAPHS), ("n3", T.IDEOGRAPHS_WIDE))))


@query("SELECT id, regexp_replace(regexp_replace(text, '[\\s\\x{3000}]', '', 'g'), '[^" + T.PRESERVED + "]', '', 'g') AS clean FROM " + values(CHARS, "id, text"))
def preserve_filter(spark, d):  # C4, C5
    return inline(spark, CHARS, "id int, text string").select("id", T.preserve(F.col("text")).alias("clean"))


@query("SELECT CAST(1 AS INT) AS id, CAST(1 AS INT) AS num, 'one' || chr(10) || chr(10) || 'more' AS content, CAST(2 AS BIGINT) AS of_n")
def marker_split_merge(spark, d):  # C12, A11, K5
    return segments.merge_sections(inline(spark, BANNERS, "id int, text string"), "id", "text")


@query("SELECT id, text, CAST(n AS BIGINT) AS n FROM " + values([(1, "# sūtra Sūtra\nsūtra sūtras, Dōgen\x27s nirvāṇa sūtra's", 7), (2, "xsutra sutraā", 0), (3, "unwholesome roots—Blessed Ones—x", 0)], "id, text, n"))
def rewrite_marks(spark, d):  # C17
    return inline(spark, MARKED, "id int, text string").select("id", rewrite.whole_words(F.col("text"), rewrite.MARKS).alias("r")).select("id", "r.text", "r.n")


@query("SELECT id, text, CAST(n AS BIGINT) AS n FROM " + values([(1, MARKED[0][1], 0), (2, MARKED[1][1], 0), (3, "unroots of merit—World-Honored Ones—x", 2)], "id, text, n"))
def rewrite_spellings(spark, d):  # C18, its fixed rules
    return inline(spark, MARKED, "id int, text string").select("id", rewrite.literal(F.col("text"), rewrite.SPELLINGS).alias("r")).select("id", "r.text", "r.n")


@query("SELECT id, text, CAST(n AS BIGINT) AS n FROM " + values([(1, "# Bath Hall\nbath hall and bath hall\n## Dharma Hall", 2), (2, "Sangha hall", 1)], "id, text, n"))
def heading_safe_rewrite(spark, d):  # C19
    return inline(spark, HEADED, "id int, text string").select("id", rewrite.outside_headings(F.col("text"), rewrite.RUNNING_TEXT).alias("r")).select("id", "r.text", "r.n")


@query("SELECT id, text, CAST(n AS BIGINT) AS n FROM " + values([(1, "a—b", 0), (2, TOP + "a, b, c\nx; y\nend...\n p; q\n...", 5), (3, "# a:b:c", 2), (4, TOP + "ā; ś", 1)], "id, text, n"))
def dash_rewrite(spark, d):  # C20
    return inline(spark, DASHED, "id int, text string").select("id", rewrite.dashes(F.col("text")).alias("r")).select("id", "r.text", "r.n")


@query(_DEDUP + "SELECT english, chinese, category, array_to_string(sources, ';') AS sources FROM u")
def dedup_representative(spark, d):  # A6, A6b, X1, W4
    return glossary.dedup_by_source_term(inline(spark, ENTRIES, ENTRY_SCHEMA)).select("english", "chinese", "category", F.array_join("sources", ";").alias("sources"))


@query(_DEDUP + "SELECT arg_min(english, (part, first_pos)) AS english, arg_min(category, (part, first_pos)) AS category, array_to_string(list_sort(list_distinct(flatten(list(sources)))), ';') AS sources FROM u GROUP BY lower(english)")
def cross_dedup(spark, d):  # A7
    merged = glossary.dedup_across_categories(glossary.dedup_by_source_term(inline(spark, ENTRIES, ENTRY_SCHEMA)))
    return merged.select("english", "category", F.array_join("sources", ";").alias("sources"))


@query(
    "WITH l AS (SELECT lower(trim(english)) AS key, arg_max(english, pos) AS english, arg_max(chinese, pos) AS chinese, arg_max(sanskrit, pos) AS sanskrit, arg_max(category, pos) AS category FROM " + values([e[:5] for e in ENTRIES], "pos, english, chinese, sanskrit, category") + " GROUP BY 1), "
    "r AS (SELECT lower(trim(english)) AS key, arg_min(english, pos) AS pe, arg_max(definition, pos) AS pd, arg_max(source, pos) AS ps, arg_min(sanskrit, pos) FILTER (sanskrit <> '') AS psk FROM " + values(PUBLISHED, "pos, english, sanskrit, definition, source") + " GROUP BY 1) "
    "SELECT coalesce(english, pe) AS english, coalesce(chinese, '') AS chinese, coalesce(nullif(sanskrit, ''), psk, '') AS sanskrit, coalesce(category, CASE WHEN pe = 'Naga' THEN 'person' ELSE 'cosmological' END) AS category, coalesce(pd, '') AS definition, coalesce(ps, 'own') AS source FROM l FULL JOIN r USING (key)"
)
def overlay_merge(spark, d):  # J7, J7a
    published = inline(spark, PUBLISHED, "pos int, english string, sanskrit string, definition string, source string")
    return glossary.overlay(inline(spark, ENTRIES, ENTRY_SCHEMA), published)


@query("SELECT category, CAST(count(*) AS BIGINT) AS n, string_agg(english, ';' ORDER BY lower(english), english) AS terms, CAST(list_position(['" + "','".join(glossary.CATEGORIES) + "'], category) AS BIGINT) AS rank FROM " + values([e[:5] for e in ENTRIES] + [(9, "x", "", "", "unlisted")], "pos, english, chinese, sanskrit, category") + " WHERE category <> 'unlisted' GROUP BY category")
def category_sections(spark, d):  # A8, O4
    rows = [e[:5] for e in ENTRIES] + [(9, "x", "", "", "unlisted")]
    return glossary.sections(inline(spark, rows, "pos int, english string, chinese string, sanskrit string, category string"))


@query("SELECT * FROM " + values([("**a** (甲)",), ("**b**: d [Pub 1]",), ("**c** (乙) Skt. *k*: d",)], "line"))
def entry_lines(spark, d):  # C24
    rows = inline(spark, RENDERED, "english string, chinese string, sanskrit string, definition string, source string")
    return rows.select(glossary.render(*(F.col(c) for c in rows.columns)).alias("line"))


@query("SELECT CAST(sum(i) AS BIGINT) AS tokens_in, CAST(sum(o) AS BIGINT) AS tokens_out, sum(i) / 1e6 * 2.50 + sum(o) / 1e6 * 12.50 AS cost FROM " + values(BATCH, "id, type, i, o") + " WHERE type = 'succeeded'")
def batch_cost(spark, d):  # A14
    sums = inline(spark, BATCH, BATCH_SCHEMA).where("type = 'succeeded'").agg(F.sum("input_tokens").alias("tokens_in"), F.sum("output_tokens").alias("tokens_out"))
    return sums.withColumn("cost", catalog.cost(F.col("tokens_in"), F.col("tokens_out")))


@query("SELECT split_part(id, '_fasc_', 1) AS t_number, CAST(split_part(id, '_fasc_', 2) AS INT) AS fasc_num FROM " + values(BATCH, "id, type, i, o"))
def composite_key_parse(spark, d):  # C28
    return inline(spark, BATCH, BATCH_SCHEMA).select(T.composite_key(F.col("custom_id")).alias("k")).select("k.*")


@query("SELECT * FROM " + values([("T01n0001", "T0001"), ("T54n2131a", "T2131a"), ("12345", "T12345"), ("0007B", "T0007B"), ("none", "none")], "name, t_number"))
def text_numbers(spark, d):  # C15, C29
    return inline(spark, NAMES, "name string").select("name", T.text_number(F.col("name")).alias("t_number"))


@query("SELECT * FROM " + values([(1, "# a\n# b", "\nbody\n## d", "\nbody"), (2, "", "x", "x"), (3, "# only", "", "")], "id, head, kept, plain"))
def header_lines(spark, d):  # F5, F6, F8
    rows = inline(spark, HEADERS, "id int, text string")
    text = F.col("text")
    return rows.select("id", T.leading_header(text).alias("head"), T.drop_comment_lines(text, True).alias("kept"), T.drop_comment_lines(text, False).alias("plain"))


@query("SELECT * FROM " + values([("Arhat", "阿羅漢; Skt. *arhat*", "A saint."), ("Vow", "", "A promise\nkept.")], "term, parenthetical, definition"))
def glossary_markdown(spark, d):  # S16
    return inline(spark, GLOSSARY, "id int, text string").select(F.explode(glossary.parse_markdown(F.col("text"))).alias("e")).select("e.*")


@query("SELECT * FROM " + values([("0001a01", "甲乙"), ("0001a02", "")], "ref, text"))
def anchored_page_lines(spark, d):  # S13, E4, F9
    return inline(spark, LINES, "id int, html string").select(F.explode(markup.anchored_lines(F.col("html"))).alias("l")).select("l.ref", "l.text")


@query("SELECT path, CAST(pos AS INT) AS pos, type, text FROM " + values([("a.xml", 0, "heading", "H"), ("a.xml", 1, "para", "abceX"), ("a.xml", 2, "verse", "v1\nv2")], "path, pos, type, text"))
def xml_reading_order(spark, d):  # S4, E1, E2, E3, J9
    return markup.xml_blocks(inline(spark, XML, "path string, xml string"), chars={"x": "X"}).select("path", "pos", "type", "text")


@query("SELECT id, first, last FROM " + values([(1, "0010", "0012"), (2, None, None)], "id, first, last"))
def page_bounds(spark, d):  # S11
    return inline(spark, PAGES, "id int, html string").select("id", markup.page_bounds(F.col("html")).alias("b")).select("id", "b.*")


@query("SELECT * FROM " + values([("a.xml", "正題", "譯者", 3), ("b.xml", "次題", "", 0), ("c.xml", "", "", 0)], "path, title, author, extent"))
def xml_header_fields(spark, d):  # S2, S3
    head = '<t><titleStmt><title xml:lang="zh-Hant" level="{0}">{1}</title>{2}</titleStmt><extent>{3}</extent></t>'
    rows = [("a.xml", head.format("m", "正題", "<author>譯者</author>", "共3卷 12")), ("b.xml", head.format("x", "次題", "", "")), ("c.xml", "<bad")]
    return markup.xml_headers(inline(spark, rows, "path string, xml string"))


@query("SELECT * FROM " + values([("c1", "丁"), ("c2", "\U00020000")], "id, value"))
def character_map(spark, d):  # S5, C25, A16
    return markup.character_map(inline(spark, DECLARED, "id string, kind string, value string, file_pos int"))


@query("SELECT * FROM " + values([("Intro", "one\n"), ("Notes", "three")], "title, body"))
def markdown_sections(spark, d):  # S17
    rows = inline(spark, [("# T\n## Intro\none\n## Other\ntwo\n## Notes\nthree",)], "text string")
    return rows.select(F.explode(T.markdown_sections(F.col("text"), ["Intro", "Notes"])).alias("title", "body"))


@query("SELECT CAST(1 AS INT) AS id, " + values([("\n" + "=" * 40 + "\nFascicle 1: t\n" + "=" * 40 + "\n\n\n## h\n\n  a\n  b\n\n[Dhāraṇī] d\n\np\n",)], "text").replace("(VALUES", "v.text FROM (VALUES", 1))
def rendered_blocks(spark, d):  # C14
    rows = inline(spark, [(1, [("juan", "t", "1"), ("heading", "h", ""), ("para", "", ""), ("verse", "a\nb", ""), ("dharani", "d", ""), ("para", "p", "")])], "id int, blocks array<struct<type:string,text:string,n:string>>")
    return rows.select("id", markup.render_blocks(F.col("blocks")).alias("text"))


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(map(tuple, frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(CASES))
def test_same_as_sql(spark, name):
    made, sql = CASES[name]
    assert rows(made(spark, None).toPandas()) == rows(duckdb.sql(sql).df())
