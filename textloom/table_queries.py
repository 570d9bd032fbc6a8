"""Queries whose inputs are made from the tables by SQL that both engines read.

The tables hold neither banners, markup of texts, nor characters beyond Latin, so a first
step writes them in: it gives both sides the same rows, and what follows is computed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import catalog, chunking, external, glossary, positions, rewrite, segments
from textloom.plans import runs
from textloom.registry import classify_sql, literal_count, nested, query, table
from textloom.sources import files, markup, store
from textloom.streaming import incremental

TRIM = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"


def prepared(spark, d: str, name: str, /, **columns: str) -> DataFrame:
    """Columns of a table by SQL expressions."""
    return table(spark, d, name).select(*(F.expr(sql).alias(c) for c, sql in columns.items()))


def prepared_sql(name: str, /, **columns: str) -> str:
    return "(SELECT " + ", ".join(f"{sql} AS {c}" for c, sql in columns.items()) + f" FROM {name})"


# Characters of another script, put in place of frequent letters

SCRIPT = {"doc_id": "doc_id", "text": "translate(text, 'aeiourst,', '漢㐀豈𠀀一　「Ａ。')"}


@query(
    "SELECT doc_id, CAST(length(regexp_replace(text, '[^\\x{4E00}-\\x{9FFF}\\x{3400}-\\x{4DBF}]', '', 'g')) AS BIGINT) AS n1, "
    "CAST(length(regexp_replace(text, '[^\\x{4E00}-\\x{9FFF}]', '', 'g')) AS BIGINT) AS n2, "
    f"CAST(length(regexp_replace(text, '[^\\x{{4E00}}-\\x{{9FFF}}\\x{{3400}}-\\x{{4DBF}}\\x{{20000}}-\\x{{2A6DF}}\\x{{F900}}-\\x{{FAFF}}\\x{{2F800}}-\\x{{2FA1F}}]', '', 'g')) AS BIGINT) AS n3 FROM {prepared_sql('documents', **SCRIPT)}"
)
def ideograph_counts(spark, d):  # C1, C2, C3
    rows = prepared(spark, d, "documents", **SCRIPT)
    return rows.select("doc_id", *(T.count_class(F.col("text"), c).alias(n) for n, c in (("n1", T.IDEOGRAPHS_AND_A), ("n2", T.IDEOGRAPHS), ("n3", T.IDEOGRAPHS_WIDE))))


@query(f"SELECT doc_id, regexp_replace(regexp_replace(text, '[\\s\\x{{3000}}]', '', 'g'), '[^{T.PRESERVED}]', '', 'g') AS clean FROM {prepared_sql('documents', **SCRIPT)}")
def preserve_filter(spark, d):  # C4, C5
    return prepared(spark, d, "documents", **SCRIPT).select("doc_id", T.preserve(F.col("text")).alias("clean"))


NOTED = {"doc_id": "doc_id", "text": "replace(replace(translate(text, 'aeiourst', '漢㐀豈𠀀一　「Ａ'), '.', '{引}'), ',', '{x}')"}


@query(f"SELECT doc_id, array_to_string(regexp_extract_all(regexp_replace(text, '[\\s\\x{{3000}}]', '', 'g'), '\\{{[^}}]+\\}}|[{T.PRESERVED}]+'), '') AS clean FROM {prepared_sql('documents', **NOTED)}")
def annotated_filter(spark, d):  # C6
    return prepared(spark, d, "documents", **NOTED).select("doc_id", T.preserve(F.col("text"), annotations=True).alias("clean"))


SENTENCES = {"doc_id": "doc_id", "text": "replace(replace(replace(text, '. ', '。'), ', ', '！'), chr(10), chr(10) || chr(10))"}


@query(
    f"SELECT doc_id, CAST(len(string_split(text, chr(10) || chr(10))) AS BIGINT) AS n_paragraphs, CAST(length(text) - length(translate(text, '。！？', '')) + 1 AS BIGINT) AS n_sentences, "
    f"array_to_string(list_transform(string_split(replace(replace(text, '。', '。' || chr(1)), '！', '！' || chr(1)), chr(1)), lambda s: CAST(length(s) AS VARCHAR)), ' ') AS lengths FROM {prepared_sql('documents', **SENTENCES)}"
)
def paragraphs_and_sentences(spark, d):  # C7, C8
    rows = prepared(spark, d, "documents", **SENTENCES)
    sentences = T.sentences(F.col("text"))
    lengths = F.array_join(F.transform(sentences, lambda s: F.length(s).cast("string")), " ")
    return rows.select("doc_id", F.size(T.paragraphs(F.col("text"))).cast("long").alias("n_paragraphs"), F.size(sentences).cast("long").alias("n_sentences"), lengths.alias("lengths"))


SPACED = {"doc_id": "doc_id", "text": "'　 ' || translate(text, ',', '　') || '　' || chr(10)"}


@query(f"SELECT doc_id, regexp_replace(text, '^[\\s\\x{{3000}}]+|[\\s\\x{{3000}}]+$', '', 'g') AS text FROM {prepared_sql('documents', **SPACED)}")
def trimmed_texts(spark, d):  # C30
    return prepared(spark, d, "documents", **SPACED).select("doc_id", T.strip(F.col("text")).alias("text"))


# Sections of conversations

BAR = "============"
TURN = f"chr(10) || '{BAR}' || chr(10) || 'Fascicle ' || (turn % 3) || ': ' || role || chr(10) || '{BAR}' || chr(10) || content || chr(10)"
CONTENT = "CASE WHEN length(text) % 4 = 0 THEN ' ' ELSE text END"


def joined_turns(rows: DataFrame, part: str) -> DataFrame:
    """``conv_id``, ``text``: a part for each turn, in order."""
    parts = F.array_sort(F.collect_list(F.struct("turn", F.expr(part).alias("part"))))
    return rows.groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda p: p["part"]), "").alias("text"))


@query(
    f"WITH c AS (SELECT conv_id, CAST(turn % 3 AS INT) AS num, turn, {TRIM.format(CONTENT)} AS content FROM conversations) "
    "SELECT conv_id, num, string_agg(content, chr(10) || chr(10) ORDER BY turn) AS content, CAST(any_value(of_n) AS BIGINT) AS of_n FROM c JOIN (SELECT conv_id, count(DISTINCT num) AS of_n FROM c GROUP BY conv_id) n USING (conv_id) GROUP BY conv_id, num HAVING bool_or(content <> '')"
)
def marker_split_merge(spark, d):  # C12, A11, K5
    rows = table(spark, d, "conversations").withColumn("content", F.expr(CONTENT))
    return segments.merge_sections(joined_turns(rows, TURN), "conv_id", "text")


@query("SELECT conv_id, role || ' ' || turn AS title, text || chr(10) AS body FROM conversations WHERE role || ' ' || turn IN ('user 0', 'assistant 1', 'user 2')")
def markdown_sections(spark, d):  # S17
    text = joined_turns(table(spark, d, "conversations"), "CASE WHEN turn = 0 THEN '# T' || chr(10) ELSE '' END || '## ' || role || ' ' || turn || chr(10) || text || chr(10)")
    return text.select("conv_id", F.explode(T.markdown_sections(F.col("text"), ["user 0", "assistant 1", "user 2"])).alias("title", "body"))


RULE = "=" * 40


@query(f"""
SELECT conv_id, string_agg(CASE turn % 5 WHEN 0 THEN chr(10) || '{RULE}' || chr(10) || 'Fascicle ' || turn || ': ' || text || chr(10) || '{RULE}' || chr(10) WHEN 1 THEN chr(10) || '## ' || text || chr(10)
  WHEN 2 THEN array_to_string(list_transform(string_split(text, chr(10)), lambda l: '  ' || l), chr(10)) || chr(10) WHEN 3 THEN '[Dhāraṇī] ' || text || chr(10) ELSE text || chr(10) END, chr(10) ORDER BY turn) AS text FROM conversations WHERE text <> '' GROUP BY conv_id""")
def rendered_blocks(spark, d):  # C14
    kind = F.element_at(F.array(*map(F.lit, ("juan", "heading", "verse", "dharani", "para"))), (F.col("turn") % 5 + 1).cast("int"))
    block = F.struct("turn", kind.alias("type"), F.col("text"), F.col("turn").cast("string").alias("n"))
    blocks = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(block)).alias("blocks"))
    return blocks.select("conv_id", markup.render_blocks(F.col("blocks")).alias("text"))


ESCAPED = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query(f"""
WITH b AS (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'heading' WHEN 1 THEN 'para' ELSE 'verse' END AS type, {TRIM.format("text")} AS text FROM conversations),
f AS (SELECT conv_id, turn, type, CASE type WHEN 'heading' THEN text WHEN 'para' THEN text || 'ceX' ELSE text || chr(10) || 'v2' END AS text FROM b WHERE text <> '')
SELECT CAST(conv_id AS VARCHAR) AS path, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS pos, type, text FROM f""")
def xml_reading_order(spark, d):  # E1, E2, E3, J9
    rows = table(spark, d, "conversations").where("text <> ''")
    part = f"CASE turn % 3 WHEN 0 THEN '<head>' || {ESCAPED} || '<note>n</note></head>' WHEN 1 THEN '<p>' || {ESCAPED} || '<app><lem>c</lem><rdg>d</rdg></app>e<g ref=\"#x\"/><g ref=\"#y\"/></p>tail' ELSE '<lg><l>' || {ESCAPED} || '</l><l> </l><l>v2</l></lg>tail' END"
    files = joined_turns(rows, part).select(F.col("conv_id").cast("string").alias("path"), F.concat(F.lit('<t xmlns="u">'), "text", F.lit("</t>")).alias("xml"))
    return markup.xml_blocks(files, chars={"x": "X"}).select("path", "pos", "type", "text")


# Lines of documents

HEADERS = {"doc_id": "doc_id", "text": "CASE doc_id % 4 WHEN 0 THEN '# a' || chr(10) || ' ' || chr(10) || '# ' || lang || chr(10) WHEN 1 THEN '## x' || chr(10) ELSE '' END || replace(replace(text, '. ', '.' || chr(10) || '## '), ', ', chr(10) || '# ')"}


@query(f"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {prepared_sql("documents", **HEADERS)}),
f AS (SELECT *, coalesce(list_position(list_transform(ls, lambda x: NOT (starts_with(x, '#') OR regexp_full_match(x, '\\s*'))), true), len(ls) + 1) AS first FROM l)
SELECT doc_id, array_to_string(list_filter(ls[1:first - 1], lambda x: starts_with(x, '#')), chr(10)) AS head, array_to_string(list_filter(ls, lambda x: NOT starts_with(x, '#') OR starts_with(x, '##')), chr(10)) AS kept,
  array_to_string(list_filter(ls, lambda x: NOT starts_with(x, '#')), chr(10)) AS plain FROM f""")
def header_lines(spark, d):  # F5, F6, F8
    text = F.col("text")
    return prepared(spark, d, "documents", **HEADERS).select("doc_id", T.leading_header(text).alias("head"), T.drop_comment_lines(text, True).alias("kept"), T.drop_comment_lines(text, False).alias("plain"))


BLANKS = {"doc_id": "doc_id", "text": "replace(replace(text, '. ', '.' || chr(10) || chr(10) || chr(10)), ', ', ',' || chr(10) || ' ' || chr(10) || chr(10) || chr(10) || chr(10))"}


@query(f"SELECT doc_id, regexp_replace(text, '(?m)^[^\\S\\n]*\\n[^\\S\\n]*\\n', '', 'g') AS text FROM {prepared_sql('documents', **BLANKS)}")
def without_blank_pairs(spark, d):  # F7
    return prepared(spark, d, "documents", **BLANKS).select("doc_id", T.without_blank_pairs(F.col("text")).alias("text"))


_ANCHORS = "SELECT doc_id, unnest(string_split(replace(text, '<', '('), chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents"


def _anchored(spark, d: str) -> DataFrame:
    ref = lambda i: F.format_string("%04da%02d", F.floor(i / 10), i % 10)
    line = lambda l, i: F.concat(F.lit('<a name="'), ref(i), F.lit('" class="al"><span class="tx"><span class="ec">'), l, F.lit("</span></span></a>"))  # noqa: E731, E741
    return table(spark, d, "documents").select("doc_id", F.array_join(F.transform(F.split(F.replace("text", F.lit("<"), F.lit("(")), "\n", -1), line), "").alias("html"))


@query(f"SELECT doc_id, printf('%04da%02d', i // 10, i % 10) AS ref, l AS text FROM ({_ANCHORS})")
def anchored_page_lines(spark, d):  # E4
    return _anchored(spark, d).select("doc_id", F.explode(markup.anchored_lines(F.col("html"))).alias("l")).select("doc_id", "l.ref", "l.text")


@query(f"SELECT doc_id, printf('%04d', min(i) // 10) AS first, printf('%04d', max(i) // 10) AS last FROM ({_ANCHORS}) GROUP BY doc_id")
def page_bounds(spark, d):  # S11
    return _anchored(spark, d).select("doc_id", markup.page_bounds(F.col("html")).alias("b")).select("doc_id", "b.*")


@query(f"SELECT doc_id, printf('%04da%02d', i // 10, i % 10) AS ref FROM ({_ANCHORS}) JOIN (SELECT doc_id, printf('%04d', count(*) // 20) AS last FROM ({_ANCHORS}) GROUP BY doc_id) USING (doc_id) WHERE printf('%04d', i // 10) <= last")
def lines_up_to_the_last_page(spark, d):  # F9, each text with its own last page
    lines = anchored_page_lines(spark, d).select("doc_id", "ref")
    bounds = table(spark, d, "documents").select("doc_id", F.format_string("%04d", F.floor(F.size(F.split("text", "\n", -1)) / 20)).alias("last"))
    return catalog.up_to_last_page(lines, bounds, "doc_id", "ref", "last")


# Rewrites

_WORDS = "replace(replace(replace(text, ' the ', ' sutra '), ' of ', ' Nirvana '), ' de ', ' xsutra Dogen ')"
MARKED = {"doc_id": "doc_id", "text": _WORDS}
_TOKENS = "regexp_extract_all(text, '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_]+')"
_MARKS = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in rewrite.MARKS) + "}"


@query(f"SELECT doc_id, array_to_string(list_transform(w, lambda x: coalesce(m[x], x)), '') AS text, CAST(len(list_filter(w, lambda x: m[x] IS NOT NULL)) AS BIGINT) AS n FROM (SELECT doc_id, {_TOKENS} AS w, {_MARKS} AS m FROM {prepared_sql('documents', **MARKED)})")
def rewrite_marks(spark, d):  # C17
    return positions.spread(prepared(spark, d, "documents", **MARKED)).select("doc_id", rewrite.whole_words(F.col("text"), rewrite.MARKS).alias("r")).select("doc_id", "r.text", "r.n")


SPELLED = {"doc_id": "doc_id", "text": "replace(replace(replace(replace(text, 'the', 'wholesome roots'), 'and', 'Blessed Ones'), 'que', 'Three Jewels'), 'der', 'Expedient means')"}


@query(f"SELECT doc_id, {nested(rewrite.SPELLINGS)} AS text, CAST({literal_count(rewrite.SPELLINGS)} AS BIGINT) AS n FROM {prepared_sql('documents', **SPELLED)}")
def rewrite_spellings(spark, d):  # C18, its fixed rules
    return positions.spread(prepared(spark, d, "documents", **SPELLED)).select("doc_id", rewrite.literal(F.col("text"), rewrite.SPELLINGS).alias("r")).select("doc_id", "r.text", "r.n")


HEADED = {"doc_id": "doc_id", "text": "replace(replace(replace(replace(replace(text, '. ', '.' || chr(10)), chr(10) || 'E', chr(10) || '# E'), chr(10) || 'T', chr(10) || '## T'), 'the', 'Bath Hall'), 'que', 'Dharma Hall')"}
_COUNT_CASE = literal_count(rewrite.RUNNING_TEXT).replace("text", "l")


@query(
    f"SELECT doc_id, array_to_string(list_transform(ls, lambda l: CASE WHEN starts_with(l, '#') THEN l ELSE {nested(rewrite.RUNNING_TEXT, 'l')} END), chr(10)) AS text, "
    f"CAST(coalesce(list_sum(list_transform(ls, lambda l: CASE WHEN starts_with(l, '#') THEN 0 ELSE {_COUNT_CASE} END)), 0) AS BIGINT) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {prepared_sql('documents', **HEADED)})"
)
def heading_safe_rewrite(spark, d):  # C19
    return positions.spread(prepared(spark, d, "documents", **HEADED)).select("doc_id", rewrite.outside_headings(F.col("text"), rewrite.RUNNING_TEXT).alias("r")).select("doc_id", "r.text", "r.n")


DASHED = {"doc_id": "doc_id", "text": "replace(replace(replace(replace(replace(text, '. ', '.' || chr(10)), chr(10) || 'E', chr(10) || '# E'), ', ', '—'), ' et ', ' — '), ',' || chr(10), '— ' || chr(10))"}
_STEPS = "l"
for _a, _b in (("([\\p{L}\\p{N}_])—([^—]+)—([\\p{L}\\p{N}_])", "\\1, \\2, \\3"), ("([\\p{L}\\p{N}_])—([\\p{L}\\p{N}_])", "\\1; \\2"), ("—\\s*$", "..."), ("\\s—\\s", "; "), ("—", "; ")):
    _STEPS = f"regexp_replace({_STEPS}, '{_a}', '{_b}', 'g')"


@query(f"""
WITH x AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda l, i: CASE WHEN NOT contains(l, '—') THEN {{'t': l, 'n': 0}} WHEN starts_with(l, '#') THEN {{'t': replace(l, '—', ':'), 'n': length(l) - length(replace(l, '—', ''))}}
  WHEN i <= 8 THEN {{'t': l, 'n': 0}} ELSE {{'t': {_STEPS}, 'n': 1}} END) AS ls FROM {prepared_sql("documents", **DASHED)})
SELECT doc_id, array_to_string(list_transform(ls, lambda x: x.t), chr(10)) AS text, CAST(list_sum(list_transform(ls, lambda x: x.n)) AS BIGINT) AS n FROM x""")
def dash_rewrite(spark, d):  # C20, W6
    return positions.spread(prepared(spark, d, "documents", **DASHED)).select("doc_id", rewrite.dashes(F.col("text")).alias("r")).select("doc_id", "r.text", "r.n")


CLEANED = {"key": "doc_id", "text": "replace(replace(replace(replace(text, ' the ', ' sutra '), ' of ', ' wholesome roots '), ' la ', ' Bath Hall '), ', ', ' —')"}
_LINES = "SELECT key, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS i FROM d"


@query(f"""
WITH d AS {prepared_sql("documents", **CLEANED)}, l AS ({_LINES}),
c AS (SELECT 'marks' AS rule, key, len(list_filter({_TOKENS}, lambda x: list_contains([{", ".join(f"'{a}'" for a, _ in rewrite.MARKS)}], x))) AS n FROM d
  UNION ALL SELECT 'spellings', key, {literal_count(rewrite.SPELLINGS)} FROM d
  UNION ALL SELECT 'case', key, sum(CASE WHEN starts_with(l, '#') THEN 0 ELSE {_COUNT_CASE} END) FROM l GROUP BY key
  UNION ALL SELECT 'dashes', key, sum(CASE WHEN NOT contains(l, '—') THEN 0 WHEN starts_with(l, '#') THEN length(l) - length(replace(l, '—', '')) WHEN i < 8 THEN 0 ELSE 1 END) FROM l GROUP BY key)
SELECT rule, CAST(sum(n) AS BIGINT) AS fixes, CAST(count(*) FILTER (n > 0) AS BIGINT) AS texts FROM c GROUP BY rule HAVING sum(n) > 0""")
def fixes_by_rule(spark, d):  # A13 per class of rules
    return runs.cleanup_summary(runs.cleanup_run(prepared(spark, d, "documents", **CLEANED)))


# Glossaries from parts

CATEGORY = "CASE p_size % 9 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate((*glossary.CATEGORIES, "unlisted"))) + " END"
ENTRY = {
    "pos": "p_partkey", "english": "CASE WHEN p_partkey % 5 = 0 THEN replace(p_name, 'a', 'ā') ELSE p_name END || CASE WHEN p_partkey % 4 = 0 THEN 's' ELSE '' END",
    "chinese": "CASE WHEN p_size % 3 = 0 THEN '' ELSE replace(p_brand, 'Brand#', '品') END", "sanskrit": "CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN p_name ELSE p_type END", "category": CATEGORY, "kind": "p_type", "size": "'S' || (p_size % 4)",
}


def _entries(spark, d: str) -> DataFrame:
    return prepared(spark, d, "part", **ENTRY).withColumn("sources", F.array("kind", "size"))


_DEDUP = (
    f"WITH e AS (SELECT *, [kind, size] AS sources FROM {prepared_sql('part', **ENTRY)}), "
    f"a AS (SELECT *, row_number() OVER (PARTITION BY chinese, category ORDER BY NOT regexp_matches(english, '[{T.DIACRITICS}]'), length(english), english, pos) AS k, min(pos) OVER (PARTITION BY chinese, category) AS first_pos FROM e WHERE chinese <> ''), "
    "b AS (SELECT *, row_number() OVER (PARTITION BY rtrim(lower(english), 's'), category ORDER BY -len(sources), length(english), pos) AS k, min(pos) OVER (PARTITION BY rtrim(lower(english), 's'), category) AS first_pos FROM e WHERE chinese = ''), "
    "sa AS (SELECT chinese, category, list_sort(list_distinct(flatten(list(sources)))) AS s FROM a GROUP BY ALL), sb AS (SELECT rtrim(lower(english), 's') AS n, category, list_sort(list_distinct(flatten(list(sources)))) AS s FROM b GROUP BY ALL), "
    "u AS (SELECT english, chinese, sanskrit, category, s AS sources, first_pos, 0 AS part FROM a JOIN sa USING (chinese, category) WHERE k = 1 UNION ALL SELECT english, chinese, sanskrit, b.category, s, first_pos, 1 FROM b JOIN sb ON n = rtrim(lower(english), 's') AND sb.category = b.category WHERE k = 1) "
)


@query(_DEDUP + "SELECT english, chinese, category, array_to_string(sources, ';') AS sources FROM u")
def dedup_representative(spark, d):  # A6, A6b, X1, W4, C21, C22
    return glossary.dedup_by_source_term(_entries(spark, d)).select("english", "chinese", "category", F.array_join("sources", ";").alias("sources"))


@query(_DEDUP + "SELECT arg_min(english, (part, first_pos)) AS english, arg_min(category, (part, first_pos)) AS category, array_to_string(list_sort(list_distinct(flatten(list(sources)))), ';') AS sources FROM u GROUP BY lower(english)")
def cross_dedup(spark, d):  # A7
    merged = glossary.dedup_across_categories(glossary.dedup_by_source_term(_entries(spark, d)))
    return merged.select("english", "category", F.array_join("sources", ";").alias("sources"))


PUBLISHED = {
    "pos": "p_partkey", "english": "CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) || ' ' WHEN p_partkey % 11 = 0 THEN p_name || ' ' || p_brand ELSE p_name END", "sanskrit": "CASE WHEN p_partkey % 2 = 0 THEN '' ELSE p_brand END",
    "definition": "CASE p_size % 6 WHEN 0 THEN '' WHEN 1 THEN 'a Saint' WHEN 2 THEN 'a mountain land' WHEN 3 THEN 'meditation' WHEN 4 THEN 'the kalpa' ELSE 'a word' END", "source": "CASE WHEN p_partkey % 7 = 0 THEN 'Pub ' ELSE '' END || p_type",
}


@query(
    f"WITH l AS (SELECT lower(trim(english)) AS key, arg_max(english, pos) AS english, arg_max(chinese, pos) AS chinese, arg_max(sanskrit, pos) AS sanskrit, arg_max(category, pos) AS category FROM {prepared_sql('part', **ENTRY)} WHERE pos % 4 <> 1 GROUP BY 1), "
    f"r AS (SELECT lower(trim(english)) AS key, arg_min(english, pos) AS pe, arg_max(definition, pos) AS pd, arg_max(source, pos) AS ps, arg_min(sanskrit, pos) FILTER (sanskrit <> '') AS psk, arg_min(definition || ' ' || english, pos) AS hint FROM {prepared_sql('part', **PUBLISHED)} GROUP BY 1) "
    f"SELECT coalesce(english, pe) AS english, coalesce(chinese, '') AS chinese, coalesce(nullif(sanskrit, ''), psk, '') AS sanskrit, coalesce(category, {classify_sql('hint')}) AS category, coalesce(pd, '') AS definition, coalesce('Pub ' || ps, 'own') AS source FROM l FULL JOIN r USING (key)"
)
def overlay_merge(spark, d):  # J7, J7a, a prefix set twice where it is there
    return glossary.overlay(_entries(spark, d).where("pos % 4 <> 1"), prepared(spark, d, "part", **PUBLISHED), "Pub ")


@query(f"SELECT category, CAST(count(*) AS BIGINT) AS n, string_agg(english, ';' ORDER BY lower(english), english) AS terms, CAST(list_position(['" + "','".join(glossary.CATEGORIES) + f"'], category) AS BIGINT) AS rank FROM {prepared_sql('part', **ENTRY)} WHERE category <> 'unlisted' GROUP BY category")
def category_sections(spark, d):  # A8, O4
    return glossary.sections(_entries(spark, d))


LISTED = {**ENTRY, "definition": PUBLISHED["definition"], "source": "CASE WHEN p_partkey % 3 = 0 THEN 'own' ELSE 'Pub ' || p_type END"}


@query(f"SELECT pos, '**' || english || '**' || CASE WHEN chinese <> '' THEN ' (' || chinese || ')' ELSE '' END || CASE WHEN sanskrit <> '' AND sanskrit <> english THEN ' Skt. *' || sanskrit || '*' ELSE '' END || CASE WHEN definition <> '' THEN ': ' || definition ELSE '' END || CASE WHEN source = 'own' THEN '' ELSE ' [' || source || ']' END AS line FROM {prepared_sql('part', **LISTED)}")
def entry_lines(spark, d):  # C24
    return prepared(spark, d, "part", **LISTED).select("pos", glossary.render(*(F.col(c) for c in ("english", "chinese", "sanskrit", "definition", "source"))).alias("line"))


@query("SELECT p_name AS term, CASE WHEN p_size % 2 = 0 THEN p_type || '; x' ELSE '' END AS parenthetical, CASE WHEN p_size % 3 = 0 THEN 'A ' || p_type || chr(10) || 'kept.' ELSE p_brand END AS definition FROM part")
def glossary_markdown(spark, d):  # S16
    entry = F.expr("'**' || p_name || '**' || CASE WHEN p_size % 2 = 0 THEN ' (' || p_type || '; x)' ELSE '' END || ': ' || CASE WHEN p_size % 3 = 0 THEN 'A ' || p_type || chr(10) || 'kept.' ELSE p_brand END")
    pages = table(spark, d, "part").groupBy("p_brand").agg(F.concat(F.lit("# Title\n \n"), F.array_join(F.collect_list(entry), "\n\nplain\n\n"), F.lit("\n\n# End")).alias("text"))
    return pages.select(F.explode(glossary.parse_markdown(F.col("text"))).alias("e")).select("e.*")


_SEED = "t AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS pos FROM (SELECT DISTINCT unnest(string_split_regex(text, '\\s+')) AS term FROM benchmark) WHERE length(term) > 3)"


def _seed(spark, d: str) -> DataFrame:
    """Words of the benchmark as a table of seed terms, written and loaded."""
    words = table(spark, d, "benchmark").select(F.explode(F.split("text", r"\s+")).alias("english")).where(F.length("english") > 3).distinct()
    at = incremental.shared_folder(spark, "seed")
    files.write_seed(positions.with_positions(words, ["english"]).select("pos", "english", F.lit("").alias("chinese"), F.lit("").alias("sanskrit"), F.when(F.col("pos") % 2 == 0, "other").otherwise("title").alias("category")), at)
    return files.seed_terms(spark, at)


@query(f"WITH {_SEED} SELECT CAST(pos AS BIGINT) AS pos, term AS english, '' AS chinese, '' AS sanskrit, CASE WHEN pos % 2 = 0 THEN 'other' ELSE 'title' END AS category FROM t")
def seed_table(spark, d):  # S15
    return _seed(spark, d)


@query(f"""
WITH {_SEED},
e AS (SELECT term AS english, any_value(pos) AS pos, CASE WHEN any_value(pos) % 2 = 0 THEN 'other' ELSE 'title' END AS category, count(*) AS n FROM t JOIN documents ON contains(text, term) GROUP BY term),
b AS (SELECT *, row_number() OVER (PARTITION BY rtrim(lower(english), 's'), category ORDER BY n DESC, length(english), pos) AS k, min(pos) OVER (PARTITION BY rtrim(lower(english), 's'), category) AS first_pos FROM e),
c AS (SELECT arg_min(english, first_pos) AS english, arg_min(category, first_pos) AS category, min(first_pos) AS pos FROM b WHERE k = 1 GROUP BY lower(english)),
r AS (SELECT lower(trim(english)) AS key, arg_min(english, pos) AS pe, arg_max(definition, pos) AS pd, arg_max(source, pos) AS ps, arg_min(sanskrit, pos) FILTER (sanskrit <> '') AS psk, arg_min(definition || ' ' || english, pos) AS hint FROM {prepared_sql("part", **PUBLISHED)} GROUP BY 1),
l AS (SELECT lower(trim(english)) AS key, arg_max(english, pos) AS english, arg_max(category, pos) AS category FROM c GROUP BY 1)
SELECT coalesce(english, pe) AS english, '' AS chinese, coalesce(psk, '') AS sanskrit, coalesce(category, {classify_sql("hint")}) AS category, coalesce(pd, '') AS definition, coalesce(ps, 'own') AS source FROM l FULL JOIN r USING (key)""")
def glossary_of_documents(spark, d):  # the whole run: S15, J6, A6b, A7, J7, C23
    texts = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key"), "text")
    return runs.glossary_run(texts, _seed(spark, d), prepared(spark, d, "part", **PUBLISHED))


# Ids, headers and characters from parts, results from events

NAMES = {"p_partkey": "p_partkey", "name": "CASE p_size % 4 WHEN 0 THEN 'T01n' || p_partkey WHEN 1 THEN p_partkey || 'a' WHEN 2 THEN '000' || p_partkey || 'B' ELSE p_name END"}


@query(f"""
WITH n AS (SELECT *, regexp_extract(name, '(\\d+)[abAB]?$', 1) AS digits, regexp_extract(name, '\\d+([abAB]?)$', 1) AS suffix FROM {prepared_sql("part", **NAMES)})
SELECT p_partkey, CASE WHEN digits = '' THEN name ELSE 'T' || CASE WHEN length(ltrim(digits, '0')) >= 4 THEN ltrim(digits, '0') ELSE lpad(ltrim(digits, '0'), 4, '0') END || suffix END AS t_number FROM n""")
def text_numbers(spark, d):  # C15, C29
    return prepared(spark, d, "part", **NAMES).select("p_partkey", T.text_number(F.col("name")).alias("t_number"))


@query("SELECT conv_id, turn, 'T' || conv_id AS t_number, CAST(turn AS INT) AS fasc_num FROM conversations")
def composite_key_parse(spark, d):  # C28
    rows = prepared(spark, d, "conversations", conv_id="conv_id", turn="turn", custom_id="'T' || conv_id || '_fasc_0' || turn")
    return rows.select("conv_id", "turn", T.composite_key(F.col("custom_id")).alias("k")).select("conv_id", "turn", "k.*")


RESULTS = {"type": "event_type", "i": "CAST(floor(value) AS BIGINT)", "o": "user_id"}


@query(f"SELECT CAST(sum(i) AS BIGINT) AS tokens_in, CAST(sum(o) AS BIGINT) AS tokens_out, round(sum(i) / 1e6 * 2.50 + sum(o) / 1e6 * 12.50, 9) AS cost FROM {prepared_sql('events', **RESULTS)} WHERE type <> 'error'")
def batch_cost(spark, d):  # A14
    sums = prepared(spark, d, "events", **RESULTS).where("type <> 'error'").agg(F.sum("i").alias("tokens_in"), F.sum("o").alias("tokens_out"))
    return sums.withColumn("cost", F.round(catalog.cost(F.col("tokens_in"), F.col("tokens_out")), 9))


HEADER = (
    "'<t><titleStmt>' || CASE p_size % 4 WHEN 0 THEN '<title xml:lang=\"zh-Hant\" level=\"s\">series</title>' ELSE '' END || CASE WHEN p_size % 3 = 0 THEN '' ELSE '<title xml:lang=\"zh-Hant\" level=\"' || CASE WHEN p_size % 3 = 1 THEN 'm' ELSE 'x' END || '\"> ' || p_name || '</title>' END"
    " || '<author>' || p_brand || '</author></titleStmt>' || CASE WHEN p_size % 5 = 0 THEN '' ELSE '<extent>共' || p_size || '卷 12</extent>' END || CASE WHEN p_partkey % 13 = 0 THEN '<bad' ELSE '' END || '</t>'"
)
_BAD = "p_partkey % 13 = 0"


def _headers_sql(titled: str, missing: int) -> str:
    return f"SELECT CAST(p_partkey AS VARCHAR) AS path, CASE WHEN {_BAD} THEN '' WHEN {titled} THEN p_name ELSE '' END AS title, CASE WHEN {_BAD} THEN '' ELSE p_brand END AS author, CAST(CASE WHEN {_BAD} OR p_size % 5 = 0 THEN {missing} ELSE p_size END AS INT) AS extent FROM part"


@query(_headers_sql("p_size % 3 <> 0", 0))
def xml_header_fields(spark, d):  # S2
    return markup.xml_headers(prepared(spark, d, "part", path="CAST(p_partkey AS STRING)", xml=HEADER))


@query(_headers_sql("p_size % 3 = 1", 1))
def xml_main_headers(spark, d):  # S3: level m alone, extent 1 where none is given
    return markup.xml_headers(prepared(spark, d, "part", path="CAST(p_partkey AS STRING)", xml=HEADER), fallback=False, no_extent=1)


CHARACTERS = {
    "id": "p_type || (p_size % 7)", "kind": "CASE p_partkey % 4 WHEN 0 THEN 'unicode' WHEN 1 THEN 'normalized form' WHEN 2 THEN 'normal_unicode' ELSE 'other' END",
    "value": "CASE WHEN p_partkey % 5 = 0 THEN 'U+ZZ' WHEN p_partkey % 4 = 1 THEN p_name ELSE printf('U+%X', CAST(19968 + p_partkey AS INT)) END", "file_pos": "p_partkey // 3", "n": "19968 + p_partkey",
}


@query(f"""
WITH c AS (SELECT id, file_pos, CASE kind WHEN 'normalized form' THEN 1 WHEN 'normal_unicode' THEN 2 WHEN 'unicode' THEN 3 END AS k, CASE WHEN kind = 'normalized form' THEN value WHEN value <> 'U+ZZ' THEN chr(CAST(n AS INT)) END AS v FROM {prepared_sql("part", **CHARACTERS)})
SELECT id, min(v) AS value FROM (SELECT *, rank() OVER (PARTITION BY id ORDER BY file_pos, k) AS r FROM c WHERE v IS NOT NULL AND k IS NOT NULL) WHERE r = 1 GROUP BY id""")
def character_map(spark, d):  # S5, C25, A16
    return markup.character_map(prepared(spark, d, "part", **(CHARACTERS | {"file_pos": "p_partkey div 3"})))


# Web catalogues from pages

_TITLE = "replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), chr(92), ''), chr(10), ' ')"
_QUOTE = "CASE WHEN page_id % 3 = 0 THEN chr(92) || chr(92) || '\"' ELSE chr(92) || '\"' END"
CATALOGUE = {
    "page_id": "page_id", "title": _TITLE,
    "html": f"CASE WHEN page_id % 5 = 0 THEN 'none' ELSE 'x data-n=' || {_QUOTE} || page_id || 'a_' || (50 + page_id % 40) || {_QUOTE} || '>T' || page_id || 'b ' || {_TITLE} || '</span> data-n=' || {_QUOTE} || '7_60' || {_QUOTE} || '>T7  x </span>' END",
}


@query(f"""
WITH c AS {prepared_sql("pages", **CATALOGUE)}
SELECT page_id, page_id || 'a' AS web_id, CAST(50 + page_id % 40 AS INT) AS volume, 'T' || page_id || 'b' AS t_number, trim(title) AS title FROM c WHERE page_id % 5 <> 0 AND 50 + page_id % 40 BETWEEN 56 AND 84 AND trim(title) <> ''
UNION ALL SELECT page_id, '7', 60, 'T7', 'x' FROM c WHERE page_id % 5 <> 0""")
def web_catalogue(spark, d):  # S9: fallback pattern and range of volumes
    found = markup.catalogue_entries(F.col("html"), (56, 84))
    return prepared(spark, d, "pages", **CATALOGUE).select("page_id", F.explode(found).alias("e")).select("page_id", "e.*")


ABOUT = {
    "page_id": "page_id", "title": _TITLE,
    "html": f"'<div>' || {_TITLE} || CASE WHEN page_id % 4 = 0 THEN '' ELSE ' (No. <a href=\"x\">' || page_id || '</a>  ' || CASE page_id % 3 WHEN 0 THEN '<a href=\"y\">n' || page_id || '</a> r , <a>m</a>s' WHEN 1 THEN 'plain <b>' || page_id || '</b>' ELSE '' END || ' ) in Vol. 1' END",
}


@query(f"""
SELECT page_id, CASE WHEN page_id % 4 = 0 THEN NULL ELSE nullif(trim(title), '') END AS title, CASE WHEN page_id % 4 = 0 THEN '' WHEN page_id % 3 = 0 THEN 'n' || page_id || 'r ,ms' WHEN page_id % 3 = 1 THEN 'plain ' || page_id ELSE '' END AS author
FROM {prepared_sql("pages", **ABOUT)} WHERE trim(title) <> ''""")
def titles_and_authors(spark, d):  # S12
    rows = prepared(spark, d, "pages", **ABOUT).where("trim(title) <> ''")
    return rows.select("page_id", markup.title_and_author(F.col("html")).alias("x")).select("page_id", "x.*")


_STARTS = "SELECT page_id, l, i FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1)) AS l, unnest(range(len(regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1)))) AS i FROM pages)"


@query(f"SELECT page_id, printf('%04d%s%02d', page_id % 10000, chr(CAST(97 + i % 3 AS INT)), i // 3) AS ref, l AS title, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INT) AS idx FROM ({_STARTS}) WHERE l <> '' AND NOT contains(l, '<')")
def scraped_starts(spark, d):  # S10: starts of sections with their titles
    ref = lambda i: F.format_string("%04d%s%02d", F.col("page_id") % 10000, F.element_at(F.array(*map(F.lit, "abc")), i % 3 + 1), F.floor(i / 3).cast("int"))
    span = lambda l, i: F.concat(F.lit('<span class="scrln" x="1" n="'), ref(i), F.lit('" id="y">'), l, F.lit("</span> <span n=\"0001a01\">no</span>"))  # noqa: E731, E741
    pages = table(spark, d, "pages").select("page_id", F.array_join(F.transform(markup.links(F.col("html")), span), "\n").alias("html"))
    return pages.select("page_id", F.explode(markup.section_starts(F.col("html"))).alias("s")).select("page_id", "s.*")


# Small forms of catalogues

@query("SELECT CAST(conv_id AS VARCHAR) || '.' || turn AS id, CAST((turn * 7 + conv_id % 5) * 60 + conv_id % 60 AS BIGINT) AS seconds, conv_id % 2 = 0 AS shared FROM conversations")
def timings(spark, d):  # S19: m:ss with a mark for shared times
    rows = prepared(spark, d, "conversations", id="CAST(conv_id AS STRING) || '.' || turn", time="(turn * 7 + conv_id % 5) || ':' || lpad(CAST(conv_id % 60 AS STRING), 2, '0') || CASE WHEN conv_id % 2 = 0 THEN '*' ELSE '' END")
    return rows.select("id", T.minutes_and_seconds(F.col("time")).alias("t")).select("id", "t.*")


@query("SELECT 'both' AS side, d.doc_id FROM documents d JOIN labels l ON l.doc_id = d.doc_id AND l.quality = 1 WHERE d.n_chars > 500 UNION ALL SELECT 'left', doc_id FROM documents WHERE n_chars > 500 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1) UNION ALL SELECT 'right', doc_id FROM labels WHERE quality = 1 AND doc_id NOT IN (SELECT doc_id FROM documents WHERE n_chars > 500)")
def paired_sides(spark, d):  # J11: pairs, and misses of either side
    left, right = table(spark, d, "documents").where("n_chars > 500").select("doc_id"), table(spark, d, "labels").where("quality = 1").select("doc_id")
    return catalog.paired(left, right, "doc_id").select("side", "doc_id")


@query("SELECT doc_id, CASE WHEN n_chars <= 3000 THEN 'whole' WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.doc_id % 300 > 100) THEN 'sections' ELSE 'skipped' END AS route FROM documents d")
def routed_by_file_size(spark, d):  # files of up to 100 bytes count as none
    files = table(spark, d, "labels").select("doc_id", (F.col("doc_id") % 300).alias("bytes"))
    return catalog.routed(table(spark, d, "documents").select("doc_id", "n_chars"), catalog.real_files(files, "bytes"), "doc_id", "n_chars", 3000).select("doc_id", "route")


@query("SELECT 'ids' AS chosen, doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) UNION ALL SELECT 'tier', doc_id FROM documents WHERE n_chars // 1000 = 2 UNION ALL SELECT 'all', doc_id FROM documents")
def chosen_texts(spark, d):  # by ids, by tier, or else all
    docs = table(spark, d, "documents").select("doc_id", F.floor(F.col("n_chars") / 1000).alias("tier"))
    ids = table(spark, d, "labels").where("quality = 0").select("doc_id")
    parts = [catalog.chosen(docs, "doc_id", ids=ids), catalog.chosen(docs, "doc_id", tier=2), catalog.chosen(docs, "doc_id")]
    named = [p.select(F.lit(n).alias("chosen"), "doc_id") for n, p in zip(("ids", "tier", "all"), parts, strict=True)]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("SELECT conv_id, CAST(count(*) FILTER (length(text) >= 50 AND role <> 'system') AS BIGINT) AS drafts, CAST(count(*) FILTER (length(text) >= 100 AND role <> 'system') AS BIGINT) AS reviews, CAST(count(*) FILTER (role = 'system') AS BIGINT) AS failed, CAST(count(*) FILTER (length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) = 0) AS BIGINT) AS empty FROM conversations GROUP BY conv_id")
def results_by_validity(spark, d):  # both thresholds, errors, and texts without content
    rows = table(spark, d, "conversations").select("conv_id", "text", F.when(F.col("role") == "system", "refused").alias("error"))
    ok = lambda least: F.count_if(catalog.valid(F.col("text"), F.col("error"), least))
    content = T.count_class(F.col("text"), "a-zA-Z")
    return rows.groupBy("conv_id").agg(ok(catalog.LEAST_DRAFT).alias("drafts"), ok(catalog.LEAST_REVIEW).alias("reviews"), F.count("error").alias("failed"), F.count_if(content == 0).alias("empty"))


# Files, written and read back

def _folder(spark, name: str) -> str:
    return incremental.shared_folder(spark, name)


@query("SELECT conv_id || '/chunk_' || printf('%04d', row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) || '.txt' AS name, text AS content FROM conversations WHERE text <> ''")
def chunk_files(spark, d):  # K4
    at = _folder(spark, "chunks")
    numbered = chunking.numbered(table(spark, d, "conversations").where("text <> ''"), "conv_id", "turn")
    store.write_chunks(numbered.withColumn("no", F.col("i") - 1), at, "conv_id", "no", "text")
    return store.read_files(spark, at)


@query("""SELECT doc_id || '_meta.json' AS name, '{"doc_id":' || doc_id || ',"lang":"' || lang || '","n_chars":' || n_chars || ',"author":null,"n_letters":' || length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) || '}' AS content FROM documents WHERE lang IS NOT NULL""")
def metadata_files(spark, d):  # K2
    at = _folder(spark, "metadata")
    docs = positions.spread(table(spark, d, "documents").where("lang IS NOT NULL"))
    store.write_metadata(docs.select("doc_id", "lang", "n_chars", F.lit(None).cast("string").alias("author"), T.count_class(F.col("text"), "a-zA-Z").alias("n_letters")), at, "doc_id")
    return store.read_files(spark, at)


@query(
    "SELECT conv_id || '_translation.md' AS name, '# Conversation ' || conv_id || chr(10) || 'No. ' || conv_id || chr(10) || chr(10) || CASE WHEN conv_id % 2 = 0 THEN 'By ' || conv_id || chr(10) || chr(10) ELSE '' END || '---' || chr(10) || chr(10) "
    "|| string_agg(text, chr(10) || chr(10) ORDER BY turn) AS content FROM conversations GROUP BY conv_id"
)
def translation_files(spark, d):  # K6, A10
    at = _folder(spark, "translations")
    whole = chunking.reassemble(table(spark, d, "conversations"), "conv_id", "turn", "text", "\n\n")
    number = F.col("conv_id").cast("string")
    store.write_translations(whole, at, "conv_id", F.concat(F.lit("Conversation "), number), F.concat(F.lit("No. "), number), F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("By "), number)), "text")
    return store.read_files(spark, at)


@query(
    "SELECT printf('%02d_', list_position(['" + "','".join(glossary.CATEGORIES) + "'], category)) || category || '.md' AS name, '# ' || category || ' (' || count(*) || ')' || chr(10) || chr(10) "
    f"|| string_agg('**' || english || '** ' || kind, chr(10) || chr(10) ORDER BY lower(english), english, '**' || english || '** ' || kind) || chr(10) AS content FROM {prepared_sql('part', **ENTRY)} WHERE category <> 'unlisted' GROUP BY category"
)
def glossary_files(spark, d):  # K8, A8
    at = _folder(spark, "glossary")
    entries = _entries(spark, d).withColumn("line", F.concat(F.lit("**"), "english", F.lit("** "), "kind"))
    store.write_glossary(entries, at, "category", "english", "line", glossary.CATEGORIES)
    return store.read_files(spark, at)


@query("SELECT 'T' || conv_id AS key, arg_max(text, turn % 3 * 1000 + turn) AS text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 3 ORDER BY turn DESC) AS k FROM conversations WHERE text <> '') WHERE k = 1 GROUP BY conv_id")
def texts_by_key(spark, d):  # S8: of the files of one key the last name wins
    at = _folder(spark, "texts")
    rows = table(spark, d, "conversations").where("text <> ''")
    last = rows.groupBy("conv_id", (F.col("turn") % 3).alias("s")).agg(F.max_by("text", "turn").alias("text"))
    suffix = F.element_at(F.array(F.lit(""), F.lit("a"), F.lit("b")), (F.col("s") + 1).cast("int"))
    store.write_files(last, at, F.concat(F.lit("T"), F.col("conv_id").cast("string"), suffix, F.lit(".txt")), F.col("text"))
    return files.texts(spark, at, r"/(T\d+)[ab]?\.txt$")


@query("SELECT conv_id || '.txt' AS name, CAST(sum(strlen(text)) AS BIGINT) AS length FROM conversations WHERE text <> '' GROUP BY conv_id")
def file_listing(spark, d):  # S20
    at = _folder(spark, "listed")
    rows = joined_turns(table(spark, d, "conversations").where("text <> ''"), "text")
    store.write_files(rows, at, F.concat(F.col("conv_id").cast("string"), F.lit(".txt")), F.col("text"))
    return files.listing(spark, at).select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")


# Answers and notes

ANSWER = "CASE turn % 4 WHEN 0 THEN NULL WHEN 1 THEN 'not json' WHEN 2 THEN '{\"result\":\"\",\"session_id\":\"s' || conv_id || '\"}' ELSE '{\"result\":\"' || role || '\",\"session_id\":\"s' || conv_id || '\",\"cost\":1}' END"


@query("SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN role END AS result, CASE WHEN turn % 4 > 1 THEN 's' || conv_id END AS session_id, CASE turn % 4 WHEN 0 THEN 'no output' WHEN 1 THEN 'not an answer' WHEN 2 THEN 'empty result' END AS error FROM conversations")
def parsed_replies(spark, d):  # U3
    rows = prepared(spark, d, "conversations", conv_id="conv_id", turn="turn", answer=ANSWER)
    return rows.select("conv_id", "turn", external.parsed_reply(F.col("answer")).alias("r")).select("conv_id", "turn", "r.*")


@query(f"SELECT conv_id || '.' || turn AS path, {TRIM.format('text')} || '{{引}}{{二合}}' AS text FROM conversations WHERE {TRIM.format('text')} <> ''")
def spoken_notes(spark, d):  # C26
    rows = prepared(spark, d, "conversations", path="conv_id || '.' || turn", text="text", xml=f"'<t><p type=\"dharani\">' || {ESCAPED} || '<note place=\"inline\">引、x,二合</note><note>去</note></p></t>'")
    return markup.xml_blocks(rows.where(F.regexp_replace("text", r"\s", "") != "")).select("path", F.regexp_replace("text", r"\s*(\{引\}\{二合\})$", "$1").alias("text"))
