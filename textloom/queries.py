"""Queries of the engine and the SQL that says the same.

"extension".
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom import table_queries  # noqa: F401  registers its queries
from textloom.functions import text as T
from textloom.operators import attestation, catalog, chunking, glossary, positions, rewrite, segments
from textloom.registry import ORACLES, QUERIES, classify_sql, literal_count, nested, query, table  # noqa: F401
from textloom.sources import markup, paged, store
from textloom.streaming import claims, incremental, polled

TERMS = ["the", "of", "la", "der", "token", "tion", "ement", "License", "heit", "ación", "zzzz"]
WORD = r"(^|[^\p{L}\p{N}_])"


# J6, A18
def _attested_sql(terms: list[str]) -> str:
    tests = " UNION ALL ".join(
        f"SELECT '{t}' AS term, doc_id FROM documents WHERE " + (f"regexp_matches(text, '{WORD}{t}($|[^\\p{{L}}\\p{{N}}_])')" if len(t) <= 3 else f"contains(text, '{t}')") for t in terms
    )
    return f"SELECT term, CAST(count(DISTINCT doc_id) AS BIGINT) AS n_texts, min(doc_id) AS first_key FROM ({tests}) GROUP BY term"


@query(_attested_sql(TERMS))
def term_attestation(spark, d):
    return attestation.attestation(table(spark, d, "documents"), "doc_id", "text", TERMS)


@query(_attested_sql(["un", "in", "is", "de"]))
def short_term_boundary(spark, d):
    return attestation.attestation(table(spark, d, "documents"), "doc_id", "text", ["un", "in", "is", "de"])


@query(f"SELECT *, CAST(row_number() OVER (ORDER BY n_texts DESC, term) - 1 AS BIGINT) AS place FROM ({_attested_sql(TERMS)}) WHERE n_texts >= 20")
def frequent_terms(spark, d):  # A18
    return positions.with_positions(term_attestation(spark, d).where("n_texts >= 20").withColumn("less", -F.col("n_texts")), ["less", "term"], "place").drop("less")


@query(r"""
WITH t AS (SELECT DISTINCT unnest(string_split_regex(text, '\s+')) AS term FROM benchmark),
w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS word FROM documents),
o AS (SELECT term, doc_id, string_split(text, term) AS p FROM t JOIN documents ON length(term) BETWEEN 1 AND 3 AND NOT regexp_full_match(term, '[\p{L}\p{N}_]+') AND contains(text, term)),
x AS (SELECT term, doc_id FROM t JOIN documents ON length(term) > 3 AND contains(text, term)
  UNION ALL SELECT term, doc_id FROM t JOIN w ON word = term AND length(term) <= 3
  UNION ALL SELECT term, doc_id FROM o WHERE len(list_filter(range(1, len(p)), lambda i: NOT regexp_matches(right(CASE WHEN p[i] = '' AND i > 1 THEN term ELSE p[i] END, 1), '[\p{L}\p{N}_]')
    AND NOT regexp_matches(left(CASE WHEN p[i + 1] = '' AND i + 1 < len(p) THEN term ELSE p[i + 1] END, 1), '[\p{L}\p{N}_]'))) > 0)
SELECT term, CAST(count(*) AS BIGINT) AS n_texts, min(doc_id) AS first_key FROM x GROUP BY term""")
def benchmark_word_attestation(spark, d):  # J6 at the size of a glossary, S15
    terms = table(spark, d, "benchmark").select(F.explode(F.split("text", r"\s+")).alias("term"))
    return attestation.attestation(table(spark, d, "documents"), "doc_id", "text", terms)


@query("SELECT lang, CAST(sum(length(regexp_replace(text, '[^a-zA-Z]', '', 'g'))) AS BIGINT) AS letters, CAST(count(*) AS BIGINT) AS docs FROM documents GROUP BY lang")
def letter_count_by_lang(spark, d):
    docs = table(spark, d, "documents")
    return docs.groupBy("lang").agg(F.sum(T.count_class(F.col("text"), "a-zA-Z")).alias("letters"), F.count("*").alias("docs"))


@query("SELECT CASE WHEN s <= 1 THEN '1' WHEN s <= 5 THEN '2-5' WHEN s <= 20 THEN '6-20' WHEN s <= 60 THEN '21-60' ELSE '>60' END AS size, CAST(count(*) AS BIGINT) AS n FROM (SELECT len(string_split(text, chr(10))) AS s FROM documents) GROUP BY 1")
def size_histogram(spark, d):  # A2
    lines = table(spark, d, "documents").select(F.size(F.split("text", "\n", -1)).alias("s"))
    return lines.groupBy(catalog.size_class(F.col("s")).alias("size")).agg(F.count("*").alias("n"))


DOMAIN = ["en", "fr", "de", "es", "it", "zh"]


@query("SELECT v.lang, CAST(coalesce(n, 0) AS BIGINT) AS n FROM " + "(VALUES " + ", ".join(f"('{x}')" for x in DOMAIN) + ") AS v(lang)" + " LEFT JOIN (SELECT lang, count(*) AS n FROM documents GROUP BY lang) c ON c.lang = v.lang")
def zero_filled_counts(spark, d):  # A4
    return catalog.zero_filled(table(spark, d, "documents"), "lang", DOMAIN)


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def untranslated_anti(spark, d):  # J1, X2
    return catalog.outstanding(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), "doc_id")


@query("SELECT doc_id FROM labels l WHERE quality = 1 AND NOT EXISTS (SELECT 1 FROM labels r WHERE r.doc_id = l.doc_id AND r.toxic = 1)")
def reviewed_anti(spark, d):  # J3
    labels = table(spark, d, "labels")
    return catalog.outstanding(labels.where("quality = 1").select("doc_id"), labels.where("toxic = 1"), "doc_id")


@query("SELECT d.doc_id, d.n_chars, l.quality FROM documents d JOIN labels l ON l.doc_id = d.doc_id")
def pair_join(spark, d):  # J4, J11
    return table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id")


@query("SELECT d.doc_id, CASE WHEN n_chars <= 3000 THEN 'whole' WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) THEN 'sections' ELSE 'skipped' END AS route FROM documents d")
def large_with_splits(spark, d):  # F11, J5
    return catalog.routed(table(spark, d, "documents").select("doc_id", "n_chars"), table(spark, d, "labels"), "doc_id", "n_chars", 3000).select("doc_id", "route")


@query("SELECT doc_id, source FROM documents WHERE doc_id >= coalesce((SELECT min(doc_id) FROM documents WHERE source >= 'src7'), 0)")
def catalog_start_cut(spark, d):  # F1
    return catalog.from_start(table(spark, d, "documents").select("doc_id", "source"), "source", "src7", "doc_id")


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars, doc_id LIMIT 25")
def small_first_topk(spark, d):  # O1, O2, O7
    return table(spark, d, "documents").select("doc_id", "n_chars").orderBy("n_chars", "doc_id").limit(25)


@query("SELECT doc_id, CAST(count(*) FILTER (l <> '' AND (regexp_matches(l, '^No\\.\\s*\\d+') OR NOT regexp_matches(l, '[^\\x{0}-\\x{1FFF}]'))) AS BIGINT) AS noise, CAST(count(*) AS BIGINT) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) GROUP BY doc_id")
def line_noise_filter(spark, d):  # F10
    lines = F.split("text", "\n", -1)
    return table(spark, d, "documents").select("doc_id", F.size(F.filter(lines, lambda x: T.is_noise_line(x))).cast("long").alias("noise"), F.size(lines).cast("long").alias("n"))


_PACK = """
WITH RECURSIVE items AS ({items}),
r AS (SELECT {key}, i, n AS cur, 1 AS chunk FROM items WHERE i = 1
  UNION ALL SELECT x.{key}, x.i, CASE WHEN r.cur + x.n > {cap} THEN x.n ELSE r.cur + x.n END, CASE WHEN r.cur + x.n > {cap} THEN r.chunk + 1 ELSE r.chunk END
  FROM r JOIN items x ON x.{key} = r.{key} AND x.i = r.i + 1)"""


@query(
    _PACK.format(items="SELECT doc_id, l, length(l) AS n, i FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)", key="doc_id", cap=800)
    + " SELECT r.doc_id, CAST(r.chunk AS BIGINT) AS chunk_no, CAST(sum(items.n) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS items, string_agg(l, chr(10) ORDER BY r.i) AS text FROM r JOIN items ON items.doc_id = r.doc_id AND items.i = r.i GROUP BY r.doc_id, r.chunk"
)
def greedy_chunks(spark, d):  # W3, C10
    chunks = chunking.greedy(F.split("text", "\n", -1), F.length, 800, "\n")
    return table(spark, d, "documents").select("doc_id", F.posexplode(chunks)).select("doc_id", (F.col("pos") + 1).cast("long").alias("chunk_no"), "col.n", "col.items", "col.text")


@query(r"""
WITH RECURSIVE p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents),
q AS (SELECT doc_id, t, i, length(t) > 600 AS large, lag(length(t) > 600) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM p),
z AS (SELECT doc_id, t, i, large, sum(CASE WHEN before IS NULL OR before OR large THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM q),
k AS (SELECT doc_id, run, i, large, CASE WHEN large THEN string_split(regexp_replace(t, '([.!?] )', '\1' || chr(1), 'g'), chr(1)) ELSE [t] END AS ls FROM z),
s AS (SELECT doc_id, run, i, large, unnest(ls) AS l, unnest(range(len(ls))) AS j FROM k),
items AS (SELECT doc_id, run, large, l, length(l) AS n, row_number() OVER (PARTITION BY doc_id, run ORDER BY i, j) AS i FROM s),
r AS (SELECT doc_id, run, i, n AS cur, 1 AS chunk FROM items WHERE i = 1
  UNION ALL SELECT x.doc_id, x.run, x.i, CASE WHEN r.cur + x.n > 600 THEN x.n ELSE r.cur + x.n END, CASE WHEN r.cur + x.n > 600 THEN r.chunk + 1 ELSE r.chunk END
  FROM r JOIN items x ON x.doc_id = r.doc_id AND x.run = r.run AND x.i = r.i + 1),
c AS (SELECT r.doc_id, r.run, r.chunk, sum(items.n) AS n, CASE WHEN bool_or(large) THEN array_to_string(list(l ORDER BY r.i), '') ELSE array_to_string(list(l ORDER BY r.i), chr(10)) END AS text
  FROM r JOIN items ON items.doc_id = r.doc_id AND items.run = r.run AND items.i = r.i GROUP BY r.doc_id, r.run, r.chunk)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY run, chunk) AS BIGINT) AS chunk_no, CAST(n AS BIGINT) AS n, text FROM c""")
def two_level_chunks(spark, d):  # C9
    chunks = chunking.two_level(F.col("text"), F.length, 600, "\n", r"(?<=[.!?] )", "\n")
    return table(spark, d, "documents").select("doc_id", F.posexplode(chunks)).select("doc_id", (F.col("pos") + 1).cast("long").alias("chunk_no"), "col.n", "col.text")


@query("SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS i, CAST(count(*) OVER (PARTITION BY conv_id) AS BIGINT) AS n FROM conversations")
def chunk_of_n(spark, d):  # W5
    return chunking.numbered(table(spark, d, "conversations").select("conv_id", "turn"), "conv_id", "turn")


@query("WITH s AS (SELECT user_id, ts, event_id AS section FROM events WHERE event_type = (SELECT min(event_type) FROM events)) SELECT e.event_id, coalesce(arg_max(s.section, (s.ts, s.section)) FILTER (s.ts <= e.ts), arg_min(s.section, (s.ts, s.section))) AS section FROM events e LEFT JOIN s ON s.user_id = e.user_id GROUP BY e.event_id, e.ts")
def asof_segments(spark, d):  # J8, W2
    events = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    kind = events.agg(F.min("event_type").alias("k"))
    starts = events.join(F.broadcast(kind), F.col("event_type") == F.col("k")).groupBy("user_id", "ts").agg(F.max("event_id").alias("section"))
    return segments.as_of(events.drop("event_type"), starts, "user_id", "ts", "section").select("event_id", "section")


@query("WITH l AS (SELECT doc_id, i, l, sum(CASE WHEN l = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM (SELECT doc_id, unnest(string_split(replace(text, '. ', chr(10) || chr(10)), chr(10))) AS l, unnest(range(len(string_split(replace(text, '. ', chr(10) || chr(10)), chr(10))))) AS i FROM documents)) SELECT doc_id, CAST(g AS BIGINT) AS island, CAST(count(*) AS BIGINT) AS n_lines, string_agg(l, '' ORDER BY i) AS paragraph FROM l WHERE trim(l) <> '' GROUP BY doc_id, g")
def island_paragraphs(spark, d):  # W1
    text = F.replace(F.col("text"), F.lit(". "), F.lit("\n\n"))
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split(text, "\n", -1)).alias("i", "l"))
    return segments.paragraphs(lines, "doc_id", "i", "l").drop("first")


#: Starts of sections by the length of their lines, so that some run back, some stand on noise, and some come after the last line.
_LINES = "l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)"
_SECTIONED = rf"""
{_LINES},
k AS (SELECT doc_id, i, t FROM (SELECT doc_id, i, regexp_replace(l, '^\s+|\s+$', '', 'g') AS t FROM l) WHERE NOT (t <> '' AND (regexp_matches(t, '^No\.\s*\d+') OR NOT regexp_matches(t, '[^\x{{0}}-\x{{7F}}]')))),
s AS (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id ORDER BY length(l), i) - 1 AS idx, string_split(l, ' ')[1] AS title FROM l WHERE length(l) % 5 = 0),
e AS (SELECT doc_id, idx, max(i) OVER (PARTITION BY doc_id ORDER BY idx) AS reached FROM s WHERE idx > 0),
p AS (SELECT k.doc_id, k.i, any_value(k.t) AS t, count(e.idx) AS section FROM k LEFT JOIN e ON e.doc_id = k.doc_id AND e.reached <= k.i GROUP BY k.doc_id, k.i),
b AS (SELECT *, lag(section) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM p),
h AS (SELECT doc_id, i, unnest(range(coalesce(before + 1, least(section, 1)), section + 1)) AS idx FROM b),
r AS (SELECT *, sum(CASE WHEN t = '' OR section <> before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM b),
v AS (SELECT h.doc_id, h.i, 0 AS k, 'header' AS kind, h.idx AS section, s.title AS content FROM h JOIN s ON s.doc_id = h.doc_id AND s.idx = h.idx
  UNION ALL SELECT doc_id, min(i), 1, 'paragraph', min(section), string_agg(t, '' ORDER BY i) FROM r WHERE t <> '' GROUP BY doc_id, run),
events AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i, k, section) AS BIGINT) AS seq, kind, CAST(section + 1 AS BIGINT) AS section, content FROM v)"""


def _sectioned(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "l"))
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.length("l"), "i")) - 1
    starts = lines.where(F.length("l") % 5 == 0).select("doc_id", "i", nth.alias("idx"), F.split_part("l", F.lit(" "), F.lit(1)).alias("title"))
    return lines, starts


@query(f"WITH {_SECTIONED} SELECT * FROM events")
def sectioned_text(spark, d):  # J8 in full, S10, F10, W1
    lines, starts = _sectioned(spark, d)
    return segments.sectioned_text(lines, starts, "doc_id", "i", "l", lambda t: T.is_noise_line(t, "80"))


@query(
    f"WITH {_SECTIONED}, x AS (SELECT doc_id, string_agg(CASE kind WHEN 'header' THEN chr(10) || repeat('=', 40) || chr(10) || 'Fascicle ' || printf('%03d', section) || ': ' || content || chr(10) || repeat('=', 40) || chr(10) ELSE content END, chr(10) ORDER BY seq) AS body FROM events GROUP BY doc_id), "
    "n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id) SELECT d.doc_id, CAST(coalesce(n.n, 1) AS BIGINT) AS n_sections, x.body FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN x ON x.doc_id = d.doc_id"
)
def sectioned_bodies(spark, d):  # J8 (1 section without starts), K1, C14
    lines, starts = _sectioned(spark, d)
    events = segments.sectioned_text(lines, starts, "doc_id", "i", "l", lambda t: T.is_noise_line(t, "80"))
    counts = segments.section_counts(table(spark, d, "documents"), starts, "doc_id")
    return counts.join(segments.rendered_sections(events, "doc_id"), "doc_id", "left")


@query("SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text, CAST(count(*) AS BIGINT) AS parts FROM conversations GROUP BY conv_id")
def ordered_reassembly(spark, d):  # A10
    return chunking.reassemble(table(spark, d, "conversations"), "conv_id", "turn", "text", "\n\n")


ASCII_RULES = (("the", "THE"), ("of", "uv"), ("THE", "tHe"), ("la", "LA"))


@query(f"SELECT doc_id, {nested(ASCII_RULES)} AS text, CAST({literal_count(ASCII_RULES)} AS BIGINT) AS n FROM documents")
def rewrite_text(spark, d):  # C18
    return table(spark, d, "documents").select("doc_id", rewrite.literal(F.col("text"), ASCII_RULES).alias("r")).select("doc_id", "r.text", "r.n")


@query(f"SELECT CAST(sum(n) AS BIGINT) AS total, CAST(count(*) FILTER (n > 0) AS BIGINT) AS changed FROM (SELECT {literal_count(ASCII_RULES)} AS n FROM documents)")
def rewrite_counts(spark, d):  # A13
    return rewrite_text(spark, d).agg(F.sum("n").alias("total"), F.count_if(F.col("n") > 0).alias("changed"))


@query(f"SELECT item_id, {classify_sql('text')} AS category FROM benchmark UNION ALL SELECT doc_id + 1000000, {classify_sql('text')} FROM documents")
def keyword_classify(spark, d):  # C23
    a = table(spark, d, "benchmark").select("item_id", glossary.classify(F.col("text")).alias("category"))
    return a.unionByName(table(spark, d, "documents").select((F.col("doc_id") + 1000000).alias("item_id"), glossary.classify(F.col("text")).alias("category")))


@query("SELECT lang, CAST(count(DISTINCT w) AS BIGINT) AS words, CAST(count(*) FILTER (starts_with(w, 'th')) AS BIGINT) AS th FROM (SELECT lang, unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY lang")
def distinct_words(spark, d):  # A5, A9
    words = table(spark, d, "documents").select("lang", F.explode(F.split("text", " ", -1)).alias("w"))
    return words.groupBy("lang").agg(F.count_distinct("w").alias("words"), F.count_if(F.startswith("w", F.lit("th"))).alias("th"))


@query("SELECT doc_id, CAST(n_chars // 2 + 812 // 4 AS BIGINT) AS tokens_in, CAST(2 * (n_chars // 2 + 812 // 4) AS BIGINT) AS tokens_out FROM documents")
def cost_estimate(spark, d):  # A14b
    return table(spark, d, "documents").select("doc_id", catalog.estimate(F.col("n_chars"), 812).alias("e")).select("doc_id", "e.*")


@query("SELECT event_type AS status, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type")
def status_counters(spark, d):  # A15
    return table(spark, d, "events").groupBy(F.col("event_type").alias("status")).agg(F.count("*").alias("n"))


@query("SELECT lang, CAST(round_even(sum(n_chars) / (count(*) * 7.0 / 3600), 0) AS DOUBLE) AS rate FROM documents GROUP BY lang")
def rate_summary(spark, d):  # A3, C27
    sums = table(spark, d, "documents").groupBy("lang").agg(F.sum("n_chars").alias("total"), (F.count("*") * 7.0).alias("seconds"))
    return sums.select("lang", catalog.hourly_rate(F.col("total"), F.col("seconds")).alias("rate"))


@query("SELECT page_id, CAST(len(regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1)) AS BIGINT) AS n_links, array_to_string(regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1), ' ') AS targets FROM pages")
def html_anchor_extract(spark, d):  # extension: targets of links
    found = markup.links(F.col("html"))
    return table(spark, d, "pages").select("page_id", F.size(found).cast("long").alias("n_links"), F.array_join(found, " ").alias("targets"))


@query("SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS text FROM pages")
def html_strip(spark, d):  # C31
    return table(spark, d, "pages").select("page_id", T.strip_tags(F.col("html")).alias("text"))


@query("SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id, min(ts) AS ts FROM events GROUP BY user_id")
def first_wins_dedup(spark, d):  # A16
    return glossary.first_wins(table(spark, d, "events").select("user_id", "event_id", "ts"), "user_id", ["ts", "event_id"])


@query("SELECT word, lower(strip_accents(word)) AS folded, CAST(row_number() OVER (ORDER BY lower(strip_accents(word)), word) - 1 AS BIGINT) AS place FROM (SELECT DISTINCT unnest(string_split_regex(text, '[^\\p{L}]+')) AS word FROM documents) WHERE word <> ''")
def diacritic_fold_sort(spark, d):  # O5
    words = table(spark, d, "documents").select(F.explode(F.split("text", r"[^\p{L}]+")).alias("word")).where("word <> ''").distinct()
    return positions.with_positions(words.withColumn("folded", positions.folded("word")), ["folded", "word"], "place")


@query("SELECT doc_id, quality, toxic FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE n_chars < 500) UNION ALL SELECT doc_id, 9, 9 FROM documents WHERE n_chars < 500")
def upsert_log(spark, d):  # J10, K7
    fresh = table(spark, d, "documents").where("n_chars < 500").select("doc_id", F.lit(9).alias("quality"), F.lit(9).alias("toxic"))
    return catalog.upsert(table(spark, d, "labels").select("doc_id", "quality", "toxic"), fresh, "doc_id")


@query("SELECT conv_id, string_agg(replace(text, 'e', 'E'), chr(10) ORDER BY turn) AS text, CAST(count(*) AS BIGINT) AS parts FROM conversations WHERE length(text) >= 50 GROUP BY conv_id")
def stub_map_assemble(spark, d):  # U1, F12, A10
    from textloom.operators.external import transform_chunks

    rows = table(spark, d, "conversations").where(F.length("text") >= 50).select("conv_id", "turn", "text")
    done = transform_chunks(rows, "text", lambda t: t.replace("e", "E")).where("error IS NULL").drop("text")
    return chunking.reassemble(done, "conv_id", "turn", "result", "\n")


@query("SELECT source, CAST(count(*) AS BIGINT) AS files, min(doc_id) AS first_doc FROM documents GROUP BY source")
def files_by_text(spark, d):  # A1
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("files"), F.min("doc_id").alias("first_doc"))


@query("SELECT date_trunc('day', ts) AS day, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2")
def events_by_day(spark, d):  # extension
    return table(spark, d, "events").groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "event_type").agg(F.count("*").alias("n"))


@query("SELECT doc_id, coalesce(nullif(regexp_extract(text, '([0-9]+)', 1), ''), 'none') AS first_number, 'Translate ' || lang || ': ' || source AS prompt FROM documents")
def first_numbers_and_prompts(spark, d):  # C32, C33
    docs = table(spark, d, "documents")
    return docs.select("doc_id", T.first_match(F.col("text"), "([0-9]+)", F.lit("none")).alias("first_number"), T.prompt("Translate %s: %s", F.col("lang"), F.col("source")).alias("prompt"))


@query("SELECT conv_id, turn, '{\"custom_id\":\"' || conv_id || '_' || turn || '\",\"params\":{\"max_tokens\":100,\"system\":\"s\",\"messages\":[{\"role\":\"user\",\"content\":\"' || role || '\"}]}}' AS request FROM conversations")
def batch_requests(spark, d):  # U5
    rows = table(spark, d, "conversations")
    return rows.select("conv_id", "turn", T.batch_request(F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")), "s", F.col("role"), 100).alias("request"))


@query("SELECT conv_id, turn, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn) = 'system', false) AS after_system FROM conversations")
def after_heading(spark, d):  # W7
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, d, "conversations").select("conv_id", "turn", F.coalesce(F.lag("role").over(w) == "system", F.lit(False)).alias("after_system"))


@query("SELECT source, CAST(max(n_chars) AS BIGINT) AS largest, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY source")
def section_sizes(spark, d):  # A12, A17
    return table(spark, d, "documents").groupBy("source").agg(F.max("n_chars").alias("largest"), F.count("*").alias("n"))


@query("SELECT doc_id || chr(9) || lang || chr(9) || source AS line FROM documents WHERE n_chars <= 2000 AND (doc_id IN (1, 2, 3) OR source = 'src1')")
def catalog_lines(spark, d):  # F2; a fixed choice
    docs = table(spark, d, "documents").where((F.col("n_chars") <= 2000) & (F.col("doc_id").isin(1, 2, 3) | (F.col("source") == "src1")))
    return docs.select(F.concat_ws("\t", F.col("doc_id").cast("string"), "lang", "source").alias("line"))


@query("SELECT c.conv_id, c.turn, l.item_id FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos FROM conversations) c JOIN benchmark l ON l.item_id = c.pos")
def positional_join(spark, d):  # J12
    w = Window.partitionBy("conv_id").orderBy("turn")
    left = table(spark, d, "conversations").select("conv_id", "turn", (F.row_number().over(w) - 1).cast("long").alias("pos"))
    return left.join(table(spark, d, "benchmark").select("item_id"), F.col("pos") == F.col("item_id")).select("conv_id", "turn", "item_id")


@query("SELECT doc_id AS id, lang AS title, CAST(NULL AS VARCHAR) AS url FROM documents UNION ALL SELECT page_id, NULL, url FROM pages")
def united_catalogs(spark, d):  # X4, X5 (extension)
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("title"))
    return docs.unionByName(table(spark, d, "pages").select(F.col("page_id").alias("id"), "url"), allowMissingColumns=True)


@query("SELECT doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 0)")
def membership_semi(spark, d):  # X3, J5
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").where("quality = 0").select("doc_id"), "doc_id", "left_semi")


@query("SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (n_chars > 1000) AS BIGINT) AS kept, CAST(sum(n_chars) FILTER (n_chars > 1000) // 1000 AS BIGINT) AS kilo FROM documents")
def valid_results(spark, d):  # extension: totals beyond a size
    long = F.col("n_chars") > 1000
    kilo = F.floor(F.sum(F.when(long, F.col("n_chars"))) / 1000).cast("decimal(38,0)")
    return table(spark, d, "documents").agg(F.count("*").alias("total"), F.count_if(long).alias("kept"), kilo.cast("long").alias("kilo"))


_CUT = "(SELECT coalesce(min(doc_id), 0) FROM w WHERE source >= 'src5')"
_DONE = "(SELECT doc_id FROM labels WHERE quality = 1)"


@query(f"WITH w AS (SELECT doc_id, source, lang, n_chars FROM documents WHERE lang = 'en') SELECT doc_id, n_chars FROM w WHERE doc_id >= {_CUT} AND doc_id NOT IN {_DONE} AND n_chars <= 2000")
def batch_plan(spark, d):  # F1, F2, F3, O1
    done = table(spark, d, "labels").where("quality = 1")
    return catalog.batch_plan(table(spark, d, "documents"), done, "doc_id", "doc_id", "lang", "en", "source", "src5", "n_chars", 2000).select("doc_id", "n_chars")


@query(f"WITH w AS (SELECT doc_id, source, n_chars FROM documents WHERE n_chars <= 2000) SELECT doc_id, n_chars FROM w WHERE doc_id >= {_CUT} AND doc_id NOT IN {_DONE}")
def interactive_plan(spark, d):  # F1, F2, F3, O2
    done = table(spark, d, "labels").where("quality = 1")
    return catalog.interactive_plan(table(spark, d, "documents"), done, "doc_id", "doc_id", "source", "src5", "n_chars", 2000).select("doc_id", "n_chars")


@query("SELECT doc_id, n_chars FROM documents")
def unlimited_plan(spark, d):  # F2, switched off
    return catalog.at_most(table(spark, d, "documents").select("doc_id", "n_chars"), "n_chars", 0)


@query("SELECT doc_id, n_chars, CAST(greatest((SELECT count(*) FROM documents) - 50, 0) AS BIGINT) AS more FROM documents ORDER BY n_chars DESC, doc_id LIMIT 50")
def preview_with_rest(spark, d):  # O7
    work = table(spark, d, "documents").select("doc_id", "n_chars")
    return catalog.preview(work, [F.desc("n_chars"), "doc_id"], 50)


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT f.doc_id FROM (SELECT doc_id FROM documents WHERE n_chars > 500) f JOIN labels l ON l.doc_id = f.doc_id)")
def unfinished_files_and_log(spark, d):  # J2
    docs = table(spark, d, "documents")
    return catalog.outstanding(docs.select("doc_id"), catalog.finished(docs.where("n_chars > 500"), table(spark, d, "labels"), "doc_id"), "doc_id")


@query("SELECT e.user_id, count(*) AS n FROM events e WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id AND c.c_acctbal > 3000) GROUP BY e.user_id")
def lookup_misses(spark, d):  # J4, J11
    customers = table(spark, d, "customer").where("c_acctbal > 3000").select(F.col("c_custkey").alias("user_id"), "c_name")
    missing = catalog.looked_up(table(spark, d, "events").select("user_id"), customers, "user_id")[1]
    return missing.groupBy("user_id").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, lower(p_name) AS name, CASE split_part(p_type, ' ', 1) WHEN 'PROMO' THEN 1 WHEN 'ECONOMY' THEN 2 WHEN 'STANDARD' THEN 3 ELSE 99 END AS rank FROM part")
def category_order(spark, d):  # O4
    parts = table(spark, d, "part").select("p_partkey", F.lower("p_name").alias("name"), F.split_part("p_type", F.lit(" "), F.lit(1)).alias("kind"))
    return catalog.by_rank(parts, "kind", ["PROMO", "ECONOMY", "STANDARD"], F.col("name")).drop("kind")


@query("SELECT p_partkey, lower(p_name) AS name, CASE split_part(p_type, ' ', 1) WHEN 'STANDARD' THEN 1 WHEN 'PROMO' THEN 2 ELSE 99 END AS rank FROM part")
def other_category_order(spark, d):  # O4, the second order
    parts = table(spark, d, "part").select("p_partkey", F.lower("p_name").alias("name"), F.split_part("p_type", F.lit(" "), F.lit(1)).alias("kind"))
    return catalog.by_rank(parts, "kind", ["STANDARD", "PROMO"], F.col("name")).drop("kind")


@query("SELECT doc_id, left(source, 3) AS volume, CAST(row_number() OVER (PARTITION BY left(source, 3) ORDER BY doc_id) AS BIGINT) AS nth FROM documents WHERE source IS NOT NULL")
def volume_order(spark, d):  # C16, O3
    docs = table(spark, d, "documents").where("source IS NOT NULL").select("doc_id", F.substring("source", 1, 3).alias("volume"))
    return docs.withColumn("nth", F.row_number().over(Window.partitionBy("volume").orderBy("doc_id")).cast("long")).orderBy("volume", "doc_id")


@query("SELECT event_id, CASE WHEN value < 20 THEN 1 WHEN value < 60 THEN 2 ELSE 3 END AS tier FROM events")
def tier_order(spark, d):  # O6
    tier = F.when(F.col("value") < 20, 1).when(F.col("value") < 60, 2).otherwise(3)
    return table(spark, d, "events").select("event_id", tier.alias("tier")).orderBy("tier", "event_id")


@query("SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) AS INT) AS num, c AS content FROM (SELECT doc_id, i, trim(c) AS c FROM (SELECT doc_id, unnest(string_split(text, '. ')) AS c, unnest(range(len(string_split(text, '. ')))) AS i FROM documents)) WHERE c <> '' AND c NOT LIKE '#%'")
def renumbered_sections(spark, d):  # C13
    return table(spark, d, "documents").select("doc_id", F.inline(segments.split_sections(F.col("text"), r"\. ")))


@query("SELECT regexp_extract(url, '^([a-z]+://[^/]+)', 1) AS id, CAST(count(*) AS BIGINT) AS n_files, array_to_string(list_sort(list(url)), chr(10)) AS paths FROM pages WHERE regexp_matches(url, '^[a-z]+://[^/]+') GROUP BY 1")
def grouped_files(spark, d):  # S1, A1
    return catalog.grouped_files(table(spark, d, "pages").select(F.col("url").alias("path")), r"^([a-z]+://[^/]+)").withColumn("paths", F.array_join("paths", "\n"))


@query("SELECT lang, CAST(count(*) AS BIGINT) AS n, format('{:,}', CAST(sum(n_chars) AS BIGINT)) AS total, printf('%.1f', round_even(sum(n_chars) * 100 / (SELECT sum(n_chars) FROM documents), 1)) AS share FROM documents GROUP BY lang")
def catalogue_summary(spark, d):  # K3, C27
    return catalog.summary(table(spark, d, "documents"), "lang", "n_chars")


@query("SELECT conv_id, turn, printf('T%04d_%03d', conv_id, turn) AS name FROM conversations")
def padded_names(spark, d):  # C29
    return table(spark, d, "conversations").select("conv_id", "turn", F.format_string("T%04d_%03d", "conv_id", "turn").alias("name"))


@query("SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]{4}')) AS ref FROM documents) WHERE left(ref, 4) <= '5000' GROUP BY doc_id")
def within_page_bound(spark, d):  # extension: one bound for all
    refs = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[0-9]{4}"), F.lit(0))).alias("ref"))
    return refs.where(F.substring("ref", 1, 4) <= "5000").groupBy("doc_id").agg(F.count("*").alias("n"))


@query("SELECT doc_id, lang, n_chars FROM documents WHERE n_chars > 500")
def incremental_documents(spark, d):  # 2.12, K10
    path = f"{d}/{{documents}}.parquet"  # a pattern, as a stream takes no path of a single file
    schema = table(spark, d, "documents").schema
    sink, checkpoint = (incremental.shared_folder(spark, k) for k in ("sink", "progress"))
    for _ in range(2):  # the second run finds nothing new
        incremental.drain(spark, path, schema, sink, checkpoint, lambda df: df.where("n_chars > 500").select("doc_id", "lang", "n_chars")).awaitTermination()
    return spark.read.parquet(sink)


#: A page of the store holds its own lines and, altered, those of the next one, so the cursor passes over every second page.
_HOSTS = "h AS (SELECT *, row_number() OVER (PARTITION BY text_id ORDER BY page_id) AS page FROM (SELECT page_id, html, regexp_extract(url, '://([^/]+)', 1) AS text_id, list_prepend(url, regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1)) AS ls FROM pages))"


@query(f"WITH {_HOSTS}, l AS (SELECT text_id, page, unnest(ls) AS t, unnest(range(len(ls))) AS i FROM h) SELECT text_id, printf('%04d%s%02d', page, chr(CAST(97 + i // 100 AS INT)), i % 100) AS ref, CASE WHEN page % 2 = 0 THEN t || '+' ELSE t END AS text FROM l")
def paged_lines(spark, d):  # S13, S14, S11, E4, C31
    pages = table(spark, d, "pages").select("page_id", F.regexp_extract("url", "://([^/]+)", 1).alias("text_id"), F.concat(F.array("url"), markup.links(F.col("html"))).alias("ls"))
    w = Window.partitionBy("text_id").orderBy("page_id")
    numbered = pages.select("text_id", "ls", F.row_number().over(w).alias("page"), F.lead("ls").over(w).alias("next"))

    def anchors(lines, page, mark):
        ref = lambda i: F.format_string("%04d%s%02d", page, F.substring(F.lit("abc"), (F.floor(i / 100) + 1).cast("int"), F.lit(1)), i % 100)
        one = lambda t, i: F.concat(F.lit('<a name="'), ref(i), F.lit('" class="al"><span class="tx"><span class="ec">'), F.left(t, F.lit(3)), F.lit('</span><span class="ec" lang="x">'), F.substr(t, F.lit(4)), F.lit(f"{mark}</span></span></a>"))
        return F.array_join(F.transform(lines, one), "\n")

    html = F.concat(F.lit("<p>"), anchors("ls", F.col("page"), ""), F.coalesce(anchors("next", F.col("page") + 1, "+"), F.lit("")), F.lit("</p>"))
    at = incremental.shared_folder(spark, "pages")
    paged.store_pages(numbered.select("text_id", "page", html.alias("html")), at)
    return paged.paged_texts(spark, at, delay=0.0)


_JOB = "r AS (SELECT printf('T%04d_fasc_%02d', user_id, event_id % 7) AS custom_id, CASE WHEN event_type = 'error' THEN 'errored' ELSE 'succeeded' END AS type, props AS text, CAST(floor(value) AS BIGINT) AS i, user_id AS o, event_id FROM events)"


def _job_done(spark, d):
    """The events as results of a job that is looked at twice: half way, and after its end."""
    events = table(spark, d, "events").select("event_id", "user_id", F.floor("value").alias("i"), "props", "event_type")
    made = F.struct(
        F.format_string("T%04d_fasc_%02d", "user_id", F.col("event_id") % 7).alias("custom_id"), F.when(F.col("event_type") == "error", "errored").otherwise("succeeded").alias("type"),
        F.col("props").alias("text"), F.col("i").alias("input_tokens"), F.col("user_id").alias("output_tokens"),
    )
    lines = F.transform(F.array_sort(F.collect_list(F.struct("event_id", F.to_json(made).alias("line")))), lambda x: x["line"])
    number = F.floor(F.col("event_id") / 500)
    files = events.groupBy(number.alias("number")).agg(F.array_join(lines, "\n").alias("content"))
    at, sink, progress = (incremental.shared_folder(spark, k) for k in ("job", "results", "progress"))
    store.write_files(files, at, F.format_string("results/%06d.json", "number"), F.col("content"))
    n = files.count()
    for there, ended in ((n // 2, False), (n, True)):
        polled.set_status(at, there, ended)
        polled.drain_job(spark, at, sink, progress, looks=1)
    return polled.merged(spark, sink)


@query(f"WITH {_JOB} SELECT split_part(custom_id, '_fasc_', 1) AS t_number, string_agg(text, chr(10) || chr(10) ORDER BY custom_id) AS text, CAST(count(*) AS BIGINT) AS parts FROM (SELECT custom_id, arg_max(text, event_id) AS text FROM r WHERE type = 'succeeded' GROUP BY custom_id) GROUP BY 1")
def polled_results(spark, d):  # S18, C28, A10
    keyed = _job_done(spark, d).select(T.composite_key(F.col("custom_id")).alias("k"), "text").select("k.*", "text")
    return chunking.reassemble(keyed, "t_number", "fasc_num", "text", "\n\n")


@query(f"WITH {_JOB}, l AS (SELECT custom_id, arg_max(i, event_id) AS i, arg_max(o, event_id) AS o FROM r WHERE type = 'succeeded' GROUP BY custom_id) SELECT CAST(sum(i) AS BIGINT) AS tokens_in, CAST(sum(o) AS BIGINT) AS tokens_out, round(sum(i) / 1e6 * 2.50 + sum(o) / 1e6 * 12.50, 9) AS cost FROM l")
def polled_cost(spark, d):  # S18, A14
    return polled.token_sums(_job_done(spark, d)).withColumn("cost", F.round(catalog.cost(F.col("tokens_in"), F.col("tokens_out")), 9))


_DAY = 86_400_000_000


@query(f"""
WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS t FROM events),
g AS (SELECT user_id, arg_min(event_id, (t, event_id)) AS event_id, min(t) AS t FROM e GROUP BY user_id
  UNION ALL SELECT user_id, event_id, t FROM (SELECT g.user_id, e.event_id, e.t, row_number() OVER (PARTITION BY g.user_id ORDER BY e.t, e.event_id) AS k FROM g JOIN e ON e.user_id = g.user_id AND e.t >= g.t + {_DAY}) WHERE k = 1)
SELECT user_id AS key, event_id AS claim, t AS "at", CAST(t + {_DAY} AS BIGINT) AS until FROM g""")
def granted_claims(spark, d):  # K10, 2.12: leases of a day, over a restart
    events = table(spark, d, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("claim"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    half = events.agg(F.percentile_approx("at", 0.5).alias("at")).first()["at"]
    source, sink, progress = (incremental.shared_folder(spark, k) for k in ("claims", "grants", "progress"))
    for part in (events.where(F.col("at") < half), events.where(F.col("at") >= half)):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        claims.granted(stream, _DAY).writeStream.format("parquet").option("path", sink).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(claims.GRANTED).parquet(sink)


@query("""
WITH c AS (SELECT conv_id, turn, coalesce(text, '') AS t FROM conversations),
x AS (SELECT *, CASE WHEN length(t) % 5 = 0 THEN NULL ELSE replace(t, 'e', 'E') END AS draft FROM c),
y AS (SELECT *, CASE WHEN length(draft) % 4 = 0 THEN draft ELSE draft || '!' END AS final, CASE WHEN draft IS NULL THEN 5 ELSE 1 END AS dt, CASE WHEN draft IS NULL THEN 0 WHEN length(draft) % 4 = 0 THEN 5 ELSE 1 END AS rt FROM x)
SELECT conv_id, string_agg(final, chr(10) || chr(10) ORDER BY turn) AS text, CAST(count(final) AS BIGINT) AS parts, CAST(count(*) FILTER (final IS NULL) AS BIGINT) AS failed, CAST(sum(dt + rt) AS BIGINT) AS tries FROM y GROUP BY conv_id HAVING count(final) > 0""")
def drafts_and_reviews(spark, d):  # U2, U4
    from textloom.operators import external

    def draft(t: str) -> str:
        if len(t) % 5 == 0:
            raise ValueError("refused")
        return t.replace("e", "E")

    def review(t: str) -> str:
        if len(t) % 4 == 0:
            raise ValueError("refused")
        return f"{t}!"

    rows = table(spark, d, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("t"))
    memo = incremental.shared_folder(spark, "memo")
    run = lambda: external.draft_and_review(rows, "t", draft, review, memo=memo)
    run().write.format("noop").mode("overwrite").save()
    done = run()  # nothing is called any more, and no try is added
    return external.reviewed_texts(done, "conv_id", "turn", more=[F.sum(F.col("draft_tries") + F.col("review_tries")).alias("tries")])


@query("""
WITH c AS (SELECT conv_id, turn, role, CASE WHEN length(text) % 4 = 0 THEN ' ' ELSE text END AS content, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
SELECT printf('%d_f%03d.txt', conv_id, turn) AS name, '# ' || role || chr(10) || printf('# Fascicle %d of %d', turn, n) || chr(10) || chr(10) || content AS content FROM c WHERE trim(content) <> ''""")
def section_files(spark, d):  # K1, K5, K6, C29, W5: written, then read back
    rows = table(spark, d, "conversations").withColumn("content", F.when(F.length("text") % 4 == 0, " ").otherwise(F.col("text")))
    numbered = rows.withColumn("n", F.count("*").over(Window.partitionBy("conv_id")))
    at = incremental.shared_folder(spark, "files")
    store.write_sections(numbered, at, "conv_id", "turn", "content", "n", F.col("role"))
    return store.read_files(spark, at)


@query("SELECT doc_id, lang, n_chars FROM documents WHERE n_chars > 500")
def resumed_documents(spark, d):  # three files before the deadline, the rest in the next run
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    source, sink, progress = (incremental.shared_folder(spark, k) for k in ("source", "sink", "progress"))
    docs.repartition(6, "doc_id").write.parquet(source)
    for deadline in (3, 1_000_000):
        clock = iter(range(1_000_000)).__next__
        incremental.drain_until(spark, source, docs.schema, sink, progress, deadline, lambda df: df.where("n_chars > 500"), clock)
    return incremental.batches(spark, sink, docs.schema)


_LINKED = "p AS (SELECT regexp_extract(url, '://([^/]+)', 1) AS text_id, page_id, list_transform(regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1), lambda x: regexp_replace(x, '[<>&\"]', '', 'g')) AS ls FROM pages WHERE page_id % 11 <> 0)"


@query(f"""
WITH {_LINKED},
v AS (SELECT text_id, k, arg_min(t, page_id) AS value FROM (SELECT text_id, page_id, unnest(ls) AS t, unnest(range(len(ls))) AS k FROM p) WHERE t <> '' GROUP BY text_id, k),
r AS (SELECT text_id, page_id, unnest(range(len(ls) + 1)) AS k FROM p),
t AS (SELECT r.text_id, r.page_id, string_agg(r.k || coalesce(v.value, ''), '' ORDER BY r.k) AS text FROM r LEFT JOIN v ON v.text_id = r.text_id AND v.k = r.k GROUP BY r.text_id, r.page_id),
b AS (SELECT text_id, page_id, 0 AS i, 'heading' AS type, 'page ' || page_id AS text FROM p UNION ALL SELECT text_id, page_id, 1, 'para', text FROM t
  UNION ALL SELECT p.text_id, page_id, 2, 'verse', value FROM p JOIN v ON v.text_id = p.text_id AND v.k = 0)
SELECT text_id, CAST(row_number() OVER (PARTITION BY text_id ORDER BY page_id, i) - 1 AS BIGINT) AS pos, type, text, '' AS n FROM b""")
def blocks_of_texts(spark, d):  # S4, S5, J9, X4, E1, E2, A16
    targets = F.transform(markup.links(F.col("html")), lambda x: F.regexp_replace(x, '[<>&"]', ""))
    pages = table(spark, d, "pages").select(F.regexp_extract("url", "://([^/]+)", 1).alias("text_id"), "page_id", targets.alias("ls"))
    char = lambda t, k: F.concat(F.lit('<char xml:id="L'), k.cast("string"), F.lit('"><charProp><localName>normalized form</localName><value>'), t, F.lit("</value></charProp></char>"))
    refs = F.array_join(F.transform(F.sequence(F.lit(0), F.size("ls")), lambda k: F.concat(k.cast("string"), F.lit('<g ref="#L'), k.cast("string"), F.lit('"/>'))), "")
    xml = F.concat(
        F.lit('<TEI xmlns="u"><teiHeader><p>none</p><charDecl>'), F.array_join(F.transform("ls", char), ""), F.lit("</charDecl></teiHeader><text><body><head>page "), F.col("page_id").cast("string"),
        F.lit("</head><p>"), refs, F.lit('</p><lg><l> <g ref="#L0"/></l><l><g ref="#none"/></l></lg>'), F.when(F.col("page_id") % 11 == 0, "<bad").otherwise(""), F.lit("</body></text></TEI>"),
    )
    return markup.text_blocks(pages.select("text_id", F.format_string("%09d.xml", "page_id").alias("path"), xml.alias("xml")))


# Orders, told by places

@query(f"WITH w AS (SELECT doc_id, source, lang, n_chars FROM documents WHERE lang = 'en') SELECT doc_id, n_chars, CAST(row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS BIGINT) AS place FROM w WHERE doc_id >= {_CUT} AND doc_id NOT IN {_DONE} AND n_chars <= 2000")
def batch_places(spark, d):  # O1
    return positions.with_positions(batch_plan(spark, d), ["n_chars", "doc_id"], "place")


@query("SELECT p_partkey, CAST(row_number() OVER (ORDER BY CASE split_part(p_type, ' ', 1) WHEN 'PROMO' THEN 1 WHEN 'ECONOMY' THEN 2 WHEN 'STANDARD' THEN 3 ELSE 99 END, lower(p_name), p_partkey) - 1 AS BIGINT) AS place, CAST(row_number() OVER (ORDER BY CASE split_part(p_type, ' ', 1) WHEN 'STANDARD' THEN 1 WHEN 'PROMO' THEN 2 ELSE 99 END, lower(p_name), p_partkey) - 1 AS BIGINT) AS other FROM part")
def category_places(spark, d):  # O4, both orders
    one = positions.with_positions(category_order(spark, d), ["rank", "name", "p_partkey"], "place")
    two = positions.with_positions(other_category_order(spark, d), ["rank", "name", "p_partkey"], "other")
    return one.select("p_partkey", "place").join(two.select("p_partkey", "other"), "p_partkey")


@query("SELECT event_id, CAST(row_number() OVER (ORDER BY CASE WHEN value < 20 THEN 1 WHEN value < 60 THEN 2 ELSE 3 END, event_id) - 1 AS BIGINT) AS place FROM events")
def tier_places(spark, d):  # O6
    return positions.with_positions(tier_order(spark, d), ["tier", "event_id"], "place").drop("tier")


@query("SELECT doc_id || chr(9) || lang || chr(9) || source AS line, CAST(row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS BIGINT) AS place FROM documents WHERE n_chars <= 2000 AND lang IS NOT NULL AND source IS NOT NULL")
def sorted_catalog_lines(spark, d):  # S7: filter, sort, project
    docs = table(spark, d, "documents").where("n_chars <= 2000 AND lang IS NOT NULL AND source IS NOT NULL").select("doc_id", "n_chars", "lang", "source")
    placed = positions.with_positions(docs, ["n_chars", "doc_id"], "place")
    return placed.select(F.concat_ws("\t", F.col("doc_id").cast("string"), "lang", "source").alias("line"), "place")
