"""Queries of the search by registry entry: documents are issues, conversations their comments, pages their attachments."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import items, registry_search
from millrace.plans.registry import query
from millrace.sources.adapters import view

# registry rows from the benchmark: three phrases of two words each, in backticks
_PHRASES = ((2, 3), (5, 6), (8, 9))
_WORD = "split(text, ' ')[{0}]"
_TICKED = "concat(" + ", ' ', ".join(f"'`', {_WORD.format(a - 1)}, ' ', {_WORD.format(b - 1)}, '`'" for a, b in _PHRASES) + ")"
_MODE = "CASE item_id % 3 WHEN 0 THEN 'mode a' WHEN 1 THEN 'about Mode C, old' ELSE 'zzz' END"
_MODES = [("Mode A", [], []), ("Mode C", [], [])]
_EXTRA, _BY_CATEGORY = ["licensed work"], {"odd": ["rights reserved", "Http"]}
_SOURCES, _LABELS, _TAGS = ["SRC1", "src2", "src3", "src5", "src8", "src13", "src0"], ["EN", "de"], ["en", "fr", "de", "es"]


def _registry(spark, d):
    rows = view(spark, d, "benchmark").select(F.col("item_id").alias("entry"), F.expr(_MODE).alias("mode_text"), F.expr(_TICKED).alias("description"), F.expr("CASE WHEN item_id % 2 = 0 THEN 'even' ELSE 'odd' END").alias("category_text"))
    return items.parse_registry(rows, _MODES, [], "none")


def _issues(spark, d):
    summary = F.split_part("text", F.lit("\n"), F.lit(1))
    docs = view(spark, d, "documents").withColumn("summary", summary)
    return docs.select(F.col("doc_id").alias("issue_key"), "summary", F.substr("text", F.length("summary") + 2).alias("description"), (F.col("doc_id") % 4 == 0).alias("has_attachment"), F.col("source").alias("project"), F.array("lang", "source").alias("labels"))


def _others(spark, d):
    """comments, attachments, links, subtasks."""
    said = view(spark, d, "conversations").select(F.col("conv_id").alias("issue_key"), F.col("turn").cast("long").alias("pos"), "text")
    name = F.concat("url", F.element_at(F.array(*map(F.lit, _FILES)), (F.col("page_id") % len(_FILES) + 1).cast("int")))
    files = view(spark, d, "pages").select(F.col("page_id").alias("issue_key"), F.lit(0).cast("long").alias("pos"), name.alias("name"), F.lit("").alias("mime"))
    links = view(spark, d, "lineitem").select(F.col("l_orderkey").alias("issue_key"), F.col("l_partkey").alias("other"))
    subtasks = view(spark, d, "documents").where("doc_id > 0").select(F.floor(F.col("doc_id") / 10).cast("long").alias("issue_key"), F.col("doc_id").alias("other"))
    return said, files, links, subtasks


_FILES = [".png", ".pdf", ".xml", ".zip"]


def _matches(spark, d):
    return registry_search.find_matches(_issues(spark, d), _registry(spark, d), *_others(spark, d), depth=2, labels=_LABELS)


_HELD = lambda text, words="k.keywords": f"list_filter({words}, lambda w: contains(lower({text}), lower(w)))"
_CUT = lambda text, hits: (
    f"(SELECT CASE WHEN a > 0 THEN '...' ELSE '' END || trim(replace(substr({text}, a + 1, b - a), chr(10), ' '), ' ' || chr(9) || chr(13) || chr(11) || chr(12)) || CASE WHEN b < length({text}) THEN '...' ELSE '' END "
    f"FROM (SELECT greatest(0, p - 1 - 60) AS a, least(length({text}), p - 1 + length({hits}[1]) + 60) AS b FROM (SELECT instr(lower({text}), lower({hits}[1])) AS p)))"
)
_WHOLE = "concat(summary, chr(10), description)"
_ENTRIES = """k AS (SELECT item_id AS entry, CASE item_id % 3 WHEN 0 THEN 'Mode A' WHEN 1 THEN 'Mode C' ELSE 'zzz' END AS mode, CASE WHEN item_id % 2 = 0 THEN 'even' ELSE 'odd' END AS category,
    list_filter(words, lambda x, i: NOT list_contains(list_transform(words[1:i - 1], lambda y: lower(y)), lower(x))) AS keywords
    FROM (SELECT item_id, list_transform([__PHRASES__], lambda p: split_part(text, ' ', p[1]) || ' ' || split_part(text, ' ', p[2])) AS words FROM benchmark)),
i AS (SELECT doc_id AS issue_key, split_part(text, chr(10), 1) AS summary, substr(text, length(split_part(text, chr(10), 1)) + 2) AS description, doc_id % 4 = 0 AS has_attachment, source, lang FROM documents)""".replace("__PHRASES__", ", ".join(f"[{a}, {b}]" for a, b in _PHRASES))
_FOUND = f"""
WITH {_ENTRIES},
h AS (SELECT k.entry, k.keywords, i.*, {_HELD(_WHOLE)} AS in_whole, {_HELD("summary")} AS in_summary, {_HELD("description")} AS in_text FROM k, i WHERE len({_HELD(_WHOLE)}) > 0),
gate AS (SELECT entry, issue_key, has_attachment FROM h WHERE lower(lang) IN ('en', 'de') OR lower(source) IN ('en', 'de')),
ties AS (SELECT DISTINCT l_orderkey AS issue_key, l_partkey AS other FROM lineitem WHERE l_orderkey <> l_partkey),
kids AS (SELECT doc_id // 10 AS issue_key, doc_id AS other FROM documents WHERE doc_id > 0),
below AS (SELECT t.issue_key, s.other, min(t.other) AS link FROM ties t JOIN kids s ON s.issue_key = t.other WHERE s.other <> t.issue_key AND (t.issue_key, s.other) NOT IN (SELECT (issue_key, other) FROM ties) GROUP BY ALL),
said AS (SELECT conv_id AS issue_key, turn AS pos, entry, {_HELD("c.text")} AS hits, c.text FROM k, conversations c WHERE len({_HELD("c.text")}) > 0),
files AS (SELECT page_id AS issue_key, url || (['.png', '.pdf', '.xml', '.zip'])[page_id % 4 + 1] AS name, page_id % 4 AS kind FROM pages),
f AS (SELECT g.entry, g.issue_key AS gate_key, CAST(NULL AS BIGINT) AS via, n.*, {_HELD("name")} AS hits FROM gate g JOIN k ON k.entry = g.entry JOIN files n ON n.issue_key = g.issue_key
      UNION ALL SELECT g.entry, g.issue_key, t.other, n.*, {_HELD("name")} FROM gate g JOIN k ON k.entry = g.entry JOIN ties t ON t.issue_key = g.issue_key JOIN files n ON n.issue_key = t.other),
places AS (
  SELECT g.issue_key, g.entry, 'summary' AS place, CAST(NULL AS BIGINT) AS via, 0 AS pos, in_summary AS hits, {_CUT("summary", "in_summary")} AS fragment, 'summary' AS rule, false AS attached FROM gate g JOIN h USING (entry, issue_key) WHERE len(in_summary) > 0
  UNION ALL SELECT g.issue_key, g.entry, 'description', NULL, 0, in_whole, CASE WHEN summary <> '' THEN '[' || summary || '] ' ELSE '' END || {_CUT(_WHOLE, "in_whole")}, 'description', g.has_attachment FROM gate g JOIN h USING (entry, issue_key) WHERE len(in_summary) = 0 OR len(list_filter(in_text, lambda x: NOT list_contains(in_summary, x))) > 0
  UNION ALL SELECT g.issue_key, g.entry, 'comment', NULL, pos, hits, {_CUT("text", "hits")}, 'comment', false FROM gate g JOIN said USING (entry, issue_key)
  UNION ALL SELECT gate_key, entry, CASE WHEN via IS NULL THEN 'attachment' ELSE 'linked_attachment' END, via, 0, hits, CASE WHEN len(hits) > 0 THEN {_CUT("name", "hits")} END, CASE WHEN len(hits) > 0 THEN 'attachment' WHEN kind = 2 THEN 'medium' ELSE 'low' END, false FROM f WHERE len(hits) > 0 OR kind < 3
  UNION ALL SELECT g.issue_key, g.entry, 'linked', t.other, 0, in_summary, {_CUT("summary", "in_summary")}, 'linked', false FROM gate g JOIN ties t USING (issue_key) JOIN h ON h.entry = g.entry AND h.issue_key = t.other WHERE len(in_summary) > 0
  UNION ALL SELECT g.issue_key, g.entry, 'linked_description', t.other, 0, in_text, {_CUT("description", "in_text")}, 'description', h.has_attachment FROM gate g JOIN ties t USING (issue_key) JOIN h ON h.entry = g.entry AND h.issue_key = t.other WHERE len(in_text) > 0
  UNION ALL SELECT g.issue_key, g.entry, 'linked_comment', t.other, pos, hits, {_CUT("text", "hits")}, 'comment', false FROM gate g JOIN ties t USING (issue_key) JOIN said s ON s.entry = g.entry AND s.issue_key = t.other
  UNION ALL SELECT g.issue_key, g.entry, 'linked_subtask', b.other, 0, in_summary, {_CUT("summary", "in_summary")}, 'linked', false FROM gate g JOIN below b USING (issue_key) JOIN h ON h.entry = g.entry AND h.issue_key = b.other WHERE len(in_summary) > 0
  UNION ALL SELECT g.issue_key, g.entry, 'subtask', s.other, 0, in_whole, {_CUT(_WHOLE, "in_whole")}, 'subtask', false FROM gate g JOIN kids s USING (issue_key) JOIN h ON h.entry = g.entry AND h.issue_key = s.other WHERE s.other <> g.issue_key),
m AS (SELECT issue_key, p.entry, mode, category, place, via, pos, CASE WHEN len(hits) > 0 THEN array_to_string(hits, ', ') END AS matched, CASE WHEN len(hits) > 0 THEN round(len(hits) / len(keywords), 6) END AS ratio, fragment,
  CASE WHEN len(hits) > 0 THEN 'found' ELSE 'manual' END AS status,
  CASE WHEN rule IN ('low', 'medium') THEN rule WHEN rule = 'attachment' THEN 'medium' WHEN rule = 'summary' AND r >= 0.3 OR rule = 'description' AND attached AND r >= 0.3 OR rule = 'description' AND r >= 0.5 THEN 'high'
       WHEN rule IN ('comment', 'linked') THEN CASE WHEN r >= 0.5 THEN 'medium' ELSE 'low' END WHEN r >= 0.7 THEN 'high' WHEN r >= 0.3 THEN 'medium' ELSE 'low' END AS confidence
  FROM (SELECT p.*, mode, category, keywords, len(hits) / len(keywords) AS r FROM places p JOIN k USING (entry)) p)
"""


@query("k26_registry_candidates", f"""
WITH {_ENTRIES}, w AS (SELECT entry, unnest(list_concat(keywords, list_concat(['licensed work'], CASE category WHEN 'odd' THEN ['rights reserved', 'Http'] ELSE [] END))) AS word FROM k)
SELECT DISTINCT entry, issue_key FROM w JOIN i ON contains(lower({_WHOLE}), lower(word)) WHERE lower(source) IN ('src0', 'src1', 'src2', 'src3', 'src5', 'src8', 'src13') AND (lower(lang) IN ('en', 'de') OR lower(source) IN ('en', 'de'))""")
def k26(spark, d):
    wanted = items.search_keywords(_registry(spark, d), _EXTRA, _BY_CATEGORY)
    return registry_search.candidates(wanted, _issues(spark, d), projects=_SOURCES, labels=_LABELS)


@query("k27_registry_matches", _FOUND + "SELECT * FROM m")
def k27(spark, d):
    return _matches(spark, d)


_RANK = "list_position(['summary', 'description', 'comment', 'attachment', 'linked', 'linked_description', 'linked_comment', 'linked_attachment', 'linked_subtask', 'subtask'], place)"
_FIRST = lambda value, sep, most="": f"SELECT issue_key, mode, array_to_string(list({value} ORDER BY f, {value}){most}, '{sep}') AS v FROM (SELECT issue_key, mode, {value}, min(spot) AS f FROM o WHERE coalesce({value}, '') <> '' GROUP BY ALL) GROUP BY ALL"


@query("k32_registry_deduped", _FOUND + f""", o AS (SELECT *, row(entry, {_RANK}, coalesce(CAST(via AS VARCHAR), ''), pos) AS spot, concat_ws(' ', place, CAST(via AS VARCHAR)) AS label FROM m)
SELECT issue_key, mode, p.v AS places, c.v AS categories, f.v AS fragments, arg_max(confidence, CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END) AS confidence, count(*) AS matches
FROM o LEFT JOIN ({_FIRST("label", "; ")}) p USING (issue_key, mode) LEFT JOIN ({_FIRST("category", ", ")}) c USING (issue_key, mode) LEFT JOIN ({_FIRST("fragment", " | ", "[1:3]")}) f USING (issue_key, mode) GROUP BY ALL""")
def k32(spark, d):
    return registry_search.dedupe_matches(_matches(spark, d))
