"""Queries of the work items."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import items as k
from millrace.plans.registry import query
from millrace.sources.adapters import view

AS_OF = "1998-06-15 00:00:00"
_ISSUES = """SELECT o_orderkey AS issue_id, concat('ISS-', o_orderkey) AS issue_key,
    CASE o_orderkey % 6 WHEN 0 THEN 'In Progress' WHEN 1 THEN 'Testing' WHEN 2 THEN 'To Do' WHEN 3 THEN 'Done' WHEN 4 THEN 'Open' ELSE 'Review' END AS status,
    o_orderkey % 6 = 3 AS done, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Critical' WHEN '2' THEN 'High' ELSE 'Normal' END AS priority,
    o_custkey AS assignee, CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey + 1 END AS reporter, o_custkey + 2 AS creator, o_orderdate AS created, {updated} AS updated,
    CASE o_orderkey % 5 WHEN 0 THEN 'Urgent,demo' WHEN 1 THEN 'urgent' WHEN 2 THEN 'later' ELSE '' END AS label_text, concat('v', CAST(o_orderkey % 9 AS STRING)) AS version,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST({due} AS DATE) END AS due FROM orders"""
_SQL_ISSUES = _ISSUES.replace("{updated}", "o_orderdate + to_days(CAST(o_orderkey % 40 AS INTEGER))").replace("{due}", "o_orderdate + to_days(CAST(o_orderkey % 60 AS INTEGER))")
_SQL_EVENTS = "SELECT concat('ISS-', l_orderkey) AS issue_key, CASE l_linenumber % 3 WHEN 0 THEN 'comment_added' WHEN 1 THEN 'status_changed' ELSE 'label_changed' END AS event_type, l_partkey AS author, l_shipdate AS created FROM lineitem"
_MEMBERS = "SELECT c_custkey AS member FROM customer WHERE c_custkey % 3 = 0"


def _issues(spark, d):
    o = view(spark, d, "orders")
    plus = lambda n: f"timestampadd(DAY, CAST(o_orderkey % {n} AS INT), o_orderdate)"
    text = _ISSUES.replace("{updated}", plus(40)).replace("{due}", plus(60)).replace("FROM orders", "FROM {orders}")
    return spark.sql(text, orders=o)


def _events(spark, d):
    return spark.sql(_SQL_EVENTS.replace("FROM lineitem", "FROM {lineitem}"), lineitem=view(spark, d, "lineitem"))


def _members(spark, d):
    return view(spark, d, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("member"))


def _labelled(spark, d):
    return _issues(spark, d).withColumn("labels", F.filter(F.split("label_text", ","), lambda x: x != ""))


_IDLE = f"CAST(floor((epoch(TIMESTAMP '{AS_OF}') - epoch(updated)) / 86400) AS BIGINT)"


_REASON = f"""concat_ws('; ', CASE WHEN lower(priority) IN ('critical', 'high') THEN 'high priority: ' || priority END,
   CASE WHEN due < DATE '1998-06-15' THEN 'overdue' WHEN due - DATE '1998-06-15' <= 3 THEN 'due within 3 days' WHEN due IS NULL THEN 'no due date' END,
   CASE WHEN label_text LIKE 'Urgent%' THEN 'label: Urgent' WHEN label_text = 'urgent' THEN 'label: urgent' END,
   CASE WHEN {_IDLE} >= 14 THEN 'idle: ' || {_IDLE} || ' days' END)"""


@query("k03_focus_reason", f"SELECT issue_key, {_REASON} AS reason FROM ({_SQL_ISSUES})")
def k03(spark, d):
    return k.focus_reason(_labelled(spark, d), AS_OF, ["Critical", "High"], ["URGENT"])


@query("k05_explain", f"""
SELECT issue_key, assigned_match, status_match, assigned_match AND status_match AS in_assigned, assigned_match AND status_match AND reason <> '' AS in_focus,
  CASE WHEN label_text LIKE 'Urgent%' THEN 'Urgent' WHEN label_text = 'urgent' THEN 'urgent' ELSE '' END AS matched_labels, days_idle, reason
FROM (SELECT *, assignee IN ({_MEMBERS}) AS assigned_match, lower(status) NOT IN ('done', 'review') AS status_match, {_IDLE} AS days_idle, {_REASON} AS reason FROM ({_SQL_ISSUES}))""")
def k05(spark, d):
    return k.explain(_labelled(spark, d), _members(spark, d), AS_OF, ["Critical", "High"], ["urgent"], ["Done", "Review"])


_FROM = f"TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY"  # belongs to the period
_DAYS = f"created >= {_FROM}"


@query("k08_group_events", f"""
SELECT issue_key, event_type, count(*) AS n, min(created) AS first, max(created) AS last FROM (
  SELECT issue_key, event_type, author, created FROM ({_SQL_EVENTS})
  UNION ALL SELECT issue_key, 'issue_created', coalesce(creator, reporter), created FROM ({_SQL_ISSUES}) WHERE {_DAYS}) WHERE author IN ({_MEMBERS}) GROUP BY issue_key, event_type""")
def k08(spark, d):
    found = k.group_events(_issues(spark, d), _events(spark, d), _members(spark, d), AS_OF)
    return found.groupBy("issue_key", "event_type").agg(F.count("*").alias("n"), F.min("created").alias("first"), F.max("created").alias("last"))


@query("k06_member_activity", f"""
SELECT e.author, i.status, e.event_type, count(*) AS n, count(DISTINCT e.issue_key) AS issues FROM ({_SQL_EVENTS}) e JOIN ({_SQL_ISSUES}) i USING (issue_key)
WHERE e.author IN ({_MEMBERS}) AND e.created >= TIMESTAMP '1996-01-01' AND e.created < TIMESTAMP '1997-01-01' GROUP BY e.author, i.status, e.event_type""")
def k06(spark, d):
    rows = k.member_activity(_issues(spark, d), _events(spark, d), _members(spark, d), "1996-01-01", "1996-12-31")
    return rows.groupBy("author", "status", "event_type").agg(F.count("*").alias("n"), F.countDistinct("issue_key").alias("issues"))


@query("k13_candidates", f"""
SELECT issue_key, CASE WHEN ours AND updated <= TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY THEN 'stale' WHEN updated >= {_FROM} THEN 'recent' ELSE 'group' END AS origin
FROM (SELECT *, assignee IN ({_MEMBERS}) AS ours FROM ({_SQL_ISSUES}) WHERE NOT done) WHERE ours OR updated >= {_FROM}""")
def k13(spark, d):
    return k.candidates(_issues(spark, d), _members(spark, d), AS_OF).select("issue_key", "origin")


_TASKS = f"""
SELECT issue_key, status, priority, assignee,
  CASE WHEN active THEN 10 ELSE 0 END + CASE WHEN working THEN 8 ELSE 0 END + CASE WHEN ours THEN 7 ELSE 0 END + CASE WHEN n_status > 0 THEN 6 ELSE 0 END + CASE WHEN n_comments > 0 THEN 5 ELSE 0 END
  + CASE WHEN critical THEN 5 ELSE 0 END + CASE WHEN due_soon THEN 4 ELSE 0 END + CASE WHEN new THEN 4 ELSE 0 END + CASE WHEN touched THEN 3 ELSE 0 END + CASE WHEN review THEN 3 ELSE 0 END
  + CASE WHEN todo AND active THEN 2 ELSE 0 END - CASE WHEN stale THEN 5 ELSE 0 END AS score,
  concat_ws('|', CASE WHEN active THEN 'recent activity of the group' END, CASE WHEN working THEN 'work status' END, CASE WHEN ours THEN 'assigned to the group' END, CASE WHEN n_status > 0 THEN 'status changed' END,
    CASE WHEN n_comments > 0 THEN 'comment of the group' END, CASE WHEN critical THEN 'critical priority' END, CASE WHEN high AND NOT critical THEN 'high priority' END, CASE WHEN due_soon THEN 'due today or tomorrow' END,
    CASE WHEN new THEN 'created in the period' END, CASE WHEN touched THEN 'updated in the period' END, CASE WHEN review THEN 'in review or test' END, CASE WHEN todo AND active THEN 'not begun but discussed' END,
    CASE WHEN stale THEN 'idle for long' END, CASE WHEN overdue THEN 'overdue' END) AS reasons,
  concat_ws('|', CASE WHEN working AND NOT done AND ours AND (active OR touched) THEN 'active_now' END, CASE WHEN touched AND active THEN 'changed_recently' END,
    CASE WHEN NOT done AND (overdue OR high OR due_soon OR stale OR (ours AND idle >= 14) OR (todo AND active)) THEN 'needs_attention' END, CASE WHEN stale THEN 'stale' END, CASE WHEN overdue THEN 'overdue' END,
    CASE WHEN NOT done AND (ours OR known OR n_events > 0) AND NOT active AND NOT touched THEN 'backlog' END) AS categories,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(authors, []), CASE WHEN ours THEN [CAST(assignee AS VARCHAR)] ELSE [] END))), '|') AS active_users, array_to_string(list_sort(coalesce(changed, [])), '|') AS changed,
  idle AS days_idle, CASE WHEN overdue THEN CAST(DATE '1998-06-15' - due AS INTEGER) END AS days_overdue, coalesce(last_event, updated) AS last_activity
FROM (SELECT i.*, coalesce(n_recent, 0) > 0 AS active, coalesce(n_status, 0) AS n_status, coalesce(n_comments, 0) AS n_comments, coalesce(n_events, 0) AS n_events, last_event, authors, changed, coalesce(reporter IN ({_MEMBERS}), false) OR creator IN ({_MEMBERS}) AS known,
        lower(status) IN ('in progress', 'development', 'review', 'testing') AS working, lower(status) IN ('review', 'testing') AS review, lower(status) IN ('to do', 'todo', 'open') AS todo,
        priority = 'Critical' AS critical, priority IN ('Critical', 'High') AS high, coalesce(due BETWEEN DATE '1998-06-15' AND DATE '1998-06-16', false) AS due_soon,
        coalesce(due < DATE '1998-06-15' AND NOT done, false) AS overdue, {_DAYS} AS new, updated >= {_FROM} AS touched, {_IDLE} AS idle, m.member IS NOT NULL AS ours,
        NOT done AND m.member IS NOT NULL AND {_IDLE} >= 14 AS stale
      FROM ({_SQL_ISSUES}) i LEFT JOIN ({_MEMBERS}) m ON m.member = i.assignee
      LEFT JOIN (SELECT issue_key, count_if({_DAYS}) AS n_recent, count_if({_DAYS} AND event_type = 'status_changed') AS n_status, count_if({_DAYS} AND event_type = 'comment_added') AS n_comments, count(*) AS n_events, max(created) AS last_event, list_distinct(list(CAST(author AS VARCHAR))) AS authors, list_distinct(list(event_type) FILTER ({_DAYS} AND event_type <> 'comment_added')) AS changed
                 FROM ({_SQL_EVENTS}) WHERE author IN ({_MEMBERS}) GROUP BY issue_key) e ON e.issue_key = i.issue_key)
WHERE NOT done AND (ours OR working OR touched OR active OR high OR due_soon OR overdue OR stale) OR (touched AND active) OR (NOT done AND (known OR n_events > 0) AND NOT active AND NOT touched)"""


def _tasks(spark, d):
    return k.classify(_issues(spark, d), _events(spark, d), _members(spark, d), AS_OF)


@query("k10_classify", _TASKS)
def k10(spark, d):
    return _tasks(spark, d).withColumns({c: F.array_join(c, "|") for c in ("reasons", "categories", "active_users", "changed")})


_RELEASES = f"SELECT version, concat('release ', version) AS description, issue_key, status, assignee, priority, updated, due FROM ({_SQL_ISSUES}) WHERE assignee IN ({_MEMBERS}) AND updated >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY"


def _releases(spark, d):
    versions = F.array(F.struct(F.col("version").alias("name"), F.concat(F.lit("release "), "version").alias("description")))
    return k.release_rows(_issues(spark, d).withColumn("versions", versions), _members(spark, d), AS_OF)


_KPI = ["active_now", "changed_recently", "needs_attention", "stale", "overdue"]


@query("k14_kpi_rows", f"""
WITH t AS ({_TASKS}), r AS ({_RELEASES})
SELECT 1 AS position, 'all_tasks' AS indicator, CAST(count(*) AS VARCHAR) AS value FROM t UNION ALL SELECT 2, 'group_tasks', CAST(count_if(categories <> '') AS VARCHAR) FROM t
""" + "".join(f" UNION ALL SELECT {i}, '{c}', CAST(count_if(contains('|' || categories || '|', '|{c}|')) AS VARCHAR) FROM t" for i, c in enumerate(_KPI, 3)) + f"""
UNION ALL SELECT 8, 'releases', CAST(count(DISTINCT version) AS VARCHAR) FROM r UNION ALL SELECT 9, 'release_issues', CAST(count(*) AS VARCHAR) FROM r
UNION ALL SELECT 10, 'members', CAST(count(*) AS VARCHAR) FROM ({_MEMBERS}) UNION ALL SELECT 11, 'period', '7 days' UNION ALL SELECT 12, 'stale_after', '14 days' UNION ALL SELECT 13, 'made_at', '{AS_OF}'""")
def k14(spark, d):
    return k.kpi_rows(_tasks(spark, d), _releases(spark, d), _members(spark, d), AS_OF)


@query("k19_needs_attention", f"SELECT issue_key, score, categories FROM ({_TASKS}) WHERE contains('|' || categories || '|', '|needs_attention|')")
def k19(spark, d):
    return k.sheet(_tasks(spark, d), "needs_attention").select("issue_key", "score", F.array_join("categories", "|").alias("categories"))


@query("k12_releases", f"SELECT version, min(description) AS description, count(*) AS issues, min(issue_key) AS first_issue, max(issue_key) AS last_issue FROM ({_RELEASES}) GROUP BY version")
def k12(spark, d):
    return k.releases(_releases(spark, d))


@query("k22_release_rows", _RELEASES)
def k22r(spark, d):
    return _releases(spark, d)


@query("k23_project_members", """
SELECT identity, min(name) AS name, array_to_string(list_sort(list_distinct(list(role))), ', ') AS roles, array_to_string(list_sort(list_distinct(list(team))), ', ') AS teams
FROM (SELECT CASE WHEN o_custkey % 3 = 0 THEN 'acc-' || o_custkey WHEN o_custkey % 3 = 1 THEN 'Customer ' || o_custkey ELSE 'k' || o_custkey END AS identity, 'Display ' || o_custkey AS name, o_orderpriority AS role, o_orderstatus AS team FROM orders) GROUP BY identity""")
def k23(spark, d):
    c = F.col("o_custkey")
    as_ = lambda head: F.concat(F.lit(head), c.cast("string"))
    ids = {"accountId": F.when(c % 3 == 0, as_("acc-")).otherwise(""), "name": F.when(c % 3 == 1, as_("Customer ")), "key": as_("k"), "emailAddress": as_("e"), "displayName": as_("Display ")}
    rows = view(spark, d, "orders").select(*[v.alias(n) for n, v in ids.items()], F.col("o_orderpriority").alias("role"), F.col("o_orderstatus").alias("team"))
    return k.project_members(rows)


@query("k24_load_members", "SELECT CAST(c_custkey AS VARCHAR) AS member, c_name AS name, CAST(c_custkey AS VARCHAR) || '|' || lower(c_name) AS ids FROM customer WHERE c_custkey % 4 <> 0 AND NOT contains(lower(c_name), '13')  AND NOT contains(CAST(c_custkey AS VARCHAR), '13')")
def k24(spark, d):
    rows = view(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("member"), F.col("c_name").alias("name"), (F.col("c_custkey") % 4 != 0).alias("active"))
    return k.load_members(rows, ["13"])


_WORDS = ["licensed", "the", "de la", "public license", "http"]
_HITS = lambda text: "list_filter([" + ", ".join(f"CASE WHEN contains(lower({text}), '{w}') THEN '{w}' END" for w in _WORDS) + "], lambda x: x IS NOT NULL)"
# issues: the first line of a text is the summary, the rest the description; conversations and pages stand for comments and attachments
_FOUND = f"""
WITH i AS (SELECT concat('DOC-', doc_id) AS issue_key, concat('mode ', doc_id % 3) AS mode, concat('area ', doc_id % 2) AS category, split_part(text, chr(10), 1) AS summary,
    substr(text, length(split_part(text, chr(10), 1)) + 2) AS description, doc_id % 4 = 0 AS has_attachment FROM documents),
w AS (SELECT *, {_HITS("concat(summary, chr(10), description)")} AS in_whole, {_HITS("summary")} AS in_summary, {_HITS("description")} AS in_text FROM i),
f AS (SELECT * FROM w WHERE len(in_whole) > 0),
places AS (
  SELECT issue_key, mode, category, has_attachment, 'summary' AS place, CAST(0 AS BIGINT) AS pos, in_summary AS hits FROM f WHERE len(in_summary) > 0
  UNION ALL SELECT issue_key, mode, category, has_attachment, 'description', 1, in_whole FROM f WHERE len(in_summary) = 0 OR len(list_filter(in_text, lambda x: NOT list_contains(in_summary, x))) > 0
  UNION ALL SELECT issue_key, mode, category, has_attachment, 'comment', turn + 2, {_HITS("text")} FROM f JOIN (SELECT concat('DOC-', conv_id) AS issue_key, turn, text FROM conversations) USING (issue_key)
  UNION ALL SELECT issue_key, mode, category, has_attachment, 'attachment', 1002, {_HITS("url")} FROM f JOIN (SELECT concat('DOC-', page_id) AS issue_key, url FROM pages) USING (issue_key)
  UNION ALL SELECT f.issue_key, f.mode, f.category, f.has_attachment, 'linked', 1003, {_HITS("l.text")} FROM f JOIN (SELECT concat('DOC-', doc_id - 1) AS issue_key, text FROM documents) l USING (issue_key)),
m AS (SELECT issue_key, mode, category, place, pos, array_to_string(hits, ', ') AS matched, len(hits) / 5 AS r,
  CASE WHEN place = 'summary' AND len(hits) / 5 >= 0.3 OR place = 'description' AND has_attachment AND len(hits) / 5 >= 0.3 OR place = 'description' AND len(hits) / 5 >= 0.5 THEN 'high'
       WHEN place IN ('comment', 'linked') THEN CASE WHEN len(hits) / 5 >= 0.5 THEN 'medium' ELSE 'low' END WHEN place = 'attachment' THEN 'medium'
       WHEN len(hits) / 5 >= 0.7 THEN 'high' WHEN len(hits) / 5 >= 0.3 THEN 'medium' ELSE 'low' END AS confidence FROM places WHERE len(hits) > 0)
"""


@query("k27_find_matches", _FOUND + "SELECT issue_key, mode, category, place, pos, matched, round(r, 6) AS ratio, confidence FROM m")
def k27(spark, d):
    return _matches(spark, d).drop("fragment")


def _search_issues(spark, d):
    summary = F.split_part("text", F.lit("\n"), F.lit(1))
    docs = view(spark, d, "documents").withColumn("summary", summary)
    return docs.select(F.concat(F.lit("DOC-"), "doc_id").alias("issue_key"), F.concat(F.lit("mode "), (F.col("doc_id") % 3).cast("string")).alias("mode"), F.concat(F.lit("area "), (F.col("doc_id") % 2).cast("string")).alias("category"), "summary", F.substr("text", F.length("summary") + 2).alias("description"), (F.col("doc_id") % 4 == 0).alias("has_attachment"))


def _matches(spark, d):
    said = view(spark, d, "conversations").select(F.concat(F.lit("DOC-"), "conv_id").alias("issue_key"), F.lit("comment").alias("place"), F.col("turn").cast("long").alias("pos"), "text")
    files = view(spark, d, "pages").select(F.concat(F.lit("DOC-"), "page_id").alias("issue_key"), F.lit("attachment").alias("place"), F.lit(1000).cast("long").alias("pos"), F.col("url").alias("text"))
    linked = view(spark, d, "documents").select(F.concat(F.lit("DOC-"), (F.col("doc_id") - 1).cast("string")).alias("issue_key"), F.lit("linked").alias("place"), F.lit(1001).cast("long").alias("pos"), "text")
    return k.find_matches(_search_issues(spark, d), _WORDS, said.unionByName(files).unionByName(linked))


@query("k28_fragments", """
SELECT doc_id, CASE WHEN pos = 0 THEN left(text, 120) ELSE
  CASE WHEN pos - 60 > 1 THEN '...' ELSE '' END || trim(replace(substr(text, greatest(1, pos - 60), least(length(text), pos + 7 + 60) - greatest(1, pos - 60) + 1), chr(10), ' ')) || CASE WHEN pos + 67 < length(text) THEN '...' ELSE '' END END AS fragment
FROM (SELECT doc_id, text, instr(lower(text), 'licensed') AS pos FROM documents)""")
def k28(spark, d):
    return view(spark, d, "documents").select("doc_id", k.fragment(F.col("text"), F.lit("licensed")).alias("fragment"))


@query("k32_dedupe_matches", _FOUND + """
SELECT issue_key, mode, array_to_string(list(place ORDER BY first_at), '; ') AS places, min(category) AS categories, arg_max(confidence, CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END) AS confidence, CAST(sum(n) AS BIGINT) AS matches
FROM (SELECT issue_key, mode, place, min(category) AS category, min(pos) AS first_at, count(*) AS n, arg_max(confidence, CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END) AS confidence FROM m GROUP BY ALL HAVING true) GROUP BY issue_key, mode""".replace("GROUP BY ALL HAVING true", "GROUP BY issue_key, mode, place"))
def k32(spark, d):
    return k.dedupe_matches(_matches(spark, d)).drop("fragments")


@query("k33_confidence_counts", _FOUND + "SELECT confidence, place, count(*) AS n FROM m GROUP BY confidence, place")
def k33(spark, d):
    return _matches(spark, d).groupBy("confidence", "place").agg(F.count("*").alias("n"))


@query("j14_traverse_links", """
WITH e AS (SELECT DISTINCT l_orderkey AS src, l_partkey AS dst FROM lineitem WHERE l_orderkey <> l_partkey),
r AS (SELECT o_orderkey AS root FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000),
d1 AS (SELECT root, dst AS node, min(src) AS via FROM r JOIN e ON src = root WHERE dst <> root GROUP BY root, dst),
d2 AS (SELECT root, dst AS node, min(src) AS via FROM d1 JOIN e ON src = node WHERE dst <> root AND (root, dst) NOT IN (SELECT (root, node) FROM d1) GROUP BY root, dst)
SELECT root, root AS node, 0 AS depth, CAST(NULL AS BIGINT) AS via FROM r UNION ALL SELECT root, node, 1, via FROM d1 UNION ALL SELECT root, node, 2, via FROM d2""")
def j14(spark, d):
    edges = view(spark, d, "lineitem").where("l_orderkey <> l_partkey").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst")).distinct()
    roots = view(spark, d, "orders").where("o_orderstatus = 'P' and o_totalprice > 400000").select(F.col("o_orderkey").alias("root"))
    return k.traverse_links(edges, roots, 2)


@query("k22_event_rows", f"SELECT e.issue_key, e.event_type, e.author, e.created, CAST(row_number() OVER (PARTITION BY e.issue_key ORDER BY e.created DESC, e.event_type, e.author) AS INTEGER) AS place FROM ({_SQL_EVENTS}) e SEMI JOIN ({_TASKS}) t ON e.issue_key = t.issue_key WHERE e.author IN ({_MEMBERS})")
def k22(spark, d):
    """The events of the reported tasks, newest first within each."""
    own = k.group_events(_issues(spark, d).limit(0), _events(spark, d), _members(spark, d), AS_OF)
    newest = Window.partitionBy("issue_key").orderBy(F.desc("created"), "event_type", "author")
    return own.join(_tasks(spark, d).select("issue_key"), "issue_key", "left_semi").withColumn("place", F.row_number().over(newest))


@query("j12_group_events", f"SELECT issue_key, count(*) AS n FROM ({_SQL_EVENTS}) WHERE author IN ({_MEMBERS}) GROUP BY issue_key")
def j12(spark, d):
    own = _events(spark, d).join(_members(spark, d).withColumnRenamed("member", "author"), "author", "left_semi")
    return own.groupBy("issue_key").agg(F.count("*").alias("n"))
