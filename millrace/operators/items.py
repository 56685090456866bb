"""Work items: reasons, events, classification, reports, search and link traversal over nested records."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import days_between, r6
from millrace.session import saved

# Status and priority groups of the classification, in lower case.
WORKING = ("in progress", "development", "review", "testing", "в работе", "разработка", "тестирование")
REVIEW = ("review", "testing", "тестирование")
TODO = ("to do", "todo", "open", "открыто", "сделать")
CRITICAL = ("critical", "blocker", "highest", "критический", "блокер")
HIGH = (*CRITICAL, "high", "высокий")
# Tracked change fields and the events they make.
CHANGES = {
    "status": "status_changed", "assignee": "assignee_changed", "priority": "priority_changed", "duedate": "duedate_changed", "fixversion": "fixversion_changed",
    "fix version": "fixversion_changed", "fixversions": "fixversion_changed", "components": "component_changed", "component": "component_changed",
    "labels": "label_changed", "description": "description_changed", "summary": "summary_changed",
}

USER = "struct<accountId:string,name:string,key:string,displayName:string,emailAddress:string>"
ISSUE_SCHEMA = f"""key string, fields struct<summary:string,description:string,status:struct<name:string,statusCategory:struct<name:string>>,priority:struct<name:string>,
assignee:{USER},reporter:{USER},creator:{USER},created:string,updated:string,duedate:string,labels:array<string>,components:array<struct<name:string>>,
fixVersions:array<struct<name:string,description:string>>,project:struct<key:string>,issuetype:struct<name:string>,
comment:struct<comments:array<struct<author:{USER},body:string,created:string,updated:string>>>>,
changelog struct<histories:array<struct<author:{USER},created:string,items:array<struct<field:string,fromString:string,toString:string>>>>>"""


def read_issues(spark, path: str, limit: int | None = None) -> DataFrame:
    """Landed JSON records with a declared schema; nothing is inferred."""
    df = spark.read.schema(ISSUE_SCHEMA).json(path)
    return df.limit(limit) if limit else df


def parse_ts(c: Column) -> Column:
    """Timestamp from ISO text with or without an offset; text without one is UTC; null if unreadable."""
    fixed = F.regexp_replace(F.trim(c), r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.try_to_timestamp(fixed)


def parse_date(c: Column) -> Column:
    return F.substring(F.trim(c), 1, 10).try_cast("date")


def local_clock(c: Column) -> Column:
    """HH:mm:ss as written, in the value's own offset."""
    return F.substring(F.trim(c), 12, 8)


def in_time_window(c: Column, start: str, end: str) -> Column:
    """Both ends belong to the window."""
    return local_clock(c).between(start, end)


def display(user: str) -> Column:
    return F.coalesce(*[F.nullif(F.trim(F.col(f"{user}.{f}")), F.lit("")) for f in ("displayName", "name", "emailAddress", "key", "accountId")])


def identities(user: str) -> Column:
    """All filled identity fields in lower case, each once."""
    return F.array_distinct(F.filter(F.transform(F.array(*[F.col(f"{user}.{f}") for f in ("accountId", "name", "key", "displayName", "emailAddress")]), lambda x: F.lower(F.trim(x))), lambda x: x.isNotNull() & (x != "")))


def flatten_issues(df: DataFrame) -> DataFrame:
    names = lambda c: F.array_join(F.transform(c, lambda x: x["name"]), ", ")
    f = "fields."
    return df.select(F.col("key").alias("issue_key"), F.col(f + "summary").alias("summary"), F.col(f + "status.name").alias("status"), F.col(f + "priority.name").alias("priority"), display("fields.assignee").alias("assignee"), display("fields.reporter").alias("reporter"), F.col(f + "created").alias("created"), F.col(f + "updated").alias("updated"), F.col(f + "duedate").alias("due"), F.array_join(f + "labels", ", ").alias("labels"), names(F.col(f + "components")).alias("components"), names(F.col(f + "fixVersions")).alias("versions"), F.col(f + "project.key").alias("project"), F.col(f + "issuetype.name").alias("type"))


def change_events(df: DataFrame) -> DataFrame:
    """issue_key, event_type, author, created, old, new: comments and tracked changes of every issue."""
    kinds = F.create_map(*[F.lit(x) for kv in CHANGES.items() for x in kv])
    h = df.select(F.col("key").alias("issue_key"), F.explode("changelog.histories").alias("h")).select("issue_key", "h", F.explode("h.items").alias("i"))
    changed = h.select("issue_key", kinds[F.lower("i.field")].alias("event_type"), display("h.author").alias("author"), F.col("h.created").alias("created"), F.col("i.fromString").alias("old"), F.col("i.toString").alias("new")).where("event_type is not null")
    c = df.select(F.col("key").alias("issue_key"), F.explode("fields.comment.comments").alias("c"))
    said = c.select("issue_key", F.lit("comment_added").alias("event_type"), display("c.author").alias("author"), F.col("c.created").alias("created"), F.lit(None).cast("string").alias("old"), F.col("c.body").alias("new"))
    return changed.unionByName(said)


def within(c: Column, as_of: str, days: int) -> Column:
    """Whether a time is no more than `days` days before as_of, to the second: the limit itself belongs to it."""
    return F.coalesce(c >= F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days)), F.lit(False))


def group_events(issues: DataFrame, events: DataFrame, members: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Comments and changes by members, and one "issue_created" per issue that a member (the creator, else the
    reporter) has made within the period: issue_key, event_type, author, created."""
    ours = members.select(F.col("member").alias("author")).distinct()
    made = issues.where(within(F.col("created"), as_of, days)).select("issue_key", F.lit("issue_created").alias("event_type"), F.coalesce("creator", "reporter").alias("author"), F.col("created"))
    return events.select("issue_key", "event_type", "author", "created").unionByName(made).join(ours, "author", "left_semi").select("issue_key", "event_type", "author", "created")


def member_activity(issues: DataFrame, events: DataFrame, members: DataFrame, start: str, end: str) -> DataFrame:
    """Events of members from start to end (both days whole) with the issue's status and priority, one row each."""
    when = F.col("created")
    inside = events.where((when >= F.lit(start).cast("timestamp_ntz")) & (when < F.lit(end).cast("timestamp_ntz") + F.make_dt_interval(F.lit(1))))
    own = inside.join(members.select(F.col("member").alias("author")).distinct(), "author", "left_semi")
    return own.join(issues.select("issue_key", "status", "priority"), "issue_key").select("issue_key", "event_type", "author", "created", "status", "priority")


def _focus_parts(as_of: str, priorities: list[str], labels: list[str], due_days: int, stale_days: int, empty_due: bool) -> dict[str, Column]:
    """What the focus rules say of an issue; each is null where its rule does not hold."""
    today = F.lit(as_of).cast("date")
    idle = days_between(F.col("updated"), F.lit(as_of).cast("timestamp_ntz"))
    wanted = F.array_sort(F.array_distinct(F.filter("labels", lambda x: F.lower(x).isin(*[w.lower() for w in labels]) if labels else F.lit(False))))
    return {
        "priority": F.when(F.lower("priority").isin(*[p.lower() for p in priorities]), F.concat(F.lit("high priority: "), "priority")),
        "due": F.when(F.col("due") < today, "overdue").when(F.datediff("due", today) <= due_days, f"due within {due_days} days").when(F.col("due").isNull() & F.lit(empty_due), "no due date"),
        "labels": F.when(F.size(wanted) > 0, F.concat(F.lit("label: "), F.array_join(wanted, ", "))),
        "idle": F.when(idle >= stale_days, F.concat(F.lit("idle: "), idle.cast("string"), F.lit(" days"))),
    }


def focus_reason(df: DataFrame, as_of: str, priorities: list[str], labels: list[str] = [], due_days: int = 3, stale_days: int = 14, empty_due: bool = True) -> DataFrame:  # noqa: B006
    """issue_key and its reasons joined by "; ", in fixed order; the due rules exclude one another."""
    parts = F.array(*_focus_parts(as_of, priorities, labels, due_days, stale_days, empty_due).values())
    return df.select("issue_key", F.array_join(F.filter(parts, lambda x: x.isNotNull()), "; ").alias("reason"))


def explain(df: DataFrame, assignees: DataFrame, as_of: str, priorities: list[str], labels: list[str], excluded: list[str], due_days: int = 3, stale_days: int = 14) -> DataFrame:
    """Why an issue is in the assigned set and the focus set, or not: a row of answers per issue.

    Assigned: its assignee is one of `assignees` (member) and its status is not excluded. Focus: that, and a reason.
    """
    parts = _focus_parts(as_of, priorities, labels, due_days, stale_days, True)
    team = assignees.select(F.col("member").alias("assignee"), F.lit(True).alias("_ours")).distinct()
    reason = F.array_join(F.filter(F.array(*parts.values()), lambda x: x.isNotNull()), "; ")
    status_match = F.coalesce(~F.lower("status").isin(*[x.lower() for x in excluded]), F.lit(True))
    rows = df.join(team, "assignee", "left").withColumns({"assigned_match": F.coalesce("_ours", F.lit(False)), "status_match": status_match, "reason": reason, "matched_labels": F.coalesce(F.substring_index(parts["labels"], "label: ", -1), F.lit("")), "days_idle": days_between(F.col("updated"), F.lit(as_of).cast("timestamp_ntz"))})
    assigned = F.col("assigned_match") & F.col("status_match")
    return rows.select("issue_key", "assigned_match", "status_match", assigned.alias("in_assigned"), (assigned & (F.col("reason") != "")).alias("in_focus"), "matched_labels", "days_idle", "reason")


def related(issues: DataFrame, events: DataFrame, members: DataFrame) -> DataFrame:
    """Keys of issues whose assignee, reporter or creator is a member, or that a member has an event in."""
    ours = members.select("member").distinct()
    people = issues.select("issue_key", F.explode(F.array_distinct(F.array("assignee", "reporter", "creator"))).alias("member"))
    seen = people.unionByName(events.select("issue_key", F.col("author").alias("member"))).join(ours, "member", "left_semi").select("issue_key").distinct()
    return issues.select("issue_key").join(seen, "issue_key", "left_semi")


def candidates(issues: DataFrame, members: DataFrame, as_of: str, days: int = 7, stale_days: int = 14) -> DataFrame:
    """Open issues that are looked at, each once with the last set that holds it: stale over recent over group."""
    team = members.select(F.col("member").alias("assignee"), F.lit(True).alias("_ours")).distinct()
    j = issues.where(~F.col("done")).join(team, "assignee", "left")
    ours = F.coalesce("_ours", F.lit(False))
    old = F.coalesce(F.col("updated") <= F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(stale_days)), F.lit(False))
    origin = F.when(ours & old, "stale").when(within(F.col("updated"), as_of, days), "recent").when(ours, "group")
    return j.withColumn("origin", origin).where("origin is not null").drop("_ours")


def release_rows(issues: DataFrame, members: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """A row per version and issue of the members, done ones as well, updated in the last 30 days or more.

    issues has versions: an array of (name, description); a version without a name is "no name".
    """
    own = issues.join(members.select(F.col("member").alias("assignee")).distinct(), "assignee", "left_semi").where(within(F.col("updated"), as_of, max(days, 30)))
    v = own.select("issue_key", "status", "assignee", "priority", "updated", "due", F.explode("versions").alias("v"))
    return v.select(F.coalesce(F.nullif("v.name", F.lit("")), F.lit("no name")).alias("version"), F.coalesce("v.description", F.lit("")).alias("description"), "issue_key", "status", "assignee", "priority", "updated", "due")


def releases(rows: DataFrame) -> DataFrame:
    """Of release_rows: per version its description (that of its least issue) and the number of issues.

    The issues themselves stay rows of release_rows: a version may have more than one cell should hold.
    """
    return rows.groupBy("version").agg(F.min_by("description", F.struct("issue_key", "description")).alias("description"), F.count("*").alias("issues"), F.min("issue_key").alias("first_issue"), F.max("issue_key").alias("last_issue"))


def classify(issues: DataFrame, events: DataFrame, members: DataFrame, as_of: str, days: int = 7, stale_days: int = 14) -> DataFrame:
    """Score, reasons and categories of every issue that is current.

    issues: issue_key, status, done, priority, assignee, reporter, created, updated, due; events: issue_key, event_type,
    author, created; members: member. Events are summed up per issue before the join, so one busy issue moves one row.
    A done issue is no backlog; an open one is, if its assignee, reporter or creator is a member or it has any event of one.
    """
    now, today = F.lit(as_of).cast("timestamp_ntz"), F.lit(as_of).cast("date")
    recent = lambda c: within(F.col(c), as_of, days)
    own = events.join(members.select(F.col("member").alias("author")).distinct(), "author", "left_semi")
    seen = own.groupBy("issue_key").agg(F.count_if(recent("created")).alias("n_recent"), F.count_if(recent("created") & (F.col("event_type") == "status_changed")).alias("n_status"), F.count_if(recent("created") & (F.col("event_type") == "comment_added")).alias("n_comments"), F.count("*").alias("n_events"), F.max("created").alias("last_event"), F.collect_set(F.col("author").cast("string")).alias("authors"), F.collect_set(F.when(recent("created") & ~F.col("event_type").isin("comment_added", "issue_created"), F.col("event_type"))).alias("changed"))
    j = issues.join(seen, "issue_key", "left")
    for person, flag in (("assignee", "ours"), ("reporter", "reported"), ("creator", "made")):
        j = j.join(members.select(F.col("member").alias(person), F.lit(True).alias(flag)).distinct(), person, "left")
    j = j.na.fill({"ours": False, "reported": False, "made": False, "n_recent": 0, "n_status": 0, "n_comments": 0, "n_events": 0})
    c, low = F.col, lambda n: F.lower(F.trim(F.col(n)))
    active, done = c("n_recent") > 0, c("done")
    idle = days_between(c("updated"), now)
    j = j.withColumns({
        "working": low("status").isin(*WORKING), "review": low("status").isin(*REVIEW), "todo": low("status").isin(*TODO), "critical": low("priority").isin(*CRITICAL), "high": low("priority").isin(*HIGH),
        "due_soon": F.coalesce(c("due").between(today, F.date_add(today, 1)), F.lit(False)), "overdue": F.coalesce((c("due") < today) & ~done, F.lit(False)), "active": active,
        "new": F.coalesce(recent("created"), F.lit(False)), "touched": F.coalesce(recent("updated"), F.lit(False)), "idle": idle, "stale": F.coalesce(~done & c("ours") & (idle >= stale_days), F.lit(False)),
    })
    points = [("active", 10, "recent activity of the group"), ("working", 8, "work status"), ("ours", 7, "assigned to the group"), ("status", 6, "status changed"), ("comment", 5, "comment of the group"), ("critical", 5, "critical priority"), ("only_high", 0, "high priority"), ("due_soon", 4, "due today or tomorrow"), ("new", 4, "created in the period"), ("touched", 3, "updated in the period"), ("review", 3, "in review or test"), ("todo_active", 2, "not begun but discussed"), ("stale", -5, "idle for long"), ("overdue", 0, "overdue")]
    j = j.withColumns({"status_": c("n_status") > 0, "comment_": c("n_comments") > 0, "only_high_": c("high") & ~c("critical"), "todo_active_": c("todo") & c("active")})
    flag = lambda n: c(n if n not in ("status", "comment", "only_high", "todo_active") else f"{n}_")
    score = sum((F.when(flag(n), p).otherwise(0) for n, p, _ in points), F.lit(0))
    listed = lambda pairs: F.filter(F.array(*[F.when(cond, F.lit(text)) for cond, text in pairs]), lambda x: x.isNotNull())
    attention = (c("overdue") | c("high") | c("due_soon") | c("stale") | (c("ours") & (c("idle") >= stale_days)) | c("todo_active_")) & ~done
    categories = listed([(c("working") & ~done & c("ours") & (c("active") | c("touched")), "active_now"), (c("touched") & c("active"), "changed_recently"), (F.coalesce(attention, F.lit(False)), "needs_attention"), (c("stale"), "stale"), (c("overdue"), "overdue"), (~done & (c("ours") | c("reported") | c("made") | (c("n_events") > 0)) & ~c("active") & ~c("touched"), "backlog")])
    current = ~done & (c("ours") | c("working") | c("touched") | c("active") | c("high") | c("due_soon") | c("overdue") | c("stale"))
    out = j.withColumns({"score": score, "reasons": listed([(flag(n), t) for n, _, t in points]), "categories": categories})
    none = F.array().cast("array<string>")
    users = F.array_union(F.coalesce("authors", none), F.when(c("ours"), F.array(c("assignee").cast("string"))).otherwise(none))
    out = out.withColumns({"active_users": F.array_sort(users), "changed": F.array_sort(F.coalesce("changed", none))})
    return out.where(current | (F.size("categories") > 0)).select("active_users", "changed", "issue_key", "status", "priority", "assignee", "score", "reasons", "categories", F.col("idle").alias("days_idle"), F.when(c("overdue"), F.datediff(today, "due")).alias("days_overdue"), F.coalesce("last_event", "updated").alias("last_activity"))


def kpi_rows(tasks: DataFrame, release_rows: DataFrame, members: DataFrame, as_of: str, days: int = 7, stale_days: int = 14) -> DataFrame:
    """The 13 indicators of the report in their order: position, indicator, value (as text)."""
    n = lambda k: F.count_if(F.array_contains("categories", k)).alias(k)
    kinds = ["active_now", "changed_recently", "needs_attention", "stale", "overdue"]
    row = tasks.agg(F.count("*").alias("all_tasks"), F.count_if(F.size("categories") > 0).alias("group_tasks"), *[n(k) for k in kinds])
    shipped = release_rows.agg(F.countDistinct("version").alias("releases"), F.count("*").alias("release_issues"))
    people = members.agg(F.countDistinct("member").alias("members"))
    fixed = {"period": f"{days} days", "stale_after": f"{stale_days} days", "made_at": as_of}
    one = row.crossJoin(F.broadcast(shipped)).crossJoin(F.broadcast(people)).withColumns({k: F.lit(v) for k, v in fixed.items()})  # one row each
    names = ["all_tasks", "group_tasks", *kinds, "releases", "release_issues", "members", *fixed]
    return one.select(F.inline(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(k).alias("indicator"), F.col(k).cast("string").alias("value")) for i, k in enumerate(names, 1)])))


def sheet(tasks: DataFrame, name: str) -> DataFrame:
    return tasks.where(F.array_contains("categories", name))


def project_members(rows: DataFrame) -> DataFrame:
    """(accountId, name, key, emailAddress, displayName, role, team) rows merged by the first identity that is filled:
    roles and teams sorted and joined, and the least display name."""
    filled = [F.nullif(F.trim(F.col(f)), F.lit("")) for f in ("accountId", "name", "key", "emailAddress", "displayName")]
    joined = lambda col: F.array_join(F.array_sort(F.collect_set(col)), ", ").alias(f"{col}s")
    known = rows.withColumn("identity", F.coalesce(*filled)).where("identity is not null")
    return known.groupBy("identity").agg(F.min("displayName").alias("name"), joined("role"), joined("team"))


def load_members(df: DataFrame, exclude: list[str], exclude_inactive: bool = True) -> DataFrame:
    """Members without those that are inactive or match an excluded text in any identity."""
    ids = F.array_distinct(F.filter(F.transform(F.array("member", "name"), lambda x: F.lower(F.trim(x))), lambda x: x.isNotNull() & (x != "")))
    out = df.withColumn("ids", ids).where(F.size("ids") > 0)
    if exclude_inactive:
        out = out.where("active")
    if exclude:
        out = out.where(~F.exists("ids", lambda x: F.lower(x).rlike("|".join(re.escape(p.lower()) for p in exclude))))
    return out.select("member", "name", F.array_join("ids", "|").alias("ids"))


# --- search ---------------------------------------------------------------------------------------------------------


def _held(low: Column, keywords: list[str]) -> Column:
    return F.filter(F.array(*[F.when(low.contains(k.lower()), F.lit(k)) for k in keywords]), lambda x: x.isNotNull())


def matched_keywords(text: Column, keywords: list[str]) -> Column:
    """The keywords that the text holds, in their order, whatever the case; the text is lower-cased once."""
    return F.element_at(F.transform(F.array(F.lower(F.coalesce(text, F.lit("")))), lambda low: _held(low, keywords)), 1)


def fragment(text: Column, keyword: Column, width: int = 120) -> Column:
    """About width/2 characters on both sides of the first hit, with dots where text is left out; the text is searched once."""
    half = width // 2

    def cut(x: Column) -> Column:
        whole, at, size = x["whole"], x["at"], x["size"]
        start, end = F.greatest(F.lit(1), at - half), F.least(size, at + x["wide"] - 1 + half)
        part = F.trim(F.translate(F.substr(whole, start, end - start + 1), "\n", " "))
        return F.when(at > 0, F.concat(F.when(start > 1, "...").otherwise(""), part, F.when(end < size, "...").otherwise(""))).otherwise(F.substring(whole, 1, width))

    once = F.struct(text.alias("whole"), F.instr(F.lower(text), F.lower(keyword)).alias("at"), F.length(text).alias("size"), F.length(keyword).alias("wide"))
    return F.element_at(F.transform(F.array(once), cut), 1)


def confidence(ratio: Column, place: Column, with_attachment: Column) -> Column:
    medium_or_low = F.when(ratio >= 0.5, "medium").otherwise("low")
    return (
        F.when((place == "summary") & (ratio >= 0.3), "high").when((place == "description") & with_attachment & (ratio >= 0.3), "high").when((place == "description") & (ratio >= 0.5), "high")
        .when(place.isin("comment", "linked"), medium_or_low).when(place == "attachment", "medium").when(ratio >= 0.7, "high").when(ratio >= 0.3, "medium").otherwise("low")
    )


def find_matches(issues: DataFrame, keywords: list[str], others: DataFrame | None = None) -> DataFrame:
    """issue_key, mode, category, place, pos, matched, ratio, fragment, confidence: a row per place that holds a keyword.

    issues: issue_key, mode, category, summary, description, has_attachment. An issue counts if its summary and description hold
    a keyword; its summary is a place of its own, and the description (read with the summary before it) one as well,
    unless the summary matched and the description adds no keyword. others: issue_key, place (comment, attachment, linked,
    subtask), pos, text: searched for the issues that count; pos orders places of one kind.
    """
    low = lambda c: F.coalesce(c, F.lit(""))
    whole = F.concat(low(F.col("summary")), F.lit("\n"), low(F.col("description")))
    # generated columns are not computed again where a filter or a later column reads them; each text is searched once
    hits = F.struct(matched_keywords(F.col("summary"), keywords).alias("in_summary"), matched_keywords(F.col("description"), keywords).alias("in_text"))
    across = [k for k in keywords if "\n" in k]  # may lie on both sides of the line break
    spanning = matched_keywords(whole, across) if across else F.array().cast("array<string>")
    searched = issues.select("*", F.inline_outer(F.array(hits if not across else hits.withField("across", spanning))))
    at = lambda w: F.array_contains("in_summary", w) | F.array_contains("in_text", w) | (F.array_contains("across", w) if across else F.lit(False))
    found = searched.withColumn("in_whole", F.filter(F.array(*map(F.lit, keywords)), at)).where(F.size("in_whole") > 0)
    more = (F.size("in_summary") == 0) | (F.size(F.array_except("in_text", "in_summary")) > 0)
    spots = F.array(
        F.when(F.size("in_summary") > 0, F.struct(F.lit("summary").alias("place"), F.lit(0).cast("long").alias("pos"), F.col("in_summary").alias("hits"))),
        F.when(more, F.struct(F.lit("description").alias("place"), F.lit(1).cast("long").alias("pos"), F.col("in_whole").alias("hits"))),
    )
    titled = F.concat(F.when(low(F.col("summary")) != "", F.concat(F.lit("["), "summary", F.lit("] "))).otherwise(""), fragment(whole, F.element_at("hits", 1)))
    said = F.when(F.col("place") == "summary", fragment(F.col("summary"), F.element_at("hits", 1))).otherwise(titled)
    own = found.select("issue_key", "mode", "category", "has_attachment", "summary", "description", F.inline(F.filter(spots, lambda x: x.isNotNull())))
    own = own.select("issue_key", "mode", "category", "has_attachment", "place", "pos", "hits", said.alias("fragment"))
    if others is not None:
        rest = others.select("issue_key", "place", "pos", "text", F.explode_outer(F.array(matched_keywords(F.col("text"), keywords))).alias("hits")).where(F.size("hits") > 0)
        rest = rest.join(found.select("issue_key", "mode", "category", "has_attachment"), "issue_key")
        own = own.unionByName(rest.select("issue_key", "mode", "category", "has_attachment", "place", (F.col("pos") + 2).cast("long").alias("pos"), "hits", fragment(F.col("text"), F.element_at("hits", 1)).alias("fragment")))
    ratio = F.size("hits") / len(keywords)
    return own.select("issue_key", "mode", "category", "place", "pos", F.array_join("hits", ", ").alias("matched"), r6(ratio).alias("ratio"), "fragment", confidence(ratio, F.col("place"), F.col("has_attachment")).alias("confidence"))


def dedupe_matches(matches: DataFrame) -> DataFrame:
    """One row per issue and mode: places and categories, each once in the order of the matches, the first three
    different fragments, the best confidence, and the number of matches."""
    rank = F.when(F.col("confidence") == "high", 3).when(F.col("confidence") == "medium", 2).otherwise(1)
    order = F.array_sort(F.collect_list(F.struct("pos", "place", "category", "fragment"))).alias("m")
    one = matches.groupBy("issue_key", "mode").agg(order, F.max_by("confidence", rank).alias("confidence"), F.count("*").alias("matches"))
    each = lambda f: F.array_distinct(F.filter(F.transform("m", lambda x: x[f]), lambda x: x.isNotNull() & (x != "")))
    return one.select("issue_key", "mode", F.array_join(each("place"), "; ").alias("places"), F.array_join(each("category"), ", ").alias("categories"), F.array_join(F.slice(each("fragment"), 1, 3), " | ").alias("fragments"), "confidence", "matches")


# --- the registry of searches ---------------------------------------------------------------------------------------


def first_mode(text: Column, modes: list[tuple[str, list[str], list[str]]]) -> Column:
    """The first mode whose name holds the text or is in it, or one of whose other names is in it; null if none."""
    low = F.lower(text)
    hit = lambda name, others: low.contains(name.lower()) | F.lit(name.lower()).contains(low) | F.exists(F.array(*[F.lit(a.lower()) for a in others]) if others else F.array().cast("array<string>"), lambda a: F.contains(low, a))
    return F.coalesce(*[F.when(hit(name, others), F.lit(name)) for name, others, _ in modes])


def first_category(text: Column, categories: list[str], default: str) -> Column:
    return F.coalesce(*[F.when(F.lower(text).contains(c.lower()), F.lit(c)) for c in categories], F.lit(default))


def distinct_words(words: Column) -> Column:
    """Each word once whatever its case, as it came first."""
    return F.filter(words, lambda x, i: ~F.exists(F.slice(words, F.lit(1), i), lambda y: F.lower(y) == F.lower(x)))


def parse_registry(rows: DataFrame, modes: list[tuple[str, list[str], list[str]]], categories: list[str], default: str) -> DataFrame:
    """mode, description, category and keywords of every registry row (mode_text, description, category_text).

    modes: (name, other names, keywords). The mode is found in the first cell, else in the description, else the cell
    as it stands. Keywords: those of the mode, terms in backticks, and identifiers with a known ending, cell by cell.
    """
    cells = ("mode_text", "description", "category_text")
    mode = F.coalesce(first_mode(F.col("mode_text"), modes), first_mode(F.col("description"), modes), F.nullif("mode_text", F.lit("")), F.lit("unknown mode"))
    named = rows.withColumn("mode", mode)
    quoted = [F.regexp_extract_all(F.col(c), F.lit("`([^`]+)`"), F.lit(1)) for c in cells]
    camel = [F.regexp_extract_all(F.col(c), F.lit(r"\b([A-Z][a-zA-Z]+(?:Dto|Form|Service|Inventory|Line|Task))\b"), F.lit(1)) for c in cells]
    fixed = F.coalesce(*[F.when(F.col("mode") == n, F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")) for n, _, words in modes], F.array().cast("array<string>"))
    every = named.withColumn("_all", F.concat(fixed, *[x for pair in zip(quoted, camel) for x in pair]))
    return every.select(*[c for c in rows.columns if c not in ("description", "category", "mode", "keywords")], "mode", "description", F.coalesce(F.nullif("category_text", F.lit("")), first_category(F.col("description"), categories, default)).alias("category"), distinct_words(F.col("_all")).alias("keywords"))


def search_keywords(registry: DataFrame, extra: list[str], by_category: dict[str, list[str]]) -> DataFrame:
    """registry with the keywords that find candidates: its own, the extra ones, and those of its category, each once."""
    words = F.coalesce(*[F.when(F.col("category") == c, F.array(*map(F.lit, w))) for c, w in by_category.items()], F.array().cast("array<string>"))
    more = F.array(*map(F.lit, extra)) if extra else F.array().cast("array<string>")
    return registry.withColumn("wanted", F.array_distinct(F.concat("keywords", more, words)))


def match_candidates(registry: DataFrame, texts: DataFrame, projects: list[str] = [], components: list[str] = []) -> DataFrame:  # noqa: B006
    """(entry, issue_key) of every text that holds a wanted keyword, whatever the case; texts: issue_key, text, and
    project and component, if those are asked for. The registry has a row per search: it is small by its nature, and its
    distinct words are sent to the texts, which are read once."""
    for column, allowed in (("project", projects), ("component", components)):
        if allowed:
            texts = texts.where(F.lower(column).isin(*[x.lower() for x in allowed]))
    words = registry.select(F.explode("wanted").alias("w")).select(F.lower("w").alias("w")).distinct()
    hits = texts.join(F.broadcast(words.agg(F.sort_array(F.collect_set("w")).alias("words"))), how="cross")  # one row
    hits = hits.select("issue_key", F.explode(F.filter("words", lambda w: F.contains(F.lower("text"), w))).alias("w"))
    return registry.select("entry", F.explode("wanted").alias("w")).select("entry", F.lower("w").alias("w")).join(hits, "w").select("entry", "issue_key").distinct()


def match_report(matches: DataFrame) -> DataFrame:
    """Lines of a table for deduplicated matches: bars are escaped, line breaks become spaces."""
    cell = lambda c: F.regexp_replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("|"), F.lit("\\|")), r"[\r\n]+", " ")
    return matches.select("issue_key", "mode", F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(c) for c in ("mode", "issue_key", "places", "fragments", "confidence", "categories")]), F.lit(" |")).alias("line"))


def relevance_search(found: list[DataFrame], keywords: list[str]) -> DataFrame:
    """The results of several searches, the first of a key wins, whose summary or first 200 characters of text hold a
    keyword; `place` orders them by `updated`, newest first, then by key."""
    rows = None
    for i, df in enumerate(found):
        part = df.select("issue_key", "summary", "text", "updated", F.lit(i).alias("_from"))
        rows = part if rows is None else rows.unionByName(part)
    first = rows.groupBy("issue_key").agg(F.min_by(F.struct("summary", "text", "updated", "_from"), F.col("_from")).alias("x")).select("issue_key", "x.*")
    hit = (F.size(matched_keywords(F.col("summary"), keywords)) > 0) | (F.size(matched_keywords(F.left("text", F.lit(200)), keywords)) > 0)
    return first.where(hit).select("issue_key", "updated", F.col("_from").alias("search"))


def attachment_class(name: Column, mime: Column) -> Column:
    ext, m = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)), F.lower(mime)
    return F.when(ext.isin("png", "jpg", "jpeg", "gif", "bmp", "webp", "svg") | m.startswith("image/"), "image").when((ext == "pdf") | m.contains("pdf"), "pdf").when(ext.isin("doc", "docx") | m.contains("word"), "document").when(ext.isin("xls", "xlsx") | m.contains("excel") | m.contains("spreadsheet"), "table").when((ext == "xml") | m.contains("xml"), "xml").when((ext == "json") | m.contains("json"), "json").otherwise("other")


def traverse_links(edges: DataFrame, roots: DataFrame, max_depth: int) -> DataFrame:
    """(root, node, depth, via): nodes within max_depth links of each root, each once at its least depth."""
    found = front = roots.select("root", F.col("root").alias("node"), F.lit(0).alias("depth"), F.lit(None).cast("long").alias("via"))
    for depth in range(1, max_depth + 1):
        step = front.join(edges, F.col("node") == F.col("src")).groupBy("root", F.col("dst").alias("node")).agg(F.min("src").alias("via"))
        front = saved(step.join(found.select("root", "node"), ["root", "node"], "left_anti").select("root", "node", F.lit(depth).alias("depth"), "via"))
        found = found.unionByName(front)
    return found


def ordered_distinct(df: DataFrame, key: str, pos: str, value: str) -> DataFrame:
    """Values per key, each once whatever its case, at the place where it came first."""
    first = df.withColumn("_n", F.row_number().over(Window.partitionBy(key, F.lower(value)).orderBy(pos))).where("_n = 1")
    return first.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(pos, value))), lambda x: x[value]), ", ").alias("values"))
