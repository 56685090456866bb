"""Search of work items by registry entry: every text is read once for all entries by one multi-pattern automaton."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import r6
from millrace.operators.items import attachment_class, confidence
from millrace.session import parts_for, stored

ENTRIES = 20_000  # of one automaton; a larger registry is searched for in several passes over the texts
HITS = 5_000  # that a task gathers before it hands them on: a batch of texts may have hundreds of times its rows
AROUND = 60  # characters of a fragment on both sides of the first hit
PLACES = ("summary", "description", "comment", "attachment", "linked", "linked_description", "linked_comment", "linked_attachment", "linked_subtask", "subtask")


class Searcher:
    """The keywords of many entries as one Aho-Corasick automaton over lower-case text."""

    def __init__(self, entries: list[tuple[int, list[str]]]):
        import ahocorasick

        self.owners: dict[str, list[tuple[int, int]]] = {}
        for entry, keywords in entries:
            for at, word in enumerate(keywords):
                if word:
                    self.owners.setdefault(word.lower(), []).append((entry, at))
        self.found = ahocorasick.Automaton()
        for word in self.owners:
            self.found.add_word(word, word)
        self.found.make_automaton()

    def words(self, low: str) -> dict[str, tuple[int, int]]:
        """First and last start of every keyword that the text holds."""
        out: dict[str, tuple[int, int]] = {}
        for end, word in self.found.iter(low) if self.owners else ():
            start = end - len(word) + 1
            out[word] = (out[word][0] if word in out else start, start)
        return out

    def entries(self, words: dict[str, int]) -> dict[int, tuple[list[int], int, int]]:
        """Per entry the places of its keywords in its list, and start and length of the first of them in the text."""
        out: dict[int, list[tuple[int, int, int]]] = {}
        for word, start in words.items():
            for entry, at in self.owners[word]:
                out.setdefault(entry, []).append((at, start, len(word)))
        ordered = {e: sorted(found) for e, found in out.items()}
        return {e: ([x[0] for x in hits], hits[0][1], hits[0][2]) for e, hits in ordered.items()}


def cut(text: str, start: int, length: int) -> str:
    """The hit with up to AROUND characters on both sides, in one line, dots where text is left out."""
    a, b = max(0, start - AROUND), min(len(text), start + length + AROUND)
    return ("..." if a else "") + text[a:b].replace("\n", " ").strip() + ("..." if b < len(text) else "")


def _passes(registry: DataFrame, entries: int) -> Iterator[list[tuple[int, list[str]]]]:
    """The registry's (entry, keywords), at most about `entries` at a time."""
    n = -(-registry.count() // entries)
    for k in range(n):
        rows = registry.where(F.pmod(F.xxhash64("entry"), F.lit(n)) == k).select("entry", "keywords").collect()
        yield [(r["entry"], r["keywords"]) for r in rows]


def text_hits(texts: DataFrame, registry: DataFrame, *, entries: int = ENTRIES) -> DataFrame:
    """(entry, at, fragment) with all columns of texts but `text`: a row for every entry with a keyword in text.

    at: the places (from 0) of these keywords in the entry's list. Case does not matter; null and empty texts and
    keywords give nothing.
    """
    keep = [c for c in texts.columns if c != "text"]
    schema = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in keep) + ", entry long, at array<int>, fragment string"
    return _searched(texts.where("text <> ''"), registry, schema, entries, lambda s, row: [(e, at, cut(row[-1], a, n)) for e, (at, a, n) in s.entries({w: x[0] for w, x in s.words(row[-1].lower()).items()}).items()], keep, ["text"])


def issue_hits(issues: DataFrame, registry: DataFrame, *, entries: int = ENTRIES) -> DataFrame:
    """Per issue and entry with a keyword in summary, line break and description: the keywords found in the whole, the
    summary and the description alone (`in_whole`, `in_summary`, `in_text`), and fragments of the three."""

    def found(s: Searcher, row: tuple) -> list[tuple]:
        summary, text = row[-2] or "", row[-1] or ""
        low, whole = summary.lower(), f"{summary}\n{text}"
        words = s.words(f"{low}\n{text.lower()}")
        one = s.entries({w: x[0] for w, x in words.items() if x[0] + len(w) <= len(low)})
        held = any(x[1] > len(low) for x in words.values())
        alone = s.entries({w: x[0] for w, x in s.words(text.lower()).items()}) if held else {}
        out = []
        for e, (at, a, n) in s.entries({w: x[0] for w, x in words.items()}).items():
            head, body = one.get(e), alone.get(e)
            out.append((e, at, head[0] if head else [], body[0] if body else [], cut(whole, a, n), cut(summary, *head[1:]) if head else None, cut(text, *body[1:]) if body else None))
        return out

    schema = f"issue_key {issues.schema['issue_key'].dataType.simpleString()}, entry long, in_whole array<int>, in_summary array<int>, in_text array<int>, fragment string, summary_fragment string, text_fragment string"
    return _searched(issues, registry, schema, entries, found, ["issue_key"], ["summary", "description"])


def _searched(rows: DataFrame, registry: DataFrame, schema: str, entries: int, found, keep: list[str], read: list[str]) -> DataFrame:
    """`keep` of each row beside what found(searcher, row) gives for it; a pass over rows per automaton."""
    names = [x.strip().rsplit(" ", 1)[0].strip("`") for x in schema.replace("array<int>", "array").split(", ")]
    out = None
    for part in _passes(registry, entries):
        sent = rows.sparkSession.sparkContext.broadcast(part)

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            searcher = Searcher(sent.value)
            for batch in batches:
                rows = []
                for row in zip(*[batch[c].tolist() for c in keep + read]):
                    rows.extend((*row[: len(keep)], *hit) for hit in found(searcher, row))
                    if len(rows) >= HITS:
                        yield pd.DataFrame(rows, columns=names, dtype=object)
                        rows = []
                yield pd.DataFrame(rows, columns=names, dtype=object)

        hits = rows.select(*keep, *read).mapInPandas(run, schema)
        out = hits if out is None else out.unionAll(hits)
    return out if out is not None else rows.sparkSession.createDataFrame([], schema)


def candidates(registry: DataFrame, issues: DataFrame, *, projects: list[str] = (), components: list[str] = (), labels: list[str] = ()) -> DataFrame:
    """(entry, issue_key) of the issues that hold a wanted keyword and pass the filters; an empty filter lets all pass.

    registry: entry, wanted (the entry's keywords, extra ones and those of its category); issues: issue_key, summary,
    description, and project, component, labels (an array) as far as they are asked for.
    """
    return issue_hits(filtered(issues, projects, components, labels), registry.select("entry", F.col("wanted").alias("keywords"))).select("entry", "issue_key")


def filtered(issues: DataFrame, projects: list[str] = (), components: list[str] = (), labels: list[str] = ()) -> DataFrame:
    """Issues of these projects and components with one of these labels, whatever the case."""
    low = lambda xs: [x.lower() for x in xs]
    if projects:
        issues = issues.where(F.lower("project").isin(low(projects)))
    if components:
        issues = issues.where(F.lower("component").isin(low(components)))
    if labels:
        issues = issues.where(F.arrays_overlap(F.transform("labels", F.lower), F.array(*map(F.lit, low(labels)))))
    return issues


_MANUAL = {"image": "low", "pdf": "low", "document": "low", "table": "low", "xml": "medium", "json": "medium"}


def find_matches(issues: DataFrame, registry: DataFrame, comments: DataFrame, attachments: DataFrame, links: DataFrame, subtasks: DataFrame, *, depth: int = 2, projects: list[str] = (), components: list[str] = (), labels: list[str] = (), entries: int = ENTRIES) -> DataFrame:
    """Where the issues that pass the filters hold keywords of each registry entry, in ten kinds of places.

    issues: issue_key, summary, description, has_attachment (and what the filters ask for); registry: entry, mode,
    category, keywords; comments: issue_key, pos, text; attachments: issue_key, pos, name, mime; links and subtasks:
    issue_key, other. An issue counts for an entry if its summary and description hold one of the entry's own keywords.
    Then its summary is a place, its description too unless the summary matched and it adds no keyword; further its
    comments, names of attachments, subtasks (whole) and linked issues (summaries). From depth 2 on, descriptions,
    comments, attachments and subtasks' summaries of linked issues count as well. Another issue counts once per issue:
    as a link if it is one, else as the subtask of its first link. Attachments without a keyword are listed for review
    by their class. Entries without keywords and issues without text give nothing.

    issue_key, entry, mode, category, place, via (the other issue), pos, matched, ratio, fragment, status, confidence.
    """
    registry = stored(registry.select("entry", "mode", "category", "keywords"), "registry")
    own = stored(issue_hits(issues, registry, entries=entries))
    counted = filtered(issues, projects, components, labels).select("issue_key", "has_attachment")
    pairs = own.join(counted, "issue_key")
    none, text = F.lit(None).cast(issues.schema["issue_key"].dataType), F.lit(None).cast("string")

    def spots(rows: DataFrame, place: str, at: str, fragment: Column | str, via: Column | str = none, pos: Column | str = F.lit(0), **more: Column) -> DataFrame:
        col = lambda x: F.col(x) if isinstance(x, str) else x
        return rows.select("issue_key", "entry", F.lit(place).alias("place"), col(via).alias("via"), col(pos).cast("long").alias("pos"), F.col(at).alias("at"), col(fragment).alias("fragment"), more.get("attached", F.lit(False)).alias("attached"), more.get("kind", text).alias("kind"))

    titled = F.concat(F.when(F.coalesce("summary", F.lit("")) != "", F.concat(F.lit("["), "summary", F.lit("] "))).otherwise(""), "fragment")
    adds = (F.size("in_summary") == 0) | (F.size(F.array_except("in_text", "in_summary")) > 0)
    gate = stored(pairs.select("issue_key", "entry"))
    ties = stored(links.where("other <> issue_key").select("issue_key", "other").join(gate.select("issue_key").distinct(), "issue_key", "left_semi").distinct(), "ties")
    kids = subtasks.where("other <> issue_key").select("issue_key", "other").distinct()
    told = stored(text_hits(comments.select("issue_key", "pos", "text"), registry, entries=entries))
    kind = attachment_class(F.col("name"), F.col("mime"))
    files = attachments.select("issue_key", "pos", kind.alias("kind"), F.col("name").alias("text"))
    named = stored(text_hits(files, registry, entries=entries))

    def attached(owners: DataFrame, place: str, via: Column | str) -> DataFrame:
        """Attachments by name, and those without a keyword of the entry by class; owners: issue_key, entry, of."""
        hits = named.select(F.col("issue_key").alias("of"), "entry", "pos", "at", "fragment")
        listed = owners.join(files.drop("text").withColumnRenamed("issue_key", "of"), "of").join(hits, ["of", "entry", "pos"], "left").where(F.col("at").isNotNull() | F.col("kind").isin(list(_MANUAL)))
        return spots(listed, place, "at", "fragment", via, "pos", kind=F.col("kind"))

    rows = [
        spots(pairs.where(F.size("in_summary") > 0), "summary", "in_summary", "summary_fragment"),
        spots(pairs.where(adds).join(issues.select("issue_key", "summary"), "issue_key"), "description", "in_whole", titled, attached=F.col("has_attachment")),
        spots(told.join(gate, ["issue_key", "entry"]), "comment", "at", "fragment", pos="pos"),
        attached(gate.withColumn("of", F.col("issue_key")), "attachment", none),
    ]
    theirs = own.withColumnRenamed("issue_key", "other")
    rows.append(spots(ties.join(theirs.where(F.size("in_summary") > 0), "other").join(gate, ["issue_key", "entry"]), "linked", "in_summary", "summary_fragment", "other"))
    rows.append(spots(kids.join(theirs, "other").join(gate, ["issue_key", "entry"]), "subtask", "in_whole", "fragment", "other"))
    if depth >= 2:
        with_files = issues.select(F.col("issue_key").alias("other"), "has_attachment")
        rows.append(spots(ties.join(theirs.where(F.size("in_text") > 0), "other").join(with_files, "other").join(gate, ["issue_key", "entry"]), "linked_description", "in_text", "text_fragment", "other", attached=F.col("has_attachment")))
        rows.append(spots(ties.join(told.withColumnRenamed("issue_key", "other"), "other").join(gate, ["issue_key", "entry"]), "linked_comment", "at", "fragment", "other", "pos"))
        rows.append(attached(ties.join(gate, "issue_key").withColumnRenamed("other", "of"), "linked_attachment", "of"))
        below = ties.withColumnRenamed("other", "link").join(kids.select(F.col("issue_key").alias("link"), "other"), "link").where("other <> issue_key").join(ties, ["issue_key", "other"], "left_anti")
        first = below.groupBy("issue_key", "other").agg(F.min("link").alias("link"))
        rows.append(spots(first.join(theirs.where(F.size("in_summary") > 0), "other").join(gate, ["issue_key", "entry"]), "linked_subtask", "in_summary", "summary_fragment", "other"))
    every = rows[0]
    for r in rows[1:]:
        every = every.unionAll(r)
    joined = every.join(registry.select("entry", "mode", "category", "keywords"), "entry")
    ratio, found = F.size("at") / F.size("keywords"), F.col("at").isNotNull()
    rule = F.when(F.col("place").isin("description", "linked_description"), "description").when(F.col("place").isin("comment", "linked_comment"), "comment").when(F.col("place").isin("linked", "linked_subtask"), "linked").when(F.col("place").contains("attachment"), "attachment").otherwise(F.col("place"))
    manual = F.create_map(*[F.lit(x) for pair in _MANUAL.items() for x in pair])[F.col("kind")]
    return joined.select(
        "issue_key", "entry", "mode", "category", "place", "via", "pos", F.array_join(F.transform("at", lambda i: F.get("keywords", i)), ", ").alias("matched"), r6(ratio).alias("ratio"), "fragment",
        F.when(found, "found").otherwise("manual").alias("status"), F.when(found, confidence(ratio, rule, F.col("attached"))).otherwise(manual).alias("confidence"),
    )


def dedupe_matches(matches: DataFrame) -> DataFrame:
    """One row per issue and mode: places and categories, each once in the order of entries and places, the first three
    different fragments, the best confidence, and the number of matches.

    Only the first row of each place, category and fragment is gathered per issue and mode. Matches are found once and
    written; the number of partitions follows from theirs, so that what a task holds does not grow with them.
    """
    rank = F.when(F.col("confidence") == "high", 3).when(F.col("confidence") == "medium", 2).otherwise(1)
    place = F.array_position(F.array(*map(F.lit, PLACES)), F.col("place"))
    label = F.when(F.col("via").isNull(), F.col("place")).otherwise(F.concat_ws(" ", "place", F.col("via").cast("string")))
    at = F.struct("entry", place.alias("rank"), F.coalesce(F.col("via").cast("string"), F.lit("")).alias("via"), "pos")
    rows = stored(matches.select("issue_key", "mode", "category", "fragment", "confidence", at.alias("_at"), label.alias("_label")), "matches")
    parts = parts_for(rows)
    one = rows.groupBy("issue_key", "mode").agg(F.max_by("confidence", rank).alias("confidence"), F.count(F.lit(1)).alias("matches"))

    def ordered(value: str, name: str, sep: str, most: int | None = None) -> DataFrame:
        filled = rows.where(F.coalesce(value, F.lit("")) != "").select("issue_key", "mode", value, "_at").repartition(parts, "issue_key", "mode", value)
        firsts = filled.groupBy("issue_key", "mode", value).agg(F.min("_at").alias("_at")).repartition(parts, "issue_key", "mode")
        if most:
            firsts = firsts.withColumn("_n", F.row_number().over(Window.partitionBy("issue_key", "mode").orderBy("_at", value))).where(F.col("_n") <= most)
        listed = F.array_sort(F.collect_list(F.struct("_at", value)))
        return firsts.groupBy("issue_key", "mode").agg(F.array_join(F.transform(listed, lambda x: x[value]), sep).alias(name))

    for value, name, sep, most in (("_label", "places", "; ", None), ("category", "categories", ", ", None), ("fragment", "fragments", " | ", 3)):
        one = one.join(ordered(value, name, sep, most), ["issue_key", "mode"], "left")
    return one.select("issue_key", "mode", "places", "categories", "fragments", "confidence", "matches")
