"""Joins between collections: presence, evidence, coverage and change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow import packs
from corpusflow.functions import rules
from corpusflow.functions import text as X
from corpusflow.functions import venues as V
from corpusflow.operators.containment import contained_titles as contained_titles
from corpusflow.packs import VENUES, VenuePack


def canary_status(canaries: DataFrame, papers: DataFrame) -> DataFrame:
    """(title, expected_venue, expected_year, found, actual_title, actual_venue, actual_year, relevance_level, ok)
    for canaries (title, venue, year) against papers (key, title, venue, year, relevance_level)."""
    c = canaries.select("title", F.col("venue").alias("expected_venue"), F.col("year").alias("expected_year"), X.title_key("title").alias("key"))
    p = papers.select("key", F.col("title").alias("actual_title"), F.col("venue").alias("actual_venue"), F.col("year").alias("actual_year"), "relevance_level", F.lit(True).alias("found"))
    out = F.broadcast(c).join(p, "key", "left")  # canaries are a fixed short list
    ok = F.col("found") & (F.col("actual_venue") == F.col("expected_venue")) & (F.col("actual_year") == F.col("expected_year")) & (F.col("relevance_level") != rules.IRRELEVANT)
    return out.select("title", "expected_venue", "expected_year", F.coalesce("found", F.lit(False)).alias("found"), *[F.coalesce(n, F.lit("")).alias(n) for n in ("actual_title", "actual_venue", "actual_year", "relevance_level")], F.coalesce(ok, F.lit(False)).alias("ok"))


def removed(baseline: DataFrame, current: DataFrame, key: str = "key") -> DataFrame:
    """Rows of the baseline whose key is not empty and not in the current collection."""
    return baseline.where(F.col(key) != "").join(current.select(key).distinct(), key, "left_anti")


def verified_pruned(pruned: DataFrame, baseline: DataFrame, current: DataFrame, condition: Column, key: str = "key") -> DataFrame:
    """Rows pruned that were in the baseline, are gone now and satisfy the condition."""
    there = pruned.where((F.col(key) != "") & condition).join(baseline.select(key).distinct(), key, "left_semi")
    return removed(there, current, key)


def policy_removed(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Rows removed that carry the id of a supplemental source."""
    return removed(baseline, current).where((X.text("openalex_id") != "") | (X.text("semantic_scholar_id") != ""))


def best_evidence(evidence: DataFrame, keys: list[str], rank: str, year: str, order: str) -> DataFrame:
    """The evidence of each key with the highest rank, then year as text; of equals the first by order."""
    rest = [c for c in evidence.columns if c not in keys]
    value = F.struct(F.col(rank).alias("r"), F.coalesce(F.col(year).cast("string"), F.lit("")).alias("y"), (-F.col(order)).alias("o"))
    best = evidence.groupBy(*keys).agg(F.max_by(F.struct(*rest), value).alias("__b"))
    return best.select(*[F.col(c) if c in keys else F.col("__b")[c].alias(c) for c in evidence.columns])


PLACE = ("venue", "venue_track", "booktitle", "journal")


def reconcile(papers: DataFrame, evidence: DataFrame, venues: VenuePack = VENUES) -> DataFrame:
    """(key, title, from, to, rawdata_path, rawdata_title, changed) of papers (key, title, PLACE, relevance_level) that have
    evidence (key, target, raw_title, path, booktitle, journal, year, ord): the venue it proves replaces
    a lower one, and an equal one whose category or source says otherwise."""
    known = evidence.withColumn("rank", V.evidence_rank(F.col("target"), venues))
    best = best_evidence(known, ["key"], "rank", "year", "ord").select("key", "target", "rank", "raw_title", "path", F.col("booktitle").alias("__b"), F.col("journal").alias("__j"))
    rows = papers.where(F.col("relevance_level") != rules.IRRELEVANT).join(best, "key")
    now, target = V.base_name("venue", venues), F.col("target")
    own_rank, category = V.evidence_rank(now, venues), V.category(target, venues)
    named = V.source_names("booktitle", target, venues) | V.source_names("journal", target, venues)
    same = (F.col("rank") == own_rank) & (target == now) & (X.text("venue_track") == category) & named
    changed = (F.col("rank") >= own_rank) & ~same
    after = {"venue": target, "venue_track": category, "booktitle": F.coalesce(F.when(F.col("__b") != "", F.col("__b")), F.when(F.col("__j") != "", F.col("__j")), target), "journal": F.when(X.text("__j") != "", F.col("__j")).otherwise(X.text("journal"))}
    old = F.struct(*[X.text(f).alias(f) for f in PLACE])
    return rows.select("key", "title", old.alias("from"), F.when(changed, F.struct(*[after[f].alias(f) for f in PLACE])).otherwise(old).alias("to"), F.col("path").alias("rawdata_path"), F.col("raw_title").alias("rawdata_title"), changed.alias("changed"))


def reconcile_summary(changes: DataFrame, venues: VenuePack = VENUES) -> DataFrame:
    """One row of counts over reconcile()'s result: evidence found, updates, those to a higher venue, those of
    metadata only, and papers that were right already."""
    rank = lambda c: V.evidence_rank(F.col(c)["venue"], venues)
    promoted = F.col("changed") & (rank("to") > rank("from"))
    return changes.agg(
        F.count("*").alias("evidence_matches"), F.count_if("changed").alias("updated_count"), F.count_if(promoted).alias("promoted_count"),
        F.count_if(F.col("changed") & ~promoted).alias("metadata_fix_count"), F.count_if(~F.col("changed")).alias("already_aligned_count"),
    )


def to_enrich(papers: DataFrame, group: list[str], order: str, pattern: str | None = None, most: int | None = None) -> DataFrame:
    """Papers (title, abstract, ...) to look up an abstract for: those without one whose title matches the
    pattern in any case, of each group the first `most` by order. What is counted are attempts, whatever comes of them."""
    out = papers.where(X.text("abstract") == "")
    if pattern is not None:
        out = out.where(X.text("title").rlike(f"(?iU){pattern}"))
    if most is None:
        return out
    return out.withColumn("__r", F.row_number().over(Window.partitionBy(*group).orderBy(order))).where(F.col("__r") <= most).drop("__r")


def apply_by_key(rows: DataFrame, results: DataFrame, key: str, fields: list[str], order: str | None = None) -> DataFrame:
    """rows with empty fields filled from results of the same key (a DOI, say); rows without a result stay. Of several results
    each field has its first that isn't null in the order of a column, without one the smallest."""
    pick = lambda f: F.min(f) if order is None else F.min_by(f, F.when(F.col(f).isNotNull(), F.col(order)))
    first = results.groupBy(key).agg(*[pick(f).alias(f"__{f}") for f in fields])
    out = rows.join(first, key, "left")
    for f in fields:
        out = out.withColumn(f, F.when(X.text(f) == "", F.coalesce(f"__{f}", f)).otherwise(F.col(f)))
    return out.drop(*[f"__{f}" for f in fields])


def index_links(pages: DataFrame, titles: DataFrame, link_text: str = "abs") -> DataFrame:
    """(title, path, url): titles found in index pages (path, content) of paper blocks, by simple key."""
    from corpusflow.sources.pages import index_entries

    links = index_entries(pages, link_text).select("path", X.simple_key("title").alias("k"), F.col("href").alias("url"))
    return titles.select("title", X.simple_key("title").alias("k")).join(links.where("url <> '' AND k <> ''"), "k").drop("k")


def route(url: Column, doi: Column) -> Column:
    """Where an abstract is to be had, by the shape of link and DOI."""
    return (
        F.when(F.contains(url, F.lit(packs.VIRTUAL_ROUTE)) & url.rlike("/(?:poster|paper)/"), "virtual")
        .when(F.contains(url, F.lit(packs.DETAILS_ROUTE)), "researchr")
        .when(F.lower(url).endswith(".pdf"), "pdf")
        .when(F.contains(url, F.lit(packs.PMLR_ROUTE)), "pmlr")
        .when(F.contains(url, F.lit(packs.NEURIPS_ROUTE)), "neurips")
        .when(F.lower(doi).startswith(packs.ANTHOLOGY_ROUTE), "anthology")
        .when(doi != "", "doi")
        .otherwise("none")
    )


def changes(current: DataFrame, stored: DataFrame, key: str, value: str) -> DataFrame:
    """(key, state): new, changed, same or stale, by a full outer join of fingerprints."""
    a, b = current.select(key, F.col(value).alias("__a"), F.lit(True).alias("__ia")), stored.select(key, F.col(value).alias("__b"), F.lit(True).alias("__ib"))
    both = a.join(b, key, "full_outer")
    state = F.when(F.col("__ia").isNull(), "stale").when(F.col("__ib").isNull(), "new").when(F.col("__a").eqNullSafe(F.col("__b")), "same").otherwise("changed")
    return both.select(key, state.alias("state"))


def fingerprints(files: DataFrame, group: Column) -> DataFrame:
    """(grp, fingerprint, files) of files (path, sha256): a hash over paths and hashes that no order of input changes.

    A group's files are dealt by the hash of their path to 4,096 parts, each hashed in order of path; the parts' hashes make
    the group's. So a group of any size is many rows of bounded ones, not one."""
    rows = files.select(group.alias("grp"), "path", "sha256", F.left(F.sha2("path", 256), F.lit(3)).alias("part"))
    lines = F.array_sort(F.collect_list(F.concat_ws(":", "path", "sha256")))
    parts = rows.groupBy("grp", "part").agg(F.sha2(F.array_join(lines, "\n"), 256).alias("h"), F.count("*").alias("n"))
    whole = F.array_sort(F.collect_list(F.concat_ws(":", "part", "h")))
    return parts.groupBy("grp").agg(F.sha2(F.array_join(whole, "\n"), 256).alias("fingerprint"), F.sum("n").alias("files"))


def coverage(expected: DataFrame, actual: DataFrame, keys: list[str], official: DataFrame | None = None) -> DataFrame:
    """expected (keys) with files, raw_candidates, present and status: available, or missing; sites that are known to be official but have no files are official_missing."""
    counts = actual.groupBy(*keys).agg(F.count("*").alias("files"), F.sum("raw_candidates").alias("raw_candidates"))
    out = expected.join(counts, keys, "left").withColumns({"files": F.coalesce("files", F.lit(0)), "raw_candidates": F.coalesce("raw_candidates", F.lit(0))})
    out = out.withColumn("present", F.col("files") > 0)
    if official is not None:
        out = out.join(official.select(*keys, F.lit(True).alias("__official")).distinct(), keys, "left")
        status = F.when(F.col("present"), "available").when(F.col("__official"), "official_missing").otherwise("missing")
        return out.withColumn("status", status).drop("__official")
    return out.withColumn("status", F.when(F.col("present"), "available").otherwise("missing"))


def failed_among(selected: DataFrame, failures: DataFrame, name: str = "venue") -> DataFrame:
    """Selected names that failures have, whatever their case."""
    return selected.join(failures.select(F.upper(name).alias("__f")).distinct(), F.upper(F.col(name)) == F.col("__f"), "left_semi")


def attempted_since(state: DataFrame, since: Column, statuses: list[str]) -> DataFrame:
    """State rows with one of the statuses whose last attempt is not before `since`."""
    return state.where(F.col("status").isin(statuses) & (F.try_to_timestamp("last_attempt_at") >= since))


def nearest_before(points: DataFrame, marks: DataFrame, group: str, at: str, value: str, unit: str = "day") -> DataFrame:
    """points with the value of the last mark at or before them in their group; marks without a value don't count.

    An as-of join by union and window. Rows are dealt by group and unit of time, so a group of any size is many
    tasks; the last value of each unit, one row for it, is carried over to the units after it."""
    both = points.select(group, at, F.lit(None).alias("__v"), F.struct(*points.columns).alias("__p")).unionByName(marks.select(group, at, F.col(value).alias("__v"), F.lit(None).cast(points.select(F.struct(*points.columns)).schema[0].dataType).alias("__p")))
    both = both.withColumn("__u", F.date_trunc(unit, at))
    units = both.groupBy(group, "__u").agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.col(at))).alias("__last"))
    before = Window.partitionBy(group).orderBy("__u").rowsBetween(Window.unboundedPreceding, -1)
    units = units.select(group, "__u", F.last("__last", ignorenulls=True).over(before).alias("__carried"))
    w = Window.partitionBy(group, "__u").orderBy(at, F.col("__p").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("__own", F.last("__v", ignorenulls=True).over(w)).where("__p IS NOT NULL")
    out = out.alias("o").join(units.alias("u"), F.col(f"o.{group}").eqNullSafe(F.col(f"u.{group}")) & F.col("o.__u").eqNullSafe(F.col("u.__u")), "left")
    return out.select("__p.*", F.coalesce("__own", "__carried").alias(value))
