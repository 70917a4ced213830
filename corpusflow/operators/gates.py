"""Quality gates: metrics of a collection and the rules they must satisfy."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import rules
from corpusflow.functions import text as X
from corpusflow.functions import venues as V
from corpusflow.packs import TOPICS, VENUES, LabelPack, VenuePack

LIMITS = {"drop": 0.05, "dblp_failure": 0.30, "other": 0.30, "false_positive": 0.10, "raw_without_relevant": 100}


def ratio(part: Column, whole: Column) -> Column:
    """part / whole to six places, 0 for an empty whole."""
    return F.when(whole > 0, F.round(part / whole, 6)).otherwise(F.lit(0.0))


def drop_ratio(baseline: Column, current: Column, *accounted: Column) -> Column:
    """The share of the baseline that is gone and not accounted for."""
    gone = baseline - current
    for a in accounted:
        gone = gone - a
    return ratio(F.greatest(F.lit(0), gone), baseline)


def duplicate_groups(rows: DataFrame, key: str, title: str, most_titles: int = 20) -> DataFrame:
    """(key, n, titles): keys of several rows, with the first titles of each, at most most_titles."""
    groups = rows.where(F.coalesce(F.col(key), F.lit("")) != "").groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(title)
    named = rows.join(groups, key).withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= most_titles)
    return named.groupBy(key).agg(F.first("n").alias("n"), F.array_sort(F.collect_list(title)).alias("titles"))


def split(rows: DataFrame, level: str = "relevance_level") -> tuple[DataFrame, DataFrame]:
    """Rows kept and rows removed, the latter with a reason."""
    kept = rows.where(F.coalesce(F.col(level), F.lit("")) != rules.IRRELEVANT)
    return kept, rows.where(F.col(level) == rules.IRRELEVANT).withColumn("reason", F.lit(f"relevance_level={rules.IRRELEVANT}"))


def side_volume(papers: DataFrame, venues: VenuePack = VENUES) -> DataFrame:
    """Papers of a venue whose source says that they are of its side volume."""
    name, mark, _ = venues.side_volume
    source = F.lower(F.concat_ws(" ", *[X.text(f) for f in ("booktitle", "journal", "container", "source")]))
    return papers.where((F.col("venue") == name) & F.contains(source, F.lit(mark)))


def metrics(papers: DataFrame, venues: VenuePack = VENUES, topics: LabelPack = TOPICS) -> DataFrame:
    """One row of counts over papers (key, venue, venue_track, labels, relevance_level, FIELDS): a single aggregate."""
    old = F.array(*[F.lit(x) for x in topics.renamed]).cast("array<string>")
    category = V.category(F.col("venue"), venues)
    proven = V.proven_by_source({f: F.col(f) for f in ("booktitle", "journal", "container", "source", "publisher", "url", "doi")}, venues)
    unproven = F.col("venue") == venues.unproven
    source = F.lower(F.concat_ws(" ", *[X.text(f) for f in ("booktitle", "journal", "container", "source")]))
    name, mark, _ = venues.side_volume
    tests = {
        "papers": F.lit(True), "keyed": F.col("key") != "", "irrelevant": F.col("relevance_level") == rules.IRRELEVANT, "deprecated": F.arrays_overlap("labels", old),
        "other": F.col("venue_track") == venues.other, "misplaced": unproven & (F.col("venue_track") != category), "unsupported": unproven & ~proven,
        "side_volume": (F.col("venue") == name) & F.contains(source, F.lit(mark)),
    }
    counts = [F.count_if(F.coalesce(t, F.lit(False))).alias(n) for n, t in tests.items()]
    return papers.agg(*counts, F.countDistinct(F.when(F.col("key") != "", F.col("key"))).alias("unique_titles"))


#: Fatal and warning rules over a row of metrics: name, fatal, and the test that a violation meets.
RULES: list[tuple[str, bool, str]] = [
    ("payload_not_an_object", True, "NOT payload_ok"),
    ("sentinel_version", True, "sentinel_version <> 2"),
    ("duplicate_titles", True, "keyed > unique_titles"),
    ("dry_run_unreadable", True, "changed IS NULL OR stale IS NULL"),
    ("dry_run_changed", True, "changed > 0"),
    ("dry_run_stale", True, "stale > 0"),
    ("unexplained_drop", True, "drop_ratio > 0.05"),
    ("venue_outside_category", True, "misplaced > 0"),
    ("venue_unsupported", True, "unsupported > 0"),
    ("irrelevant_present", True, "irrelevant > 0"),
    ("deprecated_labels", True, "deprecated > 0"),
    ("canary_missed", True, "canaries_missed > 0"),
    ("side_volume_tagged", True, "side_volume > 0"),
    ("config_missing", True, "configs_missing > 0"),
    ("available_without_rawdata", True, "available_without_rawdata > 0"),
    ("required_rawdata_missing", True, "required_missing > 0"),
    ("journals_missing", True, "journals_missing > 0"),
    ("conferences_missing", True, "conferences_missing > 0"),
    ("dblp_failure_ratio", True, "dblp_failure_ratio > 0.3"),
    ("baseline_unavailable", False, "NOT baseline_ok"),
    ("not_published", False, "not_published > 0"),
    ("raw_without_relevant", False, "raw_without_relevant > 0"),
    ("other_ratio", False, "other_ratio > 0.3"),
    ("api_key_unset", False, "NOT api_key_set"),
    ("rate_limited", False, "rate_limited > 0"),
]


def violations(row: DataFrame, gate_rules: list[tuple[str, bool, str]] = RULES) -> DataFrame:
    """(rule, fatal) for every rule that a row of metrics breaks. Rules whose metrics the row lacks are left out;
    a metric that is null breaks no rule but those that ask for null. findings() reports rules left out as well."""
    usable = [r for r in gate_rules if _measured(r, row)]
    marks = F.array(*[F.when(F.coalesce(F.expr(test), F.lit(False)), F.struct(F.lit(name).alias("rule"), F.lit(fatal).alias("fatal"))) for name, fatal, test in usable])
    return row.select(F.explode(F.filter(marks, lambda m: m.isNotNull())).alias("m")).select("m.rule", "m.fatal")


def _measured(rule: tuple[str, bool, str], row: DataFrame) -> bool:
    return set(re.findall(r"[a-z_]+", re.sub(r"\b(?:NOT|IS|NULL|OR|AND)\b", "", rule[2]))) <= set(row.columns)


def findings(row: DataFrame, gate_rules: list[tuple[str, bool, str]] = RULES) -> DataFrame:
    """(rule, fatal, why) for every rule that a row of metrics breaks (why is 'broken') or lacks metrics for ('unmeasured'): a rule
    that was never tested has not passed."""
    names = [F.struct(F.lit(r[0]).alias("rule"), F.lit(r[1]).alias("fatal")) for r in gate_rules if not _measured(r, row)]
    broken = violations(row, gate_rules).withColumn("why", F.lit("broken"))
    if not names:
        return broken
    return broken.unionByName(row.limit(1).select(F.explode(F.array(*names)).alias("m")).select("m.rule", "m.fatal", F.lit("unmeasured").alias("why")))


class Refused(Exception):
    """Fatal rules are broken or untested; found holds (rule, fatal, why) of all findings."""

    def __init__(self, found: list[tuple[str, bool, str]]):
        super().__init__(", ".join(f"{rule} ({why})" for rule, fatal, why in found if fatal))
        self.found = found


def must_hold(row: DataFrame, gate_rules: list[tuple[str, bool, str]] = RULES) -> list[tuple[str, bool, str]]:
    """The findings over a row of metrics, at most one for each rule; Refused if one is fatal."""
    found = sorted(tuple(r) for r in findings(row, gate_rules).collect())
    if any(fatal for _, fatal, _ in found):
        raise Refused(found)
    return found


def pivot_counts(rows: DataFrame, keys: list[str], kind: str, kinds: list[str], weight: str | None = None) -> DataFrame:
    """Counts, or sums of weight, by key with a column for each kind, 0 where there is none."""
    value = F.lit(1) if weight is None else F.col(weight)
    return rows.groupBy(*keys).agg(F.count("*").alias("total"), *[F.coalesce(F.sum(F.when(F.col(kind) == k, value)), F.lit(0)).alias(k) for k in kinds])


def in_all(*keys: DataFrame) -> DataFrame:
    """The number of keys that all collections share."""
    out = keys[0].distinct()
    for k in keys[1:]:
        out = out.intersect(k)
    return out.agg(F.count("*").alias("n"))


def status_histogram(rows: DataFrame, status: str = "status") -> DataFrame:
    return rows.groupBy(F.coalesce(F.col(status), F.lit("unknown")).alias("status")).agg(F.count("*").alias("n"))


def raw_stats(rows: DataFrame, keys: list[str], relevant: Column) -> DataFrame:
    """(keys, candidates, relevant)"""
    return rows.groupBy(*keys).agg(F.count("*").alias("candidates"), F.count_if(F.coalesce(relevant, F.lit(False))).alias("relevant"))


def report_failures(*reports: DataFrame) -> DataFrame:
    """(venue, year, source, status, reason, kind) of the failures and warnings of fetch reports."""
    out = None
    for r in reports:
        for kind in ("failures", "warnings"):
            rows = r.select(F.explode(kind).alias("e")).select("e.*")
            pick = lambda n, rows=rows: F.col(n).cast("string") if n in rows.columns else F.lit(None).cast("string")
            part = rows.select(*[pick(n).alias(n) for n in ("venue", "year", "source", "status")], F.coalesce(pick("error"), pick("reason")).alias("reason"), F.lit(kind).alias("kind"))
            out = part if out is None else out.unionByName(part)
    return out


def verdict(present: Column, level: Column) -> Column:
    """What an audit says of a paper."""
    return F.when(~present, "false_positive_removed").when(level == rules.IRRELEVANT, "false_positive").when(level == rules.CORE, "true_positive_core").otherwise("true_positive_application")


def audit_rows(sample: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Audit records of a sample (title, present, stratum, relevance_level, venue, FIELDS): verdict, what is
    missing, and the sources that prove the paper; known (title, urls) adds sources by title."""
    rows = sample if known is None else sample.join(known.select("title", F.col("urls").alias("__urls")), "title", "left")
    extra = F.col("__urls") if known is not None else F.array().cast("array<string>")
    own = F.array(*[F.when(X.text(f) != "", F.col(f)) for f in ("doi", "url", "openalex_id", "semantic_scholar_id")])
    sources = F.array_distinct(F.concat(F.filter(own, lambda x: x.isNotNull()), F.coalesce(extra, F.array().cast("array<string>"))))
    missing = missing_fields(["doi", "abstract"])
    notes = F.concat_ws("; ", F.when(missing != "", F.concat(F.lit("missing "), missing)), F.when(~F.col("present"), "removed by prune-irrelevant"), F.when(F.size(F.coalesce(extra, F.array().cast("array<string>"))) > 0, "risk-directed sample"))
    return rows.select(
        "title", "present", "stratum", verdict(F.col("present"), F.col("relevance_level")).alias("verdict"), F.col("relevance_level").alias("relevance_level_expected"), "venue", V.category(F.col("venue")).alias("category"),
        "year", (X.text("year") != "").alias("year_ok"), ((X.text("doi") != "") | (X.text("url") != "")).alias("doi_or_url_ok"), sources.alias("external_sources"), notes.alias("notes"),
    )


def audit_summary(sample: DataFrame) -> DataFrame:
    """One row over an audit sample (verdict, present): sizes, false positives and their ratio."""
    current, false = F.count_if(F.col("present")), F.count_if(F.col("present") & (F.col("verdict") == "false_positive"))
    return sample.agg(F.count("*").alias("sample_size"), current.alias("current_size"), false.alias("false_positives"), ratio(false, current).alias("false_positive_ratio"), F.count_if(~F.col("present")).alias("removed"))


def missing_fields(fields: list[str]) -> Column:
    """Names of empty fields, joined by ', '."""
    return F.concat_ws(", ", *[F.when(X.text(f) == "", F.lit(f)) for f in fields])
