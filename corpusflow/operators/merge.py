"""Entity resolution: records of one title key become one, in the order of their input.

The merge rule depends on order and has thresholds, so it can't be combined map-side. Rows are dealt by key once, sorted by
key and order within tasks, and streamed past a fold that holds one record: a key of any size takes one pass of one job
and no row, list or task ever holds its members. Cleaning, venues, ranks and labels are columns; only the choice between two
records is Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions import rules
from corpusflow.functions import text as X
from corpusflow.functions import venues as V
from corpusflow.functions.text import let
from corpusflow.operators.buckets import BucketTable
from corpusflow.packs import TOPICS, VENUES, LabelPack, VenuePack
from corpusflow.schema import FIELDS, LIST_FIELDS, SOURCE_FIELDS
from corpusflow.session import materialize, release, release_at_exit, ship

#: Folded records that are given out at a time.
GIVEN = 1000
GAIN = 40
MERGED = (*FIELDS, *LIST_FIELDS)
WEIGHTS = {"doi": 4, "url": 3, "author": 2, "year": 1, "keywords": 1, "openalex_id": 2, "semantic_scholar_id": 2, "key": 1}


def filled(c: Column) -> Column:
    """Not null and not ''."""
    return F.coalesce(c != "", F.lit(False))


def score(e: dict[str, Column], venue: Column, category: Column, pack: VenuePack = VENUES) -> Column:
    """How much a record tells: the higher of two records is the primary one."""
    long = F.length(X.text(e["abstract"]))
    out = F.when(long >= 80, 8).when(long > 0, 3).otherwise(0)
    for name, weight in WEIGHTS.items():
        out = out + F.when(filled(e[name]), weight).otherwise(0)
    out = out + F.when(V.base_name(venue, pack) != pack.other, 3).otherwise(0) + F.when(filled(category) & (category != pack.other), 2).otherwise(0)
    for name in LIST_FIELDS:
        out = out + F.when(F.coalesce(F.size(e[name]), F.lit(0)) > 0, 2).otherwise(0)
    return out


def normalized(papers: DataFrame, venues: VenuePack = VENUES, topics: LabelPack = TOPICS) -> DataFrame:
    """papers (ord, map_key, fields) with clean titles and abstracts, venue, category and topic labels made
    canonical, and __key, the key of the clean title. Rows without a key are kept."""
    title = F.when(F.coalesce(F.col("title"), F.lit("")) == "", F.col("map_key")).otherwise(F.col("title"))
    out = papers.withColumn("title", X.clean_title(title)).withColumn("__key", X.title_key("title")).withColumn("__clean", X.clean_text("abstract"))
    return canonical(out, venues, topics)


def canonical(papers: DataFrame, venues: VenuePack = VENUES, topics: LabelPack = TOPICS) -> DataFrame:
    """Venue, category, labels and score anew; titles stay."""
    out = papers.withColumn("venue", V.entry_venue({f: F.col(f) for f in FIELDS}, venues)).withColumn("venue_track", V.category(F.col("venue"), venues))
    return out.withColumn("labels", rules.normalize_labels("labels", topics))


def told(e: dict[str, Any]) -> int:
    """score() of a record in a fold, whose `points` are those of its venue and category."""
    long = len(e["abstract"] or "")
    out = e["points"] + (8 if long >= 80 else 3 if long else 0)
    return out + sum(weight for f, weight in WEIGHTS.items() if e[f]) + sum(2 for f in LIST_FIELDS if e[f])


def combiner(topics: LabelPack = TOPICS, prefer_first: bool = False) -> Callable[[dict, dict], dict]:
    """The step of the fold: record b into record a, both of MERGED with normalized labels, rank and points. Venue,
    category, source and year are those of the record with the higher rank, of the primary if they tie; the primary
    is the one that tells more, the first if they tie or with prefer_first."""
    place = {label: k for k, label in enumerate(topics.labels)}

    def combine(a: dict, b: dict) -> dict:
        main, other = (b, a) if not prefer_first and told(b) > told(a) else (a, b)
        placed = main if a["rank"] == b["rank"] else a if a["rank"] > b["rank"] else b
        out = {f: main[f] or (main[f] if other[f] is None else other[f]) for f in FIELDS}
        out |= {f: placed[f] for f in (*SOURCE_FIELDS, "venue", "venue_track", "rank", "points")}
        mine, theirs = main["title"], other["title"]
        if not mine or (theirs and min(len(theirs), 140) > min(len(mine), 140)):
            out["title"] = theirs
        mine, theirs = main["abstract"], other["abstract"]
        out["abstract"] = theirs if not mine or (theirs and len(theirs) > len(mine) + GAIN) else mine
        out["year"] = placed["year"] or main["year"] or other["year"]
        for f in LIST_FIELDS:
            out[f] = list(dict.fromkeys([*(main[f] or ()), *(other[f] or ())]))
        out["labels"].sort(key=place.__getitem__)
        return out

    return combine


def fold(rows: DataFrame, keys: list[str], order: str, record: Column, step: Callable[[Any, Any], Any]) -> DataFrame:
    """(keys, order, n, record): the records of each key folded in their order; order is that of the first, n
    their number. Each row's record, a dict if it is a struct, is the start of its fold, so step(a, b) must give records of one type.

    One job: an exchange by key, a sort within tasks, and a stream of Arrow batches past one record at a time. The rows of a key are read by one
    task, as every step needs the one before, but never held. Null keys are equal; rows that tie in order come in any order."""
    ship(rows.sparkSession)
    by = [f"__k{i}" for i in range(len(keys))]
    now = rows.select(*[F.col(k).alias(n) for k, n in zip(keys, by, strict=True)], F.col(order).alias("__o"), record.alias("__r"))
    now = now.repartition(*by).sortWithinPartitions(*by, "__o")
    schema = T.StructType([*now.schema.fields[:-1], T.StructField("__n", T.LongType()), now.schema.fields[-1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        key, first, n, held, types = None, None, 0, None, None

        def give() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in batches:
            types = [*batch.schema.types[:-1], pa.int64(), batch.schema.types[-1]]
            for *own, at, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if n and own == key:
                    held, n = step(held, value), n + 1
                    continue
                if n:
                    done.append((*key, first, n, held))
                    if len(done) >= GIVEN:
                        yield give()
                key, first, n, held = own, at, 1, value
        if n:
            done.append((*key, first, n, held))
            yield give()

    out = now.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, by, strict=True)], F.col("__o").alias(order), F.col("__n").alias("n"), F.col("__r").alias("record"))


def dedupe(papers: DataFrame, venues: VenuePack = VENUES, topics: LabelPack = TOPICS, prefer_first: bool = False, canonical_result: bool = True) -> DataFrame:
    """One record for each title key of papers (ord, map_key, FIELDS, labels, pipeline_stages):
    (title_key, ord, n, fields), n rows having become one. Titles without a key are left out. Ties in ord are
    broken by nothing: ord must be unique within a key."""
    rows, record = _records(papers, venues, topics)
    out = fold(rows.where("title_key <> ''"), ["title_key"], "ord", record, combiner(topics, prefer_first))
    out = out.select("title_key", "ord", "n", *[F.col("record")[f].alias(f) for f in MERGED])
    return canonical(out, venues, topics) if canonical_result else out


def _records(papers: DataFrame, venues: VenuePack, topics: LabelPack) -> tuple[DataFrame, Column]:
    """papers (ord, map_key, MERGED) normalized, with title_key, and each row's record for the fold."""
    rows = normalized(papers.select("ord", "map_key", *MERGED), venues, topics).withColumn("abstract", F.col("__clean"))
    rows = rows.withColumn("__rank", V.merge_precedence(F.col("venue"), venues)).withColumnRenamed("__key", "title_key")
    base = V.base_name(F.col("venue"), venues)
    points = F.when(base != venues.other, 3).otherwise(0) + F.when(filled(F.col("venue_track")) & (F.col("venue_track") != venues.other), 2).otherwise(0)
    return rows, F.struct(*[F.col(f) for f in MERGED], F.col("__rank").alias("rank"), points.alias("points"))


def upsert_papers(existing: DataFrame, incoming: DataFrame, venues: VenuePack = VENUES, topics: LabelPack = TOPICS, prefer_existing: bool = False) -> DataFrame:
    """Papers (title_key, MERGED) after incoming ones (ord, map_key, MERGED) were merged into existing ones, with (added,
    updated, skipped, invalid): how many incoming rows were the first of a new key, changed the record they
    met, changed nothing, or had no key. Those without one are counted in a row of the key ''.

    Existing papers are deduplicated first. A key's incoming rows are merged in order of ord by the rule of the merge: record
    score and venue rank, or, with prefer_existing, what is there stays and only gaps are filled."""
    old = dedupe(existing, venues, topics).withColumns({"ord": F.lit(-1).cast("long"), "map_key": F.lit("")})
    rows, record = _records(old.select("ord", "map_key", *MERGED).unionByName(incoming.select("ord", "map_key", *MERGED)), venues, topics)
    rows, zero = materialize(rows, "records"), F.lit(0).cast("long")
    release_at_exit(rows)

    combine = combiner(topics, prefer_existing)

    def step(a: dict, b: dict) -> dict:
        merged = combine(a["r"], b["r"])
        same = all((merged[f] or None) == (a["r"][f] or None) for f in MERGED)
        return {"r": merged, "updated": a["updated"] + (not same), "skipped": a["skipped"] + same}

    start = F.struct(record.alias("r"), zero.alias("updated"), zero.alias("skipped"))
    out = fold(rows.where("title_key <> ''"), ["title_key"], "ord", start, step)
    out = out.select("title_key", *[F.col("record")["r"][f].alias(f) for f in MERGED], F.when(F.col("ord") >= 0, 1).otherwise(0).cast("long").alias("added"), "record.updated", "record.skipped", zero.alias("invalid"))
    bad = rows.where("title_key = '' AND ord >= 0").agg(F.count("*").alias("invalid")).where("invalid > 0")
    none = [F.lit(None).cast(out.schema[f].dataType).alias(f) for f in MERGED]
    return out.unionByName(bad.select(F.lit("").alias("title_key"), *none, *[zero.alias(c) for c in ("added", "updated", "skipped")], "invalid"))


def papers_table(papers: DataFrame, path: str, buckets: int = 64, venues: VenuePack = VENUES, topics: LabelPack = TOPICS) -> BucketTable:
    """A table of deduplicated papers (title_key, MERGED) that upsert_into() changes."""
    return BucketTable.create(dedupe(papers, venues, topics).select("title_key", *MERGED), path, ["title_key"], buckets)


def upsert_into(table: BucketTable, incoming: DataFrame, venues: VenuePack = VENUES, topics: LabelPack = TOPICS, prefer_existing: bool = False) -> dict[str, int]:
    """upsert_papers() into a papers_table(): only buckets that hold keys of incoming are read and written. The
    counts of upsert_counts() but for the total; rows without a key are counted as invalid and reach no bucket."""
    title = F.when(F.coalesce(F.col("title"), F.lit("")) == "", F.col("map_key")).otherwise(F.col("title"))
    keyed = materialize(incoming.select("ord", "map_key", *MERGED).withColumn("title_key", F.coalesce(X.title_key(X.clean_title(title)), F.lit(""))), "keyed")
    counts = {"added": 0, "updated": 0, "skipped": 0}

    def merged(old: DataFrame, new: DataFrame) -> DataFrame:
        existing = old.select(F.lit(0).cast("long").alias("ord"), F.lit("").alias("map_key"), *MERGED)
        out = materialize(upsert_papers(existing, new, venues, topics, prefer_existing), "upserted")
        release_at_exit(out)
        counts.update(out.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]).first().asDict())
        return out.select("title_key", *MERGED)

    table.upsert(keyed.where("title_key <> ''"), merged)
    counts["invalid"] = keyed.where("title_key = ''").count()
    release(keyed)
    return counts


def upsert_counts(merged: DataFrame) -> DataFrame:
    """One row (added, updated, skipped, invalid, total) over upsert_papers()'s result."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("added", "updated", "skipped", "invalid")]
    return merged.agg(*sums, F.count_if(F.col("title_key") != "").alias("total"))


def duplicates() -> Column:
    """The number of rows that went, as an aggregate over dedupe()'s result."""
    return F.coalesce(F.sum(F.col("n") - 1), F.lit(0))


def first_per_key(rows: DataFrame, keys: list[str], order: str, last: bool = False) -> DataFrame:
    """The first, or last, row of each key: a map-side combined aggregate."""
    rest = [c for c in rows.columns if c not in keys]
    best = (F.max_by if last else F.min_by)(F.struct(*rest), order)
    return rows.groupBy(*keys).agg(best.alias("__r")).select(*[F.col(c) if c in keys else F.col("__r")[c].alias(c) for c in rows.columns])


def upsert(existing: DataFrame, incoming: DataFrame, fields: list[str], prefer_existing: bool = False) -> DataFrame:
    """Records of (key, fields) after an upsert, with status added, updated, skipped, kept or invalid.

    Empty keys are invalid. A field is filled from the incoming record if it is empty, or replaced if that
    record has the higher weight (the number of filled fields) and existing records aren't preferred. kept
    are existing rows that nothing came for; skipped are rows that came and changed nothing."""
    a, b = existing.select("key", F.struct(*fields).alias("__a")), incoming.where("key <> ''").select("key", F.struct(*fields).alias("__b"))
    both = a.join(b, "key", "full_outer")
    weight = lambda s: sum((F.when(filled(F.col(s)[f].cast("string")), 1).otherwise(0) for f in fields), F.lit(0))
    replace = F.lit(False) if prefer_existing else weight("__b") > weight("__a")
    one = lambda f: (
        F.when(F.col("__a").isNull(), F.col("__b")[f]).when(F.col("__b").isNull(), F.col("__a")[f])
        .when(filled(F.col("__b")[f].cast("string")) & (replace | ~filled(F.col("__a")[f].cast("string"))), F.col("__b")[f]).otherwise(F.col("__a")[f])
    )
    merged = F.struct(*[one(f).alias(f) for f in fields])
    status = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "kept").when(merged.eqNullSafe(F.col("__a")), "skipped").otherwise("updated")
    out = both.select("key", *[one(f).alias(f) for f in fields], status.alias("status"))
    bad = incoming.where("key IS NULL OR key = ''").select("key", *fields, F.lit("invalid").alias("status"))
    return out.unionByName(bad)


def acceptable(papers: DataFrame) -> Column:
    """Whether a labelled record may be merged: it has labels, stages and relevance."""
    has = lambda f: F.coalesce(F.size(f), F.lit(0)) > 0
    return has("labels") & has("pipeline_stages") & (rules.relevance_level("title", "abstract", F.col("keywords")) != rules.IRRELEVANT)


def ordered_union(a: Column, b: Column) -> Column:
    """Values of a, then those of b that are new, each once, in their order."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(a, none), F.coalesce(b, none)))
