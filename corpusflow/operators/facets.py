"""Faceted browsing: counts, drill-down and facets that leave out their own selection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as X

LISTS = ("labels", "stages")
SCALARS = ("category", "year", "venue")


def label_counts(rows: DataFrame, column: str) -> DataFrame:
    """(value, n): rows that have the value in an array."""
    return rows.select(F.explode(F.array_distinct(column)).alias("value")).groupBy("value").agg(F.count("*").alias("n"))


def scalar_counts(rows: DataFrame, column: str, unknown: str = "Unknown") -> DataFrame:
    """(value, n); null and '' count as unknown."""
    value = F.coalesce(F.when(F.col(column).cast("string") != "", F.col(column).cast("string")), F.lit(unknown))
    return rows.groupBy(value.alias("value")).agg(F.count("*").alias("n"))


def all_counts(rows: DataFrame, scalars: list[str], unknown: str = "Unknown") -> DataFrame:
    """(facet, value, n) of all scalar facets in one pass: grouping sets."""
    filled = rows.select(*[F.coalesce(F.when(F.col(c).cast("string") != "", F.col(c).cast("string")), F.lit(unknown)).alias(c) for c in scalars])
    sets = filled.groupingSets([[F.col(c)] for c in scalars], *[F.col(c) for c in scalars]).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    bit = {c: (1 << len(scalars)) - 1 - (1 << (len(scalars) - 1 - i)) for i, c in enumerate(scalars)}
    facet, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for c in scalars:
        facet = F.when(F.col("g") == bit[c], F.lit(c)).otherwise(facet)
        value = F.when(F.col("g") == bit[c], F.col(c)).otherwise(value)
    return sets.select(facet.alias("facet"), value.alias("value"), "n")


def zero_filled(options: DataFrame, counts: DataFrame) -> DataFrame:
    """(value, n) for all options; those without rows count 0."""
    return options.select("value").join(counts, "value", "left").select("value", F.coalesce("n", F.lit(0)).alias("n"))


def top(counts: DataFrame, k: int) -> DataFrame:
    """The k values with most rows, ties by value."""
    return counts.orderBy(F.desc("n"), "value").limit(k)


@dataclass(frozen=True)
class Selection:
    """What a user has chosen: a text to find, at most one of each scalar, and labels that must all be there."""

    text: str = ""
    scalars: dict[str, str] = field(default_factory=dict)
    lists: dict[str, list[str]] = field(default_factory=dict)


def search_text(*columns: str) -> Column:
    """The lowered text that a search looks into; arrays are joined."""
    return F.lower(F.concat_ws(" ", *columns))


def tests(chosen: Selection, text_column: str) -> dict[str, Column]:
    """A predicate for the text and for each facet."""
    out = {"": F.contains(F.col(text_column), F.lit(chosen.text.lower())) if chosen.text else F.lit(True)}
    out |= {c: F.col(c) == v for c, v in chosen.scalars.items() if v}
    for c, values in chosen.lists.items():
        for v in values:
            out[c] = out.get(c, F.lit(True)) & F.array_contains(c, v)
    return out


def matching(rows: DataFrame, chosen: Selection, text_column: str = "search", leave_out: str | None = None) -> DataFrame:
    """Rows that satisfy the selection, but for the facet left out."""
    test = F.lit(True)
    for name, t in tests(chosen, text_column).items():
        if name != leave_out:
            test = test & t
    return rows.where(test)


def drill_down(rows: DataFrame, chosen: Selection, facets: list[str], text_column: str = "search") -> DataFrame:
    """(facet, value, n): for each facet the counts of what the rest of the selection leaves; the text
    always counts. One pass: a row goes to a facet's counts if every other test holds."""
    t = tests(chosen, text_column)

    def others(facet: str) -> Column:
        out = F.lit(True)
        for name, test in t.items():
            if name != facet:
                out = out & test
        return F.coalesce(out, F.lit(False))

    kinds = dict(rows.dtypes)

    def entries(facet: str) -> Column:
        own = F.array_distinct(facet) if kinds[facet].startswith("array") else F.array(F.coalesce(F.col(facet).cast("string"), F.lit("")))
        return F.when(others(facet), F.transform(own, lambda v: F.struct(F.lit(facet).alias("facet"), v.alias("value"))))

    values = [entries(f) for f in facets]
    none = F.array().cast("array<struct<facet:string,value:string>>")
    return rows.select(F.explode(F.concat(*[F.coalesce(v, none) for v in values])).alias("e")).groupBy("e.facet", "e.value").agg(F.count("*").alias("n"))


def tree(taxonomy: DataFrame, counts: DataFrame) -> DataFrame:
    """(parent, child, n, parent_n) of taxonomy (parent_ord, parent, child_ord, child): children without rows are hidden, parents stay."""
    own = counts.select(F.col("value").alias("child"), F.col("n"))
    parents = counts.select(F.col("value").alias("parent"), F.col("n").alias("parent_n"))
    out = taxonomy.join(own, "child", "left").join(parents, "parent", "left")
    seen = F.count(F.when(F.col("n") > 0, 1)).over(Window.partitionBy("parent"))
    out = out.withColumn("__seen", seen)
    keep = (F.col("n") > 0) | ((F.col("__seen") == 0) & (F.col("child_ord") == 0))
    return out.where(keep).select("parent_ord", "parent", F.when(F.col("n") > 0, F.col("child")).alias("child"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("parent_n", F.lit(0)).alias("parent_n"))


def compact(papers: DataFrame) -> DataFrame:
    """The rows of a browser (t, a, au, y, v, vb, c, u, l, s), newest first, then by title downwards."""
    link = F.when(X.text("url") != "", F.col("url")).when(X.text("doi") != "", F.concat(F.lit("https://doi.org/"), F.regexp_replace("doi", r"^https?://(?:dx\.)?doi\.org/", ""))).otherwise("")
    out = papers.select(
        X.text("title").alias("t"), X.text("abstract").alias("a"), X.text("author").alias("au"), X.text("year").alias("y"), X.text("venue").alias("v"),
        F.regexp_replace(X.text("venue"), r"\s*20\d{2}$", "").alias("vb"), X.text("venue_track").alias("c"), link.alias("u"), F.col("labels").alias("l"), F.col("pipeline_stages").alias("s"),
    )
    return out.orderBy(F.desc("y"), F.desc("t"))


def options(rows: DataFrame, column: str, order: list[str] | None = None, descending: bool = False) -> DataFrame:
    """(value, ord): the distinct values of a column in a fixed or in their own order."""
    values = rows.select(F.col(column).alias("value")).where(X.text("value") != "").distinct()
    if order:
        place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col("value"))
        return values.select("value", F.when(place > 0, place).otherwise(len(order) + 1).alias("ord"))
    w = Window.orderBy(F.desc("value") if descending else "value")  # distinct values of a facet: few
    return values.select("value", F.row_number().over(w).alias("ord"))
