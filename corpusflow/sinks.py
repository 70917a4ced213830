"""Sinks: canonical JSON, reports, Markdown and a browsable page. All files are written by Spark,
so any file system that it knows will do; a rebuilt collection is swapped in only when it is whole."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators.merge import first_per_key


def write_sorted_json(papers: DataFrame, path: str, title: str = "title") -> None:
    """One JSON object to a line, in code-point order of titles over all files in order of their names."""
    papers.repartitionByRange(F.col(title)).sortWithinPartitions(title).write.mode("overwrite").json(path, ignoreNullFields=True)


def write_json_object(papers: DataFrame, path: str, key: str = "title") -> None:
    """A single JSON object {title: record} in one text file, for collections that a person opens.

    One task writes it, as the format is one object: use write_sorted_json for large collections."""
    name = F.regexp_replace(F.to_json(F.array(F.col(key))), r"(?s)^\[(.*)\]$", "$1")
    rows = papers.select(F.col(key).alias("k"), F.concat(name, F.lit(": "), F.to_json(F.struct("*"))).alias("v"))
    ordered = rows.repartitionByRange(1, "k").sortWithinPartitions("k").select("v", F.monotonically_increasing_id().alias("i"))
    edge = lambda text: papers.sparkSession.createDataFrame([(text,)], "value string")
    entries = ordered.select(F.concat(F.when(F.col("i") > 0, F.lit(",")).otherwise(F.lit(" ")), F.col("v")).alias("value"))
    whole = edge("{").coalesce(1).union(entries).union(edge("}").coalesce(1))
    whole.coalesce(1).write.mode("overwrite").text(path)


def report(rows: DataFrame, list_name: str, **counts: F.Column) -> DataFrame:
    """(value): one JSON text with a summary of counts and the rows as a list. For reports: the
    rows of a report are few by its nature."""
    return rows.agg(F.to_json(F.struct(F.struct(*[c.alias(n) for n, c in counts.items()]).alias("summary"), F.collect_list(F.struct(*rows.columns)).alias(list_name))).alias("value"))


def extend_prune_report(old: DataFrame | None, new: DataFrame, key: str = "title") -> DataFrame:
    """Rows of an earlier report, then new ones, the first of each title key; no earlier report (or one
    that can't be read) starts afresh. Rows without a key go."""
    both = new.withColumn("__o", F.lit(1)) if old is None else old.withColumn("__o", F.lit(0)).unionByName(new.withColumn("__o", F.lit(1)), allowMissingColumns=True)
    keyed = both.withColumn("__key", X.title_key(key)).where("__key <> ''").withColumn("__at", F.struct("__o", key))
    return first_per_key(keyed, ["__key"], "__at").drop("__key", "__o", "__at")


def markdown_table(rows: DataFrame, columns: list[str], title: str) -> DataFrame:
    """(value): lines of a Markdown table; bars in cells are escaped."""
    spark = rows.sparkSession
    head = spark.createDataFrame([(0, f"# {title}\n\n| {' | '.join(columns)} |\n|{' --- |' * len(columns)}")], "o int, value string")
    cell = lambda c: F.replace(X.text(c), F.lit("|"), F.lit("\\|"))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(c) for c in columns]), F.lit(" |"))
    return head.unionByName(rows.select(F.lit(1).alias("o"), line.alias("value"))).orderBy("o", "value").select("value")


TEMPLATE = """<!doctype html><meta charset="utf-8"><title>{title}</title>
<h1>{title} <small>{total}</small></h1><select>{years}</select><select>{venues}</select><select>{categories}</select>
<script>const topics={topics},stages={stages},papers=[PAPERS];</script>"""


def option_list(counts: dict[str, int], values: list[str], everything: str) -> str:
    """Options with counts, 0 for values without rows, after one for all."""
    import html

    return "".join([f'<option value="">{everything}</option>'] + [f'<option value="{html.escape(v)}">{html.escape(v)} ({counts.get(v, 0)})</option>' for v in values])


def write_page(papers: DataFrame, path: str, title: str, categories: list[str]) -> None:
    """A page with all papers of a compact table (facets.compact) and its facets, as one text file below path.

    Papers go from tasks to the file in order, one to a line; only the counts of facets come to the driver. The format is one
    file, so one task writes it."""
    from corpusflow.operators import facets

    spark = papers.sparkSession
    count = lambda df: {r["value"]: r["n"] for r in df.collect()}
    years, venues, cats = (count(facets.scalar_counts(papers, c)) for c in ("y", "vb", "c"))
    safe = lambda v: json.dumps(v, ensure_ascii=False).replace("</", "<\\/")
    head, tail = TEMPLATE.format(
        title=title, total=papers.count(), years=option_list(years, sorted((y for y in years if y != "Unknown"), reverse=True), "All Years"), venues=option_list(venues, sorted(venues), "All Venues"),
        categories=option_list(cats, categories, "All Categories"), topics=safe(count(facets.label_counts(papers, "l"))), stages=safe(count(facets.label_counts(papers, "s"))),
    ).split("PAPERS")
    edge = lambda text: spark.createDataFrame([(text,)], "value string").coalesce(1)
    one = papers.repartitionByRange(1, F.desc("y"), F.desc("t")).sortWithinPartitions(F.desc("y"), F.desc("t")).select("*", F.monotonically_increasing_id().alias("__i"))
    record = F.replace(F.to_json(F.struct(*papers.columns), {"ignoreNullFields": "false"}), F.lit("</"), F.lit("<\\/"))
    lines = one.select(F.concat(F.when(F.col("__i") > 0, F.lit(",")).otherwise(F.lit("")), record).alias("value"))
    edge(head).union(lines).union(edge(tail)).coalesce(1).write.mode("overwrite").text(path)


def swap_in(df: DataFrame, path: str) -> None:
    """Write df beside path and move it there when all of it is written; until then the old table stays."""
    spark, new = df.sparkSession, f"{path}.new-{uuid.uuid4().hex}"
    df.write.parquet(new)
    _rename(spark, new, path)


def _rename(spark: SparkSession, new: str, path: str) -> None:
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    source, target, old = hadoop.Path(new), hadoop.Path(path), hadoop.Path(f"{path}.old-{uuid.uuid4().hex}")
    system = target.getFileSystem(conf)
    had = system.exists(target)
    if had:
        system.rename(target, old)
    if not system.rename(source, target):
        if had:
            system.rename(old, target)
        raise OSError(f"cannot move {new} to {path}")
    if had:
        system.delete(old, True)


def key_values(values: dict[str, str]) -> str:
    """Lines key=value, as build systems read them."""
    return "".join(f"{k}={v}\n" for k, v in values.items())
