"""Benchmark decontamination by winnowing (Schleimer, Wilkerson, Aiken 2003), in DataFrame functions only.

An item's windows are its runs of SPAN consecutive words; an item of fewer words is one window. A window's
fingerprint is the smallest hash of its GRAM-word grams. A document's fingerprints are those of all its runs of the same length:
neighbouring runs mostly share their smallest hash, so they are about 2 / (SPAN - GRAM + 2) of its words. Equal windows have equal
fingerprints, whatever stands around them, so no shared span of SPAN words is missed.

1. Documents' distinct fingerprints meet those of the items in a semi-join; only documents that share one go on.
2. Their hits are extended: runs whose fingerprint is shared are compared as a whole, by SHA-256 of their words.
3. Windows found in the same items have one class. A document has a set of classes, and the items of
   each distinct set are listed once, however many documents have it.

The items' side is broadcast only where its rows, of fixed size, are counted and few; beyond that both sides are dealt by fingerprint or window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import bounded, materialize, release, release_at_exit, ship

SPAN = 10
GRAM = 5
#: Windows, of some 150 bytes each, up to which they are broadcast.
WINDOWS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def lowered(text: Column) -> Column:
    """text (null: empty) with A-Z lower-cased, and no other letter."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The runs of 0-9, a-z and whatever isn't ASCII."""
    return F.array_remove(F.split(lowered(text), BETWEEN), "")


def _windows(values: Column, length: int, of) -> Column:
    """of(each run of `length` values), a list of columns; none if there are fewer."""
    starts = F.when(F.size(values) >= length, F.sequence(F.lit(0), F.size(values) - length)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: of([F.get(values, i + j) for j in range(length)]))


def fingerprints(own: Column, length: int, gram: int = GRAM) -> Column:
    """The fingerprint of each run of `length` words of an array of words, in order."""
    grams = _windows(own, min(gram, length), lambda ws: F.xxhash64(*ws))
    return grams if length <= gram else let(grams, lambda g: _windows(g, length - gram + 1, lambda hs: F.least(*hs)))


def _window(own: Column, start: Column, length: Column | int) -> Column:
    return F.sha2(F.array_join(F.slice(own, start, length), " "), 256)


def _runs(own: Column, lengths: list[int], gram: int) -> Column:
    """(n, at, mark, window) of every run of every length."""

    def of(length: int) -> Column:
        marks = fingerprints(own, length, gram)
        return F.transform(marks, lambda m, i: F.struct(F.lit(length).alias("n"), (i + 1).alias("at"), m.alias("mark")))

    return F.concat(*[of(n) for n in lengths])


def item_windows(items: DataFrame, span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, list[int]]:
    """(item, n, mark, window): the distinct windows of items (item_id, text) as a written table, and the lengths n, `span` at most, that they have."""
    own = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
    own = own.withColumn("n", F.least(F.size("ws"), F.lit(span)))
    lengths = sorted(r[0] for r in own.select("n").distinct().collect())  # span at most
    runs = F.coalesce(*[F.when(F.col("n") == n, _runs(F.col("ws"), [n], gram)) for n in lengths or [span]])
    rows = own.select("item", "ws", F.explode(runs).alias("r")).select("item", "r.n", "r.mark", _window(F.col("ws"), F.col("r.at"), F.col("r.n")).alias("window"))
    return materialize(rows.distinct(), "winnow-windows"), lengths


def fingerprinted(docs: DataFrame, lengths: list[int], gram: int = GRAM) -> DataFrame:
    """(doc_id, text_key, n_words, marks): the distinct fingerprints of every text, runs of all `lengths` together; a written table."""

    def both(ws: Column) -> Column:
        marks = F.array_distinct(F.concat(*[fingerprints(ws, n, gram) for n in lengths])) if lengths else F.array().cast("array<bigint>")
        return F.struct(F.size(ws).cast("long").alias("n_words"), marks.alias("marks"))

    rows = docs.select("doc_id", "text_key", let(words(F.col("text")), both).alias("x"))
    return materialize(rows.select("doc_id", "text_key", "x.n_words", "x.marks"), "winnow-docs")


def hits(docs: DataFrame, marked: DataFrame, windows: DataFrame, classed: DataFrame, lengths: list[int], gram: int = GRAM) -> DataFrame:
    """(doc_id, text_key, n, at, class): runs of docs (doc_id, text_key, text) that are windows of items, with their classes; a written table.

    marked: fingerprinted(docs)."""
    known = materialize(windows.select("mark").distinct(), "winnow-marks")
    near = marked.select("doc_id", "text_key", F.explode("marks").alias("mark")).join(bounded(known), "mark", "left_semi")
    near = materialize(near.groupBy("doc_id", "text_key").agg(F.collect_set("mark").alias("marks")), "winnow-near")
    # Whole texts again, but of documents that share a fingerprint only.
    some = near.withColumnsRenamed({"doc_id": "__id", "text_key": "__key"})
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key"))
    texts = docs.join(bounded(some.select("__id", "__key")), same, "left_semi").join(some, same)
    texts = texts.select("doc_id", "text_key", "marks", words(F.col("text")).alias("ws"))
    if not lengths:
        lengths = [SPAN]

    def extended(ws: Column) -> Column:
        shared = F.filter(_runs(ws, lengths, gram), lambda r: F.array_contains(F.col("marks"), r["mark"]))
        return F.transform(shared, lambda r: F.struct(r["n"].alias("n"), r["at"].alias("at"), _window(ws, r["at"], r["n"]).alias("window")))

    rows = texts.select("doc_id", "text_key", F.explode(let(F.col("ws"), extended)).alias("r")).select("doc_id", "text_key", "r.*")
    found = materialize(rows.join(bounded(classed, WINDOWS), ["n", "window"]).select("doc_id", "text_key", "n", "at", "class").distinct(), "winnow-hits")
    release(known, near)
    return found


def _classes(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(n, window, class), windows of the same items having the same class, and (class, item); written tables.

    A class is the number of its items and two sums over their hashes, so no list of items is gathered."""
    each = windows.select("n", "window", "item").distinct()
    two = [F.bit_xor(F.xxhash64(F.lit(k), F.col("item"))) for k in (1, 2)]
    classed = materialize(each.groupBy("n", "window").agg(F.struct(F.count("*").alias("items"), two[0].alias("x"), two[1].alias("y")).alias("class")), "winnow-classes")
    one = classed.groupBy("class").agg(F.min(F.struct("n", "window")).alias("w")).select("class", "w.n", "w.window")
    members = materialize(each.join(one, ["n", "window"]).select("class", "item"), "winnow-members")
    return classed, members


def judged(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated), a row for each row of docs (doc_id, text, ...).

    A document word is hit if it lies in an occurrence of a window of an item (item_id, text): `span` consecutive words of it, or all of them if
    it has fewer but not none. n_items counts the items with an occurring window; items_sha256 is of their ids, sorted as
    strings, joined by commas. Words are runs of digits, ASCII letters (A-Z lower-cased) and other characters that aren't ASCII. text_key is a hash of the text.

    A null text has no words, nor has an empty one: as a document it is clean, as an item it is nowhere. Items that repeat an item_id are one
    item with the windows of all; a null item_id is one with the id ''. Rows that repeat a doc_id, or have none, are judged each by its own
    text. Texts of any length are read as a whole, other columns aren't. No documents in, no rows out; no items, all clean."""
    ship(docs.sparkSession)
    # The rows of one doc_id are told apart by their texts, a null one being empty.
    texts = docs.select("doc_id", _text_key().alias("text_key"), "text")
    windows, lengths = item_windows(items, span, gram)
    classed, members = _classes(windows)
    marked = fingerprinted(texts, lengths, gram)
    found = hits(texts, marked, windows, classed, lengths, gram)

    # Places of a document as one pass over its sorted runs; their number is bounded by its words.
    ends = F.aggregate(
        F.array_sort("runs"),
        F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("end")),
        lambda a, r: F.struct((a["hit"] + F.greatest(r["at"] + r["n"] - F.greatest(a["end"], r["at"]), F.lit(0))).cast("long").alias("hit"), F.greatest(a["end"], r["at"] + r["n"]).alias("end")),
        lambda a: a["hit"],
    )
    own = found.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("at", "n")).alias("runs"), F.array_sort(F.collect_set("class")).alias("classes"))
    own = materialize(own.select("doc_id", "text_key", ends.alias("n_hit"), "classes"), "winnow-own")
    # What a set of classes stands for is made once, however many documents have it.
    sets = own.select("classes").distinct()
    listed = sets.select("classes", F.explode("classes").alias("class")).join(members, "class").select("classes", "item").distinct()
    listed = listed.groupBy("classes").agg(F.array_sort(F.collect_list("item")).alias("ids"))
    listed = listed.select("classes", F.size("ids").cast("long").alias("n_items"), F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"))
    verdict = own.join(listed, "classes").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "n_hit", "n_items", "items_sha256")
    verdict = materialize(verdict, "winnow-verdicts")
    release(windows, found, classed, members, own)

    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key"))
    out = marked.select("doc_id", "text_key", "n_words").join(bounded(verdict), same, "left")
    release_at_exit(marked, verdict)
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_hit", "n_items")]
    none = F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256")
    return out.select("doc_id", "text_key", "n_words", *zero, none, F.col("__key").isNotNull().alias("contaminated"))


def _text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def decontaminate(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """The rows of docs (doc_id, text, ...) that judged() doesn't find contaminated, all their columns as they are."""
    found = judged(docs, items, span, gram).where("contaminated").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    found = materialize(found, "winnow-contaminated")
    release_at_exit(found)
    return docs.join(bounded(found), F.col("doc_id").eqNullSafe(F.col("__id")) & (_text_key() == F.col("__key")), "left_anti")


def op13_winnowing(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return judged(docs, items).drop("text_key")


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
k AS (SELECT DISTINCT item, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS key
      FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
h AS MATERIALIZED (
  SELECT r, g.i AS i, k.n, k.item
  FROM (SELECT r, n, unnest(list_transform(range(1, len(ws) - n + 2), lambda i: {'i': i, 'key': array_to_string(ws[i:i + n - 1], ' ')})) AS g
        FROM d, (SELECT DISTINCT n FROM k)) x
  JOIN k ON k.n = x.n AND k.key = g.key),
hit AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT r, i, n FROM h)) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, coalesce(len(ws), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""
