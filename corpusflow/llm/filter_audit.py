"""Audit of how filters interact, by the multilinear extension of removal (Owen 1972).

Every document has a mask, the set of filters that it fails. For a part of the corpus with n(m) documents of each mask, the
removal polynomial

    f(x) = sum over m of n(m) * (1 - product over i in m of (1 - x_i))

has at the corner 1_S the number of documents that the filters S remove together. So what any order of
filters keeps, removes and finds removed already are differences of f at corners. The Shapley value of filter i is the
integral of its partial derivative along the diagonal, x = (t, ..., t), for t from 0 to 1; it is taken with
exact fractions, and the sum over all orders is their number times that.

Texts are tested in Arrow batches (a fifth of the time that splitting them in column expressions takes); masks are counted by part with map-side
combined aggregates, so a part is 2 ** filters counts at most, whatever its documents are. A polynomial is made of these counts alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction
from hashlib import sha256
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import bounded, map_arrow, materialize, release_at_exit, ship, text_bytes

CAPITALS = bytes(range(0x41, 0x5B))
SIGNS = b"#$%&*|"
CONTINUED = bytes(range(0x80, 0xC0))
COUNTS = ("n", "good", "toxic")
RESULT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def text_failures(text: bytes) -> int:
    """The filters A to D that a text in UTF-8 fails, as bits."""
    words = text.split()  # at runs of ASCII white space
    tails, capitals = (len(text) - len(text.translate(None, x)) for x in (CONTINUED, CAPITALS))
    fails = len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * capitals > 2 * (len(text) - tails), len(text.translate(None, SIGNS)) < len(text)
    return sum(1 << k for k, x in enumerate(fails) if x)


class Removal:
    """The polynomial f of mask counts: coefficients of products of variables, by bit sets of these."""

    def __init__(self, counts: Sequence[int]):
        # 1 - prod (1 - x_i) is minus the sum over non-empty subsets of (-1) ** size times their product.
        total = list(counts)
        for bit in _bits(len(total)):
            for m in range(len(total)):
                if not m & bit:
                    total[m] += total[m | bit]
        self.terms = [0 if not s else total[s] * (-1) ** (s.bit_count() + 1) for s in range(len(total))]

    def corner(self, chosen: int) -> int:
        """f where the variables `chosen` are 1 and the others 0."""
        return sum(c for s, c in enumerate(self.terms) if s & ~chosen == 0)

    def shapley(self, bit: int) -> Fraction:
        """The integral from 0 to 1 of the derivative by a variable where all variables are t."""
        by_degree = [0] * len(self.terms).bit_length()
        for s, c in enumerate(self.terms):
            if s & bit:
                by_degree[s.bit_count() - 1] += c
        return sum((Fraction(c, k + 1) for k, c in enumerate(by_degree)), Fraction(0))


def _bits(masks: int) -> list[int]:
    return [1 << k for k in range(masks.bit_length() - 1)]


def audit(n: Sequence[int], good: Sequence[int], toxic: Sequence[int], letters: str) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for all orders of the
    filters and all steps, from the counts of each mask."""
    every, total = len(n) - 1, sum(n)
    polynomials = [Removal(x) for x in (n, good, toxic)]
    corners = [[p.corner(s) for s in range(len(n))] for p in polynomials]
    gone = corners[0]
    shapley = [p * factorial(len(letters)) for p in (polynomials[0].shapley(b) for b in _bits(len(n)))]
    assert all(x.denominator == 1 for x in shapley)
    out = []
    for order in permutations(range(len(letters))):
        before, name = 0, "".join(letters[i] for i in order)
        for step, i in enumerate(order, 1):
            after, alone = before | 1 << i, gone[1 << i]
            lost = [c[after] - c[before] for c in corners]
            out.append((name, step, total - gone[after], lost[0], alone - lost[0], gone[every] - gone[every & ~(1 << i)], lost[1], lost[2], int(shapley[i])))
            before = after
    return out


def masked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic), a row for each row of docs (doc_id, text, source), bits of the mask being the filters A to E.

    See filter_audit() for odd rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "text")

    def test(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = text_bytes(batch.column(2))
        found = pa.array([text_failures(t) for t in texts], pa.int32()), pa.array([sha256(t).digest() for t in texts], pa.binary())
        return pa.RecordBatch.from_arrays([*batch.columns[:2], *found], ["doc_id", "part", "mask", "text_key"])

    rows = materialize(map_arrow(rows, test, "doc_id long, part string, mask int, text_key binary"), "audit-masks")
    release_at_exit(rows)
    # E: whoever isn't the smallest id of its text. The rows meet that id by text and id, so copies of one text are no hot key.
    first = rows.groupBy("text_key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    rows = rows.join(first, ["text_key", "doc_id"], "left")
    mask = F.col("mask") + F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), F.lit(1 << 4)).otherwise(F.lit(0))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    marks = materialize(marks.where("doc_id IS NOT NULL AND (good OR toxic)"), "audit-labels")
    release_at_exit(marks)
    rows = rows.select("doc_id", "part", mask.alias("mask")).join(bounded(marks), "doc_id", "left")
    return rows.select("part", "mask", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """How the filters A to E act on docs (doc_id, text, source) in every order, part by part: RESULT.

    A document fails A with under 200 words, B if less than half of its words are distinct, C if over 2 % of its code points are A-Z, D if it
    holds any of #$%&*|, E if its text is that of a smaller doc_id. Words are runs of what isn't ASCII white space, case-sensitive.

    A null text is an empty one and a null source the part ''. Rows that repeat a doc_id are documents each; copies under the same
    doc_id aren't copies of a smaller one. A null doc_id is neither smaller nor larger than another, and has no label. A document is good or
    toxic if any row of labels (doc_id, quality, toxic) says so. Every part has all orders and steps, zeros included. Other columns are not
    read. No documents in, no rows out."""
    ship(docs.sparkSession)
    letters, size = "ABCDE", 1 << 5
    count = {"n": F.count("*"), "good": F.count_if("good"), "toxic": F.count_if("toxic")}
    by_mask = masked(docs, labels).groupBy("part", "mask").agg(*[c.alias(k) for k, c in count.items()])
    parts = by_mask.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("masks"))  # at most 32 each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, masks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = {k: [0] * size for k in COUNTS}
                for m in masks:
                    for k in COUNTS:
                        counts[k][m["mask"]] = m[k]
                rows = audit(*(counts[k] for k in COUNTS), letters)
                kinds = [pa.string(), pa.int32(), *[pa.int64()] * 7]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(rows), pa.string()), *columns], [x.split()[0] for x in RESULT.split(", ")])

    return parts.mapInArrow(run, RESULT)


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    return filter_audit(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels")))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
g AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (len(ws) < 200)::INT + 2 * (100 * list_unique(ws) < 50 * len(ws))::INT
         + 4 * (100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(w.doc_id > first_id, false)::INT AS mask
  FROM w LEFT JOIN g USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) f(letter, bit)),
o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
      FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step, f.bit, coalesce((SELECT sum(g.bit) FROM f g WHERE contains(left(filter_order, step - 1), g.letter)), 0)::INT AS before
      FROM o, range(1, 6) r(step) JOIN f ON f.letter = substr(filter_order, step, 1)),
x AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (WHERE mask & (before | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE mask & bit > 0 AND mask & before > 0), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM x
"""
