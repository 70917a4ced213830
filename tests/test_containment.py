"""Texts within texts against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from corpusflow.operators.joins import contained_titles

TABLES = "i long, a string", "j long, b string"


def brute(left, right):
    squash = lambda t: " ".join((t or "").split()).lower()
    pairs = [(i, j, squash(a), squash(b)) for i, a in left for j, b in right]
    return sorted((i, j) for i, j, a, b in pairs if a and b and (a in b or b in a))


def found(spark, left, right):
    x, y = spark.createDataFrame(left, TABLES[0]), spark.createDataFrame(right, TABLES[1])
    return sorted((r.i, r.j) for r in contained_titles(x.repartition(3), y, "a", "b").collect())


def texts(r, words, lengths, n):
    return [" ".join(r.choice(words) for _ in range(r.choice(lengths))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_pieces_of_any_length_are_found(spark, seed):
    """Pieces cut at any character, so that their first and last words are parts of words."""
    r = random.Random(seed)
    words = ["a", "ab", "bab", "Über", "𝒳y", "日本語", "title", "of", "the"]
    long = texts(r, words, (1, 2, 3, 5, 8, 18, 19, 20, 21, 40, 90), 25)
    cut = []
    for t in long:
        for _ in range(4):
            at = r.randrange(len(t))
            cut.append(t[at : at + r.choice((1, 2, 3, 5, 9, 20, 60, 100, 200))])
    left, right = list(enumerate(long + cut[:10])), list(enumerate(cut + long[:10]))
    assert found(spark, left, right) == brute(left, right)


def test_texts_that_match_nothing(spark):
    left = [(1, None), (2, ""), (3, " \n "), (4, "alone here"), (5, "x " * 300)]
    right = [(1, None), (2, ""), (3, "\t"), (4, "other words entirely in this one")]
    assert found(spark, left, right) == []
    assert found(spark, left, []) == [] and found(spark, [], right) == []


def test_repeated_rows_stay_and_columns_may_share_names(spark):
    left, right = [(1, "A b  c d"), (1, "A b  c d"), (2, "b c")], [(7, "a B c d"), (7, "a B c d"), (8, "zz")]
    assert found(spark, left, right) == [(1, 7)] * 4 + [(2, 7)] * 2


def test_very_long_texts_and_a_common_passage(spark):
    """A passage that all texts have picks no pairs: each is looked up by what is its own."""
    r = random.Random(5)
    passage = " ".join(f"shared{k}" for k in range(60))
    own = [" ".join(f"w{r.randrange(10**6)}" for _ in range(40)) for _ in range(60)]
    left = [(k, f"{passage} {t}") for k, t in enumerate(own)] + [(99, " ".join(own) + " end" * 30_000)]
    right = [(k, f"{passage} {t[:200]}") for k, t in enumerate(own)] + [(100, own[7])]
    assert found(spark, left, right) == sorted([(k, k) for k in range(60)] + [(7, 100), (99, 100)])


def test_order_and_partitions_do_not_matter(spark):
    rows = spark.range(500).select("id", F.concat_ws(" ", F.lit("On topic"), F.col("id") % 50, F.lit("and more of it"), F.col("id")).alias("t"))
    few = spark.range(50).select(F.col("id").alias("n"), F.concat_ws(" ", F.lit("topic"), "id", F.lit("and more")).alias("s"))
    got = {k: contained_titles(rows.repartition(k), few, "t", "s").groupBy("n").count().collect() for k in (1, 7)}
    assert all(sorted((r.n, r["count"]) for r in rows_) == [(n, 10) for n in range(50)] for rows_ in got.values())
