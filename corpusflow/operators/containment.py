"""Texts that lie within other texts, found by their rarest gram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.session import materialize, release, release_at_exit

#: Words in a gram, grams in a window, characters in a gram of a text of one or two words.
WORDS, WINDOW, CHARS = 3, 16, 5
#: The level of a text that is long enough for windows; other levels are the words in a gram, or below 0 its characters.
LONG = WORDS + 1


def contained_titles(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs whose lowered texts are equal or one contains the other, each pair of rows once; null and empty texts match nothing.

    A text that lies in another has its inner words, all but the first and the last, whole in it, so each gram of inner
    words is a gram of the other. Texts are looked up by that of their grams which the fewest others have, and one with a gram that
    no other has is not looked up at all. Of long texts only the least hash of every window of grams counts, on both
    sides; texts of one or two words have grams of characters. Hashes meet in joins, texts only those of pairs whose
    hashes met; nothing is broadcast but what Spark finds small. Equal texts are compared once and expanded at the end."""
    x = left.withColumn("__t", F.lower(X.squash(a))).where("__t <> ''").withColumn("__x", _identity("__t"))
    y = right.withColumn("__t", F.lower(X.squash(b))).where("__t <> ''").withColumn("__y", _identity("__t"))
    mine, theirs = x.select(F.col("__x").alias("h"), F.col("__t").alias("t")), y.select(F.col("__y").alias("h"), F.col("__t").alias("t"))
    y_in_x = _within(mine, theirs).select(F.col("around").alias("__x"), F.col("inside").alias("__y"))
    x_in_y = _within(theirs, mine).where("around <> inside").select(F.col("inside").alias("__x"), F.col("around").alias("__y"))
    return x.drop("__t").join(y_in_x.unionByName(x_in_y), "__x").join(y.drop("__t"), "__y").drop("__x", "__y")


def _identity(c: str) -> Column:
    """128 bits of a text's SHA-256."""
    return F.substring(F.unhex(F.sha2(c, 256)), 1, 16)


def _runs(tokens: Column, k: int, kind: int) -> Column:
    """Hashes of every run of k tokens."""
    hashed = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(F.lit(kind), *[F.get(w, i + j) for j in range(k)]))
    return X.let(tokens, lambda w: F.when(F.size(w) >= k, hashed(w)).otherwise(F.array().cast("array<bigint>")))


def _grams(words: Column, t: str, level: int) -> Column:
    """The hashes of a level: of words, or of the characters of t."""
    if level < 0:
        return _runs(F.split(F.col(t), ""), -level, level)
    if level < LONG:
        return _runs(words, level, level)
    return X.let(_runs(words, WORDS, LONG), lambda g: F.when(F.size(g) >= WINDOW, F.slice(_least(g, 1), F.lit(1), F.size(g) - WINDOW + 1)).otherwise(F.array().cast("array<bigint>")))


def _least(values: Column, width: int) -> Column:
    """The least of WINDOW values from each place on, of fewer at the end; each step takes four widths together."""
    if width == WINDOW:
        return values
    least = F.transform(values, lambda v, i: F.least(v, *[F.get(values, i + k * width) for k in (1, 2, 3)]))
    return X.let(least, lambda w: _least(w, 4 * width))


def _asked(texts: DataFrame) -> DataFrame:
    """(inside, n, level, g) of texts (h, t): the grams of which all must be in a text around; n is the length."""
    words = F.split("t", " ")
    inner = F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0)))
    count = F.size(words) - 2
    level = F.when(count >= WINDOW + WORDS - 1, LONG).when(count >= 1, F.least(count, F.lit(WORDS))).otherwise(-F.least(F.length("t"), F.lit(CHARS)))
    leveled = texts.select("h", "t", F.length("t").alias("n"), level.alias("level"))
    grams = F.coalesce(*[F.when(F.col("level") == k, _grams(inner, "t", k)) for k in (*range(1, LONG + 1), *range(-CHARS, 0))])
    return leveled.select(F.col("h").alias("inside"), "n", "level", F.array_distinct(grams).alias("gs")).select("inside", "n", "level", F.explode_outer("gs").alias("g"))


def _within(around: DataFrame, inside: DataFrame) -> DataFrame:
    """(around, inside): identities of texts (h, t) of which the one contains the other."""
    asked = materialize(_asked(inside), "contained-asked")
    levels = sorted(r.level for r in asked.select("level").distinct().collect())  # at most nine
    lists = [_grams(F.split("t", " "), "t", k) for k in levels] or [F.array().cast("array<bigint>")]
    listed = around.select(F.col("h").alias("around"), F.length("t").alias("m"), F.array_distinct(F.flatten(F.array(*lists))).alias("gs"))
    every = listed.select("around", "m", F.explode_outer("gs").alias("g"))  # outer: else Spark tests the list for being empty and makes it twice
    known = materialize(every.join(asked.select("g").distinct(), "g", "left_semi"), "contained-known")
    rarity = known.groupBy("g").agg(F.count("*").alias("df"))
    rated = asked.join(rarity, "g", "left").groupBy("inside", "n").agg(F.min_by("g", F.struct("df", "g")).alias("g"), F.count_if(F.col("df").isNull()).alias("lacking"))
    picks = rated.where("lacking = 0").select("inside", "n", "g")
    met = materialize(known.join(picks, "g").where("m >= n").select("around", "inside").distinct(), "contained-met")

    def texts(side: DataFrame, name: str) -> DataFrame:
        """(name, its text) of the texts that met, each once."""
        wanted = side.withColumnRenamed("h", name).join(met.select(name).distinct(), name, "left_semi")
        return wanted.groupBy(name).agg(F.first("t").alias(f"{name}_t"))

    both = met.join(texts(inside, "inside"), "inside").join(texts(around, "around"), "around")
    out = materialize(both.where(F.contains("around_t", F.col("inside_t"))).select("around", "inside"), "contained")
    release(asked, known, met)
    release_at_exit(out)
    return out
