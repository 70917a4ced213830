"""Samples that are the same on every engine: rows are ordered by a hash of seed and key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def place(seed: int, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def per_stratum(rows: DataFrame, stratum: str, key: str, n: int, seed: int) -> DataFrame:
    """n rows of each stratum (all, if it has fewer)."""
    w = Window.partitionBy(stratum).orderBy(place(seed, F.col(key)), key)
    return rows.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def stratified(rows: DataFrame, key: str, strata: list[tuple[str, Column, int]], total: int, seed: int, first: Column | None = None) -> DataFrame:
    """rows with stratum: those of `first` ('risk'), then up to n of each stratum in turn, without what earlier
    ones took, then 'fill' up to total. Strata may overlap: a row belongs to the first that takes it."""
    pool = rows.withColumn("__p", place(seed, F.col(key)))
    taken = pool.where(F.coalesce(first, F.lit(False))).withColumn("stratum", F.lit("risk")) if first is not None else None
    for name, condition, n in [*strata, ("fill", F.lit(True), None)]:
        rest = pool if taken is None else pool.join(taken.select(key), key, "left_anti")
        if n is None:
            n = max(0, total - (taken.count() if taken is not None else 0))
        part = rest.where(F.coalesce(condition, F.lit(False))).orderBy("__p", key).limit(n).withColumn("stratum", F.lit(name))
        taken = part if taken is None else taken.unionByName(part)
    return taken.drop("__p")
