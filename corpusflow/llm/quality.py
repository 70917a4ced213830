"""Quality classifier: a sparse rule ensemble (Friedman and Popescu's RuleFit).

1. Statistics of a text are Spark columns (STATISTICS).
2. Small trees are grown on a bounded sample of labelled rows, each on a
   random half of the rows and a random part of the statistics.
3. Every path from a root to a node is a conjunctive rule over statistics. A
   logistic regression with an L1 penalty (FISTA) gives most rules weight zero.
4. The rules left are compiled into one Spark column, so scoring is a scan.

Labels, language, source and doc_id are never inputs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import without

TRAIN_ROWS = 20_000
TREES, DEPTH, MIN_LEAF, BINS = 60, 3, 10, 48
PENALTY = 2e-4
SEED = 7


def statistics(text: Column) -> dict[str, Column]:
    """Whole-text statistics as columns; every one is defined for an empty text."""
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    words = F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")
    lines = F.split(text, "\n")
    return {
        "chars": F.length(text).cast("double"),
        "words": F.size(words).cast("double"),
        "distinct_words": F.size(F.array_distinct(words)).cast("double"),
        "lines": F.size(lines).cast("double"),
        "distinct_lines": F.size(F.array_distinct(lines)).cast("double"),
        "upper": count(r"\p{Lu}"),
        "digits": count(r"[0-9]"),
        "symbols": count(r"[*%#&$|<>{}=~^_\\@+/]"),
        "shouts": count(r"!"),
        "stops": count(r"[.?!]"),
        "commas": count(r"[,;:]"),
    }


def features(s: dict[str, Column]) -> dict[str, Column]:
    """What rules test, made of the statistics."""
    per = lambda a, b: s[a] / F.greatest(s[b], F.lit(1.0))
    return {
        "chars": s["chars"],
        "words": s["words"],
        "word_length": per("chars", "words"),
        "distinct_words": per("distinct_words", "words"),
        # Distinct words over the square root of words: long texts repeat words by nature.
        "richness": s["distinct_words"] / F.sqrt(F.greatest(s["words"], F.lit(1.0))),
        "distinct_lines": per("distinct_lines", "lines"),
        "line_words": per("words", "lines"),
        "upper": per("upper", "chars"),
        "digits": per("digits", "chars"),
        "symbols": per("symbols", "words"),
        "shouts": per("shouts", "words"),
        "stops": per("stops", "words"),
        "commas": per("commas", "words"),
    }


def with_features(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs plus one struct column __f of the features of text (null: empty)."""
    stats = docs.withColumn("__s", F.struct(*[c.alias(n) for n, c in statistics(F.coalesce("text", F.lit(""))).items()]))
    found = features({n: F.col("__s")[n] for n in statistics(F.lit(""))})
    return stats.withColumn("__f", F.struct(*[c.alias(n) for n, c in found.items()])).drop("__s"), list(found)


@dataclass
class Rules:
    """Conjunctions of (feature, above, threshold) with weights."""

    features: list[str]
    intercept: float
    rules: list[tuple[tuple[int, bool, float], ...]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def column(self, at: Column) -> Column:
        """The score, 0 to 1, as a column over a struct of the features."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for f, above, threshold in rule:
                x = at[self.features[f]]
                holds = holds & ((x > threshold) if above else (x <= threshold))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))

    def describe(self) -> list[str]:
        text = lambda r: " and ".join(f"{self.features[f]} {'>' if up else '<='} {t:.6g}" for f, up, t in r)
        return [f"{w:+.3f} if {text(r)}" for r, w in sorted(zip(self.rules, self.weights, strict=True), key=lambda x: -abs(x[1]))]


def _tree(x: np.ndarray, cuts: list[np.ndarray], y: np.ndarray, rows: np.ndarray, allowed: np.ndarray) -> list[tuple]:
    """The paths of one tree; x holds bin numbers, cuts the value under each bin's edge."""
    paths: list[tuple] = []

    def grow(rows: np.ndarray, path: tuple, depth: int) -> None:
        if path:
            paths.append(path)
        n, ones = len(rows), y[rows].sum()
        if depth == DEPTH or n < 2 * MIN_LEAF or ones in (0, n):
            return
        best, whole = (1e-9, None, None), ones * ones / n + (n - ones) ** 2 / n
        for f in allowed:
            k = len(cuts[f])
            if not k:
                continue
            all_ = np.bincount(x[rows, f], minlength=k + 1).cumsum()[:k].astype(float)
            pos = np.bincount(x[rows, f], weights=y[rows], minlength=k + 1).cumsum()[:k]
            right = n - all_
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = (pos**2 + (all_ - pos) ** 2) / all_ + ((ones - pos) ** 2 + (right - ones + pos) ** 2) / right - whole
            gain[(all_ < MIN_LEAF) | (right < MIN_LEAF)] = -1
            j = int(gain.argmax())
            if gain[j] > best[0]:
                best = (float(gain[j]), f, j)
        if best[1] is None:
            return
        _, f, j = best
        left = x[rows, f] <= j
        grow(rows[left], (*path, (int(f), False, float(cuts[f][j]))), depth + 1)
        grow(rows[~left], (*path, (int(f), True, float(cuts[f][j]))), depth + 1)

    grow(rows, (), 0)
    return paths


def _holds(x: np.ndarray, rule: tuple) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, t in rule:
        out &= (x[:, f] > t) if above else (x[:, f] <= t)
    return out


def _lasso(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on standardised rules, by FISTA."""
    mean, sd = r.mean(0), np.maximum(r.std(0), 1e-6)
    z = (r - mean) / sd
    n, m = z.shape
    v = np.ones(m) / np.sqrt(max(m, 1))
    for _ in range(20):
        v = z.T @ (z @ v)
        v /= max(np.linalg.norm(v), 1e-12)
    step = 1 / (0.25 * (np.linalg.norm(z @ v) ** 2 / n + 1) + 1e-9)
    w = old = np.zeros(m)
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    b = b_old = float(np.log(rate / (1 - rate)))
    for k in range(steps):
        u, c = w + (k / (k + 3)) * (w - old), b + (k / (k + 3)) * (b - b_old)
        g = 1 / (1 + np.exp(-(z @ u + c))) - y
        old, b_old = w, b
        w = u - step * (z.T @ g) / n
        w = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
        b = float(c - step * g.mean())
    w = w / sd
    return float(b - mean @ w), w


def fit(x: np.ndarray, y: np.ndarray, names: list[str]) -> Rules:
    """Rules from a matrix of features and labels 0/1. With no rows the score is
    0.5; with one label only it is that label's smoothed share."""
    n, ones = len(y), float(y.sum())
    if ones in (0.0, float(n)):
        p = (ones + 1) / (n + 2)
        return Rules(names, float(np.log(p / (1 - p))))
    rng = np.random.default_rng(SEED)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    found: dict[tuple, None] = {}
    for _ in range(TREES):
        rows = rng.permutation(n)[: max(2 * MIN_LEAF, n // 2)]
        allowed = rng.permutation(len(names))[: max(2, 2 * len(names) // 3)]
        found.update(dict.fromkeys(tuple(sorted(p)) for p in _tree(binned, cuts, y, rows, allowed)))
    rules = list(found)
    columns, seen, kept = [], set(), []
    for rule in rules:
        holds = _holds(x, rule)
        if 0 < holds.sum() < n and (k := holds.tobytes()) not in seen:
            seen.add(k)
            columns.append(holds)
            kept.append(rule)
    if not kept:
        p = (ones + 1) / (n + 2)
        return Rules(names, float(np.log(p / (1 - p))))
    b, w = _lasso(np.stack(columns, axis=1).astype(np.float64), y.astype(np.float64), PENALTY)
    used = np.nonzero(np.abs(w) > 1e-4)[0]
    return Rules(names, b, [kept[i] for i in used], [float(w[i]) for i in used])


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learnt: crc32 of doc_id as text, mod 5, is 0 (null: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS) -> Rules:
    """Rules learnt from labels (doc_id, quality 0/1; null: no label) outside the
    held-out fold. At most max_rows labels are used, those with the smallest
    hash of doc_id, so the sample that reaches the driver is bounded."""
    chosen = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = chosen.groupBy("doc_id").agg(F.max("quality").alias("__y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).withColumnRenamed("doc_id", "__id")
    rows, names = with_features(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")))
    table = rows.select("__y", *[F.col("__f")[n].alias(n) for n in names], "__id").orderBy(F.xxhash64("__id"), *names).limit(max_rows).toPandas()
    return fit(table[names].to_numpy(float), table["__y"].to_numpy(float), names)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = TRAIN_ROWS) -> DataFrame:
    """docs (doc_id, text, ...) plus held_out boolean, score double and predicted int.

    Null and empty texts are scored like any other, by statistics that are all 0. Repeated rows are
    scored alike. Without any label the score is 0.5. Columns that are already named held_out,
    score or predicted are replaced; all others pass through."""
    rules = train(docs, labels, max_rows)
    docs = without(docs, ["held_out", "score", "predicted"])
    keep = [F.col(f"`{c}`") for c in docs.columns]
    scored, _ = with_features(docs)
    scored = scored.withColumn("__score", rules.column(F.col("__f")))
    return scored.select(*keep, held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= threshold).cast("int").alias("predicted"))


def op4_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return score_quality(docs, labels).select("doc_id", "held_out", "score", "predicted")
