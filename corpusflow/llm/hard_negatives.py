"""Hard negatives by product quantisation with stored residual norms (after Jegou, Douze, Schmid 2011).

Vectors are integers, floor(256 x). Their components are cut into parts; a part has a codebook of whole-number centroids, fitted on a
bounded sample. The index holds, in blocks, of every vector its codes, the norm of each part's residual and the vector itself.

The score of an anchor a and a vector v = c + e (centroids and residual) is a.c + a.e. The first term is a sum of entries of a lookup table, one for
each part, and the second lies within the sum of |a_part| |e_part|. So a score has a proven least and largest value, and a vector is a
candidate only if it can be among the first. Candidates are scored exactly, in whole numbers. That is done twice over the index:

1. The first positives of every anchor, vectors of its label. A block's bar is the highest value that enough least scores reach.
2. For every positive's window of scores, the first vectors of other labels in it. The bar is that of vectors that surely lie below the window's end.

A task holds one group of anchors and streams a slice of the blocks past them; slices and groups of every pair meet once. It returns a few
rows for each anchor, and windows merge them.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import materialize, release, release_at_exit, ship

STEP = 256
#: Components of a part: few, so that residuals are small also where vectors have no structure.
WIDTH = 2
CODES = 256
SAMPLE = 4096
ROUNDS = 8
ROWS = 4096
#: Anchors of a blob, and blobs of anchors and blocks that a task gets at most. Anchors that are scored together.
ASKED = 1024
GROUP = 16
SLICE = 64
TOGETHER = 128
#: Components of candidates that are scored at a time; all pairs are multiplied if one in DENSE is a candidate.
EXACT = 1 << 22
DENSE = 32
#: Scores are held within these ends.
END = 2**63 - 1
MOST = 1e100


def usable(vector: Column) -> Column:
    """Not null, all components finite, none so large that its scores would leave double's range."""
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= MOST)), F.lit(False))


def whole(raw: np.ndarray) -> np.ndarray:
    return np.floor(STEP * raw.astype(np.float64))


def _cuts(dim: int) -> list[int]:
    """Where parts begin and the last one ends."""
    return [*range(0, dim, WIDTH), dim] if dim else [0]


def _pack(*arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    for a in arrays:
        np.save(out, a)
    return out.getvalue()


def _unpack(raw: bytes) -> list[np.ndarray]:
    source, out = io.BytesIO(raw), []
    while source.tell() < len(raw):
        out.append(np.load(source))
    return out


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * (x @ centres.T)).argmin(axis=1)


def codebooks(x: np.ndarray) -> list[np.ndarray]:
    """For each part at most CODES centroids of whole numbers, by k-means from evenly spread distinct rows."""
    out, cuts = [], _cuts(x.shape[1])
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        own = np.unique(x[:, lo:hi], axis=0)
        centres = own[np.linspace(0, len(own) - 1, min(CODES, len(own))).astype(int)]
        for _ in range(ROUNDS):
            near = _nearest(own, centres)
            n = np.bincount(near, minlength=len(centres))
            sums = np.stack([np.bincount(near, own[:, d], len(centres)) for d in range(hi - lo)], axis=1)
            centres = np.where(n[:, None] > 0, np.rint(sums / np.maximum(n, 1)[:, None]), centres)
        out.append(centres)
    return out


def exact(a: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Row by row inner products of whole numbers, held within END."""
    if not a.size:
        return np.zeros(len(a), np.int64)
    if np.abs(a).max() * np.abs(v).max() * a.shape[1] < 2**53:
        return np.einsum("ij,ij->i", a, v).astype(np.int64)
    found = [sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for p, q in zip(a.tolist(), v.tolist(), strict=True)]
    return np.array([max(-END, min(END, s)) for s in found], np.int64)


class Block:
    """A block of the index: ids, labels, vectors, codes and upper bounds of the residuals' norms, the last column being for rounding."""

    def __init__(self, ids, labels, v, codes, norms):
        self.ids, self.labels, self.v, self.codes, self.norms = ids, labels, v.astype(np.float64), codes, norms.astype(np.float64)

    @staticmethod
    def build(ids: np.ndarray, labels: np.ndarray, v: np.ndarray, books: list[np.ndarray]) -> bytes:
        cuts = _cuts(v.shape[1])
        codes, norms = np.zeros((len(books), len(v)), np.uint8), np.zeros((len(books) + 1, len(v)))
        for j, book in enumerate(books):
            own = v[:, cuts[j] : cuts[j + 1]]
            codes[j] = _nearest(own, book)
            norms[j] = np.sqrt(((own - book[codes[j]]) ** 2).sum(axis=1))
        norms[-1] = 1e-9 * (np.sqrt((v * v).sum(axis=1)) + norms[:-1].sum(axis=0))
        norms *= 1 + 1e-6
        small = v.astype(np.int16) if not v.size or np.abs(v).max() < 2**15 else v
        # In half the bytes, rounded up, where they have room.
        half = np.nextafter(norms.astype(np.float32), np.float32(np.inf)) if not norms.size or norms.max() < 1e30 else norms
        return _pack(ids, labels, small, codes, half)

    def bounds(self, own: list[np.ndarray], spread: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The least and the largest score of each anchor and vector, from the anchors' parts and their norms."""
        score = np.zeros((len(self.ids), len(spread)))
        for x, book, codes in zip(own, books, self.codes, strict=True):
            score += (book @ x.T)[codes]  # a row of the lookup table for each vector
        score, room = np.ascontiguousarray(score.T), spread @ self.norms
        return np.clip(score - room, -END, END), np.clip(score + room, -END, END)

    def scores(self, a: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of a, vector, exact score) of the wanted pairs: as a product of matrices where they are many and doubles are exact, else pair by pair."""
        i, j = np.nonzero(wanted)
        own = np.flatnonzero(wanted.any(axis=0))
        if DENSE * len(i) > len(a) * len(own) and a.size and len(own) and np.abs(a).max() * np.abs(self.v).max() * a.shape[1] < 2**53:
            place = np.zeros(len(self.ids), np.int64)
            place[own] = np.arange(len(own))
            return i, j, (a @ self.v[own].T)[i, place[j]].astype(np.int64)
        step = max(1, EXACT // max(1, a.shape[1]))
        found = [exact(a[i[k : k + step]], self.v[j[k : k + step]]) for k in range(0, len(i), step)]
        return i, j, np.concatenate([np.zeros(0, np.int64), *found])


class Asked:
    """Anchors of a task: ids, labels, vectors, lookup tables and windows (anchor, from, to) with what was found for each.

    With `same`, vectors of the anchor's label are looked for, and it has one window without ends; else vectors of others."""

    def __init__(self, blobs: list[bytes], books: list[np.ndarray], top: int, same: bool):
        parts = [_unpack(b) for b in blobs]
        self.ids, self.labels, self.v = (np.concatenate([p[k] for p in parts]) for k in range(3))
        self.v, self.books, self.top, self.same = self.v.astype(np.float64), books, top, same
        if same:
            self.owner, self.key = np.arange(len(self.ids)), self.ids
            self.lo, self.hi = np.full(len(self.ids), -END), np.full(len(self.ids), END)
        else:
            starts = np.cumsum([0, *(len(p[0]) for p in parts)])
            self.owner = np.concatenate([p[3] + s for p, s in zip(parts, starts, strict=False)])
            self.key, self.lo, self.hi = (np.concatenate([p[k] for p in parts]) for k in (4, 5, 6))
        cuts = _cuts(self.v.shape[1])
        own = [self.v[:, lo:hi] for lo, hi in zip(cuts, cuts[1:], strict=False)]
        norms = [np.sqrt((x * x).sum(axis=1)) for x in own]
        self.own, self.spread = own, np.stack([*norms, np.sqrt((self.v * self.v).sum(axis=1))], axis=1)
        # What was found: window, id, score; and each window's last score once it has `top`.
        self.found = np.zeros((3, 0), np.int64)
        self.bar = np.full(len(self.owner), -np.inf)

    def scan(self, block: Block) -> None:
        kept = [self.found]
        for lo in range(0, len(self.ids), TOGETHER):
            some = slice(lo, min(lo + TOGETHER, len(self.ids)))
            least, most = block.bounds([x[some] for x in self.own], self.spread[some], self.books)
            fits = (self.labels[some, None] == block.labels[None, :]) == self.same
            fits &= self.ids[some, None] != block.ids[None, :]
            windows = np.nonzero((self.owner >= some.start) & (self.owner < some.stop))[0]
            # A round has one window of each anchor, so its rows are those of `least`.
            place = np.zeros(len(windows), np.int64)
            if len(windows):
                by = np.argsort(self.owner[windows], kind="stable")
                windows = windows[by]
                first = np.searchsorted(self.owner[windows], self.owner[windows])
                place = np.arange(len(windows)) - first
            wanted = np.zeros(fits.shape, bool)
            for r in range(int(place.max(initial=-1)) + 1):
                w = windows[place == r]
                rows = self.owner[w] - some.start
                wanted[rows] |= self._candidates(least[rows], most[rows], fits[rows], w)
            i, j, score = block.scores(self.v[some], wanted)
            for r in range(int(place.max(initial=-1)) + 1):
                w = windows[place == r]
                at = np.full(some.stop - some.start, -1)
                at[self.owner[w] - some.start] = w
                of = at[i]
                ok = (of >= 0) & (score >= self.lo[of]) & (score <= self.hi[of]) & (score >= self.bar[of])
                kept.append(np.stack([of[ok], block.ids[j[ok]], score[ok]]))
        self._merge(np.concatenate(kept, axis=1))

    def _candidates(self, least: np.ndarray, most: np.ndarray, fits: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Which vectors can be among the first of windows w, a row each."""
        lo, hi = self.lo[w].astype(np.float64)[:, None], self.hi[w].astype(np.float64)[:, None]
        bar = self.bar[w]
        sure = fits & (most <= hi) & (least > bar[:, None])
        for k in np.flatnonzero(sure.sum(axis=1) >= self.top):  # these raise it
            bar[k] = np.partition(least[k, sure[k]], -self.top)[-self.top]
        return fits & (least <= hi) & (most >= np.maximum(lo, bar[:, None]))

    def _merge(self, rows: np.ndarray) -> None:
        """Keep the first `top` of each window, and its last score as the bar."""
        rows = rows[:, np.lexsort((rows[1], -rows[2], rows[0]))]
        place = np.arange(rows.shape[1]) - np.searchsorted(rows[0], rows[0])
        self.found = rows[:, place < self.top]
        last = rows[:, place == self.top - 1]
        self.bar[last[0]] = last[2]

    def rows(self) -> pa.RecordBatch | None:
        w, ids, score = self.found
        columns = [pa.array(x, pa.int64()) for x in (self.ids[self.owner[w]], self.key[w], ids, score)]
        return pa.RecordBatch.from_arrays(columns, ["anchor_id", "key", "id", "score"]) if len(w) else None


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return whole(column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim))


def _index(rows: DataFrame, dim: int, books: list[np.ndarray], blocks: int) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(books)

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        blob = Block.build(table["vec_id"].to_numpy(), table["label"].to_numpy(), _matrix(table["v"], dim), held.value)
        return pa.table({"block": table["block"].slice(0, 1), "blob": pa.array([blob], pa.binary())})

    dealt = rows.select("vec_id", "label", "v", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("long").alias("block"))
    return materialize(dealt.groupBy("block").applyInArrow(build, "block long, blob binary"), "pq-index")


def _asked(rows: DataFrame, dim: int, blobs: int) -> DataFrame:
    """(blob_id, blob) of anchors; with a column windows (key, lo, hi) these go along, `top` of an anchor at most."""
    windows = F.col("windows") if "windows" in rows.columns else F.lit(None).cast("array<struct<key:bigint,lo:bigint,hi:bigint>>")

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        own = [(k, w["key"], w["lo"], w["hi"]) for k, ws in enumerate(table["windows"].to_pylist()) for w in ws or ()]
        arrays = np.array(own, np.int64).reshape(-1, 4).T
        blob = _pack(table["vec_id"].to_numpy(), table["label"].to_numpy(), _matrix(table["v"], dim), *arrays)
        return pa.table({"blob_id": table["blob_id"].slice(0, 1), "blob": pa.array([blob], pa.binary())})

    dealt = rows.select("vec_id", "label", "v", windows.alias("windows"), F.pmod(F.xxhash64("vec_id"), F.lit(blobs)).cast("long").alias("blob_id"))
    return materialize(dealt.groupBy("blob_id").applyInArrow(build, "blob_id long, blob binary"), "pq-asked")


def _scanned(index: DataFrame, asked: DataFrame, books: list[np.ndarray], blocks: int, blobs: int, top: int, same: bool) -> DataFrame:
    """(anchor_id, key, id, score): the first `top` of each window, by score and then id; a written table."""
    spark = index.sparkSession
    held = spark.sparkContext.broadcast(books)
    groups = -(-blobs // GROUP)
    slices = max(-(-blocks // SLICE), min(blocks, -(-4 * spark.sparkContext.defaultParallelism // groups)))
    cell = lambda s, g: (s * groups + g).alias("cell")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.withColumn("g", every(groups)).select(cell(F.col("block") % slices, F.col("g")), F.lit(1).alias("kind"), "blob")
    right = asked.withColumn("s", every(slices)).select(cell(F.col("s"), F.col("blob_id") % groups), F.lit(0).alias("kind"), "blob")
    rows = left.union(right).repartition(slices * groups, "cell").sortWithinPartitions("cell", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A cell's anchors come before its blocks.
        cell, waiting, now = None, [], None
        for batch in batches:
            for c, kind, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if c != cell:
                    if now is not None and (found := now.rows()) is not None:
                        yield found
                    cell, waiting, now = c, [], None
                if kind == 0:
                    waiting.append(blob.as_py())
                elif waiting or now is not None:
                    if now is None:
                        now, waiting = Asked(waiting, held.value, top, same), []
                    now.scan(Block(*_unpack(blob.as_py())))
        if now is not None and (found := now.rows()) is not None:
            yield found

    some = materialize(rows.mapInArrow(run, "anchor_id long, key long, id long, score long"), "pq-some")
    by = Window.partitionBy("anchor_id", "key").orderBy(F.desc("score"), "id")
    out = materialize(some.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top), "pq-first")
    release(some)
    return out


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, rows: int = ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of vectors (vec_id, embedding, label, ...).

    A component x counts as floor(256 x); a score is the inner product of two vectors. A row that `anchors` selects has as positives
    the first `positives` other rows of its label, and for each the first `negatives` rows of other labels with low * positive_score <= 100 *
    negative_score <= high * positive_score. Higher scores come first, ties by smaller vec_id; rank counts from 1. Results are
    exact: the codebooks, fitted on SAMPLE rows at most, only decide how many candidates are scored.

    Rows with a null vec_id, label or vector, or a null or non-finite component take no part, nor do components beyond 1e100. Of rows that
    repeat a vec_id the one with the smallest label, then vector, counts. Rows meet rows of the same length only; each length costs a
    few jobs. Scores beyond a long are held at its ends. Anchors without positives, and positives whose window is
    empty (as those of negative score), give no rows. Empty tables give none. Other columns are not read."""
    spark = ship(vectors.sparkSession)
    held = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast(held).alias("v"), anchors.alias("__asks"))
    own = own.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    one = own.groupBy("vec_id").agg(F.min(F.struct("label", "v", "__asks")).alias("r")).select("vec_id", "r.*")
    good = materialize(one, "pq-rows")
    lengths = good.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.count_if("__asks").alias("asks")).where("asks > 0").orderBy("dim").collect()
    out = None
    for dim, n, asks in lengths:
        same = good.where(F.size("v") == dim)
        sample = same.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
        books = codebooks(whole(np.array([r[0] for r in sample], np.float64).reshape(len(sample), dim)))
        blocks, blobs = -(-n // rows), -(-asks // ASKED)
        index, asking = _index(same, dim, books, blocks), same.where("__asks")
        first = _asked(asking, dim, blobs)
        near = _scanned(index, first, books, blocks, blobs, positives, True)
        # The window's ends in whole numbers, by exact decimals.
        ends = [F.expr(f"CAST(greatest(least({f}(CAST(score AS DECIMAL(20)) * {x} / 100), {END}BD), -{END}BD) AS LONG)") for f, x in (("ceil", low), ("floor", high))]
        windows = near.select("anchor_id", F.struct(F.col("id").alias("key"), ends[0].alias("lo"), ends[1].alias("hi")).alias("w")).where("w.lo <= w.hi")
        windows = windows.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list("w").alias("windows"))  # `positives` each
        second = _asked(asking.join(windows, "vec_id"), dim, blobs)
        found = _scanned(index, second, books, blocks, blobs, negatives, False)
        part = found.withColumnsRenamed({"id": "negative_id", "score": "negative_score", "key": "positive_id"})
        part = part.join(near.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), ["anchor_id", "positive_id"])
        part = part.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
        out = part if out is None else out.union(part)
        release(index, first, second)
        release_at_exit(near, found)
    release_at_exit(good)
    return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long") if out is None else out


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, s.id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS k
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, k::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 5
"""
