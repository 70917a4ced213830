"""Approximate nearest neighbours with a permutation index.

Pivots are a bounded sample of the vectors of a length. Every vector is represented by the order of
its nearest pivots. Vectors are dealt to blocks by the hash of their ids, so blocks and answers don't depend on how the table is
partitioned, and indexed once: a block is a row of a written table with its distinct vectors and a pivot inverted file, which posts under each pivot
the vectors that have it among their nearest, with its place in their order. A query reads the lists
of its own nearest pivots and adds up how much each vector's order agrees with its own;
this ranks the block by Spearman's footrule with a fixed place for absent pivots. The best
`share` of a block, and never fewer than LEAST over all blocks, is reranked by exact cosine.

Queries are a stated set, taken in groups of bounded size against all blocks, so a group is
one scan of the index whose tasks return a few rows per query. Nothing is searched besides the index: the
share is the recall's price at every size.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import materialize, release, release_at_exit, ship
from corpusflow.llm.cover_tree import unit, usable

PIVOTS = 256
ORDER = 96
SHARE = 0.1
LEAST = 24
SAMPLE = 4096
ROWS = 4096
QUERIES = 4096


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def choose_pivots(good: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Distinct unit vectors among at most `sample` rows, those whose ids hash lowest."""
    rows = good.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).collect()
    x = np.array([r["v"] for r in rows], np.float64)
    _, first = np.unique(x, axis=0, return_index=True)
    return unit(x[np.sort(first)[:pivots]])


def nearest_pivots(u: np.ndarray, pivots: np.ndarray, order: int) -> np.ndarray:
    """The places of the nearest pivots of unit vectors, nearest first."""
    return np.argsort(-(u @ pivots.T), axis=1, kind="stable")[:, :order]


class InvertedFile:
    """A block: its distinct vectors with the ids of each (ascending), and posting lists: pivot -> vectors and the
    pivot's place in their order."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, order: int):
        _, first, same = np.unique(x, axis=0, return_index=True, return_inverse=True)
        by = np.lexsort((ids, same.reshape(-1)))
        self.ids, self.begin = ids[by], np.searchsorted(same.reshape(-1)[by], np.arange(len(first) + 1))
        self.x = x[first]
        self.u = unit(self.x)
        near = nearest_pivots(self.u, pivots, order)
        flat = near.ravel()
        at = np.argsort(flat, kind="stable")
        self.order = np.array([near.shape[1]])
        self.vector, self.place = (at // near.shape[1]).astype(np.int32), (at % near.shape[1]).astype(np.int16)
        self.start = np.searchsorted(flat[at], np.arange(len(pivots) + 1))

    def to_bytes(self) -> bytes:
        out, half = io.BytesIO(), self.x.astype(np.float32)
        for a in (self.ids, self.begin, half if (half == self.x).all() else self.x, self.order, self.vector, self.place, self.start):
            np.save(out, a)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> InvertedFile:
        source, out = io.BytesIO(raw), cls.__new__(cls)
        out.ids, out.begin, out.x, out.order, out.vector, out.place, out.start = (np.load(source) for _ in range(7))
        out.x = out.x.astype(np.float64)
        out.u = unit(out.x)
        return out

    def agreement(self, query: np.ndarray) -> np.ndarray:
        """For each vector order(order + 1) minus its footrule to the query, halved."""
        order, total = int(self.order[0]), np.zeros(len(self.u), np.int32)
        for j, p in enumerate(query.tolist()):
            a, b = self.start[p], self.start[p + 1]
            total[self.vector[a:b]] += order - np.maximum(self.place[a:b], j)  # a vector is in a list once
        return total

    def search(self, q_ids: np.ndarray, raw: np.ndarray, q_near: np.ndarray, top: int, share: float, least: int) -> list[tuple[int, int, float]]:
        """(query row, vec_id, score) of the nearest found for each query vector."""
        wanted, out, q = min(len(self.u), max(least, int(np.ceil(share * len(self.u))))), [], unit(raw)
        for r in range(len(q_ids)):
            agrees = self.agreement(q_near[r])
            chosen = np.argpartition(-agrees, wanted - 1)[:wanted]
            if len(chosen) > 2 * top + 2:
                # Vectors whose scores tie with the last one kept stay, so ids decide between them.
                score = self.u[chosen] @ q[r]
                floor = np.partition(score, len(score) - top - 1)[len(score) - top - 1]
                chosen = chosen[score >= floor - 1e-12]
            for c, s in zip(chosen.tolist(), cosines(self.x[chosen], raw[r]).tolist(), strict=True):
                # Of equal vectors the smallest top + 1 ids can matter.
                out += [(r, int(i), s) for i in self.ids[self.begin[c] : self.begin[c + 1]][: top + 1] if i != q_ids[r]]
        return out


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The cosine of each row of x and q by its formula in doubles. Vectors are scaled by powers of two, which changes no digit and
    keeps their squares in range."""
    x, q = (np.ldexp(a, -np.frexp(np.abs(a).max(axis=-1, keepdims=True))[1]) for a in (x, q))
    return (x * q).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (q * q).sum())


def build_index(good: DataFrame, blocks: int, pivots: np.ndarray, order: int = ORDER) -> DataFrame:
    """(block, blob): the inverted files of all vectors (vec_id, v) in so many blocks."""
    held = good.sparkSession.sparkContext.broadcast(pivots)

    def build(table: pa.Table) -> pa.Table:
        own = table.sort_by("vec_id")
        x = _matrix(own["v"].combine_chunks()).astype(np.float64)
        blob = InvertedFile(own["vec_id"].to_numpy(), x, held.value, order).to_bytes()
        return pa.table({"block": own["block"].slice(0, 1), "blob": pa.array([blob], pa.binary())})

    dealt = good.select("vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("long").alias("block"))
    return materialize(dealt.groupBy("block").applyInArrow(build, "block long, blob binary"), "permutation-index")


def nearest(vectors: DataFrame, queries: F.Column, top: int = 5, pivots: int = PIVOTS, order: int = ORDER, share: float = SHARE, rows: int = ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of vectors (vec_id, embedding, ...) that
    `queries` selects, its `top` nearest other rows found, by cosine in double precision,
    nearest first, ties to the smaller vec_id.

    Vectors that are null, empty, zero or hold null or non-finite components and null vec_ids take no part. Vectors
    of each length are indexed and searched by themselves; lengths are few, each costs a few jobs. Of rows that repeat a vec_id the smallest
    vector of each length asks and the nearest answers. A row is not its own
    neighbour, nor is another row of the same vec_id. With fewer candidates all are returned; an empty
    table or query set gives no rows. Other columns are not read."""
    ship(vectors.sparkSession)
    spark = vectors.sparkSession
    picked = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), queries.alias("__q"))
    good = picked.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    lengths = good.groupBy(F.size("v").alias("n")).agg(F.count_if("__q").alias("q"), F.count("*").alias("all")).where("q > 0").orderBy("n").collect()
    out = None
    for n, _, number in lengths:
        same = good.where(F.size("v") == n)
        chosen = choose_pivots(same, pivots)
        near = min(order, len(chosen))
        blocks = -(-number // rows)
        index = build_index(same, blocks, chosen, near)
        asked = materialize(same.where("__q").groupBy("vec_id").agg(F.min("v").alias("v")), "permutation-queries")
        groups = -(-asked.count() // QUERIES)
        for k in range(groups):
            own = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == k).orderBy("vec_id").collect()  # about QUERIES rows
            if own:
                q = np.array([r["v"] for r in own], np.float64)
                held = spark.sparkContext.broadcast((np.array([r["vec_id"] for r in own]), q, nearest_pivots(unit(q), chosen, near)))
                part = index.select("blob").mapInArrow(_searcher(held, top, share, -(-LEAST // blocks)), "query_id long, vec_id long, score double")
                if groups > 1:
                    part = materialize(part, "permutation-found")
                    release_at_exit(part)
                out = part if out is None else out.union(part)
        release(asked)
        release_at_exit(index)
    if out is None:
        out = spark.createDataFrame([], "query_id long, vec_id long, score double")
    ranked = out.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return ranked.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def _searcher(held, top: int, share: float, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q, q_near = held.value
        best: list[list[tuple[float, int]]] = [[] for _ in q_ids]
        for batch in batches:
            for blob in batch.column(0):
                new: dict[int, list[tuple[float, int]]] = {}
                for r, i, s in InvertedFile.from_bytes(blob.as_py()).search(q_ids, q, q_near, top, share, least):
                    new.setdefault(r, []).append((-s, i))
                for r, found in new.items():
                    best[r] = _first(best[r] + found, top)
        rows = [(int(q_ids[r]), i, -s) for r, own in enumerate(best) for s, i in own]
        if rows:
            a, b, c = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())], ["query_id", "vec_id", "score"])

    return run


def _first(found: list[tuple[float, int]], top: int) -> list[tuple[float, int]]:
    """The first of (-score, id), each id once."""
    out: dict[int, float] = {}
    for s, i in sorted(found):
        if out.setdefault(i, s) == s and len(out) == top:
            break
    return [(s, i) for i, s in out.items()]


def op8_nearest(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
