"""Helpers shared by the training-data operators: tables in the shared folder,
Arrow plumbing, hashing and distributed connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.session import drop_at_exit, materialize, new_path, release, release_at_exit, ship  # noqa: F401

#: Edges that a task of components() holds, and the neighbours from which on a node is a hub.
EDGES = 1_000_000
HUB = 100_000


def bounded(ids: DataFrame, most: int = 1_000_000) -> DataFrame:
    """ids, a narrow written table, marked for a broadcast if it has at most `most` rows (some
    20 MB), for a merge join beyond that."""
    return F.broadcast(ids) if ids.limit(most + 1).count() <= most else ids.hint("shuffle_merge")


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """df without columns that the operator is about to add (case-insensitive)."""
    lower = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in lower])


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: T.StructType | str) -> DataFrame:
    """mapInArrow with a function of one batch; batches it answers None for vanish."""

    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def splitmix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64 on an array of uint64 (a new array)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges (u, v) that aren't the smallest of their component, and that smallest node."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, top = at[: len(u)], at[len(u) :], np.arange(len(ids))
    while True:
        x, y = top[a], top[b]
        open_ = x != y
        if not open_.any():
            break
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(top, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(top, up := top[top]):
            top = up
    moved = top != np.arange(len(ids))
    return ids[moved], ids[top[moved]]


def _contract(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with u > v that connect what edges connects: each task holds EDGES of
    them at a time and gives one edge for each node that isn't the smallest of its part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def give() -> pa.RecordBatch:
            u, v = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in contracted(u, v)], ["u", "v"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= EDGES:
                yield give()
        if held:
            yield give()

    return edges.mapInArrow(run, "u long, v long")


def stars(edges: DataFrame) -> DataFrame:
    """Connected components of edges (u long, v long) as a written table (node, component): the smallest node of
    its component for every node that isn't that node itself. Nulls link nothing.

    Each task first contracts up to EDGES edges by itself; a graph of fewer is done then. What is left
    goes through alternating large-star and small-star rounds (Kiveris et al., 2014), whose number
    grows with the logarithm of the longest path. A round is a map-side combined minimum and
    an equi-join. Nodes of more than HUB neighbours meet them by a broadcast of these few nodes
    (at most edges / HUB), so that no task gets a hub's neighbours together. Each round is written to the
    shared folder, which cuts the lineage."""
    ship(edges.sparkSession)
    raw = materialize(edges.where("u <> v").select("u", "v"), "cc")
    count = raw.count()
    # As many tasks as EDGES asks for; files are read together until then.
    now = materialize(_contract(raw.coalesce(max(1, -(-count // EDGES)))), "cc")
    release(raw)

    def met(rows: DataFrame, low: DataFrame) -> DataFrame:
        """rows (u, v) with m of low (u, m, n)."""
        hubs = F.broadcast(low.where(F.col("n") > HUB).select("u", F.col("m").alias("__m")))
        both = rows.join(hubs, "u", "left")
        return both.where("__m IS NOT NULL").select("u", "v", F.col("__m").alias("m")).union(both.where("__m IS NULL").select("u", "v").join(low.select("u", "m"), "u"))

    while count > EDGES and _is_open(now):
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = met(both, low).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = met(large, low).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = materialize(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        release(now)
        now = nxt
    out = now.withColumnsRenamed({"u": "node", "v": "component"})
    out.written_to = now.written_to
    return out


def _is_open(edges: DataFrame) -> bool:
    """Whether edges (u, v) are not yet stars: a node has two edges up, or an edge up and one down."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): stars() with a row for every node that has an edge to another."""
    out = stars(edges)
    return out.union(out.select("component", "component").distinct())


def joined(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """stars() of all links so far, from those before links (u, v) came, which are released.
    Links are contracted to components first, so the work is that of what is new."""
    if comp is None:
        return stars(links)
    x, y = (bounded(comp.select(F.col("node").alias(e), F.col("component").alias(f"c{e}"))) for e in ("u", "v"))
    ends = links.join(x, "u", "left").join(y, "v", "left").select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
    now = stars(ends)
    parts = bounded(now.select(F.col("node").alias("component"), F.col("component").alias("to")))
    old = comp.join(parts, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    out = materialize(old.union(now.select("node", "component")), "cc")
    release(comp, now)
    return out
