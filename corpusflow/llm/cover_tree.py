"""Near-duplicate embeddings by dual traversal of cover trees.

Identical vectors of a label are one point with a count. The points of a
label are dealt to blocks of bounded size: to the nearest of a few centres, which
a bounded sample gives, and by hash within a centre whose points are too many. A cover tree is built
for each block, once (nested levels whose radii halve, every node knows how far its
farthest descendant lies). Each pair of blocks that the centres' covering radii do not rule out is
one task, which walks both trees together, level by level, dropping pairs of
nodes that lie farther apart than the threshold and both covering radii. What is left at
the leaves is compared exactly. A task returns link counts and a spanning forest, never all
its pairs.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import map_arrow, materialize, release, release_at_exit, ship, stars, without

BLOCK = 4096
MOST_CELLS = 64
#: Pairs of nodes that are expanded at a time.
FRONTIER = 1 << 16
SAMPLE = 8192
SLACK = 1e-6


def usable(vector: F.Column) -> F.Column:
    """Not null, not zero, no null, NaN or infinite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def chord(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


class CoverTree:
    """Nested levels over unit vectors: the points of a level lie more than its radius
    apart and cover all points within it; the next level has half the radius.

    A level has its points (places in x), the reach of each (its farthest descendant), and where
    its children lie in the next level; the children of the last level are points of x."""

    def __init__(self, x: np.ndarray):
        self.x = x
        n = len(x)
        owner, radius, far = np.zeros(n, np.int64), 2.0, chord(x, x[:1])[:, 0]
        centres = [0]
        points, parents, self.radii = [np.array(centres)], [], [radius]
        # Halve until every point that differs is a centre of its own.
        while far.max(initial=0) > SLACK and len(points) <= 40:
            radius /= 2
            old, owner, far = owner, owner.copy(), far.copy()
            for p in np.nonzero(far > radius)[0]:
                if far[p] > radius:
                    d = chord(x, x[p : p + 1])[:, 0]
                    near = d < far
                    owner[near], far[near] = len(centres), d[near]
                    centres.append(int(p))
            points.append(np.array(centres))
            parents.append(old[points[-1]])
            self.radii.append(radius)
        parents.append(owner)
        self.points = points
        self.children: list[np.ndarray] = []
        self.start: list[np.ndarray] = []
        for level, parent in zip(points, parents, strict=True):
            self.children.append(np.argsort(parent, kind="stable"))
            self.start.append(np.searchsorted(parent[self.children[-1]], np.arange(len(level) + 1)))
        self.reach, above = [np.zeros(0)] * len(points), np.arange(n)
        for k in range(len(points) - 1, -1, -1):
            above = parents[k][above]
            self.reach[k] = np.zeros(len(points[k]))
            np.maximum.at(self.reach[k], above, rows_apart(x, x[points[k][above]]))

    def to_bytes(self, raw: np.ndarray, *more: np.ndarray) -> bytes:
        """The tree of raw vectors, whose unit vectors are x, and arrays to go along. Numbers are written
        in half the bytes where that loses nothing."""
        out, half, n = io.BytesIO(), raw.astype(np.float32), len(self.points)
        np.save(out, np.array([n]))
        places = [a.astype(np.int32) for a in (*self.points, *self.children, *self.start)]
        for a in (half if (half == raw).all() else raw, np.array(self.radii), *places, *self.reach, *more):
            np.save(out, a)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> tuple[CoverTree, np.ndarray, list[np.ndarray]]:
        """The tree, its raw vectors and the arrays that went along."""
        source, arrays = io.BytesIO(raw), []
        while source.tell() < len(raw):
            arrays.append(np.load(source))
        n, out = int(arrays[0][0]), cls.__new__(cls)
        vectors = arrays[1].astype(np.float64)
        out.x, out.radii = unit(vectors), arrays[2].tolist()
        out.points, out.children, out.start, out.reach = (arrays[3 + k * n : 3 + (k + 1) * n] for k in range(4))
        return out, vectors, arrays[3 + 4 * n :]


def rows_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of unit vectors, row by row."""
    return np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", a, b), 0))


def _below(a: CoverTree, b: CoverTree, k: int, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a child of p[i] and a child of q[i]. A tree that has ended stays at its points."""

    def children(t: CoverTree, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if k >= len(t.points):
            return at, np.ones(len(at), np.int64), np.arange(len(t.x))
        return t.start[k][at], t.start[k][at + 1] - t.start[k][at], t.children[k]

    (sa, na, ca), (sb, nb, cb) = children(a, p), children(b, q)
    many = na * nb
    row = np.repeat(np.arange(len(p)), many)
    off = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    return ca[sa[row] + off // nb[row]], cb[sb[row] + off % nb[row]]


def _count(t: CoverTree, k: int, at: np.ndarray) -> np.ndarray:
    return t.start[k][at + 1] - t.start[k][at] if k < len(t.points) else np.ones(len(at), np.int64)


def dual_pairs(a: CoverTree, b: CoverTree, most: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i of a, j of b) that the trees cannot rule out; all at most
    `most` apart are among them. With same, a is b and each pair comes once, with i < j.

    Both trees go down a level at a time, pairs of nodes in arrays of bounded length."""
    out_i, out_j = [], []
    todo = [(0, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    depth = max(len(a.points), len(b.points))
    while todo:
        k, p, q = todo.pop()
        if len(p) > FRONTIER:
            todo += [(k, p[:FRONTIER], q[:FRONTIER]), (k, p[FRONTIER:], q[FRONTIER:])]
            continue
        i, j = _below(a, b, k, p, q)
        last = k + 1 >= depth
        if same:  # a pair of different nodes came one way round; children of one node come both ways
            own = np.repeat(p == q, _count(a, k, p) * _count(b, k, q))
            keep = ~own | (i < j if last else i <= j)
            i, j = i[keep], j[keep]
        if last:
            out_i.append(np.minimum(i, j) if same else i)
            out_j.append(np.maximum(i, j) if same else j)
            continue
        pa, ra = (a.points[k + 1], a.reach[k + 1]) if k + 1 < len(a.points) else (np.arange(len(a.x)), np.zeros(len(a.x)))
        pb, rb = (b.points[k + 1], b.reach[k + 1]) if k + 1 < len(b.points) else (np.arange(len(b.x)), np.zeros(len(b.x)))
        if 4 * len(i) > len(pa) * len(pb):
            far = chord(a.x[pa], b.x[pb])[i, j]
        else:
            far = np.concatenate([rows_apart(a.x[pa[i[lo : lo + FRONTIER]]], b.x[pb[j[lo : lo + FRONTIER]]]) for lo in range(0, len(i), FRONTIER)] or [np.zeros(0)])
        near = far <= most + SLACK + ra[i] + rb[j]
        if near.any():
            todo.append((k + 1, i[near], j[near]))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_i, out_j))


def _forest(u: np.ndarray, v: np.ndarray) -> list[tuple[int, int]]:
    """Edges of (u, v) that join what was apart."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(u.tolist(), v.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(whole), -1)


def _centres(sample: list, cells: dict) -> dict:
    """(label, dimension) -> centres: points of the sample, each the farthest from those before."""
    out = {}
    for key, k in cells.items():
        x = [r["v"] for r in sample if (r["label"], len(r["v"])) == key]
        if k > 1 and len(x) > 1:
            x = unit(np.array(x, np.float64))
            chosen, far = [0], chord(x, x[:1])[:, 0]
            while len(chosen) < k and far.max() > SLACK:
                chosen.append(int(far.argmax()))
                far = np.minimum(far, chord(x, x[chosen[-1:]])[:, 0])
            out[key] = x[chosen]
    return out


def near_embeddings(vectors: DataFrame, least: float = 0.93, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of vectors (vec_id,
    embedding, label, ...).

    Rows link when their labels are equal and not null, their vectors have the same
    length and their cosine, in double precision, is at least `least`. n_links counts the other
    rows linked directly, component_id is the smallest vec_id reachable, kept is
    vec_id = component_id. Vectors that are null, empty, zero or hold null or non-finite
    components, null labels and null vec_ids link with nothing. Rows that repeat a vec_id
    count each and are one node. Other columns are not read."""
    ship(vectors.sparkSession)
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), F.col("label").cast("string").alias("label"))
    good = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    points = materialize(good.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "cover-points")

    # A label gets cells in proportion to its points. Only labels of more than a block are listed,
    # the largest SAMPLE / 2 of them; any other has one cell.
    sizes = points.groupBy("label", F.size("v").alias("dim")).agg(F.count("*").alias("n")).where(F.col("n") > block)
    cells = {(r["label"], r["dim"]): min(MOST_CELLS, -(-r["n"] // block)) for r in sizes.orderBy(F.desc("n"), "label", "dim").limit(SAMPLE // 2).collect()}
    sample = points.orderBy(F.xxhash64("rep")).limit(SAMPLE).select("label", "v").collect() if cells else []
    centres = _centres(sample, cells)
    held = spark.sparkContext.broadcast(centres)

    def assign(batch: pa.RecordBatch) -> pa.RecordBatch:
        labels, vs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        cell, far = np.zeros(len(vs), np.int32), np.full(len(vs), 2.0)
        groups: dict[tuple, list[int]] = {}
        for i, (lab, v) in enumerate(zip(labels, vs, strict=True)):
            groups.setdefault((lab, len(v)), []).append(i)
        for key, at in groups.items():
            if key in held.value:
                d = chord(unit(np.array([vs[i] for i in at], np.float64)), held.value[key])
                cell[at], far[at] = d.argmin(1), d.min(1)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], [*batch.schema.names, "cell", "far"])

    placed_ = materialize(map_arrow(points, assign, points.withColumn("cell", F.lit(0)).withColumn("far", F.lit(0.0)).schema), "cover-placed")
    placed = placed_.withColumn("dim", F.size("v"))
    stats = placed.groupBy("label", "dim", "cell").agg(F.count("*").alias("n"), F.max("far").alias("reach"))
    stats = stats.withColumn("parts", F.ceil(F.col("n") / block).cast("int"))
    gaps = [(lab, dim, i, j, float(d)) for (lab, dim), c in centres.items() for i, row in enumerate(chord(c, c)) for j, d in enumerate(row)]
    gaps = spark.createDataFrame(gaps, "label string, dim int, a int, b int, gap double")  # at most SAMPLE * MOST_CELLS rows
    blocks = stats.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    most = math.sqrt(2 - 2 * least)
    one = blocks.select("label", "dim", F.col("cell").alias("a"), F.col("part").alias("pa"), F.col("reach").alias("ra"))
    two = blocks.select("label", "dim", F.col("cell").alias("b"), F.col("part").alias("pb"), F.col("reach").alias("rb"))
    pairs = one.join(two, ["label", "dim"]).where("a < b OR (a = b AND pa <= pb)").join(gaps, ["label", "dim", "a", "b"], "left")
    pairs = pairs.where((F.col("a") == F.col("b")) | F.col("gap").isNull() | (F.col("gap") <= most + SLACK + F.col("ra") + F.col("rb")))
    same = (F.col("a") == F.col("b")) & (F.col("pa") == F.col("pb"))
    sides = pairs.select("label", "dim", F.concat_ws(":", "label", "dim", "a", "pa", "b", "pb").alias("pair"), F.explode(F.when(same, F.array(F.struct(F.col("a").alias("cell"), F.col("pa").alias("part"), F.lit(2).alias("side")))).otherwise(F.array(F.struct(F.col("a").alias("cell"), F.col("pa").alias("part"), F.lit(0).alias("side")), F.struct(F.col("b").alias("cell"), F.col("pb").alias("part"), F.lit(1).alias("side"))))).alias("s"))
    sides = sides.select("label", "dim", "pair", "s.cell", "s.part", "s.side")
    parts = placed.join(stats.select("label", "dim", "cell", "parts").where("parts > 1"), ["label", "dim", "cell"], "left")
    parts = parts.withColumn("part", F.pmod(F.xxhash64("rep"), F.coalesce("parts", F.lit(1))).cast("int"))
    # A block's tree is built once and goes, with its points, to the pairs it has part in.
    where = ["label", "dim", "cell", "part"]

    def build(table: pa.Table) -> pa.Table:
        rep, copies = table["rep"].to_numpy(), table["copies"].to_numpy()
        order = np.argsort(rep, kind="stable")
        x = _matrix(table["v"])[order]
        blob = CoverTree(unit(x)).to_bytes(x, rep[order], copies[order])
        return pa.table({**{c: table[c].slice(0, 1) for c in where}, "tree": pa.array([blob], pa.binary())})

    kinds = ", ".join(f"{c} {parts.schema[c].dataType.simpleString()}" for c in where)
    trees = materialize(parts.groupBy(*where).applyInArrow(build, f"{kinds}, tree binary"), "cover-trees")
    rows = trees.join(sides, where).select("pair", "side", "tree")

    def compare(table: pa.Table) -> pa.Table:
        order = np.argsort(table["side"].to_numpy(), kind="stable").tolist()
        (ta, xa, (rep_a, copies_a)), (tb, xb, (rep_b, copies_b)) = (CoverTree.from_bytes(table["tree"][i].as_py()) for i in (order[0], order[-1]))
        whole = len(order) == 1
        i, j = dual_pairs(ta, ta if whole else tb, most, whole)
        scaled = [x / np.abs(x).max(axis=1, keepdims=True) for x in (xa, xb)]
        norm = [np.sqrt((x * x).sum(axis=1)) for x in scaled]
        # The exact measure, in slices.
        linked = [(scaled[0][i[lo : lo + FRONTIER]] * scaled[1][j[lo : lo + FRONTIER]]).sum(axis=1) / (norm[0][i[lo : lo + FRONTIER]] * norm[1][j[lo : lo + FRONTIER]]) >= least for lo in range(0, len(i), FRONTIER)]
        linked = np.concatenate(linked) if linked else np.zeros(0, bool)
        i, j = i[linked], j[linked]
        nodes, links = [], []
        for rep, n in ((rep_a, np.bincount(i, weights=copies_b[j], minlength=len(rep_a))), (rep_b, np.bincount(j, weights=copies_a[i], minlength=len(rep_b)))):
            some = np.nonzero(n)[0]
            nodes += rep[some].tolist()
            links += n[some].astype(np.int64).tolist()
        edges = _forest(rep_a[i], rep_b[j])
        kind = [0] * len(nodes) + [1] * len(edges)
        return pa.table({"kind": pa.array(kind, pa.int32()), "a": pa.array(nodes + [e[0] for e in edges], pa.int64()), "b": pa.array(links + [e[1] for e in edges], pa.int64())})

    found = materialize(rows.groupBy("pair").applyInArrow(compare, "kind int, a long, b long"), "cover-links")
    release(placed_, trees)
    others = found.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("others"))
    members = good.join(points.select("label", "v", "rep", "copies"), ["label", "v"]).select("vec_id", "rep", "copies")
    members = materialize(members, "cover-members")
    edges = found.where("kind = 1").select(F.col("a").alias("u"), F.col("b").alias("v")).union(members.select("vec_id", "rep"))
    comp = stars(edges)
    release_at_exit(members, found, comp)
    release(points)
    links = members.groupBy("vec_id", "rep").agg(F.first("copies").alias("copies"), F.count("*").alias("rows")).join(others, "rep", "left")
    # A row's links: its vector's other copies and what they link with. Rows that repeat a vec_id with another vector have theirs added.
    links = links.groupBy("vec_id").agg(F.sum(F.col("copies") - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links"))
    out = vectors.select("vec_id").join(links, "vec_id", "left").join(comp.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def unique_embeddings(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """vectors without the rows that are near duplicates of a smaller vec_id's component."""
    gone = near_embeddings(vectors, least).where("NOT kept").select(F.col("vec_id").alias("__gone")).distinct()
    vectors = without(vectors, ["__gone"])
    return vectors.join(gone, vectors.vec_id == gone["__gone"], "left_anti")


def op2_near_embeddings(spark, sf_dir: str) -> DataFrame:
    return near_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS u, vec_id AS w FROM embeddings UNION SELECT r.u, p.w FROM r JOIN p ON r.w = p.u),
c AS (SELECT u AS vec_id, min(w) AS component_id FROM r GROUP BY u),
n AS (SELECT u AS vec_id, count(*) AS n FROM p GROUP BY u)
SELECT c.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""
