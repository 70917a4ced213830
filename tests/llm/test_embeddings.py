import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import cover_tree as C
from corpusflow.llm import permutation_index as P
from tests.llm.helpers import components

SCHEMA = "vec_id long, embedding array<float>, label int, cell string"


def rows(seed=1, n=160, dim=12):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, dim))
    out = []
    for i in range(n):
        v = base[i % len(base)] + rng.normal(size=dim) * rng.choice([0, 0.05, 0.2])
        out.append((i, [float(np.float32(x)) for x in v * rng.choice([0.01, 1, 100])], int(i % 3), "c"))
    nan = float("nan")
    out += [(1000, None, 1, "c"), (1001, [0.0] * dim, 1, "c"), (1002, [1.0] * (dim - 1) + [nan], 1, "c"), (1003, [1.0, None] + [0.5] * (dim - 2), 1, "c"), (1004, [math.inf] + [1.0] * (dim - 1), 1, "c"), (1005, [], 1, "c"), (1006, out[0][1], None, "c")]
    out += [(2000 + k, [1.0] * dim, 0, None) for k in range(30)] + [(3000, [1.0, 1.0], 0, "c"), (3001, [1.0, 1.0], 0, "c")]
    return out


def good(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    return float(a @ b / math.sqrt((a @ a) * (b @ b)))


@pytest.mark.parametrize("block", [2048, 16])
def test_links_same_as_plain(spark, block):
    data = rows()
    got = {r.vec_id: r for r in C.near_embeddings(spark.createDataFrame(data, SCHEMA), 0.93, block).collect()}
    usable = [r for r in data if good(r[1]) and r[2] is not None]
    edges = [(a[0], b[0]) for a, b in itertools.combinations(usable, 2) if a[2] == b[2] and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= 0.93]
    roots = components([r[0] for r in data], edges)
    links = {r[0]: 0 for r in data}
    for a, b in edges:
        links[a] += 1
        links[b] += 1
    assert {k: r.component_id for k, r in got.items()} == roots
    assert {k: r.n_links for k, r in got.items()} == links
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert len(edges) > 300


def test_dual_traversal_finds_all_pairs():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(9, 5))
    x = C.unit(centres[rng.integers(0, 9, 300)] + 0.1 * rng.normal(size=(300, 5)))
    y = C.unit(centres[rng.integers(0, 9, 200)] + 0.1 * rng.normal(size=(200, 5)))
    a, b = C.CoverTree(x), C.CoverTree(y)
    for most in (0.05, 0.2, 0.6):
        i, j = C.dual_pairs(a, b, most, False)
        expected = set(zip(*np.nonzero(C.chord(x, y) <= most), strict=True))
        assert expected <= set(zip(i.tolist(), j.tolist(), strict=True))
        i, j = C.dual_pairs(a, a, most, True)
        expected = {(p, q) for p, q in zip(*np.nonzero(C.chord(x, x) <= most), strict=True) if p < q}
        assert expected <= set(zip(i.tolist(), j.tolist(), strict=True))
    back, raw, _ = C.CoverTree.from_bytes(a.to_bytes(a.x))
    assert (raw == a.x).all()
    for k, ((points, radius), (more, half)) in enumerate(itertools.pairwise(zip(a.points, a.radii, strict=True))):
        assert set(points) <= set(more) and half == radius / 2
        assert (back.reach[k] == a.reach[k]).all() and sorted(a.children[k]) == list(range(len(more)))
        assert C.chord(a.x, a.x[more]).min(1).max() <= half + 1e-9


def test_empty_and_repeated(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.near_embeddings(empty).collect() == [] and P.nearest(empty, F.lit(True)).collect() == []
    twice = [(7, [1.0, 0.0], 1, "c"), (7, [1.0, 0.0], 1, "c"), (None, [1.0, 0.0], 1, "c")]
    got = sorted((str(r.vec_id), r.n_links) for r in C.near_embeddings(spark.createDataFrame(twice, SCHEMA)).collect())
    assert got == [("7", 1), ("7", 1), ("None", 0)]


@pytest.mark.parametrize("rows_", [4096, 32])
def test_search_of_every_length(spark, rows_):
    data = rows(3) + [(4000 + k, [1.0, float(k)], 0, "c") for k in range(8)] + [(50, [2.0, 1.0], 0, "c"), (5000, [7.0], 0, "c")]
    # The whole of each block is reranked, so what is found is exact.
    got = P.nearest(spark.createDataFrame(data, SCHEMA), F.col("vec_id") % 10 == 0, share=1.0, rows=rows_).collect()
    usable = [r for r in data if good(r[1])]
    for q in [r for r in usable if r[0] % 10 == 0 and r[0] != 50]:
        best = {}
        for r in usable:
            if r[0] != q[0] and len(r[1]) == len(q[1]):
                best[r[0]] = min(best.get(r[0], 9), -round(cosine(q[1], r[1]), 9))
        expected = sorted((s, i) for i, s in best.items())[:5]
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q[0])
        assert [r[0] for r in own] == list(range(1, len(expected) + 1))
        assert np.allclose([-s for s, _ in expected], [r[2] for r in own], atol=1e-9)
        if q[0] == 2000:
            assert [r[1] for r in own] == [2001, 2002, 2003, 2004, 2005]
    assert {r.query_id for r in got} >= {3000, 4000} and 5000 not in {r.query_id for r in got}
    assert len([r for r in got if r.query_id == 50]) in (5, 10)  # the repeated id asks in both lengths


def test_footrule_of_an_inverted_file():
    rng = np.random.default_rng(4)
    x, pivots = rng.normal(size=(200, 6)), C.unit(rng.normal(size=(20, 6)))
    order = 7
    file = P.InvertedFile.from_bytes(P.InvertedFile(np.arange(200), x, pivots, order).to_bytes())
    near, q = P.nearest_pivots(file.u, pivots, order), P.nearest_pivots(C.unit(rng.normal(size=(1, 6))), pivots, order)[0]
    place = lambda own: {p: j for j, p in enumerate(own.tolist())}
    for got, own in zip(file.agreement(q).tolist(), near, strict=True):
        a, b = place(own), place(q)
        footrule = sum(abs(a.get(p, order) - b.get(p, order)) for p in set(a) | set(b))
        assert 2 * got == order * (order + 1) - footrule


@pytest.mark.parametrize("source", ["noise", "check"])
def test_recall(spark, source):
    """At least 0.9 at 5 against brute force, without a block that is searched whole."""
    if source == "noise":
        x = np.random.default_rng(8).normal(size=(6000, 32))
        table = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>").coalesce(2)
    else:
        table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
        data = [r for r in table.select("vec_id", "embedding").collect() if good(r.embedding)]
        x, names = np.array([r.embedding for r in data], float), np.array([r.vec_id for r in data])
    got = {}
    for r in P.nearest(table, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    u = C.unit(x)
    names = np.arange(len(x)) if source == "noise" else names
    hits = total = 0
    for q in np.nonzero(names % 50 == 0)[0]:
        s = u @ u[q]
        s[names == names[q]] = -9
        best = np.sort(s)[::-1][:5]
        hits += sum(v >= best[-1] - 1e-12 for v in got[int(names[q])].values())
        total += 5
    assert total >= 100 and hits / total >= 0.9


def test_same_answer_for_any_partitioning(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    answers = [sorted(map(tuple, P.nearest(table.repartition(n), F.col("vec_id") % 50 == 0).collect())) for n in (1, 8, 64)]
    assert answers[0] == answers[1] == answers[2] and len(answers[0]) > 100
    data = {r.vec_id: r.embedding for r in table.collect()}
    assert all(s == float(P.cosines(np.array([data[v]], float), np.array(data[q], float))[0]) for q, _, v, s in answers[0])
    assert all(abs(s - cosine(data[q], data[v])) < 1e-15 for q, _, v, s in answers[0])


def test_cosines_of_huge_and_tiny_vectors():
    x = np.array([[1e200, 1e200], [1e-200, 0.0], [3.0, 4.0]])
    assert np.allclose(P.cosines(x, np.array([1e250, 0.0])), [math.sqrt(0.5), 1, 0.6], atol=1e-15)
