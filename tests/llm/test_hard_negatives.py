import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, rank string"


def rows(seed=1, n=400, dim=12):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 8, dim)) / math.sqrt(dim)
    out = []
    for i in range(n):
        v = base[i % len(base)] + rng.normal(size=dim) * rng.choice([0, 0.01, 0.1])
        out.append((i, [float(np.float32(x)) for x in v], int(i % 4), "c"))
    nan = float("nan")
    out += [(1000, None, 1, "c"), (1010, [0.0] * dim, 1, "c"), (1020, [1.0] * (dim - 1) + [nan], 1, "c"), (1030, [1.0, None] + [0.5] * (dim - 2), 1, "c"), (1040, [math.inf] + [1.0] * (dim - 1), 1, "c")]
    out += [(1050, out[0][1], None, "c"), (None, out[0][1], 1, "c"), (1060, [], 1, "c"), (1061, [], 1, "c"), (1062, [], 2, "c"), (1070, [0.5, 0.5], 1, "c"), (1071, [0.5, 0.25], 1, "c"), (1072, [0.5, 0.25], 2, "c")]
    out += [(2000 + k, [0.5] * dim, k % 2, None) for k in range(30)] + [(20, [9.0] * dim, 3, "c"), (20, out[20][1], 0, "c"), (3000, [-0.5] * dim, 7, "c"), (3001, [0.01] * dim, 7, "c")]
    return out


def plain(data, every=10, positives=5, negatives=5, low=80, high=100, least=-H.END, most=H.END):
    good = {}
    for vec_id, v, label, *_ in data:
        if None not in (vec_id, v, label) and all(x is not None and math.isfinite(x) for x in v):
            one = (label, v)
            good[vec_id] = min(good.get(vec_id, one), one)
    good = {k: (label, [math.floor(256 * x) for x in v]) for k, (label, v) in good.items()}
    out = []
    for a, (label, v) in good.items():
        if a % every:
            continue
        near = sorted((-max(least, min(most, sum(x * y for x, y in zip(v, w, strict=True)))), b, m == label) for b, (m, w) in good.items() if b != a and len(w) == len(v))
        for minus, p, _ in [x for x in near if x[2]][:positives]:
            fits = [(s, b) for s, b, own in near if not own and low * -minus <= 100 * -s <= high * -minus][:negatives]
            out += [(a, p, k, b, -minus, -s) for k, (s, b) in enumerate(fits, 1)]
    return sorted(out)


def check(spark, data, schema=SCHEMA, every=10, **how):
    got = H.hard_negatives(spark.createDataFrame(data, schema), F.col("vec_id") % every == 0, **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = plain(data, every, **{k: v for k, v in how.items() if k != "rows"})
    assert sorted(map(tuple, got.collect())) == expected
    return expected


@pytest.mark.parametrize("blocks", [4096, 37])
def test_same_as_plain(spark, blocks):
    assert len(check(spark, rows(), rows=blocks)) > 500


def test_other_limits_groups_and_slices(spark, monkeypatch):
    for name, value in (("ASKED", 3), ("GROUP", 2), ("SLICE", 2), ("TOGETHER", 5), ("EXACT", 64), ("DENSE", 0), ("CODES", 3), ("SAMPLE", 20)):
        monkeypatch.setattr(H, name, value)
    data = rows(2, 200)
    random.Random(1).shuffle(data)
    assert check(spark, data, rows=16, positives=3, negatives=7, low=50, high=120)


def test_large_numbers(spark):
    rng = np.random.default_rng(3)
    data = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * 10.0 ** rng.integers(0, 38)], i % 2, "c") for i in range(120)]
    check(spark, data, every=5)
    data = [(i, [float(x) for x in rng.integers(-(2**29), 2**29, 4) / 256], i % 2, "c") for i in range(150)]
    assert check(spark, data, "vec_id long, embedding array<double>, label int, rank string", 5)


def test_bounds_hold():
    rng = np.random.default_rng(4)
    x = H.whole(rng.normal(size=(500, 13)))
    books = H.codebooks(x[:100])
    block = H.Block(*H._unpack(H.Block.build(np.arange(500), np.zeros(500, int), x, books)))
    blob = H._pack(np.arange(50), np.zeros(50, int), x[:50], *np.zeros((4, 0), np.int64))
    asked = H.Asked([blob], books, 5, True)
    least, most = block.bounds(asked.own, asked.spread, books)
    true = x[:50] @ x.T
    assert (least <= true).all() and (true <= most).all()
    assert (most - least).mean() < 0.8 * np.abs(true).max()


def test_few_candidates_are_scored(monkeypatch):
    rng = np.random.default_rng(5)
    x = H.whole(rng.normal(size=(3000, 16)) + 4 * rng.normal(size=(40, 16))[rng.integers(0, 40, 3000)])
    books = H.codebooks(x[:1000])
    asked = H.Asked([H._pack(np.arange(100), np.zeros(100, int), x[:100], *np.zeros((4, 0), np.int64))], books, 5, True)
    scored, plain = [], H.Block.scores
    monkeypatch.setattr(H.Block, "scores", lambda self, a, wanted: scored.append(wanted.sum()) or plain(self, a, wanted))
    asked.scan(H.Block(*H._unpack(H.Block.build(np.arange(3000), np.zeros(3000, int), x, books))))
    assert sum(scored) < 0.02 * 100 * 3000


def test_ties_and_one_label(spark):
    data = [(k, [0.5, 0.5], 1, "c") for k in range(40)] + [(100 + k, [0.5, 0.5], 2, "c") for k in range(20)]
    assert len(check(spark, data)) == 6 * 25
    check(spark, data[:40])


def test_empty(spark):
    check(spark, [])
    check(spark, [(1, [1.0], 1, "c"), (3, [1.0], 2, "c")])
    check(spark, [(0, [], 1, "c"), (1, [], 1, "c"), (2, [], 2, "c")])
