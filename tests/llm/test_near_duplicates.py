import itertools
import random

import numpy as np
import pytest

from corpusflow.llm import ngram_join as J
from corpusflow.llm.common import components as connected
from tests.llm.helpers import DOCS, components, hard_docs, near, prose, shingle_set


def plain(rows, n, num, den):
    sets = [(r[0], shingle_set(r[1], n)) for r in rows if r[0] is not None]
    edges = [(a, b) for (a, s), (b, t) in itertools.combinations(sets, 2) if s and t and den * len(s & t) >= num * len(s | t)]
    return components([a for a, _ in sets], edges)


@pytest.mark.parametrize(("n", "num"), [(3, 90), (5, 80)])
def test_same_as_plain(spark, n, num):
    rows = hard_docs(n)
    rng = random.Random(5)
    base = prose(rng, 150)
    chain = [base]
    for _ in range(12):  # each like the one before, the last unlike the first
        chain.append(near(rng, chain[-1], 1))
    rows += [(1000 + i, t, "en", "x") for i, t in enumerate(chain)]
    got = J.jaccard_classes(spark.createDataFrame(rows, DOCS), n, num, 100).collect()
    assert len(got) == len(rows)
    expected = plain(rows, n, num, 100)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == expected
    assert len(set(expected.values())) < len(expected) - 20
    sizes = {(r[0], len(shingle_set(r[1], n))) for r in rows}
    assert {(r.doc_id, r.n_shingles) for r in got} == sizes


@pytest.mark.parametrize("chunk", [1, 3])
def test_small_chunks_lose_no_link(spark, monkeypatch, chunk):
    rows = hard_docs(9)
    expected = plain(rows, 3, 90, 100)
    monkeypatch.setattr(J, "CHUNK", chunk)
    monkeypatch.setattr(J, "MEET", chunk)
    monkeypatch.setattr(J, "MOST", 1)
    got = J.jaccard_classes(spark.createDataFrame(rows, DOCS), 3, 90, 100).collect()
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == expected


@pytest.mark.parametrize("turn", [1, -1])
def test_each_text_of_a_repeated_id_links(spark, turn):
    rng = random.Random(11)
    rows = []
    for k in range(6):
        texts = [prose(rng, 120) for _ in range(3)]
        rows += [(100 * k + 50, t, "en", "x") for t in texts] + [(100 * k + i + (60 if k % 2 else 10), near(rng, t, 1), "en", "x") for i, t in enumerate(texts)]
    rows += hard_docs(3)
    expected = plain(rows, 3, 90, 100)
    assert all(len({expected[100 * k + i] for i in ((50, 60, 61, 62) if k % 2 else (10, 11, 12, 50))}) == 1 for k in range(6))
    got = J.jaccard_classes(spark.createDataFrame(rows[::turn], DOCS).coalesce(1), 3, 90, 100).collect()
    assert len(got) == len(rows) and {r.doc_id: r.component_id for r in got if r.doc_id is not None} == expected


def test_one_of_each_class_stays(spark):
    rows = hard_docs(2)
    kept = [r.doc_id for r in J.near_unique(spark.createDataFrame(rows, DOCS), 3, 90, 100).collect()]
    first = {c for c in plain(rows, 3, 90, 100).values()}
    assert {k for k in kept if k is not None} == first and None in kept


def test_empty_table(spark):
    assert J.jaccard_classes(spark.createDataFrame([], DOCS), 3, 90, 100).collect() == []


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(4)
    for num, den in ((90, 100), (80, 100), (1, 2)):
        for size in list(range(1, 40)) + [100, 333, 1000]:
            bands = J.Bands(num, den)
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2))
            low = -(-size * num // den)
            drop = rng.integers(0, size - low + 1)
            b = np.sort(rng.permutation(a)[: size - drop])
            room = len(b) * den // num - len(a)
            if room > 0:
                b = np.unique(np.concatenate([b, rng.integers(0, 2**63, rng.integers(0, room + 1), dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if den * common >= num * (len(a) + len(b) - common) and not np.array_equal(a, b):
                assert set(J.signatures(a, bands)) & set(J.signatures(b, bands)), (num, den, len(a), len(b))


def test_sketch_never_exceeds_the_difference():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**64, rng.integers(1, 300), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 2**64, rng.integers(0, 30), dtype=np.uint64)]))
        words = J.folded([J.sketch(a, 40), J.sketch(b, 15)])
        assert np.bitwise_count(words[0] ^ words[1]).sum() <= len(np.setxor1d(a, b))


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 600)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    proper = [(a, b) for a, b in edges if a != b]
    assert got == components({x for e in proper for x in e}, proper)
