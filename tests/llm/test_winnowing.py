import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import winnowing as W
from tests.llm.helpers import WORDS, hard_docs

DOCS = "doc_id long, text string, n_hit string, mark int"
ITEMS = "item_id long, text string, doc_id string"


def plain_words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def plain(docs, items, span=10):
    windows = {}
    for item_id, text in items:
        ws = plain_words(text)
        n = min(span, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[i : i + n]), set()).add("" if item_id is None else str(item_id))
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        ws, hit, found = plain_words(text), set(), set()
        for n in lengths:
            for i in range(len(ws) - n + 1):
                if (own := windows.get(tuple(ws[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= own
        out.append((doc_id, len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def run(spark, docs, items, **how):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], DOCS)
    return [tuple(r) for r in W.judged(docs, spark.createDataFrame([(i, t, "y") for i, t in items], ITEMS), **how).drop("text_key").collect()]


def same(got, expected):
    return sorted(got, key=repr) == sorted(expected, key=repr)


def passages(rng, n, words=40):
    return [" ".join(rng.choice(WORDS) + str(rng.randint(0, 9)) for _ in range(rng.randint(1, words))) for _ in range(n)]


@pytest.mark.parametrize("how", [{}, {"span": 6, "gram": 3}])
def test_same_as_plain(spark, how):
    rng = random.Random(3)
    texts = passages(rng, 30)
    items = [(k, t) for k, t in enumerate(texts)] + [(None, texts[3]), (3, "Another one of ID three, with more than ten words in it as well."), (50, None), (51, " \t"), (52, "É tude"), (53, "word"), (54, "the " * 30)]
    docs = [(d, t) for d, t, *_ in hard_docs()][:40]
    for k in range(200):
        ws = passages(rng, 1, 60)[0].split()
        own = rng.choice(texts).split()
        lo = rng.randint(0, len(own) - 1)
        cut = own[lo : lo + rng.choice([3, 8, 9, 10, 11, 40])]
        at = rng.randint(0, len(ws))
        docs.append((1000 + k, rng.choice([" ", "-", ",\n"]).join([*ws[:at], *cut, *ws[at:]]).replace("a", rng.choice("aA"))))
    docs += [(5000, "É TUDE"), (5001, "é tude"), (5002, "the " * 50), (5003, "a 'word'!"), (5003, "nothing"), (5003, "a 'word'!"), (None, texts[3]), (5004, "x".join(texts))]
    expected = plain(docs, items, how.get("span", 10))
    assert same(run(spark, docs, items, **how), expected)
    assert 50 < sum(r[-1] for r in expected) < len(expected)


def test_shared_spans_are_never_missed():
    """Equal runs have equal fingerprints wherever they stand."""
    rng = random.Random(5)
    h = [rng.randint(0, 10**6) for _ in range(300)]
    least = lambda g: [min(g[i : i + 6]) for i in range(len(g) - 5)]
    grams = lambda ws: [hash(tuple(ws[i : i + 5])) for i in range(len(ws) - 4)]
    for at in range(0, 290, 7):
        assert least(grams(h[at : at + 10])) == [least(grams(h))[at]]


def test_fingerprints_are_sparse(spark):
    text = " ".join(passages(random.Random(8), 60))
    row = spark.createDataFrame([(text,)], "text string").select(W.words(F.col("text")).alias("ws")).select(F.size("ws").alias("n"), F.size(F.array_distinct(W.fingerprints(F.col("ws"), 10))).alias("m")).first()
    assert 0.2 * row.n < row.m < 0.4 * row.n


def test_beyond_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(W, "bounded", lambda df, most=0: df.hint("shuffle_merge"))
    rng = random.Random(4)
    texts = passages(rng, 12)
    items, docs = list(enumerate(texts)), [(k, f"before {texts[k % 12]} after {texts[(k * 5) % 12]}") for k in range(60)]
    assert same(run(spark, docs, items), plain(docs, items))


def test_common_window_of_many_items(spark):
    head = "choose the best answer to the question that is asked below"
    items = [(k, f"{head} number{k} and {k * k}") for k in range(300)]
    docs = [(k, f"{head} {k}") for k in range(200)] + [(900, f"x {head} number7 and 49")]
    assert same(run(spark, docs, items), plain(docs, items))


def test_empty_tables(spark):
    one, none = [(1, "some text of no matter")], []
    assert same(run(spark, one, none), plain(one, none))
    assert run(spark, none, [(1, one[0][1])]) == []
    assert run(spark, none, none) == []


def test_decontaminate_keeps_clean_rows(spark):
    docs = spark.createDataFrame([(1, "one two three", "x", 1), (1, "clean", "x", 2), (2, None, "x", 3), (None, "say one two three", "x", 4)], DOCS)
    items = spark.createDataFrame([(9, "one two three", "y")], ITEMS)
    kept = W.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.mark for r in kept.collect()) == [2, 3]
    plan = W.judged(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
