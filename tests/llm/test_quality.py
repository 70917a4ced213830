import zlib

import numpy as np

from corpusflow.llm import quality as Q
from tests.llm.helpers import DOCS, hard_docs


def test_held_out_accuracy(spark):
    got = Q.op4_quality(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 40
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.93
    clean = [r for r in rows if r.quality == 1]
    assert np.mean([r.predicted for r in clean]) >= 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.collect())


def test_rules_are_columns(spark):
    """The compiled column gives what the rules give in numpy."""
    rng = np.random.default_rng(1)
    x = rng.random((400, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 1] <= 0.7)).astype(float)
    rules = Q.fit(x, y, ["a", "b", "c"])
    assert 0 < len(rules.rules) < 200
    total = rules.intercept + sum(w * Q._holds(x, r) for r, w in zip(rules.rules, rules.weights, strict=True))
    from pyspark.sql import functions as F

    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    got = np.array([r.s for r in df.select(rules.column(F.struct("a", "b", "c")).alias("s")).collect()])
    assert np.allclose(np.sort(got), np.sort(1 / (1 + np.exp(-total))), atol=1e-9)
    assert np.mean((1 / (1 + np.exp(-total)) > 0.5) == y) > 0.98


def test_hard_rows(spark):
    rows = hard_docs()
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("n_lines", "score")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = Q.score_quality(docs, none)
    assert got.columns == ["doc_id", "text", "lang", "held_out", "score", "predicted"]
    assert got.count() == len(rows) and {round(r.score, 3) for r in got.collect()} == {0.5}
    one = spark.createDataFrame([(10, 1), (11, 1), (None, 0), (12, None)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in Q.score_quality(docs, one).collect())
    assert Q.score_quality(spark.createDataFrame([], DOCS), none).collect() == []


def test_statistics_same_as_plain(spark):
    """Statistics and features of hard texts against plain Python."""
    import re
    import unicodedata

    from pyspark.sql import functions as F

    texts = [None, "", " ", "\n", "A bc!\n\nA bc!, 12. Äö É $%", "x" * 5000, "One\ttwo\x0bthree\r\nfour? {a}=b_c \\ @+/", "ü😀 ÀB\u00a0c"] + [r[1] for r in hard_docs()]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    found, names = Q.with_features(docs)
    stats = [c.alias(n) for n, c in Q.statistics(F.coalesce("text", F.lit(""))).items()]
    stats = {r.doc_id: r.asDict() for r in docs.select("doc_id", *stats).collect()}
    for r in found.collect():
        t = r.text or ""
        words = [w for w in re.split(r"[ \t-\r]+", t) if w]
        lines = t.split("\n")
        many = lambda p: float(len(re.findall(p, t)))  # noqa: E731, B023
        plain = {
            "chars": float(len(t)), "words": float(len(words)), "distinct_words": float(len(set(words))), "lines": float(len(lines)), "distinct_lines": float(len(set(lines))),
            "upper": float(sum(unicodedata.category(c) == "Lu" for c in t)), "digits": many("[0-9]"), "symbols": many(r"[*%#&$|<>{}=~^_\\@+/]"), "shouts": many("!"), "stops": many("[.?!]"), "commas": many("[,;:]"),
        }
        assert {k: v for k, v in stats[r.doc_id].items() if k != "doc_id"} == plain
        per = lambda a, b: plain[a] / max(plain[b], 1.0)  # noqa: E731, B023
        expected = {
            "chars": plain["chars"], "words": plain["words"], "word_length": per("chars", "words"), "distinct_words": per("distinct_words", "words"), "richness": plain["distinct_words"] / max(plain["words"], 1.0) ** 0.5,
            "distinct_lines": per("distinct_lines", "lines"), "line_words": per("words", "lines"), "upper": per("upper", "chars"), "digits": per("digits", "chars"), "symbols": per("symbols", "words"), "shouts": per("shouts", "words"),
            "stops": per("stops", "words"), "commas": per("commas", "words"),
        }
        assert names == list(expected)
        assert all(abs(r["__f"][n] - v) < 1e-9 for n, v in expected.items())
