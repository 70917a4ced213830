import random

import pytest
from pyspark.sql import functions as F

from corpusflow import packs
from corpusflow.operators import merge as M
from corpusflow.schema import FIELDS
from corpusflow.session import ship


def papers(spark, *rows):
    ship(spark)
    columns = ", ".join(["ord long", "map_key string", *[f"{f} string" for f in FIELDS], "labels array<string>", "pipeline_stages array<string>"])
    full = [(i, r.get("map_key", ""), *[r.get(f) for f in FIELDS], r.get("labels"), r.get("pipeline_stages")) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, columns)


def test_better_record_is_primary(spark):
    long = "x" * 100
    rows = M.dedupe(papers(spark, {"title": "Text to SQL", "abstract": "short", "author": "first", "labels": ["Survey"]}, {"title": "Text-to-SQL.", "abstract": long, "doi": "10.1/x", "author": "second", "booktitle": "ICDE", "labels": ["Benchmark"]}, {"title": "别的"}, {"map_key": "Only key", "title": ""})).collect()
    by = {r.title_key: r for r in rows}
    assert set(by) == {"texttosql", "only key"}
    r = by["texttosql"]
    assert (r.n, r.author, r.abstract, r.doi, r.venue, r.venue_track) == (2, "second", long, "10.1/x", "ICDE", "数据库领域")
    assert r.labels == ["Benchmarks and Evaluation", "Benchmark", "Survey"]


@pytest.mark.parametrize(("gain", "replaced"), [(40, False), (41, True)])
def test_abstract_gain(spark, gain, replaced):
    a = "a" * 100
    rows = M.dedupe(papers(spark, {"title": "Same title", "abstract": a, "doi": "d", "url": "u"}, {"title": "same title", "abstract": "b" * (100 + gain)})).collect()
    assert (rows[0].abstract[0] == "b") is replaced and rows[0].doi == "d"


def test_equal_scores_keep_the_first(spark):
    rows = M.dedupe(papers(spark, {"title": "Same title", "author": "one"}, {"title": "Same title!", "author": "two"})).collect()
    assert rows[0].author == "one" and rows[0].ord == 0


def test_higher_venue_wins_with_its_source(spark):
    rows = M.dedupe(papers(spark, {"title": "Same title", "source": "arXiv", "abstract": "x" * 90, "doi": "d", "url": "u", "year": "2023"}, {"title": "Same title", "booktitle": "Proc. VLDB Endow.", "year": "2024"})).collect()
    assert (rows[0].venue, rows[0].booktitle, rows[0].source, rows[0].year, rows[0].doi) == ("VLDB", "Proc. VLDB Endow.", None, "2024", "d")


def test_merged_rows_have_no_duplicates(spark):
    rows = [{"title": f"Paper {i % 4}", "abstract": "w " * (i * 7), "doi": "d" if i % 3 else None} for i in range(20)]
    once = M.dedupe(papers(spark, *rows))
    again = M.dedupe(once.withColumn("map_key", F.lit("")).drop("n"))
    assert once.count() == 4 and again.agg(M.duplicates()).first()[0] == 0 and once.agg(M.duplicates()).first()[0] == 16


def test_fold_is_in_order(spark):
    rng = random.Random(1)
    rows = [(k, o, rng.choice("abc")) for k in range(5) for o in range(rng.randint(1, 40))]
    rng.shuffle(rows)
    out = M.fold(spark.createDataFrame(rows, "k int, o long, v string"), ["k"], "o", F.col("v"), lambda a, b: a + b)
    for r in out.collect():
        own = sorted((o, v) for k, o, v in rows if k == r.k)
        assert (r.record, r.n, r.o) == ("".join(v for _, v in own), len(own), 0)


@pytest.mark.parametrize("batch", [10_000, 20, 2])
def test_fold_of_hot_keys_is_the_plain_fold(spark, batch, monkeypatch):
    rng = random.Random(2)
    sizes = {0: [10] * 255 + [15, 45, 60] + [10] * 9, None: [rng.randint(0, 150) for _ in range(300)]}
    sizes |= {k: [rng.randint(0, 150) for _ in range(rng.choice([1, 5, 200, 600]))] for k in range(1, 12)}
    rows = [(k, o, chr(97 + o % 26) * n) for k, own in sizes.items() for o, n in enumerate(own)]
    rng.shuffle(rows)
    gain = M.GAIN
    monkeypatch.setattr(M, "GIVEN", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = M.fold(spark.createDataFrame(rows, "k int, o long, v string").repartition(5), ["k"], "o", F.col("v"), lambda a, b: b if len(b) > len(a) + gain else a).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        want[k] = v if k not in want or len(v) > len(want[k]) + M.GAIN else want[k]
    assert {r.k: r.record for r in got} == want and len(got) == len(sizes)
    assert {r.k: (r.o, r.n) for r in got} == {k: (0, len(own)) for k, own in sizes.items()}
    assert len(want[0]) == 60


def test_fold_of_one_hot_key_is_one_job(spark):
    rows = spark.range(20_000).select((F.col("id") >= 0).alias("a"), F.when(F.col("id") < 0, "z").alias("b"), F.col("id").alias("o"), F.struct(F.col("id").alias("x"), F.array(F.lit("y")).alias("l")).alias("r"))
    out = M.fold(rows, ["a", "b"], "o", F.col("r"), lambda a, b: {"x": (31 * a["x"] + b["x"]) % 1_000_003, "l": a["l"]})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and plan.count("Exchange hashpartitioning") == 1
    want = 0
    for k in range(1, 20_000):
        want = (31 * want + k) % 1_000_003
    assert [tuple(r) for r in out.collect()] == [(True, None, 0, 20_000, (want, ["y"]))]
    assert M.fold(rows.limit(0), ["a", "b"], "o", F.col("r"), lambda a, b: a).collect() == []


def test_python_score_is_that_of_columns(spark):
    rng = random.Random(4)
    some = lambda f: rng.choice([None, "", "x" * rng.choice([1, 79, 80])]) if f != "booktitle" else rng.choice([None, "ICDE", "arXiv"])
    rows = [{f: some(f) for f in FIELDS} | {"title": f"t {k}", "labels": rng.choice([None, [], ["Survey"]]), "pipeline_stages": rng.choice([None, [], ["x"]])} for k in range(60)]
    df, record = M._records(papers(spark, *rows), packs.VENUES, packs.TOPICS)
    pairs = df.select(M.score({f: F.col(f) for f in M.MERGED}, F.col("venue"), F.col("venue_track")).alias("s"), record.alias("r")).collect()
    assert all(r.s == M.told(r.r.asDict()) for r in pairs) and len({r.s for r in pairs}) > 8


def test_upsert(spark):
    s = "key string, a string, b string"
    old = spark.createDataFrame([("k1", "x", None), ("k2", "x", "y"), ("k3", "x", "y")], s)
    new = spark.createDataFrame([("k1", "z", "n"), ("k2", "x", ""), ("k4", "q", ""), ("", "bad", ""), (None, "bad", "")], s)
    got = {r.key: (r.a, r.b, r.status) for r in M.upsert(old, new, ["a", "b"]).collect()}
    assert got == {"k1": ("z", "n", "updated"), "k2": ("x", "y", "skipped"), "k3": ("x", "y", "kept"), "k4": ("q", "", "added"), "": ("bad", "", "invalid"), None: ("bad", "", "invalid")}
    assert {r.key: r.status for r in M.upsert(old, old, ["a", "b"]).collect()} == {"k1": "skipped", "k2": "skipped", "k3": "skipped"}
    assert M.upsert(old, new, ["a", "b"], prefer_existing=True).where("key = 'k1'").first().a == "x"


def test_acceptable(spark):
    df = papers(spark, {"title": "Text-to-SQL", "labels": ["Survey"], "pipeline_stages": ["SQL Generation"]}, {"title": "Text-to-SQL", "labels": []}, {"title": "Trees", "labels": ["Survey"], "pipeline_stages": ["x"]})
    assert [r[0] for r in df.orderBy("ord").select(M.acceptable(df)).collect()] == [True, False, False]
    assert packs.TOPICS.default
