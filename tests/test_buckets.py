import pytest
from pyspark.sql import functions as F

from corpusflow.operators import buckets as B
from corpusflow.operators import merge as M
from corpusflow.session import ship
from tests.test_merge import papers


def newest(old, new):
    """Rows of new, and those of old whose key did not come."""
    return new.unionByName(old.join(new, "k", "left_anti"))


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    ship(spark)
    rows = spark.range(200).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    return B.BucketTable.create(rows, str(tmp_path / "t"), ["k"], 16)


def files(table, version=None):
    return {r[0] for r in table.read(version).select(F.input_file_name()).distinct().collect()}


def test_only_hit_buckets_are_rewritten(spark, table):
    before = table.version()
    new = spark.createDataFrame([(3, "x"), (1000, "y")], "k int, v string")  # keys of another type find their bucket
    after = table.upsert(new, newest)
    hit = {r[0] for r in new.select(table.bucket(before)).collect()}
    assert {b for b in after.parts if after.parts[b] != before.parts.get(b)} == hit
    assert len(files(table, 0) & files(table, 1)) == len(before.parts) - len(hit)
    got = dict(content(table.read()))
    assert len(got) == 201 and got[3] == "x" and got[1000] == "y" and got[4] == "v4"
    assert len(content(table.read(0))) == 200


def test_reader_keeps_its_version(spark, table):
    reader = table.read()
    table.replace(spark.createDataFrame([(1, "only")], "k long, v string"))
    assert reader.count() == 200 and content(table.read()) == [(1, "only")]


def test_replacement_that_fails_its_check(spark, table):
    def check(written):
        if written.where("v IS NULL").count():
            raise ValueError("nulls")

    with pytest.raises(ValueError, match="nulls"):
        table.replace(spark.createDataFrame([(1, None)], "k long, v string"), check)
    assert table.version().number == 0 and table.read().count() == 200
    assert table.replace(spark.createDataFrame([(1, "a")], "k long, v string"), check).number == 1 and table.read().count() == 1


def test_job_that_dies_leaves_the_table(spark, table):
    def dies(old, new):
        return newest(old, new).withColumn("v", F.when(F.col("k") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))

    new = spark.createDataFrame([(7, "x"), (8, "y")], "k long, v string")
    with pytest.raises(Exception, match="lost"):
        table.upsert(new, dies)
    assert table.version().number == 0 and table.read().count() == 200
    used = set(table.version().parts.values())
    assert not set(table.vacuum()) & used and table.read().count() == 200


def test_other_writer_elsewhere_and_in_the_same_bucket(spark, table):
    new, calls = spark.createDataFrame([(3, "mine")], "k long, v string"), []
    place = lambda k: spark.createDataFrame([(k,)], "k long").select(table.bucket(table.version())).first()[0]
    elsewhere = next(k for k in range(100) if place(k) != place(3))

    def meanwhile(key):
        def merge(old, rows):
            calls.append(key)
            if len(calls) == 1:
                table.upsert(spark.createDataFrame([(key, "theirs")], "k long, v string"), newest)
            return newest(old, rows)

        return merge

    assert table.upsert(new, meanwhile(elsewhere)).number == 2 and len(calls) == 1
    assert {k: v for k, v in content(table.read()) if k in (3, elsewhere)} == {3: "mine", elsewhere: "theirs"}
    calls.clear()

    def joined(old, rows):
        return meanwhile(3)(old.select("k", F.concat("v", F.lit("+")).alias("v")), rows.limit(0))

    table.upsert(new, joined)
    assert len(calls) == 2 and dict(content(table.read()))[3] == "theirs+"  # seen on the second call only


def test_second_commit_of_a_number_is_a_conflict(table):
    with pytest.raises(B.Conflict):
        table._commit(table.version())
    assert table.files.names("versions").count("0000000000.json") == 1 and not [n for n in table.files.names("versions") if n.endswith(".new")]


def test_edges(spark, table, tmp_path):
    none = spark.createDataFrame([], "k long, v string")
    assert table.upsert(none, newest).number == 0
    with pytest.raises(ValueError, match="other buckets"):
        table.upsert(spark.createDataFrame([(3, "x")], "k long, v string"), lambda old, new: table.read())
    with pytest.raises(ValueError, match="columns"):
        table.upsert(spark.createDataFrame([(3, "x")], "k long, v string"), lambda old, new: new.drop("v"))
    with pytest.raises(ValueError):
        B.BucketTable.create(none.withColumn(B.BUCKET, F.lit(1)), str(tmp_path / "clash"), ["k"])
    empty = B.BucketTable.create(none, str(tmp_path / "empty"), ["k"], 4)
    assert empty.read().count() == 0 and empty.read().columns == ["k", "v"]
    rows = spark.createDataFrame([(None, "a"), (None, "a"), (1, None)], "k long, v string")
    empty.upsert(rows, lambda old, new: old.unionByName(new))
    assert content(empty.read()) == content(rows)  # null keys and repeated rows stay; merge decides
    empty.upsert(rows, lambda old, new: old.where("false"))
    assert empty.read().count() == 0 and empty.version().parts == {}
    assert len(empty.vacuum()) == 3 and empty.versions() == [2]


def test_papers(spark, tmp_path):
    old = papers(spark, {"title": "Text to SQL", "labels": ["Survey"]}, {"title": "Other paper"}, {"title": "text-to-sql"})
    new = papers(spark, {"title": "Text-to-SQL.", "doi": "10.1/x"}, {"title": "New one"}, {"title": ""}, {"title": None}, {"title": "New one"})
    table = M.papers_table(old, str(tmp_path / "p"), 8)
    assert M.upsert_into(table, new) == {"added": 1, "updated": 1, "skipped": 1, "invalid": 2}
    whole = M.upsert_papers(old, new).where("title_key <> ''").select("title_key", *M.MERGED)
    assert content(table.read()) == content(whole)
    assert M.upsert_into(table, new) == {"added": 0, "updated": 0, "skipped": 3, "invalid": 2}
