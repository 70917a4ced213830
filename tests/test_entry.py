"""Queries against their SQL, on the smallest tables."""

import math
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from corpusflow.plans import registry as library

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return tuple(map(plain, value)) if isinstance(value, list | tuple) else value


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted((tuple(plain(v) for v in r) for r in result.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr) == expected


@pytest.mark.parametrize("name", sorted(set(library.QUERIES) - set(library.ORACLES)))
def test_runs_without_sql(spark, name):
    assert library.QUERIES[name](spark, SF).count() >= 0


@pytest.mark.parametrize("name", ["source_bib", "source_evidence", "source_json_lists", "source_json_maps", "source_ndss_html"])
def test_numbers_of_blocks_are_no_years(spark, tmp_path, monkeypatch, name):
    """Blocks 1998 to 2097, as larger tables have them: years are those of the files, not numbers of blocks."""
    con = duckdb.connect()
    con.execute(f"CREATE TABLE part AS SELECT * REPLACE (1998 * 40 + p_partkey * 20 AS p_partkey) FROM '{SF}/part.parquet' WHERE p_partkey < 200")
    con.execute(f"COPY part TO '{tmp_path}/part.parquet' (FORMAT parquet)")
    monkeypatch.setattr(sys.modules[__name__], "SF", str(tmp_path))
    test_same_rows_as_sql(spark, con, name)


@pytest.mark.parametrize("name", ["source_evidence", "source_json_lists", "source_json_maps", "source_ndss_html"])
@pytest.mark.parametrize("first", [10**17, -100])
def test_blocks_of_far_keys(spark, tmp_path, monkeypatch, name, first):
    """Keys that doubles can't tell apart, and keys below zero: every part is in the block of its key."""
    con = duckdb.connect()
    con.execute(f"CREATE TABLE part AS SELECT * REPLACE ({first} + p_partkey AS p_partkey) FROM '{SF}/part.parquet' WHERE p_partkey < 200")
    con.execute(f"COPY part TO '{tmp_path}/part.parquet' (FORMAT parquet)")
    monkeypatch.setattr(sys.modules[__name__], "SF", str(tmp_path))
    test_same_rows_as_sql(spark, con, name)


def test_sorted_json_in_pieces(spark, duck):
    """Files that are read in several pieces each (as large ones are) give every row its place."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        test_same_rows_as_sql(spark, duck, "sink_sorted_json")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and [r.n for r in rows] == sorted((r.n for r in rows), reverse=True)
