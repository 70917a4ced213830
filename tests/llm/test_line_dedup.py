import hashlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import line_dedup as L
from tests.llm.helpers import DOCS, hard_docs

SHARED = "  This line is shared by very many documents, ÄÖ.\t"


def rows():
    out = []
    for k, r in enumerate(hard_docs()):
        text = r[1]
        if text is not None and k % 2:
            text = text + "\n" + (SHARED if k % 3 else SHARED.upper().replace("ÄÖ", "ÄÖ")) + "\n\n" + ("x" * 39 + "\n") * 2 + ("ü" * 40)
        out.append((r[0], text, *r[2:]))
    return out


def plain(rows):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\v\f\r"))
    holders = defaultdict(set)
    for doc, text, *_ in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 40:
                holders[k].add((doc is not None, doc or 0))
    out = []
    for doc, text, *_ in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if len(holders[key(x)]) < 5 or max(holders[key(x)]) == (doc is not None, doc or 0)]
        out.append((str(doc), len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def digest(df):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in df.collect())


@pytest.mark.parametrize(("shard_keys", "task_probes"), [(1 << 18, 1 << 22), (3, 2)])
def test_same_as_plain(spark, shard_keys, task_probes):
    docs = spark.createDataFrame(rows(), DOCS)
    got = L.dedup_lines(docs, shard_keys=shard_keys, task_probes=task_probes)
    assert got.columns == ["doc_id", "text", "lang", "n_lines", "n_dropped"]
    got = digest(got)
    assert got == plain(rows()) and any(r[2] for r in got)


def test_repeated_ids_are_one_document(spark):
    line = "A line of the license that is long enough to count, by far"
    few = [(1, line), (1, line), (1, "x\n" + line), (2, line), (2, line), (None, line), (None, line), (-(2**63), line)]
    for data in (few, [*few, (3, "y\n" + line + "\n" + line)], [*few, (-(2**63) + 1, line)]):
        full = [(*r, "en", "n") for r in data]
        assert digest(L.dedup_lines(spark.createDataFrame(full, DOCS))) == plain(full)
    assert not any(r[2] for r in plain([(*r, "en", "n") for r in few])) and any(r[2] for r in plain([(*r, "en", "n") for r in [*few, (3, line)]]))


def test_repeated_ids_same_as_sql(spark):
    line = "A line of the license that is long enough to count, by far"
    for ids in ((1, 1, 1, 2, 2), (1, 1, 2, 3, 4, 5)):
        full = [(i, line + ("\nown " + str(i)), "en", "n") for i in ids]
        con = duckdb.connect()
        con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
        con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in full])
        dropped = {r[0]: bool(r[2]) for r in con.execute(L.OP1_SQL).fetchall()}
        got = {r.doc_id: bool(r.n_dropped) for r in L.dedup_lines(spark.createDataFrame(full, DOCS)).collect()}
        assert got == dropped


def test_empty_table(spark):
    assert L.dedup_lines(spark.createDataFrame([], DOCS)).collect() == []


def test_perfect_hash_is_minimal_and_rejects_others():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 20_000):
        h = rng.integers(-(2**63), 2**63 - 1, (2, n), dtype=np.int64)
        index = L.PerfectHash.from_bytes(L.PerfectHash.build(h[0], h[1], np.arange(n), np.arange(n) * 3).to_bytes())
        at = index.find(h[0], h[1])
        assert sorted(at) == list(range(n))
        assert (index.count[at] == np.arange(n)).all() and (index.largest[at] == 3 * np.arange(n)).all()
        other = rng.integers(-(2**63), 2**63 - 1, (2, 5000), dtype=np.int64)
        assert (index.find(other[0], other[1]) == -1).all()


def test_query_columns(spark):
    out = L.op1_line_dedup(spark, "/root/testdata/sf0.001")
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "bigint", "bigint", "string"]
    assert out.where(F.col("n_dropped") > 0).count()
