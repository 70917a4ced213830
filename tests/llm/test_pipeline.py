import re

import corpus_pipeline as P
from corpusflow.llm import line_dedup, packing, pii
from tests.llm.helpers import hard_docs, shingle_set

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    names = [n for n, _ in P.STAGES]
    assert names == ["quality", "line_dedup", "near_duplicates", "personal_data", "packing"]
    frames = {}
    for name, stage in P.STAGES:
        docs = P.materialize(stage(spark, docs, SF), name)
        frames[name] = docs
        if name != "packing":
            assert docs.columns == list(P.COLUMNS)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in frames["quality"].collect()}
    clean = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in clean) >= 0.97 * len(clean) and len(kept) < len(before)

    lines = {r.doc_id: r for r in frames["line_dedup"].collect()}
    assert set(lines) == kept and all(r.n_chars == len(r.text) for r in lines.values())
    seen: dict[bytes, int] = {}
    for r in lines.values():
        for k in {line_dedup.line_key(x.encode()) for x in r.text.split("\n")}:
            seen[k] = seen.get(k, 0) + line_dedup.long_enough(k, 40)
    assert max(seen.values()) < 5

    unique = {r.doc_id: r.text for r in frames["near_duplicates"].collect()}
    sets = [s for s in (shingle_set(t, 5) for t in unique.values()) if s]
    assert not any(100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(sets) for b in sets[:i] if min(len(a), len(b)) * 100 >= 80 * max(len(a), len(b)))

    private = {r.doc_id: r.text for r in frames["personal_data"].collect()}
    assert set(private) == set(unique) and not any(pii.spans(t) for t in private.values())
    assert all(re.sub(r"\[[A-Z]+\]", "", t) for t in private.values() if t)

    pieces = frames["packing"].collect()
    assert {r.doc_id for r in pieces} == set(private)
    ids = packing.ByteBpe(packing.default_tokenizer())
    for doc, text in list(private.items())[:40]:
        assert sum(r.length for r in pieces if r.doc_id == doc) == len(ids.encode([text])[0]) // 4 + 1


def test_run_is_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, docs.collect())) == sorted(map(key, P.run(spark, SF).collect()))


def test_stages_on_hard_rows(spark):
    """Nulls, empty and long texts, repeated rows and ids, and no rows at all, through every stage."""
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    hard = [(r[0], r[1], None, r[2], None) for r in hard_docs()] + [(None, None, None, None, None)] * 2
    long = "This line of the footer is in many documents, all of them"
    hard += [(7000 + k, f"own {k}\n{long}", "en", "s", 1) for k in range(6)] + [(7000, f"own 0\n{long}", "en", "s", 1)]
    for rows in (hard, []):
        docs = spark.createDataFrame(rows, columns)
        for name, stage in P.STAGES[1:]:
            before, docs = docs, P.materialize(stage(spark, docs, SF), name)
            if name != "packing":
                assert docs.columns == list(P.COLUMNS)
            if name in ("line_dedup", "personal_data"):
                assert docs.count() == before.count()
        assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()}
        kept = P.quality(spark, spark.createDataFrame(rows, columns), SF)
        assert kept.columns == list(P.COLUMNS) and kept.count() <= len(rows)
