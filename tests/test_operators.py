import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from corpusflow import packs
from corpusflow import sinks as K
from corpusflow.operators import facets as A
from corpusflow.operators import gates as V
from corpusflow.operators import incremental as I
from corpusflow.operators import joins as J
from corpusflow.operators import sampling as L
from corpusflow.session import ship
from corpusflow.streaming import states


def rows(spark, schema, *values):
    ship(spark)
    return spark.createDataFrame(list(values), schema)


def test_canaries(spark):
    papers = rows(spark, "key string, title string, venue string, year string, relevance_level string", ("texttosql", "Text-to-SQL", "ICDE", "2024", "core"), ("other", "Other", "ICDE", "2020", "irrelevant"))
    got = {r.title: (r.found, r.ok) for r in J.canary_status(rows(spark, "title string, venue string, year string", ("Text 2 SQL", "ICDE", "2024"), ("Other", "ICDE", "2020"), ("None", "X", "1")), papers).collect()}
    assert got == {"Text 2 SQL": (True, True), "Other": (True, False), "None": (False, False)}


def test_reconcile(spark):
    s = "key string, title string, venue string, venue_track string, booktitle string, journal string, relevance_level string"
    papers = rows(spark, s, ("a", "A", "ArXiv", "ArXiv", "", "CoRR", "core"), ("b", "B", "ICDE", "数据库领域", "ICDE", "", "core"), ("c", "C", "VLDB", "wrong", "VLDB", None, "core"), ("d", "D", "ICDE", "", "", "", "irrelevant"), ("e", "E", "ICDE", "数据库领域", "ICDE", "", "core"))
    e = "key string, target string, raw_title string, path string, booktitle string, journal string, year string, ord long"
    proof = rows(spark, e, ("a", "TKDE", "A", "p", "", "TKDE", "2023", 1), ("a", "ICDE", "A", "q", "ICDE", "", "2022", 2), ("a", "KDD", "A", "r", "KDD", "", "2022", 3), ("b", "ICDE", "B", "p", "ICDE", "", "2022", 1), ("c", "VLDB", "C", "p", "VLDB", "", "2022", 1), ("d", "KDD", "D", "p", "", "", "", 1), ("e", "TKDE", "E", "p", "", "", "2024", 1))
    got = {r.key: (r["to"].venue, r["to"].venue_track, r.rawdata_path, r.changed) for r in J.reconcile(papers, proof).collect()}
    assert got == {"a": ("ICDE", "数据库领域", "q", True), "b": ("ICDE", "数据库领域", "p", False), "c": ("VLDB", "数据库领域", "p", True), "e": ("ICDE", "数据库领域", "p", False)}


def test_changes_find_nothing_twice(spark):
    now = rows(spark, "k string, v string", ("a", "1"), ("b", "2"), ("n", None))
    old = rows(spark, "k string, v string", ("a", "1"), ("b", "3"), ("gone", "x"))
    assert {r.k: r.state for r in J.changes(now, old, "k", "v").collect()} == {"a": "same", "b": "changed", "n": "new", "gone": "stale"}
    assert {r.state for r in J.changes(now, now, "k", "v").collect()} == {"same"}


def test_small_joins(spark):
    base = rows(spark, "key string, openalex_id string, semantic_scholar_id string", ("a", "w", None), ("b", None, ""), ("", "w", ""), ("c", "", "s"))
    assert {r.key for r in J.policy_removed(base, base.where("key = 'c'")).collect()} == {"a"}
    filled = J.apply_by_key(rows(spark, "doi string, abstract string", ("d1", ""), ("d2", "old"), ("d3", None)), rows(spark, "doi string, abstract string", ("d1", "new"), ("d2", "new")), "doi", ["abstract"])
    assert {r.doi: r.abstract for r in filled.collect()} == {"d1": "new", "d2": "old", "d3": None}
    index = rows(spark, "path string, content string", ("p", '<div class="paper"><p class="title">A &amp; B!</p><a href="x.html">abs</a></div>'))
    assert [r.url for r in J.index_links(index, rows(spark, "title string", ("a b",), ("c",))).collect()] == ["x.html"]
    picked = J.failed_among(rows(spark, "venue string", ("ICDE",), ("KDD",)), rows(spark, "venue string", ("icde",), (None,)))
    assert [r.venue for r in picked.collect()] == ["ICDE"]
    cover = J.coverage(rows(spark, "v string", ("a",), ("b",), ("c",)), rows(spark, "v string, raw_candidates long", ("a", 3), ("a", 4)), ["v"], rows(spark, "v string", ("b",)))
    assert {r.v: (r.raw_candidates, r.status) for r in cover.collect()} == {"a": (7, "available"), "b": (0, "official_missing"), "c": (0, "missing")}


def test_facets_without_selection_are_plain_counts(spark):
    df = rows(spark, "lang string, labels array<string>, search string", ("en", ["x", "y"], "abc"), ("de", ["x"], "bcd"), (None, None, "ab"))
    got = {(r.facet, r.value): r.n for r in A.drill_down(df, A.Selection(), ["lang", "labels"]).collect()}
    assert got == {("lang", "en"): 1, ("lang", "de"): 1, ("lang", ""): 1, ("labels", "x"): 2, ("labels", "y"): 1}
    got = {(r.facet, r.value): r.n for r in A.drill_down(df, A.Selection("b", {"lang": "en"}, {"labels": ["x"]}), ["lang", "labels"]).collect()}
    assert got == {("lang", "en"): 1, ("lang", "de"): 1, ("labels", "x"): 1, ("labels", "y"): 1}
    taxonomy = rows(spark, "parent_ord int, parent string, child_ord int, child string", (0, "p", 0, "x"), (0, "p", 1, "z"), (1, "q", 0, "w"))
    shown = A.tree(taxonomy, A.label_counts(df, "labels")).collect()
    assert {(r.parent, r.child, r.n) for r in shown} == {("p", "x", 2), ("q", None, 0)}


def test_browser_rows_and_page(spark, tmp_path):
    papers = rows(spark, "title string, abstract string, author string, year string, venue string, venue_track string, url string, doi string, labels array<string>, pipeline_stages array<string>", ("B", "", "", "2023", "ICDE2023", "c", "", "10.1/x", ["l"], ["s"]), ("A", "</script>", "", "2024", "KDD", "c", "u", "", ["l"], []), ("C", "", "", "2024", "KDD", "", "", "", None, None))
    compact = A.compact(papers)
    assert [(r.t, r.u, r.vb) for r in compact.collect()] == [("C", "", "KDD"), ("A", "u", "KDD"), ("B", "https://doi.org/10.1/x", "ICDE")]
    K.write_page(compact, str(tmp_path / "page"), "Papers", packs.CATEGORIES)
    page = "\n".join(p.read_text() for p in sorted((tmp_path / "page").glob("part-*")))
    assert [r["t"] for r in json.loads(page.split("papers=")[1].split(";</script>")[0].replace("<\\/", "</"))] == ["C", "A", "B"]
    assert page.count("</script>") == 1 and '<option value="2024">2024 (2)</option>' in page and '"l": 2' in page


def test_fetch_decisions(spark):
    now = F.lit("2026-05-10T00:00:00Z").cast("timestamp")
    s = [("a", "complete", "h", "2026-05-03T00:00:00Z"), ("b", "complete", "h", "2026-05-03T02:24:00Z"), ("c", "failed", "h", ""), ("d", "complete", "old", "2026-05-09T00:00:00Z"), ("e", "complete", "h", "not a time"), ("f", "complete", "h", "2020-01-01T00:00:00"), ("h", "complete", "h", "2026-05-09 00:00:00"), ("i", "empty", "h", "")]
    st = rows(spark, "record_key string, status string, sha256 string, last_success_at string", *s)
    want = rows(spark, "record_key string, year string, path string", *[(k, "2025" if k == "f" else "x" if k == "z" else "2026", k) for k in "abcdefghiz"])
    files = rows(spark, "path string, sha256 string, modified timestamp", *[(k, "h", dt.datetime(2026, 5, 1, tzinfo=dt.UTC)) for k in "abcdefhiz"])
    got = {r.record_key: (r.skip, r.reason, r.bootstrapped) for r in I.decide_fetch(want, st, files, now).collect()}
    assert got == {
        "a": (False, "active_year_refresh_due", False), "b": (True, "complete", False), "c": (False, "failed", False), "d": (False, "missing_or_changed_file", False), "e": (False, "active_year_missing_success_time", False),
        "f": (True, "complete", False), "g": (False, "missing_state", False), "h": (True, "complete", False), "i": (False, "empty", False), "z": (True, "complete", True),
    }
    never = {r.record_key: r.reason for r in I.decide_fetch(want, st, files, now, -1, bootstrap=False).collect()}
    assert never["a"] == "complete" and never["z"] == "missing_state"
    out = {r.record_key: (r.status, r.last_success_at, r.record_count) for r in I.outcomes(rows(spark, "record_key string, path string, rows long, sha256 string, error string", ("a", "p", 3, "h", ""), ("b", "p", 0, "h", None), ("c", "p", 5, "h", "boom")), now).collect()}
    assert out == {"a": ("complete", "2026-05-10T00:00:00Z", 3), "b": ("empty", "", 0), "c": ("failed", "", 5)}


def test_rotation():
    manifest = [f"v{i}" for i in range(14)] + ["FSE"] + [f"w{i}" for i in range(7)]
    manifest[3] = "NeurIPS"
    plan = I.Rotation(14, ["neurips", "unknown", "NeurIPS"]).select(manifest, 2)
    assert plan == {"selected": ["NeurIPS", "FSE"], "retry_selected": ["NeurIPS"], "new_selected": ["FSE"], "cursor_before": 14, "cursor_after": 15}
    after = I.Rotation(14, ["neurips"]).finalize(plan, {"FSE"}, manifest, "t")
    assert after.retry == ["FSE"] and after.cursor == 15 and after.history[-1]["succeeded"] == ["NeurIPS"]
    many = I.Rotation(0, list("abc")).select(list("abcd"), 4)
    assert many["selected"] == ["a", "d", "b", "c"] and many["cursor_after"] == 0
    assert I.Rotation().select([], 3)["selected"] == [] and len(I.Rotation(history=[{}] * 200).finalize(plan, set(), manifest, "t").history) == I.HISTORY


def test_gates(spark):
    s = "key string, title string, venue string, venue_track string, labels array<string>, relevance_level string, booktitle string, journal string, container string, source string, publisher string, url string, doi string"
    good = ("k", "T", "ICDE", "数据库领域", ["Survey"], "core", "ICDE", None, None, None, None, "", "")
    bad = ("k", "T", "WWW", "wrong", ["Evaluation Metric"], "irrelevant", "x", None, None, None, None, "", "")
    acl = ("m", "T", "ACL", "AI 领域", [], "core", "Findings of ACL", None, None, None, None, "", "")
    found = {r.rule for r in V.violations(V.metrics(rows(spark, s, good, bad, acl))).collect()}
    assert found == {"duplicate_titles", "venue_outside_category", "venue_unsupported", "irrelevant_present", "deprecated_labels", "side_volume_tagged"}
    assert V.violations(V.metrics(rows(spark, s, good))).count() == 0
    assert [r.venue for r in V.side_volume(rows(spark, s, good, acl)).collect()] == ["ACL"]
    every = rows(spark, "payload_ok boolean, sentinel_version int, changed int, stale int, drop_ratio double, canaries_missed int, other_ratio double, api_key_set boolean, dblp_failure_ratio double", (False, 1, None, 2, 0.06, 1, 0.31, False, 0.31))
    assert {r.rule for r in V.violations(every).collect()} == {"payload_not_an_object", "sentinel_version", "dry_run_unreadable", "dry_run_stale", "unexplained_drop", "canary_missed", "other_ratio", "api_key_unset", "dblp_failure_ratio"}
    measured = {r.rule: (r.fatal, r.why) for r in V.findings(every).collect()}
    assert measured["sentinel_version"] == (True, "broken") and measured["duplicate_titles"] == (True, "unmeasured") and measured["rate_limited"] == (False, "unmeasured") and "dry_run_changed" not in measured
    some = [r for r in V.RULES if r[0] in ("duplicate_titles", "rate_limited")]
    assert V.must_hold(V.metrics(rows(spark, s, good)), some) == [("rate_limited", False, "unmeasured")]
    with pytest.raises(V.Refused, match="duplicate_titles"):
        V.must_hold(V.metrics(rows(spark, s, good, bad)), some)


def test_audit(spark):
    s = "title string, present boolean, stratum string, relevance_level string, venue string, year string, doi string, url string, abstract string, openalex_id string, semantic_scholar_id string"
    sample = rows(spark, s, ("a", True, "x", "core", "ICDE", "2024", "d", "d", "t", None, None), ("b", True, "x", "irrelevant", "", "", "", "", "", "w", None), ("c", False, "x", "core", "", "", "", "", "", None, None))
    out = {r.title: r for r in V.audit_rows(sample, rows(spark, "title string, urls array<string>", ("b", ["http://k"]))).collect()}
    assert {k: r.verdict for k, r in out.items()} == {"a": "true_positive_core", "b": "false_positive", "c": "false_positive_removed"}
    assert out["a"].external_sources == ["d"] and out["b"].external_sources == ["w", "http://k"] and out["b"].notes == "missing doi, abstract; risk-directed sample"
    r = V.audit_summary(V.audit_rows(sample)).first()
    assert (r.sample_size, r.current_size, r.false_positives, r.false_positive_ratio, r.removed) == (3, 2, 1, 0.5, 1)
    report = spark.createDataFrame([([("ICDE", "2024", "boom")], [("KDD", "2023", "slow")])], "failures array<struct<venue:string,year:string,error:string>>, warnings array<struct<venue:string,year:string,reason:string>>")
    assert {(x.venue, x.reason, x.kind) for x in V.report_failures(report).collect()} == {("ICDE", "boom", "failures"), ("KDD", "slow", "warnings")}


def test_samples(spark):
    df = rows(spark, "k long, g string", *[(i, "ab"[i % 2]) for i in range(50)])
    a = L.stratified(df, "k", [("even", F.col("g") == "a", 5), ("small", F.col("k") < 20, 5)], 14, 3, F.col("k") == 7)
    got = [(r.k, r.stratum) for r in a.collect()]
    assert len(got) == 14 == len({k for k, _ in got}) and (7, "risk") in got and sum(s == "fill" for _, s in got) == 3
    assert sorted(got) == sorted((r.k, r.stratum) for r in L.stratified(df.repartition(7), "k", [("even", F.col("g") == "a", 5), ("small", F.col("k") < 20, 5)], 14, 3, F.col("k") == 7).collect())


def test_sinks(spark, tmp_path):
    df = rows(spark, "title string, n int", ("b|x", 1), ("a", 2), ("ä", None))
    K.write_sorted_json(df, str(tmp_path / "j"))
    assert [r.title for r in spark.read.json(str(tmp_path / "j")).collect()] and spark.read.json(str(tmp_path / "j")).count() == 3
    K.write_json_object(df, str(tmp_path / "o"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "o").glob("part-*")))
    assert list(json.loads(text)) == ["a", "b|x", "ä"] and json.loads(text)["a"]["n"] == 2
    for k in (1, 2):
        K.swap_in(df.limit(k), str(tmp_path / "t"))
        assert spark.read.parquet(str(tmp_path / "t")).count() == k
    assert sorted(p.name for p in tmp_path.iterdir()) == ["j", "o", "t"]
    assert [r.value for r in K.markdown_table(df, ["title", "n"], "H").collect()][1:] == ["| a | 2 |", "| b\\|x | 1 |", "| ä |  |"]
    old, new = rows(spark, "title string, r string", ("Text to SQL", "old")), rows(spark, "title string, r string", ("text2sql", "new"), ("other", "new"), ("别", "new"))
    assert {(r.title, r.r) for r in K.extend_prune_report(old, new).collect()} == {("Text to SQL", "old"), ("other", "new")}
    assert json.loads(K.report(df, "rows", count=F.count("*")).first().value)["summary"] == {"count": 3}
    assert K.key_values({"a": "1"}) == "a=1\n"


def test_streams_agree_with_batch(spark, tmp_path):
    events = rows(spark, "k string, at timestamp, v int", *[(f"k{i % 3}", dt.datetime(2024, 1, 1, i // 4, tzinfo=dt.UTC) + dt.timedelta(minutes=i), i) for i in range(40)])
    events.repartition(4).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "e"))
    q = states.latest_states(stream, ["k"], "at").writeStream.outputMode("complete").format("memory").queryName("latest").trigger(availableNow=True).start()
    q.awaitTermination(120)
    key = lambda r: (r.k, r.at, r.v)
    assert sorted(map(key, spark.table("latest").collect())) == sorted(map(key, I.latest(events, ["k"], "at").collect()))
    q = states.window_counts(stream, "at", "k", late="100 days").writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("counts").agg(F.sum("n")).first()[0] == 40


def test_requests_are_repeated():
    waits, answers = [], [(429, b""), (503, b""), (200, b"ok")]
    assert I.with_retries(lambda: answers.pop(0), sleep=waits.append) == b"ok" and waits == [1, 2]
    with pytest.raises(ValueError, match="404"):
        I.with_retries(lambda: (404, b""), sleep=waits.append)
    with pytest.raises(ValueError, match="500"):
        I.with_retries(lambda: (500, b""), sleep=waits.append)

    def down():
        raise TimeoutError

    with pytest.raises(TimeoutError):
        I.with_retries(down, attempts=2, sleep=waits.append)
    assert len(waits) == 2 + 3 + 1


def test_retries(spark):
    assert I.retry_delays() == [1, 2, 4] and I.retry_delays(8)[-1] == 30
    got = rows(spark, "s int", (429,), (500,), (599,), (404,), (200,)).select(I.retryable(F.col("s"))).collect()
    assert [r[0] for r in got] == [True, True, True, False, False]


def test_contained_titles_of_a_long_list(spark):
    left = spark.createDataFrame([(1, "One  Title 10004 and more"), (2, "title 7"), (3, ""), (4, None), (5, "nothing")], "i int, a string")
    right = spark.range(20_005).select("id", F.concat(F.lit("Title "), "id", F.lit(" and")).alias("b"))
    got = {(r.i, r.id) for r in J.contained_titles(left, right, "a", "b").collect()}
    assert got == {(1, 10_004)} | {(2, n) for n in range(20_005) if str(n).startswith("7")}
    few = right.where("id < 100")
    assert {(r.i, r.id) for r in J.contained_titles(left, few, "a", "b").collect()} == {(i, n) for i, n in got if n < 100}
