"""Sources, list pages and sinks as queries: parts are rendered as files of each format, BLOCK rows to
a file, and read back; the SQL states the rows directly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow import sinks
from corpusflow.operators import incremental
from corpusflow.plans.registry import query
from corpusflow.session import new_path
from corpusflow.sources import pages as G
from corpusflow.sources import records as R

BLOCK = 40
#: What every rendered part says: its block and place, a title with a reference and a tag in it, two authors.
PART_SQL = f"""
WITH p AS (SELECT p_partkey AS k, p_partkey // {BLOCK} AS b, row_number() OVER (PARTITION BY p_partkey // {BLOCK} ORDER BY p_partkey) - 1 AS pos, p_size AS size,
  'On the ' || p_name || ' & its number ' || p_partkey AS title, 'Ann ' || p_type || ' and Bob ' || replace(p_brand, '#', '') AS authors FROM part)
"""


def parts(read) -> DataFrame:
    """(k, b, t, tp, a, size): key, block, title in markup and plain, authors in markup and plain."""
    rows = read("part")
    plain = F.concat(F.lit("On the "), "p_name", F.lit(" & its number "), "p_partkey")
    markup = F.concat(F.lit("On the <i>"), "p_name", F.lit("</i> &amp; its number "), "p_partkey")
    authors = F.concat(F.lit("Ann "), "p_type", F.lit(" and Bob "), F.replace("p_brand", F.lit("#"), F.lit("")))
    # Whole numbers are divided as such: by way of doubles large keys came to other blocks.
    return rows.select(F.col("p_partkey").alias("k"), F.expr(f"p_partkey div {BLOCK}").alias("b"), plain.alias("tp"), markup.alias("t"), authors.alias("a"), F.col("p_size").alias("size"), F.col("p_type").alias("one"), F.replace("p_brand", F.lit("#"), F.lit("")).alias("two"))


def files(rows: DataFrame, item: Column, head: str = "", tail: str = "", between: str = "") -> DataFrame:
    """(b, content): a file for each block of at most BLOCK rows, its items in order of their keys."""
    own = rows.groupBy("b").agg(F.array_sort(F.collect_list(F.struct("k", item.alias("i")))).alias("l"))
    return own.select("b", F.concat(F.lit(head), F.array_join("l.i", between), F.lit(tail)).alias("content"))


def cat(*parts_: Column | str) -> Column:
    """Strings are literals, but for names of columns that start with a dollar sign."""
    return F.concat(*[F.col(p[1:]) if isinstance(p, str) and p.startswith("$") else F.lit(p) if isinstance(p, str) else p for p in parts_])


#: For every extractor: what stands before the items, an item, what stands after them.
PAGES: dict[str, tuple[str, Column, str]] = {}


def _pages() -> dict[str, tuple[str, Column, str]]:
    if not PAGES:
        PAGES.update({
            "numbered_lines": ("<p>Accepted Research Papers for ICDE 2024</p>", cat("<p>", (F.col("k") % 900 + 1).cast("string"), "</p><p>", "$t", "</p><p>Ann ", "$one", " (X)</p><p>and Bob ", "$two", "</p>"), "<p>© IEEE 2024</p><p>7</p><p>Not a paper of the list</p>"),
            "anthology": ("", cat('<p class="d-sm-flex a"><strong><a href="x">', "$t", "</a></strong><br><em>", "$a", "</em></p>"), ""),
            "adjacent": ("", cat('<div class="paper_wrapper"> <div class="title">', "$t", '</div>\n<div class="authors">', "$a", "</div></div>"), ""),
            "full_papers": ('<h2 id="full-papers">Full</h2><ul>', cat('<li class="accepted-paper-item"><span class="accepted-paper-title">', "$t", '</span> <span class="accepted-paper-author">', "$a", "</span></li>"), '</ul><h2 id="short-papers">Short</h2><li class="accepted-paper-item"><span class="accepted-paper-title">A short paper</span></li>'),
            "numbered_items": ("<ul>", cat("<li>(", "$k", ") ", "$t", " — ", "$a", "</li>"), "</ul>"),
            "table_pairs": ("<table>", cat("<tr><td><strong>", "$t", "</strong> https://doi.org/10.1145/", "$k", ".</td></tr><tr><td>", "$a", "</td></tr>"), "</table>"),
            "schedule": ("<p>Research Track Papers Schedule</p><p>Monday, August 3</p><p>Session chair: X (Y)</p>", cat("<p>", "$t", "</p><p>Ann ", "$one", " (X); Bob ", "$two", " (Y)</p>"), ""),
            "programme": ('<body id="track"><table>', cat('<tr><td>9:00</td><td><div class="prog-track">Research  Track</div><strong><a href="/p/', "$k", '">', "$t", '<span>x</span></a></strong><div class="performers"><a>Ann ', "$one", "</a>, <a>Bob ", "$two", "</a></div></td></tr>"), '<tr><td><div class="prog-track">Demos</div><strong><a>A demonstration</a></strong></td></tr></table>'),
            "virtual_site": ('<noscript class="noscript"><ul>', cat('<li><a href="/virtual/2024/poster/', "$k", '">', "$t", "</a></li>"), "</ul></noscript>"),
            "proceedings": ("", cat('<div class="paper"><p class="title">', "$t", '</p><p class="details">', "$a", '</p><a href="v', "$k", '.html">abs</a></div>'), ""),
            "rows": ("<table><tr><th>No</th><th>Paper title</th><th>Authors</th></tr>", cat("<tr><td>", "$k", "</td><td>", "$t", "</td><td>", "$a", "</td></tr>"), "</table>"),
            "items": ("<ul><li>Accepted demos of the year</li>", cat("<li><b>", "$t", "</b> ", "$a", "</li>"), "</ul>"),
            "piped_lines": ("", cat("<p>", "$k", " | ", "$t", "</p><p>", "$a", "</p>"), ""),
            "links": ("", cat('<a href="/papers/', "$k", '">', "$t", "</a> ", "$a", F.lit(" " * 600)), ""),
            "headings": ("<h1>List</h1>", cat("<h3>", "$t", "</h3>", "$a"), ""),
        })
    return PAGES


#: What the extractors give besides title and authors, in SQL: link and DOI.
LINKS_SQL = {"programme": "'/p/' || k", "virtual_site": "'/virtual/2024/poster/' || k", "proceedings": "'v' || k || '.html'", "links": "'/papers/' || k"}
KINDS = ["numbered_lines", "anthology", "adjacent", "full_papers", "numbered_items", "table_pairs", "schedule", "programme", "virtual_site", "proceedings", "rows", "items", "piped_lines", "links", "headings"]


def entry_sql(kind: str) -> str:
    authors = "''" if kind == "virtual_site" else "authors"
    return f"title, {authors} AS authors, {LINKS_SQL.get(kind, chr(39) * 2)} AS href, {'10.1145/'.join([chr(39)] * 2) + ' || k' if kind == 'table_pairs' else chr(39) * 2} AS doi"


def list_pages(read, kind: str) -> DataFrame:
    """(path, content): list pages of one kind."""
    head, item, tail = _pages()[kind]
    return files(parts(read), item, head, tail).select(F.col("b").cast("string").alias("path"), "content")


def _register(kind: str) -> None:
    def run(read) -> DataFrame:
        out = G.candidates(list_pages(read, kind), [kind])
        return out.select("path", F.col("pos").cast("long").alias("pos"), "title", "authors", "href", "doi")

    run.__name__, run.__doc__ = f"pages_{kind}", f"Entries of pages by the extractor {kind}."
    query(f"{PART_SQL} SELECT b::VARCHAR AS path, pos, {entry_sql(kind)} FROM p")(run)


for _kind in KINDS:
    _register(_kind)


@query(f"{PART_SQL} " + " UNION ALL ".join(f"SELECT b::VARCHAR AS path, '{kind}' AS extractor, pos, {entry_sql(kind)} FROM p WHERE b % {len(KINDS)} = {i}" for i, kind in enumerate(KINDS)))
def extractor_cascade(read):
    """Entries of pages of all kinds, the kinds taking turns, by the cascade of extractors. Every part is on one page."""
    rows, out = parts(read), None
    for i, kind in enumerate(KINDS):
        head, item, tail = _pages()[kind]
        own = files(rows.where(F.col("b") % len(KINDS) == i), item, head, tail)
        out = own if out is None else out.union(own)
    found = G.accepted(out.select(F.col("b").cast("string").alias("path"), "content"))
    return found.select("path", "extractor", F.col("pos").cast("long").alias("pos"), "title", "authors", "href", "doi")


@query(f"SELECT (p_partkey // {BLOCK})::VARCHAR AS path, count(DISTINCT p_name) AS parsed_entries, CASE WHEN count(DISTINCT p_name) >= 25 THEN 'complete' ELSE 'empty' END AS status FROM part GROUP BY 1")
def min_entries_gate(read):
    """Pages of names that repeat: a page of fewer than 25 different ones counts as empty."""
    rows = read("part").select(F.col("p_partkey").alias("k"), F.floor(F.col("p_partkey") / BLOCK).alias("b"), "p_name")
    pages = files(rows, cat("<li>The ", "$p_name", "<br>A B</li>"), "<ul>", "</ul>").select(F.col("b").cast("string").alias("path"), "content")
    return G.few_entries(pages, G.accepted(pages), 25)


@query(f"{PART_SQL} SELECT b::VARCHAR AS path, pos, title, 'Ann and Bob' AS authors FROM p")
def pages_plain_rule(read):
    """The plain rule of one site: rows of three cells, names not split at commas."""
    pages = files(parts(read), cat("<tr><td>", "$k", "</td><td>", "$t", "</td><td>Ann; Bob (X)</td></tr>"), "<main><h1>Accepted Papers</h1><table>", "</table></main>")
    out = G.accepted_by_rows(pages.select(F.col("b").cast("string").alias("path"), "content"))
    return out.select("path", F.col("pos").cast("long").alias("pos"), "title", "authors")


@query(f"{PART_SQL} SELECT b::VARCHAR AS path, lower('ICDE') || '-official-2024-' || left(trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-'), 80) AS key, title, authors AS author, 'https://c.org/a/v' || k || '.html' AS url FROM p")
def pages_records(read):
    """Entries as records: relative links are joined to the page's address."""
    found = G.candidates(list_pages(read, "proceedings"), ["proceedings"])
    entries = found.withColumns({"venue": F.lit("ICDE"), "year": F.lit(2024), "url": F.lit("https://c.org/a/list.html?x")})
    # papers() gives records only, so the page goes in by the DOI, which these entries lack.
    out = G.papers(entries.withColumn("doi", F.col("path")))
    return out.select(F.col("doi").alias("path"), "key", "title", "author", "url")


@query("SELECT s_suppkey, s_suppkey % 3 AS wanted FROM supplier WHERE s_nationkey >= 5 AND s_nationkey <= 20 AND s_suppkey % 3 = 1")
def pages_selected(read):
    """Pages to read, by venue in any case and year."""
    configs = read("supplier").select("s_suppkey", F.get(F.array(F.lit("ICDE"), F.lit("Kdd"), F.lit("VLDB")), (F.col("s_suppkey") % 3).cast("int")).alias("venue"), F.col("s_nationkey").alias("year"))
    return G.selected(configs, [" kdd ", ""], (5, 20)).select("s_suppkey", (F.col("s_suppkey") % 3).alias("wanted"))


@query(f"{PART_SQL} SELECT k, CASE k % 4 WHEN 0 THEN title WHEN 1 THEN title WHEN 2 THEN 'Block ' || k ELSE '' END AS abstract, CASE k % 4 WHEN 0 THEN authors ELSE '' END AS names FROM p")
def page_metadata(read):
    """Abstracts and authors of papers' own pages: in meta elements, in blocks, or not at all."""
    kinds = [
        cat('<meta name="citation_abstract" content="', F.regexp_replace("t", "</?i>", ""), '"><script type="application/ld+json">{"author":[{"name":"Ann ', "$one", '"},{"name":"Bob ', "$two", '"}]}</script>'),
        cat('<div class="acl-abstract"><h5>Abstract</h5><span>', "$t", "</span></div>"),
        cat('<div id="abstract"><style>p{}</style><b>Block</b> ', "$k", "</div>"),
        F.lit("<p>nothing</p>"),
    ]
    page = F.get(F.array(*kinds), (F.col("k") % 4).cast("int"))
    return parts(read).select("k", G.page_abstract(page).alias("abstract"), G.page_authors(page).alias("names"))


@query(f"{PART_SQL} SELECT k, CASE WHEN k % 2 = 0 THEN trim(repeat(title || ' word' || ' ', 4)) ELSE '' END AS abstract FROM p")
def page_pdf_abstract(read):
    """Abstracts in the text of PDFs, from the heading to the next one; short ones don't count."""
    own = F.repeat(cat("$tp", " wo-\nrd "), F.when(F.col("k") % 2 == 0, 4).otherwise(1))
    return parts(read).select("k", G.pdf_abstract(cat("Title\nAbstract. ", own, "\n 1 Introduction\nText"), 30).alias("abstract"))


# Records.

YEARS_SQL = "(2020 + b % 5)::VARCHAR"


def raw_files(rows: DataFrame, item: Column, stem: str, end: str, head: str = "", tail: str = "", between: str = "") -> DataFrame:
    """(path, content): a raw file of a block, in a folder of its year. Numbers of blocks have a letter before them: 2024 alone would be a year."""
    own = files(rows, item, head, tail, between)
    year = (F.col("b") % 5 + 2020).cast("string")
    return own.select(F.concat(F.lit("/raw/b"), "b", F.lit("/"), year, F.lit(f"/{stem}"), year, F.lit(end)).alias("path"), "content")


def at(path: str = "path") -> Column:
    """The block in a raw file's path."""
    return F.regexp_extract(path, r"^/raw/b(-?\d+)/", 1).cast("long").alias("b")


def entry_json() -> Column:
    return F.to_json(F.struct(F.col("tp").alias("title"), F.col("a").alias("author"), F.when(F.col("size") > 25, F.concat(F.lit("10.1/"), "k")).alias("doi"), F.concat(F.lit(" About\n"), "size").alias("abstract")))


JSON_SQL = f"{PART_SQL} SELECT b, pos, title, authors AS author, {YEARS_SQL} AS year, 'VLDB' || {YEARS_SQL} AS venue, CASE WHEN size > 25 THEN '10.1/' || k ELSE '' END AS doi, CASE WHEN size > 25 THEN 'https://doi.org/10.1/' || k ELSE '' END AS url, 'About ' || size AS abstract FROM p"


@query(JSON_SQL)
def source_json_lists(read):
    """JSON files that are lists of records."""
    out = R.parse_json(raw_files(parts(read), entry_json(), "VLDB", ".json", "[", "]", ","))
    return out.select(at(), "pos", "title", "author", "year", "venue", "doi", "url", "abstract")


@query(JSON_SQL)
def source_json_maps(read):
    """JSON files that are one object of titles to records; what is no object in it has no row."""
    item = F.concat(F.regexp_replace(F.to_json(F.array("tp")), r"(?s)^\[(.*)\]$", "$1"), F.lit(":"), entry_json())
    out = R.parse_json(raw_files(parts(read), item, "VLDB", ".json", "{", ',"none": 5}', ","))
    return out.select(at(), "pos", "title", "author", "year", "venue", "doi", "url", "abstract")


@query(f"{PART_SQL} SELECT b, pos, 'ARTICLE' AS type, 'k' || k AS key, title, authors AS author, CASE WHEN size > 25 THEN '1999' ELSE {YEARS_SQL} END AS year, 'VLDB' || {YEARS_SQL} AS venue FROM p")
def source_bib(read):
    """BibTeX files: values in braces or quotation marks, the latter counting more."""
    year = F.when(F.col("size") > 25, ",\n year={1999}").otherwise("")
    item = cat("@article{k", "$k", ",\n title={On the {x} wrong one}, title = \"", "$tp", "\",\n author={{", "$a", "}}", year, "}")
    out = R.parse_bib(raw_files(parts(read), item, "VLDB", ".bib", "", "\n@junk", "\n"))
    return out.select(at(), "pos", "type", "key", "title", "author", "year", "venue")


@query(f"{PART_SQL} SELECT title, authors AS author, '' AS doi, 'Two lines, \"' || size || '\"' AS abstract, '' AS year FROM p")
def source_csv(read):
    """CSV files with a header in any case, written to the shared folder and read back: an empty cell is not a missing column."""
    rows = parts(read)
    path = new_path(rows.sparkSession, "csv")
    named = rows.select(F.col("tp").alias("Title"), F.col("a").alias("AUTHOR"), F.concat(F.lit("Two\nlines, \""), "size", F.lit('"')).alias("Abstract"), F.lit("").alias("year"))
    named.write.option("header", "true").option("escape", '"').option("quoteAll", "true").option("emptyValue", "").csv(path)
    return R.read_csv(rows.sparkSession, path).select("title", "author", "doi", "abstract", "year")


@query("SELECT n_nationkey AS pos, n_name AS title, 'R' || n_regionkey AS author FROM nation UNION ALL SELECT r_regionkey + 100, r_name, 'region' FROM region")
def source_folder(read):
    """All files below a folder, by extension: JSON files, one record each, written to the shared folder."""
    n, r = read("nation"), read("region")
    path = new_path(n.sparkSession, "folder")
    record = lambda title, author, key: F.struct(F.struct(title.alias("title"), author.alias("author"), key.cast("string").alias("key")).alias("record"))
    n.select(record(F.col("n_name"), F.concat(F.lit("R"), "n_regionkey"), F.col("n_nationkey")).alias("x")).select("x.*").write.option("maxRecordsPerFile", 1).json(f"{path}/2024/a")
    r.select(record(F.col("r_name"), F.lit("region"), F.col("r_regionkey") + 100).alias("x")).select("x.*").write.option("maxRecordsPerFile", 1).json(f"{path}/2024/b")
    return R.parse_files(n.sparkSession, path).select(F.col("key").cast("int").alias("pos"), "title", "author")


@query(f"{PART_SQL} SELECT b, title, 'Abstract ' || k AS abstract, 'https://aclanthology.org/' || k AS url FROM p WHERE size > 25")
def source_acl_html(read):
    """Pages of titles and abstracts: each title takes the first abstract before the next title; those without go."""
    item = cat("<strong><a class=align-middle href=/", "$k", ">", "$t", "</a></strong>", F.when(F.col("size") > 25, cat('<div class="card-body p-3 small">Abstract ', "$k", "</div>")).otherwise(""), '<div class="other">x</div>')
    return R.parse_html(raw_files(parts(read), item, "ACL", ".html")).select(at(), "title", "abstract", "url")


@query(f"{PART_SQL} SELECT b, pos, title, '/p/' || k AS url, {YEARS_SQL} AS year FROM p")
def source_ndss_html(read):
    """Pages of the other format, known by its marks."""
    item = cat('<h3 class="blog-post-title">', "$t", '</h3><p>x</p><a class="paper-link-abs" href="/p/', "$k", '">More</a>')
    return R.parse_html(raw_files(parts(read), item, "NDSS", ".html", "<p>NDSS Symposium</p>")).select(at(), "pos", "title", "url", "year")


@query("""
WITH a AS (SELECT p_name AS title, p_partkey // 40 AS f, p_partkey AS pos, p_brand AS key FROM part)
SELECT title, arg_max(key, (f, pos)) AS key, min(f) AS f FROM a GROUP BY title""")
def combined_files(read):
    """Of records of several files with one title that of the last file, in the place of the first."""
    rows = read("part").select(F.lpad(F.floor(F.col("p_partkey") / BLOCK).cast("string"), 12, "0").alias("path"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("title"), F.col("p_brand").alias("key"))
    return R.combine_accepted(rows).select("title", "key", F.col("path").cast("long").alias("f"))


@query(f"{PART_SQL} SELECT b, title, authors AS author, 'ICDE' AS booktitle, '10.1/' || k AS doi, 'https://doi.org/10.1/' || k AS url FROM p WHERE size <= 25")
def source_dblp_xml(read):
    """Publications in XML with markup in titles; those of another year go, those without a year stay."""
    year = F.when(F.col("size") > 25, "<year>1990</year>").when(F.col("size") > 12, "<year>2024</year>").otherwise("")
    item = cat('<r><inproceedings key="c/', "$k", '"><author>Ann ', "$one", "</author><author>Bob ", "$two", "</author><title>", "$t", "</title>", year, "<booktitle>ICDE</booktitle><doi>10.1/", "$k", "</doi></inproceedings></r>")
    pages = files(parts(read), item, "<bht>", "</bht>").select(F.concat(F.lit("/raw/b"), "b", F.lit("/x")).alias("path"), "content", F.lit("ICDE").alias("venue"), F.lit("2024").alias("year"), F.lit("DB").alias("track"))
    return R.parse_dblp(pages).select(at(), "title", "author", "booktitle", "doi", "url")


@query(f"{PART_SQL} SELECT b, pos, title, 'About ' || size AS abstract, authors AS author, '2023' AS year, 'http://l/' || k AS url, 'v' || k AS key FROM p")
def source_atom(read):
    """Entries of an Atom feed: the first alternate link counts."""
    item = cat("<entry><id>http://arxiv.org/abs/v", "$k", "</id><title>", F.regexp_replace("t", "</?i>", ""), "</title><summary> About\n", F.col("size").cast("string"), "</summary><published>2023-01-02T</published><author><name>Ann ", "$one", "</name></author><author><name>Bob ", "$two", '</name></author><link href="x" rel="self"/><link href="http://l/', "$k", '" rel="alternate"/></entry>')
    pages = files(parts(read), item, "<feed>", "</feed>").select(F.concat(F.lit("/raw/b"), "b", F.lit("/x")).alias("path"), "content")
    return R.parse_atom(pages).select(at(), "pos", "title", "abstract", "author", "year", "url", "key")


def api_pages(read, item: Column, name: str) -> DataFrame:
    return files(parts(read), item, f'{{"{name}":[', "]}", ",").select(F.concat(F.lit("/raw/b"), "b", F.lit("/x")).alias("path"), "content")


@query(f"{PART_SQL} SELECT b, pos, title, 'b a b' AS abstract, authors AS author, '10.1234/' || k AS doi, 'W' || k AS openalex_id, '2024' AS year, 'S' AS source FROM p")
def source_works(read):
    """Pages of an API of works: nested fields, abstracts as inverted indexes."""
    person = lambda c, name: F.struct(F.struct(F.concat(F.lit(name), c).alias("display_name")).alias("author"))
    work = F.struct(
        F.concat(F.lit("W"), "k").alias("id"), F.concat(F.lit("https://doi.org/10.1234/"), "k").alias("doi"), F.col("tp").alias("display_name"), F.lit(2024).alias("publication_year"), F.lit("article").alias("type"),
        F.create_map(F.lit("a"), F.array(F.lit(1)), F.lit("b"), F.array(F.lit(0), F.lit(2))).alias("abstract_inverted_index"), F.array(person("one", "Ann "), person("two", "Bob ")).alias("authorships"),
        F.struct(F.struct(F.lit("S").alias("display_name")).alias("source")).alias("primary_location"),
    )
    return R.parse_works(api_pages(read, F.to_json(work), "results")).select(at(), "pos", "title", "abstract", "author", "doi", "openalex_id", "year", "source")


@query(f"{PART_SQL} SELECT b, pos, title, 'About ' || size AS abstract, authors AS author, 'https://doi.org/10.1234/' || k AS url, 's' || k AS semantic_scholar_id FROM p WHERE size > 25")
def source_s2(read):
    """Pages of the other API: papers without an abstract go."""
    person = lambda c, name: F.struct(F.concat(F.lit(name), c).alias("name"))
    paper = F.struct(F.concat(F.lit("s"), "k").alias("paperId"), F.col("tp").alias("title"), F.when(F.col("size") > 25, F.concat(F.lit("About "), "size")).alias("abstract"), F.struct(F.concat(F.lit("10.1234/"), "k").alias("DOI")).alias("externalIds"), F.array(person("one", "Ann "), person("two", "Bob ")).alias("authors"))
    return R.parse_s2(api_pages(read, F.to_json(paper), "data")).select(at(), "pos", "title", "abstract", "author", "url", "semantic_scholar_id")


@query("""
WITH s AS (SELECT o_custkey AS k, o_orderstatus AS st, o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS r FROM orders),
b AS (SELECT k, min(r) AS best FROM s GROUP BY k)
SELECT s.k, s.id, s.st FROM s JOIN b USING (k) WHERE s.r = b.best OR s.k < 100""")
def source_cascade(read):
    """For each customer the orders of the first status that has any; for some, those of all."""
    o = read("orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("st"))
    return R.cascade({s: o.where(F.col("st") == s) for s in ("F", "O")} | {"P": o.where("st NOT IN ('F', 'O')")}, ["k"], F.col("k") < 100)


@query("SELECT c_custkey, 'https://dblp.org/db/journals/tkde/tkde' || (2020 + c_nationkey - 1988) || '.xml' AS volume, ['https://d.org/db/x' || (2020 + c_nationkey) || '.xml', 'https://d.org/conf/v/y' || (2020 + c_nationkey) || '-1.xml'] AS links FROM customer")
def source_links(read):
    """A journal's volume of a year, and the links of an index page that hold the year, each once."""
    year = (F.col("c_nationkey") + 2020).cast("string")
    content = F.concat(F.lit('<a href="/db/x'), year, F.lit('.html"><a href="y'), year, F.lit('-1.html"><a href="/db/x'), year, F.lit('.html"><a href="z1999.html"><a href="/db/x'), year, F.lit('.pdf">'))
    return read("customer").select("c_custkey", R.volume_link(F.lit("tkde"), F.col("c_nationkey") + 2020).alias("volume"), R.year_links(content, year, F.lit("https://d.org/conf/v/index.html")).alias("links"))


@query(f"""
WITH w AS (SELECT p_partkey AS k, p_partkey // {10 * BLOCK} AS source, p_partkey // {BLOCK} % 10 AS page FROM part),
x AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k) - 1 AS place, row_number() OVER (PARTITION BY source, page ORDER BY k) - 1 AS pos FROM w WHERE page <= 6)
SELECT source, page, pos, 'W' || k AS id FROM x WHERE place < 250""")
def source_paged(read):
    """Pages of a crawl by cursor: it ends with the page that names no next one, and takes 250 items of a source at most."""
    rows = parts(read)
    own = rows.groupBy("b").agg(F.array_sort(F.collect_list(F.struct("k"))).alias("l"))
    cursor = F.when(F.col("b") % 10 == 6, F.lit(None)).otherwise(F.concat(F.lit("c"), "b"))
    content = F.to_json(F.struct(F.transform("l", lambda x: F.struct(F.concat(F.lit("W"), x["k"]).alias("id"))).alias("results"), F.struct(cursor.alias("next_cursor")).alias("meta")))
    responses = own.select(F.floor(F.col("b") / 10).alias("source"), (F.col("b") % 10).alias("page"), content.alias("content"))
    return R.paged(responses, 250, needed=True).select("source", "page", "pos", F.get_json_object("item", "$.id").alias("id"))


@query(f"{PART_SQL} SELECT b, title AS raw_title, 'VLDB' AS target, {YEARS_SQL} AS year, pos AS ord FROM p WHERE b % 2 = 0")
def source_evidence(read):
    """What raw files prove: those of a known venue that are one object; lists and other venues prove nothing."""
    item = F.concat(F.regexp_replace(F.to_json(F.array("tp")), r"(?s)^\[(.*)\]$", "$1"), F.lit(":"), entry_json())
    rows = parts(read)
    mapped = raw_files(rows.where(F.col("b") % 2 == 0), item, "VLDB", ".json", "{", "}", ",")
    listed = raw_files(rows.where(F.col("b") % 4 == 1), entry_json(), "VLDB", ".json", "[", "]", ",")
    other = raw_files(rows.where(F.col("b") % 4 == 3), item, "Nowhere", ".json", "{", "}", ",")
    return R.raw_evidence(mapped.union(listed).union(other)).select(at(), "raw_title", "target", "year", "ord")


@query("SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region")
def source_union(read):
    """The rows of all volumes, one of which is empty."""
    n, r = read("nation").select(F.col("n_name").alias("name")), read("region").select(F.col("r_name").alias("name"))
    return R.union_of([n, n.where("false"), r])


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey >= 0")
def source_baseline(read):
    """A collection that was written earlier, loaded as the baseline; one that isn't there is a warning."""
    rows = read("supplier")
    path = new_path(rows.sparkSession, "baseline")
    sinks.write_json_object(rows.select(F.col("s_name").alias("title"), F.col("s_suppkey").cast("string").alias("key")), f"{path}/text")
    whole = rows.sparkSession.read.text(f"{path}/text", wholetext=True)
    files = whole.select(F.lit("/raw/2024/VLDB2024.json").alias("path"), F.col("value").alias("content"))
    none, warning = R.load_baseline(rows.sparkSession, f"{path}/missing")
    known = R.parse_json(files).unionByName(none).where(F.lit(warning != ""))
    return known.select(F.col("key").cast("long").alias("s_suppkey"), F.col("title").alias("s_name"))


# Sinks: what was written is read back.


@query("SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_name || ' ' || lpad(p_partkey::VARCHAR, 12, '0')) - 1 AS place FROM part")
def sink_sorted_json(read):
    """Canonical JSON: over all files in order of their names, and within them, titles are in order."""
    rows = read("part").select("p_partkey", "p_name", F.concat("p_name", F.lit(" "), F.lpad(F.col("p_partkey").cast("string"), 12, "0")).alias("title"))
    path = new_path(rows.sparkSession, "sorted-json")
    sinks.write_sorted_json(rows, path)
    lines = rows.sparkSession.read.schema("p_partkey long, p_name string, title string").json(path).select("*", F.col("_metadata.file_name").alias("f"), F.col("_metadata.file_block_start").alias("s"), F.monotonically_increasing_id().alias("i"))
    # Large files are read in several pieces. A row's place is the number of rows in pieces before its own, by file and start, and before it in its piece.
    pieces = lines.groupBy("f", "s").agg(F.count("*").alias("n"), F.min("i").alias("i0"))
    earlier = F.struct("b.f", "b.s") < F.struct("a.f", "a.s")
    before = pieces.alias("a").join(F.broadcast(pieces).alias("b"), earlier, "left").groupBy("a.f", "a.s", "a.i0").agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    return lines.join(F.broadcast(before), ["f", "s"]).select("p_partkey", "p_name", (F.col("before") + F.col("i") - F.col("i0")).alias("place"))


@query("SELECT '| ' || replace(n_name, '_', '\\|') || ' | ' || n_regionkey || ' |' AS line FROM nation")
def sink_markdown(read):
    """Rows of a Markdown table; bars in cells are escaped."""
    rows = read("nation").select(F.translate("n_name", "_", "|").alias("name"), "n_regionkey")
    return sinks.markdown_table(rows, ["name", "n_regionkey"], "Nations").where("value NOT LIKE '#%'").select(F.col("value").alias("line"))


@query("SELECT count(*) AS n, sum(n_regionkey)::BIGINT AS regions, list(n_name ORDER BY n_name) AS names FROM nation")
def sink_report(read):
    """A report: one JSON text with a summary and the rows."""
    text = sinks.report(read("nation"), "rows", n=F.count("*"), regions=F.sum("n_regionkey"))
    parsed = text.select(F.from_json("value", "summary struct<n:long,regions:long>, rows array<struct<n_name:string>>").alias("r"))
    return parsed.select("r.summary.n", "r.summary.regions", F.array_sort("r.rows.n_name").alias("names"))


@query("SELECT 'nation ' || (n_nationkey % 10) AS title, CASE WHEN n_nationkey % 10 < 5 THEN 'region' ELSE 'nation' END AS origin FROM nation WHERE n_nationkey < 10")
def sink_prune_report(read):
    """A report that earlier rows open and new ones extend, the first of each title key."""
    old = read("region").select(F.concat(F.lit("nation "), "r_regionkey").alias("title"), F.lit("region").alias("origin"))
    new = read("nation").select(F.concat(F.lit("Nation "), (F.col("n_nationkey") % 10).cast("string")).alias("title"), F.lit("nation").alias("origin"))
    return sinks.extend_prune_report(old, new).select(F.lower("title").alias("title"), "origin")


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0")
def sink_swap(read):
    """A table rebuilt beside the old one and swapped in when it is whole."""
    rows = read("customer").select("c_custkey", "c_name", "c_acctbal")
    path = new_path(rows.sparkSession, "swapped")
    sinks.swap_in(rows, path)
    sinks.swap_in(rows.where("c_acctbal > 0").drop("c_acctbal"), path)
    return rows.sparkSession.read.parquet(path)


@query("SELECT o_orderkey::VARCHAR AS record_key, CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'complete' ELSE 'empty' END AS status, CASE o_orderstatus WHEN 'O' THEN '2024-01-02T03:04:05Z' ELSE '' END AS last_success_at, CASE o_orderstatus WHEN 'P' THEN 0 ELSE o_custkey + 1 END AS record_count FROM orders")
def fetch_outcomes(read):
    """States of fetches: complete with rows, empty without, failed with an error."""
    rows = read("orders").select(F.col("o_orderkey").cast("string").alias("record_key"), F.lit("p").alias("path"), F.when(F.col("o_orderstatus") == "P", 0).otherwise(F.col("o_custkey") + 1).alias("rows"), F.lit("h").alias("sha256"), F.when(F.col("o_orderstatus") == "F", "boom").alias("error"))
    return incremental.outcomes(rows, F.lit("2024-01-02T03:04:05Z").cast("timestamp")).select("record_key", "status", "last_success_at", "record_count")
