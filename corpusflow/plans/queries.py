"""Every operator as a query over the test tables, with DuckDB SQL for the same rows.

Rule and alias packs are parameters of the operators, so packs of words that these tables
hold make the queries tell something; their SQL is generated from the same packs in the other dialect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow import packs
from corpusflow.functions import rules
from corpusflow.functions import text as X
from corpusflow.functions import venues as V
from corpusflow.operators import buckets, facets, gates, incremental, joins, merge, sampling
from corpusflow.packs import FIXTURE_TOPICS, VenuePack
from corpusflow.plans.registry import query
from corpusflow.session import drop_at_exit, new_path, ship
from corpusflow.sources import pages as G
from corpusflow.sources import records as R

# SQL of the term and alias rules, for the other engine.

SQL_LOW = "regexp_replace(lower(coalesce({0}, '')), '\\s+', ' ', 'g')"


def sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_any(c: str, terms: list[str]) -> str:
    out = []
    for t in terms:
        out.append(f"regexp_matches({c}, '(^|[^a-z0-9]){t}($|[^a-z0-9])')" if rules.WORD.fullmatch(t) else f"contains({c}, {sql_text(t)})")
    return "(" + " OR ".join(out or ["false"]) + ")"


def sql_labels(c: str, pack: packs.LabelPack) -> str:
    hit = {label: sql_any(c, terms) for label, terms in pack.terms.items()}
    for label, terms, as_terms in pack.also:
        more = sql_any(c, terms) if as_terms else "(" + " OR ".join(f"contains({c}, {sql_text(t)})" for t in terms) + ")"
        hit[label] = f"({hit[label]} OR {more})" if label in hit else more
    parts = []
    for parent, children in pack.taxonomy.items():
        parts.append(f"CASE WHEN {' OR '.join(hit.get(x, 'false') for x in (parent, *children))} THEN {sql_text(parent)} END")
        parts += [f"CASE WHEN {hit.get(x, 'false')} THEN {sql_text(x)} END" for x in children]
    listed = f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"
    return f"CASE WHEN len({listed}) = 0 THEN [{', '.join(map(sql_text, pack.default))}] ELSE {listed} END"


def sql_alias(c: str, aliases: dict[str, list[str]]) -> str:
    ordered = sorted(((a, n) for n, own in aliases.items() for a in own), key=lambda x: -len(x[0]))
    whens = " ".join(f"WHEN {f'regexp_matches({c}, {sql_text(f'(^|[^a-z0-9]){a}($|[^a-z0-9])')})' if V.SHORT.fullmatch(a) else f'contains({c}, {sql_text(a)})'} THEN {sql_text(n)}" for a, n in ordered)
    return f"CASE {whens} ELSE '' END"


# Text.


@query("SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS squashed FROM documents")
def text_squash(read):
    return read("documents").select("doc_id", F.md5(X.squash("text").cast("binary")).alias("squashed"))


@query("SELECT doc_id, md5(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS lowered FROM documents")
def text_lowered(read):
    return read("documents").select("doc_id", F.md5(X.lowered("text").cast("binary")).alias("lowered"))


WORDS_SQL = "array_to_string(regexp_extract_all(lower(replace({0}, 'ß', 'ss')), '[a-z0-9]+'), ' ')"
KEY_SQL, FIRST_SQL = WORDS_SQL.format("text"), WORDS_SQL.format("split_part(text, chr(10), 1)")


@query(f"SELECT doc_id, md5({KEY_SQL}) AS k FROM documents")
def text_title_key(read):
    """The entity key of whole texts, as a digest."""
    return read("documents").select("doc_id", F.md5(X.title_key("text").cast("binary")).alias("k"))


@query(f"SELECT md5(k) AS k, count(*) AS n FROM (SELECT {KEY_SQL} AS k FROM documents) GROUP BY k HAVING count(*) > 1")
def duplicate_keys(read):
    rows = read("documents").select(F.md5(X.title_key("text", True).cast("binary")).alias("k"))
    return rows.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")


@query(f"SELECT count(DISTINCT k) AS unique_keys, count(*) AS documents FROM (SELECT {KEY_SQL} AS k FROM documents)")
def unique_keys(read):
    rows = read("documents").select(F.md5(X.title_key("text", True).cast("binary")).alias("k"))
    return rows.agg(F.countDistinct("k").alias("unique_keys"), F.count("*").alias("documents"))


@query("SELECT p_partkey, left(trim(regexp_replace(lower(p_name || ' / ' || p_type), '[^a-z0-9]+', '-', 'g'), '-'), 80) AS slug FROM part")
def text_slug(read):
    return read("part").select("p_partkey", X.slug(F.concat_ws(" / ", "p_name", "p_type")).alias("slug"))


@query(
    "SELECT item_id, array_to_string(list_filter(list_transform(string_split_regex(replace(regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '\\([^)]*\\)', '', 'g'), '*', ''), ';|\\band\\b|,'), lambda p: trim(p, ' ,\"')), lambda p: p <> ''), ' and ') AS names FROM benchmark"
)
def text_authors(read):
    return read("benchmark").select("item_id", X.listed_authors("text").alias("names"))


@query("SELECT doc_id, '10.1234/' || source || '.' || doc_id AS doi FROM documents")
def text_doi(read):
    link = F.concat(F.lit(" https://dx.doi.org/10.1234%2F"), "source", F.lit("."), "doc_id", F.lit(").; "))
    return read("documents").select("doc_id", X.doi(link, decode=True).alias("doi"))


@query("SELECT page_id, md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')) AS escaped FROM pages")
def text_escape_html(read):
    return read("pages").select("page_id", F.md5(X.escape_html("html").cast("binary")).alias("escaped"))


@query("SELECT item_id, array_to_string(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> ''), ' ') AS text FROM benchmark")
def inverted_index_roundtrip(read):
    """Words go to a map of positions and come back in order."""
    words = read("benchmark").select("item_id", F.posexplode(F.filter(F.split("text", r"\s+"), lambda w: w != "")).alias("at", "word"))
    places = words.groupBy("item_id", "word").agg(F.array_sort(F.collect_list("at")).alias("places"))
    index = places.groupBy("item_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "places"))).alias("index"))
    return index.select("item_id", X.inverted_text("index").alias("text"))


@query("SELECT o_orderkey, year(o_orderdate)::VARCHAR AS year, CASE o_orderkey % 4 WHEN 0 THEN 'ICDE' || year(o_orderdate) WHEN 1 THEN 'VLDB' || year(o_orderdate) WHEN 2 THEN 'ArXiv' || year(o_orderdate) ELSE '其他' END AS venue FROM orders WHERE year(o_orderdate) >= 2000 UNION ALL SELECT o_orderkey, '', CASE o_orderkey % 4 WHEN 2 THEN 'ArXiv' ELSE '其他' END FROM orders WHERE year(o_orderdate) < 2000")
def file_venue_year(read):
    year = F.year("o_orderdate").cast("string")
    stem = F.get(F.array(*[F.lit(s) for s in ("ICDE-main", "VLDB_short", "arxiv-", "EMNLP")]), (F.col("o_orderkey") % 4).cast("int"))
    path = F.concat(F.lit("/raw/"), year, F.lit("/"), stem, year, F.lit(".json"))
    return read("orders").select("o_orderkey", X.path_year(path).alias("year"), V.file_venue(path).alias("venue"))


# Markup.


@query("SELECT page_id, regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) AS h1, len(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>')) AS items, regexp_extract(html, '(?i)<meta charset=\"([^\"]*)\"', 1) AS charset FROM pages")
def html_parts(read):
    h = F.col("html")
    return read("pages").select("page_id", G.one(h, r"(?is)<h1[^>]*>(.*?)</h1>").alias("h1"), F.size(G.found(h, r"(?is)<li[^>]*>(.*?)</li>")).cast("long").alias("items"), G.one(h, r'(?i)<meta charset="([^"]*)"').alias("charset"))


@query("SELECT page_id, i - 1 AS pos, regexp_extract(a, '^<a href=\"([^\"]*)\"', 1) AS href, regexp_extract(a, '>(.*)</a>$', 1) AS anchor FROM (SELECT page_id, l[i] AS a, i FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?s)<a href=\"[^\"]*\">.*?</a>') AS l FROM pages)))")
def html_links(read):
    pattern = r'(?s)<a href="([^"]*)">(.*?)</a>'
    zipped = F.arrays_zip(G.found(F.col("html"), pattern).alias("h"), G.found(F.col("html"), pattern, 2).alias("t"))
    return read("pages").select("page_id", F.posexplode(zipped).alias("pos", "z")).select("page_id", F.col("pos").cast("long").alias("pos"), F.col("z.h").alias("href"), F.col("z.t").alias("anchor"))


@query("SELECT page_id, md5(CASE WHEN regexp_matches(html, '(?is)<article[^>]*>(.*?)</article>') THEN regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1) ELSE html END) AS region FROM pages")
def html_region(read):
    return read("pages").select("page_id", F.md5(G.main_region(F.col("html")).cast("binary")).alias("region"))


# The other engine knows no references: these are the ones that the pages hold; '&amp;' comes last, as each is decoded once.
DECODED_SQL = "regexp_replace(replace(replace(replace({0}, '&middot;', '·'), '&copy;', '©'), '&quot;', '\"'), '&amp;?', '&', 'g')"
SQUASHED_SQL = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"
TAGS_SQL = "regexp_replace({0}, '<[^>]+>', ' ', 'g')"
LINED_SQL = "regexp_replace(html, '(?i)<\\s*br\\s*/?\\s*>|</(h[1-6]|p|li|td|tr|div)>', chr(10), 'g')"


@query(
    f"SELECT page_id, len(l) AS lines, md5(array_to_string(l, chr(10))) AS digest FROM (SELECT page_id, list_filter(list_transform(string_split({DECODED_SQL.format(TAGS_SQL.format(LINED_SQL))}, chr(10)), lambda x: {SQUASHED_SQL.format('x')}), lambda x: x <> '') AS l FROM pages)"
)
def html_lines(read):
    """Lines of pages after tags went and references were decoded."""
    lines = read("pages").select("page_id", X.lines("html").alias("l"))
    return lines.select("page_id", F.size("l").cast("long").alias("lines"), F.md5(F.array_join("l", "\n").cast("binary")).alias("digest"))


BARE_SQL = "regexp_replace(html, '(?is)<(script|style)\\b[^>]*>.*?</(script|style)>', ' ', 'g')"


@query(f"SELECT page_id, md5({SQUASHED_SQL.format(DECODED_SQL.format(TAGS_SQL.format(BARE_SQL)))}) AS cleaned, md5({SQUASHED_SQL.format(TAGS_SQL.format(DECODED_SQL.format('html')))}) AS decoded_first FROM pages")
def html_clean(read):
    """Both orders: tags out and then references decoded, and the other way round."""
    return read("pages").select("page_id", F.md5(X.clean_html("html").cast("binary")).alias("cleaned"), F.md5(X.references_then_tags("html").cast("binary")).alias("decoded_first"))


@query(f"SELECT doc_id, md5({SQUASHED_SQL.format(TAGS_SQL.format('text'))}) AS cleaned FROM documents")
def text_clean(read):
    """The full cleaning of whole texts, NFKC included. Documents hold nothing that decoding or NFKC would change, which the SQL relies on."""
    return read("documents").select("doc_id", F.md5(X.clean_text("text").cast("binary")).alias("cleaned"))


# Rules.


@query(f"SELECT doc_id, {sql_any(SQL_LOW.format('text'), ['license', 'der'])} AS words, {sql_any(SQL_LOW.format('text'), ['all rights', ' | '])} AS parts FROM documents")
def term_match(read):
    low = X.lowered("text")
    return read("documents").select("doc_id", rules.any_term(low, ["license", "der"]).alias("words"), rules.any_term(low, ["all rights", " | "]).alias("parts"))


FIXTURE_RELEVANCE = rules.RelevancePack(
    direct=["general public license"], generation=["rights reserved"], natural_language=["the", "of"], boundary=["version"], other_domain=["!!"], code=[" | "], task_list=["und"], llm=["les"],
    background=[r"\blicense, version 9"], task_list_pattern=r"\ball rights\b", database=("license", "licensed"), schema=("reserved",), tables=("der",), queries=("und",), lay_users=("del",), making=("work", "under"),
    making_abroad=("para",), interfaces=("this work",), insight=("dans",), parsing="rights", language="nicht", answering="permission",
)


def sql_relevance(p: rules.RelevancePack) -> str:
    low, first = SQL_LOW.format("text"), SQL_LOW.format("split_part(text, chr(10), 1)")
    a = lambda terms: sql_any("b", list(terms))
    return f"""
    WITH d AS (SELECT doc_id, {low} AS b, {first} AS t FROM documents),
    s AS (SELECT doc_id, {sql_any('t', p.direct)} AS td, {a(p.direct)} OR (contains(b, {sql_text(p.parsing)}) AND contains(b, {sql_text(p.language)})) AS di, {a(p.generation)} AS ge, {a(p.database)} AS db,
      {a(p.schema)} AS sc, {a(p.natural_language)} AS nl, {a(p.boundary)} AS bo, {a(p.other_domain)} AS el, {a(p.code)} AS co, regexp_matches(b, {sql_text(p.task_list_pattern)}) AND {a([*p.task_list, *p.code])} AS li,
      regexp_matches(b, {sql_text(p.background[0])}) AS ba, {a(p.llm)} AS mo, {a(p.lay_users)} AS la, {a(p.making)} AS ma, {a(p.making_abroad)} AS ab, {a(p.interfaces)} AS it, contains(b, {sql_text(p.answering)}) AS an, {a(p.insight)} AS ins FROM d)
    SELECT doc_id, CASE
      WHEN NOT td AND el THEN 'irrelevant' WHEN NOT td AND li THEN 'irrelevant' WHEN NOT td AND co AND NOT ge THEN 'irrelevant' WHEN NOT td AND ba THEN 'irrelevant'
      WHEN td AND NOT bo THEN 'core' WHEN di AND NOT bo THEN 'core' WHEN di THEN 'application' WHEN ge AND (mo OR la) THEN 'application' WHEN ge AND nl THEN 'application'
      WHEN db AND nl AND ma THEN 'application' WHEN db AND ab THEN 'application' WHEN it AND db THEN 'application' WHEN an AND (db OR sc) THEN 'application' WHEN ins AND mo THEN 'application'
      ELSE 'irrelevant' END AS level FROM s"""


@query(sql_relevance(FIXTURE_RELEVANCE))
def relevance_case(read):
    first, rest = F.split_part("text", F.lit("\n"), F.lit(1)), F.regexp_replace("text", r"(?s)^[^\n]*\n?", "")
    signals = rules.signals(first, rest, F.lit(""), FIXTURE_RELEVANCE)
    return read("documents").select("doc_id", signals.alias("s")).select("doc_id", rules.decide(F.col("s")).alias("level"))


@query("SELECT doc_id, 'irrelevant' AS level FROM documents")
def relevance_domain(read):
    """The domain's own pack: the generated documents are not of its domain."""
    return read("documents").select("doc_id", rules.signals(F.lit(""), "text", F.lit("")).alias("s")).select("doc_id", rules.decide(F.col("s")).alias("level"))


LABELS = sql_labels(SQL_LOW.format("text"), FIXTURE_TOPICS)


@query("SELECT n_nationkey, 'rules' AS backend, CASE WHEN n_regionkey = 0 THEN 'Legal|Licence' ELSE 'Style' END AS labels FROM nation UNION ALL SELECT n_nationkey, 'answers', 'Legal|Licence' FROM nation WHERE n_nationkey % 2 = 0")
def label_backends(read):
    """Labels by rules, and by the answers of an outside classifier, without which a paper goes."""
    papers = read("nation").select("n_nationkey", F.col("n_nationkey").alias("key"), F.col("n_name").alias("title"), F.when(F.col("n_regionkey") == 0, "A  License").otherwise("").alias("abstract"), F.lit(None).cast("string").alias("keywords"))
    answers = papers.select("key", F.when(F.col("key") % 2 == 0, '{"topics": ["Legal, Licence"]}').otherwise("NOT_RELEVANT").alias("answer"))
    labelled = [(rules.label_papers(papers, FIXTURE_TOPICS), "rules"), (rules.label_papers(papers, FIXTURE_TOPICS, answers), "answers")]
    parts = [df.select("n_nationkey", F.lit(name).alias("backend"), F.array_join("labels", "|").alias("labels")) for df, name in labelled]
    return parts[0].union(parts[1])


@query(f"SELECT doc_id, array_to_string({LABELS}, '|') AS labels FROM documents")
def multi_label(read):
    return read("documents").select("doc_id", F.array_join(rules.classify(X.lowered("text"), FIXTURE_TOPICS), "|").alias("labels"))


@query(f"SELECT label, count(*) AS n FROM (SELECT unnest({LABELS}) AS label FROM documents) GROUP BY label")
def label_counts(read):
    rows = read("documents").select(rules.classify(X.lowered("text"), FIXTURE_TOPICS).alias("labels"))
    return facets.label_counts(rows, "labels").select(F.col("value").alias("label"), "n")


@query("SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'Legal|Licence' WHEN 1 THEN 'Language|English' WHEN 2 THEN 'Language|German' WHEN 3 THEN 'Style' ELSE '' END AS labels FROM part")
def label_normalise(read):
    given = F.get(F.array(*[F.array(F.lit(a), F.lit("no such label")) for a in ("License", "Englisch", "German", "Style", "Nothing")]), F.col("p_size") % 5)
    return read("part").select("p_partkey", F.array_join(rules.normalize_labels(given, FIXTURE_TOPICS), "|").alias("labels"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'application_related,old' WHEN doc_id % 3 = 1 THEN 'old' END AS flags FROM documents")
def quality_flags(read):
    level = F.get(F.array(F.lit("application"), F.lit("core"), F.lit("irrelevant")), (F.col("doc_id") % 3).cast("int"))
    given = F.when(F.col("doc_id") % 3 < 2, F.array(F.lit("old"), F.lit("application_related")))
    return read("documents").select("doc_id", F.array_join(rules.quality_flags(given, level), ",").alias("flags"))


HOSTS = VenuePack({"Blog": ["blog.", "blog.tionble"], "Mobile": ["m.", "m.free-bets"], "Web": ["www.", "tionsh.example"], "Net": ["net"]}, {}, [(["Blog", "Web"], "Sites"), (["Mobile"], "Phones")], side_volume=("Net", "none", "none"), unproven="")
HOST_SQL = "lower(regexp_extract(url, '^https?://([^/?#]*)', 1))"


@query(f"SELECT page_id, v AS venue, CASE WHEN v IN ('Blog', 'Web') THEN 'Sites' WHEN v = 'Mobile' THEN 'Phones' ELSE '其他' END AS category FROM (SELECT page_id, CASE WHEN {sql_alias(HOST_SQL, HOSTS.aliases)} = '' THEN '其他' ELSE {sql_alias(HOST_SQL, HOSTS.aliases)} END AS v FROM pages)")
def alias_longest_first(read):
    venue = V.name_with_year(F.regexp_extract("url", r"^https?://([^/?#]*)", 1), "", HOSTS)
    return read("pages").select("page_id", venue.alias("venue")).withColumn("category", V.category(F.col("venue"), HOSTS))


@query("SELECT n_nationkey, n_nationkey % 5 IN (0, 1, 4) AS confident FROM nation")
def confident_source(read):
    sources = F.array(*[F.lit(s) for s in ("Proc. VLDB Endow.", "PVLDB", "Findings of the ACL", "", "Annual Meeting of the Association for Computational Linguistics")])
    targets = F.array(*[F.lit(t) for t in ("VLDB2024", "VLDB", "ACL2024", "ACL", "ACL")])
    k = (F.col("n_nationkey") % 5).cast("int")
    return read("nation").select("n_nationkey", V.confident_source(F.get(sources, k), F.get(targets, k)).alias("confident"))


@query("SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'Legal|Licence|Language|German' WHEN 1 THEN 'Legal|Licence' END AS labels FROM nation")
def answered_labels(read):
    """Answers of an outside classifier: plain, fenced, refusing and broken."""
    answers = F.array(*[F.lit(a) for a in ('{"topics": ["Language, German", "Legal, Licence", "No, Such"]}', 'Here:```json{"topics": ["Legal, Licence"]}```', "NOT_RELEVANT", "{broken")])
    labels = rules.answered_labels(F.get(answers, (F.col("n_nationkey") % 4).cast("int")), "topics", FIXTURE_TOPICS)
    return read("nation").select("n_nationkey", F.array_join(labels, "|").alias("labels"))


@query("SELECT n_name AS name, row_number() OVER (ORDER BY CASE WHEN n_regionkey = 1 THEN 0 ELSE 1 END, n_nationkey) - 1 AS ord FROM nation")
def venue_manifest(read):
    n = read("nation").select(F.col("n_name").alias("venue"), F.col("n_nationkey").alias("at"), "n_regionkey")
    return incremental.manifest(n.where("n_regionkey = 1"), n).withColumn("ord", F.col("ord").cast("long"))


# Merging.


DOC_KEY = f"CASE WHEN {KEY_SQL} = '' THEN '' ELSE md5({KEY_SQL}) END"


def keyed(read) -> DataFrame:
    """Documents with the key of their whole text, as a digest ('' if the text has no word)."""
    key = X.title_key("text", True)
    return read("documents").withColumn("key", X.let(key, lambda k: F.when(k == "", "").otherwise(F.md5(k.cast("binary")))))


@query(f"SELECT key, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM (SELECT *, {DOC_KEY} AS key FROM documents) GROUP BY key")
def dedupe_first(read):
    return merge.first_per_key(keyed(read).select("key", "doc_id", "source"), ["key"], "doc_id")


@query(f"SELECT key, min(doc_id) AS doc_id, arg_max(source, doc_id) AS source FROM (SELECT *, {DOC_KEY} AS key FROM documents) GROUP BY key")
def dedupe_last(read):
    """The last value in the place of the first."""
    return R.last_of_each(keyed(read).select("key", "doc_id", "source"), ["key"], "doc_id")


@query("""
SELECT p_name AS key, min(p_partkey) AS ord, count(*) AS n, md5(list_reduce(list(repeat(p_type, p_size) ORDER BY p_partkey), lambda a, b: CASE WHEN length(b) > length(a) + 40 THEN b ELSE a END)) AS text
FROM part GROUP BY p_name""")
def dedupe_fold(read):
    """The ordered fold: a text gives way to one that is more than 40 characters longer."""
    rows = read("part").select("p_name", "p_partkey", F.expr("repeat(p_type, p_size)").alias("text"))
    out = merge.fold(rows, ["p_name"], "p_partkey", F.col("text"), lambda a, b: b if len(b) > len(a) + merge.GAIN else a)
    return out.select(F.col("p_name").alias("key"), F.col("p_partkey").alias("ord"), "n", F.md5(F.col("record").cast("binary")).alias("text"))


# Parts as papers of their names: the score of a record depends on its abstract and DOI alone, as the rest is filled alike.
PAPER_SQL = """
WITH p AS (SELECT p_partkey AS ord, p_name AS key, repeat(p_type || ' ', p_size) AS raw, 'Ann ' || p_brand AS author, CASE WHEN p_size > 40 THEN '10.1/' || p_partkey ELSE '' END AS doi, p_type AS stage,
  CASE p_size % 3 WHEN 0 THEN ['Licence'] WHEN 1 THEN ['German'] ELSE ['Table', 'no such label'] END AS labels FROM part),
r AS (SELECT key, ord, {'a': trim(raw), 'au': author, 'd': doi} AS x, labels, stage FROM p),
m AS (SELECT key, min(ord) AS ord, count(*) AS n, list_reduce(list(x ORDER BY ord), lambda a, b:
    CASE WHEN (CASE WHEN length(b.a) >= 80 THEN 8 WHEN length(b.a) > 0 THEN 3 ELSE 0 END) + (CASE WHEN b.d <> '' THEN 4 ELSE 0 END) > (CASE WHEN length(a.a) >= 80 THEN 8 WHEN length(a.a) > 0 THEN 3 ELSE 0 END) + (CASE WHEN a.d <> '' THEN 4 ELSE 0 END)
    THEN {'a': CASE WHEN b.a = '' OR length(a.a) > length(b.a) + 40 THEN a.a ELSE b.a END, 'au': b.au, 'd': CASE WHEN b.d <> '' THEN b.d ELSE a.d END}
    ELSE {'a': CASE WHEN a.a = '' OR length(b.a) > length(a.a) + 40 THEN b.a ELSE a.a END, 'au': a.au, 'd': CASE WHEN a.d <> '' THEN a.d ELSE b.d END} END) AS x,
  list_sort(list_distinct(list(stage))) AS stages, bool_or(list_contains(labels, 'Licence')) AS li, bool_or(list_contains(labels, 'German')) AS ge, bool_or(list_contains(labels, 'Table')) AS ta FROM r GROUP BY key)
SELECT key AS title_key, ord, n, md5(x.a) AS abstract, x.au AS author, x.d AS doi, array_to_string(list_filter([CASE WHEN li THEN 'Legal|Licence' END, CASE WHEN ge THEN 'Language|German' END, CASE WHEN ta THEN 'Style|Table' END], lambda y: y IS NOT NULL), '|') AS labels, array_to_string(stages, '|') AS stages FROM m
"""


def part_papers(read) -> DataFrame:
    none = F.lit(None).cast("string")
    columns = {"title": F.col("p_name"), "abstract": F.expr("repeat(concat(p_type, ' '), p_size)"), "author": F.concat(F.lit("Ann "), "p_brand"), "doi": F.when(F.col("p_size") > 40, F.concat(F.lit("10.1/"), "p_partkey")).otherwise(""), "year": F.lit("2024"), "type": F.lit("ARTICLE")}
    labels = F.when(F.col("p_size") % 3 == 0, F.array(F.lit("Licence"))).when(F.col("p_size") % 3 == 1, F.array(F.lit("German"))).otherwise(F.array(F.lit("Table"), F.lit("no such label")))
    return read("part").select(F.col("p_partkey").alias("ord"), F.lit("").alias("map_key"), *[columns.get(f, none).alias(f) for f in merge.FIELDS], labels.alias("labels"), F.array("p_type").alias("pipeline_stages"))


@query(PAPER_SQL)
def dedupe_papers(read):
    """The full merge of records: parts of one name become one, in their order."""
    out = merge.dedupe(part_papers(read), packs.VENUES, FIXTURE_TOPICS)
    return out.select("title_key", "ord", "n", F.md5(F.col("abstract").cast("binary")).alias("abstract"), "author", "doi", F.array_join("labels", "|").alias("labels"), F.array_join(F.array_sort("pipeline_stages"), "|").alias("stages"))


UPSERT_SQL = """
WITH e AS (SELECT DISTINCT p_name AS k FROM part), i AS (SELECT n_nationkey AS ord, CASE WHEN n_regionkey = 0 THEN '' WHEN n_nationkey < 12 THEN (SELECT k FROM (SELECT k, row_number() OVER (ORDER BY k) - 1 AS r FROM e) WHERE r = n_nationkey % 3) ELSE 'Paper ' || n_regionkey END AS k FROM nation)
SELECT (SELECT count(DISTINCT k) FROM i WHERE k LIKE 'Paper %') AS added, (SELECT count(DISTINCT k) FROM i WHERE k <> '' AND k NOT LIKE 'Paper %') AS updated,
  (SELECT count(*) FROM i WHERE k <> '') - (SELECT count(DISTINCT k) FROM i WHERE k <> '') AS skipped, (SELECT count(*) FROM i WHERE k = '') AS invalid, (SELECT count(*) FROM e) + (SELECT count(DISTINCT k) FROM i WHERE k LIKE 'Paper %') AS total"""


def incoming_papers(read) -> DataFrame:
    none = F.lit(None).cast("string")
    names = read("part").select("p_name").distinct()
    three = names.withColumn("r", F.row_number().over(Window.orderBy("p_name")) - 1).where("r < 3")  # names are few
    n = read("nation").withColumn("r", F.col("n_nationkey") % 3).join(F.broadcast(three), "r")
    title = F.when(F.col("n_regionkey") == 0, "").when(F.col("n_nationkey") < 12, F.col("p_name")).otherwise(F.concat(F.lit("Paper "), "n_regionkey"))
    columns = {"title": title, "keywords": F.lit("words"), "year": F.lit("2024"), "type": F.lit("ARTICLE")}
    return n.select(F.col("n_nationkey").cast("long").alias("ord"), F.lit("").alias("map_key"), *[columns.get(f, none).alias(f) for f in merge.FIELDS], F.array().cast("array<string>").alias("labels"), F.array().cast("array<string>").alias("pipeline_stages"))


@query(UPSERT_SQL)
def upsert_papers(read):
    """An upsert by key and score: the first to come for a known key brings it keywords, those after it nothing new."""
    return merge.upsert_counts(merge.upsert_papers(part_papers(read), incoming_papers(read), packs.VENUES, FIXTURE_TOPICS, prefer_existing=True))


@query(UPSERT_SQL)
def upsert_papers_buckets(read):
    """The same upsert into a table of buckets, of which only those with keys that came are rewritten."""
    incoming = incoming_papers(read)
    table = merge.papers_table(part_papers(read), new_path(incoming.sparkSession, "papers"), 16, packs.VENUES, FIXTURE_TOPICS)
    drop_at_exit(incoming.sparkSession, table.files.root)
    counts = merge.upsert_into(table, incoming, packs.VENUES, FIXTURE_TOPICS, prefer_existing=True)
    return table.read().agg(*[F.lit(n).cast("long").alias(c) for c, n in counts.items()], F.count("*").alias("total"))


@query("SELECT o_custkey AS custkey, count(*) AS n_orders, strftime(max(o_orderdate), '%Y-%m-%d') AS last_order, true AS as_planned FROM orders GROUP BY 1")
def upsert_buckets(read):
    """Customers' counts of orders before the last day, and that day's orders merged into the buckets they hit. as_planned: a
    row's file is a new one exactly where its bucket was hit."""
    orders = read("orders").select(F.col("o_custkey").alias("custkey"), "o_orderdate")
    days = orders.join(F.broadcast(orders.agg(F.max("o_orderdate").alias("last"))))  # one row
    counts = lambda rows: rows.groupBy("custkey").agg(F.count("*").alias("n_orders"), F.max(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("last_order"))
    both = lambda old, new: old.unionByName(new).groupBy("custkey").agg(F.sum("n_orders").alias("n_orders"), F.max("last_order").alias("last_order"))
    spark, incoming = orders.sparkSession, counts(days.where("o_orderdate = last"))
    table = buckets.BucketTable.create(counts(days.where("o_orderdate < last")), new_path(spark, "customers"), ["custkey"], 64)
    drop_at_exit(spark, table.files.root)
    table.upsert(incoming, both)
    place = table.bucket(table.version()).alias("bucket")
    before = table.read(0).select(F.col("custkey").alias("__k"), F.input_file_name().alias("__before"))
    after = table.read().select("*", place, F.input_file_name().alias("__after"))
    hit = incoming.select(place).distinct().withColumn("__hit", F.lit(True))
    rows = after.join(before, F.col("custkey").eqNullSafe(F.col("__k")), "left").join(F.broadcast(hit), "bucket", "left")  # hit has a row for each bucket at most
    return rows.select("custkey", "n_orders", "last_order", (F.col("__before").eqNullSafe(F.col("__after")) == F.col("__hit").isNull()).alias("as_planned"))


#: Gate rules that metrics() has no count for; they are reported as such.
UNTESTED = [(name, fatal) for name, fatal, _ in gates.RULES if name in ("baseline_unavailable", "not_published", "rate_limited")]
GATED = [r for r in gates.RULES if r[0] in ("duplicate_titles", "irrelevant_present", "deprecated_labels", "venue_unsupported", "side_volume_tagged", *(n for n, _ in UNTESTED))]


@query(f"""
WITH g AS (SELECT p_name, min(p_size) = 1 AS small FROM part GROUP BY 1),
c AS (SELECT (SELECT count(*) FROM part) AS rows_, (SELECT count_if(p_size = 1) FROM part) AS smalls, count(*) AS names, count_if(small) AS pruned FROM g),
t AS (SELECT 1 AS o, 'every row' AS attempt, rows_ > names AS dup, smalls > 0 AS irr, rows_ AS had FROM c UNION ALL SELECT 2, 'merged', false, pruned > 0, names FROM c UNION ALL SELECT 3, 'pruned', false, false, names - pruned FROM c),
k AS (SELECT *, dup OR irr AS refused, coalesce((SELECT max_by(x.had, x.o) FROM t x WHERE x.o <= t.o AND NOT (x.dup OR x.irr)), 0) AS n FROM t),
f AS (SELECT * FROM (VALUES ('duplicate_titles', true, 'broken'), ('irrelevant_present', true, 'broken'), {", ".join(f"('{n}', {str(x).lower()}, 'unmeasured')" for n, x in UNTESTED)}) AS v(rule, fatal, why))
SELECT attempt, refused, n, rule, fatal, why FROM k, f WHERE why = 'unmeasured' OR (rule = 'duplicate_titles' AND dup) OR (rule = 'irrelevant_present' AND irr)""")
def gate_commit(read):
    """Three tries to replace a table, tested on what was written before it is committed: all rows (names repeat), one for each name, and
    of these the relevant ones. n is what readers see after each try; rules without metrics are reported, none of them fatal."""
    rows = read("part").select(X.title_key("p_name").alias("key"), "p_size", "p_partkey").withColumn("at", F.struct("p_size", "p_partkey"))
    merged, spark = merge.first_per_key(rows, ["key"], "at"), rows.sparkSession
    table = buckets.BucketTable.create(rows.where("false").drop("at"), new_path(spark, "gated"), ["key"], 16)
    drop_at_exit(spark, table.files.root)
    blank = {c: F.lit("") for c in ("venue", "venue_track", "booktitle", "journal", "container", "source", "publisher", "url", "doi")}
    level = F.when(F.col("p_size") == 1, rules.IRRELEVANT).otherwise(rules.CORE)

    def attempt(name: str, new: DataFrame) -> list[tuple]:
        found: list[tuple] = []
        try:
            table.replace(new.drop("at"), lambda written: found.extend(gates.must_hold(gates.metrics(written.withColumns(blank | {"labels": F.array().cast("array<string>"), "relevance_level": level})), GATED)))
        except gates.Refused as refused:
            return [(name, True, table.read().count(), *f) for f in refused.found]
        return [(name, False, table.read().count(), *f) for f in found]

    said = [r for name, new in (("every row", rows), ("merged", merged), ("pruned", merged.where("p_size <> 1"))) for r in attempt(name, new)]
    return spark.createDataFrame(said, "attempt string, refused boolean, n long, rule string, fatal boolean, why string")


# Customers by their orders, and suppliers by their lines under every twentieth of the same keys: two versions of one table, from all rows.
VERSIONS_SQL = """
WITH a AS (SELECT o_custkey AS k, min(o_orderstatus) AS s, count(*) % 3 AS v FROM orders GROUP BY 1), b AS (SELECT l_suppkey * 20 AS k, max(l_linestatus) AS s, max(l_returnflag) AS p, count(*) % 3 AS v FROM lineitem GROUP BY 1)
"""


def versions(read) -> tuple[DataFrame, DataFrame]:
    old = read("orders").groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderstatus").alias("s"), (F.count("*") % 3).alias("v"))
    new = read("lineitem").groupBy((F.col("l_suppkey") * 20).alias("k")).agg(F.max("l_linestatus").alias("s"), F.max("l_returnflag").alias("p"), (F.count("*") % 3).alias("v"))
    return old, new


@query(f"""{VERSIONS_SQL}
SELECT coalesce(a.k, b.k)::VARCHAR AS key, CASE WHEN b.k IS NULL THEN a.s ELSE b.s END AS s, b.p AS p, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'kept' ELSE 'updated' END AS status
FROM a FULL JOIN b ON a.k = b.k""")
def upsert_status(read):
    old, new = versions(read)
    key = F.col("k").cast("string").alias("key")
    return merge.upsert(old.select(key, "s", F.lit(None).cast("string").alias("p")), new.select(key, "s", "p"), ["s", "p"])


@query(f"{VERSIONS_SQL} SELECT CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'kept' ELSE 'skipped' END AS status, count(*) AS n FROM a FULL JOIN b ON a.k = b.k GROUP BY 1")
def upsert_counters(read):
    """Existing records are preferred, so what came for them changes nothing."""
    old, new = versions(read)
    key = F.col("k").cast("string").alias("key")
    return merge.upsert(old.select(key, "s"), new.select(key, "s"), ["s"], prefer_existing=True).groupBy("status").agg(F.count("*").alias("n"))


# Joins.


SHINGLES_SQL = "SELECT {0}, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT {0}, w, unnest(range(1, len(w) - 6)) AS i FROM (SELECT {0}, string_split(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), ' ') AS w FROM {1}))"


def shingles(rows: DataFrame, key: str, n: int = 8) -> DataFrame:
    """(key, g): every run of n words of the text."""
    words = rows.select(key, F.split(F.lower(X.squash("text")), " ").alias("w")).where(F.size("w") >= n)
    return words.select(key, "w", F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("i")).select(key, F.array_join(F.slice("w", F.col("i"), F.lit(n)), " ").alias("g"))


@query(f"SELECT DISTINCT d.doc_id FROM ({SHINGLES_SQL.format('doc_id', 'documents')}) d SEMI JOIN ({SHINGLES_SQL.format('item_id', 'benchmark')}) b ON d.g = b.g")
def contamination_semi(read):
    """Documents that share a run of eight words with the benchmark."""
    own = shingles(read("documents"), "doc_id").select("doc_id", F.xxhash64("g").alias("h"), "g")
    return own.join(shingles(read("benchmark"), "item_id").select(F.xxhash64("g").alias("h"), "g").distinct(), ["h", "g"], "left_semi").select("doc_id").distinct()


@query("""
WITH b AS (SELECT item_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS y FROM benchmark), d AS (SELECT doc_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS x FROM documents)
SELECT doc_id, item_id FROM d JOIN b ON x <> '' AND y <> '' AND (contains(x, y) OR contains(y, x))""")
def containment_theta(read):
    items = read("benchmark").select("item_id", F.col("text").alias("item"))
    return joins.contained_titles(read("documents").select("doc_id", "text"), items, "text", "item").select("doc_id", "item_id")


@query("SELECT d.doc_id, d.source, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 1")
def quality_join(read):
    return read("documents").select("doc_id", "source").join(read("labels").where("quality = 1"), "doc_id").select("doc_id", "source", "quality", "toxic")


@query(f"""
WITH p AS (SELECT {FIRST_SQL} AS key, split_part(text, chr(10), 1) AS title, source AS venue, lang AS year, doc_id FROM documents),
q AS (SELECT key, arg_min(title, doc_id) AS title, arg_min(venue, doc_id) AS venue, arg_min(year, doc_id) AS year FROM p GROUP BY key),
c AS (SELECT DISTINCT n_name AS title, lower(n_name) AS key FROM nation UNION SELECT title, key FROM q WHERE venue = 'src3')
SELECT c.title, 'src3' AS expected_venue, 'en' AS expected_year, q.key IS NOT NULL AS found, coalesce(q.title, '') AS actual_title, coalesce(q.venue, '') AS actual_venue, coalesce(q.year, '') AS actual_year,
  CASE WHEN q.key IS NULL THEN '' ELSE 'core' END AS relevance_level, coalesce(q.venue = 'src3' AND q.year = 'en', false) AS ok
FROM (SELECT title, array_to_string(regexp_extract_all(lower(replace(title, 'ß', 'ss')), '[a-z0-9]+'), ' ') AS key FROM c) c LEFT JOIN q ON c.key = q.key""")
def canary_left(read):
    rows = read("documents").select(F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), F.col("source").alias("venue"), F.col("lang").alias("year"), "doc_id").withColumn("key", X.title_key("title", True))
    papers = merge.first_per_key(rows, ["key"], "doc_id").withColumn("relevance_level", F.lit("core"))
    names = read("nation").select(F.col("n_name").alias("title")).union(papers.where("venue = 'src3'").select("title")).distinct()
    return joins.canary_status(names.withColumns({"venue": F.lit("src3"), "year": F.lit("en")}), papers)


@query("SELECT o_custkey AS key, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1")
def anti_removed(read):
    base = read("orders").select(F.col("o_custkey").cast("string").alias("key"))
    now = read("customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("key"))
    return joins.removed(base, now).groupBy(F.col("key").cast("long").alias("key")).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS verified FROM orders o WHERE o_totalprice > 1000 AND o_custkey IN (SELECT c_custkey FROM customer) AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def verified_pruned(read):
    pruned = read("orders").select(F.col("o_custkey").cast("string").alias("key"), "o_totalprice")
    base = read("customer").select(F.col("c_custkey").cast("string").alias("key"), "c_mktsegment")
    return joins.verified_pruned(pruned, base, base.where("c_mktsegment = 'BUILDING'"), F.col("o_totalprice") > 1000).agg(F.count("*").alias("verified"))


@query("SELECT o_custkey, o_orderkey, o_orderpriority AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY left(o_orderpriority, 1)::INT DESC, year(o_orderdate)::VARCHAR DESC, o_orderkey) AS r FROM orders) WHERE r = 1")
def best_evidence(read):
    rows = read("orders").select("o_custkey", "o_orderkey", F.col("o_orderpriority").alias("rank"), F.left("o_orderpriority", F.lit(1)).cast("int").alias("r"), F.year("o_orderdate").cast("string").alias("y"))
    return joins.best_evidence(rows, ["o_custkey"], "r", "y", "o_orderkey").select("o_custkey", "o_orderkey", "rank")


RANKED = ["其他", "ArXiv", "AIJ", "ICDE"]
CATEGORY = {v: label for venues, label in packs.VENUE_CATEGORY for v in venues}
RECONCILED_SQL = f"""
WITH p AS (SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 0 END AS o FROM part),
e AS (SELECT l_partkey AS k, max(CASE l_suppkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 0 END) AS r FROM lineitem GROUP BY 1)
SELECT k::VARCHAR AS key, {RANKED}[o + 1] AS old, {RANKED}[CASE WHEN r >= o THEN r ELSE o END + 1] AS new, CASE WHEN r >= o THEN {[CATEGORY.get(v, v) for v in RANKED]}[r + 1] ELSE '' END AS category, r >= o AS changed
FROM p JOIN e USING (k)"""


@query(RECONCILED_SQL)
def reconcile_venues(read):
    """Papers of a preprint server or other venue that evidence places in a known one."""
    v = F.array(*[F.lit(x) for x in ("ICDE", "ArXiv", "AIJ", "其他")])
    pick = lambda c: F.get(v, (F.col(c) % 4).cast("int"))
    papers = read("part").select(F.col("p_partkey").cast("string").alias("key"), F.col("p_name").alias("title"), pick("p_partkey").alias("venue"), F.lit("").alias("venue_track"), F.lit("").alias("booktitle"), F.lit("").alias("journal"), F.lit("core").alias("relevance_level"))
    proof = read("lineitem").select(F.col("l_partkey").cast("string").alias("key"), pick("l_suppkey").alias("target"), F.lit("t").alias("raw_title"), F.lit("p").alias("path"), F.lit("").alias("booktitle"), F.lit("").alias("journal"), F.year("l_shipdate").alias("year"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    return joins.reconcile(papers, proof).select("key", F.col("from.venue").alias("old"), F.col("to.venue").alias("new"), F.col("to.venue_track").alias("category"), "changed")


@query("""
SELECT count(*) AS evidence_matches, count(*) FILTER (WHERE o <> 0 OR t <> 0) AS updated_count, count(*) FILTER (WHERE t > o) AS promoted_count, count(*) FILTER (WHERE t = o) AS metadata_fix_count, 0::BIGINT AS already_aligned_count
FROM (SELECT k, CASE k % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS o, 3 AS t FROM (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part)))""")
def reconcile_counts(read):
    """Papers of a conference, a preprint server and a journal, all of which evidence places in another conference."""
    pick = F.get(F.array(*[F.lit(x) for x in ("ICDE", "ArXiv", "TKDE")]), (F.col("p_partkey") % 3).cast("int"))
    none = F.lit("")
    papers = read("part").select(F.col("p_partkey").cast("string").alias("key"), F.col("p_name").alias("title"), pick.alias("venue"), *[none.alias(c) for c in ("venue_track", "booktitle", "journal")], F.lit("core").alias("relevance_level"))
    proof = read("lineitem").select(F.col("l_partkey").cast("string").alias("key"), F.lit("KDD").alias("target"), F.lit("t").alias("raw_title"), F.lit("p").alias("path"), F.lit("KDD").alias("booktitle"), none.alias("journal"), F.year("l_shipdate").alias("year"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    return joins.reconcile_summary(joins.reconcile(papers, proof))


@query("SELECT c_custkey, c_name FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer WHERE c_mktsegment <> 'BUILDING' AND regexp_matches(c_name, '[02468]$')) WHERE r <= 5")
def enrich_candidates(read):
    """Of each group the first five records without an abstract whose title matches a pattern."""
    rows = read("customer").select("c_custkey", "c_name", "c_nationkey", F.col("c_name").alias("title"), F.when(F.col("c_mktsegment") == "BUILDING", "known").alias("abstract"))
    return joins.to_enrich(rows, ["c_nationkey"], "c_custkey", "customer#.*[02468]$", 5).select("c_custkey", "c_name")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'old' ELSE 'c' || (SELECT c_nationkey FROM customer WHERE c_custkey = o_custkey) END AS abstract FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)")
def results_by_key(read):
    """Empty fields filled by the results of a batch, of several the first that has one."""
    rows = read("orders").select("o_orderkey", F.col("o_custkey").alias("doi"), F.when(F.col("o_orderstatus") == "F", "old").otherwise("").alias("abstract"))
    c = read("customer")
    results = c.select(F.col("c_custkey").alias("doi"), F.lit(None).cast("string").alias("abstract"), F.lit(0).alias("o"))
    for k, name in ((2, "later"), (1, "c")):
        value = F.concat(F.lit(name), F.col("c_nationkey").cast("string"))
        results = results.union(c.select("c_custkey", value, F.lit(k)))
    return joins.apply_by_key(rows, results, "doi", ["abstract"], "o").join(c.select(F.col("c_custkey").alias("doi")), "doi", "left_semi").select("o_orderkey", "abstract")


@query("SELECT p_partkey, '10.1234/x' || p_partkey AS doi, 'DOI:10.1234/x' || p_partkey AS doi_id FROM part WHERE p_partkey % 4 < 3 UNION ALL SELECT p_partkey, '', '' FROM part WHERE p_partkey % 4 = 3")
def doi_write_back(read):
    """The first DOI of several fields, written back where there is none."""
    name = F.concat(F.lit("10.1234/x"), F.col("p_partkey").cast("string"))
    on = lambda k, c: F.when(F.col("p_partkey") % 4 == k, c).otherwise("")
    rows = read("part").select("p_partkey", on(0, name).alias("doi"), on(1, F.concat(F.lit("https://doi.org/"), F.replace(name, F.lit("/"), F.lit("%2F")))).alias("url"), on(2, F.concat(F.lit("https://x.org/"), name)).alias("paper_url"))
    return X.with_doi(rows).select("p_partkey", "doi", "doi_id")


@query(f"""{VERSIONS_SQL}
SELECT coalesce(a.k, b.k) AS key, CASE WHEN a.k IS NULL THEN 'stale' WHEN b.k IS NULL THEN 'new' WHEN a.v = b.v THEN 'same' ELSE 'changed' END AS state FROM a FULL JOIN b ON a.k = b.k""")
def change_detect_full(read):
    old, new = versions(read)
    return joins.changes(old.withColumnRenamed("k", "key"), new.withColumnRenamed("k", "key"), "key", "v")


@query("""
SELECT c_custkey::VARCHAR AS record_key, CASE WHEN m = 0 THEN 'skipped' WHEN n > 0 AND m <> 1 THEN 'fetched' WHEN m = 2 THEN 'existing_kept' WHEN m < 5 THEN 'fallback_used' ELSE 'failed' END AS outcome,
  CASE WHEN m = 0 THEN 0 WHEN n > 0 AND m <> 1 THEN n WHEN m = 2 THEN 0 WHEN m < 5 THEN 7 ELSE 0 END AS rows
FROM (SELECT c_custkey, c_custkey % 7 AS m, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer)""")
def fetch_ladder(read):
    """Where the rows of a source come from: the first place, what is there, or the second place; else it failed."""
    c = read("customer").select(F.col("c_custkey").cast("string").alias("record_key"), (F.col("c_custkey") % 7).alias("m"))
    wanted = c.select("record_key", (F.col("m") == 0).alias("skip"), (F.col("m") == 2).alias("has_file"), (F.col("m") < 5).alias("has_second"))
    counts = read("orders").groupBy(F.col("o_custkey").cast("string").alias("record_key")).agg(F.count("*").alias("rows"))
    first = c.join(counts, "record_key", "left").select("record_key", F.coalesce("rows", F.lit(0)).alias("rows"), F.when(F.col("m") == 1, "boom").alias("error"))
    second = c.select("record_key", F.lit(7).alias("rows"), F.when(F.col("m") > 4, "gone").alias("error"))
    return incremental.fetch_ladder(wanted, first, second).select("record_key", "outcome", "rows")


@query("SELECT s_suppkey::VARCHAR AS record_key, 'stale' AS status, '' AS last_success_at, s_nationkey::BIGINT AS record_count, 'h' AS sha256 FROM supplier")
def stale_states(read):
    """Sources whose refresh is due: what is known of their files stays."""
    rows = read("supplier").select(F.col("s_suppkey").cast("string").alias("record_key"), F.lit("p").alias("path"), F.col("s_nationkey").cast("long").alias("rows"), F.lit("h").alias("sha256"))
    return incremental.stale(rows, F.lit("2024-01-02T03:04:05Z").cast("timestamp")).select("record_key", "status", "last_success_at", "record_count", "sha256")


@query("""
WITH f AS (SELECT source, left(sha256(doc_id::VARCHAR), 3) AS part, doc_id || ':' || sha256(text) AS line FROM documents),
p AS (SELECT source, part, sha256(string_agg(line, chr(10) ORDER BY line)) AS h, count(*) AS n FROM f GROUP BY 1, 2)
SELECT source, sha256(string_agg(part || ':' || h, chr(10) ORDER BY part || ':' || h)) AS fingerprint, sum(n)::BIGINT AS files FROM p GROUP BY source""")
def sha_fingerprint(read):
    files = read("documents").select(F.col("doc_id").cast("string").alias("path"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), "source")
    return joins.fingerprints(files, F.col("source")).withColumnRenamed("grp", "source")


@query("""
WITH g AS (SELECT event_type, d AS day FROM (SELECT DISTINCT event_type FROM events) CROSS JOIN (SELECT unnest(range(1, 32)) AS d)),
a AS (SELECT event_type, day(ts) AS day, count(*) AS files, sum(user_id % 7) AS raw FROM events GROUP BY 1, 2)
SELECT g.event_type, g.day::BIGINT AS day, coalesce(a.files, 0) AS files, coalesce(a.raw, 0)::BIGINT AS raw_candidates, a.files IS NOT NULL AS present, CASE WHEN a.files IS NULL THEN 'missing' ELSE 'available' END AS status
FROM g LEFT JOIN a ON g.event_type = a.event_type AND g.day = a.day""")
def coverage_grid(read):
    e = read("events").select("event_type", F.dayofmonth("ts").cast("long").alias("day"), (F.col("user_id") % 7).alias("raw_candidates"))
    grid = e.select("event_type").distinct().withColumn("day", F.explode(F.sequence(F.lit(1), F.lit(31)))).withColumn("day", F.col("day").cast("long"))
    return joins.coverage(grid, e, ["event_type", "day"]).withColumn("raw_candidates", F.col("raw_candidates").cast("long"))


@query("SELECT e.event_id, e.user_id, (SELECT arg_max(m.event_id, m.ts) FROM events m WHERE m.user_id = e.user_id AND m.event_type = 'purchase' AND m.ts <= e.ts) AS last_purchase FROM events e WHERE e.event_type = 'click'")
def asof_last_mark(read):
    e = read("events")
    clicks, marks = e.where("event_type = 'click'").select("event_id", "user_id", "ts"), e.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("last_purchase"))
    return joins.nearest_before(clicks, marks, "user_id", "ts", "last_purchase").select("event_id", "user_id", "last_purchase")


@query("SELECT page_id, CASE WHEN contains(url, '/virtual/') AND regexp_matches(url, '/(poster|paper)/') THEN 'virtual' WHEN lower(url) LIKE '%.pdf' THEN 'pdf' WHEN page_id % 3 = 0 THEN 'anthology' WHEN page_id % 3 = 1 THEN 'doi' ELSE 'none' END AS route FROM pages")
def abstract_route(read):
    doi = F.get(F.array(F.lit("10.18653/v1/x"), F.lit("10.1/x"), F.lit("")), (F.col("page_id") % 3).cast("int"))
    return read("pages").select("page_id", joins.route(F.col("url"), doi).alias("route"))


# Facets.


@query("SELECT lang AS value, count(*) AS n FROM documents GROUP BY 1")
def facet_plain(read):
    return facets.scalar_counts(read("documents"), "lang")


@query("SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source")
def facet_grouping_sets(read):
    return facets.all_counts(read("documents"), ["lang", "source"])


@query(f"""
WITH d AS MATERIALIZED (SELECT doc_id, lang, source, {LABELS} AS labels, lower(text) AS s FROM documents)
SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM d WHERE contains(s, 'er') AND list_contains(labels, 'Language') AND source = 'src1' GROUP BY lang
UNION ALL SELECT 'source', source, count(*) FROM d WHERE contains(s, 'er') AND list_contains(labels, 'Language') AND lang = 'en' GROUP BY source
UNION ALL SELECT 'labels', l, count(*) FROM (SELECT unnest(labels) AS l FROM d WHERE contains(s, 'er') AND lang = 'en' AND source = 'src1') GROUP BY l""")
def facet_self_excluding(read):
    rows = read("documents").select("lang", "source", rules.classify(X.lowered("text"), FIXTURE_TOPICS).alias("labels"), F.lower("text").alias("search"))
    chosen = facets.Selection("er", {"lang": "en", "source": "src1"}, {"labels": ["Language"]})
    return facets.drill_down(rows, chosen, ["lang", "source", "labels"])


@query(f"""
WITH d AS (SELECT doc_id, lang, {LABELS} AS labels, lower(text) AS s FROM documents) SELECT doc_id FROM d WHERE contains(s, 'er') AND lang = 'en' AND list_contains(labels, 'Language') AND list_contains(labels, 'English')""")
def facet_filter(read):
    rows = read("documents").select("doc_id", "lang", rules.classify(X.lowered("text"), FIXTURE_TOPICS).alias("labels"), F.lower("text").alias("search"))
    return facets.matching(rows, facets.Selection("er", {"lang": "en"}, {"labels": ["Language", "English"]})).select("doc_id")


@query("SELECT n_name AS value, count(c_custkey) AS n FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey AND c_acctbal > 5000 GROUP BY n_name")
def facet_zero_fill(read):
    counts = read("customer").where("c_acctbal > 5000").join(F.broadcast(read("nation")), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("value")).agg(F.count("*").alias("n"))
    return facets.zero_filled(read("nation").select(F.col("n_name").alias("value")), counts)


@query("SELECT p_type AS value, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, value LIMIT 15")
def topk_labels(read):
    return facets.top(facets.scalar_counts(read("part"), "p_type"), 15)


@query("SELECT DISTINCT lang AS value, CASE lang WHEN 'en' THEN 1 WHEN 'fr' THEN 2 ELSE 3 END AS ord FROM documents")
def facet_options(read):
    return facets.options(read("documents"), "lang", ["en", "fr"]).withColumn("ord", F.col("ord").cast("int"))


# Gates.


@query("SELECT source AS venue, count(*) AS total, count(*) FILTER (WHERE lang = 'en') AS en, count(*) FILTER (WHERE lang = 'de') AS de, count(*) FILTER (WHERE lang = 'fr') AS fr FROM documents GROUP BY 1")
def pivot_counts(read):
    return gates.pivot_counts(read("documents").withColumnRenamed("source", "venue"), ["venue"], "lang", ["en", "de", "fr"])


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def status_histogram(read):
    return gates.status_histogram(read("orders"), "o_orderstatus")


@query("""
WITH b AS (SELECT count(DISTINCT o_custkey) AS b FROM orders), c AS (SELECT count(DISTINCT o_custkey) AS c FROM orders WHERE o_orderkey % 3 = 0)
SELECT b, c, CASE WHEN b > 0 THEN round(greatest(0, b - c - 10) / b, 6) ELSE 0.0 END AS drop_ratio FROM b, c""")
def drop_ratio(read):
    row = read("orders").agg(F.countDistinct("o_custkey").alias("b"), F.countDistinct(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey"))).alias("c"))
    return row.select("b", "c", gates.drop_ratio(F.col("b"), F.col("c"), F.lit(10)).alias("drop_ratio"))


@query("SELECT count(*) AS n FROM (SELECT o_custkey FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0 INTERSECT SELECT l_suppkey FROM lineitem)")
def set_intersection_size(read):
    return gates.in_all(read("orders").select("o_custkey"), read("customer").where("c_acctbal > 0").select("c_custkey"), read("lineitem").select("l_suppkey"))


@query("SELECT source, count(*) AS candidates, count(*) FILTER (WHERE quality = 1) AS relevant FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source")
def raw_stats(read):
    return gates.raw_stats(read("documents").select("doc_id", "source").join(read("labels"), "doc_id", "left"), ["source"], F.col("quality") == 1)


GATE_SQL = f"""
WITH d AS (SELECT count(*) AS keyed, count(DISTINCT {DOC_KEY}) AS u, count(*) FILTER (WHERE contains(lower(text), 'license')) AS dep FROM documents),
l AS (SELECT count(*) FILTER (WHERE quality = 0) AS bad, count(*) FILTER (WHERE toxic = 1) AS tox, avg((quality = 0)::INT) AS share FROM labels),
o AS (SELECT avg((o_orderstatus = 'F')::INT) AS failed, avg((o_orderstatus = 'O')::INT) AS open, count(*) FILTER (WHERE o_totalprice < 0) AS none FROM orders),
m AS (SELECT * FROM d, l, o)
"""
GATES = [
    ("duplicate_titles", True, "keyed > u"), ("deprecated_labels", True, "dep > 0"), ("irrelevant_present", True, "bad > 0"), ("canary_missed", True, "tox > 0"), ("unexplained_drop", True, "share > 0.05"),
    ("dblp_failure_ratio", True, "failed > 0.3"), ("other_ratio", False, "open > 0.3"), ("rate_limited", False, "bad > tox"), ("dry_run_changed", True, "none > 0"), ("dry_run_stale", True, "tox > 0"), ("baseline_unavailable", False, "dep > 0"),
    ("sentinel_version", True, "none <> 2"), ("venue_unsupported", True, "none > 0"), ("journals_missing", True, "bad > 0"), ("conferences_missing", True, "none > 0"), ("config_missing", True, "dep > 0"),
    ("side_volume_tagged", True, "none > 0"), ("not_published", False, "keyed > 0"), ("api_key_unset", False, "none = 0"),
]


@query(GATE_SQL + " UNION ALL ".join(f"SELECT '{name}' AS rule, {str(fatal).lower()} AS fatal FROM m WHERE {test}" for name, fatal, test in GATES))
def gate_violations(read):
    """The rules that a row of metrics breaks; the metrics are counts over documents, labels and orders."""
    d = keyed(read).agg(F.count("*").alias("keyed"), F.countDistinct("key").alias("unique_titles"), F.count_if(F.contains(F.lower("text"), F.lit("license"))).alias("dep"))
    rows = read("labels").agg(F.count_if(F.col("quality") == 0).alias("bad"), F.count_if(F.col("toxic") == 1).alias("tox"), F.avg(F.when(F.col("quality") == 0, 1).otherwise(0)).alias("drop_ratio"))
    share = lambda s: F.avg(F.when(F.col("o_orderstatus") == s, 1).otherwise(0))
    o = read("orders").agg(share("F").alias("dblp_failure_ratio"), share("O").alias("other_ratio"), F.count_if(F.col("o_totalprice") < 0).alias("none"))
    one = d.crossJoin(rows).crossJoin(o)  # three tables of one row
    metrics = {
        "deprecated": "dep", "irrelevant": "bad", "canaries_missed": "tox", "rate_limited": "greatest(bad - tox, 0)", "changed": "none", "stale": "tox", "baseline_ok": "dep = 0", "sentinel_version": "none", "unsupported": "none",
        "journals_missing": "bad", "conferences_missing": "none", "configs_missing": "dep", "side_volume": "none", "not_published": "keyed", "api_key_set": "none <> 0",
    }
    return gates.violations(one.select("keyed", "unique_titles", "drop_ratio", "dblp_failure_ratio", "other_ratio", *[F.expr(e).alias(n) for n, e in metrics.items()]))


@query("SELECT count(*) FILTER (WHERE quality = 1) AS kept, count(*) FILTER (WHERE quality = 0) AS removed FROM labels")
def prune_split(read):
    rows = read("labels").withColumn("relevance_level", F.when(F.col("quality") == 1, "core").otherwise("irrelevant"))
    kept, gone = gates.split(rows)
    return kept.select(F.lit(1).alias("k"), F.lit(0).alias("g")).unionAll(gone.select(F.lit(0), F.lit(1))).agg(F.sum("k").alias("kept"), F.sum("g").alias("removed"))


@query("SELECT key, n, array_to_string(ids[1:3], ',') AS titles FROM (SELECT key, count(*) AS n, list(doc_id::VARCHAR ORDER BY doc_id::VARCHAR) AS ids FROM (SELECT *, " + DOC_KEY + " AS key FROM documents) WHERE key <> '' GROUP BY key HAVING count(*) > 1)")
def dup_groups(read):
    groups = gates.duplicate_groups(keyed(read).select("key", F.col("doc_id").cast("string").alias("t")), "key", "t", 3)
    return groups.select("key", "n", F.array_join("titles", ",").alias("titles"))


# Pairs of rows and islands.


@query("SELECT conv_id, turn, role, next_role, length(next_text) AS next_chars FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND next_role = 'assistant'")
def turn_pairs(read):
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = read("conversations").withColumns({"next_role": F.lead("role").over(w), "next_text": F.lead("text").over(w)})
    return rows.where("role = 'user' AND next_role = 'assistant'").select("conv_id", "turn", "role", "next_role", F.length("next_text").cast("long").alias("next_chars"))


@query("SELECT user_id, g AS island, count(*) AS n, min(ts) AS first_ts FROM (SELECT *, sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM events) GROUP BY 1, 2")
def gaps_islands(read):
    """A purchase begins an island of a user's events."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = read("events").withColumn("island", F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).over(w))
    return rows.groupBy("user_id", "island").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"))


@query("SELECT doc_id, i - 1 AS pos, md5(l[i]) AS line, md5(l[i + 1]) AS next_line FROM (SELECT doc_id, l, unnest(range(1, len(l))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))")
def line_pairs(read):
    """Each line with the next: array expressions, so no row is shuffled."""
    lines = F.split("text", "\n")
    rows = read("documents").select("doc_id", lines.alias("l")).select("doc_id", "l", F.posexplode("l").alias("pos", "line")).where(F.col("pos") + 1 < F.size("l"))
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), F.md5(F.col("line").cast("binary")).alias("line"), F.md5(F.get("l", F.col("pos") + 1).cast("binary")).alias("next_line"))


# Incremental state.


@query("SELECT user_id, event_type, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2")
def latest_state(read):
    return incremental.latest(read("events").select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], "ts", "event_id")


NOW_SQL = "(SELECT max(ts) FROM events)"


@query(f"""
WITH s AS (SELECT user_id, max(ts) AS t FROM events GROUP BY 1), n AS (SELECT max(ts) AS now FROM events),
w AS (SELECT c_custkey AS k, t, now, c_nationkey FROM customer LEFT JOIN s ON c_custkey = user_id CROSS JOIN n)
SELECT k::VARCHAR AS record_key, reason = 'complete' AS skip, reason FROM (SELECT k, CASE WHEN t IS NULL THEN 'missing_state' WHEN k % 7 = 0 THEN 'failed' WHEN k % 5 = 0 THEN 'missing_or_changed_file'
  WHEN k % 2 = 0 AND (epoch_us(now) - epoch_us(t)) / 86400e6 >= 2 THEN 'active_year_refresh_due' ELSE 'complete' END AS reason FROM w)""")
def ttl_decision(read):
    e = read("events")
    now = e.agg(F.max("ts").alias("now"))
    states = e.groupBy(F.col("user_id").alias("u")).agg(F.max("ts").alias("t"))
    states = states.select(F.col("u").cast("string").alias("record_key"), F.when(F.col("u") % 7 == 0, "failed").otherwise("complete").alias("status"), F.lit("a").alias("sha256"), F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("last_success_at"))
    wanted = read("customer").select(F.col("c_custkey").cast("string").alias("record_key"), "c_custkey", F.col("c_custkey").cast("string").alias("path")).crossJoin(F.broadcast(now))  # one row
    wanted = wanted.withColumn("year", F.when(F.col("c_custkey") % 2 == 0, F.year("now")).otherwise(F.year("now") - 1).cast("string"))
    files = wanted.select("path", F.when(F.col("c_custkey") % 5 == 0, "b").otherwise("a").alias("sha256"), F.lit(None).cast("timestamp").alias("modified"))
    return incremental.decide_fetch(wanted, states, files, F.col("now"), 2, bootstrap=False).select("record_key", "skip", "reason")


@query("SELECT n_name AS name, n_nationkey AS ord, ((n_nationkey - 20) % 25 + 25) % 25 AS turn FROM nation WHERE n_regionkey <> 0 ORDER BY turn LIMIT 7")
def round_robin(read):
    n = read("nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("ord"), "n_regionkey")
    return incremental.round_robin(n.select("name", "ord"), 20, 7, n.where("n_regionkey = 0"))


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r <= 5")
def keep_last_n(read):
    return incremental.keep_last(read("events").select("user_id", "event_id"), ["user_id"], "event_id", 5)


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at, round((epoch_us(TIMESTAMP '2030-01-01') - epoch_us(date_trunc('second', ts))) / 86400e6, 6) AS age FROM events")
def time_text(read):
    rows = read("events").select("event_id", incremental.iso(F.col("ts")).alias("at"))
    return rows.select("event_id", "at", F.round(incremental.age_days(incremental.parse_time("at"), F.to_timestamp(F.lit("2030-01-01T00:00:00Z"))), 6).alias("age"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(read):
    return read("events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


# Samples.


@query("SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('7:' || doc_id), doc_id) AS r FROM documents) WHERE r <= 8")
def stratified_md5_sample(read):
    return sampling.per_stratum(read("documents").select("doc_id", "lang"), "lang", "doc_id", 8, 7)


@query("""
WITH d AS (SELECT doc_id, lang, source, md5('7:' || doc_id) AS p FROM documents),
a AS (SELECT doc_id, 'risk' AS stratum FROM d WHERE doc_id IN (0, 1, 2)),
b AS (SELECT doc_id, 'german' AS stratum FROM (SELECT * FROM d WHERE lang = 'de' AND doc_id NOT IN (SELECT doc_id FROM a) ORDER BY p, doc_id LIMIT 8)),
c AS (SELECT doc_id, 'first' AS stratum FROM (SELECT * FROM d WHERE source = 'src1' AND doc_id NOT IN (SELECT doc_id FROM a UNION SELECT doc_id FROM b) ORDER BY p, doc_id LIMIT 8)),
t AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c),
f AS (SELECT doc_id, 'fill' AS stratum FROM (SELECT * FROM d WHERE doc_id NOT IN (SELECT doc_id FROM t) ORDER BY p, doc_id LIMIT greatest(0, 40 - (SELECT count(*) FROM t))))
SELECT * FROM t UNION ALL SELECT * FROM f""")
def audit_sample(read):
    rows = read("documents").select("doc_id", "lang", "source")
    out = sampling.stratified(rows, "doc_id", [("german", F.col("lang") == "de", 8), ("first", F.col("source") == "src1", 8)], 40, 7, F.col("doc_id").isin(0, 1, 2))
    return out.select("doc_id", "stratum")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents keyed and merged in order, labelled, and their labels counted."""
    ship(spark)
    rows = keyed(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet")).where("key <> ''")
    merged = merge.fold(rows, ["key"], "doc_id", X.text("text"), lambda a, b: b if len(b) > len(a) + merge.GAIN else a)
    labelled = merged.select(rules.classify(X.lowered("record"), FIXTURE_TOPICS).alias("labels"))
    return facets.label_counts(labelled, "labels").orderBy(F.desc("n"), "value")
