"""Raw records from JSON, CSV, BibTeX, conference HTML, DBLP XML, Atom and API JSON.

Readers take whole files as rows (path, content), so files are the unit of parallel work, and return
rows (path, pos, map_key, fields of RAW): pos is the record's place in its file. Of records of a file
with the same title the last counts, in the place of the first. A field that a record lacks is null, an
empty one is ''; defaults apply to null only."""

from __future__ import annotations

import html
import re
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions import text as X
from corpusflow.functions.venues import base_name, file_venue
from corpusflow.packs import ACL_ABSTRACT, ACL_TITLE, DBLP_WRAPPERS, NDSS, VENUES, VenuePack
from corpusflow.schema import BASE_FIELDS, FIELDS, OPTIONAL_FIELDS, RAW

EXTENSIONS = ("bib", "json", "csv", "html", "htm")


def load_baseline(spark: SparkSession, path: str, pack: VenuePack = VENUES) -> tuple[DataFrame, str]:
    """Records of an earlier collection and '', or none and a warning if it can't be read. A collection from
    before a change is a folder or file that the caller exported."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        none = spark.createDataFrame([], "path string, content string")
        return parse_json(none, pack), f"baseline unavailable: {path}"
    return parse_files(spark, path, pack=pack), ""


def read_files(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, content, modified, sha256) of every file below the paths with a known extension."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    known = files.where(F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1)).isin(*EXTENSIONS) & ~F.col("path").rlike(r"/fetch_failures\.json$"))
    return known.select("path", F.decode("content", "UTF-8").alias("content"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))


def supplemental(files: DataFrame) -> DataFrame:
    """Files of the supplemental source only."""
    return files.where(X.nth(F.split("path", "/"), -1).rlike(r"^openalex(?:\.json$|-)"))


def normalize(e: dict[str, Column], title: Column, venue: Column, year: Column) -> dict[str, Column]:
    """The columns of a record from its raw fields (null: absent) with a title, venue and year to fall back on."""
    own = lambda name, default: F.coalesce(e[name], default)
    none = F.lit("")
    out = {
        "type": own("type", F.lit("INPROCEEDINGS")), "key": own("key", none), "author": own("author", none), "booktitle": own("booktitle", venue),
        "title": X.squash(F.when(X.text(e["title"]) != "", e["title"]).otherwise(title)), "year": own("year", F.coalesce(year, none)),
        "abstract": X.squash(e["abstract"]), "keywords": own("keywords", none), "url": F.coalesce(e["url"], e["doi"], none), "doi": own("doi", none),
        "venue": own("venue", venue), "venue_track": own("venue_track", none),
    }
    bare = (out["doi"] != "") & (out["url"] == out["doi"]) & ~out["url"].startswith("http")
    out["url"] = F.when(bare, F.concat(F.lit("https://doi.org/"), out["doi"])).otherwise(out["url"])
    return out | {n: F.when(e[n] != "", e[n]) for n in OPTIONAL_FIELDS}


def named(files: DataFrame, pack: VenuePack, path: str = "path") -> DataFrame:
    """files with __venue and __year, what their names say: found once for a file, before its records become rows."""
    return files.withColumns({"__venue": file_venue(F.col(path), pack), "__year": X.path_year(F.col(path))})


def _records(rows: DataFrame, pack: VenuePack) -> DataFrame:
    """From (path, __venue, __year, pos, map_key, e: RAW) to normalized records, one for each title of a file."""
    fields = normalize({f: F.col("e")[f] for f in FIELDS}, F.col("map_key"), F.col("__venue"), F.col("__year"))
    out = rows.select("path", "pos", "map_key", *[fields[f].alias(f) for f in FIELDS]).where("title <> ''")
    return last_of_each(out, ["path", "title"], "pos")


def last_of_each(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of rows with equal keys the last, in the place of the first; a map-side combined aggregate."""
    rest = [c for c in rows.columns if c not in (*keys, order)]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__r"), F.min(order).alias(order))
    return best.select(*[F.col(c) if c in (*keys, order) else F.col("__r")[c].alias(c) for c in rows.columns])


def parse_json(files: DataFrame, pack: VenuePack = VENUES) -> DataFrame:
    """Records of an object of title to record, or of a list of records. What isn't JSON, or
    isn't an object within, has no rows."""
    trimmed = F.ltrim(X.text("content"))
    # A list is read as an object too, so one parse serves both shapes.
    shaped = F.when(trimmed.startswith("["), F.concat(F.lit('{"l":'), F.col("content"), F.lit("}"))).otherwise(F.concat(F.lit('{"m":'), F.col("content"), F.lit("}")))
    # Records are parsed one by one, so one that is no object spoils no other.
    parsed = named(files, pack).withColumn("__j", F.from_json(shaped, "struct<m:map<string,string>,l:array<string>>"))
    entry = lambda key, text: F.struct(key.alias("key"), F.when(F.ltrim(text).startswith("{"), F.from_json(text, RAW)).alias("value"))
    mapped = F.transform(F.map_entries("__j.m"), lambda kv: entry(kv["key"], kv["value"]))
    listed = F.transform(F.col("__j.l"), lambda text: entry(F.coalesce(F.get_json_object(text, "$.title"), F.lit("")), text))
    rows = parsed.select("path", "__venue", "__year", F.posexplode(F.coalesce(mapped, listed)).alias("pos", "kv"))
    return _records(rows.where("kv.value IS NOT NULL").select("path", "__venue", "__year", F.col("pos").cast("long").alias("pos"), F.col("kv.key").alias("map_key"), F.col("kv.value").alias("e")), pack)


BRACED = r"(\w+)\s*=\s*\{((?:[^{}]++|\{[^{}]*+\})*+)\}"
QUOTED = r'(\w+)\s*=\s*"([^"]*+)"'


def parse_bib(files: DataFrame, pack: VenuePack = VENUES) -> DataFrame:
    """Records of BibTeX: braced values with one level of braces within, then quoted values,
    which count more. Chunks without a head are skipped."""
    chunk = F.regexp_replace(F.col("chunk"), r"(?U)^[\s@]+|\s+$", "")
    rows = named(files, pack).select("path", "__venue", "__year", F.posexplode(F.split(X.text("content"), "\n@")).alias("pos", "chunk")).withColumn("chunk", F.concat(F.lit("@"), chunk))
    rows = rows.where(F.col("chunk").rlike(r"^@\w+\s*\{[^,]*,"))
    pairs = lambda pattern: F.arrays_zip(F.regexp_extract_all("chunk", F.lit(pattern), F.lit(1)).alias("k"), F.regexp_extract_all("chunk", F.lit(pattern), F.lit(2)).alias("v"))
    both = F.concat(pairs(BRACED), pairs(QUOTED))
    value = lambda name: X.nth(F.filter(F.col("pairs"), lambda p: F.lower(p["k"]) == name), -1)["v"]
    rows = rows.withColumn("pairs", F.transform(both, lambda p: F.struct(p["k"].alias("k"), X.squash(F.translate(p["v"], "{}", "")).alias("v"))))
    head = {"type": F.upper(F.regexp_extract("chunk", r"^@(\w+)", 1)), "key": F.btrim(F.regexp_extract("chunk", r"^@\w+\s*\{([^,]*),", 1))}
    found = lambda f: F.when(F.size(F.filter(F.col("pairs"), lambda p: F.lower(p["k"]) == f)) > 0, value(f))
    e = F.struct(*[(F.coalesce(found(f), head[f]) if f in head else found(f)).alias(f) for f in FIELDS])
    return _records(rows.select("path", "__venue", "__year", F.col("pos").cast("long").alias("pos"), F.lit("").alias("map_key"), e.alias("e")), pack)


def read_csv(spark: SparkSession, path: str, pack: VenuePack = VENUES) -> DataFrame:
    """Records of CSV files with a header; names of columns in any case. An empty cell is '', a
    missing column null."""
    rows = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').option("nullValue", "\0").option("emptyValue", "").csv(path)
    rows = rows.toDF(*[c.lower() for c in rows.columns])
    e = F.struct(*[(F.coalesce(rows[f], F.lit("")) if f in rows.columns else F.lit(None).cast("string")).alias(f) for f in FIELDS])
    place = F.monotonically_increasing_id()
    found = rows.select(F.col("_metadata.file_path").alias("path"), place.alias("pos"), F.lit("").alias("map_key"), e.alias("e"))
    return _records(named(found, pack), pack)


@F.pandas_udf(T.ArrayType(T.StringType()))
def unescape_each(values: pd.Series) -> pd.Series:
    """References decoded in every string of an array."""
    return values.map(lambda v: None if v is None else [None if x is None else html.unescape(x) for x in v])


def _from_arrays(files: DataFrame, titles: Column, urls: Column, abstracts: Column | None, pack: VenuePack, before: Column | None = None) -> DataFrame:
    """Records whose titles (and abstracts) are markup and whose arrays run in parallel."""
    plain = lambda a: F.transform(a, lambda x: F.regexp_replace(F.coalesce(x, F.lit("")), X.TAG, " "))
    rows = named(files, pack).select("path", "__venue", "__year", plain(titles).alias("t"), urls.alias("u"), (plain(abstracts) if abstracts is not None else F.transform(titles, lambda _: F.lit(""))).alias("a"))
    rows = rows.select("path", "__venue", "__year", F.posexplode(F.arrays_zip(unescape_each("t").alias("t"), F.col("u").alias("u"), unescape_each("a").alias("a"))).alias("pos", "r"))
    values = {"type": F.lit("INPROCEEDINGS"), "title": X.squash(F.col("r.t")), "abstract": F.col("r.a"), "url": F.col("r.u"), "venue": F.col("__venue"), "booktitle": F.col("__venue"), "year": F.col("__year")}
    e = F.struct(*[values.get(f, F.lit(None).cast("string")).alias(f) for f in FIELDS])
    return _records(rows.where("r.a IS NOT NULL").select("path", "__venue", "__year", F.col("pos").cast("long").alias("pos"), F.lit("").alias("map_key"), e.alias("e")), pack)


ACL_ENTRY = rf"(?s){ACL_TITLE}([^\s>]+)[^>]*>(.*?)</a></strong>(.*?)(?={ACL_TITLE}|\z)"


def parse_acl_html(files: DataFrame, pack: VenuePack = VENUES) -> DataFrame:
    """Each title with the first abstract between it and the next title; titles without are left out."""
    part = lambda k: F.regexp_extract_all(X.text("content"), F.lit(ACL_ENTRY), F.lit(k))
    url = F.transform(part(1), lambda u: F.btrim(u, F.lit("\"' \t\r\n")))
    url = F.transform(url, lambda u: F.when(u.startswith("http") | (u == ""), u).otherwise(F.concat(F.lit("https://aclanthology.org"), u)))
    abstract = F.transform(part(3), lambda body: F.when(body.rlike(ACL_ABSTRACT), F.regexp_extract(body, ACL_ABSTRACT, 1)))
    rows = files.withColumn("__z", F.filter(F.arrays_zip(part(2).alias("t"), url.alias("u"), abstract.alias("a")), lambda z: z["a"].isNotNull()))
    return _from_arrays(rows, F.col("__z.t"), F.col("__z.u"), F.col("__z.a"), pack)


def parse_ndss_html(files: DataFrame, pack: VenuePack = VENUES) -> DataFrame:
    """Titles and links by the first pattern that finds any; the group that is a link tells the order."""
    zipped = [F.arrays_zip(*[F.regexp_extract_all(X.text("content"), F.lit(p), F.lit(k)).alias(n) for k, n in ((1, "a"), (2, "b"))]) for p in NDSS]
    link_first = lambda z: z["a"].startswith("http")
    rows = files.withColumn("__z", F.when(F.size(zipped[0]) > 0, zipped[0]).otherwise(zipped[1]))
    titles = F.transform("__z", lambda z: F.when(link_first(z), z["b"]).otherwise(z["a"]))
    return _from_arrays(rows, titles, F.transform("__z", lambda z: F.when(link_first(z), z["a"]).otherwise(X.strip(z["b"]))), None, pack)


def html_format(path: Column, content: Column) -> Column:
    """acl, ndss or null by the marks that a page has, wherever they stand."""
    head = F.lower(content)
    acl = F.contains(head, F.lit("acl anthology")) | F.contains(head, F.lit("aclanthology")) | F.contains(head, F.lit("align-middle"))
    ndss = F.contains(F.lower(path), F.lit("ndss")) | F.contains(head, F.lit("ndss symposium")) | F.contains(head, F.lit("pt-cv-title"))
    return F.when(acl, "acl").when(ndss, "ndss")


def parse_html(files: DataFrame, pack: VenuePack = VENUES) -> DataFrame:
    """Records of HTML of either format; a file of neither is an error."""
    kind = html_format(F.col("path"), F.col("content"))
    files = files.withColumn("__f", F.coalesce(kind, F.raise_error(F.concat(F.lit("no known HTML format: "), F.col("path"))).cast("string")))
    return parse_acl_html(files.where("__f = 'acl'"), pack).unionByName(parse_ndss_html(files.where("__f = 'ndss'"), pack))


def parse_files(spark: SparkSession, *paths: str, pack: VenuePack = VENUES) -> DataFrame:
    """Records of all files below the paths, by extension; CSV files are read by read_csv."""
    files = read_files(spark, *paths)
    of = lambda *ends: files.where(F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1)).isin(*ends))
    return parse_json(of("json"), pack).unionByName(parse_bib(of("bib"), pack)).unionByName(parse_html(of("html", "htm"), pack))


def combine_accepted(records: DataFrame) -> DataFrame:
    """Of records of several files with one title that of the last file, in the place of the first; files in order of their paths."""
    placed = records.withColumn("__at", F.struct("path", "pos"))
    return last_of_each(placed.drop("path", "pos"), ["title"], "__at").withColumns({"path": F.col("__at.path"), "pos": F.col("__at.pos")}).drop("__at")


def first_and_last(records: DataFrame, key: str = "map_key") -> DataFrame:
    """The two tie rules of a crawl: of one key the first counts; then of one raw title the last."""
    w = Window.partitionBy(key).orderBy("path", "pos")
    first = records.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    return combine_accepted(first)


DBLP_PARSED = T.StructType([T.StructField(f, T.StringType()) for f in ("type", "key", "author", "booktitle", "journal", "title", "year", "url", "doi")])
WRAPPERS = re.compile(rf"<\?xml[^>]*>|<!DOCTYPE[^>]*>|</?(?:{'|'.join(DBLP_WRAPPERS)})[^>]*>")


def dblp_records(xml: str | None, venue: str | None, year: str | None) -> list[dict]:
    """Publications of a DBLP page that are of the year or have none. Titles may hold
    markup, whose text counts, so Spark's XML reader doesn't do. Broken XML has none."""
    try:
        root = ET.fromstring(f"<all>{WRAPPERS.sub('', xml or '')}</all>")
    except ET.ParseError:
        return []

    def all_text(node: ET.Element, tag: str) -> list[str]:
        return [" ".join("".join(e.itertext()).split()) for e in node.findall(tag)]

    def first(node: ET.Element, tag: str) -> str:
        return next(iter(all_text(node, tag)), "")

    out = []
    for node in (e for e in root.iter() if e.tag in ("inproceedings", "article")):
        title, own_year = " ".join(all_text(node, "title")), first(node, "year") or str(year)
        if own_year != str(year) or not title:
            continue
        link, doi = first(node, "ee"), first(node, "doi")
        out.append({
            "type": node.tag.upper(), "key": node.get("key", ""), "author": " and ".join(a for a in all_text(node, "author") if a),
            "booktitle": first(node, "booktitle" if node.find("booktitle") is not None else "journal") if node.find("booktitle") is not None or node.find("journal") is not None else venue or "",
            "journal": first(node, "journal"), "title": title, "year": own_year, "doi": doi, "url": link or (f"https://doi.org/{doi}" if doi else ""),
        })
    return out


@F.pandas_udf(T.ArrayType(DBLP_PARSED))
def _dblp(xml: pd.Series, venue: pd.Series, year: pd.Series) -> pd.Series:
    return pd.Series([dblp_records(x, v, y) for x, v, y in zip(xml, venue, year, strict=True)])


def parse_dblp(pages: DataFrame) -> DataFrame:
    """(path, pos, map_key, RAW fields) from (path, content, venue, year, track): publications of the year."""
    rows = pages.select("path", "venue", "year", "track", F.posexplode(_dblp("content", "venue", "year")).alias("pos", "e"))
    parsed = ("type", "key", "author", "booktitle", "journal", "title", "year", "url", "doi")
    values = {f: F.col("e")[f] if f in parsed else F.lit("") if f in BASE_FIELDS else F.lit(None).cast("string") for f in FIELDS}
    values |= {"venue": F.concat("venue", "year"), "venue_track": F.col("track"), "journal": F.when(F.col("e.journal") != "", F.col("e.journal"))}
    return rows.select("path", F.col("pos").cast("long").alias("pos"), F.col("e.title").alias("map_key"), *[values[f].alias(f) for f in FIELDS])


ATOM_ENTRY = r"(?s)<entry\b[^>]*>(.*?)</entry>"


def parse_atom(pages: DataFrame) -> DataFrame:
    """(path, pos, RAW fields) of an Atom feed's entries: year of publication, first alternate link."""
    rows = pages.select("path", F.posexplode(F.regexp_extract_all(X.text("content"), F.lit(ATOM_ENTRY), F.lit(1))).alias("pos", "x"))
    one = lambda tag: X.squash(X.html_unescape(F.regexp_extract("x", rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>", 1)))
    names = F.array_join(F.transform(F.regexp_extract_all("x", F.lit(r"(?s)<name>(.*?)</name>"), F.lit(1)), X.squash), " and ")
    link = X.nth(F.filter(F.regexp_extract_all("x", F.lit(r"<link\b([^>]*)>"), F.lit(1)), lambda a: F.contains(a, F.lit('rel="alternate"'))), 1)
    values = {
        "type": F.lit("ARTICLE"), "key": F.regexp_extract(one("id"), r"([^/]+)$", 1), "author": X.html_unescape(names), "title": one("title"), "year": F.substring(one("published"), 1, 4),
        "abstract": one("summary"), "url": F.coalesce(F.regexp_extract(link, r'href="([^"]*)"', 1), F.lit("")), "booktitle": F.lit("arXiv"), "venue": F.lit("ArXiv"), "source": F.lit("arXiv"),
    }
    return rows.select("path", F.col("pos").cast("long").alias("pos"), *[values.get(f, F.lit("") if f in BASE_FIELDS else F.lit(None).cast("string")).alias(f) for f in FIELDS]).where("title <> ''")


WORK = "struct<id:string,doi:string,title:string,display_name:string,publication_year:int,type:string,type_crossref:string,abstract_inverted_index:map<string,array<int>>,primary_location:struct<landing_page_url:string,pdf_url:string,source:struct<display_name:string>>,best_oa_location:struct<landing_page_url:string>,host_venue:struct<display_name:string>,authorships:array<struct<author:struct<display_name:string>>>,keywords:array<struct<display_name:string>>>"
S2 = "struct<paperId:string,title:string,abstract:string,year:int,venue:string,url:string,externalIds:struct<DOI:string>,authors:array<struct<name:string>>>"


def parse_works(pages: DataFrame) -> DataFrame:
    """(path, pos, RAW fields) of API pages with a list called results: nested fields become a record."""
    page = F.from_json(X.text("content"), f"struct<results:array<{WORK}>>")
    rows = pages.select("path", F.posexplode(page["results"]).alias("pos", "w"))
    w = lambda path: F.col(f"w.{path}")
    filled = lambda *cs: F.coalesce(*[F.when(c != "", c) for c in cs], F.lit(""))
    source = filled(w("primary_location.source.display_name"), w("host_venue.display_name"), w("type_crossref"))
    values = {
        "type": F.when(w("type") == "article", "ARTICLE").otherwise("INPROCEEDINGS"), "key": w("id"), "author": F.array_join(F.filter(w("authorships.author.display_name"), lambda x: x != ""), " and "),
        "booktitle": source, "title": X.squash(filled(w("title"), w("display_name"))), "year": F.coalesce(w("publication_year").cast("string"), F.lit("")), "abstract": X.inverted_text(w("abstract_inverted_index")),
        "keywords": F.array_join(w("keywords.display_name"), ", "), "url": filled(w("primary_location.landing_page_url"), w("best_oa_location.landing_page_url"), w("doi"), w("id")), "doi": X.doi(w("doi")),
        "venue": source, "source": source, "openalex_id": w("id"),
    }
    return rows.select("path", F.col("pos").cast("long").alias("pos"), *[F.coalesce(values.get(f, F.lit(None).cast("string")), F.lit("") if f in BASE_FIELDS else F.lit(None).cast("string")).alias(f) for f in FIELDS]).where("title <> ''")


def parse_s2(pages: DataFrame) -> DataFrame:
    """(path, pos, RAW fields) of API pages with a list called data; papers without an abstract are left out."""
    page = F.from_json(X.text("content"), f"struct<data:array<{S2}>>")
    rows = pages.select("path", F.posexplode(page["data"]).alias("pos", "p"))
    doi = X.doi(F.col("p.externalIds.DOI"))
    values = {
        "type": F.lit("INPROCEEDINGS"), "key": F.col("p.paperId"), "author": F.array_join(F.filter(F.col("p.authors.name"), lambda x: x != ""), " and "), "booktitle": X.text("p.venue"), "title": X.squash("p.title"),
        "year": F.coalesce(F.col("p.year").cast("string"), F.lit("")), "abstract": X.squash("p.abstract"), "url": F.coalesce(F.when(F.col("p.url") != "", F.col("p.url")), F.when(doi != "", F.concat(F.lit("https://doi.org/"), doi)), F.lit("")),
        "doi": doi, "venue": X.text("p.venue"), "semantic_scholar_id": F.col("p.paperId"),
    }
    out = rows.select("path", F.col("pos").cast("long").alias("pos"), *[F.coalesce(values.get(f, F.lit(None).cast("string")), F.lit("") if f in BASE_FIELDS else F.lit(None).cast("string")).alias(f) for f in FIELDS])
    return out.where("title <> '' AND abstract <> ''")


def paged(responses: DataFrame, most: int | None = None, needed: bool = False) -> DataFrame:
    """(source, page, pos, item) of the pages that a crawl by cursor reads: responses has (source, page from 0, content), the
    answers in the order in which they were asked for; item is the text of an entry of its list `results`.

    A source ends with its first page that is empty, names no next cursor or is missing; of what is left the first `most` items count. With
    needed, a source without any item is an error when the rows are read. What isn't JSON is an empty page."""
    page = F.from_json(X.text("content"), "struct<results:array<string>,meta:struct<next_cursor:string>>")
    rows = responses.select("source", F.col("page").cast("long").alias("page"), F.coalesce(page["results"], F.array().cast("array<string>")).alias("items"), X.text(page["meta"]["next_cursor"]).alias("next"))
    # Pages of a source are few and narrow here: their items come back afterwards.
    order = Window.partitionBy("source").orderBy("page")
    pages = rows.select("source", "page", F.size("items").alias("n"), ((F.size("items") == 0) | (F.col("next") == "")).alias("last"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    pages = pages.withColumns({"ended": F.coalesce(F.max("last").over(before), F.lit(False)), "before": F.coalesce(F.sum("n").over(before), F.lit(0)), "turn": F.row_number().over(order) - 1})
    if needed:
        empty = F.raise_error(F.concat(F.lit("no items: "), F.col("source").cast("string"))).cast("boolean")
        pages = pages.where(F.when((F.col("turn") == 0) & (F.col("n") == 0), empty).otherwise(True))
    pages = pages.where(~F.col("ended") & (F.col("turn") == F.col("page"))).select("source", "page", "before")
    out = rows.join(pages, ["source", "page"]).select("source", "page", "before", F.posexplode("items").alias("pos", "item"))
    if most is not None:
        out = out.where(F.col("before") + F.col("pos") < most)
    return out.select("source", "page", F.col("pos").cast("long").alias("pos"), "item")


def raw_evidence(files: DataFrame, pack: VenuePack = VENUES) -> DataFrame:
    """(key, target, raw_title, path, booktitle, journal, year, ord) as joins.reconcile() takes it: the records of raw JSON
    files whose names say a known venue. Files that are lists, and titles without a key, prove nothing."""
    mapped = files.where(F.ltrim(X.text("content")).startswith("{"))
    known = named(mapped, pack).withColumn("target", base_name(F.col("__venue"), pack)).where(F.col("target").isin(pack.known))
    # Files are few beside their records; a file's target meets these by its path.
    targets = known.select("path", "target").distinct()
    rows = parse_json(known.select(*mapped.columns), pack).join(targets, "path")
    out = rows.select(X.title_key("title").alias("key"), "target", F.col("title").alias("raw_title"), "path", "booktitle", "journal", "year", F.col("pos").alias("ord"))
    return out.where("key <> ''")


def union_of(volumes: list[DataFrame]) -> DataFrame:
    """The rows of all volumes of a journal; an error only if all are empty."""
    out = volumes[0]
    for df in volumes[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    if out.isEmpty():
        raise ValueError("all volumes are empty")
    return out


def cascade(sources: dict[str, DataFrame], keys: list[str], union_for: Column) -> DataFrame:
    """For each key the rows of the first source that has any; where union_for holds, those of all."""
    tagged = [df.withColumn("__rank", F.lit(i)) for i, df in enumerate(sources.values())]
    rows = tagged[0]
    for df in tagged[1:]:
        rows = rows.unionByName(df, allowMissingColumns=True)
    best = rows.groupBy(*keys).agg(F.min("__rank").alias("__best"))
    return rows.join(best, keys).where(union_for | (F.col("__rank") == F.col("__best"))).drop("__rank", "__best")


def venue_grid(spark: SparkSession, table: dict[str, dict[str, str]], years: tuple[int, int], odd: dict[str, list[int]] | None = None, tracks: list[str] | None = None, bounds: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    """(track, venue, dblp, year): every venue of the tracks in its years within the bounds."""
    wanted = {t.lower() for t in tracks} if tracks else None
    rows = [(t, v, d) for t, own in table.items() for v, d in own.items() if wanted is None or t.lower() in wanted]
    grid = spark.createDataFrame(rows, "track string, venue string, dblp string").withColumn("years", F.sequence(F.lit(years[0]), F.lit(years[1])))
    for venue, own in (odd or {}).items():
        grid = grid.withColumn("years", F.when(F.col("venue") == venue, F.array(*map(F.lit, own))).otherwise(F.col("years")))
    grid = grid.withColumn("year", F.explode("years")).drop("years")
    low, high = bounds
    return grid.where((F.col("year") >= low if low is not None else F.lit(True)) & (F.col("year") <= high if high is not None else F.lit(True)))


def year_links(content: Column, year: Column, base: Column) -> Column:
    """Distinct links of an index page that hold the year and end in .html, as .xml, in order."""
    links = F.filter(F.regexp_extract_all(X.text(content), F.lit('href="([^"]+)"'), F.lit(1)), lambda u: F.contains(u, year) & u.endswith(".html"))
    root = F.regexp_extract(base, r"^(https?://[^/]+)", 1)
    whole = F.transform(links, lambda u: F.when(u.startswith("http"), u).when(u.startswith("/"), F.concat(root, u)).otherwise(F.concat(F.regexp_replace(base, r"[^/]*$", ""), u)))
    return F.array_distinct(F.transform(whole, lambda u: F.regexp_replace(u, r"\.html$", ".xml")))


#: Journals whose volume is the year plus a constant.
JOURNAL_VOLUMES = {"tse": ("tse", -1974), "tosem": ("tosem", -1991), "tkde": ("tkde", -1988), "vldb": ("vldb", -1991), "pvldb": ("pvldb", -2007)}


def volume_link(journal: Column, year: Column, table: dict[str, tuple[str, int]] = JOURNAL_VOLUMES) -> Column:
    """The page of a journal's volume of the year, null for journals that the table lacks."""
    out = F.lit(None).cast("string")
    for name, (stem, offset) in table.items():
        out = F.when(journal == name, F.concat(F.lit(f"https://dblp.org/db/journals/{name}/{stem}"), (year + offset).cast("string"), F.lit(".xml"))).otherwise(out)
    return out
