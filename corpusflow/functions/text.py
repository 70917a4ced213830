"""Text functions. All are Spark expressions but for HTML unescaping and NFKC, which
Spark lacks; these two run fused in one Arrow UDF.

White space means Unicode white space and the separators U+001C to U+001F, as in Python."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.packs import MOJIBAKE, NOTE, SYNONYMS

WS = r"(?U)[\s\x1c-\x1f]+"
EDGE_WS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
TAG = r"<[^>]+>"
DASHES = r"[‐-―−]"
#: What case folding turns into ASCII letters and lower() does not.
FOLDS = {"ß": "ss", "ẞ": "ss", "ǰ": "j", "ẖ": "h", "ẗ": "t", "ẘ": "w", "ẙ": "y"}

def text(c: Column | str) -> Column:
    """A string column, null as empty."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once for each row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def nth(items: Column | str, place: int) -> Column:
    """The item at a place from 1, or from -1 backwards; null if there is none."""
    return F.try_element_at(items, F.lit(place))


def strip(c: Column, chars: str | None = None) -> Column:
    """Without white space, or these characters, at both ends."""
    return F.regexp_replace(c, EDGE_WS, "") if chars is None else F.btrim(c, F.lit(chars))


def squash(c: Column | str) -> Column:
    """Runs of white space as one space, none at the ends; null is empty."""
    return F.btrim(F.regexp_replace(text(c), WS, " "), F.lit(" "))


def lowered(c: Column | str) -> Column:
    """Lower case with runs of white space as one space, the ends left as they are."""
    return F.regexp_replace(F.lower(text(c)), WS, " ")


def repair_mojibake(c: Column | str) -> Column:
    out = text(c)
    for bad, good in MOJIBAKE.items():
        out = F.replace(out, F.lit(bad), F.lit(good))
    return out


@F.arrow_udf(T.StringType())
def html_unescape(values: pa.Array) -> pa.Array:
    """Character references decoded, as HTML 5 has them."""
    return pa.array([None if v is None else html.unescape(v) for v in values.to_pylist()], pa.string())


def _prepared(value: str | None) -> str:
    out = html.unescape(value or "")
    for bad, good in MOJIBAKE.items():
        out = out.replace(bad, good)
    return unicodedata.normalize("NFKC", re.sub(TAG, " ", out))


@F.arrow_udf(T.StringType())
def _prepare(values: pa.Array) -> pa.Array:
    return pa.array([_prepared(v) for v in values.to_pylist()], pa.string())


def clean_text(c: Column | str) -> Column:
    """References decoded, mojibake repaired, tags out, NFKC, one kind of dash, white
    space squashed: in this order, so an escaped tag goes too. Null is empty."""
    return squash(F.regexp_replace(_prepare(text(c)), DASHES, "-"))


def clean_title(c: Column | str, cleaned: bool = False) -> Column:
    """clean_text without a bracketed note at the end and without dots and spaces at the
    ends. With cleaned, the text is clean already and no Python runs."""
    return F.btrim(F.regexp_replace(text(c) if cleaned else clean_text(c), NOTE, ""), F.lit(" ."))


def folded(c: Column) -> Column:
    out = c
    for a, b in FOLDS.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.lower(out)


def title_key(c: Column | str, cleaned: bool = False) -> Column:
    """The key under which titles are the same paper: ASCII words of the folded clean title, with
    spellings of the domain's name made one. Titles without any have the key ''."""
    out = folded(clean_title(c, cleaned))
    for pattern, word in SYNONYMS:
        out = F.regexp_replace(out, pattern, word)
    return F.array_join(F.regexp_extract_all(out, F.lit("[a-z0-9]+"), F.lit(0)), " ")


def tags_then_references(c: Column | str) -> Column:
    """Tags out, then references decoded: an escaped tag stays as text."""
    return squash(html_unescape(F.regexp_replace(text(c), TAG, " ")))


def references_then_tags(c: Column | str) -> Column:
    """References decoded, then tags out: an escaped tag goes."""
    return squash(F.regexp_replace(html_unescape(text(c)), TAG, " "))


def clean_html(c: Column | str) -> Column:
    """Text of markup: scripts and styles out with their bodies, then tags, then references."""
    bare = F.regexp_replace(text(c), r"(?is)<(script|style)\b[^>]*>.*?</\1>", " ")
    return tags_then_references(bare)


def simple_key(c: Column | str) -> Column:
    """Lower-case ASCII words, without the synonyms of title_key."""
    return F.btrim(F.regexp_replace(F.lower(clean_html(c)), "[^a-z0-9]+", " "), F.lit(" "))


def listed_title(c: Column | str, cleaned: bool = False, least: int = 8) -> Column:
    """A title of a list page: no leading number, no single capital, no bracketed note;
    '' if fewer than least characters are left."""
    out = text(c) if cleaned else references_then_tags(c)
    out = F.regexp_replace(out, r"(?U)^\d+\s*[|.)-]\s*", "")
    out = F.regexp_replace(out, r"^[A-Z]\s*$", "")
    out = F.regexp_replace(out, r"(?U)\s*\[[^\]]*(?:Experiments|Analysis|Vision|Systems)[^\]]*\]\s*$", "")
    out = F.btrim(out, F.lit(" :-"))
    return F.when(F.length(out) < least, F.lit("")).otherwise(out)


def listed_authors(c: Column | str, cleaned: bool = False, commas: bool = True) -> Column:
    """Names joined by ' and ', of a list split at semicolons, 'and' and, by default, commas."""
    out = text(c) if cleaned else references_then_tags(c)
    out = F.regexp_replace(F.regexp_replace(out, r"(?iU)\bDOI:\s*\S+", ""), r"\([^)]*\)", "")
    parts = F.split(F.replace(out, F.lit("*"), F.lit("")), r"(?U);|\band\b" + ("|," if commas else ""))
    return F.array_join(F.filter(F.transform(parts, lambda p: F.btrim(p, F.lit(' ,"'))), lambda p: p != ""), " and ")


def doi(c: Column | str, decode: bool = False) -> Column:
    """The DOI in a text or link, '' if none. With decode, percent-escapes are decoded first; a plus sign stays."""
    out = squash(c)
    if decode:
        out = F.coalesce(F.try_url_decode(F.replace(out, F.lit("+"), F.lit("%2B"))), out)
    out = F.regexp_replace(F.regexp_replace(out, r"(?iU)^doi:\s*", ""), r"(?i)^https?://(?:dx\.)?doi\.org/", "")
    return F.rtrim(F.regexp_extract(out, r"(?iU)(10\.\d{4,9}/[^\s\"<>]+)", 1), F.lit(".,;:)]}"))


def first_doi(columns: list[Column | str]) -> Column:
    """The DOI of the first of these fields that holds one, '' if none does."""
    found = F.filter(F.array(*[doi(c, decode=True) for c in columns]), lambda d: d != "")
    return F.coalesce(F.get(found, F.lit(0)), F.lit(""))


def with_doi(rows: DataFrame, columns: tuple[str, ...] = ("doi", "url", "ee", "paper_url")) -> DataFrame:
    """rows with doi filled, where it is empty, by the first DOI in these columns (those that rows have), and doi_id, that DOI as
    batch interfaces name it, '' if there is none."""
    found = first_doi([c for c in columns if c in rows.columns])
    out = rows.withColumn("__doi", found)
    return out.withColumns({"doi": F.when(text("doi") == "", F.col("__doi")).otherwise(F.col("doi")), "doi_id": F.when(F.col("__doi") != "", F.concat(F.lit("DOI:"), "__doi")).otherwise("")}).drop("__doi")


def slug(c: Column | str, most: int = 80) -> Column:
    return F.substring(F.btrim(F.regexp_replace(F.lower(text(c)), "[^a-z0-9]+", "-"), F.lit("-")), 1, most)


def lines(c: Column | str) -> Column:
    """Non-empty lines of markup: breaks and ends of blocks end a line."""
    out = F.regexp_replace(text(c), r"(?i)<\s*br\s*/?\s*>|</(?:h[1-6]|p|li|td|tr|div)>", "\n")
    out = html_unescape(F.regexp_replace(out, TAG, " "))
    parts = F.transform(F.split(out, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), lambda x: F.btrim(F.regexp_replace(x, WS, " "), F.lit(" ")))
    return F.filter(parts, lambda x: x != "")


def inverted_text(c: Column | str) -> Column:
    """The text of an inverted index, map of word to positions; words at one position in order of the words."""
    entries = F.map_entries(F.col(c) if isinstance(c, str) else c)
    placed = F.flatten(F.transform(entries, lambda e: F.transform(e["value"], lambda at: F.struct(at.alias("at"), e["key"].alias("word")))))
    return F.coalesce(F.array_join(F.transform(F.array_sort(placed), lambda p: p["word"]), " "), F.lit(""))


def escape_html(c: Column | str) -> Column:
    out = text(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def path_year(c: Column | str) -> Column:
    """The year that is a folder of a path, else the first in the file's name, else ''."""
    parts = F.split(F.replace(text(c), F.lit("\\"), F.lit("/")), "/")
    folder = nth(F.filter(parts, lambda p: p.rlike(r"^20\d{2}$")), 1)
    return F.coalesce(folder, F.regexp_extract(nth(parts, -1), r"(20\d{2})", 1))
