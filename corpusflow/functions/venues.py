"""Venues: alias tables compiled to one CASE, longest alias first."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow import packs
from corpusflow.functions.text import let, nth, text
from corpusflow.packs import VENUES, VenuePack
from corpusflow.schema import LINK_FIELDS, SOURCE_FIELDS

SHORT = re.compile("[a-z&]{1,4}")


def has_alias(c: Column, alias: str) -> Column:
    """Short letter-only aliases match as words, others anywhere."""
    return c.rlike(f"(?<![a-z0-9]){re.escape(alias)}(?![a-z0-9])") if SHORT.fullmatch(alias) else F.contains(c, F.lit(alias))


def first_alias(c: Column, aliases: dict[str, list[str]]) -> Column:
    """The name whose longest alias a lowered text has, '' if none. Aliases of one length keep their order."""
    ordered = sorted(((a, name) for name, own in aliases.items() for a in own), key=lambda x: -len(x[0]))
    out = None
    for alias, name in ordered:
        out = (F if out is None else out).when(has_alias(c, alias), F.lit(name))
    return F.lit("") if out is None else out.otherwise(F.lit(""))


def _side_volume(c: Column, pack: VenuePack) -> Column:
    name, mark, long_name = pack.side_volume
    return F.contains(c, F.lit(mark)) & (F.contains(c, F.lit(long_name)) | has_alias(c, name.lower()))


def base_name(c: Column | str, pack: VenuePack = VENUES) -> Column:
    """A stored venue without year and suffix if it is a known one, else the preprint server or other."""
    raw = F.regexp_replace(text(c), r"(?U)^\s+|\s+$", "")
    bare = F.regexp_replace(F.regexp_replace(raw, r"(?U)\s*20\d{2}$", ""), r"20\d{2}$", "")
    bare = F.btrim(F.regexp_replace(bare, r"(?i)[-_ ]?(?:main|findings|short|long|demo|industry)$", ""), F.lit(" -_"))
    return F.when(F.contains(F.lower(raw), F.lit(pack.preprint_mark)), pack.preprint).when(bare.isin(pack.known), bare).otherwise(pack.other)


def name_with_year(c: Column | str, year: Column | str = "", pack: VenuePack = VENUES) -> Column:
    """The known venue that a free text names, with a year appended if given."""
    year = F.lit(year) if isinstance(year, str) else text(year)

    def named(low: Column, found: Column) -> Column:
        return (
            F.when(F.contains(low, F.lit(pack.preprint_mark)), F.concat(F.lit(pack.preprint), year))
            .when(_side_volume(low, pack), pack.other)
            .when(found != "", F.concat(found, year))
            .otherwise(pack.other)
        )

    return let(F.lower(text(c)), lambda low: let(first_alias(low, pack.aliases), lambda found: named(low, found)))


def _joined(fields: dict[str, Column], names: tuple[str, ...]) -> Column:
    return F.lower(F.concat_ws(" ", *[text(fields[n]) if n in fields else F.lit("") for n in names]))


def entry_venue(fields: dict[str, Column], pack: VenuePack = VENUES) -> Column:
    """The venue of a record, in order of trust: what its source names, preprint marks, its
    links, the stored venue. A stored venue that needs proof counts with it only."""
    source, link, stored = _joined(fields, SOURCE_FIELDS), _joined(fields, LINK_FIELDS), F.lower(text(fields["venue"]) if "venue" in fields else F.lit(""))
    old = base_name(fields["venue"] if "venue" in fields else F.lit(""), pack)
    name, mark, _ = pack.side_volume
    decided = lambda source, by_source, by_link: (
        F.when((by_source == name) & F.contains(source, F.lit(mark)), pack.other)
        .when(by_source != "", by_source)
        .when(F.contains(source, F.lit(pack.preprint_mark)), pack.preprint)
        .when(by_link != "", by_link)
        .when(_side_volume(stored, pack) | (old == pack.unproven), pack.other)
        .otherwise(old)
    )
    each = F.struct(source.alias("s"), link.alias("l"))
    found = lambda e: F.struct(e["s"].alias("s"), first_alias(e["s"], pack.aliases).alias("a"), first_alias(e["l"], pack.links).alias("b"))
    return let(each, lambda e: let(found(e), lambda f: decided(f["s"], f["a"], f["b"])))


def proven_by_source(fields: dict[str, Column], pack: VenuePack = VENUES) -> Column:
    """Whether source or link name the venue that needs proof."""
    return (first_alias(_joined(fields, SOURCE_FIELDS), pack.aliases) == pack.unproven) | (first_alias(_joined(fields, LINK_FIELDS), pack.links) == pack.unproven)


def category(venue: Column, pack: VenuePack = VENUES) -> Column:
    """The publication category of a resolved venue."""
    base = base_name(venue, pack)
    out = F.when(base == pack.preprint, pack.preprint)
    for venues, label in pack.categories:
        out = out.when(base.isin(venues), label)
    return out.otherwise(pack.other)


def file_venue(path: Column | str, pack: VenuePack = VENUES) -> Column:
    """The venue and year that a raw file's name stands for."""
    name = nth(F.split(text(path), "/"), -1)
    name = F.regexp_replace(name, r"(?i)\.(?:bib|json|csv|html|htm)$", "")
    name = F.regexp_replace(name, r"(?i)[-_]?(?:main|findings|short|long|demo|srw|industry)", "")
    name = F.regexp_replace(name, r"[-_]+(20\d{2})", "$1")
    year = F.regexp_extract(name, r"(20\d{2})", 1)
    prefix = F.btrim(F.regexp_replace(name, r"(?s)20\d{2}.*$", ""), F.lit("-_ "))
    return F.replace(name_with_year(prefix, year, pack), F.lit(" "), F.lit(""))


def source_kind(venue: Column, openalex: Column, semantic_scholar: Column, pack: VenuePack = VENUES) -> Column:
    ids = (text(openalex) != "") | (text(semantic_scholar) != "")
    return F.when(venue == pack.preprint, "arxiv").when(base_name(venue, pack).isin(pack.known), "ccf_venue").when(ids, "supplemental_or_other").otherwise("other")


def raw_kind(path: Column | str) -> Column:
    low = F.lower(text(path))
    return F.when(F.contains(low, F.lit("arxiv")), "arxiv").when(F.contains(nth(F.split(low, "/"), -1), F.lit("-accepted")), "official_accepted").otherwise("dblp")


def merge_precedence(venue: Column, pack: VenuePack = VENUES) -> Column:
    """3 for a known venue, 2 for the preprint server, 1 for others."""
    return F.when(base_name(venue, pack).isin(pack.known), 3).when(venue == pack.preprint, 2).otherwise(1)


def evidence_rank(venue: Column, pack: VenuePack = VENUES, journals: list[str] | None = None) -> Column:
    """3 for conferences, 2 for journals, 1 for the preprint server, 0 for others."""
    journals = [j for own in packs.JOURNALS.values() for j in own] if journals is None else journals
    base = base_name(venue, pack)
    return F.when(base.isin(journals), 2).when(base.isin(pack.known), 3).when(base == pack.preprint, 1).otherwise(0)


def source_names(value: Column | str, target: Column, pack: VenuePack = VENUES) -> Column:
    """Whether a source field names the target venue."""
    return (base_name(name_with_year(value, "", pack), pack) == target) | (base_name(value, pack) == target)


def confident_source(source: Column | str, target: Column, pack: VenuePack = VENUES, also: dict[str, list[str]] | None = None) -> Column:
    """Whether what a source calls itself is the target venue beyond doubt: not empty, not the side
    volume, and naming it, or one of the further names of that target (PVLDB for VLDB)."""
    low, base = F.lower(text(source)), base_name(target, pack)
    side, mark, _ = pack.side_volume
    more = F.lit(False)
    for name, marks in (also or {"VLDB": ["vldb endowment", "pvldb"]}).items():
        for m in marks:
            more = more | ((base == name) & F.contains(low, F.lit(m)))
    return (low != "") & ~((base == side) & F.contains(low, F.lit(mark))) & ((base_name(name_with_year(low, "", pack), pack) == base) | more)


def any_confident_source(sources: list[Column], target: Column, pack: VenuePack = VENUES) -> Column:
    out = F.lit(False)
    for s in sources:
        out = out | confident_source(s, target, pack)
    return out
