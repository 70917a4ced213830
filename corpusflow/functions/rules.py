"""Term rules compiled to columns: matching, relevance levels and label taxonomies.

A term of ASCII letters and digits only matches as a whole word, any other as a
substring. Long texts are looked up in an index: a text is split once, its words and their heads are met with those of all
terms of a pack at once, and what is left, a few strings, answers the rules. Only a term whose head is there is looked for in the text."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow import packs
from corpusflow.functions.text import let, lowered, text
from corpusflow.packs import LabelPack

WORD = re.compile("[a-z0-9]+")
#: Letters of a word's head, and terms from which on an index is worth the split.
HEAD = 4
MANY = 60
CORE, APPLICATION, IRRELEVANT = "core", "application", "irrelevant"


def has_term(c: Column, term: str) -> Column:
    return any_term(c, [term])


def any_term(c: Column, terms: list[str]) -> Column:
    """Whether a lowered text has one of the terms; false for a null text and for no terms."""
    words = [t for t in terms if WORD.fullmatch(t)]
    tests = [F.contains(c, F.lit(t)) for t in terms if not WORD.fullmatch(t)]
    if words:
        # Most texts have none of the words anywhere; finding that out takes no pattern.
        inside = F.lit(False)
        for w in words:
            inside = inside | F.contains(c, F.lit(w))
        tests.append(inside & c.rlike(f"(?<![a-z0-9])(?:{'|'.join(sorted(words, key=lambda w: -len(w)))})(?![a-z0-9])"))
    out = F.lit(False)
    for t in tests:
        out = out | t
    return F.coalesce(out, F.lit(False))


def head_of(term: str) -> str | None:
    """A head that a lowered text with this substring has among its words' heads, if there is one: that of the term's longest word which begins
    within the term, and also ends within it if it is shorter than a head."""
    found = [(m.group(), m.end()) for m in WORD.finditer(term) if m.start() > 0]
    sure = [w for w, end in found if len(w) >= HEAD or end < len(term)]
    return max(sure, key=len)[:HEAD] if sure else None


class TermIndex:
    """Which of many terms a lowered text has: any_term() for lists of them, with the text split once.

    use(index) gets the index of a row's text; it is built within let(), so once for each row. Few terms are looked for one by one."""

    def __init__(self, c: Column, words: Column | None = None, heads: Column | None = None):
        self.text, self.words, self.heads = c, words, heads

    @staticmethod
    def over(c: Column, terms: list[str], use) -> Column:
        if len(set(terms)) < MANY:
            return let(c, lambda t: use(TermIndex(t)))
        words = sorted({t for t in terms if WORD.fullmatch(t)})
        heads = sorted({h for t in terms if not WORD.fullmatch(t) and (h := head_of(t))})
        literal = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
        own = let(F.array_distinct(F.split(c, "[^a-z0-9]+")), lambda ws: F.struct(c.alias("t"), F.array_intersect(ws, literal(words)).alias("w"), F.array_intersect(F.transform(ws, lambda w: F.left(w, F.lit(HEAD))), literal(heads)).alias("h")))
        return let(own, lambda x: use(TermIndex(x["t"], x["w"], x["h"])))

    def any(self, terms: list[str]) -> Column:
        """Whether the text, which may be null, has one of the terms, all of which the index must have."""
        if self.words is None:
            return any_term(self.text, terms)
        words = [t for t in terms if WORD.fullmatch(t)]
        out = F.arrays_overlap(self.words, F.array(*[F.lit(w) for w in words])) if words else F.lit(False)
        for t in terms:
            if not WORD.fullmatch(t):
                inside = F.contains(self.text, F.lit(t))
                out = out | (F.array_contains(self.heads, head_of(t)) & inside if head_of(t) else inside)
        return F.coalesce(out, F.lit(False))


def any_pattern(c: Column, patterns: list[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | c.rlike(f"(?U){p}")
    return F.coalesce(out, F.lit(False))


@dataclass(frozen=True)
class RelevancePack:
    """The term lists that decide relevance."""

    direct: list[str]
    generation: list[str]
    natural_language: list[str]
    boundary: list[str]
    other_domain: list[str]
    code: list[str]
    task_list: list[str]
    llm: list[str]
    background: list[str]
    task_list_pattern: str
    database: tuple[str, ...] = packs.DATABASE_TERMS
    schema: tuple[str, ...] = packs.SCHEMA_TERMS
    tables: tuple[str, ...] = packs.TABLE_TERMS
    queries: tuple[str, ...] = packs.QUERY_TERMS
    lay_users: tuple[str, ...] = packs.LAY_USER_TERMS
    making: tuple[str, ...] = packs.MAKING_TERMS
    making_abroad: tuple[str, ...] = packs.MAKING_ABROAD_TERMS
    interfaces: tuple[str, ...] = packs.INTERFACE_TERMS
    insight: tuple[str, ...] = packs.INSIGHT_TERMS
    parsing: str = packs.PARSING
    language: str = packs.LANGUAGE
    answering: str = packs.ANSWERING
    #: What every text holds that a background or task list pattern finds; '' if nothing is known.
    pattern_mark: str = ""


RELEVANCE = RelevancePack(
    packs.DIRECT_TERMS, packs.GENERATION_TERMS, packs.NATURAL_LANGUAGE_TERMS, packs.BOUNDARY_TERMS, packs.OTHER_DOMAIN_TERMS,
    packs.CODE_TERMS, packs.TASK_LIST_TERMS, packs.LLM_TERMS, packs.BACKGROUND_PATTERNS, packs.TASK_LIST_PATTERN, pattern_mark="sql",
)


def signals(title: Column | str, abstract: Column | str, keywords: Column | str, pack: RelevancePack = RELEVANCE) -> Column:
    """A struct of the signals that relevance weighs, each a boolean: evaluated once for each row."""
    texts = F.struct(lowered(title).alias("head"), lowered(F.concat_ws(" ", text(title), text(abstract))).alias("body"), lowered(keywords).alias("words"))
    every = [t for own in (pack.direct, pack.generation, pack.database, pack.schema, pack.tables, pack.queries, pack.natural_language, pack.boundary, pack.other_domain, pack.code, pack.task_list, pack.llm, pack.lay_users, pack.making, pack.making_abroad, pack.interfaces, pack.insight) for t in own]
    return let(texts, lambda t: TermIndex.over(t["body"], every, lambda body: _signals(t["head"], body, t["words"], pack)))


def _signals(head: Column, index: TermIndex, words: Column, pack: RelevancePack) -> Column:
    body = index.text
    found = lambda terms: index.any(list(terms))
    has = lambda part: F.contains(body, F.lit(part))
    marked = has(pack.pattern_mark)
    tests = {
        "title_direct": any_term(head, pack.direct),
        "direct": found(pack.direct) | (has(pack.parsing) & has(pack.language)),
        "generation": found(pack.generation),
        "database": found(pack.database),
        "schema": found(pack.schema),
        "structured": found(pack.database) | (found([*pack.schema, *pack.tables]) & found(pack.queries)),
        "language": found(pack.natural_language),
        "boundary": found(pack.boundary),
        "elsewhere": found(pack.other_domain),
        "code": found(pack.code),
        "listed": marked & any_pattern(body, [pack.task_list_pattern]) & found([*pack.task_list, *pack.code]),
        "background": marked & any_pattern(body, pack.background),
        "model": found(pack.llm),
        "lay": found(pack.lay_users),
        "making": found(pack.making),
        "abroad": found(pack.making_abroad),
        "interface": found(pack.interfaces),
        "answering": has(pack.answering),
        "insight": found(pack.insight),
        "key_terms": any_term(words, [*pack.direct, *pack.generation]),
    }
    return F.struct(*[t.alias(n) for n, t in tests.items()])


def decide(s: Column) -> Column:
    """The relevance level for a struct of signals. Off-topic signs overrule all but a direct
    title; a direct mention is core unless it lies at the boundary; then come the
    combinations that make an application."""
    off = s["elsewhere"] | s["listed"] | (s["code"] & ~s["generation"]) | s["background"]
    use = (
        (s["generation"] & (s["model"] | s["lay"] | s["language"]))
        | (s["database"] & ((s["language"] & s["making"]) | s["abroad"] | s["interface"]))
        | (s["answering"] & (s["database"] | s["schema"]))
        | (s["insight"] & s["model"])
        | (s["structured"] & s["language"] & s["key_terms"])
    )
    named = s["title_direct"] | s["direct"]
    return F.when(~s["title_direct"] & off, IRRELEVANT).when(named & ~s["boundary"], CORE).when(named | use, APPLICATION).otherwise(IRRELEVANT)


def relevance_level(title: Column | str, abstract: Column | str, keywords: Column | str = "", pack: RelevancePack = RELEVANCE) -> Column:
    """core, application or irrelevant. In one expression; over large tables, put signals() in
    a column of its own first and decide() on that."""
    words = F.lit("") if isinstance(keywords, str) and not keywords else keywords
    return decide(signals(title, abstract, words, pack))


def closure(selected: Column, pack: LabelPack) -> Column:
    """Selected labels with their parents, in the order of the taxonomy; labels it doesn't have go."""
    chosen = lambda x: F.array_contains(selected, x)
    tests: dict[str, Column] = {}
    for parent, children in pack.taxonomy.items():
        up = F.arrays_overlap(selected, F.array(*[F.lit(x) for x in (parent, *children)]))
        tests[parent] = tests[parent] | up if parent in tests else up
        for child in children:
            tests.setdefault(child, chosen(F.lit(child)))
    return F.coalesce(F.filter(F.array(*[F.when(tests[x], F.lit(x)) for x in pack.labels]), lambda x: x.isNotNull()), F.array().cast("array<string>"))


def normalize_labels(labels: Column | str, pack: LabelPack) -> Column:
    """Old names replaced, then the closure: idempotent. Null is empty."""
    given = F.coalesce(F.col(labels) if isinstance(labels, str) else labels, F.array().cast("array<string>"))
    if pack.renamed:
        names = F.create_map(*[F.lit(x) for pair in pack.renamed.items() for x in pair])
        given = F.transform(given, lambda x: F.coalesce(names[x], x))
    return let(given, lambda selected: closure(selected, pack))


def matched_labels(c: Column, pack: LabelPack) -> Column:
    """The labels whose terms a lowered text has, before closure."""
    every = [t for terms in (*pack.terms.values(), *(terms for _, terms, as_terms in pack.also if as_terms)) for t in terms]

    def chosen(index: TermIndex) -> Column:
        tests = {label: index.any(terms) for label, terms in pack.terms.items()}
        for label, terms, as_terms in pack.also:
            more = index.any(terms) if as_terms else F.lit(False)
            if not as_terms:
                for t in terms:
                    more = more | F.contains(index.text, F.lit(t))
            tests[label] = tests[label] | more if label in tests else more
        return F.filter(F.array(*[F.when(t, F.lit(label)) for label, t in tests.items()]), lambda x: x.isNotNull())

    return TermIndex.over(c, every, chosen)


def classify(c: Column, pack: LabelPack) -> Column:
    """All labels of a lowered text with their parents; the pack's default labels if there is none."""
    default = F.array(*[F.lit(x) for x in pack.default])
    found = let(matched_labels(c, pack), lambda selected: normalize_labels(selected, pack))
    return let(found, lambda x: F.when(F.size(x) == 0, default).otherwise(x))


def quality_flags(flags: Column | str, level: Column, flag: str = "application_related") -> Column:
    """Flags sorted, with or without the one that the level decides; null if none is left."""
    kept = F.array_remove(F.coalesce(F.col(flags) if isinstance(flags, str) else flags, F.array().cast("array<string>")), flag)
    out = F.when(level == APPLICATION, F.array_append(kept, F.lit(flag))).otherwise(kept)
    out = F.array_sort(F.array_distinct(out))
    return F.when(F.size(out) > 0, out)


def answered_labels(answer: Column | str, field: str, pack: LabelPack) -> Column:
    """The labels in a classifier's answer: JSON, perhaps fenced, whose field lists "parent, child" pairs. Pairs
    that the taxonomy lacks go; an answer that is no JSON, or says NOT_RELEVANT, has null."""
    body = text(answer)
    body = F.when(F.contains(body, F.lit("```")), F.regexp_replace(F.split_part(body, F.lit("```"), F.lit(2)), "^json", "")).otherwise(body)
    given = F.from_json(body, "map<string,array<string>>")[field]
    known = [(f"{parent}, {child}", parent, child) for parent, children in pack.taxonomy.items() for child in children]
    pairs = F.array(*[F.struct(F.lit(a).alias("pair"), F.lit(p).alias("parent"), F.lit(c).alias("child")) for a, p, c in known])
    chosen = F.filter(pairs, lambda p: F.array_contains(given, p["pair"]))
    names = F.flatten(F.transform(chosen, lambda p: F.array(p["parent"], p["child"])))
    ok = ~F.contains(text(answer), F.lit("NOT_RELEVANT")) & given.isNotNull()
    return F.when(ok, normalize_labels(names, pack))


def label_papers(papers: DataFrame, pack: LabelPack, answers: DataFrame | None = None, field: str = "topics") -> DataFrame:
    """papers (key, title, abstract, keywords, ...) with labels: by rules, or by the answers (key, answer) of an outside
    classifier. Then papers whose answer is missing, refuses or can't be read go."""
    if answers is None:
        body = lowered(F.concat_ws(" ", *[text(c) for c in ("title", "abstract", "keywords")]))
        return papers.withColumn("labels", classify(body, pack))
    own = answers.select("key", answered_labels("answer", field, pack).alias("labels")).where("labels IS NOT NULL")
    return papers.drop("labels").join(own, "key")
