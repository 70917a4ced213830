import pytest
from pyspark.sql import functions as F

from corpusflow import packs
from corpusflow.functions import rules
from corpusflow.functions import text as X
from corpusflow.functions import venues as V
from corpusflow.session import ship


def one(spark, column, **fields):
    ship(spark)
    return spark.createDataFrame([tuple(fields.values())], ", ".join(f"{k} string" for k in fields)).select(column).first()[0]


@pytest.mark.parametrize(("text", "term", "found"), [("many agents", "agent", False), ("an agent.", "agent", True), ("bi-directional", "bi", True), ("fine-tuning", "fine-tun", True), ("llms", "llm", False), (None, "x", False)])
def test_terms(spark, text, term, found):
    assert one(spark, rules.has_term(F.col("t"), term), t=text) is found


@pytest.mark.parametrize("title", [t for t, _, _ in packs.CANARIES])
def test_canaries_are_core(spark, title):
    assert one(spark, rules.relevance_level("t", F.lit("")), t=title) == "core"
    assert one(spark, rules.relevance_level("t", F.lit("for business intelligence")), t=title) == "application"


CASES = [
    ("Visual question answering with text-to-sql tasks", "", "", "core"),
    ("Visual question answering", "about nl2sql", "", "irrelevant"),
    ("A multitask model", "for nl2sql tasks", "", "irrelevant"),
    ("Code search", "over text2sql", "", "irrelevant"),
    ("Code search", "with sql generation by text2sql", "", "core"),
    ("Models", "many tasks like parsing and text2sql", "", "irrelevant"),
    ("Parsing", "semantic parsing of sql", "", "core"),
    ("Parsing", "text2sql for threat hunting", "", "application"),
    ("Prompts", "an llm does sql generation", "", "application"),
    ("Users", "sql synthesis from natural language", "", "application"),
    ("Databases", "generate plans for a database from natural language", "", "application"),
    ("Bases", "traducción a sql", "", "application"),
    ("Interface", "a natural language interface over sql", "", "application"),
    ("QA", "question answering with schemas", "", "application"),
    ("BI", "a semantic layer and a gpt", "", "application"),
    ("Tables", "natural language query over tables of a schema", "nl2sql", "application"),
    ("Tables", "plain english over tables and queries", "other", "irrelevant"),
    ("Trees", "forests", "nl2sql", "irrelevant"),
]


def test_relevance_decisions(spark):
    ship(spark)
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(CASES)], "i int, t string, a string, k string, level string")
    got = df.withColumn("s", rules.signals("t", "a", "k")).withColumn("got", rules.decide(F.col("s"))).orderBy("i").collect()
    assert [(r.t, r.a, r.got) for r in got] == [(r.t, r.a, r.level) for r in got]


def test_labels(spark):
    low = X.lowered("t")
    assert one(spark, rules.classify(low, packs.TOPICS), t="Nothing of it") == ["Planning and Generation", "Neural-symbolic Parsing"]
    assert one(spark, rules.classify(low, packs.TOPICS), t="A text-to-sql survey with GPT") == ["Task Setting", "Single-turn Text-to-SQL", "Prompting and ICL", "Prompt Engineering", "Benchmarks and Evaluation", "Survey"]
    stages = one(spark, rules.classify(low, packs.STAGES), t="schema linking and constrained decoding with a decoder")
    assert stages == ["Grounding", "Schema Linking", "SQL Generation", "Constrained Decoding"]
    given = F.array(F.lit("Evaluation Metric"), F.lit("Survey"), F.lit("unknown"), F.lit("Prompt Engineering"))
    normal = one(spark, rules.normalize_labels(given, packs.TOPICS), t="")
    assert normal == ["Prompting and ICL", "Prompt Engineering", "Benchmarks and Evaluation", "Empirical Study", "Survey"]
    again = one(spark, rules.normalize_labels(F.array(*map(F.lit, normal)), packs.TOPICS), t="")
    assert again == normal
    assert one(spark, rules.normalize_labels(F.lit(None).cast("array<string>"), packs.TOPICS), t="") == []


def test_flags(spark):
    flags = F.array(F.lit("z"), F.lit("a"), F.lit("z"))
    assert one(spark, rules.quality_flags(flags, F.lit("application")), t="") == ["a", "application_related", "z"]
    assert one(spark, rules.quality_flags(F.array(F.lit("application_related")), F.lit("core")), t="") is None


ENTRY = ("booktitle", "journal", "container", "source", "publisher", "url", "doi", "venue")


@pytest.mark.parametrize(
    ("fields", "venue", "category"),
    [
        ({"booktitle": "Artif. Intell.", "venue": "AIJ2026"}, "AIJ", "AI 领域"), ({"booktitle": "Proc. VLDB Endow."}, "VLDB", "数据库领域"), ({"booktitle": "DI2KG@VLDB"}, "VLDB", "数据库领域"),
        ({"booktitle": "Findings of the ACL"}, "其他", "其他"), ({"journal": "CoRR arXiv"}, "ArXiv", "ArXiv"), ({"url": "https://arxiv.org/abs/1"}, "ArXiv", "ArXiv"), ({"url": "https://www2024.thewebconf.org/x"}, "WWW", "交叉/综合/新兴"),
        ({"venue": "WWW2024"}, "其他", "其他"), ({"venue": "ICSE 2023"}, "ICSE", "软件工程"), ({"venue": "ACL-findings2024"}, "其他", "其他"), ({"venue": "ACL-short2024"}, "ACL", "AI 领域"), ({"booktitle": "VLDB Journal"}, "VLDBJ", "数据库领域"), ({}, "其他", "其他"),
    ],
)
def test_entry_venues(spark, fields, venue, category):
    row = {f: fields.get(f) for f in ENTRY}
    got = V.entry_venue({f: F.col(f) for f in ENTRY})
    assert one(spark, F.struct(got.alias("v"), V.category(got).alias("c")), **row) == (venue, category)


def test_names_and_ranks(spark):
    assert one(spark, V.file_venue("p"), p="/raw/2025/ICSE-main2025.html") == "ICSE2025"
    assert one(spark, V.file_venue("p"), p="EMNLP2025.json") == "其他2025" or one(spark, V.file_venue("p"), p="EMNLP2025.json") == "其他"
    assert [one(spark, V.evidence_rank(F.lit(v)), t="") for v in ("ICDE2024", "TKDE", "ArXiv", "x")] == [3, 2, 1, 0]
    assert [one(spark, V.merge_precedence(F.lit(v)), t="") for v in ("TKDE", "ArXiv", "x")] == [3, 2, 1]
    assert one(spark, V.source_kind(F.lit("其他"), F.lit(None), F.lit("s")), t="") == "supplemental_or_other"
    assert [one(spark, V.raw_kind(F.lit(p)), t="") for p in ("/a/arxiv/x.json", "/a/ICDE2024-accepted.json", "/a/ICDE2024.json")] == ["arxiv", "official_accepted", "dblp"]


def test_index_answers_as_the_plain_rule(spark):
    import random

    rng = random.Random(6)
    terms = sorted({t for own in (packs.DIRECT_TERMS, packs.GENERATION_TERMS, packs.NATURAL_LANGUAGE_TERMS, packs.OTHER_DOMAIN_TERMS, packs.LLM_TERMS, *packs.TOPICS.terms.values()) for t in own})
    parts = [w for t in terms for w in (t, t[1:], t[:-1], *t.split())] + ["x", "-", "é", ".", "sqlite", "to"]
    texts = [(k, "".join(rng.choice(parts) + rng.choice([" ", "-", "", "", "s "]) for _ in range(rng.randint(0, 12))).lower()) for k in range(400)] + [(900, None), (901, "")]
    lists = [rng.sample(terms, rng.choice([1, 2, 5, 20])) for _ in range(30)] + [[], ["to sql"], ["a-b", "c++", "-x", "知识"]]
    index = rules.TermIndex.over(F.col("t"), [t for own in lists for t in own], lambda i: F.array(*[i.any(own) for own in lists]))
    rows = spark.createDataFrame(texts, "k int, t string").select("k", "t", index.alias("got"), F.array(*[rules.any_term(F.col("t"), own) for own in lists]).alias("want")).collect()
    assert all(r.got == r.want for r in rows)
    assert 100 < sum(map(sum, (r.want for r in rows))) < 0.9 * len(rows) * len(lists)


@pytest.mark.parametrize(("term", "head"), [("text-to-sql", "to"), ("natural language", "lang"), ("data lake", "lake"), ("to sql", None), ("c++", None), ("-sql-", "sql"), ("a of b", "of")])
def test_heads(term, head):
    assert rules.head_of(term) == head
