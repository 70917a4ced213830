"""Fixed values of the text-to-SQL literature domain, and the types that hold such values.

Every operator takes these as parameters: another domain brings its own pack.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# What must be the same as the collections that users already have.

MOJIBAKE = {
    "â€“": "-",
    "â€”": "-",
    "â€˜": "'",
    "â€™": "'",
    "â€œ": '"',
    "â€\u009d": '"',
    "â€¦": "...",
}

DIRECT_TERMS = [
    "text-to-sql", "text to sql", "text2sql", "nl2sql", "nl-to-sql", "nl to sql",
    "natural language to sql", "natural language-to-sql", "natural-language-to-sql",
    "semantic parsing to sql", "semantic parsing into sql", "question-to-sql",
    "natural language query to sql", "natural language queries to sql", "nlq to sql", "nlqs to sql",
    "natural language interface to database", "natural language interfaces to databases",
    "natural language interface for database", "natural language interface for databases",
    "natural language database interface", "natural language query interface",
    "natural language querying on structured data", "nli/db", "nli-db", "nlidb",
    "consultas en lenguaje natural", "natural language query (nlq)",
]

GENERATION_TERMS = [
    "sql generation", "generate sql", "generating sql", "sql query generation", "sql translation",
    "translate to sql", "translation to sql", "sql parser", "sql synthesis", "sql update generation",
    "sql generation task", "automated sql generation",
]

NATURAL_LANGUAGE_TERMS = [
    "natural language", "user question", "user query", "question answering", "database question answering",
    "natural language interface", "natural language query", "natural language queries", "plain english",
    "instruction", "instructions", "non-professional", "non-professionals", "non-expert", "non-experts",
    "nlp", "lenguaje natural", "consultas en lenguaje natural",
]

BOUNDARY_TERMS = [
    "cascade update", "update statements", "update operations", "sql update", "data-to-insight",
    "business intelligence", "threat hunting",
]

OTHER_DOMAIN_TERMS = ["wireless communication", "wireless communications", "visual question answering", "vqa"]

CODE_TERMS = ["code generation", "code search", "semantic code search", "source code", "function-level code", "programming language"]

TASK_LIST_TERMS = [
    "continual learning", "logits replay", "moclip", "class-incremental", "task-incremental", "multi-task",
    "multitask", "chart question answering", "chart qa", "visual question answering", "multimodal",
]

LLM_TERMS = [
    "large language model", "llm", "gpt", "chatgpt", "codex", "llama", "deepseek", "qwen", "prompt",
    "in-context", "chain-of-thought", "agent",
]

BACKGROUND_PATTERNS = [
    r"\bincluding\s+(?:[a-z0-9,;:/()\\$\\.\-\s]{0,120})text\s*[- ]?\s*to\s*[- ]?\s*sql",
    r"\bincluding\s+(?:[a-z0-9,;:/()\\$\\.\-\s]{0,120})text2sql",
    r"\bsuch as\s+(?:[a-z0-9,;:/()\\$\\.\-\s]{0,120})text\s*[- ]?\s*to\s*[- ]?\s*sql",
    r"\btasks\s+like\s+(?:[a-z0-9,;:/()\\$\\.\-\s]{0,120})text2sql",
    r"\bmostly\s+focuses\s+on\s+(?:[a-z0-9,;:/()\\$\\.\-\s]{0,120})text2sql",
    r"\bperformance\s+on\s+(?:[a-z0-9,;:/()\\$\\.\-\+\s]{0,120})nl2sql\s+tasks?",
]

TASK_LIST_PATTERN = r"\bnl2sql\s+tasks?\b|\btext\s*[- ]?\s*to\s*[- ]?\s*sql\s+tasks?\b|\btext2sql\s+tasks?\b"

TOPIC_TAXONOMY = {
    "Task Setting": ["Single-turn Text-to-SQL", "Multi-turn Text-to-SQL", "Cross-domain Text-to-SQL", "Enterprise / BI Text-to-SQL", "Conversational Data Analysis", "Text-to-DSL / Hybrid Query"],
    "Pre-training and Fine-tuning": ["Pre-training", "Supervised Fine-tuning", "Instruction Tuning", "Reinforcement Learning", "Small Models and Distillation"],
    "Prompting and ICL": ["Zero-shot / Few-shot ICL", "Prompt Engineering", "Chain-of-Thought Reasoning", "Self-consistency / Voting", "Example Selection"],
    "Grounding and Retrieval": ["Schema Linking", "Value Linking", "Schema / Content Retrieval", "Semantic Layer / Metadata", "Knowledge Graph / External Knowledge"],
    "Planning and Generation": ["Intermediate Representation", "Query Decomposition", "Join Path Planning", "Constrained Decoding", "Dialect Adaptation", "Neural-symbolic Parsing"],
    "Agentic Feedback and Repair": ["Agentic Workflow", "Tool Use and Execution Guidance", "Self-correction and Repair", "Verification and Guardrails", "Security and Access Control", "Human Feedback"],
    "Benchmarks and Evaluation": ["Benchmark", "Empirical Study", "Survey"],
}

STAGE_TAXONOMY = {
    "Task Understanding": ["Intent Detection", "Question Decomposition", "Dialogue Context Tracking", "Domain Constraint Understanding"],
    "Grounding": ["Schema Linking", "Value Linking", "Context Retrieval", "Database Content Grounding"],
    "Query Planning": ["SQL Sketch / Skeleton", "Intermediate Representation", "Join Path Planning", "Step-by-step Reasoning"],
    "SQL Generation": ["Prompt-based Generation", "Fine-tuned Generation", "Constrained Decoding", "Dialect Adaptation"],
    "Verification & Repair": ["Execution Feedback", "Self-correction", "Static SQL Validation", "Result Validation"],
}

RENAMED_TOPICS = {
    "Dataset Construction": "Benchmark",
    "Synthetic Data Generation": "Benchmark",
    "Evaluation Metric": "Empirical Study",
    "Robustness and Generalization": "Empirical Study",
    "Contamination / Data Leakage": "Empirical Study",
    "Industrial Evaluation": "Empirical Study",
}

TOPIC_TERMS = {
    "Single-turn Text-to-SQL": ["single-turn", "single turn", "one-shot", "question-to-sql"],
    "Multi-turn Text-to-SQL": ["multi-turn", "multi turn", "conversational", "dialogue", "dialog"],
    "Cross-domain Text-to-SQL": ["cross-domain", "cross domain", "spider", "bird", "generalization"],
    "Enterprise / BI Text-to-SQL": ["enterprise", "production", "business intelligence", "bi", "dashboard", "warehouse"],
    "Conversational Data Analysis": ["conversational analytics", "data analysis", "analytics", "ask questions", "plain english"],
    "Text-to-DSL / Hybrid Query": ["sparql", "cypher", "dsl", "query language", "text-to-query", "hybrid query"],
    "Pre-training": ["pre-train", "pretrain", "masked language", "language model pretraining", "bert", "t5", "codebert"],
    "Supervised Fine-tuning": ["fine-tun", "supervised", "training", "train a model", "labeled data"],
    "Instruction Tuning": ["instruction tuning", "instruction-tuned", "alignment tuning", "instruction data"],
    "Reinforcement Learning": ["reinforcement learning", "rlhf", "preference optimization", "policy optimization"],
    "Small Models and Distillation": ["small language model", "small model", "distillation", "distill", "student model", "slm"],
    "Zero-shot / Few-shot ICL": ["in-context", "few-shot", "zero-shot", "demonstration"],
    "Prompt Engineering": ["prompt", "prompting", "prompt engineering", "prompt design"],
    "Chain-of-Thought Reasoning": ["chain-of-thought", "chain of thought", "step-by-step", "reasoning"],
    "Self-consistency / Voting": ["self-consistency", "self consistency", "voting", "majority vote", "candidate selection"],
    "Example Selection": ["example selection", "demonstration selection", "retrieved examples", "similar examples"],
    "Schema Linking": ["schema linking", "schema-linking", "column linking", "table linking", "schema element"],
    "Value Linking": ["value linking", "cell value", "database value", "entity linking"],
    "Schema / Content Retrieval": ["database content", "content retrieval", "sample rows", "retrieval", "rag", "retrieve"],
    "Semantic Layer / Metadata": ["semantic layer", "metadata", "description", "documentation", "comment", "data dictionary"],
    "Knowledge Graph / External Knowledge": ["knowledge graph", "external knowledge", "ontology", "kg"],
    "Intermediate Representation": ["intermediate representation", "ir", "sketch", "skeleton", "semql", "grammar"],
    "Query Decomposition": ["decomposition", "decompose", "sub-question", "subquery", "multi-step"],
    "Join Path Planning": ["join path", "join planning", "foreign key", "join graph"],
    "Constrained Decoding": ["constrained decoding", "grammar-constrained", "grammar constrained", "decoder"],
    "Dialect Adaptation": ["dialect", "postgres", "postgresql", "mysql", "sqlite", "snowflake", "bigquery", "oracle"],
    "Neural-symbolic Parsing": ["neural-symbolic", "symbolic", "semantic parser", "grammar"],
    "Agentic Workflow": ["agent", "workflow", "planner", "multi-agent", "autonomous"],
    "Tool Use and Execution Guidance": ["tool use", "execution-guided", "execution guided", "execution feedback", "execution result"],
    "Self-correction and Repair": ["self-correction", "self correction", "repair", "refine", "revision"],
    "Verification and Guardrails": ["verification", "validate", "guardrail", "static analysis", "checker"],
    "Security and Access Control": ["privacy", "access control", "permission", "security", "rbac", "policy", "prompt injection"],
    "Human Feedback": ["human feedback", "user feedback", "interactive", "clarification"],
    "Benchmark": ["benchmark", "bird", "spider", "wikisql", "cosql", "sparc", "dataset", "corpus", "annotation", "data collection", "synthetic", "data generation", "augmentation", "generate data"],
    "Empirical Study": [
        "empirical", "evaluation", "evaluate", "metric", "execution accuracy", "exact match", "soft f1", "leaderboard", "robustness", "generalization", "out-of-domain",
        "distribution shift", "ambiguity", "contamination", "data leakage", "leakage", "training leakage", "industrial", "production", "deployment", "enterprise", "case study",
    ],
    "Survey": ["survey", "review", "literature review", "systematic literature review", "systematic review", "slr", "comprehensive review", "state-of-the-art review", "state of the art review"],
}

STAGE_TERMS = {
    "Task Understanding": ["intent", "question understanding", "decomposition", "dialogue", "context", "constraint"],
    "Intent Detection": ["intent"],
    "Question Decomposition": ["decomposition", "decompose", "sub-question", "subquestion"],
    "Dialogue Context Tracking": ["dialogue", "dialog", "multi-turn", "context tracking"],
    "Domain Constraint Understanding": ["domain constraint", "business rule", "constraint"],
    "Grounding": ["grounding", "schema linking", "value linking", "schema", "column", "table", "database content"],
    "Schema Linking": ["schema linking", "column linking", "table linking", "foreign key"],
    "Value Linking": ["value linking", "cell value", "database value", "entity linking"],
    "Context Retrieval": ["retrieval", "retrieve", "rag", "context"],
    "Database Content Grounding": ["database content", "sample rows", "row retrieval", "content grounding"],
    "Query Planning": ["planning", "planner", "sketch", "skeleton", "intermediate representation", "chain-of-thought"],
    "SQL Sketch / Skeleton": ["sketch", "skeleton"],
    "Intermediate Representation": ["intermediate representation", "semql", "ir"],
    "Join Path Planning": ["join path", "join planning", "foreign key"],
    "Step-by-step Reasoning": ["step-by-step", "chain-of-thought", "reasoning"],
    "SQL Generation": ["sql generation", "generate sql", "decoder", "text-to-sql", "nl2sql"],
    "Prompt-based Generation": ["prompt", "few-shot", "zero-shot", "in-context"],
    "Fine-tuned Generation": ["fine-tun", "instruction tuning", "supervised"],
    "Constrained Decoding": ["constrained decoding", "grammar-constrained", "decoder"],
    "Dialect Adaptation": ["dialect", "postgres", "mysql", "sqlite", "snowflake"],
    "Verification & Repair": ["verification", "repair", "self-correction", "execution feedback", "validate", "refine"],
    "Execution Feedback": ["execution feedback", "execution-guided", "execution result"],
    "Self-correction": ["self-correction", "self correction", "refine", "repair"],
    "Static SQL Validation": ["static validation", "static analysis", "syntax check", "validator"],
    "Result Validation": ["result validation", "answer validation", "consistency"],
}

AI_VENUES = ["AAAI", "ACL", "AIJ", "CVPR", "ICCV", "ICML", "IJCV", "IJCAI", "JMLR", "NeurIPS", "TPAMI"]
DATABASE_VENUES = ["ICDE", "KDD", "PODS", "SIGIR", "SIGMOD", "TKDE", "TODS", "TOIS", "VLDB", "VLDBJ"]
SOFTWARE_VENUES = ["ASE", "FSE", "ICSE", "ISSTA", "TOSEM", "TSE"]
CROSS_VENUES = ["WWW"]
OTHER, ARXIV = "其他", "ArXiv"
CATEGORIES = ["软件工程", "数据库领域", "AI 领域", "ArXiv", "交叉/综合/新兴", "其他"]
VENUE_CATEGORY = [(SOFTWARE_VENUES, "软件工程"), (DATABASE_VENUES, "数据库领域"), (AI_VENUES, "AI 领域"), (CROSS_VENUES, "交叉/综合/新兴")]

VENUE_ALIASES = {
    "AAAI": ["aaai", "aaai conference on artificial intelligence"],
    "ACL": ["acl", "annual meeting of the association for computational linguistics"],
    "AIJ": ["aij", "artificial intelligence", "artificial intelligence journal"],
    "CVPR": ["computer vision and pattern recognition", "cvpr"],
    "ICCV": ["iccv", "international conference on computer vision"],
    "ICML": ["icml", "international conference on machine learning"],
    "IJCAI": ["ijcai", "international joint conference on artificial intelligence"],
    "IJCV": ["international journal of computer vision"],
    "JMLR": ["journal of machine learning research"],
    "NeurIPS": ["neurips", "neural information processing systems", "nips"],
    "TPAMI": ["transactions on pattern analysis and machine intelligence", "tpami"],
    "SIGMOD": ["acm sigmod", "international conference on management of data", "pacmmod", "proceedings of the acm on management of data", "sigmod"],
    "TODS": ["acm transactions on database systems", "tods"],
    "TOIS": ["acm transactions on information systems", "tois"],
    "TKDE": ["ieee transactions on knowledge and data engineering", "tkde"],
    "ICDE": ["icde", "international conference on data engineering"],
    "KDD": ["kdd", "knowledge discovery and data mining"],
    "PODS": ["pods", "principles of database systems"],
    "SIGIR": ["sigir", "research and development in information retrieval"],
    "WWW": ["the web conference", "web conference", "www", "www conference", "world wide web conference", "thewebconf"],
    "VLDB": ["vldb", "very large data bases", "proceedings of the vldb endowment"],
    "VLDBJ": ["vldb journal", "vldbj"],
    "ASE": ["ieee/acm international conference on automated software engineering", "ieee / acm international conference on automated software engineering", "international conference on automated software engineering", "automated software engineering", "ase"],
    "FSE": ["joint meeting on european software engineering conference and symposium on the foundations of software engineering", "foundations of software engineering", "fse"],
    "ICSE": ["icse", "international conference on software engineering"],
    "ISSTA": ["international symposium on software testing and analysis", "issta"],
    "TOSEM": ["acm transactions on software engineering and methodology", "tosem"],
    "TSE": ["ieee transactions on software engineering", "tse"],
}

LINK_ALIASES = {"ArXiv": ["arxiv.org", "export.arxiv.org"], "WWW": ["thewebconf.org"]}

CONFERENCES = {
    "AI": {"AAAI": "aaai", "NeurIPS": "nips", "ACL": "acl", "CVPR": "cvpr", "ICCV": "iccv", "ICML": "icml", "IJCAI": "ijcai"},
    "DB": {"SIGMOD": "sigmod", "VLDB": "vldb", "ICDE": "icde", "KDD": "kdd", "WWW": "www", "SIGIR": "sigir"},
    "SE": {"ICSE": "icse", "FSE": "sigsoft", "ASE": "kbse", "ISSTA": "issta"},
    "Security": {"CCS": "ccs", "S&P": "sp", "USENIXSec": "uss", "NDSS": "ndss"},
}
CONFERENCE_YEARS = (2020, 2025)
ODD_YEARS = {"ICCV": [2021, 2023, 2025], "NDSS": [2020, 2021, 2022, 2023, 2024, 2025, 2026]}

JOURNALS = {"AI": {"AIJ": "ai"}, "DB": {"TKDE": "tkde", "VLDBJ": "vldb"}, "SE": {"TSE": "tse", "TOSEM": "tosem"}}

STOP_HEADINGS = [
    "accepted demo", "accepted demos", "accepted industry", "accepted tutorial", "accepted tutorials", "accepted workshop",
    "accepted workshops", "doctoral consortium", "industry track", "pods", "sirip",
]

CANARIES = [
    ("ValueNet: A Natural Language-to-SQL System that Learns from Database Information", "ICDE", "2021"),
    ("DIN-SQL: Decomposed In-Context Learning of Text-to-SQL with Self-Correction", "NeurIPS", "2023"),
    ("The Dawn of Natural Language to SQL: Are We Fully Ready?", "VLDB", "2024"),
    ("Combining Small Language Models and Large Language Models for Zero-Shot NL2SQL", "VLDB", "2024"),
    ("CYANSQL: Unlock the Power of NL2SQL via Clustering-based Test-Time Scaling", "ICDE", "2026"),
    ("LEAF-SQL: Level-wise Exploration with Adaptive Fine-graining for Text-to-SQL Skeleton Prediction", "ICDE", "2026"),
    ("SQLMorph: Query Mutation and Fine-Grained Metrics for Text-to-SQL Evaluation", "ICDE", "2026"),
    ("Text2SQL-Flow: A Robust SQL-Aware Data Augmentation Framework for Text-to-SQL", "ICDE", "2026"),
]

# List pages of conferences: what their markup and lines say.
TRACKS = ["research track", "research papers", "fse research papers", "icse research track", "ase research papers", "issta research papers"]
SCHEDULE_HEADING = "research track papers schedule"
SCHEDULE_SKIPS = ["theme:", "session chair:", "program", "author information", "attending", "sponsors", "calls", "menu"]
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
NUMBERED_HEADING = "accepted research papers for icde"
NUMBERED_FOOTERS = ["ieee international conference on data engineering", "© ieee"]
PROGRAMME_MARKS = ["conf.researchr.org", '<body id="track"']
MAIN_END = "<!--endMainContent"
ROW_HEADINGS = ["paper title", "total papers accepted"]
LINK_HEADINGS = ["accepted", "proceedings", "schedule", "program"]
SITE_ROW_HEADINGS = ["a", "paper title", "total papers accepted:"]
SITE_ITEM_HEADINGS = ["homepage", "accepted papers"]
ABSTRACT_NAMES = ("DC.Description", "citation_abstract", "description")
PDF_HEADINGS = ["vldb reference format", "pvldb reference format", "introduction", "keywords", "keyword", "ccs concepts"]
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
YEAR = re.compile(r"\b20\d{2}\b")
VIRTUAL_LINK = re.compile(r"/virtual/20\d{2}/(?:poster|paper)/")
LISTED_NUMBER = re.compile(r"^\d+\s*[|.)-]\s*")
LISTED_NOTE = re.compile(r"\s*\[[^\]]*(?:Experiments|Analysis|Vision|Systems)[^\]]*\]\s*$")
LISTED_DOI = re.compile(r"\bDOI:\s*\S+", re.IGNORECASE)
LISTED_BRACKETS = re.compile(r"\([^)]*\)")
LISTED_NAMES = re.compile(r";|\band\b")
LISTED_COMMAS = re.compile(r";|\band\b|,")

# Titles: spellings that share a key (pattern and what it becomes), the bracketed note at the end of a title, and what
# case folding turns into ASCII letters and lower() does not.
SYNONYMS = [
    (r"(?U)\btext\s*[- ]?\s*to\s*[- ]?\s*sql\b", "texttosql"),
    (r"(?U)\btext\s*2\s*sql\b", "texttosql"),
    (r"(?U)\bnl\s*[- ]?\s*2\s*sql\b", "nl2sql"),
    (r"(?U)\bnatural\s+language\s+to\s+sql\b", "naturallanguagetosql"),
]
NOTE = r"(?iU)\s*\[[^\]]*(?:experiment|analysis|benchmark|vision|systems)[^\]]*\]\s*\.?$"

# Sites of single papers: which links and DOIs lead where.
VIRTUAL_ROUTE, DETAILS_ROUTE = "/virtual/", "conf.researchr.org/details/"
PMLR_ROUTE, NEURIPS_ROUTE, ANTHOLOGY_ROUTE = "proceedings.mlr.press/", "proceedings.neurips.cc/", "10.18653/v1/"

# Conference pages that records are read from: what their titles, links and abstracts are marked by.
ACL_TITLE = r"<strong><a class=align-middle href="
ACL_ABSTRACT = r'(?s)<div class="card-body p-3 small">(.*?)</div>'
NDSS = (
    (r'(?s)<h2 class="pt-cv-title"><a href="([^"]*)"[^>]*>(.*?)</a></h2>'),
    (r'(?s)<h3 class="blog-post-title">(.*?)</h3>.*?<a class="paper-link-abs" href="([^"]+)"'),
)
DBLP_WRAPPERS = ("bht", "h1", "ref", "dblpcites")

# Relevance: what texts say of databases, their users, and what is made for them.
DATABASE_TERMS = ("sql", "database", "databases", "relational database", "relational databases")
SCHEMA_TERMS = ("schema", "schemas")
TABLE_TERMS = ("table", "tables")
QUERY_TERMS = ("query", "queries")
LAY_USER_TERMS = ("nlp", "non-professional", "non-professionals", "non-expert", "non-experts")
MAKING_TERMS = ("generate", "generation", "translate", "translation", "synthesis")
MAKING_ABROAD_TERMS = ("transformar", "traducción", "traduccion")
INTERFACE_TERMS = ("natural language interface", "natural language query")
INSIGHT_TERMS = ("data-to-insight", "business intelligence", "semantic layer")
PARSING = "semantic parsing"
LANGUAGE = "sql"
ANSWERING = "question answering"

# Mentions that select a label as plain substrings, and the labels of texts that no term selects.
DIRECT_MENTIONS = ["text-to-sql", "nl2sql", "natural language to sql"]
DEFAULT_TOPICS = ["Planning and Generation", "Neural-symbolic Parsing"]
DEFAULT_STAGES = ["SQL Generation"]

# End of the fixed values.


@dataclass(frozen=True)
class LabelPack:
    """A two-level taxonomy, the terms that select its labels, and what to do beyond them."""

    taxonomy: dict[str, list[str]]
    terms: dict[str, list[str]]
    default: list[str]
    renamed: dict[str, str] = field(default_factory=dict)
    # Labels that plain substrings or the terms of another list select as well.
    also: list[tuple[str, list[str], bool]] = field(default_factory=list)

    @property
    def labels(self) -> list[str]:
        """All labels in order, parents before children; a label counts where it comes first."""
        return list(dict.fromkeys(x for parent, children in self.taxonomy.items() for x in (parent, *children)))


TOPICS = LabelPack(TOPIC_TAXONOMY, TOPIC_TERMS, DEFAULT_TOPICS, RENAMED_TOPICS, [("Prompt Engineering", LLM_TERMS, True), ("Single-turn Text-to-SQL", DIRECT_MENTIONS, False)])
STAGES = LabelPack(STAGE_TAXONOMY, STAGE_TERMS, DEFAULT_STAGES, {}, [("SQL Generation", DIRECT_MENTIONS, False)])


@dataclass(frozen=True)
class VenuePack:
    """Names of venues: aliases in texts and links, categories, and the catch-alls."""

    aliases: dict[str, list[str]]
    links: dict[str, list[str]]
    categories: list[tuple[list[str], str]]
    other: str = OTHER
    preprint: str = ARXIV
    preprint_mark: str = "arxiv"
    # A venue whose side volume is none of its own, and the words that tell.
    side_volume: tuple[str, str, str] = ("ACL", "findings", "association for computational linguistics")
    # A venue that its stored name alone doesn't prove.
    unproven: str = "WWW"

    @property
    def known(self) -> list[str]:
        return [v for venues, _ in self.categories for v in venues]


VENUES = VenuePack(VENUE_ALIASES, LINK_ALIASES, VENUE_CATEGORY)

#: Words that occur in the generated test documents, for queries over them.
FIXTURE_TOPICS = LabelPack(
    {"Legal": ["Licence", "Copyright"], "Language": ["English", "German", "French", "Spanish"], "Style": ["Table", "Shout"]},
    {"Licence": ["license", "licensed"], "Copyright": ["all rights reserved", "copyright"], "English": ["the", "and of"], "German": ["und", "der", "nicht"], "French": ["les", "dans", "une"], "Spanish": ["del", "por", "para"], "Table": [" | "], "Shout": ["!!"]},
    ["Style"],
    {"License": "Licence", "Englisch": "English"},
    [("Licence", ["general public"], False)],
)
