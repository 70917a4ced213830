"""Main text of web pages by differencing with the pages of nearest URL.

Each page becomes lines, one for each block of its markup, and each line a 64-bit hash: what is ordered, dealt
and compared are these hashes, some hundredths of the markup. Pages are sorted by host and URL path, and each is paired,
within its host, with the nearest page before it and the nearest after it that are no copies of
it. The lines of a pair are aligned by their longest common subsequence; lines it aligns are
shared. Pages that share half of their text or more are copies of one article and say nothing about the site's
frame; the nearest NEAR others of each side, each kind of page once, are tried.

The order is dealt to tasks by ranges, so a host of any size spans as many as it needs. A range takes the pages near
its edges over from the ranges beside it, so what a page is compared with, and its text, is the same
however the table is partitioned.

Shared lines go. Markup only says how likely a line is the frame to begin with: menus, footers, sidebars, adverts,
forms, comments and the like go without being shared, as does what stands outside a marked article; within one a line
goes only if both neighbours share it, in one run with lines of the frame around the
article: then the template goes on into the article. Sentences that articles have in common stay.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.common import bounded, map_arrow, materialize, release, release_at_exit, ship, without

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(?i)(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")

# Contents of these are never text.
RAW = frozenset(("script", "style", "template", "noscript", "textarea", "title", "iframe", "object", "svg", "canvas", "math", "head"))
# Elements that belong to the frame of a page.
FRAME = frozenset(("nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "fieldset"))
# The header of a page, not that of an article.
OUTER_FRAME = frozenset(("header",))
INLINE = frozenset(("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
# These end an open element of their kind where authors leave the end tag out.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
FRAME_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead banner footer sidebar sidenav aside widget related recommended share sharing social ad ads advert adverts advertisement advertising "
    "adsense promo promotion sponsor sponsored cookie cookies consent gdpr notice notices alert newsletter subscribe subscription popup modal overlay comment comments respond disqus replies reply pagination "
    "pager toolbar copyright legal login signup signin search".split()
)
FRAME_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog".split())
COPY_SHARE = 0.5
#: Pages of a side that a page is compared with, until one is no copy.
NEAR = 4
FRAME_ROLE, OPEN_ROLE, MAIN_ROLE = 0, 1, 2
# What an element is: frame by its kind or role; by a name; a form; an article or main; anything else.
HARD, NAMED, FORM, MARKED, PLAIN = range(5)
# A form that holds one of these is around the page, not in it.
PAGE_PARTS = frozenset(("h1", "nav", "header", "footer"))


def _attributes(raw: str) -> tuple[bool, str]:
    """Whether a whole token of class or id is made of names of the frame, and the role."""
    named, role = False, ""
    for name, a, b, c in ATTRIBUTE.findall(raw):
        value = a or b or c
        if name.lower() == "role":
            role = value.lower()
            continue
        for token in value.split():
            words = [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()) if w]
            named |= bool(words) and FRAME_NAMES.issuperset(words)
    return named, role


def lines_of(page: str) -> list[tuple[str, int]]:
    """(line, role) for each block with text, in page order. White space in a line is one space.

    Class and id don't make an article or main the frame, nor an element that holds one which is in no other;
    nor are forms the frame that hold one, or, without such a name, the page's heading, menu, header or footer."""
    out, wrappers = _parsed(page, frozenset())
    return _parsed(page, wrappers)[0] if wrappers else out


def _parsed(page: str, spared: frozenset[int]) -> tuple[list[tuple[str, int]], frozenset[int]]:
    """Lines, and where the start tags of wrappers are that were taken for the frame. Tags at spared are not."""
    wrappers: set[int] = set()
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, int, int, int]] = []  # elements: name, role of what they hold, what they are, start
    role, at = OPEN_ROLE, 0

    def close_block() -> None:
        if parts:
            if line := " ".join("".join(parts).split()):
                out.append((line, role))
            parts.clear()

    while m := TOKEN.search(page, at):
        if m.start() > at:
            parts.append(html.unescape(page[at : m.start()]))
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                parts.append(m[0][9:].removesuffix("]]>"))
            continue
        if name not in INLINE:
            close_block()
        elif name in ("br", "wbr", "img"):
            parts.append(" " if name == "br" else "")
        if m[1] or m[4]:
            open_at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if open_at is not None:
                if name in INLINE and any(x[0] not in INLINE for x in stack[open_at + 1 :]):
                    continue  # an inline end tag does not end blocks
                del stack[open_at:]
                new = stack[-1][1] if stack else OPEN_ROLE
                if new != role:
                    close_block()
                    role = new
            continue
        if name in RAW and name != "head":
            end = re.compile(rf"</{name}\s*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in CLOSES:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in CLOSES[name]:
                    del stack[k:]
                    break
                if stack[k][0] not in INLINE:
                    break
        role_now = stack[-1][1] if stack else OPEN_ROLE
        if name in VOID:
            continue
        raw = m[3] or m[6] or ""
        named, said = _attributes(raw) if "=" in raw else (False, "")
        marked = name in ("article", "main") or said in ("main", "article")
        if name in FRAME and name != "form" or name in OUTER_FRAME and role_now != MAIN_ROLE or said in FRAME_ROLES:
            kind = HARD
        elif m.start() in spared or marked or name in ("html", "body"):
            kind = MARKED if marked else PLAIN
        else:
            kind = NAMED if named else FORM if name == "form" else PLAIN
        if (marked or name in PAGE_PARTS) and any(x[2] in (NAMED, FORM) for x in stack):
            above = {x[2] for x in stack}
            if marked and kind == MARKED and not above & {HARD, MARKED}:
                wrappers.update(x[3] for x in stack if x[2] in (NAMED, FORM))
            elif not marked and not above & {HARD, MARKED, NAMED}:
                wrappers.update(x[3] for x in stack if x[2] == FORM)
        new = FRAME_ROLE if role_now == FRAME_ROLE or kind in (HARD, NAMED, FORM) else MAIN_ROLE if marked else role_now
        stack.append((name, new, kind, m.start()))
        if new != role:
            close_block()
            role = new
    if at < len(page):
        parts.append(html.unescape(page[at:]))
    close_block()
    return out, frozenset(wrappers)


def aligned(a: list, b: list) -> list[tuple[int, int]]:
    """A longest common subsequence of two lists of lines, as index pairs
    (Hunt and Szymanski: the time grows with the pairs of equal lines)."""
    where: dict = {}
    for j, line in enumerate(b):
        where.setdefault(line, []).append(j)
    tails: list[int] = []
    chains: list[tuple] = []
    for i, line in enumerate(a):
        for j in reversed(where.get(line, ())):
            k = bisect_left(tails, j)
            link = (i, j, chains[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                chains.append(link)
            else:
                tails[k], chains[k] = j, link
    out, at = [], chains[-1] if chains else None
    while at:
        out.append(at[:2])
        at = at[2]
    return out[::-1]


class Lines:
    """A page's lines: their hashes, lengths and roles, and what kind of page it is (its longest lines)."""

    def __init__(self, hashes: list[int], sizes: list[int], roles: list[int]):
        self.hashes, self.sizes, self.roles = hashes, sizes, roles
        long = sorted((-n, h) for h, n, r in zip(hashes, sizes, roles, strict=True) if r != FRAME_ROLE)[:3]
        self.kind = tuple(h for _, h in long)


def shared(a: Lines, b: Lines) -> list[int] | None:
    """Lines of a that b shares; None if they are copies of one article."""
    pairs = aligned(a.hashes, b.hashes)
    size = lambda page, at: sum(page.sizes[i] for i in at if page.roles[i] != FRAME_ROLE)
    least = min(size(a, range(len(a.hashes))), size(b, range(len(b.hashes))))
    return None if pairs and size(a, [i for i, _ in pairs]) >= COPY_SHARE * least else [i for i, _ in pairs]


class Recent:
    """The last NEAR pages of a host, of each kind the last. What it holds after a row of pages is what it
    holds after their last ones, filled up with what it held before: so ranges can be put together."""

    def __init__(self, host: str | None = None, pages: list[Lines] | None = None):
        self.host, self.pages = host, pages or []  # the nearest first

    def add(self, host: str, page: Lines) -> None:
        rest = self.pages if host == self.host else []
        if page.kind:
            rest = [page, *(p for p in rest if p.kind != page.kind)][:NEAR]
        self.host, self.pages = host, rest

    def before(self, older: Recent) -> Recent:
        """This, with what `older` held when it began (if it has seen one host only)."""
        kinds = {p.kind for p in self.pages}
        return Recent(self.host, [*self.pages, *(p for p in older.pages if p.kind not in kinds)][:NEAR])

    def shares(self, host: str, page: Lines) -> list[int] | None:
        """What the page shares with the nearest that is no copy of it; None if there is none."""
        for other in self.pages if host == self.host else []:
            if (out := shared(page, other)) is not None:
                return out
        return None


def kept_lines(roles: list[int], before: list[int] | None, after: list[int] | None) -> list[int]:
    """The lines that are the page's main text, given those shared with either neighbour (None: no neighbour)."""
    both = set(before or ()) & set(after or ())
    either = set(before or ()) | set(after or ())
    article = MAIN_ROLE in roles
    template: set[int] = set()
    run: list[int] = []
    for i in sorted(both):
        run = [*run, i] if run and run[-1] == i - 1 else [i]
        if i + 1 not in both and any(roles[k] != MAIN_ROLE for k in run):
            template.update(run)
    return [i for i, r in enumerate(roles) if (r == MAIN_ROLE and i not in template) or (r == OPEN_ROLE and not article and i not in either)]


KEY = ("__host", "__path", "__id", "__key")
LINED = "__host string, __path string, __id long, __key long, hashes array<long>, sizes array<int>, roles binary"


def _lined(pages: DataFrame) -> DataFrame:
    """(KEY, hashes, sizes, roles) of every page's lines, pages (KEY, html)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, sizes, roles = [], [], []
        for page in batch.column(4).to_pylist():
            own = lines_of(page or "")
            hashes.append([xxhash.xxh3_64_intdigest(x) - (1 << 63) for x, _ in own])
            sizes.append([len(x) for x, _ in own])
            roles.append(bytes(r for _, r in own))
        return pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32())), pa.array(roles, pa.binary())], [*KEY, "hashes", "sizes", "roles"])

    return map_arrow(pages, run, T._parse_datatype_string(LINED))


def _read(batch: pa.RecordBatch) -> Iterator[tuple[int, str, Lines]]:
    """(range, host, page) of the rows of a batch."""
    columns = [batch.column(c).to_pylist() for c in ("range", "__host", "hashes", "sizes", "roles")]
    return ((r, host, Lines(h, n, list(roles))) for r, host, h, n, roles in zip(*columns, strict=True))


def _edges(ranges: DataFrame, down: bool) -> dict[int, Recent]:
    """For each range what was met before it, in order of the ranges or, with down, against it.

    A range tells the last NEAR pages it meets and whether it has one host only: that is all that comes to the driver, at most
    NEAR rows of hashes for a range of the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first, recent = None, None, Recent()

        def give() -> pa.RecordBatch:
            pages = recent.pages or [Lines([], [], [])]
            return pa.RecordBatch.from_arrays([
                pa.array([at] * len(pages)), pa.array(range(len(pages)), pa.int32()), pa.array([recent.host] * len(pages)), pa.array([first == recent.host] * len(pages)),
                pa.array([p.hashes for p in pages], pa.list_(pa.int64())), pa.array([p.sizes for p in pages], pa.list_(pa.int32())), pa.array([bytes(p.roles) for p in pages], pa.binary()),
            ], ["range", "place", "host", "single", "hashes", "sizes", "roles"])

        for batch in batches:
            for r, host, page in _read(batch):
                if r != at:
                    if at is not None:
                        yield give()
                    at, first, recent = r, host, Recent()
                recent.add(host, page)
        if at is not None:
            yield give()

    schema = "range long, place int, host string, single boolean, hashes array<long>, sizes array<int>, roles binary"
    own: dict[int, tuple[bool, Recent]] = {}
    for row in sorted(_in_order(ranges, down).mapInArrow(run, schema).collect(), key=lambda row: (row["range"], row["place"])):
        single, recent = own.setdefault(row["range"], (row["single"], Recent(row["host"])))
        if row["hashes"]:
            recent.pages.append(Lines(row["hashes"], row["sizes"], list(row["roles"])))
    out, now = {}, Recent()
    for r in sorted(own, reverse=down):
        out[r] = now
        single, recent = own[r]
        now = recent.before(now) if single and recent.host == now.host else recent
    return out


def _in_order(ranges: DataFrame, down: bool) -> DataFrame:
    """Rows with the rows of a range together, in order or, with down, against it."""
    return ranges.sortWithinPartitions("range", *[F.desc(c) if down else F.asc(c) for c in KEY])


def _compared(rows: DataFrame, edges: dict[int, Recent], name: str, down: bool) -> DataFrame:
    """rows with the lines that each page shares with the nearest page met before it in this order."""
    held = rows.sparkSession.sparkContext.broadcast({r: (e.host, [(p.hashes, p.sizes, p.roles) for p in e.pages]) for r, e in edges.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, recent = None, Recent()
        for batch in batches:
            out = []
            for r, host, page in _read(batch):
                if r != at:
                    at = r
                    old, pages = held.value[r]
                    recent = Recent(old, [Lines(*p) for p in pages])
                out.append(recent.shares(host, page))
                recent.add(host, page)
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], [*batch.schema.names, name])

    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))])
    return _in_order(rows, down).mapInArrow(run, schema)


def _changed(rows: DataFrame) -> DataFrame:
    """(__id, __key, keep): the places of the lines to keep, of pages where the neighbours make a difference."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        roles, before, after = (batch.column(c).to_pylist() for c in ("roles", "before", "after"))
        keep = [kept_lines(list(r), b, a) for r, b, a in zip(roles, before, after, strict=True)]
        other = pa.array([k != kept_lines(list(r), None, None) for k, r in zip(keep, roles, strict=True)], pa.bool_())
        columns = [batch.column("__id"), batch.column("__key"), pa.array(keep, pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays([c.filter(other) for c in columns], ["__id", "__key", "keep"])

    return map_arrow(rows, run, T._parse_datatype_string("__id long, __key long, keep array<int>"))


def extract_text(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html, ...) without html, plus text: blocks joined by two line feeds.

    A null or empty html, and one with no article text, has the text ''. Pages of a null or odd URL are
    neighbours of each other, under an empty host. Rows that repeat a page are one page; rows that repeat a page_id
    with another url or html are pages of their own. Other columns pass through; a column that is already
    named text is replaced. No rows in, no rows out."""
    ship(pages.sparkSession)
    pages = without(pages, ["text", *KEY, "__lines", "__alone", "keep"])
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?i)^https?://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?i)^(?:https?://[^/?#]*)?([^?#]*)", 1)
    keys = [host.alias("__host"), path.alias("__path"), F.col("page_id").cast("long").alias("__id"), F.xxhash64("url", "html").alias("__key")]
    lined = materialize(_lined(pages.select(*keys, F.col("html"))), "pages-lined")
    ranges = lined.repartitionByRange(*[F.col(c) for c in KEY]).withColumn("range", F.spark_partition_id().cast("long"))
    ranges = materialize(ranges, "pages-ranges")
    # The ranges stand now: a task takes whole ones, whatever it reads them for.
    dealt = ranges.repartition("range")
    rows = _compared(dealt, _edges(dealt, False), "before", False)
    changed = _changed(_compared(rows, _edges(dealt, True), "after", True))
    # Rows that repeat a page are one.
    changed = materialize(changed.groupBy("__id", "__key").agg(F.min("keep").alias("keep")), "pages-changed")
    release(lined, ranges)
    release_at_exit(changed)

    names = [c for c in pages.columns if c.lower() != "html"]
    source = pages.select(*[F.col(f"`{c}`") for c in names], *keys[2:], "html")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [lines_of(page or "") for page in batch.column(batch.num_columns - 1).to_pylist()]
        lines = pa.array([[x for x, _ in page] for page in own], pa.list_(pa.string()))
        alone = pa.array([kept_lines([r for _, r in page], None, None) for page in own], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], lines, alone], [*batch.schema.names[:-1], "__lines", "__alone"])

    schema = T.StructType([*source.schema.fields[:-1], T.StructField("__lines", T.ArrayType(T.StringType())), T.StructField("__alone", T.ArrayType(T.IntegerType()))])
    # What differencing changes goes to the pages, if it is of bounded size; else both meet by key, the lines instead of the markup.
    parsed = map_arrow(source, run, schema).alias("p")
    both = parsed.join(bounded(changed).alias("k"), F.col("p.__id").eqNullSafe(F.col("k.__id")) & (F.col("p.__key") == F.col("k.__key")), "left")
    text = F.array_join(F.transform(F.coalesce("keep", "__alone"), lambda i: F.get("__lines", i)), "\n\n")
    return both.select(*[F.col(f"p.`{c}`") for c in names], text.alias("text"))


def op5_html_text(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_text(pages).withColumn("n_chars", F.length("text").cast("long"))
