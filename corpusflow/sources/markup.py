"""A page's markup as elements.

The scan knows tags, their attributes and their places, no grammar. An element reaches to the first end
tag of its name after it; elements of one search do not overlap."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cached_property

_TAG = re.compile(r"<(/?)([a-z][a-z0-9]*)\b([^>]*)>", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_ANY = re.compile(r"<[^>]+>")
BREAKS = frozenset({"br"})
BLOCKS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "td", "tr", "div"})


def plain(markup: str) -> str:
    """References decoded, then tags out, white space squashed."""
    return " ".join(_ANY.sub(" ", html.unescape(markup)).split())


class Element:
    """A tag at `start` whose content is markup[lo:hi]; `end` is behind its end tag."""

    def __init__(self, page: Page, name: str, start: int, lo: int, hi: int, end: int, raw: str):
        self.page, self.name, self.start, self.lo, self.hi, self.end, self.raw = page, name, start, lo, hi, end, raw

    @cached_property
    def attributes(self) -> dict[str, str]:
        return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(self.raw)}

    def get(self, name: str) -> str:
        return self.attributes.get(name, "")

    @property
    def inner(self) -> str:
        return self.page.markup[self.lo : self.hi]

    def all(self, *names: str) -> Iterator[Element]:
        return self.page.all(*names, lo=self.lo, hi=self.hi)

    def first(self, name: str, **attributes: str) -> Element | None:
        """The first element in it whose attributes have these values."""
        return next((e for e in self.all(name) if all(e.get(k.rstrip("_")) == v for k, v in attributes.items())), None)


class Page:
    def __init__(self, markup: str):
        self.markup = markup
        self.opens: dict[str, list[tuple[int, int, str]]] = {}
        self.closes: dict[str, list[tuple[int, int]]] = {}
        self.tags: list[tuple[int, int, str, bool]] = []
        for m in _TAG.finditer(markup):
            name = m[2].lower()
            self.tags.append((m.start(), m.end(), name, bool(m[1])))
            if m[1]:
                self.closes.setdefault(name, []).append(m.span())
            else:
                self.opens.setdefault(name, []).append((m.start(), m.end(), m[3]))

    def whole(self) -> Element:
        return Element(self, "", 0, 0, len(self.markup), len(self.markup), "")

    def next_close(self, name: str, at: int) -> tuple[int, int] | None:
        own = self.closes.get(name, [])
        k = bisect_left(own, (at, at))
        return own[k] if k < len(own) else None

    def starts(self, *names: str, lo: int = 0, hi: int | None = None) -> list[tuple[int, int, str, str]]:
        """(start, end, attributes, name) of start tags, in order."""
        hi = len(self.markup) if hi is None else hi
        out = []
        for name in names:
            own = self.opens.get(name, [])
            out += [(*t, name) for t in own[bisect_left(own, (lo,)) : bisect_left(own, (hi,))]]
        return sorted(out) if len(names) > 1 else out

    def all(self, *names: str, lo: int = 0, hi: int | None = None) -> Iterator[Element]:
        """Elements of these names that lie in markup[lo:hi]."""
        hi, at = len(self.markup) if hi is None else hi, lo
        for start, end, raw, name in self.starts(*names, lo=lo, hi=hi):
            if start < at:
                continue
            close = self.next_close(name, end)
            if close and close[1] <= hi:
                at = close[1]
                yield Element(self, name, start, end, *close, raw)

    def lines(self, lo: int = 0, hi: int | None = None) -> list[str]:
        """Non-empty lines: breaks and ends of blocks end a line."""
        out, at = [], lo
        hi = len(self.markup) if hi is None else hi
        for start, end, name, closing in self.tags:
            if start >= at and end <= hi and (name in BLOCKS if closing else name in BREAKS):
                out += [self.markup[at:start], "\n"]
                at = end
        out.append(self.markup[at:hi])
        text = html.unescape(_ANY.sub(" ", "".join(out)))
        return [x for x in (" ".join(line.split()) for line in text.splitlines()) if x]
