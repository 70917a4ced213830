"""Small hard tables and plain versions of the operators."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("n_lines", T.StringType())])
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng: random.Random, words: int) -> str:
    out = []
    while len(out) < words:
        out += [rng.choice(WORDS) + str(rng.randint(0, 30)) for _ in range(rng.randint(3, 12))]
        out[-1] += rng.choice([".", ".", ".\n"])
    return " ".join(out[:words])


def near(rng: random.Random, text: str, changes: int) -> str:
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = "changed" + str(rng.randint(0, 10**6))
    return " ".join(words)


def hard_docs(seed: int = 1) -> list[tuple]:
    """Copies, near copies, nulls, empty and long texts, repeated rows and ids, a column whose name clashes."""
    rng = random.Random(seed)
    rows = [(None, "no id " + prose(rng, 30), "en", "x"), (1, None, None, None), (2, "", "en", "x"), (3, " \t\n\v\f\r ", "en", "x"), (4, "one", "en", "x"), (5, "ONE", "en", "x"), (6, "two words", "en", "x")]
    base = [prose(rng, n) for n in (8, 40, 90, 200, 400, 3000)]
    doc = 10
    for text in base:
        for changes in (0, 0, 1, 2, 4, 9, 20):
            rows.append((doc, near(rng, text, min(changes, len(text.split(" ")) // 3)), "en", "x"))
            doc += 1
    rows += [(doc + i, prose(rng, rng.randint(1, 120)), "de", "y") for i in range(40)]
    rows += [(500, "a long " * 40_000, "en", "x"), (600, base[1], "en", "x"), (600, base[1], "en", "x")]
    return rows


def components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    return {n: find(n) for n in nodes}


def shingle_set(text: str | None, n: int) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words)} if 0 < len(words) < n else {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
