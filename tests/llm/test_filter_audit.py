import itertools
import random
import re
from fractions import Fraction

from corpusflow.llm import filter_audit as A
from tests.llm.helpers import hard_docs, prose

DOCS = "doc_id long, text string, source string, mask string"
LABELS = "doc_id long, quality int, toxic int"


def plain_mask(text, older):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    fails = len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), bool(re.search(r"[#$%&*|]", text)), older
    return "".join(x for x, f in zip("ABCDE", fails, strict=True) if f)


def plain(docs, labels):
    """Every order applied, one document after the other."""
    docs = [(d, t or "", s or "") for d, t, s in docs]
    marked = []
    for d, t, s in docs:
        older = d is not None and any(x is not None and x < d and y == t for x, y, _ in docs)
        marked.append((s, plain_mask(t, older), any(x == d and q == 1 for x, q, _ in labels if d is not None), any(x == d and y == 1 for x, _, y in labels if d is not None)))
    out = []
    for part in {m[0] for m in marked}:
        own, rows, total = [m for m in marked if m[0] == part], [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [m for m in left if x in m[1]]
                left = [m for m in left if x not in m[1]]
                total[x] += len(gone)
                rows.append([part, "".join(order), step, len(left), len(gone), sum(x in m[1] for m in own) - len(gone), sum(m[1] == x for m in own), sum(m[2] for m in gone), sum(m[3] for m in gone), x])
        out += [(*r[:-1], total[r[-1]]) for r in rows]
    return out


def check(spark, docs, labels):
    got = A.filter_audit(spark.createDataFrame([(*d, "x") for d in docs], DOCS), spark.createDataFrame(labels, LABELS))
    assert got.schema.simpleString() == "struct<" + A.RESULT.replace(" string", ":string").replace(" int", ":int").replace(" long", ":bigint").replace(", ", ",") + ">"
    assert sorted(map(tuple, got.collect())) == sorted(plain(docs, labels))


def test_same_as_every_order_applied(spark):
    rng = random.Random(2)
    docs = [(d, t, rng.choice(["a", "b", None, ""])) for d, t, *_ in hard_docs()]
    for k in range(120):
        text = prose(rng, rng.choice([20, 199, 200, 201, 400]))
        for change in (lambda t: t + " #", lambda t: t.upper(), lambda t: "same word " * 150, lambda t: t.replace("a", "é")):
            text = change(text) if rng.random() < 0.3 else text
        docs.append((1000 + k, text, rng.choice(["a", "b"])))
        if rng.random() < 0.3:
            docs.append((rng.randint(0, 3000), text, rng.choice(["b", "c"])))
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d, *_ in docs if rng.random() < 0.6] + [(None, 1, 1), (1, 1, 0), (1, 0, 1)]
    check(spark, docs, labels)
    assert len({plain_mask(t or "", False) for _, t, _ in docs}) > 8


def test_limits_are_exact(spark):
    words = [f"w{k}" for k in range(100)]
    texts = ["x " * 199, "\v".join(["x"] * 200), " ".join(words * 2), " ".join(words[:99] * 2 + ["a", "a"]), "A" + "b" * 49, "A" + "b" * 48, "Ab" + "é" * 48, "a b", "&", "1" * 1000]
    check(spark, [(k, t, "s") for k, t in enumerate(texts)], [])


def test_hot_text_and_part(spark):
    docs = [(k, "" if k % 3 else f"text {k}", "hot" if k % 2 else f"s{k}") for k in range(300)]
    check(spark, docs, [(k, 1, k % 2) for k in range(300)])


def test_empty(spark):
    check(spark, [], [(1, 1, 1)])
    check(spark, [(None, None, None)], [])


def test_polynomial_is_the_mean_over_orders():
    rng = random.Random(7)
    for bits in (1, 2, 3, 4):
        counts = [rng.randint(0, 99) for _ in range(1 << bits)]
        f = A.Removal(counts)
        removed = lambda s, counts=counts: sum(n for m, n in enumerate(counts) if m & s)
        assert [f.corner(s) for s in range(1 << bits)] == [removed(s) for s in range(1 << bits)]
        orders = list(itertools.permutations(range(bits)))
        for i in range(bits):
            steps = [(sum(1 << j for j in o[: o.index(i)])) for o in orders]
            assert f.shapley(1 << i) == Fraction(sum(removed(s | 1 << i) - removed(s) for s in steps), len(orders))
