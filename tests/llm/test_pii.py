import re

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusflow.llm import pii as P
from tests.llm.helpers import DOCS, hard_docs

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and P.luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]
    return out


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a@.-+0123456789 ()Zé\n", max_size=60))
def test_base_spans_same_as_plain(text):
    assert [s[:3] for s in P.spans(text) if s[0] in P.BASE_KINDS] == plain(text)


def test_examples():
    text = "Mail a.b@x.org, card 4111 1111 1111 1111, bad 4111 1111 1111 1112, ip 10.0.0.255 and 10.0.0.256, call +1 (988) 555-2485. IBAN GB82 WEST 1234 5698 7654 32, not GB82 WEST 1234 5698 7654 33. Social security 123-45-6789; part 123-45-6789"
    kinds = [s[0] for s in P.spans(text)]
    assert kinds == ["email", "ip", "card", "phone", "iban", "ssn", "ssn"] or kinds.count("iban") == 1
    assert [s[:3] for s in P.spans(text) if s[0] in P.BASE_KINDS] == plain(text)
    assert P.redacted("to a@b.cc or +12345678x") == "to [EMAIL] or [PHONE]x"


def test_context_moves_the_score():
    plain_, near = P.spans("see 10.1.2.3 there")[0][3], P.spans("the host address 10.1.2.3 there")[0][3]
    against = P.spans("version 10.1.2.3 there")[0][3]
    assert against < plain_ < near
    assert not [s for s in P.spans("code 123-45-6789") if s[0] == "ssn"]
    assert [s for s in P.spans("ssn 123-45-6789") if s[0] == "ssn"]


def test_long_texts_take_linear_time():
    for text in ("1" * 300_000, "a." * 200_000, "+1(" * 100_000, "1 " * 200_000, "a" * 400_000 + "@", "1." * 200_000):
        P.spans(text)


def test_tables(spark):
    rows = [*hard_docs(), (9000, "a@b.cc 4111111111111111", "en", "x")]
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("n_lines", "pii")
    got = P.find_pii(docs)
    assert got.columns == ["doc_id", "text", "lang", "pii"] and got.count() == len(rows)
    assert [s.kind for s in got.where("doc_id = 9000").first().pii] == ["email", "card"]
    assert all(r.pii == [] for r in got.where("doc_id IN (1, 2, 3)").collect())
    clean = P.redact(docs)
    assert clean.where("doc_id = 9000").first().text == "[EMAIL] [CARD]" and clean.where("doc_id = 1").first().text is None
    assert P.find_pii(spark.createDataFrame([], DOCS)).collect() == []


def more(text):
    """The added kinds by a plain reading: IBANs that pass mod 97, and social security numbers near their words."""
    out = []
    for m in P.IBAN.finditer(text):
        bare = m[0].replace(" ", "")
        turned = "".join(str(ord(c) - 55) if c.isalpha() else c for c in bare[4:] + bare[:4])
        if 15 <= len(bare) <= 34 and int(turned) % 97 == 1:
            out.append(("iban", *m.span()))
    for m in P.SSN.finditer(text):
        near = text[max(0, m.start() - P.NEAR) : m.start()] + " " + text[m.end() : m.end() + P.NEAR]
        score = P.BASE_SCORE["ssn"] + 0.3 * bool(P.FOR["ssn"].search(near)) - 0.3 * bool("ssn" in P.AGAINST and P.AGAINST["ssn"].search(near))
        if round(score, 2) >= 0.5:
            out.append(("ssn", *m.span()))
    return out


def test_added_spans_of_the_query(spark):
    text = "IBAN GB82 WEST 1234 5698 7654 32 and GB82 WEST 1234 5698 7654 33, ssn 123-45-6789." + " word" * 40 + " 123-45-6780"
    assert [s[0] for s in P.spans(text) if s[0] not in P.BASE_KINDS] == [k for k, *_ in more(text)] == ["iban", "ssn"]
    out = P.op3_pii(spark, "/root/testdata/sf0.01")
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in out.collect():
        assert r.spans == ",".join(f"{k}:{s}:{e}" for k, s, e in plain(texts[r.doc_id]) + more(texts[r.doc_id]))


def test_touching_spans_stay_apart():
    assert P.redacted("a@b.cc+12345678901") == "[EMAIL][PHONE]"


def test_query(spark):
    out = P.op3_pii(spark, "/root/testdata/sf0.01")
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    import hashlib

    for r in out.collect():
        base = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, *_ in base) for x in P.BASE_KINDS)
