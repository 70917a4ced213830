"""Personal data: patterns propose spans, checksums confirm them, and context
words nearby adjust their scores.

Base kinds (email, ip, card, phone) are kept whenever their pattern and checksum
hold, whatever their score. Added kinds (iban, ssn) are kept when their score
reaches min_score: an IBAN must pass mod 97, a US social security number needs
a context word. Patterns are written so that no text takes more than linear
time: they are anchored on a rare character or use possessive repeats.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import ship, without

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DIGIT = re.compile(r"[0-9]")
# A shorter run of digits cannot hold the 16 that a card needs.
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){15,}+")
# A match that starts inside a run of digits would also start at the run's start.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.7, "ssn": 0.3}
FOR = {
    "email": re.compile(r"(?i)\b(?:e-?mail|contact|write|correo|kontakt|courriel)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|address|host|server|login)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|credit|payment|tarjeta|karte|carte)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|call|mobile|fax|telefon|tel[eé]fono)\b"),
    "iban": re.compile(r"(?i)\b(?:iban|bank|account|konto|cuenta|compte)\b"),
    "ssn": re.compile(r"(?i)\b(?:ssn|social security)\b"),
}
AGAINST = {
    "ip": re.compile(r"(?i)\b(?:version|release|section)\b"),
    "card": re.compile(r"(?i)\b(?:isbn|order|serial|tracking)\b"),
    "phone": re.compile(r"(?i)\b(?:order|serial|part)\b"),
}
NEAR = 48


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of local@domain, found from the @ signs."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        end = at + 1
        if at > free and text[at - 1] in LOCAL and (m := DOMAIN.match(text, at + 1)):
            start = at - 1
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            out.append((start, m.end()))
            free = end = m.end()
        at = text.find("@", end)
    return out


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _score(kind: str, text: str, start: int, end: int) -> float:
    around = text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]
    score = BASE_SCORE[kind] + 0.3 * bool(FOR[kind].search(around))
    if kind in AGAINST and AGAINST[kind].search(around):
        score -= 0.3
    return round(min(1.0, max(0.0, score)), 2)


def spans(text: str, min_score: float = 0.5) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind, then start; code points, end exclusive."""
    found: list[tuple[str, int, int]] = [("email", *x) for x in _emails(text)]
    if DIGIT.search(text):
        found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        found += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            found += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
        found += [("iban", *m.span()) for m in IBAN.finditer(text) if 15 <= len(i := m[0].replace(" ", "")) <= 34 and mod97(i)]
        found += [("ssn", *m.span()) for m in SSN.finditer(text)]
    out = [(k, s, e, _score(k, text, s, e)) for k, s, e in found]
    return [x for x in out if x[0] in BASE_KINDS or x[3] >= min_score]


SPAN_TYPE = "array<struct<kind:string,start:int,end:int,score:double>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def find_pii(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """docs (text, ...) plus pii: array of (kind, start, end, score), by kind in the
    order of KINDS, then start. A null or empty text has an empty array. Other columns and
    repeated rows pass through; a column that is already named pii is replaced. No rows in, no rows out."""
    ship(docs.sparkSession)

    @F.arrow_udf(SPAN_TYPE)
    def pii(texts: pa.Array) -> pa.Array:
        return pa.array([[{"kind": k, "start": s, "end": e, "score": c} for k, s, e, c in spans(t.as_py() or "", min_score)] for t in texts], _ARROW)

    return without(docs, ["pii"]).withColumn("pii", pii("text"))


def redact(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """docs (text, ...) with every span replaced by its kind in brackets, as [EMAIL].

    Spans that overlap become one, named after the first; those that only touch stay apart. A null text stays
    null. Other columns and repeated rows pass through; no rows in, no rows out."""
    ship(docs.sparkSession)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([None if (x := t.as_py()) is None else redacted(x, min_score) for t in texts], pa.string())

    return docs.withColumn("text", clean("text"))


def redacted(text: str, min_score: float = 0.5) -> str:
    out, at = [], 0
    for kind, start, end, _ in sorted(spans(text, min_score), key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def op3_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda *kinds: F.filter("pii", lambda s: s["kind"].isin(*kinds))
    return find_pii(docs).select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(written(of(*BASE_KINDS)).cast("binary"), 256).alias("base_sha256"),
        written(F.col("pii")).alias("spans"),
    )
