"""Personal data in whole texts, by DataFrame functions only.

Regular expressions propose spans; validators confirm them (octets of an
address, number of digits, Luhn for cards, mod-97 for IBANs); words near a span
raise its score.  Kinds that are too loose to stand alone (``WEAK``) are kept only
if a context word supports them.

A kind's matches are leftmost and do not overlap.  The patterns are written with
possessive loops and start guards, so that matching is linear in the text and
needs no deep recursion; they find the same spans as the plain forms beside
them.  Positions follow from splitting the text by the same pattern: the lengths
of the pieces and matches before a span add up to its start (in code points).

Defined results: a null or empty text has no spans (counts 0, hash of '');
rows are independent, so repeated rows and null ids pass through; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrank.llm.common import text_or_empty

# Start guard: a match begins where the characters of its first loop begin, or
# where the match before it ended.
_LOCAL = r"[A-Za-z0-9._%+-]"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str            # Java regular expression
    needs: str              # a literal class that must occur at all
    prior: float            # score without context
    context: tuple[str, ...]
    base: bool


# The base kinds, in their order, and the added ones.
KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9,
         ("mail", "contact", "write"), True),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.6,
         ("ip", "address", "host", "server"), True),
    # [0-9]([\x20-]?[0-9])+
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", 0.7, ("card", "visa", "credit", "payment"), True),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.7, ("phone", "call", "tel", "mobile"), True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "", 0.8,
         ("iban", "bank", "account"), False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.2,
         ("ssn", "social security"), False),
)
WEAK = 0.3                  # a span must score more
CONTEXT_CHARS = 40          # looked at on each side of a span
CONTEXT_GAIN = 0.2

_IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 1, F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1)
    ).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN (spaces allowed) leaves 1 modulo 97."""
    s = F.regexp_replace(iban, " ", "")
    turned = F.concat(F.substring(s, 5, 100), F.substring(s, 1, 4))
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)) == 1


def _valid(kind: Kind, m: Column) -> Column:
    if kind.name == "ip":
        return m.rlike(rf"^{_IP_PART}(?:\.{_IP_PART}){{3}}$")
    if kind.name == "card":
        d = _digits(m)
        n = F.length(d)
        return F.when((n >= 14) & (n <= 19), luhn(d)).otherwise(F.lit(False))
    if kind.name == "phone":
        return F.length(_digits(m)).between(10, 15)
    if kind.name == "iban":
        return mod97(m)
    return F.lit(True)


def spans_of(kind: Kind, text: Column) -> Column:
    """Array of ``(start, end, kind)`` of the confirmed matches, by start."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pieces = F.zip_with(F.split(text, kind.pattern, -1), found,
                        lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("m")))
    empty = F.array().cast("array<struct<start:int,end:int,kind:string>>")

    def step(acc, p):
        start = acc["at"] + p["gap"]
        end = start + F.length(p["m"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind.name).alias("kind"))
        out = F.when(p["m"].isNotNull() & _valid(kind, p["m"]), F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(F.coalesce(end, start).alias("at"), out.alias("out"))

    walk = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])
    if kind.needs:
        return F.when(F.contains(text, F.lit(kind.needs)), walk).otherwise(empty)
    return walk


def _score(text: Column, span: Column) -> Column:
    """Prior of the span's kind, raised by a context word nearby."""
    left = F.greatest(span["start"] - CONTEXT_CHARS, F.lit(0))
    near = F.lower(F.concat(F.substring(text, left + 1, span["start"] - left), F.lit(" "),
                            F.substring(text, span["end"] + 1, F.lit(CONTEXT_CHARS))))
    score = F.lit(0.0)
    for k in KINDS:
        hit = near.rlike(r"\b(?:" + "|".join(k.context) + r")")
        score = F.when(span["kind"] == k.name, F.lit(k.prior) + F.when(hit, F.lit(CONTEXT_GAIN)).otherwise(F.lit(0.0))).otherwise(score)
    return F.least(score, F.lit(1.0))


def find_pii(docs: DataFrame, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """``docs`` plus ``out_col``: array of ``(start, end, kind, score)`` by start, then
    kind in the order of ``KINDS``.  Spans of the added kinds that overlap a base
    span of the same text are left to the base kind."""
    text = text_or_empty(text_col)
    base = F.concat(*[spans_of(k, text) for k in KINDS if k.base])
    more = F.concat(*[spans_of(k, text) for k in KINDS if not k.base])
    rows = docs.withColumns({"__base": base, "__more": more})
    clear = F.filter(F.col("__more"), lambda s: ~F.exists(
        F.col("__base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    scored = F.transform(F.concat("__base", clear), lambda s: F.struct(
        s["start"].alias("start"), _order(s["kind"]).alias("order"), s["end"].alias("end"), s["kind"].alias("kind"),
        _score(text, s).alias("score")))
    kept = F.filter(scored, lambda s: (s["order"] < sum(k.base for k in KINDS)) | (s["score"] > WEAK))
    out = F.transform(F.array_sort(kept), lambda s: F.struct(s["start"], s["end"], s["kind"], s["score"]))
    return rows.withColumn(out_col, out).drop("__base", "__more")


def _order(kind: Column) -> Column:
    at = F.lit(len(KINDS))
    for i, k in enumerate(KINDS):
        at = F.when(kind == k.name, F.lit(i)).otherwise(at)
    return at


def is_base(kind: Column) -> Column:
    return kind.isin(*[k.name for k in KINDS if k.base])


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text_col: str = "text", pii_col: str = "pii") -> DataFrame:
    """Replace the spans of ``pii_col`` in the text by ``<kind>``; overlapping spans
    are covered together under the first one's kind.  A null text stays null."""
    text = F.col(text_col)
    n = F.size(pii_col)

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        new = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(new, F.concat(acc["out"], F.array(gap, F.concat(F.lit("<"), s["kind"], F.lit(">")))))
                        .otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    body = F.aggregate(F.col(pii_col), start, step, lambda a: F.concat(
        F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))))
    return docs.withColumn(text_col, F.when(n > 0, body).otherwise(text))


def pii_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every
    document."""
    rows = find_pii(docs.select("doc_id", "text"))
    base = F.filter("pii", lambda s: is_base(s["kind"]))

    def count(kind):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select("doc_id", *[count(k.name) for k in KINDS if k.base],
                       F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"))
