"""Personal data in texts with DataFrame functions only: patterns, checksums, context.

Patterns propose spans; Luhn (cards) and mod-97 (IBANs) confirm them; words near a span move its score. The four base
kinds always stay. Two more kinds are added where their score reaches ``least``: IBANs that pass mod-97, and
identity numbers that need a context word.

The patterns have no repeated group that Java would run by recursion and try no start inside a run that has
failed, so time is linear in the text and its spans. Positions are code points, ends are exclusive.

Defined results: a null or empty text has no spans; nothing depends on ids or other columns; an empty table gives an empty table;
rows keep all their columns in the struct ``row``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the contract calls a mail address, IP address, card and phone number.
# Written with possessive repeats and guarded starts, which match the same spans.
_MAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_IDENTITY = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

BASE = ["email", "ip", "card", "phone"]
EXTRA = ["iban", "identity"]
#: Score before the context, words that raise and words that lower it.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.8, "identity": 0.3}
RAISE = {
    "email": "mail|contact|write", "ip": "address|server|host|login", "card": "card|visa|credit|pay",
    "phone": "phone|call|tel|mobile", "iban": "iban|account|bank", "identity": "ssn|social|security|identity|passport",
}
LOWER = "example|version|order|invoice|sample"
STEP = 0.3
REACH = 40  # code points on either side
PIECE = 1024  # code points: places in a long text are found through its pieces
BLOCK = 256  # items whose outputs are gathered together
MATCHES = "array<struct<start:int,match:string>>"


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _folded(items: Column, step, kind: str) -> Column:
    """Outputs of ``step(at, item) -> (at, outputs)`` over an array, from ``at`` 0 on.

    Outputs are gathered by blocks, so that the list so far is not copied for each item.
    """
    empty = F.array().cast(f"array<{kind}>")

    def inner(at, block):
        def add(s, x):
            at, more = step(s["at"], x)
            return F.struct(at.cast("int").alias("at"), F.concat(s["out"], more).alias("out"))
        return F.aggregate(block, F.struct(at.alias("at"), empty.alias("out")), add)

    def outer(s, block):
        return _with(inner(s["at"], block), lambda r: F.struct(
            r["at"].alias("at"), F.concat(s["out"], F.array(r["out"])).alias("out")))

    def blocks(whole):
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(whole), F.lit(1)), F.lit(BLOCK)), lambda i: F.slice(whole, i, BLOCK))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    return _with(items, lambda whole: F.aggregate(blocks(whole), start, outer, lambda s: F.flatten(s["out"])))


def _between(pieces: Column, begin: Column, size: Column) -> Column:
    """``size`` code points from place ``begin`` on, taken from the pieces of PIECE code points that hold them."""
    first = F.floor(begin / PIECE).cast("int")
    some = F.slice(pieces, first + 1, F.floor((begin + size) / PIECE).cast("int") - first + 1)
    return F.array_join(some, "").substr(begin - first * PIECE + 1, size)


def _found(text: Column, pattern: str) -> Column:
    """Matches with their starts: the pieces between matches give the positions."""
    both = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def step(at, x):
        begin = at + F.length(x["gap"])
        hit = F.array(F.struct(begin.alias("start"), x["hit"].alias("match")))
        return begin + F.coalesce(F.length(x["hit"]), F.lit(0)), F.when(x["hit"].isNull(), F.array().cast(MATCHES)).otherwise(hit)

    return _folded(both, step, "struct<start:int,match:string>")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _mod97(match: Column) -> Column:
    plain = F.translate(match, " ", "")
    turned = F.concat(F.substring(plain, 5, 34), F.substring(plain, 1, 4))
    digits = F.transform(F.split(turned, ""), lambda c: F.when(c == "", None).when(c >= "A", F.ascii(c) - 55).otherwise(F.ascii(c) - 48))
    rest = F.aggregate(F.filter(digits, lambda v: v.isNotNull()), F.lit(0),
                       lambda r, v: F.pmod(r * F.when(v > 9, 100).otherwise(10) + v, F.lit(97)).cast("int"))
    return (F.length(plain) >= 15) & (rest == 1)


CHECKS = {
    "email": (_MAIL, None),
    "ip": (_IP, lambda m: F.forall(F.split(m, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))),
    "card": (_CARD, lambda m: F.call_function("luhn_check", F.translate(m, " -", ""))),
    "phone": (_PHONE, lambda m: F.length(_digits(m)).between(8, 15)),
    "iban": (_IBAN, _mod97),
    "identity": (_IDENTITY, lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$")),
}


def _score(kind: str, pieces: Column, x: Column) -> Column:
    begin = F.greatest(x["start"] - REACH, F.lit(0))
    near = F.lower(F.concat(
        _between(pieces, begin, x["start"] - begin), F.lit(" "),
        _between(pieces, x["start"] + F.length(x["match"]), F.lit(REACH))))
    raised = F.when(near.rlike(rf"\b(?:{RAISE[kind]})"), STEP).otherwise(0.0)
    lowered = F.when(near.rlike(rf"\b(?:{LOWER})\b"), STEP).otherwise(0.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(PRIOR[kind]) + raised - lowered))


def _passing(found: Column, check) -> Column:
    return F.filter(found, lambda x: check(x["match"]))


def _scored(found: Column, kind: str, pieces: Column) -> Column:
    return F.transform(found, lambda x: F.struct(
        F.lit(kind).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["match"])).alias("end"),
        x["match"].alias("match"), _score(kind, pieces, x).alias("score")))


def spans(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """Each row as struct ``row``, its text as ``text``, ``spans`` (kind, start, end, match, score in the order of kinds) and ``pieces`` of the text."""
    out = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    out = out.withColumn("pieces", F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))
    body = F.col("text")
    kinds = []
    for kind, (pattern, check) in CHECKS.items():
        found = _found(body, pattern)
        if kind == "email":
            found = F.when(body.contains("@"), found).otherwise(F.array().cast(MATCHES))
        if check:
            found = _passing(found, check)
        found = _scored(found, kind, F.col("pieces"))
        kinds.append(found if kind in BASE else F.filter(found, lambda x: x["score"] >= least))
    return out.select("row", "text", F.concat(*kinds).alias("spans"), "pieces")


def count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")


def listed(kinds: list[str]) -> Column:
    """``kind:start:end`` of the spans of these kinds, comma-joined."""
    chosen = F.filter("spans", lambda x: x["kind"].isin(kinds))
    return F.array_join(F.transform(chosen, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redacted() -> Column:
    """``text`` with each span, or group of overlapping spans, replaced by the kind of its first one in brackets."""
    pieces, text = F.col("pieces"), F.col("text")
    ordered = F.array_sort(F.transform("spans", lambda x: F.struct(x["start"], x["end"], x["kind"])))
    # a span beyond the text's end writes the rest
    closed = F.concat(ordered, F.array(F.struct(F.length(text).alias("start"), F.length(text).alias("end"), F.lit("").alias("kind"))))

    def put(at, x):
        before = _between(pieces, at, x["start"] - at)
        mark = F.when(x["kind"] == "", "").otherwise(F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
        return F.greatest(at, x["end"]), F.when(x["start"] >= at, F.array(before, mark)).otherwise(F.array().cast("array<string>"))

    return F.when(F.size("spans") == 0, text).otherwise(F.array_join(_folded(closed, put, "string"), ""))
