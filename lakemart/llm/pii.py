"""Personal data: patterns propose spans, checksums confirm them, context moves their score.

Everything is Spark SQL. A pattern's matches come from ``regexp_extract_all``; their places come
from splitting the text by the same pattern, since the lengths of gaps and matches add up to the
offsets. Patterns are possessive and start either where the last match ended or where no character
of their first class stands before: the same matches as the plain forms, in linear time, and
without deep recursion on very long runs. Of an account number only the beginning is matched; where
it ends is tried at each end of a word, for a word or another number may follow in the same letters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds in their order, with patterns, a character each match must hold, the
# words whose nearness speaks for the kind, and the score without them.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})",
}
NEEDS = {
    "email": r"@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9][\x20-]?[0-9]",
    "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}",
}
CONTEXT = {
    "email": r"(?i)\b(e-?mail|contact|write|mail)\b",
    "ip": r"(?i)\b(ip|host|server|address|login)\b",
    "card": r"(?i)\b(card|visa|mastercard|credit|payment|pay)\b",
    "phone": r"(?i)\b(phone|tel|call|mobile|fax)\b",
    "iban": r"(?i)\b(iban|account|bank|konto|transfer)\b",
}
SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
BONUS = 0.1  # added where a context word is near
NEAR = 40  # code points before and after a span that count as near
BASE = ("email", "ip", "card", "phone")
IBAN = r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+[A-Za-z0-9]?"  # the last: no end of a word yet
IBAN_REACH = 65  # code points that this can match
LENGTHS = (  # of account numbers, after their country
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 "
    "DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 "
    "IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 "
    "MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 "
    "SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid Luhn check digit."""

    def place(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    values = F.transform(F.split(F.reverse(digits), ""), place)
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number (letters and digits) leaves 1 by ISO 7064 mod 97."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(letter >= 10, rest * 100 + letter).otherwise(rest * 10 + F.ascii(c) - 48) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def _confirmed(kind: str, value: Column) -> Column:
    digits = F.length(_digits(value))
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
        return value.rlike(rf"^(?:{part}\.){{3}}{part}$")
    if kind == "card":
        return F.when(digits.between(13, 19), luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return digits.between(9, 15)
    return F.lit(True)


def account(text: Column) -> Column:
    """The account number that a text begins with, or null.

    Every end of a word is tried that leaves 15 to 34 letters and digits, which mod 97 confirms. The
    length of the country goes first, then the longest.
    """
    words = F.split(F.regexp_extract(text, IBAN, 0), " ")
    heads = F.transform(
        F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, 1, n), " ")
    )

    def size(head: Column) -> Column:
        return F.length(F.replace(head, F.lit(" "), F.lit("")))

    valid = F.filter(
        heads,
        lambda h: F.when(size(h).between(15, 34) & ~h.rlike("[a-z]"), mod97(h)).otherwise(False),
    )
    listed = F.filter(
        valid, lambda h: F.contains(F.lit(LENGTHS), F.concat(F.substring(h, 1, 2), size(h).cast("string")))
    )
    return F.coalesce(F.get(listed, F.lit(0)), F.get(valid, F.size(valid) - 1))


def accounts(text: Column, heads: Column) -> Column:
    """Account numbers of ``text`` among those that begin at ``heads``; of overlapping ones the first."""

    def one(m: Column) -> Column:
        value = account(F.substring(text, m["start"] + 1, F.lit(IBAN_REACH)))
        return F.struct(
            m["start"].alias("start"), (m["start"] + F.length(value)).alias("end"), value.alias("value")
        )

    start = F.struct(
        F.lit(0).alias("at"),
        F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)").alias("out"),
    )

    def step(state: Column, m: Column) -> Column:
        free = m["start"] >= state["at"]
        return F.struct(
            F.when(free, m["end"]).otherwise(state["at"]).alias("at"),
            F.when(free, F.concat(state["out"], F.array(m))).otherwise(state["out"]).alias("out"),
        )

    found = F.filter(F.transform(heads, one), lambda m: m["value"].isNotNull())
    return F.aggregate(found, start, step, lambda s: s["out"])


def matches(text: Column, pattern: str, needs: str) -> Column:
    """All matches in order as array of (start, end, value); code points, end exclusive."""
    has = text.rlike(needs)
    value = F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return F.when(F.size(value) > 0, _placed(value, F.split(text, pattern, -1)))


def _placed(values: Column, gaps: Column) -> Column:
    steps = F.zip_with(
        values,
        F.slice(gaps, 1, F.size(values)),
        lambda v, g: F.struct(F.length(g).alias("gap"), F.length(v).alias("n"), v.alias("v")),
    )
    start = F.struct(
        F.lit(0).alias("at"),
        F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)").alias("out"),
    )

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["gap"]
        end = begin + x["n"]
        span = F.struct(begin.alias("start"), end.alias("end"), x["v"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    return F.aggregate(steps, start, step, lambda s: s["out"])


def find(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with ``spans``: array of (kind, start, end, value, score), by kind, then start.

    A null or empty text has no spans. Kinds may overlap; one kind's spans never do. Confirmed
    account numbers (IBAN, mod 97) come after the four base kinds. The score is that of the kind,
    plus a bonus where a context word stands within ``NEAR`` code points. An input column of the
    name of ``spans`` is replaced; those beginning with ``_q_`` are reserved.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs.select(
        *[c for c in docs.columns if c != spans],
        *[matches(body, PATTERNS[k], NEEDS[k]).alias(f"_q_{k}") for k in PATTERNS],
    )

    def scored(kind: str):
        def one(m: Column) -> Column:
            begin = F.greatest(m["start"] - NEAR, F.lit(0))
            before = F.substring(body, begin + 1, m["start"] - begin)
            after = F.substring(body, m["end"] + 1, F.lit(NEAR))
            near = before.rlike(CONTEXT[kind]) | after.rlike(CONTEXT[kind])
            return F.struct(
                F.lit(kind).alias("kind"),
                m["start"].alias("start"),
                m["end"].alias("end"),
                m["value"].alias("value"),
                (F.lit(SCORE[kind]) + F.when(near, BONUS).otherwise(0.0)).alias("score"),
            )

        return one

    def confirmed(kind: str):
        return lambda m: _confirmed(kind, m["value"])

    nothing = F.expr(
        "cast(array() as array<struct<kind:string,start:int,end:int,value:string,score:double>>)"
    )
    found = []
    for k in PATTERNS:
        good = accounts(body, F.col("_q_iban")) if k == "iban" else F.filter(f"_q_{k}", confirmed(k))
        found.append(F.coalesce(F.transform(good, scored(k)), nothing))
    return out.select(
        *[c for c in docs.columns if c != spans], F.concat(*found).alias(spans)
    )


def redact(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` with each confirmed span of ``text`` replaced by its kind, as in ``[EMAIL]``.

    Spans scored under ``least`` stay. Of overlapping spans the one that begins first, or else the
    longest, is named, and all that they cover goes. Texts without spans, and null texts, stay as
    they are.
    """
    spans = "_q_spans"
    order = lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(
        b["end"] - a["end"]
    )
    sorted_spans = F.array_sort(F.filter(spans, lambda s: s["score"] >= least), order)
    body = F.col(text)
    # The text before each span not covered yet, and the span's name.
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))

    def step(state: Column, s: Column) -> Column:
        kept = F.concat(
            F.substring(body, state["at"] + 1, s["start"] - state["at"]),
            F.lit("["),
            F.upper(s["kind"]),
            F.lit("]"),
        )
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(s["start"] < state["at"], state["out"])
            .otherwise(F.concat(state["out"], F.array(kept)))
            .alias("out"),
        )

    clean = F.aggregate(
        sorted_spans,
        start,
        step,
        lambda s: F.concat(
            F.array_join(s["out"], ""), F.substring(body, s["at"] + 1, F.length(body))
        ),
    )
    new = F.when(F.size(sorted_spans) > 0, clean).otherwise(body)
    return find(docs, text, spans).select(
        *[(new if c == text else F.col(f"`{c}`")).alias(c) for c in docs.columns]
    )


def digest(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of the spans, comma-joined in their order; only ``kinds`` if given."""
    if kinds is not None:
        spans = F.filter(spans, lambda s: reduce(lambda a, b: a | b, [s["kind"] == k for k in kinds]))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
