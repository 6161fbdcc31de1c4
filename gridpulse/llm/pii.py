"""Personal data in texts, in DataFrame expressions alone.

Regular expressions propose spans, validators confirm them (parts of an address, the Luhn sum of a card, the
mod-97 remainder of an account number), and words nearby move the score up or down. Spans of the base
patterns always stay. Further spans, whose form alone says too little, need a score of LEAST_SCORE: numbers of cards
within longer runs of digits, national phone numbers, account numbers and social security numbers.

Every pattern is written so that a text is scanned in linear time: a repeated part gives nothing back, and a match
starts where a run of its characters starts or where the match before has ended.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.divergence import let, total

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")  # in the order of spans that start together
LEAST_SCORE = 75  # of 100, for a span that no base pattern has
BEFORE, AFTER = 40, 20  # characters next to a span in which words count, up to the next match of its pattern
MOST_CODES = 68  # characters of an account number with its spaces
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Pattern:
    """``find`` is what a scan uses, ``plain`` the same set of matches in the plainest words, ``hint`` what a text without matches lacks."""

    find: str
    plain: str
    hint: str


# --- fixed values: the base patterns, as the contract states them (plain) ---------
LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = Pattern(
    rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    rf"{LOCAL}+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "@",
)
IP = Pattern(
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
)
CARD = Pattern(r"[0-9](?:[ -]?[0-9])++", r"[0-9]([\x20-]?[0-9])+", r"[0-9](?:[ -]?[0-9]){11}")
PHONE = Pattern(r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]")

# --- patterns of the further spans -------------------------------------------------
GROUP = Pattern("[0-9]{13,}+", "[0-9]{13,}", "[0-9]{13}")  # within a run of digits that is no card
NATIONAL = Pattern(r"\(?[0-9][0-9(). -]*[0-9]", r"\(?[0-9][0-9(). -]*[0-9]", "[0-9]{3}[ .-][0-9]{4}")
IBAN = Pattern(r"[A-Z]{2}[0-9]{2}[A-Z0-9]*+(?: [A-Z0-9]++)*+", r"[A-Z]{2}[0-9]{2}[A-Z0-9]*(?: [A-Z0-9]+)*", "[A-Z]{2}[0-9]{2}[ ]?[A-Z0-9]")
SSN = Pattern(r"(?<![0-9])[0-9]++(?:-[0-9]++)++", r"[0-9]+(?:-[0-9]+)+", "[0-9]{3}-[0-9]{2}-[0-9]{4}")
NATIONAL_FORM = r"^\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}$"
SSN_FORM = r"^(?:00[1-9]|0[1-9][0-9]|[1-578][0-9][0-9]|6[0-57-9][0-9]|66[0-57-9])-(?:0[1-9]|[1-9][0-9])-(?:000[1-9]|00[1-9][0-9]|0[1-9][0-9][0-9]|[1-9][0-9]{3})$"
IP_FORM = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
ISSUER = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|64[4-9]|65|35|30|36|38)"

# --- fixed values: length of account numbers by country, ISO 13616 -----------------
IBAN_LENGTH = {
    "AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18,
    "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21,
    "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}

# Words, in lower case, that speak for a kind; and against it.
FOR = {
    "email": "e-mail|email|mail|contact|write|reply|kontakt|correo|courriel",
    "ip": "ip|address|server|host|ping|login|adresse",
    "card": "card|credit|debit|visa|mastercard|amex|karte|carte|tarjeta|payment",
    "phone": "phone|tel|call|mobile|cell|fax|telefon|telefono|telephone|anruf",
    "iban": "iban|account|bank|konto|cuenta|compte",
    "ssn": "ssn|social security|security number|tax id",
}
AGAINST = {"ip": "version|release|section|chapter"}
# Points of a span whose form is confirmed, and what words nearby add or take.
POINTS = {"email": 80, "ip": 50, "card": 55, "phone": 60, "iban": 85, "ssn": 45}
WORD_POINTS = {"email": 15, "ip": 30, "card": 25, "phone": 30, "iban": 10, "ssn": 30}
ISSUER_POINTS = 20
NATIONAL_POINTS = 45


def running(sizes: Column) -> Column:
    """Sums up to each place, in rounds that each double how far a sum reaches back."""
    strides = F.array(*(F.lit(1 << k) for k in range(30)))
    reach = lambda done, s: F.transform(done, lambda x, i: x + F.coalesce(F.get(done, i - s), F.lit(0)))
    return let(sizes, lambda x: F.aggregate(F.filter(strides, lambda s: s < F.size(x)), x, reach))


def proposed(text: Column, pattern: Pattern) -> Column:
    """Matches as structs of m, start and end (code points, end exclusive), near (what stands next to it) and last (the character before)."""
    kind = "array<struct<m:string,start:int,end:int,near:string,last:string>>"

    def placed(x: Column) -> Column:
        ends = running(F.transform(x["found"], lambda m, i: F.length(F.get(x["gaps"], i)) + F.length(m)))

        def one(ends: Column) -> Column:
            def span(m: Column, i: Column) -> Column:
                gap = F.get(x["gaps"], i)
                near = F.concat(F.right(gap, F.lit(BEFORE)), F.lit(" "), F.left(F.get(x["gaps"], i + 1), F.lit(AFTER)))
                return F.struct(
                    m.alias("m"),
                    (F.get(ends, i) - F.length(m)).alias("start"),
                    F.get(ends, i).alias("end"),
                    F.translate(near, UPPER, LOWER).alias("near"),
                    F.right(gap, F.lit(1)).alias("last"),
                )

            return F.transform(x["found"], span)

        return let(ends, one)

    both = F.struct(F.split(text, pattern.find, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern.find), 0).alias("found"))
    return F.when(text.rlike(pattern.hint), let(both, placed).cast(kind)).otherwise(F.array().cast(kind))


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def luhn(number: Column) -> Column:
    """Whether the digits of a number of at most 19 add up to a multiple of ten, every second one from the end doubled and cut down."""
    back = F.reverse(number)

    def value(i: Column) -> Column:
        digit = F.substring(back, i, F.lit(1))
        return F.when(i % 2 == 0, F.translate(digit, "0123456789", "0246813579")).otherwise(digit).cast("int")

    return total(F.transform(F.sequence(F.lit(1), F.length(number)), value), F.lit(0)) % 10 == 0


def card_number(m: Column) -> Column:
    return let(digits(m), lambda d: F.length(d).between(12, 19) & luhn(F.left(d, F.lit(19))))


def remainder97(number: Column) -> Column:
    """Of an account number without spaces: its first four characters put last, letters as 10 to 35, modulo 97."""
    turned = F.concat(F.substring(number, F.lit(5), F.length(number)), F.left(number, F.lit(4)))

    def step(rest: Column, i: Column) -> Column:
        c = F.substring(turned, i, F.lit(1))
        letter = F.ascii(c) >= 65
        return F.when(letter, rest * 100 + F.ascii(c) - 55).otherwise(rest * 10 + F.ascii(c) - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), step)


def account_length(m: Column) -> Column:
    """Characters at the start of a match that make an account number, spaces included; null if they make none."""
    lengths = F.create_map(*(F.lit(x) for pair in IBAN_LENGTH.items() for x in pair))

    def check(head: Column) -> Column:
        size = lengths[F.left(head, F.lit(2))]
        ends = F.sequence(F.lit(15), F.least(F.lit(MOST_CODES), F.length(head)))
        fits = F.array_min(F.filter(ends, lambda n: F.length(F.replace(F.left(head, n), F.lit(" "), F.lit(""))) == size))

        def real(n: Column) -> Column:
            ended = F.substring(head, n + 1, F.lit(1)).isin("", " ")
            return F.when(ended & (remainder97(F.replace(F.left(head, n), F.lit(" "), F.lit(""))) == 1), n)

        return F.when(F.length(head) >= 15, let(fits, real))

    return let(F.left(m, F.lit(MOST_CODES + 1)), check)


def said(near: Column, words: str) -> Column:
    return near.rlike(f"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)")


def scored(spans: Column, kind: str, points: int, base: bool, issuer: bool = False) -> Column:
    """Spans with their scores, sortable; a span that no base pattern has needs LEAST_SCORE."""

    def span(x: Column) -> Column:
        score = F.lit(points) + F.when(said(x["near"], FOR[kind]), WORD_POINTS[kind]).otherwise(0)
        if kind in AGAINST:
            score = score - F.when(said(x["near"], AGAINST[kind]), WORD_POINTS[kind]).otherwise(0)
        if issuer:
            score = score + F.when(digits(x["m"]).rlike(ISSUER), ISSUER_POINTS).otherwise(0)
        return F.struct(
            x["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("order"),
            x["end"].alias("end"),
            F.lit(kind).alias("kind"),
            score.alias("score"),
            F.lit(base).alias("base"),
        )

    made = F.transform(spans, span)
    return made if base else F.filter(made, lambda x: x["score"] >= LEAST_SCORE)


def groups_within(run: Column) -> Column:
    """Groups of 13 digits or more within a run of digits, placed in the text, that are numbers of cards."""
    near = run["near"]

    def moved(x: Column) -> Column:
        first = run["start"]
        return F.struct(x["m"].alias("m"), (x["start"] + first).alias("start"), (x["end"] + first).alias("end"), near.alias("near"), x["last"].alias("last"))

    return F.filter(F.transform(proposed(run["m"], GROUP), moved), lambda x: card_number(x["m"]))


def spans_of(text: Column) -> Column:
    """All spans of a text, by start, kind and end."""

    def cards(found: Column) -> Column:
        marked = F.transform(found, lambda x: F.struct(x.alias("x"), card_number(x["m"]).alias("ok")))

        def both(all_: Column) -> Column:
            right = F.transform(F.filter(all_, lambda y: y["ok"]), lambda y: y["x"])
            wrong = F.flatten(F.transform(F.filter(all_, lambda y: ~y["ok"]), lambda y: groups_within(y["x"])))
            return F.concat(scored(right, "card", POINTS["card"], True, True), scored(wrong, "card", POINTS["card"], False, True))

        return let(marked, both)

    def account(x: Column) -> Column:
        return let(account_length(x["m"]), lambda n: F.struct(x["m"].alias("m"), x["start"].alias("start"), (x["start"] + n).alias("end"), x["near"].alias("near"), x["last"].alias("last")))

    emails = proposed(text, EMAIL)
    ips = F.filter(proposed(text, IP), lambda x: x["m"].rlike(IP_FORM))
    phones = F.filter(proposed(text, PHONE), lambda x: F.length(digits(x["m"])).between(9, 15))
    national = F.filter(proposed(text, NATIONAL), lambda x: x["m"].rlike(NATIONAL_FORM) & (x["last"] != "+"))
    accounts = F.filter(F.transform(proposed(text, IBAN), account), lambda x: x["end"].isNotNull())
    social = F.filter(proposed(text, SSN), lambda x: x["m"].rlike(SSN_FORM))
    return F.sort_array(
        F.concat(
            scored(emails, "email", POINTS["email"], True),
            scored(ips, "ip", POINTS["ip"], True),
            let(proposed(text, CARD), cards),
            scored(phones, "phone", POINTS["phone"], True),
            scored(national, "phone", NATIONAL_POINTS, False),
            scored(accounts, "iban", POINTS["iban"], False),
            scored(social, "ssn", POINTS["ssn"], False),
        )
    )


def find_spans(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id and spans, an array of structs of start, end, kind, score (0 to 100) and base.

    Places are code points, ends exclusive; base tells the spans of the base patterns, which stay whatever their score. A null
    or empty text has none. Repeated rows and null ids keep their rows, other columns play no part, an empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.inline(F.array(F.struct(let(text, spans_of).alias("spans")))))


def report(docs: DataFrame) -> DataFrame:
    """Spans as text: doc_id, n_email, n_ip, n_card, n_phone (of the base patterns), base_sha256, spans and scores (of all, in one order)."""
    spans = F.col("spans")
    of = lambda kind: F.size(F.filter(spans, lambda x: x["base"] & (x["kind"] == kind))).cast("long").alias(f"n_{kind}")
    named = lambda some: F.array_join(F.transform(some, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return find_spans(docs).select(
        "doc_id",
        *map(of, KINDS[:4]),
        F.sha2(named(F.filter(spans, lambda x: x["base"])), 256).alias("base_sha256"),
        named(spans).alias("spans"),
        F.array_join(F.transform(spans, lambda x: x["score"].cast("string")), ",").alias("scores"),
    )
