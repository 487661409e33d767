"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Spark's own functions only. Every pattern is written so that a search is linear in the text: runs
are entered at their first character, and loops that cannot give way usefully are possessive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.matches import NO_MATCHES, located

#: Characters before and after a span that are searched for context words.
CONTEXT = 48


#: Length of an account number -> the countries that have it.
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK",
    21: "CH|HR|LI|LV", 22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL",
    24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST", 26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM",
    28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC",
    32: "LC", 33: "RU",
}


def _iban() -> str:
    """A run of its country's length, so that words after it stay out of the checksum; of a country
    that is not listed, a run of any length up to the next listed one."""
    listed = "|".join(IBAN_COUNTRIES.values())
    runs = [f"(?:{names})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, names in IBAN_COUNTRIES.items()]
    runs.append(f"(?!{listed})[A-Z]{{2}}[0-9]{{2}}(?:(?! (?:{listed})[0-9]{{2}}) ?[A-Z0-9]){{11,30}}")
    return f"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(runs)})(?![A-Za-z0-9])"


@dataclass(frozen=True)
class Kind:
    """``gate`` tells cheaply that a text holds no span; ``base`` and ``raised`` are scores without
    and with a context word."""

    name: str
    gate: str
    pattern: str
    context: str
    base: float
    raised: float


#: In the order in which spans of one start are listed. \G lets a run be entered where the match
#: before it has ended.
KINDS = (
    Kind(
        "email", "@",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "mail|contact|write|reply|from|to", 0.8, 0.95,
    ),
    Kind(
        "ip", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
        r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        "ip|address|host|server|login|addr", 0.6, 0.9,
    ),
    Kind(
        "card", r"[0-9](?:[ -]?[0-9]){11}",
        r"[0-9](?:[ -]?[0-9])++",
        "card|visa|mastercard|amex|credit|payment|cvv|expir", 0.7, 0.95,
    ),
    Kind(
        "phone", r"\+[0-9]",
        r"\+[0-9][ ().0-9-]+[0-9]",
        "phone|tel|call|mobile|fax|whatsapp", 0.6, 0.9,
    ),
    Kind(
        "iban", r"[A-Z]{2}[0-9]{2}",
        _iban(),
        "iban|bank|account|transfer|konto|cuenta|compte", 0.8, 0.98,
    ),
    Kind(
        "ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        "ssn|social security|tax", 0.4, 0.9,
    ),
)
BASE_KINDS = tuple(kind.name for kind in KINDS[:4])


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def mod_97(hit: Column) -> Column:
    """Remainder of an account number whose letters count from A = 10, country moved to the end."""
    plain = F.replace(hit, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))

    def step(rest: Column, sign: Column) -> Column:
        code = F.ascii(sign)
        value = F.when(code >= 65, code - 55).otherwise(code - 48)
        return F.pmod(F.when(value > 9, rest * 100 + value).otherwise(rest * 10 + value), F.lit(97))

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c)))


def confirmed(kind: str, hit: Column) -> Column:
    """The validator of a kind."""
    if kind == "ip":
        return hit.rlike(r"\A(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)(?:\.|\z)){4}\z")
    if kind == "card":
        return F.length(_digits(hit)).between(12, 19) & F.call_function("luhn_check", _digits(hit))
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    if kind == "iban":
        return mod_97(hit) == 1
    return F.lit(True)


def _spans(kind: Kind, order: int) -> Column:
    found = F.when(
        F.col("text").contains(kind.gate) if kind.gate == "@" else F.col("text").rlike(kind.gate),
        located(
            F.split("text", kind.pattern, -1),
            F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(0)),
            context=CONTEXT,
        ),
    ).otherwise(F.array().cast(NO_MATCHES))
    near = lambda m: F.concat(m["before"], F.lit(" "), m["after"]).rlike(
        rf"(?i)(?<![A-Za-z])(?:{kind.context})"
    )
    return F.transform(
        F.filter(found, lambda m: confirmed(kind.name, m["hit"])),
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(order).alias("place"),
            m["end"].alias("end"),
            F.lit(kind.name).alias("kind"),
            F.when(near(m), kind.raised).otherwise(kind.base).alias("score"),
        ),
    )


def personal_data(documents: DataFrame) -> DataFrame:
    """``documents`` with ``personal``: structs (kind, start, end, score) by start, then kind.

    Start and end are code points, the end exclusive. A null text is empty. Other columns stay; one
    called ``personal`` is replaced. Rows are independent of each other, so repeated rows and null
    ids need no rule.
    """
    rows = documents.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    spans = F.array_sort(F.concat(*[_spans(kind, i) for i, kind in enumerate(KINDS)]))
    return rows.withColumn("personal", spans).withColumn(
        "personal",
        F.transform(
            "personal",
            lambda s: F.struct(
                s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")
            ),
        ),
    )


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(
        ",",
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
    )
