"""Personal data: patterns propose spans, validators confirm them, context adjusts scores."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Code points before a span in which context words are looked for.
CONTEXT_CHARS = 40


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.

    ``pattern`` proposes, ``hint`` is a cheap test of the whole text without which there
    is no match, ``valid`` confirms a match. A match scores ``score`` of 100, and ``boost``
    more behind one of the ``context`` words; below ``least`` it is dropped.
    """

    name: str
    pattern: str
    hint: str
    valid: Callable[[Column], Column]
    score: int
    boost: int
    context: str
    least: int = 0


def _any(match: Column) -> Column:
    return F.lit(True)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _is_ip(match: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return match.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _is_card(match: Column) -> Column:
    return F.length(_digits(match)).between(14, 19) & F.call_function("luhn_check", _digits(match))


def _is_phone(match: Column) -> Column:
    return F.length(_digits(match)).between(10, 15)


def _is_iban(match: Column) -> Column:
    """Mod-97 over the rearranged number, letters as 10 to 35."""
    plain = F.replace(match, F.lit(" "))
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _is_ssn(match: Column) -> Column:
    shape = "^[0-9]{3}-[0-9]{2}-[0-9]{4}$"
    void = "^(?:000|666|9)|-00-|-0000$"
    return match.rlike(shape) & ~match.rlike(void)


# How the issuers of access keys shape them.
KEY_SHAPES = (
    "(?:AKIA|ASIA)[A-Z0-9]{16}",
    "gh[oprsu]_[A-Za-z0-9]{36}",
    "github_pat_[A-Za-z0-9_]{82}",
    "glpat-[A-Za-z0-9_-]{20}",
    "xox[abprs]-[A-Za-z0-9-]{16,}",
    "AIza[A-Za-z0-9_-]{35}",
    "(?:sk|rk|pk)[_-](?:live|test|proj|ant)[_-][A-Za-z0-9_-]{16,}",
)
KEY_SHAPE = f"^(?:{'|'.join(KEY_SHAPES)})$"
# A secret of no known shape has so many different characters, and a digit among so many characters.
SECRET_DISTINCT = 10
SECRET_DIGIT_IN = 8


def _is_key(match: Column) -> Column:
    return match.rlike(KEY_SHAPE)


def _is_secret(match: Column) -> Column:
    """As random as a secret: words, names and plain numbers are not."""
    distinct = F.size(F.array_distinct(F.split(match, "")))
    digits = F.length(_digits(match)) * SECRET_DIGIT_IN
    return (
        ~match.rlike(KEY_SHAPE)
        & match.rlike("[A-Za-z]")
        & (distinct >= SECRET_DISTINCT)
        & (digits >= F.length(match))
    )


# How long the IBANs of a country are.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}


def _iban_pattern() -> str:
    """A country's IBAN takes its length and ends there; of other countries any length is proposed."""

    def blocks(length: int) -> str:
        whole, rest = divmod(length - 4, 4)
        return rf"(?:\x20?[A-Z0-9]{{4}}){{{whole}}}" + (rf"\x20?[A-Z0-9]{{{rest}}}" if rest else "")

    known = "|".join("|".join(names.split()) for names in IBAN_LENGTHS.values())
    each = [
        rf"(?:{names.replace(' ', '|')})[0-9]{{2}}{blocks(length)}(?![A-Z0-9])"
        for length, names in IBAN_LENGTHS.items()
    ]
    other = rf"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?"
    return f"(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join([*each, other])})"


# The first four are the base kinds: their patterns find what the plain ones find. Possessive
# repeats and a start at the head of a run only spare the engine hopeless attempts.
BASE = ("email", "ip", "card", "phone")
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        _any,
        90,
        10,
        "mail|contact|write",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
        r"[0-9]\.[0-9]",
        _is_ip,
        60,
        30,
        "ip|host|server|address",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        r"[0-9](?:[\x20-]?[0-9]){13}",
        _is_card,
        80,
        20,
        "card|visa|credit|pay",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9]",
        _is_phone,
        70,
        30,
        "phone|call|tel|mobile",
    ),
    Kind(
        "iban",
        _iban_pattern(),
        r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}",
        _is_iban,
        90,
        10,
        "iban|account|bank",
    ),
    Kind(
        "ssn",
        r"[0-9]+(?:-[0-9]+){2,}",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        _is_ssn,
        40,
        40,
        "ssn|social|security",
        60,
    ),
    Kind(
        "key",
        r"[A-Za-z0-9_-]{20,}+",
        r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20}",
        _is_key,
        90,
        10,
        "token|secret|passw|key|auth|credential|bearer",
    ),
    Kind(
        "secret",
        r"[A-Za-z0-9_-]{20,}+",
        r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20}",
        _is_secret,
        30,
        40,
        "token|secret|passw|key|auth|credential|bearer",
        60,
    ),
)


def _spans(text: Column, hinted: Column, number: int, kind: Kind) -> Column:
    """Array of (start, kind number, end, score) of one kind.

    Matches and the gaps between them alternate, so lengths summed up along the text are
    positions in code points.
    """
    gaps, matches = F.split(text, kind.pattern, -1), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    near = lambda gap: F.lower(F.right(gap, F.lit(CONTEXT_CHARS))).rlike(kind.context)
    steps = F.zip_with(
        F.slice(gaps, 1, F.size(matches)),
        matches,
        lambda gap, match: F.struct(
            F.length(gap).alias("gap"),
            F.length(match).alias("length"),
            kind.valid(match).alias("valid"),
            F.when(near(gap), F.lit(kind.score + kind.boost))
            .otherwise(F.lit(kind.score))
            .alias("score"),
        ),
    )
    empty = F.expr("CAST(array() AS ARRAY<STRUCT<start: INT, kind: INT, end: INT, score: INT>>)")

    def add(done: Column, step: Column) -> Column:
        start = done["at"] + step["gap"]
        end = start + step["length"]
        span = F.struct(
            start.alias("start"), F.lit(number).alias("kind"), end.alias("end"), step["score"].alias("score")
        )
        counts = step["valid"] & (step["score"] >= kind.least)
        return F.struct(
            end.alias("at"),
            F.when(counts, F.array_append(done["spans"], span))
            .otherwise(done["spans"])
            .alias("spans"),
        )

    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    found = F.aggregate(steps, start, add, lambda done: done["spans"])
    return F.when(hinted, found).otherwise(empty)


def personal_data(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", kinds: tuple[Kind, ...] = KINDS
) -> DataFrame:
    """(id, found) per row: ``found`` is an array of (start, kind, end, score) in text order.

    Starts and ends count code points, ends exclusive; ``kind`` indexes ``kinds``; equal
    starts follow in the order of kinds. Spans of different kinds may overlap. Built-in
    functions only, row by row: nothing is shuffled.

    A null text is empty and has no spans. Rows with null or repeated ids are rows like any
    other; an empty table gives an empty result. Columns other than the two named are
    not carried.
    """
    rows = df.select(
        F.col(id_column).alias(id_column), F.coalesce(F.col(text_column), F.lit("")).alias("__text")
    )
    # Kinds with the same hint share one look at the text.
    hints = {kind.hint: f"__hint{i}" for i, kind in enumerate(kinds)}
    rows = rows.select("*", *[F.col("__text").rlike(h).alias(name) for h, name in hints.items()])
    each = [_spans(F.col("__text"), F.col(hints[k.hint]), i, k) for i, k in enumerate(kinds)]
    return rows.select(id_column, F.array_sort(F.concat(*each)).alias("found"))


def span_digest(found: DataFrame, id_column: str = "doc_id", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Counts per kind, a digest of the base spans, all spans and their scores as text."""
    names = F.array(*[F.lit(k.name) for k in kinds])
    spans, base = F.col("found"), len(BASE)

    def joined(array: Column) -> Column:
        text = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        return F.concat_ws(",", F.transform(array, text))

    def number(kind: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    counts = [number(i).alias(f"n_{k.name}") for i, k in enumerate(kinds)]
    return found.select(
        id_column,
        *counts,
        F.sha2(joined(F.filter(spans, lambda s: s["kind"] < base)), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
        F.concat_ws(",", F.transform(spans, lambda s: s["score"].cast("string"))).alias("scores"),
    )
