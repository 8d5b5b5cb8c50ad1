"""Personal data in texts: patterns propose spans, checks confirm them, nearby words adjust a score.

DataFrame functions only. A pattern's matches and the pieces between them give the places: a match starts
where the lengths of everything before it add up to. Patterns are written so that no run of characters is
read again from each of its places (guards at a run's start, possessive repeats); they match what the plain
patterns of the contract match. Account numbers are found at every end that their checksum confirms, also where the
plain pattern takes a sign of the next word with it and loses the number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import id_and_text

LOCAL, DIGITS = r"[A-Za-z0-9._%+-]", r"[0-9]"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"

#: Kinds in their order of output: pattern, a character that every match has, prior score, context words.
PATTERNS: dict[str, tuple[str, str, float, str]] = {
    "email": (rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.8, "e-?mail|contact|write"),
    "ip": (rf"(?:\G|(?<!{DIGITS}))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.6, "ip|host|server|address"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "", 0.6, "card|visa|master|credit|pay"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.6, "phone|call|tel|mobile|fax"),
    # The first four signs; group 1 is all that may belong to the number, one sign more than it may have.
    "iban": (
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?:\x20?[A-Z0-9]){11,31}+[a-z]?+))", "", 0.6, "iban|bank|account"
    ),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.3, "ssn|social|security|tax"),
    # Keys and tokens: hexadecimal digests of 160 or 256 bits, which count where a word beside them says so.
    "secret": (
        r"(?<![A-Za-z0-9])(?:[0-9a-f]{40}|[0-9a-f]{64})(?![A-Za-z0-9])",
        "",
        0.3,
        "token|secret|passw|pwd|credential|bearer|api|key|auth",
    ),
}
BASE = ("email", "ip", "card", "phone")
#: What a near context word adds, and the score from which a span outside ``BASE`` counts.
CONTEXT_BONUS, THRESHOLD = 0.3, 0.5
#: Code points before a match, and as many behind it, in which context words count, whatever else is found there.
CONTEXT_SPAN = 40

SPAN = "struct<start:int,order:int,end:int,kind:string,match:string,score:double>"


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Luhn's sum of the digits, every second from the right doubled, is a multiple of ten."""
    reverse = F.reverse(digits_of(match))

    def add(total: Column, place: Column) -> Column:
        digit = F.substr(reverse, place, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(reverse)), F.lit(0), add) % 10 == 0


def mod97(match: Column) -> Column:
    """The account number with its first four signs behind, letters as 10 to 35, leaves 1 when divided by 97."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def add(rest: Column, place: Column) -> Column:
        sign = F.ascii(F.substr(turned, place, F.lit(1)))
        return F.when(sign >= 65, (rest * 100 + sign - 55) % 97).otherwise((rest * 10 + sign - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _digits_between(match: Column, low: int, high: int) -> Column:
    return F.length(digits_of(match)).between(low, high)


CONFIRM: dict[str, Callable[[Column], Column]] = {
    "email": lambda match: F.lit(True),
    "ip": lambda match: match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
    "card": lambda match: _digits_between(match, 12, 19) & luhn(match),
    "phone": lambda match: _digits_between(match, 9, 15),
    "iban": mod97,
    "ssn": lambda match: ~match.rlike("^(?:000|666|9)|-00-|-0000$"),
    "secret": lambda match: match.rlike("[0-9]") & match.rlike("[a-f]"),
}


def says(context: Column, words: str) -> Column:
    return F.lower(context).rlike(rf"\b(?:{words})")


def behind(pieces: Column, matches: Column) -> Column:
    """For every match the ``CONTEXT_SPAN`` code points behind it, from the pieces and matches that follow.

    A match has two code points at least, so half as many of them reach far enough.
    """
    span = F.lit(CONTEXT_SPAN)
    ends = F.transform(
        F.arrays_zip(pieces.alias("piece"), matches.alias("match")),
        lambda x: F.concat(F.left(x["piece"], span), F.left(F.coalesce(x["match"], F.lit("")), span)),
    )
    return F.transform(
        matches, lambda _, k: F.left(F.array_join(F.slice(ends, k + 2, F.lit(CONTEXT_SPAN // 2)), ""), span)
    )


def spans_of(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind in a text, in order of place."""
    pattern, sign, prior, words = PATTERNS[kind]
    order = list(PATTERNS).index(kind)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    pairs = F.arrays_zip(
        matches.alias("match"),
        F.slice(pieces, 1, F.size(matches)).alias("piece"),
        behind(pieces, matches).alias("behind"),
    )
    none = F.array().cast(f"array<{SPAN}>")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["piece"])
        end = start + F.length(pair["match"])
        before = F.right(F.concat(state["tail"], pair["piece"]), F.lit(CONTEXT_SPAN))
        near = says(before, words) | says(pair["behind"], words)
        span = F.struct(
            start.alias("start"),
            F.lit(order).alias("order"),
            end.alias("end"),
            F.lit(kind).alias("kind"),
            pair["match"].alias("match"),
            (F.lit(prior) + F.when(near, CONTEXT_BONUS).otherwise(0.0)).alias("score"),
        )
        sure = CONFIRM[kind](pair["match"])
        if kind not in BASE:
            sure = sure & (span["score"] >= THRESHOLD)
        found = F.when(sure, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        tail = F.right(F.concat(before, pair["match"]), F.lit(CONTEXT_SPAN))
        return F.struct(end.alias("at"), tail.alias("tail"), found.alias("found"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), none.alias("found"))
    found = F.aggregate(pairs, start, step, lambda state: state["found"])
    possible = text.contains(sign) if sign else F.lit(True)
    return F.when(possible & text.rlike(pattern), found).otherwise(none)


def iban_spans(text: Column) -> Column:
    """Confirmed account numbers: from every possible start the longest end that mod-97 confirms.

    A number may be followed by capitalised words, digits or another number, so each end of a word is tried.
    """
    pattern, _, prior, words = PATTERNS["iban"]
    order = list(PATTERNS).index("iban")
    heads, rests = (F.regexp_extract_all(text, F.lit(pattern), F.lit(k)) for k in (0, 1))
    pieces = F.slice(F.split(text, pattern, -1), 1, F.size(heads))
    none = F.array().cast(f"array<{SPAN}>")

    def number(found: Column) -> Column:
        parts = F.split(found["rest"], " ", -1)
        ends = F.transform(
            F.sequence(F.size(parts), F.lit(1), F.lit(-1)),
            lambda k: F.concat(found["head"], F.array_join(F.slice(parts, F.lit(1), k), " ")),
        )

        def confirmed(match: Column) -> Column:
            signs = F.length(F.replace(match, F.lit(" "), F.lit("")))
            return F.when(signs.between(15, 34) & ~match.rlike("[a-z]$"), CONFIRM["iban"](match)).otherwise(False)

        return F.struct(found["piece"].alias("piece"), F.get(F.filter(ends, confirmed), F.lit(0)).alias("match"))

    def step(state: Column, found: Column) -> Column:
        start = state["at"] + F.length(found["piece"])
        end = start + F.length(found["match"])
        first = F.greatest(F.lit(0), start - CONTEXT_SPAN)
        before, after = F.substr(text, first + 1, start - first), F.substr(text, end + 1, F.lit(CONTEXT_SPAN))
        near = says(before, words) | says(after, words)
        span = F.struct(
            start.alias("start"),
            F.lit(order).alias("order"),
            end.alias("end"),
            F.lit("iban").alias("kind"),
            found["match"].alias("match"),
            (F.lit(prior) + F.when(near, CONTEXT_BONUS).otherwise(0.0)).alias("score"),
        )
        sure = found["match"].isNotNull() & (start >= state["end"])
        return F.struct(
            (start + 4).alias("at"),
            F.when(sure, end).otherwise(state["end"]).alias("end"),
            F.when(sure, F.concat(state["found"], F.array(span))).otherwise(state["found"]).alias("found"),
        )

    zipped = F.arrays_zip(heads.alias("head"), rests.alias("rest"), pieces.alias("piece"))
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("end"), none.alias("found"))
    found = F.aggregate(F.transform(zipped, number), start, step, lambda state: state["found"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: all confirmed spans of every whole text, by start, then by kind in the order of ``PATTERNS``.

    A span has start and end in code points (end exclusive), kind, matched text and score: the kind's prior plus a
    bonus for a context word near it, on either side. Spans of ``BASE`` always stay; others need ``THRESHOLD``. Null
    and empty texts have no spans; repeated rows and null ids are kept; other columns are not read. Spans that start
    at one place are ordered by kind; a long text is read once for each kind.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.concat(*(iban_spans(text) if kind == "iban" else spans_of(text, kind) for kind in PATTERNS))
    return id_and_text(docs).select("doc_id", F.array_sort(found).alias("spans"))


def with_digests(found: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans, all spans as ``kind:start:end``, and their number."""

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["order"] < len(BASE))
    return found.select(
        "doc_id",
        *(of_kind(kind) for kind in BASE),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )
