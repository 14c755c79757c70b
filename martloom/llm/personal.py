"""Personal data in texts: patterns propose spans, checksums confirm them, neighbouring words adjust their scores."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import text_or_empty

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters before and after a span in which context words count, as far as the neighbouring proposals of its kind.
BEFORE, AFTER = 40, 20
BONUS, MALUS = 0.25, 0.3
MIN_SCORE = 0.5
#: Proposals whose lengths are summed together when positions are computed.
BLOCK = 64

# Lengths of international account numbers by country.
ACCOUNT_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH DE GB GE IE ME RS VA",
    23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT ST", 26: "IS TR", 27: "FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC",
}
# Fixed value: check letters of the Spanish identity number, by remainder.
DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"

ACCOUNT = "|".join(f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, names in ACCOUNT_LENGTHS.items())
_LOCAL = "A-Za-z0-9._%+-"
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, n: total + n)


def _characters(value: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.substr(value, i, F.lit(1)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether digits end in the right check digit."""

    def counted(i: Column) -> Column:
        digit = F.substr(digits, i, F.lit(1)).try_cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return F.when((F.length(digits) - i) % 2 == 1, doubled).otherwise(digit)

    return _total(F.transform(F.sequence(F.lit(1), F.length(digits)), counted)) % 10 == 0


def mod_97(account: Column) -> Column:
    """Whether letters (10 to 35) and digits, the first four moved to the end, leave 1 when divided by 97."""

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    moved = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))
    return F.aggregate(_characters(moved), F.lit(0), step) == 1


def _is_card(hit: Column) -> Column:
    return let(_digits(hit), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))


def _is_insured(hit: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(hit, " ", ""), "2A", "19"), "2B", "18")
    return let(plain, lambda n: 97 - F.substr(n, F.lit(1), F.lit(13)).try_cast("bigint") % 97 == F.substr(n, F.lit(14), F.lit(2)).try_cast("bigint"))


def _is_identity(hit: Column) -> Column:
    rest = F.substr(hit, F.lit(1), F.lit(8)).try_cast("int") % 23
    return F.right(hit, F.lit(1)) == F.substr(F.lit(DNI_LETTERS), rest + 1, F.lit(1))


@dataclass(frozen=True)
class Kind:
    """What proposes a kind of span and confirms it, its score and the words nearby that raise or lower it.

    ``alone``: no letter or digit may touch the span. A ``base`` span stays whatever its score.
    """

    name: str
    pattern: str
    confirmed: Callable[[Column], Column]
    score: float
    raised_by: str
    lowered_by: str = ""
    base: bool = False
    alone: bool = False


def _any(hit: Column) -> Column:
    return F.lit(True)


# Quantifiers are possessive wherever no match depends on giving back, so that neither time nor depth grows with a run's square.
KINDS = (
    Kind(
        "email", f"(?:(?<![{_LOCAL}])|\\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++", _any, 0.9,
        "mail|email|contact|write|courriel|correo|schreiben", "example|noreply", base=True,
    ),
    Kind(
        "ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda hit: F.rlike(hit, F.lit(f"^{_PART}(?:\\.{_PART}){{3}}$")), 0.6,
        "ip|address|host|server|login|adresse|direccion", "version|release|section|kapitel|chapitre", base=True,
    ),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){11,}+", _is_card, 0.7, "card|credit|visa|mastercard|payment|karte|carte|tarjeta", "order|invoice|isbn|tracking", base=True),
    Kind(
        "phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda hit: F.length(_digits(hit)).between(9, 15), 0.6,
        "phone|tel|call|mobile|fax|telefon|appel|llame", "", base=True,
    ),
    Kind("iban", ACCOUNT, lambda hit: mod_97(F.regexp_replace(hit, " ", "")), 0.9, "iban|account|bank|konto|compte|cuenta", alone=True),
    Kind(
        "nir", r"[12] ?[0-9]{2} ?[0-9]{2} ?(?:[0-9]{2}|2[AB]) ?[0-9]{3} ?[0-9]{3} ?[0-9]{2}", _is_insured, 0.6,
        "nir|insee|secu|securite|social|assure", "order|invoice|isbn|tracking", alone=True,
    ),
    Kind("dni", r"[0-9]{8}-?[A-Z]", _is_identity, 0.4, "dni|nif|documento|identidad", alone=True),
    Kind(
        "ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        lambda hit: ~F.rlike(hit, F.lit("^(?:000|666|9)|-00-|0000$")), 0.3, "ssn|social|security", "order|invoice|part", alone=True,
    ),
)
SPAN = "struct<start:int,kind_no:int,end:int,kind:string,score:double>"
TOUCHES = r"[A-Za-z0-9]"


def _near(words: str, before: Column, after: Column) -> Column:
    found = F.lit(f"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)")
    return F.rlike(F.translate(before, UPPER, LOWER), found) | F.rlike(F.translate(after, UPPER, LOWER), found)


def _offsets(lengths: Column) -> Column:
    """Sums of all lengths before each block of ``BLOCK``."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int"))
    first = F.array(F.lit(0))
    return F.aggregate(blocks, first, lambda sums, b: F.concat(sums, F.array(F.element_at(sums, -1) + _total(F.slice(lengths, b * BLOCK + 1, BLOCK)))))


def _spans(text: Column, number: int, kind: Kind) -> Column:
    """Confirmed spans of one kind, in order of start; positions are code points."""

    def of(hits: Column) -> Column:
        gaps = F.split(text, kind.pattern, -1)
        lengths = F.zip_with(F.transform(hits, F.length), F.slice(F.transform(gaps, F.length), 1, F.size(hits)), lambda a, b: a + b)
        read = F.struct(hits.alias("hits"), gaps.alias("gaps"), lengths.alias("lengths"))
        return let(read, lambda r: let(_offsets(r["lengths"]), lambda sums: spans(r["hits"], r["gaps"], r["lengths"], sums)))

    def spans(hits: Column, gaps: Column, lengths: Column, sums: Column) -> Column:
        def is_right(i: Column) -> Column:
            hit, before, after = F.get(hits, i), F.get(gaps, i), F.get(gaps, i + 1)
            right = kind.confirmed(hit)
            if kind.alone:
                right = right & ~F.rlike(F.right(before, F.lit(1)), F.lit(TOUCHES)) & ~F.rlike(F.left(after, F.lit(1)), F.lit(TOUCHES))
            return right

        def span(i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            end = F.get(sums, block) + _total(F.slice(lengths, block * BLOCK + 1, i % BLOCK + 1))
            before, after = F.right(F.get(gaps, i), F.lit(BEFORE)), F.left(F.get(gaps, i + 1), F.lit(AFTER))
            score = F.lit(kind.score) + F.when(_near(kind.raised_by, before, after), BONUS).otherwise(0.0)
            if kind.lowered_by:
                score = score - F.when(_near(kind.lowered_by, before, after), MALUS).otherwise(0.0)
            return F.struct(
                (end - F.length(F.get(hits, i))).alias("start"),
                F.lit(number).alias("kind_no"),
                end.alias("end"),
                F.lit(kind.name).alias("kind"),
                F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 2).alias("score"),
            )

        return F.transform(F.filter(F.sequence(F.lit(0), F.size(hits) - 1), is_right), span)

    none = F.array().cast(f"array<{SPAN}>")
    return let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), lambda hits: F.when(F.size(hits) > 0, of(hits)).otherwise(none))


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array of ``start, kind_no, end, kind, score`` by start, then kind.

    Every kind proposes its leftmost non-overlapping matches; a proposal that its checksum or rule does not confirm is
    dropped, without another try inside of it. Words before and after a span raise or lower its score. Base kinds
    (email, ip, card, phone) stay whatever their score; further kinds (iban by mod 97, nir by its mod-97 key, dni by its
    letter, ssn by its ranges) need ``min_score``, which dni and ssn reach by context words only.

    A plain projection: no shuffle, no Python. Null texts count as empty and have no spans. Repeated rows give repeated
    results; extra columns are ignored; an empty table gives no rows.
    """
    whole = text_or_empty(text)
    some = F.rlike(whole, F.lit("[0-9@]"))
    none = F.array().cast(f"array<{SPAN}>")
    kinds = []
    for number, kind in enumerate(KINDS):
        spans = _spans(whole, number, kind)
        kinds.append(spans if kind.base else F.filter(spans, lambda s: s["score"] >= min_score))
    return docs.select(F.col(doc_id).alias("doc_id"), F.when(some, F.sort_array(F.concat(*kinds))).otherwise(none).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; a span that begins inside an earlier one goes with it."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substr(text, state["at"] + 1, s["start"] - state["at"])
        taken = F.struct(F.concat(state["out"], gap, F.lit("["), s["kind"], F.lit("]")).alias("out"), s["end"].alias("at"))
        return F.when(s["start"] >= state["at"], taken).otherwise(F.struct(state["out"].alias("out"), F.greatest(state["at"], s["end"]).alias("at")))

    return F.aggregate(spans, start, step, lambda state: F.concat(state["out"], F.substr(text, state["at"] + 1)))
