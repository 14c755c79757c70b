"""Personal data against plain Python patterns on hand-made and random texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from martloom.llm.personal import ACCOUNT_LENGTHS, masked, personal_data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind: str, hit: str) -> bool:
    digits = [int(c) for c in hit if c.isdigit()]
    if kind == "ip":
        return all(int(part) <= 255 for part in hit.split("."))
    if kind == "card":
        doubled = [d if n % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for n, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple]:
    found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, text) if passes(kind, m[0])]
    return sorted(found)


def scanned(spark, texts: list, **options) -> list:
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return [r["spans"] for r in personal_data(df, **options).orderBy("doc_id").collect()]


TEXTS = [
    "a@b.c_x@d.e",
    "a@b.c@d.e a@b@c.d x@y",
    "\U0001f600é mail a.b@mail8.example.com. 10.0.0.255 256.1.1.1 1.2.3.4.5.6.7.8 0010.0.0.00000001",
    "4539 1488 0343 6467, 4539-1488-0343-6467 4539148803436467 12 4539148803436468",
    "+1 (743) 555-3824 +49.30.1234567- +1 2 +123456789012345678 ++49 30 123456",
    "4465758382889437 4465758382889437",
    None,
    "",
    "1" * 30_000 + " " + "a" * 50_000 + "@" + "b." * 20_000 + "c " + "1.2" * 9_000 + "+1" + " " * 9_000,
]


def test_base_spans_are_those_of_plain_patterns(spark):
    rng = random.Random(5)
    parts = ["a@b.c", "@", ".", "-", "+1", " ", "12", "555-1234", "4539148803436467", "10.0.0.1", "é", "\U0001f600", "_", "999", "x", "(", "card", "\n"]
    texts = TEXTS + ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(400)]
    for text, spans in zip(texts, scanned(spark, texts), strict=True):
        assert [tuple(s)[:4] for s in spans if s["kind_no"] < 4] == base_spans(text or ""), text


def test_many_spans_of_one_text_keep_their_places(spark):
    text = " ".join(f"word{n} u{n}@mail{n % 7}.example.com 10.0.{n % 300}.1" for n in range(2_000))
    (spans,) = scanned(spark, [text])
    assert [tuple(s)[:4] for s in spans] == base_spans(text)


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("DE89 3704 0044 0532 0130 00 and", ["iban"]),
        ("GB82WEST12345698765432", ["iban"]),
        ("DE88370400440532013000", []),
        ("XDE89370400440532013000", []),
        ("DE893704004405320130001", []),
        ("nir 1 84 12 76 451 089 46.", ["nir"]),
        ("184127645108947", []),
        ("2 84 12 2A 451 089 80", ["nir"]),
        ("dni 12345678Z", ["dni"]),
        ("12345678Z", []),
        ("dni 12345678A", []),
        ("Social security: 536-22-8145", ["ssn"]),
        ("part 536-22-8145", []),
        ("ssn 666-22-8145", []),
    ],
)
def test_further_kinds_need_their_checksum_or_words(spark, text, kinds):
    (spans,) = scanned(spark, [text])
    assert [s["kind"] for s in spans if s["kind_no"] > 3] == kinds


def test_words_nearby_move_scores(spark):
    found = scanned(spark, ["card 4539148803436467", "4539148803436467", "order 4539148803436467"])
    assert [spans[0]["score"] for spans in found] == [0.95, 0.7, 0.4]
    assert scanned(spark, ["12345678Z"], min_score=0.1)[0][0]["kind"] == "dni"


def test_account_lengths_are_those_of_known_accounts():
    lengths = {c: n for n, names in ACCOUNT_LENGTHS.items() for c in names.split()}
    assert [lengths[c] for c in ("DE", "FR", "ES", "GB", "NL", "NO", "CH")] == [22, 27, 24, 22, 18, 15, 21]


def test_edge_rows(spark, edge, nothing):
    rows = personal_data(edge).collect()
    assert len(rows) == edge.count()
    by_id = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in rows}
    assert by_id[4] == by_id[5] == by_id[6] == []
    assert by_id[13] == ["email", "card"]
    assert personal_data(nothing).count() == 0


def test_masking(spark):
    df = spark.createDataFrame([(1, "to a@b.c, +1 743 555 3824 or 4539148803436467!")], "doc_id long, text string")
    joined = personal_data(df).join(df, "doc_id")
    assert joined.select(masked(F.col("text"), F.col("spans"))).head()[0] == "to [email], [phone] or [card]!"
