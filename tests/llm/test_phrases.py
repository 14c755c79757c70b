"""Collocations against a plain Python version."""

import random
import re
from collections import Counter

import pytest

from martloom.llm import phrases
from martloom.llm.phrases import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_count, max_words, top, share=100):
    by_lang = {}
    for text, lang in rows:
        by_lang.setdefault("und" if lang is None else lang, []).append((text or "").translate(LOWER))
    result = []
    for lang, texts in by_lang.items():
        f = Counter()
        for text in texts:
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
                words = re.findall(r"[^\x20\x09]+", piece)
                f.update(tuple(words[i : i + k]) for k in range(1, max_words + 1) for i in range(len(words) - k + 1))
        n = sum(c for g, c in f.items() if len(g) == 1)
        found = []
        for gram, a in f.items():
            if len(gram) < 2 or a < min_count:
                continue
            inside = any(
                len(o) > len(gram) and c >= min_count and 100 * c >= share * a and any(o[i : i + len(gram)] == gram for i in range(len(o) - len(gram) + 1)) for o, c in f.items()
            )
            if not inside:
                score, cut = min((1000 * a * n // (f[gram[:k]] * f[gram[k:]]), k) for k in range(1, len(gram)))
                found.append((-score, -a, " ".join(gram).encode(), f[gram[:cut]], f[gram[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(result)


def table(spark, rows):
    named = [(i, t, g, "x", 1) for i, (t, g) in enumerate(rows)]
    return spark.createDataFrame(named, "doc_id long, text string, lang string, phrase string, n int").repartition(3)


def random_rows(seed, documents, names):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(names)] + ["É", "of", "The", "x/y"]
    fixed = [[rng.choice(words) for _ in range(rng.randrange(2, 7))] for _ in range(6)]
    rows = []
    for _ in range(documents):
        parts = []
        for _ in range(rng.randrange(1, 30)):
            parts += rng.choice(fixed) if rng.random() < 0.3 else [rng.choice(words)]
            parts.append(rng.choice(["", "", "", "", ".", " , ", "\n", "\t"]))
        rows.append((" ".join(parts), rng.choice(["en", "en", "de", None])))
    return [*rows, (None, "en"), ("", "fr"), (" \t. ", None), ("a a a a a", "one"), ("a a a a a", "one")]


@pytest.mark.parametrize("rounds", [(1.0,), (0.2, 0.6, 1.0)])
@pytest.mark.parametrize(("top", "share"), [(4, 100), (1000, 60)])
def test_equal_to_a_plain_version(spark, rounds, top, share):
    rows = random_rows(7, 60, 25)
    got = collocations(table(spark, rows), min_count=3, max_words=4, top=top, share=share, rounds=rounds)
    assert sorted(map(tuple, got.collect())) == plain(rows, 3, 4, top, share)


def test_a_language_is_settled_before_all_words_are_open(spark, monkeypatch):
    rows = [(" ".join(["the"] * 40 + ["rare", f"pair{i % 3}", f"end{i % 3}"]), "en") for i in range(60)]
    opened, plain_limits = [], phrases._limits
    monkeypatch.setattr(phrases, "_limits", lambda words, share: opened.append(share) or plain_limits(words, share))
    got = collocations(table(spark, rows), min_count=3, max_words=3, top=3, rounds=(0.3, 1.0))
    assert sorted(map(tuple, got.collect())) == plain(rows, 3, 3, 3)
    assert opened == [0.3]


def test_small_chunks_and_full_filters_change_nothing(spark, monkeypatch):
    rows = random_rows(8, 30, 12)
    monkeypatch.setattr(phrases, "CHUNK", 40)
    monkeypatch.setattr(phrases, "FILTER_BITS", 7)
    got = collocations(table(spark, rows), min_count=2, max_words=3, top=50)
    assert sorted(map(tuple, got.collect())) == plain(rows, 2, 3, 50)


def test_products_beyond_64_bits(spark):
    rows = [("lang", "q r", 2 * 10**15, 3 * 10**15, 10**15, 10**16)]
    counts = spark.createDataFrame([("l", "q r", 10**15), ("l", "q", 2 * 10**15), ("l", "r", 3 * 10**15)], "lang string, phrase string, f long")
    languages = spark.createDataFrame([("l", 10**16, 10**16)], "lang string, n long, largest long")
    assert phrases.scored(counts, languages).head()["score"] == 1000 * 10**15 * 10**16 // (rows[0][2] * rows[0][3])


def test_nothing_to_find(spark, edge, nothing):
    assert collocations(nothing.selectExpr("*", "text as lang")).count() == 0
    assert collocations(edge.selectExpr("*", "doc_id as lang"), min_count=50_000).count() == 0
    found = collocations(edge.selectExpr("*", "cast(null as string) as lang"), min_count=5, top=10)
    assert {r["lang"] for r in found.collect()} == {"und"}
