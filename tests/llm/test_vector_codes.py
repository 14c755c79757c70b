"""Vector codes against a plain Python version."""

import hashlib
import math
import random

import numpy as np
import pytest

from martloom.llm.gnat import build, nearest
from martloom.llm.vector_codes import compress


def plain(rows, parts, entries, rounds):
    """Rows of (vec_id, vector, label), one after the other, with Python integers."""
    whole = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    width = len(whole[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in whole[:entries]] for p in range(parts)]

    def codes():
        return [[min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)), k) for k, e in enumerate(books[p])) for p in range(parts)] for _, v, _ in whole]

    for _ in range(rounds):
        found = codes()
        for p in range(parts):
            for k in range(len(books[p])):
                members = [cut(v, p) for (_, v, _), f in zip(whole, found, strict=True) if f[p][1] == k]
                if members:
                    books[p][k] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in codes()]
    sums = {}
    for (_, _, label), error in zip(whole, errors, strict=True):
        sums[label] = sums.get(label, 0) + error
    return sorted(
        (str(i), "".join(f"{k:02x}" for _, k in f), error, sums[label], digest)
        for (i, _, label), f, error in zip(whole, codes(), errors, strict=True)
    )


def table(spark, rows):
    df = spark.createDataFrame([(i, v, l, "x", 1.5) for i, v, l in rows], "vec_id long, embedding array<float>, label int, code string, error double")
    return df.repartition(4)


def got(df):
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect())


@pytest.mark.parametrize("case", ["spread", "ties", "few"])
def test_equal_to_a_plain_version(spark, case):
    rng = random.Random(3)
    n = 5 if case == "few" else 160
    draw = (lambda: float(rng.randrange(-2, 3)) / 256) if case == "ties" else (lambda: float(np.float32(rng.gauss(0, 1))))
    rows = [(i, [draw() for _ in range(8)], rng.choice([None, 1, 2])) for i in range(n)]
    rows += [rows[3], (3, [draw() for _ in range(8)], 2), (None, [draw() for _ in range(8)], None)]
    rows += [(1000, None, 1), (-1, [1.0] * 7 + [None], 1), (-2, [1.0] * 7 + [float("nan")], None), (-3, [float("inf")] + [0.0] * 7, 1)]
    assert got(compress(table(spark, rows), parts=2, entries=40, rounds=2)) == plain(rows, 2, 40, 2)


def test_other_lengths_go_and_empty_tables_have_no_rows(spark):
    rows = [(1, [0.5, 0.25], 1), (2, [0.5, 0.25, 0.75], 1), (3, [], 1), (0, [0.0, 1.0, 2.0], 2), (4, [0.0, 1.0, 2.0, 3.0], 2)]
    assert [r[0] for r in got(compress(table(spark, rows), parts=2))] == ["1"]
    assert compress(table(spark, []), parts=2).count() == 0
    assert compress(table(spark, [(1, None, 1)]), parts=2).count() == 0


def test_components_too_large_are_told(spark):
    with pytest.raises(ValueError, match="exact 64-bit"):
        compress(table(spark, [(1, [1e30, 0.0], 1)]), parts=2)


@pytest.mark.parametrize("spread", [1, 3, 1000, 1 << 27])
def test_the_tree_finds_what_a_full_search_finds(spread):
    draw = np.random.default_rng(spread)
    points, queries = draw.integers(-spread, spread + 1, (200, 4)), draw.integers(-2 * spread, 2 * spread + 1, (500, 4))
    queries[:200] = points
    distances = ((queries[:, None] - points[None]) ** 2).sum(axis=2)
    entries, best = nearest(build(points), points, queries)
    assert (entries == distances.argmin(axis=1)).all()
    assert (best == distances.min(axis=1)).all()


def test_the_tree_leaves_out_children(monkeypatch):
    from martloom.llm import gnat

    draw = np.random.default_rng(1)
    centres = draw.integers(-100_000, 100_000, (8, 4))
    points = (centres[:, None] + draw.integers(-50, 50, (8, 8, 4))).reshape(-1, 4)
    compared, plain_squared = [], gnat.squared
    tree = build(points)
    monkeypatch.setattr(gnat, "squared", lambda a, b: compared.append(len(a) * len(b)) or plain_squared(a, b))
    nearest(tree, points, points + 1)
    assert sum(compared) < 0.4 * len(points) ** 2
