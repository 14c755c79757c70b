import hashlib
import itertools
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash
from edge_cases import TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import simhash, substrings
from martloom.llm.bits import near, planes, spanning_links
from martloom.llm.graph import components
from martloom.llm.simhash import drop_near_duplicates, exact_scheme, near_duplicates, similarity_scheme
from martloom.llm.substrings import remove_repeats
from martloom.llm.suffixes import SPAN, Suffixes, equal_classes, window_runs


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, radius):
    parent = list(range(len(ids)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(ids)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            parent[top(a)] = top(b)
    least = {}
    for n, i in enumerate(ids):
        if i is not None:
            least[top(n)] = min(i, least.get(top(n), i))
    return [least.get(top(n)) for n in range(len(ids))]


def check_near(df, rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    expected = plain_components([i for i, _ in rows], prints, 3)
    found = near_duplicates(df, exact_scheme()).collect()
    key = lambda i, f, c: (str(i), f, str(c))
    assert sorted(key(r["doc_id"], r["f0"] % (1 << 64), r["component_id"]) for r in found) == sorted(
        key(i, f, c) for (i, _), f, c in zip(rows, prints, expected, strict=True)
    )


def test_near_duplicates_on_edge_cases(edge):
    check_near(edge, TEXTS)


@pytest.mark.parametrize("group", [4096, 4])
def test_near_duplicates_of_a_corpus(corpus, texts, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", group)
    check_near(corpus, list(texts.items()))


def test_long_texts_are_read_in_blocks(monkeypatch):
    text = " ".join(f"w{i * i % 1009}" for i in range(3000))
    monkeypatch.setattr(simhash, "BLOCK", 100)
    assert int(simhash.fingerprint(text, 3, 1)[0]) == plain_fingerprint(text)


@settings(deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), min_size=1, max_size=90), st.integers(0, 1 << 32), st.integers(1, 40))
def test_bit_slices_give_the_distances(values, flips, radius):
    values = values + [v ^ flips for v in values[:20]]
    prints = np.array(values, np.uint64).reshape(-1, 1)
    lanes = np.unpackbits(near(prints, planes(prints), radius).view(np.uint8), axis=1, bitorder="little")[:, : len(values)]
    assert lanes.tolist() == [[int((a ^ b).bit_count() <= radius) for b in values] for a in values]
    top = list(range(len(values)))
    for a, b in spanning_links(prints, radius):
        top = [top[a] if t == top[b] else t for t in top]
    expected = plain_components(list(range(len(values))), values, radius)
    assert len(set(top)) == len(set(expected))


def test_similar_documents_share_a_component(corpus, texts):
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(corpus, similarity_scheme()).collect()}
    shingles = {}
    for i, t in texts.items():
        words = t.encode().lower().split()
        shingles[i] = {b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    pairs = [
        found[a] == found[b]
        for a, b in itertools.combinations(texts, 2)
        if len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])
    ]
    far = [
        found[a] == found[b]
        for a, b in itertools.combinations(texts, 2)
        if len(shingles[a] & shingles[b]) < 0.5 * len(shingles[a] | shingles[b])
    ]
    assert sum(pairs) >= 0.9 * len(pairs) > 0
    assert not any(far)


def pairs_at(similarity, n_pairs, seed, n=400):
    """Texts 2k and 2k + 1 with ``n`` five-word shingles each and the least Jaccard similarity from ``similarity`` on."""
    draw = np.random.default_rng(seed)
    shared = next(c for c in range(n + 1) if c >= similarity * (2 * n - c))
    word = lambda size: [f"w{x}" for x in draw.integers(0, 1 << 40, size)]
    texts = []
    for _ in range(n_pairs):
        base = word(shared + 4)
        texts += [" ".join(base + word(n - shared)) for _ in range(2)]
    return texts


@pytest.mark.parametrize("group", [4096, 4])
def test_pairs_at_the_limit_are_found_and_those_below_are_not(spark, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", group)
    at, above, below = pairs_at(0.8, 150, 1), pairs_at(0.83, 150, 2), pairs_at(0.78, 60, 3) + pairs_at(0.795, 60, 4)
    texts = at + above + below
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, similarity_scheme()).collect()}
    linked = [found[2 * k] == found[2 * k + 1] for k in range(len(texts) // 2)]
    assert sum(linked[:150]) >= 0.9 * 150
    assert sum(linked[150:300]) >= 0.95 * 150
    assert not any(linked[300:])
    assert all(found[i] // 2 == i // 2 for i in found)


@pytest.mark.parametrize("n", [5, 10, 20, 50, 400])
def test_pairs_of_any_length_are_found(spark, n):
    texts = pairs_at(0.8, 100, n, n)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, similarity_scheme()).collect()}
    linked = [found[2 * k] == found[2 * k + 1] for k in range(100)]
    assert sum(linked) >= (100 if n <= simhash.SHORT else 90)
    assert all(found[i] // 2 == i // 2 for i in found)


@pytest.mark.parametrize("small", [4, 13, 56])
def test_fingerprints_alone_name_the_candidates_of_short_sets(spark, small):
    """A set and the same with as many more shingles as 0.8 allows, which have the most uneven fingerprints."""
    scheme, texts = similarity_scheme(), []
    for k in range(300):
        whole = [f"w{k}x{n}" for n in range(int(small / 0.8) + 4)]
        texts += [" ".join(whole[: small + 4]), " ".join(whole)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    nodes = simhash.stored(simhash.fingerprints(docs, scheme).withColumn("node", F.col("doc_id")), "test-nodes")
    found = {r["node"]: r["component"] for r in simhash.candidate_groups(nodes, scheme).collect()}
    assert sum(found.get(2 * k, -1) == found.get(2 * k + 1, -2) for k in range(300)) >= 297
    left = sorted(r["doc_id"] for r in drop_near_duplicates(docs).collect())
    assert len(left) <= 303 and set(range(0, 600, 2)) <= set(left)
    assert not hasattr(simhash, "short_links")


def near_copies(count, words):
    draw = np.random.default_rng(count)
    base = [f"w{x}" for x in range(words)]
    texts = []
    for k in range(count):
        own = list(base)
        own[int(draw.integers(words))] = f"new{k}"
        texts.append(" ".join(own))
    return texts


def test_large_groups_of_near_copies_leave_few_links_a_node(spark, monkeypatch):
    """What the first bands have joined is not linked again, so links grow with the group and not with bands times group."""
    counted, whole = [], simhash.components
    monkeypatch.setattr(simhash, "components", lambda links: counted.append((kept := simhash.stored(links, "test-links")).count()) or whole(kept))
    scheme, share = similarity_scheme(), []
    for count in (600, 6000):
        docs = spark.createDataFrame(list(enumerate(near_copies(count, 60))), "doc_id long, text string").repartition(8)
        prints = simhash.stored(simhash.fingerprints(docs, scheme), "test-prints")
        counted.clear()
        groups = simhash.candidate_groups(prints.select(F.col("doc_id").alias("node"), *simhash._parts(scheme)), scheme)
        assert groups.count() == count and groups.select("component").distinct().count() == 1
        share.append(sum(counted) / count)
    assert max(share) <= 12 and share[1] <= 1.5 * share[0], share


@pytest.mark.parametrize("group", [4096, 16])
def test_short_near_copies_are_one_group(spark, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", group)
    texts = near_copies(200, 60) + ["another text of six words altogether"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, similarity_scheme()).collect()}
    assert found == {**dict.fromkeys(range(200), 0), 200: 200}


def test_rows_are_dropped_by_their_text_where_ids_repeat(spark):
    a = near_copies(1, 60)[0]
    b, other = a + " tail", " ".join(f"o{n}" for n in range(30))
    rows = [(0, a), (1, b), (1, other), (2, a), (2, a), (3, None), (3, ""), (None, a), (5, other + " x")]
    left = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(str((i, t or "")) for i, t in left.collect()) == sorted(map(str, [(0, a), (1, other), (3, ""), (None, a)]))
    twice = drop_near_duplicates(spark.createDataFrame([(0, a), (0, b), (4, other), (4, other)], "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in twice.collect()) == [0, 4]


def test_a_repeated_line_makes_no_near_duplicates(spark):
    line = "= = = = = " * 400
    docs = [(k, line + " ".join(f"w{k}x{n}" for n in range(60))) for k in range(4)]
    found = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), similarity_scheme()).collect()
    assert all(r["doc_id"] == r["component_id"] for r in found)


@pytest.mark.parametrize("group", [4096, 8])
def test_similarities_decide_within_a_component(spark, monkeypatch, group):
    """Copies of one text, each with its own changes: only chains of pairs at 0.8 or more stay together."""
    monkeypatch.setattr(simhash, "GROUP", group)
    draw = np.random.default_rng(5)
    base = [f"w{x}" for x in range(160)]
    texts = []
    for k in range(60):
        words = list(base)
        for n in draw.choice(len(words), int(draw.integers(1, 8)), replace=False):
            words[n] = f"new{k}x{n}"
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(156)} for t in texts]
    joined = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            joined = [joined[a] if j == joined[b] else j for j in joined]
    expected = [min(i for i, j in enumerate(joined) if j == own) for own in joined]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, similarity_scheme()).collect()}
    assert 1 < len(set(expected)) < len(texts)
    assert [found[i] for i in range(len(texts))] == expected


def test_dropping_near_duplicates(edge, nothing):
    left = drop_near_duplicates(edge)
    assert left.columns == edge.columns
    ids = sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None)
    assert 0 in ids and 1 not in ids and 2 not in ids and 11 not in ids and 9 in ids and 10 in ids
    assert drop_near_duplicates(nothing).count() == 0
    assert near_duplicates(nothing, exact_scheme()).count() == 0


def test_components(spark):
    links = [(1, 2), (2, 3), (7, 7), (9, 8), (8, 10), (3, 1)] + [(100, n) for n in range(101, 160)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    expected = {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 10: 8} | {n: 100 for n in range(100, 160)}
    assert {r["node"]: r["component"] for r in found.collect()} == expected


def plain_repeats(rows):
    last = 1 << 62
    texts = [(last if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in sorted(texts):
        for p in range(len(b) - 49):
            first.setdefault(b[p : p + 50], i)
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        out.append((None if i == last else i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_repeats_on_edge_cases(edge, nothing):
    assert sorted((tuple(r) for r in remove_repeats(edge).collect()), key=str) == plain_repeats(TEXTS)
    assert remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("hot", [50_000, 1])
def test_repeats_of_a_corpus(corpus, texts, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT_RUNS", hot)
    rows = remove_repeats(corpus, keep_text=True).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == plain_repeats(texts.items())
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in rows)


def test_windows_that_are_equal_share_a_key(monkeypatch):
    from martloom.llm import suffixes

    monkeypatch.setattr(suffixes, "CHUNK", 64)
    text = (b"abcabcabc" * 20 + b"the quick brown fox jumps over the lazy dog again and again " * 3) * 2
    key = {}
    for start, end, value in zip(*window_runs(text), strict=True):
        for p in range(start, end):
            assert key.setdefault(text[p : p + SPAN], value) == value
    assert len(key) == len({text[p : p + SPAN] for p in range(len(text) - SPAN + 1)})


@settings(deadline=None, max_examples=40)
@given(st.text("ab", min_size=SPAN, max_size=200), st.booleans())
def test_suffix_sort_and_collisions(text, broken):
    buffer = text.encode()
    places = np.arange(len(buffer) - SPAN + 1)
    groups = places // 40
    order, classes = _classes(buffer, places, groups, broken)
    windows = [(int(groups[s]), buffer[places[s] : places[s] + SPAN]) for s in order]
    assert windows == sorted(windows)
    assert classes.tolist() == [len(set(windows[: k + 1])) - 1 for k in range(len(windows))]


def _classes(buffer, places, groups, broken):
    """With ``broken``, every hash is the same, so that only the check by bytes can be right."""
    usual = Suffixes.common
    if broken:
        Suffixes.common = lambda self, x, y: np.full(len(x), SPAN)
    try:
        return equal_classes(buffer, places, groups)
    finally:
        Suffixes.common = usual
