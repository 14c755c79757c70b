import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from edge_cases import TEXTS
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.llm.exact_dedup import SUPPORT, digest_of, drop_exact_duplicates, exact_duplicates, frequent_digests
from martloom.llm.sharding import permuted, shard


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


@pytest.mark.parametrize("seed", [1, 2])
def test_frequent_digests_are_named_in_any_row_order(spark, seed):
    copies = F.when(F.col("id") % 4 == 0, "copy").when(F.col("id") % 100 == 1, "rarer copy")
    docs = spark.range(40_000).withColumn("text", F.coalesce(copies, F.concat(F.lit("own "), "id"))).orderBy(F.rand(seed)).repartition(3)
    named = {bytes(r["digest"]) for r in frequent_digests(docs.select(digest_of("text").alias("digest")), SUPPORT).collect()}
    assert {hashlib.sha256(t).digest() for t in (b"copy", b"rarercopy")} <= named
    assert len(named) <= 1 / SUPPORT


def test_groups_and_winners(edge):
    rows = exact_duplicates(edge).collect()
    assert len(rows) == len(TEXTS)
    groups = defaultdict(list)
    for i, t in TEXTS:
        groups[hashlib.sha256(plain(t).encode()).digest()].append((-len(t or ""), i is None, i if i is not None else 0, i))
    kept = defaultdict(int)
    for r in rows:
        group = groups[bytes(r["digest"])]
        assert r["group_size"] == len(group)
        assert r["keep_id"] == min(group)[3]
        kept[bytes(r["digest"])] += r["kept"]
    assert set(kept.values()) == {1}


@pytest.mark.parametrize("support", [0.9, 0.001])
def test_the_split_changes_no_row(corpus, support):
    rows = {tuple(r) for r in exact_duplicates(corpus, support=support).drop("digest").collect()}
    assert rows == {tuple(r) for r in exact_duplicates(corpus, support=0.05).drop("digest").collect()}


def test_dropping_keeps_columns_and_one_row_a_group(edge):
    left = drop_exact_duplicates(edge)
    assert left.columns == edge.columns
    found = [(r["doc_id"], plain(r["text"])) for r in left.collect()]
    assert len(found) == len({t for _, t in found}) == len({plain(t) for _, t in TEXTS})


def test_empty_table(nothing):
    assert exact_duplicates(nothing).count() == 0
    assert drop_exact_duplicates(nothing).count() == 0
    assert shard(nothing, 8).count() == 0


@given(st.integers(1, 3000), st.integers(0, 1 << 40))
def test_permutation_is_a_bijection(total, seed):
    assert sorted(permuted(np.arange(total), total, seed).tolist()) == list(range(total))


def test_shards(edge):
    rows = shard(edge, 8).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    expected = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in TEXTS)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == expected


def test_shuffle_does_not_depend_on_partitions(corpus):
    first = {tuple(r) for r in shard(corpus, 8).collect()}
    assert first == {tuple(r) for r in shard(corpus.repartition(7), 8).collect()}
