"""SimHash near-duplicates: fingerprints of word shingles, compared bit-sliced within buckets, joined to components.

Where a similarity is asked for, the fingerprints only name candidates; the shingle sets decide about their links.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.bits import near, planes, spanning_links
from martloom.llm.common import packed, stored, text_or_empty
from martloom.llm.graph import components

SEED = 42
#: Keeps products such as 0.8 * 35 from being rounded past a whole number.
EPSILON = 1e-9
#: Bytes of a text that are split into words at a time.
BLOCK = 1 << 20
_WHITE = re.compile(rb"[\x20\x09-\x0D]")
#: Fingerprints that one task compares with one another at a time; larger buckets are split into pairs of chunks.
GROUP = 4096
#: Rows of small groups that are compared in one go.
TILE = 256
#: Bands after which what they have joined is told to the next ones.
BAND_GROUPS = (4, 16)
#: Standard deviations of the distance at the limit by which the radius of candidates is above its mean.
MARGIN = 4
#: Sets of at most so many shingles get buckets of their own, as few shingles make uneven fingerprints.
SHORT = 100
#: Bits on which such a bucket agrees, and the recall that the most uneven pair of them must have.
SHORT_BAND_BITS, SHORT_RECALL = 10, 0.999
#: Bytes of shingle sets that a task verifies against one another at a time, beside at most ``GROUP`` sets.
SET_BYTES = 64 << 20


@dataclass(frozen=True)
class Scheme:
    """Shingle length, 64-bit words in a fingerprint, radius in bits, and the bits on which a bucket agrees, one mask each.

    With a ``similarity`` fingerprints are taken over distinct shingles, and a link needs that Jaccard similarity of the sets.
    Nodes whose sets have ``sizes`` shingles, from and to, go to the buckets of ``short`` too.
    """

    shingle_words: int
    words: int
    radius: int
    masks: tuple[tuple[int, ...], ...]
    similarity: float | None = None
    short: Scheme | None = None
    sizes: tuple[int, int] = (0, 0)


def exact_scheme(shingle_words: int = 3, radius: int = 3) -> Scheme:
    """64 bits in ``radius + 2`` blocks: near fingerprints agree on two of them at least, so no pair is missed."""
    edges = [round(64 * k / (radius + 2)) for k in range(radius + 3)]
    blocks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in itertools.pairwise(edges)]
    return Scheme(shingle_words, 1, radius, tuple((a | b,) for a, b in itertools.combinations(blocks, 2)))


def similarity_scheme(similarity: float = 0.8, shingle_words: int = 5, words: int = 4, band_bits: int = 16, recall: float = 0.95) -> Scheme:
    """Links between shingle sets of a Jaccard similarity of at least ``similarity``, found by 64 * ``words`` bits.

    The bits of two sets of one size at the limit differ independently with one probability. The radius is ``MARGIN``
    standard deviations above the mean distance, and the buckets, which agree on ``band_bits`` bits drawn anew for each,
    are as many as find such a pair with the wanted probability over all its distances. Pairs above the limit are found
    more surely; pairs below it are candidates at most.
    """
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    radius, masks = _banded(share, words, band_bits, recall)
    if not 0 < similarity < 1:
        return Scheme(shingle_words, words, radius, masks, similarity)
    short = Scheme(shingle_words, words, *_banded(max(share, uneven_share(similarity)), words, SHORT_BAND_BITS, SHORT_RECALL), similarity)
    # Smaller sets are of the similarity only if they are equal, which is one node; larger ones are not with a set of ``SHORT``.
    sizes = (math.ceil(similarity / (1 - similarity) - EPSILON), int(SHORT / (similarity - EPSILON)))
    return Scheme(shingle_words, words, radius, masks, similarity, short, sizes)


def _banded(share: float, words: int, band_bits: int, recall: float) -> tuple[int, tuple[tuple[int, ...], ...]]:
    """Radius, and as many masks as find pairs whose bits differ with probability ``share`` with the wanted probability."""
    bits = 64 * words
    radius = round(share * bits + MARGIN * math.sqrt(bits * share * (1 - share)))
    chances = [math.comb(bits, d) * share**d * (1 - share) ** (bits - d) for d in range(radius + 1)]
    agree = [math.comb(bits - d, band_bits) / math.comb(bits, band_bits) for d in range(radius + 1)]
    bands = 1
    while sum(c * (1 - (1 - a) ** bands) for c, a in zip(chances, agree, strict=True)) < min(recall, 0.999 * sum(chances)):
        bands += 1
    draw = np.random.default_rng(SEED)
    masks = []
    for _ in range(bands):
        chosen = draw.choice(bits, band_bits, replace=False)
        masks.append(tuple(sum(1 << int(b % 64) for b in chosen if b // 64 == w) for w in range(words)))
    return radius, tuple(masks)


def uneven_share(similarity: float) -> float:
    """The largest probability with which a bit differs between two sets of the similarity, one of at most ``SHORT`` shingles.

    A bit is set in over half of the hashes, so an even number of them sets fewer bits than an odd one; four shingles and the
    same four with a fifth differ in more bits than long sets do.
    """

    def over_half(own: int, shared: int) -> np.ndarray:
        """By how many shared hashes have the bit, whether the whole set has it."""
        tails = np.cumsum([math.comb(own, k) / 2**own for k in range(own, -1, -1)])[::-1]
        needed = (own + shared) // 2 + 1 - np.arange(shared + 1)
        return np.where(needed > own, 0.0, tails[np.clip(needed, 0, own)])

    worst = 0.0
    for a in range(1, SHORT + 1):
        for b in range(a, int(a / (similarity - EPSILON)) + 1):
            shared = math.ceil(similarity * (a + b) / (1 + similarity) - EPSILON)
            if shared <= a < max(b, shared + 1):
                having = np.array([math.comb(shared, k) / 2**shared for k in range(shared + 1)])
                one, other = over_half(a - shared, shared), over_half(b - shared, shared)
                worst = max(worst, float((having * (one * (1 - other) + other * (1 - one))).sum()))
    return worst


def _shingle_hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, repeats included, block by block."""
    data, at, held, whole = text.lower(), 0, [], 0
    while at < len(data):
        end = _WHITE.search(data, min(at + BLOCK, len(data)))
        end = end.start() if end else len(data)
        words = held + data[at:end].split()
        whole += len(words) - len(held)
        at, held = end + 1, words[-(size - 1) :] if size > 1 else []
        if len(words) >= size:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = (ends - [len(w) + 1 for w in words])[: len(words) - size + 1].tolist()
            digest = xxhash.xxh64_intdigest
            yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)], np.uint64)
    if 0 < whole < size:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def _more_words(hashes: np.ndarray, words: int) -> np.ndarray:
    """The hash and further words mixed from it, one column each."""
    columns = [hashes]
    for k in range(1, words):
        value = hashes + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))
        value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        columns.append(value ^ (value >> np.uint64(31)))
    return np.stack(columns, axis=1)


def shingle_set(text: str, shingle_words: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *_shingle_hashes(text.encode(), shingle_words)]))


def _majority(blocks: Iterable[np.ndarray], words: int) -> np.ndarray:
    total, counts = 0, np.zeros(64 * words, np.int64)
    for hashes in blocks:
        for at in range(0, len(hashes), 1 << 14):
            wide = np.ascontiguousarray(_more_words(hashes[at : at + (1 << 14)], words))
            counts += np.unpackbits(wide.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
        total += len(hashes)
    return np.packbits(2 * counts > total, bitorder="little").view(np.uint64)


def fingerprint(text: str, shingle_words: int, words: int) -> np.ndarray:
    """Bits set in over half of the shingle hashes, as unsigned 64-bit words; zero without a word."""
    return _majority(_shingle_hashes(text.encode(), shingle_words), words)


def _set_mark(hashes: np.ndarray) -> int:
    """A signed hash of a shingle set."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).astype(np.int64))


def _parts(scheme: Scheme) -> list[str]:
    return [f"f{w}" for w in range(scheme.words)]


def _keys(scheme: Scheme) -> list[str]:
    """Columns on which the rows of a node agree."""
    return _parts(scheme) + (["same"] if scheme.similarity is not None else [])


def fingerprints(docs: DataFrame, scheme: Scheme, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text) and the fingerprint's words ``f0, f1, ...`` (signed) of every row.

    A scheme with a similarity adds ``same``, a hash of the shingle set, and ``n``, its size.
    """
    names = _keys(scheme) + (["n"] if scheme.similarity is not None else [])

    def made_of(content: str) -> np.ndarray:
        if scheme.similarity is None:
            return fingerprint(content, scheme.shingle_words, scheme.words).view(np.int64)
        hashes = shingle_set(content, scheme.shingle_words)
        return np.append(_majority([hashes], scheme.words).view(np.int64), [_set_mark(hashes), len(hashes)])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = [made_of(content) for content in batch["text"]]
            found = pd.DataFrame(np.array(prints, np.int64).reshape(-1, len(names)), columns=names)
            found.insert(0, "doc_id", batch["doc_id"].to_numpy())
            found.insert(1, "mark", batch["mark"].to_numpy())
            yield found

    whole = text_or_empty(text)
    named = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.xxhash64(whole).alias("mark"), whole.alias("text"))
    kind = docs.schema[doc_id].dataType
    made = named.mapInPandas(rows, "doc_id string, mark long, " + ", ".join(f"{n} long" for n in names))
    return made.withColumn("doc_id", F.col("doc_id").cast(kind))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _bucket(number: int, masks: tuple[int, ...], names: list[str]) -> Column:
    return F.xxhash64(F.lit(number), *[F.col(n).bitwiseAND(F.lit(_signed(m))) for n, m in zip(names, masks, strict=True)])


def near_links(nodes: DataFrame, scheme: Scheme, bands: slice = slice(None), label: str = "node") -> DataFrame:
    """Links ``a, b`` between near fingerprints of ``nodes`` (``node``, words), enough to join every component.

    Links are between values of ``label``; nodes that share one are joined already and need none. ``bands`` says which
    buckets are used.

    Every fingerprint goes to its buckets. A bucket of over ``GROUP`` fingerprints is dealt into chunks, and every pair
    of chunks is a group; so no task holds more than a group, no near pair is lost, and a group returns fewer links than
    it has rows.
    """
    names = _parts(scheme)
    own = ["node"] if label == "node" else ["node", label]
    keys = F.array(*[_bucket(n, masks, names) for n, masks in list(enumerate(scheme.masks))[bands]])
    dealt = nodes.select(*own, *names, F.explode(keys).alias("bucket"))
    sizes = nodes.select(F.explode(keys).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    large = stored(sizes.filter(F.col("n") > GROUP), "buckets")
    usual = dealt
    if large.count():
        usual = dealt.join(large, "bucket", "left_anti")
        chunks = F.ceil(F.col("n") / F.lit(GROUP // 2)).cast("int")
        mine = F.pmod(F.xxhash64("node"), chunks)
        other = F.explode(F.sequence(F.lit(0), chunks - 1))
        split = dealt.join(large, "bucket").select(*own, *names, "bucket", mine.alias("mine"), other.alias("other"))
        pair = F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other"))
        usual = usual.unionByName(split.select(*own, *names, pair.alias("bucket")))

    def compared(rows: pd.DataFrame) -> list[tuple[int, int]]:
        """Links within the buckets of sorted rows; neighbouring small buckets are compared in one tile."""
        buckets = rows["bucket"].to_numpy()
        starts = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1]))
        sizes = np.diff(np.append(starts, len(buckets)))
        several = np.repeat(sizes > 1, sizes)
        prints = np.ascontiguousarray(rows[names].to_numpy(np.int64)[several]).view(np.uint64)
        nodes_of = rows[label].to_numpy()[several].tolist()
        edges = np.append(0, np.cumsum(sizes[sizes > 1]))
        links, at = [], 0
        while at < len(edges) - 1:
            end = max(at + 1, int(np.searchsorted(edges, edges[at] + TILE, side="right")) - 1)
            low, at = int(edges[at]), end
            links += to_least([(nodes_of[low + a], nodes_of[low + b]) for a, b in spanning_links(prints[low : int(edges[end])], scheme.radius)])
        return links

    return _by_bucket(usual, compared)


def to_least(stars: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same stars with the least node of each in the middle, so that buckets which share members repeat their links."""
    members: dict[int, set[int]] = {}
    for middle, other in stars:
        members.setdefault(middle, {middle}).add(other)
    return [(least, node) for nodes in members.values() for least in [min(nodes)] for node in nodes if node != least]


def candidate_groups(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """``node, component`` of the nodes that near fingerprints join to others.

    The bands are taken in groups, and each group of bands only adds links between the components found so far. So a
    group of near copies, which the first bands join for the most part, leaves few links to all later ones. The bands of
    short sets follow, for the nodes of their sizes ``n``.
    """
    known = _joined(nodes.withColumn("component", F.col("node")), scheme)
    if scheme.short is not None and "n" in nodes.columns:
        known = _joined(known, scheme.short, F.col("n").between(*scheme.sizes))
    several = known.groupBy("component").agg(F.count("*").alias("members")).filter("members > 1").select(F.col("component").alias("whole"))
    return known.join(several, F.col("component") == F.col("whole"), "left_semi").select("node", "component")


def _joined(known: DataFrame, scheme: Scheme, part: Column | None = None) -> DataFrame:
    """``known`` with the components that near fingerprints join, of all nodes or of a part of them."""
    edges = [*(b for b in BAND_GROUPS if b < len(scheme.masks)), len(scheme.masks)]
    for low, high in itertools.pairwise([0, *edges]):
        compared = known if part is None else known.filter(part)
        joined = components(near_links(compared, scheme, slice(low, high), "component")).select(F.col("node").alias("was"), F.col("component").alias("into"))
        renamed = known.join(joined, F.col("component") == F.col("was"), "left").withColumn("component", F.coalesce("into", "component"))
        known = stored(renamed.drop("was", "into"), "joined")
    return known


def _by_bucket(rows: DataFrame, compared: Callable[[pd.DataFrame], list[tuple[int, int]]]) -> DataFrame:
    """Links ``a, b`` that ``compared`` finds in sorted rows of whole buckets."""

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole buckets go on; the last one of a batch waits for the next batch."""
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if len(rest):
                buckets = rest["bucket"].to_numpy()
                cut = int(np.searchsorted(buckets, buckets[-1]))
                yield pd.DataFrame(compared(rest.iloc[:cut]), columns=["a", "b"], dtype="int64")
                rest = rest.iloc[cut:]
        if rest is not None and len(rest):
            yield pd.DataFrame(compared(rest), columns=["a", "b"], dtype="int64")

    ordered = rows.repartition("bucket").sortWithinPartitions("bucket", "node")
    return ordered.mapInPandas(linked, "a long, b long")


def shingle_sets(docs: DataFrame, nodes: DataFrame, scheme: Scheme, doc_id: str, text: str) -> DataFrame:
    """``same`` and ``hashes``, the sorted shingle hashes as bytes, of the documents that ``least`` of ``nodes`` names."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(content, scheme.shingle_words) for content in batch["text"]]
            yield pd.DataFrame({"same": np.array([_set_mark(s) for s in sets], np.int64), "hashes": [s.tobytes() for s in sets]})

    wanted = nodes.select(F.col("least").alias("wanted")).distinct()
    named = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    texts = named.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi").select("text")
    return texts.mapInPandas(rows, "same long, hashes binary").groupBy("same").agg(F.first("hashes").alias("hashes"))


def similar_links(members: DataFrame, scheme: Scheme) -> DataFrame:
    """Links ``a, b`` between ``members`` (``node``, words, ``hashes``, ``component``) of the wanted similarity.

    Every pair of a component within the radius is decided by the Jaccard similarity of its sets, unless links found
    before it in the task join it already. Large components are dealt into chunks and pairs of them, like large buckets.
    """
    names = _parts(scheme)
    kept = members.select("node", *names, "hashes", "component")
    sizes = kept.groupBy("component").agg(F.count("*").alias("n"), F.sum(F.octet_length("hashes")).alias("bytes"))
    chunks = F.greatest(F.ceil(F.col("n") * 2 / GROUP), F.ceil(F.col("bytes") * 2 / SET_BYTES), F.lit(1)).cast("int")
    large = stored(sizes.withColumn("chunks", chunks).filter("chunks > 1").select("component", "chunks"), "large")
    usual = kept.withColumnRenamed("component", "bucket")
    if large.count():
        usual = usual.join(large.select(F.col("component").alias("bucket")), "bucket", "left_anti").select("node", *names, "hashes", "bucket")
        mine = F.pmod(F.xxhash64("node"), "chunks")
        other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
        split = kept.join(large, "component").select("node", *names, "hashes", "component", mine.alias("mine"), other.alias("other"))
        pair = F.xxhash64("component", F.least("mine", "other"), F.greatest("mine", "other"))
        usual = usual.unionByName(split.select("node", *names, "hashes", pair.alias("bucket")))

    def compared(rows: pd.DataFrame) -> list[tuple[int, int]]:
        buckets, nodes = rows["bucket"].to_numpy(), rows["node"].tolist()
        prints = np.ascontiguousarray(rows[names].to_numpy(np.int64)).view(np.uint64)
        sets = [np.frombuffer(h, np.uint64) for h in rows["hashes"]]
        edges = [*np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])).tolist(), len(buckets)] if len(buckets) else [0]
        links = []
        for low, high in itertools.pairwise(edges):
            stars = verified_links(prints[low:high], sets[low:high], scheme)
            links += to_least([(nodes[low + a], nodes[low + b]) for a, b in stars])
        return links

    return _by_bucket(usual, compared)


def verified_links(prints: np.ndarray, sets: list[np.ndarray], scheme: Scheme) -> list[tuple[int, int]]:
    """Stars over what pairs within the radius, of short sets within theirs, and of the similarity join."""
    sliced = planes(prints)

    def within(a: int, others: np.ndarray) -> np.ndarray:
        short = scheme.short is not None and scheme.sizes[0] <= len(sets[a]) <= scheme.sizes[1]
        row = np.unpackbits(near(prints[a : a + 1], sliced, scheme.short.radius if short else scheme.radius)[0].view(np.uint8), bitorder="little")
        return others[row[others].astype(bool)]

    return set_stars(sets, scheme.similarity, within)


def set_stars(sets: list[np.ndarray], similarity: float, within: Callable[[int, np.ndarray], np.ndarray] | None = None) -> list[tuple[int, int]]:
    """Stars over the components of sets whose Jaccard similarity is at least ``similarity``.

    A member is compared with all sets that no component has yet, by one count of the shingles it shares with them; so a
    group of near copies is done after its first member, and no pair is compared that is joined already.
    """
    n = len(sets)
    if n < 2:
        return []
    counts = np.array([len(s) for s in sets], np.int64)
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    edges = np.concatenate([[0], np.cumsum(counts)])
    mark = np.zeros(len(values), np.int32)
    free, stars = np.ones(n, bool), []
    for first in range(n):
        if not free[first]:
            continue
        free[first] = False
        todo = [first]
        while todo:
            a = todo.pop()
            others = np.flatnonzero(free)
            fewer, more = np.minimum(counts[others], counts[a]), np.maximum(counts[others], counts[a])
            others = others[fewer >= similarity * more - EPSILON]
            if within is not None and len(others):
                others = within(a, others)
            if not len(others):
                continue
            mine = codes[edges[a] : edges[a + 1]]
            mark[mine] = 1
            both = _shared(mark, codes, edges, counts, others)
            mark[mine] = 0
            found = others[both >= similarity * (counts[a] + counts[others] - both) - EPSILON]
            free[found] = False
            stars += [(first, b) for b in found.tolist()]
            todo += found.tolist()
    return stars


def _shared(mark: np.ndarray, codes: np.ndarray, edges: np.ndarray, counts: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many marked codes each of the other sets has."""
    sizes = counts[others]
    ends = np.cumsum(sizes)
    places = np.arange(int(ends[-1])) + np.repeat(edges[others] - (ends - sizes), sizes)
    summed = np.concatenate([[0], np.cumsum(mark[codes[places]])])
    return summed[ends] - summed[ends - sizes]


def near_duplicates(docs: DataFrame, scheme: Scheme, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, f0, ..., component_id``, the smallest id that links reach.

    Texts are lower-cased (A to Z) and split at ASCII white space; a text of fewer words than a shingle is one shingle,
    and one without words has fingerprint zero and is linked like any other. Equal fingerprints are reduced to one node
    before anything is compared, so a group of copies of any size is a single row from there on.

    Null texts are empty texts. Null ids get the component of their fingerprint, and do not name one unless all ids of a
    component are null. Repeated rows give repeated results; an empty table gives no rows; extra columns are ignored.

    With a similarity a node is a shingle set. The links of fingerprints name components of candidates only; their sets
    are read again, and only pairs of the similarity (by 64-bit hashes of the shingles) are linked. Fingerprints of sets of at
    most ``SHORT`` shingles meet in more buckets and within a wider radius.
    """
    return _grouped(docs, scheme, doc_id, text).select("doc_id", *_parts(scheme), "component_id")


def _grouped(docs: DataFrame, scheme: Scheme, doc_id: str, text: str) -> DataFrame:
    """The rows of ``fingerprints`` with ``component``, a number, and ``component_id``."""
    keys = _keys(scheme)
    rows = stored(fingerprints(docs, scheme, doc_id, text), "fingerprints")
    sizes = [F.max("n").alias("n")] if scheme.similarity is not None else []
    distinct = rows.groupBy(*keys).agg(F.min("doc_id").alias("least"), *sizes)
    nodes = stored(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
    if scheme.similarity is None:
        groups = components(near_links(nodes, scheme))
    else:
        candidates = stored(nodes.join(candidate_groups(nodes, scheme), "node"), "candidates")
        members = stored(candidates.join(shingle_sets(docs, candidates, scheme, doc_id, text), "same"), "sets")
        groups = components(similar_links(members, scheme))
    linked = stored(nodes.join(groups, "node").select("node", "least", "component"), "members")
    # Stored, so that the join after it has two plain shuffles, of which Spark splits a component with very many nodes.
    smallest = stored(linked.groupBy("component").agg(F.min("least").alias("component_id")), "components")
    named = nodes.join(linked.join(smallest, "component").select("node", "component", "component_id"), "node", "left").select(
        *keys, F.coalesce("component", "node").alias("component"), F.coalesce("component_id", "least").alias("component_id")
    )
    return rows.join(named, keys)


def drop_near_duplicates(docs: DataFrame, scheme: Scheme | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of every component, the one with the smallest id, with all its columns, of any name.

    Of rows that share the smallest id, one stays (by a hash of its text, if they differ); rows of another component that
    repeat an id are decided by their own text. Rows with a null id stay. Null texts count as empty; an empty table stays empty.
    """
    found = stored(_grouped(docs, scheme or similarity_scheme(), doc_id, text).select("doc_id", "mark", "component"), "groups").filter(
        F.col("doc_id").isNotNull()
    )
    kept = found.groupBy("component").agg(F.min(F.struct("doc_id", "mark")).alias("kept"))
    texts = found.groupBy("component", "doc_id", "mark").agg(F.count("*").alias("n"))
    judged = texts.join(kept, "component").withColumn("stays", (F.col("kept.doc_id") == F.col("doc_id")) & (F.col("kept.mark") == F.col("mark")))
    marks = judged.filter(~F.col("stays") | (F.col("n") > 1)).select(F.col("doc_id").alias("marked"), "mark", "stays")
    rows = packed(docs).select("row", F.col(f"row.`{doc_id}`").alias("id"), F.xxhash64(text_or_empty(f"row.`{text}`")).alias("text_mark"))
    same = (F.col("id") == F.col("marked")) & (F.col("text_mark") == F.col("mark"))
    others = rows.join(marks, same, "left_anti")
    repeated = rows.join(marks.filter("stays"), same, "left_semi").dropDuplicates(["id", "text_mark"])
    return others.unionByName(repeated).select("row.*")
