"""Stupid-backoff language-model scores from n-gram counts of the whole corpus."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import text_bytes, text_or_empty

ORDER = 2
BACKOFF = 0.4
#: Longer n-grams count as seen from this many occurrences on; an n-gram that occurs once stands only where it is scored.
SEEN = 2
BLOCK_BYTES = 8 << 20
LEAST_BLOCKS = 64
BLOCKS_PER_BUCKET = 4
LEAST_BUCKETS = 48
PART = 1 << 20
REMEMBERED_WORDS = 200_000
WORD = r"[^\x20\x09-\x0D]+"
_WHITE = re.compile(r"[\x20\x09-\x0D]")


def packed(ascending: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as differences, all first bytes before all second ones: that compresses in a shuffle."""
    steps = np.diff(ascending.astype(np.uint64), prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


class WordHashes:
    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def _learn(self, word: bytes) -> int:
        if len(self.known) >= REMEMBERED_WORDS:
            self.known.clear()
        found = self.known[word] = xxhash.xxh64_intdigest(word)
        return found

    def __call__(self, text: str) -> np.ndarray:
        """Hashes of the lower-cased words of a text, in order; a text is read in parts."""
        get, learn, parts, at = self.known.get, self._learn, [], 0
        while at < len(text):
            white = _WHITE.search(text, min(at + PART, len(text)))
            end = white.start() if white else len(text)
            words = text[at:end].lower().encode().split()
            parts.append(np.array([learn(w) if (h := get(w)) is None else h for w in words], np.uint64))
            at = end + 1
        return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


_HASHES = WordHashes()


def _joined(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those one word shorter and the last word."""
    value = before * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(0x632BE59BD9B4E019)
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(29))


class Block:
    """The n-grams of a block of documents: for every word and order the n-gram that ends there, where the document has one."""

    def __init__(self, rows: pd.DataFrame, order: int, buckets: int):
        words = [_HASHES(t) for t in rows["text"]]
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.owner = np.repeat(np.arange(len(words)), self.sizes)
        every = np.concatenate(words) if words else np.zeros(0, np.uint64)
        place = np.arange(len(every)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.ends, hashes, current = [], [], every
        for n in range(1, order + 1):
            ends = np.flatnonzero(place >= n - 1)
            if n > 1:
                whole = np.zeros(len(every), np.uint64)
                whole[ends] = _joined(current[ends - 1], every[ends])
                current = whole
            self.ends.append(ends)
            hashes.append(current[ends])
        self.cuts = np.cumsum([len(h) for h in hashes])[:-1]
        self.keys, self.at, self.counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        mixed = (self.keys * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)
        self.bucket, self.buckets = mixed.astype(np.int64) % buckets, buckets

    def by_bucket(self) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(self.bucket, kind="stable")
        edges = np.searchsorted(self.bucket[order], np.arange(self.buckets + 1))
        for b in range(self.buckets):
            if edges[b] < edges[b + 1]:
                yield b, order[edges[b] : edges[b + 1]]

    def log_scores(self, totals: np.ndarray, n_words: int) -> np.ndarray:
        """Sums of the logarithms of the words' scores, a document each; ``totals`` are corpus counts by key."""
        of_order = np.split(totals[self.at], self.cuts)
        words = len(self.owner)
        count = [np.zeros(words, np.int64) for _ in of_order]
        for n, (ends, found) in enumerate(zip(self.ends, of_order, strict=True)):
            count[n][ends] = found
        score = np.log(np.maximum(count[0], 1)) - np.log(max(n_words, 1))
        for n in range(1, len(count)):
            ends = self.ends[n]
            score[ends] += np.log(BACKOFF)
            seen = ends[count[n][ends] >= SEEN]
            score[seen] = np.log(count[n][seen]) - np.log(count[n - 1][seen - 1])
        return np.bincount(self.owner, score, len(self.sizes))


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """One row per document: ``doc_id, n_words, log_score, mean_log_score``.

    A word's score is the count of the longest seen n-gram that ends at it over the count of that n-gram without it,
    times ``BACKOFF`` for every order skipped; for the word alone its count over all words of the corpus. Words are lower
    case between ASCII white space; n-grams do not leave their document. ``log_score`` sums natural logarithms.

    Counts cover every document. The corpus is dealt into blocks by a hash; a block sends its distinct n-grams with
    their counts to buckets by the n-gram's hash, a row for each block and bucket. A bucket sums them, which is its part
    of the count table, joins them to what each block sent and replies with the totals in the order asked. So a word
    in every document is one entry for each block, and what moves grows with the distinct n-grams of the blocks.

    A null or empty text has no words, a ``log_score`` of 0 and no mean. Null ids stay null, repeated rows are scored
    and counted as often as they come, an empty table gives no rows; extra columns are ignored.
    """
    named = docs.select(F.col(doc_id).cast("string").alias("doc_id"), text_or_empty(text).alias("text"))
    blocks = max(LEAST_BLOCKS, -(-text_bytes(named, "text") // BLOCK_BYTES))
    buckets = max(LEAST_BUCKETS, blocks // BLOCKS_PER_BUCKET)
    n_words = named.agg(F.sum(F.regexp_count("text", F.lit(WORD)).cast("bigint"))).head()[0] or 0
    by_block = named.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")).groupBy("block")

    def explode(rows: pd.DataFrame) -> pd.DataFrame:
        block, number = Block(rows, order, buckets), int(rows["block"].iloc[0])
        out = [(number, b, packed(block.keys[p]), block.counts[p].astype(np.uint32).tobytes()) for b, p in block.by_bucket()]
        return pd.DataFrame(out, columns=["block", "bucket", "keys", "counts"])

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = [len(k) // 8 for k in rows["keys"]]
        keys = np.concatenate([unpacked(k) for k in rows["keys"]])
        names, back = np.unique(keys, return_inverse=True)
        totals = np.bincount(back, np.frombuffer(b"".join(rows["counts"]), np.uint32), len(names)).astype(np.int64)
        joined = np.split(totals[back], np.cumsum(sizes)[:-1])
        return pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "totals": [t.tobytes() for t in joined]})

    def summed(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        block, totals = Block(rows, order, buckets), {}
        for bucket, data in zip(replies["bucket"], replies["totals"], strict=True):
            totals[int(bucket)] = data
        by_key = np.zeros(len(block.keys), np.int64)
        for bucket, positions in block.by_bucket():
            by_key[positions] = np.frombuffer(totals[bucket], np.int64)
        logs = block.log_scores(by_key, n_words)
        return pd.DataFrame({"doc_id": rows["doc_id"], "n_words": block.sizes, "log_score": logs})

    sent = by_block.applyInPandas(explode, "block int, bucket int, keys binary, counts binary")
    counted = sent.groupBy("bucket").applyInPandas(count, "block int, bucket int, totals binary")
    scored = by_block.cogroup(counted.groupBy("block")).applyInPandas(summed, "doc_id string, n_words long, log_score double")
    scored = scored.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))
    return scored.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
