"""Removal of long byte strings that an earlier document holds already."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import text_bytes, text_or_empty
from martloom.llm.suffixes import SPAN, equal_classes, repeated_windows, window_runs

#: Bytes of text that one task reads at a time, and blocks at least, so that small tables spread as well.
BLOCK_BYTES = 16 << 20
LEAST_BLOCKS = 64
#: Buckets for each block: what one bucket sorts takes several times its bytes of memory.
BUCKETS_A_BLOCK = 2
#: A key with more runs than this is hot: its windows are then spread by their own bytes.
HOT_RUNS = 50_000
LAST = np.iinfo(np.int64).max

REPLY = "block int, bucket int, kind int, data binary"
ASK = "block int, bucket int, kind int, keys binary, lengths binary, firsts binary, data binary"
ASK_COLUMNS = ["block", "bucket", "kind", "keys", "lengths", "firsts", "data"]
#: Kinds of rows: what a bucket says of keys, spans a bucket has resolved, what a block keeps of itself for the cut.
MARKS, SPANS, OWN = 0, 1, 2


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets


def _planes(values: np.ndarray) -> bytes:
    """Numbers of 64 bits byte by byte: the upper bytes of small numbers are one run of zeros, which compresses."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(data: bytes, kind: type = np.int64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(kind).ravel()


def _joined_numbers(parts: pd.Series, kind: type = np.int64) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *[_numbers(p, kind) for p in parts]])


def _sorted_keys(parts: pd.Series) -> np.ndarray:
    """Keys that were sent as the differences of a rising sequence."""
    return np.concatenate([np.zeros(0, np.uint64), *[np.cumsum(_numbers(p, np.uint64), dtype=np.uint64) for p in parts]])


def _steps(values: np.ndarray) -> np.ndarray:
    """Differences of neighbours: numbers that rise slowly travel as small ones."""
    return np.diff(values, prepend=values.dtype.type(0))


def in_order(rows: pd.DataFrame) -> tuple[np.ndarray, list[bool], list[bytes]]:
    """Ids, whether they are null, and texts of a block in an order that does not depend on how its rows came in."""
    found = sorted(zip(rows["own"].tolist(), rows["unnamed"].tolist(), rows["text"].tolist(), strict=True))
    return np.array([f[0] for f in found], np.int64), [f[1] for f in found], [f[2].encode() for f in found]


class Block:
    """The documents of a block, their runs, and the keys it asks for, by bucket and key."""

    def __init__(self, rows: pd.DataFrame, buckets: int):
        self.ids, self.unnamed, self.texts = in_order(rows)
        self.runs = [window_runs(t) for t in self.texts]
        self.buckets = buckets
        keys = np.concatenate([r[2] for r in self.runs]) if self.runs else np.zeros(0, np.uint64)
        owner = np.repeat(self.ids, [len(r[2]) for r in self.runs])
        self.keys, self.at = np.unique(keys, return_inverse=True)
        least, most = np.full(len(self.keys), LAST), np.full(len(self.keys), np.iinfo(np.int64).min)
        np.minimum.at(least, self.at, owner)
        np.maximum.at(most, self.at, owner)
        self.several = least != most
        self.occurrences = np.bincount(self.at, minlength=len(self.keys)).astype(np.int64)
        self.bucket = _bucket_of(self.keys, buckets)

    def questions(self):
        """Positions in ``keys`` by bucket."""
        order = np.argsort(self.bucket, kind="stable")
        edges = np.searchsorted(self.bucket[order], np.arange(self.buckets + 1))
        return [(b, order[edges[b] : edges[b + 1]]) for b in range(self.buckets) if edges[b] < edges[b + 1]]

    def shared(self, replies: pd.DataFrame) -> np.ndarray:
        """What the buckets say of every key: 0 in one document, 1 in several, 2 hot."""
        said = {int(b): d for b, d in zip(replies["bucket"], replies["data"], strict=True)}
        marks = np.zeros(len(self.keys), np.uint8)
        for bucket, positions in self.questions():
            marks[positions] = np.frombuffer(said[bucket], np.uint8)
        return marks

    def snippets(self, marks: np.ndarray):
        """The distinct stretches to be resolved: key, bytes, first document of each and bucket, in a fixed order by bucket.

        And the shared runs: document, start, end and the stretch's place in that order.
        """
        place: dict[tuple[int, bytes], int] = {}
        documents, begins, stops, which = [], [], [], []
        at = 0
        for number, (starts, ends, keys) in enumerate(self.runs):
            said = marks[self.at[at : at + len(keys)]]
            at += len(keys)
            text = self.texts[number]
            marked = np.flatnonzero(said)
            if not len(marked):
                continue
            before = len(begins)
            runs = zip(starts[marked].tolist(), ends[marked].tolist(), keys[marked].tolist(), said[marked].tolist(), strict=True)
            for start, end, key, mark in runs:
                if mark == 1:
                    begins.append(start)
                    stops.append(end)
                    which.append(place.setdefault((key, text[start : end + SPAN - 1]), len(place)))
                else:
                    for p in range(start, end):
                        window = text[p : p + SPAN]
                        begins.append(p)
                        stops.append(p + 1)
                        which.append(place.setdefault((xxhash.xxh64_intdigest(window), window), len(place)))
            documents.append(np.full(len(begins) - before, number))
        names = list(place)
        keys = np.array([n[0] for n in names], np.uint64)
        bucket = _bucket_of(keys, self.buckets)
        order = np.lexsort((keys, bucket))
        same = keys[order[1:]] == keys[order[:-1]]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
        for low, high in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            order[low : high + 1] = sorted(order[low : high + 1].tolist(), key=lambda i: names[i][1])
        rank = np.empty(len(names), np.int64)
        rank[order] = np.arange(len(names))
        documents = np.concatenate([*documents, np.zeros(0, np.int64)]).astype(np.int64)
        which = rank[np.array(which, np.int64)]
        firsts = np.full(len(names), LAST)
        np.minimum.at(firsts, which, self.ids[documents])
        found = documents, np.array(begins, np.int64), np.array(stops, np.int64), which
        return keys[order], [names[i][1] for i in order.tolist()], firsts, bucket[order], found


def _ask(buckets: int):
    def ask(rows: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows, buckets)
        number = int(rows["block"].iloc[0])
        out = [
            (number, b, _planes(_steps(block.keys[p])), block.several[p].tobytes(), _planes(block.occurrences[p]))
            for b, p in block.questions()
        ]
        return pd.DataFrame(out, columns=["block", "bucket", "keys", "several", "occurrences"])

    return ask


def _count(rows: pd.DataFrame) -> pd.DataFrame:
    """Of every key asked for in a bucket: whether several documents hold it, and whether it has very many runs."""
    sizes = [len(k) // 8 for k in rows["keys"]]
    keys = _sorted_keys(rows["keys"])
    several = np.frombuffer(b"".join(rows["several"]), bool)
    names, back, blocks = np.unique(keys, return_inverse=True, return_counts=True)
    marks = np.zeros(len(names), np.uint8)
    marks[back[several]] = 1
    marks[blocks > 1] = 1
    runs = np.bincount(back, _joined_numbers(rows["occurrences"]), len(names))
    marks[(marks == 1) & (runs > HOT_RUNS)] = 2
    replies = np.split(marks[back], np.cumsum(sizes)[:-1])
    return pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "kind": MARKS, "data": [r.tobytes() for r in replies]})


def _joined(documents: np.ndarray, starts: np.ndarray, ends: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and end of the maximal runs that spans cover; spans that touch are one. No end is beyond ``room``."""
    low, high = documents * (room + 2) + starts, documents * (room + 2) + ends
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    fresh = np.append(True, low[1:] > high[:-1])[: len(low)]
    last = np.append(fresh[1:], True)[: len(low)]
    documents = low[fresh] // (room + 2)
    return documents, low[fresh] - documents * (room + 2), high[last] - documents * (room + 2)


def _send(buckets: int):
    def send(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame([], columns=ASK_COLUMNS)
        out, number = [], int(rows["block"].iloc[0])
        block = Block(rows, buckets)
        keys, data, firsts, bucket, (documents, begins, stops, which) = block.snippets(block.shared(replies))
        lengths = np.array([len(d) for d in data], np.int64)
        edges = np.searchsorted(bucket, np.arange(buckets + 1))
        for b in np.unique(bucket).tolist():
            mine = slice(edges[b], edges[b + 1])
            numbers = _planes(_steps(keys[mine])), _planes(lengths[mine]), _planes(firsts[mine])
            out.append((number, b, 0, *numbers, b"".join(data[mine])))
        # What an earlier document of the block covers is known here; the rest waits for its stretch. The bucket hands both back.
        known = firsts[which] < block.ids[documents]
        room = max(map(len, block.texts))
        spans = _joined(documents[known], begins[known], stops[known] + SPAN - 1, room)
        waiting = [_steps(v[~known]) for v in (documents, begins, which)]
        packed = [np.concatenate([_steps(spans[0]), _steps(spans[1]), spans[2] - spans[1]]), np.concatenate(waiting), edges]
        out.append((number, number % buckets, OWN, *[_planes(p.astype(np.int64)) for p in packed], b""))
        return pd.DataFrame(out, columns=ASK_COLUMNS)

    return send


def _resolve(rows: pd.DataFrame) -> pd.DataFrame:
    """For every stretch sent to a bucket, its windows that stand in a document before the block's first with it.

    Equal stretches are one. Where a key has different ones, the windows of them that may be equal are suffix-sorted
    within the key, and equal windows share the least document. What blocks keep of themselves goes back to them as it is.
    """
    own = rows[rows["kind"] == OWN]
    rows = rows[rows["kind"] != OWN]
    asked = [len(k) // 8 for k in rows["keys"]]
    keys, lengths, firsts = _sorted_keys(rows["keys"]), _joined_numbers(rows["lengths"]), _joined_numbers(rows["firsts"])
    data = b"".join(rows["data"])
    begins = np.append(0, np.cumsum(lengths))[:-1]
    place: dict[tuple[int, bytes], int] = {}
    which = np.array(
        [place.setdefault((k, data[b : b + n]), len(place)) for k, b, n in zip(keys.tolist(), begins.tolist(), lengths.tolist(), strict=True)],
        np.int64,
    )
    least = np.full(len(place), LAST)
    np.minimum.at(least, which, firsts)
    names = list(place)
    name_keys = np.array([n[0] for n in names], np.uint64)
    _, group, many = np.unique(name_keys, return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(many[group] > 1)
    mixed = mixed[np.argsort(group[mixed], kind="stable")]
    buffer = b"".join(names[i][1] for i in mixed)
    size = np.array([len(names[i][1]) for i in mixed], np.int64)
    windows = size - SPAN + 1
    offset = np.append(0, np.cumsum(size))[:-1]
    first_window = np.append(0, np.cumsum(windows))
    local = np.arange(first_window[-1]) - np.repeat(first_window[:-1], windows)
    places, groups, earliest = np.repeat(offset, windows) + local, np.repeat(group[mixed], windows), np.repeat(least[mixed], windows)
    # A window whose hash no other window of its key has is equal to none: only the rest is sorted.
    again = np.flatnonzero(repeated_windows(buffer, places, groups))
    order, classes = equal_classes(buffer, places[again], groups[again])
    best = np.full(int(classes[-1]) + 1 if len(classes) else 0, LAST)
    np.minimum.at(best, classes, earliest[again[order]])
    earliest[again[order]] = best[classes]
    at = np.full(len(names), -1)
    at[mixed] = np.arange(len(mixed))
    # The least document of any window of a stretch: most stretches have no window in an earlier one.
    reach = least.copy()
    if len(mixed):
        reach[mixed] = np.minimum.reduceat(earliest, first_window[:-1])
    concerned = reach[which] < firsts

    out = [
        (int(block), int(bucket), OWN, np.array([len(k), len(w), len(e)], np.int64).tobytes() + k + w + e)
        for block, bucket, k, w, e in zip(own["block"], own["bucket"], own["keys"], own["lengths"], own["firsts"], strict=True)
    ]
    done = 0
    for block, bucket, n in zip(rows["block"], rows["bucket"], asked, strict=True):
        spans = []
        for i in np.flatnonzero(concerned[done : done + n]).tolist():
            name, mine = which[done + i], firsts[done + i]
            if least[name] < mine:
                spans.append((i, 0, lengths[done + i] - SPAN + 1))
            elif at[name] >= 0:
                covered = earliest[first_window[at[name]] : first_window[at[name] + 1]] < mine
                if covered.any():
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
                    spans.extend((i, a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        done += n
        if spans:
            out.append((int(block), int(bucket), SPANS, np.array(spans, np.int64).tobytes()))
    return pd.DataFrame(out, columns=["block", "bucket", "kind", "data"])


def _kept_of_block(data: bytes):
    """What ``_send`` packed: known spans (document, start, end), waiting runs (document, start, stretch), bucket edges."""
    sizes = np.frombuffer(data, np.int64, 3)
    spans, waiting, edges = (_numbers(d) for d in _sliced(data[sizes.nbytes :], sizes.tolist()))
    documents, starts, widths = spans.reshape(3, -1)
    starts = np.cumsum(starts)
    return (np.cumsum(documents), starts, starts + widths), np.cumsum(waiting.reshape(3, -1), axis=1), edges


def _sliced(data: bytes, sizes: list[int]) -> list[bytes]:
    ends = np.cumsum(sizes).tolist()
    return [data[end - size : end] for size, end in zip(sizes, ends, strict=True)]


def _cut(keep_text: bool):
    def cut(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        ids, unnamed, texts = in_order(rows)
        (documents, starts, ends), (later, begins, which), edges = _kept_of_block(replies["data"][replies["kind"] == OWN].iloc[0])
        resolved = replies[replies["kind"] == SPANS]
        found = [
            np.frombuffer(data, np.int64).reshape(-1, 3) + (edges[b], 0, 0)
            for b, data in zip(resolved["bucket"], resolved["data"], strict=True)
        ]
        covered = np.concatenate([np.zeros((0, 3), np.int64), *found])
        covered = covered[np.argsort(covered[:, 0], kind="stable")]
        first = np.searchsorted(covered[:, 0], which)
        many = np.searchsorted(covered[:, 0], which, side="right") - first
        at = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        shift = np.repeat(begins, many)
        documents = np.concatenate([documents, np.repeat(later, many)])
        starts = np.concatenate([starts, shift + covered[at, 1]])
        ends = np.concatenate([ends, shift + covered[at, 2] + SPAN - 1])
        documents, starts, ends = _joined(documents, starts, ends, max(map(len, texts), default=0))
        bounds = np.searchsorted(documents, np.arange(len(texts) + 1)).tolist()
        starts, ends = starts.tolist(), ends.tolist()
        out = []
        for number, (key, nameless, text) in enumerate(zip(ids.tolist(), unnamed, texts, strict=True)):
            kept, at = [], 0
            for i in range(bounds[number], bounds[number + 1]):
                kept.append(text[at : starts[i]])
                at = ends[i]
            rest = b"".join([*kept, text[at:]])
            row = (None if nameless else key, len(text), len(text) - len(rest), len(kept), hashlib.sha256(rest).hexdigest())
            out.append((*row, rest) if keep_text else row)
        names_out = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * keep_text]
        found = pd.DataFrame(out, columns=names_out)
        return found.assign(doc_id=pd.array([r[0] for r in out], "Int64"))

    return cut


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for, the ``kept`` bytes.

    Every byte goes that is covered by a string of ``SPAN`` bytes which also starts in a document of a smaller id.

    Documents are dealt into blocks by a hash. A block asks, bucket by bucket, which of its window keys other documents
    hold as well; equal windows have equal keys, so all else is left alone. For those it sends the distinct stretches
    of windows, and the bucket resolves them by a suffix sort: hash-compared, a merge sort, verified by bytes. Copies
    of a passage are one stretch for each block. A key with very many runs, such as those at the edges of a passage that
    a third of all documents hold, is given up for its single windows, each a group by itself with one entry for each
    block; so no group grows with the number of documents. Rows between blocks and buckets are at most one for each key.

    Ids are whole numbers; ids as text that is no number are an error. Null texts are empty. A null id counts as later than
    all others. Documents that share an id leave one another alone. Texts shorter than ``SPAN`` bytes keep everything; an empty table gives no rows; extra columns are ignored.
    """
    number = F.col(doc_id).cast("bigint")
    named = docs.select(F.coalesce(number, F.lit(LAST)).alias("own"), number.isNull().alias("unnamed"), text_or_empty(text).alias("text"))
    blocks = max(LEAST_BLOCKS, -(-text_bytes(named, "text") // BLOCK_BYTES))
    buckets = BUCKETS_A_BLOCK * blocks
    dealt = named.withColumn("block", F.pmod(F.xxhash64("own", "text"), F.lit(blocks)).cast("int"))
    by_block = dealt.groupBy("block")
    asked = by_block.applyInPandas(_ask(buckets), "block int, bucket int, keys binary, several binary, occurrences binary")
    counted = asked.groupBy("bucket").applyInPandas(_count, REPLY)
    sent = by_block.cogroup(counted.groupBy("block")).applyInPandas(_send(buckets), ASK)
    resolved = sent.groupBy("bucket").applyInPandas(_resolve, REPLY)
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text
    return by_block.cogroup(resolved.groupBy("block")).applyInPandas(_cut(keep_text), result)
