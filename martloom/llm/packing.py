"""Harmonic packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from martloom.llm.common import stored, text_or_empty

CAPACITY = 2048
END_ID = 1
#: A piece goes to its class uncut where a full bin of its like leaves at most this share of padding.
TOLERANCE = 1 / 64
#: Words whose ids a Python worker remembers before it starts anew; a worker that goes on to other stages keeps them, about 100 MB.
REMEMBERED_WORDS = 450_000

#: Letters of one code point each whose lower case is one as well; no sign of the second part starts a contraction.
LATIN_LETTERS = "".join(chr(c) for c in range(0xC0, 0x100) if chr(c).isalpha())
_PLAIN = re.compile(rf"([A-Za-z{LATIN_LETTERS}]+)([!-&(-/:-@\[-`{{-~]*)")

PIECES = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, class int, worker int, place long"


def cut(tokens: int, capacity: int = CAPACITY, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """Lengths and classes of a document's pieces. Class j takes lengths up to ``capacity // j``, j to a bin.

    Whole sequences first. The rest goes to the class of its length if j of it nearly fill a bin; else a piece as
    long as the next class allows is cut off, which leaves a much shorter rest.
    """
    pieces = [(capacity, 1)] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        share = capacity // rest
        if capacity - share * rest <= capacity * tolerance:
            pieces.append((rest, share))
            break
        length = capacity // (share + 1)
        pieces.append((length, share + 1))
        rest -= length
    return pieces


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    No token of this kind of vocabulary spans white space, so ids are looked up word by word and words are remembered,
    up to a bound. A new word of common Latin letters with signs after it is two pieces to the tokenizer, lower-case
    letters and signs; its model takes each of them without going through the stages before it. Any other word
    goes through all of the tokenizer.
    """

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_file(vocabulary)
        # A text with the name of one of these is cut around it, so such a text goes through all of the tokenizer as a whole.
        self.added = [token.content.lower() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {"": b""}
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled = {ord(c): byte_level.pre_tokenize_str(c)[0][0] for c in LATIN_LETTERS}

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            if len(self.pieces) >= REMEMBERED_WORDS:
                self.pieces = {"": b""}
            ids = [token.id for token in self.tokenizer.model.tokenize(piece.translate(self.spelled))]
            found = self.pieces[piece] = np.array(ids, "<u4").tobytes()
        return found

    def _learn(self, word: str) -> bytes:
        if len(self.known) >= REMEMBERED_WORDS:
            self.known.clear()
        if len(word) > 64:
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if parts := _PLAIN.fullmatch(word):
            found = self._piece(parts[1].lower()) + self._piece(parts[2])
        else:
            found = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        self.known[word] = found
        return found

    def __call__(self, text: str) -> bytes:
        lowered = text.lower() if any(name[0] in text for name in self.added) else ""
        if any(name in lowered for name in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        get, learn = self.known.get, self._learn
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join([learn(w) if (ids := get(w)) is None else ids for w in words if w])


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def cut_documents(docs: DataFrame, vocabulary: str, doc_id: str, text: str, keep_ids: bool) -> DataFrame:
    """Pieces of all documents (ids as text), numbered within their class by the task that cut them."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, worker, counts = encoder(vocabulary), TaskContext.get().partitionId(), {}
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for key, content in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encode(content) + end
                start, total = 0, len(ids) // 4
                for length, kind in cut(total):
                    part = ids[4 * start : 4 * (start + length)]
                    place = counts.get(kind, 0)
                    counts[kind] = place + 1
                    row = (key, start, length, zlib.crc32(part), total, kind, worker, place)
                    rows.append((*row, part) if keep_ids else row)
                    start += length
            names = [c.split()[0] for c in schema.split(", ")]
            yield pd.DataFrame(rows, columns=names)

    schema = PIECES + ", ids binary" * keep_ids
    return docs.select(F.col(doc_id).cast("string").alias("doc_id"), text_or_empty(text).alias("text")).mapInPandas(pieces, schema)


def _first_fit(rows: pd.DataFrame) -> pd.DataFrame:
    """Longest first, each into the first bin with room."""
    rows = rows.sort_values(["length", "doc_id", "start"], ascending=[False, True, True])
    room: list[int] = []
    bins = []
    for length in rows["length"]:
        at = next((b for b, left in enumerate(room) if left >= length), len(room))
        if at == len(room):
            room.append(CAPACITY)
        room[at] -= length
        bins.append(at)
    return rows.assign(bin=bins, place=range(len(rows)))


def pack(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of documents with their place in a sequence of at most ``CAPACITY`` tokens.

    Columns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, if asked for, the piece's ``ids``
    (little-endian 32-bit). Sequence ids and the offsets in a sequence have no gaps.

    Every task cuts its documents into pieces of reciprocal-capacity classes and fills bins of j pieces of class j on
    its own. What a task leaves over is numbered within its class over all tasks, by the tasks' counts, and fills
    bins of j in the same way. Under j pieces of each class are left then, however large the input: those few go
    to the first bin with room.

    A null text is an empty one, which is the end id alone; null ids stay null; rows that repeat are packed as often
    as they come; an empty table gives no rows. Extra columns are ignored.
    """
    pieces = stored(cut_documents(docs, vocabulary, doc_id, text, keep_ids), "pieces")
    kind = Window.partitionBy("class")
    before = kind.orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("class", "worker").agg(F.count("*").alias("n"))
    full, left = F.expr("n div class"), F.expr("n % class")
    fills = stored(
        counts.select(
            "class",
            "worker",
            full.alias("bins"),
            F.coalesce(F.sum(full).over(before), F.lit(0)).alias("bins_before"),
            F.coalesce(F.sum(left).over(before), F.lit(0)).alias("left_before"),
            F.sum(full).over(kind).alias("class_bins"),
            F.expr("sum(n % class) over (partition by class) div class").alias("shared_bins"),
        ),
        "fills",
    )
    # A row for each class, of which there are fewer than 100.
    by_class = fills.groupBy("class").agg(F.first("class_bins").alias("class_bins"), F.first("shared_bins").alias("shared"))
    ahead = Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    firsts = by_class.select("class", F.coalesce(F.sum(F.col("class_bins") + F.col("shared")).over(ahead), F.lit(0)).alias("first"))
    total = by_class.agg(F.coalesce(F.sum(F.col("class_bins") + F.col("shared")), F.lit(0))).head()[0]

    placed = pieces.join(fills, ["class", "worker"]).join(F.broadcast(firsts), "class")
    own = F.expr("place < bins * class")
    in_class = F.expr("left_before + place - bins * class")
    shared_bin = F.expr("(left_before + place - bins * class) div class")
    columns = [c for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids") if c in pieces.columns]
    regular = placed.filter(own | (shared_bin < F.col("shared_bins"))).select(
        *columns,
        (F.col("first") + F.when(own, F.expr("bins_before + place div class")).otherwise(F.col("class_bins") + shared_bin)).alias("sequence_id"),
        F.when(own, F.col("place")).otherwise(in_class).alias("place"),
    )
    few = placed.filter(~own & (shared_bin >= F.col("shared_bins"))).select(*columns, F.lit(0).alias("bin"), F.lit(0).cast("bigint").alias("place"))
    fitted = few.groupBy("bin").applyInPandas(_first_fit, few.schema)
    last = fitted.select(*columns, (F.lit(total) + F.col("bin")).cast("bigint").alias("sequence_id"), "place")
    order = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(order), F.lit(0))
    packed = regular.unionByName(last).withColumn("offset", offset).drop("place")
    return packed.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))
