"""Vectors as product codes: every part of a vector becomes the number of its nearest codebook entry."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import stored
from martloom.llm.gnat import Node, build, nearest

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Integer components beyond it would let a squared distance leave 64 bits.
LARGEST = 1 << 28
#: Vectors that are compared at a time.
CHUNK = 4096
_SUMS = "part int, entry int, n long, sums array<long>"


def _whole(vector: Column) -> Column:
    """Neither null nor with a component that is null or not finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(finite(x), F.lit(False))), F.lit(False))


def _integers(batch: pa.RecordBatch, scale: int) -> np.ndarray:
    """The batch's vectors as rows of integers floor(scale * x)."""
    flat = np.floor(batch.column("vector").flatten().to_numpy(zero_copy_only=False) * scale)
    if len(flat) and np.abs(flat).max() > LARGEST:
        raise ValueError(f"a component beyond {LARGEST} / {scale} has no exact 64-bit distance")
    return flat.astype(np.int64).reshape(batch.num_rows, -1)


def _assigned(vectors: np.ndarray, books: list[np.ndarray], trees: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """Entry number and squared distance of every part of every vector, (n, parts) each."""
    width = vectors.shape[1] // len(books)
    found = [nearest(tree, book, vectors[:, p * width : (p + 1) * width]) for p, (tree, book) in enumerate(zip(trees, books, strict=True))]
    return np.stack([f for f, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            yield batch.slice(at, CHUNK)


def _next_books(rows: DataFrame, books: list[np.ndarray], scale: int) -> list[np.ndarray]:
    """Every entry as the floored mean of the parts assigned to it. A task sends one row for each entry it has used."""
    shape = (len(books), *books[0].shape)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [build(book) for book in books]
        counts, sums = np.zeros(shape[:2], np.int64), np.zeros(shape, np.int64)
        for batch in _chunks(batches):
            vectors = _integers(batch, scale)
            entries, _ = _assigned(vectors, books, trees)
            for p in range(shape[0]):
                counts[p] += np.bincount(entries[:, p], minlength=shape[1])
                np.add.at(sums[p], entries[:, p], vectors[:, p * shape[2] : (p + 1) * shape[2]])
        part, entry = np.nonzero(counts)
        held = [pa.array(x) for x in (part.astype(np.int32), entry.astype(np.int32), counts[part, entry], sums[part, entry].tolist())]
        yield pa.RecordBatch.from_arrays([*held[:3], held[3].cast(pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    exact = [F.sum(F.col("sums")[k].cast("decimal(28,0)")).alias(f"s{k}") for k in range(shape[2])]
    made = [book.copy() for book in books]
    # At most a row for each entry of each part.
    for row in rows.mapInArrow(totals, _SUMS).groupBy("part", "entry").agg(F.sum("n").alias("n"), *exact).collect():
        made[row["part"]][row["entry"]] = [int(row[f"s{k}"]) // row["n"] for k in range(shape[2])]
    return made


def digest(books: list[np.ndarray]) -> str:
    """Hash of all components, by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def compress(
    rows: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every vector, ``code`` as entry numbers in hex, two digits a part.

    Components become floor(scale * x) and vectors ``parts`` equal parts. A part's codebook starts as that part of the
    first ``entries`` vectors by id; each round assigns every part to its nearest entry, found by a tree over the
    entries (``gnat``), and replaces used entries by floored means. Codes come from one more assignment. Every scan is
    one pass without a shuffle of vectors: tasks send counts and sums of at most ``parts * entries`` entries.

    Vectors that are null or have a null or non-finite component are dropped, and so are those whose length is not the one of
    the first kept vector, or is no multiple of ``parts``. Rows are taken in the order of id (nulls last), then vector, so
    repeated ids and rows each count and give repeated results. Rows without a label share one sum. Fewer vectors than
    ``entries`` give shorter codebooks; an empty table gives no rows. Extra columns are ignored. A component of more
    than ``LARGEST / scale`` is an error, as its distances may leave 64 bits.
    """
    if not 0 < entries <= 256:
        raise ValueError("two hex digits hold 256 entries at most")
    schema = f"vec_id {rows.schema[vec_id].dataType.simpleString()}, label {rows.schema[label].dataType.simpleString()}, code string, error long"
    named = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).alias("label"))
    kept = named.filter(_whole(F.col("vector")) & (F.size("vector") % parts == 0) & (F.size("vector") > 0))
    ordered = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    first = kept.orderBy(*ordered).limit(1).select(F.size("vector").alias("n")).head()
    length = first["n"] if first else 0
    kept = kept.filter(F.size("vector") == length)
    start = [r["vector"] for r in kept.orderBy(*ordered).limit(entries).select("vector").collect()]
    books: list[np.ndarray] = []
    if start:
        whole = np.floor(np.array(start) * scale)
        if np.abs(whole).max() > LARGEST:
            raise ValueError(f"a component beyond {LARGEST} / {scale} has no exact 64-bit distance")
        books = np.split(whole.astype(np.int64), parts, axis=1)
        for _ in range(rounds):
            books = _next_books(kept.select("vector"), books, scale)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [build(book) for book in books]
        for batch in _chunks(batches):
            found, distances = _assigned(_integers(batch, scale), books, trees)
            text = found.astype(np.uint8).tobytes().hex()
            codes = [text[at : at + 2 * parts] for at in range(0, len(text), 2 * parts)]
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(distances.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    # Stored, so that vectors are assigned once and the join after it can split a label with very many rows.
    codes = stored(kept.select("vec_id", "label", "vector").mapInArrow(coded, schema), "vector-codes")
    sums = codes.groupBy(F.col("label").alias("same_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("same_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
