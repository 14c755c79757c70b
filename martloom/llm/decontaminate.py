"""Benchmark decontamination by size-partitioned MinHash containment search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import packed, small_side, stored, text_or_empty

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
WORD = r"[\p{L}\p{M}\p{N}]+"
#: Keeps products such as 0.8 * 35 from being rounded past a whole number.
EPSILON = 1e-9


def _words(text: str) -> Column:
    return F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(WORD), F.lit(0))


def _per_shingle(words: Column, size: int, make) -> Column:
    """``make`` of every ``size`` consecutive words; of all words where there are fewer; nothing where there is none."""
    last = F.greatest(F.size(words) - (size - 1), F.lit(1))
    shingles = F.transform(F.sequence(F.lit(1), last), lambda i: make(F.slice(words, i, size)))
    return F.when(F.size(words) > 0, shingles)


def _text_of(shingle: Column) -> Column:
    return F.array_join(shingle, " ")


def item_shingles(items: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """Distinct shingles of the test items with their hash and the item's number of them."""
    words = items.select(F.col(item_id).alias("item_id"), _words(text).alias("words"))
    each = F.transform(_per_shingle(F.col("words"), size, lambda s: F.struct(F.xxhash64(s).alias("hash"), _text_of(s).alias("shingle"))), lambda s: s)
    rows = words.select("item_id", F.explode_outer(each).alias("s")).select("item_id", "s.hash", "s.shingle")
    rows = rows.filter("shingle IS NOT NULL").distinct()
    return rows.withColumn("n_item", F.count("*").over(Window.partitionBy("item_id")))


def item_sketches(shingles: DataFrame, threshold: float) -> DataFrame:
    """The MinHash sketch of every item: its smallest shingle hashes, as many as its size partition asks for.

    Partitions hold items of sizes between two powers of two. A document with the wanted share of an item lacks at most
    ``(1 - threshold) * size`` of its shingles, so with one more than that at the largest size of the partition it
    holds at least one hash of the sketch: nothing is missed.
    """
    sized = shingles.withColumn("partition", F.floor(F.log2("n_item")).cast("int"))
    largest = sized.groupBy("partition").agg(F.max("n_item").alias("largest"))
    length = F.col("largest") - F.ceil(F.col("largest") * F.lit(threshold) - EPSILON) + 1
    place = F.row_number().over(Window.partitionBy("item_id").orderBy("hash", "shingle"))
    placed = sized.withColumn("place", place).join(largest, "partition")
    return placed.filter(F.col("place") <= length).select("partition", "item_id", "hash")


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = CONTAINMENT,
    size: int = SHINGLE_WORDS,
) -> DataFrame:
    """Pairs of a document and a test item it contains: ``doc_id, item_id, n_shared, n_item, containment``.

    Containment is the share of the item's distinct word shingles that occur anywhere in the document, and is at least
    ``threshold``. Words are runs of letters, marks and digits in lower case. A text of fewer than ``size`` words is
    one shingle of all its words.

    Documents are searched by the sketches of the items, then every candidate pair is verified on the shingles
    themselves. The sketches are broadcast where they are counted to be few; the documents' hashes are joined in their
    scan and only hits are shuffled. Candidates are counted by document and item, so an item found in a third of all
    documents spreads over the documents.

    Null and empty texts contain nothing and are contained in nothing. Rows that share a ``doc_id`` are taken as one
    document, repeated items as one item; a null id is an id of its own. Extra columns are ignored.
    """
    shingles = stored(item_shingles(items, item_id, item_text, size), "items")
    sketches = stored(item_sketches(shingles, threshold), "sketches")
    highest = sketches.agg(F.max("hash")).head()[0]
    words = docs.select(F.col(doc_id).alias("doc_id"), _words(text).alias("words"))
    hashes = _per_shingle(F.col("words"), size, F.xxhash64)
    low = F.filter(hashes, lambda h: h <= F.lit(highest).cast("bigint"))
    # Not explode(): the filter that Spark infers from it would split the text anew for every shingle. Nulls join nothing.
    hits = words.select("doc_id", F.explode_outer(low).alias("hash")).join(small_side(sketches.select("item_id", "hash")), "hash")
    candidates = stored(hits.select("doc_id", "item_id").distinct(), "candidates")

    wanted = candidates.select(F.col("doc_id").alias("wanted")).distinct()
    suspects = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi"
    )
    spelled = suspects.select("doc_id", _words("text").alias("words"))
    texts = spelled.select("doc_id", F.explode_outer(_per_shingle(F.col("words"), size, _text_of)).alias("shingle"))
    shared = texts.join(small_side(shingles.select("item_id", "shingle", "n_item")), "shingle").distinct()
    counted = shared.groupBy("doc_id", "item_id", "n_item").agg(F.count("*").alias("n_shared"))
    pairs = candidates.withColumnsRenamed({"doc_id": "c_doc", "item_id": "c_item"})
    same = F.col("doc_id").eqNullSafe(F.col("c_doc")) & F.col("item_id").eqNullSafe(F.col("c_item"))
    return (
        counted.filter(F.col("n_shared") >= F.col("n_item") * F.lit(threshold) - EPSILON)
        .join(pairs, same, "left_semi")
        .select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that contain no test item, with all their columns; columns of any name are kept.

    Null and empty texts contain no item and stay. Rows of one id, a null one too, go together when one of them contains
    an item. Without items, or without documents, nothing changes.
    """
    leaks = contained_items(docs, items, doc_id, text).select(F.col("doc_id").alias("leak")).distinct()
    return packed(docs).join(leaks, F.col(f"row.`{doc_id}`").eqNullSafe(F.col("leak")), "left_anti").select("row.*")
