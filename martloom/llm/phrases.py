"""Collocations: the best-scoring phrases of every language, mined by growth from prefixes and suffixes of high score bounds.

A phrase of count a that is cut into parts of counts l and r scores 1000 * a * n / (l * r), and a is at most l and r. So no
phrase scores above 1000 * n / f for the count f of its first or its last word, and these bounds order the frontier.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.common import stored, text_or_empty

MIN_COUNT, MAX_WORDS, TOP, SHARE = 100, 5, 2000, 100
#: Shares of all occurrences of frequent words that are open in each round, from the rarest word on.
ROUNDS = (0.25, 1.0)
#: Words that a task encodes together.
CHUNK = 2_000_000
#: Bits of a filter, and probes for each entry. A full filter lets more through and loses nothing.
FILTER_BITS, PROBES = 25, 4
#: Parts into which a language's phrases are ranked before the last ranking.
SALTS = 64

# What ends a piece; no word holds one of them.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BREAK = b"."
_AS_BREAK = bytes.maketrans(ENDS, BREAK * len(ENDS))

Test = Callable[[np.ndarray], np.ndarray]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _extended(grams: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word each."""
    return _mixed(grams * np.uint64(0x9E3779B97F4A7C15) + words)


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def _tokens(texts: list[str]) -> list[bytes]:
    """Words in order, with ``BREAK`` between pieces and documents."""
    data = BREAK.join(t.encode() for t in texts).lower().translate(_AS_BREAK)
    return data.replace(BREAK, b" " + BREAK + b" ").split()


_CHUNKS = "lang string, n long, words array<string>, counts array<long>, codes binary"


def encoded(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Chunks of one language each: distinct words with their counts, and the words in order as numbers, -1 between pieces."""
    most = CHUNK

    def chunk(language: str, texts: list[str]) -> pa.RecordBatch:
        codes, words = pd.factorize(np.array([BREAK, *_tokens(texts)], object))
        codes = codes.astype(np.int32) - 1
        counts = np.bincount(codes[codes >= 0], minlength=len(words) - 1)
        columns = [[language], [int(counts.sum())], [words[1:].tolist()], [counts.tolist()], [codes.tobytes()]]
        kinds = [pa.string(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        arrays[2] = arrays[2].cast(pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "n", "words", "counts", "codes"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[str]] = {}
        size = 0
        for batch in batches:
            for language, content in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held.setdefault(language, []).append(content)
                size += len(content) // 5 + 1
                if size > most:
                    yield from (chunk(*item) for item in held.items())
                    held, size = {}, 0
        yield from (chunk(*item) for item in held.items())

    named = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), text_or_empty(text).alias("text"))
    return named.mapInArrow(chunks, _CHUNKS)


def _probes(h: Column) -> list[Column]:
    mask = F.lit((1 << FILTER_BITS) - 1)
    step = F.shiftrightunsigned(h, 64 - FILTER_BITS).bitwiseOR(F.lit(1))
    return [(h.bitwiseAND(mask) + step * k).bitwiseAND(mask) for k in range(PROBES)]


def _filter(hashes: DataFrame) -> Broadcast:
    """A Bloom filter of the column ``h``, of one size whatever the number of rows."""
    bit = F.explode(F.array(*_probes(F.col("h")))).alias("bit")
    marks = hashes.select(bit).select(F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("mark"))
    found = marks.groupBy("word").agg(F.bit_or("mark").alias("mark")).toArrow()
    words = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    words[found["word"].to_numpy()] = found["mark"].to_numpy().astype(np.int64).view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(words)


def _test(words: np.ndarray) -> Test:
    bits = len(words).bit_length() + 5
    mask = np.uint64((1 << bits) - 1)

    def within(h: np.ndarray) -> np.ndarray:
        found, at, step = np.ones(len(h), bool), h & mask, (h >> np.uint64(64 - bits)) | np.uint64(1)
        for _ in range(PROBES):
            found &= (words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
            at = (at + step) & mask
        return found

    return within


_COMPACT = "lang string, words array<string>, hashes binary, codes binary"


def compacted(chunks: DataFrame, frequent: Broadcast) -> DataFrame:
    """The chunks without rare words: a place of theirs ends a piece, as no phrase holds one. Adds the words' hashes."""

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        usual_words = _test(frequent.value)
        for batch in batches:
            for k in range(batch.num_rows):
                words = batch.column("words")[k].values
                hashes = _word_hashes(batch.column("lang")[k].as_py(), words.cast(pa.binary()).to_pylist())
                usual = usual_words(hashes)
                number = np.append(np.where(usual, np.cumsum(usual) - 1, -1), -1).astype(np.int32)  # the last entry stands for -1
                codes = number[np.frombuffer(batch.column("codes")[k].as_py(), np.int32)]
                codes = codes[(codes >= 0) | np.append(False, codes[:-1] >= 0)]
                columns = [batch.column("lang").slice(k, 1), pa.array([words.filter(pa.array(usual)).to_pylist()], pa.list_(pa.string()))]
                columns += [pa.array([x.tobytes()], pa.binary()) for x in (hashes[usual], codes)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "words", "hashes", "codes"])

    return chunks.select("lang", "words", "codes").mapInArrow(compact, _COMPACT)


class Growth:
    """What a chunk needs to find its phrases of ``size`` words: the open words and the phrases of the level below."""

    def __init__(self, size: int, open_words: Broadcast, shorter: Broadcast | None):
        self.size, self.open_words, self.shorter = size, open_words, shorter

    def places(self, hashes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of phrases whose prefix is frequent behind an open first word, or whose suffix is before an open last word; their hashes."""
        last = len(codes) - self.size + 1
        if last <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        usual, fits = codes >= 0, np.ones(last, bool)
        for k in range(self.size):
            fits &= usual[k : k + last]
        is_open = np.append(_test(self.open_words.value)(hashes), False)[codes]
        starts = np.flatnonzero(fits & (is_open[:last] | is_open[self.size - 1 :]))
        if self.shorter is not None:
            within = _test(self.shorter.value)
            opens_first, opens_last = is_open[starts], is_open[starts + self.size - 1]
            opens_first[opens_first] = within(self._hashes(hashes, codes, starts[opens_first], self.size - 1))
            asked = opens_last & ~opens_first
            opens_last[asked] = within(self._hashes(hashes, codes, starts[asked] + 1, self.size - 1))
            starts = starts[opens_first | opens_last]
        return starts, self._hashes(hashes, codes, starts, self.size)

    def _hashes(self, hashes: np.ndarray, codes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        return reduce(_extended, (hashes[codes[starts + k]] for k in range(1, size)), hashes[codes[starts]])


def _of_chunks(chunks: DataFrame, columns: list[str], found: Callable[..., pa.RecordBatch], schema: str) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                hashes = np.frombuffer(batch.column("hashes")[k].as_py(), np.uint64)
                codes = np.frombuffer(batch.column("codes")[k].as_py(), np.int32)
                yield found(hashes, codes, *[batch.column(c)[k] for c in columns])

    return chunks.select("hashes", "codes", *columns).mapInArrow(each, schema)


def grown(chunks: DataFrame, growth: Growth, min_count: int) -> DataFrame:
    """``lang, phrase, h, f`` of the phrases of one length that are found at least ``min_count`` times.

    Counts of hashes, which are never too small, come first. Only phrases whose hash reaches ``min_count`` are then counted
    by their words, so the result does not depend on hashes.
    """
    size = growth.size

    def by_hash(hashes: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        found, counts = np.unique(growth.places(hashes, codes)[1], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], names=["h", "f"])

    hashed = _of_chunks(chunks, [], by_hash, "h long, f long").groupBy("h").agg(F.sum("f").alias("f")).filter(F.col("f") >= min_count)
    likely = _filter(hashed)

    def by_words(hashes: np.ndarray, codes: np.ndarray, lang: pa.Scalar, words: pa.ListScalar) -> pa.RecordBatch:
        starts, grams_hash = growth.places(hashes, codes)
        kept = _test(likely.value)(grams_hash)
        grams = codes[starts[kept][:, None] + np.arange(size)[None, :]]
        number = np.zeros(len(grams), np.int64)  # equal phrases get equal numbers, word by word
        for k in range(size):
            _, number = np.unique(number * len(hashes) + grams[:, k], return_inverse=True)
        _, first, counts = np.unique(number, return_index=True, return_counts=True)
        parts = [words.values.take(pa.array(grams[first, k])) for k in range(size)]
        texts = pc.binary_join_element_wise(*parts, pa.scalar(" "))
        columns = [pa.array([lang.as_py()] * len(texts), pa.string()), texts, pa.array(grams_hash[kept][first].view(np.int64)), pa.array(counts)]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "h", "f"])

    counted = _of_chunks(chunks, ["lang", "words"], by_words, "lang string, phrase string, h long, f long")
    return counted.groupBy("lang", "phrase").agg(F.first("h").alias("h"), F.sum("f").alias("f")).filter(F.col("f") >= min_count)


def _hashed_words(words: DataFrame) -> DataFrame:
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            h = [xxhash.xxh64_intdigest(w.encode(), xxhash.xxh64_intdigest(l.encode())) for l, w in zip(batch["lang"], batch["phrase"], strict=True)]
            yield batch.assign(h=np.array(h, np.uint64).view(np.int64))

    return words.mapInPandas(each, "lang string, phrase string, f long, h long").select("lang", "phrase", "h", "f")


def _limits(words: DataFrame, share: float) -> DataFrame:
    """``lang, largest``: words of at most this count are open. They hold about ``share`` of the occurrences, or are the rarest class."""
    classes = words.groupBy("lang", F.floor(F.log2(F.col("f").cast("double"))).alias("class")).agg(F.max("f").alias("most"), F.sum("f").alias("held"))
    # At most 64 classes a language.
    rising = Window.partitionBy("lang").orderBy("class")
    summed = classes.withColumn("below", F.sum("held").over(rising)).withColumn("all", F.sum("held").over(Window.partitionBy("lang")))
    opened = F.when(F.col("below") <= F.col("all") * share, F.col("most"))
    return summed.groupBy("lang").agg(F.coalesce(F.max(opened), F.min("most")).alias("largest"), F.max("most").alias("most"))


def _part(words: Column, first: Column | int, count: Column) -> Column:
    return F.array_join(F.slice(words, first, count), " ")


def _wide(name: str) -> Column:
    return F.col(name).cast("decimal(18,0)")


def scored(grams: DataFrame, languages: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of all phrases between open words, by their lowest cut, the shortest first part among equals.

    ``grams`` has every part of such a phrase: first parts grow behind its first word, rests before its last one.
    """
    counts = grams.select("lang", "phrase", "f")
    words = F.split("phrase", " ")
    cuts = F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("cut")
    cut = counts.filter(F.contains("phrase", F.lit(" "))).select("lang", "phrase", F.col("f").alias("a"), words.alias("words"), cuts)
    parts = cut.select(
        "lang", "phrase", "a", "cut",
        _part(F.col("words"), 1, F.col("cut")).alias("first"),
        _part(F.col("words"), F.col("cut") + 1, F.size("words") - F.col("cut")).alias("rest"),
        (F.size("words") - 1).alias("cuts"),
    )
    firsts = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    joined = parts.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"]).join(languages, "lang")
    ends_open = ((F.col("cut") > 1) | (F.col("l") <= F.col("largest"))) & ((F.col("cut") < F.col("cuts")) | (F.col("r") <= F.col("largest")))
    # Products need up to 38 digits; decimals hold them exactly.
    exact = joined.withColumn("above", _wide("a") * _wide("n") * F.lit(1000).cast("decimal(4,0)")).withColumn("under", _wide("l") * _wide("r"))
    row = F.struct(F.expr("above div under").alias("score"), "cut", "l", "r")
    best = exact.groupBy("lang", "phrase", "a", "n").agg(F.min(row).alias("best"), F.bool_and(ends_open).alias("open"), F.count("*").alias("found"), F.max("cuts").alias("cuts"))
    whole = best.filter(F.col("open") & (F.col("found") == F.col("cuts")))
    return whole.select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"))


def surviving(phrases: DataFrame, grams: DataFrame, share: int) -> DataFrame:
    """Without phrases inside a longer one that occurs in at least ``share`` percent of their places.

    Any such longer phrase holds one that is longer by one word and occurs at least as often, so these decide.
    """
    words = F.split("phrase", " ")
    shorter = F.explode(F.array(_part(words, 1, F.size(words) - 1), _part(words, 2, F.size(words) - 1))).alias("phrase")
    longer = grams.filter(F.size(words) > 2).select("lang", "f", shorter).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    joined = phrases.join(longer, ["lang", "phrase"], "left")
    return joined.filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share)).drop("longer")


def first_ranks(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of every language with their ``rank``; parts of a language are ranked first, so no task gets all of it."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = phrases.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    return some.drop("salt").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= top)


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    share: int = SHARE,
    text: str = "text",
    lang: str = "lang",
    rounds: tuple[float, ...] = ROUNDS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases of 2 to ``max_words`` words of every language.

    Texts are lower-cased (A to Z), cut into pieces at ``.,;:!?`` and line ends and into words at spaces and tabs.
    A phrase with a count a of at least ``min_count`` scores floor(1000 * a * n / (l * r)) at its worst cut; it is dropped
    inside a longer phrase that fills ``share`` percent of its places. Ties in score fall to the higher count, then to the phrase.

    Best first: a round opens the rarest words, whose phrases have the highest bounds, and grows phrases of one more word
    at a time behind open first words and before open last ones, from frequent prefixes and suffixes only. A language is
    settled once its last rank scores above the bound of all words that are not open yet, so equal scores are all known;
    the others go into the next round, which opens more words, in the end all of them.

    Every count is exact, over all documents. Documents are encoded once, then without rare words; tasks count what they hold before anything is
    shuffled, so repeated rows and common phrases meet as one row a task. Filters have a fixed size and only let too
    much through. Null texts and empty ones have no words, a null language counts as ``und``, repeated rows count again,
    other columns are ignored; without phrases there are no rows.
    """
    chunks = stored(encoded(docs, text, lang), "phrase-chunks")
    totals = stored(chunks.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    pairs = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    counted = pairs.groupBy("lang", F.col("w.words").alias("phrase")).agg(F.sum("w.counts").alias("f")).filter(F.col("f") >= min_count)
    words = stored(_hashed_words(counted), "phrase-words")
    usual = stored(compacted(chunks, _filter(words)), "phrase-places")
    left, results = totals, []
    for number, fraction in enumerate(rounds):
        languages = stored(left.join(_limits(words, fraction), "lang"), f"phrase-limits-{number}")
        own = words.join(languages.select("lang", "largest"), "lang").filter(F.col("f") <= F.col("largest"))
        opened, shorter, levels = _filter(own.select("h")), None, [words]
        for size in range(2, max_words + 1):
            level = stored(grown(usual, Growth(size, opened, shorter), min_count), f"phrases-{number}-{size}")
            levels.append(level)
            if not level.head(1):
                break
            shorter = _filter(level)
        grams = reduce(DataFrame.unionByName, levels)
        kept = surviving(scored(grams, languages), grams, share)
        ranked = stored(first_ranks(kept, top), f"phrase-ranks-{number}")
        last = ranked.groupBy("lang").agg(F.max("rank").alias("ranks"), F.min("score").alias("lowest"))
        bound = F.expr("(cast(n as decimal(18,0)) * 1000) div cast(largest + 1 as decimal(18,0))")
        settled = (F.col("largest") == F.col("most")) | ((F.col("ranks") == top) & (F.col("lowest") > bound))
        state = stored(languages.join(last, "lang", "left").withColumn("settled", F.coalesce(settled, F.lit(False))), f"phrase-state-{number}")
        results.append(ranked.join(state.filter("settled").select("lang"), "lang"))
        left = state.filter(~F.col("settled")).select("lang", "n")
        if not left.head(1):
            break
    return reduce(DataFrame.unionByName, results).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
