"""Secret scan: candidates in text and a random forest that removes false positives."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import small_side, stored, text_or_empty

#: A candidate is a run of these characters, this long at least, in a word that has a digit or assigns something.
RUN = r"[A-Za-z0-9+/_.\-]{12,}={0,2}"
WHITE = r"[\x20\x09-\x0D]+"
NEIGHBOURS = 3
#: A run of letters in a candidate is a dictionary word when so many documents hold it as a word.
DICTIONARY_DOCUMENTS = 5
LETTERS = r"[a-z]{3,}"
#: Labelled findings that training reads at most, the first in the order of a hash.
TRAINING_FINDINGS = 20_000
TREES, DEPTH, SEED = 24, 6, 11
THRESHOLD = 0.5

# Published formats of keys and tokens.
KNOWN_FORMATS = (
    ("aws-access-key", r"^(?:AKIA|ASIA)[0-9A-Z]{16}$"),
    ("github-token", r"^gh[pousr]_[0-9A-Za-z]{36,}$"),
    ("gitlab-token", r"^glpat-[0-9A-Za-z_\-]{20,}$"),
    ("slack-token", r"^xox[abprs]-[0-9A-Za-z\-]{10,}$"),
    ("google-api-key", r"^AIza[0-9A-Za-z_\-]{35}$"),
    ("stripe-key", r"^[sr]k_(?:live|test)_[0-9A-Za-z]{16,}$"),
    ("json-web-token", r"^eyJ[0-9A-Za-z_\-]+\.[0-9A-Za-z_\-]+\.[0-9A-Za-z_\-]+$"),
)
SECRET_WORDS = r"(?i)(?:pass(?:word|wd|phrase)?|pwd|secret|token|api_?key|access_?key|auth|credential|private)"
PLACEHOLDERS = r"(?i)(?:example|sample|dummy|placeholder|changeme|your[_-]|xxxx|1234567|abcdef)"
TEST_PATHS = r"(?i)(?:test|example|sample|fixture|mock|spec)"
NUMBERS = r"^[0-9.+/_\-]+$"
UUID = r"(?i)^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$"

FEATURES = (
    "length",
    "transitions",
    "bigram_score",
    "coverage",
    "digits",
    "capitals",
    "distinct",
    "hex_only",
    "slashes",
    "dots",
    "after_at",
    "after_link",
    "assigned",
    "quoted",
    "secret_word",
    "placeholder",
    "test_path",
)


def _candidates(docs: DataFrame, doc_id: str, text: str, path: str | None) -> DataFrame:
    """``doc_id, path, position, value, lead, near``: a row for each candidate; the position counts words from 0.

    ``lead`` is the word up to the value with the two before it, ``near`` the words around.
    """
    words = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.col(path).cast("string") if path else F.lit(None).cast("string")).alias("path"),
        F.split(text_or_empty(text), WHITE).alias("words"),
    )

    def likely(i: Column) -> Column:
        word = F.get("words", i)
        return (F.length(word) >= 12) & (word.rlike("[0-9]") | word.rlike("[=:]")) & word.rlike(RUN)

    def described(i: Column) -> Column:
        word, low = F.get("words", i), F.greatest(i - NEIGHBOURS, F.lit(0))
        near = F.array_join(F.slice("words", low + 1, NEIGHBOURS * 2 + 1), " ")
        before = F.array_join(F.slice("words", F.greatest(i - 1, F.lit(1)), F.least(i, F.lit(2))), " ")
        each = F.regexp_extract_all(word, F.lit(RUN), F.lit(0))
        return F.transform(
            each,
            lambda value: F.struct(
                i.alias("position"),
                value.alias("value"),
                F.concat_ws(" ", F.when(i > 0, before), F.left(word, F.position(value, word) - 1)).alias("lead"),
                near.alias("near"),
            ),
        )

    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), likely)
    found = F.flatten(F.transform(places, described))
    rows = words.select("doc_id", "path", F.explode_outer(found).alias("c")).select("doc_id", "path", "c.*")
    return rows.filter("value IS NOT NULL")


def _dictionary(docs: DataFrame, text: str, runs: DataFrame) -> DataFrame:
    """Those of the letter runs that enough documents hold as a word of their own."""
    words = docs.select(F.array_distinct(F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(r"(?<![a-z0-9])[a-z]{3,}(?![a-z0-9])"), F.lit(0))).alias("words"))
    held = words.select(F.explode_outer("words").alias("run")).join(small_side(runs), "run")
    return held.groupBy("run").count().filter(F.col("count") >= DICTIONARY_DOCUMENTS).select("run")


def _bigrams(words: DataFrame) -> Column:
    """Logarithms of character transitions in dictionary words: a literal map of at most 26 * 26 entries."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("run") - 1), lambda i: F.substr("run", i, F.lit(2)))
    counts = words.select(F.explode_outer(pairs).alias("pair")).groupBy("pair").count()
    rows = counts.filter("pair IS NOT NULL").collect()
    first: dict[str, int] = {}
    for row in rows:
        first[row["pair"][0]] = first.get(row["pair"][0], 0) + row["count"]
    table = {row["pair"]: round(math.log(row["count"] / first[row["pair"][0]]), 4) for row in rows}
    return F.from_json(F.lit(json.dumps(table)), "map<string,double>")


UNSEEN_TRANSITION = -7.0


def findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Candidates with the features of ``FEATURES``.

    The dictionary is what all documents of the corpus hold; it is only looked up for the letter runs of candidates,
    each distinct value once.
    """
    rows = stored(_candidates(docs, doc_id, text, path), "candidates")
    values = rows.select("value").distinct()
    runs_of = F.regexp_extract_all(F.lower("value"), F.lit(LETTERS), F.lit(0))
    runs = stored(values.select("value", F.explode_outer(runs_of).alias("run")), "runs")
    known = stored(_dictionary(docs, text, runs.select("run").filter("run IS NOT NULL").distinct()), "dictionary")
    covered = runs.join(known.withColumn("known", F.lit(1)), "run", "left").groupBy("value").agg(
        (F.sum(F.when(F.col("known") == 1, F.length("run")).otherwise(0)) / F.max(F.length("value"))).alias("coverage")
    )
    covered = stored(covered, "coverage")
    value, lower = F.col("value"), F.lower("value")
    length = F.length(value)
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[^A-Za-z0-9]", "-"), "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    table = _bigrams(known)
    pairs = F.transform(F.sequence(F.lit(1), length - 1), lambda i: F.substr(lower, i, F.lit(2)))
    logs = F.transform(pairs, lambda pair: F.coalesce(F.element_at(table, pair), F.lit(UNSEEN_TRANSITION)))

    def share(pattern: str) -> Column:
        return (length - F.length(F.regexp_replace(value, pattern, ""))) / length

    def mark(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("double")

    lead, near = F.col("lead"), F.col("near")
    return rows.join(covered, "value").select(
        "doc_id",
        "position",
        "value",
        "lead",
        "near",
        length.cast("double").alias("length"),
        ((F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1) / length).alias("transitions"),
        (F.aggregate(logs, F.lit(0.0), lambda total, log: total + log) / F.size(logs)).alias("bigram_score"),
        "coverage",
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("capitals"),
        (F.size(F.array_distinct(F.split(value, ""))) / length).alias("distinct"),
        mark(value.rlike("^[0-9a-fA-F]+$")).alias("hex_only"),
        (length - F.length(F.replace(value, F.lit("/"), F.lit("")))).cast("double").alias("slashes"),
        (length - F.length(F.replace(value, F.lit("."), F.lit("")))).cast("double").alias("dots"),
        mark(lead.rlike("@$")).alias("after_at"),
        mark(lead.rlike("://[^ ]*$")).alias("after_link"),
        mark(lead.rlike(r"[=:]\s*[\"']?$")).alias("assigned"),
        mark(lead.rlike(r"[\"']$")).alias("quoted"),
        mark(near.rlike(SECRET_WORDS)).alias("secret_word"),
        mark(near.rlike(PLACEHOLDERS)).alias("placeholder"),
        mark(F.col("path").rlike(TEST_PATHS)).alias("test_path"),
    )


def known_format() -> Column:
    """Name of the published format that a value has, else null."""
    return F.coalesce(*[F.when(F.col("value").rlike(pattern), F.lit(name)) for name, pattern in KNOWN_FORMATS], F.lit(None).cast("string"))


def rule_label() -> Column:
    """A label where it is certain: 1 for known formats and for random values assigned to a secret word, 0 for parts of
    addresses and links, placeholders, UUIDs, numbers and values made of words; null where nothing is certain."""
    random = (F.col("coverage") == 0) & (F.col("digits") >= 0.15) & (F.col("slashes") == 0) & (F.col("dots") == 0)
    named = F.col("lead").rlike(SECRET_WORDS) & (F.col("assigned") == 1)
    harmless = (F.col("after_at") == 1) | (F.col("after_link") == 1) | (F.col("placeholder") == 1) | (F.col("coverage") >= 0.5)
    return (
        F.when(harmless | F.col("value").rlike(UUID) | F.col("value").rlike(NUMBERS), F.lit(0.0))
        .when(known_format().isNotNull() | (named & random), F.lit(1.0))
        .otherwise(F.lit(None).cast("double"))
    )


@dataclass(frozen=True)
class SecretFilter:
    """A forest, or a constant score where the labels had one kind only."""

    forest: RandomForestClassificationModel | None
    constant: float

    def score(self, rows: DataFrame) -> DataFrame:
        if self.forest is None:
            return rows.withColumn("score", F.lit(self.constant))
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(rows)
        scored = self.forest.transform(vectors)
        return scored.withColumn("score", vector_to_array("_probability").getItem(1)).drop("_features", "_raw", "_probability", "_class")


def train(labelled: DataFrame, rows: int = TRAINING_FINDINGS) -> SecretFilter:
    """A random forest from findings with a ``label`` of 0 or 1; rows without one are not used.

    At most ``rows`` findings are read. With labels of one kind, or none, the score is that label, or 0.
    """
    chosen = labelled.filter("label IS NOT NULL").orderBy(F.xxhash64("doc_id", "position", "value"), "value", "doc_id", "position").limit(rows)
    chosen = stored(chosen.select("label", *FEATURES), "findings")
    n, positive = chosen.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).head()
    if not 0 < positive < n:
        return SecretFilter(None, 1.0 if n and positive else 0.0)
    weighted = chosen.withColumn("weight", F.when(F.col("label") == 1, F.lit(n / (2 * positive))).otherwise(F.lit(n / (2 * (n - positive)))))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(weighted)
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="label", weightCol="weight", probabilityCol="_probability", rawPredictionCol="_raw",
        predictionCol="_class", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
    )
    return SecretFilter(forest.fit(vectors), 0.0)


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, labelled: DataFrame | None = None) -> DataFrame:
    """All candidates: ``doc_id, position, value, format, score, is_secret`` and their features.

    The forest learns from ``labelled`` findings (the columns of ``findings`` with a ``label``), by default from those
    among the candidates that rules label with certainty, and decides about every candidate, so that what only looks
    like a secret is marked as no secret.

    Null and empty texts have no candidates; repeated rows give repeated candidates; a null id is kept; an empty table
    gives no rows; extra columns are ignored.
    """
    rows = stored(findings(docs, doc_id, text, path), "features")
    model = train(rows.withColumn("label", rule_label()) if labelled is None else labelled)
    scored = model.score(rows).withColumn("format", known_format())
    return scored.withColumn("is_secret", F.col("score") >= THRESHOLD)
