"""The registered queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import quality
from martloom.llm.common import documents
from martloom.llm.decontaminate import contained_items
from martloom.llm.exact_dedup import exact_duplicates
from martloom.llm.language_model import score_documents
from martloom.llm.licenses import license_scan
from martloom.llm.packing import pack
from martloom.llm.personal import ACCOUNT, listed, personal_data
from martloom.llm.phrases import collocations
from martloom.llm.secrets import scan_secrets
from martloom.llm.sharding import shard
from martloom.llm.simhash import exact_scheme, near_duplicates
from martloom.llm.substrings import remove_repeats
from martloom.llm.vector_codes import compress

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def register(function):
        QUERIES[name] = function
        return function

    return register


@query("op1_decontaminate")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE["op1_decontaminate"] = r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}]+') FROM benchmark
), places AS (
  SELECT kind, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM texts WHERE len(w) > 0
), shingles AS (
  SELECT DISTINCT kind, id, array_to_string(w[i:i + 4], ' ') AS s FROM places
), items AS (
  SELECT id AS item_id, s, count(*) OVER (PARTITION BY id) AS n_item FROM shingles WHERE kind = 'i'
)
SELECT d.id AS doc_id, item_id, count(*) AS n_shared, n_item, count(*) / n_item AS containment
FROM shingles d JOIN items USING (s) WHERE d.kind = 'd'
GROUP BY d.id, item_id, n_item HAVING count(*) * 5 >= n_item * 4
"""


@query("op2_harmonic_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query("op3_secret_forest")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir), path="source")
    return found.select(
        "doc_id",
        F.col("position").cast("bigint").alias("position"),
        F.sha2("value", 256).alias("value_sha256"),
        F.col("length").cast("bigint").alias("length"),
        "format",
        F.round("coverage", 6).alias("coverage"),
        F.round("score", 6).alias("score"),
        "is_secret",
    )


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(documents(spark, sf_dir), exact_scheme())
    return rows.select("doc_id", F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), "component_id")


@query("op5_stupid_backoff")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score_documents(documents(spark, sf_dir))
    return rows.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


ORACLE["op5_stupid_backoff"] = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM texts
), grams AS (
  SELECT doc_id, w[i] AS w1, CASE WHEN i > 1 THEN w[i - 1] END AS w0 FROM places
), ones AS (
  SELECT w1 AS word, count(*) AS c, sum(count(*)) OVER () AS n FROM grams GROUP BY w1
), twos AS (
  SELECT w0, w1, count(*) AS c FROM grams WHERE w0 IS NOT NULL GROUP BY w0, w1
), scored AS (
  SELECT g.doc_id,
         CASE WHEN g.w0 IS NULL THEN ln(a.c / a.n)
              WHEN t.c >= 2 THEN ln(t.c / b.c)
              ELSE ln(0.4 * a.c / a.n) END AS s
  FROM grams g JOIN ones a ON a.word = g.w1
  LEFT JOIN ones b ON b.word = g.w0
  LEFT JOIN twos t ON t.w0 = g.w0 AND t.w1 = g.w1
)
SELECT d.doc_id, len(d.w) AS n_words, round(coalesce(s.total, 0), 4) AS log_score,
       round(CASE WHEN len(d.w) > 0 THEN s.total / len(d.w) END, 6) AS mean_log_score
FROM texts d LEFT JOIN (SELECT doc_id, sum(s) AS total FROM scored GROUP BY doc_id) s USING (doc_id)
"""


@query("op6_feistel_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(documents(spark, sf_dir), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op7_exact_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_duplicates(documents(spark, sf_dir))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE["op7_exact_dedup"] = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept,
       text_sha256
FROM rows
WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""


@query("op8_quality_ftrl")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = quality.train(docs, labels.filter(~quality.held_out()), "quality")
    scored = quality.score(docs.select("doc_id", "text"), weights)
    return scored.select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op9_suffix_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


@query("op10_license_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir)).drop("detections")


@query("op11_personal_data")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(documents(spark, sf_dir))
    kinds = ("email", "ip", "card", "phone")

    def of(*names: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*names))

    counts = [F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in kinds]
    base = of(*kinds)
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


ORACLE["op11_personal_data"] = r"""
WITH kinds(kind_no, kind, pattern, raised) AS (VALUES
  (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+', ''),
  (1, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)', ''),
  (2, 'card', '[0-9]([\x20-]?[0-9])+', ''),
  (3, 'phone', '\+[0-9][\x20().0-9-]+[0-9]', ''),
  (4, 'iban', @ACCOUNT@, 'iban|account|bank|konto|compte|cuenta'),
  (5, 'nir', '[12] ?[0-9]{2} ?[0-9]{2} ?(?:[0-9]{2}|2[AB]) ?[0-9]{3} ?[0-9]{3} ?[0-9]{2}', 'nir|insee|secu|securite|social|assure'),
  (6, 'dni', '[0-9]{8}-?[A-Z]', 'dni|nif|documento|identidad'),
  (7, 'ssn', '[0-9]{3}-[0-9]{2}-[0-9]{4}', 'ssn|social|security')
), found AS MATERIALIZED (
  SELECT doc_id, n_row, kind_no, kind, raised, regexp_extract_all(t, pattern) AS hits, string_split_regex(t, pattern) AS gaps
  FROM (SELECT doc_id, row_number() OVER () AS n_row, coalesce(text, '') AS t FROM documents), kinds
), places AS (
  SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM found
), proposed AS (
  SELECT doc_id, n_row, kind_no, kind, hits[i] AS hit, regexp_replace(hits[i], '[^0-9A-Z]', '', 'g') AS plain,
         list_sum(list_transform(gaps[:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda h: length(h))), 0) AS start,
         translate(right(gaps[i], 40), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS before,
         translate(left(gaps[i + 1], 20), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS after, raised
  FROM places
), judged AS (
  SELECT *,
         regexp_matches(before, '(?:^|[^a-z])(?:' || raised || ')(?:[^a-z]|$)') OR regexp_matches(after, '(?:^|[^a-z])(?:' || raised || ')(?:[^a-z]|$)') AS is_raised,
         regexp_matches(before, '(?:^|[^a-z])(?:order|invoice|isbn|tracking)(?:[^a-z]|$)') OR regexp_matches(after, '(?:^|[^a-z])(?:order|invoice|isbn|tracking)(?:[^a-z]|$)') AS is_number,
         regexp_matches(before, '(?:^|[^a-z])(?:order|invoice|part)(?:[^a-z]|$)') OR regexp_matches(after, '(?:^|[^a-z])(?:order|invoice|part)(?:[^a-z]|$)') AS is_part,
         regexp_matches(before, '[A-Za-z0-9]$') OR regexp_matches(after, '^[A-Za-z0-9]') AS touched
  FROM proposed
), spans AS (
  SELECT doc_id, n_row, kind_no, kind, start::BIGINT AS start, (start + length(hit))::BIGINT AS stop FROM judged WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(hit, '.'), lambda p: length(ltrim(p, '0')) > 3 OR right('000' || ltrim(p, '0'), 3) > '255')) = 0
    WHEN 'card' THEN length(plain) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(plain) + 1), lambda k:
      CASE WHEN (length(plain) - k) % 2 = 0 THEN plain[k]::INT WHEN plain[k] > '4' THEN plain[k]::INT * 2 - 9 ELSE plain[k]::INT * 2 END)) % 10 = 0
    WHEN 'phone' THEN length(plain) BETWEEN 9 AND 15
    WHEN 'iban' THEN NOT touched AND list_reduce(list_prepend(0, list_transform(string_split(plain[5:] || plain[:4], ''), lambda c:
      CASE WHEN c <= '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)), lambda rest, v: (rest * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1
    WHEN 'nir' THEN NOT touched AND (is_raised OR NOT is_number)
      AND 97 - replace(replace(plain, '2A', '19'), '2B', '18')[:13]::BIGINT % 97 = right(plain, 2)::BIGINT
    WHEN 'dni' THEN NOT touched AND is_raised AND substr('TRWAGMYFPDXBNJZSQVHLCKE', plain[:8]::INT % 23 + 1, 1) = plain[9]
    ELSE NOT touched AND is_raised AND NOT is_part AND NOT regexp_matches(hit, '^(?:000|666|9)|-00-|0000$') END
), joined AS (
  SELECT n_row, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_no) FILTER (kind_no < 4) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_no) AS spans
  FROM spans GROUP BY n_row
)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM (SELECT DISTINCT doc_id, n_row FROM found) d LEFT JOIN joined USING (n_row)
""".replace("@ACCOUNT@", f"'{ACCOUNT}'")


@query("op12_phrase_collocations")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


ORACLE["op12_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents)
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), grams AS MATERIALIZED (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 6) r(k))
  GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM grams WHERE k > 1
), scores AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.cut, l.f AS l, r.f AS r, n, (1000::HUGEINT * c.a * n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(w[:cut], ' ')
  JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')
), best AS (
  SELECT lang, phrase, k, a, n, arg_min(l, score * 10 + cut) AS l, arg_min(r, score * 10 + cut) AS r, min(score) AS score
  FROM scores GROUP BY lang, phrase, k, a, n
), kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM grams g WHERE g.lang = b.lang AND g.k > b.k AND 100 * g.f >= 100 * b.a AND contains(' ' || g.phrase || ' ', ' ' || b.phrase || ' '))
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""


@query("op13_vector_codes")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _assignment(books: str) -> str:
    """SQL: the nearest entry of every part, the lowest number among equally near ones."""
    return f"""
  SELECT v, part, min_by(entry, d * 1024 + entry) AS entry, min(d) AS d FROM (
    SELECT p.v, p.part, b.entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts p JOIN {books} b USING (part)
  ) GROUP BY v, part"""


def _means(books: str, assigned: str) -> str:
    return f"""
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM {books} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY k) AS x FROM (
      SELECT part, entry, k, floor(sum(c) / count(*))::BIGINT AS mean
      FROM (SELECT p.part, a.entry, unnest(range(1, len(p.x) + 1)) AS k, unnest(p.x) AS c FROM parts p JOIN {assigned} a USING (v, part))
      GROUP BY part, entry, k
    ) GROUP BY part, entry
  ) m USING (part, entry)"""


ORACLE["op13_vector_codes"] = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS v, vec_id, label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT v, part, x[part * len(x) // 16 + 1 : (part + 1) * len(x) // 16] AS x FROM kept, range(16) r(part)
), books0 AS MATERIALIZED (SELECT part, v - 1 AS entry, x FROM parts WHERE v <= 64
), assigned0 AS MATERIALIZED ({_assignment("books0")}
), books1 AS MATERIALIZED ({_means("books0", "assigned0")}
), assigned1 AS MATERIALIZED ({_assignment("books1")}
), books2 AS MATERIALIZED ({_means("books1", "assigned1")}
), assigned2 AS MATERIALIZED ({_assignment("books2")}
), coded AS (
  SELECT v, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM assigned2 GROUP BY v
), digest AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books2
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (v), digest
"""
