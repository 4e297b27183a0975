"""One query per operator, over its whole tables, in the form its contract asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm import collocations, fingerprints, jaccard, mixing, negatives, packing, private, rules, sketches, substring, toxicity, unigram, urls
from trackloom.session import ship_package

QUERIES: dict = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(query):
        QUERIES[name] = query
        if sql:
            SQL[name] = sql
        return query

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(n: int):
    """The remainder that tells held-out documents from those to learn from."""
    return F.crc32(F.col("doc_id").cast("string")) % n


@register("op1_substring_dedup", """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), p AS (
  SELECT doc_id, words, len(words) AS n, unnest(range(1, len(words) - 18)) AS i FROM w WHERE len(words) >= 20
), g AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY md5(array_to_string(words[i:i+19], ' ')) ORDER BY doc_id, i) AS r FROM p
), c AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM g WHERE r > 1
), f AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM w
), k AS (
  SELECT f.doc_id, string_agg(f.word, ' ' ORDER BY f.j) AS kept, count(*) AS n_kept
  FROM f LEFT JOIN c ON f.doc_id = c.doc_id AND f.j = c.j WHERE c.j IS NULL GROUP BY f.doc_id
), s AS (
  SELECT doc_id, string_agg(e, ',' ORDER BY a) AS removed_spans FROM (
    SELECT doc_id, min(j) - 1 AS a, (min(j) - 1)::VARCHAR || '-' || max(j)::VARCHAR AS e FROM (
      SELECT doc_id, j, j - row_number() OVER (PARTITION BY doc_id ORDER BY j) AS island FROM c
    ) GROUP BY doc_id, island
  ) GROUP BY doc_id
)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, (len(w.words) - coalesce(k.n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256, coalesce(s.removed_spans, '') AS removed_spans
FROM w LEFT JOIN k ON w.doc_id = k.doc_id LEFT JOIN s ON w.doc_id = s.doc_id
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_digests(table(spark, sf_dir, "documents"))


def byte_bpe() -> tuple:
    """The vocabulary of byte_bpe_50k.json, as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, {"<|endoftext|>": 50256}


@register("op2_best_fit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), byte_bpe())


@register("op3_context_mixing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.lm_scores(table(spark, sf_dir, "documents"), fold(7) == 2)


@register("op4_weighted_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_pairs(table(spark, sf_dir, "documents"))


@register("op5_private_data")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.private_spans(table(spark, sf_dir, "documents"))


@register("op6_unigram_pieces")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return unigram.round_trips(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op7_jaccard_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@register("op8_url_filter", """
WITH u AS (
  SELECT page_id, url,
         CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN contains(url, '://') THEN regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') ELSE '' END AS path,
         list_sort(list_filter(string_split(regexp_extract(url, '^.*?://[^?#]*\\?([^#]*)', 1, 's'), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]*|ref)='))) AS kept
  FROM pages
), c AS (
  SELECT page_id, host, path,
         CASE WHEN contains(url, '://') THEN regexp_replace(host, '^www\\.', '')
           || regexp_replace(regexp_replace(path, '/+$', ''), '\\.html?$', '')
           || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical
  FROM u
), l AS (
  SELECT canonical FROM c WHERE canonical IS NOT NULL GROUP BY canonical HAVING count(*) > 1
), r AS (
  SELECT c.*, l.canonical IS NOT NULL AS listed,
         CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/de/8') THEN 'example.net/de/8'
              WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/7') THEN 'example.com/en/7'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/en/') THEN 'com/en/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/de/') THEN 'net/de/'
              WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/es/') THEN 'org/es/' END AS rule
  FROM c LEFT JOIN l ON c.canonical = l.canonical
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/en/', 'example.net/de/8', 'org/es/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict, canonical
FROM r
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, urls.repeated_addresses(pages))


@register("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold(4) == 2)


@register("op10_quality_rules", """
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), p AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3
), g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i+1], words[i+2]) AS n FROM p
), r AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 3)) AS j FROM g WHERE n > 1) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         (length(t) - len(regexp_extract_all(t, '[\\x20\\x09-\\x0D]')))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         len(regexp_extract_all(t, '[!?]{2,}'))::BIGINT AS n_marks,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(r.n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN r ON w.doc_id = r.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 40 * n_words OR 100 * n_marks > 40 * n_words
            OR 100 * n_dup_lines > 50 * n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM m
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


@register("op11_hard_negatives", """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


@register("op12_collocations", """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM d
), t AS (
  SELECT lang, piece, unnest(words) AS word, unnest(range(len(words))) AS i FROM w
), e AS (
  SELECT lang, word AS w1, lead(word) OVER p AS w2, lead(word, 2) OVER p AS w3, lead(word, 3) OVER p AS w4
  FROM t WINDOW p AS (PARTITION BY piece ORDER BY i)
), g AS (
  SELECT lang, 1 AS k, w1 AS phrase, count(*) AS f FROM e GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 AS phrase, count(*) FROM e WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 AS phrase, count(*) FROM e WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 AS phrase, count(*) FROM e WHERE w4 IS NOT NULL GROUP BY ALL
), n AS (
  SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY lang
), c AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM g WHERE k > 1 AND f >= 30
), b AS (
  SELECT lang, array_to_string(words[s : s + m - 1], ' ') AS phrase, max(a) AS longest
  FROM c, (VALUES (2), (3)) t(m), (VALUES (1), (2), (3)) u(s) WHERE m < k AND s + m - 1 <= k GROUP BY ALL
), x AS (
  SELECT c.lang, c.phrase, c.a, j, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a) // (l.f::HUGEINT + r.f) AS score
  FROM c JOIN (VALUES (1), (2), (3)) t(j) ON j < k
  JOIN g l ON l.lang = c.lang AND l.k = j AND l.phrase = array_to_string(c.words[1 : j], ' ')
  JOIN g r ON r.lang = c.lang AND r.k = c.k - j AND r.phrase = array_to_string(c.words[j + 1 : ], ' ')
  LEFT JOIN b ON b.lang = c.lang AND b.phrase = c.phrase
  WHERE b.longest IS NULL OR 100 * b.longest < 80 * c.a
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, j) = 1
)
SELECT x.lang, row_number() OVER (PARTITION BY x.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM x JOIN n ON x.lang = n.lang QUALIFY rank <= 2000
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@register("op13_odd_sketches")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.near_duplicates(table(spark, sf_dir, "documents"))
