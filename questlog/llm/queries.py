"""Named queries over the sample tables, one for each operator of this folder."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from questlog.llm import (
    codec,
    conversation_trie,
    filter_audit,
    fingerprints,
    lines,
    packing,
    phrases,
    simhash,
    substrings,
    token_counts,
    topk,
    toxicity,
    url_filters,
)

# Rules of the URL query, host and path.
SITE_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
# Words that block a URL to which no site rule applies.
BLOCKED_WORDS = ["ads", "banner", "casino", "gambling", "porn", "torrent", "viagra", "xxx"]
TOKEN_LIMIT = 1024
SEQUENCE_TOKENS = 2048


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select("doc_id", "fingerprint", "component_id")


def op2_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = phrases.remove_repeats(_table(spark, sf_dir, "documents"), window=35)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op4_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digests(ids, joined, decoded):
        return hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()

    return codec.encode(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        finish=digests,
        finished="ids_sha256 string, decoded_sha256 string",
    )


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_filters.site_rule(*r) for r in SITE_RULES] + [url_filters.word_rule("block", w) for w in BLOCKED_WORDS]
    judged = url_filters.url_verdicts(_table(spark, sf_dir, "pages"), rules, default="allow")
    rule = F.when(F.col("field") == "site", F.col("matched"))
    return judged.select("page_id", "host", "path", rule.alias("rule"), "verdict")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = docs.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), toxicity.toxicity_score(model, F.col("text")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), SEQUENCE_TOKENS)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(_table(spark, sf_dir, "documents"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(_table(spark, sf_dir, "documents"), window=400)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.interactions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(conversation_trie.rebuilt_paths(_table(spark, sf_dir, "conversations")))


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.drop_frequent_lines(_table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_phrases": op2_phrases,
    "op3_token_counts": op3_token_counts,
    "op4_codec": op4_codec,
    "op5_url_filters": op5_url_filters,
    "op6_toxicity": op6_toxicity,
    "op7_topk": op7_topk,
    "op8_packing": op8_packing,
    "op9_fingerprints": op9_fingerprints,
    "op10_substrings": op10_substrings,
    "op11_filter_audit": op11_filter_audit,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_lines": op13_lines,
}

_LOWER_AZ = f"translate({{}}, '{url_filters.UPPER}', '{url_filters.LOWER}')"
_HOST = _LOWER_AZ.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")

# The other queries hash, learn, link over chains or pack, which DuckDB's SQL cannot
# express, or (op10, windows of bytes) not within a machine's memory; tests/llm holds
# them against brute-force versions.
ORACLE_SQL = {
    "op2_phrases": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
starts AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM words)
),
again AS (SELECT doc_id, s FROM starts QUALIFY count(*) OVER (PARTITION BY h) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(s, s + 35)) AS p FROM again)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words) ANTI JOIN gone USING (doc_id, p)
  GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, ifnull(n, 0) AS n_removed, sha256(ifnull(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id)""",
    "op5_url_filters": f"""
WITH cut AS (
  SELECT page_id, {_LOWER_AZ.format("coalesce(url, '')")} AS lowered, {_HOST} AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
fits AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
  END AS rule
  FROM cut
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN regexp_matches(lowered, '(^|[^a-z0-9])({"|".join(BLOCKED_WORDS)})([^a-z0-9]|$)') THEN 'block'
  ELSE 'allow' END AS verdict
FROM fits""",
    "op7_topk": """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5""",
    "op11_filter_audit": r"""
WITH flagged AS (
  SELECT doc_id, ifnull(lang, '') AS part, ifnull(text, '') AS t,
    regexp_extract_all(ifnull(text, ''), '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY ifnull(text, '')) AS least
  FROM documents
),
masks AS (
  SELECT doc_id, part,
    (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
      + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
      + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * ifnull(doc_id > least, false)::INT AS mask
  FROM flagged
),
named AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, mask, count(*) AS docs, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM masks LEFT JOIN named USING (doc_id) GROUP BY part, mask
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, ifnull(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
),
per_step AS (
  SELECT part, filter_order, step, bit,
    sum(docs) FILTER (mask & (before | bit) = 0) AS kept,
    sum(docs) FILTER (mask & bit <> 0 AND mask & before = 0) AS removed,
    sum(docs) FILTER (mask & bit <> 0 AND mask & before <> 0) AS redundant,
    sum(docs) FILTER (mask = bit) AS unique_fails,
    sum(good) FILTER (mask & bit <> 0 AND mask & before = 0) AS good_lost,
    sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, ifnull(kept, 0)::BIGINT AS kept, ifnull(removed, 0)::BIGINT AS removed,
  ifnull(redundant, 0)::BIGINT AS redundant, ifnull(unique_fails, 0)::BIGINT AS unique_fails,
  ifnull(good_lost, 0)::BIGINT AS good_lost, ifnull(toxic_lost, 0)::BIGINT AS toxic_lost,
  (sum(ifnull(removed, 0)) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM per_step""",
    "op12_conversation_trie": """
WITH turns AS (
  SELECT conv_id, ifnull(role, '') AS role, ifnull(text, '') AS text, sha256(concat(length(ifnull(role, '')), ':', role, text)) AS digest, turn
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
  SELECT conv_id, list({d: digest, n: length(text)} ORDER BY turn NULLS FIRST, digest) AS seq FROM turns GROUP BY conv_id
),
shared AS (
  SELECT *, (xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384))
    ), 4294967295) % 6)::BIGINT AS h
  FROM own
),
whole AS (
  SELECT c.conv_id, list_concat(ifnull(b.seq[1:c.h], []), c.seq[c.h + 1:]) AS seq
  FROM shared c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
),
prefixes AS (
  SELECT conv_id, d, array_to_string(list_transform(seq[1:d], lambda t: t.d), '') AS path, seq[d].n AS chars, len(seq) = d AS ends
  FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM whole)
),
nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(ifnull(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY path, d
),
below AS (
  SELECT n.*, p.conv_id AS parent_conv_id, count(c.path) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.path = n.path[:64 * (n.d - 1)] AND p.d = n.d - 1
  LEFT JOIN nodes c ON c.d = n.d + 1 AND c.path[:64 * n.d] = n.path
  GROUP BY ALL
),
sums AS (
  SELECT path[:64 * up] AS top, up, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * ifnull(chars, 0)) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM below) GROUP BY ALL
)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved::BIGINT AS saved_tokens, ends_sha256
FROM below JOIN sums ON top = path AND up = d""",
    "op13_lines": r"""
WITH split AS (SELECT doc_id, string_split(ifnull(text, ''), chr(10)) AS lines FROM documents),
keyed AS (
  SELECT doc_id, p, line,
    translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS p FROM split)
),
frequent AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.k) AS n_dropped, sha256(ifnull(string_agg(line, chr(10) ORDER BY p) FILTER (f.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f ON f.k = keyed.k GROUP BY doc_id""",
}
