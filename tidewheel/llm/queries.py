"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewheel.plans.storage import shared_path

from . import chunk_bpe, decontaminate, fingerprints, near_dups, preferences, quality, secrets, token_counts, token_files, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document; null text counts as empty, null ids and repeated rows come back as they are, no rows give none."""
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op2_simhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; nulls, ties, repeats and empty tables as in ``near_dups.near_duplicates``."""
    return near_dups.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and decoded text; null text counts as empty, null ids and repeated rows come back as they are, no rows give none."""
    return chunk_bpe.round_trip(_table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files in the shared folder, read back; a null id fails, rows of one id stand by a hash of their text, no rows give none."""
    out = shared_path(spark, "tokens")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), out)
    return token_files.read_tokens(spark, out)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, from an empty ledger; null text has none, null ids and repeated rows come back as they are, no rows give none."""
    return secrets.findings(secrets.scan_versions(_table(spark, sf_dir, "documents")))


def op6_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a pair of conversations; null ids and turns are left out, repeated rows count once, no rows give none."""
    return preferences.preference_format(*preferences.swapped_replies(_table(spark, sf_dir, "conversations")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; null text counts as empty, null ids are scored, without labels of both kinds all scores are alike, no rows give none."""
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items in them; null texts contain nothing, repeated rows repeat, an empty table gives none."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; null text counts as empty, null ids are scored, without labels of both kinds every score is 1, no rows give none."""
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text; null text counts as empty, a repeated id and text is one document, no rows give none."""
    return fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_simhash_near_dups, op3_bpe_round_trip, op4_token_files, op5_secret_scan, op6_preference_format, op7_toxicity, op8_decontamination, op9_quality, op10_fingerprints)}

_ASSIGN = "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"''']?\\x20*[:=]\\x20*[\"''']?([A-Za-z0-9+/_.=-]+)".replace("'''", "''")

ORACLE = {
    "op5_secret_scan": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT r, 0 AS no, 'assign' AS kind, regexp_extract_all(t, '{_ASSIGN}') AS hits, regexp_split_to_array(t, '{_ASSIGN}') AS gaps FROM d
  UNION ALL SELECT r, 1, 'access', regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_split_to_array(t, 'AKIA[A-Z0-9]+') FROM d
  UNION ALL SELECT r, 2, 'hex', regexp_extract_all(t, '[0-9a-f]{{24,}}'), regexp_split_to_array(t, '[0-9a-f]{{24,}}') FROM d),
u AS (SELECT r, no, kind, hits, gaps, unnest(range(1, len(hits) + 1)) AS i FROM m WHERE len(hits) > 0),
s AS (SELECT r, no, kind, hits[i] AS hit,
  coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + CASE WHEN i > 1 THEN list_sum(list_transform(hits[1:i-1], lambda x: length(x))) ELSE 0 END AS a FROM u),
k AS (SELECT r, no, kind, a::BIGINT AS a, (a + length(hit))::BIGINT AS z FROM s
  WHERE CASE kind WHEN 'assign' THEN length(regexp_extract(hit, '{_ASSIGN}', 2)) >= 6 WHEN 'access' THEN length(hit) >= 20 ELSE true END),
g AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, no) AS spans FROM k GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)""",
    "op6_preference_format": """
WITH c AS (SELECT DISTINCT conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
l AS (SELECT conv_id, max(turn) AS last_turn FROM c WHERE role = 'assistant' GROUP BY conv_id),
lt AS (SELECT conv_id, last_turn, max(text) AS reply FROM l JOIN c USING (conv_id) WHERE turn = last_turn AND role = 'assistant' GROUP BY ALL),
p AS (SELECT conv_id, last_turn, coalesce(lead(reply) OVER (ORDER BY conv_id), first_value(reply) OVER (ORDER BY conv_id)) AS reply FROM lt QUALIFY count(*) OVER () > 1),
rows AS (
  SELECT conv_id AS pair_id, turn, 'chosen' AS side, role, text FROM c JOIN p USING (conv_id) WHERE turn <= last_turn
  UNION SELECT conv_id, turn, 'rejected', role, CASE WHEN turn = last_turn AND role = 'assistant' THEN reply ELSE text END FROM c JOIN p USING (conv_id) WHERE turn <= last_turn),
t AS (SELECT pair_id, turn, list_sort(list({'r': role, 't': text}) FILTER (side = 'chosen')) AS a, list_sort(list({'r': role, 't': text}) FILTER (side = 'rejected')) AS b FROM rows GROUP BY ALL),
s AS (SELECT pair_id, min(turn) FILTER (a IS DISTINCT FROM b) AS split FROM t GROUP BY pair_id),
f AS (SELECT DISTINCT pair_id, turn, CASE WHEN split IS NULL OR turn < split THEN 'prompt' ELSE side END AS part, role, text, '<|' || role || '|>' || chr(10) || text || chr(10) AS body FROM rows JOIN s USING (pair_id)),
w AS (SELECT *, coalesce(sum(length(body)) OVER (PARTITION BY pair_id, part ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(role) + 5 AS pos FROM f),
g AS (SELECT pair_id, part, string_agg(body, '' ORDER BY turn, role, text) AS body, coalesce(string_agg(pos || ':' || (pos + length(text)), ',' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss FROM w GROUP BY pair_id, part)
SELECT pair_id, coalesce(max(body) FILTER (part = 'prompt'), '') AS prompt, coalesce(max(body) FILTER (part = 'chosen'), '') AS chosen, coalesce(max(body) FILTER (part = 'rejected'), '') AS rejected,
  coalesce(max(loss) FILTER (part = 'chosen'), '') AS chosen_loss, coalesce(max(loss) FILTER (part = 'rejected'), '') AS rejected_loss
FROM g GROUP BY pair_id""",
}
