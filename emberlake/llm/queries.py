"""Registered queries of this subpackage: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from emberlake.llm import (
    chat_format, jaccard_join, language_id, minhash_dedup, mixing, order_minhash, quality_rules, ranked_search, secret_scan,
    spelling_groups, token_files, trie_bpe, url_filters)
from emberlake.llm.common import table

#: End-of-document identifier: the first one that the byte vocabulary leaves free.
SEPARATOR = 50256


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filters.filter_urls(url_filters.dated_captures(pages), url_filters.dated_entries(pages))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edit_sensitivity(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.document_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, SEPARATOR)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.shingle_join(table(spark, sf_dir, "documents"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat_format.summarize(chat_format.format_conversations(turns.unionByName(own)))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).drop("text_key", "found")


def op10_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups.spelling_groups(table(spark, sf_dir, "documents"))


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {query.__name__: query for query in (
    op1_url_filters, op2_order_minhash, op3_token_counts, op4_ngram_jaccard_join, op5_chat_formatting, op6_language_id,
    op7_quality_rules, op8_mixing, op9_secret_scan, op10_trie_bpe, op11_ranked_search, op12_spelling_groups,
    op13_minhash_dedup)}

_DRAW = "CAST(concat('0x', substr(md5(concat('{salt}', {key})), 1, 7)) AS BIGINT)"
_HOST = r"nullif(rtrim(trim(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '.'), '')"


def _draw(salt: str, key: str) -> str:
    return _DRAW.format(salt=salt, key=key)


def _listed(name: str, source: str, key: str, salt: str, verdict: str, keep: str) -> str:
    return (f"SELECT '{name}' AS list_name, {key} AS key, '{verdict}' AS verdict, "
            f"1672531200 + {_draw(salt, key)} % (731 * 86400) AS listed_at FROM {source} WHERE {keep}")


def _components(words: int, percent: int, kept: str = "") -> str:
    """Links of shingle sets by counting shared shingles, equal texts once; then everything reachable."""
    return rf"""
WITH RECURSIVE texts AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
worded AS (SELECT text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM texts),
grams AS (SELECT DISTINCT text, CASE WHEN len(w) < {words} THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + {words - 1}], ' ') END AS gram
  FROM (SELECT text, w, unnest(range(1, greatest(len(w) - {words - 2}, 2))) AS i FROM worded WHERE len(w) > 0)),
sizes AS (SELECT text, count(*) AS n, row_number() OVER (ORDER BY text) AS id FROM grams GROUP BY text),
posted AS (SELECT s.id, s.n, g.gram FROM grams g JOIN sizes s USING (text)),
links AS (SELECT a.id AS a, b.id AS b FROM posted a JOIN posted b ON a.gram = b.gram AND a.id <> b.id AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reach AS (SELECT id AS a, id AS b FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_id AS (SELECT s.id, min(d.doc_id) AS doc_id FROM documents d JOIN sizes s USING (text) GROUP BY s.id),
component AS (SELECT r.a AS id, min(l.doc_id) AS component_id FROM reach r JOIN least_id l ON l.id = r.b GROUP BY r.a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, CASE WHEN s.id IS NULL THEN d.doc_id ELSE c.component_id END AS component_id{kept}
FROM documents d LEFT JOIN sizes s ON s.text = d.text LEFT JOIN component c ON c.id = s.id"""


_BLOCKED = f"{_draw('host:', 'host')} % 3 = 0"
_ESCAPED = "replace({x}, chr(92), chr(92) || chr(92))"
for _control in chat_format.CONTROL_STRINGS:
    _ESCAPED = f"replace({_ESCAPED}, '{_control}', '{_control[0]}' || chr(92) || '{_control[1:]}')"

ORACLE_SQL: dict[str, str] = {
    "op1_url_filters": f"""
WITH hosts AS (SELECT DISTINCT {_HOST} AS host FROM pages WHERE {_HOST} IS NOT NULL),
domains AS (SELECT DISTINCT substr(host, instr(host, '.') + 1) AS host FROM hosts WHERE len(string_split(host, '.')) > 2),
plain AS (SELECT DISTINCT regexp_extract(url, '^[^?#]*') AS key FROM pages WHERE url IS NOT NULL),
entries AS (
  {_listed('hosts', 'hosts', 'host', 'on:', 'block', _BLOCKED)} UNION ALL
  {_listed('hosts', 'hosts', 'host', 'off:', 'allow', _BLOCKED + f" AND {_draw('off:', 'host')} % 3 = 0")} UNION ALL
  {_listed('hosts', 'hosts', 'host', 'again:', 'block', _BLOCKED + f" AND {_draw('again:', 'host')} % 9 = 0")} UNION ALL
  {_listed('domains', 'domains', 'host', 'on:', 'block', f"{_draw('domain:', 'host')} % 8 = 0")} UNION ALL
  {_listed('urls', 'plain', 'key', 'on:', 'allow', f"{_draw('url:', 'key')} % 8 = 0")}),
dated AS (SELECT list_name, key, listed_at, max(verdict) AS verdict FROM entries GROUP BY ALL),
spans AS (SELECT *, lead(listed_at, 1, 253402214400) OVER (PARTITION BY list_name, key ORDER BY listed_at) AS until FROM dated),
captures AS (SELECT page_id, url, {_HOST} AS host, regexp_extract(url, '^[^?#]*') AS own,
  1672531200 + {_draw('fetch:', 'CAST(page_id AS VARCHAR)')} % (731 * 86400) AS fetched FROM pages),
matched AS (
  SELECT c.page_id, count(*) AS n_active,
    max(struct_pack(n := length(s.key), at := s.listed_at, list := s.list_name, verdict := s.verdict, key := s.key)) AS best
  FROM captures c JOIN spans s ON s.listed_at <= c.fetched AND c.fetched < s.until
    AND (s.key = c.own OR s.key = c.host OR ends_with(c.host, '.' || s.key) AND contains(s.key, '.'))
  GROUP BY c.page_id)
SELECT c.page_id, c.url, to_timestamp(c.fetched) AS fetched_at, coalesce(m.best.verdict = 'block', false) AS blocked,
  m.best.list AS list_name, m.best.key AS matched_key, to_timestamp(m.best.at) AS listed_at, coalesce(m.n_active, 0) AS n_active
FROM captures c LEFT JOIN matched m USING (page_id)""",
    "op5_chat_formatting": f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL
  SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
shown AS (
  SELECT *, '<|im_start|>' || replace({_ESCAPED.format(x='role')}, chr(10), chr(92) || chr(10)) || chr(10) AS opening,
    {_ESCAPED.format(x='text')} || '<|im_end|>' || chr(10) AS rest FROM turns),
placed AS (
  SELECT *, coalesce(sum(length(opening) + length(rest)) OVER (
    PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM shown)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(opening) + length(rest)) AS BIGINT) AS formatted_chars,
  count(*) FILTER (role = 'assistant') AS n_examples,
  CAST(coalesce(sum(before + length(opening)) FILTER (role = 'assistant'), 0) AS BIGINT) AS context_chars
FROM placed GROUP BY conv_id""",
    "op4_ngram_jaccard_join": _components(5, 75),
    "op11_ranked_search": r"""
WITH terms AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
held AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), corpus),
scores AS (SELECT a.item_id, h.doc_id, CAST(sum(w.w * ((1000000000 * h.tf) // (1000 * h.tf + 8 * (10 + (90 * s.n * c.docs) // c.words)))) AS BIGINT) AS score
  FROM asked a JOIN held h USING (term) JOIN weights w USING (term) JOIN sizes s USING (doc_id), corpus c GROUP BY a.item_id, h.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 10""",
    "op13_minhash_dedup": _components(4, 80, ", d.doc_id = CASE WHEN s.id IS NULL THEN d.doc_id ELSE c.component_id END AS kept"),
}
