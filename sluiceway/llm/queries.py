"""One registered query for each operator, over its whole table, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluiceway.llm import bpe, conversation_sql, decontaminate, jaccard, language, prefix_trie, repair, rules_cascade, secrets, sharding, token_store, toxicity, url_templates, weak_labels
from sluiceway.llm.common import shared_dir, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score, learnt from weak labels, for every document."""
    return weak_labels.classify(table(spark, sf_dir, "documents"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, in nested encodings too."""
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count, class and component of every document."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's url."""
    return url_templates.judge_urls(table(spark, sf_dir, "pages"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text they decode to."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shard and a place in it for every document."""
    return sharding.shard_digests(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return language.identify(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of the rule cascade for every document."""
    return rules_cascade.measure(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place and digest of every document's token ids, read back from a written store."""
    return token_store.token_digests(table(spark, sf_dir, "documents"), token_store.new_folder(spark, shared_dir(spark)), BYTE_VOCABULARY)


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    return repair.repair_digests(table(spark, sf_dir, "conversations"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of rebuilt conversations."""
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_secret_scans": op2_secret_scans,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_toxicity": op4_toxicity,
    "op5_url_filters": op5_url_filters,
    "op6_bpe": op6_bpe,
    "op7_sharding": op7_sharding,
    "op8_language_id": op8_language_id,
    "op9_quality_rules": op9_quality_rules,
    "op10_decontamination": op10_decontamination,
    "op11_token_store": op11_token_store,
    "op12_structure_repair": op12_structure_repair,
    "op13_prefix_trie": op13_prefix_trie,
}

#: Measures of the quality rules, as common table expressions over `documents`.
RULE_MEASURES = r"""
texts AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
grams AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS gram FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM texts WHERE len(words) > 5)),
found AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM found, range(5) AS r(k) WHERE n > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM texts),
line_counts AS (SELECT doc_id, count(*) AS n_lines, count(DISTINCT line) AS n_different FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
measures AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines, coalesce(n_lines - n_different, 0) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower
  FROM texts LEFT JOIN repeated r USING (doc_id) LEFT JOIN line_counts USING (doc_id)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    100 * n_symbols > {symbols} * n_words OR (n_upper + n_lower >= 50 AND 100 * n_upper > {upper} * (n_upper + n_lower))
      OR (n_lines >= 8 AND 100 * n_dup_lines > {lines} * n_lines) OR word_chars > {mean} * n_words AS more_failed
  FROM measures)
""".format(symbols=rules_cascade.MAX_SYMBOLS_PERCENT, upper=rules_cascade.MAX_UPPER_PERCENT, lines=rules_cascade.MAX_DUP_LINES_PERCENT, mean=rules_cascade.MAX_MEAN_WORD)

ORACLES: dict[str, str] = {
    "op12_structure_repair": conversation_sql.STRUCTURE_REPAIR,
    "op13_prefix_trie": conversation_sql.PREFIX_TRIE,
    "op5_url_filters": url_templates.oracle_sql(),
    "op9_quality_rules": f"WITH {RULE_MEASURES} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR more_failed) AS kept FROM judged",
}
