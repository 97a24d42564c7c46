"""The queries of this package on the given tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from touchline.llm import (
    decontaminate, document_fingerprint, embedding_dedup, html_extract, line_dedup, merkle_manifest, prefix_trie,
    quality_gam, sentencepiece_codec, simhash_dedup, suffix_dedup, token_files, url_filter,
)
from touchline.llm.common import shared_folder, table
from touchline.llm.sql import FINGERPRINT_SQL, MANIFEST_SQL, TRIE_SQL

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup_suffixes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.dedup_embeddings(table(spark, sf_dir, "embeddings"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = token_files.write_token_files(
        table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER), shared_folder(spark)
    )
    return token_files.read_token_files(shards)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.dedup_simhash(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merkle_manifest.manifest(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprint.compare_edits(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

LINES_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), keyed AS (
  SELECT doc_id, i, line, translate(trim(line, {_BLANKS}), {_UPPER}, {_LOWER}) AS key FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.last AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_WORDS = "regexp_extract_all(translate(text, {u}, {l}), '[^\\x{{00}}-\\x{{2F}}\\x{{3A}}-\\x{{60}}\\x{{7B}}-\\x{{7F}}]+')".format(
    u=_UPPER, l=_LOWER)

WINDOWS_SQL = f"""
WITH items AS (
  SELECT item_id, w, least(len(w), 10) AS size
  FROM (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL) WHERE len(w) > 0
), item_windows AS (
  SELECT item_id, size, list_slice(w, i, i + size - 1) AS win
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM items)
), docs AS (
  SELECT doc_id, coalesce({_WORDS}, []::VARCHAR[]) AS w FROM documents
), places AS (
  SELECT doc_id, size, i, list_slice(w, i, i + size - 1) AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM item_windows))
), found AS (
  SELECT p.doc_id, p.i, p.size, v.item_id FROM places p JOIN item_windows v ON p.size = v.size AND p.win = v.win
), hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found)
  GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_sentencepiece, op3_embedding_dedup, op4_token_files, op5_quality_classifier,
        op6_url_filter, op7_html_extract, op8_simhash_dedup, op9_line_dedup, op10_decontaminate,
        op11_merkle_manifest, op12_document_fingerprints, op13_prefix_trie,
    )
} | {"pipeline": _pipeline}

SQL: dict[str, str] = {
    "op9_line_dedup": LINES_SQL, "op10_decontaminate": WINDOWS_SQL, "op11_merkle_manifest": MANIFEST_SQL,
    "op12_document_fingerprints": FINGERPRINT_SQL, "op13_prefix_trie": TRIE_SQL,
}
