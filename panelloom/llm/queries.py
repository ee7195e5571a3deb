"""The operators' queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, html_extract, lang_id, minhash, pieces, quality, secret_scan, token_store, url_filter, warc
from .common import read

URL_RULES = [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")]


def op1_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(read(spark, sf_dir, "documents"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.read_shards(token_store.write_shards(read(spark, sf_dir, "documents"), added_tokens=True))


def op4_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op5_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read(spark, sf_dir, "pages"), URL_RULES)


def op6_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_packages(warc.write_packages(read(spark, sf_dir, "pages")))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(read(spark, sf_dir, "documents")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"))
    model = lang_id.fit(docs.where(~F.col("held_out")).select("text", "lang"))
    return lang_id.identify(docs.select("doc_id", "text", "held_out"), model, keep=["held_out"])


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_quality_divergence, op2_sentencepiece, op3_token_store, op4_dart_minhash, op5_url_trie, op6_warc_zip, op7_decontaminate, op8_secret_scan, op9_language_id, op10_html_extract)
}

SQL: dict[str, str] = {
    "op5_url_trie": r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rule, verdict, host, path) AS (VALUES
  ('com/en/', 'block', 'com', '/en/'), ('example.com/en/7', 'allow', 'example.com', '/en/7'),
  ('net/de/', 'allow', 'net', '/de/'), ('example.net/de/8', 'block', 'example.net', '/de/8'), ('org/es/', 'block', 'org', '/es/')),
judged AS (
  SELECT p.page_id, p.host, p.path,
         (SELECT max(struct_pack(n := length(r.rule), rule := r.rule, verdict := r.verdict)) FROM rules r
          WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS best
  FROM parts p)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM judged
""",
}
