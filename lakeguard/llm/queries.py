"""Registered queries of this package, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeguard.llm import (alignment, decontaminate, jaccard_join, licenses, line_runs, mixing, prefix_trie, pu_classifier,
                           quality_rules, secrets, token_counts, url_rules, warc)
from lakeguard.llm.common import table

QUERIES = {}
ORACLE_SQL = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


@register("op1_quality_rules")
def op1_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@register("op2_warc_transactions")
def op2_warc_transactions(spark, sf_dir):
    return warc.resolve_revisits(warc.captures_of(table(spark, sf_dir, "pages")))


@register("op3_secret_scan")
def op3_secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"), ["doc_id"])


@register("op7_pu_quality")
def op7_pu_quality(spark, sf_dir):
    return pu_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op4_token_counts")
def op4_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), ["doc_id"])


@register("op5_chosen_path_join")
def op5_chosen_path_join(spark, sf_dir):
    return jaccard_join.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@register("op6_line_runs")
def op6_line_runs(spark, sf_dir):
    found = line_runs.removals(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed")


@register("op9_benchmark_simhash")
def op9_benchmark_simhash(spark, sf_dir):
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", F.col("start").alias("start_word"))


@register("op8_source_mix")
def op8_source_mix(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


URL_SQL = """
with parts as (
  select page_id, url,
         case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
), cut as (
  select page_id, rest, regexp_extract(rest, '^[^?#]*', 0) as bare from parts
), split as (
  select page_id, rest, lower(regexp_extract(coalesce(bare, ''), '^[^/]*', 0)) as host,
         regexp_extract(coalesce(bare, ''), '^[^/]*(.*)$', 1) as path
  from cut
), ruled as (
  select *, case
      when (host = 'www.example.com' or host like '%.www.example.com') and path like '/en/%' then 'www.example.com/en/'
      when (host = 'example.com' or host like '%.example.com') and path like '/en/%' then 'example.com/en/'
      when (host = 'net' or host like '%.net') and path like '/es/%' then 'net/es/'
      when (host = 'net' or host like '%.net') and path like '/fr/%' then 'net/fr/'
      when (host = 'com' or host like '%.com') and path like '/%' then 'com/'
    end as rule
  from split
)
select page_id, host, path, rule, pattern,
  case when rule in ('www.example.com/en/', 'com/') then 'allow'
       when rule is not null then 'block'
       when pattern is not null then 'block' else 'allow' end as verdict
from (
  select *, case
      when rule is not null or host || path = '' then null
      when regexp_matches(rest, '[?&]utm_source=feed(&|#|$)') then 'tracking-feed'
      when regexp_matches(rest, '[?&]ref=') then 'referral'
      when regexp_matches(rest, '/ads?/') then 'advert'
      when regexp_matches(rest, '/(adult|xxx)/') then 'adult-path'
    end as pattern
  from ruled)
"""


@register("op10_url_rules", URL_SQL)
def op10_url_rules(spark, sf_dir):
    judged = url_rules.judge(table(spark, sf_dir, "pages"), ["page_id"])
    return judged.select("page_id", "host", "path", "rule", "pattern", "verdict")


@register("op11_prefix_trie")
def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


@register("op12_license_scan")
def op12_license_scan(spark, sf_dir):
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents"), ["doc_id"]), ["doc_id"])


@register("op13_tokenizer_alignment")
def op13_tokenizer_alignment(spark, sf_dir):
    return alignment.alignment_summary(table(spark, sf_dir, "documents"), ["doc_id"])
