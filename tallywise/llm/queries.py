"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywise.llm import (bpe_lexicon, chat_format, filter_audit, html_region, license_templates, mixing_tree, nn_descent, quality_mcd,
                           rmq_search, secrets_crf, shard_tree, simhash_tiles, token_planes)
from tallywise.llm.common import hex16, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_secret_scan")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets_crf.scan_digest(docs)


@query("op2_bpe")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_lexicon.with_round_trip(docs, "text", bpe_lexicon.vocabulary_path()).drop("text")


@query("op3_simhash")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash_tiles.near_duplicates(docs, keep=["doc_id"])
    return found.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


@query("op6_quality")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality_mcd.judge(docs).select("doc_id", *[n for n, _ in quality_mcd.STATS], "base_failed", "kept", "mahalanobis")


@query("op9_mixing")
def op9(spark, sf_dir):
    return mixing_tree.mix_sizes(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


_OP4_SQL = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (
  select *, replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') as shown_text,
         replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') as shown_role from t)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls last, role) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(13 + length(shown_role) + length(shown_text)) as bigint) as formatted_chars
from e group by conv_id
"""


@query("op4_chat", _OP4_SQL)
def op4(spark, sf_dir):
    said = r"\### Assistant: </turn> ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat_format.formatted(turns.unionByName(more))


@query("op5_token_planes")
def op5(spark, sf_dir):
    return token_planes.planes_round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_sharding")
def op7(spark, sf_dir):
    return shard_tree.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op8_licenses")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_templates.with_licenses(docs).drop("text")


@query("op10_nn_descent")
def op10(spark, sf_dir):
    return nn_descent.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op11_html_region")
def op11(spark, sf_dir):
    return html_region.with_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


@query("op12_filter_audit", filter_audit.AUDIT_SQL)
def op12(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_rmq_search", rmq_search.RANK_SQL)
def op13(spark, sf_dir):
    return rmq_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
