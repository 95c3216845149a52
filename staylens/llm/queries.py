"""Queries of the training-data operators and the DuckDB SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_windows, license_scan, line_dedup, prefix_trie, source_divergence

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


#: Words of a text column in DuckDB.
WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query("op1_decontaminate", rf"""
WITH item AS (SELECT DISTINCT item_id, {WORDS} AS w FROM benchmark),
win AS (SELECT item_id, least(13, len(w)) AS n, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS s
  FROM item, unnest(range(1, greatest(len(w) - 13, 0) + 2)) u(i) WHERE len(w) > 0),
doc AS (SELECT row_number() OVER () AS k, doc_id, {WORDS} AS w FROM documents),
place AS (SELECT k, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM doc, (SELECT DISTINCT n FROM win), unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) u(i)),
found AS (SELECT k, i, win.n, item_id FROM place JOIN win ON place.s = win.s AND place.n = win.n),
hit AS (SELECT k, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + n)) v(p) GROUP BY k),
items AS (SELECT k, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS list
  FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS x FROM found) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (k) LEFT JOIN items USING (k)""")
def decontaminate_documents(spark, sf_dir):
    from . import decontaminate as op

    marked = op.annotate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return marked.select("doc_id", *[f"contamination.{c}" for c in op.KIND.names if c != "spans"])


@query("op2_sentencepiece")
def sentencepiece_documents(spark, sf_dir):
    from . import sentencepiece_viterbi as op

    return op.encode(table(spark, sf_dir, "documents"), keep=["doc_id"])


@query("op6_ngram_jaccard_join")
def near_copies(spark, sf_dir):
    from . import jaccard_join as op

    return op.documents(table(spark, sf_dir, "documents"))


@query("op8_suffix_array_dedup")
def repeated_passages(spark, sf_dir):
    from . import suffix_dedup as op

    made = op.deduplicate(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return made.select("doc_id", *[f"dedup.{c}" for c in op.KIND.names if c != "kept"])


@query("op4_toxicity")
def toxic_documents(spark, sf_dir):
    from . import toxicity as op

    docs = table(spark, sf_dir, "documents")
    marked = op.annotate(docs, op.train(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return marked.select("doc_id", op.held_out("doc_id").alias("held_out"), "toxicity.score", "toxicity.predicted")


@query("op3_fingerprints")
def fingerprint_documents(spark, sf_dir):
    from . import syncmers as op

    return op.with_successors(table(spark, sf_dir, "documents"))


@query("op9_html_extraction")
def main_texts(spark, sf_dir):
    from . import html_density as op

    return op.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"]).select("page_id", "url", "main.*")


@query("op7_license_scan", license_scan.oracle())
def license_labels(spark, sf_dir):
    made = license_scan.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return made.select("doc_id", "license.*")


@query("op5_chat_formatting", chat_windows.oracle())
def formatted_conversations(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                    F.lit(chat_windows.PLANTED).alias("text"))
    return chat_windows.read_back(chat_windows.windows(rows.unionByName(planted)))


@query("op10_pii")
def personal_data(spark, sf_dir):
    from . import pii_bootstrap as op

    return op.report(table(spark, sf_dir, "documents"))


@query("op13_line_dedup", line_dedup.oracle())
def shared_lines(spark, sf_dir):
    made = line_dedup.deduplicate(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return made.select("doc_id", "dedup.n_lines", "dedup.n_dropped", F.sha2("dedup.kept", 256).alias("kept_sha256"))


@query("op12_source_divergence", source_divergence.oracle())
def source_shares(spark, sf_dir):
    return source_divergence.audit(table(spark, sf_dir, "documents"))


@query("op11_prefix_trie", prefix_trie.oracle())
def conversation_prefixes(spark, sf_dir):
    return prefix_trie.nodes(prefix_trie.rebuilt(prefix_trie.paths(table(spark, sf_dir, "conversations"))))
