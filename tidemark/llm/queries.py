"""The registered queries of this subpackage, and their SQL where SQL can say it.

Each query reads whole tables, runs its operator with production parameters and derives the
digest columns of its contract from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import alignment, decontaminate, exact, language, licences, mixing, periods, quotes, repeats, simhash, tokens, topk, toxicity
from ._common import WHITE, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


@query("op1_mix_sources")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "source", "size", "source_size", "target", "taken"
    )


@query("op5_simhash_pigeonring")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


@query(
    "op6_exact_dedup",
    r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op7_token_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    tokens.write_token_files(table(spark, sf_dir, "documents"), path)
    return tokens.read_token_files(spark, path, ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = toxicity.held_out("doc_id", 4, 2)
    profiles = language.train(docs, ~held)
    found = language.predict(docs, profiles)
    return found.select("doc_id", toxicity.held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    found = toxicity.score(docs, model)
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query("op3_quotation_links")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


@query("op4_licence_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(table(spark, sf_dir, "documents"))


@query("op8_latent_leaks")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_repeated_passages")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op11_align_tokenizers")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query(
    "op12_pivot_top_k",
    """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS other, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, other)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def planted_runs(docs: DataFrame) -> DataFrame:
    """docs with a repetition written into one in ten texts, as the contract of op13 says.

    With h = crc32(decimal doc_id) and g = h div 10, a text with h % 10 = 0 repeats from word
    a = g % n on with the period 1 + (n - a) div (3 + g % 8).
    """
    words = F.filter(F.split(F.coalesce("text", F.lit("")), WHITE), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # a lambda's argument is computed once; a column named in a lambda would be computed for every word
    given = F.transform(F.array(F.struct(words.alias("w"), F.expr("crc32(cast(cast(doc_id AS string) AS binary)) div 10").alias("g"))), _repeated)
    return docs.withColumn("text", F.coalesce(F.when(h % 10 == 0, F.element_at(given, 1)), F.col("text")))


def _repeated(given: Column) -> Column:
    """The words w with the repetition that g tells, joined by a blank; null without words."""
    n = F.size(given["w"]).cast("long")
    a = given["g"] % n
    p = F.floor((n - a) / (3 + given["g"] % 8)) + 1
    told = F.transform(F.array(F.struct(given["w"].alias("w"), a.alias("a"), p.alias("p"))), lambda s: F.array_join(
        F.transform(F.sequence(F.lit(0).cast("long"), F.size(s["w"]).cast("long") - 1), lambda i: F.get(
            s["w"], F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"]).cast("int"))), " "))
    return F.when(n > 0, F.element_at(told, 1))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periods.periodic_runs(planted_runs(docs)).select(
        "doc_id", "n_runs", "start", "length", "period", F.expr("1000 * length div period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )
