"""Registered queries of the subpackage, with their parameters, and SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.llm import training_order as order
from tablegauge.llm import (
    bbit_minhash,
    disclosure,
    html_mincut,
    kd_search,
    periodic_runs,
    prefix_join,
    prefix_trie,
    recompression,
    toxicity,
    url_bloom,
    vector_packing,
    winnowing,
)
from tablegauge.llm.common import load, ship_package
from tablegauge.llm.oracles import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES", "RANKS"]

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return order.training_order(load(spark, sf_dir, "documents"), RANKS, key=0x5EED)


def op2_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return toxicity.toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op3_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return html_mincut.extracted(load(spark, sf_dir, "pages"))


def op4_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    found = bbit_minhash.near_duplicates(load(spark, sf_dir, "documents"), words=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return vector_packing.pack(load(spark, sf_dir, "documents"), RANKS)


def op6_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    kept = recompression.repeated_passages_removed(load(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_kd_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    vectors = load(spark, sf_dir, "embeddings")
    return kd_search.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5, scale=256)


#: The rules of the query, and words in the name of a host that put the URLs on it on the list.
URL_RULES = (
    url_bloom.Rule("com", "/", "allow"),
    url_bloom.Rule("example.com", "/en/", "block"),
    url_bloom.Rule("www.example.com", "/en/", "allow"),
    url_bloom.Rule("net", "/es/", "block"),
    url_bloom.Rule("net", "/fr/", "block"),
)
LISTED_HOSTS = r"(^|[.-])(spam|pills|casino|bets|ads)[.-]"


def op8_url_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    # The list grows with the corpus: every URL seen on a host of such a name.
    listed = url_bloom.host_and_path(pages.select("url")).filter(F.col("host").rlike(LISTED_HOSTS)).select("url")
    return url_bloom.judged(pages, listed, URL_RULES)


def op9_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return disclosure.personal_data(load(spark, sf_dir, "documents"))


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.decontamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op11_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return prefix_join.similar_documents(load(spark, sf_dir, "documents"), words=4, percent=85)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = load(spark, sf_dir, "documents")
    # One document in ten goes on from word a with its words from a to a + p, again and again.
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    changed = docs.select("doc_id", "text", F.when((h % 10 == 0) & F.col("text").isNotNull(), words).alias("w"), F.floor(h / 10).alias("g"))
    n = F.size("w")
    changed = changed.withColumn("a", F.when(n > 0, (F.col("g") % n).cast("int")))
    changed = changed.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    repeated = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", F.col("a") + F.pmod(i - F.col("a"), F.col("p")))))
    text = F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("text"))
    found = periodic_runs.periodic_runs(changed.select("doc_id", text.alias("text")), min_words=24, exponent=3)
    # Runs are in order of start, then period, so the first of equal exponents stays.
    longer = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, r: F.when(longer(best, r), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    own = prefix_trie.sequences(load(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(own, block=20, most=4))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_training_order,
        op2_ftrl,
        op3_mincut,
        op4_bbit_minhash,
        op5_vector_best_fit,
        op6_recompression,
        op7_kd_trees,
        op8_url_bloom,
        op9_disclosure,
        op10_winnowing,
        op11_prefix_join,
        op12_periodic_runs,
        op13_prefix_trie,
    )
}
