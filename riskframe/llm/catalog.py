"""One query per operator over its whole table, with its digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import (exact, hmm, license, merkle, mixing, negatives, orcids, packing, quality, simhash, substring,
                           tokens, urls)
from riskframe.session import cut_lineage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@register("op1_mix")
def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", mixing.n_words().alias("size"))
    x = mixing.schedule(docs)
    return x.repartitionByRange("finish").sortWithinPartitions("finish").select(
        "doc_id", "size", "source_size", "target", "taken", "finish")


@register("op2_pack")
def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir).select("doc_id", "text"))


@register("op3_hmm")
def op3_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.scored_texts(documents(spark, sf_dir).select("doc_id", "text"))


@register("op4_substring")
def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = substring.without_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return x.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op5_exact")
def op5_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(documents(spark, sf_dir).select("doc_id", "text"))


@register("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = simhash.near_groups(documents(spark, sf_dir).select("doc_id", "text"))
    return x.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op7_license")
def op7_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scanned(documents(spark, sf_dir).select("doc_id", "text"))


@register("op8_tokens")
def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = documents(spark, sf_dir).select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        tokens.count_tokens("text").alias("n_tokens"))
    return x.withColumn("over_limit", F.col("n_tokens") > 2048)


@register("op9_orc")
def op9_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = orcids.write(documents(spark, sf_dir).select("doc_id", "text"))
    return orcids.read(spark, folder).select("doc_id", "start", "n_tokens", orcids.crc32("ids").alias("ids_crc32"))


@register("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = cut_lineage(quality.document_statistics(documents(spark, sf_dir).select("doc_id", "text")))
    forest = quality.fit(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.verdicts(stats, forest).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op11_negatives")
def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0, label=label)


#: rules of the url filter: verdict, host, path
URL_RULES = [urls.Rule("block", "net", "/"), urls.Rule("allow", "example.net", "/en/"),
             urls.Rule("block", "example.com", "/de/"), urls.Rule("allow", "org", "/fr/")]
#: a domain whose first label has one of these words goes on the block list
LISTED_WORDS = ["ads", "adult", "bets", "casino", "pills", "spam"]


@register("op12_urls")
def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    names = urls.corpus_domains(pages.select(urls.url_parts("url")[0].alias("host")))
    out = urls.judged(pages, URL_RULES, urls.domains_with_words(names, LISTED_WORDS))
    return out.select("page_id", "host", "path", "rule", "verdict")


@register("op13_merkle")
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merkle.proofs(documents(spark, sf_dir), F.replace("text", F.lit("\n"), F.lit("")),
                        F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256"),
                      "folded_root", "verified")
