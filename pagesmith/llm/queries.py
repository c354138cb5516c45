"""Registered queries of the operators: (spark, sf_dir) -> DataFrame over the whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesmith.llm import (decontaminate, fill_in_middle, html_extract, importance, language_id, line_dedup, pii, quality_crf,
                           quality_rules, repeats, sentencepiece_fst, simhash_dedup, url_filter)

QUERIES = {}


def q(fn):
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@q
def op3_simhash_near_dedup(spark, sf_dir):
    out = simhash_dedup.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, distance=4)
    return out.select("doc_id", "fingerprint", "component_id")


#: Rules of the query: (rule, allowed).
URL_RULES = [("com/", True), ("example.com/en/", False), ("www.example.com/en/", True), ("net/es/", False), ("net/fr/", False)]


@q
def op2_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "rule string, allow boolean")
    return url_filter.judge_urls(read(spark, sf_dir, "pages"), rules)


@q
def op7_quality_rules(spark, sf_dir):
    out = quality_rules.judge(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def piece_model() -> str:
    """Place of the model file, a parameter of the operator: read when a query runs."""
    return os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


@q
def op9_sentencepiece(spark, sf_dir):
    return sentencepiece_fst.encode_documents(read(spark, sf_dir, "documents"), piece_model())


def held_out(id_col: str, folds: int, fold: int):
    """Rows of the test fold by the CRC-32 of the id's text; rows without an id are in none."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


@q
def op6_language_id(spark, sf_dir):
    docs, test = read(spark, sf_dir, "documents"), held_out("doc_id", 5, 0)
    model = language_id.train(docs, ~test)
    return language_id.predict(docs.select("doc_id", test.alias("held_out"), "text"), model).drop("text")


@q
def op8_line_dedup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.deduplicate(docs, removed_out="removed")
    return out.select("doc_id", "text", F.when(F.col("removed").isNull(), 0).otherwise(F.size("removed")).cast("long").alias("n_removed"))


@q
def op1_benchmark_decontamination(spark, sf_dir):
    out = decontaminate.contaminations(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", F.col("item").alias("item_id"), "start", "similarity", "windows")


@q
def op4_html_extraction(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    return html_extract.extract_pages(pages, html_extract.train(pages))


@q
def op10_quality_classifier(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = quality_crf.train(docs, labels, ~held_out("doc_id", 3, 1))
    out = docs.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), quality_crf.quality(F.col("text"), model, spark).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@q
def op5_pii(spark, sf_dir):
    found = pii.detect(read(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)), F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"),
        pii.as_text(F.array_sort(F.array_distinct(F.concat("base", "added")))).alias("spans"))


@q
def op11_repeated_passages(spark, sf_dir):
    return repeats.remove_repeats(read(spark, sf_dir, "documents"), window=20, texts=False).drop("spans")


@q
def op12_fill_in_middle(spark, sf_dir):
    return fill_in_middle.fill_in_middle(read(spark, sf_dir, "documents"), seed=7, fim_percent=100, spm_percent=50, texts=False)


@q
def op13_importance_resampling(spark, sf_dir):
    out = importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), percent=5, least_words=20, seed=42)
    return out.select("doc_id", "n_features", "weight", "score", "rank")
