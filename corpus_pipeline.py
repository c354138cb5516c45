"""The corpus pipeline: stages that each apply one operator to what the stage before kept.

``run`` applies them in order to ``documents``; every stage's result is written as Parquet and read again, so
a lost executor never re-runs an earlier stage.  All but the last return the columns of ``documents``.  Stages that hand
whole texts to Python bound the session's Arrow batches by bytes (a plan takes the setting when its result is written).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pagesmith.llm import decontaminate, language_id, line_dedup, sentencepiece_fst, simhash_dedup
from pagesmith.llm.common import free_name
from pagesmith.llm.queries import held_out, piece_model
from pagesmith.session import bound_batches, scratch_path

#: Languages are accepted from this score on (0.5: the margin of the best language is zero).
LEAST_SCORE = 0.4


def identify_language(spark, docs, sf_dir):
    """Documents without a letter, or whose best language stays below ``LEAST_SCORE``, go."""
    bound_batches(spark)
    model = language_id.train(docs, ~held_out("doc_id", 5, 0))
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    judged = language_id.predict(docs, model, lang_out=lang, score_out=score)
    kept = (F.col(lang) != language_id.UNKNOWN) & (F.col(score) >= LEAST_SCORE)
    return judged.where(kept).select(*docs.columns)


def deduplicate_lines(spark, docs, sf_dir):
    """Lines equal or similar to an earlier line go; every document stays, with its text and n_chars anew."""
    out = line_dedup.deduplicate(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def deduplicate_documents(spark, docs, sf_dir):
    """One document of each SimHash near-duplicate class stays."""
    return simhash_dedup.keep_one(docs, shingle=4, distance=4)


def remove_benchmark(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark, docs, sf_dir):
    """doc_id, piece ids, their number, and whether decoding gives the text back."""
    bound_batches(spark)
    return sentencepiece_fst.encode_documents(docs, piece_model())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", deduplicate_lines),
    ("simhash_near_dedup", deduplicate_documents),
    ("benchmark_decontamination", remove_benchmark),
    ("sentencepiece", encode),
]

#: Trained models, fingerprint components and the transducer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in order over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
