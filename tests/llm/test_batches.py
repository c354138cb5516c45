"""Whole texts cross to Python in batches bounded by bytes, whatever the session allows."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pagesmith.llm import simhash_dedup
from pagesmith.session import ARROW_BYTES, TEXT_BATCH, bound_batches, bounded_batches

WIDE = str(64 << 20)


@pytest.fixture
def wide(spark):
    before = spark.conf.get(ARROW_BYTES)
    spark.conf.set(ARROW_BYTES, WIDE)
    yield spark
    spark.conf.set(ARROW_BYTES, before)


def texts(spark, rows=24, size=1 << 20):
    return spark.range(0, rows, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab c "), size // 5).alias("text"))


def largest(docs):
    @F.pandas_udf("long")
    def bytes_(s):
        return pd.Series([int(s.str.len().sum())] * len(s))
    return docs.select(bytes_("text").alias("n")).agg(F.max("n")).first()[0]


def test_fingerprints_are_made_of_small_batches(wide, monkeypatch):
    table, seen = simhash_dedup.table, {}

    def noted(df, name):
        seen.setdefault(name, wide.conf.get(ARROW_BYTES))
        return table(df, name)
    monkeypatch.setattr(simhash_dedup, "table", noted)
    assert simhash_dedup.near_duplicates(texts(wide, 3, 100)).count() == 3
    assert int(seen["simhash-docs"]) == TEXT_BATCH
    assert wide.conf.get(ARROW_BYTES) == WIDE  # as it was for the rest of the session


def test_batches_hold_few_texts_more_than_the_bound(wide):
    docs = texts(wide)
    with bounded_batches(wide):
        assert largest(docs) <= TEXT_BATCH + (2 << 20)
    assert largest(docs) > 2 * TEXT_BATCH


def test_stages_of_the_pipeline_bound_what_they_return(wide):
    docs = texts(wide, 4, 100).withColumns({"lang": F.lit("x"), "source": F.lit("s"), "n_chars": F.length("text")})
    for stage in (corpus_pipeline.identify_language, corpus_pipeline.encode):
        wide.conf.set(ARROW_BYTES, WIDE)
        stage(wide, docs, "")
        assert int(wide.conf.get(ARROW_BYTES)) == TEXT_BATCH


@pytest.mark.parametrize("before, after", [("1000", "1000"), ("3k", "3k"), ("67108864b", str(TEXT_BATCH)), ("64m", str(TEXT_BATCH))])
def test_a_lower_bound_of_the_session_stays(wide, before, after):
    wide.conf.set(ARROW_BYTES, before)
    bound_batches(wide)
    assert wide.conf.get(ARROW_BYTES).rstrip("b") == after
