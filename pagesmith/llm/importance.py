"""Selection of documents by importance for a target distribution (hashed n-gram features, Gumbel top-k).

Features are all runs of one to ``RUN`` consecutive words; a feature's bucket is the CRC-32 of its text modulo the
number of buckets.  Feature texts are never built.  For every block of documents an Aho-Corasick automaton is compiled
over the block's distinct words, each bounded by delimiters; a word's payload holds its CRC, the CRC with a leading
space, and its length.  Scanning the texts emits the payloads in order, and payloads of neighbouring words are composed:
CRC(a + b) follows from CRC(a), CRC(b) and the length of b alone.  The composed numbers are the buckets, for
counting and for scoring.

A block is bounded by bytes, and so is its dictionary, whatever the vocabulary of the corpus.  Counts leave a task as at
most one row per bucket.
"""

from __future__ import annotations

import math
import zlib
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesmith.llm.common import table
from pagesmith.operators.ordering import numbered

BUCKETS, RUN = 10_000, 3
#: Documents with fewer words are never drawn; so many of a hundred others are.
LEAST_WORDS, PERCENT = 20, 5
#: Bytes of text per automaton.
BLOCK_BYTES = 4 << 20
#: A-Z to a-z; every other ASCII character but digits and a-z delimits words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_POLY = 0xEDB88320  # fixed value: the reflected CRC-32 polynomial
#: Appended lengths with a table of their own; longer ones are composed of steps of powers of two.
SHORT = 64


def _step_tables() -> np.ndarray:
    """tables[n][i][x]: what n zero bytes make of the CRC register whose byte i is x, for n below SHORT."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> np.uint32(1)) ^ np.uint32(_POLY), one >> np.uint32(1))
    tables = np.empty((SHORT, 4, 256), np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(1, SHORT):
        before = tables[n - 1]
        tables[n] = (before >> np.uint32(8)) ^ one[before & np.uint32(255)]
    return tables


STEPS = _step_tables()


def append_zeros(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRC registers after ``n`` zero bytes each."""
    small = np.minimum(n, SHORT - 1)
    out = STEPS[small, 0, crc & np.uint32(255)]
    for i in (1, 2, 3):
        out = out ^ STEPS[small, i, (crc >> np.uint32(8 * i)) & np.uint32(255)]
    more = np.flatnonzero(n > small)
    if len(more):
        out[more] = append_zeros(out[more], (n - small)[more])
    return out


class Dictionary:
    """Automaton over the distinct words of some folded texts, with their payloads."""

    def __init__(self, texts: list[bytes]):
        import ahocorasick

        words = list(set(b" ".join(texts).split()))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, w in enumerate(words):
            self.automaton.add_word(f" {w.decode('latin-1')} ", i)  # a character per byte
        self.crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        self.spaced_crc = np.fromiter((zlib.crc32(b" " + w) for w in words), np.uint32, len(words))
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        if words:
            self.automaton.make_automaton()

    def scan(self, text: bytes) -> np.ndarray:
        """The words of a text as they follow one another (numbers of the dictionary)."""
        if not len(self.size):
            return np.zeros(0, np.int64)
        return np.fromiter(map(itemgetter(1), self.automaton.iter(f" {text.decode('latin-1')} ")), np.int64)

    def runs(self, text: bytes, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
        """(bucket of every feature, number of words)."""
        words = self.scan(text)
        crc, found = self.crc[words], []
        for k in range(RUN):
            if k:  # the run grows by " word": compose the payloads of neighbours
                tail = words[k:]
                crc = append_zeros(crc[:-1], self.size[tail] + 1) ^ self.spaced_crc[tail] if len(tail) else crc[:0]
            found.append(crc % np.uint32(buckets))
        return np.concatenate(found).astype(np.int64), len(words)


def _blocks(column: pa.ChunkedArray | pa.Array):
    """(first row, folded texts) of consecutive rows of bounded size; a null is an empty text."""
    texts, size, first = [], 0, 0
    for row, x in enumerate(column.cast(pa.large_binary())):
        x = (x.as_py() or b"").translate(FOLD)
        if texts and size + len(x) > BLOCK_BYTES:
            yield first, texts
            texts, size, first = [], 0, row
        texts.append(x)
        size += len(x)
    if texts:
        yield first, texts


def feature_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts; a bucket without a feature has no row."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in _blocks(batch.column(0)):
                words = Dictionary(texts)
                total += np.bincount(np.concatenate([words.runs(text, buckets)[0] for text in texts]), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    return docs.select(text_col).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket in thousandths: floor(1000 ln) of its smoothed share in ``target`` over that in ``docs``.
    The counts, one number per bucket, come to the driver."""
    def counts(df):
        out = np.zeros(buckets, np.int64)
        for r in feature_counts(df, text_col, buckets).collect():
            out[r["bucket"]] = r["n"]
        return out.tolist(), int(out.sum())

    (s, all_s), (t, all_t) = counts(docs), counts(target)
    return np.array([math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) per row: weight is the sum of the gains of all features."""
    d = docs.select(F.col(id_col).alias("id"), text_col)

    def weigh(batches):
        for batch in batches:
            numbers = np.zeros((3, batch.num_rows), np.int64)
            for first, texts in _blocks(batch.column(1)):
                words = Dictionary(texts)
                for row, text in enumerate(texts, first):
                    runs, n = words.runs(text, len(gain))
                    numbers[:, row] = n, len(runs), gain[runs].sum()
            yield pa.record_batch([batch.column(0), *map(pa.array, numbers)], ["id", "n_words", "n_features", "weight"])

    out = d.mapInArrow(weigh, f"id {d.schema['id'].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint")
    return out.withColumnRenamed("id", id_col)


def noise(id_col: Column, seed: int = 42) -> Column:
    """Gumbel noise in thousandths, rounded down, from the SHA-256 of seed and id (a null id counts as empty)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
             least_words: int = LEAST_WORDS, seed: int = 42, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) per row of ``docs``.

    ``score`` is the weight plus the id's noise.  Of the rows with at least ``least_words`` words, the
    floor(percent / 100) with the highest scores are drawn and ranked from 1, ties by the smaller id (null first); the
    rest has a null rank.  Drawing without replacement by these scores samples in proportion to exp(weight / 1000).

    * A null or empty text has no words: weight 0, never drawn.  Texts are read whole, however long.
    * Repeated rows are drawn one by one; rows that tie in id and score are ranked in any order.
    * An empty table gives an empty one; an empty target has smoothed counts only.  Extra columns are ignored.
    """
    scored = weights(docs, gains(docs, target, text_col, buckets), id_col, text_col)
    scored = table(scored.withColumn("score_", F.col("weight") + noise(F.col(id_col), seed)), "importance")
    fit = F.col("n_words") >= least_words
    draw = percent * scored.where(fit).count() // 100
    rank = F.when(F.col("rank_") <= draw, F.col("rank_"))
    drawn = numbered(scored.where(fit), [F.desc("score_"), F.asc_nulls_first(id_col), F.asc("weight"), F.asc("n_features")], "rank_")
    rest = scored.where(~fit).withColumn("rank_", F.lit(None).cast("long"))
    out = drawn.select(*scored.columns, rank.alias("rank_")).unionByName(rest)
    return out.select(id_col, "n_words", "n_features", "weight", F.col("score_").alias("score"), F.col("rank_").alias("rank"))
