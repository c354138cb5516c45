"""Language identification by string kernels.

The kernel of two texts is the blended-spectrum presence kernel: the number of character n-grams
(n = 1 .. N, letters in lower case, everything else one space) that both hold, divided by the root of the
product of their numbers of distinct n-grams.  A few training texts are landmarks (Nyström
approximation), one-versus-rest kernel ridge regression is fitted in the landmark space, and texts are
scored in batches: presence matrix x landmark matrix, then x dual coefficients.

Training uses a bounded sample per language (``TRAIN_ROWS``, documented parameter) chosen by a hash of
the id over the whole table; scoring reads every text whole, in blocks, and moves nothing but the results.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesmith.llm.common import free_name, hash_sample, worker_cache

MAX_N = 3
#: Size of the n-gram table (n-grams are told apart by a hash of this many bits).
BITS = 17
#: Training rows and landmarks per language, fragments cut from each training text, ridge.
TRAIN_ROWS, LANDMARKS, FRAGMENTS, RIDGE = 160, 16, 3, 1e-2
FRAGMENT_CHARS = (12, 60)
BLOCK_CHARS, BATCH = 1 << 20, 64
UNKNOWN = "und"


def _letters() -> np.ndarray:
    cache = worker_cache()
    if "letters" not in cache:
        cache["letters"] = np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)])
    return cache["letters"]


def gram_codes(text: str) -> tuple[np.ndarray, bool]:
    """Hashed n-grams of a text (with repeats) and whether it holds a letter."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[c]
    c = np.where(letter, c, 32).astype(np.uint64)
    c = np.concatenate(([32], c[(c != 32) | np.concatenate(([True], c[:-1] != 32))], [32])).astype(np.uint64)
    out, h = [], np.zeros(len(c), np.uint64)
    for n in range(1, MAX_N + 1):
        if len(c) < n:
            break
        h = h[:len(c) - n + 1] * np.uint64(0x100000001B3) + c[n - 1:]
        out.append(((h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS))
    return np.concatenate(out).astype(np.int64), bool(letter.any())


def presence(text: str | None) -> tuple[np.ndarray, bool]:
    """Flags of the n-grams that a whole text holds (long texts block by block) and whether it has a letter."""
    flags, any_letter = np.zeros(1 << BITS, np.uint8), False
    for k in range(0, len(text or ""), BLOCK_CHARS):
        codes, letter = gram_codes(text[max(0, k - MAX_N + 1):k + BLOCK_CHARS])
        flags[codes] = 1
        any_letter |= letter
    return flags, any_letter


@dataclass
class LanguageModel:
    languages: list[str]
    column: np.ndarray      # n-gram -> column of the landmark matrix; the last column is "in no landmark"
    landmarks: np.ndarray   # (columns, landmarks) presence, each divided by the root of its size
    dual: np.ndarray        # (landmarks, languages)

    def kernel(self, held: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return held @ self.landmarks / np.sqrt(np.maximum(sizes, 1))[:, None]

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1: half the margin plus one half) of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        n = self.landmarks.shape[0]
        held, sizes, known = np.zeros((len(texts), n), np.float32), np.zeros(len(texts)), []
        for i, t in enumerate(texts):
            flags, letter = presence(t)
            codes = np.flatnonzero(flags)
            held[i, self.column[codes]] = 1
            sizes[i] = len(codes)
            known.append(letter)
        held[:, -1] = 0
        margins = self.kernel(held, sizes) @ self.dual
        best = margins.argmax(1)
        scores = np.clip(0.5 + margins[np.arange(len(texts)), best] / 2, 0, 1)
        return ([self.languages[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, scores, 0.0))


def fit(packed: list[bytes], labels: np.ndarray, ranks: np.ndarray, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
    """Nyström ridge regression from presence flags (bits, a row each).  ``ranks`` orders the rows of a
    language; its first ones become landmarks.  Rows are unpacked a block at a time."""
    row = lambda i: np.unpackbits(np.frombuffer(packed[i], np.uint8))
    languages = sorted(set(labels))
    chosen = np.concatenate([np.flatnonzero(labels == x)[np.argsort(ranks[labels == x], kind="stable")][:landmarks]
                             for x in languages])
    used = np.any([row(i) for i in chosen], axis=0)
    n = int(used.sum())
    column = np.full(1 << BITS, n, np.int64)
    column[used] = np.arange(n)
    z = np.zeros((n + 1, len(chosen)), np.float32)
    for j, i in enumerate(chosen):
        flags = row(i)
        z[:-1, j] = flags[used] / np.sqrt(max(flags.sum(), 1))
    model = LanguageModel(languages, column, z, np.zeros((len(chosen), len(languages))))
    k = np.zeros((len(packed), len(chosen)))
    for at in range(0, len(packed), BATCH):
        flags = np.array([row(i) for i in range(at, min(at + BATCH, len(packed)))])
        held = np.zeros((len(flags), n + 1), np.float32)
        held[:, :-1] = flags[:, used]
        k[at:at + len(flags)] = model.kernel(held, flags.sum(1, dtype=np.int64))
    # W^-1/2 of the landmarks' own kernel maps k to features whose products approximate the kernel
    values, vectors = np.linalg.eigh(k[chosen])
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    phi = k @ root
    y = np.where(labels[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    weight = 1.0 / np.array([np.sum(labels == x) for x in labels])[:, None]  # languages count alike
    gram = phi.T @ (phi * weight) + ridge / len(chosen) * np.eye(phi.shape[1])
    model.dual = (root @ np.linalg.solve(gram, phi.T @ (y * weight))).astype(np.float32)
    return model


def _fragments(text: str, seed: int) -> list[str]:
    rng = np.random.default_rng(seed)
    out = [text]
    for _ in range(FRAGMENTS):
        size = int(rng.integers(*FRAGMENT_CHARS))
        at = int(rng.integers(0, max(1, len(text) - size)))
        out.append(text[at:at + size])
    return out


def train(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows: int = TRAIN_ROWS, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
    """Fit on up to ``rows`` rows per language among those where ``usable`` holds, lang and id are
    not null and the text has a letter.  Rows are chosen by a hash of the id, over the whole table.  Without
    any such row the model knows no language and finds every text unknown."""
    d = docs.where(usable).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    known = d.where("id is not null and lang is not null").select("id", "lang").distinct()
    ids = hash_sample(known.withColumn("rank", F.xxhash64(F.lit("lang"), F.col("id"))), rows, "rank", ("lang",))
    picked = d.join(F.broadcast(ids), ["id", "lang"]).dropDuplicates(["id"])  # at most rows per language

    def features(batches):
        for batch in batches:
            out = []
            for lang, rank, text in zip(batch["lang"].to_pylist(), batch["rank"].to_pylist(), batch["text"].to_pylist()):
                for j, part in enumerate(_fragments(text or "", rank & 0xFFFFFFFF)):
                    flags, letter = presence(part)
                    if letter:
                        out.append((lang, rank, j, np.packbits(flags).tobytes()))
            yield pa.RecordBatch.from_pylist([dict(zip(("lang", "rank", "part", "flags"), x)) for x in out], schema=pa.schema(
                [("lang", pa.string()), ("rank", pa.int64()), ("part", pa.int32()), ("flags", pa.binary())]))

    got = sorted(picked.select("lang", "rank", "text").mapInArrow(
        features, "lang string, rank bigint, part int, flags binary").collect())
    if not got:
        return LanguageModel([], np.zeros(1 << BITS, np.int64), np.zeros((1, 0), np.float32), np.zeros((0, 0), np.float32))
    ranks = np.array([(x["part"] > 0) * 2.0 ** 64 + float(x["rank"]) for x in got])  # landmarks are whole texts first
    return fit([bytes(x["flags"]) for x in got], np.array([x["lang"] for x in got]), ranks, landmarks, ridge)


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_out: str = "lang_pred",
            score_out: str = "score") -> DataFrame:
    """``docs`` with the language and score of every text; ``und`` and 0 for null texts and texts without
    a letter.  Columns of ``docs`` with these names are replaced; repeated rows get equal results."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def language(texts):
        import pandas as pd
        langs, scores, all_texts = [], [], texts.tolist()
        for k in range(0, len(all_texts), BATCH):
            a, b = shared.value.score(all_texts[k:k + BATCH])
            langs += a
            scores.append(b)
        return pd.DataFrame({"lang": langs, "score": np.concatenate(scores) if scores else []})

    keep = [c for c in docs.columns if c.lower() not in (lang_out.lower(), score_out.lower())]
    both = free_name(docs, "language")
    return docs.select(*(F.col(f"`{c}`") for c in keep), language(F.col(text_col)).alias(both)).select(
        *(F.col(f"`{c}`") for c in keep), F.col(f"{both}.lang").alias(lang_out), F.col(f"{both}.score").alias(score_out))
