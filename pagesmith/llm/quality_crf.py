"""Document quality by a linear-chain conditional random field over lines.

Every line with a word is good or bad.  A line's features describe its characters and words and those of the
lines before and after it; neighbouring labels interact.  Forward-backward gives each line's probability of
being good, and a document's quality is their mean weighted by line length.

Labels exist for documents only, so in training every line takes its document's label.  Training uses a
bounded sample (``TRAIN_ROWS`` documents per class of at most ``TRAIN_LINES`` lines, chosen by a hash of the
id over the whole table).  Scoring reads every text whole, in blocks of rows.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesmith.llm.common import hash_sample, worker_cache

TRAIN_ROWS, TRAIN_LINES = 800, 300
STEPS, RATE, RIDGE = 250, 0.2, 3e-4
#: Lines that documents run side by side may take with their padding, and characters scored at once; a longer document runs alone.
CELLS, CHARS = 1 << 16, 4 << 20
SYMBOLS = "#*$%&|<>{}[]~^_=+\\/@"
FEATURES = 12
#: Features that a line also takes from each neighbour.
NEAR = (1, 2, 3, 4, 5, 7)
WIDTH = FEATURES + 2 * len(NEAR) + 2


def _classes() -> np.ndarray:
    """Character class by code point: 0 other, 1 upper, 2 other letter, 3 digit, 4 space, 5 symbol, 6 end mark, 7 shout."""
    cache = worker_cache()
    if "classes" not in cache:
        t = np.zeros(sys.maxunicode + 1, np.uint8)
        for i in range(sys.maxunicode + 1):
            c = chr(i)
            t[i] = 1 if c.isupper() else 2 if c.isalpha() else 3 if c.isdigit() else 4 if c.isspace() else 0
        for c in SYMBOLS:
            t[ord(c)] = 5
        for c in ".,;:?":
            t[ord(c)] = 6
        t[ord("!")] = 7
        cache["classes"] = t
    return cache["classes"]


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines, WIDTH) features and line lengths of the lines that hold a word."""
    lines = [x for x in (text or "").split("\n") if x.strip()]
    n = len(lines)
    out = np.zeros((n, WIDTH), np.float32)
    if not n:
        return out, np.zeros(0)
    kinds = _classes()[np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")]
    length = np.fromiter(map(len, lines), np.int64, n)
    starts = np.concatenate(([0], np.cumsum(length)[:-1]))
    share = [np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in range(8)]
    n_words, distinct = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k, x in enumerate(lines):
        words = x.split()
        n_words[k], distinct[k] = len(words), len(set(words))
    solid = np.maximum(length - share[4], 1)
    letters = np.maximum(share[1] + share[2], 1)
    seen: set[str] = set()
    again = np.array([x in seen or seen.add(x) is not None for x in lines])
    # words over distinct words: natural for short lines, so judged against the logarithm of the length
    own = (np.ones(n), share[1] / letters, (share[5] / solid), share[7] / np.maximum(n_words, 1), share[3] / solid,
           1 - distinct / np.maximum(n_words, 1), np.log1p(n_words) / 5, share[6] / np.maximum(n_words, 1), solid / np.maximum(n_words, 1) / 10,
           again, np.minimum(share[0] / solid, 1), (share[5] + share[7] + share[0]) / np.maximum(n_words, 1))
    out[:, :FEATURES] = np.stack(own, 1)
    k = len(NEAR)
    out[1:, FEATURES:FEATURES + k] = out[:-1, NEAR]
    out[:-1, FEATURES + k:FEATURES + 2 * k] = out[1:, NEAR]
    out[0, -2] = out[-1, -1] = 1  # no line before, no line after
    return np.clip(out, 0, 4), length.astype(float)


@dataclass
class Chain:
    """weights (WIDTH, 2) for bad and good, transitions (2, 2)."""

    weights: np.ndarray
    steps: np.ndarray

    def marginals(self, docs: list[np.ndarray], pair_weights: np.ndarray | None = None):
        """Probability of either label for every line of every document, and, given a weight per document, the
        weighted expected number of each pair of neighbouring labels.  Documents run side by side."""
        rows = np.array([len(d) for d in docs])
        out: list[np.ndarray] = [np.zeros((0, 2))] * len(docs)
        total = np.zeros((2, 2))
        a = np.exp(self.steps)
        order = np.argsort(rows, kind="stable")
        order = order[rows[order] > 0]
        k = 0
        while k < len(order):  # shortest first: a part ends where its padded size would pass the bound
            end = k + 1
            while end < len(order) and (end + 1 - k) * rows[order[end]] <= CELLS:
                end += 1
            part, k = order[k:end], end
            n, size = rows[part], int(rows[part].max())
            e = np.ones((size, len(part), 2))
            live = np.arange(size)[:, None] < n[None, :]
            for j, i in enumerate(part):
                s = docs[i] @ self.weights
                e[:n[j], j] = np.exp(s - s.max(1, keepdims=True))
            fwd, bwd = np.empty_like(e), np.ones_like(e)
            x = e[0]
            fwd[0] = x / x.sum(1, keepdims=True)
            for t in range(1, size):
                x = (fwd[t - 1] @ a) * e[t]
                x /= x.sum(1, keepdims=True)
                fwd[t] = np.where(live[t][:, None], x, fwd[t - 1])
            for t in range(size - 2, -1, -1):
                x = (bwd[t + 1] * e[t + 1]) @ a.T
                x /= x.sum(1, keepdims=True)
                bwd[t] = np.where(live[t + 1][:, None], x, 1.0)
            p = fwd * bwd
            p /= p.sum(2, keepdims=True)
            for j, i in enumerate(part):
                out[i] = p[:n[j], j]
            if pair_weights is not None and size > 1:
                both = fwd[:-1, :, :, None] * a[None, None] * (e[1:] * bwd[1:])[:, :, None, :]
                both /= both.sum((2, 3), keepdims=True)
                total += (both * (live[1:] * pair_weights[part])[:, :, None, None]).sum((0, 1))
        return out if pair_weights is None else (out, total)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Length-weighted mean probability of good; 0 for texts without a word."""
        docs = [line_features(t) for t in texts]
        good = self.marginals([d for d, _ in docs])
        return np.array([float((g[:, 1] * n).sum() / n.sum()) if len(n) else 0.0 for g, (_, n) in zip(good, docs)])


def fit(docs: list[np.ndarray], labels: list[int], steps: int = STEPS, rate: float = RATE, ridge: float = RIDGE) -> Chain:
    """Maximum likelihood with a ridge, by Adam on the whole sample."""
    x, y, rows = np.concatenate(docs).astype(float), np.asarray(labels), np.array([len(d) for d in docs])
    weight = np.zeros(len(docs))
    for c in (0, 1):  # both classes' lines weigh 1/2 in all
        weight[y == c] = 0.5 / max(rows[y == c].sum(), 1)
    line_weight, line_y = np.repeat(weight, rows)[:, None], np.repeat(y, rows)
    seen = x.T @ (line_weight * (line_y[:, None] == np.arange(2)))
    kept = np.diag([(weight * (rows - 1))[y == c].sum() for c in (0, 1)])
    model = Chain(np.zeros((x.shape[1], 2)), np.zeros((2, 2)))
    m, v = np.zeros(x.shape[1] * 2 + 4), np.zeros(x.shape[1] * 2 + 4)
    for k in range(1, steps + 1):
        p, pairs = model.marginals(docs, weight)
        gw = seen - x.T @ (line_weight * np.concatenate(p)) - ridge * model.weights
        gs = kept - pairs - ridge * model.steps
        g = np.concatenate((gw.ravel(), gs.ravel()))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
        model.weights = model.weights + step[:-4].reshape(-1, 2)
        model.steps = np.clip(model.steps + step[-4:].reshape(2, 2), -6, 6)
    return model


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows: int = TRAIN_ROWS, lines: int = TRAIN_LINES) -> Chain:
    """Fit on up to ``rows`` labelled documents per class among the rows of ``labels`` where ``usable`` holds.
    Ids with a null or contradictory label are left out.  Without both classes every line is equally
    likely good or bad (score 0.5)."""
    known = (labels.where(usable).where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(F.min(label_col).cast("int").alias("y"), F.max(label_col).cast("int").alias("z")).where("y = z and y in (0, 1)"))
    ids = hash_sample(known.select("id", "y", F.xxhash64(F.lit("quality"), "id").alias("rank")), rows, "rank", ("y",)).select("id", "y")
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id").dropDuplicates(["id"])

    def measured(batches):
        for batch in batches:
            out = []
            for i, y, text in zip(batch["id"].to_pylist(), batch["y"].to_pylist(), batch["text"].to_pylist()):
                x, _ = line_features(text)
                if 0 < len(x) <= lines:
                    out.append({"id": str(i), "y": y, "x": x.tobytes()})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("id", pa.string()), ("y", pa.int32()), ("x", pa.binary())]))

    got = sorted(picked.select("id", "y", "text").mapInArrow(measured, "id string, y int, x binary").collect())
    if len({r["y"] for r in got}) < 2:
        return Chain(np.zeros((WIDTH, 2)), np.zeros((2, 2)))
    return fit([np.frombuffer(r["x"], np.float32).reshape(-1, WIDTH) for r in got], [r["y"] for r in got])


def quality(text: Column, model: Chain, spark) -> Column:
    """Score of each text from 0 to 1 (0 for null and blank texts).  A text of any length is scored whole; documents that run
    side by side take a bounded number of lines with their padding, so memory follows the longest text alone."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        parts, some, chars = [], [], 0
        for text in texts.tolist():
            if some and chars + len(text or "") > CHARS:
                parts.append(shared.value.score(some))
                some, chars = [], 0
            some.append(text)
            chars += len(text or "")
        if some:
            parts.append(shared.value.score(some))
        return pd.Series(np.concatenate(parts) if parts else [], dtype="float64")

    return score(text)
