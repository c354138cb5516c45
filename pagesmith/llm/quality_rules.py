"""Document quality rules as a short-circuit cascade of native expressions.

Each rule is a predicate that says a text fails.  The order in which rules are tried is found on a
sample: every rule's time and rejection rate are measured there, and rules run by rejections per
second.  A text that fails a rule is not looked at by the rules after it (SQL's CASE stops at the
first true branch), so costly rules see only what cheap ones passed.  The verdict doesn't depend
on the order.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesmith.llm.common import drop, free_name, stripped, table, words

SYMBOLS = "#*$%&|<>"
#: Rows of the sample that sets the order of the rules (whole texts; the verdicts don't depend on it).
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """A text fails when ``fails`` holds; it may use the signal columns and the text."""

    name: str
    fails: Callable[[Column], Column]


def repeated_window_words(df: DataFrame, words_col: str, out: str, size: int = 3) -> DataFrame:
    """``df`` plus ``out``: how many words lie in a ``size``-word window that the text holds twice or more."""
    n = F.size(words_col) - (size - 1)
    shifted = [F.slice(words_col, i + 1, F.greatest(n, F.lit(0))) for i in range(size)]
    hashed = F.transform(F.arrays_zip(*shifted), lambda x: F.xxhash64(*(x[str(i)] for i in range(size))))
    h, s, p = (free_name(df, c) for c in ("window_hash", "window_sorted", "window_repeats"))
    some = F.size(F.array_distinct(h)) < F.size(h)
    df = df.withColumn(h, hashed)
    # windows sorted by hash: a repeated one equals a neighbour
    df = df.withColumn(s, F.when(some, F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    here = F.col(s)
    pairs = F.arrays_zip(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1))
    equal = F.transform(F.filter(pairs, lambda x: x["0"]["h"] == x["1"]["h"]), lambda x: F.array(x["0"]["i"], x["1"]["i"]))
    df = df.withColumn(p, F.when(here.isNotNull(), F.sort_array(F.array_distinct(F.flatten(equal)))))
    start = F.struct(F.lit(-size).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(p, start, lambda a, i: F.struct(
        i.alias("last"), (a["n"] + F.least(F.lit(size), i - a["last"])).alias("n")), lambda a: a["n"])
    return df.withColumn(out, F.coalesce(covered, F.lit(0).cast("long"))).drop(h, s, p)


def signals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) per row; counts are
    long, and zero for null, empty and blank texts.  Lines count if they hold a word."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: stripped(x) != "")
    d = d.withColumn("words", words(F.col("text"))).withColumn("lines", lines)
    d = repeated_window_words(d, "words", "n_repeat_words")
    return d.select(
        "id", "text", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words")


def _letters(text: Column, kind: str) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), rf"[^\p{{{kind}}}]+", ""))


RULES = (
    Rule("few_words", lambda t: F.col("n_words") < 50),
    Rule("repeated_words", lambda t: 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    Rule("symbols", lambda t: 100 * F.col("n_symbols") > 10 * F.col("word_chars")),
    Rule("repeated_lines", lambda t: 100 * F.col("n_dup_lines") > 50 * F.col("n_lines")),
    Rule("word_length", lambda t: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words"))),
    Rule("shouting", lambda t: 100 * _letters(t, "Lu") > 50 * _letters(t, "L")),
)
BASE = ("few_words", "repeated_words")


def rule_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES,
               sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """The rules by rejections per second on a sample of about ``sample_rows`` documents: dicts of name, seconds,
    rejected, rows.  An empty table keeps the given order."""
    total = docs.count()
    picked = docs.select(id_col, text_col).sample(min(1.0, sample_rows / max(total, 1)), seed=7)
    sample = table(signals(picked, id_col, text_col).repartition(1), "quality-sample")
    sample.agg(F.max("n_words")).first()  # reads once before any timing
    found = []
    for r in rules:
        t0 = time.perf_counter()
        row = sample.agg(F.count_if(r.fails(F.col("text"))).alias("k"), F.count("*").alias("n")).first()
        found.append({"name": r.name, "seconds": time.perf_counter() - t0, "rejected": row["k"], "rows": row["n"]})
    drop(docs.sparkSession, sample)
    return sorted(found, key=lambda x: -x["rejected"] / max(x["seconds"], 1e-9)) if total else found


def cascade(measured: DataFrame, rules: tuple[Rule, ...], order: list[str]) -> Column:
    """Name of the first rule, in this order, that a text fails; null if it passes all."""
    by = {r.name: r for r in rules}
    out = None
    for name in order:
        hit = by[name].fails(measured["text"])
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES,
          base: tuple[str, ...] = BASE, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``signals`` plus base_failed (a base rule fails), kept and failed_rule (first in cascade order).

    One row per input row; null, empty and blank texts have no words and fail.  Repeated rows and
    extra columns are allowed (the latter are not carried).
    """
    m = signals(docs, id_col, text_col)
    order = [x["name"] for x in rule_order(docs, id_col, text_col, rules, sample_rows)]
    by = {r.name: r for r in rules}
    failed = None
    for name in base:
        hit = by[name].fails(m["text"])
        failed = hit if failed is None else failed | hit
    m = m.withColumn("base_failed", failed).withColumn("failed_rule", cascade(m, rules, order))
    return m.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
                    "base_failed", F.col("failed_rule").isNull().alias("kept"), "failed_rule")
