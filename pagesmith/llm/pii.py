"""Personal data: candidate spans scored by boosted trees, in native expressions only.

One pass over the texts finds, per kind, the base spans (fixed patterns with their checks) and the candidates
of a broader generator, with some characters of context.  Only these narrow rows are worked on afterwards.

Boosted trees learn from all candidates which of them hold a base span, from format (with checksums and number ranges) and
context.  The learner sees a feature only by its bin, so the candidates are counted by kind, label and bins, and these counts,
few as they are, train it; every kind's counts are scaled to its share of ``TRAIN_CANDIDATES``.  What merely spells a base pattern otherwise, such as
the leading plus of a phone number or the at sign, is no feature.  A base span is thus a labelled positive
and any other candidate is unlabelled, and scores are calibrated for that: the mean score of the labelled ones of
a kind estimates how often a positive is labelled, and a candidate is selected when its score divided by that
reaches the threshold.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagesmith.llm import gbt
from pagesmith.llm.common import drop, hash_sample, table

TRAIN_CANDIDATES, THRESHOLD, CONTEXT = 20_000, 0.5, 24
#: Bins per feature and kind, halved while the counts of binned candidates are more than ``VECTORS`` rows; no candidate is left out.
KIND_BINS, VECTORS = 16, 50_000

KINDS = ("email", "ip", "card", "phone")
# Base patterns, written so that a failed attempt isn't repeated from within the same run of characters.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?=[0-9][\x20-]?[0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# High-recall generators.
LOOSE = {
    "email": r"(?i)[^\s@<>()\[\]\"',;:|]{1,64}(?:@|\s?[\[(]\s?at\s?[\])]\s?)[A-Za-z0-9-]{1,63}(?:(?:\.|\s?[\[(]\s?dot\s?[\])]\s?)[A-Za-z0-9-]{1,63}){0,8}",
    "ip": r"(?<![0-9A-Za-z.:])(?:[0-9]{1,4}(?:\.[0-9]{1,4}){3,5}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7})(?![0-9A-Za-z])",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9])(?:\+|00)?[(]?[0-9](?:[)]?[\x20./-]{0,2}[(]?[0-9]){2,14}[)]?(?![0-9])",
}
#: What a text must hold for a kind to be looked for.
NEEDS = {"email": r"@|(?i)[\[(]\s?at\s?[\])]", "ip": r"[0-9]\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f:]", "card": r"[0-9]", "phone": r"[0-9]"}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CUES = {"phone": r"(?i)(tel|phone|call|fax|mobile|cell|dial|whatsapp)", "email": r"(?i)(mail|contact|write|reach)",
        "card": r"(?i)(card|visa|amex|credit|payment|account)", "ip": r"(?i)(\bip\b|host|server|address|login|client)"}


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    doubled = F.transform(F.split(F.reverse(digits), "(?!^)(?!$)"), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        2 * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: Column, m: Column) -> Column:
    """The checks of a base match; kind by its place in ``KINDS``."""
    n = F.length(_digits(m))
    return (F.when(kind == 0, F.lit(True)).when(kind == 1, m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
            .when(kind == 2, F.when(n.between(16, 19), luhn(_digits(m))).otherwise(False)).otherwise(n.between(8, 15)))


def _with_matches(df: DataFrame, text: str, part: int, kind: int, pattern: str, out: str) -> DataFrame:
    """``df`` plus the leftmost non-overlapping matches, each with its number, the length of the gap before it (the text split
    at matches) and some characters around it."""
    t = F.col(text)
    found = F.when(t.rlike(NEEDS[KINDS[kind]]), F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    df = df.withColumn("m_", found)
    df = df.withColumn("g_", F.when(F.size("m_") > 0, F.split(t, pattern, -1)).otherwise(F.array().cast("array<string>")))
    rows = F.arrays_zip(F.col("m_").alias("m"), F.col("g_").alias("g"), F.slice("g_", 2, F.greatest(F.size("g_"), F.lit(1))).alias("h"))
    match = F.transform(rows, lambda x, i: F.struct(
        F.lit(part).alias("part"), F.lit(kind).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"), x["m"].alias("m"),
        F.right(x["g"], F.lit(CONTEXT)).alias("before"), F.left(x["h"], F.lit(1)).alias("after")))
    return df.withColumn(out, F.filter(match, lambda x: x["m"].isNotNull())).drop("m_", "g_")


def find_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, base, loose): valid base spans and all candidates of every text, as arrays in any order.

    A match starts after the gaps and matches before it.  These are summed up in one sorted pass over the matches as narrow
    rows: appending to an array, match by match, would copy it every time."""
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.monotonically_increasing_id().alias("row"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    parts = [(k, pattern) for patterns in (BASE, LOOSE) for k, pattern in enumerate(patterns.values())]
    for part, (kind, pattern) in enumerate(parts):
        d = _with_matches(d, "t", part, kind, pattern, f"p{part}")
    x = d.select("id", "th", "row", F.explode_outer(F.concat(*(F.col(f"p{k}") for k in range(len(parts))))).alias("x")).select("id", "th", "row", "x.*")
    x = x.repartition("row")  # rows of a text meet once, for its sums and for its lists
    end = F.sum(F.col("gap") + F.length("m")).over(Window.partitionBy("row", "part").orderBy("i")).cast("int")
    x = x.withColumn("e", end).withColumn("s", F.col("e") - F.length("m"))
    span, base = F.struct("kind", "s", "e", "m", "before", "after"), F.col("part") < len(BASE)
    return x.groupBy("row", "id", "th").agg(
        F.collect_list(F.when(base & valid(F.col("kind"), F.col("m")), span)).alias("base"),
        F.collect_list(F.when(~base, span)).alias("loose")).select("id", "th", "base", "loose")


def plausible(kind: Column, m: Column) -> Column:
    """Whether a candidate's content can be of its kind: a domain with a dot, address parts in range, a card
    number's length and check digit, a phone number's length."""
    n = F.length(_digits(m))
    return (F.when(kind == 0, m.rlike(r"(?i)[A-Za-z0-9](?:\.|\s?[\[(]\s?dot)"))
            .when(kind == 1, m.contains(":") | m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
            .when(kind == 2, F.when(n.between(13, 19), luhn(_digits(m))).otherwise(False)).otherwise(n.between(8, 15)))


def candidate_features(c: DataFrame) -> tuple[DataFrame, list[str]]:
    """``c`` (kind, m, before, after) plus format and context features; and their names."""
    m = F.regexp_replace("m", r"^(\+|00)", "")
    groups = F.split(F.regexp_replace(m, r"[^0-9]+", " "), " ")
    last, cue = F.right("before", F.lit(1)), F.lit(None)
    for k, kind in enumerate(KINDS):
        cue = F.when(F.col("kind") == k, F.col("before").rlike(CUES[kind])) if k == 0 else cue.when(F.col("kind") == k, F.col("before").rlike(CUES[kind]))
    side = lambda x: (F.when(x == "", 0).when(x.rlike(r"\s"), 1).when(x.rlike(r"[0-9]"), 2).when(x.rlike(r"\p{L}"), 3)
                      .when(x.rlike(r"[=:\"'#$&%*_]"), 4).otherwise(5))
    count = lambda pattern: F.length(F.regexp_replace(m, pattern, ""))
    cols = {
        "kind": F.col("kind"), "length": F.length(m), "digits": count(r"[^0-9]+"), "letters": count(r"\P{L}+"), "spaces": count(r"[^ ]+"),
        "dots": count(r"[^.]+"), "dashes": count(r"[^-]+"), "brackets": count(r"[^()\[\]]+"), "colons": count(r"[^:]+"), 
        "groups": F.size(groups), "longest": F.array_max(F.transform(groups, lambda x: F.length(x))), "first": F.length(F.get(groups, F.lit(0))),
        "last": F.length(F.element_at(groups, -1)), "before": side(last), "after": side(F.coalesce("after", F.lit(""))),
        "cue": cue.cast("int"), "plausible": plausible(F.col("kind"), F.col("m")).cast("int"), "lead": F.when(m.rlike("^[0-9]"), F.left(m, F.lit(1)).cast("int")).otherwise(-1)}
    names = [f"f_{x}" for x in cols]
    return c.select("*", *(F.coalesce(v.cast("double"), F.lit(0.0)).alias(f"f_{k}") for k, v in cols.items())), names


def shares(counts: dict, total: int) -> dict:
    """How many of each group's rows are taken: ``total`` in equal shares, what small groups leave goes to the others."""
    out, left = {}, total
    for done, (group, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[group] = min(n, left // (len(counts) - done))
        left -= out[group]
    return out


def training_sample(c: DataFrame, names: list[str], total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and weights of up to ``total`` candidates, chosen by a hash in every kind and label.  A
    labelled candidate weighs 1, the others what gives their kind its ratio of labels; so a hot kind takes
    neither rows nor weight from a rare one."""
    counts = {(r["kind"], r["y"]): r["n"] for r in c.groupBy("kind", "y").agg(F.count("*").alias("n")).collect()}
    share = shares(counts, total)
    rows, weight = [], []
    for (kind, y), n in share.items():
        group = c.where((F.col("kind") == kind) & (F.col("y") == y)).select("y", *names, F.xxhash64("id", "th", "s", "e").alias("r"))
        rows += hash_sample(group, n, "r").collect()
        other = (kind, not y)
        back = (counts[kind, y] / n) / (counts[other] / share[other]) if not y and n and share.get(other) else 1.0
        weight += [back] * n
    x = np.array([[r[name] for name in names] for r in rows]).reshape(len(rows), len(names))
    return x, np.array([float(r["y"]) for r in rows]), np.array(weight)


def _bin(name: str, edges: np.ndarray) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, edges.tolist())), lambda x: x < F.col(name)))


def binned_candidates(c: DataFrame, names: list[str], total: int = TRAIN_CANDIDATES, bins: int = KIND_BINS, most: int = VECTORS
                      ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Features (the upper edges of their bins), labels, weights, kinds and bin edges: a row per kind, label and bins that any
    candidate has.  Bins end at each kind's own quantiles.  A row weighs its number of candidates, scaled so that a kind's
    labelled ones have their share of ``total`` and its others keep their ratio to them."""
    counts = {(r["kind"], r["y"]): r["n"] for r in c.groupBy("kind", "y").agg(F.count("*").alias("n")).collect()}
    share = shares(counts, total)
    scale = {k: share[k, (k, True) in counts] / counts[k, (k, True) in counts] for k, _ in counts}
    while True:
        at = [i / bins for i in range(1, bins)]
        cuts = c.groupBy("kind").agg(*(F.percentile(n, at).alias(n) for n in names)).collect()  # a row per kind
        edges = [np.unique(np.array([x for r in cuts for x in r[n]], float)) for n in names]
        binned = [_bin(n, e).alias(n) for n, e in zip(names, edges) if len(e)]
        found = table(c.select("kind", "y", *binned).groupBy("kind", "y", *(n for n, e in zip(names, edges) if len(e))).agg(F.count("*").alias("n_")), "pii-vectors")
        if bins <= 2 or found.count() <= most:
            break
        drop(c.sparkSession, found)
        bins //= 2
    rows = sorted(found.collect(), key=tuple)  # sums of doubles in one order
    tops = [np.append(e, e[-1] + 1) if len(e) else np.zeros(1) for e in edges]
    x = np.array([[top[r[n]] if len(e) else 0.0 for n, e, top in zip(names, edges, tops)] for r in rows], float).reshape(len(rows), len(names))
    return (x, np.array([float(r["y"]) for r in rows]), np.array([r["n_"] * scale[r["kind"]] for r in rows]), np.array([r["kind"] for r in rows], int), edges)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
           sample: int | None = None) -> DataFrame:
    """(id, base, added) per row of ``docs``: arrays of (kind, s, e), positions in code points, end exclusive, sorted
    by kind, start and end.  ``added`` are selected candidates that touch no base span.

    The trees learn from all candidates, or from up to ``sample`` of them if that is given.
    Null, empty and blank texts have none.  Texts are searched whole; the work is in proportion to their length and matches.
    Generators take e-mail names of up to 64 characters and up to nine domain labels of 63; base patterns have no such bounds.  Rows with equal id and text get the same spans; null ids, repeated
    rows and extra columns are allowed.
    """
    found = table(find_spans(docs, id_col, text_col), "pii-found")
    one = lambda column, base: (found.select("id", "th", F.explode_outer(column).alias("x")).where("x is not null")
                                .select("id", "th", F.lit(base).alias("base"), "x.*"))
    both = one("base", True).unionByName(one("loose", False)).distinct()

    def touches(*keys: str) -> Column:
        """A base span of the text (and of the keys' group) overlaps: seen in one sorted pass."""
        w = Window.partitionBy("id", "th", *keys).orderBy("s", "e")
        past, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
        return (F.coalesce(F.max(F.when(F.col("base"), F.col("e"))).over(past) > F.col("s"), F.lit(False))
                | F.coalesce(F.min(F.when(F.col("base"), F.col("s"))).over(ahead) < F.col("e"), F.lit(False)))

    c = both.select("*", touches().alias("touches"), touches("kind").alias("y")).where("not base")
    c, names = candidate_features(c)
    c = table(c.select("id", "th", "kind", "s", "e", "touches", "y", *names), "pii-candidates")

    if sample is None:
        x, y, weight, kinds, edges = binned_candidates(c, names)
        model = gbt.fit(x, y, weight=weight, edges=edges)
    else:
        x, y, weight = training_sample(c, names, sample)
        model, kinds = gbt.fit(x, y, weight=weight), x[:, 0]
    p, known = model.probability(x), [(y == 1) & (kinds == k) for k in range(4)]
    labelled = [float(np.average(p[i], weights=weight[i])) if i.any() else 1.0 for i in known]
    score = 1 / (1 + F.exp(-F.expr(model.sql(names))))
    often = F.get(F.array(*(F.lit(labelled[k]) for k in range(4))), F.col("kind"))
    picked = (c.where(~F.col("touches")).where(score / often >= threshold).groupBy("id", "th")
              .agg(F.collect_set(F.struct("kind", "s", "e")).alias("added")))
    out = found.alias("f").join(picked.alias("p"), F.expr("f.th = p.th and f.id <=> p.id"), "left").select(
        F.col("f.id").alias(id_col), F.array_sort(F.transform("base", lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))).alias("base"),
        F.array_sort(F.coalesce("added", F.array().cast("array<struct<kind:int,s:int,e:int>>"))).alias("added"))
    return out


def as_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")
