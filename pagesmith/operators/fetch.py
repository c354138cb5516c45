"""Data rules of the fetch step over an attempts table (R1-R4, J4, A2, K4 input).

An attempt row is (id, url, fetched_at, status, content_type[, content]).  Only status 200 is a
success; at most ``max_retries + 1`` attempts per URL count, ordered by (fetched_at, id); attempts
after the first success are ignored.  No network access happens here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagesmith.functions.content import EXTENSION_MAP, DEFAULT_EXT, mime_table, object_name
from pagesmith.operators.ordering import numbered
from pagesmith.session import scratch_path
from pagesmith.sources import store

MAX_RETRIES = 3
RETRY_BACKOFF = 0.5
OK = 200


def ranked_attempts(attempts: DataFrame, max_retries: int = MAX_RETRIES, url_col: str = "url",
                    order=("fetched_at", "id")) -> DataFrame:
    """Attempts that count: the first max_retries+1 per URL, numbered 1.. (``attempt_no``).

    ``row_number() <= k`` lets Spark keep only k rows per URL on the map side before the shuffle
    (WindowGroupLimit), so a URL with millions of attempts does not pile up in one task."""
    w = Window.partitionBy(url_col).orderBy(*[F.col(c).asc() for c in order])
    return attempts.withColumn("attempt_no", F.row_number().over(w)) \
        .filter(F.col("attempt_no") <= max_retries + 1)


def retry_outcome(attempts: DataFrame, max_retries: int = MAX_RETRIES, url_col: str = "url",
                  order=("fetched_at", "id")) -> DataFrame:
    """Per URL the outcome (succeeded / failed / pending), attempts used, first success."""
    r = ranked_attempts(attempts, max_retries, url_col, order)
    ok = F.col("status") == OK
    first_ok = F.min(F.when(ok, F.struct("attempt_no", "id", "fetched_at")))
    g = r.groupBy(url_col).agg(F.count(F.lit(1)).alias("_seen"), first_ok.alias("_ok"))
    state = F.when(F.col("_ok").isNotNull(), F.lit("succeeded")) \
        .when(F.col("_seen") >= max_retries + 1, F.lit("failed")).otherwise(F.lit("pending"))
    return g.select(url_col, state.alias("state"),
                    F.coalesce(F.col("_ok.attempt_no"), F.col("_seen")).cast("int").alias("attempts_used"),
                    F.col("_ok.id").alias("success_id"), F.col("_ok.fetched_at").alias("succeeded_at"))


def retry_schedule(outcome: DataFrame, backoff: float = RETRY_BACKOFF, url_col: str = "url") -> DataFrame:
    """R2: pending URLs, the retry number coming next and the wait before it (the first retry
    is immediate: wait = backoff * (attempts used - 1))."""
    p = outcome.filter(F.col("state") == "pending")
    return p.select(url_col, F.col("attempts_used").alias("retry_no"),
                    F.round(F.lit(backoff) * (F.col("attempts_used") - 1), 3).alias("delay_s"))


def successful_fetches(attempts: DataFrame, max_retries: int = MAX_RETRIES, url_col: str = "url",
                       order=("fetched_at", "id")) -> DataFrame:
    """The one stored response per URL: its first success within the allowed attempts."""
    r = ranked_attempts(attempts, max_retries, url_col, order).filter(F.col("status") == OK)
    w = Window.partitionBy(url_col).orderBy("attempt_no")
    return r.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") == 1).drop("_k")


def name_objects(fetches: DataFrame, url_col: str = "url", ct_col: str = "content_type", **kw) -> DataFrame:
    """F10 applied: add ``object_name`` = slug(url) + extension(content type)."""
    return fetches.withColumn("object_name", object_name(url_col, ct_col, **kw))


def latest_object(stored: DataFrame, name_col: str = "object_name", order=("fetched_at", "id")) -> DataFrame:
    """One row per object name, the last write wins (by ``order``, descending)."""
    w = Window.partitionBy(name_col).orderBy(*[F.col(c).desc() for c in order])
    return stored.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") == 1).drop("_k")


def object_name_collisions(stored: DataFrame, name_col: str = "object_name", url_col: str = "url") -> DataFrame:
    """Object names shared by different URLs (they would overwrite each other)."""
    return stored.groupBy(name_col).agg(
        F.countDistinct(url_col).alias("n_urls"), F.min(url_col).alias("first_url"),
        F.max(url_col).alias("last_url")).filter(F.col("n_urls") > 1)


def extension_table(spark, extension_map: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(exact table, case-insensitive MIME table) as small DataFrames for J4."""
    exact = spark.createDataFrame(sorted((extension_map or EXTENSION_MAP).items()), "content_type string, ext string")
    mime = spark.createDataFrame(sorted(mime_table().items()), "content_type string, ext string")
    return exact, mime


def lookup_extension(df: DataFrame, ct_col: str = "content_type", exact: DataFrame | None = None,
                     mime: DataFrame | None = None) -> DataFrame:
    """The extension lookup of F9 as joins, for large custom tables.  The fixed tables (constants of the
    library) are broadcast; for given tables Spark picks the join from their known or measured bytes, and
    adaptive execution splits a hot content type."""
    fixed = extension_table(df.sparkSession)
    own = exact is not None, mime is not None
    exact, mime = exact if exact is not None else fixed[0], mime if mime is not None else fixed[1]
    ex = exact.select(F.col("content_type").alias("_ct_exact"), F.col("ext").alias("_ext1")).dropDuplicates(["_ct_exact"])
    mi = mime.select(F.lower("content_type").alias("_ct_lower"), F.col("ext").alias("_ext2")).dropDuplicates(["_ct_lower"])
    d = df.withColumn("_ct_exact", F.col(ct_col)).withColumn("_ct_lower", F.lower(F.col(ct_col)))
    d = d.join(ex if own[0] else F.broadcast(ex), ["_ct_exact"], "left")
    d = d.join(mi if own[1] else F.broadcast(mi), ["_ct_lower"], "left")
    ext = F.when(F.col(ct_col).isNull(), F.lit(None).cast("string")) \
        .otherwise(F.coalesce("_ext1", "_ext2", F.lit(DEFAULT_EXT)))
    return d.withColumn("ext", ext).drop("_ct_exact", "_ct_lower", "_ext1", "_ext2")


def download_progress(outcome: DataFrame) -> DataFrame:
    """A2: done, total and percent done (two decimals) over the URL outcomes."""
    done = F.count_if(F.col("state") == "succeeded")
    total = F.count(F.lit(1))
    return outcome.agg(done.alias("done"), total.alias("total")).select(
        "done", "total", F.round(F.lit(100.0) * F.col("done") / F.nullif(F.col("total"), F.lit(0)), 2).alias("percent"))


#: Rows of (id, name, url) up to which the winners are broadcast to the bodies (about a hundred bytes each).
BROADCAST_WINNERS = 100_000


def store_plan(attempts: DataFrame, max_retries: int = MAX_RETRIES, content_col: str = "content") -> DataFrame:
    """Attempts -> objects to store: first success per URL, named, last write per name wins.

    Winners are decided on narrow rows and written.  The bodies of failed attempts are left out in the scan; the others
    meet the winners by id, which identifies an attempt (of rows that repeat an id one is taken).  Few winners go to
    the bodies, so that only winners' bodies are moved; many meet them in a shuffle by id."""
    narrow = attempts.drop(content_col)
    won = latest_object(name_objects(successful_fetches(narrow, max_retries)))
    if content_col not in attempts.columns:
        return won
    path = scratch_path(attempts.sparkSession, "winners")
    won.write.parquet(path)
    won = attempts.sparkSession.read.schema(won.schema).parquet(path)
    few = won.count() <= BROADCAST_WINNERS
    bodies = attempts.where(F.col("status") == OK).select("id", content_col)
    return bodies.join(F.broadcast(won) if few else won, "id").select(*won.columns, content_col).dropDuplicates(["id"])


def progress_steps(outcome: DataFrame, url_col: str = "url") -> DataFrame:
    """A2 after every download: (url, done, percent) per success in order of (succeeded_at, success_id); ``percent`` is of all
    URLs.  The running count is taken over sorted ranges, so no task sees all rows."""
    total = outcome.count()
    ok = outcome.where(F.col("state") == "succeeded").select(url_col, "succeeded_at", "success_id")
    steps = numbered(ok, [F.asc("succeeded_at"), F.asc("success_id")], "done")
    return steps.select(url_col, "done", F.round(F.lit(100.0) * F.col("done") / F.lit(total), 2).alias("percent"))


def attempt_state(attempts: DataFrame, max_retries: int = MAX_RETRIES, url_col: str = "url", order=("fetched_at", "id")) -> DataFrame:
    """(url, attempts): of every URL the attempts that count so far, in order, at most ``max_retries + 1``.  States of parts
    of the attempts merge to the state of all of them, however they are split (``merge_states``)."""
    first = ranked_attempts(attempts, max_retries, url_col, order)
    entry = F.struct(*[F.col(c) for c in order], "status")
    return first.groupBy(url_col).agg(F.sort_array(F.collect_list(entry)).alias("attempts"))


def merge_states(max_retries: int = MAX_RETRIES, url_col: str = "url"):
    """The merge of ``store.update_store``: the first attempts of both sides."""
    def merge(stored: DataFrame, new: DataFrame) -> DataFrame:
        lists = F.sort_array(F.array_distinct(F.flatten(F.collect_list("attempts"))))  # two short lists per URL
        return stored.unionByName(new).groupBy(url_col).agg(F.slice(lists, 1, max_retries + 1).alias("attempts"))

    return merge


def state_outcome(state: DataFrame, max_retries: int = MAX_RETRIES, url_col: str = "url") -> DataFrame:
    """R1 from kept states: the columns of ``retry_outcome``."""
    n = F.size("attempts")
    first = F.array_position(F.transform("attempts", lambda a: a["status"] == OK), True).cast("int")
    state_ = F.when(first > 0, F.lit("succeeded")).when(n >= max_retries + 1, F.lit("failed")).otherwise(F.lit("pending"))
    hit = F.when(first > 0, F.get("attempts", first - 1))
    return state.select(url_col, state_.alias("state"), F.when(first > 0, first).otherwise(n).alias("attempts_used"),
                        hit["id"].alias("success_id"), hit["fetched_at"].alias("succeeded_at"))


def fold_attempts(attempts: DataFrame, path: str, max_retries: int = MAX_RETRIES, buckets: int = store.BUCKETS) -> DataFrame:
    """R1 and R2 over runs: folds an increment of attempts into the states kept at ``path`` and gives the outcome of all
    attempts so far.  Increments may come in any split and order, and one that comes twice changes nothing.  Rows without
    a URL are left out."""
    new = attempt_state(attempts.where("url is not null"), max_retries)
    store.update_store(new, path, "url", merge_states(max_retries), buckets)
    return state_outcome(store.read_store(attempts.sparkSession, path, new.schema), max_retries)


def unique_names(named: DataFrame, name_col: str = "object_name", url_col: str = "url") -> DataFrame:
    """R4 resolved: (url, object_name) with a name of its own for every distinct URL.

    The URL that sorts first keeps the name; the k-th of a name's n URLs gets ``-k`` before the extension.  A suffixed name
    may be taken itself: names held without a suffix come first, then the URL that sorts first, and the others try k + n,
    k + 2n and so on until no two are equal.  The result depends on neither order nor partitions.
    Places within a name come from row numbers over sorted ranges, so a name that most URLs share fills no single task.
    """
    spark = named.sparkSession

    def written(df, name):
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def places(df, by):  # 1, 2, 3... of every row within its ``by``, in order of the URL
        rows = numbered(df, [F.asc(by), F.asc("url")], "row")
        groups = rows.groupBy(by).agg(F.min("row").alias("first"), F.count("*").alias("n"))
        return rows.join(groups, by).withColumn("k", F.col("row") - F.col("first") + 1).drop("row", "first")

    d = named.where(F.col(name_col).isNotNull() & F.col(url_col).isNotNull()).select(F.col(url_col).alias("url"), F.col(name_col).alias("base")).distinct()
    ext = F.regexp_extract("base", r"(\.[^.]*)?$", 0)
    suffixed = F.concat(F.expr("left(base, length(base) - length(ext))"), F.lit("-"), F.col("k").cast("string"), F.col("ext"))
    d = written(places(d, "base").withColumn("ext", ext), "names-places")
    taken = written(d.where("k = 1").select("url", F.col("base").alias("object_name")), "names-taken")
    left = d.where("k > 1")
    while not left.isEmpty():
        wish = left.select("url", suffixed.alias("object_name"))
        free = wish.join(taken.select("object_name"), "object_name", "left_anti")
        got = written(free.groupBy("object_name").agg(F.min("url").alias("url")).select("url", "object_name"), "names-got")
        rest = left.join(got.select("url"), "url", "left_anti").withColumn("k", F.col("k") + F.col("n"))
        taken = written(taken.unionByName(got), "names-taken")
        left = written(rest, "names-left")
    return taken.select(F.col("url").alias(url_col), F.col("object_name").alias(name_col))
