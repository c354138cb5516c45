"""The composite jobs: each takes DataFrames or paths and parameters, writes its outputs, and
returns the DataFrames it produced (read back from what was written where a file is the output)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesmith import schemas
from pagesmith.functions.text import language_label
from pagesmith.functions.urls import path_basename
from pagesmith.operators import fetch, langid, markup, pagination, reconcile, records
from pagesmith.session import listed_in_few_tasks, scratch_path
from pagesmith.sources import files, sinks, store

SITE_PREFIX = "https://portal.example.org"


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` from a table in the shared folder: computed once for several outputs."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def job_publishers(facet_pages: DataFrame, out: str, mode: str = markup.PERMISSIVE, key: str = "page_id") -> dict[str, DataFrame]:
    """Facet page(s) -> publishers JSON; ``rejects``: (key, _error) of the pages the parser can't handle, which end the job
    with ``mode='FAILFAST'``.  The pages are parsed once."""
    spark = facet_pages.sparkSession
    parsed = _written(markup.facet_records(facet_pages, keys=(key,), mode=mode), "facet-records")
    pubs = records.project_records(markup.clean_facets(parsed.where("_error is null"), mode=mode), schemas.PUBLISHER)
    sinks.sink_json_single(pubs, out)
    return {"publishers": files.scan_json_batches(spark, out, schemas.PUBLISHER, layout="lines", pattern=None),
            "rejects": parsed.where("_error is not null").select(key, "_error")}


def job_publishers_from_files(spark: SparkSession, html_dir: str, out: str, pattern: str = "*.html") -> dict[str, DataFrame]:
    """The same from a folder of saved search pages; files that aren't UTF-8 are rejects, too."""
    pages, bad = files.html_pages(spark, html_dir, pattern)
    res = job_publishers(pages, out, key="file_name")
    return res | {"rejects": res["rejects"].unionByName(bad)}


def job_listing_urls(spark: SparkSession, publishers_path: str, out: str, prefix: str = SITE_PREFIX,
                     layout: str = "lines", on_missing: str = "drop") -> dict[str, DataFrame]:
    """Publishers JSON -> one listing URL per result page, as a text file; ``rejects``: (record, reason) of text that
    doesn't parse, publishers without a required field, and URLs that have no place for the page number."""
    required = ["name", "url", "article_count"]
    read = lambda need: files.scan_json_batches(
        spark, publishers_path, schemas.PUBLISHER, layout=layout, pattern=None, required=need, on_missing=on_missing)
    pubs = read(required)
    sinks.sink_text_lines(pagination.paginate_urls(pubs, prefix=prefix), "page_url", out)
    record = F.to_json(F.struct(*schemas.PUBLISHER.names))
    lacking = read(None).where(F.array_contains(F.array(*[F.col(f).isNull() for f in required]), True))
    unusable = pagination.invalid_publisher_urls(pubs)
    text = files.json_rejects(spark, publishers_path, schemas.PUBLISHER, layout, None).select("record", F.lit("malformed JSON").alias("reason"))
    rejects = text.unionByName(lacking.select(record.alias("record"), F.lit("missing field").alias("reason"))) \
        .unionByName(unusable.select(record.alias("record"), F.lit("no single search part in the URL").alias("reason")))
    return {"urls": files.scan_url_list(spark, out), "rejects": rejects}


def job_articles(spark: SparkSession, html_dir: str, out: str, batch_size: int = sinks.BATCH_ROWS,
                 pattern: str = "*.html", mode: str = markup.PERMISSIVE, ordered: bool = False) -> dict[str, DataFrame]:
    """Listing HTML files -> article records in JSON batches; ``rejects``: (file_name, _error) of the files that are not UTF-8
    or that the parser can't handle (``mode='FAILFAST'`` ends the job on the latter).  ``ordered``: batches of whole pages
    in the order of their paths.  The files are parsed once."""
    pages, bad = files.html_pages(spark, html_dir, pattern)
    parsed = _written(markup.extract_records(pages, markup.ARTICLE_FIELDS, markup.ARTICLE_CARD, ("path", "file_name"), mode=mode, with_errors=True),
                      "article-records")
    arts = markup.clean_articles(parsed.where("_error is null"), ("path",))
    if ordered:
        sinks.sink_json_batches(arts.select("path", "record_no", *schemas.ARTICLE.names), out, batch_size, ["record_no"], "path")
    else:
        sinks.sink_json_batches(records.project_records(arts, schemas.ARTICLE), out, batch_size)
    back = files.scan_json_batches(spark, out, schemas.ARTICLE, layout="lines").select(schemas.ARTICLE.names)
    rejects = parsed.where("_error is not null").select("file_name", "_error").unionByName(bad)
    return {"articles": back, "rejects": rejects}


def job_articles_stream(spark: SparkSession, html_dir: str, out: str, checkpoint: str, pattern: str = "*.html",
                        files_per_batch: int = 10_000) -> DataFrame:
    """``job_articles`` for a folder that files are dropped into: reads the files that came since the last run with the same
    ``checkpoint`` (a shared folder, required), writes the records of each micro-batch to a folder of its own, and ends.

    A micro-batch that is run again after a failure overwrites its folder, so no file is written twice and none is
    lost.  Files that are not UTF-8, or that the parser can't handle, go to the folder ``out-rejects``.  Names that start
    with '_' or '.' are not seen by a file stream.  Returns all records written so far."""
    if not checkpoint:
        raise ValueError("a checkpoint folder that survives runs is required")
    pages = spark.readStream.schema("value string").option("wholetext", True).option("pathGlobFilter", pattern) \
        .option("maxFilesPerTrigger", files_per_batch).format("text").load(html_dir)
    pages = pages.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))

    def write(batch: DataFrame, number: int) -> None:
        recs = markup.extract_records(batch, markup.ARTICLE_FIELDS, markup.ARTICLE_CARD, ("path",), with_errors=True)
        path = scratch_path(spark, "stream-records")
        recs.write.parquet(path)  # parsed once for both outputs
        recs = spark.read.schema(recs.schema).parquet(path)
        good = markup.clean_articles(recs.where("_error is null"))
        sinks.sink_json_batches(records.project_records(good, schemas.ARTICLE), f"{out}/micro_batch={number}")
        sinks.sink_json_batches(recs.where("_error is not null").select("path", "_error"), f"{out.rstrip('/')}-rejects/micro_batch={number}")

    with listed_in_few_tasks(spark):  # a micro-batch lists each of its files
        query = pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return files.scan_json_batches(spark, out, schemas.ARTICLE, layout="lines").select(schemas.ARTICLE.names)


def job_language(spark: SparkSession, articles_path: str, profile: langid.LanguageProfile, out: str,
                 batch_size: int = sinks.BATCH_ROWS, layout: str = "lines", pattern: str | None = "*.json") -> dict[str, DataFrame]:
    """Article batches -> the same records with a language label (from the title only), and the text that didn't parse."""
    arts = files.scan_json_batches(spark, articles_path, schemas.ARTICLE_LANG, layout=layout, pattern=pattern)
    found = langid.detect_language(arts, profile, "title", out_col="_lang")
    found = found.withColumn("language", language_label("_lang"))
    sinks.sink_json_batches(records.project_records(found, schemas.ARTICLE_LANG), out, batch_size)
    return {"articles": files.scan_json_batches(spark, out, schemas.ARTICLE_LANG, layout="lines"),
            "rejects": files.json_rejects(spark, articles_path, schemas.ARTICLE_LANG, layout, pattern)}


def job_language_filter(spark: SparkSession, articles_path: str, out: str,
                        whitelist=records.LANGUAGE_WHITELIST, layout: str = "lines",
                        pattern: str | None = "*.json") -> dict[str, DataFrame]:
    """Labelled batches -> per-language counts (all rows), the whitelisted records (one JSON) and the text that
    didn't parse."""
    arts = files.scan_json_batches(spark, articles_path, schemas.ARTICLE_LANG, layout=layout, pattern=pattern)
    counts = records.language_counts(arts)
    sinks.sink_json_single(records.filter_language(arts, whitelist), out)
    kept = files.scan_json_batches(spark, out, schemas.ARTICLE_LANG, layout="lines", pattern=None)
    return {"counts": counts, "articles": kept, "rejects": files.json_rejects(spark, articles_path, schemas.ARTICLE_LANG, layout, pattern)}


def job_info_urls(spark: SparkSession, articles_path: str, out: str, layout: str = "lines",
                  pattern: str | None = "*.json") -> dict[str, DataFrame]:
    """Article batches -> info_url list (NULLs dropped), and the text that didn't parse."""
    arts = files.scan_json_batches(spark, articles_path, schemas.ARTICLE, layout=layout, pattern=pattern)
    sinks.sink_text_lines(records.project_info_urls(arts), "info_url", out)
    return {"urls": spark.read.text(out), "rejects": files.json_rejects(spark, articles_path, schemas.ARTICLE, layout, pattern)}


def job_download_links(pages: DataFrame, out: str, batch_size: int = sinks.BATCH_ROWS) -> dict[str, DataFrame]:
    """Article pages (filename, html) -> (filename, url) batches, the misses report and the pages the parser
    rejects.  The pages are parsed once, into a written table that all three come from."""
    spark = pages.sparkSession
    parsed, skipped = markup.meta_links(pages)
    parsed = _written(parsed, "meta-links")
    usable = F.col("url").isNotNull() & (F.col("url") != "")
    sinks.sink_json_batches(parsed.filter(usable).select("filename", "url"), out, batch_size)
    read = files.scan_json_batches(spark, out, schemas.DOWNLOAD_LINK, layout="lines")
    misses = parsed.filter(~usable).select("filename").unionByName(skipped)
    return {"links": read, "misses": misses, "rejects": parsed.filter("_error is not null").select("filename", "_error")}


def job_download_links_from_files(spark: SparkSession, html_dir: str, out: str, pattern: str = "*.html",
                                  batch_size: int = sinks.BATCH_ROWS) -> dict[str, DataFrame]:
    """The same from a folder of HTML files: the file's base name is kept with each link; files that aren't UTF-8 are
    misses and rejects."""
    pages, bad = files.html_pages(spark, html_dir, pattern)
    res = job_download_links(pages.select(path_basename("path").alias("filename"), "html"), out, batch_size)
    bad = bad.select(F.col("file_name").alias("filename"), "_error")
    return res | {"misses": res["misses"].unionByName(bad.select("filename")), "rejects": res["rejects"].unionByName(bad)}


def job_download_urls(spark: SparkSession, links_dir: str, out: str) -> dict[str, DataFrame]:
    """Any files with JSON arrays of {url} -> URL list; bad files are reported and skipped."""
    rows, errors = files.scan_json_tolerant(spark, links_dir, "url")
    sinks.sink_text_lines(records.filter_nonempty_url(rows), "url", out)
    return {"urls": spark.read.text(out), "errors": errors}


def job_store_objects(attempts: DataFrame, out: str, max_retries: int = fetch.MAX_RETRIES, buckets: int = store.BUCKETS) -> dict[str, DataFrame]:
    """Fetch attempts -> object store (last write per name wins; objects of earlier runs into ``out`` stay), the progress
    line, and the progress after every download."""
    sinks.sink_object_store(fetch.store_plan(attempts, max_retries), out, buckets)
    outcome = fetch.retry_outcome(attempts, max_retries)
    return {"objects": sinks.scan_object_store(attempts.sparkSession, out), "progress": fetch.download_progress(outcome),
            "steps": fetch.progress_steps(outcome)}


def job_reconcile(local: DataFrame, remote_listing: DataFrame, prefix: str = "") -> dict[str, DataFrame]:
    """Local names vs an object listing -> delete plan, not-found report, what stays."""
    remote = files.scan_manifest(local.sparkSession, listing=remote_listing, prefix=prefix)
    return {"delete_plan": reconcile.reconcile_uploaded(local, remote),
            "not_found": reconcile.reconcile_missing(local, remote),
            "remaining": reconcile.reconcile_remaining(local, remote)}
