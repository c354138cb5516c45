"""File sources: Spark's own readers, and Arrow batches for folders of whole files.  Contents are only read in tasks."""

from __future__ import annotations

import os
import re
from itertools import islice
from unicodedata import category
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesmith.functions.text import strip_text
from pagesmith.session import TEXT_BATCH, listed_in_few_tasks, scratch_path

BAD_UTF8 = "invalid UTF-8"
NOT_JSON, NOT_ARRAY, BAD_ITEM = "malformed JSON", "not an array of objects", "bad item"
SPARK_MARKS = ("_SUCCESS", "_committed_", "_started_", "_delta_log", "_spark_metadata")
#: What Hadoop's codecs unpack and pyarrow doesn't, or otherwise.
SPARK_UNPACKS = (".deflate", ".lz4", ".snappy", ".zst")
LISTING = "name string, bytes bigint, hidden boolean, spark_only boolean"


def _opener(folder: str):
    """-> (pyarrow's file system, the folder's name there)."""
    from pyarrow import fs

    local = folder.startswith("file:") or "://" not in folder
    return (fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")) if local else fs.FileSystem.from_uri(folder)


def _entries(folder: str):
    """(name, whether it is a folder, bytes) of what a folder holds; entry by entry where it is local."""
    from pyarrow import fs

    where, at = _opener(folder)
    if not isinstance(where, fs.LocalFileSystem):
        for x in where.get_file_info(fs.FileSelector(at)):
            if x.type in (fs.FileType.Directory, fs.FileType.File):
                yield x.base_name, x.type == fs.FileType.Directory, x.size or 0
        return
    with os.scandir(at) as found:
        for x in found:
            try:
                if (is_folder := x.is_dir()) or x.is_file():
                    yield x.name, is_folder, x.stat().st_size
            except FileNotFoundError:  # gone meanwhile
                pass


def _seen(name: str) -> bool:
    """Whether Spark's readers take the name."""
    return name[0] != "." and (name[0] != "_" or "=" in name)


def _partitioned(folder: str, name: str) -> bool:
    """Whether a folder within ``folder`` is a partition folder, or holds one."""
    below = f"{folder}/{name}"
    return _seen(name) and ("=" in name or any(is_folder and _partitioned(below, x) for x, is_folder, _ in _entries(below)))


def _uri_part(name: str) -> str:
    """The name as Java writes it in a URI's path."""
    return "".join(c if c in "_-!.~'()*:@&=+$,;" or (c.isalnum() if c < "\x7f" else category(c) not in ("Zs", "Zl", "Zp", "Cc")) else quote(c) for c in name)


def _listed(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """LISTING of a folder's files, written by one task: Spark's readers would keep every file in the driver, several times.
    ``hidden`` are those that Spark's readers pass over: empty ones, and names that start with '_' or '.' (its own markers and
    checksums are left out).  ``spark_only`` are files that only Spark unpacks; a row without a name stands for partition folders."""
    names = spark._jvm.org.apache.hadoop.fs.GlobPattern("*" + suffix).compiled().pattern()
    path = scratch_path(spark, "listing")

    def rows(folder):
        matches, parts = re.compile(names, re.DOTALL).fullmatch, False
        for name, is_folder, size in _entries(folder):
            if is_folder:
                parts = parts or _partitioned(folder, name)
            elif _seen(name) and size:
                if matches(name) and not name.endswith("._COPYING_"):
                    yield name, size, False, name.endswith(SPARK_UNPACKS)
            elif name.endswith(suffix) and not name.endswith(".crc") and not name.startswith(SPARK_MARKS):
                yield name, size, True, False
        if parts:
            yield None, 0, False, True

    def listed(batches):
        schema = pa.schema([("name", pa.string()), ("bytes", pa.int64()), ("hidden", pa.bool_()), ("spark_only", pa.bool_())])
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = rows(folder)
                while some := [*islice(found, 10_000)]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)

    spark.createDataFrame([(folder,)], "folder string").mapInArrow(listed, LISTING).write.parquet(path)
    return spark.read.schema(LISTING).parquet(path)


def _contents(listed: DataFrame, directory: str, folder: str, uri: str, tasks: int) -> DataFrame:
    """(path, file_name, value) of the listed files, dealt to ``tasks``, with the paths and names that Spark's readers give."""
    def batch_of(rows):
        path, name, value = zip(*rows)
        return pa.record_batch([pa.array(path, pa.string()), pa.array(name, pa.string()), pa.array(value, pa.binary())], ["path", "file_name", "value"])

    def read(batches):
        where, at = _opener(folder)
        for batch in batches:
            rows, size = [], 0
            for name, hidden in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codec = "detect" if hidden else "gzip" if name.endswith(".gz") else "bz2" if name.endswith(".bz2") else None
                with where.open_input_stream(f"{at}/{name}", compression=codec) as f:
                    data = f.read()
                rows.append((f"{directory}/{name}", name, data) if hidden else (f"{uri}/{_uri_part(name)}", _uri_part(name), data))
                size += len(data)
                if size >= TEXT_BATCH:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)

    names = listed.select("name", "hidden").repartition(tasks, "name")
    return names.mapInArrow(read, "path string, file_name string, value binary").withColumn("value", F.col("value").cast("string"))


def _spark_files(spark: SparkSession, directory: str, suffix: str) -> DataFrame:
    df = spark.read.text(directory, wholetext=True, pathGlobFilter="*" + suffix)
    parts = [c for c in df.columns if c != "value"]
    return df.select(*parts, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"), "value")


def whole_files(spark: SparkSession, directory: str, suffix: str = "", every: bool = True) -> DataFrame:
    """(path, file_name, value) of every file of one directory (not recursive) whose name ends with ``suffix``, as one
    string each; empty files and names that start with '_' or '.' are read, too.  Bytes are not checked here: see
    ``is_valid_utf8``.  The files are listed when this is called, by one task into the shared folder; names are dealt to tasks
    that read, and the driver holds none.  Only a directory with discovered partition folders (their columns come first), or
    with files of SPARK_UNPACKS, is read by Spark's reader, whose driver holds every file.  ``every=False`` leaves out
    what Spark's readers pass over, for a store that only Spark can read; it is read by them."""
    if not every:
        return _spark_files(spark, directory, suffix)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(directory)
    store = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not store.exists(hadoop):
        _spark_files(spark, directory, suffix)  # its error
    hadoop = store.makeQualified(hadoop)
    folder, path = hadoop.toString(), hadoop.toUri()
    uri = folder.removesuffix(path.getPath()) + path.getRawPath()
    listed = _listed(spark, folder, suffix)
    found = listed.agg(F.count("name").alias("files"), F.sum("bytes").alias("bytes"), F.bool_or("spark_only").alias("spark_only")).first()
    task_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(found.bytes or 0) // task_bytes))
    contents = lambda names: _contents(names, directory.rstrip("/"), folder, uri.rstrip("/"), max(1, min(tasks, found.files)))
    if not found.spark_only:
        return contents(listed)
    return _spark_files(spark, directory, suffix).unionByName(contents(listed.where("hidden")), allowMissingColumns=True)


def html_pages(spark: SparkSession, directory: str, pattern: str = "*.html") -> tuple[DataFrame, DataFrame]:
    """``scan_html_pages`` and ``html_rejects`` of one listing."""
    files = whole_files(spark, directory, pattern.removeprefix("*"))
    return (files.where(F.is_valid_utf8("value")).withColumnRenamed("value", "html"),
            files.where(~F.is_valid_utf8("value")).select("file_name", F.lit(BAD_UTF8).alias("_error")))


def scan_html_pages(spark: SparkSession, directory: str, pattern: str = "*.html") -> DataFrame:
    """Every file of one directory (not recursive) whose name matches ``*<suffix>``, whole, as one UTF-8 string.
    -> (path, file_name, html).  File order is not defined.  Names that start with '_' or '.' are read as well.  Files
    that are not valid UTF-8 are left out and told by ``html_rejects``."""
    return html_pages(spark, directory, pattern)[0]


def html_rejects(spark: SparkSession, directory: str, pattern: str = "*.html") -> DataFrame:
    """(file_name, _error): the files that ``scan_html_pages`` leaves out."""
    return html_pages(spark, directory, pattern)[1]


def _json(spark: SparkSession, path: str, schema: T.StructType, layout: str, pattern: str | None) -> DataFrame:
    """Parsed rows plus ``_corrupt_record``: the text of a line (or, for arrays, of a file) that doesn't fit."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    r = spark.read.schema(full).option("multiLine", layout == "array").option("mode", "PERMISSIVE")
    with listed_in_few_tasks(spark):
        return (r.option("pathGlobFilter", pattern) if pattern else r).json(path)


def _fits(schema: T.StructType) -> Column:
    # Spark rejects plans that need the corrupt column alone, so a data column is named as well
    return F.col("_corrupt_record").isNull() & (F.concat_ws("", F.col(schema.fields[0].name).cast("string")) >= "")


def scan_json_batches(spark: SparkSession, path: str, schema: T.StructType, layout: str = "array",
                      pattern: str | None = "*.json", required: list[str] | None = None,
                      with_file: bool = False, on_missing: str = "drop", mode: str = "PERMISSIVE") -> DataFrame:
    """All JSON batch files of a directory, rows concatenated, explicit schema (missing key ->
    NULL).  ``layout='array'``: each file is one JSON array of objects (may span lines);
    ``layout='lines'``: one object per line (what ``sink_json_batches`` writes).  Text that doesn't parse is
    never a record: it is left out and found by ``json_rejects``, or ends the job (``mode='FAILFAST'``).
    ``required`` lists fields that must be present and non-null (the strict readers' rule): such rows are
    dropped (``on_missing='drop'``) or end the job with an error (``on_missing='fail'``)."""
    df = _json(spark, path, schema, layout, pattern)
    if with_file:
        df = df.withColumn("file_name", F.col("_metadata.file_name"))
    ok = _fits(schema)
    if mode == "FAILFAST":
        ok = F.when(ok, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("malformed JSON: "), F.left("_corrupt_record", F.lit(80)))).cast("boolean"))
    df = df.filter(ok).drop("_corrupt_record")
    if required:
        ok = F.lit(True)
        for f in required:
            ok = ok & F.col(f).isNotNull()
        if on_missing == "fail":  # evaluated in the filter, so it runs for every row
            err = F.raise_error(F.lit("missing required field among " + ", ".join(required))).cast("boolean")
            df = df.filter(F.when(ok, F.lit(True)).otherwise(err))
        else:
            df = df.filter(ok)
    return df


def json_rejects(spark: SparkSession, path: str, schema: T.StructType, layout: str = "array",
                 pattern: str | None = "*.json") -> DataFrame:
    """(file_name, record): what ``scan_json_batches`` leaves out: lines, or whole array files, that don't parse."""
    df = _json(spark, path, schema, layout, pattern)
    return df.select(F.col("_metadata.file_name").alias("file_name"), "*").filter(~_fits(schema)).select(
        "file_name", F.col("_corrupt_record").alias("record"))


def scan_json_tolerant(spark: SparkSession, directory: str, field: str = "url") -> tuple[DataFrame, DataFrame]:
    """S3: every file of a directory whatever its name, each one a JSON array of objects.
    -> (rows: (file_name, pos, <field>), errors: (file_name, error)).

    Items are read in order, as by a loop that writes values as it goes and gives a file up at the first error:

    - the items before a bad one are kept, and the file has one error row; bad are items that are no object, and values
      that are neither a string nor empty (null, false, 0, "", [], {} and a missing key are empty, and give a null);
    - a file that doesn't parse, or isn't valid UTF-8, gives an error and no row; an empty one doesn't parse;
    - a document that is no array gives an error; an empty object or string gives nothing.

    Each file is parsed to an array of variants, so one very large item list isn't one value.  An object with a repeated
    key doesn't parse here; text after the closing bracket makes the file malformed unless it ends with one, too.
    """
    files = whole_files(spark, directory)
    text = F.col("value")
    blank = " \t\r\n"
    whole = F.is_valid_utf8(text) & F.btrim(text, F.lit(blank)).endswith("]")
    items = F.when(whole, F.from_json(text, "array<variant>"))
    # a value is bad if it is no string and not one of the empty values
    read = f"""transform(items, v -> named_struct('object', schema_of_variant(v) like 'OBJECT%',
        'value', if(schema_of_variant(v) like 'OBJECT%', try_variant_get(v, '$.{field}', 'variant'), null)))"""
    kinds = """transform(read, x -> named_struct('text', if(schema_of_variant(x.value) = 'STRING', try_variant_get(x.value, '$', 'string'), null),
        'bad', not x.object or (x.value is not null and schema_of_variant(x.value) not in ('STRING', 'VOID')
            and coalesce(to_json(x.value) not in ('false', '[]', '{}'), true) and coalesce(try_variant_get(x.value, '$', 'double') <> 0, true))))"""
    parsed = files.select("file_name", text.alias("value"), items.alias("items")).withColumn("read", F.expr(read)).withColumn("items", F.expr(kinds))
    parsed = parsed.withColumn("first_bad", F.array_position(F.col("items.bad"), True))
    good = F.when(F.col("first_bad") > 0, F.slice("items", 1, F.col("first_bad").cast("int") - 1)).otherwise(F.col("items"))
    rows = parsed.where("items is not null").select("file_name", F.posexplode(good).alias("pos", "item")).select(
        "file_name", "pos", F.col("item.text").alias(field))
    nothing = F.regexp_like(text, F.lit(r'\A\s*(\{\s*\}|"")\s*\z'))
    error = (F.when(~F.is_valid_utf8(text), BAD_UTF8).when(F.col("first_bad") > 0, BAD_ITEM).when(F.col("items").isNotNull() | nothing, None)
             .when(F.try_parse_json(F.make_valid_utf8(text)).isNotNull() & ~F.btrim(text, F.lit(blank)).startswith("["), NOT_ARRAY).otherwise(NOT_JSON))
    errors = parsed.select("file_name", error.alias("error")).where("error is not null")
    return rows, errors


def scan_url_list(spark: SparkSession, path: str, drop_blank: bool = False) -> DataFrame:
    """One URL per line, both ends stripped; blank lines kept unless ``drop_blank``."""
    df = spark.read.text(path).select(strip_text("value").alias("url"))
    return df.filter(F.col("url") != "") if drop_blank else df


def scan_manifest(spark: SparkSession, root: str | None = None, listing: DataFrame | None = None,
                  prefix: str = "", col: str = "name") -> DataFrame:
    """Object names under ``prefix``.  Either a given listing table (``listing``, column
    ``col``) or the files below ``root`` (only their paths are read, never their bytes; names are
    relative to ``root``)."""
    if listing is None:
        if root is None:
            raise ValueError("give a listing DataFrame or a root path")
        base = root.rstrip("/") + "/"
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
        rel = F.regexp_replace(F.col("path"), "^.*?" + "\\Q" + base.split("://")[-1].lstrip("/") + "\\E", "")
        listing = files.select(rel.alias(col))
    out = listing.select(F.col(col).alias("name"))
    return out.filter(F.col("name").startswith(prefix)) if prefix else out
