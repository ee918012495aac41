"""Readers of site folders, catalogues, dumps, archives and data pages."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lorespark.functions import lua
from lorespark.operators.titlesearch import title_from_path
from lorespark.session import ship

MANIFEST = "title string, ns int, pageid bigint, path string, bytes bigint"
DUMP = "title string, ns int, pageid bigint, redirect boolean, size bigint, content string"
SUMMARY = "site string, displayName string, format string, home_title string, total_pages bigint"
DEFAULT_HOME = "首页"


def files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, length, modified) of all files below a folder; contents are not read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return df.select("path", "length", F.col("modificationTime").alias("modified"))


def binary(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "length", "content")


def _relative(path: Column, root: str) -> Column:
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^.*?" + root.rstrip("/").replace("\\", "/").split("/")[-1] + "/", "")


def texts(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path relative to the folder, body) of UTF-8 files, each whole. Empty files give no row, as in all file sources of Spark."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(root, wholetext=True)
    return df.select(_relative(F.col("_metadata.file_path"), root).alias("path"), F.col("value").alias("body"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The catalogue of a site with `ord`, the place in the file; entries without title or path are left out."""
    entries = spark.read.schema(MANIFEST).option("multiLine", "true").json(path)  # entry by entry; one file is one partition
    return entries.withColumn("ord", F.monotonically_increasing_id()).where("title <> '' AND path <> ''")


def manifest_from_files(spark: SparkSession, root: str) -> DataFrame:
    """The catalogue that file paths imply, where there is no manifest."""
    found = files(spark, root).select(_relative(F.col("path"), root).alias("path"), F.col("length").alias("bytes")).where(F.col("path").rlike(r"\.(wiki|html)$"))
    return found.select(title_from_path(F.col("path")).alias("title"), "path", "bytes")


def pages(spark: SparkSession, site_dir: str) -> DataFrame:
    """(title, path, format, body, ord): catalogue joined with the page files; a missing file has a null body, one listed with 0 bytes an empty one."""
    root = f"{site_dir.rstrip('/')}/pages"
    listed = manifest(spark, f"{site_dir.rstrip('/')}/manifest.json")
    joined = listed.join(texts(spark, root), "path", "left").withColumn("body", F.coalesce("body", F.when(F.col("bytes") == 0, F.lit(""))))
    fmt = F.when(F.lower(F.ltrim(F.left(F.col("body"), F.lit(64)))).rlike("^<(!doctype|html)"), "html").otherwise("wiki")
    return joined.select("title", "path", fmt.alias("format"), "body", "ord")


def sites(spark: SparkSession, root: str) -> DataFrame:
    """(name, display_name, total_pages, home_title) of the folders below `root` that hold pages.

    Hidden folders and `cache` are none. The number of sites is that of folders a person made.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if not status.isDirectory() or name.startswith(".") or name == "cache":
            continue
        if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "pages")):
            continue
        summary = {}
        if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "summary.json")):
            row = spark.read.text(status.getPath().toString() + "/summary.json", wholetext=True).first()
            summary = json.loads(row["value"]) if row else {}
        found.append((name, summary.get("displayName") or name, summary.get("total_pages"), summary.get("home_title") or DEFAULT_HOME))
    return spark.createDataFrame(found, "name string, display_name string, total_pages bigint, home_title string")


def dump(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of a page dump; lines that cannot be read are left out."""
    return spark.read.schema(DUMP).json(path).where("title IS NOT NULL")


def json_records(pages_df: DataFrame, schema: str, body_col: str = "body") -> DataFrame:
    """`record` parsed by the schema, null where the page is no JSON."""
    return pages_df.withColumn("record", F.from_json(body_col, schema, {"mode": "PERMISSIVE"}))


def string_maps(pages_df: DataFrame, name_col: str = "title", body_col: str = "body") -> DataFrame:
    """(name, key, value) of pages that hold one flat map of strings."""
    return pages_df.select(F.col(name_col).alias("name"), F.explode(F.from_json(body_col, "map<string,string>")).alias("key", "value"))


def _unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive, content in zip(batch.column(0), batch.column(1)):
            with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                for info in z.infolist():  # entry by entry, so that memory holds one at a time
                    if not info.is_dir():
                        yield pa.record_batch([pa.array([archive.as_py()]), pa.array([info.filename]), pa.array([info.file_size], pa.int64()), pa.array([z.read(info)], pa.binary())], names=["archive", "name", "size", "content"])


def zip_entries(spark: SparkSession, root: str) -> DataFrame:
    """(archive, name, size, content) of every file in the zip archives of a folder, one archive a task."""
    ship(spark)
    return binary(spark, root, "*.zip").select("path", "content").mapInArrow(_unzip, "archive string, name string, size bigint, content binary")


def lua_tables(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, json): Lua literals as JSON; null where the source is no single literal."""
    ship(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()

    def read(source: str | None) -> str | None:
        try:
            return None if source is None else json.dumps(lua.read_table(source), ensure_ascii=False)
        except ValueError:
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([read(s) for s in b.column(1).to_pylist()], pa.string())], names=["id", "json"])

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"id {kind}, json string").withColumnRenamed("id", id_col)


def lua_enums(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    from lorespark.operators.parsing import rows_of

    return rows_of(df, id_col, text_col, lua.enum_rows, "`table` string, key int, label string")


def harvest(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, kind, name): what module code requires, loads and reads, each once."""
    parts = [df.select(F.col(id_col), F.lit(kind).alias("kind"), F.explode(F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(rx), 1))).alias("name")) for kind, rx in lua.HARVEST.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
