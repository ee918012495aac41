"""Property tables: (title, prop, value, pos), multi-valued, values distinct in order of first place."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lorespark.functions.markup import without_opaque
from lorespark.functions.titles import uc_first
from lorespark.session import ship

SCHEMA_VERSION = 1
_ANNOTATION = re.compile(r"\[\[([^\[\]|{}:]+)::([^\[\]|]*)(?:\|[^\[\]]*)?\]\]")
_SET = re.compile(r"\{\{\s*#set\s*:((?:[^{}]|\{\{[^{}]*\}\})*)\}\}", re.I)
_CATEGORY = re.compile(r"\[\[\s*(?:category|分类)\s*:\s*([^\[\]|]+)", re.I)
#: The property under which category membership is kept.
CATEGORY = "Category"


def page_properties(text: str) -> list[tuple[str, str]]:
    """(property, value) of annotations, #set calls and categories in order; empty values are skipped."""
    text = without_opaque(text)
    found: list[tuple[int, str, str]] = [(m.start(), m[1].strip(), m[2].strip()) for m in _ANNOTATION.finditer(text)]
    for m in _SET.finditer(text):
        for k, part in enumerate(m[1].split("|")):
            prop, eq, value = part.partition("=")
            if eq:
                found.append((m.start() + k, prop.strip(), value.strip()))
    found += [(m.start(), CATEGORY, m[1].strip()) for m in _CATEGORY.finditer(text)]
    return [(p[:1].upper() + p[1:], v) for _, p, v in sorted(found, key=lambda x: x[0]) if p and v]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pair = pa.struct([("prop", pa.string()), ("value", pa.string())])
    for batch in batches:
        rows = [[{"prop": p, "value": v} for p, v in page_properties(t or "")] for t in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(rows, pa.list_(pair))], names=["title", "found"])


def properties_of_pages(pages: DataFrame, title_col: str = "title", text_col: str = "content") -> DataFrame:
    """The property table of wikitext pages. Pages of one title share their values."""
    ship(pages.sparkSession)
    raw = pages.select(F.col(title_col).alias("title"), F.col(text_col)).mapInArrow(_extract, "title string, found array<struct<prop:string,value:string>>")
    return distinct_values(raw.select("title", F.posexplode("found").alias("pos", "f")).select("title", "f.prop", "f.value", "pos"))


def distinct_values(props: DataFrame) -> DataFrame:
    """Each value of a title and property once, at its first place; null or empty values are none."""
    kept = props.where(F.col("title").isNotNull() & (F.col("value") != ""))
    return kept.groupBy("title", uc_first(F.col("prop")).alias("prop"), "value").agg(F.min("pos").cast("int").alias("pos"))


def from_columns(df: DataFrame, title: Column, columns: dict[str, str]) -> DataFrame:
    """Unpivots columns (property name -> column name) into a property table; nulls give no row."""
    pairs = F.array(*[F.struct(F.lit(p).alias("prop"), F.col(c).cast("string").alias("value"), F.lit(i).alias("pos")) for i, (p, c) in enumerate(columns.items())])
    return df.select(title.alias("title"), F.inline(pairs)).where("value IS NOT NULL").select("title", "prop", "value", "pos")


def as_map(props: DataFrame) -> DataFrame:
    """(title, props MAP<STRING, ARRAY<STRING>>), values in order."""
    per = props.groupBy("title", "prop").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]).alias("values"))
    return per.groupBy("title").agg(F.map_from_entries(F.collect_list(F.struct("prop", "values"))).alias("props"))


def first_values(props: DataFrame, prop: str) -> DataFrame:
    """(title, value) with the first value of one property."""
    return props.where(F.col("prop") == prop).groupBy("title").agg(F.min_by("value", F.struct("pos", "value")).alias("value"))


def save_snapshot(props: DataFrame, path: str, site: str) -> None:
    """Replaces the materialised table of a site. The committer makes the switch atomic per write."""
    props.withColumns({"schema_version": F.lit(SCHEMA_VERSION), "site": F.lit(site)}).write.mode("overwrite").partitionBy("site").option("partitionOverwriteMode", "dynamic").parquet(path)


def load_snapshot(spark: SparkSession, path: str, site: str) -> DataFrame | None:
    """The table of a site, or None if there is none of this version: then it is to be rebuilt."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        return None
    df = spark.read.parquet(path)
    df = df.where((F.col("schema_version") == SCHEMA_VERSION) & (F.col("site") == site)).select("title", "prop", "value", "pos")
    return None if df.isEmpty() else df


def refresh(props: DataFrame, pages: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilds only the pages whose content changed.

    `known` has (title, digest) of the pages that `props` was built from; returns the new
    property table and the new digests. Pages that are gone lose their properties.
    """
    now = pages.select("title", "content", F.xxhash64("content").alias("digest"))
    changed = now.join(known, ["title", "digest"], "left_anti")
    same = now.join(known, ["title", "digest"], "left_semi").select("title").distinct()
    kept = props.join(same.join(changed.select("title").distinct(), "title", "left_anti"), "title", "left_semi")
    again = pages.join(changed.select("title").distinct(), "title", "left_semi")
    return kept.unionByName(properties_of_pages(again)), now.select("title", "digest").distinct()


def reverse_lookup(props: DataFrame, prop: str, targets: DataFrame) -> DataFrame:
    """(title, referring): for each title of `targets` the pages that have it as a value of `prop`."""
    refs = props.where(F.col("prop") == prop).select(F.col("title").alias("referring"), F.col("value").alias("title"))
    return targets.select("title").join(refs, "title").distinct()


def number_footnotes(refs: DataFrame) -> DataFrame:
    """(page, pos, seq, body): notes numbered by first appearance, one number per name.

    A note without a name has a number of its own. The body of a named note is its first
    non-empty one, wherever it stands.
    """
    named = F.when(F.coalesce("name", F.lit("")) != "", F.concat(F.lit("n:"), F.col("name"))).otherwise(F.concat(F.lit("p:"), F.col("pos").cast("string")))
    keyed = refs.withColumn("key", named)
    first = keyed.groupBy("page", "key").agg(F.min("pos").alias("first_pos"), F.min_by("body", F.when(F.coalesce("body", F.lit("")) != "", F.col("pos"))).alias("first_body"))
    seq = F.dense_rank().over(Window.partitionBy("page").orderBy("first_pos"))
    return keyed.select("page", "pos", "key").join(first.withColumn("seq", seq), ["page", "key"]).select("page", "pos", "seq", F.coalesce("first_body", F.lit("")).alias("body"))
