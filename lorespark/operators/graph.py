"""Link graphs: edges, levels from a start, closures, histograms."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lorespark.functions import markup
from lorespark.functions.titles import canonical_title
from lorespark.session import materialise, scratch, ship


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        titles, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        yield pa.record_batch([batch.column(0), pa.array([markup.references(t or "", s) for s, t in zip(titles, texts)], pa.list_(pa.string()))], names=["title", "raw"])


def page_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, kind) of wiki pages (title, content): distinct, without self-links."""
    ship(pages.sparkSession)
    raw = pages.select("title", "content").mapInArrow(_links, "title string, raw array<string>")
    one = raw.select(canonical_title(F.col("title")).alias("src"), F.explode("raw").alias("r"))
    edges = one.select("src", canonical_title(F.col("r")).alias("dst")).where("src <> '' AND dst <> '' AND src <> dst").distinct()
    kind = F.when(F.col("dst").startswith("Category:"), "category_link").when(F.col("dst").startswith("File:"), "file_ref").when(F.col("dst").startswith("Template:"), "template").when(F.col("dst").startswith("Module:"), "invoke").otherwise("wikilink")
    return edges.withColumn("kind", kind)


def kind_counts(edges: DataFrame) -> DataFrame:
    """(kind, links, pages, targets): how many links of each kind there are, on how many pages, to how many titles."""
    return edges.groupBy("kind").agg(F.count("*").alias("links"), F.countDistinct("src").alias("pages"), F.countDistinct("dst").alias("targets"))


def union_edges(*edges: DataFrame) -> DataFrame:
    """Distinct (src, dst) of several edge tables, self-links left out."""
    out = edges[0].select("src", "dst")
    for e in edges[1:]:
        out = out.unionByName(e.select("src", "dst"))
    return out.where("src <> dst").distinct()


def both_ways(edges: DataFrame) -> DataFrame:
    return union_edges(edges, edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def levels(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(node, level, parent): breadth-first from `start` (node) to the last level; of several parents on the level before, the least.

    Each round joins the frontier with the edges and drops what was seen. What a round finds is
    appended to one stored table of all nodes seen, so that neither lineage nor plan grows. Parents
    are aggregated before anything is kept, so a node with very many in-links is one row.
    """
    spark = start.sparkSession
    kind = dict(start.dtypes)["node"]
    edges = materialise(edges.select("src", "dst").distinct())
    path = scratch(spark, "levels")
    begin = start.where("node IS NOT NULL").select("node").distinct().select("node", F.lit(None).cast(kind).alias("parent"))
    begin.write.parquet(f"{path}/level=0")
    depth = 0
    seen = lambda: spark.read.schema(f"node {kind}, parent {kind}, level int").parquet(path)
    front = spark.read.schema(f"node {kind}, parent {kind}").parquet(f"{path}/level=0")
    while not front.isEmpty():
        depth += 1
        reached = front.join(edges, F.col("node") == F.col("src")).groupBy("dst").agg(F.min("src").alias("parent")).where("dst IS NOT NULL")
        new = reached.join(seen().select("node"), F.col("dst") == F.col("node"), "left_anti").select(F.col("dst").alias("node"), "parent")
        new.write.parquet(f"{path}/level={depth}")
        front = spark.read.schema(f"node {kind}, parent {kind}").parquet(f"{path}/level={depth}")
    return seen().select("node", "level", "parent")


def with_unreachable(nodes: DataFrame, reached: DataFrame) -> DataFrame:
    """All nodes with their level, -1 where none."""
    return nodes.select("node").distinct().join(reached, "node", "left").withColumn("level", F.coalesce("level", F.lit(-1)))


def closure(edges: DataFrame) -> DataFrame:
    """(src, dst) for every node that can be reached from another, itself only over a cycle.

    Rounds double the length of the paths they know: what the last round found is extended by all
    that is known, until nothing is new, so a chain of n edges takes log n rounds. The result grows
    with the pairs, so this is for dependency graphs, not for link graphs of whole corpora.
    """
    seen = new = materialise(edges.where("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst").distinct())
    while not new.isEmpty():
        step = seen.select(F.col("src").alias("dst"), F.col("dst").alias("further"))
        new = materialise(new.join(step, "dst").select("src", F.col("further").alias("dst")).distinct().join(seen, ["src", "dst"], "left_anti"))
        seen = materialise(seen.unionByName(new))
    return seen


def closure_tables(requires: DataFrame, tables: DataFrame) -> DataFrame:
    """(module, tables): the sorted names of the tables of a module and of all that it requires."""
    own = tables.select(F.col("module").alias("src"), "table_name")
    reach = closure(requires).join(tables.select(F.col("module").alias("dst"), "table_name"), "dst").select("src", "table_name")
    return own.unionByName(reach).groupBy(F.col("src").alias("module")).agg(F.sort_array(F.collect_set("table_name")).alias("tables"))


def histogram(df: DataFrame, value: str) -> DataFrame:
    """(value, n, pct, cumulative_pct) in the order of the values. The window runs over the few distinct values."""
    counts = df.groupBy(value).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    running = F.sum("n").over(Window.orderBy(value))
    return counts.select(value, "n", F.round(F.col("n") * 100.0 / total, 4).alias("pct"), F.round(running * 100.0 / total, 4).alias("cumulative_pct"))


def degrees(edges: DataFrame) -> DataFrame:
    """(node, out_links, in_links)."""
    both = edges.select(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(edges.select(F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    return both.groupBy("node").agg(F.sum("o").alias("out_links"), F.sum("i").alias("in_links"))
