"""Parsers as table functions: one row per page in, one row per node, link or cell out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from lorespark.functions import html_dom, wikitext
from lorespark.session import ship

_CELL = "row_ix int, col_ix int, rowspan int, colspan int, is_header boolean, text string, sort_value string, align string, bgcolor string, width_pct double"
SCHEMAS = {
    "html_nodes": "node_id int, parent_id int, ord int, depth int, tag string, text string, attrs map<string,string>",
    "html_blocks": "kind string, level int, text string",
    "html_cells": f"table_no int, {_CELL}",
    "html_links": "kind string, target string, fragment string, label string",
    "html_gauges": "gauge_no int, row_no int, seg_no int, pct double, class string",
    "wiki_nodes": "node_id int, parent_id int, depth int, kind string, level int, text string",
    "wiki_cells": f"table_no int, {_CELL}",
    "wiki_links": "kind string, target string, fragment string, label string, width int, height int, align string, link string",
    "wiki_footnotes": "pos int, name string, body string",
}


def rows_of(df: DataFrame, id_col: str, text_col: str, parse: Callable[[str], list[dict]], schema: str) -> DataFrame:
    """(id, the columns of `schema`), a row for each that `parse` finds; null texts have none.

    Rows of a page leave together as one array and are flattened in the JVM, so a batch never
    holds more output than its pages have.
    """
    ship(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    arrow = pa.struct(list(to_arrow_schema(_parse_datatype_string(schema))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                found = [[] if t is None else parse(t) for t in batch.column(1).to_pylist()]
                yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(arrow))], names=["__id", "__rows"])

    fields = ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in _parse_datatype_string(schema).fields)
    raw = df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"__id {kind}, __rows array<struct<{fields}>>")
    return raw.select(F.col("__id").alias(id_col), F.inline("__rows"))


def html_nodes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return rows_of(df, id_col, text_col, html_dom.nodes, SCHEMAS["html_nodes"])


def html_blocks(df: DataFrame, id_col: str, text_col: str, rules: html_dom.PageRules = html_dom.PageRules()) -> DataFrame:
    return rows_of(df, id_col, text_col, lambda t: html_dom.blocks(t, rules), SCHEMAS["html_blocks"])


def html_cells(df: DataFrame, id_col: str, text_col: str, rules: html_dom.PageRules = html_dom.PageRules()) -> DataFrame:
    return rows_of(df, id_col, text_col, lambda t: html_dom.table_cells(t, rules), SCHEMAS["html_cells"])


def html_links(df: DataFrame, id_col: str, text_col: str, base: str = "", rules: html_dom.PageRules = html_dom.PageRules()) -> DataFrame:
    return rows_of(df, id_col, text_col, lambda t: html_dom.links(t, base, rules), SCHEMAS["html_links"])


def html_gauges(df: DataFrame, id_col: str, text_col: str, rules: html_dom.PageRules = html_dom.PageRules()) -> DataFrame:
    return rows_of(df, id_col, text_col, lambda t: html_dom.gauges(t, rules), SCHEMAS["html_gauges"])


def wiki_nodes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return rows_of(df, id_col, text_col, wikitext.nodes, SCHEMAS["wiki_nodes"])


def wiki_cells(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return rows_of(df, id_col, text_col, wikitext.table_cells, SCHEMAS["wiki_cells"])


def wiki_links(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return rows_of(df, id_col, text_col, wikitext.links, SCHEMAS["wiki_links"])


def wiki_footnotes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return rows_of(df, id_col, text_col, wikitext.footnotes, SCHEMAS["wiki_footnotes"])


def rewrite_placeholders(df: DataFrame, text_col: str, patterns: list[tuple[str, str]]) -> DataFrame:
    """Placeholder elements of a site replaced by module calls: (pattern, replacement with groups)."""
    text = F.col(text_col)
    for pattern, by in patterns:
        text = F.regexp_replace(text, pattern, by)
    return df.withColumn(text_col, text)
