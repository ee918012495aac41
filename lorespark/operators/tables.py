"""Operations on extracted tables: keyword filter, typed sort, shape, chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorespark.functions.ranking import number_rows, running_sum


def contains_all(hay: Column, query: str) -> Column:
    """Whether all words of the query occur in the text, whatever their case; a blank query keeps all."""
    test = F.lit(True)
    low = F.lower(F.coalesce(hay, F.lit("")))
    for word in query.lower().split():
        test = test & low.contains(word)
    return test


def filter_rows(rows: DataFrame, query: str, text_cols: list[str], header_col: str | None = None) -> DataFrame:
    """Rows whose texts together hold every word; header rows stay."""
    test = contains_all(F.concat_ws(" ", *text_cols), query)
    return rows.where(test | F.coalesce(F.col(header_col), F.lit(False)) if header_col else test)


def typed_key(text: Column, sort_value: Column | None = None) -> list[Column]:
    """Sort keys of a cell: numbers by value before texts. The number leads the text; commas are dropped."""
    shown = F.coalesce(F.nullif(sort_value, F.lit("")), text) if sort_value is not None else text
    number = F.replace(F.regexp_extract(F.trim(shown), r"^[+-]?[\d.,]*\d", 0), F.lit(","), F.lit("")).try_cast("double")
    return [F.when(number.isNotNull(), 0).otherwise(1), number, F.when(number.isNull(), F.coalesce(shown, F.lit("")))]


def sort_rows(rows: DataFrame, text: Column, row_col: str, direction: str = "asc", header_col: str | None = None, sort_value: Column | None = None) -> DataFrame:
    """Header rows first, then by the typed key, ties in the original order; `none` restores that order."""
    if direction not in ("asc", "desc", "none"):
        raise ValueError("direction is asc, desc or none")
    head = [F.coalesce(F.col(header_col), F.lit(False)).desc()] if header_col else []
    if direction == "none":
        return rows.orderBy(*head, row_col)
    keys = typed_key(text, sort_value)
    return rows.orderBy(*head, *[k.asc() if direction == "asc" else k.desc() for k in keys], row_col)


def next_direction(direction: str) -> str:
    return {"asc": "desc", "desc": "none", "none": "asc"}[direction]


def shape(cells: DataFrame) -> DataFrame:
    """Per table: rows, columns (the greatest column end), whether a cell spans rows, and the renderer's thresholds."""
    out = cells.groupBy("table_id").agg(
        F.countDistinct("row_ix").alias("row_count"),
        F.max(F.col("col_ix") + F.col("colspan")).alias("col_count"),
        F.max((F.col("rowspan") > 1).cast("int")).alias("has_rowspan"),
    )
    return out.select("*", (F.col("row_count") >= 10).cast("int").alias("filter_box"), (F.col("col_count") > 7).cast("int").alias("wide"), (F.col("row_count") > 40).cast("int").alias("split_rows"))


def table_heights(cells: DataFrame, least: int = 26) -> DataFrame:
    """Per table the sum over rows of the greatest cell height divided by its row span."""
    per_row = cells.groupBy("table_id", "row_ix").agg(F.greatest(F.lit(least), F.max(F.ceil(F.col("height") / F.col("rowspan")))).alias("h"))
    return per_row.groupBy("table_id").agg(F.sum("h").cast("bigint").alias("total_height"))


def chunk_rows(rows: DataFrame, table_col: str, row_col: str, size: int = 80, boundary_col: str | None = None) -> DataFrame:
    """`chunk`: separator rows begin a new one; without them every `size` rows do. A table of any size is spread over tasks."""
    if boundary_col:
        return running_sum(rows, [table_col], row_col, F.coalesce(F.col(boundary_col), F.lit(False)).cast("int"), "chunk")
    return number_rows(rows, [table_col], row_col, out="__n").withColumn("chunk", F.floor((F.col("__n") - 1) / size).cast("bigint")).drop("__n")


def chunk_spanned_rows(rows: DataFrame, table_col: str, row_col: str, span_col: str, size: int = 80) -> DataFrame:
    """`chunk` of about `size` rows that never cuts through a row span: a block of rows joined by
    spans goes to the chunk in which its first row lies."""
    w = Window.partitionBy(table_col).orderBy(row_col)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    starts = F.coalesce(F.max(F.col(row_col) + F.col(span_col)).over(before), F.lit(-1)) <= F.col(row_col)
    marked = rows.withColumn("__n", F.row_number().over(w) - 1).withColumn("__start", F.when(starts, F.col("__n")))
    first = F.last("__start", ignorenulls=True).over(w)
    return marked.withColumn("chunk", F.floor(first / size).cast("bigint")).drop("__n", "__start")


def sections(lines: DataFrame, doc_col: str, line_col: str, is_heading: Column) -> DataFrame:
    """`section`: 0 before the first heading line, then counted up at each."""
    return running_sum(lines, [doc_col], line_col, is_heading.cast("int"), "section")


def merge_spans(spans: DataFrame, doc_col: str, pos_col: str, style_col: str, text_col: str) -> DataFrame:
    """Neighbouring spans of one style become one: (doc, run, style, text)."""
    w = Window.partitionBy(doc_col).orderBy(pos_col)
    new = (~F.col(style_col).eqNullSafe(F.lag(style_col).over(w)) | F.lag(pos_col).over(w).isNull()).cast("int")
    runs = spans.withColumn("__new", new).withColumn("run", F.sum("__new").over(w).cast("bigint"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(pos_col, text_col))), lambda x: x[text_col]), "")
    return runs.groupBy(doc_col, "run", style_col).agg(text.alias("merged_text"))


def split_pages(lines: DataFrame, doc_col: str, line_col: str, text_col: str, limit: int = 100_000, items: int = 150) -> DataFrame:
    """(doc, part, label, lines): pages of at least `limit` characters with two or more sections, one
    part per section, sections of more than `items` list lines cut after every `items` of them;
    other pages stay one part. A label that occurs again gets a number."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    heading = text.rlike(r"^=+[^=].*=+\s*$|^'{3}[^']+'{3}\s*$")
    marked = sections(lines.withColumn("__h", heading), doc_col, line_col, F.col("__h"))
    size = marked.groupBy(doc_col).agg(F.sum(F.length(text) + 1).alias("__size"), F.max("section").alias("__secs"))
    big = marked.join(size, doc_col).withColumn("__big", (F.col("__size") >= limit) & (F.col("__secs") >= 2))
    in_section = Window.partitionBy(doc_col, "section").orderBy(line_col)
    count = F.sum(text.rlike(r"^[*#]").cast("int")).over(in_section)
    piece = F.when(F.col("__big"), F.floor(F.greatest(count - 1, F.lit(0)) / items)).otherwise(0)
    placed = big.withColumn("__piece", piece).withColumn("__sec", F.when(F.col("__big"), F.col("section")).otherwise(0))
    label = F.min_by(F.when(F.col("__h"), F.regexp_replace(text, r"^[='\s]+|[='\s]+$", "")), F.when(F.col("__h"), F.col(line_col)))
    parts = placed.groupBy(doc_col, "__sec", "__piece").agg(F.coalesce(label, F.lit("")).alias("l"), F.sort_array(F.collect_list(F.struct(line_col, text.alias("t")))).alias("ls"))
    n = F.row_number().over(Window.partitionBy(doc_col, "l").orderBy("__sec", "__piece"))
    part = F.row_number().over(Window.partitionBy(doc_col).orderBy("__sec", "__piece")) - 1
    shown = F.when(n > 1, F.concat("l", F.lit(" ("), n.cast("string"), F.lit(")"))).otherwise(F.col("l"))
    return parts.select(doc_col, part.alias("part"), shown.alias("label"), F.transform("ls", lambda x: x["t"]).alias("lines"))
