"""Counts and coverage over a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the censuses look for.
PATTERNS = {
    "template": r"(?<!\{)\{\{\s*([^{}|#:\[\]<>\n]+?)\s*(?:\||\}\})",
    "invoke": r"\{\{\s*#invoke\s*:\s*([^|{}]+?)\s*(?:\||\}\})",
    "function": r"\{\{\s*(#\w+)\s*:",
    "file": r"(?i)\[\[\s*(?:file|image|文件)\s*:\s*([^\[\]|]+?)\s*[\]|]",
    "stylesheet": r"(?i)<templatestyles[^>]*src\s*=\s*[\"']?([^\"'\s/>]+)",
}
#: Unparsed syntax that must not show in rendered text.
LEAK_MARKS = ["{{", "}}", "[[", "]]", "{|", "|}", "'''", "<nowiki", "<ref", "&nbsp;", "__TOC__"]


#: Characters by which names meet in a fuzzy match.
GRAM = 4


def usage(pages: DataFrame, kind: str, text_col: str = "content") -> DataFrame:
    """(name, uses, pages): how often a pattern names something, and in how many rows."""
    found = pages.select(F.regexp_extract_all(F.col(text_col), F.lit(PATTERNS[kind]), 1).alias("names"))
    per_row = found.select(F.posexplode("names").alias("i", "name"), F.size("names").alias("n"), "names")
    first = F.array_position("names", F.col("name")) == F.col("i") + 1  # the row counts once per name
    return per_row.groupBy("name").agg(F.count("*").alias("uses"), F.sum(first.cast("int")).alias("pages"))


def most_common(counts: DataFrame, n: int, value: str = "uses", name: str = "name") -> DataFrame:
    return counts.orderBy(F.col(value).desc(), name).limit(n)


def coverage(have: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """(total, matched, pct) of the keys of `have` that `known` has."""
    flagged = have.select(key).join(known.select(key).distinct().withColumn("__hit", F.lit(1)), key, "left")
    return flagged.agg(F.count("*").alias("total"), F.count("__hit").alias("matched"), F.round(F.count("__hit") * 100.0 / F.count("*"), 4).alias("pct"))


def missing(have: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of `have` whose key `known` lacks; null keys are missing."""
    return have.join(known.select(key).distinct(), key, "left_anti")


def missing_files(refs: DataFrame, stored: DataFrame) -> DataFrame:
    """File names (name) that are referred to but not stored, templated names left out; both sides in one form."""
    form = lambda c: F.lower(F.regexp_replace(F.trim(c), r"[\s_]+", "_"))
    wanted = refs.where(~F.col("name").rlike(r"[{}<>]")).select(form(F.col("name")).alias("name")).distinct()
    return wanted.join(stored.select(form(F.col("name")).alias("name")).distinct(), "name", "left_anti")


def namespace_counts(dump: DataFrame) -> DataFrame:
    """(ns, total, redirects) per namespace; an unknown redirect flag counts as none."""
    return dump.groupBy("ns").agg(F.count("*").alias("total"), F.count_if(F.coalesce("redirect", F.lit(False))).alias("redirects"))


def extensions(files: DataFrame, path_col: str = "path", bytes_col: str = "bytes") -> DataFrame:
    """(ext, files, total_bytes) by lower-case file extension, '' without one."""
    ext = F.lower(F.regexp_extract(path_col, r"\.([A-Za-z0-9]+)\s*$", 1))
    return files.groupBy(ext.alias("ext")).agg(F.count("*").alias("files"), F.sum(F.coalesce(F.col(bytes_col), F.lit(0))).alias("total_bytes"))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys that occur more than once; an empty result asserts uniqueness."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def latest_by_title(dump: DataFrame, order_col: str) -> DataFrame:
    """The last row of each title, whole. A struct maximum aggregates map-side, so a title with very many rows is no problem."""
    rest = [c for c in dump.columns if c != "title"]
    return dump.groupBy("title").agg(F.max_by(F.struct(*rest), order_col).alias("r")).select("title", "r.*")


def rollup_pages(hits: DataFrame, handler: str, page: str) -> DataFrame:
    """(handler, page, n): each distinct page of a handler and the number of its hits; the list of a
    handler is its rows, so it may have any length."""
    return hits.groupBy(handler, page).agg(F.count("*").alias("n"))


def leaks(rendered: DataFrame, text_col: str, marks: list[str] | None = None) -> DataFrame:
    """Rows with `leaked`, the marks that show in the text; others are left out."""
    marks = marks or LEAK_MARKS
    found = F.filter(F.array(*[F.lit(m) for m in marks]), lambda m: F.contains(F.col(text_col), m))
    return rendered.withColumn("leaked", found).where(F.size("leaked") > 0)


def audit(df: DataFrame, declared: Column, made: Column) -> DataFrame:
    """Rows in which two counts differ."""
    return df.withColumn("declared", declared).withColumn("made", made).where("declared <> made")


def fuzzy_match(names: DataFrame, tables: DataFrame, shared: int = 8) -> DataFrame:
    """(name, table_name): equal, one inside the other, or alike in the first `shared` characters, whatever the case.

    No nested loop over both sides: names meet by equal keys only. What may lie inside the other
    gives its first GRAM characters (or all, if it has fewer), what may hold it every run of one to
    GRAM characters; of those that meet, containment is then tested.
    """
    a = names.select(F.col("name"), F.lower("name").alias("a")).where("a <> ''").distinct()
    b = tables.select(F.col("table_name"), F.lower("table_name").alias("b")).where("b <> ''").distinct()

    def of_length(c: str, n: int) -> Column:
        all_of_them = F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substring(c, i, n))
        return F.when(F.length(c) >= n, all_of_them).otherwise(F.array().cast("array<string>"))

    def runs(c: str) -> Column:
        return F.explode(F.array_distinct(F.flatten(F.array(*[of_length(c, n) for n in range(1, GRAM + 1)]))))

    within = a.select("name", "a", runs("a").alias("k")).join(b.select("table_name", "b", F.left("b", F.lit(GRAM)).alias("k")), "k").where(F.contains("a", "b")).select("name", "table_name")
    around = b.select("table_name", "b", runs("b").alias("k")).join(a.select("name", "a", F.left("a", F.lit(GRAM)).alias("k")), "k").where(F.contains("b", "a")).select("name", "table_name")
    prefix = a.where(F.length("a") >= shared).select("name", F.left("a", F.lit(shared)).alias("k")).join(b.where(F.length("b") >= shared).select("table_name", F.left("b", F.lit(shared)).alias("k")), "k").select("name", "table_name")
    return within.unionByName(around).unionByName(prefix).distinct()


def page_invokes(pages: DataFrame, page_col: str, text_col: str) -> DataFrame:
    """(page, module, fn) of the module calls in a text, each once per page."""
    calls = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(r"\{\{\s*#invoke\s*:\s*([^|{}]+\|[^|{}]+?)\s*(?:\||\}\})"), 1))
    parts = F.split("c", r"\|")
    out = pages.select(F.col(page_col).alias("page"), calls.alias("c")).select("page", F.trim(parts[0]).alias("module"), F.trim(parts[1]).alias("fn"))
    return out.where("module <> '' AND fn <> ''").distinct()


def handler_coverage(invokes: DataFrame, modules: DataFrame, tables: DataFrame, stored: DataFrame) -> DataFrame:
    """(handler, pages, first_page, tables, gap, verdict) of every module function that pages call.

    `invokes` (page, module, fn), `modules` (module), `tables` (module, table_name), `stored`
    (table_name). Module names meet in any case and show as the module spells itself. A handler
    whose tables are all stored is `local`, one that lacks some is `snapshot`, one whose module is
    not there is `unknown`. The pages of a handler are the rows of `rollup_pages`, of any number;
    here they are counted.
    """
    own = modules.groupBy(F.lower("module").alias("k")).agg(F.min("module").alias("known"))
    state = tables.select(F.lower("module").alias("k"), "table_name").distinct().join(stored.select("table_name").distinct().withColumn("there", F.lit(True)), "table_name", "left")
    of = state.groupBy("k").agg(F.count("*").alias("tables"), F.count_if(F.col("there").isNull()).alias("gap"))
    calls = invokes.withColumn("k", F.lower("module")).groupBy("k", "fn").agg(F.countDistinct("page").alias("pages"), F.min("page").alias("first_page"), F.min("module").alias("called"))
    joined = calls.join(own, "k", "left").join(of, "k", "left").fillna(0, ["tables", "gap"])
    verdict = F.when(F.col("known").isNull(), "unknown").when(F.col("gap") > 0, "snapshot").otherwise("local")
    return joined.select(F.concat_ws("|", F.coalesce("known", "called"), "fn").alias("handler"), "pages", "first_page", "tables", "gap", verdict.alias("verdict"))
