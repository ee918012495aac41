"""Parsers and expansion over the page dump."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorespark.functions.html_dom import PageRules
from lorespark.operators import census, expansion, parsing
from lorespark.operators import titlesearch as T
from lorespark.sources import site
from lorespark.session import table

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _dump(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sdv_full")


@query(r"""WITH t AS (SELECT rec_no, regexp_replace(content, '(?s)<!--.*?(-->|\z)|<!\[.*?>|<\?.*?>', ' ', 'g') AS c FROM sdv_full),
h AS (SELECT rec_no, unnest(regexp_extract_all(c, '(?i)<h([1-6])\b[^>]*>', 1)) AS level FROM t)
SELECT rec_no, CAST(level AS INT) AS level, count(*) AS n FROM h GROUP BY ALL""")
def html_headings(spark: SparkSession, d: str) -> DataFrame:
    nodes = parsing.html_nodes(_dump(spark, d), "rec_no", "content").where(F.col("tag").rlike("^h[1-6]$"))
    return nodes.groupBy("rec_no", F.substring("tag", 2, 1).cast("int").alias("level")).agg(F.count("*").alias("n"))


_SQL_HREFS = r"""WITH t AS (SELECT rec_no, regexp_replace(content, '(?s)<!--.*?(-->|\z)', ' ', 'g') AS c FROM sdv_full),
h AS (SELECT rec_no, substr(unnest(regexp_extract_all(c, '(?i)<a\s[^>]*?href=("/wiki/[^"#]*|''/wiki/[^''#]*)', 1)), 3) AS target FROM t)
"""


@query(_SQL_HREFS + "SELECT rec_no, target, count(*) AS n FROM h GROUP BY ALL")
def link_edges_from_html(spark: SparkSession, d: str) -> DataFrame:
    links = parsing.html_links(_dump(spark, d), "rec_no", "content", "index.html", PageRules(internal_path="wiki/"))
    return links.where("kind = 'link'").groupBy("rec_no", "target").agg(F.count("*").alias("n"))


@query(_SQL_HREFS + r""", k AS (SELECT trim(regexp_replace(replace(title, chr(8206), ''), '[_\s]+', ' ', 'g')) AS name, title, path FROM manifest WHERE title <> '' AND path <> ''),
c AS (SELECT name, min(title) AS title FROM k GROUP BY name)
SELECT DISTINCT rec_no, target, c.title AS resolved FROM (SELECT rec_no, target, trim(regexp_replace(url_decode(substr(target, 6)), '[_\s]+', ' ', 'g')) AS name FROM h) LEFT JOIN c USING (name)""")
def html_links_to_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """The links of HTML parts with the catalogue's title of the page they lead to, null where it has none."""
    links = parsing.html_links(_dump(spark, d), "rec_no", "content", "index.html", PageRules(internal_path="wiki/")).where("kind = 'link'")
    return T.href_titles(links.select("rec_no", "target").distinct(), T.entries(table(spark, d, "manifest")), "wiki/")


@query()
def html_node_tree(spark: SparkSession, d: str) -> DataFrame:
    return parsing.html_nodes(_dump(spark, d), "rec_no", "content").withColumn("attrs", F.to_json("attrs"))


@query()
def html_block_rows(spark: SparkSession, d: str) -> DataFrame:
    return parsing.html_blocks(_dump(spark, d), "rec_no", "content")


@query()
def wikitext_node_rows(spark: SparkSession, d: str) -> DataFrame:
    return parsing.wiki_nodes(_dump(spark, d), "rec_no", "content")


@query(r"""WITH t AS (SELECT rec_no, unnest(regexp_extract_all(regexp_replace(regexp_replace(content, '(?s)<!--.*?(-->|\z)', '', 'g'), '(?s)<nowiki>.*?</nowiki>', 'x', 'g'), '(?s)\{\|.*?\n\|\}', 0)) AS t FROM sdv_full)
SELECT rec_no, CAST(sum(len(regexp_extract_all(t, '(?m)^(?:\| |! )', 0)) + 2 * len(regexp_extract_all(t, '(?m)^! .* !! .* !! ', 0))) AS BIGINT) AS cells FROM t GROUP BY rec_no""")
def wikitext_table_cells(spark: SparkSession, d: str) -> DataFrame:
    return parsing.wiki_cells(_dump(spark, d), "rec_no", "content").groupBy("rec_no").agg(F.count("*").alias("cells"))


@query(r"""WITH t AS (SELECT rec_no, regexp_replace(content, '(?is)<!--.*?(?:-->|\z)|<nowiki\b[^>]*>.*?</nowiki\s*>|<pre\b[^>]*>.*?</pre\s*>|<source\b[^>]*>.*?</source\s*>|<syntaxhighlight\b[^>]*>.*?</syntaxhighlight\s*>', chr(1), 'g') AS c FROM sdv_full),
l AS (SELECT rec_no, trim(split_part(unnest(regexp_extract_all(c, '\[\[((?:[^\[\]]|\[[^\[]|\][^\]])*)\]\]', 1)), '|', 1), chr(32) || chr(9) || chr(10) || chr(13)) AS head FROM t),
n AS (SELECT rec_no, head, CASE WHEN contains(head, ':') THEN trim(split_part(head, ':', 1)) ELSE '' END AS ns FROM l),
k AS (SELECT rec_no, head, CASE WHEN contains(head, '::') THEN 'property' WHEN regexp_matches(ns, '(?i)^(?:file|image|文件|图像)$') THEN 'file' WHEN regexp_matches(ns, '(?i)^(?:category|分类)$') THEN 'category' WHEN regexp_matches(ns, '^[a-z]{2}$') THEN 'interwiki' ELSE 'internal' END AS kind FROM n)
SELECT rec_no, kind, CASE kind WHEN 'internal' THEN trim(split_part(ltrim(head, ':'), '#', 1)) WHEN 'interwiki' THEN head WHEN 'property' THEN trim(substr(head, strpos(head, '::') + 2)) ELSE trim(substr(head, strpos(head, ':') + 1)) END AS target, count(*) AS n FROM k GROUP BY ALL""")
def wikitext_link_targets(spark: SparkSession, d: str) -> DataFrame:
    """The links of every record by kind and target."""
    return parsing.wiki_links(_dump(spark, d), "rec_no", "content").groupBy("rec_no", "kind", "target").agg(F.count("*").alias("n"))


@query()
def wikitext_link_rows(spark: SparkSession, d: str) -> DataFrame:
    return parsing.wiki_links(_dump(spark, d), "rec_no", "content")


@query()
def template_expansion(spark: SparkSession, d: str) -> DataFrame:
    dump = _dump(spark, d)
    return expansion.expand_pages(dump.where("ns = 0"), dump.where("ns = 10").withColumn("newest", F.struct("dumped_at", "rec_no")), order_col="newest").select("title", "expanded")


@query(r"""WITH m AS (SELECT rec_no, regexp_extract(content, '(?s)p\.data = (\{.*\})\s*return p', 1) AS code FROM sdv_full WHERE ns = 828),
e AS (SELECT rec_no, code, regexp_extract_all(code, '\["([^"]*)"\]\s*=\s*(\d+)', 1) AS k, regexp_extract_all(code, '\["([^"]*)"\]\s*=\s*(\d+)', 2) AS v FROM m),
-- of equal keys the last value counts, in the place of the first
o AS (SELECT rec_no, k, min(i) AS i, arg_max(v, i) AS v FROM (SELECT rec_no, k[i] AS k, v[i] AS v, i FROM (SELECT *, unnest(range(1, len(k) + 1)) AS i FROM e)) GROUP BY rec_no, k),
j AS (SELECT rec_no, '{' || string_agg('"' || k || '": ' || v, ', ' ORDER BY i) || '}' AS json FROM o GROUP BY rec_no)
SELECT e.rec_no, CASE WHEN code <> '' THEN coalesce(json, '{}') END AS json FROM e LEFT JOIN j ON j.rec_no = e.rec_no""")
def module_data_tables(spark: SparkSession, d: str) -> DataFrame:
    code = F.regexp_replace(F.regexp_extract("content", r"(?s)p\.data = (\{.*\})\s*return p", 1), r"^\s*$", "")
    return site.lua_tables(_dump(spark, d).where("ns = 828").withColumn("code", code), "rec_no", "code")


@query(r"""SELECT DISTINCT rec_no, kind, name FROM (SELECT rec_no, 'require' AS kind, unnest(regexp_extract_all(content, 'require\s*\(?\s*["'']([^"'']+)["'']', 1)) AS name FROM sdv_full WHERE ns = 828
UNION ALL SELECT rec_no, 'load_data', unnest(regexp_extract_all(content, 'loadData\s*\(?\s*["'']([^"'']+)["'']', 1)) FROM sdv_full WHERE ns = 828
UNION ALL SELECT rec_no, 'json_page', unnest(regexp_extract_all(content, '["''](JSON:[^"'']+)["'']', 1)) FROM sdv_full WHERE ns = 828
UNION ALL SELECT rec_no, 'sql_table', unnest(regexp_extract_all(content, '(?i)\bfrom\s+([A-Za-z_]\w*)', 1)) FROM sdv_full WHERE ns = 828)""")
def module_harvest(spark: SparkSession, d: str) -> DataFrame:
    return site.harvest(_dump(spark, d).where("ns = 828"), "rec_no", "content")


_SQL_INVOKES = r"""
WITH c AS (SELECT rec_no AS page, unnest(regexp_extract_all(content, '\{\{\s*#invoke\s*:\s*([^|{}]+\|[^|{}]+?)\s*(?:\||\}\})', 1)) AS c FROM sdv_full),
i AS (SELECT DISTINCT page, trim(split_part(c, '|', 1)) AS module, trim(split_part(c, '|', 2)) AS fn FROM c),
m AS (SELECT DISTINCT trim(substr(title, strpos(title, ':') + 1)) AS module, content FROM sdv_full WHERE ns = 828 AND title IS NOT NULL),
t AS (SELECT DISTINCT lower(module) AS k, unnest(regexp_extract_all(content, '(?:require|loadData)\s*\(?\s*["'']([^"'']+)["'']', 1)) AS table_name FROM m),
s AS (SELECT DISTINCT title AS table_name FROM manifest WHERE title <> '' AND path <> ''),
o AS (SELECT k, count(*) AS tables, count(*) FILTER (WHERE s.table_name IS NULL) AS gap FROM t LEFT JOIN s USING (table_name) GROUP BY k),
h AS (SELECT lower(module) AS k, fn, count(DISTINCT page) AS pages, min(page) AS first_page, min(module) AS called FROM i WHERE module <> '' AND fn <> '' GROUP BY ALL),
w AS (SELECT lower(module) AS k, min(module) AS known FROM m GROUP BY ALL)
"""


@query(_SQL_INVOKES + "SELECT coalesce(known, called) || '|' || fn AS handler, pages, first_page, coalesce(tables, 0) AS tables, coalesce(gap, 0) AS gap, CASE WHEN known IS NULL THEN 'unknown' WHEN coalesce(gap, 0) > 0 THEN 'snapshot' ELSE 'local' END AS verdict FROM h LEFT JOIN w USING (k) LEFT JOIN o USING (k)")
def handler_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Module functions that pages call, the data their modules read, and what of it the catalogue lacks."""
    dump = _dump(spark, d)
    modules = dump.where("ns = 828 AND title IS NOT NULL").select(F.trim(F.substr("title", F.instr("title", ":") + 1)).alias("module"), "content")
    read = site.harvest(modules, "module", "content").where("kind IN ('require', 'load_data')").select("module", F.col("name").alias("table_name"))
    return census.handler_coverage(census.page_invokes(dump, "rec_no", "content"), modules, read, T.entries(table(spark, d, "manifest")).select(F.col("title").alias("table_name")))
