"""Round trips through sources and sinks, and parsers against plain counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorespark.functions import html_dom
from lorespark.operators import parsing
from lorespark.operators import tables as B
from lorespark.operators import titlesearch as T
from lorespark.plans.ask import parse_ask
from lorespark.plans.q_ask import part_corpus
from lorespark.session import scratch, table
from lorespark.sources import sinks, site

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _customer_pages(spark: SparkSession, d: str) -> DataFrame:
    """Customers as pages: half of them in a namespace, some without a text."""
    c = table(spark, d, "customer")
    title = F.concat(F.when(F.col("c_custkey") % 2 == 0, "Help:").otherwise(""), F.regexp_replace("c_name", "#", " "))
    body = F.when(F.col("c_custkey") % 10 != 3, F.concat(F.lit("== "), "c_mktsegment", F.lit(" ==\n城 "), "c_name"))
    return c.select(title.alias("title"), F.lit(0).alias("ns"), F.col("c_custkey").alias("pageid"), F.col("c_custkey").alias("ord"), body.alias("content"))


_SQL_PAGES = """WITH p AS (SELECT c_custkey, (CASE WHEN c_custkey % 2 = 0 THEN 'Help:' ELSE '' END) || replace(c_name, '#', ' ') AS title, CASE WHEN c_custkey % 10 <> 3 THEN '== ' || c_mktsegment || ' ==' || chr(10) || '城 ' || c_name END AS content FROM customer),
f AS (SELECT *, replace(title, ':', '_') || '.wiki' AS path FROM p)
"""


@query(_SQL_PAGES + "SELECT path, md5(content) AS digest FROM f WHERE content <> ''")
def export_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Pages written as files, listed and read again as whole texts; Spark's readers pass over empty files."""
    out = scratch(spark, "site")
    sinks.export_pages(_customer_pages(spark, d), out, "customers")
    return site.texts(spark, f"{out}/pages").select("path", F.md5(F.coalesce("body", F.lit(""))).alias("digest"))


@query(_SQL_PAGES + "SELECT title, path, CAST(strlen(coalesce(content, '')) AS BIGINT) AS bytes FROM f")
def exported_catalogue(spark: SparkSession, d: str) -> DataFrame:
    out = scratch(spark, "site")
    sinks.export_pages(_customer_pages(spark, d), out, "customers")
    return spark.read.schema(site.MANIFEST).json(f"{out}/manifest.jsonl").select("title", "path", "bytes")


@query(_SQL_PAGES + "SELECT path AS name, CAST(strlen(coalesce(content, '')) AS BIGINT) AS size, md5(content) AS digest FROM f WHERE content <> ''")
def zip_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Pages packed into archives, their entries read and extracted, the files read again."""
    packed, out = scratch(spark, "zips"), scratch(spark, "unzipped")
    sinks.pack_pages(T.assign_paths(_customer_pages(spark, d)), packed, archives=4)
    entries = site.zip_entries(spark, packed)
    sinks.extract_archive(entries, out)
    back = site.binary(spark, out).select(F.element_at(F.split("path", "/"), -1).alias("__file"), "content")
    return entries.select("name", "size").join(back, F.regexp_replace(F.url_decode("__file"), r"\+", " ") == F.col("name")).select("name", "size", F.md5("content").alias("digest"))


@query("SELECT title, ns, pageid, redirect, size, md5(content) AS digest FROM sdv_full WHERE title IS NOT NULL")
def jsonl_dump_round_trip(spark: SparkSession, d: str) -> DataFrame:
    out = scratch(spark, "dump")
    table(spark, d, "sdv_full").select("title", "ns", "pageid", "redirect", "size", "content").write.json(out)
    return site.dump(spark, out).select("title", "ns", "pageid", "redirect", "size", F.md5("content").alias("digest"))


@query("SELECT p_brand AS name, CAST(p_partkey AS VARCHAR) AS key, p_name AS value FROM part")
def string_map_pages(spark: SparkSession, d: str) -> DataFrame:
    """One page of JSON per brand, a flat map of part numbers to names."""
    part = table(spark, d, "part")
    pairs = F.map_from_entries(F.collect_list(F.struct(F.col("p_partkey").cast("string"), "p_name")))
    return site.string_maps(part.groupBy(F.col("p_brand").alias("title")).agg(F.to_json(pairs).alias("body")))


@query("SELECT p_partkey, 'Brand' AS enum, CAST(i AS INT) AS key, CASE i WHEN 1 THEN p_brand ELSE p_type END AS label FROM part, (SELECT unnest([1, 2]) AS i)")
def lua_enum_rows(spark: SparkSession, d: str) -> DataFrame:
    code = F.format_string('local p = {}\np.Brand = {"%s", "%s"}\nreturn p', "p_brand", "p_type")
    rows = site.lua_enums(table(spark, d, "part").select("p_partkey", code.alias("code")), "p_partkey", "code")
    return rows.select("p_partkey", F.col("table").alias("enum"), "key", "label")


@query("SELECT ord, title, path, coalesce(bytes, -1) AS bytes FROM (SELECT row_number() OVER (ORDER BY ord) - 1 AS ord, title, path, bytes FROM manifest) WHERE title <> '' AND path <> ''")
def manifest_json_read(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue written as one JSON array, as sites have it, and read with the places of its entries."""
    out = scratch(spark, "manifest")
    rows = table(spark, d, "manifest").select("ord", "title", "ns", "pageid", "path", "bytes")
    entries = F.transform(F.sort_array(F.collect_list(F.struct("ord", "title", "ns", "pageid", "path", "bytes"))), lambda e: F.struct(e["title"].alias("title"), e["ns"].alias("ns"), e["pageid"].alias("pageid"), e["path"].alias("path"), e["bytes"].alias("bytes")))
    rows.agg(F.to_json(entries).alias("value")).coalesce(1).write.text(out)
    return site.manifest(spark, out).select("ord", "title", "path", F.coalesce("bytes", F.lit(-1)).alias("bytes"))


@query(r"""WITH t AS (SELECT rec_no, regexp_replace(content, '(?s)<!--.*?(-->|\z)|<!\[.*?>|<\?.*?>', ' ', 'g') AS c FROM sdv_full),
h AS (SELECT rec_no, lower(unnest(regexp_extract_all(c, '<([A-Za-z][A-Za-z0-9]*)(?:[\s/][^<>]*)?>', 1))) AS tag FROM t)
SELECT rec_no, tag, count(*) AS n FROM h GROUP BY ALL""")
def html_tag_counts(spark: SparkSession, d: str) -> DataFrame:
    """Elements of each tag of the HTML trees of all records."""
    nodes = parsing.html_nodes(table(spark, d, "sdv_full"), "rec_no", "content").where("tag RLIKE '^[a-z]'")
    return nodes.groupBy("rec_no", "tag").agg(F.count("*").alias("n"))


@query(r"""WITH t AS (SELECT rec_no, regexp_replace(content, '(?is)<!--.*?(-->|\z)|<nowiki\b[^>]*>.*?</nowiki\s*>|<pre\b[^>]*>.*?</pre\s*>|<source\b[^>]*>.*?</source\s*>|<syntaxhighlight\b[^>]*>.*?</syntaxhighlight\s*>', chr(1), 'g') AS c FROM sdv_full),
l AS (SELECT rec_no, unnest(regexp_extract_all(c, '\[\[((?:[^\[\]]|\[[^\[]|\][^\]])*)\]\]', 1)) AS l FROM t)
SELECT rec_no, count(*) AS links FROM l GROUP BY ALL""")
def wikitext_link_counts(spark: SparkSession, d: str) -> DataFrame:
    links = parsing.wiki_links(table(spark, d, "sdv_full"), "rec_no", "content")
    return links.groupBy("rec_no").agg(F.count("*").alias("links"))


@query(r"""WITH t AS (SELECT rec_no, unnest(string_split(regexp_replace(content, '(?is)<!--.*?(-->|\z)|<nowiki\b[^>]*>.*?</nowiki\s*>|<pre\b[^>]*>.*?</pre\s*>|<source\b[^>]*>.*?</source\s*>|<syntaxhighlight\b[^>]*>.*?</syntaxhighlight\s*>', chr(1), 'g'), chr(10))) AS l FROM sdv_full)
SELECT rec_no, CAST(CASE WHEN regexp_matches(l, '^=+\s*$') THEN least(6, (length(trim(l, chr(32) || chr(13))) - 1) // 2) ELSE least(6, length(regexp_extract(l, '^(=+)', 1))) END AS INT) AS level, count(*) AS n
FROM t WHERE regexp_matches(l, '^={1,6}\s*[^=\s][^\n]*?\s*={1,6}\s*$|^={3,}\s*$') GROUP BY ALL""")
def wikitext_heading_counts(spark: SparkSession, d: str) -> DataFrame:
    nodes = parsing.wiki_nodes(table(spark, d, "sdv_full"), "rec_no", "content").where("kind = 'heading'")
    return nodes.groupBy("rec_no", "level").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_name AS title, p_type AS namespace, CAST(p_partkey AS INT) AS pageid FROM part")
def html_page_meta(spark: SparkSession, d: str) -> DataFrame:
    page = F.format_string('<head><title>%s | site</title></head><div class="breadcrumb">Home &gt; %s &gt; x</div><p>y</p>', "p_name", "p_type")
    rows = table(spark, d, "part").select("p_partkey", F.concat(F.col("p_partkey").cast("string"), F.lit("\n"), page).alias("t"))
    return parsing.rows_of(rows, "p_partkey", "t", lambda t: [html_dom.page_meta(t.partition("\n")[2], f"data/{t.partition(chr(10))[0]}.html")], "title string, namespace string, pageid int")


@query("SELECT p_partkey, '<body><p>' || p_name || '</p></body>' AS page FROM part")
def html_chrome_stripped(spark: SparkSession, d: str) -> DataFrame:
    page = F.format_string('<head><title>%s</title></head><body><div id="nav"><div>%s</div></div><ul class="x breadcrumb"><li>a</li></ul><script>var a;</script><p>%s</p></body>', "p_name", "p_type", "p_name")
    rows = table(spark, d, "part").select("p_partkey", page.alias("t"))
    return parsing.rows_of(rows, "p_partkey", "t", lambda t: [{"page": html_dom.strip_chrome(t)}], "page string")


@query("SELECT p_partkey, '{{#invoke:Part|show|' || p_partkey || '}} and {{#invoke:Part|show|0}}' AS body FROM part")
def placeholder_rewriting(spark: SparkSession, d: str) -> DataFrame:
    body = F.format_string('<part id="%d"></part> and <part id="0"></part>', "p_partkey")
    rows = table(spark, d, "part").select("p_partkey", body.alias("body"))
    return parsing.rewrite_placeholders(rows, "body", [(r'<part id="(\d+)"></part>', r"{{#invoke:Part|show|$1}}")])


@query("""WITH s AS (SELECT p_partkey, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS place FROM part) SELECT p_partkey, place, 'none' AS next FROM s""")
def table_sort_toggle(spark: SparkSession, d: str) -> DataFrame:
    """The second state of a sort toggle: rows by falling number, ties in their order."""
    direction = B.next_direction("asc")
    rows = B.sort_rows(table(spark, d, "part").select("p_partkey", F.col("p_size").cast("string").alias("t")), F.col("t"), "p_partkey", direction)
    return rows.rdd.zipWithIndex().map(lambda x: (x[0]["p_partkey"], x[1] + 1, B.next_direction(direction))).toDF("p_partkey bigint, place bigint, next string")


@query("""SELECT 'part:' || p_partkey AS title FROM part WHERE p_brand = 'Brand#4' AND p_size >= 25""")
def ask_category_and_property(spark: SparkSession, d: str) -> DataFrame:
    """A category condition beside a property, in the strict reading of conditions."""
    manifest, props = part_corpus(spark, d)
    large = manifest.join(props.where("prop = 'P_size' AND CAST(value AS INT) >= 25").select("title"), "title", "left_semi")
    categories = large.select("title", F.lit("Category").alias("prop"), F.lit("Large").alias("value"), F.lit(0).alias("pos"))
    return parse_ask("[[Category:Large]] [[P_brand::Brand#4]]|limit=100000").rows(manifest, props.unionByName(categories.select(*props.columns))).select("title")
