"""Round trips and the smaller operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorespark.functions import strings as S
from lorespark.operators import expansion, graph, parsing, records, smallfiles
from lorespark.operators import props as P
from lorespark.operators import tables as B
from lorespark.operators import titlesearch as T
from lorespark.plans import ask as A
from lorespark.plans.q_ask import part_corpus
from lorespark.session import scratch, table

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT 'images_manifest' AS listing, name AS title, path, bytes, ord, listed_at FROM images_manifest UNION ALL SELECT 'manifest', title, path, bytes, ord, listed_at FROM manifest")
def p5_merged(spark: SparkSession, d: str) -> DataFrame:
    """Both catalogues written as many small sorted runs, merged into few files, and read again."""
    rest = ["path", "bytes", "ord", "listed_at"]
    rows = table(spark, d, "manifest").select(F.lit("manifest").alias("listing"), "title", *rest).unionByName(table(spark, d, "images_manifest").select(F.lit("images_manifest").alias("listing"), F.col("name").alias("title"), *rest))
    runs, out = scratch(spark, "runs"), scratch(spark, "merged")
    rows.repartition(64, "ord").sortWithinPartitions("listing", "path").write.parquet(runs)
    smallfiles.merge_runs(spark, runs, ["listing", "path"], out, file_bytes=1 << 20)
    return spark.read.parquet(out).drop("out_file", "row_bytes")


@query("""SELECT 'part:' || p_partkey AS title, 'P_brand' AS prop, p_brand AS value, 0 AS pos FROM part UNION ALL SELECT 'part:' || p_partkey, 'P_type', p_type, 1 FROM part
UNION ALL SELECT 'part:' || p_partkey, 'P_size', CAST(p_size AS VARCHAR), 2 FROM part UNION ALL SELECT 'part:' || p_partkey, 'P_name', p_name, 3 FROM part""")
def snapshot_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "snapshot")
    P.save_snapshot(part_corpus(spark, d)[1], path, "parts")
    return P.load_snapshot(spark, path, "parts")


@query("""SELECT 'part:' || p_partkey AS title, 'Brand' AS prop, p_brand AS value FROM part UNION ALL SELECT 'part:' || p_partkey, 'Size', CAST(p_size AS VARCHAR) FROM part""")
def annotation_properties(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("x [[brand::"), F.col("p_brand"), F.lit("|shown]] {{#set:size="), F.col("p_size").cast("string"), F.lit("|none=}} <nowiki>[[a::b]]</nowiki>"))
    pages = table(spark, d, "part").select(F.concat(F.lit("part:"), F.col("p_partkey").cast("string")).alias("title"), text.alias("content"))
    return P.properties_of_pages(pages).select("title", "prop", "value")


@query("""SELECT 'part:' || p_partkey AS title, '<b>' || p_name || '</b>' || CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END || ' ' || (p_size * 2 + 1) || CASE p_type WHEN 'PROMO' THEN ' promo' WHEN 'SMALL' THEN ' promo' ELSE ' other' END AS expanded FROM part""")
def template_call_expansion(spark: SparkSession, d: str) -> DataFrame:
    call = F.concat(F.lit("{{box|"), F.col("p_name"), F.lit("|size="), F.col("p_size").cast("string"), F.lit("|kind="), F.col("p_type"), F.lit("}}"))
    pages = table(spark, d, "part").select(F.concat(F.lit("part:"), F.col("p_partkey").cast("string")).alias("title"), call.alias("content"))
    box = "<b>{{{1}}}</b>{{#ifexpr:{{{size}}} > 25|large|small}} {{#expr:{{{size}}}*2+1}} {{#switch:{{{kind}}}|SMALL|PROMO=promo|other}}<noinclude>doc</noinclude>"
    templates = spark.createDataFrame([("Template:Box", box)], "title string, content string")
    return expansion.expand_pages(pages, templates).select("title", "expanded")


@query("""SELECT o_orderkey AS title, 'a ' || CASE WHEN o_orderstatus = 'F' THEN chr(10) || '* F' || chr(10) ELSE o_orderstatus END || ' z ' AS expanded FROM orders""")
def placeholder_filling(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    pages = o.select(F.col("o_orderkey").alias("title"), F.lit("a @@1@@ z @@2@@").alias("expanded"))
    body = F.when(F.col("o_orderstatus") == "F", "* F").otherwise(F.col("o_orderstatus"))
    return expansion.fill_placeholders(pages, o.select(F.col("o_orderkey").alias("title"), F.lit("1").alias("id"), body.alias("body")))


@query("""SELECT o_orderkey, '[[Customer:' || o_custkey || ']] of ' || o_orderstatus AS stored FROM orders""")
def interpolated_queries(spark: SparkSession, d: str) -> DataFrame:
    text = A.interpolate(F.lit("[[Customer:{{CUST}}]] of {{STATUS}}"), {"CUST": F.col("o_custkey"), "STATUS": F.col("o_orderstatus")})
    return table(spark, d, "orders").select("o_orderkey", text.alias("stored"))


@query("""SELECT p_partkey, 0 AS row_ix, 0 AS col_ix, p_name AS text FROM part UNION ALL SELECT p_partkey, 0, 1, p_brand FROM part UNION ALL SELECT p_partkey, 1, 1, p_type FROM part UNION ALL SELECT p_partkey, 1, 2, CAST(p_size AS VARCHAR) FROM part""")
def html_table_spans(spark: SparkSession, d: str) -> DataFrame:
    html = F.format_string("<table><tr><td rowspan=2>%s<td colspan=2><b>%s</b><tr><td>%s</td><td>%s</table>", "p_name", "p_brand", "p_type", F.col("p_size").cast("string"))
    return parsing.html_cells(table(spark, d, "part").select("p_partkey", html.alias("h")), "p_partkey", "h").select("p_partkey", "row_ix", "col_ix", "text")


@query("""SELECT p_partkey, 0 AS gauge_no, CAST(p_size AS DOUBLE) AS pct FROM part""")
def html_gauges(spark: SparkSession, d: str) -> DataFrame:
    html = F.format_string('<div class="progress"><div class="progress-bar x" style="color:red;width:%d%%"></div></div>', "p_size")
    return parsing.html_gauges(table(spark, d, "part").select("p_partkey", html.alias("h")), "p_partkey", "h").select("p_partkey", "gauge_no", "pct")


@query("""SELECT p_partkey, 'data/' || p_size || '.html' AS target, 's' AS fragment, p_name AS label FROM part""")
def html_link_resolution(spark: SparkSession, d: str) -> DataFrame:
    html = F.format_string('<a href="../data/./%d.html#s">%s</a><a href="http://x/y.html">no</a><a href="#t">no</a>', "p_size", "p_name")
    return parsing.html_links(table(spark, d, "part").select("p_partkey", html.alias("h")), "p_partkey", "h", "ida/1.html").select("p_partkey", "target", "fragment", "label")


@query("""SELECT p_partkey, p_name AS image_title, CAST(p_size AS DOUBLE) AS left_pct, 5.0::DOUBLE AS top_pct FROM part""")
def map_lines(spark: SparkSession, d: str) -> DataFrame:
    from lorespark.functions import wikitext

    line = F.format_string("@@WIKIMAP|a.png|%s|100|200|%d,5@@", "p_name", "p_size")
    rows = parsing.rows_of(table(spark, d, "part").select("p_partkey", line.alias("t")), "p_partkey", "t", lambda t: [r for r in [wikitext.map_rows(t)] if r], "image string, title string, width double, height double, markers array<struct<left:double,top:double>>")
    return rows.select("p_partkey", F.col("title").alias("image_title"), F.inline("markers")).withColumnsRenamed({"left": "left_pct", "top": "top_pct"})


_SQL_CHANNEL = "lpad(to_hex(CAST(greatest(0, least(255, floor(({0} - {1} / 2 + {1} * (CASE WHEN d = 0 THEN 0 ELSE (x[{2}] - lo) / d END)) * 255 + 0.5))) AS BIGINT)), 2, '0')"


def _sql_colour(to: str, span: str) -> str:
    return "'#' || lower(" + " || ".join(_SQL_CHANNEL.format(to, span, i) for i in (1, 2, 3)) + ")"


@query(f"""WITH c AS (SELECT o_orderkey, (o_orderkey * 7919 + 12345) % 16777216 AS n FROM orders),
p AS (SELECT *, [n // 65536 / 255.0::DOUBLE, n // 256 % 256 / 255.0::DOUBLE, n % 256 / 255.0::DOUBLE] AS x, '#' || lower(lpad(to_hex(n), 6, '0')) AS colour FROM c),
l AS (SELECT *, list_min(x) AS lo, list_max(x) - list_min(x) AS d, (list_max(x) + list_min(x)) / 2 AS l FROM p),
s AS (SELECT *, CASE WHEN d = 0 THEN 0 ELSE d / (1 - abs(2 * l - 1)) END AS s, 0.53::DOUBLE + (0.5 - l) * 0.28::DOUBLE AS tl, 0.2::DOUBLE + (l - 0.5) * 0.18::DOUBLE AS gl FROM l),
w AS (SELECT *, (1 - abs(2 * tl - 1)) * least(s, 0.8::DOUBLE) AS ts, (1 - abs(2 * gl - 1)) * (s * 0.55::DOUBLE) AS gs FROM s)
SELECT o_orderkey, CASE WHEN l < 0.5 THEN {_sql_colour("tl", "ts")} ELSE colour END AS shown, CASE WHEN l >= 0.5 THEN {_sql_colour("gl", "gs")} ELSE colour END AS ground FROM w""")
def dark_mode_colours(spark: SparkSession, d: str) -> DataFrame:
    colour = F.concat(F.lit("#"), F.lower(F.lpad(F.hex((F.col("o_orderkey") * 7919 + 12345) % 16777216), 6, "0")))
    return table(spark, d, "orders").select("o_orderkey", S.dark_text_colour(colour).alias("shown"), S.dark_ground_colour(colour).alias("ground"))


@query("""SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS first, split_part(o_orderpriority, '-', 2) AS second FROM orders UNION ALL SELECT o_orderkey, o_orderstatus, '' FROM orders""")
def pairwise_arguments(spark: SparkSession, d: str) -> DataFrame:
    args = F.split(F.concat_ws("-", "o_orderpriority", "o_orderstatus"), "-")
    return table(spark, d, "orders").select("o_orderkey", F.inline(records.pairwise(args)))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey, l_suppkey) AS place FROM lineitem""")
def number_rows_in_slices(spark: SparkSession, d: str) -> DataFrame:
    from lorespark.functions.ranking import number_rows

    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (-F.col("l_quantity")).cast("bigint").alias("o"))
    return number_rows(lines, ["l_orderkey"], "o", ["l_linenumber", "l_partkey", "l_suppkey"], "place", width=10).drop("o")


@query("""WITH s AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS p FROM lineitem GROUP BY ALL),
a AS (SELECT *, coalesce(max(l_linenumber + 1 + p % 3) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) <= l_linenumber AS st, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS n FROM s)
SELECT l_orderkey, l_linenumber, CAST(max(CASE WHEN st THEN n END) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) // 2 AS BIGINT) AS chunk FROM a""")
def chunk_spanned_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg((F.min("l_partkey") % 3 + 1).alias("span"))
    return B.chunk_spanned_rows(rows, "l_orderkey", "l_linenumber", "span", 2).select("l_orderkey", "l_linenumber", "chunk")


@query(r"""WITH l AS (SELECT rec_no, no, coalesce(x[no], '') AS t FROM (SELECT rec_no, unnest(range(1, len(x) + 1)) AS no, x FROM (SELECT rec_no, string_split(content, chr(10)) AS x FROM sdv_full))),
h AS (SELECT *, regexp_matches(t, '^=+[^=].*=+\s*$|^''{3}[^'']+''{3}\s*$') AS h FROM l),
s AS (SELECT *, sum(h::INT) OVER (PARTITION BY rec_no ORDER BY no) AS section, sum(length(t) + 1) OVER (PARTITION BY rec_no) AS size, sum(h::INT) OVER (PARTITION BY rec_no) AS n FROM h),
c AS (SELECT *, size >= 2000 AND n >= 2 AS big, sum(regexp_matches(t, '^[*#]')::INT) OVER (PARTITION BY rec_no, section ORDER BY no) AS items FROM s),
p AS (SELECT rec_no, CASE WHEN big THEN section ELSE 0 END AS sec, CASE WHEN big THEN greatest(items - 1, 0) // 10 ELSE 0 END AS piece, no, t, h FROM c),
g AS (SELECT rec_no, sec, piece, coalesce(arg_min(regexp_replace(t, '^[=''\s]+|[=''\s]+$', '', 'g'), no) FILTER (WHERE h), '') AS label, count(*) AS n_lines, md5(string_agg(t, chr(10) ORDER BY no)) AS digest FROM p GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY rec_no, label ORDER BY sec, piece) AS again, CAST(row_number() OVER (PARTITION BY rec_no ORDER BY sec, piece) - 1 AS INT) AS part FROM g)
SELECT rec_no, part, CASE WHEN again > 1 THEN label || ' (' || again || ')' ELSE label END AS label, n_lines, digest FROM k""")
def page_splitting(spark: SparkSession, d: str) -> DataFrame:
    """The parts of every page; at 2,000 characters and 10 items, for no page of the tables is as long as the default limit."""
    lines = table(spark, d, "sdv_full").select("rec_no", F.posexplode(F.split("content", "\n")).alias("no", "line"))
    parts = B.split_pages(lines, "rec_no", "no", "line", limit=2000, items=10)
    return parts.select("rec_no", "part", "label", F.size("lines").cast("bigint").alias("n_lines"), F.md5(F.array_join("lines", "\n")).alias("digest"))


@query("""WITH RECURSIVE e AS (SELECT p_partkey AS src, p_partkey // 3 AS dst FROM part), r AS (SELECT p_partkey AS title, 0 AS n FROM part WHERE p_brand = 'Brand#4' UNION SELECT e.dst, r.n + 1 FROM r JOIN e ON e.src = r.title WHERE r.n < 20) SELECT DISTINCT title FROM r""")
def dependency_subset(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    edges = part.select(F.col("p_partkey").alias("src"), F.floor(F.col("p_partkey") / 3).cast("bigint").alias("dst"))
    return T.dependency_subset(part.where("p_brand = 'Brand#4'").select(F.col("p_partkey").alias("title")), edges, 20)


@query("""SELECT DISTINCT src, dst FROM (SELECT o_custkey AS src, o_orderkey % 100 AS dst FROM orders UNION ALL SELECT user_id, event_id % 100 FROM events) WHERE src <> dst""")
def union_of_edges(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "orders").select(F.col("o_custkey").alias("src"), (F.col("o_orderkey") % 100).alias("dst"))
    b = table(spark, d, "events").select(F.col("user_id").alias("src"), (F.col("event_id") % 100).alias("dst"))
    return graph.union_edges(a, b)


@query("""SELECT DISTINCT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AND c_custkey IN (SELECT user_id FROM events)""")
def name_set_intersection(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey")
    placed = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(placed, "c_custkey", "left_semi").join(table(spark, d, "events").select(F.col("user_id").alias("c_custkey")), "c_custkey", "left_semi").distinct()
