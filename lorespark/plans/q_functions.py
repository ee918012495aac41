"""String, expression and page functions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorespark.functions import exprs as X
from lorespark.functions import strings as S
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


@query("""SELECT p_partkey, CASE WHEN strpos(p_name, 'e') > 0 THEN CAST(strpos(p_name, 'e') - 1 AS VARCHAR) ELSE '' END AS pos_e,
substr(p_name, 3, 4) AS mid, right(p_name, 3) AS tail, CASE WHEN length(p_name) > 4 THEN substr(p_name, 2, length(p_name) - 3) ELSE '' END AS cut,
split_part(p_name, ' ', 2) AS second, split_part(p_name, ' ', -1) AS last_word, replace(p_name, 'r', 'RR') AS replaced, length(p_name) AS n FROM part""")
def str_pos_sub_explode(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("p_name")
    return table(spark, d, "part").select(
        "p_partkey", S.position(c, "e").alias("pos_e"), S.sub(c, 2, 4).alias("mid"), S.sub(c, -3).alias("tail"), S.sub(c, 1, -2).alias("cut"),
        S.explode_part(c, " ", 1).alias("second"), S.explode_part(c, " ", -1).alias("last_word"), S.replace_all(c, "r", "RR").alias("replaced"), S.length_of(c).cast("bigint").alias("n"),
    )


@query(r"""SELECT ord, array_to_string(list_slice(string_split(path, '/'), 1, 2), '/') AS first_two, array_to_string(list_slice(string_split(path, '/'), 2, 2), '/') AS second_of_two, '' AS none FROM manifest WHERE path IS NOT NULL""")
def str_titleparts(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("path")
    return table(spark, d, "manifest").where("path IS NOT NULL").select("ord", S.title_parts(p, 2).alias("first_two"), S.title_parts(p, 2, 2).alias("second_of_two"), S.title_parts(p, 0).alias("none"))


@query("""SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'compact' WHEN p_type = 'LARGE' THEN 'big' ELSE 'other' END AS kind FROM part""")
def switch_case_fallthrough(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", S.switch(F.col("p_type"), ["SMALL", " MEDIUM = compact ", "LARGE=big", "#default = other"]).alias("kind"))


@query("""SELECT rec_no, CASE WHEN trim(content) <> '' AND redirect THEN 'r' ELSE 'p' END AS by_text, CASE WHEN trim(CAST(ns AS VARCHAR)) = '0' THEN 'main' ELSE 'other' END AS by_ns,
CASE WHEN contains(content, 'class="error"') OR contains(content, '{{#') THEN 'calls' ELSE 'plain' END AS by_error FROM sdv_full""")
def branch_functions(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sdv_full")
    text = F.when(F.col("redirect"), F.col("content"))
    return s.select("rec_no", S.if_text(text, F.lit("r"), F.lit("p")).alias("by_text"), S.if_equal(F.col("ns"), F.lit("0 "), F.lit("main"), F.lit("other")).alias("by_ns"), S.if_error(F.col("content"), F.lit("calls"), F.lit("plain")).alias("by_error"))


@query("""SELECT m.rec_no, CASE WHEN k.title IS NOT NULL THEN 'yes' ELSE 'no' END AS listed FROM sdv_full m LEFT JOIN (SELECT DISTINCT title FROM manifest WHERE title <> '' AND path <> '') k USING (title)""")
def exists_flag(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "manifest").where("title <> '' AND path <> ''").select("title").distinct().withColumn("hit", F.lit(1))
    return table(spark, d, "sdv_full").select("rec_no", "title").join(known, "title", "left").select("rec_no", F.when(F.col("hit") == 1, "yes").otherwise("no").alias("listed"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
CASE WHEN l_linenumber - 3 = 0 THEN 0 ELSE l_extendedprice / (l_linenumber - 3) END AS divided,
CASE WHEN l_linenumber - 3 = 0 THEN 0 ELSE CAST(l_partkey AS DOUBLE) % (l_linenumber - 3) END AS remainder,
CASE WHEN l_linenumber = 0 THEN 0 ELSE trunc(l_quantity / l_linenumber) END AS whole,
round(l_extendedprice * (1 - l_discount) / 100, 1) AS rounded, CAST(l_quantity * 2 > l_partkey + 1 AS DOUBLE) AS compared, -l_quantity + floor(l_tax * 100) * 2 AS mixed FROM lineitem""")
def expr_arith_round_divzero(spark: SparkSession, d: str) -> DataFrame:
    v = {n: F.col(c) for n, c in (("q", "l_quantity"), ("p", "l_extendedprice"), ("d", "l_discount"), ("t", "l_tax"), ("n", "l_linenumber"), ("k", "l_partkey"))}
    made = {"divided": "p / (n - 3)", "remainder": "k mod (n - 3)", "whole": "q div n", "rounded": "p * (1 - d) / 100 round 1", "compared": "q * 2 > k + 1", "mixed": "-q + floor(t * 100) * 2"}
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", *[X.to_column(X.parse(e), v).alias(n) for n, e in made.items()])


@query("""SELECT CAST(14.0 AS DOUBLE) AS a, CAST(0.0 AS DOUBLE) AS b, CAST(-3.0 AS DOUBLE) AS c, CAST(1.0 AS DOUBLE) AS d, CAST(3.14 AS DOUBLE) AS e, CAST(1200.0 AS DOUBLE) AS f, CAST(-2.0 AS DOUBLE) AS g, CAST(25.0 AS DOUBLE) AS h""")
def expr_constants(spark: SparkSession, d: str) -> DataFrame:
    texts = {"a": "2 + 3 * 4", "b": "abc", "c": "-2.5 round 0", "d": "1 <> 2", "e": "3.14159 round 2", "f": "1234 round -2", "g": "trunc(-2.9)", "h": "(2 + 3) * (1 + 4"}
    return spark.range(1).select(*[X.to_column(X.parse(t)).alias(n) for n, t in texts.items()])


@query("""SELECT ord, title AS fullpagename, CASE WHEN contains(title, ':') THEN split_part(title, ':', 1) ELSE '' END AS namespace, split_part(n, '/', -1) AS pagename,
CASE WHEN contains(n, '/') THEN array_to_string(list_slice(string_split(n, '/'), 1, -2), '/') ELSE n END AS basepagename, split_part(n, '/', 1) AS rootpagename,
CASE WHEN contains(n, '/') THEN substr(n, strpos(n, '/') + 1) ELSE n END AS subpagename
FROM (SELECT *, CASE WHEN contains(title, ':') THEN substr(title, strpos(title, ':') + 1) ELSE title END AS n FROM manifest WHERE title IS NOT NULL)""")
def page_words(spark: SparkSession, d: str) -> DataFrame:
    words = S.page_words(F.col("title"))
    return table(spark, d, "manifest").where("title IS NOT NULL").select("ord", *[c.alias(n) for n, c in words.items()])


@query("""SELECT c_custkey, lower(c_name) AS lc, upper(c_name) AS uc, lower(c_name[1]) || substr(c_name, 2) AS lcfirst, upper(c_mktsegment[1]) || substr(c_mktsegment, 2) AS ucfirst, lower(replace(c_name, '_', ' ')) AS look,
CASE c_nationkey WHEN 10 THEN 'Template' WHEN 14 THEN 'Category' WHEN 0 THEN '' WHEN 1 THEN 'Talk' WHEN 2 THEN 'User' WHEN 4 THEN 'Project' WHEN 6 THEN 'File' WHEN 3 THEN 'User talk' WHEN 8 THEN 'MediaWiki' WHEN 12 THEN 'Help' ELSE CAST(c_nationkey AS VARCHAR) END AS ns,
regexp_replace(replace(c_name, '#', '%23'), ' ', '%20', 'g') AS encoded FROM customer""")
def case_and_code_words(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("c_name")
    return table(spark, d, "customer").select(
        "c_custkey", F.lower(n).alias("lc"), F.upper(n).alias("uc"), S.lc_first(n).alias("lcfirst"), S.uc_first(F.col("c_mktsegment")).alias("ucfirst"),
        S.lookup_key(n).alias("look"), S.canonical_namespace(F.col("c_nationkey").cast("string")).alias("ns"), S.url_encode(n).alias("encoded"),
    )


@query("""WITH a AS (SELECT o_orderkey, string_split(o_orderpriority || '-' || o_orderstatus, '-') AS a FROM orders)
SELECT o_orderkey, coalesce(a[2], '') AS second, coalesce(a[-1], '') AS last_one, coalesce(a[9], '') AS ninth, '' AS zeroth FROM a""")
def array_functions(spark: SparkSession, d: str) -> DataFrame:
    a = S.array_define(F.concat_ws("-", "o_orderpriority", "o_orderstatus"), "-")
    return table(spark, d, "orders").select("o_orderkey", S.array_index(a, 2).alias("second"), S.array_index(a, -1).alias("last_one"), S.array_index(a, 9, "x").alias("ninth"), S.array_index(a, 0).alias("zeroth"))


@query("""WITH a AS (SELECT l_orderkey, list(DISTINCT l_returnflag ORDER BY l_returnflag) AS a FROM lineitem GROUP BY ALL)
SELECT l_orderkey, CASE WHEN len(a) <= 1 THEN array_to_string(a, '') ELSE array_to_string(a[1:len(a) - 1], '、') || '和' || a[-1] END AS pretty,
'* ' || array_to_string(a, chr(10) || '* ') AS bullets, array_to_string(a, chr(10)) AS lines, array_to_string(a, '') AS plain FROM a""")
def list_to_text(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_returnflag")).alias("a"))
    a = F.col("a")
    return rows.select("l_orderkey", S.list_to_text(a).alias("pretty"), S.list_to_text(a, "bullets").alias("bullets"), S.list_to_text(a, "newline").alias("lines"), S.list_to_text(a, "plain").alias("plain"))


@query("""SELECT o_orderkey, format('{:,}', CAST(trunc(o_totalprice) AS BIGINT)) AS grouped, floor(o_totalprice / 10 + 0.5) AS tens FROM orders""")
def number_words(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", S.grouped_thousands(F.col("o_totalprice")).alias("grouped"), S.round_half_up(F.col("o_totalprice") / 10).cast("double").alias("tens"))


@query(r"""SELECT ord, regexp_replace('pages/' || '/' || path, '/+', '/', 'g') AS joined FROM manifest WHERE path IS NOT NULL""")
def path_join(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manifest").where("path IS NOT NULL").select("ord", S.join_path(F.lit("pages/"), F.col("path")).alias("joined"))
