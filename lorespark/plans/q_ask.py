"""Semantic queries and catalogue look-ups over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorespark.functions.natsort import natkey
from lorespark.functions.titles import NAMESPACE_ALIASES, canonical_title
from lorespark.operators import props as P
from lorespark.operators import titlesearch as T
from lorespark.plans import ask as A
from lorespark.session import table
from pyspark.sql import Window

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def part_corpus(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Parts as pages `part:<key>` with single-valued properties."""
    part = table(spark, d, "part")
    title = F.concat(F.lit("part:"), F.col("p_partkey").cast("string"))
    manifest = part.select(title.alias("title"), F.col("p_partkey").alias("ord"))
    return manifest, P.from_columns(part, title, {"P_brand": "p_brand", "P_type": "p_type", "P_size": "p_size", "P_name": "p_name"})


def order_corpus(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Orders as pages with the multi-valued properties of their lines."""
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    manifest = orders.select(F.concat(F.lit("order:"), F.col("o_orderkey").cast("string")).alias("title"), F.col("o_orderkey").alias("ord"))
    title = F.concat(F.lit("order:"), F.col("l_orderkey").cast("string"))
    each = F.inline(F.array(*[F.struct(F.lit(p).alias("prop"), F.col(c).cast("string").alias("value"), F.col("l_linenumber").alias("pos")) for p, c in (("flag", "l_returnflag"), ("status", "l_linestatus"), ("supplier", "l_suppkey"))]))
    return manifest, P.distinct_values(lines.select(title.alias("title"), each))


def joined(df: DataFrame) -> DataFrame:
    """Array columns as text."""
    return df.select(*[F.array_join(c, ",").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])


@query("""SELECT 'part:' || p_partkey AS title, p_type AS ptype, CAST(p_size AS VARCHAR) AS psize, row_number() OVER (ORDER BY p_size, p_partkey) AS rank_no
FROM part WHERE p_brand = 'Brand#4' ORDER BY p_size, p_partkey LIMIT 20""")
def ask_ns_filter_sort_limit(spark: SparkSession, d: str) -> DataFrame:
    q = A.parse_ask("[[part:+]] [[p_brand::Brand#4]]|?P_type=ptype|?P_size=psize|sort=P_size|limit=20")
    return joined(q.rows(*part_corpus(spark, d), rank=True)).withColumn("rank_no", F.col("rank_no").cast("bigint"))


@query("SELECT 'part:' || p_partkey AS title, p_name AS named FROM part WHERE p_type = 'PROMO' AND p_size = 7 AND p_brand <> ''")
def ask_multi_filter_and(spark: SparkSession, d: str) -> DataFrame:
    return joined(A.parse_ask("[[part:+]][[P_type::PROMO]][[P_size::7]][[P_brand::+]]|?P_name=named").rows(*part_corpus(spark, d)))


_ORDER_VALUES = """
WITH v AS (SELECT l_orderkey AS k, l_returnflag AS flag, min(l_linenumber) AS pos FROM lineitem GROUP BY ALL),
s AS (SELECT l_orderkey AS k, CAST(l_suppkey AS VARCHAR) AS sup, min(l_linenumber) AS pos FROM lineitem GROUP BY ALL),
f AS (SELECT k, string_agg(flag, ',' ORDER BY pos, flag) AS flags FROM v GROUP BY k),
g AS (SELECT k, string_agg(sup, ',' ORDER BY pos, sup) AS suppliers FROM s GROUP BY k)
"""


@query(_ORDER_VALUES + "SELECT 'order:' || o_orderkey AS title, flags, suppliers FROM orders JOIN f ON f.k = o_orderkey JOIN g ON g.k = o_orderkey WHERE o_orderkey IN (SELECT k FROM v WHERE flag = 'R') AND o_orderkey IN (SELECT k FROM v WHERE flag = 'A')")
def ask_multivalue_contains(spark: SparkSession, d: str) -> DataFrame:
    return joined(A.parse_ask("[[order:+]][[Flag::R]][[Flag::A]]|?flag=flags|?supplier=suppliers").rows(*order_corpus(spark, d)))


@query(_ORDER_VALUES + "SELECT coalesce((SELECT replace(flags, ',', '、') FROM f WHERE k = 5) || '、' || (SELECT replace(suppliers, ',', '、') FROM g WHERE k = 5), '') AS shown")
def ask_single_page_show(spark: SparkSession, d: str) -> DataFrame:
    return A.show(order_corpus(spark, d)[1], "order:5", ["?flag", "?supplier=By#"])


@query("SELECT 'part:' || p_partkey AS title, p_type AS ptype FROM part WHERE p_partkey = 11 AND p_brand <> ''")
def ask_single_page(spark: SparkSession, d: str) -> DataFrame:
    return joined(A.parse_ask("[[part:11]]|?P_type=ptype").rows(*part_corpus(spark, d)))


@query("SELECT 'part:' || p_partkey AS title, p_name AS named FROM part WHERE starts_with('part:' || p_partkey, 'part:1')")
def ask_title_prefix(spark: SparkSession, d: str) -> DataFrame:
    return joined(A.parse_ask("[[~part:1*]]|?P_name=named").rows(*part_corpus(spark, d)))


@query("SELECT count(*) AS n FROM part WHERE p_type = 'SMALL'")
def ask_count(spark: SparkSession, d: str) -> DataFrame:
    return A.parse_ask("[[P_type::SMALL]]|format=count").count(*part_corpus(spark, d))


@query("""SELECT coalesce('{| class="wikitable"' || chr(10) || '! Part' || chr(10) || '! P_type' || chr(10) || '! P_size' || chr(10) || string_agg('|-' || chr(10) || '| [[part:' || p_partkey || '|' || p_partkey || ']]' || chr(10) || '| ' || p_type || chr(10) || '| ' || p_size, chr(10) ORDER BY p_size DESC NULLS LAST, p_partkey) || chr(10) || '|}', '') AS wikitext
FROM (SELECT * FROM part WHERE p_brand = 'Brand#2' AND p_size = 9)""")
def ask_render_table_text(spark: SparkSession, d: str) -> DataFrame:
    return A.parse_ask("[[P_brand::Brand#2]][[P_size::9]]|?P_type|?P_size|mainlabel=Part|sort=P_size").text(*part_corpus(spark, d))


@query("""SELECT coalesce(string_agg('* [[part:' || p_partkey || '|' || p_partkey || ']] • ' || p_name, chr(10) ORDER BY p_partkey), '') AS wikitext FROM part WHERE p_brand = 'Brand#2' AND p_size = 9""")
def ask_render_list_text(spark: SparkSession, d: str) -> DataFrame:
    return A.parse_ask("[[P_brand::Brand#2]][[P_size::9]]|?P_name|format=list").text(*part_corpus(spark, d))


@query("""SELECT coalesce(string_agg('{{Row|part:' || p_partkey || '|P_name=' || p_name || '}}', chr(10) ORDER BY p_partkey), '') AS wikitext FROM part WHERE p_brand = 'Brand#2' AND p_size = 9""")
def ask_render_template_text(spark: SparkSession, d: str) -> DataFrame:
    return A.parse_ask("[[P_brand::Brand#2]][[P_size::9]]|?P_name|format=template|template=Row").text(*part_corpus(spark, d))


@query("""SELECT coalesce(string_agg('<part:' || p_partkey || '> ' || p_name || ' in BRAND#2 (' || CASE WHEN p_partkey % 2 = 0 THEN 'even' ELSE 'odd' END || ')', chr(10) ORDER BY p_partkey), '') AS wikitext FROM part WHERE p_brand = 'Brand#2' AND p_size = 9""")
def ask_template_expanded(spark: SparkSession, d: str) -> DataFrame:
    """Template rows expanded: named values, a nested template, a case word and an arithmetic branch."""
    ask = A.parse_ask("[[P_brand::Brand#2]][[P_size::9]]|?P_name|?P_brand|format=template|template=Row")
    row = "<{{{1}}}> {{Shown|{{{P_name}}}}} in {{uc:{{{P_brand}}}}} ({{#ifexpr:{{#explode:{{{1}}}|:|1}} mod 2|odd|even}})"
    templates = spark.createDataFrame([("Template:Row", row), ("Template:Shown", "{{{1|}}}")], "title string, content string")
    return ask.expanded(*part_corpus(spark, d), templates)


def _nation_corpus(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    nation = table(spark, d, "nation")
    named = lambda df, ns, key, name, of: df.join(nation, F.col(of) == F.col("n_nationkey")).select(F.concat(F.lit(ns + ":"), F.col(name)).alias("title"), F.col(key).cast("bigint").alias("ord"), F.col("n_name").alias("nation"))
    rows = named(table(spark, d, "supplier"), "supplier", "s_suppkey", "s_name", "s_nationkey").unionByName(named(table(spark, d, "customer"), "customer", "c_custkey", "c_name", "c_nationkey"))
    return rows.select("title", "ord"), P.from_columns(rows, F.col("title"), {"Nation": "nation"})


@query("""SELECT n_name AS title, 'supplier:' || s_name AS referring FROM nation JOIN supplier ON s_nationkey = n_nationkey
UNION ALL SELECT n_name, 'customer:' || c_name FROM nation JOIN customer ON c_nationkey = n_nationkey""")
def ask_reverse_lookup(spark: SparkSession, d: str) -> DataFrame:
    return P.reverse_lookup(_nation_corpus(spark, d)[1], "Nation", table(spark, d, "nation").select(F.col("n_name").alias("title")))


@query("""SELECT 'supplier:' || s_name AS title FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_name = 'NATION_3'
UNION ALL SELECT 'customer:' || c_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_3'""")
def ask_union_ns(spark: SparkSession, d: str) -> DataFrame:
    return A.ask_union([A.parse_ask("[[supplier:+]][[Nation::NATION_3]]"), A.parse_ask("[[customer:+]][[Nation::NATION_3]]")], *_nation_corpus(spark, d))


@query("""SELECT event_id, CASE WHEN n_name IS NULL THEN v ELSE '[[' || v || '|' || v || ']]' END AS linked
FROM (SELECT event_id, 'NATION_' || (user_id % 40) AS v FROM events) LEFT JOIN nation ON n_name = v""")
def ask_linkify_values(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_id", F.concat(F.lit("NATION_"), (F.col("user_id") % 40).cast("string")).alias("v"))
    return A.linkify(rows, "v", table(spark, d, "nation").select(F.col("n_name").alias("title"))).select("event_id", "linked")


@query("""SELECT p_brand AS brand, rank() OVER (ORDER BY CAST(substr(p_brand, 7) AS INT)) AS natural_rank, count(*) AS n FROM part GROUP BY p_brand""")
def natural_sort_rank(spark: SparkSession, d: str) -> DataFrame:
    brands = table(spark, d, "part").groupBy(F.col("p_brand").alias("brand")).agg(F.count("*").alias("n"))
    return brands.withColumn("natural_rank", F.rank().over(Window.orderBy(natkey(F.col("brand")))).cast("bigint"))


_ENTRIES = "WITH e AS (SELECT title, arg_max(path, ord) AS path, min(ord) AS ord FROM manifest WHERE title <> '' AND path <> '' GROUP BY title)\n"


@query(_ENTRIES + "SELECT * FROM e")
def manifest_entries(spark: SparkSession, d: str) -> DataFrame:
    return T.entries(table(spark, d, "manifest"))


@query(
    _ENTRIES
    + """, q AS (SELECT title, CASE WHEN contains(title, ':') THEN split_part(title, ':', 1) ELSE '' END AS ns, lower(title) AS t, lower(CASE WHEN contains(title, ':') THEN substr(title, strpos(title, ':') + 1) ELSE title END) AS name FROM e)
SELECT title, CAST(tier AS INT) AS tier FROM (
  SELECT title, CASE WHEN t = 'ga' OR name = 'ga' THEN 1 WHEN starts_with(name, 'ga') AND ns = '' THEN 2 WHEN starts_with(name, 'ga') THEN 3 WHEN contains(t, 'ga') THEN 4 END AS tier
  FROM q WHERE ns <> 'Template')
WHERE tier IS NOT NULL ORDER BY tier, length(title), title LIMIT 50"""
)
def title_search_ranked(spark: SparkSession, d: str) -> DataFrame:
    return T.search(T.entries(table(spark, d, "manifest")), "Ga", 50, ("Template",))


@query(_ENTRIES + "SELECT title, substr(title, 10) AS shown, ord FROM e WHERE starts_with(title, 'Category:')")
def title_prefix_list(spark: SparkSession, d: str) -> DataFrame:
    return T.by_prefix(T.entries(table(spark, d, "manifest")), "Category:", strip=True)


_CANON = r"trim(regexp_replace(regexp_replace(split_part({0}, '#', 1), '[\x{{061c}}\x{{200e}}\x{{200f}}\x{{202a}}-\x{{202e}}\x{{2066}}-\x{{2069}}]', '', 'g'), '[_\s]+', ' ', 'g'))"
_CANON_SQL = (
    "SELECT ord, CASE WHEN regexp_matches(t, '(?i)^(category|分类) ?:') THEN 'Category:' || upper(n[1]) || substr(n, 2) WHEN regexp_matches(t, '(?i)^(file|image|文件) ?:') THEN 'File:' || upper(n[1]) || substr(n, 2) "
    "WHEN regexp_matches(t, '(?i)^(template|模板) ?:') THEN 'Template:' || upper(n[1]) || substr(n, 2) WHEN regexp_matches(t, '(?i)^(module|模块) ?:') THEN 'Module:' || upper(n[1]) || substr(n, 2) "
    "ELSE upper(t[1]) || substr(t, 2) END AS canonical FROM (SELECT ord, t, trim(substr(t, strpos(t, ':') + 1)) AS n FROM (SELECT ord, " + _CANON.format("title") + " AS t FROM manifest WHERE title <> ''))"
)


@query(_CANON_SQL)
def title_normalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manifest").where("title <> ''").select("ord", canonical_title(F.col("title")).alias("canonical"))


@query(r"""SELECT ord, CASE WHEN NOT contains(b, '/') THEN b WHEN starts_with(b, 'Main/') THEN substr(b, 6) ELSE split_part(b, '/', 1) || ':' || substr(b, strpos(b, '/') + 1) END AS path_title
FROM (SELECT ord, regexp_replace(regexp_replace(array_to_string(list_filter(string_split(replace(trim(path), '\', '/'), '/'), lambda s: s <> '' AND s <> '.'), '/'), '^\.?/+', ''), '\.(wiki|html)$', '') AS b FROM manifest WHERE path <> '')""")
def title_from_path(spark: SparkSession, d: str) -> DataFrame:
    from lorespark.operators.smallfiles import normal_path

    return table(spark, d, "manifest").where("path <> ''").select("ord", T.title_from_path(normal_path(F.col("path"))).alias("path_title"))


_UC, _LC = "upper({0}[1]) || substr({0}, 2)", "lower({0}[1]) || substr({0}, 2)"
_NS, _NAME = "split_part({0}, ':', 1) || ':'", "substr({0}, strpos({0}, ':') + 1)"
_VARIANTS = "[b, " + _UC.format("b") + ", " + _LC.format("b") + ", " + ", ".join(f"CASE WHEN strpos(b, ':') > 1 THEN {_NS.format('b')} || {f.format('(' + _NAME.format('b') + ')')} ELSE b END" for f in (_UC, _LC)) + "]"


@query(rf"""
WITH t AS (SELECT DISTINCT title FROM manifest WHERE title <> '' AND path <> ''),
l AS (SELECT DISTINCT trim(regexp_replace(replace(title, chr(8206), ''), '[_\s]+', ' ', 'g')) AS page, unnest(regexp_extract_all(content, '\[\[([^\[\]|{{}}\n]+)', 1)) AS target FROM sdv_full),
c AS (SELECT page, target, trim(regexp_replace(replace(split_part(target, '#', 1), chr(8206), ''), '[_\s]+', ' ', 'g')) AS t FROM l WHERE page IS NOT NULL),
d AS (SELECT *, CASE WHEN strpos(t, ':') > 0 THEN split_part(t, ':', 1) ELSE '' END AS tns, CASE WHEN strpos(page, ':') > 0 THEN split_part(page, ':', 1) ELSE '' END AS pns FROM c),
e AS (SELECT page, target, [CASE WHEN starts_with(t, '/') THEN page || '/' || trim(t, '/') WHEN starts_with(t, '../') THEN regexp_replace(page, '/[^/]*$', '') || substr(t, 3) END, t,
  CASE lower(tns) {" ".join(f"WHEN '{a}' THEN '{c}:' || trim(substr(t, strpos(t, ':') + 1))" for a, c in NAMESPACE_ALIASES.items())} END, CASE WHEN pns <> '' AND tns = '' THEN pns || ':' || t END] AS bases FROM d),
b AS (SELECT page, target, i, bases[i] AS b FROM (SELECT *, unnest(range(1, 5)) AS i FROM e) WHERE bases[i] IS NOT NULL AND bases[i] <> ''),
v AS (SELECT page, target, i, j, vs[j] AS title FROM (SELECT *, {_VARIANTS} AS vs, unnest(range(1, 6)) AS j FROM b)),
h AS (SELECT page, target, arg_min(v.title, i * 10 + j) AS resolved FROM v JOIN t USING (title) GROUP BY ALL)
SELECT c.page, c.target, h.resolved FROM c LEFT JOIN h ON h.page = c.page AND h.target = c.target""")
def link_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Every wiki link of every page against the catalogue."""
    from lorespark.functions.titles import clean_title

    targets = F.regexp_extract_all("content", F.lit(r"\[\[([^\[\]|{{}}\n]+)".replace("{{}}", "{}")), 1)
    links = table(spark, d, "sdv_full").select(clean_title(F.col("title")).alias("page"), F.explode(targets).alias("target")).where("page IS NOT NULL").distinct()
    return T.resolve_links(links, T.entries(table(spark, d, "manifest")), NAMESPACE_ALIASES).select("page", "target", "resolved")


@query(r"""
WITH r AS (SELECT trim(regexp_replace(replace(title, chr(8206), ''), '[_\s]+', ' ', 'g')) AS source, trim(regexp_replace(regexp_extract(content, '^#(?:REDIRECT|重定向)\s*\[\[([^\]|#]+)', 1), '[_\s]+', ' ', 'g')) AS target FROM sdv_full),
one AS (SELECT source, min(target) AS target FROM r WHERE target <> '' GROUP BY source),
h AS (SELECT a.source, a.target AS t1, b.target AS t2, c.target AS t3, e.target AS t4, f.target AS t5 FROM one a LEFT JOIN one b ON b.source = a.target LEFT JOIN one c ON c.source = b.target LEFT JOIN one e ON e.source = c.target LEFT JOIN one f ON f.source = e.target)
SELECT source, coalesce(t5, t4, t3, t2, t1) AS target, CAST(1 + (t2 IS NOT NULL)::INT + (t3 IS NOT NULL)::INT + (t4 IS NOT NULL)::INT + (t5 IS NOT NULL)::INT AS INT) AS hops FROM h""")
def redirect_follow(spark: SparkSession, d: str) -> DataFrame:
    return T.follow_redirects(T.redirect_targets(table(spark, d, "sdv_full")))


@query(r"""
WITH s AS (SELECT DISTINCT replace(split_part(replace(trim(path), '\', '/'), '/', -1), chr(8206), '') AS stored_name FROM images_manifest),
w AS (SELECT DISTINCT name FROM images_manifest),
c AS (SELECT name, 0 AS p, name AS n FROM w UNION ALL SELECT name, 1, split_part(name, '/', -1) FROM w
  UNION ALL SELECT name, 2, regexp_replace(regexp_replace(name, '[:\s/]+', '_', 'g'), '[<>"|?*\\]', '_', 'g') FROM w
  UNION ALL SELECT name, 3, CASE WHEN z[1] = upper(z[1]) THEN lower(z[1]) ELSE upper(z[1]) END || substr(z, 2) FROM (SELECT name, regexp_replace(regexp_replace(name, '[:\s/]+', '_', 'g'), '[<>"|?*\\]', '_', 'g') AS z FROM w))
SELECT w.name, h.n AS stored_name, h.n IS NOT NULL AS known FROM w LEFT JOIN (SELECT name, arg_min(n, p) AS n FROM c JOIN s ON s.stored_name = c.n GROUP BY name) h USING (name)""")
def file_probing(spark: SparkSession, d: str) -> DataFrame:
    images = table(spark, d, "images_manifest")
    base = F.element_at(F.split(F.translate(F.trim("path"), "\\", "/"), "/"), -1)
    return T.probe_files(images.select("name").distinct(), images.select(F.translate(base, "\u200e", "").alias("stored_name")))


@query(r"""SELECT ord, CASE WHEN n > 1 THEN title || ' (' || coalesce(CAST(pageid AS VARCHAR), '?') || ')' ELSE title END AS unique_title
FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY ord, pageid) AS n FROM manifest WHERE title <> '')""")
def title_collision_suffix(spark: SparkSession, d: str) -> DataFrame:
    return T.unique_titles(table(spark, d, "manifest").where("title <> ''")).select("ord", "unique_title")


@query(r"""
WITH p AS (SELECT ord, regexp_replace(regexp_replace(title, '[<>:"\\|?*\x00-\x1f]', '_', 'g'), '[. ]+$', '_') AS p FROM manifest WHERE title <> '')
SELECT ord, p || CASE WHEN n > 1 THEN '_dup' || (n - 1) ELSE '' END || '.wiki' AS path FROM (SELECT *, row_number() OVER (PARTITION BY lower(p) ORDER BY ord) AS n FROM p)""")
def path_assignment(spark: SparkSession, d: str) -> DataFrame:
    return T.assign_paths(table(spark, d, "manifest").where("title <> ''").select("ord", "title")).select("ord", "path")


@query("""SELECT ord, title FROM manifest WHERE ns IN (10, 828) OR (coalesce(ns NOT IN (10, 828), true) AND title IN (SELECT title FROM core_pages))""")
def subset_of_namespaces(spark: SparkSession, d: str) -> DataFrame:
    return T.subset(table(spark, d, "manifest"), [10, 828], table(spark, d, "core_pages")).select("ord", "title")


@query("""
WITH named AS (SELECT l_orderkey AS page, l_linenumber * 100 + l_partkey % 100 AS pos, CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE l_returnflag END AS name, l_linestatus AS body FROM lineitem),
one AS (SELECT page, pos, min(name) AS name, min(body) AS body FROM named GROUP BY page, pos),
k AS (SELECT *, CASE WHEN name <> '' THEN 'n:' || name ELSE 'p:' || pos END AS key FROM one),
f AS (SELECT page, key, min(pos) AS fp, arg_min(body, pos) AS body FROM k GROUP BY page, key)
SELECT k.page, k.pos, dense_rank() OVER (PARTITION BY k.page ORDER BY f.fp) AS seq, f.body FROM k JOIN f USING (page, key)""")
def footnote_numbering(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    rows = lines.select(F.col("l_orderkey").alias("page"), (F.col("l_linenumber") * 100 + F.col("l_partkey") % 100).alias("pos"), F.when(F.col("l_linenumber") % 3 == 0, "").otherwise(F.col("l_returnflag")).alias("name"), F.col("l_linestatus").alias("body"))
    refs = rows.groupBy("page", "pos").agg(F.min("name").alias("name"), F.min("body").alias("body"))
    return P.number_footnotes(refs).withColumn("seq", F.col("seq").cast("bigint"))


# Regions in which nothing is markup, as for the references of pages.
_OPAQUE = r"(?ism)<!--.*?(?:-->|\z)|^[ \t]*%[^\n]*|<nowiki>.*?</nowiki\s*>|<pre\b[^>]*>.*?</pre\s*>|<source\b[^>]*>.*?</source\s*>|<syntaxhighlight\b[^>]*>.*?</syntaxhighlight\s*>|^[ \t]*```[^\n]*\n.*?^[ \t]*```[ \t]*\r?$|^[ \t]*~~~[^\n]*\n.*?^[ \t]*~~~[ \t]*\r?$|\\begin\{verbatim\}.*?\\end\{verbatim\}|\\begin\{lstlisting\}.*?\\end\{lstlisting\}"


@query(rf"""WITH t AS (SELECT title, regexp_replace(content, '{_OPAQUE}', chr(10), 'g') AS c FROM sdv_full WHERE title IS NOT NULL),
m AS (SELECT title, regexp_extract_all(c, '(?i)\[\[[^\[\]|{{}}:]+::[^\[\]|]*(?:\|[^\[\]]*)?\]\]|\[\[\s*(?:category|分类)\s*:\s*[^\[\]|]+', 0) AS m FROM t),
e AS (SELECT title, m[i] AS m, i FROM (SELECT title, m, unnest(range(1, len(m) + 1)) AS i FROM m)),
v AS (SELECT title, i, CASE WHEN contains(m, '::') THEN upper(trim(split_part(substr(m, 3), '::', 1))[1]) || substr(trim(split_part(substr(m, 3), '::', 1)), 2) ELSE 'Category' END AS prop,
  CASE WHEN contains(m, '::') THEN trim(regexp_extract(m, '::([^\[\]|]*)', 1)) ELSE trim(regexp_extract(m, '(?s):\s*(.*)$', 1), chr(32) || chr(9) || chr(10) || chr(13)) END AS value FROM e),
SELECT title, prop, value, CAST(min(i) - 1 AS INT) AS pos FROM v WHERE value <> '' GROUP BY ALL""")
def page_properties(spark: SparkSession, d: str) -> DataFrame:
    return P.properties_of_pages(table(spark, d, "sdv_full"))
