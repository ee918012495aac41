"""Record look-ups, table operations, graphs and censuses over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lorespark.operators import census as C
from lorespark.operators import graph as G
from lorespark.operators import records as R
from lorespark.operators import tables as B
from lorespark.plans.q_data import CANON_SQL, SQL_ORPHANS
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


# --- records ------------------------------------------------------------------------------------


@query("""SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name AS part_name, s.s_name AS supplier_name, n.n_name AS nation_name, r.r_name AS region_name
FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey AND l.l_partkey > 0 LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey AND l.l_suppkey > 0
LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey AND s.s_nationkey > 0 LEFT JOIN region r ON r.r_regionkey = n.n_regionkey AND n.n_regionkey > 0""")
def record_star_lookup(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    out = R.star_lookup(lines, [(t("part").select("p_partkey", "p_name"), "l_partkey", "p_partkey", "a_"), (t("supplier").select("s_suppkey", "s_name", "s_nationkey"), "l_suppkey", "s_suppkey", "b_"), (t("nation"), "b_s_nationkey", "n_nationkey", "c_"), (t("region"), "c_n_regionkey", "r_regionkey", "e_")])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.col("a_p_name").alias("part_name"), F.col("b_s_name").alias("supplier_name"), F.col("c_n_name").alias("nation_name"), F.col("e_r_name").alias("region_name"))


@query("""SELECT p_partkey, 1 AS slot, p_brand AS item, p_size AS amount FROM part WHERE p_brand <> '' UNION ALL SELECT p_partkey, 2, p_type, p_size * 2 FROM part WHERE p_type <> ''
UNION ALL SELECT p_partkey, 3, CASE WHEN p_size > 25 THEN p_name ELSE '0' END, p_size * 3 FROM part WHERE p_size > 25""")
def record_unpivot_slots(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("i1"), F.col("p_type").alias("i2"), F.when(F.col("p_size") > 25, F.col("p_name")).otherwise("0").alias("i3"), F.col("p_size").alias("a1"), (F.col("p_size") * 2).alias("a2"), (F.col("p_size") * 3).alias("a3"))
    return R.unpivot_slots(part, ["p_partkey"], {"item": ["i1", "i2", "i3"], "amount": ["a1", "a2", "a3"]})


@query("""WITH a AS (SELECT l_orderkey, l_suppkey, min(l_linenumber) AS pos FROM lineitem GROUP BY ALL)
SELECT l_orderkey, string_agg(s_name, ',' ORDER BY pos, l_suppkey) AS suppliers FROM a JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_orderkey""")
def record_array_keys(spark: SparkSession, d: str) -> DataFrame:
    pos = table(spark, d, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.min("l_linenumber").alias("pos"))
    keys = F.transform(F.sort_array(F.collect_list(F.struct("pos", "l_suppkey"))), lambda x: x["l_suppkey"])
    orders = pos.groupBy("l_orderkey").agg(keys.alias("keys"))
    return R.join_array_keys(orders, "l_orderkey", "keys", table(spark, d, "supplier"), "s_suppkey", "s_name").select("l_orderkey", F.array_join("values", ",").alias("suppliers"))


@query("SELECT p_name, min(p_partkey) AS first_part, arg_min(p_brand, p_partkey) AS first_brand, max(p_partkey) AS last_part, arg_max(p_brand, p_partkey) AS last_brand FROM part GROUP BY p_name")
def record_first_last_match(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").select("p_name", "p_partkey", "p_brand")
    first = R.first_match(part, "p_name", "p_partkey").select("p_name", F.col("p_partkey").alias("first_part"), F.col("p_brand").alias("first_brand"))
    last = R.last_match(part, "p_name", "p_partkey").select("p_name", F.col("p_partkey").alias("last_part"), F.col("p_brand").alias("last_brand"))
    return first.join(last, "p_name")


@query("""SELECT event_id, coalesce(nullif(s_name, ''), nullif(c_name, ''), nullif(n_name, '')) AS resolved FROM events
LEFT JOIN supplier ON s_suppkey = user_id LEFT JOIN customer ON c_custkey = user_id * 11 LEFT JOIN nation ON n_nationkey = user_id % 30""")
def fallback_chain_coalesce(spark: SparkSession, d: str) -> DataFrame:
    """Users that no supplier has fall to a customer, those beyond the customers to a nation, and some to nothing."""
    steps = [(table(spark, d, "supplier"), F.col("user_id"), "s_suppkey", "s_name"), (table(spark, d, "customer"), F.col("user_id") * 11, "c_custkey", "c_name"), (table(spark, d, "nation"), F.col("user_id") % 30, "n_nationkey", "n_name")]
    return R.fallback_chain(table(spark, d, "events").select("event_id", "user_id"), steps, "resolved").select("event_id", "resolved")


@query("""WITH k AS (SELECT DISTINCT title FROM manifest WHERE title <> '' AND path <> ''), t AS (SELECT DISTINCT CASE WHEN contains(title, ':') THEN substr(title, strpos(title, ':') + 1) ELSE title END AS name FROM manifest WHERE title <> '')
SELECT name, coalesce(a.title, b.title, c.title, 'Missing:' || name) AS resolved FROM t LEFT JOIN k a ON a.title = 'Template:' || name LEFT JOIN k b ON b.title = 'Module:' || name LEFT JOIN k c ON c.title = 'Category:' || name""")
def namespace_preference(spark: SparkSession, d: str) -> DataFrame:
    from lorespark.functions.strings import without_namespace

    m = table(spark, d, "manifest")
    names = m.where("title <> ''").select(without_namespace(F.col("title")).alias("name")).distinct()
    return R.prefer_namespace(names, "name", m.where("title <> '' AND path <> ''"), ["Template:", "Module:", "Category:"], "Missing:").select("name", "resolved")


@query("SELECT o_orderkey, coalesce(w.word, o_orderstatus) AS status_word FROM orders LEFT JOIN (VALUES ('F', 'finished'), ('O', 'open')) w(k, word) ON k = o_orderstatus")
def dictionary_join(spark: SparkSession, d: str) -> DataFrame:
    words = spark.createDataFrame([("F", "finished"), ("O", "open")], "k string, word string")
    return R.translate(table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status_word")), "status_word", words, "k", "word").select("o_orderkey", "status_word")


@query("SELECT event_id, CAST(user_id & 1 AS BIGINT) AS b0, CAST((user_id >> 1) & 1 AS BIGINT) AS b1, CAST((user_id >> 2) & 1 AS BIGINT) AS b2 FROM events")
def record_bitflags(spark: SparkSession, d: str) -> DataFrame:
    return R.bit_flags(table(spark, d, "events").select("event_id", "user_id"), "user_id", ["b0", "b1", "b2"]).select("event_id", "b0", "b1", "b2")


@query("""WITH b AS (SELECT o_custkey AS g, CAST(o_orderkey % 1000 AS DOUBLE) AS x, o_totalprice AS y, 100.0 AS lx, 950.0 AS ux, 20000.0 AS ly, 480000.0 AS uy FROM orders),
p AS (SELECT g, round((x - lx) / (ux - lx) * 100, 1) AS l, round((y - ly) / (uy - ly) * 100, 1) AS t FROM b)
SELECT g AS o_custkey, count(*) AS markers, round(sum(greatest(0.0, least(100.0, l))), 1) AS sum_left, round(sum(greatest(0.0, least(100.0, t))), 1) AS sum_top FROM p WHERE l BETWEEN -5 AND 105 AND t BETWEEN -5 AND 105 GROUP BY g""")
def marker_projection_clamp(spark: SparkSession, d: str) -> DataFrame:
    x = (F.col("o_orderkey") % 1000).cast("double")
    pts = table(spark, d, "orders").select("o_custkey", x.alias("x"), F.col("o_totalprice").alias("y"), F.lit(100.0).alias("lower_x"), F.lit(950.0).alias("upper_x"), F.lit(20000.0).alias("lower_y"), F.lit(480000.0).alias("upper_y"))
    m = R.markers(pts, "o_custkey", "x", "y")
    total = lambda f: F.round(F.aggregate("markers", F.lit(0.0), lambda a, p: a + p[f]), 1)
    return m.select("o_custkey", F.size("markers").cast("bigint").alias("markers"), total("left").alias("sum_left"), total("top").alias("sum_top"))


@query("""WITH s AS (SELECT l_orderkey, l_returnflag, sum(l_quantity) AS s FROM lineitem GROUP BY ALL), m AS (SELECT l_orderkey, max(s) AS m FROM s GROUP BY ALL)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, CAST(floor(l_quantity / m * 100 + 0.5) AS BIGINT) AS pct FROM lineitem JOIN m USING (l_orderkey)""")
def gauge_share(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    return R.share_of_greatest(lines, "l_orderkey", "l_returnflag", "l_quantity").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "pct")


@query("""WITH q AS (SELECT l_orderkey, list(CASE WHEN l_linenumber % 4 = 0 THEN 255 ELSE l_linenumber END ORDER BY l_linenumber) AS r FROM lineitem GROUP BY ALL),
c AS (SELECT l_orderkey, list_transform(r, lambda x: CASE WHEN x = 255 THEN 0 ELSE x END) AS r FROM q)
SELECT l_orderkey, round(CASE WHEN list_sum(r) > 0 THEN r[1] / list_sum(r) ELSE 1.0 / len(r) END, 6) AS first_share, CAST(len(r) AS BIGINT) AS hits, CAST(coalesce(list_sum(r), 0) AS DOUBLE) AS last_total FROM c""")
def hit_shares(spark: SparkSession, d: str) -> DataFrame:
    rate = F.when(F.col("l_linenumber") % 4 == 0, 255).otherwise(F.col("l_linenumber"))
    r = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", rate.alias("r")))), lambda x: x["r"]).alias("r"))
    clean = F.transform("r", lambda x: F.when(x == 255, 0.0).otherwise(x.cast("double")))
    return r.select("l_orderkey", F.round(F.element_at(R.hit_shares(F.col("r")), 1), 6).alias("first_share"), F.size("r").cast("bigint").alias("hits"), F.element_at(R.running_total(clean), -1).alias("last_total"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_prop_lookup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("""SELECT c_mktsegment AS segment, c_custkey // 500 AS part, count(*) AS n, string_agg(c_name, ',' ORDER BY c_custkey) AS names FROM customer GROUP BY ALL""")
def group_collect_structs(spark: SparkSession, d: str) -> DataFrame:
    got = R.collect_by(table(spark, d, "customer").withColumnRenamed("c_mktsegment", "segment"), "segment", "c_custkey", ["c_custkey", "c_name"], 500)
    return got.select("segment", "part", F.size("items").cast("bigint").alias("n"), F.array_join(F.transform("items", lambda x: x["c_name"]), ",").alias("names"))


@query("""SELECT o_orderkey, CAST(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 3 END AS BIGINT) AS listed, (CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END) + (CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END) + (CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS score,
row_number() OVER (PARTITION BY o_custkey ORDER BY TRY_CAST(regexp_extract(o_orderpriority, '^\\d+', 0) AS DOUBLE) DESC, o_orderkey) AS by_rate FROM orders""".replace("\\\\", "\\"))
def custom_orders(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    s = R.scored(o, {"a": F.col("o_totalprice") > 100000, "b": F.col("o_totalprice") > 200000, "c": F.col("o_orderstatus") == "F"})
    rate = F.regexp_extract("o_orderpriority", r"^\d+", 0).try_cast("double")
    return s.select("o_orderkey", R.listed_first(F.col("o_orderpriority"), ["2-HIGH", "1-URGENT"]).cast("bigint").alias("listed"), F.col("score").cast("int").alias("score"), F.row_number().over(Window.partitionBy("o_custkey").orderBy(rate.desc(), "o_orderkey")).cast("bigint").alias("by_rate"))


# --- tables -------------------------------------------------------------------------------------


@query("SELECT doc_id FROM documents WHERE contains(lower(text), 'the') AND contains(lower(text), 'bridge')")
def table_keyword_filter(spark: SparkSession, d: str) -> DataFrame:
    return B.filter_rows(table(spark, d, "documents"), " The  bridge", ["text"]).select("doc_id")


@query(r"""WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'A' THEN l_linestatus || l_linenumber WHEN l_returnflag = 'N' THEN '1,' || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') ELSE l_linenumber || ' pcs' END AS cell FROM lineitem),
k AS (SELECT *, TRY_CAST(replace(regexp_extract(cell, '^[+-]?[\d.,]*\d', 0), ',', '') AS DOUBLE) AS num FROM c)
SELECT l_orderkey, l_linenumber, l_partkey, cell, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN num IS NOT NULL THEN 0 ELSE 1 END, num NULLS FIRST, CASE WHEN num IS NULL THEN cell END NULLS FIRST, l_linenumber, l_partkey) AS place FROM k""")
def table_typed_sort(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("l_linenumber").cast("string")
    cell = F.when(F.col("l_returnflag") == "A", F.concat("l_linestatus", n)).when(F.col("l_returnflag") == "N", F.concat(F.lit("1,"), F.lpad(n, 3, "0"))).otherwise(F.concat(n, F.lit(" pcs")))
    cells = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", cell.alias("cell"))
    w = Window.partitionBy("l_orderkey").orderBy(*B.typed_key(F.col("cell")), "l_linenumber", "l_partkey")  # each order is a table
    return cells.withColumn("place", F.row_number().over(w).cast("bigint"))


_CELLS = "SELECT l_orderkey AS table_id, l_linenumber AS row_ix, CAST(l_partkey % 5 AS INT) AS col_ix, CAST(1 + l_suppkey % 4 AS INT) AS colspan, CAST(1 + l_suppkey % 2 AS INT) AS rowspan, CAST(l_quantity AS INT) AS height FROM lineitem"


def _cells(spark: SparkSession, d: str) -> DataFrame:
    n = lambda c, a, m: (F.lit(a) + F.col(c) % m).cast("int")
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("table_id"), F.col("l_linenumber").alias("row_ix"), n("l_partkey", 0, 5).alias("col_ix"), n("l_suppkey", 1, 4).alias("colspan"), n("l_suppkey", 1, 2).alias("rowspan"), F.col("l_quantity").cast("int").alias("height"))


@query(f"SELECT table_id, count(DISTINCT row_ix) AS row_count, max(col_ix + colspan) AS col_count, max(CASE WHEN rowspan > 1 THEN 1 ELSE 0 END) AS has_rowspan, CASE WHEN count(DISTINCT row_ix) >= 10 THEN 1 ELSE 0 END AS filter_box, CASE WHEN max(col_ix + colspan) > 7 THEN 1 ELSE 0 END AS wide, CASE WHEN count(DISTINCT row_ix) > 40 THEN 1 ELSE 0 END AS split_rows FROM ({_CELLS}) GROUP BY table_id")
def table_shape_stats(spark: SparkSession, d: str) -> DataFrame:
    return B.shape(_cells(spark, d))


@query(f"SELECT table_id, CAST(sum(h) AS BIGINT) AS total_height FROM (SELECT table_id, row_ix, greatest(26, max(ceil(height / rowspan))) AS h FROM ({_CELLS}) GROUP BY ALL) GROUP BY table_id")
def table_heights(spark: SparkSession, d: str) -> DataFrame:
    return B.table_heights(_cells(spark, d))


@query("SELECT c_custkey, CAST(floor((row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) / 80) AS BIGINT) AS chunk FROM customer")
def chunk_rows_80(spark: SparkSession, d: str) -> DataFrame:
    return B.chunk_rows(table(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", "c_custkey").select("c_custkey", "chunk")


@query("SELECT event_id, CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS section FROM events")
def section_split_islands(spark: SparkSession, d: str) -> DataFrame:
    return B.sections(table(spark, d, "events").select("event_id", "user_id", "event_type"), "user_id", "event_id", F.col("event_type") == "signup").select("event_id", "section")


@query("""WITH x AS (SELECT *, CASE WHEN lag(event_type) OVER w IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS nw FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM x)
SELECT user_id, CAST(run AS BIGINT) AS run, event_type, string_agg(CAST(event_id AS VARCHAR), '' ORDER BY event_id) AS merged_text FROM r GROUP BY user_id, run, event_type""")
def merge_equal_spans(spark: SparkSession, d: str) -> DataFrame:
    return B.merge_spans(table(spark, d, "events").select("user_id", "event_id", "event_type", F.col("event_id").cast("string").alias("t")), "user_id", "event_id", "event_type", "t")


# --- graphs -------------------------------------------------------------------------------------


def _order_edges(spark: SparkSession, d: str) -> DataFrame:
    """Customers to nations to regions and back down, as a graph of names."""
    n, r, c = table(spark, d, "nation"), table(spark, d, "region"), table(spark, d, "customer")
    up = n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("src"), F.col("n_name").alias("dst"))  # five fixed rows
    down = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("src"), F.col("c_name").alias("dst"))  # 25 fixed rows
    chain = c.select(F.col("c_name").alias("src"), F.format_string("Customer#%09d", F.col("c_custkey") * 2).alias("dst"))
    return G.union_edges(up, down, chain)


_EDGES_SQL = """WITH RECURSIVE e AS (SELECT r_name AS src, n_name AS dst FROM nation JOIN region ON n_regionkey = r_regionkey UNION SELECT n_name, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION SELECT c_name, 'Customer#' || lpad(CAST(c_custkey * 2 AS VARCHAR), 9, '0') FROM customer WHERE c_custkey > 0),
b AS (SELECT 'ASIA' AS node, 0 AS level UNION SELECT e.dst, b.level + 1 FROM b JOIN e ON e.src = b.node WHERE b.level < 30),
l AS (SELECT node, min(level) AS level FROM b GROUP BY node)
"""


@query(_EDGES_SQL + "SELECT l.node, CAST(l.level AS INT) AS level, (SELECT min(p.node) FROM l p JOIN e ON e.src = p.node WHERE e.dst = l.node AND p.level = l.level - 1) AS parent FROM l")
def bfs_levels(spark: SparkSession, d: str) -> DataFrame:
    return G.levels(_order_edges(spark, d), spark.createDataFrame([("ASIA",)], "node string"))


@query(_EDGES_SQL + ", h AS (SELECT coalesce(level, -1) AS level, count(*) AS n FROM (SELECT src AS node FROM e UNION SELECT dst FROM e) LEFT JOIN l USING (node) GROUP BY 1) SELECT CAST(level AS INT) AS level, n, round(n * 100.0 / sum(n) OVER (), 4) AS pct, round(sum(n) OVER (ORDER BY level) * 100.0 / sum(n) OVER (), 4) AS cumulative_pct FROM h")
def level_histogram_cumulative(spark: SparkSession, d: str) -> DataFrame:
    edges = _order_edges(spark, d)
    nodes = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node")))
    return G.histogram(G.with_unreachable(nodes, G.levels(edges, spark.createDataFrame([("ASIA",)], "node string"))), "level")


@query("""WITH RECURSIVE e AS (SELECT p_partkey AS src, p_partkey // 2 AS dst FROM part WHERE p_partkey > 0), c AS (SELECT * FROM e UNION SELECT c.src, e.dst FROM c JOIN e ON e.src = c.dst) SELECT src, dst FROM c""")
def transitive_closure(spark: SparkSession, d: str) -> DataFrame:
    return G.closure(table(spark, d, "part").where("p_partkey > 0").select(F.col("p_partkey").alias("src"), F.floor(F.col("p_partkey") / 2).cast("bigint").alias("dst")))


@query("""WITH RECURSIVE e AS (SELECT p_partkey AS src, p_partkey // 2 AS dst FROM part WHERE p_partkey > 0), c AS (SELECT src, dst FROM e UNION SELECT c.src, e.dst FROM c JOIN e ON e.src = c.dst),
r AS (SELECT src AS module, dst AS of FROM c UNION SELECT p_partkey, p_partkey FROM part)
SELECT module, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS tables FROM r JOIN part ON p_partkey = of GROUP BY module""")
def dependency_tables(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    edges = part.where("p_partkey > 0").select(F.col("p_partkey").alias("src"), F.floor(F.col("p_partkey") / 2).cast("bigint").alias("dst"))
    return G.closure_tables(edges, part.select(F.col("p_partkey").alias("module"), F.col("p_brand").alias("table_name"))).withColumn("tables", F.array_join("tables", ","))


@query(_EDGES_SQL.split("b AS (")[0].rstrip(",\n") + " SELECT node, CAST(sum(o) AS BIGINT) AS out_links, CAST(sum(i) AS BIGINT) AS in_links FROM (SELECT src AS node, 1 AS o, 0 AS i FROM e UNION ALL SELECT dst, 0, 1 FROM e) GROUP BY node")
def link_degrees(spark: SparkSession, d: str) -> DataFrame:
    return G.degrees(_order_edges(spark, d))


# The references of every record, of any namespace, without its own title, in the form of titles.
_SQL_LINKS = (
    SQL_ORPHANS.split("refs AS (")[0].replace("ns <> 828", "true").replace("SELECT rec_no, dumped_at, title AS raw FROM bare\n", "SELECT rec_no, dumped_at, raw FROM (SELECT NULL AS rec_no, NULL AS dumped_at, NULL AS raw) WHERE false\n").replace("WHERE ns = 828", "WHERE false").replace("WITH bare", "WITH RECURSIVE bare")
    + """own AS (SELECT rec_no, ref_title AS src FROM (SELECT rec_no, title, """
    + CANON_SQL
    + """ AS ref_title FROM (SELECT *, trim(substr(t, strpos(t, ':') + 1)) AS n FROM (SELECT rec_no, title, trim(regexp_replace(title, '^:+ ?', '')) AS t FROM bare)))),
edge AS (SELECT DISTINCT src, ref_title AS dst FROM form JOIN own USING (rec_no) WHERE what = 'ref' AND src <> '' AND ref_title <> '' AND src <> ref_title),
kinds AS (SELECT src, dst, CASE WHEN starts_with(dst, 'Category:') THEN 'category_link' WHEN starts_with(dst, 'File:') THEN 'file_ref' WHEN starts_with(dst, 'Template:') THEN 'template' WHEN starts_with(dst, 'Module:') THEN 'invoke' ELSE 'wikilink' END AS kind FROM edge)
"""
)


@query(_SQL_LINKS + "SELECT src, dst, kind FROM kinds")
def wiki_link_edges(spark: SparkSession, d: str) -> DataFrame:
    return G.page_edges(table(spark, d, "sdv_full"))


@query(_SQL_LINKS + "SELECT kind, count(*) AS links, count(DISTINCT src) AS pages, count(DISTINCT dst) AS targets FROM kinds GROUP BY kind")
def link_kind_counts(spark: SparkSession, d: str) -> DataFrame:
    return G.kind_counts(G.page_edges(table(spark, d, "sdv_full")))


@query("SELECT CAST(range AS BIGINT) AS node, CAST(range AS INT) AS level, CASE WHEN range > 0 THEN CAST(range - 1 AS BIGINT) END AS parent FROM range(0, 67)")
def long_chain_levels(spark: SparkSession, d: str) -> DataFrame:
    """A chain of edges, as long redirect and category chains are: every level is reached."""
    edges = spark.range(66).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    return G.levels(edges, spark.createDataFrame([(0,)], "node bigint"))


@query("SELECT CAST(a.range AS BIGINT) AS src, CAST(b.range AS BIGINT) AS dst FROM range(0, 201) a JOIN range(0, 201) b ON a.range < b.range")
def long_chain_closure(spark: SparkSession, d: str) -> DataFrame:
    """The closure of a chain of 200 edges: all pairs, in eight rounds."""
    return G.closure(spark.range(200).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")))


@query(_SQL_LINKS + """, walk AS (SELECT 'Village Notice Board' AS node, 0 AS level UNION SELECT dst, level + 1 FROM walk JOIN edge ON src = node WHERE level < 30),
best AS (SELECT node, min(level) AS level FROM walk GROUP BY node)
SELECT node, CAST(level AS INT) AS level, (SELECT min(p.node) FROM best p JOIN edge ON src = p.node WHERE dst = best.node AND p.level = best.level - 1) AS parent FROM best""")
def wiki_link_levels(spark: SparkSession, d: str) -> DataFrame:
    return G.levels(G.page_edges(table(spark, d, "sdv_full")), spark.createDataFrame([("Village Notice Board",)], "node string"))


# --- censuses -----------------------------------------------------------------------------------


def _usage_sql(pattern: str) -> str:
    return f"WITH u AS (SELECT rec_no, unnest(regexp_extract_all(content, '{pattern}', 1)) AS name FROM sdv_full) SELECT name, count(*) AS uses, count(DISTINCT rec_no) AS pages FROM u GROUP BY name"


@query(_usage_sql(C.PATTERNS["function"]))
def usage_census(spark: SparkSession, d: str) -> DataFrame:
    return C.usage(table(spark, d, "sdv_full"), "function")


@query(_usage_sql(C.PATTERNS["invoke"]) + " ORDER BY uses DESC, name LIMIT 25")
def usage_census_topk(spark: SparkSession, d: str) -> DataFrame:
    return C.most_common(C.usage(table(spark, d, "sdv_full"), "invoke"), 25)


@query("WITH u AS (SELECT unnest(regexp_extract_all(content, '" + C.PATTERNS["file"] + "', 1)) AS name FROM sdv_full) SELECT count(DISTINCT name) AS distinct_files, count(*) AS refs FROM u")
def count_distinct_refs(spark: SparkSession, d: str) -> DataFrame:
    return C.usage(table(spark, d, "sdv_full"), "file").agg(F.count("*").alias("distinct_files"), F.sum("uses").alias("refs"))


@query("SELECT ns, count(*) AS total, count(*) FILTER (WHERE redirect) AS redirects FROM sdv_full GROUP BY ns")
def namespace_counts(spark: SparkSession, d: str) -> DataFrame:
    return C.namespace_counts(table(spark, d, "sdv_full"))


@query(r"SELECT lower(regexp_extract(path, '\.([A-Za-z0-9]+)\s*$', 1)) AS ext, count(*) AS files, CAST(sum(coalesce(bytes, 0)) AS BIGINT) AS total_bytes FROM images_manifest GROUP BY 1")
def extension_histogram(spark: SparkSession, d: str) -> DataFrame:
    return C.extensions(table(spark, d, "images_manifest"))


@query("SELECT count(*) AS total, count(k.o_custkey) AS matched, round(count(k.o_custkey) * 100.0 / count(*), 4) AS pct FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) k ON k.o_custkey = c_custkey")
def coverage_ratio(spark: SparkSession, d: str) -> DataFrame:
    return C.coverage(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").select(F.col("o_custkey").alias("k")), "k")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def coverage_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return C.missing(table(spark, d, "customer").select("c_custkey", "c_name"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("WITH u AS (SELECT DISTINCT lower(regexp_replace(trim(unnest(regexp_extract_all(content, '" + C.PATTERNS["file"] + r"', 1))), '[\s_]+', '_', 'g')) AS name FROM sdv_full) SELECT name FROM u WHERE NOT regexp_matches(name, '[{}<>]') AND name NOT IN (SELECT lower(regexp_replace(trim(name), '[\s_]+', '_', 'g')) FROM images_manifest)")
def missing_file_refs(spark: SparkSession, d: str) -> DataFrame:
    return C.missing_files(C.usage(table(spark, d, "sdv_full"), "file"), table(spark, d, "images_manifest"))


@query("SELECT title, count(*) AS n FROM manifest WHERE title <> '' GROUP BY title HAVING count(*) > 1")
def uniqueness_violations(spark: SparkSession, d: str) -> DataFrame:
    return C.duplicates(table(spark, d, "manifest").where("title <> ''"), "title")


@query("SELECT title, max(rec_no) AS rec_no, arg_max(ns, rec_no) AS ns FROM sdv_full GROUP BY title")
def dump_latest_by_title(spark: SparkSession, d: str) -> DataFrame:
    return C.latest_by_title(table(spark, d, "sdv_full").select("title", "rec_no", "ns"), "rec_no")


@query("SELECT event_type, user_id, count(*) AS n FROM events GROUP BY event_type, user_id")
def handler_rollup(spark: SparkSession, d: str) -> DataFrame:
    return C.rollup_pages(table(spark, d, "events"), "event_type", "user_id")


_SQL_LEAKED = " || ".join("(CASE WHEN contains(content, '{0}') THEN '{0} ' ELSE '' END)".format(m.replace("'", "''")) for m in C.LEAK_MARKS)


@query(f"SELECT * FROM (SELECT rec_no, {_SQL_LEAKED} AS leaked FROM sdv_full) WHERE leaked <> ''")
def leak_sweep(spark: SparkSession, d: str) -> DataFrame:
    found = C.leaks(table(spark, d, "sdv_full"), "content")
    return found.select("rec_no", F.array_join(F.transform("leaked", lambda x: F.concat(x, F.lit(" "))), "").alias("leaked"))


@query()
def leak_sweep_expanded(spark: SparkSession, d: str) -> DataFrame:
    """What expansion leaves behind in the pages of the main namespace."""
    from lorespark.plans.q_text import template_expansion

    found = C.leaks(template_expansion(spark, d), "expanded")
    return found.select("title", F.explode("leaked").alias("mark")).groupBy("mark").agg(F.count("*").alias("pages"), F.countDistinct("title").alias("titles"))


@query("SELECT rec_no, size AS declared, CAST(length(content) AS BIGINT) AS made FROM sdv_full WHERE size <> length(content)")
def size_audit(spark: SparkSession, d: str) -> DataFrame:
    return C.audit(table(spark, d, "sdv_full"), F.col("size"), F.length("content").cast("bigint")).select("rec_no", "declared", "made")


@query("""WITH b AS (SELECT DISTINCT p_brand AS name, lower(p_brand) AS a FROM part), n AS (SELECT DISTINCT n_name || ' brand#1' AS table_name, lower(n_name || ' brand#1') AS b FROM nation UNION SELECT DISTINCT p_brand || '1', lower(p_brand || '1') FROM part)
SELECT name, table_name FROM b, n WHERE a = n.b OR contains(n.b, a) OR contains(a, n.b) OR (length(a) >= 8 AND length(n.b) >= 8 AND left(a, 8) = left(n.b, 8))""")
def fuzzy_table_match(spark: SparkSession, d: str) -> DataFrame:
    part, nation = table(spark, d, "part"), table(spark, d, "nation")
    names = nation.select(F.concat("n_name", F.lit(" brand#1")).alias("table_name")).unionByName(part.select(F.concat("p_brand", F.lit("1")).alias("table_name")))
    return C.fuzzy_match(part.select(F.col("p_brand").alias("name")), names)


@query("""WITH d AS (SELECT DISTINCT user_id, event_type FROM events) SELECT * FROM d""")
def deduplicate_queries(spark: SparkSession, d: str) -> DataFrame:
    from lorespark.plans.ask import distinct_queries

    return distinct_queries(table(spark, d, "events").select("user_id", "event_type"), ["user_id", "event_type"])


# --- nested records -----------------------------------------------------------------------------


@query("""SELECT p_brand, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS INT) AS pos, p_partkey AS entry_id, p_name AS entry_title FROM part
QUALIFY p_partkey > 100 AND p_partkey < 900""")
def map_entries_in_range(spark: SparkSession, d: str) -> DataFrame:
    """A map of brand to the ids and titles of its parts, asked for every brand; ids within a range."""
    part = table(spark, d, "part")
    entry = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))
    listed = part.groupBy("p_brand").agg(F.map_from_arrays(F.array(F.col("p_brand")), F.array(F.sort_array(F.collect_list(entry)))).alias("by_name"))
    return R.map_entries(listed, "p_brand", "by_name", F.col("p_brand"), 100, 900)


@query("""SELECT DISTINCT n_name AS query, a.area, s_suppkey, s_name FROM supplier JOIN nation ON true, (SELECT unnest(['north', 'south', 'west']) AS area) a
WHERE s_nationkey = n_nationkey AND (a.area <> 'south' OR s_suppkey % 2 = 0) AND (a.area <> 'west' OR s_suppkey % 3 = 0)""")
def item_map_placements(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as places of their nation's name, fanned out by area, without empty areas and ship variants."""
    supplier, nation = table(spark, d, "supplier"), table(spark, d, "nation")
    areas = F.filter(F.array(F.lit("north"), F.when(F.col("s_suppkey") % 2 == 0, "south").otherwise(""), F.when(F.col("s_suppkey") % 3 == 0, "west"), F.lit("north_shipoff")), lambda x: x.isNotNull())
    places = supplier.join(R.small_side(nation), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_name", F.col("n_name").alias("place"), areas.alias("areas"))
    values = nation.select(F.col("n_name").alias("query"), F.concat(F.lit(" "), "n_name").alias("value"))
    return R.placements_by_area(values, places, "place", "areas", "_shipoff").select("query", "area", "s_suppkey", "s_name")


@query("SELECT p_partkey, p_size % 2 = 0 AS in_area FROM part")
def any_case_containment(spark: SparkSession, d: str) -> DataFrame:
    areas = F.when(F.col("p_size") % 2 == 0, F.array(F.lower("p_brand"), F.lit("x"))).otherwise(F.array(F.col("p_type")))
    return table(spark, d, "part").select("p_partkey", R.holds_any_case(areas, F.upper("p_brand")).alias("in_area"))


@query("""SELECT l_orderkey, l_linenumber, 'first' AS section, 1 AS slot, l_partkey AS item, l_quantity AS pct FROM lineitem WHERE l_partkey <> 0
UNION ALL SELECT l_orderkey, l_linenumber, 'first', 2, l_suppkey, l_discount FROM lineitem WHERE l_suppkey <> 0
UNION ALL SELECT l_orderkey, l_linenumber, 'second', 1, l_suppkey, l_tax FROM lineitem WHERE l_suppkey <> 0 AND l_linenumber % 2 = 0""")
def nested_unpivot(spark: SparkSession, d: str) -> DataFrame:
    """Two struct columns with two slots each, the second struct null in odd rows."""
    one = F.struct(F.col("l_partkey").alias("t1"), F.col("l_suppkey").alias("t2"), F.col("l_quantity").alias("p1"), F.col("l_discount").alias("p2"))
    two = F.when(F.col("l_linenumber") % 2 == 0, F.struct(F.col("l_suppkey").alias("t1"), F.lit(0).cast("bigint").alias("t2"), F.col("l_tax").alias("p1"), F.lit(0.0).alias("p2")))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", one.alias("s1"), two.alias("s2"))
    return R.unpivot_nested(rows, ["l_orderkey", "l_linenumber"], {"s1": "first", "s2": "second"}, {"item": ["t1", "t2"], "pct": ["p1", "p2"]})
