from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lorespark.operators import census as C
from lorespark.operators import expansion
from lorespark.operators import graph as G
from lorespark.operators import parsing
from lorespark.operators import props as P
from lorespark.operators import records as R
from lorespark.operators import tables as B
from lorespark.operators import titlesearch as T
from lorespark.plans import ask as A

PAGES = [("item:B-3", "[[Kind::tool]] [[Price::30]] [[Price::30]] {{#set:Price=40}}"), ("item:B-24", "[[kind::tool]] [[Price::9]]"), ("item:A", "[[Kind::food]] [[Category:Shop]]"), ("shop:X", "[[Sells::item:A]] [[Sells::item:B-3]]"), ("Home", ""), (None, "[[Kind::tool]]"), ("Empty", None)]


@pytest.fixture(scope="module")
def corpus(spark):
    pages = spark.createDataFrame(PAGES, "title string, content string")
    manifest = spark.createDataFrame([(t, i) for i, (t, _) in enumerate(PAGES)], "title string, ord bigint")
    return manifest, P.properties_of_pages(pages).cache()


def titles(df):
    return [r["title"] for r in df.collect()]


def test_properties(corpus):
    got = {(r["title"], r["prop"], r["value"]) for r in corpus[1].collect()}
    assert ("item:B-3", "Price", "40") in got and ("item:B-24", "Kind", "tool") in got and ("item:A", "Category", "Shop") in got
    assert sum(1 for t, p, v in got if (t, p, v) == ("item:B-3", "Price", "30")) == 1
    assert {r["title"]: r["props"] for r in P.as_map(corpus[1]).collect()}["item:B-3"]["Price"] == ["30", "40"]


def test_ask(corpus):
    ask = lambda q, **k: titles(A.parse_ask(q, **k).rows(*corpus))
    assert ask("[[item:+]] [[Kind::tool]]|sort=Price") == ["item:B-24", "item:B-3"]
    assert ask("[[item:+]]|sort=Price") == ["item:A", "item:B-24", "item:B-3"]  # missing first
    assert ask("[[Price::40]]") == ["item:B-3"] and ask("[[Price::+]]") == ["item:B-3", "item:B-24"] and ask("[[Price::+]]", compat=True) == []
    assert ask("[[Home]]") == ["Home"] and ask("[[Gone]]") == [] and ask("[[item:+]]|limit=1") == ["item:B-3"] and len(ask("[[item:+]]|limit=-1")) == 3
    assert ask("[[Category:Shop]]") == ["item:A"] and len(ask("[[Category:Shop]]", compat=True)) == 6
    assert ask("[[~item:B*]]") == ["item:B-3", "item:B-24"] and ask("[[Home]][[item:+]]", compat=True) == ["Home"] and ask("[[Home]][[item:+]]") == []
    q = A.parse_ask("[[item:+]][[Kind::tool]]|?Price=P|?Price=P|sort=price")
    assert q.rows(*corpus).columns == ["title", "P", "P_2"]
    assert A.parse_ask("[[item:A]]|?Kind|headers=hide").text(*corpus).first()[0] == '{| class="wikitable"\n|-\n| [[item:A|A]]\n| food\n|}'
    assert A.parse_ask("[[Gone]]|?Kind").text(*corpus).first()[0] == ""
    with pytest.raises(ValueError):
        A.parse_ask("[[item:A]]|format=chart").text(*corpus)
    assert A.show(corpus[1], "item:B-3", ["?price#", "Kind"]).first()[0] == "30、40、tool" and A.show(corpus[1], "None", ["Kind"]).first()[0] == ""


def test_reverse_and_snapshot(spark, corpus, tmp_path):
    targets = spark.createDataFrame([("item:A",), ("item:B-24",)], "title string")
    assert [tuple(r) for r in P.reverse_lookup(corpus[1], "Sells", targets).collect()] == [("item:A", "shop:X")]
    path = str(tmp_path / "snap")
    assert P.load_snapshot(spark, path, "s") is None
    P.save_snapshot(corpus[1], path, "s")
    assert P.load_snapshot(spark, path, "s").count() == corpus[1].count() and P.load_snapshot(spark, path, "other") is None


def test_refresh(spark):
    old = spark.createDataFrame([("a", "[[P::1]]"), ("b", "[[P::2]]"), ("gone", "[[P::9]]")], "title string, content string")
    new = spark.createDataFrame([("a", "[[P::1]]"), ("b", "[[P::3]]"), ("c", "[[P::4]]")], "title string, content string")
    known = old.select("title", F.xxhash64("content").alias("digest"))
    props, digests = P.refresh(P.properties_of_pages(old), new, known)
    assert sorted((r["title"], r["value"]) for r in props.collect()) == [("a", "1"), ("b", "3"), ("c", "4")] and digests.count() == 3


def test_titles(spark):
    m = spark.createDataFrame([("Foo", "p1", 0), ("Foo", "p2", 5), ("ns:foo bar", "p3", 1), ("xfoo", "p4", 2), ("Template:foo", "p5", 3), ("", "p", 4), ("Z", None, 6)], "title string, path string, ord bigint")
    e = T.entries(m)
    assert {(r["title"], r["path"], r["ord"]) for r in e.collect()} >= {("Foo", "p2", 0)} and e.count() == 4
    assert [tuple(r) for r in T.search(e, "foo", 10, ("Template",)).collect()] == [("Foo", 1), ("ns:foo bar", 3), ("xfoo", 4)]
    assert T.search(e, "  ").count() == 0
    links = spark.createDataFrame([("ns:P", "/Sub/"), ("ns:P", "foo bar"), ("P", "foo"), ("P", "nope"), (None, "Foo")], "page string, target string")
    known = spark.createDataFrame([("ns:P/Sub",), ("ns:foo bar",), ("Foo",)], "title string")
    got = {(r["page"], r["target"]): r["resolved"] for r in T.resolve_links(links, known, {"mb": "Template"}).collect()}
    assert got[("ns:P", "/Sub/")] == "ns:P/Sub" and got[("ns:P", "foo bar")] == "ns:foo bar" and got[("P", "foo")] == "Foo" and got[("P", "nope")] is None
    red = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), (None, "q")], "source string, target string")
    assert {r["source"]: r["target"] for r in T.follow_redirects(red).collect()} == {"a": "c", "b": "c", "x": "y", "y": "x"}
    files = spark.createDataFrame([("A: b/c",), ("x y.png",), ("nope",)], "name string")
    stored = spark.createDataFrame([("A_b_c",), ("X_y.png",)], "stored_name string")
    assert {r["name"]: r["stored_name"] for r in T.probe_files(files, stored).collect()} == {"A: b/c": "A_b_c", "x y.png": "X_y.png", "nope": None}
    paths = spark.createDataFrame([("Main/A/B.wiki",), ("Template/X.wiki",), ("solo.html",)], "p string").select(T.title_from_path(F.col("p"))).collect()
    assert [r[0] for r in paths] == ["A/B", "Template:X", "solo"]


def test_records(spark):
    facts = spark.createDataFrame([(1, 10), (2, 0), (3, -1), (4, 99), (5, None)], "id int, fk int")
    dim = spark.createDataFrame([(10, "ten"), (0, "zero")], "k int, v string")
    assert {r["id"]: r["d_v"] for r in R.star_lookup(facts, [(dim, "fk", "k", "d_")]).collect()} == {1: "ten", 2: None, 3: None, 4: None, 5: None}
    slots = spark.createDataFrame([(1, "a", "0", None, 5, 6, 7)], "id int, i1 string, i2 string, i3 string, p1 int, p2 int, p3 int")
    assert [tuple(r) for r in R.unpivot_slots(slots, ["id"], {"item": ["i1", "i2", "i3"], "prob": ["p1", "p2", "p3"]}).collect()] == [(1, 1, "a", 5)]
    arr = spark.createDataFrame([(1, [10, 7, 0]), (2, [])], "id int, ks array<int>")
    assert {r["id"]: r["values"] for r in R.join_array_keys(arr, "id", "ks", dim, "k", "v").collect()} == {1: ["ten", "zero"], 2: []}
    shares = spark.createDataFrame([([10, 255, 30],), ([0, 0],)], "r array<int>").select(R.hit_shares(F.col("r"))).collect()
    assert shares[0][0] == [0.25, 0.0, 0.75] and shares[1][0] == [0.5, 0.5]
    pts = spark.createDataFrame([("g", 5.0, 5.0, 0.0, 10.0, 0.0, 10.0), ("g", 10.4, 0.0, 0.0, 10.0, 0.0, 10.0), ("g", 20.0, 0.0, 0.0, 10.0, 0.0, 10.0), ("e", 1.0, 1.0, 3.0, 3.0, 0.0, 1.0)], "g string, x double, y double, lower_x double, upper_x double, lower_y double, upper_y double")
    assert [(r["g"], [tuple(m) for m in r["markers"]]) for r in R.markers(pts, "g", "x", "y").collect()] == [("g", [(50.0, 50.0), (100.0, 0.0)])]
    pairs = spark.createDataFrame([(["a", "b", "c"],), ([],)], "a array<string>").select(R.pairwise(F.col("a"))).collect()
    assert [tuple(p) for p in pairs[0][0]] == [("a", "b"), ("c", "")] and pairs[1][0] == []
    rates = spark.createDataFrame([("5%", 1), ("30%", 2), (None, 3), ("x", 4)], "r string, o int")
    assert [r["o"] for r in R.by_rate(rates, "r", "o").collect()] == [2, 1, 3, 4]


def test_tables(spark):
    rows = spark.createDataFrame([(0, "Name", True), (1, "1,200 gold", False), (2, "90", False), (3, "abc", False), (4, None, False)], "ix int, t string, h boolean")
    order = lambda d: [r["ix"] for r in B.sort_rows(rows, F.col("t"), "ix", d, "h").collect()]
    assert order("asc") == [0, 2, 1, 4, 3] and order("desc") == [0, 3, 4, 1, 2] and order("none") == [0, 1, 2, 3, 4]
    assert [r["ix"] for r in B.filter_rows(rows, "GOLD 1,2", ["t"], "h").collect()] == [0, 1] and B.filter_rows(rows, " ", ["t"]).count() == 5
    assert B.next_direction(B.next_direction(B.next_direction("asc"))) == "asc"
    spans = spark.createDataFrame([("t", i, 3 if i == 1 else 1) for i in range(6)], "t string, r int, s int")
    assert [r["chunk"] for r in B.chunk_spanned_rows(spans, "t", "r", "s", 2).orderBy("r").collect()] == [0, 0, 0, 0, 2, 2]


def test_graph(spark):
    edges = spark.createDataFrame([("h", "a"), ("h", "b"), ("a", "c"), ("b", "c"), ("c", "h"), ("a", "a"), ("z", "y")], "src string, dst string")
    start = spark.createDataFrame([("h",)], "node string")
    got = {r["node"]: (r["level"], r["parent"]) for r in G.levels(edges, start).collect()}
    assert got == {"h": (0, None), "a": (1, "h"), "b": (1, "h"), "c": (2, "a")}
    nodes = spark.createDataFrame([("h",), ("z",)], "node string")
    assert {r["node"]: r["level"] for r in G.with_unreachable(nodes, G.levels(edges, start)).collect()} == {"h": 0, "z": -1}
    clo = {(r["src"], r["dst"]) for r in G.closure(edges.where("src <> 'c'")).collect()}
    assert clo == {("h", "a"), ("h", "b"), ("h", "c"), ("a", "c"), ("b", "c"), ("a", "a"), ("z", "y")}
    assert G.levels(edges.limit(0), start).count() == 1 and T.dependency_subset(start.withColumnRenamed("node", "title"), edges).count() == 4


def test_census(spark):
    pages = spark.createDataFrame([("a", "{{X}} {{x|1}} {{#if:1|{{X}}}} [[File:A b.png|t]]"), ("b", "{{#invoke:M|f}} [[image:{{{1}}}.png]]"), ("c", None)], "title string, content string")
    assert {r["name"]: (r["uses"], r["pages"]) for r in C.usage(pages, "template").collect()} == {"X": (2, 1), "x": (1, 1)}
    stored = spark.createDataFrame([("other.png",)], "name string")
    assert [r["name"] for r in C.missing_files(C.usage(pages, "file"), stored).collect()] == ["a_b.png"]
    assert C.coverage(pages.select("title"), pages.where("title = 'a'").select("title"), "title").first()["pct"] == pytest.approx(33.3333)
    assert C.fuzzy_match(spark.createDataFrame([("Enemy",), ("longprefixA",)], "name string"), spark.createDataFrame([("enemylist",), ("ene",), ("longprefixB",), ("q",)], "table_name string")).count() == 3


def test_expansion_ways_agree(spark):
    templates = spark.createDataFrame([("Template:Box", "<{{{1|}}}{{Inner}}>"), ("Template:Inner", "in"), ("Template:Unused", "u"), ("Template:N", None)], "title string, content string")
    pages = spark.createDataFrame([("p", "{{box|a}} [[K::v]]"), ("q", "plain"), ("r", None)], "title string, content string")
    a = {r["title"]: r["expanded"] for r in expansion.expand_pages(pages, templates).collect()}
    b = {r["title"]: r["expanded"] for r in expansion.expand_pages(pages, templates, limit=0).collect()}
    assert a == b == {"p": "<ain> [[v]]", "q": "plain", "r": None}
    assert [tuple(r) for r in expansion.expanded_properties(expansion.expand_pages(pages, templates)).collect()] == [("p", "K", "v", 0)]
    filled = expansion.fill_placeholders(spark.createDataFrame([("p", "x @@1@@ y @@2@@")], "title string, expanded string"), spark.createDataFrame([("p", "1", "{| t\n|}")], "title string, id string, body string"))
    assert filled.first()["expanded"] == "x \n{| t\n|}\n y "


def test_both_ways_of_expansion_know_every_name(spark):
    templates = spark.createDataFrame([("Template:Long_name", "old", 1), ("模板:Long name", "new", 2), ("Template:A:B", "ab", 1), ("Template:Call", "{{{{{1}}}}}", 1), ("Template:Deep", "<{{long_name}}>", 1)], "title string, content string, at int")
    pages = spark.createDataFrame([("p", "{{Template:Long name}} {{模板:long_name}} {{A:B}} {{call|deep}} {{None}}"), ("q", "{{Long_name}}"), ("q", "{{deep}}"), ("r", None)], "title string, content string")
    want = [("p", "new new ab <new> {{None}}"), ("q", "<new>"), ("q", "new"), ("r", "None")]
    for limit in (expansion.BROADCAST_CHARS, 0):
        got = sorted((str(r["title"]), str(r["expanded"])) for r in expansion.expand_pages(pages, templates, limit, "at").collect())
        assert got == want


def test_footnotes_and_parsing(spark):
    pages = spark.createDataFrame([(1, 'a<ref name="n"/> b<ref>x</ref> c<ref name="n">body</ref>'), (2, None)], "page int, content string")
    notes = P.number_footnotes(parsing.wiki_footnotes(pages, "page", "content"))
    assert [(r["pos"], r["seq"], r["body"]) for r in notes.orderBy("pos").collect()] == [(0, 1, "body"), (1, 2, "x"), (2, 1, "body")]
    assert parsing.html_nodes(spark.createDataFrame([(1, "<b>x</b>"), (2, None), (3, "")], "id int, t string"), "id", "t").groupBy("id").count().count() == 2


def test_whole_dump_queries_keep_hard_records(spark, tmp_path):
    from lorespark.plans.q_text import QUERIES

    pages = [
        (1, "<!-- <h2>no</h2> <a href='/wiki/No'>n</a> --><h2>a</h2><H3 id=x>b</H3><a href='/wiki/A#f'>a</a> <a href=\"/wiki/A\">a</a>\n{|\n| a || b\n<!--\n| no\n-->\n|-\n| c\n|}"),
        (2, "<pre>x</pre><h2>c</h2><source>s</source><a href=/wiki/B>b</a>\n<nowiki>{|\n| no\n|}</nowiki>\n{|\n! d\n|}"),
        (3, "<h1>d</h1>"),
        (4, None),
    ]
    spark.createDataFrame(pages, "rec_no int, content string").write.parquet(f"{tmp_path}/sdv_full.parquet")
    rows = lambda name: sorted(tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect())
    assert rows("html_headings") == [(1, 2, 1), (1, 3, 1), (2, 2, 1), (3, 1, 1)]
    assert rows("link_edges_from_html") == [(1, "wiki/A", 2), (2, "wiki/B", 1)]
    assert rows("wikitext_table_cells") == [(1, 3), (2, 1)]
