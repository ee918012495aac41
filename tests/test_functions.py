from __future__ import annotations

import functools
import math
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lorespark.functions import exprs as X
from lorespark.functions import html_dom as H
from lorespark.functions import lua, markup
from lorespark.functions import strings as S
from lorespark.functions import wikitext as W
from lorespark.functions.natsort import natkey
from lorespark.functions.template import Expander
from lorespark.functions.titles import canonical_title


def natural(a: str, b: str) -> int:
    ra, rb = (re.findall(r"[0-9]+|[^0-9]+", x) for x in (a, b))
    for x, y in zip(ra, rb):
        dx, dy = x.isdigit(), y.isdigit()
        if dx and dy and int(x) != int(y):
            return -1 if int(x) < int(y) else 1
        if dx != dy:
            return -1 if dx else 1
        if not dx and x != y:
            return -1 if x < y else 1
    return (len(ra) > len(rb)) - (len(ra) < len(rb))


def test_natural_order(spark):
    rng = random.Random(3)
    words = ["", "9", "10", "b", "b-3", "b-24", "01", "中2", "中10", None] + ["".join(rng.choice("ab019-中") for _ in range(rng.randint(0, 6))) for _ in range(300)]
    got = [r["w"] for r in spark.createDataFrame([(w,) for w in words], "w string").orderBy(natkey(F.col("w"))).collect()]
    for a, b in zip(got, got[1:]):
        assert natural(a or "", b or "") <= 0, (a, b)


CASES = {"2 + 3 * 4": 14, "7 mod 3": 1, "-7 mod 3": -1, "7 div 2": 3, "-7 div 2": -3, "1 / 0": 0, "5 % 0": 0, "abc": 0, "": 0, "1 = 1.0": 1, "1 <> 1": 0, "2.5 round 0": 3, "-2.5 round 0": -3, "1234 round -2": 1200, "1 + 1 round 0 * 2": 2, "floor(-1.5)": -2, "trunc(-1.5)": -1, "abs(-3) + ceil(1.2)": 5, "(1 + 2": 3, "1.5e3": 1500, "2 < 3 < 0": 0, "1 $ 2": 1}


def test_expressions(spark):
    row = spark.range(1).select(*[X.to_column(X.parse(e)).alias(f"c{i}") for i, e in enumerate(CASES)]).first()
    for i, (e, want) in enumerate(CASES.items()):
        assert X.evaluate(X.parse(e)) == pytest.approx(want), e
        assert row[i] == pytest.approx(want), e
    assert X.expr("0.1 + 0.2") == "0.3" and X.expr("10 / 4") == "2.5" and X.expr("6 / 3") == "2"


@settings(max_examples=60, deadline=None)
@given(st.text("0123456789+-*/%() .eroundmiv<>=", max_size=30))
def test_any_expression_has_a_value(text):
    try:
        assert isinstance(X.evaluate(X.parse(text)), float)
    except OverflowError:
        pass


def test_string_functions(spark):
    df = spark.createDataFrame([("abcdef", "a/b/c"), ("", ""), (None, None)], "s string, t string")
    s, t = F.col("s"), F.col("t")
    rows = df.select(
        S.position(s, "c").alias("pos"), S.position(s, "z").alias("nopos"), S.sub(s, -3, 2).alias("sub"), S.sub(s, 2, -10).alias("swap"), S.explode_part(t, "/", -1).alias("last"), S.explode_part(t, "/", 9).alias("out"),
        S.title_parts(t, 2, 2).alias("parts"), S.title_parts(t, 0).alias("none"), S.replace_all(s, "", "x").alias("same"), S.url_encode(F.lit("a b*~ü")).alias("url"),
    ).collect()
    assert tuple(rows[0]) == ("2", "", "de", "", "c", "", "b", "", "abcdef", "a%20b%2A~%C3%BC")
    assert rows[1]["sub"] == "" and rows[1]["pos"] == "" and rows[1]["last"] == ""
    assert rows[2]["sub"] is None and rows[2]["last"] is None
    sw = spark.createDataFrame([("a",), ("b",), ("c",), ("z",), (None,)], "v string").select(S.switch(F.col("v"), ["a", "b= AB ", "c=C", "#default=D"]).alias("r"))
    assert [r["r"] for r in sw.collect()] == ["AB", "AB", "C", "D", "D"]
    arr = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],), (None,)], "a array<string>").select(S.list_to_text(F.col("a")).alias("p"), S.array_index(F.col("a"), -1, "d").alias("i"))
    assert [tuple(r) for r in arr.collect()][:3] == [("a、b和c", "c"), ("a", "a"), ("", "")]


def test_canonical_titles(spark):
    given_ = ["\u200ecategory: foo_bar", "分类:x#y", "Image:a b.png", " main  Page ", ":Category:Z", "#only", "", None, "template:Box", "Foo:bar"]
    want = ["Category:Foo bar", "Category:X", "File:A b.png", "Main Page", "Category:Z", "", "", None, "Template:Box", "Foo:bar"]
    assert [r[0] for r in spark.createDataFrame([(g,) for g in given_], "t string").select(canonical_title(F.col("t"))).collect()] == want


def test_references():
    text = """{{Box|1={{{1|}}}}} [[A|b]] [[/Sub/]] [[fr:X]] [[#s]] {{#invoke: Mod |f}} {{#if:x|{{Inner}}}} {{PAGENAME}} <!-- [[No]] -->
% \\href{/wiki/No}{x}
<nowiki>{{No}}</nowiki>
<pre>[[No]]</pre> <a href="/wiki/H_%28x%29">h</a> <A HREF='/wiki/Q'>q</A> [m](/wiki/M%3F) \\href{/wiki/L\\_x}{l} [[{{{1}}}]]
<gallery>
File:g.png|cap
</gallery>
```
[[No]]
```
"""
    got = markup.references(text, "\u200eParent ")
    assert set(got) == {"Template:Box", "A", "Parent/Sub", "#s", "Module:Mod", "Template:Inner", "H_(x)", "Q", "M?", "L_x", "File:g.png"}
    assert markup.module_references("require('Module:A') mw.loadData(\"Module:B\") -- require('Module:C')\n--[[ require('Module:D') ]]") == ["Module:A", "Module:B"]


def test_templates():
    env = Expander({"Box": "<b>{{{1|none}}}</b>{{#if:{{{x|}}}|X={{{x}}}}}<noinclude>doc</noinclude>", "Loop": "{{Loop}}a", "Deep": "{{Box|{{Box|in}}}}"}, titles={"Main Page"}, pages=lambda t: "<section begin=s />one<section end=s />two\n== H ==\nbody\n== I ==" if t == "P" else None, modules={"m": lambda f, pos, named: f"{f}:{pos}:{named.get('k')}"})
    cases = {
        "{{box|A|x=2}}": "<b>A</b>X=2", "{{Box}}": "<b>none</b>", "{{Loop}}": "a", "{{Deep}}": "<b><b>in</b></b>", "{{#switch:b|a|b=AB|#default=z}}": "AB", "{{#switch:q|a=1|d}}": "d", "{{#ifexpr:1>2|y|n}}": "n",
        "{{#ifexist:main Page|yes|no}}": "yes", "{{PAGENAME}}/{{NAMESPACE}}/{{SUBPAGENAME}}": "C/NS/B/C", "{{Nope|a}}": "{{Nope|a}}", "<nowiki>{{Box}}</nowiki>": "<nowiki>{{Box}}</nowiki>", "{{#lst:P|s}}": "one", "{{#lsth:P|H}}": "body",
        "{{#invoke:M|f|a|k=v}}": "f:['a']:v", "{{#arraydefine:k|a,b}}{{#arrayindex:k|-1}}": "b", "{{{{{1|Box}}}|q}}": "<b>q</b>", "{{!}}{{#time:x}}": "|", "{{open": "{{open", "{{#iferror:{{#expr:1}}|e|ok}}": "ok",
    }
    for given_, want in cases.items():
        assert env.expand(given_, "NS:A/B/C")[0] == want, given_
    assert env.expand("[[p::v|l]]{{#set:Q=w|R=}}[[P::]]")[1] == [("P", "v"), ("Q", "w")]


def test_lua():
    assert lua.read_table('return { a = 1, ["b"] = {1, -2.5, "x\\n"}, [3] = true, s = [[long]] }') == {"a": 1, "b": [1, -2.5, "x\n"], "3": True, "s": "long"}
    for bad in ("{1} x", "{", "return f()", "{[1]}"):
        with pytest.raises(ValueError):
            lua.read_table(bad)
    assert lua.enum_rows('p.T = { "a", [5] = "b", "c" }') == [{"table": "T", "key": 1, "label": "a"}, {"table": "T", "key": 5, "label": "b"}, {"table": "T", "key": 2, "label": "c"}]


def test_html():
    doc = H.nodes("<ul><li>a<li>b</ul></p><img src='x>y'><!-- c -->&amp;")
    assert [(n["tag"], n["text"], n["parent_id"]) for n in doc] == [("#document", "", -1), ("ul", "", 0), ("li", "", 1), ("", "a", 2), ("li", "", 1), ("", "b", 4), ("img", "", 0), ("", "&", 0)]
    cells = H.table_cells("<table><tr><td rowspan=2>a<td colspan=2>b<tr><td>c<td>d</table>")
    assert [(c["row_ix"], c["col_ix"], c["text"]) for c in cells] == [(0, 0, "a"), (0, 1, "b"), (1, 1, "c"), (1, 2, "d")]
    dots = lambda n: "." * n
    runs = H.gauges(f'<p class="sharpness"><i class=a>{dots(9)}</i><i class=b>{dots(30)}</i>\n<i class=a>{dots(34)}</i></p>')
    assert [g["pct"] for g in runs] == [23, 77, 87]
    assert H.resolve("data/1.html", "../ida/2.html#x") == ("ida/2.html", "x") and H.resolve("a", "http://x") is None and H.resolve("a", "#b") is None
    assert len(H.table_cells("<table>" + "<tr><td>1<td>2" * 2500 + "</table>")) == 5000
    assert H.page_meta("<title>A | B</title><p class=breadcrumb>X > Y > A</p>", "data/12.html") == {"title": "A", "namespace": "Y", "pageid": 12}
    assert H.strip_chrome('<head>h</head><div id="nav"><div>x</div></div>\n\n\nrest') == "\nrest"
    assert H.inject('<p id="a"></p>', {"a": "x\\u0041\\n"}) == '<p id="a">xA\n</p>'


def test_wikitext():
    rows = W.nodes("Intro\nmore\n" + "\n".join(f"* [[Page/{i}|{i}]]" for i in range(10)))
    assert [r["kind"] for r in rows] == ["paragraph", "bullet_list"] + ["item"] * 10
    cells = W.table_cells("{|\n|-\n| rowspan=4 | a || rowspan=2 | b || c\n|-\n| d\n|-\n| rowspan=2 | e || f\n|-\n| g\n|}")
    by_row = {r: [c["col_ix"] for c in cells if c["row_ix"] == r] for r in range(4)}
    assert by_row == {0: [0, 1, 2], 1: [2], 2: [1, 2], 3: [2]}
    assert W.link_row("File:A.png|thumb|120x40px|left|link=B|cap")["width"] == 120
    assert [W.link_row(x)["kind"] for x in ("Category:A", "p::v", "fr:B", "A#b|c", "文件:x.png")] == ["category", "property", "interwiki", "internal", "file"]
    assert W.variants("a-{zh-tw:x;zh-cn:y}-b") == "ayb"
    assert W.map_rows(" @@WIKIMAP| a.png |T|10|20.5px|1,2;bad;3,4@@")["markers"] == [{"left": 1.0, "top": 2.0}, {"left": 3.0, "top": 4.0}]
    assert all(W.map_rows(x) is None for x in ("@@MAP|a.png|T|10|20|1,2@@", "@@WIKIMAP|a.png|T|10|0|1,2@@", "@@WIKIMAP||T|10|20|1,2@@", "@@WIKIMAP|a.png|T|10|20|@@", "plain"))


@settings(max_examples=150, deadline=None)
@given(st.text("[]{}|<>!-*#=':\n ax/&;\\$`~", max_size=80))
def test_parsers_take_any_text(text):
    W.nodes(text), W.table_cells(text), W.links(text), H.nodes(text), H.blocks(text), H.table_cells(text), markup.references(text, "T")
    Expander({"a": text}).expand(text, "T")


def test_round_trip_of_comparators():
    assert math.isclose(X.evaluate(("round", ("num", 2.345), ("num", 2.0))), 2.35)
    assert functools.cmp_to_key(natural)("a2") < functools.cmp_to_key(natural)("a10")


def test_html_inside_wikitext():
    rows = W.nodes("<div class=x>\n== H ==\n* a\n</div>after\n<ul><li>p<li>q</ul>\n<table><tr><td>c</table>")
    assert [(r["kind"], r["depth"], r["text"]) for r in rows] == [("container", 0, ""), ("heading", 1, "H"), ("bullet_list", 1, ""), ("item", 2, "a"), ("paragraph", 0, "after"), ("bullet_list", 0, ""), ("item", 1, "p"), ("item", 1, "q"), ("table", 0, ""), ("cell", 1, "c")]
    assert len(W.nodes("<div>" * 300 + "x")) > 0


def test_colours(spark):
    """Against the standard library's conversion by hue, for all lengths of hex colours."""
    import colorsys
    import random

    def brute(c, applies, light, saturation):
        digits = c[1:] if len(c) > 5 else "".join(x * 2 for x in c[1:])
        h, l, s = colorsys.rgb_to_hls(*(int(digits[i : i + 2], 16) / 255 for i in (0, 2, 4)))
        if not applies(l):
            return c
        rgb = colorsys.hls_to_rgb(h, light(l), saturation(s))
        return "#" + "".join(f"{max(0, min(255, int(x * 255 + 0.5))):02x}" for x in rgb) + digits[6:]

    rng = random.Random(6)
    colours = ["#000", "#fff", "#000000", "#ffffff", "#808080", "#12345678", "#abcd", *(f"#{rng.randrange(1 << 24):06x}" for _ in range(300))]
    rows = spark.createDataFrame([(c,) for c in [*colours, "red", "#12345", None]], "c string").select("c", S.dark_text_colour(F.col("c")).alias("t"), S.dark_ground_colour(F.col("c")).alias("g")).collect()
    near = lambda x, y: x == y or len(x) == len(y) and all(abs(int(x[i : i + 2], 16) - int(y[i : i + 2], 16)) <= 1 for i in range(1, len(x), 2))
    for r in rows:
        if r["c"] in colours:
            assert near(r["t"], brute(r["c"], lambda l: l < 0.5, lambda l: 0.53 + (0.5 - l) * 0.28, lambda s: min(s, 0.8)))
            assert near(r["g"], brute(r["c"], lambda l: l >= 0.5, lambda l: 0.2 + (l - 0.5) * 0.18, lambda s: s * 0.55))
        else:
            assert r["t"] == r["g"] == r["c"]


def test_positions_and_parts_of_texts(spark):
    from lorespark.functions.template import Expander

    expand = lambda t: Expander({}).expand(t, "P")[0]
    assert [expand(t) for t in ("{{#sub:abcdef|1|0}}", "{{#sub:abcdef|1}}", "{{#pos:abcabc|a|-1}}", "{{#pos:abc||1}}", "{{ns:文件}}", "{{ns:12}}", "{{ns:User talk}}", "{{ns:nothing}}")] == ["", "bcdef", "0", "1", "File", "Help", "User talk", "nothing"]
    row = spark.createDataFrame([("abcabc",)], "s string").select(S.position(F.col("s"), "a", -1).alias("a"), S.position(F.col("s"), "", 2).alias("b"), S.position(F.col("s"), "", 99).alias("c")).first()
    assert tuple(row) == ("0", "2", "6")


def test_nesting_has_no_bound():
    deep = "<div>\n" * 60 + "* in the middle\n" + "</div>\n" * 60
    got = W.nodes(deep)
    assert any(n["kind"] == "item" and n["text"] == "in the middle" and n["depth"] >= 60 for n in got)
