from __future__ import annotations

import collections
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lorespark.llm import content_model as cm
from lorespark.llm import doctree as dt
from lorespark.llm import langid, mixing, neardup, packing, split, termfreq, tokens

# --- markup -------------------------------------------------------------------------------------

PAGE = """{{Infobox|a=b}}

== Wiki ''one'' ==
<h3 class="t"><span>HTML &amp; two</span></h3>

## Md three ##
Setext four
-----------

\\subsection*{Tex \\& \\emph{five}}

* [[A|b]] c
** nested [m](/wiki/M)
# hash item

- dash _x_
  + sub
1. first

<ul><li>open <b>li</b>
<li>closed</li></ul>

\\begin{itemize}
  \\item tex\\_a
\\end{itemize}

<pre>
if a &lt; b
* no
</pre>
```lua
x = 1
== no ==
```

Costs $5 or $7 and $x + 1$ holds. \\(y\\) <math>z</math>

$$
w = 2
$$

<!-- == gone ==
* gone -->
<nowiki>* gone</nowiki>

% \\section{gone}

A 50
% chance

3 * 4 * 5 == 60 and 1 - 2

[[Category:X]]"""


def elements(text):
    tree = dt.parse(text)
    f = cm.Forest([tree])
    p, _ = cm.marginals(f, *cm.trained())
    return {(cm.ELEMENTS[k], tree.label(i)) for i, k in enumerate(tree.kinds) if k in cm.ELEMENTS and p[i, cm.HIDDEN] < 0.5}


@pytest.mark.parametrize("text", [PAGE, PAGE.replace("\n", "\r\n")])
def test_elements_of_a_page(text):
    assert elements(text) == {
        ("heading", "Wiki one"), ("heading", "HTML & two"), ("heading", "Md three"), ("heading", "Setext four"), ("heading", "Tex & five"),
        ("list", "b c"), ("list", "nested m"), ("list", "hash item"), ("list", "dash x"), ("list", "sub"), ("list", "first"), ("list", "open li"), ("list", "closed"), ("list", "tex_a"),
        ("code", "if a < b"), ("code", "x = 1"), ("formula", "x + 1"), ("formula", "y"), ("formula", "z"), ("formula", "w = 2"),
    }


def test_messages_give_exact_marginals():
    rng = np.random.default_rng(5)
    tree = dt.Tree()
    for parent in (0, 0, 1, 1, 3):
        tree.add(int(rng.integers(1, len(dt.KINDS))), parent, "x" * int(rng.integers(0, 90)))
    f = cm.Forest([tree])
    node_w, edge_w = rng.normal(size=(cm.N_FEATURES, 3)), rng.normal(size=(cm.N_EDGES, 3, 3))
    p, joint = cm.marginals(f, node_w, edge_w)
    un = f.unary(node_w)
    total, want = 0.0, np.zeros((6, 3))
    for y in itertools.product((0, 1, 2), repeat=5):
        y = (cm.CONTENT, *y)
        s = np.exp(sum(un[i, y[i]] for i in range(1, 6)) + sum(edge_w[f.edge[i], y[f.parent[i]], y[i]] for i in range(1, 6)))
        total += s
        for i in range(6):
            want[i, y[i]] += s
    assert np.allclose(p, want / total, atol=1e-9) and np.allclose(joint[1:].sum((1, 2)), 1)


def test_training_fits():
    trees, y = cm.labelled()
    p, _ = cm.marginals(cm.Forest(trees), *cm.trained())
    assert (p.argmax(1) == y).all()


#: Pages that the model has not seen, with other words than those it was trained on.
HELD_OUT = [
    [("~", "<nav class=\"top\"><ul><li><a href=\"/x\">Wiki</a></li><li><a href=\"/y\">Events</a></li></ul></nav>"), ("+", "<h1>Cheese press</h1>"), ("+", "<p>The press turns milk into cheese within two hundred minutes.</p>"), ("~", "<div class=\"footer\"><ul><li>Terms of use</li><li>Imprint</li></ul></div>")],
    [("~", "{{Season box|name=Spring}}"), ("+", "Spring is the first season and lasts for four weeks."), ("+", "== Crops =="), ("+", "* Parsnip grows in four days\n* Kale\n** Two harvests"), ("~", "* [[Main page]]\n* [[Search]]\n* [[Random page]]\n* [[Sign in]]"), ("~", "[[Category:Seasons]]")],
    [("-", "<!-- === Draft ===\n# one\n# two -->"), ("+", "# Boil water\n# Add salt"), ("-", "<script>\nvar list = 1;\n* no item\n</script>"), ("~", "Subscribe for the latest news of the valley"), ("+", "Soup restores energy and keeps the cook warm in winter.")],
    [("+", "\\section{Force}"), ("+", "The bow bends as far as $f = k x$ allows before the wood breaks."), ("~", "<div class=\"breadcrumb\"><a href=\"/a\">Start</a> / <a href=\"/b\">Physics</a></div>"), ("+", "\\begin{itemize}\n\\item Yew\n\\item Ash\n\\end{itemize}")],
    [("~", "<div id=\"cookie-notice\"><p>This site stores cookies on your device.</p></div>"), ("+", "## Lamps"), ("+", "- Oil lamp\n- Candle"), ("+", "```\nlight()\n- wick\n# burn\n```"), ("~", "<aside><h3>Share on</h3><ul><li>Letters</li></ul></aside>")],
    [("~", "登录 | 导航"), ("+", "=== 季节 ==="), ("+", "春天的雨水很多，农夫在田里播种。"), ("+", "# 播种\n# 浇水"), ("~", "{{导航框|季节}}"), ("-", "<nowiki>## 不是标题</nowiki>")],
]


def test_the_model_decides_what_the_ancestors_cannot():
    """Ablation: hidden and content as the ancestors alone tell, against the marginals, on pages held out."""
    trees, y = cm.labelled(HELD_OUT)
    f = cm.Forest(trees)
    real = f.kind != dt.ROOT
    p, _ = cm.marginals(f, *cm.trained())
    rule = np.full(len(y), cm.CONTENT)
    for level in f.levels[1:]:
        rule[level] = np.where(np.isin(f.kind[level], (dt.COMMENT, dt.NOWIKI)) | np.isin(f.kind[f.parent[level]], (dt.COMMENT, dt.NOWIKI, dt.CODE)) | (rule[f.parent[level]] == cm.HIDDEN), cm.HIDDEN, cm.CONTENT)
    model_right, rule_right = (p.argmax(1) == y)[real].mean(), (rule == y)[real].mean()
    alone = np.exp(f.unary(cm.trained()[0])).argmax(1)  # node potentials without messages
    assert model_right >= 0.93 and rule_right <= 0.8 and (alone == y)[real].mean() < model_right
    is_element = np.isin(f.kind, list(cm.ELEMENTS))
    assert ((p[:, cm.HIDDEN] >= 0.5) == (y == cm.HIDDEN))[is_element].all()


def test_clean_text_keeps_levels_lists_and_cells():
    page = """= Top =
== Mid ==
1. one
2. two
   - in two

* a
** b
*# c
*# d

<table><thead><tr><th>h1</th><th>h2</th></tr></thead><tr><td>c1</td><td>c2 <b>x</b></td></tr></table>

<script>var a = "== no ==";</script>
{| class="wikitable"
! N !! P
|-
| [[x|y]]
| 2
|}

=== Deep ===
<ol><li>first<ul><li>inner</li></ul></li><li>second</li></ol>
"""
    tree = dt.parse(page)
    p, _ = cm.marginals(cm.Forest([tree]), *cm.trained())
    text = cm.render(tree, p[:, cm.CONTENT] >= 0.5)
    for part in ("# Top\n", "## Mid\n", "### Deep\n", "1. one\n2. two\n  - in two", "- a\n  - b\n  1. c\n  2. d", "h1 | h2\nc1 | c2 x", "N | P\ny | 2", "1. first\n  - inner\n2. second"):
        assert part in text, (part, text)
    assert "var a" not in text and "c1c2" not in text


@pytest.mark.parametrize("many", [1, 8, 300])
def test_long_lists_and_empty_sections_do_not_sway_their_parents(many):
    for text, want in (("```\nx\n" + "* star\n" * many + "```", set()), ("<!--\n" + "* star\n\n== x ==\n\n" * many + "-->", set()), ("== A ==\n\n" + "<!-- == x == -->\n\n" * many, {("heading", "A")}), ("<nowiki>== x ==</nowiki>\n\n" * many + "* b", {("list", "b")})):
        assert {e for e in elements(text) if e[0] != "code"} == want


def test_structure_operator(spark):
    df = spark.createDataFrame([(1, PAGE, "x"), (2, None, None), (3, "", ""), (4, "plain", "e"), (None, "== H ==", "")], "id bigint, t string, elements string")
    rows = {r["item_key"]: r for r in cm.structure(df, "id", "t").collect()}
    assert len(rows[1]["elements"]) == 20 and rows[2]["clean_text"] is None and rows[3]["clean_text"] == "" and rows[4]["clean_text"] == "plain"
    text = rows[1]["clean_text"]
    assert "## Wiki one" in text and "- b c\n  - nested m" in text and "```\nx = 1" in text and "$x + 1$" in text and "gone" not in text and "Infobox" not in text and "Category" not in text
    assert [e["label"] for e in rows[None]["elements"]] == ["H"]


@settings(max_examples=200, deadline=None)
@given(st.text("=#*-+1. \n\r<>/hlipre[]{}|$\\&'`~_x", max_size=100))
def test_any_text_is_a_tree(text):
    tree = dt.parse(text)
    p, _ = cm.marginals(cm.Forest([tree]), *cm.trained())
    assert np.isfinite(p).all()
    cm.render(tree, p[:, cm.CONTENT] >= 0.5)
    [tree.label(i) for i in range(1, len(tree.kinds))]


# --- near-duplicates ----------------------------------------------------------------------------


def near_rows(seed, n=220):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        if i % 3 and out:
            words = out[rng.randrange(len(out))][1].split()
            for _ in range(rng.randint(0, 5)):
                k = rng.randrange(len(words))
                words[k : k + rng.randint(0, 1)] = [rng.choice(vocabulary)]
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.randint(38, 90))]
        out.append((i, " ".join(words)))
    return out


def brute_pairs(rows, width, t, least):
    sets = {}
    for i, s in rows:
        w = regex.findall(r"[\p{L}\p{Nd}]+", (s or "").lower())
        if len(w) >= max(least, width):
            sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-12}


@pytest.mark.parametrize("width,threshold,cell", [(3, 0.6, 64), (5, 0.8, 4)])
def test_near_duplicates_against_brute_force(spark, width, threshold, cell):
    rows = near_rows(width)
    rows += [(1000 + i, rows[0][1].upper()) for i in range(5)]  # copies
    df = spark.createDataFrame(rows + [(2000, None), (2001, ""), (2002, "short text")], "id bigint, t string").withColumn("item", F.lit("clash"))
    near = neardup.NearDuplicates(df.select("id", F.col("t").alias("text"), "item"), "id", "text", width, threshold, 40, cell)
    got = {tuple(r) for r in near.record_pairs().collect()}
    want = brute_pairs(rows, width, threshold, 40)
    assert got == want and len(want) > 50
    classes = {r["item"]: r["class_id"] for r in near.membership().collect()}
    assert all(classes[1000 + i] == 0 for i in range(5)) and 2002 not in classes
    reps = near.pairs().collect()
    assert all(classes[r["item_a"]] == r["item_a"] and r["similarity"] >= threshold - 1e-9 for r in reps)


def test_hot_group_is_spread_and_whole(spark):
    rng = random.Random(9)
    base = [f"v{i}" for i in range(80)]
    rows = []
    for i in range(60):
        words = list(base)
        words[rng.randrange(80)] = f"z{i}"
        rows.append((i, " ".join(words)))
    near = neardup.NearDuplicates(spark.createDataFrame(rows, "id bigint, t string"), "id", "t", 3, 0.6, 40, cell_members=8)
    assert {tuple(r) for r in near.record_pairs().collect()} == brute_pairs(rows, 3, 0.6, 40)


def test_no_pair_at_the_threshold_is_missed(spark):
    rows = []
    for i in range(300):  # pairs that share 60 of 100 shingles, 0.6 exactly, and 59 of 101
        head = [f"a{i}x{k}" for k in range(62 if i % 3 else 61)]
        tail = 20 if i % 3 else 21
        rows += [(2 * i + j, " ".join(head + [f"b{i}x{j}x{k}" for k in range(tail)])) for j in range(2)]
    near = neardup.NearDuplicates(spark.createDataFrame(rows, "id bigint, t string"), "id", "t", 3, 0.6, 40)
    assert {tuple(r) for r in near.record_pairs().collect()} == {(2 * i, 2 * i + 1) for i in range(300) if i % 3} == brute_pairs(rows, 3, 0.6, 40)


def test_every_band_of_similarity_is_whole_and_few_groups_are_opened(spark):
    rng = random.Random(4)
    rows, vocabulary = [], [f"w{k}" for k in range(400)]  # unrelated texts share many single shingles
    for i in range(150):
        words = [f"{rng.choice(vocabulary)}" if rng.random() < 0.3 else f"u{i}x{k}" for k in range(rng.choice([50, 90, 1500 if i < 6 else 200]))]
        words[5:9] = ["the", "same", "few", "words"]
        rows.append((3 * i, " ".join(words)))
        for j in range(2):  # edits from light to heavy, and a moved half
            edited = [f"e{i}x{j}x{k}" if rng.random() < 0.14 * rng.random() else w for k, w in enumerate(words)]
            rows.append((3 * i + 1 + j, " ".join(edited[20:] + edited[:20] if j else edited)))
    near = neardup.NearDuplicates(spark.createDataFrame(rows, "id bigint, t string"), "id", "t", 3, 0.6, 40)
    want = brute_pairs(rows, 3, 0.6, 40)
    got = {(r["item_a"], r["item_b"]): r["similarity"] for r in near.pairs().collect()}
    assert set(got) == want
    bands = collections.Counter(int(s * 20) for s in got.values())
    assert len([b for b in range(12, 20) if bands[b]]) >= 7  # pairs lie in nearly every band from 0.6 on, each of them whole
    opened = near.candidates().count()
    met = sum(1 for a, b in itertools.combinations(rows, 2))
    assert len(want) <= opened < 2 * len(want) < met / 20  # all of them share a shingle with all


def shuffled(spark):
    """Bytes that all stages so far have written to shuffles."""
    gateway = spark.sparkContext._gateway
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    none = gateway.new_array(gateway.jvm.double, 0)
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, none, gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_meetings_are_not_shuffled(spark):
    def cost(n):
        rng = random.Random(n)
        rows = [(i, " ".join(f"m{rng.randrange(12)}" for _ in range(60))) for i in range(n)]  # unrelated, of few shingles that all share
        near = neardup.NearDuplicates(spark.createDataFrame(rows, "id bigint, t string"), "id", "t", 3, 0.6, 40)
        before = shuffled(spark)
        near.candidates().count()
        return shuffled(spark) - before

    cost(50)
    assert cost(3000) < 3 * cost(1500)


def test_blocks_of_the_matrix_add_up(spark, monkeypatch):
    rows = near_rows(3, 120)
    for name, limit in (("BLOCK_CELLS", 1), ("QUERY_MEETINGS", 50), ("STEP", 20)):
        monkeypatch.setattr(neardup, name, limit)
    used, blocks = [], neardup.NearDuplicates._blocks
    monkeypatch.setattr(neardup.NearDuplicates, "_blocks", lambda self, tables: used.extend(blocks(self, tables)) or used)
    near = neardup.NearDuplicates(spark.createDataFrame(rows, "id bigint, t string"), "id", "t", 3, 0.6, 40)
    assert {tuple(r) for r in near.record_pairs().collect()} == brute_pairs(rows, 3, 0.6, 40) and len(used) > 1


def test_steps_are_bounded_by_their_bytes():
    texts = [("word " * 200_000)] * 9 + [None, "short text of words"]  # 1 MB each
    steps = list(neardup._steps(iter([pa.record_batch([pa.array(texts)], names=["t"])]), 3, 0))
    assert sum(len(kept) for _, kept, _ in steps) == 10 and max(len(kept) for _, kept, _ in steps) <= 5


def test_copies_in_many_tasks_count_once(spark):
    text = " ".join(f"c{k}" for k in range(60))
    rows = [(i, text) for i in range(200)] + [(1000, text + " and more"), (1001, " ".join(f"d{k}" for k in range(57)) + " c0 c1 c2 c3")]
    near = neardup.NearDuplicates(spark.createDataFrame(rows, "id bigint, t string").repartition(7), "id", "t", 3, 0.6, 40)
    assert [tuple(r)[:2] for r in near.pairs().collect()] == [(0, 1000)] and near.candidates().count() == 1
    assert near.membership().where("class_id = 0").count() == 200


def test_same_id_with_two_texts_and_clashing_columns(spark):
    a, b = " ".join(f"a{k}" for k in range(50)), " ".join(f"b{k}" for k in range(50))
    rows = [(1, a, "t"), (1, b, None), (2, a + " x", "t"), (3, b + " y", "t"), (None, a, "t"), (4, None, "t"), (5, "", "t")]
    df = spark.createDataFrame(rows, "id bigint, text string, item string").withColumn("part", F.lit(1)).withColumn("query", F.lit(2))
    near = neardup.NearDuplicates(df, "id", "text", 3, 0.6, 40)
    assert {tuple(r) for r in near.record_pairs().collect()} == {(1, 2), (1, 3)}


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "id bigint, t string")
    assert neardup.NearDuplicates(df, "id", "t").record_pairs().count() == 0


# --- splitting ----------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.text("ab. \n\r=。", max_size=300), st.integers(5, 60), st.integers(0, 4))
def test_pieces_cover_the_text(text, limit, overlap):
    spans, _, _ = split.split_spans(text, limit, overlap)
    assert all(0 < b - a <= limit for a, b in spans)
    if spans:
        assert spans[0][0] == 0 and spans[-1][1] == len(text)
        assert all(b0 - overlap == a1 and b1 > b0 for (_, b0), (a1, b1) in zip(spans, spans[1:]))
        assert text[: spans[0][1]] + "".join(text[b0:b1] for (_, b0), (_, b1) in zip(spans, spans[1:])) == text
    else:
        assert text == ""


def cut_by_lines(text, limit):
    """The definition of the cut, from the lengths of lines and paragraphs alone."""
    kind, run = 0, -1
    for line in text.split("\n"):
        line = line.removesuffix("\r")
        if len(line) > limit:
            return 2
        run = run + 1 + len(line) if line.strip() else -1
        kind = max(kind, int(run > limit))
    return kind


@settings(max_examples=400, deadline=None)
@given(st.text("ab. \n\r=", max_size=300), st.integers(5, 40))
def test_the_splitter_reports_its_cut(text, limit):
    assert len(text) <= limit or split.split_spans(text, limit, 2)[1] == cut_by_lines(text, limit)


def test_natural_boundaries():
    text = "\n\n".join("word " * 20 for _ in range(10))
    spans, cut, squeezed = split.split_spans(text, 250, 10)
    assert cut == squeezed == 0 and all(text[b - 2 : b] == "\n\n" for _, b in spans[:-1])
    assert [split.split_spans(t, 100, 10)[1] for t in ("a" * 50 + "\n" + "b" * 50, "a" * 101, "a" * 99 + "\r\n\r\n" + "b" * 99)] == [1, 2, 0]
    # a first paragraph may fill the limit; a later one, which must stand beside the overlap, may not
    spans, cut, squeezed = split.split_spans("a" * 98 + "\n\n" + "b" * 60, 100, 10)
    assert spans == [(0, 100), (90, 160)] and squeezed == 0
    spans, cut, squeezed = split.split_spans("a" * 50 + "\n\n" + "b " * 49 + "\n\n" + "c" * 20, 100, 10)
    assert squeezed == 1 and cut == 0


def test_split_operator(spark):
    df = spark.createDataFrame([(1, "x" * 30), (2, "y" * 10), (3, None), (4, "𠮷 " * 10)], "id bigint, t string")
    got = {r["item_key"]: r for r in split.split_oversized(df, "id", "t", 15, 2).collect()}
    assert set(got) == {1, 4} and got[1]["cut"] == "hard" and "".join(p["piece"][2 if p["piece_no"] else 0 :] for p in got[4]["pieces"]) == "𠮷 " * 10


# --- terms --------------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [3, 100])
def test_terms_against_brute_force(spark, limit):
    texts = ["The the CAFÉ café so­ft ｗｉｄｅ 3x", None, "", "the 中文，字 x_y", "the", "the", "x"] * 3
    df = spark.createDataFrame([(t, 1) for t in texts], "t string, term int")
    occurrences, records = collections.Counter(), collections.Counter()
    for t in texts:
        found = termfreq.terms_of(t or "")
        occurrences.update(found)
        records.update(set(found))
    assert "café" in occurrences and "soft" in occurrences and "wide" in occurrences and "中文" in occurrences
    got = termfreq.term_counts(df, "t", table_limit=limit).collect()
    assert {r["term"]: (r["occurrences"], r["records"]) for r in got} == {k: (occurrences[k], records[k]) for k in occurrences}
    marks = {r["term"]: r["mark"] for r in termfreq.marked_terms(df, "t", rare_below=4).collect()}
    assert marks["the"] == "common" and marks["soft"] == "rare" and marks["x"] == "common"
    assert termfreq.marked_terms(df.limit(0), "t").count() == 0


# --- packing ------------------------------------------------------------------------------------


@pytest.mark.parametrize("task_items", [40_000, 60])
def test_packing(spark, task_items):
    rng = random.Random(4)
    sizes = [(i, rng.choice([1, 5, 30, 60, 100, 101, 250, rng.randint(1, 400)])) for i in range(500)] + [(900, None), (901, 0)]
    profiles = {"a": (100, 1), "b": (1000, 0)}
    packed = packing.pack(spark.createDataFrame(sizes, "item bigint, position int"), "item", "position", profiles, task_items)
    rows = packed.collect()
    for p, (cap, sep) in profiles.items():
        mine = [r for r in rows if r["profile"] == p]
        by, items = collections.defaultdict(list), collections.defaultdict(list)
        for r in mine:
            by[r["container"]].append(r["n_tokens"])
            items[r["item"]].append((r["token_start"], r["n_tokens"]))
        assert all(sum(v) + sep * (len(v) - 1) <= cap for v in by.values())
        want = {i: s for i, s in sizes if s}
        assert set(items) == set(want)
        for i, parts in items.items():
            parts.sort()
            assert (len(parts) == 1) == (want[i] <= cap) and sum(n for _, n in parts) == want[i] and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
        assert sum(want.values()) / (len(by) * cap) > 0.9
        assert sum(2 * (sum(v) + sep * (len(v) - 1)) <= cap - sep for v in by.values()) <= 1  # however many tasks there were
    assert {(r["profile"], r["up_to_half"] <= 1) for r in packing.fill_report(packed, profiles).collect()} == {("a", True), ("b", True)}
    assert packing.pack(spark.createDataFrame([], "i bigint, s int"), "i", "s", profiles).count() == 0


# --- mixing -------------------------------------------------------------------------------------


def test_mixing(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["big ", "BIG", "small-one", "small_one", "tiny", None]) if i % 3 else "big", rng.randint(1, 300)) for i in range(6000)]
    sizes = spark.createDataFrame(rows + [(9000, "big", None)], "item bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("m", "big", 2.0, 1), ("m", "small_one", 1.0, 3), ("m", "none", 5.0, 9), ("n", "tiny", 0.5, 4), ("n", "big", 0.5, 1), ("e", "none", 1.0, 1)], "mix string, source string, target_share double, max_repeats int")
    mix = mixing.Mixture(sizes, targets, block_tokens=500, chunk_rows=700)
    schedule = mix.schedule().collect()
    source = {i: (s or "").strip().lower().replace("-", "_") for i, s, _ in rows}
    limits = {("m", "big"): 1, ("m", "small_one"): 3, ("n", "tiny"): 4, ("n", "big"): 1}
    uses = collections.Counter((r["mix"], r["item"], r["token_start"]) for r in schedule if r["epoch"] == 0)
    assert set(uses.values()) == {1} and all(r["epoch"] < limits[(r["mix"], source[r["item"]])] for r in schedule)
    share = {(r["mix"], r["source"]): r["actual_share"] for r in mix.shares().collect()}
    assert share[("m", "big")] == pytest.approx(2 / 3, abs=0.02) and share[("m", "small_one")] == pytest.approx(1 / 3, abs=0.02) and share[("n", "tiny")] == pytest.approx(0.5, abs=0.02) and share[("m", "none")] == 0 == share[("e", "none")]
    head = [r for r in sorted((r for r in schedule if r["mix"] == "m"), key=lambda r: r["slot"]) if r["slot"] < 100]
    tokens_of = collections.Counter()
    for r in head:
        tokens_of[r["source"]] += r["n_tokens"]
    assert tokens_of["big"] / sum(tokens_of.values()) == pytest.approx(2 / 3, abs=0.1)  # every stretch is mixed
    assert mixing.Mixture(sizes.limit(0), targets).schedule().count() == 0
    # blocks are equal but for the last of a source and epoch, and every epoch holds all of its tokens once
    per_block = mix.blocks.groupBy("source", "epoch", "block").agg(F.sum("n_tokens").alias("t")).collect()
    last = {k: max(r["block"] for r in per_block if (r["source"], r["epoch"]) == k) for k in {(r["source"], r["epoch"]) for r in per_block}}
    assert all(r["t"] == 500 or r["block"] == last[(r["source"], r["epoch"])] for r in per_block)
    held = collections.defaultdict(list)
    for r in mix.blocks.collect():
        held[(r["epoch"], r["item"])].append((r["token_start"], r["n_tokens"]))
    size = {i: n for i, _, n in rows}
    for (_, item), parts in held.items():
        parts.sort()
        assert parts[0][0] == 0 and sum(n for _, n in parts) == size[item] and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
    orders = [[r["item"] for r in sorted((r for r in schedule if (r["mix"], r["source"], r["epoch"]) == ("m", "small_one", e)), key=lambda r: (r["slot"], r["item"]))] for e in (0, 1)]
    assert orders[1] and orders[0][:40] != orders[1][:40]


# --- languages ----------------------------------------------------------------------------------

SPOKEN = {
    "en": ["The old bridge opens in the morning when the market begins.", "Nobody knows how the farmer found the lost ring.", "Rain falls often while the harvest waits in the field."],
    "de": ["Die alte Brücke öffnet am Morgen, wenn der Markt beginnt.", "Niemand weiß, wie der Bauer den verlorenen Ring gefunden hat.", "Der Regen fällt oft, während die Ernte auf dem Feld wartet."],
    "zh": ["旧桥在早晨集市开始的时候开放。", "没有人知道农夫怎样找到丢失的戒指。", "下雨的时候庄稼在田里等待收获。"],
}


def test_languages(spark):
    rng = random.Random(2)
    rows = []
    for i in range(240):
        lang = rng.choice(list(SPOKEN))
        rows.append((i, " ".join(rng.choice(SPOKEN[lang]) for _ in range(3)), lang if rng.random() > 0.1 else rng.choice(["en", "de", "zh"]), lang))
    mixed = SPOKEN["en"][0] + "\n" + SPOKEN["de"][1]
    special = [(900, mixed, "en"), (901, SPOKEN["de"][0] + " (ring)", "German"), (902, SPOKEN["en"][1], None), (903, None, "en"), (904, "12 / 13", "de"), (905, "{{#invoke:x|y}} [[Die alte Brücke]] " + SPOKEN["en"][2], "en_GB"), (906, "", "")]
    df = spark.createDataFrame([r[:3] for r in rows] + special, "id bigint, text string, lang string").withColumn("segments", F.lit(1))
    got = {r["item_key"]: r for r in langid.detect(df, "id", "text", "lang").collect()}
    assert all([x["lang"] for x in got[i]["languages"]] == [lang] for i, _, _, lang in rows)
    assert all(got[i]["relabel"] == (label != lang) for i, _, label, lang in rows)
    assert {x["lang"] for x in got[900]["languages"]} == {"en", "de"} and len(got[900]["segments"]) == 2 and got[900]["relabel"]
    assert not got[901]["relabel"] and got[902]["relabel"] and not got[905]["relabel"]
    assert all(not got[i]["relabel"] and got[i]["languages"] == [] for i in (903, 904, 906))
    assert langid.detect(df.limit(0), "id", "text", "lang").count() == 0


class _Decided:
    """Sentences that name their language; a question mark makes the margin small, two leave it unclear."""

    def decide(self, prose):
        return prose.split()[0], 0.9, 0.01 if "?" in prose else 0.5

    def clear(self, prose, lang):
        return "??" not in prose


def test_a_certain_language_is_not_renamed():
    langs = lambda text: [s["lang"] for s in langid.segments(_Decided(), text)]
    assert langs("es uno dos tres??\n" + "es uno dos tres.\n" * 10 + "en one two three.") == ["es", "en"]
    assert langs("es uno dos tres??\nen one two three.") == ["en"]
    assert langs("es uno dos tres.\npt um dois tres?\nes uno dos tres.") == ["es", "pt", "es"]
    assert langs("es uno dos tres.\npt um dois tres??\nes uno dos tres.") == ["es"]


def test_a_small_margin_is_clear_if_all_that_tells_apart_agrees():
    shared = [f"^{c}{d}$" for c in "abcdefgh" for d in "ijklmnop"] * 4
    es, pt = (1 << langid.LANGS.index(k) for k in ("es", "pt"))
    only = [f"^z{c}$" for c in "abcdefghij"]
    filters = langid.Filters.fill({g: es | pt for g in shared} | {g: pt for g in only})
    text = " ".join(g[1:3] for g in shared + only)
    lang, _, margin = filters.decide(text)
    assert lang == "pt" and margin < langid.MIN_MARGIN and filters.clear(text, "pt") and not filters.clear(text, "es")
    assert not filters.clear(" ".join(g[1:3] for g in shared), "pt")


def test_labels():
    assert [langid.label_code(x) for x in ("EN", "zh_Hans", "deu", "French", "pt-BR", "??", "", None, "unknown", "Chinese (Simplified)", "xx")] == ["en", "zh", "de", "fr", "pt", None, None, None, None, "zh", None]


def test_filter_has_no_false_negative():
    members = {f"g{i}": 1 << (i % 9) for i in range(5000)}
    f = langid.Filters.fill(members)
    assert all(f.mask(g) & m == m for g, m in members.items())
    extra = sum(bin(f.mask(f"x{i}")).count("1") for i in range(20000)) / 20000
    assert extra == pytest.approx(sum(f.false_rates), rel=0.5, abs=1e-3)


# --- tokens -------------------------------------------------------------------------------------


def test_token_sizes(spark):
    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "id int, text string")
    assert {r["id"]: r["n_tokens"] for r in tokens.token_sizes(df, ["id"], "text").collect()} == {1: 2, 2: 0, 3: None}
