"""The semantic query: conditions and options to a DataFrame.

`parse_ask` reads the template form into an `AskQuery`; `AskQuery.rows` compiles it over a
property table and a page catalogue. By default all conditions hold together, `[[P::+]]` means
that the property exists, `[[~A/*]]` keeps its slash, and categories filter; `compat=True`
gives the stricter older reading: one candidate source by precedence
(page, prefix, namespace), `+` as a literal value, the slash dropped, categories ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorespark.functions.natsort import natkey
from lorespark.functions.strings import without_namespace
from lorespark.operators.props import CATEGORY

_CONDITION = re.compile(r"\[\[(.+?)\]\]", re.S)
FORMATS = {"table", "list", "ul", "template", "count", ""}
#: Rows that a query without a limit may bring into one page.
MAX_TEXT_ROWS = 200_000
DEFAULT_LABEL = "页面"


def canonical(prop: str) -> str:
    prop = prop.strip()
    return prop[:1].upper() + prop[1:]


@dataclass(frozen=True)
class AskQuery:
    page: str | None = None
    prefix: str | None = None
    namespace: str | None = None
    filters: tuple[tuple[str, str], ...] = ()
    categories: tuple[str, ...] = ()
    display: tuple[tuple[str, str], ...] = ()  # (property, label)
    sort: tuple[str, ...] = ()
    limit: int = 0
    main_label: str | None = None
    headers: bool = True
    fmt: str = "table"
    template: str = ""
    compat: bool = field(default=False, kw_only=True)

    def candidates(self, manifest: DataFrame) -> DataFrame:
        """Titles of the catalogue that the page, prefix and namespace conditions leave; these push down to the scan."""
        t = F.col("title")
        tests: list[Column] = []
        if self.page is not None:
            tests.append(t == self.page)
        if self.prefix is not None:
            tests.append(t.startswith(self.prefix))
        if self.namespace is not None:
            tests.append(t.startswith(self.namespace + ":"))
        if self.compat:
            tests = tests[:1]
        for test in tests:
            manifest = manifest.where(test)
        return manifest.where("title <> ''").groupBy("title").agg(F.min("ord").alias("ord"))

    def matching(self, manifest: DataFrame, props: DataFrame) -> DataFrame:
        """(title, ord) of the pages that meet all conditions: the properties are read once for all filters."""
        rows = self.candidates(manifest)
        tests = []
        for prop, value in self.filters:
            of = F.col("prop") == canonical(prop)
            tests.append(of & (F.col("value") == value) if value != "+" or self.compat else of)
        if not self.compat:
            tests += [(F.col("prop") == CATEGORY) & (F.col("value") == name) for name in self.categories]
        if not tests:
            return rows
        either = tests[0]
        for t in tests[1:]:
            either = either | t
        met = props.where(either)
        if len(tests) > 1:
            met = met.groupBy("title").agg(*[F.max(t).alias(f"t{i}") for i, t in enumerate(tests)])
            for i in range(len(tests)):
                met = met.where(f"t{i}")
        return rows.join(met.select("title"), "title", "left_semi")

    def rows(self, manifest: DataFrame, props: DataFrame, rank: bool = False) -> DataFrame:
        """(title, then an array of values per display column, then `rank_no` if asked), sorted and cut.

        Sorting is natural on the first value of each sort property, missing ones first, then in
        catalogue order. Equal labels of display columns get a number.
        """
        hit = self.matching(manifest, props)
        wanted = list(dict.fromkeys(canonical(p) for p, _ in self.display))
        sorts = [canonical(p) for p in self.sort if p.strip()]
        needed = list(dict.fromkeys(wanted + sorts))
        if needed:
            of = props.where(F.col("prop").isin(needed)).join(hit.select("title"), "title", "left_semi")
            ordered = [F.sort_array(F.collect_list(F.when(F.col("prop") == p, F.struct("pos", "value")))).alias(f"p{i}") for i, p in enumerate(needed)]
            hit = hit.join(of.groupBy("title").agg(*ordered), "title", "left")
        values = {p: F.coalesce(F.transform(f"p{i}", lambda x: x["value"]), F.array().cast("array<string>")) for i, p in enumerate(needed)}
        order = [natkey(F.coalesce(F.try_element_at(values[p], F.lit(1)), F.lit(""))) for p in sorts] + [F.col("ord"), F.col("title")]
        used: dict[str, int] = {}
        columns = []
        for p, label in self.display:
            used[label] = used.get(label, 0) + 1
            columns.append(values[canonical(p)].alias(label if used[label] == 1 else f"{label}_{used[label]}"))
        out = hit.orderBy(*order)
        if self.limit > 0:
            out = out.limit(self.limit)
        if rank:
            columns.append(F.row_number().over(Window.orderBy(*order)).alias("rank_no"))  # after the limit
        return out.select("title", *columns)

    def count(self, manifest: DataFrame, props: DataFrame) -> DataFrame:
        return self.matching(manifest, props).agg(F.count("*").alias("n"))

    def text(self, manifest: DataFrame, props: DataFrame) -> DataFrame:
        """One row `wikitext`: a table, list or template calls; '' without results. Rows come together
        in one task, as a page must: more than MAX_TEXT_ROWS without a limit are an error."""
        if self.fmt not in FORMATS:
            raise ValueError(f"unknown format {self.fmt!r}")
        bounded = self if self.limit > 0 else replace(self, limit=MAX_TEXT_ROWS + 1)
        rows = bounded.rows(manifest, props, rank=True)
        labels = [c for c in rows.columns if c not in ("title", "rank_no")]
        link = F.concat(F.lit("[["), F.col("title"), F.lit("|"), without_namespace(F.col("title")), F.lit("]]"))
        cells = [F.array_join(F.col(f"`{c}`"), "<br>") for c in labels]
        if self.fmt == "count":
            return self.count(manifest, props).select(F.col("n").cast("string").alias("wikitext"))
        if self.fmt in ("list", "ul"):
            extra = [F.when(c != "", F.concat(F.lit(" • "), c)).otherwise("") for c in [F.array_join(F.col(f"`{c}`"), "、") for c in labels]]
            line, head, tail = F.concat(F.lit("* "), link, *extra), "", ""
        elif self.fmt == "template":
            args = [F.when(F.size(F.col(f"`{c}`")) > 0, F.concat(F.lit(f"|{c}="), F.array_join(F.col(f"`{c}`"), "、"))).otherwise("") for c in labels]
            first = f"|{self.main_label}=" if self.main_label else "|"
            line, head, tail = F.concat(F.lit("{{" + self.template + first), F.col("title"), *args, F.lit("}}")), "", ""
        else:
            line = F.concat(F.lit("|-\n| "), F.concat_ws("\n| ", link, *cells))
            names = "\n! ".join([self.main_label or DEFAULT_LABEL, *labels])
            head, tail = '{| class="wikitable"\n' + (f"! {names}\n" if self.headers else ""), "\n|}"
        joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank_no", line.alias("line")))), lambda x: x["line"]), "\n")
        too_many = F.when((F.count("*") > MAX_TEXT_ROWS) & F.lit(self.limit <= 0), F.raise_error(F.lit(f"more than {MAX_TEXT_ROWS} rows for one page; give a limit")))
        lines = rows.agg(F.coalesce(too_many.cast("string"), joined).alias("body"))
        return lines.select(F.when(F.col("body") == "", "").otherwise(F.concat(F.lit(head), F.col("body"), F.lit(tail))).alias("wikitext"))


    def expanded(self, manifest: DataFrame, props: DataFrame, templates: DataFrame, page: str = "") -> DataFrame:
        """The `wikitext` of `text` with the template calls of its rows expanded, as on the page `page`."""
        from lorespark.operators.expansion import expand_pages

        pages = self.text(manifest, props).select(F.lit(page).alias("title"), F.col("wikitext").alias("content"))
        return expand_pages(pages, templates).select(F.col("expanded").alias("wikitext"))


def parse_ask(args: list[str] | str, compat: bool = False) -> AskQuery:
    """The conditions in the first argument, then `?P`, `?P=Label` and options. Text between
    conditions and unknown options are ignored; of several pages, prefixes or namespaces the last counts."""
    parts = args.split("|") if isinstance(args, str) else list(args)
    got: dict = {"compat": compat}
    filters, categories = [], []
    for raw in _CONDITION.findall(parts[0] if parts else ""):
        c = raw.strip()
        if "::" in c:
            prop, _, value = c.partition("::")
            filters.append((canonical(prop), value.strip()))
        elif c.startswith("~"):
            prefix = c[1:].removesuffix("*")
            got["prefix"] = prefix.removesuffix("/") if compat else prefix
        elif c.endswith(":+"):
            got["namespace"] = c[:-2].strip()
        elif m := re.match(r"(?:category|分类)\s*:\s*(.*)", c, re.I | re.S):
            categories.append(m[1].strip())
        else:
            got["page"] = c
    display, sort = [], []
    for part in parts[1:]:
        p = part.strip()
        if p.startswith("?"):
            prop, eq, label = p[1:].partition("=")
            display.append((canonical(prop), label.strip() if eq else canonical(prop)))
            continue
        key, eq, value = p.partition("=")
        key, value = key.strip().lower(), value.strip()
        if not eq:
            continue
        if key == "sort":
            sort = [canonical(x) for x in value.split(",") if x.strip()]
        elif key == "limit":
            got["limit"] = int(value) if re.fullmatch(r"\d+", value) else 0
        elif key == "mainlabel":
            got["main_label"] = value
        elif key == "headers":
            got["headers"] = value not in ("hide", "none")
        elif key == "format":
            got["fmt"] = value.lower()
        elif key == "template":
            got["template"] = value
    return AskQuery(filters=tuple(filters), categories=tuple(categories), display=tuple(display), sort=tuple(sort), **got)


def show(props: DataFrame, page: str, wanted: list[str]) -> DataFrame:
    """One row `shown`: the non-empty values of the properties of one page, in the order asked, joined by 、."""
    names = [canonical(p.strip().removeprefix("?").removesuffix("#").partition("=")[0]) for p in wanted]
    order = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("prop"))
    of = props.where((F.col("title") == page) & F.col("prop").isin(names) & (F.col("value") != ""))
    values = F.sort_array(F.collect_list(F.struct(order.alias("o"), "pos", "value")))
    return of.agg(F.array_join(F.transform(values, lambda x: x["value"]), "、").alias("shown"))


def ask_union(queries: list[AskQuery], manifest: DataFrame, props: DataFrame) -> DataFrame:
    """The results of several queries one after another, duplicates kept."""
    out = queries[0].rows(manifest, props)
    for q in queries[1:]:
        out = out.unionByName(q.rows(manifest, props))
    return out


def linkify(rows: DataFrame, value_col: str, manifest: DataFrame) -> DataFrame:
    """Adds `linked`: a value that is the title of a page becomes a link that shows it without its namespace."""
    known = manifest.where("title <> ''").select(F.col("title").alias("__known")).distinct()
    v = F.col(value_col)
    out = rows.join(known, v == F.col("__known"), "left")
    link = F.concat(F.lit("[["), v, F.lit("|"), without_namespace(v), F.lit("]]"))
    return out.withColumn("linked", F.when(F.col("__known").isNotNull(), link).otherwise(v)).drop("__known")


def distinct_queries(stored: DataFrame, key_cols: list[str]) -> DataFrame:
    """Stored queries to run, each distinct key once."""
    return stored.dropDuplicates(key_cols)


def interpolate(text: Column, variables: dict[str, Column]) -> Column:
    """Magic words of a stored query replaced by columns."""
    for name, value in variables.items():
        text = F.replace(text, F.lit("{{" + name + "}}"), F.coalesce(value.cast("string"), F.lit("")))
    return text
