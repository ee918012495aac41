"""Template expansion of whole corpora."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorespark.functions.strings import namespace_of, without_namespace
from lorespark.functions.template import Expander
from lorespark.functions.titles import clean_title, uc_first
from lorespark.session import materialise, ship

#: Template sources up to this many characters go to the executors as a whole.
BROADCAST_CHARS = 32 * 1024 * 1024
_RESULT = "title string, expanded string, props array<struct<prop:string,value:string>>"
_PAIR = pa.struct([("prop", pa.string()), ("value", pa.string())])


def _expand(shared: dict[str, str] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        env = Expander(shared) if shared is not None else None
        for batch in batches:
            texts, props = [], []
            own = batch.column(2).to_pylist() if env is None else [None] * batch.num_rows
            for title, text, needed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), own):
                if text is None:
                    texts.append(None)
                    props.append([])
                    continue
                done, found = (env or Expander(dict(needed or []))).expand(text, title or "")
                texts.append(done)
                props.append([{"prop": p, "value": v} for p, v in found])
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string()), pa.array(props, pa.list_(_PAIR))], names=["title", "expanded", "props"])

    return run


class _Asked(dict):
    """Templates that keep the names asked for in vain."""

    def __init__(self, items):
        super().__init__(items)
        self.missed: set[str] = set()

    def __contains__(self, name: object) -> bool:
        if super().__contains__(name):
            return True
        self.missed.add(name)
        return False


def _missed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        missed = []
        for title, text, needed in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
            have = _Asked(needed or [])
            Expander(have).expand(text, title or "")
            missed.append(sorted(have.missed))
        yield pa.record_batch([batch.column(0), pa.array(missed, pa.list_(pa.string()))], names=["id", "names"])


def expand_pages(pages: DataFrame, templates: DataFrame, limit: int = BROADCAST_CHARS, order_col: str | None = None, namespaces: tuple[str, ...] = ("模板", "Template")) -> DataFrame:
    """(title, expanded, props) of pages (title, content) with templates (title, content).

    Of templates whose titles are alike but for underscores, spaces and the case of the first letter
    one of a namespace that comes earlier in `namespaces` is taken, then the one with the greatest
    `order_col`. The size of the templates is checked: small ones
    are shipped once. Beyond `limit` characters each page gets just those it calls: in rounds, pages
    are expanded and the names asked for in vain are joined, until none of them is a template.
    """
    ship(pages.sparkSession)
    known = F.array_position(F.array(*[F.lit(n.lower()) for n in namespaces]), F.lower(namespace_of(F.col("title"))))
    rank = F.when(known > 0, -known).otherwise(F.lit(-(len(namespaces) + 1)))
    pick = F.max_by("content", F.struct(rank, F.col(order_col))) if order_col else F.min_by("content", F.struct(-rank, "content"))
    named = templates.where("content IS NOT NULL").groupBy(uc_first(clean_title(without_namespace(F.col("title")))).alias("name")).agg(pick.alias("content"))
    size = named.agg(F.coalesce(F.sum(F.length("content")), F.lit(0)).alias("n")).first()["n"]
    if size <= limit:
        shared = {r["name"]: r["content"] for r in named.collect()}
        return pages.select("title", "content").mapInArrow(_expand(shared), _RESULT)
    named = materialise(named)
    pages = materialise(pages.select(F.monotonically_increasing_id().alias("id"), "title", "content"))
    state = pages.withColumn("needed", F.lit(None).cast("map<string,string>"))
    calls = None
    todo = state.where("content IS NOT NULL")
    while True:
        missed = todo.mapInArrow(_missed, "id bigint, names array<string>").select("id", F.explode("names").alias("name"))
        found = materialise(missed.join(named.select("name"), "name", "left_semi").select("id", "name"))
        if found.isEmpty():
            return state.select("title", "content", "needed").mapInArrow(_expand(None), _RESULT)
        calls = found if calls is None else materialise(calls.unionByName(found))
        per_page = calls.join(named, "name").groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("name", "content"))).alias("needed"))  # at most the templates one page calls
        state = materialise(pages.join(per_page, "id", "left"))
        todo = state.join(found.select("id").distinct(), "id", "left_semi")


def expanded_properties(expanded: DataFrame) -> DataFrame:
    """The property table that expansion collected."""
    from lorespark.operators.props import distinct_values

    return distinct_values(expanded.select("title", F.posexplode("props").alias("pos", "p")).select("title", "p.prop", "p.value", "pos"))


def fill_placeholders(pages: DataFrame, results: DataFrame) -> DataFrame:
    """`expanded` with each mark `@@id@@` replaced by the `body` of `results` (title, id, body), blocks set off by lines.

    Marks without a result vanish. A page holds few marks, so its results fit one array.
    """
    per = results.groupBy("title").agg(F.collect_list(F.struct(F.concat(F.lit("@@"), F.col("id"), F.lit("@@")).alias("mark"), F.when(F.col("body").rlike(r"^(\{\||[*#|])"), F.concat(F.lit("\n"), F.col("body"), F.lit("\n"))).otherwise(F.col("body")).alias("body"))).alias("r"))
    filled = F.aggregate(F.coalesce("r", F.array().cast("array<struct<mark:string,body:string>>")), F.col("expanded"), lambda a, x: F.replace(a, x["mark"], x["body"]))
    return pages.join(per, "title", "left").withColumn("expanded", F.regexp_replace(filled, "@@[A-Za-z0-9_-]+@@", "")).drop("r")
