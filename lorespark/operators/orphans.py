"""References to records that do not exist (problem 4).

State is kept by target title: the first listing of the parent and the last deletion or
restoration. References probe it in the order of time; one that finds no live parent is pending.
`evaluate` folds the events it is given; `streaming.pending_orphans` keeps the state and gives it
those of a batch, `resolve` a whole history at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorespark.functions import markup
from lorespark.functions.titles import canonical_title
from lorespark.session import materialise, ship

#: A title with more than this share of all references is spread over several tasks; at most
#: 1 / HOT_SHARE titles can be hot, so their list is small by construction.
HOT_SHARE = 1 / 256


def _targets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        titles, spaces, texts = (batch.column(i).to_pylist() for i in (1, 2, 3))
        found = []
        for title, ns, text in zip(titles, spaces, texts):
            refs = [] if text is None else markup.module_references(text) if ns == 828 else markup.references(text, title)
            found.append(([title] if title else []) + refs)
        yield pa.record_batch([batch.column(0), batch.column(4), pa.array(found, pa.list_(pa.string()))], names=["rec_no", "dumped_at", "raw"])


def page_references(dump: DataFrame) -> DataFrame:
    """(rec_no, dumped_at, ref_title): the distinct references of each record, its own title among them.

    Null contents hold no references; a null title is none and has no sub-pages.
    """
    ship(dump.sparkSession)
    kinds = dict(dump.dtypes)
    rows = dump.select("rec_no", "title", F.col("ns").cast("int"), "content", "dumped_at")
    raw = rows.mapInArrow(_targets, f"rec_no {kinds['rec_no']}, dumped_at {kinds['dumped_at']}, raw array<string>")
    targets = F.array_distinct(F.transform("raw", canonical_title))
    return raw.select("rec_no", "dumped_at", F.explode(targets).alias("ref_title")).where("ref_title <> ''")


def page_listings(manifest: DataFrame, core_pages: DataFrame, images: DataFrame) -> DataFrame:
    """(ref_title, first_listed) of every listing of a page or an image."""
    pages = manifest.where("title <> '' AND path <> ''").select(F.col("title").alias("t"), "listed_at")
    core = core_pages.where("title <> ''").select(F.col("title").alias("t"), "listed_at")
    files = images.where("name <> '' AND path <> ''").select(F.concat(F.lit("File:"), F.col("name")).alias("t"), "listed_at")
    rows = pages.unionByName(core).unionByName(files).select(canonical_title(F.col("t")).alias("ref_title"), "listed_at")
    return rows.where("ref_title <> ''").withColumnRenamed("listed_at", "first_listed")


def deletion_log(page_log: DataFrame) -> DataFrame:
    """(ref_title, logged_at, log_id, deleted) of deletions and restorations; repeated rows once."""
    action = F.lower(F.trim("log_action"))
    rows = page_log.where(action.isin("delete", "restore") & F.col("logged_at").isNotNull())
    return rows.select(canonical_title(F.col("title")).alias("ref_title"), "logged_at", "log_id", (action == "delete").alias("deleted")).where("ref_title <> ''").distinct()


def status_of(listed: Column, first_listed: Column, deleted: Column, at: Column) -> Column:
    """The state of a reference; null if it holds. A reference without a time is never deleted or late."""
    return F.when(listed.isNull(), "missing").when(deleted, "deleted").when(first_listed > at, "late")


def resolve(refs: DataFrame, parents: DataFrame, log: DataFrame, hot_share: float = HOT_SHARE) -> DataFrame:
    """(rec_no, dumped_at, ref_title, status) of the references that do not hold, from a whole history."""
    return evaluate(materialise(refs), parents, log, hot_share).where("status IS NOT NULL").drop("again")


def hot_titles(refs: DataFrame, hot_share: float = HOT_SHARE) -> DataFrame:
    """(ref_title, salts) of the titles with more than their share of the references; at most 1 / hot_share rows."""
    total = refs.count()
    per_title = refs.groupBy("ref_title").agg(F.count("*").alias("n"))
    return per_title.where(F.col("n") > total * hot_share).select("ref_title", F.ceil(F.col("n") / F.lit(max(1.0, total * hot_share))).cast("int").alias("salts"))


def evaluate(refs: DataFrame, parents: DataFrame, log: DataFrame, hot_share: float = HOT_SHARE, hot: DataFrame | None = None) -> DataFrame:
    """(rec_no, dumped_at, ref_title, again, status) of references that are stored; the status of one that holds is null.

    A title may have several parents, of which the earliest counts. `again` is taken over where
    there is such a column. `hot` may give the hot titles, if they are known. All events of a title meet in one ordered fold: its parent first, then the log and the
    references by time, the log first on ties and the greater log_id last. References of a hot
    title are spread over salts, and only its parent and log are copied to each of them.
    """
    if "again" not in refs.columns:
        refs = refs.withColumn("again", F.lit(None).cast("boolean"))
    hot = F.broadcast(hot_titles(refs, hot_share) if hot is None else hot)  # at most 1 / hot_share rows

    def salted(df: DataFrame, one: bool) -> DataFrame:
        joined = df.join(hot, "ref_title", "left")
        if one:
            return joined.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("rec_no"), F.col("salts")).cast("int"), F.lit(0))).drop("salts")
        return joined.withColumn("salt", F.explode(F.when(F.col("salts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("salts") - 1)))).drop("salts")

    time = dict(refs.dtypes)["dumped_at"]
    nothing = {"rec_no": dict(refs.dtypes)["rec_no"], "at": time, "listed": "boolean", "first_listed": time, "deleted": "boolean", "log_id": "bigint", "is_ref": "boolean", "again": "boolean"}

    def event(df: DataFrame, **given: Column) -> DataFrame:
        return df.select("ref_title", "salt", *[given.get(k, F.lit(None)).cast(t).alias(k) for k, t in nothing.items()])

    events = (
        event(salted(refs, True), rec_no=F.col("rec_no"), at=F.col("dumped_at"), is_ref=F.lit(True), again=F.col("again"))
        .unionByName(event(salted(parents, False), listed=F.lit(True), first_listed=F.col("first_listed")))
        .unionByName(event(salted(log, False), at=F.col("logged_at"), deleted=F.col("deleted"), log_id=F.col("log_id")))
    )
    order = [F.col("listed").desc_nulls_last(), F.col("at").asc_nulls_first(), F.col("is_ref").asc_nulls_first(), F.col("log_id").asc_nulls_first()]
    state = Window.partitionBy("ref_title", "salt").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(c, ignorenulls=True).over(state)
    folded = events.select("rec_no", F.col("at").alias("dumped_at"), "ref_title", "is_ref", "again", last("listed").alias("l"), F.min("first_listed").over(state).alias("f"), last("deleted").alias("d"))
    status = status_of(F.col("l"), F.col("f"), F.col("d") & F.col("dumped_at").isNotNull(), F.col("dumped_at"))
    return folded.where("is_ref").select("rec_no", "dumped_at", "ref_title", "again", status.alias("status"))


def snapshot(orphans: DataFrame) -> DataFrame:
    """Counts per target table, month and status."""
    where = F.when(F.col("ref_title").startswith("File:"), "images_manifest").otherwise("manifest")
    month = F.date_format("dumped_at", "yyyy-MM")
    return orphans.groupBy(where.alias("target_table"), month.alias("period"), "status").agg(F.count("*").alias("orphan_refs"), F.countDistinct("ref_title").alias("orphan_titles"))
