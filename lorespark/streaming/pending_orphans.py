"""Pending orphans kept up to date batch by batch (problem 4).

State lies below a folder that all executors share, as deltas: a batch appends the references, the
listings and the log entries that it brings, and the changes of the orphans that follow from them.
Nothing that is there is written again until `compact` replaces the deltas by one table each.

A batch looks only at what it touches: new references probe the parent index and the log; arriving
parents take up the waiting orphans of their titles; deletions and restorations take up all earlier
references to theirs. The orphans after all batches are those that `orphans.resolve` finds at once,
whatever the order in which events came.

A batch counts once its commit is written, last of all: it names the deltas, which the batch wrote or
found where they are already stored. A batch that is repeated writes its deltas anew.
A state whose commits have a gap is an error, never an empty state.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorespark.operators import orphans
from lorespark.session import materialise, scratch

TABLES = {
    "refs": "rec_no bigint, dumped_at timestamp_ntz, ref_title string",
    "parents": "ref_title string, first_listed timestamp_ntz",
    "log": "ref_title string, logged_at timestamp_ntz, log_id bigint, deleted boolean",
    "changes": "rec_no bigint, dumped_at timestamp_ntz, ref_title string, status string, version int",
}
#: Kinds of rows in a stream of events; all columns but those of the kind are null.
EVENTS = "kind string, rec_no bigint, dumped_at timestamp_ntz, ref_title string, first_listed timestamp_ntz, logged_at timestamp_ntz, log_id bigint, deleted boolean"


class MissingVersion(RuntimeError):
    """The state of a batch was asked for that is not there."""


class PendingOrphans:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._known = spark, folder.rstrip("/"), {}

    def _path(self, name: str, version: int, base: bool = False) -> str:
        return f"{self.folder}/{name}/{'base' if base else 'v'}{version:08d}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _commits(self, version: int) -> list[str]:
        """The folders whose deltas make up the state after a batch: a base, if any, and what came later."""
        known = [n for n in self._names(f"{self.folder}/commits") if int(n.lstrip("basev")) <= version]
        bases = [n for n in known if n.startswith("base")]
        first = int(bases[-1][4:]) if bases else 0
        later = [n for n in known if n.startswith("v") and int(n[1:]) > first]
        if [int(n[1:]) for n in later] != list(range(first + 1, version + 1)):
            raise MissingVersion(f"state of batch {version} is not complete in {self.folder}: it has {', '.join(bases[-1:] + later) or 'nothing'}")
        return bases[-1:] + later

    def _commit(self, name: str, paths: dict[str, str]) -> None:
        fs, p = self._fs(f"{self.folder}/commits/{name}")
        out = fs.create(p, True)
        out.write(bytearray(json.dumps(paths).encode()))
        out.close()

    def _deltas(self, name: str, version: int) -> list[str]:
        """Where the rows of a table of the state after a batch lie."""
        if version not in self._known:  # commits are small: one line a batch
            paths = []
            for commit in self._commits(version):
                fs, p = self._fs(f"{self.folder}/commits/{commit}")
                stream = fs.open(p)
                paths.append(json.loads(bytes(stream.readAllBytes())))
                stream.close()
            self._known = {version: paths}
        return [c[name] for c in self._known[version] if name in c]

    def read(self, name: str, version: int) -> DataFrame:
        """All rows of a table of the state after a batch; version 0 is empty."""
        there = self._deltas(name, version)
        if not there:
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(*there)

    def orphans(self, version: int, titles: DataFrame | None = None) -> DataFrame:
        """(rec_no, dumped_at, ref_title, status) that wait after a batch, of all titles or of some."""
        changes = self.read("changes", version)
        if titles is not None:
            changes = changes.join(titles, "ref_title", "left_semi")
        last = changes.groupBy("rec_no", "dumped_at", "ref_title").agg(F.max_by("status", "version").alias("status"))
        return last.where("status IS NOT NULL")

    def apply(self, version: int, refs: DataFrame | str | None = None, parents: DataFrame | str | None = None, log: DataFrame | str | None = None, hot: DataFrame | None = None) -> None:
        """Applies batch `version` (1, 2, ..) to the state of the one before.

        Tables come as rows, or as paths where they are stored to stay. `hot` is for `evaluate`.
        """
        self._commits(version - 1)
        paths: dict[str, str] = {}
        for name, given in {"refs": refs, "parents": parents, "log": log}.items():
            if isinstance(given, str):
                paths[name] = given
            elif given is not None:
                given.select(*[c.split()[0] for c in TABLES[name].split(", ")]).write.mode("overwrite").parquet(self._path(name, version))
                paths[name] = self._path(name, version)
        new = {n: self.spark.read.schema(TABLES[n]).parquet(path) for n, path in paths.items()}
        todo = [new["refs"].withColumn("again", F.lit(False))] if "refs" in new else []
        if "parents" in new and self._deltas("changes", version - 1):
            todo.append(self.orphans(version - 1, new["parents"].select("ref_title")).drop("status").withColumn("again", F.lit(True)))
        if "log" in new and self._deltas("refs", version - 1):
            todo.append(self.read("refs", version - 1).join(new["log"].select("ref_title"), "ref_title", "left_semi").withColumn("again", F.lit(True)))
        if todo:
            every = todo[0]
            for t in todo[1:]:
                every = every.unionByName(t)
            if hot is None:
                every = materialise(every)  # counted first
            known = [self.read(n, version - 1).unionByName(new[n]) if n in new else self.read(n, version - 1) for n in ("parents", "log")]
            changed = orphans.evaluate(every, *known, hot=hot).where("status IS NOT NULL OR again").withColumn("version", F.lit(version))
            paths["changes"] = self._path("changes", version)
            changed.select(*[c.split()[0] for c in TABLES["changes"].split(", ")]).write.mode("overwrite").parquet(paths["changes"])
        self._known = {}
        self._commit(f"v{version:08d}", paths)

    def compact(self, version: int) -> None:
        """Replaces the deltas up to a batch by one table each and removes them."""
        parts = self._commits(version)
        whole = {"refs": self.read("refs", version).distinct(), "parents": self.read("parents", version).groupBy("ref_title").agg(F.min("first_listed").alias("first_listed"))}
        whole |= {"log": self.read("log", version).distinct(), "changes": self.orphans(version).withColumn("version", F.lit(version))}
        for name, df in whole.items():
            df.write.mode("overwrite").parquet(self._path(name, version, base=True))
        self._commit(f"base{version:08d}", {name: self._path(name, version, base=True) for name in TABLES})
        self._known = {}
        for part in parts:
            for name in ("commits", *TABLES):
                fs, p = self._fs(f"{self.folder}/{name}/{part}")
                fs.delete(p, True)

    def snapshot(self, version: int) -> DataFrame:
        """Counts per target table, month and status after a batch."""
        return orphans.snapshot(self.orphans(version))

    def apply_events(self, version: int, events: DataFrame) -> None:
        """Applies a batch of rows in the form EVENTS, which may hold any of the three kinds."""
        of = {k: events.where(F.col("kind") == k) for k in ("ref", "parent", "log")}
        self.apply(version, of["ref"], of["parent"], of["log"])

    def run(self, events: DataFrame, **options: str):
        """A streaming query over rows in the form EVENTS: references, listings and log entries in any order."""
        writer = events.writeStream.foreachBatch(lambda batch, batch_id: self.apply_events(batch_id + 1, batch)).option("checkpointLocation", f"{self.folder}/checkpoint")
        for k, v in options.items():
            writer = writer.option(k, v)
        return writer.trigger(availableNow=True).start()


def as_events(refs: DataFrame, parents: DataFrame, log: DataFrame) -> DataFrame:
    """Three tables as rows in the form EVENTS."""
    out = None
    for kind, df in (("ref", refs), ("parent", parents), ("log", log)):
        columns = [(F.lit(kind) if name == "kind" else F.col(name) if name in df.columns else F.lit(None)).cast(type_).alias(name) for name, type_ in (c.split() for c in EVENTS.split(", "))]
        out = df.select(*columns) if out is None else out.unionByName(df.select(*columns))
    return out


def by_period(refs: DataFrame, parents: DataFrame, log: DataFrame, period: str = "yyyy-MM") -> tuple[PendingOrphans, int]:
    """The state after a batch for every period of a history, and its version.

    Events are stored by period first, where they stay as the deltas of their batch; those without
    a time come with the last one.
    """
    spark = refs.sparkSession
    time = F.coalesce("dumped_at", "first_listed", "logged_at")
    events = as_events(refs, parents, log).withColumn("period", F.coalesce(F.date_format(time, period), F.lit("~")))
    path = scratch(spark, "events")
    events.write.partitionBy("period", "kind").parquet(path)
    stored = spark.read.schema(f"{EVENTS}, period string").parquet(path)
    state = PendingOrphans(spark, scratch(spark, "orphans"))
    fs, p = state._fs(path)
    there = [(s.getPath().getName().removeprefix("period="), {k.getPath().getName().removeprefix("kind=") for k in fs.listStatus(s.getPath())}) for s in fs.listStatus(p) if s.isDirectory()]
    hot, version = materialise(orphans.hot_titles(stored.where("kind = 'ref'"))), 0
    for version, (name, kinds) in enumerate(sorted(there), 1):
        state.apply(version, *(f"{path}/period={name}/kind={k}" if k in kinds else None for k in ("ref", "parent", "log")), hot=hot)
    return state, version
