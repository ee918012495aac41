"""Writers: page files with catalogue and summary, zip parts, subsets."""

from __future__ import annotations

import itertools
import zipfile
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorespark.operators.titlesearch import assign_paths
from lorespark.session import materialise, ship
from lorespark.sources.storage import Folder, shared_uri


def _write_files(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = Folder(uri, TaskContext.get().taskAttemptId())
        for batch in batches:
            sizes = []
            for path, body in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = (body or "").encode()
                folder.put(path, lambda out, data=data: out.write(data))
                sizes.append(len(data))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], names=["title", "path", "bytes"])

    return run


def export_pages(pages: DataFrame, out_dir: str, site: str) -> DataFrame:
    """Writes pages (title, ns, pageid, ord, content) as files below `out_dir`/pages, a URI that every
    executor reaches, with manifest.jsonl and summary.json folders beside them; returns the catalogue."""
    ship(pages.sparkSession)
    placed = assign_paths(pages)
    written = materialise(placed.select("title", "path", "content").mapInArrow(_write_files(shared_uri(pages.sparkSession, f"{out_dir.rstrip('/')}/pages")), "title string, path string, bytes bigint"))
    listed = placed.drop("content").join(written, ["title", "path"])
    listed.select("title", "ns", "pageid", "path", "bytes").write.mode("overwrite").json(f"{out_dir.rstrip('/')}/manifest.jsonl")
    listed.agg(F.lit(site).alias("site"), F.count("*").alias("total_pages"), F.sum("bytes").alias("total_bytes")).coalesce(1).write.mode("overwrite").json(f"{out_dir.rstrip('/')}/summary.json")
    return listed


def _write_zip(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        folder, n = Folder(uri, ctx.taskAttemptId()), 0

        def write(out: BinaryIO) -> None:
            nonlocal n
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:  # entries go out one by one
                for batch in itertools.chain([first], batches):
                    for path, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                        z.writestr(path, body or "")
                        n += 1

        first = next((b for b in batches if b.num_rows), None)
        if first is not None:
            name = folder.put(f"part-{ctx.partitionId():05d}.zip", write)
            yield pa.record_batch([pa.array([name]), pa.array([n], pa.int64())], names=["archive", "entries"])

    return run


def pack_pages(pages: DataFrame, out_dir: str, archives: int = 1) -> DataFrame:
    """Writes pages (path, content) into `archives` zip files below a URI; (archive, entries)."""
    ship(pages.sparkSession)
    spread = pages.select("path", "content").repartitionByRange(archives, "path").sortWithinPartitions("path")
    return materialise(spread.mapInArrow(_write_zip(shared_uri(pages.sparkSession, out_dir)), "archive string, entries bigint"))


def extract_archive(entries: DataFrame, out_dir: str) -> DataFrame:
    """Writes zip entries (name, content) below a folder; names that leave it are refused."""
    ship(entries.sparkSession)
    uri = shared_uri(entries.sparkSession, out_dir)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = Folder(uri, TaskContext.get().taskAttemptId())
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                folder.put(name, lambda out, data=content.as_buffer(): out.write(data))
            yield pa.record_batch([batch.column(0)], names=["name"])

    return materialise(entries.select("name", "content").mapInArrow(run, "name string"))
