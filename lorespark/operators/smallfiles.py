"""Consolidation of very many small files (problem 5).

Two halves:

* `plan_bundles` works on catalogue rows: one row per distinct file, sorted by path inside key
  ranges, rolled into bundles by bytes.
* `merge_runs` works on data: many small sorted files become few well-sized sorted files. Runs are
  cut at the edges of key ranges, each range is merged k ways by one task, and outputs roll by
  bytes; duplicates stay; the range of every output goes into a table beside the files.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lorespark.session import cut_lineage, materialise, ship

#: Files below this size count as small.
SMALL_BYTES = 1024
#: Bytes of a bundle; a parquet file of the usual block size holds thousands of tiny texts.
BUNDLE_BYTES = 128 * 1024 * 1024
#: Bundles that one key range is rolled into; it bounds the rows of a range.
BUNDLES_PER_RANGE = 16


def normal_path(path: Column) -> Column:
    r"""Trimmed, `\` as `/`, without empty and `.` segments; null stays null."""
    flat = F.regexp_replace(F.regexp_replace(path, r"(?U)^\s+|\s+$", ""), r"\\", "/")
    return F.array_join(F.filter(F.split(flat, "/"), lambda s: (s != "") & (s != ".")), "/")


def distinct_files(entries: DataFrame, name_col: str, listing: str) -> DataFrame:
    """(listing, file_path, file_bytes): each distinct file once.

    Entries whose name or path is null or empty are none. The bytes of a file are the last
    non-null ones by `ord`; files without any have null. Of equal `ord` the larger bytes count.
    """
    e = entries.select(
        F.col(name_col).alias("name"), normal_path(F.col("path")).alias("file_path"), F.col("bytes").cast("bigint").alias("b"), F.col("ord").alias("o")
    ).where((F.col("name") != "") & (F.col("file_path") != ""))
    last = F.max(F.when(F.col("b").isNotNull(), F.struct(F.coalesce("o", F.lit(-1)).alias("o"), "b")))
    return e.groupBy("file_path").agg(last.alias("last")).select(F.lit(listing).alias("listing"), "file_path", F.col("last.b").alias("file_bytes"))


def small_files(files: DataFrame, small_bytes: int = SMALL_BYTES) -> DataFrame:
    """The files to consolidate; files of unknown size are left out."""
    return files.where(F.col("file_bytes") < small_bytes)


def plan_bundles(files: DataFrame, bundle_bytes: int = BUNDLE_BYTES, bundles_per_range: int = BUNDLES_PER_RANGE) -> DataFrame:
    """(listing, file_path, file_bytes, bundle): every input row in exactly one bundle.

    Rows are range-partitioned by (listing, file_path) into as many ranges as the total bytes
    ask for; within a range a running sum of bytes closes a bundle when the next file begins
    beyond it. So a bundle exceeds `bundle_bytes` by less than one file, its files are
    neighbours in path order, and no step needs all rows in one task. An empty table gives an
    empty plan; negative sizes count as 0.
    """
    files = materialise(files)  # summed, sampled for the ranges, and divided
    size = F.greatest(F.coalesce("file_bytes", F.lit(0)), F.lit(0))
    total = files.agg(F.coalesce(F.sum(size), F.lit(0)).alias("t")).first()["t"]
    ranges = max(1, math.ceil(total / (bundle_bytes * bundles_per_range)))
    ranged = files.repartitionByRange(ranges, "listing", "file_path").withColumn("key_range", F.spark_partition_id())
    ranged = cut_lineage(ranged)  # range numbers must not change when a task is run again
    w = Window.partitionBy("listing", "key_range").orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(size).over(w), F.lit(0))
    no = F.floor(before / F.lit(bundle_bytes)).cast("bigint")
    name = F.format_string("%s-%05d-%05d", F.col("listing"), F.col("key_range"), no)
    return ranged.withColumn("bundle", name).select("listing", "file_path", "file_bytes", "bundle")


def bundle_ranges(plan: DataFrame) -> DataFrame:
    """Range metadata of a plan: first and last path, files and bytes of each bundle."""
    return plan.groupBy("listing", "bundle").agg(
        F.min("file_path").alias("first_path"), F.max("file_path").alias("last_path"), F.count("*").alias("files"), F.sum("file_bytes").alias("total_bytes")
    )


def _row_key(table: pa.Table, at: int, keys: list[str]) -> tuple:
    """The key of a row in a form that Python can order, nulls first."""
    values = [table.column(k)[at].as_py() for k in keys]
    return tuple((v is not None, v if v is not None else 0) for v in values)


def _first_not_below(table: pa.Table, keys: list[str], edge: tuple, also_equal: bool) -> int:
    """The place of the first row of a sorted table that is not below `edge` (or, with `also_equal`, is above it)."""
    low, high = 0, table.num_rows
    while low < high:
        mid = (low + high) // 2
        here = _row_key(table, mid, keys)
        if here < edge or also_equal and here == edge:
            low = mid + 1
        else:
            high = mid
    return low


def _sorted(table: pa.Table, keys: list[str]) -> pa.Table:
    return table.take(pc.sort_indices(table, sort_keys=[(k, "ascending") for k in keys], null_placement="at_start"))


def _run(content: bytes, columns: list[str] | None = None) -> pa.Table:
    return pq.read_table(pa.BufferReader(content), columns=columns)


def _samples(keys: list[str], per_run: int):
    """Keys at even distances in each run, with the bytes that each stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = content.as_py()
                table = _run(raw, keys)
                if table.num_rows:
                    at = np.unique(np.linspace(0, table.num_rows - 1, min(per_run, table.num_rows)).astype(int))
                    picked = table.select(keys).take(pa.array(at)).combine_chunks()
                    yield pa.record_batch([*(c.chunk(0) for c in picked.columns), pa.array([path] * len(at)), pa.array([len(raw) / len(at)] * len(at))], names=[*(f"k{i}" for i in range(len(keys))), "run", "weight"])

    return run


def _cut_runs(keys: list[str], edges: list[tuple]):
    """Slices of the runs, whole in one key range each, as Arrow data with their least keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                table = _run(content.as_py())
                if not table.num_rows:
                    continue
                if not table.select(keys).equals(_sorted(table.select(keys), keys)):
                    raise ValueError(f"{path} is not sorted by {', '.join(keys)}")
                at = 0
                while at < table.num_rows:
                    no = bisect_right(edges, (_row_key(table, at, keys), path))
                    # rows of the edge's own key belong below it, if the run's path does
                    end = table.num_rows if no == len(edges) else _first_not_below(table, keys, edges[no][0], path < edges[no][1])
                    part = table.slice(at, max(end, at + 1) - at)
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, part.schema) as out:
                        out.write_table(part)
                    least = [pa.array([part.column(k)[0].as_py()], part.schema.field(k).type) for k in keys]
                    yield pa.record_batch([pa.array([no], pa.int32()), *least, pa.array([path]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["range_no", *(f"k{i}" for i in range(len(keys))), "run", "data"])
                    at += part.num_rows

    return run


def _row_bytes(table: pa.Table) -> np.ndarray:
    """Bytes of each row: lengths of texts, widths of numbers, and the mean of what is nested."""
    size = np.zeros(table.num_rows, np.float64)
    for column in table.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type):
            size += pc.fill_null(pc.binary_length(column), 0).to_numpy()
        else:
            size += column.nbytes / max(1, table.num_rows)
    return size


def _merge(keys: list[str], file_bytes: int, held_bytes: int):
    """Merges the slices of each range, which come by their least keys.

    Slices are opened as their turn comes. Once enough is held, everything below the least key of
    the next slice is final and goes out; the rest waits for what may still lie before it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no, held, size, written = None, [], 0, 0.0

        def flush(edge: tuple | None) -> Iterator[pa.RecordBatch]:
            nonlocal held, size, written
            if not held:
                return
            whole = _sorted(pa.concat_tables(held), keys)
            end = whole.num_rows if edge is None else _first_not_below(whole, keys, edge, False)
            done, held = whole.slice(0, end), [whole.slice(end)] if end < whole.num_rows else []
            size = sum(t.nbytes for t in held)
            if end:
                bytes_ = _row_bytes(done)
                file = ((written + np.cumsum(bytes_) - bytes_) // file_bytes).astype(np.int64)
                written += float(bytes_.sum())
                name = pa.array([f"{no:06d}-{f:05d}" for f in file])
                for b in done.append_column("out_file", name).append_column("row_bytes", pa.array(bytes_.astype(np.int64))).combine_chunks().to_batches(max_chunksize=20_000):
                    yield b

        for batch in batches:
            for i, (here, data) in enumerate(zip(batch.column(0).to_pylist(), batch.column(batch.num_columns - 1))):
                if here != no:
                    yield from flush(None)
                    no, written = here, 0.0
                elif size > held_bytes:
                    values = [batch.column(1 + k)[i].as_py() for k in range(len(keys))]
                    yield from flush(tuple((v is not None, v if v is not None else 0) for v in values))
                held.append(pa.ipc.open_stream(pa.BufferReader(data.as_buffer())).read_all())
                size += held[-1].nbytes
        yield from flush(None)

    return run


def merge_runs(spark: SparkSession, runs: str, keys: list[str], out_dir: str, file_bytes: int = BUNDLE_BYTES, range_bytes: int | None = None, per_run: int = 16, held_bytes: int = 64 << 20) -> DataFrame:
    """Merges the parquet files below `runs`, each small and sorted by `keys`, into few; returns their metadata.

    Rows are kept as they are, duplicates too; nulls come first. Key ranges are drawn from keys of
    all runs so that each holds about `range_bytes`; equal keys are divided between ranges by run,
    so that one frequent key fills no task. An output is closed when the next row begins beyond
    `file_bytes`. The result, one row per output with its rows, bytes, least and greatest key, is
    also written to `_ranges` beside the files. Runs without rows give nothing.
    """
    ship(spark)
    schema = spark.read.parquet(runs).schema
    kinds = ", ".join(f"k{i} {schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
    order = [f"k{i}" for i in range(len(keys))]
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(runs).select("path", "content")
    total = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(runs).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    ranges = max(1, math.ceil(total / (range_bytes or 2 * file_bytes)))
    edges: list[tuple] = []
    if ranges > 1:
        sampled = content.mapInArrow(_samples(keys, per_run), f"{kinds}, run string, weight double").repartitionByRange(*order, "run")
        placed = cut_lineage(sampled.withColumn("part", F.spark_partition_id()))
        parts = placed.groupBy("part").agg(F.sum("weight").alias("w")).orderBy("part").collect()  # one row a task
        before = np.concatenate([[0.0], np.cumsum([r["w"] for r in parts])[:-1]])
        begins = spark.createDataFrame([(r["part"], float(b)) for r, b in zip(parts, before)], "part int, begin double")
        running = F.sum("weight").over(Window.partitionBy("part").orderBy(*(F.col(c).asc_nulls_first() for c in order), "run").rowsBetween(Window.unboundedPreceding, 0))
        upto = F.col("begin") + F.col("s")
        step = float(sum(r["w"] for r in parts)) / ranges
        crossed = placed.withColumn("s", running).join(F.broadcast(begins), "part").where(F.floor(upto / step) > F.floor((upto - F.col("weight")) / step))
        edges = sorted({(tuple((v is not None, v if v is not None else 0) for v in r[:-1]), r["run"]) for r in crossed.select(*order, "run").collect()})  # one a range
    cut = content.mapInArrow(_cut_runs(keys, edges), f"range_no int, {kinds}, run string, data binary")
    gathered = cut.repartition(len(edges) + 1, "range_no").sortWithinPartitions("range_no", *(F.col(c).asc_nulls_first() for c in order), "run")
    merged = gathered.mapInArrow(_merge(keys, file_bytes, held_bytes), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", out_file string, row_bytes bigint")
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    was = spark.conf.get(setting)
    spark.conf.set(setting, "64")  # writers stay open side by side: nothing is sorted again
    try:
        merged.write.mode("errorifexists").partitionBy("out_file").parquet(out_dir)
    finally:
        spark.conf.set(setting, was)
    key = F.struct(*keys)
    written = spark.read.parquet(out_dir).groupBy("out_file").agg(F.count("*").alias("rows"), F.sum("row_bytes").alias("bytes"), F.min(key).alias("least"), F.max(key).alias("greatest"))
    written.write.parquet(f"{out_dir}/_ranges")
    return spark.read.parquet(f"{out_dir}/_ranges")
