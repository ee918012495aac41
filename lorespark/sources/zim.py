"""ZIM archives as tables. The layout of the format is public; stored, LZMA and zstd clusters are read.

Nothing passes through the driver but the header: directory entries and clusters are read by
ranges in the tasks, from a URI that all executors reach, and joined by (cluster, blob).
"""

from __future__ import annotations

import lzma
import os
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorespark.session import ship
from lorespark.sources.storage import open_input, shared_uri

# Fixed values of the format.
MAGIC = 72173914
HEADER = struct.Struct("<IHH16sIIQQQQIIQ")
REDIRECT, LINK_TARGET, DELETED = 0xFFFF, 0xFFFE, 0xFFFD


def header(path: str) -> dict:
    path = path if "://" in path else f"file://{os.path.abspath(path)}"
    with open_input(path) as f:
        v = HEADER.unpack(f.read(HEADER.size))
        if v[0] != MAGIC:
            raise ValueError(f"{path} is no ZIM archive")
        out = {"entries": v[4], "clusters": v[5], "url_at": v[6], "cluster_at": v[8], "mime_at": v[9], "end": v[12]}
        f.seek(out["mime_at"])
        raw = f.read(1 << 16)
        out["mimes"] = [m.decode() for m in raw.split(b"\0\0", 1)[0].split(b"\0")]
        return out


def _string(f) -> str:
    out = b""
    while b"\0" not in out:
        more = f.read(256)
        if not more:
            break
        out += more
    return out.split(b"\0", 1)[0].decode("utf-8", "replace")


def _entry(f, at: int, mimes: list[str]) -> tuple:
    f.seek(at)
    mime, _, ns, _ = struct.unpack("<HBcI", f.read(8))
    if mime in (REDIRECT, LINK_TARGET, DELETED):
        target = struct.unpack("<I", f.read(4))[0] if mime == REDIRECT else None
        return ns.decode(), _string(f), None, None, None, target
    cluster, blob = struct.unpack("<II", f.read(8))
    return ns.decode(), _string(f), mimes[mime], cluster, blob, None


def entries(spark: SparkSession, path: str, partitions: int = 64) -> DataFrame:
    """(entry, ns, url, mime, cluster, blob, redirect): the directory of an archive."""
    ship(spark)
    path = shared_uri(spark, path)
    h = header(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open_input(path) as f:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                places = []
                for i in ids:
                    f.seek(h["url_at"] + 8 * i)
                    places.append(struct.unpack("<Q", f.read(8))[0])
                cols = list(zip(*(_entry(f, at, h["mimes"]) for at in places))) or [()] * 6
                kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.record_batch([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["entry", "ns", "url", "mime", "cluster", "blob", "redirect"])

    ids = spark.range(0, h["entries"], 1, max(1, min(partitions, h["entries"])))
    return ids.mapInArrow(run, "entry bigint, ns string, url string, mime string, cluster bigint, blob bigint, redirect bigint")


def blobs(spark: SparkSession, path: str, partitions: int = 64) -> DataFrame:
    """(cluster, blob, content) of every blob, a cluster at a time."""
    ship(spark)
    path = shared_uri(spark, path)
    h = header(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        with open_input(path) as f:
            for batch in batches:
                for c in batch.column(0).to_pylist():
                    f.seek(h["cluster_at"] + 8 * c)
                    ends = f.read(16)
                    start = struct.unpack("<Q", ends[:8])[0]
                    end = struct.unpack("<Q", ends[8:16])[0] if c + 1 < h["clusters"] else h["end"]
                    f.seek(start)
                    raw = f.read(end - start)
                    kind, wide = raw[0] & 15, bool(raw[0] & 16)
                    if kind not in (0, 1, 4, 5):
                        raise ValueError(f"cluster {c} has compression {kind}, which is not read")
                    data = zstandard.ZstdDecompressor().decompressobj().decompress(raw[1:]) if kind == 5 else lzma.decompress(raw[1:]) if kind == 4 else raw[1:]
                    size, code = (8, "Q") if wide else (4, "I")
                    n = struct.unpack(f"<{code}", data[:size])[0] // size
                    at = struct.unpack(f"<{n}{code}", data[: n * size])
                    for i in range(n - 1):
                        yield pa.record_batch([pa.array([c], pa.int64()), pa.array([i], pa.int64()), pa.array([data[at[i] : at[i + 1]]], pa.binary())], names=["cluster", "blob", "content"])

    return spark.range(0, h["clusters"], 1, max(1, min(partitions, h["clusters"]))).mapInArrow(run, "cluster bigint, blob bigint, content binary")


def files(spark: SparkSession, path: str, mime_prefix: str = "") -> DataFrame:
    """(ns, url, mime, content) of the entries whose type begins so; redirects are left out."""
    wanted = entries(spark, path).where(F.col("mime").startswith(mime_prefix))
    return wanted.join(blobs(spark, path), ["cluster", "blob"]).select("ns", "url", "mime", "content")
