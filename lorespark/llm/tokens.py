"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorespark.session import ship

#: Vocabulary file with one base64 token and its rank a line.
DEFAULT_VOCABULARY = os.environ.get("LORESPARK_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
# Fixed value: the public pattern that cuts text before byte pairs are merged.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


_sent: set[tuple[str, str]] = set()


def send(spark: SparkSession, path: str) -> str:
    """Has Spark copy the vocabulary file to every worker, once per application; returns its name there."""
    if (spark.sparkContext.applicationId, path) not in _sent:
        spark.sparkContext.addFile(path)
        _sent.add((spark.sparkContext.applicationId, path))
    return os.path.basename(path)


def _count(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(SparkFiles.get(name))
        for batch in batches:
            n = [None if t is None else len(enc.encode_ordinary(t)) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.record_batch([*batch.columns[:-1], pa.array(n, pa.int64())], names=[*batch.schema.names[:-1], "n_tokens"])

    return run


def token_sizes(df: DataFrame, keep: list[str], text_col: str, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """The columns `keep` and `n_tokens` of each row; null for a null text, 0 for an empty one.

    `vocabulary` is a path on the driver (or of a file system that Spark knows); workers get a copy.
    """
    ship(df.sparkSession)
    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "n_tokens bigint"])
    return df.select(*keep, F.col(text_col).alias("__text")).mapInArrow(_count(send(df.sparkSession, vocabulary)), schema)
