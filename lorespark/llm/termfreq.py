"""Frequency of every distinct term over a whole collection (problem 6).

Last-seen counters: a task reads its records one after another and keeps, of each term, the
occurrences, the records and the last record that held it, so no set per record is needed. The
counters of a task are its pre-aggregate; only they are shuffled, hash-partitioned by term, and
added up. A record lies in one task and a full table is handed on between two records only, so
sums of partial counters are exact.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorespark.session import ship

#: Terms are runs of letters of any script.
LETTERS = regex.compile(r"\p{L}+")
#: Soft hyphen and zero-width space are no part of a term.
DROPPED = {0xAD: None, 0x200B: None}
#: Counters that a task holds before it hands them on.
TABLE_LIMIT = 400_000
RARE_BELOW_RECORDS = 3
COMMON_SHARE = 0.2

_OUT = pa.schema([("term", pa.string()), ("n", pa.int64()), ("r", pa.int64())])


def terms_of(text: str) -> list[str]:
    """Terms in order: NFKC, lower case, without soft hyphens and zero-width spaces."""
    if text.isascii():
        return LETTERS.findall(text.lower())
    return LETTERS.findall(unicodedata.normalize("NFKC", text).lower().translate(DROPPED))


def _counters(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[str, list[int]] = {}
        record = 0

        def flush() -> pa.RecordBatch:
            rows = table.values()
            out = pa.record_batch([pa.array(table.keys(), pa.string()), pa.array([e[0] for e in rows], pa.int64()), pa.array([e[1] for e in rows], pa.int64())], schema=_OUT)
            table.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text is None:
                    continue
                record += 1
                for term in terms_of(text):
                    seen = table.get(term)
                    if seen is None:
                        table[term] = [1, 1, record]
                    else:
                        seen[0] += 1
                        if seen[2] != record:
                            seen[1] += 1
                            seen[2] = record
                if len(table) >= limit:
                    yield flush()
        if table:
            yield flush()

    return run


def term_counts(df: DataFrame, text_col: str, table_limit: int = TABLE_LIMIT) -> DataFrame:
    """(term, occurrences, records) of all rows of `df`; each row is a record of its own.

    Null and empty texts hold no term. Repeated rows count as often as they occur.
    """
    ship(df.sparkSession)
    partial = df.select(F.col(text_col)).mapInArrow(_counters(table_limit), "term string, n bigint, r bigint")
    return partial.groupBy("term").agg(F.sum("n").alias("occurrences"), F.sum("r").alias("records"))


def mark_terms(counts: DataFrame, total_records: int, rare_below: int = RARE_BELOW_RECORDS, common_share: float = COMMON_SHARE) -> DataFrame:
    """Adds `mark`: `rare`, `common` or `useful`. Where both hold (tiny collections) it is `rare`."""
    mark = F.when(F.col("records") < rare_below, "rare").when(F.col("records") >= F.lit(common_share) * F.lit(total_records), "common").otherwise("useful")
    return counts.withColumn("mark", mark)


def marked_terms(df: DataFrame, text_col: str, **marks) -> DataFrame:
    """Counts and marks over all rows, those with null texts included in the total."""
    return mark_terms(term_counts(df, text_col), df.count(), **marks)
