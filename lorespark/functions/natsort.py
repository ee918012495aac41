"""Natural order as a sortable column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def natkey(c: Column) -> Column:
    """Array of (band, number, text) per run: digit runs compare as numbers and come before other runs.

    A total order; null and '' come first. Leading zeros are ignored, so `01` equals `1` and the
    following runs decide.
    """
    runs = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"([0-9]+|[^0-9]+)"), 1)

    def part(run: Column) -> Column:
        number = F.regexp_extract(run, "^[0-9]+$", 0) != ""
        return F.struct(
            F.when(number, 0).otherwise(1).alias("band"),
            F.when(number, run.try_cast("decimal(38,0)")).alias("num"),
            F.when(number, F.when(run.try_cast("decimal(38,0)").isNull(), F.regexp_replace(run, "^0+", "")).otherwise("")).otherwise(run).alias("txt"),
        )

    return F.transform(runs, part)
