"""Mixing sources to target weights (problem 8).

Low-discrepancy source schedule: slot i of a mix looks up the point frac(i * golden ratio) in the
cumulative weights of its sources; the k-th slot of a source takes the k-th block of its shuffled
records, and begins anew, in another order, after the last one as often as the cap allows. Blocks
hold equal numbers of tokens (a record that crosses the edge of a block is divided there), so
shares of slots are shares of tokens but for the last block of a source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorespark.session import materialise

BLOCK_TOKENS = 512
#: Rows of a chunk, within which ranks and running sums are taken; chunks are then offset.
CHUNK_ROWS = 100_000
# Fixed value: 2^32 divided by the golden ratio, odd.
GOLDEN = 2654435769


def normal_source(c: Column) -> Column:
    """Lower case, trimmed, `-` as `_`; null stays null."""
    return F.regexp_replace(F.lower(F.trim(c)), "-", "_")


def _offsets(df: DataFrame, keys: list[str], size: Column) -> DataFrame:
    """`size` summed over the chunks before each chunk of `keys`."""
    w = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return df.groupBy(*keys, "chunk").agg(F.sum(size).alias("s")).select(*keys, "chunk", F.coalesce(F.sum("s").over(w), F.lit(0)).alias("offset"))


def blocks(sizes: DataFrame, block_tokens: int, epochs: Column, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(source, epoch, block, item, token_start, n_tokens): records of a source in shuffled order, cut into blocks of equal tokens.

    Every epoch below `epochs`, a column of the row's source, has an order of its own, that of ids
    hashed with its number. Running sums are taken inside chunks of the hash range, so that a
    source of any size is spread. A record that crosses edges gives a row for each block it lies in.
    """
    chunks = max(1, math.ceil(sizes.count() / chunk_rows))
    each = sizes.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.greatest(epochs, F.lit(1)).cast("int") - 1)))
    h = F.xxhash64(F.col("item"), F.col("epoch") + 11)
    rows = each.withColumn("h", h).withColumn("chunk", F.floor((F.shiftrightunsigned("h", 33) * chunks) / F.lit(2.0**31)).cast("int"))
    offset = _offsets(rows, ["source", "epoch"], F.col("n_tokens"))
    w = Window.partitionBy("source", "epoch", "chunk").orderBy("h", "item", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_tokens").over(w), F.lit(0))
    inside = rows.withColumn("before", before).join(offset, ["source", "epoch", "chunk"]).withColumn("begin", F.col("before") + F.col("offset"))
    end = F.col("begin") + F.col("n_tokens")
    whole = F.lit(block_tokens)
    parts = inside.withColumn("block", F.explode(F.sequence(F.floor(F.col("begin") / whole), F.floor((end - 1) / whole))))
    left, right = F.greatest(F.col("begin"), F.col("block") * whole), F.least(end, (F.col("block") + 1) * whole)
    return parts.select("source", F.col("epoch").cast("bigint").alias("epoch"), F.col("block").cast("bigint").alias("block"), "item", (left - F.col("begin")).alias("token_start"), (right - left).alias("n_tokens"))


class Mixture:
    """The schedule of several mixes over one table of (item, source, n_tokens).

    `targets` has rows (mix, source, target_share, max_repeats) and is small and fixed; shares are
    scaled to 1 over the sources that have records. Records without a source or tokens take no
    part. The length of a mix is the greatest at which no source exceeds its repeats.
    """

    def __init__(self, sizes: DataFrame, targets: DataFrame, block_tokens: int = BLOCK_TOKENS, chunk_rows: int = CHUNK_ROWS):
        self.spark, self.chunk_rows = sizes.sparkSession, chunk_rows
        wanted = targets.select("mix", normal_source(F.col("source")).alias("source"), "target_share", "max_repeats").collect()
        self.targets = [(r["mix"], r["source"], float(r["target_share"] or 0), int(r["max_repeats"] or 0)) for r in wanted if r["mix"] and r["source"]]
        names = sorted({s for _, s, _, _ in self.targets})
        clean = sizes.select("item", normal_source(F.col("source")).alias("source"), "n_tokens").where(F.col("source").isin(names) & (F.col("n_tokens") > 0))
        clean = materialise(clean)
        stock = clean.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()  # one row per source of the targets
        self.stock = {r["source"]: -(-r["t"] // block_tokens) for r in stock}
        self.plans = {m: p for m in sorted({m for m, *_ in self.targets}) if (p := self._plan(m))}
        epochs = F.lit(1)
        for s in self.stock:  # one more than the weights ask for: slots of a source may run ahead of its share
            asked = [min(r, int(p["slots"] * w // self.stock[s]) + 2) for p in self.plans.values() for x, w, r in zip(p["sources"], p["weights"], p["repeats"]) if x == s]
            epochs = F.when(F.col("source") == s, F.lit(max(asked, default=1))).otherwise(epochs)
        self.blocks = materialise(blocks(clean, block_tokens, epochs, chunk_rows))

    def _plan(self, mix: str) -> dict | None:
        """Weights, limits and the number of slots of a mix; None if none of its sources has records."""
        rows = sorted((s, w, r) for m, s, w, r in self.targets if m == mix and s in self.stock and w > 0 and r > 0)
        total = sum(w for _, w, _ in rows)
        if not total:
            return None
        n = math.floor(min(self.stock[s] * r / (w / total) for s, w, r in rows) + 1e-9)
        return {"sources": [s for s, _, _ in rows], "weights": [w / total for _, w, _ in rows], "limits": [self.stock[s] * r for s, _, r in rows], "repeats": [r for _, _, r in rows], "slots": n}

    def slots(self) -> DataFrame:
        """(mix, slot, source, epoch, block) of every slot, ranks per source taken chunk by chunk."""
        parts = []
        for mix, p in self.plans.items():
            high, low = F.shiftright("id", 16) % 65536, F.col("id") % 65536  # the product of whole ids would overflow
            at = ((high * GOLDEN % 65536) * 65536 + low * GOLDEN) % F.lit(2**32) / F.lit(float(2**32))
            edge, source, limit, k = 0.0, F.lit(None).cast("string"), F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
            cuts = []
            for s, w, l in zip(p["sources"], p["weights"], p["limits"]):
                edge += w
                cuts.append((edge, s, l, self.stock[s]))
            for i, (e, s, l, b) in enumerate(reversed(cuts)):
                hit = F.lit(True) if i == 0 else at < e
                source, limit, k = F.when(hit, F.lit(s)).otherwise(source), F.when(hit, F.lit(l)).otherwise(limit), F.when(hit, F.lit(b)).otherwise(k)
            ids = self.spark.range(p["slots"]).select(F.lit(mix).alias("mix"), F.col("id").alias("slot"), source.alias("source"), limit.alias("lim"), k.alias("k"))
            parts.append(ids.withColumn("chunk", F.floor(F.col("slot") / self.chunk_rows).cast("int")))
        if not parts:
            return self.spark.createDataFrame([], "mix string, slot bigint, source string, epoch bigint, block bigint")
        rows = parts[0]
        for x in parts[1:]:
            rows = rows.unionByName(x)
        offset = _offsets(rows, ["mix", "source"], F.lit(1))
        w = Window.partitionBy("mix", "source", "chunk").orderBy("slot")
        ranked = rows.withColumn("r", F.row_number().over(w) - 1).join(offset, ["mix", "source", "chunk"]).withColumn("rank", F.col("r") + F.col("offset")).where("rank < lim")
        epoch = F.floor(F.col("rank") / F.col("k")).cast("bigint")
        return ranked.select("mix", "slot", "source", epoch.alias("epoch"), F.pmod(F.col("rank"), F.col("k")).alias("block"))

    def schedule(self) -> DataFrame:
        """(mix, slot, source, epoch, item, token_start, n_tokens): the records of the mix, or their parts, by slot."""
        return self.slots().join(self.blocks, ["source", "epoch", "block"]).select("mix", "slot", "source", "epoch", "item", "token_start", "n_tokens")

    def shares(self) -> DataFrame:
        """Per mix and source the share wanted, the share reached, tokens and the most repeats of a record."""
        got = self.schedule().groupBy("mix", "source").agg(F.sum("n_tokens").alias("tokens"), (F.max("epoch") + 1).alias("repeats"))
        total = got.groupBy("mix").agg(F.sum("tokens").alias("mix_tokens"))
        wanted = self.spark.createDataFrame(self.targets or [], "mix string, source string, target_share double, max_repeats int")
        out = wanted.join(got, ["mix", "source"], "left").join(total, "mix", "left").fillna(0, ["tokens", "repeats"])
        return out.select("mix", "source", "target_share", "max_repeats", "tokens", "repeats", F.coalesce(F.col("tokens") / F.col("mix_tokens"), F.lit(0.0)).alias("actual_share"))
