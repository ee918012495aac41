"""Filling containers of fixed capacity (problem 7).

Hierarchical residual packing: every task packs its items by best fit, largest first, and emits
the bins that are nearly full. The others go on as items of the next round, where fewer tasks
gather more of them. Best fit leaves each task at most one bin that is no more than half full, so
once rounds help little, those alone are merged further, down to one task. In the end no two
containers of a profile would fit into one, but for a single small one, whatever the number of
tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorespark.session import materialise, ship

#: Items that one task packs, and the share of the capacity that a nearly full bin may leave empty.
TASK_ITEMS = 40_000
NEARLY_FULL = 0.005
#: Rounds over all underfull bins end when one merges less than this share of them; those up to half full go on.
LEAST_GAIN = 0.01

_MEMBERS = "array<struct<item:{0},piece_no:int,token_start:bigint,n_tokens:bigint>>"


class BestFit:
    """Bins by room: a bit per size of room finds the tightest bin in one shift."""

    def __init__(self, capacity: int, separator: int):
        self.capacity, self.separator = capacity, separator
        self.by_room: dict[int, list[int]] = {}
        self.rooms = 0
        self.used: list[int] = []

    def place(self, size: int) -> int:
        """The bin of an item of `size`, which must not exceed the capacity."""
        need = size + self.separator  # the separator before it
        fits = self.rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            stack = self.by_room[room]
            at = stack.pop()
            if not stack:
                self.rooms ^= 1 << room
            self.used[at] += need
        else:
            at = len(self.used)
            self.used.append(size)
        room = self.capacity - self.used[at]
        if room > self.separator:
            stack = self.by_room.setdefault(room, [])
            if not stack:
                self.rooms |= 1 << room
            stack.append(at)
        return at


def _round(profiles: dict[str, tuple[int, int]], no: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        rows: dict[str, list[tuple[int, str, list]]] = {}
        schema = None
        for batch in batches:
            schema = schema or batch.schema
            for p, size, key, members in zip(*(c.to_pylist() for c in batch.columns)):
                rows.setdefault(p, []).append((size, key, members))
        for p, items in rows.items():
            capacity, separator = profiles[p]
            fit = BestFit(capacity, separator)
            bins: list[list] = []
            items.sort(key=lambda r: (-r[0], r[1]))
            for size, _, members in items:
                at = fit.place(size)
                if at == len(bins):
                    bins.append([])
                bins[at].extend(members)
            for at in range(0, len(bins), 2000):
                part = bins[at : at + 2000]
                columns = [[p] * len(part), fit.used[at : at + 2000], [f"{p}-{no}-{task:05d}-{at + i:06d}" for i in range(len(part))], part]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _pieces(sizes: DataFrame, profiles: dict[str, tuple[int, int]]) -> DataFrame:
    """One row per item and profile, or per piece where an item exceeds the capacity."""
    known = F.array(*[F.struct(F.lit(p).alias("profile"), F.lit(c).cast("bigint").alias("capacity")) for p, (c, _) in profiles.items()])
    each = sizes.where("size > 0").select("item", "size", F.inline(known))
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.col("capacity"))
    cut = each.select("profile", "item", "size", "capacity", F.posexplode(starts).alias("piece_no", "token_start"))
    n = F.least(F.col("capacity"), F.col("size") - F.col("token_start"))
    member = F.struct("item", "piece_no", "token_start", n.alias("n_tokens"))
    return cut.select("profile", n.alias("size"), F.concat_ws("-", F.col("item").cast("string"), "piece_no").alias("key"), F.array(member).alias("members"))


def pack(sizes: DataFrame, id_col: str, size_col: str, profiles: dict[str, tuple[int, int]], task_items: int = TASK_ITEMS) -> DataFrame:
    """(profile, container, position, item, piece_no, token_start, n_tokens).

    `profiles` maps a name to (capacity, tokens lost between two items). Items without a size
    or of size 0 need no container; an item above the capacity is cut into full pieces and a
    rest, all others stay whole. Repeated ids are packed as often as they occur.
    """
    if any(c <= 0 or s < 0 for c, s in profiles.values()):
        raise ValueError("capacities must be positive and separators not negative")
    ship(sizes.sparkSession)
    items = sizes.select(F.col(id_col).alias("item"), F.col(size_col).cast("bigint").alias("size"))
    schema = f"profile string, used bigint, container string, members {_MEMBERS.format(items.schema['item'].dataType.simpleString())}"
    full = F.lit(None).cast("bigint")
    for p, (c, _) in profiles.items():
        full = F.when(F.col("profile") == p, F.lit(math.floor(c * (1 - NEARLY_FULL)))).otherwise(full)
    half = F.lit(None).cast("bigint")
    for p, (c, sep) in profiles.items():
        half = F.when(F.col("profile") == p, F.lit((c - sep) // 2)).otherwise(half)
    rows = materialise(_pieces(items, profiles))
    left, done, no, small = rows.count(), [], 0, False
    while True:
        tasks = max(1, math.ceil(left / task_items))
        spread = rows.repartition(tasks, F.xxhash64("key")) if tasks > 1 else rows.coalesce(1)
        packed = materialise(spread.mapInArrow(_round(profiles, no), schema))
        if tasks == 1:
            done.append(packed)
            break
        stays = F.col("used") > half if small else F.col("used") >= full
        under = packed.where(~stays)
        now = under.count()
        if not small and now > left * (1 - LEAST_GAIN):
            small, stays = True, F.col("used") > half
            under = packed.where(~stays)
            now = under.count()
        done.append(packed.where(stays))
        rows, left, no = under.select("profile", F.col("used").alias("size"), F.col("container").alias("key"), "members"), now, no + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("profile", "container", F.posexplode("members").alias("position", "m")).select("profile", "container", "position", "m.*")


def fill_report(packed: DataFrame, profiles: dict[str, tuple[int, int]]) -> DataFrame:
    """Per profile: containers, items, tokens, the share of the capacity that they fill, and how many are no more than half full."""
    capacity = separator = F.lit(None).cast("bigint")
    for p, (c, s) in profiles.items():
        capacity, separator = F.when(F.col("profile") == p, F.lit(c)).otherwise(capacity), F.when(F.col("profile") == p, F.lit(s)).otherwise(separator)
    used = F.col("t") + (F.col("n") - 1) * separator
    per = packed.groupBy("profile", "container").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t"))
    total = per.groupBy("profile").agg(F.count("*").alias("containers"), F.sum("n").alias("items"), F.sum("t").alias("tokens"), F.count_if(used * 2 <= capacity - separator).alias("up_to_half"))
    return total.withColumn("fill", F.col("tokens") / (F.col("containers") * capacity))
