"""Look-ups over record tables: stars with sentinel keys, repeated columns, first matches, fallbacks, markers.

No rule of any one game or shop is in here: what to look up and compute comes as arguments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorespark.functions.strings import bit, marker_percent, percent_of_span

#: Dimension tables up to this many bytes by the optimizer's own estimate are broadcast; files may grow tenfold in memory.
BROADCAST_BYTES = 8 * 1024 * 1024


def small_side(dim: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint if the optimizer's size estimate of the table is below the bound, else the table as it is."""
    size = int(str(dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(dim) if size <= max_bytes else dim


def star_lookup(facts: DataFrame, dims: list[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Left equi-joins of facts to dimensions (table, foreign key, key, prefix of its columns).

    A numeric foreign key of 0 or less means no row. A dimension must have one row per key.
    """
    out = facts
    for dim, fk, key, prefix in dims:
        right = small_side(dim.select(*[F.col(c).alias(f"{prefix}{c}") for c in dim.columns]))
        kind = dict(out.dtypes)[fk]
        link = F.when(F.col(fk) > 0, F.col(fk)) if kind in ("int", "bigint", "smallint", "double") else F.nullif(F.col(fk), F.lit(""))
        out = out.withColumn("__fk", link).join(right, F.col("__fk") == F.col(f"{prefix}{key}"), "left").drop("__fk")
    return out


def unpivot_slots(df: DataFrame, keep: list[str], groups: dict[str, list[str]]) -> DataFrame:
    """One row per slot of repeated columns, e.g. {"item": ["item1", ..], "prob": ["prob1", ..]};
    slots whose first column is null, '' or 0 are empty."""
    names, columns = list(groups), list(groups.values())
    if len({len(c) for c in columns}) != 1:
        raise ValueError("every group needs as many columns as the others")
    slots = F.array(*[F.struct(F.lit(i + 1).alias("slot"), *[F.col(c[i]).alias(n) for n, c in zip(names, columns)]) for i in range(len(columns[0]))])
    out = df.select(*keep, F.inline(slots))
    return out.where(F.col(names[0]).isNotNull() & ~F.col(names[0]).cast("string").isin("", "0", "0.0"))


def join_array_keys(df: DataFrame, id_col: str, array_col: str, dim: DataFrame, key: str, value: str) -> DataFrame:
    """(id, values): the array of keys replaced by the looked-up values in the same order; unknown keys drop out."""
    one = df.select(F.col(id_col), F.posexplode(array_col).alias("__i", "__k"))
    got = one.join(small_side(dim.select(F.col(key).alias("__k"), F.col(value).alias("__v"))), "__k", "left")
    values = F.transform(F.sort_array(F.collect_list(F.when(F.col("__v").isNotNull(), F.struct("__i", "__v")))), lambda x: x["__v"])
    return df.select(id_col).distinct().join(got.groupBy(id_col).agg(values.alias("values")), id_col, "left").withColumn("values", F.coalesce("values", F.array().cast(f"array<{dict(dim.dtypes)[value]}>")))


def first_match(dim: DataFrame, key: str, order_col: str) -> DataFrame:
    """The first row of each key by order: what a scan of a list for a name finds. One aggregation, no window."""
    rest = [c for c in dim.columns if c != key]
    return dim.groupBy(key).agg(F.min_by(F.struct(*rest), order_col).alias("r")).select(key, "r.*")


def last_match(dim: DataFrame, key: str, order_col: str) -> DataFrame:
    """The last row of each key by order: what filling a map leaves."""
    rest = [c for c in dim.columns if c != key]
    return dim.groupBy(key).agg(F.max_by(F.struct(*rest), order_col).alias("r")).select(key, "r.*")


def fallback_chain(df: DataFrame, steps: list[tuple[DataFrame, Column, str, str]], out: str) -> DataFrame:
    """`out` is the first non-empty value of several look-ups (table, key expression, its key, its value)."""
    found = []
    for i, (dim, expr, key, value) in enumerate(steps):
        right = small_side(dim.select(F.col(key).alias(f"__k{i}"), F.nullif(F.col(value), F.lit("")).alias(f"__v{i}")))
        df = df.join(right, expr == F.col(f"__k{i}"), "left")
        found.append(F.col(f"__v{i}"))
    return df.withColumn(out, F.coalesce(*found)).drop(*[f"__{x}{i}" for i in range(len(steps)) for x in "kv"])


def prefer_namespace(df: DataFrame, name_col: str, titles: DataFrame, prefixes: list[str], default: str = "") -> DataFrame:
    """`resolved`: the first `prefix + name` that is a title, else `default + name`."""
    tried = df.select(name_col).distinct().select(name_col, F.posexplode(F.array(*[F.concat(F.lit(p), F.col(name_col)) for p in prefixes])).alias("__i", "title"))
    hit = tried.join(titles.select("title").distinct(), "title").groupBy(name_col).agg(F.min_by("title", "__i").alias("__t"))
    return df.join(hit, name_col, "left").withColumn("resolved", F.coalesce("__t", F.concat(F.lit(default), F.col(name_col)))).drop("__t")


def translate(df: DataFrame, col: str, dictionary: DataFrame, key: str, value: str) -> Column | DataFrame:
    """`col` by its dictionary value, itself where there is none."""
    right = small_side(first_match(dictionary.select(F.col(key).alias("__k"), F.col(value).alias("__v")), "__k", "__v"))
    return df.join(right, F.col(col) == F.col("__k"), "left").withColumn(col, F.coalesce("__v", F.col(col))).drop("__k", "__v")


def bit_flags(df: DataFrame, flags_col: str, labels: list[str]) -> DataFrame:
    """One 0/1 column per bit, lowest first."""
    return df.select("*", *[bit(F.col(flags_col), i).alias(n) for i, n in enumerate(labels)])


def markers(points: DataFrame, group: str, x: str, y: str, slack: float = 5.0) -> DataFrame:
    """(group, markers): places as percentages of the box of their group, in order, those outside left out.

    `points` has columns lower_x, upper_x, lower_y, upper_y of the box.
    """
    left = marker_percent(percent_of_span(F.col(x), F.col("lower_x"), F.col("upper_x")), slack)
    top = marker_percent(percent_of_span(F.col(y), F.col("lower_y"), F.col("upper_y")), slack)
    placed = points.select(group, left.alias("left"), top.alias("top")).where("left IS NOT NULL AND top IS NOT NULL")
    return placed.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("left", "top"))).alias("markers"))


def hit_shares(rates: Column) -> Column:
    """Share of each hit: by rate where any is positive, else equal over all hits; 255 counts as none."""
    clean = F.transform(rates, lambda r: F.when((r == 255) | (r < 0), 0.0).otherwise(r.cast("double")))
    total = F.aggregate(clean, F.lit(0.0), lambda a, r: a + r)
    return F.transform(clean, lambda r: F.when(total > 0, r / total).otherwise(F.lit(1.0) / F.size(rates)))


def running_total(values: Column) -> Column:
    """Array of running sums."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1))), lambda i: F.aggregate(F.slice(values, 1, i), F.lit(0.0), lambda a, x: a + x))


def share_of_greatest(df: DataFrame, gauge: str, row: str, value: str, out: str = "pct") -> DataFrame:
    """`out`: each value in percent of the greatest row sum of its gauge, halves rounded up."""
    sums = df.groupBy(gauge, row).agg(F.sum(value).alias("__s")).groupBy(gauge).agg(F.max("__s").alias("__m"))
    return df.join(sums, gauge).withColumn(out, F.floor(F.col(value) / F.nullif(F.col("__m"), F.lit(0)) * 100 + 0.5).cast("bigint")).drop("__m")


def by_rate(df: DataFrame, rate_col: str, order_col: str) -> DataFrame:
    """Falling by the number with which a text begins, ties in order; texts without one last."""
    rate = F.regexp_extract(F.trim(rate_col), r"^[+-]?(?:\d+\.?\d*|\.\d+)", 0).try_cast("double")
    return df.withColumn("rate_value", rate).orderBy(F.col("rate_value").desc_nulls_last(), order_col)


def listed_first(c: Column, names: list[str]) -> Column:
    """Sort key: place in the list, names not listed last."""
    return F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(n) for n in names]), c), F.lit(0)), F.lit(len(names) + 1))


def pairwise(args: Column) -> Column:
    """Consecutive pairs of an array; a last odd one pairs with ''."""
    n = F.size(args)
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)), F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(F.element_at(args, i).alias("first"), F.coalesce(F.try_element_at(args, i + 1), F.lit("")).alias("second")))


def scored(df: DataFrame, tests: dict[str, Column], out: str = "score") -> DataFrame:
    """Number of tests that hold; null tests do not."""
    return df.withColumn(out, sum((F.coalesce(t, F.lit(False)).cast("int") for t in tests.values()), F.lit(0)))


def collect_by(df: DataFrame, key: str, order_col: str, columns: list[str], span: int) -> DataFrame:
    """(key, part, items): the rows of each key as sorted structs, in parts of `span` values of the
    integer order column, so that no row grows with its key."""
    part = F.floor(F.col(order_col) / F.lit(span)).cast("bigint")
    return df.groupBy(key, part.alias("part")).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("items"))


def in_order(a: Column, names: list[str]) -> Column:
    """A list of names in the order of `names`, unknown ones after them by name."""
    keyed = F.transform(a, lambda x: F.struct(listed_first(x, names).alias("o"), x.alias("x")))
    return F.transform(F.sort_array(keyed), lambda s: s["x"])


def map_entries(df: DataFrame, id_col: str, map_col: str, name: str | Column, above: int | None = None, below: int | None = None, inside: bool = True) -> DataFrame:
    """(id, pos, entry_id, entry_title) of the entries that a name has in a map of name to array of (id, title).

    With bounds only ids strictly between them are taken, or with `inside=False` only the others.
    An unknown name, a null map and an empty array give nothing.
    """
    listed = F.try_element_at(F.col(map_col), F.lit(name) if isinstance(name, str) else name)
    out = df.select(F.col(id_col), F.posexplode(listed).alias("pos", "e")).select(id_col, "pos", F.col("e.id").alias("entry_id"), F.col("e.title").alias("entry_title"))
    if above is None and below is None:
        return out
    between = F.lit(True)
    if above is not None:
        between = between & (F.col("entry_id") > above)
    if below is not None:
        between = between & (F.col("entry_id") < below)
    return out.where(between if inside else ~between)


def placements_by_area(values: DataFrame, places: DataFrame, name_col: str, areas_col: str, skip_suffix: str = "") -> DataFrame:
    """(query, area, place columns): query values (query, value) joined to places by trimmed name, once for each of their areas.

    Places without a name, empty areas and areas that end with `skip_suffix` are left out. The group
    of an area is its rows, so an area may have any number of them.
    """
    keyed = values.select("query", F.trim("value").alias("__v")).where("__v <> ''").distinct()
    fanned = places.where(F.col(name_col) != "").withColumn("area", F.explode(areas_col)).where("area <> ''").drop(areas_col)
    if skip_suffix:
        fanned = fanned.where(~F.col("area").endswith(skip_suffix))
    return keyed.join(fanned, F.col("__v") == F.col(name_col)).drop("__v")


def holds_any_case(array: Column, wanted: Column) -> Column:
    """Whether an array holds a text in any case; false for a null or empty array."""
    return F.coalesce(F.exists(array, lambda x: F.lower(x) == F.lower(wanted)), F.lit(False))


def unpivot_nested(df: DataFrame, keep: list[str], outer: dict[str, str], inner: dict[str, list[str]]) -> DataFrame:
    """One row per filled slot of struct columns: `outer` names the columns (column: section name), `inner` the
    repeated fields of each struct, as in `unpivot_slots`. Null structs have no slots."""
    parts = None
    for column, section in outer.items():
        fields = [F.col(f"{column}.{f}").alias(f) for names in inner.values() for f in names]
        flat = df.where(F.col(column).isNotNull()).select(*keep, F.lit(section).alias("section"), *fields)
        one = unpivot_slots(flat, [*keep, "section"], inner)
        parts = one if parts is None else parts.unionByName(one)
    return parts
