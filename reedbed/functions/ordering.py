"""Reproducible order, ranks and running totals that never need one task per group.

Rows are ordered by ``md5(seed:id)``. Its leading hex digits split any group,
however large, into evenly filled slices, so a rank is "rows in earlier slices"
(from a small histogram) plus the position inside the own slice. The slice
balance rests on ``id`` being a key of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reedbed.session import materialize

SLICE_DIGITS = 3  # 16**3 = 4096 slices per group, and more digits for more rows
SLICE_ROWS = 20_000  # rows of a slice that one task sorts


def hash_key(id_col: str | Column, seed: int) -> Column:
    """Order key of a row: independent of partitions and portable to other engines."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), col.cast("string")))


def hash_number(text: Column) -> Column:
    """First 60 bits of md5 as a non-negative bigint."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _before(groups: list[str], order: Column, value: Column) -> Column:
    w = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0).cast("bigint"))


def _slices(df: DataFrame, groups: list[str], key: str, digits: int) -> DataFrame:
    """Histogram (groups, slice) -> rows in the slice and in all slices before it."""
    hist = (
        df.groupBy(*groups, F.substring(key, 1, digits).alias("_slice"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    return hist.withColumn("_before", _before(groups, F.col("_slice"), F.col("_rows")))


def slice_digits(rows: int) -> int:
    """Leading digits that keep the slices of a group of so many rows within ``SLICE_ROWS`` rows on average."""
    digits = SLICE_DIGITS
    while rows > SLICE_ROWS * 16**digits:
        digits += 1
    return digits


def rank_by_hash(df: DataFrame, groups: list[str], key: str, out: str = "rank", rows: int = 0) -> DataFrame:
    """Add the 1-based rank by ``key`` inside each group (non-null group columns).

    A group is spread over its slices; no task sorts more than one slice. ``rows`` is the size of the
    input where it is known: larger inputs have finer slices.
    """
    digits = slice_digits(rows)
    sliced = df.withColumn("_slice", F.substring(key, 1, digits))
    offsets = _slices(df, groups, key, digits).drop("_rows")
    local = Window.partitionBy(*groups, "_slice").orderBy(key)
    # Numbered before the join: its order by group and slice then serves the join as well.
    return (
        sliced.withColumn("_rn", F.row_number().over(local))
        .join(offsets, groups + ["_slice"])
        .withColumn(out, F.col("_before") + F.col("_rn"))
        .drop("_slice", "_before", "_rn")
    )


def cut_keys(narrow: DataFrame, groups: list[str], key: str, n: int | Column) -> DataFrame:
    """(groups, ``cut``): the n-th key of each group in order, or its last; groups of which nothing is wanted are left out.

    ``narrow`` has the groups and the key, best as a written table. A histogram of leading digits tells which slice of a
    group holds its n-th key; only that slice is counted again by further digits, until it is small enough to
    be sorted. So the work after the first pass does not grow with the group, and nothing but counts is shuffled.
    """
    quota = (F.lit(n) if isinstance(n, int) else n).cast("bigint")
    # A group column may be null or an array: the groups go by one text each, and none by the empty one.
    name = F.to_json(F.struct(*groups)) if groups else F.lit("")
    held = narrow.select(*groups, name.alias("_group"), F.col(key).alias("_key"), quota.alias("_quota"))
    digits, found, current = SLICE_DIGITS, None, held
    while True:
        counted = current.groupBy("_group", F.substring("_key", 1, digits).alias("_slice")).agg(F.count(F.lit(1)).alias("_rows"), F.max("_quota").alias("_quota"))
        before = _before(["_group"], F.col("_slice"), F.col("_rows"))
        if found is None:
            whole = F.sum("_rows").over(Window.partitionBy("_group"))
            placed = counted.withColumns({"_before": before, "_all": whole}).withColumn("_want", F.least("_quota", "_all"))
        else:
            placed = counted.withColumn("_before", before).join(found.select("_group", "_want"), "_group")
        cut = placed.filter((F.col("_before") < F.col("_want")) & (F.col("_want") <= F.col("_before") + F.col("_rows")))
        found = materialize(cut.select("_group", F.col("_slice").alias("_cut_slice"), (F.col("_want") - F.col("_before")).alias("_want"), "_rows"), "cuts")
        current = held.join(found.select("_group", "_cut_slice"), "_group").filter(F.col("_key").startswith(F.col("_cut_slice"))).drop("_cut_slice")
        most = found.agg(F.max("_rows")).first()[0] or 0
        if most <= SLICE_ROWS or digits >= 30:
            break
        digits += SLICE_DIGITS
    order = Window.partitionBy("_group").orderBy("_key")
    last = current.withColumn("_rank", F.row_number().over(order)).join(found.select("_group", "_want"), "_group").filter("_rank = _want")
    return materialize(last.select(*groups, F.col("_key").alias("cut")), "cut-keys")


def take_by_hash(df: DataFrame, groups: list[str], key: str, n: int | Column) -> DataFrame:
    """The first ``n`` rows by ``key`` of each group; ``n`` may depend on the group. Rows are filtered, not shuffled."""
    return up_to_cut(df, cut_keys(df, groups, key, n), groups, F.col(key))


def up_to_cut(df: DataFrame, cuts: DataFrame, groups: list[str], key: Column) -> DataFrame:
    """The rows whose key is not behind their group's cut: a filter on the scan, with one small row for each group."""
    if not groups:
        return df.filter(key <= cuts.select("cut").scalar())
    same = [F.col(g).eqNullSafe(F.col(f"_cut_{g}")) for g in groups]
    named = cuts.select(*[F.col(g).alias(f"_cut_{g}") for g in groups], F.col("cut").alias("_cut"))
    return df.join(named, same).filter(key <= F.col("_cut")).drop("_cut", *[f"_cut_{g}" for g in groups])


def value_cuts(df: DataFrame, col: str) -> list[float]:
    """Values that split ``col`` evenly: four ranges per shuffle partition.

    Fetched once and then used as constants: the cuts only balance the work,
    any cuts give the same result, but all branches must use the same ones.
    """
    pieces = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if pieces < 2:
        return []
    points = [i / pieces for i in range(1, pieces)]
    found = df.agg(F.percentile_approx(col, points, F.lit(20 * pieces)).alias("c")).first()["c"]
    return sorted(set(found or []))


def _piece(col: Column, cuts: list[float]) -> Column:
    """Number of cuts at or below ``col``: a binary search, so the expression stays short for any number of cuts."""
    if not cuts:
        return F.lit(0)
    known, steps = F.array(*map(F.lit, cuts)), [1 << k for k in reversed(range(len(cuts).bit_length()))]

    def step(at: Column, width: Column) -> Column:
        below = (at + width <= len(cuts)) & (F.get(known, at + width - 1) <= col)
        return F.when(below, at + width).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def running_totals(
    df: DataFrame, groups: list[str], order: str, sums: list[str], cuts: list[float], descending: bool
) -> DataFrame:
    """Inclusive running sums by ``order`` in each group, and the group totals.

    ``df`` has one row per (groups, order). Adds ``<s>_run`` and ``<s>_total`` for each
    ``s`` in ``sums``. A group is cut into value ranges that are summed apart and then
    shifted by the sums of the ranges before them.
    """
    cut = df.withColumn("_piece", _piece(F.col(order), cuts))
    piece_order = F.col("_piece").desc() if descending else F.col("_piece").asc()
    totals = cut.groupBy(*groups, "_piece").agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums])
    whole = Window.partitionBy(*groups)
    shifts = totals.select(
        *groups,
        "_piece",
        *[_before(groups, piece_order, F.col(f"_sum_{s}")).alias(f"_shift_{s}") for s in sums],
        *[F.sum(f"_sum_{s}").over(whole).alias(f"{s}_total") for s in sums],
    )
    row_order = F.col(order).desc() if descending else F.col(order).asc()
    local = (
        Window.partitionBy(*groups, "_piece").orderBy(row_order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = cut.withColumns({f"_local_{s}": F.sum(s).over(local) for s in sums}).join(shifts, groups + ["_piece"])
    runs = {f"{s}_run": F.col(f"_shift_{s}") + F.col(f"_local_{s}") for s in sums}
    return summed.withColumns(runs).drop("_piece", *[f"_{kind}_{s}" for kind in ("shift", "local") for s in sums])


def with_next(
    df: DataFrame, groups: list[str], order: str, cols: list[str], cuts: list[float], descending: bool
) -> DataFrame:
    """Adds ``<c>_next``, the value in the next row by ``order`` of the group; null in its last row.

    ``df`` has one row per (groups, order). Value ranges look up their own rows; over a border the first row of the
    next range that has any is handed on, one small row per range.
    """
    cut = df.withColumn("_piece", _piece(F.col(order), cuts)).withColumn("_row", F.struct(*cols))
    piece_order = F.col("_piece").desc() if descending else F.col("_piece").asc()
    row_order = F.col(order).desc() if descending else F.col(order).asc()
    first = F.max_by("_row", order) if descending else F.min_by("_row", order)
    heads = cut.groupBy(*groups, "_piece").agg(first.alias("_head"))
    over = F.lead("_head").over(Window.partitionBy(*groups).orderBy(piece_order))
    borders = heads.select(*groups, "_piece", over.alias("_border"))
    inside = F.lead("_row").over(Window.partitionBy(*groups, "_piece").orderBy(row_order))
    found = cut.withColumn("_inside", inside).join(borders, groups + ["_piece"])
    following = F.coalesce("_inside", "_border")
    return found.select(*df.columns, *[following[c].alias(f"{c}_next") for c in cols])
