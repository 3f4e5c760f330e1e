"""Reproducible sampling and id-safe splits.

Random order is the order of ``md5(seed:id)``: the same rows come out for any number of
partitions, and no group is ever ranked in one task (see ``functions.ordering``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reedbed.config import SamplingStrategy
from reedbed.functions.ordering import cut_keys, hash_key, hash_number, rank_by_hash, up_to_cut
from reedbed.operators.strategies import apply_strategy, keep_by_frequency
from reedbed.session import materialize

LABEL = "class_label_single"
DRAWS_PER_TASK_ROW = 100_000


def _target_pool(df: DataFrame) -> DataFrame:
    return df.filter((F.col("species_type") == "Target Only") & F.col(LABEL).isNotNull())


def _other_pool(df: DataFrame) -> DataFrame:
    return df.filter(F.col("species_type") == "Other")


def _narrow(pool: DataFrame, seed: int, *columns: str) -> DataFrame:
    """Ids, the named columns and the order key, written once: all that is picked is picked from it."""
    written = materialize(pool.select("id", *columns), "sampling-pool")
    return written.withColumn("_key", hash_key("id", seed))  # cheaper to compute again than to store


def _take(df: DataFrame, groups: list[str], n: int, seed: int) -> DataFrame:
    """The first ``n`` rows of each group: the cut keys come from a narrow pass, and the rows are filtered by them."""
    cuts = cut_keys(_narrow(df, seed, *groups), groups, "_key", n)
    return up_to_cut(df, cuts, groups, hash_key("id", seed))


def sample_target_none(df: DataFrame) -> DataFrame:
    """All labelled rows with target species only."""
    return _target_pool(df)


def sample_target_downsample(df: DataFrame, cap: int | None, seed: int = 42) -> DataFrame:
    """At most ``cap`` rows per label; without a cap, all."""
    if not cap:
        return _target_pool(df)
    return _take(_target_pool(df), [LABEL], cap, seed)


def _upsampled_ids(narrow: DataFrame, cap: int | None, seed: int) -> DataFrame:
    """(id, draw): ``max(n, cap)`` draws with replacement per label.

    Draws are made in blocks spread over the cluster and meet the ids by
    ``(label, rank)``, which is unique: a large class is never one task.
    """
    sizes = narrow.groupBy(LABEL).agg(F.count(F.lit(1)).alias("_n"))
    wanted = F.greatest(F.col("_n"), F.lit(cap or 0).cast("bigint"))
    blocks = (
        sizes.withColumn("_wanted", wanted)
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_wanted - 1) div {DRAWS_PER_TASK_ROW}"))))
        # A fixed number of partitions: the few block rows look too small to adaptive
        # execution, which would merge them, and with them all draws, into one task.
        .repartition(int(narrow.sparkSession.conf.get("spark.sql.shuffle.partitions")), LABEL, "_block")
    )
    first = F.col("_block") * DRAWS_PER_TASK_ROW
    last = F.least(first + DRAWS_PER_TASK_ROW, F.col("_wanted")) - 1
    draws = blocks.select(LABEL, "_n", F.explode(F.sequence(first, last)).alias("draw"))
    text = F.concat_ws(":", F.lit(str(seed)), F.col(LABEL).cast("string"), F.col("draw").cast("string"))
    draws = draws.select(LABEL, "draw", (hash_number(text) % F.col("_n") + 1).alias("_rank"))
    ranked = rank_by_hash(narrow.select("id", LABEL, "_key"), [LABEL], "_key", "_rank", narrow.count())
    return ranked.join(draws, [LABEL, "_rank"]).select("id", "draw")


def sample_target_upsample(df: DataFrame, cap: int | None, seed: int = 42) -> DataFrame:
    """``max(n, cap)`` draws with replacement per label, with the number of the draw. Whole rows meet the drawn ids once."""
    pool = _target_pool(df)
    return pool.join(_upsampled_ids(_narrow(pool, seed, LABEL), cap, seed), "id").select(*df.columns, "draw")


def exclude_rare_other(df: DataFrame, min_count: int) -> DataFrame:
    """Other rows with at least one species that occurs ``min_count`` times among them."""
    return keep_by_frequency(_other_pool(df), lambda n: n >= min_count)


def sample_other_random(df: DataFrame, size: int, seed: int = 42) -> DataFrame:
    """``size`` rows of the Other pool."""
    return _take(_other_pool(df), [], size, seed)


def _first_ids(narrow: DataFrame, groups: list[str], n: int | Column) -> DataFrame:
    return up_to_cut(narrow, cut_keys(narrow, groups, "_key", n), groups, F.col("_key")).select("id")


def _stratified_ids(narrow: DataFrame, size: int) -> DataFrame:
    """The ids of an even share per species list, topped up to ``size`` from those not taken."""
    groups = narrow.agg(F.count_distinct("species_names")).first()[0]
    even = materialize(_first_ids(narrow.filter(F.col("species_names").isNotNull()), ["species_names"], max(1, size // max(groups, 1))), "other-share")
    rest = size - even.count()
    if rest <= 0:
        return even
    unused = materialize(narrow.join(even, "id", "left_anti").select("id", "_key"), "other-unused")
    return even.union(_first_ids(unused, [], rest))


def sample_other_stratified(df: DataFrame, size: int, seed: int = 42) -> DataFrame:
    """An even share per species list, topped up to ``size`` from the rows not taken.

    The share is at least one row, so more lists than ``size`` give more rows than ``size``.
    Ids are picked on a narrow table that is written once; full rows are fetched at the end.
    """
    if size <= 0:
        return df.limit(0)
    pool = _other_pool(df)
    return pool.join(_stratified_ids(_narrow(pool, seed, "species_names"), size), "id", "left_semi")


def sample_other(
    df: DataFrame, strategy: str, size: int, exclude_below: int | None = None, seed: int = 42
) -> DataFrame:
    pool = exclude_rare_other(df, exclude_below) if exclude_below else df
    samplers = {"random": sample_other_random, "stratify": sample_other_stratified}
    if strategy not in samplers:
        raise ValueError(f"unknown Other sampling {strategy!r}; known: {sorted(samplers)}")
    return samplers[strategy](pool, size, seed)


def sample_target(df: DataFrame, strategy: str, cap: int | None, seed: int = 42) -> DataFrame:
    """The named target sampling; upsampled rows also carry their ``draw``."""
    if strategy == "downsample":
        return sample_target_downsample(df, cap, seed)
    if strategy == "upsample":
        return sample_target_upsample(df, cap, seed)
    if strategy == "none":
        return sample_target_none(df)
    raise ValueError(f"unknown target sampling {strategy!r}")


def _target_ids(narrow: DataFrame, strategy: str, cap: int | None, seed: int) -> DataFrame:
    """(id, draw) of the named target sampling; only upsampled ids have a draw."""
    if strategy == "upsample":
        return _upsampled_ids(narrow, cap, seed)
    if strategy not in ("downsample", "none"):
        raise ValueError(f"unknown target sampling {strategy!r}")
    ids = _first_ids(narrow, [LABEL], cap) if strategy == "downsample" and cap else narrow.select("id")
    return ids.withColumn("draw", F.lit(None).cast("bigint"))


def _other_ids(narrow: DataFrame, strategy: str, size: int, exclude_below: int | None) -> DataFrame:
    if strategy not in ("random", "stratify"):
        raise ValueError(f"unknown Other sampling {strategy!r}; known: ['random', 'stratify']")
    pool = materialize(exclude_rare_other(narrow, exclude_below), "other-frequent") if exclude_below else narrow
    if size <= 0:
        return pool.limit(0).select("id")
    return _first_ids(pool, [], size) if strategy == "random" else _stratified_ids(pool, size)


def sample_modelling_dataset(df: DataFrame, strategy: SamplingStrategy = SamplingStrategy()) -> DataFrame:
    """Filter, sample targets, add the Other sample if wanted, shuffle.

    All ids are picked from one narrow table of the pool; the pool's whole rows meet the picked ids once.
    """
    cap, seed = strategy.max_samples_per_class, strategy.seed
    if strategy.include_other and cap is None:
        raise ValueError("max_samples_per_class is needed to size the Other sample")
    pool = apply_strategy(df, strategy.species_data_to_use)
    narrow = _narrow(pool, seed, LABEL, "species_type", "species_names")
    picked = _target_ids(_target_pool(narrow), strategy.target_sampling, cap, seed)
    if strategy.include_other:
        size = round(cap * strategy.other_boost)  # half to even
        other = _other_ids(_other_pool(narrow), strategy.other_sampling, size, strategy.exclude_other_below_count)
        picked = picked.unionByName(other.withColumn("draw", F.lit(None).cast("bigint")))
    drawn = pool.join(picked.withColumnRenamed("id", "_picked"), F.col("id") == F.col("_picked"))
    return shuffle_rows(drawn, seed).select(*df.columns)


def sample_hold_out(
    cleaned: DataFrame, used_ids: DataFrame, filter_fn: str | Callable[[DataFrame], DataFrame] | None = None,
    cap: int | None = None, seed: int = 42,
) -> DataFrame:
    """Rows not used for modelling, filtered if wanted; a cap also drops rows without label."""
    unused = apply_strategy(cleaned.join(used_ids.select("id"), "id", "left_anti"), filter_fn)
    if cap is None or cap <= 0:
        return unused
    if LABEL not in unused.columns:
        raise ValueError(f"missing column {LABEL} for a cap per class")
    return _take(unused.filter(F.col(LABEL).isNotNull()), [LABEL], cap, seed)


def _with_quota(ids: DataFrame, wanted: Column, stratify: bool) -> DataFrame:
    """Add ``_stratum`` and how many of its ids are wanted.

    Per class by largest remainder (ties: smaller class first). With fewer ids, or fewer
    wanted ids, than classes there is one stratum.
    """
    counts = ids.groupBy("label").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy()
    sized = counts.select(
        "label",
        "_n",
        F.sum("_n").over(whole).alias("_all"),
        F.count("label").over(whole).alias("_classes"),
        wanted.cast("bigint").alias("_wanted"),
    )
    exact = F.col("_wanted").cast("decimal(38,0)") * F.col("_n").cast("decimal(38,0)")
    sized = sized.withColumn("_left", (exact % F.col("_all")).cast("bigint"))
    sized = sized.withColumn("_base", F.expr(
        "cast((cast(_wanted as decimal(38,0)) * cast(_n as decimal(38,0))) div cast(_all as decimal(38,0)) as bigint)"
    ))
    by_rest = Window.orderBy(F.col("_left").desc(), F.col("label").asc())
    spare = F.col("_wanted") - F.sum("_base").over(whole)
    quota = F.col("_base") + F.when(F.row_number().over(by_rest) <= spare, 1).otherwise(0)
    split = F.lit(stratify) & (F.col("_all") >= F.col("_classes")) & (F.col("_wanted") >= F.col("_classes"))
    quotas = sized.select(
        F.col("label").alias("_label"),
        F.when(split, F.concat(F.lit("c"), F.coalesce(F.col("label").cast("string"), F.lit("")))).otherwise("all").alias("_stratum"),
        F.when(split, quota).otherwise(F.col("_wanted")).alias("_quota"),
    )
    # No hint: adaptive execution broadcasts the quotas while they are small and splits a hot label beyond.
    by_label = F.col("label").eqNullSafe(F.col("_label"))
    return ids.join(quotas, by_label).drop("_label")


def _assign(ids: DataFrame, wanted: Column, stratify: bool, seed: int) -> DataFrame:
    """Mark the wanted number of ids with ``_chosen``."""
    keyed = _with_quota(ids, wanted, stratify).withColumn("_key", hash_key("id", seed))
    ranked = rank_by_hash(keyed, ["_stratum"], "_key", "_rank")
    return ranked.select("id", "label", (F.col("_rank") <= F.col("_quota")).alias("_chosen"))


def split_ids(
    df: DataFrame, id_col: str, label_col: str, order_col: str, test: float, val: float,
    stratify: bool = True, seed: int = 42,
) -> DataFrame:
    """``(id, split)`` for every distinct id: floor(n * test) test, floor(n * val) val, the rest train.

    The label of an id is that of its first row by ``order_col``.
    """
    named = df.groupBy(F.col(id_col).alias("id")).agg(F.min_by(label_col, order_col).alias("label"))
    ids = materialize(named, "split-ids")
    n = ids.agg(F.count(F.lit(1))).scalar()
    tested = materialize(_assign(ids, F.floor(n * F.lit(float(test))), stratify, seed), "split-test")
    rest = tested.filter(~F.col("_chosen")).select("id", "label")
    valued = _assign(rest, F.floor(n * F.lit(float(val))), stratify, seed)
    return tested.filter("_chosen").select("id", F.lit("test").alias("split")).unionByName(
        valued.select("id", F.when(F.col("_chosen"), "val").otherwise("train").alias("split"))
    )


def split_by_id(
    df: DataFrame, id_col: str, label_col: str, order_col: str, test: float, val: float,
    stratify: bool = True, seed: int = 42,
) -> DataFrame:
    """All rows with their ``split``; rows of one id stay together."""
    for col in (id_col, label_col):
        if col not in df.columns:
            raise ValueError(f"missing column: {col}")
    splits = split_ids(df, id_col, label_col, order_col, test, val, stratify, seed).withColumnRenamed("id", "_id")
    return df.join(splits, F.col(id_col) == F.col("_id")).drop("_id")


def split_sizes(df: DataFrame, id_col: str) -> DataFrame:
    """Rows and distinct ids per split."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("num_rows"), F.count_distinct(id_col).alias("num_ids"))


def shuffle_rows(df: DataFrame, seed: int = 42) -> DataFrame:
    """A fixed random order; copies of an id are told apart by their ``draw`` if there is one."""
    if "draw" not in df.columns:
        return df.orderBy(hash_key("id", seed))
    copy = F.concat_ws(":", F.col("id").cast("string"), F.col("draw").cast("string"))
    return df.orderBy(hash_key(copy, seed))
