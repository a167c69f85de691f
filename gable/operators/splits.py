"""Train/test splits and folds, reproducible by md5 order of a unique key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gable.operators.spread import rank_by_hash, rank_by_order


def split_by_key(
    df: DataFrame,
    key: str,
    test_size: float = 0.2,
    strata: Sequence[str] = (),
    seed: int = 0,
    names: tuple[str, str] = ("train", "test"),
) -> DataFrame:
    """Shuffled split. Without strata ``ceil(test_size * n)`` rows are test, with strata ``round`` of it per stratum."""
    ranked = rank_by_hash(df, key, seed, strata, "_rank", "_size")
    share = F.lit(float(test_size)) * F.col("_size")
    n_test = F.round(share) if strata else F.ceil(F.round(share, 9))
    label = F.when(F.col("_rank") <= n_test, names[1]).otherwise(names[0])
    return ranked.withColumn("split", label).drop("_rank", "_size")


def split_in_order(
    df: DataFrame, order: Sequence[str | Column], test_size: float = 0.25, strata: Sequence[str] = ()
) -> DataFrame:
    """Unshuffled split: the last ``ceil(test_size * n)`` rows of the order are test."""
    ranked = rank_by_order(df, order, strata, "_rank", "_size")
    n_test = F.ceil(F.round(F.lit(float(test_size)) * F.col("_size"), 9))
    label = F.when(F.col("_rank") > F.col("_size") - n_test, "test").otherwise("train")
    return ranked.withColumn("split", label).drop("_rank", "_size")


def split_data(
    df: DataFrame,
    problem_type: str,
    key: str,
    target: str | None = None,
    order: Sequence[str | Column] | None = None,
    test_size: float = 0.2,
    seed: int = 0,
) -> DataFrame:
    """Default split of a problem type: ordered for time series, shuffled for regression, else stratified."""
    if problem_type.startswith("time series"):
        return split_in_order(df, order or [key], test_size)
    if problem_type == "regression":
        return split_by_key(df, key, test_size, seed=seed)
    if problem_type not in ("binary", "multiclass"):
        raise ValueError(f"unknown problem type: {problem_type}")
    return split_by_key(df, key, test_size, [target], seed)


def training_validation_split(
    df: DataFrame,
    key: str,
    test_size: float | None = None,
    train_size: float | None = None,
    shuffle: bool = False,
    stratify: str | None = None,
    order: Sequence[str | Column] | None = None,
    seed: int = 0,
) -> DataFrame:
    """Single split, a quarter for test by default; unshuffled it is the end of the order."""
    if test_size is None:
        test_size = 0.25 if train_size is None else 1 - train_size
    if stratify and not shuffle:
        raise ValueError("a stratified split must be shuffled")
    if shuffle:
        return split_by_key(df, key, test_size, [stratify] if stratify else (), seed)
    return split_in_order(df, order or [key], test_size)


def k_fold(
    df: DataFrame, key: str, k: int = 3, strata: Sequence[str] = (), seed: int = 0, name: str = "fold"
) -> DataFrame:
    """0-based fold per row; with strata every stratum is dealt evenly over the folds."""
    if k < 2:
        raise ValueError("k-fold needs at least two folds")
    ranked = rank_by_hash(df, key, seed, strata, "_rank")
    return ranked.withColumn(name, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")


def time_series_split(
    df: DataFrame, order: Sequence[str | Column], n_splits: int = 3, max_delay: int = 0, gap: int = 0
) -> DataFrame:
    """Rolling-origin splits in long form: one row per (split, row) with role train or test.

    Train ends ``gap`` rows later and test starts ``max_delay`` rows earlier than in the plain scheme, so a row
    may have both roles. Split bounds are arithmetic on the position, hence one pass after ranking.
    """
    ranked = rank_by_order(df, order, (), "_rank", "_size")
    n = df.count()
    if n // n_splits < gap + max_delay:
        raise ValueError("too few rows per split for the given gap and max_delay")
    size = n // (n_splits + 1)
    if size == 0:
        raise ValueError("more splits than rows")
    position = F.col("_rank") - 1
    roles = []
    for i in range(n_splits):
        first = n - (n_splits - i) * size
        train = position < min(first + gap, n)
        test = (position >= max(first - max_delay, 0)) & (position < min(first + size + gap, n))
        for role, member in (("train", train), ("test", test)):
            roles.append(F.when(member, F.struct(F.lit(i).alias("split_id"), F.lit(role).alias("role"))))
    kept = F.filter(F.array(*roles), lambda r: r.isNotNull())
    long = ranked.withColumn("_member", F.explode(kept))
    return long.select(*df.columns, "_member.split_id", "_member.role")
