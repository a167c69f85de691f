"""Class balancing: down-sampling and synthetic over-sampling."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gable.operators.knn import knn_join, vector_of
from gable.operators.reduce import check_numeric_without_nulls
from gable.operators.splits import k_fold, split_by_key, training_validation_split
from gable.operators.spread import hash_number, rank_by_hash
from gable.runtime import written


def class_sizes(df: DataFrame, target: str) -> dict[object, int]:
    """Rows per class; one row per class reaches the driver."""
    return {r[0]: r[1] for r in df.groupBy(target).agg(F.count(F.lit(1))).collect()}


def _per_class(target: str, values: dict[object, object], default=None) -> Column:
    out = F.lit(default)
    for c, v in values.items():
        out = F.when(F.col(target) == F.lit(c), F.lit(v)).otherwise(out)
    return out


def _keep_first(df: DataFrame, target: str, key: str, goals: dict[object, int], seed: int) -> DataFrame:
    ranked = rank_by_hash(df, key, seed, [target], "_rank")
    goal = _per_class(target, goals)
    return ranked.filter(goal.isNull() | (F.col("_rank") <= goal)).drop("_rank")


class BalancedClassificationSampler:
    """Cut classes that outnumber the smallest by more than ``balanced_ratio``.

    Nothing happens when the data are balanced, or when a class is too small both in rows and in share.
    """

    def __init__(self, balanced_ratio: float = 4, min_samples: int = 100, min_percentage: float = 0.1, seed: int = 0):
        allowed = {
            "balanced_ratio": (balanced_ratio, balanced_ratio >= 1, "1 or more"),
            "min_samples": (min_samples, min_samples > 0, "positive"),
            "min_percentage": (min_percentage, 0 < min_percentage <= 0.5, "above 0 and up to one half"),
        }
        for name, (given, good, rule) in allowed.items():
            if not good:
                raise ValueError(f"{name} has to be {rule}: {given}")
        self.balanced_ratio, self.min_samples, self.min_percentage, self.seed = balanced_ratio, min_samples, min_percentage, seed

    def goals(self, sizes: dict[object, int]) -> dict[object, int]:
        """Rows to keep per class that is cut."""
        total, least = sum(sizes.values()), min(sizes.values(), default=0)
        shares = {c: n / total for c, n in sizes.items()}
        over = [c for c in sizes if shares[c] / min(shares.values()) > self.balanced_ratio]
        small = any(n < self.min_samples for n in sizes.values())
        if not over or (small and any(s < self.min_percentage for s in shares.values())):
            return {}
        goal = max(int(self.balanced_ratio * least), self.min_samples)
        return {c: goal for c in over if sizes[c] > goal}

    def fit_resample(self, df: DataFrame, target: str, key: str) -> DataFrame:
        return _keep_first(df, target, key, self.goals(class_sizes(df, target)), self.seed)


class RandomUnderSampler:
    """Every class cut to the smallest one, with or without replacement."""

    def __init__(self, replacement: bool = False, seed: int = 0):
        self.replacement, self.seed = replacement, seed

    def fit_resample(self, df: DataFrame, target: str, key: str) -> DataFrame:
        sizes = class_sizes(df, target)
        least = min(sizes.values(), default=0)
        if not self.replacement:
            return _keep_first(df, target, key, {c: least for c in sizes}, self.seed)
        ranked = rank_by_hash(df, key, self.seed, [target], "_rank")
        draws = _draws(df, {c: (least, n) for c, n in sizes.items()}, target, self.seed)
        return draws.join(ranked, [target, "_rank"]).select(*df.columns)


def _uniform(*what) -> Column:
    """Reproducible number in [0, 1) from a hash of the arguments."""
    return hash_number(*what) / F.lit(float(1 << 52))


def _draws(df: DataFrame, wanted: dict[object, tuple[int, int]], target: str, seed: int) -> DataFrame:
    """(class, draw, rank): for each class (draws, size), ranks drawn with replacement."""
    spark, kind = df.sparkSession, df.schema[target].dataType
    parts = []
    for c, (n, size) in wanted.items():
        rank = F.floor(_uniform(F.lit(seed), F.lit(str(c)), F.col("id")) * size).cast("long") + 1
        parts.append(spark.range(n).select(F.lit(c).cast(kind).alias(target), F.col("id").alias("_draw"), rank.alias("_rank")))
    return reduce(DataFrame.unionByName, parts)


class SMOTE:
    """Grow every class to the largest one with points between a row and one of its k nearest of the same class.

    New rows get fresh keys above the largest one; ``synthetic`` tells them apart.
    """

    def __init__(self, k_neighbors: int = 5, seed: int = 0):
        self.k, self.seed = k_neighbors, seed

    def check(self, df: DataFrame, features: Sequence[str]) -> None:
        check_numeric_without_nulls(df, list(features))

    def wanted(self, sizes: dict[object, int]) -> dict[object, int]:
        most = max(sizes.values(), default=0)
        return {c: most - n for c, n in sizes.items() if n < most}

    def _search_space(self, df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, float]:
        """Rows with ``_x``, the vector that neighbours are searched in, and ``_codes``, whole numbers that cost the
        returned square distance each where they differ."""
        return df.withColumns({"_x": vector_of(features), "_codes": F.array().cast("array<long>")}), 0.0

    def _made(self, features: Sequence[str], u: Column) -> dict[str, Column]:
        return {c: F.col(c) + u * (F.col(f"_nb_{c}") - F.col(c)) for c in features}

    def fit_resample(
        self, df: DataFrame, target: str, key: str, features: Sequence[str], group: str | None = None,
        wanted: dict[object, int] | None = None,
    ) -> DataFrame:
        """``group`` restricts neighbours further (rows of one class and group); ``wanted`` counts new rows per group."""
        self.check(df, [c for c in features if c in self.numeric(features)])
        by = group or target
        sizes = class_sizes(df, by)
        new = wanted if wanted is not None else self.wanted(sizes)
        new = {c: n for c, n in new.items() if n > 0 and sizes.get(c, 0) > 1}
        base = df.select(key, target, *([group] if group else []), *features)
        if not new:
            return base.withColumn("synthetic", F.lit(False))
        rows = base.filter(F.col(by).isin(list(new)))
        near = self._neighbours(rows, by, key, features)
        seeds = rank_by_hash(rows, key, self.seed, [by], "_rank")
        draws = _draws(df, {c: (n, sizes[c]) for c, n in new.items()}, by, self.seed).join(seeds, [by, "_rank"])
        # A class may have fewer than k other members.
        available = near.groupBy(key).agg(F.max("nn").alias("_k"))
        pick = F.floor(_uniform(F.lit(self.seed + 1), F.col("_draw"), F.col(key)) * F.col("_k")).cast("int") + 1
        draws = draws.join(available, key).withColumn("nn", pick).join(near, [key, "nn"])
        others = rows.select(F.col(key).alias("neighbour"), *[F.col(c).alias(f"_nb_{c}") for c in features])
        u = _uniform(F.lit(self.seed + 2), F.col("_draw"), F.col(key))
        made = draws.join(others, "neighbour").withColumns(self._made(features, u))
        top = df.agg(F.max(key)).first()[0]
        # Draws are numbered within their class: an offset per class keeps the new keys apart.
        starts, at = {}, int(top) + 1
        for c, n in new.items():
            starts[c], at = at, at + n
        made = made.withColumn(key, (_per_class(by, starts) + F.col("_draw")).cast(df.schema[key].dataType))
        return base.withColumn("synthetic", F.lit(False)).unionByName(
            made.select(*base.columns).withColumn("synthetic", F.lit(True))
        )

    def numeric(self, features: Sequence[str]) -> list[str]:
        return list(features)

    def _neighbours(self, rows: DataFrame, by: str, key: str, features: Sequence[str]) -> DataFrame:
        """k nearest within the same class: one search, with classes moved apart along an extra axis."""
        space, mismatch = self._search_space(rows, features)
        edge = space.select(F.posexplode("_x").alias("_d", "_v")).groupBy("_d").agg((F.max("_v") - F.min("_v")).alias("_w"))
        most = edge.agg(F.sum(F.col("_w") * F.col("_w"))).first()[0] or 0.0
        span = math.sqrt(most + mismatch * (len(features) - len(self.numeric(features))))
        # Apart by more than any distance inside a class, even if nothing varies.
        codes = {c: i * (2 * span + 1) for i, c in enumerate(class_sizes(rows, by))}
        space = space.withColumn("_x", F.concat("_x", F.array(_per_class(by, codes, 0.0).cast("double"))))
        near = knn_join(space, space, self.k, key, key, "_x", exclude_self=True, codes="_codes", mismatch=mismatch)
        # A small class reaches into others, whose distance exceeds any inside a class.
        return near.filter(F.col("distance") <= span * (1 + 1e-9)).drop("carried").transform(written)


class SMOTENC(SMOTE):
    """SMOTE for mixed columns: a category mismatch costs as much as the median spread of the numbers, and a new
    row takes the most frequent category among the neighbours of its base row."""

    def __init__(self, categorical_features: Sequence[str], k_neighbors: int = 5, seed: int = 0):
        super().__init__(k_neighbors, seed)
        if not categorical_features:
            raise ValueError("categorical_features must name at least one column")
        self.categorical = list(categorical_features)

    def numeric(self, features):
        found = [c for c in features if c not in self.categorical]
        if set(self.categorical) - set(features):
            raise ValueError("categorical_features must be among the features")
        if not found:
            raise ValueError("SMOTENC needs at least one continuous feature")
        return found

    def _search_space(self, df, features):
        numbers = self.numeric(features)
        row = df.agg(*[F.stddev_pop(c).alias(c) for c in numbers]).first()
        spread = sorted(row[c] or 0.0 for c in numbers)
        half = (spread[len(spread) // 2] + spread[(len(spread) - 1) // 2]) / 4
        # Levels are compared by hash: two one-hot coordinates of height ``half`` would differ.
        codes = F.array(*[F.xxhash64(F.col(c).isNull(), F.col(c)) for c in self.categorical])
        return df.withColumns({"_x": vector_of(numbers), "_codes": codes}), 2 * half * half

    def _neighbours(self, rows, by, key, features):
        near = super()._neighbours(rows, by, key, features)
        others = rows.select(F.col(key).alias("neighbour"), *[F.col(c).alias(f"_mode_{c}") for c in self.categorical])
        modes = near.join(others, "neighbour").groupBy(key).agg(
            *[F.mode(f"_mode_{c}", deterministic=True).alias(f"_mode_{c}") for c in self.categorical]  # k values each
        )
        return near.join(modes, key)

    def _made(self, features, u):
        made = super()._made(self.numeric(features), u)
        return made | {c: F.col(f"_mode_{c}") for c in self.categorical}


def tomek_links(df: DataFrame, target: str, key: str, features: Sequence[str]) -> DataFrame:
    """Keys of rows in a pair of mutual nearest neighbours of different classes."""
    near = knn_join(df, df, 1, key, key, list(features), exclude_self=True).select(F.col(key).alias("a"), F.col("neighbour").alias("b"))
    mutual = near.join(near.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"])
    classes = df.select(F.col(key).alias("a"), F.col(target).alias("_ca"))
    others = df.select(F.col(key).alias("b"), F.col(target).alias("_cb"))
    return mutual.join(classes, "a").join(others, "b").filter(F.col("_ca") != F.col("_cb")).select(F.col("a").alias(key))


class SMOTETomek:
    """SMOTE, then both rows of every Tomek link removed."""

    def __init__(self, k_neighbors: int = 5, seed: int = 0):
        self.smote = SMOTE(k_neighbors, seed)

    def fit_resample(self, df: DataFrame, target: str, key: str, features: Sequence[str]) -> DataFrame:
        grown = self.smote.fit_resample(df, target, key, features).transform(written)
        return grown.join(tomek_links(grown, target, key, features), key, "left_anti")


class KMeansSMOTE:
    """SMOTE inside clusters where a class holds at least its balanced share; sparse clusters grow more.

    The spread of a cluster is its root mean square distance, which needs no pairs.
    """

    def __init__(self, k_neighbors: int = 2, n_clusters: int = 8, seed: int = 0):
        self.k, self.n_clusters, self.seed = k_neighbors, n_clusters, seed

    def fit_resample(self, df: DataFrame, target: str, key: str, features: Sequence[str]) -> DataFrame:
        check_numeric_without_nulls(df, list(features))
        rows = VectorAssembler(inputCols=list(features), outputCol="_v").transform(df)
        model = KMeans(featuresCol="_v", predictionCol="_cluster", k=self.n_clusters, seed=self.seed).fit(rows)
        rows = model.transform(rows).drop("_v").withColumn("_group", F.concat_ws("|", F.col(target).cast("string"), "_cluster"))
        stats = rows.groupBy("_group", target, "_cluster").agg(
            F.count(F.lit(1)).alias("n"), sum(F.var_pop(c) for c in features).alias("spread")
        )
        stats = stats.collect()  # classes x clusters rows
        sizes, whole = class_sizes(df, target), {}
        for r in stats:
            whole[r["_cluster"]] = whole.get(r["_cluster"], 0) + r["n"]
        total = sum(sizes.values())
        wanted: dict[object, int] = {}
        for c, missing in SMOTE().wanted(sizes).items():
            rich = [r for r in stats if r[target] == c and r["n"] > self.k and r["n"] / whole[r["_cluster"]] >= sizes[c] / total]
            if not rich:
                rich = [r for r in stats if r[target] == c and r["n"] > 1]
            logs = [len(features) * 0.5 * math.log(max(2 * r["spread"], 1e-12)) - 2 * math.log(r["n"]) for r in rich]
            shares = [math.exp(x - max(logs)) for x in logs]
            counts = [int(missing * s / sum(shares)) for s in shares]
            if counts:
                counts[0] += missing - sum(counts)
            wanted |= {r["_group"]: n for r, n in zip(rich, counts)}
        grown = SMOTE(self.k, self.seed).fit_resample(rows, target, key, features, "_group", wanted)
        return grown.drop("_group")


def resample_train(df: DataFrame, sampler, target: str, key: str, features: Sequence[str] | None = None) -> DataFrame:
    """Apply a sampler to the rows whose ``split`` is train; test rows stay as they are."""
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    args = (train, target, key) if features is None else (train, target, key, list(features))
    resampled = sampler.fit_resample(*args).withColumn("split", F.lit("train"))
    return resampled.select(*[c for c in df.columns if c in resampled.columns]).unionByName(
        test.select(*[c for c in df.columns if c in resampled.columns])
    )


def resampled_split(
    df: DataFrame, sampler, target: str, key: str, features: Sequence[str] | None = None, test_size: float = 0.25, seed: int = 0
) -> DataFrame:
    """Training-validation split, then the sampler on its train part."""
    return resample_train(training_validation_split(df, key, test_size, shuffle=True, seed=seed), sampler, target, key, features)


def resampled_folds(
    df: DataFrame, sampler, target: str, key: str, features: Sequence[str] | None = None, k: int = 3, seed: int = 0
) -> DataFrame:
    """Stratified folds in long form (``split_id``): each with its test fold and the resampled others."""
    folded = k_fold(df, key, k, [target], seed)
    out = []
    for i in range(k):
        role = F.when(F.col("fold") == i, "test").otherwise("train")
        one = resample_train(folded.withColumn("split", role).drop("fold"), sampler, target, key, features)
        out.append(one.withColumn("split_id", F.lit(i)))
    return reduce(DataFrame.unionByName, out)


__all__ = [
    "BalancedClassificationSampler", "RandomUnderSampler", "SMOTE", "SMOTENC", "SMOTETomek", "KMeansSMOTE",
    "class_sizes", "resample_train", "resampled_split", "resampled_folds", "split_by_key", "tomek_links",
]
