"""Exact k-nearest-neighbour join.

Equal rows are searched once: of equal training rows only the k with the smallest keys can be neighbours, and equal queries
share their answer. Training rows lie in the cells of a space partition (``kdtree``), a bounded number in each. A query is
first compared with the rows around it, its own cell or, if that has too few rows, the smallest subtree that has enough.
Their k-th distance limits the search: in the second step it goes to those regions (subtrees of a chunk of rows) that come as
near as that, and there meets the cells whose box does. Crowds of queries for one cell or region, and cells of equal rows with
many codes, are cut into chunks; a task holds one chunk of each side and emits at most k rows per query. Matrix products in
blocks of bounded memory find the rows that may be near enough, and only their distances are taken exactly. Where nothing can be
pruned (many dimensions) the number of products grows with the square of the rows, but a row moves once per region, not per cell.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gable.operators.kdtree import flat, grow, matrix, placed
from gable.operators.spread import lookup_join
from gable.operators.stages import FittedModel, FittedStage, with_state
from gable.runtime import written

#: Rows of a cell, and of a region or a chunk of queries, whichever meet in a task.
CELL_ROWS, CHUNK_ROWS = 4_000, 32_768
_BLOCK_CELLS = 2_000_000


def vector_of(cols: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in cols])


def nearest_rows(a: np.ndarray, b: np.ndarray, k: int, a_codes, b_codes, mismatch: float, limit: np.ndarray | None = None):
    """(query, row, distance) of the k nearest rows of b for each of a, ties to the earlier row; where limits are given, none
    beyond a query's limit."""
    out = []
    if not len(a) or not len(b):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    middle = b.mean(axis=0)
    side = b - middle
    norms = (side * side).sum(axis=1)
    side = np.vstack([-2 * side.T, norms])
    step = max(1, _BLOCK_CELLS // len(b))
    for i in range(0, len(a), step):
        x = a[i : i + step] - middle
        own = (x * x).sum(axis=1)
        # The square distance less the query's own norm, by one product; slack is more than its rounding error.
        rough = np.hstack([x, np.ones((len(x), 1))]) @ side
        slack = 8 * (a.shape[1] + 16) * np.finfo(float).eps * (own + norms.max())
        if a_codes.size:
            rough += mismatch * sum((x[:, None] != y).astype(float) for x, y in zip(a_codes[i : i + step].T, b_codes.T))
            slack += 8 * np.finfo(float).eps * mismatch * a_codes.shape[1]
        if limit is not None:
            most = limit[i : i + step] ** 2 - own + slack
        else:
            most = np.partition(rough, k - 1, axis=1)[:, k - 1] + 2 * slack if k < len(b) else np.full(len(x), np.inf)
        query, row = np.nonzero(~(rough > most[:, None]))  # so that an overflow is looked at
        square = np.zeros(len(query))
        for x, y in zip(a[i : i + step].T, b.T):
            gap = x[query] - y[row]
            square += gap * gap
        if a_codes.size:
            square += mismatch * (a_codes[i + query] != b_codes[row]).sum(axis=1)
        distance = np.sqrt(square)
        near = np.isfinite(distance) if limit is None else np.isfinite(distance) & (distance <= limit[i + query])
        out.append(_first(k, query[near] + i, row[near], distance[near]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _first(k: int, query: np.ndarray, row: np.ndarray, distance: np.ndarray):
    """The k nearest of each query, ties to the earlier row."""
    order = np.lexsort((row, distance, query))
    query, row, distance = query[order], row[order], distance[order]
    kept = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[kept], row[kept], distance[kept]


def _nearest_in_cells(a: np.ndarray, b: np.ndarray, k: int, a_codes, b_codes, mismatch: float, limit: np.ndarray, cell: np.ndarray):
    """As nearest_rows; a query is compared with the cells whose bounding box is within its limit."""
    order = np.argsort(cell, kind="stable")
    wide, out = limit * (1 + 1e-9) + 1e-12, []
    for mine in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
        low, high = b[mine].min(axis=0), b[mine].max(axis=0)
        away = np.zeros(len(a))
        for x, least, most in zip(a.T, low, high):
            gap = np.maximum(np.maximum(least - x, x - most), 0)
            away += gap * gap
        some = np.flatnonzero(away <= wide * wide)
        codes = (a_codes[some], b_codes[mine]) if a_codes.size else (a_codes, b_codes)
        query, row, distance = nearest_rows(a[some], b[mine], k, *codes, mismatch, limit[some])
        out.append((some[query], mine[row], distance))
    return _first(k, *(np.concatenate(c) for c in zip(*out)))


def _batches(batches, find):
    """(batch, rows, parts) of small batches: ``find`` names parts for rows of vectors and their limits."""
    for whole in batches:
        for start in range(0, whole.num_rows, 2000):
            b = whole.slice(start, 2000)
            yield b, *find(flat(b.column("vector")), b.column("limit").to_numpy(zero_copy_only=False))


def _visits(queries: DataFrame, find) -> tuple[DataFrame, DataFrame]:
    """queries, a row per part that ``find`` names for them, and the visits (part, n) of each part."""

    def run(batches):
        for b, row, part in _batches(batches, find):
            for i in range(0, len(row), 4000):
                columns = b.take(pa.array(row[i : i + 4000])).columns
                yield pa.RecordBatch.from_arrays([*columns, pa.array(part[i : i + 4000])], [*b.schema.names, "part"])

    def count(batches):
        for _, _, part in _batches(batches, find):
            found, n = np.unique(part, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["part", "n"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in queries.schema.fields)
    counted = queries.select("vector", "limit").mapInArrow(count, "part long, n long").groupBy("part").agg(F.sum("n").alias("n"))
    return queries.mapInArrow(run, f"{kept}, part long"), counted


def _chunked(sizes: dict[int, int], rows: int) -> Column:
    """Chunks of a part: 1 but for those with more than ``rows``, which are few (all rows / rows at most)."""
    many = {c: -(-n // rows) for c, n in sizes.items() if n > rows}
    if not many:
        return F.lit(1)
    known = F.create_map(*[F.lit(x) for pair in many.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.col("part").cast("int")), F.lit(1))


def _searched(queries: DataFrame, find, train: DataFrame, sizes: dict[int, int], k: int, chunk_rows: int, mismatch: float) -> DataFrame:
    """(id, neighbour, distance, carried): of every query the k nearest rows, within its limit, of each chunk of the parts found."""
    visits, counted = _visits(queries, find)
    visited = {r[0]: r[1] for r in counted.where(F.col("n") > chunk_rows).collect()}
    of_part, of_visits = _chunked(sizes, chunk_rows), _chunked(visited, chunk_rows)
    here = F.pmod(F.xxhash64("id"), F.lit(1 << 30)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = visits.withColumn("tc", every(of_part)).withColumn("qc", here % of_visits)
    right = train.withColumn("qc", every(of_visits)).withColumn("tc", here % of_part)

    def closest(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"id": [], "neighbour": [], "distance": [], "carried": []})
        b = b.sort_values("id")
        sides = (matrix(a["vector"]), matrix(b["vector"]), k, matrix(a["codes"]), matrix(b["codes"]), mismatch)
        limit = a["limit"].to_numpy(float)
        bounded = np.isfinite(limit).any()
        query, row, distance = _nearest_in_cells(*sides, limit, b["cell"].to_numpy()) if bounded else nearest_rows(*sides)
        ids = a["id"].to_numpy()[query], b["id"].to_numpy()[row]
        return pd.DataFrame({"id": ids[0], "neighbour": ids[1], "distance": distance, "carried": b["carried"].to_numpy()[row]})

    kinds = f"id {visits.schema['id'].dataType.simpleString()}, neighbour {train.schema['id'].dataType.simpleString()}"
    pairs = left.groupBy("part", "tc", "qc").cogroup(right.groupBy("part", "tc", "qc"))
    return pairs.applyInPandas(closest, f"{kinds}, distance double, carried double")


def _search(q: DataFrame, t: DataFrame, k: int, chunk_rows: int, cell_rows: int, mismatch: float) -> DataFrame:
    """(id, neighbour, distance, carried, nn) for queries (id, vector, codes) and written rows (id, vector, codes, carried)."""
    tree, sizes = grow(t, cell_rows)
    region, top = tree.regions(sizes, chunk_rows)
    rows = placed(t, tree, region).transform(written)
    homes = tree.homes(sizes, k)
    region_sizes: dict[int, int] = {}
    for c, n in sizes.items():
        region_sizes[int(region[c])] = region_sizes.get(int(region[c]), 0) + n

    def around(x, _):
        home = [homes[c] for c in tree.place(x).tolist()]
        return np.repeat(np.arange(len(x)), [len(h) for h in home]), np.array([c for h in home for c in h], np.int64)

    def within(x, limit):
        row, part = tree.within(x, limit * (1 + 1e-9) + 1e-12, top)
        some = np.isin(part, list(region_sizes))
        order = np.argsort(part[some], kind="stable")
        return row[some][order], part[some][order]

    search = lambda of, find, part, n: _searched(of, find, rows.withColumn("part", F.col(part)), n, k, chunk_rows, mismatch)
    first = search(q.withColumn("limit", F.lit(float("inf"))), around, "cell", sizes)
    # The home of a query has few cells, so its list of distances is short.
    nth = F.get(F.sort_array(F.collect_list("distance")), F.lit(k - 1))
    limits = first.groupBy("id").agg(nth.alias("limit"))
    limited = q.join(limits, "id", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf")))).transform(written)
    nn = F.row_number().over(Window.partitionBy("id").orderBy("distance", "neighbour"))
    return search(limited, within, "region", region_sizes).withColumn("nn", nn).filter(F.col("nn") <= k)


def _searchable(df: DataFrame, *cols: Column) -> DataFrame:
    """Rows with finite numbers only, as no others have a distance; ``_of`` makes equal rows easy to bring together."""
    rows = df.select(*cols).filter(F.forall("vector", lambda v: F.abs(v) < float("inf")))
    # Zero has one sign.
    return rows.withColumn("vector", F.transform("vector", lambda v: v + F.lit(0.0))).withColumn("_of", F.xxhash64("vector", "codes"))


def knn_join(
    queries: DataFrame,
    train: DataFrame,
    k: int,
    query_key: str,
    train_key: str,
    features: Sequence[str] | str,
    exclude_self: bool = False,
    chunk_rows: int = CHUNK_ROWS,
    cell_rows: int = CELL_ROWS,
    carry: str | None = None,
    codes: str | None = None,
    mismatch: float = 0.0,
) -> DataFrame:
    """(query_key, neighbour, distance, carried, nn): the k nearest train rows, ties to the smaller key.

    ``features`` is a list of numeric columns or the name of one array column. Keys must be unique. ``carry``
    names a numeric train column that comes along as ``carried``, so that no join has to fetch it. ``codes`` names a
    column with an array of whole numbers that are compared for equality: each that differs adds ``mismatch`` to the square
    of the distance.
    """
    vector = F.col(features).cast("array<double>") if isinstance(features, str) else vector_of(features)
    code = F.col(codes).cast("array<long>") if codes else F.array().cast("array<long>")
    payload = F.col(carry).cast("double") if carry else F.lit(0.0)
    q = _searchable(queries, F.col(query_key).alias("id"), vector.alias("vector"), code.alias("codes"))
    t = _searchable(train, F.col(train_key).alias("id"), vector.alias("vector"), code.alias("codes"), payload.alias("carried"))
    # Rows are read several times below; writing them once cuts off whatever produced them.
    q = q.transform(written)
    same, most = ["_of", "vector", "codes"], k + int(exclude_self)
    # Spark keeps the first rows of a group before it shuffles them, so a frequent row is no burden.
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("id"))
    t = t.withColumn("_nth", nth).filter(F.col("_nth") <= most).drop("_nth", "_of").transform(written)
    kinds = q.groupBy(*same).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("_n")).transform(written)
    found = _search(kinds.select(F.col("first").alias("id"), "vector", "codes"), t, most, chunk_rows, cell_rows, mismatch)
    near = F.sort_array(F.collect_list(F.struct("distance", "neighbour", "carried"))).alias("near")
    answers = kinds.join(found.groupBy(F.col("id").alias("first")).agg(near), "first").drop("first")
    mine = F.filter("near", lambda n: n["neighbour"] != F.col("id")) if exclude_self else F.col("near")
    of = lookup_join(q, answers, same, "inner", weight="_n").select("id", F.slice(mine, 1, k).alias("near"))
    out = of.select("id", F.posexplode("near").alias("nn", "_near"))
    return out.select(
        F.col("id").alias(query_key), "_near.neighbour", "_near.distance", "_near.carried", (F.col("nn") + 1).alias("nn")
    )


_KNN = {
    "features": [],
    "label": None,
    "key": "unit_indx",
    "n_neighbors": 5,
    "weights": "distance",
    "prediction": "prediction",
    "chunk_rows": CHUNK_ROWS,
}


class KNeighborsRegressorModel(FittedModel):
    """Keeps the training rows as a DataFrame; prediction is a kNN join."""

    DEFAULTS = with_state(_KNN)

    def __init__(self, train: DataFrame | None = None, **options):
        super().__init__(**options)
        self.train = train

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key, k = self.opt("key"), self.opt("n_neighbors")
        near = knn_join(
            dataset, self.train, k, key, key, self.opt("features"), chunk_rows=self.opt("chunk_rows"), carry=self.opt("label")
        ).withColumnRenamed("carried", "_y")
        if self.opt("weights") == "uniform":
            value = F.avg("_y")
        else:
            # Rows at distance zero, if any, decide alone.
            exact = F.avg(F.when(F.col("distance") == 0, F.col("_y")))
            inverse = F.try_divide(F.lit(1.0), F.col("distance"))
            value = F.coalesce(exact, F.sum(F.col("_y") * inverse) / F.sum(inverse))
        predicted = near.groupBy(key).agg(value.alias(self.opt("prediction")))
        return dataset.join(predicted, key, "left")

    def write(self) -> MLWriter:
        return _TrainWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TrainReader(cls)


class _TrainWriter(DefaultParamsWriter):
    """Saves the training rows next to the stage."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.train.write.parquet(f"{path}/train")


class _TrainReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        model.train = self.sparkSession.read.parquet(f"{path}/train")
        return model


class KNeighborsRegressor(FittedStage):
    """Inverse-distance (or plain) mean of the k nearest training rows."""

    DEFAULTS = _KNN
    MODEL = KNeighborsRegressorModel

    def __init__(self, **options):
        super().__init__(**options)
        if self.opt("weights") not in ("distance", "uniform"):
            raise ValueError("weights must be 'distance' or 'uniform'")

    def _fit(self, dataset: DataFrame) -> KNeighborsRegressorModel:
        kept = [self.opt("key"), *([self.opt("features")] if isinstance(self.opt("features"), str) else self.opt("features"))]
        train = dataset.select(*kept, self.opt("label"))
        return KNeighborsRegressorModel(train=train, **self.options(), state={"fitted": True})
