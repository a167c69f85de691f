"""Scaling, principal components and linear discriminants."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gable.operators.profile import null_shares
from gable.operators.stages import FittedModel, FittedStage, numeric_columns, with_state


def spread_array(df: DataFrame, col: str, size: int, prefix: str) -> DataFrame:
    """Elements of an array as columns ``<prefix>0..``."""
    return df.withColumns({f"{prefix}{i}": F.col(col)[i].cast("double") for i in range(size)}).drop(col)


class StandardScalerModel(FittedModel):
    DEFAULTS = with_state({"columns": None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        made = {c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self.learned.items()}
        return dataset.withColumns(made) if made else dataset

    def provenance(self):
        return {c: [c] for c in self.learned}


class StandardScaler(FittedStage):
    """(x - mean) / population standard deviation; a constant column is only centred."""

    DEFAULTS = {"columns": None}
    MODEL = StandardScalerModel

    def learn(self, df):
        cols = self.opt("columns") or numeric_columns(df)
        aggs = [f(c).alias(f"{n}{c}") for c in cols for n, f in (("m_", F.avg), ("s_", F.stddev_pop))]
        row = df.agg(*aggs).first()
        return {c: [row[f"m_{c}"], row[f"s_{c}"] or 1.0] for c in cols}


def check_numeric_without_nulls(df: DataFrame, cols: list[str]) -> None:
    other = set(cols) - set(numeric_columns(df))
    if other:
        raise ValueError(f"all columns must be numeric: {sorted(other)}")
    if any(s > 0 for s in null_shares(df, cols).values()):
        raise ValueError("columns must not contain missing values")


def _covariance(df: DataFrame, cols: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Row count, mean and sample covariance: a tree aggregate, d x d numbers on the driver."""
    vectors = VectorAssembler(inputCols=cols, outputCol="_v").transform(df).select("_v")
    mean = vectors.select(Summarizer.metrics("count", "mean").summary(F.col("_v")).alias("s")).select("s.*").first()
    matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "_v"))
    return mean["count"], mean["mean"].toArray(), matrix.computeCovariance().toArray()


def _signed(components: np.ndarray) -> np.ndarray:
    """Fix the free sign: the largest loading of each component is positive."""
    top = np.abs(components).argmax(axis=0)
    return components * np.sign(components[top, range(components.shape[1])])


class ProjectionModel(FittedModel):
    """Centre and project; outputs ``component_i`` in place of the input columns."""

    DEFAULTS = with_state({})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols, mean, matrix = self.learned["columns"], self.learned["mean"], self.learned["components"]
        # Built as expression text: one call per component instead of one per matrix element.
        centred = ", ".join(f"CAST(`{c}` AS DOUBLE) - {m!r}D" for c, m in zip(cols, mean))
        rows = dataset.withColumn("_centred", F.expr(f"array({centred})"))
        made = {f"component_{i}": _dot("_centred", weights) for i, weights in enumerate(matrix)}
        return rows.withColumns(made).drop("_centred", *cols)

    def provenance(self):
        names = [f"component_{i}" for i in range(len(self.learned["components"]))]
        return {c: names for c in self.learned["columns"]}


def _dot(values: str, weights: list[float]) -> Column:
    literal = ", ".join(f"{float(w)!r}D" for w in weights)
    return F.expr(f"aggregate(zip_with({values}, array({literal}), (a, b) -> a * b), 0.0D, (acc, x) -> acc + x)")


class PCA(FittedStage):
    """Components of the centred columns: a given number, or the fewest that reach a share of the variance."""

    DEFAULTS = {"variance": 0.95, "n_components": None, "columns": None}

    def _fit(self, dataset):
        cols = self.opt("columns") or numeric_columns(dataset)
        check_numeric_without_nulls(dataset, cols)
        _, mean, cov = _covariance(dataset, cols)
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1].clip(min=0), vectors[:, ::-1]
        ratio = values / values.sum() if values.sum() else values
        k = self.opt("n_components")
        if k is None:
            k = int(np.searchsorted(np.cumsum(ratio), self.opt("variance")) + 1)
        k = min(k, len(cols))
        state = {
            "columns": cols,
            "mean": mean.tolist(),
            "components": _signed(vectors[:, :k]).T.tolist(),
            "explained_variance_ratio": ratio[:k].tolist(),
        }
        return ProjectionModel(state=state)


class LinearDiscriminantAnalysis(FittedStage):
    """Directions that separate classes most, from per-class means and the total covariance."""

    DEFAULTS = {"n_components": None, "target": None, "columns": None}

    def _fit(self, dataset):
        y = self.opt("target")
        cols = self.opt("columns") or [c for c in numeric_columns(dataset) if c != y]
        check_numeric_without_nulls(dataset, cols)
        vectors = VectorAssembler(inputCols=cols, outputCol="_v").transform(dataset)
        # One mean vector per class reaches the driver.
        groups = (
            vectors.groupBy(y)
            .agg(Summarizer.metrics("count", "mean").summary(F.col("_v")).alias("s"))
            .select("s.count", vector_to_array("s.mean").alias("mean"))
            .collect()
        )
        most = min(len(groups) - 1, len(cols))
        k = self.opt("n_components")
        if k is not None and k > min(len(groups), len(cols)):
            raise ValueError(f"{k} components asked for, but only {min(len(groups), len(cols))} can exist")
        k = min(k or most, most)
        n, mean, cov = _covariance(dataset, cols)
        means = np.array([g["mean"] for g in groups])
        counts = np.array([g["count"] for g in groups], dtype=float)
        gaps = means - mean
        between = (gaps * counts[:, None]).T @ gaps / n
        within = cov * (n - 1) / n - between
        values, vectors_ = np.linalg.eig(np.linalg.pinv(within) @ between)
        order = np.argsort(values.real)[::-1][:k]
        directions = vectors_[:, order].real
        # Scale to unit within-class variance, as a discriminant axis is usually reported.
        directions = directions / np.sqrt(np.einsum("ij,ik,kj->j", directions, within, directions))
        state = {"columns": cols, "mean": mean.tolist(), "components": _signed(directions).T.tolist()}
        return ProjectionModel(state=state)
