"""Base classes of the Spark ML stages: options and fitted state are Params, so stages save and load."""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame
from pyspark.sql import types as T


class Options(Params, DefaultParamsReadable, DefaultParamsWritable):
    """Params declared by a ``DEFAULTS`` dictionary; values must be JSON-friendly."""

    DEFAULTS: dict[str, object] = {}

    def __init__(self, **options):
        super().__init__()
        for name, default in self.DEFAULTS.items():
            setattr(self, name, Param(self, name, name.replace("_", " ")))
            self._setDefault(**{name: default})
        unknown = set(options) - set(self.DEFAULTS)
        if unknown:
            raise TypeError(f"unknown options: {sorted(unknown)}")
        self._set(**options)

    def opt(self, name: str):
        return self.getOrDefault(name)

    def options(self) -> dict[str, object]:
        return {n: self.opt(n) for n in self.DEFAULTS}


class ExpressionTransformer(Options, Transformer):
    """A stage without fitted state."""

    def provenance(self) -> dict[str, list[str]]:
        """Source column -> columns derived from it."""
        return {}


class FittedModel(Options, Model):
    """A fitted stage; ``state`` holds what was learned."""

    def provenance(self) -> dict[str, list[str]]:
        return {}

    @property
    def learned(self):
        return self.opt("state")


class FittedStage(Options, Estimator):
    """An estimator whose model takes the same options plus ``state``."""

    MODEL: type[FittedModel]

    def learn(self, df: DataFrame):
        raise NotImplementedError

    def _fit(self, dataset: DataFrame) -> FittedModel:
        return self.MODEL(**self.options(), state=self.learn(dataset))


class _PartsWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        for i, part in enumerate(self.instance.parts):
            part.write().save(f"{path}/parts/{i}")


class _PartsReader(DefaultParamsReader):
    def load(self, path: str):
        found = super().load(path)
        found.parts = [DefaultParamsReader.loadParamsInstance(f"{path}/parts/{i}", self.sparkSession) for i in range(found.n_parts())]
        return found


class WithParts:
    """Stages inside a stage: ``parts`` are saved below it, loaded, and copied with it. ``n_parts`` tells their number from the options."""

    parts: list = []

    def n_parts(self) -> int:
        raise NotImplementedError

    def copy(self, extra=None):
        that = super().copy(extra)
        that.parts = [part.copy(extra) for part in self.parts]
        return that

    def write(self) -> DefaultParamsWriter:
        return _PartsWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _PartsReader(cls)


class _TableWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.table.write.parquet(f"{path}/table")


class _TableReader(DefaultParamsReader):
    def load(self, path: str):
        found = super().load(path)
        found.table = self.sparkSession.read.parquet(f"{path}/table")
        return found


class WithTable:
    """A fitted stage whose state is a distributed ``table``, saved as parquet next to its options."""

    table: DataFrame | None = None

    def write(self) -> DefaultParamsWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _TableReader(cls)


def one_of(stage, **allowed) -> None:
    """Check options of a stage (or any dict of options) against the values they may take."""
    for option, values in allowed.items():
        chosen = stage.opt(option)
        for value in chosen if isinstance(chosen, (list, tuple)) else [chosen]:
            if value not in values:
                raise ValueError(f"option {option} of {type(stage).__name__}: {value!r} is none of {list(values)}")


def with_state(defaults: dict[str, object]) -> dict[str, object]:
    return {**defaults, "state": {}}


def columns_of(df: DataFrame, *kinds: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.NumericType)


def time_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.TimestampType, T.TimestampNTZType, T.DateType)
