"""The steps of a feature specification, as plain descriptions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame


@dataclass(frozen=True)
class Scaler:
    """Learned from the data when the specification is fitted."""

    kind: str


def scaler_standard() -> Scaler:
    """``(x - mean) / sample standard deviation``; null where that deviation is 0 or unknown."""
    return Scaler("standard")


def scaler_min_max() -> Scaler:
    """``(x - min) / (max - min)``; null where both are equal."""
    return Scaler("min_max")


@dataclass(frozen=True)
class Step:
    name: str


@dataclass(frozen=True)
class Numeric(Step):
    key: str
    shape: int = 1
    default_value: float | None = None
    dtype: str = "float"
    normalizer_fn: Scaler | Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class Categorical(Step):
    key: str


@dataclass(frozen=True)
class Vocabulary(Categorical):
    vocabulary: tuple | None = None
    default_value: int = -1
    num_oov_buckets: int = 0
    file: str | None = None
    file_size: int | None = None


@dataclass(frozen=True)
class HashBucket(Categorical):
    buckets: int = 1


@dataclass(frozen=True)
class Identity(Categorical):
    buckets: int = 1
    default_value: int | None = None


@dataclass(frozen=True)
class Bucketized(Step):
    source: str
    boundaries: tuple[float, ...]


@dataclass(frozen=True)
class Crossed(Step):
    keys: tuple[str, ...]
    buckets: int
    hash_key: int | None = None


@dataclass(frozen=True)
class Indicator(Step):
    source: str
    sparse: bool = False


@dataclass(frozen=True, eq=False)
class Embedding(Step):
    source: str
    dimension: int | Callable[[int], float] | None = None
    combiner: str = "mean"
    max_norm: float | None = None
    weights: DataFrame | None = None


@dataclass(frozen=True)
class Remove(Step):
    pass


#: steps whose output goes into the dense feature array
DENSE = (Numeric, Bucketized, Indicator, Embedding)
#: steps whose output is an id
IDS = (Categorical, Bucketized, Crossed)
