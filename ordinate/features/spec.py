"""Feature specifications: describe, fit, apply.

A specification is an immutable list of steps.  Fitting makes one aggregation for
all scalers and one distinct pass for all learned vocabularies.  Applying is a
projection, plus a join for each vocabulary or embedding table too large to be
written into the expression.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, types as T

from ordinate.features import steps as S
from ordinate.features.fit import learn
from ordinate.functions.selectors import Selector, parse_formula, resolve

# What a step's output counts as when selecting by type; None keeps
# the type of the column it came from.
STEP_TYPES = {
    S.Vocabulary: None, S.HashBucket: "string", S.Identity: None, S.Bucketized: "float",
    S.Crossed: "string", S.Indicator: "float", S.Embedding: "float",
}
COMBINERS = ("mean", "sqrtn", "sum")


def default_dimension(size: int) -> int:
    """Embedding width for a number of categories: their fourth root, rounded down."""
    return int(size ** 0.25 + 1e-9)


@dataclass(frozen=True, eq=False)
class FeatureSpec:
    data: DataFrame
    x: tuple[str, ...]
    y: str | None = None
    steps: tuple[S.Step, ...] = ()

    # -- what there is to select from

    def _schema(self) -> T.StructType:
        known = {c: self.data.schema[c].dataType.simpleString() for c in self.x}
        for step in self.steps:
            if isinstance(step, S.Remove):
                continue
            kind = step.dtype if isinstance(step, S.Numeric) else STEP_TYPES[type(step)]
            if kind is not None or step.name not in known:
                known[step.name] = kind or "string"
        ordered = [s.name for s in self.steps if not isinstance(s, S.Remove)]
        names = dict.fromkeys([*ordered, *self.x])
        return T.StructType.fromDDL(", ".join(f"`{n}` {known[n]}" for n in names))

    def feature_names(self) -> list[str]:
        return self._schema().names

    def feature_types(self) -> list[str]:
        return [f.dataType.simpleString() for f in self._schema().fields]

    def _with(self, made: Sequence[S.Step]) -> "FeatureSpec":
        return replace(self, steps=(*self.steps, *made))

    def _variables(self, terms, named: dict) -> list[tuple[str | None, str]]:
        """Pairs of (given name or None, column)."""
        pairs = [(None, c) for c in resolve(self._schema(), terms)] if terms else []
        for name, term in named.items():
            found = resolve(self._schema(), term)
            if isinstance(term, Selector) or len(found) != 1:
                raise ValueError("a name can be given to one column, not to a selection")
            pairs.append((name, found[0]))
        if not pairs:
            raise ValueError("no columns selected")
        return pairs

    def _columns(self, terms) -> list[str]:
        return [c for _, c in self._variables(terms, {})]

    # -- steps

    def step_numeric_column(
        self, *terms, shape: int = 1, default_value=None, dtype: str = "float",
        normalizer_fn: S.Scaler | Callable | None = None,
    ) -> "FeatureSpec":
        """Numbers, with missing ones filled, cast and scaled."""
        return self._with([S.Numeric(c, c, shape, default_value, dtype, normalizer_fn) for c in self._columns(terms)])

    def step_categorical_column_with_vocabulary_list(
        self, *terms, vocabulary_list: Sequence | None = None, default_value: int = -1, num_oov_buckets: int = 0
    ) -> "FeatureSpec":
        """Ids by place in a list; without one, the sorted distinct values are learned."""
        _one_way_out(default_value, num_oov_buckets)
        listed = None if vocabulary_list is None else tuple(vocabulary_list)
        return self._with([
            S.Vocabulary(c, c, listed, default_value, num_oov_buckets) for c in self._columns(terms)])

    def step_categorical_column_with_vocabulary_file(
        self, *terms, vocabulary_file: str, vocabulary_size: int | None = None,
        default_value: int | None = None, num_oov_buckets: int = 0,
    ) -> "FeatureSpec":
        """Ids by line in a text file, of which only the first ``vocabulary_size`` lines may count."""
        default_value = -1 if default_value is None else default_value
        _one_way_out(default_value, num_oov_buckets)
        return self._with([
            S.Vocabulary(c, c, None, default_value, num_oov_buckets, vocabulary_file, vocabulary_size)
            for c in self._columns(terms)])

    def step_categorical_column_with_hash_bucket(self, *terms, hash_bucket_size: int) -> "FeatureSpec":
        """Ids by hash of the value's text."""
        return self._with([S.HashBucket(c, c, int(hash_bucket_size)) for c in self._columns(terms)])

    def step_categorical_column_with_identity(
        self, *terms, num_buckets: int, default_value: int | None = None
    ) -> "FeatureSpec":
        """Integers that are ids already; outside ``[0, num_buckets)``: the default, or an error."""
        return self._with([S.Identity(c, c, int(num_buckets), default_value) for c in self._columns(terms)])

    def step_indicator_column(self, *terms, sparse: bool = False, **named) -> "FeatureSpec":
        """One-hot (for arrays: counts) of a step that gives ids."""
        made = []
        for name, c in self._variables(terms, named):
            self._ids_step(c)
            made.append(S.Indicator(name or f"indicator_{c}", c, sparse))
        return self._with(made)

    def step_embedding_column(
        self, *terms, dimension: int | Callable[[int], float] | None = None, combiner: str = "mean",
        max_norm: float | None = None, weights: DataFrame | None = None, **named,
    ) -> "FeatureSpec":
        """Vectors looked up in ``weights``, a table of ``id`` and ``vector``.

        Arrays of ids give the combined vector (mean, sum, or sum over the root of the
        count).  The default dimension is the fourth root of the number of ids.
        """
        _check_combiner(combiner)
        made = []
        for name, c in self._variables(terms, named):
            self._ids_step(c)
            made.append(S.Embedding(name or f"embedding_{c}", c, dimension, combiner, max_norm, weights))
        return self._with(made)

    def step_shared_embeddings_column(
        self, *columns: str, dimension: int | None = None, combiner: str = "mean",
        max_norm: float | None = None, weights: DataFrame | None = None, name: str | None = None,
    ) -> "FeatureSpec":
        """One table of vectors for several columns; each becomes ``<name>_<column>``."""
        _check_combiner(combiner)
        name = name or "shared_embeddings_" + "_".join(columns)
        sizes = {self._ids_step(c).name: c for c in columns}
        if len(sizes) < 2:
            raise ValueError("shared embeddings need at least two columns")
        return self._with([S.Embedding(f"{name}_{c}", c, dimension, combiner, max_norm, weights) for c in columns])

    def step_bucketized_column(self, *terms, boundaries: Sequence[float], **named) -> "FeatureSpec":
        """Bucket number of a numeric step: how many of the boundaries are not above it."""
        edges = tuple(boundaries)
        if not edges or list(edges) != sorted(set(edges)):
            raise ValueError("boundaries must be increasing")
        made = []
        for name, c in self._variables(terms, named):
            if not any(isinstance(s, S.Numeric) and s.name == c for s in self.steps):
                raise ValueError(f"{c!r} is not a numeric step")
            made.append(S.Bucketized(name or f"bucketized_{c}", c, edges))
        return self._with(made)

    def step_crossed_column(
        self, *crosses: Sequence[str], hash_bucket_size: int, hash_key: int | None = None, **named
    ) -> "FeatureSpec":
        """Ids by hash of a combination; each argument is a list of id steps or raw columns."""
        made = []
        for name, keys in [*((None, k) for k in crosses), *named.items()]:
            keys = tuple(resolve(self._schema(), keys))
            if len(keys) < 2:
                raise ValueError("a cross needs at least two columns")
            for k in keys:
                step = self._step(k)
                if isinstance(step, S.HashBucket):
                    raise ValueError(f"{k!r} is hashed already; cross its column instead")
                if isinstance(step, (S.Numeric, S.Indicator, S.Embedding)):
                    raise ValueError(f"{k!r} does not give ids; bucketize it first")
            made.append(S.Crossed(name or "crossed_" + "_".join(keys), keys, int(hash_bucket_size), hash_key))
        return self._with(made)

    def step_remove_column(self, *terms) -> "FeatureSpec":
        """Leave features out of the result; steps made from them stay."""
        present = {s.name for s in self.steps if not isinstance(s, S.Remove)}
        names = self._columns(terms)
        absent = [n for n in names if n not in present]
        if absent:
            raise ValueError(f"no features named {absent}")
        return self._with([S.Remove(n) for n in names])

    def _step(self, name: str) -> S.Step | None:
        return next((s for s in reversed(self.steps) if s.name == name and not isinstance(s, S.Remove)), None)

    def _ids_step(self, name: str) -> S.Step:
        step = self._step(name)
        if not isinstance(step, S.IDS):
            raise ValueError(f"{name!r} is not a step that gives ids")
        return step

    # -- fitting

    def fit(self, data: DataFrame | None = None) -> "FittedSpec":
        """Learn scalers and vocabularies from ``data`` (by default, the spec's own)."""
        from ordinate.features.transform import FittedSpec

        source = self.data if data is None else data
        return FittedSpec(self, learn(source, self.steps))

    def features(self):
        raise ValueError("only available after fitting")

    dense_features = features


def _one_way_out(default_value: int, num_oov_buckets: int) -> None:
    if num_oov_buckets < 0 or (num_oov_buckets and default_value != -1):
        raise ValueError("unknown values get either default_value or num_oov_buckets, not both")


def _check_combiner(combiner: str) -> None:
    if combiner not in COMBINERS:
        raise ValueError(f"combiner must be one of {COMBINERS}")


def feature_spec(data: DataFrame, x, y: str | None = None) -> FeatureSpec:
    """Open a specification on columns chosen by a formula, selectors or names."""
    if isinstance(x, str) and "~" in x:
        features, response = parse_formula(x, data.columns)
    else:
        features, response = resolve(data.schema, x), y
    if response is not None and response not in data.columns:
        raise ValueError(f"no column named {response!r}")
    return FeatureSpec(data, tuple(features), response)
