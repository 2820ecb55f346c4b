"""Applying a fitted specification."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ordinate.features import held, steps as S
from ordinate.features.fit import Learned
from ordinate.features.spec import FeatureSpec, default_dimension
from ordinate.functions.hashing import hash_bucket, parts_text


@dataclass(frozen=True, eq=False)
class FittedSpec:
    spec: FeatureSpec
    learned: Learned

    # -- metadata

    def fit(self, data=None):
        raise ValueError("already fitted")

    def features(self) -> dict[str, S.Step]:
        """The features in order, after removals."""
        found: dict[str, S.Step] = {}
        for step in self.spec.steps:
            if isinstance(step, S.Remove):
                found.pop(step.name, None)
            else:
                found[step.name] = step
        return found

    def dense_features(self) -> dict[str, S.Step]:
        return {n: s for n, s in self.features().items() if isinstance(s, S.DENSE)}

    def feature_names(self) -> list[str]:
        return self.spec.feature_names()

    def size(self, name: str) -> int:
        """Number of ids that a step gives."""
        step = self.spec._ids_step(name)
        if isinstance(step, S.Vocabulary):
            return self.learned.vocabularies[name].size + step.num_oov_buckets
        if isinstance(step, S.Bucketized):
            return len(step.boundaries) + 1
        return step.buckets

    def dimension(self, step: S.Embedding) -> int:
        if callable(step.dimension):
            return int(step.dimension(self.size(step.source)))
        return default_dimension(self.size(step.source)) if step.dimension is None else int(step.dimension)

    # -- applying

    def transform(
        self, df: DataFrame, keep: Sequence[str] = (), dense: bool = False
    ) -> DataFrame:
        """Columns ``x`` (a struct of all features, or one array if ``dense``) and ``y``.

        ``keep`` adds input columns.  Vocabularies and embeddings of any size are joined.  A digest stands for each
        different array; its items travel with that, never with the array, and each different one is looked up once.
        Arrays of ids that need no vocabulary are looked up in their rows, without a shuffle, if the vectors that they can
        reach have up to 64 MB, no repeated ids and no null numbers.  A join takes an aggregate, so on a stream arrays are looked up in tables of up to 64 MB that workers hold;
        larger ones are an error that names ``per_micro_batch``, where there is no bound.
        """
        out = df
        made: dict[str, Column] = {}
        features = self.features()
        wanted = set(features if not dense else self.dense_features())
        needed = self._needed(wanted)
        for step in self.spec.steps:  # later steps refer to the columns of earlier ones
            if isinstance(step, S.Remove) or step.name not in needed:
                continue
            column = f"__f_{step.name}"
            if isinstance(step, S.Embedding):
                out = self._embedded(out, step, column)
            elif isinstance(step, S.Vocabulary):
                out = self._joined(out, step, column)
            elif isinstance(step, S.Indicator) and self._is_array(df, step.source):
                counted = _with_counts(out, F.col(f"`__f_{step.source}`"), "__counts", self.size(step.source))
                out = counted.withColumn(column, _multi_hot(F.col("__counts"), self.size(step.source), step.sparse)).drop("__counts")
            else:
                out = out.withColumn(column, self._expression(df, step))
            made[step.name] = F.col(f"`{column}`")
        kept = [F.col(f"`{c}`") for c in keep]
        if dense:
            for n, s in self.dense_features().items():
                if isinstance(s, S.Bucketized) and self._is_array(df, n):
                    out = _with_counts(out, F.col(f"`__f_{n}`"), f"__n_{n}", self.size(n))
            parts = [self._dense(out, n, s) for n, s in self.dense_features().items()]
            x = F.concat(*parts)
        else:
            x = F.struct(*[made[n].alias(n) for n in features])
        y = [F.col(f"`{self.spec.y}`").alias("y")] if self.spec.y is not None and self.spec.y in df.columns else []
        return out.select(*kept, x.alias("x"), *y)

    def _needed(self, wanted: set[str]) -> set[str]:
        needed = set(wanted)
        for step in reversed(self.spec.steps):
            if isinstance(step, S.Remove) or step.name not in needed:
                continue
            if isinstance(step, (S.Bucketized, S.Indicator, S.Embedding)):
                needed.add(step.source)
            elif isinstance(step, S.Crossed):
                needed.update(k for k in step.keys if self.spec._step(k) is not None)
        return needed

    def _expression(self, df: DataFrame, step: S.Step) -> Column:
        if isinstance(step, S.Numeric):
            return self._numeric(df, step)
        if isinstance(step, S.Categorical):
            return _each(df, step.key, lambda v: self._id(step, v))
        if isinstance(step, S.Bucketized):
            return _each_value(F.col(f"`__f_{step.source}`"), self._is_array(df, step.source), lambda v: _bucket(v, step.boundaries))
        if isinstance(step, S.Crossed):
            parts = [F.col(f"`__f_{k}`") if self.spec._step(k) is not None else F.col(f"`{k}`") for k in step.keys]
            whole = parts_text(*([F.lit(step.hash_key)] if step.hash_key is not None else []), *parts)
            absent = [p.isNull() for p in parts]
            missing = absent[0]
            for a in absent[1:]:
                missing = missing | a
            return F.when(~missing, hash_bucket(whole, step.buckets))
        return _one_hot(F.col(f"`__f_{step.source}`"), self.size(step.source), step.sparse)

    def _is_array(self, df: DataFrame, name: str) -> bool:
        step = self.spec._step(name)
        if isinstance(step, (S.Categorical, S.Numeric)):
            return isinstance(df.schema[step.key].dataType, T.ArrayType)
        return isinstance(step, S.Bucketized) and self._is_array(df, step.source)

    def _numeric(self, df: DataFrame, step: S.Numeric) -> Column:
        def one(value: Column) -> Column:
            if step.default_value is not None:
                value = F.coalesce(value, F.lit(step.default_value))
            if isinstance(step.normalizer_fn, S.Scaler):
                shift, divisor = self.learned.scales[step.name]
                value = (value.cast("double") - F.lit(shift).cast("double")) / F.lit(divisor).cast("double")
                return value
            value = value.cast(step.dtype)
            return step.normalizer_fn(value) if step.normalizer_fn else value

        value = F.col(f"`{step.key}`")
        if not isinstance(df.schema[step.key].dataType, T.ArrayType):
            return one(value)
        right_size = F.when(F.size(value) == step.shape, value).otherwise(
            F.raise_error(F.lit(f"column {step.key} must hold {step.shape} numbers in each row")))
        return F.transform(right_size, one)

    def _id(self, step: S.Categorical, value: Column) -> Column:
        if isinstance(step, S.HashBucket):
            return hash_bucket(value, step.buckets)
        if isinstance(step, S.Identity):
            number = value.cast("bigint")
            other = F.raise_error(F.concat(F.lit(f"column {step.key} is outside [0, {step.buckets}): "), number.cast("string"))
                                  ).cast("bigint") if step.default_value is None else F.lit(step.default_value).cast("bigint")
            return F.when(number.isNull(), F.lit(None)).when(number.between(0, step.buckets - 1), number).otherwise(other)
        raise TypeError(f"{step.name} is joined")

    def _joined(self, df: DataFrame, step: S.Vocabulary, column: str) -> DataFrame:
        """Ids by joining the vocabulary; rows of a common value, or null, are spread by Spark's skew handling."""
        vocab = self.learned.vocabularies[step.name]
        table = vocab.table.select(F.col("value").alias("__value"), F.col("id").alias("__id"))
        key = F.col(f"`{step.key}`")
        if not isinstance(df.schema[step.key].dataType, T.ArrayType):
            text = key.cast("string")
            found = df.join(table, text == F.col("__value"), "left")
            return found.withColumn(column, _or_unknown(F.col("__id"), text, step, vocab.size)).drop("__id", "__value")
        if df.isStreaming:
            texts = F.transform(key, lambda v: v.cast("string"))
            found = held.places(vocab.table.select("value", F.col("id").cast("bigint").alias("id")), step.name)
            out = df.withColumn("__texts", texts).withColumn("__places", found(F.col("__texts")))
            ids = F.zip_with("__places", "__texts", lambda place, text: _or_unknown(place, text, step, vocab.size))
            return out.withColumn(column, ids).drop("__texts", "__places")
        # arrays are narrower than their items, which then lie where they are put together again, unless the join moves them
        narrow = _narrow(df, key).groupBy("__digest").agg(F.first("__array").alias("__array"))
        # (outer, as the optimizer would else compute arrays twice, to leave out empty ones before they are split)
        items = narrow.select("__digest", F.posexplode_outer("__array").alias("__pos", "__item")).where("__pos is not null")
        items = items.select("__digest", "__pos", F.col("__item").cast("string").alias("__text"))
        items = items.join(table, F.col("__text") == F.col("__value"), "left")
        ids = _or_unknown(F.col("__id"), F.col("__text"), step, vocab.size)
        gathered = F.sort_array(F.collect_list(F.struct("__pos", ids.alias("id"))))
        rows = items.groupBy("__digest").agg(gathered.getField("id").alias(column))
        # after the join only whether there was an array counts, so that arrays do not go through it
        out = df.withColumn("__digest", _digest(key)).withColumn("__there", key.isNotNull()).join(rows, "__digest", "left")
        ids = F.when(F.col("__there"), F.coalesce(F.col(f"`{column}`"), F.array().cast("array<bigint>")))
        return out.withColumn(column, ids).drop("__digest", "__there")

    def _embedded(self, df: DataFrame, step: S.Embedding, column: str) -> DataFrame:
        if step.weights is None:
            raise ValueError(f"{step.name} needs weights: a table of id and vector")
        d = self.dimension(step)
        vector = F.transform("vector", lambda v: v.cast("double"))
        vector = F.when(F.size(vector) == d, vector).otherwise(F.raise_error(F.lit(f"{step.name} needs vectors of {d} numbers")))
        table = step.weights.select(F.col("id").cast("bigint").alias("__id"), _clipped(vector, step.max_norm).alias("__vector"))
        table = table.where("__id >= 0")
        table, small = (table, False) if df.isStreaming else self._reachable(table, step, d)
        zeros = F.array_repeat(F.lit(0.0), d)
        ids = F.col(f"`__f_{step.source}`")
        if not isinstance(df.schema[f"__f_{step.source}"].dataType, T.ArrayType):
            # only ids that can be in a table take part
            found = df.join(table, F.when(ids >= 0, ids.cast("bigint")) == F.col("__id"), "left")
            return found.withColumn(column, F.coalesce("__vector", zeros)).drop("__id", "__vector")
        weights = table.select(F.col("__id").alias("id"), F.col("__vector").alias("vector"))
        found = None
        if df.isStreaming:
            found = held.combined(weights, step.name, d, step.combiner)
        elif small and not isinstance(self.spec._ids_step(step.source), S.Vocabulary):
            # ids that their row alone gives: computed once, and looked up there; only those of a vocabulary come from a shuffle
            found = held.combined_if_plain(weights, d, step.combiner)
        if found is not None:
            return df.withColumn(column, found(ids.cast("array<bigint>")))
        # equal ids of an array are counted in its row, before vectors join: one row for each, not for each item
        # (outer as above)
        items = _with_counts(_narrow(df, ids), F.col("__array"), "__counts").select("__digest", F.inline_outer("__counts"))
        items = items.where("id is not null").distinct().join(table, F.col("id") == F.col("__id"))
        # one partial sum per dimension: no list of vectors is ever gathered
        sums = [F.sum(F.get("__vector", F.lit(i)) * F.col("times")).alias(f"__s{i}") for i in range(d)]
        rows = items.groupBy("__digest").agg(F.sum("times").alias("__n"), *sums)
        divisor = {"sum": F.lit(1.0), "mean": F.col("__n").cast("double"), "sqrtn": F.sqrt(F.col("__n"))}[step.combiner]
        combined = rows.select("__digest", F.array(*[F.col(f"__s{i}") / divisor for i in range(d)]).alias(column))
        out = df.withColumn("__digest", _digest(ids)).join(combined, "__digest", "left").drop("__digest")
        return out.withColumn(column, F.coalesce(F.col(f"`{column}`"), zeros))

    def _reachable(self, table: DataFrame, step: S.Embedding, d: int) -> tuple[DataFrame, bool]:
        """The vectors of ids that the step's source can give, and whether they are small; every task gets them all then.

        So no rows are dealt out by id: one that most rows have would be one task's work, too few bytes for Spark to split.
        Tables that stay larger are joined by shuffling.
        """
        source = self.spec._ids_step(step.source)
        default = getattr(source, "default_value", None)
        near = table.where(F.col("__id") < max(self.size(step.source), -1 if default is None else default + 1))
        small = near.count() * 8 * (d + 4) <= held.MOST_BYTES
        return F.broadcast(near) if small else near, small

    def _dense(self, out: DataFrame, name: str, step: S.Step) -> Column:
        value = F.col(f"`__f_{name}`")
        if isinstance(step, S.Bucketized):
            many = isinstance(out.schema[f"__f_{name}"].dataType, T.ArrayType)
            return _multi_hot(F.col(f"`__n_{name}`"), self.size(name)) if many else _one_hot(value, self.size(name))
        if isinstance(step, S.Indicator) and step.sparse:
            raise ValueError(f"{name} is sparse and cannot be part of a dense array")
        if isinstance(out.schema[f"__f_{name}"].dataType, T.ArrayType):
            return value.cast("array<double>")
        return F.array(value.cast("double"))


def _digest(array: Column) -> Column:
    """What stands for an array in shuffles: 16 bytes."""
    return F.unhex(F.md5(F.to_json(F.struct(array.alias("a")))))


def _narrow(df: DataFrame, array: Column) -> DataFrame:
    """The arrays, as ``__array``, with their digests."""
    return df.select(_digest(array).alias("__digest"), array.alias("__array"))


def _with_counts(df: DataFrame, ids: Column, name: str, size: int | None = None) -> DataFrame:
    """Add the different ids of an array from 0 up to ``size``, in order, as ``(id, times)``.

    One sort of the array, one pass for where a new id begins, and one for the distances between.  No lambda refers to
    anything but its own arguments: wherever the optimizer moves these expressions to, none is computed once for each item.
    """
    inside = lambda i: (i >= 0) & (i < size) if size is not None else i >= 0
    there = F.filter(F.coalesce(ids, F.array().cast("array<bigint>")), inside)
    out = df.withColumn("__sorted", F.sort_array(there).cast("array<bigint>"))
    ordered = F.col("__sorted")
    pairs = F.zip_with(ordered, _shifted(ordered, F.lit(None).cast("bigint")), lambda x, before: F.struct(x.alias("id"), before.alias("before")))
    marked = F.transform(pairs, lambda p, i: F.when(~p["id"].eqNullSafe(p["before"]), F.struct(p["id"].alias("id"), i.alias("at"))))
    out = out.withColumn("__starts", F.filter(marked, lambda s: s.isNotNull()))
    starts = F.col("__starts")
    stops = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.struct(F.lit(None).cast("bigint").alias("id"), F.size(ordered).alias("at"))))
    counts = F.zip_with(starts, stops, lambda s, stop: F.struct(s["id"].alias("id"), (stop["at"] - s["at"]).alias("times")))
    return out.withColumn(name, F.filter(counts, lambda c: c["id"].isNotNull())).drop("__sorted", "__starts")


def _shifted(array: Column, first: Column) -> Column:
    """The items one place further on, ``first`` at the start."""
    return F.concat(F.array(first), F.slice(array, 1, F.greatest(F.size(array) - 1, F.lit(0))))


def _multi_hot(counts: Column, size: int, sparse: bool = False) -> Column:
    """How often each id occurs, from the ``(id, times)`` that do."""
    if sparse:
        return F.struct(F.lit(size).alias("size"), F.transform(counts, lambda c: c["id"].cast("int")).alias("indices"),
                        F.transform(counts, lambda c: c["times"].cast("double")).alias("values"))
    # zeros up to each id that is there, then its count: as long as the array and the result together
    before = _shifted(counts, F.struct(F.lit(-1).cast("bigint").alias("id"), F.lit(0).alias("times")))
    gaps = F.zip_with(counts, before, lambda c, b: F.concat(
        F.array_repeat(F.lit(0.0), (c["id"] - b["id"] - 1).cast("int")), F.array(c["times"].cast("double"))))
    last = F.coalesce(F.get(counts, F.size(counts) - 1)["id"], F.lit(-1))
    found = F.when(F.size(counts) > 0, F.flatten(gaps)).otherwise(F.array().cast("array<double>"))
    return F.concat(found, F.array_repeat(F.lit(0.0), (F.lit(size - 1) - last).cast("int")))


def _one_hot(ids: Column, size: int, sparse: bool = False) -> Column:
    if sparse:
        here = F.when((ids >= 0) & (ids < size), F.array(ids.cast("int"))).otherwise(F.array().cast("array<int>"))
        return F.struct(F.lit(size).alias("size"), here.alias("indices"), F.transform(here, lambda i: F.lit(1.0)).alias("values"))
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce((i == ids).cast("double"), F.lit(0.0)))


def _each(df: DataFrame, key: str, one) -> Column:
    return _each_value(F.col(f"`{key}`"), isinstance(df.schema[key].dataType, T.ArrayType), one)


def _each_value(value: Column, many: bool, one) -> Column:
    return F.transform(value, one) if many else one(value)


def _bucket(value: Column, boundaries: Sequence[float]) -> Column:
    count = F.lit(0)
    for b in boundaries:
        count = count + F.when(value >= b, 1).otherwise(0)
    return F.when(value.isNotNull(), count)


def _or_unknown(place: Column, text: Column, step: S.Vocabulary, size: int) -> Column:
    """The id; for a value outside the vocabulary its default or hashed id; null for null."""
    if step.num_oov_buckets:
        unknown = F.lit(size).cast("bigint") + hash_bucket(text, step.num_oov_buckets)
    else:
        unknown = F.lit(step.default_value).cast("bigint")
    return F.when(text.isNotNull(), F.coalesce(place, unknown))


def _clipped(vector: Column, max_norm: float | None) -> Column:
    if max_norm is None:
        return vector
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, v: total + v * v))
    return F.when(norm > max_norm, F.transform(vector, lambda v: v * max_norm / norm)).otherwise(vector)


def use_spec(df: DataFrame, spec, **options) -> DataFrame:
    """Apply a fitted specification; an unfitted one is an error."""
    if not isinstance(spec, FittedSpec):
        raise ValueError("the specification is not fitted")
    return spec.transform(df, **options)
