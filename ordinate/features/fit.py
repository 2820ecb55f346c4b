"""What a specification learns from data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T

from ordinate.features import steps as S
from ordinate.order import with_ordinal
from ordinate.scratch import written


@dataclass(frozen=True, eq=False)
class Vocab:
    """Different values and their ids, as a table ``(value, id)`` of any size; ids run up to ``size``."""

    size: int
    table: DataFrame


@dataclass(frozen=True, eq=False)
class Learned:
    scales: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)  # (shift, divisor)
    vocabularies: dict[str, Vocab] = field(default_factory=dict)


def learn(data: DataFrame, steps) -> Learned:
    """Fit all steps: one aggregate for the scalers, one distinct pass for vocabularies."""
    return Learned(_scales(data, steps), _vocabularies(data, steps))


def _scales(data: DataFrame, steps) -> dict:
    scaled = [s for s in steps if isinstance(s, S.Numeric) and isinstance(s.normalizer_fn, S.Scaler)]
    if not scaled:
        return {}
    arrays = [s for s in scaled if isinstance(data.schema[s.key].dataType, T.ArrayType)]
    plain = [s for s in scaled if s not in arrays]
    found = {}
    if plain:
        found.update(_scale_job(data, {s: F.col(f"`{s.key}`").cast("double") for s in plain}))
    for s in arrays:
        items = data.select(F.explode(F.col(f"`{s.key}`")).alias("v"))
        found.update(_scale_job(items, {s: F.col("v").cast("double")}))
    return found


def _scale_job(data: DataFrame, columns: dict) -> dict:
    aggs = []
    for i, (step, c) in enumerate(columns.items()):
        pair = (F.avg(c), F.stddev_samp(c)) if step.normalizer_fn.kind == "standard" else (F.min(c), F.max(c))
        aggs += [pair[0].alias(f"a{i}"), pair[1].alias(f"b{i}")]
    row = data.agg(*aggs).first()
    found = {}
    for i, step in enumerate(columns):
        a, b = row[f"a{i}"], row[f"b{i}"]
        if step.normalizer_fn.kind == "min_max" and a is not None:
            b = b - a
        found[step.name] = (a, b or None)  # nothing can be divided by 0
    return found


def _vocabularies(data: DataFrame, steps) -> dict[str, Vocab]:
    vocab_steps = [s for s in steps if isinstance(s, S.Vocabulary)]
    found = {s.name: _given(data, s) for s in vocab_steps if s.vocabulary is not None}
    for s in vocab_steps:
        if s.file is not None:
            found[s.name] = _from_file(data, s)
    learned = [s for s in vocab_steps if s.name not in found]
    if not learned:
        return found

    pairs = []
    for i, s in enumerate(learned):
        c = F.col(f"`{s.key}`")
        values = c if isinstance(data.schema[s.key].dataType, T.ArrayType) else F.array(c)
        pairs.append(_tagged(values, i))
    items = data.select(F.inline(F.flatten(F.array(*pairs)))).where(F.col("value").isNotNull())
    # numbers sort by value, the rest by UTF-8 bytes, which is how Spark compares strings
    kinds = {i: _number_kind(data, s.key) for i, s in enumerate(learned)}
    order = []
    for kind in ("bigint", "double"):
        chosen = [i for i, k in kinds.items() if k == kind]
        if chosen:
            items = items.withColumn(kind, F.when(F.col("step").isin(chosen), F.col("value").cast(kind)))
            order.append(kind)
    distinct = written(items.distinct(), "vocabulary")
    ranked = with_ordinal(distinct, [*order, "value"], "id", partition_by="step")
    table = written(ranked.select("step", "value", "id"), "vocabulary")
    sizes = {r["step"]: r["count"] for r in table.groupBy("step").count().collect()}
    for i, s in enumerate(learned):
        found[s.name] = Vocab(sizes.get(i, 0), table.where(F.col("step") == i).select("value", "id"))
    return found


def _text_of(data: DataFrame, key: str, value):
    """A vocabulary's entry in the form that the column's values have as text: 1 is 1.0 beside doubles."""
    kind = data.schema[key].dataType
    kind = kind.elementType if isinstance(kind, T.ArrayType) else kind
    return value.try_cast(kind).cast("string") if isinstance(kind, T.NumericType) else value


def _first_places(data: DataFrame, key: str, entries: DataFrame) -> DataFrame:
    """Of entries that are equal as the column's values, the first one's place counts."""
    typed = entries.select(_text_of(data, key, F.col("value")).alias("value"), "id").where("value is not null")
    return typed.groupBy("value").agg(F.min("id").alias("id"))


def _given(data: DataFrame, step: S.Vocabulary) -> Vocab:
    rows = [(str(v), i) for i, v in enumerate(step.vocabulary)]
    entries = data.sparkSession.createDataFrame(rows, "value string, id bigint")
    return Vocab(len(rows), _first_places(data, step.key, entries))


def _tagged(values, i: int):
    return F.transform(values, lambda v: F.struct(F.lit(i).alias("step"), v.cast("string").alias("value")))


def _number_kind(data: DataFrame, key: str) -> str | None:
    """The type to sort a column's values by, if they are numbers."""
    kind = data.schema[key].dataType
    kind = kind.elementType if isinstance(kind, T.ArrayType) else kind
    if isinstance(kind, T.IntegralType):
        return "bigint"
    return "double" if isinstance(kind, T.NumericType) else None


def _from_file(data: DataFrame, step: S.Vocabulary) -> Vocab:
    from ordinate.sources.text import text_lines

    spark = data.sparkSession
    count = spark.read.text(step.file).count()
    if step.file_size is not None:
        if step.file_size > count:
            raise ValueError(f"{step.file} has {count} lines, fewer than vocabulary_size {step.file_size}")
        count = step.file_size
    lines = text_lines(spark, step.file, with_position=True).where(F.col("line") < count)
    entries = lines.select("value", F.col("line").alias("id"))
    return Vocab(count, written(_first_places(data, step.key, entries), "vocabulary"))
