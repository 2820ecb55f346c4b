"""Text lines and delimited records."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ordinate.operators.batching import batch
from ordinate.operators.combine import shuffle_and_repeat
from ordinate.operators.position import repeat
from ordinate.sources.files import file_list
from ordinate.sources.record_spec import SPARK_TYPES, TYPE_DEFAULTS, RecordSpec, fitting_types
from ordinate.sources.records import CHUNK_BYTES, open_file, spread

_BAD = "__bad"
#: Named compressions, and the headers that zlib is told to expect.
WINDOW_BITS = {"GZIP": 31, "ZLIB": 15}


def text_lines(
    spark: SparkSession, paths, record_spec: RecordSpec | None = None, with_position: bool = False, streaming: bool = False,
    compression: str | None = None,
) -> DataFrame:
    """Lines of text files as ``value``, or decoded columns when a spec is given.

    ``.gz`` and ``.deflate`` files are unpacked by their extension.  With ``compression``, ``GZIP`` or ``ZLIB``, all files
    are unpacked that way, whatever their names; a file that is not of that kind, or ends early, is an error.  ``with_position``
    adds ``path`` and the 0-based ``line`` in the file, which order the lines.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if compression is not None and compression not in WINDOW_BITS:
        raise ValueError(f"compression must be None or one of {sorted(WINDOW_BITS)}, got {compression}")
    if streaming:
        if len(paths) != 1 or with_position or compression:
            raise ValueError("a stream reads one directory, has no line positions and no named compression")
        lines = spark.readStream.text(paths[0])
        return decode_delim(lines, record_spec) if record_spec else lines
    if compression is not None:
        lines = _unpacked_lines(spark, paths, compression)
        rows = decode_delim(lines, record_spec) if record_spec else lines
        return rows if with_position else rows.drop("path", "line")
    if record_spec is not None and record_spec.skip <= 1 and not with_position:
        return _decode(_raw_csv(spark, paths, record_spec), record_spec)
    if not with_position and record_spec is None:
        return spark.read.text(paths)
    lines = _numbered(spark, paths)
    if record_spec is None:
        return lines
    decoded = decode_delim(lines, record_spec)
    return decoded if with_position else decoded.drop("path", "line")


def _unpacked(file, path: str, compression: str) -> Iterator[bytes]:
    """A compressed file's content in pieces; streams that follow each other in a file are read one after the other."""
    unpack, data, begun = zlib.decompressobj(WINDOW_BITS[compression]), b"", False
    while True:
        data = data or file.read(CHUNK_BYTES)
        if unpack.eof:
            data = data.lstrip(b"\0")  # files may be padded
        if not data:
            if unpack.eof or not begun:
                return
            yield unpack.flush()
            if not unpack.eof:
                raise ValueError(f"{path} ends within its {compression} data")
            continue
        if unpack.eof:
            unpack = zlib.decompressobj(WINDOW_BITS[compression])
        begun = True
        yield unpack.decompress(data, CHUNK_BYTES)
        data = unpack.unconsumed_tail or unpack.unused_data


def _lines(chunks: Iterator[bytes]) -> Iterator[list[bytes]]:
    """Lines that end with LF, CR LF or CR, some at a time.  A line that spans many chunks is put together once."""
    held: list[bytes] = []
    after_cr = False
    for chunk in chunks:
        if not chunk:
            continue
        if after_cr and chunk.startswith(b"\n"):
            chunk = chunk[1:]  # its CR has ended the line
        after_cr = chunk.endswith(b"\r") if chunk else False
        *done, rest = chunk.replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n")
        if done:
            done[0] = b"".join([*held, done[0]])
            held = []
            yield done
        held.append(rest)
    last = b"".join(held)
    if last:
        yield [last]


def _unpacked_lines(spark: SparkSession, paths: list[str], compression: str) -> DataFrame:
    """Lines of compressed files with file and number, one task per file: such a file can only be read from its start.

    Lines are counted as they are read, so no file's lines are ranked or moved.  Bytes go on as they are.
    """
    files = spread(file_list(spark, paths, shuffle=False).where("length > 0").select("path"), "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                at = 0
                with open_file(path) as file:
                    for lines in _lines(_unpacked(file, path, compression)):
                        n = len(lines)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path] * n), pa.array(range(at, at + n), pa.int64()), pa.array(lines, pa.binary())], ["path", "line", "value"])
                        at += n

    read_lines = files.mapInArrow(read, "path string, line bigint, value binary")
    return read_lines.select("path", "line", F.col("value").cast("string").alias("value"))


def _numbered(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with their file and number.

    A read block is one task's consecutive lines, so ranking inside it is bounded by
    the block size; what came before it in the file is summed from the block counts.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__seen"),
    )
    blocks = lines.groupBy("path", "__block").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("path").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("path", "__block", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("path", "__block").orderBy("__seen")) - 1
    ranked = lines.withColumn("__inside", inside).join(blocks, ["path", "__block"])
    return ranked.select("path", (F.col("__before") + F.col("__inside")).alias("line"), "value")


def decode_delim(lines: DataFrame, spec: RecordSpec, column: str = "value") -> DataFrame:
    """Decode delimited lines into the spec's named, typed columns.

    A record with another number of fields, or a field that is not of its type, is an
    error; a missing field becomes its default.  The spec's first ``skip`` lines are
    left out of each file when the lines carry their ``line`` number.
    """
    if spec.skip and "line" in lines.columns:
        lines = lines.where(F.col("line") >= spec.skip)
    elif spec.skip:
        raise ValueError("skipping lines needs their positions: read them with with_position=True")
    fields = ", ".join(f"f{i} string" for i in range(len(spec.names)))
    parsed = F.from_csv(
        F.col(column), F.lit(f"{fields}, {_BAD} string"),
        {"sep": spec.delim, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD},
    )
    kept = [c for c in lines.columns if c != column]
    raw = lines.select(*kept, parsed.alias("__record"))
    return raw.select(*kept, *_typed(spec, lambda i: F.col("__record")[f"f{i}"], F.col("__record")[_BAD]))


def _raw_csv(spark: SparkSession, paths: list[str], spec: RecordSpec) -> DataFrame:
    fields = ", ".join(f"f{i} string" for i in range(len(spec.names)))
    return (
        spark.read.schema(f"{fields}, {_BAD} string")
        .option("sep", spec.delim).option("header", spec.skip == 1)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD)
        .option("columnPruning", False)  # a short record must show whichever columns are wanted
        .csv(paths)
    )


def field_texts(spark: SparkSession, path: str, delim: str, skip: int, fields: int) -> DataFrame:
    """All records of a file as texts ``f0``, ``f1``, ... without its first lines."""
    schema = ", ".join(f"f{i} string" for i in range(fields))
    if skip <= 1:
        return spark.read.schema(schema).option("sep", delim).option("header", skip == 1).csv(path)
    lines = _numbered(spark, [path]).where(F.col("line") >= skip)
    return lines.select(F.from_csv("value", F.lit(schema), {"sep": delim}).alias("r")).select("r.*")


def _decode(raw: DataFrame, spec: RecordSpec) -> DataFrame:
    return raw.select(*_typed(spec, lambda i: F.col(f"f{i}"), F.col(_BAD)))


def _typed(spec: RecordSpec, field, bad: Column) -> list[Column]:
    """Cast each field, checking the record as a whole even if few columns are used later."""
    out = []
    for i, (name, kind, default) in enumerate(zip(spec.names, spec.types, spec.defaults)):
        text, ddl = field(i), SPARK_TYPES[kind]
        value = text.try_cast(ddl) if kind != "character" else text
        wrong = F.raise_error(F.concat(F.lit(f"column {name} is not {kind}: "), text))
        value = (
            F.when(bad.isNotNull(), F.raise_error(F.concat(F.lit("wrong number of fields: "), bad)))
            .when(text.isNull(), F.lit(default).cast(ddl))
            .when(value.isNull(), wrong)
            .otherwise(value)
        )
        out.append(value.cast(ddl).alias(name))
    return out


def make_csv_dataset(
    spark: SparkSession,
    file_pattern,
    batch_size: int | None = None,
    order_by=None,
    column_names: Sequence[str] | None = None,
    column_defaults: Sequence | None = None,
    label_name: str | None = None,
    select_columns: Sequence[str | int] | None = None,
    field_delim: str = ",",
    use_quote_delim: bool = True,
    na_value: str = "",
    header: bool = True,
    num_epochs: int = 1,
    shuffle_seed: int | None = None,
    shuffle_buffer_size: int | None = None,
    num_rows_for_inference: int | None = None,
) -> DataFrame:
    """CSV files as features and a label, optionally shuffled, repeated and batched.

    A column whose default is a type name (``"integer"``, ``"double"``,
    ``"character"``) is required; one with a value is optional and gets that value
    when missing.  Types that are not given are those that all rows fit, or so many as
    ``num_rows_for_inference`` says.  With ``shuffle_buffer_size`` rows move only within
    blocks of that many.  Without ``batch_size`` the rows have struct ``features`` and
    ``label``; batches need ``order_by``, columns that identify a row.
    """
    paths = [file_pattern] if isinstance(file_pattern, str) else list(file_pattern)
    if column_names is None:
        if not header:
            raise ValueError("column_names is needed for files without a header")
        column_names = spark.read.option("header", True).option("sep", field_delim).csv(paths).columns
    column_names = list(column_names)
    chosen = [column_names[c] if isinstance(c, int) else c for c in (select_columns or column_names)]
    missing = [c for c in [*chosen, *([label_name] if label_name else [])] if c not in column_names]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    chosen = [c for c in column_names if c in chosen]  # defaults come in file order
    options = {"sep": field_delim, "header": header, "nullValue": na_value, "mode": "FAILFAST", "columnPruning": False}
    if not use_quote_delim:
        options["quote"] = ""
    text = spark.read.schema(", ".join(f"`{c}` string" for c in column_names)).options(**options).csv(paths)
    if column_defaults is None:
        rows = text if num_rows_for_inference is None else text.limit(num_rows_for_inference)
        kinds = fitting_types(rows, chosen)
        empty = {c for c, gone in zip(chosen, rows.agg(*[(F.count(f"`{c}`") == 0).alias(c) for c in chosen]).first()) if gone} if None in kinds else set()
        column_defaults = [TYPE_DEFAULTS[k or ("integer" if c in empty else "character")] for c, k in zip(chosen, kinds)]
    if len(column_defaults) != len(chosen):
        raise ValueError("one default per selected column")
    made = {}
    for c, default in zip(chosen, column_defaults):
        required = default in SPARK_TYPES
        kind = default if required else {int: "integer", float: "double"}.get(type(default), "character")
        raw, ddl = F.col(f"`{c}`"), SPARK_TYPES[kind]
        value = raw if kind == "character" else raw.try_cast(ddl)
        absent = F.raise_error(F.lit(f"column {c} is required")) if required else F.lit(default).cast(ddl)
        wrong = F.raise_error(F.concat(F.lit(f"column {c} is not {kind}: "), raw))
        made[c] = F.when(raw.isNull(), absent).when(value.isNull(), wrong).otherwise(value).cast(ddl)
    rows = text.select(*[v.alias(n) for n, v in made.items()])
    features = [c for c in chosen if c != label_name]
    order = [order_by] if isinstance(order_by, str) else list(order_by or [])
    mixed = []
    if shuffle_seed is not None:
        rows = shuffle_and_repeat(rows, order, num_epochs, shuffle_seed, shuffle_buffer_size)
        mixed = [*(["shuffle_key_block"] if shuffle_buffer_size else []), "shuffle_key"]
        order = ["epoch", *mixed, *order]
    elif batch_size is not None or num_epochs != 1:
        rows = repeat(rows, num_epochs)
        order = ["epoch", *order]
    if batch_size is not None:
        if len(order) < 2:
            raise ValueError("batches need order_by: columns that identify a row")
        keep = [*features, *([label_name] if label_name else [])]
        return batch(rows, batch_size, order, columns=keep)
    shaped = F.struct(*[F.col(f"`{c}`") for c in features]).alias("features")
    label = [F.col(f"`{label_name}`").alias("label")] if label_name else []
    return rows.select(*[F.col(c) for c in order if c == "epoch" or c in mixed], shaped, *label)

