"""Binary records: fixed-length ones, and length-framed ones with checksums.

Files are listed by Spark, cut into ranges of whole records and read by tasks that
open only their own range, so a large file is read in parallel like many small
ones.  Paths are opened with Arrow's file systems (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import gzip
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ordinate.sources.files import file_list

# Fixed values of the record framing: reflected polynomial and mask of its CRC-32C,
# 8-byte little-endian length, 4-byte checksum before and after the payload.
CRC_POLYNOMIAL = 0x82F63B78
CRC_MASK_DELTA = 0xA282EAD8
HEADER, HEADER_BYTES = "<QI", 12
FOOTER, FOOTER_BYTES = "<I", 4

#: bytes of a file that one task reads
SPLIT_BYTES = 64 << 20
#: payload bytes handed to Spark at a time
CHUNK_BYTES = 4 << 20


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark's own readers and writers would take it."""
    plain = spark._jvm.org.apache.hadoop.fs.Path(path)
    return plain.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(plain).toString()


def _locate(path: str):
    """Arrow's file system for a qualified path, and the name within it."""
    single = path.startswith("file:/") and not path.startswith("file://")
    return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if single else path)


def open_file(path: str):
    system, name = _locate(path)
    return system.open_input_file(name)


def spread(splits: DataFrame, *by: str) -> DataFrame:
    """One task's worth of splits per partition.

    The rows are only descriptions of what to read, so without a fixed number of
    partitions adaptive execution would take them for little work and join them.
    """
    return splits.repartition(int(splits.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def fixed_length_records(
    spark: SparkSession, paths, record_bytes: int, header_bytes: int = 0, footer_bytes: int = 0,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Records of ``record_bytes`` bytes between a file's header and footer.

    Columns ``path`` and ``record`` (its number in the file) order the binary ``value``.
    """
    if record_bytes < 1:
        raise ValueError("record_bytes must be at least 1")
    body = F.col("length") - header_bytes - footer_bytes
    n = F.when(
        (body >= 0) & (body % record_bytes == 0), F.expr(f"(length - {header_bytes} - {footer_bytes}) div {record_bytes}")
    ).otherwise(F.raise_error(F.concat(F.lit("not a whole number of records: "), F.col("path"))))
    per_split = max(1, split_bytes // record_bytes)
    files = file_list(spark, paths, shuffle=False).select("path", n.alias("n")).where("n > 0")
    splits = files.select("path", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(per_split).cast("bigint"))).alias("first"))
    splits = splits.select("path", "first", F.least(F.lit(per_split), F.col("n") - F.col("first")).alias("count"))

    def read(frames):
        step = max(1, CHUNK_BYTES // record_bytes)
        for frame in frames:
            for path, first, count in frame.itertuples(index=False):
                with open_file(path) as file:
                    file.seek(header_bytes + first * record_bytes)
                    for start in range(first, first + count, step):
                        size = min(step, first + count - start)
                        data = file.read(size * record_bytes)
                        yield pd.DataFrame({
                            "path": path,
                            "record": np.arange(start, start + size),
                            "value": [data[i:i + record_bytes] for i in range(0, len(data), record_bytes)],
                        })

    return spread(splits, "path", "first").mapInPandas(read, "path string, record bigint, value binary")


# -- length-framed records -----------------------------------------------------


def _crc_table() -> list[int]:
    table = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ (CRC_POLYNOMIAL if n & 1 else 0)
        table.append(n)
    return table


_TABLE = _crc_table()


def masked_crc(data: bytes, crc: int = 0xFFFFFFFF) -> int:
    """Rotated and offset CRC-32C, as stored beside lengths and payloads."""
    for byte in data:
        crc = (crc >> 8) ^ _TABLE[(crc ^ byte) & 0xFF]
    crc ^= 0xFFFFFFFF
    return (((crc >> 15) | (crc << 17)) + CRC_MASK_DELTA) & 0xFFFFFFFF


def _masked_crcs(payloads: list[bytes]) -> list[int]:
    """``masked_crc`` of many payloads: byte by byte, but all that are long enough at once."""
    lengths = np.array([len(p) for p in payloads])
    longest_first = np.argsort(-lengths, kind="stable")
    data = np.frombuffer(b"".join(payloads), np.uint8)
    starts = (np.cumsum(lengths) - lengths)[longest_first]
    table, crc = np.array(_TABLE, np.uint32), np.full(len(payloads), 0xFFFFFFFF, np.uint32)
    together = lengths[longest_first[63]] if len(payloads) > 63 else 0  # fewer are not worth a numpy call
    reaching = len(payloads) - np.searchsorted(np.sort(lengths), np.arange(together), side="right")
    for at, n in enumerate(reaching):
        head = crc[:n]
        crc[:n] = (head >> 8) ^ table[(head ^ data[starts[:n] + at]) & 0xFF]
    out = [0] * len(payloads)
    for place, start, value in zip(longest_first, starts, crc.tolist()):
        out[place] = masked_crc(payloads[place][together:], value)
    return out


def _stream(path: str, compression: str | None):
    if compression == "GZIP":
        return gzip.GzipFile(fileobj=open_file(path))
    return _Inflated(open_file(path)) if compression == "ZLIB" else _buffered(path)


def _buffered(path: str):
    """An uncompressed file, read in pieces: one request for many small records."""
    return io.BufferedReader(open_file(path), CHUNK_BYTES)


class _Inflated:
    """Reads a zlib-compressed file piece by piece."""

    def __init__(self, raw):
        self._raw, self._zlib, self._ready = raw, zlib.decompressobj(), b""

    def read(self, size: int) -> bytes:
        while len(self._ready) < size:
            piece = self._raw.read(CHUNK_BYTES)
            if not piece:
                break
            self._ready += self._zlib.decompress(piece)
        out, self._ready = self._ready[:size], self._ready[size:]
        return out

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self._raw.close()


def _framed(file, path: str, count: int | None, verify: bool) -> Iterator[bytes]:
    while count is None or count > 0:
        head = file.read(HEADER_BYTES)
        if not head:
            return
        if len(head) < HEADER_BYTES:
            raise ValueError(f"truncated record in {path}")
        size, check = struct.unpack(HEADER, head)
        if masked_crc(head[:8]) != check:
            raise ValueError(f"corrupted record length in {path}")
        body = file.read(size + FOOTER_BYTES)
        if len(body) < size + FOOTER_BYTES:
            raise ValueError(f"truncated record in {path}")
        payload = body[:size]
        if verify and masked_crc(payload) != struct.unpack(FOOTER, body[size:])[0]:
            raise ValueError(f"corrupted record in {path}")
        yield payload
        if count is not None:
            count -= 1


def framed_records(
    spark: SparkSession, paths, compression: str | None = None, verify: bool = False, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Records framed by their length and checksums.

    Columns ``path`` and ``record`` (its number in the file) order the binary ``value``.
    Lengths are always checked, payloads if ``verify``.  An uncompressed file is first
    walked from header to header, skipping payloads, to cut it into ranges of whole
    records; compressed ones (``GZIP``, ``ZLIB``) can only be read from the start.
    """
    if compression not in (None, "GZIP", "ZLIB"):
        raise ValueError("compression must be None, GZIP or ZLIB")
    files = spread(file_list(spark, paths, shuffle=False).where("length > 0").select("path", "length"), "path")
    if compression is None:
        splits = files.mapInPandas(lambda frames: _walk(frames, split_bytes), "path string, offset bigint, first bigint, count bigint")
    else:
        whole = F.lit(None).cast("bigint")
        splits = files.select("path", F.lit(0).cast("bigint").alias("offset"), F.lit(0).cast("bigint").alias("first"), whole.alias("count"))

    def read(frames):
        for frame in frames:
            for path, offset, first, count in frame.itertuples(index=False):
                with _stream(path, compression) as file:
                    if offset:
                        file.seek(int(offset))
                    rows, held, at = [], 0, int(first)
                    for payload in _framed(file, path, None if pd.isna(count) else int(count), verify):
                        rows.append(payload)
                        held += len(payload)
                        if held >= CHUNK_BYTES:
                            yield pd.DataFrame({"path": path, "record": np.arange(at, at + len(rows)), "value": rows})
                            at, rows, held = at + len(rows), [], 0
                    if rows:
                        yield pd.DataFrame({"path": path, "record": np.arange(at, at + len(rows)), "value": rows})

    return spread(splits, "path", "offset").mapInPandas(read, "path string, record bigint, value binary")


def _walk(frames, split_bytes: int):
    for frame in frames:
        for path, length in frame.itertuples(index=False):
            with _buffered(path) as file:
                start, first, at, record = 0, 0, 0, 0
                while at < length:
                    file.seek(at)
                    head = file.read(HEADER_BYTES)
                    if len(head) < HEADER_BYTES:
                        raise ValueError(f"truncated record in {path}")
                    size, check = struct.unpack(HEADER, head)
                    if masked_crc(head[:8]) != check:
                        raise ValueError(f"corrupted record length in {path}")
                    at, record = at + HEADER_BYTES + size + FOOTER_BYTES, record + 1
                    if at - start >= split_bytes or at >= length:
                        yield pd.DataFrame({"path": [path], "offset": [start], "first": [first], "count": [record - first]})
                        start, first = at, record
                if at > length:
                    raise ValueError(f"truncated record in {path}")


def write_framed_records(df: DataFrame, column: str, path: str) -> int:
    """Write a binary column as one framed file per partition; returns the record count.

    A task writes under its attempt's name and renames at the end, so a retried or
    speculative task leaves one finished file per partition.
    """

    target = _qualified(df.sparkSession, path)

    def write(frames):
        context = TaskContext.get()
        system, base = _locate(target)
        system.create_dir(base, recursive=True)
        part = f"{base}/part-{context.partitionId():06d}"
        draft, n = f"{part}.{context.taskAttemptId()}.tmp", 0
        with system.open_output_stream(draft) as out:
            for frame in frames:
                payloads = list(frame[column])
                n += len(payloads)
                for payload, check in zip(payloads, _masked_crcs(payloads)):
                    head = struct.pack("<Q", len(payload))
                    out.write(head + struct.pack(FOOTER, masked_crc(head)) + payload + struct.pack(FOOTER, check))
        system.move(draft, f"{part}.records")
        yield pd.DataFrame({"n": [n]})

    written = df.select(column).mapInPandas(write, "n bigint")
    return written.agg(F.sum("n")).first()[0] or 0


# -- typed examples inside records ------------------------------------------------

# Field number of each kind of feature list in an example message.
FEATURE_KINDS = {1: "bytes", 2: "float", 3: "int64"}
_SPARK_ELEMENT = {"bytes": "binary", "float": "float", "int64": "bigint"}


def decode_examples(records: DataFrame, features: dict[str, str], column: str = "value") -> DataFrame:
    """Decode serialized examples into columns.

    ``features`` maps names to ``bytes``, ``float`` or ``int64``, with ``[]`` appended
    for a list.  A feature that is absent is null; one of another kind is an error.
    """
    kinds = {n: k.removesuffix("[]") for n, k in features.items()}
    lists = {n: k.endswith("[]") for n, k in features.items()}
    unknown = [k for k in kinds.values() if k not in _SPARK_ELEMENT]
    if unknown:
        raise ValueError(f"unknown feature kinds {unknown}")
    ddl = ", ".join(f"`{n}` array<{_SPARK_ELEMENT[k]}>" for n, k in kinds.items())
    kept = [c for c in records.columns if c != column]
    kept_ddl = ", ".join(f"`{c}` {records.schema[c].dataType.simpleString()}" for c in kept)

    def decode(frames):
        for frame in frames:
            parsed = [_example(bytes(v)) for v in frame[column]]
            out = {c: frame[c] for c in kept}
            for name, kind in kinds.items():
                cells = []
                for found in parsed:
                    stored, values = found.get(name, (kind, None))
                    if stored != kind and values:
                        raise ValueError(f"feature {name} holds {stored}, not {kind}")
                    cells.append(values)
                out[name] = cells
            yield pd.DataFrame(out)

    rows = records.mapInPandas(decode, ", ".join(p for p in (kept_ddl, ddl) if p))

    def only(name: str):
        values = F.col(f"`{name}`")
        several = F.raise_error(F.lit(f"feature {name} has more than one value"))
        first = F.when(F.size(values) > 1, several).otherwise(F.get(values, F.lit(0)))
        return first.cast(_SPARK_ELEMENT[kinds[name]]).alias(name)

    return rows.select(*kept, *[F.col(f"`{n}`") if lists[n] else only(n) for n in kinds])


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of one message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            value, at = _varint(data, at)
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            value, at = data[at:at + size], at + size
        elif wire == 2:
            size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        else:
            raise ValueError(f"unsupported wire type {wire}")
        yield number, value


def _example(data: bytes) -> dict[str, tuple[str, list]]:
    found = {}
    for number, message in _fields(data):
        if number != 1:
            continue
        for entry_number, entry in _fields(message):
            if entry_number == 1:
                parts = dict(_fields(entry))
                found[bytes(parts.get(1, b"")).decode()] = _feature(parts.get(2, b""))
    return found


def _feature(data: bytes) -> tuple[str, list]:
    for number, body in _fields(data):
        kind, values = FEATURE_KINDS[number], []
        for _, item in _fields(body):
            if kind == "bytes":
                values.append(item)
            elif kind == "float":  # packed, or one at a time
                values.extend(np.frombuffer(item, "<f4").tolist())
            elif isinstance(item, int):
                values.append(item - (1 << 64) if item >> 63 else item)
            else:
                at = 0
                while at < len(item):
                    value, at = _varint(item, at)
                    values.append(value - (1 << 64) if value >> 63 else value)
        return kind, values
    return "bytes", []


def encode_examples(df: DataFrame, features: dict[str, str], name: str = "value") -> DataFrame:
    """Serialize columns as examples in a binary column; the inverse of :func:`decode_examples`.

    Null and missing features are left out.
    """
    kinds = {n: k.removesuffix("[]") for n, k in features.items()}
    numbers = {kind: number for number, kind in FEATURE_KINDS.items()}
    cols = []
    for n, k in kinds.items():  # a single value travels as an array, or pandas would turn numbers beside nulls to floats
        value = F.col(f"`{n}`")
        values = value if features[n].endswith("[]") else F.when(value.isNotNull(), F.array(value))
        cols.append(values.cast(f"array<{_SPARK_ELEMENT[k]}>").alias(n))

    def encode(frames):
        for frame in frames:
            rows = []
            for cells in zip(*[frame[n] for n in kinds]):
                entries = []
                for (feature, kind), values in zip(kinds.items(), cells):
                    if values is not None:
                        body = _field(numbers[kind], _values(kind, values))
                        entries.append(_field(1, _field(1, feature.encode()) + _field(2, body)))
                rows.append(_field(1, b"".join(entries)))
            yield pd.DataFrame({name: rows})

    return df.select(*cols).mapInPandas(encode, f"`{name}` binary")


def _values(kind: str, values) -> bytes:
    if kind == "bytes":
        return b"".join(_field(1, bytes(v)) for v in values)
    if kind == "float":
        return _field(1, np.asarray(values, "<f4").tobytes())
    return _field(1, b"".join(_to_varint(int(v)) for v in values))


def _to_varint(value: int) -> bytes:
    value, out = value & ((1 << 64) - 1), bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _field(number: int, body: bytes) -> bytes:
    return _to_varint(number << 3 | 2) + _to_varint(len(body)) + body
