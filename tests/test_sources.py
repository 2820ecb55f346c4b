"""Sources read back exactly what was written."""

import gzip
import struct
import zlib

import pytest
from pyspark.sql import functions as F

import ordinate as o
from ordinate.sources.record_spec import csv_record_spec, delim_record_spec, tsv_record_spec
from ordinate.sources.records import masked_crc

HEADER = '"mpg","cyl","name"\n'
ROWS = ['21.0,6,"Mazda, RX4"', "22.8,4,Datsun", ",8,Duster", "18.1,,"]
WANT = [(21.0, 6, "Mazda, RX4"), (22.8, 4, "Datsun"), (0.0, 8, "Duster"), (18.1, 0, "")]


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "cars.csv"
    path.write_text(HEADER + "\n".join(ROWS) + "\n")
    return str(path)


def test_record_spec(spark, csv_file):
    spec = csv_record_spec(spark, csv_file)
    assert spec.names == ("mpg", "cyl", "name") and spec.types == ("double", "integer", "character")
    assert spec.defaults == (0.0, 0, "") and spec.skip == 1
    assert csv_record_spec(spark, csv_file, types="dic") == spec
    assert csv_record_spec(names=["a", "b", "c"], defaults=[0, 0.0, ""], types="idc").skip == 0
    assert delim_record_spec(names=["a", "b"], defaults=[1, "x"]).types == ("integer", "character")
    assert tsv_record_spec(names=["a"], types=["double"]).delim == "\t"
    with pytest.raises(ValueError, match="names for"):
        csv_record_spec(spark, csv_file, names=["a", "b"])
    with pytest.raises(ValueError, match="invalid column types"):
        csv_record_spec(spark, csv_file, types="dix")
    with pytest.raises(ValueError, match="types for"):
        csv_record_spec(spark, csv_file, types="di")
    with pytest.raises(ValueError, match="defaults for"):
        csv_record_spec(spark, csv_file, defaults=[0.0])
    with pytest.raises(TypeError):
        csv_record_spec(spark, csv_file, names="abc")
    with pytest.raises(ValueError):
        csv_record_spec(names=["a"])


def test_undecidable_types_are_refused(spark, tmp_path):
    path = tmp_path / "flags.csv"
    path.write_text("a,b\nTRUE,1\nFALSE,2\n")
    with pytest.raises(ValueError, match="cannot tell"):
        csv_record_spec(spark, str(path))


def test_delimited_records(spark, csv_file):
    spec = csv_record_spec(spark, csv_file)
    assert sorted(map(tuple, o.text_lines(spark, csv_file, spec).collect())) == sorted(WANT)
    lines = o.text_lines(spark, csv_file, with_position=True)
    assert [r.line for r in lines.orderBy("line").collect()] == list(range(5))
    decoded = o.decode_delim(lines, spec).orderBy("line")
    assert [(r.mpg, r.cyl, r.name) for r in decoded.collect()] == WANT
    other = csv_record_spec(spark, csv_file, types="dic", defaults=[-1.0, -2, "none"])
    assert (-1.0, 8, "Duster") in [tuple(r) for r in o.text_lines(spark, csv_file, other).collect()]
    with pytest.raises(ValueError):
        o.decode_delim(spark.read.text(csv_file), spec)


def test_skip_is_per_file(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text("# a note\n# another\na,b\n" + "".join(f"{i},{j}\n" for j in range(4)))
    spec = delim_record_spec(names=["a", "b"], types="ii", skip=3)
    rows = o.text_lines(spark, str(tmp_path), spec).collect()
    assert sorted(map(tuple, rows)) == [(i, j) for i in range(3) for j in range(4)]


@pytest.mark.parametrize("line, message", [("1,2", "wrong number of fields"), ("1,2,3,4", "wrong number of fields"), ("x,2,c", "is not double"), ("1,2.5,c", "is not integer")])
def test_malformed_records_are_errors(spark, tmp_path, line, message):
    path = tmp_path / "bad.csv"
    path.write_text(HEADER + ROWS[1] + "\n" + line + "\n")
    spec = delim_record_spec(names=["mpg", "cyl", "name"], types="dic", skip=1)
    with pytest.raises(Exception, match=message):
        o.text_lines(spark, str(path), spec).collect()
    if "fields" in message:  # found even if only one column is wanted
        with pytest.raises(Exception, match=message):
            o.text_lines(spark, str(path), spec).select("mpg").collect()
    with pytest.raises(Exception, match=message):
        o.decode_delim(o.text_lines(spark, str(path), with_position=True), spec).collect()


def test_compressed_lines(spark, tmp_path):
    text = "one\ntwo\nthree\n".encode()
    (tmp_path / "a.txt.gz").write_bytes(gzip.compress(text))
    (tmp_path / "b.txt.deflate").write_bytes(zlib.compress(text))
    for name in ("a.txt.gz", "b.txt.deflate"):
        lines = o.text_lines(spark, str(tmp_path / name), with_position=True).orderBy("line").collect()
        assert [r.value for r in lines] == ["one", "two", "three"]


def test_positions_across_blocks(spark, tmp_path):
    path = tmp_path / "long.txt"
    path.write_text("".join(f"line {i}\n" for i in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = o.text_lines(spark, str(path), with_position=True)
        assert lines.where("value <> concat('line ', line)").count() == 0 and lines.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_make_csv_dataset(spark, tmp_path):
    for f in range(2):
        (tmp_path / f"p{f}.csv").write_text("id,x,s,y\n" + "".join(f"{f * 5 + i},{i / 2},n{i},{i % 2}\n" for i in range(5)))
    glob = str(tmp_path / "*.csv")
    rows = o.make_csv_dataset(spark, glob, label_name="y")
    assert rows.columns == ["features", "label"] and rows.count() == 10
    assert rows.schema["features"].dataType.simpleString() == "struct<id:int,x:double,s:string>"
    batches = o.make_csv_dataset(spark, glob, batch_size=4, order_by="id", label_name="y", num_epochs=2, select_columns=["id", "x", "y"])
    got = batches.orderBy("batch_id").collect()
    assert [r.size for r in got] == [4] * 5 and [v for r in got for v in r.id] == list(range(10)) * 2
    mixed = o.make_csv_dataset(spark, glob, batch_size=10, order_by="id", num_epochs=2, shuffle_seed=1, select_columns=[0])
    one, two = [r.id for r in mixed.orderBy("batch_id").collect()]
    assert sorted(one) == sorted(two) == list(range(10)) and one != two
    (tmp_path / "p3.csv").write_text("id,x,s,y\n10,NIL,z,1\n")
    filled = o.make_csv_dataset(spark, glob, na_value="NIL", select_columns=["id", "x"], column_defaults=["integer", -1.0])
    assert {r.features.x for r in filled.where("features.id = 10").collect()} == {-1.0}
    needed = o.make_csv_dataset(spark, glob, na_value="NIL", select_columns=["id", "x"], column_defaults=["integer", "double"])
    with pytest.raises(Exception, match="required"):
        needed.collect()
    with pytest.raises(ValueError):
        o.make_csv_dataset(spark, glob, select_columns=["nope"])


def test_fixed_length_records(spark, tmp_path):
    for f in range(3):
        body = b"".join(struct.pack("<I", f * 1000 + i) for i in range(500))
        (tmp_path / f"{f}.bin").write_bytes(b"HEAD!" + body + b"END")
    got = o.fixed_length_records(spark, str(tmp_path / "*.bin"), 4, 5, 3, split_bytes=256)
    assert got.rdd.getNumPartitions() > 1
    rows = got.orderBy("path", "record").collect()
    assert [struct.unpack("<I", r.value)[0] for r in rows] == [f * 1000 + i for f in range(3) for i in range(500)]
    with pytest.raises(Exception, match="not a whole number"):
        o.fixed_length_records(spark, str(tmp_path / "*.bin"), 7).collect()


def frame_record(payload):
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked_crc(head)) + payload + struct.pack("<I", masked_crc(payload))


def test_checksum():
    # published check value of CRC-32C for "123456789", then rotated and offset
    crc = 0xE3069283
    assert masked_crc(b"123456789") == (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


@pytest.mark.parametrize("compression", [None, "GZIP", "ZLIB"])
def test_framed_records(spark, tmp_path, compression):
    payloads = [bytes([i % 251]) * (i % 97) for i in range(700)]
    data = b"".join(map(frame_record, payloads))
    pack = {None: lambda d: d, "GZIP": gzip.compress, "ZLIB": zlib.compress}[compression]
    path = tmp_path / "one.records"
    path.write_bytes(pack(data))
    rows = o.framed_records(spark, str(path), compression, verify=True, split_bytes=4096).orderBy("record").collect()
    assert [bytes(r.value) for r in rows] == payloads and [r.record for r in rows] == list(range(700))
    for broken in (data[:-1], data[:3] + b"\xff" + data[4:]):
        path.write_bytes(pack(broken))
        with pytest.raises(Exception, match="truncated|corrupted"):
            o.framed_records(spark, str(path), compression, verify=True).collect()
    path.write_bytes(pack(data[:-6] + b"\x00\x01" + data[-4:]))
    with pytest.raises(Exception, match="corrupted record"):
        o.framed_records(spark, str(path), compression, verify=True).collect()


def test_written_records_round_trip(spark, tmp_path):
    df = spark.range(1000).select(F.concat(F.lit("row "), F.col("id")).cast("binary").alias("b"))
    path = str(tmp_path / "out")
    assert o.write_framed_records(df, "b", path) == 1000
    back = o.framed_records(spark, path + "/*.records", verify=True)
    assert sorted(bytes(r.value) for r in back.collect()) == sorted(bytes(r.b) for r in df.collect())


def varint(n):
    n, out = n & (2**64 - 1), b""
    while True:
        byte, n = n & 0x7F, n >> 7
        out += bytes([byte | (0x80 if n else 0)])
        if not n:
            return out


def part(number, body):
    return varint(number << 3 | 2) + varint(len(body)) + body


def example(**features):
    entries = b""
    for name, (kind, values) in features.items():
        if kind == 1:
            body = b"".join(part(1, v) for v in values)
        elif kind == 2:
            body = part(1, struct.pack(f"<{len(values)}f", *values))
        else:
            body = part(1, b"".join(map(varint, values)))
        entries += part(1, part(1, name.encode()) + part(2, part(kind, body)))
    return part(1, entries)


def test_examples(spark, tmp_path):
    data = [example(h=(3, [28]), neg=(3, [-5, 7]), raw=(1, [b"\x00\xff"]), w=(2, [0.5, 1.5])), example(h=(3, [1]), raw=(1, [b""]))]
    path = tmp_path / "x.records"
    path.write_bytes(b"".join(map(frame_record, data)))
    features = {"h": "int64", "neg": "int64[]", "raw": "bytes", "w": "float[]"}
    rows = o.decode_examples(o.framed_records(spark, str(path)), features).orderBy("record").collect()
    assert (rows[0].h, rows[0].neg, bytes(rows[0].raw), rows[0].w) == (28, [-5, 7], b"\x00\xff", [0.5, 1.5])
    assert (rows[1].h, rows[1].neg, rows[1].w) == (1, None, None)
    with pytest.raises(Exception, match="not float"):
        o.decode_examples(o.framed_records(spark, str(path)), {"h": "float"}).collect()
    with pytest.raises(Exception, match="more than one"):
        o.decode_examples(o.framed_records(spark, str(path)), {"neg": "int64"}).collect()


def test_examples_round_trip(spark):
    rows = [(5, [1.5, -2.0], b"x", [2**60 + 1, -1]), (-7, None, None, []), (2**60 + 1, None, b"", [7]), (None, [0.25], b"", [0, 127, 128])]
    df = spark.createDataFrame(rows, "a bigint, w array<float>, b binary, n array<bigint>")
    features = {"a": "int64", "w": "float[]", "b": "bytes", "n": "int64[]"}
    back = [tuple(r) for r in o.decode_examples(o.encode_examples(df, features), features).collect()]
    assert sorted(map(repr, back)) == sorted(map(repr, rows))


def test_file_list_and_read_files(spark, tmp_path):
    for i in range(8):
        (tmp_path / f"f{i}.txt").write_text("".join(f"{i}{c}\n" for c in "abc"))
    glob = str(tmp_path / "*.txt")
    plain = o.file_list(spark, glob, shuffle=False).orderBy("rank").collect()
    assert [r.path[-6:] for r in plain] == [f"f{i}.txt" for i in range(8)]
    mixed = [r.path for r in o.file_list(spark, glob, seed=5).orderBy("rank").collect()]
    assert sorted(mixed) == sorted(r.path for r in plain) and mixed != [r.path for r in plain]
    assert mixed == [r.path for r in o.file_list(spark, glob, seed=5).orderBy("rank").collect()]
    reader = lambda s, paths: o.text_lines(s, paths, with_position=True)
    assert o.read_files(spark, glob, reader).count() == 24
    part = o.read_files(spark, glob, reader, num_shards=4, shard_index=1)
    assert sorted({r.value[0] for r in part.collect()}) == ["1", "5"]
    turns = o.read_files(spark, glob, reader, parallel_files=2, parallel_interleave=2, order_in_file="line")
    got = [r.value for r in turns.orderBy("round", "slot", "block_pos").collect()][:12]
    assert got == ["0a", "0b", "1a", "1b", "0c", "1c", "2a", "2b", "3a", "3b", "2c", "3c"]
    listed = o.read_files(spark, [str(tmp_path / "f1.txt"), str(tmp_path / "f2.txt")], reader)
    assert listed.count() == 6


def test_memory_sources(spark):
    whole = o.tensors_dataset(spark, {"a": [1, 2, 3], "b": "x"})
    assert whole.count() == 1 and whole.first().a == [1, 2, 3]
    slices = o.tensor_slices_dataset(spark, {"a": [1, 2, 3], "b": ["x", "y", "z"]})
    assert [(r.a, r.b) for r in slices.orderBy("pos").collect()] == [(1, "x"), (2, "y"), (3, "z")]
    with pytest.raises(ValueError):
        o.tensor_slices_dataset(spark, {"a": [1, 2], "b": [1]})
    coo = spark.createDataFrame([(0, 0, 1), (1, 2, 2)], "row bigint, col int, value int")
    assert [(r.row, r.entries) for r in o.sparse_slices(coo, 3).orderBy("row").collect()] == [(0, {0: 1}), (1, {2: 2}), (2, {})]
    assert [r.value for r in o.range_dataset(spark, 1, 10, 3, "int").orderBy("value").collect()] == [1, 4, 7]
    assert o.range_dataset(spark).count() == 0
    a, b, c = (
        [r.value for r in o.random_integer_dataset(spark, 50, seed).orderBy("pos").collect()] for seed in (1, 1, 2)
    )
    assert a == b != c and len(set(a)) == 50 and any(v < 0 for v in a) and any(v > 0 for v in a)
    with pytest.raises(ValueError):
        o.random_integer_dataset(spark, None, 1)


def test_sql(spark):
    spark.range(5).selectExpr("id", "cast(id as double) / 2 as half", "concat('n', id) as name").createOrReplaceTempView("t5")
    spec = o.sql_record_spec(["a", "b", "c"], ["int32", "float64", "string"])
    got = o.sql_dataset(spark, "select * from t5 where id > 2", spec)
    assert got.dtypes == [("a", "int"), ("b", "double"), ("c", "string")]
    assert sorted(map(tuple, got.collect())) == [(3, 1.5, "n3"), (4, 2.0, "n4")]
    with pytest.raises(ValueError):
        o.sql_dataset(spark, "select id from t5", spec)
    with pytest.raises(ValueError):
        o.sql_record_spec(["a"], ["float32"])


def test_types_fit_all_rows(spark, tmp_path):
    """A value of another type in the last row counts, however far down it is."""
    path = tmp_path / "rows.csv"
    path.write_text("a,b,c\n" + "".join(f"{i},{i},{i}\n" for i in range(3000)) + "2.5,3000,x\n")
    spec = csv_record_spec(spark, str(path))
    assert spec.types == ("double", "integer", "character")
    assert o.text_lines(spark, str(path), spec).where("a = 2.5 AND c = 'x'").count() == 1
    rows = o.make_csv_dataset(spark, str(path), label_name="c")
    assert rows.where("features.a = 2.5").count() == 1 and rows.count() == 3001
    deep = tmp_path / "deep.csv"
    deep.write_text("note\nmore\n1,2\n3,4.5\n")
    assert csv_record_spec(spark, str(deep), skip=2, names=["a", "b"]).types == ("integer", "double")


def test_files_in_the_given_order(spark, tmp_path):
    for name, lines in (("a", "a1\na2\n"), ("b", ""), ("c", "c1\nc2\n")):
        (tmp_path / f"{name}.txt").write_text(lines)
    files = [str(tmp_path / f"{n}.txt") for n in "cba"]
    reader = lambda s, paths: o.text_lines(s, paths, with_position=True)
    read = lambda paths, **k: [r.value for r in o.read_files(
        spark, paths, reader, order_in_file="line", **k).orderBy("round", "slot", "block_pos").collect()]
    assert read(files, parallel_files=2) == ["c1", "c2", "a1", "a2"]
    assert read(files, parallel_files=3) == ["c1", "a1", "c2", "a2"]
    assert read(files, parallel_files=1, num_shards=3, shard_index=0) == ["c1", "c2"]
    assert read(o.file_list(spark, str(tmp_path), shuffle=False), parallel_files=2) == ["a1", "a2", "c1", "c2"]


def test_csv_dataset_shuffled_in_blocks(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("a,b\n" + "".join(f"{i},{i}\n" for i in range(40)))
    batches = o.make_csv_dataset(spark, str(path), batch_size=10, order_by="a", label_name="b", num_epochs=2, shuffle_seed=4, shuffle_buffer_size=10)
    got = [r.a for r in batches.orderBy("batch_id").collect()]
    assert [sorted(a) for a in got] == [list(range(k, k + 10)) for k in (0, 10, 20, 30)] * 2
    assert got[:4] != got[4:] and got[0] != sorted(got[0])


@pytest.mark.parametrize("compression", ["GZIP", "ZLIB"])
def test_named_compression(spark, tmp_path, compression):
    """The caller's word counts, not the name: lines, numbers, records, joined streams, padding, odd files."""
    pack = {"GZIP": gzip.compress, "ZLIB": zlib.compress}[compression]
    content = {
        "a.txt": "x,1\ny,2\n", "b.gz.old": "é,3\r\n,4\rz,5", "c": "", "d.bin": "\n\nlast\n", "e": "l" * 9_000_000 + "\n" + "m" * 10 + "\r\n"}
    for name, text in content.items():
        (tmp_path / name).write_bytes(pack(text.encode()))
    (tmp_path / "f").write_bytes(pack(b"one\ntw") + pack(b"o\nthree") + bytes(5))
    (tmp_path / "g").write_bytes(b"")
    got = o.text_lines(spark, str(tmp_path), with_position=True, compression=compression).collect()
    lines = {}
    for r in sorted(got, key=lambda r: (r.path, r.line)):
        lines.setdefault(r.path.rsplit("/", 1)[1], []).append((r.line, r.value))
    want = {"a.txt": ["x,1", "y,2"], "b.gz.old": ["é,3", ",4", "z,5"], "d.bin": ["", "", "last"], "e": ["l" * 9_000_000, "m" * 10], "f": ["one", "two", "three"]}
    assert lines == {k: list(enumerate(v)) for k, v in want.items()}
    spec = o.csv_record_spec(names=["a", "b"], types="ci", skip=1)
    pair = [str(tmp_path / "a.txt"), str(tmp_path / "b.gz.old")]
    assert sorted((r.a or "", r.b) for r in o.text_lines(spark, pair, spec, compression=compression).collect()) == [("", 4), ("y", 2), ("z", 5)]
    (tmp_path / "short").write_bytes(pack(content["a.txt"].encode() * 100)[:-6])
    with pytest.raises(Exception, match="ends within"):
        o.text_lines(spark, str(tmp_path / "short"), compression=compression).collect()
    (tmp_path / "plain").write_bytes(b"not packed at all")
    with pytest.raises(Exception):
        o.text_lines(spark, str(tmp_path / "plain"), compression=compression).collect()
    with pytest.raises(ValueError):
        o.text_lines(spark, str(tmp_path), compression="LZ9")


def test_lines_do_not_depend_on_pieces():
    """CR, LF and CR LF end lines wherever the content is cut."""
    from ordinate.sources.text import _lines

    text = b"a\r\nb\rc\n\n\r\r\nd\n\re"
    want = [b"a", b"b", b"c", b"", b"", b"", b"d", b"", b"e"]
    for size in range(1, len(text) + 1):
        assert [line for some in _lines(text[i:i + size] for i in range(0, len(text), size)) for line in some] == want, size
