import json
import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from medley.sources import avro, typed

SCHEMA = "i int, l long, f float, d double, b boolean, s string"


def rows(n=500):
    r = random.Random(4)
    pick = lambda x: None if r.random() < 0.2 else x
    edge = [(2**31 - 1, 2**63 - 1, 0.5, 1e300, True, ""), (-(2**31), -(2**63), -0.25, -0.0, False, "ü語😀" * 50), (0, 0, 0.0, 0.0, None, None), (None,) * 6, (-1, -64, 1.5, 2.5, True, "x")]
    return edge + [
        (pick(r.randrange(-(2**31), 2**31)), pick(r.randrange(-(2**63), 2**63)), pick(r.randrange(1000) / 4), pick(r.random()), pick(r.random() < 0.5), pick("é" * r.randrange(200)))
        for _ in range(n)
    ]


def plain(path):
    """One file read byte by byte, without compression."""
    data = path.read_bytes()
    at = 4

    def number():
        nonlocal at
        z = shift = 0
        while True:
            b = data[at]
            at += 1
            z |= (b & 127) << shift
            shift += 7
            if b < 128:
                return (z >> 1) ^ -(z & 1)

    def take(n):
        nonlocal at
        at += n
        return data[at - n : at]

    assert data[:4] == b"Obj\x01"
    meta = {}
    while n := number():
        for _ in range(n):
            k = take(number()).decode()
            meta[k] = take(number())
    sync, out = take(16), []
    kinds = [f["type"][1] for f in json.loads(meta["avro.schema"])["fields"]]
    while at < len(data):
        count, size = number(), number()
        end = at + size
        for _ in range(count):
            row = []
            for kind in kinds:
                if number() == 0:
                    row.append(None)
                elif kind == "string":
                    row.append(take(number()).decode())
                elif kind == "boolean":
                    row.append(take(1) == b"\x01")
                else:
                    row.append(number() if kind in ("int", "long") else struct.unpack("<f" if kind == "float" else "<d", take(4 if kind == "float" else 8))[0])
            out.append(tuple(row))
        assert at == end and take(16) == sync
    return out


def test_written_files_read_by_a_plain_reader(spark, tmp_path):
    want = rows()
    avro.write(spark.createDataFrame(want, SCHEMA).coalesce(1), str(tmp_path / "a"), "null")
    (file,) = (tmp_path / "a").glob("*.avro")
    assert plain(file) == want


@pytest.mark.parametrize("codec", ["snappy", "deflate", "null"])
def test_round_trip_and_splits(spark, tmp_path, monkeypatch, codec):
    want = sorted(rows(), key=repr)
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 20)
    try:
        avro.write(df, str(tmp_path / "a"), codec)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for split in (1 << 25, 1000, 37):
        got = avro.read(spark, str(tmp_path / "a"), split)
        assert got.schema.simpleString() == df.schema.simpleString()
        assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert avro.read(spark, str(tmp_path / "a"), 1000).select(F.spark_partition_id().alias("p")).distinct().count() > 6
    avro.write(df.limit(5), str(tmp_path / "a"), codec, "append")
    assert avro.read(spark, str(tmp_path / "a")).count() == len(want) + 5
    avro.write(df.limit(0), str(tmp_path / "a"), codec)
    assert avro.read(spark, str(tmp_path / "a")).count() == 0


def test_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="date"):
        avro.write(spark.sql("SELECT current_date() AS d"), str(tmp_path / "d"))
    with pytest.raises(ValueError, match="format"):
        typed.csv_to_typed(spark, "x", str(tmp_path / "t"), [("a", "int")], fmt="nosuch")
    (tmp_path / "x.avro").write_bytes(b"something else")
    with pytest.raises(Exception, match="not an Avro"):
        avro.read(spark, str(tmp_path / "x.avro")).collect()


def test_a_damaged_block_is_an_error():
    packed = bytearray(avro.squeezed(b"some records" * 20, "snappy"))
    assert avro.opened(bytes(packed), "snappy") == b"some records" * 20
    packed[-1] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        avro.opened(bytes(packed), "snappy")


def test_fields_that_are_never_null():
    schema, plan = avro.schema_of('{"type":"record","name":"r","fields":[{"name":"a","type":"long"},{"name":"s","type":["string","null"]}]}')
    blocks = [(2, bytes([2, 0, 2]) + b"x" + bytes([4, 2])), (1, bytes([3, 0, 0]))]
    batch = avro.decoded(blocks, plan, pa.schema([("a", pa.int64()), ("s", pa.string())]))
    assert schema.names == ["a", "s"] and batch.to_pydict() == {"a": [1, 2, -2], "s": ["x", None, ""]}
