"""Avro object container files, written and read as Arrow batches by a data source of Spark's Python interface.

A file is a header, with the schema as JSON, and blocks of records, each followed by the file's sync marker, at which it can
be split. Records are encoded column by column; on reading, the blocks of a split are decoded side by side, so that one step
takes a field of every block. Paths may be of any file system that pyarrow opens, and must be reachable for every executor.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

MAGIC = b"Obj\x01"
SYNC = 16
BLOCK_ROWS = 2_000
SPLIT = 32 << 20
READ = 1 << 20
SIDE_BY_SIDE = 64
# The format's names of the types that are written.
KINDS = {"string": T.StringType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType()}
Piece = tuple[np.ndarray, np.ndarray]


def schema_json(schema: T.StructType, name: str = "record") -> str:
    """A schema as the format's JSON; every field may be null. Other types are refused."""
    names = {v.simpleString(): k for k, v in KINDS.items()}
    bad = [f"{f.name}: {f.dataType.simpleString()}" for f in schema.fields if f.dataType.simpleString() not in names]
    if bad:
        raise ValueError(f"types that cannot be written as Avro: {bad}")
    fields = [{"name": f.name, "type": ["null", names[f.dataType.simpleString()]], "default": None} for f in schema.fields]
    return json.dumps({"type": "record", "name": name, "fields": fields})


def schema_of(text: str) -> tuple[T.StructType, list[tuple[str, int]]]:
    """Spark's schema of the JSON, and of each field its type and the branch that is null (-1: never null)."""
    held, fields, plan = json.loads(text), [], []
    for f in held["fields"]:
        branches = f["type"] if isinstance(f["type"], list) else [f["type"]]
        kinds = [b for b in branches if b != "null"]
        if held.get("type") != "record" or len(kinds) != 1 or len(branches) > 2 or kinds[0] not in KINDS:
            raise ValueError(f"field {f['name']} of type {f['type']} cannot be read")
        fields.append(T.StructField(f["name"], KINDS[kinds[0]], True))
        plan.append((kinds[0], branches.index("null") if "null" in branches else -1 if not isinstance(f["type"], list) else 2))
    return T.StructType(fields), plan


def varints(values: np.ndarray) -> Piece:
    """Signed numbers as zigzag varints: bytes and lengths."""
    v = values.astype(np.int64)
    z = ((v << 1) ^ (v >> 63)).view(np.uint64)
    groups = np.stack([(z >> np.uint64(7 * k)).astype(np.uint64) for k in range(10)], axis=1)
    size = np.maximum(1, (groups > 0).sum(axis=1))
    used = np.arange(10) < size[:, None]
    more = np.arange(10) < size[:, None] - 1
    return ((groups & np.uint64(127)).astype(np.uint8) | (more * np.uint8(128)).astype(np.uint8))[used], size.astype(np.int64)


def interleaved(pieces: list[Piece]) -> np.ndarray:
    """The bytes of several columns, record by record."""
    total = sum(size for _, size in pieces)
    start = np.cumsum(total) - total
    out = np.empty(int(total.sum()), np.uint8)
    for flat, size in pieces:
        own = np.cumsum(size) - size
        out[np.repeat(start - own, size) + np.arange(len(flat))] = flat
        start = start + size
    return out


def encoded(column: pa.Array) -> list[Piece]:
    """A column as its union branch and its values; nulls have no value bytes."""
    here = column.is_valid().to_numpy(zero_copy_only=False)
    branch = (np.where(here, np.uint8(2), np.uint8(0)), np.ones(len(column), np.int64))
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        texts = column.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        flat, size = varints(np.diff(offsets)[here])
        count = np.zeros(len(column), np.int64)
        count[here] = size
        return [branch, (flat, count), (data, np.diff(offsets))]
    count = np.zeros(len(column), np.int64)
    valid = column.drop_null()
    if pa.types.is_integer(column.type):
        flat, count[here] = varints(valid.to_numpy(zero_copy_only=False))
    else:
        values = valid.to_numpy(zero_copy_only=False)
        values = values.astype(np.uint8) if pa.types.is_boolean(column.type) else values.astype("<f4" if pa.types.is_float32(column.type) else "<f8")
        flat, count[here] = np.frombuffer(values.tobytes(), np.uint8), values.itemsize
    return [branch, (flat, count)]


def long(value: int) -> bytes:
    return varints(np.array([value]))[0].tobytes()


def header(schema: str, codec: str, sync: bytes) -> bytes:
    entries = {"avro.schema": schema.encode(), "avro.codec": codec.encode()}
    packed = b"".join(long(len(k)) + k.encode() + long(len(v)) + v for k, v in entries.items())
    return MAGIC + long(len(entries)) + packed + b"\0" + sync


def squeezed(data: bytes, codec: str) -> bytes:
    if codec == "snappy":
        return pa.Codec("snappy").compress(data, asbytes=True) + zlib.crc32(data).to_bytes(4, "big")
    if codec == "deflate":
        packer = zlib.compressobj(wbits=-15)
        return packer.compress(data) + packer.flush()
    return data


def opened(data: bytes, codec: str) -> bytes:
    """A block's records; one that does not fit its checksum is an error."""
    if codec == "snappy":
        size, shift = 0, 0
        for b in data:  # the length stands in front, as a plain varint
            size |= (b & 127) << shift
            shift += 7
            if b < 128:
                break
        out = pa.Codec("snappy").decompress(data[:-4], size, asbytes=True)
        if zlib.crc32(out) != int.from_bytes(data[-4:], "big"):
            raise ValueError("a block does not fit its checksum")
        return out
    return zlib.decompress(data, wbits=-15) if codec == "deflate" else data


class Side:
    """Blocks decoded side by side: one buffer, and the place reached in each."""

    def __init__(self, blocks: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(blocks) + bytes(16), np.uint8)
        size = np.array([len(b) for b in blocks], np.int64)
        self.at = np.cumsum(size) - size

    def varint(self, rows: np.ndarray) -> np.ndarray:
        z, shift, left = np.zeros(len(rows), np.uint64), 0, np.arange(len(rows))
        while len(left):
            b = self.data[self.at[rows[left]]]
            z[left] |= (b & 127).astype(np.uint64) << np.uint64(shift)
            self.at[rows[left]] += 1
            left, shift = left[b > 127], shift + 7
        return (z >> np.uint64(1)).view(np.int64) ^ -(z & np.uint64(1)).view(np.int64)

    def fixed(self, rows: np.ndarray, kind: str) -> np.ndarray:
        width = np.dtype(kind).itemsize
        found = self.data[self.at[rows][:, None] + np.arange(width)]
        self.at[rows] += width
        return np.ascontiguousarray(found).view(kind)[:, 0]


def decoded(blocks: list[tuple[int, bytes]], plan: list[tuple[str, int]], schema: pa.Schema) -> pa.RecordBatch:
    """The records of blocks (count, bytes) as one batch, block after block."""
    side, counts = Side([b for _, b in blocks]), np.array([n for n, _ in blocks], np.int64)
    base = np.cumsum(counts) - counts
    total = int(counts.sum())
    forms = {"boolean": "u1", "int": "i8", "long": "i8", "float": "<f4", "double": "<f8"}
    columns = [np.zeros((total, 2), np.int64) if kind == "string" else np.zeros(total, forms[kind]) for kind, _ in plan]
    missing = [np.zeros(total, bool) for _ in plan]
    for step in range(int(counts.max()) if len(counts) else 0):
        live = np.flatnonzero(counts > step)
        for (kind, null), column, gone in zip(plan, columns, missing, strict=True):
            rows = live
            if null >= 0:
                absent = side.varint(live) == null
                gone[base[live[absent]] + step] = True
                rows = live[~absent]
            to = base[rows] + step
            if kind == "string":
                size = side.varint(rows)
                column[to, 0], column[to, 1] = side.at[rows], size
                side.at[rows] += size
            else:
                column[to] = side.varint(rows) if kind in ("int", "long") else side.fixed(rows, forms[kind])
    out = []
    for (kind, _), column, gone, field in zip(plan, columns, missing, schema, strict=True):
        if kind == "string":
            start, size = column[:, 0], column[:, 1]
            offsets = np.concatenate([[0], np.cumsum(size)])
            flat = side.data[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]
            texts = pa.Array.from_buffers(pa.large_string(), total, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat)])
            out.append(pa.compute.if_else(pa.array(gone), None, texts).cast(field.type))
        else:
            values = column.astype(bool) if kind == "boolean" else column
            out.append(pa.array(values, mask=gone).cast(field.type))
    return pa.RecordBatch.from_arrays(out, schema=schema)


def place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class Scan:
    """Bytes of a file from some place on, read ahead in pieces."""

    def __init__(self, file: pa.NativeFile, at: int, size: int) -> None:
        self.file, self.at, self.size, self.held = file, at, size, b""

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.at + len(self.held) < self.size:
            self.held += self.file.read_at(min(max(READ, n - len(self.held)), self.size - self.at - len(self.held)), self.at + len(self.held))
        out, self.held = self.held[:n], self.held[n:]
        self.at += len(out)
        if len(out) < n:
            raise ValueError("the file ends inside a block")
        return out

    def long(self) -> int:
        z, shift = 0, 0
        while True:
            b = self.take(1)[0]
            z |= (b & 127) << shift
            shift += 7
            if b < 128:
                return (z >> 1) ^ -(z & 1)

    def after(self, mark: bytes) -> bool:
        """Go behind the next marker; False if there is none."""
        while True:
            found = self.held.find(mark)
            if found >= 0:
                self.take(found + len(mark))
                return True
            keep = len(mark) - 1
            self.at, self.held = self.at + max(0, len(self.held) - keep), self.held[-keep:]
            more = min(READ, self.size - self.at - len(self.held))
            if more <= 0:
                return False
            self.held += self.file.read_at(more, self.at + len(self.held))


def read_header(scan: Scan) -> tuple[str, str, bytes]:
    """Schema, codec and sync marker."""
    if scan.take(4) != MAGIC:
        raise ValueError("not an Avro container file")
    held = {}
    while n := scan.long():
        if n < 0:
            scan.long()
        for _ in range(abs(n)):
            key = scan.take(scan.long()).decode()
            held[key] = scan.take(scan.long())
    codec = held.get("avro.codec", b"null").decode()
    if codec not in ("null", "deflate", "snappy"):
        raise ValueError(f"codec {codec} cannot be read")
    return held["avro.schema"].decode(), codec, scan.take(SYNC)


def files(path: str) -> list[tuple[str, int]]:
    """Path and size of each file of a folder, or of the file."""
    system, root = place(path)
    info = system.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [(path, info.size)]
    found = system.get_file_info(pafs.FileSelector(root))
    return sorted((f"{path.rstrip('/')}/{f.base_name}", f.size) for f in found if f.is_file and not f.base_name.startswith(("_", ".")))


@dataclass
class Part(InputPartition):
    """The blocks of a file that begin between two offsets."""

    path: str
    start: int
    end: int
    size: int


class Reader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, split: int) -> None:
        self.path, self.names, self.split = path, schema, split

    def partitions(self) -> list[Part]:
        return [Part(p, a, min(a + self.split, size), size) for p, size in files(self.path) for a in range(0, size, self.split)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        system, root = place(partition.path)
        with system.open_input_file(root) as file:
            scan = Scan(file, 0, partition.size)
            text, codec, sync = read_header(scan)
            own, plan = schema_of(text)
            if own.simpleString() != self.names.simpleString():
                raise ValueError(f"{partition.path} holds {own.simpleString()}, not {self.names.simpleString()}")
            arrow = to_arrow_schema(own)
            if partition.start > scan.at:
                # a marker that begins before the split's start belongs to the block before it
                scan = Scan(file, max(scan.at - SYNC, partition.start - SYNC), partition.size)
                if not scan.after(sync):
                    return
            blocks: list[tuple[int, bytes]] = []
            while scan.at < partition.end and scan.at < partition.size:
                count, size = scan.long(), scan.long()
                blocks.append((count, opened(scan.take(size), codec)))
                if scan.take(SYNC) != sync:
                    raise ValueError(f"{partition.path}: a block does not end with the file's marker")
                if len(blocks) == SIDE_BY_SIDE:
                    yield decoded(blocks, plan, arrow)
                    blocks = []
            if blocks:
                yield decoded(blocks, plan, arrow)


@dataclass
class Written(WriterCommitMessage):
    name: str


class Writer(DataSourceArrowWriter):
    """Each task writes one file aside; those of the tasks that count are moved in when all are done."""

    def __init__(self, path: str, schema: T.StructType, codec: str, overwrite: bool) -> None:
        self.path, self.schema, self.codec, self.overwrite = path, schema_json(schema), codec, overwrite
        if codec not in ("null", "deflate", "snappy"):
            raise ValueError(f"codec {codec} cannot be written")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = place(self.path)
        name, sync, out = f"part-{uuid.uuid4().hex}.avro", uuid.uuid4().bytes, None
        system.create_dir(f"{root}/_temporary")
        for batch in iterator:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                rows = batch.slice(low, BLOCK_ROWS)
                if out is None:
                    out = system.open_output_stream(f"{root}/_temporary/{name}", compression=None)
                    out.write(header(self.schema, self.codec, sync))
                packed = squeezed(interleaved([p for c in rows.columns for p in encoded(c)]).tobytes(), self.codec)
                out.write(long(rows.num_rows) + long(len(packed)) + packed + sync)
        if out is None:  # a task without rows leaves the schema, so that an empty table can be read
            out = system.open_output_stream(f"{root}/_temporary/{name}", compression=None)
            out.write(header(self.schema, self.codec, sync))
        out.close()
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = place(self.path)
        old = [f.path for f in system.get_file_info(pafs.FileSelector(root)) if f.is_file] if self.overwrite else []
        for m in messages:
            if m is not None:
                system.move(f"{root}/_temporary/{m.name}", f"{root}/{m.name}")
        for path in old:
            system.delete_file(path)
        system.delete_dir(f"{root}/_temporary")

    def abort(self, messages: list[Written | None]) -> None:
        system, root = place(self.path)
        if system.get_file_info(f"{root}/_temporary").type == pafs.FileType.Directory:
            system.delete_dir(f"{root}/_temporary")


class AvroSource(DataSource):
    """[S15, S16] `spark.read.format("medley_avro").load(path)`, and the same to write; options `codec` and `split`."""

    @classmethod
    def name(cls) -> str:
        return "medley_avro"

    def schema(self) -> T.StructType:
        found = files(self.options["path"])
        if not found:
            raise ValueError(f"no files in {self.options['path']}")
        system, root = place(found[0][0])
        with system.open_input_file(root) as file:
            return schema_of(read_header(Scan(file, 0, found[0][1]))[0])[0]

    def reader(self, schema: T.StructType) -> Reader:
        return Reader(self.options["path"], schema, int(self.options.get("split", SPLIT)))

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        return Writer(self.options["path"], schema, self.options.get("codec", "snappy"), overwrite)


def read(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """[S16] Avro files as a frame; files are split at sync markers into parts of about `split` bytes."""
    spark.dataSource.register(AvroSource)
    return spark.read.format(AvroSource.name()).option("split", str(split)).load(path)


def write(df: DataFrame, path: str, codec: str = "snappy", mode: str = "overwrite") -> None:
    """[S15] A frame as Avro files, one a task; types other than text, truth values and numbers are refused."""
    schema_json(df.schema)
    df.sparkSession.dataSource.register(AvroSource)
    df.write.format(AvroSource.name()).option("codec", codec).mode(mode).save(path)
