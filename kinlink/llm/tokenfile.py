"""Token-id files with Elias-Fano encoded document boundaries.

The corpus is range-partitioned by document id and each partition writes
segments of at most about ``segment_ids`` ids.  A segment is one record of a
Parquet folder, so that any store that Spark reaches can hold it:

    doc_ids   ids of its documents, ascending
    bounds    Elias-Fano bytes: the end of each document in the segment
    ids       the concatenated ids, little-endian, 16 bits each where the
              vocabulary allows it and 32 bits otherwise

Elias-Fano bytes: header (values, universe, low bits), the low bits of each
value packed, the high bits as a unary bit vector, and the place of every
256th one bit of it, from which ``select`` walks at most 256 ones.  That is
about 2 + log2(universe / values) bits a document, and no 64-bit offset table.

Defined results: a null or empty text is the end id alone; a null doc_id sorts
first; rows with equal ids are ordered by a hash of their text; an empty table
gives an empty folder; other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinlink.llm.common import count_partitions, shared_dir
from kinlink.llm.encode import Encoder

HEADER, EACH = "<4sBxxxQQ", 256
MAGIC = b"EFB1"


class EliasFano:
    """A non-decreasing sequence below ``universe`` + 1."""

    def __init__(self, n: int, universe: int, width: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.universe, self.width, self.low, self.high, self.samples = n, universe, width, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        values, n = np.asarray(values, dtype=np.uint64), len(values)
        width = max(0, int(universe // max(n, 1)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        vector = np.zeros((int(universe) >> width) + n + 1, dtype=np.uint8)
        vector[ones] = 1
        return cls(n, int(universe), width, low, np.packbits(vector, bitorder="little"), ones[::EACH].astype("<u4"))

    def to_bytes(self) -> bytes:
        return struct.pack(HEADER, MAGIC, self.width, self.n, self.universe) + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, b: bytes) -> EliasFano:
        magic, width, n, universe = struct.unpack_from(HEADER, b)
        if magic != MAGIC:
            raise ValueError("not Elias-Fano bytes")
        low, high = -(-n * width // 8), -(-((universe >> width) + n + 1) // 8)
        data = np.frombuffer(b, dtype=np.uint8, offset=struct.calcsize(HEADER))
        return cls(n, universe, width, data[:low], data[low : low + high], np.frombuffer(data[low + high :].tobytes(), dtype="<u4"))

    def _low(self, i: int) -> int:
        at = i * self.width
        chunk = int.from_bytes(self.low[at // 8 : (at + self.width + 7) // 8].tobytes(), "little")
        return chunk >> at % 8 & (1 << self.width) - 1

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // EACH]), i % EACH
        if left:
            byte, left = at // 8, left + int(self.high[at // 8] & ((1 << at % 8) - 1)).bit_count()
            while left >= (n := int(self.high[byte]).bit_count()):
                left, byte = left - n, byte + 1
            at = 8 * byte + int(np.flatnonzero(np.unpackbits(self.high[byte : byte + 1], bitorder="little"))[left])
        return at - i << self.width | self._low(i)

    def values(self) -> np.ndarray:
        """All values at once."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n] - np.arange(self.n)
        bits = np.unpackbits(self.low, bitorder="little", count=self.n * self.width).reshape(self.n, self.width).astype(np.int64)
        return (ones.astype(np.int64) << self.width) + (bits << np.arange(self.width)).sum(axis=1)


def write(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 0, segment_ids: int = 1 << 20, part_bytes: int = 16 << 20) -> None:
    """Encode ``docs`` and write the segments to ``path`` in ascending doc_id order."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("th")).repartitionByRange(count_partitions(size, part_bytes), "doc_id", "th").sortWithinPartitions("doc_id", "th").select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        encoder, end = Encoder.in_worker(sent.value), end_id.to_bytes(4, "little")
        narrow = max(encoder.n_ids - 1, end_id) < 1 << 16
        part, segment = TaskContext.get().partitionId(), 0
        names, texts, total = [], [], 0

        def flush() -> pa.RecordBatch:
            ends = np.cumsum([len(x) // 4 for x in texts])
            ids = np.frombuffer(b"".join(texts), dtype="<u4")
            bounds = EliasFano.build(ends, int(ends[-1])).to_bytes()
            row = [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([16 if narrow else 32], pa.int32()), pa.array([names], pa.list_(to_arrow_type(kind))), pa.array([bounds], pa.binary()), pa.array([(ids.astype("<u2") if narrow else ids).tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(row, ["part", "segment", "n_ids", "id_bits", "doc_ids", "bounds", "ids"])

        for b in batches:
            keys, column = b.column(0).to_pylist(), b.column(1)
            for at in range(0, len(keys), 10_000):
                for key, ids in zip(keys[at : at + 10_000], encoder.encode(column.slice(at, 10_000)), strict=True):
                    names.append(key)
                    texts.append(ids + end)
                    total += len(ids) // 4 + 1
                    if total >= segment_ids:
                        yield flush()
                        names, texts, total, segment = [], [], 0, segment + 1
        if names:
            yield flush()

    kind_name = kind.simpleString()
    rows.mapInArrow(run, f"part int, segment int, n_ids long, id_bits int, doc_ids array<{kind_name}>, bounds binary, ids binary").write.option("compression", "zstd").parquet(path)


FIELDS = ("part", "segment", "id_bits", "doc_ids", "bounds", "ids")


def documents(b: pa.RecordBatch) -> Iterator[tuple[list[pa.Array], list[memoryview]]]:
    """For each segment: doc_id, part, segment, at and n_tokens of its documents, and their ids with 32 bits each."""
    for i in range(b.num_rows):
        part, segment, bits, names, bounds, ids = (b.column(k)[i] for k in range(len(FIELDS)))
        ends = EliasFano.from_bytes(bounds.as_py()).values()
        starts = np.concatenate([[0], ends[:-1]])
        data = memoryview(np.frombuffer(ids.as_buffer(), dtype="<u2" if bits.as_py() == 16 else "<u4").astype("<u4")).cast("B")
        n = len(ends)
        yield [names.values, pa.array([part.as_py()] * n, pa.int32()), pa.array([segment.as_py()] * n, pa.int32()), pa.array(starts, pa.int64()), pa.array(ends - starts, pa.int64())], [data[4 * s : 4 * e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def decoded(spark: SparkSession, path: str, name: str, kind: str, of) -> DataFrame:
    """The files' documents with one more column, ``of`` their ids as an Arrow array; decoded where they are read."""
    files = spark.read.parquet(path)
    inner = files.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for columns, ids in documents(b):
                yield pa.RecordBatch.from_arrays([*columns, of(ids)], ["doc_id", "part", "segment", "at", "n_tokens", name])

    return files.select(*FIELDS).mapInArrow(run, f"doc_id {inner}, part int, segment int, at long, n_tokens long, {name} {kind}")


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, segment, at (place in the segment), n_tokens, ids (little-endian, 32 bits each), from the files."""
    return decoded(spark, path, "ids", "binary", lambda ids: pa.array([bytes(x) for x in ids], pa.binary()))


GROUP = 1024


def offsets(spark: SparkSession, path: str) -> DataFrame:
    """part, segment, first: ids before each segment.  Sums go up in three steps, so that a window holds a part's segments, the parts of a group, or one row for each ``GROUP`` parts."""
    sizes = spark.read.parquet(path).select("part", "segment", "n_ids").withColumn("group", F.floor(F.col("part") / GROUP).cast("int"))

    def before(d: DataFrame, by: list[str], order: str, name: str) -> DataFrame:
        w = (Window.partitionBy(*by) if by else Window).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return d.select(*by, order, F.coalesce(F.sum("n_ids").over(w), F.lit(0)).alias(name))

    total = lambda *c: sizes.groupBy(*c).agg(F.sum("n_ids").alias("n_ids"))
    groups, parts, own = before(total("group"), [], "group", "a"), before(total("group", "part"), ["group"], "part", "b"), before(sizes, ["group", "part"], "segment", "c")
    return own.join(parts, ["group", "part"]).join(groups, "group").select("part", "segment", (F.col("a") + F.col("b") + F.col("c")).alias("first"))


def lookup(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids of the documents named (a column doc_id), by ``select`` on the boundaries of their segments alone."""
    files = spark.read.parquet(path)
    names = files.select("part", "segment", F.posexplode("doc_ids").alias("place", "doc_id")).join(wanted.select("doc_id").distinct(), "doc_id")
    asked = names.groupBy("part", "segment").agg(F.collect_list(F.struct("doc_id", "place")).alias("asked"))  # at most a segment's documents
    rows = files.select("part", "segment", "id_bits", "bounds", "ids").join(asked, ["part", "segment"])
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                bounds, width, out = EliasFano.from_bytes(r["bounds"]), r["id_bits"] // 8, []
                for x in r["asked"]:
                    begin, end = bounds.select(x["place"] - 1) if x["place"] else 0, bounds.select(x["place"])
                    ids = np.frombuffer(r["ids"], dtype=f"<u{width}", count=end - begin, offset=begin * width)
                    out.append((x["doc_id"], begin, end - begin, ids.astype("<u4").tobytes()))
                n, columns = len(out), list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array([r["part"]] * n, pa.int32()), pa.array([r["segment"]] * n, pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary())], ["doc_id", "part", "segment", "at", "n_tokens", "ids"])

    found = rows.mapInArrow(run, f"doc_id {kind}, part int, segment int, at long, n_tokens long, ids binary")
    return found.join(offsets(spark, path), ["part", "segment"]).select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids")


def boundaries(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32, from the files."""
    rows = decoded(spark, path, "ids_crc32", "long", lambda ids: pa.array(map(zlib.crc32, ids), pa.int64()))
    return rows.join(offsets(spark, path), ["part", "segment"]).select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write the files to a new folder of the shared space and read their boundaries back."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write(docs, tokenizer_path, path, end_id)
    return boundaries(spark, path)
