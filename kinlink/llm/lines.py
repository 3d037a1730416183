"""Line dedup: sharded cuckoo filters backed by exact reference-count tables.

``LineIndex`` keeps, for every distinct line key, in how many documents it
stands (the reference-count table, exact, hash-sharded), and for the keys that
reach ``min_docs`` one cuckoo filter per shard.  Documents can be added and
deleted: counts change by +1 or -1, keys that cross the threshold are inserted
in or deleted from the filter of their shard.  Lines of a document are first
probed against the filter of their shard; only hits go on to the exact table,
so a false positive of the filter never drops a line.

Defined results: a null or empty text is one empty line; an empty key (white
space only) is never dropped; repeated rows of the input count as documents of
their own; an empty table gives an empty result; columns other than the id and
the text are carried through untouched by ``filter_documents``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.llm.common import SPACE_BYTES, count_partitions, stored

SLOTS, KICKS = 4, 500
KEY_BYTES = 16


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE_BYTES).lower()


def key_hash(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=KEY_BYTES).digest()


class CuckooFilter:
    """Partial-key cuckoo filter over 16-byte keys: 16-bit fingerprints, four to a bucket."""

    def __init__(self, buckets: np.ndarray):
        self.buckets = buckets

    @classmethod
    def sized(cls, n: int) -> CuckooFilter:
        rows = 1 << max(1, int(np.ceil(np.log2(max(n, 1) / (SLOTS * 0.85)))))
        return cls(np.zeros((rows, SLOTS), dtype=np.uint16))

    @classmethod
    def build(cls, keys: np.ndarray) -> CuckooFilter:
        f = cls.sized(len(keys))
        while not all(f.insert(*x) for x in zip(*f.places(keys), strict=True)):
            f = cls(np.zeros((2 * len(f.buckets), SLOTS), dtype=np.uint16))
        return f

    @classmethod
    def from_bytes(cls, b: bytes) -> CuckooFilter:
        return cls(np.frombuffer(b, dtype="<u2").reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.buckets.astype("<u2").tobytes()

    def alternate(self, i, fp):
        return (i ^ (fp.astype(np.uint64) * np.uint64(0x5BD1E995))) & np.uint64(len(self.buckets) - 1)

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First bucket and fingerprint (never 0) of each row of (n, 16) key bytes."""
        words = np.ascontiguousarray(keys).view("<u8")
        fp = (words[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
        fp[fp == 0] = 1
        return (words[:, 1] >> np.uint64(16)) & np.uint64(len(self.buckets) - 1), fp

    def insert(self, i: np.uint64, fp: np.uint16) -> bool:
        for at in (i, self.alternate(i, fp)):
            free = np.flatnonzero(self.buckets[at] == 0)
            if len(free):
                self.buckets[at, free[0]] = fp
                return True
        at = i
        for kick in range(KICKS):
            slot = kick % SLOTS
            fp, self.buckets[at, slot] = self.buckets[at, slot], fp
            at = self.alternate(at, fp)
            free = np.flatnonzero(self.buckets[at] == 0)
            if len(free):
                self.buckets[at, free[0]] = fp
                return True
        return False

    def delete(self, i: np.uint64, fp: np.uint16) -> bool:
        for at in (i, self.alternate(i, fp)):
            there = np.flatnonzero(self.buckets[at] == fp)
            if len(there):
                self.buckets[at, there[0]] = 0
                return True
        return False

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, dtype=bool)
        i, fp = self.places(keys)
        return ((self.buckets[i] == fp[:, None]) | (self.buckets[self.alternate(i, fp)] == fp[:, None])).any(axis=1)


def as_rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """(n, 16) bytes of a binary column without nulls."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, KEY_BYTES)


def with_text_hash(docs: DataFrame) -> DataFrame:
    """Rows are known by id and text together, as ids may be null or repeat."""
    return docs.withColumn("__th", F.xxhash64("text"))


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row for each document and distinct key: doc_id, th, key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys = [], []
            for i, text in enumerate(b.column(2).to_pylist()):
                own = {k for k in map(line_key, set((text or b"").split(b"\n"))) if k and (min_chars < 2 or len(k.decode()) >= min_chars)}
                keys += map(key_hash, own)
                ids += [i] * len(own)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids, pa.int32())), b.column(1).take(pa.array(ids, pa.int32())), pa.array(keys, pa.binary())], ["doc_id", "th", "key"])

    rows = with_text_hash(docs.select("doc_id", "text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "__th", F.col("text").cast("binary")).mapInArrow(run, f"doc_id {kind}, th long, key binary")


def shard_of(n: int):
    return F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")


def build_filters(hot: DataFrame, shards: int) -> DataFrame:
    def run(key: tuple, t: pa.Table) -> pa.Table:
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": [CuckooFilter.build(as_rows(t.column("key"))).to_bytes()]})

    return hot.select("key", shard_of(shards).alias("shard")).groupBy("shard").applyInArrow(run, "shard int, filter binary")


@dataclass(frozen=True)
class LineIndex:
    """refs: key, n (exact, keys with n > 0); filters: shard, filter."""

    refs: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int
    min_chars: int

    @classmethod
    def build(cls, docs: DataFrame, min_docs: int = 10, min_chars: int = 1, occ: DataFrame | None = None, per_shard: int = 200_000) -> LineIndex:
        occ = occurrences(docs, min_chars) if occ is None else occ
        refs = stored(occ.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "line-refs")
        shards = count_partitions(refs.filter(F.col("n") >= min_docs).count(), per_shard, 16)
        filters = stored(build_filters(refs.filter(F.col("n") >= min_docs), shards), "line-filters")
        return cls(refs, filters, shards, min_docs, min_chars)

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._change(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        """Take documents out again that were inserted before."""
        return self._change(docs, -1)

    def _change(self, docs: DataFrame, sign: int) -> LineIndex:
        delta = occurrences(docs, self.min_chars).groupBy("key").agg((sign * F.count(F.lit(1))).alias("d"))
        both = stored(self.refs.join(delta, "key", "full").select("key", F.coalesce("n", F.lit(0)).alias("was"), (F.coalesce("n", F.lit(0)) + F.coalesce("d", F.lit(0))).alias("n")), "line-change")
        crossed = both.filter((F.col("was") >= self.min_docs) != (F.col("n") >= self.min_docs)).select("key", shard_of(self.shards).alias("shard"), (F.col("n") >= self.min_docs).alias("up"))

        def run(key: tuple, old: pa.Table, moved: pa.Table) -> pa.Table:
            f = CuckooFilter.from_bytes(old.column("filter")[0].as_py()) if old.num_rows else CuckooFilter.sized(moved.num_rows)
            up = np.array(moved.column("up").to_pylist(), dtype=bool)
            rows = as_rows(moved.column("key")) if moved.num_rows else np.zeros((0, KEY_BYTES), np.uint8)
            if len(rows):
                i, fp = f.places(rows)
                for k in np.flatnonzero(~up):
                    f.delete(i[k], fp[k])
                if not all(f.insert(i[k], fp[k]) for k in np.flatnonzero(up)):
                    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([None], pa.binary())})
            return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": [f.to_bytes()]})

        changed = stored(self.filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInArrow(run, "shard int, filter binary"), "line-filters")
        refs = both.filter("n > 0").select("key", "n")
        full = changed.filter("filter is null").select("shard")  # filters that have grown too full are built anew from the exact table
        anew = build_filters(refs.filter(F.col("n") >= self.min_docs).withColumn("shard", shard_of(self.shards)).join(full, "shard", "left_semi").select("key"), self.shards)
        return replace(self, refs=refs, filters=stored(changed.filter("filter is not null").unionByName(anew), "line-filters"))

    def probe(self, occ: DataFrame, per_group: int = 500_000) -> DataFrame:
        """The occurrences whose key a filter holds: all hot ones, and a few others.

        A group is one shard and one salt of the documents, so a key that
        stands in most documents is dealt over all salts.
        """
        salts = count_partitions(occ.count(), per_group, 8)

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            rows = left.select(["doc_id", "th", "key"])
            if not right.num_rows or not left.num_rows:
                return rows.slice(0, 0)
            f = CuckooFilter.from_bytes(right.column("filter")[0].as_py())
            return rows.filter(pa.array(f.contains(as_rows(left.column("key")))))

        kind = occ.schema["doc_id"].dataType.simpleString()
        left = occ.withColumn("shard", shard_of(self.shards)).withColumn("salt", F.pmod(F.xxhash64("doc_id", "th"), F.lit(salts)).cast("int"))
        right = self.filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return left.groupBy("shard", "salt").cogroup(right.groupBy("shard", "salt")).applyInArrow(run, f"doc_id {kind}, th long, key binary")

    def dropped_keys(self, occ: DataFrame) -> DataFrame:
        """doc_id, th, keys: the keys that each document loses, checked against the exact table."""
        hot = self.refs.filter(F.col("n") >= self.min_docs).select("key")
        return self.probe(occ).join(hot, "key").groupBy("doc_id", "th").agg(F.collect_set("key").alias("keys"))


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (text): lines found in ``min_docs`` documents or more go everywhere."""
    occ = stored(occurrences(docs, min_chars), "line-occurrences")
    return filter_documents(docs.select("doc_id", "text"), LineIndex.build(docs, min_docs, min_chars, occ), occ)


def filter_documents(docs: DataFrame, index: LineIndex, occ: DataFrame | None = None) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept, the text without the lines whose key is hot in ``index``."""
    occ = occurrences(docs, index.min_chars) if occ is None else occ
    drops = index.dropped_keys(occ).toDF("__id", "__dth", "__keys")
    names, at = docs.columns, (docs.columns.index("doc_id"), docs.columns.index("text"))
    own = [f"c{i}" for i in range(len(names))]  # columns are carried by position, whatever their names
    rows = docs.toDF(*own).withColumn("__th", F.xxhash64(own[at[1]]))
    joined = rows.join(drops, F.col(own[at[0]]).eqNullSafe(F.col("__id")) & (F.col("__th") == F.col("__dth")), "left").select(*own, "__keys")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_lines, n_dropped, kept = [], [], []
            for text, keys in zip(b.column(at[1]).cast(pa.binary()).to_pylist(), b.column("__keys").to_pylist(), strict=True):
                lines = (text or b"").split(b"\n")
                stay = lines
                if keys:
                    gone = set(keys)
                    stay = [x for x in lines if not ((k := line_key(x)) and key_hash(k) in gone)]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(own))), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], [*own, "n_lines", "n_dropped", "kept"])

    kinds = ", ".join(f"{c} {x.dataType.simpleString()}" for c, x in zip(own, docs.schema, strict=True))
    return joined.mapInArrow(run, f"{kinds}, n_lines long, n_dropped long, kept string").toDF(*names, "n_lines", "n_dropped", "kept")
