"""SimHash near-dedup by multi-index hashing.

A fingerprint is cut into two segments of 32 bits.  Two fingerprints that
differ in at most two bits differ in at most one bit in one of the segments
(pigeonhole), so the Hamming ball of radius one around each segment value is
enumerated, looked up in the segment's table, and every match is verified on
all 64 bits.  Of a pair, one side has the 0 where the segments differ, so only
flips from 0 to 1 are enumerated and each such pair is fetched once.

Segment values shared by more than ``heavy`` fingerprints would make pairs grow
with the square of the bucket.  For these, an exact linear way is taken:
fingerprints that differ in at most two bits share a point within one bit of
both, so each emits its 65 points and is linked to the least fingerprint at
each point.

Defined results: null or empty texts and texts without a word have fingerprint
zero, linked like any other; exact copies share one fingerprint and are never
expanded into pairs; rows with a null doc_id get the component of their
fingerprint; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.llm.common import stored
from kinlink.llm.graph import components

SEED, BITS, SEGMENT = 42, 64, 32


def fingerprint(text: bytes | None, words_each: int) -> int:
    words = (text or b"").lower().split()  # bytes.split and bytes.lower know ASCII only
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    spans = map(b" ".join, zip(*(words[i:] for i in range(words_each)), strict=False)) if len(words) >= words_each else [b" ".join(words)]
    bits = np.frombuffer(b"".join([digest(s, SEED) for s in spans]), dtype=np.uint8).reshape(-1, 8)
    ones = np.unpackbits(bits, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(bits)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words_each: int = 5) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(t, words_each) for t in b.column(1).to_pylist()], pa.int64())], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, f"doc_id {kind}, fp long")


def _segment(i: int):
    return F.shiftrightunsigned("fp", SEGMENT * i).bitwiseAND(F.lit((1 << SEGMENT) - 1))


def _far(max_bits: int):
    return F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits


def links(fps: DataFrame, max_bits: int = 2, heavy: int = 64) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within ``max_bits`` <= 2 bits; fps: distinct fp."""
    if not 0 <= max_bits <= 2:
        raise ValueError("two segments with balls of radius one find at most two differing bits")
    spread = F.array(*(F.struct(F.lit(i).alias("s"), _segment(i).alias("v")) for i in range(BITS // SEGMENT)))
    tables = fps.select("fp", F.explode(spread).alias("x")).select("fp", "x.s", "x.v")
    crowded = stored(tables.groupBy("s", "v").count().filter(F.col("count") > heavy).select("s", "v"), "simhash-heavy")
    some = not crowded.isEmpty()
    flips = F.filter(F.sequence(F.lit(0), F.lit(SEGMENT - 1)), lambda k: F.expr("v").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), k)) == 0)
    ball = F.transform(flips, lambda k: F.col("v").bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), k)))
    probes = tables.select("fp", "s", F.explode(F.concat(F.array("v"), ball)).alias("at"), F.col("v").alias("own"))
    light = (tables.join(crowded, ["s", "v"], "left_anti") if some else tables).select(F.col("fp").alias("other"), F.col("s").alias("os"), F.col("v").alias("ov"))
    found = probes.join(light, (F.col("s") == F.col("os")) & (F.col("at") == F.col("ov")))
    found = found.filter(((F.col("at") != F.col("own")) | (F.col("fp") < F.col("other"))) & _far(max_bits)).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    if not some:
        return found
    dense = probes.join(crowded.withColumnRenamed("v", "at"), ["s", "at"], "left_semi").select("fp").distinct()
    points = dense.select("fp", F.explode(F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda k: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k))))).alias("at"))
    least = points.groupBy("at").agg(F.min("fp").alias("other"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("at", "other")
    near = points.join(least, "at").filter(F.col("fp") != F.col("other"))
    if max_bits == 1:  # points in the middle join fingerprints two bits apart; those with an end in the middle suffice
        near = points.alias("p").join(dense.select(F.col("fp").alias("other")), F.col("at") == F.col("other")).filter(F.col("fp") != F.col("other"))
    return found.unionByName(near.filter(_far(max_bits)).select(F.col("fp").alias("a"), F.col("other").alias("b")))


def near_duplicates(docs: DataFrame, words_each: int = 5, max_bits: int = 2) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id that links reach."""
    own = stored(fingerprints(docs, words_each), "simhash-docs")
    fps = stored(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-fps")
    roots = components(links(fps.select("fp"), max_bits))
    known = fps.join(roots, fps.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = known.groupBy("root").agg(F.min("first").alias("component_id"))
    return own.join(known.join(named, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")
