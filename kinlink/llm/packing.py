"""Packing into sequences by cutting-stock column generation.

Every document is encoded and closed with an end id.  It is cut into whole
sequences and one rest; a sequence's length in units of ``grain`` tokens is the
stock, and the histogram of the rests (at most ``seq_len / grain`` bins) is the
demand.  The linear program over patterns is solved on the driver from that
histogram alone.  Pieces are then ranked within their bin, by counts over small
salted groups, and rank r of a bin takes the r-th slot that the patterns offer
for it, which is arithmetic on a table of a few hundred rows.  A sequence's
pieces stand one after another from offset 0.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; every id lies in exactly one piece; an empty table gives no piece;
other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinlink.llm.common import count_partitions, stored
from kinlink.llm.cutting import solve
from kinlink.llm.encode import BATCH, Encoder

WIDTH = 4


def pieces(docs: DataFrame, tokenizer_json: str, seq_len: int, end_id: int, with_ids: bool = False, batch_bytes: int = BATCH) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, and with ``with_ids`` the ids: documents cut at multiples of ``seq_len``."""
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder.in_worker(sent.value, batch_bytes), end_id.to_bytes(WIDTH, "little")
        for b in batches:
            at, start, length, crc, total, own = [], [], [], [], [], []
            for i, ids in enumerate(encoder.encode(b.column(1))):
                ids += end
                for k in range(0, len(ids), WIDTH * seq_len):
                    piece = ids[k : k + WIDTH * seq_len]
                    at.append(i)
                    start.append(k // WIDTH)
                    length.append(len(piece) // WIDTH)
                    crc.append(zlib.crc32(piece))
                    total.append(len(ids) // WIDTH)
                    if with_ids:
                        own.append(piece)
            columns = [b.column(0).take(pa.array(at, pa.int32())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(own, pa.binary())] if with_ids else columns, [*names, "ids"] if with_ids else names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids)


def slots(plan: list[tuple[int, dict[int, int]]]) -> list[tuple[int, list[tuple[int, int, int, int]]]]:
    """For each bin, its runs of ranks: (first rank, rank after the last, slots in each sequence, first sequence)."""
    runs, filled, base = defaultdict(list), defaultdict(int), 0
    for times, pattern in plan:
        for units, each in pattern.items():
            runs[units].append((filled[units], filled[units] + times * each, each, base))
            filled[units] += times * each
        base += times
    return sorted(runs.items())


def layout(cut: DataFrame, seq_len: int, grain: int, per_group: int = 100_000) -> DataFrame:
    """``cut`` (stored pieces) with sequence_id and offset."""
    spark = cut.sparkSession
    binned = cut.withColumn("units", F.ceil(F.col("length") / grain).cast("int"))
    histogram = {r["units"]: r["count"] for r in binned.groupBy("units").count().collect()}  # at most seq_len / grain rows
    plan = slots(solve(histogram, seq_len // grain))
    table = spark.createDataFrame(plan, "units int, runs array<struct<low:long,high:long,each:long,base:long>>")
    salted = binned.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(count_partitions(sum(histogram.values()), per_group, 16))))
    before = salted.groupBy("units", "salt").count().withColumn("before", F.sum("count").over(Window.partitionBy("units").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))).select("units", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    ranked = salted.withColumn("own", F.row_number().over(Window.partitionBy("units", "salt").orderBy("doc_id", "start")) - 1).join(before, ["units", "salt"])
    placed = ranked.withColumn("rank", F.col("before") + F.col("own")).join(F.broadcast(table), "units")  # its size is bounded by the bins
    placed = placed.withColumn("run", F.filter("runs", lambda r: (F.col("rank") >= r.low) & (F.col("rank") < r.high))[0])
    placed = placed.withColumn("sequence_id", F.col("run.base") + F.floor((F.col("rank") - F.col("run.low")) / F.col("run.each")))
    line = Window.partitionBy("sequence_id").orderBy(F.desc("units"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(line), F.lit(0))).select(*cut.columns, "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer_path: str, seq_len: int = 1024, end_id: int = 0, grain: int = 4, with_ids: bool = False, batch_bytes: int = BATCH) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with ``with_ids`` each piece's ids."""
    if seq_len % grain:
        raise ValueError("grain divides seq_len")
    with open(tokenizer_path, encoding="utf-8") as f:
        source = f.read()
    return layout(stored(pieces(docs, source, seq_len, end_id, with_ids, batch_bytes), "pieces"), seq_len, grain)
