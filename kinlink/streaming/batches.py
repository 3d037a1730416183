"""New vendor records as they come: each micro-batch is linked against the fixed list of source 1.

An extension beyond batch linkage; the linker and source 1 are those of a
finished training run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinlink.operators import normalize
from kinlink.plans.link import Linker, paired
from kinlink.sources.store import kept


def linked(batch: DataFrame, s1: DataFrame, linker: Linker) -> DataFrame:
    """s1_id, vendor_id, p_final of the chosen pairs of one batch (id, name, address, row_order, source)."""
    v = kept(normalize.normalised(batch), "batch").withColumn("v_idx", F.col("row_order") * 2 + F.col("source") - 2)
    scored = linker.select(linker.score(paired(s1, v)[0])).filter("selected")
    return scored.join(s1.select("s1_idx", F.col("id").alias("s1_id")), "s1_idx").join(v.select("v_idx", F.col("id").alias("vendor_id")), "v_idx").select("s1_id", "vendor_id", "p_final")


def link_stream(vendors: DataFrame, s1: DataFrame, linker: Linker, path: str, checkpoint: str) -> StreamingQuery:
    """Write each micro-batch's links below ``path``/batch=<id>; a batch that is run again overwrites its own folder."""

    def run(batch: DataFrame, number: int) -> None:
        linked(batch, s1, linker).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return vendors.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
