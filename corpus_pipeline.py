"""A corpus pipeline: each stage calls one operator on all that the stage before it kept.

``run`` applies the stages to the documents, each written as Parquet in the
folder that the cluster shares and read again as the next one's input; what a
stage stores on its way is deleted when it is done.

Defined results, for every stage: rows are known by doc_id and text, a null id
or text among them; a null text is an empty one; repeated rows are judged alike
(near-dedup keeps one of them); an empty table gives an empty one; other columns
pass through, whatever their names, but for n_chars, which follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.llm import decontam, lines, nearcopies, packing, quality
from kinlink.llm.common import stored, stored_alone, table
from kinlink.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; n_chars follows the text."""
    occ = stored(lines.occurrences(docs, 1), "line-occurrences")
    out = lines.filter_documents(docs, lines.LineIndex.build(docs, 10, 1, occ), occ)
    put = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return out.select(*(put[c].alias(c) if c in put else F.col(f"`{c}`") for c in docs.columns))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of exact and near copies the document with the smallest doc_id stays."""
    return nearcopies.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which an item of the benchmark leaks go; rows are known by id and text, a null id among them."""
    leaks = decontam.contaminated(docs, table(spark, sf_dir, "benchmark"), min_match=5, min_coverage=0.8)
    bad = stored(leaks.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).distinct(), "leaks")
    names, at, text = [f"c{i}" for i in range(len(docs.columns))], docs.columns.index("doc_id"), docs.columns.index("text")
    rows = docs.toDF(*names)
    return rows.join(bad, F.col(names[at]).eqNullSafe(F.col("__id")) & (F.xxhash64(names[text]) == F.col("__th")), "left_anti").toDF(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of the documents left, in sequences of 1024."""
    return packing.pack(docs, tokenizer_path(), seq_len=1024, end_id=0, batch_bytes=4 << 20)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("simhash near-dedup", simhash_near_dedup), ("benchmark decontamination", benchmark_decontamination), ("packing", packed)]

#: SimHash, cutting stock and tokenizers are not SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored_alone(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name.replace(" ", "-"), spark)
    return STAGES[-1][1](spark, docs, sf_dir)
