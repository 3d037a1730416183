"""Sources: TSV files, source and label tables, configuration, profiles."""

from __future__ import annotations

import copy
import os
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinlink.functions.columns import id_list, joined, list_style, squeezed


class SchemaError(ValueError):
    """A table lacks columns or holds what the configuration rules out."""


def read_tsv(spark: SparkSession, path: str, quoting: str = "minimal") -> DataFrame:
    """All columns are strings, missing is empty, names are trimmed; the word NA stays."""
    reader = spark.read.options(sep="\t", header=True, inferSchema=False, multiLine=quoting != "none")
    raw = (reader.option("quote", "") if quoting == "none" else reader.option("escape", '"')).csv(path)
    return raw.toDF(*(c.lstrip("﻿").strip() for c in raw.columns)).fillna("")


def lost_rows(spark: SparkSession, path: str, rows: DataFrame) -> int:
    """Lines of the file that are not blank, less the header and the rows that were parsed."""
    return spark.read.text(path).filter(F.length(F.trim("value")) > 0).count() - 1 - rows.count()


def need(df: DataFrame, columns: list[str], what: str) -> None:
    if missing := [c for c in columns if c not in df.columns]:
        raise SchemaError(f"{what}: no column {', '.join(missing)}; there are {', '.join(df.columns)}")


def numbered(df: DataFrame, name: str = "row_order") -> DataFrame:
    """Rows with their place in the table: the place in the task, and the rows of the tasks before it (one count a task)."""
    here = df.withColumn("_at", F.monotonically_increasing_id()).withColumn("_task", F.shiftright("_at", 33))
    counts = here.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_task", F.coalesce(F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return here.join(F.broadcast(before), "_task").select(*(F.col(f"`{c}`") for c in df.columns), (F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias(name))


def project_source(raw: DataFrame, source: int, id_col: str, name_col: str, address_cols: list[str], address_join: str = ", ") -> DataFrame:
    """id, name, address, row_order, source, of a raw table that has row_order."""
    need(raw, [id_col, name_col, *address_cols], f"source {source}")
    return raw.select(squeezed(F.col(id_col)).alias("id"), squeezed(F.col(name_col)).alias("name"), joined([F.col(c) for c in address_cols], address_join).alias("address") if address_cols else F.lit("").alias("address"), "row_order", F.lit(source).cast("byte").alias("source"))


def keep_first(df: DataFrame, key: str = "id", order: str = "row_order") -> DataFrame:
    """The first row of each key; a key that a third of the rows share is cut to one row a task before the shuffle."""
    return df.withColumn("_first", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter("_first = 1").drop("_first")


def source_stats(rows: DataFrame) -> DataFrame:
    """One row: what a source table holds before empty and duplicate ids go."""
    sized = rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("id") == "").alias("empty_id_dropped"),
        F.count_if((F.col("id") != "") & (F.col("name") == "")).alias("empty_name"),
        F.count_if((F.col("id") != "") & (F.col("address") == "")).alias("empty_address"),
        F.count_if((F.col("id") != "") & (F.col("name") == "") & (F.col("address") == "")).alias("empty_name_and_address"),
        (F.count_if(F.col("id") != "") - F.count_distinct(F.when(F.col("id") != "", F.col("id")))).alias("duplicate_ids"),
    )
    return sized


def repeated_pairs() -> Column:
    """Aggregate: rows whose lower-cased name and address were there before."""
    return F.count(F.lit(1)) - F.count_distinct(F.lower("name"), F.lower("address"))


def load_source(spark: SparkSession, path: str, source: int, spec: dict[str, Any], quoting: str = "minimal", duplicates: str = "keep_first") -> tuple[DataFrame, dict]:
    """spec: id, name, address (list of columns), and address_join if it is not ', '."""
    raw = read_tsv(spark, path, quoting)
    rows = project_source(numbered(raw), source, spec["id"], spec["name"], spec.get("address", []), spec.get("address_join", ", "))
    stats = source_stats(rows).first().asDict() | {"lost_rows": lost_rows(spark, path, raw)}
    if stats["lost_rows"] > 0 and quoting == "minimal":
        raise SchemaError(f"source {source}: {stats['lost_rows']} lines were swallowed by quotes; read it with quoting none")
    if stats["duplicate_ids"] and duplicates == "error":
        raise SchemaError(f"source {source}: {stats['duplicate_ids']} duplicate ids")
    kept = keep_first(rows.filter("id <> ''"))
    return kept, stats | {"duplicate_name_address_rows": kept.agg(repeated_pairs()).first()[0]}


def shared_ids(a: DataFrame, b: DataFrame) -> DataFrame:
    """Ids that both sources use, so that an id alone does not tell the record."""
    return a.select("id").intersect(b.select("id"))


def load_sources(spark: SparkSession, specs: dict[int, dict[str, Any]], quoting: str = "minimal", overlap: str = "allow") -> tuple[dict[int, DataFrame], dict]:
    """All sources and their statistics; ids that sources 2 and 3 share are counted, or an error if ``overlap`` says so."""
    found = {k: load_source(spark, s["path"], k, s, quoting) for k, s in specs.items()}
    rows, stats = {k: x[0] for k, x in found.items()}, {k: x[1] for k, x in found.items()}
    shared = shared_ids(rows[2], rows[3]).count() if {2, 3} <= set(rows) else 0
    if shared and overlap == "error":
        raise SchemaError(f"sources 2 and 3 share {shared} ids")
    return rows, {"sources": stats, "shared_ids": shared}


def label_sizes(labels: DataFrame) -> DataFrame:
    """size, n: how many entities have lists of each size."""
    return labels.groupBy(F.size("all_ids").alias("size")).agg(F.count(F.lit(1)).alias("n"))


def project_labels(raw: DataFrame, s1_id: str, match_columns: list[str], sep: str = ",") -> DataFrame:
    """s1_id, one list of ids for each match column, all_ids; rows of one id are united in file order (raw has row_order)."""
    need(raw, [s1_id, *match_columns], "labels")
    rows = raw.select(squeezed(F.col(s1_id)).alias("s1_id"), "row_order", *(id_list(F.col(c), sep).alias(c) for c in match_columns))
    united = lambda c: F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("row_order", c))), lambda x: x[c])))
    out = rows.groupBy("s1_id").agg(*(united(c).alias(c) for c in match_columns))
    return out.withColumn("all_ids", F.array_distinct(F.flatten(F.array(*match_columns))))


def label_stats(labels: DataFrame) -> DataFrame:
    return labels.agg(F.count(F.lit(1)).alias("entities"), F.count_if(F.size("all_ids") == 0).alias("singletons"), F.avg((F.size("all_ids") == 0).cast("double")).alias("singleton_rate"), F.sum(F.size("all_ids")).cast("long").alias("total_label_ids"))


def load_labels(spark: SparkSession, path: str, s1_id: str, match_columns: list[str], sep: str = ",") -> tuple[DataFrame, dict]:
    raw = numbered(read_tsv(spark, path))
    labels = project_labels(raw, s1_id, match_columns, sep)
    style = raw.agg(list_style(F.col(match_columns[0]))).first()[0]
    return labels, label_stats(labels).first().asDict() | {"list_format": style}


def header(spark: SparkSession, path: str) -> list[str]:
    return read_tsv(spark, path).columns


def profile(df: DataFrame, sep: str = ",") -> DataFrame:
    """One row a column: rows, share empty, distinct values, the least value and the longest list in it."""
    rows = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias("value")) for c in df.columns))).alias("x")).select("x.*")
    some = F.when(F.col("value") != "", F.col("value"))
    return rows.groupBy("column").agg(F.count(F.lit(1)).alias("n_rows"), F.avg((F.col("value") == "").cast("double")).alias("empty_share"), F.count_distinct(some).alias("n_distinct"), F.min(some).alias("example"), F.max(F.size(id_list(F.col("value"), sep))).cast("long").alias("longest_list"))


def merged(base: dict, over: dict) -> dict:
    out = copy.deepcopy(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


def load_config(path: str, overrides: list[str] = ()) -> dict:
    """YAML; ``base`` names a file to inherit from; overrides are ``dotted.key=value``."""
    import yaml

    with open(path, encoding="utf-8") as f:
        own = yaml.safe_load(f) or {}
    if base := own.pop("base", None):
        own = merged(load_config(os.path.join(os.path.dirname(path), base)), own)
    for item in overrides:
        key, _, value = item.partition("=")
        at = own
        *way, last = key.split(".")
        for k in way:
            at = at.setdefault(k, {})
        at[last] = yaml.safe_load(value)
    return own


def lookup(config: dict, key: str, default: Any = None) -> Any:
    for k in key.split("."):
        if not isinstance(config, dict) or k not in config:
            return default
        config = config[k]
    return config
