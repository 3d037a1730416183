"""``python -m kinlink.cli train|predict|evaluate|errors|validate|profile|package`` over TSV tables named in a YAML file.

The file holds ``sources`` (1, 2, 3: path by split, id, name, address), ``labels``
(path, id, match columns, and ``by_source`` if each column belongs to a source),
``run`` (the folder of results) and, if wanted, ``quoting``, ``overlap``, ``seed``,
``calibration``, ``training`` (negatives, missed, matchable, neighbours),
``decision`` (parameters that replace those found) and ``keep_matrix``.

Training and prediction run in stages; ``--stages`` names some of them and
``--resume`` passes over those that are done with the same settings.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.functions.columns import id_list
from kinlink.operators import decide, labels, metrics
from kinlink.plans import link
from kinlink.plans.stages import Run, Stage
from kinlink.sources import sinks, tables
from kinlink.sources.store import Store


def _specs(cfg: dict, split: str) -> dict[int, dict]:
    return {int(k): s | {"path": s["path"][split] if isinstance(s["path"], dict) else s["path"]} for k, s in cfg["sources"].items()}


def _load(split: str):
    def run(r: Run) -> dict:
        rows, stats = tables.load_sources(r.spark, _specs(r.settings, split), r.settings.get("quoting", "minimal"), r.settings.get("overlap", "allow"))
        with Store(r.spark) as keep:
            s1, v = link.prepare(rows, keep)
            r.write(f"{split}/s1", s1)
            r.write(f"{split}/vendors", v)
        return stats

    return run


def _labels(r: Run) -> dict:
    spec = r.settings["labels"]
    found, stats = tables.load_labels(r.spark, spec["path"], spec["id"], spec["matches"], spec.get("separator", ","))
    by_source = {int(k): c for k, c in spec["by_source"].items()} if "by_source" in spec else None
    truth = labels.resolve(found, r.table("train/s1"), r.table("train/vendors"), by_source=by_source, **spec.get("policies", {}))
    for name, d in zip(truth._fields, truth, strict=True):
        r.write(f"train/{name}", d)
    return stats


def _pair(split: str):
    def run(r: Run) -> dict:
        how = {k: x for k, x in r.settings.get("training", {}).items() if k == "neighbours"}
        with Store(r.spark) as keep:
            made = link.paired(r.table(f"{split}/s1"), r.table(f"{split}/vendors"), keep, **how)
            sizes = {n: r.write(f"{split}/{n}", d).count() for n, d in zip(("features", "candidates", "precap"), made, strict=True)}
        return sizes

    return run


def _made(r: Run, split: str) -> tuple[DataFrame, ...]:
    return tuple(r.table(f"{split}/{n}") for n in ("features", "candidates", "precap"))


def _fit(r: Run) -> dict:
    how = dict(r.settings.get("training", {}))
    truth = labels.Truth(*(r.table(f"train/{n}") for n in labels.Truth._fields))
    with Store(r.spark) as keep:
        linker, held = link.train(r.table("train/s1"), r.table("train/vendors"), truth, keep, method=r.settings.get("calibration", "isotonic"), seed=r.settings.get("seed", 7), made=_made(r, "train"), **how)
        linker.save(f"{r.folder}/model", r.spark)
        r.write("train/holdout", held)
    if not r.settings.get("keep_matrix", True):
        r.drop("train/features")
    return linker.report


def _decide(split: str):
    def run(r: Run) -> dict:
        linker = link.Linker.load(f"{r.folder}/model", r.spark)
        if own := r.settings.get("decision"):
            linker.params = decide.Params.of(linker.params.to_dict() | own)
        s1, v = r.table(f"{split}/s1"), r.table(f"{split}/vendors")
        with Store(r.spark) as keep:
            out, scored, found = link.predict(linker, s1, v, keep, r.settings.get("list_style", "plain"), "by_source" in r.settings.get("labels", {}), _made(r, split))
            r.write(f"{split}/scored", sinks.scored_table(scored, linker.params.graph_mode))
            out = r.write(f"{split}/results", out)
            sinks.write_tsv(found.orderBy("source1_id", "candidate_source", "candidate_id"), f"{r.folder}/{split}/candidate_pairs.tsv")
        sinks.write_tsv(out.orderBy("row_order").drop("row_order"), f"{r.folder}/{split}/matching_results.tsv")
        if not r.settings.get("keep_matrix", True):
            r.drop(f"{split}/features")
        lists = [c for c in out.columns if c not in ("s1_id", "row_order")]
        return sinks.validate(out.drop("row_order"), s1, v, lists).first().asDict()

    return run


SOURCES = ("sources", "quoting", "overlap")
FITTING = ("training", "calibration", "seed")


def training(spark: SparkSession, cfg: dict) -> Run:
    return Run(spark, cfg["run"], cfg, [Stage("load", (), _load("train"), SOURCES), Stage("labels", ("load",), _labels, ("labels",)), Stage("pair", ("load",), _pair("train"), ("training",)), Stage("fit", ("labels", "pair"), _fit, FITTING)])


def prediction(spark: SparkSession, cfg: dict, split: str) -> Run:
    return Run(spark, cfg["run"], cfg, [Stage(f"{split}-load", (), _load(split), SOURCES), Stage(f"{split}-pair", (f"{split}-load",), _pair(split), ("training",)), Stage(f"{split}-decide", (f"{split}-pair",), _decide(split), (*FITTING, "decision", "list_style"))])


def errors(spark: SparkSession, cfg: dict) -> dict:
    """The seven tables of what went wrong on the holdout entities, as TSV files, and their sizes."""
    r = training(spark, cfg)
    held, truth = r.table("train/holdout"), labels.Truth(*(r.table(f"train/{n}") for n in labels.Truth._fields))
    own = held.select("s1_idx").distinct()
    params = link.Linker.load(f"{r.folder}/model", spark).params
    found = metrics.error_tables(truth.entities.join(own, "s1_idx", "left_semi"), held, truth.pairs.join(own, "s1_idx", "left_semi"), r.table("train/s1"), r.table("train/vendors"), params.threshold_s2)
    for name, d in found.items():
        sinks.write_tsv(d, f"{r.folder}/errors/{name}.tsv")
    return {name: d.count() for name, d in found.items()}


def _lists(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    d = tables.read_tsv(spark, path)
    return d.select(F.col(f"`{d.columns[0]}`").alias("s1_id"), F.flatten(F.array(*(id_list(F.col(f"`{c}`")) for c in (columns or d.columns[1:])))).alias("ids"))


def evaluate(spark: SparkSession, predicted: str, truth: str, columns: list[str]) -> dict:
    """Two files of lists, each with the entity's id in its first column."""
    return metrics.summary(metrics.score_lists(_lists(spark, predicted, columns), _lists(spark, truth, columns))).first().asDict()


def validate(spark: SparkSession, cfg: dict, path: str, split: str) -> dict:
    """A result file against the sources, and against the label file's columns if there is one."""
    out = tables.read_tsv(spark, path)
    if "labels" in cfg and len(tables.header(spark, cfg["labels"]["path"])) != len(out.columns):
        raise tables.SchemaError(f"columns are {out.columns}, those of the labels {tables.header(spark, cfg['labels']['path'])}")
    rows, _ = tables.load_sources(spark, _specs(cfg, split), cfg.get("quoting", "minimal"))
    lists = out.columns[1:]
    return sinks.validate(out.withColumnRenamed(out.columns[0], "s1_id"), rows[1], rows[2].unionByName(rows[3]), lists).first().asDict()


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="kinlink", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("command", choices=("train", "predict", "evaluate", "errors", "validate", "profile", "package"))
    p.add_argument("--config")
    p.add_argument("--set", nargs="*", default=[], metavar="KEY=VALUE")
    p.add_argument("--decision", nargs="*", default=[], metavar="KEY=VALUE", help="decision parameters that replace those found")
    p.add_argument("--stages", nargs="*", help="run these stages only")
    p.add_argument("--resume", action="store_true", help="pass over stages that are done")
    p.add_argument("--split", default="test")
    p.add_argument("--predictions")
    p.add_argument("--labels")
    p.add_argument("--columns", nargs="*", default=[])
    p.add_argument("--table", help="the TSV file to profile")
    p.add_argument("--include-models", action="store_true", help="put the models into the archive")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("kinlink").getOrCreate()
    cfg = tables.load_config(a.config, [*a.set, *(f"decision.{x}" for x in a.decision)]) if a.config else {}
    if a.command == "train":
        out = training(spark, cfg).go(a.stages, a.resume)
    elif a.command == "predict":
        out = prediction(spark, cfg, a.split).go(a.stages, a.resume)
    elif a.command == "evaluate":
        out = evaluate(spark, a.predictions, a.labels, a.columns)
    elif a.command == "errors":
        out = errors(spark, cfg)
    elif a.command == "validate":
        out = validate(spark, cfg, a.predictions, a.split)
    elif a.command == "package":
        out = sinks.archive(f"{cfg['run']}.zip", cfg["run"], ["*/*.tsv", *(["model/**"] if a.include_models else [])])
    else:
        out = {r["column"]: r.asDict() for r in tables.profile(tables.read_tsv(spark, a.table)).collect()}
    print(json.dumps(out, indent=1, default=str))


if __name__ == "__main__":
    main()
