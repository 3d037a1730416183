import json

import pytest
from kinlink import cli
from kinlink.plans.stages import Run, Stage, StageError
from kinlink.sources import sinks, synthetic
from pyspark.sql import functions as F


def test_evaluate_and_profile(spark, tmp_path, capsys):
    (tmp_path / "p.tsv").write_text("s\tm\ne1\ta\ne3\tx\nother\ty\n")
    (tmp_path / "t.tsv").write_text("s\tm\ne1\t[a, b]\ne2\t[]\ne3\t\n")
    cli.main(["evaluate", "--predictions", str(tmp_path / "p.tsv"), "--labels", str(tmp_path / "t.tsv")])
    out = json.loads(capsys.readouterr().out)
    assert out["entities"] == 3 and abs(out["macro_f"] - (0.625 / 0.75 + 1) / 3) < 1e-9
    cli.main(["profile", "--table", str(tmp_path / "t.tsv")])
    assert json.loads(capsys.readouterr().out)["s"]["n_distinct"] == 3


def test_stages(spark, tmp_path):
    ran = []
    stage = lambda name, needs, reads=(): Stage(name, needs, lambda r: ran.append(name) or {"n": r.write(name, r.spark.range(3)).count()}, reads)
    make = lambda **k: Run(spark, str(tmp_path / "run"), k, [stage("a", (), ("x",)), stage("b", ("a",)), stage("c", ("b",), ("y",))])
    with pytest.raises(StageError):
        make(x=1).go(["b"])  # a has not run
    with pytest.raises(StageError):
        make(x=1).go(["z"])
    assert make(x=1).go()["c"] == {"n": 3} and ran == ["a", "b", "c"]
    make(x=1, y=2).go(resume=True)
    assert ran == ["a", "b", "c", "c"]  # only c reads y
    make(x=2).go(["a"])
    with pytest.raises(StageError):
        make(x=2).go(["c"])  # b is out of date
    make(x=2).go(resume=True)
    assert ran[-2:] == ["b", "c"]


def test_train_predict_errors_validate_package(spark, tmp_path, capsys):
    for split, n, seed in (("train", 120, 7), ("test", 40, 8)):
        sources, truth = synthetic.tables(spark, n, seed=seed)
        for k, d in sources.items():
            sinks.write_tsv(d.select("id", "name", "address"), str(tmp_path / f"{split}{k}.tsv"))
        sinks.write_tsv(truth.select("s1_id", F.array_join("all_ids", ",").alias("matches")), str(tmp_path / f"{split}_labels.tsv"))
    source = lambda k: {"path": {s: str(tmp_path / f"{s}{k}.tsv") for s in ("train", "test")}, "id": "id", "name": "name", "address": ["address"]}
    cfg = {"sources": {k: source(k) for k in (1, 2, 3)}, "labels": {"path": str(tmp_path / "train_labels.tsv"), "id": "s1_id", "matches": ["matches"]}, "run": str(tmp_path / "run"), "quoting": "none", "keep_matrix": False}
    (tmp_path / "c.json").write_text(json.dumps(cfg))
    run = lambda *a: (cli.main([*a, "--config", str(tmp_path / "c.json")]), json.loads(capsys.readouterr().out))[1]
    assert run("train")["fit"]["holdout"]["macro_f"] > 0.6
    assert run("predict")["test-decide"]["n_rows"] == 40
    assert run("errors").keys() >= {"false_positives", "difficult", "singleton_errors"}
    result = str(tmp_path / "run/test/matching_results.tsv")
    assert run("validate", "--predictions", result)["missing_ids"] == 0
    assert run("evaluate", "--predictions", result, "--labels", str(tmp_path / "test_labels.tsv"))["macro_f"] > 0.6
    assert "test/matching_results.tsv" in run("package") and any(n.startswith("model/") for n in run("package", "--include-models"))
