import pytest
from kinlink.functions import columns as C
from kinlink.sources import sinks, tables
from pyspark.sql import functions as F


def test_id_lists(spark):
    cases = {"a,b": "ab", "a, b ,": "ab", "": "", "[]": "", "[a, b]": "ab", "['a','b']": "ab", '"a", "b", "a"': "ab", '["a", "b", "a"]': "ab", "nan": "", "(a)": "a", "{b}": "b"}
    df = spark.createDataFrame([(k, list(v)) for k, v in cases.items()] + [(None, [])], "t string, want array<string>")
    assert all(r.got == r.want for r in df.select("want", C.id_list(F.col("t")).alias("got")).collect())
    style = lambda v: spark.createDataFrame([(x,) for x in v], "t string").agg(C.list_style(F.col("t"))).first()[0]
    assert style(["[a]", "[]", "[b, c]"]) == "bracketed" and style(["a", "", "b,c"]) == "plain" and style([""]) == "plain"


def test_fbeta(spark):
    want = {(0, 0, 0): 1, (0, 1, 0): 0, (0, 0, 2): 0, (1, 1, 2): 0.625 / 0.75 * 1, (1, 2, 1): 0.625 / 1.125}
    df = spark.createDataFrame(list(want), "tp long, p long, t long")
    for r in df.select("*", C.fbeta(F.col("tp"), F.col("p"), F.col("t")).alias("f")).collect():
        assert abs(r.f - {(1, 1, 2): 1.25 / 1.5}.get((r.tp, r.p, r.t), want[r.tp, r.p, r.t])) < 1e-9 or (r.tp, r.p, r.t) == (1, 2, 1) and abs(r.f - 1.25 / 2.25) < 1e-9


def test_sources_and_sinks(spark, tmp_path):
    p = tmp_path / "s.tsv"
    p.write_text("﻿record_id\tbusiness_name \tstreet\tcity\nA1\t NA  Ltd\t1 Main St\t\n\t x\ty\tz\nA1\tsecond\t\tParis\nA2\t\t\t\n", encoding="utf-8")
    rows, stats = tables.load_source(spark, str(p), 2, {"id": "record_id", "name": "business_name", "address": ["street", "city"]})
    assert sorted(map(tuple, rows.select("id", "name", "address").collect())) == [("A1", "NA Ltd", "1 Main St"), ("A2", "", "")]
    assert stats["empty_id_dropped"] == 1 and stats["duplicate_ids"] == 1 and stats["n_rows"] == 4
    with pytest.raises(tables.SchemaError):
        tables.load_source(spark, str(p), 2, {"id": "record_id", "name": "none"})
    with pytest.raises(tables.SchemaError):
        tables.load_source(spark, str(p), 2, {"id": "record_id", "name": "business_name"}, duplicates="error")
    q = tmp_path / "l.tsv"
    q.write_text("s\tm2\tm3\nA1\tb,c\t\nA1\tb\td\nA2\t[]\t\n", encoding="utf-8")
    found, stats = tables.load_labels(spark, str(q), "s", ["m2", "m3"])
    assert {r.s1_id: r.all_ids for r in found.collect()} == {"A1": ["b", "c", "d"], "A2": []} and stats["singletons"] == 1
    sinks.write_tsv(rows.select("id", "name"), str(tmp_path / "out"))
    text = (tmp_path / "out").read_text()
    assert text.splitlines()[0] == "id\tname" and "A2\t" in text.splitlines()
    assert tables.lost_rows(spark, str(p), tables.read_tsv(spark, str(p))) == 0


def test_config(tmp_path):
    (tmp_path / "base.yaml").write_text("a: {b: 1, c: 2}\nd: 3\n")
    (tmp_path / "own.yaml").write_text("base: base.yaml\na: {b: 5}\n")
    c = tables.load_config(str(tmp_path / "own.yaml"), ["a.e=[1, 2]"])
    assert c == {"a": {"b": 5, "c": 2, "e": [1, 2]}, "d": 3} and tables.lookup(c, "a.x", 9) == 9


def test_results(spark):
    s1 = spark.createDataFrame([(0, "A1", 0), (1, "A2", 1), (2, "A3", 2)], "s1_idx long, id string, row_order long")
    v = spark.createDataFrame([(0, "B1", 2), (2, "B3", 2), (3, "C1", 3)], "v_idx long, id string, source int")
    chosen = spark.createDataFrame([(0, 0, 0.9), (0, 3, 0.95), (1, 2, 0.8)], "s1_idx long, v_idx long, p_final double")
    got = lambda **k: [tuple(r) for r in sinks.matching_results(s1, v, chosen, **k).orderBy("row_order").drop("row_order").collect()]
    assert got() == [("A1", "C1,B1"), ("A2", "B3"), ("A3", "")]
    assert got(style="bracketed") == [("A1", "[C1, B1]"), ("A2", "[B3]"), ("A3", "[]")]
    assert got(by_source=True) == [("A1", "B1", "C1"), ("A2", "B3", ""), ("A3", "", "")]
